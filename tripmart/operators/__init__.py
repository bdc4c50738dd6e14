"""tripmart.operators."""
