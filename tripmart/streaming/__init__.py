"""tripmart.streaming."""
