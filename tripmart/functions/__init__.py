from tripmart.functions.columns import *  # noqa: F401,F403
from tripmart.functions.columns import (  # noqa: F401
    PAYMENT_LABELS, VENDOR_LABELS, SURROGATE_NULL_TOKEN, snake_case,
)
