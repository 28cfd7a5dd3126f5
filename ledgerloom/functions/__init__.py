from .codes import email_domain, email_status, loyalty_tier_code, payment_method_code, text_to_boolean
from .flags import invalid_date_flag, missing_flag, negative_flag, zero_flag
from .objects import object_construct, object_construct_keep_null, sha256_of
from .parse import abs_value, line_total, safe_date, safe_decimal, safe_integer
from .text import (
    blank_to_null,
    default_currency,
    first_name_from,
    last_name_from,
    norm_initcap,
    norm_lower,
    norm_trim,
    norm_upper,
)

__all__ = [
    "abs_value", "blank_to_null", "default_currency", "email_domain", "email_status", "first_name_from",
    "invalid_date_flag", "last_name_from", "line_total", "loyalty_tier_code", "missing_flag", "negative_flag",
    "norm_initcap", "norm_lower", "norm_trim", "norm_upper", "object_construct", "object_construct_keep_null",
    "payment_method_code", "safe_date", "safe_decimal", "safe_integer", "sha256_of", "text_to_boolean", "zero_flag",
]
