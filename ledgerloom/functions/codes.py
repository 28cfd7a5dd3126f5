"""Code lists and format checks."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import blank_to_null

# The recognised spellings per payment method code.
PAYMENT_METHOD_SPELLINGS = {
    "CREDIT_CARD": ["CREDITCARD", "CREDIT_CARD", "CC"],
    "DEBIT_CARD": ["DEBITCARD", "DEBIT_CARD", "DC"],
    "BANK_TRANSFER": ["BANKTRANSFER", "BANK_TRANSFER", "WIRE"],
}
# Loyalty tiers, words for true and false, the e-mail pattern.
LOYALTY_TIERS = ["GOLD", "SILVER", "BRONZE", "PLATINUM"]
TRUE_WORDS = ["TRUE", "YES", "1", "Y", "T"]
FALSE_WORDS = ["FALSE", "NO", "0", "N", "F"]
EMAIL_PATTERN = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}\z"


def email_status(c: Column) -> Column:
    address = F.lower(F.trim(c))
    return (
        F.when(blank_to_null(F.trim(c)).isNull(), "MISSING")
        .when(~address.rlike(EMAIL_PATTERN), "INVALID")
        .otherwise("VALID")
    )


def email_domain(c: Column) -> Column:
    return F.split_part(c, F.lit("@"), F.lit(2))


def payment_method_code(c: Column) -> Column:
    spelled = F.upper(F.trim(c))
    packed = F.replace(spelled, F.lit(" "), F.lit(""))
    code = F.when(spelled == "PAYPAL", "PAYPAL")
    for name, spellings in PAYMENT_METHOD_SPELLINGS.items():
        code = code.when(packed.isin(spellings), name)
    return code.when(blank_to_null(spelled).isNull(), "MISSING").otherwise("OTHER")


def loyalty_tier_code(c: Column) -> Column:
    tier = F.upper(F.trim(c))
    return F.when(tier.isin(LOYALTY_TIERS), tier).otherwise("UNKNOWN")


def text_to_boolean(c: Column) -> Column:
    word = F.upper(F.trim(c))
    return F.when(word.isin(TRUE_WORDS), True).when(word.isin(FALSE_WORDS), False)
