"""Text normalisation. Only the empty string becomes NULL; blanks trim to ''."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Characters after which the next letter is a capital. The
# apostrophe is not among them.
WORD_DELIMITERS = r'\s!?@"^#$&~_,.:;+\-*%/|\\\[\](){}<>'


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def norm_trim(c: Column) -> Column:
    return F.trim(blank_to_null(c))


def norm_upper(c: Column) -> Column:
    return F.upper(norm_trim(c))


def norm_lower(c: Column) -> Column:
    return F.lower(norm_trim(c))


def capitalise_words(c: Column) -> Column:
    words = F.split(F.lower(c), f"(?<=[{WORD_DELIMITERS}])")
    capitalised = F.transform(words, lambda w: F.concat(F.upper(w.substr(1, 1)), F.substr(w, F.lit(2))))
    return F.array_join(capitalised, "")


def norm_initcap(c: Column) -> Column:
    return capitalise_words(norm_trim(c))


def default_currency(c: Column) -> Column:
    return F.coalesce(norm_upper(c), F.lit("USD"))


def first_name_from(first: Column, full: Column) -> Column:
    """The given first name, else the first token of the full name."""
    return F.when(blank_to_null(first).isNotNull(), capitalise_words(F.trim(first))).when(
        blank_to_null(full).isNotNull(), capitalise_words(F.trim(F.split_part(full, F.lit(" "), F.lit(1))))
    )


def last_name_from(last: Column, full: Column) -> Column:
    """The given last name, else the second token of the full name ('' if there is one token)."""
    second = F.when(F.size(F.split(full, " ")) > 1, F.split_part(full, F.lit(" "), F.lit(2))).otherwise(F.lit(""))
    return F.when(blank_to_null(last).isNotNull(), capitalise_words(F.trim(last))).when(
        blank_to_null(full).isNotNull(), capitalise_words(F.trim(second))
    )
