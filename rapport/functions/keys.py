"""Join-key and name normalisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters after which a new word starts, besides white space.
WORD_BREAKS = r"""[](){}/|\<>!?@"^#$&~_,.:;*%+-"""


def clean_phone(phone: Column) -> Column:
    """Ten-digit phone key; null when the text does not hold exactly one.

    Punctuation is dropped, and so is a leading country code 1.
    """
    digits = F.regexp_replace(phone, r"\D", "")
    return F.nullif(F.regexp_extract(digits, r"^1?(\d{10})$", 1), F.lit(""))


def full_name(first: Column, last: Column) -> Column:
    """Space-joined name; missing parts are skipped, none at all gives ''."""
    return F.concat_ws(" ", first, last)


def strip_prefix(value: Column, prefix: str) -> Column:
    """Bare id of an external id: without exactly this prefix, as it is where it has none."""
    return F.when(value.startswith(prefix), F.substring(value, len(prefix) + 1, 2147483647)).otherwise(value)


def add_prefix(value: Column, prefix: str) -> Column:
    """External id from a bare id; null stays null."""
    return F.concat(F.lit(prefix), value.cast("string"))


def title_case(value: Column) -> Column:
    """Capitalise each word, where punctuation as well as white space ends a word.

    Spark's own ``initcap`` only starts a new word after a space.
    """
    breaks = "".join("\\" + c for c in WORD_BREAKS)
    words = F.split(F.lower(value), rf"(?<=[\s{breaks}])")
    return F.array_join(
        F.transform(words, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, 2, 2147483647))),
        "",
    )
