"""String cleaning and safe numeric parsing as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Numbers pandas' to_numeric accepts: optional sign, digits with optional
# fraction (or a bare fraction), optional exponent, surrounding blanks.
# Everything else ('1d', '1.5f', '1_0', 'nan', 'inf', '0x10') becomes NULL.
NUMERIC_PATTERN = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"

NULL_TOKENS = ("?", "")


def strip_blanks(c: Column) -> Column:
    """Remove leading/trailing whitespace like Python's ``str.strip()``.

    Spark's ``trim`` removes spaces only, so it is not used here.
    """
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def null_tokens(c: Column, tokens=NULL_TOKENS) -> Column:
    """'?' and '' become NULL; everything else passes through."""
    return F.when(c.isin(*tokens), F.lit(None).cast("string")).otherwise(c)


def safe_double(c: Column) -> Column:
    """Guarded cast: NULL unless the text is a plain decimal number."""
    s = c.cast("string")
    return F.when(s.rlike(NUMERIC_PATTERN), s.try_cast("double"))
