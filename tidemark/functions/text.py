"""Text helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters with the Unicode property White_Space.
WHITESPACE = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip_whitespace(c: Column) -> Column:
    """Drop leading and trailing whitespace of any kind (trim() drops spaces only)."""
    return F.btrim(c, F.lit(WHITESPACE))


def plain_double(c: Column) -> Column:
    """Text of a double without an exponent where it is of ordinary size."""
    size = F.abs(c)
    digits = F.regexp_replace(c.try_cast("decimal(38,12)").cast("string"), "0+$", "")
    plain = F.when(digits.endswith("."), F.concat(digits, F.lit("0"))).otherwise(digits)
    ordinary = ((size >= 1e7) & (size < 1e16)) | ((size >= 1e-4) & (size < 1e-3))
    return F.when(ordinary, plain).otherwise(c.cast("string"))
