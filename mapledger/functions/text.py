"""Small text helpers that follow the service's idea of 'missing' and 'blank'."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def given(value: Column) -> Column:
    """The text, or null when it is empty."""
    return F.nullif(value, F.lit(""))


# The characters that count as white space at the ends of a text.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009"
    "\u200a\u2028\u2029\u202f\u205f\u3000"
)


def stripped(value: Column) -> Column:
    """The text without white space at both ends, Unicode spaces included."""
    return F.btrim(value, F.lit(WHITE_SPACE))


def tokens(text: str) -> list[str]:
    """The lower-case words of a search text."""
    return (text or "").lower().split()
