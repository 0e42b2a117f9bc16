"""Words of whole texts as native expressions."""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Runs of ASCII digits and letters and of everything beyond ASCII, once A-Z is lower case.
ALNUM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ALNUM_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"
#: Runs of anything but ASCII white space.
SPACED_WORD = r"[^\x20\x09-\x0D]+"


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case; letters beyond ASCII as they are, unlike ``lower``."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def alnum_words(text: Column) -> Column:
    """The words of lower-cased ``text``; none for null."""
    found = F.regexp_extract_all(lower_ascii(text), F.lit(ALNUM_WORD), F.lit(0))
    return F.coalesce(found, F.array().cast("array<string>"))


def spaced_words(text: Column) -> Column:
    """What white space separates in ``text``; none for null."""
    found = F.regexp_extract_all(text, F.lit(SPACED_WORD), F.lit(0))
    return F.coalesce(found, F.array().cast("array<string>"))
