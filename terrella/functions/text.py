"""String helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_BLANKS = " \t\n\r\x0b\x0c"


def slice_text(text: Column, start: int, stop: int) -> Column:
    """Characters ``[start, stop)``, counted from zero."""
    return F.substring(text, start + 1, stop - start)


def strip(text: Column) -> Column:
    """Remove blanks, tabs and line ends on both sides (``trim`` only removes blanks)."""
    return F.btrim(text, F.lit(_BLANKS))


def strip_lower(text: Column) -> Column:
    return F.lower(strip(text))
