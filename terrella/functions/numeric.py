"""Scalar arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sigmoid(x: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-x))


def round_half_even(x: Column) -> Column:
    """Nearest whole number as an integer; ties go to the even neighbour."""
    return F.rint(x).cast("int")


def drawn_bits(hex_digits: int, *parts: Column | int) -> Column:
    """Number made of the first hex digits (15 at most) of the MD5 of the parts, joined by '-'.

    A null part is written as nothing, so that rows with null keys get a number too.
    """
    texts = [F.coalesce((p if isinstance(p, Column) else F.lit(p)).cast("string"), F.lit("")) for p in parts]
    digest = F.md5(F.concat_ws("-", *texts).cast("binary"))
    return F.conv(F.substring(digest, 1, hex_digits), 16, 10).cast("bigint")
