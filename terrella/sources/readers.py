"""Readers for typed, headerless, positional and fixed-width text files."""

from __future__ import annotations

import csv
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrella.functions.text import slice_text, strip


def read_csv_typed(
    spark: SparkSession,
    path: str | list[str],
    schema: str,
    aliases: Mapping[str, str] | None = None,
    malformed: str | None = None,
) -> DataFrame:
    """CSV files with a header line; types are bound to the columns' names.

    Files may differ in the order of their columns and in the columns they have:
    a declared column that a file lacks is null there, and columns that are not
    declared are left out. Names are compared stripped and in lower case, after
    ``aliases`` (other name to declared name). A file without any declared
    column is an error. ``malformed`` names a column that receives the line of
    each row that does not parse. Only the header line of each file is read on
    the driver.
    """
    declared = T._parse_datatype_string(schema)
    plain = lambda name: name.strip().lower()
    known = {plain(f.name): f for f in declared}
    known |= {plain(a): known[plain(to)] for a, to in (aliases or {}).items() if plain(to) in known}
    layouts: dict[tuple[str, ...], list[str]] = {}
    for file in spark.read.text(path).inputFiles():
        first = spark.read.text(file).first()
        if first is not None:
            layouts.setdefault(tuple(next(csv.reader([first[0].removeprefix("\ufeff")]))), []).append(file)
    out = [F.col(f"`{f.name}`") for f in declared] + ([F.col(f"`{malformed}`")] if malformed else [])
    extra = [T.StructField(malformed, T.StringType())] if malformed else []
    frames = []
    for header, files in layouts.items():
        if not any(plain(h) in known for h in header):
            raise ValueError(f"no declared column in the header of {files[0]}")
        fields = [
            T.StructField(known[plain(h)].name, known[plain(h)].dataType)
            if plain(h) in known
            else T.StructField(f"_unused_{i}", T.StringType())
            for i, h in enumerate(header)
        ]
        reader = spark.read.schema(T.StructType(fields + extra)).option("header", True)
        if malformed:
            reader = reader.option("columnNameOfCorruptRecord", malformed)
        frames.append(reader.csv(files))
    if not frames:
        return spark.createDataFrame([], T.StructType([*declared, *extra]))
    names = {f.name for f in declared}
    kinds = {f.name: f.dataType for f in declared}

    def completed(frame: DataFrame) -> DataFrame:
        missing = {n: F.lit(None).cast(kinds[n]) for n in names - set(frame.columns)}
        return (frame.withColumns(missing) if missing else frame).select(*out)

    return reduce(DataFrame.unionByName, map(completed, frames))


def read_csv_headerless(
    spark: SparkSession, path: str | list[str], schema: str, keep: Sequence[str], partitions: int | None = None
) -> DataFrame:
    """CSV files without a header, gzip included; ``schema`` lists every file column.

    A gzip file is read by one task. ``partitions`` spreads its rows afterwards.
    """
    rows = spark.read.schema(schema).option("header", False).csv(path).select(*keep)
    return rows.repartition(partitions) if partitions else rows


def read_csv_positional(
    spark: SparkSession, path: str | list[str], types: Sequence[str], names: Sequence[str]
) -> DataFrame:
    """CSV files whose columns are named by position; the first line is data."""
    schema = ", ".join(f"_{i} {kind}" for i, kind in enumerate(types))
    return spark.read.schema(schema).option("header", False).csv(path).toDF(*names)


def read_fixed_width(
    spark: SparkSession, path: str | list[str], fields: Mapping[str, tuple[int, int]]
) -> DataFrame:
    """Text lines cut into stripped string columns at zero-based [start, stop) places."""
    lines = spark.read.text(path)
    return lines.select(
        *[strip(slice_text(F.col("value"), *place)).alias(name) for name, place in fields.items()]
    )
