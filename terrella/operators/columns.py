"""Projections and filters."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def normalize_names(df: DataFrame, aliases: Mapping[str, str] | None = None) -> DataFrame:
    """Strip and lower-case column names, then map aliases to their common name."""
    aliases = aliases or {}
    cleaned = [name.strip().lower() for name in df.columns]
    return df.toDF(*[aliases.get(name, name) for name in cleaned])


def keep_columns(df: DataFrame, allowed: Iterable[str]) -> DataFrame:
    """Keep the allowed columns that exist, in table order."""
    allowed = set(allowed)
    return df.select(*[c for c in df.columns if c in allowed])


def drop_types(df: DataFrame, *types: type[T.DataType]) -> DataFrame:
    return df.select(*[f.name for f in df.schema if not isinstance(f.dataType, types)])


def downcast_numeric(df: DataFrame) -> DataFrame:
    """64-bit integers and floats to 32 bits; integers that do not fit become null."""

    def narrow(field: T.StructField) -> Column:
        column = F.col(field.name)
        if isinstance(field.dataType, T.LongType):
            column = column.try_cast("int")
        elif isinstance(field.dataType, T.DoubleType):
            column = column.cast("float")
        return column.alias(field.name)

    return df.select(*[narrow(f) for f in df.schema])


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast the named columns; text that does not parse becomes null."""
    return df.withColumns({name: F.col(name).try_cast(kind) for name, kind in types.items()})


def fill_sentinel(df: DataFrame, value: int = -1) -> DataFrame:
    """Replace null and NaN with a sentinel; in a timestamp it counts milliseconds."""

    def filled(field: T.StructField) -> Column:
        column = F.col(field.name)
        if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
            present = F.nanvl(column, F.lit(None).cast(field.dataType))
            return F.coalesce(present, F.lit(value).cast(field.dataType))
        if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            moment = F.timestamp_millis(F.lit(value)).cast(field.dataType)
            return F.coalesce(column, moment)
        if isinstance(field.dataType, T.NumericType):
            return F.coalesce(column, F.lit(value).cast(field.dataType))
        return column

    return df.select(*[filled(f).alias(f.name) for f in df.schema])


def filter_all(df: DataFrame, rules: Sequence[str]) -> DataFrame:
    """Keep the rows that satisfy every SQL predicate."""
    return df.filter(" AND ".join(f"({rule})" for rule in rules))


def with_literals(df: DataFrame, **values) -> DataFrame:
    return df.withColumns({name: F.lit(value) for name, value in values.items()})


def tenths_mm_to_inches(value: Column) -> Column:
    """Rain depth, given in tenths of a millimetre, as inches."""
    return value * 1 / 10 * 0.0393701


def feature_names(df: DataFrame, label: str) -> list[str]:
    """All columns but the label, in name order."""
    return sorted(set(df.columns) - {label})


def split_features_label(df: DataFrame, label: str) -> tuple[DataFrame, DataFrame]:
    """The feature columns in name order, and the label column."""
    return df.select(*feature_names(df, label)), df.select(label)


def assemble(df: DataFrame, names: Sequence[str], out: str = "features") -> DataFrame:
    """Gather numeric columns into the vector column the learners read."""
    return VectorAssembler(inputCols=list(names), outputCol=out).transform(df)


def elementwise_chain(df: DataFrame, steps: Sequence[tuple[str, str]]) -> DataFrame:
    """Apply (name, expression) assignments in order; later ones see earlier ones."""
    for name, expression in steps:
        df = df.withColumn(name, F.expr(expression))
    return df


def array_to_columns(df: DataFrame, array: str, names: Sequence[str]) -> DataFrame:
    """The elements of an array as named columns, in place of the array.

    A null array gives null columns; one of another length than ``names`` is an error.
    """
    rest = [c for c in df.columns if c != array]
    fits = F.col(array).isNull() | (F.size(array) == len(names))
    wrong = F.raise_error(F.concat(F.lit(f"{len(names)} elements of {array} wanted, found "), F.size(array)))
    whole = F.when(fits, F.col(array)).otherwise(wrong)
    return df.select(*rest, whole.alias(array)).select(
        *rest, *[F.get(F.col(array), i).alias(n) for i, n in enumerate(names)]
    )


def count_matches(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """One row with the number of rows that satisfy each rule, in a single pass."""
    return df.agg(*[F.count_if(F.expr(rule)).alias(name) for name, rule in rules.items()])


def preview_matches(df: DataFrame, rule: str, order: Sequence[str], n: int = 5) -> DataFrame:
    """The first ``n`` rows, by ``order``, that satisfy a rule."""
    return df.filter(rule).orderBy(*order).limit(n)
