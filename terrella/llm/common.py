"""What several operators of this subpackage share: settings, tables in the shared folder, batches of rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrella.session import configure, scratch_path

#: Rows of one Arrow batch: texts are long, so that batches stay a few megabytes.
BATCH_ROWS = "1000"


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the library's settings and short Arrow batches."""
    configure(spark)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) != BATCH_ROWS:
        spark.conf.set(key, BATCH_ROWS)
    return spark


def materialize(frame: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and read it back.

    It cuts the lineage, survives lost executors and keeps a table that several
    later steps need from being computed again.
    """
    spark = frame.sparkSession
    path = scratch_path(spark, label)
    frame.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def per_worker(key: tuple, build: Callable[[], object]):
    """An object that a Python worker builds once and keeps for its later tasks."""
    import sys
    import types

    name = "_terrella_per_worker"
    kept = sys.modules.setdefault(name, types.ModuleType(name)).__dict__
    if key not in kept:
        kept[key] = build()
    return kept[key]


def map_batches(
    frame: DataFrame, fn: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    """``mapInArrow`` with a function of one batch."""

    def over(batches):
        for batch in batches:
            if batch.num_rows:
                yield from fn(batch)

    return frame.mapInArrow(over, schema)


def one_of_three(key: str, parts: int) -> Column:
    """crc32 of a column's text modulo ``parts``; null for a null value."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % F.lit(parts)


def words_of(text: str | None) -> list[bytes]:
    """Words between ASCII white space, with A-Z in lower case."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []
