"""What the operators of this subpackage share: reading tables, Arrow-batched maps, cutting lineage."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ..sources.shared import materialize

ROOT = str(Path(__file__).resolve().parents[2])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the data set; the Python workers get this repository on their path."""
    env = spark.sparkContext.environment
    if ROOT not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, env.get("PYTHONPATH", "")]))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


cut = materialize  # cuts lineage with a table in the shared folder


#: Rows that a map holds as Python objects at once.
SLICE = 1000


def map_rows(df: DataFrame, schema: str, fn: Callable[..., Iterator[tuple]]) -> DataFrame:
    """mapInArrow with Python tuples: fn gets the columns of up to `SLICE` rows as lists and yields result rows.

    One Arrow batch and one slice of it as Python objects are in memory at a time; results leave in pieces of
    10,000 rows.
    """
    spark = df.sparkSession
    fields = spark.createDataFrame([], schema).schema
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(fields)

    def pack(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) if rows else [()] * len(arrow)
        return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    def run(batches):
        for batch in batches:
            rows = []
            for at in range(0, batch.num_rows, SLICE):
                for row in fn(*(c.to_pylist() for c in batch.slice(at, SLICE).columns)):
                    rows.append(row)
                    if len(rows) >= 10_000:
                        yield pack(rows)
                        rows = []
            if rows:
                yield pack(rows)

    return df.mapInArrow(run, fields)


def map_columns(df: DataFrame, schema: str, fn: Callable[..., list[list]]) -> DataFrame:
    """mapInArrow where fn gets a batch's columns as lists and returns whole result columns (lists or Arrow arrays)."""
    from pyspark.sql.pandas.types import to_arrow_schema

    fields = df.sparkSession.createDataFrame([], schema).schema
    arrow = to_arrow_schema(fields)

    def run(batches):
        for batch in batches:
            columns = fn(*(c.to_pylist() for c in batch.columns))
            yield pa.RecordBatch.from_arrays([c.cast(f.type) if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    return df.mapInArrow(run, fields)
