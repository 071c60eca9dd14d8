"""Helpers shared by the operators: exact column picks, written tables, Arrow batches."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import shared_dir

#: Rows of an Arrow batch that a task turns into Python objects at a time.
SLICE_ROWS = 1000


def position(names: list[str], name: str) -> int:
    """Place of a column: an exact spelling wins over one in another case, the first over later ones."""
    at = [i for i, n in enumerate(names) if n == name] or [i for i, n in enumerate(names) if n.lower() == name.lower()]
    if not at:
        raise ValueError(f"no column {name!r} among {names}")
    return at[0]


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """The given columns only, as ``new=old`` (see ``position``); further columns may have any names, also the same ones."""
    names = df.columns
    flat = df.toDF(*[f"c{i}" for i in range(len(names))])
    return flat.select(*[F.col(f"c{position(names, old)}").alias(new) for new, old in columns.items()])


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder in the shared folder of the cluster."""
    return f"{shared_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows, written once to the shared folder and read back: later steps neither repeat
    the work nor depend on the executors that did it."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def map_batches(df: DataFrame, start: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]], schema: str | StructType, rows: int = SLICE_ROWS) -> DataFrame:
    """``start()`` once a task, its result on every slice of at most ``rows`` rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = None
        for batch in batches:
            step = step or start()
            for at in range(0, batch.num_rows, rows):
                out = step(batch.slice(at, rows))
                if out.num_rows:
                    yield out

    return df.mapInArrow(run, schema)


def documents(spark: SparkSession, folder: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
