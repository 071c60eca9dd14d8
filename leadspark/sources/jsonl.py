"""Extraction log (JSON lines) and the inferred source CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import EXTRACTION_SCHEMA
from .csv_records import read_csv_rows
from .lead_csv import path_exists

CORRUPT = "_corrupt"


def read_log(spark: SparkSession, path: str, schema: T.StructType = EXTRACTION_SCHEMA) -> DataFrame:
    """Tolerant scan: bad lines come back with the line in ``_corrupt``; blank lines vanish."""
    full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    if not path_exists(spark, path):
        return spark.createDataFrame([], full)
    return spark.read.schema(full).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).json(path)


def parse_log(lines: DataFrame, column: str = "value", schema: T.StructType = EXTRACTION_SCHEMA) -> DataFrame:
    """The same for lines that are already a text column (other columns are kept)."""
    full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_json(F.col(column), full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    rest = [c for c in lines.columns if c != column]
    return lines.filter(F.trim(column) != "").select(*rest, parsed.alias("r")).select(*rest, "r.*")


def good_rows(log: DataFrame) -> DataFrame:
    return log.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)


def corrupt_rows(log: DataFrame) -> DataFrame:
    return log.filter(F.col(CORRUPT).isNotNull()).select(CORRUPT)


def read_log_strict(spark: SparkSession, path: str, schema: T.StructType = EXTRACTION_SCHEMA) -> DataFrame:
    """Strict scan: a bad line fails the job."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def append_log(df: DataFrame, path: str) -> None:
    """One JSON record per row in new files; earlier files stay."""
    df.write.mode("append").option("ignoreNullFields", "true").json(path)


def processed_ids(log: DataFrame, id_col: str = "barrio_id") -> DataFrame:
    return log.filter(F.col(id_col).isNotNull()).select(id_col).distinct()


def read_source_csv(spark: SparkSession, path: str, id_col: str | None = None) -> DataFrame:
    """Source table with inferred types; ``row_id`` is the declared key or the row position (from 0, as text).

    Positions follow the paths of the files and the lines in them, so they are the same in every run; one
    file is read by several tasks.
    """
    return read_csv_rows(spark, path, id_col=id_col, infer=True)
