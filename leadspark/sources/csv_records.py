"""CSV records with stable row numbers, read in splits also where quoted fields hold line breaks.

The files are scanned as lines. Whether a line begins inside a quoted field follows from the number of quote
characters before it, which is added up inside a split and then over the splits of a file (two numbers a
split), so no task reads a whole file and the row numbers are the same in every run.
"""

from __future__ import annotations

import csv

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from .lead_csv import path_exists

_PLACE = ["__file", "__split"]
_OPTIONS = {"quote": '"', "escape": '"'}


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with file, split, order in the split and whether they begin and end inside a quoted field."""
    scan = spark.read.option("lineSep", "\n").text(path).select(
        F.regexp_replace("value", "^\ufeff", "").alias("line"), F.col("_metadata.file_path").alias("__file"),
        F.col("_metadata.file_block_start").alias("__split"), F.monotonically_increasing_id().alias("__at"))
    lines = scan.withColumn("__quotes", F.length("line") - F.length(F.replace("line", F.lit('"'), F.lit(""))))
    splits = lines.groupBy(*_PLACE).agg(F.sum("__quotes").alias("__in"))
    earlier = W.partitionBy("__file").orderBy("__split").rowsBetween(W.unboundedPreceding, -1)
    splits = splits.select(*_PLACE, F.coalesce(F.sum("__in").over(earlier), F.lit(0)).alias("__before"))
    inside = W.partitionBy(*_PLACE).orderBy("__at").rowsBetween(W.unboundedPreceding, 0)
    total = F.col("__before") + F.sum("__quotes").over(inside)
    return lines.join(splits, _PLACE).withColumn("__total", total).withColumns({
        "__open": (F.col("__total") - F.col("__quotes")) % 2 == 1, "__opens": F.col("__total") % 2 == 1,
    }).drop("__before", "__total", "__quotes")


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """``(file_path, record_no, record)``: the text of every record, numbered from 0 in its file.

    Blank lines between records count for nothing. Only records over several lines are put together by
    grouping; one line is a record as it is. A file whose last field is never closed ends in one record.
    """
    # A blank line outside quotes is no record.
    lines = _lines(spark, path).filter(F.col("__open") | (F.trim(F.regexp_replace("line", "\r$", "")) != ""))
    starts = F.when(~F.col("__open"), 1).otherwise(0)
    counts = lines.groupBy(*_PLACE).agg(F.sum(starts).alias("__n"))
    earlier = W.partitionBy("__file").orderBy("__split").rowsBetween(W.unboundedPreceding, -1)
    counts = counts.select(*_PLACE, F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"))
    inside = W.partitionBy(*_PLACE).orderBy("__at").rowsBetween(W.unboundedPreceding, 0)
    placed = lines.withColumn("__n", F.sum(starts).over(inside)).join(counts, _PLACE).select(
        F.col("__file").alias("file_path"), (F.col("__before") + F.col("__n") - 1).alias("record_no"),
        "line", "__split", "__at", "__open", "__opens")
    single = placed.filter(~F.col("__open") & ~F.col("__opens")).select("file_path", "record_no", F.col("line").alias("record"))
    pieces = placed.filter(F.col("__open") | F.col("__opens")).groupBy("file_path", "record_no").agg(
        F.array_sort(F.collect_list(F.struct("__split", "__at", "line"))).alias("p"))
    several = pieces.select("file_path", "record_no", F.array_join("p.line", "\n").alias("record"))
    return single.unionByName(several).withColumn("record", F.regexp_replace("record", "\r$", ""))


def inferred_schema(rows: DataFrame) -> T.StructType:
    """Types that every value of a text column fits: whole number, number, truth value, else text; text without a value."""
    kinds = ["bigint", "double", "boolean"]
    names = rows.columns
    fits = [F.count_if(F.col(f"`{n}`").try_cast(k).isNotNull()).alias(f"{i}_{k}") for i, n in enumerate(names) for k in kinds]
    seen = rows.agg(*[F.count(f"`{n}`").alias(f"{i}_all") for i, n in enumerate(names)], *fits).first()
    fields = []
    for i, name in enumerate(names):
        kind = next((k for k in kinds if seen[f"{i}_all"] and seen[f"{i}_{k}"] == seen[f"{i}_all"]), "string")
        fields.append(f"`{name}` {kind}")
    return T.StructType.fromDDL(", ".join(fields))


def read_csv_rows(spark: SparkSession, path: str, schema: T.StructType | str | None = None, id_col: str | None = None,
                  infer: bool = False) -> DataFrame:
    """Rows of CSV files with a header, and ``row_id`` (text): the ``id_col``, or the row's position from 0.

    Positions run through the files in the order of their paths. Columns are text unless a ``schema`` of the
    file's columns is given or types are to be inferred (one more pass); every file must have the header of the first one. A column named
    ``row_id`` in the file is replaced. Files without a row give an empty table; a path that is not there, one without columns but the id.
    """
    if not path_exists(spark, path):
        return spark.createDataFrame([], "row_id string")
    records = csv_records(spark, path)
    headers = records.filter("record_no = 0").select("record").distinct().limit(2).collect()
    if not headers:
        return spark.createDataFrame([], "row_id string")
    if len(headers) > 1:
        raise ValueError(f"files of {path} have different headers")
    if schema is None:
        names = next(csv.reader([headers[0].record]))
        schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    elif isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    if infer:
        texts = F.from_csv("record", ", ".join(f"`{n}` string" for n in schema.names), _OPTIONS)
        schema = inferred_schema(records.filter("record_no > 0").select(texts.alias("r")).select("r.*"))
    parsed = F.from_csv("record", ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema), _OPTIONS)
    body = records.filter("record_no > 0").select("file_path", "record_no", parsed.alias("r"))
    kept = [F.col("r")[n].alias(n) for n in schema.names if n != "row_id"]
    if id_col:
        return body.select(*kept, F.col("r")[id_col].cast("string").alias("row_id"))
    # One number a file, and the driver lists the files anyway.
    sizes = body.groupBy("file_path").agg(F.max("record_no").alias("__n"))
    earlier = W.orderBy("file_path").rowsBetween(W.unboundedPreceding, -1)
    sizes = sizes.select("file_path", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__offset"))
    return body.join(sizes, "file_path").select(*kept, (F.col("__offset") + F.col("record_no") - 1).cast("string").alias("row_id"))
