"""Incremental extraction and failure streaks as streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.crawlplan import FAILURE_LIMIT, failure_streaks
from ..operators.grouping import order_bucket
from ..operators.enrich import extraction_records
from ..sources.lead_csv import path_exists


def page_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", files_per_trigger: int = 1000) -> DataFrame:
    return spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", files_per_trigger).load(path)


def incremental_extraction(pages: DataFrame, out: str, checkpoint: str, fmt: str = "parquet") -> StreamingQuery:
    """Records of pages ``(id, nombre, url, text)`` not seen before, each batch durable.

    The checkpoint remembers the files read and, in its state store, the ids seen (not the pages). With
    the store of ``build_session`` a batch looks up its own ids only, whatever has been written
    before. It is written under its number with overwrite: a repeated batch replaces itself, and a
    page delivered twice is extracted once. Pages without an id count as one page.
    """
    def extract(batch: DataFrame, batch_id: int) -> None:
        extraction_records(batch).write.mode("overwrite").format(fmt).save(f"{out}/batch={batch_id}")

    return pages.dropDuplicates(["id"]).writeStream.foreachBatch(extract).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def streak_stream(attempts: DataFrame, out: str, state: str, checkpoint: str, limit: int = FAILURE_LIMIT) -> StreamingQuery:
    """Running failure streak per source of a stream ``(source, ts, fail)``.

    Every micro-batch runs the batch operator, which spreads a hot source over
    time buckets, and adds the streak carried over to the rows before the
    source's first success. Output and state are written per batch id with
    overwrite, so a repeated batch replaces itself. Attempts of later batches
    must be later in ``ts``.
    """
    def advance(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = failure_streaks(batch, "source", ["ts"], "fail", order_bucket(batch, "ts"), limit)
        first_ok = batch.filter(~F.col("fail")).groupBy("source").agg(F.min("ts").alias("__ok"))
        before = f"{state}/batch={batch_id - 1}"
        if batch_id > 0 and path_exists(spark, before):
            carried = spark.read.parquet(before)
        else:
            carried = rows.select("source", F.col("streak").alias("carry")).limit(0)
        total = F.col("streak") + F.when(
            F.col("__ok").isNull() | (F.col("ts") < F.col("__ok")), F.coalesce("carry", F.lit(0))).otherwise(0)
        joined = rows.join(first_ok, "source", "left").join(carried, "source", "left")
        result = joined.select("source", "ts", total.alias("streak"), (total >= limit).alias("open"))
        result.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
        done = spark.read.parquet(f"{out}/batch={batch_id}")
        latest = done.groupBy("source").agg(F.max_by("streak", "ts").alias("carry"))
        idle = carried.join(latest.select("source"), "source", "left_anti")
        latest.unionByName(idle).write.mode("overwrite").parquet(f"{state}/batch={batch_id}")

    return attempts.writeStream.foreachBatch(advance).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
