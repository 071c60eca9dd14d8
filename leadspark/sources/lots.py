"""Lots: partitioned lead tables registered in the ledger.

A lot is written as an attempt of its own folder and counts once its row stands in the manifest
beside the lots. Readers take the attempt that was committed first, so rows of a broken run are never
seen and a repeated run adds nothing.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..schemas import VERTICALS
from .ledger import Ledger
from .lead_csv import consolidate, path_exists


#: Committed attempts; the underscore hides the folder from scans of the lots.
MANIFEST = "_manifest"
MANIFEST_SCHEMA = "lote_id string, vertical string, intento string, filas long, ts timestamp"


def stage_lot(leads: DataFrame, root: str, vertical: str, lot_id: str) -> str:
    """Lead rows as a new attempt under ``vertical=/lote_id=/intento=``; returns the attempt."""
    attempt = f"i{uuid.uuid4().hex}"
    tagged = leads.withColumns({"vertical": F.lit(vertical), "lote_id": F.lit(lot_id), "intento": F.lit(attempt)})
    tagged.write.mode("append").partitionBy("vertical", "lote_id", "intento").parquet(root)
    return attempt


def committed_lots(spark: SparkSession, root: str) -> DataFrame:
    """The attempt that counts of every lot: the one committed first."""
    path = f"{root}/{MANIFEST}"
    if not path_exists(spark, path):
        return spark.createDataFrame([], MANIFEST_SCHEMA)
    first = F.min_by(F.struct("vertical", "intento", "filas", "ts"), F.struct("ts", "intento")).alias("m")
    return spark.read.schema(MANIFEST_SCHEMA).parquet(path).groupBy("lote_id").agg(first).select("lote_id", "m.*")


def commit_lot(spark: SparkSession, root: str, vertical: str, lot_id: str, attempt: str, rows: int):
    """Commit an attempt; returns the manifest row that counts, which an earlier commit keeps."""
    row = (lot_id, vertical, attempt, rows, datetime.now(timezone.utc))
    spark.createDataFrame([row], MANIFEST_SCHEMA).coalesce(1).write.mode("append").parquet(f"{root}/{MANIFEST}")
    return committed_lots(spark, root).filter(F.col("lote_id") == lot_id).first()


def save_lot(ledger: Ledger, leads: DataFrame, root: str, vertical: str, lot_id: str | None = None) -> str:
    """Write one lot and register it with its row count.

    The count is observed while writing: the rows are computed once. A run repeated with the same
    ``lot_id`` writes no rows if the lot is committed, and registers it as of its commit; the same
    event twice in the ledger is one. A lot of another vertical under that id is an error.
    """
    lot_id, spark = lot_id or str(uuid.uuid4()), ledger.spark
    done = committed_lots(spark, root).filter(F.col("lote_id") == lot_id).first()
    if done is None:
        seen = Observation()
        attempt = stage_lot(leads.observe(seen, F.count(F.lit(1)).alias("n")), root, vertical, lot_id)
        done = commit_lot(spark, root, vertical, lot_id, attempt, seen.get["n"])
    if done.vertical != vertical:
        raise ValueError(f"lot {lot_id!r} is one of {done.vertical!r}")
    ledger.create_lot(lot_id, vertical, done.ts, done.filas)
    return lot_id


def save_lots(ledger: Ledger, leads: DataFrame, root: str) -> dict[str, str]:
    """One lot for every vertical that ``leads`` has, written by one job; returns lot id by vertical.

    Rows without a vertical are an error, as is a vertical that is not known: their lot could not be found.
    """
    spark, attempt = ledger.spark, f"i{uuid.uuid4().hex}"
    ids = {v: str(uuid.uuid4()) for v in VERTICALS}
    lot_of = F.create_map(*[F.lit(x) for pair in ids.items() for x in pair])
    known = F.coalesce(F.try_element_at(lot_of, F.col("vertical")), F.raise_error(F.concat(F.lit("no such vertical: "), F.coalesce("vertical", F.lit("NULL")))))
    tagged, seen = leads.withColumns({"lote_id": known, "intento": F.lit(attempt)}), Observation()
    counters = [F.count_if(F.col("vertical") == v).alias(v) for v in VERTICALS]
    tagged.observe(seen, *counters).write.mode("append").partitionBy("vertical", "lote_id", "intento").parquet(root)
    counts = {v: n for v, n in seen.get.items() if n}
    at = datetime.now(timezone.utc)
    rows = [(ids[v], v, attempt, n, at) for v, n in counts.items()]
    if rows:
        spark.createDataFrame(rows, MANIFEST_SCHEMA).coalesce(1).write.mode("append").parquet(f"{root}/{MANIFEST}")
        ledger.append("lots", *[(ids[v], v, at, "pendiente", n, None) for v, n in counts.items()])
    return {v: ids[v] for v in counts}


def read_lots(spark: SparkSession, root: str, lots: DataFrame) -> DataFrame:
    """Lead rows of the given ledger lots; only the partitions of their committed attempts are scanned."""
    wanted = committed_lots(spark, root).join(lots.select("vertical", "lote_id"), ["vertical", "lote_id"], "left_semi")
    rows = spark.read.option("basePath", root).parquet(root)
    return rows.join(wanted.select("vertical", "lote_id", "intento"), ["vertical", "lote_id", "intento"], "left_semi").drop("intento")


def open_lots(lots: DataFrame) -> DataFrame:
    """Lots that belong in a consolidation: neither uploaded nor discarded."""
    return lots.filter(F.col("estado").isin("pendiente", "consolidado"))


def consolidated(spark: SparkSession, root: str, lots: DataFrame, vertical: str) -> DataFrame:
    """The export table of a vertical. Reading it changes no lot state."""
    from .lead_csv import export_row
    from ..schemas import CSV_SCHEMA

    if committed_lots(spark, root).filter("filas > 0").isEmpty():
        return spark.createDataFrame([], CSV_SCHEMA)
    rows = read_lots(spark, root, open_lots(lots.filter(F.col("vertical") == vertical)))
    return consolidate([export_row(rows)])
