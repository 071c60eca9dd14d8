"""Append-only ledger of verticals, lots and runs, and the questions asked of it."""

from __future__ import annotations

import math
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import _col
from ..operators.grouping import first_per_group, sorted_positions
from ..schemas import (
    BASE_VERTICAL, DISPLAY_NAMES, LOT_EVENT_SCHEMA, RUN_EVENT_SCHEMA, VERTICAL_EVENT_SCHEMA, VERTICALS,
)
from .lead_csv import path_exists

_TABLES = {"verticals": VERTICAL_EVENT_SCHEMA, "lots": LOT_EVENT_SCHEMA, "runs": RUN_EVENT_SCHEMA}
#: Small event files of a table beyond which an append merges them.
COMPACT_AFTER = 64
#: Bytes of a merged file; one of half of it is not small any more.
FILE_BYTES = 128 << 20


class Ledger:
    """Event tables under one folder; every change is an append.

    Appends merge small files, so their number is bounded. An event that stands there twice is one
    to every view below: a merge broken between writing and deleting changes no answer, and the next
    one drops the copies. A table read before a merge is to be read anew after it.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def events(self, table: str) -> DataFrame:
        path = f"{self.root}/{table}"
        if not path_exists(self.spark, path):
            return self.spark.createDataFrame([], _TABLES[table])
        return self.spark.read.schema(_TABLES[table]).parquet(path)

    def append(self, table: str, *rows: tuple) -> None:
        self.append_frame(table, self.spark.createDataFrame(list(rows), _TABLES[table]).coalesce(1))

    def append_frame(self, table: str, df: DataFrame) -> None:
        df.select(*_TABLES[table].names).write.mode("append").parquet(f"{self.root}/{table}")
        if len(self._small_files(table)) > COMPACT_AFTER:
            self.compact(table)

    def _small_files(self, table: str) -> list:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{table}")
        listed = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).listStatus(path)
        return [f for f in listed if f.getPath().getName().endswith(".parquet") and 2 * f.getLen() < FILE_BYTES]

    def compact(self, table: str) -> None:
        """Merge the small event files of a table."""
        old = self._small_files(table)
        if len(old) < 2:
            return
        parts = math.ceil(sum(f.getLen() for f in old) / FILE_BYTES)
        rows = self.spark.read.schema(_TABLES[table]).parquet(*[f.getPath().toString() for f in old]).distinct()
        rows.repartition(parts).write.mode("append").parquet(f"{self.root}/{table}")
        for f in old:
            f.getPath().getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(f.getPath(), False)

    # -- verticals
    def activate(self, vertical: str, ts: datetime, prompt_path: str = "", schema_path: str = "") -> None:
        if vertical not in VERTICALS:
            raise ValueError(f"unknown vertical {vertical!r}")
        self.append("verticals", (vertical, "activar", ts, prompt_path, schema_path))

    def deactivate(self, vertical: str, ts: datetime) -> None:
        if vertical == BASE_VERTICAL:
            raise ValueError("the base vertical stays active")
        self.append("verticals", (vertical, "desactivar", ts, None, None))

    def active(self) -> DataFrame:
        return active_verticals(self.events("verticals"))

    # -- lots
    def create_lot(self, lot_id: str, vertical: str, ts: datetime, leads: int = 0) -> None:
        self.append("lots", (lot_id, vertical, ts, "pendiente", leads, None))

    def update_lot(self, lot_id: str, state: str, ts: datetime, leads: int | None = None,
                   uploaded: datetime | None = None) -> None:
        self.append("lots", (lot_id, None, ts, state, leads, uploaded))

    def lots(self) -> DataFrame:
        return lot_states(self.events("lots"))

    # -- runs
    def start_run(self, run_id: str, vertical: str, ts: datetime) -> None:
        self.append("runs", (run_id, vertical, "inicio", ts, None, None, None, None, None))

    def finish_run(self, run_id: str, ts: datetime, discovered=0, scraped=0, enriched=0, validated=0, errors=0) -> None:
        self.append("runs", (run_id, None, "fin", ts, discovered, scraped, enriched, validated, errors))

    def runs(self) -> DataFrame:
        return run_states(self.events("runs"))


# ---------------------------------------------------------------- views


def active_verticals(events: DataFrame, with_default: bool = True) -> DataFrame:
    """Active verticals: first activation since the last deactivation, newest paths.

    The base vertical is there even before any event.
    """
    off = events.filter("accion = 'desactivar'").groupBy("vertical").agg(F.max("ts").alias("off_ts"))
    live = events.filter("accion = 'activar'").join(off, "vertical", "left").filter("off_ts is null or ts > off_ts")
    view = live.groupBy("vertical").agg(
        F.min("ts").alias("activado_en"),
        F.max_by("prompt_path", "ts").alias("prompt_path"),
        F.max_by("schema_path", "ts").alias("schema_path"),
    )
    if not with_default:
        return view
    base = events.sparkSession.createDataFrame(
        [(BASE_VERTICAL, None, "", "")], "vertical string, activado_en timestamp, prompt_path string, schema_path string"
    )
    return view.unionByName(base.join(view.select("vertical"), "vertical", "left_anti"))


def list_active(events: DataFrame) -> DataFrame:
    return active_verticals(events).orderBy("activado_en", "vertical")


def inactive_verticals(active: DataFrame, dimension: DataFrame) -> DataFrame:
    return dimension.join(active.select("vertical"), "vertical", "left_anti")


def is_active(active: DataFrame, vertical: str) -> DataFrame:
    """One row ``active`` true/false."""
    return active.agg(F.coalesce(F.max(F.col("vertical") == vertical), F.lit(False)).alias("active"))


def are_active(verticals: DataFrame, active: DataFrame) -> DataFrame:
    """``verticals`` with the column ``active``."""
    marked = active.select("vertical", F.lit(True).alias("active"))
    return verticals.join(marked, "vertical", "left").withColumn("active", F.coalesce("active", F.lit(False)))


def lot_states(events: DataFrame) -> DataFrame:
    """Latest state of every lot; a NULL in an event keeps the older value."""
    def newest(name: str):
        return F.max_by(F.when(F.col(name).isNotNull(), F.col(name)), F.when(F.col(name).isNotNull(), F.col("ts"))).alias(name)

    return events.groupBy("lote_id").agg(
        newest("vertical"), F.min("ts").alias("creado_en"), newest("estado"),
        F.coalesce(newest("leads_count"), F.lit(0)).alias("leads_count"), newest("subido_en"),
    )


def filter_lots(lots: DataFrame, vertical: str | None = None, state: str | None = None) -> DataFrame:
    """Lots by optional vertical and state, newest first."""
    if vertical:
        lots = lots.filter(F.col("vertical") == vertical)
    if state:
        lots = lots.filter(F.col("estado") == state)
    return lots.orderBy(F.desc("creado_en"), "lote_id")


def newest_first(lots: DataFrame, name: str = "n") -> DataFrame:
    """Lots with their place in the listing of ``filter_lots``."""
    return sorted_positions(lots, [F.desc("creado_en"), F.asc("lote_id")], name)


def pending_lots(lots: DataFrame, vertical: str | None = None) -> DataFrame:
    return filter_lots(lots, vertical, "pendiente")


def pending_leads(lots: DataFrame) -> DataFrame:
    """Pending lots and their leads per vertical; verticals without any give 0."""
    pending = F.col("estado") == "pendiente"
    return lots.groupBy("vertical").agg(
        F.count_if(pending).alias("lotes"),
        F.coalesce(F.sum(F.when(pending, F.col("leads_count"))), F.lit(0)).alias("leads"),
    )


def lot_summary(lots: DataFrame) -> DataFrame:
    """Lots by state per vertical; discarded ones are not in the total."""
    def n(state: str):
        return F.count_if(F.col("estado") == state)

    return lots.groupBy("vertical").agg(
        n("pendiente").alias("pendientes"), n("consolidado").alias("consolidados"), n("subido").alias("subidos"),
        F.count_if(F.col("estado").isin("pendiente", "consolidado", "subido")).alias("total"),
    )


def lot_totals(lots: DataFrame) -> DataFrame:
    """Lots and leads per vertical, and overall on the row with NULL vertical."""
    return lots.rollup("vertical").agg(
        F.count(F.lit(1)).alias("lotes"), F.coalesce(F.sum("leads_count"), F.lit(0)).alias("leads")
    )


def status_table(active: DataFrame, lots: DataFrame) -> DataFrame:
    """Active verticals with pending lots and leads, 0 when none."""
    return active.join(pending_leads(lots), "vertical", "left").select(
        "vertical", "activado_en", F.coalesce("lotes", F.lit(0)).alias("lotes"), F.coalesce("leads", F.lit(0)).alias("leads")
    )


def run_states(events: DataFrame) -> DataFrame:
    """Runs: start joined with the (last) finish; unfinished ones have no ``fin`` and zeros."""
    start = events.filter("tipo = 'inicio'").groupBy("run_id").agg(
        F.min_by("vertical", "ts").alias("vertical"), F.min("ts").alias("inicio"))
    metrics = ["discovered", "scraped", "enriched", "validated", "errors"]
    end = events.filter("tipo = 'fin'").groupBy("run_id").agg(
        F.max("ts").alias("fin"), *[F.max_by(m, "ts").alias(m) for m in metrics])
    return start.join(end, "run_id", "left").select(
        "run_id", "vertical", "inicio", "fin", *[F.coalesce(m, F.lit(0)).alias(m) for m in metrics])


def latest_runs(runs: DataFrame) -> DataFrame:
    """Last started run of each vertical."""
    return first_per_group(runs, ["vertical"], ["inicio", "run_id"], last=True)


def short_ids(df: DataFrame, id_col: str, time_col: str) -> DataFrame:
    """Ledger rows for display: 8-character id, minute-precise time."""
    return df.withColumn(id_col, F.substring(_col(id_col).cast("string"), 1, 8)).withColumn(
        time_col, F.date_format(time_col, "yyyy-MM-dd HH:mm"))


def display_name(vertical) -> "F.Column":
    names = F.create_map(*[F.lit(x) for kv in DISPLAY_NAMES.items() for x in kv])
    return F.coalesce(F.try_element_at(names, _col(vertical)), _col(vertical))
