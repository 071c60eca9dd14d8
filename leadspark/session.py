"""Session settings and the checkpoint folder shared by iterative operators."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_STATE_STORE = "spark.sql.streaming.stateStore."
#: State of streams on disk; a batch uploads its changes, not the whole state.
STATE_STORE_CONF = {
    f"{_STATE_STORE}providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{_STATE_STORE}rocksdb.changelogCheckpointing.enabled": "true",
}

#: Settings the operators are written for. AQE splits skewed join partitions
#: and picks the number of reducers; UTC keeps every time text comparable.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    **STATE_STORE_CONF,
}


#: Temporary folder of a local session without ``spark.checkpoint.dir``.
_local_fallback: list[str] = []


def build_session(app_name: str = "leadspark", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def state_store(spark: SparkSession) -> Iterator[None]:
    """Streams started inside use the store on disk, whatever the session was built with; its settings stay."""
    before = {key: spark.conf.get(key, None) for key in STATE_STORE_CONF}
    for key, value in STATE_STORE_CONF.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared scratch folder: ``spark.checkpoint.dir``.

    Only a ``local`` master without that setting falls back to a temporary
    folder; on a cluster a missing setting is an error, because a folder on
    one machine is lost with it.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if not _local_fallback:
        _local_fallback.append(tempfile.mkdtemp(prefix="spark-"))
    return _local_fallback[0]


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (survives executor loss) of an iteration's state."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(os.path.join(shared_dir(df.sparkSession), "rdd"))
    return df.checkpoint(eager=True)
