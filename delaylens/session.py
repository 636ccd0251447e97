"""Session helpers: a tuned local session for tests/bench and a shared
checkpoint folder taken from the cluster configuration."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  driver_memory: str = "8g", extra: dict | None = None) -> SparkSession:
    """Session for tests and the local bench. On a cluster, build the
    session from the cluster's own defaults instead."""
    b = (SparkSession.builder.master(f"local[{cores}]").appName("delaylens")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", driver_memory))
    for k, v in {**DEFAULT_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


#: input bytes that ask for one shuffle partition before adaptive execution merges small ones
INPUT_BYTES = 2 << 20
#: shuffled bytes of a merged partition at most: rows grow to many times that when sorted
SHUFFLED_BYTES = 8 << 20


def _bytes(text: str) -> int:
    number, unit = re.fullmatch(r"\s*(\d+)\s*([a-z]*)\s*", text.lower()).groups()
    return int(number) << {"": 0, "k": 10, "m": 20, "g": 30, "t": 40, "p": 50}[unit.rstrip("b").rstrip("i")]


def spread_shuffles(spark: SparkSession, input_bytes: int) -> None:
    """Let the number of shuffle partitions follow the input, so that what a task sorts
    or aggregates stays as large when the input grows. Adaptive execution merges the
    partitions again that turn out small; nothing changes where it is off."""
    first, size = "spark.sql.adaptive.coalescePartitions.initialPartitionNum", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    parts = -(-input_bytes // INPUT_BYTES)
    if parts <= shuffle_parts(spark):
        return
    spark.conf.set(first, str(parts))
    if _bytes(spark.conf.get(size)) > SHUFFLED_BYTES:
        spark.conf.set(size, str(SHUFFLED_BYTES))


def shuffle_parts(spark: SparkSession) -> int:
    """Partitions that a shuffle starts with."""
    first = spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(first or 0))


def app_key(spark: SparkSession) -> str:
    """Identity of the running application (for per-application reuse of
    readers and model runs)."""
    try:
        return spark.sparkContext.applicationId
    except Exception:  # noqa: BLE001 - sessions without a SparkContext handle
        return spark.conf.get("spark.app.id", None) or str(id(spark))


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster that setting points at shared storage and is used as is.
    Only when it is unset in a local session (tests) is a scratch folder
    created; on a cluster each executor would write to a disk of its own, so
    an unset folder raises there."""
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001
        sc = None
    d = sc.getCheckpointDir() if sc is not None else None
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        master = sc.master if sc is not None else spark.conf.get("spark.master", "")
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="delaylens-ckpt-")
        atexit.register(shutil.rmtree, d, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", d)
    if sc is None:
        return d
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory for written
    stage outputs (CSV hand-overs, lineage cuts)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df, name: str):
    """Write ``df`` as parquet under the shared checkpoint folder and read
    it back: cuts the lineage before repeated passes (model fits), and a
    lost executor then re-reads files instead of recomputing joins."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
