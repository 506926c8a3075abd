"""Session helpers.

The library never creates a session on its own inside an operator; these helpers
are for scripts, tests and the bench.  On a cluster the session (and its
``spark.checkpoint.dir``) comes from the cluster configuration: we only read it.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on for exact results (not tuning knobs).
_SEMANTIC_CONF = {
    # epoch-ms formatting and the oracle comparison are both defined in UTC
    "spark.sql.session.timeZone": "UTC",
}

_LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.driver.memory": "8g",
}


def local_session(cpus: int | str = 8, shuffle_partitions: int | None = None,
                  app_name: str = "annolink") -> SparkSession:
    """A local session for tests and the bench (never used by operators)."""
    if shuffle_partitions is None:
        shuffle_partitions = int(cpus) if str(cpus).isdigit() else 8
    parts = shuffle_partitions
    builder = (SparkSession.builder.master(f"local[{cpus}]").appName(app_name)
               .config("spark.sql.shuffle.partitions", str(parts)))
    for k, v in {**_LOCAL_CONF, **_SEMANTIC_CONF}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_semantic_conf(spark)
    ensure_checkpoint_dir(spark)
    return spark


def apply_semantic_conf(spark: SparkSession) -> None:
    for k, v in _SEMANTIC_CONF.items():
        spark.conf.set(k, v)


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder the cluster names, if any."""
    value = spark.conf.get("spark.checkpoint.dir", None)
    if value:
        return value
    return spark.sparkContext.getCheckpointDir()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder from ``spark.checkpoint.dir`` or ``setCheckpointDir``.
    Without either, a local master (tests) gets a fresh folder; a cluster raises."""
    value = checkpoint_dir(spark)
    if not value:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        value = tempfile.mkdtemp(prefix="annolink-ckpt-")
        spark.conf.set("spark.checkpoint.dir", value)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(value)
    return value


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub folder of the shared checkpoint folder for streaming checkpoints and
    written intermediate tables (visible to every executor on a cluster)."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, name)
