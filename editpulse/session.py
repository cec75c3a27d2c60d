"""Session helpers for tests, the bench and command-line runs.

Library functions never build or reconfigure a session; they take the
caller's.  ``scratch_dir`` resolves the shared folder for checkpoints and
intermediate tables from ``spark.checkpoint.dir`` and only invents a local
one when the setting is unset (tests, single-machine runs).
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Local session configured like the tests and the bench."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("editpulse")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _configured_checkpoint_dir(spark: SparkSession) -> str | None:
    value = None
    try:
        value = spark.conf.get("spark.checkpoint.dir", None)
    except Exception:  # pragma: no cover - conf access differs per mode
        value = None
    if not value:
        try:
            value = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
        except Exception:  # pragma: no cover
            value = None
    return value or None


def checkpoint_root(spark: SparkSession) -> str:
    """The shared scratch root named by ``spark.checkpoint.dir``.

    When the setting is unset on a local master (tests, a laptop) a fresh local
    directory is created and registered on the context, so
    ``DataFrame.checkpoint()`` works too.  On a cluster the setting must name
    shared storage: a machine-local folder would lose data.
    """
    root = _configured_checkpoint_dir(spark)
    if root is None:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="editpulse-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new, unique directory path under the shared scratch root."""
    root = checkpoint_root(spark)
    return f"{root}/{purpose}-{uuid.uuid4().hex[:12]}"
