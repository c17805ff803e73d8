"""Shared folder for written intermediates (landed tables, checkpoints).

The cluster names the folder in ``spark.checkpoint.dir``. Only a local session, as in tests, may
fall back to a temporary folder: on a cluster that would be a different disk on every machine.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_RUN_FOLDERS: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """One fresh sub-folder per Spark application, below the folder the cluster names."""
    app = spark.sparkContext.applicationId
    if app not in _RUN_FOLDERS:
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base:
            if not spark.sparkContext.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all machines can reach")
            base = tempfile.mkdtemp(prefix="tallyreel-")
        _RUN_FOLDERS[app] = f"{base.rstrip('/')}/tallyreel-{uuid.uuid4().hex}"
    return _RUN_FOLDERS[app]


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Reliable checkpoints need a directory; keep the one the session already has."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(f"{shared_folder(spark)}/checkpoints")
