"""Where streaming jobs keep checkpoints and state."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder that the driver and all executors share.

    It lies under ``spark.checkpoint.dir``, or where the session names none, in
    its warehouse folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    root = root or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/checkpoints"
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
