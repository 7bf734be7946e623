"""Folders for checkpoints and intermediate tables."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def workspace(spark: SparkSession, name: str) -> str:
    """A fresh folder that driver and executors share.

    It lies under ``spark.checkpoint.dir``, or under the session's warehouse
    where that is not set.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
