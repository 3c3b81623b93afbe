"""Folders for what a query writes and reads back: in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch_folder(spark: SparkSession) -> str:
    """A new folder's name in spark.checkpoint.dir, as the session names it. Only a local master, whose executors are this machine, may name none."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not named:
        known = sc._jsc.sc().getCheckpointDir()
        if known.isEmpty() and not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
        named = tempfile.mkdtemp(prefix="siltworks-") if known.isEmpty() else known.get()
    return f"{named}/siltworks-{uuid.uuid4().hex}"
