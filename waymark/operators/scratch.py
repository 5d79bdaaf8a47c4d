"""Tables that a job writes for itself, in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession, name: str) -> str:
    """A new path under spark.checkpoint.dir. Where that is unset: under a new local folder for a local master, else an error."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="waymark-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/waymark/{spark.conf.get('spark.app.id', 'application')}/{uuid.uuid4().hex}-{name}"


def kept(df: DataFrame) -> DataFrame:
    """The same rows, written and read back: lineage ends here."""
    path = folder(df.sparkSession, "kept")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
