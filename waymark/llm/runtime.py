"""Shared folders, written tables and small DataFrame helpers for the operators of this package."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SETTING = "spark.checkpoint.dir"
#: Size of the Arrow batches between the JVM and Python workers, of which a task holds several on either side, and the session's default.
BATCHES, BATCH_BYTES, USUAL = "spark.sql.execution.arrow.maxBytesPerBatch", 8 << 20, 64 << 20


def prepared(df: DataFrame) -> DataFrame:
    """The same rows; a session that has chosen no size of Arrow batches gets one of 8 MB, as whole texts fill batches of ten thousand rows."""
    conf = df.sparkSession.conf
    if conf.get(BATCHES).rstrip("b") == str(USUAL):
        conf.set(BATCHES, str(BATCH_BYTES))
    return df


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as the cluster names it. Where none is set: a new local one for a local master, else an error."""
    if not spark.conf.get(SETTING, None):
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError(f"{SETTING} must name a folder that driver and executors share")
        spark.conf.set(SETTING, tempfile.mkdtemp(prefix="waymark-"))
    return spark.conf.get(SETTING).rstrip("/")


def scratch_root(spark: SparkSession) -> str:
    """The part of the shared folder that this application's tables lie in."""
    return f"{shared_dir(spark)}/waymark/{spark.conf.get('spark.app.id', 'application')}"


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{scratch_root(spark)}/{uuid.uuid4().hex}-{name}"


def clear(spark: SparkSession) -> None:
    """Delete every table that this application has written to the shared folder; results that were not yet read go with them."""
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def written(df: DataFrame, name: str) -> DataFrame:
    """The same rows, read back from a table in the shared folder: cuts lineage, and no executor holds the only copy."""
    path = scratch(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def large(df: DataFrame) -> DataFrame:
    """The same rows, for one side of a join: both sides are sorted, and neither is broadcast, however small it looks.

    Columns of numbers take few bytes as files or shuffled, but some 30 times as many in the hash table that the driver makes of them.
    """
    return df.hint("merge")


def salted(left: DataFrame, right: DataFrame, keys: list[str], spread: Column, how: str, salts: int = 8) -> DataFrame:
    """Join with a key that may hold a large share of left's rows; right has few rows for each key.

    left is dealt by (keys, salt), the salt being spread modulo salts, and each row of right goes to every salt.
    """
    salt = "__salt"
    every = right.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    dealt = left.withColumn(salt, F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
    return dealt.join(every, [*keys, salt], how).drop(salt)
