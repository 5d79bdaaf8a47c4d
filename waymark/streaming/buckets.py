"""Versioned tables in hash buckets: a step rewrites the buckets that its keys fall into, and a small manifest makes it the newest version."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from waymark.streaming.batches import Versions

BUCKET, SCHEMA = "__bucket", -1
MANIFEST = "bucket int, folder string"


class Buckets(Versions):
    """A table whose rows lie in `count` buckets by a hash of their key, so a step costs what its buckets hold, not what the table holds.

    A version is a manifest, of `count` rows at most, that names the folder of each bucket; folders are never written twice but by
    the step of their own number, so readers of older versions are not touched, and a step that died or is made again gives the same.
    Rows of one key lie in one bucket. The key is an expression over the rows' columns; a null one is a key like others.
    """

    def __init__(self, spark: SparkSession, path: str, key: Column, count: int = 64):
        super().__init__(spark, path)
        self.count, self.bucket = count, F.pmod(F.xxhash64(key), F.lit(count)).cast("int")

    def beside(self, name: str, key: Column) -> Buckets:
        return Buckets(self.spark, f"{self.path}-{name}", key, self.count)

    def manifest(self, number: int | None = None) -> tuple[dict[int, str], StructType | None]:
        """The folder of each bucket that has rows, and the table's schema."""
        number = self.at if number is None else number
        rows = {r["bucket"]: r["folder"] for r in super().read(number).collect()} if number else {}
        schema = rows.pop(SCHEMA, None)
        return rows, StructType.fromJson(json.loads(schema)) if schema else None

    def touched(self, keys: DataFrame) -> list[int]:
        """The buckets of rows that have the key's columns: `count` numbers at most."""
        return sorted(r[0] for r in keys.select(self.bucket).distinct().collect())

    def read(self, number: int | None = None, buckets: list[int] | None = None) -> DataFrame:
        """The rows of all buckets, or of some: no other bucket's files are opened."""
        held, schema = self.manifest(number)
        folders = [f for b, f in sorted(held.items()) if buckets is None or b in set(buckets)]
        if schema is None:
            raise ValueError(f"no table under {self.path} yet")
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def holding(self, keys: DataFrame) -> DataFrame:
        return self.read(buckets=self.touched(keys))

    def write(self, rows: DataFrame, number: int | None = None) -> DataFrame:
        """The next version, or that of the number, of these rows alone."""
        return self._commit(rows, self.at + 1 if number is None else number, {}, list(range(self.count)))

    def change(self, number: int, keys: DataFrame, make: Callable[[DataFrame | None], DataFrame]) -> DataFrame:
        """The version of that number: make gets the rows of the buckets that the keys fall into, or None where there is no table yet, and gives
        what is to stand there; rows of other buckets are carried over as files."""
        before = max((n for n in self.numbers() if n < number), default=0)
        held, schema = self.manifest(before)
        touched = self.touched(keys)
        return self._commit(make(self.read(before, touched) if schema is not None else None), number, held, touched)

    def _commit(self, rows: DataFrame, number: int, held: dict[int, str], touched: list[int]) -> DataFrame:
        root = f"{self.path}/data/n={number:06d}"
        rows.withColumn(BUCKET, self.bucket).hint("rebalance", BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(root)
        path = self.spark._jvm.org.apache.hadoop.fs.Path(root)
        files = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).listStatus(path)
        fresh = {int(n.partition("=")[2]): f"{root}/{n}" for f in files if (n := f.getPath().getName()).startswith(f"{BUCKET}=")}
        if strays := set(fresh) - set(touched):
            raise ValueError(f"rows of buckets that no key named: {sorted(strays)[:5]}")
        manifest = {b: f for b, f in held.items() if b not in set(touched)} | fresh
        listed = [*manifest.items(), (SCHEMA, rows.schema.json())]
        super().write(self.spark.createDataFrame(listed, MANIFEST).coalesce(1), number)
        return self.read()

    def drop_before(self, keep: int = 2) -> None:
        """Delete all but the newest `keep` manifests, and the folders that none of these names."""
        super().drop_before(keep)
        named = {f for n in self.numbers() for f in self.manifest(n)[0].values()}
        root = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/data")
        files = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        for step in files.listStatus(root):
            for f in files.listStatus(step.getPath()):
                name = f.getPath().getName()
                if name.startswith(f"{BUCKET}=") and f"{self.path}/data/{step.getPath().getName()}/{name}" not in named:
                    files.delete(f.getPath(), True)
