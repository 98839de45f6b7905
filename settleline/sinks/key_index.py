"""Which keys an append-only table holds, without shuffling the table.

The index is a Parquet table of the keys alone, hash-bucketed on the key.  A batch
is dealt by the same hash and anti-joined bucket by bucket: only the batch is
shuffled, the stored side is read in place, whatever its size.

The table's data files are the truth and the index follows them: it records which
files it has covered, and ``catch_up`` adds the keys of those that it hasn't (the
files of the last append, of a batch that failed after its write, or all files of a
table that had no index).  Keys that get in twice do no harm.

The bucketed layout is declared in the session's catalog as an external table; the
files stay when the session ends, and the next one declares them again.
"""

from __future__ import annotations

import hashlib
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Buckets of a new index.  At 10^12 keys choose some thousands; an index keeps its number.
BUCKETS = 16


class KeyIndex:
    def __init__(self, spark: SparkSession, path: str, key: str, buckets: int = BUCKETS):
        self.spark, self.path, self.key = spark, path.rstrip("/"), key
        root = f"{self.path}__keys"
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if self._fs.exists(self._path(root)):
            stored = [s.getPath().getName() for s in self._fs.listStatus(self._path(root))]
            buckets = next((int(n.partition("-")[2]) for n in stored if n.startswith("buckets-")), buckets)
        self.buckets = buckets
        self.keys_path, self.files_path = f"{root}/buckets-{buckets}", f"{root}/files"
        self.table = f"settleline_keys_{hashlib.md5(self.keys_path.encode()).hexdigest()[:16]}"
        location = self._fs.makeQualified(self._path(self.keys_path)).toString()
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.table} (`{key}` STRING) USING parquet "
                  f"CLUSTERED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{location}'")

    def _data_files(self) -> set[str]:
        if not self._fs.exists(self._path(self.path)):
            return set()
        root = self._fs.makeQualified(self._path(self.path)).toString().rstrip("/")
        files = self.spark.read.schema(f"`{self.key}` string").parquet(self.path).inputFiles()
        # relative to the table: the same table may be reached by file:/ and file:/// alike
        plain = root.replace("file:///", "file:/")
        return {unquote(f).replace("file:///", "file:/").removeprefix(plain) for f in files}

    def _covered(self) -> set[str]:
        if not self._fs.exists(self._path(self.files_path)):
            return set()
        return {r[0] for r in self.spark.read.schema("file string").parquet(self.files_path).collect()}

    def catch_up(self) -> int:
        """Add the keys of the data files that the index doesn't cover yet; the number of those files."""
        missing = sorted(self._data_files() - self._covered())
        if missing:
            rows = self.spark.read.schema(f"`{self.key}` string").parquet(*[f"{self.path}{f}" for f in missing])
            rows.repartition(self.buckets, F.col(self.key)).write.insertInto(self.table)
            self.spark.createDataFrame([(f,) for f in missing], "file string").coalesce(1).write.mode("append").parquet(self.files_path)
        return len(missing)

    def keys(self) -> DataFrame:
        self.spark.catalog.refreshTable(self.table)
        return self.spark.table(self.table)

    def absent(self, batch: DataFrame) -> DataFrame:
        """Rows of ``batch`` (keys unique and not null) whose key the table doesn't hold."""
        return batch.join(self.keys(), self.key, "left_anti")
