"""Tables whose state is a list of committed folders.

Rows are written to a folder of their own first; the table changes when a marker
naming that folder is created, which is one file-system call.  So readers see the
state before or after a write, never half of it, a job that fails leaves nothing
visible, and several parts (sub-tables) change together.  A commit adds its folder
to the earlier ones or replaces them; a replaced generation stays for readers that
have planned on it and goes with the next replacement.

Layout under the table's path: ``_data/<folder>/<part>`` and ``_commits/<number>.<add
or replace>.<folder>.<note>``.  One writer at a time.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Commit:
    number: int
    replaces: bool
    folder: str
    note: str


class CommitLog:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._fs = self._hadoop(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _names(self) -> list[str]:
        folder = self._hadoop(f"{self.path}/_commits")
        return sorted(s.getPath().getName() for s in self._fs.listStatus(folder)) if self._fs.exists(folder) else []

    def history(self) -> list[Commit]:
        """All commits that still have a marker, oldest first."""
        out = []
        for name in self._names():
            if not name.startswith((".", "_")):
                number, kind, folder, note = name.split(".", 3)
                out.append(Commit(int(number), kind == "replace", folder, note))
        return sorted(out, key=lambda c: c.number)

    def current(self) -> list[Commit]:
        """The commits that make up the state: the last replacing one and those after it."""
        out: list[Commit] = []
        for c in self.history():
            out = [c] if c.replaces else [*out, c]
        return out

    def next_number(self) -> int:
        return max((c.number for c in self.history()), default=0) + 1

    def folder(self, name: str, part: str = "rows") -> str:
        return f"{self.path}/_data/{name}/{part}"

    def publish(self, folder: str, replaces: bool = False, note: str = "") -> Commit:
        """Make a written folder part of the table (all of it, with ``replaces``)."""
        before = self.history()
        c = Commit(max((x.number for x in before), default=0) + 1, replaces, folder, note)
        marker = f"{self.path}/_commits/{c.number:012d}.{'replace' if replaces else 'add'}.{folder}.{note}"
        if not self._fs.createNewFile(self._hadoop(marker)):
            raise RuntimeError(f"commit {c.number} of {self.path} exists already")
        if replaces:
            self._drop(before)
        return c

    def _drop(self, before: list[Commit]) -> None:
        """Remove what an earlier replacement has replaced (the generation before the last stays)."""
        at = max((k for k, c in enumerate(before) if c.replaces), default=0)
        for c in before[:at]:
            self._fs.delete(self._hadoop(f"{self.path}/_commits/{c.number:012d}.{'replace' if c.replaces else 'add'}.{c.folder}.{c.note}"), False)
            self._fs.delete(self._hadoop(f"{self.path}/_data/{c.folder}"), True)

    def replace(self, rows: DataFrame, note: str = "") -> DataFrame:
        """Put ``rows`` (which may be derived from the table) in place of the whole table."""
        folder = uuid.uuid4().hex
        rows.write.parquet(self.folder(folder))
        self.publish(folder, replaces=True, note=note)
        return self.spark.read.schema(rows.schema).parquet(self.folder(folder))

    def read(self, schema=None, part: str = "rows") -> DataFrame | None:
        """The table's rows, or None if nothing was committed."""
        folders = [self.folder(c.folder, part) for c in self.current()]
        if not folders:
            return None
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        return reader.parquet(*folders)


def latest(rows: DataFrame, keys: list[str], order: str = "seq") -> DataFrame:
    """Of the rows with equal keys the one with the greatest ``order`` (which goes)."""
    others = [c for c in rows.columns if c not in (*keys, order)]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*others), order).alias("_last")).select(*keys, "_last.*").select(
        *[c for c in rows.columns if c != order])
