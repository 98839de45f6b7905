"""Helpers shared by the operators: staged tables, row identity, union-find."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from settleline.session import checkpoint_dir, configured_checkpoint_dir, ensure_checkpoint_dir
from settleline.sinks.tables import delete_path

#: Words are runs of anything but these ASCII white-space characters.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"

_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (``spark.checkpoint.dir``).

    Where the session names none, a local session gets one of its own; on a
    cluster that is an error, since executors would not see each other's files.
    """
    if configured_checkpoint_dir(spark) is None and spark.sparkContext.master.startswith("local["):
        return ensure_checkpoint_dir(spark)
    root = checkpoint_dir(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Queries planned inside drop their shuffle files when they end; the setting comes back after.

    Otherwise the files stay until the driver happens to collect its garbage, which has no bound
    in the size of the input: a long run would keep the shuffles of all queries so far.
    """
    before = spark.conf.get(_FREE_SHUFFLES, None)
    spark.conf.set(_FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.unset(_FREE_SHUFFLES) if before is None else spark.conf.set(_FREE_SHUFFLES, before)


class Scratch:
    """The tables that ``staged`` and ``cut`` made in a ``scratch`` block, with their folders."""

    def __init__(self, made: Iterable[tuple[DataFrame, str]] = ()) -> None:
        self.made = list(made)
        self.kept: list[tuple[DataFrame, str]] = []

    def keep(self, table: DataFrame) -> DataFrame:
        """``table``, which outlives the block."""
        self.kept += [x for x in self.made if x[0] is table]
        self.made = [x for x in self.made if x[0] is not table]
        return table


_scratch: ContextVar[Scratch | None] = ContextVar("scratch", default=None)


@contextmanager
def scratch(spark: SparkSession, earlier: Iterable[tuple[DataFrame, str]] = ()) -> Iterator[Scratch]:
    """At its end the files of all tables ``staged`` or ``cut`` inside go, and those of ``earlier``.

    Nothing that is read later may depend on them but what ``Scratch.keep`` has kept.
    """
    token = _scratch.set(made := Scratch(earlier))
    try:
        yield made
    finally:
        _scratch.reset(token)
        for _, path in made.made:
            delete_path(spark, path)


def noted(table: DataFrame, path: str) -> DataFrame:
    made = _scratch.get()
    if made is not None:
        made.made.append((table, path))
    return table


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts the lineage: what follows reads the table, and a lost executor costs
    only the tasks it was running.  Shuffles of the write go with it.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    with shuffles_freed(spark):
        df.write.parquet(path)
    return noted(spark.read.schema(df.schema).parquet(path), path)


def cut(df: DataFrame) -> DataFrame:
    """Checkpoint in the shared folder (for the small tables of iterations)."""
    shared_dir(df.sparkSession)
    with shuffles_freed(df.sparkSession):
        table = df.select("*").checkpoint(eager=True)  # planned anew, with the setting
    return noted(table, table._jdf.queryExecution().analyzed().rdd().getCheckpointFile().get())


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def hash128(*cols: Column) -> tuple[Column, Column]:
    """Two independently seeded 64-bit hashes: together a 128-bit identity."""
    return F.xxhash64(F.lit(11), *cols), F.xxhash64(F.lit(29), *cols)


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """Distributed union-find: ``(node, component)`` for every node of ``edges``.

    ``component`` is the least node that can be reached.  Alternates large-star
    and small-star rounds (each node hands its neighbours to the least of them)
    until all are stars, which takes O(log^2 n) rounds.  The large star is an
    aggregation with map-side combine and an equi-join, so a hub with many
    neighbours is summed before it is shuffled; the small star a window over rows
    of two nodes, which spill if need be; rounds are checkpointed.  Edges with a
    null end are ignored; an empty input gives an empty result.
    """
    e = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where(F.col("u").isNotNull() & F.col("v").isNotNull())
    e = e.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    e = cut(e)
    for _ in range(max_rounds):
        back = e.select(F.col("v").alias("u"), F.col("u").alias("v"))
        least = both_ways(e).groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = back.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = large.select("u", "v", F.min("v").over(Window.partitionBy("u")).alias("m")).select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
            F.struct(F.col("u").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*")
        e = cut(small.where("u <> v").distinct())
        with shuffles_freed(e.sparkSession):
            settled = are_stars(e)
        if settled:
            break
    else:
        raise RuntimeError("connected components did not settle")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def both_ways(e: DataFrame) -> DataFrame:
    """Every edge ``(u, v)`` from either end."""
    return e.select(F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))).alias("e")).select("e.*")


def are_stars(e: DataFrame) -> bool:
    """Whether each node of ``(u, v)``, all u > v, has one lesser neighbour that has none, or none itself."""
    return both_ways(e).groupBy("u").agg(F.count(F.when(F.col("v") < F.col("u"), 1)).alias("below"), F.max("v").alias("most")).where(
        (F.col("below") > 1) | ((F.col("below") == 1) & (F.col("most") > F.col("u")))).isEmpty()


def require_columns(df: DataFrame, names: Iterable[str]) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names with as many underscores in front as it takes to clash with no column."""
    taken = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n = "_" + n
        out.append(n)
    return out
