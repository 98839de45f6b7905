"""URL filters over time, in DataFrame operations only.

A list changes: entries are added and removed on dated events.  The events of an
entry become validity intervals (from an ``add`` to the next event of the same
entry), and a capture is judged by the entries that were valid when it was
fetched: an equi-join on the entry's key, then the interval condition.  The
intervals of one entry don't overlap, so a capture meets each entry at most once.

Entries are ``domain`` (a host and all hosts below it), ``host`` (that host
alone) or ``prefix`` (host and path: with a final slash a directory and all below
it, without one that page alone).  A capture has a key for each domain above its
host and each directory of its path, at the depths that the lists' entries have
(the driver sees these few numbers), so the join grows with the captures and no
entry is too deep.  Of the entries that
meet a capture the most specific decides: prefix before host before domain, the
longer key first, ``allow`` before ``block``, then list name.  Without one the
capture is kept.

Skew: keys of one very frequent host meet its few intervals, so the adaptive
join may split the captures' side anywhere; no window or list over a host's
captures is ever built.

Defined results: null or hostless URLs match nothing and are kept; a null fetch
time matches no interval; of events of one entry at one time ``add`` counts (it
is renewed); empty lists keep everything; equal captures get equal results;
extra columns of the inputs are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import require_columns

RANK = {"prefix": 3, "host": 2, "domain": 1}


def host_of(url: Column) -> Column:
    """Lower-case host without user, port, ``www.`` or a final dot; empty if there is none."""
    host = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.regexp_replace(F.lower(host), r"^www\.|\.$", "")


def path_of(url: Column) -> Column:
    """Path from its first slash, without query and fragment."""
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)", 1)


def validity_intervals(events: DataFrame) -> DataFrame:
    """``list_name, action, kind, key, valid_from, valid_to`` from dated add and remove events.

    ``valid_to`` is null while an entry stands.  ``events`` has ``list_name, action
    (block or allow), kind, key, event (add or remove), at``.
    """
    require_columns(events, ["list_name", "action", "kind", "key", "event", "at"])
    entry = ["list_name", "action", "kind", "key"]
    # at one time an add outweighs a remove: the entry is renewed
    one = events.where(F.col("at").isNotNull() & F.col("key").isNotNull()).groupBy(*entry, "at").agg(F.min("event").alias("event"))
    w = Window.partitionBy(*entry).orderBy("at")  # the history of one entry, a few dated events
    return one.select(*entry, "event", F.col("at").alias("valid_from"), F.lead("at").over(w).alias("valid_to")).where(
        "event = 'add'").drop("event")


def entry_depths(events: DataFrame) -> tuple[list[int], list[int]]:
    """Numbers of labels of the domain entries, and of directories of the prefix entries with a final slash."""
    depth = F.when(F.col("kind") == "domain", F.size(F.split("key", r"\."))).when(
        (F.col("kind") == "prefix") & F.endswith("key", F.lit("/")), F.size(F.split("key", "/")) - 1)
    rows = events.select("kind", depth.alias("depth")).where("depth IS NOT NULL").distinct().collect()  # as many as depths
    return (sorted(r["depth"] for r in rows if r["kind"] == "domain"), sorted(r["depth"] for r in rows if r["kind"] == "prefix"))


def _numbers(depths: list[int]) -> Column:
    return F.array(*map(F.lit, depths)) if depths else F.array().cast("array<int>")


def capture_keys(captures: DataFrame, label_depths: list[int], dir_depths: list[int]) -> DataFrame:
    """A row for each key under which an entry of these depths could name a capture's URL."""
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    named = captures.select("url", "fetch_time", host.alias("host"), path.alias("path")).where("host <> ''").distinct()
    labels, dirs = F.split("host", r"\."), F.split("path", "/")
    domains = F.transform(F.filter(_numbers(label_depths), lambda n: n <= F.size(labels)), lambda n: F.struct(
        F.lit("domain").alias("kind"), F.array_join(F.slice(labels, F.size(labels) - n + 1, n), ".").alias("key")))
    hosts = F.array(F.struct(F.lit("host").alias("kind"), F.col("host").alias("key")))
    # the n-th directory of a path of k parts ends with a slash for n < k; the page itself is the whole path
    within = F.transform(F.filter(_numbers(dir_depths), lambda n: n < F.size(dirs)), lambda n: F.struct(
        F.lit("prefix").alias("kind"), F.concat(F.col("host"), F.array_join(F.slice(dirs, 1, n), "/"), F.lit("/")).alias("key")))
    page = F.array(F.struct(F.lit("prefix").alias("kind"), F.concat("host", "path").alias("key")))
    prefixes = F.array_distinct(F.concat(within, page))
    keys = F.concat(domains, hosts, F.when(F.col("path") == "", F.expr("filter(array(named_struct('kind', '', 'key', '')), x -> false)")).otherwise(prefixes))
    return named.select("url", "fetch_time", F.explode(keys).alias("k")).select("url", "fetch_time", "k.kind", "k.key")


def filter_captures(captures: DataFrame, events: DataFrame) -> DataFrame:
    """All captures with the entry that decided: ``page_id, url, fetch_time, kept,
    list_name, kind, key, valid_from, valid_to``."""
    require_columns(captures, ["page_id", "url", "fetch_time"])
    rows = captures.select("page_id", "url", "fetch_time")
    intervals = validity_intervals(events)
    met = capture_keys(rows, *entry_depths(events)).join(intervals, ["kind", "key"]).where(
        (F.col("valid_from") <= F.col("fetch_time")) & (F.col("valid_to").isNull() | (F.col("fetch_time") < F.col("valid_to"))))
    rank = F.when(F.col("kind") == "prefix", RANK["prefix"]).when(F.col("kind") == "host", RANK["host"]).otherwise(RANK["domain"])
    # the least struct is the entry that decides
    best = met.groupBy("url", "fetch_time").agg(F.min(F.struct(
        (-rank).alias("r"), (-F.length("key")).alias("l"), "action", "list_name", "kind", "key", "valid_from", "valid_to")).alias("e"))
    out = rows.join(best, ["url", "fetch_time"], "left")
    return out.select("page_id", "url", "fetch_time", F.coalesce(F.col("e.action") != "block", F.lit(True)).alias("kept"),
                      "e.list_name", "e.kind", "e.key", "e.valid_from", "e.valid_to")
