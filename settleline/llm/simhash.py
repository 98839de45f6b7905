"""SimHash near-duplicates with pigeonring filtering.

Fingerprint: 64 bits; bit i is set if it is set in more than half of the
XXH64 hashes (seed 42) of the text's 3-word shingles.  Two documents link if
their fingerprints differ in at most ``max_bits`` bits; components of links are
the groups of near copies.

Candidates come from the pigeonring principle (Qin and Xiao, 2018).  The
fingerprint is a ring of ``SEGMENTS`` segments.  If two fingerprints differ in
at most d bits, some start on the ring exists from which every chain of l
consecutive segments differs in at most l*d/SEGMENTS bits.  With five segments
and d = 2 the budgets are 0, 0, 1, 1, 2: two neighbouring segments (25 or 26
bits) are equal, which is the equi-join key, and the longer chains prune what
the key lets through before the full Hamming check.

Groups of copies: equal fingerprints collapse into one row first.  A key that
more than ``PAIR_LIMIT`` distinct fingerprints share isn't expanded into pairs.
Its fingerprints go the exact way for crowded keys: two fingerprints differ in
at most two bits if and only if one point of the cube lies within one bit of
both, so each lists its 65 points within one bit, and the members of a point
link to its least member.  That is 65 rows a fingerprint, whatever the size of
the crowd, and loses no link.

Defined results: null or wordless text has fingerprint zero and links like any
other; equal rows get equal results; a null ``doc_id`` takes part, but only
non-null ids name a component (null if it has none); an empty table gives an
empty result.  Other columns of the input are ignored by ``simhash_groups``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import connected_components, cut, free_names, hash128, require_columns, staged

SHINGLE = 3
MAX_BITS = 2
SEGMENTS = 5
#: A key with more distinct fingerprints than this goes the way for crowded keys
#: (65 rows a fingerprint), which is then the cheaper of two exact ways.
PAIR_LIMIT = 64
#: Shingles hashed at a time, which bounds memory for very long texts.
BLOCK = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of one text."""
    # bytes.lower changes A-Z only, bytes.split splits at ASCII white space only
    words = text.encode("utf-8", "replace").lower().split() if text else []
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for lo in range(0, n, BLOCK):
        hi = min(n, lo + BLOCK)
        hashes = np.array([digest(b" ".join(words[i:i + shingle]), 42) for i in range(lo, hi)], dtype="<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def with_fingerprint(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``(doc_id, k1, k2, fp)``: the row's identity and its fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t.as_py(), shingle) for t in b.column(3)], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(fps)], names=["doc_id", "k1", "k2", "fp"])

    return docs.select(F.col("doc_id").cast("long"), *row_key(), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, k1 long, k2 long, fp long")


def row_key() -> tuple[Column, Column]:
    """A row's identity by doc_id and text; equal rows have equal keys."""
    k1, k2 = hash128(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return k1.alias("k1"), k2.alias("k2")


def segment_bounds(segments: int = SEGMENTS) -> list[tuple[int, int]]:
    """(shift, width) of each segment of the ring."""
    edges = [64 * i // segments for i in range(segments + 1)]
    return [(edges[i], edges[i + 1] - edges[i]) for i in range(segments)]


def chain_mask(start: int, length: int, segments: int = SEGMENTS) -> int:
    """Bits of ``length`` consecutive segments from ``start``, as a signed long."""
    m = 0
    for k in range(length):
        shift, width = segment_bounds(segments)[(start + k) % segments]
        m |= ((1 << width) - 1) << shift
    return m - (1 << 64) if m >> 63 else m


def within_chain_budgets(diff: Column, start: Column, max_bits: int, segments: int = SEGMENTS) -> Column:
    """Every chain from ``start`` stays within its share of the budget."""
    ok = F.lit(False)
    for s in range(segments):
        here = start == F.lit(s)
        for length in range(1, segments + 1):
            here &= F.bit_count(diff.bitwiseAND(F.lit(chain_mask(s, length, segments)))) <= F.lit(length * max_bits // segments)
        ok |= here
    return ok


def link_fingerprints(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links ``(a, b)`` that connect all distinct ``fp`` within ``max_bits`` bits."""
    if max_bits != 2:
        raise ValueError("the budgets of the ring and the crowded-key step are laid out for 2 bits")
    exact = (SEGMENTS - 1) // max_bits  # segments at the head of a chain whose budget is zero
    ring = fps.select("fp", F.explode(F.array(*[
        F.struct(F.lit(s).alias("start"), F.col("fp").bitwiseAND(F.lit(chain_mask(s, exact))).alias("bits"))
        for s in range(SEGMENTS)])).alias("k")).select("fp", "k.start", "k.bits")
    keys = cut(ring.groupBy("start", "bits").agg(F.count("*").alias("n")).where("n > 1"))
    shared = ring.join(keys, ["start", "bits"])
    few = shared.where(F.col("n") <= PAIR_LIMIT).select("start", "bits", "fp")
    diff = F.col("fp").bitwiseXOR(F.col("other"))
    pairs = few.join(few.withColumnRenamed("fp", "other"), ["start", "bits"]).where(
        (F.col("fp") < F.col("other")) & within_chain_budgets(diff, F.col("start"), max_bits)
        & (F.bit_count(diff) <= max_bits)).select(F.col("fp").alias("a"), F.col("other").alias("b"))
    crowd = shared.where(F.col("n") > PAIR_LIMIT).select("fp").distinct()
    flips = [0] + [1 << i if i < 63 else -(1 << 63) for i in range(64)]
    points = crowd.select("fp", F.explode(F.array(*[F.col("fp").bitwiseXOR(F.lit(x)) for x in flips])).alias("point"))
    centre = points.groupBy("point").agg(F.min("fp").alias("least"), F.count("*").alias("n")).where("n > 1")
    stars = points.join(centre, "point").where("fp <> least").select(F.col("fp").alias("a"), F.col("least").alias("b"))
    return pairs.unionByName(stars).distinct()


def _components(docs: DataFrame, shingle: int, max_bits: int) -> tuple[DataFrame, DataFrame]:
    """The fingerprint of every row, and of every fingerprint its component's least row."""
    require_columns(docs, ["doc_id", "text"])
    fp = staged(with_fingerprint(docs, shingle), "simhash")
    # a struct orders by its fields: rows with an id come first, by id
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "k1", "k2")
    distinct = fp.groupBy("fp").agg(F.min(row).alias("row"))
    comp = connected_components(link_fingerprints(distinct.select("fp"), max_bits))
    labelled = distinct.join(comp.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "row", F.coalesce("component", "fp").alias("component"))
    least = labelled.groupBy("component").agg(F.min("row").alias("first"))
    return fp, labelled.join(least, "component").select("fp", "first")


def simhash_groups(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` for every row of ``docs``.

    ``fingerprint`` is 16 lower-case hex digits; ``component_id`` is the least
    doc_id that links lead to, the row's own included.
    """
    fp, named = _components(docs, shingle, max_bits)
    return fp.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("first.doc_id").alias("component_id"))


def keep_one_per_group(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One row of ``docs`` for each component, with all its columns: that of the
    least doc_id (rows without an id come last, then the row's hash decides)."""
    _, named = _components(docs, shingle, max_bits)
    r1, r2 = free_names(docs, "r1", "r2")
    keep = named.select(F.col("first.k1").alias(r1), F.col("first.k2").alias(r2)).distinct()
    k1, k2 = row_key()
    kept = docs.select("*", k1.alias(r1), k2.alias(r2)).join(keep, [r1, r2], "left_semi")
    return kept.dropDuplicates([r1, r2]).select(*docs.columns)
