"""Benchmark decontamination: BM25 with block-max WAND, then overlap checks.

The test items are the indexed side.  Each item's BM25 weights are divided by
the score the item has against its own text, so one threshold means the same
for every item.  Postings are ordered by item and cut into blocks with the
largest weight of each.

Every text is cut into overlapping passages of ``2 * stride`` words (``stride``
is at least the longest item, so each occurrence lies whole in some passage)
and each passage queries the index:

* the block-max bound first, for all passages of a text at once: in some range
  of items, the largest weights of the passage's distinct terms must reach the
  threshold;
* then block-max WAND over the postings, which returns all items at or above
  the threshold;
* then the check of the retrieved items: at least ``overlap`` of the question's
  word 5-grams are in the passage, and so are those of the answer (or of the
  whole item, where an answer of a word or two was altered).

An item is split at an explicit answer mark (``Answer:``, ``A:``) or else before
its last sentence; an item of one sentence has no answer part.

The index is broadcast in shards of at most ``SHARD_BYTES`` of item text, so
the benchmark may grow; document counts come from the whole benchmark.

Defined results: null or wordless texts match nothing, null or wordless items
are never matched, equal rows get equal results, a null doc_id is carried
through, empty tables give an empty result.  Clashing extra columns are kept.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import require_columns

K1, B = 1.2, 0.75
THRESHOLD = 0.5
OVERLAP = 0.8
GRAM = 5
MIN_STRIDE = 64
BLOCK = 64
#: Ranges of items that the bound over all passages of a text tells apart.
RANGES = 128
#: Passages whose bounds are computed together.
PASSAGES = 2048
SHARD_BYTES = 32 << 20

WORD = re.compile(r"\w+")
#: Past the last posting.
END = 1 << 62

ANSWER_MARK = re.compile(r"(?:^|\s)(?:answer|a)\s*:\s*", re.I)
SENTENCE_END = re.compile(r"[.!?]\s+")


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


def split_item(text: str) -> tuple[list[str], list[str]]:
    """Words of the question and of the answer (may be empty)."""
    mark = None
    for mark in ANSWER_MARK.finditer(text):
        pass
    if mark and words_of(text[:mark.start()]):
        return words_of(text[:mark.start()]), words_of(text[mark.end():])
    end = None
    for end in SENTENCE_END.finditer(text.rstrip()):
        pass
    if end and words_of(text[:end.start()]) and words_of(text[end.end():]):
        return words_of(text[:end.start()]), words_of(text[end.end():])
    return words_of(text), []


def grams(words: list[str], n: int) -> set[tuple[str, ...]]:
    return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)}


def overlap(part: list[str], passage: list[str], gram: int = GRAM) -> float:
    """Share of the part's distinct grams that the passage has; 1 for no words."""
    if not part:
        return 1.0
    n = min(gram, len(part))
    own = grams(part, n)
    return len(own & grams(passage, n)) / len(own)


@dataclass
class Postings:
    items: list[int]  # positions of the items, ascending
    weights: list[float]
    most: float
    block_most: list[float]


@dataclass
class Index:
    item_ids: list[int | None]
    parts: list[tuple[list[str], list[str]]]
    terms: dict[str, int]
    postings: list[Postings]
    range_most: np.ndarray  # term x range of items: the largest weight
    longest: int


def build_index(items: list[tuple[int | None, str]], doc_count: int, mean_length: float, df: dict[str, int]) -> Index:
    """Index of items with words; statistics are those of the whole benchmark."""
    parts = [split_item(t) for _, t in items]
    lists: dict[str, list[tuple[int, float]]] = {}
    for at, (q, a) in enumerate(parts):
        tf = Counter(q + a)
        long = K1 * (1 - B + B * sum(tf.values()) / mean_length)
        weight = {t: np.log1p((doc_count - df[t] + 0.5) / (df[t] + 0.5)) * n * (K1 + 1) / (n + long) for t, n in tf.items()}
        own = sum(weight.values())
        for t, w in weight.items():
            lists.setdefault(t, []).append((at, float(w / own)))
    postings = []
    for rows in lists.values():
        weights = [w for _, w in rows]
        postings.append(Postings([i for i, _ in rows], weights, max(weights),
                                 [max(weights[k:k + BLOCK]) for k in range(0, len(weights), BLOCK)]))
    per_range = -(-len(items) // RANGES) or 1
    range_most = np.zeros((len(lists), -(-len(items) // per_range)), np.float32)
    for k, p in enumerate(postings):
        np.maximum.at(range_most[k], np.array(p.items) // per_range, np.array(p.weights, np.float32))
    return Index([i for i, _ in items], parts, {t: k for k, t in enumerate(lists)}, postings, range_most, max((len(q) + len(a) for q, a in parts), default=0))


def block_max_wand(lists: list[Postings], threshold: float) -> list[tuple[int, float]]:
    """All items whose weights in ``lists`` sum to the threshold or more, with the sum."""
    found = []
    threshold -= 1e-9
    cursors = [[p.items[0], 0, p] for p in lists]

    def seek(c: list, item: int) -> None:
        """Move to the first posting at or after ``item``, block by block."""
        _, at, p = c
        n = len(p.items)
        while at < n and p.items[min((at // BLOCK + 1) * BLOCK, n) - 1] < item:
            at = (at // BLOCK + 1) * BLOCK
        while at < n and p.items[at] < item:
            at += 1
        c[1] = at
        c[0] = p.items[at] if at < n else END

    while cursors:
        cursors.sort(key=itemgetter(0))
        bound, pivot = 0.0, -1
        for k, c in enumerate(cursors):
            bound += c[2].most
            if bound >= threshold:
                pivot = k
                break
        if pivot < 0:
            break
        item = cursors[pivot][0]
        while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == item:
            pivot += 1
        ahead, bound, skip_to = cursors[:pivot + 1], 0.0, None
        for _, at, p in ahead:  # the blocks that would hold the pivot item
            block = at // BLOCK
            while block < len(p.block_most) - 1 and p.items[(block + 1) * BLOCK - 1] < item:
                block += 1
            bound += p.block_most[block]
            last = p.items[min((block + 1) * BLOCK, len(p.items)) - 1]
            skip_to = last if skip_to is None else min(skip_to, last)
        if bound < threshold:
            goal = max(item, skip_to) + 1
            if pivot + 1 < len(cursors):
                goal = min(goal, max(cursors[pivot + 1][0], item + 1))
        elif cursors[0][0] == item:
            score = sum(p.weights[at] for _, at, p in ahead)
            if score >= threshold:
                found.append((item, score))
            goal = item + 1
        else:
            goal = item
        for c in ahead:
            if c[0] < goal:
                seek(c, goal)
        cursors = [c for c in cursors if c[0] != END]
    return found


def promising(term: np.ndarray, edges: np.ndarray, index: Index, threshold: float) -> Iterator[int]:
    """Passages whose bound reaches the threshold in some range of items."""
    for lo in range(0, len(edges) - 1, PASSAGES):
        starts = edges[lo:lo + PASSAGES + 1]
        own = np.nonzero(starts[1:] > starts[:-1])[0]
        if len(own):
            sums = np.add.reduceat(index.range_most[term[starts[0]:starts[-1]]], starts[own] - starts[0], axis=0)
            yield from lo + own[sums.max(axis=1) >= threshold - 1e-4]


def matches(text: str | None, index: Index, threshold: float = THRESHOLD, least: float = OVERLAP) -> list[tuple]:
    """``(item position, first word, score, question overlap, answer overlap)``, the best passage for each item."""
    words = words_of(text)
    if not words or not index.postings:
        return []
    n_terms = len(index.postings)
    get = index.terms.get
    ids = np.array([get(w, n_terms) for w in words])
    at = np.nonzero(ids < n_terms)[0]
    ids = ids[at]
    stride = max(MIN_STRIDE, index.longest)
    last = max(0, -(-len(words) // stride) - 2)  # the last passage reaches the end
    # passage k holds words k*stride to (k+2)*stride: each word is in two of them
    later = np.minimum(at // stride, last)
    earlier = np.maximum(at // stride - 1, 0)
    pairs = np.unique(np.concatenate([later * n_terms + ids, earlier * n_terms + ids]))
    passage, term = np.divmod(pairs, n_terms)
    best: dict[int, tuple] = {}
    edges = np.searchsorted(passage, np.arange(last + 2))
    for k in promising(term, edges, index, threshold):
        lists = [index.postings[t] for t in term[edges[k]:edges[k + 1]]]
        for item, score in block_max_wand(lists, threshold):
            start = int(k) * stride
            own = words[start:start + 2 * stride]
            q, a = index.parts[item]
            in_q, in_a = overlap(q, own), overlap(a, own)
            if in_q >= least and (in_a >= least or overlap(q + a, own) >= least):
                best[item] = max(best.get(item, (0.0,)), (score, -start, in_q, in_a))
    return [(i, -b[1], b[0], b[2], b[3]) for i, b in sorted(best.items())]


def index_shards(benchmark: DataFrame, shard_bytes: int = SHARD_BYTES) -> Iterator[Index]:
    """One index per ``shard_bytes`` of item text; the driver holds a shard at a time while it builds."""
    require_columns(benchmark, ["item_id", "text"])
    items = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).where(F.col("text").rlike(r"[\p{L}\p{N}_]"))
    words = items.select(F.regexp_extract_all(F.lower("text"), F.lit(r"(?U)(\w+)"), 1).alias("w"))
    size, count = items.agg(F.sum(F.octet_length("text")), F.count("*")).first()
    mean = words.agg(F.avg(F.size("w"))).first()[0]
    if not count:
        return
    shards = -(-size // shard_bytes)
    for k in range(shards):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(shards)) == k).collect()
        rows = sorted(((r["item_id"], r["text"]) for r in rows if words_of(r["text"])), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        own = sorted({w for _, t in rows for w in words_of(t)})
        df = Counter({w: 0 for w in own})
        if shards == 1:
            for _, t in rows:
                df.update(set(words_of(t)))
        else:
            listed = benchmark.sparkSession.createDataFrame([(w,) for w in own], "term string")
            counted = words.select(F.explode(F.array_distinct("w")).alias("term")).groupBy("term").count()
            df.update({r["term"]: r["count"] for r in counted.join(listed, "term").collect()})
        yield build_index(rows, count, mean, df)


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, least: float = OVERLAP,
                 shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """A row for each document and test item whose text it holds.

    ``doc_id, item_id, first_word`` (of the passage), ``score`` (share of the
    item's own BM25 score), ``question_overlap, answer_overlap``.
    """
    require_columns(docs, ["doc_id", "text"])
    schema = "doc_id long, item_id long, first_word long, score double, question_overlap double, answer_overlap double"
    types = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64()]
    names = [c.split()[0] for c in schema.split(", ")]
    source = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    spark = docs.sparkSession
    out = spark.createDataFrame([], schema)
    for index in index_shards(benchmark, shard_bytes):
        shared = spark.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            own = shared.value
            for b in batches:
                rows = [(doc_id, own.item_ids[i], *rest) for doc_id, text in zip(b.column(0).to_pylist(), b.column(1))
                        for i, *rest in matches(text.as_py(), own, threshold, least)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 6, types)], names=names)

        out = out.unionByName(source.mapInArrow(run, schema))
    return out


def keep_uncontaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, least: float = OVERLAP,
                        shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Rows of ``docs`` that hold no test item, columns unchanged."""
    require_columns(docs, ["text"])
    at = docs.columns.index("text")
    out = docs
    for index in index_shards(benchmark, shard_bytes):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for b in batches:
                clean = [not matches(t.as_py(), shared.value, threshold, least) for t in b.column(at)]
                yield b.filter(pa.array(clean, pa.bool_()))

        out = out.mapInArrow(run, docs.schema)
    return out
