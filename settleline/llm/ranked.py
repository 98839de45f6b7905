"""Ranked lexical search by dense blocked matrix multiplication.

Scores are BM25-like and integer: an item's score for a document is the sum over
the item's terms of ``weight(term) * impact(term, document)``, with

    weight = floor(1000 * ln((2N + 2) / (2 df + 1)))
    impact = (1000000000 * tf) div (1000 * tf + 8 * m),  m = 10 + (90 * n * N) div L

over N documents with a term, L their terms, n those of the document, df the
documents that hold the term, tf its occurrences in this one.

The items' terms form a compact vocabulary.  It is cut into tiles; for each tile
of documents, the impacts of the tile's terms that occur there form a dense
float64 matrix, which BLAS multiplies with the dense matrix of the items'
weights.  Impacts are at most 10^6, and a tile holds so few terms that the sum of
its weights times 10^6 stays under 2^53: each partial sum of a product is an
integer that a double holds exactly, in whatever order BLAS adds.  Tiles' results
are added up in 64-bit integers.

Top-k: a task keeps each item's k best rows (score, then the smaller doc_id).  A
tile's document replaces one only if its score is not under the k-th best one, so
equal scores are always settled by doc_id, not by the order of tiles or tasks.
The tasks' rows are ranked by two windows: per item and salt, then per item, so no
window holds more than ``k * SALTS`` rows plus a salt's share of the tasks.

Spark side: two passes over the documents (counts, then scores), nothing staged.
The items are the query set: they are broadcast in groups of at most
``ITEMS`` items and ``CELLS`` matrix cells; each group takes a pass of its own.

Defined results: null or termless documents are not counted and never returned;
a null or termless item gets no rows; repeated rows of documents count and are
ranked one by one, repeated rows of items each get their ranking; a document
without doc_id counts, and comes after all others of equal score.  An item gets
fewer than k rows where fewer documents score above 0.  Empty tables give an
empty result.  Other columns are ignored; texts are read whole.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import require_columns

K = 10
#: Documents of a tile.
DOCS = 256
#: Terms of a tile at most; fewer where their weights are large.
TERMS = 4096
#: Items x terms of a broadcast group: 64 MB of float64.
CELLS = 1 << 23
ITEMS = 4096
SALTS = 64
MOST_IMPACT = 1_000_000
#: ASCII letters and digits and all bytes of other characters make terms; only A-Z are lower-cased.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def terms_of(text: bytes | None) -> list[bytes]:
    """Terms of a text (UTF-8) in order."""
    return text.translate(_FOLD).split() if text else []


@dataclass
class Items:
    """A group of items and its compact vocabulary."""

    ids: list[int | None]
    terms: list[list[int]]  # of each item, distinct places in the vocabulary
    vocabulary: dict[bytes, int]
    documents: int = 0
    length: int = 0
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))

    def tiles(self) -> list[tuple[int, int]]:
        """Ranges of the vocabulary whose sums stay under 2^53."""
        out, lo, total = [], 0, 0
        for t, w in enumerate(self.weights.tolist()):
            if t > lo and (t - lo >= TERMS or (total + w) * MOST_IMPACT >= 1 << 53):
                out.append((lo, t))
                lo, total = t, 0
            total += w
        return [*out, (lo, len(self.weights))] if len(self.weights) else []

    def matrix(self) -> np.ndarray:
        """terms x items: the term's weight where the item holds it."""
        m = np.zeros((len(self.vocabulary), len(self.ids)))
        for i, own in enumerate(self.terms):
            m[own, i] = self.weights[own]
        return m


def groups_of(items: DataFrame, cells: int = CELLS) -> Iterator[Items]:
    """Items with terms, in groups of at most ``ITEMS`` items and ``cells`` matrix cells (or one item)."""
    ids: list[int | None] = []
    terms: list[list[int]] = []
    vocabulary: dict[bytes, int] = {}
    rows = items.select(F.col("item_id").cast("long"), F.col("text").cast("string").cast("binary").alias("text")).orderBy("item_id", "text")
    for item_id, text in rows.toLocalIterator(prefetchPartitions=False):
        own = dict.fromkeys(terms_of(text))
        if not own:
            continue
        more = sum(t not in vocabulary for t in own)
        if ids and (len(ids) == ITEMS or (len(ids) + 1) * (len(vocabulary) + more) > cells):
            yield Items(ids, terms, vocabulary)
            ids, terms, vocabulary = [], [], {}
        ids.append(item_id)
        terms.append([vocabulary.setdefault(t, len(vocabulary)) for t in own])
    if ids:
        yield Items(ids, terms, vocabulary)


def with_statistics(docs: DataFrame, group: Items) -> Items:
    """N, L and the weights of the group's vocabulary, over all documents."""
    shared = docs.sparkSession.sparkContext.broadcast(group.vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, holders = shared.value, Counter()
        n_docs = n_terms = 0
        for b in batches:
            for t in b.column(0):
                words = terms_of(t.as_py())
                if words:
                    n_docs += 1
                    n_terms += len(words)
                    holders.update(place.keys() & set(words))
        rows = [(-2, n_docs), (-1, n_terms), *((place[w], n) for w, n in holders.items())]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=["what", "n"])

    counted = docs.select(F.col("text").cast("string").cast("binary")).mapInArrow(count, "what long, n long").groupBy("what").agg(
        F.sum("n").alias("n")).collect()  # two rows and one for each term of the group
    n = {r["what"]: r["n"] for r in counted}
    group.documents, group.length = n.get(-2, 0), n.get(-1, 0)
    group.weights = np.array([math.floor(1000 * math.log((2 * group.documents + 2) / (2 * n.get(t, 0) + 1)))
                              for t in range(len(group.vocabulary))], np.int64)
    shared.destroy()
    return group


class Ranking:
    """The k best documents of every item so far: larger scores first, then smaller ids."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.score = np.zeros((items, k), np.int64)  # 0: no document yet
        self.doc = np.zeros((items, k), np.int64)
        self.no_id = np.zeros((items, k), bool)

    def add(self, scores: np.ndarray, doc: np.ndarray, no_id: np.ndarray) -> None:
        """``scores``: documents x items."""
        worth = (scores > 0) & (scores >= self.score[:, -1])
        for i in np.nonzero(worth.any(axis=0))[0]:
            at = np.nonzero(worth[:, i])[0]
            s, d, x = (np.concatenate([a, b]) for a, b in ((self.score[i], scores[at, i]), (self.doc[i], doc[at]), (self.no_id[i], no_id[at])))
            best = np.lexsort((d, x, -s))[:self.k]
            self.score[i], self.doc[i], self.no_id[i] = s[best], d[best], x[best]


def impacts(counts: list[int], n: int, documents: int, length: int) -> list[int]:
    """Impact of terms that a document of ``n`` terms holds ``counts`` times."""
    m8 = 8 * (100 - 90 + (90 * n * documents) // length)
    return [(1_000_000_000 * tf) // (1000 * tf + m8) for tf in counts]


def tile_scores(row: np.ndarray, term: np.ndarray, impact: np.ndarray, n_rows: int, matrix: np.ndarray,
                tiles: list[tuple[int, int]]) -> np.ndarray:
    """documents x items: exact scores of a tile of documents from its (row, term, impact) entries."""
    scores = np.zeros((n_rows, matrix.shape[1]), np.int64)
    for lo, hi in tiles:
        own = (term >= lo) & (term < hi)
        if own.any():
            used, column = np.unique(term[own], return_inverse=True)
            dense = np.zeros((n_rows, len(used)))
            dense[row[own], column] = impact[own]
            scores += (dense @ matrix[used]).astype(np.int64)
    return scores


def _ranked_by_tasks(docs: DataFrame, group: Items, k: int) -> DataFrame:
    """``(item, doc_id, score)``: each task's k best of every item."""
    shared = docs.sparkSession.sparkContext.broadcast(group)
    n_items = len(group.ids)

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        matrix, tiles, place, best = own.matrix(), own.tiles(), own.vocabulary, Ranking(n_items, k)
        doc: list[int | None] = []
        row, term, impact = [], [], []

        def settle() -> None:
            if doc:
                scores = tile_scores(np.array(row, np.int64), np.array(term, np.int64), np.array(impact, np.float64), len(doc), matrix, tiles)
                best.add(scores, np.array([d or 0 for d in doc], np.int64), np.array([d is None for d in doc]))
            for x in (doc, row, term, impact):
                x.clear()

        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1)):
                words = terms_of(text.as_py())
                tf = Counter(words)
                held = [w for w in tf if w in place]
                if held:
                    row += [len(doc)] * len(held)
                    term += [place[w] for w in held]
                    impact += impacts([tf[w] for w in held], len(words), own.documents, own.length)
                    doc.append(doc_id)
                    if len(doc) == DOCS:
                        settle()
        settle()
        item, at = np.nonzero(best.score)
        yield pa.RecordBatch.from_arrays(
            [pa.array(item, pa.int32()), pa.array(best.doc[item, at], pa.int64(), mask=best.no_id[item, at]), pa.array(best.score[item, at])],
            names=["item", "doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").cast("binary")).mapInArrow(
        rank, "item int, doc_id long, score long")


def rank_documents(docs: DataFrame, items: DataFrame, k: int = K, cells: int = CELLS) -> DataFrame:
    """``item_id, rank, doc_id, score``: each item's k best documents with a score above 0."""
    require_columns(docs, ["doc_id", "text"])
    require_columns(items, ["item_id", "text"])
    spark = docs.sparkSession
    out = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    for group in groups_of(items, cells):
        group = with_statistics(docs, group)
        found = _ranked_by_tasks(docs, group, k).withColumn("salt", F.pmod(F.xxhash64("doc_id", "score"), F.lit(SALTS)))
        few = found.withColumn("rank", F.row_number().over(Window.partitionBy("item", "salt").orderBy(*order))).where(F.col("rank") <= k)
        ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= k)
        named = spark.createDataFrame(list(enumerate(group.ids)), "item int, item_id long")  # at most ``cells`` rows
        out = out.unionByName(ranked.join(F.broadcast(named), "item").select("item_id", "rank", "doc_id", "score"))
    return out
