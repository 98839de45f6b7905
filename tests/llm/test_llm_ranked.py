import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from settleline.llm import ranked

from .llm_helpers import SF, clash

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ITEMS = "item_id long, text string"


def terms(text):
    return [t.translate(LOWER) for t in TERM.findall(text)] if text else []


def brute(docs, items, k=10):
    docs = [(i, terms(t)) for i, t in docs]
    docs = [(i, w) for i, w in docs if w]
    count, length = len(docs), sum(len(w) for _, w in docs)
    df = Counter(t for _, w in docs for t in set(w))
    out = []
    for item_id, text in items:
        own = set(terms(text))
        found = []
        for i, words in docs:
            tf, m = Counter(words), 100 - 90 + (90 * len(words) * count) // length
            s = sum(math.floor(1000 * math.log((2 * count + 2) / (2 * df[t] + 1))) * ((1000000000 * tf[t]) // (1000 * tf[t] + 8 * m))
                    for t in own if t in tf)
            if s > 0:
                found.append((-s, i is None, i or 0))
        out += [(item_id, n + 1, None if x else i, -s) for n, (s, x, i) in enumerate(sorted(found)[:k])]
    return sorted(out, key=str)


def run(spark, docs, items, parts=3, **kw):
    d = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, source string").repartition(parts)
    return sorted((tuple(r) for r in ranked.rank_documents(d, spark.createDataFrame(items, ITEMS), **kw).collect()), key=str)


def test_equals_brute_force_on_the_tables(spark):
    docs, items = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    d = [(r["doc_id"], r["text"]) for r in docs.collect()]
    i = [(r["item_id"], r["text"]) for r in items.collect()]
    for parts in (1, 6):
        out = ranked.rank_documents(clash(docs.repartition(parts)), clash(items))
        assert sorted((tuple(r) for r in out.collect()), key=str) == brute(d, i)


def test_ties_nulls_and_repeats(spark):
    docs = [(i, "alpha beta") for i in range(40, 0, -1)] + [(None, "alpha beta"), (7, "alpha beta"), (50, None), (51, ""), (52, "-- !"),
            (53, "ALPHA alpha ä"), (None, None), (54, "gamma")]
    items = [(1, "Alpha, beta?"), (1, "Alpha, beta?"), (2, "gamma gamma"), (3, None), (4, "..."), (5, "unheard"), (None, "Ä ä"), (6, "alpha")]
    for parts in (1, 5):
        out = run(spark, docs, items, parts)
        assert out == brute(docs, items)
    assert [r[2] for r in out if r[0] == 2] == [54]


def test_all_documents_where_there_are_fewer_than_k(spark):
    docs = [(None, "one two"), (2, "two one"), (1, "two three"), (9, "four")]
    out = run(spark, docs, [(1, "one two")], k=3)
    assert out == brute(docs, [(1, "one two")], k=3) and len(out) == 3


def test_items_in_groups(spark):
    docs = [(i, " ".join(f"w{(i * j) % 31}" for j in range(1, 3 + i % 9))) for i in range(80)]
    items = [(i, " ".join(f"w{(i + j) % 31}" for j in range(7))) for i in range(12)]
    want = brute(docs, items)
    assert run(spark, docs, items, cells=20) == want
    assert run(spark, docs, items) == want


def test_tiles_keep_sums_under_2_53(monkeypatch):
    rng = np.random.default_rng(3)
    n, v, items = 7, 300, 5
    group = ranked.Items(list(range(items)), [sorted(rng.choice(v, 200, replace=False).tolist()) for _ in range(items)],
                         {str(t).encode(): t for t in range(v)}, 10, 10, rng.integers(1 << 27, 1 << 28, v))
    tiles = group.tiles()
    assert tiles[0][0] == 0 and tiles[-1][1] == v and all(a[1] == b[0] for a, b in zip(tiles, tiles[1:])) and len(tiles) > 5
    assert all(int(group.weights[a:b].sum()) * ranked.MOST_IMPACT < 1 << 53 for a, b in tiles)
    dense = rng.integers(0, ranked.MOST_IMPACT + 1, (n, v))
    row, term = np.nonzero(dense)
    got = ranked.tile_scores(row, term, dense[row, term].astype(np.float64), n, group.matrix(), tiles)
    for d in range(n):
        for i in range(items):
            assert got[d, i] == sum(int(dense[d, t]) * int(group.weights[t]) for t in group.terms[i])
    monkeypatch.setattr(ranked, "TERMS", 13)
    assert (ranked.tile_scores(row, term, dense[row, term].astype(np.float64), n, group.matrix(), group.tiles()) == got).all()


def test_long_texts_and_empty_tables(spark):
    long = "needle " * 3 + "hay " * 300_000
    docs = [(1, long), (2, "needle"), (3, "hay")]
    assert run(spark, docs, [(1, "needle hay")]) == brute(docs, [(1, "needle hay")])
    assert run(spark, [], [(1, "needle")]) == [] and run(spark, docs, []) == [] and run(spark, [(1, None)], [(1, "a")]) == []


def test_missing_columns(spark):
    with pytest.raises(ValueError):
        ranked.rank_documents(spark.range(3), spark.createDataFrame([], ITEMS))
    d = spark.createDataFrame([(1, "a b")], "doc_id int, text string").withColumn("item", F.lit(3))
    assert ranked.rank_documents(d, spark.createDataFrame([(1, "a")], ITEMS)).columns == ["item_id", "rank", "doc_id", "score"]
