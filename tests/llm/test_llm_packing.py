import zlib

import numpy as np
from .llm_helpers import clash
from hypothesis import given, settings
from hypothesis import strategies as st

from tokenizers import Tokenizer

from settleline.llm import packing as P


@given(st.lists(st.integers(1, 64), max_size=300))
@settings(max_examples=80, deadline=None)
def test_best_fit_bins(sizes):
    sizes = np.array(sizes, np.int64)
    bins, at, fills = P.best_fit(sizes, 64)
    for b in range(len(fills)):
        own = sorted((int(a), int(s)) for a, s, k in zip(at, sizes, bins) if k == b)
        assert sum(s for _, s in own) == fills[b] <= 64
        end = 0
        for a, s in own:
            assert a == end
            end += s
    # best-fit decreasing by search over all open bins
    free = []
    for s in sorted(sizes, reverse=True):
        fits = [f for f in free if f >= s]
        if fits:
            free[free.index(min(fits))] -= s
        else:
            free.append(64 - s)
    assert len(free) == len(fills)


@given(st.integers(1, 9000))
def test_cuts(n):
    parts = P.cuts(n)
    assert sum(m for _, m in parts) == n and all(m <= 1024 for _, m in parts)
    assert all(m == 1024 for _, m in parts[1:]) and [s for s, _ in parts] == list(np.cumsum([0] + [m for _, m in parts[:-1]]))
    assert (len(parts) == 1) == (n <= 1024)


ODD = ["a <|endoftext|> b", "<|endoftext|>" * 3 + "x" * 3000, "<|endoftext", "", " ", "a", "\n\n\t  x", "<|endoftext|> inside", "don't you'll I'M", "naïve Ünïcödé 漢字 かな 한국어 🙂🙃", "x" * 5000, " " * 3000 + "y",
       "1234567890 ½ ² Ⅻ", "​﻿ z", "a\x00b\x1f", "ﬀ ǅ ß", "\r\n\r\n", "🏳️‍🌈" * 50]


def test_ids_are_those_of_tokenizers(spark, sf_docs):
    paths = P.vocabulary_paths()
    slow = Tokenizer.from_file(paths[0])  # as it comes: added tokens in a text are found
    assert len(P.token_ids("a <|endoftext|> b", paths)) == 5 and 50256 in P.token_ids("a <|endoftext|> b", paths)
    texts = [r.text or "" for r in sf_docs.select("text").collect()] + ODD
    for t in texts:
        assert P.token_ids(t, paths)[:-1].tolist() == slow.encode(t, add_special_tokens=False).ids


def check(out, docs):
    paths = P.vocabulary_paths()
    want = []
    for r in docs.collect():
        ids = P.token_ids(r.text, paths)
        want += [(r.doc_id, k, s, n, zlib.crc32(ids[s:s + n].tobytes())) for k, (s, n) in enumerate(P.cuts(len(ids)))]
    rows = out.collect()
    key = lambda x: (x[0] is None, x[0] or 0, x[1], x[4])
    assert sorted([(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows], key=key) == sorted(want, key=key)
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        end = 0
        for at, n in sorted(places):
            assert at == end
            end += n
        assert end <= 1024
    return len(by), sum(r.length for r in rows)


def test_sequences_are_gapless_and_nearly_full(spark, sf_docs):
    n, tokens = check(P.pack(sf_docs.repartition(7)), sf_docs)
    assert n <= 1.03 * -(-tokens // 1024)


def test_small_blocks_and_a_deep_tree(spark, sf_docs):
    docs = sf_docs.repartition(24)
    n, tokens = check(P.pack(docs, block=9, fan_in=2), docs)
    assert n <= 1.15 * -(-tokens // 1024)


def test_items_too_large_to_share(spark, make_docs):
    docs = make_docs(*[(i, "word " * 700) for i in range(40)]).repartition(8)
    n, _ = check(P.pack(docs), docs)
    assert n == 40


def test_odd_rows(spark, make_docs):
    docs = clash(make_docs((1, None), (1, ""), (2, "a"), (2, "a"), (None, "b"), (3, "long " * 30000)))
    check(P.pack(docs), docs)
    assert P.pack(make_docs()).count() == 0


def test_ids_come_along(spark, make_docs):
    for r in P.pack(make_docs((1, "some words here"), (2, "more " * 2000)), with_ids=True).collect():
        assert len(r.ids) == r.length and zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32
