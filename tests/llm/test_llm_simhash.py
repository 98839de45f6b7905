import random

import numpy as np
import xxhash
from .llm_helpers import clash

from settleline.llm import simhash as S


def brute_fingerprint(text):
    import re
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hs = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hs) * 2 > len(hs))


def brute_components(fps):
    """Least index reachable over links of at most two bits."""
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    x = np.array(fps, dtype=np.uint64)
    for i in range(len(x)):
        for j in np.nonzero(np.bitwise_count(x ^ x[i]) <= 2)[0]:
            a, b = find(i), find(int(j))
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def test_fingerprints():
    for t in ["", None, "one", "one two", "A b C d", "Ä a b  c\x0bd\x1fe", "repeat me now " * 40, "z " * 200_000]:
        assert S.fingerprint(t) == brute_fingerprint(t)


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = sorted(S.simhash_groups(docs).collect(), key=lambda r: r.doc_id)
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    assert [r.fingerprint for r in got] == [f"{brute_fingerprint(texts[r.doc_id]):016x}" for r in got]
    want = brute_components([int(r.fingerprint, 16) for r in got])
    assert [r.component_id for r in got] == [got[i].doc_id for i in want]


def links_of(spark, fps):
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    links = S.link_fingerprints(spark.createDataFrame([(x,) for x in signed], "fp long"))
    comp = {r.node: r.component for r in S.connected_components(links).collect()}
    return [comp.get(x, x) for x in signed]


def same_partition(a, b):
    return len(set(zip(a, b))) == len(set(a)) == len(set(b))


def test_links_match_brute_force(spark, monkeypatch):
    rng = random.Random(5)
    fps = set()
    for _ in range(12):  # crowds around a centre and chains away from it, as well as lone ones
        centre = rng.getrandbits(64)
        for _ in range(60):
            x = centre
            for b in rng.sample(range(64), rng.randint(0, 3)):
                x ^= 1 << b
            fps.add(x)
        fps.add(rng.getrandbits(64))
    fps = sorted(fps | {0, (1 << 64) - 1, 3, 1 << 63})
    want = brute_components(fps)
    assert same_partition(links_of(spark, fps), want)
    monkeypatch.setattr(S, "PAIR_LIMIT", 2)  # nearly all keys go the way for crowded ones
    assert same_partition(links_of(spark, fps), want)


def test_pigeonring_keeps_every_pair_within_two_bits():
    rng = random.Random(6)
    for _ in range(300):
        diff = sum(1 << b for b in rng.sample(range(64), rng.randint(0, 2)))
        assert any(all(bin(diff & (S.chain_mask(s, n) % (1 << 64))).count("1") <= n * 2 // S.SEGMENTS for n in range(1, S.SEGMENTS + 1))
                   for s in range(S.SEGMENTS))


def test_odd_rows(spark, make_docs):
    docs = clash(make_docs((5, None), (4, ""), (3, " \t"), (2, "a b c d"), (2, "a b c d"), (9, "A B  C\nd"), (None, "a b c d"), (None, "only me here"),
                           (7, "w " * 100_000)))
    got = S.simhash_groups(docs).collect()
    assert sorted((r.doc_id or -1, r.component_id or -1) for r in got) == [(-1, -1), (-1, 2), (2, 2), (2, 2), (3, 3), (4, 3), (5, 3), (7, 7), (9, 2)]
    assert {r.fingerprint for r in got if r.doc_id in (3, 4, 5)} == {"0" * 16}
    kept = S.keep_one_per_group(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or -1, r.text) for r in kept.collect()) == [(-1, "only me here"), (2, "a b c d"), (3, " \t"), (7, "w " * 100_000)]
    assert S.simhash_groups(make_docs()).count() == 0 and S.keep_one_per_group(make_docs()).count() == 0
