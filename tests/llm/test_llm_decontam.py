import random
from collections import Counter

from .llm_helpers import clash

from settleline.llm import decontam as D


def test_block_max_wand_returns_all_at_the_threshold():
    rng = random.Random(1)
    items = [(i, " ".join(rng.choice([f"w{k}" for k in range(40)]) for _ in range(rng.randint(3, 30)))) for i in range(400)]
    df = Counter(w for _, t in items for w in set(D.words_of(t)))
    index = D.build_index(items, 400, sum(len(D.words_of(t)) for _, t in items) / 400, df)
    for _ in range(150):
        terms = rng.sample(range(len(index.postings)), rng.randint(1, 25))
        threshold = rng.choice([0.2, 0.4, 0.6, 0.8])
        scores = Counter()
        for t in terms:
            p = index.postings[t]
            for i, w in zip(p.items, p.weights):
                scores[i] += w
        got = dict(D.block_max_wand([index.postings[t] for t in terms], threshold))
        assert set(got) == {i for i, v in scores.items() if v >= threshold - 1e-9}
        assert all(abs(got[i] - scores[i]) < 1e-9 for i in got)


def test_whole_items_are_found_and_nothing_else(spark):
    sf = "/root/testdata/sf0.01"
    docs, bench = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    got = {(r.doc_id, r.item_id) for r in D.contaminated(docs, bench).collect()}
    items = bench.collect()
    want = set()
    for r in docs.select("doc_id", "text").collect():
        words = D.words_of(r.text)
        for i in items:
            q, a = D.split_item(i.text)
            if D.overlap(q, words) >= D.OVERLAP and (D.overlap(a, words) >= D.OVERLAP or D.overlap(q + a, words) >= D.OVERLAP):
                want.add((r.doc_id, i.item_id))
    assert got == want and want


def test_shards_give_the_same(spark):
    sf = "/root/testdata/sf0.001"
    docs, bench = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    one = {(r.doc_id, r.item_id, round(r.score, 6)) for r in D.contaminated(docs, bench).collect()}
    many = {(r.doc_id, r.item_id, round(r.score, 6)) for r in D.contaminated(docs, bench, shard_bytes=1500).collect()}
    assert one == many


def test_split_item():
    assert D.split_item("What is two and two? Answer: four") == (["what", "is", "two", "and", "two"], ["four"])
    assert D.split_item("First one. Second two! Third.") == (["first", "one", "second", "two"], ["third"])
    assert D.split_item("Just one sentence.") == (["just", "one", "sentence"], [])


def test_item_across_passages_and_small_edits(spark, make_docs):
    rng = random.Random(3)
    item = " ".join(f"q{rng.randint(0, 10 ** 6)}" for _ in range(50)) + ". " + " ".join(f"a{i}" for i in range(8)) + "."
    bench = spark.createDataFrame([(1, item), (2, None), (3, ""), (None, "some other thing that nobody has. Or has one?")], "item_id long, text string")
    filler = lambda n: " ".join(f"f{rng.randint(0, 10 ** 6)}" for _ in range(n))
    edited = item.split()
    edited[20] = "changed"
    rows = [(i, f"{filler(n)} {item} {filler(90)}") for i, n in enumerate((0, 1, 30, 63, 64, 65, 100, 127, 128, 1000))]
    rows += [(50, filler(80) + " " + " ".join(edited)), (60, filler(300)), (61, None), (62, ""), (63, " ".join(item.split()[:25])), (None, item), (64, filler(60000) + item)]
    docs = clash(make_docs(*rows))
    found = {r.doc_id for r in D.contaminated(docs, bench).collect()}
    assert found == {*range(10), 50, None, 64}
    kept = D.keep_uncontaminated(docs, bench)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [60, 61, 62, 63]


def test_empty_tables(spark, make_docs):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert D.contaminated(make_docs((1, "words")), bench).count() == 0
    assert D.keep_uncontaminated(make_docs((1, "words")), bench).count() == 1
    assert D.contaminated(make_docs(), spark.createDataFrame([(1, "a b c")], "item_id long, text string")).count() == 0
