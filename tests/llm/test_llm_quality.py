import random
import re
from collections import Counter

import pytest

from .llm_helpers import SF, clash
from hypothesis import given, settings
from hypothesis import strategies as st

from settleline.llm import quality as Q


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    times = Counter(grams)
    marked = {i + k for i, g in enumerate(grams) if times[g] > 1 for k in range(3)}
    lines = text.split("\n")
    dups = sum(bool(re.search(r"[^\x20\x09-\x0D]", ln)) and ln in lines[:i] for i, ln in enumerate(lines))
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dups, len(marked)


@given(st.one_of(st.none(), st.text(alphabet="ab \n\t\x0b\x1f é#|　", max_size=80)))
@settings(max_examples=300, deadline=None)
def test_counts(text):
    assert Q.base_counts(text) == brute(text)


def test_whole_table_and_base_rules(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    got = Q.quality_verdicts(docs).collect()
    assert len(got) == len(texts)
    for r in got:
        n, chars, symbols, dups, repeats = brute(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, dups, repeats)
        assert r.base_failed == (n < 50 or 100 * repeats > 50 * n)
        assert not (r.kept and r.base_failed)
    passing = [r for r in got if not r.base_failed]
    assert sum(r.kept for r in passing) > 0.9 * len(passing)


def test_measures():
    paths = Q.vocabulary_paths()
    sp, is_byte, bpe = Q.processors(paths)
    text = "the cat and the dog and the bird"
    ids = sp.encode(text)
    chars, share, entropy, bpe_chars = Q.fertility(text, paths)
    assert chars == len(text) / len(ids) and share == 0 and 0 < entropy <= 1 and bpe_chars == len(text) / len(bpe.encode_ordinary(text))
    assert Q.fertility("\U0001F9FF\U0001F9EC", paths)[1] > 0.5
    assert Q.fertility(None, paths) == Q.fertility("", paths) == (0.0, 0.0, 0.0, 0.0)
    long = " ".join(["the cat sat on the mat"] * 60_000)
    assert abs(Q.fertility(long, paths)[0] - len(long) / len(sp.encode(long))) < 0.01


def quartile(values, q):
    """The least value that a share q of all values doesn't exceed."""
    values = sorted(values)
    return values[max(0, -(-int(q * 100) * len(values) // 100) - 1)]


def verdicts(rows):
    """``kept`` worked out from the measures alone: bands of languages drawn toward their main script."""
    passing = [r for r in rows if not r["base_failed"]]

    def quartiles(of):
        return {m: [quartile([r[m] for r in of], q) for q in (0.25, 0.75)] for m in Q.MEASURES}

    scripts = {s: quartiles([r for r in passing if r["script"] == s]) for s in {r["script"] for r in passing}}
    limits = {(None, s): q for s, q in scripts.items()}
    for lang in {r["lang"] for r in passing if r["lang"] is not None}:
        own = [r for r in passing if r["lang"] == lang]
        main = max(Counter(r["script"] for r in own).items(), key=lambda x: (x[1], x[0]))[0]
        w, q = len(own) / (len(own) + Q.SUPPORT), quartiles(own)
        limits[lang, None] = {m: [w * a + (1 - w) * b for a, b in zip(q[m], scripts[main][m])] for m in Q.MEASURES}
    out = []
    for r in rows:
        q = limits.get((r["lang"], None) if r["lang"] is not None else (None, r["script"]))
        kept = q is not None and not r["base_failed"]
        for m in Q.MEASURES if kept else ():
            room = max((q[m][1] - q[m][0]) * Q.WIDTH, Q.LEAST_WIDTH[m])
            kept &= q[m][0] - room <= r[m] <= q[m][1] + room
        out.append((r["doc_id"], kept))
    return sorted(out, key=str)


def test_kept_equals_bands_by_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [r.asDict() for r in Q.measured(docs).withColumn("base_failed", Q.base_failed()).collect()]
    got = sorted(((r.doc_id, r.kept) for r in Q.quality_verdicts(docs).collect()), key=str)
    assert got == verdicts(rows) and 0 < sum(k for _, k in got) < len(got)


@pytest.mark.parametrize("labelled", [True, False])
def test_a_small_language_beside_a_large_one(spark, make_docs, sf_docs, labelled):
    """Clean texts of a script that the vocabulary lacks stay, however few they are."""
    rng = random.Random(7)
    words = [w for r in sf_docs.where("lang = 'en'").limit(40).collect() for w in (r.text or "").split()]
    letters = [chr(c) for c in range(0x10D0, 0x10F1)]
    georgian = ["".join(rng.choices(letters, k=rng.randint(2, 9))) for _ in range(3000)]
    latin = [(i, " ".join(rng.choices(words, k=rng.randint(80, 300))), "en") for i in range(300)]
    small = [(5000 + i, " ".join(rng.choices(georgian, k=rng.randint(80, 300))), "ka" if labelled else None) for i in range(250)]
    for n in (1, 5, 99, 100, 250):
        got = {r.doc_id: r.kept for r in Q.quality_verdicts(make_docs(*latin, *small[:n])).collect()}
        assert sum(not got[5000 + i] for i in range(n)) <= n // 50, n
        assert sum(not got[i] for i in range(300)) <= 3


def test_script():
    assert Q.script("abc déf") == "LATIN" and Q.script("привет мир") == "CYRILLIC" and Q.script("12 34") == "none" and Q.script(None) == "none"


def test_outliers_go_and_the_rest_stays(spark, make_docs, sf_docs):
    import base64
    rng = random.Random(2)
    words = [w for r in sf_docs.where("lang = 'en'").limit(40).collect() for w in (r.text or "").split()]
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(80, 400))), "en") for i in range(300)]
    rows += [(1000 + i, " ".join(base64.b64encode(rng.randbytes(30)).decode() for _ in range(60)), "en") for i in range(5)]
    rows += [(2000, " ".join("\U0001F9FF\U0001F9EC\u16a0"[rng.randrange(3)] * 3 + str(k) for k in range(80)), "en")]
    got = {r.doc_id: r for r in Q.quality_verdicts(make_docs(*rows)).collect()}
    assert sum(got[i].kept for i in range(300)) >= 297
    assert not any(got[i].kept for i in got if i >= 1000)
    assert not any(got[i].base_failed for i in got if i >= 1000)


def test_odd_rows(spark, make_docs):
    docs = clash(make_docs((1, None), (2, ""), (None, "a b c " * 30), (3, "word"), (3, "word"), (4, "один два три " * 4000, None)))
    got = Q.quality_verdicts(docs).collect()
    assert len(got) == 6 and not any(r.kept for r in got) and all(r.base_failed for r in got)
    assert {r.doc_id: r.language for r in got}[4] == "script:CYRILLIC"
    assert Q.quality_verdicts(make_docs()).count() == 0
    assert Q.quality_verdicts(make_docs((1, "x")).drop("lang")).count() == 1
