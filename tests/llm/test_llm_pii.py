import hashlib
import itertools
import re

import numpy as np
import pytest

from settleline.llm import pii

from .llm_helpers import SF, clash

#: The patterns as they stand, searched from left to right.
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


@pytest.fixture(scope="module")
def model():
    return pii.trained()


def plain_luhn(d):
    s = [int(c) for c in d[::-1]]
    return (sum(s[0::2]) + sum(sum(divmod(2 * x, 10)) for x in s[1::2])) % 10 == 0


def plain(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            ok = {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m.group().split(".")),
                  "card": 14 <= len(digits) <= 19 and plain_luhn(digits), "phone": 10 <= len(digits) <= 15}[kind]
            if ok:
                out.append((kind, m.start(), m.end()))
    return sorted(out, key=lambda s: (s[1], list(PLAIN).index(s[0])))


def test_base_spans_equal_the_plain_patterns():
    rng = np.random.default_rng(4)
    alphabet = list("a.@-+ 0123456789()1.1.@a") + ["256.", "255", " 4111111111111111", "x@y.z", "+1 (555) 010-9999", "é", "\n"]
    for _ in range(4000):
        text = "".join(rng.choice(alphabet, rng.integers(0, 40)))
        assert pii.base_spans(text) == plain(text), text
    for text in ("a@b@c.de", "a@b.c@d.e", "@a.b", "1.2.3.4.5.6.7.8", "0000000255.1.1.1", "4111 1111-1111 1111", "é@b.cd", "+1 (555) 010-9999."):
        assert pii.base_spans(text) == plain(text), text


def test_base_spans_of_the_table(spark):
    for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect():
        if r["text"]:
            assert pii.base_spans(r["text"]) == plain(r["text"])


def test_long_runs_take_linear_time(model):
    for text in ("1" * 400_000, "a" * 400_000, "1." * 200_000, "1 " * 50_000, "+" * 200_000, "+1" * 20_000, "@" * 100_000, "a@" * 50_000, "::" * 20_000):
        pii.base_spans(text)
    base, every = pii.spans_of("12 " * 3000 + "call 555-123-4567 " + "word " * 20_000, model)
    assert any(k == "phone" and a >= 9000 for k, a, _ in every)


def segmentations(n, found):
    """All ways to cut tokens 0..n into outside tokens and candidates."""
    by = {}
    for c in found:
        by.setdefault(c[0], []).append(c)

    def go(t):
        if t == n:
            yield []
            return
        for rest in go(t + 1):
            yield [(t, t + 1, None), *rest]
        for c in by.get(t, ()):
            for rest in go(c[1]):
                yield [c, *rest]

    return go(0)


def worth(model, tokens, segments):
    label, total = 0, 0.0
    for i, j, kind in segments:
        k = 0 if kind is None else pii.KINDS.index(kind) + 1
        total += model.moves[label, k] + (model.score(kind, tokens, i, j) if kind else 0.0)
        label = k
    return total


TEXTS = ("tel 555-123-4567", "a (at) b.com 1", "4111/1111/1111/1111 0", "fe80::1:2 x", "10[.]0[.]0[.]7")


@pytest.mark.parametrize("text", TEXTS)
def test_viterbi_finds_the_best_of_all_segmentations(model, text):
    tokens, _ = pii.tokens_of(text, 0, len(text))
    found = list(pii.candidates(tokens, [False] * len(tokens)))
    assert found
    best = max(worth(model, tokens, s) for s in segmentations(len(tokens), found))
    got = model.decode(tokens, found, len(tokens))
    whole, t = [], 0
    for i, j, kind in [*got, (len(tokens), len(tokens), None)]:
        whole += [(x, x + 1, None) for x in range(t, i)] + ([(i, j, kind)] if kind else [])
        t = j
    assert worth(model, tokens, whole) == pytest.approx(best)


def test_likelihood_and_its_gradient_by_enumeration():
    rng = np.random.default_rng(2)
    lengths, rows = [5, 3, 4], [(0, 1, 3, 1), (0, 1, 4, 2), (0, 3, 5, 1), (0, 0, 1, 3), (1, 0, 3, 4), (2, 1, 2, 1), (2, 2, 4, 2), (2, 2, 4, 1)]
    score, moves = rng.normal(size=len(rows)), rng.normal(size=(5, 5))
    z, p, moved = pii.Lattices(lengths, rows).expected(score, moves)
    want_z, want_p, want_moved = 0.0, np.zeros(len(rows)), np.zeros((5, 5))
    for e, n in enumerate(lengths):
        own = [(i, j, r) for r, (x, i, j, _) in enumerate(rows) if x == e]
        totals, uses, pairs = [], [], []
        for s in segmentations(n, own):
            label, total, used, pair = 0, 0.0, np.zeros(len(rows)), np.zeros((5, 5))
            for i, j, r in s:
                k = 0 if r is None else rows[r][3]
                total += moves[label, k] + (0.0 if r is None else score[r])
                pair[label, k] += 1
                if r is not None:
                    used[r] += 1
                label = k
            totals.append(total)
            uses.append(used)
            pairs.append(pair)
        weight = np.exp(totals)
        want_z += np.log(weight.sum())
        want_p += (weight[:, None] * np.array(uses)).sum(axis=0) / weight.sum()
        want_moved += (weight[:, None, None] * np.array(pairs)).sum(axis=0) / weight.sum()
    assert z == pytest.approx(want_z) and np.allclose(p, want_p) and np.allclose(moved, want_moved)


def test_accuracy_on_held_out_sentences(model):
    right = found = marked = 0
    for tokens, entities in pii.made(600, seed=99):
        got = model.decode(tokens, list(pii.candidates(tokens, [False] * len(tokens))), len(tokens))
        right += len(set(got) & set(entities))
        found += len(got)
        marked += len(entities)
    assert right / found > 0.9 and right / marked > 0.85, (right, found, marked)


def test_forms_that_the_patterns_miss(model):
    cases = [("write to jane.doe (at) mail.example.com now", "email", "jane.doe (at) mail.example.com"),
             ("host 10[.]20[.]30[.]40 is down", "ip", "10[.]20[.]30[.]40"), ("call (555) 123-4567 today", "phone", "(555) 123-4567"),
             ("from 2001:db8:0:0:1:0:0:1 again", "ip", "2001:db8:0:0:1:0:0:1"), ("card 4111.1111.1111.1111 paid", "card", "4111.1111.1111.1111")]
    for text, kind, want in cases:
        base, every = pii.spans_of(text, model)
        assert not base and [(k, text[a:b]) for k, a, b in every] == [(kind, want)], (text, every)


def test_plain_text_is_left_alone(model):
    for text in ("Licensed under CC BY-NC 4.0.", "GNU General Public License, version 3.", "In 1999-2004 we sold 1,234,567 units at 12.50.", "2024-01-02 10:20:30",
                 'token = "254ca002228af484f2d1"', "4111111111111112", "Version 2.0 of 2024", "the at of dot thing", "", "no digits here"):
        assert pii.spans_of(text, model) == ([], []), text


def test_clean_documents_of_the_table_are_left_alone(spark, model):
    texts = [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect() if r["text"]]
    clean = [t for t in texts if not pii.base_spans(t)]
    assert len(clean) > 50 and sum(bool(pii.spans_of(t, model)[1]) for t in clean) <= len(clean) // 100


def test_long_texts_are_decoded_in_parts(model, monkeypatch):
    rng = np.random.default_rng(8)
    maker = pii.Maker(5)
    pieces = []
    for _ in range(120):
        pieces.append(maker.pick(maker.email, maker.ip, maker.phone, maker.look_alike, maker.word)())
    text = " word ".join(pieces) + "\n" + " ".join(map(str, rng.integers(0, 99, 300)))
    whole = pii.spans_of(text, model)
    monkeypatch.setattr(pii, "PART", 40)
    assert pii.spans_of(text, model) == whole
    assert whole[1]


def test_added_spans_keep_off_base_spans(model):
    text = "mail a.b@c.org, call +1 (555) 010-9999 or (555) 123-4567, ip 1.2.3.4:80 4111 1111 1111 1111"
    base, every = pii.spans_of(text, model)
    assert base == plain(text) and set(base) <= set(every)
    for x, y in itertools.product(set(every) - set(base), base):
        assert x[2] <= y[1] or y[2] <= x[1]


def test_rows_of_a_frame(spark, make_docs, model):
    docs = make_docs((1, None), (2, ""), (3, "x a@b.cd y +1 (555) 010-9999"), (3, "x a@b.cd y +1 (555) 010-9999"), (None, "ip 1.2.3.4"), (4, "é a@b.cd"))
    rows = sorted(map(tuple, pii.find_spans(clash(docs), model).collect()), key=str)
    none = hashlib.sha256(b"").hexdigest()

    def digest(s):
        return hashlib.sha256(s.encode()).hexdigest()

    assert rows == sorted([(1, 0, 0, 0, 0, none, "", 0), (2, 0, 0, 0, 0, none, "", 0)]
                          + 2 * [(3, 1, 0, 0, 1, digest("email:2:8,phone:11:28"), "email:2:8,phone:11:28", 0)]
                          + [(None, 0, 1, 0, 0, digest("ip:3:10"), "ip:3:10", 0), (4, 1, 0, 0, 0, digest("email:2:8"), "email:2:8", 0)], key=str)
    assert pii.find_spans(make_docs(), model).collect() == []


def test_redact(spark, make_docs, model):
    docs = clash(make_docs((1, "mail a@b.cd now"), (2, None), (3, "nothing")))
    out = pii.redact(docs, model)
    assert out.schema == docs.schema
    assert [r["text"] for r in out.orderBy("doc_id").collect()] == ["mail [email] now", None, "nothing"]
    assert pii.masked("abcdef", [("ip", 1, 3), ("card", 2, 5)]) == "a[ip]f"
