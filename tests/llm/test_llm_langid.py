import random

import numpy as np
import pytest
from .llm_helpers import clash

from pyspark.sql import functions as F

from settleline.llm import langid as L


def net(n_langs=3):
    rng = np.random.default_rng(0)
    return L.ByteConvNet.fresh([f"l{i}" for i in range(n_langs)], rng)


def test_tables_answer_as_the_filters_do():
    model, rng = net(), np.random.default_rng(1)
    x = rng.integers(0, 256, (5, L.WINDOW)).astype(np.uint8)
    e = model.embed[x]
    pooled = [np.max([sum(e[:, i + o] @ f[o] for o in range(w)) for i in range(L.WINDOW - w + 1)], axis=0) for w, f in model.filters.items()]
    want = L.softmax(np.maximum(np.concatenate(pooled, axis=1) + model.bias, 0) @ model.dense + model.dense_bias)
    assert np.allclose(model.predict(x, model.tables()), want, atol=1e-5)


def test_gradients_against_differences():
    model, rng = net(), np.random.default_rng(2)
    model = L.ByteConvNet(model.langs, model.embed.astype(float), {w: f.astype(float) for w, f in model.filters.items()},
                          model.bias.astype(float), model.dense.astype(float), model.dense_bias.astype(float))
    x = rng.integers(0, 256, (4, 40)).astype(np.uint8)
    y = np.array([0, 1, 2, 1])

    def loss():
        e = model.embed[x]
        pooled = [np.max([sum(e[:, i + o] @ f[o] for o in range(w)) for i in range(40 - w + 1)], axis=0) for w, f in model.filters.items()]
        p = L.softmax(np.maximum(np.concatenate(pooled, axis=1) + model.bias, 0) @ model.dense + model.dense_bias)
        return -np.log(p[np.arange(4), y]).mean()

    for p, g in zip(model.params(), model.gradients(x, y)):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        old, step = p[at], 1e-6
        p[at] = old + step
        up = loss()
        p[at] = old - step
        down = loss()
        p[at] = old
        assert (up - down) / (2 * step) == pytest.approx(g[at], rel=1e-3, abs=1e-6)


def test_windows_cover_every_byte():
    for n in (0, 1, L.WINDOW, L.WINDOW + 1, 1000, 12345):
        data = bytes(random.Random(n).randbytes(n))
        rows, lengths = L.windows_of(data)
        stride = L.WINDOW - max(L.WIDTHS) + 1
        assert all(rows[i, :m].tobytes() == data[i * stride:i * stride + m] for i, m in enumerate(lengths))
        assert (len(rows) - 1) * stride + lengths[-1] == n


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = L.language_of_documents(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out AND lang IS NOT NULL").toPandas()
    assert len(got) > 100
    assert (got.lang == got.lang_pred).mean() > 0.97


def test_odd_rows(spark, make_docs):
    rows = [(i, "the and of the and with " * 5, "en") for i in range(30)] + [(100 + i, "und der die das ist nicht " * 5, "de") for i in range(30)]
    rows += [(None, "und der die das", None), (200, None, "en"), (201, "", "en"), (202, "12345 !!", "de"), (203, "der die " * 40000, None), (203, "der die " * 40000, None)]
    docs = make_docs(*rows)
    got = {r.doc_id: r for r in L.language_of_documents(docs).collect()}
    assert L.language_of_documents(docs).count() == len(rows)
    assert [got[i].lang_pred for i in (200, 201, 202)] == ["und"] * 3
    assert [got[i].score for i in (200, 201, 202)] == [0.0] * 3
    assert got[203].lang_pred == "de" and got[None].lang_pred == "de" and got[None].held_out
    assert all(0 <= r.score <= 1 for r in got.values())
    kept = L.keep_identified(clash(docs))
    assert kept.columns == clash(docs).columns
    assert {r.doc_id for r in kept.collect()} == {r[0] for r in rows} - {200, 201, 202}
    assert {r.score for r in kept.collect()} == {7}


def test_nothing_to_learn(spark, make_docs):
    assert L.language_of_documents(make_docs()).count() == 0
    assert [r.lang_pred for r in L.language_of_documents(make_docs((0, "some words", None))).collect()] == ["und"]


def test_labels_are_no_input(spark, make_docs):
    rows = [(i, "the and of the and with " * 5, "en") for i in range(30)] + [(100 + i, "und der die das ist nicht " * 5, "de") for i in range(30)]
    model = L.learn(make_docs(*rows))
    one = L.identify(make_docs((1, "und der die", "en"), (2, "und der die", None)), model).collect()
    assert one[0].lang_pred == one[1].lang_pred and one[0].score == one[1].score


def test_every_label_is_learnt(spark, make_docs, monkeypatch):
    rows = [(i, f"text number {i} " * 5, f"l{i % 90:02d}") for i in range(900)]
    _, langs = L.training_sample(make_docs(*rows), F.lit(True))
    assert set(langs) == {f"l{k:02d}" for k in range(90)}
    monkeypatch.setattr(L, "SAMPLE", 100)
    texts, langs = L.training_sample(make_docs(*rows), F.lit(True), windows_per_text=2)
    assert set(langs) == {f"l{k:02d}" for k in range(90)} and len(texts) <= 2 * 90 * 2
