"""Language identification with a byte convolutional network.

Network: a byte embedding, filters of several widths over it, ReLU and max
pooling over a fixed-length window, one dense layer, softmax.  It is trained in
numpy (Adam on cross-entropy, gradients written out below) on windows of
labelled texts.  A text is cut into windows over its whole length; the windows
of a batch go through the network together, and the text's distribution is the
mean of its windows' weighted by their bytes.

For prediction the embedding is multiplied into the filters once: a filter's
answer is then a sum of one table row per offset, looked up by byte.

Training reads a bounded sample: about ``per_lang`` texts of each label that
``usable`` admits (fewer where the labels are so many that ``SAMPLE`` texts are
reached, but one at least), drawn by a hash of the id, and ``windows_per_text``
windows of each, spread over the whole text.  Every label is learnt.  Labels, ids and sources are no inputs of
a prediction.

Defined results: null text, or text without a letter, is ``und`` with score 0;
so is every text when there is nothing to learn from.  Equal texts get equal
results.  Only doc_id, text and lang are read; an empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import free_names, require_columns

WINDOW = 192
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBED = 8
#: Bounds of the training sample.
PER_LANG = 500
WINDOWS_PER_TEXT = 6
SAMPLE = 32_000
STEPS = 700
BATCH = 64
UNKNOWN = "und"
#: A filtering stage rejects a best language below this share (even odds among many would be lower still).
MIN_SCORE = 0.35
#: Windows that go through the network together.
CHUNK = 64


def windows_of(data: bytes, size: int = WINDOW, overlap: int = max(WIDTHS) - 1) -> tuple[np.ndarray, np.ndarray]:
    """All windows of a text as rows of bytes (the last padded with zero bytes), and their lengths."""
    stride = size - overlap
    n = 1 + max(0, -(-(len(data) - size) // stride))
    flat = np.zeros(stride * (n - 1) + size, np.uint8)
    flat[:len(data)] = np.frombuffer(data, np.uint8)
    rows = np.lib.stride_tricks.as_strided(flat, (n, size), (stride, 1))
    lengths = np.minimum(size, len(data) - stride * np.arange(n))
    return rows, lengths


@dataclass
class ByteConvNet:
    langs: list[str]
    embed: np.ndarray  # 256 x EMBED
    filters: dict[int, np.ndarray]  # width -> width x EMBED x FILTERS
    bias: np.ndarray  # features
    dense: np.ndarray  # features x langs
    dense_bias: np.ndarray

    @staticmethod
    def fresh(langs: list[str], rng: np.random.Generator) -> ByteConvNet:
        def draw(*shape: int, fan: int) -> np.ndarray:
            return (rng.standard_normal(shape) / np.sqrt(fan)).astype(np.float32)

        n = FILTERS * len(WIDTHS)
        return ByteConvNet(langs, draw(256, EMBED, fan=EMBED), {w: draw(w, EMBED, FILTERS, fan=w) for w in WIDTHS},
                           np.zeros(n, np.float32), draw(n, len(langs), fan=n), np.zeros(len(langs), np.float32))

    def params(self) -> list[np.ndarray]:
        return [self.embed, *self.filters.values(), self.bias, self.dense, self.dense_bias]

    def gradients(self, x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        """Gradients of the mean cross-entropy, in the order of ``params``."""
        n, size = x.shape
        e = self.embed[x]
        pooled, where = [], []
        for w, f in self.filters.items():
            a = sum(e[:, o:size - w + 1 + o] @ f[o] for o in range(w))
            at = a.argmax(axis=1)
            where.append(at)
            pooled.append(np.take_along_axis(a, at[:, None], axis=1)[:, 0])
        z = np.concatenate(pooled, axis=1) + self.bias
        hidden = np.maximum(z, 0)
        p = softmax(hidden @ self.dense + self.dense_bias)
        p[np.arange(n), y] -= 1
        p /= n
        back = (p @ self.dense.T) * (z > 0)
        d_embed = np.zeros_like(self.embed)
        d_filters = []
        for k, (w, f) in enumerate(self.filters.items()):
            own = back[:, k * FILTERS:(k + 1) * FILTERS]
            d = np.zeros_like(f)
            for o in range(w):  # only the position that won the pooling has a gradient
                seen = np.take_along_axis(x, where[k] + o, axis=1)
                d[o] = np.einsum("nfe,nf->ef", self.embed[seen], own)
                np.add.at(d_embed, seen, own[:, :, None] * f[o].T[None])
            d_filters.append(d)
        return [d_embed, *d_filters, back.sum(axis=0), hidden.T @ p, p.sum(axis=0)]

    def tables(self) -> list[np.ndarray]:
        """For each offset, the answer of all filters that reach it, by byte."""
        return [np.ascontiguousarray(np.concatenate([self.embed @ f[o] for w, f in self.filters.items() if w > o], axis=1))
                for o in range(max(WIDTHS))]

    def predict(self, x: np.ndarray, tables: list[np.ndarray]) -> np.ndarray:
        """Distribution of each window."""
        n, size = x.shape
        width = FILTERS * len(WIDTHS)
        out = np.empty((n, width), np.float32)
        acc = tables[0][x]
        for o in range(1, max(WIDTHS)):
            skip = FILTERS * sum(w <= o for w in WIDTHS)
            acc[:, :size - o, skip:] += tables[o][x[:, o:]]
        for k, w in enumerate(WIDTHS):
            own = slice(k * FILTERS, (k + 1) * FILTERS)
            out[:, own] = acc[:, :size - w + 1, own].max(axis=1)
        return softmax(np.maximum(out + self.bias, 0) @ self.dense + self.dense_bias)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit(windows: list[bytes], labels: list[str], steps: int = STEPS, seed: int = 7) -> ByteConvNet | None:
    """Train on windows of labelled text; classes weigh alike.  None without labels."""
    langs = sorted(set(labels))
    if not langs:
        return None
    rng = np.random.default_rng(seed)
    net = ByteConvNet.fresh(langs, rng)
    by_lang = [[w for w, y in zip(windows, labels) if y == lang] for lang in langs]
    first = [np.zeros_like(p) for p in net.params()]
    second = [np.zeros_like(p) for p in net.params()]
    for step in range(1, steps + 1):
        y = rng.integers(len(langs), size=BATCH)
        x = np.zeros((BATCH, WINDOW), np.uint8)
        for i, lang in enumerate(y):
            w = by_lang[lang][rng.integers(len(by_lang[lang]))]
            if rng.random() < 0.4:  # short texts too
                lo = rng.integers(max(1, len(w) - 8))
                w = w[lo:lo + rng.integers(8, 65)]
            x[i, :len(w)] = np.frombuffer(w, np.uint8)
        rate = 0.01 * (1 - step / (steps + 1))
        for p, g, m, v in zip(net.params(), net.gradients(x, y), first, second):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= (rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
    return net


def held_out() -> Column:
    """Documents that training never sees: crc32 of the id's text leaves 1 modulo 3
    (and documents without an id)."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(True))


def training_sample(docs: DataFrame, usable: Column, per_lang: int = PER_LANG,
                    windows_per_text: int = WINDOWS_PER_TEXT) -> tuple[list[bytes], list[str]]:
    """Labelled windows of about ``min(per_lang, SAMPLE / labels)`` texts of each label (at most twice
    as many in all); a label's text with the least hash is always among them."""
    labelled = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.col("lang").cast("string")).where(
        usable & F.col("lang").isNotNull() & (F.length("text") > 0))
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20))
    counts = labelled.groupBy("lang").agg(F.count("*").alias("count"), F.min(draw).alias("least")).collect()  # a row per label
    if not counts:
        return [], []
    per_lang = max(1, min(per_lang, SAMPLE // len(counts)))
    below = [(r["lang"], max(r["least"] + 1, int(min(1.0, per_lang / r["count"]) * (1 << 20)))) for r in counts]
    chosen = F.broadcast(docs.sparkSession.createDataFrame(below, "lang string, below long"))  # a row per label

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for doc_id, text, lang in zip(*(c.to_pylist() for c in b.columns)):
                all_windows, lengths = windows_of(text.encode("utf-8", "replace"))
                for i in np.unique(np.linspace(0, len(lengths) - 1, windows_per_text).astype(int)):
                    rows.append((lang, doc_id, int(i), all_windows[i, :lengths[i]].tobytes()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 4,
                                                [pa.string(), pa.int64(), pa.int64(), pa.binary()])],
                names=["lang", "doc_id", "at", "bytes"])

    sample = labelled.join(chosen, "lang").where(draw < F.col("below")).select("doc_id", "text", "lang")
    rows = sample.mapInArrow(cut, "lang string, doc_id long, at long, bytes binary").limit(
        2 * per_lang * len(counts) * windows_per_text).collect()
    rows.sort(key=lambda r: (r["lang"], r["doc_id"] is None, r["doc_id"] or 0, r["at"], bytes(r["bytes"])))
    return [bytes(r["bytes"]) for r in rows], [r["lang"] for r in rows]


def predict_texts(net: ByteConvNet | None, texts: list[str | None]) -> tuple[list[str], list[float]]:
    """Prediction and score of each text."""
    known = [t is not None and any(c.isalpha() for c in t) for t in texts]
    langs, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
    if net is None:
        return langs, scores
    tables = net.tables()
    sums = np.zeros((len(texts), len(net.langs)))
    held, owner, weight, n = [], [], [], 0

    def flush() -> None:
        nonlocal held, owner, weight, n
        if held:
            x, who, w = np.concatenate(held), np.concatenate(owner), np.concatenate(weight)
            for lo in range(0, len(x), CHUNK):
                np.add.at(sums, who[lo:lo + CHUNK], net.predict(x[lo:lo + CHUNK], tables) * w[lo:lo + CHUNK, None])
        held, owner, weight, n = [], [], [], 0

    for i, t in enumerate(texts):
        if known[i]:
            rows, lengths = windows_of(t.encode("utf-8", "replace"))
            held.append(rows)
            owner.append(np.full(len(rows), i))
            weight.append(lengths)
            n += len(rows)
            if n >= 16 * CHUNK:
                flush()
    flush()
    for i in np.nonzero(known)[0]:
        best = int(sums[i].argmax())
        langs[i], scores[i] = net.langs[best], float(sums[i, best] / sums[i].sum())
    return langs, scores


def identify(docs: DataFrame, net: ByteConvNet | None, pred: str = "lang_pred", score: str = "score") -> DataFrame:
    """All columns of ``docs`` with two more (existing ones of those names are replaced)."""
    source = docs.drop(pred, score)
    at = source.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            langs, scores = predict_texts(net, b.column(at).to_pylist())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                                             names=[*b.schema.names, pred, score])

    more = [T.StructField(pred, T.StringType()), T.StructField(score, T.DoubleType())]
    return source.mapInArrow(run, T.StructType([*source.schema.fields, *more]))


def learn(docs: DataFrame, usable: Column | None = None) -> ByteConvNet | None:
    require_columns(docs, ["doc_id", "text", "lang"])
    return fit(*training_sample(docs, ~held_out() if usable is None else usable))


def language_of_documents(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every document, learnt from those not held out."""
    net = learn(docs)
    return identify(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), net).select(
        "doc_id", held_out().alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """Rows with a recognised language (not ``und``, score of at least ``min_score``), columns unchanged."""
    pred, score = free_names(docs, "lang_pred", "score")
    return identify(docs, learn(docs), pred, score).where(
        (F.col(pred) != UNKNOWN) & (F.col(score) >= min_score)).select(*docs.columns)
