"""Quality rules by tokeniser fertility.

Public vocabularies are yardsticks: text they were not made for (wrong encodings,
keys, markup, repeated junk) needs more tokens, more single bytes, or few
different ones.  Measured per text, with a vocabulary that falls back to bytes
(``piece_bpe_32k.model``):

* characters per token,
* the share of byte-fallback tokens,
* token entropy in bits over its greatest possible value for that many tokens,

and, with a byte-level one for many languages (``byte_bpe_multi_50k.tiktoken``),
characters per token again.

Each measure has a band per language (per script where the language is null): the
quartiles of the texts that pass the base rules, widened on both sides by ``WIDTH``
times their distance.  A language's quartiles are drawn toward those of the script
that most of its texts are in, ``n`` texts of its own weighing ``n / (n + SUPPORT)``:
one rule at every size, and no language is held against another script.  Quartiles
come from a mergeable sketch, so a language with a third of all rows is summed
map-side.  A text is kept if it passes the base rules and lies within all bands.

Texts longer than ``SLICE`` characters are handed to the tokenizers in parts that
are cut at spaces (else anywhere), so that a very long run without any may count a
token more per part.

Words are runs of anything but ASCII white space.  Base rules: at least 50 words,
and at most half of the words in 3-word windows that occur twice or more.

Defined results: null text has no words and fails; equal rows get equal
results; null doc_ids are carried through; an empty table gives an empty result.
Only doc_id, text and lang (if there) are read.
"""

from __future__ import annotations

import base64
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, require_columns, staged

MIN_WORDS = 50
REPEAT_PERCENT = 50
WIDTH = 4.0
#: The least half-width of a band, for measures that are nearly constant.
LEAST_WIDTH = {"chars_per_token": 0.25, "byte_share": 0.02, "entropy": 0.05, "bpe_chars_per_token": 0.25}
#: Texts of its own that weigh as much as a language's script.
SUPPORT = 50.0
#: Rows of bands that may be broadcast; beyond it they are joined by shuffle.
FEW_GROUPS = 10_000
SYMBOLS = "#*$%&|<>"
WHITE = " \t\n\x0b\x0c\r"
#: Characters handed to the tokenizer at a time (cut at a space), which bounds its memory.
SLICE = 200_000

MEASURES = ("chars_per_token", "byte_share", "entropy", "bpe_chars_per_token")
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def vocabulary_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@lru_cache(maxsize=2)
def processors(paths: tuple[str, str]):
    """The tokenizers and, by id of the first, whether it is a byte-fallback token."""
    import public_tokenizers
    import sentencepiece
    import tiktoken

    sp = sentencepiece.SentencePieceProcessor(model_file=paths[0])
    with open(paths[1], "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    bpe = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return sp, np.array([sp.is_byte(i) for i in range(sp.get_piece_size())]), bpe


def count_tokens(bpe, part: str) -> int:
    """Tokens of a part; halves where the library gives up (it panics on some very long runs)."""
    try:
        return len(bpe.encode_ordinary(part))
    except BaseException as e:  # a Rust panic isn't an Exception
        if isinstance(e, (KeyboardInterrupt, SystemExit, GeneratorExit)) or len(part) < 2:
            raise
        return count_tokens(bpe, part[:len(part) // 2]) + count_tokens(bpe, part[len(part) // 2:])


def base_counts(text: str | None) -> tuple[int, int, int, int, int]:
    """In the order of ``COUNTS``."""
    text = text or ""
    words = text.encode("utf-8", "replace").split()  # bytes.split splits at ASCII white space only
    seen: set[str] = set()
    dup_lines = 0
    for line in text.split("\n"):
        if line.strip(WHITE):
            dup_lines += line in seen
            seen.add(line)
    windows = list(zip(words, words[1:], words[2:]))
    repeated = 0
    if len(set(windows)) < len(windows):
        times = Counter(windows)
        marked = np.zeros(len(words), bool)
        again = np.array([times[w] > 1 for w in windows])
        for k in range(3):
            marked[k:len(windows) + k] |= again
        repeated = int(marked.sum())
    return (len(words), len(text) - sum(map(text.count, WHITE)), sum(map(text.count, SYMBOLS)), dup_lines, repeated)


def slices(text: str) -> Iterator[str]:
    at = 0
    while at < len(text):
        end = at + SLICE
        if end < len(text):
            end = max(text.rfind(" ", at + 1, end), text.rfind("\n", at + 1, end)) if " " in text[at + 1:end] or "\n" in text[at + 1:end] else end
        yield text[at:end]
        at = end


def fertility(text: str | None, paths: tuple[str, str]) -> tuple[float, float, float, float]:
    """In the order of ``MEASURES``; zeros for text without tokens."""
    sp, is_byte, bpe = processors(paths)
    counts = np.zeros(len(is_byte), np.int64)
    n_bpe = 0
    for part in slices(text or ""):
        ids = sp.encode(part, num_threads=1)
        n_bpe += count_tokens(bpe, part)
        if ids:
            counts += np.bincount(ids, minlength=len(counts))
    used = counts[counts > 0]
    n = int(used.sum())
    if not n:
        return 0.0, 0.0, 0.0, 0.0
    p = used / n
    entropy = float(-(p * np.log2(p)).sum() / np.log2(min(n, len(counts)))) if n > 1 else 0.0
    return len(text) / n, float(counts[is_byte].sum() / n), entropy, len(text) / max(1, n_bpe)


@lru_cache(maxsize=1 << 16)
def script_of(char: str) -> str:
    return unicodedata.name(char, "").partition(" ")[0] if char.isalpha() else ""


def script(text: str | None) -> str:
    """The script with most of the text's different letters (``none`` without letters)."""
    found = Counter(s for s in map(script_of, set(text or "")) if s)
    return max(found, key=lambda s: (found[s], s)) if found else "none"


def measured(docs: DataFrame, paths: tuple[str, str] | None = None) -> DataFrame:
    """``doc_id, lang, script, n_words, ..., chars_per_token, ...``."""
    require_columns(docs, ["doc_id", "text"])
    paths = paths or vocabulary_paths()
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    schema = "doc_id long, lang string, script string, " + ", ".join(f"{c} long" for c in COUNTS) + ", " + ", ".join(f"{m} double" for m in MEASURES)
    types = [pa.int64(), pa.string(), pa.string()] + [pa.int64()] * len(COUNTS) + [pa.float64()] * len(MEASURES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for doc_id, text, own in zip(b.column(0).to_pylist(), b.column(1), b.column(2).to_pylist()):
                t = text.as_py()
                rows.append((doc_id, own, script(t), *base_counts(t), *fertility(t, paths)))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [()] * len(types), types)],
                                             names=["doc_id", "lang", "script", *COUNTS, *MEASURES])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), lang.alias("lang")).mapInArrow(run, schema)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))


def quartiles() -> list[Column]:
    return [F.percentile_approx(m, [0.25, 0.75], 2000).alias(m) for m in MEASURES]


def bands(passing: DataFrame, width: float, support: float) -> DataFrame:
    """``(lang, script, {measure}_lo, {measure}_hi)``: a row for each language (its script
    null) and for each script (its language null)."""
    scripts = passing.groupBy("script").agg(*quartiles())
    main = passing.groupBy("lang", "script").count().groupBy("lang").agg(F.max_by("script", F.struct("count", "script")).alias("script"))
    around = scripts.select("script", *[F.col(m).alias(f"{m}_around") for m in MEASURES])
    langs = passing.where("lang IS NOT NULL").groupBy("lang").agg(F.count("*").alias("n"), *quartiles()).join(main, "lang").join(around, "script")
    weight = F.col("n") / (F.col("n") + F.lit(support))
    drawn = langs.select("lang", F.lit(None).cast("string").alias("script"), *[
        F.array(*[weight * F.col(m)[i] + (1 - weight) * F.col(f"{m}_around")[i] for i in (0, 1)]).alias(m) for m in MEASURES])
    both = drawn.unionByName(scripts.select(F.lit(None).cast("string").alias("lang"), "script", *MEASURES))
    out = []
    for m in MEASURES:
        lo, hi = F.col(m)[0], F.col(m)[1]
        room = F.greatest((hi - lo) * width, F.lit(LEAST_WIDTH[m]))
        out += [(lo - room).alias(f"{m}_lo"), (hi + room).alias(f"{m}_hi")]
    return both.select("lang", "script", *out)


def quality_verdicts(docs: DataFrame, width: float = WIDTH, support: float = SUPPORT, paths: tuple[str, str] | None = None) -> DataFrame:
    """``doc_id``, the counts, ``base_failed``, ``kept``, ``language`` and the measures of every document."""
    rows = staged(measured(docs, paths).withColumn("base_failed", base_failed()), "fertility")
    limits = cut(bands(rows.where(~F.col("base_failed")), width, support)).toDF("l", "s", *[f"{m}_{e}" for m in MEASURES for e in ("lo", "hi")])
    if limits.count() <= FEW_GROUPS:  # a row for each language and each script
        limits = F.broadcast(limits)
    own_script = F.when(F.col("lang").isNull(), F.col("script"))
    both = rows.join(limits, F.col("lang").eqNullSafe(F.col("l")) & own_script.eqNullSafe(F.col("s")), "left")
    within = F.lit(True)
    for m in MEASURES:
        within &= F.col(m).between(F.col(f"{m}_lo"), F.col(f"{m}_hi"))
    return both.select("doc_id", *COUNTS, "base_failed", F.coalesce(~F.col("base_failed") & within, F.lit(False)).alias("kept"),
                       F.coalesce("lang", F.concat(F.lit("script:"), "script")).alias("language"), *MEASURES)
