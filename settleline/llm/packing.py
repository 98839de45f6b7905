"""Best-fit sequence packing by hierarchical residual packing.

Documents become token ids followed by an end id; a document longer than a
sequence is cut into full pieces, the remainder coming first.  Pieces are packed
into sequences of at most ``capacity`` tokens:

* level 0: every partition packs its own pieces best-fit, longest first;
* bins that are nearly full (at most ``slack`` tokens free) are emitted;
* the underfull bins of ``fan_in`` partitions meet in one partition of the next
  level, where each is an item of its fill, and are packed best-fit again, and
  so on up the tree.

An item keeps its own content layout, so a piece's place is its offset in its
bin plus that bin's offset in the bin above.  A task packs blocks of at most
``block`` items, so its memory is bounded; a level whose underfull bins fit one
block is the root.  A level that can merge nothing more (bins too large to
share a sequence) ends the tree as well.  Every piece is placed: nothing is
dropped, and only documents above the capacity are cut.

Ids are those of the `tokenizers` file ``byte_bpe_50k.json``.  They are computed
by `tiktoken` over the same vocabulary as ranks, which is four times faster;
a text that it can't take goes through `tokenizers`.  Tests hold the two
against each other.

Defined results: null text is empty text, one piece of the end id alone; equal
rows are packed separately; null doc_ids are carried through; an empty table
gives an empty result.  Only doc_id and text are read.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import require_columns, staged

CAPACITY = 1024
END_ID = 2
#: A bin with at most this many free tokens is emitted at once.
SLACK = 4
FAN_IN = 8
#: Items that one call of the packer holds.
BLOCK = 200_000

PIECES = "uid long, doc_id long, piece int, start long, length long, ids_crc32 long"
PLACED = "item long, size int, bin long, at int, fill int"


def vocabulary_paths() -> tuple[str, str]:
    """Places of the vocabulary as a `tokenizers` file and as ranks."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


@lru_cache(maxsize=2)
def encoders(json_path: str, ranks_path: str):
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    slow = Tokenizer.from_file(json_path)
    added = re.compile("|".join(re.escape(t.content) for t in slow.get_added_tokens_decoder().values()) or r"(?!)")
    return fast, slow, added


def token_ids(text: str | None, paths: tuple[str, str]) -> np.ndarray:
    """Ids of the text as unsigned 32-bit integers, the end id last."""
    fast, slow, added = encoders(*paths)
    text = text or ""
    try:  # added tokens that stand in the text are for ``tokenizers`` alone to find
        ids = slow.encode(text, add_special_tokens=False).ids if added.search(text) else fast.encode_ordinary(text)
    except BaseException as e:  # a Rust panic isn't an Exception
        if isinstance(e, (KeyboardInterrupt, SystemExit, GeneratorExit)):
            raise
        ids = slow.encode(text, add_special_tokens=False).ids
    out = np.empty(len(ids) + 1, "<u4")
    out[:-1] = ids
    out[-1] = END_ID
    return out


def cuts(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of n ids."""
    if n <= capacity:
        return [(0, n)]
    first = n % capacity
    head = [(0, first)] if first else []
    return head + [(s, capacity) for s in range(first, n, capacity)]


def tokenized_pieces(docs: DataFrame, capacity: int = CAPACITY, paths: tuple[str, str] | None = None,
                     with_ids: bool = False) -> DataFrame:
    """A row per piece; ``uid`` numbers the rows.  ``with_ids`` adds the ids."""
    require_columns(docs, ["doc_id", "text"])
    paths = paths or vocabulary_paths()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uid = TaskContext.get().partitionId() << 40
        for b in batches:
            rows: list[tuple] = []
            kept = []
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1)):
                ids = token_ids(text.as_py(), paths)
                for k, (start, length) in enumerate(cuts(len(ids), capacity)):
                    own = ids[start:start + length]
                    rows.append((uid, doc_id, k, start, length, zlib.crc32(own.tobytes())))
                    if with_ids:
                        kept.append(own.astype(np.int32))
                    uid += 1
            types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            names = ["uid", "doc_id", "piece", "start", "length", "ids_crc32"]
            columns = [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 6, types)]
            if with_ids:
                columns, names = [*columns, pa.array(kept, pa.list_(pa.int32()))], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    source = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return source.mapInArrow(run, PIECES + ", ids array<int>" * with_ids)


def best_fit(sizes: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best-fit decreasing: bin and offset of each item, and each bin's fill.

    Open bins wait in a stack for each residual; an integer's bits tell which
    residuals have any, so the tightest one that fits is a shift and a mask.
    """
    order = np.argsort(-sizes, kind="stable")
    bins = np.empty(len(sizes), np.int64)
    at = np.empty(len(sizes), np.int64)
    fills: list[int] = []
    waiting: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_bits = 0
    for i, size in zip(order.tolist(), sizes[order].tolist()):
        fitting = open_bits >> size
        if fitting:
            free = size + ((fitting & -fitting).bit_length() - 1)
            b = waiting[free].pop()
            if not waiting[free]:
                open_bits &= ~(1 << free)
        else:
            b, free = len(fills), capacity
            fills.append(0)
        bins[i], at[i] = b, fills[b]
        fills[b] += size
        free -= size
        if free:
            waiting[free].append(b)
            open_bits |= 1 << free
    return bins, at, np.array(fills, np.int64)


def place(items: DataFrame, level: int, capacity: int, block: int) -> DataFrame:
    """Pack ``(item, size)`` best-fit within each partition, ``block`` at a time."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        next_bin = (level << 56) | (TaskContext.get().partitionId() << 32)

        def packed(parts: list[pd.DataFrame]) -> pd.DataFrame:
            nonlocal next_bin
            # by size and item, so that a repeated task gives the same bins
            whole = pd.concat(parts).sort_values(["size", "item"], ascending=[False, True], kind="stable")
            bins, at, fills = best_fit(whole["size"].to_numpy(np.int64), capacity)
            out = pd.DataFrame({"item": whole["item"].to_numpy(), "size": whole["size"].to_numpy(),
                                "bin": next_bin + bins, "at": at, "fill": fills[bins]})
            next_bin += len(fills)
            return out

        held: list[pd.DataFrame] = []
        n = 0
        for b in batches:
            while len(b):
                room, b = b.iloc[:block - n], b.iloc[block - n:]
                held.append(room)
                n += len(room)
                if n == block:
                    yield packed(held)
                    held, n = [], 0
        if held:
            yield packed(held)

    return items.mapInPandas(run, PLACED)


def pack(docs: DataFrame, capacity: int = CAPACITY, slack: int = SLACK, fan_in: int = FAN_IN, block: int = BLOCK,
         paths: tuple[str, str] | None = None, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents with the sequence and offset each is placed at.

    ``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` and, if
    ``with_ids``, the piece's ``ids``.
    """
    pieces = staged(tokenized_pieces(docs, capacity, paths, with_ids), "pieces")
    level = 0
    placed = staged(place(pieces.select(F.col("uid").alias("item"), F.col("length").cast("int").alias("size")),
                          level, capacity, block), "bins")
    spots = placed.select(F.col("item").alias("uid"), F.col("bin").alias("top"), F.col("at").cast("long").alias("offset"))
    while True:
        under = placed.where(F.col("fill") < capacity - slack).select("bin", "fill").distinct()
        total, spread = under.agg(F.count("*"), F.countDistinct(F.shiftright("bin", 32))).first()
        if total < 2 or (level and spread == 1 and total <= block):
            break  # nothing to merge, or the root has packed them together
        level += 1
        parents = 1 if total <= block else max(-(-spread // fan_in), -(-total // block))
        # neighbouring partitions of the level below meet in one parent
        parent = F.floor(F.shiftright("bin", 32).bitwiseAND(F.lit((1 << 24) - 1)) / fan_in)
        items = under.repartition(parents, *([parent] if parents > 1 else [])).select(
            F.col("bin").alias("item"), F.col("fill").alias("size"))
        merged = staged(place(items, level, capacity, block), "bins")
        spots = spots.join(merged.select(F.col("item").alias("top"), F.col("bin").alias("_bin"), F.col("at").alias("_at")),
                           "top", "left").select("uid", F.coalesce("_bin", "top").alias("top"),
                                                 (F.col("offset") + F.coalesce("_at", F.lit(0))).alias("offset"))
        bins = merged.agg(F.countDistinct("bin")).first()[0]
        placed = merged
        if bins > 0.99 * total:
            break  # what is left is too large to share sequences
    wanted = ["doc_id", "piece", "start", "length", "ids_crc32", F.col("top").alias("sequence_id"), "offset"]
    return pieces.join(spots, "uid").select(*wanted, *(["ids"] if with_ids else []))
