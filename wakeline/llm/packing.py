"""Operator 1, packing: tokenized documents into fixed windows.

A task streams its documents, tokenizes them and keeps of each piece only
``(doc_id, start, length, crc)``. Overlong documents are first cut into full
windows; what is left of them is packed by best-fit decreasing over a block
of bounded size. A segment tree indexed by remaining capacity finds the
tightest open window. As many windows are open from the start as the block's ids need,
so a block is padded by less than one window: a piece for which no open window has room
is cut at the widest one, and its rest placed in its turn. No shuffle is
needed: a block's windows depend on that block alone.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.llm.common import arrow_rows, text_or_empty

WINDOW = 1024
BLOCK = 16_384
SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long, padded_to long"
)


@lru_cache(maxsize=1)
def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies, to that byte."""
    printable = [b for b in range(256) if chr(b).isprintable() and b not in (32, 160, 173)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(rest)}


@lru_cache(maxsize=4)
def byte_bpe(path: str):
    """An encoder with the ids of the tokenizer file at ``path``.

    The file's vocabulary drives tiktoken's byte-pair loop, which gives the
    tokenizers library's ids (tests compare them over code points of all planes) in a
    quarter of the time. The file names its pre-tokenizer (byte level, with the pattern built
    into the library) and not the pattern, hence the constant here. The added token's
    string stays a special token.
    """
    import tiktoken

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    alphabet = byte_alphabet()
    ranks = {bytes(alphabet[c] for c in token): i for token, i in spec["model"]["vocab"].items()}
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    return tiktoken.Encoding(
        "packing", pat_str=pattern, mergeable_ranks={k: v for k, v in ranks.items() if v not in special.values()}, special_tokens=special
    )


class CapacityTree:
    """Open windows by remaining capacity 0..size, as a segment tree of counts.

    ``tightest(need)`` descends to the smallest capacity of at least ``need``
    that some open window has, ``widest()`` to the largest, in O(log size).
    """

    def __init__(self, size: int) -> None:
        self.leaves = 1 << size.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.open: list[list[int]] = [[] for _ in range(size + 1)]

    def _add(self, capacity: int, by: int) -> None:
        node = capacity + self.leaves
        while node:
            self.count[node] += by
            node >>= 1

    def push(self, capacity: int, window: int) -> None:
        self.open[capacity].append(window)
        self._add(capacity, 1)

    def pop(self, capacity: int) -> int:
        self._add(capacity, -1)
        return self.open[capacity].pop()

    def tightest(self, need: int) -> int | None:
        count, node = self.count, need + self.leaves
        if count[node]:
            return need
        while node > 1:  # climb until a right sibling holds a window
            if not node & 1 and count[node + 1]:
                node += 1
                break
            node >>= 1
        else:
            return None
        while node < self.leaves:
            node = 2 * node + (not count[2 * node])
        return node - self.leaves

    def widest(self) -> int:
        node = 1
        while node < self.leaves:
            node = 2 * node + (self.count[2 * node + 1] > 0)
        return node - self.leaves


def best_fit_decreasing(lengths: list[int], size: int) -> list[list[tuple[int, int, int]]]:
    """Windows as lists of (index of ``lengths``, start, length), as few windows as can hold all.

    The longest piece comes first, of equal ones the first; lengths are below or at ``size``.
    """
    tree = CapacityTree(size)
    windows: list[list[tuple[int, int, int]]] = [[] for _ in range(-(-sum(lengths) // size))]
    for window in reversed(range(len(windows))):
        tree.push(size, window)
    waiting: list[list[tuple[int, int]]] = [[] for _ in range(size + 1)]
    for i, length in enumerate(lengths):
        waiting[length].append((i, 0))
    for length in range(size, 0, -1):
        for i, start in waiting[length]:
            room = tree.tightest(length)
            if room is None:
                room = tree.widest()
                waiting[length - room].append((i, start + room))
            window, taken = tree.pop(room), min(room, length)
            windows[window].append((i, start, taken))
            if room > taken:
                tree.push(room - taken, window)
    return windows


class Packer:
    """Packs one task's pieces, a block at a time.

    A piece is ``(doc_id, start, ids, doc_tokens)`` with ids as a uint32 array.
    """

    def __init__(self, first_sequence: int, size: int) -> None:
        self.sequence, self.size = first_sequence, size
        self.waiting: list[tuple] = []
        self.rows: list[tuple] = []

    def add(self, doc_id, ids: np.ndarray) -> None:
        whole = len(ids) - len(ids) % self.size
        for start in range(0, whole, self.size):
            self._close([(doc_id, start, ids[start : start + self.size], len(ids))])
        if whole < len(ids):
            self.waiting.append((doc_id, whole, ids[whole:].copy(), len(ids)))

    def _close(self, pieces: list[tuple]) -> None:
        used = sum(len(p[2]) for p in pieces)
        padded = used if used & (used - 1) == 0 else self.size
        offset = 0
        for doc_id, start, ids, total in pieces:
            self.rows.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes()), total, self.sequence, offset, padded))
            offset += len(ids)
        self.sequence += 1

    def pack(self) -> None:
        pieces, self.waiting = self.waiting, []
        for window in best_fit_decreasing([len(p[2]) for p in pieces], self.size):
            self._close([(pieces[i][0], pieces[i][1] + start, pieces[i][2][start : start + length], pieces[i][3]) for i, start, length in window])

    def take(self) -> list[tuple]:
        rows, self.rows = self.rows, []
        return rows


def pack(df: DataFrame, tokenizer: str, size: int = WINDOW, block: int = BLOCK, end_id: int = 0) -> DataFrame:
    """One row per piece of ``df``'s (doc_id, text), columns as ``SCHEMA``.

    A null text counts as empty (its one id is ``end_id``); null or repeated
    doc_ids are packed like any other, a row for a row; an empty table gives
    no rows; other columns are ignored. ``padded_to`` is ``size``, or the
    sequence's own length where that is a power of two. ``sequence_id`` is the
    task's number in the upper bits and a count below.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder = byte_bpe(tokenizer)
        packer = Packer(TaskContext.get().partitionId() << 32, size)
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                packer.add(doc_id, np.array([*encoder.encode(text, allowed_special="all"), end_id], dtype="<u4"))
                if len(packer.waiting) >= block:
                    packer.pack()
                if len(packer.rows) >= 50_000:
                    yield arrow_rows(packer.take(), SCHEMA)
        packer.pack()
        yield arrow_rows(packer.take(), SCHEMA)

    slim = df.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return slim.mapInArrow(run, SCHEMA)


def op1_packing(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from wakeline.llm.common import documents

    return pack(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))
