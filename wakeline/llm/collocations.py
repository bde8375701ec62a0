"""Operator 12, phrase collocations counted by minimal perfect hashing.

Texts become numbers of frequent words once, in chunks of bounded length
written to the shared checkpoint folder. Phrases then grow by a word a level.
A window of k words is a candidate if the phrases of its first and of
its last k - 1 words are frequent (Apriori), and if the hash bucket that it falls in is
filled often enough (a bucket holds all windows of its keys, so no frequent phrase is lost).
A candidate's key is the number of its first k - 1 words' phrase with its last word's, so keys are
exact at every level. Candidates get slots by a minimal perfect hash; a slot's
stored key tells other windows that hash there. A task counts slots into a numpy array.
A last pass of the level writes down which frequent phrase begins at each place.

A level reads the word numbers three times, however many there are: for the buckets, for the candidates' counts and to write
phrases down. Tasks deal what they meet, in sorted blocks, to parts of fixed size (``BUCKETS`` counters, ``PART`` windows), each of which is
counted in one task. Only more than ``PART`` frequent phrases of a level, or ``WORDS`` frequent words, take more passes. The driver
sees one such part at a time, and a bit for each bucket.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from itertools import groupby, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wakeline.llm.common import arrow_batches, delete_folder, documents, scratch_folder, shuffle_partitions, text_or_empty, written

LEAST = 100
LONGEST = 5
TOP = 2_000
#: Counters of a part of the buckets, and windows for each of them, about.
BUCKETS = 1 << 17
LOAD = 32
#: Windows whose candidates are counted in one part and frequent phrases of a pass, about, and words of one.
PART = 1 << 22
WORDS = 1 << 20
#: Windows that a task sorts at a time, and hashes at a time.
BLOCK, FEW = 1 << 23, 1 << 18
#: Words of a chunk.
CHUNK = 1 << 14
#: Bytes of an Arrow batch and of a row group of chunks: a task holds some of its chunks at a time, not all.
BATCH, GROUP = "8m", 8 << 20
#: Bits of a word's number, and of a phrase's.
BITS = 31
SPLITS = bytes.maketrans(b".,;:!?\n\x0b\x0c\r\t", b"\n" * 10 + b" ")
SLICE = 1 << 20


def mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """Keys spread over 64 bits."""
    x = keys.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Slots:
    """Minimal perfect hash of distinct keys: each has a slot of its own below their number.

    A level gives slots to the keys that are alone in their cell; the others go to the next, smaller one. A cell
    is a bit, and a slot is the number of bits before it.
    """

    def __init__(self, keys: np.ndarray) -> None:
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        rest, taken = keys, 0
        while len(rest):
            size = -(-max(8, len(rest) * 3 // 2) // 64) * 64
            at = self._cell(rest, len(self.levels), size)
            met = np.bincount(at, minlength=size)
            bits = np.packbits(met == 1, bitorder="little").view("<u8")
            n = np.bitwise_count(bits).astype(np.int32)
            self.levels.append((bits, taken + np.cumsum(n, dtype=np.int32) - n))
            taken += int(n.sum())
            rest = rest[met[at] != 1]
        self.keys = np.zeros(len(keys), np.int64)
        self.keys[self._slots(keys)] = keys

    @staticmethod
    def _cell(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mix(keys, level) % np.uint64(size)).astype(np.int64)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        slots, todo = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, (bits, before) in enumerate(self.levels):
            if not len(todo):
                break
            at = self._cell(keys[todo], level, 64 * len(bits))
            word, bit = bits[at >> 6], np.uint64(1) << (at & 63).astype(np.uint64)
            got = word & bit != 0
            slots[todo[got]] = before[at[got] >> 6] + np.bitwise_count(word[got] & (bit[got] - np.uint64(1)))
            todo = todo[~got]
        return slots

    def __getitem__(self, keys: np.ndarray) -> np.ndarray:
        """The keys' slots; -1 for any other key, told by the one that is stored."""
        slots = self._slots(keys)
        if not len(self.keys):
            return slots
        return np.where((slots >= 0) & (self.keys[np.maximum(slots, 0)] == keys), slots, -1)


def slices(text: str) -> Iterator[bytes]:
    """A text's bytes, A-Z lower-cased, with one mark for all that ends a piece and one for blanks; a long text in parts that end with a piece."""
    data = text.encode("utf-8", "surrogatepass").lower().translate(SPLITS)
    at = 0
    while at < len(data):
        end = data.find(b"\n", at + SLICE)
        end = len(data) if end < 0 else end + 1
        yield data[at:end]
        at = end


def tokens(part: bytes) -> list[bytes]:
    """Words, and a mark at each piece's end."""
    return [t for t in part.replace(b"\n", b" \n ").split(b" ") if t]


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, text) to (lang, word, n), summed in a task as far as memory allows."""

    def rows(counts: dict[str, Counter]) -> pa.RecordBatch:
        flat = [(lang, word, n) for lang, words in counts.items() for word, n in words.items()]
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in flat], pa.string()), pa.array([r[1] for r in flat], pa.binary()).cast(pa.string()), pa.array([r[2] for r in flat], pa.int64())], names=["lang", "word", "n"])

    counts: dict[str, Counter] = {}
    for batch in batches:
        for lang, text in zip(*(batch.column(i).to_pylist() for i in range(2))):
            own = counts.setdefault(lang, Counter())
            for part in slices(text):
                own.update(part.split())
            if sum(map(len, counts.values())) > 1 << 18:
                yield rows(counts)
                counts = {}
    yield rows(counts)


def _tokens(chunk: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, text) to chunks (lang, own, tokens, words) of one language: words, and marks where pieces end.

    A chunk ends with some words of the next one, for the windows that begin in it. Words have no numbers yet.
    """
    shared = LONGEST - 1

    def row(lang: str, held: list[bytes], own: int) -> pa.RecordBatch:
        cells = [pa.array([lang], pa.string()), pa.array([own], pa.int32()), pa.array([b" ".join(held)], pa.binary()), pa.nulls(1, pa.binary())]
        return pa.RecordBatch.from_arrays(cells, names=["lang", "own", "tokens", "words"])

    held: dict[str, list[bytes]] = {}
    for batch in batches:
        for lang, text in zip(*(batch.column(i).to_pylist() for i in range(2))):
            own = held.setdefault(lang, [])
            for part in slices(text):
                own.extend(tokens(part))
                own.append(b"\n")
                while len(own) >= chunk + shared:
                    yield row(lang, own[: chunk + shared], chunk)
                    del own[:chunk]
            if len(held) > 64:  # no buffer for each of many languages
                yield from (row(lang, rest, len(rest)) for lang, rest in held.items() if rest)
                held = {}
    yield from (row(lang, rest, len(rest)) for lang, rest in held.items() if rest)


def _numbered(told, last: bool) -> Callable:
    """Chunks with the numbers of one part of the words filled in; the last time without the tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers: dict[str, dict[bytes, int]] = told.value
        for batch in batches:
            for lang, own, tokens, known in zip(*(batch.column(i).to_pylist() for i in range(4))):
                split = tokens.split(b" ")
                new = np.fromiter(map(numbers.get(lang, {}).get, split, repeat(-1)), np.int32, len(split))
                words = (new if known is None else np.maximum(new, np.frombuffer(known, np.int32))).tobytes()
                kinds = [pa.int32(), pa.binary(), pa.binary(), pa.binary()] if last else [pa.string(), pa.int32(), pa.binary(), pa.binary()]
                row = (own, words, words, None) if last else (lang, own, tokens, words)
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, kinds)], names=["own", "words", "at", "next"] if last else ["lang", "own", "tokens", "words"])

    return run


_TOKENS, _CHUNKS = "lang string, own int, tokens binary, words binary", "own int, words binary, at binary, next binary"


def windows(words: np.ndarray, at: np.ndarray, k: int, own: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, keys) of the candidate windows of k words that begin at the first ``own`` places."""
    n = max(0, min(own, len(words) - k + 1))
    places = np.flatnonzero((at[:n] >= 0) & (at[1 : n + 1] >= 0))
    return places, (at[places].astype(np.int64) << BITS) | words[places + k - 1]


def _blocks(arrays: Iterator[np.ndarray], size: int) -> Iterator[np.ndarray]:
    """The arrays' numbers, about ``size`` at a time."""
    held, n = [], 0
    for one in arrays:
        held.append(one)
        n += len(one)
        if n >= size:
            yield np.concatenate(held)
            held, n = [], 0
    if n:
        yield np.concatenate(held)


def _keys(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[np.ndarray]:
    """Keys of all windows of a task's chunks (own, words, at), a few chunks' at a time."""
    chunks = (tuple(c[i].as_py() for c in b.columns) for b in batches for i in range(b.num_rows))
    return _blocks((windows(np.frombuffer(words, np.int32), np.frombuffer(at, np.int32), k, own)[1] for own, words, at in chunks), FEW)


def packed(numbers: np.ndarray) -> bytes:
    """Sorted whole numbers from 0 on as steps, all lowest bytes first, then the next ones, as many as the largest step has."""
    steps = np.diff(numbers.astype("<i8"), prepend=0)
    width = max(1, (int(steps.max()).bit_length() + 7) // 8)
    return bytes([width]) + steps.view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8, offset=1).reshape(data[0], -1)
    steps = np.zeros((planes.shape[1], 8), np.uint8)
    steps[:, : len(planes)] = planes.T
    return np.cumsum(steps.view("<i8").ravel())


def _rows(dealt: Iterator[tuple[int, np.ndarray, np.ndarray | None]]) -> pa.RecordBatch:
    """Numbers by part, and how often each was met where repeats don't tell it; parts without numbers have no row."""
    rows = [(part, packed(numbers), None if counts is None else packed(np.cumsum(counts))) for part, numbers, counts in dealt if len(numbers)]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate((pa.int32(), pa.binary(), pa.binary()))], names=["part", "numbers", "counts"])


_PACKED = "part int, numbers binary, counts binary"


def _dealt(chunks: DataFrame, n_windows: int, parts: int, met: Callable, summed: Callable, schema: str) -> DataFrame:
    """What ``summed`` makes of each part's rows that ``met`` makes of the chunks; they meet in one task, a task's parts one after another."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for b in batches for row in zip(*(c.to_pylist() for c in b.columns)))
        for part, own in groupby(rows, key=lambda row: row[0]):
            yield summed(part, ((unpacked(numbers), counts) for _, numbers, counts in own))

    tasks = max(2, chunks.sparkSession.sparkContext.defaultParallelism, n_windows // (4 * BLOCK))  # tasks that fill their blocks
    rows = chunks.select("own", "words", "at").coalesce(tasks).mapInArrow(met, _PACKED)
    return rows.repartition(min(parts, shuffle_partitions(chunks.sparkSession)), "part").sortWithinPartitions("part").mapInArrow(each, schema)


def _places(keys: np.ndarray, parts: int) -> np.ndarray:
    """The keys' buckets, numbered over all parts."""
    h = mix(keys, 1 << 20)
    return (h >> np.uint64(40)) % np.uint64(parts) * np.uint64(BUCKETS) + (h & np.uint64(BUCKETS - 1))


def _full(chunks: DataFrame, k: int, n_windows: int, parts: int, least: int) -> np.ndarray:
    """A bit for each bucket: whether the windows of k words meet it ``least`` times."""
    kind = np.uint32 if parts * BUCKETS <= 1 << 32 else np.uint64

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for places in _blocks((_places(keys, parts).astype(kind) for keys in _keys(batches, k)), BLOCK):
            places.sort()
            needed = np.ones(len(places), bool)
            needed[least:] = places[least:] != places[:-least]  # more of a bucket than ``least`` in a block tell nothing
            places = places[needed]
            dealt = np.split(places, np.searchsorted(places, np.arange(1, parts, dtype=kind) * kind(BUCKETS)))
            yield _rows((part, own & kind(BUCKETS - 1), None) for part, own in enumerate(dealt))

    def summed(part: int, rows: Iterator[tuple]) -> pa.RecordBatch:
        total = np.zeros(BUCKETS, np.int64)
        for places in _blocks((numbers for numbers, _ in rows), FEW):
            total += np.bincount(places, minlength=BUCKETS)
        return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([np.packbits(total >= least).tobytes()], pa.binary())], names=["part", "bits"])

    bits = np.zeros((parts, BUCKETS // 8), np.uint8)
    rows = _dealt(chunks, n_windows, parts, met, summed, "part int, bits binary").toArrow()
    for part, own in zip(*(rows.column(i).to_pylist() for i in range(2))):
        bits[part] = np.frombuffer(own, np.uint8)
    return bits.ravel()


def _frequent(chunks: DataFrame, k: int, n_windows: int, least: int, part: int) -> DataFrame:
    """(key, f) of the windows of k words that are met ``least`` times, from those whose bucket is."""
    buckets, parts = max(1, -(-n_windows // (BUCKETS * LOAD))), max(1, -(-n_windows // part))
    told = chunks.sparkSession.sparkContext.broadcast(_full(chunks, k, n_windows, buckets, least))  # half a MB for each 128 million windows

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        bits = told.value
        for keys in _keys(batches, k):
            at = _places(keys, buckets)
            yield keys[(bits[at >> np.uint64(3)] >> (np.uint64(7) - (at & np.uint64(7))).astype(np.uint8)) & 1 == 1]

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(candidates(batches), BLOCK // 2):
            keys, counts = np.unique(block, return_counts=True)
            own = (mix(keys, 1 << 21) % np.uint64(parts)).astype(np.int32)
            order = np.argsort(own, kind="stable")
            dealt = np.split(order, np.searchsorted(own[order], np.arange(1, parts)))
            yield _rows((j, keys[at], counts[at]) for j, at in enumerate(dealt))

    def summed(_: int, rows: Iterator[tuple]) -> pa.RecordBatch:
        met = [(keys, np.diff(unpacked(counts), prepend=0)) for keys, counts in rows]
        keys = np.concatenate([keys for keys, _ in met])
        slots = Slots(np.unique(keys))
        f = np.zeros(len(slots.keys), np.int64)
        np.add.at(f, slots[keys], np.concatenate([counts for _, counts in met]))
        return pa.RecordBatch.from_arrays([pa.array(slots.keys[f >= least], pa.int64()), pa.array(f[f >= least], pa.int64())], names=["key", "f"])

    return _dealt(chunks, n_windows, parts, met, summed, "key long, f long")


def _needed(words: np.ndarray, at: np.ndarray, own: int) -> tuple[int, np.ndarray, np.ndarray]:
    """(own, words, at) without the places that no longer window can use; nothing follows on where some are left out."""
    begins = np.flatnonzero((at[:-1] >= 0) & (at[1:] >= 0))
    kept = np.zeros(len(at) + LONGEST + 1, bool)
    for i in range(LONGEST + 1):
        kept[begins + i] = True
    places = np.flatnonzero(kept[: len(at)])
    left = at[places]
    left[np.flatnonzero(np.diff(places) > 1)] = -1
    return int(np.searchsorted(places, own)), words[places], left


def _marked(slots, before: int, k: int, last: bool) -> Callable:
    """Chunks with the numbers of the frequent phrases of k words put down in ``next`` where they begin; the last time they are ``at``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own, words, at, known in (tuple(c[i].as_py() for c in b.columns) for b in batches for i in range(b.num_rows)):
            numbers, old = np.frombuffer(words, np.int32), np.frombuffer(at, np.int32)
            new = np.full(len(old), -1, np.int32) if known is None else np.frombuffer(known, np.int32).copy()
            places, keys = windows(numbers, old, k, len(old))
            slot = slots.value[keys]
            new[places[slot >= 0]] = before + slot[slot >= 0]
            if last:
                own, numbers, new = _needed(numbers, new, own)
                row = (own, numbers.tobytes(), new.tobytes(), None)
            else:
                row = (own, words, at, new.tobytes())
            kinds = [pa.int32(), pa.binary(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, kinds)], names=["own", "words", "at", "next"])

    return run


class _Levels:
    """The chunks and the phrase tables of one run, in a folder of its own."""

    def __init__(self, spark: SparkSession, least: int, part: int) -> None:
        self.spark, self.least, self.part = spark, max(1, least), part
        self.folder, self.steps = scratch_folder(spark, "phrases"), 0
        self.chunks: DataFrame | None = None
        self.held: str | None = None

    def keep(self, chunks: DataFrame) -> None:
        """Chunks written anew; the ones before are deleted."""
        self.steps += 1
        folder = f"{self.folder}/chunks{self.steps}"
        self.chunks = written(chunks, folder, GROUP)
        if self.held:
            delete_folder(self.spark, self.held)
        self.held = folder

    def encode(self, texts: DataFrame, words: DataFrame, parts: int, chunk: int) -> None:
        """Chunks of the texts' words by number, a part of the words a pass."""
        for j in range(parts):
            numbers: dict[str, dict[bytes, int]] = {}
            own = words.where(F.pmod(F.xxhash64("word"), F.lit(parts)) == j).select("lang", "word", "id").toArrow()
            for lang, word, number in zip(*(own.column(i).to_pylist() for i in range(3))):
                numbers.setdefault(lang, {})[word.encode()] = number
            fill = _numbered(self.spark.sparkContext.broadcast(numbers), j == parts - 1)
            schema = _CHUNKS if j == parts - 1 else _TOKENS
            self.keep(texts.mapInArrow(lambda rows, fill=fill: fill(_tokens(chunk, rows)), schema) if j == 0 else self.chunks.mapInArrow(fill, schema))

    def grow(self, k: int, n_windows: int) -> tuple[DataFrame, int]:
        """(id, key, f) of the frequent phrases of k words, and how many windows they have in all."""
        keys = written(_frequent(self.chunks, k, n_windows, self.least, self.part), f"{self.folder}/keys{k}")
        parts = max(1, -(-keys.count() // self.part))
        place, found, met = f"{self.folder}/phrases{k}", 0, 0
        for j in range(parts):
            own = keys.where(F.pmod(F.xxhash64("key"), F.lit(parts)) == j).toArrow()
            kept = Slots(own.column("key").to_numpy())
            f = np.zeros(len(kept.keys), np.int64)
            f[kept[own.column("key").to_numpy()]] = own.column("f").to_numpy()
            rows = pa.table({"id": pa.array(found + np.arange(len(f)), pa.int64()), "key": pa.array(kept.keys, pa.int64()), "f": pa.array(f, pa.int64())})
            self.spark.createDataFrame(rows).write.mode("append").parquet(place)
            numbers = self.spark.sparkContext.broadcast(kept)
            self.keep(self.chunks.mapInArrow(_marked(numbers, found, k, j == parts - 1), _CHUNKS))
            numbers.destroy()
            found, met = found + len(f), met + int(f.sum())
            if found >= 1 << BITS:
                raise OverflowError(f"more frequent phrases of {k} words than 31 bits number")
        delete_folder(self.spark, f"{self.folder}/keys{k}")
        return self.spark.read.schema("id long, key long, f long").parquet(place), met


def _numbered_words(often: DataFrame, folder: str) -> tuple[DataFrame, int]:
    """Words (lang, word, f) with ids from 0, by language and hash bucket; no order over all of them."""
    rows = often.withColumn("bucket", F.pmod(F.xxhash64("lang", "word"), F.lit(1024)))
    counts = rows.groupBy("bucket").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))  # 1,024 rows
    offsets = counts.select("bucket", F.coalesce(before, F.lit(0)).alias("before"))
    place = F.row_number().over(Window.partitionBy("bucket").orderBy("lang", "word")) - 1
    rows = rows.withColumn("place", place).join(F.broadcast(offsets), "bucket")
    table = written(rows.select((F.col("before") + F.col("place")).alias("id"), "lang", "word", "f"), folder)
    return table, table.count()


def _with_parts(phrases: DataFrame, shorter: DataFrame, words: DataFrame, k: int) -> DataFrame:
    """Phrases of k words with their texts and the counts of all their first and last parts, read by number and key."""
    low = (1 << BITS) - 1
    rows = phrases.withColumns({"prefix": F.shiftright("key", BITS), "last": F.col("key").bitwiseAND(low)})
    first = shorter.select(F.col("id").alias("prefix"), "lang", F.col("text").alias("start"), F.col("f").alias("f_prefix"), "firsts", F.col("suffix").alias("middle"))
    rows = rows.join(first, "prefix").join(words.select(F.col("id").alias("last"), F.col("word")), "last")
    ends = shorter.select(F.col("id").alias("suffix"), F.col("f").alias("f_suffix"), "lasts", F.col("key").alias("suffix_key"))
    if k == 2:
        rows = rows.join(ends.drop("suffix_key"), F.col("last") == F.col("suffix"))
    else:
        rows = rows.withColumn("suffix_key", F.shiftleft("middle", BITS).bitwiseOR(F.col("last"))).join(ends, "suffix_key")
    joined = lambda parts, one: F.concat(parts, F.array(one)).alias(parts)
    return rows.select("id", "key", "lang", F.concat_ws(" ", "start", "word").alias("text"), "f", "prefix", "suffix", "f_prefix", "f_suffix", joined("firsts", "f_prefix"), joined("lasts", "f_suffix"))


def collocations(df: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, part: int = PART, words_part: int = WORDS, chunk: int = CHUNK) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of each language's best phrases of 2 to ``longest`` words.

    A phrase lies within a piece of a text. Its score is that of its weakest cut, floor(1000 a n / (l r)), by
    exact arithmetic; of equal cuts the first counts. A phrase inside a longer one that is as frequent is
    dropped. Null texts have no words and a null lang is ``und``; repeated rows
    count each; ties rank by a, then by the phrase's bytes; without frequent phrases, or rows, the result is empty. Only
    text and lang are read. Phrases are at most five words long, as chunks share four.
    """
    if not 2 <= longest <= LONGEST:
        raise ValueError(f"phrases have 2 to {LONGEST} words")
    spark = df.sparkSession
    with arrow_batches(spark, BATCH):
        tables, sizes = _levels(df, least, longest, part, words_part, chunk)
    return _best(tables, sizes, top)


def _levels(df: DataFrame, least: int, longest: int, part: int, words_part: int, chunk: int) -> tuple[list[DataFrame], DataFrame]:
    """The tables of frequent phrases of 2, 3, ... words, and how many words each language has."""
    spark = df.sparkSession
    level = _Levels(spark, least, part)
    texts = df.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), text_or_empty().alias("text"))
    counts = written(texts.mapInArrow(_count_words, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("f")), f"{level.folder}/counts")
    sizes = counts.groupBy("lang").agg(F.sum("f").alias("n"))
    words, n_words = _numbered_words(counts.where(F.col("f") >= least), f"{level.folder}/words")
    level.encode(texts, words, max(1, -(-n_words // words_part)), chunk)
    shorter = words.select("id", F.col("id").alias("key"), "lang", F.col("word").alias("text"), "f", F.col("id").alias("suffix"), F.expr("cast(array() as array<long>)").alias("firsts"), F.expr("cast(array() as array<long>)").alias("lasts"))
    n_windows = counts.agg(F.coalesce(F.sum("f"), F.lit(0))).first()[0]
    tables = []
    for k in range(2, longest + 1):
        phrases, n_windows = level.grow(k, n_windows)
        shorter = written(_with_parts(phrases, shorter, words, k), f"{level.folder}/level{k}")
        tables.append(shorter)
    delete_folder(spark, level.held)
    return tables, sizes


def _best(tables: list[DataFrame], sizes: DataFrame, top: int) -> DataFrame:
    rows = None
    for i, table in enumerate(tables):
        kept = table
        if i + 1 < len(tables):
            longer = tables[i + 1]
            inside = longer.where("f = f_prefix").select(F.col("prefix").alias("id")).union(longer.where("f = f_suffix").select(F.col("suffix").alias("id")))
            kept = table.join(inside, "id", "left_anti")
        kept = kept.select("lang", "text", "f", "firsts", "lasts")
        rows = kept if rows is None else rows.union(kept)
    rows = rows.join(F.broadcast(sizes), "lang")  # a row for each language
    whole = lambda c: c.cast("decimal(38,0)")
    cut = F.zip_with("firsts", F.reverse("lasts"), lambda x, y: F.struct(x.alias("l"), y.alias("r")))
    scored = F.transform(cut, lambda c, i: F.struct(_div(whole(F.lit(1000)) * whole(F.col("f")) * whole(F.col("n")), whole(c["l"]) * whole(c["r"])).alias("score"), i.alias("k"), c["l"].alias("l"), c["r"].alias("r")))
    rows = rows.withColumn("c", F.array_min(scored)).select("lang", F.col("text").alias("phrase"), F.col("f").alias("a"), "c.l", "c.r", "n", "c.score")
    order = [F.desc("score"), F.desc("a"), "phrase"]
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    near = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("rank") <= top)
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)  # at most 64 * top rows
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def _div(a, b):
    return F.call_function("div", a, b)


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(documents(spark, sf_dir))


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
OP12_SQL = rf"""with pieces as (select coalesce(lang, 'und') as lang, regexp_extract_all(unnest(regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') as w from documents),
grams as (select lang, k, array_to_string(list_slice(w, i, i + k - 1), ' ') as phrase from (select lang, k, w, unnest(generate_series(1, len(w) - k + 1)) as i from pieces, (select unnest(generate_series(1, {LONGEST})) as k) where len(w) >= k)),
f as materialized (select lang, k, phrase, count(*) as f from grams group by all),
n as (select lang, sum(f)::bigint as n from f where k = 1 group by lang),
often as materialized (select lang, k, phrase, f, string_split(phrase, ' ') as w from f where f >= {LEAST}),
cuts as (select o.lang, o.k, o.phrase, o.f as a, j, array_to_string(list_slice(w, 1, j), ' ') as p1, array_to_string(list_slice(w, j + 1, o.k), ' ') as p2
  from (select *, unnest(generate_series(1, k - 1)) as j from often where k >= 2) o),
scored as (select c.lang, c.k, c.phrase, c.a, j, x.f as l, y.f as r, n, cast((1000::hugeint * a * n) // (x.f::hugeint * y.f) as bigint) as score
  from cuts c join f x on x.lang = c.lang and x.phrase = p1 join f y on y.lang = c.lang and y.phrase = p2 join n on n.lang = c.lang),
one as (select *, row_number() over (partition by lang, phrase order by score, j) as pick from scored),
inner_ as (select distinct lang, array_to_string(list_slice(w, s, s + m - 1), ' ') as phrase, f from (
  select lang, w, f, k, m, unnest(generate_series(1, k - m + 1)) as s from often, (select unnest(generate_series(2, {LONGEST - 1})) as m) where m < k)),
kept as (select * from one o where pick = 1 and not exists (select 1 from inner_ i where i.lang = o.lang and i.phrase = o.phrase and 100 * i.f >= 100 * o.a))
select * from (select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n, score from kept) where rank <= {TOP}"""
