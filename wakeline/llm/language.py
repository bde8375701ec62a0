"""Operator 2, language identification as inference of a multilingual mixture.

Each language has a model of character trigrams (hashed to a fixed table).
A document is a mixture: each of its words is drawn from one language, with
unknown proportions. For a set of languages, expectation-maximisation
estimates the proportions from the words' trigram likelihoods; languages join
the set, best first, while the likelihood less a penalty for each language
(half its logarithm of the number of words, as in BIC) rises. The predicted
language is the one with the largest share, which is the score.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.llm.common import arrow_rows, documents, text_or_empty

#: Size of the trigram table, a power of two.
TABLE = 1 << 16
#: Labelled rows that a language's model is fitted on, about.
SAMPLE = 2_000
ROUNDS = 12
SMOOTHING = 0.5
#: Documents that are worked together in a task have so many code points at most; a longer one is worked in pieces.
BLOCK = 1 << 20
#: With more languages than these the blocks are smaller, for a task's memory.
WIDE = 64
#: Trigrams that are counted at once.
COUNTED = 1 << 20


def trigrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Table places of the lower-cased text's trigrams, and the first trigram of each word.

    Words are runs of letters and marks; each is flanked by a space.
    """
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    # Letters and marks: all of them lie outside this list of ASCII and general punctuation.
    other = (points < 97) | ((points > 122) & (points < 170)) | ((points >= 0x2000) & (points < 0x2070)) | ((points >= 0x3000) & (points < 0x3005)) | (points >= 0xFF00) & (points < 0xFF21)
    x = np.where(other, np.uint32(32), points)
    keep = np.ones(len(x), bool)
    keep[1:] = ~(other[1:] & other[:-1])
    x = np.concatenate((np.array([32], np.uint32), x[keep], np.array([32], np.uint32))).astype(np.uint64)
    if x[1] == 32:
        x = x[1:]
    if len(x) > 1 and x[-2] == 32:
        x = x[:-1]
    if len(x) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    h = (x[:-2] * np.uint64(0x9E3779B97F4A7C15) + x[1:-1]) * np.uint64(0xC2B2AE3D27D4EB4F) + x[2:]
    h *= np.uint64(0x165667B19E3779F9)
    spots = (h >> np.uint64(64 - int(math.log2(TABLE)))).astype(np.int64)
    within = x[1:-1] != 32  # trigrams centred on a space span two words
    starts = np.flatnonzero((x[:-2] == 32) & within)
    shift = np.cumsum(within) - within
    return spots[within], shift[starts]


def has_letter(text: str) -> bool:
    return any(c.isalpha() for c in text)


def train(df: DataFrame, sample: int = SAMPLE) -> tuple[list[str], np.ndarray]:
    """Languages and their (TABLE, languages) log-likelihoods from ``df``'s (text, lang, pick).

    About ``sample`` rows of each language are read, those with the smallest
    ``pick`` (a hash of the row). Every language is learned; the trigram counts come back as one row for
    each language and trigram, TABLE of them a language at most.
    """
    known = df.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = known.groupBy("lang").count()
    names = sorted(r["lang"] for r in sizes.select("lang").collect())
    if not names:
        return [], np.zeros((TABLE, 0), np.float32)
    # An arithmetic test on a uniform hash: no shuffle, and the same rows at every retry.
    share = F.least(F.lit(1.0), F.lit(sample) / F.col("count"))
    picked = known.join(F.broadcast(sizes), "lang").where(F.pmod("pick", F.lit(1_000_003)) < share * 1_000_003).select("lang", "text")
    number = {name: i for i, name in enumerate(names)}

    def counted(codes: list[np.ndarray]) -> pa.RecordBatch:
        code, n = np.unique(np.concatenate(codes), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(code // TABLE), pa.array(code % TABLE), pa.array(n)], names=["lang", "spot", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, size = [], 0
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                codes.append(number[lang] * TABLE + trigrams(text)[0])
                size += len(codes[-1])
                if size > COUNTED:
                    yield counted(codes)
                    codes, size = [], 0
        if codes:
            yield counted(codes)

    found = picked.mapInArrow(count, "lang long, spot long, n long").groupBy("lang", "spot").agg(F.sum("n").alias("n")).collect()
    table = np.full((TABLE, len(names)), SMOOTHING)
    for lang, spot, n in found:
        table[spot, lang] += n
    return names, np.log(table / table.sum(axis=0)).astype(np.float32)


def _cuts(text: str, size: int) -> Iterator[str]:
    """The text in pieces of ``size`` code points at most, cut after a blank or line end of a piece's second half; else a word is cut."""
    at = 0
    while len(text) - at > size:
        middle, end = at + size // 2, at + size
        end = max(text.rfind(" ", middle, end), text.rfind("\n", middle, end)) + 1 or end
        yield text[at:end]
        at = end
    yield text[at:]


def _likelihoods(texts: list[str], model: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each word's text and its likelihood under each language, scaled so that a word's largest is 1."""
    parts = [trigrams(t) for t in texts]
    sizes = [len(s) for _, s in parts]
    if not sum(sizes):
        return np.zeros(0, np.int64), np.zeros((0, model.shape[1]))
    base = np.concatenate(([0], np.cumsum([len(p) for p, _ in parts])[:-1]))
    starts = np.concatenate([s + b for (_, s), b in zip(parts, base)])
    logs = np.add.reduceat(model[np.concatenate([p for p, _ in parts])], starts, axis=0).astype(np.float64)
    return np.repeat(np.arange(len(texts)), sizes), np.exp(logs - logs.max(axis=1, keepdims=True))


#: A pass over (text of each word, values of each word) in parts.
Pass = Callable[[], Iterable[tuple[np.ndarray, np.ndarray]]]


def _passes(make: Pass, hold: bool) -> Pass:
    """``make``, or its parts kept for all passes."""
    if not hold:
        return make
    parts = list(make())
    return lambda: parts


def _summed(parts: Iterable[tuple[np.ndarray, np.ndarray]], docs: int, width: int) -> np.ndarray:
    """Sums (docs, width) of the words' values by text; a part's words come text by text."""
    sums = np.zeros((docs, width))
    for doc, values in parts:
        if len(doc):
            starts = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1])))
            sums[doc[starts]] += np.add.reduceat(values, starts, axis=0)
    return sums


def _rise(words: Pass, shares: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """EM over the columns of each text's set alone: shares (docs, languages of a set) and log-likelihoods.

    ``words`` passes over the likelihoods of the set's languages, in its order.
    """
    docs, size = shares.shape

    def drawn(now: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for doc, like in words():
            joint = like * now[doc]
            yield doc, joint / np.maximum(joint.sum(axis=1, keepdims=True), 1e-30)

    for _ in range(ROUNDS):
        shares = _summed(drawn(shares), docs, size) / count[:, None]
    logs = ((doc, np.log(np.maximum((like * shares[doc]).sum(axis=1, keepdims=True), 1e-30))) for doc, like in words())
    return shares, _summed(logs, docs, 1)[:, 0]


def infer(texts: list[str], model: np.ndarray, piece: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """Index and share of each text's main language (of texts that have trigrams; else -1, 0).

    Of equal shares, and of equally likely first languages, the one with the smallest index counts.
    Texts of more than ``piece`` code points in all are not held as likelihoods: every
    pass makes them anew, piece by piece; a word longer than a piece counts as several.
    """
    docs, langs = len(texts), model.shape[1]
    hold = sum(map(len, texts)) <= piece

    def made() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        if hold:
            yield _likelihoods(texts, model)
            return
        for k, text in enumerate(texts):
            for cut in _cuts(text, piece):
                doc, like = _likelihoods([cut], model)
                yield doc + k, like

    words = _passes(made, hold)
    facts = _summed(((doc, np.column_stack((np.log(np.maximum(like, 1e-30)), np.ones(len(doc))))) for doc, like in words()), docs, langs + 1)
    whole, count = facts[:, :-1], facts[:, -1]
    top, share = np.where(count > 0, whole.argmax(axis=1), -1), np.where(count > 0, 1.0, 0.0)
    penalty = 0.5 * np.log(np.maximum(count, 2))
    live = np.flatnonzero(count > 0)  # texts whose sets still grow, with their sets, shares and worth
    sets, shares = top[live, None], np.ones((len(live), 1))
    worth = whole[live, top[live]] - penalty[live]
    for size in range(2, langs + 1):
        if not len(live):
            break
        place = np.full(docs, -1)
        place[live] = np.arange(len(live))

        def of_live(place: np.ndarray = place) -> Iterator[tuple[np.ndarray, np.ndarray]]:
            for doc, like in words():
                use = place[doc] >= 0
                yield place[doc[use]], like[use]

        def gains(sets: np.ndarray = sets, shares: np.ndarray = shares, rows: Pass = of_live) -> Iterator[tuple[np.ndarray, np.ndarray]]:
            for doc, like in rows():
                mixed = np.maximum((np.take_along_axis(like, sets[doc], 1) * shares[doc]).sum(axis=1, keepdims=True), 1e-30)
                yield doc, np.maximum(np.log(np.maximum(like, 1e-30) / mixed), 0)

        # The next language to try is the one most words gain by, given the set so far.
        gain = _summed(gains(), len(live), langs)
        np.put_along_axis(gain, sets, -1, 1)
        wider = np.column_stack((sets, gain.argmax(axis=1)))
        trial = np.column_stack((shares * (1 - 1 / size), np.full(len(live), 1 / size)))

        def of_set(wider: np.ndarray = wider, rows: Pass = of_live) -> Iterator[tuple[np.ndarray, np.ndarray]]:
            return ((doc, np.take_along_axis(like, wider[doc], 1)) for doc, like in rows())

        trial, total = _rise(_passes(of_set, hold), trial, count[live])
        now = total - size * penalty[live]
        better = now > worth
        live, sets, shares, worth = live[better], wider[better], trial[better], now[better]
        share[live] = shares.max(axis=1)
        top[live] = np.where(shares == share[live, None], sets, langs).min(axis=1)
    return top, share


def identify(df: DataFrame, names: list[str], model: np.ndarray) -> DataFrame:
    """(doc_id, lang_pred, score) for each row of ``df`` (doc_id, text).

    A null text, one without a letter, or any text where no language could
    be learned is ``und`` with score 0. Rows are answered one for one; whole
    texts are read, however long: one of more than a block is read again, piece by piece, for each pass of EM.
    """
    schema = "doc_id long, lang_pred string, score double"
    shared = df.sparkSession.sparkContext.broadcast(model)
    block = BLOCK * WIDE // max(WIDE, len(names))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            first = 0
            while first < len(texts):
                last, size = first, 0
                while last < len(texts) and (last == first or size + len(texts[last]) <= block):
                    size += len(texts[last])
                    last += 1
                top, share = infer(texts[first:last], shared.value, block) if names else ([-1] * (last - first), [0.0] * (last - first))
                rows = []
                for doc_id, text, k, s in zip(ids[first:last], texts[first:last], top, share):
                    sure = k >= 0 and has_letter(text)
                    rows.append((doc_id, names[k] if sure else "und", min(1.0, float(s)) if sure else 0.0))
                yield arrow_rows(rows, schema)
                first = last

    return df.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(run, schema)


def op2_language(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held_out = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))
    learn = docs.where(~held_out).select("text", "lang", F.xxhash64("doc_id").alias("pick"))
    names, model = train(learn)
    found = identify(docs, names, model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
