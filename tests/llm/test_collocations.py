"""Collocations against counting every phrase, and the perfect hash."""

import random
import re
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from wakeline.llm import collocations as c

SCHEMA = "doc_id long, text string, lang string, phrase string, rank string"


def plain(rows, least, longest, top):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = lang or "und"
        low = "".join(ch.lower() if "A" <= ch <= "Z" else ch for ch in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                f.update((lang, tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    often = {key: a for key, a in f.items() if a >= least}
    gone = set()
    for (lang, w), a in often.items():
        for m in range(2, len(w)):
            gone.update((lang, w[i : i + m]) for i in range(len(w) - m + 1) if 100 * a >= 100 * f[lang, w[i : i + m]])
    made = {}
    for (lang, w), a in often.items():
        if len(w) < 2 or (lang, w) in gone:
            continue
        score, _, left, right = min((1000 * a * n[lang] // (f[lang, w[:j]] * f[lang, w[j:]]), j, f[lang, w[:j]], f[lang, w[j:]]) for j in range(1, len(w)))
        made.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), left, right))
    return sorted((lang, i + 1, p.decode(), -a, left, right, n[lang], -s) for lang, found in made.items() for i, (s, a, p, left, right) in enumerate(sorted(found)[:top]))


def corpus(seed, n):
    rng = random.Random(seed)
    words = ["A", "bé", "c", "dD", "e", "ünï", "g", "h h", " ", "x'y"]
    made = []
    for i in range(n):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", "\t", "  ", ", ", "\n", "\x0b", " . "]) for _ in range(rng.randint(0, 60)))
        made.append((text + "new york city hall " * rng.randint(0, 3), rng.choice(["en", "de", None, "und"])))
    return made


@pytest.mark.parametrize(("least", "longest", "top", "part", "words", "chunk"), [(5, 5, 2000, 1 << 21, 1 << 20, 1 << 17), (3, 4, 20, 40, 3, 50), (4, 5, 7, 1000, 1 << 20, 7), (2, 2, 50, 9, 5, 1000)])
def test_as_plain_counting(spark, least, longest, top, part, words, chunk):
    rows = corpus(least, 150)
    df = spark.createDataFrame([(i, t, lang, "clash", "clash") for i, (t, lang) in enumerate(rows)], SCHEMA)
    got = c.collocations(df, least, longest, top, part, words, chunk).collect()
    assert sorted(map(tuple, got)) == plain(rows, least, longest, top)


def test_edge_cases(spark, odd_rows):
    assert c.collocations(spark.createDataFrame([], SCHEMA)).collect() == []
    assert c.collocations(spark.createDataFrame([(1, None, None, "", ""), (2, "a b", "en", "", "")], SCHEMA)).collect() == []
    rows = [(t, None) for _, t in odd_rows]
    got = c.collocations(spark.createDataFrame([(d, t, None, "", "") for d, t in odd_rows], SCHEMA)).collect()
    assert got and sorted(map(tuple, got)) == plain(rows, c.LEAST, 5, c.TOP)


def test_exact_scores(spark):
    """Products beyond 64 bits, by the expression that scores phrases."""
    from pyspark.sql import functions as F

    a, n, left, right = 9_007_199_254_740_993, 4_000_000_000_000_037, 9_007_199_254_740_997, 9_007_199_254_741_011
    row = spark.createDataFrame([(a, n, left, right)], "a long, n long, l long, r long")
    whole = lambda x: F.col(x).cast("decimal(38,0)")
    assert row.select(c._div(F.lit(1000).cast("decimal(38,0)") * whole("a") * whole("n"), whole("l") * whole("r"))).first()[0] == 1000 * a * n // (left * right)


def test_slots_are_minimal_and_verified():
    rng = np.random.default_rng(3)
    keys = np.unique(rng.integers(0, 1 << 62, 50_000))
    slots = c.Slots(keys)
    assert sorted(slots[keys].tolist()) == list(range(len(keys)))
    others = np.setdiff1d(rng.integers(0, 1 << 62, 50_000), keys)
    assert (slots[others] == -1).all()
    assert (c.Slots(keys[:0])[others] == -1).all()


def test_more_buckets_take_no_more_jobs(spark, monkeypatch):
    """The buckets' passes over the words once grew with the words, each of them reading all."""
    rows = corpus(7, 150)
    df = spark.createDataFrame([(i, t, lang, "clash", "clash") for i, (t, lang) in enumerate(rows)], SCHEMA)
    context, jobs = spark.sparkContext, []
    for load in (c.LOAD, Fraction(256, c.BUCKETS)):  # 256 windows for each part of the buckets
        monkeypatch.setattr(c, "LOAD", load)
        context.setJobGroup(f"collocations {load}", "")
        assert sorted(map(tuple, c.collocations(df, 5).collect())) == plain(rows, 5, 5, c.TOP)
        jobs.append(len(context.statusTracker().getJobIdsForGroup(f"collocations {load}")))
    context.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[0] and jobs[1] <= jobs[0] + 4


@pytest.mark.parametrize("numbers", [[0], [5, 5, 5, 6], [0, 0, 1 << 61], list(range(0, 70_000, 255)), [1 << 40] * 3])
def test_packed_numbers(numbers):
    assert c.unpacked(c.packed(np.array(numbers, np.uint64))).tolist() == numbers
