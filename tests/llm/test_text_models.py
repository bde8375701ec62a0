import hashlib
import random
import re

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from wakeline.llm import bpe, language, ordermin, quality

WORD_PATH = public_tokenizers.path("word_bpe_49k.json")


def test_bpe_equals_the_tokenizer():
    codec, library = bpe.codec(WORD_PATH), Tokenizer.from_file(WORD_PATH)
    rng = random.Random(3)
    texts = ["", " ", "<|startoftext|>Hi<|endoftext|> you", "İSTANBUL ΣΑΣ don't 'S", "a" * 3000, "</w> a</w>", "a\x1cb\x85c\xa0d\u2028e \u0301x", "x<|endoftext|>\u0301y <|endoftext|><|startoftext|>"]
    for k in range(600):
        alphabet = ["abcdeehillnoprsstttuwxyz", "!?.,-=#*/\\()[]{}~^_+<>|&%$@:;'\"", "".join(map(chr, range(160, 1400, 7))), "日本語テキスト😀 ab 12"][k % 4]
        texts.append("".join(rng.choice(alphabet) for _ in range(rng.randint(1, 60))))
    for text in texts:
        ids = library.encode(text, add_special_tokens=False).ids
        got = codec.encode(text)
        assert np.frombuffer(got, "<u4").tolist() == ids
        assert codec.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_bpe_state_stays_small():
    codec = bpe.codec(WORD_PATH)
    assert codec.merges.lookahead == max(map(len, codec.merges.id_of)) - 1
    state, longest = codec.encoder.start, 0
    rng = random.Random(9)
    for _ in range(4000):
        _, state = codec.encoder._step(state, rng.choice("etaoinshrdlu"))
        longest = max(longest, len(state.symbols))
    assert longest <= 3 * codec.merges.lookahead


def test_byte_decoder_against_the_tokenizer():
    """Random ids split characters anywhere; the machine never holds more than an unfinished one."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    codec, library = bpe.codec(path), Tokenizer.from_file(path)
    rng = random.Random(7)
    rare = [i for t, i in library.get_vocab().items() if len(t) == 1]
    for k in range(400):
        ids = [rng.choice(rare) if rng.random() < 0.5 else rng.randrange(50_257) for _ in range(rng.randint(0, 60))]
        assert codec.decode(ids) == library.decode(ids, skip_special_tokens=False)
    text = "ünï 日本 😀" * 50
    ids, decoder, out = library.encode(text, add_special_tokens=False).ids, codec.decoder(), ""
    for token in ids:
        out += decoder.feed(token)
        assert text.startswith(out) and len(decoder.utf8.getstate()[0]) <= 3
    assert out + decoder.close() == text
    assert np.frombuffer(codec.encode(text), "<u4").tolist() == ids


def test_full_tables_change_nothing(monkeypatch):
    monkeypatch.setattr(bpe, "CHUNKS", 3)
    monkeypatch.setattr(bpe, "WORDS", 3)
    monkeypatch.setattr(bpe, "STATES", 5)
    small, codec = bpe.Codec(WORD_PATH), bpe.codec(WORD_PATH)
    for text in ("the cat, the hat; the very long words of it", "unbelievably many unrememberable words"):
        assert small.encode(text) == codec.encode(text)


def test_bpe_odd_rows(make, odd_rows):
    df = make(odd_rows, extra=True)
    got = bpe.digests(df, WORD_PATH).collect()
    assert len(got) == len(odd_rows)
    none = [r for r in got if r.doc_id == 1][0]
    assert none.n_tokens == 0 and none.ids_sha256 == none.decoded_sha256 == hashlib.sha256(b"").hexdigest()
    back = bpe.decode(bpe.encode(df, WORD_PATH), WORD_PATH).where("doc_id = 5").first()
    assert back.decoded == "a</w> b</w> c</w>"
    assert bpe.digests(make([]), WORD_PATH).count() == 0


def test_language_held_out(spark):
    rng = random.Random(4)
    sounds = {"aa": ["ka", "to", "mi"], "bb": ["sch", "ung", "ein"], "cc": ["ción", "ñe", "rro"]}
    rows = [(i, " ".join("".join(rng.choices(sounds[k], k=3)) for _ in range(60)), k) for i, k in enumerate(["aa", "bb", "cc"] * 60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    names, model = language.train(df.where("doc_id % 3 < 3 and doc_id < 120").withColumn("pick", F.xxhash64("doc_id")))
    got = {r.doc_id: r for r in language.identify(df, names, model).collect()}
    assert all(got[i].lang_pred == k for i, _, k in rows)
    mixed = rows[0][1] + " " + " ".join(rows[1][1].split()[:20])
    one = language.identify(spark.createDataFrame([(0, mixed)], "doc_id long, text string"), names, model).first()
    assert one.lang_pred == "aa" and 0.65 < one.score < 0.85


def test_every_labelled_language_is_learned(spark):
    """300 languages, each with words of its own two letters; the last ones are the rarest."""
    rows = []
    for k in range(300):
        one, two = chr(0x4E00 + 2 * k), chr(0x4E01 + 2 * k)
        words = f"{one}{two}{one} {two}{one}{one} {one}{one}{two}{two} {two}{two}{one}"
        rows += [(len(rows) + n, f"{words} {words}", f"l{k:03}") for n in range(2 if k < 280 else 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    names, model = language.train(df.withColumn("pick", F.xxhash64("doc_id")))
    assert names == [f"l{k:03}" for k in range(300)] and model.shape == (language.TABLE, 300)
    got = {r.doc_id: r.lang_pred for r in language.identify(df.where("doc_id >= 540"), names, model).collect()}
    assert got == {d: lang for d, _, lang in rows if d >= 540}


def test_language_odd_rows(make, odd_rows, spark):
    df = make(odd_rows, extra=True)
    names, model = language.train(df.withColumn("pick", F.xxhash64("doc_id")))
    got = language.identify(df, names, model).collect()
    assert len(got) == len(odd_rows)
    assert {r.doc_id: r.lang_pred for r in got}[10] == "und" and {r.doc_id: r.lang_pred for r in got}[1] == "und"
    assert all(0 <= r.score <= 1 for r in got)
    names, model = language.train(df.where("false").withColumn("pick", F.xxhash64("doc_id")))
    assert {r.lang_pred for r in language.identify(df, names, model).collect()} == {"und"}
    assert language.identify(make([]), names, model).count() == 0


def brute(text):
    text = text or ""
    words, seen, covered = re.findall(r"[^\x20\x09-\x0D]+", text), {}, set()
    for k in range(len(words) - 2):
        seen.setdefault(tuple(words[k : k + 3]), []).append(k)
    for places in seen.values():
        if len(places) > 1:
            for k in places:
                covered |= {k, k + 1, k + 2}
    lines = [s for s in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", s)]
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)


def test_quality_statistics(make, odd_rows, prose):
    rows = [*odd_rows, (20, "a b c a b c a"), (21, "x\n\nx\n y\nx"), (22, prose(1)), (23, "# a * b | c\x0bd\x1ce")]
    got = quality.judge(make(rows, extra=True), []).collect()
    assert sorted(tuple(r[c] for c in quality.BASE) for r in got) == sorted(brute(t) for _, t in rows)
    assert all(r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) for r in got)
    assert quality.judge(make([]), []).count() == 0


def test_quality_learns_junk(make, prose, spark):
    rows = [(i, prose(i) if i % 4 else " ".join(w + "##" for w in prose(i).split())) for i in range(400)]
    labels = spark.createDataFrame([(i, int(i % 4 > 0)) for i in range(0, 400, 2)], "doc_id long, quality int")
    docs = make(rows)
    rules = quality.fit(docs, labels)
    assert rules
    assert all(r.kept == (r.doc_id % 4 > 0) for r in quality.judge(docs, rules).collect())
    assert quality.fit(docs, labels.where("false")) == []


def test_order_minhash_rows(make, odd_rows, prose):
    rows = [(i * 3, prose(i, 30 + i)) for i in range(40)]
    got = {r.doc_id: r for r in ordermin.fingerprint_edits(make(rows, extra=True), ranges=5).collect()}
    for k, (doc_id, text) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        new = text[: len(text) - len(text) // 4] + after[: len(text) // 4]
        prints = [ordermin.order_minhash(t) for t in (text, new, after)]
        r = got[doc_id]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(new.encode()).hexdigest()
        assert r.near_edited == ordermin.likeness(prints[0], prints[1]) > r.near_next == ordermin.likeness(prints[0], prints[2])
    odd = ordermin.fingerprint_edits(make(odd_rows, extra=True), ranges=3).collect()
    assert len(odd) == len(odd_rows)
    assert len({r.fingerprint for r in odd if r.doc_id in (7, 8)}) == 1
    assert ordermin.fingerprint_edits(make([])).count() == 0
    alone = ordermin.fingerprint_edits(make([(1, "abcdefgh")])).collect()
    assert len(alone) == 1 and alone[0].near_next == 1.0


def plain_order_minhash(text):
    """Selection, text order and tuples spelled out with Python integers."""
    mask = (1 << 64) - 1
    mix = 0x9E3779B97F4A7C15

    def mixed(x):
        x = ((x ^ x >> 29) * 0xBF58476D1CE4E5B9) & mask
        return x ^ x >> 32

    width = min(ordermin.KMER, len(text))
    grams = [text[i : i + width] for i in range(len(text) - width + 1)] if text else []
    base, count = [], {}
    for gram in grams:
        h = 0
        for c in gram:
            h = ((h + ord(c) + 1) * mix) & mask
        h = mixed(h)
        n = count[gram] = count.get(gram, -1) + 1
        base.append(mixed((h + n * mix) & mask) if n else h)
    out = []
    for odd in ordermin._ODD.tolist():
        chosen = sorted(range(len(base)), key=lambda i: ((base[i] * odd) & mask, i))[: ordermin.TUPLE]
        h = 0
        for t, i in enumerate(sorted(chosen)):
            h = mixed((h * mix + base[i] + t + 1) & mask)
        out.append(h >> 32 if base else 0)
    return out


def test_order_minhash_brute_force():
    rng = random.Random(2)
    texts = ["", "a", "abc", "aaaaaaaaaaaaaaa", "the cat and the hat and the cat sat", "ünï 日本 😀" * 9]
    texts += ["".join(rng.choice("abc ") for _ in range(rng.randint(1, 300))) for _ in range(60)]
    for text in texts:
        assert ordermin.order_minhash(text).tolist() == plain_order_minhash(text)


def test_order_counts():
    """Moving the halves of a text keeps its k-mers but not their order."""
    text, moved = "the cat and the hat ran off; a dog in a bog sat on", " a dog in a bog sat onthe cat and the hat ran off;"
    assert ordermin.likeness(ordermin.order_minhash(text), ordermin.order_minhash(moved)) < 0.8
    assert ordermin.likeness(ordermin.order_minhash(text), ordermin.order_minhash(text[:-1] + "x")) > 0.7


def test_mixture_in_pieces():
    """Texts longer than a piece: the same sets and shares as in one piece; a word longer than a piece is no obstacle."""
    rng = np.random.default_rng(16)
    model = np.log(rng.dirichlet(np.full(language.TABLE, 0.05), 5).T + 1e-9).astype(np.float32)
    texts = [" ".join("".join(rng.choice(list("abcdefghij"), int(n))) for n in rng.integers(1, 9, 400)) for _ in range(6)]
    texts = [*texts, "", "12 34", texts[0].replace(" ", "\n"), "ab"]
    for text in texts:
        cuts = list(language._cuts(text, 100))
        assert "".join(cuts) == text and max(map(len, cuts)) <= 100
    top, share = language.infer(texts, model)
    for piece in (100, 1000):
        again, shares = language.infer(texts, model, piece)
        assert again.tolist() == top.tolist() and np.allclose(shares, share)
    assert top.tolist()[6:8] == [-1, -1] and share.tolist()[6:8] == [0, 0] and top[8] == top[0]
    long, sure = language.infer(["x" * 5000], model, 100)
    assert long[0] >= 0 and 0 < sure[0] <= 1


def test_mixture_against_plain_em():
    """EM with dictionaries, one text at a time, over the same likelihoods."""
    rng = np.random.default_rng(6)
    model = np.log(rng.dirichlet(np.full(language.TABLE, 0.05), 4).T + 1e-9).astype(np.float32)
    letters = "abcdefghij"
    texts = [" ".join("".join(rng.choice(list(letters), 4)) for _ in range(int(n))) for n in rng.integers(1, 40, 25)]
    top, share = language.infer(texts, model)
    for text, k, s in zip(texts, top.tolist(), share.tolist()):
        spots, starts = language.trigrams(text)
        ends = [*starts[1:].tolist(), len(spots)]
        logs = [[sum(float(model[spots[i], lang]) for i in range(a, b)) for lang in range(4)] for a, b in zip(starts.tolist(), ends)]
        like = [[np.exp(x - max(row)) for x in row] for row in logs]
        penalty = 0.5 * np.log(max(len(like), 2))
        whole = [sum(np.log(max(row[lang], 1e-30)) for row in like) for lang in range(4)]
        best = {int(np.argmax(whole)): 1.0}
        worth = max(whole) - penalty
        while len(best) < 4:
            mixed = [sum(row[x] * w for x, w in best.items()) for row in like]
            gain = {x: sum(max(0.0, np.log(max(row[x], 1e-30) / max(m, 1e-30))) for row, m in zip(like, mixed)) for x in range(4) if x not in best}
            new = max(gain, key=lambda x: gain[x])
            size = len(best) + 1
            trial = {x: w * (1 - 1 / size) for x, w in best.items()} | {new: 1 / size}
            for _ in range(language.ROUNDS):
                shares = dict.fromkeys(trial, 0.0)
                for row in like:
                    total = max(sum(row[x] * w for x, w in trial.items()), 1e-30)
                    for x, w in trial.items():
                        shares[x] += row[x] * w / total / len(like)
                trial = shares
            total = sum(np.log(max(sum(row[x] * w for x, w in trial.items()), 1e-30)) for row in like)
            if total - size * penalty <= worth:
                break
            best, worth = trial, total - size * penalty
        assert abs(max(best.values()) - s) < 1e-3
        assert max(best, key=lambda x: best[x]) == k or sorted(best.values())[-1] - sorted(best.values())[-2] < 1e-3


def test_learner_finds_a_conjunction():
    """Bad rows need two conditions; a plain search over all threshold pairs agrees."""
    rng = np.random.default_rng(1)
    n = 3000
    values = {"x": rng.random(n), "y": rng.random(n), "noise": rng.random(n)}
    bad = (values["x"] > 0.6) & (values["y"] <= 0.4)
    rules = quality.learn_rules(values, bad, rng.integers(0, 3, n))
    caught = np.zeros(n, bool)
    for rule in rules:
        caught |= quality._covers(rule, values, np.ones(n, bool))
    assert any({c.feature for c in rule} == {"x", "y"} for rule in rules)
    assert np.count_nonzero(caught & ~bad) < 0.01 * n and np.count_nonzero(caught & bad) > 0.9 * np.count_nonzero(bad)
    # Noise teaches nothing: what growing finds there is pruned or refused.
    assert quality.learn_rules(values, rng.random(n) < 0.3, rng.integers(0, 3, n)) == []


def test_a_vague_rule_hides_no_later_one():
    """The best first rule is too imprecise to take; a rule for other bad rows is learned all the same."""
    rng = np.random.default_rng(5)
    n = 6_000
    values = {name: rng.random(n) for name in ("a", "b")}
    vague, sure = values["a"] > 0.8, values["b"] < 0.02
    bad = (vague & (rng.random(n) < 0.7)) | sure
    rules = quality.learn_rules(values, bad, rng.integers(0, 3, n))
    caught = np.zeros(n, bool)
    for rule in rules:
        caught |= quality._covers(rule, values, np.ones(n, bool))
    assert np.count_nonzero(caught & sure) >= 0.9 * np.count_nonzero(sure)
    assert np.count_nonzero(caught & ~bad) <= 0.06 * np.count_nonzero(caught)


def test_repeated_labels_count_once(make, prose, spark):
    rows = [(i, prose(i) if i % 4 else " ".join(w + "##" for w in prose(i).split())) for i in range(200)]
    labels = spark.createDataFrame([(i, int(i % 4 > 0)) for i in range(200)] + [(1, 1)] * 500 + [(2, None)], "doc_id long, quality int")
    docs = make(rows + rows[:3] * 20)
    rules = quality.fit(docs, labels)
    assert rules and rules == quality.fit(make(rows), labels.dropDuplicates())
