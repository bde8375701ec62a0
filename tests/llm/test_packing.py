import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from wakeline.llm.packing import SCHEMA, CapacityTree, best_fit_decreasing, byte_bpe, pack

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_ids_equal_the_tokenizer_over_code_points():
    tokenizer, own = Tokenizer.from_file(PATH), byte_bpe(PATH)
    points = [c for c in range(0, 0x110000, 37) if not 0xD800 <= c <= 0xDFFF]
    texts = [f"a{chr(c)}1{chr(c)}! {chr(c)}{chr(c)} {chr(c)}b" for c in points] + ["x <|endoftext|> y", "  a\n\n b ", ""]
    for text, e in zip(texts, tokenizer.encode_batch(texts, add_special_tokens=False)):
        assert own.encode(text, allowed_special="all") == e.ids


def test_tree_finds_the_tightest_window():
    rng = np.random.default_rng(1)
    tree, held = CapacityTree(64), []
    for k in range(2000):
        need = int(rng.integers(1, 65))
        room = tree.tightest(need)
        assert room == min((c for c in held if c >= need), default=None)
        if room is not None and rng.random() < 0.6:
            tree.pop(room)
            held.remove(room)
        else:
            c = int(rng.integers(1, 65))
            tree.push(c, k)
            held.append(c)


def test_best_fit_decreasing_by_hand():
    # 30 ids fill three windows of 10 whole pieces at a time.
    windows = best_fit_decreasing([5, 7, 3, 5, 2, 8], 10)
    assert sorted(sorted(i for i, _, _ in w) for w in windows) == [[0, 3], [1, 2], [4, 5]]
    # 18 ids in two windows: the third piece has no room and is cut at the widest window.
    assert best_fit_decreasing([6, 6, 6], 10) == [[(0, 0, 6), (2, 4, 2)], [(1, 0, 6), (2, 0, 4)]]
    assert best_fit_decreasing([], 10) == []


def test_best_fit_decreasing_against_a_plain_scan():
    """The same choices as looking through all windows; all ids placed, less than a window of padding."""
    rng = np.random.default_rng(3)
    for _ in range(30):
        lengths = rng.integers(1, 65, int(rng.integers(1, 120))).tolist()
        rooms = [64] * -(-sum(lengths) // 64)
        placed, queue = [], sorted(((-n, 0, i, 0) for i, n in enumerate(lengths)))
        turn = 1
        while queue:
            n, _, i, start = queue.pop(0)
            n = -n
            fits = [r for r in rooms if r >= n]
            room = min(fits) if fits else max(rooms)
            rooms[rooms.index(room)] -= min(room, n)
            placed.append((i, start, min(room, n)))
            if n > room:
                queue.append((room - n, turn, i, start + room))
                queue.sort()
                turn += 1
        windows = best_fit_decreasing(lengths, 64)
        assert sorted(p for w in windows for p in w) == sorted(placed)
        assert sorted(64 - sum(p[2] for p in w) for w in windows) == sorted(rooms) and sum(rooms) < 64


def check(rows, tokenizer, texts, size):
    by_row, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_row[r.doc_id].append(r)
        by_seq[r.sequence_id].append(r)
    for doc_id, text in texts.items():
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        got = sorted(by_row[doc_id], key=lambda r: r.start)
        assert sum(r.length for r in got) == len(ids) == got[0].doc_tokens
        at = 0
        for r in got:
            assert r.start == at and r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
    for got in by_seq.values():
        at = 0
        for r in sorted(got, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= size and got[0].padded_to == (at if at & (at - 1) == 0 else size)


def test_every_id_lies_in_one_piece(make, prose):
    texts = {i: prose(i, 40 + 13 * (i % 60)) for i in range(200)}
    rows = pack(make(list(texts.items()), extra=True).repartition(3), PATH, size=256).collect()
    check(rows, Tokenizer.from_file(PATH), texts, 256)
    seen = {r.sequence_id: r.padded_to for r in rows}
    assert sum(seen.values()) < 1.03 * sum(r.length for r in rows)


def test_equal_lengths_are_not_padded_to_twice(make):
    rows = pack(make([(i, "word " * 600) for i in range(64)]).coalesce(1), PATH).collect()
    seen = {r.sequence_id: r.padded_to for r in rows}
    assert sum(seen.values()) < sum(r.length for r in rows) + 1024


def test_odd_rows(make, odd_rows, spark):
    rows = pack(make(odd_rows, extra=True), PATH).collect()
    check(rows, Tokenizer.from_file(PATH), {d: t for d, t in odd_rows if d not in (8, None)}, 1024)
    assert sum(r.start == 0 for r in rows) == len(odd_rows)
    empty = pack(make([]), PATH)
    assert empty.count() == 0 and [f.name for f in empty.schema] == [p.split()[0] for p in SCHEMA.split(", ")]
