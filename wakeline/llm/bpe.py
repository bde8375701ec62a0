"""Operator 3, BPE encoding and decoding by streaming transducers.

Encoding. A merge list splits a piece of text in one way, and a list of tokens is
that way exactly if each two neighbours are the split of what they spell
together. So the last token of every prefix can be told from the last tokens
of shorter prefixes, a symbol at a time. What is undecided after a symbol is
only which of the recent boundaries the next token will start from: a
boundary stays open while the symbols since it begin some token. Tokens that
all open boundaries agree on are stable and emitted at once. The merge list's
sufficient lookahead is thus the longest token less one symbol
(``Merges.lookahead``); no more symbols need be held to decide a boundary.
States and steps are tabulated when first met, in tables of bounded size, and so are
whole words and chunks of text between ASCII white space.

Decoding. A second machine takes token ids one by one and holds at most an
unfinished UTF-8 sequence (byte-level decoding) or whether a blank is due
(tokenizers without a decoder join token strings with blanks). Text comes out
as it is finished; nothing waits for the document's end.
"""

from __future__ import annotations

import codecs
import hashlib
import json
import re
from array import array
from collections.abc import Callable, Iterable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.llm.common import arrow_rows, documents, text_or_empty
from wakeline.llm.packing import byte_alphabet

WORD_END = "</w>"
#: Entries that a task's tables hold at most.
STATES = 250_000
PAIRS = 400_000
WORDS = 800_000
CHUNKS = 400_000
#: Longer words and chunks are encoded but not remembered.
LONG_WORD = 64
#: Token ids whose text is passed on together.
PIECES = 8_192
#: Symbol of a byte that ends a word, a character outside the byte alphabet.
_ENDING = 0x1000


class Merges:
    """A tokenizer file's vocabulary and merge list over single-character symbols.

    Symbols are the byte alphabet's characters; a word's last symbol has its
    own character where the file marks word ends.
    """

    def __init__(self, spec: dict) -> None:
        model = spec["model"]
        self.marks_ends = model.get("end_of_word_suffix") == WORD_END
        self.id_of = {self._symbols(t): i for t, i in model["vocab"].items()}
        self.spelling = {i: s for s, i in self.id_of.items()}
        self.strings = {i: t for t, i in model["vocab"].items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}
        self.parts: dict[int, tuple[int, int]] = {}
        self.rank: dict[tuple[int, int], int] = {}
        self.born: dict[int, int] = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            a, b = self.id_of[self._symbols(left)], self.id_of[self._symbols(right)]
            whole = self.id_of[self._symbols(left) + self._symbols(right)]
            self.rank[a, b] = self.born[whole] = rank
            self.parts[whole] = (a, b)
        self.size = max(self.spelling) + 1
        self.lookahead = max(map(len, self.id_of)) - 1
        self.beginnings = {s[:k] for s in self.id_of for k in range(1, len(s))}
        #: What tokens end with, and the token that is just that, or -1.
        self.tails = {s[k:]: -1 for s in self.id_of for k in range(len(s))} | self.id_of
        self._fits: dict[int, bool] = {}
        self._whole: dict[int, bool] = {}

    def _symbols(self, token: str) -> str:
        if self.marks_ends and token.endswith(WORD_END) and len(token) > len(WORD_END):
            body = token[: -len(WORD_END)]
            return body[:-1] + chr(_ENDING + ord(body[-1]))
        return token

    def _spine(self, token: int, side: int) -> list[int]:
        """The pieces that lie at the token's edge (0 left, 1 right) while it is merged, smallest first."""
        spine = [token]
        while spine[-1] in self.parts:
            spine.append(self.parts[spine[-1]][side])
        return spine[::-1]

    def fits(self, left: int, right: int) -> bool:
        """Whether the two tokens' text is split into these two tokens.

        Both grow from their edge symbols; it fails if a merge across the border
        comes before the merges that would take one of the edge pieces away.
        """
        pair = left * self.size + right
        known = self._fits.get(pair)
        if known is not None:
            return known
        xs, ys = self._spine(left, 1), self._spine(right, 0)
        i = j = 0
        never, fine = 1 << 60, True
        while True:
            gone_x = self.born[xs[i + 1]] if i + 1 < len(xs) else never
            gone_y = self.born[ys[j + 1]] if j + 1 < len(ys) else never
            across = self.rank.get((xs[i], ys[j]), never)
            if across < gone_x and across <= gone_y and across < never:
                fine = False
                break
            if gone_x == gone_y == never:
                break
            if gone_x <= gone_y:
                i += 1
            else:
                j += 1
        if len(self._fits) >= PAIRS:
            self._fits.clear()
        self._fits[pair] = fine
        return fine

    def whole(self, token: int) -> bool:
        """Whether the token's own text is split into just this token."""
        if token not in self._whole:
            parts = self.parts.get(token)
            fine = True
            if parts is not None:
                pieces = [self.id_of[c] for c in self.spelling[token]]
                while len(pieces) > 1:
                    best = min((self.rank.get(p, 1 << 60), k) for k, p in enumerate(zip(pieces, pieces[1:])))
                    if best[0] == 1 << 60:
                        break
                    k = best[1]
                    pieces[k : k + 2] = [self.id_of[self.spelling[pieces[k]] + self.spelling[pieces[k + 1]]]]
                fine = pieces == [token]
            self._whole[token] = fine
        return self._whole[token]


class State:
    """What the encoder must remember: the last stable token and the undecided symbols after it.

    ``ends[k]`` is (start, token) of the last token of the first k+1 symbols.
    """

    __slots__ = ("before", "ends", "last", "steps", "symbols")

    def __init__(self, before: int, symbols: str, ends: tuple[tuple[int, int], ...]) -> None:
        self.before, self.symbols, self.ends = before, symbols, ends
        self.steps: dict[str, tuple[tuple[int, ...], State] | None] = {}  # None: asked for once
        self.last: list[int] | None = None

    def rest(self) -> list[int]:
        """The tokens that are left if the text ends here."""
        if self.last is None:
            self.last = [token for _, token in chain(self.ends, len(self.symbols))]
        return self.last


def chain(ends: Sequence[tuple[int, int]], upto: int) -> list[tuple[int, int]]:
    """(end, token) of the split of the first ``upto`` symbols."""
    out = []
    while upto:
        start, token = ends[upto - 1]
        out.append((upto, token))
        upto = start
    return out[::-1]


class Encoder:
    def __init__(self, merges: Merges) -> None:
        self.merges = merges
        self.states: dict[tuple[int, str], State] = {}
        self.start = State(-1, "", ())

    def _last(self, before: int, ends: Sequence[tuple[int, int]], symbols: str) -> tuple[int, int]:
        """(start, token) of the last token of ``symbols``, whose shorter prefixes end as ``ends`` says.

        Only one token fits, as a text has one split.
        """
        m = self.merges
        tails, known = m.tails, m._fits
        for start in range(len(symbols) - 1, -1, -1):
            token = tails.get(symbols[start:])
            if token is None:
                break
            if token >= 0:
                left = ends[start - 1][1] if start else before
                fine = left < 0 or known.get(left * m.size + token)
                if (m.fits(left, token) if fine is None else fine) and m.whole(token):
                    return start, token
        raise ValueError(f"no token for the symbol {symbols[-1]!r}")

    def _step(self, state: State, symbol: str) -> tuple[tuple[int, ...], State]:
        m = self.merges
        symbols = state.symbols + symbol
        size = len(symbols)
        found = self._last(state.before, state.ends, symbols)
        new = State(state.before, symbols, (*state.ends, found))
        stable = 0
        if symbols not in m.beginnings:  # else a token may yet begin at the last stable boundary
            open_at = [k for k in range(max(1, size - m.lookahead), size) if symbols[k:] in m.beginnings] + [size]
            chains = [chain(new.ends, k) for k in open_at]
            while all(len(c) > stable for c in chains) and len({c[stable] for c in chains}) == 1:
                stable += 1
        emitted: tuple[int, ...] = ()
        if stable:
            emitted = tuple(t for _, t in chains[0][:stable])
            cut = chains[0][stable - 1][0]
            # Ends that reach back over the cut belong to no open boundary: they are never followed.
            kept = tuple((max(0, s - cut), t) for s, t in new.ends[cut:])
            new = State(emitted[-1], symbols[cut:], kept)
        if len(self.states) >= STATES:
            self.states.clear()
            self.start.steps.clear()
        new = self.states.setdefault((new.before, new.symbols), new)
        return emitted, new

    def stream(self, symbols: Iterable[str]) -> Iterator[int]:
        """Token ids, each as soon as it is stable."""
        state = self.start
        for symbol in symbols:
            step = state.steps.get(symbol)
            if step is None:
                step = state.steps[symbol] = self._step(state, symbol)
            yield from step[0]
            state = step[1]
        yield from state.rest()

    def tokens(self, symbols: str) -> list[int]:
        """The stream's ids of a short piece, gathered; its end is known, so what follows the last tabulated state needs none.

        A step is tabulated when it is asked for again; till then only the last tokens of the
        piece's remaining prefixes are told.
        """
        state, out, at, last = self.start, [], 0, len(symbols) - 1
        while at < last:
            symbol = symbols[at]
            step = state.steps.get(symbol)
            if step is None:
                if symbol not in state.steps:
                    state.steps[symbol] = None
                    break
                step = state.steps[symbol] = self._step(state, symbol)
            if step[0]:
                out += step[0]
            state = step[1]
            at += 1
        held, ends = state.symbols + symbols[at:], list(state.ends)
        for size in range(len(state.symbols) + 1, len(held) + 1):
            ends.append(self._last(state.before, ends, held[:size]))
        return out + [token for _, token in chain(ends, len(held))]


class Decoder:
    """Token ids to text, one at a time.

    ``blanks``: token strings joined with blanks; else the tokens' bytes as
    UTF-8, ill-formed ones replaced.
    """

    def __init__(self, strings: dict[int, str], spaced: dict[int, str], blanks: bool) -> None:
        self.strings, self.spaced, self.blanks = strings, spaced, blanks
        self.bytes = byte_alphabet()
        self.utf8 = codecs.getincrementaldecoder("utf-8")("replace")
        self.due = False

    def feed(self, token: int) -> str:
        """The text that the token finishes."""
        string = self.strings[token]
        if self.blanks:
            if self.due:
                return self.spaced[token]
            self.due = True
            return string
        try:
            return self.utf8.decode(bytes([self.bytes[c] for c in string]))
        except KeyError:  # an added token
            return self.utf8.decode(b"", True) + string

    def close(self) -> str:
        """What an unfinished character becomes."""
        self.due = False
        return "" if self.blanks else self.utf8.decode(b"", True)

    def stream(self, tokens: Sequence[int]) -> Iterator[str]:
        """The text of all tokens, in parts of at most PIECES tokens."""
        first = 0
        if self.blanks and len(tokens) and not self.due:
            yield self.feed(tokens[0])
            first = 1
        # Where a blank is due, and stays so, a token's text is a look in the table.
        step = self.spaced.__getitem__ if self.due else self.feed
        for k in range(first, len(tokens), PIECES):
            yield "".join(map(step, tokens[k : k + PIECES]))
        yield self.close()


class Table(dict):
    """Keys to values that are made when first asked for.

    A full table is put aside and begun anew; what is asked for again comes back from
    the one put aside, so frequent keys stay.
    """

    def __init__(self, make: Callable, most: int) -> None:
        super().__init__()
        self.make, self.most = make, most // 2
        self.aside: dict = {}

    def __missing__(self, key):
        value = self.aside.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= LONG_WORD:
            if len(self) >= self.most:
                self.aside = dict(self)
                self.clear()
            self[key] = value
        return value


class Codec:
    """Encodes and decodes whole texts as the tokenizer file says.

    Texts are cut at ASCII white space first, where the file's pre-tokenizer drops
    all white space: no rule of its normalizer reaches over it. Chunks are normalized and cut into
    words by the tokenizers library, by whatever the file says, but for chunks of ASCII letters
    alone, which are a word each; merging is the transducer's.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.merges = Merges(spec)
        self.encoder = Encoder(self.merges)
        library = Tokenizer.from_file(path)
        self.normalizer, self.pre_tokenizer = library.normalizer, library.pre_tokenizer
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut = re.compile("(" + "|".join(map(re.escape, self.added)) + ")") if self.added else None
        steps = (spec["pre_tokenizer"] or {}).get("pretokenizers", [])
        self.local = any(s.get("behavior") == "Removed" and s.get("invert") for s in steps) and not any(re.search(r"\s", t) for t in self.added)
        self.plain = self.local and not any(t.isalpha() for t in self.added) and [w for w, _ in self.pre_tokenizer.pre_tokenize_str(self.normalizer.normalize_str("Ab"))] == ["ab"]
        self.blanks = spec["decoder"] is None
        self.spaced = {i: " " + t for i, t in self.merges.strings.items()}
        self.words, self.chunks = Table(self.word, WORDS), Table(self.chunk, CHUNKS)

    def word(self, word: str) -> bytes:
        """Ids of one pre-token, given in the byte alphabet."""
        symbols = word[:-1] + chr(_ENDING + ord(word[-1])) if self.merges.marks_ends else word
        ids = self.encoder.tokens(symbols) if len(symbols) <= LONG_WORD else self.encoder.stream(symbols)
        return array("I", ids).tobytes()

    def chunk(self, chunk: bytes) -> bytes:
        """Ids of a piece of text that may hold added tokens."""
        if self.plain and chunk.isalpha():  # bytes.isalpha(): ASCII letters only, one word under any Unicode version
            return self.words[chunk.lower().decode("ascii")]
        text, ids = chunk.decode("utf-8"), []
        for k, part in enumerate(self.cut.split(text) if self.cut else [text]):
            if k % 2:
                ids.append(array("I", [self.added[part]]).tobytes())
            elif part:
                normal = self.normalizer.normalize_str(part) if self.normalizer else part
                ids += [self.words[word] for word, _ in self.pre_tokenizer.pre_tokenize_str(normal)]
        return b"".join(ids)

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        raw = text.encode("utf-8")  # bytes.split() cuts at exactly space and \t to \r
        return b"".join(map(self.chunks.__getitem__, raw.split())) if self.local else self.chunk(raw)

    def decoder(self) -> Decoder:
        return Decoder(self.merges.strings, self.spaced, self.blanks)

    def decode(self, ids: Sequence[int]) -> str:
        return "".join(self.decoder().stream(ids))


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


def encode(df: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, ids) of each row of ``df`` (doc_id, text); ids is an array of int. A null text has no ids."""
    schema = "doc_id long, ids array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(tokenizer)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            yield arrow_rows([(d, np.frombuffer(coder.encode(t), "<i4")) for d, t in zip(batch.column("doc_id").to_pylist(), texts)], schema)

    return df.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(run, schema)


def decode(df: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, decoded) of each row of ``df`` (doc_id, ids); null ids decode to an empty text."""
    schema = "doc_id long, decoded string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(tokenizer)
        for batch in batches:
            ids = batch.column("ids").to_pylist()
            yield arrow_rows([(d, coder.decode(x or [])) for d, x in zip(batch.column("doc_id").to_pylist(), ids)], schema)

    return df.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(run, schema)


def digests(df: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): both directions of each row, without moving the ids.

    Rows are answered one for one; a null text counts as empty; an empty table
    gives no rows; other columns are ignored.
    """
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(tokenizer)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                ids = coder.encode(text)
                decoded = hashlib.sha256()
                for part in coder.decoder().stream(array("I", ids)):
                    decoded.update(part.encode("utf-8"))
                rows.append((doc_id, len(ids) // 4, hashlib.sha256(ids).hexdigest(), decoded.hexdigest()))
            yield arrow_rows(rows, schema)

    return df.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(run, schema)


def op3_bpe(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return digests(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))
