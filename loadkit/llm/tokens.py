"""Token counts from a compiled finite-state tokenizer (operator 6).

The vocabulary file's merges are compiled, as text asks for them, into a
deterministic transducer over byte symbols: a state holds what the coming symbols
can still depend on (the longest suffix that begins a token, with the last token
of the encoding at each of its positions), and each transition carries the number
of tokens that it adds to the encoding. A longer token may replace shorter ones,
so a transition can take tokens back; the sum over a pre-token is its exact count.

A transition's token is the one that ends here and that no merge would have joined
with, or cut from, the token before it; `fits` undoes both tokens along their
merges, latest first, to decide that. States and transitions are interned, so a
pre-token costs one lookup per symbol once its states exist.

White space brings the machine back to its start. So the state map of a chunk of
text is constant after its first white space and is kept as (text up to it, count
between, text after the last); maps compose associatively, and a text is the scan
over its chunks' maps, in any grouping.

Defined results: NULL is an empty text; special strings inside a text count as the
library's default takes them (one token each).
"""

from __future__ import annotations

import json
import re

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from tokenizers import Tokenizer

from loadkit.llm.common import map_slices, table, text_rows

TOKENIZER = "word_bpe_49k.json"
MAX_TOKENS = 2048
CHUNK_CHARS = 1 << 16
CACHE_WORDS = 150_000     # distinct words whose result a worker keeps; then it starts anew
CACHE_STATES = 120_000
LONGEST_CACHED = 64
COMPILED: dict[str, WordCounts] = {}   # per worker process, by file
#: what the files' normalizer takes as white space; str.split() also cuts at these four
SPACES = re.compile("[\t-\r \x85\xa0  -     　]+")
NOT_SPACES = re.compile("[\x1c-\x1f]")
COMBINING = "\u0300"   # characters below are composed already and are lower-cased one by one
CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")


def words_of(text: str) -> list[str]:
    return text.split() if not NOT_SPACES.search(text) else [w for w in SPACES.split(text) if w]


def byte_symbols() -> dict[int, str]:
    """Byte value -> symbol of byte-level vocabularies: printable bytes stand for
    themselves, the others for the code points from 256 on, in order."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


class BpeTransducer:
    """Lazily determinised transducer of a BPE vocabulary with word-end symbols."""

    def __init__(self, spec: dict):
        model = spec["model"]
        self.end = model["end_of_word_suffix"] or ""
        pairs = [tuple(m) if not isinstance(m, str) else tuple(m.split(" ", 1)) for m in model["merges"]]
        made = {a + b for a, b in pairs}
        self.number = {t: i for i, t in enumerate(t for t in model["vocab"] if t not in made)}
        first = len(self.number)
        self.number |= {a + b: first + i for i, (a, b) in enumerate(pairs)}
        self.halves = [(i, i) for i in range(first)] + [(self.number[a], self.number[b]) for a, b in pairs]
        self.joined = {(self.number[a], self.number[b]): first + i for i, (a, b) in enumerate(pairs)}
        self.first = first
        self.symbols = byte_symbols()
        self.built: dict[int, bool] = {}   # token -> see whole()
        self.begins = {t[:k] for t in self.number for k in range(1, len(t) - (len(self.end) if t.endswith(self.end) else 0) + 1)}
        self.reset()

    def reset(self) -> None:
        self.ids = {("", (-1,), (0,)): 0}
        self.states = [("", (-1,), (0,))]
        self.moves: dict[int, tuple[int, int]] = {}   # (state << 8) + byte -> (next state << 8, tokens)
        self.ends: dict[int, int] = {}                # (state << 8) + last byte -> tokens

    def fits(self, left: int, right: int) -> bool:
        """Whether ``left`` and ``right`` stay two neighbouring tokens: take both apart,
        the later merge first; no pair met on the way may merge earlier than that."""
        bound = len(self.halves)
        while True:
            if self.joined.get((left, right), bound) < bound:
                return False
            if left > right:
                if left < self.first:
                    return True
                bound, left = left, self.halves[left][1]
            else:
                if right < self.first:
                    if left < self.first:
                        return True
                    bound, left = left, self.halves[left][1]
                else:
                    bound, right = right + 1, self.halves[right][0]

    def whole(self, token: int) -> bool:
        """Whether the vocabulary's merges ever build ``token``."""
        if token < self.first:
            return True
        if token not in self.built:
            self.built[token] = not self.fits(*self.halves[token]) and all(map(self.whole, self.halves[token]))
        return self.built[token]

    def _token(self, state: int, tail: str) -> tuple[int, int]:
        """(token that ends with the symbol, tokens up to it relative to the state)."""
        near, lasts, counts = self.states[state]
        for k in range(len(near) + 1):
            t = self.number.get(near[k:] + tail)
            if t is not None and self.whole(t) and (lasts[k] < 0 or self.fits(lasts[k], t)):
                return t, counts[k] + 1
        raise ValueError(f"no token ends with {tail!r}")

    def _move(self, at: int) -> tuple[int, int]:
        c = self.symbols[at & 255]
        near, lasts, counts = self.states[at >> 8]
        t, n = self._token(at >> 8, c)
        text, k = near + c, 0
        while text[k:] and text[k:] not in self.begins:
            k += 1
        key = (text[k:], lasts[k:] + (t,), tuple(x - n for x in counts[k:]) + (0,))
        to = self.ids.get(key)
        if to is None:
            to = self.ids[key] = len(self.states)
            self.states.append(key)
        step = self.moves[at] = to << 8, n
        return step

    def _end(self, at: int) -> int:
        n = self.ends[at] = self._token(at >> 8, self.symbols[at & 255] + self.end)[1]
        return n

    def count(self, piece: bytes) -> int:
        """Tokens of one pre-token, given as bytes."""
        if len(self.states) > CACHE_STATES:
            self.reset()
        state = total = 0
        moves = self.moves
        for b in piece[:-1]:
            at = state + b
            state, n = moves[at] if at in moves else self._move(at)
            total += n
        at = state + piece[-1]
        return total + (self.ends[at] if at in self.ends else self._end(at))



class Memo(dict):
    """Code point -> what ``ask`` says of the character, asked once; for translate()."""

    def __init__(self, ask):
        super().__init__()
        self.ask = ask

    def __missing__(self, c: int) -> str:
        self[c] = out = self.ask(chr(c))
        return out


class WordCounts(dict):
    """Tokens per white-space-delimited word: special strings, the normalizer, the
    pre-token automaton over character classes, then the transducer."""

    def __init__(self, path: str):
        super().__init__()
        spec = json.load(open(path, encoding="utf-8"))
        self.machine = BpeTransducer(spec)
        library = Tokenizer.from_file(path)
        self.normal, cutter = library.normalizer, library.pre_tokenizer
        special = [re.escape(t["content"]) for t in spec["added_tokens"]]
        self.special = re.compile("|".join(special)) if special else None
        pieces = lambda s: len(cutter.pre_tokenize_str(s))
        # class of a character in the file's pattern, as its pre-tokenizer shows it
        self.kinds = Memo(lambda c: "L" if pieces("a" + c) == 1 else "O" if pieces("!" + c) == 1 else "N")
        self.lower = Memo(self.normal.normalize_str)

    def pretokens(self, word: str) -> list[str]:
        kinds = word.translate(self.kinds)
        if not kinds.strip("L"):
            return [word]
        out, at, n = [], 0, len(word)
        while at < n:
            to = at + 1
            if word[at] == "'" and word.startswith(CONTRACTIONS, at):
                to = at + len(next(c for c in CONTRACTIONS if word.startswith(c, at)))
            elif (k := kinds[at]) != "N":
                while to < n and kinds[to] == k:
                    to += 1
            out.append(word[at:to])
            at = to
        return out

    def pieces(self, word: str) -> list[bytes]:
        """Normalised pre-tokens of a word without special strings."""
        if word.isascii():
            word = word.lower()
            if word.isalpha():
                return [word.encode()]
        elif max(word) < COMBINING:
            word = word.translate(self.lower)
        else:
            word = self.normal.normalize_str(word)
        return [piece.encode() for piece in self.pretokens(word)]

    def result(self, word: str) -> int:
        if self.special and self.special.search(word):
            return len(self.special.findall(word)) + sum(self.result(x) for x in self.special.split(word) if x)
        return sum(map(self.machine.count, self.pieces(word)))

    def __missing__(self, word: str):
        got = self.result(word)
        if len(word) <= LONGEST_CACHED:
            if len(self) >= CACHE_WORDS:
                self.clear()
            self[word] = got
        return got


#: A chunk's state map: (text before the first white space, tokens between, text after
#: the last); (text, None, None) if it has no white space.
ChunkMap = tuple[str, int | None, str | None]


def chunk_map(counts: WordCounts, text: str) -> ChunkMap:
    words = words_of(text)
    if not words:
        return ("", 0, "") if text else ("", None, None)
    if len(words) == 1 and len(words[0]) == len(text):
        return text, None, None
    head = words.pop(0) if text.startswith(words[0]) else ""
    tail = words.pop() if words and text.endswith(words[-1]) else ""
    return head, sum(map(counts.__getitem__, words)), tail


def compose(counts: WordCounts, a: ChunkMap, b: ChunkMap) -> ChunkMap:
    if a[1] is None:
        return a[0] + b[0], b[1], b[2]
    if b[1] is None:
        return a[0], a[1], a[2] + b[0]
    between = a[2] + b[0]
    return a[0], a[1] + (counts[between] if between else 0) + b[1], b[2]


def count_text(counts: WordCounts, text: str, chunk_chars: int = CHUNK_CHARS) -> int:
    """Tokens of a text: maps of its chunks, composed pairwise up a tree."""
    if len(text) <= chunk_chars:
        return sum(map(counts.__getitem__, words_of(text)))
    maps = [chunk_map(counts, text[at:at + chunk_chars]) for at in range(0, len(text), chunk_chars)]
    while len(maps) > 1:
        maps = [compose(counts, *maps[i:i + 2]) if i + 1 < len(maps) else maps[i] for i in range(0, len(maps), 2)]
    head, n, tail = maps[0]
    return sum(counts[x] for x in (head, tail) if x) + (n or 0)


def token_counts(docs: DataFrame, tokenizer: str = TOKENIZER, max_tokens: int = MAX_TOKENS) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every row. ``tokenizer``: a
    byte-level BPE file with word ends, by its name or path."""
    def make():
        path = tokenizer if "/" in tokenizer else public_tokenizers.path(tokenizer)
        counts = COMPILED.get(path) or COMPILED.setdefault(path, WordCounts(path))

        def one(batch):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            n = [count_text(counts, t) for t in texts]
            return pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(t.encode()) for t in texts], pa.int64()),
                 pa.array(n, pa.int64()), pa.array([x > max_tokens for x in n])],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"])
        return one
    return map_slices(text_rows(docs), make, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))
