"""Token counts by finite-state transducers compiled from a word-level BPE
tokenizer file, with the state maps of text chunks composed by a prefix scan.

Two deterministic transducers in sequence:

* the splitter cuts a text into pieces (its separators reset all state);
* the word transducer reads a piece letter by letter. Its state is what is left
  to decide about the merges so far (see :class:`WordTransducer`), and every
  transition is annotated with the number of tokens it emits, which may be
  negative when a merge takes an earlier token back.

The merges of a prefix never depend on what follows, so counting needs one left
to right pass and no merge queue. States and transitions are compiled when first
met and kept by the worker.

A chunk of bytes, cut anywhere, maps any entry state to an exit state and a
count. Its first separator resets the state, so the map is: run the entry state
over the part before it, add a constant, and leave with the state reached by the
part after the last separator. Such maps compose associatively
(:func:`compose`), so chunks are counted on their own and joined by a scan.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .words import utf8

#: White space on which the splitter always resets, whatever stands around it.
_SEPARATOR = re.compile(rb"[\x20\x09-\x0D]+")
#: Sizes at which a worker's caches are emptied; caches only.
CACHE_WORDS, CACHE_STATES = 500_000, 300_000
CHUNK_BYTES = 1 << 18
#: Last character that the patterns and case rules here and there agree on.
LATIN = "\u024f"
#: Distance between a letter and the same letter at the end of a word.
_END = 0x100000


def byte_letters() -> list[str]:
    """The letter that byte-level vocabularies use for every byte: printable
    Latin-1 bytes stand for themselves, the rest are numbered from U+0100."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class WordTransducer:
    """Counts the BPE tokens of a word, a letter at a time.

    The encoding of a prefix ends in exactly one token: the suffix token that
    stays apart from the last token of what stands before it when the two are
    merged on their own. So a state holds, for every position back to where a
    vocabulary entry can still begin, the last token there and the tokens
    emitted since. Letters at a word's end are letters of their own."""

    def __init__(self, merges: list[list[str]], suffix: str):
        def marked(token: str) -> str:
            if suffix and token.endswith(suffix) and token != suffix:
                token = token[:-len(suffix)]
                return token[:-1] + chr(ord(token[-1]) + _END)
            return token

        self.ranks = {(marked(a), marked(b)): r for r, (a, b) in enumerate(merges)}
        self.made = {a + b: (r, a, b) for (a, b), r in self.ranks.items()}
        self.tokens = self.made.keys()
        self.prefixes = {t[:k] for t in self.tokens for k in range(1, len(t) + 1)}
        self.apart: dict[tuple[str, str], bool] = {}
        self.whole: dict[str, bool] = {}
        self._restart()

    def _restart(self) -> None:
        self.states = [("", ("",), (0,))]
        self.ids = {self.states[0]: 0}
        self.steps: list[dict[str, tuple[int, int]]] = [{}]

    def merged(self, letters: str) -> list[str]:
        """Plain merging: lowest rank first, leftmost first. For tests."""
        parts = list(letters)
        while len(parts) > 1:
            rank, at = min((self.ranks.get(pair, len(self.ranks)), k) for k, pair in enumerate(zip(parts, parts[1:])))
            if rank == len(self.ranks):
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def stay_apart(self, a: str, b: str, limit: int) -> bool:
        """Whether no merge of a rank below ``limit`` crosses the border of a and
        b while their letters are merged. Their merges are undone, latest first:
        just before each of them the two tokens at the border could have merged,
        which needs a lower rank than the merge that did happen (or the same, if
        the border is to its left, as then leftmost decides)."""
        while True:
            if self.ranks.get((a, b), limit) < limit:
                return False
            rank_a, rank_b = (self.made[t][0] if t in self.made else -1 for t in (a, b))
            if rank_a > rank_b:
                limit, _, a = self.made[a]
            elif rank_b >= 0:
                limit, b = rank_b + 1, self.made[b][1]
            else:
                return True

    def _fits(self, before: str, token: str) -> bool:
        """Whether ``token`` is what its own letters merge to, and stays apart
        from the token before it."""
        whole = self.whole.get(token)
        if whole is None:
            whole = True
            if token in self.made:
                rank, a, b = self.made[token]
                whole = self._fits("", a) and self._fits("", b) and self.stay_apart(a, b, rank)
            self.whole[token] = whole
        if not whole or not before:
            return whole
        found = self.apart.get((before, token))
        if found is None:
            if len(self.apart) >= CACHE_STATES:
                self.apart.clear()
            found = self.apart[before, token] = self.stay_apart(before, token, len(self.ranks))
        return found

    def step(self, state: int, letter: str) -> tuple[int, int]:
        """Next state and tokens emitted, for a transition that is new."""
        tail, last, since = self.states[state]
        text = tail + letter
        keep = len(text)  # what can still become a longer token begins here
        for k in range(len(text)):  # longest suffix first; a single letter is always a token
            token = text[k:]
            if keep > k and token in self.prefixes:
                keep = k
            if (k == len(tail) or token in self.made) and self._fits(last[k], token):
                break
        while keep > k and k + 1 < len(text):
            k += 1
            if text[k:] in self.prefixes:
                keep = k
        emitted = 1 - since[len(text) - len(token)]
        new = (text[keep:], (*last[keep:], token), (*[s + emitted for s in since[keep:]], 0))
        number = self.ids.get(new)
        if number is None:
            number = self.ids[new] = len(self.states)
            self.states.append(new)
            self.steps.append({})
        found = self.steps[state][letter] = (number, emitted)
        return found

    def count(self, letters: str) -> int:
        """Tokens of a whole word; its last letter is read as a word end."""
        if len(self.states) >= CACHE_STATES:
            self._restart()
        state, total, steps = 0, 0, self.steps
        for letter in letters[:-1]:
            state, emitted = steps[state].get(letter) or self.step(state, letter)
            total += emitted
        last = chr(ord(letters[-1]) + _END)
        return total + (steps[state].get(last) or self.step(state, last))[1]


class Splitter:
    """Cuts the bytes between two separators into pieces, as the tokenizer file
    says (NFC and lower case, a pattern, byte-level letters). Characters beyond
    Latin are left to the library's own normalizer and splitter, whose Unicode
    tables may be older or newer than Python's."""

    def __init__(self, spec: str):
        data = json.loads(spec)
        cut = data["pre_tokenizer"]["pretokenizers"][0]
        kinds = [n["type"] for n in data["normalizer"]["normalizers"]]
        if data["model"]["type"] != "BPE" or cut["type"] != "Split" or kinds != ["NFC", "Replace", "Lowercase"]:
            raise ValueError("not a lower-casing word BPE tokenizer")
        self.pattern = regex.compile(cut["pattern"]["Regex"])
        self.special_ids = {t["content"]: t["id"] for t in data["added_tokens"]}
        special = sorted(self.special_ids, key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, special)) + ")") if special else None
        self.letters = byte_letters()
        self.library = Tokenizer.from_str(spec)

    def pieces(self, raw: bytes) -> list[str]:
        """Pieces as letters; a special string is a piece of its own, after a NUL
        (which is no letter)."""
        if raw.isalpha():  # ASCII letters only
            return [raw.lower().decode()]
        if raw[-1:] in (b".", b",") and raw[:-1].isalpha():
            return [raw[:-1].lower().decode(), raw[-1:].decode()]
        text = raw.decode("utf-8", "replace")
        if self.special is None or "<" not in text:
            return self._cut(text)
        out = []
        for k, part in enumerate(self.special.split(text)):
            out += ["\0" + part] if k % 2 else self._cut(part)
        return out

    def _cut(self, text: str) -> list[str]:
        if text.isascii():
            found = self.pattern.findall(text.lower())
            if text.isprintable():
                return found
        elif max(text) <= LATIN:
            found = self.pattern.findall(unicodedata.normalize("NFC", text).lower())
        else:
            return [p for p, _ in self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))]
        return ["".join([self.letters[b] for b in piece.encode()]) for piece in found]


class Counter(dict):
    """Bytes between two separators -> tokens, filled as they are met. Compiled
    from the text of a tokenizer file (BPE with a word-end suffix)."""

    def __init__(self, spec: str):
        super().__init__()
        model = json.loads(spec)["model"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.splitter = Splitter(spec)
        self.words = WordTransducer(merges, model["end_of_word_suffix"])
        self.known: dict[str, int] = {}

    def __missing__(self, raw: bytes) -> int:
        total = 0
        for piece in self.splitter.pieces(raw):
            tokens = self.known.get(piece)
            if tokens is None:
                tokens = self.known[piece] = 1 if piece[0] == "\0" else self.words.count(piece)
            total += tokens
        if len(self) >= CACHE_WORDS:
            self.clear()
            self.known.clear()
        self[raw] = total
        return total


class Map(NamedTuple):
    """The state map of a chunk: an open word is carried as its bytes, which
    name the transducer's state. ``tail`` is None if there is no separator."""

    head: bytes
    count: int = 0
    tail: bytes | None = None


def chunk_map(counter: Counter, chunk: bytes) -> Map:
    first = _SEPARATOR.search(chunk)
    if first is None:
        return Map(chunk)
    rest = chunk[first.end():]
    words = rest.split()
    tail = words.pop() if words and not _SEPARATOR.match(rest[-1:]) else b""
    return Map(chunk[:first.start()], sum(map(counter.__getitem__, words)), tail)


def compose(counter: Counter, a: Map, b: Map) -> Map:
    if a.tail is None:
        return Map(a.head + b.head, b.count, b.tail)
    if b.tail is None:
        return Map(a.head, a.count, a.tail + b.head)
    return Map(a.head, a.count + counter[a.tail + b.head] + b.count, b.tail)


def scan(counter: Counter, maps: list[Map]) -> list[Map]:
    """All prefixes' maps: pairs are composed, their scan gives every second
    prefix, one more composition the others. Depth is the logarithm of the
    number of chunks, work proportional to it."""
    if len(maps) < 2:
        return maps
    pairs = scan(counter, [compose(counter, *maps[k:k + 2]) for k in range(0, len(maps) - 1, 2)])
    out = [maps[0]]
    for k in range(1, len(maps)):
        out.append(pairs[k // 2] if k % 2 else compose(counter, pairs[k // 2 - 1], maps[k]))
    return out


def count(counter: Counter, text: bytes | None, chunk_bytes: int = CHUNK_BYTES) -> int:
    """Tokens of a whole text."""
    if not text:
        return 0
    maps = [chunk_map(counter, text[k:k + chunk_bytes]) for k in range(0, len(text), chunk_bytes)]
    whole = scan(counter, maps)[-1]
    return counter[whole.head] + whole.count + (counter[whole.tail] if whole.tail else 0)


def token_counts(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 2048) -> DataFrame:
    """One row per row of ``docs``: (id, n_bytes, n_tokens, over_limit).

    Counts are those of the tokenizer file's library for the whole text, without
    added special tokens; special strings inside a text are one token each. The
    file is read by the driver and sent to the executors (its size is fixed).

    Defined cases: a null text counts as empty (0 bytes, 0 tokens); ids may be
    null or repeated, every row gives its own row; other columns are not looked
    at; an empty table gives an empty result."""
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(spec.value)
        for batch in batches:
            found = [(len(t or b""), count(counter, t)) for t in utf8(batch.column("t"))]
            sizes, tokens = zip(*found) if found else ((), ())
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(sizes, pa.int64()), pa.array(tokens, pa.int64())],
                                             names=["id", "n_bytes", "n_tokens"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t"))
    kind = rows.schema["id"].dataType.simpleString()
    out = rows.mapInArrow(run, f"id {kind}, n_bytes long, n_tokens long")
    return out.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
