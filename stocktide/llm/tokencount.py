"""Token counts of every prefix, by dynamic programming over the vocabulary of a byte-pair tokenizer.

The tokens of a text end, at each of its prefixes, in one token that fits the
tokens before it: two neighbours fit if encoding their bytes alone gives the same
two tokens, and a row of tokens is the encoding of its bytes if all neighbours
fit. So with the last token of every shorter prefix at hand, the last token of
the next one is found among the vocabulary's entries that end there, and

    count(prefix) = count(prefix without its last token) + 1

1. A text is cut into parts that never share a token (words, numbers, signs,
   spaces). A part's counts at its character ends are computed once per distinct
   part while it is cached, as steps from one character to the next. What stands
   between two spaces is cut once while it is cached, and a worker keeps both
   caches from task to task.
2. The steps of a text are its parts' steps in a row. Two kinds of prefixes end
   inside a part that would be cut otherwise if the text ended there, spaces
   before a word and the special string, and their steps are put right.
3. The steps are stored, compressed, with the text's key. ``count_before`` and
   ``fits`` answer from them how many tokens the first n characters have, and how
   many characters a budget of tokens holds. Nothing is encoded again.

Counts are those of the tokenizer's library, special strings in the text
included. A longer prefix can have fewer tokens than a shorter one.

Defined cases: a null or empty text has no token, and no steps; texts of any
length are counted whole; repeated rows give repeated rows; a null key stays
null; an empty table gives an empty table; further columns are not read, unless
``keep`` names them.
"""

from __future__ import annotations

import json
import os
import sys
import types
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .quality import _typed

#: Parts and words are kept in two generations of this many; pairs of tokens are dropped beyond that many.
CACHED_PARTS, CACHED_WORDS = 200_000, 400_000
CACHED_PAIRS = 2_000_000
#: Longer words are put together from their parts each time.
WORD_CHARS = 40
#: Rows that are handed on at once.
ROWS = 500

# Fixed value: the pattern of the byte-level tokenizer's parts.
PARTS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
# Parts that would be two if they ended before their last letter.
CONTRACTIONS = ("'re", "'ve", "'ll")
SPACES = regex.compile(r"\s{2,}(?=\S)")


class _NoWord(Exception):
    """A text cannot be cut at each of its spaces."""


class _Words(dict):
    """Steps of what stands between two spaces, the first of them included.

    A part never goes on over a space, and takes one in at its start if a sign
    follows. So parts can be cut at a space before a sign that is none; before
    another space, at the end, and beside signs that the library classes
    otherwise, the text is cut as a whole. Two generations, as for parts.
    """

    def __init__(self, counter: PrefixCounter):
        self.counter, self.older = counter, {}

    def __missing__(self, word: str) -> bytes:
        found = self.older.get(word)
        if found is None:
            if not word or word[0].isspace():
                raise _NoWord
            parts = [f" {word}"] if word.isascii() and word.isalpha() else self.counter.parts(f" {word}")
            if not self.counter.unlike.isdisjoint(word):
                raise _NoWord
            found = self.counter.joined(parts)
        if len(word) <= WORD_CHARS:
            if len(self) >= CACHED_WORDS:
                self.older = dict(self)
                self.clear()
            self[word] = found
        return found


def counter_of(path: str) -> PrefixCounter:
    """The counter of a tokenizer file, with what it has seen: one for all tasks of a Python worker."""
    # Functions reach a worker by value, and their own globals do not outlive a task.
    shared = sys.modules.setdefault("stocktide_counters", types.ModuleType("stocktide_counters"))
    known = vars(shared).setdefault("by_file", {})
    key = (path, os.stat(path).st_mtime_ns, os.stat(path).st_size)
    if key not in known:
        known.clear()  # one tokenizer at a time
        known[key] = PrefixCounter(path)
    return known[key]


class PrefixCounter:
    """Steps of token counts from character to character, for one tokenizer file."""

    def __init__(self, path: str):
        from tokenizers.pre_tokenizers import ByteLevel

        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        if model["model"]["type"] != "BPE" or model["pre_tokenizer"]["type"] != "ByteLevel" or model["normalizer"]:
            raise ValueError("a byte-level BPE tokenizer file without normalizer is needed")
        as_byte = byte_of_sign()
        as_bytes = lambda entry: bytes(map(as_byte.__getitem__, entry))
        self.special = [x["content"] for x in model["added_tokens"]]
        if any(x["single_word"] or x["lstrip"] or x["rstrip"] for x in model["added_tokens"]):
            raise ValueError("special strings that depend on their neighbours are not supported")
        vocabulary = {as_bytes(x) for x in model["model"]["vocab"] if x not in self.special}
        # Every beginning of an entry has the number of that entry, 0 if it is none itself, and what can follow by byte.
        self.entry = [b"", *sorted(vocabulary)]
        self.longest = max(map(len, self.entry))
        self.next: dict[int, tuple[int, dict]] = {}
        for number, entry in enumerate(self.entry[1:], 1):
            following = self.next
            for byte in entry[:-1]:
                following = following.setdefault(byte, (0, {}))[1]
            following[entry[-1]] = (number, {})  # beginnings come first in order
        pairs = (x.split(" ") if isinstance(x, str) else x for x in model["model"]["merges"])
        self.ranks = {(as_bytes(a), as_bytes(b)): rank for rank, (a, b) in enumerate(pairs)}
        self.library = ByteLevel(add_prefix_space=False)
        self.cut = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.words = _Words(self)
        self.pairs: dict[int, bool] = {}
        self.alike: set[str] = set(map(chr, range(128)))
        self.unlike: set[str] = set()

    def merge(self, data: bytes) -> list[bytes]:
        """The tokens of a few bytes, by merging the neighbours of the lowest rank."""
        out = [data[i : i + 1] for i in range(len(data))]
        while len(out) > 1:
            ranks = [self.ranks.get(pair, len(self.ranks)) for pair in zip(out, out[1:])]
            at = min(range(len(ranks)), key=ranks.__getitem__)
            if ranks[at] == len(self.ranks):
                break
            out[at : at + 2] = [out[at] + out[at + 1]]
        return out

    def fit(self, a: int, b: int) -> bool:
        """Whether entry b can follow entry a."""
        if len(self.pairs) >= CACHED_PAIRS:
            self.pairs.clear()
        first, second = self.entry[a], self.entry[b]
        found = self.pairs[a << 32 | b] = self.merge(first + second) == [first, second]
        return found

    def counts(self, data: bytes) -> list[int]:
        """Token counts of all prefixes of a part's bytes, from the empty one on."""
        first, pairs = self.next, self.pairs.get
        n = len(data)
        last, count = [0] * (n + 1), [0] * (n + 1)
        for i in range(n):
            before, following, counted, j = last[i] << 32, first, count[i] + 1, i
            for byte in data[i : i + self.longest]:
                found = following.get(byte)
                if found is None:
                    break
                number, following = found
                j += 1
                if number and not last[j]:
                    good = i == 0 or pairs(before | number)
                    if good is None:
                        good = self.fit(last[i], number)
                    if good:
                        last[j], count[j] = number, counted
                if not following:
                    break
        return count

    def steps(self, part: str) -> bytes:
        """The steps at the characters of a part, as 16-bit numbers."""
        found = self.known.get(part) or self.older.get(part)
        if found is None:
            data = part.encode()
            count = self.counts(data)
            if part in CONTRACTIONS:
                count[2] = 2
            if len(data) > len(part):
                count = [0, *(c for c, following in zip(count[1:], data[1:] + b" ") if following & 0xC0 != 0x80)]
            found = array("h", [b - a for a, b in zip(count, count[1:])]).tobytes()
        if len(self.known) >= CACHED_PARTS:
            self.known, self.older = {}, self.known
        self.known[part] = found
        return found

    def parts(self, text: str) -> list[str]:
        """The parts of a text; signs that the library classes otherwise are left to it."""
        if new := set(text).difference(self.alike, self.unlike):
            for sign in new:
                probe = f"a{sign}a {sign}1{sign}!{sign}{sign}b"
                same = [part for part, _ in self.cuts_of_library(probe)] == PARTS.findall(probe)
                (self.alike if same else self.unlike).add(sign)
        if self.unlike and not self.unlike.isdisjoint(text):
            return [part for part, _ in self.cuts_of_library(text)]
        return PARTS.findall(text)

    def cuts_of_library(self, text: str) -> list[tuple[str, int]]:
        return [(text[a:b], a) for _, (a, b) in self.library.pre_tokenize_str(text)]

    def plain(self, text: str) -> np.ndarray:
        """Steps of a text without special strings."""
        first, *others = text.split(" ")
        try:
            steps = [self.joined(self.parts(first)), *map(self.words.__getitem__, others)]
        except _NoWord:
            steps = [self.joined(self.parts(text))]
        out = np.frombuffer(b"".join(steps), "<i2")
        if "  " in text or "\n" in text or "\t" in text or not text.isascii():
            for run in SPACES.finditer(text):
                # Spaces at the end of a text are one part; before a word the last one is cut off.
                spaces, at = run.group(), run.end() - 1
                over = self.total(spaces) - self.total(spaces[:-1]) - self.total(spaces[-1])
                if over:
                    out = out if out.flags.writeable else out.copy()
                    out[at] += over
                    out[at + 1] -= over
        return out

    def joined(self, parts: list[str]) -> bytes:
        known = self.known
        return b"".join([known[p] if p in known else self.steps(p) for p in parts])

    def total(self, part: str) -> int:
        return int(np.frombuffer(self.steps(part), "<i2").sum())

    def of(self, text: str) -> np.ndarray:
        """Steps of a text: the count of its first n characters is the sum of the first n steps."""
        if self.cut is None or not any(s in text for s in self.special):
            return self.plain(text)
        out, start = [], 0
        for match in self.cut.finditer(text):
            # Up to the last sign of the special string the text is like any other.
            head = self.plain(text[start : match.end() - 1])
            own = int(self.plain(text[start : match.start()]).sum()) if match.start() > start else 0
            out += [head, np.array([own + 1 - int(head.sum())], "<i2")]
            start = match.end()
        return np.concatenate([*out, self.plain(text[start:])])


def byte_of_sign() -> dict[str, int]:
    """How the vocabulary writes bytes: printable Latin-1 signs as they are, the others from U+0100 on in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(other)}


def pack_steps(steps: np.ndarray) -> bytes | None:
    return zstandard.compress(steps.tobytes(), 1) if len(steps) else None


def prefix_counts(stored: bytes | None) -> np.ndarray:
    """Token counts of the prefixes of 0, 1, 2, .. characters."""
    steps = np.frombuffer(zstandard.decompress(stored), "<i2") if stored else np.empty(0, "<i2")
    return np.concatenate(([0], np.cumsum(steps, dtype=np.int64)))


def count_tokens(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """``key``, ``keep``, ``n_chars``, ``n_bytes``, ``n_tokens`` and ``prefix_steps`` (what ``count_before`` and ``fits`` read).

    ``tokenizer`` is the path of a tokenizer file that every executor can read.
    """
    source = docs.select(key, *keep, F.col(text).alias("__text"))
    names = [key, *keep]
    own = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.drop("__text").schema)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = counter_of(tokenizer)
        for batch in batches:
            for i in range(0, len(batch), ROWS):
                some = batch.slice(i, ROWS)
                texts = [t or "" for t in some.column(len(names)).to_pylist()]
                steps = [counter.of(t) for t in texts]
                numbers = ([len(t) for t in texts], [len(t.encode()) for t in texts], [int(s.sum()) for s in steps])
                yield pa.RecordBatch.from_arrays(
                    [*some.columns[: len(names)], *(pa.array(x, pa.int64()) for x in numbers), pa.array(map(pack_steps, steps), pa.binary())],
                    names=[*names, "n_chars", "n_bytes", "n_tokens", "prefix_steps"],
                )

    return source.mapInArrow(work, f"{own}, n_chars long, n_bytes long, n_tokens long, prefix_steps binary")


def count_before(chars: Column | str, steps: Column | str = "prefix_steps") -> Column:
    """Tokens of the first ``chars`` characters, from the stored steps; beyond the text, those of the whole text."""

    def work(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for stored, ends in batches:
            found = []
            for data, n in zip(stored.to_pylist(), ends.to_pylist()):
                counts = prefix_counts(data)
                found.append(None if n is None else int(counts[min(max(n, 0), len(counts) - 1)]))
            yield pa.array(found, pa.int64())

    return F.arrow_udf(_typed_pairs(work), "long")(steps, _column(chars).cast("long"))


def fits(budget: Column | int, steps: Column | str = "prefix_steps") -> Column:
    """Characters of the longest prefix of at most ``budget`` tokens, from the stored steps; a budget below 0 holds as 0."""

    def work(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for stored, budgets in batches:
            found = []
            for data, most in zip(stored.to_pylist(), budgets.to_pylist()):
                within = None if most is None else np.flatnonzero(prefix_counts(data) <= max(most, 0))
                found.append(None if within is None else int(within[-1]))
            yield pa.array(found, pa.int64())

    return F.arrow_udf(_typed_pairs(work), "long")(steps, _column(budget).cast("long"))


def truncated(docs: DataFrame, tokenizer: str, budget: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``n_tokens`` and ``text`` cut to its longest prefix of at most ``budget`` tokens."""
    names = {"__whole": F.col(text)}
    counted = count_tokens(docs.select(key, text).withColumns(names), tokenizer, key, text, keep=("__whole",))
    most = fits(budget)
    return counted.withColumn("__n", most).select(key, "n_tokens", F.expr("substring(`__whole`, 1, cast(`__n` as int))").alias("text"))


def _column(value: Column | str | int) -> Column:
    return value if isinstance(value, Column) else F.col(value) if isinstance(value, str) else F.lit(value)


def _typed_pairs(work):
    """As ``_typed``, for functions of two columns."""
    _typed(work).__annotations__["batches"] = Iterator[tuple[pa.Array, pa.Array]]
    return work
