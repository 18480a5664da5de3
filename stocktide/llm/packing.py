"""Sequence packing as a cutting-stock problem, solved by column generation.

1. Texts become token ids, with an end id. A document of L ids is cut into full
   sequences, a body of a multiple of ``GRAIN`` ids, and a tail below it, so
   that the length histogram has at most capacity/grain + grain entries whatever
   the corpus.
2. The driver solves the linear program "fewest sequences" over this histogram.
   Columns are patterns (how many pieces of each length share a sequence); the
   next one comes from a knapsack over the dual prices, by dynamic programming.
   Pattern counts are rounded down, and only patterns that fill a sequence stay.
3. Pieces of one length are ranked: a task counts its own, and the counts of the
   tasks before it are added. A rank says which copy of which pattern a piece
   falls into, and where; no piece needs to know another one.
4. What rounding leaves over, a bounded number of sequences, is laid end to end
   and cut at the capacity; its end is cut at powers of two, which need no padding.

Defined cases: a null or empty text has the end id alone; repeated rows are
packed as often as they occur; a null id stays null; an empty table gives an
empty table; further columns are not read.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stocktide.session import materialize

from .text import CACHED_WORDS, texts_of

CAPACITY = 4096
GRAIN = 64
END_ID = 2
#: New words that are encoded in one line, and bytes of text that are looked up at once.
LINE_WORDS = 200
GROUP_BYTES = 4 << 20
#: Signs at the end of a word, and words that the tokenizer's clean-up leaves as they are: small Latin letters.
SIGNS = bytes(b for b in range(33, 127) if not chr(b).isalnum())
PLAIN = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+")


class WordIds:
    """Ids of white-space separated words, as bytes; the tokenizer never joins text across white space.

    It lowers all letters, so A-Z are lowered before. Signs at the end of a word
    of letters are one part of their own, so the word and the signs are encoded
    apart. Words are kept in two generations. The older one is dropped when the recent
    one is full, so memory is bounded and common words stay.
    """

    def __init__(self, path: str, most: int = CACHED_WORDS):
        from tokenizers import Tokenizer, pre_tokenizers

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.plain = Tokenizer(self.tokenizer.model)
        self.plain.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        #: Which ids end a word.
        self.ends = np.array([(self.tokenizer.id_to_token(i) or "").endswith("</w>") for i in range(self.tokenizer.get_vocab_size())])
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.most, self.recent, self.older = most, {}, {}

    def _learn(self, words: set[bytes]) -> None:
        """Ids of new words, plain ones without the tokenizer's clean-up."""
        cut, other = {}, set()
        for word in words:
            stem = word.rstrip(SIGNS)
            if PLAIN.fullmatch(stem):
                cut[word] = stem
            else:
                other.add(word)
        stems = set(cut.values()).difference(self.recent)
        known = stems & self.older.keys()
        self.recent.update((w, self.older[w]) for w in known)
        tails = {word[len(stem) :] for word, stem in cut.items()}.difference(self.recent, (b"",))
        self._encode_plain(sorted(stems - known))
        self._encode(sorted(other | tails))
        self.recent.update((w, self.recent[s] + self.recent[w[len(s) :]]) for w, s in cut.items() if len(s) < len(w))

    def _encode_plain(self, words: list[bytes]) -> None:
        """Encode words of letters, many in one line; each has one id that ends it."""
        lines = [words[i : i + LINE_WORDS] for i in range(0, len(words), LINE_WORDS)]
        for line, own in zip(lines, self.plain.encode_batch([b" ".join(line).decode() for line in lines], add_special_tokens=False)):
            ids = np.array(own.ids, self.kind)
            cuts = ((np.flatnonzero(self.ends[ids]) + 1) * self.kind.itemsize).tolist()
            data = ids.tobytes()
            self.recent.update(zip(line, [data[a:b] for a, b in zip([0, *cuts], cuts)], strict=True))

    def _encode(self, words: list[bytes]) -> None:
        """Encode words, many in one line; a token belongs to the word in which it starts."""
        lines = [words[i : i + LINE_WORDS] for i in range(0, len(words), LINE_WORDS)]
        found = self.tokenizer.encode_batch([b" ".join(line).decode() for line in lines], add_special_tokens=False)
        for line, own in zip(lines, found):
            starts = np.cumsum([0, *(len(w.decode()) + 1 for w in line)])
            at = np.fromiter((begin for begin, _ in own.offsets), np.int64, len(own.ids))
            cuts = (np.searchsorted(at, starts) * self.kind.itemsize).tolist()
            data = np.array(own.ids, self.kind).tobytes()
            self.recent.update(zip(line, [data[a:b] for a, b in zip(cuts, cuts[1:])]))

    def _group(self, texts: list[bytes]) -> list[bytes]:
        """One look-up per word; only words that are not at hand are looked at again."""
        words = [text.lower().split() for text in texts]
        found = [list(map(self.recent.get, own)) for own in words]
        gaps = [(n, [i for i, x in enumerate(f) if x is None]) for n, f in enumerate(found) if None in f]
        missing = {words[n][i] for n, places in gaps for i in places}
        known = missing & self.older.keys()
        self.recent.update((w, self.older[w]) for w in known)
        if new := missing - known:
            self._learn(new)
        for n, places in gaps:
            own, f = words[n], found[n]
            for i in places:
                f[i] = self.recent[own[i]]
        out = [b"".join(f) for f in found]
        if len(self.recent) >= self.most:
            self.older, self.recent = self.recent, {}
        return out

    def of(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text, in groups of about ``GROUP_BYTES``."""
        out: list[bytes] = []
        held, size = [], 0
        for text in texts:
            if held and size + len(text) > GROUP_BYTES:
                out += self._group(held)
                held, size = [], 0
            held.append(text)
            size += len(text)
        return out + self._group(held) if held else out


def knapsack(sizes: np.ndarray, prices: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Best value and counts of an unbounded knapsack."""
    use = np.flatnonzero(prices > 1e-12)
    best = np.zeros(capacity + 1)
    steps = [best]
    for i in use:
        size = int(sizes[i])
        rows = -(-(capacity + 1) // size)
        table = np.full(rows * size, -np.inf)
        table[: capacity + 1] = best
        table = table.reshape(rows, size)
        gain = prices[i] * np.arange(rows)[:, None]
        best = (np.maximum.accumulate(table - gain, axis=0) + gain).ravel()[: capacity + 1]
        steps.append(best)
    counts = np.zeros(len(sizes), np.int64)
    room = capacity
    for at in range(len(use) - 1, -1, -1):
        i, size = use[at], int(sizes[use[at]])
        taken = np.arange(room // size + 1)
        k = int(np.argmax(steps[at][room - taken * size] + prices[i] * taken))
        counts[i], room = k, room - k * size
    return float(best[capacity]), counts


def column_generation(sizes: np.ndarray, demand: np.ndarray, capacity: int, most: int = 2000) -> list[tuple[float, np.ndarray]]:
    """Patterns and how often to use each (fractional), for the fewest sequences that cover the demand."""
    m = len(sizes)
    if not m:
        return []
    basis = np.diag(capacity // sizes).astype(float)
    cost = np.ones(m)
    amount = demand / np.diag(basis)
    for _ in range(most):
        prices = np.linalg.solve(basis.T, cost)
        if prices.min() < -1e-9:  # more than asked of one length is allowed
            column, price = np.zeros(m), 0.0
            column[prices.argmin()] = -1
        else:
            value, counts = knapsack(sizes, prices, capacity)
            if value <= 1 + 1e-9:
                break
            column, price = counts.astype(float), 1.0
        moved = np.linalg.solve(basis, column)
        ratio = np.where(moved > 1e-9, amount / np.where(moved > 1e-9, moved, 1), np.inf)
        out = int(ratio.argmin())
        if not np.isfinite(ratio[out]):
            break
        amount = np.maximum(amount - ratio[out] * moved, 0)
        amount[out] = ratio[out]
        basis[:, out], cost[out] = column, price
    return [(amount[j], basis[:, j].astype(np.int64)) for j in range(m) if cost[j] > 0]


@dataclass
class Plan:
    """Where the piece of a length and rank goes; its size follows the histogram, not the corpus."""

    capacity: int
    full: int
    #: Per length: first ranks of the pattern runs, first sequence, pieces per sequence, offset in the sequence.
    runs: dict[int, list[np.ndarray]] = field(default_factory=dict)
    covered: dict[int, int] = field(default_factory=dict)
    tape: dict[int, int] = field(default_factory=dict)
    tape_starts: np.ndarray = None
    tape_first: int = 0
    tape_full: int = 0

    def place(self, length: int, rank: int) -> Iterator[tuple[int, int, int]]:
        """Sequence, offset and length of the piece's parts; only pieces on the tape have several."""
        if length == self.capacity:
            yield rank, 0, length
        elif rank < self.covered[length]:
            first, sequence, per, offset = self.runs[length]
            run = int(np.searchsorted(first, rank, "right")) - 1
            copy, slot = divmod(rank - int(first[run]), int(per[run]))
            yield int(sequence[run]) + copy, int(offset[run]) + slot * length, length
        else:
            at, left = self.tape[length] + (rank - self.covered[length]) * length, length
            while left:
                number, offset = divmod(at, self.capacity)
                room = self.capacity - offset
                if number >= self.tape_full:  # the tape's end, cut at powers of two
                    over = at - self.tape_full * self.capacity
                    part = int(np.searchsorted(self.tape_starts, over, "right")) - 1
                    number, offset = self.tape_full + part, over - int(self.tape_starts[part])
                    room = int(self.tape_starts[part + 1]) - over
                take = min(left, room)
                yield self.tape_first + number, offset, take
                at, left = at + take, left - take


def make_plan(histogram: dict[int, int], capacity: int) -> Plan:
    plan = Plan(capacity, histogram.get(capacity, 0))
    sizes = np.array(sorted(s for s, n in histogram.items() if s < capacity and n), np.int64)
    left = np.array([histogram[s] for s in sizes.tolist()], np.int64)
    used: dict[int, list[tuple[int, int, int, int]]] = {int(s): [] for s in sizes}
    sequence, ranks = plan.full, np.zeros(len(sizes), np.int64)
    for amount, pattern in sorted(column_generation(sizes, left.astype(float), capacity), key=lambda x: (-x[0], x[1].tolist())):
        held = pattern > 0
        if not held.any() or int(pattern @ sizes) != capacity:
            continue
        copies = int(min(np.floor(amount + 1e-6), (left[held] // pattern[held]).min()))
        if copies <= 0:
            continue
        offset = 0
        for i in np.flatnonzero(held):
            used[int(sizes[i])].append((int(ranks[i]), sequence, int(pattern[i]), offset))
            offset += int(pattern[i] * sizes[i])
        ranks += copies * pattern
        left -= copies * pattern
        sequence += copies
    at = 0
    for i, size in enumerate(sizes.tolist()):
        plan.runs[size] = list(np.array(used[size], np.int64).reshape(-1, 4).T)
        plan.covered[size], plan.tape[size] = int(ranks[i]), at
        at += int(left[i]) * size
    plan.tape_first, plan.tape_full = sequence, at // capacity
    ends = [1 << b for b in range(capacity.bit_length(), -1, -1) if at % capacity >> b & 1]
    plan.tape_starts = np.concatenate(([0], np.cumsum(ends))).astype(np.int64)
    return plan


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, grain: int = GRAIN, end_id: int = END_ID, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: ``key``, ``start``, ``length``, ``ids`` (little-endian unsigned 32-bit numbers), ``doc_tokens``, ``sequence_id`` and ``offset``.

    ``tokenizer`` is the path of a tokenizer file that every executor can read.
    """
    kind = docs.schema[key].dataType.simpleString()
    pieces = "full long, full_rank long, body long, body_rank long, tail long, tail_rank long"

    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, part = WordIds(tokenizer), TaskContext.get().partitionId()
        end = np.array([end_id], ids.kind).tobytes()
        seen: dict[int, int] = {}

        def rank(length: int, n: int = 1) -> int:
            before = seen.get(length, 0)
            seen[length] = before + n
            return before

        for batch in batches:
            for i in range(0, len(batch), 500):
                some = batch.slice(i, 500)
                out = [found + end for found in ids.of(texts_of(some.column(1)))]
                rows = []
                for data in out:
                    full, rest = divmod(len(data) // ids.kind.itemsize, capacity)
                    body, tail = rest - rest % grain, rest % grain
                    rows.append((full, rank(capacity, full), body, rank(body) if body else 0, tail, rank(tail) if tail else 0))
                columns = [pa.array(x, pa.int64()) for x in zip(*rows)]
                wide = pa.array([ids.kind.itemsize] * len(some), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), pa.array(out, pa.binary()), wide, pa.array([part] * len(some), pa.int64()), *columns],
                    names=[key, "ids", "width", "part", *(p.split()[0] for p in pieces.split(", "))],
                )

    tokens = docs.select(key, text).mapInArrow(tokenize, f"`{key}` {kind}, ids binary, width int, part long, {pieces}")
    tokens = materialize(tokens, "tokens")
    entry = lambda size, n: F.struct(size.cast("long").alias("size"), n.cast("long").alias("n"))
    one = F.lit(1)
    entries = F.array(entry(F.lit(capacity), F.col("full")), entry(F.col("body"), one), entry(F.col("tail"), one))
    counts = tokens.select("part", F.explode(entries).alias("e")).where("e.size > 0 and e.n > 0").groupBy("part", "e.size").agg(F.sum("e.n").alias("n"))
    counts = materialize(counts, "piece_counts")
    histogram = {r["size"]: r["n"] for r in counts.groupBy("size").agg(F.sum("n").alias("n")).collect()}  # one row per length
    plan = make_plan(histogram, capacity)
    before = F.sum("n").over(Window.partitionBy("size").orderBy("part")) - F.col("n")
    offsets = counts.select("part", F.struct("size", before.alias("before")).alias("e")).groupBy("part").agg(F.collect_list("e").alias("before"))
    offsets = materialize(offsets, "piece_offsets")
    schema = f"`{key}` {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = None, {}
        for batch in batches:
            for i in range(0, len(batch), 500):
                some = batch.slice(i, 500)
                get = {name: some.column(name).to_pylist() for name in some.schema.names if name not in ("before", key)}
                source, rows = [], []
                for j in range(len(some)):
                    if get["part"][j] != part:
                        part = get["part"][j]
                        before = {e["size"]: e["before"] for e in some.column("before")[j].as_py()}
                    ids = np.frombuffer(get["ids"][j], f"<u{get['width'][j]}").astype("<u4")
                    own = [(capacity, before.get(capacity, 0) + get["full_rank"][j] + n) for n in range(get["full"][j])]
                    own += [(get[c][j], before[get[c][j]] + get[f"{c}_rank"][j]) for c in ("body", "tail") if get[c][j]]
                    start = 0
                    for size, rank in own:
                        for sequence, offset, length in plan.place(size, rank):
                            source.append(j)
                            rows.append((start, length, ids[start : start + length].tobytes(), len(ids), sequence, offset))
                            start += length
                start, length, data, total, sequence, offset = zip(*rows)
                numbers = [pa.array(x, pa.int64()) for x in (start, length, total, sequence, offset)]
                yield pa.RecordBatch.from_arrays(
                    [some.column(key).take(pa.array(source)), numbers[0], numbers[1], pa.array(data, pa.binary()), *numbers[2:]],
                    names=[key, "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
                )

    joined = tokens.join(offsets, "part")
    return joined.select(key, "ids", "width", "part", *(p.split()[0] for p in pieces.split(", ")), "before").mapInArrow(assign, schema)
