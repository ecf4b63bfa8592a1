"""Benchmark passages in training texts, found by an FM-index per shard of documents.

A shard is a slice of one task's texts. Its words that occur in no phrase can be part of no match, so each
run of them counts as one separator; the index covers all other words. Phrases are sought backwards with
ranks from a wavelet matrix, their places are read from sampled suffix positions, and overlapping places
are merged into removal spans.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lealtia.llm.common import Powers, letter_values, split_words, text_slices

PHRASE = 13
#: Every so many positions, and at the start of each run of words, the suffix position is stored.
SAMPLE = 8
#: A benchmark is sought in blocks of about so many words; each block is one more pass over the texts.
BLOCK_WORDS = 2_000_000

_BREAK = np.ones(256, bool)
_BREAK[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


class WaveletMatrix:
    """Symbols of a sequence by their bits, with counts of ones before every place of every level."""

    def __init__(self, symbols: np.ndarray, top: int) -> None:
        self.bits = max(1, top.bit_length())
        self.ones: list[np.ndarray] = []
        self.zeros: list[int] = []
        for level in reversed(range(self.bits)):
            bit = ((symbols >> level) & 1).astype(bool)
            self.ones.append(np.concatenate([[0], np.cumsum(bit, dtype=np.int64)]))
            self.zeros.append(len(symbols) - int(self.ones[-1][-1]))
            symbols = np.concatenate([symbols[~bit], symbols[bit]])

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before the place beside it."""
        low = np.zeros(len(place), np.int64)
        for level, (ones, zeros) in enumerate(zip(self.ones, self.zeros)):
            up = (symbol >> (self.bits - 1 - level)) & 1 == 1
            low = np.where(up, zeros + ones[low], low - ones[low])
            place = np.where(up, zeros + ones[place], place - ones[place])
        return place - low

    def at(self, place: np.ndarray) -> np.ndarray:
        """The symbols at some places."""
        symbol = np.zeros(len(place), np.int64)
        for ones, zeros in zip(self.ones, self.zeros):
            up = ones[place + 1] - ones[place]
            symbol = symbol * 2 + up
            place = np.where(up == 1, zeros + ones[place], place - ones[place])
        return symbol


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Suffixes in order, by doubling the compared length; separators (0) differ by their place."""
    apart = symbols == 0
    rank = symbols + int(apart.sum())
    rank[apart] = np.arange(int(apart.sum()))
    _, rank = np.unique(rank, return_inverse=True)
    width, n = 1, len(symbols)
    while True:
        behind = np.zeros(n, np.int64)
        behind[: max(n - width, 0)] = rank[width:] + 1
        key = rank * (n + 1) + behind
        order = np.argsort(key, kind="stable")
        step = np.empty(n, np.int64)
        step[:1] = 0
        step[1:] = key[order][1:] != key[order][:-1]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(step)
        if not n or rank[order[-1]] == n - 1:
            return order
        width *= 2


class FmIndex:
    """Index of a sequence of symbols; 0 separates runs, which no phrase crosses."""

    def __init__(self, symbols: np.ndarray, top: int, sample: int = SAMPLE) -> None:
        order = suffix_order(symbols)
        self.matrix = WaveletMatrix(symbols[order - 1], top)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=top + 1))])
        kept = (order % sample == 0) | (symbols[order - 1] == 0)
        self.samples = order[kept]
        self.sampled = np.concatenate([[0], np.cumsum(kept)])

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and end row of each phrase; ``phrases`` holds the last symbol of each in column 0."""
        low = np.zeros(len(phrases), np.int64)
        high = np.full(len(phrases), self.first[-1], np.int64)
        for step in range(phrases.shape[1]):
            live = np.flatnonzero((lengths > step) & (low < high))
            if not len(live):
                break
            symbol = phrases[live, step]
            low[live] = self.first[symbol] + self.matrix.rank(symbol, low[live])
            high[live] = self.first[symbol] + self.matrix.rank(symbol, high[live])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Position of the suffix in each row: steps back until a sampled one is met."""
        found, rows = np.zeros(len(rows), np.int64), rows.copy()
        open_ = np.arange(len(rows))
        steps = 0
        while len(open_):
            here = rows[open_]
            done = self.sampled[here + 1] > self.sampled[here]
            found[open_[done]] = self.samples[self.sampled[here[done]]] + steps
            open_ = open_[~done]
            symbol = self.matrix.at(rows[open_])
            rows[open_] = self.first[symbol] + self.matrix.rank(symbol, rows[open_])
            steps += 1
        return found


class Phrases:
    """The windows of a block of items as rows of word numbers, and the items of each window."""

    def __init__(self, items: list[tuple[str | None, np.ndarray]], width: int) -> None:
        words = [w for _, w in items if len(w)]
        self.vocabulary = np.unique(np.concatenate(words)) if words else np.zeros(0, np.uint64)
        owners: dict[tuple, set[str]] = {}
        for name, hashes in items:
            numbers = (np.searchsorted(self.vocabulary, hashes) + 1).tolist()
            for first in range(max(1, len(numbers) - width + 1) if numbers else 0):
                owner = owners.setdefault(tuple(numbers[first : first + width]), set())
                if name is not None:
                    owner.add(name)
        self.lengths = np.array([len(p) for p in owners], np.int64)
        self.table = np.zeros((len(owners), width), np.int64)
        for row, phrase in enumerate(owners):
            self.table[row, : len(phrase)] = phrase[::-1]
        self.owners = [sorted(o) for o in owners.values()]
        self.shortest = int(self.lengths.min()) if len(owners) else 0


def phrase_blocks(benchmark: DataFrame, width: int, block_words: int) -> Iterator[Phrases]:
    """The items in blocks of about ``block_words`` words, so that a block has a bounded size."""
    values, powers = letter_values(fold=True), Powers()
    held: list[tuple[str | None, np.ndarray]] = []
    size = 0
    for row in benchmark.select(F.col("item_id").cast("string"), F.col("text").cast("string")).toLocalIterator():
        raw = np.frombuffer((row[1] or "").encode(), np.uint8)
        hashes = split_words(raw, np.array([0, len(raw)]), _BREAK, values, powers).hashes
        held.append((row[0], hashes))
        size += len(hashes)
        if size >= block_words:
            yield Phrases(held, width)
            held, size = [], 0
    yield Phrases(held, width)


def occurrences(numbers: np.ndarray, bounds: np.ndarray, phrases: Phrases) -> tuple[np.ndarray, np.ndarray]:
    """(first word, phrase) of every occurrence in a shard; ``numbers`` has a phrase word's number or 0."""
    known = numbers > 0
    fresh = np.zeros(len(numbers) + 1, bool)
    fresh[bounds] = True
    starts = np.flatnonzero(known & (np.concatenate([[True], ~known[:-1]]) | fresh[:-1]))
    ends = np.flatnonzero(known & (np.concatenate([~known[1:], [True]]) | fresh[1:])) + 1
    long_enough = ends - starts >= phrases.shortest
    starts, ends = starts[long_enough], ends[long_enough]
    none = np.zeros(0, np.int64)
    if not len(starts) or not phrases.shortest:
        return none, none
    edge = np.zeros(len(numbers) + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, ends, -1)
    kept = np.flatnonzero(np.cumsum(edge[:-1]))
    at = np.searchsorted(kept, starts)
    symbols = np.insert(numbers[kept], at, 0)
    places = np.insert(kept, at, -1)
    index = FmIndex(symbols, len(phrases.vocabulary))
    low, high = index.search(phrases.table, phrases.lengths)
    counts = np.maximum(high - low, 0)
    which = np.repeat(np.arange(len(counts)), counts)
    rows = np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(low, counts)
    return places[index.locate(rows)], which


def find_passages(
    docs: DataFrame,
    benchmark: DataFrame,
    keep: list[str],
    width: int = PHRASE,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """The columns ``keep`` of every row and what of the benchmark is in its ``text``.

    ``n_words``; ``span_starts`` and ``span_ends``, the merged runs of hit words (numbers from 0, end
    exclusive); ``n_hit`` words in them; ``items``, the ids found, as sorted strings, and ``n_items``;
    ``contaminated`` if there is a hit and the hits are a twentieth of the words or more. A null or empty
    text has no words and no hit; a null or empty item is never found; an item without id hits but is not
    listed. Repeated items count once; repeated rows are treated row by row. Kept columns that are named
    like a result are replaced. An empty table gives no rows; an empty benchmark hits nothing.
    """
    results = ["n_words", "span_starts", "span_ends", "n_hit", "items", "n_items", "contaminated"]
    kept = [docs.schema[c] for c in keep if c not in results]
    carried = [
        T.StructField("n_words", T.LongType()),
        T.StructField("span_starts", T.ArrayType(T.LongType())),
        T.StructField("span_ends", T.ArrayType(T.LongType())),
        T.StructField("items", T.ArrayType(T.StringType())),
    ]
    text = T.StructField("__fm_text", T.StringType())
    blocks = list(phrase_blocks(benchmark, width, block_words))
    frame = docs.select(*[F.col(f"`{f.name}`") for f in kept], F.col("text").cast("string").alias("__fm_text"))
    for number, phrases in enumerate(blocks):
        again, last = number > 0, number == len(blocks) - 1
        fields = kept + ([] if last else [text]) + carried
        frame = frame.mapInArrow(_search(phrases, len(kept), again, last), T.StructType(fields))
    hits = F.aggregate(
        F.zip_with("span_ends", "span_starts", lambda e, s: e - s), F.lit(0).cast("long"), lambda a, n: a + n
    )
    return (
        frame.withColumn("n_hit", hits)
        .withColumn("n_items", F.size("items").cast("long"))
        .withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * 20 >= F.col("n_words")))
        .select(*[F.col(f"`{f.name}`") for f in kept], *results)
    )


def _search(phrases: Phrases, n_kept: int, again: bool, last: bool):
    """A task's work for one block; ``again``: results of earlier blocks stand behind the text."""

    def shard(batch: pa.RecordBatch, powers: Powers, values: np.ndarray) -> Iterator[pa.RecordBatch]:
        texts = batch.column(n_kept)
        for first, end, data, offsets in text_slices(texts):
            words = split_words(data, offsets, _BREAK, values, powers)
            total = len(words.hashes)
            numbers = np.zeros(total, np.int64)
            if len(phrases.vocabulary):
                guess = np.minimum(np.searchsorted(phrases.vocabulary, words.hashes), len(phrases.vocabulary) - 1)
                numbers = np.where(phrases.vocabulary[guess] == words.hashes, guess + 1, 0)
            begin, which = occurrences(numbers, words.bounds, phrases)
            edge = np.zeros(total + 1, np.int64)
            np.add.at(edge, begin, 1)
            np.add.at(edge, begin + phrases.lengths[which], -1)
            part = batch.slice(first, end - first)
            own = np.searchsorted(words.bounds, begin, "right") - 1
            if again:
                old_starts, old_ends = part.column(n_kept + 2), part.column(n_kept + 3)
                shift = np.repeat(words.bounds[:-1], np.diff(old_starts.offsets.to_numpy()))
                np.add.at(edge, old_starts.flatten().to_numpy() + shift, 1)
                np.add.at(edge, old_ends.flatten().to_numpy() + shift, -1)
            covered = np.cumsum(edge[:-1]) > 0
            fresh = np.zeros(total + 1, bool)
            fresh[words.bounds] = True
            starts = np.flatnonzero(covered & (np.concatenate([[True], ~covered[:-1]]) | fresh[:-1]))
            ends = np.flatnonzero(covered & (np.concatenate([~covered[1:], [True]]) | fresh[1:])) + 1
            owner = np.searchsorted(words.bounds, starts, "right") - 1
            cuts = np.searchsorted(owner, np.arange(end - first + 1))
            found: list[set[str]] = [set() for _ in range(end - first)]
            for pair in np.unique(own * max(1, len(phrases.owners)) + which).tolist():
                found[pair // len(phrases.owners)].update(phrases.owners[pair % len(phrases.owners)])
            if again:
                for names, old in zip(found, part.column(n_kept + 4).to_pylist()):
                    names.update(old)
            base = words.bounds[owner]
            columns = [part.column(i) for i in range(n_kept + (not last))] + [
                pa.array(np.diff(words.bounds)),
                pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(starts - base, pa.int64())),
                pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(ends - base, pa.int64())),
                pa.array([sorted(names) for names in found], pa.list_(pa.string())),
            ]
            names = [batch.schema.names[i] for i in range(n_kept + (not last))]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "n_words", "span_starts", "span_ends", "items"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, values = Powers(), letter_values(fold=True)
        for batch in batches:
            yield from shard(batch, powers, values)

    return search
