"""Benchmark decontamination with suffix arrays over the training documents.

Each batch of documents is a shard. Its words become numbers (0 for a word that no benchmark
item holds), the suffixes that can begin a match are sorted into a suffix array, and every
test suffix of the benchmark is binary-searched in it at once. The ranges found give the
places of all verbatim matches of a window; neighbouring places on one diagonal join into the
longest match of an item.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowproof.llm.text import ALNUM_WORDS, bound_batches, free_name, share, utf8

WINDOW = 13

#: Words in one suffix array; a longer document is cut into overlapping pieces.
SHARD_WORDS = 2_000_000

#: Words of benchmark text that one search block may hold in memory (about 300 bytes each while
#: it is built, 110 when it is shared); a larger benchmark is searched block after block.
BLOCK_WORDS = 1_000_000

MATCHES = "array<struct<item_id:string,doc_start:bigint,item_start:bigint,n_words:bigint>>"
FOUND = f"struct<n_words:bigint,hits:array<struct<first:bigint,past:bigint>>,matches:{MATCHES}>"


class TestSuffixes:
    """Numbered, packed and sorted windows of one block of benchmark items.

    Windows are rows of word numbers, padded behind; equal ones are one entry with all its places.
    """

    def __init__(self, items: list[tuple[str, bytes]]):
        self.names = sorted({name for name, _ in items})
        self.vocabulary: dict[bytes, int] = {}
        number = {name: k for k, name in enumerate(self.names)}
        numbered = []
        for name, text in items:
            words = text.translate(ALNUM_WORDS).split()
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words]
            if ids:
                numbered.append((number[name], np.array(ids, np.int32)))
        self.bits = max(1, len(self.vocabulary).bit_length())
        self.per_key = max(1, 62 // self.bits)
        top = (1 << self.bits) - 1
        # All items in a row, each followed by padding, so that a window is a slice.
        n = np.array([len(w) for _, w in numbered], np.int64)
        length = np.minimum(n, WINDOW)
        flat = np.zeros(int(n.sum()) + WINDOW * len(numbered), np.int32)
        begin = np.cumsum(n + WINDOW) - (n + WINDOW)
        for (_, words), b in zip(numbered, begin.tolist(), strict=True):
            flat[b:b + len(words)] = words
        count = n - length + 1
        owner = np.repeat(np.arange(len(numbered)), count)
        start = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
        at, size = begin[owner] + start, length[owner] if len(owner) else np.zeros(0, np.int64)
        keys = [*self.keys(lambda j: flat[at + j].astype(np.int64) * (j < size), len(at)), size]
        order = np.lexsort(keys[::-1])
        new = np.ones(len(order), bool)
        if len(order):
            new[1:] = np.any([k[order[1:]] != k[order[:-1]] for k in keys], axis=0)
        entry, first = np.flatnonzero(new), order[new]
        self.lengths = size[first]
        self.low = [k[first] for k in keys[:-1]]
        words_of = lambda j: np.where(j < self.lengths, flat[at[first] + j].astype(np.int64), top)
        self.high = self.keys(words_of, len(first))
        second = np.minimum(at[first] + 1, max(0, len(flat) - 1))
        pairs = flat[at[first]].astype(np.int64) << self.bits | flat[second] if len(first) else np.zeros(0, np.int64)
        self.first_pairs = np.unique(pairs[self.lengths > 1])
        self.single = np.unique(flat[at[first][self.lengths == 1]]).astype(np.int64)
        # Places of each window in the items, one list after the other.
        self.n_places = np.diff(np.append(entry, len(order)))
        self.place_from = np.concatenate(([0], np.cumsum(self.n_places))).astype(np.int64)
        items_of = np.array([k for k, _ in numbered], np.int64)
        self.place_item = items_of[owner[order]] if len(order) else np.zeros(0, np.int64)
        self.place_start = start[order]

    def keys(self, column, rows: int) -> list[np.ndarray]:
        """The first words of each suffix, several to a sort key."""
        keys = []
        for first in range(0, WINDOW, self.per_key):
            key = np.zeros(rows, np.int64)
            for j in range(first, min(WINDOW, first + self.per_key)):
                key <<= self.bits
                key |= column(j)
            keys.append(key)
        return keys


def _bound(keys: list[np.ndarray], wanted: list[np.ndarray], past_equal: bool) -> np.ndarray:
    """Binary search of all wanted suffixes at once: the first place not before (or after) each."""
    n, m = len(keys[0]), len(wanted[0])
    low, high = np.zeros(m, np.int64), np.full(m, n, np.int64)
    for _ in range(n.bit_length()):
        open_ = low < high
        middle = np.minimum((low + high) >> 1, n - 1)
        before, equal = np.zeros(m, bool), np.ones(m, bool)
        for key, want in zip(keys, wanted, strict=True):
            found = key[middle]
            before |= equal & (found < want)
            equal &= found == want
        if past_equal:
            before |= equal
        low = np.where(open_ & before, middle + 1, low)
        high = np.where(open_ & ~before, middle, high)
    return low


def _shard_matches(tokens: np.ndarray, tests: TestSuffixes) -> tuple[np.ndarray, np.ndarray]:
    """Places and window numbers of all matches in one shard."""
    padded = np.concatenate((tokens, np.zeros(WINDOW, np.int64)))
    can_start = np.zeros(len(tokens), bool)
    if len(tests.first_pairs):
        both = np.flatnonzero((padded[:len(tokens)] > 0) & (padded[1:len(tokens) + 1] > 0))
        pairs = padded[both] << tests.bits | padded[both + 1]
        spot = np.minimum(np.searchsorted(tests.first_pairs, pairs), len(tests.first_pairs) - 1)
        can_start[both[tests.first_pairs[spot] == pairs]] = True
    if len(tests.single):
        can_start |= np.isin(tokens, tests.single)
    suffixes = np.flatnonzero(can_start)
    none = np.zeros(0, np.int64)
    if not len(suffixes):
        return none, none
    keys = tests.keys(lambda j: padded[suffixes + j], len(suffixes))
    order = np.lexsort(keys[::-1])
    suffixes, keys = suffixes[order], [key[order] for key in keys]
    low = _bound(keys, tests.low, past_equal=False)
    counts = _bound(keys, tests.high, past_equal=True) - low
    found = np.flatnonzero(counts > 0)
    if not len(found):
        return none, none
    n = counts[found]
    inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return suffixes[np.repeat(low[found], n) + inside], np.repeat(found, n)


def _pieces(documents: list[np.ndarray]) -> Iterator[list[tuple[int, int, np.ndarray]]]:
    """Shards: lists of (document, first word, words), long documents in overlapping pieces."""
    shard, size = [], 0
    for d, words in enumerate(documents):
        for first in range(0, max(1, len(words)), SHARD_WORDS):
            piece = words[first:first + SHARD_WORDS + WINDOW - 1]
            if shard and size + len(piece) > SHARD_WORDS:
                yield shard
                shard, size = [], 0
            shard.append((d, first, piece))
            size += len(piece)
    if shard:
        yield shard


def _search(texts: list[bytes], tests: TestSuffixes) -> list[tuple[int, list, list]]:
    """Per text: number of words, hit spans, longest match of each item."""
    get = tests.vocabulary.get
    documents = []
    for text in texts:
        words = text.translate(ALNUM_WORDS).split()
        documents.append(np.fromiter(map(get, words, repeat(0)), np.int64, len(words)))
    found: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in texts]
    if len(tests.lengths):
        for shard in _pieces(documents):
            # A zero behind every piece: no match runs from one document into the next.
            sizes = np.array([len(piece) + 1 for _, _, piece in shard], np.int64)
            begin = np.cumsum(sizes) - sizes
            tokens = np.zeros(sizes.sum(), np.int64)
            for (_, _, piece), b in zip(shard, begin, strict=True):
                tokens[b:b + len(piece)] = piece
            places, windows = _shard_matches(tokens, tests)
            order = np.argsort(places, kind="stable")
            places, windows = places[order], windows[order]
            owner = np.searchsorted(begin, places, side="right") - 1
            cut = np.searchsorted(owner, np.arange(len(shard) + 1))
            for k in np.unique(owner):
                d, first, _ = shard[k]
                own = slice(cut[k], cut[k + 1])
                found[d].append((places[own] - begin[k] + first, windows[own]))
    results = []
    for words, parts in zip(documents, found, strict=True):
        if not parts:
            results.append((len(words), [], []))
            continue
        places = np.concatenate([p for p, _ in parts])
        windows = np.concatenate([w for _, w in parts])
        results.append((len(words), _spans(places, places + tests.lengths[windows]),
                        _longest(places, windows, tests)))
    return results


def _spans(first: np.ndarray, past: np.ndarray) -> list[tuple[int, int]]:
    """Union of the intervals."""
    order = np.argsort(first, kind="stable")
    first, past = first[order], np.maximum.accumulate(past[order])
    new = np.flatnonzero(np.concatenate(([True], first[1:] > past[:-1])))
    ends = past[np.concatenate((new[1:] - 1, [len(past) - 1]))]
    return list(zip(first[new].tolist(), ends.tolist(), strict=True))


def _longest(places: np.ndarray, windows: np.ndarray, tests: TestSuffixes) -> list[tuple]:
    """The longest verbatim match with each item: (item, place in text, place in item, words)."""
    n = tests.n_places[windows]
    inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    spot = np.repeat(tests.place_from[windows], n) + inside
    place, item, start = np.repeat(places, n), tests.place_item[spot], tests.place_start[spot]
    length = np.repeat(tests.lengths[windows], n)
    order = np.lexsort((place, place - start, item))
    place, item, start, length = place[order], item[order], start[order], length[order]
    joined = (item[1:] == item[:-1]) & (place[1:] - start[1:] == place[:-1] - start[:-1])
    joined &= place[1:] - place[:-1] <= 1
    new = np.flatnonzero(np.concatenate(([True], ~joined)))
    last = np.concatenate((new[1:] - 1, [len(place) - 1]))
    words = place[last] + length[last] - place[new]
    best: dict[int, tuple] = {}
    for i, p, s, w in zip(item[new].tolist(), place[new].tolist(), start[new].tolist(), words.tolist(), strict=True):
        if i not in best or w > best[i][3]:
            best[i] = (tests.names[i], p, s, w)
    return [best[i] for i in sorted(best)]


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[str, bytes]]]:
    """Benchmark items in blocks of bounded size, the same items always in the same block."""
    items = benchmark.select(
        F.coalesce(benchmark["item_id"].cast("string"), F.lit("")).alias("item_id"),
        benchmark["text"].cast("binary").alias("body"),
        F.regexp_count(benchmark["text"].cast("string"), F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")).alias("n"),
    ).filter("n > 0")
    words = items.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    blocks = max(1, math.ceil(words / BLOCK_WORDS))
    block = F.pmod(F.xxhash64("item_id"), F.lit(blocks))
    for k in range(blocks):
        yield [(r["item_id"], bytes(r["body"])) for r in items.filter(block == k).select("item_id", "body").collect()]


def _searched(docs: DataFrame, tests: TestSuffixes, name: str, again: bool) -> DataFrame:
    """Adds the findings of one block; ``again`` joins them to those of the blocks before."""
    known = docs.drop(name) if again else docs
    schema = known.select("*", F.lit(None).cast(FOUND).alias(name)).schema
    shared = share(docs.sparkSession, tests)
    kind = pa.struct([
        ("n_words", pa.int64()),
        ("hits", pa.list_(pa.struct([("first", pa.int64()), ("past", pa.int64())]))),
        ("matches", pa.list_(pa.struct([("item_id", pa.string()), ("doc_start", pa.int64()),
                                        ("item_start", pa.int64()), ("n_words", pa.int64())]))),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        suffixes = shared()
        for batch in batches:
            found = _search(utf8(batch.column("text")), suffixes)
            rows = [
                {"n_words": n, "hits": [{"first": a, "past": b} for a, b in hits],
                 "matches": [dict(zip(("item_id", "doc_start", "item_start", "n_words"), m, strict=True)) for m in matches]}
                for n, hits, matches in found
            ]
            if again:
                for row, old in zip(rows, batch.column(name).to_pylist(), strict=True):
                    spans = [(h["first"], h["past"]) for h in row["hits"] + old["hits"]]
                    if spans:
                        first, past = np.array(spans, np.int64).T
                        row["hits"] = [{"first": a, "past": b} for a, b in _spans(first, past)]
                    row["matches"] = old["matches"] + row["matches"]
                batch = batch.select([f.name for f in batch.schema if f.name != name])
            columns = [*batch.columns, pa.array(rows, kind)]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, name])

    return docs.mapInArrow(run, schema)


def find_contamination(docs: DataFrame, benchmark: DataFrame, name: str = "_found") -> DataFrame:
    """``docs`` with a column ``name``: words, hit spans and the longest match of each item.

    A text's words are runs of ASCII letters and digits, A-Z lower-cased, and of any other
    character beyond ASCII. A window is 13 consecutive words of an item; an item of fewer words
    is one window. Null and empty texts have no words and no findings; items without words
    match nothing; rows that repeat are judged alike; an item id that repeats counts once, a
    null one as empty text; empty tables give empty results. All columns of ``docs`` pass
    through; ``name`` must not be among them, else ValueError. Very long texts are searched whole.
    """
    if name.lower() in {c.lower() for c in docs.columns}:
        raise ValueError(f"there is a column {name} already")
    bound_batches(docs.sparkSession)
    found, again = docs, False
    for items in _blocks(benchmark):
        found, again = _searched(found, TestSuffixes(items), name, again), True
    return found


def n_hit(name: str) -> Column:
    return F.aggregate(
        F.col(name)["hits"], F.lit(0).cast("long"), lambda s, h: s + h["past"] - h["first"]
    )


def contaminated(name: str) -> Column:
    """A document is contaminated when at least a twentieth of its words is hit."""
    return (n_hit(name) > 0) & (20 * n_hit(name) >= F.col(name)["n_words"])


def contamination_report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document with counts, the items found and the verdict."""
    found = find_contamination(docs.select("doc_id", "text"), benchmark)
    names = F.array_sort(F.transform("_found.matches", lambda m: m["item_id"]))
    return found.select(
        "doc_id",
        F.col("_found.n_words").alias("n_words"),
        n_hit("_found").alias("n_hit"),
        F.size("_found.matches").cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ",").cast("binary"), 256).alias("items_sha256"),
        contaminated("_found").alias("contaminated"),
    )


def remove_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated, with their columns as they were.

    Null and empty texts stay, rows that repeat stay or go alike, an empty benchmark removes
    nothing; any column names are allowed.
    """
    name = free_name(docs, "_found")
    return find_contamination(docs, benchmark, name).filter(~contaminated(name)).drop(name)
