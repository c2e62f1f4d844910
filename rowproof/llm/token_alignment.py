"""Alignment of two tokenizers' tokens over the bytes of a text, by merge paths.

Tokens of A and of B that cover the same bytes have ends that form two sorted lists. Merging them
gives, at each distinct end, the one pair of tokens that overlaps in front of it (a link), and at
each common end a cut between two groups. Binary searches along the diagonals of the merge grid
divide the merging into pieces with equal numbers of ends, which do not depend on each other, so
that one giant document and a thousand small ones cost the same. A piece gives its overlaps;
groups that begin in one piece and end in a later one are stitched.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rowproof.llm.text import bound_batches, share
from rowproof.session import settle, settle_measured

#: Ends in one piece of the merge.
PIECE_ENDS = 4096

#: Characters of texts that are encoded and merged at once (one text may be longer).
STEP_CHARS = 500_000

#: Distinct pairs whose counts are handed to every task; more than that are joined.
SHARED_PAIRS = 2_000_000

#: Pairs that a task holds before it passes their counts on.
HELD_PAIRS = 1_000_000

#: How the byte-level pre-tokenizer splits a text.
BYTE_LEVEL_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_of_char() -> dict[str, int]:
    """The byte-level alphabet: printable bytes stand for themselves, others from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(rest)}


@dataclass
class TokenizerPair:
    """A byte-level byte-pair tokenizer (A) and a byte-pair piece model with byte fallback (B)."""

    ranks: dict[bytes, int]
    model: bytes

    @staticmethod
    def load(tokenizer_file: str, model_file: str) -> TokenizerPair:
        """Raises ValueError for a tokenizer of another kind, which would give other ids."""
        read = json.loads(Path(tokenizer_file).read_text(encoding="utf-8"))
        split, model = read["pre_tokenizer"] or {}, read["model"]
        if split.get("type") != "ByteLevel" or split.get("add_prefix_space") or not split.get("use_regex", True) or read["normalizer"]:
            raise ValueError("tokenizer A must be byte-level, without a normalizer or a prefix")
        vocab, of = model["vocab"], _byte_of_char()
        merged = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
        if [vocab[m] for m in merged] != list(range(256, 256 + len(merged))):
            raise ValueError("tokenizer A must number its tokens in the order of its merges")
        return TokenizerPair({bytes(of[c] for c in t): k for t, k in vocab.items()}, Path(model_file).read_bytes())

    @cached_property
    def _a(self):
        import tiktoken

        return tiktoken.Encoding("a", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=self.ranks, special_tokens={})

    @cached_property
    def _b(self):
        import sentencepiece

        return sentencepiece.SentencePieceProcessor(model_proto=self.model)

    @cached_property
    def a_bytes(self) -> list[bytes]:
        found = [b""] * (max(self.ranks.values()) + 1)
        for token, k in self.ranks.items():
            found[k] = token
        return found

    @cached_property
    def b_bytes(self) -> list[bytes]:
        n, b = self._b.get_piece_size(), self._b
        pieces = [b.id_to_piece(k) for k in range(n)]
        return [bytes([int(p[1:-1], 16)]) if b.is_byte(k) else p.replace("▁", " ").encode() for k, p in enumerate(pieces)]

    @cached_property
    def lengths(self) -> tuple[np.ndarray, np.ndarray]:
        return tuple(np.array([len(t) for t in side], np.int64) for side in (self.a_bytes, self.b_bytes))

    @cached_property
    def names(self) -> list[bytes]:
        """How each token is written inside and at the end of its side of a group: A's, then B's."""
        found = []
        for side, last in ((self.a_bytes, b"|"), (self.b_bytes, b";")):
            for k in range(len(side)):
                found += [b"%d," % k, b"%d%s" % (k, last)]
        return found

    @cached_property
    def pair_width(self) -> str:
        return "<u4" if len(self.a_bytes) * len(self.b_bytes) < 1 << 32 else "<u8"

    def encode(self, texts: list[str]) -> list[tuple[list[int], list[int]]]:
        """Ids by A (of a blank and the text) and by B (which puts the blank itself), of each text
        whose tokens spell exactly that; else none."""
        out, a_of, b_of = [], self.a_bytes.__getitem__, self.b_bytes.__getitem__
        for text, b in zip(texts, self._b.encode(texts, num_threads=1), strict=True):
            whole = (" " + text).encode("utf-8")
            a = self._a.encode_ordinary(" " + text) if text else []
            good = text and b"".join(map(a_of, a)) == whole and b"".join(map(b_of, b)) == whole
            out.append((a, b) if good else ([], []))
        return out


def merge_cuts(a: np.ndarray, b: np.ndarray, piece: int) -> tuple[np.ndarray, np.ndarray]:
    """Where pieces begin in two sorted lists: on every ``piece``-th diagonal of the merge grid.

    A binary search on each diagonal finds how many of its ends are A's; of equal ends A's comes
    first. A cut between two equal ends moves behind both.
    """
    d = np.append(np.arange(0, len(a) + len(b), piece), len(a) + len(b))
    low, high = np.maximum(0, d - len(b)), np.minimum(d, len(a))
    while (open_ := low < high).any():
        mid = (low + high) // 2
        ahead = open_ & (a[np.minimum(mid, len(a) - 1)] <= b[np.clip(d - 1 - mid, 0, len(b) - 1)])
        low = np.where(ahead, mid + 1, low)
        high = np.where(open_ & ~ahead, mid, high)
    i, j = low, d - low
    if len(a) and len(b):
        j = j + ((i > 0) & (j < len(b)) & (a[np.maximum(i - 1, 0)] == b[np.minimum(j, len(b) - 1)]))
    return i, j


def merge_pieces(a: np.ndarray, b: np.ndarray, piece: int = PIECE_ENDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(token of A, token of B, whether both end here) at each distinct end of two lists that
    cover the same bytes, merged piece by piece."""
    if not len(a):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
    i, j = merge_cuts(a, b, piece)
    n_a, n_b = np.diff(i), np.diff(j)
    most = int((n_a + n_b).max())
    column = np.arange(most)
    # A row a piece: A's ends, then B's, as odd and even numbers so that A's comes first.
    from_a, from_b = column < n_a[:, None], (column >= n_a[:, None]) & (column < (n_a + n_b)[:, None])
    keys = np.full(from_a.shape, np.iinfo(np.int64).max)
    keys[from_a] = 2 * a
    keys[from_b] = 2 * b + 1
    keys.sort(axis=1, kind="stable")  # two sorted runs: merged in one pass
    used = column < (n_a + n_b)[:, None]
    is_b = (keys & 1).astype(bool) & used
    before_b = np.cumsum(is_b, axis=1) - is_b
    end = keys >> 1
    new = used.copy()
    new[:, 1:] &= end[:, 1:] != end[:, :-1]
    common = np.zeros_like(new)
    common[:, :-1] = (end[:, 1:] == end[:, :-1]) & used[:, 1:]
    token_a = i[:-1, None] + column - before_b
    token_b = j[:-1, None] + before_b
    return token_a[new], token_b[new], common[new]


@dataclass
class Aligned:
    """Documents' tokens, links and groups; documents follow each other in all arrays."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    pairs: list[np.ndarray]
    times: list[np.ndarray]
    groups: list[bytes]


def align_texts(both: TokenizerPair, texts: list[str]) -> Aligned:
    encoded = both.encode(texts)
    n_a, n_b = (np.array([len(e[side]) for e in encoded], np.int64) for side in (0, 1))
    ids_a, ids_b = (np.fromiter((k for e in encoded for k in e[side]), np.int64, int(n.sum())) for side, n in ((0, n_a), (1, n_b)))
    ends_a, ends_b = np.cumsum(both.lengths[0][ids_a]), np.cumsum(both.lengths[1][ids_b])
    token_a, token_b, common = merge_pieces(ends_a, ends_b)
    # The last end of a document is common, so no group reaches into the next one.
    last_a, last_b = token_a[common], token_b[common]
    behind_a = np.cumsum(n_a)
    groups_to = np.searchsorted(last_a, behind_a - 1, "right") if len(last_a) else np.zeros(len(texts), np.int64)
    n_groups = np.diff(groups_to, prepend=0)
    links_to = np.cumsum(n_a + n_b - n_groups)
    # Each document's distinct pairs and how many links have them.
    span = len(both.a_bytes) * len(both.b_bytes)
    doc = np.repeat(np.arange(len(texts)), n_a + n_b - n_groups)
    keyed, times = np.unique(doc * span + ids_a[token_a] * len(both.b_bytes) + ids_b[token_b], return_counts=True)
    at = np.searchsorted(keyed, np.arange(1, len(texts)) * span)
    pairs, times = np.split(keyed % span, at), np.split(times, at)
    # The groups written out: a group's A tokens, then its B tokens.
    group_a = np.repeat(np.arange(len(last_a)), np.diff(last_a, prepend=-1))
    group_b = np.repeat(np.arange(len(last_b)), np.diff(last_b, prepend=-1))
    place_a = np.arange(len(ids_a)) + np.append(-1, last_b[:-1])[group_a] + 1 if len(ids_a) else ids_a
    place_b = np.arange(len(ids_b)) + last_a[group_b] + 1 if len(ids_b) else ids_b
    written = np.empty(len(ids_a) + len(ids_b), np.int64)
    closes_a, closes_b = np.zeros(len(ids_a), np.int64), np.zeros(len(ids_b), np.int64)
    closes_a[last_a], closes_b[last_b] = 1, 1
    written[place_a] = 2 * ids_a + closes_a
    written[place_b] = 2 * (len(both.a_bytes) + ids_b) + closes_b
    names, to = both.names.__getitem__, np.cumsum(n_a + n_b).tolist()
    groups = [b"".join(map(names, written[a:b].tolist()))[:-1] for a, b in zip([0, *to[:-1]], to, strict=True)]
    assert links_to[-1] == len(token_a)
    return Aligned(n_a, n_b, n_groups, pairs, times, groups)


def _steps(texts: list[str]) -> Iterator[tuple[int, int]]:
    first, size = 0, 0
    for k, text in enumerate(texts):
        size += len(text)
        if size >= STEP_CHARS or k + 1 == len(texts):
            yield first, k + 1
            first, size = k + 1, 0


def align(docs: DataFrame, both: TokenizerPair, keep_groups: bool = True) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, groups_sha256, groups, pairs, times.

    ``groups`` is ``a1,a2|b1;a3|b2,b3`` in order (null unless ``keep_groups``), its digest is
    there in any case. ``pairs`` are the distinct linked pairs, as A's id times B's vocabulary
    plus B's id, packed in ``pair_width``; ``times`` says how many links each has (32 bits).

    Null and empty texts, and texts whose tokens do not spell a blank and the text (a U+2581 in
    it, say), have no tokens: zeros, empty groups and an empty digest. Repeated rows are
    documents of their own. Texts are taken whole, an empty table gives no rows, and only doc_id
    and text are read, so other columns may have any names.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    shared = share(spark, both)
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = (f"doc_id {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, groups string, "
              "pairs binary, times binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = shared()
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for a, b in _steps(texts):
                found = align_texts(pair, texts[a:b])
                links = found.n_a + found.n_b - found.n_groups
                digests = [hashlib.sha256(g).hexdigest() if n else "" for g, n in zip(found.groups, found.n_a.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a), *map(pa.array, (found.n_a, found.n_b, found.n_groups, links)), pa.array(digests, pa.string()),
                     pa.array([g.decode() if keep_groups else None for g in found.groups], pa.string()),
                     pa.array([p.astype(pair.pair_width).tobytes() for p in found.pairs], pa.binary()),
                     pa.array([t.astype("<u4").tobytes() for t in found.times], pa.binary())],
                    ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "groups", "pairs", "times"],
                )

    return rows.mapInArrow(run, schema)


def pair_counts(aligned: DataFrame, both: TokenizerPair) -> DataFrame:
    """(pair, docs, best): in how many documents each pair is linked, and whether no other pair of
    the same A id is in more. Tasks add up before anything is shuffled."""
    width = both.pair_width

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def summed(held: list) -> tuple[np.ndarray, np.ndarray]:
            keys, at = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
            return keys, np.bincount(at, np.concatenate([n for _, n in held])).astype(np.int64)

        def passed(keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int64)), pa.array(n)], ["pair", "docs"])

        held, size = [], 0
        for batch in batches:
            packed = b"".join(v or b"" for v in batch.column("pairs").to_pylist())
            if not packed:
                continue
            keys, n = np.unique(np.frombuffer(packed, width), return_counts=True)
            held.append((keys, n))
            size += len(keys)
            if size > HELD_PAIRS:
                held = [summed(held)]
                size = len(held[0][0])
                if size > HELD_PAIRS // 2:
                    yield passed(*held[0])
                    held, size = [], 0
        if held:
            yield passed(*summed(held))

    counts = aligned.select("pairs").mapInArrow(run, "pair bigint, docs bigint").groupBy("pair").agg(F.sum("docs").alias("docs"))
    # One A id has at most as many pairs as B has ids.
    a = F.floor(F.col("pair") / F.lit(len(both.b_bytes)))
    return counts.withColumn("best", F.col("docs") == F.max("docs").over(Window.partitionBy(a)))


def alignment_report(aligned: DataFrame, both: TokenizerPair) -> DataFrame:
    """One row per document: the counts of :func:`align` with n_best and count_sum.

    ``n_best`` counts links whose pair is the most frequent of its A id, ties included;
    ``count_sum`` adds up the documents that have each link's pair. Counts of up to SHARED_PAIRS
    pairs go to every task as sorted arrays; more are joined, with equal results.
    """
    spark = aligned.sparkSession
    bound_batches(spark)
    counts, measured = settle_measured(pair_counts(aligned, both), "pair-counts")
    plain = ["doc_id", "n_a", "n_b", "n_groups", "n_links"]
    if measured["rows"] > SHARED_PAIRS:
        return _joined_report(aligned, counts, both, plain)
    width = both.pair_width
    table = counts.toArrow().sort_by("pair")
    shared = share(spark, tuple(table.column(c).to_numpy() for c in ("pair", "docs", "best")))
    kind = aligned.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, docs, best = shared()
        for batch in batches:
            sums = np.zeros((2, batch.num_rows), np.int64)
            for k, (p, t) in enumerate(zip(batch.column("pairs").to_pylist(), batch.column("times").to_pylist(), strict=True)):
                if p:
                    at, n = np.searchsorted(pairs, np.frombuffer(p, width).astype(np.int64)), np.frombuffer(t, "<u4").astype(np.int64)
                    sums[:, k] = n @ best[at], n @ docs[at]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in plain), *map(pa.array, sums), batch.column("groups_sha256")],
                [*plain, "n_best", "count_sum", "groups_sha256"],
            )

    return aligned.select(*plain, "groups_sha256", "pairs", "times").mapInArrow(run, schema)


def _joined_report(aligned: DataFrame, counts: DataFrame, both: TokenizerPair, plain: list[str]) -> DataFrame:
    width = both.pair_width
    rows = settle(aligned.select(*plain, "groups_sha256", "pairs", "times", F.monotonically_increasing_id().alias("row")), "aligned-rows")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, p, t in zip(*(batch.column(c).to_pylist() for c in ("row", "pairs", "times")), strict=True):
                if p:
                    keys = np.frombuffer(p, width).astype(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(keys), row, np.int64)), pa.array(keys), pa.array(np.frombuffer(t, "<u4").astype(np.int64))],
                        ["row", "pair", "n"],
                    )

    links = rows.select("row", "pairs", "times").mapInArrow(run, "row bigint, pair bigint, n bigint").join(counts, "pair")
    sums = links.groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("n_best"), F.sum(F.col("n") * F.col("docs")).alias("count_sum"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return rows.join(sums, "row", "left").select(*plain, zero("n_best"), zero("count_sum"), "groups_sha256")
