"""SentencePiece encoding and decoding as a max-plus scan over the lattice of pieces.

The lattice of a text has a node before each character and an edge for each piece that occurs
(characters that no piece covers go by their bytes). A transition from one piece to the next
weighs 0 when merging the two pieces' text gives back exactly these two pieces, else minus
infinity. A path of weight 0 is the encoding of a byte-pair model, and there is exactly one, so
the best path in the max-plus sense is what the library computes by merging.

No piece holds a blank mark behind another character. So every path passes the node before a
word's mark, the text between two such nodes is encoded on its own, and equal stretches have
equal encodings. Giant documents are cut into chunks at any place. A chunk's transfer matrix
says with which weight each piece that crosses or touches its left cut leads to each piece that
crosses or touches its right cut. The matrices of a document are combined by an associative
max-plus scan, which gives every chunk the piece it starts behind and the piece it ends with;
the chunks are then traced back independently of each other.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property, lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowproof.llm.text import bound_batches, free_name, share
from rowproof.session import settle

MARK = "▁"

#: Characters of a chunk; a longer document is cut into chunks that are encoded in parallel.
CHUNK_CHARS = 32_768

#: Words in each of two generations, and piece pairs, that a worker remembers.
CACHE_WORDS = 90_000
CACHE_PAIRS = 400_000

#: Characters of texts that are split at once, and documents that are decoded at once.
SPLIT_CHARS = 4_000_000
DECODE_ROWS = 128

NEVER = -np.inf
BYTES, NOTHING = -2, -3  # instead of a piece: a character's bytes; no path at all
START = (0, 0, -1)  # the state before the first character: no piece ends there


@dataclass
class Pieces:
    """The vocabulary of a byte-pair model with byte fallback.

    What a worker has learned about stretches and pairs lives with the broadcast copy and so
    outlasts a task.
    """

    ids: dict[str, int]
    rank: dict[str, float]  # merging order: the highest score first
    texts: list[bytes]  # what each id decodes to
    byte_ids: list[int]
    longest: int
    ending: dict[str, int]  # the longest piece that ends in two given characters
    tails: dict[str, tuple[int, ...]]  # lengths of the longer pieces that end in four given ones
    strings: list[str]
    pairs: dict[int, bool] = field(default_factory=dict)
    known: dict[str, bytes] = field(default_factory=dict)
    older: dict[str, bytes] = field(default_factory=dict)

    @staticmethod
    def load(model_file: str) -> Pieces:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        ids, rank, texts, byte_ids, strings = {}, {}, [], [0] * 256, []
        for k in range(model.get_piece_size()):
            piece = model.id_to_piece(k)
            strings.append(piece)
            if model.is_byte(k):
                byte_ids[int(piece[1:-1], 16)] = k
                texts.append(bytes([int(piece[1:-1], 16)]))
            elif model.is_control(k) or model.is_unknown(k) or model.is_unused(k):
                texts.append(b"")
            else:
                ids[piece] = k
                rank[piece] = model.get_score(k)
                texts.append(piece.replace(MARK, " ").encode())
        if any(MARK in p.lstrip(MARK) or (p[:1] == MARK and p[1:2] == MARK and p.strip(MARK)) for p in ids):
            raise ValueError("a piece holds a blank mark behind another character")
        if not all(byte_ids) or model.encode(" \u00a0A\ufb01") != [k for p in ("▁▁", "\u00a0", "A", "\ufb01") for k in _plain(ids, byte_ids, p)]:
            raise ValueError("not a byte-pair model with byte fallback that leaves texts as they are")
        ending: dict[str, int] = {}
        tails: dict[str, set[int]] = {}
        for piece in ids:
            ending[piece[-2:]] = max(ending.get(piece[-2:], 1), len(piece))
            if len(piece) >= TAIL:
                tails.setdefault(piece[-TAIL:], set()).add(len(piece))
        lengths = {tail: (*sorted(found, reverse=True), *_SHORT) for tail, found in tails.items()}
        return Pieces(ids, rank, texts, byte_ids, max(map(len, ids)), ending, lengths, strings)

    @cached_property
    def packed_ids(self) -> list[bytes]:
        return [packed([k]) for k in range(len(self.strings))]

    @cached_property
    def gather(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The bytes of all pieces in a row, and where each begins and how long it is."""
        lengths = np.array([len(t) for t in self.texts], np.int64)
        return np.frombuffer(b"".join(self.texts), np.uint8), np.cumsum(lengths) - lengths, lengths

    def _merged(self, text: str) -> list[str]:
        """Byte-pair merging as defined: the best pair first, of equal ones the leftmost."""
        parts, rank = list(text), self.rank
        while True:
            best, at = None, -1
            for k in range(len(parts) - 1):
                score = rank.get(parts[k] + parts[k + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, k
            if at < 0:
                return parts
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def follows(self, left: int, right: int) -> bool:
        """Whether piece ``right`` may stand behind ``left`` (-1: at the start)."""
        key = left << 20 | right
        found = self.pairs.get(key)
        if found is None:
            if len(self.pairs) > CACHE_PAIRS:
                self.pairs.clear()
            b = self.strings[right]
            if left < 0:
                found = self._merged(b) == [b]
            else:
                a = self.strings[left]
                found = self._merged(a + b) == [a, b]
            self.pairs[key] = found
        return found

    def edges(self, text: str, end: int) -> Iterator[tuple[int, int]]:
        """(start, id) of the edges that end at a node; BYTES stands for a character's bytes."""
        get, k = self.ids.get, None
        for start in range(max(0, end - self.ending.get(text[max(0, end - 2):end], 1)), end):
            k = get(text[start:end])
            if k is not None:
                yield start, k
        if k is None:
            yield end - 1, BYTES

    def _learn(self, words: dict[str, list[str]]) -> None:
        """Viterbi over the stretches of new words: at each node one piece is reached by weight 0.

        What reaches a node depends on the text before it alone. In sorted order, a stretch
        goes on from the nodes it shares with the one before.
        """
        get, pairs, follows, tails = self.ids.get, self.pairs, self.follows, self.tails
        wide = self.packed_ids
        last, so_far, previous, found = [-1], [b""], "", {}
        for text in sorted({s for stretches in words.values() for s in stretches}):
            shared = 0
            for a, b in zip(text, previous):  # noqa: B905  the shorter one ends it
                if a != b:
                    break
                shared += 1
            del last[shared + 1:], so_far[shared + 1:]
            for end in range(shared + 1, len(text) + 1):
                # The edges of this node, written out for speed: only lengths that occur are tried.
                reached_by, start = NOTHING, 0
                for length in tails.get(text[end - TAIL:end], _SHORT) if end >= TAIL else _SHORT:
                    start = end - length
                    if start < 0:
                        continue
                    k = get(text[start:end])
                    if k is not None:
                        before = last[start]
                        fits = before == BYTES or pairs.get(before << 20 | k)
                        if fits is None:
                            fits = follows(before, k)
                        if fits:
                            reached_by = k
                            break
                # Each node has one way to it, so its ids are those of the node before and one more.
                if reached_by == NOTHING:
                    last.append(BYTES)
                    so_far.append(so_far[end - 1] + packed(self._bytes_of(text[end - 1])[::-1]))
                else:
                    last.append(reached_by)
                    so_far.append(so_far[start] + wide[reached_by])
            found[text] = so_far[-1]
            previous = text
        for word, stretches in words.items():
            self.known[word] = b"".join([found[s] for s in stretches])

    def _bytes_of(self, text: str) -> list[int]:
        """Ids of a character's bytes, the last first."""
        return [self.byte_ids[b] for b in reversed(text.encode("utf-8", "replace"))]

    def _remember(self, words: set[str]) -> None:
        """Make all ``words`` known: from memory, where possible from its older generation.

        When the younger generation is full it becomes the older one, so that what is asked for
        again and again stays.
        """
        if len(self.known) > CACHE_WORDS:
            self.known, self.older = {}, self.known
        missing = words.difference(self.known)
        met = missing.intersection(self.older)
        self.known.update(zip(met, map(self.older.__getitem__, met), strict=True))
        if len(missing) > len(met):
            self._learn({word: _stretches(word) for word in missing - met})

    def encode(self, texts: list[str]) -> list[bytes]:
        """Packed ids of whole texts, each from its first node to its last."""
        return self._encode([_words(t) for t in texts], [len(t) for t in texts])

    def encode_marked(self, text: str) -> bytes:
        """Packed ids of a text in marked form, from one passing node to another."""
        return self._encode([[MARK_FORM + s for s in _STRETCH.findall(text)]], [len(text)])[0]

    def _encode(self, split: list[list[str]], sizes: list[int]) -> list[bytes]:
        encoded, first, size = [], 0, 0
        for k, n in enumerate(sizes):
            size += n
            if size >= SPLIT_CHARS or k + 1 == len(sizes):
                self._remember(set().union(*split[first:k + 1]))
                get = self.known.__getitem__
                encoded += [b"".join(map(get, words)) for words in split[first:k + 1]]
                first, size = k + 1, 0
        return encoded


@lru_cache(64)
def _packer(n: int) -> struct.Struct:
    return struct.Struct(f"<{n}I")


def packed(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    return _packer(len(ids)).pack(*ids)


# A run of marks with what follows up to the next mark; a line feed stands alone.
_STRETCH = re.compile(f"\n|{MARK}+[^{MARK}\n]*|[^{MARK}\n]+")


#: In front of a word that is a stretch in marked form already.
MARK_FORM = "\x00\n"

#: Characters at the end of a longer piece, and the lengths of shorter ones.
TAIL, _SHORT = 4, (3, 2, 1)


def _words(text: str) -> list[str]:
    """Parts of a text that are encoded on their own, cheaply: at single blanks and line feeds.

    A part is what follows a blank (a mark), or a line feed with what follows it. Texts with
    blanks side by side, or marks of their own, are split in marked form.
    """
    if not text:
        return []
    apart = text.replace("\n", " \n") if "\n" in text else text
    if "  " in apart or apart[0] == " " or apart[-1] == " " or MARK in text or "\x00" in text:
        return [MARK_FORM + s for s in _STRETCH.findall(marked(text))]
    return apart.split(" ")


def _stretches(word: str) -> list[str]:
    if word.startswith(MARK_FORM):
        return [word[len(MARK_FORM):]]
    return ["\n", word[1:]] if word[0] == "\n" and len(word) > 1 else [word] if word == "\n" else [MARK + word]


def _plain(ids: dict[str, int], byte_ids: list[int], piece: str) -> list[int]:
    return [ids[piece]] if piece in ids else [byte_ids[b] for b in piece.encode()]


def marked(text: str) -> str:
    """A text as the model sees it: a mark in front and in place of each blank."""
    return MARK + text.replace(" ", MARK) if text else ""


def decode_all(pieces: Pieces, packed_ids: list[bytes]) -> list[str]:
    """The texts of packed ids, gathered from the pieces' bytes for all of them at once."""
    blob, starts, lengths = pieces.gather
    ids = np.frombuffer(b"".join(packed_ids), "<u4").astype(np.int64)
    n = lengths[ids]
    ends = np.cumsum(n)
    body = blob[np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts[ids] - ends + n, n)].tobytes()
    until = np.append(0, ends)[np.cumsum([len(v) // 4 for v in packed_ids])].tolist()
    texts = []
    for a, b in zip([0, *until[:-1]], until, strict=True):
        texts.append(body[a + (body[a:a + 1] == b" " and b > a):b].decode("utf-8", "replace"))
    return texts


def decode(pieces: Pieces, ids: bytes) -> str:
    """The text of packed ids, without the blank that encoding puts in front."""
    body = b"".join(map(pieces.texts.__getitem__, np.frombuffer(ids, "<u4").tolist()))
    return (body[1:] if body[:1] == b" " else body).decode("utf-8", "replace")


def states_at(pieces: Pieces, text: str, cut: int) -> list[tuple[int, int, int]]:
    """(chars before the cut, chars behind it, id) of the edges that cross or touch a cut."""
    found = []
    for end in range(cut, min(len(text), cut + pieces.longest - 1) + 1):
        for start, k in pieces.edges(text, end):
            if start < cut:
                found.append((cut - start, end - cut, k))
    return found


def _free(left: str, right: str) -> bool:
    """Whether every path passes the node between two characters."""
    return "\n" in (left, right) or (right == MARK and left != MARK)


@dataclass(frozen=True)
class Chunk:
    """Characters ``begin`` to ``end`` of ``text``, which also shows what lies around the cuts."""

    text: str
    begin: int
    end: int
    first: bool
    last: bool

    def entries(self, pieces: Pieces) -> list[tuple[int, int, int]]:
        return [START] if self.first else states_at(pieces, self.text, self.begin)

    def exits(self, pieces: Pieces) -> list[tuple[int, int, int]]:
        return states_at(pieces, self.text, self.end)

    def passing(self) -> tuple[int, int]:
        """The first and last node that all paths pass, or (-1, -1)."""
        nodes = [k for k in range(self.begin + 1, self.end) if _free(self.text[k - 1], self.text[k])]
        return (nodes[0], nodes[-1]) if nodes else (-1, -1)


def reached(pieces: Pieces, chunk: Chunk, entries: list[tuple[int, int, int]], until: int) -> dict:
    """Forward weights: for each node and last piece, the entries that get there by weight 0.

    Sets of entries are bit masks, the columns of the transfer matrix. Values are
    (mask, start, piece before); ``until`` is the last node wanted, pieces that end up to the
    longest length behind it are followed when they start before it.
    """
    text, at = chunk.text, {}
    for e, (_, behind, k) in enumerate(entries):
        mask, *_ = at.setdefault(chunk.begin + behind, {}).get(k, (0, -1, -1))
        at[chunk.begin + behind][k] = (mask | 1 << e, -1, -1)
    for end in range(chunk.begin + 1, min(len(text), until + pieces.longest - 1) + 1):
        for start, k in pieces.edges(text, end):
            if start < chunk.begin or start >= until or start not in at:
                continue
            for before, (mask, *_) in at[start].items():
                if k == BYTES or before == BYTES or pieces.follows(before, k):
                    old = at.setdefault(end, {}).get(k, (0, start, before))
                    at[end][k] = (old[0] | mask, old[1], old[2])
    return at


def transfer(pieces: Pieces, chunk: Chunk) -> np.ndarray:
    """Weights from each entry to each exit: 0 or minus infinity."""
    entries, exits = chunk.entries(pieces), chunk.exits(pieces)
    low, high = chunk.passing()
    matrix = np.full((len(entries), len(exits)), NEVER)
    if low < 0:
        # One stretch fills the chunk.
        at = reached(pieces, chunk, entries, chunk.end)
        for x, (_, behind, k) in enumerate(exits):
            mask = at.get(chunk.end + behind, {}).get(k, (0,))[0]
            matrix[[e for e in range(len(entries)) if mask >> e & 1], x] = 0
        return matrix
    # Up to the first passing node, then from the last one: between them all is one path.
    to_low = np.full((len(entries), 1), NEVER)
    for mask, *_ in reached(pieces, chunk, entries, low).get(low, {}).values():
        to_low[[e for e in range(len(entries)) if mask >> e & 1], 0] = 0
    tail = Chunk(chunk.text, high, chunk.end, True, chunk.last)
    at = reached(pieces, tail, [START], chunk.end)
    from_high = np.full((1, len(exits)), NEVER)
    for x, (ahead, behind, k) in enumerate(exits):
        if chunk.end - ahead >= high and at.get(chunk.end + behind, {}).get(k, (0,))[0]:
            from_high[0, x] = 0
    return max_plus(to_low, from_high)


def max_plus(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a[:, :, None] + b[None, :, :]).max(axis=1)


def prefixes(matrices: list[np.ndarray]) -> list[np.ndarray]:
    """Products of the first 1, 2, ... matrices, in a logarithmic number of associative rounds."""
    done, step = list(matrices), 1
    while step < len(done):
        done = [max_plus(done[k - step], m) if k >= step else m for k, m in enumerate(done)]
        step *= 2
    return done


def trace(pieces: Pieces, chunk: Chunk, entry: int, exit_: int) -> bytes:
    """Packed ids of the pieces that start inside the chunk, given where it is entered and left."""
    entries, exits = chunk.entries(pieces), chunk.exits(pieces)
    ahead, behind, k = exits[exit_]
    low, high = chunk.passing()
    if low < 0:
        at = reached(pieces, chunk, [entries[entry]], chunk.end)
        return _walk(pieces, chunk.text, at, chunk.end + behind, k)
    at = reached(pieces, chunk, [entries[entry]], low)
    head = _walk(pieces, chunk.text, at, low, next(iter(at[low])))
    tail = Chunk(chunk.text, high, chunk.end, True, chunk.last)
    at = reached(pieces, tail, [START], chunk.end)
    return head + pieces.encode_marked(chunk.text[low:high]) + _walk(pieces, chunk.text, at, chunk.end + behind, k)


def _walk(pieces: Pieces, text: str, at: dict, end: int, k: int) -> bytes:
    path: list[int] = []
    while True:
        _, start, before = at[end][k]
        if start < 0:
            return packed(path[::-1])
        path += pieces._bytes_of(text[start:end]) if k == BYTES else [k]
        end, k = start, before


def _chunks(text: str, longest: int) -> Iterator[Chunk]:
    """Chunks of a marked text, each with the characters that its cuts' pieces can cover."""
    for begin in range(0, len(text), CHUNK_CHARS):
        end = min(len(text), begin + CHUNK_CHARS)
        left, right = max(0, begin - longest), min(len(text), end + longest)
        yield Chunk(text[left:right], begin - left, end - left, begin == 0, end == len(text))


CHUNK = "text string, begin int, past int, first boolean, last boolean"


def _chunk_of(row: dict) -> Chunk:
    return Chunk(row["text"], row["begin"], row["past"], row["first"], row["last"])


def _small_ids(docs: DataFrame, shared, name: str) -> DataFrame:
    """Adds the ids of documents that are one chunk each."""
    schema = docs.select("*", F.lit(None).cast("binary").alias(name)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = shared()
        for batch in batches:
            ids = pieces.encode([t or "" for t in batch.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ids, pa.binary())], [*batch.schema.names, name])

    return docs.mapInArrow(run, schema)


def _giant_ids(giants: DataFrame, shared) -> DataFrame:
    """(row, ids) of giant documents (row, text)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        longest = shared().longest
        for batch in batches:
            for row, text in zip(batch.column("row").to_pylist(), batch.column("text").to_pylist(), strict=True):
                for k, c in enumerate(_chunks(marked(text), longest)):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([row]), pa.array([k], pa.int32()), pa.array([c.text]), pa.array([c.begin], pa.int32()),
                         pa.array([c.end], pa.int32()), pa.array([c.first]), pa.array([c.last])],
                        ["row", "k", "text", "begin", "past", "first", "last"],
                    )

    # The chunks of one document spread over all tasks.
    chunks = settle(giants.mapInArrow(cut, f"row bigint, k int, {CHUNK}").repartition("row", "k"), "chunks")

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = shared()
        for batch in batches:
            found = [transfer(pieces, _chunk_of(r)) for r in batch.to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("k"), pa.array([m.shape[0] for m in found], pa.int32()),
                 pa.array([m.astype("<f4").tobytes() for m in found], pa.binary())],
                ["row", "k", "entries", "matrix"],
            )

    def scan(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("k")
        steps = [np.frombuffer(m, "<f4").reshape(n, -1) for m, n in zip(group["matrix"], group["entries"], strict=True)]
        so_far = prefixes(steps)
        exits = [0] * len(steps)
        exits[-1] = int(np.argmax(so_far[-1][0]))
        # Backwards: the state at a cut is on the best path to the state at the next cut.
        for c in range(len(steps) - 1, 0, -1):
            exits[c - 1] = int(np.argmax(so_far[c - 1][0] + steps[c][:, exits[c]]))
        return pd.DataFrame({"row": group["row"].to_numpy(), "k": group["k"].to_numpy(),
                             "entry": [0, *exits[:-1]], "exit": exits})

    moves = chunks.mapInArrow(matrices, "row bigint, k int, entries int, matrix binary")
    resolved = moves.groupBy("row").applyInPandas(scan, "row bigint, k int, entry int, exit int")

    def back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = shared()
        for batch in batches:
            ids = [trace(pieces, _chunk_of(r), r["entry"], r["exit"]) for r in batch.to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("k"), pa.array(ids, pa.binary())], ["row", "k", "ids"]
            )

    traced = chunks.join(settle(resolved, "states"), ["row", "k"]).mapInArrow(back, "row bigint, k int, ids binary")

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [b"".join(parts) for parts in batch.column("parts").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(ids, pa.binary())], ["row", "ids"])

    # A document's parts meet in one row, as the document itself does.
    whole = traced.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("k", "ids"))).alias("parts"))
    return whole.select("row", F.transform("parts", lambda p: p["ids"]).alias("parts")).mapInArrow(joined, "row bigint, ids binary")


def _is_giant(docs: DataFrame) -> Column:
    # Blanks become marks one for one, and one mark comes in front.
    return F.coalesce(F.length(docs["text"]), F.lit(0)) + 1 > CHUNK_CHARS


def _giants(docs: DataFrame, shared, name: str) -> DataFrame:
    """The giant documents with their ids."""
    row = free_name(docs, "_row")
    giants = settle(docs.filter(_is_giant(docs)).withColumn(row, F.monotonically_increasing_id()), "giants")
    found = _giant_ids(giants.select(F.col(row).alias("row"), "text"), shared)
    found = found.select(F.col("row").alias(row), F.col("ids").alias(name))
    return giants.join(found, row).select(*docs.columns, name)


def _refuse(df: DataFrame, name: str) -> None:
    if name.lower() in {c.lower() for c in df.columns}:
        raise ValueError(f"there is a column {name} already")


def encode(docs: DataFrame, model_file: str, name: str = "ids") -> DataFrame:
    """``docs`` with a column ``name``: the ids of each whole text, without special ids, packed
    as little-endian unsigned 32-bit integers.

    Null and empty texts have no ids. Rows are independent of each other, so repeated rows get
    equal ids; an empty table gives an empty result. All columns pass through; ``name`` must not
    be among them, else ValueError.
    """
    _refuse(docs, name)
    bound_batches(docs.sparkSession)
    shared = share(docs.sparkSession, Pieces.load(model_file))
    return _small_ids(docs.filter(~_is_giant(docs)), shared, name).union(_giants(docs, shared, name))


def decoded(df: DataFrame, model_file: str, ids: str, name: str) -> DataFrame:
    """``df`` with a column ``name``: the text of the packed ids in column ``ids``.

    Null ids give an empty text; a column ``name`` that is there already gives ValueError.
    """
    _refuse(df, name)
    bound_batches(df.sparkSession)
    shared = share(df.sparkSession, Pieces.load(model_file))
    schema = df.select("*", F.lit(None).cast("string").alias(name)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = shared()
        for batch in batches:
            texts = decode_all(pieces, [v or b"" for v in batch.column(ids).to_pylist()])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, name])

    return df.mapInArrow(run, schema)


def encoding_report(docs: DataFrame, model_file: str) -> DataFrame:
    """One row per document: its ids, how many, their checksum, and whether they decode to the text.

    ``ids`` are packed as :func:`encode` packs them: little-endian unsigned 32-bit integers.
    ``ids_crc32`` is the unsigned crc32 of these bytes.
    ``round_trip`` compares with the text, a null one as empty and a mark in it as a blank, as
    the model reads it. Repeated rows get equal reports, an empty table gives none; other columns
    than doc_id and text are not read.
    """
    bound_batches(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    key = docs.schema["doc_id"].dataType.simpleString()
    shared = share(docs.sparkSession, Pieces.load(model_file))

    def report(batch: pa.RecordBatch, texts: list[str], ids: list[bytes]) -> pa.RecordBatch:
        same = []
        for a in range(0, len(ids), DECODE_ROWS):
            back = decode_all(shared(), ids[a:a + DECODE_ROWS])
            same += [x == t.replace(MARK, " ") for x, t in zip(back, texts[a:a + DECODE_ROWS], strict=True)]
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array([len(v) // 4 for v in ids], pa.int64()),
             pa.array(map(zlib.crc32, ids), pa.int64()), pa.array(same, pa.bool_()), pa.array(ids, pa.binary())],
            ["doc_id", "n_tokens", "ids_crc32", "round_trip", "ids"],
        )

    # Documents of one chunk are encoded, decoded and summed up in one pass.
    def small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            yield report(batch, texts, shared().encode(texts))

    def giant(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            yield report(batch, texts, batch.column("ids").to_pylist())

    schema = f"doc_id {key}, n_tokens bigint, ids_crc32 bigint, round_trip boolean, ids binary"
    giants = _giants(docs, shared, "ids").mapInArrow(giant, schema)
    return docs.filter(~_is_giant(docs)).mapInArrow(small, schema).union(giants)
