"""Token-id output: raw id payloads in shards, found by a minimal perfect hash index.

Below one folder there are two tables. ``shards`` holds, in ascending doc_id order, blocks of
raw little-endian ids (16 bits wide when the vocabulary allows it, else 32) with the doc_ids and
lengths of the documents in them. ``index`` holds parts of a minimal perfect hash over the
doc_ids: a key's hash names its part, a bucket's pilot there names its slot, and the slot stores
a fingerprint of the key, the shard, the offset and the length. A lookup therefore reads one
part and one slot, whatever the number of documents.
"""

from __future__ import annotations

import json
import math
import os
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rowproof.llm.text import bound_batches, share, utf8
from rowproof.session import settle

END_ID = 2

#: Bytes of payload after which a shard is closed; one longer document fills a shard of its own.
SHARD_BYTES = 8 * 1024 * 1024

#: Keys in one part of the index, about.
PART_KEYS = 4096

#: Words in each of two generations whose ids a worker remembers.
CACHE_WORDS = 600_000

#: Punctuation that may close a word.
CLOSING = b".,!?;:"

#: Words of letters that are encoded as one text.
JOINED_WORDS = 200

#: Bytes of texts that are split at once.
SPLIT_BYTES = 4_000_000


@dataclass
class WordEncoder:
    """Encodes blank-separated words; a tokenizer that drops blanks encodes each on its own.

    The memory of words lives with the broadcast copy, so that a worker keeps it from one task
    to the next.
    """

    definition: str
    width: str
    ends: np.ndarray  # whether an id closes a word
    memory: dict[bytes, bytes] = field(default_factory=dict)
    older: dict[bytes, bytes] = field(default_factory=dict)
    tokenizer: object = None

    def _ready(self) -> None:
        if self.tokenizer is None:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer

            self.tokenizer = Tokenizer.from_str(self.definition)

    def _library(self, words: list[bytes]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast([w.decode("utf-8", "replace") for w in words], add_special_tokens=False)
        return [np.array(e.ids, self.width).tobytes() for e in found]

    def _joined(self, words: list[bytes]) -> list[bytes]:
        """Ids of words that are letters alone, many in one text: an id that closes a word ends
        each. Should a text hold more words than went in, its words are encoded one by one."""
        found: list[bytes] = []
        groups = [words[k:k + JOINED_WORDS] for k in range(0, len(words), JOINED_WORDS)]
        texts = [b" ".join(group).decode("utf-8", "replace") for group in groups]
        wide = np.dtype(self.width).itemsize
        for group, encoded in zip(groups, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False), strict=True):
            ids = np.array(encoded.ids, self.width)
            until = (np.flatnonzero(self.ends[ids]) + 1) * wide
            if len(until) != len(group) or until[-1] != len(ids) * wide:
                found += self._library(group)
                continue
            packed = ids.tobytes()
            found += [packed[a:b] for a, b in zip([0, *until[:-1].tolist()], until.tolist(), strict=True)]
        return found

    def _learn(self, words: set[bytes]) -> None:
        """Only words whose stem without closing punctuation is new are encoded, ASCII ones in
        lower case. The tokenizer splits letters from what follows them."""
        memory, older, plain = self.memory, self.older, []
        bare, closed = {}, {}  # stems of words, and of words with closing punctuation
        for word in words:
            stem = word.rstrip(CLOSING)
            if stem.isalpha():  # ASCII letters alone
                low = stem.lower()
            elif not stem.isascii() and (text := stem.decode("utf-8", "replace")).isalpha() and text.lower().isalpha():
                low = stem
            else:
                plain.append(word)
                continue
            if len(stem) == len(word):
                bare[word] = low
            else:
                closed[word] = low, word[len(stem):]
        new = []
        for stem in {*bare.values(), *(low for low, _ in closed.values())}:
            if stem not in memory:
                if (ids := older.get(stem)) is not None:
                    memory[stem] = ids
                else:
                    new.append(stem)
        memory.update(zip(new, self._joined(new), strict=True))
        memory.update(zip(plain, self._library(plain), strict=True))
        tails = list({tail for _, tail in closed.values()})
        ends = dict(zip(tails, self._library(tails), strict=True))
        get = memory.__getitem__
        memory.update(zip(bare, map(get, bare.values()), strict=True))
        memory.update({word: memory[stem] + ends[tail] for word, (stem, tail) in closed.items()})

    def _remember(self, words: set[bytes]) -> None:
        """Make all ``words`` known. A full memory becomes the older generation, from which words
        that are met again come back, so that frequent ones stay."""
        if len(self.memory) > CACHE_WORDS:
            self.memory, self.older = {}, self.memory
        missing = words.difference(self.memory)
        known = missing.intersection(self.older)
        self.memory.update(zip(known, map(self.older.__getitem__, known), strict=True))
        if len(missing) > len(known):
            self._learn(missing - known)

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Payload of each text, without an end."""
        self._ready()
        encoded, first, size = [], 0, 0
        for k, text in enumerate(texts):
            size += len(text)
            if size >= SPLIT_BYTES or k + 1 == len(texts):
                split = [t.split() for t in texts[first:k + 1]]
                self._remember(set().union(*split))
                get = self.memory.__getitem__
                encoded += [b"".join(map(get, words)) for words in split]
                first, size = k + 1, 0
        return encoded


def load_encoder(tokenizer_file: str) -> WordEncoder:
    """Raises ValueError for a tokenizer that does not lower-case and split at blanks, or does not
    mark the ends of words: words could not be encoded on their own."""
    from tokenizers import Tokenizer

    definition = Path(tokenizer_file).read_text(encoding="utf-8")
    tokenizer = Tokenizer.from_str(definition)
    vocab = tokenizer.get_vocab(with_added_tokens=True)
    mark = json.loads(definition)["model"].get("end_of_word_suffix")
    ids = lambda text: tokenizer.encode(text, add_special_tokens=False).ids
    if not mark or ids("Ab  cD.\nx") != ids("ab") + ids("cd") + ids(".") + ids("x"):
        raise ValueError("the tokenizer must lower-case, drop blanks and mark the ends of words")
    ends = np.zeros(max(vocab.values()) + 1, bool)
    ends[[k for token, k in vocab.items() if token.endswith(mark)]] = True
    return WordEncoder(definition, "<u2" if max(*vocab.values(), END_ID) < 1 << 16 else "<u4", ends)


def _shard_writer(shared):
    """Encodes sorted documents and closes a shard whenever enough payload has gathered."""
    kind = pa.schema([
        ("task", pa.int32()), ("shard", pa.int64()), ("start_in_task", pa.int64()), ("n_ids", pa.int64()),
        ("payload", pa.binary()), ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared()
        wide = np.dtype(encoder.width).itemsize
        end = np.array([END_ID], encoder.width).tobytes()
        task, number, written = TaskContext.get().partitionId(), 0, 0
        held, ids, lengths, size = [], [], [], 0

        def closed() -> pa.RecordBatch:
            row = {
                "task": [task], "shard": [(task << 32) + number], "start_in_task": [written],
                "n_ids": [size // wide], "payload": [b"".join(held)], "doc_ids": [ids], "lengths": [lengths],
            }
            return pa.RecordBatch.from_pydict(row, kind)

        for batch in batches:
            keys = batch.column("doc_id").to_pylist()
            for key, body in zip(keys, encoder.encode(utf8(batch.column("text"))), strict=True):
                if held and size + len(body) > SHARD_BYTES:
                    yield closed()
                    number, written = number + 1, written + size // wide
                    held, ids, lengths, size = [], [], [], 0
                held += [body, end]
                ids.append(key)
                lengths.append(len(body) // wide + 1)
                size += len(body) + wide
        if held:
            yield closed()

    return run


def _mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """64-bit hashes of integer keys."""
    h = keys.astype(np.int64).view(np.uint64) + np.uint64((seed + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class PerfectHash:
    """A minimal perfect hash by hash and displace: one pilot for each bucket of keys.

    A bucket of one key stores its slot outright, as a negative pilot.
    """

    def __init__(self, pilots: np.ndarray, n: int):
        self.pilots, self.n = pilots, n

    @staticmethod
    def build(keys: np.ndarray) -> PerfectHash:
        """For distinct keys."""
        n = len(keys)
        m = max(1, n // 4)
        bucket, place = (_mix(keys, 0) % np.uint64(m)).astype(np.int64), _mix(keys, 1)
        order = np.argsort(bucket, kind="stable")
        bounds = np.searchsorted(bucket[order], np.arange(m + 1))
        pilots, taken = np.zeros(m, np.int64), np.zeros(n, bool)
        tries = _mix(np.arange(256), 2)
        for b in np.argsort(-np.diff(bounds), kind="stable").tolist():
            own = place[order[bounds[b]:bounds[b + 1]]]
            if len(own) <= 1:
                break
            first = 0
            while True:
                slots = _slots(own[None, :], tries[:, None], n)
                good = ~taken[slots].any(axis=1)
                ordered = np.sort(slots, axis=1)
                good &= (ordered[:, 1:] != ordered[:, :-1]).all(axis=1)
                if good.any():
                    k = int(np.argmax(good))
                    pilots[b] = first + k
                    taken[slots[k]] = True
                    break
                first += 256
                tries = _mix(np.arange(first, first + 256), 2)
            if first:
                tries = _mix(np.arange(256), 2)
        free = iter(np.flatnonzero(~taken).tolist())
        for b in np.flatnonzero(np.diff(bounds) == 1).tolist():
            pilots[b] = -1 - next(free)
        return PerfectHash(pilots, n)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        if not self.n:
            return np.zeros(len(keys), np.int64)
        pilots = self.pilots[(_mix(keys, 0) % np.uint64(len(self.pilots))).astype(np.int64)]
        found = _slots(_mix(keys, 1), _mix(np.maximum(pilots, 0), 2), self.n)
        return np.where(pilots < 0, -1 - pilots, found)


def _slots(place: np.ndarray, pilot: np.ndarray, n: int) -> np.ndarray:
    mixed = (place ^ pilot) * np.uint64(0xD6E8FEB86659FD93)
    return ((mixed ^ (mixed >> np.uint64(32))) % np.uint64(n)).astype(np.int64)


def _fingerprints(keys: np.ndarray) -> np.ndarray:
    return (_mix(keys, 3) >> np.uint64(32)).astype(np.uint32)


INDEX = "part int, parts int, n bigint, pilots binary, fingerprints binary, shards binary, offsets binary, lengths binary, copies binary"


def _index_part(group: pd.DataFrame) -> pd.DataFrame:
    keys = group["doc_id"].to_numpy(np.int64)
    hashed = PerfectHash.build(keys)
    at = np.argsort(hashed.slots(keys))
    columns = {name: group[name].to_numpy(np.int64)[at].tobytes() for name in ("shards", "offsets", "lengths", "copies")}
    return pd.DataFrame([{
        "part": group["part"].iloc[0], "parts": group["parts"].iloc[0], "n": len(keys), "pilots": hashed.pilots.tobytes(),
        "fingerprints": _fingerprints(keys)[at].tobytes(), **columns,
    }])


@dataclass(frozen=True)
class TokenFiles:
    """The tables below ``path``."""

    spark: SparkSession
    path: str
    width: str

    def shards(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/shards")

    def index(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/index")

    def entries(self) -> DataFrame:
        """(doc_id, shard, offset, n_tokens) of every document; the payload is not read."""
        return _directory(self.shards().select("shard", "doc_ids", "lengths"))

    def starts(self) -> DataFrame:
        """(shard, start): the number of ids before each shard; one window row per write task."""
        shards = self.shards().select("task", "shard", "start_in_task", "n_ids")
        tasks = shards.groupBy("task").agg(F.sum("n_ids").alias("n"))
        before = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
        bases = settle(tasks.select("task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")), "bases")
        return shards.join(bases, "task").select("shard", (F.col("base") + F.col("start_in_task")).alias("start"))

    def lookup(self, keys: DataFrame) -> DataFrame:
        """(doc_id, shard, offset, n_tokens, copies) for the keys that the index holds.

        ``copies`` counts the documents of that doc_id; the place is that of the first one.
        """
        parts = self.index().agg(F.max("parts")).first()[0]
        asked = keys.select(F.col("doc_id").cast("long").alias("doc_id")).filter("doc_id IS NOT NULL").distinct()
        if not parts:
            return asked.select("doc_id", *[F.lit(0).cast("long").alias(c) for c in ("shard", "offset", "n_tokens", "copies")]).filter(F.lit(False))
        asked = asked.withColumn("part", _part(parts))

        def find(group: pd.DataFrame, part: pd.DataFrame) -> pd.DataFrame:
            names = ["doc_id", "shard", "offset", "n_tokens", "copies"]
            if not len(part) or not len(group):
                return pd.DataFrame({name: pd.Series(dtype="int64") for name in names})
            row, wanted = part.iloc[0], group["doc_id"].to_numpy(np.int64)
            slots = PerfectHash(np.frombuffer(row["pilots"], np.int64), int(row["n"])).slots(wanted)
            known = np.frombuffer(row["fingerprints"], np.uint32)[slots] == _fingerprints(wanted)
            stored = [np.frombuffer(row[c], np.int64)[slots][known] for c in ("shards", "offsets", "lengths", "copies")]
            return pd.DataFrame(dict(zip(names, [wanted[known], *stored], strict=True)))

        found = asked.groupBy("part").cogroup(self.index().groupBy("part"))
        return found.applyInPandas(find, "doc_id bigint, shard bigint, offset bigint, n_tokens bigint, copies bigint")

    def checksums(self) -> DataFrame:
        """(shard, offset, ids_crc32) of every document, read from the payloads."""
        width = self.width

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for shard, payload, lengths in zip(*(batch.column(c) for c in ("shard", "payload", "lengths")), strict=True):
                    ids = np.frombuffer(payload.as_buffer(), width).astype("<u4")
                    n = lengths.values.to_numpy()
                    at = np.cumsum(n) - n
                    sums = [zlib.crc32(ids[a:b]) for a, b in zip(at.tolist(), (at + n).tolist(), strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(n), shard.as_py(), np.int64)), pa.array(at), pa.array(sums, pa.int64())],
                        ["shard", "offset", "ids_crc32"],
                    )

        return self.shards().select("shard", "payload", "lengths").mapInArrow(run, "shard bigint, offset bigint, ids_crc32 bigint")

    def read(self, keys: DataFrame) -> DataFrame:
        """(doc_id, ids) of the first document of each key that the index holds."""
        width = self.width
        places = self.lookup(keys)

        def fetch(group: pd.DataFrame, shard: pd.DataFrame) -> pd.DataFrame:
            if not len(shard) or not len(group):
                return pd.DataFrame({"doc_id": pd.Series(dtype="int64"), "ids": pd.Series(dtype=object)})
            ids = np.frombuffer(shard["payload"].iloc[0], width).astype(np.int64)
            found = [ids[o:o + n] for o, n in zip(group["offset"], group["n_tokens"], strict=True)]
            return pd.DataFrame({"doc_id": group["doc_id"], "ids": found})

        payloads = self.shards().select("shard", "payload")
        return places.groupBy("shard").cogroup(payloads.groupBy("shard")).applyInPandas(fetch, "doc_id bigint, ids array<bigint>")


def _part(parts: int):
    return F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(parts)).cast("int")


def _directory(shards: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, ids, lengths in zip(*(batch.column(c) for c in ("shard", "doc_ids", "lengths")), strict=True):
                n = lengths.values.to_numpy()
                yield pa.RecordBatch.from_arrays(
                    [ids.values, pa.array(np.full(len(n), shard.as_py(), np.int64)), pa.array(np.cumsum(n) - n), pa.array(n)],
                    ["doc_id", "shard", "offset", "n_tokens"],
                )

    return shards.mapInArrow(run, "doc_id bigint, shard bigint, offset bigint, n_tokens bigint")


def write_token_files(docs: DataFrame, path: str, tokenizer_file: str) -> TokenFiles:
    """Encode every whole text, end it with id 2, and write shards and index below ``path``.

    Null texts count as empty and still get their end id. Documents follow each other by
    doc_id, a null one first; rows that share a doc_id lie side by side, by the hash of their
    text, and the index leads to the first of them. An empty table gives empty files. Other
    columns are not read. All files are written by Spark, so a task that is repeated replaces
    what it wrote.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    encoder = load_encoder(tokenizer_file)
    shared = share(spark, encoder)

    # The row number spreads copies of one row over tasks. Texts are moved and encoded in their
    # new places: packed ids take as much room in a shuffle as compressed texts do.
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn(
        "_h", F.xxhash64("text")).withColumn("_row", F.monotonically_increasing_id())
    ordered = rows.repartitionByRange("doc_id", "_h", "_row").sortWithinPartitions("doc_id", "_h", "_row")
    shards = ordered.select("doc_id", "text").mapInArrow(
        _shard_writer(shared),
        "task int, shard bigint, start_in_task bigint, n_ids bigint, payload binary, doc_ids array<bigint>, lengths array<bigint>",
    )
    shards.write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/shards")
    files = TokenFiles(spark, path, encoder.width)
    keyed = files.entries().filter("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.min(F.struct("shard", "offset", "n_tokens")).alias("first"), F.count(F.lit(1)).alias("copies")
    )
    keyed = settle(keyed.select("doc_id", "first.*", "copies"), "keys")
    parts = max(1, math.ceil(keyed.count() / PART_KEYS))
    split = keyed.select(
        _part(parts).alias("part"), F.lit(parts).alias("parts"), "doc_id", F.col("shard").alias("shards"),
        F.col("offset").alias("offsets"), F.col("n_tokens").alias("lengths"), "copies",
    )
    built = split.groupBy("part").applyInPandas(_index_part, INDEX)
    built.write.mode("overwrite").parquet(f"{path}/index")
    return files


def file_report(docs: DataFrame, files: TokenFiles) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, read back from the files.

    Each doc_id of ``docs`` is looked up in the index; documents without a doc_id, and further
    ones of the same doc_id, are found by the directory of the shards.
    """
    found = settle(files.lookup(docs.select("doc_id")), "places")
    places = found.select("doc_id", "shard", "offset", "n_tokens")
    entries = files.entries()
    nameless = entries.filter("doc_id IS NULL")
    several = found.filter("copies > 1").select("doc_id", F.col("shard").alias("_s"), F.col("offset").alias("_o"))
    further = entries.join(several, "doc_id").filter("NOT (shard = _s AND offset = _o)")
    places = places.union(nameless).union(further.select(places.columns))
    return places.join(files.checksums(), ["shard", "offset"]).join(files.starts(), "shard").select(
        "doc_id", (F.col("start") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32"
    )
