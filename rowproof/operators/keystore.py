"""Known keys in hash slices, each with a Bloom filter beside it.

Whether a key is new is asked again and again, of a table that only grows. Here its keys lie in
slices by their hash. A batch first meets the filters, which are small: keys whose bits are not
all set are new and meet nothing else. Only slices that may hold a key of the batch are opened,
for an exact anti join that removes the filters' false hits.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from rowproof.functions.columns import named, named_all
from rowproof.operators.novelty import new_rows
from rowproof.schemas import schema_of
from rowproof.session import settle
from rowproof.sources.committed import CommittedStore
from rowproof.sources.tables import Slices

SLICE = "key_slice"

#: Bits of a filter's block, set for each key.
BLOCK_BITS, PROBES = 512, 6

_FILTER = "slice int, block int, " + ", ".join(f"w{k} bigint" for k in range(BLOCK_BITS // 64))


def _hash(keys: Sequence[str], seed: int) -> Column:
    """A hash in which null parts count, and neighbouring parts do not run together."""
    parts = [x for k in keys for x in (named(k), named(k).isNull())]
    return F.xxhash64(*parts, F.lit(seed))


def _places(keys: Sequence[str]) -> list[Column]:
    first, step = _hash(keys, 2), _hash(keys, 3).bitwiseOR(F.lit(1))
    return [F.pmod(F.shiftrightunsigned(first, 9) + k * F.shiftrightunsigned(step, 9), F.lit(BLOCK_BITS)).cast("int") for k in range(PROBES)]


def _word(place: Column, w: int) -> Column:
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(place, F.lit(64)))
    return F.when(F.floor(place / 64) == w, bit).otherwise(F.lit(0).cast("long"))


@dataclass(frozen=True)
class KeyStore:
    """Keys of ``table`` in a store, by ``slices`` hash slices.

    ``blocks`` of 512 bits make up a slice's filter: 32 keys a block keep false hits near one
    in a hundred. More keys than that cost time, never results.
    """

    store: CommittedStore
    table: str
    keys: StructType
    slices: int = 64
    blocks: int = 64

    @property
    def names(self) -> list[str]:
        return self.keys.names

    def _slice(self) -> Column:
        return F.pmod(_hash(self.names, 0), F.lit(self.slices)).cast("int")

    def _block(self) -> Column:
        return F.pmod(_hash(self.names, 1), F.lit(self.blocks)).cast("int")

    def filters(self, spark: SparkSession) -> DataFrame:
        """One row per block of a slice: the filters of all commits, merged by bitwise or."""
        stored = self.store.read(spark, f"{self.table}_filters", _filter_schema())
        words = [F.bit_or(c).alias(c) for c in stored.columns[2:]]
        return stored.groupBy("slice", "block").agg(*words)

    def possible(self, batch: DataFrame) -> DataFrame:
        """Rows of ``batch`` whose key may be stored, with the slice that would hold it.

        The filters are settled first, so the planner broadcasts them when they are small."""
        spark = batch.sparkSession
        filters = settle(self.filters(spark).withColumnsRenamed({"slice": "_fs", "block": "_fb"}), "filters")
        asked = batch.withColumns({SLICE: self._slice(), "_b": self._block()})
        met = asked.join(filters, (F.col(SLICE) == F.col("_fs")) & (F.col("_b") == F.col("_fb")))
        held = F.lit(True)
        for place in _places(self.names):
            words = [F.col(f"w{w}").bitwiseAND(_word(place, w)) for w in range(BLOCK_BITS // 64)]
            found = words[0]
            for word in words[1:]:
                found = found.bitwiseOR(word)
            held &= found != 0
        return met.filter(held).select(*named_all(batch.columns), SLICE)

    def open(self, spark: SparkSession, slices: Sequence[int]) -> DataFrame:
        """The keys of some slices; the others are not read."""
        wanted = Slices(SLICE, self._slice(), list(slices))
        return self.store.read(spark, self.table, self.keys, slices=wanted) if slices else _none(spark, self.keys)

    def new_keys(self, batch: DataFrame) -> DataFrame:
        """Distinct keys of ``batch`` that are not stored; null parts are equal. Written once."""
        spark = batch.sparkSession
        asked = settle(batch.select(*named_all(self.names)).distinct(), "asked")
        maybe = settle(self.possible(asked), "possible")
        # At most one number for each slice.
        slices = sorted(r[0] for r in maybe.select(SLICE).distinct().toLocalIterator())
        if not slices:
            return asked
        stored = new_rows(maybe.drop(SLICE), self.open(spark, slices), self.names)
        known = new_rows(maybe.drop(SLICE), stored, self.names)
        return settle(new_rows(asked, known, self.names), "new-keys")

    def add(self, new: DataFrame) -> None:
        """Store keys that :meth:`new_keys` gave, and their filters, in the open commit."""
        slices = Slices(SLICE, self._slice())
        self.store.append(new.select(*named_all(self.names)), self.table, slices)
        places = _places(self.names)
        merged = []
        for w in range(BLOCK_BITS // 64):
            own = _word(places[0], w)
            for place in places[1:]:
                own = own.bitwiseOR(_word(place, w))
            merged.append(F.bit_or(own).alias(f"w{w}"))
        filters = new.groupBy(self._slice().alias("slice"), self._block().alias("block")).agg(*merged)
        self.store.append(filters, f"{self.table}_filters")

    def compact(self, spark: SparkSession, most_files: int = 8) -> int:
        """Bring the keys of slices with many files together."""
        return self.store.compact(spark, self.table, self.keys, Slices(SLICE, self._slice()), most_files)


def _filter_schema() -> StructType:
    kinds = schema_of("a int, b bigint")
    return StructType([StructField(n, kinds["a" if t == "int" else "b"].dataType) for n, t in (c.split() for c in _FILTER.split(", "))])


def _none(spark: SparkSession, schema: StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


DIGEST = schema_of("digest string")


def row_digest(names: Sequence[str]) -> Column:
    """A digest of some columns in which null and empty text differ."""
    return F.sha2(F.to_json(F.struct(*[named(n).cast("string").alias(f"c{k}") for k, n in enumerate(names)]), {"ignoreNullFields": "false"}), 256)


def split_repeats(seen: KeyStore, rows: DataFrame, names: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows met for the first time, repeats), over all batches that used the same ``seen``.

    ``seen`` has DIGEST as its key. Of equal rows in one batch the first by the other columns is
    met for the first time. The digests are added to the open commit, so a batch that is
    repeated after a failure is judged as if it were new.
    """
    columns = rows.columns
    order = F.struct(*named_all(c for c in columns if c not in names), F.monotonically_increasing_id().alias("_n"))
    numbered = settle(rows.withColumns({"digest": row_digest(names), "_order": order}), "numbered")
    new = seen.new_keys(numbered)
    firsts = numbered.groupBy("digest").agg(F.min("_order").alias("_least"))
    fresh = firsts.join(new, "digest").withColumnRenamed("digest", "_digest")
    marked = numbered.join(fresh, (F.col("digest") == F.col("_digest")) & (F.col("_order") == F.col("_least")), "left")
    marked = settle(marked.select(*named_all(columns), F.col("_digest").isNotNull().alias("_first")), "marked")
    seen.add(new)
    return marked.filter("_first").select(*named_all(columns)), marked.filter("NOT _first").select(*named_all(columns))
