"""Dimension loads that neither read the whole dimension nor wait for each other.

New members are found through the dimension's key store, which opens the slices that may hold
them. Ids come from leased blocks, so two loads at once draw different ids. Members, keys and
filters are one commit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rowproof.functions.columns import named
from rowproof.operators.copies import one_per_key
from rowproof.operators.identity import assign_ids
from rowproof.operators.keystore import KeyStore
from rowproof.operators.novelty import has_null
from rowproof.plans.warehouse import Dimension
from rowproof.session import scratch_scope, settle_measured
from rowproof.sources.committed import LEASE_BLOCK, CommittedStore


def key_store(store: CommittedStore, dim: Dimension, slices: int = 64, blocks: int = 64) -> KeyStore:
    """The key store of a dimension; its shape must stay the same from load to load."""
    keys = StructType([dim.schema[name] for name in dim.natural_key])
    return KeyStore(store, f"{dim.table}_keys", keys, slices, blocks)


def load_dim_sliced(
    spark: SparkSession, store: CommittedStore, dim: Dimension, incoming: DataFrame, slices: int = 64, blocks: int = 64,
    lease_block: int = LEASE_BLOCK,
) -> tuple[int, int]:
    """Append the members whose natural key is new; returns how many, and how many rows had a
    key part that is null or cannot be read and were left out.

    Each new key is loaded once. Two loads at the same time may both find a key new; the one
    that publishes second then finds that the store has grown, and starts over.
    """
    types = {f.name: f.dataType for f in dim.schema}
    rows = incoming.select(*[named(c).try_cast(types[c]).alias(c) for c in dim.columns])
    with scratch_scope(spark):
        rows, measured = settle_measured(rows, "members", unkeyed=F.count_if(has_null(dim.natural_key)))
        keyed = one_per_key(rows.dropna(subset=list(dim.natural_key)), dim.natural_key)
        known = key_store(store, dim, slices, blocks)
        while True:
            seen = store.state(spark).number
            new = known.new_keys(keyed)
            same = [keyed[n].eqNullSafe(new[n]) for n in dim.natural_key]
            fresh = keyed.join(new, same, "left_semi")
            numbered, made = settle_measured(assign_ids(fresh, "_row", dim.natural_key), "new-members")
            if not made["rows"]:
                return 0, measured["unkeyed"]
            ids = store.lease(spark, f"{dim.table}.{dim.id_column}", made["rows"], lease_block)
            stored = numbered.withColumn("_row", F.col("_row") - 1)
            with store.commit(spark, after=seen) as commit:
                store.append(stored.select(ids.alias(dim.id_column), *[named(c) for c in dim.columns]), dim.table)
                known.add(new)
            if commit.published:
                return made["rows"], measured["unkeyed"]
