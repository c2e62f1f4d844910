"""Sharding by balanced label propagation.

Documents are linked when their texts are equal; a shard is a label. Each round, every group of
linked documents looks at the labels of its members and moves those outside towards the shard
where most of it is, as far as that shard's quota has room. Documents of one group with one
label always move alike, so the state is (group, shard, members), of which a hot group has at
most one row per shard. Documents without links fill what room is left. At last all documents
are laid out by label and the line is cut into shards whose counts differ by one at most; the
cuts part no more groups than there are shards.

All of it is joins, aggregations and one range sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowproof.session import settle, settle_measured

#: Rounds of label propagation at most; it ends earlier when no document moves.
ROUNDS = 12

#: By how much a shard may exceed its even share while labels move; the layout evens it out.
SLACK = 0.5

#: Share of the capacity that must be free for a shard to be moved to.
OPEN = 0.05

#: Members that leave even a full shard for one that holds more of their group.
FEW = 3

_ROW_BITS = 33  # of monotonically_increasing_id: above is the task, below the row


def _unit(*parts) -> Column:
    """A number in [0, 1) that depends on the parts alone."""
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 30)) / float(1 << 30)


def _loads(state: DataFrame) -> DataFrame:
    return state.groupBy("shard").agg(F.sum("n").alias("load"))


def _moved(state: DataFrame, capacity: float, step: int) -> DataFrame:
    """The state after one round, with ``moved`` members per row that came in."""
    loads = settle(_loads(state), "loads")  # one row per shard
    placed = state.join(loads, "shard").withColumn("room", F.greatest(F.lit(capacity) - F.col("load"), F.lit(0.0)))
    # The target is where most members are that can still grow; ties go to the lowest shard. A
    # shard that is all but full is none, or rounds would pass with a handful of moves.
    open_from = max(1.0, OPEN * capacity)
    best = placed.groupBy("group").agg(
        F.max(F.when(F.col("room") >= open_from, F.struct("n", (-F.col("shard")).alias("s")))).alias("best")
    ).select("group", (-F.col("best.s")).alias("target"), F.col("best.n").alias("there"))
    # Where a large part of a group has filled a shard it stays, so that it need not fit in one.
    wishes = placed.join(best.filter("target IS NOT NULL"), "group").filter(
        (F.col("shard") != F.col("target")) & ((F.col("room") >= open_from) | (2 * F.col("n") <= F.col("there")) | (F.col("n") <= FEW))
    ).select("group", "shard", "n", "target")
    demand = wishes.groupBy("target").agg(F.sum("n").alias("demand"))
    quotas = settle(
        demand.join(loads.withColumnRenamed("shard", "target"), "target", "left").select(
            "target",
            F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.lit(capacity) - F.coalesce("load", F.lit(0))) / F.col("demand")).alias("share"),
        ),
        "quotas",
    )
    # The share of a row that moves is rounded at random, so that small rows move too.
    takes = wishes.join(quotas, "target").withColumn(
        "moved", F.floor(F.col("n") * F.col("share") + _unit("group", "shard", F.lit(step))).cast("long")
    ).withColumn("moved", F.least("moved", "n")).filter("moved > 0")
    out = takes.select("group", "shard", (-F.col("moved")).alias("n"), F.lit(0).cast("long").alias("came"))
    come = takes.select("group", F.col("target").alias("shard"), F.col("moved").alias("n"), F.col("moved").alias("came"))
    kept = state.select("group", "shard", "n", F.lit(0).cast("long").alias("came"))
    summed = kept.union(out).union(come).groupBy("group", "shard").agg(F.sum("n").alias("n"), F.sum("came").alias("came"))
    return summed.filter("n > 0")


def propagate(members: DataFrame, capacity: float, rounds: int = ROUNDS) -> DataFrame:
    """(group, shard, n): where the members of each group (group, shard, n) come to lie."""
    state = settle(members.select("group", "shard", "n"), "labels")
    for step in range(rounds):
        after, seen = settle_measured(_moved(state, capacity, step), "labels", came=F.sum("came"))
        state = after.select("group", "shard", "n")
        if not seen["came"]:
            break
    return state


def assign_shards(docs: DataFrame, shards: int, rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) for every row of ``docs``.

    ``size`` is the text's UTF-8 bytes plus 8, ``slot`` counts from 0 in each shard without a
    gap, and the row counts of any two shards differ by one at most. Null texts have size 8, the
    checksum of no bytes, and no links; empty texts equal each other. Repeated rows are rows of
    their own. An empty table gives an empty result; other columns are not read.
    """
    body = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    light, seen = settle_measured(
        docs.select(
            "doc_id",
            (F.length(body) + 8).cast("long").alias("size"),
            F.crc32(body).alias("text_crc32"),
            F.unhex(F.md5(F.col("text").cast("binary"))).alias("group"),
            F.pmod(F.xxhash64("doc_id", F.lit("shard")), F.lit(shards)).cast("int").alias("shard"),
        ),
        "light",
    )
    rows = seen["rows"]
    capacity = rows / shards
    counted = light.filter("group IS NOT NULL").groupBy("group", "shard").agg(F.count(F.lit(1)).alias("n"))
    whole = counted.groupBy("group").agg(F.sum("n").alias("all"))
    linked = counted.join(whole.filter("all > 1").select("group"), "group")
    state = propagate(linked, (1 + SLACK) * capacity, rounds)

    # Each group's members are dealt to its shards in these shares, by the hash of the doc_id.
    spread = state.groupBy("group").agg(
        F.array_sort(F.collect_list(F.struct("shard", "n"))).alias("parts"), F.sum("n").alias("all")
    )
    # Documents without links are dealt to the room that the linked ones leave.
    loads = {r["shard"]: r["load"] for r in _loads(state).collect()}  # one number per shard
    rooms = [(k, max(0.0, capacity - loads.get(k, 0))) for k in range(shards)]
    free = F.array(*[F.struct(F.lit(k).alias("shard"), F.lit(n).alias("n")) for k, n in rooms])

    def dealt(parts: Column, total: Column) -> Column:
        """The shard in whose share the document's hash falls."""
        at = _unit("doc_id", F.lit("deal")) * total
        walk = F.aggregate(
            parts,
            F.struct(F.lit(0.0).alias("sum"), F.lit(-1).alias("shard")),
            lambda s, p: F.struct(
                (s["sum"] + p["n"].cast("double")).alias("sum"),
                F.when(s["shard"] >= 0, s["shard"]).when(at < s["sum"] + p["n"].cast("double"), p["shard"])
                .otherwise(F.lit(-1)).alias("shard"),
            ),
        )["shard"]
        return F.when(walk >= 0, walk).otherwise(F.element_at(parts, -1)["shard"])

    # Groups of a single document have no row in ``spread``.
    labelled = light.join(spread, "group", "left").select(
        "doc_id", "size", "text_crc32", "group",
        F.when(F.col("parts").isNotNull(), dealt(F.col("parts"), F.col("all")))
        .otherwise(dealt(free, F.lit(sum(n for _, n in rooms)))).alias("label"),
    )
    return _laid_out(settle(labelled, "labelled"), rows, shards)


def _laid_out(labelled: DataFrame, rows: int, shards: int) -> DataFrame:
    """Ranks all rows by label and group and cuts the ranks into even shards."""
    own = F.monotonically_increasing_id()
    ordered = labelled.withColumn("_own", own).repartitionByRange("label", "group", "doc_id", "_own")
    ordered = ordered.sortWithinPartitions("label", "group", "doc_id", "_own")
    sliced = settle(
        ordered.select("doc_id", "size", "text_crc32", F.monotonically_increasing_id().alias("_at")), "sliced"
    ).withColumn("_slice", F.shiftright("_at", _ROW_BITS))
    sizes = sliced.groupBy("_slice").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)  # one row per sort task
    offsets = settle(
        sizes.select("_slice", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset")), "offsets"
    )
    rank = F.col("_offset") + F.col("_at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    ranked = sliced.join(offsets, "_slice").withColumn("_rank", rank)
    # Shard s holds the ranks r with s = r * shards div rows; its first is rows * s / shards, rounded up.
    exact = F.expr(f"CAST(_rank * {shards}L DIV {max(1, rows)}L AS INT)")
    first = F.expr(f"(shard * CAST({rows} AS BIGINT) + {shards - 1}L) DIV {shards}L")
    return ranked.withColumn("shard", exact).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("_rank") - first).cast("long").alias("slot")
    )


def links_cut(assigned: DataFrame) -> float:
    """Of the links between neighbours in a group of equal checksums and sizes, the share cut."""
    per = assigned.groupBy("text_crc32", "size", "shard").agg(F.count(F.lit(1)).alias("n"))
    groups = per.groupBy("text_crc32", "size").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("parts"))
    found = groups.agg(F.sum(F.col("n") - 1).alias("links"), F.sum(F.col("parts") - 1).alias("cut")).first()
    return (found["cut"] or 0) / max(1, found["links"] or 0)
