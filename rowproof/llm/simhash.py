"""SimHash near-duplicates: tiled exact comparison with exclusive-or and bit counts.

Distinct fingerprints are cut into parts; the population counts of the parts are a
fingerprint's signature, and a tile holds the fingerprints of one signature (at most
``TILE_ROWS`` of them, larger ones are cut). A differing bit changes the population count of
one part by one, so two tiles whose counts differ by more than the radius in sum are never
compared. All other pairs of tiles are compared in full: within the radius no link is missed.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations, product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowproof.llm.components import components
from rowproof.llm.text import LOWER, UPPER, bound_batches, free_name, utf8
from rowproof.session import settle, settle_measured

SEED = 42
SHINGLE = 3
RADIUS = 2
BITS = 64

#: Fingerprints that one task holds at once, and how many it compares with them.
TILE_ROWS = 4096
TILE_VISITORS = 32 * TILE_ROWS

_LOWER = bytes.maketrans(UPPER, LOWER)
_HASHES_AT_ONCE = 1 << 16


def fingerprint(text: bytes) -> int:
    """A bit is set when more than half of the shingles' hashes have it; no words: zero."""
    words = text.translate(_LOWER).split()
    if not words:
        return 0
    body = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    width = min(SHINGLE, len(words))
    n = len(words) - width + 1
    starts = np.concatenate(([0], ends[:n - 1] + 1)).tolist()
    ends = ends[width - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    set_bits = np.zeros(BITS, np.int64)
    for k in range(0, n, _HASHES_AT_ONCE):
        part = zip(starts[k:k + _HASHES_AT_ONCE], ends[k:k + _HASHES_AT_ONCE], strict=True)
        hashes = np.array([digest(body[a:b], SEED) for a, b in part], "<u8")
        set_bits += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(
            axis=0, dtype=np.int64
        )
    return sum(1 << bit for bit in np.flatnonzero(2 * set_bits > n).tolist())


def fingerprints(docs: DataFrame, *carried: str) -> DataFrame:
    """(doc_id, the carried columns, fp): the fingerprint as a signed 64-bit number."""
    bound_batches(docs.sparkSession)
    names = ["doc_id", *carried]
    docs = docs.select(*names, "text")
    schema = docs.select(*names, F.lit(None).cast("long").alias("fp")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array([fingerprint(t) for t in utf8(batch.column("text"))], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(values.view(np.int64))], [*names, "fp"]
            )

    return docs.mapInArrow(run, schema)


def parts_for(n: int) -> int:
    """Into how many parts a fingerprint is cut: the more fingerprints, the finer the tiles.

    With p parts of b bits, two random fingerprints share a tile with a chance of about
    (pi * b) ** (-p / 2). The result is the same for any number of parts.
    """
    for parts in (2, 4, 8):
        if n * (math.pi * BITS / parts) ** (-parts / 2) <= TILE_ROWS / 16:
            return parts
    return 16


def _signature(fp: Column, parts: int) -> list[Column]:
    width = BITS // parts
    mask = F.lit((1 << width) - 1)
    return [F.bit_count(F.shiftrightunsigned(fp, p * width).bitwiseAND(mask)) for p in range(parts)]


def _tile(counts: list[Column], parts: int) -> Column:
    """Signature as one number, biased by the radius so that neighbours stay positive."""
    base = BITS // parts + 1 + 2 * RADIUS
    tile = F.lit(0).cast("long")
    for c in counts:
        tile = tile * base + (c + RADIUS)
    return tile


def _steps(parts: int) -> list[int]:
    """What to add to a tile's number to reach each later tile within the radius."""
    base = BITS // parts + 1 + 2 * RADIUS
    weights = [base ** (parts - 1 - p) for p in range(parts)]
    steps = set()
    for touched in range(1, RADIUS + 1):
        for places in combinations(range(parts), touched):
            for moves in product(range(-RADIUS, RADIUS + 1), repeat=touched):
                if all(moves) and sum(map(abs, moves)) <= RADIUS:
                    steps.add(sum(weights[p] * m for p, m in zip(places, moves, strict=True)))
    return sorted(s for s in steps if s > 0)


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest member of each member's component, for members 0 to n - 1 and links a, b."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        root = root[root]
        if (root == before).all():
            return root


def _compare(home: np.ndarray, visitors: np.ndarray, inside: bool) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links of one tile with its visitors (and with itself), in blocks."""
    everyone = np.concatenate((home, visitors))
    a_all, b_all = [], []
    others = everyone if inside else visitors
    shift = 0 if inside else len(home)
    step = max(1, (1 << 21) // max(1, len(home)))
    for k in range(0, len(others), step):
        block = others[k:k + step]
        near = np.bitwise_count(block[:, None] ^ home[None, :]) <= RADIUS
        b, a = np.nonzero(near)
        b = b + (k + shift)
        keep = a != b
        if keep.any():
            # A dense group would yield a link for each pair: keep a spanning forest only.
            members, local = np.unique(np.concatenate((a[keep], b[keep])), return_inverse=True)
            half = len(local) // 2
            root = _roots(len(members), local[:half], local[half:])
            moved = root != np.arange(len(members))
            a_all.append(members[root[moved]])
            b_all.append(members[moved])
    if not a_all:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    a, b = np.concatenate(a_all), np.concatenate(b_all)
    members, local = np.unique(np.concatenate((a, b)), return_inverse=True)
    root = _roots(len(members), local[:len(a)], local[len(a):])
    moved = root != np.arange(len(members))
    return everyone[members[moved]], everyone[members[root[moved]]]


def _compare_tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by tile; those of a tile's own fingerprints come before its visitors."""
    key, role, held = None, [], []
    names = ["a", "b"]

    def closed() -> pa.RecordBatch | None:
        fps, visiting = np.concatenate(held), np.concatenate(role)
        home, visitors = fps[visiting == 0], fps[visiting != 0]
        # The first slice of a chunk also compares the chunk with itself.
        a, b = _compare(home, visitors, inside=key[2] == 0)
        if len(a):
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names)
        return None

    for batch in batches:
        keys = np.stack([batch.column(c).to_numpy() for c in ("tile", "chunk", "slice")])
        fps = batch.column("fp").to_numpy().view(np.uint64)
        visiting = batch.column("visiting").to_numpy()
        cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
        for first, past in zip(np.concatenate(([0], cuts)), np.concatenate((cuts, [len(fps)])), strict=True):
            if first == past:
                continue
            now = tuple(keys[:, first])
            if now != key:
                if key is not None and (out := closed()) is not None:
                    yield out
                key, role, held = now, [], []
            held.append(fps[first:past])
            role.append(visiting[first:past])
    if key is not None and (out := closed()) is not None:
        yield out


def near_links(distinct: DataFrame, n: int) -> DataFrame:
    """Links (a, b) that connect all ``fp`` values within the radius of each other."""
    parts = parts_for(n)
    tiled = settle(
        distinct.select("fp", _tile(_signature(F.col("fp"), parts), parts).alias("tile")), "tiled"
    )
    sizes = tiled.groupBy("tile").agg(F.count(F.lit(1)).alias("n"))
    steps = F.array(*[F.lit(s).cast("long") for s in _steps(parts)])
    neighbours = F.explode(F.transform(steps, lambda s: F.col("tile") + s)).alias("tile")
    arriving = (
        sizes.select(neighbours, "n")
        .groupBy("tile").agg(F.sum("n").alias("arriving"))
    )
    chunks = F.ceil(F.col("n") / TILE_ROWS).cast("int")
    layout = settle(
        sizes.join(arriving, "tile", "left").select(
            "tile", chunks.alias("chunks"),
            # Each chunk meets the visitors and the chunks before it, a slice of them at a time.
            F.ceil((F.coalesce("arriving", F.lit(0)) + F.col("n")) / TILE_VISITORS).cast("int").alias("slices"),
        ),
        "layout",
    )
    spread = F.xxhash64("fp", F.lit("chunk"))
    chunk = F.pmod(spread, F.col("chunks")).cast("int")
    own_slice = F.pmod(F.xxhash64("fp", F.lit("slice")), F.col("slices")).cast("int")
    own = tiled.join(layout, "tile").withColumn("chunk", chunk)
    home = own.select(
        "tile", "chunk", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"),
        F.lit(0).alias("visiting"), "fp",
    )
    later = own.filter("chunk + 1 < chunks").select(
        "tile", F.explode(F.sequence(F.col("chunk") + 1, F.col("chunks") - 1)).alias("chunk"),
        own_slice.alias("slice"), F.lit(1).alias("visiting"), "fp",
    )
    visits = tiled.select(neighbours, "fp").join(layout, "tile").select(
        "tile", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"),
        own_slice.alias("slice"), F.lit(1).alias("visiting"), "fp",
    )
    met = home.union(later).union(visits).repartition("tile", "chunk", "slice")
    met = met.sortWithinPartitions("tile", "chunk", "slice", "visiting")
    return met.mapInArrow(_compare_tiles, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, *carried: str) -> DataFrame:
    """(doc_id, the carried columns, fp, component_id) for every row of ``docs``.

    Equal texts and texts without words (null, empty, blank: fingerprint zero) share a
    fingerprint and so a component. ``component_id`` is the smallest non-null doc_id
    reachable, null if there is none. Repeated rows each keep their row; an empty table gives
    an empty result; columns other than ``doc_id``, ``text`` and the carried ones are not read.
    """
    return _classified(docs, *carried).select("doc_id", *carried, "fp", "component_id")


def _classified(docs: DataFrame, *carried: str) -> DataFrame:
    """:func:`near_duplicates` with ``root``, which names a component also where no row has an id."""
    marked = settle(fingerprints(docs, *carried), "fingerprints")
    smallest = marked.groupBy("fp").agg(F.min("doc_id").alias("least"))
    distinct, seen = settle_measured(smallest, "distinct")
    bound_batches(docs.sparkSession)
    links = settle(near_links(distinct.select("fp"), seen["rows"]), "links")
    linked = settle(components(links), "components")
    rooted = distinct.join(linked, distinct["fp"] == linked["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    roots = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = settle(rooted.join(roots, "root").select("fp", "root", "component_id"), "classes")
    return marked.join(classes, "fp")


def as_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` without the documents whose component holds a smaller doc_id.

    A document is a doc_id and a text: texts that share one doc_id are judged each in its own
    component, so that every component keeps the documents of its smallest doc_id. A row without
    doc_id has no name to be removed by and stays; exact repeats of a row stay or go together.
    """
    digest, stays = free_name(docs, "_text"), F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    marked = docs.withColumn(digest, F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256))
    found = settle(near_duplicates(marked, digest).select("doc_id", digest, stays.alias("stays")), "judged")
    ids = found.groupBy("doc_id").agg(F.bool_or("stays").alias("some"), F.bool_and("stays").alias("all"))
    ids = settle(ids.filter("NOT all"), "affected")
    # Most go by their id alone; texts are told apart only where some rows of an id stay.
    whole = settle(ids.filter("NOT some").select("doc_id"), "removed")
    mixed = found.filter("NOT stays").join(ids.filter("some").select("doc_id"), "doc_id", "left_semi")
    single = settle(mixed.select("doc_id", digest).distinct(), "removed-texts")
    kept = docs.join(whole, "doc_id", "left_anti")
    if single.isEmpty():
        return kept.select(docs.columns)
    kept = kept.withColumn(digest, F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256))
    return kept.join(single, ["doc_id", digest], "left_anti").select(docs.columns)


def one_row_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` with exactly one row of each component: one with the smallest doc_id.

    Rows without a doc_id come behind all others of their component; which of several rows with
    the smallest doc_id stays is decided by their number. Texts without words are one component.
    An empty table gives an empty result; all columns pass through, whatever their names.
    """
    row = free_name(docs, "_row")
    numbered = settle(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    found = settle(_classified(numbered, row).select("doc_id", row, "root"), "judged")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), F.col("doc_id").alias("id"), F.col(row).alias("row")))
    # A hot component is one row per task before the shuffle; most rows are alone in theirs.
    several = found.groupBy("root").agg(least.alias("kept"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    several = settle(several.select(F.col("root").alias("_root"), F.col("kept.row").alias("_kept")), "several")
    removed = found.join(several, found["root"] == several["_root"]).filter(F.col(row) != F.col("_kept"))
    return numbered.join(settle(removed.select(row), "removed"), row, "left_anti").select(docs.columns)
