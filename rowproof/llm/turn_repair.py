"""Repair of the turn structure of conversations by tables of blocks (the Four Russians' way).

A sound conversation reads, by the initials of its roles, ``(s?(ua)+)?``. Four states follow
that pattern. The cost to go from each state behind a row is a vector of four numbers; less its
minimum, only a few dozen vectors ever occur. A table holds, for each such vector and each block
of BLOCK rows (as symbols: role and fault), the vector before the block and what was taken off.
A conversation is processed from its end, one lookup a block; then blocks are opened from their
ends again, and a walk forward takes, among the cheapest edits, the one whose initial is least.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowproof.llm.text import share
from rowproof.llm.turn_chunks import arrow_schema, chunk_frame, folded, in_order
from rowproof.session import settle

BLANKS = " \t\n\x0b\x0c\r"
DELETE, INSERT, REROLE, TRUNCATED = 4, 3, 3, 3

#: Rows of one block.
BLOCK = 4

# A row's symbol: 0 must be deleted; 1 to 4 role s, u, a, other; 5 to 8 the same, truncated.
N_SYMBOLS = 9
_START, _AFTER_S, _AFTER_U, _AFTER_A = range(4)
_FAR = 1 << 20
# State behind a row of role s, u, a, other.
_NEXT = (
    (_AFTER_S, _AFTER_U, None, None),
    (None, _AFTER_U, None, None),
    (None, None, _AFTER_A, None),
    (None, _AFTER_U, None, None),
)
#: The one state that an inserted or relabelled row leads to, and its role.
_PUSH = (_AFTER_U, _AFTER_U, _AFTER_A, _AFTER_U)
_ROLE = ("user", "user", "assistant", "user")


def _with_inserts(costs: list[int]) -> list[int]:
    for _ in range(3):
        costs = [min(c, INSERT + costs[_PUSH[q]]) for q, c in enumerate(costs)]
    return costs


#: Costs to go at the end: the conversation must be empty or end behind an assistant.
_END = tuple(_with_inserts([0, _FAR, _FAR, 0]))


@lru_cache(None)
def _moves(symbol: int, q: int) -> list[tuple[str, int, int]]:
    """(initial, cost, next state) of the edits of one row, by initial."""
    found = [("D", DELETE, q)]
    if symbol:
        extra = TRUNCATED if symbol > 4 else 0
        kept = _NEXT[q][(symbol - 1) % 4]
        if kept is not None:
            found.append(("K", extra, kept))
        found.append(("R", REROLE + extra, _PUSH[q]))
    return found


@lru_cache(100_000)
def _before(after: tuple[int, ...], symbol: int) -> tuple[int, ...]:
    return tuple(_with_inserts([min(c + after[t] for _, c, t in _moves(symbol, q)) for q in range(4)]))


def symbol_of(role: str, gone: bool, truncated: bool) -> int:
    return 0 if gone else 1 + "sua".find(role[:1] or "?") % 4 + 4 * truncated


@dataclass
class BlockTables:
    """Transitions of normalised cost vectors, by one symbol and by a block of symbols."""

    block: int = BLOCK
    walks: dict[tuple[int, int, int], tuple[str, int]] = field(default_factory=dict)

    @cached_property
    def _single(self) -> tuple[list[tuple[int, ...]], np.ndarray, np.ndarray]:
        """(vectors, vector before a symbol, what was taken off); vector 0 is the end's."""
        index, vectors, rows, offsets = {_END: 0}, [_END], [], []
        for v in vectors:  # grows as new vectors are met
            came = [_before(v, x) for x in range(N_SYMBOLS)]
            offsets.append([min(c) for c in came])
            row = []
            for c in came:
                c = tuple(x - min(c) for x in c)
                if c not in index:
                    index[c] = len(vectors)
                    vectors.append(c)
                row.append(index[c])
            rows.append(row)
        return vectors, np.array(rows, np.int32), np.array(offsets, np.int32)

    @cached_property
    def _blocks(self) -> tuple[np.ndarray, np.ndarray]:
        """For each vector behind a block and each block: the vector before it, and the costs."""
        _, one, cost = self._single
        before, total = one, cost
        for _ in range(self.block - 1):
            # One more symbol in front of blocks that are known.
            total = total[:, None, :] + np.moveaxis(cost[before], 2, 1)
            before = np.moveaxis(one[before], 2, 1)
            before, total = before.reshape(len(one), -1), total.reshape(len(one), -1)
        return before, total

    def codes(self, symbols: bytes) -> tuple[list[int], bytes]:
        """Numbers of the full blocks, and the symbols left at the end."""
        n = len(symbols) // self.block
        full = np.frombuffer(symbols, np.uint8, n * self.block).reshape(n, self.block)
        return (full @ N_SYMBOLS ** np.arange(self.block)[::-1]).tolist(), symbols[n * self.block:]

    def backward(self, symbols: bytes, after: int = 0) -> tuple[int, list[int], int]:
        """(vector before all, vectors behind each full block, costs taken off)."""
        codes, rest = self.codes(symbols)
        _, one, cost = self._single
        blocks, total = self._blocks
        v, spent = after, 0
        for x in reversed(rest):
            v, spent = int(one[v, x]), spent + int(cost[v, x])
        behind = []
        for code in reversed(codes):
            behind.append(v)
            v, spent = int(blocks[v, code]), spent + int(total[v, code])
        return v, behind[::-1], spent

    def chunk_map(self, symbols: bytes) -> np.ndarray:
        """For every vector behind these symbols, the vector before them."""
        codes, rest = self.codes(symbols)
        _, one, _ = self._single
        blocks, _ = self._blocks
        v = np.arange(len(one), dtype=np.int32)
        for x in reversed(rest):
            v = one[v, x]
        for code in reversed(codes):
            v = blocks[v, code]
        return v

    def cost(self, symbols: bytes) -> int:
        """Cost of the cheapest repair of a whole conversation."""
        v, _, spent = self.backward(symbols)
        return spent + self._single[0][v][_START]

    def _walk(self, symbols: bytes, after: int, q: int) -> tuple[str, int]:
        """Edits of some rows from state ``q``: the rows are opened backward, then walked."""
        vectors, one, _ = self._single
        behind, v = [], after
        for x in reversed(symbols):
            behind.append(v)
            v = int(one[v, x])
        edits = []
        for x, b in zip(symbols, reversed(behind), strict=True):
            ahead, left = vectors[b], _before(vectors[b], x)
            while True:
                best = {name: t for name, c, t in _moves(x, q) if c + ahead[t] == left[q]}
                if INSERT + left[_PUSH[q]] == left[q]:
                    best["I"] = _PUSH[q]
                name = min(best)
                edits.append(name)
                q = best[name]
                if name != "I":
                    break
        return "".join(edits), q

    def trace(self, symbols: bytes, after: int = 0, q: int = _START) -> tuple[str, int]:
        """(edits, state behind them) of these rows, given what follows and where they begin."""
        codes, rest = self.codes(symbols)
        _, behind, _ = self.backward(symbols, after)
        edits = []
        for n, (code, b) in enumerate(zip(codes, behind, strict=True)):
            found = self.walks.get((code, b, q))
            if found is None:
                found = self.walks[code, b, q] = self._walk(symbols[n * self.block:(n + 1) * self.block], b, q)
            edits.append(found[0])
            q = found[1]
        last, q = self._walk(rest, after, q)
        return "".join(edits) + last, q


def closing(q: int) -> str:
    """The inserts that end a conversation."""
    return "I" * (_END[q] // INSERT)


def applied(edits: str, rows: list[tuple[str, str]], q: int) -> list[tuple[str, str, str]]:
    """(edit, role, text) of all rows behind the edits, deleted ones left out."""
    made, at = [], iter(rows)
    for name in edits:
        role, text = ("", "") if name == "I" else next(at)
        if name == "D":
            continue
        if name == "K":
            q = _NEXT[q]["sua".find(role[:1])]
        else:
            role, q = _ROLE[q], _PUSH[q]
        made.append((name, role, text))
    return made


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows with faults put in by crc32 of ``conv_id:turn`` modulo 20, nulls as one blank.

    Adds ``dropped`` for remainder 0, so that a conversation that loses all rows is still known.
    """
    some = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    luck = F.pmod(F.crc32(F.concat_ws(":", some("conv_id"), some("turn")).cast("binary")), F.lit(20))
    text = F.when(F.col("luck") == 1, "").when(F.col("luck") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    rows = conversations.select("conv_id", "turn", some("role").alias("role"), some("text").alias("text"), luck.alias("luck"))
    return rows.select(
        "conv_id", "turn", F.when(F.col("luck") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
        (F.col("luck") == 0).alias("dropped"),
        F.explode(F.when(F.col("luck") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy"),
    ).drop("_copy")


def with_faults(rows: DataFrame) -> DataFrame:
    """Adds uid, blank, duplicate and truncated; ``dropped`` rows take no part."""
    settled = settle(rows.withColumn("uid", F.monotonically_increasing_id()), "turns")
    body = F.rtrim(F.col("text"), F.lit(BLANKS))
    keyed = settled.filter("NOT dropped").select("conv_id", "turn", "role", "uid", F.sha2("text", 256).alias("d"))
    several = settle(keyed.groupBy("conv_id", "role", "d").agg(
        F.min(F.struct("turn", "uid"))["uid"].alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1"), "repeated")
    same = keyed["conv_id"].eqNullSafe(several["conv_id"]) & (keyed["role"] == several["role"]) & (keyed["d"] == several["d"])
    again = settle(keyed.join(several, same).filter("uid <> first").select("uid", F.lit(True).alias("duplicate")), "again")
    return settled.join(again, "uid", "left").select(
        "conv_id", "turn", "role", "text", "uid", "dropped", (body == "").alias("blank"),
        F.coalesce("duplicate", F.lit(False)).alias("duplicate"),
        (~F.right(body, F.lit(1)).isin(".", "!", "?")).alias("truncated"),
    )


_ROW = ["turn", "role", "text", "dropped", "blank", "duplicate", "truncated"]
_CHUNK = """symbols binary, roles array<string>, texts array<string>, n bigint, blank bigint, duplicate bigint,
    truncated bigint, illegal bigint, first string, last string, turns bigint, low bigint, high bigint"""
_LEGAL = {"su", "ua", "au"}


def _chunk(rows: list[tuple]) -> dict:
    """Symbols and counts of one chunk. Turns are sorted, so distinct ones are counted by change."""
    here = [r for r in rows if not r[3]]
    roles, counts, symbols = [r[1] for r in here], [0, 0, 0], bytearray()
    for _, role, _, _, blank, duplicate, truncated in here:
        fault = 0 if blank else 1 if duplicate else 2 if truncated else None
        if fault is not None:
            counts[fault] += 1
        symbols.append(symbol_of(role, fault in (0, 1), fault == 2))
    turns = [r[0] for r in here if r[0] is not None]
    initials = [r[:1] for r in roles]
    return {
        "symbols": bytes(symbols), "roles": roles, "texts": [r[2] for r in here], "n": len(here),
        "blank": counts[0], "duplicate": counts[1], "truncated": counts[2],
        "illegal": sum(a + b not in _LEGAL for a, b in zip(initials, initials[1:])),  # noqa: B905
        "first": initials[0] if here else None, "last": initials[-1] if here else None,
        "turns": len(set(turns)), "low": turns[0] if turns else None, "high": turns[-1] if turns else None,
    }


def repair_chunks(rows: DataFrame) -> DataFrame:
    """Chunks of conversations with ``edits`` and the repaired roles and texts.

    ``rows`` are (conv_id, turn, role, text, uid, dropped, blank, duplicate, truncated) as
    :func:`with_faults` gives them. Chunks of one conversation follow each other by (part, k).

    Every conversation of the rows has a chunk, also one whose rows are all dropped. Null turns
    come first, repeated rows and rows of one turn follow each other by role and text hash. A
    null conv_id is a conversation like others. A role whose initial is none of s, u and a (an
    empty one too) can only be relabelled or deleted. An empty table gives an empty frame; texts
    may be of any length, other columns are not read.
    """
    spark = rows.sparkSession
    tables = share(spark, BlockTables())
    chunks = settle(chunk_frame(in_order(rows), _ROW, _chunk, _CHUNK), "turn-chunks")
    kind = chunks.schema["conv_id"].dataType.simpleString()
    key = "part int, k int"

    def mapped(column: str, value):
        """A mapInArrow function: (conv_id, part, k, column) of each chunk."""
        def run(batches):
            for batch in batches:
                made = [value(r) for r in batch.to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in ("conv_id", "part", "k")), pa.array(made, pa.binary())],
                    ["conv_id", "part", "k", column])
        return run

    # What follows a chunk: the vectors before chunks are folded from the last to the first one.
    several = chunks.filter("NOT whole").select("conv_id", "part", "k", "symbols")
    maps = several.mapInArrow(
        mapped("map", lambda r: tables().chunk_map(r["symbols"]).tobytes()), f"conv_id {kind}, {key}, map binary")

    def back(state: dict, row: dict) -> dict:
        after = state.setdefault("v", 0)
        final = not state.get("seen")
        state["v"], state["seen"] = int(np.frombuffer(row["map"], np.int32)[after]), True
        return {"part": row["part"], "k": row["k"], "after": after, "final": final}

    behind = settle(folded(
        maps, [F.desc("part"), F.desc("k")], dict, back, lambda s: None, f"{key}, after int, final boolean"), "behind")

    # Where a chunk begins: states are folded from the first chunk to the last one.
    def leaving(row: dict) -> bytes:
        return bytes(tables().trace(row["symbols"], row["after"], q)[1] for q in range(4))

    exits = _joined(several, behind).mapInArrow(mapped("exits", leaving), f"conv_id {kind}, {key}, exits binary")

    def forth(state: dict, row: dict) -> dict:
        q = state.setdefault("q", _START)
        state["q"] = row["exits"][q]
        return {"part": row["part"], "k": row["k"], "enters": q}

    enters = settle(folded(exits, ["part", "k"], dict, forth, lambda s: None, f"{key}, enters int"), "enters")
    resolved = _joined(behind, enters)
    placed = _joined(chunks.filter("NOT whole"), resolved).unionByName(
        chunks.filter("whole").withColumns({"after": F.lit(0), "final": F.lit(True), "enters": F.lit(_START)}))

    out = (f"conv_id {kind}, {key}, whole boolean, edits string, cost bigint, edited array<struct<edit:string,role:string,text:string>>, "
           "n bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, first string, last string, "
           "turns bigint, low bigint, high bigint")
    arrow = arrow_schema(spark, out)

    def edit(batches):
        for batch in batches:
            made = []
            for r in batch.to_pylist():
                edits, q = tables().trace(r["symbols"], r["after"], r["enters"])
                if r["final"]:
                    edits += closing(q)
                rows = list(zip(r["roles"], r["texts"], strict=True))
                kept = applied(edits, rows, r["enters"])
                left = [x for x, e in zip(r["symbols"], edits.replace("I", ""), strict=True) if e != "D"]
                cost = DELETE * edits.count("D") + INSERT * edits.count("I") + REROLE * edits.count("R") + TRUNCATED * sum(x > 4 for x in left)
                made.append(r | {"edits": edits, "cost": cost,
                                 "edited": [dict(zip(("edit", "role", "text"), e, strict=True)) for e in kept]})
            yield pa.RecordBatch.from_pylist([{n: m[n] for n in arrow.names} for m in made], arrow)

    return placed.mapInArrow(edit, out)


def _joined(left: DataFrame, right: DataFrame) -> DataFrame:
    """Chunks and what is known about them; a null conv_id is a key like others."""
    right = right.withColumnsRenamed({c: f"_{c}" for c in ("conv_id", "part", "k")})
    same = left["conv_id"].eqNullSafe(right["_conv_id"]) & (left["part"] == right["_part"]) & (left["k"] == right["_k"])
    return left.join(right, same).drop("_conv_id", "_part", "_k")


def repaired_turns(chunks: DataFrame) -> DataFrame:
    """(conv_id, part, k, n, edit, role, text): the repaired rows, in order of part, k and n."""
    return chunks.select("conv_id", "part", "k", F.posexplode("edited").alias("n", "_e")).select(
        "conv_id", "part", "k", "n", "_e.edit", "_e.role", "_e.text")


_REPORT = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"


def repair_report(chunks: DataFrame) -> DataFrame:
    """One row per conversation: faults, cost, the edits' initials and a digest of the repaired rows.

    The chunks of a conversation are streamed in order, since its digest is one sequence.
    """
    pieces = chunks.withColumn("lines", F.array_join(F.transform("edited", lambda e: F.concat(e["role"], F.lit(":"), e["text"])), "\n"))
    pieces = pieces.withColumn("edited", F.size("edited"))

    def start() -> dict:
        return {"n": 0, "turns": 0, "low": None, "high": None, "last": None, "blank": 0, "duplicate": 0, "truncated": 0,
                "illegal": 0, "cost": 0, "edits": [], "sha": hashlib.sha256(), "some": False}

    def step(s: dict, r: dict) -> None:
        for c in ("blank", "duplicate", "truncated", "illegal", "cost"):
            s[c] += r[c]
        if r["n"]:
            if s["last"] is not None and s["last"] + r["first"] not in _LEGAL:
                s["illegal"] += 1
            s["last"] = r["last"]
        if r["turns"]:
            s["turns"] += r["turns"] - (s["high"] == r["low"])
            s["low"] = r["low"] if s["low"] is None else s["low"]
            s["high"] = r["high"]
        if r["edited"]:
            s["sha"].update(("\n" if s["some"] else "").encode() + r["lines"].encode())
            s["some"] = True
        s["edits"].append(r["edits"])

    def finish(s: dict) -> dict:
        gaps = s["high"] - s["low"] + 1 - s["turns"] if s["turns"] else 0
        counts = {c: s[c] for c in ("blank", "duplicate", "truncated", "illegal", "cost")}
        return {"gaps": gaps, **counts, "audit": "".join(s["edits"]), "repaired_sha256": s["sha"].hexdigest()}

    several = folded(pieces.filter("NOT whole").drop("whole"), ["part", "k"], start, step, finish, _REPORT)
    whole = pieces.filter("whole").select(
        "conv_id", F.when(F.col("turns") > 0, F.col("high") - F.col("low") + 1 - F.col("turns")).otherwise(0).cast("long").alias("gaps"),
        "blank", "duplicate", "truncated", "illegal", "cost", F.col("edits").alias("audit"),
        F.sha2(F.col("lines").cast("binary"), 256).alias("repaired_sha256"))
    return whole.unionByName(several)
