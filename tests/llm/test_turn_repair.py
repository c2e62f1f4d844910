"""Conversation repair against a plain search over all edits."""

import hashlib
import random
import re
import zlib
from pathlib import Path

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rowproof.llm import turn_chunks, turn_repair
from rowproof.llm.queries import QUERIES
from rowproof.llm.turn_repair import BlockTables, applied, closing, symbol_of

DATA = "/root/testdata/sf0.01"

TABLES = BlockTables()
STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
FULL = {"u": "user", "a": "assistant"}


def plain(rows):
    """(cost, audit, repaired rows): the least over all edits, kept for each state; rows are
    (role, text, must be deleted, truncated)."""
    best = {0: (0, "", [])}

    def inserts(best):
        for _ in range(4):
            for q, (cost, audit, made) in list(best.items()):
                for x in "ua":
                    t = STEP.get((q, x))
                    found = (cost + 3, audit + "I", [*made, (FULL[x], "")])
                    if t is not None and (t not in best or found < best[t]):
                        best[t] = found
        return best

    for role, text, gone, cut in rows:
        after = {}
        for q, (cost, audit, made) in inserts(best).items():
            options = [(q, (cost + 4, audit + "D", made))]
            if not gone:
                t = STEP.get((q, role[:1]))
                if t is not None:
                    options.append((t, (cost + 3 * cut, audit + "K", [*made, (role, text)])))
                for x in "ua":
                    t = STEP.get((q, x))
                    if t is not None:
                        options.append((t, (cost + 3 + 3 * cut, audit + "R", [*made, (FULL[x], text)])))
            for t, found in options:
                if t not in after or found[:2] < after[t][:2]:
                    after[t] = found
        best = after
    best = inserts(best)
    return min(best[q] for q in (0, 3) if q in best)


ROLES = ["system", "user", "assistant", "tool", "", " "]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(ROLES), st.sampled_from(["a.", "b"]), st.booleans(), st.booleans()), max_size=14), st.integers(0, 14))
def test_tables_equal_the_search(rows, cut):
    symbols = bytes(symbol_of(role, gone, short) for role, _, gone, short in rows)
    cost, audit, made = plain(rows)
    edits, q = TABLES.trace(symbols)
    edits += closing(q)
    assert (TABLES.cost(symbols), edits) == (cost, audit)
    assert [e[1:] for e in applied(edits, [r[:2] for r in rows], 0)] == made
    assert re.fullmatch("(s?(ua)+)?", "".join(r[:1] for r, _ in made))
    # Two chunks that meet give the same.
    cut = min(cut, len(rows))
    behind = int(TABLES.chunk_map(symbols[cut:])[0])
    left, middle = TABLES.trace(symbols[:cut], behind)
    right, end = TABLES.trace(symbols[cut:], 0, middle)
    assert left + right + closing(end) == audit


def test_few_vectors_occur():
    assert len(TABLES._single[0]) < 100


def damage(conversations):
    """{conv_id: rows after damage}, in plain Python."""
    found = {c: [] for c, *_ in conversations}
    for conv, turn, role, text in conversations:
        role, text = " " if role is None else role, " " if text is None else text
        key = ":".join(" " if x is None else str(x) for x in (conv, turn))
        luck = zlib.crc32(key.encode()) % 20
        if luck == 0:
            continue
        text = "" if luck == 1 else re.sub("[.!?]", "", text) if luck == 2 else text
        found[conv] += [(turn, "user" if luck == 4 else role, text)] * (2 if luck == 3 else 1)
    return found


def expected(conversations):
    rows = []
    for conv, turns in damage(conversations).items():
        turns.sort(key=lambda r: (r[0] is not None, r[0] or 0))
        seen, counts, judged = set(), [0, 0, 0], []
        for _, role, text in turns:
            body = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = 0 if not body else 1 if (role, text) in seen else 2 if body[-1] not in ".!?" else 3
            seen.add((role, text))
            if fault < 3:
                counts[fault] += 1
            judged.append((role, text, fault < 2, fault == 2))
        numbers = {t for t, *_ in turns if t is not None}
        cost, audit, made = plain(judged)
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:], strict=False))
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made).encode()).hexdigest()
        gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        rows.append((conv, gaps, *counts, illegal, cost, audit, digest))
    return sorted(rows, key=str)


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def report(conversations):
    chunks = turn_repair.repair_chunks(turn_repair.with_faults(turn_repair.damaged(conversations)))
    return sorted((tuple(r) for r in turn_repair.repair_report(chunks).select(COLUMNS).collect()), key=str)


def sample(seed, conversations, longest):
    luck = random.Random(seed)
    rows = []
    for conv in [*range(conversations), None]:
        for turn in range(luck.randrange(1, longest)):
            role = luck.choice(["system", "user", "assistant", "user", "assistant", None, "tool", ""])
            rows.append((conv, turn if luck.random() < 0.95 else turn + 1000, role, luck.choice([None, "", " \n", "Yes.", "No", "x! ", "é。", f"t{turn}."])))
        rows.append((conv, None, "system", "Before all."))
    return rows


SCHEMA = "conv_id bigint, turn bigint, role string, text string"


@pytest.mark.parametrize("chunk_rows", [1024, 3])
def test_report_equals_plain_python(spark, monkeypatch, chunk_rows):
    # Chunks of three rows make every conversation meet over the folds.
    monkeypatch.setattr(turn_chunks, "CHUNK_ROWS", chunk_rows)
    rows = sample(7, 60, 30)
    found = report(spark.createDataFrame(rows, SCHEMA).repartition(5))
    assert found == expected(rows)


def test_one_conversation_over_several_tasks(spark):
    rows = [(1, k, "user" if k % 2 == 0 else "assistant", f"turn {k % 700}.") for k in range(5000)]
    assert report(spark.createDataFrame(rows, SCHEMA)) == expected(rows)


def test_given_fixture_of_faults_and_odd_columns(spark):
    rows = spark.createDataFrame(
        [(1, None, None, None, "a", "b"), (1, None, None, None, "a", "b"), (2, 5, "user", "Hi!", "a", "b")],
        SCHEMA + ", symbols string, uid string")
    plain_rows = [tuple(r)[:4] for r in rows.collect()]
    assert report(rows) == expected(plain_rows)
    assert report(rows.limit(0)) == []


def test_repaired_turns_are_sound(spark):
    rows = sample(3, 20, 12)
    chunks = turn_repair.repair_chunks(turn_repair.with_faults(turn_repair.damaged(spark.createDataFrame(rows, SCHEMA))))
    by = {}
    for r in sorted(turn_repair.repaired_turns(chunks).collect(), key=lambda r: (r.part, r.k, r.n)):
        by.setdefault(r.conv_id, []).append(r.role[:1])
    assert by and all(re.fullmatch("s?(ua)+", "".join(v)) for v in by.values())


@pytest.mark.skipif(not Path(DATA).exists(), reason="given tables are not here")
def test_query_over_given_conversations(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{DATA}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    found = QUERIES["op13_turn_repair"](spark, DATA).select(COLUMNS).collect()
    assert sorted(map(tuple, found), key=str) == expected(rows)
