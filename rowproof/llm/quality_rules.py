"""Quality rules as a short-circuit cascade.

On a bounded sample, each rule's cost (seconds a document) and verdicts are measured; rules are
then ordered by how many of the documents still standing they reject for their cost. A text
goes through the rules in that order and stops at the first that rejects it. The order changes
the time only: a text is kept when no rule rejects it.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowproof.llm.text import bound_batches, utf8

SYMBOLS = b"#*$%&|<>"

#: Documents of the sample on which costs and selectivities are measured.
SAMPLE_ROWS = 512


class Page:
    """One text; what a rule asks for is computed once, when first asked for."""

    def __init__(self, text: bytes):
        self.text = text

    @cached_property
    def words(self) -> list[bytes]:
        # bytes.split() splits at blanks and at tab to carriage return, nothing else.
        return self.text.split()

    @property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return len(b"".join(self.words).decode("utf-8", "replace"))

    @cached_property
    def n_symbols(self) -> int:
        return len(self.text) - len(self.text.translate(None, SYMBOLS))

    @cached_property
    def n_lines(self) -> int:
        return sum(1 for line in self.text.split(b"\n") if line.strip())

    @cached_property
    def n_dup_lines(self) -> int:
        """Lines with a word that equal an earlier line."""
        if b"\n" not in self.text:
            return 0
        lines = [line for line in self.text.split(b"\n") if line.strip()]
        return len(lines) - len(set(lines))

    @cached_property
    def n_repeat_words(self) -> int:
        """Words inside 3-word windows that occur twice or more in the text."""
        words = self.words
        if len(words) < 4:
            return 0
        number: dict[bytes, int] = {}
        new = count()
        get = number.get
        ids = np.empty(len(words), np.int64)
        for k, word in enumerate(words):
            n = get(word)
            if n is None:
                n = number[word] = next(new)
            ids[k] = n
        # Pairs first, then triples, so that codes stay below 2**63 for any text.
        pairs = np.unique(ids[:-1] * len(number) + ids[1:], return_inverse=True)[1]
        _, which, times = np.unique(
            pairs[:-1] * len(number) + ids[2:], return_inverse=True, return_counts=True
        )
        start = np.flatnonzero(times[which] > 1)
        if not len(start):
            return 0
        inside = np.zeros(len(words), bool)
        for offset in range(3):
            inside[start + offset] = True
        return int(inside.sum())

    @cached_property
    def capitals(self) -> tuple[int, int]:
        """ASCII capitals and ASCII letters."""
        codes = np.frombuffer(self.text, np.uint8)
        upper = int(((codes >= 65) & (codes <= 90)).sum())
        return upper, upper + int(((codes >= 97) & (codes <= 122)).sum())


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Page], bool]


#: What every text must satisfy in any case.
BASE_RULES = (
    Rule("too_short", lambda p: p.n_words < 50),
    Rule("repeated_words", lambda p: 100 * p.n_repeat_words > 50 * p.n_words),
)

#: The verdict on texts that pass the base: shares chosen well outside ordinary prose.
CASCADE_RULES = (
    Rule("symbols", lambda p: 10 * p.n_symbols > 3 * p.n_words),
    Rule("capitals", lambda p: 10 * p.capitals[0] > 6 * p.capitals[1]),
    Rule("duplicate_lines", lambda p: 2 * p.n_dup_lines > p.n_lines),
    Rule("word_length", lambda p: not 2 * p.n_words <= p.word_chars <= 25 * p.n_words),
)

RULES = BASE_RULES + CASCADE_RULES


def stopped_by(page: Page, rules: Sequence[Rule]) -> str | None:
    """The first rule that rejects; rules behind it are not asked."""
    return next((r.name for r in rules if r.rejects(page)), None)


def measure(docs: DataFrame, rules: tuple[Rule, ...], rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Seconds of each rule and its verdicts over a sample, one row per document."""
    bound_batches(docs.sparkSession)
    total = docs.select("doc_id").count()
    share = min(1.0, rows / max(1, total))
    inside = F.pmod(F.xxhash64("doc_id", F.lit("cascade")), 1 << 20) < F.lit(int(share * (1 << 20)) + 1)
    schema = "seconds array<double>, rejected array<boolean>"
    kind = pa.schema([("seconds", pa.list_(pa.float64())), ("rejected", pa.list_(pa.bool_()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seconds, rejected = [], []
            for text in utf8(batch.column("text")):
                own, verdicts = [], []
                for rule in rules:
                    page = Page(text)  # each rule is timed as if it came first
                    began = time.perf_counter()
                    verdicts.append(bool(rule.rejects(page)))
                    own.append(time.perf_counter() - began)
                seconds.append(own)
                rejected.append(verdicts)
            yield pa.RecordBatch.from_pydict({"seconds": seconds, "rejected": rejected}, kind)

    # A hash threshold takes about ``rows`` documents; the limit makes that a bound.
    sampled = docs.filter(inside).select("text").mapInArrow(run, schema).limit(2 * rows).collect()
    if not sampled:
        return np.ones(len(rules)), np.zeros((0, len(rules)), bool)
    return (
        np.array([r["seconds"] for r in sampled]).mean(axis=0) + 1e-9,
        np.array([r["rejected"] for r in sampled], bool),
    )


def cascade_order(seconds: np.ndarray, rejected: np.ndarray) -> list[int]:
    """Rules by rejection per cost, each judged on what the rules before it leave."""
    left, order, standing = set(range(len(seconds))), [], np.ones(len(rejected), bool)
    while left:
        best = max(left, key=lambda r: ((rejected[standing, r].sum() + 0.5) / seconds[r], -r))
        order.append(best)
        left.discard(best)
        standing &= ~rejected[:, best]
    return order


def _ordered(docs: DataFrame) -> tuple[Rule, ...]:
    """All rules, by rejection per cost on a sample of these documents."""
    order = list(cascade_order(*measure(docs, RULES, SAMPLE_ROWS)))
    order += [k for k in range(len(RULES)) if k not in order]
    return tuple(RULES[k] for k in order)


def cascade(docs: DataFrame) -> DataFrame:
    """(doc_id, kept, stopped_by) of every document: the verdict, and the rule at which it ended.

    A text is asked for nothing behind the rule that rejects it. Which rule that is depends on
    the measured order where several reject; the verdict does not. Null and empty texts have no
    words and are rejected, very long ones are judged whole; repeated rows and ties of rules
    are judged alike; an empty table gives an empty result; only ``doc_id`` and ``text`` are read.
    """
    bound_batches(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    rules = _ordered(docs)
    key = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends = [stopped_by(Page(text), rules) for text in utf8(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([e is None for e in ends]), pa.array(ends, pa.string())],
                ["doc_id", "kept", "stopped_by"])

    return docs.mapInArrow(run, f"doc_id {key}, kept boolean, stopped_by string")


def keep_quality_texts(docs: DataFrame) -> DataFrame:
    """The documents that no rule rejects, with their columns as they were."""
    bound_batches(docs.sparkSession)
    rules = _ordered(docs.select("doc_id", "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [stopped_by(Page(text), rules) is None for text in utf8(batch.column("text"))]
            yield batch.filter(pa.array(kept, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def judge_quality(docs: DataFrame) -> DataFrame:
    """The verdict of the cascade, and then the counts of each text for a report.

    The verdict comes first and stops early; the counts, whether a base rule fails, and the
    first rule in the order of RULES that rejects a rejected text are worked out afterwards.

    Null and empty texts have no words, so the base rejects them; very long texts are judged
    whole. Repeated rows are judged alike, an empty table gives an empty result; only ``doc_id``
    and ``text`` are read.
    """
    bound_batches(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    rules = _ordered(docs)
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    key = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {key}, {', '.join(f'{c} bigint' for c in counts)}, base_failed boolean, kept boolean, failed_rule string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: dict[str, list] = {c: [] for c in counts}
            base_failed, kept, failed = [], [], []
            for text in utf8(batch.column("text")):
                page = Page(text)
                kept.append(stopped_by(page, rules) is None)
                for c in counts:
                    columns[c].append(getattr(page, c))
                base_failed.append(stopped_by(page, BASE_RULES) is not None)
                failed.append(None if kept[-1] else stopped_by(page, RULES))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(columns[c], pa.int64()) for c in counts),
                 pa.array(base_failed), pa.array(kept), pa.array(failed, pa.string())],
                ["doc_id", *counts, "base_failed", "kept", "failed_rule"],
            )

    return docs.mapInArrow(run, schema)
