"""Quality classifier: supervised subword embeddings.

Words and character n-grams are hashed to rows of one embedding table, a document is the mean
of its rows, and a softmax over two classes is trained with it by stochastic gradient descent.
The score of a document is linear in its features up to the softmax, so that after training
each row shrinks to one number and scoring gathers numbers, not vectors.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from rowproof.llm.labelled import fit_in_a_task, labelled_sample, scored
from rowproof.llm.ngrams import WordHasher, buckets, gram_hashes, slices
from rowproof.llm.text import bound_batches, share

BITS = 16
DIMENSIONS = 8
ORDERS = (2, 3)
EPOCHS = 6
RATE = 4.0

#: Labelled documents the model is fitted to, at most.
SAMPLE_ROWS = 4000

#: The row of a word that follows itself.
REPEAT = 0

#: Rows of zeros that every mean includes, so that few features do not decide alone.
ZEROS = 32

KEEP_FROM = 0.3


class Features:
    """Rows of the embedding table that a text uses, repeats included."""

    def __init__(self):
        self.words = WordHasher()

    def __call__(self, text: str) -> Iterator[np.ndarray]:
        for points, own in slices(text, max(ORDERS) - 1):
            words = self.words(points[:own])
            yield buckets(words, BITS)
            # Of word pairs, the one that matters in any vocabulary: a word after itself.
            yield np.full(int((words[1:] == words[:-1]).sum()), REPEAT, np.int64)
            for n in ORDERS:
                yield buckets(gram_hashes(points, n, own), BITS)


def train(rows: Iterator[tuple[str, int]]) -> np.ndarray:
    """Logit of quality 1 for each row of the table, a bias last."""
    features, data, labels = Features(), [], []
    for text, y in rows:
        counts = sum((np.bincount(b, minlength=1 << BITS) for b in features(text)), np.zeros(1 << BITS, np.int64))
        at = np.flatnonzero(counts)
        if len(at):
            data.append((at.astype(np.int32), (counts[at] / (counts.sum() + ZEROS)).astype(np.float32)))
            labels.append(int(y > 0))
    if not data:
        return np.concatenate((np.zeros(1 << BITS), [50.0])).astype(np.float32)
    random = np.random.default_rng(7)
    table = random.uniform(-1, 1, (1 << BITS, DIMENSIONS)).astype(np.float32) / DIMENSIONS
    out, bias = np.zeros((2, DIMENSIONS), np.float32), np.zeros(2, np.float32)
    steps, done = EPOCHS * len(data), 0
    for _ in range(EPOCHS):
        for k in random.permutation(len(data)):
            at, share = data[k]
            rate = RATE * (1 - done / steps)
            done += 1
            mean = share @ table[at]
            logits = out @ mean + bias
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[labels[k]] -= 1
            back = p @ out
            out -= rate * np.outer(p, mean)
            bias -= 0.05 * rate * p
            table[at] -= rate * share[:, None] * back[None, :]
    return np.concatenate((table @ (out[1] - out[0]), [bias[1] - bias[0]])).astype(np.float32)


def scorer(logits: np.ndarray) -> Callable[[str | None], float]:
    features = Features()

    def score(text: str | None) -> float:
        total, n = 0.0, ZEROS
        for rows in features(text or ""):
            total += float(logits[rows].sum(dtype=np.float64))
            n += len(rows)
        logit = total / n + float(logits[-1])
        return float(1 / (1 + np.exp(-np.clip(logit, -50, 50))))

    return score


def fit_quality(docs: DataFrame, labels: DataFrame) -> np.ndarray:
    """Fit to at most ``SAMPLE_ROWS`` labelled documents outside the held-out fold."""
    return fit_in_a_task(labelled_sample(docs, labels, "quality", SAMPLE_ROWS), train)


def score_quality(docs: DataFrame, logits: np.ndarray) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row.

    Null, empty and very short texts without features get the score of the bias alone; when no
    labelled document was found, every score is close to 1. Repeated rows are scored alike.
    """
    shared = share(docs.sparkSession, logits)
    return scored(docs, lambda: scorer(shared()), KEEP_FROM)


def keep_quality(docs: DataFrame, logits: np.ndarray) -> DataFrame:
    """The documents with a score of at least 0.3, with their columns as they were."""
    bound_batches(docs.sparkSession)
    shared = share(docs.sparkSession, logits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = scorer(shared())
        for batch in batches:
            kept = [score(t) >= KEEP_FROM for t in batch.column("text").to_pylist()]
            yield batch.filter(pa.array(kept, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
