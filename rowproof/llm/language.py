"""Language identification by nearest centroid.

A text is a TF-IDF vector of hashed letter n-grams, of length one. Each language has several
centroids, found by clustering a bounded sample of its texts; a text gets the language of the
centroid with the highest cosine, and is rejected when it lies farther from that centroid than
the language's own texts do. Document frequencies are counted over all texts learned from.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rowproof.llm.ngrams import buckets, gram_hashes, slices
from rowproof.llm.text import bound_batches, free_name, remainder, share
from rowproof.session import settle, settle_measured

BITS = 13
ORDERS = (1, 2, 3)

#: Texts of a language that its centroids are fitted to, and how many centroids it gets.
SAMPLE_PER_LANGUAGE = 400
CENTROIDS = 4

#: A text is rejected below this share of the lowest cosine that 99 % of the sample reach; a
#: text with fewer different n-grams than FULL_GRAMS cannot come as close, and need not.
REJECT_SHARE = 0.5
FULL_GRAMS = 1000

#: Languages whose centroids are shared at once (128 KB each); more are compared block by block.
BLOCK_LANGUAGES = 500

UNDETERMINED = "und"


class Grams:
    """Counts of a text's letter n-grams; all that is no letter counts as one kind of blank."""

    def __init__(self):
        self.letter = np.array([chr(c).isalpha() for c in range(1 << 16)])

    def _letters(self, points: np.ndarray) -> np.ndarray:
        letter = self.letter[np.minimum(points, 0xFFFF)]
        for c in np.unique(points[points > 0xFFFF]).tolist():
            letter[points == c] = chr(c).isalpha()
        return letter

    def __call__(self, text: str) -> np.ndarray | None:
        """Counts by bucket, or None for a text without a letter."""
        counts, lettered = np.zeros(1 << BITS, np.int64), False
        for points, own in slices(text.lower(), max(ORDERS) - 1):
            letter = self._letters(points)
            lettered = lettered or bool(letter[:own].any())
            points = np.where(letter, points, 32).astype(np.uint32)
            for n in ORDERS:
                hashes = gram_hashes(points, n, own)
                counts += np.bincount(buckets(hashes, BITS), minlength=1 << BITS)
        return counts if lettered else None


def _vector(counts: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and values of the TF-IDF vector of length one."""
    at = np.flatnonzero(counts)
    values = (1 + np.log(counts[at])) * idf[at]
    return at, (values / max(np.linalg.norm(values), 1e-12)).astype(np.float32)


def _document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """In how many texts each bucket occurs, and of how many."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, seen = Grams(), np.zeros((1 << BITS) + 1, np.int64)
        for batch in batches:
            for text in batch.column("text").to_pylist():
                counts = grams(text)
                if counts is not None:
                    seen[:-1] += counts > 0
                    seen[-1] += 1
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(seen[at])], ["bucket", "n"])

    counted = texts.mapInArrow(run, "bucket bigint, n bigint")
    seen = np.zeros((1 << BITS) + 1, np.int64)
    # At most one row per bucket.
    for row in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        seen[row["bucket"]] = row["n"]
    return seen[:-1], int(seen[-1])


def _clustered(vectors: np.ndarray, k: int) -> np.ndarray:
    """Spherical k-means from the farthest-first start, the same at every run."""
    centre = vectors.mean(axis=0)
    chosen = [int(np.argmax(vectors @ centre))]
    while len(chosen) < min(k, len(vectors)):
        chosen.append(int(np.argmin((vectors @ vectors[chosen].T).max(axis=1))))
    centroids = vectors[chosen]
    for _ in range(10):
        nearest = np.argmax(vectors @ centroids.T, axis=1)
        sums = np.stack([vectors[nearest == c].sum(axis=0) for c in range(len(centroids))])
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        moved = np.where(norms > 0, sums / np.maximum(norms, 1e-12), centroids)
        if np.allclose(moved, centroids, atol=1e-6):
            break
        centroids = moved
    return centroids.astype(np.float32)


@dataclass(frozen=True)
class LanguageModel:
    """The centroids of one block of languages."""

    idf: np.ndarray
    languages: list[str]  # of each centroid
    centroids: np.ndarray  # buckets x centroids
    least: np.ndarray  # cosine below which a centroid's language is rejected

    def predict(self, grams: Grams, text: str | None) -> tuple[str, float, bool]:
        """Language, cosine and whether the text is rejected."""
        counts = grams(text) if text else None
        if counts is None or not self.languages:
            return UNDETERMINED, 0.0, True
        at, values = _vector(counts, self.idf)
        cosines = values @ self.centroids[at]
        best = int(np.argmax(cosines))
        score = float(min(1.0, max(0.0, cosines[best])))
        near_enough = self.least[best] * min(1.0, math.sqrt(len(at) / FULL_GRAMS))
        return self.languages[best], score, score < near_enough


@dataclass(frozen=True)
class Languages:
    """Fitted centroids as a table (block, lang, centroid, least), however many languages."""

    idf: np.ndarray
    table: DataFrame
    blocks: int

    def models(self) -> Iterator[LanguageModel]:
        """One block after the other, which bounds what is shared with tasks at a time."""
        for k in range(self.blocks):
            found = self.table.filter(F.col("block") == k).select("lang", "centroid", "least").collect()
            rows = sorted(found, key=lambda r: (r["lang"], bytes(r["centroid"])))
            centroids = [np.frombuffer(bytes(r["centroid"]), np.float32) for r in rows]
            yield LanguageModel(
                self.idf, [r["lang"] for r in rows],
                np.ascontiguousarray(np.stack(centroids, axis=1)) if rows else np.zeros((1 << BITS, 0), np.float32),
                np.array([r["least"] for r in rows]),
            )


def fit_languages(docs: DataFrame) -> Languages:
    """Fit to the texts with a language whose crc32(doc_id) mod 4 is not 2.

    Any number of languages is learned: their centroids are a table in blocks of about
    BLOCK_LANGUAGES. Null languages and texts are not learned from.
    """
    bound_batches(docs.sparkSession)
    learned = docs.filter(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & (remainder(F.col("doc_id"), 4) != 2)
    ).select("doc_id", F.col("lang").cast("string").alias("lang"), "text")
    seen, texts = _document_frequencies(learned.select("text"))
    idf = (np.log((1 + texts) / (1 + seen)) + 1).astype(np.float32)

    sizes, measured = settle_measured(learned.groupBy("lang").agg(F.count(F.lit(1)).alias("n")), "languages")
    blocks = max(1, math.ceil(measured["rows"] / BLOCK_LANGUAGES))
    spread = F.pmod(F.xxhash64("doc_id", F.lit("language")), 1 << 30)
    # About twice the sample by hash, then exactly the smallest hashes.
    near = learned.join(sizes, "lang").withColumn("_h", spread).filter(
        F.col("_h") * F.col("n") <= F.lit(2 * SAMPLE_PER_LANGUAGE * (1 << 30))
    )
    order = Window.partitionBy("lang").orderBy("_h", "doc_id", "text")
    sample = near.withColumn("_k", F.row_number().over(order)).filter(
        F.col("_k") <= SAMPLE_PER_LANGUAGE
    ).select("lang", "text")

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        grams, vectors = Grams(), []
        for text in group["text"]:
            counts = grams(text)
            if counts is not None:
                vector = np.zeros(1 << BITS, np.float32)
                at, values = _vector(counts, idf)
                vector[at] = values
                vectors.append(vector)
        names = ["lang", "centroid", "least"]
        if not vectors:
            return pd.DataFrame(columns=names)
        vectors = np.stack(vectors)
        centroids = _clustered(vectors, CENTROIDS)
        own = (vectors @ centroids.T).max(axis=1)
        least = float(REJECT_SHARE * np.quantile(own, 0.01))
        return pd.DataFrame(
            [(group["lang"].iloc[0], c.tobytes(), least) for c in centroids], columns=names
        )

    fitted = sample.groupBy("lang").applyInPandas(fit, "lang string, centroid binary, least double")
    block = F.pmod(F.xxhash64("lang", F.lit("block")), F.lit(blocks)).cast("int")
    return Languages(idf, settle(fitted.withColumn("block", block), "centroids"), blocks)


_BEST = "struct<lang:string,score:double,rejected:boolean>"


def _compared(docs: DataFrame, languages: Languages, name: str) -> DataFrame:
    """``docs`` with a column ``name``: the nearest language of all blocks, its cosine, and
    whether the text is rejected. Of equal cosines the first language in order wins."""
    kind = pa.struct([("lang", pa.string()), ("score", pa.float64()), ("rejected", pa.bool_())])
    rows = docs.withColumn(name, F.lit(None).cast(_BEST))

    def against(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            grams, fitted = Grams(), shared()
            for batch in batches:
                best = []
                for text, old in zip(batch.column("text").to_pylist(), batch.column(name).to_pylist(), strict=True):
                    lang, score, rejected = fitted.predict(grams, text)
                    new = {"lang": lang, "score": score, "rejected": bool(rejected)}
                    if old is None or old["lang"] == UNDETERMINED or (lang != UNDETERMINED and (-score, lang) < (-old["score"], old["lang"])):
                        old = new
                    best.append(old)
                others = [c for c in batch.schema.names if c != name]
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in others), pa.array(best, kind)], [*others, name])
        return run

    for model in languages.models():
        rows = rows.mapInArrow(against(share(docs.sparkSession, model)), rows.schema)
    return rows


def identify(docs: DataFrame, languages: Languages) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, rejected) for every row.

    Null texts and texts without a letter are ``und`` with score 0 and rejected, and so is
    everything when no language was learned. Ties go to the first language in order. Repeated
    rows are judged alike, very long texts whole; an empty table gives an empty result; only
    ``doc_id`` and ``text`` are read.
    """
    bound_batches(docs.sparkSession)
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"), (remainder(F.col("doc_id"), 4) == 2).alias("held_out"))
    return _compared(docs, languages, "_best").select(
        "doc_id", "held_out", F.col("_best.lang").alias("lang_pred"), F.col("_best.score").alias("score"), F.col("_best.rejected").alias("rejected"))


def keep_identified(docs: DataFrame, languages: Languages) -> DataFrame:
    """The documents whose language is not rejected, with their columns as they were.

    Null texts and texts without a letter are rejected; repeated rows stay or go alike.
    """
    bound_batches(docs.sparkSession)
    name = free_name(docs, "_best")
    return _compared(docs, languages, name).filter(~F.col(f"`{name}`.rejected")).drop(name)
