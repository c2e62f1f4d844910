"""Toxicity by weak supervision.

Many voters look at a text: each term of a lexicon votes toxic where it occurs, and so does each
word beginning of a mined list; other patterns vote either way or abstain. A generative model estimates, by expectation maximisation, how often
each voter votes what given the hidden label, and from what is left unexplained which voters
go together; correlated voters share their weight. Its posterior labels train a linear
classifier on words, which scores all documents.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame

from rowproof.llm.labelled import fit_in_a_task, labelled_sample, scored
from rowproof.llm.text import ALNUM_WORDS, share

#: Lengths, in bytes, of the word beginnings that count as patterns.
STEMS = (4, 5, 6, 7, 8)

#: Labelled documents the models are fitted to, at most.
SAMPLE_ROWS = 6000

#: Terms mined from the sample that join the lexicon, and words the classifier may use.
MINED_TERMS = 100
CLASSIFIER_WORDS = 2048

#: Steps of gradient descent.
STEPS = 600

TOXIC_FROM = 0.5

# Common English terms of abuse.
LEXICON = (
    "awful bastard clown coward crap creep cretin damn dimwit disgusting dumb fool freak garbage "
    "hate hateful idiot idiotic imbecile jerk kill liar loser lunatic moron moronic nasty pathetic "
    "pig psycho rat retard rubbish scum scumbag shit shut sick stupid sucker trash ugly useless "
    "vermin vile weirdo worthless wretch"
).split()

_YOU = re.compile(rb"\byou(?:r|'re| are)?\b", re.I)
_SHOUTED = re.compile(rb"[A-Z]{4,}[^\n]{0,40}!")
_STRUNG = re.compile(rb"[!?]{3,}")
ABSTAIN, CLEAN, TOXIC = 0, 1, 2

#: Correlation, given the label, from which voters share their weight.
CORRELATED = 0.2


def words_of(text: str | None) -> set[bytes]:
    """Distinct words, A-Z lower-cased, without punctuation, and their beginnings.

    A beginning ends in ``*``: languages that inflect hang many endings on one term of abuse.
    """
    words = set((text or "").encode("utf-8", "replace").translate(ALNUM_WORDS).split())
    return words.union(*({w[:n] + b"*" for w in words if len(w) > n} for n in STEMS))


def votes(text: str, words: set[bytes], lexicon: list[bytes]) -> list[int]:
    """One vote of each term, then one of each pattern."""
    body = text.encode("utf-8", "replace")
    named = [TOXIC if term in words else ABSTAIN for term in lexicon]
    found = sum(v == TOXIC for v in named)
    return named + [
        TOXIC if found >= 2 else ABSTAIN,
        CLEAN if found == 0 else ABSTAIN,
        TOXIC if found and _YOU.search(body) else ABSTAIN,
        TOXIC if _SHOUTED.search(body) else ABSTAIN,
        TOXIC if _STRUNG.search(body) else ABSTAIN,
        CLEAN if b"!" not in body else ABSTAIN,
    ]


@dataclass(frozen=True)
class LabelModel:
    prior: float
    likelihood: np.ndarray  # voters x label x vote
    correlation: np.ndarray  # voters x voters, given the label
    weight: np.ndarray  # of each voter, less for those that go with others

    def posterior(self, cast: np.ndarray) -> np.ndarray:
        ratio = np.log(self.likelihood[:, 1]) - np.log(self.likelihood[:, 0])
        evidence = ratio[np.arange(cast.shape[1])[None, :], cast]
        logit = np.log(self.prior / (1 - self.prior)) + evidence @ self.weight
        return 1 / (1 + np.exp(-np.clip(logit, -50, 50)))


def fit_label_model(cast: np.ndarray, known: np.ndarray, rounds: int = 20) -> LabelModel:
    """Expectation maximisation over the votes; ``known`` labels (0 or 1, else -1) stay fixed."""
    n, voters = cast.shape
    toxic_votes, clean_votes = (cast == TOXIC).sum(axis=1), (cast == CLEAN).sum(axis=1)
    belief = np.where(known >= 0, known, np.clip(0.5 + 0.25 * (toxic_votes - clean_votes), 0.05, 0.95))
    chosen = np.stack([cast == v for v in (ABSTAIN, CLEAN, TOXIC)], axis=2).astype(np.float64)
    weight, correlation = np.ones(voters), np.eye(voters)
    for _ in range(rounds):
        both = np.stack((1 - belief, belief))
        counts = np.einsum("yn,njv->jyv", both, chosen) + 0.5
        likelihood = counts / counts.sum(axis=2, keepdims=True)
        prior = float((belief.sum() + 1) / (n + 2))
        # What the label leaves unexplained of each vote, and how it goes together.
        signed = chosen[:, :, TOXIC] - chosen[:, :, CLEAN]
        mean = likelihood[:, :, TOXIC] - likelihood[:, :, CLEAN]
        rest = signed - both.T @ mean.T
        spread = np.sqrt((rest ** 2).mean(axis=0)) + 1e-6
        correlation = (rest.T @ rest) / n / np.outer(spread, spread)
        np.fill_diagonal(correlation, 1)
        # Voters that tend to exclude each other are no repetition and keep their weight.
        shared = np.where(correlation > CORRELATED, correlation, 0)
        weight = 1 / shared.sum(axis=1)
        model = LabelModel(prior, likelihood, correlation, weight)
        belief = np.where(known >= 0, known, model.posterior(cast))
    return model


@dataclass(frozen=True)
class Classifier:
    bias: float
    weight: dict[bytes, float]

    def score(self, text: str | None) -> float:
        known = self.weight
        logit = self.bias + sum(known[w] for w in words_of(text) if w in known)
        return float(1 / (1 + np.exp(-np.clip(logit, -50, 50))))


def mined_terms(bags: list[set[bytes]], labels: np.ndarray) -> list[bytes]:
    """Words of toxic documents that hardly occur in others, the most frequent first."""
    toxic, clean = Counter(), Counter()
    for bag, y in zip(bags, labels, strict=True):
        (toxic if y else clean).update(bag)
    n_toxic, n_clean = max(1, int(labels.sum())), max(1, int((labels == 0).sum()))
    good = [
        word for word, n in toxic.items()
        if n >= max(5, 0.005 * n_toxic) and n / n_toxic >= 20 * (clean[word] + 0.5) / n_clean
    ]
    good = most_specific(good, {word: (toxic[word], clean[word]) for word in good})
    return sorted(good, key=lambda word: (-toxic[word], word))[:MINED_TERMS]


def most_specific(words: list[bytes], seen: dict[bytes, tuple[int, int]]) -> list[bytes]:
    """Of a word and its beginnings that occur equally often, only the longest."""
    longest: dict[tuple, bytes] = {}
    for word in words:
        key = (word[:STEMS[0]], *seen[word])
        if len(word.rstrip(b"*")) > len(longest.get(key, b"").rstrip(b"*")) or (
            word.rstrip(b"*") == longest[key].rstrip(b"*") and not word.endswith(b"*")
        ):
            longest[key] = word
    return list(longest.values())


def train(rows: Iterator[tuple[str, int]]) -> tuple[float, dict[bytes, float]]:
    """Bias and word weights of the classifier."""
    texts, labels = [], []
    for text, y in rows:
        texts.append(text)
        labels.append(int(y > 0))
    y = np.array(labels, np.int64)
    if not len(y):
        return -50.0, {}
    bags = [words_of(t) for t in texts]
    # Two thirds of the labels mine voters and anchor the model. It estimates how good and how
    # alike voters are with the labels of the last third unseen, and judges all by votes alone.
    seen = np.arange(len(y)) % 3 != 2
    terms = mined_terms([b for b, s in zip(bags, seen, strict=True) if s], y[seen])
    lexicon = sorted({w.encode() for w in LEXICON} | set(terms))
    cast = np.array([votes(t, b, lexicon) for t, b in zip(texts, bags, strict=True)], np.int64)
    known = np.where(seen, y, -1)
    target = fit_label_model(cast, known).posterior(cast)
    return _linear(bags, target)


def _linear(bags: list[set[bytes]], target: np.ndarray) -> tuple[float, dict[bytes, float]]:
    """Logistic regression on the presence of words that go with the posterior label."""
    n, hard = len(bags), target >= 0.5
    seen, toxic = Counter(), Counter()
    for bag, t in zip(bags, hard, strict=True):
        seen.update(bag)
        if t:
            toxic.update(bag)
    share = max(1.0 / n, hard.mean())
    telling: dict[bytes, float] = {}
    for word, k in seen.items():
        if k >= 5:
            expected = k * share
            surplus = (toxic[word] - expected) ** 2 / (expected * max(1e-9, 1 - share))
            if surplus > 20:
                telling[word] = surplus
    kept = most_specific(list(telling), {w: (seen[w], toxic[w]) for w in telling})
    kept = sorted(kept, key=lambda w: (-telling[w], w))[:CLASSIFIER_WORDS]
    vocabulary = {word: j for j, word in enumerate(kept)}
    x = np.zeros((n, len(vocabulary)), np.float32)
    for i, bag in enumerate(bags):
        x[i, [vocabulary[w] for w in bag & vocabulary.keys()]] = 1
    weight, bias = np.zeros(x.shape[1], np.float32), float(np.log(share / max(1e-6, 1 - share)))
    moved, moved_bias = np.zeros_like(weight), 0.0
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-np.clip(x @ weight + bias, -50, 50)))
        error = ((p - target) / n).astype(np.float32)
        moved = 0.9 * moved - 8.0 * (x.T @ error + 1e-5 * weight)
        moved_bias = 0.9 * moved_bias - 8.0 * float(error.sum())
        weight, bias = weight + moved, bias + moved_bias
    return bias, {w: float(weight[j]) for w, j in vocabulary.items()}


def fit_toxicity(docs: DataFrame, labels: DataFrame) -> Classifier:
    """Fit to at most ``SAMPLE_ROWS`` labelled documents outside the held-out fold."""
    return Classifier(*fit_in_a_task(labelled_sample(docs, labels, "toxic", SAMPLE_ROWS), train))


def score_toxicity(docs: DataFrame, classifier: Classifier) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row.

    Null and empty texts have no words and get the score of the bias alone; when no labelled
    document was found, every score is close to 0. Repeated rows are scored alike.
    """
    shared = share(docs.sparkSession, classifier)

    def scorer() -> Callable[[str | None], float]:
        return shared().score

    return scored(docs, scorer, TOXIC_FROM)
