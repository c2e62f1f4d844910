import zlib

import numpy as np
import pytest

from rowproof.llm import language, ngrams, quality_model, toxicity

from llm_samples import ODD, documents, prose

LETTERS = {"xx": "abcdefg", "yy": "mnopqrs", "zz": "tuvwxyzé"}


def text_of(lang, seed, words=60):
    random = np.random.default_rng(seed)
    return " ".join("".join(random.choice(list(LETTERS[lang]), 5)) for _ in range(words))


def fold(doc_id, k):
    return zlib.crc32(str("" if doc_id is None else doc_id).encode()) % k


def test_word_hashes_depend_on_the_word_alone():
    hasher = ngrams.WordHasher()
    a = hasher(ngrams.code_points("one two  one\nthree"))
    assert len(a) == 4 and a[0] == a[2] and len(set(a.tolist())) == 3
    assert hasher(ngrams.code_points("zzz one"))[1] == a[0]
    assert len(hasher(ngrams.code_points(" \n"))) == 0


def test_slices_hash_like_the_whole(monkeypatch):
    text = prose(3, 200) + " 漢字😀"
    whole = language.Grams()(text)
    monkeypatch.setattr(ngrams, "SLICE_CHARS", 17)
    assert (language.Grams()(text) == whole).all()


def test_language(spark):
    langs = sorted(LETTERS)
    rows = [(k, text_of(langs[k % 3], k), langs[k % 3]) for k in range(300, 540)]
    docs = documents(spark, rows + [(i, t, None) for i, t in ODD] + [(900, "12 34 !?"), (901, "漢字漢字漢字漢字" * 40)])
    model = language.fit_languages(docs)
    found = language.identify(docs, model).collect()
    assert len(found) == len(rows) + len(ODD) + 2
    truth = {i: lang for i, _, lang in rows}
    for r in found:
        assert r.held_out == (fold(r.doc_id, 4) == 2)
        assert 0 <= r.score <= 1 and r.lang_pred in (*langs, "und")
    by = {r.doc_id: r for r in found}
    assert all(by[i].lang_pred == lang and not by[i].rejected for i, lang in truth.items())
    assert all(by[i].lang_pred == "und" and by[i].rejected for i in (1, 2, 3, 8, 900))
    assert by[901].rejected and by[901].lang_pred != "und"
    kept = language.keep_identified(docs, model)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.select("doc_id").collect()} >= set(truth)


def test_language_does_not_learn_from_the_held_out(spark):
    held = [k for k in range(400) if fold(k, 4) == 2]
    docs = documents(spark, [(k, text_of("xx", k), "xx") for k in held])
    assert {r.lang_pred for r in language.identify(docs, language.fit_languages(docs)).collect()} == {"und"}


def test_language_of_an_empty_table(spark):
    docs = documents(spark, [])
    assert language.identify(docs, language.fit_languages(docs)).collect() == []


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


def held_out_accuracy(found, truth):
    known = [(r.predicted, truth[r.doc_id]) for r in found if r.held_out and r.doc_id in truth]
    return np.mean([p == y for p, y in known])


@pytest.fixture(scope="module")
def judged(spark):
    rows, good, toxic = [], {}, {}
    for k in range(400):
        text = prose(k, 80)
        good[k], toxic[k] = int(k % 4 != 0), int(k % 5 == 1)
        if not good[k]:
            text = text.upper().replace(" ", "!! ")
        if toxic[k]:
            text += (" you Idiot", " zagloba", " zaglobi!", " STUPID")[k % 4]
        rows.append((k, text))
    docs = documents(spark, rows + [(1000 + (i or 0) if i is not None else None, t) for i, t in ODD])
    return docs, labels(spark, [(k, good[k], toxic[k]) for k in range(400)] + [(None, 1, 1), (5000, 0, 1), (7, None, None)]), good, toxic


def test_quality(judged):
    docs, known, good, _ = judged
    logits = quality_model.fit_quality(docs, known)
    found = quality_model.score_quality(docs, logits).collect()
    assert len(found) == docs.count()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) and r.held_out == (fold(r.doc_id, 5) == 0) for r in found)
    assert held_out_accuracy(found, good) > 0.95
    kept = quality_model.keep_quality(docs, logits)
    assert kept.columns == docs.columns and kept.count() == sum(r.predicted for r in found)


def test_toxicity(judged):
    docs, known, _, toxic = judged
    found = toxicity.score_toxicity(docs, toxicity.fit_toxicity(docs, known)).collect()
    assert len(found) == docs.count()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in found)
    assert held_out_accuracy(found, toxic) > 0.95
    assert all(r.predicted == 0 for r in found if r.doc_id is None or r.doc_id >= 1000)


def test_label_model_finds_accuracies_and_correlations():
    random = np.random.default_rng(5)
    y = random.random(4000) < 0.3
    right = lambda p: np.where(random.random(4000) < p, y, ~y)
    votes = [np.where(right(p), toxicity.TOXIC, toxicity.CLEAN) for p in (0.9, 0.8, 0.7, 0.6)]
    votes.append(votes[2])  # a copy of the third
    cast = np.stack(votes, axis=1)
    model = toxicity.fit_label_model(cast, np.where(np.arange(4000) < 400, y, -1))
    accuracy = model.likelihood[:, 1, toxicity.TOXIC]
    assert np.allclose(accuracy[:4], (0.9, 0.8, 0.7, 0.6), atol=0.1)
    assert model.correlation[2, 4] > 0.9 and model.correlation[0, 1] < 0.1
    assert model.weight[2] < 0.6 < 0.9 < model.weight[0]
    assert np.mean((model.posterior(cast) >= 0.5) == y) > 0.9


def test_without_labels_and_without_documents(spark):
    docs, none = documents(spark, ODD), labels(spark, [])
    assert {r.predicted for r in quality_model.score_quality(docs, quality_model.fit_quality(docs, none)).collect()} == {1}
    assert {r.predicted for r in toxicity.score_toxicity(docs, toxicity.fit_toxicity(docs, none)).collect()} == {0}
    empty = documents(spark, [])
    assert quality_model.score_quality(empty, quality_model.fit_quality(empty, none)).collect() == []
    assert toxicity.score_toxicity(empty, toxicity.fit_toxicity(empty, none)).collect() == []


def test_repeated_ids_and_labels_teach_once(spark):
    docs = documents(spark, [(k % 10, prose(k, 20)) for k in range(100)])
    known = labels(spark, [(k % 10, 1, 0) for k in range(50)])
    from rowproof.llm.labelled import labelled_sample

    sample = labelled_sample(docs, known, "quality", 1000).collect()
    assert len(sample) == len({r.doc_id for r in sample}) == sum(fold(k, 5) != 0 for k in range(10))


@pytest.mark.parametrize("block", [500, 3])
def test_more_languages_than_one_block_holds(spark, monkeypatch, block):
    # Eight languages with letters of their own; blocks of three give the same as one block.
    rows = [(100 * k + j, " ".join(chr(97 + 3 * k + (j + i) % 3) * 4 for i in range(60)), f"l{k}") for k in range(8) for j in range(30)]
    docs = documents(spark, rows + [(9000, "", None), (9001, None, None), (9002, "1 2 3", None)])
    monkeypatch.setattr(language, "BLOCK_LANGUAGES", block)
    fitted = language.fit_languages(docs)
    assert fitted.blocks == (1 if block == 500 else 3)
    found = {r.doc_id: r for r in language.identify(docs, fitted).collect()}
    assert all(found[i].lang_pred == lang for i, _, lang in rows)
    assert {found[i].lang_pred for i in (9000, 9001, 9002)} == {"und"}
    kept = language.keep_identified(docs, fitted)
    assert kept.columns == docs.columns and kept.count() == len(rows)


def test_scores_equal_a_plain_computation(spark):
    rows = [(k, " ".join(WORDS[lang][(k + i) % len(WORDS[lang])] for i in range(40)), lang) for k, lang in enumerate(["en", "de"] * 20)]
    docs = documents(spark, rows)
    fitted = language.fit_languages(docs)
    model = next(fitted.models())
    learned = [t for i, t, _ in rows if fold(i, 4) != 2]
    buckets = lambda t: language.Grams()(t)
    seen = sum((buckets(t) > 0).astype(int) for t in learned)
    idf = np.log((1 + len(learned)) / (1 + seen)) + 1
    for r in language.identify(docs, fitted).collect():
        counts = buckets(dict((i, t) for i, t, _ in rows)[r.doc_id])
        vector = np.where(counts > 0, (1 + np.log(np.maximum(counts, 1))) * idf, 0)
        cosines = (vector / np.linalg.norm(vector)) @ model.centroids
        assert r.lang_pred == model.languages[int(np.argmax(cosines))]
        assert abs(r.score - cosines.max()) < 1e-4


WORDS = {"en": "the quick brown fox jumps over lazy dogs while reading".split(), "de": "der schnelle braune fuchs springt über faule hunde beim lesen".split()}
