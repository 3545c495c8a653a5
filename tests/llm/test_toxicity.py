import random

import numpy as np
import pytest

from rxvigil.llm import queries, toxicity
from tests.llm.samples import awkward, awkward_rng, frame, prose, rows

SF = "/root/testdata/sf0.01"
RUDE = "grumbo vexling snarf blotch".split()


def corpus(rng, n=240):
    given, labels = [], []
    for i in range(n):
        words = prose(rng, 40).split()
        if i % 3 == 0:
            words[5], words[20] = rng.sample(RUDE, 2)
        given.append((1000 + i, " ".join(words)))
        labels.append((1000 + i, int(i % 3 == 0), i % 4 == 1))
    return given, labels


@pytest.fixture(scope="module")
def fitted(spark):
    given, labels = corpus(random.Random(1))
    table = spark.createDataFrame(labels, "doc_id long, toxic int, calibrates boolean")
    return toxicity.fit(frame(spark, given), table), dict(given), {i: y for i, y, c in labels if not c}


def counts(model, text):
    return toxicity._Counts(model.number).of(text.encode())


def test_neighbours_are_the_exact_nearest(fitted):
    """The block-max search equals cosines computed text by text, in order and with ties by key."""
    model, texts, examples = fitted

    def vector(text):
        out = np.zeros(len(model.idf))
        ids, weights = toxicity._weigh(*counts(model, text), model.idf)
        out[ids] = weights
        return out

    held = {i: vector(texts[i]) for i in examples}
    for key in list(texts)[:60]:
        own = vector(texts[key])
        cosines = sorted((-round(float(own @ v), 9), i) for i, v in held.items() if own @ v > 0)[: model.k]
        near = model.near(*counts(model, texts[key]))
        assert sorted((-round(c, 9), i) for c, i, _ in near) == cosines
        assert all(examples[i] == label for _, i, label in near)


def test_small_blocks_give_the_same_neighbours(fitted):
    model, texts, examples = fitted
    weighed = [(i, y, *toxicity._weigh(*counts(model, texts[i]), model.idf)) for i, y in sorted(examples.items())]
    small, one = (toxicity.Index.build(weighed, len(model.idf), block) for block in (3, 1000))
    for text in list(texts.values())[:40]:
        query = toxicity._weigh(*counts(model, text), model.idf)
        a, b = small.nearest(*query, 5), one.nearest(*query, 5)
        assert [(round(c, 9), i) for c, i, _ in a] == [(round(c, 9), i) for c, i, _ in b]


def test_terms_and_weights_against_a_plain_count(fitted):
    """Every word of the examples is a term; idf counts all documents, relevance the examples alone."""
    model, texts, examples = fitted
    words = {i: set(t.lower().split()) for i, t in texts.items()}
    assert set(model.number) == {w.encode() for i in examples for w in words[i]}
    ones, settings = sum(examples.values()), toxicity.Settings()
    zeros = len(examples) - ones
    for term, at in model.number.items():
        a, b = (sum(term.decode() in words[i] for i, y in examples.items() if y == label) for label in (1, 0))
        df = sum(term.decode() in w for w in words.values())
        table = np.array([[a, b], [ones - a, zeros - b]], float)
        expected = table.sum(0) * table.sum(1)[:, None] / table.sum()
        chi2 = ((table - expected) ** 2 / np.maximum(expected, 1e-12)).sum()
        relevance = max((chi2 / (chi2 + settings.halfway)) ** 2, settings.least_relevance)
        assert abs(model.idf[at] - (np.log((len(texts) + 1) / (df + 1)) + 1) * relevance) < 1e-9


def test_calibration_is_the_best_monotone_fit():
    rng = random.Random(3)
    rows_ = [(int(rng.random() < v), v) for v in (round(rng.random(), 2) for _ in range(400))] + [(1, None), (0, None), (0, None)]
    model = toxicity.Model({}, np.zeros(0), None, 5, np.zeros(0), np.zeros(0), 0.5).calibrated(rows_)
    assert model.bare == (1 + 0.5) / 4 and (np.diff(model.rates) >= 0).all() and (np.diff(model.votes) >= 0).all()
    # The largest-lower-mean form of isotonic regression, without the smoothing.
    voted = sorted((v, y) for y, v in rows_ if v is not None)
    labels = [y for _, y in voted]
    for at in range(0, len(voted), 37):
        best = max(min(np.mean(labels[i : j + 1]) for j in range(at, len(labels))) for i in range(at + 1))
        assert abs(float(np.interp(voted[at][0], model.votes, model.rates)) - best) < 0.35


def test_repeated_labelled_keys_give_the_same_fit(spark):
    given, labels = corpus(random.Random(4), 60)
    given += [(1000, "zz grumbo"), (1000, "aa plain"), (1000, None)]
    table = spark.createDataFrame(labels, "doc_id long, toxic int, calibrates boolean")
    fits = [toxicity.fit(frame(spark, given).repartition(n), table) for n in (1, 3, 7)]
    assert all(f.number == fits[0].number and np.array_equal(f.idf, fits[0].idf) for f in fits)
    assert b"aa" in fits[0].number and b"zz" not in fits[0].number


def test_scores_and_evidence(spark, fitted):
    model = fitted[0]
    rng = random.Random(9)
    given = awkward(awkward_rng()) + [(50, prose(rng, 30) + " Grumbo " + prose(rng, 30) + " SNARF!"), (51, prose(rng, 60))]
    found = rows(toxicity.apply(frame(spark, given), model))
    assert len(found) == len(given) and all(0 <= r["score"] <= 1 for r in found)
    by_id = {r["doc_id"]: r for r in found}
    assert by_id[50]["score"] > 0.8 and all(e["label"] == 1 for e in by_id[50]["evidence"])
    assert by_id[51]["score"] < 0.2
    assert by_id[1]["score"] == by_id[2]["score"] == model.bare and by_id[1]["evidence"] == []
    assert len({r["score"] for r in found if r["doc_id"] == 4}) == 1


def test_held_out_accuracy_of_the_query(spark):
    found = {r["doc_id"]: r for r in rows(queries.op5_toxicity(spark, SF))}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert len(found) == spark.read.parquet(f"{SF}/documents.parquet").count()
    held = [(found[i], y) for i, y in labels.items() if found[i]["held_out"]]
    right = sum(r["predicted"] == y for r, y in held)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    worded = [r for i, r in found.items() if toxicity.plain_words(texts[i].encode())]
    assert sum(not r["evidence"] for r in worded) < 0.02 * len(worded)
    assert right / len(held) > 0.85 and all(r["predicted"] == int(r["score"] >= 0.3) for r in found.values())


def test_held_out_labels_do_not_matter(spark):
    labels = queries.toxicity_labels(spark, SF)
    assert labels.filter(queries.quarter() == 2).count() == 0 and labels.filter(queries.quarter() == 3).count() > 0


def test_no_labels_clashes_and_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    clash = frame(spark, [(1, "a b"), (2, None)]).selectExpr("*", "'x' AS Score", "'y' AS key", "'z' AS term")
    found = rows(toxicity.apply(clash, toxicity.fit(clash, none)))
    assert [r["score"] for r in found] == [0.5, 0.5] and {(r["key"], r["term"]) for r in found} == {("y", "z")}
    odd = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (2, None), (3, 7)], "doc_id long, toxic int")
    assert len(rows(toxicity.apply(clash, toxicity.fit(clash, odd)))) == 2
    assert rows(toxicity.apply(clash.limit(0), toxicity.fit(clash.limit(0), none))) == []
