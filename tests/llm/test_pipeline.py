import random

import corpus_pipeline
import pytest

import __spark_entry__ as entry
from rxvigil.llm.simhash import _fingerprint
from tests.llm.samples import awkward, awkward_rng, frame, prose
from tests.llm.test_decontamination import brute, words

SF = "/root/testdata/sf0.001"
STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Tables with planted cases: rude texts, near copies, a shared passage, benchmark text, and awkward rows."""
    rng, path = random.Random(21), tmp_path_factory.mktemp("sf")
    given, labels = [], []
    for i in range(200):
        text = prose(rng, 60).split()
        if i % 4 == 0:
            text[7] = text[30] = "grumbo"
        given.append((500 + i, " ".join(text)))
        labels.append((500 + i, 1, int(i % 4 == 0)))
    item, passage, base = prose(rng, 20), prose(rng, 60), prose(rng, 300).split()
    given += [(1000 + i, f"{prose(rng, 50)} {item} {prose(rng, 20)}") for i in range(3)]
    given += [(2000 + i, f"{prose(rng, 50)} {passage} {prose(rng, 20)}") for i in range(5)]
    given += [(3000 + i, " ".join(base)) for i in range(4)]
    given += awkward(awkward_rng())
    frame(spark, given).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path), given, item, passage


def test_stages_take_effect(spark, folder, tmp_path):
    sf_dir, given, item, passage = folder
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    steps = {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{tmp_path}/{name}")
        before, docs = docs, spark.read.parquet(f"{tmp_path}/{name}")
        steps[name] = docs.collect()
        if name != "packing":
            assert docs.dtypes == before.dtypes
    ids = {n: [r.doc_id for r in kept] for n, kept in steps.items()}
    rude = {500 + i for i in range(0, 200, 4)}
    assert set(range(500, 700)) - rude <= set(ids["toxicity"]) and not rude & set(ids["toxicity"])
    # One document of each group of fingerprints within two bits, the one with the smallest key.
    prints = sorted((r.doc_id is None, r.doc_id or 0, _fingerprint(r.text.encode() if r.text else None, 3)) for r in steps["toxicity"])
    assert ids["simhash"].count(3000) == 1 and not {3001, 3002, 3003} & set(ids["simhash"])
    kept = {_fingerprint(r.text.encode() if r.text else None, 3) for r in steps["simhash"]}
    assert len(kept) == len(steps["simhash"])
    assert all(any((p ^ q).bit_count() <= 2 for q in kept) or len(prints) > len(kept) for *_, p in prints)
    assert sum(passage in (r.text or "") for r in steps["passages"]) == 1
    assert {2000 + i for i in range(5)} <= set(ids["passages"])
    hit = {r.doc_id for r in steps["passages"] if brute(r.text, [(1, item)])[1]}
    assert hit == {1000, 1001, 1002} and set(ids["decontamination"]) == set(ids["passages"]) - hit
    assert sum(r.length for r in steps["packing"] if r.doc_id == 501) == next(r.doc_tokens for r in steps["packing"] if r.doc_id == 501)
    assert set(ids["packing"]) == set(ids["decontamination"])


def test_run_equals_the_stages(spark):
    found = entry.queries()["pipeline"](spark, SF)
    assert found.count() > 0 and "sequence_id" in found.columns


def test_stages_on_an_empty_table(spark, folder):
    docs = spark.read.parquet(f"{folder[0]}/documents.parquet").limit(0)
    for stage in STAGES.values():
        assert stage(spark, docs, folder[0]).count() == 0


def test_extra_columns_are_kept(spark, folder):
    docs = spark.read.parquet(f"{folder[0]}/documents.parquet").selectExpr("*", "'x' AS score", "1 AS fingerprint", "'y' AS hits")
    for name, stage in STAGES.items():
        if name != "packing":
            kept = stage(spark, docs, folder[0])
            assert kept.columns == docs.columns and {r.score for r in kept.select("score").collect()} == {"x"}


def test_words_helper():
    assert words("A-b\tç9") == [b"a", b"b", "ç9".encode()]
