import random
import re

from rxvigil.llm import licences, queries
from rxvigil.llm.licences import Notice
from tests.llm.samples import awkward, awkward_rng, frame, prose, rows
from tests.llm.test_decontamination import words

SF = "/root/testdata/sf0.01"
PHRASES = {"mit": "under the mit license", "apache-2": "apache license version 2", "cc-by-nc": "cc by nc"}


def brute(text):
    own = words(text)
    places = []
    for label, phrase in PHRASES.items():
        wanted = phrase.encode().split()
        places += [(i, label) for i in range(len(own)) if own[i : i + len(wanted)] == wanted]
    starts = sorted(i for i, _ in places)
    return len(own), len(places), *((starts[0], starts[-1]) if starts else (None, None)), ",".join(sorted({l for _, l in places}))


def digest(r):
    return r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]


def test_base_places_equal_brute_force(spark):
    found = rows(queries.op9_licences(spark, SF))
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert len(found) == len(texts)
    for r in found:
        assert digest(r) == brute(texts[r["doc_id"]])
        assert set(r["base_labels"].split(",")) - {""} <= set(r["labels"].split(","))
        assert 0 <= r["score"] <= 1 and (r["score"] > 0) == bool(r["labels"])
    assert any(r["n_base"] for r in found) and any("gpl-3" in r["labels"] for r in found)


def places(spark, texts, notices):
    found = licences.scan(frame(spark, list(enumerate(texts))), notices, carry=["doc_id"])
    return {r["doc_id"]: r["places"] for r in rows(found)}


def edited(rng, text, edits):
    for _ in range(edits):
        at, kind = rng.randrange(1, len(text) - 1), rng.randrange(3)
        text = text[:at] + ("" if kind == 0 else "q") + text[at + (kind != 1) :]
    return text


def test_every_notice_within_its_errors_is_found(spark):
    rng = random.Random(6)
    notice = Notice("gpl", "under the gnu general public license version", "3", 4)
    texts = [f"{prose(rng, 30)}. {edited(rng, notice.words, n % 5)} 3 {prose(rng, 20)}" for n in range(60)]
    found = places(spark, texts, (notice,))
    for i, text in enumerate(texts):
        assert len(found[i]) == 1 and found[i][0]["errors"] <= i % 5
        own = [w.decode() for w in words(text)]
        assert " ".join(own[found[i][0]["first"] : found[i][0]["past"]]) == found[i][0]["passage"]


def test_versions_are_not_mixed_up_and_clean_text_is_left_alone(spark):
    rng = random.Random(7)
    notices = (*licences.PHRASES, *licences.NOTICES)
    texts = [
        "This work is licensed under the GNU General Public License, version 3.",
        "licensed under the GNU General Public Licence version 2 or later",
        "Released   under\nthe M.I.T. License; cc by-nc-sa, CC-BY-NC",
        "license version", prose(rng, 5000), "the mit license under", None, "",
    ]
    found = places(spark, texts, notices)
    labels = {i: {p["label"] for p in found[i]} for i in found}
    assert labels[0] == {"gpl-3"} and labels[1] == {"gpl-2"} and labels[2] == {"mit", "cc-by-nc"}
    assert all(not labels[i] for i in range(3, 8))


def test_overlapping_places_count(spark):
    found = places(spark, ["ab ab ab ab", "xab ab abx ab"], (Notice("ab", "ab ab", base=True),))
    assert [(p["first"], p["past"]) for p in found[0]] == [(0, 2), (1, 3), (2, 4)] and found[1] == []


def test_awkward_rows_clashes_and_an_empty_table(spark):
    given = awkward(awkward_rng())
    clash = frame(spark, given).selectExpr("*", "1 AS Places", "2 AS n_words", "'x' AS label")
    found = rows(licences.scan(clash))
    assert len(found) == len(given)
    assert sorted(r["n_words"] for r in found) == sorted(len(words(t)) for _, t in given)
    assert rows(licences.scan(clash.limit(0))) == []
    assert re.search("label", " ".join(found[0]))


def test_a_fuzzy_notice_right_before_a_better_one(spark):
    notice = Notice("mit", "released under the mit license", errors=3)
    found = places(spark, ["relesed undr the mit license y released under the mit license"], (notice,))
    assert [(p["first"], p["past"], p["errors"]) for p in found[0]] == [(0, 5, 2), (6, 11, 0)]
