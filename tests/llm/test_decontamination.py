import hashlib
import random
import re

from rxvigil.llm import decontamination, queries
from tests.llm.samples import awkward, awkward_rng, frame, prose, rows

SF = "/root/testdata/sf0.001"
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))


def brute(text, items, size=10):
    """Hit words and items of a document, window by window."""
    own, hit, found = words(text), set(), set()
    places = {}
    for i in range(len(own)):
        for n in range(1, size + 1):
            places.setdefault(tuple(own[i : i + n]), []).append(i) if i + n <= len(own) else None
    for item, item_text in items:
        test = words(item_text)
        for i in range(max(1, len(test) - size + 1) if test else 0):
            window = tuple(test[i : i + size])
            for at in places.get(window, ()):
                hit.update(range(at, at + len(window)))
                found.add(item)
    return len(own), len(hit), found


def test_the_query_equals_brute_force(spark):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    found = rows(queries.op10_decontamination(spark, SF))
    assert sorted(r["doc_id"] for r in found) == sorted(texts)
    for r in found:
        n_words, n_hit, names = brute(texts[r["doc_id"]], items)
        digest = hashlib.sha256(",".join(sorted(map(str, names))).encode()).hexdigest()
        assert (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) == (
            n_words, n_hit, len(names), digest, n_hit > 0,
        )
    assert any(r["contaminated"] for r in found)


def planted(rng):
    items = [(1, prose(rng, 25)), (2, "Alpha beta"), (3, None), (4, ""), (2, "gamma delta"), (None, prose(rng, 12)), (5, "x")]
    long = prose(rng, 40)
    items.append((6, long))
    inside = items[0][1].split()
    given = awkward(rng) + [
        (30, prose(rng, 20) + " " + items[0][1].upper() + ". " + prose(rng, 5)),
        (31, " ".join(inside[:9]) + " zz " + " ".join(inside[9:14])),
        (32, "ALPHA, beta gamma-delta alpha beta"),
        (33, " ".join(long.split()[5:15])),
        (34, items[5][1]),
        (35, "y x y x"),
    ]
    return given, items


def test_planted_phrases_in_slices(spark):
    given, items = planted(random.Random(2))
    bench = spark.createDataFrame(items, "item_id long, text string")
    for size in (16 << 20, 60):  # one pass over the index, and several
        index = decontamination.build_index(frame(spark, given), segment_bytes=200)
        found = rows(decontamination.search(index, bench, slice_bytes=size))
        got = sorted(
            (str(r["doc_id"]), r["n_words"], sum(h["past"] - h["first"] for h in r["hits"]), {p["item_id"] for p in r["phrases"]})
            for r in found
        )
        want = []
        for i, text in given:
            n_words, n_hit, names = brute(text, items)
            want.append((str(i), n_words, n_hit, {None if n is None else str(n) for n in names}))
        assert got == sorted(want)


def test_proximity(spark):
    phrase = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    given = [(1, phrase.replace("delta", "delta xx")), (2, phrase), (3, " ".join(reversed(phrase.split()))), (4, phrase[:30])]
    bench = spark.createDataFrame([(1, phrase)], "item_id long, text string")
    found = {r["doc_id"]: r for r in rows(decontamination.search(decontamination.build_index(frame(spark, given)), bench, slop=2))}
    assert [p["item_id"] for p in found[1]["near"]] == ["1"] and not found[1]["hits"]
    assert not found[2]["near"] and found[2]["hits"] == [{"first": 0, "past": 10}]
    assert not found[3]["near"] and not found[4]["near"]


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    found = rows(decontamination.search(decontamination.build_index(frame(spark, [(1, "a b"), (2, None)])), none))
    assert sorted((r["doc_id"], r["n_words"], r["hits"]) for r in found) == [(1, 2, []), (2, 0, [])]
    bench = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert rows(decontamination.search(decontamination.build_index(frame(spark, [])), bench)) == []
