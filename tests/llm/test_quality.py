import math
import re
from collections import Counter

import xxhash

from rxvigil.llm import quality, queries
from tests.llm.samples import awkward, awkward_rng, frame, rows

SF = "/root/testdata/sf0.01"


def test_the_query_keeps_good_documents(spark):
    found = {r["doc_id"]: r for r in rows(queries.op7_quality(spark, SF))}
    labels = [(r.doc_id, r.quality) for r in spark.read.parquet(f"{SF}/labels.parquet").collect()]
    share = sum(q for _, q in labels) / len(labels)
    assert sum(r["selected"] for r in found.values()) == round(share * len(found))
    kept = {y: [found[i]["selected"] for i, q in labels if q == y] for y in (0, 1)}
    assert sum(kept[1]) / len(kept[1]) > 0.95 and sum(kept[0]) / len(kept[0]) < 0.3
    # Exactly the largest draws are selected.
    least = min(r["draw"] for r in found.values() if r["selected"])
    assert all(r["draw"] <= least for r in found.values() if not r["selected"])


def test_draws_follow_the_weights(spark):
    """Two kinds of text with known weights are drawn first in proportion to them."""
    table = frame(spark, [(i, "up" if i % 2 else "down") for i in range(4000)])
    targets = spark.createDataFrame([(i,) for i in range(4000) if i % 2 or i % 8 == 0], "doc_id long")
    found = rows(quality.resample(table, targets, 0.1, quality.Settings(targets=10_000)))
    weight = {r["doc_id"] % 2: math.exp(r["log_weight"]) for r in found}
    picked = [r["doc_id"] % 2 for r in found if r["selected"]]
    assert len(picked) == 400
    assert abs(sum(picked) / 400 - weight[1] / (weight[0] + weight[1])) < 0.07


def test_awkward_rows_ties_and_repeats(spark):
    given = awkward(awkward_rng()) + [(70, "same")] * 20
    targets = spark.createDataFrame([(4,), (4,), (None,)], "doc_id long")
    for share in (0.0, 0.4, 1.0):
        found = rows(quality.resample(frame(spark, given), targets, share))
        assert len(found) == len(given) and sum(r["selected"] for r in found) == round(share * len(given))
    assert len({r["draw"] for r in found if r["doc_id"] == 70}) == 1


def test_no_targets_clashes_and_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long")
    clash = frame(spark, [(1, "a b"), (2, None)]).selectExpr("*", "1 AS draw", "2 AS key", "3 AS target")
    assert [r["log_weight"] for r in rows(quality.resample(clash, none, 0.5))] == [0.0, 0.0]
    assert rows(quality.resample(clash.limit(0), none, 0.5)) == []


def test_weights_against_plain_counting(spark):
    """Both models counted text by text, with every bucket smoothed by one."""
    given = awkward(awkward_rng())[:-4] + [(100 + i, f"word{i % 7} tail {'x' * (i % 3)}, end-{i % 5}!") for i in range(40)]
    chosen = {100, 101, 105, 112, 4}
    targets = spark.createDataFrame([(k,) for k in chosen], "doc_id long")
    size = quality.Settings().buckets

    def buckets(text):
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode()
        tokens = re.findall(rb"[0-9a-z\x80-\xff]+|[^\s0-9a-z\x80-\xff]+", lowered)
        one = [xxhash.xxh64_intdigest(t) for t in tokens]
        two = [(a * 0x9E3779B97F4A7C15 + b) % 2**64 for a, b in zip(one, one[1:])]
        return [h % size for h in one + [h ^ h >> 31 for h in two]]

    raw, wanted = Counter(), Counter()
    for key, text in given:
        raw.update(buckets(text))
        wanted.update(buckets(text) if key in chosen else [])
    total = [sum(c.values()) + size for c in (wanted, raw)]
    expected = sorted(
        (str(key), round(sum(math.log((wanted[b] + 1) / total[0]) - math.log((raw[b] + 1) / total[1]) for b in buckets(text)), 6))
        for key, text in given
    )
    found = rows(quality.resample(frame(spark, given), targets, 0.3))
    assert sorted((str(r["doc_id"]), round(r["log_weight"], 6)) for r in found) == expected
