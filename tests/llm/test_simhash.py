import random
import re

import xxhash
from pyspark.sql import functions as F

from rxvigil.llm import queries, simhash
from rxvigil.llm.components import connected_components
from rxvigil.session import written_table
from tests.llm.samples import awkward, awkward_rng, frame, prose, rows

SF = "/root/testdata/sf0.001"


def fingerprint(text):
    lowered = re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode())
    words = re.findall(rb"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if sum(h >> bit & 1 for h in hashes) * 2 > len(hashes))


def brute(given, threshold=2):
    """The smallest key reachable from each row over links of fingerprints."""
    prints = [fingerprint(t) for _, t in given]
    group = list(range(len(given)))

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(given)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= threshold:
                group[find(i)] = find(j)
    least = {}
    for i, (key, _) in enumerate(given):
        if key is not None:
            least[find(i)] = min(key, least.get(find(i), key))
    return sorted((str(k), f"{p:016x}", str(least.get(find(i)))) for i, ((k, _), p) in enumerate(zip(given, prints)))


def test_the_query_equals_brute_force(spark):
    given = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    found = rows(queries.op2_simhash(spark, SF))
    assert sorted((str(r["doc_id"]), r["fingerprint"], str(r["component_id"])) for r in found) == brute(given)


def test_awkward_rows_and_near_copies(spark):
    rng = random.Random(3)
    given, base = awkward(rng), prose(rng, 400).split()
    for i in range(40):
        copy = list(base)
        copy[rng.randrange(len(copy))] = "changed"
        given.append((100 + i, " ".join(copy)))
    found = rows(simhash.components(frame(spark, given)).select("doc_id", simhash.hex_digits().alias("f"), "component_id"))
    assert sorted((str(r["doc_id"]), r["f"], str(r["component_id"])) for r in found) == brute(given)


def test_every_close_pair_shares_an_anchor(spark, monkeypatch):
    rng = random.Random(4)
    values = {rng.getrandbits(64) for _ in range(60)}
    for value in list(values):
        for _ in range(20):
            near = value
            for bit in rng.sample(range(64), rng.randint(1, 4)):
                near ^= 1 << bit
            values.add(near)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    table = spark.createDataFrame([(v,) for v in signed], "fingerprint long")
    want = {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= 2}
    monkeypatch.setattr(simhash, "HOMES_AT_ONCE", 4)  # hot anchors are compared in parts
    found = simhash.links(table).collect()
    assert len(found) == len(want) and {(r.a, r.b) for r in found} == want


def test_components_of_paths_stars_and_loops(spark):
    links = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 100)] + [(5000, 5000), (7, 6), (7, 6)]
    found = {r.node: r.root for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert set(found) == set(range(201)) | set(range(1000, 1100))
    assert len({found[i] for i in range(201)}) == 1 and len({found[i] for i in range(1000, 1100)}) == 1
    assert found[0] != found[1000]
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_one_row_of_each_component_stays(spark):
    given = awkward(awkward_rng())
    kept = rows(simhash.keep_one(frame(spark, given)))
    components = {c for _, _, c in brute(given)}
    assert sorted(str(r["doc_id"]) for r in kept) == sorted(components)


def test_clashing_columns_and_an_empty_table(spark):
    clash = frame(spark, [(1, "a b c d"), (2, "e f g h")]).selectExpr("*", "'x' AS Fingerprint", "'y' AS root", "'z' AS anchor")
    assert rows(simhash.components(clash)) and simhash.keep_one(clash).columns == clash.columns
    assert {r["Fingerprint"] for r in rows(simhash.keep_one(clash))} == {"x"}
    assert rows(simhash.components(clash.limit(0))) == [] and rows(simhash.keep_one(clash.limit(0))) == []


def test_replicas_are_not_broadcast(spark):
    """Each fingerprint has about 60 of them, which Spark's estimate of their size does not know."""
    given = spark.range(3_000).select(F.xxhash64("id").alias("fingerprint"))
    found = simhash.links(written_table(given, "test-fingerprints"))
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan.split("replicate")[0]
