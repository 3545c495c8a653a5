import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest

from rxvigil.llm import oracles, queries, target_sampling
from tests.llm.samples import SCHEMA, awkward, awkward_rng, frame, prose, rows
from tests.oracle import connect, differences

SF = "/root/testdata/sf0.01"


def features(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(target_sampling.WORD, lowered)
    return len(words), words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def plain(docs, target, size=10_000, percent=25):
    """The contract, spelled out; rows of (doc_id, text)."""
    def buckets(text):
        return [zlib.crc32(f.encode()) % size for f in features(text)[1]]

    held = Counter(b for _, t in docs for b in buckets(t))
    wanted = Counter(b for t in target for b in buckets(t))
    s, t = sum(held.values()), sum(wanted.values())
    found = []
    for key, text in docs:
        own = buckets(text)
        gains = [math.floor(1000 * math.log((wanted[b] + 1) * (s + size) / ((held[b] + 1) * (t + size)))) for b in own]
        weight = sum(gains) // len(gains) if gains else 0
        h = int(hashlib.sha256(f"7:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        found.append([key, len(own), weight, score, None, features(text)[0]])
    eligible = sorted((r for r in found if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for place, row in enumerate(eligible[: percent * len(eligible) // 100]):
        row[4] = place + 1
    return Counter(tuple(r[:5]) for r in found)


def result(frame):
    return Counter((r["doc_id"], r["n_features"], r["weight"], r["score"], r["rank"]) for r in rows(frame))


def test_the_query_equals_its_sql(spark):
    assert differences(queries.op11_target_sampling(spark, SF), connect(SF), oracles.OP11_TARGET_SAMPLING) == []


def test_awkward_texts_against_plain_python(spark):
    rng = random.Random(3)
    given = awkward(awkward_rng()) + [(i, prose(rng, rng.randint(0, 60))) for i in range(100, 160)]
    given += [(200, "x" * 300 + " é漢" * 40 + "-" + "漢" * 100), (201, "A B\x00C 7up"), (202, "ÀB àb" * 30)]
    aimed = [prose(rng, 50) for _ in range(5)] + [None, "", given[-1][1]]
    target = spark.createDataFrame([(t,) for t in aimed], "text string")
    assert result(target_sampling.resample(frame(spark, given), target)) == plain(given, aimed)


@pytest.mark.parametrize("characters", [1, 7, 64])
def test_words_and_windows_are_whole_across_slices(spark, characters, monkeypatch):
    monkeypatch.setattr(target_sampling, "SLICE", characters)
    rng = random.Random(4)
    given = [(i, prose(rng, n)) for i, n in enumerate([0, 1, 2, 25, 40, 0, 90])]
    target = spark.createDataFrame([(prose(rng, 30),)], "text string")
    assert result(target_sampling.resample(frame(spark, given), target)) == plain(given, [target.first()[0]])


def test_ties_are_drawn_by_key_and_repeats_each(spark):
    given = [(i // 2, "a b c d " * 6) for i in range(80)]
    none = spark.createDataFrame([], "text string")
    found = rows(target_sampling.resample(frame(spark, given), none))
    assert sorted(r["rank"] for r in found if r["rank"]) == list(range(1, 21))
    assert result(target_sampling.resample(frame(spark, given), none)).total() == 80
    assert {r["n_features"] for r in found} == {47}


def test_short_texts_clashing_columns_and_empty_tables(spark):
    none = spark.createDataFrame([], "text string, key long, place long")
    clash = frame(spark, [(1, "too short"), (2, None)]).selectExpr("*", "1 AS key", "2 AS place", "3 AS score", "4 AS bucket")
    assert result(target_sampling.resample(clash, none)) == plain([(1, "too short"), (2, None)], [])
    assert rows(target_sampling.resample(spark.createDataFrame([], SCHEMA), none)) == []
