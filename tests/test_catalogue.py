import itertools
import random

import pytest
from pyspark.sql import functions as F

from rxvigil.operators import accepted_catalogue, check_rules, rejected, rejection_envelopes, validate_catalogue
from rxvigil.functions import transition_allowed
from tests.builders import at, change, changelog
from tests.fold import ALLOWED, loop_verdicts

STATUSES = ["PENDING", "ACTIVE", "SUSPENDED", "WITHDRAWN"]


def verdicts_by_key(df):
    found = {}
    for r in df.select("key", "offset", "verdict").collect():
        found.setdefault(r.key, {})[r.offset] = r.verdict
    return {k: [v for _, v in sorted(rows.items())] for k, rows in found.items()}


def test_every_history_up_to_five_updates(spark):
    rows, expected = [], {}
    for n, moves in enumerate(itertools.product([*STATUSES, None], repeat=5)):
        key = f"k{n}"
        rows += [change(key, i, m, delete=m is None) for i, m in enumerate(moves)]
        expected[key] = loop_verdicts([(m is None, m, None) for m in moves])[0]
    df = changelog(spark, rows)
    assert verdicts_by_key(validate_catalogue(df)) == expected


def random_history(rng, key, n, delete_rate):
    rows, history = [], []
    for offset in range(n):
        delete = rng.random() < delete_rate
        status = rng.choices(STATUSES, [3, 3, 3, 0.2])[0]
        blank = rng.random() < 0.1
        rows.append(change(key, offset, None if delete else status, delete, narc=" " if blank else None))
        history.append((delete, status, "NARCOTICS_CATEGORY_BLANK" if blank and not delete else None))
    return rows, loop_verdicts(history)[0]


@pytest.mark.parametrize("rows_per_task", [7, 60, 100_000])
def test_hot_keys_in_slices_equal_the_loop(spark, rows_per_task):
    rng = random.Random(rows_per_task)
    rows, expected = [], {}
    for key, n, rate in [("hot", 700, 0.01), ("busy", 300, 0.1), ("dead", 300, 0.0), ("small", 5, 0.2)]:
        more, expected[key] = random_history(rng, key, n, rate)
        rows += more
    rng.shuffle(rows)
    got = validate_catalogue(
        changelog(spark, rows), rows_per_task=rows_per_task
    )
    assert verdicts_by_key(got) == expected


def test_slices_with_equal_times_follow_the_offset(spark):
    rng = random.Random(5)
    rows, expected = random_history(rng, "hot", 400, 0.02)
    rows = [r[:4] + (at(0),) + r[5:] for r in rows]
    got = validate_catalogue(changelog(spark, rows), rows_per_task=30)
    assert verdicts_by_key(got) == {"hot": expected}


def test_rejected_update_does_not_become_the_previous_one(spark):
    rows = [change("k", i, s) for i, s in enumerate(["ACTIVE", "PENDING", "SUSPENDED"])]
    assert verdicts_by_key(validate_catalogue(changelog(spark, rows)))["k"] == [
        "OK", "ILLEGAL_STATUS_TRANSITION", "OK"
    ]


def test_withdrawn_is_final_until_deleted(spark):
    rows = [change("w", i, s) for i, s in enumerate(
        ["PENDING", "ACTIVE", "SUSPENDED", "ACTIVE", "WITHDRAWN", "ACTIVE"])]
    rows += [change("t", 0, "WITHDRAWN"), change("t", 1, None, delete=True), change("t", 2, "ACTIVE")]
    got = verdicts_by_key(validate_catalogue(changelog(spark, rows)))
    assert got["w"] == ["OK"] * 5 + ["ILLEGAL_STATUS_TRANSITION"]
    assert got["t"] == ["OK", "TOMBSTONE", "OK"]


def test_known_statuses_are_the_starting_point(spark):
    rows = [change("a", 0, "PENDING"), change("b", 0, "PENDING"), change("c", 0, "ACTIVE"),
            change("c", 1, None, delete=True), change("c", 2, "PENDING")]
    known = spark.createDataFrame([("a", "ACTIVE"), ("c", "WITHDRAWN")], "key string, marketingStatus string")
    got = verdicts_by_key(validate_catalogue(changelog(spark, rows), statuses=known))
    assert got == {
        "a": ["ILLEGAL_STATUS_TRANSITION"], "b": ["OK"],
        "c": ["ILLEGAL_STATUS_TRANSITION", "TOMBSTONE", "OK"],
    }


@pytest.mark.parametrize("start", STATUSES)
def test_known_status_with_sliced_history(spark, start):
    rng = random.Random(start)
    rows, _ = random_history(rng, "hot", 300, 0.005)
    history = [(r[5], r[9], "NARCOTICS_CATEGORY_BLANK" if r[12] == " " and not r[5] else None) for r in rows]
    known = spark.createDataFrame([("hot", start)], "key string, marketingStatus string")
    got = validate_catalogue(changelog(spark, rows), statuses=known, rows_per_task=40)
    assert verdicts_by_key(got) == {"hot": loop_verdicts(history, start)[0]}


def test_first_broken_rule_wins_and_prices_may_be_equal(spark):
    nan = float("nan")
    rows = [
        change(None, 0), change(" \t", 1), change("k", 2, "PENDING", auth="\t", ex=9.0, public=1.0),
        change("k", 3, ex=9.0, public=1.0, narc=" "), change("k", 4, narc="\t"),
        change("k", 5, ex=7.0, public=7.0), change("k", 6, ex=nan), change("k", 7, public=nan),
        change(" ", 8, delete=True, narc=" "), change("k", 9, "PENDING", auth=None),
        change("k", 10, narc=""),
    ]
    got = {r.offset: r.rule for r in check_rules(changelog(spark, rows)).collect()}
    assert got == {
        0: "GTIN_REQUIRED", 1: "GTIN_REQUIRED", 2: "AUTH_NUMBER_REQUIRED", 3: "PRICE_INVERSION",
        4: "NARCOTICS_CATEGORY_BLANK", 5: None, 6: None, 7: None, 8: None,
        9: "AUTH_NUMBER_REQUIRED", 10: "NARCOTICS_CATEGORY_BLANK",
    }


def test_missing_status_counts_as_active(spark):
    rows = [change("k", 0, None), change("k", 1, "PENDING")]
    got = validate_catalogue(changelog(spark, rows)).orderBy("offset").collect()
    assert [r.verdict for r in got] == ["OK", "ILLEGAL_STATUS_TRANSITION"]
    assert got[1].message == "Status transition ACTIVE → PENDING is not permitted"


def test_price_inversion_message(spark):
    rows = [change("k", 0, ex=0.125, public=0.1)]
    [row] = check_rules(changelog(spark, rows)).collect()
    assert row.message == "Public price CHF 0.10 < ex-factory price CHF 0.13 — impossible"


def test_accepted_catalogue_and_rejections(spark):
    rows = [
        change("a", 0), change("a", 1, "PENDING"), change("b", 2), change("b", 3, None, delete=True),
        change("c", 4, ex=9.0, public=1.0), change(None, 5),
    ]
    verdicts = validate_catalogue(changelog(spark, rows))
    assert [(r.key, r.offset) for r in accepted_catalogue(verdicts).collect()] == [("a", 0)]
    assert sorted(r.offset for r in rejected(verdicts).collect()) == [1, 4, 5]
    envelopes = {r.offset: r for r in rejection_envelopes(verdicts).collect()}
    assert envelopes[4].errorType == "VALIDATION" and envelopes[4].stackTrace is None
    assert envelopes[4].context == {
        "gtin": "c", "productName": "Samplin", "validationRule": "PRICE_INVERSION",
        "manufacturer": "Muster Labs",
    }
    assert "gtin" not in envelopes[5].context and envelopes[5].context["validationRule"] == "GTIN_REQUIRED"


def test_transition_matrix(spark):
    pairs = spark.createDataFrame(list(itertools.product([None, *STATUSES], STATUSES)), "a string, b string")
    for r in pairs.withColumn("ok", transition_allowed("a", "b")).collect():
        assert r.ok == (r.a is None or r.a == r.b or r.b in ALLOWED[r.a])


def test_nothing_is_collected_or_run_in_python(spark):
    plan = validate_catalogue(changelog(spark, [change("k", 0)]).where(F.col("offset") >= 0))
    text = plan._jdf.queryExecution().toString()
    assert "Python" not in text and "collect_list" not in text
