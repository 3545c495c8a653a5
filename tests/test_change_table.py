import json
import random
from pathlib import Path

import pytest

from rxvigil import schemas as S
from rxvigil import streaming as st
from rxvigil.streaming import ChangeTable
from rxvigil.streaming.files import create_once, names, read_text
from tests.builders import change, changelog
from tests.test_streaming import Feed, alert, product


def prices(table, spark, schema, version, keys=None):
    wanted = None if keys is None else spark.createDataFrame([(k,) for k in keys], "key string")
    return {r.key: r.publicPriceCHF for r in table.as_of(spark, version, schema, wanted).collect()}


def filled(spark, folder, batches, **options):
    table = ChangeTable(str(folder), ["publicPriceCHF"], **options)
    for i, rows in enumerate(batches):
        table.apply(changelog(spark, rows), i)
    return table, table.schema_of(changelog(spark, []))


def random_batches(rng, count):
    """Changes of 40 keys, and the prices after each batch."""
    batches, held, states, offset = [], {}, [], 0
    for _ in range(count):
        rows = []
        for _ in range(rng.randint(0, 12)):
            key, gone = f"k{rng.randint(0, 39)}", rng.random() < 0.2
            rows.append(change(key, offset, delete=True) if gone else change(key, offset, public=float(offset)))
            held.pop(key, None)
            if not gone:
                held[key] = float(offset)
            offset += 1
        batches.append(rows)
        states.append(dict(held))
    return batches, states


@pytest.mark.parametrize("compact_every", [1, 3, 100])
def test_every_version_can_be_read(spark, tmp_path, compact_every):
    batches, states = random_batches(random.Random(compact_every), 9)
    table, schema = filled(spark, tmp_path / "t", batches, compact_every=compact_every, buckets=4)
    assert [prices(table, spark, schema, v) for v in range(9)] == states
    assert prices(table, spark, schema, None) == states[-1] and prices(table, spark, schema, -1) == {}
    asked = ["k1", "k2", "k30", "absent"]
    assert prices(table, spark, schema, 8, asked) == {k: p for k, p in states[-1].items() if k in asked}


def test_reading_opens_the_asked_buckets_only(spark, tmp_path):
    rows = [change(f"k{i}", i, public=float(i)) for i in range(200)]
    table, schema = filled(spark, tmp_path / "t", [rows], buckets=8)
    one = table.as_of(spark, 0, schema, spark.createDataFrame([("k7",)], "key string"))
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]
    asked = prices(table, spark, schema, 0, ["k7"])
    assert asked == {"k7": 7.0}
    # The other buckets' files may even be missing.
    [own] = {r[0] for r in spark.createDataFrame([("k7",)], "key string").select(table._bucket()).collect()}
    [folder] = (tmp_path / "t" / "data" / "set=0").glob("attempt=*")
    for other in folder.glob("bucket=*"):
        if other.name != f"bucket={own}":
            for file in other.iterdir():
                file.unlink()
    assert prices(table, spark, schema, 0, ["k7"]) == {"k7": 7.0}


def test_compaction_leaves_untouched_buckets_alone(spark, tmp_path):
    first = [change(f"k{i}", i, public=1.0) for i in range(60)]
    batches = [first, *([change("k0", 100 + i, public=float(i))] for i in range(4))]
    table, schema = filled(spark, tmp_path / "t", batches, compact_every=3, buckets=4)
    bases = [int(n.removeprefix("set=")) for n in names(spark, f"{tmp_path}/t/data") if int(n.removeprefix("set=")) % 2]
    assert bases == [7]
    [base] = (tmp_path / "t" / "data" / "set=7").glob("attempt=*")
    assert len(list(base.glob("bucket=*"))) == 1
    assert prices(table, spark, schema, 4)["k0"] == 3.0 and len(prices(table, spark, schema, 4)) == 60


def test_two_queries_share_the_table_while_a_batch_is_retried(spark, tmp_path):
    """A reader keeps its version; an attempt without a manifest is never seen, and the first committed one counts."""
    table, schema = filled(spark, tmp_path / "t", [[change("a", 0, public=1.0)]])
    reader = ChangeTable(str(tmp_path / "t"), ["publicPriceCHF"])
    seen = reader.as_of(spark, None, schema)
    lost = table._write(table._newest(changelog(spark, [change("a", 5, public=99.0)]), table.order_by), 2)
    assert lost["buckets"] and prices(reader, spark, schema, None) == {"a": 1.0}
    table.apply(changelog(spark, [change("a", 6, public=2.0)]), 1)
    table.apply(changelog(spark, [change("a", 7, public=3.0)]), 1)
    assert prices(reader, spark, schema, None) == {"a": 2.0}
    assert [r.publicPriceCHF for r in seen.collect()] == [1.0]
    with pytest.raises(ValueError, match="buckets"):
        ChangeTable(str(tmp_path / "t"), ["publicPriceCHF"], buckets=3).as_of(spark, None, schema)


def test_vacuum_keeps_what_later_versions_need(spark, tmp_path):
    batches, states = random_batches(random.Random(5), 8)
    table, schema = filled(spark, tmp_path / "t", batches, compact_every=2, buckets=2)
    lost = table._write(table._newest(changelog(spark, batches[0] or [change("x", 0)]), table.order_by), 6)
    before = len(list(Path(tmp_path / "t" / "data").glob("*/*/*/*.parquet")))
    table.vacuum(spark, 6)
    assert table.versions(spark) == [6, 7]
    assert [prices(table, spark, schema, v) for v in (6, 7)] == states[6:]
    left = list(Path(tmp_path / "t" / "data").glob("*/*/*/*.parquet"))
    assert len(left) < before and not any(lost["attempt"] in str(p) for p in left)


def test_files_are_created_once(spark, tmp_path):
    path = str(tmp_path / "folder" / "one")
    assert create_once(spark, path, "first ü") and not create_once(spark, path, "second")
    assert read_text(spark, path) == "first ü" and names(spark, str(tmp_path / "none")) == []
    assert names(spark, str(tmp_path / "folder")) == ["one"]


def test_enrichment_reads_the_table_that_admission_keeps(spark, tmp_path):
    """Two running queries and one table: the one admits products, the other looks alerts up in them."""
    products, alerts = Feed(spark, str(tmp_path / "products")), Feed(spark, str(tmp_path / "alerts"))
    table = ChangeTable(str(tmp_path / "table"), st.pipelines._TABLE_FIELDS)

    def admit():
        sink = st.file_sink(str(tmp_path / "admitted"))
        st.start_catalogue_admission(products.stream(), sink, str(tmp_path / "c1"), "accepted", table=table).awaitTermination()

    def enrich():
        sink, folder = st.file_sink(str(tmp_path / "enriched")), str(tmp_path / "c2")
        st.start_alert_enrichment(alerts.stream(), sink, folder, table=table, catalogue="shared").awaitTermination()

    products.add((S.PRODUCTS_TOPIC, "p", product("p", "first")), (S.PRODUCTS_TOPIC, "q", product("q", public=-1.0)))
    admit()
    alerts.add((S.ALERTS_TOPIC, "p", alert("a1", "p")), (S.ALERTS_TOPIC, "q", alert("a2", "q")))
    enrich()
    products.add((S.PRODUCTS_TOPIC, "p", product("p", "second")))
    admit()
    alerts.add((S.ALERTS_TOPIC, "p", alert("a3", "p")))
    enrich()
    found = st.read_records(spark, str(tmp_path / "enriched"), S.ENRICHED_TOPIC).collect()
    assert {json.loads(r.value)["alertId"]: json.loads(r.value)["productName"] for r in found} == {"a1": "first", "a3": "second"}
    with pytest.raises(ValueError, match="needs its table"):
        st.start_alert_enrichment(alerts.stream(), lambda *_: None, str(tmp_path / "c3"), catalogue="shared")
