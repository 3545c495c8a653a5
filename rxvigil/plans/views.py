"""Domain views over the benchmark tables.

Each view is one table and a list of column expressions whose text means the same in Spark and
in the SQL engine the results are compared with, so both sides start from identical inputs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _pad(expr: str, width: int) -> str:
    return f"lpad(cast({expr} as varchar(20)), {width}, '0')"


_ALERT_GTIN = f"concat(case when user_id % 10 = 9 then 'X' else '0' end, {_pad('user_id', 13)})"
_PRICE_GTIN = f"concat(case when l_partkey % 11 = 0 then 'X' else '0' end, {_pad('l_partkey', 13)})"
_CHANGE_GTIN = f"case when o_orderkey % 101 = 0 then ' ' else {_pad('o_custkey', 14)} end"


def _double(literal: float) -> str:
    return f"cast({literal} as double)"


VIEWS: dict[str, tuple[str, dict[str, str]]] = {
    "v_catalogue": ("part", {
        "key": _pad("p_partkey", 14),
        "gtin": _pad("p_partkey", 14),
        "authorizationNumber":
            "case when p_partkey % 17 = 0 then '' else concat('AUTH-', cast(p_partkey as varchar(20))) end",
        "productName": "p_name",
        "atcCode": f"concat('A', {_pad('p_size', 2)})",
        "dosageForm": "p_type",
        "manufacturer": "p_brand",
        "activeSubstance": "p_name",
        "marketingStatus":
            "case p_partkey % 4 when 0 then 'ACTIVE' when 1 then 'SUSPENDED' when 2 then 'PENDING' else 'WITHDRAWN' end",
        "exFactoryPriceCHF":
            f"p_retailprice * case when p_partkey % 23 = 0 then {_double(1.1)} else {_double(0.7)} end",
        "publicPriceCHF": f"case when p_partkey % 41 = 0 then {_double(0.0)} else p_retailprice end",
        "narcoticsCategory":
            "case when p_type = 'PROMO' then 'BetmG-A' when p_partkey % 29 = 0 then ' ' end",
    }),
    "v_alerts": ("events", {
        "key": _ALERT_GTIN,
        "topic": "'hci.drug-alerts.avro'",
        "partition": "cast(event_id % 4 as int)",
        "offset": "event_id",
        "ts": "cast(ts as timestamp)",
        "alertId": "cast(event_id as varchar(20))",
        "gtin": _ALERT_GTIN,
        "alertType":
            "case event_type when 'view' then 'RECALL' when 'click' then 'SHORTAGE' "
            "when 'signup' then 'QUALITY_DEFECT' when 'error' then 'PRICE_SUSPENSION' "
            "when 'purchase' then 'IMPORT_BAN' end",
        "severity":
            "case event_id % 5 when 0 then 'CLASS_I' when 1 then 'CLASS_II' when 2 then 'CLASS_III' "
            "when 3 then 'ADVISORY' end",
        "headline": "event_type",
        "description": "props",
        "issuedByUtc": "cast(ts as timestamp)",
    }),
    # The same alerts, but every twentieth record reaches its log about 200 records late.
    "v_delayed_alerts": ("events", {
        # Some alerts lack a key; theirs are far ahead in time and must not count.
        "key": f"case when event_id % 25 <> 7 then {_ALERT_GTIN} end",
        "topic": "'hci.drug-alerts.avro'",
        "partition": "cast(event_id % 4 as int)",
        "offset": "event_id * 2 + case when event_id % 20 = 0 then 401 else 0 end",
        "ts": "cast(ts as timestamp) + case when event_id % 25 = 7 then interval '1' day else interval '0' day end",
    }),
    # A third of the records carry no issue time and fall back to their ingestion time.
    "v_undated_alerts": ("events", {
        "key": _ALERT_GTIN,
        "alertId": "cast(event_id as varchar(20))",
        "issuedByUtc": "case when event_id % 3 <> 0 then cast(ts as timestamp) end",
        "timestamp": "cast(ts as timestamp) + interval '90' second",
    }),
    "v_price_updates": ("lineitem", {
        "key": _PRICE_GTIN,
        "topic": "'hci.price-updates.avro'",
        "partition": "cast(l_partkey % 4 as int)",
        "offset": "l_orderkey * 8 + l_linenumber",
        "ts": "cast(l_shipdate as timestamp)",
        "gtin": _PRICE_GTIN,
        "previousPublicPriceCHF":
            f"case when l_linenumber = 7 then {_double(0.0)} else cast(900 + l_linenumber * 10 as double) end",
        "newPublicPriceCHF": "900 + l_quantity * 8",
        "effectiveDateUtc": "cast(l_shipdate as timestamp)",
        "changeReason": "l_returnflag",
    }),
    "v_product_changelog": ("orders", {
        "key": _CHANGE_GTIN,
        "topic": "'hci.medicinal-products.avro'",
        "partition": "cast(o_custkey % 4 as int)",
        "offset": "o_orderkey",
        "ts": "cast(o_orderdate as timestamp)",
        "is_delete": "o_orderkey % 19 = 0",
        "gtin": _CHANGE_GTIN,
        "authorizationNumber": "case when o_orderkey % 13 = 0 then '' else 'AUTH' end",
        "productName": "concat('Product-', cast(o_custkey as varchar(20)))",
        "manufacturer": "concat('Maker-', o_orderstatus)",
        "marketingStatus":
            "case o_orderpriority when '3-MEDIUM' then 'SUSPENDED' when '4-NOT SPECIFIED' then 'PENDING' "
            "when '5-LOW' then 'WITHDRAWN' else 'ACTIVE' end",
        "exFactoryPriceCHF":
            f"o_totalprice * case when o_orderkey % 31 = 0 then {_double(1.1)} else {_double(0.7)} end",
        "publicPriceCHF": "o_totalprice",
        "narcoticsCategory":
            "case when o_orderkey % 37 = 0 then ' ' when o_orderkey % 5 = 0 then 'BetmG-A' end",
    }),
    # JSON texts, every fiftieth cut short by one character.
    "v_raw": ("events", {
        "key": "cast(event_id as varchar(20))",
        # Cut short, two values in one, and text after the value.
        "value":
            "case event_id % 50 when 0 then substr(props, 1, length(props) - 1) when 1 then concat(props, props) "
            "when 2 then concat(props, ' trailing') when 3 then concat(' ', props, ' ') else props end",
        "topic": "'hci.drug-alerts.avro'",
        "partition": "cast(event_id % 4 as int)",
        "offset": "event_id",
    }),
    # Whole texts as output records of differing size.
    "v_output": ("documents", {
        "topic": "'hci.alerts.enriched.avro'",
        "key": "cast(doc_id as varchar(20))",
        "value": "text",
    }),
    # Source topics of all shapes the dead-letter naming rule tells apart.
    "v_topics": ("orders", {
        "offset": "o_orderkey",
        "topic":
            "case o_orderkey % 5 when 0 then 'hci.drug-alerts.avro' when 1 then 'hci.price-updates.avro' "
            "when 2 then 'external.topic' when 3 then concat('hci.', o_orderpriority) end",
    }),
}

# The same rows with the micro-batch in which they arrive when a table is replayed as a stream:
# alerts by issue time with every twentieth delayed, catalogue and changelog out of order.
BATCHES = 3
for _name, _view, _arrives in (
    ("v_alerts_in_batches", "v_alerts",
     "least(2, case when ts < timestamp '2024-01-11 00:00:00' then 0 when ts < timestamp '2024-01-21 00:00:00' then 1 "
     "else 2 end + case when event_id % 20 = 0 then 1 else 0 end)"),
    ("v_catalogue_in_batches", "v_catalogue", "p_partkey % 3"),
    ("v_changelog_in_batches", "v_product_changelog", "o_orderkey % 3"),
    # In order of time, with every tenth row a batch late.
    ("v_price_updates_delayed", "v_price_updates",
     "least(2, case when l_shipdate < timestamp '1997-04-01 00:00:00' then 0 when l_shipdate < timestamp '1999-07-01 00:00:00' "
     "then 1 else 2 end + case when l_orderkey % 10 = 0 then 1 else 0 end)"),
    ("v_product_changelog_delayed", "v_product_changelog",
     "least(2, case when o_orderdate < timestamp '1997-04-01 00:00:00' then 0 when o_orderdate < timestamp '1999-07-01 00:00:00' "
     "then 1 else 2 end + case when o_orderkey % 10 = 0 then 1 else 0 end)"),
):
    VIEWS[_name] = (VIEWS[_view][0], {**VIEWS[_view][1], "arrives": f"cast({_arrives} as int)"})


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    source, columns = VIEWS[name]
    return project_view(table(spark, sf_dir, source), name)


def project_view(rows: DataFrame, name: str) -> DataFrame:
    """The view's columns over a batch or streaming frame of its source table."""
    _, columns = VIEWS[name]
    return rows.selectExpr(*[f"{expr} AS `{alias}`" for alias, expr in columns.items()])


def view_sql(*names: str) -> str:
    """The views as SQL common table expressions (without the leading WITH)."""
    parts = []
    for name in names:
        source, columns = VIEWS[name]
        body = ", ".join(f'{expr} AS "{alias}"' for alias, expr in columns.items())
        parts.append(f"{name} AS (SELECT {body} FROM {source})")
    return ",\n".join(parts)


def plain_timestamps(df: DataFrame) -> DataFrame:
    """Timestamps without time zone, as the comparison engine returns them."""
    return df.select(*[
        F.col(f.name).cast("timestamp_ntz").alias(f.name)
        if isinstance(f.dataType, T.TimestampType) else F.col(f.name)
        for f in df.schema.fields
    ])
