"""Small frames for the operator tests."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

T0 = datetime(2024, 1, 1)

CHANGE = (
    "key string, topic string, partition int, offset bigint, ts timestamp, is_delete boolean, "
    "authorizationNumber string, productName string, manufacturer string, marketingStatus string, "
    "exFactoryPriceCHF double, publicPriceCHF double, narcoticsCategory string"
)


def at(seconds):
    return T0 + timedelta(seconds=seconds)


def change(key, offset, status="ACTIVE", delete=False, auth="AUTH", ex=5.5, public=12.8, narc=None, ts=None):
    return (
        key, "hci.medicinal-products.avro", 0, offset, at(offset) if ts is None else ts, delete,
        auth, "Samplin", "Muster Labs", status, ex, public, narc,
    )


def changelog(spark, rows):
    return spark.createDataFrame(rows, CHANGE)


def products(spark, *rows):
    """(key, name, narcoticsCategory)"""
    return spark.createDataFrame(
        [(k, k, "A-17", n, "X00YZ09", "Pill", "Muster Labs", "Samplin", "ACTIVE", 5.5, 12.8, c)
         for k, n, c in rows],
        "key string, gtin string, authorizationNumber string, productName string, atcCode string, "
        "dosageForm string, manufacturer string, activeSubstance string, marketingStatus string, "
        "exFactoryPriceCHF double, publicPriceCHF double, narcoticsCategory string",
    )


def alerts(spark, *rows):
    """(alertId, key, type, severity)"""
    return spark.createDataFrame(
        [(k, "hci.drug-alerts.avro", 0, i, a, k, t, s, f"Notice: {t}", "", T0)
         for i, (a, k, t, s) in enumerate(rows)],
        "key string, topic string, partition int, offset bigint, alertId string, gtin string, "
        "alertType string, severity string, headline string, description string, issuedByUtc timestamp",
    )


def updates(spark, *rows):
    """(key, previous, new)"""
    return spark.createDataFrame(
        [(k, "hci.price-updates.avro", 0, i, k, p, n, "YEARLY_REVIEW", T0) for i, (k, p, n) in enumerate(rows)],
        "key string, topic string, partition int, offset bigint, gtin string, "
        "previousPublicPriceCHF double, newPublicPriceCHF double, changeReason string, "
        "effectiveDateUtc timestamp",
    )


def prices(spark, *rows):
    return spark.createDataFrame(list(rows), "key string, confirmedPriceCHF double")


def one_row(spark, **columns):
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in columns.items()])
