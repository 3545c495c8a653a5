"""Admission of product updates: ordered business rules and a status lifecycle.

Updates of a key are judged in order. A rejected update leaves the key's status as it was, an
accepted one sets it, a delete clears it. The status an update is compared with therefore
depends on every earlier verdict of the key.

Within one "life" (the updates between two deletes) the lifecycle has a shape that windows can
follow without replaying verdicts one by one:

* the first update of a life is always accepted;
* WITHDRAWN is reachable from every status and final;
* ACTIVE and SUSPENDED reach each other, and neither goes back to PENDING;
* PENDING is left only through ACTIVE (or WITHDRAWN).

So the status before an update follows from four running values of its life: the first status,
whether ACTIVE was seen, the latest of ACTIVE/SUSPENDED, and whether WITHDRAWN was seen.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rxvigil import schemas as S
from rxvigil.functions import is_blank, json_record, less_than, transition_allowed
from rxvigil.operators.deadletter import envelope_struct, letter, output_record
from rxvigil.operators.latest import latest_by_key
from rxvigil.operators.lookup import lookup_join
from rxvigil.operators.skew import ROWS_PER_TASK, ordered_slices

OK, TOMBSTONE = "OK", "TOMBSTONE"


def check_rules(changelog: DataFrame, key: str = "key") -> DataFrame:
    """Add ``rule`` and ``message`` of the first stateless rule an update breaks (else null).

    Deletes are exempt: they are applied before any validation.
    """
    status = F.coalesce("marketingStatus", F.lit(S.DEFAULT_MARKETING_STATUS))
    auth, category = F.col("authorizationNumber"), F.col("narcoticsCategory")
    public, ex_factory = F.col("publicPriceCHF"), F.col("exFactoryPriceCHF")
    # Rule names and messages of the rejection contract, first failure wins.
    rules = [
        (
            "GTIN_REQUIRED",
            F.col(key).isNull() | is_blank(key),
            F.lit("GTIN key is null or empty"),
        ),
        (
            "AUTH_NUMBER_REQUIRED",
            (status == "PENDING") & (auth.isNull() | is_blank(auth)),
            F.lit("PENDING product must have a Swissmedic authorisation number"),
        ),
        (
            "PRICE_INVERSION",
            less_than(public, ex_factory),
            F.format_string(
                "Public price CHF %.2f < ex-factory price CHF %.2f — impossible", public, ex_factory
            ),
        ),
        (
            "NARCOTICS_CATEGORY_BLANK",
            category.isNotNull() & is_blank(category),
            F.lit("narcoticsCategory is present but blank — must be null or a valid BetmG code"),
        ),
    ]
    rule = F.when(_is_delete(), None)
    for name, broken, _ in rules:
        rule = rule.when(broken, name)
    message = F.lit(None).cast("string")
    for name, _, text in rules:
        message = F.when(F.col("rule") == name, text).otherwise(message)
    return changelog.withColumn("rule", rule.cast("string")).withColumn("message", message)


def validate_catalogue(
    changelog: DataFrame,
    key: str = "key",
    order_by: Sequence[str] = ("ts", "offset"),
    statuses: DataFrame | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Every changelog row with ``verdict``, ``message`` and ``priorStatus``.

    ``verdict`` is ``OK``, ``TOMBSTONE`` or the broken rule. ``statuses`` holds the status
    (``marketingStatus``) some keys already have before this changelog, one row per key.

    One shuffle on the key and one ordered scan; the history of a heavy key is cut into slices
    that run in parallel. Rows that a stateless rule decides stay out of the shuffle.
    """
    ruled = check_rules(changelog, key).withColumn("status", _status())
    # Rows broken by a stateless rule never touch the status, nor do deletes without a usable
    # key, since nothing is ever accepted under one.
    decided = F.col("rule").isNotNull() | F.col(key).isNull() | is_blank(key)
    stateless = ruled.where(decided).select(
        *changelog.columns,
        F.when(_is_delete(), TOMBSTONE).otherwise(F.col("rule")).alias("verdict"),
        "message",
        F.lit(None).cast("string").alias("priorStatus"),
    )
    judged = ruled.where(~decided)
    if statuses is None:
        judged = judged.withColumn("entry", F.lit(None).cast("string"))
    else:
        held = statuses.select(key, F.col("marketingStatus").alias("entry"))
        judged = lookup_join(judged, held, key).drop("matched")

    groups = [key]
    whole, sliced = ordered_slices(judged, groups, order_by, rows_per_task)
    result = _with_prior(whole, groups, _order(order_by))
    if sliced is not None:
        cut = [*groups, "slice"]
        entries = _slice_entries(sliced, groups, order_by)
        entered = sliced.drop("entry").join(entries, cut, "left")
        result = result.unionByName(
            _with_prior(entered, cut, _order(order_by)).select(*result.columns)
        )

    prior = F.col("prior")
    illegal = ~transition_allowed(prior, "status")
    verdict = F.when(_is_delete(), TOMBSTONE).when(illegal, "ILLEGAL_STATUS_TRANSITION").otherwise(OK)
    text = F.format_string("Status transition %s → %s is not permitted", prior, F.col("status"))
    return result.select(
        *changelog.columns,
        verdict.alias("verdict"),
        F.when(illegal & ~_is_delete(), text).alias("message"),
        F.when(~_is_delete(), prior).alias("priorStatus"),
    ).unionByName(stateless)


def accepted_catalogue(
    verdicts: DataFrame, key: str = "key", order_by: Sequence[str] = ("ts", "offset")
) -> DataFrame:
    """Latest accepted update per key, without the keys deleted since."""
    admitted = verdicts.where(F.col("verdict").isin(OK, TOMBSTONE))
    return latest_by_key(admitted, key, order_by)


def rejected(verdicts: DataFrame) -> DataFrame:
    return verdicts.where(~F.col("verdict").isin(OK, TOMBSTONE))


def _rejection_envelope() -> Column:
    # The processor's name and the context keys of the rejection contract.
    return envelope_struct(
        "VALIDATION",
        F.col("message"),
        "ProductCatalogueProcessor",
        {
            "gtin": "key",
            "productName": "productName",
            "validationRule": "verdict",
            "manufacturer": "manufacturer",
        },
    )


def rejection_envelopes(verdicts: DataFrame) -> DataFrame:
    """VALIDATION envelopes of rejected product updates."""
    return rejected(verdicts).select(_rejection_envelope().alias("envelope")).select("envelope.*")


def admission_records(verdicts: DataFrame, accepted_topic: str) -> DataFrame:
    """Accepted updates (a delete has a null value) and dead letters, in one pass."""
    value = json_record(verdicts, S.MEDICINAL_PRODUCT.fieldNames())
    accepted = output_record(F.lit(accepted_topic), "key", F.when(~_is_delete(), value))
    record = F.when(F.col("verdict").isin(OK, TOMBSTONE), accepted).otherwise(
        letter(_rejection_envelope())
    )
    return verdicts.select(record.alias("record")).select("record.*")


def _is_delete() -> Column:
    return F.coalesce(F.col("is_delete"), F.lit(False))


def _status() -> Column:
    status = F.coalesce("marketingStatus", F.lit(S.DEFAULT_MARKETING_STATUS))
    return F.when(~_is_delete(), status)


def _order(names: Sequence[str]) -> list[Column]:
    return [F.col(n) for n in names]


def _with_prior(
    rows: DataFrame,
    groups: Sequence[str],
    order: Sequence[Column],
) -> DataFrame:
    """Add ``prior``: the status accepted before each row, null if there is none.

    The column ``entry`` is the status a group starts with. Tombstones have a null ``status``.
    """
    history = Window.partitionBy(*groups).orderBy(*order)
    so_far = history.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = history.rowsBetween(Window.unboundedPreceding, -1)
    status, life = F.col("status"), F.col("life")

    lives = rows.withColumn("life", F.sum(_is_delete().cast("long")).over(so_far)).withColumn(
        "opens_life", F.coalesce(F.lag(_is_delete()).over(history), F.lit(True))
    )

    def latest(condition: Column) -> Column:
        return F.last(F.when(condition, F.struct("life", "status")), ignorenulls=True).over(before)

    seen = lives.select(
        "*",
        latest(F.col("opens_life") & status.isNotNull()).alias("first_"),
        latest(status.isin("ACTIVE", "SUSPENDED")).alias("trading_"),
        latest(status == "ACTIVE").alias("activated_"),
        latest(status == "WITHDRAWN").alias("withdrawn_"),
    )

    def in_life(name: str) -> Column:
        return F.col(name)["life"] == life

    inherited = F.when(life == 0, F.col("entry"))
    first = F.coalesce(inherited, F.when(in_life("first_"), F.col("first_")["status"]))
    trading = F.when(in_life("trading_"), F.col("trading_")["status"])
    prior = (
        F.when((inherited == "WITHDRAWN") | in_life("withdrawn_"), F.lit("WITHDRAWN"))
        .when(first.isin("ACTIVE", "SUSPENDED") | in_life("activated_"), F.coalesce(trading, first))
        .otherwise(first)
    )
    return seen.withColumn("prior", prior).drop(
        "life", "opens_life", "first_", "trading_", "activated_", "withdrawn_"
    )


def _slice_entries(sliced: DataFrame, groups: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Status with which each slice of a heavy key starts: ``groups, slice, entry``.

    A slice is condensed to the few rows that decide the status after it: its last delete and,
    after that, the first and last row of every status. With its opening row that is at most
    ten rows per slice, and running the lifecycle over them gives every slice's entry status.
    """
    cut = [*groups, "slice"]
    at = F.struct(*order_by)
    row = F.struct(at.alias("at"), _is_delete().alias("is_delete"), "status")
    bounds = sliced.groupBy(*cut).agg(
        F.min(row).alias("opening"),
        F.max(F.when(_is_delete(), at)).alias("last_delete"),
        F.first("entry").alias("entry"),
    )
    opening = bounds.select(*cut, "entry", F.lit(True).alias("opens"), "opening.*")
    deletes = bounds.where(F.col("last_delete").isNotNull()).select(
        *cut, "entry", F.lit(False).alias("opens"), F.col("last_delete").alias("at"),
        F.lit(True).alias("is_delete"), F.lit(None).cast("string").alias("status"),
    )
    last_life = (
        sliced.where(~_is_delete())
        .drop("entry").join(bounds.select(*cut, "entry", "last_delete"), cut)
        .where(F.col("last_delete").isNull() | (at > F.col("last_delete")))
        .groupBy(*cut, "entry", "status").agg(F.min(at).alias("first_at"), F.max(at).alias("last_at"))
        .select(*cut, "entry", "status", F.explode(F.array("first_at", "last_at")).alias("at"))
        .withColumn("opens", F.lit(False))
        .withColumn("is_delete", F.lit(False))
    )
    condensed = opening.unionByName(deletes).unionByName(last_life)
    # The opening row may appear again as a first row; judging a row twice changes nothing.
    order = [F.col("slice"), F.col("opens").desc(), F.col("at")]
    return _with_prior(condensed, groups, order).where("opens").select(
        *cut, F.col("prior").alias("entry")
    )
