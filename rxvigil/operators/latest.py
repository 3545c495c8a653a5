"""Latest value per key of a changelog."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_by_key(
    changelog: DataFrame,
    key: str = "key",
    order_by: Sequence[str] = ("ts", "offset"),
    delete: str | None = "is_delete",
    keep_deletes: bool = False,
) -> DataFrame:
    """The newest row of each key; keys whose newest row is a delete are left out.

    ``max_by`` combines map-side: a key updated a billion times still ships one row per task.
    """
    rest = [c for c in changelog.columns if c != key]
    newest = changelog.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.max_by(F.struct(*rest), F.struct(*order_by)).alias("newest")
    )
    latest = newest.select(key, "newest.*").select(*changelog.columns)
    if delete is None or keep_deletes:
        return latest
    return latest.where(~F.coalesce(F.col(delete), F.lit(False)))
