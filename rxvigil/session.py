"""Session settings, the shared folder for intermediate tables, and plan size checks."""

from __future__ import annotations

import uuid

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

import rxvigil

# Settings the operators rely on; all can be changed on a running session.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Long texts fill an Arrow batch long before its row limit does.
    "spark.sql.execution.arrow.maxBytesPerBatch": "16777216",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings the operators rely on to an existing session.

    Functions of this package travel to the Python workers by value, so a worker need not
    find the package on its own path.
    """
    cloudpickle.register_pickle_by_value(rxvigil)
    for name, value in RUNTIME_CONF.items():
        spark.conf.set(name, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    A session without that setting uses a folder below its warehouse, which is shared as well.
    """
    context = spark.sparkContext
    folder = (
        context.getConf().get("spark.checkpoint.dir")
        or spark.conf.get("spark.checkpoint.dir", None)
        or context.getCheckpointDir()
        or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    )
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage, survives executor loss, and lets several readers see exactly
    the same rows with column pruning.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
