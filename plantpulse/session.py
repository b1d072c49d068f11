"""Session settings the library relies on, and the shared working folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTINGS = {
    # Telemetry is stored in UTC; a different zone would shift every unzoned timestamp.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a batch that holds many rows also where an aggregate by batch follows the join.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Counts and bounds from Parquet footers, for tables that sources.footers opens.
    "spark.sql.parquet.aggregatePushdown": "true",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to the session, for good (shuffle sizes stay what the cluster set)."""
    for key, value in _SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder below the cluster's checkpoint folder.

    The folder has to be visible to every executor. Where ``spark.checkpoint.dir`` is not set, the
    warehouse is used, which all of them see too.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def discard(spark: SparkSession, *folders: str) -> None:
    """Delete folders below the shared one that nothing reads any more."""
    for folder in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stored(df: DataFrame, purpose: str) -> tuple[DataFrame, str]:
    """Like ``staged``, together with the folder, for callers that delete it again."""
    folder = shared_folder(df.sparkSession, purpose)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder), folder


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """Write an intermediate result to the shared folder and go on from there.

    This cuts the lineage, so what follows neither repeats the work nor depends on the
    executors that did it.
    """
    return stored(df, purpose)[0]
