"""Helpers the text operators share."""

from __future__ import annotations

import os
from collections.abc import Callable
from pathlib import Path
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import plantpulse
from plantpulse.session import prepare, shared_folder

#: Seeds, folds and samples are all taken from these hashes, so reruns agree.
FOLDS = 5
#: Rows that Spark hands to a Python worker at a time; texts are long, and both sides hold a whole batch.
ROWS_AT_ONCE = 2_000


def ready(spark: SparkSession) -> SparkSession:
    """The session with its settings, and with this package on the path of the Python workers.

    On a cluster the package has to be installed on all machines, or sent with ``--py-files``.
    """
    environment = spark.sparkContext.environment
    root = str(Path(plantpulse.__file__).resolve().parent.parent)
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, root])
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= ROWS_AT_ONCE:
        spark.conf.set(key, ROWS_AT_ONCE)
    return prepare(spark)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fold(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 5; a NULL id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % FOLDS


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


_KEPT: dict[Any, Any] = {}


def kept(name: Any, make: Callable[[], Any]) -> Any:
    """An operator's object in a Python worker, from task to task; those of other operators are let go first."""
    if name not in _KEPT:
        _KEPT.clear()
        _KEPT[name] = make()
    return _KEPT[name]


class Recent(dict):
    """A dict that fills itself by ``make`` and forgets what was not used lately.

    At most ``2 * size`` entries are held: the young generation becomes the old one when it is
    full, and an entry found in the old one moves back. Results don't depend on what is held.
    """

    def __init__(self, make: Callable[[Any], Any], size: int):
        super().__init__()
        self._make, self._size, self._old = make, size, {}

    def __missing__(self, key: Any) -> Any:
        value = self._old.get(key)
        if value is None:
            value = self._make(key)
        self.put(key, value)
        return value

    def put(self, key: Any, value: Any) -> None:
        if len(self) >= self._size:
            self._old = dict(self)
            self.clear()
        self[key] = value

    def held(self, key: Any) -> bool:
        return key in self or key in self._old


def text_key() -> Column:
    """A key for the text of a row; NULL counts as empty."""
    return F.xxhash64(F.coalesce("text", F.lit("")))


def written(df: DataFrame, purpose: str, compression: str | None = None) -> tuple[DataFrame, str]:
    """The frame as a table in the shared folder, and that table's folder."""
    folder = shared_folder(df.sparkSession, purpose)
    df.write.parquet(folder, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(folder), folder


def discard(spark: SparkSession, folder: str) -> None:
    """Delete a folder that :func:`written` made."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
