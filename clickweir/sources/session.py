"""Session settings the jobs rely on, and the shared scratch folder."""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# One shuffle partition for this much stored input, and rows take about so many times their stored
# size in a shuffle.
_BYTES_PER_PARTITION = 128 * 1024 * 1024
_SHUFFLE_GROWTH = 4

_OWN_SCRATCH: dict[str, str] = {}


def use_utc(spark: SparkSession) -> SparkSession:
    """Dates, hours and windows are UTC; pin the zone so they do not depend on the cluster."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``. Only a local session, as in tests, may do
    without the setting; on a cluster a machine-local folder would be lost with its machine."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not _is_local(spark):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _OWN_SCRATCH:
        _OWN_SCRATCH[app] = tempfile.mkdtemp(prefix="clickweir-")
    return _OWN_SCRATCH[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path in the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def partitions_for(stored: int, at_least: int) -> int:
    """Shuffle partitions for an input of so many bytes; AQE merges those that turn out small."""
    wanted = math.ceil(stored * _SHUFFLE_GROWTH / _BYTES_PER_PARTITION)
    return max(at_least, wanted)


@contextmanager
def sized_shuffles(spark: SparkSession, stored: int) -> Iterator[None]:
    """Raise ``spark.sql.shuffle.partitions`` to fit the input while a job runs; never lower it."""
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    spark.conf.set(name, str(partitions_for(stored, int(before))))
    try:
        yield
    finally:
        spark.conf.set(name, before)
