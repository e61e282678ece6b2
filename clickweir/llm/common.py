"""What several operators here share: stored intermediate tables and folds of ids."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import zipfile
from pathlib import Path

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickweir.sources import tables
from clickweir.sources.session import scratch_path

_SHIPPED: set[str] = set()
_TRIM = "systemTrimNativeHeap"  # a diagnostic command of JVMs on Linux, from some update of Java 17 on


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application; ``--py-files`` does the same."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    _SHIPPED.add(app)
    package = Path(__file__).resolve().parent.parent
    target = Path(tempfile.mkdtemp(prefix="clickweir-")) / "clickweir_package.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for file in sorted(package.rglob("*.py")):
            archive.write(file, file.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(target))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, name: str, **options: str) -> DataFrame:
    """The frame written to the shared folder and read back: lineage ends here, and a lost executor
    costs the tasks that ran on it, not what is stored. ``options`` go to the writer."""
    path = scratch_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    table_ = df.sparkSession.read.schema(df.schema).parquet(path)
    table_.stored_path = path
    return table_


def superseded(df: DataFrame | None) -> None:
    """Remove a stored frame that nothing reads any more."""
    if df is not None:
        tables.remove(df.sparkSession, df.stored_path)


def trim() -> None:
    """What Python has freed in this process goes back to the system where the C library can do that; it keeps it otherwise."""
    gc.collect()
    given_back = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if given_back:
        given_back(0)


def tidy(spark: SparkSession) -> None:
    """Let go of the shuffle files of frames that are gone: Spark removes them when the driver's JVM finds
    that nothing refers to them, which by itself it may not look for in half an hour. What Python has freed here,
    as after training, goes back to the system. So does what
    the JVM has freed outside its heap: hundreds of its threads plan, compile and broadcast, each with memory of its own."""
    trim()
    jvm = spark.sparkContext._jvm
    jvm.System.gc()
    bean = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand")
    told = spark.sparkContext._gateway.new_array(jvm.java.lang.Object, 4)  # neither arguments nor their types
    told[0], told[1] = bean, _TRIM
    called = next(m for m in jvm.java.lang.Class.forName("javax.management.MBeanServer").getMethods() if m.getName() == "invoke")
    try:
        called.invoke(jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer(), told)
    except Py4JJavaError:  # a JVM that has no such command
        pass


def fold(doc_id: str | Column, modulus: int) -> Column:
    """``crc32(doc_id as text) mod modulus``."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(column.cast("string").cast("binary")) % modulus


def labelled_sample(labels: DataFrame, column: str, keep: Column, per_class: int) -> DataFrame:
    """At most ``per_class`` ids of each class of a 0/1 label (``doc_id, label``), chosen by a hash of
    the id. An id with several labels takes the largest; ids or labels that are NULL are left out."""
    rows = (
        labels.where(F.col("doc_id").isNotNull() & F.col(column).isNotNull() & keep)
        .groupBy("doc_id").agg((F.max(column) > 0).cast("int").alias("label"))
    )
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    return rows.where("label = 1").orderBy(*order).limit(per_class).union(
        rows.where("label = 0").orderBy(*order).limit(per_class))
