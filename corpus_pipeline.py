"""Documents made ready for training in five stages, each over all that the one before it kept.

A stage is ``(spark, docs, sf_dir) -> DataFrame``; what it returns is written as Parquet and read again
as the ``docs`` of the next. All but the last return the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickweir.llm import common, decontamination, overlap, packing, queries, secrets, toxicity

_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
_ROWS = 2000


def _prepared(spark: SparkSession) -> None:
    """Memory from earlier work is given back, and whole texts go to Python in batches that are small beside the heap of a task."""
    queries.prepared(spark)
    given = int(spark.conf.get(_BATCH))
    if not 0 < given <= _ROWS:
        spark.conf.set(_BATCH, str(_ROWS))
    common.tidy(spark)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored as toxic (0.5 or more) go. The model learns from the labels of ``sf_dir``; where
    no kept document has one, nothing goes."""
    _prepared(spark)  # training needs memory that the driver's JVM may hold on to from earlier work
    columns = docs.columns
    model = toxicity.fit(docs, common.table(spark, sf_dir, "labels"))
    name = _unused(columns, "_score")
    rated = toxicity.score(docs.withColumnRenamed("score", name) if "score" in columns else docs, model).where("score < 0.5").drop("score")
    return rated.withColumnRenamed(name, "score").select(*columns) if "score" in columns else rated.select(*columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose sets of five-word shingles have a Jaccard similarity of 0.8 or more are linked: pairs named by
    SimHash and then all that it misses, each compared as whole sets. Of each
    class of linked ones the row with the smallest doc_id stays, of rows that repeat that id, one."""
    _prepared(spark)  # what training took goes
    return overlap.representatives(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a passage of the benchmark occurs go."""
    _prepared(spark)
    return decontamination.clean(docs, common.table(spark, sf_dir, "benchmark"))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the texts; all documents stay, and ``n_chars`` follows the text."""
    _prepared(spark)
    kept = secrets.masked(docs, *secrets.trained(docs))
    if "n_chars" in docs.columns:
        changed = F.length("text").cast(docs.schema["n_chars"].dataType)
        kept = kept.withColumn("n_chars", F.when(F.col("text").contains(secrets.MASK), changed).otherwise(F.col("n_chars")))
    return kept.select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences of 2048 tokens."""
    _prepared(spark)
    return queries.packed(docs)


def _unused(columns: list[str], name: str) -> str:
    while name in columns:
        name += "_"
    return name


STAGES = [
    ("toxicity", toxicity_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("secrets", secret_stage),
    ("packing", packing_stage),
]

ORACLE_SQL = None  # trained models, fingerprints and token ids are not SQL; see tests/llm/test_pipeline.py


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
