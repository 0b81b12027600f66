"""A corpus pipeline: from ``documents`` to token files, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next stage's docs. All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lograft.llm.decontaminate import find_leaks
from lograft.llm.jaccard_join import jaccard_components
from lograft.llm.mixing import mix_sources
from lograft.llm.quality import score_quality
from lograft.llm.queries import GOOD, quality_model, tokenizer_file
from lograft.llm.scratch import counted, in_few_tasks, scratch_path, settle, sieve_cells, sieve_test
from lograft.llm.token_files import read_token_files, write_token_files


#: Words of a benchmark passage that remove a document.
LEAST_PASSAGE = 8


def _with_row_key(docs: DataFrame) -> DataFrame:
    """With a column ``_row``, a 64-bit hash of id and text: decisions are about rows, and
    ids may be missing or stand on several texts."""
    return docs.withColumn("_row", F.xxhash64("doc_id", "text"))


def _split(docs: DataFrame, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows whose key is surely not among ``keys``, and the others: texts of the first
    need not move for an exact join."""
    marked = sieve_test(docs, sieve_cells(keys, "_row"), "_row")
    return marked.filter(~F.col("in_sieve")).drop("in_sieve"), marked.filter("in_sieve").drop("in_sieve")


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject. Documents without text
    get the mean label, and stay where most labelled documents are good."""
    scored = score_quality(docs, quality_model(spark, docs, sf_dir))
    return scored.filter(F.col("score") >= GOOD).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a Jaccard similarity of 0.8 over five-word shingles, the
    one with the smallest id (rows without an id last), and one row of it. Documents
    without words stay."""
    rows = _with_row_key(docs)
    found, n = counted(jaccard_components(rows, words=5, percent=80, id_col="_row"))
    linked = found.filter("n_links > 0").groupBy(F.col("doc_id").alias("_row"), "component_id").count()
    ids = rows.groupBy("_row").agg(F.min(F.col("doc_id").cast("long")).alias("id"))
    linked = settle(in_few_tasks(linked.join(ids, "_row"), n))
    first = in_few_tasks(linked.groupBy("component_id").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "_row")).alias("f"))
                         .select("f._row"), n)
    gone = settle(in_few_tasks(linked.select("_row").join(first, "_row", "left_anti"), n))
    again = linked.filter("count > 1").select("_row")
    sure, maybe = _split(rows, gone.union(again))
    left = maybe.join(gone, "_row", "left_anti").join(again.withColumn("_again", F.lit(True)), "_row", "left")
    once = left.filter("_again").dropDuplicates(["_row"])
    return sure.select(*docs.columns).unionByName(left.filter("_again is null").unionByName(once).select(*docs.columns))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of ``LEAST_PASSAGE`` words or more of a benchmark item: a
    shorter item, as ``yes``, says nothing about where a document is from."""
    benchmark = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    rows = _with_row_key(docs)
    gone = settle(find_leaks(rows, benchmark, id_col="_row").filter(F.col("n_words") >= LEAST_PASSAGE).select(F.col("doc_id").alias("_row")).distinct())
    sure, maybe = _split(rows, gone)
    return sure.select(*docs.columns).unionByName(maybe.join(gone, "_row", "left_anti").select(*docs.columns))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: weights 3, 1, 2 over the sources."""
    mixed = mix_sources(docs, weights=(3, 1, 2), share=1.5, most=2.0, keep=[c for c in docs.columns if c != "doc_id"])
    return (mixed.filter("copies > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
            .select(*docs.columns))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix, and a row per document read back from them."""
    path = scratch_path(spark, "pipeline-tokens")
    write_token_files(docs, tokenizer_file("word_bpe_49k.json"), path, end_id=2, vocabulary=49408)
    return read_token_files(spark, path)


STAGES = [
    ("quality", keep_good),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_leaks),
    ("mixing", mix),
    ("token_files", tokens),
]

#: SQL cannot express the classifier, the components or the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
