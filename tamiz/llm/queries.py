"""Queries of the operators on training data and their SQL, where SQL can express them on whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamiz.llm.batch_dedup import deduplicate_batches
from tamiz.llm.encoding import find_garbled, pair_counts
from tamiz.llm.leakage import find_leaks
from tamiz.llm.subjects import score_subjects, train_subjects
from tamiz.llm.tokenize import encode_corpus, encode_whole, token_count
from tamiz.llm.truncation import score_truncation, truncation_rates

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


@query
def p6_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_corpus(table(spark, sf_dir, "documents"), "doc_id", "text")


@query
def p6_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long texts that the tokenizer's pattern cannot split: the letters of every 64 neighbouring documents in one run, encoded
    as a tree of halves of a thousand letters, with whether the ids are those of the run encoded at once."""
    docs = table(spark, sf_dir, "documents").where("text IS NOT NULL")
    letters = docs.select(F.floor(F.col("doc_id") / 64).alias("run"), F.struct("doc_id", F.regexp_replace("text", r"\P{L}+", "").alias("letters")).alias("d"))
    runs = letters.groupBy("run").agg(F.concat_ws("", F.transform(F.array_sort(F.collect_list("d")), lambda d: d["letters"])).alias("text")).repartition("run")
    tree = encode_corpus(runs, "run", "text", whole=4096, half=1024)
    once = encode_whole(runs, "run", "text").withColumnRenamed("ids", "once")
    both = runs.select("run", F.length("text").alias("letters")).join(tree, "run").join(once, "run")
    return both.select("run", "letters", token_count(F.col("ids")).alias("tokens"), (F.col("ids") == F.col("once")).alias("same"))


@query
def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"), "doc_id", "text", "item_id", "text")


@query
def p7_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaked test items with the number of documents that hold them."""
    return p7_found(spark, sf_dir).groupBy("item_id").agg(F.countDistinct("doc_id").alias("documents"))


def _scored_cuts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_truncation(table(spark, sf_dir, "documents"), "doc_id", "text", "source")


@query
def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored_cuts(spark, sf_dir).where("is_cut").select("doc_id")


@query
def p8_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each source cuts."""
    return truncation_rates(_scored_cuts(spark, sf_dir), "source")


@query
def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_garbled(table(spark, sf_dir, "final_projects"), "rec_id", ["titulo", "objeto"]).select("rec_id", "field")


@query
def p4_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Garbled values with the original text as far as it can be told."""
    return find_garbled(table(spark, sf_dir, "final_projects"), "rec_id", ["titulo", "objeto"])


def _batch_leaders(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "raw_projects").where(F.col("load_kind") == "batch")
    return deduplicate_batches(rows, "load_no", pair_counts(rows, ["proyecto"]))


@query
def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _batch_leaders(spark, sf_dir).where(F.col("raw_id") != F.col("leader"))
    return found.select(F.col("leader").alias("raw_id_a"), F.col("raw_id").alias("raw_id_b"))


@query
def p3_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every batch row with a bill number, the accepted row that says the same and the number of its repeats."""
    found = _batch_leaders(spark, sf_dir)
    sizes = found.groupBy("leader").agg((F.count(F.lit(1)) - 1).alias("repeats"))
    return found.join(sizes, "leader").select("raw_id", "leader", "repeats")


def _subjects(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, areas = table(spark, sf_dir, "final_projects"), table(spark, sf_dir, "subject_areas")
    labels = table(spark, sf_dir, "subject_labels").join(areas.select("subject"), "subject", "left_semi")
    texts = ["titulo", "objeto"]
    model = pair_counts(rows, texts)
    # The subject of none is the last of the closed list.
    rules = train_subjects(rows, labels, "rec_id", "no_camara", texts, "subject", "otros", model)
    return score_subjects(rows, "rec_id", texts, rules, "otros", model)


@query
def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _subjects(spark, sf_dir).select("rec_id", "subject")


@query
def p1_composition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of each subject and their share of the corpus."""
    found = _subjects(spark, sf_dir)
    total = table(spark, sf_dir, "final_projects").count()
    return found.groupBy("subject").agg(F.count(F.lit(1)).alias("records"), (F.count(F.lit(1)) / F.lit(max(1, total))).alias("share"))
