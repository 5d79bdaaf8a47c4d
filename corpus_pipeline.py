"""From raw documents to packed training sequences: each stage's rows are written as Parquet and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.llm import minhash, packing, quality, substring, toxicity
from waymark.llm.queries import table, vocabulary
from waymark.llm.runtime import large, scratch, written

# All stages: columns of documents, whatever they are, stay in their order and types; an empty table gives an empty one. n_chars is only
# rewritten where it is there. Rows whose doc_id is null go through like others, each on its own unless a stage says so.


def beside(docs: DataFrame) -> DataFrame:
    """doc_id and text, with the other columns as one, so that no name meets one that an operator adds."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    return docs.select("doc_id", "text", F.struct(F.lit(0).alias("__"), *rest).alias("row"))


def as_before(found: DataFrame, docs: DataFrame, **fresh) -> DataFrame:
    """The columns of docs again, those in fresh anew."""
    own = lambda c: F.col(c) if c in ("doc_id", "text") else F.col(f"row.`{c}`")
    return found.select(*[fresh.get(c, own(c)).alias(c) for c in docs.columns])


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps. Null and empty texts go; repeated rows are judged each."""
    return as_before(quality.classify(beside(docs)).where("keep"), docs)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents not predicted toxic; trained on the labelled documents that are left, each once. Without both labels among them all stay."""
    return as_before(toxicity.classify(beside(docs), table(spark, sf_dir, "labels")).where("predicted = 0"), docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the smallest doc_id, of each component of 5-word shingle similarity 0.8 or more.

    Rows that repeat a doc_id and its text are one document: the smallest row by its other columns as JSON stays. Rows of one doc_id with different
    texts stay or go together, each text once. Rows without a doc_id are compared too, under a number of 2 ** 62 or more from a hash of their text.
    """
    keyed = beside(docs).withColumn("row_key", F.coalesce("doc_id", F.lit(1 << 62) + F.xxhash64("text").bitwiseAND(F.lit((1 << 62) - 1))))
    found = minhash.near_duplicates(keyed.select(F.col("row_key").alias("doc_id"), "text"), k=5, percent=80)
    gone = written(found.where("not kept").select(F.col("doc_id").alias("row_key")).distinct(), "gone")
    again = written(keyed.groupBy("row_key").agg(F.count("*").alias("n")).where("n > 1").select("row_key").join(large(gone), "row_key", "left_anti"), "again")
    once = keyed.join(large(gone.unionByName(again)), "row_key", "left_anti").drop("row_key")
    own = F.struct("doc_id", "text", "row")
    least = keyed.join(large(again), "row_key", "left_semi").groupBy("row_key", "text").agg(F.min_by(own, F.to_json("row")).alias("least"))
    return as_before(once.unionByName(least.select("least.*")), docs)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of 20-word windows that stand earlier too; a text without any such window stays as it is.

    Every document stays, also one of which no word is left. Rows without a doc_id stay whole; rows that share one lose what any of them repeats.
    """
    found = substring.remove_repeats(beside(docs), length=20)
    fresh = {"text": F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))}
    if "n_chars" in docs.columns:
        fresh["n_chars"] = F.length(fresh["text"]).cast(docs.schema["n_chars"].dataType)
    return as_before(found, docs, **fresh)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' tokens, packed into sequences of 4096. A null or empty text is its end token alone."""
    return packing.pack(docs, vocabulary("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", quality_stage),
    ("toxicity", toxicity_stage),
    ("MinHash near-dedup", near_duplicate_stage),
    ("substring dedup", substring_stage),
    ("packing", packing_stage),
]
#: Trained models and a tokenizer have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents, one after another."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
