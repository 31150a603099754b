"""From documents to token files: quality, near-duplicates, benchmark leaks, mix, tokens.

Every stage takes what the one before it kept and returns documents; the last returns what
the token files hold. ``run`` writes each stage as Parquet under the shared folder and
reads it again, so a lost executor costs one stage's tasks at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnwork.llm import decontaminate, mixing, quality, simhash, tokens
from tarnwork.llm.common import Scratch, fold

#: No SQL: the stages fit a classifier, hash with XXH64 and run a tokenizer.
ORACLE_SQL = None

#: Near-duplicates of the pipeline: five-word shingles, similarity 0.8 or more. At 0.8 two
#: fingerprints of 256 bits differ in 39 bits on average, with a deviation of 6; the radius
#: only makes candidates, which are compared exactly.
WORDS, LANES, RADIUS, SIMILARITY = 5, 4, 56, 0.8
BANDS = simhash.sampled_bands(bits=256, width=11, count=36)


def tokenizer_file() -> str:
    """The public tokenizer of the token files."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a quality score of 0.3 or more."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select(F.col("doc_id").alias("id"), "quality")
    model = quality.learn(docs.where(fold("doc_id", 5) != 0), labels.where(fold("id", 5) != 0), spark)
    scored = quality.with_scores(docs, spark, model, name="__score")
    return scored.where(F.col("__score") >= 0.3).drop("__score")


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group, or by text hash without ids."""
    grouped = simhash.near_rows(docs, spark, WORDS, RADIUS, LANES, BANDS, SIMILARITY)
    return simhash.survivors(docs, grouped)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.without_contaminated(docs, decontaminate.contaminated(docs, benchmark, spark, exact=True))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, for a budget of all their tokens."""
    return mixing.mix(docs, mixing.plan(docs, spark, entropy=0.9, repeats=4.0)).select(*docs.columns)


def tokens_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix, read back."""
    folder = tokens.write_tokens(docs, spark, tokenizer_file(), end_id=0, added=True)
    return tokens.read_tokens(spark, folder).select(
        F.col("id").alias("doc_id"), "start", F.col("n").alias("n_tokens"), F.crc32("ids").alias("ids_crc32")
    )


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicates_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("tokens", tokens_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        docs = scratch.save(stage(spark, docs, sf_dir), f"{number}-{name}")
    return docs
