"""The corpus pipeline: language ID, near-dedup, benchmark decontamination, secrets, BPE.

Every stage takes (spark, docs, sf_dir) and returns the rows that go on, with the columns of ``documents``; the last
returns one row of token digests for each document.  Null and empty texts are texts without words and go at the first
stage; ids may be null, and may be shared by different texts, which are different documents in every stage.  The columns
of ``docs`` travel in one struct wherever a stage joins, so that extra ones can't clash.  Empty tables give empty ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexforge.llm.bpe_codec import encode_decode
from lexforge.llm.decontaminate import contamination
from lexforge.llm.language_id import identify, train
from lexforge.llm.near_duplicates import near_duplicates
from lexforge.llm.queries import vocabulary
from lexforge.llm.secrets import redact_secrets
from lexforge.llm.staging import staged
from lexforge.sources.storage import spread


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that is told with some margin.

    Texts without letters (null and empty ones among them), ties and undecided ones go; repeated rows share one fate.
    """
    out = identify(docs, train(docs), keep=(F.struct("*").alias("row"),))
    return out.filter("accepted").select("row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that with the smallest id, or the first of several with it.

    Repeated rows are copies of each other; different texts under one id are not, and null ids come after all others.
    Texts without words are no copies and stay.
    """
    rows = staged(docs.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("at")), "numbered")
    groups = staged(near_duplicates(rows.select("at", "row.text"), id_col="at").select(F.col("doc_id").alias("at"), F.col("component_id").alias("group")), "groups")
    several = groups.filter("at != group").select("group").distinct()
    members = groups.join(several, "group", "left_semi").join(rows.select("at", "row.doc_id"), "at")
    first = members.groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "at")).alias("first"))
    gone = groups.join(several, "group", "left_semi").join(first.select(F.col("first.at").alias("at")), "at", "left_anti").select("at")
    return rows.join(gone, "at", "left_anti").select("row.*")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that benchmark passages don't contaminate; texts without words are clean, repeated rows share one fate."""
    found = contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    gone = found.filter("contaminated").select(F.col("doc_id").alias("id"), "key").distinct()
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("doc"), F.xxhash64(F.col("text").cast("string")).alias("hash"))
    return rows.join(gone, F.col("doc").eqNullSafe(F.col("id")) & (F.col("hash") == F.col("key")), "left_anti").select("row.*")


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked unless they are widely copied examples, and mixed strings where only one owner holds them.

    Owners are counted over the stage's input, repeated rows once; a null source is an owner of its own.  Null and empty
    texts stay as they are; ``n_chars`` follows the masked text.
    """
    masked = redact_secrets(docs, owned=True)
    return masked.withColumn("n_chars", F.length("text").cast("long")).select(*[f"`{c}`" for c in docs.columns])


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded text, for every row; null and empty texts have no tokens."""
    return encode_decode(docs, vocabulary(), ids=False)


STAGES = [("language_id", language_id), ("near_dedup", near_dedup), ("decontamination", decontamination), ("secrets", secret_scan), ("bpe", bpe)]
#: Language ID, sketching and BPE are not for SQL; tests hold the pipeline against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``, each written as Parquet and read again by the next."""
    docs = spread(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
