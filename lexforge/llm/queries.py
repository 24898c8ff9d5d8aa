"""Queries opN_<name> over the driver's tables, each through its operator with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexforge.llm import oracles
from lexforge.llm.bpe_codec import encode_decode
from lexforge.llm.decontaminate import contamination
from lexforge.llm.embedding_dedup import near_vectors
from lexforge.llm.html_text import main_text
from lexforge.llm.language_id import fold, identify, train
from lexforge.llm.near_duplicates import near_duplicates
from lexforge.llm.prefix_trie import borrowed_openings, prefix_trie, turns_of
from lexforge.llm.secrets import scan_secrets
from lexforge.llm.shards import shard_rows
from lexforge.llm.source_audit import divergences
from lexforge.llm.staging import new_path
from lexforge.llm.surrogates import family_names, replace_entities
from lexforge.llm.token_counts import count_tokens
from lexforge.llm.token_files import read_digests, write_ids
from lexforge.sources.storage import spread


def vocabulary() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _spread(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table for work in Python, which a small table in one split would do on one core."""
    return spread(_table(spark, sf_dir, name))


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(_spread(spark, sf_dir, "documents"), vocabulary())


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(_spread(spark, sf_dir, "embeddings"))


def op3_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _spread(spark, sf_dir, "documents")
    return replace_entities(docs, key=b"a key of the caller's own", families=family_names(docs))


def op4_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_decode(_spread(spark, sf_dir, "documents"), vocabulary(), ids=False)


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(_spread(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")).drop("key")


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(_table(spark, sf_dir, "documents"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _spread(spark, sf_dir, "documents")
    out = identify(docs, train(docs))
    return out.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "lang_pred", "score", "margin", "accepted")


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_spread(spark, sf_dir, "documents"))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "token-files")
    write_ids(_spread(spark, sf_dir, "documents"), path, vocabulary())
    return read_digests(spark, path)


def op10_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_rows(_table(spark, sf_dir, "documents"), shards=8)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(borrowed_openings(turns_of(_table(spark, sf_dir, "conversations"), "conv_id", "turn", "role", "text")))


def op12_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergences(_spread(spark, sf_dir, "documents"))


def op13_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(_spread(spark, sf_dir, "pages"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_embedding_dedup": op2_embedding_dedup,
    "op3_surrogates": op3_surrogates,
    "op4_bpe_codec": op4_bpe_codec,
    "op5_decontaminate": op5_decontaminate,
    "op6_secrets": op6_secrets,
    "op7_language_id": op7_language_id,
    "op8_near_duplicates": op8_near_duplicates,
    "op9_token_files": op9_token_files,
    "op10_shards": op10_shards,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_source_audit": op12_source_audit,
    "op13_html_text": op13_html_text,
}
ORACLE_SQL: dict[str, str] = {
    "op2_embedding_dedup": oracles.OP2,
    "op5_decontaminate": oracles.OP5,
    "op6_secrets": oracles.OP6,
    "op8_near_duplicates": oracles.OP8,
    "op11_prefix_trie": oracles.OP11,
    "op12_source_audit": oracles.OP12,
}
