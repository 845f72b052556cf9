"""Registered queries of the package: each applies one operator to its whole table."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lowtide.llm import (bit_kmeans, filter_audit, license_scan, line_dedup, mixing, ngram_join, repetition, secret_scan, sentencepiece,
                         spotsigs, tool_links, toxicity, url_filter)

PIECES = os.environ.get("LOWTIDE_PIECES", "/opt/tokenizers/piece_bpe_32k.model")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.compare_edited(_table(spark, sf_dir, "documents"))


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece.round_trip(_table(spark, sf_dir, "documents"), PIECES)


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(_table(spark, sf_dir, "documents"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")


#: tools of the conversations: each assistant turn asks one of them
SCHEMAS = {
    "search": {"required": ["query"], "properties": {"query": {"type": "string"}, "limit": {"type": "integer", "minimum": 1, "maximum": 20}}},
    "quote": {"required": ["lines", "text"], "properties": {"lines": {"type": "integer"}, "text": {"type": "string"}}},
    "rate": {"required": ["score"], "properties": {"score": {"type": "number", "minimum": 0, "maximum": 1}, "style": {"enum": ["short", "long"]}}},
}


def calls_and_results(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results of plain chats: an assistant turn calls a tool with its text, the next user turn is the result.

    The assistant turn before it, two turns earlier, is the call it depends on.
    """
    n, text = F.length("text"), F.col("text")
    escaped = F.to_json(F.struct(text.alias("x")), {"ignoreNullFields": "false"})
    quoted = F.expr("substring(escaped, 6, length(escaped) - 6)")
    turns = turns.withColumn("escaped", escaped).withColumn("quoted", quoted)
    arguments = F.when(F.col("turn") % 3 == 0, F.concat(F.lit('{"query": '), "quoted", F.lit(', "limit": '), n % 25, F.lit("}"))).when(
        F.col("turn") % 3 == 1, F.concat(F.lit('{ "text": '), "quoted", F.lit(', "lines": '), F.size(F.split("text", "\n")), F.lit(" }"))).otherwise(
        F.concat(F.lit('{"style":"'), F.when(n < 500, "short").otherwise("long"), F.lit('","score":'), (n % 101) / 100, F.lit("}")))
    key = lambda shift: F.concat(F.lit("call_"), (F.col("turn") - shift).cast("string"))
    name = F.element_at(F.array(*map(F.lit, SCHEMAS)), (F.pmod("turn", F.lit(3)) + 1).cast("int"))
    calls = turns.filter("role = 'assistant'").select(
        "conv_id", key(0).alias("call_id"), "turn", name.alias("name"), arguments.alias("arguments"), F.when(F.col("turn") > 2, key(2)).alias("after"))
    results = turns.filter("role = 'user' and turn > 0").select("conv_id", key(1).alias("call_id"), "turn", text.alias("content"))
    return calls, results


def op5_tool_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tool_links.link(*calls_and_results(_table(spark, sf_dir, "conversations")), SCHEMAS)


def op6_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.measure(_table(spark, sf_dir, "documents")).drop("covered_words", "longest_run")


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(_table(spark, sf_dir, "documents"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = secret_scan.scan(_table(spark, sf_dir, "documents")).select("doc_id", "spans")
    kinds = [r.kind for r in secret_scan.BASE]
    base = F.filter("spans", lambda s: s["kind"].isin(kinds))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    counts = (count(k).alias(f"n_{k}") for k in kinds)
    return spans.select("doc_id", *counts, F.sha2(secret_scan.listed(base), 256).alias("base_sha256"),
                        secret_scan.listed(F.col("spans")).alias("spans"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(_table(spark, sf_dir, "pages"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.report(_table(spark, sf_dir, "documents"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.judge(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op13_bit_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bit_kmeans.cluster(_table(spark, sf_dir, "embeddings"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (
    op1_spotsigs, op2_sentencepiece, op3_license_scan, op4_mixing, op5_tool_links, op6_repetition, op7_ngram_join, op8_secret_scan, op9_url_filter,
    op10_line_dedup, op11_filter_audit, op12_toxicity, op13_bit_kmeans, pipeline)}
