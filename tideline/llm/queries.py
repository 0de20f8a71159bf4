"""The registered queries of this subpackage, and SQL where it can express them.

Every query applies one operator to the whole of its table. Those without SQL are tested
against brute force or a library in `tests/llm`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm.dartminhash import near_classes
from tideline.llm import personal, secretscan, warc
from tideline.llm import quality as quality_rules
from tideline.llm.decontaminate import blocks, leaks
from tideline.llm.gnat import hard_negatives
from tideline.llm.multiindex import nearest_neighbours
from tideline.llm.oracle import ORACLE
from tideline.llm.pieces import piece_round_trips
from tideline.llm.resample import resample
from tideline.llm.sentences import without_repeats
from tideline.llm.shipping import ship
from tideline.llm.storage import stored
from tideline.llm.tokenfiles import read_tokens, write_tokens
from tideline.llm.toxicity import Field, toxicity, train


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def piece_ids_and_digests(docs: DataFrame) -> DataFrame:
    """Piece ids of every text, decoded again: counts, digests and the ids."""
    model = tokenizer_file("piece_bpe_32k.model")
    return piece_round_trips(docs, model).select(
        F.col("id").alias("doc_id"),
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
        "ids",
    )


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_ids_and_digests(table(spark, sf_dir, "documents")).drop("ids")


def op2_personal(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found, base, added = personal.with_spans(docs, personal.train(docs))
    counts = [personal.count_of(kind, base).alias(f"n_{kind}") for kind in personal.KINDS]
    every = F.array_sort(F.concat(base, added))
    return found.select(
        "doc_id",
        *counts,
        F.sha2(personal.written(F.col(base)), 256).alias("base_sha256"),
        personal.written(every).alias("spans"),
    )


def op3_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without its repeated sentences, and what was removed."""
    return without_repeats(table(spark, sf_dir, "documents"))


def held_out(id: str = "doc_id") -> Column:
    """Rows kept from training: the checksum of the id as text is divisible by 5."""
    return F.crc32(F.col(id).cast("string").cast("binary")) % 5 == 0


def toxicity_field(spark: SparkSession, sf_dir: str, docs: DataFrame) -> Field:
    labels = table(spark, sf_dir, "labels").where(~held_out())
    return train(docs, labels)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    tagged = docs.select("doc_id", toxicity("text", toxicity_field(spark, sf_dir, docs)).alias("found"))
    return tagged.select(
        "doc_id",
        F.coalesce(held_out(), F.lit(False)).alias("held_out"),
        F.col("found.score").alias("score"),
        (F.col("found.score") >= 0.5).cast("int").alias("predicted"),
        F.col("found.spans").alias("spans"),
    )


def op5_dartminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_classes(table(spark, sf_dir, "documents"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    forest = quality_rules.train(docs, table(spark, sf_dir, "labels"))
    measured = docs.select("doc_id", quality_rules.quality("text", forest).alias("found")).select("doc_id", "found.*")
    failed = quality_rules.base_failed(F.col("n_words"), F.col("n_repeat_words"))
    return measured.select(
        "doc_id",
        *quality_rules.COUNTS,
        failed.alias("base_failed"),
        (~failed & (F.col("score") >= 0.5)).alias("kept"),
        "score",
    )


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = docs.select("doc_id", secretscan.secrets("text", secretscan.train(docs)).alias("found"))
    base = F.filter("found", lambda s: s["kind"] < secretscan.KINDS.index("random"))
    return found.select(
        "doc_id",
        *[secretscan.count_of(k, "found").alias(f"n_{k}") for k in secretscan.KINDS[:3]],
        F.sha2(secretscan.written(base), 256).alias("base_sha256"),
        secretscan.written(F.col("found")).alias("spans"),
    )


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, files = warc.write_warc(table(spark, sf_dir, "pages"))
    records = stored(warc.read_records(spark, folder, files, with_payload=False), "records")
    found = warc.captures(records)
    return found.select(
        warc.page_of("main.record_id").alias("page_id"),
        F.col("main.payload_bytes").alias("payload_bytes"),
        F.col("main.digest").alias("payload_digest"),
        F.col("main.kind").alias("record_type"),
        warc.page_of("main.refers_to").alias("refers_to"),
        F.col("request.target").alias("requested"),
    )


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for every place of a benchmark item in a document."""
    docs = table(spark, sf_dir, "documents")
    found = leaks("text", blocks(table(spark, sf_dir, "benchmark")))
    matches = docs.select("doc_id", F.explode(found).alias("match"))
    return matches.select(
        "doc_id",
        F.col("match.item").alias("item_id"),
        F.col("match.start").alias("start"),
        F.col("match.end").alias("end"),
        F.col("match.edits").alias("edits"),
    )


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    files = write_tokens(docs, tokenizer_file("word_bpe_49k.json"), end=1)
    return read_tokens(spark, files).select(
        F.col("id").alias("doc_id"),
        "start",
        (F.octet_length("tokens") / 4).cast("long").alias("n_tokens"),
        F.crc32("tokens").alias("ids_crc32"),
    )


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    found = hard_negatives(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, label=moved)
    return found.select(
        F.col("anchor").alias("anchor_id"),
        F.col("positive").alias("positive_id"),
        "rank",
        F.col("negative").alias("negative_id"),
        "positive_score",
        "negative_score",
    )


def op12_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)
    return found.select(F.col("query").alias("query_id"), "rank", F.col("id").alias("vec_id"), "score")


def op13_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select(F.col("id").alias("doc_id"), "n_features", "weight", "score", "rank")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_personal": op2_personal,
    "op3_sentence_spans": op3_sentence_spans,
    "op4_toxicity": op4_toxicity,
    "op5_dartminhash": op5_dartminhash,
    "op6_quality": op6_quality,
    "op7_secrets": op7_secrets,
    "op8_warc": op8_warc,
    "op9_decontaminate": op9_decontaminate,
    "op10_token_files": op10_token_files,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_multi_index": op12_multi_index,
    "op13_resample": op13_resample,
}

__all__ = ["ORACLE", "QUERIES"]
