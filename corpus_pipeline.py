"""A training corpus from raw documents, in five stages.

Toxic documents go, one document of each group of near copies stays, documents that hold
a benchmark passage go, personal data is replaced by its kind in brackets, and what is
left becomes token ids. Each stage gets what the one before kept, as a Parquet table.
Columns beside those that a stage works on pass through the first four stages untouched.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm import personal
from tideline.llm.dartminhash import near_classes
from tideline.llm.decontaminate import blocks, leaks
from tideline.llm.queries import piece_ids_and_digests, table, toxicity_field
from tideline.llm.shipping import ship
from tideline.llm.storage import sized, stored
from tideline.llm.toxicity import toxicity


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under one half; the field learns from the labels beside the
    documents."""
    ship(spark)
    field = toxicity_field(spark, sf_dir, docs)
    (found,) = personal.fresh(docs, "found")
    scored = docs.withColumn(found, toxicity("text", field))
    return scored.where(F.col(found)["score"] < 0.5).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each class of near copies, one without an id only
    if no other is in the class. Texts that share an id are compared each for itself, the
    least digest first; of rows with equal id and text the one with the least digest stays."""
    ship(spark)
    unclear = docs.groupBy("doc_id").count().where("doc_id is null or count > 1")
    if unclear.isEmpty():
        classes = near_classes(docs)
        copies = sized(stored(classes.where("doc_id <> class_id").select("doc_id"), "copies"))
        return docs.join(copies, "doc_id", "left_anti").select(*docs.columns)
    own, number, digest, theirs, rows, row = personal.fresh(docs, "own", "number", "digest", "theirs", "rows", "row")
    keyed = docs.withColumn(digest, F.md5(F.coalesce("text", F.lit(""))))
    keys = keyed.groupBy("doc_id", digest).agg(F.count(F.lit(1)).alias(rows))
    keys = keys.orderBy(F.col("doc_id").asc_nulls_last(), digest)
    keys = stored(
        keys.select(
            F.col("doc_id").alias(own), F.col(digest).alias(theirs), rows, F.monotonically_increasing_id().alias(number)
        ),
        "keys",
    )
    same = F.col("doc_id").eqNullSafe(F.col(own)) & (F.col(digest) == F.col(theirs))
    numbered = stored(keyed.join(sized(keys), same).select(*docs.columns, number, rows), "numbered")
    classes = near_classes(numbered.select(number, "text"), id=number)
    copies = sized(stored(classes.where(F.col(number) != F.col("class_id")).select(number).distinct(), "copies"))
    kept = numbered.join(copies, number, "left_anti")
    whole = F.struct(*docs.columns)  # any types: rows are ordered by a digest, not by their columns
    one = kept.where(F.col(rows) > 1).groupBy(number).agg(F.min_by(whole, F.md5(F.to_json(whole))).alias(row))
    return kept.where(F.col(rows) == 1).select(*docs.columns).unionByName(one.select(f"{row}.*"))


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark items."""
    found = leaks("text", blocks(table(spark, sf_dir, "benchmark")))
    (places,) = personal.fresh(docs, "places")
    return docs.withColumn(places, found).where(F.size(places) == 0).select(*docs.columns)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data as its kind in brackets and `n_chars` counted anew."""
    spotted, base, added = personal.with_spans(docs, personal.train(docs))
    text = personal.redacted(F.col("text"), F.concat(base, added))
    changed = spotted.withColumn("text", text)
    return changed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with digests of them and of the decoded text."""
    ship(spark)
    return piece_ids_and_digests(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_benchmark),
    ("personal_data", redact),
    ("token_ids", tokens),
]

#: No SQL: fitted models, hashed signatures and the tokenizer; tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over `documents`, each one's result written and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
