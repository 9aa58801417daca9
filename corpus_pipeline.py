"""Corpus pipeline: toxicity, quality, near-duplicates, mixing, tokens.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir),
works on every row its predecessor kept and returns a DataFrame with the
columns of ``documents`` (the last one: the encoded rows). ``run`` applies them
to the documents table, each stage written as Parquet to the shared folder and
read back as the next one's docs.

Rows survive as rows: a stage whose operator joins its decisions back writes its
input once with a key of each row (``keyed``) and joins by that key, so null and
repeated ids neither share a decision nor meet in one task. Null texts pass the
filters by the rules of the operator's own module; rows with the same text and
id are near duplicates like any others; the mixing stage repeats a row as often
as the mix takes it. Extra columns stay, also those with the operators' names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import balance, near_dup, pieces, toxicity, weak_label
from tessera.llm.shared import free_name, table, written

SHINGLE_WORDS = 5
SIMILARITY = 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the convolutional scorer accepts at the threshold of their
    language (the common one for a null language and for those not calibrated)."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    name = free_name(docs, "toxic_score")
    return toxicity.score(docs, model, name=name).where(F.col(name) < toxicity.language_threshold(model)).drop(name)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weakly labelled scorer keeps."""
    model = weak_label.fit(docs)
    name = free_name(docs, "quality_score")
    return weak_label.score(docs, model, name=name).where(F.col(name) >= weak_label.KEEP).drop(name)


def keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` written with a number of each row, and that column's name."""
    key = free_name(docs, "row_key")
    return written(docs.withColumn(key, F.monotonically_increasing_id()), "pipeline-keyed"), key


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate group: the smallest id (nulls last)."""
    rows, key = keyed(docs)
    groups = near_dup.near_duplicates(rows, id_col=key, k=SHINGLE_WORDS, percent=SIMILARITY).select(F.col("doc_id").alias(key), "component_id")
    # one row for each group out of a partial aggregate; all joins are by the row's own key
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col(key).alias("key"))
    first = groups.join(rows.select(key, "doc_id"), key).groupBy("component_id").agg(F.min(order)["key"].alias(key)).select(key)
    return rows.join(first, key, "left_semi").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as many times as the mix to target weights takes it."""
    rows, key = keyed(docs)
    n = free_name(docs, "mix_copies")
    taken = balance.mixed(rows, id_col=key).where("copies > 0").select(F.col("doc_id").alias(key), F.col("copies").alias(n))
    return rows.join(taken, key).withColumn(n, F.explode(F.sequence(F.lit(1), F.col(n)))).select(*docs.columns)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids and byte spans of every row, with digests of both directions."""
    import public_tokenizers
    rows = pieces.encode(docs.select("doc_id", "source", "lang", "text"), public_tokenizers.path("piece_bpe_32k.model"))
    return rows.select("doc_id", "source", "lang", F.expr("cast(octet_length(ids) div 4 as bigint)").alias("n_tokens"), "ids",
                       F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
                       F.crc32(F.concat("begins", "ends")).alias("spans_crc32"))


STAGES = [
    ("toxicity", drop_toxic),
    ("quality classifier", keep_quality),
    ("MinHash near-dedup", drop_near_duplicates),
    ("mixing sources to target weights", mix_sources),
    ("SentencePiece encoding and decoding", encode_pieces),
]

#: Trained classifiers and a tokenizer: SQL cannot express the rows of ``run``.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs, "pipeline-stage")
    return docs
