"""Text jobs: word count (P9), sentiment totals (P10), word-cloud tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.text import EXTRA_STOP_WORDS, explode_words, html_unescape, letters_only_words
from tessera.operators.ordering import sample_n
from tessera.operators.text import add_clean_words, class_words, collocations, merged_phrase_counts, sentiment_counts, word_count
from tessera.operators.windows import topn
from tessera.session import cut_lineage


def word_count_job(lines: DataFrame, text: str = "value") -> DataFrame:
    """Text lines -> (word, count)."""
    return word_count(lines, text)


def sentiment_job(records: DataFrame, text: str = "text") -> DataFrame:
    """P10: records per class; ``conservation`` checks the totals add up."""
    return sentiment_counts(records, text)


def conservation(records: DataFrame, counts: DataFrame) -> DataFrame:
    """Class totals must equal the input rows."""
    n_in = records.select(F.count(F.lit(1))).scalar()
    return counts.agg(F.sum("n").alias("classified")).select(
        n_in.alias("input_rows"), "classified", (F.col("classified") == n_in).alias("conserved"))


def corpus_stop_words(docs: DataFrame, text: str, n: int = 50, extra=EXTRA_STOP_WORDS) -> DataFrame:
    """A stop list derived by rule from the corpus itself: its n most frequent
    cleaned words (ties by word) plus the extra words. Used when no general
    English list is supplied; bounded at n + len(extra) rows."""
    words = explode_words(docs, letters_only_words(html_unescape(F.col(text))))
    top = (words.groupBy("word").agg(F.count(F.lit(1)).alias("c"))
           .orderBy(F.col("c").desc(), F.col("word")).limit(n).select("word"))
    extra_df = docs.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, extra)).cast("array<string>")).alias("word"))
    return top.union(extra_df).distinct()


def class_word_weights(counts: DataFrame, cls: str, k: int = 200, scaling: float = 0.5) -> DataFrame:
    """L3+L5 per class: top k words of each class and their relative weight.
    Windows run over at most k rows per class (group limit before the shuffle)."""
    top = topn(counts, cls, [F.col("count").desc(), F.col("word")], k, "row", name="rank")
    w = Window.partitionBy(cls)
    return (top.withColumn("_max", F.max("count").over(w)).withColumn("_n", F.count(F.lit(1)).over(w))
            .withColumn("weight", F.lit(scaling) * F.col("count") / F.col("_max")
                        + F.lit(1 - scaling) * (1 - (F.col("rank") - 1) / F.col("_n")))
            .drop("_max", "_n"))


def _written_words(df: DataFrame, cls: str, words: str) -> DataFrame:
    """``cls`` and ``words``, checkpointed as texts of words and single spaces (a
    third of the arrays' size)."""
    held = cut_lineage(df.select(cls, F.array_join(words, " ").alias("_text")))
    return held.select(cls, F.when(F.col("_text") == "", F.array().cast("array<string>")).otherwise(F.split("_text", " ")).alias(words))


def cloud_table(records: DataFrame, cls: str, id_col: str, text: str, stop, per_class: int | None = 50_000,
                k: int = 200, scaling: float = 0.5, seed: int = 42, min_llr: float | None = None) -> DataFrame:
    """Clean text, optional seeded sample of ``per_class`` records per
    class, word counts per class, top k with weights. With ``min_llr`` the word
    pairs whose log-likelihood ratio over these records reaches it become one
    token ``w1_w2`` before counting; the cleaned words, read three times then, are
    written once."""
    recs = records.select(*dict.fromkeys([cls, id_col, text]))
    if per_class is not None:
        recs = sample_n(recs, cls, id_col, per_class, seed)
    words = add_clean_words(recs.select(cls, text), text, stop, "words")
    if min_llr is None:
        counts = class_words(words, cls, "words")
    else:
        words = _written_words(words, cls, "words")
        counts = merged_phrase_counts(words, cls, "words", collocations(words, cls, "words", min_llr))
    return class_word_weights(counts, cls, k, scaling)
