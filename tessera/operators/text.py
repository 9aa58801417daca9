"""Text jobs (L1-L7): tokens, word frequency, collocations, weights, keyword
sentiment, words by class. Tokenising is a JVM regex; counting is a partial
aggregate, so a very common word costs one row per task before the shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.ranges import asc, desc
from tessera.operators.windows import global_rank
from tessera.session import cut_lineage
from tessera.functions.text import (
    NEGATIVE_WORDS, POSITIVE_WORDS, SENTIMENT_TOKEN, WORDCOUNT_TOKEN, count_members, explode_words,
    html_unescape, letters_only_words, tokens,
)


def tokenize(df: DataFrame, text: str, pattern: str = WORDCOUNT_TOKEN, name: str = "tokens") -> DataFrame:
    """L1: lower-cased regex tokens as an array column."""
    return df.withColumn(name, tokens(text, pattern))


def word_count(df: DataFrame, text: str, pattern: str = WORDCOUNT_TOKEN) -> DataFrame:
    """(word, count) over all texts."""
    words = explode_words(df, tokens(text, pattern))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("count"))


def stop_list(stop) -> Column:
    """Stop words joined by ``,``, with one before the first: a Python list becomes
    a literal, a one-column DataFrame (bounded, e.g. a word list table) a scalar
    subquery. Only words of lower-case letters can meet a cleaned word; the others
    are left out."""
    if isinstance(stop, DataFrame):
        word = F.col(f"`{stop.columns[0]}`")
        return stop.filter(word.rlike("^[a-z]+$")).select(F.concat(F.lit(","), F.array_join(F.sort_array(F.collect_set(word)), ","))).scalar()
    return F.lit("," + ",".join(sorted(w for w in set(stop) if w and w.isascii() and w.isalpha() and w.islower())))


def add_clean_words(df: DataFrame, text: str, stop, name: str = "words", unescape: bool = True) -> DataFrame:
    """L2 as an array column: unescape HTML, lower, keep ASCII letters and
    whitespace, split, drop stop words (duplicates and order kept): built-in
    functions."""
    src = html_unescape(F.col(text)) if unescape else F.col(text)
    # a column, since a subquery cannot stand in a lambda
    held = df.withColumn("_stop", stop_list(stop))
    return held.withColumn(name, letters_only_words(src, F.col("_stop"))).drop("_stop")


def clean_text(df: DataFrame, text: str, stop, name: str | None = None, unescape: bool = True) -> DataFrame:
    """L2: cleaned text joined by single spaces."""
    out = add_clean_words(df, text, stop, "_words", unescape)
    return out.withColumn(name or text, F.array_join("_words", " ")).drop("_words")


def top_words(df: DataFrame, text: str, k: int = 200, pattern: str = WORDCOUNT_TOKEN) -> DataFrame:
    """L3: the k most frequent words (ties by word)."""
    return word_count(df, text, pattern).orderBy(F.col("count").desc(), F.col("word")).limit(k)


def _ll(k: Column, n: Column, x: Column) -> Column:
    eps = F.lit(1e-12)
    return k * F.ln(F.greatest(x, eps)) + (n - k) * F.ln(F.greatest(1 - x, eps))


def collocations(df: DataFrame, id_col: str, words: str, min_llr: float = 30.0, materialize: bool = True) -> DataFrame:
    """L4: adjacent word pairs scored by Dunning's log-likelihood ratio; the
    score is the only rule (two words seen once, together, pass it in a large
    corpus).

    ``words`` is an array column. One explode emits every position as
    (word, next word or null); a single partial aggregate over those pairs is
    the only pass over the texts. Unigram counts, the corpus size and the
    bigram counts are all derived from that aggregate, which is checkpointed
    once (``materialize``) into the shared checkpoint folder so the three
    consumers do not each re-run the text pipeline. The unigrams, far fewer than
    the pairs, are the hashed side of both joins, so the pairs are not sorted.
    """
    arr = F.col(words)
    # (w[i], w[i+1]) for every position, the last with a null partner; a
    # built-in zip instead of a per-element lambda
    nxt = F.slice(arr, 2, F.greatest(F.size(arr), F.lit(1)))
    grams = explode_words(df, F.arrays_zip(arr.alias("w1"), nxt.alias("w2")), "p")
    pairs = (grams.filter(F.col("p.w1").isNotNull())
             .groupBy(F.col("p.w1").alias("w1"), F.col("p.w2").alias("w2"))
             .agg(F.count(F.lit(1)).alias("c12")))
    if materialize:
        pairs = cut_lineage(pairs)
    unigrams = pairs.groupBy("w1").agg(F.sum("c12").alias("c"))
    n = unigrams.select(F.sum("c")).scalar()
    bigrams = pairs.filter(F.col("w2").isNotNull())
    u1 = unigrams.select(F.col("w1"), F.col("c").alias("c1"))
    u2 = unigrams.select(F.col("w1").alias("w2"), F.col("c").alias("c2"))
    j = bigrams.join(u1.hint("shuffle_hash"), "w1").join(u2.hint("shuffle_hash"), "w2")
    c12, c1, c2 = F.col("c12").cast("double"), F.col("c1").cast("double"), F.col("c2").cast("double")
    p, p1, p2 = c2 / n, c12 / c1, (c2 - c12) / (n - c1)
    llr = -2 * (_ll(c12, c1, p) + _ll(c2 - c12, n - c1, p) - _ll(c12, c1, p1) - _ll(c2 - c12, n - c1, p2))
    return j.withColumn("llr", llr).filter(F.col("llr") >= min_llr).select(
        "w1", "w2", "c12", "c1", "c2", "llr")


def word_weight(counts: DataFrame, scaling: float = 0.5, word: str = "word", count: str = "count") -> DataFrame:
    """Relative weight of each word of a frequency table of any size:
    ``s * c / max(c) + (1 - s) * (1 - (rank - 1) / n)`` (0 = rank only, 1 = ratio),
    ranked by falling count, then word. The words are numbered by ``global_rank``,
    so no window holds the vocabulary, and the words counted once, half of it,
    are spread over many ranges. ``counts`` is read several times: hand over a
    written table where it is costly."""
    mx = counts.select(F.max(count)).scalar()
    n = counts.select(F.count(F.lit(1))).scalar()
    return (global_rank(counts, [desc(count), asc(word)], "rank")
            .withColumn("weight", F.lit(scaling) * F.col(count) / mx
                        + F.lit(1 - scaling) * (1 - (F.col("rank") - 1) / n)))


def sentiment(df: DataFrame, text: str, pos=POSITIVE_WORDS, neg=NEGATIVE_WORDS,
              name: str = "sentiment") -> DataFrame:
    """More positive than negative keyword hits -> 'positive', fewer ->
    'negative', equal -> 'neutral'; repeated keywords count each time."""
    toks = tokens(text, SENTIMENT_TOKEN)
    p, q = count_members(toks, pos), count_members(toks, neg)
    return (df.withColumn("pos_hits", p).withColumn("neg_hits", q)
            .withColumn(name, F.when(F.col("pos_hits") > F.col("neg_hits"), "positive")
                        .when(F.col("pos_hits") < F.col("neg_hits"), "negative").otherwise("neutral")))


def sentiment_counts(df: DataFrame, text: str, pos=POSITIVE_WORDS, neg=NEGATIVE_WORDS) -> DataFrame:
    """Records per sentiment class."""
    return sentiment(df, text, pos, neg).groupBy("sentiment").agg(F.count(F.lit(1)).alias("n"))


def class_words(df: DataFrame, cls: str, words: str) -> DataFrame:
    """Word frequency per class from an array column (no driver-side string)."""
    return (explode_words(df, F.col(words), "word", keep=[cls])
            .groupBy(cls, "word").agg(F.count(F.lit(1)).alias("count")))


def merged_phrase_counts(df: DataFrame, cls: str, words: str, pairs: DataFrame, joint: str = "_") -> DataFrame:
    """Word frequency per class after accepted pairs became one token.

    Each array is read from left to right: a word and its follower that are in
    ``pairs`` (w1, w2) make one token ``w1_w2``, and reading goes on behind them.
    So of a run of overlapping accepted pairs every second one is taken, from the
    first. Only positions with an accepted pair are dealt by row, for that rule;
    all other words stay a partial aggregate: word counts, less the words that
    phrases took, plus the phrases. The accepted pairs are the hashed side where
    they meet the positions, so the positions are not sorted."""
    counts = class_words(df, cls, words)
    arr = F.col(words)
    grams = F.arrays_zip(arr.alias("w1"), F.slice(arr, 2, F.greatest(F.size(arr), F.lit(1))).alias("w2"))
    placed = df.withColumn("_row", F.monotonically_increasing_id()).select(cls, "_row", F.posexplode_outer(grams).alias("_at", "_p"))
    placed = placed.where(F.col("_p.w2").isNotNull()).select(cls, "_row", "_at", F.col("_p.w1").alias("w1"), F.col("_p.w2").alias("w2"))
    hits = placed.join(pairs.select("w1", "w2").distinct().hint("shuffle_hash"), ["w1", "w2"])
    run = F.col("_at") - F.row_number().over(Window.partitionBy("_row").orderBy("_at"))
    nth = F.row_number().over(Window.partitionBy("_row", "_run").orderBy("_at"))
    taken = hits.withColumn("_run", run).withColumn("_nth", nth).where(F.col("_nth") % 2 == 1)
    each = F.array(F.struct(F.col("w1").alias("word"), F.lit(-1).cast("long").alias("count")),
                   F.struct(F.col("w2").alias("word"), F.lit(-1).cast("long").alias("count")),
                   F.struct(F.concat_ws(joint, "w1", "w2").alias("word"), F.lit(1).cast("long").alias("count")))
    changed = taken.select(cls, F.inline(each))
    return counts.unionByName(changed).groupBy(cls, "word").agg(F.sum("count").alias("count")).where(F.col("count") > 0)
