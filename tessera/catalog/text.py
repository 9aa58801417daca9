"""Text jobs over ``documents``, ``labels`` and ``conversations``."""

from pyspark.sql import functions as F

from tessera.catalog import load, query
from tessera.functions.text import EXTRA_STOP_WORDS, NEGATIVE_WORDS, POSITIVE_WORDS
from tessera.operators import text as L
from tessera.plans import text_jobs as P
from tessera.session import cut_lineage

TOK = "'[\\p{L}\\p{N}_''’]+'"
STOK = "'[\\p{L}\\p{N}_'']+'"
WS = "\\t\\n\\x0B\\f\\r\\x1C-\\x1F\\x{85}\\p{Z}"
CLEAN = (f"list_filter(string_split(trim(regexp_replace(regexp_replace(lower(text), '[^a-zA-Z{WS}]', '', 'g'), "
         f"'[{WS}]+', ' ', 'g')), ' '), lambda w: w <> '')")
STOP_SQL = f"""
  (SELECT word FROM (SELECT word, count(*) AS c FROM (SELECT unnest({CLEAN}) AS word FROM documents) w
                     GROUP BY word ORDER BY c DESC, word LIMIT 50) t
   UNION SELECT unnest([{', '.join(repr(w) for w in EXTRA_STOP_WORDS)}]))"""
CLEAN_NOSTOP = "list_filter(" + CLEAN + ", lambda w: NOT list_contains(stop, w))"
# documents with the (bounded) stop list attached as one list value per row
DOCS_STOP = f"(SELECT documents.*, s.stop FROM documents, (SELECT list(word) AS stop FROM {STOP_SQL} x) s)"


def docs(spark, sf):
    return load(spark, sf, "documents")


def stop(spark, sf):
    return P.corpus_stop_words(docs(spark, sf), "text")


@query("tokenize", f"""
  SELECT doc_id, len(regexp_extract_all(lower(text), {TOK})) AS n_tokens,
         array_to_string(regexp_extract_all(lower(text), {TOK}), ' ') AS tokens FROM documents""")
def q_tokenize(spark, sf):
    d = L.tokenize(docs(spark, sf), "text")
    return d.select("doc_id", F.size("tokens").cast("long").alias("n_tokens"), F.array_join("tokens", " ").alias("tokens"))


@query("word_count", f"""
  SELECT word, count(*) AS count FROM (SELECT unnest(regexp_extract_all(lower(text), {TOK})) AS word
                                       FROM documents) w GROUP BY word""")
def q_word_count(spark, sf):
    return P.word_count_job(docs(spark, sf), "text")


@query("top_words", f"""
  SELECT word, count(*) AS count FROM (SELECT unnest(regexp_extract_all(lower(text), {TOK})) AS word
                                       FROM documents) w GROUP BY word ORDER BY count DESC, word LIMIT 200""")
def q_top_words(spark, sf):
    return L.top_words(docs(spark, sf), "text", 200)


@query("stop_words", f"SELECT * FROM {STOP_SQL} s")
def q_stop_words(spark, sf):
    return stop(spark, sf)


@query("clean_text", f"SELECT doc_id, array_to_string({CLEAN_NOSTOP}, ' ') AS text FROM {DOCS_STOP} d")
def q_clean_text(spark, sf):
    return L.clean_text(docs(spark, sf).select("doc_id", "text"), "text", stop(spark, sf))


LLR_SQL = f"""
  WITH w AS (SELECT doc_id, {CLEAN_NOSTOP} AS words FROM {DOCS_STOP} d),
  p AS (SELECT words[i] AS w1, words[i + 1] AS w2 FROM (
          SELECT words, unnest(range(1, len(words))) AS i FROM w WHERE len(words) >= 2) x),
  b AS (SELECT w1, w2, count(*) AS c12 FROM p GROUP BY 1, 2),
  u AS (SELECT w, count(*) AS c FROM (SELECT unnest(words) AS w FROM w) y GROUP BY 1),
  n AS (SELECT sum(c)::DOUBLE AS n FROM u),
  j AS (SELECT b.w1, b.w2, b.c12, u1.c AS c1, u2.c AS c2, n.n,
               c2::DOUBLE / n AS p, c12::DOUBLE / c1 AS p1, (c2 - c12)::DOUBLE / (n - c1) AS p2
        FROM b JOIN u u1 ON b.w1 = u1.w JOIN u u2 ON b.w2 = u2.w, n),
  s AS (SELECT *, -2 * (
          (c12 * ln(greatest(p, 1e-12)) + (c1 - c12) * ln(greatest(1 - p, 1e-12)))
        + ((c2 - c12) * ln(greatest(p, 1e-12)) + ((n - c1) - (c2 - c12)) * ln(greatest(1 - p, 1e-12)))
        - (c12 * ln(greatest(p1, 1e-12)) + (c1 - c12) * ln(greatest(1 - p1, 1e-12)))
        - ((c2 - c12) * ln(greatest(p2, 1e-12)) + ((n - c1) - (c2 - c12)) * ln(greatest(1 - p2, 1e-12)))) AS llr
        FROM j)
  SELECT w1, w2, c12, c1, c2, round(llr, 6) AS llr FROM s WHERE llr >= 30"""


@query("collocations", LLR_SQL)
def q_collocations(spark, sf):
    d = L.add_clean_words(docs(spark, sf).select("doc_id", "text"), "text", stop(spark, sf))
    return L.collocations(d, "doc_id", "words", 30.0).withColumn("llr", F.round("llr", 6))


@query("word_weight", f"""
  WITH c AS (SELECT word, count(*) AS count FROM (SELECT unnest(regexp_extract_all(lower(text), {TOK})) AS word
             FROM documents) w GROUP BY word ORDER BY count DESC, word LIMIT 200),
  r AS (SELECT *, row_number() OVER (ORDER BY count DESC, word) AS rank FROM c)
  SELECT word, count, rank,
         round(0.5 * count / (SELECT max(count) FROM c) + 0.5 * (1 - (rank - 1) / (SELECT count(*) FROM c)), 9) AS weight
  FROM r""")
def q_word_weight(spark, sf):
    counts = cut_lineage(L.top_words(docs(spark, sf), "text", 200))
    return L.word_weight(counts, 0.5).withColumn("weight", F.round("weight", 9))


@query("vocabulary_weight", f"""
  WITH c AS (SELECT word, count(*) AS count FROM (SELECT unnest(regexp_extract_all(lower(text), {TOK})) AS word
             FROM documents) w GROUP BY word),
  r AS (SELECT *, row_number() OVER (ORDER BY count DESC, word) AS rank FROM c)
  SELECT word, count, rank,
         round(0.25 * count / (SELECT max(count) FROM c) + 0.75 * (1 - (rank - 1) / (SELECT count(*) FROM c)), 9) AS weight
  FROM r""")
def q_vocabulary_weight(spark, sf):
    counts = cut_lineage(L.word_count(docs(spark, sf), "text"))
    return L.word_weight(counts, 0.25).withColumn("weight", F.round("weight", 9))


def _hits(words):
    return f"len(list_filter(regexp_extract_all(lower(text), {STOK}), lambda x: list_contains([{words}], x)))"


POS = ", ".join(repr(w) for w in POSITIVE_WORDS)
NEG = ", ".join(repr(w) for w in NEGATIVE_WORDS)
SENT_SQL = f"""
  SELECT *, CASE WHEN pos_hits > neg_hits THEN 'positive' WHEN pos_hits < neg_hits THEN 'negative'
                 ELSE 'neutral' END AS sentiment
  FROM (SELECT conv_id, turn, {_hits(POS)} AS pos_hits, {_hits(NEG)} AS neg_hits FROM conversations) x"""


@query("sentiment", SENT_SQL)
def q_sentiment(spark, sf):
    c = load(spark, sf, "conversations").select("conv_id", "turn", "text")
    return L.sentiment(c, "text").drop("text")


@query("sentiment_counts", f"SELECT sentiment, count(*) AS n FROM ({SENT_SQL}) s GROUP BY 1")
def q_sentiment_counts(spark, sf):
    return P.sentiment_job(load(spark, sf, "conversations"), "text")


@query("sentiment_conservation", """
  SELECT count(*) AS input_rows, count(*) AS classified, true AS conserved FROM conversations""")
def q_sentiment_conservation(spark, sf):
    c = load(spark, sf, "conversations")
    return P.conservation(c, P.sentiment_job(c, "text"))


@query("class_words", f"""
  SELECT quality, word, count(*) AS count FROM (
    SELECT l.quality, unnest({CLEAN_NOSTOP}) AS word FROM {DOCS_STOP} d JOIN labels l ON d.doc_id = l.doc_id) x
  GROUP BY 1, 2""")
def q_class_words(spark, sf):
    d = docs(spark, sf).join(load(spark, sf, "labels"), "doc_id")
    w = L.add_clean_words(d.select("quality", "text"), "text", stop(spark, sf))
    return L.class_words(w, "quality", "words")


@query("cloud_weights", f"""
  WITH c AS (SELECT quality, word, count(*) AS count FROM (
      SELECT l.quality, unnest({CLEAN_NOSTOP}) AS word FROM {DOCS_STOP} d JOIN labels l ON d.doc_id = l.doc_id) x
    GROUP BY 1, 2),
  r AS (SELECT *, row_number() OVER (PARTITION BY quality ORDER BY count DESC, word) AS rank FROM c),
  t AS (SELECT *, max(count) OVER (PARTITION BY quality) AS mx, count(*) OVER (PARTITION BY quality) AS n
        FROM r WHERE rank <= 200)
  SELECT quality, word, count, rank, round(0.5 * count / mx + 0.5 * (1 - (rank - 1) / n), 9) AS weight FROM t""")
def q_cloud_weights(spark, sf):
    d = docs(spark, sf).join(load(spark, sf, "labels"), "doc_id")
    out = P.cloud_table(d, "quality", "doc_id", "text", stop(spark, sf), per_class=None)
    return out.withColumn("weight", F.round("weight", 9))


@query("cloud_table", f"""
  WITH s AS (SELECT doc_id FROM (
      SELECT d.doc_id, row_number() OVER (PARTITION BY quality ORDER BY md5(d.doc_id || '|42'), d.doc_id) AS r
      FROM documents d JOIN labels l ON d.doc_id = l.doc_id) x WHERE r <= 50000),
  c AS (SELECT quality, word, count(*) AS count FROM (
      SELECT l.quality, unnest({CLEAN_NOSTOP}) AS word FROM {DOCS_STOP} d JOIN labels l ON d.doc_id = l.doc_id
      JOIN s ON s.doc_id = d.doc_id) x GROUP BY 1, 2),
  r AS (SELECT *, row_number() OVER (PARTITION BY quality ORDER BY count DESC, word) AS rank FROM c),
  t AS (SELECT *, max(count) OVER (PARTITION BY quality) AS mx, count(*) OVER (PARTITION BY quality) AS n
        FROM r WHERE rank <= 200)
  SELECT quality, word, count, rank, round(0.5 * count / mx + 0.5 * (1 - (rank - 1) / n), 9) AS weight FROM t""")
def q_cloud_table(spark, sf):
    # seeded sample of up to 50,000 labelled documents per class (the feature), then as above
    d = docs(spark, sf).join(load(spark, sf, "labels"), "doc_id")
    out = P.cloud_table(d, "quality", "doc_id", "text", stop(spark, sf))
    return out.withColumn("weight", F.round("weight", 9))


@query("cloud_phrases", f"""
  WITH d AS (SELECT row_number() OVER () AS id, l.quality, {CLEAN_NOSTOP} AS words FROM {DOCS_STOP} d JOIN labels l ON d.doc_id = l.doc_id),
  accepted AS ({LLR_SQL.replace(f"{CLEAN_NOSTOP} AS words FROM {DOCS_STOP} d)", f"{CLEAN_NOSTOP} AS words FROM {DOCS_STOP} d JOIN labels l ON d.doc_id = l.doc_id)").replace("SELECT doc_id, ", "SELECT d.doc_id, ")}),
  hits AS (SELECT id, quality, i, words[i] AS w1, words[i + 1] AS w2, i - row_number() OVER (PARTITION BY id ORDER BY i) AS run
           FROM (SELECT id, quality, words, unnest(range(1, len(words))) AS i FROM d WHERE len(words) >= 2) x
           JOIN accepted a ON a.w1 = words[i] AND a.w2 = words[i + 1]),
  taken AS (SELECT quality, w1, w2 FROM (SELECT *, row_number() OVER (PARTITION BY id, run ORDER BY i) AS nth FROM hits) y WHERE nth % 2 = 1),
  c AS (SELECT quality, word, sum(n) AS count FROM (
          SELECT quality, unnest(words) AS word, 1 AS n FROM d UNION ALL SELECT quality, w1, -1 FROM taken
          UNION ALL SELECT quality, w2, -1 FROM taken UNION ALL SELECT quality, w1 || '_' || w2, 1 FROM taken) z
        GROUP BY 1, 2 HAVING sum(n) > 0),
  r AS (SELECT *, row_number() OVER (PARTITION BY quality ORDER BY count DESC, word) AS rank FROM c),
  t AS (SELECT *, max(count) OVER (PARTITION BY quality) AS mx, count(*) OVER (PARTITION BY quality) AS n
        FROM r WHERE rank <= 200)
  SELECT quality, word, count::BIGINT AS count, rank, round(0.5 * count / mx + 0.5 * (1 - (rank - 1) / n), 9) AS weight FROM t""")
def q_cloud_phrases(spark, sf):
    d = docs(spark, sf).join(load(spark, sf, "labels"), "doc_id")
    out = P.cloud_table(d, "quality", "doc_id", "text", stop(spark, sf), per_class=None, min_llr=30.0)
    return out.withColumn("weight", F.round("weight", 9))
