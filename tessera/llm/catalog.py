"""The registered queries of the training-data operators: each applies its
operator with production parameters to the whole table it is meant for and
derives the digest columns. ``ORACLE`` has SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm.shared import table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def _query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@_query
def op2_super_min_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups: 3-word shingles, similarity 0.85 or more."""
    from tessera.llm.near_dup import near_duplicates
    return near_duplicates(table(spark, sf_dir, "documents"), k=3, percent=85).drop("shingle_key")


ORACLE["op2_super_min_hash"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS a FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(a) = 0 THEN []::VARCHAR[] WHEN len(a) < 3 THEN [array_to_string(a, ' ')]
    ELSE [a[i] || ' ' || a[i + 1] || ' ' || a[i + 2] for i in range(1, len(a) - 1)] END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2),
links AS (SELECT p.a, p.b FROM pairs p JOIN n na ON na.doc_id = p.a JOIN n nb ON nb.doc_id = p.b
          WHERE 100 * p.c >= 85 * (na.n + nb.n - p.c)),
reach(doc_id, root) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT l.b, r.root FROM reach r JOIN links l ON l.a = r.doc_id),
comp AS (SELECT doc_id, min(root) AS component_id FROM reach GROUP BY doc_id)
SELECT c.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id, c.doc_id = c.component_id AS kept
FROM comp c LEFT JOIN n ON n.doc_id = c.doc_id
"""


@_query
def op3_convolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document; rows with crc32 % 4 = 2 teach nothing."""
    from pyspark.sql import functions as F

    from tessera.llm import toxicity
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2
    model = toxicity.fit(docs, labels.where(~held_out))
    scored = toxicity.score(docs.select("doc_id", "text", "lang"), model)
    limit = toxicity.language_threshold(model)
    return scored.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
                         limit.alias("lang_threshold"), (F.col("score") >= limit).cast("int").alias("predicted_by_lang"))


@_query
def op7_weak_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document: label-model posterior, scorer, decision."""
    from pyspark.sql import functions as F

    from tessera.llm import weak_label
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = weak_label.score(docs, weak_label.fit(docs), posterior="posterior")
    return scored.select("doc_id", "posterior", "score", (F.col("score") >= weak_label.KEEP).alias("kept"))


@_query
def op6_entropy_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes from every document."""
    from pyspark.sql import functions as F

    from tessera.llm.balance import mixed
    return mixed(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).cast("long").alias("taken"), "rate", "copies")


@_query
def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's ids, spans and decoded text."""
    import public_tokenizers
    from pyspark.sql import functions as F

    from tessera.llm.pieces import encode
    rows = encode(table(spark, sf_dir, "documents").select("doc_id", "text"), public_tokenizers.path("piece_bpe_32k.model"))
    return rows.select("doc_id", F.expr("cast(octet_length(ids) div 4 as bigint)").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"), F.crc32(F.concat("begins", "ends")).alias("spans_crc32"))


@_query
def op5_phrase_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and its edit, and their likeness."""
    from tessera.llm.lz_print import compare_next
    return compare_next(table(spark, sf_dir, "documents"))


@_query
def op1_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards 0 to 39 of all documents, equal texts together."""
    from tessera.llm.packing import pack
    return pack(table(spark, sf_dir, "documents"), 40)


@_query
def op8_record_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place and ids, read back from the record files."""
    import public_tokenizers
    from pyspark.sql import functions as F

    from tessera.llm import records
    folder, summary = records.write(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return records.read(spark, folder, summary).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@_query
def op9_host_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page at its host's winning path."""
    from pyspark.sql import functions as F

    from tessera.llm.host_paths import extract
    return extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"), "path")


@_query
def op10_pivot_permutation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links, component and decision of every vector, cosine 0.98 or more."""
    from tessera.llm.pivots import links
    return links(table(spark, sf_dir, "embeddings"))


ORACLE["op10_pivot_permutation"] = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
u AS (SELECT vec_id, label, e, sqrt(list_dot_product(e, e)) AS norm FROM v),
links AS (SELECT x.vec_id AS a, y.vec_id AS b FROM u x JOIN u y ON x.label = y.label AND x.vec_id <> y.vec_id AND len(x.e) = len(y.e)
          WHERE list_dot_product(x.e, y.e) / (x.norm * y.norm) >= 0.98),
reach(vec_id, root) AS (
  SELECT vec_id, vec_id FROM embeddings
  UNION
  SELECT l.b, r.root FROM reach r JOIN links l ON l.a = r.vec_id),
comp AS (SELECT vec_id, min(root) AS component_id FROM reach GROUP BY vec_id),
deg AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT c.vec_id, coalesce(d.n, 0) AS n_links, c.component_id, c.vec_id = c.component_id AS kept
FROM comp c LEFT JOIN deg d ON d.a = c.vec_id
"""


@_query
def op11_metric_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of all vectors: 8 parts, 16 entries, 6 rounds of k-means."""
    from tessera.llm.metric_trees import codes
    return codes(table(spark, sf_dir, "embeddings")).drop("label")


def _op11_oracle(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """Plain k-means: every part against every entry, round by round."""
    def assign(r: int) -> str:
        return f"""a{r} AS (
  SELECT p.n, p.vec_id, p.label, p.part, p.v, min({{'d': list_sum(list_transform(range(1, len(p.v) + 1), lambda i: (p.v[i] - c.v[i]) * (p.v[i] - c.v[i])))::HUGEINT, 'e': c.entry}}) AS best
  FROM p JOIN c{r} c ON c.part = p.part GROUP BY ALL)"""

    def means(r: int) -> str:
        return f"""m{r} AS (
  SELECT part, entry, list(floor_mean ORDER BY i) AS v FROM (
    SELECT part, best.e AS entry, i, (sum(v[i]) - ((sum(v[i]) % count(*)) + count(*)) % count(*)) // count(*) AS floor_mean
    FROM a{r}, (SELECT unnest(range(1, (SELECT max(len(v)) FROM p) + 1)) AS i) GROUP BY part, best.e, i) GROUP BY part, entry),
c{r + 1} AS (SELECT c.part, c.entry, coalesce(m.v::BIGINT[], c.v) AS v FROM c{r} c LEFT JOIN m{r} m ON m.part = c.part AND m.entry = c.entry)"""
    steps = ",\n".join(f"{assign(r)},\n{means(r)}" for r in range(rounds))
    return f"""
WITH whole AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)::BIGINT) AS e, row_number() OVER (ORDER BY vec_id NULLS LAST) AS n FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT n, vec_id, label, part, e[part * len(e) // {parts} + 1:(part + 1) * len(e) // {parts}] AS v FROM whole, (SELECT unnest(range({parts})) AS part)),
c0 AS (SELECT part, n - 1 AS entry, v FROM p WHERE n <= {entries}),
{steps},
{assign(rounds)},
coded AS (SELECT n, vec_id, label, string_agg(printf('%02x', best.e), '' ORDER BY part) AS code, sum(best.d)::BIGINT AS error FROM a{rounds} GROUP BY ALL),
books AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM c{rounds})
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM coded, books
"""


ORACLE["op11_metric_trees"] = _op11_oracle()


@_query
def op12_head_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quarter of the documents drawn towards the benchmark's word runs."""
    from tessera.llm.head_tail import resample
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE["op12_head_tail"] = r"""
WITH polynomial AS (  -- the CRC of each byte value, bit by bit
  SELECT list(list_reduce(list_prepend(b::BIGINT, [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY b) AS t
  FROM range(256) r(b)),
texts AS (
  SELECT doc_id, 0 AS target, text FROM documents UNION ALL SELECT NULL, 1, text FROM benchmark),
w AS (
  SELECT doc_id, target, row_number() OVER () AS n, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS a FROM texts),
f AS (
  SELECT doc_id, target, n, unnest(list_concat(a, CASE WHEN len(a) < 2 THEN []::VARCHAR[] ELSE [a[i] || ' ' || a[i + 1] for i in range(1, len(a))] END)) AS g FROM w),
g AS (SELECT n, target, g, count(*) AS c FROM f GROUP BY ALL),
hashed AS (
  SELECT g, xor(list_reduce(list_prepend(4294967295::BIGINT, [(position(hex[2 * i - 1] IN '0123456789ABCDEF') - 1) * 16 + position(hex[2 * i] IN '0123456789ABCDEF') - 1 for i in range(1, len(hex) // 2 + 1)]::BIGINT[]),
    lambda s, b: xor(t[(xor(s, b) & 255) + 1], s >> 8)), 4294967295) % 10000 AS bucket
  FROM (SELECT DISTINCT g, hex(encode(g)) AS hex FROM g), polynomial),
b AS (SELECT g.n, g.target, h.bucket, sum(g.c) AS c FROM g JOIN hashed h ON h.g = g.g GROUP BY ALL),
total AS (SELECT bucket, sum(c) FILTER (target = 0) AS s, sum(c) FILTER (target = 1) AS t FROM b GROUP BY bucket),
every AS (SELECT coalesce(sum(s), 0)::DOUBLE AS s_all, coalesce(sum(t), 0)::DOUBLE AS t_all FROM total),
gain AS (
  SELECT bucket, floor(1000 * ln(((coalesce(t, 0) + 1)::DOUBLE * (s_all + 10000)) / ((coalesce(s, 0) + 1)::DOUBLE * (t_all + 10000))))::BIGINT AS gain FROM total, every),
weighed AS (SELECT n, sum(c)::BIGINT AS n_features, floor(sum(c * gain)::DOUBLE / sum(c)::DOUBLE)::BIGINT AS weight FROM b JOIN gain ON gain.bucket = b.bucket WHERE b.target = 0 GROUP BY n),
scored AS (
  SELECT w.n, w.doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || coalesce(w.doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM w LEFT JOIN weighed x ON x.n = w.n WHERE w.target = 0),
ranked AS (SELECT n, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST) AS rank, 25 * count(*) OVER () // 100 AS draw FROM scored WHERE n_features >= 39)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= draw THEN rank END AS rank FROM scored s LEFT JOIN ranked r ON r.n = s.n
"""


@_query
def op13_anchor_expansion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: counts, digest and spans."""
    from pyspark.sql import functions as F

    from tessera.llm import anchors_pii
    found = anchors_pii.find(table(spark, sf_dir, "documents").select("doc_id", "text"), name="found")
    counts = [anchors_pii.count_of(F.col("found"), kind).alias(f"n_{kind}") for kind in anchors_pii.BASE]
    return found.select("doc_id", *counts, F.sha2(anchors_pii.listed(F.col("found"), anchors_pii.BASE), 256).alias("base_sha256"),
                        anchors_pii.listed(F.col("found")).alias("spans"))
