"""Registered queries of the training-data operators, and the SQL that checks them.

Each query is thin: it applies one operator to its whole table and derives the columns of
its result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import langid, quality, toxicity
from .clustering import cluster
from .conversations import repair
from .decontaminate import decontaminate
from .fingerprints import fingerprint_documents
from .mixing import mix_sources
from .neardup import near_duplicates
from .neighbours import search
from .pages import extract_pages
from .sharding import shard
from .util import held_out, join_rows, read_table
from .warc import read_records, write_archives


def op1_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = decontaminate(read_table(spark, sf_dir, "documents"),
                         read_table(spark, sf_dir, "benchmark"))
    return hits.select(
        F.col("doc").alias("doc_id"), "n_words", "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        contaminated().alias("contaminated"))


def contaminated():
    """The rule of the query and of the pipeline stage: a twentieth of the words is hit."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def op2_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").withColumn("held_out", held_out())
    names, trees = langid.learn(docs, ~F.col("held_out"))
    return langid.identify(docs, names, trees, ["doc_id", "held_out"])


def op3_invertible_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    prints = fingerprint_documents(read_table(spark, sf_dir, "documents"))
    return prints.withColumnRenamed("doc", "doc_id")


def op4_cube_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mix_sources(read_table(spark, sf_dir, "documents"))
    return mix.select(F.col("doc").alias("doc_id"), "size", "source_size", "target",
                      (F.col("copies") * F.col("size")).alias("taken"))


def op5_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = write_archives(read_table(spark, sf_dir, "pages"))
    return read_records(index, payloads=False).select(
        F.col("id").cast("long").alias("page_id"), "payload_bytes", "payload_digest",
        F.col("type").alias("record_type"), F.col("refers").cast("long").alias("refers_to"))


def _classified(spark: SparkSession, sf_dir: str, kind, label: str, threshold: float) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").withColumn("held_out", held_out())
    labels = read_table(spark, sf_dir, "labels").where(~held_out())
    model = kind.fit(docs, labels, label)
    return kind.score(docs, model, ["doc_id", "held_out"]).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int"))


def op7_ftrl(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _classified(spark, sf_dir, toxicity, "toxic", 0.3)


def op9_random_indexing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _classified(spark, sf_dir, quality, "quality", 0.7)


def op6_min_max_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = near_duplicates(read_table(spark, sf_dir, "documents"))
    return groups.select(F.col("doc").alias("doc_id"), "n_shingles",
                         F.col("component").alias("component_id"),
                         F.col("doc").eqNullSafe(F.col("component")).alias("kept"))


def op8_site_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = extract_pages(read_table(spark, sf_dir, "pages"))
    return pages.select(F.col("pid").alias("page_id"), "url", "text",
                        F.char_length("text").cast("long").alias("n_chars"))


def op10_minimax_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharded(read_table(spark, sf_dir, "documents"))


def sharded(docs: DataFrame) -> DataFrame:
    """Rows of the query and of the last pipeline stage."""
    return shard(docs).select(
        F.col("doc").alias("doc_id"), "size", "text_crc32", F.lit("bytes").alias("law"),
        "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op11_multi_index_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "embeddings")
    found = search(rows, rows.where(F.col("vec_id") % 50 == 0))
    return found.select(F.col("query").alias("query_id"), "rank", F.col("id").alias("vec_id"), "score")


def damaged(rows: DataFrame) -> DataFrame:
    """The faults that the query plants, by crc32 of conversation and turn."""
    known = {c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")}
    kind = F.crc32(F.concat(known["conv_id"], F.lit(":"), known["turn"]).cast("binary")) % 20
    return (rows.select("conv_id", "turn", known["role"].alias("role"), known["text"].alias("text"), kind.alias("kind"))
            .where("kind != 0")
            .withColumns({"text": F.when(F.col("kind") == 1, "").when(
                F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")),
                "role": F.when(F.col("kind") == 4, "user").otherwise(F.col("role")),
                "copy": F.explode(F.array_repeat(F.lit(1), F.when(F.col("kind") == 3, 2).otherwise(1)))})
            .select("conv_id", "turn", "role", "text"))


def op12_bidirectional_dijkstra(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "conversations")
    found = repair(damaged(rows)).withColumnRenamed("conv", "conv_id")
    every = join_rows(rows.select("conv_id").distinct(), found, ["conv_id"], "left")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return every.select(
        "conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("digest", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))


def op13_equal_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = cluster(read_table(spark, sf_dir, "embeddings"))
    components = F.transform("centroid", lambda c: c.cast("string"))
    return found.select(
        F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia",
        F.sha2(F.array_join(components, ",").cast("binary"), 256).alias("centroid_sha256"))


QUERIES = {f.__name__: f for f in (
    op1_winnowing, op2_ppm, op3_invertible_sketch, op4_cube_sampling, op5_warc_index,
    op6_min_max_hashing, op7_ftrl, op8_site_templates, op9_random_indexing,
    op10_minimax_shards, op11_multi_index_hashing,
    op12_bidirectional_dijkstra, op13_equal_average)}

_OP1 = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item_id, regexp_extract_all(translate(coalesce(text, ''),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(13, len(w)) AS t,
         array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS g
       FROM b, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS u(i) WHERE len(w) > 0),
ts AS (SELECT DISTINCT t FROM bw),
dw AS (SELECT r, t, i, array_to_string(w[i:i + t - 1], ' ') AS g
       FROM d, ts, unnest(range(1, len(w) - t + 2)) AS u(i) WHERE len(w) >= t),
h AS (SELECT dw.r, dw.t, dw.i, bw.item_id FROM dw JOIN bw ON dw.t = bw.t AND dw.g = bw.g),
p AS (SELECT r, count(DISTINCT j) AS n FROM h, unnest(range(i, i + t)) AS u(j) GROUP BY r),
m AS (SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
      FROM (SELECT DISTINCT r, item_id FROM h) GROUP BY r)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(p.n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(p.n, 0) > 0 AND 20 * coalesce(p.n, 0) >= len(w) AS contaminated
FROM d LEFT JOIN p USING (r) LEFT JOIN m USING (r)
"""

_OP6 = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g
      FROM d, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS u(i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g
      WHERE x.doc_id <> y.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM c JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
      WHERE 100 * c >= 85 * (na.n + nb.n - c)),
r(a, b) AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
m AS (SELECT a, min(b) AS b FROM r GROUP BY a)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles,
       least(d.doc_id, coalesce(m.b, d.doc_id)) AS component_id,
       d.doc_id = least(d.doc_id, coalesce(m.b, d.doc_id)) AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN m ON m.a = d.doc_id
"""

_OP5 = r"""
WITH p AS (SELECT page_id, sha256(coalesce(html, '')) AS d,
             octet_length(encode(coalesce(html, ''))) AS n FROM pages),
f AS (SELECT d, min(page_id) AS first FROM p WHERE n >= 100 GROUP BY d)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, p.d AS payload_digest,
       CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN 'revisit'
            ELSE 'response' END AS record_type,
       CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM p LEFT JOIN f ON f.d = p.d
"""

_OP11 = """
WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE vec_id IS NOT NULL
  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)
    / (sqrt(list_dot_product(q.e, q.e)) * sqrt(list_dot_product(c.e, c.e))) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 5
"""

# a step of the recursion takes one row: the cheapest (cost, letters) that end in each of the
# four states of (s?(ua)+)?, first without, then with insertions behind the row
_OP12 = r"""
WITH RECURSIVE t AS (SELECT *, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(key, ''),
      lambda ch: CAST(ascii(ch) AS BIGINT))), lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)),
      lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) % 20 AS kind
  FROM (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations)),
d AS (SELECT dense_rank() OVER (ORDER BY conv_id) AS k, turn, kind, copy,
    CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, conv_id
  FROM t, unnest(range(CASE kind WHEN 3 THEN 2 ELSE 1 END)) AS u(copy)),
n AS (SELECT k, turn, role, text, row_number() OVER (PARTITION BY k ORDER BY turn NULLS FIRST, role, text) AS i,
    rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS seen, left(role, 1) AS ini
  FROM d WHERE kind <> 0),
f AS (SELECT *, CASE WHEN seen = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY k, role, text ORDER BY i) > 1
    THEN 'duplicate' WHEN right(seen, 1) NOT IN ('.', '!', '?') THEN 'truncated' END AS fault,
    lag(ini) OVER (PARTITION BY k ORDER BY i) || ini AS pair FROM n),
g AS (SELECT *, coalesce(fault IN ('blank', 'duplicate'), false) AS gone,
    CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END AS more FROM f),
w AS (SELECT k, CAST(0 AS BIGINT) AS i, [{'c': 0, 'a': ''}, {'c': 1000000000, 'a': ''},
      {'c': 5, 'a': 'I'}, {'c': 10, 'a': 'II'}] AS b FROM (SELECT DISTINCT k FROM d)
  UNION ALL
  SELECT k, i, [b[1], b[2], b[3], list_min([b[4], {'c': b[3].c + 5, 'a': b[3].a || 'I'}])] AS b FROM (
    SELECT k, i, [b[1], b[2], list_min([b[3], {'c': b[1].c + 5, 'a': b[1].a || 'I'},
        {'c': b[2].c + 5, 'a': b[2].a || 'I'}, {'c': b[4].c + 5, 'a': b[4].a || 'I'}]), b[4]] AS b FROM (
      SELECT w.k, g.i, [
        {'c': b[1].c + 2, 'a': b[1].a || 'D'},
        list_min([{'c': b[2].c + 2, 'a': b[2].a || 'D'},
          {'c': CASE WHEN ini = 's' AND NOT gone THEN b[1].c + more ELSE 1000000000 END, 'a': b[1].a || 'K'}]),
        list_min(list_concat([{'c': b[3].c + 2, 'a': b[3].a || 'D'}], list_transform([b[1], b[2], b[4]], lambda x:
          {'c': CASE WHEN gone THEN 1000000000 WHEN ini = 'u' THEN x.c + more ELSE x.c + more + 1 END,
           'a': x.a || CASE WHEN ini = 'u' THEN 'K' ELSE 'R' END}))),
        list_min([{'c': b[4].c + 2, 'a': b[4].a || 'D'},
          {'c': CASE WHEN gone THEN 1000000000 WHEN ini = 'a' THEN b[3].c + more ELSE b[3].c + more + 1 END,
           'a': b[3].a || CASE WHEN ini = 'a' THEN 'K' ELSE 'R' END}])] AS b
      FROM w JOIN g ON g.k = w.k AND g.i = w.i + 1))),
e AS (SELECT k, list_min([b[1], b[4]]) AS x FROM w QUALIFY row_number() OVER (PARTITION BY k ORDER BY i DESC) = 1),
l AS (SELECT k, j, x.a[j] AS edit, len(replace(left(x.a, j), 'I', '')) AS i,
    len(replace(left(x.a, j), 'D', '')) - 1 - len(replace(x.a, 'D', '')) % 2 AS place
  FROM e, unnest(range(1, len(x.a) + 1)) AS u(j)),
o AS (SELECT l.k, string_agg(CASE WHEN edit = 'K' THEN role WHEN place % 2 = 0 THEN 'user' ELSE 'assistant' END
    || ':' || CASE WHEN edit = 'I' THEN '' ELSE text END, chr(10) ORDER BY j) AS t
  FROM l JOIN g ON g.k = l.k AND g.i = greatest(l.i, 1) WHERE edit <> 'D' GROUP BY l.k),
c AS (SELECT k, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM g GROUP BY k)
SELECT z.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank,
  coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  CAST(e.x.c AS BIGINT) AS cost, e.x.a AS audit, sha256(coalesce(o.t, '')) AS repaired_sha256
FROM (SELECT DISTINCT k, conv_id FROM d) z JOIN e USING (k) LEFT JOIN c USING (k) LEFT JOIN o USING (k)
"""

# the rounds are one text: every vector to its nearest centroid, then exact floored means
_ASSIGN = """a{i} AS (SELECT r, vec_id, v, c, d FROM (
  SELECT k.r, k.vec_id, k.v, m.c, CAST(list_sum(list_transform(list_zip(k.v, m.m),
           lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS d,
         row_number() OVER (PARTITION BY k.r ORDER BY d, m.c) AS best FROM k, m{i} m) WHERE best = 1)"""
_MOVE = """m{j} AS (SELECT c, list(t ORDER BY i) AS m FROM (
  SELECT c, i, CAST((s - ((s % n) + n) % n) // n AS BIGINT) AS t FROM (
    SELECT c, i, sum(v[i]) AS s, count(*) AS n FROM a{i}, unnest(range(1, 65)) AS u(i) GROUP BY c, i)) GROUP BY c
  UNION ALL SELECT c, m FROM m{i} WHERE c NOT IN (SELECT c FROM a{i}))"""
_OP13 = """
WITH k AS (SELECT row_number() OVER () AS r, vec_id,
  list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
m0 AS (SELECT CAST(row_number() OVER (ORDER BY h, v) - 1 AS INTEGER) AS c, v AS m
  FROM (SELECT sha256('1:' || vec_id) AS h, v FROM k ORDER BY h NULLS LAST, v LIMIT 16)),
""" + ",\n".join(_ASSIGN.format(i=i) + ",\n" + _MOVE.format(i=i, j=i + 1) for i in range(3)) + ",\n" \
    + _ASSIGN.format(i=3) + """
SELECT vec_id, a3.c AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY a3.c) AS BIGINT) AS cluster_inertia,
  CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(m3.m, ',')) AS centroid_sha256
FROM a3 JOIN m3 ON m3.c = a3.c
"""

ORACLE = {"op1_winnowing": _OP1, "op5_warc_index": _OP5, "op6_min_max_hashing": _OP6,
          "op11_multi_index_hashing": _OP11, "op12_bidirectional_dijkstra": _OP12,
          "op13_equal_average": _OP13}
