"""The queries of this package and their SQL, for ``__spark_entry__``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from histdim.llm.frames import table


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every text of ``documents``."""
    from histdim.llm.spans import digest_spans
    from histdim.llm.secrets import BASE_RULES, scan_secrets

    found = scan_secrets(table(spark, sf_dir, "documents"))
    return digest_spans(found, "doc_id", [r.kind for r in BASE_RULES])


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words left of every document once repeated 13-word passages are removed."""
    from histdim.llm.substrings import DedupParams, kept_texts

    kept = kept_texts(table(spark, sf_dir, "documents"), params=DedupParams(window=13))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


OP2_SQL = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
g AS (
  SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS s
  FROM w, unnest(range(1, greatest(len(ws) - 11, 1))) AS t(i)),
f AS (SELECT s, min(doc_id) AS m FROM g GROUP BY s),
r AS (
  SELECT DISTINCT g.doc_id, g.i + j AS p
  FROM g JOIN f USING (s), unnest(range(13)) AS u(j) WHERE f.m < g.doc_id),
p AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS p FROM w),
k AS (
  SELECT p.doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p.p) AS kept
  FROM p ANTI JOIN r ON p.doc_id = r.doc_id AND p.p = r.p GROUP BY p.doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(k.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k.kept, '')) AS kept_sha256
FROM w LEFT JOIN k ON w.doc_id = k.doc_id
"""


def label_domain() -> Column:
    """The domain that a row of ``labels`` stands for."""
    return F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "good").when(F.col("quality") == 0, "poor")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posterior, rate and copies of every document for the target domain weights."""
    from histdim.llm.mixing import document_rates

    labels = table(spark, sf_dir, "labels").select("doc_id", label_domain().alias("domain"))
    return document_rates(table(spark, sf_dir, "documents"), labels, {"good": 0.85, "poor": 0.1, "toxic": 0.05})


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule statistics and the verdict on every document."""
    from histdim.llm.quality import judge_documents

    return judge_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "anomaly")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's token ids, packed into rows of 2048."""
    from histdim.llm.packing import PackParams, pack_documents

    return pack_documents(table(spark, sf_dir, "documents"), params=PackParams(length=2048))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-copy component of every document."""
    from histdim.llm.simhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"), shingle=4, radius=4)


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page through WARC archives and back, by way of the merged index."""
    from histdim.llm.warc import archived_index
    from histdim.session import scratch_path

    index = archived_index(table(spark, sf_dir, "pages"), scratch_path(spark, "warc"))
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "timestamp", "position")


OP7_SQL = r"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS h, coalesce(url, '') AS u,
         string_split(regexp_replace(lower(regexp_extract(url, '^[A-Za-z]+://([^/?#]+)', 1)), '^www\.|:(80|443)$', '', 'g'), ':') AS host,
         regexp_extract(url, '^[A-Za-z]+://[^/?#]+([^?#]*)', 1) AS path, regexp_extract(url, '^[^#?]*\?([^#]*)', 1) AS query
  FROM pages),
d AS (
  SELECT page_id, h, sha1(h) AS x, min(page_id) OVER (PARTITION BY h) AS m,
         CASE WHEN u = '' THEN '' ELSE
           array_to_string(list_reverse(string_split(host[1], '.')), ',') || coalesce(':' || host[2], '') || ')' ||
           CASE WHEN path = '' THEN '/' ELSE path END || CASE WHEN query = '' THEN '' ELSE '?' || query END END AS url_key,
         strftime(TIMESTAMP '2024-01-01' + to_seconds(coalesce(page_id, 0) % 1000000000), '%Y%m%d%H%M%S') AS timestamp
  FROM p)
SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         CAST(1 + ((CAST('0x' || substr(x, CAST(1 + 5 * (i // 4) AS INT), 5) AS INT) >> CAST(15 - 5 * (i % 4) AS INT)) & 31) AS INT), 1)), '')
         AS payload_digest,
       CASE WHEN page_id = m THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> m THEN m END AS refers_to, url_key, timestamp,
       row_number() OVER (ORDER BY url_key, timestamp, page_id NULLS FIRST) - 1 AS position
FROM d
"""


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every text of ``documents``, also disguised."""
    from histdim.llm.pii import KINDS, find_personal_data
    from histdim.llm.spans import digest_spans

    return digest_spans(find_personal_data(table(spark, sf_dir, "documents")), "doc_id", KINDS)


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents into which a benchmark item leaked, with the item."""
    from histdim.llm.tiling import TilingParams, find_leaks

    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), params=TilingParams())


def op10_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    from histdim.llm.html import extract_main_text

    return extract_main_text(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op11_va_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster, distance and inertia of every 64-component vector of ``embeddings``."""
    from histdim.llm.vafile import ClusterParams, cluster

    return cluster(table(spark, sf_dir, "embeddings"), params=ClusterParams(dims=64, scale=64, k=16, rounds=3))


def _op11_sql() -> str:
    near = """a{r} AS (
  SELECT i, v, arg_min(c, (list_sum(list_transform(range(1, 65), lambda j: (v[j] - w[j]) * (v[j] - w[j]))), c)) AS c
  FROM x, c{r} GROUP BY i, v),
"""
    move = """m{r} AS (
  SELECT c, j, sum(y) AS s, count(*) AS n
  FROM (SELECT c, unnest(v) AS y, unnest(range(1, 65)) AS j FROM a{r}) GROUP BY c, j),
u{r} AS (SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY j) AS w FROM m{r} GROUP BY c),
c{n} AS (SELECT c{r}.c, coalesce(u{r}.w, c{r}.w) AS w FROM c{r} LEFT JOIN u{r} USING (c)),
"""
    steps = "".join(near.format(r=r) + move.format(r=r, n=r + 1) for r in range(3))
    return f"""
WITH x AS (
  SELECT row_number() OVER () AS i, vec_id, list_transform(embedding, lambda y: CAST(floor(64 * CAST(y AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda y: y IS NULL OR NOT isfinite(y))) = 0),
c0 AS (
  SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id), v) - 1 AS c, v AS w FROM x
  QUALIFY row_number() OVER (ORDER BY sha256('1:' || vec_id), v) <= 16),
{steps}{near.format(r=3)}d AS (
  SELECT i, a3.c, list_sum(list_transform(range(1, 65), lambda j: (v[j] - w[j]) * (v[j] - w[j]))) AS distance, w
  FROM a3 JOIN c3 USING (c))
SELECT vec_id, CAST(c AS INT) AS cluster, CAST(distance AS BIGINT) AS distance,
       CAST(sum(distance) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
       CAST(sum(distance) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(w, ',')) AS centroid_sha256
FROM d JOIN x USING (i)
"""


def op12_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 rows of ``embeddings`` with the largest inner products, for each whose vec_id is divisible by 20."""
    from histdim.llm.crosspolytope import HashParams, nearest

    return nearest(table(spark, sf_dir, "embeddings"), asks=F.col("id") % 20 == 0, params=HashParams(k=20))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie of ``conversations``, rebuilt to share their first turns."""
    from histdim.llm.trie import conversations, prefix_trie, rebuilt

    return prefix_trie(rebuilt(conversations(table(spark, sf_dir, "conversations"))))


#: crc32 is written out, as this dialect has none.
OP13_SQL = """
WITH t AS (
  SELECT conv_id AS c, {'r': coalesce(role, ''), 't': coalesce(text, '')} AS x,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(coalesce(role, '') || ':' || coalesce(text, ''))) AS i
  FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT c, list(x ORDER BY i) AS own FROM t GROUP BY c),
z AS (
  SELECT c, own, xor(list_reduce(
      list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(c::VARCHAR, ''), lambda s: [ascii(s)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
      lambda a, b: xor(xor(a, b) >> 1, 3988292384 * (xor(a, b) & 1))), 4294967295) % 9 AS h
  FROM o),
s AS (
  SELECT z.c, list_concat(coalesce(b.own[1:z.h], []), z.own[z.h + 1:]) AS seq
  FROM z LEFT JOIN o AS b ON b.c = z.c - z.c % 5),
p AS (SELECT c, unnest(range(0, len(seq) + 1)) AS d, seq FROM s),
q AS (SELECT c, d, len(seq) AS l, seq[1:d] AS pre, min(c) OVER (PARTITION BY d, seq[1:d]) AS m FROM p),
k AS (
  SELECT m, d, count(*) AS n, any_value(CASE WHEN d > 0 THEN strlen(pre[d].t) ELSE 0 END) AS b,
         sha256(coalesce(string_agg(CASE WHEN l = d THEN c::VARCHAR END, ',' ORDER BY c), '')) AS ends
  FROM q GROUP BY m, d),
u AS (
  SELECT DISTINCT q.m, q.d, w.m AS am, w.d AS ad FROM q JOIN q AS w ON w.c = q.c AND w.d <= q.d),
kids AS (SELECT am, ad, count(*) AS n FROM u WHERE ad = d - 1 GROUP BY am, ad),
subtree AS (
  SELECT u.am, u.ad, sum((k.n - 1) * k.b) AS saved, count(*) FILTER (kids.n IS NULL) AS leaves
  FROM u JOIN k ON k.m = u.m AND k.d = u.d LEFT JOIN kids ON kids.am = u.m AND kids.ad = u.d GROUP BY u.am, u.ad)
SELECT k.m AS conv_id, CAST(k.d AS BIGINT) AS depth, up.am AS parent_conv_id, CAST(k.n AS BIGINT) AS n_convs,
       CAST(coalesce(kids.n, 0) AS BIGINT) AS n_children, CAST(subtree.leaves AS BIGINT) AS n_leaves,
       CAST(subtree.saved AS BIGINT) AS saved_tokens, k.ends AS ends_sha256
FROM k JOIN subtree ON subtree.am = k.m AND subtree.ad = k.d
LEFT JOIN kids ON kids.am = k.m AND kids.ad = k.d
LEFT JOIN u AS up ON up.m = k.m AND up.d = k.d AND up.ad = k.d - 1
"""


QUERIES = {f.__name__: f for f in (op1_secret_scan, op2_substring_dedup, op3_mixing, op4_quality, op5_packing, op6_simhash, op7_warc, op8_pii,
                                  op9_decontamination, op10_main_text, op11_va_file, op12_nearest, op13_prefix_trie)}
ORACLES = {"op2_substring_dedup": OP2_SQL, "op7_warc": OP7_SQL, "op11_va_file": _op11_sql(), "op13_prefix_trie": OP13_SQL}
