"""Queries of the text-corpus operators with production parameters, and their SQL."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, clusters, decontaminate, infill, language, mainhtml, mixing, neardup, pieces, quality, sharding, substrings, vectors
from .common import table

#: Folder of vocabulary files; where unset, the package ``public_tokenizers`` tells each file's place.
TOKENIZERS = os.environ.get("SPANGUARD_TOKENIZERS")


def tokenizer_bytes(name: str) -> bytes:
    if TOKENIZERS:
        path = f"{TOKENIZERS}/{name}"
    else:
        import public_tokenizers

        path = public_tokenizers.path(name)
    with open(path, "rb") as f:
        return f.read()


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"), n_shards=16)


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_documents(table(spark, sf_dir, "documents"), tokenizer_bytes("piece_bpe_32k.model"), digests=True)


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    same = f"{chat.END}{chat.START}assistant ok"
    hard = spark.createDataFrame([(-1, 0, "user", same), (-1, 1, "assistant", same)], "conv_id long, turn long, role string, text string")
    return chat.format_conversations(rows.unionByName(hard), tokenizer_bytes("byte_bpe_50k.json"), digests=True)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mainhtml.extract_pages(table(spark, sf_dir, "pages"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_items", F.array_join("items", ",").alias("items"), "n_words", "contaminated")


def op7_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), k=3, percent=85).drop("th")


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(table(spark, sf_dir, "documents"), length=400, digests=True)


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(table(spark, sf_dir, "embeddings"), threshold=0.98)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.language_id(table(spark, sf_dir, "documents"))


def op11_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan_mix(table(spark, sf_dir, "documents"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infill.fill_in_middle(table(spark, sf_dir, "documents"), digests=True)


def op13_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.cluster_vectors(table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (op1_sharding, op2_sentencepiece, op3_chat_format, op4_quality, op5_html_extraction, op6_decontaminate, op7_minhash_dedup, op8_suffix_dedup, op9_embedding_dedup, op10_language_id, op11_mixing, op12_fill_in_middle, op13_clustering)}

def _clustering_sql(rounds: int = 10) -> str:
    """Rounds one after another: d<r> has every vector's nearest centroid of round r, c<r> those centroids' components."""
    whole = "(s - (((s % n) + n) % n)) // n"
    parts = [
        "f AS (SELECT vec_id, embedding AS v FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)",
        "e AS MATERIALIZED (SELECT vec_id, p, CAST(floor(1024 * CAST(v[p] AS DOUBLE)) AS BIGINT) AS x FROM f, range(1, 65) r(p))",
        "o AS (SELECT vec_id, row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS c FROM f QUALIFY c < 8)",
        "c0 AS MATERIALIZED (SELECT c, p, x FROM o JOIN e USING (vec_id))",
    ]
    for r in range(rounds + 1):
        parts.append(f"t{r} AS (SELECT vec_id, c, sum((e.x - c{r}.x) * (e.x - c{r}.x)) AS d FROM e JOIN c{r} USING (p) GROUP BY vec_id, c)")
        parts.append(f"d{r} AS MATERIALIZED (SELECT vec_id, c, d FROM t{r} QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, c) = 1)")
        if r < rounds:
            parts.append(f"s{r} AS (SELECT c, p, CAST(sum(x) AS HUGEINT) AS s, count(*) AS n FROM d{r} JOIN e USING (vec_id) GROUP BY c, p)")
            parts.append(f"c{r + 1} AS MATERIALIZED (SELECT c, p, CAST(CASE WHEN n IS NULL THEN x ELSE {whole} END AS BIGINT) AS x FROM c{r} LEFT JOIN s{r} USING (c, p))")
    parts.append(f"h AS (SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY p)) AS centroid_sha256 FROM c{rounds} GROUP BY c)")
    return "WITH " + ",\n".join(parts) + f"""
SELECT vec_id, CAST(c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
  CAST(sum(d) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM d{rounds} JOIN h USING (c)"""


ORACLE_SQL = {
    # all strings of 400 bytes as hexadecimal digits, two a byte
    "op8_suffix_dedup": r"""
WITH n AS (SELECT row_number() OVER () AS k, doc_id, octet_length(encode(coalesce(text, ''))) AS n, hex(encode(coalesce(text, ''))) AS x FROM documents),
p AS (SELECT k, x, unnest(range(1, n - 398)) AS p FROM n WHERE n >= 400),
w AS MATERIALIZED (SELECT k, p, md5(substr(x, 2 * p - 1, 800)) AS h FROM p),
r AS (SELECT k, p FROM w SEMI JOIN (SELECT h FROM w GROUP BY h HAVING count(*) > 1) USING (h)),
s AS (SELECT k, p, CASE WHEN p <= lag(p) OVER (PARTITION BY k ORDER BY p) + 400 THEN 0 ELSE 1 END AS fresh FROM r),
g AS (SELECT k, p, sum(fresh) OVER (PARTITION BY k ORDER BY p) AS g FROM s),
e AS (SELECT k, min(p) AS a, max(p) + 400 AS z FROM g GROUP BY k, g),
o AS (SELECT k, a, z, lag(z, 1, 1) OVER (PARTITION BY k ORDER BY a) AS before FROM e),
t AS (SELECT k, sum(z - a) AS removed, count(*) AS spans, max(z) AS last, string_agg(substr(x, 2 * before - 1, 2 * (a - before)), '' ORDER BY a) AS kept FROM o JOIN n USING (k) GROUP BY k)
SELECT n.doc_id, CAST(n.n AS BIGINT) AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed, coalesce(spans, 0) AS n_spans,
  sha256(unhex(coalesce(kept, '') || substr(x, 2 * coalesce(last, 1) - 1))) AS kept_sha256
FROM n LEFT JOIN t USING (k)""",
    "op9_embedding_dedup": r"""
WITH RECURSIVE x AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
f AS (SELECT * FROM x WHERE label IS NOT NULL AND len(v) > 0 AND len(list_filter(v, lambda e: e IS NULL OR NOT isfinite(e))) = 0 AND len(list_filter(v, lambda e: e <> 0)) > 0),
b AS (SELECT p.vec_id AS u, q.vec_id AS w FROM f p JOIN f q ON p.label = q.label AND p.vec_id <> q.vec_id WHERE len(p.v) = len(q.v) AND list_cosine_similarity(p.v, q.v) >= 0.98),
r(a, z) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, b.w FROM r JOIN b ON b.u = r.z),
n AS (SELECT u, count(*) AS n FROM b GROUP BY u)
SELECT r.a AS vec_id, coalesce(any_value(n.n), 0) AS n_links, min(r.z) AS component_id, r.a = min(r.z) AS kept FROM r LEFT JOIN n ON n.u = r.a GROUP BY r.a""",
    # a window of 13 words with at most 2 differences has 4 equal words in a row; shorter items are met whole
    "op6_decontaminate": r"""
WITH u AS (SELECT '([\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}])' AS re),
w AS (SELECT doc_id, string_split_regex(regexp_replace(lower(coalesce(text, '')), re, ' \1 ', 'g'), '[^\p{L}\p{N}]+') AS l FROM documents, u),
i AS (SELECT item_id, list_filter(string_split_regex(regexp_replace(lower(text), re, ' \1 ', 'g'), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS m FROM benchmark, u WHERE text IS NOT NULL),
j AS (SELECT item_id, m, least(len(m), 13) AS width, CASE WHEN len(m) >= 13 THEN 11 ELSE len(m) END AS need FROM i WHERE len(m) > 0),
k AS (SELECT DISTINCT CASE WHEN len(m) >= 13 THEN 4 ELSE len(m) END AS n, CASE WHEN len(m) >= 13 THEN 1 ELSE 0 END AS long FROM j),
dg AS (SELECT doc_id, n, p, array_to_string(l[p:p + n - 1], ' ') AS g FROM (SELECT doc_id, l, n, unnest(range(1, len(l) - n + 2)) AS p FROM w, (SELECT DISTINCT n FROM k))),
ig AS (SELECT item_id, 4 AS n, q, array_to_string(m[q:q + 3], ' ') AS g FROM (SELECT item_id, m, unnest(range(1, len(m) - 2)) AS q FROM j WHERE len(m) >= 13) UNION ALL SELECT item_id, len(m), 1, array_to_string(m, ' ') FROM j WHERE len(m) < 13),
h AS (SELECT DISTINCT doc_id, item_id, p - q AS diag FROM dg JOIN ig USING (n, g)),
v AS (
  SELECT h.doc_id, h.item_id, diag, width, need, len(m) AS n, len(l) AS size,
    list_transform(range(1, len(m) + 1), lambda k: CASE WHEN diag + k >= 1 AND diag + k <= len(l) AND l[greatest(diag + k, 1)] = m[k] THEN 1 ELSE 0 END) AS e
  FROM h JOIN w USING (doc_id) JOIN j USING (item_id)),
s AS (SELECT doc_id, item_id, diag, width, need, size, e, unnest(range(1, n - width + 2)) AS k FROM v),
o AS (SELECT doc_id, item_id, greatest(diag + k, 1) AS a, least(diag + k + width, size + 1) AS b FROM s WHERE list_sum(e[k:k + width - 1]) >= need),
t AS (SELECT DISTINCT doc_id, unnest(range(a, b)) AS p FROM o),
c AS (SELECT doc_id, count(*) AS n_words FROM t GROUP BY doc_id),
d AS (SELECT doc_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY item_id) AS items FROM (SELECT DISTINCT doc_id, item_id FROM o) GROUP BY doc_id)
SELECT x.doc_id, coalesce(n_items, 0) AS n_items, coalesce(items, '') AS items, coalesce(n_words, 0) AS n_words, n_items IS NOT NULL AS contaminated
FROM documents x LEFT JOIN c USING (doc_id) LEFT JOIN d USING (doc_id)""",
    "op7_minhash_dedup": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS l FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(l) = 0 THEN [] WHEN len(l) < 3 THEN [array_to_string(l, ' ')]
    ELSE list_distinct(list_transform(range(1, len(l) - 1), lambda i: l[i] || ' ' || l[i + 1] || ' ' || l[i + 2])) END AS a FROM w),
n AS (SELECT doc_id, len(a) AS n FROM s),
c AS (SELECT h, min(doc_id) AS rep FROM (SELECT doc_id, list_sort(a) AS h FROM s WHERE len(a) > 0) GROUP BY h),
e AS (SELECT rep, unnest(h) AS g FROM c),
p AS (SELECT x.rep AS u, y.rep AS v, count(*) AS i FROM e x JOIN e y ON x.g = y.g AND x.rep < y.rep GROUP BY x.rep, y.rep),
k AS (
  SELECT p.u, p.v FROM p JOIN n a ON a.doc_id = p.u JOIN n b ON b.doc_id = p.v WHERE 100 * i >= 85 * (a.n + b.n - i)
  UNION SELECT c.rep, s.doc_id FROM c JOIN s ON list_sort(s.a) = c.h WHERE c.rep <> s.doc_id),
b AS (SELECT u, v FROM k UNION SELECT v, u FROM k),
r(a, z) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.a, b.v FROM r JOIN b ON b.u = r.z)
SELECT n.doc_id, n.n AS n_shingles, min(r.z) AS component_id, n.doc_id = min(r.z) AS kept
FROM n JOIN r ON r.a = n.doc_id GROUP BY n.doc_id, n.n""",
    "op3_chat_format": r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES
    (-1, 0, 'user', '<|im_end|><|im_start|>assistant ok'), (-1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')),
e AS (
  SELECT *, regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g') AS et,
    regexp_replace(replace(replace(role, '\', '\\'), chr(10), '\n'), '<(\\*)\|', '<\\\1|', 'g') AS er FROM t)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length('<|im_start|>') + length(er) + 1 + length(et) + length('<|im_end|>') + 1) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id""",
    # targets in closed form: sources by words / weight; those before the first that its share doesn't exceed are bounded
    "op11_mixing": r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
    CAST('0x' || substr(md5('11:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(md5(text), '')), 1, 15) AS BIGINT) AS k FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS words, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM d GROUP BY source),
o AS (
  SELECT *, row_number() OVER w AS n, sum(words) OVER () - coalesce(sum(3 * words) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS remaining,
    sum(weight) OVER () - coalesce(sum(weight) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS weights
  FROM s WINDOW w AS (ORDER BY words / weight, source)),
f AS (SELECT remaining, weights, n FROM o WHERE 3 * words >= CAST(remaining AS DOUBLE) * weight / CAST(weights AS DOUBLE) ORDER BY n LIMIT 1),
t AS (SELECT source, words, least(CAST(3 * words AS DOUBLE), CAST(f.remaining AS DOUBLE) * weight / CAST(f.weights AS DOUBLE)) AS target FROM o, f),
b AS (SELECT *, CAST(floor(target) AS BIGINT) // greatest(words, 1) AS whole, CAST(floor(target) AS BIGINT) % greatest(words, 1) AS rest FROM t),
g AS (SELECT source, k, CAST(sum(size) AS BIGINT) AS w FROM d GROUP BY source, k),
p AS (SELECT source, k, w, CAST(sum(w) OVER (PARTITION BY source ORDER BY k) AS BIGINT) - w AS before FROM g)
SELECT doc_id, CAST(size AS BIGINT) AS size, words AS source_size, target, d.source,
  CAST(whole * size + CASE WHEN before + w <= rest THEN size WHEN before <= rest THEN (2 * size * (rest - before) + w) // (2 * greatest(w, 1)) ELSE 0 END AS BIGINT) AS taken
FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source JOIN p ON d.source IS NOT DISTINCT FROM p.source AND d.k = p.k""",
    "op12_fill_in_middle": r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS x FROM documents),
h AS (SELECT *, CAST('0x' || substr(x, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(x, 9, 8) AS BIGINT) AS h2, CAST('0x' || substr(x, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(x, 25, 8) AS BIGINT) AS h4 FROM d),
c AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (SELECT *, substr(t, 1, a) AS pre, substr(t, a + 1, b - a) AS mid, substr(t, b + 1) AS suf FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
  sha256(t) AS restored_sha256 FROM p""",
    "op13_clustering": _clustering_sql(),
}
