"""The registered queries of this folder: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheaf.llm import (
    ann,
    bpe,
    centroids,
    jaccard,
    langid,
    lines,
    mips,
    packing,
    quality,
    sampling,
    secrets,
    substring,
    variants,
    warc,
)
from sheaf.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.scan(table(spark, sf_dir, "documents", "doc_id", "text")))


@query
def op4_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    held_out = sampling.remainder(F.col("doc_id"), 3) == 1
    model = langid.fit(docs, ~held_out)
    return langid.predict(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score", "ambiguous"
    )


@query
def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    labels = table(spark, sf_dir, "labels", "doc_id", "quality").withColumnRenamed("quality", "label")
    held_out = sampling.remainder(F.col("doc_id"), 4) == 2
    model = quality.fit(docs, labels, ~held_out)
    return quality.score(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return packing.pack(packing.items(docs, tokenizer_path("word_bpe_49k.json")))


@query
def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return bpe.digests(bpe.round_trip(docs, tokenizer_path("byte_bpe_50k.json")))


@query
def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.round_trip(table(spark, sf_dir, "pages", "page_id", "url", "html"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


# sha256 of the whole payload; of equal payloads of 100 bytes on, the smallest page responds
ORACLE_SQL["op5_warc"] = """
WITH p AS (
    SELECT page_id, url, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
    FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first_id FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT p.page_id, CAST(p.payload_bytes AS BIGINT) AS payload_bytes, p.payload_digest,
       CASE WHEN f.first_id < p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN f.first_id < p.page_id THEN f.first_id END AS refers_to
FROM p LEFT JOIN f ON p.payload_digest = f.payload_digest
"""


@query
def op1_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = ann.vectors(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))
    return ann.search(points, F.col("vec_id") % 100 == 0)


@query
def op3_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = mips.scaled(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))
    return mips.search(points, F.col("vec_id") % 100 == 0)


# doubles hold these sums of whole numbers exactly
ORACLE_SQL["op3_topk"] = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS p
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.p, c.p) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= 10
"""


@query
def op2_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    shortened = substring.dedup(table(spark, sf_dir, "documents", "doc_id", "text"))
    return shortened.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


@query
def op9_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents", "doc_id", "text"))


@query
def op9_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.link_counts(table(spark, sf_dir, "documents", "doc_id", "text"))


@query
def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = centroids.scaled(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))
    clustered, last, _ = centroids.cluster(points, 16, 3)
    return centroids.described(clustered, last)


def _lloyd_sql(k: int = 16, rounds: int = 3, width: int = 64) -> str:
    """Assignments and exact floored means, one common table after another. The remainder
    takes the sign of the sum, so it is made positive before it is taken off."""
    text = f"""
WITH v AS MATERIALIZED (
    SELECT vec_id, p, row_number() OVER (ORDER BY h, p) - 1 AS row_id
    FROM (
        SELECT vec_id, sha256('1:' || vec_id) AS h,
               list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS p
        FROM embeddings
        WHERE len(embedding) = {width} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)),
c0 AS MATERIALIZED (SELECT CAST(row_id AS INTEGER) AS cluster, p AS c FROM v WHERE row_id < {k}),
"""
    for t in range(rounds + 1):
        text += f"""
d{t} AS MATERIALIZED (
    SELECT row_id, cluster,
           CAST(list_sum(list_transform(list_zip(p, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS distance
    FROM v CROSS JOIN c{t}),
a{t} AS MATERIALIZED (
    SELECT row_id, arg_min(cluster, distance * {k} + cluster) AS cluster, min(distance) AS distance FROM d{t} GROUP BY row_id),
"""
        if t < rounds:
            text += f"""
s{t} AS MATERIALIZED (
    SELECT cluster, i, CAST((s - ((s % n) + n) % n) // n AS BIGINT) AS m
    FROM (SELECT cluster, i, sum(p[i]) AS s, count(*) AS n
          FROM a{t} JOIN v USING (row_id) CROSS JOIN range(1, {width} + 1) r(i) GROUP BY cluster, i)),
c{t + 1} AS MATERIALIZED (
    SELECT c{t}.cluster, coalesce(list(m ORDER BY i) FILTER (m IS NOT NULL), any_value(c)) AS c
    FROM c{t} LEFT JOIN s{t} USING (cluster) GROUP BY c{t}.cluster),
"""
    return text + f"""
w AS (SELECT cluster, CAST(sum(distance) AS BIGINT) AS cluster_inertia FROM a{rounds} GROUP BY cluster)
SELECT vec_id, cluster, distance, cluster_inertia,
       CAST((SELECT sum(cluster_inertia) FROM w) AS BIGINT) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{rounds} JOIN v USING (row_id) JOIN w USING (cluster) JOIN c{rounds} USING (cluster)
"""


ORACLE_SQL["op11_centroids"] = _lloyd_sql()


@query
def op12_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.variants(variants.counted_words(table(spark, sf_dir, "documents", "doc_id", "text")))


# crc32 by its bit rule: a table of the 256 bytes, then one step a byte. Two words are near if
# one is the other less a letter, or both less the letter at one place are equal.
ORACLE_SQL["op12_variants"] = r"""
WITH RECURSIVE bits AS (
    SELECT b, 0 AS step, CAST(b AS BIGINT) AS c FROM range(256) t(b)
    UNION ALL
    SELECT b, step + 1, CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END FROM bits WHERE step < 8),
crc AS MATERIALIZED (SELECT list(c ORDER BY b) AS crc FROM bits WHERE step = 8),
run AS MATERIALIZED (
    SELECT doc_id, translate(r, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS r, count(*) AS n
    FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{00C0}-\x{00FF}]+')) AS r FROM documents)
    WHERE length(r) >= 5 GROUP BY 1, 2),
hashed AS MATERIALIZED (
    SELECT r, n, xor(4294967295, list_reduce(
        list_transform(range(1, octet_length(encode(x)) + 1),
                       lambda i: CAST('0x' || substr(hex(encode(x)), 2 * i - 1, 2) AS BIGINT)),
        lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1]), 4294967295)) AS h
    FROM (SELECT r, n, coalesce(CAST(doc_id AS VARCHAR), '') || ':' || r AS x FROM run) CROSS JOIN crc),
word AS MATERIALIZED (
    SELECT w AS word, CAST(sum(n) AS BIGINT) AS n
    FROM (SELECT n, CASE WHEN h % 97 = 0 THEN r[:h % length(r)] || r[h % length(r) + 2:] ELSE r END AS w FROM hashed)
    WHERE length(w) >= 5 GROUP BY w HAVING sum(n) >= 3),
less AS MATERIALIZED (SELECT word, n, i, word[:i - 1] || word[i + 1:] AS d FROM word, range(1, length(word) + 1) r(i)),
near AS MATERIALIZED (
    SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM less a JOIN less b ON a.d = b.d AND a.i = b.i AND a.word <> b.word
    UNION SELECT a.word, a.n, b.word, b.n FROM less a JOIN word b ON a.d = b.word
    UNION SELECT b.word, b.n, a.word, a.n FROM less a JOIN word b ON a.d = b.word),
best AS MATERIALIZED (
    SELECT word, n, count(*) AS n_near, max(other_n) AS most, arg_min(other, (-other_n, encode(other))) AS other FROM near GROUP BY word, n),
form AS MATERIALIZED (SELECT word, other AS form, most AS form_n FROM best WHERE most >= 2 * n),
chain AS (
    SELECT word, form AS so_far, 1 AS step FROM form
    UNION ALL
    SELECT chain.word, form.form, step + 1 FROM chain JOIN form ON form.word = chain.so_far),
root AS (SELECT word, arg_max(so_far, step) AS root FROM chain GROUP BY word)
SELECT word.word, form, coalesce(root, word.word) AS root, word.n, coalesce(n_near, 0) AS n_near, form_n
FROM word LEFT JOIN best USING (word) LEFT JOIN form USING (word) LEFT JOIN root USING (word)
"""


@query
def op13_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    shortened = lines.dedup(table(spark, sf_dir, "documents", "doc_id", "text"))
    return shortened.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


ORACLE_SQL["op13_lines"] = r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
k AS MATERIALIZED (
    SELECT doc_id, l, list_transform(l, lambda x: translate(
        trim(x, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS keys
    FROM d),
e AS (SELECT doc_id, unnest(list_distinct(keys)) AS key FROM k),
g AS MATERIALIZED (
    SELECT key, max(doc_id) AS keeper FROM e WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
gone AS MATERIALIZED (
    SELECT doc_id, list(key) AS lost FROM (SELECT DISTINCT doc_id, key FROM e) JOIN g USING (key) WHERE doc_id < keeper GROUP BY doc_id),
f AS (
    SELECT doc_id, l, list_filter(l, lambda x, i: lost IS NULL OR NOT list_contains(lost, keys[i])) AS kept
    FROM k LEFT JOIN gone USING (doc_id))
SELECT doc_id, len(l) AS n_lines, len(l) - len(kept) AS n_dropped, sha256(array_to_string(kept, chr(10))) AS kept_sha256 FROM f
"""
