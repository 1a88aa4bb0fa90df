"""The operators applied to the test tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from namewright.llm import jaccard_join, langid, maxscore, multi_index, packing, pii, secrets, sentencepiece_scan, token_counts, warc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack_documents(table(spark, sf_dir, "documents"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "padded_to")


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = sentencepiece_scan.decode_ids(sentencepiece_scan.encode_documents(table(spark, sf_dir, "documents")))
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_ids"),
        F.crc32("ids").alias("ids_crc32"),
        "score",
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"))


def op4_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return maxscore.search(vectors, vectors.where("vec_id % 20 = 0"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _digest(pii.find_personal_data(table(spark, sf_dir, "documents")), pii.BASE)


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_groups(table(spark, sf_dir, "documents"))


def _digest(spans: DataFrame, base: tuple[str, ...], everything: str = "spans") -> DataFrame:
    """Counts by base kind, the digest of the base spans and the text of all spans."""

    def text(array: F.Column) -> F.Column:
        return F.array_join(F.transform(array, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def number(kind: str) -> F.Column:
        return F.size(F.filter(everything, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    own = F.filter(everything, lambda s: s["kind"].isin(*base))
    counts = [number(kind) for kind in base]
    return spans.select("doc_id", *counts, F.sha2(text(own), 256).alias("base_sha256"), text(F.col(everything)).alias("spans"))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _digest(secrets.find_secrets(table(spark, sf_dir, "documents")), secrets.BASE)


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = warc.archive_roundtrip(table(spark, sf_dir, "pages"))
    return read.select(F.col("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs.where(~langid.held_out()))
    found = langid.identify(docs.withColumn("held_out", langid.held_out()), model, keep_columns=("held_out",))
    return found.select("doc_id", "held_out", "lang_pred", "score")


def op10_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multi_index.near_vectors(table(spark, sf_dir, "embeddings"))


def pii_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts of op5, which SQL can check."""
    return op5_pii(spark, sf_dir).select("doc_id", *(f"n_{k}" for k in pii.BASE))


def secrets_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts of op7, which SQL can check."""
    return op7_secrets(spark, sf_dir).select("doc_id", *(f"n_{k}" for k in secrets.BASE))


PII_SQL = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
f AS (SELECT doc_id, regexp_extract_all(t, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+') AS mails,
    list_transform(regexp_extract_all(t, '[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)'), lambda m: string_split(m, '.')) AS ips,
    list_transform(regexp_extract_all(t, '[0-9](?:[\x20-]?[0-9])+'), lambda m: regexp_replace(m, '[^0-9]', '', 'g')) AS cards,
    list_transform(regexp_extract_all(t, '\+[0-9][\x20().0-9-]+[0-9]'), lambda m: length(regexp_replace(m, '[^0-9]', '', 'g'))) AS phones FROM t)
SELECT doc_id, CAST(len(mails) AS BIGINT) AS n_email,
  CAST(len(list_filter(ips, lambda ps: len(list_filter(ps, lambda p: length(ltrim(p, '0')) > 3 OR coalesce(try_cast(p AS INT), 0) > 255)) = 0)) AS BIGINT) AS n_ip,
  CAST(len(list_filter(cards, lambda d: length(d) BETWEEN 12 AND 19 AND list_sum(list_transform(range(1, length(d) + 1),
    lambda i: CAST(substr(d, length(d) + 1 - i, 1) AS INT) * (2 - i % 2) - 9 * CAST(CAST(substr(d, length(d) + 1 - i, 1) AS INT) * (2 - i % 2) > 9 AS INT))) % 10 = 0)) AS BIGINT) AS n_card,
  CAST(len(list_filter(phones, lambda n: n BETWEEN 9 AND 15)) AS BIGINT) AS n_phone
FROM f
"""

SECRETS_SQL = r"""
SELECT doc_id,
  CAST(len(list_filter(regexp_extract_all(coalesce(text, ''), '(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 1),
    lambda v: length(v) >= 12)) AS BIGINT) AS n_assign,
  CAST(len(list_filter(regexp_extract_all(coalesce(text, ''), 'AKIA[A-Z0-9]+'), lambda v: length(v) >= 18)) AS BIGINT) AS n_access,
  CAST(len(list_filter(regexp_extract_all(coalesce(text, ''), '[0-9a-f]+'), lambda v: length(v) >= 16)) AS BIGINT) AS n_hex
FROM documents
"""

OP4_SQL = """
WITH q AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS query_id, b.vec_id AS vec_id, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM q a JOIN q b ON a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 20
"""

OP8_SQL = """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
d AS (
  SELECT page_id, CAST(octet_length(payload) AS BIGINT) AS payload_bytes, sha1(payload) AS payload_digest FROM p),
w AS (
  SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS kept FROM d)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN kept = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN kept = page_id THEN NULL ELSE kept END AS refers_to
FROM w
"""

OP6_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
    lambda t: t <> '') AS w FROM documents),
s AS MATERIALIZED (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM w),
e AS MATERIALIZED (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
p AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM e a JOIN e b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
r AS (SELECT doc_id, doc_id AS c FROM s UNION SELECT r.doc_id, p.y FROM r JOIN p ON p.x = r.c)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, m.c AS component_id
FROM s JOIN (SELECT doc_id, min(c) AS c FROM r GROUP BY doc_id) m USING (doc_id)
"""

OP10_SQL = """
WITH RECURSIVE v AS MATERIALIZED (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e,
    coalesce(len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0, false) AS ok FROM embeddings),
p AS MATERIALIZED (
  SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.ok AND b.ok AND a.vec_id <> b.vec_id
  WHERE list_dot_product(a.e, b.e) / (sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))) >= 0.9),
r AS (SELECT vec_id, vec_id AS c FROM v UNION SELECT r.vec_id, p.y FROM r JOIN p ON p.x = r.c),
n AS (SELECT x AS vec_id, count(*) AS n FROM p GROUP BY x)
SELECT vec_id, coalesce(n, 0) AS n_links, m.c AS component_id, vec_id = m.c AS kept
FROM (SELECT vec_id, min(c) AS c FROM r GROUP BY vec_id) m LEFT JOIN n USING (vec_id)
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_sentencepiece": op2_sentencepiece,
    "op3_token_counts": op3_token_counts,
    "op4_maxscore": op4_maxscore,
    "op5_pii": op5_pii,
    "op6_jaccard_join": op6_jaccard_join,
    "op7_secrets": op7_secrets,
    "op8_warc": op8_warc,
    "op9_language_id": op9_language_id,
    "op10_multi_index": op10_multi_index,
    "pii_counts": pii_counts,
    "secrets_counts": secrets_counts,
}

ORACLE_SQL: dict[str, str] = {"op4_maxscore": OP4_SQL, "op6_jaccard_join": OP6_SQL, "op8_warc": OP8_SQL, "op10_multi_index": OP10_SQL, "pii_counts": PII_SQL, "secrets_counts": SECRETS_SQL}
