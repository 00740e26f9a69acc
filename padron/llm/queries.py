"""One query per operator over the whole table of documents, and their DuckDB SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from padron.llm import clusters, exact, langid, licenses, lines, mixing, packing, pii, quality, secrets, simhash, spelling, suffix
from padron.llm.common import documents, text_of

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def register(query: Query) -> Query:
    QUERIES[query.__name__] = query
    return query


@register
def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(documents(spark, sf_dir).select("doc_id", "text"))
    return found.select(
        "doc_id",
        *[secrets.count_of(k).alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(secrets.written("base_spans").cast("binary"), 256).alias("base_sha256"),
        secrets.written("found_spans").alias("spans"),
    )


@register
def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.plan(documents(spark, sf_dir))
    return plan.select("doc_id", "size", "source_size", "target", "taken", "copies", "source")


@register
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.classes(documents(spark, sf_dir))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@register
def op4_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix.without_repeats(documents(spark, sf_dir))
    removed = F.aggregate("runs", F.lit(0).cast("long"), lambda n, r: n + r["stop"] - r["start"])
    return found.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("runs").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@register
def op5_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    left = lines.without_lines(docs, lines.repeated_lines(docs))
    return left.select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256")
    )


@register
def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(documents(spark, sf_dir).select("doc_id", "text"))
    return found.select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        "score",
    )


@register
def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judged(documents(spark, sf_dir))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@register
def op8_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Each call has an index of its own, empty before and loaded in two turns.
    found = exact.decisions(documents(spark, sf_dir), f"digests_{uuid.uuid4().hex}")
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


@register
def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held_out = F.coalesce(langid.crc_part() == 2, F.lit(False))
    model = langid.fit(docs.where(~held_out))
    found = langid.identify(docs.select("doc_id", "text"), model, ["doc_id"])
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "accepted")


@register
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.sequences(documents(spark, sf_dir), tokenizer_path(), with_ids=False)
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "bucket")


@register
def op11_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = clusters.clusters(spark.read.parquet(f"{sf_dir.rstrip('/')}/embeddings.parquet"))
    return found.select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", F.sha2(F.col("centroid").cast("binary"), 256).alias("centroid_sha256")
    )


@register
def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(documents(spark, sf_dir))


@register
def op13_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.scan(documents(spark, sf_dir))
    return found.select(
        "doc_id",
        *[pii.count_of(k).alias(f"n_{k}") for k in pii.BASE_KINDS],
        F.sha2(pii.written("base").cast("binary"), 256).alias("base_sha256"),
        pii.written("found").alias("spans"),
    )


# Words are runs of anything but the six ASCII spaces.
_WORDS = r"len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w != ''))"

ORACLE["op2_mixing"] = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, CAST({_WORDS} AS BIGINT) AS size,
    (CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 12) AS BIGINT) + 0.5::DOUBLE) / 281474976710656.0::DOUBLE AS u
  FROM documents),
s0 AS (SELECT source, sum(size)::DOUBLE AS source_size FROM d GROUP BY source),
s AS (SELECT *, [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][1 + (row_number() OVER (ORDER BY source IS NULL, source COLLATE "C") - 1) % 3] AS weight,
    2 * source_size AS cap, 1.5 * sum(source_size) OVER () AS total FROM s0),
rounds AS (
  SELECT 0 AS round, source, source_size, weight, cap, total, FALSE AS full_
  FROM s
  UNION ALL
  SELECT round + 1, source, source_size, weight, cap, total,
    full_ OR weight * (total - coalesce(sum(cap) FILTER (full_) OVER (), 0)) / (sum(weight) FILTER (NOT full_) OVER ()) > cap
  FROM rounds WHERE round < (SELECT count(*) FROM s)),
last AS (SELECT *, coalesce(sum(cap) FILTER (full_) OVER (), 0) AS used, sum(weight) FILTER (NOT full_) OVER () AS w
  FROM rounds WHERE round = (SELECT max(round) FROM rounds)),
goal AS (SELECT source, source_size, CASE WHEN full_ THEN cap ELSE weight * (total - used) / w END AS target FROM last),
r0 AS (SELECT d.*, g.source_size, g.target, CASE WHEN g.source_size > 0 THEN g.target / g.source_size ELSE 0 END AS ratio
  FROM d JOIN goal g ON d.source IS NOT DISTINCT FROM g.source),
r AS (SELECT *, floor(ratio) AS whole, target - floor(ratio) * source_size AS wanted,
    CASE WHEN ratio - floor(ratio) > 0 AND size > 0
      THEN (u / (1 - u)) / ((ratio - floor(ratio)) / (1 - (ratio - floor(ratio)))) END AS rank_ FROM r0),
c AS (SELECT *, rank_ IS NOT NULL AND sum(size) OVER (PARTITION BY source, rank_ IS NULL ORDER BY rank_, doc_id, size
      ROWS UNBOUNDED PRECEDING) <= wanted AS extra FROM r),
m AS (SELECT *, wanted - sum(CASE WHEN extra THEN size ELSE 0 END) OVER (PARTITION BY source) AS missing FROM c),
t AS (SELECT *, CASE WHEN rank_ IS NOT NULL AND NOT extra AND abs(size - missing) < missing
      THEN row_number() OVER (PARTITION BY source ORDER BY (CASE WHEN rank_ IS NOT NULL AND NOT extra AND abs(size - missing) < missing THEN 0 ELSE 1 END), abs(size - missing), rank_, doc_id, size) END AS pick FROM m)
SELECT doc_id, size, CAST(source_size AS BIGINT) AS source_size, target,
  CAST(whole + CASE WHEN extra OR pick = 1 THEN 1 ELSE 0 END AS BIGINT) * size AS taken,
  CAST(whole + CASE WHEN extra OR pick = 1 THEN 1 ELSE 0 END AS BIGINT) AS copies, source
FROM t
"""

ORACLE["op4_substrings"] = """
WITH h AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
w AS (SELECT doc_id, p, substr(x, 2 * p + 1, 100) AS s
  FROM (SELECT doc_id, x, unnest(range(0, greatest(length(x) // 2 - 49, 0))) AS p FROM h)),
f AS (SELECT s, min(doc_id) AS first_id FROM w GROUP BY s HAVING min(doc_id) < max(doc_id)),
c AS (SELECT w.doc_id, w.p FROM w JOIN f ON w.s = f.s AND w.doc_id > f.first_id),
b AS (SELECT *, CASE WHEN p <= max(p) OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 50
    THEN 0 ELSE 1 END AS begins FROM c),
r AS (SELECT doc_id, min(p) AS a, max(p) + 50 AS z
  FROM (SELECT *, sum(begins) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM b) GROUP BY doc_id, run),
k AS (SELECT doc_id, a, z, lag(z, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS before FROM r),
t AS (SELECT k.doc_id, sum(z - a) AS n_removed, count(*) AS n_spans, max(z) AS last_end,
    string_agg(substr(x, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS parts
  FROM k JOIN h USING (doc_id) GROUP BY k.doc_id)
SELECT h.doc_id, length(x) // 2 AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(CASE WHEN t.doc_id IS NULL THEN x ELSE parts || substr(x, 2 * last_end + 1) END)) AS kept_sha256
FROM h LEFT JOIN t ON h.doc_id = t.doc_id
"""

ORACLE["op5_lines"] = r"""
WITH l AS (
  SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS nr
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents)),
k AS (SELECT *, translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
bad AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (key IN (SELECT key FROM bad)) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY nr) FILTER (key NOT IN (SELECT key FROM bad)), '')) AS kept_sha256
FROM k GROUP BY doc_id
"""

ORACLE["op8_exact"] = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
  doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
"""


def _clusters_sql(size: int = 64, rounds: int = 10) -> str:
    """Every round as a step of its own; distances and means as whole numbers."""
    distance = "list_sum(list_transform(list_zip(v.x, c.x), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
    steps = [f"""
v AS MATERIALIZED (SELECT row_number() OVER () AS nr, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings WHERE len(embedding) = {size} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {size}),
c0 AS MATERIALIZED (SELECT CAST(row_number() OVER (ORDER BY h, x) - 1 AS INTEGER) AS k, x
  FROM (SELECT sha256('3:' || CAST(vec_id AS VARCHAR)) AS h, x FROM v ORDER BY h, x LIMIT 8))"""]
    for r in range(rounds + 1):
        steps.append(f"""
a{r} AS MATERIALIZED (SELECT nr, arg_min(k, (d, k)) AS k, min(d) AS d
  FROM (SELECT v.nr, c.k, CAST({distance} AS BIGINT) AS d FROM v CROSS JOIN c{r} AS c) GROUP BY nr)""")
        if r < rounds:
            steps.append(f"""
m{r} AS (SELECT k, i, sum(x[i]) AS total, count(*) AS n
  FROM (SELECT a.k, v.x FROM v JOIN a{r} AS a USING (nr)) CROSS JOIN range(1, {size + 1}) AS t(i) GROUP BY k, i),
c{r + 1} AS MATERIALIZED (SELECT c.k, coalesce(n.x, c.x) AS x FROM c{r} AS c
  LEFT JOIN (SELECT k, list(CAST((total - (total % n + n) % n) // n AS BIGINT) ORDER BY i) AS x FROM m{r} GROUP BY k) AS n ON n.k = c.k)""")
    return f"""WITH {",".join(steps)}
SELECT vec_id, a.k AS cluster, a.d AS distance, CAST(sum(a.d) OVER (PARTITION BY a.k) AS BIGINT) AS cluster_inertia,
  CAST(sum(a.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.x, ',')) AS centroid_sha256
FROM v JOIN a{rounds} AS a USING (nr) JOIN c{rounds} AS c ON c.k = a.k
"""


ORACLE["op11_clusters"] = _clusters_sql()

ORACLE["op12_spelling"] = r"""
WITH RECURSIVE tab AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
o AS (SELECT doc_id, w, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]+')) AS w FROM documents)
  GROUP BY doc_id, w),
b AS (SELECT *, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || w)) AS x FROM o),
h AS (SELECT w, n, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(length(x) // 2), lambda i: CAST('0x' || substr(x, 2 * i + 1, 2) AS BIGINT))),
    lambda c, y: xor(c >> 8, t[1 + (xor(c, y) & 255)]))) AS crc FROM b CROSS JOIN tab),
s AS (SELECT CASE WHEN crc % 97 = 0 THEN substr(w, 1, crc % length(w)) || substr(w, crc % length(w) + 2) ELSE w END AS word, n FROM h),
v AS MATERIALIZED (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM s WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
d AS MATERIALIZED (SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM v)),
near AS MATERIALIZED (
  SELECT a.word, b.word AS other FROM d AS a JOIN d AS b ON a.rest = b.rest AND a.i = b.i AND a.word != b.word
  UNION SELECT d.word, v.word FROM d JOIN v ON d.rest = v.word
  UNION SELECT v.word, d.word FROM d JOIN v ON d.rest = v.word),
f AS MATERIALIZED (
  SELECT v.word, v.n, count(o.word) AS n_near, max(o.n) AS top, arg_min(o.word, (-o.n, encode(o.word))) AS best
  FROM v LEFT JOIN near ON near.word = v.word LEFT JOIN v AS o ON o.word = near.other GROUP BY v.word, v.n),
g AS MATERIALIZED (SELECT word, n, n_near, CASE WHEN top >= 2 * n THEN best END AS form, CASE WHEN top >= 2 * n THEN top END AS form_n FROM f),
r AS (SELECT word, word AS root FROM g UNION ALL SELECT r.word, g.form FROM r JOIN g ON g.word = r.root WHERE g.form IS NOT NULL),
z AS (SELECT r.word, r.root FROM r JOIN g ON g.word = r.root WHERE g.form IS NULL)
SELECT g.word, form, z.root, n, n_near, form_n FROM g JOIN z ON z.word = g.word
"""
