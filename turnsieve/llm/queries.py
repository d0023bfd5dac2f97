"""Registered queries of the training-data operators; each applies its operator to a whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    centroids,
    decontaminate,
    embeddings,
    licenses,
    linededup,
    packing,
    quality,
    sharding,
    simhash,
    spelling,
    toxicity,
    urlrules,
    warc,
)
from .common import LOWER, UPPER, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _registered(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@_registered
def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints and near-duplicate components of all documents."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"), simhash.hex_of().alias("fingerprint"), F.col("component").alias("component_id")
    )


@_registered
def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 1024 tokens."""
    return packing.digest(packing.pack(table(spark, sf_dir, "documents")))


@_registered
def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents that lie in a passage of ten words of a benchmark item."""
    found = decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("id").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


_SPLIT = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_WORDS = f"[x FOR x IN string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{_SPLIT}') IF x <> '']"

ORACLES["op10_decontaminate"] = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
  i AS (SELECT item_id, {_WORDS} AS ws FROM benchmark WHERE item_id IS NOT NULL),
  w AS (SELECT DISTINCT item_id, least(10, len(ws)) AS n, ws[p : p + least(10, len(ws)) - 1] AS win
        FROM i, unnest(range(1, greatest(2, len(ws) - 8))) AS u(p) WHERE len(ws) > 0),
  lengths AS (SELECT DISTINCT n FROM w),
  hit AS (SELECT doc_id, item_id, p, w.n
          FROM (SELECT doc_id, n, p, ws[p : p + n - 1] AS win
                FROM d, lengths, unnest(range(1, len(ws) - n + 2)) AS u(p)) AS c
          JOIN w ON w.n = c.n AND w.win = c.win),
  words AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM hit, unnest(range(p, p + n)) AS u(q) GROUP BY doc_id),
  items AS (SELECT doc_id, count(*) AS n_items, string_agg(k, ',' ORDER BY k) AS ids
            FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS k FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""


@_registered
def op7_linededup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of all documents without the later copies of repeated runs of 50 words or more."""
    found = linededup.deduplicate_lines(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        F.col("_lines").alias("n_lines"),
        F.col("_gone").alias("n_deleted"),
        F.col("_words_gone").alias("n_words_deleted"),
        F.md5("text").alias("text_md5"),
    )


# A line goes when it lies in a run of 50 words or more that occurs earlier, too. The shortest such runs that
# start or end at each line are enough: they are compared as whole lists of lines.
ORACLES["op7_linededup"] = """
WITH docs AS (SELECT row_number() OVER (ORDER BY doc_id) AS d, doc_id, text FROM documents),
  lines AS (SELECT d, p, ls[p] AS line,
              len([x FOR x IN string_split_regex(ls[p], '[\\x20\\x09-\\x0D]+') IF x <> '']) AS words
            FROM (SELECT d, string_split(text, chr(10)) AS ls FROM docs WHERE text IS NOT NULL),
              unnest(range(1, len(ls) + 1)) AS u(p)),
  often AS (SELECT line FROM lines GROUP BY line HAVING count(*) > 1),
  reps AS (SELECT *, p - row_number() OVER (PARTITION BY d ORDER BY p) AS g FROM lines SEMI JOIN often USING (line)),
  sums AS (SELECT *, sum(words) OVER (PARTITION BY d, g ORDER BY p) AS after FROM reps),
  ends AS (SELECT a.d, a.p AS f, min(b.p) AS t FROM sums a JOIN sums b
             ON a.d = b.d AND a.g = b.g AND b.p >= a.p AND b.after - a.after + a.words >= 50 GROUP BY ALL
           UNION
           SELECT b.d, max(a.p) AS f, b.p AS t FROM sums a JOIN sums b
             ON a.d = b.d AND a.g = b.g AND b.p >= a.p AND b.after - a.after + a.words >= 50 GROUP BY ALL),
  runs AS (SELECT e.d, f, t, list(line ORDER BY p) AS content
           FROM ends e JOIN lines l ON e.d = l.d AND l.p BETWEEN f AND t GROUP BY ALL),
  again AS (SELECT d, f, t, row_number() OVER (PARTITION BY content ORDER BY d, f) AS nth FROM runs),
  gone AS (SELECT DISTINCT d, p FROM again, unnest(range(f, t + 1)) AS u(p) WHERE nth > 1)
SELECT docs.doc_id, CAST(count(p) AS BIGINT) AS n_lines, CAST(count(gone.d) AS BIGINT) AS n_deleted,
  CAST(coalesce(sum(words) FILTER (gone.d IS NOT NULL), 0) AS BIGINT) AS n_words_deleted,
  CASE WHEN any_value(text) IS NOT NULL
    THEN md5(coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (gone.d IS NULL), '')) END AS text_md5
FROM docs LEFT JOIN lines USING (d) LEFT JOIN gone USING (d, p) GROUP BY docs.d, docs.doc_id
"""


def _fold(n: int, doc_id: str = "doc_id") -> Column:
    """The remainder that decides which labels may be learnt from; null ids have none."""
    return F.crc32(F.col(doc_id).cast("string")) % n


@_registered
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents, learnt from four fifths of the labels."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels.where(_fold(5) != 0))
    scored = toxicity.score(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id",
        F.coalesce(_fold(5) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@_registered
def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices in all documents, exact and with edits."""
    return licenses.summary(licenses.scan(table(spark, sf_dir, "documents")))


@_registered
def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards of near-equal bytes."""
    found = sharding.shards(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"),
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@_registered
def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages through ARC and WARC files and back."""
    found = warc.round_trip(table(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLES["op6_warc"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
  d AS (SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, sha256(html) AS payload_digest FROM p),
  f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM d)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to
FROM f
"""


@_registered
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents, learnt from three quarters of the labels."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.fit(docs, labels.where(_fold(4) != 2))
    scored = quality.score(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id",
        F.coalesce(_fold(4) == 2, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


@_registered
def op5_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicates of all vectors, within their labels."""
    found = embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))
    return found.select(
        F.col("id").alias("vec_id"),
        "n_links",
        F.col("component").alias("component_id"),
        (F.col("id") == F.col("component")).alias("kept"),
    )


ORACLES["op5_embeddings"] = """
WITH RECURSIVE v AS (
    SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
    WHERE label IS NOT NULL AND vec_id IS NOT NULL AND len(embedding) > 0
      AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = len(embedding)
      AND len([x FOR x IN embedding IF x <> 0]) > 0),
  links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND len(a.e) = len(b.e)
              AND a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
  reached AS (SELECT vec_id, vec_id AS root FROM embeddings
              UNION SELECT l.b, r.root FROM reached r JOIN links l ON l.a = r.vec_id),
  roots AS (SELECT vec_id, min(root) AS component_id FROM reached GROUP BY vec_id),
  counts AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(n, 0) AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings e JOIN roots USING (vec_id) LEFT JOIN counts USING (vec_id)
"""


@_registered
def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forty clusters of all vectors after five rounds."""
    found = centroids.cluster(table(spark, sf_dir, "embeddings"))
    return found.withColumnRenamed("id", "vec_id")


def _rounds_sql(rounds: int) -> str:
    """The assignment and the update of each round, one after the other."""
    parts = []
    for i in range(rounds + 1):
        parts.append(
            f"""a{i} AS (SELECT v, x, vec_id, min(struct_pack(d, c)) AS b FROM (
                  SELECT v, x, vec_id, c, list_sum([(p[1] - p[2]) * (p[1] - p[2]) FOR p IN list_zip(x, m)])::BIGINT AS d
                  FROM kept, c{i}) GROUP BY ALL)"""
        )
        if i < rounds:
            parts.append(
                f"""s{i} AS (SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY j) AS m FROM (
                      SELECT b.c AS c, j, sum(x[j]) AS s, count(*) AS n FROM a{i}, range(1, 65) r(j) GROUP BY ALL) GROUP BY c),
                  c{i + 1} AS (SELECT c, coalesce(s{i}.m, c{i}.m) AS m FROM c{i} LEFT JOIN s{i} USING (c))"""
            )
    return ",\n  ".join(parts)


# the floor of a mean is taken by whole numbers: // rounds towards zero
ORACLES["op11_centroids"] = f"""
WITH kept AS (
    SELECT row_number() OVER () AS v, vec_id, [CAST(floor(256 * CAST(y AS DOUBLE)) AS BIGINT) FOR y IN embedding] AS x
    FROM embeddings WHERE len(embedding) = 64 AND len([y FOR y IN embedding IF y IS NOT NULL AND isfinite(y)]) = 64),
  c0 AS (SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id), x) - 1 AS c, x AS m
         FROM kept WHERE vec_id IS NOT NULL QUALIFY c < 40),
  {_rounds_sql(centroids.ROUNDS)}
SELECT vec_id, CAST(b.c AS INTEGER) AS cluster, b.d AS distance,
  CAST(sum(b.d) OVER (PARTITION BY b.c) AS BIGINT) AS cluster_inertia, CAST(sum(b.d) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(m, ',')) AS centroid_sha256
FROM a{centroids.ROUNDS} AS a JOIN c{centroids.ROUNDS} AS f ON f.c = a.b.c
"""


@_registered
def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents with their more frequent neighbours."""
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


ORACLES["op12_spelling"] = f"""
WITH RECURSIVE bits(i, k, c) AS (
    SELECT i, 0, CAST(i AS BIGINT) FROM range(256) AS r(i)
    UNION ALL SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM bits WHERE k < 8),
  crc AS (SELECT list(c ORDER BY i) AS t FROM bits WHERE k = 8),
  runs AS (SELECT doc_id, run, count(*) AS n
           FROM (SELECT doc_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[A-Za-zÀ-ÿ]+')) AS run
                 FROM documents) WHERE length(run) >= 6 GROUP BY ALL),
  marked AS (SELECT run, n, xor(list_reduce([4294967295] || [CAST('0x' || x AS BIGINT) FOR x IN
               regexp_extract_all(hex(encode(doc_id || ':' || run)), '..')],
               lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS h FROM runs, crc),
  slipped AS (SELECT CASE WHEN h % 199 = 0
                THEN substring(run, 1, CAST(h % length(run) AS BIGINT)) || substring(run, CAST(h % length(run) AS BIGINT) + 2)
                ELSE run END AS word, n FROM marked),
  words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM slipped WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
  cuts AS (SELECT word, n, i, substring(word, 1, i - 1) || substring(word, i + 1) AS part
           FROM words, unnest(range(1, length(word) + 1)) AS u(i)),
  pairs AS (SELECT a.word, b.word AS near, b.n AS m FROM cuts a JOIN cuts b ON a.i = b.i AND a.part = b.part AND a.word <> b.word
            UNION SELECT c.word, w.word, w.n FROM cuts c JOIN words w ON c.part = w.word
            UNION SELECT w.word, c.word, c.n FROM cuts c JOIN words w ON c.part = w.word),
  best AS (SELECT word, count(*) AS n_near, min(struct_pack(less := -m, near)) AS b FROM pairs GROUP BY word),
  forms AS (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN -b.less >= 5 * n THEN b.near END AS form,
              CASE WHEN -b.less >= 5 * n THEN -b.less END AS form_n FROM words LEFT JOIN best USING (word)),
  steps(word, reached) AS (SELECT word, word FROM forms
                           UNION ALL SELECT steps.word, form FROM steps JOIN forms ON forms.word = reached WHERE form IS NOT NULL)
SELECT f.word, f.form, s.reached AS root, f.n, f.n_near, f.form_n
FROM forms f JOIN steps s USING (word) JOIN forms l ON l.word = s.reached AND l.form IS NULL
"""


@_registered
def op13_urlrules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on all URLs: given rules, then rules mined from what these label."""
    found = urlrules.judge(table(spark, sf_dir, "pages").select("page_id", "url"))
    return found.select("page_id", "host", "path", "rule", "verdict", "pattern", "confidence")


def _url_tokens(text: str, mark: str) -> str:
    spaced = f"string_split_regex(regexp_replace(translate({text}, '{UPPER}', '{LOWER}'), '[0-9]+', '0', 'g'), '{_SPLIT}')"
    return f"[{mark!r} || x FOR x IN {spaced} IF x <> '']"


def _given_sql(value: int | None) -> str:
    """A CASE over the given rules, the longest first: their names, or with ``value`` that part of them."""
    ordered = sorted(urlrules.RULES, key=lambda r: -len(r[1] + r[2]))
    return "CASE " + " ".join(
        f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{v if value == 0 else h + p}'"
        for v, h, p in ordered
    ) + " END"


# every combination of a labelled URL's frequent tokens is counted, without the miner's order or pruning
ORACLES["op13_urlrules"] = f"""
WITH p AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substring(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
  q AS (SELECT *, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
          regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, regexp_extract(rest, '(?s)^[^?#]*(.*)$', 1) AS further FROM p),
  u AS (SELECT row_number() OVER () AS r, page_id, host, path, {_given_sql(None)} AS rule, {_given_sql(0)} AS label,
          list_sort(list_distinct({_url_tokens("host", "h:")} || {_url_tokens("path", "p:")} || {_url_tokens("further", "q:")})) AS tokens
        FROM q),
  l AS (SELECT r, label, tokens FROM u WHERE label IS NOT NULL),
  least AS (SELECT ceil(CAST({urlrules.MIN_SUPPORT} AS DOUBLE) * count(*)) AS least FROM l),
  seen AS (SELECT token, list(r ORDER BY r) AS rs FROM l, unnest(tokens) AS t(token) GROUP BY token),
  items AS (SELECT min(token) AS token FROM seen, least WHERE len(rs) >= least GROUP BY rs),
  cut AS (SELECT r, label, list(token ORDER BY token) AS ts FROM l, unnest(tokens) AS t(token) JOIN items USING (token) GROUP BY ALL),
  kinds AS (SELECT label, ts, count(*) AS n FROM cut GROUP BY ALL),
  sets AS (SELECT label, [ts[i] FOR i IN range(1, len(ts) + 1) IF (m >> (i - 1)) & 1 = 1] AS s, sum(n) AS n
           FROM kinds, unnest(range(1, CAST(1 << len(ts) AS BIGINT))) AS c(m) GROUP BY ALL),
  rules AS (SELECT s, label, n, n / sum(n) OVER (PARTITION BY s) AS confidence FROM sets),
  kept AS (SELECT s, label, n, confidence FROM rules, least WHERE n >= least AND confidence >= {urlrules.MIN_CONFIDENCE}),
  hits AS (SELECT r, s, kept.label, confidence, row_number() OVER (PARTITION BY r
             ORDER BY confidence DESC, n DESC, len(s), kept.label DESC, s) AS nth
           FROM u JOIN kept ON list_has_all(u.tokens, kept.s) WHERE u.label IS NULL),
  first AS (SELECT r, label AS found, array_to_string(s, ' ') AS pattern, confidence FROM hits WHERE nth = 1)
SELECT page_id, host, path, rule, coalesce(label, found, 'allow') AS verdict, pattern, confidence FROM u LEFT JOIN first USING (r)
"""
