"""One query per operator over the given tables, and the SQL that checks it where SQL can."""

from __future__ import annotations

import string

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, collocations, exact_dedup, filter_audit, fingerprints, line_dedup, neighbours, ngram_join, packing, quality, suffix_dedup, url_filter, warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded bytes of every text, as digests."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.round_trip(_table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


def op2_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every vector whose id is divisible by 20, among all vectors."""
    table = _table(spark, sf_dir, "embeddings")
    return neighbours.nearest(table, table.where(F.col("vec_id") % 20 == 0), k=20)


# Entries come from the pages themselves: two lists name hosts, parent domains and paths, with
# changes at times that follow from the page id. A page is fetched an hour after the page before.
_ENTRIES = """
SELECT list, name, changed, listed FROM (
  SELECT CASE WHEN page_id % 2 = 0 THEN 'ads' ELSE 'spam' END AS list,
         CASE WHEN page_id % 6 < 2 THEN regexp_extract(lower(url), '^[a-z]+://([^/:?#]+)', 1)
              WHEN page_id % 6 < 4 THEN regexp_extract(lower(url), '^[a-z]+://[^./:?#]+[.]([^/:?#]+)', 1)
              ELSE regexp_extract(url, '^[a-z]+://([^/:?#]+/[^/?#]+)', 1) END AS name,
         3600 * ((page_id * 7919) % (page_id + 1)) AS changed, (page_id * 31) % 5 < 3 AS listed
  FROM pages WHERE url IS NOT NULL AND page_id % 3 = 0
) WHERE name <> ''
"""


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page against the list entries in force when it was fetched."""
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    entries = spark.sql(_ENTRIES.replace("FROM pages", "FROM {pages}"), pages=pages)
    out = url_filter.judged(pages.withColumn("fetched", 3600 * F.col("page_id")), entries)
    return out.select(
        "page_id", "blocked", F.size("hits").cast("long").alias("n_hits"),
        F.array_join(F.transform("hits", lambda h: F.concat(h["list"], F.lit(":"), h["name"])), " ").alias("hits"))


OP3_SQL = f"""
WITH entries AS ({_ENTRIES}),
one AS (SELECT list, name, changed, bool_and(listed) AS listed FROM entries GROUP BY ALL),
spans AS (SELECT *, lead(changed) OVER (PARTITION BY list, name ORDER BY changed) AS until FROM one),
p AS (
  SELECT page_id, 3600 * page_id AS fetched,
         lower(regexp_extract(url, '^[A-Za-z]+://([^/:?#]+)', 1)) AS host,
         regexp_extract(url, '^[A-Za-z]+://[^/?#]*(/[^?#]*)?', 1) AS path
  FROM pages
),
n AS (
  SELECT page_id, fetched, array_to_string(list_slice(string_split(host, '.'), k, len(string_split(host, '.'))), '.') AS name
  FROM p, unnest(range(1, 1 + len(string_split(host, '.')))) AS r(k)
  UNION
  SELECT page_id, fetched, host || array_to_string(list_slice(string_split(path, '/'), 1, k), '/')
  FROM p, unnest(range(2, 1 + len(string_split(path, '/')))) AS r(k)
),
h AS (
  SELECT DISTINCT page_id, list || ':' || n.name AS hit
  FROM n JOIN spans s ON n.name = s.name AND fetched >= changed AND (until IS NULL OR fetched < until) AND listed
)
SELECT p.page_id, count(hit) > 0 AS blocked, count(hit) AS n_hits, coalesce(string_agg(hit, ' ' ORDER BY hit), '') AS hits
FROM pages p LEFT JOIN h ON p.page_id = h.page_id GROUP BY p.page_id
"""


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quality score for every text, learned from trusted positives and unlabelled texts."""
    return quality.quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every byte in a run of 50 that an earlier document holds is removed."""
    out = suffix_dedup.drop_repeated(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents linked by the similarity of their sets of four words in a row."""
    return ngram_join.similar_documents(_table(spark, sf_dir, "documents"), n=4, percent=85)


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page archived, read back and indexed; equal payloads are stored once."""
    index = warc.capture_histories(_table(spark, sf_dir, "pages"))
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to",
                        "url_key", "time", "intact")


_GROUP = "CAST('0x' || substr(d, 5 * i + 1, 5) AS INT)"
OP7_SQL = f"""
WITH t AS (
  SELECT page_id, url, coalesce(html, '') AS html FROM pages
),
u AS (
  SELECT page_id, html, strlen(html) AS payload_bytes, sha1(html) AS d, max(page_id) OVER (PARTITION BY html) AS last,
         regexp_replace(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://|#.*$', '', 'g') AS bare
  FROM t
)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(8), lambda i: array_to_string(list_transform([15, 10, 5, 0],
         lambda s: substr('{warc.BASE32}', 1 + (({_GROUP} >> s) & 31), 1)), '')), '') AS payload_digest,
       CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id < last THEN last END AS refers_to,
       array_to_string(list_reverse(string_split(lower(regexp_extract(bare, '^([^/?:]*)', 1)), '.')), ',') || ')'
         || regexp_extract(bare, '^[^/?:]*(?::[0-9]*)?(.*)$', 1) AS url_key,
       strftime(TIMESTAMP '2024-01-01' + to_seconds(page_id), '%Y-%m-%dT%H:%M:%SZ') AS "time",
       true AS intact
FROM u
"""


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text as token pieces, packed into sequences of 1024 tokens."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    return packing.packed_documents(_table(spark, sf_dir, "documents"), path, end_id=2, with_ids=False)


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal texts, and the row that stays."""
    return exact_dedup.exact_groups(_table(spark, sf_dir, "documents"))


OP9_SQL = r"""
WITH t AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents
)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
FROM t WINDOW w AS (PARTITION BY norm)
"""


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines found in ten documents or more are dropped everywhere."""
    out = line_dedup.drop_common_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


_BLANKS = " || ".join(f"chr({k})" for k in (32, *range(9, 14)))
OP10_SQL = f"""
WITH docs AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (
  SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM docs
),
k AS (
  SELECT *, translate(trim(line, {_BLANKS}), '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS key
  FROM l
),
common AS (
  SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10
)
SELECT doc_id, count(*) AS n_lines, count(c.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE c.key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN common c ON k.key = c.key
GROUP BY doc_id
"""

def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five filters in all 120 orders: per part, order and step, what each removes and costs."""
    return filter_audit.filter_audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


_LETTER_BITS = " + ".join(f"(CASE WHEN contains({{s}}, '{c}') THEN {1 << k} ELSE 0 END)" for k, c in enumerate("ABCDE"))
OP11_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents
),
w AS (
  SELECT *, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM d
),
f AS (
  SELECT doc_id, part,
         CASE WHEN len(ws) < 100 THEN 1 ELSE 0 END
         + CASE WHEN 100 * len(list_distinct(ws)) < 80 * len(ws) THEN 2 ELSE 0 END
         + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) THEN 4 ELSE 0 END
         + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
         + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 16 ELSE 0 END AS mask
  FROM w
),
lab AS (
  SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id
),
m AS (
  SELECT part, mask, count(*) AS n, count(*) FILTER (WHERE good) AS g, count(*) FILTER (WHERE toxic) AS x
  FROM f LEFT JOIN lab USING (doc_id) GROUP BY ALL
),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c),
orders AS (
  SELECT a.c || b.c || c.c || d.c || e.c AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.c, b.c, c.c, d.c, e.c])) = 5
),
steps AS (
  SELECT filter_order, s AS step, (1 << (ascii(substr(filter_order, s, 1)) - 65)) AS bit,
         """ + _LETTER_BITS.format(s="substr(filter_order, 1, s - 1)") + r""" AS earlier
  FROM orders, range(1, 6) r(s)
),
c AS (
  SELECT part, filter_order, step, bit,
         sum(CASE WHEN mask & (bit | earlier) = 0 THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN mask & bit <> 0 AND mask & earlier = 0 THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN mask & bit <> 0 AND mask & earlier <> 0 THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN mask & bit <> 0 AND mask & earlier = 0 THEN g ELSE 0 END) AS good_lost,
         sum(CASE WHEN mask & bit <> 0 AND mask & earlier = 0 THEN x ELSE 0 END) AS toxic_lost
  FROM m, steps GROUP BY ALL
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM c
"""


def op12_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and of its edit by the next document, and their likeness."""
    return fingerprints.fingerprints(_table(spark, sf_dir, "documents"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per language, the 2,000 phrases of 2 to 5 words that their parts explain least."""
    return collocations.collocations(_table(spark, sf_dir, "documents"))


OP13_SQL = f"""
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang,
         translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS t
  FROM documents
),
p AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM d),
w AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS ws FROM p
),
tot AS MATERIALIZED (SELECT lang, sum(len(ws))::BIGINT AS n FROM w GROUP BY lang),
g AS (
  SELECT lang, m, array_to_string(list_slice(ws, i, i + m - 1), ' ') AS phrase
  FROM (SELECT lang, ws, m, unnest(range(1, len(ws) + 2 - m)) AS i FROM w, range(1, 6) r(m) WHERE len(ws) >= m)
),
freq AS MATERIALIZED (
  SELECT lang, m, phrase, count(*)::BIGINT AS f FROM g GROUP BY ALL HAVING count(*) >= 100
),
cand AS MATERIALIZED (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS ws FROM freq WHERE m >= 2),
cuts AS (
  SELECT lang, m, phrase, a, k, array_to_string(list_slice(ws, 1, k), ' ') AS lp,
         array_to_string(list_slice(ws, k + 1, m), ' ') AS rp
  FROM cand, range(1, 5) r(k) WHERE k < m
),
sc AS (
  SELECT cuts.lang, cuts.phrase, a, k, l.f AS l, r.f AS r, tot.n,
         ((1000::HUGEINT * a * tot.n) // (l.f::HUGEINT * r.f))::BIGINT AS score
  FROM cuts JOIN freq l ON l.lang = cuts.lang AND l.phrase = lp JOIN freq r ON r.lang = cuts.lang AND r.phrase = rp
  JOIN tot ON tot.lang = cuts.lang
),
best AS (SELECT * FROM sc QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_ AS (
  SELECT lang, array_to_string(list_slice(ws, i, i + ln - 1), ' ') AS phrase, max(a) AS outer_a
  FROM cand, range(2, 5) x(ln), range(1, 5) y(i) WHERE ln < m AND i + ln - 1 <= m GROUP BY ALL
),
kept AS (
  SELECT b.* FROM best b LEFT JOIN inner_ o ON o.lang = b.lang AND o.phrase = b.phrase
  WHERE o.outer_a IS NULL OR o.outer_a < b.a
)
SELECT lang, rank, phrase, a, l, r, n, score FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
) WHERE rank <= 2000
"""


QUERIES = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_neighbours": op2_neighbours,
    "op3_url_filter": op3_url_filter,
    "op4_quality": op4_quality,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_ngram_join": op6_ngram_join,
    "op7_warc": op7_warc,
    "op8_packing": op8_packing,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_line_dedup": op10_line_dedup,
    "op11_filter_audit": op11_filter_audit,
    "op12_fingerprints": op12_fingerprints,
    "op13_collocations": op13_collocations,
}
ORACLE = {
    "op3_url_filter": OP3_SQL,
    "op7_warc": OP7_SQL,
    "op9_exact_dedup": OP9_SQL,
    "op10_line_dedup": OP10_SQL,
    "op11_filter_audit": OP11_SQL,
    "op13_collocations": OP13_SQL,
}
