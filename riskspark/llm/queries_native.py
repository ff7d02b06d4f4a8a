"""Queries of the operators that use JVM functions only, with their SQL."""

from riskspark.llm import decontaminate, licenses, sharding
from riskspark.llm.base import table
from riskspark.llm.registry import query
from riskspark.llm.words import SQL_WORDS

_WINDOW = 10
_SHARD_BYTES = 1 << 20

CONTAMINATION_SQL = f"""
WITH items AS (SELECT cast(item_id AS VARCHAR) AS item, {SQL_WORDS.format("text")} AS w FROM benchmark),
wins AS (
  SELECT DISTINCT item, array_to_string(w[s + 1 : s + {_WINDOW}], ' ') AS win, least(len(w), {_WINDOW}) AS size
  FROM items, unnest(range(0, greatest(len(w) - {_WINDOW}, 0) + 1)) t(s) WHERE len(w) > 0
),
docs AS (SELECT doc_id, {SQL_WORDS.format("text")} AS w FROM documents),
places AS (
  SELECT doc_id, s, size, array_to_string(w[s + 1 : s + size], ' ') AS win
  FROM docs, (SELECT DISTINCT size FROM wins), unnest(range(0, len(w) - size + 1)) t(s)
),
hits AS (SELECT doc_id, s, size, item FROM places JOIN wins USING (win, size)),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT DISTINCT doc_id, s, size FROM hits), unnest(range(s, s + size)) u(p) GROUP BY doc_id
),
named AS (
  SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(covered.n, 0) AS n_hit, coalesce(named.n, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(covered.n, 0) > 0 AS contaminated
FROM docs LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""


@query("op2_decontamination", CONTAMINATION_SQL)
def decontamination(spark, sf_dir):
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), _WINDOW)


SHARD_SQL = f"""
WITH placed AS (
  SELECT doc_id, cast(octet_length(encode(coalesce(text, ''))) AS BIGINT) AS size,
         substr(md5(concat_ws(chr(9), coalesce(cast(doc_id AS VARCHAR), '\\N'), coalesce(text, '\\N'))), 1, 15) AS hex
  FROM documents
),
bitted AS (
  SELECT doc_id, size, array_to_string(list_transform(range(0, 15), lambda i: substr(
    '0000000100100011010001010110011110001001101010111100110111101111', 4 * (strpos('0123456789abcdef', hex[i + 1 : i + 1]) - 1) + 1, 4)), '') AS b
  FROM placed
),
tried AS (
  SELECT doc_id, size, d, substr(b, 1, d) AS shard, sum(size) OVER cell AS bytes, count(*) OVER cell AS n
  FROM bitted, unnest(range(0, 61)) t(d) WINDOW cell AS (PARTITION BY d, substr(b, 1, d))
),
least_depth AS (SELECT doc_id, min(d) AS d FROM tried WHERE bytes <= {_SHARD_BYTES} GROUP BY doc_id)
SELECT doc_id, size AS n_bytes, shard, cast(d AS INTEGER) AS depth, cast(bytes AS BIGINT) AS shard_bytes, n AS shard_rows
FROM tried JOIN least_depth USING (doc_id, d)
"""


@query("op7_sharding", SHARD_SQL)
def shards(spark, sf_dir):
    return sharding.assign(table(spark, sf_dir, "documents"), _SHARD_BYTES)


_TEMPLATES = ", ".join(
    "(" + ", ".join([str(i), f"'{label}'", str(base).lower(), f"'{key}'", f"'{rest}'"]) + ")"
    for i, (label, base, key, rest) in enumerate(
        [(label, True, phrase, "") for phrase, label in licenses.BASE] + [(label, False, key, rest) for label, key, rest in licenses.NOTICES]
    )
)
LICENSE_SQL = f"""
WITH templates(id, label, base, phrase, more) AS (VALUES {_TEMPLATES}),
known AS (
  SELECT id, label, base, phrase, len(string_split(phrase, ' ')) AS size,
         CASE WHEN more = '' THEN [] ELSE string_split(more, ' ') END AS rest FROM templates
),
docs AS (SELECT doc_id, {SQL_WORDS.format("text")} AS w FROM documents),
sizes AS (SELECT DISTINCT size FROM known),
places AS (
  SELECT doc_id, w, s, size, array_to_string(w[s + 1 : s + size], ' ') AS phrase FROM docs, sizes, unnest(range(0, len(w) - size + 1)) t(s)
),
hits AS (SELECT doc_id, w, s, label, base, size, rest FROM places JOIN known USING (phrase, size)),
scored AS (
  SELECT *, (size + len(list_filter(range(0, len(rest)), lambda i: coalesce(w[s + size + i + 1] = rest[i + 1], false)))) / (size + len(rest)) AS share FROM hits
),
each AS (
  SELECT doc_id, count(*) FILTER (base) AS n_base, min(s) FILTER (base) AS first_word, max(s) FILTER (base) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels,
         string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score
  FROM scored GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0) AS score
FROM docs LEFT JOIN each USING (doc_id)
"""


@query("op10_license_scan", LICENSE_SQL)
def license_scan(spark, sf_dir):
    return licenses.scan(table(spark, sf_dir, "documents"))
