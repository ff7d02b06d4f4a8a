"""Queries of the duplicate searches, with SQL where it can express them and is fast enough on whole tables.

A row per byte window takes DuckDB over a minute and several GB on a thousand documents, so the suffix dedup is compared with
a brute-force version instead, as are the SimHash groups.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.llm import phrase_dedup, simhash, suffix_dedup
from riskspark.llm.base import table
from riskspark.llm.registry import query

_BYTES, _WORDS = 400, 13


def digested(out: DataFrame) -> DataFrame:
    """The operator's rows with the digest of the kept text in place of the text."""
    return out.withColumn("kept_sha256", F.sha2(F.col("kept").cast("binary"), 256)).drop("kept")


@query("op3_suffix_dedup")
def suffix(spark, sf_dir):
    return digested(suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), _BYTES))


@query("op6_simhash")
def simhash_groups(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), 3, 2)


PHRASE_SQL = f"""
WITH docs AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
wins AS (SELECT doc_id, s, md5(array_to_string(w[s + 1 : s + {_WORDS}], ' ')) AS k FROM docs, unnest(range(0, len(w) - {_WORDS - 1})) t(s)),
firsts AS (SELECT k, min(doc_id) AS d FROM wins GROUP BY k),
gone AS (SELECT DISTINCT doc_id, s + i AS p FROM wins JOIN firsts USING (k), unnest(range({_WORDS})) u(i) WHERE d < doc_id),
lost AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id),
each AS (SELECT doc_id, p, w[p + 1] AS word FROM docs, unnest(range(0, len(w))) t(p)),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS body FROM each ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(lost.n, 0) AS n_removed, sha256(coalesce(body, '')) AS kept_sha256
FROM docs LEFT JOIN lost USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


@query("op9_substring_dedup", PHRASE_SQL)
def substring(spark, sf_dir):
    return digested(phrase_dedup.remove_passages(table(spark, sf_dir, "documents"), _WORDS))
