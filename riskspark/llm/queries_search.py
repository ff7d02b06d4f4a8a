"""Queries of the lexical search, the vector index and the whitening."""

from riskspark.llm import lexical, multi_index, whitening
from riskspark.llm.base import table
from riskspark.llm.registry import query
from riskspark.llm.words import SQL_WORDS

RANKED_SQL = f"""
WITH d AS (SELECT doc_id, {SQL_WORDS.format('text')} AS w FROM documents),
s AS (SELECT count(*) AS total, CAST(sum(len(w)) AS BIGINT) AS words FROM d WHERE len(w) > 0),
q AS (SELECT DISTINCT item_id, unnest({SQL_WORDS.format('text')}) AS term FROM benchmark),
t AS (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, len(w) AS n, unnest(w) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY ALL),
f AS (SELECT term, CAST(floor(1000 * ln((2 * total + 2) / (2 * df + 1)::DOUBLE)) AS BIGINT) AS weight
  FROM (SELECT term, count(*) AS df FROM t GROUP BY term), s),
p AS (SELECT doc_id, term, weight * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * total) // words))) AS part FROM t JOIN f USING (term), s),
r AS (SELECT item_id, doc_id, CAST(sum(part) AS BIGINT) AS score FROM q JOIN p USING (term) GROUP BY ALL),
k AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM r WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM k WHERE rank <= 50
"""


@query("op11_lexical_search", RANKED_SQL)
def lexical_search(spark, sf_dir):
    return lexical.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), 50)


@query("op13_whitening")
def whitening_(spark, sf_dir):
    return whitening.whiten(table(spark, sf_dir, "embeddings"), 8)


@query("op12_multi_index")
def multi_index_(spark, sf_dir):
    return multi_index.nearest(table(spark, sf_dir, "embeddings"), lambda i: i % 100 == 0, 10)
