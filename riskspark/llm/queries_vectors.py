"""Query of the vector search with its SQL."""

from riskspark.llm import cover_tree
from riskspark.llm.base import table
from riskspark.llm.registry import query

TOP_SQL = """
WITH rows AS (
  SELECT vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
pairs AS (
  SELECT q.vec_id AS query_id, d.vec_id, cast(list_sum(list_transform(list_zip(q.v, d.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM rows q JOIN rows d ON q.vec_id <> d.vec_id WHERE q.vec_id % 50 = 0
),
ranked AS (SELECT *, cast(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM pairs)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


@query("op1_exact_top_k", TOP_SQL)
def exact_top_k(spark, sf_dir):
    return cover_tree.top_k(table(spark, sf_dir, "embeddings"), lambda i: i % 50 == 0, 5)
