"""Benchmark decontamination as a prefix-filtered set join, with JVM functions only.

Each benchmark item gives windows of consecutive words. Whole windows must be contained, so the necessary prefix of a window
is its one rarest word; texts are joined on it, positions and lengths bound the candidates, and the words of the window are
compared one by one (``phrases``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskspark.llm.base import DOC, ROW, carried, keyed, stored
from riskspark.llm.phrases import BROADCAST_BYTES, places, rarest_words
from riskspark.llm.words import words


def item_windows(items: DataFrame, length: int, text: str = "text", key: str = "item_id") -> DataFrame:
    """(item, arr) for every window of every item; an item with fewer words, but not none, is one window."""
    split = items.select(F.col(key).cast("string").alias("item"), words(F.col(text)).alias("w")).where(F.size("w") > 0)
    at = F.sequence(F.lit(0), F.greatest(F.size("w") - F.lit(length), F.lit(0)))
    return split.select("item", "w", F.explode(at).alias("at")).select("item", F.slice("w", F.col("at") + 1, F.lit(length)).alias("arr"))


def window_hits(rows: DataFrame, items: DataFrame, length: int, most_bytes: int = BROADCAST_BYTES, text: str = "text", key: str = "item_id"):
    """(_row, _doc, n, hits, items): words hit and the sorted ids of items found, for every keyed row."""
    pairs = stored(item_windows(items, length, text, key).distinct(), "pairs")
    distinct = pairs.select("arr").distinct()
    phrases = stored(distinct.select(F.monotonically_increasing_id().alias("id"), "arr"), "windows")
    found = stored(places(rows, rarest_words(phrases, rows, most_bytes), most_bytes), "places")
    hit = found.where(F.col("id").isNotNull())
    spans = (
        hit.join(phrases.select("id", F.size("arr").alias("len")), "id").groupBy(ROW, "start").agg(F.max(F.col("start") + F.col("len")).alias("stop"))
    )
    before = F.max("stop").over(Window.partitionBy(ROW).orderBy("start").rowsBetween(Window.unboundedPreceding, -1))
    new = F.greatest(F.lit(0), F.col("stop") - F.greatest("start", F.coalesce("reach", F.lit(0))))
    covered = spans.withColumn("reach", before).groupBy(ROW).agg(F.sum(new).alias("hits"))
    named = hit.select(ROW, "id").distinct().join(phrases, "id").join(pairs, "arr").groupBy(ROW).agg(F.array_sort(F.collect_set("item")).alias("items"))
    lines = found.where(F.col("id").isNull()).select(ROW, DOC, "n")
    out = lines.join(covered.join(named, ROW, "left"), ROW, "left")
    return out.select(ROW, DOC, "n", F.coalesce("hits", F.lit(0)).alias("hits"), F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def contamination(docs: DataFrame, items: DataFrame, length: int = 10, text: str = "text", key: str = "doc_id", most_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(key, n_words, n_hit, n_items, items_sha256, contaminated) for every row of ``docs``.

    A word is hit if it lies in any occurrence of a window of ``length`` consecutive words of an item (or of the whole item,
    if that is shorter). ``items_sha256`` is over the ids of the items found, sorted as strings and joined by commas.

    Null and empty texts have no words, on either side; an item without words finds nothing. Items with equal texts are all
    named; equal item ids count once, null item ids hit words but are not named. Repeated rows each get a line, an empty
    table gives an empty table, an empty benchmark hits nothing. Other columns are not looked at.
    """
    found = window_hits(keyed(docs, text, key), items, length, most_bytes)
    return found.select(
        F.col(DOC).alias(key),
        F.col("n").cast("long").alias("n_words"),
        F.col("hits").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("hits") > 0).alias("contaminated"),
    )


def uncontaminated(docs: DataFrame, items: DataFrame, length: int = 10, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``docs`` without the rows in which any word is hit."""
    whole = carried(docs, text, key)
    gone = stored(window_hits(whole.select(ROW, DOC, "text"), items, length).where("hits > 0").select(ROW), "contaminated")
    return whole.select(ROW, "rest").join(gone, ROW, "left_anti").select("rest.*")
