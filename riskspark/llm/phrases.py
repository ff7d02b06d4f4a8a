"""Exact places of word phrases in texts with JVM functions only.

A phrase is looked up by one of its words, the one that the fewest texts hold: a text that holds the phrase holds that word at the
phrase's offset, so a single necessary token finds every place. Places are then bounded by position and length and compared
word by word. The array of words never leaves its row: exploding, probing and comparing are one generated loop.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.llm.base import DOC, ROW, stored
from riskspark.llm.words import bytes_of, words

#: Largest phrase index, in bytes of its stored files, that is sent to all executors.
BROADCAST_BYTES = 16 << 20


def split_words(rows: DataFrame) -> DataFrame:
    """(_row, _doc, words, n) of keyed rows."""
    return rows.select(ROW, DOC, words(F.col("text")).alias("words")).select(ROW, DOC, "words", F.size("words").alias("n"))


def rarest_words(phrases: DataFrame, rows: DataFrame, most_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``phrases`` (id, arr) with ``token`` and ``off``: the word of each that the fewest texts hold, and its offset.

    Texts are counted once for each of their words, added up per task before they move. A phrase with a word that no text holds cannot
    occur and is left out.
    """
    each = phrases.select("id", F.posexplode("arr").alias("off", "token"))
    vocabulary = stored(each.select("token").distinct(), "vocabulary")
    small = F.broadcast(vocabulary) if bytes_of(vocabulary) <= most_bytes else vocabulary
    seen = split_words(rows).select(F.explode(F.array_distinct("words")).alias("token")).join(small, "token", "left_semi")
    counts = stored(seen.groupBy("token").agg(F.count(F.lit(1)).alias("n")), "counts")
    ranked = each.join(counts, "token", "left").groupBy("id").agg(
        F.min(F.struct("n", "off", "token")).alias("first"), F.count("n").alias("known"), F.count("off").alias("all")
    )
    return phrases.join(ranked.where("known = all").select("id", "first.token", "first.off"), "id")


def places(rows: DataFrame, index: DataFrame, most_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(_row, _doc, n, id, start, more): every place of every phrase, and one line with a null ``id`` for each text.

    ``index`` is (id, arr, token, off, rest); ``more`` counts the words of ``rest`` that stand at their places after the
    phrase. The index is sent to all tasks if its stored size allows; a larger one is joined by a shuffle of the exploded
    words, and candidates meet their text again to be compared.
    """
    rest = F.col("rest") if "rest" in index.columns else F.array().cast("array<string>")
    index = stored(index.select(F.col("id").cast("long").alias("id"), "arr", "token", "off", rest.alias("rest")), "index")
    split = split_words(rows)
    start = F.col("pos") - F.col("off")
    inside = (start >= 0) & (start + F.size("arr") <= F.col("n"))
    same = F.when(inside, F.slice("words", start + 1, F.size("arr")) == F.col("arr")).otherwise(F.lit(False))
    after = F.slice("words", F.col("start") + F.size("arr") + 1, F.size("rest"))
    matched = F.filter(F.arrays_zip(after.alias("w"), F.col("rest").alias("t")), lambda p: p["w"] == p["t"])
    more = F.when(F.size("rest") > 0, F.size(matched)).otherwise(0).alias("more")
    if bytes_of(index) <= most_bytes:
        empty = F.array().cast("array<string>")
        none = rows.sparkSession.range(1).select(
            F.lit(None).cast("long").alias("id"), empty.alias("arr"), F.lit("").alias("token"), F.lit(0).alias("off"), empty.alias("rest")
        )
        tokens = split.select(ROW, DOC, "n", "words", F.posexplode(F.concat("words", F.array(F.lit("")))).alias("pos", "token"))
        found = tokens.join(F.broadcast(index.unionByName(none)), "token").where(F.col("id").isNull() | same)
        found = found.select(ROW, DOC, "n", "words", "id", "arr", "rest", F.when(F.col("id").isNotNull(), start).alias("start"))
        return found.select(ROW, DOC, "n", "id", "start", more)
    tokens = split.select(ROW, "n", F.posexplode("words").alias("pos", "token"))
    maybe = tokens.join(index.select("id", F.size("arr").alias("len"), "token", "off"), "token")
    maybe = maybe.where((start >= 0) & (start + F.col("len") <= F.col("n"))).select(ROW, "id", "pos")
    kept = maybe.join(index, "id").join(split, ROW).where(same).withColumn("start", start)
    lines = split.select(ROW, DOC, "n", F.lit(None).cast("long").alias("id"), F.lit(None).cast("int").alias("start"), F.lit(0).alias("more"))
    return kept.select(ROW, DOC, "n", "id", "start", more).unionByName(lines)
