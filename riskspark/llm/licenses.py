"""Licence scan with a positional rare-token index, with JVM functions only.

A template is a run of licence words with a mandatory key phrase in it. The index holds, for each template, the word of its
key phrase with the highest inverse document frequency over the scanned texts, and its offset. A text's words are looked up
there; each posting gives the place where the template would start; the key phrase is verified word by word at that place,
and the other template words, which have no postings of their own, are compared at their places after it, all inside the row
of the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.llm.base import DOC, ROW, keyed, stored
from riskspark.llm.phrases import places, rarest_words

#: Phrases and labels that a scan must report.
BASE = [
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
]
#: (label, key phrase, words of the template that follow the key phrase); public licence notices, lower-cased.
NOTICES = [
    ("agpl", "gnu affero general public license", ""),
    ("lgpl", "gnu lesser general public license", ""),
    ("mpl", "mozilla public license", ""),
    ("epl", "eclipse public license", ""),
    ("bsd", "bsd license", ""),
    ("isc", "isc license", ""),
    ("boost", "boost software license", ""),
    ("cc-by", "creative commons attribution", ""),
    ("cc0", "creative commons zero", ""),
    ("apache", "licensed under the apache license version 2 0", "you may not use this file except in compliance with the license"),
    ("gpl", "under the terms of the gnu general public license", "as published by the free software foundation"),
    ("mit", "permission is hereby granted free of charge", "to any person obtaining a copy of this software and associated documentation files"),
    ("bsd", "redistribution and use in source and binary forms", "with or without modification are permitted provided that the following conditions are met"),
    ("isc", "permission to use copy modify and or distribute this software", "for any purpose with or without fee is hereby granted"),
]


def templates(spark: SparkSession, base=BASE, notices=NOTICES) -> DataFrame:
    """(id, label, base, arr, rest): key phrase and following words of each template."""
    rows = [(label, True, phrase.split(), []) for phrase, label in base] + [(label, False, key.split(), rest.split()) for label, key, rest in notices]
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id long, label string, base boolean, arr array<string>, rest array<string>")


def scan(docs: DataFrame, base=BASE, notices=NOTICES, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, n_words, n_base, first_word, last_word, base_labels, labels, score) for every row of ``docs``.

    ``n_base`` counts the places where the words of a base phrase stand consecutively, ``first_word`` and ``last_word`` are
    their smallest and largest start (null if there is none). ``labels`` adds the labels of the notices whose key phrase
    occurs. ``score`` is the largest share of a template's words found in place: 1 for a base phrase, 0 without any.

    Null and empty texts have no words; the labels are then empty and the score 0. Repeated rows each get a line, an empty
    table gives an empty table, other columns are not looked at.
    """
    rows = keyed(docs, text, key)
    known = templates(rows.sparkSession, base, notices)
    phrases = rarest_words(known.select("id", "arr"), rows).join(known.select("id", "rest"), "id")
    found = stored(places(rows, phrases), "places")
    hit = found.where(F.col("id").isNotNull()).join(F.broadcast(known), "id")
    scored = hit.withColumn("share", (F.size("arr") + F.col("more")) / (F.size("arr") + F.size("rest")))
    mine = F.col("base")
    each = scored.groupBy(ROW).agg(
        F.count(F.when(mine, F.lit(1))).alias("n_base"),
        F.min(F.when(mine, F.col("start"))).cast("long").alias("first_word"),
        F.max(F.when(mine, F.col("start"))).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(mine, F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"),
        F.max("share").alias("score"),
    )
    lines = found.where(F.col("id").isNull()).select(ROW, DOC, "n")
    return lines.join(each, ROW, "left").select(
        F.col(DOC).alias(key),
        F.col("n").cast("long").alias("n_words"),
        F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
