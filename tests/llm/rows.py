"""Small tables for the tests: nulls, empty and long texts, copies, equal ids, and columns with the operators' own names."""

import random

CLASH = "doc_id long, text string, lang string, source string, n_chars long, _row long, words string, fp long, id long"


def key(r):
    return tuple((x is None, "" if x is None else x) for x in r)


def ordered(df):
    return sorted((tuple(r) for r in df.collect()), key=key)


def passages(seed=5, n=60):
    """Texts that share stretches of several lengths; some ids are null or equal."""
    r = random.Random(seed)
    base = ["".join(r.choice("abcd ") for _ in range(r.choice([0, 10, 30, 60, 100, 200]))) for _ in range(8)]
    out = []
    for i in range(n):
        t = "".join(r.choice(base)[r.randrange(5) :][: r.randrange(5, 220)] + r.choice(["", "x", "yz ", "\n"]) for _ in range(r.randrange(4)))
        if r.random() < 0.1 and out:
            t = r.choice(out)[1]
        if r.random() < 0.05:
            t = None
        if r.random() < 0.05:
            t = "a" * r.randrange(90)
        out.append((r.choice([i, i, i, i, None, 3]), t))
    return out


def clashing(spark, pairs):
    """(doc_id, text) pairs as a table of several partitions with further columns."""
    return spark.createDataFrame([(d, t, "en", "s", len(t or ""), 1, "w", 2, 3) for d, t in pairs], CLASH).repartition(3)
