"""Baskets, frequent itemsets, association rules and the rule risk score."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.functions.scalars import amount_item
from riskspark.operators.patterns import frequent_itemsets  # noqa: F401


def fit_top_levels(df: DataFrame, column: str, n: int) -> list[str]:
    """The ``n`` most frequent non-null levels, ties by name; frozen at fit time."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("c"))
    return [r[0] for r in counts.orderBy(F.desc("c"), column).limit(n).collect()]


def collapse_levels(column: str, top: list[str], prefix: str = "email="):
    return F.when(F.col(column).isin(top), F.concat(F.lit(prefix), column)).otherwise(F.lit(f"{prefix}other"))


def to_basket(df: DataFrame, top_domains: list[str], label: str | None = None) -> DataFrame:
    """Add ``items``: the sorted distinct items of a row; a column without a value gives no item,
    except that a missing domain counts with the rare ones as ``email=other``."""
    parts = []
    for c in ("ProductCD", "card4", "card6"):
        if c in df.columns:
            parts.append(F.concat(F.lit(f"{c}="), F.trim(F.col(c).cast("string"))))
    if "P_emaildomain" in df.columns:
        parts.append(collapse_levels("P_emaildomain", top_domains))
    if "TransactionAmt" in df.columns:
        parts.append(amount_item("TransactionAmt"))
    if label:
        parts.append(F.when(F.col(label) == 1, "isFraud=Yes").otherwise("isFraud=No"))
    return df.withColumn("items", F.sort_array(F.array_except(F.array(*parts), F.array(F.lit(None).cast("string")))))


def subsets(items):
    """All non-empty sub-lists of a sorted array column; of a frequent itemset they are frequent itemsets themselves."""
    empty = F.expr("array(cast(array() as array<string>))")
    grown = F.aggregate(items, empty, lambda acc, x: F.concat(acc, F.transform(acc, lambda s: F.concat(s, F.array(x)))))
    return F.filter(grown, lambda s: F.size(s) > 0)


def association_rules(itemsets: DataFrame, min_confidence: float, consequent_item: str | None = None) -> DataFrame:
    """Rules antecedent -> consequent from every split of a frequent itemset, with support, confidence and lift.

    ``consequent_item`` keeps the rules whose consequent contains that item (it may hold more).
    """
    whole = itemsets.where(F.col("size") > 1).select("items", "support")
    split = whole.select("items", "support", F.explode(subsets(F.col("items"))).alias("antecedent"))
    split = split.where(F.size("antecedent") < F.size("items")).withColumn("consequent", F.array_except("items", "antecedent"))
    if consequent_item:
        split = split.where(F.array_contains("consequent", consequent_item))
    left = itemsets.select(F.col("items").alias("antecedent"), F.col("support").alias("_sa"))
    right = itemsets.select(F.col("items").alias("consequent"), F.col("support").alias("_sc"))
    rules = split.join(left, "antecedent").join(right, "consequent")
    confidence = F.col("support") / F.col("_sa")
    return rules.select(
        "antecedent", "consequent", "support", confidence.alias("confidence"), (confidence / F.col("_sc")).alias("lift")
    ).where(F.col("confidence") >= min_confidence)


def top_rules(rules: DataFrame, n: int) -> DataFrame:
    """Head by lift, then confidence, then the sides as text."""
    return rules.orderBy(F.desc(F.round("lift", 9)), F.desc(F.round("confidence", 9)),
                         F.array_join("antecedent", ";"), F.array_join("consequent", ";")).limit(n)


def rule_score(antecedents: list[list[str]]):
    """Number of rules whose items are all in ``items``, as a projection for a few rules; ``patterns.rule_scores`` is for many."""
    score = F.lit(0)
    for items in antecedents:
        have = F.lit(True)
        for i in items:
            have = have & F.array_contains("items", i)
        score = score + have.cast("int")
    return score
