"""Column expressions: time parts, encodings, text flags, bands and guarded arithmetic. All stay inside codegen."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Device and browser words looked for in text columns.
DEVICE_TOKENS = ["windows", "mac", "ios", "android", "linux", "chrome", "safari", "firefox", "mobile", "tablet", "samsung"]
# Product codes counted as high risk (1) or not (0); any other code counts as 0.
PRODUCT_RISK = {"W": 0, "C": 1, "H": 1, "R": 0, "S": 0}
# Amount bands as (lower limit, level, score, action, factor of the amount at stake), highest first.
AMOUNT_RULES = [
    (1500.0, "SEVERE", 92, "Block Immediately", 1.2),
    (500.0, "SUSPICIOUS", 64, "Verify User Identity", 0.5),
]
AMOUNT_RULE_ELSE = ("SAFE", 12, "Allow Transaction", 0.0)


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hour_of_day(dt) -> Column:
    return F.pmod(F.floor(_c(dt) / 3600), F.lit(24)).cast("bigint")


def day_of_week(dt) -> Column:
    return F.pmod(F.floor(_c(dt) / 86400), F.lit(7)).cast("bigint")


def day_of_month(dt) -> Column:
    return F.pmod(F.floor(_c(dt) / 86400), F.lit(30)).cast("bigint")


def legacy_day_of_week(dt) -> Column:
    """Older definition, one day behind :func:`day_of_week`."""
    return F.floor(F.pmod(_c(dt) / 86400 - 1, F.lit(7.0))).cast("bigint")


def cyclic(value, period: float) -> tuple[Column, Column]:
    angle = _c(value) * F.lit(2 * math.pi / period)
    return F.sin(angle), F.cos(angle)


def log1p_nonneg(c) -> Column:
    return F.log1p(F.greatest(_c(c), F.lit(0.0)))


def clip(c, low=None, high=None) -> Column:
    """Clip, keeping NULL (``greatest``/``least`` alone would skip it)."""
    out = x = _c(c)
    if low is not None:
        out = F.greatest(out, F.lit(float(low)))
    if high is not None:
        out = F.least(out, F.lit(float(high)))
    return F.when(x.isNotNull(), out)


def zscore(c, mean: float, std: float, eps: float = 1e-6) -> Column:
    return (_c(c) - F.lit(float(mean))) / F.lit(float(std) + eps)


def clean_text(c) -> Column:
    """NULL becomes ``missing``; trimmed and lower-cased."""
    return F.lower(F.trim(F.coalesce(_c(c).cast("string"), F.lit("missing"))))


def composite_key(cols: list, sep: str = "|") -> Column:
    return F.concat_ws(sep, *[clean_text(c) for c in cols])


def user_key(card="card1", addr="addr1") -> Column:
    """``card_addr`` with ``nan`` for a missing part."""
    part = lambda c: F.coalesce(_c(c).cast("string"), F.lit("nan"))
    return F.concat(part(card), F.lit("_"), part(addr))


def token_flags(c, prefix: str, tokens: list[str] = DEVICE_TOKENS) -> list[Column]:
    text = clean_text(c)
    return [text.contains(t).cast("int").alias(f"{prefix}__has_{t}") for t in tokens]


def one_hot(c, levels: list[str], prefix: str) -> list[Column]:
    """One 0/1 column per level fixed at fit time; the caller passes at most a dozen levels."""
    text = clean_text(c)
    return [(text == F.lit(v)).cast("int").alias(f"{prefix}__{v}") for v in levels]


def null_flag(c) -> Column:
    return _c(c).isNull().cast("int")


def null_count(cols: list[str]) -> Column:
    total = F.lit(0)
    for c in cols:
        total = total + null_flag(c)
    return total


def product_risk(c) -> Column:
    out = None
    for code, flag in PRODUCT_RISK.items():
        out = F.when(_c(c) == code, flag) if out is None else out.when(_c(c) == code, flag)
    return out.otherwise(0)


def predicted(p, threshold: float = 0.5, inclusive: bool = False) -> Column:
    hit = _c(p) >= F.lit(threshold) if inclusive else _c(p) > F.lit(threshold)
    return hit.cast("int")


def risk_band(p) -> Column:
    return F.when(_c(p) > 0.5, "severe").when(_c(p) > 0.3, "suspicious").otherwise("safe")


def amount_rule(amount) -> dict[str, Column]:
    """Level, score, action and amount at stake by the fixed amount bands."""
    a = _c(amount)

    def pick(i, last):
        out = None
        for row in AMOUNT_RULES:
            value = F.lit(row[i]) if i < 4 else a * F.lit(row[4])
            out = F.when(a > row[0], value) if out is None else out.when(a > row[0], value)
        return out.otherwise(last)

    level, score, action, _ = AMOUNT_RULE_ELSE
    return {
        "level": pick(1, F.lit(level)),
        "score": pick(2, F.lit(score)),
        "action": pick(3, F.lit(action)),
        "impact": pick(4, F.lit(0.0)),
    }


def case_review(amount, score) -> dict[str, Column]:
    """Band of a case under review: raise to 85 above 1500, set 60 above 300, else lower to 20."""
    a, s = _c(amount), _c(score)
    return {
        "case_score": F.when(a > 1500, F.greatest(s, F.lit(85))).when(a > 300, F.lit(60)).otherwise(F.least(s, F.lit(20))),
        "case_level": F.when(a > 1500, "severe").when(a > 300, "suspicious").otherwise("safe"),
    }


def weighted_vote(columns: list, weights: list[float]) -> Column:
    """Weighted mean of probabilities; the plain mean when no weight is positive."""
    kept = [max(float(w), 0.0) for w in weights]
    if sum(kept) <= 0:
        kept = [1.0] * len(columns)
    total = None
    for c, w in zip(columns, kept):
        term = _c(c) * F.lit(w / sum(kept))
        total = term if total is None else total + term
    return total


def guarded_ratio(num, den) -> Column:
    """Division by at least one."""
    return _c(num) / F.greatest(_c(den), F.lit(1))


def finite(c, fill=None) -> Column:
    """NaN and both infinities become NULL or ``fill``."""
    x = _c(c)
    bad = F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    good = F.when(~bad, x)
    return good if fill is None else F.coalesce(good, F.lit(float(fill)))


def round_half_even(c, digits: int) -> Column:
    """Scale, round to the nearest even, scale back: the rounding of array libraries on doubles."""
    scale = F.lit(float(10**digits))
    return F.rint(_c(c) * scale) / scale


def to_number(c) -> Column:
    """Cast to double; anything that is no number becomes NULL."""
    return finite(_c(c).try_cast("double"))


def amount_item(amount) -> Column:
    a = _c(amount)
    return F.when((a > 0) & (a <= 50), "Amt=Low").when((a > 50) & (a <= 200), "Amt=Mid").when(a > 200, "Amt=High")
