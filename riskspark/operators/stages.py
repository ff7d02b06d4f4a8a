"""Fitted feature steps as Spark ML stages, so that they go into a ``Pipeline`` and can be saved with it.

A fitted stage keeps a JSON-ready ``state`` and lookup ``tables``; both are saved below the stage's own path.
"""

from __future__ import annotations

from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.functions import scalars as S
from riskspark.operators import behavior as B
from riskspark.operators import clean, represent, rules, selection
from riskspark.plans.scratch import persist_table
from riskspark.plans.skew import lookup_join, stored_sizes


class _Options(Params):
    """Stage settings as one dict parameter."""

    options = Param(Params._dummy(), "options", "settings of the stage", TypeConverters.identity)
    defaults: dict = {}

    def _opt(self) -> dict:
        return {**self.defaults, **(self.getOrDefault("options") if self.isSet("options") else {})}


class _Fitter(_Options, Estimator, DefaultParamsReadable, DefaultParamsWritable):
    def __init__(self, **options):
        super().__init__()
        self._set(options=options)


class _StateWriter(MLWriter):
    def __init__(self, stage):
        super().__init__()
        self.stage = stage

    def saveImpl(self, path: str) -> None:
        extra = {"state": self.stage.state, "tables": sorted(self.stage.tables)}
        DefaultParamsWriter.saveMetadata(self.stage, path, self.sparkSession, extraMetadata=extra)
        for name, df in self.stage.tables.items():
            df.write.mode("overwrite").parquet(f"{path}/tables/{name}")


class _StateReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str):
        meta = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        tables = {n: self.sparkSession.read.parquet(f"{path}/tables/{n}") for n in meta["tables"]}
        stage = self.cls(meta["state"], tables)
        stage._resetUid(meta["uid"])
        return stage


class _Fitted(Model, MLWritable, MLReadable):
    def __init__(self, state: dict | None = None, tables: dict[str, DataFrame] | None = None):
        super().__init__()
        self.state = state or {}
        self.tables = tables or {}

    def write(self):
        return _StateWriter(self)

    @classmethod
    def read(cls):
        return _StateReader(cls)


def _kept(df: DataFrame, names: list[str]) -> list[str]:
    return [c for c in names if c in df.columns]


# ---- schema and selection -------------------------------------------------------------------------------------------

class SchemaConform(_Options, Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Bring any batch to a stated schema (DDL text)."""

    def __init__(self, **options):
        super().__init__()
        self._set(options=options)

    def _transform(self, df):
        o = self._opt()
        return clean.conform(df, T.StructType.fromDDL(o["schema"]), zero_fill=o.get("zero_fill", True))


class ColumnPruner(_Fitter):
    """Null share, constants, redundancy, mutual information; remembers the kept columns and their types."""

    defaults = {"label": "isFraud", "id": "TransactionID", "pass": [], "exclude": [], "null_threshold": 0.95, "corr_threshold": 0.98,
                "keep": 167, "bins": 10, "fill": -1.0, "min_score": None}

    def _fit(self, df):
        o = self._opt()
        aside = {o["label"], o["id"], *o["pass"], *o["exclude"]}
        numeric = [c for c in clean.columns_of_kind(df, "numeric") if c not in aside]
        kept = selection.prune_columns(df, numeric, o["label"], null_threshold=o["null_threshold"], corr_threshold=o["corr_threshold"],
                                       keep=o["keep"], bins=o["bins"], fill=o["fill"], min_score=o["min_score"])
        fields = [f for f in df.schema.fields if f.name in kept]
        return ColumnPrunerModel({"schema": T.StructType(fields).json(), "aside": [o["id"], o["label"], *o["pass"]]})


class ColumnPrunerModel(_Fitted):
    def kept(self) -> list[str]:
        return T.StructType.fromJson(self._schema()).names

    def _schema(self):
        import json

        return json.loads(self.state["schema"])

    def _transform(self, df):
        fitted = T.StructType.fromJson(self._schema())
        aside = [df.schema[c] for c in _kept(df, self.state["aside"])]
        keep_null = clean.conform(df, T.StructType([*aside, *[f for f in fitted.fields if f.name not in {a.name for a in aside}]]), zero_fill=False)
        return keep_null


# ---- behaviour ------------------------------------------------------------------------------------------------------

class BehaviorFeatures(_Fitter):
    """Missing flags, time parts, user row count and amount ratio, then median fill and 0.

    ``variant="mean"`` gives the other published form: log amount, rows per card, amount over the user's mean, fill -1.
    """

    defaults = {"id": "TransactionID", "label": "isFraud", "time": "TransactionDT", "amount": "TransactionAmt", "null_threshold": 0.20,
                "variant": "median", "exclude": []}

    def _fit(self, df):
        o = self._opt()
        aside = {o["id"], o["label"], *o["exclude"]}
        inputs = [c for c in df.columns if c not in aside]
        numeric = [c for c in clean.columns_of_kind(df, "numeric") if c not in aside]
        users, overall = B.fit_users(df, o["amount"])
        state = {**o, "flags": [c for c in B.fit_null_columns(df.select(*inputs), o["null_threshold"])],
                 "medians": clean.fit_medians(df, numeric), "overall": overall}
        cards = df.where(F.col("card1").isNotNull()).groupBy("card1").agg(F.count("*").alias("card1_count"))
        return BehaviorFeaturesModel(state, {"users": users, "cards": persist_table(cards, "cards")})


class BehaviorFeaturesModel(_Fitted):
    def _transform(self, df):
        s = self.state
        out = df.select("*", *[S.null_flag(c).alias(f"{c}_null") for c in _kept(df, s["flags"])])
        out = out.withColumns({"hour": S.hour_of_day(s["time"]), "dow": S.day_of_week(s["time"]), "day_of_month": S.day_of_month(s["time"])})
        out = B.apply_users(out, (self.tables["users"], s["overall"]), s["id"], s["amount"])
        if s["variant"] == "mean":
            out = lookup_join(out, self.tables["cards"], ["card1"], "card1_count", F.col(s["id"]), stored=True)
            out = out.withColumns({"card1_count": F.coalesce("card1_count", F.lit(0)), "Amt_Log": S.log1p_nonneg(s["amount"])})
            return clean.fill(out.drop("Amt_to_Median_User", "user_count"), {c: -1.0 for c in _kept(df, list(s["medians"]))})
        out = out.drop("Amt_to_Mean_User")
        return clean.fill(out, {c: (0.0 if m is None else m) for c, m in s["medians"].items() if c in out.columns})


class FrequencyEncoder(_Fitter):
    """``<column>_freq`` and ``<column>_count``; NULL is a level, a level not seen at fit time gets 0."""

    defaults = {"id": "TransactionID", "columns": []}

    def _fit(self, df):
        o = self._opt()
        return FrequencyEncoderModel(o, {c: B.fit_frequencies(df, c) for c in o["columns"]})


class FrequencyEncoderModel(_Fitted):
    def _transform(self, df):
        for c in self.state["columns"]:
            df = B.apply_frequencies(df, self.tables[c], c, self.state["id"])
        return df


class EnsembleFeatures(_Fitter):
    """Time, amount, filled numerics, text frequencies, lengths, levels and tokens, key-set blocks, entity degrees, velocity.

    Degrees and velocity are part of the output (they are computed on the batch itself).
    """

    defaults = {"id": "TransactionID", "label": "isFraud", "time": "TransactionDT", "amount": "TransactionAmt", "null_threshold": 0.20,
                "exclude": [], "text_columns": ["DeviceInfo", "id_30", "id_31", "P_emaildomain", "R_emaildomain"], "max_levels": 12}

    def _fit(self, df):
        o = self._opt()
        aside = {o["id"], o["label"], o["time"], o["amount"], *o["exclude"]}
        numeric = [c for c in clean.columns_of_kind(df, "numeric") if c not in aside]
        texts = [c for c in clean.columns_of_kind(df, "text") if c not in aside]
        tables = {}
        if texts:
            share = F.col("n") / F.lit(float(max(df.count(), 1)))
            tables["levels"] = persist_table(B.level_counts(df, texts).withColumn("share", share), "levels")
        sets = B.usable_key_sets(df)
        tables["key_sets"] = persist_table(B.key_set_stats(df, sets, o["amount"]), "keysets")
        medians = clean.fit_medians(df, [*numeric, o["time"]])
        state = {**o, "numeric": numeric, "texts": texts, "sets": sets, "amount_stats": B.fit_amount(df, o["amount"]), "medians": medians,
                 "flags": B.fit_null_columns(df.select(*numeric), o["null_threshold"], inclusive=True) if numeric else [],
                 "levels": B.fit_levels(df, texts, o["max_levels"]) if texts else {}}
        return EnsembleFeaturesModel(state, tables)


class EnsembleFeaturesModel(_Fitted):
    def _transform(self, df):
        s = self.state
        a = s["amount_stats"]
        time = F.coalesce(F.col(s["time"]), F.lit(s["medians"].get(s["time"]) or 0.0).cast("double"))
        hour, day = S.hour_of_day(time), S.day_of_week(time)
        hs, hc = S.cyclic(hour, 24.0)
        ds, dc = S.cyclic(day, 7.0)
        raw = F.coalesce(F.col(s["amount"]), F.lit(a["median"]))
        amount = S.clip(raw, 0.0, a["clip_high"] if a["clip_high"] > 0 else None)
        cols = [F.col(c) for c in _kept(df, [s["id"], s["label"]])]
        cols += [time.cast("double").alias(s["time"]), S.log1p_nonneg(time).alias(f"{s['time']}_log1p"), hour.alias("tx_hour"), day.alias("tx_day"),
                 hs.alias("tx_hour_sin"), hc.alias("tx_hour_cos"), ds.alias("tx_day_sin"), dc.alias("tx_day_cos"), amount.alias(s["amount"]),
                 F.log1p(amount).alias(f"{s['amount']}_log1p"), F.sqrt(amount).alias(f"{s['amount']}_sqrt"),
                 S.zscore(amount, a["mean"], a["std"]).alias(f"{s['amount']}_zscore")]
        cols += [F.coalesce(F.col(c).cast("double"), F.lit(s["medians"].get(c) or 0.0)).alias(c) for c in s["numeric"]]
        cols += [S.null_flag(c).alias(f"{c}_missing") for c in s["flags"]]
        for c in s["texts"]:
            cols += [F.length(S.clean_text(c)).cast("double").alias(f"{c}_len"), (S.clean_text(c) == "missing").cast("int").alias(f"{c}_missing")]
            cols += S.one_hot(c, s["levels"].get(c, []), c)
            if c in s["text_columns"]:
                cols += S.token_flags(c, c)
        keys = [F.col(c).alias(f"_in_{c}") for c in sorted({c for ks in s["sets"] for c in ks} | set(s["texts"]) | set(_kept(df, B.VELOCITY_ENTITIES)))]
        out = persist_table(df.select(*cols, *keys), "ensemble")
        names = [c for c in out.columns if not c.startswith("_in_")]
        ids = F.col(s["id"])
        inputs = [c for c in out.columns if c.startswith("_in_")]
        key_frame = out.select(s["id"], s["amount"], s["time"], *[F.col(c).alias(c[4:]) for c in inputs])
        # text frequencies
        feats = key_frame
        sizes = stored_sizes(self.tables["levels"], "column", "n") if s["texts"] else {}
        for c in s["texts"]:
            share = self.tables["levels"].where(F.col("column") == c).select(F.col("level").alias("_lev"), F.col("n").alias("_n"), F.col("share").alias(f"{c}_freq"))
            keyed = feats.withColumn("_lev", S.clean_text(c))
            feats = lookup_join(keyed, share, ["_lev"], "_n", ids, sizes=sizes[c]).drop("_lev", "_n").fillna(0.0, [f"{c}_freq"])
        feats = B.with_key_sets(feats, self.tables["key_sets"], s["sets"], a["median"], s["id"], s["amount"])
        feats = B.with_entity_degrees(feats, s["id"])
        feats = B.with_velocity(feats, _kept(key_frame, B.VELOCITY_ENTITIES), s["time"], s["id"])
        made = feats.select(s["id"], *[c for c in feats.columns if c not in key_frame.columns])
        return out.select(*names).join(made, s["id"])


class BlockFeatures(_Fitter):
    """Log amount, missing flags, category codes and counts, group statistics, V components and row null count."""

    defaults = {"id": "TransactionID", "label": "isFraud", "amount": "TransactionAmt", "groups": ["card1", "card2", "addr1"],
                "values": ["TransactionAmt", "dist1", "dist2"], "components": 10, "exclude": []}

    def _fit(self, df):
        o = self._opt()
        aside = {o["id"], o["label"], *o["exclude"]}
        texts = [c for c in clean.columns_of_kind(df, "text") if c not in aside]
        groups, values = _kept(df, o["groups"]), _kept(df, o["values"])
        v = clean.columns_of_family(df, "V")
        tables = {f"codes_{c}": B.fit_codes(df, c, o["id"]) for c in texts}
        tables["groups"] = persist_table(B.group_stats(df, groups, values), "groups")
        pca = represent.fit_pca(df, v, min(o["components"], len(v))) if len(v) > 1 else None
        shown = [c for c in _kept(df, o["values"]) if c not in aside]
        return BlockFeaturesModel({**o, "texts": texts, "groups": groups, "values": values, "pca": pca, "shown": shown}, tables)


class BlockFeaturesModel(_Fitted):
    def _transform(self, df):
        s = self.state
        out = df.withColumns({"amt_log": S.log1p_nonneg(s["amount"]), **{f"{c}_missing": S.null_flag(c) for c in s["shown"]}})
        for c in s["texts"]:
            codes = self.tables[f"codes_{c}"].select("level", F.col("code").alias(f"{c}_code"), F.col("n").alias(f"{c}_count"))
            keyed = out.withColumn("level", F.coalesce(F.col(c), F.lit("missing")))
            out = lookup_join(keyed, codes, ["level"], f"{c}_count", F.col(s["id"]), stored=True).drop("level")
            out = out.fillna(-1, [f"{c}_code"]).fillna(0, [f"{c}_count"])
        out = B.join_group_stats(out, self.tables["groups"], s["groups"], s["id"])
        if s["pca"]:
            out = represent.apply_pca(out, s["pca"], "v_pca_")
        return out.withColumn("missing_count", S.null_count([c for c in out.columns if c not in (s["id"], s["label"])]))


# ---- representation and rules ---------------------------------------------------------------------------------------

class PcaFeatures(_Fitter):
    defaults = {"columns": None, "k": 10, "variance": None, "prefix": "pca_comp_", "id": "TransactionID", "label": "isFraud", "exclude": []}

    def _fit(self, df):
        o = self._opt()
        cols = o["columns"] or [c for c in clean.columns_of_kind(df, "numeric") if c not in {o["id"], o["label"], *o["exclude"]}]
        return PcaFeaturesModel({"pca": represent.fit_pca(df, cols, o["k"], o["variance"]), "prefix": o["prefix"]})


class PcaFeaturesModel(_Fitted):
    def _transform(self, df):
        return represent.apply_pca(df, self.state["pca"], self.state["prefix"])


class ClusterFeature(_Fitter):
    defaults = {"columns": None, "k": 5, "restarts": 10, "seed": 42, "scale": False, "id": "TransactionID", "label": "isFraud", "exclude": [],
                "out": "cluster_label"}

    def _fit(self, df):
        o = self._opt()
        cols = o["columns"] or [c for c in clean.columns_of_kind(df, "numeric") if c not in {o["id"], o["label"], *o["exclude"]}]
        return ClusterFeatureModel({"clusters": represent.fit_clusters(df, cols, o["k"], o["restarts"], o["seed"], o["scale"]), "out": o["out"]})


class ClusterFeatureModel(_Fitted):
    def _transform(self, df):
        return represent.apply_clusters(df, self.state["clusters"], self.state["out"])


class RuleRiskScore(_Fitter):
    """``association_risk_score``: how many of the top rules towards the positive label a row satisfies."""

    defaults = {"label": "isFraud", "min_support": 0.01, "min_confidence": 0.05, "top": 10}

    def _fit(self, df):
        o = self._opt()
        top = rules.fit_top_levels(df, "P_emaildomain", 6) if "P_emaildomain" in df.columns else []
        sets = persist_table(rules.frequent_itemsets(rules.to_basket(df, top, o["label"]), o["min_support"]), "itemsets")
        found = rules.top_rules(rules.association_rules(sets, o["min_confidence"], "isFraud=Yes"), o["top"]).collect()
        return RuleRiskScoreModel({"domains": top, "rules": [list(r["antecedent"]) for r in found]})


class RuleRiskScoreModel(_Fitted):
    def _transform(self, df):
        baskets = rules.to_basket(df, self.state["domains"])
        return baskets.withColumn("association_risk_score", rules.rule_score(self.state["rules"])).drop("items")
