"""Customer feature table: aggregates, time features, encodings, scaling and WoE."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from riskloom.columns import DEFAULT, TxnColumns
from riskloom.functions.exprs import c
from riskloom.operators.aggregate import category_columns, category_values, customer_aggregates, modal_categories
from riskloom.operators.encode import LOW_CARDINALITY, CategoryEncoder, CategoryEncoderModel
from riskloom.operators.normalize import Normalizer, NormalizerModel, log_columns
from riskloom.operators.temporal import VELOCITY_WINDOWS, calendar_modes, temporal_features
from riskloom.operators.woe import MIN_IV, Woe, WoeModel
from riskloom.plans.dictionary import feature_dictionary
from riskloom.session import materialize


@dataclass(frozen=True)
class FeatureConfig:
    """What the feature table contains."""

    cols: TxnColumns = DEFAULT
    categories: tuple[str, ...] | None = None  # default: all text columns but key and time
    recent: bool = True
    cyclical: bool = True
    gaps: bool = True
    velocity_windows: tuple[int, ...] = VELOCITY_WINDOWS
    calendar_velocity: bool = False
    low_cardinality: int = LOW_CARDINALITY
    woe_level: str = "customer"  # or "transaction": maps fitted on raw rows
    woe_bins: int = 4
    min_iv: float | None = MIN_IV  # None keeps every feature
    stage_input: bool = False  # write the transactions once, when they are a join or another costly plan


# the earlier, smaller feature set: no recent, cyclical, gap or velocity block, WoE on transactions without a filter
BASIC = FeatureConfig(recent=False, cyclical=False, gaps=False, velocity_windows=(), woe_level="transaction", woe_bins=5, min_iv=None)


def customer_base(txn: DataFrame, cfg: FeatureConfig = FeatureConfig()) -> tuple[DataFrame, list[str]]:
    """Customer rows with numeric features, ``HasFraud`` if labelled, and modal categories.

    Branches over column-pruned scans, each reduced to one row per customer before it is joined on the customer key. Categories with few values
    belong to the first branch; only those with many need one of their own.
    """
    cols = cfg.cols
    categories = [n for n in (cfg.categories if cfg.categories is not None else category_columns(txn, cols)) if n in txn.columns]
    values = category_values(txn, categories)
    out = customer_aggregates(txn, cols, recent=cfg.recent, cyclical=cfg.cyclical, categories=values)
    if cfg.gaps or cfg.velocity_windows:
        timed = temporal_features(txn, cols, cfg.gaps, cfg.velocity_windows, cfg.calendar_velocity)
    else:
        timed = calendar_modes(txn, cols)
    out = out.join(timed, cols.id, "left")
    many = [n for n in categories if n not in values]
    if many:
        out = out.join(modal_categories(txn, many, cols), cols.id, "left")
    return out.select(*[c(n) for n in out.columns if n not in categories], *[c(n) for n in categories]), categories


def _ordered(columns: list[str], cfg: FeatureConfig, leave_out: set[str]) -> list[str]:
    """Measures first, then each calendar part with its statistics, gaps and velocities."""
    groups = ("Hour_mean", "Hour_std", "Weekday", "Day", "Month_mean", "Month_mode", "Year", "Is", "Hour_", "Month_", "TimeSinceLast", "Velocity")
    known = [n for n in columns if n not in leave_out and n != cfg.cols.id]
    timed = [n for g in groups for n in known if n.startswith(g)]
    timed = list(dict.fromkeys(timed))
    return [cfg.cols.id] + [n for n in known if n not in timed] + timed


@dataclass
class FeatureModel:
    """Frozen encoders, scaler and WoE maps; applies to any later transactions."""

    cfg: FeatureConfig
    categories: list[str]
    numeric: list[str]
    encoder: CategoryEncoderModel = field(repr=False)
    normalizer: NormalizerModel = field(repr=False)
    woe: WoeModel | None = field(repr=False)
    base: DataFrame = field(repr=False)

    @property
    def woe_features(self) -> list[str]:
        if self.woe is None:
            return []
        return list(self.woe.ivs) if self.cfg.min_iv is None else self.woe.kept(self.cfg.min_iv)

    def features_of(self, base: DataFrame) -> DataFrame:
        key = self.cfg.cols.id
        out = self.encoder.transform(base)
        out = self.normalizer.transform(out)
        if self.woe_features:
            out = self.woe.transform(out, self.woe_features)
        names = self.numeric + self.encoder.feature_names + self.normalizer.feature_names + [f"{n}_woe" for n in self.woe_features]
        return out.select(c(key), *[c(n) for n in names if n != key])

    def transform(self, txn: DataFrame) -> DataFrame:
        base, _ = customer_base(txn, self.cfg)
        return self.features_of(base)

    def dictionary(self) -> DataFrame:
        kinds = [(n, "aggregate") for n in self.numeric if n != self.cfg.cols.id]
        kinds += [(n, "frequency" if n in {f"{x}_freq" for x in self.encoder.frequency_cols} else "one_hot") for n in self.encoder.feature_names]
        kinds += [(n, "normalized") for n in self.normalizer.feature_names]
        kinds += [(f"{n}_woe", "woe") for n in self.woe_features]
        return feature_dictionary(self.base.sparkSession, kinds, self.woe.ivs if self.woe else {})


def fit_features(txn: DataFrame, cfg: FeatureConfig = FeatureConfig()) -> FeatureModel:
    """Build the customer base once, then fit encoders, scaler and WoE on it."""
    if cfg.stage_input:
        txn = materialize(txn, "transactions")
    base, categories = customer_base(txn, cfg)
    base = materialize(base, "customer-base")
    has_label = "HasFraud" in base.columns
    numeric = _ordered(base.columns, cfg, set(categories) | {"HasFraud"})
    encoder = CategoryEncoder(categories, cfg.low_cardinality).fit(base)
    normalizer = Normalizer(log_columns(numeric, cfg.cols.amount, cfg.cols.value)).fit(base)
    woe = None
    if has_label and categories:
        if cfg.woe_level == "transaction":
            woe = Woe(categories, cfg.cols.label, cfg.woe_bins, cfg.cols.id).fit(txn.where(c(cfg.cols.id).isNotNull()))
        else:
            woe = Woe(categories, "HasFraud", cfg.woe_bins, cfg.cols.id).fit(base)
    return FeatureModel(cfg, categories, numeric, encoder, normalizer, woe, base)


def build_features(txn: DataFrame, cfg: FeatureConfig = FeatureConfig()) -> tuple[DataFrame, DataFrame]:
    """Feature table and its dictionary."""
    model = fit_features(txn, cfg)
    return model.features_of(model.base), model.dictionary()
