"""Scoring of raw records with the fitted preparation and model."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.ml import PipelineModel, Transformer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.columns import known, quoted, require_columns
from plumbline.operators.clean import age_from_today, age_from_year, cast_types, impute
from plumbline.operators.features import Encoder, Scaler, transform_features
from plumbline.operators.quality import Rule, apply_rules
from plumbline.operators.training import without_inputs


def predict(model: PipelineModel | Transformer, df: DataFrame, target: str | None = None) -> DataFrame:
    """Add ``prediction``. The target must not be among the inputs; an empty table stays empty."""
    if target is not None and target in df.columns:
        raise ValueError(f"the target {target} must not be in the scored table")
    return without_inputs(model.transform(df))


@dataclass(frozen=True)
class Preparation:
    """Everything fitted on the training split that a raw record needs."""

    features: tuple[str, ...]
    year_column: str | None = None
    reference_year: int | None = None
    log_columns: tuple[str, ...] = ()
    sqrt_columns: tuple[str, ...] = ()
    encoder: Encoder | None = None
    scaler: Scaler | None = None
    encoding: str = "one_hot"
    types: dict[str, str] = field(default_factory=dict)
    fills: dict[str, Any] = field(default_factory=dict)

    def apply(self, df: DataFrame, drop_original: bool = True) -> DataFrame:
        """The same steps as in training, in the same order; a chain of projections."""
        df = cast_types(df, self.types)
        df = impute(df, {c: v for c, v in self.fills.items() if c in df.columns})
        if self.year_column and self.reference_year is None:
            df = age_from_today(df, self.year_column)
        elif self.year_column:
            df = age_from_year(df, self.year_column, self.reference_year)
        df = transform_features(df, self.log_columns, self.sqrt_columns, drop_original)
        if self.encoder is not None:
            if self.encoding == "label_encoding":
                df = self.encoder.label(df)
                df = df.drop(*self.encoder.categories) if drop_original else df
            else:
                df = self.encoder.one_hot(df, drop_original)
        if self.scaler is not None:
            df = self.scaler.apply(df)
        return df


@dataclass(frozen=True)
class Scorer:
    """Rules, preparation, model and the way back to the scale of the target."""

    preparation: Preparation
    model: PipelineModel | Transformer
    version: str
    rules: tuple[Rule, ...] = ()
    currency: str = "INR"
    target_scaler: Scaler | None = None
    target: str | None = None
    log_target: bool = True

    def score(self, df: DataFrame, keep: Sequence[str]) -> DataFrame:
        """One response row per record; records that break a rule get no price.

        A chain of projections without a shuffle, so it also runs on a stream.
        """
        require_columns(df, keep)
        originals = {f"__keep{i}": quoted(c) for i, c in enumerate(keep)}
        checked = apply_rules(df, self.rules) if self.rules else df.withColumns({
            "violations": F.array().cast("array<string>"), "valid": F.lit(True)
        })
        engineered = self.preparation.apply(checked.withColumns(originals))
        features = self.preparation.features
        incomplete = F.exists(F.array(*[known(engineered, c).isNull() for c in features]), lambda missing: missing)
        flagged = engineered.withColumn(
            "violations",
            F.when(incomplete, F.array_append("violations", F.lit("incomplete"))).otherwise(F.col("violations")),
        ).withColumn("valid", F.col("valid") & ~incomplete)
        # The assembler takes no missing values; such records are already marked.
        scored = self.model.transform(flagged.fillna(0.0, subset=list(features)))
        return scored.select(
            *[F.col(f"__keep{i}").alias(c) for i, c in enumerate(keep)],
            F.when(F.col("valid"), self._price(F.col("prediction"))).alias("predicted_price"),
            F.lit(self.currency).alias("currency"),
            F.lit(self.version).alias("model_version"),
            F.current_timestamp().alias("prediction_timestamp"),
            F.lit(None).cast("string").alias("confidence_interval"),
            "valid",
            "violations",
        )

    def _price(self, prediction: Column) -> Column:
        if self.target_scaler is not None and self.target is not None:
            prediction = self.target_scaler.restore(prediction, self.target)
        return F.expm1(prediction) if self.log_target else prediction


def batch_summary(responses: DataFrame) -> DataFrame:
    """Totals of a scored batch."""
    return responses.agg(
        F.count(F.lit(1)).alias("total_predictions"),
        F.count("predicted_price").alias("priced"),
        F.count_if(~F.col("valid")).alias("rejected"),
        F.current_timestamp().alias("batch_timestamp"),
    )
