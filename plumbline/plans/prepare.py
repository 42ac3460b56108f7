"""From a raw table to train and test tables for a regressor."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions.columns import nan_to_null, quoted, small_table
from plumbline.operators import clean, features
from plumbline.operators.features import Encoder, Scaler
from plumbline.operators.scoring import Preparation
from plumbline.operators.selection import Selection, recursive_elimination
from plumbline.operators.split import holdout
from plumbline.session import materialize
from plumbline.sources.tables import write_processed


@dataclass(frozen=True)
class PrepareOptions:
    """Options of the preparation.

    ``year_per_frame`` takes the latest year of each split instead of the
    training split; ``scale_target`` scales the target with the features and
    ``scaling_columns`` names the columns to scale (default: all numeric ones).
    """

    keys: tuple[str, ...]
    target: str
    test_size: int = 1500
    seed: int = 42
    cleaning: clean.CleaningPlan = field(default_factory=clean.CleaningPlan)
    log_columns: tuple[str, ...] = ()
    sqrt_columns: tuple[str, ...] = ()
    encode: tuple[str, ...] | None = None
    encoding: str = "one_hot"
    scaling: str | None = "standardization"
    scaling_columns: tuple[str, ...] | None = None
    scale_target: bool = False
    year_per_frame: bool = False
    select_features: bool = False
    selection: dict = field(default_factory=dict)


@dataclass(frozen=True)
class Prepared:
    train: DataFrame
    test: DataFrame
    features: tuple[str, ...]
    target: str
    reference_year: int | None
    encoder: Encoder | None
    scaler: Scaler | None
    selection: Selection | None
    fills: dict[str, Any] = field(default_factory=dict)
    cleaned: DataFrame | None = None

    def preparation(self, options: PrepareOptions) -> Preparation:
        """The fitted steps for raw records, without those of the target."""
        source = options.target.removesuffix("_log").removesuffix("_sqrt")
        scaler = self.scaler
        if scaler is not None and self.target in scaler.centre:
            kept = [c for c in scaler.centre if c != self.target]
            scaler = Scaler({c: scaler.centre[c] for c in kept}, {c: scaler.spread[c] for c in kept})
        return Preparation(
            features=self.features,
            year_column=options.cleaning.year_column,
            reference_year=self.reference_year,
            log_columns=tuple(c for c in options.log_columns if c != source),
            sqrt_columns=tuple(c for c in options.sqrt_columns if c != source),
            encoder=self.encoder,
            encoding=options.encoding,
            scaler=scaler,
            types=dict(options.cleaning.types),
            fills=dict(self.fills),
        )


def prepare(df: DataFrame, options: PrepareOptions) -> Prepared:
    """Split, clean, transform, encode, scale and select.

    Everything is fitted on the training split; applying it is a chain of
    projections. The duplicates of a split are found without the row key, so
    equal records with different keys count as copies.
    """
    train, test = holdout(nan_to_null(df), options.keys, options.test_size, options.seed)
    plan = options.cleaning
    # The test split and later records are filled with values of the training split.
    fills = clean.fit_fills(train, plan)
    report = clean.cleaning_report(train.drop(*options.keys), plan)
    year = None
    if plan.year_column and not options.year_per_frame:
        year = clean.latest_year(train, plan.year_column)

    def transformed(frame: DataFrame) -> DataFrame:
        return features.transform_features(
            _clean_records(frame, options, year, fills), options.log_columns, options.sqrt_columns
        )

    # The fits below read the training split several times, but its copies are removed once.
    train, test = materialize(transformed(train)), transformed(test)
    encoder = None
    words = options.encode if options.encode is not None else tuple(
        features.string_columns(train, exclude=options.keys)
    )
    if words:
        encoder = features.fit_encoder(train, words)
        if options.encoding == "one_hot":
            train, test = encoder.one_hot(train), encoder.one_hot(test)
        elif options.encoding == "label_encoding":
            train, test = (encoder.label(f).drop(*words) for f in (train, test))
        else:
            raise ValueError(f"unknown encoding {options.encoding!r}")
    columns = [
        c for c in features.scaling_columns(train, options.target, options.scale_target) if c not in options.keys
    ]
    scaler = None
    if options.scaling:
        scaled = columns if options.scaling_columns is None else list(options.scaling_columns)
        scaler = features.fit_scaler(train, scaled, options.scaling)
        train, test = scaler.apply(train), scaler.apply(test)
    names = [c for c in columns if c != options.target]
    selection = None
    if options.select_features:
        selection = recursive_elimination(
            train, names, options.keys, options.target, seed=options.seed, **options.selection
        )
        names = [c for c in names if c in selection.selected]
    keep = [*options.keys, options.target]
    return Prepared(
        features.select_features(train, names, keep),
        features.select_features(test, names, keep),
        tuple(names), options.target, year, encoder, scaler, selection, fills, report,
    )


def _clean_records(frame: DataFrame, options: PrepareOptions, year: int | None, fills: dict[str, Any]) -> DataFrame:
    """The cleaning chain; copies are rows that agree in everything but the key."""
    plan = options.cleaning
    kept = clean.CleaningPlan(
        types=plan.types, missing=plan.missing, missing_columns=plan.missing_columns, duplicates="keep",
        year_column=None, drop=(),
    )
    frame = clean.clean(frame, kept, fills=fills)
    if plan.duplicates == "remove":
        others = [c for c in frame.columns if c not in options.keys]
        # The copy with the smallest key stays, whichever task sees it first.
        groups = frame.groupBy(*[quoted(c) for c in others])
        if len(options.keys) == 1:
            # A plain minimum keeps the aggregate hash-based; a struct would need a sort.
            frame = groups.agg(F.min(quoted(options.keys[0])).alias(options.keys[0]))
        else:
            first = F.min(F.struct(*[quoted(k) for k in options.keys])).alias("__key")
            frame = groups.agg(first).select("__key.*", *[quoted(c) for c in others])
    if plan.year_column:
        frame = clean.age_from_year(frame, plan.year_column, year)
    return clean.drop_columns(frame, plan.drop)


def write_prepared(prepared: Prepared, folder: str, version: int) -> dict[str, str]:
    """Store both splits and the fitted parameters under one version."""
    spark = prepared.train.sparkSession
    paths = {
        "train": write_processed(prepared.train, folder, "train", version),
        "test": write_processed(prepared.test, folder, "test", version),
    }
    tables = {
        "encoder": prepared.encoder and prepared.encoder.to_table(spark),
        "scaler": prepared.scaler and prepared.scaler.to_table(spark),
        "selection": prepared.selection and prepared.selection.table(spark),
        "fills": prepared.fills and small_table(
            spark, [(c, str(v)) for c, v in prepared.fills.items() if v is not None], "column string, value string"),
        "cleaning_report": prepared.cleaned,
    }
    for name, fitted in tables.items():
        if fitted is not None and fitted != {}:
            paths[name] = f"{folder}/{name}_v{version}"
            fitted.write.mode("overwrite").parquet(paths[name])
    return paths
