"""Feature pipeline built from dictionary roles."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Estimator, Pipeline, Transformer
from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.casts import decimals_to_double, to_timestamp
from ledgerloom.functions.dates import (
    PART_SETS,
    QUARTERS,
    WEEK_SYSTEMS,
    date_stage,
    part_columns,
    quote,
)
from ledgerloom.operators.ranges import fit_split_points
from ledgerloom.plans.stages import MISSING, BucketModel, CategoryModel, MissingModel, WideCategoryModel
from ledgerloom.sources.dictionary import Field, check_schema, features_of, keys_of

FEATURES = "features"
# Date part of a missing date where rows with missing values are kept.
MISSING_PART = -1
#: Categories of a text column up to which each has a position of its own in the vector that trees are grown on.
WIDE = 512
#: Categories, the most frequent, that have one in a column of more; the others are told apart by a binary code.
OWN = 32

_CHOICES = {
    "date_parts": tuple(PART_SETS),
    "week_system": WEEK_SYSTEMS,
    "quarter": QUARTERS,
    "handle_invalid": ("error", "skip", "keep"),
}


@dataclass(frozen=True)
class FeatureOptions:
    """How features are built.

    ``date_parts``: "clock" (year, month, day, hour, minute) or "calendar" (nine
    parts). ``handle_invalid``: what NaN, NULL and unseen categories do; "error",
    "skip" (not trained on, and scored as NULL) or "keep". Kept, a number has a
    bucket of its own and counts as 0, the parts of a date are ``MISSING_PART``,
    and a category has an index of its own.
    """

    date_parts: str = "clock"
    week_system: str = "iso"
    quarter: str = "month_div_4"
    handle_invalid: str = "error"

    def __post_init__(self) -> None:
        for name, words in _CHOICES.items():
            if getattr(self, name) not in words:
                raise ValueError(f"{name} must be one of {words}, not {getattr(self, name)!r}")


def used_columns(fields: Sequence[Field]) -> set[str]:
    """Names of the columns the job uses."""
    return set(keys_of(fields)) | set(features_of(fields, "DOUBLE", "DATE", "NOMINAL", "TARGET"))


def source_frame(df: DataFrame, fields: Sequence[Field], strict: bool = True) -> DataFrame:
    """Only the columns the job uses, in declared order, with decimals and text dates cast.

    A text that is no date raises, or is NULL when not ``strict``.
    """
    wanted = used_columns(fields)
    missing = sorted(wanted - set(df.columns))
    if missing:
        raise ValueError(f"dictionary and table differ: not in the table: {', '.join(missing)}")
    dates = set(features_of(fields, "DATE"))
    pruned = df.select(*[F.col(quote(f.name)) for f in fields if f.name in wanted])
    text_dates = {
        name: to_timestamp(name, strict)
        for name in pruned.columns
        if name in dates and isinstance(pruned.schema[name].dataType, T.StringType)
    }
    ready = decimals_to_double(pruned.withColumns(text_dates) if text_dates else pruned)
    check_schema(fields, ready.schema)
    return ready


def feature_columns(fields: Sequence[Field], options: FeatureOptions = FeatureOptions()) -> list[str]:
    """Columns that make up the feature vector, in declared order.

    The ``_vec`` column of a text column that holds one category only has no
    positions and is left out when the stages are built.
    """
    columns: list[str] = []
    for field in fields:
        if field.role == "DATE":
            columns += part_columns(field.name, PART_SETS[options.date_parts])
        elif field.role == "DOUBLE":
            known = field.name if options.handle_invalid == "error" else f"{field.name}_known"
            columns += [f"{field.name}_bucket", known]
        elif field.role == "NOMINAL":
            columns.append(f"{field.name}_vec")
    return columns


def feature_stages(
    fields: Sequence[Field],
    statistics: DataFrame,
    train_rows: DataFrame,
    options: FeatureOptions = FeatureOptions(),
    for_trees: bool = False,
) -> list[Estimator | Transformer]:
    """Stages from source columns to ``features``.

    Trees hold every position of every row, zeros too, so the rows of a column with a
    category for every so many of them would take memory and time by the square of
    their number. ``for_trees`` gives a column of more than ``WIDE`` categories few positions:
    one for each of the ``OWN`` most frequent, and a binary code for each of the others.
    ``statistics`` is the frame that value ranges are taken from; categories are
    those of ``train_rows``. It takes one pass for all ranges and one for all
    categories, however many columns there are. SKIP and TEXT fields add nothing.
    """
    dates = features_of(fields, "DATE")
    doubles = features_of(fields, "DOUBLE")
    nominals = features_of(fields, "NOMINAL")
    if not (dates or doubles or nominals):
        raise ValueError("the dictionary declares no field that a feature can be built from")
    check_names(fields, train_rows.columns, options)
    keep = options.handle_invalid != "error"
    stages: list[Estimator | Transformer] = []
    if dates:
        missing = MISSING_PART if keep else None
        parts = PART_SETS[options.date_parts]
        stages.append(date_stage(dates, parts, options.week_system, options.quarter, missing))
    if doubles:
        stages.append(BucketModel(fit_split_points(statistics, doubles), keep))
    without_positions: set[str] = set()
    wide: dict[str, int] = {}
    known: dict[str, int] = {}
    if nominals:
        categories = CategoryModel.fit_on(train_rows, nominals, keep)
        known = {name: size.categories for name, size in categories.sizes.items()}
        stages.append(categories)
        # One category less the dropped one leaves a vector of no positions, which
        # the encoder refuses; a kept row adds a category for what is unknown.
        encoded = [name for name in nominals if categories.values_of(name) > 1]
        without_positions = {f"{name}_vec" for name in nominals if name not in encoded}
        wide = {name: categories.values_of(name) for name in encoded if for_trees and known[name] > WIDE}
        if wide:
            taken = [f"{name}_{part}" for name in wide for part in ("head", "code")]
            if twice := sorted({*taken} & {*train_rows.columns}):
                raise ValueError(f"feature columns that would have the name of another column: {', '.join(twice)}")
            stages.append(WideCategoryModel(wide, OWN))
        if encoded:
            stages.append(
                OneHotEncoder(
                    inputCols=[f"{name}_head" if name in wide else f"{name}_idx" for name in encoded],
                    outputCols=[f"{name}_vec" for name in encoded],
                )
            )
    if options.handle_invalid == "skip":
        stages.append(MissingModel(doubles, dates, known))
    columns = [name for name in feature_columns(fields, options) if name not in without_positions]
    coded = {f"{name}_vec": [f"{name}_vec", f"{name}_code"] for name in wide}
    columns = [own for name in columns for own in coded.get(name, [name])]
    if not columns:
        raise ValueError("no field gives a feature: every text column holds one category only")
    stages.append(VectorAssembler(inputCols=columns, outputCol=FEATURES))
    return stages


def check_names(fields: Sequence[Field], columns: Sequence[str], options: FeatureOptions) -> None:
    """``ValueError`` if a feature column would be named as another one, or as a source column."""
    made = [FEATURES, MISSING]
    for field in fields:
        made += [name for name in feature_columns([field], options) if name != field.name]
        made += [f"{field.name}_idx"] if field.role == "NOMINAL" else []
    twice = sorted({name for name in made if made.count(name) > 1 or name in columns})
    if twice:
        raise ValueError(f"feature columns that would have the name of another column: {', '.join(twice)}")


def complete_rows(frame: DataFrame) -> DataFrame:
    """The rows of a transformed frame that miss no value, where those are to be skipped."""
    return frame.where(~F.col(MISSING)).drop(MISSING) if MISSING in frame.columns else frame


def feature_frame(
    df: DataFrame,
    fields: Sequence[Field],
    options: FeatureOptions = FeatureOptions(),
) -> DataFrame:
    """``df``'s used columns plus every feature column and ``features``, fitted on ``df``."""
    source = source_frame(df, fields, options.handle_invalid == "error")
    model = Pipeline(stages=feature_stages(fields, source, source, options)).fit(source)
    return complete_rows(model.transform(source))
