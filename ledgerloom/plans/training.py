"""The job: split, fit features and boosted trees, score the hold-out, measure, save."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import cached_property
from typing import Any

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.casts import label_column
from ledgerloom.functions.dates import quote
from ledgerloom.operators.confusion import classification_metrics, count_columns, metrics_from_counts
from ledgerloom.operators.invalid import count_rows, source_counts, unseen_counts
from ledgerloom.operators.splits import (
    BUCKET,
    bucket_split,
    content_bucket,
    random_split,
    with_key_bucket,
    with_random_bucket,
)
from ledgerloom.plans.features import (
    FEATURES,
    FeatureOptions,
    complete_rows,
    feature_stages,
    source_frame,
    used_columns,
)
from ledgerloom.plans.stages import MISSING, BucketModel, CategoryModel
from ledgerloom.session import drop_table, shared_dir, shared_table
from ledgerloom.sources.dictionary import Field, features_of, keys_of, load_fields, read_dictionary, target_of
from ledgerloom.sources.jdbc import JdbcTable, read_jdbc
from ledgerloom.sources.outputs import (
    metrics_path,
    model_path,
    new_run,
    publish_run,
    save_metrics,
    save_model,
    scored_path,
)

# Names of the metrics, as they are saved.
METRICS = ("precision", "recall", "f1Score", "accuracy")

#: Rows that one partition holds at most, about: a job of more rows has more partitions than it states.
PARTITION_ROWS = 250_000

_CHOICES = {
    "split": ("keyed", "random", "content", None),
    "stats_from": ("all", "train"),
    "reuse": ("persist", "table", "none"),
}


@dataclass(frozen=True)
class TrainOptions:
    """How the job runs.

    ``split``: "keyed", "random", "content" for a random one that no partitioning
    changes, or None for keyed where the dictionary has a key. ``stats_from``: take value ranges from "all" rows or from "train" only.
    ``reuse``: how the passes of the job share the source; "persist" keeps the
    used columns in executor memory and disk, "table" writes them once as parquet
    to the shared folder (for sources that must be read only once), "none" reads
    the source each time (good for files that are columnar already).
    ``keep_scored``: a job with an output folder writes its scored hold-out there,
    in the pass that measures it.
    ``partitions``: shuffle the used columns into so many, None to leave them as
    they are. Trees depend on how rows are parted, so give a number to have the
    same model on every cluster. ``train`` takes more where partitions would hold over
    ``PARTITION_ROWS`` rows; how many follows from the number of rows alone, which is
    counted for it. ``classifier``: parameters of ``GBTClassifier``.
    """

    seed: int = 42
    train_share: float = 0.8
    split: str | None = None
    stats_from: str = "all"
    reuse: str = "persist"
    partitions: int | None = None
    keep_scored: bool = False
    features: FeatureOptions = FeatureOptions()
    classifier: Mapping[str, Any] = field(default_factory=dict)

    def __post_init__(self) -> None:
        for name, words in _CHOICES.items():
            if getattr(self, name) not in words:
                raise ValueError(f"{name} must be one of {words}, not {getattr(self, name)!r}")


class TrainResult:
    """Fitted model and scored hold-out; the metrics are computed when they are first asked for.

    ``scored`` and the metrics read the same kept rows. ``save_scored`` writes the
    scored rows and measures them in the same pass. ``run`` is the folder that the job
    published, if any. ``close``, or leaving a ``with`` block, gives up the kept rows and
    deletes what the job wrote to the shared folder; after it only what was saved
    can be used.
    """

    def __init__(
        self,
        model: PipelineModel,
        scored: DataFrame,
        fields: Sequence[Field],
        release: Callable[[], None],
        source_values: Callable[[], Mapping[str, int]] = dict,
    ) -> None:
        self.model = model
        self.scored = scored
        self.run: str | None = None
        self._fields = fields
        self._release = release
        self._source_values = source_values

    def _aggregates(self) -> list[Column]:
        """Confusion counts, and counts of unseen categories where rows with one are scored."""
        known = [stage.sizes for stage in self.model.stages if isinstance(stage, CategoryModel) and stage.keep]
        unseen = unseen_counts({name: size.categories for sizes in known for name, size in sizes.items()})
        return [*count_columns(self.scored.schema, "prediction", target_of(self._fields)), *unseen]

    @cached_property
    def counts(self) -> dict[str, int]:
        """Confusion counts ``tp, fp, tn, fn, n`` and unseen categories of the hold-out, from one pass."""
        return self.scored.agg(*self._aggregates()).first().asDict()

    def save_scored(self, path: str, columns: Sequence[str] | None = None) -> DataFrame:
        """Write the scored rows, or ``columns`` of them, as Parquet, and read them from there.

        The counts that the metrics follow from are observed while the rows are
        written, so neither the metrics nor a reader of the rows computes them again.
        """
        seen = Observation()
        rows = self.scored.observe(seen, *self._aggregates())
        rows = rows if columns is None else rows.select(*[F.col(quote(name)) for name in columns])
        rows.write.parquet(path)
        self.counts = dict(seen.get)
        return rows.sparkSession.read.schema(rows.schema).parquet(path)

    @cached_property
    def metrics(self) -> DataFrame:
        """One row, computed once."""
        cells = [F.lit(self.counts[name]).cast("long").alias(name) for name in ("tp", "fp", "tn", "fn", "n")]
        return metrics_from_counts(self.scored.sparkSession.sql("SELECT 1").select(*cells))

    @cached_property
    def bad_values(self) -> DataFrame:
        """``field, kind, n``: values that no feature can be built from.

        ``null``, ``nan`` and ``unparsed`` (a text that is no date) are counted over all source
        rows: in the pass that writes them where ``reuse`` is "table", and else in
        one when they are asked for. ``unseen`` categories are counted over the hold-out
        along with the metrics, where such rows are kept or skipped.
        """
        return count_rows(self.scored.sparkSession, {**self._source_values(), **self.counts})

    def close(self) -> None:
        self._release()

    def __enter__(self) -> TrainResult:
        return self

    def __exit__(self, *problem: object) -> None:
        self.close()


def labelled_frame(df: DataFrame, fields: Sequence[Field], strict: bool = True) -> DataFrame:
    """Source frame whose target is a double label."""
    source = source_frame(df, fields, strict)
    target = target_of(fields)
    return source.withColumn(target, label_column(source.schema, target))


def prepared_frame(
    df: DataFrame, fields: Sequence[Field], options: TrainOptions = TrainOptions()
) -> DataFrame:
    """Labelled frame, with the split bucket of each row where one can be kept.

    A key bucket can always be computed again. A random one is drawn once, so it
    is added only to a frame that is then written as a table, and after any
    shuffle, so that a row's place in the shuffle depends on its content alone.
    """
    labelled = labelled_frame(df, fields, options.features.handle_invalid == "error")
    if options.split == "content":
        labelled = content_bucket(labelled, options.seed)
    if options.partitions is not None:
        labelled = labelled.repartition(options.partitions)
    if options.split == "content":
        return labelled
    keys = keys_of(fields)
    if options.split == "keyed" or (options.split is None and keys):
        return with_key_bucket(labelled, keys)
    return with_random_bucket(labelled, options.seed) if options.reuse == "table" else labelled


def partitions_for(rows: int, stated: int) -> int:
    """Partitions of a job of ``rows``: as many as stated, and more where those would hold over ``PARTITION_ROWS`` each."""
    return max(stated, -(-rows // PARTITION_ROWS))


def split_frame(prepared: DataFrame, options: TrainOptions = TrainOptions()) -> tuple[DataFrame, DataFrame]:
    """Train and test part of a prepared frame."""
    if BUCKET in prepared.columns:
        return bucket_split(prepared, options.train_share)
    return random_split(prepared, options.train_share, options.seed)


def fit(
    prepared: DataFrame,
    train_rows: DataFrame,
    fields: Sequence[Field],
    options: TrainOptions = TrainOptions(),
) -> PipelineModel:
    """Fit feature stages and the classifier on the train part of a prepared frame.

    Rows with missing values are left out of the training if they are to be
    skipped, and the model gives them a NULL prediction.
    """
    statistics = {"all": prepared, "train": train_rows}[options.stats_from]
    built = Pipeline(stages=feature_stages(fields, statistics, train_rows, options.features, for_trees=True)).fit(train_rows)
    if options.partitions is not None and options.reuse == "table":
        # A table is read in parts by its bytes, of which rows need more once they are vectors.
        train_rows = train_rows.repartition(options.partitions)
    parameters = {"seed": options.seed, **options.classifier}
    classifier = GBTClassifier(featuresCol=FEATURES, labelCol=target_of(fields), **parameters)
    trees = classifier.fit(complete_rows(built.transform(train_rows)))
    stages = [*built.stages, trees]
    if options.features.handle_invalid == "skip":
        kept = f"SELECT * EXCEPT (prediction, {MISSING}), IF({MISSING}, NULL, prediction) AS prediction FROM __THIS__"
        stages.append(SQLTransformer(statement=kept))
    return PipelineModel(stages)


def score(model: PipelineModel, df: DataFrame, fields: Sequence[Field]) -> DataFrame:
    """Predictions for source rows, with or without the target: keys, features, ``prediction``.

    A projection over the source; nothing is shuffled.
    """
    known = [field for field in fields if field.role != "TARGET" or field.name in df.columns]
    kept = any(isinstance(stage, CategoryModel | BucketModel) and stage.keep for stage in model.stages)
    return model.transform(source_frame(df, known, strict=not kept))


def evaluate(scored: DataFrame, fields: Sequence[Field]) -> DataFrame:
    """One-row metrics of a scored frame, computed now; only that row is moved."""
    row = classification_metrics(scored, "prediction", target_of(fields)).first()
    values = [F.lit(row[name]).cast("double").alias(name) for name in METRICS]
    return scored.sparkSession.sql("SELECT 1").select(*values)


def train(
    df: DataFrame,
    fields: Sequence[Field],
    out: str | None = None,
    options: TrainOptions = TrainOptions(),
) -> TrainResult:
    """Train on one part of ``df``, score the other, measure and save under ``out`` if given.

    Tree growing keeps its lineage short through the shared checkpoint folder.
    Model and metrics, and the scored rows if they are kept, are published as one run
    when all of them are written; see ``latest_run``. Close the result when it is no
    longer needed.
    """
    spark = df.sparkSession
    shared_dir(spark)
    used = [name for name in df.columns if name in used_columns(fields)]
    df = df.select(*[F.col(quote(name)) for name in used])
    values = source_counts(df.schema, used, features_of(fields, "DATE"))
    seen = Observation()
    observed = options.reuse == "table" and bool(values)
    source = df.observe(seen, *values) if observed else df
    written: list[DataFrame] = []
    kept: list[DataFrame] = []

    def source_values() -> Mapping[str, int]:
        return seen.get if observed else df.agg(*values).first().asDict()

    def release() -> None:
        while kept:
            kept.pop().unpersist()
        while written:
            drop_table(written.pop())

    try:
        if options.partitions is not None:
            if options.reuse == "table":
                # The source is read once: its rows are counted where they are written, unless it is not as declared.
                labelled_frame(df, fields)
                source = shared_table(source)
                written.append(source)
            options = replace(options, partitions=partitions_for(source.count(), options.partitions))
        prepared = drawn = prepared_frame(source, fields, options)
        if options.split == "content":
            written.append(drawn)  # its counted rows
        if options.reuse == "table":
            prepared = shared_table(drawn)
            if options.partitions is not None:
                drop_table(written.pop(0))
            written.append(prepared)
        elif options.reuse == "persist":
            prepared = prepared.persist(StorageLevel.MEMORY_AND_DISK)
            kept.append(prepared)
        train_rows, test_rows = split_frame(prepared, options)
        model = fit(prepared, train_rows, fields, options)
        written += [stage.ranks for stage in model.stages if isinstance(stage, CategoryModel)]
        result = TrainResult(model, model.transform(test_rows), fields, release, source_values)
        if out is not None:
            result.run = new_run(out)
            save_model(model, model_path(result.run))
            if options.keep_scored:
                result.save_scored(scored_path(result.run))
            save_metrics(result.metrics, metrics_path(result.run))
            publish_run(spark, out, result.run)
    except BaseException:
        release()
        raise
    return result


def run_job(
    spark: SparkSession,
    source: JdbcTable,
    dictionary: str,
    out: str,
    options: TrainOptions = TrainOptions(reuse="table"),
) -> TrainResult:
    """The whole job: JDBC table and dictionary file in, model and metrics out.

    The table is read once into the shared folder: a live table may change
    between reads, and the database should not serve every pass.
    """
    fields = load_fields(read_dictionary(spark, dictionary))
    return train(read_jdbc(spark, source), fields, out, options)
