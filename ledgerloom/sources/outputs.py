"""Model and metrics output, published together.

Each run writes to a folder of its own. A marker, written last, names the run:
one file, which Spark's own commit puts in place by a rename. So a reader sees
the model and the metrics of one finished run, whatever becomes of the next.
"""

from __future__ import annotations

import time
import uuid

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_MARKER = "number bigint, run string"


def model_path(out: str) -> str:
    """Where a job with output folder ``out`` keeps its model."""
    return f"{out.rstrip('/')}/model"


def metrics_path(out: str) -> str:
    """Where a job with output folder ``out`` keeps its metrics; never the model's path."""
    return f"{out.rstrip('/')}/metrics"


def scored_path(out: str) -> str:
    """Where a job with output folder ``out`` keeps its scored hold-out, if it keeps it."""
    return f"{out.rstrip('/')}/scored"


def new_run(out: str) -> str:
    """Folder for the outputs of one run of a job with output folder ``out``; no other run gets the same."""
    return f"{out.rstrip('/')}/runs/{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def _markers(spark: SparkSession, out: str) -> DataFrame | None:
    """``number, run`` of the published runs; None before the first."""
    try:
        reader = spark.read.schema(_MARKER).option("recursiveFileLookup", "true")
        return reader.json(f"{out.rstrip('/')}/published")
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def publish_run(spark: SparkSession, out: str, run: str) -> None:
    """Make ``run``, a folder of ``new_run`` whose outputs are all written, the one that readers get."""
    name = run.rstrip("/").rpartition("/")[2]
    markers = _markers(spark, out)
    last = markers.agg(F.max("number")).first()[0] if markers is not None else None
    marker = spark.range(1).select(F.lit((last or 0) + 1).cast("long").alias("number"), F.lit(name).alias("run"))
    marker.coalesce(1).write.json(f"{out.rstrip('/')}/published/{name}")


def latest_run(spark: SparkSession, out: str) -> str:
    """Folder of the run that was published last; of two published at once, the one begun last."""
    markers = _markers(spark, out)
    found = markers.orderBy(F.desc("number"), F.desc("run")).first() if markers is not None else None
    if found is None:
        raise FileNotFoundError(f"no run is published in {out}")
    return f"{out.rstrip('/')}/runs/{found['run']}"


def load_latest(spark: SparkSession, out: str) -> tuple[PipelineModel, DataFrame]:
    """Model and metrics of the run that was published last."""
    run = latest_run(spark, out)
    return load_model(model_path(run)), spark.read.json(metrics_path(run))


def save_model(model: PipelineModel, path: str) -> None:
    """Write every fitted stage at ``path``."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    """Read a model written by ``save_model``."""
    return PipelineModel.load(path)


def save_metrics(metrics: DataFrame, path: str) -> None:
    """Write the one-row metrics frame as one JSON object; NULL is written as null."""
    metrics.coalesce(1).write.mode("overwrite").option("ignoreNullFields", "false").json(path)
