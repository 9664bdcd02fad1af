"""Dictionary-driven feature building and classifier training on Spark.

One transaction table plus a small data dictionary in, a fitted
``PipelineModel``, scored hold-out and one-row metrics frame out.
"""

from ledgerloom.plans.training import TrainResult, run_job, score, train
from ledgerloom.session import build_session, shared_dir

__all__ = ["TrainResult", "build_session", "run_job", "score", "shared_dir", "train"]
