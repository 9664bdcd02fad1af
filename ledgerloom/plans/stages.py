"""Pipeline stages that Spark ML lacks: buckets and categories fitted without the driver holding values."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.dates import quote
from ledgerloom.operators.categories import RankSize, category_ranks, field_size, string_index
from ledgerloom.operators.ranges import bucket_column

# Column that says which rows miss a value the features need.
MISSING = "features_missing"


class _Writer(MLWriter):
    def __init__(self, stage: _Stage) -> None:
        super().__init__()
        self._stage = stage

    def saveImpl(self, path: str) -> None:  # noqa: N802
        DefaultParamsWriter.saveMetadata(self._stage, path, self.sparkSession, {"spec": self._stage.spec()})
        self._stage.save_tables(path)


class _Reader(MLReader):
    def __init__(self, kind: type[_Stage]) -> None:
        super().__init__()
        self._kind = kind

    def load(self, path: str) -> _Stage:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        stage = self._kind.from_spec(metadata["spec"], self.sparkSession, path)
        stage._resetUid(metadata["uid"])
        return stage


class _Stage(Model, MLReadable, MLWritable):
    """A fitted stage that is saved as its ``spec`` and, if it has any, tables beside it."""

    def write(self) -> _Writer:
        return _Writer(self)

    @classmethod
    def read(cls) -> _Reader:
        return _Reader(cls)

    def spec(self) -> dict:
        raise NotImplementedError

    def save_tables(self, path: str) -> None:
        pass


class BucketModel(_Stage):
    """Adds ``<c>_bucket`` for number columns, with its number of values in the metadata.

    With ``keep`` a NULL or NaN has a bucket of its own, after the others, and
    ``<c>_known`` holds the number, or 0 where there is none.
    """

    def __init__(self, points: Mapping[str, Sequence[float]], keep: bool = False) -> None:
        super().__init__()
        self.points = {name: list(borders) for name, borders in points.items()}
        self.keep = keep

    def spec(self) -> dict:
        return {"inner": {name: borders[1:-1] for name, borders in self.points.items()}, "keep": self.keep}

    @classmethod
    def from_spec(cls, spec: dict, spark, path: str) -> BucketModel:  # noqa: ANN001
        whole = {name: [float("-inf"), *inner, float("inf")] for name, inner in spec["inner"].items()}
        return cls(whole, spec["keep"])

    def _transform(self, dataset: DataFrame) -> DataFrame:
        added = {}
        for name, borders in self.points.items():
            bucket = bucket_column(name, borders, "keep" if self.keep else "error")
            number = F.col(quote(name))
            if self.keep:
                bucket = F.coalesce(bucket, F.lit(float(len(borders) - 1)))
                known = F.nanvl(number, F.lit(None).cast("double"))
                added[f"{name}_known"] = F.coalesce(known, F.lit(0.0))
            values = [str(float(value)) for value in range(len(borders) - 1 + self.keep)]
            attribute = {"ml_attr": {"type": "nominal", "name": f"{name}_bucket", "vals": values}}
            added[f"{name}_bucket"] = bucket.alias(f"{name}_bucket", metadata=attribute)
        return dataset.withColumns(added)


class CategoryModel(_Stage):
    """Adds ``<c>_idx``, the rank of the category, for text columns; the ranks are a table.

    The metadata of a column states the number of its categories, not their
    names. A NULL or unknown category is an error, or with ``keep`` the index
    after the last.
    """

    def __init__(self, sizes: Mapping[str, RankSize], ranks: DataFrame, keep: bool = False) -> None:
        super().__init__()
        self.sizes = dict(sizes)
        self.ranks = ranks
        self.keep = keep

    @classmethod
    def fit_on(cls, df: DataFrame, columns: Sequence[str], keep: bool = False) -> CategoryModel:
        """Ranks of all columns from one pass over ``df``, a table in the shared folder."""
        ranks = category_ranks(df, columns)
        sizes = {name: field_size(ranks, name) for name in columns}
        empty = [name for name, size in sizes.items() if not size.categories]
        if empty:
            raise ValueError(f"no category in {', '.join(empty)}")
        return cls(sizes, ranks, keep)

    def values_of(self, name: str) -> int:
        """Number of different indexes of a column."""
        return self.sizes[name].categories + self.keep

    def spec(self) -> dict:
        return {"sizes": {n: [s.categories, s.bytes, s.rows] for n, s in self.sizes.items()}, "keep": self.keep}

    def save_tables(self, path: str) -> None:
        self.ranks.write.parquet(f"{path}/ranks")

    @classmethod
    def from_spec(cls, spec: dict, spark, path: str) -> CategoryModel:  # noqa: ANN001
        sizes = {name: RankSize(*numbers) for name, numbers in spec["sizes"].items()}
        return cls(sizes, spark.read.parquet(f"{path}/ranks"), spec["keep"])

    def _transform(self, dataset: DataFrame) -> DataFrame:
        for name, size in self.sizes.items():
            index = f"{name}_idx"
            own = self.ranks.where(F.col("field") == name)
            indexed = string_index(dataset, name, index, own, size=size)
            if self.keep:
                unknown = F.lit(float(size.categories))
            else:
                shown = F.coalesce(F.col(quote(name)), F.lit("NULL"))
                unknown = F.raise_error(F.concat(F.lit(f"{name}: no such category: "), shown)).cast("double")
            attribute = {"ml_attr": {"type": "nominal", "name": index, "num_vals": self.values_of(name)}}
            whole = F.coalesce(F.col(quote(index)), unknown).alias(index, metadata=attribute)
            dataset = indexed.select(*[F.col(quote(c)) for c in dataset.columns], whole)
        return dataset


class WideCategoryModel(_Stage):
    """Adds ``<c>_head`` and ``<c>_code`` for indexed columns of many categories.

    ``<c>_head`` is the index of one of the ``own`` most frequent categories, or ``own``
    for another. ``<c>_code`` is a vector that has zeros for the former, and else the
    binary digits of the index less ``own``, counted from 1. So every category is told apart
    from every other, and the width grows by one when their number doubles.
    """

    def __init__(self, values: Mapping[str, int], own: int) -> None:
        super().__init__()
        self.values = dict(values)
        self.own = own

    def spec(self) -> dict:
        return {"values": self.values, "own": self.own}

    @classmethod
    def from_spec(cls, spec: dict, spark, path: str) -> WideCategoryModel:  # noqa: ANN001
        return cls(spec["values"], spec["own"])

    def _transform(self, dataset: DataFrame) -> DataFrame:
        added = {}
        for name, values in self.values.items():
            index, head, code = F.col(quote(f"{name}_idx")), f"{name}_head", f"{name}_code"
            nominal = {"ml_attr": {"type": "nominal", "name": head, "num_vals": self.own + 1}}
            added[head] = F.least(index, F.lit(float(self.own))).alias(head, metadata=nominal)
            rest = F.greatest(index.cast("long") - (self.own - 1), F.lit(0))
            width = (values - self.own).bit_length()
            digits = [F.shiftright(rest, place).bitwiseAND(F.lit(1)).cast("double") for place in range(width)]
            binary = [{"idx": place, "name": str(place), "vals": ["0", "1"]} for place in range(width)]
            group = {"ml_attr": {"attrs": {"binary": binary}, "num_attrs": width}}
            added[code] = array_to_vector(F.array(*digits)).alias(code, metadata=group)
        return dataset.withColumns(added)


class MissingModel(_Stage):
    """Adds ``MISSING``: whether a number or date is NULL or NaN, or a category NULL or unknown."""

    def __init__(self, numbers: Sequence[str], dates: Sequence[str], categories: Mapping[str, int]) -> None:
        super().__init__()
        self.numbers, self.dates, self.categories = list(numbers), list(dates), dict(categories)

    def spec(self) -> dict:
        return {"numbers": self.numbers, "dates": self.dates, "categories": self.categories}

    @classmethod
    def from_spec(cls, spec: dict, spark, path: str) -> MissingModel:  # noqa: ANN001
        return cls(spec["numbers"], spec["dates"], spec["categories"])

    def _transform(self, dataset: DataFrame) -> DataFrame:
        missing = F.lit(False)
        for name in self.numbers:
            missing |= F.col(quote(name)).isNull() | F.isnan(F.col(quote(name)))
        for name in self.dates:
            missing |= F.col(quote(name)).isNull()
        for name, known in self.categories.items():
            missing |= F.col(quote(f"{name}_idx")) >= known
        return dataset.withColumn(MISSING, missing)
