"""The data dictionary: which columns exist, their types, and what each is for.

A dictionary is JSON ``{"name": ..., "attrs": [{"name", "dataType",
"valueType", "usageType"}, ...]}``. It has one row per table column, so it is
read, checked and classified as a DataFrame and then collected once.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The words a dictionary may use ("continious" is the accepted spelling).
VOCABULARY = {
    "dataType": ["string", "boolean", "integer", "double", "date-time", "currency"],
    "valueType": ["continious", "nominal", "flag", "text"],
    "usageType": ["feature", "targetField", "keyField", "skip"],
}

_MEMBERS = ("name", "dataType", "valueType", "usageType")
ATTR_SCHEMA = T.StructType([T.StructField(member, T.StringType()) for member in _MEMBERS])
FILE_SCHEMA = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("attrs", T.ArrayType(ATTR_SCHEMA)),
    ]
)


@dataclass(frozen=True)
class Field:
    """One dictionary row with its role: SKIP, TARGET, DATE, DOUBLE, NOMINAL or TEXT."""

    pos: int
    name: str
    data_type: str
    value_type: str
    usage_type: str
    role: str


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """``(pos, name, dataType, valueType, usageType)`` of a dictionary file, in file order."""
    document = spark.read.schema(FILE_SCHEMA).option("mode", "FAILFAST").json(path, multiLine=True)
    return _flat(document.select("attrs"))


def dictionary_frame(spark: SparkSession, attrs: Iterable[Mapping[str, str]]) -> DataFrame:
    """The same frame from rows held in the program."""
    text = F.lit(json.dumps({"attrs": [dict(attr) for attr in attrs]}))
    document = spark.sql("SELECT 1").select(F.from_json(text, FILE_SCHEMA).alias("document"))
    return _flat(document.select("document.attrs"))


def _flat(document: DataFrame) -> DataFrame:
    return document.select(F.posexplode("attrs").alias("pos", "attr")).select("pos", "attr.*")


def with_roles(attrs: DataFrame) -> DataFrame:
    """Add ``role``; NULL where the row has no valid role."""
    usage, data, value = F.col("usageType"), F.col("dataType"), F.col("valueType")
    text_role = F.when(value == "nominal", "NOMINAL").when(value == "text", "TEXT")
    feature_role = (
        F.when(data == "date-time", "DATE")
        .when(data == "double", "DOUBLE")
        .when(data == "string", text_role)
    )
    role = (
        F.when(usage == "targetField", "TARGET")
        .when(usage.isin("keyField", "skip"), "SKIP")
        .when(usage == "feature", feature_role)
    )
    return attrs.withColumn("role", role)


def with_problems(roles: DataFrame) -> DataFrame:
    """Add ``problems``: what is wrong with the row, or an empty array."""
    missing = [F.when(F.col(m).isNull(), F.lit(f"{m} is missing")) for m in _MEMBERS]
    unknown = [
        F.when(~F.col(m).isin(words), F.concat(F.lit(f"unknown {m} "), F.col(m)))
        for m, words in VOCABULARY.items()
    ]
    no_role = F.when(
        F.col("role").isNull() & (F.col("usageType") == "feature"),
        F.concat(F.lit("no feature can be built from "), F.concat_ws(" / ", "dataType", "valueType")),
    )
    return roles.withColumn("problems", F.array_compact(F.array(*missing, *unknown, no_role)))


def load_fields(attrs: DataFrame) -> list[Field]:
    """Classified fields in declared order; ``ValueError`` lists every bad row."""
    rows = sorted(with_problems(with_roles(attrs)).collect(), key=lambda row: row.pos)
    complaints = [f"{row.name or f'field {row.pos}'}: {', '.join(row.problems)}" for row in rows if row.problems]
    names = [row.name for row in rows]
    complaints += sorted({f"{name}: declared twice" for name in names if name and names.count(name) > 1})
    targets = [row.name for row in rows if row.usageType == "targetField"]
    if len(targets) != 1:
        complaints.append(f"exactly one targetField is needed, found {len(targets)}")
    if complaints:
        raise ValueError("bad data dictionary: " + "; ".join(complaints))
    return [
        Field(row.pos, row.name, row.dataType, row.valueType, row.usageType, row.role) for row in rows
    ]


# Which physical types can serve each role, after decimals became doubles.
_ROLE_TYPES = {
    "DOUBLE": (T.DoubleType,),
    "DATE": (T.TimestampType, T.TimestampNTZType, T.DateType),
    "NOMINAL": (T.StringType,),
    "TARGET": (T.BooleanType, T.NumericType),
}


def check_schema(fields: Sequence[Field], schema: T.StructType) -> None:
    """``ValueError`` listing every used field that the table lacks or types differently."""
    complaints = []
    for field in fields:
        used = field.role in _ROLE_TYPES or field.usage_type == "keyField"
        if not used:
            continue
        if field.name not in schema.fieldNames():
            complaints.append(f"{field.name}: not in the table")
            continue
        actual = schema[field.name].dataType
        wanted = _ROLE_TYPES.get(field.role)
        if wanted is not None and not isinstance(actual, wanted):
            complaints.append(f"{field.name}: {actual.simpleString()} cannot serve as {field.role}")
    if complaints:
        raise ValueError("dictionary and table differ: " + "; ".join(complaints))


def target_of(fields: Sequence[Field]) -> str:
    """Name of the target field."""
    return next(field.name for field in fields if field.role == "TARGET")


def keys_of(fields: Sequence[Field]) -> list[str]:
    """Names of the key fields, in declared order."""
    return [field.name for field in fields if field.usage_type == "keyField"]


def features_of(fields: Sequence[Field], *roles: str) -> list[str]:
    """Names of the fields with one of the roles, in declared order."""
    return [field.name for field in fields if field.role in roles]
