"""

Every query reads its whole table. Keys of ``queries()`` without an entry in
``oracle_sql()`` train a model, which SQL cannot express.
"""

from __future__ import annotations

import importlib.util
import sys
import uuid
from collections.abc import Callable
from pathlib import Path

from pyspark.ml.feature import Bucketizer, OneHotEncoder
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from ledgerloom.functions.casts import decimals_to_double, label_column, to_timestamp  # noqa: E402
from ledgerloom.functions.dates import (  # noqa: E402
    CLOCK_PARTS,
    date_part,
    date_parts,
    enrich_dates,
    zoned_date_parts,
)
from ledgerloom.operators import categories, confusion, ranges, splits  # noqa: E402
from ledgerloom.operators.vectors import vector_entries  # noqa: E402
from ledgerloom.plans import features, stages, training  # noqa: E402
from ledgerloom.session import shared_dir, shared_table  # noqa: E402
from ledgerloom.sources.dictionary import (  # noqa: E402
    Field,
    dictionary_frame,
    load_fields,
    read_dictionary,
    with_roles,
)
from ledgerloom.sources.outputs import load_latest, load_model, save_model  # noqa: E402
from ledgerloom.sources.predicates import ask_frame, gapless, plan_parts  # noqa: E402

# The operators for training data may be left out as a whole; what fails inside them is not hidden.
LLM = None
if importlib.util.find_spec("ledgerloom.llm") and importlib.util.find_spec("corpus_pipeline"):
    from ledgerloom.llm import queries as LLM  # noqa: E402, N812

    import corpus_pipeline  # noqa: E402

SMOKE_DIR = "/root/testdata/sf0.001"


def _attr(name: str, data: str, value: str, usage: str) -> dict[str, str]:
    return {"name": name, "dataType": data, "valueType": value, "usageType": usage}


ORDERS_ATTRS = [
    _attr("o_orderkey", "integer", "continious", "keyField"),
    _attr("o_custkey", "integer", "nominal", "skip"),
    _attr("o_orderstatus", "string", "text", "feature"),
    _attr("o_totalprice", "double", "continious", "feature"),
    _attr("o_orderdate", "date-time", "continious", "feature"),
    _attr("o_orderpriority", "string", "nominal", "feature"),
    _attr("big", "boolean", "flag", "targetField"),
]
EVENTS_ATTRS = [
    _attr("event_id", "integer", "continious", "keyField"),
    _attr("ts", "date-time", "continious", "feature"),
    _attr("user_id", "integer", "nominal", "skip"),
    _attr("event_type", "string", "nominal", "feature"),
    _attr("value", "double", "continious", "feature"),
    _attr("props", "string", "text", "feature"),
    _attr("high", "boolean", "flag", "targetField"),
]
LINES_ATTRS = [
    _attr("line", "integer", "continious", "keyField"),
    _attr("quantity", "double", "continious", "feature"),
    _attr("part", "string", "nominal", "feature"),
    _attr("many", "boolean", "flag", "targetField"),
]
LINEITEM_DOUBLES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]

# So many partitions on any cluster, as trees depend on them.
TRAINING = training.TrainOptions(partitions=8)

# Parts that the rows of a table are to be read in.
JDBC_PARTS = 8
# The largest whole number whose cube has 64 bits.
LAST_CUBED = 2_097_151

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the boolean target ``big``."""
    big = (F.col("o_totalprice") > 200000) & (F.col("o_orderpriority") != "5-LOW")
    return _table(spark, sf_dir, "orders").withColumn("big", big)


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the boolean target ``high``."""
    return _table(spark, sf_dir, "events").withColumn("high", F.col("value") > 50)


def _orders_fields(spark: SparkSession) -> list[Field]:
    return load_fields(dictionary_frame(spark, ORDERS_ATTRS))


def _without(fields: list[Field], *roles: str) -> list[Field]:
    return [field for field in fields if field.role not in roles]


# --- casts and dates ---------------------------------------------------------


def decimal_to_double(spark: SparkSession, sf_dir: str) -> DataFrame:
    amounts = _table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_totalprice").cast("decimal(12,2)").alias("amt")
    )
    return decimals_to_double(amounts)


def label_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders").select(
        "o_orderkey", (F.col("o_totalprice") > 200000).alias("label")
    )
    return orders.withColumn("label", label_column(orders.schema, "label"))


def string_to_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = _table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("string").alias("t"))
    shown = F.date_format(to_timestamp("t"), "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return texts.select("event_id", F.year(to_timestamp("t")).alias("y"), shown.alias("shown"))


def date_parts_basic(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(spark, sf_dir, "events").select("event_id", "ts")
    return date_parts(events, "ts", CLOCK_PARTS).drop("ts")


def date_parts_extended(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(spark, sf_dir, "events").select("event_id", "ts")
    return date_parts(events, "ts", ("weekDay", "yearDay", "minuteFromDayBeginning")).drop("ts")


def date_parts_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(spark, sf_dir, "events").select("event_id", "ts")
    stamp = F.date_format("ts_timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return enrich_dates(events, "ts").withColumn("ts_timestamp", stamp).drop("ts")


def date_parts_zoned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of a year by the clock of New York, which is set forward and back in it."""
    shifted = "timestampadd(DAY, event_id % 12 * 30, CAST(ts AS TIMESTAMP_NTZ))"
    instant = f"timestamp_micros(timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', {shifted})) AS ts"
    events = zoned_date_parts(_table(spark, sf_dir, "events").selectExpr("event_id", instant), "ts", "America/New_York")
    return events.drop("ts").withColumn("ts_local", F.date_format("ts_local", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


def _order_date(part: str, alias: str, **options: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        orders = _table(spark, sf_dir, "orders")
        return orders.select("o_orderkey", date_part("o_orderdate", part, **options).alias(alias))

    return query


def quarter_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "orders").select(
        "o_orderkey",
        date_part("o_orderdate", "quarter", quarter="calendar").alias("q"),
        date_part("o_orderdate", "quarter").alias("lq"),
    )


# --- dictionary and splits ---------------------------------------------------


def field_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Role of every field, and how many values the table holds for it."""
    roles = with_roles(dictionary_frame(spark, ORDERS_ATTRS))
    names = [attr["name"] for attr in ORDERS_ATTRS]
    values = (
        _orders(spark, sf_dir)
        .agg(*[F.count(name).alias(name) for name in names])
        .unpivot([], names, "name", "n_values")
    )
    return roles.join(values, "name").select("pos", "name", "role", "n_values")


def split_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders")
    return orders.select("o_orderkey", splits.split_label(["o_orderkey"]).alias("split"))


def split_random_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows in both parts together, and keys that are in both: all, and none."""
    train, test = splits.random_split(_table(spark, sf_dir, "orders").select("o_orderkey"))
    parts = train.withColumn("part", F.lit(0)).unionByName(test.withColumn("part", F.lit(1)))
    per_key = parts.groupBy("o_orderkey").agg(
        F.count("*").alias("n"), (F.min("part") != F.max("part")).alias("both")
    )
    return per_key.agg(F.sum("n").alias("n_total"), F.count_if("both").alias("n_overlap"))


# --- ranges, buckets, categories ---------------------------------------------


def split_random_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with few different rows, of which each is drawn; how many of each go to either part."""
    few = _table(spark, sf_dir, "events").select("event_type", (F.col("user_id") % 20).alias("u"))
    rows = splits.content_bucket(few, 42)
    label = F.when(F.col(splits.BUCKET) < 80, "train").otherwise("test").alias("split")
    return rows.groupBy("event_type", "u", label).agg(F.count("*").alias("n"))


def split_by_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by the part that their line items go to, a tenth of which are of one order."""
    lines = _table(spark, sf_dir, "lineitem")
    lines = lines.withColumn("l_orderkey", F.when(F.col("l_quantity") > 5, F.col("l_orderkey")).otherwise(77))
    train, test = splits.row_share_split(lines, ["l_orderkey"])
    both = train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))
    return both.groupBy("l_orderkey", "split").agg(F.count("*").alias("n"))


def jdbc_predicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items by the condition that would read them, with a key of uneven gaps, a hot value and NULLs.

    The key is a cube. Beyond ``LAST_CUBED``, where a cube does not fit in 64 bits and SQL
    gives none, keys go on from the last cube without gaps, so each order keeps its own.
    """
    beyond = f"{LAST_CUBED**3} + (l_orderkey - {LAST_CUBED})"
    uneven = f"CASE WHEN l_orderkey > {LAST_CUBED} THEN {beyond} ELSE l_orderkey * l_orderkey * l_orderkey END"
    lines = _table(spark, sf_dir, "lineitem").selectExpr(
        f"CASE WHEN l_quantity <= 15 THEN 7 WHEN l_quantity < 50 THEN {uneven} END AS k",
        "l_partkey AS other",
    )
    parts = plan_parts(ask_frame(lines), "k", JDBC_PARTS, spread=True)
    conditions = [F.expr(text) for text in gapless(parts, "k", "other")]
    met = F.array_compact(F.array(*[F.when(own, F.lit(place)) for place, own in enumerate(conditions)]))
    rows = lines.select(F.explode(met).alias("part")).groupBy("part").agg(F.count("*").alias("n"))
    planned = [(place, part.low, part.high, part.slice) for place, part in enumerate(parts)]
    # One row for each part.
    facts = F.broadcast(spark.createDataFrame(planned, "part int, low bigint, high bigint, slice int"))
    return rows.join(facts, "part").select("part", "low", "high", "slice", "n")


def numeric_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranges.numeric_ranges(_table(spark, sf_dir, "orders"), ["o_totalprice"]).drop("field")


def numeric_range_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranges.numeric_ranges(_table(spark, sf_dir, "lineitem"), LINEITEM_DOUBLES)


def bucketize(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(spark, sf_dir, "events").select("event_id", "value")
    return ranges.bucketize(events, ["value"]).select("event_id", "value_bucket")


def bucketize_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(spark, sf_dir, "events").select("event_id", "value")
    points = ranges.fit_split_points(events, ["value"])
    stage = Bucketizer(inputCol="value", outputCol="value_bucket", splits=points["value"])
    return stage.transform(events).select("event_id", "value_bucket")


def category_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = categories.category_frequency(_table(spark, sf_dir, "orders"), "o_orderpriority")
    return ranks.withColumnRenamed("value", "o_orderpriority")


def _line_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with their part as text: a column of many categories."""
    part = F.col("l_partkey").cast("string").alias("part")
    return _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", part)


def category_frequency_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = categories.category_frequency(_line_parts(spark, sf_dir), "part")
    return ranks.withColumnRenamed("value", "part")


def _priorities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")


def string_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return categories.string_index(_priorities(spark, sf_dir), "o_orderpriority", "idx")


def string_index_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The join for rank tables that are too large to broadcast."""
    return categories.string_index(_line_parts(spark, sf_dir), "part", "idx", broadcast_bytes=0)


def string_index_skewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Few categories, each of many rows and of a long text, by the join for large rank tables."""
    flag = F.repeat("l_returnflag", F.lit(5000)).alias("flag")
    lines = _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", flag)
    return categories.string_index(lines, "flag", "idx", broadcast_bytes=0).drop("flag")


def one_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _priorities(spark, sf_dir)
    ranks = categories.category_frequency(orders, "o_orderpriority")
    size = categories.rank_size(ranks)
    indexed = categories.string_index(orders, "o_orderpriority", "idx", ranks, size=size)
    return categories.one_hot_entries(indexed, "o_orderkey", "idx", size.categories)


def _encoded_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    indexer = stages.CategoryModel.fit_on(orders, ["o_orderpriority"])
    indexed = indexer.transform(orders).withColumnRenamed("o_orderpriority_idx", "idx")
    return OneHotEncoder(inputCol="idx", outputCol="vec").fit(indexed).transform(indexed)


def string_index_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _encoded_orders(spark, sf_dir).drop("vec")


def one_hot_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_entries(_encoded_orders(spark, sf_dir), "o_orderkey", "vec")


# --- feature vectors ---------------------------------------------------------


def assemble_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = _without(_orders_fields(spark), "DATE")
    frame = features.feature_frame(_orders(spark, sf_dir), fields)
    return vector_entries(frame, "o_orderkey", features.FEATURES)


def feature_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = features.feature_frame(_orders(spark, sf_dir), _orders_fields(spark))
    return vector_entries(frame, "o_orderkey", features.FEATURES)


def feature_frame_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of which every seventh has no price, kept."""
    price = F.when(F.col("o_orderkey") % 7 != 0, F.col("o_totalprice"))
    orders = _orders(spark, sf_dir).withColumn("o_totalprice", price)
    options = features.FeatureOptions(handle_invalid="keep")
    frame = features.feature_frame(orders, _without(_orders_fields(spark), "DATE"), options)
    return vector_entries(frame, "o_orderkey", features.FEATURES)


def feature_frame_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with their part, of which there are many, as a category."""
    lines = _table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("line"),
        F.col("l_quantity").cast("double").alias("quantity"),
        F.col("l_partkey").cast("string").alias("part"),
        (F.col("l_quantity") > 25).alias("many"),
    )
    frame = features.feature_frame(lines, load_fields(dictionary_frame(spark, LINES_ATTRS)))
    return vector_entries(frame, "line", features.FEATURES)


def feature_frame_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events, whose dictionary order is date, category, number, with all nine date parts."""
    fields = load_fields(dictionary_frame(spark, EVENTS_ATTRS))
    options = features.FeatureOptions(date_parts="calendar")
    frame = features.feature_frame(_events(spark, sf_dir), fields, options)
    return vector_entries(frame, "event_id", features.FEATURES)


# --- metrics -----------------------------------------------------------------


def _rule_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders scored by a fixed rule, so that the metrics have one right value."""
    rule = (F.col("o_totalprice") > 250000).cast("double")
    return _orders(spark, sf_dir).withColumn("prediction", rule)


def prediction_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    target: Column = (F.col("o_totalprice") > 200000).cast("int")
    scored = _rule_scored(spark, sf_dir).withColumn("target", target)
    return confusion.prediction_target(scored, "prediction", "target")


def confusion_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return confusion.confusion_counts(_rule_scored(spark, sf_dir), "prediction", "big")


def classification_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return confusion.classification_metrics(_rule_scored(spark, sf_dir), "prediction", "big")


# --- training ----------------------------------------------------------------


def hold_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that training never sees, with their label."""
    prepared = training.prepared_frame(_orders(spark, sf_dir), _orders_fields(spark))
    _, test_rows = training.split_frame(prepared)
    return test_rows.select("o_orderkey", F.col("big").alias("label"))


def _ruled_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders whose target is a rule over a bucket border and a category.

    The features tell the two classes apart exactly, so trees learn the rule
    however the rows are partitioned, and SQL can state every prediction.
    """
    orders = _table(spark, sf_dir, "orders")
    middle = ranges.fit_split_points(orders, ["o_totalprice"])["o_totalprice"][3]
    rule = (F.col("o_totalprice") >= middle) & F.col("o_orderpriority").isin("1-URGENT", "5-LOW")
    return orders.withColumn("big", rule)


def _kept(result: training.TrainResult, *columns: Column) -> DataFrame:
    """Columns of the scored rows, written so that the job can be closed."""
    with result:
        return shared_table(result.scored.select(*columns))


def gbt_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions for the ruled target from price and priority."""
    fields = _without(_orders_fields(spark), "DATE")
    result = training.train(_ruled_orders(spark, sf_dir), fields, options=TRAINING)
    return _kept(result, F.col("o_orderkey"), F.col("big").alias("label"), F.col("prediction"))


def gbt_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with the date, of which the rule knows nothing, among the features."""
    result = training.train(_ruled_orders(spark, sf_dir), _orders_fields(spark), options=TRAINING)
    return _kept(result, F.col("o_orderkey"), F.col("big").cast("int").alias("target"), F.col("prediction"))


def gbt_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = _without(_orders_fields(spark), "DATE")
    with training.train(_ruled_orders(spark, sf_dir), fields, options=TRAINING) as result:
        return result.metrics


def score_and_measure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts taken while the scored rows are written, beside the same from the written rows."""
    fields = _without(_orders_fields(spark), "DATE")
    with training.train(_ruled_orders(spark, sf_dir), fields, options=TRAINING) as result:
        path = f"{shared_dir(spark)}/scored-{uuid.uuid4()}"
        rows = result.save_scored(path, ["o_orderkey", "big", "prediction"])
        observed = [F.lit(result.counts[name]).cast("long").alias(name) for name in ("tp", "fp", "tn", "fn", "n")]
    written = rows.agg(F.count("*").alias("rows"), F.sum("prediction").cast("long").alias("positive"))
    return written.select("rows", "positive", *observed)


def bad_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values of odd orders that no feature can be built from, counted while the job reads and scores them."""
    key = F.col("o_orderkey")
    price = F.when(key % 11 == 0, F.lit(float("nan"))).when(key % 11 != 1, F.col("o_totalprice"))
    date = F.when(key % 13 == 0, "no date").when(key % 13 != 1, F.col("o_orderdate").cast("string"))
    rare = F.when(key % 500 == 7, F.concat(F.lit("rare "), key.cast("string"))).otherwise(F.col("o_orderpriority"))
    odd = _orders(spark, sf_dir).withColumns({"o_totalprice": price, "o_orderdate": date, "o_orderpriority": rare})
    options = training.TrainOptions(
        partitions=8, reuse="table", features=features.FeatureOptions(handle_invalid="keep"), classifier={"maxIter": 2, "maxDepth": 2}
    )
    with training.train(odd, _orders_fields(spark), options=options) as result:
        return result.bad_values


def model_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hold-out rows, and how many the saved and reloaded model scores differently."""
    result = training.train(_orders(spark, sf_dir), _orders_fields(spark), options=TRAINING)
    path = f"{shared_dir(spark)}/model-{uuid.uuid4()}"
    save_model(result.model, path)
    inputs = features.source_frame(_orders(spark, sf_dir), _orders_fields(spark)).columns
    before = result.scored.select(*inputs, F.col("prediction").alias("before"))
    after = load_model(path).transform(before)
    counts = after.agg(
        F.count("*").alias("n"),
        F.count_if(~F.col("before").eqNullSafe(F.col("prediction"))).alias("n_mismatch"),
    )
    with result:
        return shared_table(counts)


def job_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a job leaves behind: a dictionary file in, metrics and model out, both read back."""
    folder = f"{shared_dir(spark)}/job-{uuid.uuid4()}"
    attrs = [attr for attr in ORDERS_ATTRS if attr["dataType"] != "date-time"]
    members = "struct<name:string,dataType:string,valueType:string,usageType:string>"
    document = spark.createDataFrame([("orders", attrs)], f"name string, attrs array<{members}>")
    document.coalesce(1).write.json(f"{folder}/dictionary")
    fields = load_fields(read_dictionary(spark, f"{folder}/dictionary"))
    orders = _ruled_orders(spark, sf_dir)
    training.train(orders, fields, folder, TRAINING).close()
    model, saved = load_latest(spark, folder)
    _, test_rows = training.split_frame(training.prepared_frame(orders, fields))
    scored = model.transform(test_rows)
    wrong = F.count_if(~F.col("prediction").eqNullSafe(F.col("big")))
    # One row each.
    return scored.agg(F.count("*").alias("n"), wrong.alias("n_wrong")).join(F.broadcast(saved.select("accuracy", "f1Score")))


def entry(spark: SparkSession) -> DataFrame:
    """Train on the small orders table: metrics of the hold-out."""
    return gbt_metrics(spark, SMOKE_DIR)


def _llm_queries() -> dict[str, Query]:
    return LLM.queries() | {"pipeline": corpus_pipeline.run} if LLM else {}


def _llm_oracles() -> dict[str, str]:
    if not LLM:
        return {}
    pipeline = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return LLM.oracle_sql() | pipeline


def queries() -> dict[str, Query]:
    """One callable per operator; each reads its whole table under ``sf_dir``."""
    return {
        "decimal_to_double": decimal_to_double,
        "label_cast": label_cast,
        "string_to_timestamp": string_to_timestamp,
        "date_parts_basic": date_parts_basic,
        "date_parts_extended": date_parts_extended,
        "date_parts_all": date_parts_all,
        "date_parts_zoned": date_parts_zoned,
        "quarter_variants": quarter_variants,
        "week_number_iso": _order_date("weekNumber", "w", week_system="iso"),
        "week_number_us": _order_date("weekNumber", "w", week_system="us"),
        "field_roles": field_roles,
        "split_keyed": split_keyed,
        "split_random_check": split_random_check,
        "split_random_rows": split_random_rows,
        "split_by_rows": split_by_rows,
        "jdbc_predicates": jdbc_predicates,
        "numeric_range": numeric_range,
        "numeric_range_all": numeric_range_all,
        "bucketize": bucketize,
        "bucketize_stage": bucketize_stage,
        "category_frequency": category_frequency,
        "category_frequency_wide": category_frequency_wide,
        "string_index": string_index,
        "string_index_shuffled": string_index_shuffled,
        "string_index_skewed": string_index_skewed,
        "string_index_stage": string_index_stage,
        "one_hot": one_hot,
        "one_hot_stage": one_hot_stage,
        "assemble_features": assemble_features,
        "feature_frame": feature_frame,
        "feature_frame_calendar": feature_frame_calendar,
        "feature_frame_missing": feature_frame_missing,
        "feature_frame_wide": feature_frame_wide,
        "prediction_target": prediction_target,
        "confusion_counts": confusion_counts,
        "classification_metrics": classification_metrics,
        "hold_out": hold_out,
        "gbt_rule": gbt_rule,
        "gbt_predictions": gbt_predictions,
        "gbt_metrics": gbt_metrics,
        "score_and_measure": score_and_measure,
        "bad_values": bad_values,
        "model_roundtrip": model_roundtrip,
        "job_outputs": job_outputs,
        **_llm_queries(),
    }


# --- SQL ---------------------------------------------------------------------

_IS_BIG = "o_totalprice > 200000 AND o_orderpriority <> '5-LOW'"
_KEY_BUCKET = "CAST('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8) AS BIGINT) % 100"
_ORDER_RANKS = """
    SELECT o_orderpriority, count(*) AS n,
           row_number() OVER (ORDER BY count(*) DESC, o_orderpriority) - 1 AS idx
    FROM orders GROUP BY o_orderpriority
"""
_PART_RANKS = """
    SELECT CAST(l_partkey AS VARCHAR) AS part, count(*) AS n,
           row_number() OVER (ORDER BY count(*) DESC, CAST(l_partkey AS VARCHAR)) - 1 AS idx
    FROM lineitem GROUP BY 1
"""
_CLOCK = ["year", "month", "day", "hour", "minute"]
_CALENDAR = {
    "year": "year({c})",
    "quarter": "floor(month({c}) / 4.0) + 1",
    "month": "month({c})",
    "weekNumber": "weekofyear({c})",
    "weekDay": "isodow({c})",
    "yearDay": "dayofyear({c})",
    "hour": "hour({c})",
    "minute": "minute({c})",
    "minuteFromDayBeginning": "hour({c}) * 60 + minute({c})",
}


def _calendar_sql(column: str, cast: str, prefix: str) -> str:
    return ", ".join(
        f"CAST({text.format(c=column)} AS {cast}) AS {prefix}{part}" for part, text in _CALENDAR.items()
    )


def _bucket_sql(table: str, key: str, value: str) -> str:
    return f"""
    SELECT {key}, {value} AS v, CAST(CASE WHEN {value} < mn THEN 0 WHEN {value} < mn + st THEN 1
           WHEN {value} < mn + 2 * st THEN 2 WHEN {value} < mn + 3 * st THEN 3
           WHEN {value} < mx THEN 4 ELSE 5 END AS DOUBLE) AS bucket
    FROM {table}, (SELECT min({value}) AS mn, max({value}) AS mx,
                          (max({value}) - min({value})) / 4 AS st FROM {table})
    """


def _one_hot_sql(table: str, key: str, column: str, first: int) -> str:
    """The 1.0 of each row's one-hot vector, whose positions start at ``first``."""
    return f"""
    SELECT {key}, CAST(idx + {first} AS INTEGER) AS pos, CAST(1 AS DOUBLE) AS value
    FROM {table} JOIN (
        SELECT {column} AS v, row_number() OVER (ORDER BY count(*) DESC, {column}) - 1 AS idx
        FROM {table} GROUP BY {column}) ON v = {column}
    WHERE idx < (SELECT count(DISTINCT {column}) FROM {table}) - 1
    """


def _vector_sql(key: str, entries: str, table: str, column: str, others: int) -> str:
    """Entries that are not zero, with the size: ``others`` positions and a one-hot of ``column``."""
    return f"""
    SELECT {key}, CAST((SELECT count(DISTINCT {column}) FROM {table}) - 1 + {others} AS INTEGER) AS size,
           pos, value
    FROM ({entries}) WHERE value <> 0
    """


def _value_sql(table: str, key: str, parts: list[tuple[int, str]]) -> str:
    """Long rows for single values: ``(position, SQL)`` pairs."""
    return " UNION ALL ".join(
        f"SELECT {key}, CAST({pos} AS INTEGER) AS pos, CAST({text} AS DOUBLE) AS value FROM {table}"
        for pos, text in parts
    )


def _number_sql(table: str, key: str, value: str, first: int) -> str:
    """Long rows for the bucket and the raw value of a number."""
    both = _value_sql("b", key, [(first, "bucket"), (first + 1, "v")])
    return f"SELECT * FROM (WITH b AS ({_bucket_sql(table, key, value)}) {both})"


_RULE_COUNTS = f"""
    SELECT count(CASE WHEN label = 1 AND p = 1 THEN 1 END) AS tp,
           count(CASE WHEN label = 0 AND p = 1 THEN 1 END) AS fp,
           count(CASE WHEN label = 0 AND p = 0 THEN 1 END) AS tn,
           count(CASE WHEN label = 1 AND p = 0 THEN 1 END) AS fn,
           count(*) AS n
    FROM (SELECT CAST({_IS_BIG} AS INTEGER) AS label, CAST(o_totalprice > 250000 AS INTEGER) AS p FROM orders)
"""


def _roles_sql() -> str:
    rows = ", ".join(
        f"({pos}, '{a['name']}', '{a['dataType']}', '{a['valueType']}', '{a['usageType']}')"
        for pos, a in enumerate(ORDERS_ATTRS)
    )
    counts = " UNION ALL ".join(
        f"SELECT '{a['name']}' AS field, count({a['name']}) AS n_values FROM o" for a in ORDERS_ATTRS
    )
    return f"""
    WITH o AS (SELECT *, {_IS_BIG} AS big FROM orders),
         d(pos, name, dt, vt, ut) AS (VALUES {rows}),
         c AS ({counts})
    SELECT CAST(pos AS INTEGER) AS pos, name,
           CASE WHEN ut = 'targetField' THEN 'TARGET' WHEN ut IN ('keyField', 'skip') THEN 'SKIP'
                WHEN dt = 'date-time' THEN 'DATE' WHEN dt = 'double' THEN 'DOUBLE'
                WHEN vt = 'nominal' THEN 'NOMINAL' WHEN vt = 'text' THEN 'TEXT' END AS role,
           n_values
    FROM d JOIN c ON field = name
    """


def _jdbc_sql(parts: int, levels: int = 16) -> str:
    """The parts that ``jdbc_predicates`` plans: cells that hold too many rows are cut, level by level."""
    found = [
        """WITH l AS (SELECT CASE WHEN l_quantity <= 15 THEN 7 WHEN l_quantity < 50 THEN l_orderkey * l_orderkey * l_orderkey END AS k,
                             l_partkey AS other FROM lineitem),""",
        f"""b AS (SELECT count(*) AS total, min(k) AS lo, max(k) AS hi, (max(k) - min(k) + {parts * 64}) // {parts * 64} AS w FROM l),""",
        "h0 AS (SELECT lo AS low, hi + 1 AS high, w, total FROM b),",
    ]
    for level in range(1, levels + 1):
        found.append(
            f"""c{level} AS MATERIALIZED (
                SELECT k - (k - low) % w AS low, least(k - (k - low) % w + any_value(w), any_value(high)) AS high,
                       greatest(1, (any_value(w) + 63) // 64) AS w, any_value(total) AS total, count(*) AS n
                FROM l JOIN h{level - 1} ON k >= low AND k < high GROUP BY k - (k - low) % w),
            h{level} AS (SELECT low, high, w, total FROM c{level} WHERE n * {parts * 4} > total AND high - low > 1),"""
        )
    light = " UNION ALL ".join(
        f"SELECT low, high, n, total FROM c{level} WHERE NOT (n * {parts * 4} > total AND high - low > 1)" for level in range(1, levels + 1)
    )
    return "".join(found) + f"""
        s AS (SELECT *, n * {parts} > total AS alone FROM ({light})),
        o AS (SELECT *, coalesce(sum(CASE WHEN alone THEN 0 ELSE n END) OVER before, 0) * {parts} // total AS run,
                     coalesce(sum(CASE WHEN alone THEN 1 ELSE 0 END) OVER before, 0) AS breaks
              FROM s WINDOW before AS (ORDER BY low ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
        p AS (SELECT min(low) AS low, max(high) AS high, sum(n) AS n, alone, any_value(total) AS total
              FROM o GROUP BY alone, breaks, CASE WHEN alone THEN low ELSE run END),
        q AS (SELECT low, CASE WHEN alone THEN high ELSE coalesce(lead(low) OVER (ORDER BY low), high) END AS high, n,
                     CASE WHEN alone THEN (n * {parts} + total - 1) // total ELSE 1 END AS slices FROM p
              UNION ALL SELECT NULL, NULL, count(*), greatest(1, (count(*) * {parts} + any_value(total) - 1) // any_value(total))
              FROM l, b WHERE k IS NULL HAVING count(*) > 0),
        e AS (SELECT low, high, n, slices, unnest(range(CAST(slices AS BIGINT))) AS slice FROM q)
        SELECT CAST(row_number() OVER (ORDER BY low NULLS LAST, slice) - 1 AS INTEGER) AS part, CAST(low AS BIGINT) AS low,
               CAST(high AS BIGINT) AS high, CAST(slice AS INTEGER) AS slice,
               CASE WHEN slices = 1 THEN CAST(n AS BIGINT)
                    ELSE (SELECT count(*) FROM l WHERE l.k IS NOT DISTINCT FROM e.low AND l.other % e.slices = e.slice) END AS n
        FROM e"""


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL for every query that does not only train a model."""
    indexed_orders = f"""
        SELECT o_orderkey, o.o_orderpriority, CAST(idx AS DOUBLE) AS idx
        FROM orders o JOIN ({_ORDER_RANKS}) r ON r.o_orderpriority = o.o_orderpriority"""
    bucketized = f"SELECT event_id, bucket AS value_bucket FROM ({_bucket_sql('events', 'event_id', 'value')})"
    one_hot_orders = f"""
        SELECT o_orderkey, CAST(k - 1 AS INTEGER) AS size, CAST(nullif(idx, k - 1) AS INTEGER) AS pos,
               CASE WHEN idx < k - 1 THEN CAST(1 AS DOUBLE) END AS value
        FROM ({indexed_orders}), (SELECT count(DISTINCT o_orderpriority) AS k FROM orders)"""
    price = _number_sql("orders", "o_orderkey", "o_totalprice", 0)
    order_clock = _value_sql(
        "orders", "o_orderkey", [(2 + i, f"{part}(o_orderdate)") for i, part in enumerate(_CLOCK)]
    )
    event_calendar = _value_sql(
        "events", "event_id", [(i, text.format(c="ts")) for i, text in enumerate(_CALENDAR.values())]
    )
    event_kinds = "(SELECT count(DISTINCT event_type) FROM events)"
    event_value = f"""
        SELECT event_id, CAST(pos + 9 + {event_kinds} - 1 AS INTEGER) AS pos, value
        FROM ({_number_sql('events', 'event_id', 'value', 0)})"""
    ruled = f"""
        SELECT o_orderkey, CAST(o_orderpriority IN ('1-URGENT', '5-LOW') AND o_totalprice >= mn + 2 * st AS DOUBLE) AS label
        FROM orders, (SELECT min(o_totalprice) AS mn, (max(o_totalprice) - min(o_totalprice)) / 4 AS st FROM orders)
        WHERE {_KEY_BUCKET} >= 80"""
    lines = """(SELECT l_orderkey * 10 + l_linenumber AS line, CAST(l_quantity AS DOUBLE) AS quantity,
                       CAST(l_partkey AS VARCHAR) AS part FROM lineitem)"""
    unpriced = "(SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0 THEN o_totalprice END AS price FROM orders)"
    return {
        "decimal_to_double": """
            SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DOUBLE) AS amt FROM orders""",
        "label_cast": """
            SELECT o_orderkey, CAST(CAST(o_totalprice > 200000 AS INTEGER) AS DOUBLE) AS label FROM orders""",
        "string_to_timestamp": """
            SELECT event_id, CAST(year(t) AS INTEGER) AS y, strftime(t, '%Y-%m-%d %H:%M:%S.%f') AS shown
            FROM (SELECT event_id, CAST(CAST(ts AS VARCHAR) AS TIMESTAMP) AS t FROM events)""",
        "date_parts_basic": "SELECT event_id, "
        + ", ".join(f"CAST({part}(ts) AS INTEGER) AS ts_{part}" for part in _CLOCK)
        + " FROM events",
        "date_parts_extended": """
            SELECT event_id, CAST(isodow(ts) AS INTEGER) AS "ts_weekDay",
                   CAST(dayofyear(ts) AS INTEGER) AS "ts_yearDay",
                   CAST(hour(ts) * 60 + minute(ts) AS INTEGER) AS "ts_minuteFromDayBeginning"
            FROM events""",
        "date_parts_all": f"""
            SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts_timestamp,
                   {_calendar_sql('ts', 'INTEGER', 'ts_')}
            FROM events""",
        "quarter_variants": """
            SELECT o_orderkey, CAST(quarter(o_orderdate) AS INTEGER) AS q,
                   CAST(floor(month(o_orderdate) / 4.0) + 1 AS INTEGER) AS lq FROM orders""",
        "week_number_iso": """
            SELECT o_orderkey, CAST(weekofyear(o_orderdate) AS INTEGER) AS w FROM orders""",
        "week_number_us": """
            SELECT o_orderkey, CAST(ceil(dayofyear(CAST(o_orderdate AS DATE)
                   + CAST(6 - dayofweek(o_orderdate) AS INTEGER)) / 7.0) AS INTEGER) AS w FROM orders""",
        "field_roles": _roles_sql(),
        "split_keyed": f"""
            SELECT o_orderkey, CASE WHEN {_KEY_BUCKET} < 80 THEN 'train' ELSE 'test' END AS split FROM orders""",
        "split_random_check": """
            SELECT count(*) AS n_total, CAST(0 AS BIGINT) AS n_overlap FROM orders""",
        "split_random_rows": """
            SELECT event_type, u, CASE WHEN CAST('0x' || substr(md5(digest || ':' || copy), 1, 8) AS BIGINT) * (100 / 4294967296) < 80
                                       THEN 'train' ELSE 'test' END AS split, count(*) AS n
            FROM (SELECT event_type, u, sha256('42:' || CAST(to_json({'event_type': event_type, 'u': u}) AS VARCHAR)) AS digest,
                         row_number() OVER (PARTITION BY event_type, u) - 1 AS copy
                  FROM (SELECT event_type, user_id % 20 AS u FROM events))
            GROUP BY ALL""",
        "split_by_rows": """
            WITH k AS (SELECT l_orderkey, count(*) AS n, CAST('0x' || substr(md5(CAST(l_orderkey AS VARCHAR)), 1, 15) AS BIGINT) AS place
                       FROM (SELECT CASE WHEN l_quantity > 5 THEN l_orderkey ELSE 77 END AS l_orderkey FROM lineitem) GROUP BY 1),
                 s AS (SELECT *, sum(n) OVER (ORDER BY place) AS upto, 0.8 * sum(n) OVER () AS wanted FROM k),
                 c AS (SELECT min(place) AS place FROM s WHERE upto >= wanted),
                 l AS (SELECT c.place + CASE WHEN wanted - (upto - n) > upto - wanted THEN 1 ELSE 0 END AS border
                       FROM c JOIN s ON s.place = c.place)
            SELECT l_orderkey, CASE WHEN place < border THEN 'train' ELSE 'test' END AS split, n FROM k, l""",
        "jdbc_predicates": _jdbc_sql(JDBC_PARTS),
        "date_parts_zoned": f"""
            SELECT event_id, strftime(c, '%Y-%m-%d %H:%M:%S.%f') AS ts_local,
                   CAST(timezone('America/New_York', timezone('UTC', t - INTERVAL 1 HOUR)) = c AS INTEGER) AS ts_repeated,
                   {_calendar_sql('c', 'INTEGER', 'ts_')}
            FROM (SELECT event_id, t, timezone('America/New_York', timezone('UTC', t)) AS c
                  FROM (SELECT event_id, ts + to_days(CAST(event_id % 12 * 30 AS INTEGER)) AS t FROM events))""",
        "numeric_range": """
            SELECT min(o_totalprice) AS mn, max(o_totalprice) AS mx,
                   (max(o_totalprice) - min(o_totalprice)) / 4 AS step FROM orders""",
        "numeric_range_all": " UNION ALL ".join(
            f"SELECT '{c}' AS field, min({c}) AS mn, max({c}) AS mx, (max({c}) - min({c})) / 4 AS step FROM lineitem"
            for c in LINEITEM_DOUBLES
        ),
        "bucketize": bucketized,
        "bucketize_stage": bucketized,
        "category_frequency": _ORDER_RANKS,
        "category_frequency_wide": _PART_RANKS,
        "string_index": indexed_orders,
        "string_index_shuffled": f"""
            SELECT l_orderkey, l_linenumber, part, CAST(idx AS DOUBLE) AS idx
            FROM lineitem JOIN ({_PART_RANKS}) ON part = CAST(l_partkey AS VARCHAR)""",
        "string_index_skewed": """
            SELECT l_orderkey, l_linenumber, CAST(idx AS DOUBLE) AS idx
            FROM lineitem l JOIN (SELECT l_returnflag AS f, row_number() OVER (ORDER BY count(*) DESC, l_returnflag) - 1 AS idx
                                  FROM lineitem GROUP BY l_returnflag) ON f = l.l_returnflag""",
        "string_index_stage": indexed_orders,
        "one_hot": one_hot_orders,
        "one_hot_stage": one_hot_orders,
        "assemble_features": _vector_sql(
            "o_orderkey",
            f"{price} UNION ALL {_one_hot_sql('orders', 'o_orderkey', 'o_orderpriority', 2)}",
            "orders",
            "o_orderpriority",
            2,
        ),
        "feature_frame": _vector_sql(
            "o_orderkey",
            f"{price} UNION ALL {order_clock} UNION ALL "
            + _one_hot_sql("orders", "o_orderkey", "o_orderpriority", 7),
            "orders",
            "o_orderpriority",
            7,
        ),
        "feature_frame_calendar": _vector_sql(
            "event_id",
            f"{event_calendar} UNION ALL {_one_hot_sql('events', 'event_id', 'event_type', 9)}"
            f" UNION ALL {event_value}",
            "events",
            "event_type",
            11,
        ),
        "feature_frame_missing": f"""
            SELECT o_orderkey, CAST((SELECT count(DISTINCT o_orderpriority) FROM orders) + 2 AS INTEGER) AS size, pos, value
            FROM (SELECT o_orderkey, CAST(0 AS INTEGER) AS pos, CASE WHEN v IS NULL THEN CAST(6 AS DOUBLE) ELSE bucket END AS value
                  FROM ({_bucket_sql(unpriced, "o_orderkey", "price")})
                  UNION ALL SELECT o_orderkey, CAST(1 AS INTEGER) AS pos, price AS value FROM {unpriced} WHERE price IS NOT NULL
                  UNION ALL SELECT o_orderkey, CAST(idx + 2 AS INTEGER) AS pos, CAST(1 AS DOUBLE) AS value FROM ({indexed_orders}))
            WHERE value <> 0""",
        "feature_frame_wide": _vector_sql(
            "line",
            f"{_number_sql(lines, 'line', 'quantity', 0)} UNION ALL {_one_hot_sql(lines, 'line', 'part', 2)}",
            lines,
            "part",
            2,
        ),
        "prediction_target": """
            SELECT CASE WHEN o_totalprice > 250000 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS prediction,
                   CAST(o_totalprice > 200000 AS INTEGER) AS target FROM orders""",
        "confusion_counts": _RULE_COUNTS,
        "classification_metrics": f"""
            SELECT p AS precision, r AS recall, 2 * p * r / nullif(p + r, 0) AS "f1Score",
                   CAST(tp + tn AS DOUBLE) / nullif(n, 0) AS accuracy
            FROM (SELECT *, CAST(tp AS DOUBLE) / nullif(tp + fp, 0) AS p,
                         CAST(tp AS DOUBLE) / nullif(tp + fn, 0) AS r FROM ({_RULE_COUNTS}))""",
        "hold_out": f"""
            SELECT o_orderkey, CAST({_IS_BIG} AS DOUBLE) AS label FROM orders WHERE {_KEY_BUCKET} >= 80""",
        "gbt_rule": f"SELECT o_orderkey, label, label AS prediction FROM ({ruled})",
        "gbt_predictions": f"""
            SELECT o_orderkey, CAST(label AS INTEGER) AS target, label AS prediction FROM ({ruled})""",
        "gbt_metrics": f"""
            SELECT tp / nullif(tp, 0) AS precision, tp / nullif(tp, 0) AS recall,
                   tp / nullif(tp, 0) AS "f1Score", CAST(1 AS DOUBLE) AS accuracy
            FROM (SELECT sum(label) AS tp FROM ({ruled}))""",
        "job_outputs": f"""
            SELECT count(*) AS n, CAST(0 AS BIGINT) AS n_wrong, CAST(1 AS DOUBLE) AS accuracy,
                   sum(label) / nullif(sum(label), 0) AS "f1Score" FROM ({ruled})""",
        "score_and_measure": f"""
            SELECT count(*) AS rows, CAST(sum(label) AS BIGINT) AS positive, CAST(sum(label) AS BIGINT) AS tp, CAST(0 AS BIGINT) AS fp,
                   CAST(count(*) - sum(label) AS BIGINT) AS tn, CAST(0 AS BIGINT) AS fn, count(*) AS n FROM ({ruled})""",
        "bad_values": f"""
            SELECT unnest(['o_orderkey', 'o_totalprice', 'o_totalprice', 'o_orderdate', 'o_orderdate',
                           'o_orderpriority', 'o_orderpriority', 'big']) AS field,
                   unnest(['null', 'null', 'nan', 'null', 'unparsed', 'null', 'unseen', 'null']) AS kind,
                   unnest([0, count_if(o_orderkey % 11 = 1), count_if(o_orderkey % 11 = 0), count_if(o_orderkey % 13 = 1),
                           count_if(o_orderkey % 13 = 0), 0, count_if(o_orderkey % 500 = 7 AND {_KEY_BUCKET} >= 80), 0]) ::BIGINT AS n
            FROM orders""",
        "model_roundtrip": f"""
            SELECT count(*) AS n, CAST(0 AS BIGINT) AS n_mismatch FROM orders WHERE {_KEY_BUCKET} >= 80""",
        **_llm_oracles(),
    }
