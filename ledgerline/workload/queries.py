"""Queries over the driver tables: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from functools import partial, reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions import columns as C
from ledgerline.operators import aggregate as A
from ledgerline.operators import join as J
from ledgerline.operators import profile as P
from ledgerline.operators import project as S
from ledgerline.operators import quality as Q
from ledgerline.operators import rank as R
from ledgerline.operators import sketch as K
from ledgerline.plans import decompose as D
from ledgerline.plans.gold import GOLD_TABLE, SUMMARY_KEYS, to_gold, write_gold
from ledgerline.plans.profiling import profile_job, review
from ledgerline.plans.publish import audit_totals, publish
from ledgerline.plans.refine import refine
from ledgerline.schemas import (
    CUSTOMER_BEHAVIOR,
    DEVICE,
    DEVICE_SCHEMA,
    FRAUD_TIMING,
    MERCHANT,
    MONEY,
    PAYMENTS,
    PAYMENTS_SCHEMA,
    TRANSACTION_SOURCES,
)
from ledgerline.sources import readers as IN
from ledgerline.sources import sinks as OUT
from ledgerline.sources.files import write_files
from ledgerline.sources.scratch import scratch_folder
from ledgerline.sources.together import all_together
from ledgerline.workload.tables import bronze_sources, raw_sources, silver_sources, table, wide_transactions

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

FACT_COLUMNS = (
    "transaction_id",
    "Category",
    "Type",
    "location",
    "amount",
    "is_fraud",
    "timestamp",
    "fraud_type",
)


def query(name: str) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        return function

    return register


def comparable(df: DataFrame) -> DataFrame:
    """Output two engines print alike: no run time, decimals as double, sets as text."""
    columns = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if field.name in ("ingestion_timestamp", "profiling_timestamp"):
            continue
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, T.ArrayType):
            column = F.array_join(F.sort_array(column.cast("array<string>")), ",")
        columns.append(column.alias(field.name))
    return df.select(*columns)


def gold_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The Gold columns that the summaries read, from the sources that have them."""
    order = (PAYMENTS, MERCHANT, FRAUD_TIMING)
    return J.transaction_join(silver_sources(spark, sf_dir, *order), order).select(*FACT_COLUMNS)


def written_measures(spark: SparkSession, sf_dir: str, key: str) -> DataFrame:
    """The measures per value of a key, a few rows, written once for all who read them."""
    path = scratch_folder(spark, "measures")
    OUT.write_parquet(A.fraud_measures(gold_facts(spark, sf_dir), key), path)
    return spark.read.parquet(path)


def reviewed(spark: SparkSession, sf_dir: str, part: str) -> DataFrame:
    """A part of the review of a written profile of all five sources."""
    return comparable(review(written_profile(spark, sf_dir))[part])


def written_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_folder(spark, "profile")
    bronze = bronze_sources(spark, sf_dir)
    tables = {name: f"{root}/bronze/{name}" for name in bronze}
    all_together({name: partial(OUT.write_parquet, bronze[name], path) for name, path in tables.items()})
    return profile_job(spark, {**tables, "absent": f"{root}/bronze/absent"}, f"{root}/metadata")


# Scans and sinks ---------------------------------------------------------------


@query("csv_roundtrip")
def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_folder(spark, "csv")
    OUT.write_csv(raw_sources(spark, sf_dir, PAYMENTS)[PAYMENTS], path)
    return comparable(IN.read_source(spark, IN.SourceSpec("csv", path, PAYMENTS_SCHEMA)))


@query("wide_csv_scan")
def wide_csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_folder(spark, "wide")
    OUT.write_csv(wide_transactions(spark, sf_dir), path)
    wide = IN.read_wide_csv(spark, path)
    return comparable(wide.withColumn("timestamp", C.coerce_timestamp(F.col("timestamp"))))


@query("jsonl_roundtrip")
def jsonl_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_folder(spark, "jsonl")
    OUT.write_jsonl(raw_sources(spark, sf_dir, DEVICE)[DEVICE], path)
    return S.flatten_device(IN.read_source(spark, IN.SourceSpec("jsonl", path, DEVICE_SCHEMA)))


@query("json_scan")
def json_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_folder(spark, "json")
    OUT.write_jsonl(raw_sources(spark, sf_dir, PAYMENTS)[PAYMENTS], path)
    return comparable(IN.read_source(spark, IN.SourceSpec("JSON", path, PAYMENTS_SCHEMA)))


def _json_arrays(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One JSON array per batch of JSON objects."""
    for batch in batches:
        yield pd.DataFrame({"value": ["[" + ",\n".join(batch["value"]) + "]"]})


@query("json_multiline_scan")
def json_multiline_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that hold one JSON array each, over several lines."""
    path = scratch_folder(spark, "json-arrays")
    objects = raw_sources(spark, sf_dir, PAYMENTS)[PAYMENTS].select(
        F.to_json(F.struct("*"), {"timestampFormat": OUT.TEXT_TIMESTAMP}).alias("value")
    )
    arrays = objects.mapInPandas(_json_arrays, "value string")
    arrays.write.mode("overwrite").option("maxRecordsPerFile", 1).text(path)
    return comparable(IN.read_source(spark, IN.SourceSpec("json", path, PAYMENTS_SCHEMA, multi_line=True)))


@query("generic_scan_orc")
def generic_scan_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_folder(spark, "orc")
    raw_sources(spark, sf_dir, MERCHANT)[MERCHANT].write.mode("overwrite").orc(path)
    return comparable(IN.read_source(spark, IN.SourceSpec("orc", path)))


@query("parquet_overwrite_scan")
def parquet_overwrite_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, raw = scratch_folder(spark, "overwrite"), raw_sources(spark, sf_dir, MERCHANT, PAYMENTS)
    OUT.write_parquet(raw[MERCHANT], path)
    OUT.write_parquet_ms(raw[PAYMENTS], path, "event_time")
    return comparable(IN.read_dataset(spark, path))


@query("dataset_reassembly")
def dataset_reassembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_folder(spark, "parts")
    timing = raw_sources(spark, sf_dir, FRAUD_TIMING)[FRAUD_TIMING]
    parts = {"fraud": F.col("is_fraud"), "other": ~F.col("is_fraud")}
    for part, rows in parts.items():
        OUT.write_parquet(timing.filter(rows), f"{root}/{part}")
    return IN.read_dataset(spark, *[f"{root}/{part}" for part in parts])


@query("uneven_parts")
def uneven_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three parts of payments: columns that only some have, a number and a struct that one part holds narrower."""
    root = scratch_folder(spark, "uneven")
    payments = raw_sources(spark, sf_dir, PAYMENTS)[PAYMENTS].withColumn("n", _number("tx_id"))
    parts = [
        ("tx_id", "CAST(n AS INT) AS n", "payment_channel", "named_struct('x', CAST(n AS INT)) AS s"),
        ("tx_id", "n", "location", "named_struct('y', location, 'x', n) AS s"),
        ("n", "tx_id", "payment_channel"),
    ]
    for at, columns in enumerate(parts):
        OUT.write_parquet(payments.filter(F.col("n") % 3 == at).selectExpr(*columns), f"{root}/{at}")
    whole = IN.read_dataset(spark, *[f"{root}/{at}" for at in range(len(parts))])
    return whole.select("tx_id", "n", "payment_channel", "location", F.col("s.x").alias("x"), F.col("s.y").alias("y"))


#: Rows of a landing file in the query about files.
FILE_ROWS = 5_000


def _number(column: str) -> Column:
    """The number of an event out of its transaction id."""
    return F.substring(column, 3, 18).cast("bigint")


def _landing_files(spark: SparkSession, sf_dir: str, landing: str) -> dict[str, IN.SourceSpec]:
    """Payments as CSV files and device telemetry as compressed JSON files, some thousand rows each, under names of their own."""
    raw = raw_sources(spark, sf_dir, PAYMENTS, DEVICE)
    n, piece = _number("tx_id"), (_number("tx_id") / FILE_ROWS).cast("bigint")
    named = raw[PAYMENTS].withColumn("name", F.format_string("payments-%s-%03d.csv", "payment_channel", piece))
    lines = named.select("name", n.alias("at"), F.to_csv(F.struct(*raw[PAYMENTS].columns)).alias("value"))
    OUT.write_parquet(named.select("name").distinct(), f"{landing}/_names")
    names = spark.read.parquet(f"{landing}/_names")
    headers = names.select("name", F.lit(-1).cast("bigint").alias("at"), F.lit(",".join(raw[PAYMENTS].columns)).alias("value"))
    write_files(lines.unionByName(headers), f"{landing}/payments_files", known=names)
    n, piece = _number("transaction_id"), (_number("transaction_id") / FILE_ROWS).cast("bigint")
    telemetry = raw[DEVICE].select(F.format_string("device-%03d.json.gz", piece).alias("name"), n.alias("at"), F.to_json(F.struct("*")).alias("value"))
    write_files(telemetry, f"{landing}/device_files", codec="gzip")
    return {
        "payments_files": IN.SourceSpec("csv", "/payments_files"),
        "device_files": IN.SourceSpec("jsonl", "/device_files", DEVICE_SCHEMA),
    }


@query("file_row_audit")
def file_row_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of every published file whose name is known, and totals of the sources whose files Spark named."""
    landing, target = scratch_folder(spark, "landing"), scratch_folder(spark, "published")
    D.write_raw(raw_sources(spark, sf_dir), landing)
    files = _landing_files(spark, sf_dir, landing)
    relative = {
        **D.raw_specs(""),
        **files,
        "absent": IN.SourceSpec("parquet", "/absent"),
    }
    audit = publish(spark, landing, target, relative)
    by_name = F.col("source").isin(list(files))
    name = F.regexp_extract("file_path", "[^/]+$", 0)
    totals = audit_totals(audit.filter(~by_name)).select(
        "source", F.lit(None).cast("string").alias("file_name"), (F.col("file_count") > 0).alias("has_files"), "row_count"
    )
    return totals.unionByName(
        audit.filter(by_name).select("source", name.alias("file_name"), F.lit(True).alias("has_files"), "row_count")
    )


def _broken_lines(spark: SparkSession, sf_dir: str, root: str) -> dict[str, IN.SourceSpec]:
    """CSV lines with a word for an amount or with one field, and JSON lines cut in half."""
    raw = raw_sources(spark, sf_dir, PAYMENTS, DEVICE)
    n = _number("tx_id") % 50
    amount = F.when(n == 0, "n/a").otherwise(F.col("amount").cast("string"))
    line = F.to_csv(F.struct(*raw[PAYMENTS].columns), {"timestampFormat": OUT.TEXT_TIMESTAMP})
    lines = raw[PAYMENTS].withColumn("amount", amount).select(F.when(n == 1, "cut").otherwise(line).alias("value"))
    lines.write.text(f"{root}/raw/payments_broken")
    text, n = F.to_json(F.struct("*")), _number("transaction_id") % 50
    cut = F.when(n == 2, F.substring(text, 1, 20)).otherwise(text)
    raw[DEVICE].select(cut.alias("value")).write.text(f"{root}/raw/device_broken")
    return {
        "payments_broken": IN.SourceSpec("csv", f"{root}/raw/payments_broken", PAYMENTS_SCHEMA, options={"header": False}),
        "device_broken": IN.SourceSpec("jsonl", f"{root}/raw/device_broken", DEVICE_SCHEMA),
    }


@query("ingest_status")
def ingest_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_folder(spark, "ingest")
    raw = raw_sources(spark, sf_dir)
    specs = D.write_raw(raw, f"{root}/raw")
    OUT.write_csv(raw[PAYMENTS].filter(F.col("amount") < 0), f"{root}/raw/none")
    specs["no_rows"] = IN.SourceSpec("csv", f"{root}/raw/none", PAYMENTS_SCHEMA)
    specs["no_path"] = IN.SourceSpec("parquet", f"{root}/raw/absent")
    specs["no_match"] = IN.SourceSpec("csv", f"{root}/raw/payments_core", DEVICE_SCHEMA)
    specs |= _broken_lines(spark, sf_dir, root)
    _, status = IN.ingest(spark, specs, f"{root}/bronze")
    return status.drop("message")


@query("quarantine")
def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records that ingest put aside: their raw text, and the key where it could be read."""
    root = scratch_folder(spark, "quarantine")
    specs = _broken_lines(spark, sf_dir, root)
    IN.ingest(spark, specs, f"{root}/bronze", drop_malformed=True)
    keys = {"payments_broken": "tx_id", "device_broken": "transaction_id"}
    aside = [
        spark.read.parquet(f"{root}/bronze/{IN.QUARANTINE}/{name}").select(
            F.lit(name).alias("source"), F.substring(IN.MALFORMED, 1, 3).alias("start"), F.col(key).alias("key")
        )
        for name, key in keys.items()
    ]
    return reduce(DataFrame.unionByName, aside)


# Projection, casts, derived columns ---------------------------------------------


@query("rename_by_map")
def rename_by_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(S.rename_by_map(raw_sources(spark, sf_dir, MERCHANT)[MERCHANT]))


@query("lineage_columns")
def lineage_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(bronze_sources(spark, sf_dir, MERCHANT)[MERCHANT])


@query("struct_flatten")
def struct_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(silver_sources(spark, sf_dir, DEVICE)[DEVICE])


@query("safe_decimal")
def safe_decimal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amounts as text, every one of another form: good, padded, bad and far too long."""
    value = F.col("value").cast(MONEY).cast("string")
    n = F.col("event_id") % 4
    text = (
        F.when(n == 0, value)
        .when(n == 1, F.concat(F.lit("  "), value, F.lit("5 ")))
        .when(n == 2, F.concat(value, F.lit(" EUR")))
        .otherwise(F.concat(F.lit("12345678901234567890"), value))
    )
    events = table(spark, sf_dir, "events").select("event_id", text.alias("amount_text"))
    return comparable(events.withColumn("amount", C.safe_decimal(F.col("amount_text"))))


@query("timestamp_normalize")
def timestamp_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A zone-free column made a timestamp, in full, by name from text, and to the millisecond."""
    events = table(spark, sf_dir, "events").select("event_id", "ts", F.col("ts").cast("string").alias("event_time"))
    normal = S.cast_columns(S.timestamp_normalize(events), decimals=())
    return normal.withColumn("ts_ms", C.to_milliseconds(F.col("ts")))


@query("parse_timestamp_coerce")
def parse_timestamp_coerce(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of unusable timestamps in a text column with bad and missing ones."""
    events = table(spark, sf_dir, "events")
    text = (
        F.when(F.col("event_type") == "error", F.concat(F.lit("on "), F.col("ts").cast("string")))
        .when(F.col("event_type") == "view", F.lit(None))
        .otherwise(F.col("ts").cast("string"))
    )
    return D.unparsed_timestamps(events.select(text.alias("timestamp")))


@query("stringify_objects")
def stringify_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(D.merchant(wide_transactions(spark, sf_dir), missing="nan"))


@query("location_missing")
def location_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    payments = silver_sources(spark, sf_dir, PAYMENTS)[PAYMENTS]
    return payments.groupBy("location", "location_missing").agg(F.count(F.lit(1)).alias("row_count"))


@query("fraud_inconsistent")
def fraud_inconsistent(spark: SparkSession, sf_dir: str) -> DataFrame:
    timing = silver_sources(spark, sf_dir, FRAUD_TIMING)[FRAUD_TIMING]
    return timing.select("transaction_id", "location_missing", "is_fraud_inconsistent")


@query("time_of_day")
def time_of_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_sources(spark, sf_dir, FRAUD_TIMING)[FRAUD_TIMING].groupBy("time_of_day").count()


@query("day_of_week")
def day_of_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_sources(spark, sf_dir, FRAUD_TIMING)[FRAUD_TIMING].select("transaction_id", "day_of_week")


@query("null_injection")
def null_injection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_sources(spark, sf_dir, FRAUD_TIMING)[FRAUD_TIMING].select("transaction_id", "location")


@query("row_hash")
def row_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The digest over all Gold columns."""
    return to_gold(silver_sources(spark, sf_dir)).select("transaction_id", "row_hash")


@query("decompose")
def decomposed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOB-01 with all its sources: rows, and a column of each in one table."""
    parts = D.decompose(wide_transactions(spark, sf_dir))
    columns = {PAYMENTS: "tx_id", MERCHANT: "ID", DEVICE: "transaction_id", CUSTOMER_BEHAVIOR: "sender_account", FRAUD_TIMING: "transaction_id"}
    keys = [df.select(F.lit(name).alias("source"), F.col(columns[name]).alias("key")) for name, df in parts.items()]
    return reduce(DataFrame.unionByName, keys)


# Joins ---------------------------------------------------------------------------


@query("transaction_join")
def transaction_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(J.transaction_join(silver_sources(spark, sf_dir, *TRANSACTION_SOURCES)))


@query("behavior_join")
def behavior_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = silver_sources(spark, sf_dir, PAYMENTS, CUSTOMER_BEHAVIOR)
    return comparable(J.behavior_join(silver[PAYMENTS], silver[CUSTOMER_BEHAVIOR]))


@query("gold_table")
def gold_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Left joins whose right sides lack keys."""
    return comparable(to_gold(silver_sources(spark, sf_dir, gaps=True)).drop("row_hash"))


@query("duplicate_key_join")
def duplicate_key_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders against line items: the right key repeats, and some orders have none."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("transaction_id"), F.col("o_orderstatus").alias("status")
    )
    items = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("transaction_id"), "l_linenumber", "l_quantity", "l_returnflag"
    )
    names = ("orders", "items")
    heavy = dict(zip(names, J.heavy_keys((orders, "transaction_id"), (items, "transaction_id"))))
    return J.transaction_join({"orders": orders, "items": items}, names, heavy=heavy)


@query("heavy_key_join")
def heavy_key_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items by return flag, three keys for the whole table, joined to a row per flag."""
    items = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_orderkey", "l_linenumber", "l_quantity")
    per_flag = items.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("flag_rows"))
    (heavy,) = J.heavy_keys((items, "l_returnflag"))
    return J.behavior_join(items, per_flag, "l_returnflag", heavy)


@query("heavy_right_join")
def heavy_right_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per return flag, and one flag that no line item has, joined to all line items."""
    items = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_orderkey", "l_linenumber", "l_quantity")
    flags = items.select("l_returnflag").distinct().unionByName(
        table(spark, sf_dir, "region").select(F.concat(F.lit("none-"), "r_regionkey").alias("l_returnflag"))
    )
    (heavy,) = J.heavy_keys((items, "l_returnflag"), least=100)
    return J.left_join(flags, items, "l_returnflag", right_heavy=heavy)


@query("key_sketches")
def key_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The most frequent keys of two batches, sketched apart and merged, with as many rows as a count gives."""
    items = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", "l_linenumber")
    batches = [items.filter(F.col("l_linenumber") % 2 == at) for at in (0, 1)]
    rows = [K.sketched(df, "lineitem", ("l_returnflag", "l_linestatus")) for df in batches]
    return K.top_items(reduce(DataFrame.unionByName, rows), 10)


def _bucketed_silver(spark: SparkSession, sf_dir: str, gaps: bool) -> Mapping[str, DataFrame]:
    """Silver tables bucketed by transaction id, a bucket for each shuffle partition."""
    root = scratch_folder(spark, "bucketed")
    bronze = bronze_sources(spark, sf_dir, *TRANSACTION_SOURCES, gaps=gaps)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    silver, _ = refine(spark, bronze, root, buckets=buckets, tables=root.rsplit("/", 1)[1].replace("-", "_"))
    return silver


@query("bucketed_join")
def bucketed_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(J.transaction_join(_bucketed_silver(spark, sf_dir, gaps=False)))


@query("bucketed_census")
def bucketed_census(spark: SparkSession, sf_dir: str) -> DataFrame:
    return J.key_census(_bucketed_silver(spark, sf_dir, gaps=True), "transaction_id")


@query("key_coverage")
def key_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = silver_sources(spark, sf_dir, gaps=True)
    by_transaction = {name: silver[name] for name in (MERCHANT, DEVICE, FRAUD_TIMING)}
    by_account = {CUSTOMER_BEHAVIOR: silver[CUSTOMER_BEHAVIOR]}
    return J.key_coverage(silver[PAYMENTS], by_transaction, "transaction_id").unionByName(
        J.key_coverage(silver[PAYMENTS], by_account, "sender_account")
    )


@query("missing_keys")
def missing_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("order_key"))
    items = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("order_key"))
    return J.missing_keys(orders, items, "order_key")


# Aggregates and ranking -------------------------------------------------------------


@query("customer_behavior")
def customer_behavior(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(A.behavior_rollup(wide_transactions(spark, sf_dir)))


def _summary_queries(key: str) -> None:
    low = key.lower()

    @query(f"fraud_by_{low}")
    def summary(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(A.fraud_summary(gold_facts(spark, sf_dir), key))

    @query(f"timestamps_by_{low}")
    def timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
        return A.group_values(gold_facts(spark, sf_dir), key, "timestamp")

    @query(f"fraud_types_by_{low}")
    def fraud_types(spark: SparkSession, sf_dir: str) -> DataFrame:
        return A.group_values(gold_facts(spark, sf_dir), key, "fraud_type")

    @query(f"scaled_{low}")
    def scaled(spark: SparkSession, sf_dir: str) -> DataFrame:
        ranked = R.ranked_summary(written_measures(spark, sf_dir, key), key, "fraud_transaction_count")
        return ranked.select(key, *[F.round(m, 9).alias(m) for m in R.SCALED_MEASURES])


for _key in ("Category", "Type", "location"):
    _summary_queries(_key)


def _ranked_queries(name: str, key: str, measure: str) -> None:
    @query(name)
    def ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
        """The first twenty with their ranks."""
        top = R.ranked_summary(written_measures(spark, sf_dir, key), key, measure, n=20)
        return top.select("rank", key, F.round(measure, 9).alias(measure))


for _label, _measure in (("count", "fraud_transaction_count"), ("amount", "fraud_amount")):
    _ranked_queries(f"top_locations_by_{_label}", "location", _measure)
    _ranked_queries(f"ranked_category_by_{_label}", "Category", _measure)
    _ranked_queries(f"ranked_type_by_{_label}", "Type", _measure)


@query("fraud_summaries")
def fraud_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All three summaries from one scan of the facts."""
    parts = A.fraud_parts(gold_facts(spark, sf_dir), SUMMARY_KEYS)
    # Written once, as for Gold: each summary reads its own parts.
    path = scratch_folder(spark, "parts")
    OUT.write_parquet(parts, path)
    parts = spark.read.parquet(path)
    each = [A.summary_of(parts, key).withColumnRenamed(key, "key") for key in SUMMARY_KEYS]
    return comparable(reduce(DataFrame.unionByName, each))


@query("row_counts")
def row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.row_counts(bronze_sources(spark, sf_dir))


# Quality and profiles ------------------------------------------------------------------


@query("uniqueness")
def uniqueness(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = {name: table(spark, sf_dir, name) for name in ("orders", "lineitem")}
    keys = {"orders": "o_orderkey", "lineitem": "l_orderkey"}
    return reduce(DataFrame.unionByName, [Q.uniqueness(df, name, keys[name]) for name, df in frames.items()])


@query("completeness")
def completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = silver_sources(spark, sf_dir)
    checks = [Q.completeness(A.null_counts(df), name, threshold=0.01) for name, df in silver.items()]
    return reduce(DataFrame.unionByName, checks)


@query("row_count_checks")
def row_count_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = bronze_sources(spark, sf_dir)
    frames["refunds"] = frames[PAYMENTS].filter(F.col("amount") < 0)
    counts = A.row_counts(frames)
    return Q.row_count_alerts(counts, frames)


@query("alerts")
def alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources with gaps, and amounts of which some cannot be read."""
    bronze = bronze_sources(spark, sf_dir, gaps=True)
    text = F.col("amount").cast("string")
    spoilt = F.when(_number("tx_id") % 50 == 0, F.concat(text, F.lit(" EUR"))).otherwise(text)
    bronze[PAYMENTS] = bronze[PAYMENTS].withColumn("amount", spoilt)
    silver = {name: S.standardize(df, failures=True) for name, df in bronze.items()}
    return Q.alerts(silver, failed=["refunds"])


@query("profile")
def profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(P.profile_all(bronze_sources(spark, sf_dir)))


@query("nested_profile")
def nested_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Structs and arrays whose times differ by microseconds, and maps, told apart exactly."""
    events = table(spark, sf_dir, "events")
    at = F.timestamp_micros(F.unix_micros(F.col("ts").cast("timestamp")) + F.col("event_id") % 3)
    nested = events.select(
        F.struct(at.alias("at"), F.col("event_type").alias("kind")).alias("stamp"),
        F.array(at).alias("times"),
        F.create_map(F.col("event_type"), F.col("user_id")).alias("users"),
    )
    counts = P.profile_all({"events": nested}).filter("metric = 'distinct_count'")
    return counts.select("column_name", "metric_value")


@query("profile_written")
def profile_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(written_profile(spark, sf_dir))


for _query, _part in (
    ("profile_columns", "columns_per_source"),
    ("column_names", "column_names"),
    ("data_types", "data_types"),
    ("struct_columns", "struct_columns"),
    ("profile_row_counts", "row_counts"),
    ("null_issues", "null_issues"),
):
    query(_query)(partial(reviewed, part=_part))


# The whole way -----------------------------------------------------------------------------


@query("medallion_run")
def medallion_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw files in five formats to Bronze, Silver, Gold and the three summaries, which are returned in one table."""
    root = scratch_folder(spark, "medallion")
    OUT.write_parquet(wide_transactions(spark, sf_dir), f"{root}/wide")
    specs = D.write_raw(D.decompose(spark.read.parquet(f"{root}/wide")), f"{root}/raw")
    bronze, _ = IN.ingest(spark, specs, f"{root}/bronze")
    silver, _ = refine(spark, bronze, f"{root}/silver")
    tables = write_gold(spark, silver, f"{root}/gold")
    parts = [
        tables[f"fraud_by_{key.lower()}"].withColumnRenamed(key, "key").join(
            tables[GOLD_TABLE].groupBy(F.col(key).alias("same")).agg(F.count("row_hash").alias("hashes")),
            F.col("key").eqNullSafe(F.col("same")),
        ).drop("same")
        for key in SUMMARY_KEYS
    ]
    return comparable(reduce(DataFrame.unionByName, parts))
