"""Landed records: nested JSON, hand-kept CSV files and the append-only raw tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window, functions as F, types as T

from adtally import fixed_values as fv
from adtally.functions.names import breakdown_key, is_bookkeeping, quoted
from adtally.session import drop_stage

METRIC_LIST = "ARRAY<STRUCT<action_type: STRING, indicator: STRING, value: STRING>>"
UNREADABLE = "_unreadable"


def insight_schema(level: str, breakdowns: Iterable[str] = ()) -> T.StructType:
    """Read schema of delivery records; ``results`` comes in several shapes and is read as text."""
    types = {f: METRIC_LIST for f in fv.METRIC_LIST_FIELDS}
    fields = [*fv.INSIGHT_FIELDS[level], *breakdowns]
    return T.StructType.fromDDL(", ".join(f"`{f}` {types.get(f, 'STRING')}" for f in fields))


def entity_schema(entity: str) -> T.StructType:
    fields = fv.ENTITY_FIELDS[entity]
    return T.StructType.fromDDL(", ".join(f"`{f}` {fv.NESTED_FIELDS.get(f, 'STRING')}" for f in fields))


def read_records(spark: SparkSession, paths: str | list[str], schema: T.StructType | None = None) -> DataFrame:
    """JSON-lines records from one or many paths; lines that are no JSON object are skipped.

    With a schema nothing is inferred and only its fields are parsed; a field
    of another shape is NULL and its record stays, whatever is selected.
    Without one Spark reads the files twice, the first time to find the fields.
    """
    if not schema:
        return spark.read.option("mode", "DROPMALFORMED").json(paths)
    return readable(spark.read.schema(with_unreadable(schema)).option("columnNameOfCorruptRecord", UNREADABLE).json(paths))


def with_unreadable(schema: T.StructType) -> T.StructType:
    """The schema with a column for the text of records that don't fit it; ``readable`` takes it away again."""
    return T.StructType([*schema.fields, T.StructField(UNREADABLE, T.StringType())])


def readable(records: DataFrame) -> DataFrame:
    """Records that are JSON objects. Whether a line is one is asked of its text, so selected columns don't matter.

    The filter also names the first field: Spark refuses scans of the text column alone.
    """
    first = F.length(F.concat_ws("", quoted(records.columns[0]).cast("string"))) >= 0
    whole = F.schema_of_variant(F.try_parse_json(UNREADABLE)).startswith("OBJECT")
    return records.where(first & (F.col(UNREADABLE).isNull() | F.coalesce(whole, F.lit(False)))).drop(UNREADABLE)


def unreadable_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """The lines, as ``line``, that ``read_records`` skips: to count or to look at what was refused."""
    lines = spark.read.text(paths).withColumnRenamed("value", "line").where(F.trim("line") != "")
    shape = F.schema_of_variant(F.try_parse_json("line"))
    return lines.where(~F.coalesce(shape.startswith("OBJECT"), F.lit(False)))


ARRIVAL_ORDER = ["_arrived", "_file", "_offset", "_line"]


def arrival_columns(records: DataFrame) -> DataFrame:
    """Where a file source row came from, next to the record; ``with_arrival`` adds the line as well."""
    return records.select(
        "*",
        F.col("_metadata.file_modification_time").alias("_arrived"),
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_offset"),
    )


def with_arrival(records: DataFrame) -> DataFrame:
    """Records with ``ARRIVAL_ORDER``: newest file last, then line by line."""
    return arrival_columns(records).withColumn("_line", F.monotonically_increasing_id())


def read_text_csv(spark: SparkSession, path: str, required: Iterable[str] = ()) -> DataFrame:
    """A CSV with a header, every value as text, headers trimmed and lower case, required columns added as NULL."""
    rows = spark.read.option("header", True).option("inferSchema", False).csv(path)
    named = rows.toDF(*[c.strip().lstrip("﻿").lower() for c in rows.columns])
    missing = {c: F.lit(None).cast("string") for c in required if c not in named.columns}
    return named.withColumns(missing) if missing else named


def write_csv(df: DataFrame, path: str) -> bool:
    """CSV with a header, one file per task; nothing is left for no rows. The rows are counted while they are written."""
    counter = Observation("csv")
    df.observe(counter, F.count(F.lit(1)).alias("n")).write.option("header", True).csv(path)
    if not counter.get["n"]:
        drop_stage(df.sparkSession, path)
        return False
    return True


def record_json(df: DataFrame) -> Column:
    """The whole record as JSON text with its NULL fields, without bookkeeping columns."""
    fields = [quoted(c) for c in df.columns if not is_bookkeeping(c)]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def raw_insight_rows(records: DataFrame, level: str, breakdowns: Iterable[str] | None, ingest_id: Column) -> DataFrame:
    """Raw delivery rows: id columns, canonical breakdowns, time of arrival and the full record."""

    def text(name: str) -> Column:
        return (quoted(name) if name in records.columns else F.lit(None)).cast("string").alias(name)

    return records.select(
        ingest_id.cast("bigint").alias("id"),
        text("account_id"),
        F.lit(level).alias("level"),
        text("date_start").cast("date").alias("date_start"),
        text("date_stop").cast("date").alias("date_stop"),
        F.lit(breakdown_key(breakdowns)).alias("breakdowns"),
        F.current_timestamp().alias("fetched_at"),
        record_json(records).alias("payload"),
    )


def raw_rows(records: DataFrame, columns: Mapping[str, str], ingest_id: Column) -> DataFrame:
    """Raw rows of any entity: ``{raw column: record field}`` and the full record."""
    return records.select(
        ingest_id.cast("bigint").alias("id"),
        *[
            (quoted(source) if source in records.columns else F.lit(None)).cast("string").alias(name)
            for name, source in columns.items()
        ],
        record_json(records).alias("payload"),
    )


def replay_insights(
    raw: DataFrame,
    level: str,
    breakdowns: Iterable[str] | None = None,
    from_date: str | None = None,
    to_date: str | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Raw delivery rows of one level, optionally of one breakdown set and date range, in id order with a limit."""
    terms = [F.col("level") == level]
    if from_date:
        terms.append(F.col("date_start") >= F.lit(from_date).cast("date"))
    if to_date:
        terms.append(F.col("date_start") <= F.lit(to_date).cast("date"))
    if breakdowns is not None:
        terms.append(F.coalesce("breakdowns", F.lit("")) == breakdown_key(breakdowns))
    for term in terms:
        raw = raw.where(term)
    return first_ids(raw, limit)


def first_ids(raw: DataFrame, limit: int | None) -> DataFrame:
    """The first rows by id; without a limit no sort, since replays order by id where order matters."""
    return raw.orderBy("id").limit(limit) if limit and limit > 0 else raw


def single_breakdown(rows: DataFrame) -> list[str]:
    """The only breakdown set of replayed rows; more than one is an error. Runs one job that stops early."""
    found = rows.select(F.coalesce("breakdowns", F.lit("")).alias("b")).distinct().limit(2).collect()
    if len(found) > 1:
        raise ValueError(f"several breakdown sets in the raw rows, such as {[r['b'] for r in found]}: choose one")
    return [b for b in found[0]["b"].split(",") if b] if found else []


def decode_payload(rows: DataFrame, schema: T.StructType, keep: Iterable[str] = ("id",)) -> DataFrame:
    """Payloads as columns, next to the kept raw columns under ``_raw_<name>``; NULL ones and non-objects are skipped.

    A field of another shape is NULL and its record stays. A payload that is a
    struct already is used as it is.
    """
    kept = [quoted(k).alias(f"_raw_{k}") for k in keep]
    if isinstance(rows.schema["payload"].dataType, T.StructType):
        return rows.where("payload IS NOT NULL").select(*kept, "payload.*")
    checked = schema.add(T.StructField(UNREADABLE, T.StringType()))
    parsed = F.from_json("payload", checked, {"columnNameOfCorruptRecord": UNREADABLE})
    decoded = rows.where("payload IS NOT NULL").select(*kept, parsed.alias("_record"))
    bad = F.col(f"_record.{UNREADABLE}")
    whole = F.schema_of_variant(F.try_parse_json(bad)).startswith("OBJECT")
    return decoded.where(bad.isNull() | F.coalesce(whole, F.lit(False))).select(
        *[f"_raw_{k}" for k in keep], *[F.col("_record").getField(f).alias(f) for f in schema.names if f != UNREADABLE]
    )


def newest_payloads(rows: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Raw rows without those that a later row of the same key replaces, told from the payload's text.

    Only the fields that make the key are read, so payloads that lose are never decoded; each task keeps one row of a
    key before anything is shuffled. Rows whose payload is no object or lacks a key all stay: the load decides on them.
    """
    if not isinstance(rows.schema["payload"].dataType, T.StringType):
        return rows
    found = {f"_key_{i}": F.get_json_object("payload", f"$['{key}']") for i, key in enumerate(keys)}
    keyed = rows.withColumns(found)
    lone = F.when(F.concat(*[F.col(c) for c in found]).isNull(), F.col("id"))
    newest = Window.partitionBy(*found, lone).orderBy(F.col("id").desc_nulls_last())
    return keyed.withColumn("_rank", F.row_number().over(newest)).where("_rank = 1").drop("_rank", *found)


def payload_schema(rows: DataFrame) -> T.StructType:
    """Schema of the object payloads, from one aggregation job; fields of mixed shapes are text."""
    shape = F.schema_of_variant(F.try_parse_json("payload"))
    objects = rows.where(shape.startswith("OBJECT"))
    merged = objects.select(F.schema_of_variant_agg(F.try_parse_json("payload")).alias("s")).first()["s"]
    if not merged or not merged.startswith("OBJECT"):
        return T.StructType([])
    ddl = merged.replace("OBJECT<", "STRUCT<").replace("VARIANT", "STRING").replace("VOID", "STRING")
    return T.StructType.fromDDL("payload " + ddl)["payload"].dataType
