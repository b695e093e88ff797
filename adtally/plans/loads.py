"""Loads: delivery facts and the five dimensions, from landed or raw records to tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from adtally import fixed_values as fv
from adtally.functions.accounts import without_prefix
from adtally.functions.coerce import to_utc_timestamp
from adtally.functions.names import column_name, fact_table_name, is_bookkeeping, quoted
from adtally.operators import reshape, windows
from adtally.operators.fieldmap import FieldMap, apply_field_map
from adtally.operators.keyed import creatives_of_ads, keep_first
from adtally.operators.profile import numeric_text_columns, observed_profile
from adtally.operators.star import star_sql, star_view
from adtally.plans.sync import sync_tables
from adtally.session import drop_stage, write_stage
from adtally.sources import landed
from adtally.sources import changes
from adtally.sources.tables import Layout, layout_of, replace_days, replace_table, upsert_table, write_table


#: Windows that a job of a range load writes and marks together: a quarter of a year at seven days each.
WINDOWS_PER_JOB = 13


def normalise_facts(
    records: DataFrame,
    level: str,
    breakdowns: Iterable[str] = (),
    fields: FieldMap | None = None,
    metric_types: Mapping[str, Iterable[str]] | None = None,
    numeric_text: Iterable[str] | None = None,
    keep_nulls: bool = False,
    unknown_metrics: str = "fail",
) -> DataFrame:
    """Delivery records to a wide fact table.

    Two things depend on the data: the metric types that become columns and
    the text columns that are numbers. Unless given, one job finds both.
    Giving them also keeps column types stable from batch to batch; then a type
    that was not named fails the load or, with ``unknown_metrics="keep"``, stays
    as JSON text, and text in a number column fails the load.
    """
    flat = reshape.flatten(reshape.split_results(records))
    if metric_types is None and numeric_text is None:
        metric_types, numeric_text = reshape.discover_shape(flat)
    wide = reshape.expand_metrics(flat, metric_types, unknown_metrics)
    if numeric_text is None:
        numeric_text = numeric_text_columns(wide)
    numeric = reshape.null_non_finite(reshape.coalesce_duplicates(reshape.cast_numbers(wide, numeric_text)))
    wanted = [fv.LEVEL_IDS[level], "date_start", "date_stop", *(b.strip() for b in breakdowns if b.strip())]
    complete = reshape.ensure_columns(numeric, {c: "string" for c in wanted})
    return apply_field_map(reshape.fill_numbers(complete, keep_nulls), fields)


def load_facts(
    spark: SparkSession,
    records: DataFrame,
    level: str,
    database: str,
    order: Sequence[str],
    breakdowns: Sequence[str] = (),
    fields: FieldMap | None = None,
    days: Sequence[date] | None = None,
    buckets: int = 0,
    **known: object,
) -> str:
    """Normalise and upsert delivery records; returns the table written.

    ``days`` spares the job that finds them. Rows are keyed by entity, day and whatever breakdowns there are. A new
    table is bucketed by its entity if ``buckets`` says into how many.
    """
    table = f"{database}.{fact_table_name(level, breakdowns)}"
    facts = normalise_facts(records, level, breakdowns, fields, **known)
    dates = {c: F.to_date(quoted(c)) for c in ("date_start", "date_stop")}
    keys = [fv.LEVEL_IDS[level], "date_start", *(column_name(b) for b in breakdowns if b.strip())]
    layout = layout_of(table, buckets, keys)
    upsert_table(spark, facts.withColumns(dates), table, order, keys, days=days, layout=layout)
    return table


def _between(records: DataFrame, first: date | str, last: date | str) -> DataFrame:
    """Records of some days. A day that can't be read fails the job, as it does in a load of all days.

    Days that are stored as dates are a filter for the scan. Texts are not: any of them may be unreadable.
    """
    raw = F.col("date_start")
    near = F.lit(True)
    if isinstance(records.schema["date_start"].dataType, T.DateType):
        near = raw.between(F.lit(str(first)).cast("date"), F.lit(str(last)).cast("date"))
    day = raw.try_cast("date")
    shown = F.coalesce(raw.cast("string"), F.lit("NULL"))
    failed = F.raise_error(F.concat(F.lit("date_start is no date: "), shown)).cast("date")
    read = records.where(near | raw.isNull()).withColumn("_day", F.coalesce(day, failed))
    return read.where(windows.within(first, last, "_day"))


def load_range(
    spark: SparkSession,
    records: DataFrame,
    level: str,
    database: str,
    order: Sequence[str],
    first: date | str,
    last: date | str,
    days: int = 7,
    profile: str | None = None,
    breakdowns: Sequence[str] = (),
    fields: FieldMap | None = None,
    force: bool = False,
    windows_per_job: int = WINDOWS_PER_JOB,
    **known: object,
) -> DataFrame:
    """Load the windows of a range that are not marked complete, and mark them once they are written.

    A job takes ``windows_per_job`` of them, and a failure costs only the
    windows of its job. The records are read once per job, so they should be
    stored by day. Returns the windows loaded with the rows stored for each.
    A failed write marks nothing.
    """
    checkpoint_table = f"{database}.{fv.CHECKPOINT}"
    if not spark.catalog.tableExists(checkpoint_table):
        write_table(spark.createDataFrame([], fv.DECLARED[fv.CHECKPOINT]), checkpoint_table)
    checkpoint = spark.table(checkpoint_table)
    bounds = spark.sql("SELECT CAST(:first AS DATE) first, CAST(:last AS DATE) last", {"first": str(first), "last": str(last)})
    done = windows.completed_windows(checkpoint, level, profile, breakdowns)
    todo = windows.remaining_windows(windows.date_windows(bounds, days), done, force)
    # As short as the calendar, and fixed before the checkpoint it was derived from changes.
    listed = sorted(todo.collect())
    loaded = spark.createDataFrame([], "since DATE, until DATE, rows_loaded BIGINT")
    for start in range(0, len(listed), windows_per_job):
        part = listed[start : start + windows_per_job]
        due = [since + timedelta(n) for since, until in part for n in range((until - since).days + 1)]
        chosen_windows = spark.createDataFrame(part, "since DATE, until DATE")
        chosen = windows.in_windows(_between(records, due[0], due[-1]), chosen_windows, "_day").drop("_day")
        table = load_facts(spark, chosen, level, database, order, breakdowns, fields, due, **known)
        stored = spark.table(table).where(windows.within(due[0], due[-1]))
        counted = spark.createDataFrame(windows.rows_per_window(stored, chosen_windows).collect(), loaded.schema)
        marks = windows.mark_completed(checkpoint.limit(0), counted, level, profile, breakdowns)
        upsert_table(spark, marks, checkpoint_table, order=["completed_at"])
        loaded = loaded.unionByName(counted)
    return loaded


def load_rolling(
    spark: SparkSession,
    records: DataFrame,
    level: str,
    database: str,
    order: Sequence[str],
    today: date,
    days_back: int = 7,
    include_today: bool = False,
    **options: object,
) -> DataFrame:
    """Reload the last days whether or not they were loaded before, so late data is taken up."""
    first, last = windows.rolling_range(today, days_back, include_today)
    span = (last - first).days + 1
    return load_range(spark, records, level, database, order, first, last, span, force=True, **options)


def load_preset(
    spark: SparkSession,
    records: DataFrame,
    level: str,
    database: str,
    order: Sequence[str],
    today: date,
    preset: str = "yesterday",
    csv_path: str | None = None,
    breakdowns: Sequence[str] = (),
    **options: object,
) -> str:
    """Load the days of a named snapshot; no windows are marked. ``csv_path`` gets a copy of those rows."""
    first, last = windows.preset_range(preset, today)
    chosen = _between(records, first, last).drop("_day")
    due = [first + timedelta(n) for n in range((last - first).days + 1)]
    table = load_facts(spark, chosen, level, database, order, breakdowns, days=due, **options)
    if csv_path:
        landed.write_csv(spark.table(table).where(windows.within(first, last)), csv_path)
    return table


def replay_facts(
    spark: SparkSession,
    raw: DataFrame,
    level: str,
    database: str,
    breakdowns: Sequence[str] | None = None,
    fields: FieldMap | None = None,
    from_date: str | None = None,
    to_date: str | None = None,
    limit: int | None = None,
    **known: object,
) -> str:
    """Load facts again from their raw payloads; the raw id says which payload of a key is newest.

    Of raw rows kept by level and day only those asked for are read, and only the newest payload of a key is decoded.
    """
    rows = landed.replay_insights(raw, level, breakdowns, from_date, to_date, limit)
    chosen = landed.single_breakdown(rows) if breakdowns is None else breakdowns
    keys = [fv.LEVEL_IDS[level], "date_start", *(b.strip() for b in chosen if b.strip())]
    if _kept_as_is(fields, *keys):
        rows = landed.newest_payloads(rows, keys)
    records = landed.decode_payload(rows, landed.insight_schema(level, chosen))
    return load_facts(spark, records, level, database, ["_raw_id"], chosen, fields, **known)


@dataclass(frozen=True)
class Dimension:
    """How records of an entity become rows of its table."""

    feed: str
    table: str
    id_column: str
    name_column: str
    timestamps: tuple[str, ...] = ()
    images: Mapping[str, str] = field(default_factory=dict)
    keep_first: bool = False


# Feeds, tables and columns per entity.
DIMENSIONS = {
    "accounts": Dimension("accounts-info", fv.ACCOUNTS, "id", "account_name", ("created_time",)),
    "campaigns": Dimension(
        "campaigns-info", fv.CAMPAIGNS, "campaign_id", "campaign_name", ("created_time", "start_time", "stop_time")
    ),
    "adsets": Dimension("adsets-info", fv.ADSETS, "adset_id", "adset_name", ("created_time", "start_time", "end_time")),
    "ads": Dimension("ads-info", fv.ADS, "ad_id", "ad_name", ("created_time", "updated_time")),
    "creatives": Dimension(
        "creatives-info", fv.CREATIVES, "creative_id", "creative_name",
        images={"asset_feed_spec_image_url": "url", "asset_feed_spec_image_hash": "hash"}, keep_first=True,
    ),
    "ad-previews": Dimension("ads-info", fv.ADS, "ad_id", "ad_name", ("created_time", "updated_time")),
}
IMAGE_LIST = "asset_feed_spec.images"


def shape_dimension(
    records: DataFrame, entity: str, fields: FieldMap | None = None, statuses: Sequence[str] = ()
) -> DataFrame:
    """Entity records flattened, named and with their times read; numbers are still text."""
    plan = DIMENSIONS[entity]
    rows = records.where(F.col("effective_status").isin(list(statuses))) if statuses else records
    flat = reshape.rename_if_absent(reshape.flatten(rows), {"id": plan.id_column, "name": plan.name_column})
    flat = reshape.first_element(flat, IMAGE_LIST, plan.images)
    mapped = apply_field_map(flat, fields)
    times = {c: to_utc_timestamp(quoted(c).cast("string")) for c in plan.timestamps if c in mapped.columns}
    return mapped.withColumns(times) if times else mapped


def normalise_dimension(
    records: DataFrame,
    entity: str,
    fields: FieldMap | None = None,
    statuses: Sequence[str] = (),
    numeric_text: Iterable[str] | None = None,
) -> DataFrame:
    """Entity records to rows of their dimension, optionally only those of some effective statuses."""
    shaped = shape_dimension(records, entity, fields, statuses)
    if numeric_text is None:
        numeric_text = numeric_text_columns(shaped)
    return reshape.fill_numbers(reshape.cast_numbers(shaped, numeric_text))


def load_dimension(
    spark: SparkSession,
    records: DataFrame,
    entity: str,
    database: str,
    order: Sequence[str],
    csv_path: str | None = None,
    buckets: int = 0,
    **options: object,
) -> str:
    """Normalise and upsert one entity; ads also seed the creatives they name. ``csv_path`` gets a copy of the rows.

    The records are read once: shaped, profiled and staged by one job, and all else reads the stage. New tables are
    bucketed by their key if ``buckets`` says into how many.
    """
    plan = DIMENSIONS[entity]
    rows, path = _staged_dimension(records, entity, **options)
    if plan.keep_first:
        rows = keep_first(rows, [plan.id_column], order)
    if csv_path:
        landed.write_csv(stored_columns(rows), csv_path)
    table = _store_dimension(spark, rows, plan, database, order, buckets)
    drop_stage(spark, path)
    return table


def _staged_dimension(
    records: DataFrame, entity: str, numeric_text: Iterable[str] | None = None, **options: object
) -> tuple[DataFrame, str]:
    """Normalised rows read from a stage, and where that is."""
    shaped = shape_dimension(records, entity, **options)
    untyped = {f.name: quoted(f.name).cast("string") for f in shaped.schema if isinstance(f.dataType, T.NullType)}
    observed, numeric = observed_profile(shaped.withColumns(untyped) if untyped else shaped)
    path = write_stage(observed, f"dim-{entity}")
    staged = records.sparkSession.read.schema(observed.schema).parquet(path)
    known = numeric() if numeric_text is None else numeric_text
    return reshape.fill_numbers(reshape.cast_numbers(staged, known)), path


def _store_dimension(
    spark: SparkSession, rows: DataFrame, plan: Dimension, database: str, order: Sequence[str], buckets: int = 0
) -> str:
    table = f"{database}.{plan.table}"
    upsert_table(spark, rows, table, order, fv.NATURAL_KEYS[plan.table], layout=layout_of(table, buckets))
    if plan.table == fv.ADS:
        creatives = f"{database}.{fv.CREATIVES}"
        upsert_table(spark, creatives_of_ads(rows, order), creatives, None, layout=layout_of(creatives, buckets))
    return table


def replay_dimension(
    spark: SparkSession, raw: DataFrame, entity: str, database: str, limit: int | None = None, **options: object
) -> str:
    """Load a dimension again from its raw payloads, the newest of each key; only those are decoded.

    Entities without declared fields take those found in the payloads, by one job.
    """
    plan = DIMENSIONS[entity]
    rows = landed.first_ids(raw, limit)
    schema = landed.entity_schema(entity) if entity in fv.ENTITY_FIELDS else landed.payload_schema(rows)
    key = plan.id_column if plan.id_column in schema.names else "id"
    if _kept_as_is(options.get("fields"), plan.id_column, key) and not options.get("statuses"):
        rows = landed.newest_payloads(rows, [key])
    records, path = _staged_dimension(landed.decode_payload(rows, schema), entity, **options)
    table = _store_dimension(spark, records, plan, database, ["_raw_id"])
    drop_stage(spark, path)
    return table


def _kept_as_is(fields: FieldMap | None, *names: str) -> bool:
    """Whether a field map leaves these fields under their names and gives none of the names to another field."""
    if fields is None:
        return True
    hidden = fields.excluded | fields.pending
    return not any(n in hidden or fields.renames.get(n, n) != n for n in names) and not any(
        new in names and old != new for old, new in fields.renames.items()
    )


def stored_columns(df: DataFrame) -> DataFrame:
    return df.select(*[quoted(c) for c in df.columns if not is_bookkeeping(c)])


def distinct_records(df: DataFrame) -> DataFrame:
    """Full-row distinct over the stored columns."""
    return stored_columns(df).dropDuplicates()


def full_view(spark: SparkSession, database: str) -> DataFrame:
    """The star join over a database; campaigns and ad sets take part if they exist."""

    def table(name: str) -> DataFrame | None:
        return spark.table(f"{database}.{name}") if spark.catalog.tableExists(f"{database}.{name}") else None

    required = [table(n) for n in (fv.AD_FACT, fv.ACCOUNTS, fv.ADS, fv.CREATIVES)]
    if any(t is None for t in required):
        raise ValueError(f"the full view needs {fv.AD_FACT}, {fv.ACCOUNTS}, {fv.ADS} and {fv.CREATIVES}")
    return star_view(*required, table(fv.CAMPAIGNS), table(fv.ADSETS))


def create_full_view(spark: SparkSession, database: str) -> bool:
    """Define the database's view, which reads its tables by name; False while a required table is missing.

    It stays readable after any later load; columns that tables gain show once it is defined anew.
    """
    names = {
        "fact": fv.AD_FACT, "accounts": fv.ACCOUNTS, "ads": fv.ADS, "creatives": fv.CREATIVES,
        "campaigns": fv.CAMPAIGNS, "adsets": fv.ADSETS,
    }
    stored = {n: f"{database}.{table}" for n, table in names.items() if spark.catalog.tableExists(f"{database}.{table}")}
    if not {"fact", "accounts", "ads", "creatives"} <= set(stored):
        return False
    columns = {n: spark.table(table).columns for n, table in stored.items()}
    spark.sql(f"CREATE OR REPLACE VIEW {database}.{fv.FULL_VIEW} AS {star_sql(stored, columns)}")
    return True


#: The month of a combined row, by which that table is kept: a day's rows are too few for files of their own.
COMBINED_MONTH = "date_month"
_COMBINED = "combined"
#: For each dimension of the view, the fact's column that holds its key.
_FACT_KEYS = {fv.ADS: "ad_id", fv.CAMPAIGNS: "campaign_id", fv.ADSETS: "adset_id", fv.ACCOUNTS: "account_id"}


def materialise_combined(spark: SparkSession, database: str, mirror: str | None = None) -> int:
    """Keep the full view as a table, mirror it if asked, and return its row count.

    The table is kept by month. Once it stands, only months are written anew that hold a changed day of the fact, or a
    fact row whose account, ad, creative, campaign or ad set changed; all other months keep their files. What changed
    comes from the database's ledger. The whole table is written where columns changed or a table was replaced whole.
    """
    table = f"{database}.{fv.COMBINED}"
    changes.start(spark, database)
    sources = [fv.AD_FACT, *_FACT_KEYS, fv.CREATIVES]
    present = [n for n in sources if spark.catalog.tableExists(f"{database}.{n}")]
    due, before = changes.owed(spark, database, _COMBINED, present), changes.logged(spark, database)
    view = full_view(spark, database)
    rows = view.withColumn(COMBINED_MONTH, F.trunc(F.col(fv.DATE_PARTITION).cast("date"), "MM"))
    months = _months_due(spark, database, due, table, rows)
    if months is None:
        replace_table(rows, table, layout=Layout((COMBINED_MONTH,), tuple(fv.FACT_CLUSTER)))
    elif months:
        replace_days(rows, table, months)
    for name in present:
        changes.take(spark, database, _COMBINED, name, before if due[name] is None else due[name], whole=due[name] is None)
    changes.prune(spark, database)
    if mirror:
        sync_tables(spark, database, mirror, [fv.COMBINED], create=True, owed=True)
    return spark.table(table).count()


def _months_due(
    spark: SparkSession, database: str, due: Mapping[str, list | None], table: str, rows: DataFrame
) -> set[date] | None:
    """Months of the combined table to be written anew, None for all of them."""
    whole = any(entries is None or any(e.day is None and not e.has_keys for e in entries) for entries in due.values())
    if whole or not spark.catalog.tableExists(table) or set(spark.table(table).columns) != set(rows.columns):
        return None
    months = {e.day.replace(day=1) for e in due[fv.AD_FACT]}
    fact = spark.table(f"{database}.{fv.AD_FACT}")
    touched = []
    for name, entries in due.items():
        if not entries or name == fv.AD_FACT:
            continue
        keys = changes.changed_keys(spark, database, entries)
        column = _FACT_KEYS.get(name, "ad_id")
        if name == fv.CREATIVES:
            ads = spark.table(f"{database}.{fv.ADS}")
            keys = ads.join(keys, ads["creative_id"] == keys["key"], "left_semi").select(F.col("ad_id").alias("key"))
        elif name == fv.ACCOUNTS:
            keys = keys.select(without_prefix(F.col("key")).alias("key"))
        if column in fact.columns:
            hit = fact.join(keys, fact[column] == keys["key"], "left_semi")
            touched.append(hit.select(F.trunc(F.col(fv.DATE_PARTITION).cast("date"), "MM").alias("month")))
    if touched:
        # Bounded by the calendar.
        months |= {r[0] for r in reduce(DataFrame.union, touched).distinct().collect()}
    return None if None in months else months
