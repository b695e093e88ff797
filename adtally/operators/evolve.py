"""Schema growth and repair, as projections towards a declared or stored schema."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from adtally.fixed_values import COMBINED, DECLARED
from adtally.functions.coerce import declared_cast, strict_number, to_day
from adtally.functions.names import column_name, is_id_column, keep_head, keep_tail, quoted

DRIFT_SCHEMA = "column_name STRING, expected STRING, found STRING"


def declared_schema(table: str) -> T.StructType:
    """Declared columns of a table; no columns when the table is not declared."""
    return T.StructType.fromDDL(DECLARED[table]) if table in DECLARED else T.StructType([])


def full_schema(df: DataFrame, table: str) -> T.StructType:
    """Declared type of each column, else the type it has."""
    wanted = {f.name: f.dataType for f in declared_schema(table)}
    return T.StructType([T.StructField(f.name, wanted.get(f.name, f.dataType)) for f in df.schema])


def align_declared(df: DataFrame, table: str, extra: str = "keep") -> DataFrame:
    """Declared columns added as NULL and cast; undeclared ones kept or, with ``extra="drop"``, left out."""
    declared = declared_schema(table)
    if not declared:
        return df
    missing = [] if table == COMBINED else [f for f in declared if f.name not in df.columns]
    kept = [n for n in df.columns if extra == "keep" or n in declared.names]
    widened = df.select(*[quoted(n) for n in kept], *[F.lit(None).cast(f.dataType).alias(f.name) for f in missing])
    return declared_cast(widened, declared)


def fit_stored(batch: DataFrame, table: str, stored: T.StructType) -> DataFrame:
    """Batch columns in the types they are stored in: declared ones cast leniently, nested ones for text as JSON."""
    declared = declared_schema(table)
    nested = {f.name for f in batch.schema if is_nested(f.dataType)} - set(declared.names)
    texts = [f for f in stored if f.name in nested and isinstance(f.dataType, T.StringType)]
    return declared_cast(batch, T.StructType([*declared.fields, *texts]))


def json_texts(df: DataFrame) -> DataFrame:
    """Nested columns as JSON text."""
    return declared_cast(df, T.StructType([T.StructField(f.name, T.StringType()) for f in df.schema if is_nested(f.dataType)]))


def stored_name(name: str, existing: Iterable[str]) -> str | None:
    """The existing column that a name already has, also under its two truncations."""
    existing = set(existing)
    return next((n for n in (name, column_name(name), keep_tail(name), keep_head(name)) if n in existing), None)


def is_nested(data_type: T.DataType) -> bool:
    return isinstance(data_type, (T.StructType, T.ArrayType, T.MapType))


def columns_to_add(batch: DataFrame, existing: Iterable[str], table: str = "") -> list[T.StructField]:
    """Declared columns and flat batch columns a stored table lacks; ids are text."""
    existing = set(existing)
    added: dict[str, T.StructField] = {}
    for field in declared_schema(table):
        if stored_name(field.name, existing) is None:
            added[field.name] = T.StructField(field.name, field.dataType)
    for field in batch.schema:
        name = column_name(field.name)
        if stored_name(field.name, existing) or name in added or is_nested(field.dataType):
            continue
        added[name] = T.StructField(name, T.StringType() if is_id_column(name) else field.dataType)
    return list(added.values())


def repair_types(df: DataFrame, table: str = "", to_number: Iterable[str] = ()) -> DataFrame:
    """Stored columns brought to the types later batches need.

    Whole-number ids become text, declared dates become DATE, and the text
    columns in ``to_number`` become DOUBLE with the empty text as NULL.
    """
    dates = {f.name for f in declared_schema(table) if isinstance(f.dataType, T.DateType)}
    to_number = set(to_number)

    def repaired(f: T.StructField) -> Column:
        c = quoted(f.name)
        if is_id_column(f.name) and isinstance(f.dataType, T.IntegralType):
            return c.cast("string").alias(f.name)
        if f.name in dates and not isinstance(f.dataType, T.DateType):
            return to_day(c).alias(f.name)
        if f.name in to_number and isinstance(f.dataType, T.StringType):
            return strict_number(c).alias(f.name)
        return c

    return df.select(*[repaired(f) for f in df.schema])


def type_changes(stored: DataFrame, table: str, batch: DataFrame) -> tuple[list[str], list[str], list[str]]:
    """Columns of ``stored`` whose types the next batch asks to change: whole-number ids, days kept as text, and texts
    that the batch has as numbers. The last two depend on the stored values too; ``unfit_values`` looks at them. Ids that
    are declared as whole numbers stay so."""
    declared = {f.name: f.dataType for f in declared_schema(table)}
    incoming = {f.name: f.dataType for f in batch.schema}
    ids, days, numbers = [], [], []
    for f in stored.schema:
        if is_id_column(f.name):
            if isinstance(f.dataType, T.IntegralType) and not isinstance(declared.get(f.name), T.IntegralType):
                ids.append(f.name)
        elif isinstance(declared.get(f.name), T.DateType):
            if not isinstance(f.dataType, T.DateType):
                days.append(f.name)
        elif isinstance(f.dataType, T.StringType) and not isinstance(declared.get(f.name), T.StringType):
            if isinstance(incoming.get(f.name), T.NumericType):
                numbers.append(f.name)
    return ids, days, numbers


def unfit_values(stored: DataFrame, batch: DataFrame, days: Iterable[str], numbers: Iterable[str]) -> dict[str, str | None]:
    """For each column one value that is no day or no number, None if all are, from one job over both sides.

    Blank texts are missing values.
    """
    rules = {n: to_day for n in days} | {n: strict_number for n in numbers}
    names = list(rules)
    if not names:
        return {}

    def odd(df: DataFrame) -> DataFrame:
        have = set(df.columns)
        texts = [(quoted(n) if n in have else F.lit(None)).cast("string") for n in names]
        unread = [F.when((F.btrim(x) != "") & rules[n](x).isNull(), x) for n, x in zip(names, texts, strict=True)]
        return df.select(*[F.min(u).alias(f"c{i}") for i, u in enumerate(unread)])

    both = odd(stored).unionByName(odd(batch))
    found = both.agg(*[F.min(f"c{i}").alias(f"c{i}") for i in range(len(names))]).first()
    return dict(zip(names, found, strict=True))


def promotable(stored_numeric: Iterable[str], batch_numeric: Iterable[str]) -> list[str]:
    """Text columns that are numeric on both sides; one old text value is enough to stay text."""
    return sorted(set(stored_numeric) & set(batch_numeric))


def schema_drift(spark: SparkSession, expected: T.StructType, found: T.StructType) -> DataFrame:
    """One row per column whose stored type differs from the expected one; absent columns are not drift."""
    have = {f.name: f.dataType.simpleString() for f in found}
    rows = [
        (f.name, f.dataType.simpleString(), have[f.name])
        for f in expected
        if f.name in have and have[f.name] != f.dataType.simpleString()
    ]
    return spark.createDataFrame(rows, DRIFT_SCHEMA)
