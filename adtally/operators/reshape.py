"""Nested delivery records to wide tables."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from adtally.functions.coerce import strict_number
from adtally.functions.names import is_bookkeeping, is_id_column, quoted

METRIC_KEYS = {"action_type", "indicator"}
#: Metric types of one list that become columns, at most. More are a vocabulary, which belongs into a map or long rows.
MOST_TYPES = 2000


def flatten(df: DataFrame) -> DataFrame:
    """Structs at any depth become columns with dotted names; lists stay as they are."""
    return df.select(*_leaves(df.schema, None, ""))


def _leaves(schema: T.StructType, parent: Column | None, prefix: str) -> list[Column]:
    leaves = []
    for field in schema:
        value = quoted(field.name) if parent is None else parent.getField(field.name)
        name = prefix + field.name
        if isinstance(field.dataType, T.StructType):
            leaves += _leaves(field.dataType, value, name + ".")
        else:
            leaves.append(value.alias(name))
    return leaves


def metric_lists(df: DataFrame) -> list[str]:
    """Columns holding lists of ``{action_type or indicator, value}``."""
    return [
        f.name
        for f in df.schema
        if isinstance(f.dataType, T.ArrayType)
        and isinstance(f.dataType.elementType, T.StructType)
        and METRIC_KEYS & set(f.dataType.elementType.names)
    ]


def expand_metrics(
    df: DataFrame, keys: Mapping[str, Iterable[str]] | None = None, unknown: str = "fail"
) -> DataFrame:
    """One column ``<list>_<type>`` per metric type; within a list the last item of a type wins.

    ``keys`` gives the types per list column. Without it one aggregation job
    finds them: types are counted down per task before anything is shuffled,
    and only the distinct ones, which become columns, reach the driver.
    A list column with no types at all is kept. Types that ``keys`` lacks fail
    the job, or go to ``<list>_other``: with ``unknown="keep"`` as JSON text,
    with ``unknown="map"`` as a MAP from type to value, which takes any
    vocabulary; nothing is looked for then, and without ``keys`` all types go there.
    """
    if unknown not in ("fail", "keep", "map"):
        raise ValueError(f"unknown is 'fail', 'keep' or 'map', not {unknown!r}")
    lists = metric_lists(df)
    given = keys is not None or unknown == "map"
    if keys is None:
        keys = {} if unknown == "map" else discover_metric_types(df, lists)
    wanted = {name: sorted(set(keys.get(name, ()))) for name in lists}
    expanded = [name for name in lists if wanted[name] or unknown == "map"]
    if not expanded:
        return df
    helpers = {f"_{part}_{i}": c for i, name in enumerate(expanded) for part, c in _newest_first(df, name).items()}
    kept = [name for name in df.columns if name not in expanded]
    if given and unknown == "fail":
        for i, name in enumerate(expanded):
            helpers[f"_types_{i}"] = _only_known(helpers[f"_types_{i}"], name, wanted[name])
    others = [
        _others(i, wanted[name], unknown).alias(f"{name}_other")
        for i, name in enumerate(expanded) if given and unknown != "fail"
    ]
    with_helpers = df.select(*[quoted(n) for n in kept], *[c.alias(n) for n, c in helpers.items()])
    return with_helpers.select(
        *[quoted(n) for n in kept],
        *[
            F.get(quoted(f"_values_{i}"), F.array_position(quoted(f"_types_{i}"), F.lit(key)) - 1).alias(f"{name}_{key}")
            for i, name in enumerate(expanded)
            for key in wanted[name]
        ],
        *others,
    )


def _only_known(types: Column, name: str, wanted: list[str]) -> Column:
    """The types, or a failure that names one the list column should not have."""
    odd = F.array_except(F.array_compact(types), F.array(*[F.lit(w) for w in wanted]))
    message = F.concat(F.lit(f"{name} has a metric type that was not named: "), F.get(odd, F.lit(0)))
    return F.when(F.size(odd) > 0, F.raise_error(message).cast("array<string>")).otherwise(types)


def _others(i: int, wanted: list[str], how: str) -> Column:
    """The types that have no column with their values, as JSON text or as a map; NULL without any."""
    named = F.array(*[F.lit(w) for w in wanted]).cast("array<string>")
    types = F.array_except(F.array_compact(quoted(f"_types_{i}")), named)
    values = F.transform(types, lambda t: F.get(quoted(f"_values_{i}"), F.array_position(quoted(f"_types_{i}"), t) - 1))
    rest = F.map_from_arrays(types, values)
    return F.when(F.size(types) > 0, F.to_json(rest) if how == "keep" else rest)


def _refuse_vocabulary(types: DataFrame, lists: Iterable[str], most: int) -> None:
    """Fail with the number of types of a list that has more than ``most``; counted where they are."""
    counts = types.groupBy("list").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most).orderBy("list").collect()
    for row in counts:
        raise ValueError(
            f"{row['list']} has {row['n']} metric types, more than {most}: name those to be columns, or keep them in a map"
        )


def discover_metric_types(df: DataFrame, lists: Iterable[str], most: int = MOST_TYPES) -> dict[str, list[str]]:
    """Distinct metric types per list column, from one job over all of them; more than ``most`` of a list fail."""
    lists = list(lists)
    if not lists:
        return {}

    def tagged(name: str) -> Column:
        types = _newest_first(df, name)["types"]
        return F.transform(types, lambda key: F.struct(F.lit(name).alias("list"), key.alias("type")))

    found = (
        df.select(F.explode(F.concat(*[F.coalesce(tagged(n), F.array()) for n in lists])).alias("item"))
        .select("item.list", "item.type")
        .where(F.col("type").isNotNull())
        .distinct()
    )
    types: dict[str, list[str]] = {name: [] for name in lists}
    for row in _bounded(found, lists, most):
        types[row["list"]].append(row["type"])
    return types


def _bounded(found: DataFrame, lists: Iterable[str], most: int) -> list:
    """Rows of different types, no more of a list than ``most``: each task and the driver stop at one more."""
    first = Window.partitionBy("list").orderBy("type")
    rows = found.withColumn("_nth", F.row_number().over(first)).where(F.col("_nth") <= most + 1).collect()
    if any(r["_nth"] > most and r["list"] for r in rows):
        _refuse_vocabulary(found, lists, most)
    return rows


def discover_shape(df: DataFrame, most: int = MOST_TYPES) -> tuple[dict[str, list[str]], list[str]]:
    """Metric types per list column, and the text columns that hold only numbers once the lists are expanded.

    Both decisions come from one job over long rows (list, name, value), which
    are counted per task before the shuffle; one row per column reaches the
    driver. More than ``most`` types of a list fail, before they are columns.
    """
    lists = metric_lists(df)
    texts = [
        F.struct(F.lit("").alias("list"), F.lit(f.name).alias("type"), quoted(f.name).alias("value"))
        for f in df.schema
        if isinstance(f.dataType, T.StringType) and not is_bookkeeping(f.name) and not is_id_column(f.name)
    ]
    parts = [metric_rows(df, name) for name in lists] + ([F.array(*texts)] if texts else [])
    if not parts:
        return {}, []
    items = df.select(F.inline(F.concat(*[F.coalesce(p, F.array()) for p in parts])))
    counted = items.groupBy("list", "type").agg(
        F.count("value").alias("non_null"), F.count(strict_number(F.col("value"))).alias("numeric_like")
    )
    types: dict[str, list[str]] = {name: [] for name in lists}
    numeric = []
    for row in _bounded(counted, lists, max(most, len(texts))):
        if row["list"]:
            types[row["list"]].append(row["type"])
        name = f"{row['list']}_{row['type']}" if row["list"] else row["type"]
        if row["non_null"] and row["non_null"] == row["numeric_like"] and not is_id_column(name):
            numeric.append(name)
    return types, numeric


def expand_metrics_long(df: DataFrame, ids: Iterable[str]) -> DataFrame:
    """The same metrics as rows (ids, list, type, value), for vocabularies too wide for columns."""
    parts = [metric_rows(df, name) for name in metric_lists(df)]
    items = F.explode(F.concat(*[F.coalesce(p, F.array()) for p in parts])).alias("item")
    return df.select(*[quoted(i) for i in ids], items).select(*[quoted(i) for i in ids], "item.*")


def metric_rows(df: DataFrame, name: str) -> Column:
    """A list column as an array of (list, type, value text), the last value of each type."""
    newest = _first_of_each(_newest_first(df, name))
    pairs = F.arrays_zip(newest["types"].alias("t"), newest["values"].cast("array<string>").alias("v"))
    return F.transform(pairs, lambda p: F.struct(F.lit(name).alias("list"), p["t"].alias("type"), p["v"].alias("value")))


def _newest_first(df: DataFrame, name: str) -> dict[str, Column]:
    """Cleaned types and values of a list column, last item first; unnamed items have a NULL type."""
    item = df.schema[name].dataType.elementType

    def cleaned(x: Column) -> Column:
        return F.translate(_label(x, item, "action_type", "indicator"), ":.", "__")

    values = F.transform(quoted(name), lambda x: x["value"]) if "value" in item.names else F.transform(
        quoted(name), lambda x: F.lit(None).cast("string")
    )
    return {"types": F.reverse(F.transform(quoted(name), cleaned)), "values": F.reverse(values)}


def _label(item: Column, item_type: T.StructType, first: str, second: str) -> Column:
    """The first label unless it is empty or absent, else the second as it is."""
    preferred = [F.nullif(item[first].cast("string"), F.lit(""))] if first in item_type.names else []
    fallback = [item[second].cast("string")] if second in item_type.names else []
    return F.coalesce(*preferred, *fallback, F.lit(None).cast("string"))


def _first_of_each(newest: dict[str, Column]) -> dict[str, Column]:
    types = F.array_compact(F.array_distinct(newest["types"]))
    values = F.transform(types, lambda t: F.get(newest["values"], F.array_position(newest["types"], t) - 1))
    return {"types": types, "values": values}


def split_results(df: DataFrame, name: str = "results") -> DataFrame:
    """Replace a results column by comma-joined ``<name>_indicator`` and ``<name>_value`` texts.

    Accepts a list of items, an object (map or struct), a scalar, or JSON text
    of any of the three, which is how a column of mixed shapes is read.
    """
    if name not in df.columns:
        empty = F.lit(None).cast("string")
        return df.select("*", empty.alias(f"{name}_indicator"), empty.alias(f"{name}_value"))
    pairs = _result_pairs(quoted(name), df.schema[name].dataType)
    staged = df.select(*[quoted(c) for c in df.columns if c != name], pairs.alias("_pairs"))

    def joined(part: str) -> Column:
        texts = F.transform(F.col("_pairs"), lambda p: p[part])
        return F.when(F.size("_pairs") > 0, F.array_join(texts, ",")).alias(f"{name}_{part}")

    return staged.select(*[quoted(c) for c in staged.columns if c != "_pairs"], joined("indicator"), joined("value"))


def _result_pairs(c: Column, data_type: T.DataType) -> Column:
    if isinstance(data_type, T.ArrayType):
        return _list_pairs(c, data_type.elementType)
    if isinstance(data_type, T.MapType):
        return _entry_pairs(F.map_entries(c.cast("map<string,string>")))
    if isinstance(data_type, T.StructType):
        # An absent field and a NULL one look alike in a struct; both are left out.
        entries = F.array(*[_pair(F.lit(n), c.getField(n).cast("string")) for n in data_type.names])
        return F.when(c.isNotNull(), F.filter(entries, lambda p: p["value"].isNotNull()))
    if isinstance(data_type, T.StringType):
        return (
            F.when(c.rlike(r"^\s*\["), _list_pairs(F.from_json(c, "array<string>"), data_type))
            .when(c.rlike(r"^\s*\{"), _entry_pairs(F.map_entries(F.from_json(c, "map<string,string>"))))
            .when(c.isNotNull(), F.array(_pair(F.lit("results"), c)))
        )
    return F.when(c.isNotNull(), F.array(_pair(F.lit("results"), c.cast("string"))))


def _pair(indicator: Column, value: Column) -> Column:
    return F.struct(indicator.alias("indicator"), value.alias("value"))


def _entry_pairs(entries: Column) -> Column:
    return F.transform(entries, lambda e: _pair(e["key"], F.coalesce(e["value"], F.lit("0"))))


def _list_pairs(items: Column, item_type: T.DataType) -> Column:
    def from_struct(x: Column) -> Column:
        named = _label(x, item_type, "indicator", "action_type")
        values = [x["value"].cast("string")] if "value" in item_type.names else []
        if "values" in item_type.names and "value" in item_type["values"].dataType.elementType.names:
            values.append(F.get(x["values"], F.lit(0))["value"].cast("string"))
        return _pair(named, F.coalesce(*values, F.lit("0")))

    def from_text(x: Column) -> Column:
        item = F.from_json(x, "indicator STRING, action_type STRING, value STRING, values STRING")
        wrapped = F.filter(
            F.transform(F.from_json(item["values"], "array<string>"), lambda v: F.from_json(v, "map<string,string>")),
            lambda m: F.map_contains_key(m, "value"),
        )
        first = F.get(wrapped, F.lit(0))["value"]
        named = F.coalesce(F.nullif(item["indicator"], F.lit("")), item["action_type"])
        return _pair(named, F.coalesce(item["value"], first, F.lit("0")))

    if isinstance(item_type, T.StringType):
        objects = F.filter(items, lambda x: x.startswith("{"))
        pairs = F.transform(objects, from_text)
    else:
        pairs = F.transform(items, from_struct)
    return F.filter(pairs, lambda p: p["indicator"].isNotNull())


def coalesce_duplicates(df: DataFrame) -> DataFrame:
    """Merge numbered (``c``, ``c.1``, ``c.2``) and equally named columns: first non-NULL, plain names before numbered."""
    positions = [f"c{i}" for i in range(len(df.columns))]
    bases = [re.sub(r"(?<=.)\.\d+$", "", name) for name in df.columns]
    groups: dict[str, list[int]] = {base: [] for base in bases}
    for i in sorted(range(len(bases)), key=lambda i: bases[i] != df.columns[i]):
        groups[bases[i]].append(i)
    if list(groups) == df.columns:
        return df
    types = [f.dataType for f in df.schema]

    def merged(indices: list[int]) -> Column:
        same = len({types[i] for i in indices}) == 1
        return F.coalesce(*[F.col(positions[i]) if same else F.col(positions[i]).cast("string") for i in indices])

    return df.toDF(*positions).select(*[merged(indices).alias(name) for name, indices in groups.items()])


def null_non_finite(df: DataFrame) -> DataFrame:
    """NaN and infinities of floating columns become NULL."""

    def finite(f: T.StructField) -> Column:
        c = quoted(f.name)
        if not isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            return c
        return F.when(~F.isnan(c) & (F.abs(c) != float("inf")), c).alias(f.name)

    return df.select(*[finite(f) for f in df.schema])


def ensure_columns(df: DataFrame, wanted: Mapping[str, str]) -> DataFrame:
    """Add absent columns as NULL of the given type."""
    missing = {n: F.lit(None).cast(t) for n, t in wanted.items() if n not in df.columns}
    return df.withColumns(missing) if missing else df


def rename_if_absent(df: DataFrame, renames: Mapping[str, str]) -> DataFrame:
    """Rename each source column whose new name is not taken."""
    usable = {old: new for old, new in renames.items() if old in df.columns and new not in df.columns}
    return df.withColumnsRenamed(usable) if usable else df


def cast_numbers(df: DataFrame, numeric_text: Iterable[str]) -> DataFrame:
    """Turn the text columns a profile found numeric into DOUBLE; blank is missing, other text fails the job."""
    numeric_text = set(numeric_text)

    def cast(f: T.StructField) -> Column:
        if f.name not in numeric_text or not isinstance(f.dataType, T.StringType):
            return quoted(f.name)
        text, number = quoted(f.name), strict_number(quoted(f.name))
        message = F.concat(F.lit(f"{f.name} holds text that is no number: "), text)
        # The number is worked out once; only what has none is looked at again.
        odd = F.when(F.trim(text) != "", F.raise_error(message).cast("double"))
        return F.coalesce(number, odd).alias(f.name)

    return df.select(*[cast(f) for f in df.schema])


def fill_numbers(df: DataFrame, keep_nulls: bool = False) -> DataFrame:
    """NULL numbers become 0, ids become clean text, everything else keeps its NULLs.

    Booleans count as numbers 1 and 0, as in the stored tables.
    """

    def filled(f: T.StructField) -> Column:
        c = quoted(f.name)
        if is_bookkeeping(f.name):
            return c
        if is_id_column(f.name):
            return clean_id(c, f.dataType).alias(f.name)
        if isinstance(f.dataType, T.BooleanType):
            c = c.cast("double")
        elif not isinstance(f.dataType, T.NumericType):
            return c
        return (c if keep_nulls else F.coalesce(c, F.lit(0).cast(_number_type(f.dataType)))).alias(f.name)

    return df.select(*[filled(f) for f in df.schema])


def _number_type(data_type: T.DataType) -> T.DataType:
    return T.DoubleType() if isinstance(data_type, T.BooleanType) else data_type


def clean_id(c: Column, data_type: T.DataType) -> Column:
    """Id as text, without the ``.0`` a float column gives whole numbers."""
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        whole = F.when(c == F.floor(c), c.try_cast("decimal(38,0)").cast("string"))
        return F.when(~F.isnan(c), F.coalesce(whole, c.cast("string")))
    if isinstance(data_type, T.NumericType):
        return F.regexp_replace(c.cast("string"), r"\.0+$", "")
    if isinstance(data_type, T.StringType):
        return F.regexp_replace(c, r"^(\d+)\.0+$", "$1")
    return c.cast("string")


def first_element(df: DataFrame, name: str, fields: Mapping[str, str]) -> DataFrame:
    """Columns from the first struct of a list: ``{new column: field}``; NULL for an empty list."""
    if name not in df.columns:
        return df
    return df.withColumns({new: F.get(quoted(name), F.lit(0))[field] for new, field in fields.items()})


def first_non_blank(df: DataFrame, *names: str) -> Column:
    """First value that is neither NULL nor blank among the columns that exist."""
    present = [quoted(n) for n in names if n in df.columns]
    picks = [F.when(F.trim(c.cast("string")) != "", c) for c in present]
    return F.coalesce(*picks) if picks else F.lit(None).cast("string")
