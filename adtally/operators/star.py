"""The star join over daily facts and its reporting variants."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from adtally import fixed_values as fv
from adtally.functions.accounts import without_prefix
from adtally.functions.names import quoted, ticked


def star_view(
    fact: DataFrame,
    accounts: DataFrame,
    ads: DataFrame,
    creatives: DataFrame,
    campaigns: DataFrame | None = None,
    adsets: DataFrame | None = None,
    few_ads: DataFrame | None = None,
) -> DataFrame:
    """Every fact row with the attributes of its account, ad, creative, campaign and ad set.

    Only dimension columns that exist are selected; fact columns outside the
    fixed list follow at the end in name order. Creatives hang off ads, so the
    two are joined first and the fact meets each dimension once. No side is
    forced to broadcast: Spark does so below its size threshold and otherwise
    splits skewed partitions of the fact. ``few_ads``, a bounded number of ids,
    says that the fact has no others; then their ads are sent to it.
    """
    dims = {"accounts": accounts, "ads": ads, "creatives": creatives, "campaigns": campaigns, "adsets": adsets}
    shown, sources = star_columns({n: d.columns for n, d in {"fact": fact, **dims}.items() if d is not None})
    of = {dim: {n: F.coalesce(*map(quoted, cs)) for n, cs in part.items()} for dim, part in sources.items()}

    creative_side = creatives.select(
        F.col("creative_id").alias("_creative"), *[c.alias(n) for n, c in of["creatives"].items()]
    )
    ad_side = ads.select(
        F.col("ad_id").alias("_ad"), F.col("creative_id").alias("_ad_creative"),
        *[c.alias(n) for n, c in of["ads"].items()],
    ).join(creative_side, F.col("_ad_creative") == F.col("_creative"), "left")
    if few_ads is not None:
        ad_side = F.broadcast(ad_side.join(F.broadcast(few_ads), ad_side["_ad"] == few_ads["ad_id"], "left_semi"))
    # The ads come first: a fact bucketed by them is still arranged so.
    joined = fact.join(ad_side, F.col("ad_id") == F.col("_ad"), "left")
    joined = _attach(joined, "account_id", accounts, without_prefix(F.col("id")), of["accounts"])
    if campaigns is not None:
        joined = _attach(joined, "campaign_id", campaigns, F.col("campaign_id"), of["campaigns"])
    if adsets is not None:
        joined = _attach(joined, "adset_id", adsets, F.col("adset_id"), of["adsets"])
    return joined.select(*[quoted(c) for c in shown])


#: Rows of one ad from which star_of_buckets sends its ad to them, and such ads at most.
HOT_ROWS, HOT_ADS = 1_000_000, 10_000


def star_of_buckets(fact: DataFrame, *dims: DataFrame | None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``star_view`` of a fact that is bucketed by its ads, which is joined as it lies, without a shuffle of its rows.

    A bucket can't be split, so ads with more than ``hot_rows`` rows, or a ``HOT_ADS``-th of all if that is more, are
    left out of it: their rows get the few ads they need by broadcast. One count by ad, also without a shuffle, finds
    them.
    """
    counts = fact.groupBy("ad_id").agg(F.count(F.lit(1)).alias("n"))
    least = max(hot_rows, (counts.agg(F.sum("n")).first()[0] or 0) // HOT_ADS)
    found = counts.where((F.col("n") > least) & F.col("ad_id").isNotNull()).select("ad_id").collect()
    if not found:
        return star_view(fact, *dims)
    # At most HOT_ADS ids.
    hot = fact.sparkSession.createDataFrame(found, "ad_id STRING")
    of = hot.select(F.col("ad_id").alias("_hot"))
    cold = fact.join(F.broadcast(of), F.col("ad_id") == F.col("_hot"), "left_anti")
    warm = fact.join(F.broadcast(of), F.col("ad_id") == F.col("_hot"), "left_semi")
    return star_view(cold, *dims).unionByName(star_view(warm, *dims, few_ads=hot))


def star_columns(have: Mapping[str, Sequence[str]]) -> tuple[list[str], dict[str, dict[str, list[str]]]]:
    """The view's columns in order, and for each dimension its names in the view with the columns each comes from.

    ``have`` lists the columns of ``fact`` and of the dimensions that exist. A name takes the first non-NULL of its
    columns; a name with no column is left out.
    """
    picks = {
        "accounts": fv.VIEW_ACCOUNTS, "ads": fv.VIEW_ADS, "creatives": fv.VIEW_CREATIVES,
        "campaigns": fv.VIEW_CAMPAIGNS, "adsets": fv.VIEW_ADSETS,
    }
    of = {dim: {n: [c] for c, n in part.items() if c in have.get(dim, ())} for dim, part in picks.items()}
    found = {n: [c for c in columns if c in have["creatives"]] for n, columns in fv.VIEW_FALLBACKS.items()}
    fallbacks = {n: columns for n, columns in found.items() if columns}
    fixed = [c for c in fv.VIEW_FACT if c in have["fact"]]
    dynamic = sorted(set(have["fact"]) - fv.VIEW_NOT_DYNAMIC)
    names = [n for part in of.values() for n in part] + list(fallbacks)
    clashes = sorted(set(names) & set(fixed + dynamic))
    if clashes:
        raise ValueError(f"fact and dimension columns share names: {clashes}")
    of["creatives"] |= fallbacks
    return [*fixed, *names, *dynamic], of


def star_sql(relations: Mapping[str, str], have: Mapping[str, Sequence[str]]) -> str:
    """The view of ``star_view`` as SQL text over named tables, which a catalog can keep."""
    shown, of = star_columns(have)
    side = {n: "ads" if dim == "creatives" else dim for dim, part in of.items() for n in part}

    def picked(dim: str) -> str:
        sources = {n: ", ".join(f"{dim}.{ticked(c)}" for c in columns) for n, columns in of[dim].items()}
        return "".join(f", coalesce({columns}) AS {ticked(n)}" for n, columns in sources.items())

    account = f"regexp_replace(accounts.id, '^{fv.ACCOUNT_PREFIX}', '')"
    joins = [
        f"LEFT JOIN (SELECT {account} AS _key{picked('accounts')} FROM {relations['accounts']} AS accounts) AS accounts"
        " ON fact.account_id = accounts._key",
        f"LEFT JOIN (SELECT ads.ad_id AS _key{picked('ads')}{picked('creatives')} FROM {relations['ads']} AS ads"
        f" LEFT JOIN {relations['creatives']} AS creatives ON ads.creative_id = creatives.creative_id) AS ads"
        " ON fact.ad_id = ads._key",
    ]
    for dim, key in (("campaigns", "campaign_id"), ("adsets", "adset_id")):
        if dim in relations:
            joins.append(
                f"LEFT JOIN (SELECT {dim}.{key} AS _key{picked(dim)} FROM {relations[dim]} AS {dim}) AS {dim}"
                f" ON fact.{key} = {dim}._key"
            )
    columns = ", ".join(f"{side.get(c, 'fact')}.{ticked(c)}" for c in shown)
    return f"SELECT {columns} FROM {relations['fact']} AS fact {' '.join(joins)}"


def _attach(df: DataFrame, key: str, dim: DataFrame, dim_key: Column, columns: Mapping[str, Column]) -> DataFrame:
    side = dim.select(dim_key.alias(f"_{key}"), *[c.alias(n) for n, c in columns.items()])
    return df.join(side, F.col(key) == F.col(f"_{key}"), "left")


# Which dimensions a delivery level is reported with: (fact column, dimension, its key).
LEVEL_JOINS = {
    "account": ["accounts"],
    "campaign": ["accounts", "campaigns"],
    "adset": ["adsets", "campaigns"],
    "ad": ["accounts", "campaigns", "adsets", "ads"],
}
DIM_KEYS = {
    "accounts": ("account_id", "id"),
    "campaigns": ("campaign_id", "campaign_id"),
    "adsets": ("adset_id", "adset_id"),
    "ads": ("ad_id", "ad_id"),
}


def level_report(fact: DataFrame, level: str, dims: Mapping[str, DataFrame], attributes: Mapping[str, list[str]]) -> DataFrame:
    """A fact of any level with chosen dimension attributes, named ``<dimension>_<attribute>``."""
    report = fact
    for name in LEVEL_JOINS[level]:
        if name not in dims:
            continue
        key, dim_key = DIM_KEYS[name]
        stored = without_prefix(F.col(dim_key)) if name == "accounts" else F.col(dim_key)
        report = _attach(report, key, dims[name], stored, {f"{name}_{a}": quoted(a) for a in attributes.get(name, [])})
    return report.drop(*[f"_{DIM_KEYS[n][0]}" for n in LEVEL_JOINS[level]])


def accounts_with_registry(accounts: DataFrame, registry: DataFrame) -> DataFrame:
    """Accounts, keyed ``account_id``, with the registry's profile, include flag and notes."""
    extra = registry.select("account_id", "profile_name", "include_in_etl", "notes")
    return accounts.withColumnRenamed("id", "account_id").join(extra, "account_id", "left")


def calendar_dim(fact: DataFrame, day: str = fv.DATE_PARTITION) -> DataFrame:
    """One row per day between the first and last fact day, with year and month."""
    bounds = fact.agg(F.min(day).cast("date").alias("first"), F.max(day).cast("date").alias("last"))
    days = bounds.where("first IS NOT NULL").select(F.explode(F.sequence("first", "last")).alias("date"))
    return days.select(
        "date", F.year("date").alias("year"), F.month("date").alias("month_no"),
        F.date_format("date", "MMM yyyy").alias("month"),
    )


def with_calendar(fact: DataFrame, calendar: DataFrame, day: str = fv.DATE_PARTITION) -> DataFrame:
    return fact.join(calendar.withColumnRenamed("date", day), day, "left")


ADDITIVE = ("spend", "social_spend", "impressions", "clicks")


def delivery_rollup(fact: DataFrame, level: str, breakdowns: tuple[str, ...] = ()) -> DataFrame:
    """Daily sums at a coarser level. Reach and unique counts do not add up and are left out.

    ``ctr`` and ``cpm`` follow from the sums. Sums are built per task before
    the shuffle, so an account with a third of the rows sends one row per day
    and task.
    """
    keys = [fv.LEVEL_IDS[level], fv.DATE_PARTITION, *breakdowns]
    sums = {m: F.sum(m).alias(m) for m in ADDITIVE if m in fact.columns}
    rolled = fact.groupBy(*keys).agg(*sums.values())
    if {"clicks", "impressions"} <= set(sums):
        rolled = rolled.withColumn("ctr", _per("clicks", "impressions", 100))
    if {"spend", "impressions"} <= set(sums):
        rolled = rolled.withColumn("cpm", _per("spend", "impressions", 1000))
    return rolled


def _per(part: str, whole: str, scale: int) -> Column:
    return F.try_divide(F.col(part).cast("double") * scale, F.col(whole).cast("double"))
