"""Daily layer: context, price target and wide fertilizer prices per date and region."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from seriesmill import fixed

DAY_KEYS = ("date_id", "region_id")
CONTEXT_IDS = ("eco_id", "weather_id")
DIM_COLUMNS = {
    "dim_date": ("date_id", ["year", "quarter", "month", "day", "crop_season"]),
    "dim_region": ("region_id", ["region_name"]),
    "dim_rice_type": ("rice_id", ["rice_name", "rice_group", "unit"]),
    "dim_economy": ("eco_id", ["cpi_status", "market_signal", "unit"]),
    "dim_weather": ("weather_id", ["weather_type", "severity_level", "agriculture_impact"]),
}


def _keyed(fact: DataFrame) -> DataFrame:
    # rows without a key belong to no group
    return fact.where(F.col("date_id").isNotNull() & F.col("region_id").isNotNull())


def _context_aggs(fact: DataFrame, order: str) -> list[Column]:
    # "last" has a meaning only along an order column; ids are numbers, so the pair stays in
    # the fixed-width hash aggregate
    ids = [
        F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c)
        for c in CONTEXT_IDS
        if c in fact.columns
    ]
    return ids + [F.avg(c).alias(c) for c in fixed.CONTEXT_MEASURES if c in fact.columns]


def _fert_aggs(fert_ids: Sequence[str]) -> list[Column]:
    return [
        F.avg(F.when(F.col("fert_id") == f, F.col("price_fert"))).alias(f"{fixed.FERT_PREFIX}{f}")
        for f in fert_ids
    ]


def daily_context(fact: DataFrame, order: str) -> DataFrame:
    """Per date and region: last known ids along ``order`` and mean measures."""
    return _keyed(fact).groupBy(*DAY_KEYS).agg(*_context_aggs(fact, order))


def daily_target(fact: DataFrame, rice_ids: Sequence[str] | None = fixed.RICE_IDS) -> DataFrame:
    """Mean price per date, region and wanted variety; ``None`` keeps all varieties."""
    rows = _keyed(fact).where(F.col("rice_id").isNotNull() & F.col("price_rice").isNotNull())
    if rice_ids is not None:
        rows = rows.where(F.col("rice_id").isin(*rice_ids))
    return rows.groupBy(*DAY_KEYS, "rice_id").agg(F.avg("price_rice").alias("price_rice"))


def fertilizer_ids(fact: DataFrame) -> list[str]:
    """Distinct fertilizer ids with a price; one small job, needed only when ids are not given."""
    rows = fact.where(F.col("fert_id").isNotNull() & F.col("price_fert").isNotNull())
    limit = int(fact.sparkSession.conf.get("spark.sql.pivotMaxValues"))
    ids = [r[0] for r in rows.select("fert_id").distinct().orderBy("fert_id").take(limit + 1)]
    if len(ids) > limit:
        raise ValueError(f"more than {limit} fertilizer ids cannot become columns")
    return ids


def fertilizer_wide(fact: DataFrame, fert_ids: Sequence[str] | None = None) -> DataFrame:
    """One mean price column per fertilizer."""
    ids = list(fert_ids) if fert_ids is not None else fertilizer_ids(fact)
    rows = _keyed(fact).where(F.col("fert_id").isNotNull() & F.col("price_fert").isNotNull())
    wide = rows.groupBy(*DAY_KEYS).pivot("fert_id", ids).agg(F.avg("price_fert"))
    return wide.withColumnsRenamed({f: f"{fixed.FERT_PREFIX}{f}" for f in ids})


def daily_facts(
    fact: DataFrame,
    order: str,
    rice_ids: Sequence[str] | None = fixed.RICE_IDS,
    fert_ids: Sequence[str] | None = None,
) -> DataFrame:
    """Target, context and fertilizer columns of every date, region and variety.

    With a list of varieties all three are one aggregate: context and fertilizer means plus one
    conditional mean per variety, then one output row per variety that has a price. The fact is
    read once and shuffled once, after map-side combining. Without a list the three aggregates
    are joined.
    """
    ids = list(fert_ids) if fert_ids is not None else fertilizer_ids(fact)
    if rice_ids is None:
        context = daily_context(fact, order)
        wide = fertilizer_wide(fact, ids)
        keys = list(DAY_KEYS)
        return daily_target(fact, None).join(context, keys, "left").join(wide, keys, "left")

    price_of = [
        F.avg(F.when(F.col("rice_id") == r, F.col("price_rice"))).alias(f"__price_{i}")
        for i, r in enumerate(rice_ids)
    ]
    # conditional means need no row filter: a row without fert_id or price adds nothing
    days = _keyed(fact).groupBy(*DAY_KEYS).agg(
        *price_of, *_context_aggs(fact, order), *_fert_aggs(ids)
    )
    varieties = F.array(
        *[
            F.struct(F.lit(r).alias("rice_id"), F.col(f"__price_{i}").alias("price_rice"))
            for i, r in enumerate(rice_ids)
        ]
    )
    priced = F.filter(varieties, lambda s: s["price_rice"].isNotNull())
    rest = [c for c in days.columns if c not in DAY_KEYS and not c.startswith("__price_")]
    return (
        days.withColumn("__v", F.explode(priced))
        .select(*DAY_KEYS, "__v.rice_id", "__v.price_rice", *rest)
    )


def join_dimension(
    df: DataFrame, dim: DataFrame, key: str, columns: Sequence[str], null_safe: bool = False
) -> DataFrame:
    """Left join of the named dimension columns.

    No broadcast hint: the planner broadcasts a dimension whose size is known to be under
    ``spark.sql.autoBroadcastJoinThreshold`` and otherwise sorts and merges.
    """
    side = dim.select(key, *columns)
    if not null_safe:
        return df.join(side, key, "left")
    side = side.withColumnRenamed(key, f"__{key}")
    return df.join(side, F.col(key).eqNullSafe(F.col(f"__{key}")), "left").drop(f"__{key}")


def with_dimensions(
    daily: DataFrame, source: Mapping[str, DataFrame], null_safe: bool = False
) -> DataFrame:
    """Attach the five dimensions; the economy unit is renamed so that it does not clash."""
    out = daily
    for name, (key, columns) in DIM_COLUMNS.items():
        dim = source[name]
        if name == "dim_economy":
            dim = dim.withColumnRenamed("unit", "economy_unit")
            columns = ["economy_unit" if c == "unit" else c for c in columns]
        out = join_dimension(out, dim, key, columns, null_safe and key in CONTEXT_IDS)
    return out


def daily_model_base(
    source: Mapping[str, DataFrame],
    order: str,
    rice_ids: Sequence[str] | None = fixed.RICE_IDS,
    fert_ids: Sequence[str] | None = None,
    null_safe: bool = False,
) -> DataFrame:
    """Daily base: facts of every date, region and variety with their dimensions.

    Expects cleaned tables (``sources.star.clean_tables``).
    """
    facts = daily_facts(source["fact"], order, rice_ids, fert_ids)
    return with_dimensions(facts, source, null_safe)


def repeated_dimension_keys(source: Mapping[str, DataFrame]) -> DataFrame:
    """Dimension keys that occur more than once; any row here would multiply the daily base."""
    parts = [
        source[name]
        .groupBy(F.lit(name).alias("dimension"), F.col(key).cast("string").alias("key"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .where(F.col("n_rows") > 1)
        for name, (key, _) in DIM_COLUMNS.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
