"""Ledger operators: sums by group, history by month offset, trend statistics, wide features.

History is computed from the rows that exist: each row knows its month offset to the report month,
so lags and leads are conditional sums in one aggregation. A missing combination is zero.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgercast.dimensions import Dimensions
from ledgercast.functions.bucket import client_bucket
from ledgercast.functions.calendar import month_index
from ledgercast.functions.money import from_units, units, units_as
from ledgercast.functions.trend import STATISTICS, base_statistics, derived_statistics, history_columns
from ledgercast.operators.cohort import cohort_filter_ledger, with_cohort_month
from ledgercast.plans.cohort_plan import LEDGER_WINDOW, CohortPlan
from ledgercast.sources.local_table import broadcast_if_small

KEYS = ["epk_id", "report_dt"]


# -- filters and dimension joins -----------------------------------------------------------------


def keep_sample(df: DataFrame, sample: DataFrame | None) -> DataFrame:
    """Rows of the sampled clients. A client listed twice does not repeat its rows.

    Put it behind an aggregation by client: with a small sample the optimizer pushes the join
    below the aggregation as a broadcast, with a large one only combined rows are shuffled.
    """
    if sample is None:
        return df
    return df.join(sample.select("epk_id").distinct(), "epk_id", "left_semi")


def product_allowlist(ledger: DataFrame, dims: Dimensions) -> DataFrame:
    return ledger.where(F.col("product_cd").isin(dims.product_codes))


def map_products(df: DataFrame, dims: Dimensions, how: str = "left") -> DataFrame:
    dim = dims.product_dim(df.sparkSession)
    return df.join(broadcast_if_small(dim, len(dims.product_codes)), "product_cd", how)


def map_items(df: DataFrame, dims: Dimensions) -> DataFrame:
    """A code outside every group keeps its rows with a null item."""
    dim = dims.item_dim(df.sparkSession)
    return df.join(broadcast_if_small(dim, sum(map(len, dims.items.values()))), "pl_item", "left")


# -- sums ----------------------------------------------------------------------------------------


def ledger_sum_by_code(ledger: DataFrame) -> DataFrame:
    return ledger.groupBy("epk_id", "product_cd", "report_dt", "pl_item").agg(
        from_units(F.sum(units(F.col("pl_val")))).alias("pl_value")
    )


def ledger_sum_by_group(ledger: DataFrame, dims: Dimensions) -> DataFrame:
    """Sums by client, product, item and month.

    Codes become groups before the aggregation: the lookups are map-side, and one shuffle of
    partial sums does what sums by code followed by sums by group need two for.
    """
    mapped = map_items(map_products(ledger, dims, "inner"), dims)
    return mapped.groupBy("epk_id", "product", "item", "report_dt").agg(
        from_units(F.sum(units(F.col("pl_val")))).alias("pl_value")
    )


def filtered_ledger(
    ledger: DataFrame, plan: CohortPlan, dims: Dimensions, sample: DataFrame | None = None
) -> DataFrame:
    return keep_sample(ledger_sum_by_group(cohort_filter_ledger(ledger, plan), dims), sample)


def distinct_clients(ledger: DataFrame) -> DataFrame:
    return ledger.select("epk_id").distinct()


def product_month_total(sums: DataFrame) -> DataFrame:
    """Product total per client and month over the mapped items."""
    return (
        sums.where(F.col("item").isNotNull())
        .groupBy("epk_id", "product", "report_dt")
        .agg(from_units(F.sum(units(F.col("pl_value").cast("decimal(18,4)")))).alias("pl_total"))
    )


def ledger_sort(sums: DataFrame) -> DataFrame:
    """Sorted files without a global sort: a client's rows sit together, in order."""
    return sums.repartition("epk_id").sortWithinPartitions("epk_id", "product", "item", "report_dt")


# -- dense form ----------------------------------------------------------------------------------


def attribute_grid(spark: SparkSession, months: DataFrame, dims: Dimensions) -> DataFrame:
    """Every product, item and month."""
    names = lambda values: F.array(*[F.lit(v) for v in values])
    return months.select(
        F.explode(names(dims.product_names)).alias("product"), "report_dt"
    ).select("product", F.explode(names(dims.item_names)).alias("item"), "report_dt")


def client_grid(clients: DataFrame, plan: CohortPlan, dims: Dimensions) -> DataFrame:
    """Every product, item and wanted month of each client.

    Each client expands only into the months of its own cells, so nothing is generated and then
    filtered out.
    """
    spark = clients.sparkSession
    windows = plan.bucket_windows_frame(spark, LEDGER_WINDOW)
    months = (
        clients.withColumn("bucket", client_bucket(F.col("epk_id"), plan.buckets, plan.hash_kind))
        .join(broadcast_if_small(windows, plan.lookup_rows()), "bucket")
        .select("epk_id", F.explode(F.sequence("win_lo", "win_hi", F.expr("interval 1 month"))).alias("m"))
        .select("epk_id", F.last_day("m").alias("report_dt"))
    )
    if len({plan.window(cell) for cell in plan.cells}) > 1:
        months = months.distinct()
    names = lambda values: F.array(*[F.lit(v) for v in values])
    return months.select(
        "epk_id", F.explode(names(dims.product_names)).alias("product"), "report_dt"
    ).select("epk_id", "product", F.explode(names(dims.item_names)).alias("item"), "report_dt")


def densify_ledger(grid: DataFrame, sums: DataFrame) -> DataFrame:
    keys = ["epk_id", "product", "item", "report_dt"]
    return grid.join(sums, keys, "left").select(*keys, F.coalesce("pl_value", F.lit(0.0)).alias("pl_value"))


def complete_windows_only(grid: DataFrame, plan: CohortPlan) -> DataFrame:
    """Grid rows whose month has its full history and future inside the client's months.

    In the dense grid those are the rows without an empty lag or lead.
    """
    lookup = plan.bucket_windows_frame(grid.sparkSession, LEDGER_WINDOW)
    month = month_index(F.col("report_dt"))
    whole = (
        (F.col("_bucket") == F.col("bucket"))
        & (month - (plan.history - 1) >= month_index(F.col("win_lo")))
        & (month + plan.predict <= month_index(F.col("win_hi")))
    )
    return (
        grid.withColumn("_bucket", client_bucket(F.col("epk_id"), plan.buckets, plan.hash_kind))
        .join(broadcast_if_small(lookup, plan.lookup_rows()), whole, "left_semi")
        .drop("_bucket")
    )


# -- sparse history ------------------------------------------------------------------------------


def cohort_rows(ledger: DataFrame, plan: CohortPlan, dims: Dimensions) -> DataFrame:
    """Ledger rows of the plan with groups, report month and offset; no shuffle."""
    mapped = map_items(map_products(with_cohort_month(ledger, plan), dims, "inner"), dims)
    return mapped.select(
        "epk_id", F.col("cohort_dt").alias("report_dt"), "product", "item", "offset", units(F.col("pl_val")).alias("v")
    )


def _sum_at(condition) -> F.Column:
    return F.coalesce(F.sum(F.when(condition, F.col("v"))), F.lit(0).cast("long"))


def history_units(rows: DataFrame, plan: CohortPlan, each_month: bool) -> DataFrame:
    """Lags and leads by client, report month, product and item, in money units.

    ``h_k`` is the sum k months back (1 = the report month), ``f_m`` the sum m months ahead;
    without ``each_month`` the future is one column ``f_sum``. Sums combine before the shuffle, so
    a client with very many rows costs one row per map task.
    """
    offset = F.col("offset")
    sums = [_sum_at(offset == 1 - k).alias(f"h_{k}") for k in range(1, plan.history + 1)]
    if each_month:
        sums += [_sum_at(offset == m).alias(f"f_{m}") for m in range(1, plan.predict + 1)]
    elif plan.predict > 0:
        sums += [_sum_at(offset > 0).alias("f_sum")]
    return rows.groupBy("epk_id", "report_dt", "product", "item").agg(*sums)


def item_history(history: DataFrame, plan: CohortPlan) -> DataFrame:
    """``item_-H`` … ``item_-1`` of each mapped item, as DOUBLE."""
    lags = [from_units(F.col(f"h_{k}")).alias(f"item_-{k}") for k in range(plan.history, 0, -1)]
    others = [c for c in history.columns if not c.startswith("h_") and c not in KEYS + ["product", "item"]]
    keep_newest = [F.col("h_1")] if "h_1" in history.columns else []
    return history.select(*KEYS, "product", "item", *lags, *keep_newest, *others)


def trend_stats(df: DataFrame, history: int) -> DataFrame:
    """Add the ten statistics; nothing for a history of one month."""
    return df.withColumns(base_statistics(history)).withColumns(derived_statistics(history)) if history > 1 else df


def windowed_ledger(ledger: DataFrame, plan: CohortPlan, dims: Dimensions) -> DataFrame:
    """History, statistics and product leads per client, report month, product and item."""
    history = history_units(cohort_rows(ledger, plan, dims), plan, each_month=True).where("item is not null")
    stats = trend_stats(item_history(history, plan), plan.history)
    return stats.select(*KEYS, "product", "item", *[f"`{c}`" for c in measures(plan)])


def measures(plan: CohortPlan) -> list[str]:
    """The measures of one product and item: lags, then statistics."""
    return history_columns(plan.history) + (STATISTICS if plan.history > 1 else [])


def product_leads(rows: DataFrame, plan: CohortPlan) -> DataFrame:
    """Product totals ``pl_-1`` (report month), ``pl_0`` … ``pl_{P-1}`` over the mapped items."""
    offset = F.col("offset")
    sums = [from_units(_sum_at(offset == m)).alias(f"pl_{m - 1}") for m in range(plan.predict + 1)]
    return rows.where(F.col("item").isNotNull()).groupBy(*KEYS, "product").agg(*sums)


def product_outcomes(rows: DataFrame, plan: CohortPlan) -> DataFrame:
    """``pl_-1`` and ``pl_target`` per client, report month and product: the lean long form."""
    offset = F.col("offset")
    sums = [from_units(_sum_at(offset == 0)).alias("pl_-1")]
    if plan.predict > 0:
        sums.append(from_units(_sum_at(offset > 0)).alias("pl_target"))
    return rows.where(F.col("item").isNotNull()).groupBy(*KEYS, "product").agg(*sums)


# -- pivots --------------------------------------------------------------------------------------


def pivot_items(windowed: DataFrame, plan: CohortPlan, dims: Dimensions) -> DataFrame:
    """One row per client, month and product: ``{item}_{-k}`` and ``{item}_{statistic}``."""
    columns = {c: short_name(c) for c in measures(plan)}
    return _turned(windowed, KEYS + ["product"], "item", dims.item_names, columns)


def pivot_products(by_product: DataFrame, dims: Dimensions) -> DataFrame:
    """One row per client and month: every measure prefixed with its product."""
    columns = {c: c for c in by_product.columns if c not in KEYS + ["product"]}
    return _turned(by_product, KEYS, "product", dims.product_names, columns)


def _turned(long: DataFrame, keys: list[str], by: str, names: list[str], columns: dict[str, str]) -> DataFrame:
    """A row per ``keys`` with ``{name}_{column}`` for every name in ``by``; what is missing is zero.

    The rows of a key meet in one map, read as wide columns behind the exchange: the aggregation holds the
    rows that exist, where a pivot holds every column of every name. A name occurs once per key.
    """
    values = F.struct(*[F.col(f"`{c}`").alias(f"v{i}") for i, c in enumerate(columns)])
    entry = F.when(F.col(by).isin(names), F.struct(F.col(by), values))
    met = long.repartition(*keys).groupBy(*keys).agg(F.map_from_entries(F.collect_list(entry)).alias(CELLS))
    wide = [
        f"coalesce(try_element_at({CELLS}, '{name}').v{i}, 0D) AS `{name}_{short}`"
        for name in names
        for i, short in enumerate(columns.values())
    ]
    return met.selectExpr(*keys, *wide)


def short_name(measure: str) -> str:
    """``item_-3`` becomes ``-3``; statistics keep their name."""
    return measure.removeprefix("item_")


NOW = "now"
CELLS = "_cells"


def client_cells(
    rows: DataFrame, plan: CohortPlan, dims: Dimensions, each_month: bool = False, sample: DataFrame | None = None
) -> DataFrame:
    """A client and report month with a map from ``product|item`` to its measures and future sums.

    Two exchanges, both of combined rows: partial sums on the full key, then one short row per
    product and item that holds nothing but sums; lags in currency and statistics are derived behind
    the second one. A client brings at most products x items of those rows, so they fit in a map; a
    pivot would carry every column of every client through its aggregation buffers, before the
    exchange too.
    """
    history = keep_sample(history_units(rows, plan, each_month), sample).repartition(*KEYS)
    stats = trend_stats(item_history(history, plan), plan.history)
    pair = F.concat_ws("|", "product", F.coalesce("item", F.lit("")))
    columns = measures(plan) + ["h_1"] + future_sums(plan, each_month)
    entry = F.struct(pair, F.struct(*[F.col(f"`{c}`") for c in columns]))
    return stats.groupBy(*KEYS).agg(F.map_from_entries(F.collect_list(entry)).alias(CELLS))


def future_sums(plan: CohortPlan, each_month: bool) -> list[str]:
    """Names of the months ahead in :func:`history_units`."""
    if each_month:
        return [f"f_{m}" for m in range(1, plan.predict + 1)]
    return ["f_sum"] if plan.predict > 0 else []


def widen(df: DataFrame, plan: CohortPlan, dims: Dimensions, each_month: bool = False) -> DataFrame:
    """The map of :func:`client_cells` as wide columns behind the other columns.

    A missing pair, and a missing map, is zero: a history of zeros has statistics of zero. Do it last:
    joins and sorts in front of it move the map, which holds only the pairs that exist.
    """

    def cell(product: str, item: str, column: str, zero: str) -> str:
        return f"coalesce(try_element_at({CELLS}, '{product}|{item}').`{column}`, {zero})"

    features = [
        f"{cell(p, i, c, '0D')} AS `{p}_{i}_{short_name(c)}`"
        for p in dims.product_names
        for i in dims.item_names
        for c in measures(plan)
    ]
    exact = [
        " + ".join(cell(p, i, column, "0L") for i in dims.item_names) + f" AS `{p}|{name}`"
        for p in dims.product_names
        for column, name in [("h_1", NOW), *[(f, f) for f in future_sums(plan, each_month)]]
    ]
    return df.selectExpr(*other_columns(df), *features, *exact)


def other_columns(df: DataFrame) -> list[str]:
    return [f"`{c}`" for c in df.columns if c != CELLS]


def feature_names(plan: CohortPlan, dims: Dimensions) -> list[str]:
    """Names of the ledger features, in order."""
    names = [
        f"{p}_{i}_{short_name(c)}"
        for p in dims.product_names
        for i in dims.item_names
        for c in measures(plan)
    ]
    return names + [f"{p}_pl_-1" for p in dims.product_names]


def features_of_cells(df: DataFrame, plan: CohortPlan, dims: Dimensions) -> DataFrame:
    """Item features and every product month ``{p}_pl_{-1 … P-1}`` behind the other columns."""
    wide = widen(df, plan, dims, each_month=True)
    items = feature_names(plan, dims)[: -len(dims.product_names)]
    months = []
    for p in dims.product_names:
        ahead = [(f"f_{m}", m - 1) for m in range(1, plan.predict + 1)]
        months += [units_as(f"{p}|{part}", f"{p}_pl_{m}") for part, m in [(NOW, -1), *ahead]]
    return wide.selectExpr(*other_columns(df), *[f"`{c}`" for c in items], *months)


def pnl_features(ledger: DataFrame, plan: CohortPlan, dims: Dimensions, sample: DataFrame | None = None) -> DataFrame:
    """Ledger features of each client and report month."""
    return features_of_cells(client_cells(cohort_rows(ledger, plan, dims), plan, dims, True, sample), plan, dims)
