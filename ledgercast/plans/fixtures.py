"""Ledger, profile, client sample and scores derived from order tables.

The library itself reads any ledger and profile; these views give the queries and the bench
something to run on. Each reads its tables whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgercast.dimensions import Dimensions
from ledgercast.functions.money import MONEY
from ledgercast.operators.ensembles import LEAF, NODES
from ledgercast.operators.evaluate import by_product
from ledgercast.operators.ledger import cohort_rows, product_outcomes
from ledgercast.operators.targets import now, sale_flags, target, total_of
from ledgercast.plans.cohort_plan import CohortPlan, CohortSettings, ScoringSettings
from ledgercast.sources.ledger import scan_ledger
from ledgercast.sources.local_table import local_table

DIMENSIONS = Dimensions(
    products={
        "P1": (1, 2, 3, 4),
        "P2": (5, 6, 7, 8),
        "P3": (9, 10, 11, 12),
        "P4": (13, 14, 15, 16),
        "P5": (17, 18, 19, 20),
        "P6": (21, 22, 23, 24),
    },
    items={"Fee": (1, 2), "Interest": (3, 4), "Cost": (5, 6)},
)
PRODUCTS = DIMENSIONS.product_names
ITEMS = DIMENSIONS.item_names

SETTINGS = CohortSettings(
    history_months=6,
    predict_months=12,
    buckets=30,
    train_from="1999-05-31",
    train_months=2,
    train_bucket=1,
    train_width=10,
    test_from="1999-09-30",
    test_months=1,
    test_bucket=21,
    test_width=9,
    hash_kind="md5",
)
PLAN = CohortPlan.training(SETTINGS)
SCORING_PLAN = CohortPlan.scoring(
    ScoringSettings(history_months=6, buckets=1, report_from="2001-06-30", report_months=1, hash_kind="md5")
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as P&L: brand number is the product code, line number the item code.

    Returned lines count negative, so sums of both signs and of zero occur.
    """
    value = (F.col("l_extendedprice") * (1 - F.col("l_discount"))).cast(MONEY)
    return (
        table(spark, sf_dir, "lineitem")
        .join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.col("o_custkey").alias("client_id"),
            F.last_day("o_orderdate").alias("report_date"),
            F.regexp_extract("p_brand", "([0-9]+)$", 1).cast("int").alias("product_cd"),
            F.col("l_linenumber").alias("pl_item"),
            F.when(F.col("l_returnflag") == "R", -value).otherwise(value).cast(MONEY).alias("pl_val"),
        )
    )


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_ledger(spark, raw_ledger(spark, sf_dir))


def client_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clients with urgent orders, once per order: the list repeats clients."""
    return (
        table(spark, sf_dir, "orders")
        .where(F.col("o_orderpriority") == "1-URGENT")
        .select(F.col("o_custkey").alias("epk_id"))
    )


def raw_profile(spark: SparkSession, sf_dir: str, months: list | None = None) -> DataFrame:
    """Every customer at every report month, with columns of all roles and missing values."""
    months = months or sorted(set(PLAN.report_months() + SCORING_PLAN.report_months()))
    each_month = F.explode(F.array(*[F.lit(m) for m in months])).alias("report_dt")
    seen = (
        table(spark, sf_dir, "orders")
        .select("o_custkey", F.to_date("o_orderdate").alias("day"))
        .select("o_custkey", "day", each_month)
        .where(F.col("day") <= F.col("report_dt"))
        .groupBy(F.col("o_custkey").alias("epk_id"), "report_dt")
        .agg(F.count(F.lit(1)).alias("orders_qty"), F.max("day").alias("last_order_dt"))
    )
    nation = table(spark, sf_dir, "nation")
    balance = F.col("c_acctbal")
    return (
        table(spark, sf_dir, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("c_custkey").alias("epk_id"),
            each_month,
            F.when(balance >= 0, balance).alias("acctbal_amt"),
            F.lit(None).cast("double").alias("empty_rate"),
            F.when(~balance.between(8000, 9000), F.col("c_mktsegment")).alias("mkt_segm"),
            F.col("n_name").alias("nation_cd"),
            F.when(~balance.between(4000, 5500), F.col("n_regionkey")).alias("region_group"),
            F.col("c_name").alias("name_cd"),
            F.col("c_name").alias("note_txt"),
        )
        .join(seen, ["epk_id", "report_dt"], "left")
    )


def outcomes(spark: SparkSession, sf_dir: str, plan: CohortPlan = PLAN) -> DataFrame:
    """``pl_-1`` and ``pl_target`` of every client and product of the plan, long, zeros included."""
    wide = outcomes_wide(spark, sf_dir, plan)
    return by_product(wide, PRODUCTS, {"pl_-1": "{p}_pl_-1", "pl_target": "{p}_pl_target"})


def outcomes_wide(spark: SparkSession, sf_dir: str, plan: CohortPlan = PLAN) -> DataFrame:
    """Report-month P&L, target, flag per product and totals, without item features."""
    long = product_outcomes(cohort_rows(ledger(spark, sf_dir), plan, DIMENSIONS), plan)
    sums = []
    for p in PRODUCTS:
        for name in (now(), target()):
            value = F.max(F.when(F.col("product") == p, F.col(f"`{name}`")))
            sums.append(F.coalesce(value, F.lit(0.0)).alias(f"{p}_{name}"))
    wide = sale_flags(long.groupBy("epk_id", "report_dt").agg(*sums), PRODUCTS)
    return wide.withColumns(
        {"total_pl_-1": total_of([now(p) for p in PRODUCTS]), "total_pl_target": total_of([target(p) for p in PRODUCTS])}
    )


def hash_share(key) -> F.Column:
    """A number in [0, 1) from the hash of a key."""
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def scores(spark: SparkSession, sf_dir: str, coarse: bool = False) -> DataFrame:
    """Scores without a model: every later step can then be checked against SQL.

    The chance of a sale is a hash share; ``coarse`` keeps three distinct values of it.
    """
    columns = {}
    for p in PRODUCTS:
        share = hash_share(F.concat(F.lit(f"s{p}"), F.col("epk_id").cast("string")))
        share = F.floor(share * 3) / 3 if coarse else share
        columns[f"{p}_sales_pl_predict_probability"] = share
        columns[f"{p}_rich_pl_predict"] = F.col(f"`{p}_pl_-1`") * 12
        columns[f"{p}_poor_pl_predict"] = share * 100
    columns["AllProducts_total_pl_predict"] = F.col("`total_pl_-1`") * 12
    return outcomes_wide(spark, sf_dir).withColumns(columns)


TREES, LEVELS = 12, 3


def ensemble(spark: SparkSession) -> DataFrame:
    """Nodes of an ensemble made by rule over the products' P&L: whole trees of three levels."""
    inner, nodes = 2**LEVELS - 1, []
    for t in range(TREES):
        for n in range(2 * inner + 1):
            split = ((3 * t + 5 * n) % len(PRODUCTS), ((31 * t + 17 * n) % 13 - 6) * 500.0, 2 * n + 1, 2 * n + 2)
            value, weight = ((7 * t + 3 * n) % 11 - 5) * 0.25, 0.5 if t else 1.0
            nodes.append((t, n, *(split if n < inner else (LEAF, None, LEAF, LEAF)), value, weight))
    return local_table(spark, nodes, NODES)
