"""Every operator as a query over the order tables, ready to compare with SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgercast.dimensions import Dimensions
from ledgercast.functions.bucket import client_bucket
from ledgercast.functions.calendar import month_end_offset, report_months_window
from ledgercast.functions.trend import history_columns
from ledgercast.operators import calibration as C, cohort as H, combine as K, dataset as S
from ledgercast.operators import ensembles as EN, evaluate as E, ledger as L, models as M, profile as P, targets as T
from ledgercast.plans import fixtures as fx, jobs as J
from ledgercast.plans.cohort_plan import CohortPlan
from ledgercast.session import stage_path
from ledgercast.sources import ledger as SL, profile as SP, stages as SG

Query = Callable[[SparkSession, str], DataFrame]

PLAN, DIMS, PRODUCTS = fx.PLAN, fx.DIMENSIONS, fx.PRODUCTS
KEYS = ["epk_id", "report_dt"]
QUERIES: dict[str, Query] = {}


def query(make: Query) -> Query:
    QUERIES[make.__name__] = make
    return make


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(f"`{c}`"), digits) for c in columns})


def quoted(columns: list[str]) -> list[str]:
    return [f"`{c}`" for c in columns]


def money_as_double(df: DataFrame, column: str = "pl_val") -> DataFrame:
    return df.withColumn(column, F.col(column).cast("double"))


# -- sources and sinks ---------------------------------------------------------------------------


@query
def scan_ledger(spark, sf):
    fx.raw_ledger(spark, sf).createOrReplaceTempView("fx_ledger_source")
    return money_as_double(SL.scan_ledger(spark, "fx_ledger_source"))


def _as_numbers(profile: DataFrame) -> DataFrame:
    return profile.withColumns({c: F.col(c).cast("double") for c in ("region_group", "orders_qty") if c in profile.columns})


@query
def scan_profile(spark, sf):
    fx.raw_profile(spark, sf).createOrReplaceTempView("fx_profile_source")
    return _as_numbers(SP.scan_profile(spark, "fx_profile_source"))


@query
def scan_client_sample(spark, sf):
    return SL.scan_client_sample(spark, fx.client_sample(spark, sf))


@query
def product_dim(spark, sf):
    parts = fx.table(spark, sf, "part").select(F.regexp_extract("p_brand", "([0-9]+)$", 1).cast("int").alias("product_cd"))
    counts = parts.groupBy("product_cd").agg(F.count(F.lit(1)).alias("parts"))
    return counts.join(DIMS.product_dim(spark), "product_cd").select("product_cd", "product", "parts")


@query
def item_dim(spark, sf):
    lines = fx.table(spark, sf, "lineitem").select(F.col("l_linenumber").alias("pl_item"))
    counts = lines.groupBy("pl_item").agg(F.count(F.lit(1)).alias("lines"))
    return counts.join(DIMS.item_dim(spark), "pl_item").select("pl_item", "item", "lines")


@query
def month_dim(spark, sf):
    counts = fx.ledger(spark, sf).groupBy("report_dt").agg(F.count(F.lit(1)).alias("rows"))
    return PLAN.months_frame(spark).join(counts, "report_dt", "left").select(
        "report_dt", F.coalesce("rows", F.lit(0)).alias("rows")
    )


@query
def stage_write(spark, sf):
    path = SG.stage_write(L.filtered_ledger(fx.ledger(spark, sf), PLAN, DIMS), stage_path(spark, "filtered-ledger"))
    return spark.read.parquet(path)


@query
def stage_read(spark, sf):
    path = stage_path(spark, "clients")
    L.distinct_clients(fx.ledger(spark, sf)).write.parquet(path)
    return SG.stage_read(spark, path)


@query
def score_sink(spark, sf):
    path = SG.score_sink(_combined(spark, sf), stage_path(spark, "project"), "scores")
    return rounded(spark.read.parquet(path).select(*KEYS, "total_pl_predict"), 4, "total_pl_predict")


# -- cohorts and calendar ------------------------------------------------------------------------


@query
def month_end_shift(spark, sf):
    day = F.to_date("o_orderdate")
    shifts = {"back_1": -1, "same_0": 0, "next_1": 1, "next_12": 12}
    return fx.table(spark, sf, "orders").select(
        "o_orderkey", *[month_end_offset(day, n).alias(name) for name, n in shifts.items()]
    )


@query
def report_months_window_query(spark, sf):
    months = report_months_window(F.col("report_dt"), PLAN.history, PLAN.predict)
    return (
        fx.ledger(spark, sf)
        .groupBy("report_dt")
        .agg(F.count(F.lit(1)).alias("rows"))
        .select("report_dt", F.explode(months).alias("month"), "rows")
    )


@query
def cohort_months(spark, sf):
    ranges = (
        fx.table(spark, sf, "orders")
        .groupBy("o_orderpriority")
        .agg(F.min(F.last_day("o_orderdate")).alias("first"), F.max(F.last_day("o_orderdate")).alias("last"))
    )
    return H.cohort_months(ranges, "first", "last", PLAN.history, PLAN.predict)


def _with_clients(spark, sf, plan: CohortPlan) -> DataFrame:
    """Clients per cell: counts per bucket first, then the few buckets meet the few cells."""
    bucket = client_bucket(F.col("c_custkey"), plan.buckets, plan.hash_kind)
    counts = fx.table(spark, sf, "customer").groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    cells = plan.cells_frame(spark)
    by_bucket = cells.withColumn("bucket", F.explode(F.sequence("bin_lo", "bin_hi")))
    columns = ["split", "bin_lo", "bin_hi", F.col("report_from").alias("report_dt"), "win_lo", "win_hi"]
    return by_bucket.join(counts, "bucket", "left").groupBy(*columns).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("clients"))


@query
def cohort_plan(spark, sf):
    return _with_clients(spark, sf, PLAN).drop("win_lo", "win_hi")


@query
def scoring_cohort_plan(spark, sf):
    return _with_clients(spark, sf, fx.SCORING_PLAN)


@query
def client_bucket_query(spark, sf):
    return fx.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("epk_id"),
        client_bucket(F.col("c_custkey"), 30, "md5").alias("bucket_30"),
        client_bucket(F.col("c_custkey"), 300, "md5").alias("bucket_300"),
    )


@query
def client_bucket_native(spark, sf):
    return fx.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("epk_id"), client_bucket(F.col("c_custkey"), 300).alias("bucket_300")
    )


@query
def cohort_windows(spark, sf):
    return _with_clients(spark, sf, PLAN)


@query
def cohort_filter_ledger(spark, sf):
    return money_as_double(H.cohort_filter_ledger(fx.ledger(spark, sf), PLAN))


def _typed_profile(spark, sf) -> DataFrame:
    return SP.select_by_suffix(fx.raw_profile(spark, sf))


@query
def cohort_filter_profile(spark, sf):
    return _as_numbers(H.cohort_filter_profile(_typed_profile(spark, sf), PLAN))


@query
def cohort_filter_train(spark, sf):
    return _as_numbers(H.cohort_split(_typed_profile(spark, sf), PLAN)[0])


@query
def cohort_filter_test(spark, sf):
    return _as_numbers(H.cohort_split(_typed_profile(spark, sf), PLAN)[1])


# -- projections, filters ------------------------------------------------------------------------


@query
def select_by_suffix(spark, sf):
    return _as_numbers(SP.select_by_suffix(fx.raw_profile(spark, sf)))


@query
def select_feature_sample(spark, sf):
    wanted = ["acctbal_amt", "mkt_segm", "note_txt", "orders_qty"]
    return _as_numbers(SP.select_feature_sample(fx.raw_profile(spark, sf), wanted))


@query
def product_allowlist(spark, sf):
    return money_as_double(L.product_allowlist(fx.ledger(spark, sf), DIMS))


@query
def segment_rich(spark, sf):
    return T.segment(fx.outcomes(spark, sf), "rich")


@query
def segment_poor(spark, sf):
    return T.segment(fx.outcomes(spark, sf), "poor")


@query
def segment_poor_sold(spark, sf):
    return T.segment(fx.outcomes(spark, sf), "poor_sold")


def _flagged_train(spark, sf) -> DataFrame:
    train, _ = H.cohort_split(fx.outcomes_wide(spark, sf), PLAN)
    return H.validation_flag(train, "md5").select(*KEYS, "`total_pl_-1`", "total_pl_target", "is_valid")


@query
def validation_flag(spark, sf):
    return _flagged_train(spark, sf)


@query
def validation_rows(spark, sf):
    return H.validation_rows(_flagged_train(spark, sf), True)


@query
def complete_windows_only(spark, sf):
    clients = L.distinct_clients(L.filtered_ledger(fx.ledger(spark, sf), PLAN, DIMS))
    return L.complete_windows_only(L.client_grid(clients, PLAN, DIMS), PLAN)


def _column_report(df: DataFrame, groups: dict[str, list[str]]) -> DataFrame:
    """One row per column: its group and how many rows are not zero."""
    labels = {f"{g}|{c}": c for g, names in groups.items() for c in names}
    counts = df.agg(*[F.expr(f"count_if(`{c}` != 0)").alias(label) for label, c in labels.items()])
    part = F.split("label", "[|]")
    return counts.unpivot([], list(labels), "label", "nonzero").select(
        part[0].alias("group"), part[1].alias("column"), "nonzero"
    )


@query
def column_groups(spark, sf):
    dataset = T.pnl_dataset(fx.ledger(spark, sf), PLAN, DIMS)
    return _column_report(dataset, vars(T.column_groups(dataset.columns)))


@query
def profile_feature_groups(spark, sf):
    encoded = _encoded(spark, sf)
    return _column_report(encoded, P.profile_feature_groups(encoded.columns))


@query
def drop_targets_for_scoring(spark, sf):
    return T.drop_targets(fx.scores(spark, sf))


@query
def prediction_projection(spark, sf):
    scores = fx.scores(spark, sf).withColumn("acctbal_amt", F.lit(1.0))
    outcomes = T.column_groups([c for c in scores.columns if "_pl_predict" not in c and c != "acctbal_amt"]).outcomes()
    return scores.select(*quoted(K.prediction_columns(scores.columns, outcomes)))


# -- joins ---------------------------------------------------------------------------------------


@query
def ledger_client_sample(spark, sf):
    return money_as_double(L.keep_sample(fx.ledger(spark, sf), fx.client_sample(spark, sf)))


@query
def profile_client_sample(spark, sf):
    return _as_numbers(L.keep_sample(_typed_profile(spark, sf), fx.client_sample(spark, sf)))


@query
def map_products(spark, sf):
    return money_as_double(L.map_products(fx.ledger(spark, sf), DIMS))


@query
def map_items(spark, sf):
    return money_as_double(L.map_items(fx.ledger(spark, sf), DIMS))


@query
def attribute_grid(spark, sf):
    months = fx.ledger(spark, sf).select("report_dt").distinct()
    return L.attribute_grid(spark, months, DIMS)


def _sums(spark, sf) -> DataFrame:
    return L.filtered_ledger(fx.ledger(spark, sf), PLAN, DIMS)


@query
def client_grid(spark, sf):
    return L.client_grid(L.distinct_clients(_sums(spark, sf)), PLAN, DIMS)


@query
def densify_ledger(spark, sf):
    sums = _sums(spark, sf)
    return L.densify_ledger(L.client_grid(L.distinct_clients(sums), PLAN, DIMS), sums)


def _train_profile(spark, sf) -> DataFrame:
    return H.cohort_filter_profile(_typed_profile(spark, sf), PLAN.only("train"))


# More than the nations, fewer than the clients of the smallest tables: names of clients go at every scale.
CATEGORY_VALUES = 50


def _params(spark, sf) -> P.ProfileParams:
    return P.fit_params(_train_profile(spark, sf), max_values=CATEGORY_VALUES)


def _encoded(spark, sf, plan: CohortPlan = PLAN) -> DataFrame:
    return P.profile_transform(H.cohort_filter_profile(_typed_profile(spark, sf), plan), _params(spark, sf))


ENCODED_FLOATS = ["acctbal_amt_mean_na", "orders_qty_mean_na", "mkt_segm", "nation_cd"]


@query
def feature_dataset(spark, sf):
    cells = L.client_cells(L.cohort_rows(fx.ledger(spark, sf), PLAN, DIMS), PLAN, DIMS)
    joined = S.profile_with_cells(_encoded(spark, sf), cells)
    return rounded(T.dataset_of_cells(joined, PLAN, DIMS), 6, *ENCODED_FLOATS)


# -- aggregations, pivots, windows ---------------------------------------------------------------


@query
def ledger_sum_by_code(spark, sf):
    return L.ledger_sum_by_code(fx.ledger(spark, sf))


@query
def ledger_sum_by_group(spark, sf):
    return L.ledger_sum_by_group(fx.ledger(spark, sf), DIMS)


@query
def numeric_means(spark, sf):
    return rounded(P.numeric_means(_train_profile(spark, sf)), 6, "mean")


@query
def category_counts(spark, sf):
    return P.category_counts(_train_profile(spark, sf))


GATE = 20


@query
def category_cardinality_gate(spark, sf):
    return P.category_cardinality_gate(P.category_counts(_train_profile(spark, sf)), GATE)


@query
def distinct_clients(spark, sf):
    return L.distinct_clients(_sums(spark, sf))


def _windowed(spark, sf) -> DataFrame:
    return L.windowed_ledger(fx.ledger(spark, sf), PLAN, DIMS)


@query
def pivot_items(spark, sf):
    return L.pivot_items(_windowed(spark, sf), PLAN, DIMS)


@query
def pivot_products(spark, sf):
    return L.pivot_products(L.pivot_items(_windowed(spark, sf), PLAN, DIMS), DIMS)


@query
def ratio_of_sums(spark, sf):
    rows = E.by_product(fx.scores(spark, sf), PRODUCTS)
    ratio = E.ratio_of_sums(F.col("rich"), F.col("pl_target"))
    return rounded(rows.groupBy("product").agg(ratio.alias("ratio")), 9, "ratio")


@query
def item_history_lags(spark, sf):
    return _windowed(spark, sf).select(*KEYS, "product", "item", *quoted(history_columns(PLAN.history)))


@query
def product_month_total(spark, sf):
    return L.product_month_total(L.ledger_sum_by_group(fx.ledger(spark, sf), DIMS))


def _rows(spark, sf) -> DataFrame:
    return L.cohort_rows(fx.ledger(spark, sf), PLAN, DIMS)


@query
def product_total_leads(spark, sf):
    return L.product_leads(_rows(spark, sf), PLAN)


@query
def category_tie_rank(spark, sf):
    gated = P.category_cardinality_gate(P.category_counts(_train_profile(spark, sf)))
    return P.category_tie_rank(gated).select(
        "feature", "value", "n", F.col("tie_rank").cast("long").alias("tie_rank"), "n_tied"
    )


def _code_importances(spark, sf) -> DataFrame:
    """Share of the absolute P&L by brand and line number: an importance table made from data."""
    name = F.concat_ws("_", F.col("product_cd").cast("string"), F.col("pl_item").cast("string"))
    return _shares(fx.ledger(spark, sf).select(name.alias("feature"), "pl_val"))


def _shares(values: DataFrame) -> DataFrame:
    """Share of each feature; the sums are staged, as their total and every later pass read them again."""
    sums = values.groupBy("feature").agg(F.sum(F.abs("pl_val")).alias("s"))
    sums = SG.staged(sums, stage_path(values.sparkSession, "feature-sums"))
    total = sums.agg(F.sum("s")).first()[0]
    return sums.select("feature", (F.col("s").cast("double") / F.lit(float(total))).alias("importance"))


@query
def importance_cumsum(spark, sf):
    return rounded(M.importance_cumsum(_code_importances(spark, sf)), 9, "importance", "running")


@query
def importance_cutoff(spark, sf):
    return rounded(M.importance_cutoff(_code_importances(spark, sf), 100), 9, "importance", "running")


@query
def top_features(spark, sf):
    parts = fx.table(spark, sf, "lineitem").select(
        F.col("l_partkey").cast("string").alias("feature"), F.col("l_extendedprice").cast("decimal(18,4)").alias("pl_val")
    )
    return rounded(M.top_features(_shares(parts), 300), 12, "importance")


@query
def ledger_sort(spark, sf):
    return L.ledger_sort(_sums(spark, sf))


@query
def layout_hints(spark, sf):
    """One folder per month, a client's rows together and in order inside each file."""
    path = SG.stage_write(L.ledger_sort(_sums(spark, sf)), stage_path(spark, "sorted-ledger"), "report_dt")
    return SG.stage_read(spark, path).select("epk_id", "product", "item", "report_dt", "pl_value")


# -- scalar expressions --------------------------------------------------------------------------


def _stats(*columns: str) -> Query:
    def make(spark, sf):
        return _windowed(spark, sf).select(*KEYS, "product", "item", *columns)

    return make


QUERIES["row_mean"] = _stats("mean")
QUERIES["row_min_max"] = _stats("min", "max")
QUERIES["scatter"] = _stats("scatter")
QUERIES["delta_abs"] = _stats("delta_abs_mean", "delta_abs_min", "delta_abs_max")
QUERIES["delta_relative"] = _stats("delta_relative_mean", "delta_relative_min", "delta_relative_max")


@query
def no_history_case(spark, sf):
    return L.windowed_ledger(fx.ledger(spark, sf), replace(PLAN, history=1), DIMS)


def _month_columns(spark, sf) -> DataFrame:
    return L.pivot_products(L.product_leads(_rows(spark, sf), PLAN), DIMS)


@query
def product_target(spark, sf):
    return T.product_target(_month_columns(spark, sf), PRODUCTS, PLAN.predict)


@query
def sale_flag(spark, sf):
    flagged = T.sale_flags(T.product_target(_month_columns(spark, sf), PRODUCTS, PLAN.predict), PRODUCTS)
    return flagged.select(*KEYS, *[F.col(f"{p}_sales_pl_target").cast("long").alias(f"{p}_sales_pl_target") for p in PRODUCTS])


@query
def total_naive_and_target(spark, sf):
    wide = T.product_target(_month_columns(spark, sf), PRODUCTS, PLAN.predict)
    return T.total_naive_and_target(wide, PRODUCTS).select(*KEYS, "`total_pl_-1`", "total_pl_target")


@query
def scoring_total_naive(spark, sf):
    features = L.pnl_features(fx.ledger(spark, sf), fx.SCORING_PLAN, DIMS)
    return T.scoring_total_naive(features, PRODUCTS).select(*KEYS, "`total_pl_-1`")


@query
def date_recency(spark, sf):
    return _typed_profile(spark, sf).select(*KEYS, P.date_recency("last_order_dt").cast("long").alias("last_order_dt"))


@query
def dual_imputation(spark, sf):
    means = _params(spark, sf).means
    columns = [c for name in ("acctbal_amt", "empty_rate", "orders_qty") for c in P.dual_imputation(name, means[name])]
    return rounded(
        H.cohort_filter_profile(_typed_profile(spark, sf), PLAN).select(*KEYS, *columns),
        6, "acctbal_amt_mean_na", "orders_qty_mean_na",
    )


@query
def category_fill(spark, sf):
    profile = _typed_profile(spark, sf)
    columns = ["mkt_segm", "nation_cd", "name_cd"]
    number = P.category_fill(profile, "region_group").cast("long").alias("region_group")
    return profile.select(*KEYS, *[P.category_fill(profile, c) for c in columns], number)


@query
def category_frequency(spark, sf):
    return rounded(P.category_frequency(_train_profile(spark, sf)), 12, "code")


@query
def category_encode(spark, sf):
    codes = _params(spark, sf).codes
    columns = [P.category_encode(c, codes[c]) for c in ("mkt_segm", "nation_cd")]
    return rounded(H.cohort_filter_profile(_typed_profile(spark, sf), PLAN).select(*KEYS, *columns), 12, "mkt_segm", "nation_cd")


@query
def cohort_split(spark, sf):
    train, test = H.cohort_split(fx.outcomes_wide(spark, sf), PLAN)
    columns = [*KEYS, "`total_pl_-1`", "total_pl_target"]
    return train.select(F.lit("train").alias("split"), *columns).union(test.select(F.lit("test").alias("split"), *columns))


@query
def positive_probability(spark, sf):
    rows = E.by_product(fx.scores(spark, sf), PRODUCTS)
    vector = array_to_vector(F.array(1 - F.col("probability"), F.col("probability")))
    return rows.select(*KEYS, "product", M.positive_probability(vector).alias("probability"))


def _calibration(spark, sf):
    return C.load_calibration(C.calibration_fit(_sale_scores(spark, sf)), PRODUCTS)


def _calibrated(spark, sf) -> DataFrame:
    return C.apply_calibration(fx.scores(spark, sf), _calibration(spark, sf))


@query
def apply_calibration(spark, sf):
    columns = [f"{p}_sales_pl_predict_probability_calibrated" for p in PRODUCTS]
    return rounded(_calibrated(spark, sf).select(*KEYS, *columns), 9, *columns)


@query
def poor_mix(spark, sf):
    columns = [f"{p}_poor_mix_pl_predict" for p in PRODUCTS]
    return rounded(K.with_poor_mix(_calibrated(spark, sf), PRODUCTS).select(*KEYS, *columns), 6, *columns)


def _combined(spark, sf) -> DataFrame:
    return K.combine(fx.scores(spark, sf), _calibration(spark, sf), PRODUCTS)


@query
def product_total_prediction(spark, sf):
    columns = [f"{p}_total_pl_predict" for p in PRODUCTS]
    return rounded(_combined(spark, sf).select(*KEYS, *columns), 4, *columns)


@query
def total_prediction(spark, sf):
    return rounded(_combined(spark, sf).select(*KEYS, "total_pl_predict"), 4, "total_pl_predict")


@query
def naive_year(spark, sf):
    return fx.outcomes_wide(spark, sf).select(*KEYS, K.naive_year().alias("total_pl_-1_year"))


# -- calibration and evaluation ------------------------------------------------------------------


def _sale_scores(spark, sf, coarse: bool = False) -> DataFrame:
    return E.sale_scores(fx.scores(spark, sf, coarse), PRODUCTS)


@query
def score_quantile_bins(spark, sf):
    return C.score_quantile_bins(_sale_scores(spark, sf))


@query
def calibration_bin_stats(spark, sf):
    stats = C.calibration_bin_stats(_sale_scores(spark, sf)).drop("score_sum")
    return rounded(stats, 9, "score_mean", "target_rate")


@query
def calibration_default(spark, sf):
    return rounded(C.calibration_default(_sale_scores(spark, sf)), 9, "coef")


@query
def calibration_fit(spark, sf):
    return rounded(C.calibration_fit(_sale_scores(spark, sf)), 9, "coef")


@query
def calibration_fit_observed(spark, sf):
    return rounded(C.calibration_fit(_sale_scores(spark, sf), mode="observed"), 9, "coef")


@query
def calibration_fit_equal_width(spark, sf):
    return rounded(C.calibration_fit(_sale_scores(spark, sf, coarse=True)), 9, "coef")


@query
def calibration_job(spark, sf):
    train, _ = H.cohort_split(fx.scores(spark, sf), PLAN)
    valid = H.validation_rows(H.validation_flag(train, "md5"))
    return rounded(C.calibration_fit(E.sale_scores(valid, PRODUCTS)), 9, "coef")


@query
def regression_metrics(spark, sf):
    rows = E.by_product(fx.scores(spark, sf), PRODUCTS)
    return rounded(E.regression_metrics(rows, ["product"], "pl_target", "rich"), 4, "mae", "rmse", "sum")


@query
def roc_auc(spark, sf):
    return rounded(E.roc_auc(_sale_scores(spark, sf)), 9, "roc_auc")


@query
def pr_auc(spark, sf):
    return rounded(E.pr_auc(_sale_scores(spark, sf)), 9, "pr_auc")


@query
def classification_metrics(spark, sf):
    return rounded(E.classification_metrics(_sale_scores(spark, sf)), 9, "roc_auc", "pr_auc", "sum")


@query
def classification_metrics_tied(spark, sf):
    return rounded(E.classification_metrics(_sale_scores(spark, sf, coarse=True)), 9, "roc_auc", "pr_auc", "sum")


def _tested(spark, sf) -> DataFrame:
    """Combined scores of the test cells; calibration still learns from all rows of the fixture."""
    return H.cohort_split(_combined(spark, sf), PLAN)[1]


def _parts(*parts: str) -> Query:
    def make(spark, sf):
        return rounded(E.product_metrics(_tested(spark, sf), PRODUCTS, list(parts)), 4, "mae", "rmse", "sum")

    return make


QUERIES["eval_rich"] = _parts("rich_regression_model", "rich_regression_naive")
QUERIES["eval_poor_regression"] = _parts("poor_regression_model")
QUERIES["eval_poor_mix"] = _parts("poor_mix_model", "poor_mix_naive")
QUERIES["eval_product_total"] = _parts("product_total_model", "product_total_naive", "product_total_naive_year")


@query
def eval_sale(spark, sf):
    _, test = H.cohort_split(fx.scores(spark, sf), PLAN)
    return rounded(E.classification_metrics(E.sale_scores(test, PRODUCTS)), 9, "roc_auc", "pr_auc", "sum")


@query
def eval_total(spark, sf):
    return rounded(E.total_metrics(_tested(spark, sf)), 4, "mae", "rmse", "sum")


@query
def metrics_report(spark, sf):
    combined = SG.staged(_tested(spark, sf), stage_path(spark, "combined"))
    return rounded(E.evaluate(combined, PRODUCTS), 4, "value")


# -- models --------------------------------------------------------------------------------------

# Two products over all product codes, so that every ledger row takes part in few models.
MODEL_DIMS = Dimensions(
    products={"Card": tuple(range(1, 13)), "Loan": tuple(range(13, 26))}, items=fx.DIMENSIONS.items
)
MODEL_SETTINGS = M.SearchSettings(
    forest_trees=5, forest_depth=3, forest_rows=1.0, depths=(2,), steps=(0.1,), iterations=(3,),
    refit_depth=3, cutoff_features=20, keep_features=60,
)
# The whole job: the published grid, trees and depths, on all rows of a segment; every tree of a forest draws as many rows.
WHOLE_SETTINGS = M.SearchSettings(sample_rows=None, forest_rows=1.0)
_TRAINED: dict[tuple[str, str], tuple] = {}


def _trained(spark, sf) -> tuple[J.Trained, DataFrame, DataFrame]:
    """One training run per session and input."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _TRAINED:
        _TRAINED[key] = J.train(fx.raw_profile(spark, sf), fx.ledger(spark, sf), PLAN, MODEL_DIMS, MODEL_SETTINGS)
    return _TRAINED[key]


def _fitted(trained: J.Trained, model_id: str) -> M.FittedModel:
    return next(f for f in trained.fitted if f.spec.id == model_id)


def _scored_by(model_id: str) -> Query:
    def make(spark, sf):
        trained, _, test = _trained(spark, sf)
        fitted = _fitted(trained, model_id)
        return M.predict_one(test, fitted.spec, fitted.model).select(*KEYS, f"`{fitted.spec.score}`")

    return make


QUERIES["model_rich"] = _scored_by("Card_rich_regression")
QUERIES["model_poor"] = _scored_by("Loan_poor_regression")
QUERIES["model_sale"] = _scored_by("Card_poor_classification")
QUERIES["model_total"] = _scored_by("AllProducts_total_regression")


@query
def assemble_features(spark, sf):
    wide = fx.outcomes_wide(spark, sf)
    names = [T.now(p) for p in PRODUCTS]
    values = vector_to_array("all_features")
    return M.assemble_features(wide, names).select(
        *KEYS, F.size(values).cast("long").alias("features"), values[0].alias("first"), values[len(names) - 1].alias("last")
    )


@query
def sample_rows(spark, sf):
    return H.sample_rows(fx.raw_profile(spark, sf), 0.1, 23, "md5").select(*KEYS)


@query
def rf_importance(spark, sf):
    trained, train, _ = _trained(spark, sf)
    features = J.model_features(train, PLAN, MODEL_DIMS)
    return M.rf_importance(train, features, M.model_total(), WHOLE_SETTINGS)


@query
def feature_importance_table(spark, sf):
    trained, _, _ = _trained(spark, sf)
    tables = [f.importances.withColumn("model", F.lit(f.spec.id)) for f in trained.fitted]
    path = SG.stage_write(reduce(DataFrame.union, tables), stage_path(spark, "importances"))
    return SG.stage_read(spark, path)


def _fit_and_score(spec: M.ModelSpec, settings: M.SearchSettings) -> Query:
    def make(spark, sf):
        _, train, test = _trained(spark, sf)
        fitted = M.fit_model(train, J.model_features(train, PLAN, MODEL_DIMS), spec, settings)
        return M.predict_one(test, spec, fitted.model).select(*KEYS, f"`{spec.score}`")

    return make


QUERIES["gbt_regression"] = _fit_and_score(M.model_rich("Loan", loss="mae"), WHOLE_SETTINGS)
QUERIES["gbt_classification"] = _fit_and_score(M.model_sale("Loan"), MODEL_SETTINGS)
QUERIES["rf_model"] = _fit_and_score(M.model_rich("Card", family="rf"), WHOLE_SETTINGS)
QUERIES["refit_on_selected"] = _fit_and_score(M.model_total(), replace(MODEL_SETTINGS, refit_on_all=True))
QUERIES["gbt_search"] = _fit_and_score(M.model_rich("Card"), WHOLE_SETTINGS)


@query
def predict_all(spark, sf):
    trained, _, test = _trained(spark, sf)
    return J.predict_outcomes(test, trained.models, MODEL_DIMS)


def _scoring_inputs(spark, sf) -> tuple[DataFrame, DataFrame]:
    return fx.raw_profile(spark, sf), fx.ledger(spark, sf)


@query
def predict_scoring(spark, sf):
    trained, _, _ = _trained(spark, sf)
    features = J.scoring_features(*_scoring_inputs(spark, sf), fx.SCORING_PLAN, MODEL_DIMS, trained.params)
    return J.predict_scoring(features, trained.models, MODEL_DIMS)


@query
def model_save_load(spark, sf):
    trained, _, test = _trained(spark, sf)
    folder = stage_path(spark, "models")
    trained.save_models(folder)
    return J.predict_outcomes(test, J.Trained.load_models(folder, list(trained.models)), MODEL_DIMS)


@query
def model_validation_metrics(spark, sf):
    trained, _, _ = _trained(spark, sf)
    return reduce(DataFrame.union, [f.metrics for f in trained.fitted])


@query
def test_report(spark, sf):
    trained, _, test = _trained(spark, sf)
    return J.test_report(trained, test, MODEL_DIMS)


@query
def score_clients(spark, sf):
    trained, _, _ = _trained(spark, sf)
    scores = J.score_clients(*_scoring_inputs(spark, sf), fx.SCORING_PLAN, MODEL_DIMS, trained)
    path = J.write_scores(scores, stage_path(spark, "project"), "scores")
    return SG.stage_read(spark, path)


@query
def ensemble_scores(spark, sf):
    wide = fx.outcomes_wide(spark, sf)
    rows = wide.select(*KEYS, F.array(*[F.col(f"`{T.now(p)}`") for p in PRODUCTS]).alias("x"))
    sums = EN.tree_sums(rows, "x", fx.ensemble(spark), KEYS)
    total, trees = F.col("total"), F.col("trees")
    scores = sums.select(*KEYS, total, EN.boosted_score(total, True).alias("chance"), EN.forest_score(total, trees).alias("mean"), trees)
    return rounded(scores, 9, "chance", "mean")


# -- composite jobs ------------------------------------------------------------------------------


@query
def pnl_features(spark, sf):
    return L.pnl_features(fx.ledger(spark, sf), PLAN, DIMS)


@query
def pnl_dataset(spark, sf):
    dataset = T.pnl_dataset(fx.ledger(spark, sf), PLAN, DIMS)
    return dataset.withColumns({f"{p}_sales_pl_target": F.col(f"{p}_sales_pl_target").cast("long") for p in PRODUCTS})


@query
def profile_fit(spark, sf):
    means, encoding = P.profile_fit(_train_profile(spark, sf))
    return rounded(
        means.select("feature", F.lit("mean").alias("value"), F.col("mean").alias("code")).union(encoding), 6, "code"
    )


@query
def profile_transform(spark, sf):
    encoded = _encoded(spark, sf)
    return rounded(encoded.withColumns({c: F.col(c).cast("long") for c in ("last_order_dt", "region_group")}), 6, *ENCODED_FLOATS)


@query
def scoring_features(spark, sf):
    features = J.scoring_features(*_scoring_inputs(spark, sf), fx.SCORING_PLAN, DIMS, _params(spark, sf))
    return rounded(
        features.withColumns({c: F.col(c).cast("long") for c in ("last_order_dt", "region_group")}), 6, *ENCODED_FLOATS
    )


for _old, _new in (("report_months_window_query", "report_months_window"), ("client_bucket_query", "client_bucket")):
    QUERIES[_new] = QUERIES.pop(_old)
