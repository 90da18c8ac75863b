import datetime as dt
import random
from collections import Counter
from dataclasses import replace

import pytest
from pyspark.sql import Window, functions as F

from ledgercast.defaults import bank_dimensions
from ledgercast.dimensions import Dimensions
from ledgercast.functions.calendar import month_end
from ledgercast.operators import dataset as S, ledger as L, targets as T
from ledgercast.plans import fixtures as fx
from ledgercast.plans.cohort_plan import Cell, CohortPlan

REPORT = dt.date(2020, 6, 30)
DIMS = Dimensions({"A": (1,), "B": (2,)}, {"X": (10,), "Y": (20,)})


def plan(history=6, predict=2):
    return CohortPlan((Cell("all", 0, 0, REPORT, REPORT),), 1, history, predict)


def ledger(spark, rows):
    """Rows of (client, product code, item code, month offset, value)."""
    data = [(c, month_end(REPORT, o), p, i, v) for c, p, i, o, v in rows]
    frame = spark.createDataFrame(data, "epk_id long, report_dt date, product_cd int, pl_item int, pl_val double")
    return frame.withColumn("pl_val", F.col("pl_val").cast("decimal(18,4)"))


def stats(spark, values):
    rows = [(1, 1, 10, k - 5, float(v)) for k, v in enumerate(values)]
    return L.windowed_ledger(ledger(spark, rows), plan(), DIMS).where("product = 'A' and item = 'X'").first()


def test_lags_and_statistics(spark):
    row = stats(spark, [1, 2, 3, 4, 5, 6])
    assert row["item_-1"] == 6 and row["item_-6"] == 1
    assert (row["mean"], row["min"], row["max"]) == (3.5, 1, 6)
    assert row["scatter"] == 5 / 3.5
    assert (row["delta_abs_mean"], row["delta_abs_min"], row["delta_abs_max"]) == (2.5, 1, 5)
    assert row["delta_relative_max"] == 5 / 3.5


def test_zero_mean_uses_the_guard(spark):
    row = stats(spark, [-1, 1, 0, 0, 0, 0])
    assert row["mean"] == 0 and row["scatter"] == pytest.approx(20000)
    assert row["delta_abs_max"] == 1 and row["delta_relative_max"] == pytest.approx(10000)


def test_missing_pairs_are_zero(spark):
    wide = T.pnl_dataset(ledger(spark, [(1, 1, 10, 0, 5.0)]), plan(), DIMS).first().asDict()
    assert all(v == 0 for k, v in wide.items() if k.startswith("B_"))
    assert wide["A_X_-1"] == 5 and wide["A_Y_mean"] == 0


def test_leads_targets_and_flags(spark):
    rows = [(1, 1, 10, m, 10.0 * (m + 1)) for m in range(3)]
    rows += [(1, 2, 10, 1, 20.0)]
    rows += [(2, 1, 10, 1, 5.0), (2, 1, 20, 2, -5.0)]
    source = ledger(spark, rows)
    leads = {(r["epk_id"], r["product"]): r for r in L.product_leads(L.cohort_rows(source, plan(), DIMS), plan()).collect()}
    assert [leads[1, "A"][f"pl_{m}"] for m in (-1, 0, 1)] == [10, 20, 30]
    data = {r["epk_id"]: r for r in T.pnl_dataset(source, plan(), DIMS).collect()}
    assert (data[1]["A_pl_target"], data[1]["A_sales_pl_target"]) == (50, 0)
    assert (data[1]["B_pl_target"], data[1]["B_sales_pl_target"]) == (20, 1)
    assert (data[2]["A_pl_target"], data[2]["A_sales_pl_target"]) == (0, 0)
    assert (data[1]["total_pl_-1"], data[1]["total_pl_target"]) == (10, 70)


def test_no_months_ahead(spark):
    frame = T.pnl_dataset(ledger(spark, [(1, 1, 10, 0, 5.0), (1, 1, 10, 1, 9.0)]), plan(predict=0), DIMS)
    assert not [c for c in frame.columns if "target" in c]
    row = frame.first()
    assert row["A_pl_-1"] == 5 and row["total_pl_-1"] == 5


def test_one_month_of_history(spark):
    frame = L.windowed_ledger(ledger(spark, [(1, 1, 10, 0, 5.0)]), plan(history=1), DIMS)
    assert frame.columns == ["epk_id", "report_dt", "product", "item", "item_-1"]


def test_unmapped_item_counts_nowhere_but_keeps_the_client(spark):
    source = ledger(spark, [(1, 1, 99, 0, 5.0)])
    row = T.pnl_dataset(source, plan(), DIMS).first().asDict()
    assert row["epk_id"] == 1 and all(v == 0 for k, v in row.items() if k not in ("epk_id", "report_dt"))
    assert L.ledger_sum_by_group(source, DIMS).first()["item"] is None


def test_product_outside_the_list_is_dropped(spark):
    source = ledger(spark, [(1, 3, 10, 0, 5.0)])
    assert L.product_allowlist(source, DIMS).isEmpty()
    assert T.pnl_dataset(source, plan(), DIMS).isEmpty()


def test_code_in_two_groups_is_refused():
    with pytest.raises(ValueError):
        Dimensions({"A": (1,), "B": (1,)}, {})


def test_dimensions_from_json(tmp_path):
    (tmp_path / "p.json").write_text('{"A": ["title", [1, 2]], "B": ["other", [3]]}')
    (tmp_path / "i.json").write_text('{"X": [10], "Y": [20, 21]}')
    dims = Dimensions.from_json(str(tmp_path / "p.json"), str(tmp_path / "i.json"))
    assert dims.product_codes == [1, 2, 3] and dims.item_names == ["X", "Y"]


def test_bank_dimensions_give_the_published_feature_count():
    dims = bank_dimensions()
    assert (len(dims.product_codes), sum(map(len, dims.items.values()))) == (23, 136)
    names = L.feature_names(CohortPlan((), 1, 6, 12), dims)
    assert len(names) == len(set(names)) == 903
    assert "AccCurr_NetIntInc_-1" in names and "DebitCard_pl_-1" in names


def test_sample_with_repeats_does_not_multiply_rows(spark):
    source = ledger(spark, [(1, 1, 10, 0, 5.0), (2, 1, 10, 0, 7.0)])
    sample = spark.createDataFrame([(1,), (1,), (1,)], "epk_id long")
    assert [r["A_pl_-1"] for r in T.pnl_dataset(source, plan(), DIMS, sample).collect()] == [5]


def dense_windows(sums, the_plan, dims):
    """Grid, lags and leads by row: the textbook form of what the library sums by offset."""
    grid = L.client_grid(L.distinct_clients(sums), the_plan, dims)
    dense = L.densify_ledger(grid, sums)
    series = Window.partitionBy("epk_id", "product", "item").orderBy("report_dt")
    totals = dense.withColumn("t", F.sum("pl_value").over(Window.partitionBy("epk_id", "product", "report_dt")))
    lags = [F.lag("pl_value", k - 1).over(series).alias(f"item_-{k}") for k in range(1, the_plan.history + 1)]
    leads = [F.lead("t", m).over(series).alias(f"pl_{m - 1}") for m in range(the_plan.predict + 1)]
    return totals.select("epk_id", "report_dt", "product", "item", *lags, *leads).na.drop("any")


def test_sparse_history_equals_dense_windows(spark, sf):
    sums = L.filtered_ledger(fx.ledger(spark, sf), fx.PLAN, fx.DIMENSIONS)
    dense = dense_windows(sums, fx.PLAN, fx.DIMENSIONS)
    sparse = L.windowed_ledger(fx.ledger(spark, sf), fx.PLAN, fx.DIMENSIONS)
    lags = [f"item_-{k}" for k in range(1, 7)]
    both = dense.alias("d").join(sparse.alias("s"), ["epk_id", "report_dt", "product", "item"], "full")
    gap = [F.abs(F.coalesce(F.col(f"d.`{c}`"), F.lit(0.0)) - F.coalesce(F.col(f"s.`{c}`"), F.lit(0.0))) for c in lags]
    assert both.select(F.max(F.greatest(*gap))).first()[0] < 1e-6
    assert both.where(F.col("d.`item_-1`").isNull()).isEmpty()


def test_pivots_agree_with_the_wide_dataset(spark, sf):
    windowed = L.windowed_ledger(fx.ledger(spark, sf), fx.PLAN, fx.DIMENSIONS)
    by_pivot = L.pivot_products(L.pivot_items(windowed, fx.PLAN, fx.DIMENSIONS), fx.DIMENSIONS)
    names = L.feature_names(fx.PLAN, fx.DIMENSIONS)[: -len(fx.PRODUCTS)]
    wide = T.pnl_dataset(fx.ledger(spark, sf), fx.PLAN, fx.DIMENSIONS)
    keys = ["epk_id", "report_dt"]
    columns = [*keys, *[f"`{c}`" for c in names]]
    assert by_pivot.select(*columns).exceptAll(wide.select(*columns)).isEmpty()


def test_result_does_not_depend_on_partitioning(spark, sf):
    source = fx.ledger(spark, sf)
    one = T.pnl_dataset(source, fx.PLAN, fx.DIMENSIONS)
    many = T.pnl_dataset(source.repartition(9), fx.PLAN, fx.DIMENSIONS)
    assert one.exceptAll(many).isEmpty()


def test_dataset_moves_only_combined_rows(spark, sf, tmp_path):
    """Two exchanges, the first behind a partial aggregation; no window, no sort, no pivot."""
    path = str(tmp_path / "ledger")
    fx.ledger(spark, sf).write.parquet(path)
    frame = T.pnl_dataset(spark.read.parquet(path), fx.PLAN, fx.DIMENSIONS)
    text = frame._jdf.queryExecution().sparkPlan().toString() + "\n"
    physical = frame._jdf.queryExecution().executedPlan().toString()
    assert physical.count("Exchange hashpartitioning") == 2
    assert "Window" not in text and "pivotfirst" not in text and "CartesianProduct" not in text
    lines = physical.splitlines()
    lower = max(i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line)
    assert "partial_sum" in lines[lower + 1]


def exchanged(node):
    """Names of the columns of each exchange, from the top down."""
    found = [[a.name() for a in (node.output().apply(i) for i in range(node.output().size()))]] if "ShuffleExchange" in node.nodeName() or node.nodeName() == "Exchange" else []
    for i in range(node.children().size()):
        found += exchanged(node.children().apply(i))
    return found


def test_exchanges_carry_sums_only(spark, sf):
    """Lags in currency, statistics and maps are made behind the second exchange."""
    frame = T.pnl_dataset(fx.ledger(spark, sf), fx.PLAN, fx.DIMENSIONS)
    upper, lower, *_ = exchanged(frame._jdf.queryExecution().executedPlan().initialPlan())
    sums = [f"h_{k}" for k in range(1, fx.PLAN.history + 1)] + ["f_sum"]
    assert upper == [*T.KEYS, "product", "item", *sums]
    assert len(lower) == len(upper)


def profile_rows(spark, sf):
    """Every second client, once more without ledger rows, with missing values."""
    clients = fx.ledger(spark, sf).select("epk_id").where("epk_id % 2 = 0").distinct()
    months = T.pnl_dataset(fx.ledger(spark, sf), fx.PLAN, fx.DIMENSIONS).select("report_dt").distinct()
    known = clients.union(clients.select(-F.col("epk_id") - 1)).crossJoin(F.broadcast(months))
    return known.withColumns({"age_amt": F.when(F.col("epk_id") % 4 == 0, 1.5), "name_cd": F.lit(None).cast("string")})


def test_late_widening_equals_the_join_of_wide_rows(spark, sf):
    profile, source = profile_rows(spark, sf), fx.ledger(spark, sf)
    cells = L.client_cells(L.cohort_rows(source, fx.PLAN, fx.DIMENSIONS), fx.PLAN, fx.DIMENSIONS)
    late = T.dataset_of_cells(S.profile_with_cells(profile, cells), fx.PLAN, fx.DIMENSIONS)
    early = S.feature_dataset(profile, T.pnl_dataset(source, fx.PLAN, fx.DIMENSIONS))
    assert late.columns == early.columns and late.dtypes == early.dtypes
    assert late.count() == early.count() and late.exceptAll(early).isEmpty()


def sorted_widths(node):
    """Number of columns of each sort in a plan."""
    found = [node.output().size()] if node.nodeName() == "Sort" else []
    for i in range(node.children().size()):
        found += sorted_widths(node.children().apply(i))
    return found


def test_join_sorts_no_wide_rows(spark, sf):
    profile = profile_rows(spark, sf)
    cells = L.client_cells(L.cohort_rows(fx.ledger(spark, sf), fx.PLAN, fx.DIMENSIONS), fx.PLAN, fx.DIMENSIONS)
    dataset = T.dataset_of_cells(S.profile_with_cells(profile, cells.hint("merge")), fx.PLAN, fx.DIMENSIONS)
    widths = sorted_widths(dataset._jdf.queryExecution().executedPlan().initialPlan())
    assert widths and max(widths) <= len(profile.columns)
    assert len(dataset.columns) > 300


def test_column_groups(spark, sf):
    groups = T.column_groups(T.pnl_dataset(fx.ledger(spark, sf), fx.PLAN, fx.DIMENSIONS).columns)
    assert len(groups.features) == 6 * 3 * 16 + 6
    assert len(groups.targets) == len(groups.flags) == len(groups.naive) == 6
    assert (groups.total_target, groups.total_naive) == (["total_pl_target"], ["total_pl_-1"])


def test_history_window_length_is_free(spark, sf):
    short = replace(fx.PLAN, history=3, predict=4)
    frame = T.pnl_dataset(fx.ledger(spark, sf), short, fx.DIMENSIONS)
    assert "P1_Fee_-3" in frame.columns and "P1_Fee_-4" not in frame.columns


def test_client_with_a_third_of_all_rows(spark):
    """Brute force over a ledger in which one client holds a third of the rows."""
    rng = random.Random(11)
    rows = []
    for n in range(3000):
        client = 7 if n % 3 == 0 else 100 + rng.randint(0, 40)
        rows.append((client, rng.choice([1, 2, 3]), rng.choice([10, 20, 99]), rng.randint(-8, 4), rng.randint(-500, 500) / 100))
    want = {}
    for client, product, item, offset, value in rows:
        if product == 3 or not -5 <= offset <= 2:
            continue
        row = want.setdefault(client, Counter())
        if item == 99:
            continue
        p, i = {1: "A", 2: "B"}[product], {10: "X", 20: "Y"}[item]
        if offset <= 0:
            row[f"{p}_{i}_{offset - 1}"] += round(value * 100)
        if offset == 0:
            row[f"{p}_pl_-1"] += round(value * 100)
        if offset > 0:
            row[f"{p}_pl_target"] += round(value * 100)
    got = {r["epk_id"]: r.asDict() for r in T.pnl_dataset(ledger(spark, rows), plan(), DIMS).collect()}
    assert set(got) == set(want)
    names = [f"{p}_{i}_-{k}" for p in "AB" for i in "XY" for k in range(1, 7)] + [f"{p}_{c}" for p in "AB" for c in ("pl_-1", "pl_target")]
    for client, row in want.items():
        assert {c: got[client][c] for c in names} == {c: row[c] / 100 for c in names}


def test_client_with_two_report_months_gets_both(spark):
    months = (month_end(REPORT, -1), REPORT)
    two = CohortPlan(tuple(Cell("all", 0, 0, m, m) for m in months), 1, 6, 2)
    rows = {r["report_dt"]: r for r in T.pnl_dataset(ledger(spark, [(1, 1, 10, 0, 5.0)]), two, DIMS).collect()}
    assert (rows[REPORT]["A_pl_-1"], rows[REPORT]["A_pl_target"]) == (5, 0)
    assert (rows[months[0]]["A_pl_-1"], rows[months[0]]["A_pl_target"]) == (0, 5)


def test_pivots_hold_only_rows_that_exist(spark):
    rows = [(1, "A", 1.5, None), (1, "B", 2.0, 3.0), (2, "other", 9.0, 9.0)]
    long = spark.createDataFrame(rows, "epk_id long, product string, `x_-1` double, y double").withColumn("report_dt", F.lit("2020-06-30"))
    wide = L.pivot_products(long.select("epk_id", "report_dt", "product", "`x_-1`", "y"), DIMS)
    assert wide.columns == ["epk_id", "report_dt", *[f"{p}_{c}" for p in DIMS.product_names for c in ("x_-1", "y")]]
    got = {r["epk_id"]: r for r in wide.collect()}
    assert (got[1]["A_x_-1"], got[1]["A_y"], got[1]["B_x_-1"], got[1]["B_y"]) == (1.5, 0.0, 2.0, 3.0)
    assert set(list(got[2])[2:]) == {0.0}
    text = wide._jdf.queryExecution().toString()
    assert "collect_list" in text and "first(" not in text
