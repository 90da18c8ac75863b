"""The same answers in DuckDB SQL, written without looking at the Spark plans.

History comes from a dense month grid with LAG and LEAD, quantiles from ``quantile_cont``, ranks
from plain windows, so an error in the sparse Spark forms cannot hide here.
"""

from __future__ import annotations

import re

from ledgercast.plans import fixtures as fx
from ledgercast.plans.catalog import GATE

P, I = fx.PRODUCTS, fx.ITEMS
H, F = fx.PLAN.history, fx.PLAN.predict
LAGS = [f"item_-{k}" for k in range(H, 0, -1)]
STATS = [
    "mean", "min", "max", "scatter", "delta_abs_mean", "delta_abs_min", "delta_abs_max",
    "delta_relative_mean", "delta_relative_min", "delta_relative_max",
]


def q(name: str) -> str:
    return f'"{name}"'


def bucket(client: str, n: int) -> str:
    return f"(('0x' || substr(md5(CAST({client} AS VARCHAR)), 1, 8))::BIGINT % {n})"


def values(rows: list[tuple]) -> str:
    return ", ".join("(" + ", ".join(repr(v) if isinstance(v, (int, str)) else f"DATE '{v}'" for v in row) + ")" for row in rows)


def cells(plan) -> str:
    rows = [(c.split, c.bin_lo, c.bin_hi, c.report_from, *plan.window(c)) for c in plan.cells]
    return f"SELECT * FROM (VALUES {values(rows)}) t(split, bin_lo, bin_hi, report_dt, win_lo, win_hi)"


def case(column: str, groups: dict) -> str:
    arms = " ".join(f"WHEN {column} IN ({', '.join(map(str, codes))}) THEN '{name}'" for name, codes in groups.items())
    return f"CASE {arms} END"


MONTHS = sorted(set(fx.PLAN.report_months() + fx.SCORING_PLAN.report_months()))

CTES: dict[str, str] = {
    "ledger": """
        SELECT o_custkey AS epk_id, last_day(o_orderdate) AS report_dt,
               CAST(replace(p_brand, 'Brand#', '') AS BIGINT) AS product_cd,
               CAST(l_linenumber AS BIGINT) AS pl_item,
               CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END
                 * CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18,4)) AS pl_val
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey""",
    "cells": cells(fx.PLAN),
    "score_cells": cells(fx.SCORING_PLAN),
    "sample": "SELECT o_custkey AS epk_id FROM orders WHERE o_orderpriority = '1-URGENT'",
    "profile": f"""
        SELECT c_custkey AS epk_id, m.report_dt,
               CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS acctbal_amt,
               CAST(NULL AS DOUBLE) AS empty_rate,
               CASE WHEN NOT (c_acctbal BETWEEN 8000 AND 9000) THEN c_mktsegment END AS mkt_segm,
               n_name AS nation_cd,
               CAST(CASE WHEN NOT (c_acctbal BETWEEN 4000 AND 5500) THEN n_regionkey END AS DOUBLE) AS region_group,
               c_name AS name_cd,
               CAST((SELECT nullif(count(*), 0) FROM orders WHERE o_custkey = c_custkey
                     AND CAST(o_orderdate AS DATE) <= m.report_dt) AS DOUBLE) AS orders_qty,
               (SELECT max(CAST(o_orderdate AS DATE)) FROM orders WHERE o_custkey = c_custkey
                     AND CAST(o_orderdate AS DATE) <= m.report_dt) AS last_order_dt
        FROM customer JOIN nation ON c_nationkey = n_nationkey,
             (VALUES {values([(m,) for m in MONTHS])}) m(report_dt)""",
    "cohort_profile": f"""
        SELECT p.*, c.split FROM profile p JOIN cells c
          ON {bucket('p.epk_id', fx.PLAN.buckets)} BETWEEN c.bin_lo AND c.bin_hi AND p.report_dt = c.report_dt""",
    "train_profile": "SELECT * EXCLUDE (split) FROM cohort_profile WHERE split = 'train'",
    "mapped": f"""
        SELECT *, {case('product_cd', fx.DIMENSIONS.products)} AS product,
               {case('pl_item', fx.DIMENSIONS.items)} AS item FROM ledger""",
    "cohort_ledger": f"""
        SELECT l.*, c.report_dt AS cohort_dt, datediff('month', c.report_dt, l.report_dt) AS o
        FROM mapped l JOIN cells c ON {bucket('l.epk_id', fx.PLAN.buckets)} BETWEEN c.bin_lo AND c.bin_hi
         AND l.report_dt BETWEEN c.win_lo AND c.win_hi""",
    "sums": """
        SELECT epk_id, product, item, report_dt, SUM(pl_val) AS v FROM cohort_ledger
        WHERE product IS NOT NULL GROUP BY ALL""",
    "clients": "SELECT DISTINCT epk_id FROM sums",
    "grid": f"""
        SELECT c.epk_id, p.product, i.item, last_day(m.m) AS report_dt, s.win_lo, s.win_hi
        FROM clients c JOIN cells s ON {bucket('c.epk_id', fx.PLAN.buckets)} BETWEEN s.bin_lo AND s.bin_hi,
             (VALUES {values([(x,) for x in P])}) p(product), (VALUES {values([(x,) for x in I])}) i(item),
             LATERAL (SELECT unnest(generate_series(date_trunc('month', s.win_lo), s.win_hi, INTERVAL 1 MONTH)) AS m) m""",
    "dense": """
        SELECT g.epk_id, g.product, g.item, g.report_dt, coalesce(s.v, 0) AS v
        FROM grid g LEFT JOIN sums s USING (epk_id, product, item, report_dt)""",
    "dense_windows": f"""
        SELECT *, {', '.join(f'LAG(v, {k}) OVER w AS lag_{k}' for k in range(H))},
               {', '.join(f'LEAD(t, {m}) OVER w AS lead_{m}' for m in range(F + 1))}
        FROM (SELECT *, SUM(v) OVER (PARTITION BY epk_id, product, report_dt) AS t FROM dense)
        WINDOW w AS (PARTITION BY epk_id, product, item ORDER BY report_dt)""",
    "whole_windows": f"SELECT * FROM dense_windows WHERE lag_{H - 1} IS NOT NULL AND lead_{F} IS NOT NULL",
    "stats": f"""
        SELECT *, ("max" - "min") / g AS scatter, delta_abs_mean / g AS delta_relative_mean,
               delta_abs_min / g AS delta_relative_min, delta_abs_max / g AS delta_relative_max
        FROM (SELECT *, CASE WHEN mean = 0 THEN 0.0001::DOUBLE ELSE mean END AS g,
                     "item_-1" - mean AS delta_abs_mean, "item_-1" - "item_-2" AS delta_abs_min,
                     "item_-1" - "item_-{H}" AS delta_abs_max
              FROM (SELECT *, ({' + '.join(q(c) for c in LAGS)}) / {H}::DOUBLE AS mean,
                           least({', '.join(q(c) for c in LAGS)}) AS "min",
                           greatest({', '.join(q(c) for c in LAGS)}) AS "max"
                    FROM (SELECT epk_id, report_dt, product, item,
                                 {', '.join(f'CAST(lag_{k - 1} AS DOUBLE) AS "item_-{k}"' for k in range(H, 0, -1))},
                                 {', '.join(f'lead_{m}' for m in range(F + 1))}
                          FROM whole_windows)))""",
    # combinations that have ledger rows at all: the sparse form has no others
    "live_stats": """
        SELECT * FROM stats s WHERE EXISTS (
          SELECT 1 FROM sums u WHERE u.epk_id = s.epk_id AND u.product = s.product AND u.item = s.item)""",
    "live_leads": f"""
        SELECT DISTINCT epk_id, report_dt, product, {', '.join(f'CAST(lead_{m} AS DOUBLE) AS "pl_{m - 1}"' for m in range(F + 1))}
        FROM whole_windows w WHERE EXISTS (
          SELECT 1 FROM sums u WHERE u.epk_id = w.epk_id AND u.product = w.product AND u.item IS NOT NULL)""",
    "outcomes": "SELECT epk_id, cohort_dt AS report_dt, "
    + ", ".join(
        f"""CAST(coalesce(SUM(pl_val) FILTER (WHERE product = '{p}' AND o = 0), 0) AS DOUBLE) AS "{p}_pl_-1",
            CAST(coalesce(SUM(pl_val) FILTER (WHERE product = '{p}' AND o > 0), 0) AS DOUBLE) AS "{p}_pl_target" """
        for p in P
    )
    + """, CAST(coalesce(SUM(pl_val) FILTER (WHERE o = 0), 0) AS DOUBLE) AS "total_pl_-1",
           CAST(coalesce(SUM(pl_val) FILTER (WHERE o > 0), 0) AS DOUBLE) AS total_pl_target
        FROM cohort_ledger WHERE product IS NOT NULL AND item IS NOT NULL GROUP BY ALL""",
    "outcomes_long": " UNION ALL ".join(
        f"""SELECT epk_id, report_dt, '{p}' AS product, "{p}_pl_-1" AS "pl_-1", "{p}_pl_target" AS pl_target FROM outcomes"""
        for p in P
    ),
    "probs": """
        SELECT *, ('0x' || substr(md5('s' || product || CAST(epk_id AS VARCHAR)), 1, 8))::BIGINT::DOUBLE / 4294967296::DOUBLE AS prob
        FROM outcomes_long""",
    "scored": """
        SELECT *, 12 * "pl_-1" AS rich, 100 * prob AS poor,
               CAST("pl_-1" = 0 AND pl_target <> 0 AS BIGINT) AS sale FROM probs""",
    "poor": """SELECT product, prob AS score, sale AS target, epk_id, report_dt FROM scored WHERE "pl_-1" = 0""",
    "poor_coarse": "SELECT * REPLACE (floor(score * 3) / 3 AS score) FROM poor",
    "poor_valid": f"""
        SELECT p.* FROM poor p JOIN cells c ON c.split = 'train' AND p.report_dt = c.report_dt
          AND {bucket('p.epk_id', fx.PLAN.buckets)} BETWEEN c.bin_lo AND c.bin_hi
        WHERE ('0x' || substr(md5(CAST(p.report_dt AS VARCHAR) || CAST(epk_id AS VARCHAR)), 1, 8))::BIGINT % 5 = 4""",
    "poor_test": f"""
        SELECT p.* FROM poor p JOIN cells c ON c.split = 'test' AND p.report_dt = c.report_dt
          AND {bucket('p.epk_id', fx.PLAN.buckets)} BETWEEN c.bin_lo AND c.bin_hi""",
    "encoding": """
        SELECT feature, value,
               CASE WHEN ties > 1 THEN (r::DOUBLE / ties + n) ELSE n::DOUBLE END / total AS code
        FROM (SELECT *, row_number() OVER (PARTITION BY feature, n ORDER BY value) - 1 AS r,
                     count(*) OVER (PARTITION BY feature, n) AS ties,
                     count(*) OVER (PARTITION BY feature) AS size, sum(n) OVER (PARTITION BY feature) AS total
              FROM category_counts) WHERE size < 500
        UNION ALL
        SELECT feature, 'other_value', -1.0::DOUBLE FROM category_counts GROUP BY feature
        HAVING count(*) < 500 AND count(*) FILTER (WHERE value = 'other_value') = 0""",
    "category_counts": " UNION ALL ".join(
        f"SELECT '{c}' AS feature, coalesce({c}, 'other_value') AS value, count(*)::BIGINT AS n FROM train_profile GROUP BY ALL"
        for c in ("mkt_segm", "nation_cd", "name_cd")
    ),
    "means": " UNION ALL ".join(
        f"SELECT '{c}' AS feature, coalesce(avg({c}), 0)::DOUBLE AS mean FROM train_profile"
        for c in ("acctbal_amt", "empty_rate", "orders_qty")
    ),
    "importances": """
        SELECT feature, s / (SELECT CAST(sum(abs(pl_val)) AS DOUBLE) FROM ledger) AS importance FROM (
          SELECT product_cd || '_' || pl_item AS feature, CAST(sum(abs(pl_val)) AS DOUBLE) AS s FROM ledger GROUP BY ALL)""",
    "running": """
        SELECT *, sum(importance) OVER (ORDER BY importance DESC, feature ROWS UNBOUNDED PRECEDING) AS running FROM importances""",
}


def encoded_columns() -> str:
    """The encoded profile; DuckDB drops ``name_cd`` where it has too many values, as the fit does."""
    mean = lambda c: f"round(coalesce({c}, (SELECT mean FROM means WHERE feature = '{c}')), 6) AS {c}_mean_na"
    code = lambda c: (
        f"round(coalesce((SELECT code FROM encoding WHERE feature = '{c}' AND value = coalesce(x.{c}, 'other_value')),"
        f" (SELECT code FROM encoding WHERE feature = '{c}' AND value = 'other_value')), 6) AS {c}"
    )
    numeric = ", ".join(f"coalesce({c}, 0)::DOUBLE AS {c}, {mean(c)}" for c in ("acctbal_amt", "empty_rate", "orders_qty"))
    return (
        f"epk_id, report_dt, {numeric}, coalesce(datediff('day', last_order_dt, report_dt), 0)::BIGINT AS last_order_dt, "
        f"{code('mkt_segm')}, {code('nation_cd')}, coalesce(region_group, -9876)::BIGINT AS region_group"
    )


def needs(text: str) -> list[str]:
    """Names of the shared tables a text reads, dependencies first."""
    found: list[str] = []

    def visit(sql: str) -> None:
        for name in CTES:
            if name not in found and re.search(rf"\b(FROM|JOIN)\s+{name}\b", sql):
                visit(CTES[name])
                if name not in found:
                    found.append(name)

    visit(text)
    return found


def sql(text: str, **extra: str) -> str:
    """Put the shared tables a query reads in front of it."""
    names = needs(" ".join([text, *extra.values()]))
    parts = [f"{n} AS ({CTES[n]})" for n in names] + [f"{n} AS ({body})" for n, body in extra.items()]
    return (f"WITH {', '.join(parts)} " if parts else "") + text


LEDGER = "epk_id, report_dt, product_cd, pl_item, CAST(pl_val AS DOUBLE) AS pl_val"
PROFILE = "epk_id, report_dt, acctbal_amt, empty_rate, mkt_segm, nation_cd, region_group, name_cd, orders_qty, last_order_dt"


def wide_features(with_months: bool) -> str:
    """Pivot of every measure over the dense form: all clients, all combinations."""
    cells_ = []
    for p in P:
        for i in I:
            for c in LAGS + STATS:
                name = f"{p}_{i}_{c.removeprefix('item_')}"
                cells_.append(f"MAX({q(c)}) FILTER (WHERE product = '{p}' AND item = '{i}') AS {q(name)}")
    for p in P:
        first = f"MAX(lead_{{m}}) FILTER (WHERE product = '{p}' AND item = '{I[0]}')"
        now = first.format(m=0)
        cells_.append(f'CAST({now} AS DOUBLE) AS "{p}_pl_-1"')
        if with_months:
            cells_ += [f'CAST({first.format(m=m)} AS DOUBLE) AS "{p}_pl_{m - 1}"' for m in range(1, F + 1)]
        else:
            target = " + ".join(first.format(m=m) for m in range(1, F + 1))
            cells_.append(f'CAST({target} AS DOUBLE) AS "{p}_pl_target"')
            cells_.append(f'CAST({now} = 0 AND ({target}) <> 0 AS BIGINT) AS "{p}_sales_pl_target"')
    if not with_months:
        one = f"FILTER (WHERE item = '{I[0]}')"
        cells_.append(f'CAST(SUM(lead_0) {one} AS DOUBLE) AS "total_pl_-1"')
        ahead = " + ".join(f"lead_{m}" for m in range(1, F + 1))
        cells_.append(f"CAST(SUM({ahead}) {one} AS DOUBLE) AS total_pl_target")
    return f"SELECT epk_id, report_dt, {', '.join(cells_)} FROM stats GROUP BY ALL"


def live_pivot(with_product: bool) -> str:
    """Pivot of the combinations that have ledger rows; the others are zero."""
    keys = "epk_id, report_dt, product" if with_product else "epk_id, report_dt"
    cells_ = []
    for p in [None] if with_product else P:
        for i in I:
            for c in LAGS + STATS:
                short = f"{i}_{c.removeprefix('item_')}"
                name = short if p is None else f"{p}_{short}"
                on = f"item = '{i}'" + ("" if p is None else f" AND product = '{p}'")
                cells_.append(f"coalesce(MAX({q(c)}) FILTER (WHERE {on}), 0) AS {q(name)}")
    return f"SELECT {keys}, {', '.join(cells_)} FROM live_stats GROUP BY ALL"


def column_report(source: str, groups: dict[str, list[str]]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{g}' AS "group", '{c}' AS "column", count(*) FILTER (WHERE {q(c)} <> 0)::BIGINT AS nonzero FROM {source}"""
        for g, names in groups.items()
        for c in names
    )


def dataset_groups() -> dict[str, list[str]]:
    features = [f"{p}_{i}_{c.removeprefix('item_')}" for p in P for i in I for c in LAGS + STATS]
    naive = [f"{p}_pl_-1" for p in P]
    return {
        "features": features + naive,
        "targets": [f"{p}_pl_target" for p in P],
        "flags": [f"{p}_sales_pl_target" for p in P],
        "naive": naive,
        "total_target": ["total_pl_target"],
        "total_naive": ["total_pl_-1"],
    }


PROFILE_GROUPS = {
    "numeric": [f"{c}_mean_na" for c in ("acctbal_amt", "empty_rate", "orders_qty")] + ["acctbal_amt", "empty_rate", "orders_qty"],
    "date": ["last_order_dt"],
    "categorical": ["mkt_segm", "nation_cd", "region_group"],
}


def wide_scores(targets: bool = True) -> str:
    """One row per client with every score column."""
    columns = []
    for p in P:
        pick = lambda c: f"MAX({c}) FILTER (WHERE product = '{p}')"
        columns.append(f'{pick(q("pl_-1"))} AS "{p}_pl_-1"')
        if targets:
            columns.append(f'{pick("pl_target")} AS "{p}_pl_target"')
            columns.append(f'{pick("sale")} AS "{p}_sales_pl_target"')
        columns.append(f'{pick("prob")} AS "{p}_sales_pl_predict_probability"')
        columns.append(f'{pick("rich")} AS "{p}_rich_pl_predict"')
        columns.append(f'{pick("poor")} AS "{p}_poor_pl_predict"')
    total_target = "o.total_pl_target, " if targets else ""
    return (
        f'SELECT epk_id, report_dt, {", ".join(columns)}, {total_target}o."total_pl_-1", 12 * o."total_pl_-1" AS "AllProducts_total_pl_predict"'
        f" FROM scored JOIN outcomes o USING (epk_id, report_dt) GROUP BY epk_id, report_dt, {total_target}o.\"total_pl_-1\""
    )


# -- calibration ---------------------------------------------------------------------------------


def binned(source: str) -> dict[str, str]:
    points = ", ".join(f"{k / 10}" for k in range(1, 10))
    return {
        "edges": f"""
            SELECT product, list_filter(list_distinct(q), lambda e: e > least) AS edges
            FROM (SELECT product, quantile_cont(score, [{points}]) AS q, min(score) AS least FROM {source} GROUP BY product)""",
        "binned": f"""
            SELECT s.*, len(list_filter(edges, lambda e: e < s.score))::BIGINT AS bin FROM {source} s JOIN edges USING (product)""",
        "bin_stats": """
            SELECT product, bin, min(score) AS score_min, max(score) AS score_max, count(*)::BIGINT AS n,
                   sum(target)::BIGINT AS positives, avg(score) AS score_mean, sum(target)::DOUBLE / count(*) AS target_rate
            FROM binned GROUP BY ALL""",
        "defaults": """
            SELECT product, CASE WHEN sum(score) = 0 OR sum(target) = 0 THEN 1::DOUBLE
                                 ELSE sum(target)::DOUBLE / sum(score) END AS coef FROM binned GROUP BY product""",
    }


def fitted(source: str, mode: str = "contiguous") -> dict[str, str]:
    upper = "score_max" if mode == "observed" else "lead(score_min) OVER (PARTITION BY product ORDER BY bin)"
    return binned(source) | {
        "sizes": "SELECT product, count(*) AS found FROM bin_stats GROUP BY product",
        "calibration": f"""
            SELECT product, bin, CASE WHEN bin = 0 THEN 0::DOUBLE ELSE score_min END AS lo,
                   CASE WHEN bin = 9 THEN 1::DOUBLE ELSE upper END AS hi,
                   CASE WHEN score_mean = 0 OR abs(1 - target_rate / score_mean) >= 0.9999::DOUBLE THEN 1::DOUBLE
                        ELSE target_rate / score_mean END AS coef
            FROM (SELECT *, {upper} AS upper FROM bin_stats) JOIN sizes USING (product) WHERE found = 10
            UNION ALL
            SELECT product, k.k::BIGINT, round(k.k::DOUBLE / 10, 2), round(k.k::DOUBLE / 10 + 0.1::DOUBLE, 2), coef
            FROM defaults JOIN sizes USING (product), range(10) k(k) WHERE found <> 10""",
    }


CALIBRATED = fitted("poor") | {
    "combined": """
        SELECT s.*, coalesce(s.prob * c.coef, 0) AS calibrated, coalesce(s.prob * c.coef, 0) * s.poor AS mix,
               CASE WHEN s."pl_-1" = 0 THEN coalesce(s.prob * c.coef, 0) * s.poor ELSE s.rich END AS product_total
        FROM scored s LEFT JOIN calibration c
          ON s.product = c.product AND s.prob >= c.lo AND (s.prob < c.hi OR (c.bin = 9 AND s.prob <= c.hi))""",
    "totals": """
        SELECT epk_id, report_dt, sum(product_total) AS total_pl_predict FROM combined GROUP BY ALL""",
    "combined_test": f"""
        SELECT p.* FROM combined p JOIN cells c ON c.split = 'test' AND p.report_dt = c.report_dt
          AND {bucket('p.epk_id', fx.PLAN.buckets)} BETWEEN c.bin_lo AND c.bin_hi""",
}


def by_products(column: str, suffix: str, digits: int) -> str:
    picks = ", ".join(f"round(MAX({column}) FILTER (WHERE product = '{p}'), {digits}) AS \"{p}_{suffix}\"" for p in P)
    return f"SELECT epk_id, report_dt, {picks} FROM combined GROUP BY ALL"


# -- metrics -------------------------------------------------------------------------------------


def regression(predict: str, target: str = "pl_target", digits: int = 4) -> str:
    return (
        f"round(avg(abs({predict} - {target})), {digits}) AS mae, round(sqrt(avg(({predict} - {target}) ** 2)), {digits}) AS rmse, "
        f"round(sum({predict}) / nullif(sum({target}), 0), {digits}) AS sum"
    )


PARTS = {
    "rich_regression_model": ('"pl_-1" <> 0', "rich"),
    "rich_regression_naive": ('"pl_-1" <> 0', '"pl_-1"'),
    "poor_regression_model": ('"pl_-1" = 0 AND pl_target <> 0', "poor"),
    "poor_mix_model": ('"pl_-1" = 0', "mix"),
    "poor_mix_naive": ('"pl_-1" = 0', '"pl_-1"'),
    "product_total_model": ("true", "product_total"),
    "product_total_naive": ("true", '"pl_-1"'),
    "product_total_naive_year": ("true", '("pl_-1" * 12)'),
}


def parts(*names: str) -> str:
    return " UNION ALL ".join(
        f"SELECT product, '{n}' AS part, {regression(PARTS[n][1])} FROM combined_test WHERE {PARTS[n][0]} GROUP BY product" for n in names
    )


TOTALS = {"total_mix_model": "total_pl_predict", "total_single_model": '(12 * "total_pl_-1")', "total_naive_year": '("total_pl_-1" * 12)'}
TOTAL_PARTS = " UNION ALL ".join(
    f"SELECT '{n}' AS part, {regression(c, 'total_pl_target')} FROM totals JOIN outcomes USING (epk_id, report_dt)"
    " SEMI JOIN combined_test USING (epk_id, report_dt)"
    for n, c in TOTALS.items()
)


def curve(source: str) -> dict[str, str]:
    return {
        "steps": f"""
            SELECT product, score, sum(target)::DOUBLE AS tp, (count(*) - sum(target))::DOUBLE AS fp, sum(score) AS s
            FROM {source} GROUP BY ALL""",
        "curve": """
            SELECT *, sum(tp) OVER w - tp AS tp0, sum(fp) OVER w - fp AS fp0,
                   sum(tp) OVER (PARTITION BY product) AS np, sum(fp) OVER (PARTITION BY product) AS nn
            FROM steps WINDOW w AS (PARTITION BY product ORDER BY score DESC)""",
    }


ROC = "sum(fp * (tp0 + tp / 2)) / nullif(max(np) * max(nn), 0)"
PR = """sum(tp * ((tp0 + tp) / (tp0 + tp + fp0 + fp)
          + CASE WHEN tp0 + fp0 = 0 THEN (tp0 + tp) / (tp0 + tp + fp0 + fp) ELSE tp0 / (tp0 + fp0) END) / 2) / nullif(max(np), 0)"""


def ranking(digits: int = 9) -> str:
    return (
        f"SELECT product, round({ROC}, {digits}) AS roc_auc, round({PR}, {digits}) AS pr_auc, "
        f"round(sum(s) / nullif(max(np), 0), {digits}) AS sum FROM curve GROUP BY product"
    )


def long_metrics(source: str, product: str, part: str, names: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT 'test' AS scope, {product} AS product, {part} AS part, '{n}' AS metric, {q(n)} AS value FROM ({source})" for n in names
    )


REGRESSION = ["mae", "rmse", "sum"]


def with_clients(cells_name: str, n: int, columns: str) -> str:
    return (
        f"SELECT {columns}, count(c_custkey)::BIGINT AS clients FROM {cells_name} LEFT JOIN customer"
        f" ON {bucket('c_custkey', n)} BETWEEN bin_lo AND bin_hi GROUP BY ALL"
    )


def shift(n: int) -> str:
    day = "CAST(o_orderdate AS DATE)"
    if n <= 0:
        return f"last_day(last_day({day}) + to_months({n}))"
    return f"last_day(last_day({day}) + to_months(CASE WHEN last_day({day}) = {day} THEN {n} ELSE {n - 1} END))"


def flagged(where: str) -> str:
    return f"""
        SELECT o.epk_id, o.report_dt, "total_pl_-1", total_pl_target,
          ('0x' || substr(md5(CAST(o.report_dt AS VARCHAR) || CAST(epk_id AS VARCHAR)), 1, 8))::BIGINT % 5 = 4 AS is_valid
        FROM outcomes o JOIN cells c ON c.split = 'train' AND o.report_dt = c.report_dt
          AND {bucket('o.epk_id', fx.PLAN.buckets)} BETWEEN c.bin_lo AND c.bin_hi WHERE {where}"""


def live(*columns: str) -> str:
    return sql(f"SELECT epk_id, report_dt, product, item, {', '.join(map(q, columns))} FROM live_stats")


BORDERS = [round(0.9 + k * 0.001, 3) for k in range(99)]
CUTOFF = {
    "borders": f"""
        SELECT b, (SELECT count(*) FROM running WHERE running < b) AS below
        FROM (VALUES {', '.join(f'({b}::DOUBLE)' for b in BORDERS)}) t(b)""",
    "border": """
        SELECT CASE WHEN (SELECT below FROM borders WHERE b = 0.95::DOUBLE) < 100
               THEN coalesce((SELECT min(b) FROM borders WHERE b >= 0.95::DOUBLE AND below >= 100), 0.998::DOUBLE)
               ELSE coalesce((SELECT max(b) FROM borders WHERE b <= 0.95::DOUBLE AND below < 100), 0.9::DOUBLE) END AS b""",
}


ORACLE: dict[str, str] = {
    "scan_ledger": sql(f"SELECT {LEDGER} FROM ledger"),
    "scan_profile": sql(f"SELECT {PROFILE} FROM profile"),
    "scan_client_sample": sql("SELECT epk_id FROM sample"),
    "product_dim": f"""
        SELECT CAST(replace(p_brand, 'Brand#', '') AS BIGINT) AS product_cd,
               {case("CAST(replace(p_brand, 'Brand#', '') AS BIGINT)", fx.DIMENSIONS.products)} AS product, count(*)::BIGINT AS parts
        FROM part GROUP BY ALL HAVING product IS NOT NULL""",
    "item_dim": f"""
        SELECT CAST(l_linenumber AS BIGINT) AS pl_item, {case('l_linenumber', fx.DIMENSIONS.items)} AS item, count(*)::BIGINT AS lines
        FROM lineitem GROUP BY ALL HAVING item IS NOT NULL""",
    "month_dim": sql(
        """SELECT m.report_dt, count(l.report_dt)::BIGINT AS rows
           FROM (SELECT DISTINCT last_day(m) AS report_dt FROM cells,
                 LATERAL (SELECT unnest(generate_series(date_trunc('month', win_lo), win_hi, INTERVAL 1 MONTH)) AS m)) m
           LEFT JOIN ledger l USING (report_dt) GROUP BY ALL"""
    ),
    "stage_write": sql("SELECT epk_id, product, item, report_dt, CAST(v AS DOUBLE) AS pl_value FROM sums"),
    "stage_read": sql("SELECT DISTINCT epk_id FROM ledger"),
    "score_sink": sql("SELECT epk_id, report_dt, round(total_pl_predict, 4) AS total_pl_predict FROM totals", **CALIBRATED),
    "month_end_shift": f"SELECT o_orderkey, {shift(-1)} AS back_1, {shift(0)} AS same_0, {shift(1)} AS next_1, {shift(12)} AS next_12 FROM orders",
    "report_months_window": sql(
        f"""SELECT report_dt, last_day(report_dt + to_months(k.k::INTEGER)) AS month, count(*)::BIGINT AS rows
            FROM ledger, range({1 - H}, {F + 1}) k(k) GROUP BY ALL"""
    ),
    "cohort_months": f"""
        SELECT DISTINCT o_orderpriority, last_day(last_day(r.m) + to_months(k.k::INTEGER)) AS report_dt
        FROM (SELECT o_orderpriority, unnest(generate_series(date_trunc('month', lo), hi, INTERVAL 1 MONTH)) AS m
              FROM (SELECT o_orderpriority, min(o_orderdate) AS lo, max(o_orderdate) AS hi FROM orders GROUP BY ALL)) r, range({1 - H}, {F + 1}) k(k)""",
    "cohort_plan": sql(with_clients("cells", fx.PLAN.buckets, "split, bin_lo::BIGINT AS bin_lo, bin_hi::BIGINT AS bin_hi, report_dt")),
    "scoring_cohort_plan": sql(
        with_clients("score_cells", 1, "split, bin_lo::BIGINT AS bin_lo, bin_hi::BIGINT AS bin_hi, report_dt, win_lo, win_hi")
    ),
    "client_bucket": f"SELECT c_custkey AS epk_id, {bucket('c_custkey', 30)} AS bucket_30, {bucket('c_custkey', 300)} AS bucket_300 FROM customer",
    "cohort_windows": sql(
        with_clients("cells", fx.PLAN.buckets, "split, bin_lo::BIGINT AS bin_lo, bin_hi::BIGINT AS bin_hi, report_dt, win_lo, win_hi")
    ),
    "cohort_filter_ledger": sql(f"SELECT {LEDGER} FROM cohort_ledger"),
    "cohort_filter_profile": sql(f"SELECT {PROFILE} FROM cohort_profile"),
    "cohort_filter_train": sql(f"SELECT {PROFILE} FROM cohort_profile WHERE split = 'train'"),
    "cohort_filter_test": sql(f"SELECT {PROFILE} FROM cohort_profile WHERE split = 'test'"),
    "select_by_suffix": sql(f"SELECT {PROFILE} FROM profile"),
    "select_feature_sample": sql("SELECT epk_id, report_dt, acctbal_amt, mkt_segm, orders_qty FROM profile"),
    "product_allowlist": sql(f"SELECT {LEDGER} FROM mapped WHERE product IS NOT NULL"),
    "segment_rich": sql("""SELECT * FROM outcomes_long WHERE "pl_-1" <> 0"""),
    "segment_poor": sql("""SELECT * FROM outcomes_long WHERE "pl_-1" = 0"""),
    "segment_poor_sold": sql("""SELECT * FROM outcomes_long WHERE "pl_-1" = 0 AND pl_target <> 0"""),
    "validation_flag": sql(flagged("true")),
    "validation_rows": sql(f"SELECT * FROM ({flagged('true')}) WHERE is_valid"),
    "complete_windows_only": sql("SELECT epk_id, product, item, report_dt FROM whole_windows"),
    "column_groups": sql(column_report("wide", dataset_groups()), wide=wide_features(False)),
    "profile_feature_groups": sql(
        column_report("encoded", PROFILE_GROUPS), encoded=f"SELECT {encoded_columns()} FROM cohort_profile x"
    ),
    "drop_targets_for_scoring": sql(wide_scores(targets=False)),
    "prediction_projection": sql(wide_scores()),
    "ledger_client_sample": sql(f"SELECT {LEDGER} FROM ledger WHERE epk_id IN (SELECT epk_id FROM sample)"),
    "profile_client_sample": sql(f"SELECT {PROFILE} FROM profile WHERE epk_id IN (SELECT epk_id FROM sample)"),
    "map_products": sql(f"SELECT {LEDGER}, product FROM mapped"),
    "map_items": sql(f"SELECT {LEDGER}, item FROM mapped"),
    "attribute_grid": sql(
        f"""SELECT product, item, report_dt FROM (SELECT DISTINCT report_dt FROM ledger),
            (VALUES {values([(x,) for x in P])}) p(product), (VALUES {values([(x,) for x in I])}) i(item)"""
    ),
    "client_grid": sql("SELECT epk_id, product, item, report_dt FROM grid"),
    "densify_ledger": sql("SELECT epk_id, product, item, report_dt, CAST(v AS DOUBLE) AS pl_value FROM dense"),
    "feature_dataset": sql(
        "SELECT e.*, " + ", ".join(f"coalesce(w.{q(c)}, 0) AS {q(c)}" for g, cs in dataset_groups().items() if g != "naive" for c in cs)
        + " FROM encoded e LEFT JOIN wide w USING (epk_id, report_dt)",
        encoded=f"SELECT {encoded_columns()} FROM cohort_profile x",
        wide=wide_features(False),
    ),
    "ledger_sum_by_code": sql(
        "SELECT epk_id, product_cd, report_dt, pl_item, CAST(SUM(pl_val) AS DOUBLE) AS pl_value FROM ledger GROUP BY ALL"
    ),
    "ledger_sum_by_group": sql(
        """SELECT epk_id, product, item, report_dt, CAST(SUM(pl_val) AS DOUBLE) AS pl_value FROM mapped
           WHERE product IS NOT NULL GROUP BY ALL"""
    ),
    "numeric_means": sql("SELECT feature, round(mean, 6) AS mean FROM means"),
    "category_counts": sql("SELECT * FROM category_counts"),
    "category_cardinality_gate": sql(
        f"""SELECT feature, value, n, (sum(n) OVER (PARTITION BY feature))::BIGINT AS total FROM category_counts
            QUALIFY count(*) OVER (PARTITION BY feature) < {GATE}"""
    ),
    "distinct_clients": sql("SELECT epk_id FROM clients"),
    "pivot_items": sql(live_pivot(True)),
    "pivot_products": sql(live_pivot(False)),
    "ratio_of_sums": sql("SELECT product, round(sum(rich) / nullif(sum(pl_target), 0), 9) AS ratio FROM scored GROUP BY product"),
    "item_history_lags": live(*LAGS),
    "product_month_total": sql(
        """SELECT DISTINCT epk_id, product, report_dt, CAST(SUM(pl_val) OVER (PARTITION BY epk_id, product, report_dt) AS DOUBLE) AS pl_total
           FROM mapped WHERE product IS NOT NULL AND item IS NOT NULL"""
    ),
    "product_total_leads": sql("SELECT * FROM live_leads"),
    "category_tie_rank": sql(
        """SELECT feature, value, n, row_number() OVER (PARTITION BY feature, n ORDER BY value) - 1 AS tie_rank,
                  count(*) OVER (PARTITION BY feature, n) AS n_tied
           FROM (SELECT * FROM category_counts QUALIFY count(*) OVER (PARTITION BY feature) < 500)"""
    ),
    "importance_cumsum": sql("SELECT feature, round(importance, 9) AS importance, round(running, 9) AS running FROM running"),
    "importance_cutoff": sql(
        """SELECT feature, round(importance, 9) AS importance, round(running, 9) AS running FROM running, border
           WHERE running < border.b OR running = importance""",
        **CUTOFF,
    ),
    "top_features": """
        SELECT feature, round(s / (SELECT CAST(sum(CAST(l_extendedprice AS DECIMAL(18,4))) AS DOUBLE) FROM lineitem), 12) AS importance
        FROM (SELECT CAST(l_partkey AS VARCHAR) AS feature, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,4))) AS DOUBLE) AS s
              FROM lineitem GROUP BY ALL) ORDER BY s DESC, feature LIMIT 300""",
    "ledger_sort": sql("SELECT epk_id, product, item, report_dt, CAST(v AS DOUBLE) AS pl_value FROM sums"),
    "layout_hints": sql("SELECT epk_id, product, item, report_dt, CAST(v AS DOUBLE) AS pl_value FROM sums"),
    "row_mean": live("mean"),
    "row_min_max": live("min", "max"),
    "scatter": live("scatter"),
    "delta_abs": live("delta_abs_mean", "delta_abs_min", "delta_abs_max"),
    "delta_relative": live("delta_relative_mean", "delta_relative_min", "delta_relative_max"),
    "no_history_case": sql(
        """SELECT epk_id, cohort_dt AS report_dt, product, item,
                  CAST(coalesce(SUM(pl_val) FILTER (WHERE o = 0), 0) AS DOUBLE) AS "item_-1"
           FROM cohort_ledger WHERE product IS NOT NULL AND item IS NOT NULL AND o >= 0 GROUP BY ALL"""
    ),
    "product_target": sql(
        "SELECT epk_id, report_dt, " + ", ".join(f'"{p}_pl_-1", "{p}_pl_target"' for p in P) + " FROM outcomes"
    ),
    "sale_flag": sql(
        "SELECT epk_id, report_dt, "
        + ", ".join(f'CAST("{p}_pl_-1" = 0 AND "{p}_pl_target" <> 0 AS BIGINT) AS "{p}_sales_pl_target"' for p in P)
        + " FROM outcomes"
    ),
    "total_naive_and_target": sql("""SELECT epk_id, report_dt, "total_pl_-1", total_pl_target FROM outcomes"""),
    "scoring_total_naive": sql(
        """SELECT epk_id, c.report_dt, CAST(coalesce(SUM(pl_val) FILTER (WHERE l.report_dt = c.report_dt AND item IS NOT NULL), 0) AS DOUBLE) AS "total_pl_-1"
           FROM mapped l JOIN score_cells c ON l.report_dt BETWEEN c.win_lo AND c.win_hi WHERE product IS NOT NULL GROUP BY ALL"""
    ),
    "date_recency": sql(
        "SELECT epk_id, report_dt, coalesce(datediff('day', last_order_dt, report_dt), 0)::BIGINT AS last_order_dt FROM profile"
    ),
    "dual_imputation": sql(
        "SELECT epk_id, report_dt, acctbal_amt, acctbal_amt_mean_na, empty_rate, empty_rate_mean_na, orders_qty, orders_qty_mean_na FROM encoded",
        encoded=f"SELECT {encoded_columns()} FROM cohort_profile x",
    ),
    "category_fill": sql(
        """SELECT epk_id, report_dt, coalesce(mkt_segm, 'other_value') AS mkt_segm, nation_cd, name_cd,
                  coalesce(region_group, -9876)::BIGINT AS region_group FROM profile"""
    ),
    "category_frequency": sql("SELECT feature, value, round(code, 12) AS code FROM encoding"),
    "category_encode": sql(
        """SELECT epk_id, report_dt, round(m.code, 12) AS mkt_segm, round(n.code, 12) AS nation_cd FROM cohort_profile p
           JOIN encoding m ON m.feature = 'mkt_segm' AND m.value = coalesce(p.mkt_segm, 'other_value')
           JOIN encoding n ON n.feature = 'nation_cd' AND n.value = p.nation_cd"""
    ),
    "cohort_split": sql(
        f"""SELECT c.split, epk_id, o.report_dt, "total_pl_-1", total_pl_target FROM outcomes o
            JOIN cells c ON {bucket('o.epk_id', fx.PLAN.buckets)} BETWEEN c.bin_lo AND c.bin_hi AND o.report_dt = c.report_dt"""
    ),
    "positive_probability": sql("SELECT epk_id, report_dt, product, prob AS probability FROM probs"),
    "apply_calibration": sql(by_products("calibrated", "sales_pl_predict_probability_calibrated", 9), **CALIBRATED),
    "poor_mix": sql(by_products("mix", "poor_mix_pl_predict", 6), **CALIBRATED),
    "product_total_prediction": sql(by_products("product_total", "total_pl_predict", 4), **CALIBRATED),
    "total_prediction": sql("SELECT epk_id, report_dt, round(total_pl_predict, 4) AS total_pl_predict FROM totals", **CALIBRATED),
    "naive_year": sql("""SELECT epk_id, report_dt, "total_pl_-1" * 12 AS "total_pl_-1_year" FROM outcomes"""),
    "score_quantile_bins": sql("SELECT product, score, target, bin FROM binned", **binned("poor")),
    "calibration_bin_stats": sql(
        """SELECT product, bin, score_min, score_max, n, positives, round(score_mean, 9) AS score_mean, round(target_rate, 9) AS target_rate
           FROM bin_stats""",
        **binned("poor"),
    ),
    "calibration_default": sql("SELECT product, round(coef, 9) AS coef FROM defaults", **binned("poor")),
    "calibration_fit": sql("SELECT * REPLACE (round(coef, 9) AS coef) FROM calibration", **fitted("poor")),
    "calibration_fit_observed": sql("SELECT * REPLACE (round(coef, 9) AS coef) FROM calibration", **fitted("poor", "observed")),
    "calibration_fit_equal_width": sql("SELECT * REPLACE (round(coef, 9) AS coef) FROM calibration", **fitted("poor_coarse")),
    "calibration_job": sql("SELECT * REPLACE (round(coef, 9) AS coef) FROM calibration", **fitted("poor_valid")),
    "regression_metrics": sql(f"SELECT product, {regression('rich')} FROM scored GROUP BY product"),
    "roc_auc": sql(f"SELECT product, round({ROC}, 9) AS roc_auc FROM curve GROUP BY product", **curve("poor")),
    "pr_auc": sql(f"SELECT product, round({PR}, 9) AS pr_auc FROM curve GROUP BY product", **curve("poor")),
    "classification_metrics": sql(ranking(), **curve("poor")),
    "classification_metrics_tied": sql(ranking(), **curve("poor_coarse")),
    "eval_rich": sql(parts("rich_regression_model", "rich_regression_naive"), **CALIBRATED),
    "eval_poor_regression": sql(parts("poor_regression_model"), **CALIBRATED),
    "eval_poor_mix": sql(parts("poor_mix_model", "poor_mix_naive"), **CALIBRATED),
    "eval_product_total": sql(parts("product_total_model", "product_total_naive", "product_total_naive_year"), **CALIBRATED),
    "eval_sale": sql(ranking(), **curve("poor_test")),
    "eval_total": sql(TOTAL_PARTS, **CALIBRATED),
    "metrics_report": sql(
        " UNION ALL ".join(
            [
                long_metrics(parts(*PARTS), "product", "part", REGRESSION),
                long_metrics(ranking(4), "product", "'poor_classification_model'", ["roc_auc", "pr_auc", "sum"]),
                long_metrics(TOTAL_PARTS, "'all'", "part", REGRESSION),
            ]
        ),
        **CALIBRATED,
        **curve("poor_test"),
    ),
    "assemble_features": sql(
        f"""SELECT epk_id, report_dt, {len(P)}::BIGINT AS features, "{P[0]}_pl_-1" AS first, "{P[-1]}_pl_-1" AS last FROM outcomes"""
    ),
    "sample_rows": sql(
        """SELECT epk_id, report_dt FROM profile
           WHERE ('0x' || substr(md5('23|' || CAST(report_dt AS VARCHAR) || '|' || CAST(epk_id AS VARCHAR)), 1, 8))::BIGINT % 10000 < 1000"""
    ),
    "ensemble_scores": sql(
        """SELECT epk_id, report_dt, sum(value * weight) AS total, round(1 / (1 + exp(-2 * sum(value * weight))), 9) AS chance,
                  round(sum(value * weight) / count(*), 9) AS mean, count(*) AS trees
           FROM level3 JOIN nodes USING (tree, node) GROUP BY epk_id, report_dt""",
        nodes=f"""SELECT tree, node, (3 * tree + 5 * node) % {len(P)} AS feature, ((31 * tree + 17 * node) % 13 - 6) * 500.0::DOUBLE AS threshold,
                  ((7 * tree + 3 * node) % 11 - 5) * 0.25::DOUBLE AS value, CASE WHEN tree = 0 THEN 1.0::DOUBLE ELSE 0.5::DOUBLE END AS weight
                  FROM range({fx.TREES}) t(tree), range({2 ** (fx.LEVELS + 1) - 1}) n(node)""",
        level0=f"""SELECT epk_id, report_dt, [{", ".join(f'"{p}_pl_-1"' for p in P)}] AS x, tree, 0::BIGINT AS node
                   FROM outcomes, range({fx.TREES}) t(tree)""",
        **{
            f"level{k}": f"""SELECT l.epk_id, l.report_dt, l.x, l.tree, 2 * l.node + CASE WHEN x[feature + 1] <= threshold THEN 1 ELSE 2 END AS node
                             FROM level{k - 1} l JOIN nodes n ON l.tree = n.tree AND l.node = n.node"""
            for k in range(1, fx.LEVELS + 1)
        },
    ),
    "pnl_features": sql(wide_features(True)),
    "pnl_dataset": sql(wide_features(False)),
    "profile_fit": sql(
        "SELECT feature, 'mean' AS value, round(mean, 6) AS code FROM means UNION ALL SELECT feature, value, round(code, 6) FROM encoding"
    ),
    "profile_transform": sql(f"SELECT {encoded_columns()} FROM cohort_profile x"),
}


def scoring_oracle() -> str:
    """Scoring features by conditional sums over the six months up to the scoring month."""
    lags = ", ".join(f'CAST(coalesce(SUM(pl_val) FILTER (WHERE o = {1 - k}), 0) AS DOUBLE) AS "item_-{k}"' for k in range(H, 0, -1))
    extra = {
        "score_rows": """
            SELECT l.*, c.report_dt AS cohort_dt, datediff('month', c.report_dt, l.report_dt) AS o FROM mapped l JOIN score_cells c
              ON l.report_dt BETWEEN c.win_lo AND c.win_hi WHERE product IS NOT NULL""",
        "score_items": f"SELECT epk_id, cohort_dt AS report_dt, product, item, {lags} FROM score_rows WHERE item IS NOT NULL GROUP BY ALL",
        "score_base": f"""
            SELECT *, ({' + '.join(q(c) for c in LAGS)}) / {H}::DOUBLE AS mean, least({', '.join(q(c) for c in LAGS)}) AS "min",
                   greatest({', '.join(q(c) for c in LAGS)}) AS "max" FROM score_items""",
        "score_deltas": f"""
            SELECT *, CASE WHEN mean = 0 THEN 0.0001::DOUBLE ELSE mean END AS g, "item_-1" - mean AS delta_abs_mean,
                   "item_-1" - "item_-2" AS delta_abs_min, "item_-1" - "item_-{H}" AS delta_abs_max FROM score_base""",
        "score_stats": """
            SELECT *, ("max" - "min") / g AS scatter, delta_abs_mean / g AS delta_relative_mean,
                   delta_abs_min / g AS delta_relative_min, delta_abs_max / g AS delta_relative_max FROM score_deltas""",
        "score_now": "SELECT epk_id, cohort_dt AS report_dt, "
        + ", ".join(f"""CAST(SUM(pl_val) FILTER (WHERE product = '{p}' AND o = 0) AS DOUBLE) AS "{p}_pl_-1" """ for p in P)
        + """, CAST(SUM(pl_val) FILTER (WHERE o = 0) AS DOUBLE) AS "total_pl_-1" FROM score_rows WHERE item IS NOT NULL GROUP BY ALL""",
        "score_wide": "SELECT epk_id, report_dt, "
        + ", ".join(
            f"MAX({q(c)}) FILTER (WHERE product = '{p}' AND item = '{i}') AS {q(f'{p}_{i}_' + c.removeprefix('item_'))}"
            for p in P
            for i in I
            for c in LAGS + STATS
        )
        + " FROM score_stats GROUP BY ALL",
        "score_encoded": f"SELECT {encoded_columns()} FROM profile x WHERE report_dt = (SELECT report_dt FROM score_cells)",
    }
    items = [f"{p}_{i}_{c.removeprefix('item_')}" for p in P for i in I for c in LAGS + STATS]
    now = [f"{p}_pl_-1" for p in P] + ["total_pl_-1"]
    columns = ", ".join([f"coalesce(w.{q(c)}, 0) AS {q(c)}" for c in items] + [f"coalesce(n.{q(c)}, 0) AS {q(c)}" for c in now])
    return sql(
        f"""SELECT e.*, {columns} FROM score_encoded e LEFT JOIN score_wide w USING (epk_id, report_dt)
            LEFT JOIN score_now n USING (epk_id, report_dt)""",
        **extra,
    )


ORACLE["scoring_features"] = scoring_oracle()
