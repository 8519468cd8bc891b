"""DuckDB SQL of the model operators that have a closed form (see ``oracle.py``)."""

from __future__ import annotations

from shelfwise.plans.oracle import FEATS, PANEL, TEST_SIZE, K, feature_split_ctes, r, with_

THREE = ("price", "inventory_level", "discount")
SLOTTED = ("weather_condition", "seasonality", "region", "store_id", "product_id", "category")
ALPHA = 1.0
BINS = 32


def _det(m: list[list[str]]) -> str:
    a, b, c = m
    return (f"({a[0]} * ({b[1]} * {c[2]} - {b[2]} * {c[1]}) - {a[1]} * ({b[0]} * {c[2]} - {b[2]} * {c[0]}) "
            f"+ {a[2]} * ({b[0]} * {c[1]} - {b[1]} * {c[0]}))")


def ridge_cte(name: str, where: str) -> list[str]:
    """One row of ``fl``'s ridge over three inputs: standardised w, coefficients b, intercept (Cramer's rule)."""
    stats = ["CAST(count(*) AS DOUBLE) AS n", "avg(y) AS my"]
    for i, a in enumerate(THREE):
        stats += [f"avg({a}) AS m{i}", f"stddev_pop({a}) AS s{i}", f"covar_pop({a}, y) AS cy{i}"]
        stats += [f"covar_pop({a}, {THREE[j]}) AS c{i}{j}" for j in range(i + 1, 3)]
    cell = lambda i, j: (f"(n + {ALPHA})" if i == j else
                         f"(n * c{min(i, j)}{max(i, j)} / (s{i} * s{j}))")
    rows = [[cell(i, j) for j in range(3)] for i in range(3)]
    right = [f"(n * cy{i} / s{i})" for i in range(3)]
    w = [f"{_det([[right[i] if j == k else rows[i][j] for j in range(3)] for i in range(3)])} / {_det(rows)} AS w{k}"
         for k in range(3)]
    return [f"{name}_s AS (SELECT {', '.join(stats)} FROM fl WHERE {where})",
            f"{name}_w AS (SELECT *, {', '.join(w)} FROM {name}_s)",
            f"{name} AS (SELECT *, w0 / s0 AS b0, w1 / s1 AS b1, w2 / s2 AS b2, "
            f"my - w0 / s0 * m0 - w1 / s1 * m1 - w2 / s2 * m2 AS b FROM {name}_w)"]


def _folds(fl: list[str], bounds) -> list[str]:
    ctes, parts = list(fl), []
    for i in range(5):
        lo, hi = bounds(i)
        ctes += ridge_cte(f"k{i}", f"pos < {lo}")
        told = f"k{i}.b + k{i}.b0 * {THREE[0]} + k{i}.b1 * {THREE[1]} + k{i}.b2 * {THREE[2]}"
        parts.append(f"SELECT CAST({i} AS INTEGER) AS fold, avg(abs(e)) AS mae, sqrt(avg(e * e)) AS rmse FROM "
                     f"(SELECT fl.y - ({told}) AS e FROM fl, k{i} WHERE pos >= {lo} AND pos < {hi})")
    return ctes + ["folds AS (" + " UNION ALL ".join(parts) + ")"]


def build() -> dict[str, str]:
    o: dict[str, str] = {}
    q = lambda ctes, body: with_(*ctes) + body
    fl = feature_split_ctes()[:-1] + [f"fl AS MATERIALIZED (SELECT pos, fpos.n AS total, {', '.join(THREE)}, "
                                      "least(greatest(coalesce(quantity, 0.0), 0.0), 1000000.0) AS y FROM fpos)"]
    cut = f"CAST(floor(total * (CAST(1 AS DOUBLE) - CAST({TEST_SIZE} AS DOUBLE))) AS BIGINT)"
    o["ridge_coefficients"] = q(fl + ridge_cte("f", f"pos < {cut}"), " UNION ALL ".join(
        [f"SELECT '{c}' AS feature, {r(f'b{i}')} AS coefficient, {r(f'w{i}')} AS standardised FROM f"
         for i, c in enumerate(THREE)]
        + [f"SELECT 'intercept' AS feature, {r('b')} AS coefficient, CAST(NULL AS DOUBLE) AS standardised FROM f"]))
    cv = _folds(fl, lambda i: (f"total - {5 - i} * (total // 6)", f"total - {5 - i} * (total // 6) + total // 6"))
    wf = _folds(fl, lambda i: (f"({cut} // 6) * {i + 1}", f"least(({cut} // 6) * {i + 2}, {cut})"))
    per_fold = f"SELECT 'linear_regression' AS model, fold, {r('mae')} AS mae, {r('rmse')} AS rmse FROM folds"
    o["ridge_cv"] = q(cv, per_fold)
    o["ridge_walk_forward"] = q(wf, per_fold)
    o["ridge_cv_summary"] = q(cv, f"""SELECT 'linear_regression' AS model, {r('avg(mae)')} AS mae_mean,
  {r('stddev_pop(mae)')} AS mae_std, {r('avg(rmse)')} AS rmse_mean, {r('stddev_pop(rmse)')} AS rmse_std FROM folds""")

    # every input as cells (row, input, value), zeros left out; sums over pairs of cells of a row
    names = [f"SELECT {i} AS p, '{f}' AS feature, '' AS v" for i, f in enumerate(FEATS)]
    names += [f"SELECT DISTINCT {len(FEATS) + i} AS p, '{c}' AS feature, {c} AS v FROM ftr WHERE {c} IS NOT NULL"
              for i, c in enumerate(SLOTTED)]
    cells = [f"SELECT pos, '{f}' AS feature, '' AS v, CAST({f} AS DOUBLE) AS x FROM ftr WHERE {f} <> 0" for f in FEATS]
    cells += [f"SELECT pos, '{c}' AS feature, {c} AS v, CAST(1 AS DOUBLE) AS x FROM ftr WHERE {c} IS NOT NULL" for c in SLOTTED]
    slots = feature_split_ctes() + [
        "named AS MATERIALIZED (SELECT row_number() OVER (ORDER BY p, v) - 1 AS k, "
        "CASE WHEN v = '' THEN feature ELSE feature || '_' || v END AS name, feature, v FROM (" + " UNION ALL ".join(names) + "))",
        "cells AS MATERIALIZED (SELECT pos, k, x FROM (" + " UNION ALL ".join(cells) + ") c JOIN named USING (feature, v))",
        "many AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM ftr)",
        "single AS MATERIALIZED (SELECT named.k, name, coalesce(sum(x), 0) / any_value(n) AS m, "
        "sqrt(greatest(coalesce(sum(x * x), 0) / any_value(n) - pow(coalesce(sum(x), 0) / any_value(n), 2), 0)) AS s "
        "FROM named CROSS JOIN many LEFT JOIN cells ON cells.k = named.k GROUP BY named.k, name)",
        "joint AS MATERIALIZED (SELECT a.k AS i, b.k AS j, sum(a.x * b.x) AS xy FROM cells a "
        "JOIN cells b ON a.pos = b.pos AND a.k < b.k GROUP BY a.k, b.k)",
        "cc AS (SELECT a.k AS i, b.k AS j, a.name AS feature_a, b.name AS feature_b, "
        "abs((coalesce(xy, 0) / n - a.m * b.m) / (a.s * b.s)) AS c FROM single a JOIN single b ON a.k < b.k CROSS JOIN many "
        "LEFT JOIN joint ON joint.i = a.k AND joint.j = b.k WHERE a.s > 1e-9 AND b.s > 1e-9)"]
    o["correlated_slots"] = q(slots, f"SELECT CAST(i AS INTEGER) AS i, CAST(j AS INTEGER) AS j, feature_a, feature_b, "
                                     f"{r('c')} AS abs_corr FROM cc WHERE c > 0.7")
    o["interpretation_slots"] = q(slots, f"""SELECT count(*) AS n_samples,
  CAST((SELECT count(*) FROM named) AS INTEGER) AS n_features,
  {r('count(*) / (SELECT CAST(count(*) AS DOUBLE) FROM named)')} AS samples_per_feature,
  CAST(102400 AS INTEGER) AS forest_parameter_estimate, (SELECT count(*) FROM cc WHERE c > 0.7) AS n_correlated_pairs FROM ftr""")

    o["one_hot_long"] = q(PANEL, " UNION ALL ".join(
        f"SELECT {K}, '{c}' AS feature, {c} AS value, code FROM panel JOIN (SELECT {c} AS v, row_number() OVER (ORDER BY {c}) - 1 "
        f"AS code FROM (SELECT DISTINCT {c} FROM panel WHERE {c} IS NOT NULL)) d ON panel.{c} = d.v" for c in SLOTTED))

    y = "least(greatest(coalesce(quantity, 0.0), 0.0), 1000000.0)"
    long = [f"SELECT '{f}' AS feature, CAST({f} AS DOUBLE) AS v, {y} AS y FROM ftr" for f in FEATS]
    one = [f"SELECT '{c}_' || {c} AS feature, {y} AS y FROM ftr WHERE {c} IS NOT NULL" for c in SLOTTED]
    cuts = "[" + ", ".join(f"CAST({k} AS DOUBLE) / {BINS}" for k in range(1, BINS)) + "]"
    gain = ("((tq - ts * ts / tn) - (lq - ls * ls / ln) - ((tq - lq) - (ts - ls) * (ts - ls) / (tn - ln))) / tn")
    o["split_gains"] = q(feature_split_ctes() + [
        "lg AS MATERIALIZED (" + " UNION ALL ".join(long) + ")",
        f"th AS (SELECT feature, count(DISTINCT v) AS d, quantile_cont(v, {cuts}) AS t FROM lg GROUP BY feature)",
        f"bn AS (SELECT feature, CASE WHEN d <= {BINS} THEN v ELSE coalesce(list_min(list_filter(t, lambda e: e >= v)), "
        "CAST('infinity' AS DOUBLE)) END AS b, v, y FROM lg JOIN th USING (feature))",
        "hi AS (SELECT feature, b, CAST(count(*) AS DOUBLE) AS n, sum(y) AS s, sum(y * y) AS q, min(v) AS low, max(v) AS high "
        "FROM bn GROUP BY feature, b)",
        "sd AS (SELECT feature, sum(n) OVER f AS tn, sum(s) OVER f AS ts, sum(q) OVER f AS tq, sum(n) OVER u AS ln, "
        "sum(s) OVER u AS ls, sum(q) OVER u AS lq, (high + lead(low) OVER o) / 2 AS threshold FROM hi "
        "WINDOW f AS (PARTITION BY feature), o AS (PARTITION BY feature ORDER BY b), "
        "u AS (PARTITION BY feature ORDER BY b ROWS UNBOUNDED PRECEDING))",
        "tot AS (SELECT CAST(count(*) AS DOUBLE) AS tn, sum(y) AS ts, sum(y * y) AS tq FROM (SELECT " + y + " AS y FROM ftr))",
        "os AS (SELECT feature, tn, ts, tq, tn - count(*) AS ln, ts - sum(y) AS ls, tq - sum(y * y) AS lq, "
        "CAST(0.5 AS DOUBLE) AS threshold FROM (" + " UNION ALL ".join(one) + ") CROSS JOIN tot GROUP BY feature, tn, ts, tq)",
        f"gn AS (SELECT feature, threshold, {gain} AS gain, ln, tn FROM (SELECT * FROM sd WHERE threshold IS NOT NULL "
        "UNION ALL BY NAME SELECT * FROM os WHERE ln >= 1 AND ln < tn))"],
        f"""SELECT feature, {r('arg_max(threshold, (gain, -threshold))')} AS threshold, {r('max(gain)')} AS gain,
  CAST(arg_max(ln, (gain, -threshold)) AS BIGINT) AS n_left, CAST(any_value(tn) AS BIGINT) AS n FROM gn GROUP BY feature""")
    return o


MODEL_SQL = build()
