"""Independent DuckDB SQL for every SQL-checkable query in ``queries.py``.

Written from the operator definitions, not from the Spark plans: positions come
from a global ``row_number``, modes from ordered aggregates, breakdowns from
UNION ALL. Doubles use the same tie-free rounding as ``finish``.
"""

from __future__ import annotations

from statistics import NormalDist

K = "date, store_id, product_id, category, region"
KP = "store_id, product_id, category, region"
TEST_SIZE = 0.2
DIMENSIONS = {"Weather Condition": "weather_condition", "Seasonality": "seasonality",
              "Region": "region"}
FEATS = ["price", "inventory_level", "units_ordered", "discount", "competitor_pricing",
         "is_holiday", "is_promotion", "day_of_week", "month", "quarter",
         "day_of_month", "is_weekend", "lag_1", "lag_7", "lag_30", "ma_7", "ma_30"]


# The advice each triggered risk carries.
AT_PREDICTION_TIME = "Review feature temporal semantics: ensure all features are available at prediction time."
ADVICE = {
    "inventory_negative_values": AT_PREDICTION_TIME,
    "inventory_temporal_correlation": "Consider excluding 'Inventory Level' if it represents end-of-day values, "
                                      "or transform to start-of-day values.",
    "units_ordered_negative_values": AT_PREDICTION_TIME,
    "units_ordered_future_pattern": "Consider excluding 'Units Ordered' if it represents future orders to be placed.",
}


def r(x: str, d: int = 4) -> str:
    """Tie-free rounding, mirrored from ``functions.numeric.stable_round``."""
    return f"CAST(floor(({x}) * {10 ** d}.0 + 0.501) / {10 ** d}.0 AS DOUBLE)"


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" if ctes else ""


SEASON = ("CASE quarter(l.l_shipdate) WHEN 1 THEN 'Winter' WHEN 2 THEN 'Spring' "
          "WHEN 3 THEN 'Summer' ELSE 'Autumn' END")
JOINS = ("FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey "
         "JOIN part p ON l.l_partkey = p.p_partkey JOIN supplier s ON l.l_suppkey = s.s_suppkey "
         "JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN region rg ON n.n_regionkey = rg.r_regionkey")


def raw_cte(product: str = "p.p_brand", drop_inventory: bool = False) -> str:
    inv = "" if drop_inventory else "CAST(p.p_size AS DOUBLE) AS inventory_level, "
    return f"""raw AS (SELECT CAST(l.l_shipdate AS DATE) AS date, n.n_name AS store_id,
  {product} AS product_id, p.p_type AS category, rg.r_name AS region,
  l.l_quantity AS units_sold, l.l_extendedprice / NULLIF(l.l_quantity, 0) AS price,
  o.o_orderpriority AS weather_condition, {SEASON} AS seasonality,
  {inv}CAST(l.l_linenumber AS DOUBLE) AS units_ordered,
  l.l_discount AS discount, p.p_retailprice AS competitor_pricing,
  CAST(l.l_returnflag = 'R' AS INTEGER) AS holiday, CAST(l.l_discount >= 0.05 AS INTEGER) AS promotion
  {JOINS})"""


DIRTY = f"""dj AS (SELECT l.l_orderkey AS k, CAST(l.l_shipdate AS DATE) AS d, l.l_quantity AS q,
  l.l_extendedprice / NULLIF(l.l_quantity, 0) AS pr, n.n_name, p.p_brand, p.p_type, rg.r_name,
  o.o_orderpriority, p.p_size, l.l_linenumber, l.l_discount, p.p_retailprice, {SEASON} AS season {JOINS}),
drows AS (SELECT
  CASE WHEN k % 113 = 0 THEN 'not a date' WHEN k % 7 = 0 THEN strftime(d, '%m/%d/%Y')
       ELSE strftime(d, '%Y-%m-%d') END AS date_text,
  n_name AS store_id,
  CASE WHEN k % 107 = 0 THEN NULL ELSE p_brand END AS product_id,
  CASE WHEN k % 109 = 0 THEN NULL ELSE p_type END AS category,
  r_name AS region,
  CASE WHEN k % 103 = 0 THEN NULL WHEN k % 127 = 0 THEN 'n/a'
       ELSE CAST(CASE WHEN k % 101 = 0 THEN -q ELSE q END AS VARCHAR) END AS units_sold,
  CASE WHEN k % 131 = 0 THEN 'unknown' ELSE CAST(CASE WHEN k % 89 = 0 THEN -pr ELSE pr END AS VARCHAR) END AS price,
  o_orderpriority AS weather_condition, season AS seasonality,
  CAST(p_size AS DOUBLE) AS inventory_level, CAST(l_linenumber AS DOUBLE) AS units_ordered,
  l_discount AS discount, p_retailprice AS competitor_pricing, k FROM dj),
dirty AS (SELECT * EXCLUDE (k) FROM drows UNION ALL SELECT * EXCLUDE (k) FROM drows WHERE k % 97 = 0)"""


def parse_date_sql(col: str) -> str:
    fmts = ["%Y-%m-%d", "%m/%d/%Y", "%Y/%m/%d", "%m-%d-%Y", "%d.%m.%Y", "%Y%m%d"]
    parts = ", ".join(f"try_strptime(trim({col}), '{f}')" for f in fmts)
    return f"CAST(coalesce({parts}) AS DATE)"


def num(col: str) -> str:
    return f"CASE WHEN {col} IS NULL THEN NULL ELSE coalesce(TRY_CAST({col} AS DOUBLE), 0.0) END"


TYPED = f"""typed AS (SELECT {parse_date_sql('date_text')} AS date, store_id, product_id, category, region,
  {num('units_sold')} AS units_sold, {num('price')} AS price, weather_condition, seasonality,
  inventory_level, units_ordered, discount, competitor_pricing FROM dirty)"""


def fix_ctes(src: str, cols: list[str]) -> list[str]:
    sel = ", ".join("coalesce(m.modal, t.category) AS category" if c == "category" else f"t.{c}" for c in cols)
    return [
        f"""catcount AS (SELECT product_id, category, count(*) AS c FROM {src}
  WHERE product_id IS NOT NULL AND category IS NOT NULL GROUP BY product_id, category)""",
        """modal AS (SELECT product_id, first(category ORDER BY c DESC, category ASC) AS modal
  FROM catcount GROUP BY product_id HAVING count(*) > 1)""",
        f"fixed AS (SELECT {sel} FROM {src} t LEFT JOIN modal m ON t.product_id = m.product_id)",
    ]


RAW_COLS = ["date", "store_id", "product_id", "category", "region", "units_sold", "price",
            "weather_condition", "seasonality", "inventory_level", "units_ordered", "discount",
            "competitor_pricing", "holiday", "promotion"]
TYPED_COLS = ["date", "store_id", "product_id", "category", "region", "units_sold", "price",
              "weather_condition", "seasonality", "inventory_level", "units_ordered", "discount",
              "competitor_pricing"]


def impute_cte(src="fixed", name="imputed", cols=RAW_COLS):
    sel = ", ".join("coalesce(units_sold, 0.0) AS units_sold" if c == "units_sold" else c for c in cols)
    return f"{name} AS (SELECT {sel} FROM {src} WHERE product_id IS NOT NULL AND category IS NOT NULL)"


def clamp_cte(src="deduped", name="clean", cols=RAW_COLS):
    def one(c):
        if c in ("units_sold", "price"):
            return f"CASE WHEN {c} < 0 THEN 0.0 ELSE {c} END AS {c}"
        return c
    return f"{name} AS (SELECT {', '.join(one(c) for c in cols)} FROM {src})"


def clean_ctes(raw_cols=RAW_COLS) -> list[str]:
    return fix_ctes("raw", raw_cols) + [impute_cte(cols=raw_cols),
                                        "deduped AS (SELECT DISTINCT * FROM imputed)",
                                        clamp_cte(cols=raw_cols)]


def mode_ctes(col: str) -> list[str]:
    return [
        f"""{col}_c AS (SELECT {K}, {col} AS v, count(*) AS c FROM cleank
  WHERE {col} IS NOT NULL GROUP BY {K}, {col})""",
        f"{col}_m AS (SELECT {K}, first(v ORDER BY c DESC, v ASC) AS {col} FROM {col}_c GROUP BY {K})",
    ]


def panel_ctes(raw_cols=RAW_COLS, extra_avg=("inventory_level", "units_ordered", "discount",
                                               "competitor_pricing"), flags=("holiday", "promotion")):
    avgs = "".join(f", avg({c}) AS {c}" for c in extra_avg if c in raw_cols)
    maxes = "".join(f", max({c}) AS {c}" for c in flags if c in raw_cols)
    return clean_ctes(raw_cols) + [
        f"""cleank AS (SELECT * FROM clean WHERE date IS NOT NULL AND store_id IS NOT NULL
  AND product_id IS NOT NULL AND category IS NOT NULL AND region IS NOT NULL)""",
        *mode_ctes("weather_condition"), *mode_ctes("seasonality"),
        f"""agg AS (SELECT {K}, coalesce(sum(units_sold), 0.0) AS quantity, avg(price) AS price{avgs}{maxes}
  FROM cleank GROUP BY {K})""",
        f"""panel AS (SELECT a.*, w.weather_condition, s.seasonality FROM agg a
  LEFT JOIN weather_condition_m w USING ({K}) LEFT JOIN seasonality_m s USING ({K}))""",
    ]


PANEL = [raw_cte()] + panel_ctes()

SPLIT = [
    f"""pos AS (SELECT *, row_number() OVER (ORDER BY {K}) - 1 AS pos, count(*) OVER () AS n FROM panel)""",
    f"""split AS (SELECT *, pos < floor(n * (CAST(1 AS DOUBLE) - CAST({TEST_SIZE} AS DOUBLE))) AS is_train,
  product_id || '_' || category AS pk FROM pos)""",
    "tr AS (SELECT * FROM split WHERE is_train)",
    "te AS (SELECT * FROM split WHERE NOT is_train)",
]


def baseline_cte(kind: str, target: str = "quantity", name: str = "scored") -> list[str]:
    if kind == "mean":
        return [f"pm AS (SELECT pk, avg({target}) AS v FROM tr GROUP BY pk)",
                f"""{name} AS (SELECT te.*, te.{target} AS label,
  coalesce(pm.v, (SELECT avg({target}) FROM tr)) AS prediction FROM te LEFT JOIN pm USING (pk))"""]
    last = [f"pl AS (SELECT pk, arg_max({target}, pos) AS v FROM tr GROUP BY pk)"]
    glob = f"(SELECT arg_max({target}, pos) FROM tr)"
    if kind == "last":
        return last + [f"""{name} AS (SELECT te.*, te.{target} AS label, coalesce(pl.v, {glob}) AS prediction
  FROM te LEFT JOIN pl USING (pk))"""]
    return last + [
        f"ps AS (SELECT pk, isodow(date) - 1 AS dow, arg_max({target}, pos) AS v FROM tr GROUP BY pk, isodow(date) - 1)",
        f"""{name} AS (SELECT te.*, te.{target} AS label, coalesce(ps.v, pl.v, {glob}) AS prediction
  FROM te LEFT JOIN ps ON te.pk = ps.pk AND isodow(te.date) - 1 = ps.dow LEFT JOIN pl ON te.pk = pl.pk)"""]


def scored_ctes(kind: str = "seasonal", target: str = "quantity") -> list[str]:
    pre = []
    if target == "revenue":
        pre = ["trr AS (SELECT *, price * quantity AS revenue FROM tr)",
               "ter AS (SELECT *, price * quantity AS revenue FROM te)"]
        body = [c.replace("FROM tr", "FROM trr").replace("FROM te", "FROM ter")
                 .replace("te.", "ter.").replace(" te ", " ter ") for c in baseline_cte(kind, target)]
        return PANEL + SPLIT + pre + body
    return PANEL + SPLIT + baseline_cte(kind, target)


def all_scored_ctes() -> list[str]:
    ctes = PANEL + SPLIT
    parts = []
    for i, (kind, name) in enumerate((("last", "baseline_last_value"), ("mean", "baseline_mean"),
                                      ("seasonal", "baseline_seasonal_naive"))):
        body = baseline_cte(kind, "quantity", f"s_{kind}")
        body = [b.replace("pm AS", f"pm_{kind} AS").replace("pl AS", f"pl_{kind} AS")
                 .replace("ps AS", f"ps_{kind} AS").replace("JOIN pm", f"JOIN pm_{kind} pm")
                 .replace("JOIN pl", f"JOIN pl_{kind} pl").replace("JOIN ps", f"JOIN ps_{kind} ps")
                for b in body]
        ctes += body
        parts.append(f"SELECT '{name}' AS model, {i} AS model_order, label, prediction FROM s_{kind}")
    ctes.append("allscored AS (" + " UNION ALL ".join(parts) + ")")
    ctes.append("""cmp AS (SELECT model, avg(abs(label - greatest(prediction, 0.0))) AS mae,
  sqrt(avg((label - greatest(prediction, 0.0)) * (label - greatest(prediction, 0.0)))) AS rmse,
  min(model_order) AS model_order,
  coalesce(sum(greatest(greatest(prediction, 0.0) - label, 0.0)), 0.0) * 0.1 AS holding_cost,
  coalesce(sum(greatest(label - greatest(prediction, 0.0), 0.0)), 0.0) * 10.0 AS stockout_cost
  FROM allscored GROUP BY model)""")
    return ctes


def features_ctes(src: str = "panel", clip: bool = True) -> list[str]:
    w = f"PARTITION BY {KP} ORDER BY date"
    ma = lambda n: (f"CASE WHEN count(quantity) OVER ({w} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) = {n} "  # noqa: E731
                    f"THEN avg(quantity) OVER ({w} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) END")
    raw_f = f"""fraw AS (SELECT *, CAST(isodow(date) - 1 AS INTEGER) AS day_of_week, CAST(month(date) AS INTEGER) AS month,
  CAST(quarter(date) AS INTEGER) AS quarter, CAST(day(date) AS INTEGER) AS day_of_month,
  CAST(isodow(date) >= 6 AS INTEGER) AS is_weekend,
  CAST(coalesce(holiday = 1, false) AS INTEGER) AS is_holiday, CAST(coalesce(promotion = 1, false) AS INTEGER) AS is_promotion,
  price * quantity AS revenue,
  lag(quantity, 1) OVER ({w}) AS lag_1, lag(quantity, 7) OVER ({w}) AS lag_7, lag(quantity, 30) OVER ({w}) AS lag_30,
  {ma(7)} AS ma_7, {ma(30)} AS ma_30 FROM {src})"""
    dbl = ["quantity", "price", "inventory_level", "units_ordered", "discount", "competitor_pricing",
           "revenue", "lag_1", "lag_7", "lag_30", "ma_7", "ma_30"]
    ints = ["holiday", "promotion", "day_of_week", "month", "quarter", "day_of_month", "is_weekend",
            "is_holiday", "is_promotion"]
    cl = (lambda x: f"least(greatest({x}, -1000000.0), 1000000.0)") if clip else (lambda x: x)
    sel = [K, "weather_condition", "seasonality"]
    sel += [f"{cl(f'coalesce({c}, 0.0)')} AS {c}" for c in dbl]
    sel += [f"CAST({cl(f'coalesce({c}, 0)')} AS INTEGER) AS {c}" for c in ints]
    return [raw_f, f"feats AS (SELECT {', '.join(sel)} FROM fraw)"]


def feature_split_ctes() -> list[str]:
    return PANEL + features_ctes() + [
        f"""fpos AS (SELECT *, row_number() OVER (ORDER BY {K}) - 1 AS pos, count(*) OVER () AS n FROM feats)""",
        f"ftr AS (SELECT * FROM fpos WHERE pos < floor(n * (CAST(1 AS DOUBLE) - CAST({TEST_SIZE} AS DOUBLE))))",
    ]


STOCK_FILE = """sfile AS (SELECT p_brand || '_' || p_type AS product_key,
  greatest(coalesce(CAST((sum(p_size) % 20) * 25 - 25 AS DOUBLE), 0.0), 0.0) AS current_stock
  FROM part GROUP BY p_brand, p_type)"""

REC = [STOCK_FILE,
       """dem AS (SELECT pk AS product_key, min(product_id || ' (' || category || ')') AS product_line,
  avg(greatest(prediction, 0.0)) AS predicted_demand FROM scored GROUP BY pk)""",
       """rec0 AS (SELECT d.product_line, d.product_key, coalesce(s.current_stock, 0.0) AS current_stock,
  d.predicted_demand, d.predicted_demand * CAST(1.2 AS DOUBLE) AS safety_stock,
  d.predicted_demand * CAST(14.0 AS DOUBLE) AS target_inventory,
  greatest(0.0, d.predicted_demand * CAST(14.0 AS DOUBLE) - coalesce(s.current_stock, 0.0)) AS recommended_order,
  CASE WHEN d.predicted_demand > 0 THEN coalesce(s.current_stock, 0.0) / d.predicted_demand ELSE 999.0 END AS days_until_stockout
  FROM dem d LEFT JOIN sfile s USING (product_key))""",
       """rec AS (SELECT *, CASE WHEN predicted_demand <= 0 THEN 'POOR' WHEN days_until_stockout <= 3 THEN 'URGENT'
  WHEN days_until_stockout <= 7 THEN 'NORMAL' WHEN days_until_stockout <= 14 THEN 'LOW' ELSE 'POOR' END AS reorder_urgency
  FROM rec0)"""]


def err_aggs(act="label", pred="greatest(prediction, 0.0)") -> tuple[str, str]:
    e = f"({act} - {pred})"
    return f"avg(abs({e}))", f"sqrt(avg({e} * {e}))"


def breakdown(src: str, dims: dict[str, str], aggs: str, overall: bool = True) -> str:
    parts = []
    if overall:
        parts.append(f"SELECT 'Overall' AS dimension, 'All' AS value, {aggs} FROM {src}")
    for name, expr in dims.items():
        parts.append(f"SELECT '{name}' AS dimension, CAST({expr} AS VARCHAR) AS value, {aggs} FROM {src} "
                     f"WHERE {expr} IS NOT NULL GROUP BY {expr}")
    return " UNION ALL ".join(parts)


def q(ctes: list[str], select: str) -> str:
    return with_(*ctes) + select


# ---------------------------------------------------------------------- queries

def build() -> dict[str, str]:
    o: dict[str, str] = {}
    mae, rmse = err_aggs()
    mae_u, rmse_u = err_aggs(pred="prediction")

    o["parse_date"] = q([DIRTY], f"SELECT date_text, {parse_date_sql('date_text')} AS date, count(*) AS n_rows "
                                 f"FROM dirty GROUP BY ALL")
    o["daily_panel"] = q(PANEL, "SELECT * REPLACE (" + ", ".join(
        f"{r(c)} AS {c}" for c in ["quantity", "price", "inventory_level", "units_ordered",
                                   "discount", "competitor_pricing"]) + ") FROM panel")
    o["calendar_features"] = q(PANEL, f"""SELECT {K}, CAST(isodow(date) - 1 AS INTEGER) AS day_of_week,
  CAST(month(date) AS INTEGER) AS month, CAST(quarter(date) AS INTEGER) AS quarter,
  CAST(day(date) AS INTEGER) AS day_of_month, CAST(isodow(date) >= 6 AS INTEGER) AS is_weekend FROM panel""")
    o["numeric_features"] = q(PANEL, f"""SELECT {K}, CAST(coalesce(holiday = 1, false) AS INTEGER) AS is_holiday,
  CAST(coalesce(promotion = 1, false) AS INTEGER) AS is_promotion, {r('inventory_level')} AS inventory_level,
  {r('units_ordered')} AS units_ordered, {r('price')} AS price, {r('discount')} AS discount,
  {r('competitor_pricing')} AS competitor_pricing FROM panel""")
    o["revenue"] = q(PANEL, f"SELECT {K}, {r('quantity')} AS quantity, {r('price')} AS price, "
                            f"{r('price * quantity')} AS revenue FROM panel")
    cats = ["weather_condition", "seasonality", "region", "store_id", "product_id", "category"]
    n_cols = " + ".join(f"(SELECT count(DISTINCT {c}) FROM panel)" for c in cats)
    o["one_hot_wide"] = q(PANEL, " UNION ALL ".join(
        f"SELECT {K}, '{c}_' || {c} AS feature, CAST(1 AS INTEGER) AS value, CAST({n_cols} AS INTEGER) AS n_columns "
        f"FROM panel WHERE {c} IS NOT NULL" for c in cats))
    feat_dbl = ["quantity", "price", "inventory_level", "units_ordered", "discount", "competitor_pricing",
                "revenue", "lag_1", "lag_7", "lag_30", "ma_7", "ma_30"]
    o["clean_clip"] = q(PANEL + features_ctes(), "SELECT * REPLACE (" + ", ".join(
        f"{r(c)} AS {c}" for c in feat_dbl) + ") FROM feats")

    w = f"PARTITION BY {KP} ORDER BY date"
    o["lag_rows"] = q(PANEL, f"""SELECT {K}, {r('quantity')} AS quantity,
  {r(f'lag(quantity, 1) OVER ({w})')} AS lag_1, {r(f'lag(quantity, 7) OVER ({w})')} AS lag_7,
  {r(f'lag(quantity, 30) OVER ({w})')} AS lag_30 FROM panel""")
    lj = lambda n: (f"LEFT JOIN panel b{n} ON a.store_id = b{n}.store_id AND a.product_id = b{n}.product_id "  # noqa: E731
                    f"AND a.category = b{n}.category AND a.region = b{n}.region AND b{n}.date = a.date - {n}")
    o["lag_calendar"] = q(PANEL, f"""SELECT a.date, a.store_id, a.product_id, a.category, a.region,
  {r('a.quantity')} AS quantity, {r('b1.quantity')} AS lag_1, {r('b7.quantity')} AS lag_7,
  {r('b30.quantity')} AS lag_30 FROM panel a {lj(1)} {lj(7)} {lj(30)}""")

    def ma_rows(lo, hi, n):
        fr = f"({w} ROWS BETWEEN {lo} AND {hi})"
        return r(f"CASE WHEN count(quantity) OVER {fr} = {n} THEN avg(quantity) OVER {fr} END")
    o["ma_rows"] = q(PANEL, f"""SELECT {K}, {r('quantity')} AS quantity,
  {ma_rows('6 PRECEDING', 'CURRENT ROW', 7)} AS ma_7, {ma_rows('29 PRECEDING', 'CURRENT ROW', 30)} AS ma_30 FROM panel""")
    o["ma_strict"] = q(PANEL, f"""SELECT {K}, {r('quantity')} AS quantity,
  {ma_rows('7 PRECEDING', '1 PRECEDING', 7)} AS ma_7, {ma_rows('30 PRECEDING', '1 PRECEDING', 30)} AS ma_30 FROM panel""")

    def ma_cal(n):
        return r(f"""CASE WHEN date - min(date) OVER (PARTITION BY {KP}) >= {n - 1} THEN
   coalesce((SELECT sum(b.quantity) FROM panel b WHERE b.store_id = a.store_id AND b.product_id = a.product_id
    AND b.category = a.category AND b.region = a.region AND b.date BETWEEN a.date - {n - 1} AND a.date), 0.0) / {n}.0 END""")
    o["ma_calendar"] = q(PANEL, f"SELECT {K}, {r('quantity')} AS quantity, {ma_cal(7)} AS ma_7, "
                                f"{ma_cal(30)} AS ma_30 FROM panel a")

    o["chrono_split"] = q(PANEL + SPLIT[:2], f"SELECT {K}, is_train FROM split")
    o["cv_fold_ranges"] = q(PANEL + SPLIT[:1], """c AS (SELECT count(*) AS n FROM panel),
rng AS (SELECT CAST(i AS INTEGER) AS fold, CAST(0 AS BIGINT) AS train_start, n - (5 - i) * (n // 6) AS train_end,
  n - (5 - i) * (n // 6) AS val_start, n - (5 - i) * (n // 6) + n // 6 AS val_end FROM c, range(5) t(i))
SELECT rng.*, p1.date AS val_first_date, p2.date AS val_last_date FROM rng
  JOIN pos p1 ON p1.pos = rng.val_start JOIN pos p2 ON p2.pos = rng.val_end - 1""".replace("c AS", ", c AS", 0))
    o["cv_fold_ranges"] = o["cv_fold_ranges"].replace("\nc AS (", ",\nc AS (", 1)
    o["walk_forward_ranges"] = q(PANEL + SPLIT[:1] + [
        f"c AS (SELECT CAST(floor(count(*) * (CAST(1 AS DOUBLE) - CAST({TEST_SIZE} AS DOUBLE))) AS BIGINT) AS m FROM panel)",
        """rng AS (SELECT CAST(i AS INTEGER) AS fold, CAST(0 AS BIGINT) AS train_start, (m // 6) * (i + 1) AS train_end,
  (m // 6) * (i + 1) AS val_start, least((m // 6) * (i + 2), m) AS val_end FROM c, range(5) t(i)
  WHERE (m // 6) * (i + 1) < m)"""],
        """SELECT rng.*, p1.date AS val_first_date, p2.date AS val_last_date FROM rng
  JOIN pos p1 ON p1.pos = rng.val_start JOIN pos p2 ON p2.pos = rng.val_end - 1""")

    stat = {"mean": "avg(quantity)", "median": "quantile_cont(quantity, 0.5)",
            "p75": "quantile_cont(quantity, 0.75)", "p90": "quantile_cont(quantity, 0.9)"}
    for m, s in stat.items():
        o[f"stock_{m}"] = q(PANEL, f"""SELECT product_id || '_' || category AS product_key,
  {r(f'greatest(1.0, round_even({s} * 10.0, 0))')} AS current_stock FROM panel GROUP BY 1""")
    o["latest_stock"] = q([raw_cte()] + fix_ctes("raw", RAW_COLS), f"""SELECT product_id || '_' || category AS product_key,
  {r("greatest(coalesce(first(inventory_level ORDER BY date DESC, store_id DESC, region DESC, inventory_level DESC), 0.0), 0.0)")} AS current_stock
  FROM fixed WHERE product_id IS NOT NULL AND category IS NOT NULL GROUP BY 1""")
    raw_noinv = [c for c in RAW_COLS if c != "inventory_level"]
    o["resolve_stock"] = q([raw_cte(drop_inventory=True)] + panel_ctes(raw_noinv) + [STOCK_FILE],
                           f"""SELECT d.product_key, {r('coalesce(s.current_stock, 0.0)')} AS current_stock,
  'stock file' AS stock_source FROM (SELECT DISTINCT product_id || '_' || category AS product_key FROM panel) d
  LEFT JOIN sfile s USING (product_key)""")
    dirty_panel = panel_ctes(TYPED_COLS, flags=())
    o["resolve_stock_column"] = q([DIRTY, TYPED] + fix_ctes("typed", TYPED_COLS) + dirty_panel[len(fix_ctes("raw", TYPED_COLS)):] + [
        """ls AS (SELECT product_id || '_' || category AS product_key,
  first(inventory_level ORDER BY date DESC NULLS LAST, store_id DESC, region DESC, inventory_level DESC) AS v
  FROM fixed WHERE product_id IS NOT NULL AND category IS NOT NULL GROUP BY 1)"""],
        f"""SELECT d.product_key, {r('greatest(coalesce(ls.v, 0.0), 0.0)')} AS current_stock,
  'dataset column: inventory_level' AS stock_source
  FROM (SELECT DISTINCT product_id || '_' || category AS product_key FROM panel) d LEFT JOIN ls USING (product_key)""")
    o["stock_duplicates"] = f"""SELECT p_brand || '_' || p_type AS product_key,
  {r("arg_max(CASE WHEN p_partkey % 7 = 0 THEN 0.0 ELSE greatest(p_size - 10, 0) END, p_partkey)")} AS current_stock
  FROM part GROUP BY 1"""
    by_day = ("op AS (SELECT CAST(o_orderdate AS DATE) AS date, o_orderpriority AS region, "
              "row_number() OVER (ORDER BY CAST(o_orderdate AS DATE), o_orderpriority) - 1 AS pos, count(*) OVER () AS n FROM orders)")
    o["split_ties"] = q([by_day], f"""SELECT date, region,
  pos < floor(n * (CAST(1 AS DOUBLE) - CAST({TEST_SIZE} AS DOUBLE))) AS is_train, count(*) AS n_rows FROM op GROUP BY ALL""")
    o["fold_ties"] = q([by_day], """SELECT date, region, CAST(list_sum(list_transform(range(6),
    lambda i: CAST(pos >= n - (5 - i) * (n // 6) AS INTEGER))) AS INTEGER) AS fold, count(*) AS n_rows FROM op GROUP BY ALL""")
    o["with_stock"] = q(PANEL + [STOCK_FILE], f"""SELECT {K}, {r('coalesce(s.current_stock, 0.0)')} AS current_stock
  FROM panel p LEFT JOIN sfile s ON p.product_id || '_' || p.category = s.product_key""")
    o["scaler_stats"] = q(feature_split_ctes(), " UNION ALL ".join(
        f"SELECT '{f}' AS feature, {r(f'avg({f})')} AS mean, {r(f'stddev_pop({f})')} AS std FROM ftr" for f in FEATS))
    pairs = [(i, j) for i in range(len(FEATS)) for j in range(i + 1, len(FEATS))]
    corr_rows = []
    for i, j in pairs:
        a, b = FEATS[i], FEATS[j]
        cexpr = (f"CASE WHEN stddev_pop({a}) > 0 AND stddev_pop({b}) > 0 THEN "
                 f"abs(covar_pop({a}, {b}) / (stddev_pop({a}) * stddev_pop({b}))) END")
        corr_rows.append(f"SELECT {i} AS i, {j} AS j, '{a}' AS feature_a, '{b}' AS feature_b, {cexpr} AS c FROM ftr")
    o["correlated_pairs"] = q(feature_split_ctes() + ["cc AS (" + " UNION ALL ".join(corr_rows) + ")"],
                              f"SELECT i, j, feature_a, feature_b, {r('c')} AS abs_corr FROM cc WHERE c > 0.7")
    o["data_profile"] = q(feature_split_ctes(), f"""SELECT count(*) AS n_samples, CAST({len(FEATS)} AS INTEGER) AS n_features,
  {r(f'count(*) / {float(len(FEATS))}')} AS samples_per_feature FROM ftr""")

    o["interpretation"] = q(feature_split_ctes() + ["cc AS (" + " UNION ALL ".join(corr_rows) + ")"],
                            f"""SELECT count(*) AS n_samples, CAST({len(FEATS)} AS INTEGER) AS n_features,
  {r(f'count(*) / {float(len(FEATS))}')} AS samples_per_feature, CAST(102400 AS INTEGER) AS forest_parameter_estimate,
  (SELECT count(*) FROM cc WHERE c > 0.7) AS n_correlated_pairs FROM ftr""")
    fpos = feature_split_ctes()[:-1] + ["fl AS (SELECT pos, n, product_id || '_' || category AS pk, "
                                        "least(greatest(coalesce(quantity, 0.0), 0.0), 1000000.0) AS y FROM fpos)"]

    def folds(bounds) -> list[str]:
        """Errors of the mean per product, per fold: train before the first bound, validate up to the second."""
        parts = []
        for i in range(5):
            lo, hi = bounds(i)
            parts.append(f"""SELECT CAST({i} AS INTEGER) AS fold, avg(abs(e)) AS mae, sqrt(avg(e * e)) AS rmse FROM (
  SELECT v.y - coalesce(t.m, (SELECT avg(y) FROM fl WHERE pos < {lo})) AS e
  FROM (SELECT * FROM fl WHERE pos >= {lo} AND pos < {hi}) v
  LEFT JOIN (SELECT pk, avg(y) AS m FROM fl WHERE pos < {lo} GROUP BY pk) t USING (pk))""")
        return ["folds AS (" + " UNION ALL ".join(parts) + ")"]
    cv = folds(lambda i: (f"n - {5 - i} * (n // 6)", f"n - {5 - i} * (n // 6) + n // 6"))
    last = f"CAST(floor(n * (CAST(1 AS DOUBLE) - CAST({TEST_SIZE} AS DOUBLE))) AS BIGINT)"
    wf = folds(lambda i: (f"({last} // 6) * {i + 1}", f"least(({last} // 6) * {i + 2}, {last})"))
    per_fold = f"SELECT 'baseline_mean' AS model, fold, {r('mae')} AS mae, {r('rmse')} AS rmse FROM folds"
    o["cv_baseline"] = q(fpos + cv, per_fold)
    o["walk_forward_baseline"] = q(fpos + wf, per_fold)
    o["cv_summary_baseline"] = q(fpos + cv, f"""SELECT 'baseline_mean' AS model, {r('avg(mae)')} AS mae_mean,
  {r('stddev_pop(mae)')} AS mae_std, {r('avg(rmse)')} AS rmse_mean, {r('stddev_pop(rmse)')} AS rmse_std FROM folds""")

    for kind, key in (("last", "baseline_last"), ("mean", "baseline_mean"), ("seasonal", "baseline_seasonal")):
        o[key] = q(scored_ctes(kind), f"SELECT {K}, {r('label')} AS label, {r('prediction')} AS prediction FROM scored")
    o["accuracy"] = q(scored_ctes(), f"SELECT {r(mae)} AS mae, {r(rmse)} AS rmse FROM scored")
    p = "greatest(prediction, 0.0)"
    over = f"coalesce(sum(greatest({p} - label, 0.0)), 0.0)"
    under = f"coalesce(sum(greatest(label - {p}, 0.0)), 0.0)"
    o["economic_cost"] = q(scored_ctes(), f"""SELECT {r(f'{over} * 0.1 + {under} * 10.0', 2)} AS total_cost,
  {r(f'{over} * 0.1', 2)} AS holding_cost, {r(f'{under} * 10.0', 2)} AS stockout_cost,
  {r(over, 2)} AS over_prediction_units, {r(under, 2)} AS under_prediction_units FROM scored""")
    o["compare_models"] = q(all_scored_ctes(), f"""SELECT model, {r('mae')} AS mae, {r('rmse')} AS rmse, model_order,
  {r('holding_cost + stockout_cost', 2)} AS total_cost, {r('holding_cost', 2)} AS holding_cost,
  {r('stockout_cost', 2)} AS stockout_cost FROM cmp""")
    # the run keeps products of 30 rows of history or more
    keep = "HAVING count(*) >= 30"
    o["run_reports"] = o["compare_models"].replace("pos AS (SELECT *,", f"""kept AS (SELECT * FROM panel SEMI JOIN (
  SELECT product_id, category FROM panel GROUP BY product_id, category {keep}) k USING (product_id, category)),
pos AS (SELECT *,""").replace("AS n FROM panel)", "AS n FROM kept)")
    o["best_model"] = q(all_scored_ctes(), f"""SELECT first(model ORDER BY rmse, model_order, model) AS model,
  {r('min(rmse)')} AS rmse FROM cmp""")
    pp = f"""pp AS (SELECT pk AS product_key, min(product_id || ' (' || category || ')') AS product_line,
  {mae_u} AS mae, {rmse_u} AS rmse, count(*) AS n_samples FROM scored GROUP BY pk)"""
    o["per_product"] = q(scored_ctes() + [pp], f"SELECT product_key, product_line, {r('mae')} AS mae, "
                                               f"{r('rmse')} AS rmse, n_samples FROM pp")
    o["performance_tier"] = q(scored_ctes() + [pp, "th AS (SELECT quantile_cont(rmse, 0.33) AS q33, quantile_cont(rmse, 0.67) AS q67 FROM pp)"],
                              f"""SELECT product_key, product_line, {r('mae')} AS mae, {r('rmse')} AS rmse, n_samples,
  CASE WHEN rmse < q33 THEN 'green' WHEN rmse < q67 THEN 'orange' ELSE 'red' END AS tier FROM pp, th""")
    di_aggs = f"{r(mae)} AS mae, {r(rmse)} AS rmse, {r('avg(label)')} AS mean_actual, {r('avg(greatest(prediction, 0.0))')} AS mean_predicted"
    o["dimension_impact"] = q(scored_ctes(), breakdown("scored", DIMENSIONS, di_aggs))
    te_src = ["err AS (SELECT *, label - greatest(prediction, 0.0) AS e, abs(label - greatest(prediction, 0.0)) AS ae, "
              "abs(label - greatest(prediction, 0.0)) / (label + 1e-10) * 100.0 AS pe FROM scored)"]
    te_aggs = (f"{r('avg(ae)')} AS mae, {r('sqrt(avg(e * e))')} AS rmse, {r('avg(e)')} AS mean_error, "
               f"{r('stddev_samp(e)')} AS std_error, {r('avg(pe)', 2)} AS mean_pct_error, count(*) AS n_samples")
    tdims = {"Day_of_Week": "dayname(date)",
             "Weekend_Status": "CASE WHEN isodow(date) >= 6 THEN 'Weekend' ELSE 'Weekday' END",
             "Month": "monthname(date)", "Quarter": "'Q' || CAST(quarter(date) AS VARCHAR)"}
    o["temporal_errors"] = q(scored_ctes() + te_src, breakdown("err", tdims, te_aggs))
    o["revenue_metrics"] = q(scored_ctes("seasonal", "revenue"), f"""SELECT {r(mae, 2)} AS mae, {r(rmse, 2)} AS rmse,
  {r('sum(label)', 2)} AS total_revenue_true, {r(f'sum({p})', 2)} AS total_revenue_pred,
  {r(f'CASE WHEN sum(label) > 0 THEN abs(sum({p}) - sum(label)) / sum(label) * 100.0 ELSE 0.0 END', 2)} AS revenue_error_pct
  FROM scored""")
    o["revenue_report"] = q(scored_ctes("seasonal", "revenue"),
                            breakdown("scored", DIMENSIONS, f"{r(f'sum({p})', 2)} AS predicted_revenue, count(*) AS count"))

    o["recommend_orders"] = q(scored_ctes() + REC, f"""SELECT product_line, product_key, {r('current_stock')} AS current_stock,
  {r('predicted_demand')} AS predicted_demand, {r('safety_stock')} AS safety_stock, {r('target_inventory')} AS target_inventory,
  {r('recommended_order')} AS recommended_order, reorder_urgency, {r('days_until_stockout')} AS days_until_stockout FROM rec""")
    o["urgency_summary"] = q(scored_ctes() + REC, " UNION ALL ".join(
        f"SELECT '{lvl}' AS reorder_urgency, count(*) FILTER (WHERE reorder_urgency = '{lvl}') AS n_products, "
        f"{r(f'coalesce(sum(recommended_order) FILTER (WHERE reorder_urgency = {chr(39)}{lvl}{chr(39)}), 0.0)')} AS order_quantity FROM rec"
        for lvl in ("URGENT", "NORMAL", "LOW", "POOR")))
    o["final_report"] = q(scored_ctes() + REC, f"""SELECT product_line AS "Product Line", reorder_urgency AS "Reorder Urgency",
  {r(r('days_until_stockout', 2))} AS "Days Until Stockout", {r(r('current_stock', 2))} AS "Current Stock",
  {r(r('predicted_demand', 2))} AS "Predicted Daily Demand", {r(r('safety_stock', 2))} AS "Safety Stock Target",
  {r(r('target_inventory', 2))} AS "Target Inventory", {r(r('recommended_order', 2))} AS "Recommended Order Quantity" FROM rec""")
    o["order_chart"] = q(scored_ctes() + REC, f"SELECT product_line, {r('recommended_order')} AS recommended_order FROM rec")
    o["executive_summary"] = q(all_scored_ctes() + baseline_cte("seasonal") + REC, f"""SELECT
  (SELECT count(*) FROM rec) AS n_products,
  (SELECT count(*) FILTER (WHERE reorder_urgency = 'URGENT') FROM rec) AS urgent_products,
  (SELECT {r('coalesce(sum(recommended_order), 0.0)')} FROM rec) AS total_order_quantity,
  b.model AS best_model, {r('b.rmse')} AS best_rmse, {r('cmp.holding_cost + cmp.stockout_cost', 2)} AS total_cost
  FROM (SELECT first(model ORDER BY rmse, model_order, model) AS model, min(rmse) AS rmse FROM cmp) b
  JOIN cmp ON cmp.model = b.model""")
    o["format_report"] = q(scored_ctes() + REC + [f"""rr AS (SELECT product_line, reorder_urgency, {r('current_stock', 2)} AS cs,
  {r('recommended_order', 2)} AS ro, {r('days_until_stockout', 2)} AS du, {r('predicted_demand', 2)} AS pd FROM rec)"""],
                           """SELECT product_line, reorder_urgency, format('{:,.0f}', cs) || ' units' AS current_stock_text,
  format('{:,.0f}', ro) || ' units' AS order_text,
  CASE WHEN du >= 999.0 THEN 'Sufficient' ELSE format('{:,.1f}', du) || ' days' END AS days_text,
  '$' || format('{:,.2f}', pd) AS demand_money_text FROM rr""")

    diag = [pp, te_src[0],
            f"""td AS (SELECT dayname(date) AS label, {rmse} AS rmse, {mae} AS mae FROM scored GROUP BY 1)""",
            f"""tw AS (SELECT CASE WHEN isodow(date) >= 6 THEN 'Weekend' ELSE 'Weekday' END AS label, {rmse} AS rmse,
  {mae} AS mae FROM scored GROUP BY 1)"""]
    for name, col in DIMENSIONS.items():
        diag.append(f"""d_{col} AS (SELECT CAST({col} AS VARCHAR) AS label, {rmse} AS rmse, {mae} AS mae FROM scored
  WHERE {col} IS NOT NULL GROUP BY 1)""")
    sel = [f"SELECT 'overall' AS section, 'All' AS label, {rmse} AS rmse, {mae} AS mae FROM scored",
           "SELECT * FROM (SELECT 'product_best' AS section, product_line AS label, rmse, mae FROM pp ORDER BY rmse ASC, product_line ASC LIMIT 5)",
           "SELECT * FROM (SELECT 'product_worst' AS section, product_line AS label, rmse, mae FROM pp ORDER BY rmse DESC, product_line ASC LIMIT 5)",
           "SELECT * FROM (SELECT 'day_best' AS section, label, rmse, mae FROM td ORDER BY rmse ASC, label ASC LIMIT 1)",
           "SELECT * FROM (SELECT 'day_worst' AS section, label, rmse, mae FROM td ORDER BY rmse DESC, label ASC LIMIT 1)",
           "SELECT 'weekend' AS section, label, rmse, mae FROM tw"]
    for name, col in DIMENSIONS.items():
        sel.append(f"SELECT * FROM (SELECT '{name}_best' AS section, label, rmse, mae FROM d_{col} ORDER BY rmse ASC, label ASC LIMIT 1)")
        sel.append(f"SELECT * FROM (SELECT '{name}_worst' AS section, label, rmse, mae FROM d_{col} ORDER BY rmse DESC, label ASC LIMIT 1)")
    o["diagnostics"] = q(scored_ctes() + diag + ["dg AS (" + " UNION ALL ".join(sel) + ")"],
                         f"SELECT section, label, {r('rmse')} AS rmse, {r('mae')} AS mae FROM dg")

    o["sales_trend"] = q(PANEL + SPLIT, f"""SELECT date, product_id || ' (' || category || ')' AS product_line,
  {r('sum(quantity)')} AS quantity FROM tr GROUP BY 1, 2""")
    o["prediction_series"] = q(scored_ctes(), f"SELECT date, {r('sum(label)')} AS actual, {r(f'sum({p})')} AS predicted "
                                              f"FROM scored GROUP BY date")
    grid = [(i / 100, NormalDist().inv_cdf(i / 100)) for i in range(1, 100)]
    plist = "[" + ", ".join(f"'{x!r}'::DOUBLE" for x, _ in grid) + "]"
    zlist = "[" + ", ".join(f"'{z!r}'::DOUBLE" for _, z in grid) + "]"
    o["residual_qq"] = q(scored_ctes() + [f"qq AS (SELECT quantile_cont(label - {p}, {plist}) AS qs FROM scored)"],
                         f"""SELECT {r(f'{plist}[i]')} AS p, {r('qs[i]')} AS sample_quantile, {r(f'{zlist}[i]')} AS theoretical_quantile
  FROM qq, range(1, 100) t(i)""")
    o["revenue_series"] = q(scored_ctes("seasonal", "revenue"), breakdown(
        "scored", {"Date": "date", "Weather Condition": "weather_condition", "Region": "region"},
        f"{r('sum(label)', 2)} AS actual_revenue, {r(f'sum({p})', 2)} AS predicted_revenue", overall=False))

    # cleaning on the dirty binding
    o["leakage_audit"] = q(PANEL + [f"""lx AS (SELECT inventory_level AS x, lead(quantity) OVER (PARTITION BY {KP} ORDER BY date) AS y,
  units_ordered, quantity FROM panel)""",
                                   """la AS (SELECT min(x) AS inv_min, min(units_ordered) AS uo_min,
  CASE WHEN stddev_pop(x) FILTER (WHERE y IS NOT NULL) > 0 AND stddev_pop(y) FILTER (WHERE x IS NOT NULL) > 0
   THEN covar_pop(x, y) / (stddev_pop(x) FILTER (WHERE y IS NOT NULL) * stddev_pop(y) FILTER (WHERE x IS NOT NULL)) END AS corr,
  min(CAST(coalesce(units_ordered >= quantity, false) AS INTEGER)) AS every FROM lx)"""],
                           f"""SELECT 'inventory_negative_values' AS risk, CAST(coalesce(inv_min < 0, false) AS INTEGER) AS triggered, {r('inv_min')} AS measure FROM la
UNION ALL SELECT 'inventory_temporal_correlation', CAST(coalesce(corr > 0.7, false) AS INTEGER), {r('corr')} FROM la
UNION ALL SELECT 'units_ordered_negative_values', CAST(coalesce(uo_min < 0, false) AS INTEGER), {r('uo_min')} FROM la
UNION ALL SELECT 'units_ordered_future_pattern', CAST(coalesce(every = 1, false) AS INTEGER), {r('CAST(every AS DOUBLE)')} FROM la""")
    advice = " ".join(f"WHEN '{k}' THEN '{v.replace(chr(39), chr(39) * 2)}'" for k, v in ADVICE.items())
    o["leakage_audit"] = (f"SELECT risk, triggered, measure, CASE WHEN triggered = 1 THEN CASE risk {advice} END END "
                          f"AS recommendation FROM ({o['leakage_audit']})")
    o["inconsistent_products"] = q([DIRTY, TYPED], """SELECT product_id, count(DISTINCT category) AS n_categories
  FROM typed WHERE product_id IS NOT NULL GROUP BY product_id HAVING count(DISTINCT category) > 1""")
    fx = [DIRTY, TYPED] + fix_ctes("typed", TYPED_COLS)
    o["fix_category"] = q(fx, "SELECT product_id, category, count(*) AS n_rows FROM fixed GROUP BY ALL")
    o["missing_counts"] = q([DIRTY], " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS n_missing FROM dirty"
        for c in ("product_id", "category", "units_sold", "date_text")))
    per = (f"SELECT product_id, category, count(*) AS n_rows, {r('sum(units_sold)')} AS sum_units, "
           f"{r('min(units_sold)')} AS min_units, {r('min(price)')} AS min_price FROM {{src}} GROUP BY ALL")
    imp = impute_cte(cols=TYPED_COLS)
    o["impute"] = q(fx + [imp], per.format(src="imputed"))
    o["dedup"] = q(fx + [imp, "deduped AS (SELECT DISTINCT * FROM imputed)"], per.format(src="deduped"))
    o["clamp_negative"] = q(fx + [imp, "deduped AS (SELECT DISTINCT * FROM imputed)", clamp_cte(cols=TYPED_COLS)],
                            per.format(src="clean"))
    o["coerce_types"] = q([DIRTY], f"""SELECT count(*) AS n_rows,
  count(*) FILTER (WHERE units_sold IS NOT NULL AND TRY_CAST(units_sold AS DOUBLE) IS NULL) AS units_bad_text,
  count(*) FILTER (WHERE price IS NOT NULL AND TRY_CAST(price AS DOUBLE) IS NULL) AS price_bad_text,
  {r(f"sum({num('units_sold')})")} AS sum_units, count({num('units_sold')}) AS n_units,
  {r(f"sum({num('price')})", 2)} AS sum_price FROM dirty""")
    o["quality_report"] = q([DIRTY, TYPED] + fix_ctes("typed", TYPED_COLS) + [
        imp, f"grp AS (SELECT {', '.join(TYPED_COLS)}, count(*) AS c FROM imputed GROUP BY ALL)"], f"""
SELECT 'input_rows' AS metric, count(*) AS value FROM dirty
UNION ALL SELECT 'missing_product_id', count(*) FILTER (WHERE product_id IS NULL) FROM dirty
UNION ALL SELECT 'missing_category', count(*) FILTER (WHERE category IS NULL) FROM dirty
UNION ALL SELECT 'missing_units_sold', count(*) FILTER (WHERE units_sold IS NULL) FROM dirty
UNION ALL SELECT 'missing_date', count(*) FILTER (WHERE date_text IS NULL) FROM dirty
UNION ALL SELECT 'bad_dates', count(*) FILTER (WHERE date_text IS NOT NULL AND {parse_date_sql('date_text')} IS NULL) FROM dirty
UNION ALL SELECT 'units_sold_converted', count(*) FILTER (WHERE units_sold IS NOT NULL AND TRY_CAST(units_sold AS DOUBLE) IS NULL) FROM dirty
UNION ALL SELECT 'price_converted', count(*) FILTER (WHERE price IS NOT NULL AND TRY_CAST(price AS DOUBLE) IS NULL) FROM dirty
UNION ALL SELECT 'inconsistent_products', count(*) FROM (SELECT product_id FROM typed WHERE product_id IS NOT NULL
  GROUP BY product_id HAVING count(DISTINCT category) > 1)
UNION ALL SELECT 'duplicates_removed', CAST(coalesce(sum(c - 1), 0) AS BIGINT) FROM grp
UNION ALL SELECT 'clean_rows', count(*) FROM grp
UNION ALL SELECT 'negative_units_fixed', count(*) FILTER (WHERE units_sold < 0) FROM grp
UNION ALL SELECT 'negative_price_fixed', count(*) FILTER (WHERE price < 0) FROM grp""")
    o["filter_history"] = q([raw_cte("CAST(l.l_partkey AS VARCHAR)")] + panel_ctes() + [
        "keep AS (SELECT product_id, category FROM panel GROUP BY ALL HAVING count(*) >= 30)"],
        f"SELECT {K}, {r('quantity')} AS quantity FROM panel SEMI JOIN keep USING (product_id, category)")
    ev = f"""evraw AS (SELECT CAST(ts AS DATE) AS date, 'web' AS store_id, event_type AS product_id,
  'events' AS category, 'global' AS region FROM events),
evp AS (SELECT {K}, CAST(count(*) AS DOUBLE) AS quantity FROM evraw WHERE date IS NOT NULL AND product_id IS NOT NULL GROUP BY ALL)"""
    o["events_lags"] = q([ev], f"""SELECT {K}, {r('quantity')} AS quantity, {r(f'lag(quantity, 1) OVER ({w})')} AS lag_1,
  {r(f'lag(quantity, 7) OVER ({w})')} AS lag_7,
  {r(f'CASE WHEN count(quantity) OVER ({w} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) = 7 THEN avg(quantity) OVER ({w} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) END')} AS ma_7
  FROM evp""")
    o["stock_per_product"] = q(PANEL + [STOCK_FILE], f"""SELECT p.product_id || '_' || p.category AS product_key,
  {r('min(coalesce(s.current_stock, 0.0))')} AS current_stock FROM panel p
  LEFT JOIN sfile s ON p.product_id || '_' || p.category = s.product_key GROUP BY 1""")
    o["prediction_range"] = q(scored_ctes(), f"""SELECT {r(f'least(min(label), min({p}))')} AS min_value,
  {r(f'greatest(max(label), max({p}))')} AS max_value FROM scored""")
    o["residual_bins"] = q(scored_ctes(), f"""SELECT CAST(floor({p} / 50.0) AS BIGINT) AS bin, {r(f'avg({p})')} AS mean_predicted,
  {r(f'avg(label - {p})')} AS mean_residual, count(*) AS n FROM scored GROUP BY 1""")
    o["top_correlated"] = q(feature_split_ctes() + ["cc AS (" + " UNION ALL ".join(corr_rows) + ")"],
                            f"SELECT i, j, feature_a, feature_b, {r('c')} AS abs_corr FROM cc WHERE c > 0.7 "
                            f"ORDER BY i, j LIMIT 5")
    o["error_columns"] = q(scored_ctes(), f"""SELECT {K}, {r(f'label - {p}')} AS error, {r(f'abs(label - {p})')} AS abs_error,
  {r(f'abs(label - {p}) / (label + 1e-10) * 100.0')} AS pct_error FROM scored""")
    o["filter_history_days"] = q([raw_cte("CAST(l.l_partkey AS VARCHAR)")] + panel_ctes() + [
        "keep AS (SELECT product_id, category FROM panel GROUP BY ALL HAVING count(DISTINCT date) >= 30)"],
        f"SELECT {K}, {r('quantity')} AS quantity FROM panel SEMI JOIN keep USING (product_id, category)")
    o["chrono_split_date"] = q(PANEL + SPLIT[:2] + [
        "bd AS (SELECT min(date) AS d FROM split WHERE NOT is_train)"],
        f"SELECT {K}, date < (SELECT d FROM bd) AS is_train FROM split")
    o["stock_mean_train"] = q(PANEL + SPLIT, f"""SELECT pk AS product_key,
  {r('greatest(1.0, round_even(avg(quantity) * 10.0, 0))')} AS current_stock FROM tr GROUP BY pk""")
    o["events_panel"] = q([], f"""SELECT CAST(ts AS DATE) AS date, 'web' AS store_id, event_type AS product_id,
  'events' AS category, 'global' AS region, CAST(count(*) AS DOUBLE) AS quantity, {r('avg(value)')} AS price,
  CASE quarter(CAST(ts AS DATE)) WHEN 1 THEN 'Winter' WHEN 2 THEN 'Spring' WHEN 3 THEN 'Summer' ELSE 'Autumn' END
  AS seasonality FROM events WHERE ts IS NOT NULL AND event_type IS NOT NULL GROUP BY ALL""")
    o["row_positions"] = q([], """SELECT date, region, min(pos) AS first_position, max(pos) AS last_position,
  count(*) AS n_rows, count(DISTINCT pos) AS n_positions FROM (
  SELECT date, region, row_number() OVER (ORDER BY date NULLS FIRST, region NULLS FIRST) - 1 AS pos FROM (
    SELECT CASE WHEN o_orderkey % 11 <> 0 THEN CAST(o_orderdate AS DATE) END AS date, o_orderpriority AS region FROM orders))
  GROUP BY date, region""")
    return o


ORACLE_SQL = build()
