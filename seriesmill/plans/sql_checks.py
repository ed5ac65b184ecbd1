"""The queries written a second time, as plain SQL over the same tables."""

from __future__ import annotations

from seriesmill import fixed
from seriesmill.plans.standins import FERT_IDS

FERTS = [f"{fixed.FERT_PREFIX}{f}" for f in FERT_IDS]
MEASURES = [*fixed.CONTEXT_MEASURES, *FERTS]
NUMBERS = ["price_rice", *MEASURES]
CATS = list(fixed.PANEL_CATEGORIES)


def rnd(expr: str, places: int = 4) -> str:
    scale = f"1e{places}"
    return f"floor(({expr}) * {scale} + CAST(0.501 AS DOUBLE)) / {scale}"


def _rounded(columns, places: int) -> str:
    return ", ".join(f"{rnd(c, places)} AS {c}" for c in columns)


FACT = """
lines AS (
  SELECT l.*, o.*, c.*, n.* FROM lineitem l JOIN orders o ON l_orderkey = o_orderkey
  JOIN customer c ON o_custkey = c_custkey JOIN nation n ON c_nationkey = n_nationkey),
fact AS (
  SELECT CAST(o_orderdate AS DATE) AS date_id,
    CASE WHEN o_orderkey % 101 <> 0 THEN CAST(n_regionkey AS BIGINT) END AS region_id,
    CASE WHEN o_orderkey % 7 <> 0 THEN CAST(ascii(c_mktsegment) AS BIGINT) END AS eco_id,
    CASE WHEN o_orderkey % 5 <> 0 THEN CAST(ascii(o_orderstatus) AS BIGINT) END AS weather_id,
    'R0' || substr(o_orderpriority, 1, 1) AS rice_id,
    CASE WHEN o_orderkey % 11 <> 0 THEN o_totalprice END AS price_rice,
    CAST(NULL AS VARCHAR) AS fert_id, CAST(NULL AS DOUBLE) AS price_fert,
    CAST(NULL AS DOUBLE) AS avg_temperature, CAST(NULL AS DOUBLE) AS max_temp,
    CAST(NULL AS DOUBLE) AS min_temp, CAST(NULL AS DOUBLE) AS rainfall_mm,
    CAST(NULL AS DOUBLE) AS avg_wind_speed, CAST(NULL AS DOUBLE) AS production_ton,
    CAST(NULL AS DOUBLE) AS area_harvest_ha, CAST(NULL AS DOUBLE) AS yield_kg_per_ha,
    CAST(NULL AS DOUBLE) AS cpi_change_value, o_orderkey AS row_key
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  UNION ALL
  SELECT CAST(o_orderdate AS DATE), CASE WHEN o_orderkey % 101 <> 0 THEN CAST(n_regionkey AS BIGINT) END,
    NULL, NULL, NULL, NULL, l_returnflag, l_extendedprice / l_quantity,
    l_quantity, l_quantity + l_linenumber, l_quantity - l_linenumber,
    CASE WHEN l_linenumber > 1 THEN l_discount * 100 END, l_tax * 100, l_extendedprice / 100,
    l_quantity * 10, l_extendedprice / (l_quantity * 10), l_discount - l_tax, o_orderkey
  FROM lines)"""

CTX = """
ctx AS (
  SELECT date_id, region_id,
    arg_max(eco_id, row_key) FILTER (WHERE eco_id IS NOT NULL) AS eco_id,
    arg_max(weather_id, row_key) FILTER (WHERE weather_id IS NOT NULL) AS weather_id, """ + ", ".join(
    f"avg({c}) AS {c}" for c in fixed.CONTEXT_MEASURES
) + """
  FROM fact WHERE date_id IS NOT NULL AND region_id IS NOT NULL GROUP BY ALL)"""

TARGET = """
tgt AS (
  SELECT date_id, region_id, rice_id, avg(price_rice) AS price_rice FROM fact
  WHERE price_rice IS NOT NULL AND rice_id IN ('R01', 'R02', 'R03')
    AND date_id IS NOT NULL AND region_id IS NOT NULL GROUP BY ALL)"""

FERT = """
fw AS (
  SELECT date_id, region_id, """ + ", ".join(
    f"avg(price_fert) FILTER (WHERE fert_id = '{f}') AS {fixed.FERT_PREFIX}{f}" for f in FERT_IDS
) + """
  FROM fact WHERE fert_id IS NOT NULL AND price_fert IS NOT NULL
    AND date_id IS NOT NULL AND region_id IS NOT NULL GROUP BY date_id, region_id)"""

DIMS = """
dim_date AS (
  SELECT DISTINCT CAST(o_orderdate AS DATE) AS date_id, CAST(year(o_orderdate) AS INTEGER) AS year,
    CAST(quarter(o_orderdate) AS INTEGER) AS quarter, CAST(month(o_orderdate) AS INTEGER) AS month,
    CAST(day(o_orderdate) AS INTEGER) AS day,
    CASE WHEN month(o_orderdate) <= 4 THEN 'Đông Xuân' WHEN month(o_orderdate) <= 8 THEN 'Hè Thu'
      ELSE 'Thu Đông' END AS crop_season
  FROM orders),
dim_region AS (SELECT CAST(r_regionkey AS BIGINT) AS region_id, r_name AS region_name FROM region),
dim_rice AS (
  SELECT DISTINCT 'R0' || substr(o_orderpriority, 1, 1) AS rice_id, o_orderpriority AS rice_name,
    CASE WHEN substr(o_orderpriority, 1, 1) <= '2' THEN 'fragrant' ELSE 'plain' END AS rice_group,
    'VND/kg' AS unit FROM orders),
dim_economy AS (
  SELECT DISTINCT CAST(ascii(c_mktsegment) AS BIGINT) AS eco_id,
    CASE WHEN ascii(c_mktsegment) < 70 THEN 'up' ELSE 'down' END AS cpi_status,
    lower(c_mktsegment) AS market_signal, '%' AS economy_unit FROM customer),
dim_weather AS (
  SELECT DISTINCT CAST(ascii(o_orderstatus) AS BIGINT) AS weather_id, 'type ' || o_orderstatus AS weather_type,
    CASE WHEN o_orderstatus = 'F' THEN 'high' ELSE 'low' END AS severity_level,
    'impact ' || o_orderstatus AS agriculture_impact FROM orders WHERE o_orderstatus <> 'P')"""

FACTS = """
facts AS (
  SELECT * FROM tgt LEFT JOIN ctx USING (date_id, region_id) LEFT JOIN fw USING (date_id, region_id))"""
BASE = """
base AS (
  SELECT * FROM facts LEFT JOIN dim_date USING (date_id) LEFT JOIN dim_region USING (region_id)
  LEFT JOIN dim_rice USING (rice_id) LEFT JOIN dim_economy USING (eco_id)
  LEFT JOIN dim_weather USING (weather_id))"""

# most frequent value, ties to the smallest
_mode = (
    "list_sort(list_transform(map_entries(histogram({c})), lambda e: {{'n': -CAST(e.value AS BIGINT), 'v': e.key}}))[1].v"
)
_month = "CAST(date_trunc('month', date_id) AS DATE)"
MONTHLY_FULL = f"""
monthly AS (
  SELECT {_month} AS date_id, region_id, rice_id, {", ".join(f"avg({c}) AS {c}" for c in NUMBERS)},
    {", ".join(f"{_mode.format(c=c)} AS {c}" for c in CATS)}
  FROM base GROUP BY 1, 2, 3)"""
MONTHLY = f"""
monthly AS (
  SELECT {_month} AS date_id, region_id, rice_id, {", ".join(f"avg({c}) AS {c}" for c in NUMBERS)}
  FROM facts GROUP BY 1, 2, 3)"""

TO_FACTS = ",".join([FACT, CTX, TARGET, FERT, FACTS])
TO_MONTHLY = TO_FACTS + "," + MONTHLY
TO_FULL = ",".join([TO_FACTS, DIMS, BASE, MONTHLY_FULL])
W = "(PARTITION BY region_id, rice_id ORDER BY date_id)"


def _frame(n: int) -> str:
    return f"(PARTITION BY region_id, rice_id ORDER BY date_id ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


CALENDAR = {
    "month_num": "CAST(month(date_id) AS INTEGER)",
    "year_num": "CAST(year(date_id) AS INTEGER)",
    "month_sin": "sin(2 * pi() * month(date_id) / CAST(12 AS DOUBLE))",
    "month_cos": "cos(2 * pi() * month(date_id) / CAST(12 AS DOUBLE))",
}
T_LAGS = {f"price_rice_lag_{k}": f"lag(price_rice, {k}) OVER {W}" for k in range(1, 7)}
F_LAGS = {f"{c}_lag_{k}": f"lag({c}, {k}) OVER {W}" for c in MEASURES for k in range(1, 4)}
R_MEAN = {f"{c}_roll_mean_{n}": f"avg({c}) OVER {_frame(n)}" for c in NUMBERS for n in (2, 3, 6)}
R_STD = {f"{c}_roll_std_{n}": f"stddev_samp({c}) OVER {_frame(n)}" for c in NUMBERS for n in (2, 3, 6)}
CHANGE = {
    "price_rice_diff_1": f"price_rice - lag(price_rice) OVER {W}",
    "price_rice_pct_change_1": f"(price_rice - lag(price_rice) OVER {W}) / nullif(lag(price_rice) OVER {W}, 0)",
}
TARGETS = {f"target_t_plus_{h}": f"lead(price_rice, {h}) OVER {W}" for h in (1, 2, 3)}
DIRECTIONS = {
    f"direction_t_plus_{h}": f"CASE WHEN lead(price_rice, {h}) OVER {W} > price_rice THEN CAST(1 AS DOUBLE) "
    f"WHEN lead(price_rice, {h}) OVER {W} < price_rice THEN CAST(0 AS DOUBLE) END"
    for h in (1, 2, 3)
}
LATEST = {"row_is_latest": "date_id = max(date_id) OVER (PARTITION BY region_id, rice_id)"}
EXTRA = {**CALENDAR, **T_LAGS, **F_LAGS, **R_MEAN, **R_STD, **CHANGE, **TARGETS, **DIRECTIONS, **LATEST}
EXACT = {"month_num", "year_num", "row_is_latest"}
PANEL = f"""
panel AS (SELECT *, {", ".join(f"{e} AS {n}" for n, e in EXTRA.items())} FROM monthly)"""
TO_PANEL = TO_FULL + "," + PANEL


def _block(exprs: dict[str, str], keep=("price_rice",), places: int = 3, plain=()) -> str:
    inner = ", ".join([*keep, *[f"{e} AS {n}" for n, e in exprs.items()]])
    outer = ", ".join(
        n if n in plain else f"{rnd(n, places)} AS {n}" for n in [*keep, *exprs]
    )
    return (
        f"WITH {TO_MONTHLY} SELECT date_id, region_id, rice_id, {outer} FROM "
        f"(SELECT date_id, region_id, rice_id, {inner} FROM monthly)"
    )


def _panel_columns(names, places: int = 3) -> str:
    doubles = [*NUMBERS, *[n for n in EXTRA if n not in EXACT]]
    return ", ".join(f"{rnd(n, places)} AS {n}" if n in doubles else n for n in names)


ALL_PANEL = ["date_id", "region_id", "rice_id", *NUMBERS, *CATS, *EXTRA]
ROLE_TEXT = {c for c in CATS if c not in ("eco_id", "weather_id", "quarter", "month", "year")}
FEATURES = [
    c for c in ALL_PANEL
    if c not in ("date_id", "region_id", "rice_id", "price_rice", "row_is_latest")
    and not c.startswith(("target_t_plus_", "direction_t_plus_"))
]

STAR_SHAPES = f"""WITH {FACT}
SELECT 'fact' AS table_name, count(*) AS n_rows, 18 AS n_columns FROM fact
UNION ALL SELECT 'dim_date', count(DISTINCT o_orderdate), 6 FROM orders
UNION ALL SELECT 'dim_economy', count(DISTINCT c_mktsegment), 4 FROM customer
UNION ALL SELECT 'dim_fertilizer_type', count(DISTINCT l_returnflag), 1 FROM lineitem
UNION ALL SELECT 'dim_region', count(*), 2 FROM region
UNION ALL SELECT 'dim_rice_type', count(DISTINCT o_orderpriority), 4 FROM orders
UNION ALL SELECT 'dim_weather', count(DISTINCT o_orderstatus) FILTER (WHERE o_orderstatus <> 'P'), 4 FROM orders"""

GAPPY = """
gappy AS (
  SELECT event_type, date,
    CASE WHEN (day(date) + length(event_type)) % 4 <> 0 THEN a END AS mean_value,
    CASE WHEN (day(date) + length(event_type)) % 7 <> 0 THEN m END AS max_value
  FROM (SELECT event_type, CAST(ts AS DATE) AS date, avg(value) AS a, max(value) AS m FROM events
        WHERE day(ts) % 5 <> 0 GROUP BY 1, 2))"""


EVERY_DAY = GAPPY.replace("WHERE day(ts) % 5 <> 0 ", "")


def _last(c: str, rows: str, order: str = "date") -> str:
    return (
        f"last_value({c} IGNORE NULLS) OVER (PARTITION BY event_type ORDER BY {order} "
        f"ROWS BETWEEN UNBOUNDED PRECEDING AND {rows})"
    )


def _next(c: str, order: str = "date") -> str:
    return (
        f"first_value({c} IGNORE NULLS) OVER (PARTITION BY event_type ORDER BY {order} "
        f"ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
    )


def _neighbour(c: str) -> str:
    p, n = _last(c, "CURRENT ROW"), _next(c)
    return rnd(f"coalesce({c}, ({p} + {n}) / 2, {p}, {n})") + f" AS {c}"


def _line(c: str) -> str:
    # known neighbours as (date, value); the value lies on the line between them
    return rnd(
        f"CASE WHEN {c} IS NOT NULL THEN {c} WHEN {c}_pd < {c}_nd THEN "
        f"{c}_pv + ({c}_nv - {c}_pv) * (CAST(date - {c}_pd AS DOUBLE) / ({c}_nd - {c}_pd)) END"
    ) + f" AS {c}"


_line_inputs = ", ".join(
    f"{_last(f'CASE WHEN {c} IS NOT NULL THEN date END', 'CURRENT ROW')} AS {c}_pd, "
    f"{_next(f'CASE WHEN {c} IS NOT NULL THEN date END')} AS {c}_nd, "
    f"{_last(c, 'CURRENT ROW')} AS {c}_pv, {_next(c)} AS {c}_nv"
    for c in ("mean_value", "max_value")
)
LINEAR = f"""WITH {GAPPY},
cal AS (SELECT event_type, CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date
        FROM gappy GROUP BY event_type),
dense AS (SELECT cal.event_type, cal.date, mean_value, max_value FROM cal
          LEFT JOIN gappy ON cal.event_type = gappy.event_type AND cal.date = gappy.date)
SELECT event_type, date, {_line("mean_value")}, {_line("max_value")}
FROM (SELECT *, {_line_inputs} FROM dense)"""

RANGES = """
r AS (SELECT p_partkey, CASE WHEN p_partkey % 7 <> 0 THEN
        CASE WHEN p_partkey % 5 = 0 THEN CAST(p_size * 100 AS VARCHAR)
             ELSE (p_size * 100) || '-' || (p_size * 100 + p_partkey % 50 * 10) END END AS t FROM part)"""

_index = f"(?i){fixed.INDEX_MOVE}"
TREND = f"""
WITH t AS (
  SELECT o_orderkey, (o_orderkey % 7) || ',' || (o_orderkey % 89 + 10) AS v,
    CASE o_orderkey % 4 WHEN 0 THEN 'TĂNG' WHEN 1 THEN 'giảm' WHEN 2 THEN 'ổn định' ELSE 'đứng yên' END AS w
  FROM orders),
s AS (
  SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'Giá cả Tăng ' || v || '%' ELSE 'Tin thị trường' END AS title,
    'Theo báo cáo, chỉ số giá tiêu dùng ' || w || ' nhẹ ' || v || ' %' AS body FROM t),
m AS (
  SELECT o_orderkey, title, lower(regexp_extract(title || '. ' || body, '{_index}', 2)) AS word,
    regexp_extract(title || '. ' || body, '{_index}', 3) AS hit,
    regexp_extract(title, '{fixed.PERCENT}', 1) AS own FROM s)
SELECT o_orderkey,
  CASE WHEN word = 'tăng' THEN 'Tăng' WHEN word = 'giảm' THEN 'Giảm' WHEN word <> '' THEN 'Đi ngang'
       WHEN own <> '' AND contains(lower(title), 'tăng') THEN 'Tăng'
       WHEN own <> '' AND contains(lower(title), 'giảm') THEN 'Giảm' ELSE 'Không rõ' END AS trend,
  replace(nullif(CASE WHEN word <> '' THEN hit ELSE own END, ''), ',', '.') AS amount
FROM m"""

URL_DATE = r"""
WITH u AS (
  SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d,
    'https://news.example/gia-phan-bon-' || CASE WHEN o_orderkey % 2 = 0 THEN 'hom-nay-' ELSE 'ngay-' END ||
    CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%d%m') WHEN 1 THEN day(o_orderdate) || strftime(o_orderdate, '%m')
      WHEN 2 THEN day(o_orderdate) || '' || month(o_orderdate) ELSE '' END ||
    '-tin-' || (o_orderkey % 6 + 2021) || '.htm' AS URL FROM orders),
x AS (
  SELECT *, regexp_extract(URL, '(?:ngay|hom-nay)-(\d{1,4})', 1) AS g, regexp_extract(URL, '(202[3-5])', 1) AS y FROM u),
p AS (
  SELECT *, CASE length(g) WHEN 4 THEN substr(g, 1, 2) ELSE substr(g, 1, 1) END AS dd,
    CASE length(g) WHEN 4 THEN substr(g, 3) ELSE substr(g, 2) END AS mm FROM x)
SELECT URL, CAST(coalesce(CASE WHEN y <> '' AND length(g) >= 2
  THEN TRY_CAST(y || '-' || lpad(mm, 2, '0') || '-' || lpad(dd, 2, '0') AS DATE) END, d) AS VARCHAR) AS Ngay_Chuan
FROM p"""

DAY_FIRST = """
SELECT o_orderkey, CASE WHEN o_orderkey % 4 < 3 THEN strftime(o_orderdate, '%Y-%m-%d') ELSE 'chưa rõ' END AS day
FROM orders"""

PRICE_TEXT = """
WITH s AS (SELECT o_orderkey AS k, o_orderkey % 700 + 80 AS low FROM orders),
v AS (SELECT *, low * 1000 BETWEEN 100000 AND 2000000 AS fits,
  low || '000' || CASE WHEN k % 3 = 0 THEN '-' || (low + 20) || '000' ELSE '' END AS span FROM s)
SELECT k AS o_orderkey,
  CASE WHEN fits THEN CASE WHEN k % 5 = 0 THEN low || '000' ELSE span END END AS price_0,
  CASE WHEN fits AND k % 7 <> 0 THEN span END AS price_1
FROM v"""

_TITLE = """replace(replace(replace(replace(coalesce(
  nullif(trim(regexp_replace(regexp_extract(html, '(?is)<h1\\b[^>]*\\bclass=["''][^"'']*\\bdetail-title\\b[^>]*>(.*?)</h1\\s*>', 1), '<[^>]*>', '', 'g')), ''),
  nullif(trim(regexp_replace(regexp_extract(html, '(?is)<h1\\b[^>]*>(.*?)</h1\\s*>', 1), '<[^>]*>', '', 'g')), ''), ''), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&')""".replace("\\\\", "\\")
PAGE_TITLE = f"""
SELECT page_id, CASE WHEN page_id % 2 = 0 THEN 'Gạo & Cámtăng' || page_id ELSE {_TITLE} END AS title FROM pages"""

ARTICLE_DATE = """
SELECT url, CASE page_id % 3
  WHEN 0 THEN lpad(CAST(page_id % 28 + 1 AS VARCHAR), 2, '0') || '/03/2024'
  WHEN 1 THEN (page_id % 28 + 1) || '/7/2023' END AS ngay_thang
FROM pages"""

ARTICLE_RECORDS = f"""
SELECT url, {_TITLE} AS tieu_de, CASE WHEN page_id % 4 = 3 THEN 'Không rõ' WHEN page_id % 2 = 0 THEN 'Tăng' ELSE 'Giảm' END AS xu_huong_bien_dong,
  CASE WHEN page_id % 4 <> 3 THEN (page_id % 9) || '.' || (page_id % 90 + 10) END AS muc_tang_giam, '%' AS don_vi
FROM pages"""

# the page outside the table holds no price words, so both ways give the table's figures; a
# regional table or the page text differ only in the way the figures are found
REGION_PRICES = """
SELECT row_number() OVER (ORDER BY '2024-02-' || lpad(CAST(page_id % 28 + 1 AS VARCHAR), 2, '0'), url) AS id,
  '2024-02-' || lpad(CAST(page_id % 28 + 1 AS VARCHAR), 2, '0') AS ngay_dang, url,
  '650000' AS price_0,
  CASE WHEN page_id % 300 + 90 >= 100 THEN (page_id % 300 + 90) || '000' END AS price_1,
  (page_id % 500 + 400) || '000-' || (page_id % 500 + 420) || '000' AS price_2
FROM pages"""

FOLDS = """
months AS (SELECT date_id AS month, row_number() OVER (ORDER BY date_id) AS r, count(*) OVER () AS n
           FROM (SELECT DISTINCT date_id FROM {src})),
cuts AS (SELECT DISTINCT c.cut, c.cut - greatest(12, n - 6) + 1 AS fold FROM
         (SELECT n, CAST(unnest(generate_series(greatest(12, n - 6), n - 1)) AS BIGINT) AS cut FROM months) c),
fold AS (SELECT CAST(fold AS INTEGER) AS fold, month, CASE WHEN r <= cut THEN 'train' ELSE 'valid' END AS role
         FROM months JOIN cuts ON r <= cut + 1)"""


def _baseline() -> str:
    cols = {**{k: v for k, v in R_MEAN.items() if k.startswith("price_rice")}, **CHANGE, **TARGETS, **DIRECTIONS}
    parts = [f"p AS MATERIALIZED (SELECT *, {', '.join(f'{e} AS {n}' for n, e in cols.items())} FROM monthly)"]
    rules = {
        "regression": {"last_value": "price_rice", "mean_3": "price_rice_roll_mean_3", "mean_6": "price_rice_roll_mean_6"},
        "classification": {
            "repeat_move": "CASE WHEN price_rice_diff_1 > 0 THEN 1 ELSE 0 END",
            "back_to_mean": "CASE WHEN price_rice < price_rice_roll_mean_3 THEN 1 ELSE 0 END",
        },
    }
    for task, guesses in rules.items():
        selects = []
        for h in (1, 2, 3):
            label = f"{'target' if task == 'regression' else 'direction'}_t_plus_{h}"
            tag = f"{task[:3]}{h}"
            parts.append(f"k_{tag} AS (SELECT * FROM p WHERE {label} IS NOT NULL)")
            parts.append(FOLDS.format(src=f"k_{tag}").replace("months", f"m_{tag}").replace("cuts", f"c_{tag}")
                         .replace("\nfold AS", f"\nf_{tag} AS"))
            for name, guess in guesses.items():
                selects.append(
                    f"SELECT '{task}' AS task, {h} AS horizon, '{name}' AS model_name, fold, {label} AS truth, "
                    f"CAST({guess} AS DOUBLE) AS guess FROM k_{tag} JOIN f_{tag} ON date_id = month WHERE role = 'valid'"
                )
        parts.append(f"{task}_rows AS (" + " UNION ALL ".join(selects) + ")")
    parts.append("""
reg AS (SELECT task, horizon, model_name, fold, sqrt(avg((truth - guess) * (truth - guess))) AS rmse,
  avg(abs(truth - guess)) AS mae, avg(CASE WHEN abs(truth) >= 1e-8 THEN abs((truth - guess) / abs(truth)) END) * 100 AS mape,
  CASE WHEN count(*) < 2 THEN NULL WHEN min(truth) = max(truth) THEN CASE WHEN sum(abs(truth - guess)) = 0 THEN 1 ELSE 0 END
    ELSE 1 - sum((truth - guess) * (truth - guess)) / (var_pop(truth) * count(*)) END AS r2
  FROM regression_rows WHERE guess IS NOT NULL GROUP BY ALL)""")
    parts.append("""
cls AS (SELECT task, horizon, model_name, fold, avg(CASE WHEN truth = guess THEN CAST(1 AS DOUBLE) ELSE 0 END) AS accuracy
  FROM classification_rows WHERE guess IS NOT NULL GROUP BY ALL)""")
    parts.append("scores AS (SELECT * FROM reg UNION ALL BY NAME SELECT * FROM cls)")
    return f"WITH {TO_MONTHLY}, " + ",\n".join(parts)


BASELINE = _baseline()
REG = ["rmse", "mae", "mape", "r2"]
_summary_cols = ", ".join(f"{rnd(f'avg({c})', 3)} AS {c}" for c in [*REG, "accuracy"])
SUMMARY = f"summary AS (SELECT task, horizon, model_name, {_summary_cols} FROM scores GROUP BY ALL)"

FORECAST_EXPORT = f"""WITH {TO_PANEL},
f AS (SELECT *, CAST(date_id + to_months(h) AS DATE) AS fm FROM panel, (VALUES (1), (2), (3)) v(h) WHERE row_is_latest)
SELECT strftime(date_id, '%m/%Y') AS thang_goc_du_bao, strftime(fm, '%m/%Y') AS thang_du_bao,
  CAST(year(fm) AS INTEGER) AS nam_du_bao, CAST(month(fm) AS INTEGER) AS thang_so_du_bao, h AS so_thang_du_bao,
  region_id, region_name, rice_id, rice_name, rice_group, {rnd("price_rice", 3)} AS gia_hien_tai,
  CAST(round(CAST({rnd("price_rice", 3)} AS DECIMAL(18, 3)), 2) AS DOUBLE) AS gia_du_bao,
  CASE WHEN {rnd("price_rice_diff_1", 3)} > 0 THEN 'Tăng' ELSE 'Giảm/Đi ngang' END AS xu_huong_du_bao
FROM f"""

GAPPY_LINES = """
g AS (SELECT l_orderkey, l_partkey, l_suppkey, CASE WHEN l_orderkey % 7 <> 0 THEN l_quantity END AS l_quantity,
  CASE WHEN l_orderkey % 5 <> 0 THEN l_extendedprice END AS l_extendedprice,
  CASE WHEN l_orderkey % 3 <> 0 THEN l_returnflag END AS l_returnflag FROM lineitem)"""

_corr = [*MEASURES, *T_LAGS]
CORR = (
    f"WITH {TO_MONTHLY}, w AS (SELECT *, {', '.join(f'{e} AS {n}' for n, e in T_LAGS.items())} FROM monthly) "
    "SELECT feature, " + rnd("corr") + " AS corr FROM (SELECT unnest(["
    + ", ".join(f"{{'feature': '{c}', 'corr': corr(price_rice, {c})}}" for c in _corr)
    + "], recursive := true) FROM w) ORDER BY abs(corr) DESC NULLS LAST, feature LIMIT 30"
)



def _per_horizon(label: str) -> str:
    """Rows of ``src`` once per horizon with a known label and per fold, with the role of their month."""
    y = f"CASE h WHEN 1 THEN {label}1 WHEN 2 THEN {label}2 ELSE {label}3 END"
    return f"""labelled AS (SELECT CAST(h AS INTEGER) AS horizon, {y} AS y, src.* FROM src, (VALUES (1), (2), (3)) v(h) WHERE {y} IS NOT NULL),
months AS (SELECT horizon, date_id AS month, row_number() OVER (PARTITION BY horizon ORDER BY date_id) AS r,
  count(*) OVER (PARTITION BY horizon) AS n FROM (SELECT DISTINCT horizon, date_id FROM labelled)),
cuts AS (SELECT horizon, cut, cut - greatest(12, n - 6) + 1 AS fold
  FROM (SELECT DISTINCT horizon, n, CAST(unnest(generate_series(greatest(12, n - 6), n - 1)) AS BIGINT) AS cut FROM months)),
fold AS (SELECT horizon, CAST(fold AS INTEGER) AS fold, month, CASE WHEN r <= cut THEN 'train' ELSE 'valid' END AS role
  FROM months JOIN cuts USING (horizon) WHERE r <= cut + 1),
member AS (SELECT l.*, fold, role FROM labelled l JOIN fold f ON l.horizon = f.horizon AND date_id = month)"""


FOLD_NUMBERS = [*MEASURES, *T_LAGS]
FOLD_SOURCE = f"""src AS (SELECT date_id, region_id, rice_id, {", ".join(NUMBERS)},
  {", ".join(f"{e} AS {c}" for c, e in {**T_LAGS, **TARGETS}.items())} FROM monthly)"""


def _mixed(e: str) -> str:
    return f"(({e}) * ({e}) % 2147483647 + ({e}) * 48271 + 11) % 2147483647"


TREE_CUTS = f"""long AS (SELECT target_t_plus_1 AS y, unnest({list(range(len(FOLD_NUMBERS)))}) AS f,
  unnest([{", ".join(f"coalesce(CAST({c} AS DOUBLE), 0)" for c in FOLD_NUMBERS)}]) AS x FROM src WHERE target_t_plus_1 IS NOT NULL),
span AS (SELECT f, min(x) AS lo, max(x) AS hi FROM long GROUP BY f),
m1 AS (SELECT span.*, t, {_mixed("42 + t")} AS m FROM span, range(25) r(t)),
m2 AS (SELECT * EXCLUDE m, {_mixed("m")} AS m FROM m1),
m3 AS (SELECT * EXCLUDE m, {_mixed("m + f")} AS m FROM m2),
m4 AS (SELECT * EXCLUDE m, {_mixed("m")} AS m FROM m3),
cuts AS (SELECT t, f, lo + {_mixed("m")} / CAST(2147483647 AS DOUBLE) * (hi - lo) AS cut FROM m4)"""
FOLD_TEXTS = f"""src AS (SELECT date_id, rice_id AS rice, CAST(region_id AS VARCHAR) AS region,
  CASE WHEN month(date_id) <> 3 THEN strftime(date_id, '%m') END AS month_text,
  {", ".join(f"{e} AS {c}" for c, e in DIRECTIONS.items())} FROM monthly)"""

FACT_COLUMNS = [
    "date_id", "region_id", "eco_id", "weather_id", "rice_id", "price_rice", "row_key", "fert_id", "price_fert",
    *fixed.CONTEXT_MEASURES,
]

SQL = {
    "load_star": STAR_SHAPES,
    "profile_shape": STAR_SHAPES,
    "read_csv_schema": "SELECT event_id, CAST(ts AS DATE) AS report_date, event_type, value, "
    "CASE WHEN event_id % 9 <> 0 THEN props END AS data FROM events",
    "write_csv": "SELECT c_custkey, c_name || ', \"' || c_mktsegment || '\"' AS label, c_acctbal FROM customer",
    "write_json": "SELECT event_id, 'giá gạo ' || event_type AS tieu_de, "
    "CASE WHEN event_id % 9 <> 0 THEN value END AS muc_tang_giam FROM events",
    "clean_fact": """
SELECT o_orderkey AS row_key, CASE WHEN o_orderkey % 13 <> 0 THEN CAST(o_orderdate AS DATE) END AS date_id,
  CASE WHEN o_orderkey % 17 = 0 THEN NULL WHEN o_orderkey % 3 = 0 THEN o_orderkey % 5
       WHEN o_orderkey % 19 = 0 THEN NULL ELSE o_orderkey % 5 END AS region_id,
  o_orderkey % 4 AS eco_id, CASE WHEN o_orderkey % 23 <> 0 THEN o_totalprice END AS price_rice,
  o_orderpriority AS rice_id FROM orders""",
    "ingest_stream": "SELECT DISTINCT event_type, user_id, CAST(ts AS DATE) AS day FROM events",
    "parse_price_map": """
SELECT event_id, regexp_extract(props, '(\\d+)', 1) AS ure,
  CASE WHEN event_id % 3 = 2 AND event_id % 5 <> 0 THEN CAST(event_id AS VARCHAR) END AS kali FROM events""",
    "range_low": f"WITH {RANGES} SELECT p_partkey, CAST(split_part(t, '-', 1) AS DOUBLE) AS price FROM r",
    "range_mid": f"WITH {RANGES} SELECT p_partkey, "
    + rnd("(CAST(split_part(t, '-', 1) AS DOUBLE) + CAST(split_part(t, '-', -1) AS DOUBLE)) / 2 / 50")
    + " AS price_per_kg FROM r",
    "ffill": "SELECT event_type, event_id, last_value(CASE WHEN event_id % 7 <> 0 THEN value END IGNORE NULLS) "
    "OVER (PARTITION BY event_type ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS value FROM events",
    "neighbor_mean_fill": f"WITH {EVERY_DAY}, masked AS (SELECT event_type, date, mean_value, "
    "CASE WHEN mean_value IS NOT NULL THEN max_value END AS max_value FROM gappy) "
    f"SELECT event_type, date, {_neighbour('mean_value')}, {_neighbour('max_value')} FROM masked",
    "linear_interp": LINEAR,
    "dedupe_rows": "SELECT DISTINCT event_type, user_id, CAST(ts AS DATE) AS day FROM events",
    "overlay_fix": """
WITH o AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, o_orderstatus AS feed, o_totalprice AS price FROM orders),
merged AS (SELECT * FROM o WHERE day < DATE '2001-01-01' AND feed <> 'P'
  UNION ALL SELECT o_orderkey, day, feed, price + 1000 FROM o WHERE feed = 'P' AND o_orderkey % 2 = 0)
SELECT * FROM merged UNION ALL
SELECT * FROM o WHERE day >= DATE '2001-01-01' AND o_orderkey NOT IN (SELECT o_orderkey FROM merged)""",
    "signed_change": """
SELECT o_orderkey, CASE o_orderstatus WHEN 'P' THEN 0 WHEN 'F' THEN -o_totalprice ELSE o_totalprice END AS change,
  CASE o_orderstatus WHEN 'P' THEN 'Ổn định' WHEN 'F' THEN 'Giảm' ELSE 'Tăng' END AS trend FROM orders""",
    "yield_derive": "SELECT l_orderkey, l_linenumber, l_partkey, "
    + rnd("CASE WHEN l_linenumber <> 7 THEN l_extendedprice * 1000 / l_quantity END") + " AS yield_kg FROM lineitem",
    "spot_reading_flag": """
SELECT CAST(l_shipdate AS DATE) AS day, l_suppkey, avg(l_quantity) = max(l_quantity) AND avg(l_quantity) = min(l_quantity)
  AS is_spot FROM lineitem GROUP BY 1, 2""",
    "price_range_guard": "SELECT o_orderkey, CASE WHEN o_totalprice BETWEEN 50000 AND 300000 THEN o_totalprice END AS price FROM orders",
    "page_title": PAGE_TITLE,
    "article_date": ARTICLE_DATE,
    "article_records": ARTICLE_RECORDS,
    "region_table_prices": REGION_PRICES,
    "trend_extract": TREND,
    "url_date": URL_DATE,
    "dayfirst_date": DAY_FIRST,
    "price_extract": PRICE_TEXT,
    "daily_context": f"WITH {FACT}, {CTX} SELECT date_id, region_id, eco_id, weather_id, {_rounded(fixed.CONTEXT_MEASURES, 4)} FROM ctx",
    "daily_target": f"WITH {FACT}, {TARGET} SELECT date_id, region_id, rice_id, {rnd('price_rice', 3)} AS price_rice FROM tgt",
    "fert_wide": f"WITH {FACT}, {FERT} SELECT date_id, region_id, {_rounded(FERTS, 4)} FROM fw",
    "daily_base": f"WITH {TO_FACTS}, {DIMS}, {BASE} SELECT * REPLACE ({_rounded(NUMBERS, 3)}) FROM base",
    "monthly_agg": f"WITH {TO_FULL} SELECT * REPLACE ({_rounded(NUMBERS, 3)}) FROM monthly",
    "monthly_mode": f"""WITH {FACT}, n AS (
  SELECT CAST(date_trunc('month', date_id) AS DATE) AS month, region_id, eco_id, count(*) AS c FROM fact
  WHERE region_id IS NOT NULL AND eco_id IS NOT NULL GROUP BY 1, 2, 3)
SELECT month, region_id, eco_id FROM n QUALIFY row_number() OVER (PARTITION BY month, region_id ORDER BY c DESC, eco_id) = 1""",
    "calendar_features": _block(CALENDAR, keep=(), places=4, plain=("month_num", "year_num")),
    "target_lags": _block(T_LAGS),
    "feature_lags": _block(F_LAGS),
    "rolling_mean": _block(R_MEAN),
    "rolling_std": _block(R_STD),
    "diff_pct": _block(CHANGE),
    "lead_targets": _block(TARGETS),
    "direction_labels": _block(DIRECTIONS, keep=(), plain=tuple(DIRECTIONS)),
    "latest_row": f"""WITH {FACT} SELECT region_id, rice_id, date_id, row_key, price_rice FROM fact
WHERE region_id IS NOT NULL AND price_rice IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY region_id, rice_id ORDER BY date_id DESC, row_key) = 1""",
    "monthly_panel": f"WITH {TO_PANEL} SELECT {_panel_columns(ALL_PANEL)} FROM panel",
    "training_matrix": f"WITH {TO_PANEL} SELECT "
    + _panel_columns(["date_id", "region_id", "rice_id", *FEATURES, "direction_t_plus_1"])
    + " FROM panel WHERE direction_t_plus_1 IS NOT NULL",
    "align_columns": f"WITH {TO_PANEL} SELECT date_id, region_id, rice_id, {_rounded(['price_rice', 'price_rice_lag_1'], 3)}, "
    "CAST(NULL AS DOUBLE) AS price_fert_Z, region_name FROM panel WHERE row_is_latest",
    "infer_roles": f"WITH {TO_PANEL} SELECT unnest(["
    + ", ".join(
        f"{{'column_name': '{c}', 'n_known': count({c}), 'role': '{'categorical' if c in ROLE_TEXT else 'numeric'}'}}"
        for c in FEATURES
    )
    + "], recursive := true) FROM panel",
    "series_length": f"WITH {TO_MONTHLY} SELECT region_id, rice_id, count(DISTINCT date_id) AS n_months FROM monthly GROUP BY ALL",
    "value_counts": f"WITH {FACT}, {TARGET} SELECT rice_id, count(*) AS n_rows FROM tgt GROUP BY ALL ORDER BY rice_id",
    "nonnull_profile": f"WITH {FACT} SELECT unnest(["
    + ", ".join(f"{{'column_name': '{c}', 'n_known': count({c})}}" for c in FACT_COLUMNS)
    + "], recursive := true) FROM fact",
    "corr_with_target": CORR,
    "expanding_folds": f"WITH {TO_MONTHLY}, {FOLDS.format(src='monthly')} "
    "SELECT fold, role, count(*) AS n_rows, min(date_id) AS first_month, max(date_id) AS last_month "
    "FROM monthly JOIN fold ON date_id = month GROUP BY fold, role",
    "reg_metrics": f"{BASELINE} SELECT task, horizon, model_name, fold, {_rounded(REG, 3)} FROM reg",
    "cls_accuracy": f"{BASELINE} SELECT task, horizon, model_name, fold, {rnd('accuracy')} AS accuracy FROM cls",
    "score_union": f"{BASELINE} SELECT task, horizon, model_name, fold, {_rounded([*REG, 'accuracy'], 3)} FROM scores",
    "score_summary": f"{BASELINE}, {SUMMARY} SELECT * FROM summary",
    "best_model": f"""{BASELINE}, {SUMMARY} SELECT * FROM summary QUALIFY row_number() OVER (
  PARTITION BY task, horizon ORDER BY rmse NULLS LAST, mae NULLS LAST, mape NULLS LAST, accuracy DESC NULLS LAST, model_name) = 1""",
    "majority_class": f"""WITH {TO_MONTHLY}, d AS (SELECT *, {DIRECTIONS['direction_t_plus_1']} AS y FROM monthly),
n AS (SELECT rice_id, y, count(*) AS c FROM d WHERE y IS NOT NULL GROUP BY ALL)
SELECT rice_id, y AS majority FROM n QUALIFY row_number() OVER (PARTITION BY rice_id ORDER BY c DESC, y) = 1""",
    "impute_median": f"WITH {GAPPY_LINES} SELECT l_orderkey, l_partkey, l_suppkey, "
    + rnd("coalesce(l_quantity, (SELECT median(l_quantity) FROM g))") + " AS l_quantity, "
    + rnd("coalesce(l_extendedprice, (SELECT median(l_extendedprice) FROM g))") + " AS l_extendedprice, l_returnflag FROM g",
    "impute_mode": f"""WITH {GAPPY_LINES} SELECT l_orderkey, l_partkey, coalesce(l_returnflag, (SELECT l_returnflag FROM g
  WHERE l_returnflag IS NOT NULL GROUP BY l_returnflag ORDER BY count(*) DESC, l_returnflag LIMIT 1)) AS l_returnflag FROM g""",
    "one_hot": """
WITH k AS (SELECT o_orderpriority AS p, row_number() OVER (ORDER BY o_orderpriority) - 1 AS i, count(*) OVER () AS n
  FROM (SELECT DISTINCT o_orderpriority FROM orders WHERE o_orderpriority <> '3-MEDIUM'))
SELECT o_orderkey, CAST((SELECT max(n) FROM k) AS INTEGER) AS width, CAST(coalesce(i, -1) AS INTEGER) AS hot_at
FROM orders LEFT JOIN k ON o_orderpriority = p""",
    "ordinal_encode": """
WITH k AS (SELECT o_orderpriority AS p, row_number() OVER (ORDER BY o_orderpriority) - 1 AS i
  FROM (SELECT DISTINCT o_orderpriority FROM orders WHERE o_orderpriority <> '3-MEDIUM'))
SELECT o_orderkey, CAST(coalesce(i, -1) AS DOUBLE) AS code FROM orders LEFT JOIN k ON o_orderpriority = p""",
    "standardize": "WITH s AS (SELECT avg(l_quantity) AS qm, stddev_pop(l_quantity) AS qs, avg(l_extendedprice) AS em, "
    "stddev_pop(l_extendedprice) AS es FROM lineitem) SELECT l_orderkey, l_partkey, "
    + rnd("(l_quantity - (SELECT qm FROM s)) / (SELECT qs FROM s)") + " AS l_quantity, "
    + rnd("(l_extendedprice - (SELECT em FROM s)) / (SELECT es FROM s)") + " AS l_extendedprice FROM lineitem",
    "forecast_calendar": """
SELECT o_orderkey, h AS horizon, CAST(date_trunc('month', CAST(o_orderdate AS DATE)) + to_months(h) AS DATE) AS forecast_month,
  strftime(date_trunc('month', CAST(o_orderdate AS DATE)) + to_months(h), '%m/%Y') AS label,
  CAST(year(date_trunc('month', o_orderdate) + to_months(h)) AS INTEGER) AS year,
  CAST(month(date_trunc('month', o_orderdate) + to_months(h)) AS INTEGER) AS month
FROM orders, (VALUES (1), (2), (3)) v(h)""",
    "forecast_export": FORECAST_EXPORT,
    "forecast_sink": FORECAST_EXPORT,
    "fold_statistics": f"""WITH {TO_MONTHLY}, {FOLD_SOURCE}, {_per_horizon("target_t_plus_")},
long AS (SELECT horizon, fold, unnest([{", ".join(f"'{c}'" for c in FOLD_NUMBERS)}]) AS column_name,
  unnest([{", ".join(f"CAST({c} AS DOUBLE)" for c in FOLD_NUMBERS)}]) AS v FROM member WHERE role = 'train'),
med AS (SELECT horizon, fold, column_name, median(v) AS m FROM long GROUP BY ALL)
SELECT horizon, fold, column_name, {rnd("m", 3)} AS median, {rnd("avg(coalesce(v, m))", 3)} AS mean,
  {rnd("CASE WHEN stddev_pop(coalesce(v, m)) = 0 THEN 1 ELSE stddev_pop(coalesce(v, m)) END", 3)} AS dev
FROM long JOIN med USING (horizon, fold, column_name) GROUP BY horizon, fold, column_name, m""",
    "fold_modes": f"""WITH {TO_MONTHLY}, {FOLD_TEXTS}, {_per_horizon("direction_t_plus_")},
long AS (SELECT horizon, fold, unnest(['rice', 'region', 'month_text']) AS column_name, unnest([rice, region, month_text]) AS text
  FROM member WHERE role = 'train'),
n AS (SELECT horizon, fold, column_name, text, count(*) AS n_rows FROM long WHERE text IS NOT NULL GROUP BY ALL)
SELECT * FROM n QUALIFY row_number() OVER (PARTITION BY horizon, fold, column_name ORDER BY n_rows DESC, text) = 1""",
    "extra_trees_level": f"""WITH {TO_MONTHLY}, {FOLD_SOURCE}, {TREE_CUTS},
sums AS (SELECT t, f, cut, count(*) AS n, sum(y) AS s, sum(y * y) AS q, count(*) FILTER (x <= cut) AS nl, sum(y) FILTER (x <= cut) AS sl
  FROM cuts JOIN long USING (f) GROUP BY ALL),
gains AS (SELECT *, sl * sl / nl + (s - sl) * (s - sl) / (n - nl) - s * s / n AS gain FROM sums WHERE nl >= 2 AND n - nl >= 2),
best AS (SELECT *, max(gain) OVER (PARTITION BY t) AS most FROM gains)
SELECT CAST(t AS INTEGER) AS tree, [{", ".join(f"'{c}'" for c in FOLD_NUMBERS)}][f + 1] AS column_name, {rnd("cut", 3)} AS cut, nl AS n_left, n - nl AS n_right,
  {rnd("sl / nl", 3)} AS mean_left, {rnd("(s - sl) / (n - nl)", 3)} AS mean_right
FROM best WHERE gain >= most - 1e-9 * q QUALIFY row_number() OVER (PARTITION BY t ORDER BY f) = 1""",
    "elastic_net_folds": f"""WITH {TO_MONTHLY}, {FOLD_SOURCE}, {_per_horizon("target_t_plus_")}
SELECT horizon, fold, count(*) FILTER (role = 'train') AS train_rows, true AS optimal, count(*) FILTER (role = 'valid') AS valid_rows,
  {rnd("avg(y) FILTER (role = 'valid')", 3)} AS valid_mean FROM member GROUP BY ALL""",
}
