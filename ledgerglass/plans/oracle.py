"""DuckDB SQL for the catalog queries, written independently of the Spark operators."""

from __future__ import annotations

# one transaction per (order, supplier)
TX = """tx0 AS (
SELECT l_orderkey*1000000 + l_suppkey AS trans_num,
       epoch_us(min(o_orderdate)) + ((l_orderkey*7919 + l_suppkey*104729) % 86400)*1000000 AS us,
       min(o_custkey) AS cc_num, min(s_name) AS merchant, min(p_type) AS category, min(p_name) AS job,
       CASE WHEN min(o_custkey) % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
       concat('C', CAST(min(o_custkey) % 40 AS VARCHAR)) AS city, min(n_name) AS state,
       500 + (min(o_custkey) % 40)*(min(o_custkey) % 40)*1500 AS city_pop,
       DATE '1930-01-01' + CAST(min(o_custkey)*7919 % 25000 AS INTEGER) AS dob,
       25 + (min(o_custkey)*7919 % 2400)/1e2 AS lat, -124 + (min(o_custkey)*104729 % 5700)/1e2 AS long,
       25 + (l_suppkey*7919 % 2400)/1e2 AS merch_lat, -124 + (l_suppkey*104729 % 5700)/1e2 AS merch_long,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS amt,
       CASE WHEN ((l_orderkey*1000000 + l_suppkey) % 100003)*7919 % 1000 < 20 THEN 1 ELSE 0 END AS is_fraud
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
     JOIN nation ON c_nationkey = n_nationkey JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey
GROUP BY l_orderkey, l_suppkey),
tx AS (SELECT *, ((trans_num % 99991)*104729 % 1000 + is_fraud*300)/1.3e3 AS score, make_timestamp(us) AS ts,
              CAST(make_timestamp(us) AS DATE) AS trans_date,
              CAST(round(amt*100) AS BIGINT) AS cents FROM tx0)"""

F_ = "(1e0/298.257223563e0)"


def _geo() -> str:
    """Ellipsoidal distance in miles: five steps of the equation for the longitude on the sphere (near-antipodal pairs, which the tables lack, give null)."""
    ctes = [
        f"geo0 AS (SELECT trans_num AS gid, atan((1-{F_})*tan(radians(lat))) AS b1, atan((1-{F_})*tan(radians(merch_lat))) AS b2, abs(radians(merch_long)-radians(long)) AS span, lat = merch_lat AND long = merch_long AS same FROM tx)",
        "geo1 AS (SELECT *, sin(b1) AS s1, cos(b1) AS c1, sin(b2) AS s2, cos(b2) AS c2, span AS lam FROM geo0)",
    ]
    last = "geo1"
    for i in range(5):
        ctes.append(
            f"ga{i} AS (SELECT gid, same, span, s1, c1, s2, c2, lam AS was, sqrt(pow(c2*sin(lam),2)+pow(c1*s2-s1*c2*cos(lam),2)) AS ss, s1*s2+c1*c2*cos(lam) AS cs, c1*c2*sin(lam) AS pr FROM {last})"
        )
        ctes.append(f"gb{i} AS (SELECT *, atan2(ss, cs) AS arc, CASE WHEN ss = 0 THEN 0e0 ELSE pr/ss END AS az FROM ga{i})")
        ctes.append(f"gc{i} AS (SELECT *, CASE WHEN 1-az*az <= 0 THEN 0e0 ELSE cs-2*s1*s2/(1-az*az) END AS mid, {F_}/16*(1-az*az)*(4+{F_}*(4-3*(1-az*az))) AS c FROM gb{i})")
        ctes.append(f"gd{i} AS (SELECT *, span+(1-c)*{F_}*az*(arc+c*ss*(mid+c*cs*(2*mid*mid-1))) AS lam FROM gc{i})")
        last = f"gd{i}"
    minor = f"(6378137e0*(1-{F_}))"
    ctes += [
        f"ge AS (SELECT *, (1-az*az)*((6378137e0*6378137e0-{minor}*{minor})/({minor}*{minor})) AS u FROM {last})",
        "gf AS (SELECT *, 1+u/16384*(4096+u*(u*(320-175*u)-768)) AS ka, u/1024*(256+u*(u*(74-47*u)-128)) AS kb FROM ge)",
        f"gg AS (SELECT gid, CASE WHEN same THEN 0e0 WHEN abs(lam-was) < 1e-11 AND lam < pi() THEN {minor}*ka*(arc-kb*ss*(mid+kb/4*(cs*(2*mid*mid-1)-kb/6*mid*(4*ss*ss-3)*(4*mid*mid-3))))/1609.344e0 END AS distance FROM gf)",
        "geo AS (SELECT tx.*, distance FROM tx JOIN gg ON trans_num = gid)",
    ]
    return ",\n".join(ctes)


GEO = _geo()

DAY = 86_400_000_000
WINDOWS = (7, 30, 90)


def _risk(w: int, d: int = 7) -> str:
    frame = f"(PARTITION BY merchant ORDER BY us RANGE BETWEEN {(d + w) * DAY - 1} PRECEDING AND {d * DAY} PRECEDING)"
    return (
        f"CAST(count(is_fraud) OVER {frame} AS BIGINT) AS merchant_num_trans_{w}_day_window, "
        f"round(coalesce(CAST(sum(is_fraud) OVER {frame} AS DOUBLE)/nullif(count(is_fraud) OVER {frame},0),0),6) AS merchant_risk_{w}_day_window"
    )


# windows of a card that end at its previous transaction (no equal times within a card here)
def _card(w: int, expr: str) -> str:
    return f"{expr} OVER (PARTITION BY cc_num ORDER BY us RANGE BETWEEN {w * DAY - 1} PRECEDING AND CURRENT ROW)"


def _card_cte() -> str:
    rolls = ", ".join(
        f"{_card(w, 'sum(cents)')} AS s{w}, {_card(w, 'count(cents)')} AS c{w}, "
        f"{_card(w, 'sum(CAST(round(distance*1048576) AS BIGINT))')} AS m{w}"
        for w in WINDOWS
    )
    lags = ", ".join(
        f"lag({x}{w}) OVER (PARTITION BY cc_num ORDER BY us) AS l{x}{w}" for w in WINDOWS for x in "scm"
    )
    return f"""roll AS (SELECT *, {rolls} FROM geo),
lagged AS (SELECT *, {lags}, lag(us) OVER (PARTITION BY cc_num ORDER BY us) AS prev_us FROM roll),
means AS (SELECT city AS mcity, CAST(sum(cents) AS DOUBLE)/count(*)/100 AS ca, avg(distance) AS cd FROM geo GROUP BY city),
card AS (SELECT * FROM lagged JOIN means ON city = mcity)"""



# category dictionary: part names by their second word, only those with an even smallest key
GAZ = """names AS (SELECT p_name AS job, min(p_partkey) AS first_key FROM part GROUP BY p_name),
listed AS (SELECT split_part(job, ' ', 2) AS category, job FROM names WHERE first_key % 2 = 0),
gaz AS (SELECT category, job, dense_rank() OVER (ORDER BY category) - 1 AS cat_ord,
               row_number() OVER (PARTITION BY category ORDER BY job) - 1 AS job_ord FROM listed),
jobcat AS (SELECT job AS gjob, category AS gcat FROM gaz QUALIFY row_number() OVER (PARTITION BY job ORDER BY cat_ord) = 1)"""

# US federal holidays with observed days, built day by day
HOLIDAYS = """years AS (SELECT CAST(range AS INTEGER) AS y FROM range(1980, 2031)),
fixed AS (SELECT make_date(y, m, d) AS h FROM years, (VALUES (1,1,1870),(6,19,2021),(7,4,1870),(11,11,1978),(12,25,1870)) v(m,d,since) WHERE y >= since),
shifted AS (SELECT h FROM fixed UNION SELECT h - 1 FROM fixed WHERE isodow(h) = 6 UNION SELECT h + 1 FROM fixed WHERE isodow(h) = 7),
cal AS (SELECT CAST(range AS DATE) AS d FROM range(DATE '1980-01-01', DATE '2031-01-01', INTERVAL 1 DAY)),
ranked AS (SELECT d, month(d) AS m, isodow(d) AS wd, year(d) AS y,
                  row_number() OVER (PARTITION BY year(d), month(d), isodow(d) ORDER BY d) AS nth,
                  row_number() OVER (PARTITION BY year(d), month(d), isodow(d) ORDER BY d DESC) AS back FROM cal),
floating AS (SELECT d AS h FROM ranked WHERE (m=1 AND wd=1 AND nth=3 AND y>=1986) OR (m=2 AND wd=1 AND nth=3)
             OR (m=5 AND wd=1 AND back=1) OR (m=9 AND wd=1 AND nth=1) OR (m=10 AND wd=1 AND nth=2) OR (m=11 AND wd=4 AND nth=4)),
hol AS (SELECT h FROM shifted UNION SELECT h FROM floating)"""

AGE = "CAST(floor((trans_date - dob)/365.0) AS BIGINT)"


def _age_label(names) -> str:
    a, b, c, d = names
    return (
        f"CASE WHEN {AGE} > 0 AND {AGE} <= 25 THEN {a} WHEN {AGE} > 25 AND {AGE} <= 45 THEN {b} "
        f"WHEN {AGE} > 45 AND {AGE} <= 65 THEN {c} WHEN {AGE} > 65 THEN {d} END"
    )


AGE_NAME = _age_label(("'under 25'", "'25-45'", "'45-65'", "'65+'"))
AGE_CODE = _age_label((1, 0, 2, 3))


def _curve(source: str = "tx", keys: str = "") -> str:
    """Counts above each distinct score, per group."""
    part = f"PARTITION BY {keys.rstrip(', ')}" if keys else ""
    tail = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    return f"""c0 AS (SELECT {keys} score, count(*) AS n, sum(is_fraud) AS p FROM {source} GROUP BY {keys} score),
curve AS (SELECT *, coalesce(sum(n) OVER ({part} ORDER BY score DESC {tail}), 0) AS nu,
                 coalesce(sum(p) OVER ({part} ORDER BY score DESC {tail}), 0) AS pu FROM c0)"""


AUC = "sum(CAST(n-p AS DOUBLE)*(pu+p/2.0)) / (sum(p)*CAST(sum(n-p) AS DOUBLE))"
AP = "sum(p*CAST(pu+p AS DOUBLE)/(nu+n)) / sum(p)"
PRAUC = "sum(p*(CAST(pu+p AS DOUBLE)/(nu+n) + CASE WHEN nu = 0 THEN 1.0 ELSE CAST(pu AS DOUBLE)/nu END)/2) / sum(p)"
F1 = """coalesce(2.0*coalesce(sum(CASE WHEN score > 0.5 AND score < 1.5 THEN p END),0)
 / nullif(coalesce(sum(CASE WHEN score > 0.5 AND score < 1.5 THEN n END),0) + sum(p),0), 0.0)"""


def _top(k: str) -> str:
    return f"""r AS (SELECT trans_date, trans_num, is_fraud, row_number() OVER (PARTITION BY trans_date ORDER BY score DESC, trans_num) AS rk,
             sum(is_fraud) OVER (PARTITION BY trans_date) AS nf FROM tx),
d AS (SELECT trans_date, CAST(max(nf) AS BIGINT) AS n_fraud, CAST(coalesce(sum(CASE WHEN rk <= {k} THEN is_fraud END),0) AS BIGINT) AS n_detected
      FROM r GROUP BY trans_date)"""


def _even(x: str, digits: int) -> str:
    """Round half to even."""
    return f"round_even({x}, {digits})"


FOLDS = f"""ft AS (SELECT *, CAST(year(ts) AS INTEGER) AS fold, CASE WHEN trans_num % 2 = 0 THEN 'val' ELSE 'train' END AS dataset FROM tx),
{_curve('ft', 'fold, dataset, ')},
w AS (SELECT fold, dataset, {AUC} AS auc_roc, {AP} AS average_precision, {F1} AS f1_score FROM curve GROUP BY fold, dataset),
folds AS (SELECT fold, dataset, 'auc_roc' AS metric, auc_roc AS value FROM w UNION ALL
          SELECT fold, dataset, 'average_precision', average_precision FROM w UNION ALL SELECT fold, dataset, 'f1_score', f1_score FROM w)"""

MANIFEST = f"""span AS (SELECT min(us) AS a, max(us) AS b FROM tx),
pts AS (SELECT a, b, CAST(unnest(range(0, 1 + (b-a)//(90*{DAY}))) AS INTEGER) AS split_id FROM span),
bounds AS (SELECT split_id, a + split_id*90*{DAY} AS point_us, greatest(a + split_id*90*{DAY} - 90*{DAY}, a) AS train_start_us,
            a + split_id*90*{DAY} - {DAY} AS train_end_us, a + split_id*90*{DAY} + 31*{DAY} AS val_start_us,
            least(a + split_id*90*{DAY} + 121*{DAY}, b) AS val_end_us FROM pts),
man AS (SELECT *, CASE WHEN floor((train_end_us-train_start_us)/CAST({DAY} AS DOUBLE)) + 1 < 90 THEN 'short training'
                       WHEN floor((val_end_us-val_start_us)/CAST({DAY} AS DOUBLE)) + 1 < 90 THEN 'short validation'
                       WHEN train_start_us >= train_end_us OR val_start_us >= val_end_us THEN 'empty side' END AS reason FROM bounds)"""

# longest common subsequence row by row: one step per character of the first text
FUZZY = """un AS (SELECT DISTINCT job FROM tx WHERE job NOT IN (SELECT job FROM gaz)),
k1 AS (SELECT job, array_to_string(list_sort(string_split(job, ' ')), ' ') AS a FROM un),
k2 AS (SELECT category, cat_ord, job AS match, job_ord, array_to_string(list_sort(string_split(job, ' ')), ' ') AS b FROM gaz),
lcs(job, match, category, cat_ord, job_ord, a, b, i, prev) AS (
  SELECT job, match, category, cat_ord, job_ord, a, b, 0, [0 for j in range(0, length(b)+1)] FROM k1, k2
  UNION ALL
  SELECT job, match, category, cat_ord, job_ord, a, b, i+1,
         list_prepend(0, [list_max([CASE WHEN a[i+1] = b[k] THEN prev[k]+1 ELSE prev[k+1] END for k in range(1, j+1)]) for j in range(1, length(b)+1)])
  FROM lcs WHERE i < length(a)),
sc AS (SELECT job, match, category, 200.0*prev[length(b)+1]/(length(a)+length(b)) AS score, cat_ord, job_ord FROM lcs WHERE i = length(a)),
best AS (SELECT * FROM sc WHERE score >= 70 QUALIFY row_number() OVER (PARTITION BY job ORDER BY score DESC, cat_ord, job_ord) = 1),
fuzzy AS (SELECT un.job, coalesce(category, 'Other') AS category, match, round(CAST(score AS DOUBLE), 6) AS score FROM un LEFT JOIN best ON un.job = best.job)"""


def _quantile_rows(column: str, ps, label: str) -> str:
    return " UNION ALL ".join(
        f"SELECT CAST({p} AS DOUBLE) AS probability, round(quantile_cont(CAST({column} AS DOUBLE), {p}),6) AS quantile, '{label}' AS column_name FROM tx"
        for p in ps
    )


def _corr_rows(cols, source: str = "tx") -> str:
    return " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, round(corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)),6) AS r FROM {source}"
        for a in cols
        for b in cols
    )


def _profile_rows() -> str:
    out = []
    types = {"cc_num": "bigint", "merchant": "string", "category": "string", "gender": "string", "city_pop": "bigint", "amt": "decimal(18,2)", "is_fraud": "int"}
    for c, kind in types.items():
        stats = {"count": f"count({c})", "missing": f"count(*)-count({c})", "distinct": f"count(DISTINCT {c})"}
        if kind != "string":
            x = f"CAST({c} AS DOUBLE)"
            stats |= {"mean": f"avg({x})", "std": f"stddev_samp({x})", "min": f"min({x})", "max": f"max({x})"}
            stats |= {n: f"quantile_cont({x}, {q})" for n, q in (("q1", 0.25), ("median", 0.5), ("q3", 0.75))}
        out += [
            f"SELECT '{c}' AS column_name, '{s}' AS stat, round(CAST({e} AS DOUBLE),4) AS value, CAST(NULL AS VARCHAR) AS text FROM holed" for s, e in stats.items()
        ]
        out.append(f"SELECT '{c}', 'type', CAST(NULL AS DOUBLE), '{kind}'")
        out.append(
            f"SELECT '{c}', 'frequent_' || rank, n, v FROM (SELECT CAST({c} AS VARCHAR) AS v, CAST(count(*) AS DOUBLE) AS n, "
            f"row_number() OVER (ORDER BY count(*) DESC, CAST({c} AS VARCHAR)) AS rank FROM holed WHERE {c} IS NOT NULL GROUP BY 1 "
            f"HAVING count(*) > 0.05e0*(SELECT count(*) FROM holed)) WHERE rank <= 3"
        )
    return " UNION ALL ".join(out)


#: buckets of a quantile sketch grow by this factor
GAMMA = "(1.01e0/0.99e0)"


def _rates(dims: dict[str, str], source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{d}' AS dimension, CAST({e} AS VARCHAR) AS value, count(*) AS n, "
        f"round(count(*)/(SELECT CAST(count(*) AS DOUBLE) FROM {source}),9) AS share, round(avg(is_fraud),9) AS fraud_rate FROM {source} GROUP BY 1, 2"
        for d, e in dims.items()
    )


_HIST = "h0 AS (SELECT ln(CAST(amt AS DOUBLE)+1) AS x FROM tx), hb AS (SELECT min(x) AS lo, (max(x)-min(x))/30 AS w FROM h0)"

def _half_up(x: str) -> str:
    """Four digits, rounding the decimal value half up."""
    return f"CAST(round(CAST({x} AS DECIMAL(28,10)),4) AS DOUBLE)"


ALL_WINDOWS = (1, 7, 30, 90, 180)
EARLY = "ts < TIMESTAMP '1998-01-01'"


def _inputs(rows: str, known: str) -> str:
    """CTEs up to ``inputs``: every model input of the ``rows``, with codes and city bins learned from the ``known`` ones."""
    lags = ", ".join(f"lag({x}{w}) OVER o AS l{x}{w}" for w in ALL_WINDOWS for x in "scm")
    rolls = ", ".join(
        f"{_card(w, 'sum(cents)')} AS s{w}, {_card(w, 'count(cents)')} AS c{w}, "
        f"{_card(w, 'sum(CAST(round(distance*1048576) AS BIGINT))')} AS m{w}, {_risk(w)}"
        for w in ALL_WINDOWS
    )
    windows = []
    for w in ALL_WINDOWS:
        money, miles = f"coalesce(CAST(ls{w} AS DOUBLE)/100/lc{w}, ca)", f"coalesce(CAST(lm{w} AS DOUBLE)/1048576/lc{w}, cd)"
        windows.append(
            f"round(coalesce(CAST(ls{w} AS DOUBLE)/100, 0),6) AS sum_amount_{w}_days, CAST(coalesce(lc{w}, 0) AS BIGINT) AS count_amount_{w}_days, "
            f"round({money},6) AS avg_amount_{w}_days, round(CAST(amt AS DOUBLE)/{money},6) AS amount_over_average_{w}_days, "
            f"{_half_up(miles)} AS avg_distance_{w}_days, CASE WHEN distance = 0 AND {miles} = 0 THEN 0.0 WHEN {miles} = 0 THEN CAST('inf' AS DOUBLE) "
            f"ELSE {_half_up(f'distance/{miles}')} END AS distance_over_avg_{w}_days, "
            f"round(coalesce((us-prev_us)/1e6, mean_gap),4) AS inter_transaction_time_{w}_days, "
            f"merchant_num_trans_{w}_day_window, merchant_risk_{w}_day_window"
        )
    return f"""jc AS (SELECT geo.*, coalesce(gcat, 'Other') AS job_category FROM geo LEFT JOIN jobcat ON job = gjob),
src AS MATERIALIZED (SELECT * FROM jc WHERE {rows}), known AS MATERIALIZED (SELECT * FROM jc WHERE {known}),
jcodes AS (SELECT job_category AS jv, row_number() OVER (ORDER BY job_category) - 1 AS jcode FROM (SELECT DISTINCT job_category FROM known)),
ccodes AS (SELECT category AS cv, row_number() OVER (ORDER BY category) - 1 AS ccode FROM (SELECT DISTINCT category FROM known)),
cuts AS (SELECT quantile_cont(city_pop, 0.85) AS qa, quantile_cont(city_pop, 0.99) AS qb FROM known),
nd AS (SELECT CAST(count(DISTINCT trans_date) AS DOUBLE) AS nd FROM src),
means AS (SELECT city AS mcity, CAST(sum(cents) AS DOUBLE)/count(*)/100 AS ca, avg(distance) AS cd FROM src GROUP BY city),
roll AS (SELECT *, {rolls}, count(*) OVER (PARTITION BY cc_num) AS card_n, CAST(sum(cents) OVER (PARTITION BY cc_num) AS DOUBLE) AS card_s,
 count(*) OVER (PARTITION BY merchant) AS mer_n, CAST(sum(cents) OVER (PARTITION BY merchant) AS DOUBLE) AS mer_s,
 count(*) OVER (PARTITION BY cc_num, trans_date) AS day_n FROM src),
lagged AS MATERIALIZED (SELECT *, {lags}, lag(us) OVER o AS prev_us FROM roll WINDOW o AS (PARTITION BY cc_num ORDER BY us)),
gaps AS (SELECT CAST(sum(us - prev_us) AS DOUBLE)/count(prev_us)/1e6 AS mean_gap FROM lagged),
inputs AS (SELECT trans_num, city_pop, round(lat,6) AS lat, round(long,6) AS long, round(merch_lat,6) AS merch_lat, round(merch_long,6) AS merch_long,
CAST(amt AS DOUBLE) AS amt, {_half_up('distance')} AS distance, CASE WHEN gender = 'M' THEN 1 ELSE 0 END AS gender_M,
coalesce(CAST(jcode AS DOUBLE), -1.0) AS job_encoded, coalesce(CAST(ccode AS DOUBLE), -1.0) AS category_encoded,
CAST({AGE} AS BIGINT) AS age, CAST(coalesce({AGE_CODE}, 0) AS INTEGER) AS age_group, CASE WHEN city_pop <= qa THEN 0 WHEN city_pop <= qb THEN 1 ELSE 2 END AS city_size,
CAST(hour(ts) AS INTEGER) AS transaction_hour, CAST(isodow(ts)-1 AS INTEGER) AS transaction_day_of_week, CASE WHEN isodow(ts) >= 6 THEN 1 ELSE 0 END AS is_weekend,
CASE WHEN hour(ts) >= 22 THEN 2 WHEN hour(ts) <= 3 THEN 1 ELSE 0 END AS is_high_risk_hour, CASE WHEN trans_date IN (SELECT h FROM hol) THEN 1 ELSE 0 END AS is_holiday,
CAST(day_n AS BIGINT) AS daily_trans_count, round(nd/card_n,6) AS card_count_sparsity, round(nd*100/card_s,6) AS card_amount_sparsity,
round(nd/mer_n,6) AS merchant_count_sparsity, round(nd*100/mer_s,6) AS merchant_amount_sparsity, {', '.join(windows)}
FROM lagged JOIN means ON city = mcity LEFT JOIN jcodes ON job_category = jv LEFT JOIN ccodes ON category = cv, cuts, nd, gaps)"""


ORACLE = {
    "load_summary": f"WITH {TX} SELECT count(*) AS n_transactions, CAST(sum(is_fraud) AS BIGINT) AS n_fraud FROM tx",
    "label_split_counts": f"WITH {TX} SELECT is_fraud, count(*) AS n FROM tx GROUP BY is_fraud",
    "filter_points": f"WITH {TX} SELECT trans_num, merchant, merch_lat, merch_long, city, state FROM tx WHERE city = 'C7' AND is_fraud = 1",
    "drop_null_subset": f"WITH {TX} SELECT trans_num, CAST(amt AS DOUBLE) AS amt, is_fraud FROM tx WHERE trans_num % 13 <> 0 AND trans_num % 17 <> 0",
    "fill_with_zero": f"""WITH {TX} SELECT trans_num, CASE WHEN trans_num % 13 = 0 THEN 0 ELSE city_pop END AS city_pop,
CASE WHEN trans_num % 17 <> 0 THEN merchant END AS merchant FROM tx""",
    "fill_with_group_mean": f"""WITH {TX}, h AS (SELECT trans_num, city, CASE WHEN trans_num % 13 <> 0 THEN CAST(amt AS DOUBLE) END AS amt FROM tx)
SELECT trans_num, city, round(coalesce(amt, avg(amt) OVER (PARTITION BY city)),6) AS amt FROM h""",
    "fill_with_mean": f"""WITH {TX}, h AS (SELECT trans_num, CASE WHEN trans_num % 13 <> 0 THEN CAST(amt AS DOUBLE) END AS amt FROM tx)
SELECT trans_num, round(coalesce(amt, (SELECT avg(amt) FROM h)),6) AS amt FROM h""",
    "preview": f"WITH {TX} SELECT trans_num, cc_num, merchant, CAST(amt AS DOUBLE) AS amt FROM tx ORDER BY trans_num LIMIT 5",
    "card_id_clean": f"WITH {TX} SELECT trans_num, CAST(cc_num AS VARCHAR) AS card_id FROM tx",
    "time_slice": f"WITH {TX} SELECT trans_num, cc_num, us FROM tx WHERE ts BETWEEN TIMESTAMP '1996-01-01 12:00:00' AND TIMESTAMP '1996-06-30 12:00:00'",
    "event_time_slice": """SELECT event_id AS trans_num, user_id AS cc_num, epoch_us(ts) AS us FROM events
WHERE ts BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-12 12:00:00'""",
    "threshold_class": f"WITH {TX} SELECT trans_num, CAST(score > 0.5 AS INTEGER) AS predicted, CAST(score > 0.25 AS INTEGER) AS predicted_strict FROM tx",
    "merchant_delayed_risk": f"WITH {TX} SELECT trans_num, {', '.join(_risk(w) for w in (1, 7, 30))} FROM tx",
    "event_type_delayed_risk": f"""WITH tx AS (SELECT event_id AS trans_num, event_type AS merchant, epoch_us(ts) AS us,
CASE WHEN (event_id % 100003)*7919 % 1000 < 20 THEN 1 ELSE 0 END AS is_fraud FROM events) SELECT trans_num, {', '.join(_risk(w, 2) for w in (1, 7))} FROM tx""",
    "card_rolling_amount": f"WITH {TX}, {GEO}, {_card_cte()} SELECT trans_num, "
    + ", ".join(
        f"round(CAST(ls{w} AS DOUBLE)/100,6) AS sum_amount_{w}_days, CAST(lc{w} AS BIGINT) AS count_amount_{w}_days, "
        f"round(coalesce(CAST(ls{w} AS DOUBLE)/100/lc{w}, ca),6) AS avg_amount_{w}_days, "
        f"round(CAST(amt AS DOUBLE)/coalesce(CAST(ls{w} AS DOUBLE)/100/lc{w}, ca),6) AS amount_over_average_{w}_days"
        for w in WINDOWS
    )
    + " FROM card",
    "card_rolling_distance": f"WITH {TX}, {GEO}, {_card_cte()} SELECT trans_num, "
    + ", ".join(
        f"{_half_up(f'coalesce(CAST(lm{w} AS DOUBLE)/1048576/lc{w}, cd)')} AS avg_distance_{w}_days, "
        f"CASE WHEN distance <> 0 AND coalesce(CAST(lm{w} AS DOUBLE)/1048576/lc{w}, cd) = 0 THEN CAST('inf' AS DOUBLE) WHEN distance <> 0 OR coalesce(CAST(lm{w} AS DOUBLE)/1048576/lc{w}, cd) <> 0 "
        f"THEN {_half_up(f'distance/coalesce(CAST(lm{w} AS DOUBLE)/1048576/lc{w}, cd)')} END AS distance_over_avg_{w}_days"
        for w in WINDOWS
    )
    + " FROM card",
    "card_gap": f"""WITH {TX} SELECT trans_num, round(coalesce(gap, avg(gap) OVER ()),4) AS inter_transaction_time_7_days
FROM (SELECT trans_num, (us - lag(us) OVER (PARTITION BY cc_num ORDER BY us))/1e6 AS gap FROM tx)""",
    "carried_windows": f"WITH {TX}, {GEO}, {_card_cte()}, risks AS (SELECT trans_num AS id, {_risk(7)}, {_risk(30)} FROM tx) SELECT trans_num, "
    "CAST(count(*) OVER (PARTITION BY cc_num, trans_date) AS BIGINT) AS daily_trans_count, "
    + ", ".join(f"round(CAST(ls{w} AS DOUBLE)/100,6) AS sum_amount_{w}_days, CAST(lc{w} AS BIGINT) AS count_amount_{w}_days" for w in (7, 30))
    + ", risks.* EXCLUDE (id) FROM card JOIN risks ON trans_num = id WHERE year(ts) >= 1999",
    "known_risk_enrich": f"""WITH {TX}, r AS (SELECT trans_num, us, merchant, {_risk(7)}, {_risk(30)} FROM tx),
e AS (SELECT merchant AS em, us + 7*{DAY} AS known, merchant_risk_7_day_window AS r7, merchant_risk_30_day_window AS r30 FROM r
      QUALIFY row_number() OVER (PARTITION BY merchant, us ORDER BY trans_num DESC) = 1)
SELECT trans_num, coalesce(r7, 0) AS merchant_risk_7_day_window, coalesce(r30, 0) AS merchant_risk_30_day_window
FROM r ASOF LEFT JOIN e ON merchant = em AND us >= known""",
    "hex_density": f"""WITH {TX}, g AS (SELECT CAST({AGE} AS DOUBLE) AS a, ln(CAST(amt AS DOUBLE)+1) AS x FROM tx),
b AS (SELECT min(a) AS la, (max(a)-min(a))/20 AS wa, min(x) AS lx, (max(x)-min(x))/11 AS wx FROM g),
p AS (SELECT *, (a-la)/wa AS u, (x-lx)/wx AS v FROM g, b),
q AS (SELECT *, pow(u-floor(u+0.5e0),2)+3*pow(v-floor(v+0.5e0),2) <= pow(u-floor(u)-0.5e0,2)+3*pow(v-floor(v)-0.5e0,2) AS f FROM p),
c AS (SELECT *, CAST(CASE WHEN f THEN 2*floor(v+0.5e0) ELSE 2*floor(v)+1 END AS INTEGER) AS r, CAST(CASE WHEN f THEN floor(u+0.5e0) ELSE floor(u) END AS INTEGER) AS k FROM q)
SELECT r AS "row", k AS "column", round(any_value(la+(k+CASE WHEN f THEN 0e0 ELSE 0.5e0 END)*wa),6) AS x_centre, round(any_value(lx+r/2e0*wx),6) AS y_centre, count(*) AS n
FROM c GROUP BY r, k""",
    "frequent_values": f"WITH {TX}, big AS (SELECT 0.001e0*count(*) AS least FROM tx), "
    + "long AS ("
    + " UNION ALL ".join(f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value FROM tx" for c in ("cc_num", "merchant", "category", "job", "city", "state"))
    + ") SELECT column_name, value, count(*) AS n FROM long WHERE value IS NOT NULL GROUP BY ALL HAVING count(*) > (SELECT least FROM big)",
    "sketched_quantiles": f"""WITH {TX}, b AS (SELECT category, CAST(ceil(round(ln(CAST(amt AS DOUBLE)/1e-9)/ln({GAMMA}),9)) AS INTEGER)+1 AS bucket, count(*) AS n FROM tx GROUP BY ALL),
c AS (SELECT *, coalesce(sum(n) OVER (PARTITION BY category ORDER BY bucket ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below, sum(n) OVER (PARTITION BY category) AS size FROM b),
s AS (SELECT *, unnest([0.25e0, 0.5e0, 0.9e0, 0.99e0]) AS probability FROM c)
SELECT category, probability, round(pow({GAMMA}, bucket-1)*1e-9*2/(1+{GAMMA}),4) AS quantile FROM s
WHERE below <= floor(probability*(size-1)) AND floor(probability*(size-1)) < below + n""",
    "sketched_cards": f"""WITH {TX}, h AS (SELECT CAST(date_trunc('month', ts) AS DATE) AS month, md5(CAST(cc_num AS VARCHAR)) AS d FROM tx),
k AS (SELECT month, ('0x' || substr(d, 1, 4))::INTEGER & 4095 AS register, max(CASE WHEN ('0x' || substr(d, 5, 12))::BIGINT = 0 THEN 49 ELSE 49 - length(bin(('0x' || substr(d, 5, 12))::BIGINT)) END) AS rank
      FROM h GROUP BY ALL),
e AS (SELECT month, CAST(count(*) AS DOUBLE) AS used, 0.7213e0/(1+1.079e0/4096)*4096*4096/(sum(pow(2e0, -rank)) + (4096-count(*))) AS raw FROM k GROUP BY month)
SELECT CAST(month AS VARCHAR) AS month, round(CASE WHEN raw <= 2.5e0*4096 AND used < 4096 THEN 4096*ln(4096/greatest(4096-used, 0.5e0)) ELSE raw END,4) AS estimate FROM e""",
    "card_daily_count": f"""WITH {TX} SELECT trans_num,
CAST(count(*) OVER (PARTITION BY cc_num, trans_date) AS BIGINT) AS daily_trans_count FROM tx""",
    "sparsity": f"""WITH {TX}, nd AS (SELECT count(DISTINCT trans_date) AS d FROM tx)
SELECT trans_num, round(CAST(d AS DOUBLE)/count(*) OVER (PARTITION BY cc_num),9) AS card_count_sparsity,
round(CAST(d AS DOUBLE)*100/CAST(sum(cents) OVER (PARTITION BY cc_num) AS DOUBLE),9) AS card_amount_sparsity,
round(CAST(d AS DOUBLE)/count(*) OVER (PARTITION BY merchant),9) AS merchant_count_sparsity,
round(CAST(d AS DOUBLE)*100/CAST(sum(cents) OVER (PARTITION BY merchant) AS DOUBLE),9) AS merchant_amount_sparsity FROM tx, nd""",
    "sparsity_means": f"""WITH {TX}, nd AS (SELECT CAST(count(DISTINCT trans_date) AS DOUBLE) AS d FROM tx),
c AS (SELECT count(*) AS n, CAST(sum(cents) AS DOUBLE)/100 AS s FROM tx GROUP BY cc_num), m AS (SELECT count(*) AS n, CAST(sum(cents) AS DOUBLE)/100 AS s FROM tx GROUP BY merchant)
SELECT round((SELECT d FROM nd)/(SELECT avg(n) FROM c),9) AS card_count_sparsity, round((SELECT d FROM nd)/(SELECT avg(n) FROM m),9) AS merchant_count_sparsity,
round((SELECT d FROM nd)/(SELECT avg(s) FROM c),9) AS card_amount_sparsity, round((SELECT d FROM nd)/(SELECT avg(s) FROM m),9) AS merchant_amount_sparsity""",
    **{
        name: f"""WITH {TX}, p AS (SELECT trans_num, lat, long, row_number() OVER (PARTITION BY lat, long ORDER BY trans_num) - 1 AS i,
count(*) OVER (PARTITION BY lat, long) AS n FROM tx {where})
SELECT trans_num, round(CASE WHEN n > 1 THEN lat + 0.001*sin(2*pi()*i/n) ELSE lat END,9) AS lat_adjusted,
round(CASE WHEN n > 1 THEN long + 0.001*cos(2*pi()*i/n) ELSE long END,9) AS long_adjusted FROM p"""
        for name, where in (("spread_points", "WHERE is_fraud = 1"), ("spread_all_points", ""))
    },
    "key_totals": f"""WITH {TX} SELECT 'cc_num' AS kind, CAST(cc_num AS VARCHAR) AS key, count(amt) AS n, round(CAST(sum(cents) AS DOUBLE)/100,2) AS total_amount FROM tx GROUP BY 1,2
UNION ALL SELECT 'merchant', merchant, count(amt), round(CAST(sum(cents) AS DOUBLE)/100,2) FROM tx GROUP BY 1,2""",
    "city_means": f"""WITH {TX}, {GEO} SELECT city, round(CAST(sum(cents) AS DOUBLE)/count(amt)/100,5) AS city_amount, round(avg(distance),5) AS city_distance FROM geo GROUP BY city""",
    "distinct_counts": f"""WITH {TX} SELECT count(DISTINCT cc_num) AS n_cc_num, count(DISTINCT merchant) AS n_merchant, count(DISTINCT category) AS n_category,
count(DISTINCT job) AS n_job, count(DISTINCT city) AS n_city FROM tx""",
    **{
        name: f"""WITH {TX}, t AS (SELECT trans_date, count(*) AS num_transactions FROM tx {where} GROUP BY trans_date),
f AS (SELECT trans_date, count(*) AS a, count(DISTINCT cc_num) AS b FROM tx {where or 'WHERE true'} AND is_fraud = 1 GROUP BY trans_date)
SELECT CAST(t.trans_date AS VARCHAR) AS trans_date, num_transactions, num_transactions/100 AS num_transactions_scaled,
coalesce(a,0) AS num_fraud_transactions, coalesce(b,0) AS num_fraud_cards FROM t LEFT JOIN f ON t.trans_date = f.trans_date"""
        for name, where in (("daily_fraud_stats", ""), ("daily_fraud_stats_card", "WHERE cc_num = 77"))
    },
    "value_counts": f"WITH {TX} SELECT job, count(*) AS n FROM tx GROUP BY job",
    "top_cities": f"WITH {TX} SELECT city, count(*) AS n FROM tx GROUP BY city ORDER BY n DESC, city LIMIT 10",
    "top_states": f"WITH {TX} SELECT state, count(*) AS n, count(*)/10 AS n_scaled FROM tx GROUP BY state ORDER BY n DESC, state LIMIT 10",
    "rates_by_dimension": f"WITH {TX}, {GAZ}, j AS (SELECT *, coalesce(gcat, 'Other') AS job_category FROM tx LEFT JOIN jobcat ON job = gjob) "
    + _rates(
        {"day_of_week": "isodow(ts)-1", "hour": "hour(ts)", "gender": "gender", "job_category": "job_category", "category": "category"},
        "j",
    ),
    "rate_by_age_group": f"""WITH {TX}, g AS (SELECT {AGE_NAME} AS age_group, is_fraud FROM tx)
SELECT age_group, count(*) AS n, round(count(*)/(SELECT CAST(count(*) AS DOUBLE) FROM g),9) AS share, round(avg(is_fraud),9) AS fraud_rate FROM g GROUP BY age_group""",
    "first_fraud": f"""WITH {TX}, f AS (SELECT cc_num, min(us) AS first_us FROM tx WHERE is_fraud = 1 GROUP BY cc_num)
SELECT trans_num, first_us AS first_fraud_us FROM tx LEFT JOIN f ON tx.cc_num = f.cc_num""",
    "active_after_fraud": f"""WITH {TX}, f AS (SELECT cc_num, min(us) AS first_us FROM tx WHERE is_fraud = 1 GROUP BY cc_num),
a AS (SELECT DISTINCT tx.cc_num FROM tx JOIN f ON tx.cc_num = f.cc_num WHERE is_fraud = 0 AND us > first_us + 3*{DAY})
SELECT (SELECT count(DISTINCT cc_num) FROM tx) AS n_cards, (SELECT count(*) FROM a) AS n_active,
round(CAST((SELECT count(*) FROM a) AS DOUBLE)/(SELECT count(DISTINCT cc_num) FROM tx),9) AS active_share""",
    "class_means": f"""WITH {TX}, {GEO} SELECT is_fraud, round(avg(CAST(amt AS DOUBLE)),4) AS mean_amount, round(avg(distance),4) AS mean_distance, round(avg(score),4) AS mean_score FROM geo GROUP BY is_fraud""",
    "city_size": f"""WITH {TX}, q AS (SELECT quantile_cont(city_pop, 0.85) AS a, quantile_cont(city_pop, 0.99) AS b FROM tx)
SELECT trans_num, city_pop, CASE WHEN city_pop > 0 AND city_pop <= a THEN 0 WHEN city_pop > a AND city_pop <= b THEN 1 WHEN city_pop > b THEN 2 END AS city_size,
CASE WHEN city_pop > 0 AND city_pop <= 88735 THEN 0 WHEN city_pop > 88735 AND city_pop <= 1577385 THEN 1 WHEN city_pop > 1577385 THEN 2 END AS fixed_size FROM tx, q""",
    "exact_quantiles": f"WITH {TX} "
    + _quantile_rows("city_pop", (0.85, 0.99), "city_pop")
    + " UNION ALL "
    + _quantile_rows("amt", (0.25, 0.5, 0.75, 0.99), "amt"),
    "imbalance": f"""WITH {TX} SELECT count(*) FILTER (is_fraud = 0) AS negatives, count(*) FILTER (is_fraud = 1) AS positives,
round(CAST(count(*) FILTER (is_fraud = 0) AS DOUBLE)/count(*) FILTER (is_fraud = 1),6) AS imbalance_ratio FROM tx""",
    "positive_weights": f"WITH {TX} SELECT trans_num, CASE WHEN is_fraud = 1 THEN 50e0 ELSE 1e0 END AS weight FROM tx",
    "loss": f"WITH {TX} SELECT round(CAST(sum(cents) AS DOUBLE)/100,2) AS loss FROM tx WHERE is_fraud = 1 AND NOT score > 0.5",
    "corr_matrix": f"WITH {TX} " + _corr_rows(("amt", "lat", "long", "city_pop", "merch_lat", "merch_long", "is_fraud")),
    "corr_matrix_with_nulls": f"WITH {TX}, holed AS (SELECT * REPLACE (CASE WHEN trans_num % 13 <> 0 THEN amt END AS amt) FROM tx) "
    + _corr_rows(("lat", "city_pop", "is_fraud", "cc_num", "amt"), "holed"),
    "table_profile": f"WITH {TX}, holed AS (SELECT * REPLACE (CASE WHEN trans_num % 13 <> 0 THEN amt END AS amt) FROM tx) " + _profile_rows(),
    "duplicate_rows": f"WITH {TX} SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT cc_num, merchant, category FROM tx)) AS n_duplicates FROM tx",
    "histogram": f"""WITH {TX}, {_HIST} SELECT CAST(least(floor((x-lo)/w), 29) AS INTEGER) AS bin, round(min(lo + least(floor((x-lo)/w), 29)*w),6) AS bin_start, count(*) AS n
FROM h0, hb GROUP BY 1""",
    "box_stats": f"""WITH {TX}, g AS (SELECT {AGE_NAME} AS age_group, ln(CAST(amt AS DOUBLE)+1) AS x FROM tx),
q AS (SELECT age_group, quantile_cont(x,0.25) AS q1, quantile_cont(x,0.5) AS median, quantile_cont(x,0.75) AS q3 FROM g WHERE age_group IS NOT NULL GROUP BY age_group)
SELECT q.age_group, round(min(q1),6) AS q1, round(min(median),6) AS median, round(min(q3),6) AS q3,
round(min(CASE WHEN x >= q1-1.5*(q3-q1) THEN x END),6) AS low_whisker, round(max(CASE WHEN x <= q3+1.5*(q3-q1) THEN x END),6) AS high_whisker, count(*) AS n
FROM g JOIN q ON g.age_group = q.age_group GROUP BY q.age_group""",
    "density2d": f"""WITH {TX}, g AS (SELECT CAST({AGE} AS DOUBLE) AS a, ln(CAST(amt AS DOUBLE)+1) AS x FROM tx),
b AS (SELECT min(a) AS la, (max(a)-min(a))/20 AS wa, min(x) AS lx, (max(x)-min(x))/20 AS wx FROM g)
SELECT CAST(least(floor((a-la)/wa),19) AS INTEGER) AS x_bin, CAST(least(floor((x-lx)/wx),19) AS INTEGER) AS y_bin, count(*) AS n FROM g, b GROUP BY 1, 2""",
    "time_flags": f"""WITH {TX}, {HOLIDAYS} SELECT trans_num, CAST(trans_date AS VARCHAR) AS trans_date, CAST(hour(ts) AS INTEGER) AS transaction_hour,
CAST(isodow(ts)-1 AS INTEGER) AS transaction_day_of_week, CASE WHEN trans_date IN (SELECT h FROM hol) THEN 1 ELSE 0 END AS is_holiday,
CASE WHEN isodow(ts) >= 6 THEN 1 ELSE 0 END AS is_weekend, CASE WHEN hour(ts) >= 22 THEN 2 WHEN hour(ts) <= 3 THEN 1 ELSE 0 END AS is_high_risk_hour FROM tx""",
    "age_groups": f"WITH {TX} SELECT trans_num, {AGE} AS age, {AGE_CODE} AS age_group FROM tx",
    "log_scale": f"WITH {TX} SELECT trans_num, round(ln(CAST(amt AS DOUBLE)+1),6) AS scale_amt, round(ln(CAST(city_pop AS DOUBLE)+1),6) AS city_pop_scale FROM tx",
    "geodesic": f"WITH {TX}, {GEO} SELECT trans_num, round(distance,5) AS distance FROM geo",
    "months": f"WITH {TX} SELECT DISTINCT CAST(CAST(date_trunc('month', ts) AS DATE) AS VARCHAR) AS month FROM tx",
    "label_encode": f"WITH {TX} SELECT trans_num, CAST(dense_rank() OVER (ORDER BY job) - 1 AS INTEGER) AS job_label FROM tx",
    "ordinal_encode": f"""WITH {TX}, m AS (SELECT merchant AS v, dense_rank() OVER (ORDER BY merchant) - 1 AS code FROM (SELECT DISTINCT merchant FROM tx WHERE ts < TIMESTAMP '1995-02-01'))
SELECT trans_num, coalesce(CAST(code AS DOUBLE), -1.0) AS merchant_encoded FROM tx LEFT JOIN m ON merchant = v""",
    "encoder_mapping": f"WITH {TX} SELECT merchant AS value, row_number() OVER (ORDER BY merchant) - 1 AS code FROM (SELECT DISTINCT merchant FROM tx)",
    "onehot": f"""WITH {TX} SELECT trans_num, CASE WHEN gender = 'M' THEN 1 ELSE 0 END AS gender_M, CASE WHEN category = 'LARGE' THEN 1 ELSE 0 END AS category_LARGE, CASE WHEN category = 'MEDIUM' THEN 1 ELSE 0 END AS category_MEDIUM, CASE WHEN category = 'PROMO' THEN 1 ELSE 0 END AS category_PROMO, CASE WHEN category = 'SMALL' THEN 1 ELSE 0 END AS category_SMALL, CASE WHEN category = 'STANDARD' THEN 1 ELSE 0 END AS category_STANDARD FROM tx""",
    "categorize": f"WITH {TX}, {GAZ} SELECT trans_num, coalesce(gcat, 'Other') AS job_category FROM tx LEFT JOIN jobcat ON job = gjob",
    "unseen_values": f"WITH {TX}, {GAZ} SELECT DISTINCT job FROM tx WHERE job NOT IN (SELECT job FROM gaz)",
    "fuzzy_match": f"WITH RECURSIVE {TX}, {GAZ}, {FUZZY} SELECT * FROM fuzzy",
    "updated_gazetteer": f"WITH RECURSIVE {TX}, {GAZ}, {FUZZY} SELECT category, job FROM gaz UNION ALL SELECT category, job FROM fuzzy",
    "train_risk_enrich": f"""WITH {TX}, tr AS (SELECT merchant, lat, long, us, trans_num, {', '.join(_risk(w) for w in (7, 30))} FROM (SELECT * FROM tx WHERE ts < TIMESTAMP '1999-01-01')),
last AS (SELECT * FROM tr QUALIFY row_number() OVER (PARTITION BY merchant, lat, long ORDER BY us DESC, trans_num DESC) = 1)
SELECT t.trans_num, coalesce(l.merchant_risk_7_day_window, 0) AS merchant_risk_7_day_window, coalesce(l.merchant_risk_30_day_window, 0) AS merchant_risk_30_day_window
FROM (SELECT * FROM tx WHERE ts >= TIMESTAMP '1999-01-01') t LEFT JOIN last l ON t.merchant = l.merchant AND t.lat = l.lat AND t.long = l.long""",
    "feature_table": f"WITH {TX}, {GAZ}, {HOLIDAYS}, {GEO}, {_inputs('true', 'true')} SELECT * FROM inputs",
    "serving_table": f"""WITH {TX}, {GAZ}, {HOLIDAYS}, {GEO}, {_inputs(f"NOT {EARLY}", EARLY)},
tr AS (SELECT merchant, lat, long, us, trans_num, {', '.join(_risk(w) for w in ALL_WINDOWS)} FROM (SELECT * FROM tx WHERE {EARLY})),
newest AS (SELECT * FROM tr QUALIFY row_number() OVER (PARTITION BY merchant, lat, long ORDER BY us DESC, trans_num DESC) = 1)
SELECT i.* REPLACE ({', '.join(f'coalesce(n.merchant_risk_{w}_day_window, 0.0) AS merchant_risk_{w}_day_window' for w in ALL_WINDOWS)})
FROM inputs i JOIN tx ON i.trans_num = tx.trans_num LEFT JOIN newest n ON tx.merchant = n.merchant AND tx.lat = n.lat AND tx.long = n.long""",
    "split_manifest": f"WITH {TX}, {MANIFEST} SELECT * FROM man",
    "split_rows": f"""WITH {TX}, {MANIFEST}, u AS (SELECT split_id, 'train' AS role, train_start_us AS f, train_end_us AS t FROM man WHERE reason IS NULL
UNION ALL SELECT split_id, 'val', val_start_us, val_end_us FROM man WHERE reason IS NULL)
SELECT split_id, role, min(us) AS first_us, max(us) AS last_us, count(*) AS n FROM u JOIN tx ON us BETWEEN f AND t GROUP BY split_id, role""",
    "standardize": f"""WITH {TX}, s AS (SELECT avg(CAST(amt AS DOUBLE)) AS ma, stddev_pop(CAST(amt AS DOUBLE)) AS sa, avg(city_pop) AS mc, stddev_pop(city_pop) AS sc FROM tx)
SELECT trans_num, round((CAST(amt AS DOUBLE)-ma)/sa,6) AS amount, round((city_pop-mc)/sc,6) AS city_pop FROM tx, s""",
    "roc_auc": f"WITH {TX}, {_curve()} SELECT round({AUC},9) AS auc_roc FROM curve",
    "avg_precision": f"WITH {TX}, {_curve()} SELECT round({AP},9) AS average_precision FROM curve",
    "pr_auc": f"WITH {TX}, {_curve()} SELECT round({PRAUC},9) AS pr_auc FROM curve",
    "f1": f"""WITH {TX}, q AS (SELECT count(*) FILTER (score > 0.5 AND is_fraud = 1) AS tp, count(*) FILTER (score > 0.5) AS al, count(*) FILTER (is_fraud = 1) AS p FROM tx)
SELECT round(CASE WHEN tp = 0 THEN 0.0 ELSE 2*(tp/al)*(tp/p)/((tp/al)+(tp/p)) END,9) AS f1_score FROM q""",
    "precision_at_k_day": f"WITH {TX}, {_top('5')} SELECT CAST(trans_date AS VARCHAR) AS trans_date, n_fraud, n_detected, round(n_detected/5,9) AS precision FROM d",
    "precision_at_fraud_count_day": f"WITH {TX}, {_top('nf')} SELECT CAST(trans_date AS VARCHAR) AS trans_date, n_fraud, n_detected, round(CAST(n_detected AS DOUBLE)/nullif(n_fraud,0),9) AS precision FROM d",
    "detected_at_k": f"WITH {TX}, {_top('5')} SELECT CAST(trans_date AS VARCHAR) AS trans_date, trans_num FROM r WHERE rk <= 5 AND is_fraud = 1",
    "detected_at_fraud_count": f"WITH {TX}, {_top('nf')} SELECT CAST(trans_date AS VARCHAR) AS trans_date, trans_num FROM r WHERE rk <= nf AND is_fraud = 1",
    "precision_at_k_mean": f"WITH {TX}, {_top('5')} SELECT {_even('avg(n_detected/5)', 3)} AS precision_top_5 FROM d",
    "metric_table": f"""WITH {TX}, {_curve()}, {_top('5')}, r2 AS (SELECT trans_date, sum(CASE WHEN rk <= 50 THEN is_fraud END) AS n50 FROM r GROUP BY trans_date)
SELECT {_even(AUC, 3)} AS auc_roc, {_even(AP, 3)} AS average_precision, {_even(F1, 3)} AS f1_score,
(SELECT {_even('avg(n_detected/5)', 3)} FROM d) AS precision_top_5, (SELECT {_even('avg(coalesce(n50,0)/50)', 3)} FROM r2) AS precision_top_50 FROM curve""",
    "confusion": f"""WITH {TX}, grid AS (SELECT * FROM (VALUES (0,0),(0,1),(1,0),(1,1)) v(label, predicted)),
c AS (SELECT is_fraud AS l, CAST(score > 0.5 AS INTEGER) AS g, count(*) AS n FROM tx GROUP BY 1, 2)
SELECT label, predicted, coalesce(n, 0) AS n FROM grid LEFT JOIN c ON label = l AND predicted = g""",
    "naive_baseline": f"""WITH {TX} SELECT CAST(0.5 AS DOUBLE) AS auc_roc, round(avg(is_fraud),9) AS average_precision, round((avg(is_fraud)+1)/2,9) AS pr_auc, CAST(0 AS DOUBLE) AS f1_score FROM tx""",
    "fold_metrics": f"WITH {TX}, {FOLDS} SELECT fold, dataset, metric, round(value,9) AS value FROM folds",
    "fold_summary": f"""WITH {TX}, {FOLDS} SELECT metric, round(avg(value) FILTER (dataset='val'),9) AS val_mean, round(stddev_pop(value) FILTER (dataset='val'),9) AS val_std,
round(avg(value) FILTER (dataset='train'),9) AS train_mean, round(stddev_pop(value) FILTER (dataset='train'),9) AS train_std FROM folds GROUP BY metric""",
    "sweep_means": f"""WITH {TX}, th AS (SELECT * FROM (VALUES ('0.3', 0.3e0), ('0.5', 0.5e0), ('0.7', 0.7e0)) v(summary, t)),
f AS (SELECT summary, year(ts) AS y, CAST(sum(CASE WHEN score > t THEN is_fraud ELSE 0 END) AS DOUBLE) AS hit, sum(is_fraud) AS p, sum(CASE WHEN score > t THEN 1 ELSE 0 END) AS al FROM tx, th GROUP BY 1, 2),
m AS (SELECT summary, 'recall' AS metric, hit/p AS value FROM f UNION ALL SELECT summary, 'precision', hit/al FROM f)
SELECT summary, 'val' AS dataset, metric, round(avg(value),9) AS mean, round(stddev_pop(value),9) AS std FROM m GROUP BY summary, metric""",
    "ks_drift": f"""WITH {TX}, v AS (SELECT CAST(date_trunc('month', ts) AS DATE) AS m, 'amt' AS feature, CAST(amt AS DOUBLE) AS x FROM tx UNION ALL
SELECT CAST(date_trunc('month', ts) AS DATE), 'is_fraud', CAST(is_fraud AS DOUBLE) FROM tx),
sz AS (SELECT m, count(*) AS n FROM v WHERE feature = 'amt' GROUP BY m),
pairs AS (SELECT a.m AS month, CAST(k AS INTEGER) AS lag, b.m AS other, a.n AS na, b.n AS nb FROM sz a, (SELECT unnest([1,2,3]) AS k) l, sz b
          WHERE b.m = CAST(a.m - to_months(CAST(k AS INTEGER)) AS DATE)),
z AS (SELECT month, lag, feature, x, na, nb, sum(CASE WHEN m = month THEN 1 ELSE 0 END) AS ca, sum(CASE WHEN m = other THEN 1 ELSE 0 END) AS cb
      FROM pairs JOIN v ON m = month OR m = other GROUP BY ALL),
e AS (SELECT *, abs(CAST(sum(ca) OVER w AS DOUBLE)/na - CAST(sum(cb) OVER w AS DOUBLE)/nb) AS gap FROM z WINDOW w AS (PARTITION BY month, lag, feature ORDER BY x)),
k AS (SELECT month, lag, feature, max(gap) AS ks, max(gap)*sqrt(CAST(any_value(na) AS DOUBLE)*any_value(nb)/(any_value(na)+any_value(nb))) AS lam FROM e GROUP BY month, lag, feature),
pv AS (SELECT *, CASE WHEN lam < 0.04 THEN 1.0 ELSE least(1.0, greatest(0.0, 2*list_sum([CASE WHEN j % 2 = 1 THEN 1.0 ELSE -1.0 END * exp(-2.0*j*j*lam*lam) for j in range(1, 101)]))) END AS p FROM k)
SELECT CAST(month AS VARCHAR) AS month, lag, feature, round(ks,9) AS ks, round(p,9) AS p_value, p < 0.05 AS drift FROM pv""",
    "kl_drift": f"""WITH {TX}, v AS (SELECT CAST(date_trunc('month', ts) AS DATE) AS m, CAST(amt AS DOUBLE) AS x FROM tx),
b AS (SELECT min(x) AS lo, (max(x)-min(x))/20 AS w FROM v), c AS (SELECT m, CAST(least(floor((x-lo)/w),19) AS INTEGER) AS bin, count(*) AS n FROM v, b GROUP BY 1, 2),
sz AS (SELECT m, sum(n) AS s FROM c GROUP BY m),
g AS (SELECT a.m AS month, o.m AS other, a.s AS sa, o.s AS so, CAST(bin AS INTEGER) AS bin FROM sz a JOIN sz o ON o.m = CAST(a.m - INTERVAL 1 MONTH AS DATE), (SELECT unnest(range(0,20)) AS bin) r),
f AS (SELECT month, other, (coalesce(x.n,0)+1e-6)/(sa+1e-6*20) AS p, (coalesce(y.n,0)+1e-6)/(so+1e-6*20) AS q FROM g
      LEFT JOIN c x ON x.m = month AND x.bin = g.bin LEFT JOIN c y ON y.m = other AND y.bin = g.bin)
SELECT CAST(month AS VARCHAR) AS month, CAST(other AS VARCHAR) AS other, round(sum(p*ln(p/q)),8) AS kl FROM f GROUP BY month, other""",
}
