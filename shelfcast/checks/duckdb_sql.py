"""DuckDB SQL mirror of the adapter views and the cleaning / feature steps.

``CTES`` is one WITH-list; each oracle query appends its final SELECT.
DuckDB only evaluates the CTEs a query references."""

from __future__ import annotations

from ..sources.adapter import (CLUSTER_MODULUS, FAMILIES, HOLIDAY_TYPES, ID_EPOCH,
                               NATIONAL_LOCALE_NAME, PROMO_DISCOUNT, TEST_DAYS)

_FAM = "[" + ", ".join(f"'{f}'" for f in FAMILIES) + "]"
_TYPES = "[" + ", ".join(f"'{t}'" for t in HOLIDAY_TYPES) + "]"


def _id(d: str, s: str, f: str) -> str:
    return (f"CAST(CAST(({d} - DATE '{ID_EPOCH}') AS BIGINT) * 1000000000 + CAST({s} AS BIGINT) * 1000"
            f" + (list_position({_FAM}, {f}) - 1) AS BIGINT)")


def _norm(x: str) -> str:
    return f"lower(trim(regexp_replace(coalesce(CAST({x} AS VARCHAR), ''), '\\s+', ' ', 'g')))"


def _days(lo: str, hi: str) -> str:
    return f"range(CAST({lo} AS TIMESTAMP), CAST({hi} + 1 AS TIMESTAMP), INTERVAL 1 DAY)"


CTES = f"""
daily AS (
  SELECT CAST(l.l_shipdate AS DATE) AS date, CAST(s.s_nationkey AS INTEGER) AS store_nbr, p.p_type AS family,
         SUM(l.l_quantity) AS sales,
         CAST(COUNT(*) FILTER (WHERE l.l_discount >= {PROMO_DISCOUNT}) AS INTEGER) AS onpromotion
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN part p ON l.l_partkey = p.p_partkey
  GROUP BY 1, 2, 3),
cut AS (SELECT MAX(date) AS max_date, MAX(date) - {TEST_DAYS} AS cutoff FROM daily),
train_raw AS (
  SELECT {_id('d.date', 'd.store_nbr', 'd.family')} AS id, d.date, d.store_nbr, d.family,
         CAST(d.sales AS DOUBLE) AS sales, d.onpromotion
  FROM daily d, cut WHERE d.date <= cut.cutoff),
test_axes AS (
  SELECT st.store_nbr, fa.family, CAST(t.r AS DATE) AS date
  FROM (SELECT DISTINCT store_nbr FROM train_raw) st, (SELECT DISTINCT family FROM train_raw) fa, cut,
       {_days('cut.cutoff + 1', 'cut.max_date')} t(r)),
test_full AS (
  SELECT {_id('g.date', 'g.store_nbr', 'g.family')} AS id, g.date, g.store_nbr, g.family,
         CAST(COALESCE(d.onpromotion, 0) AS INTEGER) AS onpromotion, CAST(COALESCE(d.sales, 0) AS DOUBLE) AS sales
  FROM test_axes g LEFT JOIN daily d ON g.date = d.date AND g.store_nbr = d.store_nbr AND g.family = d.family),
test_raw AS (SELECT id, date, store_nbr, family, onpromotion FROM test_full),
stores_raw AS (
  SELECT CAST(n.n_nationkey AS INTEGER) AS store_nbr, n.n_name AS city, r.r_name AS state,
         chr(CAST(65 + n.n_regionkey AS INTEGER)) AS type, CAST(n.n_nationkey % {CLUSTER_MODULUS} AS INTEGER) AS cluster
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey),
oil_raw AS (
  SELECT date, CASE WHEN day(date) = 13 THEN NULL ELSE CAST(cents // (n * 100000) AS DOUBLE) END AS dcoilwtico
  FROM (SELECT CAST(o_orderdate AS DATE) AS date, SUM(CAST(round(o_totalprice * 100) AS BIGINT)) AS cents,
               COUNT(*) AS n FROM orders GROUP BY 1)
  WHERE isodow(date) <= 5),
tx_raw AS (
  SELECT CAST(l.l_shipdate AS DATE) AS date, CAST(s.s_nationkey AS INTEGER) AS store_nbr,
         CAST(COUNT(DISTINCT l.l_orderkey) AS DOUBLE) AS transactions
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey GROUP BY 1, 2),
odates AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS date FROM orders),
hol_raw AS (
  SELECT date, {_TYPES}[(month(date) - 1) % 6 + 1] AS type, 'National' AS locale,
         '{NATIONAL_LOCALE_NAME}' AS locale_name, 'N ' || CAST(month(date) AS VARCHAR) AS description,
         year(date) % 3 = 0 AS transferred
  FROM odates WHERE day(date) = 1
  UNION ALL
  SELECT date, {_TYPES}[month(date) % 6 + 1], 'Regional', r.r_name, '  R  ' || r.r_name, month(date) = 12
  FROM odates JOIN region r ON day(date) = r.r_regionkey + 1
  UNION ALL
  SELECT date, 'Holiday', 'Local', n.n_name, 'L ' || n.n_name, false
  FROM odates JOIN nation n ON day(date) = n.n_nationkey % 28 + 1 WHERE month(date) % 4 = 0),
stores_c AS (
  SELECT store_nbr, {_norm('city')} AS city, {_norm('state')} AS state, {_norm('type')} AS type, cluster
  FROM stores_raw),
hol_typed AS (
  SELECT date, {_norm('type')} AS type, {_norm('locale')} AS locale, {_norm('locale_name')} AS locale_name,
         {_norm('description')} AS description, coalesce(lower(CAST(transferred AS VARCHAR)) = 'true', false) AS transferred
  FROM hol_raw),
hol_c AS (
  SELECT *, type AS holiday_type, locale AS holiday_locale, description AS holiday_description,
         CAST(type = 'holiday' AS INTEGER) AS is_holiday, CAST(type = 'event' AS INTEGER) AS is_event,
         CAST(type = 'additional' AS INTEGER) AS is_additional, CAST(type = 'bridge' AS INTEGER) AS is_bridge,
         CAST(type = 'work day' AS INTEGER) AS is_work_day
  FROM hol_typed WHERE NOT transferred),
tb AS (SELECT MIN(date) AS lo, MAX(date) AS hi FROM train_raw),
grid AS (
  SELECT g.date, g.store_nbr, g.family, t.id, COALESCE(t.sales, 0.0) AS sales,
         CAST(COALESCE(t.onpromotion, 0) AS INTEGER) AS onpromotion,
         CAST(t.present IS NULL AS INTEGER) AS is_generated_row
  FROM (SELECT CAST(r.r AS DATE) AS date, st.store_nbr, fa.family
        FROM tb, {_days('tb.lo', 'tb.hi')} r(r), (SELECT DISTINCT store_nbr FROM train_raw) st,
             (SELECT DISTINCT family FROM train_raw) fa) g
  LEFT JOIN (SELECT *, 1 AS present FROM train_raw) t
    ON g.date = t.date AND g.store_nbr = t.store_nbr AND g.family = t.family),
span AS (
  SELECT least(a.lo, b.lo) AS min_date, greatest(a.hi, b.hi) AS max_date
  FROM tb a, (SELECT MIN(date) AS lo, MAX(date) AS hi FROM test_raw) b),
spine AS (SELECT CAST(r.r AS DATE) AS date FROM span, {_days('span.min_date', 'span.max_date')} r(r)),
oil_j AS (
  SELECT s.date, o.dcoilwtico AS p, CAST(s.date - DATE '1970-01-01' AS BIGINT) AS pos
  FROM spine s LEFT JOIN oil_raw o ON s.date = o.date),
oil_w AS (
  SELECT date, p, pos, CAST(p IS NULL AS INTEGER) AS oil_missing_original,
    last_value(p IGNORE NULLS) OVER (ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pv,
    last_value(CASE WHEN p IS NOT NULL THEN pos END IGNORE NULLS)
      OVER (ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pi,
    first_value(p IGNORE NULLS) OVER (ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS nv,
    first_value(CASE WHEN p IS NOT NULL THEN pos END IGNORE NULLS)
      OVER (ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS ni
  FROM oil_j),
oil_f AS (
  SELECT date, oil_missing_original,
    COALESCE(p, CASE WHEN pi IS NOT NULL AND ni IS NOT NULL THEN pv + (nv - pv) * (pos - pi) / (ni - pi) END, pv, nv)
      AS oil_price
  FROM oil_w),
oil_c AS (
  SELECT date, oil_price, oil_missing_original,
    COALESCE(oil_price - lag(oil_price) OVER (ORDER BY date), 0.0) AS oil_price_change_1,
    avg(oil_price) OVER (ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS oil_price_ma_7,
    avg(oil_price) OVER (ORDER BY date ROWS BETWEEN 27 PRECEDING AND CURRENT ROW) AS oil_price_ma_28
  FROM oil_f),
tx_c AS (
  SELECT s.date, st.store_nbr, COALESCE(t.transactions, 0.0) AS transactions,
         CAST(t.transactions IS NULL AS INTEGER) AS transactions_missing_original
  FROM spine s CROSS JOIN (SELECT DISTINCT store_nbr FROM stores_c) st
  LEFT JOIN tx_raw t ON t.date = s.date AND t.store_nbr = st.store_nbr),
hol_exp AS (
  SELECT h.*, s.store_nbr, s.city, s.state FROM hol_c h CROSS JOIN stores_c s WHERE h.holiday_locale = 'national'
  UNION ALL
  SELECT h.*, s.store_nbr, s.city, s.state FROM hol_c h JOIN stores_c s ON h.locale_name = s.state
  WHERE h.holiday_locale = 'regional'
  UNION ALL
  SELECT h.*, s.store_nbr, s.city, s.state FROM hol_c h JOIN stores_c s ON h.locale_name = s.city
  WHERE h.holiday_locale = 'local'),
hol_feat AS (
  SELECT date, store_nbr, CAST(COUNT(*) AS INTEGER) AS holiday_count,
    CAST(MAX(CASE WHEN holiday_locale = 'national' THEN 1 ELSE 0 END) AS INTEGER) AS is_national_holiday,
    CAST(MAX(CASE WHEN holiday_locale = 'regional' THEN 1 ELSE 0 END) AS INTEGER) AS is_regional_holiday,
    CAST(MAX(CASE WHEN holiday_locale = 'local' THEN 1 ELSE 0 END) AS INTEGER) AS is_local_holiday,
    MAX(is_holiday) AS is_holiday, MAX(is_event) AS is_event, MAX(is_additional) AS is_additional,
    MAX(is_bridge) AS is_bridge, MAX(is_work_day) AS is_work_day,
    COALESCE(string_agg(DISTINCT NULLIF(COALESCE(holiday_description, ''), ''), '|'
             ORDER BY NULLIF(COALESCE(holiday_description, ''), '')), '') AS holiday_names
  FROM hol_exp GROUP BY date, store_nbr),
base AS (
  SELECT date, store_nbr, family, id, sales, onpromotion, 'train' AS dataset_split, is_generated_row FROM grid
  UNION ALL
  SELECT date, store_nbr, family, id, CAST(NULL AS DOUBLE), onpromotion, 'test', 0 FROM test_raw),
integrated AS (
  SELECT b.date, b.store_nbr, b.family, b.id, b.sales, b.onpromotion, b.dataset_split, b.is_generated_row,
    s.city, s.state, s.type, s.cluster,
    o.oil_price, o.oil_missing_original, o.oil_price_change_1, o.oil_price_ma_7, o.oil_price_ma_28,
    COALESCE(t.transactions, 0.0) AS transactions,
    CAST(COALESCE(t.transactions_missing_original, 0) AS INTEGER) AS transactions_missing_original,
    CAST(COALESCE(h.holiday_count, 0) AS INTEGER) AS holiday_count,
    CAST(COALESCE(h.is_national_holiday, 0) AS INTEGER) AS is_national_holiday,
    CAST(COALESCE(h.is_regional_holiday, 0) AS INTEGER) AS is_regional_holiday,
    CAST(COALESCE(h.is_local_holiday, 0) AS INTEGER) AS is_local_holiday,
    CAST(COALESCE(h.is_holiday, 0) AS INTEGER) AS is_holiday,
    CAST(COALESCE(h.is_event, 0) AS INTEGER) AS is_event,
    CAST(COALESCE(h.is_additional, 0) AS INTEGER) AS is_additional,
    CAST(COALESCE(h.is_bridge, 0) AS INTEGER) AS is_bridge,
    CAST(COALESCE(h.is_work_day, 0) AS INTEGER) AS is_work_day,
    COALESCE(h.holiday_names, '') AS holiday_names,
    CAST(COALESCE(b.onpromotion, 0) > 0 AS INTEGER) AS promo_active
  FROM base b
  LEFT JOIN stores_c s ON b.store_nbr = s.store_nbr
  LEFT JOIN oil_c o ON b.date = o.date
  LEFT JOIN tx_c t ON b.date = t.date AND b.store_nbr = t.store_nbr
  LEFT JOIN hol_feat h ON b.date = h.date AND b.store_nbr = h.store_nbr),
features AS (
  SELECT id, date, dataset_split, store_nbr, family,
    CAST(store_nbr AS VARCHAR) || '_' || family AS store_family_key,
    sales, onpromotion, promo_active, transactions, transactions_missing_original,
    oil_price, oil_missing_original, oil_price_change_1, oil_price_ma_7, oil_price_ma_28,
    city, state, type, cluster, holiday_count,
    CAST(CASE WHEN holiday_names = '' THEN 0 ELSE len(string_split(holiday_names, '|')) END AS INTEGER)
      AS holiday_name_count,
    holiday_names, is_national_holiday, is_regional_holiday, is_local_holiday,
    is_holiday, is_event, is_additional, is_bridge, is_work_day,
    CAST(year(date) AS INTEGER) AS year, CAST(quarter(date) AS INTEGER) AS quarter,
    CAST(month(date) AS INTEGER) AS month, CAST(day(date) AS INTEGER) AS day,
    CAST(isodow(date) - 1 AS INTEGER) AS day_of_week, CAST(dayofyear(date) AS INTEGER) AS day_of_year,
    CAST(week(date) AS INTEGER) AS week_of_year, CAST(isodow(date) >= 6 AS INTEGER) AS is_weekend,
    CAST(day(date) = 1 AS INTEGER) AS is_month_start, CAST(date = last_day(date) AS INTEGER) AS is_month_end,
    CAST(CAST(date_trunc('quarter', date) AS DATE) = date AS INTEGER) AS is_quarter_start,
    CAST(CAST(date_trunc('quarter', date + 1) AS DATE) = date + 1 AS INTEGER) AS is_quarter_end,
    CAST(date - (SELECT min_date FROM span) AS INTEGER) AS days_since_start,
    avg(onpromotion) OVER (PARTITION BY family) AS family_mean_onpromotion,
    avg(onpromotion) OVER (PARTITION BY store_nbr) AS store_mean_onpromotion,
    avg(transactions) OVER (PARTITION BY family) AS family_mean_transactions,
    avg(transactions) OVER (PARTITION BY store_nbr) AS store_mean_transactions,
    is_generated_row
  FROM integrated),
tf AS (
  SELECT date, store_nbr, family, COALESCE(TRY_CAST(sales AS DOUBLE), 0.0) AS sales
  FROM features WHERE dataset_split = 'train')
"""


def sql(final_select: str) -> str:
    body = final_select.strip()
    if body[:4].upper() == "WITH":  # merge the query's own WITH-list into ours
        return "WITH " + CTES.strip() + ",\n" + body[4:].lstrip()
    return "WITH " + CTES.strip() + "\n" + body


def rounded(select_cols: list[str], double_cols: set[str], source: str, digits: int = 6) -> str:
    """SELECT list that rounds the double columns."""
    out = []
    for c in select_cols:
        out.append(f"round({c}, {digits}) AS {c}" if c in double_cols else c)
    return f"SELECT {', '.join(out)} FROM {source}"
