"""F-family (series) and I-family (two-sample statistics) queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from delaylens.functions.stats import erfc_sql, kolmogorov_sf_sql
from delaylens.operators import filters as CF, lookups as E, reports as R, series as S, twosample as I
from delaylens.plans import params as P
from delaylens.plans.inputs import trips
from delaylens.plans.oracle_base import with_
from delaylens.plans.registry import q

D = "DepDelayMinutes"
GAP_START, GAP_END = f"{P.GAP_YEARS[0]}-01-01", f"{P.GAP_YEARS[-1]}-12-31"

# the gap-free daily series, densified to every day
SERIES_SQL = {
    "s0": f"SELECT DepDate AS d, avg({D}) AS y FROM trips WHERE DepDate IS NOT NULL AND (Year IS NULL OR Year NOT IN {P.EXCLUDE_YEARS}) GROUP BY DepDate",
    "s": "SELECT c.d, s0.y, CAST(c.d - (SELECT min(d) FROM s0) AS INTEGER) AS i FROM "
         "(SELECT CAST(unnest(generate_series(min(d), max(d), INTERVAL 1 DAY)) AS DATE) AS d FROM s0) c LEFT JOIN s0 ON c.d = s0.d",
    "nb": """SELECT d, y, i,
  last_value(CASE WHEN y IS NOT NULL THEN i END IGNORE NULLS) OVER (ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pi,
  last_value(y IGNORE NULLS) OVER (ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS py,
  first_value(CASE WHEN y IS NOT NULL THEN i END IGNORE NULLS) OVER (ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS ni,
  first_value(y IGNORE NULLS) OVER (ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS ny FROM s""",
    "interp": """SELECT d, y, i, CASE WHEN y IS NOT NULL THEN y WHEN pi IS NULL THEN NULL WHEN ni IS NULL THEN py
  ELSE py + (ny - py) * (i - pi) / (ni - pi) END AS y_filled FROM nb""",
}


def _series(spark, sf, key=None):
    s = R.daily_series(CF.exclude_years(trips(spark, sf, without=P.EXCLUDE_YEARS), P.EXCLUDE_YEARS), key=key)
    return E.densify_calendar(s if key is None else s.where(F.col(key).isNotNull()), key=key)


#: the same series per origin city
CITY = "OriginCity"
CITY_SQL = {k: v.replace("min(d) FROM s0)", "min(d) FROM s0 z WHERE z.OriginCity = c.OriginCity)") for k, v in SERIES_SQL.items()}
CITY_SQL["s0"] = f"SELECT OriginCity, DepDate AS d, avg({D}) AS y FROM trips WHERE DepDate IS NOT NULL AND OriginCity IS NOT NULL AND (Year IS NULL OR Year NOT IN {P.EXCLUDE_YEARS}) GROUP BY 1, 2"
CITY_SQL["s"] = """SELECT c.OriginCity, c.d, s0.y, CAST(c.d - c.lo AS INTEGER) AS i FROM
  (SELECT OriginCity, lo, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d
   FROM (SELECT OriginCity, min(d) AS lo, max(d) AS hi FROM s0 GROUP BY 1)) c LEFT JOIN s0 ON c.d = s0.d AND c.OriginCity = s0.OriginCity"""
for _k in ("nb", "interp"):
    CITY_SQL[_k] = SERIES_SQL[_k].replace("OVER (ORDER BY", "OVER (PARTITION BY OriginCity ORDER BY").replace("SELECT d,", "SELECT OriginCity, d,")


@q("interpolate_linear_by_city", with_("trips", extra=CITY_SQL) + """
SELECT OriginCity, d, y, i, y_filled, (y IS NULL AND y_filled IS NOT NULL) AS is_filled FROM interp""")
def interpolate_linear_by_city(spark, sf):
    """F1 per origin city: one window partition per series."""
    return S.interpolate_linear(_series(spark, sf, CITY), key=CITY)


@q("forward_fill_by_city", with_("trips", extra=CITY_SQL) + """
SELECT OriginCity, d, y, last_value(y IGNORE NULLS) OVER (PARTITION BY OriginCity ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS y_filled FROM s""")
def forward_fill_by_city(spark, sf):
    """F2 per origin city."""
    return S.forward_fill(_series(spark, sf, CITY), key=CITY)


@q("interpolate_linear", with_("trips", extra=SERIES_SQL) + """
SELECT d, y, i, y_filled, (y IS NULL AND y_filled IS NOT NULL) AS is_filled FROM interp""")
def interpolate_linear(spark, sf):
    """F1 over the two-year gap of the gap-free daily series."""
    return S.interpolate_linear(_series(spark, sf))


@q("forward_fill", with_("trips", extra=SERIES_SQL) + """
SELECT d, y, last_value(y IGNORE NULLS) OVER (ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS y_filled FROM s""")
def forward_fill(spark, sf):
    """F2."""
    return S.forward_fill(_series(spark, sf))


@q("gap_check", with_("trips", extra=SERIES_SQL) + f"""
SELECT '{GAP_START}' AS range_start, '{GAP_END}' AS range_end,
  CAST(count(y) FILTER (WHERE d BETWEEN DATE '{GAP_START}' AND DATE '{GAP_END}') AS BIGINT) AS values_in_range,
  count(y) FILTER (WHERE d BETWEEN DATE '{GAP_START}' AND DATE '{GAP_END}') = 0 AS is_gap,
  CASE WHEN count(y) FILTER (WHERE d BETWEEN DATE '{GAP_START}' AND DATE '{GAP_END}') = 0 THEN 'linear' ELSE 'ffill' END AS method
FROM s""")
def gap_check(spark, sf):
    """F3."""
    return S.gap_check(_series(spark, sf), GAP_START, GAP_END)


def _city_stl(spark, sf):
    filled = S.fill_gaps(_series(spark, sf, CITY), GAP_START, GAP_END, key=CITY)
    return S.stl_decompose(filled, key=CITY)


@q("stl_decompose")
def stl_decompose(spark, sf):
    """F4 (rows-only): weekly STL (period 7, seasonal smoother 365, robust) of
    the gap-filled daily series of every origin city; a group is one series."""
    return _city_stl(spark, sf)


@q("component_stats")
def component_stats(spark, sf):
    """D25 (rows-only), per origin city."""
    return S.component_stats(_city_stl(spark, sf), key=CITY)


@q("trend_slope", with_("trips", extra=SERIES_SQL) + """
SELECT regr_slope(y_filled, CAST(i AS DOUBLE)) AS slope,
  CASE WHEN regr_slope(y_filled, CAST(i AS DOUBLE)) > 0.01 THEN 'increasing'
       WHEN regr_slope(y_filled, CAST(i AS DOUBLE)) < -0.01 THEN 'decreasing' ELSE 'stable' END AS direction
FROM interp WHERE y_filled IS NOT NULL""")
def trend_slope(spark, sf):
    """F5 on the interpolated series (the analysis plan applies it to the
    STL trend)."""
    return S.trend_slope(S.interpolate_linear(_series(spark, sf)), y="y_filled")


# ---- I-family ----------------------------------------------------------------

def _comparisons():
    return [("pre_vs_gap", P.PRE_YEARS, P.GAP_YEARS), ("gap_vs_post", P.GAP_YEARS, P.POST_YEARS)]


def _hist_cte(a, b):
    return (f"SELECT CAST({D} AS DOUBLE) AS v, count(*) FILTER (WHERE Year IN {a}) AS a, "
            f"count(*) FILTER (WHERE Year IN {b}) AS b FROM trips WHERE {D} IS NOT NULL AND Year IN {a + b} GROUP BY 1")


def _ks_sql(name, a, b):
    h = _hist_cte(a, b)
    en = "(n.na * n.nb / (n.na + n.nb))"
    lam = f"((sqrt({en}) + 0.12 + 0.11 / sqrt({en})) * ks_statistic)"
    return f"""SELECT '{name}' AS comparison, n_a, n_b, ks_statistic, {kolmogorov_sf_sql(lam.replace('n.na', 'n_a').replace('n.nb', 'n_b'))} AS ks_pvalue FROM (
  SELECT CAST(n.na AS BIGINT) AS n_a, CAST(n.nb AS BIGINT) AS n_b,
    max(abs(c.ca / n.na - c.cb / n.nb)) AS ks_statistic
  FROM (SELECT v, CAST(sum(a) OVER (ORDER BY v) AS DOUBLE) AS ca, CAST(sum(b) OVER (ORDER BY v) AS DOUBLE) AS cb FROM ({h})) c,
       (SELECT CAST(sum(a) AS DOUBLE) AS na, CAST(sum(b) AS DOUBLE) AS nb FROM ({h})) n
  GROUP BY n.na, n.nb)"""


def _two(fn, spark, sf):
    df = trips(spark, sf)
    y = F.col("Year")
    parts = [fn(df, D, y.isin(*a), y.isin(*b)).select(F.lit(n).alias("comparison"), "*")
             for n, a, b in _comparisons()]
    return parts[0].unionByName(parts[1])


@q("ks_2samp", with_("trips") + " UNION ALL ".join(_ks_sql(n, a, b) for n, a, b in _comparisons()))
def ks_2samp(spark, sf):
    """Pre vs gap and gap vs post."""
    return _two(I.ks_2samp, spark, sf)


def _mw_sql(name, a, b):
    h = _hist_cte(a, b)
    n1, n2 = "CAST(n_a AS DOUBLE)", "CAST(n_b AS DOUBLE)"
    u1 = f"(r_a - {n1} * ({n1} + 1) / 2.0)"
    u = f"greatest({u1}, {n1} * {n2} - {u1})"
    s = f"sqrt({n1} * {n2} / 12.0 * (({n1} + {n2} + 1) - tie_term / (({n1} + {n2}) * ({n1} + {n2} - 1))))"
    z = f"(({u} - {n1} * {n2} / 2.0 - 0.5) / {s})"
    p = f"least(1.0, greatest(0.0, 2.0 * 0.5 * {erfc_sql(f'({z} / sqrt(2.0))')}))"
    return f"""SELECT '{name}' AS comparison, CAST(n_a AS BIGINT) AS n_a, CAST(n_b AS BIGINT) AS n_b, {u1} AS u_statistic,
  tie_term, {z} AS z, {p} AS mw_pvalue FROM (
  SELECT sum(CAST(a AS DOUBLE) * (before_t + (t + 1) / 2.0)) AS r_a, sum(a) AS n_a, sum(b) AS n_b,
    sum(pow(CAST(t AS DOUBLE), 3) - t) AS tie_term
  FROM (SELECT *, CAST(COALESCE(sum(t) OVER (ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE) AS before_t
        FROM (SELECT *, a + b AS t FROM ({h}))))"""


@q("mann_whitney_u", with_("trips") + " UNION ALL ".join(_mw_sql(n, a, b) for n, a, b in _comparisons()))
def mann_whitney_u(spark, sf):
    """I2."""
    return _two(I.mann_whitney_u, spark, sf)


def _d_sql(name, a, b):
    return f"""SELECT '{name}' AS comparison, n_a, n_b, mean_a, mean_b, var_a, var_b,
  (mean_a - mean_b) / sqrt(((n_a - 1) * var_a + (n_b - 1) * var_b) / (n_a + n_b - 2)) AS cohens_d FROM (
  SELECT CAST(count(*) FILTER (WHERE Year IN {a}) AS BIGINT) AS n_a, CAST(count(*) FILTER (WHERE Year IN {b}) AS BIGINT) AS n_b,
    avg({D}) FILTER (WHERE Year IN {a}) AS mean_a, avg({D}) FILTER (WHERE Year IN {b}) AS mean_b,
    var_samp({D}) FILTER (WHERE Year IN {a}) AS var_a, var_samp({D}) FILTER (WHERE Year IN {b}) AS var_b
  FROM trips WHERE Year IN {a + b})"""


@q("cohens_d", with_("trips") + " UNION ALL ".join(_d_sql(n, a, b) for n, a, b in _comparisons()))
def cohens_d(spark, sf):
    """I3."""
    return _two(I.cohens_d, spark, sf)


ADVICE_SQL = {"ks": _ks_sql("pre_vs_gap", P.PRE_YEARS, P.GAP_YEARS),
              "dd": _d_sql("pre_vs_gap", P.PRE_YEARS, P.GAP_YEARS),
              "adv": """SELECT ks.ks_statistic, ks.ks_pvalue, dd.cohens_d,
  CASE WHEN ks.ks_pvalue < 0.001 AND abs(dd.cohens_d) > 0.2 THEN 'strong' WHEN ks.ks_pvalue < 0.05 THEN 'moderate'
       ELSE 'weak' END AS evidence FROM ks, dd"""}


@q("exclusion_advice", with_("trips", extra=ADVICE_SQL) + "SELECT *, evidence = 'strong' AS exclude_gap_years FROM adv")
def exclusion_advice(spark, sf):
    """I4: evidence level from KS p and Cohen's d (pre vs gap)."""
    df = trips(spark, sf)
    y = F.col("Year")
    a, b = y.isin(*P.PRE_YEARS), y.isin(*P.GAP_YEARS)
    return I.exclusion_advice(I.ks_2samp(df, D, a, b), I.cohens_d(df, D, a, b))
