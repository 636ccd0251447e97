"""P3 (period impact) and P4 (delay analysis) as dicts of DataFrames, plus
the K16 insights table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from delaylens.operators import filters as CF, lookups as E, reports as R, series as S, sets as H
from delaylens.operators import topk as T, twosample as I
from delaylens.plans import params as P

D = "DepDelayMinutes"


def impact_analysis(df: DataFrame) -> dict:
    """P3 over the enriched (not yet year-filtered) table."""
    y = F.col("Year")
    pre, gap, post = y.isin(*P.PRE_YEARS), y.isin(*P.GAP_YEARS), y.isin(*P.POST_YEARS)
    ks1, ks2 = I.ks_2samp(df, D, pre, gap), I.ks_2samp(df, D, gap, post)
    d1 = I.cohens_d(df, D, pre, gap)
    advice = I.exclusion_advice(ks1, d1)
    exclude = advice.select("exclude_gap_years").scalar()
    keep = ~F.coalesce(y.isin(*P.EXCLUDE_YEARS), F.lit(False))
    recommended = df.where(keep | ~exclude)      # gap years go only on strong evidence
    periods = df.withColumn("Period", F.when(pre, "Pre").when(gap, "Gap").when(post, "Post"))
    return {
        "yearly_volume": R.yearly_volume(df), "monthly_volume": R.monthly_volume(df),
        "volume_vs_baseline": R.volume_vs_baseline(df, P.BASELINE_YEAR, P.GAP_YEARS),
        "period_delay_stats": R.period_delay_stats(df, P.PERIODS),
        "busiest_routes": T.busiest_per_group(periods, "Period", "Route", 10),
        "routes_dropped": H.keys_dropped(df, "Route", P.PRE_YEARS, P.GAP_YEARS),
        "routes_added": H.keys_added(df, "Route", P.PRE_YEARS, P.GAP_YEARS),
        "route_change_counts": H.key_change_counts(df, "Route", P.PRE_YEARS, P.GAP_YEARS),
        "month_year_pivot": R.month_year_pivot(df, list(range(1995, 2002))),
        "histogram_pre": R.histogram(CF.range_filter(df.where(pre), D, 0, 120), D, 30),
        "histogram_gap": R.histogram(CF.range_filter(df.where(gap), D, 0, 120), D, 30),
        "histogram_post": R.histogram(CF.range_filter(df.where(post), D, 0, 120), D, 30),
        "ks": ks1.select(F.lit("pre_vs_gap").alias("comparison"), "*").unionByName(
            ks2.select(F.lit("gap_vs_post").alias("comparison"), "*")),
        "mann_whitney": I.mann_whitney_u(df, D, pre, gap),
        "cohens_d": d1,
        "period_contrast": R.period_contrast(df, P.GAP_YEARS, P.NORMAL_YEARS),
        "advice": advice,
        "recommended": recommended,
    }


def delay_analysis(spark: SparkSession, df: DataFrame, min_route_flights: int = P.MIN_ROUTE_FLIGHTS,
                   min_airport_flights: int = P.MIN_AIRPORT_FLIGHTS, key: str | None = None) -> dict:
    """P4 over the cleaned table: route, hour, weekday, season, airport,
    month, quarter and year reports; daily series, gap fill, STL and its
    component stats; top-k tables and the insights table."""
    routes = R.route_stats(df, min_flights=min_route_flights)
    hourly, monthly = R.hourly_delays(df), R.monthly_delays(df)
    series = E.densify_calendar(R.daily_series(df))
    gap_start, gap_end = f"{P.GAP_YEARS[0]}-01-01", f"{P.GAP_YEARS[-1]}-12-31"
    filled = S.fill_gaps(series, gap_start, gap_end)
    decomp = S.stl_decompose(filled)
    out = {
        "route_stats": routes, "top_routes": T.top_routes(routes, 20),
        "hourly_delays": hourly, "worst_hours": T.worst_hours(hourly, 10),
        "weekday_delays": R.weekday_delays(df), "season_delays": R.season_delays(df),
        "airport_delays": R.airport_delays(df, min_flights=min_airport_flights),
        "worst_airports": T.worst_airports(R.airport_delays(df, min_flights=min_airport_flights), 10),
        "monthly_delays": monthly, "quarterly_delays": R.quarterly_delays(df), "yearly_delays": R.yearly_delays(df),
        "daily_series": series, "filled_series": filled, "stl": decomp,
        "component_stats": S.component_stats(decomp),
    }
    out["insights"] = insights(routes, hourly, monthly, decomp)
    return out


#: key columns of the tables of P4 that hold no decomposition
TABLE_KEYS = {
    "route_stats": ["Route"], "top_routes": ["Ranking", "Rank", "Route"], "hourly_delays": ["CRSDepTimeHour"],
    "worst_hours": ["CRSDepTimeHour"], "weekday_delays": ["DayOfWeek"], "season_delays": ["Season"],
    "airport_delays": ["OriginCity"], "worst_airports": ["OriginCity"], "monthly_delays": ["Month"],
    "quarterly_delays": ["Quarter"], "yearly_delays": ["Year"], "daily_series": ["d"], "filled_series": ["d"],
}


# Insight categories, finding templates and recommendations.
INSIGHT_TEXT = {
    "route": ("Route Risk", "%d routes identified as high-risk",
              "Implement proactive monitoring and contingency planning for these routes"),
    "time": ("Time Patterns", "Worst departure hours: %s",
             "Consider adjusting schedules or adding buffer time during peak delay hours"),
    "season": ("Seasonal Patterns", "Highest delays in %s (%.1f min), lowest in %s (%.1f min)",
               "Adjust operational capacity and staffing during high-risk months"),
    "trend": ("Long-term Trends", "Overall delay trend is %s (slope: %.4f)",
              "Monitor trend changes and implement interventions if delays are increasing"),
}


def insights(routes: DataFrame, hourly: DataFrame, monthly: DataFrame, decomp: DataFrame | None) -> DataFrame:
    """(category, finding, recommendation) rows from one-row results:
    high-risk route count (C6), worst 3 hours in descending order (G2),
    extreme months (G6) and the direction of the STL trend (F5)."""
    from delaylens.functions.columns import MONTH_NAMES, name_of

    def row(kind: str, finding) -> list:
        cat, _, rec = INSIGHT_TEXT[kind]
        return [F.lit(cat).alias("category"), finding.alias("finding"), F.lit(rec).alias("recommendation")]

    risk = CF.high_risk_groups(routes, "Route").agg(F.count(F.lit(1)).alias("n"))
    top3 = T.worst_hours(hourly, 3).agg(F.array_sort(F.collect_list(F.struct(
        (-F.col("Avg_Delay")).alias("k"), F.col("CRSDepTimeHour").alias("h")))).alias("hs"))
    hours = F.array_join(F.transform("hs", lambda x: F.format_string("%02d:00", x["h"])), ", ")
    ext = T.extreme_months(monthly)
    parts = [
        risk.select(*row("route", F.format_string(INSIGHT_TEXT["route"][1], "n"))),
        top3.select(*row("time", F.format_string(INSIGHT_TEXT["time"][1], hours))),
        ext.select(*row("season", F.format_string(
            INSIGHT_TEXT["season"][1], name_of("Worst_Month", MONTH_NAMES, 1), "Worst_Avg",
            name_of("Best_Month", MONTH_NAMES, 1), "Best_Avg"))),
    ]
    if decomp is not None:
        tr = S.trend_slope(S.with_position(decomp), y="trend")
        parts.append(tr.select(*row("trend", F.format_string(INSIGHT_TEXT["trend"][1], "direction", "slope"))))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
