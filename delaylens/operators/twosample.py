"""Two-sample statistics (I-family) between two row subsets of one table.

Both tests start from a value histogram ``groupBy(value)`` with per-sample
counts (partial aggregation: a hot value is one row after the map side),
then use distributed running totals over the distinct values
(``functions.prefix``). The final statistic is a one-row aggregate. Nulls
are dropped (the original would return NaN on them)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delaylens.functions.prefix import running_totals
from delaylens.functions.stats import kolmogorov_sf, norm_sf


def value_histogram(df: DataFrame, value: str, in_a: Column, in_b: Column) -> DataFrame:
    """(v, a, b): per distinct non-null value, rows from sample A and B."""
    return (df.where(F.col(value).isNotNull() & (in_a | in_b))
            .groupBy(F.col(value).cast("double").alias("v"))
            .agg(F.count_if(in_a).alias("a"), F.count_if(in_b).alias("b")))


def ks_2samp(df: DataFrame, value: str, in_a: Column, in_b: Column) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov D = max |F_A(v) - F_B(v)| and the
    asymptotic two-sided p (Kolmogorov series with Stephens' correction on
    the effective size n_a*n_b/(n_a+n_b)); both null when a sample is empty."""
    h = value_histogram(df, value, in_a, in_b)
    cum = running_totals(h, "v", ["a", "b"])
    n = h.agg(F.struct(F.sum("a").alias("a"), F.sum("b").alias("b"))).scalar()
    na, nb = n.getField("a"), n.getField("b")
    d = (cum.agg(F.max(F.abs(F.try_divide("cum_a", na) - F.try_divide("cum_b", nb))).alias("ks_statistic"))
         .select(na.cast("bigint").alias("n_a"), nb.cast("bigint").alias("n_b"), "ks_statistic"))
    n1, n2 = F.col("n_a").cast("double"), F.col("n_b").cast("double")
    en = F.try_divide(n1 * n2, n1 + n2)
    lam = (F.sqrt(en) + F.lit(0.12) + F.try_divide(F.lit(0.11), F.sqrt(en))) * F.col("ks_statistic")
    return d.withColumn("ks_pvalue", F.when(lam.isNotNull(), kolmogorov_sf(lam)))


def mann_whitney_u(df: DataFrame, value: str, in_a: Column, in_b: Column, continuity: bool = True) -> DataFrame:
    """U of sample A from mid-ranks of the pooled sample, the tie term
    sum(t^3 - t), and the two-sided normal-approximation p with continuity
    correction (as for large samples); z and p are null when a sample is
    empty or all values tie."""
    h = value_histogram(df, value, in_a, in_b).withColumn("t", F.col("a") + F.col("b"))
    cum = running_totals(h, "v", ["t"], inclusive=False, prefix="before_")
    agg = cum.agg(
        F.sum(F.col("a") * (F.col("before_t") + (F.col("t") + 1) / 2.0)).alias("r_a"),
        F.sum("a").alias("n_a"), F.sum("b").alias("n_b"),
        F.sum(F.col("t").cast("double") ** 3 - F.col("t")).alias("tie_term"))
    n1, n2 = F.col("n_a").cast("double"), F.col("n_b").cast("double")
    n = n1 + n2
    u1 = F.col("r_a") - n1 * (n1 + 1) / 2.0
    out = agg.withColumn("u_statistic", u1)
    u = F.greatest(u1, n1 * n2 - u1)
    s = F.sqrt(n1 * n2 / 12.0 * ((n + 1) - F.try_divide(F.col("tie_term"), n * (n - 1))))
    z = F.try_divide(u - n1 * n2 / 2.0 - (0.5 if continuity else 0.0), s)
    p = F.when(z.isNotNull(), F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.lit(2.0) * norm_sf(z))))
    return out.select(F.col("n_a").cast("bigint").alias("n_a"), F.col("n_b").cast("bigint").alias("n_b"),
                      "u_statistic", "tie_term", z.alias("z"), p.alias("mw_pvalue"))


def cohens_d(df: DataFrame, value: str, in_a: Column, in_b: Column) -> DataFrame:
    """(mean_a - mean_b) / pooled std. As in the original, the sizes
    are row counts (nulls included) while mean and std skip nulls."""
    x = F.col(value)
    g = df.where(in_a | in_b).agg(
        F.count_if(in_a).alias("n_a"), F.count_if(in_b).alias("n_b"),
        F.avg(F.when(in_a, x)).alias("mean_a"), F.avg(F.when(in_b, x)).alias("mean_b"),
        F.var_samp(F.when(in_a, x)).alias("var_a"), F.var_samp(F.when(in_b, x)).alias("var_b"))
    pooled = F.sqrt(((F.col("n_a") - 1) * F.col("var_a") + (F.col("n_b") - 1) * F.col("var_b"))
                    / (F.col("n_a") + F.col("n_b") - 2))
    return g.withColumn("cohens_d", F.try_divide(F.col("mean_a") - F.col("mean_b"), pooled))


def exclusion_advice(ks: DataFrame, d: DataFrame, p_strong: float = 0.001, d_strong: float = 0.2,
                     p_moderate: float = 0.05) -> DataFrame:
    """I4: strong (p < 0.001 and |d| > 0.2) -> exclude the gap years;
    moderate (p < 0.05) or weak -> keep them. Inputs are one-row results."""
    p = ks.select("ks_pvalue").scalar()
    dd = d.select("cohens_d").scalar()
    level = (F.when((p < p_strong) & (F.abs(dd) > d_strong), "strong")
             .when(p < p_moderate, "moderate").otherwise("weak"))
    return ks.select("ks_statistic", "ks_pvalue", dd.alias("cohens_d"), level.alias("evidence"),
                     (level == "strong").alias("exclude_gap_years"))
