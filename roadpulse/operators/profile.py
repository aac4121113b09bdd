"""Data profile of feature rows tagged with a period."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import CONTEXT_FLAGS, FEATURE_COLUMNS, MODEL_FEATURES
from .joins import join_groups
from .quantiles import exact_percentiles
from .serving import union_all

NUMERIC = ["temperature_f", "humidity", "wind_speed_mph", "visibility_mi", "lat", "lon"]
BOX = NUMERIC[:4]
CORRELATED = ["true_severity", *MODEL_FEATURES]
TAGS = ["period", "source_schema"]


#: Sums of squares below this share of the squared size are rounding.
ROUNDING = 1e-14


def concat_periods(frames: dict[str, DataFrame], source_schema: dict[str, str]) -> DataFrame:
    """Feature rows of several periods in one frame, tagged with period and origin."""
    return union_all(
        [
            df.select(*FEATURE_COLUMNS).withColumns({"period": F.lit(name), "source_schema": F.lit(source_schema[name])})
            for name, df in frames.items()
        ]
    )


def period_overview(df: DataFrame) -> DataFrame:
    """Rows, columns, first and last year and origins of each period."""
    return df.groupBy("period").agg(
        F.count("event_id").alias("rows"), F.lit(len(df.columns)).alias("columns"),
        F.min("event_year").alias("min_year"), F.max("event_year").alias("max_year"),
        F.array_join(F.sort_array(F.collect_set("source_schema")), ", ").alias("source_schema"),
    )


def schema_report(df: DataFrame, periods: list[str], wanted: list[str] | None = None) -> DataFrame:
    """Presence, type and number of known values of each wanted column, per period."""
    types = dict(df.dtypes)
    names = sorted({*(wanted or FEATURE_COLUMNS), *TAGS})
    known = df.where(F.col("period").isin(periods)).groupBy("period").agg(*[F.count(c).alias(f"{c}__n") for c in names if c in types])
    asked = df.sparkSession.createDataFrame([(p,) for p in periods], "period string").join(known, "period", "left")
    arms = ", ".join(
        f"'{c}', {str(c in types).lower()}, '{types.get(c, 'missing')}', coalesce({f'`{c}__n`' if c in types else '0L'}, 0L)" for c in names)
    return asked.select("period", F.expr(f"stack({len(names)}, {arms}) as (column, present, dtype, known)"))


def year_counts(df: DataFrame) -> DataFrame:
    """Rows by period and year."""
    return df.groupBy("period", "event_year").agg(F.count("*").alias("accident_count"))


def severity_counts(df: DataFrame) -> DataFrame:
    """Rows and share of each severity inside its period."""
    counts = df.where("true_severity is not null").groupBy("period", "true_severity").agg(F.count("*").alias("count"))
    total = F.sum("count").over(Window.partitionBy("period"))
    return counts.withColumn("share", F.col("count") / total)


def severity_share(df: DataFrame, periods: list[str] | None = None) -> DataFrame:
    """Severity counts and shares with one pair of columns per period, 0 where a class is absent."""
    counts = severity_counts(df).groupBy("true_severity")
    pivot = counts.pivot("period", periods) if periods else counts.pivot("period")
    return pivot.agg(F.first("count").alias("count"), F.first("share").alias("share")).fillna(0)


def drift(df: DataFrame, before: str, after: str) -> DataFrame:
    """Share of each severity in two periods and its change."""
    counts = severity_counts(df)
    side = lambda name, alias: counts.where(F.col("period") == name).select(
        "true_severity", F.col("share").alias(alias)
    )
    both = side(before, "share_before").join(side(after, "share_after"), "true_severity", "full").fillna(0.0)
    return both.withColumn("share_change", F.col("share_after") - F.col("share_before"))


def imbalance(df: DataFrame) -> DataFrame:
    """Largest and smallest class of each period and their ratio; the lower class wins a tie."""
    counts = severity_counts(df)
    size = F.struct("count", (-F.col("true_severity")).alias("c"))
    out = counts.groupBy("period").agg(
        F.max_by("true_severity", size).alias("majority_class"), F.max("count").alias("majority_count"),
        F.min_by("true_severity", F.struct("count", "true_severity")).alias("minority_class"),
        F.min("count").alias("minority_count"),
    )
    return out.withColumn("majority_to_minority_ratio", F.round(F.col("majority_count") / F.col("minority_count"), 2))


def _stack(names: list[str], fields: dict[str, str]) -> Column:
    """Rows per feature out of columns named ``<feature>__<field>``."""
    arms = ", ".join("'" + n + "', " + ", ".join(f"`{n}__{f}`" for f in fields) for n in names)
    return F.expr(f"stack({len(names)}, {arms}) as (feature, {', '.join(fields.values())})")


def missing_report(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Missing values and their share, per column and period. NaN counts as missing."""
    names = columns or FEATURE_COLUMNS
    types = dict(df.dtypes)
    gap = lambda c: F.col(c).isNull() | F.isnan(c) if types[c] in ("double", "float") else F.col(c).isNull()
    wide = df.groupBy("period").agg(F.count("*").alias("_n"), *[F.count_if(gap(c)).alias(f"{c}__m") for c in names])
    long = wide.select("period", "_n", _stack(names, {"m": "missing_count"}))
    return long.select("period", "feature", "missing_count", (F.col("missing_count") / F.col("_n")).alias("missing_share"))


def _long(df: DataFrame, names: list[str]) -> DataFrame:
    arms = ", ".join(f"'{n}', cast(`{n}` as double)" for n in names)
    return df.select("period", F.expr(f"stack({len(names)}, {arms}) as (feature, value)"))


def numeric_summary(df: DataFrame, names: list[str] | None = None) -> DataFrame:
    """Count, mean, sample deviation, minimum, median and maximum per feature and period, to three places.

    The moments of all features come from one pass; only the median needs rows per feature.
    """
    names = names or NUMERIC
    fields = {"count": "count", "mean": "mean", "std": "std", "min": "min", "max": "max"}
    how = {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    wide = df.groupBy("period").agg(*[fn(n).alias(f"{n}__{f}") for n in names for f, fn in how.items()])
    moments = wide.select("period", _stack(names, fields))
    medians = exact_percentiles(_long(df, names), "value", {"median": 0.5}, by=["period", "feature"])
    out = join_groups(moments, medians, ["period", "feature"], "left")
    return out.withColumns({c: F.round(c, 3) for c in ("mean", "std", "min", "median", "max")})


def box_stats(df: DataFrame, names: list[str] | None = None) -> DataFrame:
    """Five-number summary per feature and period."""
    marks = {"min": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "max": 1.0}
    return exact_percentiles(_long(df, names or BOX), "value", marks, by=["period", "feature"])


def histogram(df: DataFrame, column: str, bins: int = 40) -> DataFrame:
    """Rows of equal-width bins between minimum and maximum, per period; empty bins are left out."""
    value = F.col(column).cast("double")
    rows = df.select("period", value.alias("v")).where("v is not null and not isnan(v)")
    ends = rows.groupBy("period").agg(F.min("v").alias("low"), F.max("v").alias("high"))
    joined = join_groups(rows, ends, ["period"])
    width = (F.col("high") - F.col("low")) / bins
    raw = F.floor((F.col("v") - F.col("low")) / width)
    index = F.when(width > 0, F.least(F.lit(bins - 1), raw)).otherwise(F.lit(0)).cast("int")
    counts = joined.groupBy("period", index.alias("bin_idx"), "low", "high").agg(F.count("*").alias("count"))
    step = (F.col("high") - F.col("low")) / bins
    return counts.select(
        "period", "bin_idx", (F.col("low") + F.col("bin_idx") * step).alias("bin_start"),
        (F.col("low") + (F.col("bin_idx") + 1) * step).alias("bin_end"), "count",
    )


def severity_stats(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows, mean severity and rate of severity 3 or more, by any keys, to four places; unknown severity is not severe."""
    severe = F.avg(F.coalesce((F.col("true_severity") >= 3).cast("double"), F.lit(0.0)))
    return df.groupBy(*keys).agg(
        F.count("event_id").alias("accident_count"), F.round(F.avg("true_severity"), 4).alias("avg_severity"),
        F.round(severe, 4).alias("severe_rate"),
    )


def flag_stats(df: DataFrame, flags: list[str] | None = None) -> DataFrame:
    """The same for each value of each context flag, in long form.

    Rows are first counted per combination of all flags, so the long form is built from at most a few
    hundred rows per period.
    """
    flags = flags or CONTEXT_FLAGS
    combined = df.groupBy("period", *flags).agg(
        F.count("event_id").alias("n"), F.count("true_severity").alias("known"),
        F.sum("true_severity").alias("total"), F.count_if(F.col("true_severity") >= 3).alias("severe"),
    )
    arms = ", ".join(f"'{f}', `{f}`" for f in flags)
    long = combined.select("period", "n", "known", "total", "severe", F.expr(f"stack({len(flags)}, {arms}) as (feature, value)"))
    sums = long.where("value is not null").groupBy("period", "feature", "value").agg(
        *[F.sum(c).alias(c) for c in ("n", "known", "total", "severe")]
    )
    return sums.select(
        "period", "feature", F.col("value").cast("int").alias("value"), F.col("n").alias("accident_count"),
        F.round(F.col("total") / F.col("known"), 4).alias("avg_severity"),
        F.round(F.col("severe") / F.col("n"), 4).alias("severe_rate"),
    )


def corr_matrix(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Pearson correlations of all column pairs per period, in long form with both orders and the diagonal.

    A pair uses the rows that have both values. One pass: each Arrow batch gives the counts, means and
    centred sums of every pair by matrix products with the mask of present values, as one row per
    period; Spark adds them up. A column that does not vary next to its own size gives null.
    """
    names = columns or CORRELATED
    d = len(names)
    sums = ["n", "mi", "mj", "vi", "vj", "c"]

    def partial(batches):
        import numpy as np
        import pandas as pd

        for batch in batches:
            out = []
            for period, rows in batch.groupby("period", sort=False, dropna=False):
                x = rows[names].to_numpy(dtype="float64")
                here = ~np.isnan(x)
                m = here.astype(float)
                shift = np.where(here.any(axis=0), np.where(here, x, 0).sum(axis=0) / np.maximum(m.sum(axis=0), 1), 0)
                x = np.where(here, x - shift, 0)
                n = m.T @ m
                some = np.maximum(n, 1)
                mi = (x.T @ m) / some  # mean of i over the rows that have j too, from the shifted values
                mj = mi.T
                vi = (x * x).T @ m - n * mi * mi
                c = x.T @ x - n * mi * mj
                parts = n, mi + shift[:, None], mj + shift[None, :], vi, vi.T, c
                out.append((None if pd.isna(period) else period, *[p.ravel().tolist() for p in parts]))
            yield pd.DataFrame(out, columns=["period", *sums])

    wanted = df.select("period", *[F.col(c).cast("double").alias(c) for c in names])
    kinds = ", ".join(f"{s} array<double>" for s in sums)
    cells = wanted.mapInPandas(partial, f"period string, {kinds}").select(
        "period", F.posexplode(F.arrays_zip(*sums)).alias("pos", "s")).select("period", "pos", "s.*").where("n > 0")
    n, mi, mj = F.col("n"), F.col("mi"), F.col("mj")
    total = cells.groupBy("period", "pos").agg(
        F.sum(n).alias("n"), F.sum("vi").alias("vi"), F.sum("vj").alias("vj"), F.sum("c").alias("c"),
        F.sum(n * mi).alias("si"), F.sum(n * mj).alias("sj"), F.sum(n * mi * mi).alias("sii"), F.sum(n * mj * mj).alias("sjj"),
        F.sum(n * mi * mj).alias("sij"),
    )
    vi = F.col("vi") + F.col("sii") - F.col("si") * F.col("si") / n
    vj = F.col("vj") + F.col("sjj") - F.col("sj") * F.col("sj") / n
    c = F.col("c") + F.col("sij") - F.col("si") * F.col("sj") / n
    # Squares that are no more than rounding, measured by the column's own size.
    flat = (vi <= F.col("sii") * ROUNDING) | (vj <= F.col("sjj") * ROUNDING)
    name = lambda k: F.get(F.array(*[F.lit(x) for x in names]), k.cast("int"))
    return total.select(
        "period", name(F.floor(F.col("pos") / d)).alias("feature"), name(F.pmod(F.col("pos"), F.lit(d))).alias("other"),
        F.when(~flat, c / F.sqrt(vi) / F.sqrt(vj)).alias("correlation"),
    )


def label_corr(df: DataFrame, label: str = "true_severity", columns: list[str] | None = None) -> DataFrame:
    """Features by the size of their correlation with the label, ranked per period."""
    rows = corr_matrix(df, columns).where((F.col("other") == label) & (F.col("feature") != label))
    order = Window.partitionBy("period").orderBy(F.abs(F.round("correlation", 9)).desc_nulls_last(), F.col("feature"))
    return rows.select(
        "period", "feature", F.col("correlation").alias("correlation_with_label"), F.row_number().over(order).alias("rank")
    )


def quality_report(df: DataFrame) -> DataFrame:
    """Rows, columns, repeated ids, missing values, and shares of rush-hour, weekend and night rows."""
    missing = sum((F.count_if(F.col(c).isNull()) for c in df.columns), F.lit(0))
    share = lambda c: F.round(F.avg(F.col(c).cast("double")), 4).alias(f"{c}_share")
    return df.agg(
        F.count("*").alias("rows"), F.lit(len(df.columns)).alias("columns"),
        (F.count("event_id") - F.count_distinct("event_id")).alias("duplicate_ids"), missing.alias("missing_values"),
        F.round(F.avg("hour"), 2).alias("mean_hour"), share("is_rush_hour"), share("is_weekend"), share("is_night"),
    )


def value_shares(df: DataFrame, column: str) -> DataFrame:
    """Rows and share of each value of one column."""
    total = df.select(F.count("*")).scalar()
    counts = df.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("count"))
    return counts.withColumn("share", F.round(F.col("count") / total, 4))
