"""Data profile of feature rows tagged with a period."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from roadpulse.operators import profile as p
from roadpulse.operators.sampling import temporal_split
from roadpulse.schemas import CONTEXT_FLAGS, FEATURE_COLUMNS

from . import views as v
from .registry import Registry

query = Registry()

TAGGED = f"""
tagged as (select *, case when event_year < {v.SPLIT_YEAR} then 'before' else 'after' end as period, 'raw' as source_schema from features)"""


def tagged(spark, sf_dir):
    """Feature rows before and after the split year, stored once like any profiled table."""

    def make():
        before, after = temporal_split(v.feature_table(spark, sf_dir), v.SPLIT_YEAR)
        return p.concat_periods({"before": before, "after": after}, {"before": "raw", "after": "raw"})

    return v.stored(spark, sf_dir, "tagged", make)


def _sql(query_text: str) -> str:
    return v.with_views(["features"], f"with {TAGGED}{query_text}")


def _r(df, *columns, digits=9):
    return df.withColumns({c: F.round(c, digits) for c in columns})


@query(
    "period_overview",
    _sql(
        f""" select period, count(*) as rows, {len(FEATURE_COLUMNS) + 2} as columns, min(event_year) as min_year, max(event_year) as max_year,
  'raw' as source_schema from tagged group by 1"""
    ),
)
def period_overview(spark, sf_dir):
    return p.period_overview(tagged(spark, sf_dir))


@query("year_counts", _sql(" select period, event_year, count(*) as accident_count from tagged group by 1, 2"))
def year_counts(spark, sf_dir):
    return p.year_counts(tagged(spark, sf_dir))


SHARES = """,
counts as (select period, true_severity as s, count(*) as n, count(*)::double / sum(count(*)) over (partition by period) as share
  from tagged group by 1, 2)"""


@query(
    "severity_share",
    _sql(
        f"""{SHARES}
select s as true_severity, coalesce(max(n) filter (where period = 'before'), 0) as before_count,
  round(coalesce(max(share) filter (where period = 'before'), 0), 9) as before_share,
  coalesce(max(n) filter (where period = 'after'), 0) as after_count,
  round(coalesce(max(share) filter (where period = 'after'), 0), 9) as after_share from counts group by 1"""
    ),
)
def severity_share(spark, sf_dir):
    out = p.severity_share(tagged(spark, sf_dir), ["before", "after"])
    return _r(out, "before_share", "after_share")


@query(
    "drift",
    _sql(
        f"""{SHARES}
select s as true_severity, round(coalesce(max(share) filter (where period = 'before'), 0), 9) as share_before,
  round(coalesce(max(share) filter (where period = 'after'), 0), 9) as share_after,
  round(coalesce(max(share) filter (where period = 'after'), 0) - coalesce(max(share) filter (where period = 'before'), 0), 9) as share_change
from counts group by 1"""
    ),
)
def drift(spark, sf_dir):
    return _r(p.drift(tagged(spark, sf_dir), "before", "after"), "share_before", "share_after", "share_change")


@query(
    "imbalance",
    _sql(
        f"""{SHARES}
select period, arg_max(s, n * 10 - s) as majority_class, max(n) as majority_count, arg_min(s, n * 10 + s) as minority_class,
  min(n) as minority_count, round(max(n)::double / min(n), 2) as majority_to_minority_ratio from counts group by 1"""
    ),
)
def imbalance(spark, sf_dir):
    return p.imbalance(tagged(spark, sf_dir))


def _holes(df):
    """Rows with holes in two columns, so that there is something to report."""
    k = F.substr(F.col("event_id"), F.lit(3)).cast("bigint")
    return df.withColumns(
        {"humidity": F.when(k % 5 != 0, F.col("humidity")), "true_severity": F.when(k % 9 != 0, F.col("true_severity"))}
    )


@query(
    "missing_report",
    _sql(
        """,
holed as (select * replace (case when k % 5 = 0 then null else humidity end as humidity,
  case when k % 9 = 0 then null else true_severity end as true_severity) from tagged)
"""
        + " union all ".join(
            f"select period, '{c}' as feature, count(*) - count({c}) as missing_count,"
            f" round((count(*) - count({c}))::double / count(*), 9) as missing_share from holed group by 1"
            for c in FEATURE_COLUMNS
        )
    ),
)
def missing_report(spark, sf_dir):
    out = p.missing_report(_holes(tagged(spark, sf_dir)), FEATURE_COLUMNS)
    return _r(out, "missing_share")


@query(
    "numeric_summary",
    _sql(
        " "
        + " union all ".join(
            f"select period, '{c}' as feature, count({c}) as count, round(avg({c}) + 1e-9, 3) as mean, round(stddev_samp({c}) + 1e-9, 3) as std,"
            f" round(min({c}), 3) as min, round(max({c}), 3) as max, round(percentile_cont(0.5) within group (order by {c}), 3) as median"
            " from tagged group by 1"
            for c in p.NUMERIC
        )
    ),
)
def numeric_summary(spark, sf_dir):
    return p.numeric_summary(tagged(spark, sf_dir))


@query(
    "box_stats",
    _sql(
        " "
        + " union all ".join(
            f"select period, '{c}' as feature, min({c}) as min, round(percentile_cont(0.25) within group (order by {c}), 6) as q1,"
            f" round(percentile_cont(0.5) within group (order by {c}), 6) as median,"
            f" round(percentile_cont(0.75) within group (order by {c}), 6) as q3, max({c}) as max from tagged group by 1"
            for c in p.BOX
        )
    ),
)
def box_stats(spark, sf_dir):
    return _r(p.box_stats(tagged(spark, sf_dir)), "q1", "median", "q3", digits=6)


def _histogram_sql(c: str) -> str:
    return f"""
select period, '{c}' as feature, bin_idx, round(low + bin_idx * (high - low) / 40, 6) as bin_start,
  round(low + (bin_idx + 1) * (high - low) / 40, 6) as bin_end, n as count
from (select period, least(39, cast(floor(({c} - low) / ((high - low) / 40)) as int)) as bin_idx, low, high, count(*) as n
  from tagged join (select period, min({c}) as low, max({c}) as high from tagged group by 1) using (period) group by 1, 2, 3, 4)"""


@query("histogram40", _sql(" union all ".join(map(_histogram_sql, p.BOX))))
def histogram40(spark, sf_dir):
    """All weather columns."""
    rows = tagged(spark, sf_dir)
    parts = [p.histogram(rows, c, 40).withColumn("feature", F.lit(c)) for c in p.BOX]
    return _r(reduce(lambda a, b: a.unionByName(b), parts), "bin_start", "bin_end", digits=6)


def _stats_sql(keys: str) -> str:
    return _sql(
        f""" select {keys}, count(*) as accident_count, round(avg(true_severity) + 1e-9, 4) as avg_severity,
  round(avg((true_severity >= 3)::int) + 1e-9, 4) as severe_rate from tagged group by all"""
    )


@query("severity_stats_hour", _stats_sql("period, hour"))
def severity_stats_hour(spark, sf_dir):
    return p.severity_stats(tagged(spark, sf_dir), ["period", "hour"])


@query("severity_stats_rush", _stats_sql("period, is_rush_hour, is_weekend"))
def severity_stats_rush(spark, sf_dir):
    return p.severity_stats(tagged(spark, sf_dir), ["period", "is_rush_hour", "is_weekend"])


@query("severity_stats_weather", _stats_sql("period, weather_code"))
def severity_stats_weather(spark, sf_dir):
    return p.severity_stats(tagged(spark, sf_dir), ["period", "weather_code"])


@query("severity_stats_road", _stats_sql("period, road_type_code"))
def severity_stats_road(spark, sf_dir):
    return p.severity_stats(tagged(spark, sf_dir), ["period", "road_type_code"])


@query(
    "flag_stats",
    _sql(
        " "
        + " union all ".join(
            f"select period, '{c}' as feature, {c} as value, count(*) as accident_count, round(avg(true_severity) + 1e-9, 4) as avg_severity,"
            f" round(avg((true_severity >= 3)::int) + 1e-9, 4) as severe_rate from tagged group by all"
            for c in CONTEXT_FLAGS
        )
    ),
)
def flag_stats(spark, sf_dir):
    return p.flag_stats(tagged(spark, sf_dir))


def _corr_cell(a: str, b: str) -> str:
    both = f"filter (where {a} is not null and {b} is not null)"
    return f'case when var_pop({a}) {both} > 0 and var_pop({b}) {both} > 0 then round(corr({a}, {b}), 6) + 0e0 end as "{a}|{b}"'


CORR_HOLES = """, gaps as (select * replace (case when k % 5 = 0 then null else humidity end as humidity,
  case when k % 9 = 0 then null else true_severity end as true_severity, humidity * 1e-7 as visibility_mi,
  case when k % 13 = 0 then null else period end as period) from tagged)"""


def _gaps(df):
    k = F.substr(F.col("event_id"), F.lit(3)).cast("bigint")
    tiny = df.withColumn("visibility_mi", F.col("humidity") * 1e-7)
    return _holes(tiny).withColumn("period", F.when(k % 13 != 0, F.col("period")))


@query(
    "corr_matrix",
    _sql(
        CORR_HOLES + ", wide as (select period, "
        + ", ".join(_corr_cell(a, b) for a in p.CORRELATED for b in p.CORRELATED)
        + """ from gaps group by 1),
long as (select * from wide unpivot include nulls (c for pair in (columns(* exclude (period)))))
select period, split_part(pair, '|', 1) as feature, split_part(pair, '|', 2) as other, c as correlation from long"""
    ),
)
def corr_matrix(spark, sf_dir):
    """With holes, a null period, and a column that is another one made tiny."""
    out = p.corr_matrix(_gaps(tagged(spark, sf_dir)))
    return out.withColumn("correlation", F.round("correlation", 6) + F.lit(0.0))


@query(
    "label_corr",
    _sql(
        ", cells as ("
        + " union all ".join(
            f"select period, '{a}' as feature, case when var_pop({a}) > 0 then corr({a}, true_severity) end as c from tagged group by 1"
            for a in p.CORRELATED[1:]
        )
        + """)
select period, feature, round(c, 6) + 0e0 as correlation_with_label,
  cast(row_number() over (partition by period order by abs(round(c, 9)) desc nulls last, feature) as int) as rank from cells"""
    ),
)
def label_corr(spark, sf_dir):
    out = p.label_corr(tagged(spark, sf_dir))
    return out.withColumn("correlation_with_label", F.round("correlation_with_label", 6) + F.lit(0.0))


SCHEMA_COLUMNS = sorted({*FEATURE_COLUMNS, *p.TAGS})


@query(
    "schema_report",
    _sql(
        " "
        + " union all ".join(
            f"select period, '{c}' as \"column\", true as present, count({c}) as known from tagged group by 1" for c in SCHEMA_COLUMNS
        )
    ),
)
def schema_report(spark, sf_dir):
    return p.schema_report(tagged(spark, sf_dir), ["before", "after"]).drop("dtype")


@query(
    "quality_report",
    v.with_views(
        ["live_features"],
        """
select count(*) as rows, 24 as columns, count(event_id) - count(distinct event_id) as duplicate_ids, 0 as missing_values,
  round(avg(hour) + 1e-9, 2) as mean_hour, round(avg(is_rush_hour) + 1e-9, 4) as is_rush_hour_share,
  round(avg(is_weekend) + 1e-9, 4) as is_weekend_share, round(avg(is_night) + 1e-9, 4) as is_night_share from live_features""",
    ),
)
def quality_report(spark, sf_dir):
    rows = v.live(spark, sf_dir).withColumn("true_severity", F.col("severity")).withColumn("event_year", F.year("event_time"))
    return p.quality_report(rows.select(*FEATURE_COLUMNS))


@query(
    "value_shares",
    _sql(
        " select true_severity as value, count(*) as count, round(count(*)::double / sum(count(*)) over (), 4) as share from tagged group by 1"
    ),
)
def value_shares(spark, sf_dir):
    return p.value_shares(tagged(spark, sf_dir), "true_severity")
