"""The catalogue's queries as ANSI SQL, for comparison on the same tables."""

from __future__ import annotations

# --- inputs ------------------------------------------------------------------

_HOUSEHOLD = """
    (props ->> 'k')::int * 0.5::double - 5.0::double AS outdoor_temperature,
    (['Winter', 'Spring', 'Summer', 'Fall'])[user_id % 4 + 1] AS season,
    (user_id % 5 + 1)::int AS household_size"""

_READINGS = f"""readings AS (
  SELECT event_id, user_id AS home_id, event_type AS appliance_type, value AS energy_consumption, ts,
    strftime(ts, '%H:%M') AS time, strftime(ts, '%Y-%m-%d') AS date, {_HOUSEHOLD}
  FROM events)"""

_PLAUSIBLE = f"""{_READINGS}, plausible AS (
  SELECT *, hour(ts)::int AS hour, month(ts)::int AS month, (dayofweek(ts) + 1)::int AS day_of_week
  FROM readings WHERE energy_consumption > 0 AND energy_consumption < 20)"""

_RAW = f"""household AS (
  SELECT *, {_HOUSEHOLD} FROM events),
raw AS (
  SELECT user_id AS home_id, nullif(event_type, 'error') AS appliance_type, value AS energy_consumption,
    CASE event_type
      WHEN 'click' THEN strftime(ts, '%H:%M')
      WHEN 'view' THEN CASE WHEN user_id % 2 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') ELSE strftime(ts, '%H:%M:%S') END
      WHEN 'purchase' THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
      WHEN 'signup' THEN ' ' || strftime(ts, '%H:%M') || ' '
      ELSE 'n/a' END AS time,
    CASE event_type
      WHEN 'purchase' THEN strftime(ts, '%d/%m/%Y')
      WHEN 'error' THEN ''
      ELSE strftime(ts, '%Y-%m-%d') END AS date,
    nullif(outdoor_temperature, -5.0) AS outdoor_temperature, season, household_size
  FROM household)"""

# NaN energies, which are missing values.
_GAPPY = f"""{_RAW}, gappy AS (
  SELECT * REPLACE (CASE WHEN home_id % 50 <> 7 THEN energy_consumption END AS energy_consumption) FROM raw)"""

_ISO = "try_strptime(date, '%Y-%m-%d')::date"
_ANY_DATE = f"coalesce({_ISO}, try_strptime(date, '%d/%m/%Y')::date)"
_CLOCK_TEXT = "CASE WHEN length(trim(time)) > 8 THEN split_part(replace(trim(time), 'T', ' '), ' ', 2) ELSE trim(time) END"
_HOUR = f"TRY_CAST(split_part({_CLOCK_TEXT}, ':', 1) AS INT)"
_TS = f"""try_strptime(strftime({_ANY_DATE}, '%Y-%m-%d') || ' ' || {_CLOCK_TEXT}
      || CASE WHEN length({_CLOCK_TEXT}) = 5 THEN ':00' ELSE '' END, '%Y-%m-%d %H:%M:%S')"""

_NO_NULL = """appliance_type IS NOT NULL AND outdoor_temperature IS NOT NULL AND home_id IS NOT NULL
    AND energy_consumption IS NOT NULL AND time IS NOT NULL AND date IS NOT NULL
    AND season IS NOT NULL AND household_size IS NOT NULL"""

_CLEAN = f"""{_RAW}, clean AS (
  SELECT *, {_HOUR} AS hour, {_ISO} AS date_parsed, month({_ISO})::int AS month,
    year({_ISO})::int AS year, (dayofweek({_ISO}) + 1)::int AS day_of_week
  FROM (SELECT DISTINCT * FROM raw WHERE {_NO_NULL})
  WHERE energy_consumption > 0 AND energy_consumption < 20)"""


def _hourly(source: str = "readings") -> str:
    return f"""hourly AS (
  SELECT home_id, date_trunc('hour', ts) AS ts, avg(energy_consumption) AS consumption,
    avg(outdoor_temperature) AS outdoor_temp, avg(household_size) AS household_size,
    count(*) AS readings
  FROM {source} GROUP BY 1, 2)"""


_HOME = "PARTITION BY home_id ORDER BY ts"


def _featured(frame: str) -> str:
    return f"""featured AS (
  SELECT home_id, ts, consumption, outdoor_temp, household_size,
    lag(consumption, 1) OVER ({_HOME}) AS lag_1,
    lag(consumption, 24) OVER ({_HOME}) AS lag_24,
    avg(consumption) OVER ({_HOME} {frame}) AS rolling_mean_24,
    stddev_samp(consumption) OVER ({_HOME} {frame}) AS rolling_std_24,
    hour(ts)::int AS hour, (dayofweek(ts) + 1)::int AS dayofweek, month(ts)::int AS month,
    CASE WHEN dayofweek(ts) IN (0, 6) THEN 1.0::double ELSE 0.0::double END AS is_weekend
  FROM hourly),
usable AS (
  SELECT * FROM featured WHERE consumption IS NOT NULL AND lag_1 IS NOT NULL
    AND lag_24 IS NOT NULL AND rolling_mean_24 IS NOT NULL)"""


_WITH_CURRENT = "ROWS BETWEEN 23 PRECEDING AND CURRENT ROW"
_PRIOR = "ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING"
_BY_TIME = "RANGE BETWEEN INTERVAL 23 HOUR PRECEDING AND CURRENT ROW"

_HOURLY = f"{_READINGS}, {_hourly()}"
_NAIVE = f"{_HOURLY}, {_featured(_PRIOR)}"


def _split(source: str) -> str:
    return f"""bounds AS (
  SELECT min(floor(epoch(ts))) AS first, max(floor(epoch(ts))) AS last FROM {source}),
split AS (
  SELECT s.*, CASE
      WHEN floor(epoch(ts)) <= floor(first + (last - first) * 0.8::double) THEN 'train'
      WHEN floor(epoch(ts)) <= floor(first + (last - first) * 0.9::double) THEN 'val'
      ELSE 'test' END AS split
  FROM {source} s CROSS JOIN bounds)"""


def _trained() -> str:
    """Rows with every feature, and their part."""
    complete = " AND ".join(
        f"{c} IS NOT NULL" for c in ("rolling_std_24", "outdoor_temp", "household_size", "hour", "month")
    )
    return f"complete AS (SELECT * FROM usable WHERE {complete}), " + _split("complete")


def _r(expression: str, name: str, places: int = 6) -> str:
    return f"round({expression}, {places}) + 0.0 AS {name}"


def _below(cut: str, key: str = "event_id") -> str:
    return f"md5('42:' || {key}::varchar) < '{cut}'"


def _rolling(frame: str) -> str:
    return f"""WITH {_HOURLY} SELECT home_id, ts, {_r('consumption', 'consumption', 8)},
  {_r(f'avg(consumption) OVER ({_HOME} {frame})', 'rolling_mean_24', 8)},
  {_r(f'stddev_samp(consumption) OVER ({_HOME} {frame})', 'rolling_std_24', 8)} FROM hourly"""


_EXACT_DAY = "RANGE BETWEEN INTERVAL {0} HOUR PRECEDING AND INTERVAL {0} HOUR PRECEDING"
_DESCRIBED = ("energy_consumption", "outdoor_temperature", "household_size")
_CORRELATED = (*_DESCRIBED, "hour", "month")
_SCALED = ("energy_consumption", "outdoor_temperature", "household_size")
_FITTED = ("lag_1", "lag_24", "rolling_mean_24", "outdoor_temp", "hour")
_RENAMED = """home_id, appliance_type, round(energy_consumption, 6) AS energy_consumption, time, date,
  round(outdoor_temperature, 6) AS outdoor_temperature, season, household_size"""


def _metrics(label: str, prediction: str) -> str:
    error = f"({label} - {prediction})"
    r2 = f"(1 - sum({error} * {error}) / nullif(var_pop({label}) * count({label}), 0))"
    base = f"CASE WHEN {label} = 0 THEN 1e-9 ELSE {label} END"
    return ", ".join(
        (
            f"count({label})::bigint AS rows",
            _r(f"sqrt(avg({error} * {error}))", "rmse"),
            _r(f"avg(abs({error}))", "mae"),
            _r(r2, "r2"),
            _r(f"{r2} * 100", "r2_pct"),
            _r(f"avg(abs({error} / ({base}))) * 100", "mape", 6),
            f"count(*) FILTER (WHERE {label} = 0)::bigint AS zero_labels",
        )
    )


_NAIVE_MODELS = """pairs AS (
  SELECT 'last_hour' AS model, *, lag_1 AS prediction FROM {0}
  UNION ALL SELECT 'last_day', *, lag_24 FROM {0}
  UNION ALL SELECT 'rolling', *, rolling_mean_24 FROM {0})"""


def _profile(dimension: str) -> str:
    return f"""SELECT '{dimension}' AS dimension, {dimension}::varchar AS value, count(*)::bigint AS count,
  {_r('avg(energy_consumption)', 'avg_consumption')}, {_r('sum(energy_consumption)', 'total_consumption')},
  {_r('avg(outdoor_temperature)', 'avg_temperature')} FROM plausible GROUP BY {dimension}"""


def _index(column: str) -> str:
    return f"""SELECT {column}, (row_number() OVER (ORDER BY count(*) DESC, {column}) - 1)::double AS rank
  FROM readings GROUP BY {column}"""


def _report(columns: str, tail: str) -> str:
    return f"WITH {_PLAUSIBLE} SELECT {columns} FROM plausible {tail}"


_MEAN = _r("avg(energy_consumption)", "avg_consumption")

ORACLES: dict[str, str] = {
    # scans, selection, cleaning
    "scan_parquet": "SELECT * FROM events",
    "preview_rows": f"""WITH {_READINGS} SELECT * REPLACE (round(energy_consumption, 6) AS energy_consumption)
  FROM readings ORDER BY ts, event_id LIMIT 50""",
    "rename_readings": f"WITH {_RAW} SELECT {_RENAMED} FROM raw",
    "project_series": f"WITH {_READINGS} SELECT home_id, ts, energy_consumption FROM readings",
    "cast_numeric": """SELECT event_id, TRY_CAST(props ->> 'k' AS double) AS level,
  TRY_CAST(strftime(ts, '%H:%M') AS double) AS clock FROM events""",
    "filter_outliers": "SELECT event_id, value FROM events WHERE value > 0 AND value < 20",
    "filter_parsed_ts": f"""WITH {_RAW} SELECT home_id, {_TS} AS ts,
  round(energy_consumption, 6) AS energy_consumption, round(outdoor_temperature, 6) AS outdoor_temperature,
  household_size::double AS household_size FROM raw WHERE {_TS} IS NOT NULL""",
    "quality_report": f"""WITH {_GAPPY} SELECT count(*)::bigint AS rows_in,
  count(*) FILTER (WHERE NOT ({_NO_NULL}))::bigint AS rows_with_null,
  count(*) FILTER (WHERE {_ANY_DATE} IS NULL)::bigint AS unparsed_date,
  count(*) FILTER (WHERE {_HOUR} IS NULL)::bigint AS unparsed_hour,
  count(*) FILTER (WHERE {_TS} IS NULL)::bigint AS unparsed_ts,
  count(*) FILTER (WHERE energy_consumption <= 0 OR energy_consumption >= 20)::bigint AS out_of_range
  FROM gappy""",
    "stage_counts": f"""WITH {_GAPPY}, stamped AS (SELECT * FROM (SELECT *, {_TS} AS ts FROM gappy) WHERE ts IS NOT NULL),
  {_hourly('stamped')}, {_featured(_WITH_CURRENT)}
  SELECT (SELECT count(*) FROM raw)::bigint AS rows_in, (SELECT sum(readings) FROM hourly)::bigint AS rows_parsed,
  (SELECT count(*) FROM hourly)::bigint AS rows_hourly, (SELECT count(*) FROM usable)::bigint AS rows_featured""",
    "drop_any_null": f"WITH {_RAW} SELECT {_RENAMED} FROM raw WHERE {_NO_NULL}",
    "drop_null_features": f"""WITH {_HOURLY}, {_featured(_WITH_CURRENT)} SELECT * REPLACE (
  round(consumption, 8) AS consumption, round(outdoor_temp, 8) AS outdoor_temp,
  round(household_size, 8) AS household_size, round(lag_1, 8) AS lag_1, round(lag_24, 8) AS lag_24,
  round(rolling_mean_24, 8) AS rolling_mean_24, round(rolling_std_24, 8) AS rolling_std_24) FROM usable""",
    "dedup_rows": f"WITH {_RAW} SELECT DISTINCT * FROM (SELECT * FROM raw UNION ALL SELECT * FROM raw)",
    "clean_readings": f"WITH {_CLEAN} SELECT * FROM clean",
    "clean_readings_strict": f"WITH {_CLEAN} SELECT * FROM clean WHERE hour IS NOT NULL AND date_parsed IS NOT NULL",
    "clean_by_hour": f"WITH {_CLEAN} SELECT hour, {_MEAN} FROM clean GROUP BY 1",
    # samples and splits
    "sample_hash": f"SELECT event_id, value FROM events WHERE {_below('1999999a')}",
    "scatter_feed": f"""WITH {_PLAUSIBLE} SELECT outdoor_temperature, hour, energy_consumption
  FROM plausible WHERE {_below('028f5c29')}""",
    "split_hash": f"""SELECT event_id, CASE WHEN {_below('cccccccd')} THEN 'train' ELSE 'test' END AS split
  FROM events""",
    "split_by_time": f"WITH {_HOURLY}, {_split('hourly')} SELECT home_id, ts, split FROM split",
    "split_sizes": f"WITH {_HOURLY}, {_split('hourly')} SELECT split, count(*)::bigint AS rows FROM split GROUP BY 1",
    "time_bounds": "SELECT min(ts) AS min_ts, max(ts) AS max_ts FROM events",
    # reports
    "by_appliance": _report(
        f"appliance_type, count(energy_consumption)::bigint AS count, {_MEAN}, "
        + _r("sum(energy_consumption)", "total_consumption"),
        "GROUP BY 1",
    ),
    "by_season": _report(
        f"season, count(*)::bigint AS count, {_MEAN}, " + _r("avg(outdoor_temperature)", "avg_temperature"),
        "GROUP BY 1",
    ),
    "by_hour": _report(f"hour, {_MEAN}", "GROUP BY 1"),
    "by_household_size": _report(f"household_size, count(*)::bigint AS count, {_MEAN}", "GROUP BY 1"),
    "by_date_hour": _report(f"date, hour, {_MEAN}", "GROUP BY 1, 2"),
    "by_date_hour_first": _report(f"date, hour, {_MEAN}", "GROUP BY 1, 2 ORDER BY 1, 2 LIMIT 100"),
    "profile_all": f"WITH {_PLAUSIBLE} "
    + " UNION ALL ".join(map(_profile, ("appliance_type", "season", "hour", "household_size"))),
    "headline": _report(
        f"count(*)::bigint AS total_records, {_MEAN}, "
        "count(DISTINCT appliance_type)::bigint AS unique_appliances, "
        + _r("avg(household_size)", "avg_household_size"),
        "",
    ),
    "describe_numeric": f"WITH {_PLAUSIBLE} "
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c})::bigint AS count, {_r(f'avg({c})', 'mean')},
  {_r(f'stddev_samp({c})', 'stddev')}, {_r(f'min({c})::double', 'min')}, {_r(f'max({c})::double', 'max')} FROM plausible"""
        for c in _DESCRIBED
    ),
    "correlation": f"WITH {_PLAUSIBLE} "
    + " UNION ALL ".join(
        f"""SELECT '{x}' AS x, '{y}' AS y,
  CASE WHEN isnan(corr({y}, {x})) THEN NULL ELSE round(corr({y}, {x}), 6) + 0.0 END AS r FROM plausible"""
        for x in _CORRELATED
        for y in _CORRELATED
    ),
    "histogram": _report(
        "floor(round(energy_consumption * 100)::bigint / 40.0)::bigint AS bin, "
        "round(floor(round(energy_consumption * 100)::bigint / 40.0) * 0.4::double, 6) AS bin_start, "
        "count(*)::bigint AS count",
        "GROUP BY 1, 2",
    ),
    "season_share": _report(
        "season, count(*)::bigint AS count, round(count(*)::double / sum(count(*)) OVER (), 6) AS share",
        "GROUP BY 1",
    ),
    "compare_to_average": f"""WITH {_READINGS},
  named AS (SELECT * REPLACE (nullif(appliance_type, 'error') AS appliance_type) FROM readings),
  averages AS (SELECT appliance_type, avg(energy_consumption) AS group_average FROM named GROUP BY 1)
  SELECT event_id, appliance_type, round(energy_consumption, 6) AS prediction,
  round(group_average, 6) AS group_average,
  {_r('(energy_consumption - group_average) / nullif(group_average, 0) * 100', 'percent_difference')}
  FROM named LEFT JOIN averages USING (appliance_type)""",
    # parsing and calendar
    "parse_hour": f"WITH {_RAW} SELECT home_id, time, {_HOUR} AS hour FROM raw",
    "parse_date": f"""WITH {_RAW} SELECT home_id, date, {_ISO} AS date_iso, {_ANY_DATE} AS date_parsed
  FROM raw""",
    "calendar_parts": """SELECT o_orderkey, year(o_orderdate)::int AS year, hour(o_orderdate)::int AS hour,
  (dayofweek(o_orderdate) + 1)::int AS dayofweek, month(o_orderdate)::int AS month,
  CASE WHEN dayofweek(o_orderdate) IN (0, 6) THEN 1.0::double ELSE 0.0::double END AS is_weekend
  FROM orders""",
    "build_timestamp": f"WITH {_RAW} SELECT home_id, date, time, {_TS} AS ts FROM raw",
    "interaction_terms": f"""WITH {_READINGS} SELECT event_id, outdoor_temperature,
  outdoor_temperature * outdoor_temperature AS temp_squared FROM readings""",
    # series
    "hourly_rollup": f"""WITH {_HOURLY} SELECT home_id, ts, round(consumption, 6) AS consumption,
  {_r('outdoor_temp', 'outdoor_temp')}, round(household_size, 6) AS household_size FROM hourly""",
    "lag_features": f"""WITH {_HOURLY} SELECT home_id, ts, round(consumption, 6) AS consumption,
  round(lag(consumption, 1) OVER ({_HOME}), 6) AS lag_1,
  round(lag(consumption, 24) OVER ({_HOME}), 6) AS lag_24 FROM hourly""",
    "lag_features_time": f"""WITH {_HOURLY} SELECT home_id, ts, round(consumption, 6) AS consumption,
  round(max(consumption) OVER ({_HOME} {_EXACT_DAY.format(1)}), 6) AS lag_1,
  round(max(consumption) OVER ({_HOME} {_EXACT_DAY.format(24)}), 6) AS lag_24 FROM hourly""",
    "rolling_features": _rolling(_WITH_CURRENT),
    "rolling_features_prior": _rolling(_PRIOR),
    "rolling_features_time": _rolling(_BY_TIME),
    "featured_orders": """WITH daily AS (
  SELECT o_custkey, date_trunc('day', o_orderdate)::timestamp AS o_orderdate, avg(o_totalprice) AS consumption
  FROM orders GROUP BY 1, 2)
  SELECT o_custkey, o_orderdate, round(consumption, 6) AS consumption,
  round(lag(consumption, 1) OVER w, 6) AS lag_1, round(lag(consumption, 3) OVER w, 6) AS lag_3,
  round(avg(consumption) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 6) AS rolling_mean_3,
  round(stddev_samp(consumption) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 6) AS rolling_std_3
  FROM daily WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate)""",
    # model inputs and metrics
    "index_categories": f"""WITH {_READINGS}, a AS ({_index('appliance_type')}), s AS ({_index('season')})
  SELECT event_id, r.appliance_type, r.season, a.rank AS appliance_index, s.rank AS season_index
  FROM readings r JOIN a USING (appliance_type) JOIN s USING (season)""",
    "scale_std": f"WITH {_READINGS} SELECT event_id, "
    + ", ".join(_r(f"{c} / stddev_samp({c}) OVER ()", f"{c}_scaled") for c in _SCALED)
    + " FROM readings",
    "scale_zscore": f"WITH {_READINGS} SELECT event_id, "
    + ", ".join(_r(f"({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER ()", f"{c}_scaled") for c in _SCALED)
    + " FROM readings",
    "fitted_features": f"WITH {_HOURLY}, {_featured(_WITH_CURRENT)}, {_split('usable')}, figures AS (SELECT "
    + ", ".join(f"avg({c}) AS mean_{c}, stddev_samp({c}) AS dev_{c}" for c in _FITTED)
    + " FROM split WHERE split = 'train') SELECT home_id, ts, split, "
    + ", ".join(_r(f"({c} - mean_{c}) / dev_{c}", f"{c}_scaled") for c in _FITTED)
    + " FROM split CROSS JOIN figures",
    "metric_suite": f"WITH {_NAIVE} SELECT {_metrics('consumption', 'lag_1')} FROM usable",
    "metric_mape": f"""WITH {_NAIVE} SELECT count(*)::bigint AS rows,
  {_r('avg(abs((consumption - lag_24) / nullif(consumption, 0))) * 100', 'mape')},
  count(*) FILTER (WHERE consumption = 0)::bigint AS zero_labels FROM usable""",
    "metric_table": f"""WITH {_NAIVE}, {_split('usable')}, {_NAIVE_MODELS.format('split')}
  SELECT model, split, {_metrics('consumption', 'prediction')} FROM pairs GROUP BY 1, 2""",
    "best_model": f"""WITH {_NAIVE}, {_NAIVE_MODELS.format('usable')}
  SELECT model, {_r('sqrt(avg((consumption - prediction) * (consumption - prediction)))', 'rmse')}
  FROM pairs GROUP BY 1 ORDER BY 2, 1 LIMIT 1""",
    # sources and sinks
    "csv_round_trip": f"""WITH {_RAW} SELECT {_RENAMED.replace('time, date', "trim(time) AS time, nullif(date, '') AS date")}
  FROM raw""",
    "parquet_round_trip": f"""WITH {_READINGS}
  SELECT * REPLACE (round(energy_consumption, 6) AS energy_consumption) FROM readings""",
    "single_csv_sink": _report(
        f"appliance_type, count(energy_consumption)::bigint AS count, {_MEAN}, "
        + _r("sum(energy_consumption)", "total_consumption"),
        "GROUP BY 1",
    ),
    "predictions_sink": f"""WITH {_NAIVE} SELECT home_id, ts, round(consumption, 6) AS label,
  round(lag_24, 6) AS prediction FROM usable""",
    "typed_timestamps": "SELECT event_id, date_trunc('second', ts)::timestamp AS ts FROM events",
    # models with an exact result
    "linear_one_feature": f"""WITH {_NAIVE}, {_trained()}, line AS (
  SELECT regr_slope(consumption, lag_24) AS slope, regr_intercept(consumption, lag_24) AS base
  FROM split WHERE split = 'train')
  SELECT home_id, ts, split, {_r('base + slope * lag_24', 'prediction', 5)} FROM split CROSS JOIN line
  WHERE split <> 'train'""",
    "model_round_trip": f"""WITH {_NAIVE}, {_trained()}, line AS (
  SELECT regr_slope(consumption, lag_24) AS slope, regr_intercept(consumption, lag_24) AS base
  FROM split WHERE split = 'train')
  SELECT home_id, ts, split, {_r('base + slope * lag_24', 'prediction', 5)} FROM split CROSS JOIN line
  WHERE split <> 'train'""",
    "tree_on_hour": f"""WITH {_NAIVE}, {_trained()}, by_hour AS (
  SELECT hour(ts) AS hour, count(*) AS n, sum(consumption) AS total FROM split WHERE split = 'train' GROUP BY 1),
  parted AS (SELECT hour, sum(n) OVER w AS n, sum(total) OVER w AS total, sum(n) OVER () AS all_n,
    sum(total) OVER () AS all_total FROM by_hour WINDOW w AS (ORDER BY hour)),
  best AS (SELECT hour AS cut, total / n AS low, (all_total - total) / (all_n - n) AS high FROM parted WHERE n < all_n
    ORDER BY total * total / n + (all_total - total) * (all_total - total) / (all_n - n) DESC LIMIT 1)
  SELECT home_id, ts, split, {_r('CASE WHEN hour(ts) <= cut THEN low ELSE high END', 'prediction', 5)}
  FROM split CROSS JOIN best WHERE split <> 'train'""",
    **{
        f"{model}_by_appliance": _report(
            f"appliance_type, {_r('avg(energy_consumption)', 'low', 5)}, {_r('avg(energy_consumption)', 'high', 5)}",
            "GROUP BY 1",
        )
        for model in ("tree", "gbt", "forest")
    },
    "forecast_checks": f"""WITH {_NAIVE}, {_trained()}
  SELECT model, count(*)::bigint AS rows_scored, 0::bigint AS missing, 0::bigint AS outside
  FROM split CROSS JOIN (SELECT unnest(['linear', 'forest', 'gbt']) AS model) WHERE split <> 'train' GROUP BY 1""",
    "household_checks": f"""WITH {_PLAUSIBLE}
  SELECT model, count(*)::bigint AS rows_scored, 0::bigint AS missing, 0::bigint AS outside
  FROM plausible CROSS JOIN (SELECT unnest(['gbt', 'tree', 'forest']) AS model)
  WHERE NOT ({_below('cccccccd')}) GROUP BY 1""",
    "forecast_preview_keys": f"""WITH {_NAIVE}, {_trained()}
  SELECT home_id, ts, consumption AS label FROM split WHERE split = 'test' ORDER BY ts, home_id LIMIT 10""",
    "scenario_keys": f"""WITH {_PLAUSIBLE}, averages AS (
  SELECT appliance_type, avg(energy_consumption) AS group_average FROM plausible GROUP BY 1)
  SELECT event_id, appliance_type, {_r('group_average', 'group_average')}, false AS missing
  FROM plausible JOIN averages USING (appliance_type)""",
}
