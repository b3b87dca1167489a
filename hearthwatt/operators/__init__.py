from .cleaning import (
    cast_numeric,
    clean_readings,
    drop_nulls,
    drop_repeats,
    keep_open_range,
    keep_parsed,
    quality_report,
    rename_readings,
    timestamped_readings,
    with_reading_calendar,
    with_timestamp,
)
from .comparing import compare_to_average
from .metrics import best_model, best_model_name, metric_suite, metric_table
from .modelling import (
    FittedModels,
    check_categories,
    fit_forecast,
    fit_household,
    index_categories,
    interaction_terms,
    load_model,
    save_model,
    scale_columns,
    score_scenarios,
    spread,
)
from .profiling import (
    average_by,
    by_appliance,
    by_date_hour,
    by_hour,
    by_household_size,
    by_season,
    correlation,
    describe_numeric,
    from_profile,
    headline,
    histogram,
    profile_all,
    season_share,
)
from .series import (
    featured_series,
    hourly_rollup,
    stage_counts,
    with_calendar,
    with_lags,
    with_rolling,
)
from .splitting import (
    hash_sample,
    hash_split,
    split_by_time,
    split_ranges,
    split_sizes,
    time_bounds,
    time_limits,
    within_split,
)

__all__ = [name for name in dir() if not name.startswith("_")]
