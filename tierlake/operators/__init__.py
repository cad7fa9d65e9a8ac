from tierlake.operators.aggregates import (
    count_by_group,
    mean_by_group,
    preview,
    rank_by_mean,
    table_shape,
    union_years,
    value_counts,
)
from tierlake.operators.analyses import (
    abstention_rate,
    compare_flag,
    corr_external,
    density_by_group,
    histogram_by_group,
    mean_median_by_group,
    region_compare,
    top_groups,
)
from tierlake.operators.columns import (
    fill_scores,
    present,
    present_only,
    restrict_years,
    select_present,
    with_year,
    years_having,
)
from tierlake.operators.joins import broadcast_if_small, join_dimension, join_null_safe
from tierlake.operators.median import exact_median
from tierlake.operators.sketches import median_sketch_by_group, merge_by_group, quantile_of, rank_bounds, rank_error, sketches_by_group

__all__ = [
    "abstention_rate",
    "broadcast_if_small",
    "compare_flag",
    "corr_external",
    "count_by_group",
    "density_by_group",
    "exact_median",
    "fill_scores",
    "histogram_by_group",
    "join_dimension",
    "join_null_safe",
    "mean_by_group",
    "mean_median_by_group",
    "median_sketch_by_group",
    "merge_by_group",
    "present",
    "present_only",
    "preview",
    "quantile_of",
    "rank_bounds",
    "rank_by_mean",
    "rank_error",
    "region_compare",
    "restrict_years",
    "select_present",
    "sketches_by_group",
    "table_shape",
    "top_groups",
    "union_years",
    "value_counts",
    "with_year",
    "years_having",
]
