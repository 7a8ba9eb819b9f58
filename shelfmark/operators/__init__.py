from shelfmark.operators.aggregates import (
    WEEKDAYS,
    bounds,
    counts_by,
    counts_by_type,
    daily_vendor_rollup,
    distinct_vendors,
    merged_bounds,
    merged_rollup,
    order_weekday,
    products_by_vendor,
    revenue_per_day,
    row_count,
    sales_by_color_day,
    sales_by_weekday,
    sales_per_day,
    sales_per_day_vendor,
    sold_partials,
    vendor_totals,
    weekday_spine,
)
from shelfmark.operators.boxplot import box_outliers, box_stats, quartiles
from shelfmark.operators.coverage import coverage_grid, expand_days, missing_drops, store_start_gate
from shelfmark.operators.filters import (
    cast_price_int,
    cast_sold_date,
    drop_columns,
    filter_color,
    filter_range,
    filter_sold,
    filter_title,
    filter_vendor,
    matches,
    prepare_sold,
)
from shelfmark.operators.guard import guard_passes, incremental_guard, latest_or_never, open_stores
from shelfmark.operators.points import (
    ordered_category,
    points,
    price_vs_condition_points,
    price_vs_type_points,
)
from shelfmark.operators.quality import (
    DataQualityError,
    check_mart,
    check_sold,
    check_staging,
    dq_failures,
    dq_gate,
    dq_not_null,
    dq_unique,
    dq_valid_vendors,
    duplicate_keys,
    not_in_seed,
)
from shelfmark.operators.sold import (
    day_before,
    filter_snapshot_day,
    last_available_day,
    project_mart,
    project_sold,
    project_sold_ext,
    require_complete_day,
    snapshot_diff,
    snapshot_diff_days,
    sold_products_mart,
)
from shelfmark.operators.staging import (
    enrich,
    enrich_stores,
    extract_attributes,
    latest_by_id,
    row_hash,
    stage,
    tag_store,
)

__all__ = [name for name in dir() if not name.startswith("_")]
