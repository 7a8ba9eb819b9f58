from shelfmark.sources.compaction import compact, file_sizes
from shelfmark.sources.export import export_csv
from shelfmark.sources.landing import (
    cluster_by_vendor,
    concat_pages,
    day_path,
    day_path_column,
    flatten_nested,
    landed_stores,
    purge_base_day,
    read_base_days,
    read_base_parquet,
    read_raw_days,
    read_raw_json,
    unread_fields,
    stamp_ingestion_date,
    write_base_parquet,
)
from shelfmark.sources.pages import (
    bad_pages,
    explode_listings,
    lift_fields,
    other_fields,
    page_counts,
    parse_pages,
    quarantine,
    quarantined,
    read_pages,
    release,
    scan_pages,
)
from shelfmark.sources.rollup import attach_rollup, detach_rollup, read_rollup, repair_rollup, rollup_of
from shelfmark.sources.seeds import VALID_VENDORS, load_seed
from shelfmark.sources.tables import (
    align_to_table,
    append_day,
    audit_counts,
    delete_day,
    delete_days,
    drop_partitions,
    ensure_table,
    evolve_table,
    insert_bucketed,
    materialize_incremental,
    materialize_view,
    partition_values,
    replace_day,
    replace_days,
    scan_table,
    schema_history,
    set_aside,
    store_view,
)

__all__ = [name for name in dir() if not name.startswith("_")]
