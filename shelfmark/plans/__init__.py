from shelfmark.plans.daily import (
    BadPagesError,
    DayReport,
    build_sold,
    land_days,
    publish_staging,
    publish_views,
    quarantine_root,
    rebuild_sold,
    run_day,
)
from shelfmark.plans.dashboard import dashboard
from shelfmark.plans.state import advance_state, latest_state, merged_state, sold_from_state, state_versions

__all__ = [name for name in dir() if not name.startswith("_")]
