"""Ranked traffic statistics on PySpark: dumps to daily facts, facts to ranked reports, with
upserts, calendars, dimension sync and data-quality checks as DataFrame operators."""

from viewmart.operators.calendars import (
    calendar,
    last_ingested,
    missing_dates,
    needs_build,
    pending_dates,
)
from viewmart.operators.changes import append_rows, key_problems, merge_rows
from viewmart.operators.dimension import change_counts, dimension_changes, sync_dimension
from viewmart.operators.profile import (
    duplicate_keys,
    fingerprint,
    null_counts,
    profile,
    row_count,
)
from viewmart.operators.interleave import interleave, write_interleaved
from viewmart.operators.quality import expect, key_report, validate, validation, violations
from viewmart.operators.rank import (
    monthly_views,
    page_sums,
    page_totals,
    restrict_to_top,
    top_pages,
    top_rows,
    with_month,
)
from viewmart.plans.reports import build_all, top_pages_daily, top_pages_monthly
from viewmart.plans.rollups import (
    monthly_from_sums,
    read_day_sums,
    read_month_sums,
    read_window,
    refresh_sums,
    totals_from_sums,
    update_window,
)
from viewmart.sources.assets import (
    asset_exists,
    delete_asset,
    fresh_assets,
    list_assets,
    raw,
    read_asset,
    register_assets,
    write_asset,
    write_files,
)
from viewmart.sources.dumps import (
    dump_facts,
    filter_project,
    parse_lines,
    parse_rejects,
    read_dump,
    to_facts,
)
from viewmart.sources.facts import (
    read_daily_files,
    read_days,
    read_facts,
    read_recent,
    write_facts,
)
from viewmart.sources.tables import (
    WriteResult,
    append,
    drop_versions,
    merge,
    overwrite,
    read_table,
    table_content,
    table_exists,
    table_rows,
    validate_asset,
    write_clustered,
)
from viewmart.streaming.ingest import ingest, ingest_stream, read_outcomes
