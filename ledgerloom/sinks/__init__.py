from ledgerloom.sinks.snapshots import expire, read_table, versions
from ledgerloom.sinks.writers import (
    alert_rows,
    copy_table,
    read_routed,
    replace_dates,
    with_headers,
    write_append,
    write_date_slice,
    write_fan_out,
    write_folder,
    write_full_refresh,
    write_jdbc,
    write_report,
    write_routed,
)

__all__ = [
    "alert_rows",
    "copy_table",
    "expire",
    "read_routed",
    "read_table",
    "replace_dates",
    "versions",
    "with_headers",
    "write_append",
    "write_date_slice",
    "write_fan_out",
    "write_folder",
    "write_full_refresh",
    "write_jdbc",
    "write_report",
    "write_routed",
]
