from ledgerloom.sources.scans import (
    scan_documents,
    scan_jdbc,
    scan_records,
    scan_table,
    scan_wide_rows,
)

__all__ = ["scan_documents", "scan_jdbc", "scan_records", "scan_table", "scan_wide_rows"]
