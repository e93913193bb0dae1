from lathe.sources.tables import (  # noqa: F401
    read_table,
    scan_head,
    scan_select,
    scan_typed_key,
    sales_frame,
    lookup_frame,
    parts_frame,
    prediction_log_frame,
)
