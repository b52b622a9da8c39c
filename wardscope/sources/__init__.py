"""Reading incident tables and writing tables, reports, manifests and models."""

from wardscope.sources.tables import (  # noqa: F401
    RAW_INCIDENT_SCHEMA,
    load_model,
    read_incidents_csv,
    read_table,
    row_counts,
    save_model,
    write_manifest,
    write_parquet,
    write_partitioned,
    write_report_csv,
    write_summary,
)
