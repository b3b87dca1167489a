from .inspect import preview_rows, schema_report
from .readers import literal_rows, read_csv_readings, read_parquet
from .writers import delete_written, shared_folder, write_parquet, write_single_csv, written_once

__all__ = [
    "delete_written",
    "literal_rows",
    "preview_rows",
    "read_csv_readings",
    "read_parquet",
    "schema_report",
    "shared_folder",
    "write_parquet",
    "write_single_csv",
    "written_once",
]
