from oeeflow.sources.fixture import load_tables, raw_export_view, work_orders
from oeeflow.sources.io import (read_raw_export, read_work_orders, rename_raw_columns,
                                to_raw_names, write_marts, write_table)

__all__ = ["load_tables", "work_orders", "raw_export_view", "read_work_orders", "read_raw_export",
           "rename_raw_columns", "to_raw_names", "write_table", "write_marts"]
