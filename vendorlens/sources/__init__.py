"""Sources and sinks: the driver's parquet tables, the raw order-item table
derived from them, and the CSV/JSON/parquet readers and writers."""

from .orders import RAW_COLUMNS, raw_order_items  # noqa: F401
from .tables import TABLES, read_table, table_path  # noqa: F401
