from rollbook.sources.inventory import file_inventory
from rollbook.sources.readers import read_csv, read_orc, read_parquet, read_text
from rollbook.sources.router import SourceDescriptor, load_source
from rollbook.sources.tables import read_table, table_row_counts

__all__ = [
    "SourceDescriptor",
    "file_inventory",
    "load_source",
    "read_csv",
    "read_orc",
    "read_parquet",
    "read_table",
    "read_text",
    "table_row_counts",
]
