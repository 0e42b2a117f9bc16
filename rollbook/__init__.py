"""Customer-lifecycle counts and the data preparation around them, on Spark DataFrames."""

from rollbook.functions import (
    classify_strings,
    is_double,
    is_empty,
    is_int,
    is_json,
    profile_strings,
    replace_nulls,
    with_month_bounds,
    with_time_string,
)
from rollbook.operators import (
    cell_columns,
    cells_drop,
    cells_pivot,
    cells_select,
    labeled_points,
    set_nullable,
    unlabeled_vectors,
)
from rollbook.plans import active_as_of, copy_dataset, new_users, new_users_between, total_users
from rollbook.sinks import write_parquet, write_text
from rollbook.sources import (
    SourceDescriptor,
    file_inventory,
    load_source,
    read_csv,
    read_orc,
    read_parquet,
    read_table,
    read_text,
    table_row_counts,
)

__all__ = [
    "SourceDescriptor",
    "active_as_of",
    "cell_columns",
    "cells_drop",
    "cells_pivot",
    "cells_select",
    "classify_strings",
    "copy_dataset",
    "file_inventory",
    "is_double",
    "is_empty",
    "is_int",
    "is_json",
    "labeled_points",
    "load_source",
    "new_users",
    "new_users_between",
    "profile_strings",
    "read_csv",
    "read_orc",
    "read_parquet",
    "read_table",
    "read_text",
    "replace_nulls",
    "set_nullable",
    "table_row_counts",
    "total_users",
    "unlabeled_vectors",
    "with_month_bounds",
    "with_time_string",
    "write_parquet",
    "write_text",
]
