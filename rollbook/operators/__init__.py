from rollbook.operators.cells import cell_columns, cells_drop, cells_pivot, cells_select
from rollbook.operators.schemas import set_nullable
from rollbook.operators.vectors import labeled_points, unlabeled_vectors

__all__ = [
    "cell_columns",
    "cells_drop",
    "cells_pivot",
    "cells_select",
    "labeled_points",
    "set_nullable",
    "unlabeled_vectors",
]
