"""Operators of a training-data pipeline. Nothing else in the library imports them."""

from __future__ import annotations

import sys

from pyspark import cloudpickle

# Functions that run on executors travel with the job; executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
