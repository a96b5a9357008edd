"""Operators of a training-data pipeline, as Spark jobs.

Nothing else in the library imports this package.  Functions that run inside
tasks are shipped by value, so executors need not have the package installed.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
