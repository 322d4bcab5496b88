"""Operators of a training-data pipeline, each by its own Spark job.

Nothing outside this package imports it.  Functions that run inside
Python tasks are pickled by value, so executors need no installed copy.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
