"""Operators for training-data corpora (tables ``documents``, ``embeddings``, ``benchmark``, ``labels``).

Nothing else in the library imports this subpackage.  The functions that run
inside tasks are shipped by value, so executors need no copy of the package.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
