"""Operators of a training-data pipeline: search, near-duplicate and repeat
removal, secret scans, classifiers, URL lists, decontamination, tokenizing.

Functions of this package that run inside tasks are shipped by value, so
executors need numpy, pyarrow and the tokenizer files but not this package.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
