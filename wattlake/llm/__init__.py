"""Operators for preparing text, page and embedding tables for language-model training.

The functions that run inside tasks travel with the job instead of being imported on the
executors, which therefore need numpy, pyarrow and sentencepiece, but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
