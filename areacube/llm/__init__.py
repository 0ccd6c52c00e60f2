"""Training-data operators on Spark: near-duplicate joins, language ID,
packing, substring removal, token files, page text, quality rules, secrets
and byte-level BPE.

Nothing else in the library imports this subpackage.  Functions that run in
Python workers are pickled by value, so executors need numpy, pyarrow and the
tokenizer libraries but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
