"""Operators of a training-data pipeline: filters, dedup, packing, search.

One module per operator; ``queries`` registers them. Nothing outside this
package (and ``corpus_pipeline.py``) imports from here.
"""

import sys

from pyspark import cloudpickle

# functions of this package travel to the executors by value, so a cluster
# needs no copy of it on its machines
cloudpickle.register_pickle_by_value(sys.modules[__name__])
