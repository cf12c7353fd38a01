"""Training-data operators: filters, deduplication, scoring, mixing and packing of documents.

One module per operator (each with its own general interface and the thin ``opN_...`` query in
``queries.py``).  Nothing outside this folder and ``corpus_pipeline.py`` imports it.

Functions that run inside Python workers are pickled by value, so executors need no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
