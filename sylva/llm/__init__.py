"""Training-data operators: cleaning, scoring, mixing, sharding and encoding a document corpus.

Every module holds one operator and its registered query; ``sylva.llm.queries``
collects them. Nothing outside this folder imports it (the entry module and
``corpus_pipeline.py`` do).
"""

import sys

from pyspark import cloudpickle

# ship this folder's code with the tasks, so that Python workers need no installed copy
cloudpickle.register_pickle_by_value(sys.modules[__name__])
