"""Training-data operators: near-duplicates, tokens, quality, secrets, archives.

One module per operator; ``queries.py`` registers one query per operator over
the driver's tables.  Nothing outside this package (and ``corpus_pipeline.py``)
imports it.  Functions sent to executors travel by value, so executors need
numpy, pyarrow and the tokenizers library but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
