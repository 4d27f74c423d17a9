"""Training-data operators: ten dealt operators, their queries and SQL.

Nothing outside this package (and ``corpus_pipeline.py``) imports it.  Python
functions that run inside tasks are pickled by value, so executors need no
copy of the package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
