"""Training-data operators: extraction, filtering, deduplication, scoring and
tokenised output over web-scale text tables.

Nothing else in the library imports this subpackage. Its Python functions
travel inside the Spark tasks by value, so executors need only the public
libraries (numpy, pyarrow, tokenizers, ...), not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
