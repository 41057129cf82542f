"""Training-data operators: formatting, mixing, counting, sharding, scoring,
filtering, packing, search and de-duplication of corpora.

One module per operator; ``registry`` binds them to the test tables. Nothing
else in the library imports this package.

Functions that run inside tasks are shipped by value: Python workers need
numpy, pandas, pyarrow and the tokenizer libraries, not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
