"""Operators for building training corpora, and their queries.

Nothing else in the library imports this package.  Conventions shared by all operators:

* a word is ``[^\\x20\\x09-\\x0D]+``; only A-Z are lower-cased, on the UTF-8 bytes;
* a null text counts as empty; rows with a null id are kept and never compared by id;
* only the named columns of an input are read, so further columns, whatever their names, do no harm.
"""

import sys

from pyspark import cloudpickle

# functions sent to the executors carry their code along, so nothing has to be installed there
cloudpickle.register_pickle_by_value(sys.modules[__name__])
