"""Operators for preparing training text at scale.

Each module holds one operator with a general interface; ``queries`` binds them
to the tables of a data folder. Nothing outside this package imports it.
"""

from pyspark import cloudpickle

import marketflow.llm as _self

# Ship these functions to the workers by value, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(_self)
