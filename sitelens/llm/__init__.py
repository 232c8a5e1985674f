"""Training-data operators and the queries that run them.

Nothing else in the library imports this subpackage. Python functions that
run in tasks are shipped by value, so executors do not need the package
installed.
"""

import importlib

from pyspark import cloudpickle

PYTHON_MODULES = ("jaccard", "langid", "secrets", "sketch", "tokens", "toxicity", "trie", "urls", "vectors", "warc")

for _name in PYTHON_MODULES:
    cloudpickle.register_pickle_by_value(importlib.import_module(f"{__name__}.{_name}"))
