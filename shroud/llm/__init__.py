"""Operators for preparing training text at scale.

Thirteen operators over ``documents(doc_id, text, lang, source, n_chars)``-like
tables and ``pages(page_id, url)``, each in a module of its own; ``catalog`` registers one query for each.
Nothing else in the library imports this subpackage.

Functions that run in tasks are sent by value, so executors need the
third-party libraries but not an installation of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
