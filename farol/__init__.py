"""farol: risk scoring and triage analytics on Spark DataFrames.

Every operator takes a DataFrame and returns a DataFrame. Functions that have to
look at the data first (a quantile bracket, a class count) say so in their
docstring, and what they bring to the driver is bounded by the schema, the number
of classes or a fixed constant, never by the number of rows.
"""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Python tasks carry the functions they need, so executors do not have to have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
