"""Operators of a training-data pipeline; nothing else in the library imports this.

Functions of this library that run in tasks travel with the job, by value: executors need
Python with numpy, pyarrow and regex, but not this library.
"""

from pyspark import cloudpickle

import quire

cloudpickle.register_pickle_by_value(quire)
