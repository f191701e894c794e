"""Operators of a large-scale training-data pipeline. Nothing outside this
package imports it; ``bindings`` registers one query per operator."""

import sys

from pyspark import cloudpickle

# Functions sent to executors carry their code along: the package need not be
# installed on the executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
