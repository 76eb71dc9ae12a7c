"""panelflume: demand, causal and allocation analytics over large time-series panels, on Spark DataFrames."""
import sys

from pyspark import cloudpickle

# Kernels travel to the workers as code, so executors need no copy of this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
