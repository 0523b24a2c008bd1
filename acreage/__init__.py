"""Geospatial exposure and raster analytics as DataFrame -> DataFrame operators on Spark.

Four relations run through the package:

* pixels: one row per classified or multi-band raster pixel,
* cells: one row per grid cell of an equal-area grid,
* multipliers: storey proportions and insured values (small dimensions),
* samples: labelled points or chips with features, folds and predictions.

Operators take and return lazy DataFrames; only the few iterative ones
(neighbour search, global ordering) run jobs while they build their result.
"""

import os
import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions of the library are sent to Python workers whole, unless PYTHONPATH names the folder it is in.
if os.path.dirname(os.path.dirname(os.path.abspath(__file__))) not in os.environ.get("PYTHONPATH", "").split(os.pathsep):
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
