"""inkfold: document-image and text-evaluation operators on Spark DataFrames.

Every operator takes DataFrames and returns a lazy DataFrame; nothing is
collected to the driver.
"""

import sys

from pyspark import cloudpickle

# Functions sent to Python workers travel with the job, so executors do not
# need this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
