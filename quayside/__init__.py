"""quayside: declarative file-to-lake loading on PySpark.

Landed files come in through ``sources``, are reshaped by ``operators`` and
``functions``, and leave through ``sinks``. ``plans`` strings these together
for a batch load or a re-ingest; ``streaming`` does the same on arrival.
"""

import sys

from pyspark import cloudpickle

LINE_NUMBER = "meta_source_line_number"
SOURCE_NAME = "meta_source_name"
SNAPSHOT = "snapshot_date"

# functions of this package reach the Python workers by value: executors need no copy of it
cloudpickle.register_pickle_by_value(sys.modules[__name__])
