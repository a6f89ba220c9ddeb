"""Operations of a training-data pipeline, each one Spark job graph.

Nothing else in the library imports this package; its queries are listed in
:mod:`hublytics.llm.queries` and the pipeline in ``corpus_pipeline.py``.

Functions that run in executors' Python workers travel with the task (pickled
by value), so executors need no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
