"""docsift: turn collections of files into tables of nested files, text, metadata and lineage on Spark."""

import sys

from pyspark import cloudpickle

from docsift.plans.process import ProcessResult, process, process_jobs, process_path
from docsift.session import configure

__all__ = ["ProcessResult", "configure", "process", "process_jobs", "process_path"]

# Functions of this package travel to the executors inside the jobs that use them, so it need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
