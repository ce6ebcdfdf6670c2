"""ecoframe: vehicle-emissions data preparation, model training, scoring and
monitoring expressed as Spark DataFrame jobs.

Every operator is a function ``DataFrame -> DataFrame`` (or ``DataFrame ->
small typed result`` for scalar statistics) that takes column names as
arguments, so it applies to any table with the right columns.
"""

from ecoframe.session import get_spark, work_dir

__all__ = ["get_spark", "work_dir"]
