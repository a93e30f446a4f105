"""admitlab: encounter analytics as Spark DataFrame jobs.

Every job is a function ``(DataFrame, ...params) -> DataFrame`` built from
Spark SQL built-ins.  ``admitlab.plans.registry`` maps job keys to callables
``(spark, sf_dir) -> DataFrame`` that read the driver's Parquet tables.
"""

__version__ = "0.1.0"
