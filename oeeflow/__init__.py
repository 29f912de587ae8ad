"""oeeflow — work-order efficiency analytics as lazy Spark DataFrame operators.

Every public operator takes and returns a ``pyspark.sql.DataFrame`` and runs no
action, except the model fits in :mod:`oeeflow.plans.ml` and the explicit sinks in
:mod:`oeeflow.sources.io`.
"""

__version__ = "0.1.0"
