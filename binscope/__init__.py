"""binscope: DataFrame operators for tabular binary-classification work on Spark.

Every operator takes and returns ``pyspark.sql.DataFrame`` objects and is built
from built-in Spark SQL expressions, so Catalyst can prune columns, push
filters into the Parquet scan and keep the work inside whole-stage codegen.
Operators that learn something from the data are split into ``fit`` (returns a
small state DataFrame) and ``apply`` (a projection that uses that state).
"""

__version__ = "0.1.0"
