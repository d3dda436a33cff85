"""emberstat — flight-study preparation, classification, topic models and chart
statistics written as Spark DataFrame operators.

Every public function takes and returns ``pyspark.sql.DataFrame`` objects; the
``SparkSession`` is always passed in by the caller.
"""

__version__ = "0.1.0"
