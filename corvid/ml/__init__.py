"""Table-based ML jobs on ``pyspark.ml``."""
