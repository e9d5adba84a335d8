"""Column-level helpers built only from pyspark.sql.functions."""
