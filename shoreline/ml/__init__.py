"""Classification on tables with pyspark.ml."""
