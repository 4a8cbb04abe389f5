"""Market and news risk analytics as Spark DataFrame operators."""
