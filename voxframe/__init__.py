"""Speech-corpus preparation and evaluation as Spark DataFrame operators."""
