"""skylake: daily weather and solar observations on Spark."""
