"""The conversions as functions of Spark SQL, for query text that used them as macros."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Function name, argument and the expression before rounding, digits kept.
CONVERSIONS = [
    ("convert_f_to_c", "temperature", "(temperature - 32.0D) * (5.0D / 9.0D)", 0),
    ("convert_inch_to_cm", "precip", "precip * 2.54D", 0),
    ("convert_inch_to_mm", "precip", "precip * 25.4D", 2),
    ("convert_mph_to_kph", "speed", "speed * 1.60934D", 1),
    ("convert_mj_per_m2_to_kwh_per_m2", "mj_per_m2", "mj_per_m2 * 0.2778D", 3),
]


def register_functions(spark: SparkSession) -> list[str]:
    """Create the conversions, and `round_even(x, digits)`, as temporary SQL functions."""
    spark.sql("create or replace temporary function round_even(x double, digits int) returns double "
              "return rint(x * pow(10.0D, digits)) / pow(10.0D, digits)")
    for name, argument, expression, digits in CONVERSIONS:
        spark.sql(f"create or replace temporary function {name}({argument} double) returns double "
                  f"return rint(({expression}) * {float(10**digits)}D) / {float(10**digits)}D")
    return ["round_even", *[c[0] for c in CONVERSIONS]]
