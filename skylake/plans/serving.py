"""Read-only queries over the stored marts and the compacted archive, one function each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skylake.functions.numeric import avg_of_sums, exact_avg, round_half_even, rounded_avg
from skylake.operators.topk import top_k
from skylake.schemas import HISTORY_MEASURES

PANEL_M2 = 2.7
PANEL_EFFICIENCY = 0.217

# Columns of each served result.
TEMPERATURE = """
    dates weekday_name department temp tempmin tempmax feelslike feelslikemin feelslikemax descriptions
""".split()
SOLAR_GEO = """
    dates weekday_name department geo_point_2d geojson solarenergy_kwhpm2 solarradiation reg_name
    avg_solarenergy_kwhpm2 avg_solarradiation
""".split()
FEATURES = """
    dates department reg_name windspeed windgust pressure solarenergy_kwhpm2 temp feelslike precip
""".split()
SUNSHINE = ["dates", "reg_name", "department", "solarenergy_kwhpm2", "solarradiation"]
STATS = {
    "temperature": ("temp", 1), "humidity": ("humidity", 1), "windspeed": ("windspeed", 1),
    "pressure": ("pressure", 1), "cloudcover": ("cloudcover", 1), "solarradiation": ("solarradiation", 1),
    "solarenergy": ("solarenergy_kwhpm2", 2),
}


def _of(column: str, value: str) -> Column:
    return F.col(column) == F.lit(value)


def _by_date(df: DataFrame) -> DataFrame:
    """Sort by date; the record id lets Spark cut one hot date into several sort ranges."""
    return df.orderBy(F.col("dates").asc_nulls_last(), F.col("record_id").asc_nulls_last())


def get_data(mart: DataFrame) -> DataFrame:
    return mart


def get_temp_data(mart: DataFrame, department: str) -> DataFrame:
    return _by_date(mart.where(_of("department", department))).select(*TEMPERATURE)


def get_solarenergy_geo_data(mart: DataFrame, date: str) -> DataFrame:
    return mart.where(F.col("dates") == F.lit(date).cast("date")).select(*SOLAR_GEO)


def get_date(mart: DataFrame) -> DataFrame:
    return mart.select("dates").distinct()


def get_tfptwgp(mart: DataFrame, department: str) -> DataFrame:
    """Temperature, feels-like, precipitation, wind, gust and pressure."""
    return _by_date(mart.where(_of("department", department))).select(*FEATURES)


def get_sunshine_data(mart: DataFrame) -> DataFrame:
    return mart.select(*SUNSHINE)


def get_region_sunshine_data(mart: DataFrame, region: str) -> DataFrame:
    return mart.where(_of("reg_name", region)).select("reg_name", "department", "solarenergy_kwhpm2", "solarradiation")


def get_solarenergy_agg_pday(mart: DataFrame, department: str) -> DataFrame:
    """Daily solar yield of one panel: average energy, energy on the panel, energy produced."""
    average = F.col("solarenergy_kwhpm2")
    return (
        mart.where(_of("department", department))
        .groupBy("department").agg(exact_avg("solarenergy_kwhpm2").alias("solarenergy_kwhpm2"))
        .select(
            "department", average,
            (average * F.lit(PANEL_M2)).alias("available_solarenergy_kwhc"),
            (average * F.lit(PANEL_M2) * F.lit(PANEL_EFFICIENCY)).alias("real_production_kwhpday"),
        )
    )


def get_entire_department_data(archive: DataFrame, department: str) -> DataFrame:
    rounded = [round_half_even(m, 1).alias(m) for m in HISTORY_MEASURES]
    return _by_date(archive.where(_of("department", department))).select("dates", "department", *rounded)


def get_entire_region_data(archive: DataFrame, region: str) -> DataFrame:
    averages = [rounded_avg(m, 1).alias(m) for m in HISTORY_MEASURES]
    return (
        archive.where(_of("reg_name", region)).groupBy("dates", "reg_name").agg(*averages)
        .orderBy("dates", "reg_name")
    )


def get_region_history(sums: DataFrame, region: str) -> DataFrame:
    """`get_entire_region_data` from the stored sums (`served.region_sums`), a row per date and region instead of the archive's rows."""
    averages = [round_half_even(avg_of_sums(m), 1).alias(m) for m in HISTORY_MEASURES]
    return sums.where(_of("reg_name", region)).groupBy("dates", "reg_name").agg(*averages).orderBy("dates", "reg_name")


def get_ml_data(archive: DataFrame) -> DataFrame:
    """The whole archive, for a training export."""
    return archive


def get_today_stats(today_stats: DataFrame) -> DataFrame:
    return today_stats


def get_next_3_days_stats(next_3_days_stats: DataFrame, department: str | None = None) -> DataFrame:
    return next_3_days_stats if department is None else next_3_days_stats.where(_of("department", department))


def get_next_3_days_data(next_3_days: DataFrame) -> DataFrame:
    return next_3_days


def get_today_data(today: DataFrame) -> DataFrame:
    return today


def get_stats(
    today: DataFrame, next_3_days: DataFrame, level: str = "department", period: str = "today",
    top: bool = True, rank_by: str | None = None, k: int = 3,
) -> DataFrame:
    """Seven rounded averages per department or region, for the first day or the next three.

    With `rank_by`, only the `k` highest (`top`) or lowest groups by that column.
    """
    if level not in ("region", "department"):
        raise ValueError(f"unknown level {level!r}: choose region or department")
    if period not in ("today", "next3days"):
        raise ValueError(f"unknown period {period!r}: choose today or next3days")
    if rank_by is not None and rank_by not in STATS:
        raise ValueError(f"no statistic {rank_by!r}; there are {', '.join(STATS)}")
    rows = today if period == "today" else next_3_days
    key = "reg_name" if level == "region" else "department"
    stats = rows.groupBy(F.col(key).alias("geo_name")).agg(
        *[rounded_avg(measure, digits).alias(name) for name, (measure, digits) in STATS.items()]
    )
    return stats if rank_by is None else top_k(stats, rank_by, ascending=not top, k=k)
