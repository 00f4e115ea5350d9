"""Reporting views over a mart: the first day, the next three days, their averages, leaderboards.

"Today" is the earliest date of the batch. A view takes any frame with the columns it names; give it
the written mart, so that column pruning and the date filter reach the files.
"""

from __future__ import annotations

from datetime import date
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skylake.functions.numeric import rounded_avg
from skylake.operators.averages import Average, with_group_averages
from skylake.operators.topk import top_k

# The measures of the reporting views with the digits of their averages.
MEASURES = {
    "temp": 1, "solarenergy_kwhpm2": 2, "solarradiation": 2, "humidity": 2, "windspeed": 2, "pressure": 2,
    "cloudcover": 2,
}
_REPORTED = ["reg_name", "department", *MEASURES]
FORECAST_DAYS = 3


def _first(mart: DataFrame, first_day: date | None) -> Column:
    return mart.select(F.min("dates")).scalar() if first_day is None else F.lit(first_day)


def mart_today(mart: DataFrame, first_day: date | None = None) -> DataFrame:
    """Rows of the first day; a stored mart's `first` spares the scan that finds it."""
    return mart.where(F.col("dates") == _first(mart, first_day)).select(*_REPORTED)


def mart_next_3_days(mart: DataFrame, first_day: date | None = None) -> DataFrame:
    """Rows of the three days after the first one."""
    first_day = _first(mart, first_day)
    in_range = (F.col("dates") > first_day) & (F.col("dates") <= F.date_add(first_day, FORECAST_DAYS))
    return mart.where(in_range).select(*_REPORTED)


def _averages(prefix: str, temperature: str) -> list[Average]:
    return [Average(m, digits, f"{prefix}_{temperature if m == 'temp' else m}") for m, digits in MEASURES.items()]


def mart_today_stats(today: DataFrame) -> DataFrame:
    """Each measure of the first day next to its region average."""
    averages = _averages("regavg", "temp")
    with_region = with_group_averages(today, {"reg_name": averages})
    columns = [c for m, a in zip(MEASURES, averages) for c in (m, a.name)]
    return with_region.select("reg_name", "department", *columns)


def mart_next_3_days_stats(next_days: DataFrame) -> DataFrame:
    """Each measure of the next three days next to its department and region averages."""
    by_department, by_region = _averages("depavg", "temp_c"), _averages("regavg", "temp_c")
    both = with_group_averages(next_days, {"department": by_department, "reg_name": by_region})
    columns = [c for m, d, r in zip(MEASURES, by_department, by_region) for c in (m, d.name, r.name)]
    return both.select("reg_name", "department", *columns)


class Board(NamedTuple):
    """One leaderboard: three best or worst departments or regions by a measure."""

    name: str
    key: str
    three_days: bool
    measure: str
    column: str
    ascending: bool


# Measure behind each word of a leaderboard name, and which boards exist.
BOARD_MEASURES = {
    "cloudcover": "cloudcover", "humidity": "humidity", "radiation": "solarradiation",
    "solarenergy": "solarenergy_kwhpm2", "temperature": "temp", "windspeed": "windspeed",
}
BOTTOM_3D = ["cloudcover", "radiation", "solarenergy", "temperature"]
TOP_3D = ["cloudcover", "humidity", "radiation", "solarenergy", "temperature", "windspeed"]
BOTTOM_TODAY = ["cloudcover", "temperature"]
TOP_TODAY = ["cloudcover", "humidity", "solarenergy", "temperature", "windspeed"]


def _board(level: str, word: str, three_days: bool, ascending: bool) -> Board:
    end = f"{'bottom3' if ascending else 'top3'}_{word}"
    measure = BOARD_MEASURES[word]
    shown = "temperature" if measure == "temp" else measure
    if three_days:
        name, column = f"{level}_3d_{end}", f"{level}avg_{shown}"
    elif level == "dep":
        name, column = f"dep_{end}_today", shown
    else:
        name, column = f"reg_{end}_today", f"regavg_{word}"
    return Board(name, "department" if level == "dep" else "reg_name", three_days, measure, column, ascending)


LEADERBOARDS = {
    b.name: b
    for level in ("dep", "reg")
    for three_days, ascending, words in (
        (True, True, BOTTOM_3D), (True, False, TOP_3D), (False, True, BOTTOM_TODAY), (False, False, TOP_TODAY),
    )
    for b in (_board(level, word, three_days, ascending) for word in words)
}


def leaderboard(name: str, rows: DataFrame, k: int = 3) -> DataFrame:
    """A leaderboard over `mart_next_3_days` rows (`*_3d_*`) or `mart_today` rows (`*_today`).

    The three-day boards rank the rounded group averages shown by the stats view. One grouped
    aggregate gives them directly, without attaching them to every row first.
    """
    board = LEADERBOARDS[name]
    if board.three_days:
        value = rounded_avg(board.measure, MEASURES[board.measure])
    elif board.key == "reg_name":
        value = rounded_avg(board.measure, 2)
    else:
        shown = rows.select("department", F.col(board.measure).alias(board.column))
        return top_k(shown, board.column, board.ascending, k)
    grouped = rows.groupBy(board.key).agg(value.alias(board.column))
    return top_k(grouped, board.column, board.ascending, k)
