"""The daily build: every model under its own name, the marts written, the rest as views."""

from __future__ import annotations

from pyspark.sql import DataFrame

from skylake.plans import marts, staging, views
from skylake.sources.tables import ORDER, materialise, publish_view, store


def build_current(raw_weather_: DataFrame, raw_depcode_: DataFrame, root: str) -> dict[str, DataFrame]:
    """Models over the current raw tables. `mart_newdata_` is written below `root`, so the views read
    files sorted by date and prune columns and row groups."""
    models = {
        "stg_depcode_": staging.stg_depcode_(raw_depcode_),
        "stg_most_recent_weather_": staging.stg_most_recent_weather_(raw_weather_),
    }
    models["int_depcode_"] = staging.int_depcode_(models["stg_depcode_"])
    models["int_most_recent_weather_"] = staging.int_most_recent_weather_(models["stg_most_recent_weather_"])
    mart = marts.mart_newdata_(models["int_most_recent_weather_"], models["int_depcode_"], order=ORDER)
    mart, first_day = store(mart, f"{root}/mart_newdata_", ordered=True)
    models["mart_newdata_"] = mart
    models["mart_today"] = today = views.mart_today(mart, first_day)
    models["mart_next_3_days"] = following = views.mart_next_3_days(mart, first_day)
    models["mart_today_stats"] = views.mart_today_stats(today)
    models["mart_next_3_days_stats"] = views.mart_next_3_days_stats(following)
    for name, board in views.LEADERBOARDS.items():
        models[name] = views.leaderboard(name, following if board.three_days else today)
    return {name: publish_view(df, name) for name, df in models.items()}


def build_landed(raw_weather: DataFrame, raw_depcode: DataFrame, root: str, best_only: bool = False) -> dict[str, DataFrame]:
    """Models over the landed raw tables, up to the tolerant mart that feeds the archive."""
    models = {
        "stg_depcode": staging.stg_depcode(raw_depcode),
        "stg_most_recent_weather": staging.stg_most_recent_weather(raw_weather),
    }
    models["int_depcode"] = staging.int_depcode(models["stg_depcode"])
    models["int_most_recent_weather"] = staging.int_most_recent_weather(models["stg_most_recent_weather"])
    mart = marts.mart_newdata(models["int_most_recent_weather"], models["int_depcode"], best_only, order=ORDER)
    models["mart_newdata"] = materialise(mart, f"{root}/mart_newdata", ordered=True)
    return {name: publish_view(df, name) for name, df in models.items()}
