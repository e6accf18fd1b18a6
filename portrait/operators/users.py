"""User records: birthday decoding, age, zodiac and age band."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portrait.functions.scalars import age_band, birthday_fields, epoch_day

USER_COLUMNS = ["birthday", "birth_year", "name", "ts_ms", "zodiac_sign", "id", "user_level",
                "gender", "age", "create_time", "login_name"]


def enrich_users(user_info: DataFrame, as_of: str) -> DataFrame:
    """Flat user rows (P2) with F1-F4 applied and the age band.

    ``as_of`` is the date ages are counted to (the original used the wall
    clock, which makes a rerun give other answers)."""
    f = birthday_fields("birthday", as_of, "_days")
    days = user_info.withColumn("_days", epoch_day("birthday"))
    return days.select(
        f["birthday"].alias("birthday"), f["birth_year"].alias("birth_year"), "name", "ts_ms",
        f["zodiac_sign"].alias("zodiac_sign"), "id", "user_level", "gender",
        f["age"].alias("age"), "create_time", "login_name",
    ).withColumn("age_group", age_band("age"))
