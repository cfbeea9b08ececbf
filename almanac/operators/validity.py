"""Physical range rules as three-valued flags."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class RangeRule:
    """Values outside [low, high] raise ``flag``; NULL stays unknown, NaN counts as too large."""

    flag: str
    column: str
    low: float
    high: float

    def expression(self) -> Column:
        value = F.col(self.column)
        return (value < F.lit(float(self.low))) | (value > F.lit(float(self.high)))


# What a weather reading can physically be.
WEATHER_RULES = (
    RangeRule("invalid_temperature", "temperature_c", -10, 60),
    RangeRule("invalid_humidity", "humidity_pct", 0, 100),
    RangeRule("invalid_rain", "rain_mm", 0, 1000),
    RangeRule("invalid_wind_speed", "wind_speed_ms", 0, 80),
)


COMBINED = "is_quality_anomaly"
FLAGS = [*[r.flag for r in WEATHER_RULES], COMBINED]


def with_flags(df: DataFrame, rules=WEATHER_RULES, combined: str = COMBINED) -> DataFrame:
    """One flag per rule, and one that is TRUE if any is TRUE, else NULL if any is NULL."""
    flagged = df.withColumns({r.flag: r.expression() for r in rules})
    return flagged.withColumn(combined, reduce(or_, [F.col(r.flag) for r in rules]))


def valid_only(df: DataFrame, combined: str = COMBINED) -> DataFrame:
    """Rows known to be valid; an unknown (NULL) flag does not pass."""
    return df.filter(~F.col(combined))
