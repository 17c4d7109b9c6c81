"""Scalar column expressions (projection/filter helpers, P1-P16).

All are built-in Catalyst expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# P1 ---------------------------------------------------------------------------------------
NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def columns_by_type(df: DataFrame, numeric: bool = True, exclude: tuple[str, ...] = ()) -> list[str]:
    """Column names selected from the schema (metadata only, no job)."""
    out = []
    for f in df.schema.fields:
        if f.name in exclude:
            continue
        is_num = isinstance(f.dataType, NUMERIC_TYPES)
        if is_num == numeric:
            out.append(f.name)
    return out


def columns_by_prefix(df: DataFrame, prefix: str) -> list[str]:
    return [c for c in df.columns if c.startswith(prefix)]


def require_columns(df: DataFrame, required: list[str] | tuple[str, ...]) -> None:
    """Column guard: raise when required columns are absent (schema check, no job)."""
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"Missing columns: {missing}")


# P4 / P5 / P6 / P16 -------------------------------------------------------------------------
def parse_dmy(c: str | Column) -> Column:
    """dd-MM-yyyy text to date; unparseable text gives NULL (quarantine upstream)."""
    return F.to_date(F.try_to_timestamp(col(c), F.lit("dd-MM-yyyy")))


def calendar_parts(date_col: str | Column, prefix: str = "") -> list[Column]:
    """year, month, quarter and ISO week (paired with the calendar year, as the source does)."""
    d = col(date_col)
    return [
        F.year(d).alias(f"{prefix}year"),
        F.month(d).alias(f"{prefix}month"),
        F.quarter(d).alias(f"{prefix}quarter"),
        F.weekofyear(d).alias(f"{prefix}week_of_year"),
    ]


def cyclic_week(week_col: str | Column, period: float = 52.0) -> list[Column]:
    w = col(week_col)
    return [
        F.sin(F.lit(2 * math.pi) * w / period).alias("week_sin"),
        F.cos(F.lit(2 * math.pi) * w / period).alias("week_cos"),
    ]


def iso_date(c: str | Column) -> Column:
    return F.date_format(col(c), "yyyy-MM-dd")


# P8 ---------------------------------------------------------------------------------------
def level_bucket(x: str | Column, lo: Column | float, hi: Column | float) -> Column:
    """Low / Moderate / High with strict comparisons against the cuts."""
    v = col(x)
    return F.when(v < lo, "Low").when(v > hi, "High").otherwise("Moderate")


# P9 ---------------------------------------------------------------------------------------
def safe_name(c: str | Column, max_len: int = 38) -> Column:
    """lower-case, spaces and slashes to underscores, sliced."""
    s = F.lower(col(c))
    s = F.regexp_replace(s, "[ /]", "_")
    return F.substring(s, 1, max_len)


# P10 / P11 / P12 --------------------------------------------------------------------------
def clip(c: str | Column, lo: float | None = None, hi: float | None = None) -> Column:
    v = col(c)
    if lo is not None:
        v = F.greatest(v, F.lit(lo))
    if hi is not None:
        v = F.least(v, F.lit(hi))
    return v


def guarded_divide(num: str | Column, den: str | Column, default: float = 0.0) -> Column:
    d = col(den)
    return F.when(d > 0, col(num) / d).otherwise(F.lit(default))


def residual(actual: str | Column, predicted: str | Column) -> Column:
    return col(actual) - col(predicted)


# P7 ---------------------------------------------------------------------------------------
def sensor_features(
    air: str = "air_temperature_k",
    process: str = "process_temperature_k",
    rpm: str = "rotational_speed_rpm",
    torque: str = "torque_nm",
    wear: str = "tool_wear_min",
) -> list[Column]:
    """Derived sensor features, one definition shared by training and serving."""
    return [
        (F.col(process) - F.col(air)).alias("temperature_difference_k"),
        (F.col(rpm) * 2 * math.pi / 60 * F.col(torque)).alias("mechanical_power_w"),
        (F.col(torque) * F.col(wear)).alias("tool_stress"),
        F.try_divide(F.col(torque), F.col(rpm)).alias("torque_speed_ratio"),
    ]


# P13 --------------------------------------------------------------------------------------
# Decision labels of the scoring response.
DECISION_ALARM = "maintenance_required"
DECISION_NORMAL = "normal_operation"


def alarm_decision(prob: str | Column, threshold: float | Column) -> list[Column]:
    """Clip to [0,1], compare with >=, then round to 6 dp (rounding after thresholding)."""
    p = F.least(F.greatest(col(prob), F.lit(0.0)), F.lit(1.0))
    alarm = p >= threshold
    return [
        F.round(p, 6).alias("failure_probability"),
        F.lit(threshold).cast("double").alias("alarm_threshold") if not isinstance(threshold, Column) else threshold.alias("alarm_threshold"),
        alarm.alias("machine_failure_alarm"),
        F.when(alarm, DECISION_ALARM).otherwise(DECISION_NORMAL).alias("decision"),
    ]


# P14 --------------------------------------------------------------------------------------
def poly2(cols: list[str]) -> list[Column]:
    """Degree-2 expansion without bias: x_i and x_i*x_j for i<=j."""
    out = [F.col(c) for c in cols]
    for i, a in enumerate(cols):
        for b in cols[i:]:
            out.append((F.col(a) * F.col(b)).alias(f"{a}*{b}"))
    return out


# P15 --------------------------------------------------------------------------------------
def params_json(params: dict) -> Column:
    """JSON of a parameter dict with sorted keys."""
    return F.to_json(F.struct(*[F.lit(params[k]).alias(k) for k in sorted(params)]))
