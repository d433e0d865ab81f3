"""Arithmetic of token budgets for model calls."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values of the stage contract.
OUTPUT_CAP, SIZE_FLOOR, MIN_SAMPLES, RESERVE = 8192, 0.7, 5, 256
STAGES = {
    "outline": (0.3, 4096, True, 36000), "assign": (0.2, 2048, True, 12000), "merge": (0.2, 8192, False, 6000),
    "translate-en": (0.2, 8192, False, 6000), "translate-yue": (0.2, 8192, False, 6000), "summarize": (0.2, 900, False, 20000), "script": (0.35, 8192, False, 8000),
}


def estimate_tokens(size: Column, chars_per_token: float) -> Column:
    return F.when(size == 0, 0).otherwise(F.greatest(F.lit(1), F.floor(size / chars_per_token)).cast("bigint"))


def needed_tokens(expected: Column, chars_per_token: Column | float) -> Column:
    rate = chars_per_token if isinstance(chars_per_token, Column) else F.lit(float(chars_per_token))
    return F.ceil(expected / F.when(rate > 0, rate).otherwise(1.0)) + RESERVE


def max_tokens(expected: Column, chars_per_token: Column | float, samples: Column) -> Column:
    needed = needed_tokens(expected, chars_per_token)
    return F.when((needed > OUTPUT_CAP) | (samples < MIN_SAMPLES), OUTPUT_CAP).otherwise(needed)


def expected_output(union_chars: Column, payload_chars: Column, grafted: Column) -> Column:
    return F.when(grafted, payload_chars).otherwise(F.floor(union_chars)).cast("bigint")


def over_budget(payload_chars: Column, expected: Column, max_input: int, chars_per_token: Column | float) -> Column:
    return (payload_chars > max_input) | (needed_tokens(expected, chars_per_token) > OUTPUT_CAP)


def expansion_factor(stage: Column) -> Column:
    return F.when(stage == "translate-en", 1.6).otherwise(1.1)


def summary_tokens(source_chars: Column, ratio: float = 0.05) -> Column:
    wanted = F.greatest(F.lit(400), F.floor(source_chars * ratio))
    return F.least(F.greatest(F.floor(wanted / 3) + 80, F.lit(256)), F.lit(900)).cast("int")


def script_tokens(source_chars: Column) -> Column:
    return F.least(F.greatest(F.floor(source_chars * 1.8) + RESERVE, F.lit(1024)), F.lit(OUTPUT_CAP)).cast("int")


def backoff_seconds(attempt: int) -> float:
    return min(8.0, 0.5 * 2**attempt)
