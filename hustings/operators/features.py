"""Derived features of candidates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hustings.functions.numbers import uniform
from hustings.functions.text import MAJOR_PARTIES_WEB, major_party
from hustings.operators.ordering import exact_median

# Weights and threshold of the stand-in label, its noise seed, and the feature lists.
PROXY_WEIGHTS = (0.5, 0.3, 0.2)
PROXY_THRESHOLD = 0.65
NOISE_SEED = 2026
RESULT_FEATURES = ["party_code", "constituency_code", "state_code", "is_major_party"]
WEB_FEATURES = [
    "crim_count", "assets_numeric", "party_code", "edu_code", "const_code", "state_code", "is_major_party",
]


def add_major_flag(df: DataFrame, names: list[str] | None = None, any_case: bool = True) -> DataFrame:
    return df.withColumn("is_major_party", major_party(F.col("party"), names, any_case))


def above_median(df: DataFrame, column: str) -> DataFrame:
    """Add ``above``: whether the value exceeds the exact median over all rows."""
    return df.withColumn("above", F.col(column) > exact_median(df, column).scalar())


def proxy_label(df: DataFrame, row_key: Column, assets: str = "assets_numeric", flag: str = "is_major_party") -> DataFrame:
    """Add ``proxy``, a stand-in label: major party, wealth above the median and a little noise, over a threshold."""
    w_major, w_wealth, w_noise = PROXY_WEIGHTS
    score = (
        F.col(flag) * F.lit(w_major)
        + F.col("above").cast("int") * F.lit(w_wealth)
        + uniform(row_key, NOISE_SEED) * F.lit(w_noise)
    )
    return above_median(df, assets).withColumn("proxy", (score > F.lit(PROXY_THRESHOLD)).cast("int")).drop("above")


def risk_flag(count: Column) -> Column:
    return F.coalesce((count > 0).cast("int"), F.lit(0))


def risk_band(count: Column, bands: list[tuple[float, str]] | None = None) -> Column:
    """Category of a case count: the name of the highest band whose lower limit it reaches, else ``none``."""
    bands = bands or [(1, "low"), (3, "medium"), (6, "high")]
    band = F.lit("none")
    for limit, name in sorted(bands):
        band = F.when(count >= limit, F.lit(name)).otherwise(band)
    return band


def add_web_flags(df: DataFrame) -> DataFrame:
    """The web variant: exact case and the shorter list of names."""
    return add_major_flag(df, MAJOR_PARTIES_WEB, any_case=False)
