"""Row and column clean-up of candidate records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hustings.functions.numbers import money, number_or_zero
from hustings.functions.text import strip, title_case

# Texts that stand for "no candidate chosen".
NONE_OF_THE_ABOVE = ["NOTA", "NONE OF THE ABOVE"]


def drop_incomplete(df: DataFrame, columns: list[str]) -> DataFrame:
    """Drop rows lacking any of the columns, such as turnout lines."""
    return df.na.drop(subset=columns)


def drop_none_of_above(df: DataFrame, column: str = "candidate", broad: bool = True) -> DataFrame:
    """Drop the no-candidate option: both spellings in any case, or (``broad=False``) exactly ``NOTA``."""
    if broad:
        return df.where(~F.upper(column).isin(NONE_OF_THE_ABOVE))
    return df.where(F.col(column) != NONE_OF_THE_ABOVE[0])


def with_defaults(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Fill nulls of existing columns and add absent ones."""
    filled = {
        c: F.coalesce(F.col(c), F.lit(v)) if c in df.columns else F.lit(v) for c, v in defaults.items()
    }
    return df.withColumns(filled)


def clean_results(records: DataFrame, broad: bool = True) -> DataFrame:
    """Result records ready for labelling: complete rows, no-candidate option gone, votes numeric, names tidy."""
    complete = drop_incomplete(records, ["candidate", "constituency", "total_votes_raw"])
    return drop_none_of_above(complete, "candidate", broad).withColumns(
        {
            "total_votes": number_or_zero(F.col("total_votes_raw")),
            "state": title_case(F.col("state")),
            "constituency_no": F.col("constituency_no").cast("string"),
        }
    )


def clean_candidates(records: DataFrame) -> DataFrame:
    """Web candidates with numeric features and no missing categories."""
    counts = number_or_zero(F.col("criminal_cases")) if "criminal_cases" in records.columns else F.lit(0.0)
    assets = money(F.col("total_assets")) if "total_assets" in records.columns else F.lit(0.0)
    return with_defaults(
        records.withColumns({"crim_count": counts, "assets_numeric": assets}),
        {"party": "IND", "education": "Unknown", "constituency": "Unknown"},
    )


def tidy_keys(df: DataFrame, columns: list[str]) -> DataFrame:
    """Bring state-like keys of two sources to the same form."""
    return df.withColumns({c: title_case(strip(F.col(c))) for c in columns})
