"""Imputation: IMP1-IMP4.  Means are one aggregate pass producing a
one-row frame, attached to every row as a scalar subquery (evaluated
once, no join, nothing collected)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .aggregates import column_means
from .joins import attach_row, with_defaults  # noqa: F401  (IMP4 re-export)


def impute_means(df: DataFrame, columns: list[str], means_from: DataFrame | None = None) -> DataFrame:
    """IMP1/IMP2: fill nulls of ``columns`` with their null-ignoring mean
    (timestamps by mean epoch millis).  ``means_from`` lets the means come
    from another frame (IMP1 takes them before the range filter); a
    column that is all null stays null."""
    src = means_from if means_from is not None else df
    present = [c for c in columns if c in df.columns]
    j = attach_row(df, column_means(src, present), "_mean")
    return j.select(*[F.coalesce(F.col(c), F.col(f"_mean.{c}")).alias(c) if c in present
                      else F.col(c) for c in df.columns])


def impute_zero(df: DataFrame, columns: list[str]) -> DataFrame:
    """IMP3: nulls (and NaN) of ``columns`` become 0.0."""
    return df.select(*[F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(0.0)), F.lit(0.0)).alias(c)
                       if c in columns else F.col(c) for c in df.columns])
