"""Preparing claims for training and scoring."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billshift import fixed


def claims_of_type(df: DataFrame, kind: str) -> DataFrame:
    """Claims of one type. Apply it before ``blank_to_token``, so the scan gets it."""
    return df.where(F.col(fixed.CLAIM_TYPE) == kind)


def blank_to_token(df: DataFrame, token: str = fixed.BLANK_TOKEN) -> DataFrame:
    """Exactly empty strings become ``token`` in every string column; nulls stay."""
    return df.na.replace("", token)


def as_label(df: DataFrame, column: str = fixed.AMOUNT) -> DataFrame:
    return df.withColumnRenamed(column, "label")


def upper_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.upper() for c in df.columns])


def scoring_columns(kind: str) -> list[str]:
    """Columns kept for scoring: 14 for B and DME, 20 for A."""
    if kind != "A":
        return [fixed.PROVIDER, fixed.SERVICE_DATE, *fixed.code_columns(kind), fixed.AMOUNT]
    return [
        fixed.PROVIDER,
        fixed.EDUCATION_DATE,
        fixed.STATE,
        fixed.SERVICE_DATE,
        fixed.AMOUNT,
        *fixed.code_columns("B")[1:],
        *fixed.NUMBERED_PROCEDURES,
    ]


def project_claims(df: DataFrame, kind: str) -> DataFrame:
    return df.select(*scoring_columns(kind))


def prepare_training(df: DataFrame, kind: str, keys: Sequence[str] = ()) -> DataFrame:
    """Claims of one type with label; only the model's columns and ``keys`` are read.

    Type A may come as a table of its own without a type column.
    """
    if fixed.CLAIM_TYPE in [c.lower() for c in df.columns]:
        df = claims_of_type(df, kind)
    codes = fixed.code_columns(kind)
    named = as_label(blank_to_token(df.select(*codes, fixed.AMOUNT, *keys)))
    return named.toDF(*[c.upper() for c in codes], "label", *keys)


def prepare_training_types(
    df: DataFrame, kinds: Sequence[str] = tuple(fixed.CLAIM_TYPES), keys: Sequence[str] = ()
) -> DataFrame:
    """Claims of several types with label, from one read of a table that holds them all.

    Has the code columns of all ``kinds``, ``keys`` and the claim type; ``training_of`` gives
    one type's frame. Store it by type (``writers.materialise``) to read types apart.
    """
    codes = list(dict.fromkeys(c for kind in kinds for c in fixed.code_columns(kind)))
    rows = df.where(F.col(fixed.CLAIM_TYPE).isin(*kinds)).select(*codes, fixed.AMOUNT, *keys, fixed.CLAIM_TYPE)
    named = as_label(blank_to_token(rows))
    return named.toDF(*[c.upper() for c in codes], "label", *keys, fixed.CLAIM_TYPE)


def training_of(prepared: DataFrame, kind: str, keys: Sequence[str] = ()) -> DataFrame:
    """``prepare_training`` of one type, out of ``prepare_training_types``."""
    return claims_of_type(prepared, kind).select(*[c.upper() for c in fixed.code_columns(kind)], "label", *keys)


def with_periods(before: DataFrame, after: DataFrame) -> DataFrame:
    """Claims from before and after education as one frame with a ``period``."""
    return before.withColumn("period", F.lit("before")).unionByName(
        after.withColumn("period", F.lit("after"))
    )


def prepare_scoring(claims: DataFrame, kind: str) -> DataFrame:
    """Claims of one type with ``period``, projected for scoring, upper-case names.

    Both periods stay in one frame, so everything after it runs once, not twice.
    """
    if fixed.CLAIM_TYPE in [c.lower() for c in claims.columns]:
        claims = claims_of_type(claims, kind)
    kept = claims.select(*scoring_columns(kind), "period")
    return upper_columns(blank_to_token(kept)).withColumn("CLM_SRC_TYPE", F.lit(kind))
