"""Train and evaluate the model of every claim type, merge the evaluations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from billshift import fixed
from billshift.operators.metrics import merge_metrics
from billshift.operators.prep import prepare_training, prepare_training_types, training_of
from billshift.operators.training import train
from billshift.sources.readers import read_table
from billshift.sources.writers import materialise, register_table, write_table


def _prepared(claims: Mapping[str, DataFrame], keys: Sequence[str]) -> dict[str, DataFrame]:
    """Training claims of every type, stored; types that come from one frame are read from it once."""
    prepared = {}
    for kind in fixed.CLAIM_TYPES:
        if kind in prepared:
            continue
        frame = claims[kind]
        shared = [k for k in fixed.CLAIM_TYPES if claims[k] is frame]
        if len(shared) == 1:
            prepared[kind] = materialise(prepare_training(frame, kind, keys), f"training-{kind}")
            continue
        rows = materialise(prepare_training_types(frame, shared, keys), "training", [fixed.CLAIM_TYPE])
        prepared |= {k: training_of(rows, k, keys) for k in shared}
    return prepared


def train_all(
    spark: SparkSession,
    claims: Mapping[str, DataFrame],
    root: str,
    keys: Sequence[str] | None = None,
    table: str | None = None,
    portable: bool = False,
) -> DataFrame:
    """``claims``: raw training claims per claim type. Returns the merged evaluation.

    Types given the same frame are prepared in one read of it and stored by type.

    Models go to ``root/<folder>/trainedpipeline``, evaluations to
    ``root/evaluation/<type>`` and ``root/evaluation/merged``, which is registered
    as ``table`` if named. ``keys``: columns of a key-hash split, by md5 if ``portable``.
    """
    paths = []
    prepared = _prepared(claims, keys or ())
    for kind in fixed.CLAIM_TYPES:
        path = f"{root.rstrip('/')}/evaluation/{kind}"
        train(prepared[kind], kind, root, path, keys, portable=portable, stored=True)
        paths.append(path)
    merged_path = f"{root.rstrip('/')}/evaluation/merged"
    write_table(merge_metrics([read_table(spark, p) for p in paths]), merged_path)
    if table is not None:
        register_table(spark, table, merged_path)
    return read_table(spark, merged_path)
