"""A split whose sides have exact sizes and depend on the rows' keys only."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from billshift.functions.names import unused
from billshift.sources.writers import materialise

#: Hex digits of the hash that one round decides: a group has at most 16^4 counts.
DIGITS = 4
HASH_DIGITS = 32


def key_hash(keys: Sequence[str]) -> Column:
    """md5 of the ``|``-joined keys, as any engine can compute it."""
    return F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys]))


def cut_hashes(df: DataFrame, hashed: str, by: Sequence[str], percent: int) -> DataFrame:
    """``by, cut``: per group the hash that ``percent`` (rounded down) of its rows do not exceed.

    An order statistic by radix selection: count the rows by the hash's first digits, find
    the digits within which the wanted row lies, go on among these rows alone. Two or three
    counts find it among millions of rows; nothing is sorted, and the counts are taken
    per task before the shuffle, however large a group is.
    """
    # Names that no group column has.
    before, prefix, wanted, n, upto = (unused([*by, hashed, "cut"], x) for x in ("before", "prefix", "wanted", "n", "upto"))
    open_ = df.groupBy(*by).agg(F.expr(f"count(*) * {int(percent)} div 100").alias(wanted))
    open_ = open_.select(*by, wanted, F.lit("").alias(prefix), F.lit(0).cast("long").alias(before))
    done = None
    for digits in range(DIGITS, HASH_DIGITS + 1, DIGITS):
        open_ = materialise(open_, "split-open")
        head = F.substring(hashed, 1, digits)
        keys = [unused([*df.columns, wanted, before], f"_by{i}") for i in range(len(by))]
        if by:
            groups = open_.toDF(*keys, wanted, prefix, before)
            same = head.startswith(F.col(prefix))
            for column, key in zip(by, keys):
                same = same & F.col(column).eqNullSafe(F.col(key))
            # One row per group; Spark broadcasts them while they are few by size.
            marked = df.join(groups, same)
        else:
            one = open_.first()
            marked = df.where(head.startswith(F.lit(one[prefix])))
            marked = marked.withColumns({wanted: F.lit(one[wanted]), before: F.lit(one[before])})
        inside = marked.groupBy(*keys, wanted, before, head.alias(prefix)).agg(F.count("*").alias(n))
        order = Window.partitionBy(*keys).orderBy(prefix)
        reached = inside.withColumn(upto, F.col(before) + F.sum(n).over(order))
        reached = reached.where((F.col(upto) >= F.col(wanted)) & (F.col(upto) - F.col(n) < F.col(wanted)))
        reached = materialise(reached.toDF(*by, wanted, before, prefix, n, upto), "split-reached")
        last = (F.col(upto) == F.col(wanted)) | F.lit(digits == HASH_DIGITS)
        # Beyond every hash with these first digits, as "g" comes after "f".
        found = reached.where(last).select(*by, F.concat(prefix, F.lit("g")).alias("cut"))
        done = found if done is None else done.unionByName(found)
        open_ = reached.where(~last).select(*by, wanted, prefix, (F.col(upto) - F.col(n)).alias(before))
        if open_.isEmpty():
            break
    return done


def exact_split(
    df: DataFrame, keys: Sequence[str], by: Sequence[str] = (), train_percent: int = 70
) -> tuple[DataFrame, DataFrame]:
    """Split each group of ``by`` exactly: ``train_percent`` of its rows, rounded down, and the rest.

    The rows with the smallest key hashes are the training side, whatever the partitioning
    and whenever a lost partition is computed again. Rows with equal keys stay on one
    side, so sizes are exact to a row where keys are distinct. Null groups are groups.
    Rows are not shuffled for the split: each looks up its group's cut.
    """
    hashed = unused(df.columns, "_hash")
    rows = df.withColumn(hashed, key_hash(keys))
    narrow = materialise(rows.select(*by, hashed), "split-keys")
    cuts = cut_hashes(narrow, hashed, by, train_percent)
    if not by:
        found = cuts.first()
        train = F.col(hashed) < (found["cut"] if found else "")
        return rows.where(train).select(*df.columns), rows.where(~train).select(*df.columns)
    cut = unused([*df.columns, hashed], "_cut")
    names = [unused([*df.columns, hashed, cut], f"_group{i}") for i in range(len(by))]
    cuts = materialise(cuts.toDF(*names, cut), "split-cuts")
    same = reduce(lambda a, b: a & b, [F.col(column).eqNullSafe(F.col(name)) for column, name in zip(by, names)])
    # A group too small for a training row has no cut.
    marked = rows.join(cuts, same, "left")
    train = F.coalesce(F.col(hashed) < F.col(cut), F.lit(False))
    return marked.where(train).select(*df.columns), marked.where(~train).select(*df.columns)
