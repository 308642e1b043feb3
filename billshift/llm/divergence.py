"""Source divergence audit over run-length columns.

For every language, how do the word distributions of its sources differ, and which
terms make a source stand out? Each (language, source) group is a column over the
language's vocabulary: one smoothed share per term. The vocabulary is reordered so that
terms with equal counts everywhere are neighbours, which leaves each column a few
long runs. Two columns are compared by intersecting their run boundaries: within an
intersection both shares are constant, so the divergence there is one value times its
length.

Shares are integers, thousandths of a millionth, so that all arithmetic is exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from billshift.llm.arrays import text_slices
from billshift.operators.ranking import numbered
from billshift.sources.writers import materialise

#: Documents of a language that a kept term occurs in at least.
LEAST_DOCS = 3
#: Shares are counted in this part of one.
UNIT = 1_000_000_000
#: Terms listed per group.
TERMS = 200
#: Cells (terms times sources) of one segment of a language's vocabulary at most.
SEGMENT_CELLS = 1 << 20

#: What separates terms, after A-Z became a-z.
_GAP = r"[\x00-\x60\x7B-\x7F]+"


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of each (lang, source, term), one row a slice of texts.

    A row of the input is a document.
    """
    for batch in batches:
        for part in text_slices(batch):
            groups = [pc.fill_null(part.column(c), "").dictionary_encode() for c in ("lang", "source")]
            words = pc.split_pattern_regex(pc.ascii_lower(part.column("text")), _GAP)
            flat, sizes = words.flatten(), np.diff(words.offsets.to_numpy())
            terms = flat.dictionary_encode()
            ids = terms.indices.to_numpy().astype(np.int64)
            wide = max(len(terms.dictionary), 1)
            row = np.repeat(np.arange(part.num_rows, dtype=np.int64), sizes)
            ids, row = (x[pc.not_equal(flat, "").to_numpy(zero_copy_only=False)] for x in (ids, row))
            in_row, counts = np.unique(row * wide + ids, return_counts=True)
            n_sources = max(len(groups[1].dictionary), 1)
            of_row = groups[0].indices.to_numpy().astype(np.int64) * n_sources + groups[1].indices.to_numpy()
            group = of_row[in_row // wide]
            cells, at = np.unique(group * wide + in_row % wide, return_inverse=True)
            n = np.bincount(at, weights=counts, minlength=len(cells)).astype(np.int64)
            n_docs = np.bincount(at, minlength=len(cells))
            lang, source = np.divmod(cells // wide, n_sources)
            yield pa.RecordBatch.from_arrays(
                [
                    groups[0].dictionary.take(pa.array(lang)),
                    groups[1].dictionary.take(pa.array(source)),
                    terms.dictionary.take(pa.array(cells % wide)),
                    pa.array(n, pa.int64()),
                    pa.array(n_docs, pa.int64()),
                ],
                names=["lang", "source", "term", "n", "n_docs"],
            )


def term_counts(docs: DataFrame) -> DataFrame:
    """``lang, source, term, n, n_docs``: occurrences, and documents with the term.

    Counted per slice of texts and again per task before the shuffle, so a frequent
    term or a source with a third of all rows is one small row per task.
    """
    counted = docs.select("lang", "source", "text").mapInArrow(
        _term_counts, "lang string, source string, term string, n long, n_docs long"
    )
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("n_docs").alias("n_docs"))


def share(count: str, total: str, size: str) -> Column:
    """``1 + floor(UNIT * (count + 1) / (total + size))`` of long columns, exact for any long."""
    wide = "decimal(20,0)"
    return F.expr(f"1 + ({UNIT}BD * (cast({count} AS {wide}) + 1)) div (cast({total} AS {wide}) + {size})")


def gap(p: str, q: str) -> Column:
    """``floor((p - q) * (p - q) / q)``: shares are at most ``UNIT + 1``, so squares fit a long."""
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div {q}")


def runs(column: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Run-length encoding: where runs of equal values start, and their values."""
    if len(column) == 0:
        return np.zeros(0, np.int64), column
    starts = np.concatenate([[0], np.flatnonzero(np.diff(column)) + 1])
    return starts, column[starts]


def divergences(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], length: int) -> tuple[int, int]:
    """Sum of ``floor((p - q)^2 / q)`` over two run-length columns, against b and against a."""
    starts = np.union1d(a[0], b[0])
    lengths = np.diff(np.append(starts, length))
    p = a[1][np.searchsorted(a[0], starts, side="right") - 1]
    q = b[1][np.searchsorted(b[0], starts, side="right") - 1]
    square = (p - q) * (p - q)
    return int((square // q * lengths).sum()), int((square // p * lengths).sum())


def _compare(table: pa.Table) -> pa.Table:
    """All pairs of sources over one segment of a language's vocabulary."""
    names = table.column("source").combine_chunks().dictionary_encode()
    source = names.indices.to_numpy()
    place, p = (table.column(c).to_numpy() for c in ("place", "p"))
    length = int(table.column("length")[0].as_py())
    columns = []
    order = np.argsort(source, kind="stable")
    ends = np.cumsum(np.bincount(source, minlength=len(names.dictionary)))
    for rows in np.split(order, ends[:-1]):
        # The header row of a source tells its share of terms that it does not have.
        head = place[rows] < 0
        column = np.full(length, p[rows][head][0], np.int64)
        column[place[rows][~head]] = p[rows][~head]
        columns.append(runs(column))
    left, right, values = [], [], []
    for i in range(len(columns)):
        for j in range(i):
            forth, back = divergences(columns[i], columns[j], length) if length else (0, 0)
            left += [i, j]
            right += [j, i]
            values += [forth, back]
    return pa.table(
        {
            "lang": pa.array([table.column("lang")[0].as_py()] * len(left), pa.string()),
            "source": names.dictionary.take(pa.array(left, pa.int64())),
            "item": names.dictionary.take(pa.array(right, pa.int64())),
            "value": pa.array(values, pa.int64()),
        }
    )


def vocabulary(counts: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """Kept terms: ``lang, term, lang_n, place``, equal columns of counts side by side.

    ``place`` runs from 0 in every language, in the order of the total and of a hash of
    all (source, count): terms with the same counts everywhere are neighbours, and
    within a total mostly one column changes. The hash is merged by exclusive or, so a
    term's counts are never gathered.
    """
    terms = counts.groupBy("lang", "term").agg(
        F.sum("n").alias("lang_n"),
        F.sum("n_docs").alias("n_docs"),
        F.bit_xor(F.xxhash64("source", "n")).alias("alike"),
    )
    kept = terms.where(F.col("n_docs") >= least_docs).drop("n_docs")
    ordered = numbered(kept, ["lang", "lang_n", "alike", "term"], "place", within=["lang"])
    return materialise(ordered.drop("alike"), "divergence-vocabulary")


def audit(
    docs: DataFrame, least_docs: int = LEAST_DOCS, terms: int = TERMS, segment_cells: int = SEGMENT_CELLS
) -> DataFrame:
    """``lang, source, part, item, value, rank`` for every (lang, source) group of ``docs``.

    Reads ``text, lang, source``; a null counts as empty text or name, other columns
    don't matter. Part ``pair``: the divergence from each other source of the language
    over all kept terms. Part ``term``: up to ``terms`` kept terms that are more frequent
    in the group than in its language. Ranks go by value downwards and then by item;
    items of a group differ, so there are no ties. Repeated rows are documents of their
    own. A language without kept terms has pairs of value 0; a group alone in its language
    has no pairs; an empty table gives an empty one.
    """
    counts = materialise(term_counts(docs), "divergence-counts")
    kept = vocabulary(counts, least_docs)
    cells = counts.drop("n_docs").join(kept, ["lang", "term"])
    name = {c: F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source")}
    totals = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    of_lang = kept.groupBy("lang").agg(F.count("*").alias("size"), F.sum("lang_n").alias("lang_total"))
    found = docs.select(*name.values()).distinct()
    groups = (
        found.join(found.groupBy("lang").agg(F.count("*").alias("sources")), "lang")
        .join(totals, ["lang", "source"], "left")
        .join(of_lang, "lang", "left")
        .na.fill(0, ["total", "size", "lang_total"])
    )
    groups = groups.withColumn("step", F.expr(f"greatest({segment_cells} div sources, 1)"))
    groups = materialise(groups, "divergence-groups")
    shares = cells.join(groups, ["lang", "source"]).select(
        "lang", "source", "term", "place", "step", "size",
        share("n", "total", "size").alias("p"), share("lang_n", "lang_total", "size").alias("q"),
    )
    shares = materialise(shares, "divergence-shares")

    above = shares.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), gap("p", "q").alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    # A limit on row_number is applied in every task before the shuffle, too.
    top = above.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= terms)

    segment = F.expr("place div step")
    heads = groups.select(
        "lang", "source", "size", "step",
        F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.expr("(size + step - 1) div step"), F.lit(1)) - 1)).alias("segment"),
        F.lit(-1).cast("long").alias("place"),
        F.when(F.col("size") > 0, share("0", "total", "greatest(size, 1)")).otherwise(F.lit(1)).alias("p"),
    )
    columns = shares.select(
        "lang", "source", "size", "step", segment.alias("segment"), F.expr("place % step").alias("place"), "p"
    ).unionByName(heads)
    columns = columns.withColumn("length", F.expr("least(step, size - segment * step)")).drop("size", "step")
    parts = columns.groupBy("lang", "segment").applyInArrow(_compare, "lang string, source string, item string, value long")
    pairs = parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(order).alias("rank"))
    return pairs.unionByName(top)
