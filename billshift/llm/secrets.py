"""Secret scan with corpus-wide ownership frequency.

Patterns find candidates in every text. The hash of each candidate value is then
counted over the corpus, by distinct repositories and distinct owners: a value that
many owners hold is a copied example, one that stays with few owners looks live.
Tokens without a telling context (``bare``) are reported only where they look live.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from billshift.llm.arrays import text_slices
from billshift.sources.writers import materialise

# Patterns and least lengths of the base kinds.
ASSIGN = re.compile(
    r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ASSIGN_LEAST = 8
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ACCESS_LEAST = 16
HEX = re.compile(r"[0-9a-f]+")
HEX_LEAST = 32
KINDS = ("assign", "access", "hex", "bare")

#: Runs of so many token characters with upper and lower case letters, digits and
#: this entropy (bits a character) are bare candidates.
BARE = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{24,}")
BARE_ENTROPY = 3.5
#: From so many distinct owners on a value counts as copied.
COPIED_OWNERS = 3

# Same matches as HEX with its least length: runs that are too short never start one.
_LONG_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{%d,}" % HEX_LEAST)

_SCANNED = (
    "row_id long, doc_id long, repository string, owner string, n_assign long, n_access long, "
    "n_hex long, base_sha256 string, found array<struct<kind:int,start:int,end:int,value:long>>"
)


def _value(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode(), digest_size=8).digest(), "big", signed=True)


def _random_looking(token: str) -> bool:
    if not (re.search("[a-z]", token) and re.search("[A-Z]", token) and re.search("[0-9]", token)):
        return False
    n = len(token)
    return -sum(c / n * math.log2(c / n) for c in Counter(token).values()) >= BARE_ENTROPY


def candidates(text: str) -> list[tuple[int, int, int, int]]:
    """(kind, start, end, value hash) of all candidates, by start and kind."""
    found = [
        (0, m.start(), m.end(), _value(m[1])) for m in ASSIGN.finditer(text) if len(m[1]) >= ASSIGN_LEAST
    ]
    found += [
        (1, m.start(), m.end(), _value(m[0])) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LEAST
    ]
    found += [(2, m.start(), m.end(), _value(m[0])) for m in _LONG_HEX.finditer(text)]
    base = list(found)
    for m in BARE.finditer(text):
        if _random_looking(m[0]) and not any(s < m.end() and m.start() < e for _, s, e, _ in base):
            found.append((3, m.start(), m.end(), _value(m[0])))
    return sorted(found, key=lambda x: (x[1], x[0]))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind_type = pa.list_(
        pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("value", pa.int64())])
    )
    for batch in batches:
        for part in text_slices(batch):
            found = [candidates(t) for t in part.column("text").to_pylist()]
            base = [[x for x in row if x[0] < 3] for row in found]
            digest = [
                hashlib.sha256(",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e, _ in row).encode()).hexdigest()
                for row in base
            ]
            counts = [
                pa.array([sum(x[0] == k for x in row) for row in base], pa.int64()) for k in range(3)
            ]
            spans = pa.array(
                [[dict(zip(("kind", "start", "end", "value"), x)) for x in row] for row in found], kind_type
            )
            kept = [part.column(c) for c in ("row_id", "doc_id", "repository", "owner")]
            yield pa.RecordBatch.from_arrays(
                [*kept, *counts, pa.array(digest, pa.string()), spans],
                names=[
                    "row_id", "doc_id", "repository", "owner", "n_assign", "n_access", "n_hex",
                    "base_sha256", "found",
                ],
            )


def scan(docs: DataFrame, repository: Column, owner: Column, copied_owners: int = COPIED_OWNERS) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_assign, n_access, n_hex, base_sha256,
    spans, n_live, n_copied, findings``.

    ``findings``: structs of kind, start, end, n_repositories, n_owners, copied, by
    start and kind. A null text counts as empty, a null repository or owner as one of
    its own kind. ``row_id`` tells rows with equal doc_id apart.
    """
    rows = docs.select(
        F.monotonically_increasing_id().alias("row_id"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(repository.cast("string"), F.lit("")).alias("repository"),
        F.coalesce(owner.cast("string"), F.lit("")).alias("owner"),
        "text",
    )
    scanned = materialise(rows.mapInArrow(_scan, _SCANNED), "secrets-scan")
    found = scanned.where(F.size("found") > 0).select(
        "row_id", "repository", "owner", F.explode("found").alias("c")
    ).select("row_id", "repository", "owner", "c.*")
    # Distinct (value, owner, repository) first: what one repository repeats, or a value
    # in a third of all texts, shrinks per task before each shuffle.
    holders = found.select("value", "owner", "repository").distinct()
    by_owner = holders.groupBy("value", "owner").agg(F.count("*").alias("repositories"))
    spread = by_owner.groupBy("value").agg(
        F.sum("repositories").alias("n_repositories"), F.count("*").alias("n_owners")
    )
    judged = found.join(spread.hint("merge"), "value").withColumn("copied", F.col("n_owners") >= copied_owners)
    judged = judged.where((F.col("kind") < 3) | ~F.col("copied"))
    per_row = judged.groupBy("row_id").agg(
        F.array_sort(
            F.collect_list(F.struct("start", "kind", "end", "n_repositories", "n_owners", "copied"))
        ).alias("findings")
    )
    names = F.array(*[F.lit(k) for k in KINDS])
    name = lambda x: F.element_at(names, x["kind"] + 1)
    out = scanned.drop("found").join(per_row.hint("merge"), "row_id", "left")
    findings = F.coalesce("findings", F.array().cast(per_row.schema["findings"].dataType))
    return out.withColumn("findings", findings).select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256",
        F.array_join(F.transform("findings", lambda x: F.concat_ws(":", name(x), x["start"], x["end"])), ",").alias("spans"),
        F.size(F.filter("findings", lambda x: ~x["copied"])).cast("long").alias("n_live"),
        F.size(F.filter("findings", lambda x: x["copied"])).cast("long").alias("n_copied"),
        "findings",
    )
