"""Exact deduplication with a stateful stream; DataFrame operations only.

Arrivals (digest, document id, content locator) flow through a streaming
aggregation whose state is kept per digest on disk (RocksDB), without watermark and
so without expiry: an increment that arrives years later still meets it. The state
of a digest holds the largest document id, where that document's bytes are, and how
many have come. Digests that were met more than once are hits; their whole texts
are read by locator and compared byte for byte, so a colliding digest never merges
different texts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from billshift.sources.writers import materialise, scratch_path

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    # One memory bound for all state stores of an executor, instead of one for each.
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "200",
    "spark.sql.streaming.stateStore.rocksdb.writeBufferSizeMB": "2",
    # Between batches the state rests on disk; executors hold no open store of an ended run.
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
    # A batch writes what changed; snapshots follow in the background.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
STATE = "digest string, keeper struct<doc_id:long,file:string,at:long>, n long"
ARRIVAL = "digest string, doc_id long, file string, at long"


def located(docs: DataFrame) -> DataFrame:
    """``docs`` with ``file`` and ``at``, the place of every row's bytes.

    A frame that isn't read from Parquet files is written to the shared folder first.
    """
    if not _has_files(docs):
        docs = materialise(docs.select("doc_id", "text"), "exact-docs")
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), *_place())


def _place() -> list[Column]:
    return [F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at")]


def _has_files(docs: DataFrame) -> bool:
    try:
        docs.select("_metadata.row_index", "_metadata.file_path")
    except AnalysisException:
        return False
    return True


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def deduplicate_stream(spark: SparkSession, arrivals: str, checkpoint: str, states: str) -> None:
    """Bring the keyed state up to date with all files in the folder ``arrivals``.

    Every micro-batch writes the digests it changed to ``states/batch=N``, so a batch
    that is run again after a failure replaces its own output. Called again with the
    same ``checkpoint``, it goes on where it ended and reads new files only.
    """
    session = spark.newSession()
    for key, value in STATE_SETTINGS.items():
        session.conf.set(key, value)
    session.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))

    def write(changed: DataFrame, batch: int) -> None:
        changed.write.mode("overwrite").parquet(f"{states}/batch={batch}")

    stream = session.readStream.schema(ARRIVAL).parquet(arrivals)
    # Partial rows are merged per task before the shuffle: a digest with a third of
    # all rows is one row per task.
    state = stream.groupBy("digest").agg(
        F.max(F.struct("doc_id", "file", "at")).alias("keeper"), F.count("*").alias("n")
    )
    query = (
        state.writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def latest_states(spark: SparkSession, states: str) -> DataFrame:
    """One row per digest: what the last batch that changed it left."""
    rows = spark.read.schema(STATE).parquet(states)
    return rows.groupBy("digest").agg(
        F.max(F.struct("n", "keeper")).alias("last")
    ).select("digest", "last.keeper", "last.n")


def exact_duplicates(
    docs: DataFrame, digest: Callable[[Column], Column] = sha256
) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256, file, at`` for every row of ``docs``.

    Of equal texts the row with the largest doc_id stays; a null text counts as
    empty, a null doc_id as smaller than any. Of rows that share text and doc_id the
    one that lies last stays. Other columns play no part.
    """
    spark = docs.sparkSession
    rows = located(docs)
    root = scratch_path(spark, "exact")
    arrivals, states = f"{root}/arrivals", f"{root}/states"
    keyed = rows.withColumn("digest", digest(F.col("text")))
    # Beside the arrival its text's SHA-256, so that no later step reads texts for it.
    (
        keyed.select("digest", "doc_id", "file", "at", sha256(F.col("text")).alias("text_sha256"))
        .write.parquet(arrivals)
    )
    deduplicate_stream(spark, arrivals, f"{root}/checkpoint", states)
    if _no_batches(spark, states):
        hits_state = spark.createDataFrame([], STATE)
    else:
        hits_state = materialise(latest_states(spark, states).where("n > 1"), "exact-hits")

    # Whole texts of hits only, each beside its keeper's. The sides of these joins grow
    # with the corpus, so both are shuffled at every size, never broadcast.
    texts = keyed.select("digest", "doc_id", "file", "at", "text")
    hits = materialise(texts.join(hits_state.hint("merge"), "digest"), "exact-hit-texts")
    mine = F.struct("doc_id", "file", "at")
    keepers = hits.where(mine.eqNullSafe(F.col("keeper"))).select("digest", F.col("text").alias("kept_text"))
    checked = hits.join(keepers.hint("merge"), "digest").select(
        "digest", "doc_id", "file", "at",
        # Null for the bytes of the keeper, else (a collision) the differing text itself.
        F.when(F.col("text") != F.col("kept_text"), F.col("text")).alias("other"),
    )
    checked = materialise(checked, "exact-checked")
    classes = checked.groupBy("digest", "other").agg(
        F.max(F.struct("doc_id", "file", "at")).alias("best"), F.count("*").alias("group_size")
    )
    same = checked["digest"].eqNullSafe(classes["digest"]) & checked["other"].eqNullSafe(classes["other"])
    decided = checked.join(classes.hint("merge"), same).select(
        checked["file"], checked["at"], "best", "group_size"
    )
    everyone = spark.read.schema(f"{ARRIVAL}, text_sha256 string").parquet(arrivals)
    joined = everyone.join(decided.hint("merge"), ["file", "at"], "left")
    kept = F.col("best").isNull() | F.struct("doc_id", "file", "at").eqNullSafe(F.col("best"))
    return joined.select(
        "doc_id",
        F.when(F.col("best").isNull(), F.col("doc_id")).otherwise(F.col("best.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        kept.alias("kept"),
        "text_sha256",
        "file",
        "at",
    )


def _no_batches(spark: SparkSession, states: str) -> bool:
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(states)
    return not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


def drop_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    if not _has_files(docs):
        docs = materialise(docs, "exact-docs")
    gone = exact_duplicates(docs).where(~F.col("kept")).select("file", "at")
    gone = gone.withColumnsRenamed({"file": "_gone_file", "at": "_gone_at"})
    rows = docs.select("*", *[p.alias(f"_doc{i}") for i, p in enumerate(_place())])
    same = (F.col("_doc0") == F.col("_gone_file")) & (F.col("_doc1") == F.col("_gone_at"))
    return rows.join(gone.hint("merge"), same, "left_anti").select(*docs.columns)
