"""Continuous loads with Structured Streaming.

New invoice files arrive in a folder; each micro-batch runs the same batch
load (clean -> resolve codes -> key -> cells -> append to the cell table).
``foreachBatch`` gives every micro-batch a static DataFrame, so the batch plan
(broadcast or shuffle lookups, staged keys) is reused unchanged.

Delivery: an epoch's time stamp is recorded beside the stream's checkpoint
before its first write, and cells and rejects go to a batch named by the
stream's id and the epoch, which a replay replaces. So a micro-batch that is replayed after a
failure leaves the same cells, stamps and rejects as one that ran once (unless
the lookup tables changed in between), and no stream touches a batch of another
one or of a load. The id is the one that Spark keeps in the checkpoint: it stays over
restarts, and a new checkpoint is a new stream. The checkpoint tracks consumed files.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..plans import store


def read_stream(spark: SparkSession, folder: str, schema, file_glob: str | None = None,
                max_files_per_trigger: int | None = None, recursive: bool = False) -> DataFrame:
    """Parquet files arriving in ``folder`` as a stream (optionally only names matching ``file_glob``)."""
    r = spark.readStream.schema(schema)
    if recursive:
        r = r.option("recursiveFileLookup", "true")
    if file_glob:
        r = r.option("pathGlobFilter", file_glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(folder)


def epoch_stamp(spark: SparkSession, checkpoint: str, epoch_id: int) -> dt.datetime:
    """The time stamp of an epoch: recorded when it first runs, read when it is replayed."""
    path = f"{checkpoint}/wideflow-epochs/epoch={epoch_id}"
    try:
        if row := spark.read.schema("ts timestamp_ntz").parquet(path).first():
            return row["ts"]
    except AnalysisException:
        pass  # never recorded
    stamp = store.now_utc()
    spark.createDataFrame([(stamp,)], "ts timestamp_ntz").coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
    return stamp


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id of the stream that owns a checkpoint, as Spark recorded it when the stream first started."""
    return spark.read.schema("id string").json(f"{checkpoint}/metadata").first()["id"].replace("-", "")


def epoch_batch(owner: str, epoch_id: int) -> tuple[str, int]:
    """Name and sequence number of an epoch's batch: both tell streams apart, and epochs of one stream keep their order."""
    return f"s{owner}e{epoch_id}", (int(owner[:7], 16) << 32) + epoch_id


#: Spark removes the shuffle files of each execution when it ends.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """A stream that starts meanwhile (it copies the session's settings) removes its shuffle files after each epoch, as it holds on to
    its last plan: else they lie beside those of its readers. A value set by the caller stays; the session keeps its own."""
    if spark.conf.get(DROP_SHUFFLES, None) is not None:
        yield
        return
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.unset(DROP_SHUFFLES)


def drop_shuffles(epoch: DataFrame) -> None:
    """Removes the shuffle files that an epoch's rows come from, once nothing reads these any more."""
    sc = epoch.sparkSession.sparkContext._jsc.sc()
    if sc.cleaner().isEmpty():  # switched off
        return
    plan, seen = [epoch._jdf.queryExecution().toRdd()], set()
    while plan:
        rdd = plan.pop()
        if rdd.id() in seen:
            continue
        seen.add(rdd.id())
        needs = rdd.dependencies()
        for need in map(needs.apply, range(needs.size())):
            if need.getClass().getSimpleName() == "ShuffleDependency":
                sc.cleaner().get().doCleanupShuffle(need.shuffleId(), False)
            plan.append(need.rdd())


def _start(stream: DataFrame, load: Callable[..., None], checkpoint: str, available_now: bool, processing_time: str | None) -> StreamingQuery:
    """Runs ``load(rows, run_ts=, seq=, batch=, replace=)`` for every micro-batch."""
    def batch(df: DataFrame, epoch_id: int) -> None:
        name, seq = epoch_batch(stream_id(df.sparkSession, checkpoint), epoch_id)
        load(df, run_ts=epoch_stamp(df.sparkSession, checkpoint, epoch_id), seq=seq, batch=name, replace=True)
    w = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    with _shuffles_dropped(stream.sparkSession):
        return w.start()


def start_header_load(stream: DataFrame, by_name: DataFrame, by_tax: DataFrame, year: str,
                      table_path: str, checkpoint: str, rejects_path: str | None = None,
                      layout: str = "put", mode: str = "compat", available_now: bool = False,
                      processing_time: str | None = None) -> StreamingQuery:
    """Stream invoice headers into a cell table (Put-style by default)."""
    def load(df: DataFrame, **batch) -> None:
        store.load_header(df, by_name, by_tax, year, table_path, rejects_path, layout=layout, mode=mode, **batch)
    return _start(stream, load, checkpoint, available_now, processing_time)


def start_detail_load(stream: DataFrame, by_tax: DataFrame, table_path: str, checkpoint: str,
                      rejects_path: str | None = None, layout: str = "put", mode: str = "compat",
                      available_now: bool = False, processing_time: str | None = None) -> StreamingQuery:
    """Stream invoice lines into a cell table."""
    def load(df: DataFrame, **batch) -> None:
        store.load_detail(df, by_tax, table_path, rejects_path, layout=layout, mode=mode, staged=layout == "put",
                          after_staging=lambda: drop_shuffles(df), **batch)
    return _start(stream, load, checkpoint, available_now, processing_time)
