"""Structured Streaming over a landing folder of envelope files."""

from __future__ import annotations

import hashlib
import logging
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sightline.plans.intake import MAX_ATTEMPTS, process
from sightline.plans.store import Store
from sightline.sources import dead_letters, envelopes

log = logging.getLogger(__name__)


# What errors of a network or a storage say. They pass, and say nothing of the files that were being read.
PASSING = ("java.net.", "ConnectException", "SocketTimeout", "NoRouteToHost", "UnknownHost", "hadoop.ipc", "RetriableException", "StandbyException", "SafeModeException", "ExecutorLostFailure", "FetchFailed", "SlowDown", "Service Unavailable", "No space left")


def passing(e: BaseException) -> bool:
    """Whether an error is one of the surroundings (a network, a storage), which is tried again, not one of a file."""
    return isinstance(e, ConnectionError | TimeoutError) or any(x in str(e) for x in PASSING)


def start(spark: SparkSession, landing: str, store: Store, checkpoint: str, sources: Callable[[], DataFrame] | None = None, files_a_batch: int = 1000, available_now: bool = False) -> StreamingQuery:
    """Take in every file that arrives in `landing`.

    A micro-batch is named by its number; the checkpoint moves on when it is committed to the store. After a
    failure the same files come again under the same name, so the effect is once. If a micro-batch fails as a
    whole, its files are taken in one by one, so that one bad file holds up none of the others. Those that fail alone
    are counted in the store, by their digest; the micro-batch then fails and comes again, and what has failed more
    than 5 times is parked. Errors of the surroundings are raised and count for no file. The registry is read anew for each batch. Times of observation are not bounded by a
    watermark: a late sighting goes to its own month.
    """
    files = spark.readStream.format("binaryFile").option("maxFilesPerTrigger", files_a_batch).schema("path string, modificationTime timestamp, length long, content binary").load(landing)

    def take(df: DataFrame, number: int) -> None:
        rows = df.select("path", F.col("modificationTime").alias("modified"), F.col("content").alias("body"))
        known, name, now = sources() if sources else None, f"stream-{number}", F.current_timestamp()

        def attempts() -> DataFrame | None:
            counts = store.attempts
            return spark.createDataFrame(list(counts.items()), "digest string, n int") if counts else None

        if not any(b.startswith(f"{name}-") for b in store.batches):  # else some of its files are in already
            try:
                process(rows, store, name, now, known, attempts=attempts())
                store.forget_attempts()
                return
            except Exception as e:
                if passing(e):
                    raise
                log.warning("%s failed, its files are taken in one by one: %s", name, e)
        failed: list[tuple[str, Exception]] = []
        for i, path in enumerate(sorted(x[0] for x in rows.select("path").collect())):  # the paths of one micro-batch
            one = rows.where(F.col("path") == path)
            try:
                process(one, store, f"{name}-{i}", now, known, attempts=attempts())
            except Exception as e:
                if passing(e):
                    raise
                n = store.count_attempt(digest(one, path))
                log.warning("%s failed alone, for time %d: %s", path, n, e)
                if n > MAX_ATTEMPTS + 1:  # parking it with its content failed too
                    bare = spark.createDataFrame([(None, path, "poison", f"failed again and again: {e}", None)], "source string, message_id string, stage string, reason string, body string")
                    store.commit(f"{name}-{i}", {"dead_letter": dead_letters.rows(bare.withColumn("failed_at", now))})
                else:
                    failed.append((path, e))
        if failed:
            raise RuntimeError(f"{len(failed)} files failed, {failed[0][0]} the first") from failed[0][1]
        store.forget_attempts()

    def digest(one: DataFrame, path: str) -> str:
        try:
            return one.select(envelopes.digest(F.col("body"))).first()[0]
        except Exception:  # it can't be read
            return hashlib.sha256(path.encode()).hexdigest()

    writer = files.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="5 seconds")).start()


def progress(query: StreamingQuery) -> dict[str, float]:
    """Gauges of a running stream: files waiting and rows taken in with the last micro-batch, and its seconds."""
    last = query.lastProgress
    if not last:
        return {"pending": 0, "rows": 0, "seconds": 0.0}
    waiting = [s.get("metrics", {}).get("numFilesOutstanding", 0) for s in last["sources"]]
    return {"pending": float(sum(map(float, waiting))), "rows": last["numInputRows"], "seconds": last.get("durationMs", {}).get("triggerExecution", 0) / 1000}


def supervise(begin: Callable[[], StreamingQuery], most: int | None = None, wait: Callable[[float], None] = time.sleep, longest: float = 30.0) -> int:
    """Keep a stream running: after a failure it is begun again from its checkpoint, after 1, 2, 4, ... up to 30 seconds.
    Returns the number of failures once it ends without one, or after `most`."""
    failures, pause = 0, 1.0
    while True:
        try:
            begin().awaitTermination()
            return failures
        except Exception:
            failures += 1
            if most is not None and failures >= most:
                return failures
            wait(pause)
            pause = min(2 * pause, longest)


def windowed_counts(stream: DataFrame, at: str, label: str, window: str = "5 minutes", late: str = "10 minutes") -> DataFrame:
    """label, start, n: rows by window of time, given out once the watermark has passed the window's end."""
    rows = stream.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, late)
    return rows.groupBy(F.window(at, window), label).agg(F.count("*").alias("n")).select(label, F.col("window.start").alias("start"), "n")
