"""A row per micro-batch of a running job: what was read, and what became of it."""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

ACCOUNT = "query string, run_id string, batch_id bigint, n_read bigint, n_routed bigint, n_rejected bigint, n_excluded bigint"


def batch_account(progress) -> tuple | None:
    """The counts of one batch from its observed metrics, or None if no parse ran in it.

    Every parse counts the events it reads, before its include list, and events and
    rejects at its end; what lies between was excluded."""
    read = parsed = rejected = 0
    seen, named = False, False
    for name, row in progress.observedMetrics.items():
        if not name.startswith("lograft_"):
            continue
        if "_read_" in name:
            named, read = True, read + row["events"]
        else:
            seen, parsed, rejected = True, parsed + row["events"], rejected + row["rejects"]
    if not seen:
        return None
    read = read if named else parsed
    return progress.name, str(progress.runId), progress.batchId, read, parsed - rejected, rejected, read - parsed


class BatchAccounts(StreamingQueryListener):
    """Writes the account of every batch of the session's queries to a table (Parquet).

    Add it with ``spark.streams.addListener``. A batch has its own folder, so a batch that
    is run again after a failure replaces its row. ``wait_for`` blocks until a query's batch
    is in the table, since Spark tells listeners behind the query's back."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self._done: set[tuple[str, int]] = set()
        self._news = threading.Condition()

    def onQueryStarted(self, event) -> None:  # noqa: N802 - Spark's names
        pass

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        row = batch_account(p)
        if row is not None:
            (self.spark.createDataFrame([row], ACCOUNT).coalesce(1).write.mode("overwrite")
             .parquet(f"{self.path}/{p.id}/{p.batchId}"))
        with self._news:
            self._done.add((str(p.id), p.batchId))
            self._news.notify_all()

    def wait_for(self, query_id: str, batch_id: int, seconds: float = 60) -> None:
        with self._news:
            if not self._news.wait_for(lambda: (str(query_id), batch_id) in self._done, seconds):
                raise TimeoutError(f"no account of batch {batch_id} after {seconds} s")

    def table(self) -> DataFrame:
        return self.spark.read.schema(ACCOUNT).option("recursiveFileLookup", "true").parquet(self.path)
