"""The review log as a stream: a keyed state processor holds each artifact's projection, one entry a key, and applies events as they come.

The batch form is operators.clusters.replay: after all events, whatever the cut into micro-batches, the last projection of each (artifact, key) is what that gives, as long as events
of one artifact come in the order of (at, action, key, value) across micro-batches; inside one they are sorted here.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

STATES = {"ACCEPT": "ACCEPTED", "REJECT": "REJECTED", "UNCERTAIN": "UNCERTAIN"}
#: Rows of the stream: items have action ITEM, the log's events ACCEPT, REJECT, UNCERTAIN, EDIT, SPLIT, MERGE.
EVENT = "artifact string, at bigint, action string, key string, new_key string, value string"
CHANGE = "artifact string, seq bigint, key string, value string, state string"


class Projection(StatefulProcessor):
    """Emits each change of a projection with a number that grows inside the artifact; a key that went away has state GONE. idle_ms: an artifact without events for as long
    (of processing time) is given up; 0 keeps all."""

    def __init__(self, idle_ms: int = 0):
        self.idle_ms = idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        ttl = {"ttlDurationMs": self.idle_ms} if self.idle_ms else {}
        self.items = handle.getMapState("items", "key string", "value string, state string", **ttl)
        self.count = handle.getValueState("count", "n bigint", **ttl)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        found = self.count.get()
        n = found[0] if found else 0
        # what this micro-batch touches is read from the state once and written back once; a new artifact has no state to read
        self.new, self.now, self.stored, self.changed = found is None, {}, set(), set()
        # one micro-batch of one artifact
        for e in sorted(rows, key=lambda r: (r.action != "ITEM", r.at if r.at is not None else -1, r.action, r.key, r.value or "")):
            for k, value, state in self._applied(e):
                n += 1
                yield Row(artifact=key[0], seq=n, key=k, value=value, state=state)
        for k in self.changed:
            if self.now[k] is not None:
                self.items.updateValue((k,), self.now[k])
            elif k in self.stored:
                self.items.removeKey((k,))
        self.count.update((n,))

    def _get(self, key: str) -> tuple | None:
        if key not in self.now:
            self.now[key] = None if self.new else self.items.getValue((key,))
            if self.now[key] is not None:
                self.stored.add(key)
        return self.now[key]

    def _applied(self, e: Row) -> Iterator[tuple[str, str | None, str]]:
        if e.action == "ITEM":
            yield self._put(e.key, e.value, "OPEN")
            return
        now = self._get(e.key)
        if now is None:
            return
        if e.action in STATES:
            yield self._put(e.key, now[0], STATES[e.action])
        elif e.action == "EDIT":
            yield self._put(e.key, e.value, "EDITED")
        elif e.action == "SPLIT" and e.new_key is not None and self._get(e.new_key) is None:
            yield self._put(e.new_key, now[0] if e.value is None else e.value, "OPEN")
        elif e.action == "MERGE" and e.new_key is not None and e.new_key != e.key and self._get(e.new_key) is not None:
            self.now[e.key] = None
            self.changed.add(e.key)
            yield e.key, None, "GONE"

    def _put(self, key: str, value: str | None, state: str) -> tuple[str, str | None, str]:
        self._get(key)
        self.now[key] = (value, state)
        self.changed.add(key)
        return key, value, state


def projected(events: DataFrame, idle_ms: int = 0) -> DataFrame:
    """CHANGE rows of a stream of EVENT rows."""
    return events.groupBy("artifact").transformWithState(Projection(idle_ms), CHANGE, "Append", "ProcessingTime" if idle_ms else "None")


def run(spark: SparkSession, folder: str, out: str, checkpoint: str, idle_ms: int = 0, files_per_trigger: int = 1) -> None:
    """Apply what is new in a folder of Parquet files of EVENT rows, a file at a time, and append the changes to `out`; started again on the checkpoint it goes on."""
    own = spark.newSession()
    for name in ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone"):
        own.conf.set(name, spark.conf.get(name))
    own.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    own.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    own.conf.set("spark.sql.streaming.stateStore.rocksdb.allowFAllocate", "false")
    own.conf.set("spark.sql.streaming.checkpointFileManagerClass", "org.apache.spark.sql.execution.streaming.checkpointing.FileSystemBasedCheckpointFileManager")
    own.conf.set("spark.sql.streaming.checkpoint.fileChecksum.enabled", "false")
    stream = own.readStream.schema(EVENT).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)
    started = projected(stream, idle_ms).writeStream.format("parquet").outputMode("append").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    started.awaitTermination()


def current(changes: DataFrame) -> DataFrame:
    """artifact, key, value, state: the projection after all changes; one aggregation."""
    last = changes.groupBy("artifact", "key").agg(F.max_by(F.struct("value", "state"), "seq").alias("s"))
    return last.select("artifact", "key", "s.value", "s.state").where("state <> 'GONE'")
