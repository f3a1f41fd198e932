"""Work on new inputs only: against a manifest, or as a file stream that stops when it has caught up, with keyed state."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from regiscope.functions.exprs import base_name


def new_inputs(listing: DataFrame, manifest: DataFrame, path: str = "path") -> DataFrame:
    """Rows of a listing whose base name no manifest row has (repeated ones stay)."""
    done = manifest.select(base_name(F.col(path)).alias("_name")).distinct()
    return listing.join(done, base_name(F.col(path)) == done["_name"], "left_anti")


def stored(spark: SparkSession, path: str) -> DataFrame | None:
    """A table, or None where there is none yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def new_files(spark: SparkSession, folder: str, glob: str = "*.zip") -> DataFrame:
    """A stream of the folder's files: path, length and time, content not read."""
    spec = "path string, modificationTime timestamp, length long, content binary"
    return spark.readStream.format("binaryFile").schema(spec).option("pathGlobFilter", glob).load(folder).select("path", "length", "modificationTime")


def run_once(stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None]) -> None:
    """Handles all that is new and stops; the checkpoint remembers what was seen."""
    stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def stateful_session(spark: SparkSession, partitions: int | None = None) -> SparkSession:
    """A session of its own for streams with keyed state: RocksDB holds the state, two versions of it stay.

    `partitions` is the number of state partitions, which a stream keeps from its first start on; else that of the session's shuffles.
    """
    session = spark.newSession()
    session.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    session.conf.set("spark.sql.streaming.minBatchesToRetain", "2")
    session.conf.set("spark.sql.shuffle.partitions", str(partitions or spark.conf.get("spark.sql.shuffle.partitions")))
    return session


class Latest(StatefulProcessor):
    """Keeps of each key what `agg.latest` of all its rows so far would give: the rows of its latest date, its only row whatever the date, nothing once one of several has no date.

    One state holds all keys of a group (a range of their hash), so that it is read and written once a batch and group, not for each key.
    """

    def __init__(self, key: str, date: str, row: StructType):
        self.names = row.names
        self.key, self.date = row.names.index(key), row.names.index(date)
        self.kinds = StructType([StructField("rows", ArrayType(row)), StructField("gone", ArrayType(row[key].dataType))])  # gone: keys of several rows, one without a date

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.kept = handle.getValueState("kept", self.kinds)

    def handleInputRows(self, key, rows: Iterator[Row], timers) -> Iterator[Row]:
        old, gone = self.kept.get() or ((), ())
        gone, of = set(gone), {}
        for row in old:
            of.setdefault(row[self.key], []).append(tuple(row))
        n = 0
        for row in rows:
            n += 1
            row = tuple(row[name] for name in self.names)  # without the group
            k, date = row[self.key], row[self.date]
            if k in gone:
                continue
            known = of.get(k)
            if known is None:
                of[k] = [row]
            elif date is None or (latest := known[0][self.date]) is None:
                gone.add(k)
                del of[k]
            elif date > latest:
                of[k] = [row]
            elif date == latest:
                known.append(row)
        self.kept.update(([row for known in of.values() for row in known], list(gone)))
        yield Row(n=n)

    def close(self) -> None:
        pass


def keep_latest(stream: DataFrame, key: str, date: str, checkpoint: str, groups: int = 4096) -> None:
    """Takes all that is new in a stream of a `stateful_session` into the state under the checkpoint, and stops.

    The state has the latest rows of each key and the keys that are gone, so it grows with the keys, not with the batches.
    Keys are dealt to `groups`, which a stream keeps from its first start on: a task holds the state of one at a time. A batch that broke off runs again from the state before it.
    """
    dealt = stream.withColumn("_group", F.pmod(F.xxhash64(key), F.lit(groups)))
    kept = dealt.groupBy("_group").transformWithState(Latest(key, date, stream.schema), StructType([StructField("n", LongType())]), "Update", "None")
    kept.writeStream.format("noop").outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def latest_rows(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The rows of `agg.latest` of all that `keep_latest` has taken in, read from its state."""
    state = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", "kept").load()
    return state.select(F.explode("value.rows").alias("row")).select("row.*")
