"""Settlement of message streams.

``SettlementStream`` runs one micro-batch after another: detail and totals of a batch
are both written under its batch id, so a restart repeats a batch without counting it
twice. A new run with a new folder starts from the earliest message with empty totals.
``running_totals`` keeps the totals in Spark's state store instead.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from netledger import schemas
from netledger.operators import parse
from netledger.operators.dedup import latest
from netledger.operators.joins import JoinPolicy
from netledger.operators.totals import merge_maps
from netledger.plans.settlement import (NORMAL, Dimensions, Job, Lookups, detail, enrich,
                                        settle_with, with_fee)
from netledger.session import large_writes
from netledger.sinks import levels
from netledger.sinks.store import KeyedStore
from netledger.sinks.tables import drop, exists, write_batch
from netledger.sources.messages import with_arrival

INTERVAL = "5 seconds"


def reader_of(job: Job) -> Callable[[DataFrame], DataFrame]:
    return parse.read_normal if job.name == NORMAL.name else parse.read_incre


def layout_of(job: Job) -> dict[str, str]:
    return schemas.NORMAL_DETAIL if job.name == NORMAL.name else schemas.INCRE_DETAIL


def stored_key(job: Job) -> str:
    return next(name for name, source in layout_of(job).items() if source == job.row_key)


@dataclass
class SettlementStream:
    job: Job
    dimensions: Callable[[SparkSession], Dimensions]
    folder: str
    #: The fewest tasks a batch is parsed in; a batch that comes in more keeps them.
    fan_out: int | None = None
    policy: JoinPolicy = field(default_factory=JoinPolicy)
    #: Tells which version of the dimensions is published, without opening them (``load.version_of``).
    version: Callable[[SparkSession], str] | None = None
    _tables: Lookups | None = field(default=None, init=False, repr=False)
    _files: frozenset[str] | str = field(default=frozenset(), init=False, repr=False)

    @property
    def detail_path(self) -> str:
        return f"{self.folder}/detail"

    @property
    def totals_path(self) -> str:
        return f"{self.folder}/totals"

    @property
    def quarantine_path(self) -> str:
        return f"{self.folder}/quarantine"

    def store(self, spark: SparkSession) -> KeyedStore:
        """The keyed store of the detail. Its mark of a batch is the run's: readers skip a batch that is still being written."""
        return KeyedStore(spark, self.detail_path, stored_key(self.job), policy=self.policy)

    def committed(self, spark: SparkSession) -> list[int]:
        """The whole batches."""
        return self.store(spark).committed()

    def process(self, batch: DataFrame, batch_id: int) -> None:
        """Settle one micro-batch; safe to repeat.

        The parsed messages become a table of the run instead of cached blocks, so executors hold none of them, the
        lookups and the quarantine read columns, and a lost executor costs no parsing. It is dropped
        when the batch is whole.
        """
        spark, parsed = batch.sparkSession, self._parse(batch)
        with large_writes(spark):
            written = write_batch(parsed, f"{self.folder}/parsed", batch_id)
            self._settle(spark.read.schema(parsed.schema).parquet(written), batch_id)
            drop(spark, written)

    def process_all(self, messages: DataFrame, batch_id: int = 0) -> None:
        """Settle all messages as one batch, and free the lookup sides."""
        try:
            self.process(messages, batch_id)
        finally:
            self.close()

    def close(self) -> None:
        """Free the cached lookup sides; a later batch prepares them again."""
        if self._tables is not None:
            self._tables.release()
            self._tables = None

    def _parse(self, batch: DataFrame) -> DataFrame:
        rows = with_arrival(batch)
        if self.fan_out and batch.rdd.getNumPartitions() < self.fan_out:
            rows = rows.repartition(self.fan_out)
        # Only the quarantine takes the text.
        return reader_of(self.job)(rows).withColumn("value", F.when(F.col("problem").isNotNull(), F.col("value")))

    def _settle(self, parsed: DataFrame, batch_id: int) -> None:
        spark = parsed.sparkSession
        write_batch(parse.quarantined(parsed), self.quarantine_path, batch_id)
        settled = settle_with(parse.usable(parsed), self._lookups(spark))
        # The order of arrival is kept only where a key of the store can come more than once in a batch.
        arrival = [] if self.job.dedup_keys == [self.job.row_key] else ["arrival"]
        stored = detail(settled, layout_of(self.job), *arrival)
        store = self.store(spark)
        written = store.write(stored, batch_id, *arrival)
        batch_detail = spark.read.schema(stored.drop("arrival").schema).parquet(written)
        totals = merge_maps(batch_detail.filter(F.col("net").isNotNull())
                            .withColumnRenamed("merNo", "mer_no"), "mer_no", "net", "total")
        levels.write(totals, self.totals_path, batch_id)
        store.commit(batch_id, [c for c in stored.columns if c not in (store.key, "arrival")], once=not arrival)
        levels.roll(spark, self.totals_path, batch_id, store.committed(), totals.schema)

    def _lookups(self, spark: SparkSession) -> Lookups:
        """The lookup sides; prepared again when the dimensions have another version, or other files where no version is told."""
        if self.version is not None:
            if self._tables is None or self._files != self.version(spark):
                self.close()
                dims = self.dimensions(spark)
                self._tables, self._files = Lookups(dims, self.job, self.policy, together=True).keep(), dims.version
            return self._tables
        dims = self.dimensions(spark)
        files = dims.files()
        if self._tables is None or not files or files != self._files:
            self.close()
            self._tables, self._files = Lookups(dims, self.job, self.policy, together=True).keep(), files
        return self._tables

    def start(self, messages: DataFrame, once: bool = False) -> StreamingQuery:
        """Run every ``INTERVAL`` until stopped, or over what is there with ``once``."""
        trigger = {"availableNow": True} if once else {"processingTime": INTERVAL}
        return (messages.writeStream.foreachBatch(self.process).trigger(**trigger)
                .option("checkpointLocation", f"{self.folder}/checkpoint")
                .queryName(f"{self.job.name}_settlement_{self.folder.rsplit('/', 1)[-1]}").start())

    def totals(self, spark: SparkSession) -> DataFrame:
        """mer_no -> total over the whole batches; no rows before the first."""
        version = self.store(spark).version()
        net = T.DecimalType(38, 9) if version is None else T.DataType.fromDDL(version.columns["net"])
        total = T.DecimalType(min(38, net.precision + 10), net.scale)
        return levels.read(spark, self.totals_path, self.committed(spark), T.StructType().add("mer_no", "string").add("total", total))

    def detail(self, spark: SparkSession) -> DataFrame:
        """The newest row of each key; no rows (of text columns) before the first batch."""
        store = self.store(spark)
        if store.version() is None:
            return spark.createDataFrame([], ", ".join(f"`{c}` string" for c in layout_of(self.job)))
        return store.view()


def progress(query: StreamingQuery) -> list[dict]:
    """What Spark measured of the last batches of a query: their rows, rates and times.

    ``rows`` shows that a batch stays under the cap of its source, ``ms`` that it fits into the interval.
    """
    return [{"batch_id": p["batchId"], "rows": p["numInputRows"], "rows_per_second": p["processedRowsPerSecond"],
             "ms": p["durationMs"].get("triggerExecution", 0)} for p in query.recentProgress if p["numInputRows"]]


def running_totals(messages: DataFrame, dims: Dimensions, job: Job, policy: JoinPolicy = JoinPolicy(),
                   heavy: dict[str, DataFrame] | None = None) -> DataFrame:
    """Streaming mer_no -> total, kept in the state store (no deduplication).

    Dimensions of broadcast size are broadcast; a larger one is joined by an exchange of the micro-batch
    on its key. There rows without a key are scattered, and keys of the ``heavy`` list (``read_heavy_list``) divided.
    """
    return running_totals_of(parse.usable(reader_of(job)(messages)), dims, job, policy, heavy)


def running_totals_of(flow: DataFrame, dims: Dimensions, job: Job, policy: JoinPolicy = JoinPolicy(),
                      heavy: dict[str, DataFrame] | None = None) -> DataFrame:
    """``running_totals`` of a stream of parsed messages."""
    settled = with_fee(enrich(flow.filter(job.trade()), Lookups(dims, job, policy), heavy=heavy or {}), job)
    return merge_maps(settled.filter("settled"), "mer_no", "net", "total")


@dataclass
class LatestStream:
    """The last message of each key of a micro-batch, parsed, as files that the next stream reads.

    A stream cannot both keep the last row of a key and add up totals, so the one hands its rows to the other.
    """

    job: Job
    folder: str

    @property
    def records_path(self) -> str:
        return f"{self.folder}/records"

    def process(self, batch: DataFrame, batch_id: int) -> None:
        """Deduplicate one micro-batch; a batch that is there whole stays, as the next stream may have read it."""
        if exists(batch.sparkSession, f"{self.records_path}/batch_id={batch_id}/_SUCCESS"):
            return
        kept = latest(parse.usable(reader_of(self.job)(with_arrival(batch))), self.job.dedup_keys)
        write_batch(kept.drop("arrival"), self.records_path, batch_id)

    def start(self, messages: DataFrame, once: bool = False) -> StreamingQuery:
        """Run every ``INTERVAL`` until stopped, or over what is there with ``once``."""
        trigger = {"availableNow": True} if once else {"processingTime": INTERVAL}
        return (messages.writeStream.foreachBatch(self.process).trigger(**trigger)
                .option("checkpointLocation", f"{self.folder}/checkpoint").start())

    def records(self, spark: SparkSession, max_files_per_trigger: int | None = None) -> DataFrame:
        """The kept records as a stream; start it when a batch is whole, since files of one appear one by one."""
        schema = spark.read.parquet(self.records_path).drop("batch_id").schema
        reader = spark.readStream.schema(schema)
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
        return reader.parquet(f"{self.records_path}/batch_id=*")
