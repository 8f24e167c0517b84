"""Speed layer: messages to lines, keyed upsert, retention, and the batch + live view."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillhouse.functions import decode
from tillhouse.functions.calendar import from_epoch_ms, local_time
from tillhouse.functions.contracts import (
    LIVE_FACT, LIVE_KEY, LIVE_MART_COLUMNS, LIVE_MART_DAYS, RETENTION_HOURS, STREAM_ENVELOPE,
)
from tillhouse.functions.types import conform
from tillhouse.sources.sinks import exists, folders, remove

SALE = "SALE_TRANSACTION"
OFFSET = "offset"
ARRIVAL, EVENT_TIME = "arrival", "event_time"
ARRIVED = ("run", "batch")
# The first run of a generation, and its one batch.
BASE = "run=000000-compact/batch=0"
# Message item field -> column.
MESSAGE_ITEM = {
    "product_code": "product_id", "product_name": "product_name", "uom": "product_uom",
    "product_uom_id": "product_uom_id", "product_group_id": "product_group_id", "product_group": "product_group_name",
    "product_sub_category_id": "product_sub_category_id", "product_sub_category": "product_sub_category_name",
    "product_category_id": "product_category_id", "product_category": "product_category_name",
    "retail_business_type": "retail_business_type", "supplier_code": "supplier_id", "supplier_name": "supplier_name",
    "uom_size": "product_uom_size", "quantity": "quantity", "retail_selling_price": "product_price",
    "total_amount": "total_amount", "total_amount_without_tax": "total_amount_no_tax",
    "purchase_price_with_tax": "purchase_price_with_tax", "purchase_price_without_tax": "purchase_price_without_tax",
}


def sale_messages(messages: DataFrame) -> DataFrame:
    """Message text to live lines, transaction x item. Sales without items give no line.

    Other message types are dropped on their type field before the whole envelope is parsed.
    """
    kind = F.get_json_object("value", "$.stream_type")
    parsed = messages.where(kind == SALE).select(F.from_json("value", STREAM_ENVELOPE).alias("e"), *_offset(messages))
    # the outer form keeps Spark from testing the array ahead of time, which would parse every message twice;
    # a message without sales still ends at the inner explode
    offset = _offset(messages)
    sold = parsed.selectExpr("e.payload.store_code as store_id", "e.payload.store_name as store_name",
                             "explode_outer(e.payload.sale_transaction) as t", *offset)
    items = sold.selectExpr("store_id", "store_name", "t", "explode(t.sale_normal_items) as i", *offset).withColumns({
        "transaction_time": local_time(from_epoch_ms(F.col("t.document_date"))),
        "posting_time": local_time(from_epoch_ms(F.col("t.posting_date"))),
        "customer_gender": decode.gender("t.customer_gender")})
    lines = items.selectExpr(
        "t.transaction_id", "to_date(transaction_time) as report_date", "transaction_time",
        "transaction_time as sale_bill_time", "posting_time", "store_id", "store_name", "t.staff_id", "t.staff_name",
        "t.payment_method as payment_method_id", *[f"i.{field} as {name}" for field, name in MESSAGE_ITEM.items()],
        "i.total_amount as final_amount", "i.total_amount_without_tax as final_amount_no_tax", "customer_gender",
        "'Sale Transaction' as transaction_type", "'completed' as delivery_status", *offset)
    return conform(lines, {**LIVE_FACT, **{name: "int" for name in offset}})


def _offset(frame: DataFrame) -> list[str]:
    """The source's own message number, where it gives one."""
    return [OFFSET] if OFFSET in frame.columns else []


def latest(lines: DataFrame, arrival: Sequence[str] = (), newest: str = EVENT_TIME) -> DataFrame:
    """One line per key. Null key parts are equal to each other.

    `newest` says what a later version is: the one that arrived later, by the `arrival` columns and the source's
    offset, or the one with the later event time; the other decides ties. Spark prunes to one row per key and task
    before the shuffle, so copies of one key stay cheap.
    """
    order = _newest_first(lines, arrival, newest)
    return _first(lines, LIVE_KEY, order + [F.col(name).asc_nulls_last() for name in LIVE_FACT if name not in LIVE_KEY])


def _newest_first(lines: DataFrame, arrival: Sequence[str], newest: str) -> list[Column]:
    came = [F.col(name).desc_nulls_last() for name in (*arrival, *_offset(lines))]
    happened = [F.col("transaction_time").desc_nulls_last(), F.col("posting_time").desc_nulls_last()]
    return came + happened if newest == ARRIVAL else happened + came


def _first(lines: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    ranked = lines.withColumn("_rank", F.row_number().over(Window.partitionBy(*key).orderBy(*order)))
    return ranked.where("_rank = 1").drop("_rank")


class LiveTable:
    """Upserted live lines as one folder per run and micro-batch, merged when read.

    A run is one checkpoint: its batches are numbered from 0, and those of a new checkpoint go to a new folder, so
    they replace nothing. A batch writes only its own rows and a repeated batch overwrites its own folder, so
    redelivery after a lost executor or driver changes nothing. Reading keeps the newest row per key, by arrival or
    by event time.

    The table has generations. `roll` folds all batches into the base of a new one, without what retention deletes;
    batches go to the newest generation with a complete base, and a read merges no others. Readers keep the
    generation they opened; it stays until the roll after the next.
    """

    def __init__(self, spark: SparkSession, path: str, newest: str = ARRIVAL):
        self.spark, self.path, self.newest = spark, path, newest

    def generation(self) -> int:
        complete = [int(n) for n in folders(self.spark, self.path, "generation-")
                    if exists(self.spark, f"{self._folder(int(n))}/{BASE}/_SUCCESS")]
        return max(complete, default=0)

    def _folder(self, generation: int) -> str:
        return f"{self.path}/generation-{generation:06d}"

    def run_folder(self, identity: str) -> str:
        """Folder name of a run; runs sort in the order in which they first wrote."""
        known = sorted(folders(self.spark, self._folder(self.generation()), "run="))
        for name in known:
            if name.endswith(f"-{identity}"):
                return name
        return f"{len(known):06d}-{identity}"

    def upsert(self, batch: DataFrame, batch_id: int, run: str = "direct") -> None:
        lines = latest(sale_messages(batch), newest=self.newest)
        (lines.write.mode("overwrite").partitionBy("report_date")
         .parquet(f"{self._folder(self.generation())}/run={self.run_folder(run)}/batch={batch_id}"))

    def read(self, as_of: datetime | None = None, hours: int = RETENTION_HOURS) -> DataFrame:
        """The newest line per key; with `as_of`, without those that retention has deleted by then.

        With `as_of`, whole lines are read of the days under retention only. Which version of a key is its newest is
        told from a few columns of all days, as a correction may have moved a line out of them.
        """
        stored = self._stored()
        if as_of is None:
            return latest(stored, ARRIVED, self.newest).select(*LIVE_FACT)
        narrow = [*LIVE_KEY, *ARRIVED, OFFSET, "report_date", "transaction_time", "posting_time"]
        # a batch holds one line per key, so key, run and batch name a line
        winners = retained(_first(stored.select(*narrow), LIVE_KEY, _newest_first(stored, ARRIVED, self.newest)), as_of, hours)
        named = (*LIVE_KEY, *ARRIVED)
        winners = winners.select(*[F.col(c).alias(f"_w_{c}") for c in named])
        same = [F.col(c).eqNullSafe(F.col(f"_w_{c}")) for c in named]
        return retained(stored, as_of, hours).join(winners, same, "left_semi").select(*LIVE_FACT)

    def _stored(self) -> DataFrame:
        schema = conform(self.spark.createDataFrame([], "x int"), {**LIVE_FACT, OFFSET: "int"}).schema
        with_batch = schema.add("run", "string").add("batch", "long")
        folder = self._folder(self.generation())
        if not exists(self.spark, folder):
            return self.spark.createDataFrame([], with_batch)
        return self.spark.read.schema(with_batch).parquet(folder)

    def roll(self, as_of: datetime, hours: int = RETENTION_HOURS) -> None:
        """Begin a generation with what is still under retention; days that have left it are not read.

        A roll that dies leaves a base without its completion mark, which the next one overwrites.
        """
        old = self.generation()
        self._write_base(self.read(as_of, hours), self._folder(old + 1))
        for n in folders(self.spark, self.path, "generation-"):
            if int(n) < old:
                remove(self.spark, self._folder(int(n)))

    @staticmethod
    def _write_base(lines: DataFrame, folder: str) -> None:
        lines.write.mode("overwrite").partitionBy("report_date").parquet(f"{folder}/{BASE}")

    def compact(self, as_of: datetime, target: str) -> LiveTable:
        """The merged rows still under retention, as a new table; the old one stays as it is."""
        table = LiveTable(self.spark, target, self.newest)
        self._write_base(self.read(as_of), table._folder(0))
        return table


def run_upserts(messages: DataFrame, table: LiveTable, checkpoint: str,
                clock: Callable[[], datetime] | None = None) -> StreamingQuery:
    """Process what has arrived, then stop; the checkpoint remembers how far the source was read, and names the run.

    With a clock of local business time, each batch ends with what retention deletes by then.
    """

    def upsert(batch: DataFrame, batch_id: int) -> None:
        # Spark writes the query's id there before the first batch, and keeps it over restarts
        identity = batch.sparkSession.read.json(f"{checkpoint}/metadata").first()["id"]
        table.upsert(batch, batch_id, identity)
        if clock is not None:
            table.roll(clock())

    return (messages.writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def retained(lines: DataFrame, as_of: datetime, hours: int = RETENTION_HOURS) -> DataFrame:
    """Lines of the last `hours` of local business time before an explicit local moment, and those without a time.

    Deleting what is older deletes no line of unknown age. The day filter prunes whole partitions; the exact moment
    filters inside the first one.
    """
    bound = as_of - timedelta(hours=hours)
    day, moment = F.col("report_date"), F.col("transaction_time")
    return lines.where((day.isNull() | (day >= F.lit(bound.date()))) &
                       (moment.isNull() | (moment >= F.lit(str(bound)).cast("timestamp_ntz"))))


def serving_view(batch: DataFrame, live: DataFrame, prefer: str = "batch") -> DataFrame:
    """Batch days, then live days after the last batch day.

    A late live line for a day the batch already covers stays hidden until that day is rebuilt;
    prefer="latest" shows it instead, as a replacement for the batch line of its key.
    """
    batch = batch.select(*LIVE_FACT, F.lit("eod").alias("source"))
    live = live.select(*LIVE_FACT, F.lit("rlt").alias("source"))
    if prefer == "latest":
        return latest(batch.unionByName(live), ("source",)).select(*LIVE_FACT, "source")
    bound = batch.agg(F.max("report_date")).scalar()
    known = batch.where(F.col("report_date").isNotNull())
    return known.unionByName(live.where(F.col("report_date") > F.coalesce(bound, F.lit("1900-01-01").cast("date"))))


def frontier_view(batch: DataFrame, live: DataFrame) -> DataFrame:
    """Batch days, then live days after the last day that the line's own store has in batch.

    Stores are batched at different hours: a store that is behind keeps its live lines, whatever others have. Stores
    that batch does not know, and lines without a store or of a store without days, are live alone.
    """
    batch = batch.select(*LIVE_FACT, F.lit("eod").alias("source")).where(F.col("report_date").isNotNull())
    frontier = batch.groupBy(F.col("store_id").alias("_store")).agg(F.max("report_date").alias("_upto"))
    late = (live.select(*LIVE_FACT, F.lit("rlt").alias("source"))
            .join(frontier, F.col("store_id").eqNullSafe(F.col("_store")), "left")
            .where(F.col("_upto").isNull() | (F.col("report_date") > F.col("_upto"))))
    return batch.unionByName(late.select(*LIVE_FACT, "source"))


def live_mart(view: DataFrame, as_of: datetime, days: int = LIVE_MART_DAYS) -> DataFrame:
    first = as_of.date() - timedelta(days=days)
    return view.where(F.col("report_date") >= F.lit(first)).select(*LIVE_MART_COLUMNS)
