"""Scans: layered tables, windowed and parent-windowed extracts, landed JSON, Kafka."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from tillhouse.functions.calendar import RunWindow
from tillhouse.functions.types import conform

FETCH_ROWS = 10_000


def table_name(layer: str, name: str, schemas: bool = True) -> str:
    """`layer.name`, or `layer_name` where the catalog has no schemas."""
    return f"{layer}.{name}" if schemas else f"{layer}_{name}"


def read_table(spark: SparkSession, layer: str, name: str, schemas: bool = True) -> DataFrame:
    return spark.read.table(table_name(layer, name, schemas))


def between(df: DataFrame, ts: str, lo: datetime, hi: datetime) -> DataFrame:
    """Half-open [lo, hi) on the bare column, so it reaches the file scan."""
    kind = df.schema[ts].dataType.simpleString()
    return df.where((F.col(ts) >= F.lit(str(lo)).cast(kind)) & (F.col(ts) < F.lit(str(hi)).cast(kind)))


def in_business_window(docs: DataFrame, ts: str, window: RunWindow) -> DataFrame:
    """Documents of exactly the run's business days."""
    return between(docs, ts, window.utc_lo, window.utc_hi)


def windowed(table: DataFrame, ts: str, window: RunWindow) -> DataFrame:
    """Incremental extract on a write-once timestamp, over the wider cover window."""
    return between(table, ts, window.cover_lo, window.cover_hi)


def parent_windowed(child: DataFrame, parent: DataFrame, key: str, parent_ts: str, window: RunWindow) -> DataFrame:
    """Children whose parent falls in the cover window, whenever they themselves were written."""
    return child.join(windowed(parent, parent_ts, window).select(key), key, "left_semi")


def sql_moment(moment: datetime) -> str:
    return f"TIMESTAMP '{moment:%Y-%m-%d %H:%M:%S}'"


def windowed_sql(table: str, ts: str, window: RunWindow) -> str:
    """The windowed extract as text for a database's own engine."""
    return f"SELECT * FROM {table} WHERE {_inside(ts, window)}"


def parent_windowed_sql(table: str, parent: str, key: str, parent_ts: str, window: RunWindow) -> str:
    """The semi-join as text: a database join is not something Spark can push down by itself."""
    return (f"SELECT c.* FROM {table} c WHERE EXISTS (SELECT 1 FROM {parent} p WHERE p.{key} = c.{key} "
            f"AND {_inside('p.' + parent_ts, window)})")


def _inside(ts: str, window: RunWindow) -> str:
    return f"{ts} >= {sql_moment(window.cover_lo)} AND {ts} < {sql_moment(window.cover_hi)}"


def jdbc(spark: SparkSession, url: str, query: str, fetch_rows: int = FETCH_ROWS,
         split: tuple[str, int | str | datetime, int | str | datetime, int] | None = None,
         **options: str) -> DataFrame:
    """Query result over JDBC; `split` = (column, low, high, tasks) reads it in parallel."""
    reader = (spark.read.format("jdbc").option("url", url).option("fetchsize", str(fetch_rows)).options(**options))
    if split is None:
        return reader.option("query", query).load()
    column, low, high, tasks = split
    return (reader.option("dbtable", f"({query}) q").option("partitionColumn", column)
            .option("lowerBound", str(low)).option("upperBound", str(high)).option("numPartitions", str(tasks)).load())


def extract(tables: Mapping[str, DataFrame], window: RunWindow | None, transactional: Mapping[str, str],
            children: Mapping[str, tuple[str, str, str]]) -> dict[str, DataFrame]:
    """Relational extract policy: windowed transactions, children by parent, masters whole.

    `window=None` is the repair switch: everything is read whole.
    """
    def one(name: str, table: DataFrame) -> DataFrame:
        if window is None or (name not in transactional and name not in children):
            return table
        if name in transactional:
            return windowed(table, transactional[name], window)
        parent, key, parent_ts = children[name]
        return parent_windowed(table, tables[parent], key, parent_ts, window)

    return {name: one(name, table) for name, table in tables.items()}


# Which relational tables are windowed, and by what.
TRANSACTIONAL = {"delivery_orders": "created_at", "sale_transactions": "created_at", "point_histories": "created_at"}
CHILDREN = {
    "delivery_order_audits": ("delivery_orders", "order_id", "created_at"),
    "delivery_order_details": ("delivery_orders", "order_id", "created_at"),
}


def landed_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Landed API payload or document dump, with a declared schema (no inference pass)."""
    return spark.read.schema(schema).json(path)


CORRUPT = "_corrupt_record"


def parsed_documents(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Landed documents, one JSON text a line, with the file and the text of those that do not parse.

    A line that is no JSON, or that does not fit the declared schema, keeps its text in `_corrupt_record`.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    texts = spark.read.text(path).select("value", F.col("_metadata.file_name").alias("_file"))
    doc = F.from_json("value", f"{schema}, {CORRUPT} string", options)
    return texts.select(doc.alias("_doc"), "_file").select("_doc.*", "_file")


def good_documents(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col(CORRUPT).isNull()).drop(CORRUPT, "_file")


def quarantined(parsed: DataFrame) -> DataFrame:
    """The texts that did not parse, and where they lie."""
    return parsed.where(F.col(CORRUPT).isNotNull()).select(F.col("_file").alias("file"), F.col(CORRUPT).alias("text"))


def rows(spark: SparkSession, data: list[tuple], tokens: Mapping[str, str]) -> DataFrame:
    """Literal rows under a column contract; only for small fixed inputs."""
    return conform(spark.createDataFrame(data, list(tokens)), tokens)


def union_present(sources: Mapping[str, Callable[[], DataFrame]], what: str) -> DataFrame:
    """Union of the sources that exist; missing ones are skipped, none at all is an error."""
    found = []
    for read in sources.values():
        try:
            found.append(read())
        except AnalysisException as error:
            if error.getCondition() not in ("PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND"):
                raise
    if not found:
        raise ValueError(f"{what}: none of {sorted(sources)} exists")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), found)


def kafka_stream(spark: SparkSession, servers: str, topic: str, starting: str = "earliest",
                 **security: str) -> DataFrame:
    """Topic as a stream of text values. The checkpoint takes over from `starting` after the first run."""
    return (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
            .option("subscribe", topic).option("startingOffsets", starting).option("failOnDataLoss", "false")
            .options(**security).load().select(F.col("value").cast("string").alias("value")))


def day_list(first: date, last: date) -> list[date]:
    return [date.fromordinal(n) for n in range(first.toordinal(), last.toordinal())]
