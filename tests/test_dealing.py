"""How often rows are dealt, and what is sent to every task; results are checked beside it."""

import glob
import os
import time
from datetime import date

from pyspark.sql import functions as F

from tillhouse.functions.contracts import PRODUCT_FACT
from tillhouse.operators.joins import as_of_join, with_gaps
from tillhouse.operators.shares import Share
from tillhouse.operators.skew import running_sums
from tillhouse.plans import facts, identity, lakehouse, lines
from tillhouse.plans.catalog import registered
from tillhouse.plans.dims import price_timeline
from tillhouse.plans.lakehouse import Lakehouse
from tillhouse.session import tune
from tillhouse.sources import landing


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rows_of_a_sure_key_are_dealt_by_it_alone(spark):
    rows = spark.range(2000).selectExpr("coalesce(id % 40, 0L) as k", "cast(id % 7 as int) as o", "id as u")
    out = running_sums(rows, ["k"], ["o", "u"], before="b", total="n").groupBy("k", "o").agg(F.max("b"))
    # the rows once, their sums by slice and by group; none for what is grouped after it
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert plan_of(out).count("Exchange hashpartitioning") == 3
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    counted = running_sums(rows, ["k"], ["o", "u"], before="b", total="n").groupBy("k").agg(
        F.count_distinct("b").alias("places"), F.max("b").alias("last"), F.max("n").alias("n"))
    assert {tuple(r)[1:] for r in counted.collect()} == {(50, 49, 50)}


def test_a_large_dimension_in_small_files_is_not_sent_to_every_task(spark, tmp_path):
    path = str(tmp_path / "dim")
    spark.range(700_000).selectExpr("id as k", "'the same long text in every row' as name", "'another' as kind",
                                    "timestamp_ntz'2000-01-01 00:00:00' as valid_from",
                                    "timestamp_ntz'2001-01-01 00:00:00' as valid_to").write.parquet(path)
    assert sum(os.path.getsize(f) for f in glob.glob(f"{path}/*.parquet")) < 10_000_000
    left = spark.range(5).selectExpr("id as k", "timestamp_ntz'2000-06-01 00:00:00' as at")
    out = as_of_join(left, spark.read.parquet(path), ["k"], "at")
    assert "BroadcastExchange" not in plan_of(out)
    assert out.where("name is not null").count() == 5


def test_gaps_take_one_row_a_version_to_find(spark):
    moment = lambda text: f"timestamp_ntz'{text} 00:00:00'"
    dim = spark.sql(f"""select * from values ('a', {moment('2000-01-01')}, {moment('2001-01-01')}),
        ('a', {moment('2000-03-01')}, {moment('2000-06-01')}), ('a', {moment('2002-01-01')}, {moment('2003-01-01')}),
        ('b', cast(null as timestamp_ntz), {moment('2001-01-01')}), ('c', {moment('2000-01-01')}, cast(null as timestamp_ntz))
        as t(k, since, until)""")
    out = with_gaps(dim, ["k"], "since", "until")
    gaps = sorted((r["k"], str(r["since"])[:10], str(r["until"])[:10], r["_gap"]) for r in out.where("_gap is not null").collect())
    assert gaps == [("a", "0001-01-01", "2000-01-01", 1), ("a", "2001-01-01", "2002-01-01", 1), ("a", "2003-01-01", "9999-12-31", 2),
                    ("c", "0001-01-01", "2000-01-01", 1), ("c", "0001-01-01", "9999-12-31", 2)]
    assert "Generate explode(array(struct(at" not in plan_of(out)


def test_timeline_is_unfolded_by_many_tasks(spark, monkeypatch, tmp_path):
    spark.range(1, 41).selectExpr("id as p_partkey", "cast(id as double) as p_retailprice").write.parquet(f"{tmp_path}/part.parquet")
    monkeypatch.setattr(landing, "PRICED_PARTS", 10)
    prices = Lakehouse(spark, str(tmp_path)).landing.purchase_price_timeline()
    assert prices.rdd.getNumPartitions() == 4
    assert prices.select("product_id").distinct().count() == 36


def test_bills_without_an_id_are_answered_by_their_order(spark):
    bills = spark.sql("select * from values ('T1', 'D1'), ('T2', null), (null, 'D1'), (null, null) as t(transaction_id, order_no)")
    shape = ", ".join(f"'{c}' as {c}" for c in identity.DELIVERY)
    deliveries = spark.sql(f"select cast(null as string) as transaction_id, 'D1' as order_no, {shape} from range(2)")
    rated = spark.sql("select '' as transaction_id, " + ", ".join(f"'' as {c}" for c in identity.SOURCES["rated"].fields) + " from range(0)")
    earned = spark.sql("select '' as transaction_id, " + ", ".join(f"'' as {c}" for c in identity.SOURCES["earned"].fields) + " from range(0)")
    tables = {"transactions": rated, "points": earned, "deliveries": deliveries}
    out = identity.asked(bills, tables)
    found = sorted((str(r["transaction_id"]), str(r["order_no"]), r["ordered"] is not None) for r in out.collect())
    # two deliveries of an order multiply its bills, also the one without an id
    assert found == [("None", "D1", True)] * 2 + [("None", "None", False)] + [("T1", "D1", True)] * 2 + [("T2", "None", False)]


def small_lake(spark, path, orders, lines):
    """A folder with a few orders (key, date, status) and lines (order, part, number) in it."""
    spark.sql("select 1L as c_custkey, 'c' as c_name, 1 as c_nationkey, 0D as c_acctbal, 'm' as c_mktsegment").write.parquet(f"{path}/customer.parquet")
    spark.sql("select 1 as n_nationkey, 'n' as n_name, 0 as n_regionkey").write.parquet(f"{path}/nation.parquet")
    spark.sql("select id as p_partkey, concat('p', id) as p_name, 'Brand#12' as p_brand, 't' as p_type, 1 as p_size, 1D as p_retailprice "
              "from range(1, 9)").write.parquet(f"{path}/part.parquet")
    spark.createDataFrame(orders, "o_orderkey long, day string, o_orderstatus string").selectExpr(
        "o_orderkey", "1L as o_custkey", "o_orderstatus", "10D as o_totalprice", "cast(day as timestamp_ntz) as o_orderdate",
        "'1-URGENT' as o_orderpriority").write.parquet(f"{path}/orders.parquet")
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_linenumber int").selectExpr(
        "l_orderkey", "l_partkey", "1L as l_suppkey", "l_linenumber", "1D as l_quantity", "2D as l_extendedprice", "0D as l_discount",
        "0D as l_tax", "if(l_linenumber = 1, 'R', 'N') as l_returnflag", "if(l_linenumber = 2, 'O', 'F') as l_linestatus",
        "timestamp_ntz'1996-01-01 00:00:00' as l_shipdate").write.parquet(f"{path}/lineitem.parquet")
    return Lakehouse(spark, str(path))


ORDERS = [(1, "1996-01-31", "F"), (2, "1996-02-01", "F"), (2, "1996-05-01", "F"), (3, "1997-03-01", "O"), (None, "1996-01-05", "F")]
LINES = [(1, 1, 1), (1, 2, 2), (1, 2, 2), (2, 3, 1), (2, 99, 2), (3, 4, 1), (None, 5, 1), (7, 5, 1)]


def test_lines_are_dealt_by_their_document_once(spark, tmp_path):
    lake = small_lake(spark, tmp_path, ORDERS, LINES)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text, out = plan_of(lake.sale_lines()), lake.sale_lines().collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "hashpartitioning(transaction_id" not in text and "hashpartitioning(l_orderkey" not in text
    assert "_o0" not in text[text.rindex("Exchange hashpartitioning(l_partkey"):]
    found = sorted((str(r["transaction_id"]), r["row_num_transaction_id"], str(r["product_id"]), r["number_of_line_item"]) for r in out)
    assert found == [
        ("None", 1, "None", 1), ("R1", 1, "1", 1), ("R2", 1, "3", 2), ("R2", 2, "3", 2), ("R3", 1, "4", 1),
        ("T1", 1, "1", 3), ("T1", 2, "2", 3), ("T1", 3, "2", 3), ("T2", 1, "3", 4), ("T2", 2, "99", 4), ("T2", 3, "3", 4),
        ("T2", 4, "99", 4), ("T3", 1, "4", 1)]


def test_bills_without_an_order_number_have_no_id(spark, tmp_path):
    lake = small_lake(spark, tmp_path, ORDERS, LINES)
    ids = sorted(str(r["_id"]) for r in lake.landing.sale_bill().select("_id").collect())
    assert ids == ["None", "T1", "T2", "T2", "T3"]


def test_service_documents_meet_their_order_where_they_were_made(spark, tmp_path):
    lake = small_lake(spark, tmp_path, ORDERS, LINES)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan_of(lake.landing.top_up_transaction())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    # the lines, their slices, their slices by order, the orders and twice their customer; no finished document
    assert text.count("Exchange hashpartitioning(l_orderkey") == 3
    assert lake.service_lines().count() == 8


def test_filed_children_are_those_of_the_window(spark, tmp_path):
    lake = small_lake(spark, tmp_path, ORDERS, LINES)
    for first, last in ((date(1996, 1, 31), date(1996, 2, 1)), (date(1996, 1, 1), date(1996, 12, 31)), (date(1997, 1, 1), date(1997, 12, 31))):
        plain, filed = (some.during(first, last).landing for some in (lake, lake.for_many_runs()))
        for days in ((0, 0), (1, 1), (3, -3)):
            shown = [sorted(map(str, landing._lines(days).collect())) for landing in (plain, filed)]
            assert shown[0] == shown[1]
    year = lake.for_many_runs().during(date(1997, 1, 1), date(1997, 12, 31))
    assert "PartitionFilters: [isnotnull(_month" in plan_of(year.landing._lines())


def test_price_pieces_read_and_deal_the_timeline_once(spark, tmp_path):
    lake = small_lake(spark, tmp_path, ORDERS, LINES)
    pieces = facts.price_pieces(price_timeline(lake.landing, facts.PRICE_KEY), lake.span)
    text = plan_of(pieces)
    assert text.count("Scan parquet") == 1 and text.count("Exchange hashpartitioning") == 1
    # 8 parts in 5 areas: 7 years each, two of them not for part 7; a gap before the first and after the last
    found = pieces.drop("_bucket").distinct().groupBy("_gap").count().collect()
    assert sorted((str(r["_gap"]), r["count"]) for r in found) == [("1", 40), ("2", 40), ("None", 8 * 5 * 7 - 2 * 5)]


def test_a_timeline_without_keys_or_rows_has_its_gaps(spark):
    moment = lambda text: f"timestamp_ntz'{text} 00:00:00'"
    rows = spark.sql(f"select * from values (cast(null as string), {moment('2000-01-01')}, {moment('2001-01-01')}, 1D), "
                     f"('a', {moment('2001-01-01')}, {moment('2001-01-01')}, 2D), ('a', {moment('2001-01-01')}, {moment('2001-01-01')}, 2D) "
                     "as t(k, since, until, price)")
    out = with_gaps(rows, ["k"], "since", "until")
    found = sorted((str(r["k"]), str(r["since"])[:4], str(r["until"])[:4], str(r["price"]), str(r["_gap"])) for r in out.collect())
    assert found == [("None", "0001", "2000", "None", "1"), ("None", "2000", "2001", "1.0", "None"), ("None", "2001", "9999", "None", "2"),
                     ("a", "0001", "2001", "None", "1"), ("a", "0001", "2001", "None", "1"), ("a", "0001", "9999", "None", "2"),
                     ("a", "2001", "2001", "2.0", "None"), ("a", "2001", "2001", "2.0", "None")]
    assert with_gaps(rows.where("false"), ["k"], "since", "until").count() == 0


def test_canceled_orders_are_dealt_by_their_order_once(spark):
    deliveries = spark.sql("""select * from values (4L, 'T4', 'D4'), (8L, 'T8', null), (cast(null as long), 'T0', null), (12L, 'T12', 'D12'),
        (16L, 'T16', null) as t(order_id, transaction_id, order_no)""").selectExpr(
        "*", "5L as status", "order_id * 1D as total_price_amount", "timestamp_ntz'2000-01-01 10:00:00' as dom_created_at",
        "1L as payment_method", "'why' as canceled_reason")
    keys = spark.sql("select * from values ('T16', null), ('T1', 'D12') as t(transaction_id, order_no)")
    details = spark.sql("select * from values (4L, 'b'), (4L, 'a'), (4L, 'a'), (4L, null), (12L, 'a'), (null, 'c') as t(order_id, product_id)")
    shape = ", ".join(f"'x' as {c}" for c in facts.CANCELED_PRODUCT_COLUMNS)
    products = spark.sql(f"select 'a' as product_id, {shape}, timestamp_ntz'1999-01-01 00:00:00' as valid_from, "
                         "timestamp_ntz'2009-01-01 00:00:00' as valid_to")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = facts.canceled_orders(deliveries, keys, details, products)
        text, rows = plan_of(out), out.collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "hashpartitioning(coalesce(order_id" not in text and "hashpartitioning(order_id" not in text
    assert "_order" not in out.columns
    found = sorted((str(r["order_id"]), r["row_num_transaction_id"], str(r["product_id"]), r["number_of_line_item"], str(r["product_name"])) for r in rows)
    assert found == [("4", 1, "None", 4, "None"), ("4", 2, "a", 4, "x"), ("4", 3, "a", 4, "x"), ("4", 4, "b", 4, "None"),
                     ("8", 1, "None", 1, "None"), ("None", 1, "None", 1, "None")]


def shuffled_files(spark):
    """Shuffle files that lie in the session's local folders."""
    kept = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {name for folder in kept for name in glob.glob(f"{folder}/*/shuffle_*.data")}


def test_a_stored_table_leaves_no_shuffle_behind(spark, tmp_path):
    lake, before = Lakehouse(spark, str(tmp_path)), shuffled_files(spark)
    table = lake.stored("cleaned", lambda: spark.range(20_000).repartition(7).groupBy((F.col("id") % 5000).alias("k")).count())
    assert table.count() == 5000
    until = time.time() + 20
    while (left := shuffled_files(spark) - before) and time.time() < until:
        time.sleep(0.2)
    assert not left
    assert all(name.endswith(".zstd.parquet") for name in table.inputFiles())
    # what has been returned may be asked again, though its shuffle is gone
    twice = spark.range(1000).repartition(3).groupBy((F.col("id") % 7).alias("k")).count()
    assert sorted(map(tuple, twice.collect())) == sorted(map(tuple, twice.collect()))


def test_a_part_of_a_stored_table_begins_without_the_shuffles_of_the_last(spark, tmp_path):
    before, left = shuffled_files(spark), []

    def parts():
        for n in range(3):
            until = time.time() + 20
            while (found := shuffled_files(spark) - before) and time.time() < until:
                time.sleep(0.2)
            left.append(found)
            yield spark.range(n * 1000, n * 1000 + 1000).repartition(7).groupBy((F.col("id") % 10).alias("k"), "id").count()

    table = Lakehouse(spark, str(tmp_path)).stored("parts", parts, "k", rebalance=False)
    assert left == [set()] * 3
    assert table.count() == 3000 and table.select("id").distinct().count() == 3000


def test_the_fact_made_share_by_share_has_the_same_rows(spark, tmp_path, monkeypatch):
    orders = [*ORDERS, (4, "1996-03-01", "F"), (8, "1996-03-02", "O"), (16, "1998-03-03", "F"), (40, "1996-03-04", "F"), (6, None, "F")]
    lines = [*LINES, (4, 1, 1), (8, 2, 1), (16, 3, 1), (16, 3, 1), (40, 4, 2), (40, None, 3), (6, 1, 1)]
    lake = small_lake(spark, tmp_path, orders, lines)
    spark.sql("select 0 as r_regionkey, 'r' as r_name").write.parquet(f"{tmp_path}/region.parquet")
    spark.sql("select 1L as event_id, timestamp_ntz'1996-03-02 00:00:00' as ts, 4L as user_id, 'purchase' as event_type, 1D as value"
              ).write.parquet(f"{tmp_path}/events.parquet")
    rows = lambda fact: sorted(str(r) for r in fact.select(*PRODUCT_FACT).collect())
    assert len(list(lake.fact_parts())) == 1
    whole = rows(lake.stored_fact())
    monkeypatch.setattr(lakehouse, "SHARE_LINES", 1)
    monkeypatch.setattr(lakehouse, "MOST_SHARES", 2)
    monkeypatch.setattr(lakehouse, "_stored", {})
    shared = Lakehouse(spark, str(tmp_path))
    assert len(list(shared.fact_parts())) == 3
    assert rows(shared.stored_fact()) == whole
    assert len(whole) > 15 and any("canceled" in r for r in whole)


def test_a_share_leaves_out_other_lines_before_any_is_dealt(spark, tmp_path):
    lake = small_lake(spark, tmp_path, ORDERS, LINES)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan_of(lake.landing.sale_bill(keyed=True, share=Share(0, 2)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    dealt = text.split("Exchange hashpartitioning(l_partkey")[1:]
    assert len(dealt) == 2 and all("xxhash64(concat(T" in part.partition("Exchange")[0] for part in dealt)


def rich_lake(spark, path):
    """A small lake with deliveries, returns, repeated and null keys, lines without a product, and events."""
    orders = [*ORDERS, (4, "1996-03-01", "F"), (8, "1996-03-02", "O"), (16, "1998-03-03", "F"), (40, "1996-03-04", "F"), (6, None, "F")]
    lines = [*LINES, (4, 1, 1), (8, 2, 1), (16, 3, 1), (16, 3, 1), (40, 4, 2), (40, None, 3), (6, 1, 1)]
    lake = small_lake(spark, path, orders, lines)
    spark.sql("select 0 as r_regionkey, 'r' as r_name").write.parquet(f"{path}/region.parquet")
    spark.sql("select 1L as event_id, timestamp_ntz'1996-03-02 00:00:00' as ts, 4L as user_id, 'purchase' as event_type, 1D as value"
              ).write.parquet(f"{path}/events.parquet")
    return lake


def test_lines_are_read_once_for_what_the_fact_is_made_of(spark, tmp_path):
    lake = rich_lake(spark, tmp_path)
    text = plan_of(lake.completed())
    assert "lineitem.parquet" not in text and "part.parquet" not in text
    # the stored documents: their numbers, their order numbers and themselves; what was found for their product codes once
    assert text.count("/documents-") == 3 and text.count("/looked_up-") == 1


def test_stored_documents_have_the_numbers_of_whole_ones_whatever_is_read(spark, tmp_path):
    land = rich_lake(spark, tmp_path).landing
    whole = lines.numbered_bills(land.sale_bill(keyed=True), land.sale_return_bill(keyed=True))
    docs = lines.countable(lines.documents(land.sale_bill(keyed=True), False).unionByName(lines.documents(land.sale_return_bill(keyed=True), True)))
    docs.write.parquet(f"{tmp_path}/documents")
    stored = spark.read.parquet(f"{tmp_path}/documents")
    places = lambda df: sorted(map(str, df.select("transaction_id", "_codes", "_before", "number_of_line_item").collect()))
    assert places(lines.numbered(stored)) == places(lines.numbered(stored, "_codes")) == places(whole)


def test_lines_found_by_document_are_those_found_line_by_line(spark):
    item = "named_struct(" + ", ".join(f"'{f}', {{0}}" for f in (*lines.ITEM_FIELDS, "totalAmountByPromotion", "totalAmountWithoutTaxByPromotion")) + ", 'winPromotion', true)"
    bills = spark.sql(f"""select * from values ('T1', 0L, array({item.format('1')}, {item.format('2')})), ('T1', 2L, array({item.format('3')})),
        ('T1', 2L, array({item.format('3')})), ('T2', 0L, null), ('T3', 0L, array({item.format('4')})) as t(transaction_id, _before, _items)""")
    bills = bills.withColumn("_codes", F.col("_items.productCode"))
    # the second line of T1 was dropped, its third has two prices, T3 has none at all
    found = spark.sql("select * from values ('T1', 0L, 1L, 'a'), ('T1', 2L, 3L, 'b'), ('T1', 2L, 3L, 'c'), ('T2', 0L, 1L, 'd') as "
                      "t(transaction_id, _before, row_num_transaction_id, price)")
    out = facts.with_looked_up(bills, found)
    rows = sorted((r["transaction_id"], r["row_num_transaction_id"], r["product_id"], r["final_amount"], r["price"]) for r in out.collect())
    assert rows == [("T1", 1, 1, 1, "a"), *[("T1", 3, 3, 3, "b")] * 2, *[("T1", 3, 3, 3, "c")] * 2, ("T2", 1, None, None, "d")]
    text = plan_of(out)
    assert "row_num_transaction_id" not in "".join(line for line in text.splitlines() if " Sort [" in line)


def test_a_table_of_few_partitions_is_written_without_sorting_its_rows(spark, tmp_path):
    # Spark sorts rows by partition before it writes them unless it may keep some files open
    lake = Lakehouse(tune(spark), str(tmp_path))
    assert int(spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")) >= 2
    table = lake.stored("kinds", lambda: spark.range(1000).selectExpr("id", "id % 9 as kind"), "kind", rebalance=False)
    assert sorted(map(tuple, table.groupBy("kind").count().collect())) == [(0, 112), *[(k, 111) for k in range(1, 9)]]


def test_large_merges_are_made_by_share_with_the_same_rows(spark, tmp_path, monkeypatch):
    lake, names = rich_lake(spark, tmp_path), ("fact_merge", "frontier_union", "fact_product")
    shown = lambda: [sorted(map(str, registered()[name](spark, lake.sf_dir).collect())) for name in names]
    whole = shown()
    monkeypatch.setattr(lakehouse, "SHARE_LINES", 1)
    monkeypatch.setattr(lakehouse, "_stored", {})
    assert shown() == whole and all(whole)
    for name in ("fact_merge", "fact_product"):
        text = plan_of(registered()[name](spark, lake.sf_dir))
        assert "Exchange" not in text and text.count("Scan parquet") == 1
