from pyspark.sql import functions as F

from tillhouse.functions.contracts import PRODUCT_FACT, SALE_ITEMS, SERVICE_FACT
from tillhouse.functions.nested import read_nested, store_as_text
from tillhouse.functions.types import add_missing, audit_columns, cast_known, conform, void_to_string
from tillhouse.sources.tables import rows


def test_flags_read_from_text_and_numbers(spark):
    text = cast_known(spark.createDataFrame([("true",), ("false",), (None,)], "flag string"), {"flag": "bool"})
    assert [r.flag for r in text.collect()] == [True, False, None]
    number = cast_known(spark.createDataFrame([(1,), (0,)], "flag int"), {"flag": "bool"})
    assert [r.flag for r in number.collect()] == [True, False]


def test_missing_columns_are_typed(spark):
    df = add_missing(spark.createDataFrame([(1,)], "x int"), {"f": "bool", "l": "list", "d": "date", "u": "no such token"})
    assert dict(df.dtypes) == {"x": "int", "f": "boolean", "l": "array<string>", "d": "timestamp_ntz", "u": "string"}
    row = df.first()
    assert (row.f, row.l, row.d, row.u) == (None, [], None, None)


def test_conform_orders_casts_and_survives_bad_values(spark):
    df = spark.createDataFrame([("t01", "1", "5.9", None, "a,b"), ("t02", "x", "oops", "z", "")],
                               "id string, has_invoice string, amt string, extra string, codes string")
    out = conform(df, {"id": "str", "amt": "float", "has_invoice": "bool", "codes": "list_from_str", "gone": "int"})
    assert out.columns == ["id", "amt", "has_invoice", "codes", "gone"]
    assert [tuple(r) for r in out.orderBy("id").collect()] == [
        ("t01", 5.9, True, ["a", "b"], None), ("t02", None, None, [""], None)]


def test_fractions_truncate(spark):
    out = conform(spark.createDataFrame([(2.9,), (-2.9,)], "q double"), {"q": "int"})
    assert sorted(r.q for r in out.collect()) == [-2, 2]


def test_contract_sizes():
    assert (len(PRODUCT_FACT), len(SERVICE_FACT)) == (83, 54)


def test_void_becomes_string_and_audit_is_added(spark):
    df = void_to_string(spark.range(1).withColumn("n", F.lit(None)))
    assert dict(df.dtypes)["n"] == "string"
    assert audit_columns(df).columns[-4:] == ["created_at", "updated_at", "created_by", "updated_by"]


def test_nested_text_and_native_read_alike(spark):
    items = "array(named_struct('quantity', 2, 'productCode', 'p1', 'winPromotion', true))"
    native = spark.range(1).selectExpr(f"{items} as saleNormalItems")
    text = store_as_text(native)
    assert dict(text.dtypes)["saleNormalItems"] == "string"
    a, b = (df.select(read_nested(df, "saleNormalItems", SALE_ITEMS).alias("i")).first().i for df in (native, text))
    assert a == b and a[0].productCode == "p1" and a[0].quantity == 2.0 and a[0].uom is None


def test_malformed_text_is_null(spark):
    df = spark.createDataFrame([("not json",), (None,)], "saleNormalItems string")
    assert [r.i for r in df.select(read_nested(df, "saleNormalItems", SALE_ITEMS).alias("i")).collect()] == [None, None]


def test_literal_rows_under_a_contract(spark):
    df = rows(spark, [("a", 1)], {"k": "str", "n": "int"})
    assert df.dtypes == [("k", "string"), ("n", "bigint")]
