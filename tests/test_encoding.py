from datetime import datetime

import pytest
from pyspark.sql import functions as F

from millrace.functions import encode, keys, text
from millrace.functions.kinds import Column, Kind, UnsupportedColumn, map_column, nullable_store_type, parse_members
from millrace.plans.mapping import Mapping, MappingError, Table, compile_plan, resolve_key, select_columns

ORDER = Table(
    "shop", "orders",
    (
        Column("id", "bigint", "bigint unsigned"), Column("user_id", "bigint", "bigint unsigned"), Column("status", "enum", "enum('draft','paid','shipped')", members=("draft", "paid", "shipped")),
        Column("channels", "set", "set('web','ios','android','pos')", members=("web", "ios", "android", "pos")), Column("total", "decimal", "decimal(18,2)", precision=18, scale=2), Column("gift", "tinyint", "tinyint(1)"),
        Column("note", "varchar", "varchar(64)", True, charset="latin1"), Column("meta", "json", "json", True), Column("placed", "datetime", "datetime(3)", True, fsp=3), Column("updated", "timestamp", "timestamp(3)", fsp=3),
        Column("taxed", "decimal", "decimal(18,2)", generated=True, precision=18, scale=2),
    ),
    ("id",),
)
IMAGE = "struct<id:decimal(20,0),user_id:decimal(20,0),status:int,channels:bigint,total:decimal(18,2),gift:int,note:binary,meta:string,placed:string,updated:string>"


def one(spark, *exprs):
    return spark.range(1).select(*exprs).head()


def order_row(spark, **change):
    from decimal import Decimal

    row = dict(id=Decimal(42), user_id=Decimal(7), status=2, channels=0b0011, total=Decimal("19.90"), gift=1, note=bytes.fromhex("636166E9"), meta='{"coupon":"WELCOME"}', placed="2026-08-11 10:00:00.000", updated="2026-08-11 11:00:00.000")
    row.update(change)
    return spark.createDataFrame([(tuple(row.values()),)], f"r {IMAGE}")


def test_canonical_row(spark):
    plan = compile_plan(ORDER, Mapping(), zone="Asia/Tehran")
    v = order_row(spark).select(plan.values("r").alias("v"), plan.problem("r").alias("p"), plan.body("r").alias("b"), plan.key_of("r").alias("k")).head()
    d = v["v"].asDict()
    assert (d["status"], d["channels"], d["total"], d["gift"], d["note"], d["meta"]) == ("paid", ["web", "ios"], "19.90", True, "café", '{"coupon":"WELCOME"}')
    assert d["placed"] == "2026-08-11T06:30:00Z" and d["updated"] == "2026-08-11T11:00:00Z"
    assert v["p"] is None and v["k"] == "42" and '"meta":{"coupon":"WELCOME"}' in v["b"] and '"total":"19.90"' in v["b"]


def test_unsigned_is_exact_and_never_negative(spark):
    from decimal import Decimal

    plan = compile_plan(ORDER, Mapping())
    big = order_row(spark, id=Decimal("18446744073709551001")).select(plan.key_of("r").alias("k"), plan.body("r").alias("b")).head()
    assert big["k"] == "18446744073709551001" and '"id":18446744073709551001' in big["b"]
    assert "negative" in order_row(spark, user_id=Decimal(-1)).select(plan.problem("r")).head()[0]


def test_nulls_are_written(spark):
    plan = compile_plan(ORDER, Mapping())
    body = order_row(spark, note=None, meta=None, placed=None).select(plan.body("r")).head()[0]
    assert '"note":null' in body and '"meta":null' in body and '"placed":null' in body


@pytest.mark.parametrize("policy,value,problem", [("null", None, None), ("epoch", "1970-01-01T00:00:00Z", None), ("error", None, "zero date")])
def test_zero_dates(spark, policy, value, problem):
    e = encode.instant_text(F.lit("0000-00-00 00:00:00"), "UTC", policy)
    assert tuple(one(spark, e.value.alias("a"), e.problem.alias("b"))) == (value, problem)


def test_bad_values_are_problems(spark):
    plan = compile_plan(ORDER, Mapping())
    assert "no enum member 9" in order_row(spark, status=9).select(plan.problem("r")).head()[0]
    assert "not a date" in order_row(spark, placed="soon").select(plan.problem("r")).head()[0]
    assert order_row(spark, status=0, channels=0).select(plan.values("r").alias("v")).select("v.status", "v.channels").head() == ("", [])


def test_utf8_is_checked(spark):
    col = Column("t", "varchar", charset="utf8mb4")
    e = encode.encode_column(col, map_column(col), F.unhex(F.lit("FF41")))
    assert tuple(one(spark, e.value.alias("a"), e.problem.alias("b"))) == (None, "not UTF-8: FF41")


def test_keys(spark):
    part = lambda *x: one(spark, keys.doc_key([F.lit(v) for v in x]).alias("k"))["k"]
    assert part(100, "SKU-1") == "100:SKU-1" and part(1, "SKU:2") == "1:SKU%3A2" and part("a*b~c+é d") == "a%2Ab~c%2B%C3%A9%20d"
    long = part("x" * 600)
    assert long[0] == "h" and len(long) == 65 and long != part("y" * 600) and part("x" * 512) == "x" * 512
    assert part(None) is None


def test_sets_and_enums(spark):
    labels = ("web", "ios", "android", "pos")
    assert one(spark, encode.set_bitmask(F.lit("web,pos"), labels).alias("b"))["b"] == 9
    assert one(spark, encode.set_bitmask(F.lit("web,tv"), labels).alias("b"))["b"] is None
    many = tuple(f"m{i}" for i in range(64))
    assert one(spark, encode.set_members(encode.set_bitmask(F.lit("m0,m63"), many), many).alias("m"))["m"] == ["m0", "m63"]
    assert parse_members("enum('a','it''s','x,y','(z)','')") == ("a", "it's", "x,y", "(z)", "")
    assert parse_members("varchar(3)") == ()


def test_time_bit_and_instants(spark):
    t = lambda s: one(spark, encode.time_of_day_micros(F.lit(s)).alias("t"))["t"]
    assert (t("-838:59:59"), t("00:00:01.5"), t("x")) == (-3020399000000, 1500000, None)
    assert int(one(spark, encode.bit_number(F.unhex(F.lit("FFFFFFFFFFFFFFFF"))).alias("b"))["b"]) == 2**64 - 1
    r = lambda s: one(spark, encode.rfc3339(F.lit(s).cast("timestamp_ntz")).alias("r"))["r"]
    assert (r("2024-01-01 10:00:00"), r("2024-01-01 00:00:00.250"), r("2024-01-01 00:00:00.000001")) == ("2024-01-01T10:00:00Z", "2024-01-01T00:00:00.25Z", "2024-01-01T00:00:00.000001Z")
    wall = one(spark, encode.parse_wall_clock(F.lit("2024-02-03")).alias("w"))["w"]
    assert wall == datetime(2024, 2, 3)


TYPES = [
    (Column("a", "tinyint", "tinyint(1)"), Kind.BOOL, "boolean", "Bool"), (Column("a", "tinyint", "tinyint unsigned"), Kind.UINT, "short", "UInt8"), (Column("a", "mediumint", "mediumint"), Kind.INT, "integer", "Int32"),
    (Column("a", "bigint", "bigint unsigned"), Kind.UINT, "unsigned_long", "UInt64"), (Column("a", "decimal"), Kind.DECIMAL, "keyword", "Decimal(10, 0)"), (Column("a", "float"), Kind.FLOAT, "float", "Float32"),
    (Column("a", "varchar"), Kind.STRING, "keyword", "String"), (Column("a", "longtext"), Kind.STRING, "text", "String"), (Column("a", "blob"), Kind.BYTES, "binary", "String"), (Column("a", "json"), Kind.JSON, "object", "String"),
    (Column("a", "date"), Kind.DATE, "date", "Date32"), (Column("a", "datetime", fsp=3), Kind.DATETIME, "date", "DateTime64(3)"), (Column("a", "timestamp", fsp=6), Kind.TIMESTAMP, "date", "DateTime64(6, 'UTC')"),
    (Column("a", "time"), Kind.TIME, "long", "Int64"), (Column("a", "year"), Kind.YEAR, "short", "UInt16"), (Column("a", "enum", members=("x",)), Kind.ENUM, "keyword", "LowCardinality(String)"),
    (Column("a", "set", members=("x",)), Kind.SET, "keyword", "Array(String)"), (Column("a", "bit"), Kind.BIT, "long", "UInt64"),
]


@pytest.mark.parametrize("col,kind,index,store", TYPES)
def test_type_map(col, kind, index, store):
    m = map_column(col)
    assert (m.kind, m.index_type, m.store_type) == (kind, index, store)


@pytest.mark.parametrize("col", [Column("a", "point"), Column("a", "vector"), Column("a", "int", generated=True), Column("a", "enum")])
def test_refused_types(col):
    with pytest.raises(UnsupportedColumn):
        map_column(col)


def test_nullable_types():
    assert nullable_store_type(map_column(Column("a", "enum", members=("x",))), True) == "LowCardinality(Nullable(String))"
    assert nullable_store_type(map_column(Column("a", "int")), True) == "Nullable(Int32)"


def test_mapping_rules():
    with pytest.raises(MappingError):
        resolve_key(Table("s", "audit_log", (Column("actor", "varchar"),)), Mapping())
    for bad in (Mapping(key=("nope",)), Mapping(key=("id", "ID")), Mapping(key=("taxed",)), Mapping(key=("note",))):
        with pytest.raises(MappingError):
            resolve_key(ORDER, bad)
    for bad in (Mapping(include=("id",), exclude=("note",)), Mapping(include=("note",)), Mapping(exclude=("id",)), Mapping(exclude=("nope",))):
        with pytest.raises(MappingError):
            select_columns(ORDER, bad)
    for bad in ({"note": "_version"}, {"note": ""}, {"note": "status"}, {"nope": "x"}):
        with pytest.raises(MappingError):
            compile_plan(ORDER, Mapping(rename=bad))
    assert [c.name for c in select_columns(ORDER, Mapping(include=("total", "ID")))] == ["id", "total"]
    with pytest.raises(MappingError):
        compile_plan(Table("s", "t", (Column("k", "int"), Column("x", "varchar", charset="sjis")), ("k",)), Mapping())


def test_settings_text():
    assert text.parse_size("5MiB") == 5 << 20 and text.parse_size("64KiB") == 65536 and text.format_size(1536) == "1536B"
    assert text.parse_duration("1h30m") == 5400 and text.parse_duration("500ms") == 0.5
    assert text.expand("${A}-${B:-x}", {"A": "1"}) == "1-x"
    with pytest.raises(ValueError, match="A, C"):
        text.expand("${A}${C}", {})
    assert text.version_at_least("8.0.36-log", "8.0.4") and not text.version_at_least("5.7", "8.0")
    assert [text.backoff(i, jitter=lambda: 0) for i in (0, 1, 20)] == [0.2, 0.4, 30.0]
