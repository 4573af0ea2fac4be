"""Registered queries over the sample tables, each beside the DuckDB SQL that must give the same rows.

The sample tables hold no change log, so one is derived from ``orders``: a snapshot, a stale replay, plain updates, key
changes, deletes and re-inserts, with versions that are unique for each key.
"""

from __future__ import annotations

import gzip
import itertools
import json
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.engine import Engine
from millrace.functions import encode, keys
from millrace.functions.kinds import Column, map_column, parse_members
from millrace.functions.text import backoff, expand, parse_duration, parse_size, shorten, version_at_least
from millrace.operators import batching, changes, merge, status
from millrace.plans import preflight as checks
from millrace.plans import schema_gen
from millrace.plans.config import ConfigBuilder
from millrace.plans.config import parse as parse_config
from millrace.plans.mapping import Mapping, Table, compile_plan
from millrace.plans.schema_gen import schema_diff as diff_schemas
from millrace.sources import catalog, changelog, snapshot
from millrace.streaming import metrics, pipeline, sinks, versions
from millrace.streaming.storage import Files, Locked, StreamLock

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

STATES = ("draft", "paid", "shipped", "cancelled")
CHANNELS = ("web", "ios", "android", "pos")
MOVED = 10_000_000  # added to a key that changes
NOW_MS = 1_800_000_000_000


def query(sql: str | None = None, exact: tuple[str, ...] = ()):
    """Register a query; its columns named in exact are decimals, which both sides return as their exact text."""

    def register(f):
        as_text = lambda spark, sf_dir: f(spark, sf_dir).withColumns({c: F.col(c).cast("string") for c in exact})
        QUERIES[f.__name__] = as_text if exact else f
        if sql is not None:
            casts = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in exact)
            SQL[f.__name__] = f"SELECT * REPLACE ({casts}) FROM ({sql})" if exact else sql
        return f

    return register


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "orders").withColumns({"o_totalprice": F.col("o_totalprice").cast("decimal(18,2)"), "o_orderdate": F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")})


ORDERS = "SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(18,2)) AS o_totalprice, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate, o_orderpriority FROM orders"


def change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events (op, before, after, seq) with images (k, status, amount)."""
    base = load(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("status"), F.col("o_totalprice").cast("decimal(18,2)").alias("amount"))
    k = F.col("k")
    none = F.lit(None).cast("struct<k:bigint,status:string,amount:decimal(18,2)>")

    def image(key=k, state=F.col, amount=F.col):
        return F.struct(key.cast("bigint").alias("k"), (state if state is not F.col else F.col("status")).alias("status"), (amount if amount is not F.col else F.col("amount")).cast("decimal(18,2)").alias("amount"))

    def event(op, before, after, seq):
        return F.struct(F.lit(op).alias("op"), before.alias("before"), after.alias("after"), seq.cast("long").alias("seq"))

    late = lambda n: 2_000_000 + k * 8 + n
    same = image()
    gone = (k % 7 == 0) & (k % 11 != 0)
    events = F.array(
        event("snapshot", none, same, F.lit(1000)),
        F.when(k % 5 == 0, event("update", same, image(state=F.lit("STALE")), F.lit(999))),
        F.when(k % 3 == 0, event("update", same, image(state=F.lit("F"), amount=F.col("amount") + 1), late(1))),
        F.when(k % 11 == 0, event("update", same, image(key=k + MOVED), late(2))),
        F.when(gone, event("delete", same, none, late(3))),
        F.when(gone & (k % 2 == 0), event("insert", none, image(state=F.lit("NEW")), late(4))),
    )
    return base.select(F.explode(events).alias("e")).where("e IS NOT NULL").select("e.*")


LOG = """
WITH base AS (
  SELECT o_orderkey AS k, o_orderstatus AS status, CAST(o_totalprice AS DECIMAL(18,2)) AS amount FROM orders
), log AS (
  SELECT 'snapshot' AS op, CAST(NULL AS BIGINT) AS old_k, k AS new_k, status, amount, CAST(1000 AS BIGINT) AS seq FROM base
  UNION ALL SELECT 'update', k, k, 'STALE', amount, CAST(999 AS BIGINT) FROM base WHERE k % 5 = 0
  UNION ALL SELECT 'update', k, k, 'F', CAST(amount + 1 AS DECIMAL(18,2)), 2000000 + k * 8 + 1 FROM base WHERE k % 3 = 0
  UNION ALL SELECT 'update', k, k + 10000000, status, amount, 2000000 + k * 8 + 2 FROM base WHERE k % 11 = 0
  UNION ALL SELECT 'delete', k, CAST(NULL AS BIGINT), status, amount, 2000000 + k * 8 + 3 FROM base WHERE k % 7 = 0 AND k % 11 <> 0
  UNION ALL SELECT 'insert', CAST(NULL AS BIGINT), k, 'NEW', amount, 2000000 + k * 8 + 4 FROM base WHERE k % 14 = 0 AND k % 11 <> 0
), docs AS (
  SELECT old_k AS key, seq AS _version, TRUE AS _is_deleted, CAST(NULL AS VARCHAR) AS status, CAST(NULL AS DECIMAL(18,2)) AS amount
  FROM log WHERE op = 'delete' OR (op = 'update' AND old_k <> new_k)
  UNION ALL SELECT new_k, seq, FALSE, status, amount FROM log WHERE op <> 'delete'
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY key ORDER BY _version DESC) AS rn FROM docs
)
"""


def change_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of the change log: key, _version, _is_deleted, status, amount (null on tombstones)."""
    d = changes.split_key_changes(change_log(spark, sf_dir), ["k"])
    alive = lambda c: F.when(~F.col("deleted"), F.col(f"image.{c}")).alias(c)
    return d.select(F.col("image.k").alias("key"), F.col("seq").alias("_version"), F.col("deleted").alias("_is_deleted"), alive("status"), alive("amount"))


# --- projection -----------------------------------------------------------------------------------------------------


def orders_table(df: DataFrame) -> Table:
    tax = Column("total_with_tax", "decimal", "decimal(18,2)", generated=True, precision=18, scale=2)
    return catalog.from_dataframe(df.withColumn("total_with_tax", F.lit(None).cast("decimal(18,2)")), "shop", "orders", ["o_orderkey"], {"total_with_tax": tax})


def _project(spark, sf_dir, **mapping) -> DataFrame:
    rows = orders(spark, sf_dir)
    return compile_plan(orders_table(rows), Mapping(**mapping)).project(rows)


@query(ORDERS, exact=("o_totalprice",))
def project_default(spark, sf_dir):
    return _project(spark, sf_dir)


@query("SELECT o_orderkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(18,2)) AS o_totalprice FROM orders", exact=("o_totalprice",))
def project_include(spark, sf_dir):
    return _project(spark, sf_dir, include=("o_totalprice", "O_ORDERSTATUS", "o_orderkey"))


@query("SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(18,2)) AS o_totalprice FROM orders", exact=("o_totalprice",))
def project_exclude(spark, sf_dir):
    return _project(spark, sf_dir, exclude=("o_orderdate", "o_orderpriority"))


@query("SELECT o_orderkey AS id, o_orderstatus AS state FROM orders")
def project_rename(spark, sf_dir):
    return _project(spark, sf_dir, include=("o_orderkey", "o_orderstatus"), rename={"o_orderkey": "id", "o_orderstatus": "state"})


@query(LOG + "SELECT op, new_k AS key, seq FROM log WHERE op <> 'delete'")
def filter_upserts(spark, sf_dir):
    return change_log(spark, sf_dir).where(changes.is_upsert()).select("op", F.col("after.k").alias("key"), "seq")


@query(LOG + "SELECT op, seq, CASE WHEN op = 'delete' THEN old_k ELSE new_k END AS k, status, amount FROM log", exact=("amount",))
def event_values(spark, sf_dir):
    events = change_log(spark, sf_dir)
    return events.select("op", "seq", changes.event_values(events).alias("v")).select("op", "seq", "v.k", "v.status", "v.amount")


@query("SELECT o_orderkey, o_orderstatus, CAST(NULL AS VARCHAR) AS o_clerk FROM orders")
def align_by_name(spark, sf_dir):
    return snapshot.align_by_name(orders(spark, sf_dir), [("O_ORDERKEY".lower(), "bigint"), ("o_orderstatus", "string"), ("o_clerk", "string")])


# --- keys -----------------------------------------------------------------------------------------------------------


@query("SELECT o_orderkey, url_encode(o_orderkey || ':' || o_orderpriority) AS key FROM orders")
def doc_key(spark, sf_dir):
    return load(spark, sf_dir, "orders").select("o_orderkey", keys.doc_key([F.concat(F.col("o_orderkey").cast("string"), F.lit(":"), F.col("o_orderpriority"))]).alias("key"))


@query("SELECT conv_id, turn, CAST(conv_id AS VARCHAR) || ':' || CAST(turn AS VARCHAR) || ':' || url_encode(role) AS key FROM conversations")
def doc_key_composite(spark, sf_dir):
    return load(spark, sf_dir, "conversations").select("conv_id", "turn", keys.doc_key([F.col("conv_id"), F.col("turn"), F.col("role")]).alias("key"))


@query("SELECT o_orderkey, 'h' || sha256(url_encode(repeat(o_orderpriority, 120))) AS key FROM orders")
def doc_key_hashed(spark, sf_dir):
    return load(spark, sf_dir, "orders").select("o_orderkey", keys.doc_key([F.repeat("o_orderpriority", F.lit(120))]).alias("key"))


@query("SELECT page_id, url_encode(url) AS key FROM pages")
def doc_key_url(spark, sf_dir):
    return load(spark, sf_dir, "pages").select("page_id", keys.doc_key([F.col("url")]).alias("key"))


# --- encoding -------------------------------------------------------------------------------------------------------


def _orders(spark, sf_dir, **cols) -> DataFrame:
    return load(spark, sf_dir, "orders").select("o_orderkey", *(v.alias(k) for k, v in cols.items()))


K = "o_orderkey"


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 6 = 0 THEN '' ELSE (['draft', 'paid', 'shipped', 'cancelled'])[o_orderkey % 6] END AS label FROM orders")
def enum_label(spark, sf_dir):
    return _orders(spark, sf_dir, label=encode.enum_label(F.col(K) % 6, STATES))


@query("SELECT o_orderkey, 1 + o_orderkey % 4 AS number FROM orders")
def enum_to_ordinal(spark, sf_dir):
    label = F.get(F.array(*map(F.lit, STATES)), (F.col(K) % 4).cast("int"))
    return _orders(spark, sf_dir, number=encode.enum_ordinal(label, STATES).cast("long"))


@query("SELECT o_orderkey, array_to_string(list_filter(['web', 'ios', 'android', 'pos'], lambda x, i: (o_orderkey % 16) & (1 << (i - 1)) <> 0), ',') AS members FROM orders")
def set_members(spark, sf_dir):
    return _orders(spark, sf_dir, members=F.array_join(encode.set_members(F.col(K) % 16, CHANNELS), ","))


@query("SELECT o_orderkey, o_orderkey % 16 AS bits FROM orders")
def set_to_bitmask(spark, sf_dir):
    csv = F.concat_ws(",", *(F.when((F.col(K) % 16).bitwiseAND(F.lit(1 << i)) != 0, F.lit(c)) for i, c in enumerate(CHANNELS)))
    return _orders(spark, sf_dir, bits=encode.set_bitmask(csv, CHANNELS))


@query("SELECT o_orderkey, CAST('18446744073709551616' AS DECIMAL(20,0)) - o_orderkey AS wide FROM orders WHERE o_orderkey > 0", exact=("wide",))
def uint64_exact(spark, sf_dir):
    return _orders(spark, sf_dir, wide=encode.unsigned64(-F.col(K))).where("o_orderkey > 0")


@query("SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS text FROM orders")
def decimal_text(spark, sf_dir):
    return _orders(spark, sf_dir, text=encode.decimal_text(F.col("o_totalprice").cast("decimal(18,2)")))


@query("SELECT page_id, to_base64(encode(url || url)) AS b64 FROM pages")
def base64_bytes(spark, sf_dir):
    return load(spark, sf_dir, "pages").select("page_id", encode.base64_text(F.concat("url", "url").cast("binary")).alias("b64"))


@query("SELECT event_id, coalesce(nullif(CASE WHEN event_id % 9 = 0 THEN '' ELSE props END, ''), 'null') AS json FROM events")
def json_passthrough(spark, sf_dir):
    text = F.when(F.col("event_id") % 9 == 0, F.lit("")).otherwise(F.col("props"))
    return load(spark, sf_dir, "events").select("event_id", encode.json_value(text).alias("json"))


def _zero_dates():
    return F.when(F.col(K) % 10 == 0, F.lit("0000-00-00 00:00:00.000")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss.SSS"))


ZERO = "SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN {} ELSE strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') END AS instant{} FROM orders"


@query(ZERO.format("NULL", ""))
def zero_date_null(spark, sf_dir):
    return _orders(spark, sf_dir, instant=encode.instant_text(_zero_dates(), "UTC", "null").value)


@query(ZERO.format("'1970-01-01T00:00:00Z'", ""))
def zero_date_epoch(spark, sf_dir):
    return _orders(spark, sf_dir, instant=encode.instant_text(_zero_dates(), "UTC", "epoch").value)


@query(ZERO.format("NULL", ", CASE WHEN o_orderkey % 10 = 0 THEN 'zero date' END AS problem"))
def zero_date_error(spark, sf_dir):
    e = encode.instant_text(_zero_dates(), "UTC", "error")
    return _orders(spark, sf_dir, instant=e.value, problem=e.problem)


@query("SELECT o_orderkey, strftime(timezone('UTC', timezone('Asia/Tehran', o_orderdate)), '%Y-%m-%dT%H:%M:%SZ') AS instant FROM orders")
def datetime_to_utc(spark, sf_dir):
    return _orders(spark, sf_dir, instant=encode.instant_text(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"), "Asia/Tehran").value)


@query(r"SELECT event_id, regexp_replace(strftime(ts, '%Y-%m-%dT%H:%M:%S.%f'), '\.?0+$', '') || 'Z' AS instant FROM events")
def rfc3339(spark, sf_dir):
    return load(spark, sf_dir, "events").select("event_id", encode.rfc3339(F.col("ts")).alias("instant"))


@query("SELECT event_id, (epoch_us(ts) // 1000) * 1024 AS seq FROM events")
def seq_floor(spark, sf_dir):
    return load(spark, sf_dir, "events").select("event_id", encode.seq_floor(F.col("ts").cast("timestamp")).alias("seq"))


@query("SELECT event_id, CAST(strlen(CAST(event_id AS VARCHAR)) + coalesce(strlen(props), 0) AS BIGINT) AS bytes FROM events")
def doc_size(spark, sf_dir):
    return load(spark, sf_dir, "events").select("event_id", batching.doc_size(F.col("event_id").cast("string"), F.col("props")).alias("bytes"))


@query("SELECT o_orderkey, 'caf' || chr(CAST(224 + o_orderkey % 32 AS INTEGER)) AS text FROM orders")
def latin1_decode(spark, sf_dir):
    raw = F.unhex(F.concat(F.lit("636166"), F.hex(224 + F.col(K) % 32)))
    return _orders(spark, sf_dir, text=encode.latin1_text(raw))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 4 <> 0 THEN CAST(o_orderkey % 86400 AS BIGINT) * -1000000 ELSE CAST(o_orderkey % 86400 AS BIGINT) * 1000000 + 250000 END AS micros FROM orders")
def time_micros(spark, sf_dir):
    s = F.col(K) % 86400
    two = lambda x: F.lpad(F.floor(x).cast("string"), 2, "0")
    text = F.concat(F.when(F.col(K) % 4 != 0, F.lit("-")).otherwise(F.lit("")), two(s / 3600), F.lit(":"), two(s / 60 % 60), F.lit(":"), two(s % 60), F.when(F.col(K) % 4 == 0, F.lit(".25")).otherwise(F.lit("")))
    return _orders(spark, sf_dir, micros=encode.time_of_day_micros(text))


@query("""SELECT o_orderkey, '{"id":' || o_orderkey || ',"status":"' || o_orderstatus || '","note":' || CASE WHEN o_orderkey % 9 = 0 THEN 'null' ELSE '"' || o_orderpriority || '"' END || ',"meta":{"z": 1, "a": 1.10},"gift":' || CASE WHEN o_orderkey % 2 = 1 THEN 'true' ELSE 'false' END || '}' AS body FROM orders""")
def encode_doc(spark, sf_dir):
    fields = [
        ("id", F.col(K), False), ("status", F.col("o_orderstatus"), False), ("note", F.when(F.col(K) % 9 != 0, F.col("o_orderpriority")), False),
        ("meta", F.lit('{"z": 1, "a": 1.10}'), True), ("gift", encode.bool_value(F.col(K) % 2), False),
    ]
    return _orders(spark, sf_dir, body=encode.json_document(fields))


# --- change algebra -------------------------------------------------------------------------------------------------


@query(LOG + "SELECT key AS k, _version, _is_deleted FROM docs WHERE _is_deleted")
def tombstones(spark, sf_dir):
    return changes.tombstones(change_log(spark, sf_dir), ["k"])


@query(LOG + "SELECT key, _version, _is_deleted, status, amount FROM docs", exact=("amount",))
def key_change_split(spark, sf_dir):
    return change_docs(spark, sf_dir)


@query("SELECT event_id, event_type FROM events WHERE event_type IN ('click', 'purchase')")
def route_filter(spark, sf_dir):
    return changes.watched(load(spark, sf_dir, "events"), ["CLICK", "Purchase"], "event_type").select("event_id", "event_type")


@query("SELECT e.event_id, s.stream FROM events e JOIN (VALUES ('clicks', 'click'), ('all_clicks', 'click'), ('sales', 'purchase')) s(stream, t) ON e.event_type = s.t")
def route_fanout(spark, sf_dir):
    streams = spark.createDataFrame([("clicks", "Click"), ("all_clicks", "click"), ("sales", "PURCHASE")], "stream string, table string")
    return changes.fan_out(load(spark, sf_dir, "events"), streams, "event_type").select("event_id", "stream")


@query(
    LOG
    + """SELECT l.seq, concat_ws(', ',
  CASE WHEN l.old_k <> l.new_k THEN 'k: ' || l.old_k || ' -> ' || l.new_k END,
  CASE WHEN b.status <> l.status THEN 'status: ' || b.status || ' -> ' || l.status END,
  CASE WHEN b.amount <> l.amount THEN 'amount: ' || b.amount || ' -> ' || l.amount END) AS diff, l.old_k
FROM log l JOIN base b ON b.k = l.old_k WHERE l.op = 'update'"""
)
def update_diff(spark, sf_dir):
    updates = change_log(spark, sf_dir).where("op = 'update'")
    return updates.select("seq", changes.update_diff("before", "after", ["k", "status", "amount"]).alias("diff"), F.col("before.k").alias("old_k"))


@query("SELECT CAST(l_orderkey AS BIGINT) AS l_orderkey, CAST(count(*) AS BIGINT) AS n, op FROM (SELECT l_orderkey, CASE l_linenumber % 4 WHEN 0 THEN 'insert' WHEN 1 THEN 'update' WHEN 2 THEN 'delete' ELSE NULL END AS op FROM lineitem) GROUP BY l_orderkey, op")
def classify_row_events(spark, sf_dir):
    names = F.array(*map(F.lit, ("WRITE_ROWS_v2", "UPDATE_ROWSv1", "DELETE_ROWS", "TABLE_MAP")))
    op = changes.classify(F.get(names, F.col("l_linenumber") % 4))
    return load(spark, sf_dir, "lineitem").groupBy("l_orderkey", op.alias("op")).agg(F.count("*").cast("long").alias("n"))


# --- merge ----------------------------------------------------------------------------------------------------------


FINAL = LOG + "SELECT key, status, amount, _version FROM ranked WHERE rn = 1 AND NOT _is_deleted"


@query(FINAL, exact=("amount",))
def final_view(spark, sf_dir):
    return merge.final_view(change_docs(spark, sf_dir), ["key"]).select("key", "status", "amount", "_version")


@query(LOG + "SELECT status, CAST(count(*) AS BIGINT) AS n FROM ranked WHERE rn = 1 AND NOT _is_deleted GROUP BY status")
def final_count(spark, sf_dir):
    return merge.final_view(change_docs(spark, sf_dir), ["key"]).groupBy("status").agg(F.count("*").cast("long").alias("n"))


@query("SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1 AND event_type <> 'purchase'")
def events_latest(spark, sf_dir):
    docs = load(spark, sf_dir, "events").withColumns({"_version": F.unix_micros(F.col("ts").cast("timestamp")), "_is_deleted": F.col("event_type") == "purchase"})
    return merge.final_view(docs, ["user_id"], F.col("event_id")).select("user_id", "event_id", "event_type")


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey, _version FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY _version DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC) AS rn
  FROM (SELECT *, epoch_us(l_shipdate) // 1000 AS _version FROM lineitem)) WHERE rn = 1 AND l_returnflag <> 'R'"""
)
def lineitem_latest(spark, sf_dir):
    docs = load(spark, sf_dir, "lineitem").withColumns({"_version": F.unix_millis(F.col("l_shipdate").cast("timestamp")), "_is_deleted": F.col("l_returnflag") == "R"})
    tie = F.struct("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    return merge.final_view(docs, ["l_orderkey", "l_linenumber"], tie).select("l_orderkey", "l_linenumber", "l_partkey", "_version")


@query(
    """SELECT k, v FROM (
  SELECT o_orderkey AS k, o_orderstatus AS v, 1 AS s FROM orders WHERE o_orderkey % 4 <> 0
  UNION ALL SELECT o_orderkey, 'changed', 2 FROM orders WHERE o_orderkey % 4 = 0)"""
)
def snapshot_plus_changes(spark, sf_dir):
    base = load(spark, sf_dir, "orders").select(F.col(K).alias("k"), F.col("o_orderstatus").alias("v"), F.lit(1000).cast("long").alias("_version"), F.lit(False).alias("_is_deleted"))
    tail = base.where("k % 4 = 0").withColumns({"v": F.lit("changed"), "_version": F.lit(2000).cast("long")})
    return merge.final_view(base.unionByName(tail), ["k"]).select("k", "v")


MERGED = LOG + ", sides AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY _version DESC) AS r FROM docs) SELECT key, status, amount, _version, _is_deleted FROM sides WHERE r = 1"


@query(MERGED, exact=("amount",))
def merge_external_version(spark, sf_dir):
    docs = change_docs(spark, sf_dir)
    current = merge.latest(docs.where("_version <= 1000"), ["key"])
    return merge.merge_external_version(current, docs.where("_version <> 1000"), ["key"]).select("key", "status", "amount", "_version", "_is_deleted")


@query(
    LOG
    + """, arrived AS (SELECT key, _version, (_version * 7919) % 1000003 AS arrival FROM docs)
SELECT key, _version, arrival FROM (SELECT *, max(_version) OVER (PARTITION BY key ORDER BY arrival, _version ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM arrived) WHERE _version <= seen"""
)
def stale_docs(spark, sf_dir):
    arrived = change_docs(spark, sf_dir).select("key", "_version", (F.col("_version") * 7919 % 1000003).alias("arrival"))
    return merge.stale(arrived, ["key"], ["arrival", "_version"])


@query(LOG + "SELECT key, _version, _is_deleted, status, amount FROM ranked WHERE rn = 1", exact=("amount",))
def compaction(spark, sf_dir):
    return merge.compact(change_docs(spark, sf_dir), ["key"])


@query(
    LOG
    + """, v AS (SELECT key, status, amount FROM ranked WHERE rn = 1 AND NOT _is_deleted)
SELECT coalesce(b.k, v.key) AS key, CASE WHEN v.key IS NULL THEN 'missing' WHEN b.k IS NULL THEN 'extra' ELSE 'different' END AS fault
FROM base b FULL JOIN v ON b.k = v.key WHERE v.key IS NULL OR b.k IS NULL OR b.status <> v.status OR b.amount <> v.amount"""
)
def reconcile(spark, sf_dir):
    source = load(spark, sf_dir, "orders").select(F.col(K).alias("key"), F.col("o_orderstatus").alias("status"), F.col("o_totalprice").cast("decimal(18,2)").alias("amount"))
    return merge.reconcile(source, final_view(spark, sf_dir), ["key"], ["status", "amount"])


# --- scan -----------------------------------------------------------------------------------------------------------


@query("SELECT o_orderkey, o_orderstatus FROM orders ORDER BY o_orderkey LIMIT 100")
def snapshot_chunk(spark, sf_dir):
    return snapshot.chunk(load(spark, sf_dir, "orders").select(K, "o_orderstatus"), [K], None, 100)


@query("SELECT conv_id, turn, role FROM conversations WHERE conv_id > 5 OR (conv_id = 5 AND turn > 1) ORDER BY conv_id, turn LIMIT 50")
def snapshot_resume(spark, sf_dir):
    rows = load(spark, sf_dir, "conversations").select("conv_id", "turn", "role")
    return snapshot.chunk(rows, ["conv_id", "turn"], [int(x) for x in snapshot.read_cursor('["5","1"]', 2)], 50)


@query("""SELECT conv_id, turn, '["' || conv_id || '","' || turn || '"]' AS cursor FROM conversations""")
def scan_cursor(spark, sf_dir):
    return load(spark, sf_dir, "conversations").select("conv_id", "turn", snapshot.cursor(["conv_id", "turn"]).alias("cursor"))


@query("SELECT c_custkey, c_name FROM customer")
def snapshot_all_chunks(spark, sf_dir):
    rows, out = load(spark, sf_dir, "customer").select("c_custkey", "c_name"), None
    for part, _ in snapshot.ranges(rows, ["c_custkey"], max(1, rows.count() // 4)):
        out = part if out is None else out.unionByName(part)
    return out


@query(
    """SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 1.0 WHEN o_orderkey % 80 > 0 THEN least(1.0, CAST(o_orderkey % 64 AS DOUBLE) / 64) ELSE NULL END AS progress
FROM (SELECT o_orderkey FROM orders)"""
)
def snapshot_progress(spark, sf_dir):
    total = F.when(F.col(K) % 80 > 0, F.lit(64)).otherwise(F.lit(0))
    return _orders(spark, sf_dir, progress=status.snapshot_progress(F.col(K) % 5 == 0, F.col(K) % 64, total))


# --- batching and outcomes ------------------------------------------------------------------------------------------


@query(LOG + "SELECT key, _version, stream, CAST((row_number() OVER (PARTITION BY stream ORDER BY _version, key) - 1) // 100 AS BIGINT) AS batch FROM (SELECT key, _version, key % 16 AS stream FROM docs)")
def batch_assign_rows(spark, sf_dir):
    docs = change_docs(spark, sf_dir).select("key", "_version", (F.col("key") % 16).alias("stream"))
    return batching.assign_by_rows(docs, ["stream"], ["_version", "key"], 100)


BYTE_BATCHES = """WITH RECURSIVE d AS (
  SELECT event_id, user_id % 16 AS stream, CAST(strlen(CAST(event_id AS VARCHAR)) + coalesce(strlen(props), 0) AS BIGINT) AS bytes, row_number() OVER (PARTITION BY user_id % 16 ORDER BY event_id) AS i FROM events
), w(stream, i, event_id, bytes, batch, n, held) AS (
  SELECT stream, CAST(0 AS BIGINT), CAST(NULL AS BIGINT), CAST(0 AS BIGINT), CAST(0 AS BIGINT), CAST(0 AS BIGINT), CAST(0 AS BIGINT) FROM (SELECT DISTINCT stream FROM d)
  UNION ALL
  SELECT stream, i, event_id, bytes, CASE WHEN full_before OR opens THEN batch + 1 ELSE batch END, CASE WHEN full_before OR opens THEN 1 ELSE n + 1 END, CASE WHEN full_before OR opens THEN bytes ELSE held + bytes END
  FROM (SELECT d.stream, d.i, d.event_id, d.bytes, w.batch, w.n, w.held, w.n >= 100 OR w.held >= 4096 AS full_before, w.n > 0 AND w.held + d.bytes > 4096 AND d.bytes < 4096 AS opens FROM w JOIN d ON d.stream = w.stream AND d.i = w.i + 1)
) SELECT event_id, stream, bytes, batch FROM w WHERE i > 0"""


@query(BYTE_BATCHES)
def batch_assign_bytes(spark, sf_dir):
    docs = load(spark, sf_dir, "events").select("event_id", (F.col("user_id") % 16).alias("stream"), batching.doc_size(F.col("event_id").cast("string"), F.col("props")).alias("bytes"))
    return batching.assign_by_size(docs, "stream", ["event_id"], 100, 4096)


# Statuses that a document store answers with, dealt over the documents.
STATUSES = (200, 201, 409, 404, 429, 503, 400)
STATUS_SQL = "([200, 201, 409, 404, 429, 503, 400])[1 + _version % 7]"
OUTCOME_SQL = f"CASE WHEN {STATUS_SQL} BETWEEN 200 AND 299 THEN 'applied' WHEN {STATUS_SQL} = 409 THEN 'stale' WHEN {STATUS_SQL} = 404 AND _is_deleted THEN 'stale' WHEN {STATUS_SQL} = 429 OR {STATUS_SQL} >= 500 THEN 'retry' ELSE 'rejected' END"


def _outcomes(spark, sf_dir) -> DataFrame:
    code = F.get(F.array(*map(F.lit, STATUSES)), (F.col("_version") % 7).cast("int"))
    return change_docs(spark, sf_dir).withColumn("outcome", batching.classify_outcome(code, F.col("_is_deleted")))


@query(LOG + f"SELECT key, _version, {OUTCOME_SQL} AS outcome FROM docs")
def classify_outcome(spark, sf_dir):
    return _outcomes(spark, sf_dir).select("key", "_version", "outcome")


@query(
    LOG
    + f""", o AS (SELECT key % 16 AS stream, {OUTCOME_SQL} AS outcome FROM docs)
SELECT stream, CAST(count(*) AS BIGINT) AS total, CAST(count(*) FILTER (outcome = 'applied') AS BIGINT) AS applied, CAST(count(*) FILTER (outcome = 'stale') AS BIGINT) AS stale,
       CAST(count(*) FILTER (outcome = 'rejected') AS BIGINT) AS rejected, count(*) FILTER (outcome = 'retry') = 0 AS complete FROM o GROUP BY stream"""
)
def batch_outcome(spark, sf_dir):
    return batching.batch_outcome(_outcomes(spark, sf_dir).withColumn("stream", F.col("key") % 16), ["stream"])


def _problem():
    return F.when((F.col("key") % 77 == 0) & ~F.col("_is_deleted"), F.lit("status: refused"))


BAD = "key % 77 = 0 AND NOT _is_deleted"


@query(LOG + f"SELECT key, _version, CASE WHEN {BAD} THEN 'bad' ELSE 'good' END AS side FROM docs")
def isolate_rejects(spark, sf_dir):
    good, bad = batching.isolate_rejects(change_docs(spark, sf_dir), _problem())
    return good.select("key", "_version", F.lit("good").alias("side")).union(bad.select("key", "_version", F.lit("bad")))


@query(LOG + "SELECT stream, first(key ORDER BY _version, key) || '-' || min(_version) || '-' || max(_version) || '-' || count(*) AS token FROM (SELECT CAST(key AS VARCHAR) AS key, _version, key % 16 AS stream FROM docs) GROUP BY stream")
def dedup_token(spark, sf_dir):
    docs = change_docs(spark, sf_dir).select(F.col("key").cast("string").alias("key"), "_version", (F.col("key") % 16).alias("stream"))
    return batching.dedup_token(docs, ["stream"])


@query(
    LOG
    + f"""SELECT '2026-01-01T00:00:00Z' AS recorded_at, 's' || CAST(key % 3 AS VARCHAR) AS stream, CAST(key AS VARCHAR) AS key, _version AS version, _is_deleted AS deleted, 400 AS status,
  'status: refused' AS reason, CAST(strlen(status) AS BIGINT) AS body_bytes FROM docs WHERE {BAD}"""
)
def dlq_records(spark, sf_dir):
    docs = change_docs(spark, sf_dir)
    _, bad = batching.isolate_rejects(docs, _problem())
    bad = bad.withColumns({"body": F.col("status"), "stream": F.concat(F.lit("s"), (F.col("key") % 3).cast("string")), "key": F.col("key").cast("string")})
    return batching.dead_letters(bad, F.col("stream"), F.lit("2026-01-01T00:00:00Z"), F.lit(400))


@query(LOG + f"SELECT 's' || CAST(key % 3 AS VARCHAR) AS stream, CAST(count(*) AS BIGINT) AS records FROM docs WHERE {BAD} GROUP BY 1")
def dlq_count(spark, sf_dir):
    return batching.dlq_count(dlq_records(spark, sf_dir))


@query(LOG + "SELECT key AS id, status AS state, _version, CAST(_is_deleted AS INTEGER) AS _is_deleted FROM docs")
def versioned_append(spark, sf_dir):
    return batching.versioned_append(change_docs(spark, sf_dir).select(F.struct(F.col("key").alias("id"), F.col("status").alias("state")).alias("doc"), "_version", "_is_deleted"))


# --- status ---------------------------------------------------------------------------------------------------------


def _streams(spark, sf_dir) -> DataFrame:
    return load(spark, sf_dir, "events").withColumn("stream", F.concat(F.lit("s"), (F.col("user_id") % 3).cast("string")))


STREAMS = "(SELECT *, 's' || CAST(user_id % 3 AS VARCHAR) AS stream FROM events)"


@query(f"SELECT stream, CAST(max(epoch_us(ts) // 1000) AS BIGINT) AS last_event_ms, greatest(0.0, CAST({NOW_MS} - max(epoch_us(ts) // 1000) AS DOUBLE) / 1000.0) AS lag_seconds FROM {STREAMS} GROUP BY stream")
def stream_lag(spark, sf_dir):
    return status.stream_lag(_streams(spark, sf_dir), "stream", "ts", NOW_MS)


@query(
    """SELECT user_id, CASE WHEN user_id % 5 = 0 THEN FALSE WHEN user_id % 4 = 0 THEN TRUE ELSE user_id % 700 <= 300 END AS healthy FROM (SELECT DISTINCT user_id FROM events)"""
)
def stream_health(spark, sf_dir):
    users = load(spark, sf_dir, "events").select("user_id").distinct()
    u = F.col("user_id")
    return users.select(u, status.healthy(F.when(u % 5 == 0, F.lit("broken")), F.when(u % 4 != 0, (u % 700).cast("double"))).alias("healthy"))


@query(f"SELECT stream, event_type, CAST(count(*) AS BIGINT) AS events FROM {STREAMS} GROUP BY stream, event_type")
def events_by_operation(spark, sf_dir):
    return status.events_by_operation(_streams(spark, sf_dir), "stream", "event_type")


@query(
    f"""WITH b AS (SELECT stream, user_id, count(*) AS n FROM {STREAMS} GROUP BY stream, user_id), t AS (SELECT unnest([1.0, 10, 50, 100, 500, 1000, 5000, 10000, 50000, 100000, NULL])::DOUBLE AS le)
SELECT stream, le, CAST(count(*) FILTER (le IS NULL OR n <= le) AS BIGINT) AS n FROM b, t GROUP BY stream, le"""
)
def batch_size_histogram(spark, sf_dir):
    sizes = _streams(spark, sf_dir).groupBy("stream", "user_id").agg(F.count("*").alias("rows"))
    return status.histogram(sizes, "rows", ["stream"], status.BATCH_BUCKETS)


# The rules as the reference's operators have them: name, severity, metric, whether above, threshold.
RULES_SQL = """('lag_high', 'warning', 'lag_seconds', TRUE, 300.0), ('lag_critical', 'critical', 'lag_seconds', TRUE, 1800.0), ('position_stale', 'critical', 'checkpoint_age_seconds', TRUE, 600.0),
('dead_letters', 'critical', 'dead_letters_increase', TRUE, 0.0), ('sink_errors', 'warning', 'sink_errors_per_second', TRUE, 0.1), ('queue_full', 'warning', 'queue_events', TRUE, 6000.0),
('scan_stalled', 'warning', 'scan_rows_per_second', FALSE, 0.0), ('stale_writes', 'warning', 'stale_per_second', TRUE, 1.0)"""
METRICS = {"lag_seconds": ("user_id * 3", 1.0), "scan_rows_per_second": ("user_id % 3", 1.0), "checkpoint_age_seconds": ("user_id * 2 % 1300", 1.0), "dead_letters_increase": ("user_id % 2", 1.0), "sink_errors_per_second": ("user_id % 5", 0.05), "queue_events": ("user_id * 7", 1.0), "stale_per_second": ("user_id % 4", 0.5)}


@query(
    "WITH u AS (SELECT DISTINCT user_id FROM events), m AS ("
    + " UNION ALL ".join(f"SELECT user_id, '{name}' AS metric, CAST({e} AS DOUBLE) * {f} AS value FROM u" for name, (e, f) in METRICS.items())
    + f"), r(alert, severity, metric, above, threshold) AS (VALUES {RULES_SQL}) "
    "SELECT CAST(user_id AS VARCHAR) AS stream, alert, severity, value FROM m JOIN r USING (metric) WHERE CASE WHEN above THEN value > threshold ELSE value <= threshold END"
)
def alerts(spark, sf_dir):
    users = load(spark, sf_dir, "events").select("user_id").distinct()
    made = F.array(*(F.struct(F.lit(name).alias("metric"), (F.expr(e).cast("double") * F.lit(f)).alias("value")) for name, (e, f) in METRICS.items()))
    return status.alerts(users.select(F.col("user_id").cast("string").alias("stream"), F.explode(made).alias("m")).select("stream", "m.metric", "m.value"))


@query("SELECT user_id, user_id % 2 = 0 AND user_id % 5 <> 0 AND user_id % 700 <= 300 AS ready FROM (SELECT DISTINCT user_id FROM events)")
def stream_readiness(spark, sf_dir):
    u = F.col("user_id")
    return load(spark, sf_dir, "events").select("user_id").distinct().select(u, status.ready(u % 2 == 0, F.when(u % 5 == 0, F.lit("broken")), (u % 700).cast("double")).alias("ready"))


@query(
    """WITH p AS (SELECT o_custkey AS source, o_orderkey AS stream, 'u' || CAST(o_custkey % 2 AS VARCHAR) AS uuid, CASE WHEN o_orderkey % 50 = 0 THEN 2 ELSE 1 END AS first, o_orderkey % 1000 + 10 AS last FROM orders)
SELECT source, uuid, CASE WHEN min(first) = max(first) THEN uuid || ':' || min(first) || '-' || min(last) END AS start_position, min(first) <> max(first) AS divergent FROM p GROUP BY source, uuid"""
)
def shared_start_position(spark, sf_dir):
    o = load(spark, sf_dir, "orders")
    uuid_ = F.concat(F.lit("u"), (F.col("o_custkey") % 2).cast("string"))
    first = F.when(F.col(K) % 50 == 0, 2).otherwise(1)
    positions = o.select(F.col("o_custkey").alias("source"), F.col(K).alias("stream"), uuid_.alias("uuid"), first.alias("first"), (F.col(K) % 1000 + 10).alias("last"))
    return status.shared_start_position(positions)


# --- schemas and checks ---------------------------------------------------------------------------------------------


@query("SELECT * FROM (VALUES ('total', 'keyword', 'double', 'incompatible'), ('placed_at', 'date', NULL, 'missing'), ('qty', 'long', 'integer', 'incompatible')) t(field, type, found, fault)")
def schema_diff(spark, sf_dir):
    expected = spark.createDataFrame([("id", "integer"), ("total", "keyword"), ("placed_at", "date"), ("note", "keyword"), ("qty", "long"), ("meta", "object")], "field string, type string")
    actual = spark.createDataFrame([("id", "long"), ("total", "double"), ("note", "text_with_keyword"), ("qty", "integer"), ("meta", "flattened"), ("other", "text")], "field string, type string")
    return diff_schemas(expected, actual)


# A server that passes but for its row image and its retention; one that fails every check it can.
SERVER = {"version": "8.0.36-log", "log_bin": "ON", "binlog_format": "ROW", "binlog_row_image": "MINIMAL", "binlog_row_metadata": "FULL", "gtid_mode": "ON", "enforce_gtid_consistency": "ON", "binlog_row_value_options": "", "server_id": "7", "binlog_expire_logs_seconds": "3600", "log_replica_updates": "ON"}
SERVER_GRANTS = ("GRANT REPLICATION SLAVE, REPLICATION CLIENT ON *.* TO `cdc`@`%`", "GRANT SELECT ON `shop`.* TO `cdc`@`%`")
FORK = {"version": "10.6.4-MariaDB", "log_bin": "1", "binlog_format": "MIXED", "gtid_mode": "OFF", "enforce_gtid_consistency": "WARN", "binlog_row_value_options": "PARTIAL_JSON", "server_id": "0"}


@query(
    """WITH t(server, name, ok, fatal) AS (VALUES ('server', 'server_version', TRUE, TRUE), ('server', 'log_bin', TRUE, TRUE), ('server', 'binlog_format', TRUE, TRUE), ('server', 'binlog_row_image', FALSE, TRUE), ('server', 'binlog_row_metadata', TRUE, TRUE),
('server', 'gtid_mode', TRUE, TRUE), ('server', 'enforce_gtid_consistency', TRUE, FALSE), ('server', 'binlog_row_value_options', TRUE, TRUE), ('server', 'server_id', TRUE, TRUE), ('server', 'log_retention', FALSE, FALSE), ('server', 'log_replica_updates', TRUE, FALSE),
('server', 'grant replication slave', TRUE, TRUE), ('server', 'grant replication client', TRUE, TRUE), ('server', 'grant select', TRUE, TRUE))
SELECT * FROM t UNION ALL SELECT 'fork', name, FALSE, fatal FROM t"""
)
def preflight(spark, sf_dir):
    rows = [("server", *c[:3]) for c in checks.evaluate(SERVER, SERVER_GRANTS)] + [("fork", *c[:3]) for c in checks.evaluate(FORK, ["SELECT"])]
    return spark.createDataFrame(rows, "server string, name string, ok boolean, fatal boolean")


# --- streaming ------------------------------------------------------------------------------------------------------


def workspace(spark: SparkSession) -> str:
    """A fresh folder that driver and executors share."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="millrace-")
    return f"{base.rstrip('/')}/stream-{uuid.uuid4().hex[:12]}"


def log_table() -> Table:
    return Table("shop", "orders", (Column("k", "bigint"), Column("status", "varchar", nullable=True), Column("amount", "decimal", precision=18, scale=2, nullable=True)), ("k",))


def _replay(spark: SparkSession, sf_dir: str, stops: int, segments: int = 4) -> DataFrame:
    """Replay the log through the streaming engine; with stops, only so many segments are there before each restart."""
    root = workspace(spark)
    events = change_log(spark, sf_dir)
    stream = pipeline.Stream("orders", compile_plan(log_table(), Mapping(), dialect="store"), root)
    image = events.schema["before"].dataType
    if not stops:
        changelog.write_segments(events, f"{root}/log", segments)
        pipeline.run(stream, changelog.stream_log(spark, f"{root}/log", image)).awaitTermination()
        return _replayed(spark, stream)
    bounds = [0, 1000, 2_000_000, *[2_000_000 + i * 10_000 for i in range(1, segments - 1)], 1 << 62]
    for i, (low, high) in enumerate(zip(bounds[:-1], bounds[1:])):
        part = events.where((F.col("seq") >= low) & (F.col("seq") < high))
        part.write.parquet(f"{root}/log/segment={i:04d}")
        if i % max(1, len(bounds) // (stops + 1)) == 0 and i + 2 < len(bounds):
            pipeline.run(stream, changelog.stream_log(spark, f"{root}/log", image)).awaitTermination()
    pipeline.run(stream, changelog.stream_log(spark, f"{root}/log", image)).awaitTermination()
    return _replayed(spark, stream)


def _replayed(spark: SparkSession, stream: pipeline.Stream) -> DataFrame:
    out = pipeline.view(spark, stream)
    return out.select(F.col("k").alias("key"), "status", F.col("amount").cast("decimal(18,2)").alias("amount"), "_version")


@query(FINAL, exact=("amount",))
def stream_replay_final(spark, sf_dir):
    return _replay(spark, sf_dir, 0)


@query(FINAL, exact=("amount",))
def stream_resume_final(spark, sf_dir):
    return _replay(spark, sf_dir, 2)


# --- the source's events --------------------------------------------------------------------------------------------

# Names of replication events, and what they mean here.
EVENT_NAMES = {"WRITE_ROWS_EVENTv2": "rows", "UPDATE_ROWS_EVENTv1": "rows", "DELETE_ROWS": "rows", "GTID_EVENT": "position", "XID_EVENT": "position", "QUERY_EVENT": "statement", "TABLE_MAP_EVENT": "ignored", "ROTATE_EVENT": "ignored"}


def _nth(texts, n: str) -> str:
    return "([" + ", ".join(f"'{t}'" for t in texts) + f"])[1 + {n} % {len(texts)}]"


@query(f"SELECT event_id, {_nth(EVENT_NAMES, 'event_id')} AS name, {_nth(EVENT_NAMES.values(), 'event_id')} AS becomes FROM events")
def event_dispatch(spark, sf_dir):
    name = F.get(F.array(*map(F.lit, EVENT_NAMES)), (F.col("event_id") % len(EVENT_NAMES)).cast("int"))
    return load(spark, sf_dir, "events").select("event_id", name.alias("name"), changes.dispatch(name).alias("becomes"))


@query("SELECT o_custkey AS tx, o_orderkey AS pair, o_orderstatus AS before, o_orderpriority AS after FROM orders")
def pair_updates(spark, sf_dir):
    """Row images as an update event holds them: before, after, before, after."""
    images = load(spark, sf_dir, "orders").select(F.col("o_custkey").alias("tx"), F.posexplode(F.array("o_orderstatus", "o_orderpriority")).alias("place", "image"), (F.col(K) * 2).alias("at"))
    paired = changes.pair_updates(images.withColumn("position", F.col("at") + F.col("place")), ["tx"], "position", "image")
    return paired.select("tx", F.col("pair").cast("long").alias("pair"), "before", "after")


READABLE = """SELECT o_orderkey, CASE WHEN o_orderkey % 6 = 0 THEN '''''' WHEN o_orderkey % 6 <= 4 THEN (['draft', 'paid', 'shipped', 'cancelled'])[o_orderkey % 6] ELSE '5' END AS state,
  '{' || array_to_string(list_filter(['web', 'ios', 'android', 'pos'], lambda x, i: (o_orderkey % 16) & (1 << (i - 1)) <> 0), ',') || '}' AS channels,
  CASE WHEN o_orderkey % 3 = 0 THEN '0xff' || lower(hex(encode(o_orderstatus))) ELSE o_orderstatus END AS raw, CASE WHEN o_orderkey % 7 = 0 THEN 'NULL' ELSE o_orderpriority END AS note FROM orders"""


@query(READABLE)
def tail_values(spark, sf_dir):
    raw = F.when(F.col(K) % 3 == 0, F.concat(F.unhex(F.lit("FF")), F.col("o_orderstatus").cast("binary"))).otherwise(F.col("o_orderstatus").cast("binary"))
    return _orders(
        spark, sf_dir, state=changes.readable(F.col(K) % 6, Column("state", "enum", members=STATES)), channels=changes.readable(F.col(K) % 16, Column("channels", "set", members=CHANNELS)),
        raw=changes.readable(raw, binary=True), note=changes.readable(F.when(F.col(K) % 7 != 0, F.col("o_orderpriority"))),
    )


@query("SELECT o_orderkey, CAST(1 + o_orderkey % 4 AS BIGINT) AS state, CAST(o_orderkey % 2 + 2 * (o_orderkey // 2 % 2) AS BIGINT) AS channels, (o_orderkey % 24) * CAST(3600000000 AS BIGINT) AS at FROM orders")
def scan_normalised(spark, sf_dir):
    """Scanned text of enums, sets and times of day in the log's numbers."""
    k = F.col(K)
    text = _orders(spark, sf_dir, state=F.get(F.array(*map(F.lit, STATES)), (k % 4).cast("int")), channels=F.concat_ws(",", F.when(k % 2 == 1, "web"), F.when(F.floor(k / 2) % 2 == 1, "ios")), at=F.concat(F.lpad((k % 24).cast("string"), 2, "0"), F.lit(":00:00")))
    columns = [Column(K, "bigint"), Column("state", "enum", members=STATES), Column("channels", "set", members=CHANNELS), Column("at", "time")]
    return snapshot.normalised(text, columns).select(K, F.col("state").cast("long").alias("state"), F.col("channels").cast("long").alias("channels"), F.col("at").cast("long").alias("at"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 0 THEN o_orderstatus END AS value, CASE WHEN o_orderkey % 5 = 0 THEN 'not UTF-8: FF' || upper(hex(encode(o_orderstatus))) END AS problem FROM orders")
def utf8_check(spark, sf_dir):
    raw = F.when(F.col(K) % 5 == 0, F.concat(F.unhex(F.lit("FF")), F.col("o_orderstatus").cast("binary"))).otherwise(F.col("o_orderstatus").cast("binary"))
    column = Column("s", "varchar", charset="utf8mb4")
    e = encode.encode_column(column, map_column(column), raw)
    return _orders(spark, sf_dir, value=e.value, problem=e.problem)


@query(r"""SELECT o_orderkey, '{"a\"b\\":"' || o_orderstatus || '\\","t":{"x": 1}}' AS body FROM orders""".replace("\\\\", "\\\\"))
def json_escapes(spark, sf_dir):
    return _orders(spark, sf_dir, body=encode.json_document([('a"b\\', F.concat("o_orderstatus", F.lit("\\")), False), ("t", F.lit('{"x": 1}'), True)]))


@query("SELECT c_custkey, c_name FROM customer")
def scan_ranges(spark, sf_dir):
    """A table scanned in key ranges, of which each goes on after the cursor of the one before."""
    rows, out, cursor, left = load(spark, sf_dir, "customer").select("c_custkey", "c_name"), None, None, True
    size = max(1, rows.count() // 3)
    while left:
        part, cursor = next(snapshot.ranges(rows, ["c_custkey"], size, cursor))
        out, left = part if out is None else out.unionByName(part), cursor is not None
    return out


# --- settings and decisions -----------------------------------------------------------------------------------------

# Units of sizes and of durations.
SIZES = {"B": 1, "KB": 10**3, "MB": 10**6, "GB": 10**9, "TB": 10**12, "KiB": 1 << 10, "MiB": 1 << 20, "GiB": 1 << 30, "TiB": 1 << 40}
TIMES = {"ms": 1, "s": 1000, "m": 60_000, "h": 3_600_000}


@query("SELECT n || u AS text, n * f AS bytes FROM range(1, 51) t(n), (VALUES " + ", ".join(f"('{u}', CAST({f} AS BIGINT))" for u, f in SIZES.items()) + ") s(u, f)")
def size_units(spark, sf_dir):
    return spark.createDataFrame([(f"{n}{u}", parse_size(f"{n}{u}")) for n in range(1, 51) for u in SIZES], "text string, bytes long")


@query("SELECT n || u AS text, n * f AS ms FROM range(1, 51) t(n), (VALUES " + ", ".join(f"('{u}', CAST({f} AS BIGINT))" for u, f in TIMES.items()) + ") s(u, f) UNION ALL SELECT n || 'h' || n || 'm', n * 3660000 FROM range(1, 51) t(n)")
def duration_units(spark, sf_dir):
    texts = [f"{n}{u}" for n in range(1, 51) for u in TIMES] + [f"{n}h{n}m" for n in range(1, 51)]
    return spark.createDataFrame([(t, round(parse_duration(t) * 1000)) for t in texts], "text string, ms long")


@query("SELECT n, 'jdbc:' || CASE WHEN n % 2 = 0 THEN 'host' || n ELSE 'localhost' END || '/shop' AS text FROM range(0, 20) t(n)")
def environment_references(spark, sf_dir):
    return spark.createDataFrame([(n, expand("jdbc:${HOST:-localhost}/shop", {"HOST": f"host{n}"} if n % 2 == 0 else {})) for n in range(20)], "n long, text string")


@query("SELECT major || '.' || minor || '.' || patch AS version, major * 10000 + minor * 100 + patch >= 80001 AS enough FROM range(5, 10) a(major), range(0, 5) b(minor), range(0, 4) c(patch)")
def version_floor(spark, sf_dir):
    return spark.createDataFrame([(f"{a}.{b}.{c}", version_at_least(f"{a}.{b}.{c}", checks.OLDEST_SERVER)) for a in range(5, 10) for b in range(5) for c in range(4)], "version string, enough boolean")


@query(
    """SELECT pos, done, cur, started, enabled, CASE WHEN pos AND (done OR NOT enabled) THEN 'tail' WHEN NOT enabled THEN 'start_here' WHEN cur AND started THEN 'resume_scan' ELSE 'scan' END AS decision
FROM (VALUES (TRUE), (FALSE)) a(pos), (VALUES (TRUE), (FALSE)) b(done), (VALUES (TRUE), (FALSE)) c(cur), (VALUES (TRUE), (FALSE)) d(started), (VALUES (TRUE), (FALSE)) e(enabled)"""
)
def resume_decision(spark, sf_dir):
    states = itertools.product((True, False), repeat=5)
    rows = [(p, d, c, s, e, versions.resume_decision(versions.Checkpoint("s", "5" if p else "", d, "5" if s else "", '["9"]' if c else ""), e)) for p, d, c, s, e in states]
    return spark.createDataFrame(rows, "pos boolean, done boolean, cur boolean, started boolean, enabled boolean, decision string")


@query("SELECT n, 1000 * 1024 + n AS version FROM range(0, 25) t(n)")
def version_blocks(spark, sf_dir):
    """Versions in blocks of ten; the clock stands still, so each block follows the one before."""
    allocator = versions.Allocator(versions.MemoryStore(), "s", block=10, clock=lambda: 1000)
    return spark.createDataFrame([(n, allocator.next()) for n in range(25)], "n long, version long")


@query("SELECT * FROM (VALUES ('o_custkey', 'long'), ('o_orderdate', 'keyword'), ('o_orderkey', 'long'), ('o_orderpriority', 'keyword'), ('o_orderstatus', 'keyword'), ('o_totalprice', 'keyword')) t(field, type)")
def index_fields(spark, sf_dir):
    plan = compile_plan(orders_table(orders(spark, sf_dir)), Mapping())
    made = json.loads(schema_gen.index_mapping(plan)[0])["mappings"]["properties"]
    return spark.createDataFrame([(f, t["type"]) for f, t in made.items()], "field string, type string")


# --- delivery and the engine ----------------------------------------------------------------------------------------


def _index_answers(address, path, headers, body):
    """An index that finds every third document stale and refuses every seventh."""
    lines, items = iter(gzip.decompress(body).decode().splitlines()), []
    for line in lines:
        ((action, meta),) = json.loads(line).items()
        if action == "index":
            next(lines)
        code = 400 if int(meta["_id"]) % 7 == 0 else 409 if int(meta["_id"]) % 3 == 0 else 404 if action == "delete" and int(meta["_id"]) % 2 else 200
        items.append({action: {"status": code, "error": "refused"}})
    return 200, json.dumps({"items": items}).encode()


def _store_answers(address, path, headers, body):
    rows = [json.loads(line) for line in gzip.decompress(body).decode().splitlines()]
    return (400, b"bad row") if any(r["k"] % 500 == 7 for r in rows) else (200, b"")


def _delivered(spark, sf_dir, kind, transport) -> DataFrame:
    plan = compile_plan(log_table(), Mapping(), dialect="index" if kind == "index" else "store")
    last = merge.latest(changes.sink_documents(change_log(spark, sf_dir), plan), ["key"])
    return sinks.deliver(last, sinks.Delivery(kind, "orders", ("a", "b"), rows=200, transport=transport))


LAST = LOG + ", last AS (SELECT * FROM ranked WHERE rn = 1)"


@query(
    LAST
    + """, o AS (SELECT *, CASE WHEN key % 7 = 0 THEN 'rejected' WHEN key % 3 = 0 OR (_is_deleted AND key % 2 = 1) THEN 'stale' ELSE 'applied' END AS outcome FROM last)
SELECT CAST(key AS VARCHAR) AS key, _version, _is_deleted, CAST(400 AS INTEGER) AS status, CAST(0 AS BIGINT) AS applied, CAST(0 AS BIGINT) AS stale FROM o WHERE outcome = 'rejected'
UNION ALL SELECT 'all', NULL, NULL, NULL, count(*) FILTER (outcome = 'applied'), count(*) FILTER (outcome = 'stale') FROM o"""
)
def index_delivery(spark, sf_dir):
    return _outcome_rows(_delivered(spark, sf_dir, "index", _index_answers))


@query(
    LAST
    + """SELECT CAST(key AS VARCHAR) AS key, _version, _is_deleted, CAST(400 AS INTEGER) AS status, CAST(0 AS BIGINT) AS applied, CAST(0 AS BIGINT) AS stale FROM last WHERE key % 500 = 7
UNION ALL SELECT 'all', NULL, NULL, NULL, count(*), 0 FROM last WHERE key % 500 <> 7"""
)
def store_delivery(spark, sf_dir):
    """Batches that hold a bad row are halved until it stands alone."""
    return _outcome_rows(_delivered(spark, sf_dir, "store", _store_answers))


def _outcome_rows(outcomes: DataFrame) -> DataFrame:
    out = spark_table(outcomes)
    refused = out.where("key IS NOT NULL").select("key", "_version", "_is_deleted", "status", "applied", "stale")
    none = lambda t: F.lit(None).cast(t)
    return refused.unionByName(out.agg(F.sum("applied").alias("applied"), F.sum("stale").alias("stale")).select(F.lit("all").alias("key"), none("long").alias("_version"), none("boolean").alias("_is_deleted"), none("int").alias("status"), "applied", "stale"))


def spark_table(df: DataFrame) -> DataFrame:
    """df as written, so that nothing is sent twice."""
    path = f"{workspace(df.sparkSession)}/written"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _engine(spark: SparkSession, sf_dir: str, more: str = "") -> tuple[Engine, str]:
    root, events = workspace(spark), change_log(spark, sf_dir)
    events.where("op = 'snapshot'").select("after.*").write.parquet(f"{root}/src/shop.orders/scan")
    changelog.write_segments(events.where("seq >= 2000000"), f"{root}/src/shop.orders/log", 3)
    text = f"source: {{dsn: '{root}/src'}}\ncheckpoint: '{root}/state'\nruntime: {{metrics: ''}}\nstreams: {{orders: {{table: shop.orders, sink: {{type: table, target: /t}}{more}}}}}"
    return Engine(spark, parse_config(text, {}), {"shop.orders": log_table()}), root


def _shown(df: DataFrame) -> DataFrame:
    return df.select(F.col("k").alias("key"), "status", F.col("amount").cast("decimal(18,2)").alias("amount"))


FINAL_ROWS = f"SELECT key, status, amount FROM ({FINAL})"


@query(FINAL_ROWS, exact=("amount",))
def engine_run(spark, sf_dir):
    """Scan in chunks, then the log, through the engine."""
    engine, _ = _engine(spark, sf_dir, f", snapshot: {{chunk_rows: {max(1, load(spark, sf_dir, 'orders').count() // 3)}, rows_per_second: 0}}")
    engine.run()
    return _shown(engine.view("orders"))


@query(FINAL_ROWS, exact=("amount",))
def engine_rebuild(spark, sf_dir):
    """Half of the log, a compacted copy that readers move to, then the other half."""
    engine, root = _engine(spark, sf_dir)
    log = f"{root}/src/shop.orders/log"
    held = spark.read.parquet(log).where("seq % 2 = 1")
    held.write.parquet(f"{root}/late")
    spark.read.parquet(log).where("seq % 2 = 0").write.parquet(f"{root}/early")
    spark.read.parquet(f"{root}/early").write.mode("overwrite").parquet(log)
    engine.run()
    engine.rebuild("orders", 1)
    spark.read.parquet(f"{root}/late").write.mode("append").parquet(log)
    engine.run()
    return _shown(engine.view("orders"))


@query(f"SELECT key, CASE WHEN key % 10 = 1 THEN 'REPAIRED' ELSE status END AS status, amount FROM ({FINAL_ROWS})", exact=("amount",))
def engine_resnapshot(spark, sf_dir):
    """Rows that were stored wrongly are put right by a new scan of the table as it is now."""
    engine, root = _engine(spark, sf_dir)
    engine.run()
    status_now = F.when(F.col("k") % 10 == 1, "REPAIRED").otherwise(F.col("status"))
    engine.view("orders").select("k", status_now.alias("status"), "amount").write.parquet(f"{root}/now")
    spark.read.parquet(f"{root}/now").write.mode("overwrite").parquet(f"{root}/src/shop.orders/scan")
    engine.resnapshot("orders", confirm=True)
    engine.run()
    return _shown(engine.view("orders"))


@query(LOG + "SELECT 'orders' AS stream, CAST(max(seq) AS VARCHAR) AS position, TRUE AS snapshot_done, count(*) FILTER (op = 'snapshot') AS rows_done, count(*) FILTER (op = 'snapshot') AS rows_total, 1.0 AS progress, '' AS last_error, TRUE AS healthy FROM log")
def engine_status(spark, sf_dir):
    engine, _ = _engine(spark, sf_dir)
    engine.run()
    return engine.status().select("stream", "position", "snapshot_done", "rows_done", "rows_total", "progress", "last_error", "healthy")


@query("SELECT CAST(o_orderkey AS VARCHAR) AS key, o_orderkey % 9 > 4 AS refused, CASE WHEN o_orderkey % 9 > 4 THEN 'state: no enum member ' || o_orderkey % 9 END AS reason FROM orders")
def stream_dead_letters(spark, sf_dir):
    """Events whose values cannot be written go to the dead-letter log, the others to the table."""
    root = workspace(spark)
    table = Table("shop", "t", (Column("id", "bigint"), Column("state", "enum", nullable=True, members=STATES)), ("id",))
    image = F.struct(F.col(K).cast("bigint").alias("id"), (F.col(K) % 9).cast("int").alias("state"))
    events = load(spark, sf_dir, "orders").select(F.lit("insert").alias("op"), F.lit(None).cast("struct<id:bigint,state:int>").alias("before"), image.alias("after"), F.col(K).cast("long").alias("seq"))
    stream = pipeline.Stream("t", compile_plan(table, Mapping(), dialect="store"), root)
    pipeline.write_batch(stream, events, 0)
    good = pipeline.versions(spark, stream).select("key", F.lit(False).alias("refused"), F.lit(None).cast("string").alias("reason"))
    return good.union(spark.read.json(stream.path("dlq")).select("key", F.lit(True), "reason"))


# --- definitions, schemas and requests ------------------------------------------------------------------------------


@query("SELECT n, string_agg('m' || i || CASE WHEN i % 3 = 0 THEN '''' ELSE '' END, '|' ORDER BY i) AS members FROM range(1, 21) t(n), range(1, 21) s(i) WHERE i <= n GROUP BY n")
def declared_members(spark, sf_dir):
    """Members of enum and set declarations, with quotes in some labels."""
    labels = lambda n: [f"m{i}" + ("'" if i % 3 == 0 else "") for i in range(1, n + 1)]
    declared = lambda n: ("enum" if n % 2 else "set") + "(" + ",".join("'" + x.replace("'", "''") + "'" for x in labels(n)) + ")"
    return spark.createDataFrame([(n, "|".join(parse_members(declared(n)))) for n in range(1, 21)], "n long, members string")


@query("SELECT * FROM (VALUES (1, 'id', 'bigint', FALSE, 0), (2, 'state', 'enum', TRUE, 2), (3, 'total', 'decimal', TRUE, 0), (4, 'gross', 'decimal', TRUE, 0)) t(place, name, type, nullable, members)")
def catalog_columns(spark, sf_dir):
    """A definition from catalogue rows that come in any order."""
    rows = [
        {"name": "total", "data_type": "decimal", "column_type": "decimal(18,2)", "nullable": True, "precision": 18, "scale": 2, "ordinal": 3}, {"name": "id", "data_type": "bigint", "ordinal": 1},
        {"name": "gross", "data_type": "decimal", "nullable": True, "generated": True, "precision": 18, "scale": 2, "ordinal": 4}, {"name": "state", "data_type": "enum", "column_type": "enum('a','b')", "nullable": True, "ordinal": 2},
    ]
    table = catalog.from_rows("shop", "orders", rows, ["id"])
    return spark.createDataFrame([(i + 1, c.name, c.data_type, c.nullable, len(c.members)) for i, c in enumerate(table.columns)], "place int, name string, type string, nullable boolean, members int")


@query(
    """SELECT n, s AS statement, d AS dropped FROM (VALUES (0, 'ALTER TABLE orders ADD x int', TRUE), (1, 'insert into orders values (1)', FALSE), (2, ' create table t (a int)', TRUE), (3, 'DROP TABLE t', TRUE),
(4, 'update orders set a = 1', FALSE), (5, 'rename table a to b', TRUE), (6, 'TRUNCATE orders', TRUE), (7, 'BEGIN', FALSE), (8, 'select alter from t', FALSE)) t(n, s, d)"""
)
def statements_that_define(spark, sf_dir):
    """Statements after which definitions are loaded again."""
    texts = ["ALTER TABLE orders ADD x int", "insert into orders values (1)", " create table t (a int)", "DROP TABLE t", "update orders set a = 1", "rename table a to b", "TRUNCATE orders", "BEGIN", "select alter from t"]
    out = []
    for n, text in enumerate(texts):
        loads: list[str] = []
        known = catalog.Catalog(lambda s, t, loads=loads: loads.append(t) or Table(s, t, ()))
        known.get("shop", "orders")
        known.saw(text, "shop")
        known.get("shop", "orders")
        out.append((n, text, len(loads) == 2))
    return spark.createDataFrame(out, "n int, statement string, dropped boolean")


WIDE = Table(
    "shop", "things",
    (Column("id", "bigint", "bigint unsigned"), Column("state", "enum", nullable=True, members=("a", "b")), Column("tags", "set", nullable=True, members=("x",)), Column("total", "decimal", "decimal(18,2)", True, precision=18, scale=2), Column("seen", "timestamp", nullable=True), Column("meta", "json", nullable=True), Column("raw", "varbinary", nullable=True), Column("flag", "tinyint", "tinyint(1)")),
    ("id",),
)


@query("SELECT * FROM (VALUES ('flag', 'boolean'), ('id', 'unsigned_long'), ('meta', 'object'), ('raw', 'binary'), ('seen', 'date'), ('state', 'keyword'), ('tags', 'keyword'), ('total', 'keyword')) t(field, type)")
def index_schema(spark, sf_dir):
    made = json.loads(schema_gen.index_mapping(compile_plan(WIDE, Mapping()))[0])["mappings"]["properties"]
    return spark.createDataFrame([(f, t["type"]) for f, t in made.items()], "field string, type string")


@query(
    """SELECT * FROM (VALUES ('ENGINE', 'ReplacingMergeTree(_version, _is_deleted)'), ('ORDER BY', '(`thing``s id`)'), ('_is_deleted', 'UInt8'), ('_version', 'UInt64'), ('flag', 'Bool'), ('thing``s id', 'UInt64'), ('meta', 'Nullable(String)'), ('raw', 'Nullable(String)'),
('state', 'LowCardinality(Nullable(String))'), ('tags', 'Array(String)'), ('total', 'Nullable(Decimal(18, 2))')) t(name, type)"""
)
def store_schema(spark, sf_dir):
    """Lines of a column store's table, but for its instant; a name with a quote in it stays one name."""
    ddl, _ = schema_gen.store_ddl(compile_plan(WIDE, Mapping(rename={"id": "thing`s id"}, exclude=("seen",)), dialect="store"), "shop")
    rows = [tuple(line.strip().rstrip(",")[1:].rsplit("` ", 1)) for line in ddl.splitlines() if line.startswith("  `")]
    tail = ddl[ddl.index(") ENGINE = ") + len(") ENGINE = ") :].split("\nORDER BY ")
    return spark.createDataFrame([*rows, ("ENGINE", tail[0]), ("ORDER BY", tail[1])], "name string, type string")


@query("SELECT n, least(30.0, 0.2 * pow(2, n)) AS least, least(30.0, 0.2 * pow(2, n)) * 1.5 AS most FROM range(0, 12) t(n)")
def backoff_bounds(spark, sf_dir):
    return spark.createDataFrame([(n, float(backoff(n, jitter=lambda: 0.0)), float(backoff(n, jitter=lambda: 1.0))) for n in range(12)], "n long, least double, most double")


@query("SELECT n, CASE WHEN n <= 10 THEN repeat('x', n) ELSE repeat('x', 10) || '…' END AS text FROM range(0, 25) t(n)")
def shortened_text(spark, sf_dir):
    return spark.createDataFrame([(n, shorten("x" * n, 10)) for n in range(25)], "n long, text string")


@query(
    """SELECT * FROM (VALUES (0, 'a', 8, 413), (1, 'b', 4, 200), (2, 'a', 4, 503), (3, 'b', 4, 200), (4, 'a', 1, 200)) t(n, address, docs, status)"""
)
def index_requests(spark, sf_dir):
    """What a bulk of eight documents sends: halves when it is too large, all again when the server is down, one again that it put off."""
    calls, put_off = [], set()

    def transport(address, path, headers, body):
        keys = [json.loads(line)["index"]["_id"] for line in gzip.decompress(body).decode().splitlines()[::2]]
        n = len(calls)
        status = 413 if n == 0 else 503 if n == 2 else 200
        calls.append((n, address, len(keys), status))
        code = lambda k: 429 if status == 200 and k == "7" and k not in put_off and not put_off.add(k) else 200
        return status, json.dumps({"items": [{"index": {"status": code(k)}} for k in keys]}).encode()

    sink = sinks.IndexSink("orders", ["a", "b"], transport, sleep=lambda s: None)
    assert sink.write([sinks.Doc(str(i), "{}", i + 1) for i in range(8)]).applied == 8
    return spark.createDataFrame(calls, "n int, address string, docs int, status int")


@query("""SELECT * FROM (VALUES (0, 'GET', '/orders/_settings', ''), (1, 'PUT', '/orders/_settings', '-1'), (2, 'PUT', '/orders/_settings', '5s'), (3, 'POST', '/orders/_refresh', ''), (4, 'POST', '/orders/_forcemerge?max_num_segments=1', '')) t(n, method, path, "interval")""")
def index_load_mode(spark, sf_dir):
    """A scan turns refreshing off, then puts back what was there, shows the rows and merges."""
    calls, settings = [], {"refresh_interval": "5s"}

    def transport(address, path, headers, body):
        method, sent = headers[":method"], json.loads(body)["index"]["refresh_interval"] if body else ""
        calls.append((len(calls), method, path, sent))
        return 200, json.dumps({"orders": {"settings": {"index": settings}}}).encode()

    sink = sinks.IndexSink("orders", ["a"], transport)
    sink.end_load(sink.begin_load(), merge=True)
    return spark.createDataFrame(calls, "n int, method string, path string, interval string")


@query("SELECT 's' || n AS stream, CAST(n * 10 AS VARCHAR) AS position, n % 2 = 0 AS snapshot_done, n * 7 AS rows_done, CASE WHEN n % 3 = 0 THEN 'failed ' || n ELSE '' END AS last_error FROM range(0, 10) t(n)")
def stored_checkpoints(spark, sf_dir):
    """Checkpoints as a new process finds them."""
    path = f"{workspace(spark)}/checkpoints"
    for n in range(10):
        versions.FileStore(Files(spark), path).save(versions.Checkpoint(f"s{n}", "0"))
        versions.FileStore(Files(spark), path).save(versions.Checkpoint(f"s{n}", str(n * 10), n % 2 == 0, snapshot_rows_done=n * 7, last_error=f"failed {n}" if n % 3 == 0 else ""))
    found = [versions.FileStore(Files(spark), path).load(f"s{n}") for n in range(10)]
    return spark.createDataFrame([(c.stream, c.position, c.snapshot_done, c.snapshot_rows_done, c.last_error) for c in found], "stream string, position string, snapshot_done boolean, rows_done long, last_error string")


@query(LOG + "SELECT op, seq, coalesce(old_k, new_k) AS k FROM log WHERE seq >= 2000000")
def captured_events(spark, sf_dir):
    """A log copied by the diagnostic tail, as its reader finds it."""
    engine, root = _engine(spark, sf_dir)
    engine.capture("shop.orders", f"{root}/copy")
    schema = changelog.event_schema(change_log(spark, sf_dir).schema["after"].dataType)
    return spark.read.schema(schema).json(f"{root}/copy/events").select("op", "seq", F.coalesce("before.k", "after.k").alias("k"))


@query("SELECT 'r' || lpad(CAST(n AS VARCHAR), 2, '0') AS stream, CAST(n - 1 AS BIGINT) AS place, 12 * (8192 * CAST(1024 AS BIGINT) + 4 * CAST(5242880 AS BIGINT)) AS bytes FROM range(1, 13) t(n)")
def configured_streams(spark, sf_dir):
    """Streams in order of name, whatever their order in the file, and what queues and batches of all may hold."""
    builder = ConfigBuilder().source("x").checkpoint("c")
    for n in range(12, 0, -1):
        builder.table_stream(f"r{n:02d}", "shop.orders", "/t")
    config = parse_config(builder.to_yaml(), {})
    return spark.createDataFrame([(name, i, config.memory_bound()) for i, (name, _) in enumerate(config.selected())], "stream string, place long, bytes long")


@query("SELECT * FROM (VALUES (0, 'first', 'held'), (1, 'second', 'refused'), (2, 'after 59 s', 'refused'), (3, 'after 61 s', 'held'), (4, 'after release', 'held')) t(n, who, outcome)")
def stream_locks(spark, sf_dir):
    """One owner at a time; one that no longer renews its lock is followed by the next."""
    files, path, now = Files(spark), f"{workspace(spark)}/s.lock", [1000.0]
    lock = lambda who: StreamLock(files, path, who, ttl=60, clock=lambda: now[0])
    out = []

    def attempt(who: str) -> StreamLock | None:
        try:
            held = lock(who).__enter__()
        except Locked:
            held = None
        out.append((len(out), who, "held" if held else "refused"))
        return held

    attempt("first").done.set()  # as if its process had died
    attempt("second")
    now[0] += 59
    attempt("after 59 s")
    now[0] += 2
    attempt("after 61 s").__exit__()
    attempt("after release").__exit__()
    return spark.createDataFrame(out, "n int, who string, outcome string")


@query("SELECT * FROM (VALUES ('starting', '/healthz', 200), ('starting', '/readyz', 503), ('running', '/healthz', 200), ('running', '/readyz', 200), ('late', '/healthz', 200), ('late', '/readyz', 503), ('failed', '/healthz', 200), ('failed', '/readyz', 503)) t(state, path, code)")
def health_answers(spark, sf_dir):
    from urllib.error import HTTPError
    from urllib.request import urlopen

    states = {"starting": {}, "running": {"streaming": True, "last_apply": 900.0}, "late": {"streaming": True, "last_apply": 600.0}, "failed": {"streaming": True, "last_apply": 900.0, "error": "broken"}}
    out = []
    for state, fields in states.items():
        seen = metrics.Metrics(clock=lambda: 1000.0)
        seen._of("s").update(fields)
        server = metrics.serve(seen, port=0)
        for path in ("/healthz", "/readyz"):
            try:
                code = urlopen(f"http://127.0.0.1:{server.server_address[1]}{path}").status
            except HTTPError as e:
                code = e.code
            out.append((state, path, code))
        server.shutdown()
        server.server_close()
    return spark.createDataFrame(out, "state string, path string, code int")
