import json

import pytest
from pyspark.sql import functions as F

from millrace import queries as q
from millrace.engine import Engine
from millrace.functions.kinds import Column
from millrace.operators import batching, changes, merge
from millrace.plans import config, preflight, schema_gen
from millrace.plans.mapping import Mapping, Table, compile_plan
from millrace.sources import catalog, changelog, snapshot
from millrace.streaming import metrics, pipeline, sinks, versions
from millrace.streaming.storage import Alias, Files, Locked, StreamLock


@pytest.fixture
def root(spark):
    return q.workspace(spark)


def expected(spark, sf):
    return sorted(tuple(r) for r in q.QUERIES["final_view"](spark, sf).collect())


def view_rows(spark, stream):
    v = pipeline.view(spark, stream)
    return sorted(tuple(r) for r in v.select("k", "status", F.col("amount").cast("string"), "_version").collect())


def test_replay_restart_and_rerun_give_the_batch_result(spark, sf, root):
    events = q.change_log(spark, sf)
    stream = pipeline.Stream("orders", compile_plan(q.log_table(), Mapping(), dialect="store"), root)
    image = events.schema["before"].dataType
    changelog.write_segments(events.where("seq >= 2000000"), f"{root}/log/late", 2)
    pipeline.run(stream, changelog.stream_log(spark, f"{root}/log", image, 1)).awaitTermination()
    changelog.write_segments(events.where("seq < 2000000"), f"{root}/log/early", 1)  # arrives after, is older
    pipeline.run(stream, changelog.stream_log(spark, f"{root}/log", image, 1)).awaitTermination()
    want = expected(spark, sf)
    assert view_rows(spark, stream) == want
    pipeline.write_batch(stream, events.where("seq % 2 = 0"), 99)  # a replay changes nothing
    assert view_rows(spark, stream) == want
    alias = Alias(Files(spark), f"{root}/alias.json")
    copy = pipeline.rebuild(spark, stream, alias, 1)
    assert merge.final_view(copy, ["key"]).count() == len(want)
    assert alias.promote(stream.path("generations/000001")) is False
    with pytest.raises(RuntimeError, match="not complete"):
        alias.promote(f"{root}/nowhere")


def test_refused_events_become_dead_letters(spark, root):
    table = Table("s", "t", (Column("id", "int"), Column("state", "enum", members=("a", "b"))), ("id",))
    image = "struct<id:int,state:int>"
    rows = [("insert", None, (i, 9 if i == 77 else 1), 10 + i) for i in range(70, 80)]
    events = spark.createDataFrame(rows, f"op string, before {image}, after {image}, seq long")
    stream = pipeline.Stream("t", compile_plan(table, Mapping()), root)
    assert pipeline.write_batch(stream, events, 0) == {"total": 10, "applied": 9, "rejected": 1, "version": 89}
    letter = spark.read.json(stream.path("dlq")).collect()
    assert len(letter) == 1 and letter[0]["key"] == "77" and letter[0]["version"] == 87 and "no enum member 9" in letter[0]["reason"] and "body" not in letter[0].asDict()
    strict = pipeline.Stream("u", stream.plan, root, dead_letters=False)
    with pytest.raises(RuntimeError, match="no dead-letter log"):
        pipeline.write_batch(strict, events, 0)


def test_ties(spark):
    docs = spark.createDataFrame([(1, 5, False, "a", 0), (1, 5, False, "b", 1), (2, 1, True, "c", 0)], "key int, _version long, _is_deleted boolean, v string, arrival long")
    assert [r["v"] for r in merge.final_view(docs, ["key"], F.col("arrival")).collect()] == ["b"]
    current = docs.where("v = 'a'").drop("arrival")
    assert [r["v"] for r in merge.merge_external_version(current, docs.where("v = 'b'"), ["key"]).collect()] == ["a"]
    fresh = merge.merge_external_version(current.limit(0), docs.where("key = 1"), ["key"]).collect()
    assert [r["v"] for r in fresh] == ["a"]


def test_scan_chunks_resume_and_hold_the_rate(spark, sf):
    rows = q.load(spark, sf, "conversations").select("conv_id", "turn")
    seen, slept, ticks = 0, [], iter(range(1000))
    marks = []
    for part, cursor, n in snapshot.chunks(rows, ["conv_id", "turn"], 30, rate=10, sleep=slept.append, clock=lambda: next(ticks) * 0.1):
        seen += part.count()
        marks.append(cursor)
    assert seen == rows.count() and all(s > 1 for s in slept)
    rest = sum(n for *_, n in snapshot.chunks(rows, ["conv_id", "turn"], 30, start=marks[0]))
    assert rest == seen - 30
    plan = rows.where(snapshot.after(["conv_id", "turn"], [5, 1]))._jdf.queryExecution().toString()
    assert "PushedFilters: [" in plan and "GreaterThan" in plan
    with pytest.raises(ValueError):
        snapshot.read_cursor('["1"]', 2)


def test_scanned_values_take_the_logs_shape(spark):
    from millrace.functions.kinds import map_column

    col = Column("e", "enum", members=("a", "b"))
    s = Column("s", "set", members=("x", "y"))
    t = Column("t", "time")
    row = spark.range(1).select(*(snapshot.normalise(c, map_column(c), F.lit(v)).alias(c.name) for c, v in ((col, "b"), (s, "x,y"), (t, "01:00:00")))).head()
    assert tuple(row) == (2, 3, 3_600_000_000)


def test_event_shapes(spark):
    image = "struct<id:int,v:string>"
    rows = [("update", (42, "a"), (43, "a"), 9), ("delete", (1, "x"), None, 10), ("snapshot", None, (5, "s"), 1)]
    docs = changes.split_key_changes(spark.createDataFrame(rows, f"op string, before {image}, after {image}, seq long"), ["id"]).collect()
    assert sorted((d["seq"], d["image"]["id"], d["deleted"]) for d in docs) == [(1, 5, False), (9, 42, True), (9, 43, False), (10, 1, True)]
    pairs = changes.pair_updates(spark.createDataFrame([("t", i, f"v{i}") for i in range(4)], "tx string, pos long, img string"), ["tx"], "pos", "img")
    assert sorted((r["before"], r["after"]) for r in pairs.collect()) == [("v0", "v1"), ("v2", "v3")]


def test_byte_batches(spark):
    """A document at the limit or above goes with what is pending; the sinks' batches follow the same rule."""
    for sizes, want in (([40, 40, 40, 500, 10], [0, 0, 1, 1, 2]), ([40, 100, 10], [0, 0, 1]), ([99, 1, 1], [0, 0, 1]), ([99, 2, 98, 100], [0, 1, 1, 2])):
        docs = spark.createDataFrame([("s", i, b) for i, b in enumerate(sizes)], "stream string, n long, bytes long")
        assert [r["batch"] for r in batching.assign_by_size(docs, "stream", ["n"], 1000, 100).orderBy("n").collect()] == want
        dealt = list(sinks.batches((sinks.Doc("k", "x" * (b - 1), 1) for b in sizes), 1000, 100))
        assert [i for i, batch in enumerate(dealt) for _ in batch] == want


def test_versions_and_resume():
    store, now = versions.MemoryStore(), [1000]
    a = versions.Allocator(store, "s", block=3, clock=lambda: now[0])
    first = [a.next() for _ in range(4)]
    assert first[0] == 1000 << 10 and first == sorted(set(first)) and store.saves == 2
    again = versions.Allocator(store, "s", block=3, clock=lambda: 0)
    assert again.next() > first[-1]
    row = versions.Checkpoint("s", position="5", snapshot_done=True)
    assert versions.resume_decision(row, True) == "tail" and versions.resume_decision(None, False) == "start_here" and versions.resume_decision(None, True) == "scan"
    half = versions.Checkpoint("s", position="5", snapshot_start="5", snapshot_cursor='["9"]')
    assert versions.resume_decision(half, True) == "resume_scan" and versions.resume_decision(row.without_scan(), True) == "scan"
    with pytest.raises(RuntimeError):
        store.save(versions.Checkpoint("s", schema_version=2))
    assert versions.Checkpoint("s").lag_seconds(5) is None and versions.Checkpoint("s", last_event_ms=9000).lag_seconds(1000) == 0


def test_lock(spark, root):
    files = Files(spark)
    with StreamLock(files, f"{root}/a.lock", "me"):
        with pytest.raises(Locked, match="me"):
            StreamLock(files, f"{root}/a.lock", "you").__enter__()
    with StreamLock(files, f"{root}/a.lock", "you"):
        pass
    dead = StreamLock(files, f"{root}/b.lock", "killed", ttl=60, clock=lambda: 1000.0)
    files.create(f"{root}/b.lock", dead._text())  # as a killed process leaves it
    with pytest.raises(Locked, match="killed"):
        StreamLock(files, f"{root}/b.lock", "early", ttl=60, clock=lambda: 1050.0).__enter__()
    with StreamLock(files, f"{root}/b.lock", "heir", ttl=60, clock=lambda: 1061.0):
        assert "heir" in files.read_text(f"{root}/b.lock")


class Server:
    def __init__(self, *answers):
        self.answers, self.calls = list(answers), []

    def __call__(self, address, path, headers, body):
        import gzip

        self.calls.append((address, path, headers, gzip.decompress(body).decode()))
        answer = self.answers.pop(0)
        return answer(self.calls[-1]) if callable(answer) else answer


def items(*codes):
    return 200, json.dumps({"items": [{"index": {"status": c}} for c in codes]}).encode()


def docs(n):
    return [sinks.Doc(str(i), f'{{"id":{i}}}', 100 + i) for i in range(n)]


def test_index_sink():
    server = Server(items(201, 409, 503, 400), items(200))
    sink = sinks.IndexSink("orders", ["a", "b"], server, "u", "p", sleep=lambda s: None)
    result = sink.write([*docs(2), sinks.Doc("2", None, 5, True), sinks.Doc("3", "{}", 6)])
    assert (result.applied, result.stale, len(result.rejected)) == (2, 1, 1) and result.total == 4
    assert [c[0] for c in server.calls] == ["a", "b"] and server.calls[0][2]["Authorization"].startswith("Basic ")
    assert server.calls[0][3].splitlines()[0] == '{"index":{"_index":"orders","_id":"0","version":100,"version_type":"external"}}'
    assert server.calls[1][3].splitlines() == ['{"delete":{"_index":"orders","_id":"2","version":5,"version_type":"external"}}']
    halves = Server((413, b""), items(200, 200), items(200, 200))
    assert sinks.IndexSink("o", ["a"], halves, sleep=lambda s: None).write(docs(4)).applied == 4
    with pytest.raises(sinks.SinkError, match="401"):
        sinks.IndexSink("o", ["a"], Server((401, b"no")), sleep=lambda s: None).write(docs(1))
    with pytest.raises(sinks.SinkError, match="5 attempts"):
        sinks.IndexSink("o", ["a"], Server(*[(503, b"")] * 5), sleep=lambda s: None).write(docs(1))
    with pytest.raises(sinks.SinkError, match="answers"):
        sinks.IndexSink("o", ["a"], Server(items(200)), sleep=lambda s: None).write(docs(2))


def test_store_sink_finds_the_bad_row():
    answer = lambda call: (400, b"bad row") if '"id":7,' in call[3] else (200, b"")
    server = Server(*[answer] * 20)
    result = sinks.StoreSink("orders", ["a"], server, database="shop", sleep=lambda s: None).write(docs(10))
    assert result.applied == 9 and [r.doc.key for r in result.rejected] == ["7"]
    assert "insert_deduplication_token=0-100-109-10" in server.calls[0][1] and "shop.orders" in server.calls[0][1]
    assert server.calls[0][3].splitlines()[0] == '{"id":0,"_version":100,"_is_deleted":0}'
    with pytest.raises(sinks.SinkError, match="after 12 divisions"):
        sinks.StoreSink("t", ["a"], lambda *call: (400, b"no such column"), sleep=lambda s: None).write(docs(5000))
    with pytest.raises(sinks.SinkError, match="alone is larger"):
        sinks.IndexSink("o", ["a"], lambda *call: (413, b""), sleep=lambda s: None).write(docs(4))
    with pytest.raises(sinks.SinkError, match="key fields"):
        sinks.StoreSink("t", ["a"], server).write([sinks.Doc("1", None, 1, True)])


def test_schemas(spark):
    table = Table("shop", "orders", (Column("id", "bigint", "bigint unsigned"), Column("meta", "json", nullable=True), Column("tags", "set", nullable=True, members=("a",)), Column("st", "enum", nullable=True, members=("x",))), ("id",))
    plan = compile_plan(table, Mapping(rename={"id": "order_id"}), dialect="store")
    body, notes = schema_gen.index_mapping(plan, 3, 2)
    made = json.loads(body)
    assert made["mappings"]["dynamic"] == "strict" and made["mappings"]["properties"]["meta"] == {"type": "object", "enabled": False} and made["settings"]["number_of_shards"] == 3 and notes
    ddl, _ = schema_gen.store_ddl(plan, "shop")
    assert "`shop`.`orders`" in ddl and "ORDER BY (`order_id`)" in ddl and "`st` LowCardinality(Nullable(String))" in ddl and "ReplacingMergeTree(_version, _is_deleted)" in ddl
    assert "`order_id` decimal(20,0)" in schema_gen.spark_ddl(plan, "t")
    assert schema_gen.compatible("byte", "long") and not schema_gen.compatible("long", "integer") and not schema_gen.compatible("unsigned_long", "long")


def test_catalog_cache():
    loads = []
    c = catalog.Catalog(lambda s, t: loads.append(t) or Table(s, t, ()))
    c.get("Shop", "Orders"), c.get("shop", "ORDERS")
    assert len(loads) == 1
    assert not c.saw("insert into x values (1)") and c.saw("ALTER TABLE orders ADD x int", "shop")
    c.get("shop", "orders")
    assert len(loads) == 2 and c.saw("rename table a to b", "other")
    c.get("shop", "orders")
    assert len(loads) == 3
    made = catalog.from_rows("s", "t", [{"name": "b", "data_type": "int", "ordinal": 2}, {"name": "a", "data_type": "enum", "column_type": "enum('x')", "ordinal": 1}], ["b"])
    assert [x.name for x in made.columns] == ["a", "b"] and made.columns[0].members == ("x",)


def test_purged_position(spark, sf, root):
    q.change_log(spark, sf).where("seq >= 2000000").write.parquet(f"{root}/log")
    changelog.check_position(spark, f"{root}/log", 3_000_000)
    with pytest.raises(changelog.PositionPurged):
        changelog.check_position(spark, f"{root}/log", 1000)


YAML = """
source: {dsn: "${DSN}", time_zone: UTC}
checkpoint: CHECK
streams:
  orders: {table: shop.orders, sink: {type: table, target: /t}}
"""


def test_config():
    c = config.parse(YAML, {"DSN": "x"})
    assert c.streams["orders"].batch.rows == 1000 and c.runtime.buffer == 8192 and c.memory_bound() == 8192 * 1024 + 4 * (5 << 20)
    with pytest.raises(config.ConfigError) as e:
        config.parse("source: {dsn: x, colour: red}\nruntime: {buffer: -1}\nstreams: {bad-name: {table: t, sink: {type: ftp}}}", {})
    for part in ("source.colour: unknown", "checkpoint: missing", "runtime.buffer", "bad-name", ".table", ".sink.type"):
        assert part in str(e.value)
    with pytest.raises(config.ConfigError, match="memory_limit"):
        config.parse(YAML + "runtime: {memory_limit: 1MiB}", {"DSN": "x"})
    with pytest.raises(config.ConfigError, match="DSN"):
        config.parse(YAML, {})
    text = config.ConfigBuilder().source("x").checkpoint("c").index_stream("a", "s.t", ["h"], "i").store_stream("b", "s.t", ["h"], "t").to_yaml()
    assert [n for n, _ in config.parse(text, {}).selected()] == ["a", "b"]


def test_sizes_and_alerts():
    """Fixed values of the engine that this one stands in for."""
    from millrace.functions.text import format_size, parse_size
    from millrace.operators.status import ALERT_RULES

    assert [parse_size(x) for x in ("5KB", "5KiB", "5MB", "5MiB", "2GB", "1TB", "1TiB", "7B", "7")] == [5000, 5120, 5_000_000, 5 << 20, 2 * 10**9, 10**12, 1 << 40, 7, 7]
    assert format_size(1 << 40) == "1TiB"
    with pytest.raises(ValueError):
        parse_size("5k")
    assert {name: severity for name, severity, *_ in ALERT_RULES} == {"lag_high": "warning", "lag_critical": "critical", "position_stale": "critical", "dead_letters": "critical", "sink_errors": "warning", "queue_full": "warning", "scan_stalled": "warning", "stale_writes": "warning"}


def test_preflight_refusals():
    good = {**q.SERVER, "binlog_row_image": "FULL", "binlog_expire_logs_seconds": "604800"}
    check = lambda **changed: {c.name: c for c in preflight.evaluate({k: v for k, v in {**good, **changed}.items() if v is not None}, q.SERVER_GRANTS)}
    for version, ok in (("8.0.0", False), ("8.0.1", True), ("8.4.2-log", True), ("5.7.44", False), ("10.6.4-MariaDB", False), ("9", True), (None, False)):
        assert check(version=version)["server_version"].ok is ok
    assert not check(log_bin="1")["log_bin"].ok and not check(gtid_mode=None)["gtid_mode"].ok
    loose = check(enforce_gtid_consistency="OFF")["enforce_gtid_consistency"]
    assert not loose.ok and not loose.fatal
    assert [check(binlog_expire_logs_seconds=x)["log_retention"].ok for x in ("0", "86400", "86399", None)] == [True, True, False, False]
    assert check(binlog_row_value_options=None)["binlog_row_value_options"].ok and not check(binlog_row_value_options="PARTIAL_JSON")["binlog_row_value_options"].ok
    assert [check(server_id=x)["server_id"].ok for x in ("1", "0", None, str(1 << 32))] == [True, False, False, False]


def test_preflight():
    good = {**q.SERVER, "binlog_row_image": "FULL", "binlog_expire_logs_seconds": "604800"}
    assert preflight.passed(preflight.evaluate(good, q.SERVER_GRANTS)) and not preflight.passed(preflight.evaluate(q.SERVER, q.SERVER_GRANTS))
    assert not preflight.passed(preflight.evaluate(good, ["GRANT SELECT ON *.* TO x"])) and len(preflight.evaluate({}, [])) == 14
    assert preflight.passed(preflight.evaluate(good, ["GRANT ALL PRIVILEGES ON *.* TO x"]))


def test_engine_end_to_end(spark, sf, root, tmp_path):
    events = q.change_log(spark, sf)
    base = events.where("op = 'snapshot'").select("after.*")
    base.write.parquet(f"{root}/src/shop.orders/scan")
    events.where("seq >= 2000000").write.parquet(f"{root}/src/shop.orders/log")
    text = YAML.replace("${DSN}", f"{root}/src").replace("CHECK", f"{root}/state")
    engine = Engine(spark, config.parse(text, {}), {"shop.orders": q.log_table()})
    engine.run()
    v = engine.view("orders")
    want = [r[:3] for r in expected(spark, sf)]
    assert sorted(tuple(r) for r in v.select("k", "status", F.col("amount").cast("string")).collect()) == want
    assert engine.status().head()["snapshot_done"] and engine.dead_letter_count("orders") == 0
    engine.run()  # nothing new
    assert engine.view("orders").count() == len(want)
    with pytest.raises(ValueError, match="confirm"):
        engine.resnapshot("orders")
    engine.resnapshot("orders", confirm=True)
    assert not engine.status().head()["snapshot_done"]
    # the table as it is now, but for a row that was stored wrongly and one that is put right at the source only now
    now = engine.view("orders").select("k", F.when(F.col("k") == 1, "REPAIRED").otherwise(F.col("status")).alias("status"), "amount")
    now.write.parquet(f"{root}/now")
    spark.read.parquet(f"{root}/now").write.mode("overwrite").parquet(f"{root}/src/shop.orders/scan")
    pipeline.write_batch(engine.stream("orders"), events.where("op = 'snapshot' AND after.k = 2").withColumn("after", F.expr("struct(2L AS k, 'BROKEN' AS status, after.amount AS amount)")).withColumn("seq", F.lit(5_000_000).cast("long")), 99)
    assert engine.view("orders").where("k = 2").head()["status"] == "BROKEN"
    engine.run()
    got = sorted(tuple(r) for r in engine.view("orders").select("k", "status", F.col("amount").cast("string")).collect())
    assert got == sorted((k, "REPAIRED" if k == 1 else s, a) for k, s, a in want) and engine.tail("shop.orders").count() > 0
    assert "CREATE TABLE" in engine.generate_schema("orders")[0]
    n = engine.capture("shop.orders", f"{root}/capture")
    assert n == events.where("seq >= 2000000").count() and json.loads(Files(spark).read_text(f"{root}/capture/manifest.json"))["events"] == n


def test_metrics_and_cli(tmp_path, capsys):
    m = metrics.Metrics(clock=lambda: 100.0)
    assert not m.ready()
    m._of("s").update(streaming=True, last_apply=50.0)
    assert m.ready() and 'millrace_rows{stream="s"} 0' in m.exposition()
    from urllib.error import HTTPError
    from urllib.request import urlopen

    server = metrics.serve(m, port=0)
    at = f"http://127.0.0.1:{server.server_address[1]}"
    assert b"millrace_rows" in urlopen(at + "/metrics").read() and urlopen(at + "/readyz").status == 200 and urlopen(at + "/healthz").status == 200
    m._of("s")["error"] = "broken"
    assert urlopen(at + "/healthz").status == 200  # the process lives; that it is not ready is another question
    with pytest.raises(HTTPError, match="503"):
        urlopen(at + "/readyz")
    server.shutdown()
    from millrace.cli import main

    path = tmp_path / "c.yaml"
    path.write_text(YAML.replace("${DSN}", "x"))
    assert main(["--config", str(path), "validate"]) == 0 and main(["--config", "/nowhere", "validate"]) == 2 and main(["nonsense"]) == 2
    facts = tmp_path / "facts.json"
    facts.write_text(json.dumps({"variables": q.SERVER, "grants": list(q.SERVER_GRANTS)}))
    assert main(["preflight", "--facts", str(facts)]) == 1
