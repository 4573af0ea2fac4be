"""The engine end to end: destinations, kills, repairs, following, definitions."""

import json
import threading
import time
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest
from pyspark.sql import functions as F

from millrace import queries as q
from millrace.engine import Engine
from millrace.functions.kinds import Column
from millrace.plans import config
from millrace.plans.mapping import Table
from millrace.sources import changelog, snapshot
from millrace.streaming import pipeline
from millrace.streaming.storage import Files


@pytest.fixture
def root(spark):
    return q.workspace(spark)


def configured(root, sink="{type: table, target: /t}", more="", metrics=""):
    text = f"source: {{dsn: '{root}/src'}}\ncheckpoint: '{root}/state'\nruntime: {{metrics: '{metrics}'}}\nstreams:\n  orders: {{table: shop.orders, sink: {sink}{more}}}\n"
    return config.parse(text, {})


def source(spark, sf, root):
    events = q.change_log(spark, sf)
    events.where("op = 'snapshot'").select("after.*").write.parquet(f"{root}/src/shop.orders/scan")
    changelog.write_segments(events.where("seq >= 2000000"), f"{root}/src/shop.orders/log", 3)
    return sorted(tuple(r)[:3] for r in q.QUERIES["final_view"](spark, sf).collect())


def shown(engine):
    return sorted(tuple(r) for r in engine.view("orders").select("k", "status", F.col("amount").cast("string")).collect())


class Destination:
    """An index and a column store over HTTP, kept in memory."""

    def __init__(self, refuse=()):
        self.docs, self.rows, self.calls, self.refuse, self.lock = {}, [], [], set(refuse), threading.Lock()
        self.mapping = {"k": {"type": "long"}, "status": {"type": "keyword"}, "amount": {"type": "keyword"}}
        self.settings = {"refresh_interval": "5s"}
        outer = self

        class Handler(BaseHTTPRequestHandler):
            def do(self):
                import gzip

                body = self.rfile.read(int(self.headers.get("Content-Length") or 0))
                body = gzip.decompress(body) if self.headers.get("Content-Encoding") == "gzip" else body
                with outer.lock:
                    outer.calls.append((self.command, self.path))
                    status, answer = outer.answer(self.command, self.path, body.decode())
                raw = json.dumps(answer).encode()
                self.send_response(status)
                self.send_header("Content-Length", str(len(raw)))
                self.end_headers()
                self.wfile.write(raw)

            do_GET = do_POST = do_PUT = do

            def log_message(self, *args):
                pass

        self.server = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
        threading.Thread(target=self.server.serve_forever, daemon=True).start()
        self.address = f"127.0.0.1:{self.server.server_address[1]}"

    def answer(self, method, path, body):
        if path.endswith("/_mapping"):
            return 200, {"orders": {"mappings": {"properties": self.mapping}}}
        if path.endswith("/_settings"):
            if method == "PUT":
                self.settings = json.loads(body)["index"]
            return 200, {"orders": {"settings": {"index": self.settings}}}
        if path == "/_bulk":
            return 200, {"items": list(self.bulk(body.splitlines()))}
        if "INSERT" in path:
            rows = [json.loads(line) for line in body.splitlines()]
            if any(str(r["k"]) in self.refuse for r in rows):
                return 400, "bad row"
            self.rows += rows
            return 200, {}
        return 200, {}

    def bulk(self, lines):
        lines = iter(lines)
        for line in lines:
            (action, meta), = json.loads(line).items()
            body = next(lines) if action == "index" else None
            key, version = meta["_id"], meta["version"]
            if key in self.refuse:
                yield {action: {"status": 400, "error": "bad field"}}
            elif version <= self.docs.get(key, (-1, None))[0]:
                yield {action: {"status": 409}}
            else:
                self.docs[key] = (version, body)
                yield {action: {"status": 201}}


def test_index_sink_end_to_end(spark, sf, root):
    want, server = source(spark, sf, root), Destination(refuse=["2"])
    engine = Engine(spark, configured(root, f"{{type: index, target: orders, addresses: ['{server.address}']}}"))
    engine.tables["shop.orders"] = q.log_table()
    engine.run()
    got = sorted((d["k"], d["status"], d["amount"]) for d in (json.loads(b) for _, b in server.docs.values() if b))
    assert got == [w for w in want if w[0] != 2]
    paths = [p for _, p in server.calls]
    assert ("GET", "/orders/_mapping") in server.calls and "/orders/_refresh" in paths and any("_forcemerge" in p for p in paths) and server.settings == {"refresh_interval": "5s"}
    letters = engine.dead_letters("orders").collect()
    assert letters and {(r["key"], r["status"]) for r in letters} == {("2", 400)} and engine.dead_letter_count("orders") == len(letters)
    assert [(r["alert"], r["severity"]) for r in engine.alerts().collect()] == [("dead_letters", "critical")]
    before = dict(server.docs)
    pipeline.write_batch(engine.stream("orders"), q.change_log(spark, sf).where("seq >= 2000000"), 500)  # a replay is stale everywhere
    assert server.docs == before
    with pytest.raises(ValueError, match="ask that"):
        engine.view("orders")
    server.mapping["amount"] = {"type": "double"}
    with pytest.raises(ValueError, match="amount is double"):
        engine.run()
    assert engine.unhealthy().count() == 1


def test_store_sink_end_to_end(spark, sf, root):
    want, server = source(spark, sf, root), Destination(refuse=["3"])
    engine = Engine(spark, configured(root, f"{{type: store, target: orders, database: shop, addresses: ['{server.address}']}}", ", batch: {rows: 100}"), {"shop.orders": q.log_table()})
    engine.run()
    final = {}
    for r in sorted(server.rows, key=lambda r: r["_version"]):
        final[r["k"]] = r
    got = sorted((r["k"], r["status"], f"{r['amount']:.2f}") for r in final.values() if not r["_is_deleted"])
    assert got == [w for w in want if w[0] != 3] and {r["key"] for r in engine.dead_letters("orders").collect()} == {"3"}
    assert any("shop.orders" in p for _, p in server.calls)


def test_unreachable_sink_fails_the_run(spark, sf, root):
    source(spark, sf, root)

    def down(*call):
        raise OSError("connection refused")

    engine = Engine(spark, configured(root, "{type: store, target: orders, addresses: [nowhere], workers: 1}"), {"shop.orders": q.log_table()}, transport=down)
    with pytest.raises(Exception, match="still refused with 503 after 5 attempts"):
        engine.run()
    assert engine.status().head()["last_error"] and not engine.status().head()["healthy"]


def test_killed_scan_goes_on_where_it_was(spark, sf, root):
    want = source(spark, sf, root)
    settings = configured(root, more=", snapshot: {chunk_rows: 300, rows_per_second: 1}")
    slept = []

    def killed(seconds):
        slept.append(seconds)
        raise KeyboardInterrupt

    with pytest.raises(KeyboardInterrupt):
        Engine(spark, settings, {"shop.orders": q.log_table()}, sleep=killed).run()
    engine = Engine(spark, settings, {"shop.orders": q.log_table()}, sleep=slept.append)
    half = engine.status().head()
    assert 200 < half["rows_done"] < 400 and not half["snapshot_done"] and 0 < half["progress"] < 1 and slept[0] > 100
    first = Files(spark).names(f"{root}/state/orders/table")
    engine.run()
    done = engine.status().head()
    assert done["rows_done"] == done["rows_total"] and done["snapshot_done"] and shown(engine) == want
    assert first[0] in Files(spark).names(f"{root}/state/orders/table") and len(slept) >= 3


def test_pace_of_a_scan_counts_all_its_time(spark, sf, root, monkeypatch):
    """Finding a range takes part of the time that its rows are held to."""
    source(spark, sf, root)
    ranges, slept = snapshot.ranges, []

    def slow(*args):
        for part in ranges(*args):
            time.sleep(1)
            yield part

    monkeypatch.setattr(snapshot, "ranges", slow)
    monkeypatch.setattr(pipeline, "backfill", lambda *args: {"total": 300, "applied": 300, "rejected": 0, "version": 1})
    engine = Engine(spark, configured(root, more=", snapshot: {chunk_rows: 300, rows_per_second: 100}"), {"shop.orders": q.log_table()}, sleep=slept.append)
    engine.run()
    assert len(slept) >= 3 and max(slept) < 2.1


def test_ranges_cover_a_table_once(spark):
    rows = spark.createDataFrame([(i % 7, f"k{i:04d}") for i in range(1000)], "a int, b string")
    seen, marks = [], []
    for part, cursor in snapshot.ranges(rows, ["a", "b"], 150):
        seen.append([tuple(r) for r in part.collect()])
        marks.append(cursor)
    assert sorted(x for part in seen for x in part) == sorted(tuple(r) for r in rows.collect()) and len(seen) >= 6 and marks[-1] is None
    assert all(max(a) < min(b) for a, b in zip(seen, seen[1:]))
    rest = [tuple(r) for part, _ in snapshot.ranges(rows, ["a", "b"], 150, marks[1]) for r in part.collect()]
    assert sorted(rest) == sorted(x for part in seen[2:] for x in part)
    assert sum(part.count() for part, _ in snapshot.ranges(rows, ["a", "b"], 1, most=5)) == 1000
    assert [c for _, c in snapshot.ranges(rows.limit(0), ["a", "b"], 5)] == [None]


def test_rebuilt_view_takes_in_what_comes_later(spark, sf, root):
    want = source(spark, sf, root)
    engine = Engine(spark, configured(root), {"shop.orders": q.log_table()})
    engine.run()
    engine.rebuild("orders", 1)
    assert shown(engine) == want
    late = q.change_log(spark, sf).where("op = 'snapshot' AND after.k = 1").withColumn("seq", F.lit(9_000_000).cast("long")).withColumn("after", F.expr("struct(after.k AS k, 'LATE' AS status, after.amount AS amount)"))
    late.write.mode("append").parquet(f"{root}/src/shop.orders/log")
    engine.run()
    assert shown(engine) == sorted((k, "LATE" if k == 1 else s, a) for k, s, a in want)
    with pytest.raises(ValueError, match="generation 1"):
        engine.rebuild("orders", 1)
    engine.rebuild("orders", 2)
    assert len(shown(engine)) == len(want)
    plan = pipeline.current(spark, engine.stream("orders"))._jdf.queryExecution().toString()
    assert "PartitionFilters" in plan


def test_following_until_stopped(spark, sf, root):
    """New files are applied while it runs; status has the lag; stop() drains."""
    want = source(spark, sf, root)
    now = int(time.time() * 1000)
    events = q.change_log(spark, sf)
    events.where("seq >= 2000000").withColumn("ts_ms", F.lit(now - 5000).cast("long")).write.mode("overwrite").parquet(f"{root}/src/shop.orders/log")
    engine = Engine(spark, configured(root, more=", batch: {interval: 200ms}", metrics="127.0.0.1:0"), {"shop.orders": q.log_table()})
    failures = []

    def go():
        try:
            engine.run(follow=True)
        except Exception as e:
            failures.append(e)

    thread = threading.Thread(target=go)
    thread.start()

    def wait_for(check):
        until = time.time() + 90
        while time.time() < until and thread.is_alive():
            if check():
                return
            time.sleep(0.5)
        raise AssertionError(f"never came: {failures}")

    wait_for(lambda: Files(spark).names(f"{root}/state/orders/metrics"))
    added = events.where("op = 'snapshot' AND after.k = 1").withColumn("seq", F.lit(9_000_000).cast("long")).withColumn("ts_ms", F.lit(now).cast("long"))
    added.withColumn("after", F.expr("struct(after.k AS k, 'NEW' AS status, after.amount AS amount)")).write.mode("append").parquet(f"{root}/src/shop.orders/log")
    wait_for(lambda: engine.status().head()["position"] == "9000000")
    from urllib.request import urlopen

    assert urlopen(f"http://{engine.address}/readyz").status == 200 and b"millrace_lag_seconds" in urlopen(f"http://{engine.address}/metrics").read()
    assert "orders" in json.loads(urlopen(f"http://{engine.address}/streams").read())
    engine.stop()
    thread.join(60)
    assert not thread.is_alive() and not failures
    row = engine.status().head()
    assert row["last_event_ms"] == now and 0 <= row["lag_seconds"] < 300 and row["healthy"] and row["age_seconds"] >= 0
    assert shown(engine) == sorted((k, "NEW" if k == 1 else s, a) for k, s, a in want)
    assert engine.metrics.streams["orders"]["applied"] > 0 and "millrace_lag_seconds" in engine.metrics.exposition()


def test_command_line(spark, sf, root, tmp_path, capsys):
    want = source(spark, sf, root)
    path = tmp_path / "c.yaml"
    path.write_text(f"source: {{dsn: '{root}/src'}}\ncheckpoint: '{root}/state'\nruntime: {{metrics: ''}}\nstreams:\n  orders: {{table: shop.orders, sink: {{type: table, target: /t}}, snapshot: {{rows_per_second: 0}}}}\n")
    import signal

    from millrace.cli import main

    held = {n: signal.getsignal(n) for n in (signal.SIGTERM, signal.SIGINT)}
    try:
        assert main(["--config", str(path), "run", "--stream", "orders"]) == 0
    finally:
        for n, handler in held.items():
            signal.signal(n, handler)
    assert main(["--config", str(path), "status"]) == 0 and main(["--config", str(path), "tail", "--table", "shop.orders"]) == 0
    printed = capsys.readouterr().out
    assert "|true" in printed and "status: " in printed
    assert main(["--config", str(path), "tail", "--table", "shop.orders", "--capture", f"{root}/copy"]) == 0 and " events" in capsys.readouterr().out
    assert main(["--config", str(path), "resnapshot", "--stream", "orders"]) == 2 and main(["--config", str(path), "resnapshot", "--stream", "orders", "--confirm"]) == 0
    assert main(["--config", str(path), "run", "--stream", "nobody"]) == 2
    assert len(shown(Engine(spark, configured(root)))) == len(want)


def test_first_failure_of_any_stream_ends_all(spark, sf, root):
    events = q.change_log(spark, sf)
    changelog.write_segments(events, f"{root}/log", 2)
    image = events.schema["before"].dataType
    good = pipeline.Stream("good", q.compile_plan(q.log_table(), q.Mapping(), dialect="store"), root)
    bad = pipeline.Stream("bad", good.plan, root)

    def boom(counts):
        raise RuntimeError("cannot go on")

    started = [pipeline.run(good, changelog.stream_log(spark, f"{root}/log", image), available_now=False), pipeline.run(bad, changelog.stream_log(spark, f"{root}/log", image), on_batch=boom)]
    with pytest.raises(Exception, match="cannot go on"):
        pipeline.run_all(spark, started)
    assert not any(s.isActive for s in started)


def test_purged_log_and_new_definitions(spark, sf, root):
    source(spark, sf, root)
    files, log = Files(spark), f"{root}/src/shop.orders/log"
    engine = Engine(spark, configured(root))
    engine.run()
    assert engine.plan("orders").table.find("note") is None
    scan = spark.read.parquet(f"{root}/src/shop.orders/scan").withColumn("note", F.lit("x"))
    scan.write.parquet(f"{root}/wider")
    spark.read.parquet(f"{root}/wider").write.mode("overwrite").parquet(f"{root}/src/shop.orders/scan")
    files.replace(f"{log}.ddl.json", json.dumps({"seq": 3_000_000, "schema": "shop", "statement": "ALTER TABLE orders ADD note varchar(9)"}) + "\n")
    image = "struct<k:bigint,status:string,amount:decimal(18,2),note:string>"
    spark.createDataFrame([("insert", None, (77_000_000, "N", None, "hello"), 8_000_000)], f"op string, before {image}, after {image}, seq long").write.mode("append").parquet(log)
    engine.run()
    assert engine.plan("orders").table.find("note") is not None
    row = engine.view("orders").where("k = 77000000").head()
    assert row["note"] == "hello" and engine.view("orders").where("k = 2").head()["note"] is None
    changelog.purge(files, log, 9_000_000)
    with pytest.raises(changelog.PositionPurged, match="scan the table again"):
        engine.run()
    assert "scan the table again" in engine.status().head()["last_error"]


def test_scanned_labels_and_missing_keys(spark, root):
    table = Table("shop", "orders", (Column("k", "bigint"), Column("state", "enum", nullable=True, members=("draft", "paid")), Column("tags", "set", nullable=True, members=("x", "y")), Column("added", "int", nullable=True)), ("k",))
    spark.createDataFrame([(1, "paid", "x,y", 9), (2, None, "", 9)], "k long, state string, tags string, gone int").write.parquet(f"{root}/src/shop.orders/scan")
    image = "struct<k:bigint,state:int,tags:bigint,added:int>"
    spark.createDataFrame([("update", (1, 2, 3, None), (1, 1, 2, 5), 100)], f"op string, before {image}, after {image}, seq long").write.parquet(f"{root}/src/shop.orders/log")
    engine = Engine(spark, configured(root), {"shop.orders": table})
    engine.run()
    assert sorted((r["k"], r["state"], tuple(r["tags"] or ()), r["added"]) for r in engine.view("orders").collect()) == [(1, "draft", ("y",), 5), (2, None, (), None)]
    assert engine.tail("shop.orders").head()["line"] == "state: paid -> draft, tags: {x,y} -> {y}, added: NULL -> 5"
    spark.createDataFrame([("a",)], "state string").write.mode("overwrite").parquet(f"{root}/src/shop.orders/scan")
    engine.resnapshot("orders", confirm=True)
    with pytest.raises(ValueError, match="lacks key columns: k"):
        engine.run()
