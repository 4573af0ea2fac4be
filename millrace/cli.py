"""Command line: run, status, validate, schema, resnapshot, preflight, tail.

Exit codes: 0 done, 1 failed while running, 2 wrong usage or configuration.
"""

from __future__ import annotations

import argparse
import json
import signal
import sys
import time

from millrace.functions.text import parse_duration
from millrace.plans import preflight
from millrace.plans.config import ConfigError, parse


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="millrace")
    p.add_argument("--config", default="millrace.yaml")
    sub = p.add_subparsers(dest="command", required=True)
    run = sub.add_parser("run")
    run.add_argument("--stream", action="append")
    run.add_argument("--follow", action="store_true", help="go on until SIGTERM or SIGINT, then drain")
    sub.add_parser("status")
    sub.add_parser("validate")
    schema = sub.add_parser("schema")
    schema.add_argument("--stream", required=True)
    schema.add_argument("--shards", type=int, default=1)
    schema.add_argument("--replicas", type=int, default=1)
    again = sub.add_parser("resnapshot")
    again.add_argument("--stream", required=True)
    again.add_argument("--confirm", action="store_true")
    check = sub.add_parser("preflight")
    check.add_argument("--facts", required=True, help="JSON file with variables and grants, as the server reports them")
    tail = sub.add_parser("tail")
    tail.add_argument("--table", required=True)
    tail.add_argument("--for", dest="time", default="", help="look for new events so long, such as 30s")
    tail.add_argument("--capture", default="", help="copy the raw events to this folder instead")
    return p


def main(args: list[str] | None = None) -> int:
    try:
        a = _parser().parse_args(args)
    except SystemExit as e:
        return 0 if not e.code else 2
    if a.command == "preflight":
        with open(a.facts, encoding="utf-8") as f:
            facts = json.load(f)
        found = preflight.evaluate(facts["variables"], facts["grants"])
        for c in found:
            print(f"{'ok  ' if c.ok else 'FAIL' if c.fatal else 'warn'} {c.name}: {c.detail}")
        return 0 if preflight.passed(found) else 1
    try:
        with open(a.config, encoding="utf-8") as f:
            config = parse(f.read())
    except (OSError, ConfigError) as e:
        print(e, file=sys.stderr)
        return 2
    if a.command == "validate":
        print(f"{len(config.streams)} streams; queues and batches need at most {config.memory_bound()} bytes")
        return 0
    from pyspark.sql import SparkSession

    from millrace.engine import Engine

    engine = Engine(SparkSession.builder.appName("millrace").config("spark.sql.session.timeZone", "UTC").getOrCreate(), config)
    try:
        if a.command == "run":
            for number in (signal.SIGTERM, signal.SIGINT):
                signal.signal(number, lambda *_: engine.stop())
            engine.run(a.stream, a.follow)
        elif a.command == "status":
            engine.status().show(1000, truncate=False)
        elif a.command == "schema":
            text, notes = engine.generate_schema(a.stream, a.shards, a.replicas)
            print(text)
            for note in notes:
                print(note, file=sys.stderr)
        elif a.command == "resnapshot":
            engine.resnapshot(a.stream, a.confirm)
        elif a.capture:
            print(f"{engine.capture(a.table, a.capture)} events")
        else:
            last, until = -1, time.monotonic() + (parse_duration(a.time) if a.time else 0)
            while True:
                for row in engine.tail(a.table).where(f"seq > {last}").orderBy("seq").toLocalIterator():
                    print(row["op"], row["seq"], row["line"])
                    last = max(last, row["seq"])
                if time.monotonic() >= until:
                    break
                time.sleep(1)
    except ValueError as e:
        print(e, file=sys.stderr)
        return 2
    except Exception as e:
        print(e, file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
