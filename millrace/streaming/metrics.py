"""What a running query reports: counters from its progress, kept by a listener and served as text or JSON."""

from __future__ import annotations

import json
import threading
import time
from collections.abc import Callable
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

from pyspark.sql.streaming import StreamingQueryListener

READY_WITHIN_S = 300


class Metrics(StreamingQueryListener):
    def __init__(self, clock: Callable[[], float] = time.time):
        self.clock, self.streams, self.names = clock, {}, {}

    def _of(self, name: str) -> dict:
        return self.streams.setdefault(name, {"rows": 0, "batches": 0, "rows_per_second": 0.0, "backlog_files": 0, "last_apply": None, "streaming": False, "error": ""})

    def onQueryStarted(self, event):
        self.names[str(event.id)] = event.name or str(event.id)
        self._of(event.name or str(event.id))["streaming"] = True

    def onQueryProgress(self, event):
        p = event.progress
        s = self._of(p.name or str(p.id))
        s["rows"] += p.numInputRows
        s["batches"] += 1
        s["rows_per_second"] = p.processedRowsPerSecond or 0.0
        s["backlog_files"] = max((int(x.metrics.get("numFilesOutstanding", 0) or 0) for x in p.sources), default=0)
        s["last_apply"] = self.clock()

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        name = self.names.get(str(event.id), str(event.id))
        if event.exception:
            self._of(name)["error"] = event.exception[:1000]
        self._of(name)["streaming"] = False

    def counted(self, name: str, counts: dict) -> None:
        """What a batch came to, as its writer tells."""
        s = self._of(name)
        for k in ("applied", "stale", "rejected"):
            s[k] = s.get(k, 0) + counts.get(k, 0)
        if counts.get("event_ms") is not None:
            s["last_event_ms"] = max(s.get("last_event_ms") or 0, counts["event_ms"])

    def ready(self) -> bool:
        """All streaming, none in error, all applied something lately."""
        now = self.clock()
        return bool(self.streams) and all(s["streaming"] and not s["error"] and s["last_apply"] is not None and now - s["last_apply"] <= READY_WITHIN_S for s in self.streams.values())

    def exposition(self) -> str:
        """Metrics in the text format of scrapers."""
        out = []
        for name, s in sorted(self.streams.items()):
            for k in ("rows", "batches", "rows_per_second", "backlog_files", "applied", "stale", "rejected"):
                out.append(f'millrace_{k}{{stream="{name}"}} {s.get(k, 0)}')
            if s.get("last_event_ms"):
                out.append(f'millrace_lag_seconds{{stream="{name}"}} {max(0.0, self.clock() - s["last_event_ms"] / 1000)}')
        return "\n".join(out) + "\n"

    def snapshot(self) -> str:
        return json.dumps(self.streams, sort_keys=True)

    def healthy(self) -> bool:
        return not any(s["error"] for s in self.streams.values())


def serve(metrics: Metrics, host: str = "127.0.0.1", port: int = 9187) -> ThreadingHTTPServer:
    """``/metrics`` as text, ``/healthz`` as long as the process answers, ``/readyz`` as 200 or 503, ``/streams`` as JSON; stop with
    shutdown()."""

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self):
            answers = {
                "/metrics": lambda: (200, metrics.exposition()), "/streams": lambda: (200, metrics.snapshot()),
                "/healthz": lambda: (200, "ok"), "/readyz": lambda: (200, "ready") if metrics.ready() else (503, "not ready"),
            }
            code, text = answers.get(self.path, lambda: (404, "not found"))()
            body = text.encode()
            self.send_response(code)
            self.send_header("Content-Length", str(len(body)))
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *args):
            pass

    server = ThreadingHTTPServer((host, port), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    return server
