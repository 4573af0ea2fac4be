"""Files that must change at once: pointers, locks and small state, through Hadoop's file systems."""

from __future__ import annotations

import json
import threading
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


class Locked(RuntimeError):
    """Another process holds the stream."""


class Files:
    def __init__(self, spark: SparkSession):
        self.spark, self.jvm = spark, spark._jvm

    def _at(self, path: str):
        at = self.jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()), at

    def exists(self, path: str) -> bool:
        fs, at = self._at(path)
        return fs.exists(at)

    def delete(self, path: str) -> None:
        fs, at = self._at(path)
        fs.delete(at, True)

    def names(self, path: str) -> list[str]:
        """What a folder holds; nothing if it is not there."""
        fs, at = self._at(path)
        return sorted(f.getPath().getName() for f in fs.listStatus(at)) if fs.exists(at) else []

    def read_text(self, path: str) -> str | None:
        fs, at = self._at(path)
        if not fs.exists(at):
            return None
        stream = fs.open(at)
        try:
            return bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        finally:
            stream.close()

    def create(self, path: str, text: str) -> bool:
        """Write a new file; False if it is there already, which the file system decides in one step."""
        fs, at = self._at(path)
        try:
            stream = fs.create(at, False)
        except Exception as e:
            if "FileAlreadyExists" in str(e):
                return False
            raise
        stream.write(bytearray(text.encode()))
        stream.close()
        return True

    def replace(self, path: str, text: str) -> None:
        """Write beside the file, then rename over it: a reader sees the old or the new text."""
        fs, at = self._at(path + ".next")
        stream = fs.create(at, True)
        stream.write(bytearray(text.encode()))
        stream.close()
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(at.toUri() if at.toUri().getScheme() else fs.getUri(), self.spark._jsc.hadoopConfiguration())
        options = self.spark.sparkContext._gateway.new_array(self.jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = self.jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        target = self.jvm.org.apache.hadoop.fs.Path(path)
        context.rename(context.makeQualified(at), context.makeQualified(target), options)


class StreamLock:
    """One owner for a stream while its process lives.

    The owner renews the lock's time stamp; a lock that has not been renewed for ``ttl`` seconds belonged to a process that
    died, and is taken over.
    """

    def __init__(self, files: Files, path: str, owner: str, ttl: float = 60.0, clock: Callable[[], float] = time.time):
        self.files, self.path, self.ttl, self.clock = files, path, ttl, clock
        self.owner, self.token, self.done = owner, uuid.uuid4().hex, threading.Event()

    def _text(self) -> str:
        return json.dumps({"owner": self.owner, "token": self.token, "at": self.clock()})

    def __enter__(self):
        if not self.files.create(self.path, self._text()):
            found = json.loads(self.files.read_text(self.path) or "{}")
            if self.clock() - found.get("at", 0) <= self.ttl:
                raise Locked(f"{self.path} is held by {found.get('owner')}")
            self.files.replace(self.path, self._text())
            if json.loads(self.files.read_text(self.path) or "{}").get("token") != self.token:
                raise Locked(f"{self.path} was taken over by another process")
        self.renewer = threading.Thread(target=self._renew, daemon=True)
        self.renewer.start()
        return self

    def _renew(self) -> None:
        while not self.done.wait(self.ttl / 4):
            self.files.replace(self.path, self._text())

    def __exit__(self, *exc):
        self.done.set()
        self.renewer.join(30)  # a renewal under way would write the file anew
        self.files.delete(self.path)


class Alias:
    """A name that points at one complete version of a table; it moves only after a complete rebuild."""

    def __init__(self, files: Files, path: str):
        self.files, self.path = files, path

    def info(self) -> dict:
        text = self.files.read_text(self.path)
        return json.loads(text) if text else {}

    def target(self) -> str | None:
        return self.info().get("target")

    def promote(self, target: str, **info) -> bool:
        """False if the alias points there already; info is kept beside the target."""
        if self.target() == target:
            return False
        if not self.files.exists(f"{target}/_SUCCESS"):
            raise RuntimeError(f"{target} is not complete")
        self.files.replace(self.path, json.dumps({"target": target, **info}))
        return True

    def read(self) -> DataFrame:
        target = self.target()
        if target is None:
            raise RuntimeError(f"{self.path} points at nothing yet")
        return self.files.spark.read.parquet(target)
