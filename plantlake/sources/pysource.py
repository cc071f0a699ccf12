"""Python data source for point snapshots polled by executors (SRC-05 b).

The reference fetches ``/snapshot/points`` on the driver inside each
micro-batch.  This source plans one input partition per endpoint and
batch, so the polls run in executor tasks, many endpoints in parallel.  The
fetch function is named by an option (``module:function``) and imported on
the executor; the default does an HTTP GET with a timeout, and
:func:`file_fetch` reads a landed folder.

Snapshots have no offset of their own.  With the option ``store`` (a folder
that all executors reach) a poll is replayable: the task writes the payload
of (endpoint, tick) there, whole, before it returns a row, and a task that
is retried, or a batch that a restarted query plans again, reads that payload
instead of polling.  A fetch that fails leaves nothing in the store and fails
the batch.  Payloads pass through line by line and are kept (they are the
landing copy).  Two attempts that run at once may both poll; turn speculation
off, or let the silver stream's watermark dedup remove the second reading.
Without ``store`` a replay polls again.

Register with ``spark.dataSource.register(PointPollSource)`` and read with
``spark.readStream.format("plant_points").option("endpoints", "a,b")``.
"""

from __future__ import annotations

import hashlib
import importlib
import io
import json
import time
import uuid

from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

POINT_DDL = ("tag_name string, asset_id string, timestamp string, value double, quality string, uom string, "
             "source_system string, plant_id string, area_id string")
_FIELDS = ("tag_name", "asset_id", "timestamp", "value", "quality", "uom", "source_system", "plant_id", "area_id")


def http_fetch(endpoint: str, tick: int, timeout: float = 30.0) -> list[dict]:
    """GET ``<endpoint>/snapshot/points`` (a JSON array of points)."""
    import urllib.request
    with urllib.request.urlopen(f"{endpoint.rstrip('/')}/snapshot/points", timeout=timeout) as resp:
        return json.loads(resp.read().decode("utf-8"))


def file_fetch(endpoint: str, tick: int):
    """Points of a landed folder (path or URI): every line of its files is a JSON array of points."""
    store, root = fs.FileSystem.from_uri(endpoint)
    found = store.get_file_info(fs.FileSelector(root, recursive=True))
    for info in sorted((f for f in found if f.is_file and f.base_name[0] not in "._"), key=lambda f: f.path):
        with store.open_input_stream(info.path) as raw:
            for line in io.TextIOWrapper(raw, "utf-8", newline="\n"):
                yield from json.loads(line)


def _stored(folder: str, endpoint: str, tick: int, fetch):
    """Points of (endpoint, tick) from the store; fetched into it, whole, if they are not there."""
    store, root = fs.FileSystem.from_uri(folder)
    home = f"{root.rstrip('/')}/{hashlib.sha256(endpoint.encode()).hexdigest()[:32]}"
    name = f"{home}/{tick}.jsonl"
    if not store.get_file_info(name).is_file:
        store.create_dir(home, recursive=True)
        part = f"{name}.{uuid.uuid4().hex}.part"
        try:
            with store.open_output_stream(part) as out:
                for point in fetch(endpoint, tick) or []:
                    out.write(json.dumps(point).encode() + b"\n")
        except BaseException:
            if store.get_file_info(part).is_file:
                store.delete_file(part)
            raise
        if store.get_file_info(name).is_file:  # another attempt was first
            store.delete_file(part)
        else:
            store.move(part, name)
    with store.open_input_stream(name) as raw:
        for line in io.TextIOWrapper(raw, "utf-8", newline="\n"):
            yield json.loads(line)


def _poll(options: dict, endpoint: str, tick: int):
    fetch = lambda *what: _resolve(options["fetcher"])(*what)  # noqa: E731 - a replay does not need the fetcher
    store = options["store"]
    return _rows(_stored(store, endpoint, tick, fetch) if store else fetch(endpoint, tick))


def _resolve(path: str):
    if not path:
        return http_fetch
    mod, _, fn = path.partition(":")
    return getattr(importlib.import_module(mod), fn)


def _number(v):
    """A reading as a double; JSON has no NaN, so it comes as text; other text is NULL and fails the contract check."""
    if isinstance(v, str):
        return float(v) if v in ("NaN", "Infinity", "-Infinity") else None
    return None if v is None else float(v)


def _rows(points):
    for p in points or []:
        yield tuple(_number(p.get(f)) if f == "value" else p.get(f) for f in _FIELDS)


class _Poll(InputPartition):
    def __init__(self, endpoint: str, tick: int):
        super().__init__((endpoint, tick))
        self.endpoint, self.tick = endpoint, tick


class PointPollStreamReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.endpoints = [e for e in options.get("endpoints", "").split(",") if e]
        self.poll = {"fetcher": options.get("fetcher", ""), "store": options.get("store", "")}
        self.interval = float(options.get("interval_seconds", "5"))
        self.ticks = int(options["ticks"]) if "ticks" in options else None  # bounded source for tests
        self.start_tick = int(time.time() // self.interval) if self.ticks is None else 0

    def initialOffset(self) -> dict:
        return {"tick": self.start_tick}

    def latestOffset(self) -> dict:
        if self.ticks is not None:
            return {"tick": self.start_tick + self.ticks}
        return {"tick": int(time.time() // self.interval)}

    def partitions(self, start: dict, end: dict):
        # A snapshot only shows the present: ticks missed while offline cannot be polled later.
        return [_Poll(e, end["tick"]) for e in self.endpoints] if end["tick"] > start["tick"] else []

    def read(self, partition: _Poll):
        return _poll(self.poll, partition.endpoint, partition.tick)

    def commit(self, end: dict) -> None:
        pass


class PointPollBatchReader(DataSourceReader):
    def __init__(self, options: dict):
        self.endpoints = [e for e in options.get("endpoints", "").split(",") if e]
        self.poll = {"fetcher": options.get("fetcher", ""), "store": options.get("store", "")}

    def partitions(self):
        return [_Poll(e, 0) for e in self.endpoints]

    def read(self, partition: _Poll):
        return _poll(self.poll, partition.endpoint, partition.tick)


class PointPollSource(DataSource):
    """``format("plant_points")``: one snapshot poll per endpoint per tick."""

    @classmethod
    def name(cls) -> str:
        return "plant_points"

    def schema(self) -> str:
        return POINT_DDL

    def reader(self, schema):
        return PointPollBatchReader(self.options)

    def streamReader(self, schema):
        return PointPollStreamReader(self.options)
