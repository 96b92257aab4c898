"""Data sources of our own: generated events as a stream, a crawl, and a log of messages that commits batches.

``register`` makes them known to a session, under the names in ``NAMES``.  The message
log is reached by pyarrow's file systems (local and network folders, object stores).
"""

from __future__ import annotations

import datetime as dt
import json
import os
import time
import uuid
from collections.abc import Callable, Iterator, Sequence
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamArrowWriter, DataSourceStreamReader, InputPartition, WriterCommitMessage

from . import CITIES, EVENT

NAMES = ("sensor_events", "messages")


def register(spark: SparkSession, *more: type[DataSource]) -> None:
    """Make the sources known, and the package to Python workers that share the driver's disk (elsewhere it goes along by --py-files or the image)."""
    env, root = spark.sparkContext.environment, str(Path(__file__).resolve().parents[2])
    there = env.get("PYTHONPATH", "")
    if root not in there.split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, there) if x)
    for source in (SensorEvents, Messages, *more):
        spark.dataSource.register(source)


# --- generated events ---------------------------------------------------------------------------------------------


class Range(InputPartition):
    def __init__(self, start: int, stop: int):
        super().__init__((start, stop))
        self.start, self.stop = start, stop


def _uniform(seed: int, i: np.ndarray, k: int) -> np.ndarray:
    """Numbers between 0 and 1 that depend on the seed, the event and k only (the finalizer of splitmix64)."""
    with np.errstate(over="ignore"):
        x = i.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64((seed * 1_000_003 + k) % (1 << 64))
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
        x ^= x >> np.uint64(31)
    return (x >> np.uint64(11)).astype(float) / float(1 << 53)


#: Level, spread and bounds of each value of a reading: fixed values.
LEVELS = {"temperature_2m": (22.0, 3.0, -80, 70), "relative_humidity_2m": (60.0, 8.0, 0, 100), "pm2_5": (20.0, 6.0, 0, 2000), "pm10": (35.0, 9.0, 0, 3000), "carbon_monoxide": (400.0, 60.0, 0, 100000), "nitrogen_dioxide": (25.0, 5.0, 0, 2000)}


def events(start: int, stop: int, seed: int, began: dt.datetime, every: float) -> dict[str, list]:
    """Events ``start`` to ``stop``, the same however they are cut into ranges: one each ``every`` seconds, city after city, sent 50 to 2500 ms later."""
    i = np.arange(start, stop)
    city = i % len(CITIES) + 1
    iso = lambda t: t.isoformat(timespec="milliseconds") + "Z"
    at = [began + dt.timedelta(seconds=every * k) for k in i.tolist()]
    late = (50 + np.floor(_uniform(seed, i, 0) * 2451)).tolist()
    out = {
        "schema_version": ["1.0"] * len(i), "event_type": ["environment.sensor_reading"] * len(i), "event_id": [str(uuid.uuid5(uuid.UUID(int=seed), str(k))) for k in i.tolist()], "source_system": ["iot_simulator"] * len(i), "dataset_name": ["sensor_readings"] * len(i),
        "device_id": [f"device-{c:02}" for c in city.tolist()], "sequence_number": (i // len(CITIES)).tolist(), "city_id": city.tolist(), "city_name": [CITIES[c][0] for c in city.tolist()], "country_code": [CITIES[c][1] for c in city.tolist()],
        "event_time_utc": [iso(t) for t in at], "produced_at_utc": [iso(t + dt.timedelta(milliseconds=m)) for t, m in zip(at, late, strict=True)],
    }
    for k, (name, (level, spread, low, high)) in enumerate(LEVELS.items()):
        normal = np.sqrt(-2 * np.log1p(-_uniform(seed, i, 2 * k + 1))) * np.cos(2 * np.pi * _uniform(seed, i, 2 * k + 2))
        out[name] = np.round(np.clip(level + city + spread * normal, low, high), 2).tolist()
    return out


class Events:
    """Events by number.  A stream's offset is a number of events, so a stream that goes on from an offset gives what it would have given.

    ``rate`` events a second are there since ``since``, at most ``total``; the offset depends on
    the clock and the options only, not on what an earlier run has seen.
    """

    def __init__(self, options: dict[str, str]):
        self.seed, self.every = int(options.get("seed", 1)), float(options.get("every", 0.5))
        self.began = dt.datetime.fromisoformat(options.get("start", "2026-01-01T00:00:00"))
        self.total = int(options["total"]) if "total" in options else None
        self.rate, self.size = float(options.get("rate", 2)), int(options.get("rows", 100_000))
        self.since = dt.datetime.fromisoformat(options["since"]).timestamp() if "since" in options else None
        if self.since is None and self.total is None:
            raise ValueError("either since or total must be given")

    def initialOffset(self) -> dict:
        return {"events": 0}

    def latestOffset(self) -> dict:
        there = self.total if self.since is None else int(max(0.0, time.time() - self.since) * self.rate)
        return {"events": there if self.total is None else min(there, self.total)}

    def _ranges(self, start: int, stop: int) -> list[Range]:
        return [Range(a, min(a + self.size, stop)) for a in range(start, stop, self.size)]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        for a in range(partition.start, partition.stop, 10_000):
            yield pa.RecordBatch.from_pydict(events(a, min(a + 10_000, partition.stop), self.seed, self.began, self.every), schema=_EVENTS)


class EventTable(Events, DataSourceReader):
    def partitions(self) -> Sequence[Range]:
        return self._ranges(0, self.latestOffset()["events"])


class EventStream(Events, DataSourceStreamReader):
    def partitions(self, start: dict, end: dict) -> Sequence[Range]:
        return self._ranges(start["events"], end["events"])


_KINDS = {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64(), "double": pa.float64()}
_EVENTS = pa.schema([(n, _KINDS[k]) for n, k in (x.split() for x in EVENT.split(", "))])


class SensorEvents(DataSource):
    @classmethod
    def name(cls) -> str:
        return "sensor_events"

    def schema(self) -> str:
        return EVENT

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return EventTable(dict(self.options))

    def streamReader(self, schema: T.StructType) -> DataSourceStreamReader:
        return EventStream(dict(self.options))


# --- a crawl ------------------------------------------------------------------------------------------------------


class City(InputPartition):
    def __init__(self, row: dict):
        super().__init__(row)
        self.row = row


def crawl_source(fetch: Callable[[dict], str], name: str = "crawl") -> type[DataSource]:
    """A source that makes a request for each city, a partition a city: option ``cities`` has them as JSON.

    ``fetch`` takes a city and gives the response's text, or raises.  A failure is tried again, ``retries`` times
    with waits that double, and concerns its city only.
    """

    class Requests(DataSourceReader):
        def __init__(self, options: dict[str, str]):
            self.cities = json.loads(options["cities"])
            self.retries, self.wait = int(options.get("retries", 4)), float(options.get("wait", 1.0))

        def partitions(self) -> Sequence[City]:
            return [City(c) for c in self.cities]

        def read(self, partition: City) -> Iterator[tuple]:
            payload = error = None
            for k in range(self.retries + 1):
                try:
                    payload, error = fetch(partition.row), None
                    break
                except Exception as e:  # whatever a request can raise is the city's own
                    error = f"{type(e).__name__}: {e}"
                    time.sleep(self.wait * (1 << k) if k < self.retries else 0)
            yield partition.row["city_id"], payload, error

    class Crawl(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return "city_id bigint, payload string, error string"

        def reader(self, schema: T.StructType) -> DataSourceReader:
            return Requests(dict(self.options))

    return Crawl


# --- a log of messages --------------------------------------------------------------------------------------------


class Written(WriterCommitMessage):
    def __init__(self, file: str | None, rows: int):
        self.file, self.rows = file, rows


class Log:
    """A topic's folder: files of messages, and for each batch a note of the files that count.

    A task writes a file of its own; only if the driver's note names it does it count.  A
    task that fails and is repeated leaves a file that no note names.  A batch has one
    note, which gets its name when it is whole: a batch that is repeated after its note is there changes nothing.
    """

    def __init__(self, path: str):
        self.uri = path

    def _at(self) -> tuple[fs.FileSystem, str]:
        system, path = fs.FileSystem.from_uri(self.uri if "://" in self.uri else f"file://{self.uri}")
        return system, path.rstrip("/")

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        system, path = self._at()
        system.create_dir(f"{path}/data", recursive=True)
        name, rows, out = f"{uuid.uuid4().hex}.parquet", 0, None
        for b in batches:
            if out is None:
                out = pq.ParquetWriter(f"{path}/data/{name}", b.schema, filesystem=system)
            out.write_batch(b)
            rows += b.num_rows
        if out is None:
            return Written(None, 0)
        out.close()
        return Written(name, rows)

    def commit(self, messages: list[Written | None], batch: str) -> None:
        system, path = self._at()
        note = f"{path}/commits/{batch}.json"
        if system.get_file_info(note).type != fs.FileType.NotFound:
            return self.abort(messages)
        system.create_dir(f"{path}/commits", recursive=True)
        draft = f"{path}/commits/.{uuid.uuid4().hex}"
        with system.open_output_stream(draft) as out:
            out.write(json.dumps({"batch": batch, "files": [m.file for m in messages if m and m.file], "rows": sum(m.rows for m in messages if m)}).encode())
        system.move(draft, note)

    def abort(self, messages: list[Written | None]) -> None:
        system, path = self._at()
        for m in messages:
            if m and m.file:
                system.delete_file(f"{path}/data/{m.file}")


class BatchWriter(DataSourceArrowWriter):
    def __init__(self, log: Log, batch: str):
        self.log, self.batch = log, batch

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        return self.log.write(iterator)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        self.log.commit(messages, self.batch)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        self.log.abort(messages)


class StreamWriter(DataSourceStreamArrowWriter):
    def __init__(self, log: Log):
        self.log = log

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        return self.log.write(iterator)

    def commit(self, messages: list[WriterCommitMessage | None], batchId: int) -> None:
        self.log.commit(messages, f"{batchId:09}")

    def abort(self, messages: list[WriterCommitMessage | None], batchId: int) -> None:
        self.log.abort(messages)


class Messages(DataSource):
    """Sink of rows with key and value; option ``path`` is the topic's folder, ``batch`` names a batch that isn't a stream's."""

    @classmethod
    def name(cls) -> str:
        return "messages"

    def writer(self, schema: T.StructType, overwrite: bool) -> BatchWriter:
        return BatchWriter(Log(self.options["path"]), self.options.get("batch") or uuid.uuid4().hex)

    def streamWriter(self, schema: T.StructType, overwrite: bool) -> StreamWriter:
        return StreamWriter(Log(self.options["path"]))


def messages(spark: SparkSession, path: str) -> DataFrame:
    """The messages of a topic's batches, with the batch: each once, whatever was repeated."""
    notes = spark.read.schema("batch string, files array<string>, rows bigint").json(f"{path}/commits")
    rows = spark.read.parquet(f"{path}/data").withColumn("file_", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1))
    return rows.join(notes.select("batch", F.explode("files").alias("file_")), "file_").drop("file_")
