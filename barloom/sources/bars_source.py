"""Published bars as a data source of its own, for batches and for streams.

A publisher writes bars by symbol into a shared folder, as often as new sessions come, and leaves a note of the sessions each
time. Reading (`spark.read.format("bars").option("path", folder)`) plans one partition for each symbol and span of days.
Filters by symbol and time are taken over by the reader: other symbols and spans get no partition, and the rest is left
out while the files are read. As a stream the offset is the last published session, so that a query that stops goes on after
the last session it has taken.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from barloom.sources import storage

SCHEMA = "symbol string, time timestamp_ntz, open double, high double, low double, close double, volume bigint"
#: Days of one partition.
SPAN = 366
TICK = timedelta(microseconds=1)


def publish(bars: DataFrame, folder: str) -> None:
    """Adds bars to the published ones. The note of their sessions comes last, so readers do not see half of them."""
    batch = uuid.uuid4().hex
    columns = ["symbol", "time", "open", "high", "low", "close", "volume"]
    out = f"{folder}/data/{batch}"
    bars.select(*columns).repartition("symbol").sortWithinPartitions("symbol", "time").write.partitionBy("symbol").parquet(out)
    spark = bars.sparkSession
    first, last = spark.read.parquet(out).agg(F.min("time"), F.max("time")).first() if storage.names(spark, f"{out}/symbol=*") else (None, None)
    if first is not None:
        storage.claim(spark, f"{folder}/notes/{batch}.json", json.dumps({"batch": batch, "first": first.isoformat(), "last": last.isoformat()}))


def _store(uri: str):
    """(pyarrow file system, path) of a folder."""
    from pyarrow import fs

    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


def _names(uri: str) -> list[str]:
    from pyarrow import fs

    store, path = _store(uri)
    return sorted(f.base_name for f in store.get_file_info(fs.FileSelector(path, allow_not_found=True)) if not f.base_name.startswith((".", "_")))


@dataclass(frozen=True)
class Note:
    batch: str
    first: datetime
    last: datetime


def notes(folder: str) -> list[Note]:
    store, path = _store(folder)
    found = []
    for name in _names(f"{folder}/notes"):
        if name.endswith(".json"):
            with store.open_input_stream(f"{path}/notes/{name}") as f:
                x = json.loads(f.read())
            found.append(Note(x["batch"], datetime.fromisoformat(x["first"]), datetime.fromisoformat(x["last"])))
    return found


@dataclass(frozen=True)
class Wanted:
    """Bars of some symbols (None: of all) with first <= time <= last."""

    symbols: frozenset[str] | None = None
    first: datetime = datetime.min
    last: datetime = datetime.max

    @classmethod
    def of(cls, options: dict[str, str]) -> Wanted:
        symbols, first, last = (options.get(k) for k in ("symbols", "first", "last"))
        return cls(frozenset(json.loads(symbols)) if symbols else None, *(datetime.fromisoformat(x) if x else end for x, end in ((first, datetime.min), (last, datetime.max))))


class Span(InputPartition):
    """A symbol's bars of one batch between two times."""

    def __init__(self, place: str, symbol: str | None, first: datetime, last: datetime):
        self.place, self.symbol, self.first, self.last = place, symbol, first, last


def plan(folder: str, wanted: Wanted, days: int) -> list[Span]:
    spans = []
    for note in notes(folder):
        first, last = max(note.first, wanted.first), min(note.last, wanted.last)
        if first > last:
            continue
        for name in _names(f"{folder}/data/{note.batch}"):
            symbol = storage.part_value(name)
            if wanted.symbols is not None and symbol not in wanted.symbols:
                continue
            at = first
            while at <= last:
                end = min(last, at + timedelta(days=days) - TICK)
                spans.append(Span(f"{folder}/data/{note.batch}/{name}", symbol, at, end))
                at = end + TICK
    return spans


def read_span(span: Span) -> Iterator:
    import pyarrow as pa
    import pyarrow.compute as pc
    import pyarrow.dataset as ds

    store, path = _store(span.place)
    kind = pa.timestamp("us")
    inside = (pc.field("time") >= pa.scalar(span.first, kind)) & (pc.field("time") <= pa.scalar(span.last, kind))
    for batch in ds.dataset(path, filesystem=store, format="parquet").to_batches(filter=inside):
        if batch.num_rows:
            columns = [batch.column(c) for c in ("time", "open", "high", "low", "close", "volume")]
            columns[0] = columns[0].cast(kind)
            yield pa.RecordBatch.from_arrays([pa.array([span.symbol] * batch.num_rows, pa.string()), *columns], ["symbol", "time", "open", "high", "low", "close", "volume"])


class BarsReader(DataSourceReader):
    def __init__(self, folder: str, days: int, wanted: Wanted):
        self.folder, self.days, self.wanted = folder, days, wanted

    def partitions(self) -> Sequence[InputPartition]:
        return plan(self.folder, self.wanted, self.days)

    def read(self, partition: InputPartition) -> Iterator:
        if isinstance(partition, Span):  # a source without spans is read once, with none
            yield from read_span(partition)


class BarsStream(DataSourceStreamReader):
    def __init__(self, folder: str, days: int):
        self.folder, self.days = folder, days

    def initialOffset(self) -> dict:
        return {"session": datetime.min.isoformat()}

    def latestOffset(self) -> dict:
        return {"session": max((n.last for n in notes(self.folder)), default=datetime.min).isoformat()}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        first, last = (datetime.fromisoformat(x["session"]) for x in (start, end))
        return plan(self.folder, Wanted(None, first + TICK, last), self.days)

    def read(self, partition: InputPartition) -> Iterator:
        if isinstance(partition, Span):
            yield from read_span(partition)

    def commit(self, end: dict) -> None:
        """The checkpoint of the query holds the offset; nothing is kept here."""


class BarsSource(DataSource):
    """Options: path, the published folder; days, the span of a partition; and what is wanted: symbols (a JSON list), first and
    last (ISO times, both included)."""

    @classmethod
    def name(cls) -> str:
        return "bars"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> BarsReader:
        return BarsReader(self.options["path"], int(self.options.get("days", SPAN)), Wanted.of(self.options))

    def streamReader(self, schema) -> BarsStream:
        return BarsStream(self.options["path"], int(self.options.get("days", SPAN)))


def published(spark: SparkSession, folder: str, symbols: list[str] | None = None, first: str | None = None, last: str | None = None, days: int = SPAN) -> DataFrame:
    """The published bars of some symbols (None: of all) from `first` to `last`, both included."""
    spark.dataSource.register(BarsSource)
    wanted = {"symbols": None if symbols is None else json.dumps(symbols), "first": first, "last": last}
    return spark.read.format("bars").options(path=folder, days=str(days), **{k: v for k, v in wanted.items() if v is not None}).load()


def stream(spark: SparkSession, folder: str) -> DataFrame:
    spark.dataSource.register(BarsSource)
    return spark.readStream.format("bars").option("path", folder).load()
