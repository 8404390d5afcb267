"""Adapters as a Structured Streaming source with admission control.

An adapter knows places in what it reads: a place says where an item begins, so a slice between two places is read from
there and never from the start. The stream's offset is a place that advances by at most `batch` items, cut into slices of
`slice` items; so one micro-batch is bounded whatever the backlog, Spark's own checkpoint is the resume point, and a
run can be stopped between any two batches.

What an adapter gives are drafts: it gets a context that stores bytes by their digest and hands out handles, and has no
way to name catalogue rows, to read bytes that weren't captured, or to publish.
"""

from __future__ import annotations

import hashlib
import importlib
import json
import re
import uuid
from collections.abc import Iterator, Mapping
from typing import Any, BinaryIO, Protocol
from urllib.parse import urlsplit

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

Place = Mapping[str, int]


class NotCaptured(PermissionError):
    """An adapter asked for bytes that its context doesn't hold."""


class Context:
    """What an adapter may do while it reads: capture bytes, make texts from them, and read both back.

    Bytes are stored below `store`, a folder that all executors see, by their digest; equal bytes are stored once. Within
    a slice one key stands for one digest.
    """

    def __init__(self, store: str | None) -> None:
        self.store, self.held = store, dict[str, dict[str, Any]]()

    def _files(self):
        from pyarrow import fs

        if self.store is None:
            raise NotCaptured("this stream has no store for captures")
        return fs.FileSystem.from_uri(self.store) if urlsplit(self.store).scheme else (fs.LocalFileSystem(), self.store)

    def _put(self, digest: str, data: bytes) -> None:
        from pyarrow import fs

        files, root = self._files()
        folder = f"{root}/sha256/{digest[:2]}"
        if files.get_file_info(f"{folder}/{digest}").type != fs.FileType.NotFound:
            return
        files.create_dir(folder, recursive=True)
        draft = f"{folder}/.{uuid.uuid4().hex}"
        with files.open_output_stream(draft) as out:
            out.write(data)
        files.move(draft, f"{folder}/{digest}")

    def capture(self, key: str, data: bytes, media_type: str) -> dict[str, Any]:
        """Stores fetched bytes; gives their handle. The same key with other bytes is an error."""
        handle = {"key": key, "sha256": hashlib.sha256(data).hexdigest(), "byte_length": len(data), "media_type": media_type}
        if self.held.setdefault(key, handle) != handle:
            raise ValueError(f"{key} was captured with other bytes")
        self._put(handle["sha256"], data)
        return handle

    def materialize(self, key: str, text: str, media_type: str = "text/plain; charset=utf-8") -> dict[str, Any]:
        """Stores a text made from captures; gives its handle."""
        return self.capture(key, text.encode(), media_type)

    def read_text(self, handle: Mapping[str, Any]) -> str:
        """The text of a handle of this context, its digest checked again."""
        if self.held.get(handle["key"]) != handle:
            raise NotCaptured(handle["key"])
        files, root = self._files()
        with files.open_input_stream(f"{root}/sha256/{handle['sha256'][:2]}/{handle['sha256']}") as stream:
            data = stream.read()
        if hashlib.sha256(data).hexdigest() != handle["sha256"]:
            raise ValueError(f"{handle['key']} has changed in the store")
        return data.decode()


class Adapter(Protocol):
    key: str
    version: str

    def first(self) -> Place:
        """The place of the first item."""

    def after(self, place: Place, n: int) -> Place:
        """The place at most n items further; the same place if there is none yet."""

    def read(self, start: Place, end: Place, context: Context) -> Iterator[Mapping[str, Any]]:
        """The items from one place to another, as drafts without ids: external_key, body (JSON)."""


class RecordFile:
    """Records of one file that only grows, told by an end mark; a place is (item, byte). A record without its end mark isn't there yet."""

    end = b"\n"
    block = 1 << 16

    def __init__(self, path: str) -> None:
        self.path = path

    def first(self) -> Place:
        return {"item": 0, "byte": 0}

    def after(self, place: Place, n: int) -> Place:
        item, at = place["item"], place["byte"]
        with open(self.path, "rb") as f:
            for record in self._records(f, at):
                if item - place["item"] == n:
                    break
                at += len(record)
                item += self.counts(record)
        return {"item": item, "byte": at} if item > place["item"] else dict(place)

    def _records(self, f: BinaryIO, at: int, stop: int | None = None) -> Iterator[bytes]:
        """Records with their end marks, from a byte on, reading no more than is asked for and a block."""
        f.seek(at)
        rest = b""
        while data := f.read(self.block if stop is None else min(self.block, stop - f.tell())):
            rest += data
            start = 0
            while (k := rest.find(self.end, start)) >= 0:
                yield rest[start : k + len(self.end)]
                start = k + len(self.end)
            rest = rest[start:]

    def counts(self, record: bytes) -> bool:
        """Whether a record holds an item."""
        return bool(record.strip())

    def records(self, start: Place, end: Place) -> Iterator[bytes]:
        with open(self.path, "rb") as f:
            yield from filter(self.counts, self._records(f, start["byte"], end["byte"]))


class JsonLinesAdapter(RecordFile):
    """Items of a JSON-lines file."""

    key, version = "json-lines", "1"

    def read(self, start: Place, end: Place, context: Context) -> Iterator[Mapping[str, Any]]:
        for line in self.records(start, end):
            yield {"external_key": json.loads(line)["externalKey"], "body": line.decode().strip()}


class VolumeAdapter(RecordFile):
    """Items of an XML volume: each item's exact bytes are captured, and its lines are passages of a normalized text."""

    key, version = "volume", "1"
    end = b"</ITEM>"
    _item = re.compile(rb"<ITEM[\s>/].*", re.DOTALL)
    #: What drafts state about rights; none of the uses is open before a review.
    rights = {"rights_source": "volume", "attribution_text": "volume", "jurisdiction": "FI", "reviewed_on": "1970-01-01", "review_state": "unreviewed", "controlled_status": "unreviewed"}

    def counts(self, record: bytes) -> bool:
        return self._item.search(record) is not None

    def read(self, start: Place, end: Place, context: Context) -> Iterator[Mapping[str, Any]]:
        import xml.etree.ElementTree as ET

        for record in self.records(start, end):
            found = self._item.search(record)
            assert found is not None
            item = ET.fromstring(found[0])
            number = (item.get("nro") or "").strip()
            if not number:
                raise ValueError(f"an item of {self.path} has no electronic id")
            texts = item.findall("TEXT/V") or item.findall("TEXT/L")
            lines = [" ".join("".join(t.itertext()).split()) for t in texts]
            raw = context.capture(f"{number}.xml", found[0], "application/xml")
            text = context.materialize(f"{number}.txt", "\n".join(lines))
            passages = [{"external_key": f"l{k}", "ordinal": k, "source_anchor": f"l{k}", "selector": {"type": "LineSelector", "start": k, "end": k}, "quoted_text": line} for k, line in enumerate(lines, 1)]
            made = {"type": "normalization", "method": "lines", "method_version": self.version, "deterministic": True, "input_capture_keys": [raw["key"]]}
            body = {
                "captures": [raw], "artifacts": [text], "source_item": {"external_key": number, "native_id": number},
                "witnesses": [{"external_key": "w", "kind": "text", "representations": [{"external_key": "lines", "artifact_key": text["key"], "kind": "normalized-text", "derivation": made, "passages": passages}]}],
                "rights": self.rights | {"evidence_capture_keys": [raw["key"]]},
            }
            yield {"external_key": number, "body": json.dumps(body, ensure_ascii=False)}


class _Slice(InputPartition):
    def __init__(self, start: Place, end: Place) -> None:
        self.start, self.end = start, end


class _Reader(DataSourceStreamReader):
    """at: the last place that was handed out. Spark asks for it once in a micro-batch, and never tells where a restarted stream
    stands, so `open_items` reads that from the checkpoint."""

    def __init__(self, adapter: Adapter, batch: int, slice_: int, store: str | None, at: Place | None) -> None:
        self.adapter, self.batch, self.slice, self.store = adapter, batch, slice_, store
        self.at = at or adapter.first()

    def initialOffset(self) -> dict:
        return dict(self.adapter.first())

    def latestOffset(self) -> dict:
        self.at = self.adapter.after(self.at, self.batch)
        return dict(self.at)

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        slices: list[InputPartition] = []
        while start["item"] < end["item"]:
            to = self.adapter.after(start, min(self.slice, end["item"] - start["item"]))
            slices.append(_Slice(start, to))
            start = dict(to)
        if end["item"] > self.at["item"]:
            self.at = end
        return slices

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        assert isinstance(partition, _Slice)
        for item in self.adapter.read(partition.start, partition.end, Context(self.store)):
            yield item["external_key"], item["body"]


class AdapterSource(DataSource):
    """Options: adapter (module:Class), argument, batch (items in a micro-batch), slice (items in a task), store (folder for
    captures), at (the place that a restarted stream has planned; open_items fills it in)."""

    @classmethod
    def name(cls) -> str:
        return "corvane_items"

    def schema(self) -> str:
        return "external_key string, body string"

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        module, _, name = self.options["adapter"].partition(":")
        adapter = getattr(importlib.import_module(module), name)(self.options["argument"])
        batch = int(self.options.get("batch", "100"))
        return _Reader(adapter, batch, int(self.options.get("slice", str(batch))), self.options.get("store"), json.loads(self.options.get("at", "null")))


def planned_place(spark: SparkSession, checkpoint: str) -> Place | None:
    """The place up to which a stream with this checkpoint has planned its batches; None for a new one."""
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/offsets")
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in files.listStatus(folder)] if files.exists(folder) else []
    last = max((int(n) for n in names if n.isdigit()), default=None)
    if last is None:
        return None
    stream = files.open(jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/offsets/{last}"))
    try:
        return json.loads(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").splitlines()[-1])
    finally:
        stream.close()


def open_items(spark: SparkSession, checkpoint: str, adapter: str, argument: str, batch: int = 100, slice_: int | None = None, store: str | None = None) -> DataFrame:
    """The stream (external_key, body) of an adapter (module:Class), for a query with this checkpoint."""
    register(spark)
    options = {"adapter": adapter, "argument": argument, "batch": str(batch), "slice": str(slice_ or batch), "at": json.dumps(planned_place(spark, checkpoint))}
    return spark.readStream.format(AdapterSource.name()).options(**options, **({"store": store} if store else {})).load()


def register(spark: SparkSession) -> None:
    spark.dataSource.register(AdapterSource)
