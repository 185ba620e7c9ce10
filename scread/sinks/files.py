"""Sinks that a text writer can't be: pairs of files from one pass, and one file from many tasks.

Tasks write files of their own and report them in commit messages; only what committed tasks wrote is moved
or joined into place, so a task that is lost or runs twice leaves nothing behind. Compressed output is
block-compressed gzip: members of at most 64 kB that any gzip reader reads in a row and ours from the middle.
"""

from __future__ import annotations

import shutil
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from ..sources.storage import locate, size

MEMBER = 65_280
COPY = 16 * 2**20
#: A block-compressed member's header up to its size, and the empty member that ends a file.
MEMBER_HEAD = bytes([31, 139, 8, 4, 0, 0, 0, 0, 0, 255, 6, 0, 66, 67, 2, 0])
LAST_MEMBER = MEMBER_HEAD + bytes([27, 0, 3, 0, 0, 0, 0, 0, 0, 0, 0, 0])


def member(data: bytes, level: int = 6) -> bytes:
    """A gzip member of at most ``MEMBER`` bytes with its size in the header."""
    squeeze = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = squeeze.compress(data) + squeeze.flush()
    if len(body) > 2**16 - 27:  # noise does not fit: stored as it is
        squeeze = zlib.compressobj(0, zlib.DEFLATED, -15)
        body = squeeze.compress(data) + squeeze.flush()
    return MEMBER_HEAD + struct.pack("<H", len(body) + 25) + body + struct.pack("<II", zlib.crc32(data), len(data))


class _Out:
    """A new file, block-compressed if ``gz``; ``close`` ends it."""

    def __init__(self, path: str, gz: bool, last: bool = True):
        system, inner = locate(path)
        system.create_dir(inner.rsplit("/", 1)[0], recursive=True)
        self.file, self.gz, self.last, self.held = system.open_output_stream(inner), gz, last, bytearray()

    def write(self, data: bytes) -> None:
        if not self.gz:
            self.file.write(data)
            return
        self.held += data
        at = 0
        while len(self.held) - at >= MEMBER:
            self.file.write(member(bytes(self.held[at : at + MEMBER])))
            at += MEMBER
        del self.held[:at]

    def close(self) -> None:
        if self.gz:
            if self.held:
                self.file.write(member(bytes(self.held)))
            if self.last:
                self.file.write(LAST_MEMBER)
        self.file.close()


def _lines(column: pa.Array) -> bytes:
    """Values in a row, a line break after each."""
    return b"".join(x + b"\n" for x in column.cast(pa.binary()).to_pylist())


@dataclass
class _Written(WriterCommitMessage):
    task: int
    rows: int
    files: list[tuple[str, str]]  # where written, where it belongs


class _PairsWriter(DataSourceArrowWriter):
    """Rows folder, r1, r2 (records), in the order of the partitions neighbours by folder: a pair of files a folder, ``folder`` with mate=R1 and mate=R2 inside.

    A task writes its part of each file; the commit moves it, or joins the parts of several tasks in the order of the partitions.
    """

    def __init__(self, path: str):
        self.path = path.rstrip("/")
        self.kept = f"{self.path}/_writing-{uuid.uuid4().hex}"

    def write(self, batches: Iterator[pa.RecordBatch]) -> _Written:
        task = TaskContext.get()
        own = f"{self.kept}/{task.partitionId()}-{uuid.uuid4().hex}"
        files, open_now, at, rows = [], [], None, 0
        for batch in batches:
            folders, start = batch.column("folder").to_pylist(), 0
            while start < len(folders):
                stop = start + 1
                while stop < len(folders) and folders[stop] == folders[start]:
                    stop += 1
                if folders[start] != at:
                    at = folders[start]
                    for f in open_now:
                        f.close()
                    mates = [(f"{own}/{len(files) + i}", f"{self.path}/{at.replace('{mate}', m)}") for i, m in enumerate(("R1", "R2"))]
                    files += mates
                    open_now = [_Out(kept, True) for kept, _ in mates]
                for f, mate in zip(open_now, ("r1", "r2")):
                    f.write(_lines(batch.column(mate).slice(start, stop - start)))
                rows += stop - start
                start = stop
        for f in open_now:
            f.close()
        return _Written(task.partitionId(), rows, files)

    def commit(self, messages: list[_Written | None]) -> None:
        system, _ = locate(self.path)
        parts: dict[str, list[tuple[int, int, str]]] = {}
        for m in messages:
            for i, (kept, folder) in enumerate(m.files if m else ()):
                parts.setdefault(folder, []).append((m.task, i, kept))
        for folder, kept in parts.items():
            whole = f"{folder}/reads-{min(kept)[0]:05d}-{uuid.uuid4().hex[:8]}.fastq.gz"
            one = kept[0][2] if len(kept) == 1 else self._joined([k for _, _, k in sorted(kept)])
            inner = locate(whole)[1]
            system.create_dir(inner.rsplit("/", 1)[0], recursive=True)
            system.move(locate(one)[1], inner)
        self.abort(messages)

    def _joined(self, parts: list[str]) -> str:
        """A file of the members of block-compressed ones, ``COPY`` bytes at a time; only the last keeps the member that ends it."""
        out = f"{self.kept}/joined-{uuid.uuid4().hex}"
        with locate(out)[0].open_output_stream(locate(out)[1]) as whole:
            for part in parts:
                left = size(part) - len(LAST_MEMBER)
                with locate(part)[0].open_input_stream(locate(part)[1]) as f:
                    while left:
                        data = f.read(min(COPY, left))
                        whole.write(data)
                        left -= len(data)
            whole.write(LAST_MEMBER)
        return out

    def abort(self, messages: list[_Written | None]) -> None:
        system, inner = locate(self.kept)
        system.delete_dir_contents(inner, missing_dir_ok=True)
        if system.get_file_info(inner).type.name == "Directory":
            system.delete_dir(inner)


class FastqPairs(DataSource):
    """Pairs of block-compressed FASTQ files from rows folder, r1, r2."""

    @classmethod
    def name(cls) -> str:
        return "fastq_pair_files"

    def schema(self) -> str:
        return "folder string, r1 string, r2 string"

    def writer(self, schema: StructType, overwrite: bool) -> _PairsWriter:
        return _PairsWriter(self.options["path"])


class _FileWriter(DataSourceArrowWriter):
    """Rows ``value``: tasks write parts, the commit joins their bytes in the order of the partitions behind a header."""

    def __init__(self, path: str, header: str):
        self.path, self.header, self.gz = path, header, path.endswith(".gz")
        folder, _, name = path.rpartition("/")
        self.kept = f"{folder}/_writing-{name}-{uuid.uuid4().hex}"

    def write(self, batches: Iterator[pa.RecordBatch]) -> _Written:
        task = TaskContext.get()
        own, rows = f"{self.kept}/{task.partitionId()}-{uuid.uuid4().hex}", 0
        out = _Out(own, self.gz, last=False)
        for batch in batches:
            out.write(_lines(batch.column("value")))
            rows += len(batch)
        out.close()
        return _Written(task.partitionId(), rows, [(own, self.path)])

    def commit(self, messages: list[_Written | None]) -> None:
        system, inner = locate(self.path)
        done = sorted((m for m in messages if m), key=lambda m: m.task)
        header = self.header.replace("{rows}", str(sum(m.rows for m in done))).encode()
        joined = f"{self.kept}/joined"
        system.create_dir(locate(self.kept)[1], recursive=True)
        with system.open_output_stream(locate(joined)[1]) as whole:
            for at in range(0, len(header), MEMBER):
                part = header[at : at + MEMBER]
                whole.write(member(part) if self.gz else part)
            for m in done:
                with system.open_input_stream(locate(m.files[0][0])[1]) as part:
                    shutil.copyfileobj(part, whole, COPY)
            if self.gz:
                whole.write(LAST_MEMBER)
        info = system.get_file_info(inner)
        if info.type.name == "Directory":
            system.delete_dir(inner)
        elif info.type.name == "File":
            system.delete_file(inner)
        system.move(locate(joined)[1], inner)
        self.abort(messages)

    abort = _PairsWriter.abort


class OneFile(DataSource):
    """A single text file, block-compressed if its name ends in .gz; option ``header`` may name the number of rows as {rows}."""

    @classmethod
    def name(cls) -> str:
        return "one_text_file"

    def schema(self) -> str:
        return "value string"

    def writer(self, schema: StructType, overwrite: bool) -> _FileWriter:
        return _FileWriter(self.options["path"], self.options.get("header", ""))


def write_one_file(lines: DataFrame, path: str, header: str = "") -> None:
    """Lines (``value``) of all partitions in their order as one file, replaced if it is there.

    Tasks make and compress the bytes; the commit copies them as they are, 16 MB at a time.
    """
    lines.sparkSession.dataSource.register(OneFile)
    lines.select("value").write.format("one_text_file").mode("append").option("header", header).option("path", path).save()
