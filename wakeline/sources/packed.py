"""Packed records: one flat file of equal rows of numbers, written and read in parallel.

A row's place in the file is its position times its width, so tasks write
their rows where they belong and no one puts parts together. All tasks write into one
unseen file; the commit checks that each position was written once and moves it into place. A task that
is run again writes the same bytes to the same places.

Files lie where driver and executors mount them at one path.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

#: Bytes of a (first record, number of records) pair of the index.
PAIR = 16
#: Records that a reading task holds at a time, and that make a partition.
BLOCK, PARTITION = 1 << 17, 1 << 22
KINDS = {"float": "<f4", "double": "<f8", "bigint": "<i8"}


@dataclass
class _Rows(WriterCommitMessage):
    rows: int
    end: int


class _Writer(DataSourceArrowWriter):
    def __init__(self, options: dict, schema, overwrite: bool) -> None:
        self.path = options["path"]
        kinds = {f.dataType.simpleString() for f in schema.fields[1:]}
        if len(kinds) != 1 or not kinds <= set(KINDS) or schema.fields[0].dataType.simpleString() != "bigint":
            raise ValueError("packed records need a long position and then columns of one type: float, double or long")
        if not overwrite and os.path.exists(self.path):
            raise FileExistsError(self.path)
        self.kind, self.width = KINDS[kinds.pop()], len(schema.fields) - 1
        self.temp = f"{self.path}.{uuid.uuid4().hex}.tmp"

    @property
    def size(self) -> int:
        return self.width * np.dtype(self.kind).itemsize

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Rows:
        rows, end = 0, 0
        out = os.open(self.temp, os.O_WRONLY | os.O_CREAT, 0o644)
        try:
            for batch in iterator:
                if not batch.num_rows:
                    continue
                at = batch.column(0).to_numpy(zero_copy_only=False)
                data = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns[1:]]).astype(self.kind)
                cuts = (np.flatnonzero(np.diff(at) != 1) + 1).tolist()
                for a, b in zip([0, *cuts], [*cuts, len(at)]):
                    self._put(out, data[a:b].tobytes(), int(at[a]) * self.size)
                rows, end = rows + len(at), max(end, int(at.max()) + 1)
            os.fsync(out)
        finally:
            os.close(out)
        return _Rows(rows, end)

    @staticmethod
    def _put(out: int, data: bytes, place: int) -> None:
        left = memoryview(data)
        while left:
            done = os.pwrite(out, left, place)
            left, place = left[done:], place + done

    def commit(self, messages: list) -> None:
        rows, end = sum(m.rows for m in messages if m), max((m.end for m in messages if m), default=0)
        if rows != end:
            self.abort(messages)
            raise ValueError(f"{rows} records for positions up to {end}: positions must be 0, 1, ... once each")
        with open(self.temp, "ab"):  # no task may have had rows
            pass
        os.truncate(self.temp, end * self.size)
        os.replace(self.temp, self.path)

    def abort(self, messages: list) -> None:
        if os.path.exists(self.temp):
            os.unlink(self.temp)


@dataclass
class _Run(InputPartition):
    """Segments ``first`` to ``last`` - 1."""

    first: int
    last: int


class _Reader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.path, self.index = options["path"], options["index"]
        self.names = options.get("columns", "t,lon,lat,alt").split(",")
        self.target = int(options.get("points", PARTITION))

    def _starts(self, index: int, i: int) -> int:
        return int(np.frombuffer(os.pread(index, 8, i * PAIR), "<i8")[0])

    def partitions(self) -> list[InputPartition]:
        """Runs of whole segments; their borders are searched for in the index, which is not read whole."""
        segments = os.path.getsize(self.index) // PAIR
        total = os.path.getsize(self.path) // (4 * len(self.names))
        index = os.open(self.index, os.O_RDONLY)
        try:
            borders = [0]
            for at in range(self.target, total, self.target):
                low, high = borders[-1], segments
                while low < high:
                    middle = (low + high) // 2
                    low, high = (low, middle) if self._starts(index, middle) >= at else (middle + 1, high)
                borders.append(low)
        finally:
            os.close(index)
        return [_Run(a, b) for a, b in zip(borders, [*borders[1:], segments]) if b > a]

    def read(self, partition: _Run) -> Iterator[pa.RecordBatch]:
        size = 4 * len(self.names)
        index, data = os.open(self.index, os.O_RDONLY), os.open(self.path, os.O_RDONLY)
        try:
            for first in range(partition.first, partition.last, BLOCK):
                n = min(BLOCK, partition.last - first)
                starts, counts = np.frombuffer(os.pread(index, n * PAIR, first * PAIR), "<i8").reshape(-1, 2).T
                for at in range(int(starts[0]), int(starts[-1] + counts[-1]), BLOCK):
                    places = np.arange(at, min(at + BLOCK, int(starts[-1] + counts[-1])))
                    rows = np.frombuffer(os.pread(data, len(places) * size, at * size), "<f4").reshape(-1, len(self.names))
                    if len(rows) != len(places):
                        raise EOFError(f"{self.path} ends before record {places[-1]}")
                    own = np.searchsorted(starts, places, "right") - 1
                    columns = [pa.array(first + own), pa.array(places - starts[own]), *(pa.array(rows[:, i]) for i in range(rows.shape[1]))]
                    yield pa.RecordBatch.from_arrays(columns, names=["segment", "i", *self.names])
        finally:
            os.close(index)
            os.close(data)


class PackedRecords(DataSource):
    """``format("packed_records")``: records of 4-byte floats by position.

    Written: (position, columns of one type), positions 0, 1, ... once each in any order, null numbers as NaN. Modes
    ``overwrite`` and ``append``, which fails on an existing file. Read: (segment, i, columns) with the options ``path``,
    ``index`` (a packed file of each segment's first record and their number, without gaps),
    ``columns`` and ``points`` of a partition; a segment is never cut between partitions, nor read whole at once.
    """

    @classmethod
    def name(cls) -> str:
        return "packed_records"

    def schema(self) -> str:
        return "segment long, i long, " + ", ".join(f"{c} float" for c in self.options.get("columns", "t,lon,lat,alt").split(","))

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return _Writer(self.options, schema, overwrite)
