"""One JSON file for each key, streamed from bounded parts and moved into place when all are whole."""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

#: A key that may be a file's name. Fixed value.
SAFE_KEY = re.compile(r"^[A-Za-z0-9_-]+$")


@dataclass
class _Folder(WriterCommitMessage):
    folder: str


class _Writer(DataSourceWriter):
    def __init__(self, options: dict, overwrite: bool) -> None:
        self.root, self.field, self.overwrite = options["path"], options.get("list", "items"), overwrite
        self.staging = os.path.join(self.root, f".staging-{uuid.uuid4().hex}")

    def write(self, iterator: Iterator) -> _Folder:
        """Rows (key, part, head, items) in order of key and part; items are JSON arrays, joined as they come."""
        folder = os.path.join(self.staging, uuid.uuid4().hex)  # of this attempt alone
        os.makedirs(folder)
        key, out, some = None, None, False
        try:
            for row in iterator:
                if row[0] is None or not SAFE_KEY.fullmatch(row[0]):
                    continue
                if row[0] != key:
                    self._end(out)
                    key, some = row[0], False
                    out = open(os.path.join(folder, f"{key}.json"), "x", encoding="utf-8")  # noqa: SIM115
                    head = row[2].strip()[:-1]
                    out.write(f'{head}{"," if head != "{" else ""}"{self.field}":[')
                items = (row[3] or "[]").strip()[1:-1]
                if items:
                    out.write(("," if some else "") + items)
                    some = True
            self._end(out)
        except BaseException:
            if out and not out.closed:
                out.close()
            raise
        return _Folder(folder)

    @staticmethod
    def _end(out) -> None:
        if out:
            out.write("]}")
            out.close()

    def commit(self, messages: list) -> None:
        """Files of the attempts that count move into the root; with ``overwrite`` other documents of the root go."""
        new = {name: m.folder for m in messages if m for name in os.listdir(m.folder)}
        for name, folder in new.items():
            os.replace(os.path.join(folder, name), os.path.join(self.root, name))
        if self.overwrite:
            for name in os.listdir(self.root):
                if name.endswith(".json") and name not in new:
                    os.unlink(os.path.join(self.root, name))
        self._clear()

    def abort(self, messages: list) -> None:
        self._clear()

    def _clear(self) -> None:
        for folder, _, names in os.walk(self.staging, topdown=False):
            for name in names:
                os.unlink(os.path.join(folder, name))
            os.rmdir(folder)


class KeyedDocuments(DataSource):
    """``format("keyed_documents")``: ``<key>.json`` for each key of (key, part, head, items), with the items under ``list``.

    Rows of a key come together and in order of part. Keys that are no plain names are left out. Nothing is seen
    under the root before all tasks have ended, and an attempt that failed leaves nothing.
    """

    @classmethod
    def name(cls) -> str:
        return "keyed_documents"

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return _Writer(self.options, overwrite)


def write_documents(parts: DataFrame, path: str, field: str, partitions: int | None = None) -> None:
    """Documents of parts (key, part, head, items): a key's parts go to one task, which streams them into its file."""
    parts.sparkSession.dataSource.register(KeyedDocuments)
    rows = parts.select("key", "part", "head", "items")
    rows = rows.repartition(partitions, "key") if partitions else rows.repartition("key")
    rows.sortWithinPartitions("key", "part").write.format("keyed_documents").option("list", field).mode("overwrite").save(path)
