"""A streaming source over ListRecords pages: each read takes the next pages, and its offset is the resumption state.

Pages come from a folder of saved XML files (``NNNNNN.xml`` in order), which is what a fetcher leaves behind; the source
itself needs no network. Register it with ``spark.dataSource.register(OaiPages)`` and read ``format("oai_pages")``.
"""

from __future__ import annotations

import os

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition, SimpleDataSourceStreamReader


def _listing(folder: str) -> list[str]:
    return sorted(n for n in os.listdir(folder) if n.endswith(".xml"))


def _row(options: dict, folder: str, name: str) -> tuple:
    with open(os.path.join(folder, name), encoding="utf-8", errors="replace") as f:
        return options.get("repo", ""), options.get("prefix", "oai_dc"), name, f.read()


class _Stream(SimpleDataSourceStreamReader):
    def __init__(self, options: dict):
        self.options, self.folder, self.most = options, options["path"], int(options.get("pagesPerTrigger", 100))

    def initialOffset(self) -> dict:
        return {"page": 0}

    def read(self, start: dict) -> tuple:
        names = _listing(self.folder)[start["page"] : start["page"] + self.most]
        return iter([_row(self.options, self.folder, n) for n in names]), {"page": start["page"] + len(names)}

    def readBetweenOffsets(self, start: dict, end: dict):
        return iter([_row(self.options, self.folder, n) for n in _listing(self.folder)[start["page"] : end["page"]]])

    def commit(self, end: dict) -> None:
        pass


class _Batch(DataSourceReader):
    def __init__(self, options: dict):
        self.options, self.folder = options, options["path"]

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(n) for n in _listing(self.folder)]

    def read(self, partition: InputPartition):
        yield _row(self.options, self.folder, partition.value)


class OaiPages(DataSource):
    @classmethod
    def name(cls) -> str:
        return "oai_pages"

    def schema(self) -> str:
        return "repo string, prefix string, page string, xml string"

    def reader(self, schema) -> DataSourceReader:
        return _Batch(dict(self.options))

    def simpleStreamReader(self, schema) -> SimpleDataSourceStreamReader:
        return _Stream(dict(self.options))
