"""Remote sources as Python data sources; how bytes are fetched is handed in."""

from __future__ import annotations

import io
import json
import zipfile
from collections.abc import Callable, Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tessellar import schemas

#: (url, parameters) to the decoded JSON answer.
GetJson = Callable[[str, dict], dict]


def cursor_pages(get: GetJson, url: str, query: str, page_size: int = 100) -> Iterator[dict]:
    """Records of all pages; ends at an empty page, or where the next cursor is missing or unchanged."""
    cursor = "*"
    while True:
        page = get(url, {"query": query, "resultType": "core", "pageSize": page_size, "format": "json", "cursorMark": cursor})
        records = page.get("resultList", {}).get("result", [])
        yield from records
        following = page.get("nextCursorMark")
        if not records or not following or following == cursor:
            return
        cursor = following


def hit_count(get: GetJson, url: str, query: str) -> int:
    return int(get(url, {"query": query, "resultType": "idlist", "pageSize": 1, "format": "json"}).get("hitCount", 0))


class RangeFile(io.RawIOBase):
    """Seekable file over byte ranges: ``size`` of the whole, ``fetch(first, last)`` both inclusive."""

    def __init__(self, size: int, fetch: Callable[[int, int], bytes]):
        self._size, self._fetch, self._at = size, fetch, 0

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def tell(self) -> int:
        return self._at

    def seek(self, offset: int, whence: int = io.SEEK_SET) -> int:
        self._at = offset + {io.SEEK_SET: 0, io.SEEK_CUR: self._at, io.SEEK_END: self._size}[whence]
        return self._at

    def read(self, n: int | None = -1) -> bytes:
        stop = self._size if n is None or n < 0 else min(self._at + n, self._size)
        if stop <= self._at:
            return b""
        data = self._fetch(self._at, stop - 1)
        self._at += len(data)
        return data

    def readinto(self, buffer) -> int:
        data = self.read(len(buffer))
        buffer[: len(data)] = data
        return len(data)


def zip_entries(file: io.RawIOBase) -> list[str]:
    """Names in an archive, from its directory alone."""
    with zipfile.ZipFile(io.BufferedReader(file, buffer_size=1 << 20)) as archive:
        return archive.namelist()


def article_source(get: GetJson, url: str, name: str = "articles") -> type[DataSource]:
    """Data source of API records; options ``query`` and ``page_size``.  A cursor is sequential, so there is one partition."""

    class Reader(DataSourceReader):
        def __init__(self, options: dict):
            self.query, self.size = options.get("query", ""), int(options.get("page_size", 100))

        def read(self, partition: InputPartition) -> Iterator[tuple]:
            for r in cursor_pages(get, url, self.query, self.size):
                links = r.get("fullTextUrlList")
                entries = links and [tuple(e.get(k) for k in ("documentStyle", "site", "url")) for e in links.get("fullTextUrl", [])]
                yield r.get("id"), r.get("title"), (entries,) if links else None

    class Articles(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return schemas.ARTICLES

        def reader(self, schema) -> DataSourceReader:
            return Reader(self.options)

    return Articles


def archive_source(open_archive: Callable[[str], io.RawIOBase], name: str = "archives") -> type[DataSource]:
    """Data source of ``split``, ``pos``, ``entry``; option ``archives`` is JSON of split to url, one partition each."""

    class Reader(DataSourceReader):
        def __init__(self, options: dict):
            self.archives = json.loads(options["archives"])

        def partitions(self) -> list[InputPartition]:
            return [InputPartition(item) for item in self.archives.items()]

        def read(self, partition: InputPartition) -> Iterator[tuple]:
            split, url = partition.value
            for pos, entry in enumerate(zip_entries(open_archive(url))):
                yield split, pos, entry

    class Archives(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return "split STRING, pos BIGINT, entry STRING"

        def reader(self, schema) -> DataSourceReader:
            return Reader(self.options)

    return Archives
