"""The usual transport for ``remote`` and ``batches``: urllib, with the time limits of each kind of request."""

from __future__ import annotations

import json
from typing import BinaryIO
from urllib.parse import urlencode
from urllib.request import Request, urlopen

from tessellar.sources.remote import RangeFile

#: Seconds for a page or an index, a file, a batch, a size, a range.
PAGE, FILE, BATCH, SIZE, RANGE = 30, 60, 600, 15, 30


def get_json(url: str, params: dict) -> dict:
    with urlopen(f"{url}?{urlencode(params)}", timeout=PAGE) as answer:
        return json.load(answer)


def get_text(url: str) -> str:
    with urlopen(url, timeout=PAGE) as answer:
        return answer.read().decode("utf-8")


def fetch(url: str) -> bytes:
    with urlopen(url, timeout=FILE) as answer:
        return answer.read()


def open_batch(url: str) -> BinaryIO:
    return urlopen(url, timeout=BATCH)


def range_file(url: str) -> RangeFile:
    """A file read by byte ranges; redirects are followed once."""
    with urlopen(Request(url, method="HEAD"), timeout=SIZE) as answer:
        size, final = int(answer.headers["Content-Length"]), answer.url

    def part(first: int, last: int) -> bytes:
        with urlopen(Request(final, headers={"Range": f"bytes={first}-{last}"}), timeout=RANGE) as answer:
            return answer.read()

    return RangeFile(size, part)
