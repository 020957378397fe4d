"""Acquisition: a client with retries and pacing, cursor and offset pagination, and a partitioned data source.

The transport is a callable that the caller brings, so nothing here opens a socket by
itself, and tests run against a fake.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from pathlib import Path

#: (url, parameters) to (status, body); raises ConnectionError where there is no answer.
Transport = Callable[[str, dict], tuple[int, bytes]]


class Unavailable(RuntimeError):
    """No usable answer after all tries."""


class Missing(Unavailable):
    """There is no such thing, or not yet (404)."""


class Blocked(RuntimeError):
    """The other side answers a page for robots where data are expected."""


@dataclass
class Client:
    """Several tries with doubling pauses on lost connections, 429 and 5xx; a pause before each request."""

    transport: Transport
    pause: float = 0.5
    tries: int = 4
    first_backoff: float = 2.0
    sleep: Callable[[float], None] = field(default=time.sleep)

    def get(self, url: str, **parameters) -> bytes:
        problem = ""
        for k in range(self.tries):
            self.sleep(self.pause if not k else self.first_backoff * 2 ** (k - 1))
            try:
                status, body = self.transport(url, parameters)
            except ConnectionError as e:
                problem = str(e)
                continue
            if status < 400:
                return body
            problem = f"status {status}"
            if status == 404:
                raise Missing(f"{url}: {problem}")
            if status != 429 and status < 500:
                break
        raise Unavailable(f"{url}: {problem}")

    def json(self, url: str, **parameters) -> dict:
        body = self.get(url, **parameters)
        if body.lstrip()[:1] == b"<":
            raise Blocked(url)
        return json.loads(body)


def by_cursor(client: Client, url: str, records: str = "documents", **parameters) -> Iterator[dict]:
    """Records page by page until the cursor no longer moves."""
    cursor = None
    while True:
        page = client.json(url, **parameters, **({"cursor": cursor} if cursor else {}))
        yield from page.get(records, [])
        if page.get("cursor") in (None, cursor):
            return
        cursor = page["cursor"]


def by_offset(client: Client, url: str, size: int = 100, records: str = "data", **parameters) -> Iterator[dict]:
    """Records page by page until one is not full (C4)."""
    at = 0
    while True:
        page = client.json(url, **parameters, range_start=at, range_end=size).get(records, [])
        yield from page
        if len(page) < size:
            return
        at += size


def until_known(pages: Iterator[list[str]], known: set[str]) -> list[str]:
    """New ids of lists that show the newest first: stops after the first page that brings none."""
    new: list[str] = []
    for page in pages:
        fresh = [x for x in page if x not in known and x not in new]
        new += fresh
        if not fresh:
            break
    return new


def batches(ids: list, size: int) -> Iterator[list]:
    """Ids in batches."""
    for k in range(0, len(ids), size):
        yield ids[k : k + size]


def save(folder: Path, name: str, body: bytes, url: str, retrieved_at: str, force: bool = False) -> Path:
    """Writes a file and its sidecar if the file is missing; through a temporary name, so readers never see half."""
    path = Path(folder) / name
    if path.exists() and not force:
        return path
    path.parent.mkdir(parents=True, exist_ok=True)
    half = path.with_name(path.name + ".part")
    half.write_bytes(body)
    path.with_name(path.name + ".meta.json").write_text(json.dumps({"url": url, "retrieved_at": retrieved_at}))
    half.replace(path)
    return path
