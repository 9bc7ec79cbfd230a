"""Rules of fetching: addresses, redirects, retries, limits. The transport is a parameter (a function of address, seconds and
greatest size that returns a ``Response``), so the rules hold for any client and are tested without a network. One file
is fetched by the driver; ``fetch_table`` fetches many in tasks."""

from __future__ import annotations

import hashlib
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from datetime import datetime, timezone
from email.utils import parsedate_to_datetime
from urllib.parse import urljoin, urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame

# Statuses and limits.
REDIRECTS = (301, 302, 303, 307, 308)
RETRYABLE = (408, 425, 429, 500, 502, 503, 504)
XML_TYPES = ("application/atom+xml", "application/rss+xml", "application/xml", "text/xml")
MOST_BYTES, SECONDS, RETRIES, HOPS = 64 << 20, 30.0, 3, 5
LONGEST_WAIT, LONGEST_BACKOFF = 60.0, 5.0


class FetchError(Exception):
    def __init__(self, code: str, retryable: bool = False, wait: float | None = None):
        super().__init__(code)
        self.code, self.retryable, self.wait = code, retryable, wait


@dataclass
class Response:
    status: int
    body: bytes = b""
    headers: dict[str, str] = field(default_factory=dict)  # names in lower case


Transport = Callable[[str, float, int], Response]


def retry_after(value: str | None, now: datetime | None = None) -> float | None:
    """Seconds to wait, a minute at most: from a number of seconds or a date; None for anything else."""
    if value is None:
        return None
    try:
        seconds = float(value)
        return min(seconds, LONGEST_WAIT) if 0 <= seconds < float("inf") else None
    except ValueError:
        pass
    try:
        at = parsedate_to_datetime(value)
    except ValueError:
        return None
    return min(max((at - (now or datetime.now(timezone.utc))).total_seconds(), 0.0), LONGEST_WAIT)


def trusted(url: str, hosts: tuple[str, ...] | None = None) -> str:
    """The address, if it is https without user or password, and of the hosts and the usual port, if hosts are given."""
    try:
        parts = urlsplit(url)
        port = parts.port
    except ValueError as e:
        raise FetchError("INVALID_URL") from e
    if parts.scheme.lower() != "https" or not parts.hostname or parts.username or parts.password:
        raise FetchError("UNTRUSTED_URL")
    if hosts is not None and (parts.hostname.lower() not in {h.lower() for h in hosts} or port not in (None, 443)):
        raise FetchError("UNTRUSTED_URL")
    return url


def _checked(got: Response, most: int) -> Response:
    declared = got.headers.get("content-length", "")
    if (declared.isdigit() and int(declared) > most) or len(got.body) > most:
        raise FetchError("BYTE_LIMIT")
    return got


def follow(url: str, transport: Transport, hops: int = HOPS, hosts: tuple[str, ...] | None = None, seconds: float = SECONDS, most: int = MOST_BYTES, before: Callable[[str], None] | None = None) -> tuple[Response, str]:
    """(response, address) after redirects; each address is checked anew."""
    url = trusted(url, hosts)
    for hop in range(hops + 1):
        if before:
            before(url)
        got = transport(url, seconds, most)
        if got.status not in REDIRECTS:
            return _checked(got, most), url
        if hop == hops:
            raise FetchError("REDIRECT_LIMIT")
        if "location" not in got.headers:
            raise FetchError("INVALID_REDIRECT")
        url = trusted(urljoin(url, got.headers["location"]), hosts)
    raise FetchError("REDIRECT_LIMIT")


def download(url: str, transport: Transport, retries: int = RETRIES, first_wait: float = 0.25, sleep: Callable[[float], None] = time.sleep, **limits) -> tuple[Response, str, int]:
    """(response, final address, attempts). Retried: the retryable statuses and failures of the transport itself, after what
    the server asks for, else twice as long each time, five seconds at most."""
    if not 0 <= retries <= 10:
        raise ValueError("retries must be 0 to 10")
    for attempt in range(1, retries + 2):
        try:
            got, at = follow(url, transport, **limits)
            if 200 <= got.status < 300:
                return got, at, attempt
            raise FetchError(f"HTTP_{got.status}", got.status in RETRYABLE, retry_after(got.headers.get("retry-after")))
        except FetchError as e:
            failure = e
        except OSError as e:
            failure = FetchError(f"TRANSPORT: {e}", True)
        if not failure.retryable or attempt > retries:
            raise failure
        sleep(failure.wait if failure.wait is not None else min(first_wait * 2 ** (attempt - 1), LONGEST_BACKOFF))
    raise AssertionError("unreachable")


def fetch_text(url: str, transport: Transport, retries: int = 3, first_wait: float = 0.5, linear: bool = False, sleep: Callable[[float], None] = time.sleep, **limits) -> str:
    """A page's text. ``linear``: the wait grows by ``first_wait`` an attempt instead of doubling."""
    waits = iter(range(1, retries + 2))
    rest = (lambda _: sleep(first_wait * next(waits))) if linear else sleep
    got, _, _ = download(url, transport, retries, first_wait, rest, **limits)
    return got.body.decode("utf-8", "replace")


def fetch_xml(url: str, hosts: tuple[str, ...], transport: Transport, authorized: bool, most: int = 5 << 20, seconds: float = 20.0, before: Callable[[str], None] | None = None) -> dict:
    """An index of an authorized source: at most three redirects within its hosts, an XML media type (or none), strict UTF-8.
    One attempt: an index is fetched again by the next run."""
    if not authorized:
        raise FetchError("SOURCE_NOT_AUTHORIZED")
    got, at = follow(url, transport, 3, hosts, seconds, most, before)
    if not 200 <= got.status < 300:
        raise FetchError("HTTP_STATUS")
    kind = got.headers.get("content-type", "").split(";")[0].strip().lower()
    if kind and kind not in XML_TYPES:
        raise FetchError("CONTENT_TYPE")
    try:
        xml = got.body.decode("utf-8")
    except UnicodeDecodeError as e:
        raise FetchError("ENCODING") from e
    return {"xml": xml.removeprefix("﻿"), "final_url": at, "bytes": len(got.body), "sha256": hashlib.sha256(got.body).hexdigest(), "last_modified": got.headers.get("last-modified")}


class Pacer:
    """Waits until a host's last request is so many seconds ago."""

    def __init__(self, seconds: float, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep):
        self.seconds, self.clock, self.sleep = seconds, clock, sleep
        self.last: dict[str, float] = {}

    def __call__(self, url: str) -> None:
        host = urlsplit(url).hostname or ""
        left = self.last.get(host, float("-inf")) + self.seconds - self.clock()
        if left > 0:
            self.sleep(left)
        self.last[host] = self.clock()


def fetch_table(urls: DataFrame, url: str, transport: Transport, pause: float = 1.0, **limits) -> DataFrame:
    """(url, host, body, attempts, error) of every address. Addresses of a host are one task's, which paces them; a failure is
    a row, so one dead host fails nothing else."""
    from pyspark.sql import functions as F

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pace = Pacer(pause)
        for b in batches:
            for u, host in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                body, attempts, error = None, None, None
                try:
                    got, _, attempts = download(u, transport, before=pace, **limits)
                    body = got.body
                except FetchError as e:
                    error = e.code
                yield pa.RecordBatch.from_pydict({"url": [u], "host": [host], "body": pa.array([body], pa.binary()), "attempts": pa.array([attempts], pa.int32()), "error": pa.array([error], pa.string())})

    asked = urls.select(F.col(url).alias("url"), F.lower(F.parse_url(url, F.lit("HOST"))).alias("host"))
    return asked.repartition("host").sortWithinPartitions("host", "url").mapInArrow(run, "url string, host string, body binary, attempts int, error string")
