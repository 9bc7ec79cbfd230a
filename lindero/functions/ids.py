"""Opaque ids, keyed digests, slugs, canonical addresses and page cursors."""

from __future__ import annotations

import base64
import json
import uuid

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import fold, let


def composite_id(prefix: str, *parts: Column, length: int = 24, separator: str = "\x00") -> Column:
    """Prefix and the first characters of a SHA-256 over the joined parts; nulls count as ''."""
    joined = F.concat_ws(separator, *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.concat(F.lit(prefix), F.substring(F.sha2(joined, 256), 1, length))


def json_id(**fields: Column) -> Column:
    """SHA-256 of the fields as one JSON object, in this order, nulls written."""
    return F.sha2(F.to_json(F.struct(*[v.alias(k) for k, v in fields.items()]), {"ignoreNullFields": "false"}), 256)


def pads(key: bytes) -> tuple[str, str]:
    if len(key) < 32:
        raise ValueError("a key needs 32 bytes or more")
    if len(key) > 64:
        import hashlib

        key = hashlib.sha256(key).digest()
    key = key.ljust(64, b"\0")
    return bytes(b ^ 0x36 for b in key).hex(), bytes(b ^ 0x5C for b in key).hex()


def hmac_sha256(key: bytes, message: Column) -> Column:
    """Hex HMAC without leaving the JVM. The pads are literals: plans of this expression are as secret as the key."""
    inner, outer = pads(key)
    first = F.sha2(F.concat(F.unhex(F.lit(inner)), F.encode(message, "UTF-8")), 256)
    return F.sha2(F.concat(F.unhex(F.lit(outer)), F.unhex(first)), 256)


def uuid_v8(hexes: Column) -> Column:
    """A version 8 UUID from the first 16 bytes of a digest."""
    part = lambda a, n: F.substring(hexes, a, n)
    variant = F.element_at(F.array(*[F.lit(x) for x in "89ab"]), (F.conv(part(17, 1), 16, 10).cast("int") % 4 + 1))
    return F.concat_ws("-", part(1, 8), part(9, 4), F.concat(F.lit("8"), part(14, 3)), F.concat(variant, part(18, 3)), part(21, 12))


def slug(c: Column, fallback: str = "profesional", length: int = 140) -> Column:
    trim = lambda x: F.regexp_replace(x, "^-+|-+$", "")
    body = trim(F.substring(trim(F.regexp_replace(F.lower(fold(c)), "[^a-z0-9]+", "-")), 1, length))
    return F.when(body == "", fallback).otherwise(body)


def canonical_url(c: Column) -> Column:
    """https, no fragment, no default port; null for what isn't http(s)."""
    url = F.regexp_replace(F.regexp_replace(F.trim(c), "(?i)^http://", "https://"), "#.*$", "")
    url = F.regexp_replace(url, r"^(https://[^/?]+):443(?=[/?]|$)", "$1")
    return F.when(url.rlike("^https://[^/?#]+"), url)


def resolve(href: Column, base: Column) -> Column:
    """An address relative to a page's: whole, without scheme, from the root, a query or fragment, or beside the page; dot
    segments are taken out."""
    page = F.regexp_replace(base, "[?#].*$", "")
    origin = F.regexp_extract(page, "^([A-Za-z][A-Za-z0-9+.-]*://[^/]*)", 1)
    path = F.substring(page, F.char_length(origin) + 1, F.char_length(page))
    folder = F.when(path == "", "/").otherwise(F.regexp_replace(path, "[^/]*$", ""))
    h = F.trim(href)
    whole = F.when(h.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), h).when(h.startswith("//"), F.concat(F.regexp_extract(page, "^([A-Za-z][A-Za-z0-9+.-]*:)", 1), h))
    whole = whole.when(h.startswith("/"), F.concat(origin, h)).when(h == "", base).when(h.startswith("?"), F.concat(page, h)).when(h.startswith("#"), F.concat(F.regexp_replace(base, "#.*$", ""), h))
    whole = whole.otherwise(F.concat(origin, folder, h))
    return let(whole, _without_dots)


def _without_dots(url: Column) -> Column:
    """The address without dot segments, as it is if it has no authority."""
    start, tail = F.regexp_extract(url, "^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1), F.regexp_extract(url, "^[^?#]*(.*)$", 1)
    parts = F.split(F.regexp_extract(url, "^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1), "/")
    step = lambda a, x: F.when(x == "..", F.slice(a, 1, F.greatest(F.size(a) - 1, F.lit(1)))).otherwise(F.concat(a, F.array(x)))

    def joined(p: Column) -> Column:
        kept = F.aggregate(F.filter(p, lambda x: x != "."), F.array().cast("array<string>"), step)
        last = F.when(F.element_at(p, -1).isin(".", ".."), F.array(F.lit(""))).otherwise(F.array().cast("array<string>"))
        return F.array_join(F.concat(kept, last), "/")

    return F.when(start == "", url).otherwise(F.concat(start, let(parts, joined), tail))


def article_url(href: Column, base: Column, hosts: list[str]) -> Column:
    """The canonical address of an article, if it is https and of one of the hosts; else null."""
    allowed = [h.lower() for h in hosts]
    return let(canonical_url(resolve(href, base)), lambda url: F.when(F.lower(F.parse_url(url, F.lit("HOST"))).isin(*allowed), url))


def encode_cursor(name: str, public_id: str) -> str:
    body = json.dumps({"version": 1, "normalizedName": name, "id": public_id}, separators=(",", ":"), ensure_ascii=False)
    return base64.urlsafe_b64encode(body.encode()).decode().rstrip("=")


def decode_cursor(cursor: str) -> tuple[str, str]:
    """(name, id); ValueError for anything but a cursor of this version, so a bad one never restarts a listing."""
    try:
        body = json.loads(base64.urlsafe_b64decode(cursor + "=" * (-len(cursor) % 4)))
        name, public_id = body["normalizedName"], body["id"]
        if set(body) != {"version", "normalizedName", "id"} or body["version"] != 1 or not 0 < len(name) <= 200:
            raise ValueError("cursor")
        uuid.UUID(public_id)
    except (ValueError, KeyError, TypeError) as e:
        raise ValueError("invalid cursor") from e
    return name, public_id
