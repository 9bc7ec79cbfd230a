"""Strict and lenient readers: delimited text, NDJSON, feeds, HTML tables. Files are read by Spark, so any store it
knows will do; Python parses only what has no reader of its own, in Arrow batches."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ids import canonical_url
from ..functions.text import single_line

#: cp1252 bytes without a character, which the web's decoder maps to control characters.
_HOLES = {b: chr(b) for b in (0x81, 0x8D, 0x8F, 0x90, 0x9D)}


def decode_cp1252(data: bytes) -> str:
    return "".join(_HOLES.get(b) or bytes([b]).decode("cp1252") for b in data) if any(b in data for b in _HOLES) else data.decode("cp1252")


def parse_delimited(text: str, delimiter: str = ",", quote: str = '"') -> list[list[str]]:
    """RFC 4180 without leniency: ValueError for text after a closing quote, a quote inside a bare field, or a quote
    that is never closed. A byte order mark is skipped; line ends inside quotes become '\\n'; a blank interior line is a
    record of one empty field."""
    if len(delimiter) != 1 or len(quote) != 1 or delimiter == quote or {delimiter, quote} & set("\r\n"):
        raise ValueError("delimiter and quote must be two different characters")
    text = text.removeprefix("﻿")
    field = re.compile(rf"[ \t]*{re.escape(quote)}((?:[^{re.escape(quote)}]|{re.escape(quote * 2)})*){re.escape(quote)}[ \t]*|([^{re.escape(delimiter + quote)}\r\n]*)")
    rows: list[list[str]] = []
    row: list[str] = []
    at, n = 0, len(text)
    while at < n or row:
        m = field.match(text, at)
        value = m[1].replace(quote * 2, quote).replace("\r\n", "\n").replace("\r", "\n") if m[1] is not None else m[2]
        row.append(value)
        at = m.end()
        if at >= n:
            rows.append(row)
            break
        if text[at] == delimiter:
            at += 1
            if at >= n:
                rows.append([*row, ""])
                break
            continue
        if text[at] in "\r\n":
            at += 2 if text.startswith("\r\n", at) else 1
            rows.append(row)
            row = []
            continue
        raise ValueError(f"row {len(rows) + 1}: misplaced or unclosed quote")
    return rows


def read_delimited_strict(spark: SparkSession, path: str, header: list[str], delimiter: str = ",", encoding: str = "utf-8", required: tuple[str, ...] = ()) -> DataFrame:
    """Whole files through the strict parser; a header that differs, a row of another width or one with a blank required field
    fails with its number. For artifacts of bounded size: quotes may hold line ends, so a file can't be split."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for name, data in zip(b["path"], b["content"]):
                text = decode_cp1252(bytes(data)) if encoding == "cp1252" else bytes(data).decode(encoding)
                rows = parse_delimited(text, delimiter)
                if not rows or rows[0] != header:
                    raise ValueError(f"{name}: header differs")
                for i, r in enumerate(rows[1:], 2):
                    if len(r) != len(header):
                        raise ValueError(f"{name}: row {i} has {len(r)} columns")
                    if blank := [h for h in required if not r[header.index(h)].strip()]:
                        raise ValueError(f"{name}: row {i} has an empty {blank[0]}")
                yield pd.DataFrame([[*r, i] for i, r in enumerate(rows[1:], 2)], columns=[*header, "row"])

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInPandas(run, ", ".join(f"`{h}` string" for h in header) + ", `row` long")


def read_delimited(spark: SparkSession, path: str, schema: str, delimiter: str = ",") -> DataFrame:
    """The lenient, splittable path."""
    return spark.read.csv(path, schema=schema, sep=delimiter, quote='"', escape='"', multiLine=True, header=True)


def ndjson_with_quarantine(lines: DataFrame, schema: str, required: str) -> tuple[DataFrame, DataFrame]:
    """(parsed rows, quarantined lines): a column ``value`` of JSON lines; blank lines are skipped. A line is set aside,
    with its digest and a reason, if it is no object or lacks the required field."""
    rows = lines.where(F.trim("value") != "")
    rows = rows.withColumn("_json", F.expr("try_parse_json(value)")).withColumn("_row", F.from_json("value", schema))
    name = F.trim(F.col(f"_row.{required}"))
    reason = F.when(F.col("_json").isNull(), "invalid_json").when(~F.ltrim("value").startswith("{"), "not_an_object").when(name.isNull() | (name == ""), "missing_" + required)
    rows = rows.withColumn("_reason", reason)
    bad = rows.where(F.col("_reason").isNotNull()).select(F.col("_reason").alias("reason"), F.sha2("value", 256).alias("line_sha256"))
    return rows.where(F.col("_reason").isNull()).select("_row.*"), bad


def reconcile(physical: int, parsed: int, quarantined: int, declared: int | None = None) -> None:
    if physical != parsed + quarantined:
        raise ValueError(f"{physical} lines, {parsed} parsed and {quarantined} quarantined")
    if declared is not None and declared != physical:
        raise ValueError(f"{physical} lines, {declared} declared")


def strict_ndjson(text: str) -> list[str]:
    """Lines of one artifact; no byte order mark, no blank row, one line end at the end unless it is empty."""
    if text.startswith("﻿"):
        raise ValueError("byte order mark")
    if text and not text.endswith("\n"):
        raise ValueError("no line end at the end")
    lines = text.split("\n")[:-1]
    for i, line in enumerate(lines, 1):
        if not line.strip():
            raise ValueError(f"row {i} is blank")
    return lines


def read_feed(spark: SparkSession, path: str, tag: str = "item") -> DataFrame:
    """All items of an RSS channel, or urls of a news sitemap, in file order: file, place, title, link, published."""
    at = [F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("place")]
    if tag == "item":
        raw = spark.read.format("xml").option("rowTag", "item").schema("title string, link string, pubDate string").load(path)
        raw = raw.select(*at, "title", "link", F.col("pubDate").alias("published"))
    else:
        raw = spark.read.format("xml").option("rowTag", "url").schema("loc string, `news:news` struct<`news:title`: string, `news:publication_date`: string>").load(path)
        raw = raw.select(*at, F.col("`news:news`.`news:title`").alias("title"), F.col("loc").alias("link"), F.col("`news:news`.`news:publication_date`").alias("published"))
    clean = lambda c: F.nullif(single_line(F.col(c)), F.lit(""))
    return raw.select("file", "place", *[clean(c).alias(c) for c in ("title", "link", "published")])


def feed_items(items: DataFrame, hosts: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(valid items, count of invalid ones a file). Invalid: no title or one over 1,000 characters, no https link (of the
    hosts, if given), no date. Of items with one link the last counts, at the place of the first."""
    url = canonical_url(F.col("link"))
    if hosts is not None:
        url = F.when(F.lower(F.parse_url(url, F.lit("HOST"))).isin(*hosts), url)
    items = items.withColumns({"url": url, "at": parse_date(F.col("published"))})
    good = F.col("title").isNotNull() & (F.char_length("title") <= 1000) & F.col("url").isNotNull() & F.col("at").isNotNull()
    items = items.withColumn("_good", F.coalesce(good, F.lit(False)))
    last = F.max_by(F.struct("title", "at"), "place").alias("_last")
    valid = items.where("_good").groupBy("file", "url").agg(F.min("place").alias("place"), last).select("file", "place", "url", "_last.title", F.col("_last.at").alias("published_at"))
    return valid, items.groupBy("file").agg(F.count_if(~F.col("_good")).alias("invalid"))


def parse_date(c):
    """RFC 822 or ISO instants as timestamps; null for anything else."""
    bare = F.regexp_replace(c, "^[A-Za-z]{3}, *", "")
    forms = ("d MMM yyyy HH:mm:ss z", "d MMM yyyy HH:mm:ss Z", "yyyy-MM-dd'T'HH:mm:ssXXX", "yyyy-MM-dd'T'HH:mm:ss.SSSXXX", "yyyy-MM-dd")
    return F.coalesce(*[F.try_to_timestamp(bare, F.lit(f)) for f in forms])


class _Tables(HTMLParser):
    """Rows of all tables, options of selects, as text; <br> is a line end."""

    def __init__(self):
        super().__init__()
        self.cells: list[tuple[int, int, list[str]]] = []
        self.options: list[tuple[str, str]] = []
        self.table, self.row, self.parts, self.value = -1, -1, None, None

    def handle_starttag(self, tag, attrs):
        if tag == "table":
            self.table, self.row = self.table + 1, -1
        elif tag == "tr":
            self.row += 1
            self.cells.append((self.table, self.row, []))
        elif tag in ("td", "th", "option"):
            self.parts, self.value = [], dict(attrs).get("value")
        elif tag == "br" and self.parts is not None:
            self.parts.append("\n")

    def handle_data(self, data):
        if self.parts is not None:
            self.parts.append(data)

    def handle_endtag(self, tag):
        if tag in ("td", "th") and self.parts is not None and self.cells:
            self.cells[-1][2].append(_clean("".join(self.parts)))
        elif tag == "option" and self.parts is not None:
            label = _clean("".join(self.parts))
            if self.value not in (None, "", "0") and label and all(v != self.value for v, _ in self.options):
                self.options.append((self.value, label))
        if tag in ("td", "th", "option"):
            self.parts = None


def _clean(text: str) -> str:
    return " | ".join(x for x in (" ".join(line.split()) for line in text.split("\n")) if x)


def html_tables(html: str) -> list[tuple[int, int, list[str]]]:
    p = _Tables()
    p.feed(html or "")
    return [c for c in p.cells if c[2]]


def html_options(html: str) -> list[tuple[str, str]]:
    p = _Tables()
    p.feed(html or "")
    return p.options


def explode_tables(df: DataFrame, html: str, key: str) -> DataFrame:
    """(key, table, row, cells) of every table row; pages are parsed in Arrow batches."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame([(k, t, r, c) for k, h in zip(b[key], b[html]) for t, r, c in html_tables(h)], columns=[key, "table", "row", "cells"])

    return df.select(key, html).mapInPandas(run, f"`{key}` {dict(df.dtypes)[key]}, `table` int, `row` int, cells array<string>")


def by_header(rows: DataFrame, key: str, names: dict[str, list[str]]) -> DataFrame:
    """Rows of the tables whose first row has all the named headers (folded), as one column each."""
    from ..functions.text import header_key

    heads = rows.where("`row` = 0").select(key, "table", F.transform("cells", header_key).alias("_head"))
    at = {n: F.greatest(*[F.array_position("_head", a) for a in alias], F.lit(0)) for n, alias in names.items()}
    heads = heads.select(key, "table", *[v.cast("int").alias(f"_{n}") for n, v in at.items()]).where(" AND ".join(f"_{n} > 0" for n in names))
    body = rows.where("`row` > 0").join(heads, [key, "table"])
    return body.select(key, "table", "row", *[F.get("cells", F.col(f"_{n}") - 1).alias(n) for n in names])
