"""Providers' pages: rosters with weekdays, a directory with class-addressed columns, center pages, JSON-wrapped accordions.

A page is one document of bounded size; pages are parsed in Arrow batches by the standard library's HTML parser, and what
comes out is plain rows for DataFrame operators."""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Callable, Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import header_key

# Days, their names as headers, and how the pages mark things.
WEEKDAYS = (
    ("monday", "Lunes", ("Lunes", "Lun.")), ("tuesday", "Martes", ("Martes", "Mar.")), ("wednesday", "Miércoles", ("Miércoles", "Mié.")), ("thursday", "Jueves", ("Jueves", "Jue.")), ("friday", "Viernes", ("Viernes", "Vie.")),
    ("saturday", "Sábado", ("Sábado", "Sáb.")), ("sunday", "Domingo", ("Domingo", "Dom.")),
)
NO_RESULTS = "no se encontraron resultados"
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
CLOSES = {"tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "p": {"p"}}
BOUND = {"table", "tbody", "thead", "select", "ul", "ol", "dl", "div"}


class Node:
    def __init__(self, tag: str, attrs: dict[str, str], up: Node | None):
        self.tag, self.attrs, self.up, self.parts = tag, attrs, up, []
        self.classes = set(attrs.get("class", "").split())

    def walk(self) -> Iterator[Node]:
        for p in self.parts:
            if isinstance(p, Node):
                yield p
                yield from p.walk()

    def find(self, *tags: str) -> list[Node]:
        return [n for n in self.walk() if n.tag in tags]

    def having(self, *classes: str) -> list[Node]:
        return [n for n in self.walk() if n.classes.issuperset(classes)]

    def text(self, skip: Callable[[Node], bool] = lambda n: False) -> str:
        return "".join(p if isinstance(p, str) else "\n" if p.tag == "br" else "" if skip(p) else p.text(skip) for p in self.parts)

    def before(self, match: Callable[[Node], bool]) -> Node | None:
        """The nearest sibling before it that matches."""
        found = None
        for p in self.up.parts if self.up else ():
            if p is self:
                return found
            if isinstance(p, Node) and match(p):
                found = p
        return None

    def above(self, match: Callable[[Node], bool]) -> Node | None:
        n = self.up
        while n is not None and not match(n):
            n = n.up
        return n


class _Tree(HTMLParser):
    def __init__(self):
        super().__init__()
        self.root = self.at = Node("", {}, None)

    def handle_starttag(self, tag, attrs):
        n = self.at
        while n.up is not None and n.tag not in BOUND:  # tags that are left open
            if n.tag in CLOSES.get(tag, ()):
                self.at = n.up
            n = n.up
        node = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.parts.append(node)
        if tag not in VOID:
            self.at = node

    def handle_endtag(self, tag):
        n = self.at
        while n.up is not None and n.tag != tag:
            n = n.up
        if n.up is not None:
            self.at = n.up

    def handle_data(self, data):
        if self.at.tag not in ("script", "style"):
            self.at.parts.append(data)


def tree(html: str) -> Node:
    p = _Tree()
    p.feed(html or "")
    p.close()
    return p.root


def line(text: str) -> str:
    return " ".join(text.replace("﻿", " ").split())


def cell(node: Node) -> str:
    return " | ".join(x for x in map(line, node.text().split("\n")) if x)


def _header(text: str) -> str:
    """``header_key`` of a constant."""
    bare = "".join(c for c in unicodedata.normalize("NFD", text) if unicodedata.category(c)[0] != "M" and c not in "^`´¨")
    return " ".join(re.findall(r"[^\W_]+", bare)).lower()


def _key(text: str) -> str:
    bare = "".join(c for c in unicodedata.normalize("NFD", text) if not 0x300 <= ord(c) <= 0x36F)
    return re.sub("[^a-z0-9]+", " ", bare.lower()).strip()


def schedule_table(html: str) -> tuple[list[str], list[list[str]]]:
    """(headers, rows) of the first table with a header that begins with 'medico' and one that is 'especialidad'; empty where
    the page says that nothing was found; ValueError otherwise."""
    page = tree(html)
    for table in page.find("table"):
        rows = table.find("tr")
        heads = [line(c.text()) for c in rows[0].find("th", "td")] if rows else []
        keys = [_key(h) for h in heads]
        if any(k.startswith("medico") for k in keys) and "especialidad" in keys:
            body = [[cell(c) for c in r.find("th", "td")] for r in rows[1:]]
            return heads, [r for r in body if any(r)]
    if NO_RESULTS in line(page.text()).lower():
        return [], []
    raise ValueError("no schedule table, and no word that there is none")


def doctor_options(html: str, field: str = "FiltroId2") -> list[tuple[str, str]]:
    """(value, label) of the select of that id, or else name: each value once, none that is empty or 0. ValueError if none."""
    selects = tree(html).find("select")
    chosen = [s for s in selects if s.attrs.get("id") == field] or [s for s in selects if s.attrs.get("name") == field]
    out: dict[str, str] = {}
    for o in chosen[0].find("option") if chosen else ():
        value, label = line(o.attrs.get("value", "")), line(o.text())
        if value not in ("", "0") and label:
            out.setdefault(value, label)
    if not out:
        raise ValueError(f"no options in {field}")
    return list(out.items())


def directory_rows(html: str, table_id: str) -> list[dict]:
    """Rows of a table whose cells are addressed by classes column-N: place, and for each column its text and link."""
    found = [t for t in tree(html).find("table") if t.attrs.get("id") == table_id]
    out = []
    bodies = found[0].find("tbody") if found else []
    for i, r in enumerate([r for b in bodies for r in b.find("tr")], 1):
        cells: dict[int, tuple[str, str]] = {}
        for td in r.find("td"):
            at = next((int(m[1]) for c in td.attrs.get("class", "").split() if (m := re.fullmatch(r"column-(\d+)", c))), None)
            if at is not None:
                cells[at] = (line(td.text()), next((a.attrs.get("href", "") for a in td.find("a")), ""))
        get = lambda k: cells.get(k, ("", ""))  # noqa: B023, E731
        out.append({"row": i, "specialty": get(1)[0], "physician": get(2)[0], "center": get(3)[0], "address": get(4)[0], "href": get(3)[1], "complete": all(k in cells for k in (1, 2, 3, 4))})
    return out


def center_rows(html: str) -> list[dict]:
    """Rows of the tables of a center's page whose header speaks of a technician and of days and hours: specialty (caption,
    title of the accordion pane, heading before the table or before its parent, whichever has words first), physician
    without a note, schedule; ``valid`` is false for rows without one of the two."""
    out = []
    heading = lambda n: n.tag in ("h2", "h3", "h4", "h5", "h6") or (n.tag == "dt" and "sc-accordion-title" in n.classes)
    for t, table in enumerate(tree(html).find("table")):
        rows = table.find("tr")
        first = _key(rows[0].text()) if rows else ""
        if "tecnico" not in first or "dias y horarios" not in first:
            continue
        pane = table.above(lambda n: n.tag == "dd" and "sc-accordion-pane" in n.classes)
        near = [next(iter(table.find("caption")), None), pane and pane.before(lambda n: n.tag == "dt" and "sc-accordion-title" in n.classes), table.before(heading), table.up and table.up.before(heading)]
        specialty = next((x for x in (line(n.text()) for n in near if n is not None) if x), None)
        for i, r in enumerate(rows[1:], 1):
            cells = r.find("td")
            texts = ["\n".join(x for x in map(line, c.text().split("\n")) if x) for c in cells[:2]]
            name = line(re.sub(r"\s*\([^)]*\).*$", "", texts[0].split("\n")[0])) if texts else ""
            schedule = texts[1] if len(texts) > 1 else ""
            out.append({"table": t, "row": i, "specialty": specialty, "physician": name, "label": texts[0] if texts else "", "schedule": schedule, "valid": bool(name and schedule)})
    return out


def accordion_rows(response: str) -> list[dict]:
    """Entries of a response {"resultados_html": ...}: specialty, physician, clinic, day, schedule; ``valid`` is false, and
    the schedule empty, where a physician or an entry lacks what it needs. ValueError for any other response."""
    body = json.loads(response)
    if not isinstance(body, dict) or not isinstance(body.get("resultados_html"), str):
        raise ValueError("no resultados_html")
    out = []
    for item in tree(body["resultados_html"]).having("accordion-item", "horarios-v2-grid-especialidad"):
        heads = [n for h in item.having("horarios-v2-grid-especialidad-header") for n in h.having("fw-semibold")]
        specialty = line(heads[0].text()) if heads else ""
        for k, who in enumerate(item.having("horarios-medico"), 1):
            wide = [n for b in who.having("d-none", "d-lg-block") for n in b.having("text-primary")]
            name = line(wide[0].text()) if wide else ""
            name = name or next((line(n.text()) for n in who.having("text-primary")), "")
            clinic = next((line(n.text(lambda x: x.tag == "span")) for n in who.having("horarios-clinica-mobile")), "")
            base = {"specialty": specialty, "physician": name, "clinic": clinic, "physician_row": k, "day": "", "schedule": "", "valid": False}
            entries = [n for m in who.having("horarios-mobile") for n in m.parts if isinstance(n, Node) and n.tag == "div" and "d-lg-none" in n.classes]
            if not specialty or not name or not entries:
                out.append(base)
                continue
            for e in entries:
                marks = e.having("fw-medium")
                day = re.sub(r":\s*$", "", line(marks[0].text())) if marks else ""
                times = line(e.text(lambda x: bool(marks) and x is marks[0]))  # noqa: B023
                out.append(base | {"day": day, "schedule": f"{day}: {times}" if day and times else "", "valid": bool(day and times)})
    return out


def exploded(pages: DataFrame, key: str, html: str, parse: Callable[[str], list[dict]], schema: str) -> DataFrame:
    """The parser's rows of every page, with its key; ``error`` is set, and the rest null, where a page can't be read."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    kind = dict(pages.dtypes)[key]
    whole = f"`{key}` {kind}, {schema}, error string"
    arrow = to_arrow_schema(StructType.fromDDL(whole))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for k, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                try:
                    out += [r | {key: k, "error": None} for r in parse(text or "")]
                except ValueError as e:
                    out.append({key: k, "error": str(e)})
            yield pa.RecordBatch.from_pylist(out, arrow)

    return pages.select(key, html).mapInArrow(run, whole)


def roster(rows: DataFrame, headers: Column, cells: Column, columns: dict[str, list[str]]) -> DataFrame:
    """Rows of schedule tables as records: the named columns by any of their headers (folded), '' where a table has none, and
    ``weekly``, the days that have hours. Rows without a name and a specialty are left out."""
    rows = rows.withColumn("_keys", F.transform(headers, header_key))

    def at(aliases) -> Column:
        found = [F.nullif(F.array_position("_keys", _header(a)).cast("int"), F.lit(0)) for a in aliases]
        return F.coalesce(*found) if found else F.lit(None).cast("int")

    value = lambda aliases: F.coalesce(F.get(cells, at(aliases) - 1), F.lit(""))
    days = [F.struct(F.lit(d).alias("day"), F.coalesce(F.get(headers, at(alias) - 1), F.lit(label)).alias("label"), value(alias).alias("value")) for d, label, alias in WEEKDAYS]
    out = rows.select("*", *[value(a).alias(n) for n, a in columns.items()], F.filter(F.array(*days), lambda d: d["value"] != "").alias("weekly"))
    return out.where("professional_name <> '' OR specialty <> ''").drop("_keys")
