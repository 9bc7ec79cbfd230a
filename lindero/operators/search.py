"""Directory queries: substring search, keyset pages, look-ups by slug or id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ids import decode_cursor, encode_cursor
from ..functions.text import search_term


def check_bounds(limit: int = 20, query: str | None = None) -> str | None:
    """The trimmed query, None if blank; ValueError outside the bounds."""
    if not isinstance(limit, int) or isinstance(limit, bool) or not 1 <= limit <= 50:
        raise ValueError("limit must be 1 to 50")
    query = (query or "").strip()
    if len(query) > 200:
        raise ValueError("query is longer than 200 characters")
    return query or None


def contains_term(column: Column, term: str) -> Column:
    """Substring of a folded column. ``contains`` needs no escaping; ILIKE would: see ``functions.text.like_escape``."""
    return F.contains(F.lower(column), F.lit(term.lower()))


def contains_folded(column: Column, term: str) -> Column:
    """Substring of a text, both folded as search terms are. A column that is stored folded needs ``contains_term`` alone."""
    return F.contains(search_term(column), search_term(F.lit(term)))


def check_id(value: str) -> str:
    """An id or slug of 1 to 200 characters."""
    value = value.strip()
    if not 1 <= len(value) <= 200:
        raise ValueError("an id has 1 to 200 characters")
    return value


def after(name: str, public_id: str, at: tuple) -> Column:
    return (F.col(name) > F.lit(at[0])) | ((F.col(name) == F.lit(at[0])) & (F.col(public_id) > F.lit(at[1])))


def keyset_page(df: DataFrame, name: str, public_id: str, limit: int, at: tuple | None = None) -> DataFrame:
    """The next limit + 1 rows after a position: a top-k, not a sort of all."""
    rows = df.where(after(name, public_id, at)) if at else df
    return rows.orderBy(name, public_id).limit(limit + 1)


def search(df: DataFrame, name: str, public_id: str, limit: int = 20, query: str | None = None, cursor: str | None = None) -> tuple[list, str | None]:
    """(rows, next cursor) of one page of ``df``, whose names are stored folded."""
    query = check_bounds(limit, query)
    rows = df.where(F.contains(F.col(name), search_term(F.lit(query)))) if query else df
    found = keyset_page(rows, name, public_id, limit, decode_cursor(cursor) if cursor else None).collect()
    more = len(found) > limit
    found = found[:limit]
    return found, encode_cursor(found[-1][name], found[-1][public_id]) if more else None


def by_id_or_slug(people: DataFrame, routes: DataFrame, key: str, wanted: str) -> DataFrame:
    """One plan for both kinds of address: an id, or any slug, old ones too, lead to the current row."""
    wanted = check_id(wanted)
    hit = routes.where((F.col("slug") == wanted.lower()) | (F.col(key) == wanted)).select(key).distinct()
    current = routes.where(F.col("route_kind") == "CURRENT").select(key, F.col("slug").alias("current_slug"))
    return people.join(hit, key, "left_semi").join(current, key).limit(1)
