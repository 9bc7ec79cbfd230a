"""Column functions that normalise names, credentials, headers and search terms, all inside the JVM.

Two foldings, by tables built from the Unicode data: ``fold`` is compatibility decomposition without marks (ligatures,
fractions and the like become several characters), ``fold_canonical`` canonical decomposition, which leaves those as they
are. Letters that decompose to one base letter are translated; rows with a character that becomes several are told by
taking those out, and go a second, slower way, all inside the JVM. Precomposed Hangul, which no name here has, stays composed;
``fold_exact``, an Arrow function, folds that too.
"""

from __future__ import annotations

import json
import sys
import unicodedata
from collections.abc import Callable
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Honorifics dropped before a person's name.
HONORIFICS = r"(?i)^(?:(?:dr|dra|doctor|doctora|prof|profesora?|lic|licenciada?|tec|tecnica?|q\s*\.?\s*f)\.?\s+)+"
# One title before a physician's name in provider tables.
PHYSICIAN_TITLE = r"(?i)^(?:dra?|dr|lic|licda?|psic|prof|tecn|tecnica|tecnico)\.?\s+"
# Credentials too general to corroborate a specialty.
GENERIC_CREDENTIALS = ("DOCTOR EN MEDICINA", "MEDICINA", "MEDICINA GENERAL", "MEDICO")
# Word beginnings that signal a medical context.
MEDICAL_STEMS = ("anestesi", "asse", "ciruj", "clinica", "doctor", "doctora", "hospital", "medic", "msp", "mutualista", "sanatorio", "salud")


@lru_cache(maxsize=2)
def _tables(form: str) -> tuple[str, str, dict[str, str]]:
    """(characters with one base letter, those letters, characters with several)."""
    frm, to, several = [], [], {}
    for code in range(0x80, sys.maxunicode + 1):
        c = chr(code)
        kind = unicodedata.decomposition(c)
        if not kind or 0xAC00 <= code <= 0xD7A3 or (form == "NFD" and kind[0] == "<"):
            continue
        base = "".join(x for x in unicodedata.normalize(form, c) if unicodedata.category(x)[0] != "M")
        if len(base) == 1 and base != c and code < 0x10000:
            frm.append(c)
            to.append(base)
        elif base != c and unicodedata.category(c)[0] != "M":
            several[c] = base
    return "".join(frm), "".join(to), several


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once, however often it is used: written out, nested uses multiply."""
    return F.transform(F.array(value), lambda v: use(v))[0]


def _fold(c: Column, form: str, marks: str) -> Column:
    frm, to, several = _tables(form)
    short = lambda x: F.regexp_replace(F.translate(x, frm, to), marks, "")
    if not several:
        return short(c)
    table = F.from_json(F.lit(json.dumps(several, ensure_ascii=False)), "map<string,string>")
    rare = lambda x: F.char_length(F.translate(x, "".join(several), "")) != F.char_length(x)
    spelled = lambda x: F.array_join(F.transform(F.split(x, ""), lambda y: F.coalesce(F.try_element_at(table, y), y)), "")
    return let(c, lambda v: short(F.when(rare(v), spelled(v)).otherwise(v)))


def fold(c: Column) -> Column:
    """NFKD without marks."""
    return _fold(c, "NFKD", r"\p{M}+")


def fold_canonical(c: Column, marks: str = r"\p{M}+") -> Column:
    """NFD without marks, or without those of a pattern."""
    return _fold(c, "NFD", marks)


@F.pandas_udf(StringType())
def fold_exact(s: pd.Series) -> pd.Series:
    strip = lambda x: "".join(c for c in unicodedata.normalize("NFKD", x) if unicodedata.category(c)[0] != "M")
    return s.map(lambda x: x if x is None or x.isascii() else strip(x))


def squeeze(c: Column) -> Column:
    """Trim and collapse white space, no-break spaces and marks of byte order included."""
    return F.regexp_replace(F.regexp_replace(c, r"(?U)[\s﻿]+", " "), "^ | $", "")


def words(c: Column) -> Column:
    """Letters and digits, other runs as one space."""
    return F.trim(F.regexp_replace(c, r"[^\p{L}\p{N}]+", " "))


def person_name(c: Column) -> Column:
    """Comparison key of a name: notes and leading honorifics go, 'surname, given' is turned round, all words stay."""
    bare = F.regexp_replace(fold(squeeze(F.regexp_replace(c, r"\([^)]*\)", " "))), HONORIFICS, "")
    parts = lambda b: F.filter(F.transform(F.split(b, ","), squeeze), lambda p: p != "")
    turned = lambda b: let(parts(b), lambda p: F.when(F.size(p) == 2, F.concat_ws(" ", F.element_at(p, 2), F.element_at(p, 1))).otherwise(b))
    return words(F.upper(let(bare, turned)))


def identity_name(c: Column) -> Column:
    return F.upper(squeeze(fold_canonical(c)))


def credential(c: Column) -> Column:
    return words(F.upper(fold(c)))


def policy_key(c: Column) -> Column:
    return words(F.lower(fold(c)))


def match_key(c: Column) -> Column:
    """Lower-case ASCII letters and digits; all else is a space."""
    return F.trim(F.regexp_replace(F.lower(fold_canonical(c, r"[\u0300-\u036F]+")), "[^a-z0-9]+", " "))


def physician_key(c: Column) -> Column:
    return match_key(F.regexp_replace(F.regexp_replace(F.trim(c), PHYSICIAN_TITLE, ""), r"\([^)]*\).*", ""))


def header_key(c: Column) -> Column:
    return F.lower(words(F.regexp_replace(fold_canonical(c), r"[\^`´¨]", "")))


def search_term(c: Column) -> Column:
    return F.lower(F.regexp_replace(fold(c), r"[\^`´¨]", ""))


def single_line(c: Column) -> Column:
    return squeeze(c)


def cell_text(c: Column) -> Column:
    """Lines of a table cell, cleaned and joined by ' | '."""
    return F.array_join(F.filter(F.transform(F.split(c, "\n"), squeeze), lambda x: x != ""), " | ")


def token_multiset(key: Column) -> Column:
    """All words of a normalised name, sorted: equal for any order of the same words."""
    return F.array_join(F.array_sort(F.filter(F.split(key, " "), lambda x: x != "")), " ")


def specialty_consistent(specialty: Column, title: Column) -> Column:
    return credentials_consistent(credential(specialty), credential(title))


def credentials_consistent(a: Column, b: Column) -> Column:
    """``specialty_consistent`` of two ``credential`` keys, for pairs of rows whose keys were worked out before."""
    return (F.length(a) >= 4) & ~a.isin(*GENERIC_CREDENTIALS) & (F.contains(a, b) | F.contains(b, a))


def medical_context(c: Column) -> Column:
    """Whether a word signals it, in the person-name key of the text: what that key drops (a leading honorific, notes in
    brackets) signals nothing."""
    return F.exists(F.split(F.lower(person_name(c)), " "), lambda t: t.isin("dr", "dra") | t.rlike("^(" + "|".join(MEDICAL_STEMS) + ")"))


def intervals(c: Column) -> Column:
    """Array of (start, end) for each valid 'H:MM a H:MM'."""
    found = F.regexp_extract_all(c, F.lit(r"\d{1,2}:\d{2}\s*a\s*\d{1,2}:\d{2}"), 0)

    def pair(x: Column) -> Column:
        part = lambda i: F.regexp_extract(x, r"(\d{1,2}):(\d{2})\s*a\s*(\d{1,2}):(\d{2})", i)
        return F.struct(F.concat_ws(":", F.lpad(part(1), 2, "0"), part(2)).alias("start"), F.concat_ws(":", F.lpad(part(3), 2, "0"), part(4)).alias("end"))

    clock = r"^([01]\d|2[0-3]):[0-5]\d$"
    return F.filter(F.transform(found, pair), lambda p: p["start"].rlike(clock) & p["end"].rlike(clock))


def code_unit_key(c: Column) -> Column:
    """A text to order by, so that texts sort by UTF-16 code units: only beyond the basic plane does that differ from the
    order of a column itself."""
    return F.hex(F.encode(c, "UTF-16BE"))


def like_escape(c: Column) -> Column:
    return F.regexp_replace(c, r"([\\%_])", r"\\$1")


def mask_names(headline: Column, names: Column) -> Column:
    """Each name of a normalised headline replaced by 'professional', longest first, whole words only; names that follow one
    another are each replaced. Names are normalised, of letters, digits and spaces."""
    ordered = F.array_sort(F.filter(names, lambda n: n != ""), lambda a, b: F.length(b) - F.length(a))
    return F.aggregate(ordered, headline, lambda acc, n: F.regexp_replace(acc, F.concat(F.lit("(^| )"), n, F.lit("(?= |$)")), F.lit("$1professional")))
