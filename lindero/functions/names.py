"""Conservative relations between two normalised person names, as Catalyst expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EXACT, PARTIAL, INITIALS = "EXACT_NORMALIZED_NAME", "PARTIAL_TOKEN_SUBSET", "INITIALS_TOKEN_SUBSEQUENCE"


def flexible_match(canonical: str, observed: str) -> Column:
    """Columns of two normalised names -> struct(kind, flexibility, exact, initial), null if unrelated."""
    c, o = (f"filter(split({x}, ' '), t -> t <> '')" for x in (canonical, observed))
    dc, do = f"array_distinct({c})", f"array_distinct({o})"
    inside = lambda a, b: f"(size({a}) < size({b}) AND size(array_except({a}, {b})) = 0 AND forall({a}, t -> char_length(t) > 1))"
    partial = f"size({dc}) >= 2 AND size({do}) >= 2 AND ({inside(dc, do)} OR {inside(do, dc)})"
    # greedy walk: every observed word takes the next canonical word that it equals or abbreviates
    walk = f"""aggregate({o}, named_struct('rest', {c}, 'exact', 0, 'initial', 0, 'ok', true), (s, t) ->
      named_struct('rest', CASE WHEN exists(s.rest, x -> x = t OR (char_length(t) = 1 AND startswith(x, t)))
          THEN slice(s.rest, 1 + array_position(transform(s.rest, x -> x = t OR (char_length(t) = 1 AND startswith(x, t))), true), size(s.rest))
          ELSE s.rest END,
        'exact', s.exact + CASE WHEN element_at(filter(s.rest, x -> x = t OR (char_length(t) = 1 AND startswith(x, t))), 1) = t THEN 1 ELSE 0 END,
        'initial', s.initial + CASE WHEN element_at(filter(s.rest, x -> x = t OR (char_length(t) = 1 AND startswith(x, t))), 1) <> t THEN 1 ELSE 0 END,
        'ok', s.ok AND exists(s.rest, x -> x = t OR (char_length(t) = 1 AND startswith(x, t)))))"""
    walk = walk.replace("element_at(", "try_element_at(").replace("slice(s.rest, 1 + array_position", "slice(s.rest, 1 + CAST(array_position").replace("startswith(x, t))), true), size", "startswith(x, t))), true) AS INT), size")
    make = lambda kind, index, exact, initial: f"named_struct('kind', '{kind}', 'flexibility', {index}, 'exact', {exact}, 'initial', {initial})"
    return F.expr(f"""CASE WHEN {canonical} = '' OR {observed} = '' THEN NULL
      WHEN {canonical} = {observed} THEN {make(EXACT, 0, f"size({o})", 0)}
      WHEN {partial} THEN {make(PARTIAL, 1, f"least(size({c}), size({o}))", 0)}
      WHEN size({c}) >= 2 AND size({o}) >= 2 AND {walk}.ok AND {walk}.exact > 0 AND {walk}.initial > 0
        THEN {make(INITIALS, 2, f"{walk}.exact", f"{walk}.initial")} END""")


def blocking_keys(name: Column, canonical: bool) -> Column:
    """Keys of a name such that related names share one: the name itself, every two of its words (a part of a name has two
    words or more), and every word with the first letter of another one (with another word of one letter, if observed), as
    initials stand beside a word that is written out. So bearers of one common word alone never meet."""
    words = F.filter(F.split(name, " "), lambda t: t != "")
    several = F.array_sort(F.array_distinct(words))
    two = F.flatten(F.transform(several, lambda t, i: F.transform(F.slice(several, i + 2, F.size(several)), lambda u: F.concat(F.lit("&"), t, F.lit(" "), u))))

    def beside(t: Column, i: Column) -> Column:
        others = F.filter(F.transform(words, lambda u, j: F.struct(u.alias("u"), j.alias("j"))), lambda x: (x["j"] != i) & (F.lit(canonical) | (F.char_length(x["u"]) == 1)))
        return F.transform(others, lambda x: F.concat(F.lit("."), t, F.lit(" "), F.left(x["u"], F.lit(1))))

    return F.array_distinct(F.concat(F.array(F.concat(F.lit("="), name)), two, F.flatten(F.transform(words, beside))))


def blocked_pairs(left: DataFrame, right: DataFrame, left_id: str, left_name: str, right_id: str, right_name: str) -> DataFrame:
    """Pairs of a canonical and an observed name that share a key: every flexible relation needs one, so none is lost."""
    a = left.select(left_id, left_name, F.explode(blocking_keys(F.col(left_name), True)).alias("_t"))
    b = right.select(right_id, right_name, F.explode(blocking_keys(F.col(right_name), False)).alias("_t"))
    return a.join(b, "_t").drop("_t").distinct()


def flexible_pairs(left: DataFrame, right: DataFrame, left_id: str, left_name: str, right_id: str, right_name: str) -> DataFrame:
    pairs = blocked_pairs(left, right, left_id, left_name, right_id, right_name)
    return pairs.withColumn("match", flexible_match(left_name, right_name)).where("match IS NOT NULL")
