"""Names of professionals in headlines: a table of names, and joins of word sequences with it, all DataFrame operations.

A mention is a whole name as a run of words (the longest at each place), a pair of first and later word that only one
name has, initials with stops and a whole word, or what follows an honorific as far as some name agrees. It carries
no professional's id: what it links with is a hypothesis for later.

Headlines: a key column and a text. Words are runs of letters and digits; offsets come from the lengths of what lies
between them, so no row leaves the JVM. Names meet headlines by equal words (a whole name, a pair, an initial and a
word), never all against all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.names import flexible_match
from ..functions.text import fold, person_name

# Limits, and the pattern of a name after an honorific.
LEAST_WORDS, MOST_WORDS, MOST_INITIALS, FAN_OUT = 2, 10, 5, 25
HONORIFIC = (
    r"\b(?:[Dd]r(?:a)?|[Dd]octor(?:a)?)\.?\s+((?:\p{Lu}\.|(?:\p{Lu}[\p{L}\p{M}'’.-]{1,}))(?:\s+(?:(?:de|del|la|las|los|y)\s+)?(?:\p{Lu}\.|(?:\p{Lu}[\p{L}\p{M}'’.-]{1,}))){1,4})"
)
WORD = r"[\p{L}\p{N}]+"


def name_index(names: DataFrame, name: str) -> DataFrame:
    """Distinct usable names: normalized, words, n. Usable: two to ten words, each of two letters or more and no number."""
    words = F.filter(F.split(person_name(F.col(name)), " "), lambda w: w != "")
    usable = F.size("words").between(LEAST_WORDS, MOST_WORDS) & F.forall("words", lambda w: (F.char_length(w) >= 2) & ~w.rlike(r"^\d+$"))
    return names.select(words.alias("words")).where(usable).distinct().select(F.array_join("words", " ").alias("normalized"), "words", F.size("words").alias("n"))


def unique_aliases(index: DataFrame) -> DataFrame:
    """First and a later word of names of three words or more, where only one name has the pair."""
    later = F.explode(F.array_distinct(F.slice("words", 2, F.size("words")))).alias("later")
    pairs = index.where("n >= 3").select("normalized", F.col("words")[0].alias("first"), later)
    pairs = pairs.groupBy(F.concat_ws(" ", "first", "later").alias("alias")).agg(F.min("normalized").alias("owner"), F.max("normalized").alias("b"))
    return pairs.where("owner = b").drop("b")


def spans(text: Column) -> Column:
    """Array of (word, start, end) of a text: the normalised word, and where it stands (code points, end exclusive)."""
    raw = F.regexp_extract_all(text, F.lit(f"({WORD})"), 1)
    led = F.regexp_extract_all(text, F.lit(rf"([^\p{{L}}\p{{N}}]*{WORD})"), 1)
    normal = lambda w: F.regexp_replace(F.upper(fold(w)), r"[^\p{L}\p{N}]+", "")
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<word:string,start:int,end:int>>").alias("out"))

    def add(acc: Column, x: Column) -> Column:
        end = acc["at"] + F.char_length(x["led"])
        one = F.struct(normal(x["raw"]).alias("word"), (end - F.char_length(x["raw"])).alias("start"), end.alias("end"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(one)).alias("out"))

    pairs = F.zip_with(raw, led, lambda a, b: F.struct(a.alias("raw"), b.alias("led")))
    return F.filter(F.aggregate(pairs, zero, add)["out"], lambda s: s["word"] != "")


def _runs(words: DataFrame, key: str, least: int, most: int) -> DataFrame:
    """(key, i, n, run, start, end) of all runs of so many words. ``words`` has the array ``spans``."""
    at = words.select(key, "text", "spans", F.posexplode("spans").alias("i", "_s"))
    at = at.withColumn("n", F.explode(F.sequence(F.lit(least), F.lit(most)))).where(F.col("i") + F.col("n") <= F.size("spans"))
    part = F.slice("spans", F.col("i") + 1, F.col("n"))
    return at.select(key, "text", "i", "n", F.transform(part, lambda s: s["word"]).alias("run"), F.col("_s.start").alias("start"), F.element_at(part, F.col("n"))["end"].alias("end"))


def _agreeing(candidates: DataFrame, index: DataFrame, ids: list[str]) -> DataFrame:
    """Candidates (``ids``, run) with the number of names that agree flexibly and begin alike: with the first word, or with its
    letter if it is one. They meet in the first letter and any word of two letters or more, which both must have."""
    names = index.select("normalized", "words", F.left(F.col("words")[0], F.lit(1)).alias("_f"), F.explode(F.array_distinct("words")).alias("_w"))
    asked = candidates.select(*ids, "run", F.left(F.col("run")[0], F.lit(1)).alias("_f"), F.explode(F.filter(F.array_distinct("run"), lambda w: F.char_length(w) >= 2)).alias("_w"))
    met = asked.join(names, ["_f", "_w"]).drop("_w").distinct()
    first = F.col("run")[0]
    met = met.where((F.char_length(first) == 1) | (first == F.col("words")[0])).withColumn("_c", F.array_join("run", " "))
    met = met.where(flexible_match("normalized", "_c").isNotNull())
    return met.groupBy(*ids).agg(F.count(F.lit(1)).alias("names"))


def mentions(headlines: DataFrame, key: str, text: str, index: DataFrame) -> DataFrame:
    """(key, start, end, value, normalized) of all mentions, each normalised form once, where it stands first."""
    words = headlines.select(key, F.col(text).alias("text"), spans(F.col(text)).alias("spans")).where("text IS NOT NULL")
    runs = _runs(words, key, LEAST_WORDS, MOST_WORDS).withColumn("normal", F.array_join("run", " "))
    whole = runs.join(index.select(F.col("normalized").alias("normal")), "normal")
    longest = Window.partitionBy(key, "i").orderBy(F.col("n").desc())
    whole = whole.withColumn("_r", F.rank().over(longest)).where("_r = 1").select(key, "text", "start", "end", F.lit(0).alias("source"))

    pairs = runs.where("n = 2").join(unique_aliases(index).select(F.col("alias").alias("normal")), "normal").select(key, "text", "start", "end")
    taken = whole.select(key, F.col("start").alias("_a"), F.col("end").alias("_b"))
    pairs = pairs.join(taken, (pairs[key] == taken[key]) & (F.col("start") < F.col("_b")) & (F.col("_a") < F.col("end")), "left_anti").withColumn("source", F.lit(1))

    first, last = F.col("run")[0], F.element_at("run", -1)
    dotted = F.contains(F.col("_between"), F.lit("."))
    begun = words.select(key, "text", F.posexplode("spans").alias("i", "_s"), "spans").where((F.char_length("_s.word") == 1) & (F.col("i") + 1 < F.size("spans")))
    begun = begun.withColumn("_between", F.col("text").substr(F.col("_s.end") + 1, F.get("spans", F.col("i") + 1)["start"] - F.col("_s.end"))).where(dotted).select(key, "i")
    letters = _runs(words, key, LEAST_WORDS, MOST_INITIALS).where((F.char_length(first) == 1) & (F.char_length(last) >= 2)).join(begun, [key, "i"])
    few = _agreeing(letters, index, [key, "i", "n"]).where(F.col("names") <= FAN_OUT).groupBy(key, "i").agg(F.max("n").alias("n"))
    letters = letters.join(few, [key, "i", "n"]).select(key, "text", "start", "end", F.lit(2).alias("source"))

    found = F.posexplode(F.arrays_zip(F.regexp_extract_all("text", F.lit(HONORIFIC), 0).alias("all"), F.regexp_extract_all("text", F.lit(HONORIFIC), 1).alias("name"))).alias("k", "_h")
    titled = words.select(key, "text", found).withColumn("_at", F.instr("text", F.col("_h.all")) - 1 + F.char_length("_h.all") - F.char_length("_h.name"))
    titled = titled.withColumn("spans", spans(F.col("_h.name"))).where(F.size("spans") >= 2)
    titled = titled.withColumn("n", F.explode(F.sequence(F.lit(2), F.size("spans")))).withColumn("run", F.transform(F.slice("spans", 1, F.col("n")), lambda s: s["word"]))
    agree = _agreeing(titled, index, [key, "k", "n"]).join(titled.select(key, "k", "n", F.col("run")[0].alias("_w")), [key, "k", "n"])
    agree = agree.where((F.char_length("_w") > 1) | (F.col("names") <= FAN_OUT)).groupBy(key, "k").agg(F.max("n").alias("n"))
    titled = titled.join(agree, [key, "k", "n"]).select(key, "text", F.col("_at").alias("start"), (F.col("_at") + F.element_at("spans", F.col("n"))["end"]).alias("end"), F.lit(3).alias("source"))

    every = whole.unionByName(pairs).unionByName(letters).unionByName(titled)
    every = every.withColumn("value", F.trim(F.col("text").substr(F.col("start") + 1, F.col("end") - F.col("start"))))
    every = every.withColumn("normalized", person_name(F.col("value"))).where(F.size(F.split("normalized", " ")) >= 2)
    best = every.groupBy(key, "normalized").agg(F.min(F.struct("start", "source", "end", "value")).alias("m"))
    return best.select(key, "m.start", "m.end", "m.value", "normalized")


def extracted_names(headlines: DataFrame, key: str, text: str, index: DataFrame) -> DataFrame:
    """Every headline with the array of its mentions as they stand, in order."""
    found = mentions(headlines, key, text, index)
    lists = found.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("start", "normalized", "value"))), lambda m: m["value"]).alias("names"))
    return headlines.join(lists, key, "left").withColumn("names", F.coalesce("names", F.array().cast("array<string>")))
