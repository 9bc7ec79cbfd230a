"""URL filters: host and path rules first, then logistic regression on hashed character n-grams.

The regression is fitted in plain Python on ``labelled_urls``, a small table, with whole-number weights afterwards, so
Spark and any SQL engine give the very same verdict. Scoring uses DataFrame functions only and shuffles nothing; the
weights travel as one constant array of ``BUCKETS`` numbers.

Defined cases: a null url or one without ``://`` has an empty host and path, no rule and no n-grams: the regression's
constant judges it. Rules fit the host and its subdomains; a url whose path is empty fits no rule with a path. Equal
rows are judged alike, an empty table gives an empty table, other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

BUCKETS = 2048
GRAM = 3
SCALE = 1_000_000
#: verdict, host, path
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/"))
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BAD = "discount-pills casino-royal adult-video sports-bets spam-mail ads-server casino-bonus free-money click-ads bet-online pills-shop adult-cams track-pixel hot-loans link-farm poker-bets xxx-tube cheap-meds win-prizes".split()
_GOOD = "lighthouse museum timetable weather-news thermal city-library open-source garden theatre school-board river-guide northern together recipes stations history orchard maps health-advice".split()


def labelled_urls(without: int = -1, only: int = -1) -> list[tuple[str, str, int]]:
    """(host, path, 1 to block): each host with three subdomains and endings, each path with both labels. ``without`` leaves a
    pair of words out, ``only`` keeps to one, so that accuracy can be told on words that did not train."""
    out = []
    for k, pair in enumerate(zip(_BAD, _GOOD)):
        if k == without or (only >= 0 and k != only):
            continue
        for label, word in ((1, pair[0]), (0, pair[1])):
            for sub, end, path in (("", "com", f"/en/{k * 731 + 40}/"), ("www.", "net", f"/fr/{k * 977 + 11}.html"), ("blog.", "org", f"/de/{k * 389 + 7}"), ("m.", "net", f"/es/{k * 211 + 3}")):
                out.append((f"{sub}{word}.example.{end}", path, label))
    return out


def grams(host: str, path: str) -> list[int]:
    codes = [ord(c) for c in f"^{host}{path}$"]
    return [(a * 961 + b * 31 + c) % BUCKETS for a, b, c in zip(codes, codes[1:], codes[2:])]


def verdict(weights: tuple[int, ...], bias: int, host: str, path: str) -> int:
    """The regression's verdict in plain Python: 1 to block."""
    g = grams(host, path)
    return int((sum(weights[i] for i in g) + bias * len(g) if g else bias) > 0)


@lru_cache(maxsize=32)
def fit(rounds: int = 250, rate: float = 4.0, decay: float = 1e-4, without: int = -1) -> tuple[tuple[int, ...], int]:
    """(weights, constant), in millionths. Features are the shares of the n-grams, which add up to one, so a constant would add
    nothing to the weights: it is 0, as befits a table with as many labels of either kind."""
    rows = [(grams(h, p), y) for h, p, y in labelled_urls(without)]
    w = [0.0] * BUCKETS
    for _ in range(rounds):
        step = [0.0] * BUCKETS
        for g, y in rows:
            z = sum(w[i] for i in g) / len(g)
            d = y - 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))
            for i in g:
                step[i] += d / len(g)
        w = [x + rate * 20 * s / len(rows) - rate * decay * x for x, s in zip(w, step)]
    return tuple(round(x * SCALE) for x in w), 0


def split(url: Column) -> tuple[Column, Column]:
    rest = F.when(F.instr(url, "://") > 0, url.substr(F.instr(url, "://") + 3, F.length(url)))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit("")), F.coalesce(path, F.lit(""))


def fits(host: str, path: str) -> Column:
    h = F.col("host")
    return ((h == host) | h.endswith("." + host)) & F.col("path").startswith(path)


def judge(pages: DataFrame, rules=RULES) -> DataFrame:
    weights, bias = fit()
    host, path = split(F.col("url"))
    d = pages.select(F.col("page_id").alias("page_id"), F.col("url").cast("string").alias("url")).select("page_id", host.alias("host"), path.alias("path"))
    longest = sorted(rules, key=lambda r: -len(r[1] + r[2]))
    pick = lambda f: F.coalesce(*[F.when(fits(r[1], r[2]), F.lit(f(r))) for r in longest])
    codes = F.transform(F.split(F.concat(F.lit("^"), "host", "path", F.lit("$")), ""), lambda c: F.ascii(c))
    d = d.select("page_id", "host", "path", pick(lambda r: r[1] + r[2]).alias("rule"), pick(lambda r: r[0]).alias("_by_rule"), codes.alias("_c"))
    d = d.withColumn("_w", F.lit(list(weights)))
    score = F.expr(f"CASE WHEN size(_c) < {GRAM} THEN {bias}L ELSE aggregate(sequence(0, size(_c) - {GRAM}), 0L, (s, i) -> s + _w[(_c[i] * 961 + _c[i + 1] * 31 + _c[i + 2]) % {BUCKETS}]) + {bias}L * (size(_c) - {GRAM - 1}) END")
    verdict = F.when(F.col("_by_rule").isNotNull(), F.col("_by_rule")).when(score > 0, "block").otherwise("allow")
    return d.select("page_id", "host", "path", "rule", verdict.alias("verdict"))


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"))


def oracle() -> str:
    weights, bias = fit()
    longest = sorted(RULES, key=lambda r: -len(r[1] + r[2]))
    when = lambda f: "CASE " + " ".join(f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{f((v, h, p))}'" for v, h, p in longest) + " END"
    return f"""
WITH u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
h AS (SELECT page_id, coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1), '{UPPER}', '{LOWER}'), '') AS host,
             coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM u),
c AS (SELECT page_id, host, path, list_transform(string_split('^' || host || path || '$', ''), lambda c: unicode(c)) AS c, {list(weights)} AS w FROM h),
s AS (SELECT *, list_sum(list_transform(range(1, len(c) - 1), lambda i: w[(c[i] * 961 + c[i+1] * 31 + c[i+2]) % {BUCKETS} + 1])) + {bias} * (len(c) - 2) AS y, CASE WHEN len(c) < {GRAM} THEN {bias} ELSE y END AS z FROM c)
SELECT page_id, host, path, {when(lambda r: r[1] + r[2])} AS rule,
       coalesce({when(lambda r: r[0])}, CASE WHEN z > 0 THEN 'block' ELSE 'allow' END) AS verdict FROM s"""
