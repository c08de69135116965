"""URL filters: rules by host and path, and exact list membership by a Bloom filter cascade.

A *cascade* answers whether a key is listed without a join and without errors, because all
keys that will ever be asked for are known: the distinct hosts of the corpus.  Its first level
is a Bloom filter of the listed keys; the second one of those other keys that pass the first by
mistake; the third one of the listed keys that pass the second; and so on until no key passes
by mistake.  A key is listed if the first level that turns it away is an even one, or, where
all let it through, if their number is odd.  Later levels shrink by half each.

Bits are set by an aggregation over the keys and come back as a scalar subquery, so the answer
is an expression on each row and pages are never moved.  A cascade is kept below
``filter_bytes``: a longer list is cut into shards by a hash of the key, each with a cascade of
its own over its own part of the keys, and the pages are read once for each shard.

Defined results: a null url, or one without ``://``, has empty host and path, fits no rule and
is not listed; every row is judged, repeated or without an id; null and empty listed keys are
ignored, as are those that no page has; an empty table gives an empty one; other columns are
not read.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palimpsest.session import staged

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MAX_LEVELS = 100


@dataclass(frozen=True)
class Rule:
    """Fits the host and its subdomains where the path starts with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        own = (host == self.host) | host.endswith("." + self.host)
        return own & path.startswith(self.path)


def with_host_and_path(pages: DataFrame) -> DataFrame:
    """``page_id``, ``host`` (A-Z in lower case) and ``path`` of every url."""
    at = F.locate("://", F.coalesce("url", F.lit("")))
    rest = F.when(at > 0, F.substring("url", at + 3, F.length("url"))).otherwise("")
    rows = pages.select("page_id", rest.alias("rest"))
    host = F.regexp_extract("rest", r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(F.col("rest"), F.length(host) + 1, F.length("rest")), r"^[^?#]*", 0)
    return rows.select("page_id", F.translate(host, UPPER, LOWER).alias("host"), path.alias("path"))


@dataclass(frozen=True)
class Level:
    """A Bloom filter: one row with the bits in 64-bit words."""

    number: int
    bits: int
    hashes: int
    words: DataFrame

    def positions(self, key: Column) -> list[Column]:
        return [
            F.pmod(F.xxhash64(key, F.lit(self.number), F.lit(j)), F.lit(self.bits).cast("long"))
            for j in range(self.hashes)
        ]

    def passes(self, key: Column) -> Column:
        def is_set(position: Column) -> Column:
            word = F.col(f"level{self.number}")[(F.floor(position / 64)).cast("int")]
            return F.getbit(word, (position % 64).cast("int")) == 1

        return reduce(lambda a, b: a & b, map(is_set, self.positions(key)))


def _sized(keys: int, rate: float) -> tuple[int, int]:
    """Bits and hashes of a Bloom filter for so many keys and such a rate of errors."""
    bits = max(64, math.ceil(keys * math.log2(1 / rate) / math.log(2)))
    return math.ceil(bits / 64) * 64, max(1, round(math.log2(1 / rate)))


def _level(keys: DataFrame, number: int, count: int, rate: float) -> Level:
    bits, hashes = _sized(count, rate)
    empty = Level(number, bits, hashes, keys)
    position = F.explode(F.array(*empty.positions(F.col("key"))))
    words = (
        keys.select(position.alias("position"))
        .groupBy(F.floor(F.col("position") / 64).cast("int").alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, int(position % 64))")).alias("set"))
    )
    every = keys.sparkSession.range(bits // 64).select(F.col("id").cast("int").alias("word"))
    dense = every.join(words, "word", "left").fillna(0, ["set"])
    row = dense.agg(F.sort_array(F.collect_list(F.struct("word", "set"))).alias("t"))
    row = row.select(F.transform("t", lambda x: x["set"]).alias("bits"))
    return Level(number, bits, hashes, staged(row, "bloom-level"))


def _with_levels(rows: DataFrame, levels: Sequence[Level]) -> DataFrame:
    return rows.withColumns({f"level{x.number}": x.words.scalar() for x in levels})


def build_cascade(universe: DataFrame) -> list[Level]:
    """Levels for ``key`` and ``listed`` of all keys, each key once."""
    counts = universe.agg(F.count_if("listed"), F.count_if(~F.col("listed"))).first()
    listed, others = int(counts[0]), int(counts[1])
    levels: list[Level] = []
    members, count = universe.filter("listed").select("key"), listed
    rest = universe.filter("NOT listed").select("key")
    rate = min(0.5, max(1e-4, math.sqrt(0.5) * listed / max(others, 1)))
    while count:
        if len(levels) == MAX_LEVELS:
            raise RuntimeError("the cascade does not end; are keys both listed and not?")
        level = _level(members, len(levels) + 1, count, rate)
        levels.append(level)
        passed = _with_levels(rest, [level]).filter(level.passes(F.col("key"))).select("key")
        # What passes by mistake is the next level's, and has the present members against it.
        passed = staged(passed, "bloom-keys")
        members, rest, count, rate = passed, members, passed.count(), 0.5
    return levels


def is_listed(levels: Sequence[Level], key: Column) -> Column:
    """The cascade's answer; the rows need the columns of ``_with_levels``."""
    answer = F.lit(len(levels) % 2 == 1)
    for level in reversed(levels):
        answer = F.when(level.passes(key), answer).otherwise(level.number % 2 == 0)
    return answer


def url_filter(
    pages: DataFrame, listed: DataFrame, rules: Sequence[Rule], filter_bytes: int = 8 << 20
) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule``, ``verdict`` and ``listed`` of every page.

    ``listed`` has the blocked hosts in its column ``key``.  The longest rule that fits decides
    (the first in order of its text among equally long ones), else the list.
    """
    rows = with_host_and_path(pages)
    hosts = rows.filter("host <> ''").select(F.col("host").alias("key")).distinct()
    marks = listed.filter("key IS NOT NULL AND key <> ''").select("key").distinct()
    universe = staged(
        hosts.join(marks.withColumn("mark", F.lit(True)), "key", "left").select(
            "key", F.col("mark").isNotNull().alias("listed")
        ),
        "url-keys",
    )
    counts = universe.agg(F.count_if("listed"), F.count("*")).first()
    # Twice the first level bounds the cascade: the later ones halve.
    first = _sized(max(int(counts[0]), 1), 1e-4)[0]
    shards = max(1, math.ceil(2 * first / 8 / filter_bytes))
    shard = lambda key: F.pmod(F.xxhash64(key, F.lit("shard")), F.lit(shards))
    parts = []
    for number in range(shards):
        own, asked = universe, rows
        if shards > 1:
            own, asked = own.filter(shard("key") == number), asked.filter(shard("host") == number)
        levels = build_cascade(own)
        answer = is_listed(levels, F.col("host")) & (F.col("host") != "")
        parts.append(_with_levels(asked, levels).select("page_id", "host", "path", answer.alias("listed")))
    answered = reduce(DataFrame.unionByName, parts)
    rule, verdict = F.lit(None).cast("string"), F.when(F.col("listed"), "block").otherwise("allow")
    for one in sorted(rules, key=lambda r: (-len(r.text), r.text), reverse=True):
        fits = one.fits(F.col("host"), F.col("path"))
        rule = F.when(fits, one.text).otherwise(rule)
        verdict = F.when(fits, one.verdict).otherwise(verdict)
    return answered.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("verdict"), "listed")


def hosts_with_terms(pages: DataFrame, terms: Sequence[str]) -> DataFrame:
    """Hosts of the corpus that have one of the terms between dots and hyphens, as a list."""
    parts = F.split("host", "[.-]")
    named = F.arrays_overlap(parts, F.array(*map(F.lit, terms)))
    return with_host_and_path(pages).filter(named).select(F.col("host").alias("key")).distinct()
