"""URL filters: host and path rules, and a Bloom filter cascade that is exact over all keys of the corpus.

Built of DataFrame functions alone, from the bits of each level to the verdict of each row.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stagemart.llm.bloom import Bloom, bloom_of, bloom_size
from stagemart.llm.scratch import Scratch

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


@dataclass(frozen=True)
class Rule:
    """``verdict`` for ``host`` and its subdomains, where the path of the url starts with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """What lies between the first ``://`` and the next ``/``, ``?``, ``#`` or the end, A to Z lower-cased; else empty."""
    found = F.regexp_extract(url, r"://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, _UPPER, _UPPER.lower()), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(host: Column, path: Column, rules: list[Rule], value: str = "text") -> Column:
    """``text`` or ``verdict`` of the longest rule that fits, null where none does."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda rule: (len(rule.text), rule.text)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        found = F.when(fits, F.lit(getattr(rule, value))).otherwise(found)
    return found


@dataclass(frozen=True)
class CascadeOptions:
    """False-positive shares of the first level and of the later ones; ``max_bits`` about, for all levels of one cascade."""

    first_share: float = 1 / 32
    later_share: float = 1 / 4
    max_bits: int = 1 << 27


@dataclass
class Cascade:
    """Levels by turns of listed keys and of the unlisted ones that passed."""

    levels: list[Bloom] = field(default_factory=list)

    def contains(self, key: Column) -> Column:
        """Whether a key of the corpus is listed: the first level that it fails tells."""
        found = F.lit(len(self.levels) % 2 == 1)
        for level in range(len(self.levels) - 1, -1, -1):
            found = F.when(self.levels[level].passes(key), found).otherwise(F.lit(level % 2 == 1))
        return found


@dataclass
class Cascades:
    """A cascade for each shard of the keys, of which there are as many as keep each within its bits."""

    shards: list[Cascade]

    def shard(self, key: Column) -> Column:
        return shard_of(key, len(self.shards))

    def passed(self, frame: DataFrame, key: Column, told: Callable[[DataFrame, Column], DataFrame], scratch: Scratch) -> DataFrame:
        """``told`` of ``frame`` and a column that says whether ``key`` is listed.

        Each shard of the rows is a pass of its own, that sends the filters of one cascade to the tasks; of
        several, what comes out is written before the next one starts.
        """
        if len(self.shards) == 1:
            return told(frame, self.shards[0].contains(key))
        parts = [
            scratch.keep(told(frame.where(self.shard(key) == number), cascade.contains(key)), f"pass-{number}") for number, cascade in enumerate(self.shards)
        ]
        return reduce(DataFrame.union, parts)


def shard_of(key: Column, shards: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(-1), key), F.lit(shards))


def _levels(universe: DataFrame, scratch: Scratch, options: CascadeOptions) -> Cascade:
    cascade, level = Cascade(), 0
    own, other = universe.where("listed"), universe.where("not listed")
    count = own.count()
    while count:
        bits, hashes = bloom_size(count, options.later_share if level else options.first_share)
        built = bloom_of(own, F.col("key"), bits, hashes, level)
        built = replace(built, frame=scratch.keep(built.frame, f"level-{level}"))
        cascade.levels.append(built)
        own, other = other.where(built.passes(F.col("key"))), own
        count, level = own.count(), level + 1
    return cascade


def build_cascade(keys: DataFrame, scratch: Scratch, options: CascadeOptions = CascadeOptions()) -> Cascades:
    """The cascade over all ``keys`` (key string, listed boolean), which may repeat; a key listed once is listed.

    Level 0 holds the listed keys, level 1 the unlisted ones that pass level 0, level 2 the listed
    ones that pass level 1, and so on until none passes; so membership is exact for every key
    given. Keys are dealt by hash into as many shards as keep each one's levels within ``max_bits``, and each shard
    has levels of its own. Null keys and a null ``listed`` count as unlisted empty keys and as unlisted.
    """
    universe = keys.groupBy(F.coalesce("key", F.lit("")).alias("key")).agg(F.max(F.coalesce("listed", F.lit(False))).alias("listed"))
    universe, seen = scratch.keep_observed(universe, "keys", listed=F.count_if("listed"), others=F.count_if(~F.col("listed")))
    # later levels hold the given share of the keys before them
    first, _ = bloom_size(seen["listed"], options.first_share)
    second, _ = bloom_size(math.ceil(seen["others"] * options.first_share), options.later_share)
    shards = max(1, math.ceil((first + second) / (1 - options.later_share) / max(1, options.max_bits)))
    if shards == 1:
        return Cascades([_levels(universe, scratch, options)])
    dealt = scratch.keep(universe.withColumn("shard", shard_of(F.col("key"), shards)), "dealt", partition_by="shard")
    scratch.drop(universe)
    return Cascades([_levels(dealt.where(F.col("shard") == number), scratch, options) for number in range(shards)])


def filter_urls(
    pages: DataFrame, listed: Column, rules: list[Rule], url_column: str = "url", options: CascadeOptions = CascadeOptions(),
    output: str = "judged",
) -> DataFrame:
    """``pages`` with a struct column ``output``: host, path, rule, verdict (allow or block).

    A row's key is host and path; a key is listed when ``listed`` holds for any row with it. The
    longest rule that fits decides, else ``block`` for listed keys and ``allow`` for the others. The
    levels reach the rows as constants of about ``max_bits`` at most; a longer list takes a pass over
    the rows for each shard of its keys. Null urls, and those without
    ``://``, have the empty key. Repeated rows are judged alike, long urls whole, and an empty table gives an empty one. A column
    named ``output`` raises ValueError; other columns pass through.
    """
    if output in pages.columns:
        raise ValueError(f"there is a column {output} already")
    scratch = Scratch(pages.sparkSession, "urls")
    url = F.col(url_column)
    host, path = host_of(url), path_of(url)
    key = F.concat(host, path)
    cascades = build_cascade(pages.select(key.alias("key"), listed.alias("listed")), scratch, options)

    def told(rows: DataFrame, found: Column) -> DataFrame:
        verdict = F.coalesce(matching_rule(host, path, rules, "verdict"), F.when(found, "block").otherwise("allow"))
        judged = F.struct(host.alias("host"), path.alias("path"), matching_rule(host, path, rules).alias("rule"), verdict.alias("verdict"))
        return rows.withColumn(output, judged)

    return cascades.passed(pages, key, told, scratch)
