"""Exact URL rule lookup with a Bloom filter cascade, without a join.

Level 1 encodes the listed keys; some unlisted keys of the corpus pass it by chance. Level 2
encodes just those; the listed keys that pass level 2 by chance are encoded by level 3, and
so on until a level lets nothing wrong through. As the levels are built against every key the
corpus holds, a walk down the levels decides membership of such a key without error.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from windrow.llm.common import ascii_lower, stored

MAX_LEVELS = 64
#: Hash functions of one level.
PROBES = 6
#: 48 bits, so that sums of hashes stay within 64.
_HASH_MASK = (1 << 48) - 1
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: str | Column) -> Column:
    """What stands between the first ``://`` and ``/``, ``?``, ``#`` or the end, in lower case."""
    return F.coalesce(ascii_lower(F.regexp_extract(url, _URL, 1)), F.lit(""))


def path_of(url: str | Column) -> Column:
    """What follows the host, up to ``?`` or ``#``."""
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


@dataclass(frozen=True)
class Level:
    """One Bloom filter: ``words`` of 64 bits and the seed of its hashes."""

    words: tuple[int, ...]
    seed: int

    @property
    def n_bits(self) -> int:
        return 64 * len(self.words)

    def positions(self, key: Column) -> list[Column]:
        """Double hashing: the bit of each probe."""
        first = F.xxhash64(F.lit(2 * self.seed), key).bitwiseAND(F.lit(_HASH_MASK))
        step = F.xxhash64(F.lit(2 * self.seed + 1), key).bitwiseAND(F.lit(_HASH_MASK))
        return [F.pmod(first + F.lit(i) * step, F.lit(self.n_bits)) for i in range(PROBES)]

    def holds(self, key: Column) -> Column:
        words = F.lit(np.array(self.words, dtype=np.int64))

        def bit(at: Column) -> Column:
            word = F.element_at(words, (F.floor(at / 64) + 1).cast("int"))
            return F.call_function("bit_get", word, (at % 64).cast("int")) == 1

        return reduce(lambda a, b: a & b, [bit(at) for at in self.positions(key)])


def _level(keys: DataFrame, n_keys: int, false_rate: float, seed: int) -> Level:
    """The filter of ``keys`` (one column ``key``); only its words come to the driver.

    A filter has about ten words of 64 bits for every 50 keys, whatever the corpus holds.
    """
    bits = -PROBES * n_keys / math.log(1 - false_rate ** (1 / PROBES))
    empty = Level(words=(0,) * max(1, math.ceil(bits / 64)), seed=seed)
    at = keys.select(F.explode(F.array(*empty.positions(F.col("key")))).alias("at"))
    word, bit = F.floor(F.col("at") / 64), (F.col("at") % 64).cast("int")
    set_bits = at.groupBy(word.alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit)).alias("bits")
    )
    words = np.zeros(len(empty.words), dtype=np.int64)
    for row in set_bits.collect():
        words[row["word"]] = row["bits"]
    return Level(words=tuple(int(w) for w in words), seed=seed)


@dataclass(frozen=True)
class Cascade:
    levels: tuple[Level, ...]

    def lists(self, key: Column) -> Column:
        """True for listed keys, false for the other keys of the universe."""
        answer = F.lit(len(self.levels) % 2 == 1)
        for depth in range(len(self.levels) - 1, -1, -1):
            answer = F.when(~self.levels[depth].holds(key), F.lit(depth % 2 == 1)).otherwise(answer)
        return answer


def build_cascade(listed: DataFrame, universe: DataFrame, seed: int = 0) -> Cascade:
    """Cascade over the distinct texts of column ``key`` in ``listed`` and ``universe``.

    The rate of level 1 is chosen so that about as many unlisted keys pass it as there are
    listed keys; so later levels stay as small as the list. An empty list gives a cascade
    that lists nothing. Null keys belong to neither side.
    """
    listed = stored(listed.select("key").dropna().distinct(), "cascade-listed")
    n_listed = listed.count()
    if n_listed == 0:
        return Cascade(())
    others = universe.select("key").dropna().distinct().join(listed, "key", "left_anti")
    others = stored(others, "cascade-universe")
    n_others = others.count()
    inside, outside, rate = listed, others, min(0.5, n_listed / max(1, n_others))
    levels: list[Level] = []
    while len(levels) < MAX_LEVELS:
        level = _level(inside, n_listed, rate, seed + len(levels))
        levels.append(level)
        wrong = stored(outside.where(level.holds(F.col("key"))), "cascade-wrong")
        n_wrong = wrong.count()
        if n_wrong == 0:
            return Cascade(tuple(levels))
        inside, outside, n_listed, rate = wrong, inside, n_wrong, 0.4
    raise RuntimeError("the cascade does not end; use another seed")


def url_keys(host: Column, path: Column, path_lengths: list[int]) -> Column:
    """Every key a rule could have for this url: host and parent domains, each with the
    path's prefix of each rule length. Longest key first, then longest host first."""
    labels = F.split(host, r"\.")
    count = F.size(labels)
    hosts = F.transform(
        F.sequence(F.lit(1), count),
        lambda i: F.array_join(F.slice(labels, i, count - i + 1), "."),
    )
    prefixes = F.filter(
        F.array(*[F.when(F.length(path) >= n, F.substring(path, 1, n)) for n in path_lengths]),
        lambda p: p.isNotNull(),
    )
    pairs = F.flatten(
        F.transform(
            hosts,
            lambda h: F.transform(
                prefixes,
                lambda p: F.struct(
                    (-F.length(h) - F.length(p)).alias("order"), (-F.length(h)).alias("host_order"),
                    F.concat(h, p).alias("key"),
                ),
            ),
        )
    )
    return F.transform(F.array_sort(pairs), lambda x: x["key"])


def judge_urls(
    pages: DataFrame, rules: DataFrame, id_column: str = "page_id", url_column: str = "url"
) -> DataFrame:
    """Verdict of every url under ``rules`` (columns host, path, action: allow or block).

    A rule fits its host and all subdomains when the url's path starts with the rule's. The
    longest fitting rule (host and path together; ties: longer host) decides; a url that no
    rule fits is not listed, and is allowed. If a host and path are listed both ways, block
    wins. Returns id, host, path, rule, verdict; one row per input row, repeated rows and null
    ids included. Null urls and urls without ``://`` have an empty host and path. No rows give
    no rows. Other columns of ``pages`` are not read, so their names cannot clash.

    The rules' distinct path lengths go into the plan (a few numbers); the filters' size
    follows the rules, not the pages. Two passes over the urls, no shuffle of them; building
    the cascade shuffles the distinct keys.
    """
    urls = pages.select(
        F.col(id_column), host_of(url_column).alias("host"), path_of(url_column).alias("path")
    )
    keyed = rules.select(
        F.concat(ascii_lower("host"), F.coalesce("path", F.lit(""))).alias("key"),
        F.length(F.coalesce("path", F.lit(""))).alias("n"), "action",
    ).where(F.col("key").isNotNull())
    lengths = sorted(row["n"] for row in keyed.select("n").distinct().collect())
    if not lengths:
        return urls.select(
            "*", F.lit(None).cast("string").alias("rule"), F.lit("allow").alias("verdict")
        )
    keys = url_keys(F.col("host"), F.col("path"), lengths)
    universe = urls.select("host", "path").distinct().select(F.explode(keys).alias("key"))
    listed = build_cascade(keyed, universe)
    blocked = build_cascade(keyed.where("action = 'block'"), keyed, seed=MAX_LEVELS)
    fits = F.filter(keys, lambda key: listed.lists(key))
    judged = urls.withColumn("rule", F.get(fits, F.lit(0)))
    verdict = F.when(blocked.lists(F.col("rule")), "block").otherwise("allow")
    return judged.withColumn("verdict", F.when(F.col("rule").isNull(), "allow").otherwise(verdict))
