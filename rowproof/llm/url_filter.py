"""URL filters: host and path rules, and a blocked Bloom filter in front of an exact join.

The filter is a table: one row per block of 512 bits, keyed by block number. Probing it is an
equi-join on the block and a test of the bits, so a filter of any size works: the planner
broadcasts it when it is small and shuffles it otherwise. URLs whose bits are all set are
looked up in the list itself by an exact hash join, which removes the false positives.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowproof.llm.text import ascii_lower
from rowproof.session import settle

WORDS = 8  # 64-bit words in a block
PROBES = 6  # bits set by each key
KEYS_PER_BLOCK = 32  # 16 bits a key

#: (verdict, host, path) of the rules in force.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(host: Column, path: Column) -> Column:
    """One name for all spellings of an address: no user, port, ``www.``, or closing slashes.

    Scheme, query and fragment are left out; null where there is no host.
    """
    bare = F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r":[0-9]*$", "")
    bare = F.regexp_replace(F.regexp_replace(bare, r"\.+$", ""), r"^www\.", "")
    return F.when(bare != "", F.concat(bare, F.regexp_replace(path, r"/+$", "")))


def rule_for(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """The longest rule that fits, as (rule, verdict); null if none does."""
    by_length = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1], r[2]))
    fitting = [
        F.when(
            ((host == h) | host.endswith("." + h)) & path.startswith(p),
            F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict")),
        )
        for verdict, h, p in by_length
    ]
    return F.coalesce(*fitting)


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def _bits(key: Column) -> list[Column]:
    """Places of a key's bits in its block."""
    second = F.xxhash64(key, F.lit(1))
    step = F.shiftrightunsigned(second, 32).bitwiseOR(F.lit(1))
    return [(second + step * k).bitwiseAND(F.lit(WORDS * 64 - 1)).cast("int") for k in range(PROBES)]


def _bit(place: Column) -> Column:
    # A shift by a column has no function of its own.
    return F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(F.lit(63)))


def build_filter(keys: DataFrame, blocks: int) -> DataFrame:
    """The blocks that hold at least one of the distinct ``key`` values."""
    places = _bits(F.col("key"))
    words = []
    for w in range(WORDS):
        own = F.lit(0).cast("long")
        for place in places:
            inside = F.shiftright(place, 6) == w
            own = own.bitwiseOR(F.when(inside, _bit(place)).otherwise(F.lit(0).cast("long")))
        words.append(F.bit_or(own).alias(f"w{w}"))
    bits = keys.groupBy(_block(F.col("key"), blocks).alias("block")).agg(*words)
    return bits.select("block", F.array(*[f"w{w}" for w in range(WORDS)]).alias("words"))


def may_hold(words: Column, key: Column) -> Column:
    """Whether all bits of the key are set in its block."""
    test = F.lit(True)
    for place in _bits(key):
        word = F.element_at(words, F.shiftright(place, 6) + 1)
        test &= word.bitwiseAND(_bit(place)) != 0
    return F.coalesce(test, F.lit(False))


def judge_urls(pages: DataFrame, listed: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """A verdict for every page: the longest fitting rule's, else block if the URL is listed.

    ``listed`` has a column ``url``. Pages and list meet in canonical form. A null URL, or one
    without ``://``, has an empty host and path and is allowed; equal URLs get equal verdicts;
    an empty list blocks nothing; other columns are not read.
    """
    url = F.col("url")
    wanted = (
        listed.select(canonical(host_of(url), path_of(url)).alias("key"))
        .filter("key IS NOT NULL").distinct()
    )
    wanted = settle(wanted, "listed")
    blocks = max(1, wanted.count() // KEYS_PER_BLOCK)
    bloom = settle(build_filter(wanted, blocks), "bloom")
    parts = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"))
    parts = parts.withColumn("_fit", rule_for(F.col("host"), F.col("path"), rules)).select(
        "page_id", "host", "path",
        F.col("_fit.rule").alias("rule"), F.col("_fit.verdict").alias("ruled"),
        F.when(F.col("_fit").isNull(), canonical(F.col("host"), F.col("path"))).alias("key"),
    )
    # Only addresses that no rule decides are looked up, each once however often it occurs.
    asked = parts.select("key").filter("key IS NOT NULL").distinct()
    possible = (
        asked.withColumn("block", _block(F.col("key"), blocks))
        .join(bloom, "block").filter(may_hold(F.col("words"), F.col("key"))).select("key")
    )
    hits = settle(possible.join(wanted, "key", "left_semi"), "hits").withColumn("hit", F.lit(True))
    # Rows without a key get one of their own, which no canonical address can equal, so that
    # they spread over all tasks.
    own = F.concat(F.lit("://"), F.coalesce(F.col("page_id").cast("string"), F.lit("")))
    judged = parts.withColumn("key", F.coalesce("key", own)).join(hits, "key", "left")
    return judged.select(
        "page_id", "host", "path", "rule",
        F.coalesce("ruled", F.when(F.col("hit"), "block").otherwise("allow")).alias("verdict"),
    )
