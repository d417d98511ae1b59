"""URL filter: host and path rules first, then a blocked Bloom filter in front of an exact list join.

Only DataFrame functions. The filter is a table of blocks of 256 bits; a URL touches one
block, so probing is one join on the block number and four bit tests. Possible hits then
meet the list itself, which removes the false positives.

Defined results: a null url, or one without ``://``, has an empty host and path, fits no
rule and is never listed (allow). Repeated rows are judged each. Extra columns of the
input are ignored: only the named id and url columns are read. Empty tables give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortflow.llm.tables import ascii_lower, stored

BITS_PER_URL = 16
BLOCK_BITS = 256
WORDS = 4  # longs of a block
BITS_PER_WORD = 2
#: 2**18 blocks are 10 MB; a larger filter is joined by a shuffle on the block instead.
BROADCAST_BLOCKS = 1 << 18


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    return ascii_lower(F.regexp_extract(rest, "^[^/?#]*", 0)), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def canonical(host: Column, path: Column) -> Column:
    """One name for the addresses of a page: no scheme, query or fragment, no www. or m., no page ending."""
    bare = F.regexp_replace(path, r"(\.html|/)$", "")
    return F.when(host == "", None).otherwise(F.concat(F.regexp_replace(host, r"^(www|m)\.", ""), bare))


def fits(rule: Rule, host: Column, path: Column) -> Column:
    return ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)


def winning_rule(rules: Sequence[Rule], host: Column, path: Column) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits; null if none does. Of equally long ones block wins."""
    text = verdict = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.verdict == "block", r.text)):
        text = F.when(fits(rule, host, path), rule.text).otherwise(text)
        verdict = F.when(fits(rule, host, path), rule.verdict).otherwise(verdict)
    return text, verdict


def _block(url: Column, n_blocks: int) -> Column:
    return F.pmod(F.xxhash64(url), F.lit(n_blocks))


def _masks(url: Column) -> list[Column]:
    """Two bits in each of the four words of a block, from a second hash."""
    bits = F.xxhash64(url, F.lit(1))

    def one(i: int) -> Column:
        return F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(bits, 6 * i).bitwiseAND(F.lit(63)).cast("int"))

    return [one(BITS_PER_WORD * w).bitwiseOR(one(BITS_PER_WORD * w + 1)) for w in range(WORDS)]


def bloom_blocks(listed: DataFrame, url: str, n_blocks: int) -> DataFrame:
    """The filter: block number and its words. Partial aggregation sends each block once per task."""
    keyed = listed.select(_block(F.col(url), n_blocks).alias("block"), *[m.alias(f"w{i}") for i, m in enumerate(_masks(F.col(url)))])
    return keyed.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)])


def filter_urls(pages: DataFrame, rules: Sequence[Rule], listed: DataFrame, id_column: str = "page_id", url_column: str = "url") -> DataFrame:
    """Judge every row of pages. `listed` has a column `canonical` of blocked addresses.

    Returns the id, host, path, rule, verdict, canonical and listed (boolean)."""
    names = stored(listed.select("canonical").where(F.col("canonical").isNotNull()).distinct(), "listed")
    n_blocks = 1 << max(0, math.ceil(math.log2(max(1, names.count() * BITS_PER_URL / BLOCK_BITS))))
    blocks = bloom_blocks(names, "canonical", n_blocks)
    if n_blocks <= BROADCAST_BLOCKS:
        blocks = F.broadcast(blocks)

    host, path = host_and_path(F.col(url_column))
    parts = pages.select(F.col(id_column).alias(id_column), host.alias("host"), path.alias("path"))
    text, verdict = winning_rule(rules, F.col("host"), F.col("path"))
    judged = parts.select(
        id_column, "host", "path", text.alias("rule"), verdict.alias("by_rule"), canonical(F.col("host"), F.col("path")).alias("canonical")
    )
    # a row without an address has no block of its own: deal those out by the row instead of one null key
    probe = judged.withColumn("block", F.coalesce(_block(F.col("canonical"), n_blocks), -1 - F.pmod(F.xxhash64(id_column), F.lit(1024))))
    for i, mask in enumerate(_masks(F.col("canonical"))):
        probe = probe.withColumn(f"m{i}", mask)
    passes = F.lit(True)
    for i in range(WORDS):
        passes = passes & (F.col(f"w{i}").bitwiseAND(F.col(f"m{i}")) == F.col(f"m{i}"))
    probed = probe.join(blocks, "block", "left").withColumn("maybe", F.coalesce(passes & F.col("canonical").isNotNull(), F.lit(False)))
    # possible hits meet the list by a plain join on both sides' address: adaptive execution splits a hot address
    exact = names.select(F.col("canonical").alias("on_list"))
    hits = probed.where("maybe").join(exact, F.col("canonical") == F.col("on_list"), "left")
    misses = probed.where(~F.col("maybe")).withColumn("on_list", F.lit(None).cast("string"))
    columns = [
        F.col(id_column), F.col("host"), F.col("path"), F.col("rule"),
        F.coalesce(F.col("by_rule"), F.when(F.col("on_list").isNotNull(), "block").otherwise("allow")).alias("verdict"),
        F.col("canonical"), F.col("on_list").isNotNull().alias("listed"),
    ]
    return hits.select(*columns).unionByName(misses.select(*columns))


def claimed_twice(pages: DataFrame, url_column: str = "url") -> DataFrame:
    """Addresses that more than one row claims, counted over all rows: the list of the registered query."""
    host, path = host_and_path(F.col(url_column))
    counted = pages.select(canonical(host, path).alias("canonical")).where(F.col("canonical").isNotNull()).groupBy("canonical").count()
    return counted.where(F.col("count") > 1).select("canonical")
