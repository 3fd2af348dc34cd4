"""URL filters: host/path rules, and a listed-URL set behind a blocked Bloom filter.

Only DataFrame functions run here. A URL's canonical form is its host and path (A-Z of the host lower-cased, scheme, query, fragment and closing slashes
dropped). Every listed form sets one bit in each of the eight 64-bit words of one 512-bit block; the filter is a table of blocks, so
it grows with the list; below 32 MB (its number of blocks is counted) it is broadcast, so that only possible hits are shuffled, above that it is joined by block number. URLs whose bits are all set are possible hits, and an exact
join with the listed forms removes the false positives among them. Filter and listed forms are written before they are joined, which lets
the skew join split a URL or block that many pages share.

A rule (action, host, path) fits its host and all subdomains if the URL's path starts with the rule's; the longest fitting rule decides, else
the list does (block if listed, else allow).

Defined results: a null URL, or one without ``://``, has empty host and path, no rule and is never listed; repeated rows are judged one by one; an
empty list blocks nothing; an empty table gives no rows. Only the id and URL columns are read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.groups import reliable_checkpoint

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Fixed values of the contract: (action, host, path).
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
#: host labels whose pages make up the list of the query
LISTED_LABELS = ("spam-farm", "casino-win", "adult-x", "free-bets")
WORDS, BITS_PER_KEY = 8, 16
BLOCK_BYTES, BROADCAST_BYTES = 8 * (WORDS + 1), 32 << 20


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def canonical(host: Column, path: Column) -> Column:
    return F.concat(host, F.regexp_replace(path, r"/+$", ""))


def rule_columns(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, action) of the longest fitting rule, null without one. The rules are a short list given by the caller."""
    name, action = F.lit(None).cast("string"), F.lit(None).cast("string")
    for act, h, p in sorted(rules, key=lambda r: (len(r[1]) + len(r[2]), r[1] + r[2])):
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        name, action = F.when(fits, F.lit(h + p)).otherwise(name), F.when(fits, F.lit(act)).otherwise(action)
    return name, action


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def _bit(key: Column, word: int) -> Column:
    """The key's bit of one word: six bits of a second hash choose it."""
    at = F.shiftrightunsigned(F.xxhash64(key, F.lit("bits")), 6 * word).bitwiseAND(F.lit(63)).cast("int")
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), at)


def bloom_blocks(listed: DataFrame, key: str, count: int) -> tuple[DataFrame, int]:
    """Rows (block, w0..w7) of a filter over the distinct keys, and its number of blocks."""
    blocks = max(1, -(-count * BITS_PER_KEY // (64 * WORDS)))
    k = F.col(key)
    x = listed.groupBy(_block(k, blocks).alias("block")).agg(*[F.bit_or(_bit(k, i)).alias(f"w{i}") for i in range(WORDS)])
    return x, blocks


def filter_urls(
    pages: DataFrame, listed: DataFrame, id_col: str = "page_id", url_col: str = "url", rules: Sequence[tuple[str, str, str]] = RULES
) -> DataFrame:
    """id, host, path, rule, verdict and listed of every page. ``listed`` has a column ``url`` of canonical forms."""
    keys = reliable_checkpoint(listed.where(F.col("url").isNotNull()).select(F.col("url").alias("_key")).distinct())
    table, blocks = bloom_blocks(keys, "_key", keys.count())
    table = reliable_checkpoint(table)
    host, path = host_and_path(F.col(url_col))
    x = pages.select(F.col(id_col).alias("_id"), host.alias("host"), path.alias("path"))
    x = x.withColumn("_form", canonical(F.col("host"), F.col("path"))).withColumn("block", _block(F.col("_form"), blocks))
    x = x.join(F.broadcast(table) if blocks * BLOCK_BYTES <= BROADCAST_BYTES else table, "block", "left")
    every = F.lit(True)
    for i in range(WORDS):
        bit = _bit(F.col("_form"), i)
        every = every & (F.coalesce(F.col(f"w{i}"), F.lit(0).cast("bigint")).bitwiseAND(bit) == bit)
    x = x.select("_id", "host", "path", "_form", every.alias("_maybe"))
    hits = x.where("_maybe").join(keys.withColumn("_listed", F.lit(True)), F.col("_form") == F.col("_key"), "left").drop("_key")
    x = hits.union(x.where("NOT _maybe").withColumn("_listed", F.lit(None).cast("boolean")))
    rule, action = rule_columns(F.col("host"), F.col("path"), rules)
    on_list = F.coalesce("_listed", F.lit(False))
    verdict = F.coalesce(action, F.when(on_list, "block").otherwise("allow"))
    return x.select(F.col("_id").alias(id_col), "host", "path", rule.alias("rule"), verdict.alias("verdict"), on_list.alias("listed"))


def urls_on_hosts(pages: DataFrame, labels: Sequence[str], url_col: str = "url") -> DataFrame:
    """Canonical forms of the pages on hosts with one of the given labels: a list drawn from a crawl."""
    host, path = host_and_path(F.col(url_col))
    x = pages.select(host.alias("host"), canonical(host, path).alias("url"))
    return x.where(F.arrays_overlap(F.split("host", r"\."), F.array(*[F.lit(s) for s in labels]))).select("url")
