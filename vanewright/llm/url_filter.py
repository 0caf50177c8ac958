"""URL lists: a blocked Bloom filter before an exact join, with DataFrame functions only.

The filter is a table of blocks of 8 words of 32 bits.  A canonical URL hashes to one
block and sets one bit in each word of it, so it is tested with one row.  The table has
``bits`` bits per listed URL; it is broadcast if its size, known from its number of
blocks, is small, and joined by block otherwise.  URLs that pass go to an exact join
with the listed URLs, which removes the false positives; the others are not shuffled.

Host rules come before the list.  A rule is ``host/path``: it fits the host and its
subdomains where the path starts with its path, and the longest that fits decides.

Defined results: a URL that is null or has no ``://`` has an empty host and path and is
allowed; repeated pages and listed URLs change nothing; null ids are carried; other
columns are ignored; an empty list allows all.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vanewright.llm.tables import BROADCAST_BYTES, held

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)(\??[^#]*)"

# Rules of the registered query.
RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, PARTS, 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def canonical(url: Column) -> Column:
    """Host without a leading ``www.``, path without slashes at its end, sorted parameters
    without tracking ones.  Scheme and fragment do not count.  Null without a host."""
    host = F.regexp_replace(host_of(url), r"^www\.", "")
    path = F.regexp_replace(path_of(url), "/+$", "")
    given = F.split(F.substring(F.regexp_extract(url, PARTS, 3), 2, 1 << 30), "&")
    query = F.array_join(F.array_sort(F.filter(given, lambda p: (p != "") & ~p.rlike("^(utm_[a-z]+|ref)="))), "&")
    return F.when(host != "", F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise("")))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, or null."""
    out = F.lit(None).cast("string")
    for rule, _ in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        name, _, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + rest)
        out = F.when(fits, F.lit(rule)).otherwise(out)
    return out


def _block(url: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(url), F.lit(blocks))


def _bits(url: Column) -> list[Column]:
    """For each of the eight words its bit: five bits of a second hash each."""
    other = F.xxhash64(F.lit(1), url)
    place = [F.shiftright(other, 5 * i).bitwiseAND(F.lit(31)).cast("int") for i in range(8)]
    return [F.call_function("shiftleft", F.lit(1).cast("long"), p) for p in place]


def bloom(listed: DataFrame, blocks: int, url: str = "canonical") -> DataFrame:
    """(block, w0 .. w7): a row for each block that has a bit."""
    rows = listed.select(_block(F.col(url), blocks).alias("block"),
                         *[b.alias(f"w{i}") for i, b in enumerate(_bits(F.col(url)))])
    return rows.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(8)])


def judge_urls(pages: DataFrame, listed: DataFrame, rules=RULES, bits: int = 16, id_col: str = "page_id",
               url: str = "url", listed_url: str = "url") -> DataFrame:
    """(id_col, host, path, rule, verdict) for every row: the rule's verdict, or block if the
    canonical URL is listed, else allow."""
    known = held(listed.select(canonical(F.col(listed_url)).alias("canonical")).where("canonical is not null").distinct())
    blocks = max(1, -(-known.count() * bits // 256))
    table = bloom(known, blocks)
    # Nine numbers of eight bytes and the row's own share.
    table = F.broadcast(table) if blocks * 96 <= BROADCAST_BYTES else table
    host, path = host_of(F.col(url)), path_of(F.col(url))
    rows = pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"),
                        canonical(F.col(url)).alias("canonical"))
    rows = rows.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    open_ = F.col("rule").isNull() & F.col("canonical").isNotNull()
    # Rows that a rule decides need no block; they get one of their own number space.
    tested = rows.withColumn("block", F.when(open_, _block(F.col("canonical"), blocks))
                             .otherwise(-1 - F.pmod(F.xxhash64("id", "host", "path"), F.lit(1 << 20))))
    tested = tested.join(table, "block", "left")
    passes = reduce(lambda a, b: a & b, [F.col(f"w{i}").bitwiseAND(b) != 0 for i, b in enumerate(_bits(F.col("canonical")))])
    tested = tested.select("id", "host", "path", "rule", "canonical", F.coalesce(open_ & passes, F.lit(False)).alias("maybe"))
    hits = tested.where("maybe").join(known.withColumn("listed", F.lit(True)), "canonical", "left")
    out = hits.select("id", "host", "path", "rule", F.coalesce("listed", F.lit(False)).alias("listed")) \
              .unionByName(tested.where("not maybe").select("id", "host", "path", "rule", F.lit(False).alias("listed")))
    by_rule = F.lit(None).cast("string")
    for rule, verdict in rules:
        by_rule = F.when(F.col("rule") == rule, F.lit(verdict)).otherwise(by_rule)
    verdict = F.coalesce(by_rule, F.when(F.col("listed"), "block").otherwise("allow"))
    return out.select(F.col("id").alias(id_col), "host", "path", "rule", verdict.alias("verdict"))
