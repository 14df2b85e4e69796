"""URL filters: a blocked Bloom filter over listed canonical URLs, then an exact hash join, in DataFrame operations.

A listed entry is a whole URL in canonical form, or a host and a path prefix, written as host/path. The latter is met
by looking up, for each URL, every suffix of its host at a dot with every prefix of its path whose length some entry has.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbwatch.sources.storage import materialize

#: Host, path, verdict. Fixed values of the query.
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
#: Hosts known for spam; consulted where no rule fits. Fixed values of the query.
SPAM_HOSTS = ("spam-farm.example.org", "cheap-pills.example.com")
WORDS = 8  # 64-bit words of a block of the filter
PROBES = 6
BITS_PER_ENTRY = 16
_EXACT = "="  # leads the key of a whole URL, and no host


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    host = F.regexp_extract(_rest(url), r"^[^/?#]*", 0)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    url = F.coalesce(url, F.lit(""))
    at = F.locate("://", url)
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def canonical(host: Column, path: Column) -> Column:
    """Host without port and trailing dots, path with single slashes and none at its end: one name for one page."""
    bare = F.regexp_replace(F.regexp_replace(host, ":[0-9]*$", ""), "[.]+$", "")
    return F.concat(bare, F.regexp_replace(F.regexp_replace(path, "/+", "/"), "/$", ""))


def mirrored_urls(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """url of the pages whose body is that of a page with a smaller id; pages without a body mirror nothing."""
    body = F.regexp_extract(F.coalesce(F.col(f"`{html}`"), F.lit("")), "(?s)<body>(.*)</body>", 1)
    named = pages.select(F.col(f"`{page_id}`").alias("page_id"), F.col(f"`{url}`").cast("string").alias("url"), body.alias("body"))
    hashed = named.where("body != ''").select("page_id", "url", F.md5("body").alias("body"))
    first = hashed.groupBy("body").agg(F.min("page_id").alias("first_id"), F.count("*").alias("n")).where("n > 1")
    return hashed.join(first.drop("n"), "body").where("page_id > first_id").select("url")


def host_suffixes(host: Column) -> Column:
    """The host and its parents: a.b.c, b.c, c."""
    labels = F.split(host, "\\.")
    return F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )


def _probe_bits(key: Column) -> list[Column]:
    """Bit positions of a key inside its block, from a second hash."""
    second = F.xxhash64(key, F.lit(7))
    return [F.pmod(F.shiftright(second, 9 * i), F.lit(64 * WORDS)) for i in range(PROBES)]


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def bloom_blocks(listed: DataFrame, key: str, blocks: int) -> DataFrame:
    """block, words: one row for each block that holds an entry; bits are joined by OR before the shuffle."""
    bits = listed.select(_block(F.col(key), blocks).alias("block"), F.explode(F.array(*_probe_bits(F.col(key)))).alias("bit"))
    word = F.floor(F.col("bit") / 64)
    mask = F.expr("shiftleft(1L, cast(bit % 64 as int))")
    per_word = [F.coalesce(F.bit_or(F.when(word == i, mask)), F.lit(0).cast("bigint")) for i in range(WORDS)]
    return bits.groupBy("block").agg(F.array(*per_word).alias("words"))


def _may_hold(words: str, key: str) -> Column:
    found = F.lit(True)
    for bit in _probe_bits(F.col(key)):
        word = F.element_at(words, (F.floor(bit / 64) + 1).cast("int"))
        found = found & _bit_set(word, bit)
    return found


def _bit_set(word: Column, bit: Column) -> Column:
    return F.getbit(word, (bit % 64).cast("int")) == 1


def judge_urls(
    pages: DataFrame,
    rules: DataFrame,
    blocked: DataFrame | None = None,
    listed: DataFrame | None = None,
    page_id: str = "page_id",
    url: str = "url",
) -> DataFrame:
    """page_id, url, host, path, rule, verdict: one row for each page.

    ``rules`` has host, path and verdict. A rule fits its host and all subdomains when the path starts with its
    path; the longest fitting rule wins. Of rules with the same host and path allow counts
    before block. Where no rule fits, entries of ``blocked`` (host, path) that fit in the same way block the
    page, and so does its URL if its ``canonical`` form is that of one in ``listed`` (url); any other page is allowed;
    ``rule`` is null there.

    Each different host and path is judged once, so a URL or host that holds a large part of the pages is one
    row in the joins, and goes back to its pages by a join that may split it. Filter blocks are sized to the
    count of entries; Spark broadcasts them and the entries only below its own limit.

    A null URL and one without ``://`` have an empty host and path and fit no entry; so do entries with a null or empty host.
    Repeated pages are judged each. Empty tables are handled; other columns are not read.
    """
    ruled = rules.select("host", "path", "verdict", F.lit(1).alias("is_rule"))
    if blocked is not None:
        ruled = ruled.union(blocked.select("host", "path", F.lit("block"), F.lit(0)))
    entries = (
        ruled.where("host is not null and host != ''")
        .groupBy("host", F.coalesce("path", F.lit("")).alias("path"))
        .agg(F.max(F.struct("is_rule", F.when(F.col("verdict") == "allow", 1).otherwise(0).alias("allows"), "verdict")).alias("top"))
        .select(
            F.concat("host", "path").alias("key"),
            F.length("path").alias("path_chars"),
            "top.verdict",
            "top.is_rule",
        )
    )
    if listed is not None:
        name = canonical(host_of(F.col("url").cast("string")), path_of(F.col("url").cast("string")))
        exact = listed.select(F.concat(F.lit(_EXACT), name).alias("key")).where(F.col("key") != _EXACT).distinct()
        entries = entries.union(exact.select("key", F.lit(None).cast("int"), F.lit("block"), F.lit(0)))
        entries = materialize(entries, "url-entries")
    shape = entries.agg(F.count("*").alias("n"), F.collect_set("path_chars").alias("lengths")).first()
    blocks = max(1, math.ceil(shape.n * BITS_PER_ENTRY / (64 * WORDS)))
    named = pages.select(F.col(f"`{page_id}`").alias("page_id"), F.col(f"`{url}`").cast("string").alias("url")).select(
        "page_id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")
    )
    different = named.where("host != ''").select("host", "path").distinct()
    lengths = F.array(*[F.lit(n) for n in sorted(shape.lengths)]) if shape.lengths else F.array().cast("array<int>")
    prefixes = F.transform(
        F.filter(lengths, lambda n: n <= F.length("path")), lambda n: F.substr(F.col("path"), F.lit(1), n)
    )
    keys = F.flatten(F.transform(host_suffixes(F.col("host")), lambda h: F.transform(prefixes, lambda p: F.concat(h, p))))
    if listed is not None:
        keys = F.concat(keys, F.array(F.concat(F.lit(_EXACT), canonical(F.col("host"), F.col("path")))))
    asked = different.select("host", "path", F.explode(F.array_distinct(keys)).alias("asked")).withColumn(
        "asked_block", _block(F.col("asked"), blocks)
    )
    passed = asked.join(bloom_blocks(entries, "key", blocks), F.col("asked_block") == F.col("block")).where(
        _may_hold("words", "asked")
    )
    fitting = passed.select("host", "path", "asked").join(entries, F.col("asked") == F.col("key"))
    best = (
        fitting.groupBy("host", "path")
        .agg(F.max(F.struct("is_rule", F.length("key").alias("chars"), "key", "verdict")).alias("best"))
        .select(
            F.col("host").alias("of_host"),
            F.col("path").alias("of_path"),
            F.when(F.col("best.is_rule") == 1, F.col("best.key")).alias("rule"),
            "best.verdict",
        )
    )
    return named.join(
        best, (F.col("host") == F.col("of_host")) & (F.col("path") == F.col("of_path")), "left"
    ).select("page_id", "url", "host", "path", "rule", F.coalesce("verdict", F.lit("allow")).alias("verdict"))


def rule_frame(spark, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    return spark.createDataFrame([tuple(r) for r in rules], "host string, path string, verdict string")


def host_frame(spark, hosts: Sequence[str] = SPAM_HOSTS) -> DataFrame:
    return spark.createDataFrame([(h, "/") for h in hosts], "host string, path string")
