"""URL filters: host and path rules, and a list of canonical URLs behind a blocked Bloom filter.

Listed URLs are brought to a canonical form, and so are the ones to judge. Each listed key sets eight bits, one in
each 64-bit word of the one 512-bit block that its hash names; the blocks are made by ``bit_or`` with partial
aggregates. A key that finds all its bits set is a possible hit, all others are out without a join against the
list; possible hits go to an exact hash join, which removes the false positives. Rules (a host with its
subdomains, and a beginning of the path) are listed keys of the same filter: a URL is asked for under each of its
host's endings and each path length that a rule has.

The filter is broadcast while it has at most ``MOST_BROADCAST`` bytes, which its number of blocks decides before
it is made; a larger one is joined by block number, keys against blocks. The list is joined on the keys
themselves, by broadcast where Spark's own check of its stored size allows that; else a key that very many URLs
ask for makes large partitions, which the adaptive skew join splits. Only id and URL are read; a page's
other columns never are.

Null URLs and such without ``://`` have an empty host and path: no rule fits, they are not listed, and are
allowed. Null ids, repeated rows and ties are judged row by row. Of rules of one length that fit alike (repeated
ones), a blocking one wins. Empty tables give no rows; an empty list lists nothing. Other columns
and their names do not matter.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hiretide.llm.common import stored

#: (host, beginning of the path, verdict)
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"),
         ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
#: Parameters of a query that name where a link was, not what it leads to.
TRACKING = ("utm_[^=]*", "ref", "fbclid", "gclid")
WORDS, BITS_A_KEY = 8, 16  # one key in about two thousand others is let through
MOST_BROADCAST = 64 << 20
ALLOW, BLOCK = "allow", "block"


def _lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    """Behind the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lowered; else empty."""
    return _lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def canonical(url: Column) -> Column:
    """Host and path without scheme, ``www.``, standard ports, a last dot of the host, ``.html``, closing
    slashes and fragment; of the query what is no tracking, in order. Empty where there is no ``://``."""
    host = F.regexp_replace(F.regexp_replace(host_of(url), r"\.?(:80|:443)?$", ""), r"^www\.", "")
    path = F.regexp_replace(F.regexp_replace(path_of(url), r"(index)?\.html?$", ""), "/+$", "")
    query = F.regexp_extract(url, r"(?s)^.*?://[^?#]*\?([^#]*)", 1)
    kept = F.array_join(F.sort_array(F.filter(F.split(query, "&", -1), lambda p: (p != "") & ~p.rlike(
        rf"^({'|'.join(TRACKING)})(=|$)"))), "&")
    found = F.concat(host, path, F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise(""))
    return F.when(F.coalesce(url, F.lit("")).contains("://"), found).otherwise("")


def _hashes(key: Column) -> list[Column]:
    """Two hashes that do not follow from one another: the block comes from one, the bits from the other."""
    return [F.xxhash64(key).alias("__h1"), F.xxhash64(F.lit(1), key).alias("__h2")]


def _bit(hashed: Column, word: int) -> Column:
    """The bit of a key in one word of its block, by six bits of its hash."""
    place = F.shiftrightunsigned(hashed, 6 * word).bitwiseAND(F.lit(63)).cast("int")
    return F.call_function("shiftleft", F.lit(1).cast("long"), place)


def _block(hashed: Column, blocks: int) -> Column:
    return F.pmod(hashed, F.lit(blocks))


def bloom_blocks(keys: DataFrame, blocks: int) -> DataFrame:
    """The blocks that hold any of ``keys`` (a column ``key``): number and eight words."""
    return keys.select(*_hashes(F.col("key"))).groupBy(_block(F.col("__h1"), blocks).alias("block")).agg(*(
        F.bit_or(_bit(F.col("__h2"), i)).alias(f"w{i}") for i in range(WORDS)))


def possible_hits(asked: DataFrame, listed: DataFrame) -> DataFrame:
    """Rows of ``asked`` (any columns, and ``key``) whose key the Bloom filter of ``listed`` (``key``)
    lets through: all that are listed, and few others."""
    blocks = max(1, -(-listed.count() * BITS_A_KEY // (64 * WORDS)))
    table = bloom_blocks(listed, blocks)
    if blocks * 8 * (WORDS + 1) <= MOST_BROADCAST:
        table = F.broadcast(table)
    hashed = asked.select("*", *_hashes(F.col("key"))).withColumn("block", _block(F.col("__h1"), blocks))
    found = hashed.join(table, "block")
    for i in range(WORDS):
        found = found.filter(F.col(f"w{i}").bitwiseAND(_bit(F.col("__h2"), i)) != 0)
    return found.select(*asked.columns)


def listed_keys(listed: DataFrame, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Keys of rules and of listed URLs (a column ``url``), each once, and what they say."""
    spark = listed.sparkSession
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("key", "rule", "verdict")])
    ruled = spark.createDataFrame([(f"r:{h}{p}", h + p, v) for h, p, v in rules], schema)
    urls = listed.select(F.concat(F.lit("u:"), canonical(F.col("url"))).alias("key")).filter("key <> 'u:'")
    urls = urls.select("key", F.lit(None).cast("string").alias("rule"), F.lit(BLOCK).alias("verdict"))
    return ruled.unionByName(urls).groupBy("key").agg(
        F.max("rule").alias("rule"), F.max("verdict").alias("verdict"))


def asked_keys(urls: DataFrame, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """``row`` and each ``key`` that could be listed: the canonical URL, and the endings of the host
    with the beginnings of the path that are as long as a rule's."""
    parts = F.split("host", r"\.", -1)
    endings = F.transform(F.sequence(F.lit(1), F.size(parts)),
                          lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))
    lengths = sorted({len(p) for _, p, _ in rules})
    begun = F.array(*(F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in lengths)) \
        if lengths else F.array().cast("array<string>")
    ruled = F.flatten(F.transform(endings, lambda e: F.transform(
        F.array_compact(begun), lambda p: F.concat(F.lit("r:"), e, p))))
    return urls.filter("host <> '' OR path <> ''").select(
        "row", F.explode(F.concat(F.array(F.concat(F.lit("u:"), "canonical")), ruled)).alias("key"))


def judge_urls(df: DataFrame, listed: DataFrame, id_col: str = "page_id", url_col: str = "url",
               rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """Per row of ``df``: the id, ``host``, ``path``, the longest ``rule`` that fits, the ``verdict`` (the
    rule's; else ``block`` for URLs of ``listed``, a column ``url``), and whether it is ``listed``."""
    url = F.col(url_col)
    rows = df.select(F.col(id_col).alias("id"), host_of(url).alias("host"), path_of(url).alias("path"),
                     canonical(url).alias("canonical"), F.monotonically_increasing_id().alias("row"))
    rows = stored(rows, "urls")  # narrow, and the row numbers stay what they are
    known = stored(listed_keys(listed, rules), "listed")
    hits = possible_hits(asked_keys(rows, rules), known)
    exact = hits.join(known, "key")
    length = F.length("rule")
    said = exact.groupBy("row").agg(
        F.max(F.when(F.col("rule").isNotNull(), F.struct(
            length.alias("length"), "verdict", "rule"))).alias("said"),
        F.max(F.col("rule").isNull()).alias("is_listed"))
    found = rows.join(said, "row", "left")
    listed_one = F.coalesce("is_listed", F.lit(False))
    return found.select(
        F.col("id").alias(id_col), "host", "path", F.col("said.rule").alias("rule"),
        F.coalesce("said.verdict", F.when(listed_one, BLOCK).otherwise(ALLOW)).alias("verdict"),
        listed_one.alias("listed"))
