"""URL filter: host and path rules, then a Bloom filter cascade for exact list membership.

Only DataFrame functions. Level 0 encodes the listed keys; level 1 the unlisted keys of the
corpus that level 0 lets through; level 2 the listed keys that level 1 lets through; and so on
until a level lets nothing through. As the levels are built over all keys of the corpus,
walking them answers exactly for each of these keys, without joining the list.
"""

from functools import reduce

from pyspark.sql import functions as F

from tagloom.llm.common import stage

BITS_PER_KEY = 8
HASHES = 3
#: A filter up to this size is sent to the tasks as one value; larger ones are cut into shards.
MAX_FILTER_BITS = 1 << 24
WORD = 64

#: The rules (verdict, host, path) and the site names of the list.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
BLOCKED_SITES = ("ads-track", "casino-win", "cheap-pills", "free-bets", "spam-farm")

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_and_path(url):
    """(host, path) Columns of a url; both empty for null or a url without ``://``."""
    known = F.coalesce(url, F.lit(""))
    host = F.translate(F.regexp_extract(known, PARTS, 1), UPPER, LOWER)
    return host, F.regexp_extract(known, PARTS, 2)


def best_rule(host, path, rules=RULES):
    """(name, verdict) of the longest rule that fits a url, both null if none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for action, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        name = F.when(fits, F.lit(rule_host + rule_path)).otherwise(name)
        verdict = F.when(fits, F.lit(action)).otherwise(verdict)
    return name, verdict


def _positions(key, level, bits):
    return [F.pmod(F.xxhash64(key, F.lit(level), F.lit(i)), F.lit(bits)) for i in range(HASHES)]


def _has_all_bits(words, key, level, bits):
    """Whether all bits of a key are set in a level's array of 64-bit words."""
    tests = [F.getbit(F.element_at(words, (F.floor(p / WORD) + 1).cast("int")), p % WORD) == 1 for p in _positions(key, level, bits)]
    return reduce(lambda a, b: a & b, tests)


class Cascade:
    """Levels of a Bloom filter cascade; ``listed(df, key)`` adds the exact membership."""

    def __init__(self, levels, shards):
        self.levels, self.shards = levels, shards

    def listed(self, df, key, name="listed"):
        """``df`` with a boolean ``name``: whether Column name ``key`` is in the list.

        A small cascade reaches the tasks as scalar values. One beyond MAX_FILTER_BITS is cut
        by key hash into shards, and a row meets the levels of its shard by an equality join.
        """
        marked = df.withColumn("__key", F.coalesce(F.col(key), F.lit("")))
        drop = ["__key"]
        if self.shards > 1:
            marked = marked.withColumn("__shard", _shard(F.col("__key"), self.shards))
            drop.append("__shard")
        answer = F.lit(bool(self.levels) and (len(self.levels) - 1) % 2 == 0)
        for number in reversed(range(len(self.levels))):
            table, bits = self.levels[number]
            if self.shards > 1:
                word_column = f"__words{number}"
                marked = marked.join(table.select(F.col("shard").alias("__shard"), F.col("words").alias(word_column)), "__shard", "left")
                drop.append(word_column)
                words = F.col(word_column)
            else:
                words = table.select("words").scalar()
            passes = F.coalesce(_has_all_bits(words, F.col("__key"), number, bits), F.lit(False))
            answer = F.when(passes, answer).otherwise(F.lit(number % 2 == 1))
        return marked.withColumn(name, answer).drop(*drop)


def _shard(key, shards):
    return F.pmod(F.xxhash64(key, F.lit("shard")), F.lit(shards))


def _filter_table(keys, level, bits, shards):
    """One row (shard, words) for each shard: the bits of all keys as dense 64-bit words."""
    spark = keys.sparkSession
    width = -(-bits // WORD)
    set_bits = (
        keys.select(_shard(F.col("key"), shards).alias("shard"), F.explode(F.array(*_positions(F.col("key"), level, bits))).alias("p"))
        .groupBy("shard", F.floor(F.col("p") / WORD).alias("at"))
        .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("p") % WORD).cast("int"))).alias("word"))
    )
    blank = spark.range(shards * width).select(F.pmod("id", F.lit(shards)).alias("shard"), F.floor(F.col("id") / shards).alias("at"), F.lit(0).cast("long").alias("word"))
    dense = set_bits.unionByName(blank).groupBy("shard", "at").agg(F.bit_or("word").alias("word"))
    rows = dense.groupBy("shard").agg(F.sort_array(F.collect_list(F.struct("at", "word"))).alias("cells"))
    return stage(rows.select("shard", F.transform("cells", lambda c: c["word"]).alias("words")), "cascade-level")


def _passing(keys, table, level, bits, shards):
    """The keys that one level lets through."""
    if shards > 1:
        rows = keys.withColumn("shard", _shard(F.col("key"), shards)).join(table, "shard")
        return rows.filter(_has_all_bits(F.col("words"), F.col("key"), level, bits)).select("key")
    return keys.filter(_has_all_bits(table.select("words").scalar(), F.col("key"), level, bits))


def build_cascade(keys, max_bits=MAX_FILTER_BITS):
    """Cascade over ``keys`` (key string, listed boolean), one row for each key of the corpus.

    No listed key: no level, and nothing is listed. Nulls are taken as the empty key. A key
    given more than once counts as listed if any of its rows is.
    """
    universe = stage(keys.groupBy(F.coalesce("key", F.lit("")).alias("key")).agg(F.max(F.coalesce("listed", F.lit(False))).alias("listed")), "cascade-keys")
    inside, outside = universe.filter("listed").select("key"), universe.filter(~F.col("listed")).select("key")
    size = inside.count()
    shards = max(1, -(-size * BITS_PER_KEY // max_bits))
    levels = []
    while size:
        bits = max(WORD, -(-size * BITS_PER_KEY // shards))
        table = _filter_table(inside, len(levels), bits, shards)
        through = stage(_passing(outside, table, len(levels), bits, shards), "cascade-through")
        levels.append((table, bits))
        inside, outside = through, inside
        size = inside.count()
    return Cascade(levels, shards)


def site_listed(host, sites=BLOCKED_SITES):
    """Whether a label of the host is a blocked site name."""
    return F.arrays_overlap(F.split(host, r"\."), F.array(*map(F.lit, sites)))


def judge(pages, sites=BLOCKED_SITES, rules=RULES, max_bits=MAX_FILTER_BITS):
    """page_id, host, path, rule, verdict for each row of ``pages``.

    The longest fitting rule decides; without one the cascade does: a listed host is blocked,
    any other allowed. A null url has empty host and path, fits no rule and is allowed;
    repeated rows are judged each; no rows give no rows; other columns are not read.
    """
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    keys = rows.select(F.col("host").alias("key")).distinct().withColumn("listed", site_listed(F.col("key"), sites))
    judged = build_cascade(keys, max_bits).listed(rows, "host")
    name, verdict = best_rule(F.col("host"), F.col("path"), rules)
    other = F.when(F.col("listed"), F.lit("block")).otherwise(F.lit("allow"))
    return judged.select("page_id", "host", "path", name.alias("rule"), F.coalesce(verdict, other).alias("verdict"))
