"""URL filters: a blocked Bloom filter of listed canonical URLs in front of an exact hash join.

Only DataFrame functions are used. Two listings are tables (key, verdict): `rules`, which are reported, and `listed`
canonical URLs, which only decide where no rule fits. A key is `host/path`, and it fits a URL if the URL's host is the
key's host or a subdomain of it and the URL's path starts with the key's path. Every URL is turned
into its candidate keys (each host suffix with each path prefix of a length that the listing has). The Bloom filter (`bloom.py`), a table
of bounded size, drops most of them; the rest meet the listing in an exact hash join, which removes false positives.

Defined cases: a null URL, or one without `://`, has an empty host and path and fits nothing; an empty listing fits
nothing; of the keys that fit, the longest wins, among equally long ones the one with the longer host, then `block`;
a key listed twice with both verdicts blocks. Rules and URLs may be of any length. Repeated rows and extra columns stay as
they are, except that columns named host, path, rule or verdict are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillgraph.llm import bloom

#: A listing of at most so many rows is broadcast; a longer one is joined by a salted shuffle.
BROADCAST_ROWS, SALTS = 200_000, 16

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end; A-Z in lower case; empty if there is none."""
    return F.translate(F.coalesce(F.regexp_extract(url, "://([^/?#]*)([^?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def url_path(url: Column) -> Column:
    """From the host's end up to `?`, `#` or the end."""
    return F.coalesce(F.regexp_extract(url, "://([^/?#]*)([^?#]*)", 2), F.lit(""))


def candidate_keys(host: Column, path: Column, path_lengths: list[int]) -> Column:
    """Each suffix of host at a dot, with each prefix of path whose length the listing has."""
    labels = F.split(host, "\\.")
    hosts = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    known = F.split(F.lit(",".join(map(str, path_lengths))), ",").cast("array<int>")
    lengths = F.filter(known, lambda n: n <= F.char_length(path))
    return F.array_distinct(F.flatten(F.transform(hosts, lambda h: F.transform(lengths, lambda n: F.concat(h, F.substring(path, F.lit(1), n))))))


def filter_urls(pages: DataFrame, rules: DataFrame, listed: DataFrame, default: str = "allow", url: str = "url") -> DataFrame:
    """pages with host, path, rule (the rule that won, or null) and verdict (the rule's, else the listed URL's, else `default`).

    rules, listed: (key string, verdict string `allow` or `block`). The distinct URLs are judged once and joined back,
    so a URL that a third of all rows repeat is looked up once; that join has no aggregate above it, so Spark may
    split it.
    """
    both = rules.select("key", "verdict", F.lit(True).alias("is_rule")).unionByName(listed.select("key", "verdict", F.lit(False).alias("is_rule")))
    keys = both.filter(F.col("key").contains("/")).groupBy("key", "is_rule").agg(F.max("verdict").alias("listed")).withColumn("cut", F.instr("key", "/"))
    stats = keys.agg(F.count("*").alias("n"), F.collect_set(F.char_length("key") - F.col("cut") + 1).alias("lengths")).first()
    n_keys, lengths = stats["n"], sorted(stats["lengths"])
    names = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    whole = pages.select(F.struct(*names).alias("row"), F.col(url).alias("url"))
    answers = [url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path")]
    if not n_keys:
        return whole.select("row.*", *answers, F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    n_blocks = bloom.size_for(n_keys)
    urls = pages.select(F.col(url).alias("_url")).filter("_url is not null").distinct()
    cands = urls.select("_url", F.explode(candidate_keys(url_host(F.col("_url")), url_path(F.col("_url")), lengths)).alias("key"))
    hits = bloom.asked(cands, bloom.build(keys, n_blocks), n_blocks, admitted=True)
    if n_keys <= BROADCAST_ROWS:
        exact = hits.join(F.broadcast(keys), "key")
    else:
        salted = keys.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        exact = hits.withColumn("salt", F.pmod(F.xxhash64("_url"), F.lit(SALTS)).cast("int")).join(salted, ["key", "salt"])
    longest = lambda wanted: F.max(F.when(F.col("is_rule") == wanted, F.struct(F.char_length("key").alias("n"), F.col("cut"), F.col("listed"), F.col("key"))))
    judged = exact.groupBy("_url").agg(longest(True).alias("rule_"), longest(False).alias("url_"))
    joined = whole.join(judged, whole["url"] == judged["_url"], "left")
    verdict = F.coalesce("rule_.listed", "url_.listed", F.lit(default))
    return joined.select("row.*", *answers, F.col("rule_.key").alias("rule"), verdict.alias("verdict"))
