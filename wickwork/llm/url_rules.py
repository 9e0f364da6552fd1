"""URL filters: the longest allow or block rule of each URL, by a sort-merge range join.

A rule names a host and the beginning of a path. It fits the URLs of that host and of all its
subdomains whose path begins so; of the rules that fit, the longest decides.

1. Keys. The canonical key of a host and path is the host's labels in reverse order, ``/`` and the path. As a host
   holds no ``/``, a rule fits exactly the keys that begin with its own, made for the rule's host: prefixes are
   intervals of keys. A URL has such a key for its host and for each of the hosts above that some rule names.
2. Ranges. Keys are sampled, and the sample's quantiles part them into ranges of about equal numbers of URLs. A key so
   frequent that it is several quantiles has as many ranges, among which its URLs are dealt by a hash. A rule goes to
   every range that its interval meets. Repeated URLs are one before this step.
3. Sweep. In a range, rules' beginnings, URLs and rules' ends are put in order of their keys. The number of rules open
   is a running sum of beginnings less ends, and the innermost open one, the top of the stack, is the last that began
   at that depth. As intervals of prefixes nest or are apart, that is the longest rule with this host.
4. The longest rule over a URL's hosts is brought back to it by host and path.

All of it is DataFrame functions. What reaches the driver is one sample of at most ``SAMPLE`` keys, each
cut to ``SPLITTER_CHARS`` characters; the number of ranges is at most ``MOST_RANGES``.

Defined cases: a null URL, or one without ``://``, has an empty host and path; an empty host is never fitted, nor is a
URL with a path that a rule's path does not begin, an empty path included. Rules without a host or verdict are left
out, a null path is empty. Of rules with one host and path, ``block`` wins. Of fitting rules of equal length the one with
the longer host wins. Repeated URLs are each judged. An empty table gives no rows; without rules the default
holds. Rules are told apart by exact text, hosts in lower case. Columns added are ``host``, ``path``, ``rule``
and ``verdict``; a page's own columns of those names are replaced.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window, functions as F

from wickwork.llm.common import cut, within_broadcast

ROWS_PER_RANGE = 1_000_000
LEAST_RANGES = 16
MOST_RANGES = 4096
SAMPLE = 65_536
SPLITTER_CHARS = 256

# Letters that are lower-cased in a host.
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_OPEN, _URL, _CLOSE = 0, 1, 2


def url_host(url: Column) -> Column:
    """What stands between the first ``://`` and ``/``, ``?``, ``#`` or the end, in lower case; empty without one."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def url_path(url: Column) -> Column:
    """From the host's end up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _labels(host: Column) -> Column:
    return F.reverse(F.split(host, r"\."))


def _key(labels: Column, path: Column) -> Column:
    """Keys are binary, so that byte 0xFF, which UTF-8 never has, ends a prefix's interval."""
    return F.concat(F.array_join(labels, "."), F.lit("/"), path).cast("binary")


def _rules(rules: DataFrame) -> DataFrame:
    rules = rules.select(F.translate("host", _UPPER, _LOWER).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict")
    rules = rules.where("host <> '' and verdict is not null").groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    labels = _labels(F.col("host"))
    return rules.select(
        _key(labels, F.col("path")).alias("key"),
        F.array_join(labels, ".").alias("rule_host"),
        F.size(labels).alias("depth"),
        F.struct(
            (F.char_length("host") + F.char_length("path")).alias("length"),
            F.char_length("host").alias("host_length"),
            F.concat("host", "path").alias("rule"),
            "verdict",
        ).alias("rule"),
    )


def _url_keys(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``host``, ``path``, ``key`` for the host and those above it that rules name."""
    hosts = rules.groupBy("rule_host").agg(F.first("depth").alias("depth"))
    deepest = hosts.agg(F.max("depth")).first()[0] or 0
    labels = _labels(F.col("host"))
    above = urls.where("host <> ''").select("host", "path", labels.alias("labels"))
    depths = F.sequence(F.lit(1), F.least(F.size("labels"), F.lit(max(deepest, 1))))
    above = above.select("host", "path", "labels", F.explode(depths).alias("depth"))
    above = above.select("host", "path", F.array_join(F.slice("labels", F.lit(1), F.col("depth")), ".").alias("rule_host"))
    above = above.join(within_broadcast(hosts.select("rule_host"), row_bytes=256), "rule_host", "left_semi")
    return above.select("host", "path", F.concat("rule_host", F.lit("/"), "path").cast("binary").alias("key"))


def _splitters(keys: DataFrame) -> list[tuple[bytes, int]]:
    """Distinct splitters in order, each with the number of ranges that begin at it. The first is the empty key."""
    # By a hash of the whole row, so a key that many URLs share has its share of the sample.
    drawn = keys.select(F.expr(f"substring(key, 1, {SPLITTER_CHARS})").alias("key"), F.xxhash64("key", "host").alias("drawn"))
    n = keys.count()
    sample = sorted(bytes(r[0]) for r in drawn.orderBy("drawn").limit(SAMPLE).select("key").collect())
    ranges = max(LEAST_RANGES, min(MOST_RANGES, -(-n // ROWS_PER_RANGE)))
    chosen: dict[bytes, int] = {b"": 1}
    for k in range(1, ranges):
        if sample:
            splitter = sample[len(sample) * k // ranges]
            chosen[splitter] = chosen.get(splitter, 0) + 1
    return sorted(chosen.items())


def _range_of(key: Column, splitters: Column, n: int) -> Column:
    """The place of the last splitter that is at most the key, by binary search."""
    steps = F.sequence(F.lit(0), F.lit(n.bit_length() - 1))
    half = F.reverse(F.transform(steps, lambda s: F.call_function("shiftleft", F.lit(1), s)))

    def step(at: Column, size: Column) -> Column:
        there = F.least(at + size, F.lit(n - 1))
        return F.when(F.get(splitters, there) <= key, there).otherwise(at)

    return F.aggregate(half, F.lit(0), step)


def _swept(events: DataFrame) -> DataFrame:
    """The URL rows with ``top``, the innermost rule open at their key in their range."""
    order = [F.col("key"), F.col("kind"), F.col("length")]
    so_far = Window.partitionBy("range").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    change = F.when(F.col("kind") == _OPEN, 1).when(F.col("kind") == _CLOSE, -1).otherwise(0)
    events = events.withColumn("depth", F.sum(change).over(so_far))
    at_depth = Window.partitionBy("range", "depth").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    began = F.when(F.col("kind") == _OPEN, F.col("rule"))
    top = F.when(F.col("depth") > 0, F.last(began, ignorenulls=True).over(at_depth))
    return events.withColumn("top", top).where(F.col("kind") == _URL)


def longest_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``host``, ``path`` (once each) and ``best``, a struct of ``rule`` and ``verdict``, of the URLs that a rule fits.

    ``urls`` has ``host`` and ``path``, ``rules`` has ``host``, ``path`` and ``verdict``.
    """
    rules = _rules(rules)
    keys = cut(_url_keys(urls.distinct(), rules))
    chosen = _splitters(keys)
    splitters = F.array(*[F.lit(bytearray(s)) for s, _ in chosen])
    parts = F.array(*[F.lit(m) for _, m in chosen])
    firsts, total = [], 0
    for _, m in chosen:
        firsts.append(F.lit(total))
        total += m
    first = F.array(*firsts)
    n = len(chosen)

    # The URLs of a range of several parts are dealt to them by a hash.
    placed = keys.withColumn("at", _range_of(F.col("key"), splitters, n))
    in_range = (F.get(first, F.col("at")) + F.pmod(F.xxhash64("host", "path"), F.get(parts, F.col("at")))).cast("int")
    no_rule = F.lit(None).cast(rules.schema["rule"].dataType)
    url_events = placed.select(
        in_range.alias("range"), "key", F.lit(_URL).alias("kind"), F.lit(0).alias("length"), "host", "path", no_rule.alias("rule")
    )
    ends = F.concat("key", F.lit(bytearray(b"\xff")))
    nothing = F.lit(None).cast("string")
    spread = rules.select("key", ends.alias("end"), "rule")
    spread = spread.withColumn("lo", _range_of(F.col("key"), splitters, n)).withColumn("hi", _range_of(F.col("end"), splitters, n))
    last = F.get(first, F.col("hi")) + F.get(parts, F.col("hi")) - 1
    spread = spread.withColumn("range", F.explode(F.sequence(F.get(first, F.col("lo")), last)))
    bounds = [
        spread.select("range", key, F.lit(kind).alias("kind"), F.col("rule.length").alias("length"), nothing.alias("host"), nothing.alias("path"), "rule")
        for key, kind in ((F.col("key"), _OPEN), (F.col("end").alias("key"), _CLOSE))
    ]
    events = url_events.unionByName(bounds[0]).unionByName(bounds[1])
    found = _swept(events).where("top is not null")
    # Longest first, then the longer host.
    return found.groupBy("host", "path").agg(F.max("top").alias("top")).select("host", "path", F.struct("top.rule", "top.verdict").alias("best"))


def judge_urls(pages: DataFrame, rules: DataFrame, *, url: str = "url", otherwise: str = "allow") -> DataFrame:
    """``pages`` with ``host``, ``path``, the ``rule`` that decides (host and path; null for none) and the ``verdict``.

    Where no rule fits, ``otherwise`` is the verdict.
    """
    given, tag = url, uuid.uuid4().hex
    address = F.col(given)
    kept = [c for c in pages.columns if c.lower() not in ("host", "path", "rule", "verdict") or c == given]
    judged = pages.select(*kept, url_host(address).alias(f"host_{tag}"), url_path(address).alias(f"path_{tag}"))
    urls = judged.select(F.col(f"host_{tag}").alias("host"), F.col(f"path_{tag}").alias("path"))
    best = longest_rules(urls, rules).select(F.col("host").alias(f"h_{tag}"), F.col("path").alias(f"p_{tag}"), F.col("best").alias(f"best_{tag}"))
    both = judged.join(best, (F.col(f"host_{tag}") == F.col(f"h_{tag}")) & (F.col(f"path_{tag}") == F.col(f"p_{tag}")), "left")
    out = [c for c in kept if c.lower() not in ("host", "path", "rule", "verdict")]
    return both.select(
        *out,
        F.col(f"host_{tag}").alias("host"),
        F.col(f"path_{tag}").alias("path"),
        F.col(f"best_{tag}")["rule"].alias("rule"),
        F.coalesce(F.col(f"best_{tag}")["verdict"], F.lit(otherwise)).alias("verdict"),
    )
