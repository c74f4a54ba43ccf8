"""URL rules by a sort-merge range join.

A rule names a host and a path prefix; it fits its host and all subdomains. The
host's labels are reversed and joined to the path, so that a rule is a prefix of
such keys and hence an interval in their order. A page is looked up once per
ending of its host that a rule could name. Rules and look-ups are cut into ranges
of keys, rules going to every range that their interval touches; each range is
sorted and swept once with a stack of the rules that are open at the moment.

Pages with equal host and path are one look-up, so no key is hot in the sweep.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from polfin.llm.common import fresh, lower_ascii, partitions

# Keys looked at to place the range borders. They balance the ranges and decide nothing else.
BORDER_SAMPLE = 4096

Rule = tuple[str, str, str]  # verdict, host, path


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path of a URL; both empty when it is NULL or has no ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    return (
        lower_ascii(F.regexp_extract(rest, r"^[^/?#]*", 0)),
        F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1),
    )


def rule_key(host: str, path: str) -> str:
    return "\x01".join(reversed(host.split("."))) + "\x00" + path


def _probe_keys(host: Column, path: Column, depth: int) -> Column:
    """One key for each ending of the host, up to the depth of the deepest rule."""
    labels = F.reverse(F.split(host, r"\."))
    upto = F.least(F.size(labels), F.lit(depth))
    return F.transform(
        F.sequence(F.lit(1), upto),
        lambda n: F.concat(F.array_join(F.slice(labels, F.lit(1), n), "\x01"), F.lit("\x00"), path),
    )


def _ranges(keys: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Look-ups and rules side by side, each with the number of its range."""
    spark = keys.sparkSession
    seen = sorted(r.key for r in keys.select("key").orderBy(F.xxhash64("key")).limit(BORDER_SAMPLE).collect())
    n = max(1, min(partitions(spark), len(seen)))
    borders = sorted({seen[i * len(seen) // n] for i in range(1, n)})

    def place(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b.assign(bucket=[bisect_right(borders, k) for k in b.key])

    schema = "host string, path string, key string, bucket int"
    lookups = keys.mapInPandas(place, schema).select(
        "bucket", "key", F.lit(2).alias("kind"), "host", "path", F.lit(None).cast("string").alias("verdict")
    )
    copies = []
    for verdict, host, path in sorted(set(rules)):
        key = rule_key(host, path)
        last = bisect_right(borders, key + "\U0010ffff")
        copies += [
            (b, key, int(verdict == "block"), host, path, verdict) for b in range(bisect_right(borders, key), last + 1)
        ]
    return lookups.unionByName(spark.createDataFrame(copies, lookups.schema))


def _sweep(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    open_rules: list[tuple[str, str, str, str]] = []
    bucket = None
    for b in batches:
        found = []
        for at, key, kind, host, path, verdict in zip(b.bucket, b.key, b.kind, b.host, b.path, b.verdict):
            if at != bucket:
                bucket, open_rules = at, []
            while open_rules and not key.startswith(open_rules[-1][0]):
                open_rules.pop()
            if kind < 2:
                open_rules.append((key, host, path, verdict))
            elif open_rules:
                _, rule_host, rule_path, rule_verdict = open_rules[-1]
                found.append((host, path, rule_host, rule_path, rule_verdict))
        yield pd.DataFrame(found, columns=["host", "path", "rule_host", "rule_path", "verdict"])


def longest_rules(addresses: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """The winning rule of each distinct (host, path) that any rule fits.

    The longest rule (host and path together) wins; of two as long, the one with the
    longer host; of two that are equal, ``block``. Hosts with control characters
    U+0000 or U+0001 fit no rule.
    """
    for _, _, path in rules:
        if path and not path.startswith("/"):
            raise ValueError(f"a rule's path is empty or starts with a slash, not {path!r}")
    depth = max(len(host.split(".")) for _, host, _ in rules)
    keys = (
        addresses.select("host", "path")
        .where((F.col("host") != "") & ~F.col("host").rlike("[\\x00\\x01]"))
        .distinct()
        .select("host", "path", F.explode(_probe_keys(F.col("host"), F.col("path"), depth)).alias("key"))
    )
    placed = _ranges(keys, rules)
    swept = (
        placed.repartition(partitions(addresses.sparkSession), "bucket")
        .sortWithinPartitions("bucket", "key", "kind")
        .mapInPandas(_sweep, "host string, path string, rule_host string, rule_path string, verdict string")
    )
    length = F.length("rule_host") + F.length("rule_path")
    best = F.max(F.struct(length, F.length("rule_host"), "rule_host", "rule_path", "verdict"))
    return (
        swept.groupBy("host", "path")
        .agg(best.alias("best"))
        .select(
            "host",
            "path",
            F.concat("best.rule_host", "best.rule_path").alias("rule"),
            F.col("best.verdict").alias("verdict"),
        )
    )


def filter_urls(pages: DataFrame, rules: Sequence[Rule], default: str = "allow", url: str = "url") -> DataFrame:
    """Every row of ``pages`` with the columns host, path, rule and verdict added.

    ``rules`` is a list kept by hand; copies of a rule go only to ranges that its
    interval touches. A row that no rule fits has a NULL rule and the ``default``
    verdict; so has one whose URL is NULL, empty or without a host. Repeated rows are
    all kept. Columns of ``pages`` with one of the four names are replaced. No rules,
    or no rows, are fine.
    """
    new = ("host", "path", "rule", "verdict")
    rest = [c for c in pages.columns if c.lower() not in new or c == url]
    address, h, p, rule_host, rule_path, found = fresh(pages.columns, "_url", "_host", "_path", "_rh", "_rp", "_best")
    host, path = url_parts(F.col(address))
    base = pages.select(*[F.col(f"`{c}`") for c in rest], F.col(f"`{url}`").alias(address)).select(
        *[f"`{c}`" for c in rest], host.alias(h), path.alias(p)
    )
    kept = [F.col(f"`{c}`") for c in rest if c.lower() not in new]
    if not rules:
        nothing = F.lit(None).cast("string").alias("rule")
        return base.select(*kept, F.col(h).alias("host"), F.col(p).alias("path"), nothing, F.lit(default).alias("verdict"))
    best = longest_rules(base.select(F.col(h).alias("host"), F.col(p).alias("path")), rules)
    best = best.select(F.col("host").alias(rule_host), F.col("path").alias(rule_path), F.struct("rule", "verdict").alias(found))
    joined = base.join(best, (F.col(h) == F.col(rule_host)) & (F.col(p) == F.col(rule_path)), "left")
    return joined.select(
        *kept,
        F.col(h).alias("host"),
        F.col(p).alias("path"),
        F.col(f"{found}.rule").alias("rule"),
        F.coalesce(f"{found}.verdict", F.lit(default)).alias("verdict"),
    )
