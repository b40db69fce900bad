"""URL filter: a trie over reversed host labels and then path segments.

A rule ``(host, path, verdict)`` fits a URL if the URL's host is the rule's host or lies
below it, and the URL's path starts with the rule's path. Among the rules that fit, the
longest (host and path together) decides; of two equally long ones that with the longer host;
of two with the same host and path, ``block``. A URL that no rule fits gets ``default``.

The trie is broadcast while there are at most ``MAX_TRIE_RULES`` rules. A longer list is
joined instead: every distinct (host, path) looks up its host suffixes and path folders, at most
labels x segments rows each, so the work stays linear in the URLs.

Defined results: a null URL or one without ``://`` has empty host and path and gets the default
unless a rule with empty host and path exists; repeated rows are judged alike; an empty
table gives an empty result; input columns named like a result column are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelpress.llm.common import lower_ascii, without

MAX_TRIE_RULES = 200_000
RESULT = ("host", "path", "rule", "verdict")

Rule = tuple[str, str, str]


def url_host(url: Column) -> Column:
    return lower_ascii(F.regexp_extract(_after_scheme(url), "^[^/?#]*", 0))


def url_path(url: Column) -> Column:
    return F.regexp_extract(_after_scheme(url), "^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + F.lit(3))).otherwise(F.lit(""))


def build_trie(rules: Sequence[Rule]) -> dict:
    """Nested dictionaries: ``hosts`` by label from the right, ``folders`` by path segment.

    A path node lists in ``tails`` the rules that end there, with what follows their last slash.
    """
    root: dict = {"hosts": {}}
    # a block entry comes last and so replaces an allow entry of the same place
    for host, path, verdict in sorted(rules, key=lambda r: r[2] == "block"):
        node = root
        for label in reversed(host.split(".")) if host else ():
            node = node["hosts"].setdefault(label, {"hosts": {}})
        if path and not path.startswith("/"):
            raise ValueError(f"the path of a rule is empty or starts with a slash: {path!r}")
        rank = (len(host) + len(path), len(host))
        if not path:
            node["any"] = (rank, host, verdict)
            continue
        at = node.setdefault("paths", {"folders": {}, "tails": {}})
        *folders, tail = path[1:].split("/")
        for folder in folders:
            at = at["folders"].setdefault(folder, {"folders": {}, "tails": {}})
        at["tails"][tail] = (rank, host + path, verdict)
    return root


def look_up(trie: dict, host: str, path: str) -> tuple[str, str] | None:
    """Rule string and verdict of the longest rule that fits."""
    best, node = None, trie
    labels = reversed(host.split(".")) if host else iter(())
    while node is not None:
        found = [node["any"]] if "any" in node else []
        at, rest = node.get("paths") if path else None, path[1:]
        while at is not None:
            found += [hit for tail, hit in at["tails"].items() if rest.startswith(tail)]
            folder, slash, rest = rest.partition("/")
            at = at["folders"].get(folder) if slash else None
        for hit in found:
            if best is None or hit[0] > best[0]:
                best = hit
        label = next(labels, None)
        node = None if label is None else node["hosts"].get(label)
    return best and best[1:]


def judge_urls(
    pages: DataFrame,
    rules: DataFrame | Sequence[Rule],
    url: str = "url",
    default: str = "allow",
    max_trie_rules: int = MAX_TRIE_RULES,
) -> DataFrame:
    """``pages`` with host, path, rule (null if none fits) and verdict."""
    spark = pages.sparkSession
    parsed = without(
        pages.withColumns({"__h": url_host(F.col(url)), "__p": url_path(F.col(url))}), *RESULT
    ).withColumnsRenamed({"__h": "host", "__p": "path"})
    if isinstance(rules, DataFrame):
        table = rules.select("host", "path", "verdict").na.fill("")
        listed = [tuple(r) for r in table.limit(max_trie_rules + 1).collect()]
    else:
        listed = list(rules)
        table = None
    if len(listed) <= max_trie_rules:
        judged = _by_trie(spark, parsed, listed)
    else:
        if table is None:
            table = spark.createDataFrame(listed, "host string, path string, verdict string")
        judged = _by_join(parsed, table)
    return judged.withColumn("verdict", F.coalesce("verdict", F.lit(default)))


def _by_trie(spark: SparkSession, parsed: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    shared = spark.sparkContext.broadcast(build_trie(rules))

    @F.pandas_udf("rule string, verdict string")
    def judge(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        trie = shared.value
        for hosts, paths in parts:
            hits = [look_up(trie, h, p) or (None, None) for h, p in zip(hosts, paths, strict=True)]
            yield pd.DataFrame(hits, columns=["rule", "verdict"], dtype=object)

    found = parsed.withColumn("__hit", judge("host", "path"))
    return found.withColumns(
        {"rule": F.col("__hit.rule"), "verdict": F.col("__hit.verdict")}
    ).drop("__hit")


def _by_join(parsed: DataFrame, rules: DataFrame) -> DataFrame:
    """The same answer from equi-joins, for rule lists of any length."""
    folder = F.regexp_extract("path", "^(.*/)?", 0)
    keyed = rules.select(
        F.col("host").alias("r_host"),
        folder.alias("r_folder"),
        F.substr("path", F.length(folder) + 1).alias("tail"),
        "verdict",
        F.concat("host", "path").alias("rule"),
    )
    labels = F.split("host", "\\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    steps = F.split("path", "/")
    folders = F.transform(
        F.sequence(F.lit(1), F.size(steps)),
        lambda i: F.when(i == 1, F.lit("")).otherwise(
            F.concat(F.array_join(F.slice(steps, F.lit(1), i - 1), "/"), F.lit("/"))
        ),
    )
    places = (
        parsed.select("host", "path").distinct()
        .select("host", "path", F.explode(F.array_union(suffixes, F.array(F.lit("")))).alias("r_host"))
        .select("host", "path", "r_host", F.explode(folders).alias("r_folder"))
    )
    best = (
        places.join(keyed, ["r_host", "r_folder"])
        .where(F.startswith("path", F.concat("r_folder", "tail")))
        .groupBy("host", "path")
        .agg(
            F.max_by(
                F.struct("rule", "verdict"),
                F.struct(F.length("rule"), F.length("r_host"), (F.col("verdict") == "block")),
            ).alias("hit")
        )
        .select("host", "path", "hit.rule", "hit.verdict")
    )
    return parsed.join(best, ["host", "path"], "left").select(
        *[F.col(f"`{c}`") for c in parsed.columns], "rule", "verdict"
    )
