"""URL verdicts: host and path rules, and a tree of path templates for the rest.

Rules fit a host with all its subdomains and a path prefix; the longest wins. For the
rest each host has a tree of path segments. Segments that look like numbers, dates or
hashes are wildcards. Level by level, branches whose share of bad pages does not differ
from their siblings' are merged into the wildcard branch, so that a template is what
remains of a path. A template is rejected when its share of bad labelled pages, smoothed
towards its host's and that towards the whole, is above a bound.

A level costs one sum by branch and one join of rows with the branches that stay apart;
only rows whose branch can still split go on to the next.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.session import broadcast_if_small, stage

VARIABLE = r"^(?:[0-9]+|[0-9]+[.][a-z0-9]+|[0-9a-f-]{16,}|[0-9]{4}-[0-9]{2}(?:-[0-9]{2})?)$"
WILDCARD = "*"
#: Branches further than this from their siblings' share of bad pages stay apart.
DEVIATIONS = 2.58
#: Weight of a host's share, and of the overall share, in labelled pages.
SMOOTHING = 10.0
MAX_BAD_SHARE = 0.6


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null or where ``://`` is missing."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    low = F.translate(host, string.ascii_uppercase, string.ascii_lowercase)
    return F.coalesce(low, F.lit("")), F.coalesce(path, F.lit(""))


def apply_rules(rows: DataFrame, rules: DataFrame) -> DataFrame:
    """Adds ``rule`` and ``rule_verdict`` to rows with ``host`` and ``path``.

    ``rules`` has (host, path, verdict). Hosts are matched once each, however many rows
    they have, and equal rules keep the lesser verdict.
    """
    hosts = rows.select("host").distinct()
    labels = F.split("host", r"\.")
    parts = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels) - i + 1), "."),
    )
    named = rules.select(
        F.col("host").alias("suffix"), F.col("path").alias("prefix"), F.col("verdict").alias("says")
    )
    fits = hosts.select("host", F.explode(parts).alias("suffix")).join(named, "suffix")
    rule = F.struct(
        (-F.length(F.concat("suffix", "prefix"))).alias("size"),
        F.concat("suffix", "prefix").alias("rule"),
        F.col("prefix"),
        F.col("says"),
    )
    # As many entries as rules fit one host.
    by_host = fits.groupBy(F.col("host").alias("of")).agg(F.array_sort(F.collect_list(rule)).alias("fitting"))
    joined = rows.join(broadcast_if_small(stage(by_host, "host-rules"), 20_000), F.col("host") == F.col("of"), "left")
    first = F.get(F.filter("fitting", lambda r: F.startswith("path", r["prefix"])), F.lit(0))
    return joined.withColumns({"rule": first["rule"], "rule_verdict": first["says"]}).drop("of", "fitting")


def path_templates(rows: DataFrame) -> DataFrame:
    """Adds ``template`` to rows with ``host``, ``path`` and ``bad`` (null: no label).

    Every depth is treated alike. Below a branch with so few labels of either kind that
    no part of it could differ from the rest, all levels are wildcards at once.
    """
    segments = F.split(F.regexp_replace("path", "^/", ""), "/")
    plain = F.transform(segments, lambda s: F.when(s.rlike(VARIABLE), F.lit(WILDCARD)).otherwise(s))
    rows = rows.withColumns({"segments": plain, "template": F.lit("")})
    columns = [c for c in rows.columns if c != "segments"]
    done, level = None, 0
    while True:
        here = rows.withColumn("segment", F.get("segments", F.lit(level)))
        branches = here.groupBy("host", "template", "segment").agg(
            F.count("bad").alias("n"), F.sum(F.col("bad").cast("long")).alias("k")
        )
        branches = stage(branches, "url-counts")
        total = branches.groupBy("host", "template").agg(
            F.sum("n").alias("all_n"), F.sum("k").alias("all_k")
        )
        # The part that differs most holds all pages of one kind and no others.
        mixed = (F.col("all_k") > 0) & (F.col("all_k") < F.col("all_n"))
        splits = mixed & (F.greatest(F.col("all_k"), F.col("all_n") - F.col("all_k")) > DEVIATIONS**2)
        total = stage(total.where(splits).withColumn("open", F.lit(True)), "url-open")
        share = F.col("all_k") / F.col("all_n")
        spread = F.sqrt(share * (1 - share) / F.col("n"))
        apart = (F.col("n") > 0) & (F.abs(F.col("k") / F.col("n") - share) > DEVIATIONS * spread)
        stays = branches.join(total, ["host", "template"]).where(apart & (F.col("segment") != WILDCARD))
        stays = stage(stays.select("host", "template", "segment", F.lit(True).alias("stays")), "url-branches")
        here = here.join(broadcast_if_small(stays, 20_000), ["host", "template", "segment"], "left")
        here = here.join(broadcast_if_small(total.select("host", "template", "open"), 20_000), ["host", "template"], "left")
        rest = F.repeat(F.lit("/" + WILDCARD), F.size("segments") - level)
        step = F.concat(F.lit("/"), F.when(F.col("stays"), F.col("segment")).otherwise(WILDCARD))
        template = F.concat("template", F.when(F.col("open"), step).otherwise(rest))
        here = here.withColumn("template", template)
        here = here.withColumn("further", F.col("open").isNotNull() & (F.size("segments") > level + 1))
        here = stage(here.select(*columns, "segments", "further"), "url-level")
        ended = here.where(~F.col("further")).select(columns)
        done = ended if done is None else done.unionAll(ended)
        rows = here.where("further").drop("further")
        if rows.isEmpty():
            return done
        level += 1


def judge_urls(
    pages: DataFrame, rules: DataFrame, labels: DataFrame, page_id: str = "page_id", url: str = "url"
) -> DataFrame:
    """(page_id, host, path, rule, verdict, template, bad_share), one row per row of ``pages``.

    ``labels`` has (page_id, bad), one row per id; pages that a rule blocks or allows
    count as labelled by it. Without labels the verdict is allow. A null URL, or one
    without ``://``, has empty host and path and is judged like a host of that name.
    Repeated rows get equal verdicts; null ids have no label. Paths of any depth and length
    are judged whole. An empty table gives an empty result; other columns, whatever their names, are not read.
    """
    host, path = host_and_path(F.col(url).cast("string"))
    rows = pages.select(F.col(page_id).alias("page_id"), host.alias("host"), path.alias("path"))
    ruled = apply_rules(rows, rules)
    known = labels.select(F.col("page_id").alias("of"), F.col("bad").alias("said"))
    by_rule = F.when(F.col("rule_verdict").isNotNull(), F.col("rule_verdict") == "block")
    ruled = ruled.join(known, F.col("page_id") == F.col("of"), "left").withColumn(
        "bad", F.coalesce(by_rule, F.col("said"))
    )
    shaped = path_templates(stage(ruled.drop("of", "said"), "url-rows"))
    counts = [F.count("bad").alias("n"), F.sum(F.col("bad").cast("long")).alias("k")]
    nodes = stage(shaped.groupBy("host", "template").agg(*counts), "url-templates")
    hosts = nodes.groupBy("host").agg(F.sum("n").alias("host_n"), F.sum("k").alias("host_k"))
    whole = nodes.agg(F.sum("n").alias("n"), F.sum("k").alias("k")).first()
    prior = (whole["k"] or 0) / whole["n"] if whole["n"] else 0.0
    host_share = (F.coalesce("host_k", F.lit(0)) + SMOOTHING * prior) / (F.col("host_n") + SMOOTHING)
    # A template without labels of its own says nothing, whatever its host is like.
    bad_share = F.when(
        F.col("n") > 0, (F.col("k") + SMOOTHING * host_share) / (F.col("n") + SMOOTHING)
    ).otherwise(0.0)
    scored = nodes.join(hosts, "host").select("host", "template", bad_share.alias("bad_share"))
    by_method = F.when(F.col("bad_share") > MAX_BAD_SHARE, "block").otherwise("allow")
    return shaped.join(broadcast_if_small(stage(scored, "url-shares"), 20_000), ["host", "template"]).select(
        "page_id", "host", "path", "rule", F.coalesce("rule_verdict", by_method).alias("verdict"),
        "template", "bad_share",
    )
