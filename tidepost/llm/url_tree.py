"""URL filter by path templates, in DataFrame operations only.

The paths of a host form a tree of segments.  Level by level, a node with many children that
each hold few pages gets one wildcard child in their place.  Branches under one node whose
share of blocked pages does not differ significantly from that of all of them are merged.
What remains are templates; a template is rejected if the smoothed share of blocked among its
labelled pages is high.  Shares are smoothed towards the same path shape on all hosts, and
that towards all labelled pages.  Labels are the verdicts of the rules that fit.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidepost.session import materialize

# Segments that a template tells apart; what lies deeper is one tail.
LEVELS = 3
# A node is generalised if it has more children than this and fewer pages per child than that.
MANY_CHILDREN, FEW_PAGES = 4, 8.0
# Branches merge below this distance in standard errors.
MERGE_Z = 1.96
# Weight of the wider group in a smoothed share, and the share from which a template is rejected.
PRIOR_WEIGHT, REJECT = 4.0, 0.5
WILD, MERGED, TAIL = "*", "~", "**"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """Between the first `://` and the next `/`, `?`, `#` or the end, A-Z lower-cased; empty without `://`."""
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(url, instr(url, '://') + 3)"))
    return F.coalesce(F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """From the end of the host up to `?`, `#` or the end; empty without `://`."""
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(url, instr(url, '://') + 3)"))
    return F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule (verdict, host, path) that fits; null if none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for said, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1]) + len(r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        name, verdict = F.when(fits, F.lit(rule_host + rule_path)).otherwise(name), F.when(fits, F.lit(said)).otherwise(verdict)
    return name, verdict


def judged_by_rules(pages: DataFrame, rules: list[tuple[str, str, str]]) -> DataFrame:
    """page_id, host, path, rule, ruled (verdict of the rule)."""
    parsed = pages.select("page_id", F.col("url").cast("string").alias("url"))
    parsed = parsed.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    return parsed.withColumns({"rule": rule, "ruled": verdict})


def segments(path: Column) -> list[Column]:
    """The first LEVELS segments (null where there is none), and the tail."""
    parts = F.filter(F.split(path, "/"), lambda s: s != "")
    return [F.get(parts, F.lit(i)) for i in range(LEVELS)] + [F.when(F.size(parts) > LEVELS, F.lit(TAIL))]


def templates(judged: DataFrame) -> DataFrame:
    """host, path, template for each distinct host and path.

    Works on counts by host and path, which are combined before the shuffle; every level
    takes one count by child, one by node, and a join of the two.
    """
    nodes = judged.groupBy("host", "path").agg(
        F.count(F.lit(1)).alias("n"), F.count("ruled").alias("labelled"), F.count_if(F.col("ruled") == "block").alias("blocked")
    )
    names = [f"s{i}" for i in range(LEVELS + 1)]
    nodes = nodes.select("*", *[s.alias(n) for s, n in zip(segments(F.col("path")), names)])
    for level in range(LEVELS):
        above, own = names[:level], names[level]
        nodes = materialize(nodes, "url-nodes")
        children = nodes.filter(F.col(own).isNotNull()).groupBy("host", *above, own).agg(
            *[F.sum(c).alias(c) for c in ("n", "labelled", "blocked")]
        )
        children = materialize(children, "url-children")
        total = children.groupBy("host", *above).agg(
            F.count(F.lit(1)).alias("_children"), *[F.sum(c).alias(f"_{c}") for c in ("n", "labelled", "blocked")]
        )
        # A child that is generalised or merged gets its new name; others keep theirs.
        pooled = F.try_divide("_blocked", "_labelled")
        error = F.sqrt(F.try_divide(pooled * (1 - pooled), F.col("labelled")))
        alike = F.abs(F.try_divide("blocked", "labelled") - pooled) <= MERGE_Z * error  # null without labels
        renamed = (
            F.when((F.col("_children") > MANY_CHILDREN) & (F.col("_n") / F.col("_children") < FEW_PAGES), F.lit(WILD))
            .when((F.col("_children") > 1) & F.coalesce(alike, F.lit(True)), F.lit(MERGED))
            .otherwise(F.col(own))
        )
        same = lambda keys: reduce(lambda a, b: a & b, [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys])
        fresh = children.alias("l").join(total.alias("r"), same(["host", *above])).select(
            *[F.col(f"l.{k}") for k in ("host", *above, own)], renamed.alias("_new")
        )
        nodes = nodes.alias("l").join(fresh.alias("r"), same(["host", *above, own]), "left").select(
            *[F.col(f"l.{c}") for c in nodes.columns if c != own], F.col("r._new").alias(own)
        )
    return nodes.select("host", "path", F.concat(F.lit("/"), F.concat_ws("/", *names)).alias("template"), "labelled", "blocked")


def judge_templates(labelled: DataFrame) -> DataFrame:
    """host, template, purity (smoothed share of blocked), rejected."""
    counts = labelled.groupBy("host", "template").agg(F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked"))
    shapes = counts.groupBy("template").agg(F.sum("labelled").alias("_l"), F.sum("blocked").alias("_b"))
    overall = counts.agg(F.coalesce(F.try_divide(F.sum("blocked"), F.sum("labelled")), F.lit(0.0))).scalar()
    prior = shapes.select("template", ((F.col("_b") + PRIOR_WEIGHT * overall) / (F.col("_l") + PRIOR_WEIGHT)).alias("_prior"))
    purity = (F.col("blocked") + PRIOR_WEIGHT * F.col("_prior")) / (F.col("labelled") + PRIOR_WEIGHT)
    return counts.join(prior, "template").select("host", "template", purity.alias("purity"), (purity >= REJECT).alias("rejected"))


def filter_urls(pages: DataFrame, rules: list[tuple[str, str, str]]) -> DataFrame:
    """page_id, host, path, rule, template, purity, verdict for every row.

    A rule's verdict stands; else a rejected template blocks.  Null urls and urls without
    `://` have empty host and path and are judged like any others.  Repeated rows stay,
    other columns are ignored, an empty table gives no row.
    """
    judged = judged_by_rules(pages, rules)
    placed = materialize(templates(judged), "url-templates")
    verdicts = judge_templates(placed)
    known = placed.join(verdicts, ["host", "template"]).select("host", "path", "template", "purity", "rejected")
    return judged.join(known, ["host", "path"]).select(
        "page_id", "host", "path", "rule", "template", "purity",
        F.coalesce("ruled", F.when(F.col("rejected"), F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
    )
