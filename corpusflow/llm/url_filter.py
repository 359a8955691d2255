"""URL filter: a path-template tree per host, pruned by labelled purity, under fixed allow and block rules.

Every URL becomes (host, path). Path segments that vary by form (numbers, dates, hexadecimal ids, long mixed tokens) are masked first, so
that a host has few distinct paths. The tree of a host is then built level by level on these paths: a child stays a branch of its own only
if its share of bad labels differs from that of its siblings together by a two-proportion test; all other children are merged
into one wildcard branch. A template is blocked if its smoothed share of bad labels is above a limit.

Defined results: a null URL or one without ``://`` has an empty host and path and is judged like any other; an empty path has the template of the
host alone; segments beyond ``levels`` are kept together as one last segment; repeated rows each get a verdict; without labels the method allows
everything; labels that are null count as none; an empty table gives an empty table. Only the named columns are read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.session import settle

#: (verdict, host, path)
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
LEVELS = 8
#: Pseudo-counts: a template without labels has the bad share of all labels, weighing as much as this many labels.
PRIOR_LABELS = 8.0
BLOCK_ABOVE = 0.5
#: Two-sided test at about 1 %.
SIGNIFICANT_Z = 2.58
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """Index of the longest fitting rule; null if none fits."""
    order = sorted(range(len(rules)), key=lambda i: -len(rules[i][1] + rules[i][2]))
    fits = [
        ((host == rules[i][1]) | host.endswith("." + rules[i][1])) & path.startswith(rules[i][2]) for i in order
    ]
    return F.coalesce(*[F.when(f, F.lit(i)) for i, f in zip(order, fits, strict=True)])


def masked_segments(path: Column, levels: int = LEVELS) -> Column:
    """Non-empty segments with variable ones masked by form; the tail beyond ``levels`` is one segment."""

    def mask(s: Column) -> Column:
        stem = F.regexp_replace(s, r"\.[A-Za-z]{1,5}$", "")
        return (
            F.when(stem.rlike(r"^\d+$"), "{number}")
            .when(stem.rlike(r"^\d{1,4}[-_.]\d{1,2}([-_.]\d{1,4})?$"), "{date}")
            .when(stem.rlike(r"^(?=.*\d)[0-9A-Fa-f-]{8,}$"), "{hex}")
            .when(stem.rlike(r"^(?=.*\d)(?=.*[A-Za-z]).{12,}$"), "{token}")
            .when(stem.rlike(r"^([^-_]+[-_]){3,}[^-_]+$"), "{slug}")
            .otherwise(s)
        )

    parts = F.filter(F.split(path, "/", -1), lambda s: s != "")
    head = F.transform(F.slice(parts, 1, levels), mask)
    tail = F.slice(parts, levels + 1, 1 << 30)
    return F.when(F.size(parts) > levels, F.concat(head, F.array(F.concat_ws("/", F.transform(tail, mask))))).otherwise(head)


def templates(paths: DataFrame, levels: int = LEVELS, z: float = SIGNIFICANT_Z) -> DataFrame:
    """Template of each distinct (host, segments) with its label counts ``n`` and ``bad``: one round of sums a level."""
    at = settle(paths.withColumn("template", F.lit("")))
    depth = min(at.agg(F.max(F.size("segments"))).first()[0] or 0, levels + 1)
    for level in range(depth):
        seg = F.get("segments", F.lit(level))
        child = at.groupBy("host", "template", seg.alias("seg")).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
        pool = child.filter(F.col("seg").isNotNull()).groupBy("host", "template").agg(F.sum("n").alias("pn"), F.sum("bad").alias("pbad"))
        rest_n, rest_bad = F.col("pn") - F.col("n"), F.col("pbad") - F.col("bad")
        share = F.col("pbad") / F.col("pn")
        error = F.sqrt(share * (1 - share) * (1 / F.col("n") + 1 / rest_n))
        differs = (F.col("n") > 0) & (rest_n > 0) & (error > 0) & (
            F.abs(F.col("bad") / F.col("n") - rest_bad / rest_n) > F.lit(z) * error
        )
        own = child.filter(F.col("seg").isNotNull()).join(pool, ["host", "template"])
        own = own.filter(differs).select(
            F.col("host").alias("_host"), F.col("template").alias("_template"), F.col("seg").alias("_seg")
        )
        same = (F.col("host") == F.col("_host")) & (F.col("template") == F.col("_template")) & (seg == F.col("_seg"))
        step = F.when(seg.isNull(), "").otherwise(F.concat(F.lit("/"), F.coalesce("_seg", F.lit("*"))))
        at = at.join(own, same, "left").select("host", "segments", "n", "bad", F.concat("template", step).alias("template"))
        at = settle(at)
    return at


def judge(
    pages: DataFrame, labelled: DataFrame, rules=RULES, levels: int = LEVELS, prior_labels: float = PRIOR_LABELS,
    block_above: float = BLOCK_ABOVE, z: float = SIGNIFICANT_Z,
) -> DataFrame:
    """(page_id, host, path, rule, verdict, template, purity) for each row of ``pages`` (page_id, url).

    ``labelled`` (url, bad) has 0 or 1 for known URLs; ``purity`` is the smoothed share of good labels of the template.
    """
    urls = settle(pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")))
    known = labelled.filter(F.col("bad").isNotNull()).select(
        host_of(F.col("url")).alias("host"), masked_segments(path_of(F.col("url")), levels).alias("segments"),
        F.lit(1).alias("n"), F.col("bad").cast("long").alias("bad"),
    )
    seen = urls.select("host", masked_segments(F.col("path"), levels).alias("segments"), F.lit(0).alias("n"), F.lit(0).cast("long").alias("bad"))
    paths = seen.unionByName(known).groupBy("host", "segments").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    tree = templates(paths, levels, z)
    n_all, bad_all = tree.agg(F.sum("n"), F.sum("bad")).first()
    prior = (bad_all or 0) / n_all if n_all else 0.0
    bad_share = (F.sum("bad") + F.lit(prior * prior_labels)) / (F.sum("n") + F.lit(prior_labels))
    leaves = tree.groupBy("host", "template").agg((1 - bad_share).alias("purity"))
    shares = tree.select("host", "segments", "template").join(leaves, ["host", "template"])
    found = urls.withColumn("segments", masked_segments(F.col("path"), levels)).join(shares, ["host", "segments"], "left")
    chosen = rule_of(F.col("host"), F.col("path"), rules)
    pick = lambda i: reduce(lambda e, k: F.when(chosen == k, rules[k][i]).otherwise(e), range(len(rules)), F.lit(None))
    verdict = F.coalesce(pick(0), F.when(1 - F.col("purity") > block_above, "block").otherwise("allow"))
    return found.select(
        "page_id", "host", "path", F.concat(pick(1), pick(2)).alias("rule"), verdict.alias("verdict"), "template", "purity"
    )
