"""Url verdicts from listed rules and from a tree of path templates per host.

The tree grows from the host down. At each node a segment that leads to too few pages
of the node is variable and becomes the wildcard; the pages behind it go on together.
Then, from the deepest level up, sibling branches whose share of good labels doesn't
differ significantly from that of the siblings together are merged into the wildcard.
A template is rejected when its labelled purity, smoothed towards that of its host and
that towards the purity of all, is under a threshold.

All of it is DataFrame operations: counts are aggregated before their shuffle, so a
host with a third of the pages is a few rows per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemart.plans.lineage import cut_lineage

WILDCARD = "*"
#: Segments of a path that the tree resolves; what follows them doesn't part pages.
DEPTH = 4
#: Pages, and their share of the node, from which on a segment has a branch of its own.
MIN_PAGES = 20
MIN_SHARE = 0.02
#: Standard errors by which a branch must differ from its siblings to stay apart.
DIFFERENCE = 2.58
#: Weight in labels of the purity of the level above.
SMOOTHING = 10.0
#: Smoothed share of good labels under which a template is rejected.
PURITY = 0.5


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lowered) and path; both empty for NULL and for a url without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, upper, upper.lower()), path


def listed_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """Rule text and verdict of the longest fitting rule of (verdict, ``host/path``); NULL if none."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for action, text in sorted(rules, key=lambda item: len(item[1])):
        name, _, prefix = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + prefix)
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        verdict = F.when(fits, F.lit(action)).otherwise(verdict)
    return rule, verdict


def _templates(pages: DataFrame) -> DataFrame:
    """``pages`` (host, path, ...) with the columns t1 to tDEPTH; NULL past the end of a path."""
    segments = F.split(F.regexp_replace("path", "^/", ""), "/")
    rows = pages.withColumn("_segments", F.when(F.col("path") != "", segments))
    node = ["host"]
    for depth in range(1, DEPTH + 1):
        rows = rows.withColumn("_s", F.get("_segments", F.lit(depth - 1)))
        counts = rows.groupBy(*node, "_s").agg(F.count(F.lit(1)).alias("_n"))
        totals = counts.groupBy(*node).agg(F.sum("_n").alias("_of"))
        # A segment implies those before it, so the keys of these rows aren't NULL.
        frequent = counts.where((F.col("_n") >= MIN_PAGES) & F.col("_s").isNotNull())
        frequent = frequent.join(totals, node).where(F.col("_n") >= MIN_SHARE * F.col("_of"))
        frequent = frequent.select(*node, "_s", F.col("_s").alias("_fs"))
        rows = rows.join(frequent, [*node, "_s"], "left").withColumn(
            f"t{depth}",
            F.when(F.col("_s").isNotNull(), F.coalesce("_fs", F.lit(WILDCARD))),
        )
        # Each level is written, or its plan would hold those of all levels above twice.
        rows = cut_lineage(rows.drop("_s", "_fs"), "templates")
        node = [*node, f"t{depth}"]
    return rows.drop("_segments")


def _merged(stats: DataFrame) -> DataFrame:
    """(host, t1.., m1.., labelled, good): templates with the branch that each merges into."""
    names = [f"m{d}" for d in range(1, DEPTH + 1)]
    stats = stats.withColumns({f"m{d}": F.col(f"t{d}") for d in range(1, DEPTH + 1)})
    for depth in range(DEPTH, 0, -1):
        above, own = ["host", *names[: depth - 1]], names[depth - 1]
        branch, siblings = Window.partitionBy(*above, own), Window.partitionBy(*above)
        n, good = F.sum("labelled").over(branch), F.sum("good").over(branch)
        of, all_good = F.sum("labelled").over(siblings), F.sum("good").over(siblings)
        # A branch without labels, or with all of them, can't be told from the others.
        own_n, other_n = F.nullif(n, F.lit(0.0)), F.nullif(of - n, F.lit(0.0))
        pooled = all_good / (own_n + other_n)
        error = F.sqrt(pooled * (1 - pooled) * (1 / own_n + 1 / other_n))
        apart = F.abs(good / own_n - (all_good - good) / other_n) > DIFFERENCE * error
        stats = stats.withColumn("_apart", F.coalesce(apart, F.lit(False)))
        merged = F.when(F.col(own).isNull() | F.col("_apart"), F.col(own)).otherwise(WILDCARD)
        stats = stats.withColumn(own, merged).drop("_apart")
    return stats


def template_verdicts(pages: DataFrame) -> DataFrame:
    """``pages`` (host, path, good, ...) with template and purity.

    ``good`` is a label between 0 and 1, NULL where there is none. Empty hosts and paths
    have templates as any other; a host without labels has the purity of all.
    """
    rows = _templates(pages)
    keys = ["host", *(f"t{d}" for d in range(1, DEPTH + 1))]
    stats = rows.groupBy(*keys).agg(
        F.count("good").cast("double").alias("labelled"),
        F.coalesce(F.sum(F.col("good").cast("double")), F.lit(0.0)).alias("good"),
    )
    merged = _merged(stats)
    branch = ["host", *(f"m{d}" for d in range(1, DEPTH + 1))]
    totals = stats.groupBy("host").agg(F.sum("labelled").alias("_hl"), F.sum("good").alias("_hg"))
    over_all = totals.agg(F.sum("_hl").alias("_al"), F.sum("_hg").alias("_ag")).first()
    prior = over_all["_ag"] / over_all["_al"] if over_all["_al"] else 1.0
    own = Window.partitionBy(*branch)
    host = (F.col("_hg") + SMOOTHING * prior) / (F.col("_hl") + SMOOTHING)
    purity = (F.sum("good").over(own) + SMOOTHING * host) / (F.sum("labelled").over(own) + SMOOTHING)
    template = F.concat_ws("/", "host", *(f"m{d}" for d in range(1, DEPTH + 1)))
    judged = merged.join(totals, "host").select(
        *(F.col(c).alias(f"_j_{c}") for c in keys), template.alias("template"), purity.alias("purity")
    )
    same = F.lit(True)
    for c in keys:
        same &= F.col(c).eqNullSafe(F.col(f"_j_{c}"))
    return rows.join(judged, same).drop(*keys[1:], *(f"_j_{c}" for c in keys))
