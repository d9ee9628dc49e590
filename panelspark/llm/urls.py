"""URL filters: rules first, and where none decides a tree of path templates that learns from the ruled pages.

Under each host the segments of paths become a tree. A segment is generalised to ``*`` where it holds digits, or where
its node has many different children and the segment itself is rare there. Sibling branches whose smoothed shares of allowed
labels fall into the same band are merged. A template's purity is its share of allowed labels, smoothed
towards the merged branch, that towards the host, that towards all labels. Templates below ``REJECT`` are blocked.

Labels are the pages that rules decide. Defined cases: a null url or one without ``://`` has an empty host and
path, which are a host and a path like any other; without labels the share is 1, so everything is allowed;
repeated rows count each; segments after the third are one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.llm.tables import col, fresh
from panelspark.workspace import stored

#: (host, start of the path, verdict)
Rule = tuple[str, str, str]
LEVELS = 3
#: A node is variable with so many children, and so many a page; then rare children (below that share) are one.
CHILDREN, PER_PAGE, RARE = 8, 0.05, 0.05
SMOOTH, REJECT = 5.0, 0.3
#: Edges of the bands of shares in which sibling branches are merged.
BANDS = (0.1, 0.3, 0.7, 0.9)
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def host_of(url: Column) -> Column:
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, _UPPER, _UPPER.lower())


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def ruled(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule that fits, as a struct of rule and verdict; null if none does."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule_host, start, verdict in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(start)
        out = F.when(fits, F.struct(F.lit(rule_host + start).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def templates(urls: DataFrame) -> DataFrame:
    """``urls`` (one row for each host and path, with ``pages``) with the columns ``t1`` to ``t3``."""
    segments = F.filter(F.split("path", "/"), lambda s: s != "")
    rest = F.array_join(F.slice("segments", LEVELS, F.greatest(F.size("segments"), F.lit(1))), "/")
    out = urls.withColumn("segments", segments)
    parents = ["host"]
    for level in range(1, LEVELS + 1):
        name = f"t{level}"
        here = F.coalesce(F.get("segments", F.lit(level - 1)), F.lit("")) if level < LEVELS else F.when(F.size("segments") >= LEVELS, rest).otherwise("")
        out = stored(out.withColumn("here", here), "level")
        child = stored(out.groupBy(*parents, "here").agg(F.sum("pages").alias("own")), "children")
        node = child.groupBy(*parents).agg(F.sum("own").alias("all"), F.count("*").alias("children"))
        rare = (
            child.join(node, parents)
            .filter((F.col("children") >= CHILDREN) & (F.col("children") >= PER_PAGE * F.col("all")) & (F.col("own") < RARE * F.col("all")))
            .select(*parents, "here", F.lit("*").alias("general"))
        )
        # written first: joined to a plain table, a branch with many paths is split over tasks or meets a broadcast
        out = out.join(stored(rare, "rare"), [*parents, "here"], "left").withColumn(
            name, F.when(F.col("here").rlike("[0-9]"), "*").otherwise(F.coalesce("general", "here"))
        ).drop("general", "here")
        parents.append(name)
    return stored(out.drop("segments"), "templates")


def purities(tree: DataFrame) -> DataFrame:
    """``host, t1, t2, t3, purity`` of every template; ``tree`` has counts ``allowed`` and ``labelled``."""
    sums = lambda *by: tree.groupBy(*by).agg(F.sum("allowed").alias("a"), F.sum("labelled").alias("n"))
    smooth = lambda parent: (F.col("a") + SMOOTH * F.col(parent)) / (F.col("n") + SMOOTH)
    whole = tree.agg(F.sum("allowed").alias("a"), F.sum("labelled").alias("n")).first()
    overall = (whole["a"] + SMOOTH) / (whole["n"] + SMOOTH) if whole["n"] else 1.0
    hosts = sums("host").withColumn("p0", F.lit(float(overall))).select("host", smooth("p0").alias("p_host"))
    branch = sums("host", "t1").join(hosts, "host").withColumn("own", smooth("p_host"))
    band = sum((F.col("own") >= edge).cast("int") for edge in BANDS)
    branch = stored(branch.withColumn("band", band), "branches")
    merged = branch.groupBy("host", "band").agg(F.sum("a").alias("a"), F.sum("n").alias("n"), F.first("p_host").alias("p_host"))
    merged = merged.select("host", "band", smooth("p_host").alias("p_branch"))
    named = branch.join(merged, ["host", "band"]).select("host", "t1", "p_branch")
    return sums("host", "t1", "t2", "t3").join(named, ["host", "t1"]).select("host", "t1", "t2", "t3", smooth("p_branch").alias("purity"))


def judged(pages: DataFrame, rules: Sequence[Rule], url_col: str = "url") -> DataFrame:
    """The rows with ``host, path, rule, verdict, template, purity``; the last two of pages that no rule decides."""
    host, path, rule, verdict, template, purity = fresh(pages.columns, "host", "path", "rule", "verdict", "template", "purity")
    known = pages.withColumn(host, host_of(col(url_col))).withColumn(path, path_of(col(url_col)))
    ones = known.select(col(host).alias("host"), col(path).alias("path")).groupBy("host", "path").agg(F.count("*").alias("pages"))
    ones = ones.withColumn("by", ruled(F.col("host"), F.col("path"), rules))
    labelled = F.when(F.col("by").isNotNull(), F.col("pages")).otherwise(0)
    tree = templates(
        ones.select(
            "host", "path", "pages", "by", labelled.alias("labelled"), F.when(F.col("by.verdict") == "allow", labelled).otherwise(0).alias("allowed")
        )
    )
    tree = tree.join(stored(purities(tree), "purities"), ["host", "t1", "t2", "t3"])
    learnt = F.when(F.col("purity") < REJECT, "block").otherwise("allow")
    found = stored(
        tree.select(
            F.col("host").alias(host), F.col("path").alias(path), F.col("by.rule").alias(rule),
            F.coalesce("by.verdict", learnt).alias(verdict), F.concat_ws("/", "t1", "t2", "t3").alias(template), F.col("purity").alias(purity),
        ),
        "judged",
    )
    return known.join(found, [host, path]).select(*[col(c) for c in [*pages.columns, host, path, rule, verdict, template, purity]])
