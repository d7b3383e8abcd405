"""URL filters: stated rules first, then a path-template tree for the urls they leave open.

Per host, paths become templates segment by segment. A segment with digits has its runs of
digits generalised at once; then, level by level from the root, rare segments are replaced by
wildcards, whether a node has two of them or millions. A segment is frequent, and stays as it is, with
``common`` urls or more that are at least one in 4 * ``branches`` of its node's. A rare one with
labels joins those of a like share of bad ones: ``*{allow}`` (under 0.05), ``*{block}`` (over 0.95) or
its share in tenths, as ``*{0.3}``. Rare ones without any label are ``*``. Segments past
``depth`` - 1 are one segment, treated like any other.

Statistically similar branches are merged at every level, the deepest first: templates that differ in one
segment alone are taken by rising share of bad labels, and one joins the branch before it unless
its share differs significantly (two-proportion z-test) from that of the pooled branch or from the
branch's lowest member. A branch is rejected if its purity, the smoothed share of its labelled urls
that are bad, is over ``least``; the prior is the share of the host's other labels (those of rules
left out, which say nothing about other sections), that of a host is ``base``.

Urls without a label, nor any in their template, are rejected only on the evidence of their siblings: each
rare segment beside theirs that has labels votes by its share, and the lower bound of a Wilson interval
of those votes must be over ``least`` (seven bad votes or more if all agree). Segments that rules
decide have no vote, and a frequent segment without labels is allowed.

Every step is a partially aggregated count or join; a merge sees at most 4 * ``branches`` frequent segments
and a dozen wildcards.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from corpusflow.llm.common import col, stored

#: A frequent segment has one in 4 * ``BRANCHES`` of its node's urls; levels of the tree.
BRANCHES, DEPTH = 32, 6
#: Urls that make a segment frequent.
COMMON = 8
#: Weight of a prior in labelled urls, a host's prior share of bad ones, share that rejects, z that separates, z of votes.
PRIOR, BASE, LEAST, Z, SURE = 4.0, 0.25, 0.5, 1.96, 2.58

#: Urls, bad labels and labels, and those of the latter that rules give.
COUNTS = ("n", "bad", "labelled", "ruled_bad", "ruled")

# Verdict, host and path of each rule.
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/"))


def host_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path; both empty for null or without ``://``."""
    rest = F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), r"(?s)\A.*?://(.*)\z", 1)
    host = F.regexp_extract(rest, r"(?s)\A([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)\A[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest fitting rule as ``struct(verdict, rule)``, or null. A rule fits its host and all
    subdomains if the path starts with the rule's."""
    out = F.lit(None).cast("struct<verdict:string,rule:string>")
    for verdict, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        out = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(h + p).alias("rule"))).otherwise(out)
    return out


def merge_branches(members, z: float = Z) -> list[int]:
    """Branch number of each ``(bad, labelled)``, all labelled and by rising share of bad ones."""
    def differ(b1: int, n1: int, b2: int, n2: int) -> bool:
        pool = (b1 + b2) / (n1 + n2)
        return abs(b1 / n1 - b2 / n2) > z * math.sqrt(pool * (1 - pool) * (1 / n1 + 1 / n2))

    out, lowest, whole = [], (0, 0), (0, 0)
    for bad, labelled in members:
        if not out or differ(*whole, bad, labelled) or differ(*lowest, bad, labelled):
            out.append(out[-1] + 1 if out else 0)
            lowest = whole = (bad, labelled)
        else:
            out.append(out[-1])
            whole = (whole[0] + bad, whole[1] + labelled)
    return out


def judge(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES, labels: DataFrame | None = None, branches: int = BRANCHES,
          depth: int = DEPTH, prior: float = PRIOR, base: float = BASE, least: float = LEAST, z: float = Z, common: int = COMMON, sure: float = SURE) -> DataFrame:
    """One row per input row: ``page_id, host, path, rule, verdict, template, branch, purity``.

    ``verdict`` (allow or block) is that of the longest fitting rule, else that of the url's branch, the
    merged templates; ``purity`` is the branch's, for urls without labels the lower bound of their
    siblings' votes, null without these. Labelled urls are those that a rule decides, and with
    ``labels`` - ``(url, bad boolean)`` - its urls; null labels are left out. Null urls and those without
    ``://`` have empty host and path and one empty segment; they are judged like any other host. With nothing
    labelled all are allowed. Equal urls are judged alike; repeated rows each give a row and
    count as often as they stand there; no rows give no rows. Paths may have any depth and length.
    """
    host, path = host_path(col(url_col))
    rows = pages.select(col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    rows = rows.withColumn("hit", rule_of(F.col("host"), F.col("path"), rules))
    urls = rows.groupBy("host", "path", "hit").agg(F.count("*").alias("n"))
    ruled = F.when(F.col("hit").isNotNull(), F.col("n")).otherwise(0)
    blocked = F.when(F.col("hit.verdict") == "block", F.col("n")).otherwise(0)
    seen = urls.select("host", "path", "n", blocked.alias("bad"), ruled.alias("labelled"), blocked.alias("ruled_bad"), ruled.alias("ruled"))
    if labels is not None:
        h, p = host_path(F.col("url"))
        none = F.lit(0).cast("long")
        more = labels.where(F.col("bad").isNotNull()).select(h.alias("host"), p.alias("path"), none.alias("n"), F.col("bad").cast("long").alias("bad"), F.lit(1).cast("long").alias("labelled"),
                                                             none.alias("ruled_bad"), none.alias("ruled"))
        seen = seen.unionByName(more)
    parts = F.transform(F.split(F.substring("path", 2, 1 << 30), "/"), lambda s: F.regexp_replace(F.regexp_replace(s, "[0-9]+", "{n}"), r"\A\*", "%2A"))
    rest = F.array_join(F.slice(parts, depth, F.greatest(F.size(parts), F.lit(1))), "/")
    shape = F.when(F.size(parts) > depth, F.array_append(F.slice(parts, 1, depth - 1), rest)).otherwise(parts)
    seen = seen.withColumn("segments", shape).groupBy("host", "segments").agg(*[F.sum(c).alias(c) for c in COUNTS])
    tree = _generalise(seen, branches, depth, common)  # one row per host and shape of path
    nodes = tree.groupBy("host", "template").agg(*[F.sum(c).alias(c) for c in COUNTS], F.first("votes").alias("votes"), F.first("voters").alias("voters"))
    nodes = stored(_merge(nodes, depth, z), "url-branches")
    free_bad, free = F.col("bad") - F.col("ruled_bad"), F.col("labelled") - F.col("ruled")
    hosts = nodes.groupBy("host").agg(F.sum(free_bad).alias("host_bad"), F.sum(free).alias("host_labelled"))
    merged = nodes.groupBy("host", "branch").agg(F.sum("bad").alias("bad"), F.sum("labelled").alias("labelled"), F.sum(free_bad).alias("own_bad"), F.sum(free).alias("own_labelled"))
    others = (F.col("host_bad") - F.col("own_bad") + prior * base) / (F.col("host_labelled") - F.col("own_labelled") + prior)
    merged = merged.join(hosts, "host").select("host", "branch", F.when(F.col("labelled") > 0, (F.col("bad") + prior * others) / (F.col("labelled") + prior)).alias("own"))
    m, share = F.col("voters"), F.col("votes") / F.col("voters")
    bound = (share + sure**2 / (2 * m) - sure * F.sqrt(share * (1 - share) / m + sure**2 / (4 * m * m))) / (1 + sure**2 / m)
    judged = nodes.select("host", "template", "branch", F.when(m > 0, bound).alias("bound")).join(merged, ["host", "branch"])
    judged = judged.select("host", "template", "branch", F.coalesce("own", "bound").alias("purity"))
    verdicts = stored(tree.select("host", "segments", "template").join(judged, ["host", "template"]), "url-verdicts")
    rows = rows.withColumn("segments", shape)
    text = lambda c: F.concat(F.lit("/"), F.array_join(c, "/")).alias(c)
    return rows.join(verdicts, ["host", "segments"], "left").select(
        "page_id", "host", "path", F.col("hit.rule").alias("rule"),
        F.coalesce("hit.verdict", F.when(F.col("purity") > least, "block").otherwise("allow")).alias("verdict"), text("template"), text("branch"), "purity")


def _generalise(seen: DataFrame, branches: int, depth: int, common: int) -> DataFrame:
    """Add ``template`` to rows ``(host, segments, ...)``, level by level, and ``votes`` and ``voters`` of
    the siblings where the template has a ``*``."""
    tree = seen.withColumns({"template": F.array().cast("array<string>"), "votes": F.lit(None).cast("double"), "voters": F.lit(None).cast("long")})
    for level in range(1, depth + 1):
        here = F.when(F.size("segments") >= level, F.get("segments", F.lit(level - 1)))
        tree = tree.withColumn("here", here)
        children = tree.where("here IS NOT NULL").groupBy("host", "template", "here").agg(*[F.sum(c).alias(c) for c in COUNTS])
        whole = children.groupBy("host", "template").agg(F.sum("n").alias("whole"))
        frequent = (F.col("n") >= common) & (F.col("n") * 4 * branches >= F.col("whole"))
        share = F.col("bad") / F.col("labelled")
        tenths = F.concat(F.lit("*{"), F.round(share, 1).cast("string"), F.lit("}"))
        pool = F.when(share < 0.05, "*{allow}").when(share > 0.95, "*{block}").otherwise(tenths)
        star = F.when(frequent, F.col("here")).when(F.col("labelled") > 0, pool).otherwise("*")
        stars = children.join(whole, ["host", "template"]).withColumn("star", star)
        voting = stars.where(~frequent & (F.col("labelled") > 0) & (F.col("ruled") == 0))
        ballots = voting.groupBy("host", "template").agg(F.sum(share).alias("new_votes"), F.count("*").alias("new_voters"))
        stars = stars.select("host", "template", "here", "star").join(ballots, ["host", "template"], "left")
        tree = tree.join(stars, ["host", "template", "here"], "left")
        open_ = F.col("star") == "*"
        tree = tree.withColumns({
            "template": F.when(F.col("here").isNull(), F.col("template")).otherwise(F.array_append("template", F.col("star"))),
            "votes": F.when(open_ & F.col("new_voters").isNotNull(), F.col("new_votes")).otherwise(F.col("votes")),
            "voters": F.when(open_ & F.col("new_voters").isNotNull(), F.col("new_voters")).otherwise(F.col("voters"))})
        tree = stored(tree.drop("here", "star", "new_votes", "new_voters"), f"url-level-{level}")
    return tree


def _merge(nodes: DataFrame, depth: int, z: float) -> DataFrame:
    """Add ``branch``: templates of one host, equal but for similar segments, get one. A merged
    segment is called ``{first+others}``."""
    number = F.udf(lambda members: merge_branches([(m.bad, m.labelled) for m in members], z), "array<int>", useArrow=False)
    nodes = nodes.withColumn("branch", F.col("template"))
    for level in range(depth, 0, -1):
        labelled = nodes.where((F.col("labelled") > 0) & (F.size("branch") >= level))
        group = {"before": F.slice("branch", 1, level - 1), "after": F.slice("branch", level + 1, depth), "here": F.get("branch", F.lit(level - 1))}
        sums = labelled.withColumns(group).groupBy("host", "before", "after", "here").agg(F.sum("bad").alias("bad"), F.sum("labelled").alias("labelled"))
        member = F.struct((F.col("bad") / F.col("labelled")).alias("share"), "here", "bad", "labelled")
        groups = sums.groupBy("host", "before", "after").agg(F.array_sort(F.collect_list(member)).alias("members")).where(F.size("members") > 1)
        numbered = groups.withColumn("number", number("members"))
        each = numbered.select("host", "before", "after", F.explode(F.arrays_zip(F.col("members.here").alias("here"), F.col("number").alias("number"))).alias("x")).select("host", "before", "after", "x.here", "x.number")
        names = each.groupBy("host", "before", "after", "number").agg(F.min("here").alias("first"), F.count("*").alias("c")).where("c > 1")
        names = names.select("host", "before", "after", "number", F.format_string("{%s+%d}", "first", F.col("c") - 1).alias("name"))
        named = each.join(names, ["host", "before", "after", "number"]).drop("number")
        named = named.select("host", F.concat("before", F.array("here"), "after").alias("branch"), F.concat("before", F.array("name"), "after").alias("to"))
        # a branch without labels has no entry here: branches are equal only where all their segments are
        nodes = stored(nodes.join(named, ["host", "branch"], "left").withColumn("branch", F.coalesce("to", "branch")).drop("to"), f"url-merge-{level}")
    return nodes
