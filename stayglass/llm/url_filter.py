"""URL filters: rules first, then a path-template tree for each host, judged by smoothed labelled purity.

Tree. A path is cut into segments. Level by level, from the root of each host:

* a segment that is a number, a hash or a date-like name (it has a digit), or one of many different ones under its
  parent (``variable_children`` or more, none with ``literal_percent`` of the parent's urls), becomes the wildcard ``*``;
* the other segments stay literal. Literal branches of one parent that are statistically alike (the confidence bounds
  of their shares of allowed and of blocked urls overlap those of all of them together) are merged into the branch ``~``.

So templates are like ``/en/*`` or ``/~/*``. Levels go on until no two paths share a branch, however deep that is; what
a path has below the last branch it shares is generalised at once, segment by segment, since no sibling has a say there.

Purity. Labels are the rules' own verdicts, counted over all urls. Of a node: (allowed + (unlabelled + weight) * purity
of its parent) / (all + weight), so urls without a label stand for what is known above them, and a few labels of one
kind decide where they are, not for the whole host. A node with all urls of its parent has its parent's purity, so no
label counts twice for want of branches. It starts at the host's root from the purity of all urls of hosts
with the same last two names, and that from ``prior``. Templates with a purity under ``reject_below`` are blocked.

Tables are grouped by (host, prefix), with counts taken before every shuffle; no list of urls or children is collected.

Defined results: null urls and urls without ``://`` have empty host and path and are allowed unless their (empty)
template is rejected; repeated urls count as often as they occur and get the same verdict.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayglass.llm.common import name_of, stored


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


# Rules of the contract.
RULES = (
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)


@dataclass(frozen=True)
class Settings:
    variable_children: int = 20
    literal_percent: int = 20
    weight: float = 10.0
    prior: float = 0.7
    reject_below: float = 0.5
    z: float = 1.96


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host after the first ``://``, A-Z lowered, and the path up to ``?``, ``#`` or the end."""
    upper = "".join(map(chr, range(65, 91)))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.translate(host, upper, upper.lower()), path


def rule_of(host: Column, path: Column, rules) -> Column:
    """Number of the longest rule that fits, or null."""
    out = F.lit(None).cast("int")
    for i in sorted(range(len(rules)), key=lambda i: len(rules[i].name)):
        r = rules[i]
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        out = F.when(fits, F.lit(i)).otherwise(out)
    return out


def _variable(segment: Column) -> Column:
    return segment.rlike("[0-9]")


def _general(segment: Column) -> Column:
    return F.when(_variable(segment), F.lit("*")).otherwise(segment)


def template_tree(paths: DataFrame, s: Settings) -> DataFrame:
    """``paths`` (host, path, n, good, bad) with ``template``, an array of segments generalised level by level, and
    ``shared``: how many of its first segments other paths may have too."""
    names = ["host", "path", "n", "good", "bad", "segments"]
    segments = F.filter(F.split("path", "/", -1), lambda x: x != "")
    rest = stored(paths.withColumn("segments", segments).withColumn("template", F.array().cast("array<string>")), "urls")
    done, level = [], 0
    while rest.limit(1).count():
        depth = F.lit(level)
        done.append(rest.where(F.size("segments") <= level).select(*names, "template", depth.alias("shared")))
        here = rest.where(F.size("segments") > level).withColumn("segment", _general(F.get("segments", depth)))
        child = here.groupBy("host", "template", "segment").agg(*(F.sum(c).alias(c) for c in ("n", "good", "bad")), F.count("*").alias("paths"))
        child = _similar(child, s).select(F.col("host").alias("h"), F.col("template").alias("t"), F.col("segment").alias("g"), "to", "alone")
        same = (here["host"] == F.col("h")) & (here["template"] == F.col("t")) & (here["segment"] == F.col("g"))
        tail = F.transform(F.slice("segments", level + 1, F.size("segments")), _general)
        step = F.concat("template", F.when(F.col("alone"), tail).otherwise(F.array("to")))
        after = stored(here.join(child, same).select(*names, step.alias("template"), "alone"), f"urls-{level}")
        done.append(after.where("alone").select(*names, "template", depth.alias("shared")))
        rest, level = after.where("not alone").drop("alone"), level + 1
    if not done:
        return rest.withColumn("shared", F.lit(0)).drop("segments")
    return reduce(DataFrame.unionByName, done).drop("segments")


def _similar(child: DataFrame, s: Settings) -> DataFrame:
    """What each segment under its parent becomes: ``*``, ``~`` or itself; and whether the parent has one path only."""
    literal = (F.col("segment") != "*").cast("long")
    parent = child.groupBy("host", "template").agg(
        F.sum("n").alias("all"), F.sum(literal).alias("kinds"), F.max(F.when(literal == 1, F.col("n"))).alias("largest"), (F.sum("paths") == 1).alias("alone"),
        *(F.sum(F.when(literal == 1, F.col(c))).alias(f"{c}_all") for c in ("n", "good", "bad")),
    )
    parent = parent.select(F.col("host").alias("h"), F.col("template").alias("t"), "all", "kinds", "largest", "alone", "n_all", "good_all", "bad_all")
    both = child.join(parent, (child["host"] == F.col("h")) & (child["template"] == F.col("t")))
    many = (F.col("kinds") >= s.variable_children) & (F.col("largest") * 100 < F.col("all") * s.literal_percent)
    alike = F.col("kinds") > 1
    for c in ("good", "bad"):
        (low, high), (low_all, high_all) = _bounds(F.col(c), F.col("n"), s.z), _bounds(F.col(f"{c}_all"), F.col("n_all"), s.z)
        alike &= (low <= high_all) & (high >= low_all)
    to = F.when((F.col("segment") == "*") | many, F.lit("*")).when(alike, F.lit("~")).otherwise(F.col("segment"))
    return both.select("host", "template", "segment", to.alias("to"), "alone")


def _bounds(k: Column, n: Column, z: float) -> tuple[Column, Column]:
    """Wilson's bounds of the share ``k`` of ``n``, which is above 0."""
    n = n.cast("double")
    p = k / n
    middle = (p + z * z / (2 * n)) / (1 + z * z / n)
    half = z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n)) / (1 + z * z / n)
    return middle - half, middle + half


def purity(templates: DataFrame, s: Settings) -> DataFrame:
    """(host, template, purity) by smoothing from the domain over the host's root down to the template."""
    own = [F.col(c) for c in ("n", "good", "bad")]
    sums = [F.sum(c).alias(c) for c in ("n", "good", "bad")]

    def smooth(n: Column, good: Column, bad: Column, above: Column) -> Column:
        return (good + (n - good - bad + s.weight) * above) / (n + s.weight)

    def below(above: Column, urls: Column) -> Column:
        return F.when(F.col("n") < urls, smooth(*own, above)).otherwise(above)

    root = templates.groupBy("host").agg(*sums).withColumn("domain", F.substring_index("host", ".", -2))
    wide = root.groupBy("domain").agg(*sums).select("domain", F.col("n").alias("urls"), smooth(*own, F.lit(s.prior)).alias("above"))
    node = root.join(wide, "domain").withColumn("prefix", F.array().cast("array<string>"))
    out, deepest = None, templates.agg(F.max("shared")).first()[0] or 0
    for depth in range(deepest + 1):
        level = stored(node.select("host", "prefix", F.col("n").alias("urls"), below(F.col("above"), F.col("urls")).alias("above")), f"url-purity-{depth}")
        out = level if out is None else out.union(level)
        node = templates.where(F.col("shared") > depth).groupBy("host", F.slice("template", 1, depth + 1).alias("prefix")).agg(*sums)
        parent = level.withColumnRenamed("prefix", "parent")
        node = node.withColumn("parent", F.slice("prefix", 1, depth)).join(parent, ["host", "parent"])
    # what follows the shared part of a template has the same urls in every node
    ends = templates.withColumn("prefix", F.slice("template", F.lit(1), F.col("shared"))).join(out, ["host", "prefix"])
    deeper = F.size("template") > F.col("shared")
    return ends.select("host", "template", F.when(deeper, below(F.col("above"), F.col("urls"))).otherwise(F.col("above")).alias("purity"))


def judge(pages: DataFrame, page_id: str = "page_id", url: str = "url", rules=RULES, settings: Settings = Settings()) -> DataFrame:
    """(page_id, host, path, rule, verdict, template, purity) of every row."""
    s = settings
    host, path = host_and_path(name_of(url))
    rows = pages.select(name_of(page_id).alias("id"), host.alias("host"), path.alias("path"))
    number = rule_of(F.col("host"), F.col("path"), rules)
    verdict, named = F.lit(None).cast("string"), F.lit(None).cast("string")
    for i, r in enumerate(rules):
        verdict = F.when(F.col("number") == i, F.lit(r.verdict)).otherwise(verdict)
        named = F.when(F.col("number") == i, F.lit(r.name)).otherwise(named)
    rows = rows.withColumn("number", number).withColumn("ruled", verdict).withColumn("rule", named)
    paths = rows.groupBy("host", "path").agg(
        F.count("*").alias("n"), F.count(F.when(F.col("ruled") == "allow", 1)).alias("good"), F.count(F.when(F.col("ruled") == "block", 1)).alias("bad")
    )
    tree = template_tree(paths, s)
    templates = stored(tree.groupBy("host", "template").agg(*(F.sum(c).alias(c) for c in ("n", "good", "bad")), F.max("shared").alias("shared")), "url-templates")
    scored = tree.join(purity(templates, s), ["host", "template"]).select("host", "path", "template", "purity")
    own = F.when(F.col("purity") < s.reject_below, F.lit("block")).otherwise(F.lit("allow"))
    out = rows.join(scored, ["host", "path"])
    shown = F.concat(F.lit("/"), F.array_join("template", "/"))
    return out.select(
        F.col("id").alias(page_id), "host", "path", "rule", F.coalesce("ruled", own).alias("verdict"), shown.alias("template"), F.round("purity", 6).alias("purity")
    )
