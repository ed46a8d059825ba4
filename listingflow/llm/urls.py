"""URL verdicts: rules by host and path, and a tree of path templates for the rest.
Column expressions only.

Per host, paths are taken apart into segments. A segment that varies (numbers, or
too many values at one place of the tree) becomes a wildcard. Branches whose labels
do not differ from those of the whole place by more than chance are merged into the
wildcard, too. A template's purity is the share of blocked urls among its labelled
ones, smoothed towards that of the places above it; templates of a high purity are
blocked.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from listingflow.llm.common import lower_ascii, stored

WILD = "*"
# A place has varied segments if it has more values than this, and they than that
# share of its urls.
MANY_VALUES, VARIED = 20, 0.2
# Branches that differ from their place by fewer standard errors are merged with it.
SURE = 2.0
# Smoothing: as many urls as the place above counts for, and the purity that blocks.
PRIOR, IMPURE = 4.0, 0.5


@dataclass(frozen=True)
class Rule:
    verdict: str
    text: str  # host and path, as in `org/` or `example.org/es/`

    @property
    def host(self) -> str:
        return self.text.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.text.partition("/")[2]


RULES = (
    Rule("allow", "org/"),
    Rule("block", "example.org/es/"),
    Rule("block", "example.org/en/1"),
    Rule("allow", "com/fr/"),
    Rule("block", "com/de/"),
)

_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    return lower_ascii(F.regexp_extract(F.coalesce(url, F.lit("")), _URL, 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), _URL, 2)


def rule_of(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> tuple[Column, Column]:
    """The text and verdict of the longest rule that fits, else null."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.text)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        text = F.when(fits, rule.text).otherwise(text)
        verdict = F.when(fits, rule.verdict).otherwise(verdict)
    return text, verdict


def _shape(segment: Column) -> Column:
    """A segment with its numbers made wild; what is left of it is text."""
    return F.regexp_replace(segment, "[0-9]++|[0-9a-fA-F-]{16,}+", WILD)


def _smooth(blocked: Column, labelled: Column, above: Column) -> Column:
    return (blocked + PRIOR * above) / (labelled + PRIOR)


def _settled(paths: DataFrame, depth: int) -> DataFrame:
    """Templates below places whose labels are all the same, or that have none.

    No branch differs there, so every segment is wild. A level as deep as `length`
    has the labels of all paths that reach it; the distance of its purity from that of
    the labels shrinks by a factor a level, and the factors are multiplied as logs.
    """
    place = ["host", "template"]
    lengths = paths.groupBy(*place, "length").agg(F.sum("labelled").alias("own"), F.sum("blocked").alias("own_blocked"))
    whole, down = Window.partitionBy(*place), Window.partitionBy(*place).orderBy("length")
    reach = F.sum("own").over(Window.partitionBy(*place).orderBy(F.desc("length")))
    levels = F.col("length") - F.coalesce(F.lag("length").over(down), F.lit(depth))
    target = F.coalesce(F.try_divide(F.sum("own_blocked").over(whole), F.sum("own").over(whole)), F.lit(0.0))
    lengths = lengths.select(*place, "length", target.alias("target"), (levels * F.log(PRIOR / (reach + PRIOR))).alias("log"))
    lengths = lengths.select(*place, "length", "target", F.exp(F.sum("log").over(down)).alias("left"))
    found = paths.join(lengths, [*place, "length"])
    wild = F.expr(f"repeat('/{WILD}', length - {depth})")
    # Rounded, so that logs do not move a purity of just IMPURE.
    purity = F.round(F.col("target") + (F.col("purity") - F.col("target")) * F.col("left"), 12)
    return found.select("host", "path", F.concat("template", wild).alias("template"), purity.alias("purity"))


def templates(paths: DataFrame) -> DataFrame:
    """(host, path, template, purity) of distinct paths, of any depth.

    `paths` has host, path, n (urls), labelled and blocked (urls of those). The tree
    grows a level at a time while some place holds both labels; the rest is settled.
    """
    segments = F.filter(F.split("path", "/"), lambda s: s != "")
    sums = [F.sum(c).alias(c) for c in ("n", "labelled", "blocked")]
    whole = paths.agg(F.sum("blocked").alias("all_blocked"), F.sum("labelled").alias("all_labelled"))
    top = whole.first()
    share = (top["all_blocked"] or 0) / top["all_labelled"] if top["all_labelled"] else 0.0
    now = paths.withColumn("segments", segments).withColumn("length", F.size("segments")).withColumn("template", F.lit(""))
    # A host's purity leans on that of its domain, a domain's on that of all.
    domain = F.regexp_extract("host", r"([^.]*\.[^.]*)$", 1)
    now = now.withColumn("domain", F.when(domain != "", domain).otherwise(F.col("host"))).withColumn("purity", F.lit(float(share)))
    smooth = _smooth(F.col("blocked"), F.col("labelled"), F.col("above"))
    for level in (["domain"], ["domain", "host"]):
        sure = now.groupBy(*level).agg(*sums[1:], F.first("purity").alias("above")).select(*level, smooth.alias("purity"))
        now = now.drop("purity").join(stored(sure, "purity"), level)
    now, depth, out = now.drop("domain"), 0, None
    place = ["host", "template"]
    while True:
        mixed = now.groupBy(*place).agg(*sums[1:]).select(*place, F.col("blocked").between(1, F.col("labelled") - 1).alias("mixed"))
        now = stored(now.join(mixed, place), "level")
        done = _settled(now.where("not mixed"), depth)
        ended = now.where(F.col("mixed") & (F.col("length") == depth)).select("host", "path", "template", "purity")
        done = stored(done.unionByName(ended), "settled")
        out = done if out is None else out.unionByName(done)
        now = now.where(F.col("mixed") & (F.col("length") > depth)).drop("mixed")
        if now.isEmpty():
            return out
        now = now.withColumn("segment", _shape(F.get("segments", F.lit(depth))))
        branches = now.groupBy(*place, "segment").agg(*sums, F.first("purity").alias("above"))
        places = branches.groupBy(*place).agg(
            F.sum("n").alias("of_n"), F.sum("labelled").alias("of_labelled"), F.sum("blocked").alias("of_blocked"), F.count("*").alias("values")
        )
        rate = F.try_divide(F.col("of_blocked"), F.col("of_labelled"))
        error = F.sqrt(F.try_divide(rate * (1 - rate), F.col("labelled")))
        differs = F.abs(F.try_divide(F.col("blocked"), F.col("labelled")) - rate) > SURE * error
        varied = (F.col("values") > MANY_VALUES) & (F.col("values") > VARIED * F.col("of_n"))
        merged = F.when(varied | ~F.coalesce(differs, F.lit(False)), WILD).otherwise(F.col("segment"))
        chosen = branches.join(places, place).select(*place, "segment", merged.alias("as"), "labelled", "blocked", "above")
        pure = chosen.groupBy(*place, "as").agg(F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked"), F.first("above").alias("above"))
        pure = pure.select(*place, "as", smooth.alias("below"))
        chosen = stored(chosen.select(*place, "segment", "as").join(pure, [*place, "as"]), "branches")
        now = now.join(chosen, [*place, "segment"])
        now = now.withColumn("template", F.concat("template", F.lit("/"), "as")).withColumn("purity", F.col("below")).drop("as", "below", "segment")
        depth += 1


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES, id: str = "page_id", url: str = "url") -> DataFrame:
    """`id`, host, path, rule, verdict, template and purity of every row's url.

    The labels are the verdicts of the rules. A url that a rule fits has its verdict;
    another is blocked if its template's purity is above IMPURE, else allowed. A url
    without `://`, or none, has an empty host and path, and the verdict of that
    place. Repeated rows come out as often as they are there; other columns are not
    read.
    """
    rows = pages.select(F.col(id).alias("id"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    paths = rows.groupBy("host", "path").agg(F.count("*").alias("n")).withColumn("verdict", verdict)
    known = F.col("verdict").isNotNull()
    paths = paths.withColumns(
        {
            "labelled": F.when(known, F.col("n")).otherwise(0),
            "blocked": F.when(F.col("verdict") == "block", F.col("n")).otherwise(0),
        }
    ).drop("verdict")
    found = stored(templates(stored(paths, "paths")), "templates")
    found = found.select(F.col("host").alias("h"), F.col("path").alias("p"), "template", "purity")
    judged = rows.join(found, (F.col("host") == F.col("h")) & (F.col("path") == F.col("p")))
    method = F.when(F.col("purity") > IMPURE, "block").otherwise("allow")
    return judged.select(
        F.col("id").alias(id), "host", "path", rule.alias("rule"), F.coalesce(verdict, method).alias("verdict"), "template", "purity"
    )
