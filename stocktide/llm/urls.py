"""URL filters: explicit rules first, then the purity of path templates.

Pages that a rule decides are the labelled ones. For the rest, paths are
generalised to templates in a tree per host, level by level:

- runs of digits become ``#``;
- below a node with more than ``MAX_CHILDREN`` different segments, those with
  less than ``MIN_SHARE`` of its pages become ``*``;
- of the segments left, the largest leads, and those whose pages do not differ
  from its own by a chi-square test (over what follows, and over the labels) are
  merged with it; the largest of the rest leads next, until none is left. The
  step before bounds the segments of a node and so the rounds.

A template is rejected if the share of blocked pages among its labelled ones,
smoothed by ``WEIGHT`` pages of a half, reaches ``PURITY``.

The tree lives in tables of distinct paths with counts; a level is a few joins on
(host, prefix), so a host with a third of all pages is spread over its paths.

Defined cases: a null url, or one without ``://``, has an empty host and path;
segments beyond ``DEPTH`` are kept together as one; repeated pages count as often
as they occur; rules of equal length: block before allow, then by text; a null
page id stays null; an empty table gives an empty table; further columns are not
read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stocktide.session import materialize

DEPTH = 8
MAX_CHILDREN = 20
MIN_SHARE = 0.05
SIGMAS = 3.0
WEIGHT = 4.0
PURITY = 0.9
END = "$"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    there = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(there > 0, F.substr(url, there + 3)).otherwise(F.lit(""))
    return F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """Longest fitting rule (``host/path``) and its verdict, from a short list of (verdict, rule)."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for decision, text in sorted(rules, key=lambda r: (len(r[1]), r[0] == "block", r[1])):
        name, slash, tail = text.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(slash + tail)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(decision)).otherwise(verdict)
    return rule, verdict


def masked(path: Column) -> Column:
    return F.regexp_replace(path, "[0-9]+", "#")


def _segments(path: Column) -> Column:
    """Segments after the first slash; the last one holds all beyond ``DEPTH``."""
    return F.split(F.regexp_replace(path, "^/", ""), "/", DEPTH)


def _shape(segment: Column) -> Column:
    return F.regexp_replace(segment, r"\p{L}+", "w")


def _wild(paths: DataFrame, level: int) -> DataFrame:
    """``seg``: the segment at the level, or ``*`` where it is one of very many."""
    node = ["host", "prefix"]
    paths = paths.withColumn("seg", F.coalesce(F.get("rest", F.lit(level)), F.lit(END)))
    children = paths.groupBy(*node, "seg").agg(F.sum("n").alias("child_n"))
    nodes = children.groupBy(*node).agg(F.count("*").alias("children"), F.sum("child_n").alias("node_n"))
    rare = children.join(nodes.where(F.col("children") > MAX_CHILDREN), node).where(F.col("child_n") < MIN_SHARE * F.col("node_n"))
    flagged = paths.join(rare.select(*node, "seg", F.lit(True).alias("rare")), [*node, "seg"], "left")
    return flagged.withColumn("seg", F.when(F.col("rare"), F.lit("*")).otherwise(F.col("seg"))).drop("rare")


def _merge(paths: DataFrame, level: int) -> DataFrame:
    """``to``: the segment that leads the one at the level, for (host, prefix, segment)."""
    node = ["host", "prefix"]
    after = _shape(F.coalesce(F.get("rest", F.lit(level + 1)), F.lit(END)))
    kinds = [("b", F.col("blocked")), ("a", F.col("allowed")), ("u", F.col("n") - F.col("blocked") - F.col("allowed"))]
    profile = paths.where(~F.col("seg").isin("*", END))
    profile = profile.select(*node, "seg", after.alias("after"), F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), c.alias("n")) for k, c in kinds])).alias("e"))
    profile = profile.groupBy(*node, "seg", "after", F.col("e.kind").alias("kind")).agg(F.sum("e.n").alias("o")).where("o > 0")
    profile = materialize(profile, "branches")
    merged = None
    while merged is None or not profile.isEmpty():
        sizes = profile.groupBy(*node, "seg").agg(F.sum("o").alias("child_n"))
        leaders = sizes.groupBy(*node).agg(F.max_by(F.struct("seg", "child_n"), F.struct("child_n", "seg")).alias("l")).select(*node, F.col("l.seg").alias("to"), F.col("l.child_n").alias("lead_n"))
        lead = profile.withColumnRenamed("seg", "to").join(leaders, [*node, "to"]).select(*node, "after", "kind", F.col("o").alias("lead_o"))
        cells = profile.join(sizes, [*node, "seg"]).join(leaders, node).join(lead, [*node, "after", "kind"], "left").fillna(0, ["lead_o"])
        ratio = F.sqrt(F.col("lead_n") / F.col("child_n"))
        cell = F.pow(F.col("o") * ratio - F.col("lead_o") / ratio, 2) / (F.col("o") + F.col("lead_o"))
        tested = cells.groupBy(*node, "seg", "to", "child_n", "lead_n").agg(F.sum(cell).alias("x"), F.sum("lead_o").alias("met"), F.count("*").alias("k"))
        # Cells that only the leader has add what they hold, scaled; they count as one more cell.
        chi = F.col("x") + (F.col("lead_n") - F.col("met")) * F.col("child_n") / F.col("lead_n")
        free = F.greatest(F.col("k") - 1 + (F.col("met") < F.col("lead_n")).cast("int"), F.lit(1))
        same = tested.where((F.col("seg") == F.col("to")) | (chi <= free + SIGMAS * F.sqrt(2.0 * free))).select(*node, "seg", "to")
        same = materialize(same, "merged")
        merged = same if merged is None else merged.union(same)
        profile = materialize(profile.join(same, [*node, "seg"], "left_anti"), "branches")
    return merged


def templates(pages: DataFrame) -> DataFrame:
    """``template`` and ``purity`` of each distinct ``host`` and ``masked`` path of ``pages`` (``host``, ``path``, ``verdict``)."""
    count = lambda v: F.sum((F.col("verdict") == v).cast("int"))
    paths = pages.groupBy("host", masked(F.col("path")).alias("masked")).agg(
        F.count("*").alias("n"), F.coalesce(count("block"), F.lit(0)).alias("blocked"), F.coalesce(count("allow"), F.lit(0)).alias("allowed")
    )
    paths = materialize(paths.withColumns({"rest": _segments(F.col("masked")), "prefix": F.lit("")}), "paths")
    deepest = paths.agg(F.max(F.size("rest"))).first()[0] or 0
    for level in range(deepest):
        wild = materialize(_wild(paths, level), "wild")
        merged = _merge(wild, level)
        several = merged.groupBy("host", "prefix", "to").agg((F.count("*") > 1).alias("several"))
        named = merged.join(several, ["host", "prefix", "to"]).where("several").select("host", "prefix", "seg", F.concat(F.lit("*"), "to").alias("name"))
        step = wild.join(named, ["host", "prefix", "seg"], "left")
        step = step.withColumn("prefix", F.when(F.col("seg") == END, F.col("prefix")).otherwise(F.concat("prefix", F.lit("/"), F.coalesce("name", "seg"))))
        paths = materialize(step.drop("seg", "name"), "paths")
    whole = paths.groupBy("host", "prefix").agg(F.sum("blocked").alias("b"), F.sum("allowed").alias("a"))
    purity = (F.col("b") + WEIGHT / 2) / (F.col("b") + F.col("a") + WEIGHT)
    return paths.join(whole.withColumn("purity", purity), ["host", "prefix"]).select("host", "masked", F.col("prefix").alias("template"), "purity")


def judge(pages: DataFrame, rules: list[tuple[str, str]], key: str = "page_id", url: str = "url") -> DataFrame:
    """``key``, ``host``, ``path``, ``rule``, ``verdict``, ``template`` and ``purity`` of every page."""
    host, path = host_and_path(F.col(url))
    parsed = pages.select(key, host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    parsed = parsed.withColumns({"rule": rule, "verdict": verdict})
    known = templates(parsed)
    judged = parsed.withColumn("masked", masked(F.col("path"))).join(known, ["host", "masked"])
    method = F.when(F.col("purity") >= PURITY, F.lit("block")).otherwise(F.lit("allow"))
    return judged.select(key, "host", "path", "rule", F.coalesce("verdict", method).alias("verdict"), "template", "purity")
