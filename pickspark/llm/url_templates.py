"""URL filter: given rules first, then a path-template tree learned from labelled pages.

Pages are counted by host and path once; the tree grows on those counts. *Downwards*, paths are read segment by
segment: a segment value that is rare among its siblings is variable and becomes a wildcard, frequent values stay
branches, so each path gets a template. *Upwards* from the deepest level, sibling branches (of one parent, with the same
ending) are merged in the order of their shares of bad pages: a branch joins the group before it unless its share differs
significantly from the group's pooled share, or a sub-branch that both have is bad in one and clean in the other. Merged
branches are one branch from then on: their subtrees are laid upon each other and their counts pooled. A template
is rejected if its merged path's share of bad pages, smoothed towards its host's and the whole table's, passes a threshold.

Each level counts before anything is joined, so a host with a third of all pages is never gathered in one task, and only
frequent values, at most ``1 / RARE`` for each place, are joined back. Siblings that stream through one task are the
branches of one place, not its pages.

Edge cases: a null url or one without ``://`` has empty host and path and fits no rule; an empty path is a
template of its own; paths are generalised to their last segment, and each level that ``FEW`` pages of one place
reach takes a few jobs, as does each level of the tree on the way back; repeated rows count each and get equal verdicts;
rows without an id are judged like others; of repeated ids each row is labelled; without labels nothing is rejected by the
method; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, written

#: Levels after which the rows are written, so that plans stay short on deep paths.
CUT = 6
#: A value is variable if it has less than this share of its siblings' rows, or fewer rows than this.
RARE, FEW = 0.02, 5
#: A sibling joins a group if its bad share differs from the group's by fewer standard errors than this.
ERRORS = 2.0
#: Weight, in rows, of the share a template is smoothed towards; and the share it is rejected from.
WEIGHT, REJECT = 8.0, 0.5
#: Bytes of a table of strings that may be sent to all executors; more is joined by shuffle.
MOST_SENT = 8 << 20

CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), CAPITALS, SMALL)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The longest rule that fits: ``host/path`` fits the host, its subdomains, and paths that begin so."""
    whens = F.lit(None).cast("string")
    for rule in sorted(rules, key=len):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        whens = F.when(fits, F.lit(rule)).otherwise(whens)
    return whens


def _joined(rows: DataFrame, values: DataFrame, on: list[str]) -> DataFrame:
    """Left join with a written table: sent to all if its measured size allows, else shuffled."""
    width = sum((F.coalesce(F.octet_length(F.col(c)), F.lit(0)) for c, t in values.dtypes if t == "string"), F.lit(16 + 8 * len(values.columns)))
    size = values.agg(F.sum(width.cast("long"))).first()[0] or 0
    return rows.join(F.broadcast(values) if size <= MOST_SENT else values, on, "left")


def _wildcard(part: Column) -> Column:
    kind = F.regexp_extract(part, r"(\.[A-Za-z]{1,5})?$", 0)  # a file name's ending stays
    return F.when(part == "", F.lit("")).otherwise(F.concat(F.lit("*"), kind))


def templated(paths: DataFrame, rare: float = RARE) -> DataFrame:
    """Add ``template``: the path with variable segments as ``*``. ``paths``: host, path, rows and more."""
    parts = F.split(F.expr("substring(path, 2)"), "/")
    rows = paths.withColumn("_parts", F.when(F.col("path") == "", F.array().cast("array<string>")).otherwise(parts)).withColumn("template", F.lit(""))
    level, ended = 0, []
    while True:
        part = F.get("_parts", F.lit(level))
        total = written(rows.where(part.isNotNull()).groupBy("host", "template").agg(F.sum("rows").alias("_total")), "places")
        if total.where(F.col("_total") >= FEW).isEmpty():
            break  # places only get smaller: no value can be frequent from here on
        rows = rows.withColumn("_part", part)
        here = rows.where(part.isNotNull()).groupBy("host", "template", "_part").agg(F.sum("rows").alias("_n"))
        often = (F.col("_n") >= F.greatest(rare * F.col("_total"), F.lit(FEW))).alias("_often")
        frequent = written(_joined(here, total, ["host", "template"]).select("host", "template", "_part", often).where("_often"), "branches")
        shape = F.when(F.col("_often"), F.col("_part")).otherwise(_wildcard(F.col("_part")))
        rows = _joined(rows, frequent, ["host", "template", "_part"]).withColumn("template", F.when(F.col("_part").isNull(), F.col("template")).otherwise(F.concat("template", F.lit("/"), shape))).drop("_often", "_part")
        level += 1
        if level % CUT == 0:
            rows = written(rows, "levels")
            ended.append(rows.where(F.size("_parts") <= level))
            rows = rows.where(F.size("_parts") > level)
    rest = F.slice("_parts", F.lit(level + 1), F.greatest(F.size("_parts") - level, F.lit(0)))
    rows = rows.withColumn("template", F.concat("template", F.array_join(F.transform(rest, lambda p: F.concat(F.lit("/"), _wildcard(p))), "")))
    return reduce(DataFrame.unionByName, [rows, *ended]).drop("_parts")


def apart(n: int, k: int, pool_n: int, pool_k: int) -> float:
    """By how many standard errors two shares differ, each with two rows more, one of them bad."""
    p, q = (k + 1) / (n + 2), (pool_k + 1) / (pool_n + 2)
    return abs(p - q) / math.sqrt(p * (1 - p) / (n + 2) + q * (1 - q) / (pool_n + 2))


def merged(nodes: DataFrame, prior: float, errors: float = ERRORS, weight: float = WEIGHT, reject: float = REJECT) -> DataFrame:
    """``name`` (the smallest segment of its group) and ``bad`` (whether the group's smoothed share is rejected) of each
    branch. ``nodes``: host, parent, segment, n, k, below (array of name and bad of the sub-branches)."""
    raw = (F.col("k") + prior * weight) / (F.col("n") + weight)
    placed = nodes.withColumns({"_share": raw, "_ending": F.regexp_extract("segment", r"\.[A-Za-z]{1,5}$", 0)})
    names = ["host", "parent", "_ending", "segment", "n", "k", "below"]

    def named(group: list[tuple]) -> list[tuple]:
        if not group:
            return []
        n, k = sum(r[4] for r in group), sum(r[5] for r in group)
        name, bad = min(r[3] for r in group), (k + prior * weight) / (n + weight) >= reject
        return [(r[0], r[1], r[3], name, bad) for r in group]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[tuple] = []
        below: dict[str, bool] = {}
        n = k = 0
        for batch in batches:
            out: list[tuple] = []
            for row in zip(*(batch.column(c).to_pylist() for c in names)):
                own = {x["name"]: x["bad"] for x in row[6]}
                fits = group and row[:3] == group[0][:3] and apart(row[4], row[5], n, k) <= errors and all(below.get(x, bad) == bad for x, bad in own.items())
                if not fits:
                    out += named(group)
                    group, below, n, k = [], {}, 0, 0
                group.append(row)
                below |= own
                n, k = n + row[4], k + row[5]
            yield table(out)
        yield table(named(group))

    def table(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.string()] * 4 + [pa.bool_()]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names=["host", "parent", "segment", "name", "bad"])

    streamed = placed.repartition("host", "parent", "_ending").sortWithinPartitions("host", "parent", "_ending", "_share", "segment")
    return streamed.select(*names).mapInArrow(run, "host string, parent string, segment string, name string, bad boolean")


def purity(leaves: DataFrame, errors: float = ERRORS, weight: float = WEIGHT, reject: float = REJECT) -> DataFrame:
    """``bad_share`` and ``merged`` (the path after merging) of each (host, template). ``leaves``: host, template, n
    (labelled pages), k (bad ones)."""
    scratch = Scratch(leaves.sparkSession, "templates")
    counts = scratch.put(leaves.groupBy("host", "template").agg(F.sum("n").alias("n"), F.sum("k").alias("k")).withColumns({"way": F.split("template", "/"), "below": F.lit(False)}), "leaves")
    total = counts.agg(F.sum("n").alias("n"), F.sum("k").alias("k"), F.max(F.size("way")).alias("levels")).first()
    prior = (total.k or 0) / total.n if total.n else 0.0
    # The first part of a way is the empty root. Where no place has two branches there is nothing to merge: the deepest
    # level that has such a place comes first, after the one below it, whose branches say if they are bad.
    each = counts.where("size(way) > 1").select("host", "way", F.explode(F.sequence(F.lit(1), F.size("way") - 1)).alias("_level"))
    places = each.select("host", "_level", F.xxhash64(F.slice("way", F.lit(1), F.col("_level"))).alias("_place"), F.get("way", F.col("_level")).alias("_segment"))
    split = places.groupBy("host", "_level", "_place").agg(F.min("_segment").alias("a"), F.max("_segment").alias("b")).where("a <> b").agg(F.max("_level")).first()[0] or 0
    for level in range(min((total.levels or 1) - 1, split + 1 if split else 0), 0, -1):
        here = F.get("way", F.lit(level))
        parent = F.array_join(F.slice("way", 1, level), "/")
        rows = counts.withColumns({"parent": parent, "segment": here, "_next": F.get("way", F.lit(level + 1))})
        child = F.when(F.col("_next").isNotNull(), F.struct(F.col("_next").alias("name"), F.col("below").alias("bad")))
        nodes = rows.where(here.isNotNull()).groupBy("host", "parent", "segment").agg(F.sum("n").alias("n"), F.sum("k").alias("k"), F.array_sort(F.collect_set(child)).alias("below"))
        names = scratch.put(merged(nodes, prior, errors, weight, reject), "names")
        renamed = _joined(rows, names, ["host", "parent", "segment"])
        way = F.when(F.col("name").isNull(), F.col("way")).otherwise(F.concat(F.slice("way", 1, level), F.array("name"), F.slice("way", level + 2, F.size("way"))))
        counts = scratch.put(renamed.select("host", "template", "n", "k", way.alias("way"), F.coalesce("bad", F.lit(False)).alias("below")), "leaves")
    final = counts.select("host", "template", "n", "k", F.array_join("way", "/").alias("merged"))
    host = final.groupBy("host").agg(((F.sum("k") + prior * weight) / (F.sum("n") + weight)).alias("_host"))
    pool = Window.partitionBy("host", "merged")
    pooled = final.select("host", "template", "merged", F.sum("n").over(pool).alias("n"), F.sum("k").over(pool).alias("k")).join(host, "host")
    return pooled.select("host", "template", "merged", ((F.col("k") + F.col("_host") * weight) / (F.col("n") + weight)).alias("bad_share"))


def judged(pages: DataFrame, labelled: DataFrame, rules: dict[str, str], id_col: str = "page_id", url_col: str = "url", reject: float = REJECT) -> DataFrame:
    """``id_col``, ``host``, ``path``, ``rule``, ``verdict``, ``template``, ``merged`` and ``bad_share``.

    ``labelled``: page ids and ``bad`` (0 or 1), one row a page at most. ``rules``: 'host/path' to 'allow' or
    'block'."""
    read = pages.select(F.col(id_col), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    bad = labelled.select(F.col(id_col), F.col("bad").cast("int").alias("bad"))
    rows = written(read.join(bad, id_col, "left"), "pages")
    paths = rows.groupBy("host", "path").agg(F.count("*").alias("rows"), F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("k"))
    found = written(templated(written(paths, "paths")), "templated")
    shares = written(purity(found.select("host", "template", "n", "k"), reject=reject), "purity")
    own = F.when(F.col("bad_share") >= reject, F.lit("block")).otherwise(F.lit("allow"))
    rule = rule_of(F.col("host"), F.col("path"), rules)
    by_rule = reduce(lambda c, r: F.when(F.col("rule") == r, F.lit(rules[r])).otherwise(c), rules, F.lit(None).cast("string"))
    judged_paths = written(_joined(found.select("host", "path", "template"), shares, ["host", "template"]), "judged")
    out = _joined(rows, judged_paths, ["host", "path"]).withColumn("rule", rule)
    return out.select(id_col, "host", "path", "rule", F.coalesce(by_rule, own).alias("verdict"), "template", "merged", "bad_share")


#: The rules of the query.
RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}


def pages_judged(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """Pages show a document, whose id is the last number of their path; its label is the page's. A page is bad
    if its document is of low quality or toxic."""
    shown = pages.select("page_id", F.expr(r"try_cast(regexp_extract(url, '://[^?#]*?([0-9]+)[^0-9?#]*([?#]|$)', 1) as bigint)").alias("doc_id")).dropna()
    bad = labels.select("doc_id", F.expr("cast(quality = 0 or toxic = 1 as int)").alias("bad")).dropna().groupBy("doc_id").agg(F.max("bad").alias("bad"))
    labelled = shown.join(bad, "doc_id").groupBy("page_id").agg(F.max("bad").alias("bad"))
    return judged(pages, labelled, RULES)
