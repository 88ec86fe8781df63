"""URL verdicts from rules and, where no rule fits, from a tree of path templates per host.

Rules are hosts with a path prefix; the longest that fits decides.  The pages rules decide
are the labelled ones.  Digits in a segment become ``N``, and of every host a tree of path
templates is grown, a round for each level of branching:

* a node is opened while its labels support it: at least ``support`` of them, of both
  kinds, on more than one path.  What lies below any other node is one template;
* an opened node goes down to the first segment in which its paths differ.  Of the branches
  there, those whose share of blocked labels does not differ from the node's by ``z``
  standard errors (more among many branches, where some stand out by chance) are merged
  into one wildcard, and the others stay apart.

Neither depth nor width is limited: a branch that stands out among thousands is kept, and
a round goes on with opened nodes only.

A template is rejected if its blocked share among labelled pages, smoothed towards its
host's and that towards the whole, is above ``reject``.

Everything is DataFrame work on counts per host and generalised path, so a host with a
third of all pages is a few rows.

Defined results: null urls and those without ``://`` have an empty host and path; an empty
path is a template of its own; repeated rows are judged each for itself; without labelled
pages everything is allowed.  An empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm.queries import query
from clickloom.llm.shared import table, written

# The rules of the registered query.
RULES = {
    "org/": "allow",
    "example.org/es/": "block",
    "example.org/en/1": "block",
    "com/fr/": "allow",
    "com/de/": "block",
}
SUPPORT = 5
Z = 1.96
SMOOTHING = 5.0
REJECT = 0.5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    url = F.coalesce(url.cast("string"), F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), "^[^?#]*", 0)
    return F.translate(host, UPPER, LOWER), path


def matching_rule(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The longest rule that fits, or null."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=len):
        at, prefix = rule.split("/", 1)[0], "/" + rule.split("/", 1)[1]
        fits = ((host == at) | F.endswith(host, F.lit("." + at))) & F.startswith(path, F.lit(prefix))
        found = F.when(fits, rule).otherwise(found)
    return found


def shapes(path: Column) -> Column:
    """Generalised segments."""
    parts = F.split(F.regexp_replace(F.substr(path, F.lit(2)), "[0-9]+", "N"), "/")
    return F.when(path == "", F.array().cast("array<string>")).otherwise(parts)


def path_text(segments: Column) -> Column:
    """Segments as text, each with its slash before it."""
    return F.array_join(F.transform(segments, lambda part: F.concat(F.lit("/"), part)), "")


def left_of_path() -> Column:
    """What of a row's path lies below its node."""
    return F.slice("shape", F.col("level") + 1, F.size("shape"))


def nodes_of(rows: DataFrame, support: float) -> DataFrame:
    """(host, template, share, opened, same, fork, trunk) of every node; ``fork`` is where its paths part."""
    # The first and the last path in order agree on what all agree on.
    differs = F.transform(F.arrays_zip("low", "high"), lambda pair: ~pair["low"].eqNullSafe(pair["high"]))
    totals = rows.groupBy("host", "template", "level").agg(
        F.sum("labelled").alias("n"), F.sum("blocked").alias("k"), F.min(left_of_path()).alias("low"), F.max(left_of_path()).alias("high")
    )
    agree = F.array_position(differs, True).cast("int") - 1
    same = F.col("low") == F.col("high")
    opened = (F.col("n") >= support) & (F.col("k") > 0) & (F.col("k") < F.col("n")) & ~same
    return totals.select(
        "host", "template", (F.col("k") / F.greatest("n", F.lit(1))).alias("share"), opened.alias("opened"), same.alias("same"),
        (F.col("level") + agree).alias("fork"), F.when(opened, path_text(F.slice("low", F.lit(1), agree))).alias("trunk"),
    )


def grow(paths: DataFrame, support: float, z: float) -> DataFrame:
    """``paths`` (host, shape, labelled, blocked) with the template of each, round by round."""
    columns = ["host", "shape", "labelled", "blocked", "template"]
    left = written(paths.withColumns({"template": F.lit(""), "level": F.lit(0)}), "url-tree")
    grown = []
    while not left.isEmpty():
        rows = written(left.join(nodes_of(left, support), ["host", "template"]), "url-nodes")
        rest = F.when(F.col("same"), path_text(left_of_path()))
        rest = F.coalesce(rest, F.when(F.size("shape") > F.col("level"), F.lit("/**")), F.lit(""))
        grown.append(rows.where(~F.col("opened")).withColumn("template", F.concat("template", rest)).select(columns))
        rows = rows.where("opened").withColumn("segment", F.get("shape", F.col("fork")))
        ends = rows.where(F.col("segment").isNull()).withColumn("template", F.concat("template", "trunk"))
        grown.append(ends.select(columns))
        rows = rows.where(F.col("segment").isNotNull())
        branches = rows.groupBy("host", "template", "segment").agg(
            F.sum("labelled").alias("n"), F.sum("blocked").alias("k"), F.first("share").alias("share")
        )
        widths = branches.groupBy("host", "template").agg(F.count("*").alias("branches"))
        spread = F.greatest(F.lit(z), F.sqrt(2 * F.log(F.col("branches"))))
        off = F.abs(F.col("k") - F.col("n") * F.col("share"))
        alike = off <= spread * F.sqrt(F.col("n") * F.col("share") * (1 - F.col("share")))
        named = branches.join(widths, ["host", "template"]).select(
            "host", "template", "segment", F.when(alike & (F.col("branches") > 1), "*").otherwise(F.col("segment")).alias("branch")
        )
        left = written(
            rows.join(named, ["host", "template", "segment"])
            .withColumns({"template": F.concat("template", "trunk", F.lit("/"), "branch"), "level": F.col("fork") + 1})
            .select(*columns, "level"),
            "url-tree",
        )
    return reduce(DataFrame.unionByName, grown, paths.where("false").withColumn("template", F.lit("")))


def judge_urls(
    pages: DataFrame,
    rules: dict[str, str] | None = None,
    support: float = SUPPORT,
    z: float = Z,
    smoothing: float = SMOOTHING,
    reject: float = REJECT,
) -> DataFrame:
    """(page_id, host, path, rule, verdict, template, impurity), one row per page."""
    rules = RULES if rules is None else rules
    host, path = host_and_path(F.col("url"))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    rows = rows.withColumn("rule", matching_rule(F.col("host"), F.col("path"), rules))
    by_rule = F.lit(None).cast("string")
    for rule, verdict in rules.items():
        by_rule = F.when(F.col("rule") == rule, verdict).otherwise(by_rule)
    rows = rows.withColumns({"by_rule": by_rule, "shape": shapes(F.col("path"))})
    paths = rows.groupBy("host", "shape").agg(
        F.count("rule").alias("labelled"), F.count_if(F.col("by_rule") == "block").alias("blocked")
    )
    tree = grow(paths, support, z)
    counts = [F.sum(c).alias(c) for c in ("labelled", "blocked")]

    def smoothed(prior: Column) -> Column:
        return (F.col("blocked") + smoothing * prior) / (F.col("labelled") + smoothing)

    whole = tree.agg(*counts).select(
        (F.coalesce("blocked", F.lit(0)) / F.greatest(F.coalesce("labelled", F.lit(0)), F.lit(1))).alias("overall")
    )
    overall = whole.first()["overall"]  # one number
    hosts = tree.groupBy("host").agg(*counts).select("host", smoothed(F.lit(overall)).alias("of_host"))
    templates = (
        tree.groupBy("host", "template").agg(*counts).join(hosts, "host")
        .select("host", "template", smoothed(F.col("of_host")).alias("impurity"))
    )
    known = tree.select("host", "shape", "template").join(templates, ["host", "template"])
    verdict = F.coalesce("by_rule", F.when(F.col("impurity") > reject, "block").otherwise("allow"))
    return rows.join(known, ["host", "shape"], "left").select(
        "page_id", "host", "path", "rule", verdict.alias("verdict"), "template", "impurity"
    )


@query("op8_url_filters")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"))
