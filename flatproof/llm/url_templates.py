"""URL filter: rules by host and path, and for all other URLs a tree of path templates per host.

The tree has one level per path segment. A segment that is a number, a hash or a date is a wildcard at once; at every
node of the tree that has many children with few pages each, the children become one wildcard branch, except those with
labels enough that differ from the others. Siblings whose labelled pages do not differ significantly are merged into the
wildcard branch as well. A template is rejected by the
share of bad pages among its labelled ones, smoothed towards that of its host's other templates, which is smoothed
towards that of all pages.

Labels come by page id. All work runs on one row per distinct (host, path shape); pages are joined to their template
at the end by that key, on plain columns, so that adaptive execution can split a host that holds a third of all rows.
Only DataFrame operations are used.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import pack, stage, unpack

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


#: The rules of the registered query.
RULES = (
    Rule("block", "net", "/"),
    Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"),
    Rule("allow", "org", "/fr/"),
)


def url_host(url: Column) -> Column:
    """From behind the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def url_path(url: Column) -> Column:
    """From behind the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: tuple[Rule, ...]) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict, or nulls. ``rules`` is a short list; each is one branch."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        name = F.when(fits, F.lit(rule.text)).otherwise(name)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return name, verdict


def path_shape(path: Column) -> Column:
    """The segments of a path; segments that look variable are replaced by their kind, a file ending stays."""
    shape = F.regexp_replace(path, r"(?<=/)\d{4}-\d{2}-\d{2}(?=/|\.|$)", "{date}")
    shape = F.regexp_replace(shape, r"(?<=/)\d+(?=/|\.|$)", "{num}")
    shape = F.regexp_replace(shape, r"(?<=/)[0-9a-fA-F]{8}[0-9a-fA-F-]*(?=/|\.|$)", "{hex}")
    return F.filter(F.split(shape, "/"), lambda s: s != "")


def _differs(bad: Column, labelled: Column, bad_all: Column, labelled_all: Column, z: float) -> Column:
    """Whether a branch's bad share differs from that of its siblings by a two-sample test."""
    rest, bad_rest = labelled_all - labelled, bad_all - bad
    share, share_rest, pooled = (F.try_divide(a, b) for a, b in ((bad, labelled), (bad_rest, rest), (bad_all, labelled_all)))
    error = F.sqrt(pooled * (1 - pooled) * (F.try_divide(F.lit(1), labelled) + F.try_divide(F.lit(1), rest)))
    # Null where either side has no labels.
    return F.coalesce((error > 0) & (F.abs(share - share_rest) > z * error), F.lit(False))


def _rest() -> Column:
    """The segments of a shape that no template has taken up yet."""
    return F.slice("shape", F.col("_at") + 1, F.greatest(F.size("shape") - F.col("_at"), F.lit(0)))


def _common(a: Column, b: Column) -> Column:
    """How many segments two lists have in common from their start."""
    agree = F.zip_with(a, b, lambda x, y: x.eqNullSafe(y))
    first = F.array_position(agree, F.lit(False))
    return F.when(first > 0, first - 1).otherwise(F.size(a)).cast("int")


def _left(tree: DataFrame) -> int:
    return tree.agg(F.max(F.size("shape") - F.col("_at"))).first()[0] or 0


def template_tree(
    shapes: DataFrame, max_depth: int = 6, min_children: int = 8, min_pages: float = 3.0, z: float = 2.58, min_own: int = 4
) -> DataFrame:
    """Adds ``template`` to rows of ``host, shape, pages, labelled, bad``, one row per distinct host and shape.

    Level by level, the children of a node are counted; rows are distinct shapes and not pages. More than
    ``min_children`` children with fewer than ``min_pages`` pages each on average are a variable segment, in which only
    children with ``min_own`` labels or more stand alone; with fewer, their own labels could not outweigh the smoothing of
    :func:`template_verdicts`. Siblings that do not differ by ``z`` standard errors are merged. Below ``max_depth`` levels
    only open nodes go on, as far as their paths do: those with several shapes and labels of both kinds, and more labels
    than ``z`` squared, without which no share of them can differ. In all others what follows is the single tail ``**``.
    There, what all shapes of a node have in common is taken up in one step, so that the steps count branches and not
    levels. Each step is written out; one number per step reaches the driver, how far paths still go.
    """
    tree, ended = shapes.withColumns({"template": F.lit(""), "_at": F.lit(0)}), []
    depth = 0
    while _left(tree) > 0:
        if depth >= max_depth:
            nodes = tree.groupBy("host", "template").agg(
                F.count("*").alias("_n"), F.max(F.size("shape") - F.col("_at")).alias("_more"),
                F.sum("labelled").alias("_l"), F.sum("bad").alias("_b"), F.min(_rest()).alias("_lo"), F.max(_rest()).alias("_hi"),
            )
            both = (F.col("_b") > 0) & (F.col("_b") < F.col("_l")) & (F.col("_l") > z * z)
            is_open = (F.col("_n") > 1) & (F.col("_more") > 0) & both
            going = nodes.where(is_open).select("host", "template", _common(F.col("_lo"), F.col("_hi")).alias("_skip"))
            going = stage(going, "open-nodes")
            tail = F.when(F.size("shape") > F.col("_at"), F.lit("/**")).otherwise(F.lit(""))
            closed = tree.join(going, ["host", "template"], "left_anti")
            ended.append(closed.withColumn("template", F.concat("template", tail)))
            same = F.transform(F.slice("shape", F.col("_at") + 1, F.col("_skip")), lambda x: F.concat(F.lit("/"), x))
            tree = tree.join(going, ["host", "template"]).withColumns(
                {"template": F.concat("template", F.array_join(same, "")), "_at": F.col("_at") + F.col("_skip")}
            )
            tree = stage(tree.drop("_skip"), "tree")
            if _left(tree) <= 0:
                break
        tree = tree.withColumn("_segment", F.coalesce(F.get(F.col("shape"), F.col("_at")), F.lit("")))
        children = tree.groupBy("host", "template", "_segment").agg(
            *[F.sum(c).alias("_" + c) for c in ("pages", "labelled", "bad")]
        )
        nodes = children.groupBy("host", "template").agg(
            F.count_if(F.col("_segment") != "").alias("_n"), F.sum("_pages").alias("_all"),
            F.sum("_labelled").alias("_l"), F.sum("_bad").alias("_b"),
        )
        variable = (F.col("_n") > min_children) & (F.col("_all") < min_pages * F.col("_n"))
        apart = _differs(F.col("_bad"), F.col("_labelled"), F.col("_b"), F.col("_l"), z)
        kept = (F.col("_n") == 1) | (apart & (~variable | (F.col("_labelled") >= min_own)))
        part = F.when(F.col("_segment") == "", F.lit("")).otherwise(
            F.concat(F.lit("/"), F.when(kept, F.col("_segment")).otherwise(F.lit("*")))
        )
        names = children.join(nodes, ["host", "template"]).select("host", "template", "_segment", part.alias("_part"))
        tree = tree.join(names, ["host", "template", "_segment"]).withColumns(
            {"template": F.concat("template", "_part"), "_at": F.col("_at") + 1}
        )
        tree = stage(tree.drop("_part", "_segment"), "tree")
        depth += 1
    for rows in ended:
        tree = tree.unionByName(rows)
    return tree.drop("_at")


def template_verdicts(tree: DataFrame, weight: float = 4.0, threshold: float = 0.5) -> DataFrame:
    """``template_bad`` (smoothed share of bad pages) and ``template_verdict`` per host and shape."""
    totals = tree.groupBy("host", "template").agg(F.sum("labelled").alias("_own_l"), F.sum("bad").alias("_own_b"))
    hosts = totals.groupBy("host").agg(F.sum("_own_l").alias("_host_l"), F.sum("_own_b").alias("_host_b"))
    every = hosts.agg(F.sum("_host_l").alias("_all_l"), F.sum("_host_b").alias("_all_b"))
    # One row.
    hosts = hosts.crossJoin(F.broadcast(every))
    base = F.coalesce(F.try_divide("_all_b", "_all_l"), F.lit(0.0))
    hosts = hosts.select("host", "_host_l", "_host_b", base.alias("_base"))
    # The host's share without the template's own pages, which count once.
    others_l, others_b = F.col("_host_l") - F.col("_own_l"), F.col("_host_b") - F.col("_own_b")
    host_share = (others_b + weight * F.col("_base")) / (others_l + weight)
    share = (F.col("_own_b") + weight * host_share) / (F.col("_own_l") + weight)
    judged = totals.join(hosts, "host").select("host", "template", share.alias("template_bad"))
    verdict = F.when(F.col("template_bad") >= threshold, F.lit("block")).otherwise(F.lit("allow"))
    return tree.select("host", "shape", "template").join(judged, ["host", "template"]).withColumn("template_verdict", verdict)


def filter_urls(
    pages: DataFrame,
    labels: DataFrame,
    rules: tuple[Rule, ...] = RULES,
    id_col: str = "page_id",
    url_col: str = "url",
) -> DataFrame:
    """Each page with ``host, path, rule, template, template_bad, verdict``; these replace columns of the same names.

    ``labels`` has ``id`` and ``bad`` (boolean); several labels of one id count as bad if any is. A null URL or one
    without ``://`` has an empty host and path and forms a template of its own. Without any labelled page all shares
    are 0 and everything that no rule blocks is allowed. Repeated pages get the same row each.
    """
    spark = pages.sparkSession
    host, path = url_host(F.col(url_col)), url_path(F.col(url_col))
    found = pack(pages, id=F.col(id_col), host=host, path=path)
    narrow = pages.select(F.col(id_col).alias("id"), host.alias("host"), path_shape(path).alias("shape"))
    marks = labels.where(F.col("id").isNotNull()).groupBy("id").agg(F.max(F.col("bad").cast("int")).alias("bad"))
    shapes = narrow.join(marks, "id", "left").groupBy("host", "shape").agg(
        F.count("*").alias("pages"), F.count("bad").alias("labelled"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")
    )
    verdicts = template_verdicts(template_tree(stage(shapes, "shapes")))
    verdicts = stage(verdicts.withColumnRenamed("host", "_h").withColumnRenamed("shape", "_s"), "templates")
    name, ruled = rule_of(F.col("host"), F.col("path"), rules)
    judged = found.withColumn("_shape", path_shape(F.col("path"))).join(
        verdicts, (F.col("host") == F.col("_h")) & (F.col("_shape") == F.col("_s")), "left"
    )
    return unpack(
        judged, pages.columns, host=F.col("host"), path=F.col("path"), rule=name, template=F.col("template"),
        template_bad=F.col("template_bad"), verdict=F.coalesce(ruled, F.col("template_verdict")),
    )


def op5_url_templates(spark, sf_dir):
    """Pages carry labels by id: low quality or toxic counts as bad."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    bad = labels.select(F.col("doc_id").alias("id"), ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad"))
    return filter_urls(pages, bad).select("page_id", "host", "path", "rule", "verdict")
