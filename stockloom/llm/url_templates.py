"""URL filter: rules first, then a tree of path templates per host, judged by labels.

Segments with digits are variable by their form. Level by level, segments with few labels,
or whose labels do not differ from their siblings', become one wildcard branch ``*``; those
that are clearly better than their siblings become another, ``{low}``. Levels go on as long
as a node with further segments has labels enough for a split; ``**`` stands for the rest.
Segments that all urls of a node share are taken in one step, however many they are.
A template's share of bad pages is smoothed towards its parent's, up to the host and all
hosts; templates above a limit are rejected.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockloom.llm.common import sql_text, staged


class Settings(NamedTuple):
    """Siblings are merged if the ``z`` value of their bad share against the others' is
    smaller, or with fewer than ``labels`` labels. ``weight`` is the parent's, in labels; a
    share of bad pages of at least ``limit`` is rejected. Below ``depth`` levels, a node with
    all labels of its parent keeps the parent's rate, so that a long path is no evidence.
    """

    depth: int = 4
    z: float = 2.58
    labels: int = 5
    weight: float = 4.0
    limit: float = 0.5


def split_url(url: Column) -> tuple[Column, Column]:
    """Host, A-Z lower-cased, and path; both empty for null or a url without ``://``."""
    url = F.coalesce(url, F.lit(""))
    place = F.instr(url, "://")
    rest = F.when(place > 0, F.substring(url, place + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return lower, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: dict[str, str]) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict, both null if none does.

    A rule ``host/path`` fits its host and all subdomains, if the path starts with the
    rule's. Rules become one expression, so they should be hundreds at most.
    """
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r), r)):
        of, _, start = rule.partition("/")
        fits = (F.concat(F.lit("."), host).endswith(f".{of}")) & path.startswith(f"/{start}")
        name = F.when(fits, F.lit(rule)).otherwise(name)
        verdict = F.when(fits, F.lit(rules[rule])).otherwise(verdict)
    return name, verdict


def shape(path: Column) -> Column:
    """Segments joined by ``/``, variable ones by their form."""
    segments = F.filter(F.split(path, "/"), lambda s: s != "")
    long_id = sql_text("^[0-9a-fA-F-]{16,}$")
    formed = F.transform(
        segments,
        lambda s: F.when(s.rlike(long_id[2:-1]), F.lit("#")).otherwise(
            F.regexp_replace(s, "[0-9]+", "#")
        ),
    )
    return F.array_join(formed, "/")


def _smoothed(bad: str, labels: str, prior: str, weight: float) -> Column:
    return F.expr(f"({bad} + {weight} * {prior}) / ({labels} + {weight})")


SEGMENTS = "if(shape = '', 0, size(split(shape, '/')))"


def _active(settings: Settings) -> str:
    """Whether a row goes on: it has segments, and its node's labels can change its rate."""
    return f"({SEGMENTS} > told and (told < {settings.depth} or held >= {settings.labels}))"


def _shared_steps(active: DataFrame, settings: Settings) -> DataFrame:
    """(host, prefix, steps, path, next_rate, next_held) of nodes with one child.

    All arrays between the least and the largest in order share what these two share. Rates
    change as they would segment by segment: each is smoothed towards the one before, but
    from ``depth`` on only if labels were lost.
    """
    rest = "slice(split(shape, '/'), told + 1, size(split(shape, '/')) - told)"
    nodes = (
        active.withColumn("rest", F.expr(rest))
        .groupBy("host", "prefix")
        .agg(
            F.min("rest").alias("least"),
            F.max("rest").alias("most"),
            F.sum("labels").alias("next_held"),
            F.sum("bad").alias("all_bad"),
            F.max("told").alias("told"),
            F.max("rate").alias("above"),
            F.max("held").alias("above_held"),
        )
    )
    differ = "array_position(zip_with(least, slice(most, 1, size(least)), (x, y) -> x <=> y), false)"
    # Few labels end the path at ``depth``, as they do where paths branch.
    most = f"if(next_held >= {settings.labels}, 2147483647, greatest({settings.depth} - told, 1))"
    shared = f"if({differ} > 0, {differ} - 1, least(size(least), size(most)))"
    first = f"if(told >= {settings.depth} and next_held = above_held, 0, 1)"
    times = f"{first} + greatest(least({settings.depth} - told, steps) - 1, 0)"
    share = "if(next_held > 0, all_bad / next_held, above)"
    kept = f"pow({settings.weight}D / (next_held + {settings.weight}D), {times})"
    return (
        nodes.withColumn("steps", F.expr(f"cast(least({shared}, {most}) as int)"))
        .filter("steps > 0")
        .select(
            "host",
            "prefix",
            "steps",
            F.expr("array_join(slice(least, 1, steps), '/')").alias("path"),
            F.expr(f"{share} + (above - {share}) * {kept}").alias("next_rate"),
            "next_held",
        )
    )


def _deeper(tree: DataFrame, settings: Settings) -> DataFrame:
    """The tree some levels deeper: prefixes get segments, rates their next node's."""
    sums = [F.sum(c).alias(c) for c in ("n", "labels", "bad")]
    shared = staged(_shared_steps(tree.filter(_active(settings)), settings), "shared-steps")
    tree = tree.join(shared, ["host", "prefix"], "left").withColumn(
        "segment",
        F.expr(f"if({_active(settings)} and steps is null, get(split(shape, '/'), told), null)"),
    )
    children = tree.filter("segment is not null").groupBy("host", "prefix", "segment").agg(*sums)
    parents = children.groupBy("host", "prefix").agg(
        *(F.sum(c).alias(f"all_{c}") for c in ("n", "labels", "bad")),
    )
    rest = "greatest(all_labels - labels, 1)"
    pooled = "(all_bad + 1) / (all_labels + 2)"
    difference = "((bad + 0.5) / (labels + 1) - (all_bad - bad + 0.5) / (all_labels - labels + 1))"
    error = f"sqrt({pooled} * (1 - {pooled}) * (1 / labels + 1 / {rest}))"
    similar = f"(labels < {settings.labels} or abs({difference}) < {settings.z} * {error})"
    tokens = children.join(parents, ["host", "prefix"]).select(
        "host",
        "prefix",
        "segment",
        F.expr(
            f"case when {similar} then '*' when {difference} < 0 then '{{low}}' else segment end"
        ).alias("token"),
    )
    # Rows that end at a node, or are closed, keep what they have.
    goes_on = F.expr(f"{_active(settings)} and steps is not null")
    grown = tree.join(tokens, ["host", "prefix", "segment"], "left").select(
        "host",
        "shape",
        "n",
        "labels",
        "bad",
        F.when(goes_on, F.concat_ws("/", "prefix", "path"))
        .when(F.col("token").isNotNull(), F.concat_ws("/", "prefix", "token"))
        .otherwise(F.col("prefix"))
        .alias("prefix"),
        F.when(goes_on, F.col("next_rate")).otherwise(F.col("rate")).alias("rate"),
        F.when(goes_on, F.col("next_held")).otherwise(F.col("held")).alias("held"),
        F.when(goes_on, F.col("told") + F.col("steps"))
        .when(F.col("token").isNotNull(), F.col("told") + 1)
        .otherwise(F.col("told"))
        .alias("told"),
        F.col("token").isNotNull().alias("branched"),
    )
    same = F.expr(f"told > {settings.depth} and labels = above_held")
    own = _smoothed("bad", "labels", "above", settings.weight)
    nodes = (
        grown.filter("branched")
        .groupBy("host", "prefix")
        .agg(
            *sums,
            F.max("rate").alias("above"),
            F.max("held").alias("above_held"),
            F.max("told").alias("told"),
        )
        .select(
            "host",
            "prefix",
            F.lit(True).alias("branched"),
            F.when(same, F.col("above")).otherwise(own).alias("own"),
            F.col("labels").alias("own_held"),
        )
    )
    return grown.join(nodes, ["host", "prefix", "branched"], "left").select(
        "host",
        "shape",
        "n",
        "labels",
        "bad",
        "prefix",
        F.coalesce("own", "rate").alias("rate"),
        F.coalesce("own_held", "held").alias("held"),
        "told",
    )


def template_tree(urls: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(host, shape, template, rate) for each shape of ``urls`` (host, path, bad).

    ``bad`` is 1, 0 or null where there is no label. Without any label all rates are 0.
    """
    shapes = (
        urls.select("host", shape(F.col("path")).alias("shape"), "bad")
        .groupBy("host", "shape")
        .agg(F.count("*").alias("n"), F.count("bad").alias("labels"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
    )
    shapes = staged(shapes, "shapes")
    labels, bad = shapes.agg(F.sum("labels"), F.sum("bad")).first()
    overall = (bad or 0) / labels if labels else 0.0
    hosts = (
        shapes.groupBy("host")
        .agg(F.sum("labels").alias("labels"), F.sum("bad").alias("bad"))
        .select(
            "host",
            _smoothed("bad", "labels", repr(float(overall)) + "D", settings.weight).alias("rate"),
            F.col("labels").alias("held"),
        )
    )
    tree = shapes.join(hosts, "host").withColumns({"prefix": F.lit(""), "told": F.lit(0)})
    while not tree.filter(_active(settings)).isEmpty():
        tree = staged(_deeper(tree, settings), "tree")
    rest = F.expr(f"if({SEGMENTS} > told, '/**', '')")
    return tree.select("host", "shape", F.concat("host", "prefix", rest).alias("template"), "rate")


def url_verdicts(
    urls: DataFrame, labels: DataFrame, rules: dict[str, str], settings: Settings = Settings()
) -> DataFrame:
    """One row per row of ``urls``: page_id, host, path, rule, verdict, template, rate.

    ``urls`` has page_id and url, ``labels`` page_id and bad (1 or 0); a page with several
    labels counts as bad if one is. Null urls and urls without host belong to the empty
    host. Null page_ids have no label. Repeated rows get equal verdicts and count each.
    Other columns are ignored.
    """
    host, path = split_url(F.col("url"))
    own = labels.filter("page_id is not null").groupBy("page_id").agg(F.max("bad").alias("bad"))
    split = urls.select("page_id", host.alias("host"), path.alias("path"))
    tree = template_tree(split.join(own, "page_id", "left"), settings)
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    method = F.when(F.col("rate") >= settings.limit, "block").otherwise("allow")
    return (
        split.withColumn("shape", shape(F.col("path")))
        .join(tree, ["host", "shape"], "left")
        .select(
            "page_id",
            "host",
            "path",
            rule.alias("rule"),
            F.coalesce(verdict, method).alias("verdict"),
            "template",
            F.round("rate", 6).alias("rate"),
        )
    )
