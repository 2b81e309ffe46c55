"""Mentions: aggregation, weights, ranks and tiers of document-to-entity links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillgraph.functions import text as T


def aggregate(raw: DataFrame) -> DataFrame:
    """(source, target, n, in_lead), one row for each pair."""
    return raw.groupBy("source", "target").agg(F.count("*").alias("n"), F.bool_or("in_lead").alias("in_lead"))


def document_frequency(mentions: DataFrame) -> DataFrame:
    return mentions.groupBy("target").agg(F.count("*").alias("df"))


def weighted(mentions: DataFrame, generic_share: float = 0.05, media: Column | None = None) -> DataFrame:
    """With df, weight and generic; the number of sources is one row, joined as a scalar."""
    total = mentions.agg(F.count_distinct("source")).scalar()
    joined = mentions.join(document_frequency(mentions), "target")
    weight = F.sqrt(F.least("n", F.lit(5))) * F.when(F.col("in_lead"), 2.0).otherwise(1.0) * (F.log((total + 1) / (F.col("df") + 1)) + 0.1)
    return joined.withColumns({"weight": F.round(weight, 3), "generic": (F.lit(False) if media is None else media) | (F.col("df") > generic_share * total)})


def min_support(mentions: DataFrame, least: int) -> DataFrame:
    """Mentions of targets that at least so many sources have: aggregated before anything is joined."""
    return mentions.join(document_frequency(mentions).filter(F.col("df") >= least).select("target"), "target", "left_semi")


def base_score(n: Column, in_lead: Column, df: Column, total: Column, prior: Column) -> Column:
    return F.sqrt(F.least(n, F.lit(5))) * F.when(in_lead, 2.0).otherwise(1.0) * F.log((total + 1) / (df + 1)) * prior


def specificity(inlinks: Column) -> Column:
    return F.greatest(F.lit(0.4), F.least(F.lit(1.8), F.log(F.lit(20000.0)) / F.log(20 + inlinks)))


def ranked(scored: DataFrame, core: int = 20, least: float = 1.0) -> DataFrame:
    """With a 0-based rank by score and its tier; ties by target."""
    order = Window.partitionBy("source").orderBy(F.desc("score"), "target")
    out = scored.withColumn("rank", F.row_number().over(order) - 1)
    return out.withColumn("tier", F.when((F.col("rank") < core) & (F.col("score") >= least), "core").otherwise("extended"))


def top(scored: DataFrame, k: int, by: str = "score") -> DataFrame:
    order = Window.partitionBy("source").orderBy(F.desc(by), "target")
    return scored.withColumn("rn", F.row_number().over(order)).filter(F.col("rn") <= k)


def mention_code(in_lead: Column, n: Column) -> Column:
    return F.concat(F.when(in_lead, "L").otherwise(""), n.cast("string"))


def parse_links(docs: DataFrame, key: str, markup: str) -> DataFrame:
    """(source, target, n, in_lead) of the links in wiki markup, without comments, references, templates and end sections."""
    text = docs.select(F.col(key).alias("source"), T.body(T.strip_templates(T.strip_markup(F.col(markup)))).alias("text"))
    parts = text.withColumn("lead", T.lead(F.col("text")))
    rest = F.col("text").substr(F.length("lead") + 1, F.length("text"))
    tagged = lambda c, flag: F.transform(T.link_targets(c), lambda t: F.struct(t.alias("target"), F.lit(flag).alias("in_lead")))
    return aggregate(parts.select("source", F.explode(F.concat(tagged(F.col("lead"), True), tagged(rest, False))).alias("l")).select("source", "l.*"))
