"""Rule cascades, unions with provenance, precedence lookups and review merges."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillgraph.operators.rounds import settle


def blank_to_null(c: Column) -> Column:
    """Empty text counts as missing wherever a fallback follows."""
    return F.nullif(c, F.lit(""))


def first_present(*columns: Column) -> Column:
    return F.coalesce(*[blank_to_null(c) for c in columns])


def cascade(rules: list[tuple[Column, str]], otherwise: str | None = None) -> Column:
    """The name of the first rule that holds."""
    out = reduce(lambda acc, r: acc.when(r[0], r[1]) if acc is not None else F.when(r[0], r[1]), rules, None)
    return out.otherwise(F.lit(otherwise))


def role(override: Column, manual: Column, listlike: Column, kind: Column, score: Column, clean: Column, confidence: Column) -> Column:
    """theory, related or dropped: the first of nine ordered rules; an override comes before all of them."""
    supported = (score >= 2) | (clean & (score >= 1))
    solid = kind.isin("person", "organization", "work", "media", "place")
    rules = [(manual, "theory"), (listlike, "dropped"), (solid & supported, "related"), (solid, "dropped"), (kind == "theory", "theory"), ((kind == "theory?") & (clean | (score >= 1)), "theory"), ((confidence >= 3) & kind.isin("concept", "theory?"), "theory"), (supported, "related")]
    return F.coalesce(blank_to_null(override), cascade(rules, "dropped"))


def union_with_sources(parts: dict[str, DataFrame], key: str = "title") -> DataFrame:
    """(key, sources, confidence) of several lists: 2 for category, 2 for wikidata, 1 for list_page, 5 for manual."""
    tagged = reduce(DataFrame.unionByName, [df.select(key, F.lit(tag).alias("source")) for tag, df in parts.items()])
    merged = tagged.groupBy(key).agg(F.array_sort(F.collect_set("source")).alias("sources"))
    points = {"category": 2, "wikidata": 2, "list_page": 1, "manual": 5}
    return merged.withColumn("confidence", reduce(Column.__add__, [F.array_contains("sources", tag).cast("int") * n for tag, n in points.items()]))


def first_wins(df: DataFrame, key: str, order: list) -> DataFrame:
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(key).orderBy(*order))).filter("_rn = 1").drop("_rn")


def last_wins(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The whole row of the largest order, by one partial aggregation instead of a sort."""
    others = [c for c in df.columns if c != key]
    best = df.groupBy(key).agg(F.max_by(F.struct(*others), F.struct(*order)).alias("best"))
    return best.select(key, *[F.col(f"best.{c}") for c in others])


def running(df: DataFrame, order: list, amount: Column) -> DataFrame:
    """df with `before`, the sum of amount over the rows before each in order, without one task for all rows: sums of
    ranges first, then sums in them. The ranged rows are written with their part, as both read them."""
    ranged = settle(df.withColumn("_amount", amount).repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    upto = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = ranged.withColumn("_own", F.coalesce(F.sum("_amount").over(upto), F.lit(0)))
    # a row for each part
    sums = local.groupBy("_part").agg(F.sum("_amount").alias("_sum"))
    starts = sums.withColumn("_start", F.coalesce(F.sum("_sum").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_sum")
    return local.join(F.broadcast(starts), "_part").withColumn("before", F.col("_start") + F.col("_own")).drop("_part", "_own", "_start", "_amount")


def in_batches(df: DataFrame, order: list, size: int) -> DataFrame:
    """A 1-based batch number of rows in order."""
    return running(df, order, F.lit(1)).withColumn("batch", F.floor(F.col("before") / size) + 1).drop("before")


def merge_reviews(mentions: DataFrame, items: DataFrame, reviews: DataFrame, roles: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(mentions, items) after a review. items (id, role, status, manual); reviews (id, status); roles (source, target, code).

    A not_theory review demotes its theory, any other sets the status unless it is manual. A reviewed source keeps only
    its listed mentions as core. Of an unreviewed source, a mention is core if its target is a theory, or was core by
    the reviews with a role somewhere, else extended.
    """
    reviewed = reviews.select("id", F.col("status").alias("verdict"))
    joined = items.join(reviewed, "id", "left")
    demoted = (F.col("verdict") == "not_theory") & (F.col("role") == "theory")
    status = F.when(F.col("verdict").isNotNull() & (F.col("verdict") != "not_theory") & ~F.col("manual"), F.col("verdict")).otherwise(F.col("status"))
    out_items = joined.select("id", F.when(demoted, "related").otherwise(F.col("role")).alias("role"), status.alias("status"), "manual")
    with_code = mentions.drop("code").join(roles, ["source", "target"], "left").join(reviewed.select(F.col("id").alias("source"), F.lit(True).alias("seen")), "source", "left")
    core_targets = with_code.filter("seen and code is not null").select("target").distinct().withColumn("anchored", F.lit(True))
    theories = out_items.filter("role = 'theory'").select(F.col("id").alias("target"), F.lit(True).alias("theory"))
    flagged = with_code.join(core_targets, "target", "left").join(theories, "target", "left")
    core = F.when(F.col("seen"), F.col("code").isNotNull()).otherwise(F.coalesce("anchored", "theory", F.lit(False)))
    return flagged.select("source", "target", F.when(F.col("seen"), F.col("code")).alias("code"), F.when(core, "core").otherwise("extended").alias("tier")), out_items


def role_violations(reviews: DataFrame, roles: DataFrame, known: DataFrame, candidates: DataFrame) -> DataFrame:
    """(rule, id): unknown theories, illegal statuses, entities that are no candidates, illegal codes, missing reviews."""
    # fixed values: statuses and role codes
    statuses = ["confirmed", "debunked", "disputed", "not_theory"]
    codes = ["acc", "pro", "vic", "sub", "evt", "loc", "deb", "rel"]
    bad = [
        reviews.join(known, "id", "left_anti").select(F.lit("unknown theory").alias("rule"), "id"),
        reviews.filter(~F.coalesce(F.col("status").isin(statuses), F.lit(False))).select(F.lit("status"), "id"),
        roles.join(candidates, ["source", "target"], "left_anti").select(F.lit("not a candidate"), "source"),
        roles.filter(~F.coalesce(F.col("code").isin(codes), F.lit(False))).select(F.lit("code"), "source"),
        known.join(reviews, "id", "left_anti").select(F.lit("missing"), "id"),
    ]
    return reduce(DataFrame.union, bad)


def merge_dates(nodes: DataFrame, dates: DataFrame) -> DataFrame:
    """nodes (id, d) with a reviewed year where there is none; year 0 and precision none are no dates."""
    usable = dates.filter((F.col("y") != 0) & F.col("p").isNotNull() & (F.col("p") != "none")).select("id", F.col("y").cast("string").alias("_y"), "p")
    joined = nodes.join(usable, "id", "left")
    take = blank_to_null(F.col("d")).isNull() & F.col("_y").isNotNull()
    return joined.select("id", F.when(take, F.col("_y")).otherwise(F.col("d")).alias("d"), F.when(take, F.col("p")).alias("dp"))


def translate(nodes: DataFrame, done: DataFrame) -> DataFrame:
    """nodes (id, lt, summary) with reviewed translations (id, t, s): the title always wins, the summary only if there
    is none or it is the same; such a node is flagged ltm."""
    joined = nodes.join(done, "id", "left")
    use = blank_to_null(F.col("s")).isNotNull() & (blank_to_null(F.col("summary")).isNull() | (F.col("summary") == F.col("s")))
    return joined.select("id", F.coalesce(blank_to_null(F.col("t")), F.col("lt")).alias("lt"), F.when(use, F.col("s")).otherwise(F.col("summary")).alias("summary"), use.cast("int").alias("ltm"))


def emitted(items: DataFrame, entities: DataFrame, reviewed: DataFrame, least: int = 2) -> DataFrame:
    """(id, kind): the items (id, role) that were kept, and entities (id, kind, n) that are no items and have enough
    mentions or a review (id). An item's kind is its role."""
    kept = items.filter("role != 'dropped'").select("id", F.col("role").alias("kind"))
    known = reviewed.select("id", F.lit(True).alias("seen")).distinct()
    others = entities.join(items, "id", "left_anti").join(known, "id", "left").filter((F.col("n") >= least) | F.col("seen"))
    return kept.union(others.select("id", F.coalesce(blank_to_null(F.col("kind")), F.lit("concept"))))


def with_labels(df: DataFrame, key: str, ids: str, labels: DataFrame) -> DataFrame:
    """(key, labels): the array `ids` as labels (id, label), in order; an id without one stands for itself."""
    flat = df.select(key, F.posexplode(ids).alias("pos", "id")).join(labels, "id", "left")
    found = flat.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("pos", F.coalesce(blank_to_null(F.col("label")), F.col("id").cast("string")).alias("label")))).alias("l"))
    return found.select(key, F.transform("l", lambda x: x["label"]).alias("labels"))


def unique_slugs(df: DataFrame, order: str) -> DataFrame:
    """df (id, slug) where a slug that an earlier row has is replaced by the id."""
    rank = F.row_number().over(Window.partitionBy("slug").orderBy(order))
    return df.withColumn("slug", F.when(rank > 1, F.col("id")).otherwise(F.col("slug")))


def overrides(maps: DataFrame, column: str) -> DataFrame:
    """(key, value) of a map column: keys that begin with `_` are notes, and empty values override nothing."""
    return maps.select(F.explode(column)).filter(~F.col("key").startswith("_") & blank_to_null(F.col("value")).isNotNull())


def translation_violations(cases: DataFrame, done: DataFrame, most: int = 700) -> DataFrame:
    """(rule, id) of cases (id, local) and done (id, t, s): no title; else no summary where there is no local article,
    or one that is too long; and ids that are no cases."""
    joined = cases.join(done, "id", "left").withColumns({"t": blank_to_null(F.col("t")), "s": blank_to_null(F.col("s"))})
    bad = F.array_compact(F.array(F.when(F.col("t").isNull(), "no title"), F.when(F.col("t").isNotNull() & F.col("s").isNull() & ~F.col("local"), "no summary"), F.when(F.col("t").isNotNull() & (F.length("s") > most), "too long")))
    return joined.select(F.explode(bad).alias("rule"), "id").union(done.join(cases, "id", "left_anti").select(F.lit("unknown id"), "id"))


def entity_translation_violations(cases: DataFrame, done: DataFrame) -> DataFrame:
    """(rule, id) of cases (id) and done (id, t, keep): not reviewed, neither translated nor kept, and unknown ids."""
    joined = cases.select("id").join(done.withColumn("seen", F.lit(True)), "id", "left")
    empty = blank_to_null(F.col("t")).isNull() & (F.coalesce("keep", F.lit(0)) == 0)
    rule = F.when(F.col("seen").isNull(), "not reviewed").when(empty, "empty")
    return joined.select(rule.alias("rule"), "id").filter("rule is not null").union(done.join(cases, "id", "left_anti").select(F.lit("unknown id"), "id"))


def split_matches(pages: DataFrame, titles: DataFrame) -> tuple[DataFrame, DataFrame]:
    """pages (id, lang, title) by the titles (id, name) of their ids: (name, languages) of those that have one, and for
    each other id the titles by language."""
    joined = pages.join(titles, "id", "left")
    matched = joined.filter("name is not null").groupBy("name").agg(F.array_sort(F.collect_set("lang")).alias("languages"))
    unmatched = joined.filter("name is null").groupBy("id").agg(F.array_sort(F.collect_set(F.struct("lang", "title"))).alias("titles"))
    return matched, unmatched
