"""Registered queries of the build step and of the leaderboard service, each next to the SQL that states the same result."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillgraph.functions import text as T
from quillgraph.operators import build, exports, graph, layout, mentions, reach, rules, service
from quillgraph.operators.rounds import settle
from quillgraph.plans.registry import _BFS, _POINTS, D, E, M, all_edges, base_mentions, hub_mentions, part_tree, positions, query, runs
from quillgraph.sources.tables import raw_mentions, table


def part_ids(spark, sf):
    return table(spark, sf, "part").withColumn("id", F.concat(F.lit("P"), F.col("p_partkey").cast("string")))


def pid(c):
    return F.concat(F.lit("P"), c.cast("string"))


# lookups and discovery


_PAGES = "pages_ AS (SELECT p_partkey AS k, p_name || ' ' || p_partkey AS title, CASE WHEN p_partkey % 7 > 0 THEN 'Q' || (p_partkey % 60) ELSE '' END AS qid, p_partkey % 11 = 0 AS missing, p_partkey % 13 = 0 AS disambiguation FROM part WHERE p_partkey % 5 > 0), ents AS (SELECT 'Q' || n_nationkey AS qid, n_name AS label, [n_name, 'R' || n_regionkey, 'c', 'd'] AS countries FROM nation)"


def dimension_pages(spark, sf):
    k = F.col("p_partkey")
    return table(spark, sf, "part").filter(k % 5 > 0).select(F.concat_ws(" ", "p_name", k.cast("string")).alias("title"), F.when(k % 7 > 0, F.concat(F.lit("Q"), (k % 60).cast("string"))).otherwise("").alias("qid"), F.concat(F.lit("u"), k.cast("string")).alias("url"), F.col("p_brand").alias("extract"), (k % 11 == 0).alias("missing"), (k % 13 == 0).alias("disambiguation"))


@query(f"""WITH {_PAGES}, c AS (SELECT p_partkey AS k, p_name || ' ' || p_partkey AS title, ['s' || p_size % 3] AS sources, [p_type, p_brand] AS categories FROM part), j AS (SELECT coalesce(nullif(qid, ''), title) AS id, c.*, label, countries FROM c JOIN pages_ USING (title) LEFT JOIN ents USING (qid) WHERE NOT missing AND NOT disambiguation),
f AS (SELECT id, min(title) AS title, list_sort(list_distinct(flatten(list(sources)))) AS sources, list_sort(list_distinct(flatten(list(categories)))) AS categories, arg_min(label, title) FILTER (label IS NOT NULL) AS label, arg_min(countries, title) FILTER (countries IS NOT NULL) AS countries FROM j GROUP BY 1)
SELECT id, title, label, array_to_string(sources, ',') AS sources, array_to_string(categories, ',') AS categories, coalesce(array_to_string(countries[1:3], ','), '') AS countries FROM f""")
def enrich_items(spark, sf):
    k = F.col("p_partkey")
    c = table(spark, sf, "part").select(F.concat_ws(" ", "p_name", k.cast("string")).alias("title"), F.array(F.concat(F.lit("s"), (F.col("p_size") % 3).cast("string"))).alias("sources"), F.array("p_type", "p_brand").alias("categories"))
    ents = table(spark, sf, "nation").select(F.concat(F.lit("Q"), F.col("n_nationkey").cast("string")).alias("qid"), F.col("n_name").alias("label"), F.array("n_name", F.concat(F.lit("R"), F.col("n_regionkey").cast("string")), F.lit("c"), F.lit("d")).alias("countries"))
    out = build.enrich(c, dimension_pages(spark, sf), ents)
    return out.select("id", "title", "label", *[F.array_join(x, ",").alias(x) for x in ("sources", "categories", "countries")])


@query(f"WITH {_PAGES} SELECT c_custkey, nullif(qid, '') AS qid FROM customer LEFT JOIN pages_ ON k = c_custkey")
def title_ids(spark, sf):
    c = table(spark, sf, "customer").join(table(spark, sf, "part").select(F.col("p_partkey").alias("c_custkey"), F.concat_ws(" ", "p_name", F.col("p_partkey").cast("string")).alias("title")), "c_custkey", "left")
    found = build.lookup(c, "title", dimension_pages(spark, sf).select("title", rules.blank_to_null(F.col("qid")).alias("qid")))
    return found.select("c_custkey", "qid")


@query("SELECT doc_id AS id, min(CASE WHEN lang = 'en' THEN source END) AS en, min(CASE WHEN lang = 'fr' THEN source END) AS fr FROM documents GROUP BY 1")
def sitelinks(spark, sf):
    d = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.col("lang").alias("site"), F.col("source").alias("title"))
    return build.pivot_titles(d, ["en", "fr"])


_RESOLVED = "al AS (SELECT 'T' || p_partkey AS title, CASE WHEN p_partkey % 4 = 0 THEN 'T' || (p_partkey + 1) ELSE 'T' || p_partkey END AS t1 FROM part), al2 AS (SELECT title, CASE WHEN substr(t1, 2)::BIGINT % 6 = 1 THEN 'T' || substr(t1, 2)::BIGINT // 2 ELSE t1 END AS t2 FROM al), res AS (SELECT title, CASE WHEN k IS NOT NULL AND k % 13 > 0 THEN CASE WHEN k % 3 = 0 THEN t2 ELSE 'Q' || k // 2 END END AS id FROM al2 LEFT JOIN (SELECT p_partkey AS k FROM part WHERE p_partkey % 17 > 0) ON t2 = 'T' || k)"


def resolved_ids(spark, sf):
    k, p = F.col("p_partkey"), table(spark, sf, "part")
    name = lambda c: F.concat(F.lit("T"), c.cast("string"))
    normal = p.filter(k % 4 == 0).select(name(k).alias("from"), name(k + 1).alias("to"))
    redirect = p.filter((k + 1) % 6 == 1).select(name(k + 1).alias("from"), name(F.floor((k + 1) / 2)).alias("to"))
    redirect = redirect.union(p.filter((k % 6 == 1)).select(name(k), name(F.floor(k / 2)))).distinct()
    pages = p.filter(k % 17 > 0).select(name(k).alias("title"), F.when(k % 3 == 0, "").otherwise(F.concat(F.lit("Q"), F.floor(k / 2).cast("string"))).alias("id"), (k % 13 == 0).alias("disambiguation"))
    return build.resolve_targets(p.select(name(k).alias("title")), normal, redirect, pages)


@query(f"WITH {_RESOLVED} SELECT * FROM res")
def resolve_targets(spark, sf):
    return resolved_ids(spark, sf)


@query(f"WITH {M}, {_RESOLVED}, j AS (SELECT 'H' || substr(source, 2)::BIGINT // 2 AS source, id AS target, n, in_lead FROM m JOIN res ON title = 'T' || substr(target, 2)) SELECT source, target, sum(n)::BIGINT AS n, bool_or(in_lead) AS in_lead FROM j WHERE target IS NOT NULL GROUP BY 1, 2")
def resolved_mentions(spark, sf):
    m = base_mentions(spark, sf).select(F.col("source").alias("hub"), F.concat(F.lit("T"), F.col("target").substr(2, 20)).alias("title"), "n", "in_lead")
    hub_ids = m.select("hub").distinct().withColumn("id", F.concat(F.lit("H"), F.floor(F.col("hub").substr(2, 20).cast("long") / 2).cast("string")))
    return build.resolved_mentions(m, resolved_ids(spark, sf), hub_ids)


_P31 = "p31 AS (SELECT 'P' || p_partkey AS id, [p_type, p_brand] AS l FROM part)"


@query(f"WITH {_P31} SELECT id FROM p31 WHERE list_contains(l, 'PROMO') ORDER BY id LIMIT 5000")
def statement_instances(spark, sf):
    return build.instances(part_ids(spark, sf).select("id", F.array("p_type", "p_brand").alias("p31")), "PROMO").select("id")


@query("WITH RECURSIVE tree AS (SELECT p_partkey AS node, CASE WHEN p_partkey > 0 THEN p_partkey // 4 END AS parent FROM part), below AS (SELECT 5 AS node UNION SELECT t.node FROM tree t JOIN below b ON t.parent = b.node) SELECT DISTINCT l_orderkey AS id, 'o' || l_orderkey AS title FROM lineitem WHERE l_partkey IN (FROM below) AND l_orderkey % 3 > 0")
def closure_instances(spark, sf):
    entities = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(F.collect_set("l_partkey").alias("p31"))
    titles = table(spark, sf, "orders").filter("o_orderkey % 3 > 0").select(F.col("o_orderkey").alias("id"), F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("title"))
    return build.closure_instances(entities, reach.reach_index(part_tree(spark, sf)), 5, titles)


@query("SELECT p_partkey, coalesce(n_name, '') AS label FROM part LEFT JOIN nation ON p_size = n_nationkey WHERE starts_with(p_type, 'S')")
def class_labels(spark, sf):
    p = table(spark, sf, "part").filter(F.col("p_type").startswith("S")).select("p_partkey", F.col("p_size").alias("cls"))
    labels = table(spark, sf, "nation").select(F.col("n_nationkey").alias("cls"), F.col("n_name").alias("label"))
    return build.lookup(p, "cls", labels).select("p_partkey", F.coalesce("label", F.lit("")).alias("label"))


@query("SELECT user_id, max(CASE WHEN event_id % 2 = 0 THEN event_type END) AS kind, count(*) AS n FROM events WHERE user_id IS NOT NULL GROUP BY 1")
def sparql_bindings(spark, sf):
    value = lambda c: F.concat(F.lit('{"type":"literal","value":"'), c, F.lit('"}'))
    kind = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit(',"kind":'), value(F.col("event_type")))).otherwise("")
    one = F.concat(F.lit('{"user":'), value(F.col("user_id").cast("string")), kind, F.lit("}"))
    bodies = table(spark, sf, "events").filter("user_id is not null").groupBy(F.col("event_id") % 50).agg(F.concat(F.lit('{"head":{},"results":{"bindings":['), F.concat_ws(",", F.collect_list(one)), F.lit("]}}")).alias("body"))
    found = build.bindings(bodies, "body", ["user", "kind"])
    return found.groupBy(F.col("user").cast("long").alias("user_id")).agg(F.max("kind").alias("kind"), F.count("*").alias("n"))


@query("SELECT DISTINCT 'theory' AS kind, 'C' || o_custkey AS id FROM orders WHERE o_orderkey % 3 = 0 UNION SELECT DISTINCT 'entity', 'P' || l_partkey FROM lineitem WHERE l_orderkey % 3 = 0")
def reviewed_ids(spark, sf):
    return build.reviewed(review_records(spark, sf))


_REVIEWS = "rr AS (SELECT o_orderkey, 'C' || o_custkey AS id, o_orderstatus AS status FROM orders WHERE o_orderkey % 3 = 0), rc AS (SELECT DISTINCT l_orderkey, l_partkey, (['acc', 'vic', 'evt'])[1 + l_partkey % 3] AS code FROM lineitem WHERE l_orderkey % 3 = 0)"


def review_records(spark, sf):
    code = F.element_at(F.array(F.lit("acc"), F.lit("vic"), F.lit("evt")), (1 + F.col("l_partkey") % 3).cast("int"))
    roles = table(spark, sf, "lineitem").filter("l_orderkey % 3 = 0").groupBy("l_orderkey").agg(F.map_from_entries(F.array_distinct(F.collect_list(F.struct(pid(F.col("l_partkey")), code)))).alias("roles"))
    o = table(spark, sf, "orders").filter("o_orderkey % 3 = 0")
    return o.join(roles, o["o_orderkey"] == roles["l_orderkey"], "left").select(F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("id"), F.col("o_orderstatus").alias("status"), "roles")


@query(f"WITH {_REVIEWS} SELECT 'status' AS kind, status AS code, count(*) AS n FROM rr GROUP BY 2 UNION ALL SELECT 'role', code, count(*) FROM rc GROUP BY 2")
def code_tallies(spark, sf):
    return build.code_tallies(review_records(spark, sf))


_WORDS = ["widget", "ring", "small"]


@query("SELECT p_partkey, regexp_matches(lower(p_name), 'widget|ring|small') AS noise, starts_with(lower(t), 'list of') OR starts_with(lower(t), 'timeline of') AS skipped, starts_with(t, 'List of') AS listlike, starts_with(id, 'Q') AS entity FROM (SELECT *, CASE p_partkey % 5 WHEN 0 THEN 'list of ' WHEN 1 THEN 'List of ' WHEN 2 THEN 'Timeline OF ' ELSE '' END || p_name AS t, CASE WHEN p_partkey % 2 = 0 THEN 'Q' ELSE '' END || p_partkey AS id FROM part)")
def title_filters(spark, sf):
    k = F.col("p_partkey")
    title = F.concat(F.when(k % 5 == 0, "list of ").when(k % 5 == 1, "List of ").when(k % 5 == 2, "Timeline OF ").otherwise(""), "p_name")
    entity = build.is_entity_id(F.concat(F.when(k % 2 == 0, "Q").otherwise(""), k.cast("string")))
    return table(spark, sf, "part").select("p_partkey", build.is_noise(F.col("p_name"), _WORDS).alias("noise"), build.is_skipped_title(title).alias("skipped"), build.is_list_title(title).alias("listlike"), entity.alias("entity"))


@query("SELECT DISTINCT title FROM (SELECT 'T' || p_partkey AS title, CASE p_size % 4 WHEN 0 THEN 'theory' WHEN 1 THEN 'event' ELSE 'person' END AS type, p_size AS s, p_partkey AS k FROM part) WHERE type IN ('theory', 'event') OR (k % 10 < 2) OR s = 3")
def hub_selection(spark, sf):
    k, s = F.col("p_partkey"), F.col("p_size")
    title = F.concat(F.lit("T"), k.cast("string"))
    items = table(spark, sf, "part").select(title.alias("title"), F.when(s % 4 == 0, "theory").when(s % 4 == 1, "event").otherwise("person").alias("type"), F.when(s == 3, F.array(F.lit("manual"))).otherwise(F.array(F.lit("category"))).alias("sources"))
    previous = table(spark, sf, "part").filter(k % 10 < 3).select(title.alias("title"), F.when(k % 10 == 0, "theory").when(k % 10 == 1, "related").otherwise("dropped").alias("role"))
    return build.hubs(items, previous)


_TYPED = "typed AS (SELECT p_partkey, CASE WHEN regexp_matches(p_name, '(?i)\\bring\\b') THEN 'theory' WHEN contains(lower(p_type), 'promo') OR contains(lower(p_brand), '#1') THEN 'person' WHEN contains(lower(p_type), 'small') OR contains(lower(p_brand), 'small') THEN 'work' WHEN regexp_matches(p_name, 'bolt') THEN 'place' WHEN p_size % 2 = 0 THEN 'theory?' ELSE 'other' END AS old FROM part)"


def old_type():
    return build.classify(F.col("p_name"), F.array("p_type", "p_brand"), F.col("p_name"), F.col("p_size") % 2 == 0, [("theory", r"(?i)\bring\b")], [("person", ["promo", "#1"]), ("work", ["small"])], [("place", "bolt")])


@query(f"WITH {_TYPED} SELECT p_partkey, old AS kind FROM typed")
def classify_items(spark, sf):
    return table(spark, sf, "part").select("p_partkey", old_type().alias("kind"))


_FINAL = f"{_TYPED}, fin AS (SELECT p_partkey, old, CASE WHEN cls IN ('person', 'organization', 'work', 'media', 'place') THEN cls WHEN regexp_matches(p_name, '(?i)\\b(red|lime)\\b') THEN 'theory' WHEN cls IS NOT NULL THEN cls WHEN old = 'other' THEN 'concept' ELSE old END AS type FROM typed JOIN part USING (p_partkey) LEFT JOIN (VALUES (0, 'person'), (1, 'event'), (2, 'concept')) c(r, cls) ON p_size % 9 = r)"


def final_types(spark, sf):
    by_class = F.create_map(*[F.lit(x) for kv in {0: "person", 1: "event", 2: "concept"}.items() for x in kv])[F.col("p_size") % 9]
    return table(spark, sf, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size", old_type().alias("old")).withColumn("type", build.final_type(by_class, F.col("p_name").rlike(r"(?i)\b(red|lime)\b"), F.col("old")))


@query(f"WITH {_FINAL} SELECT p_partkey, type FROM fin")
def build_types(spark, sf):
    return final_types(spark, sf).select("p_partkey", "type")


_BUILT = f"{M}, {_FINAL}, th AS (SELECT 'P' || p_partkey AS id FROM fin WHERE type IN ('theory', 'theory?')), mm AS (SELECT source, target FROM m UNION SELECT target, 'P' || (substr(source, 2)::BIGINT % 200) FROM m WHERE n > 1 AND target != 'P' || (substr(source, 2)::BIGINT % 200)), sc AS (SELECT id, sum(x)::BIGINT AS score FROM (SELECT target AS id, count(*) AS x FROM mm WHERE source IN (FROM th) GROUP BY 1 UNION ALL SELECT source, count(*) FROM mm WHERE target IN (FROM th) GROUP BY 1) GROUP BY 1)"


def two_way(spark, sf):
    """Mentions of parts by customers, and by parts of what stands for customers."""
    m = base_mentions(spark, sf)
    back = pid(F.col("source").substr(2, 20).cast("long") % 200)
    return m.select("source", "target").union(m.filter("n > 1").select(F.col("target"), back.alias("b")).filter("target != b")).distinct()


def scores(spark, sf):
    theories = final_types(spark, sf).filter("type in ('theory', 'theory?')").select(pid(F.col("p_partkey")).alias("id"))
    return build.connectivity(two_way(spark, sf), theories)


@query(f"WITH {_BUILT} SELECT * FROM sc")
def connectivity(spark, sf):
    return scores(spark, sf)


_ROLES = _BUILT + """, it AS (SELECT p_partkey, CASE p_partkey % 29 WHEN 0 THEN 'List of ' ELSE '' END || p_name AS title, type, coalesce(score, 0) // 2 AS score, p_size % 6 AS confidence, p_partkey % 31 = 0 AS manual, CASE WHEN p_partkey % 37 = 0 THEN 'related' END AS ov, CASE WHEN p_size % 5 = 0 THEN false ELSE p_brand NOT IN ('Brand#1', 'Brand#2', 'Brand#3', 'Brand#4', 'Brand#5', 'Brand#6', 'Brand#7', 'Brand#8', 'Brand#9') END AS clean FROM fin JOIN part USING (p_partkey) LEFT JOIN sc ON id = 'P' || p_partkey),
ro AS (SELECT p_partkey, CASE WHEN ov IS NOT NULL THEN ov WHEN manual THEN 'theory' WHEN starts_with(title, 'List of') THEN 'dropped' WHEN type IN ('person', 'work', 'place', 'media', 'organization') THEN CASE WHEN score >= 2 OR (clean AND score >= 1) THEN 'related' ELSE 'dropped' END WHEN type = 'theory' THEN 'theory' WHEN type = 'theory?' AND (clean OR score >= 1) THEN 'theory' WHEN confidence >= 3 AND type IN ('concept', 'theory?') THEN 'theory' WHEN score >= 2 OR (clean AND score >= 1) THEN 'related' ELSE 'dropped' END AS role FROM it)"""


def item_roles(spark, sf):
    k, s = F.col("p_partkey"), F.col("p_size")
    items = final_types(spark, sf).withColumn("id", pid(k)).join(scores(spark, sf), "id", "left")
    title = F.concat(F.when(k % 29 == 0, "List of ").otherwise(""), "p_name")
    # one digit: noise; every fifth item has no category at all
    noise = F.array(*[F.lit(f"Brand#{i}") for i in range(1, 10)])
    clean = build.has_clean(F.when(s % 5 == 0, F.array().cast("array<string>")).otherwise(F.array("p_brand")), noise)
    role = rules.role(F.when(k % 37 == 0, "related"), k % 31 == 0, build.is_list_title(title), F.col("type"), F.floor(F.coalesce("score", F.lit(0)) / 2), clean, s % 6)
    return items.select("p_partkey", "id", "type", "p_name", role.alias("role"))


@query(f"WITH {_ROLES} SELECT * FROM ro")
def build_roles(spark, sf):
    return item_roles(spark, sf).select("p_partkey", "role")


@query(f"WITH {_BUILT} SELECT target, count(*) AS df_raw, count(*) FILTER (substr(source, 2)::BIGINT % 3 = 0) AS df_theories, count(*) FILTER (substr(source, 2)::BIGINT % 3 < 2) AS df_kept FROM m GROUP BY 1")
def document_frequencies(spark, sf):
    m, n = base_mentions(spark, sf), F.col("id").substr(2, 20).cast("long")
    ids = m.select(F.col("source").alias("id")).distinct()
    return build.frequencies(m, ids.filter(n % 3 == 0), ids.filter(n % 3 < 2))


@query(f"WITH {M} SELECT * FROM m WHERE substr(source, 2)::BIGINT % 3 < 2")
def kept_source_mentions(spark, sf):
    m = base_mentions(spark, sf)
    kept = table(spark, sf, "customer").filter("c_custkey % 3 < 2").select(F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("id"))
    return build.from_kept(m, kept).select("source", "target", "n", "in_lead")


@query(f"WITH {M}, x AS (SELECT target AS node, 1 AS i, 0 AS o FROM m UNION ALL SELECT source, 0, 1 FROM m) SELECT node, sum(i)::BIGINT AS n_in, sum(o)::BIGINT AS n_out, count(*) AS degree FROM x GROUP BY 1")
def in_out_degree(spark, sf):
    return build.in_and_out(base_mentions(spark, sf))


_TOPICAL = "p_name LIKE '%red%' OR p_type LIKE 'S%'"


@query(f"WITH {D}, rev AS (SELECT DISTINCT target AS s, source AS t FROM raw WHERE kind = 'R'), j AS (SELECT source, target, p_partkey, sqrt(least(n, 5)) * CASE WHEN in_lead THEN 2.0 ELSE 1.0 END * ln((total + 1) / (df + 1)::DOUBLE) AS base, CASE WHEN p_partkey % 5 < 3 THEN df * 100 WHEN p_partkey % 5 = 3 THEN 500000 END AS links, rev.s IS NOT NULL AS mutual, {_TOPICAL} AS topical FROM m JOIN d USING (target) JOIN part ON target = 'P' || p_partkey CROSS JOIN t LEFT JOIN rev ON rev.s = target AND rev.t = source) SELECT source, target, round(base * CASE WHEN links IS NULL THEN 1.0 ELSE greatest(0.4, least(1.8, ln(20000.0) / ln(20 + links))) END * CASE WHEN mutual THEN 1.5 ELSE 1.0 END * CASE WHEN topical THEN 1.3 ELSE 1.0 END, 3) AS score FROM j")
def relevance_score(spark, sf):
    m, raw, k = base_mentions(spark, sf), raw_mentions(spark, sf), F.col("p_partkey")
    total = m.agg(F.count_distinct("source")).scalar()
    back = raw.filter("kind = 'R'").select("target", "source", F.lit(True).alias("back")).distinct()
    joined = m.join(mentions.document_frequency(m), "target").join(part_ids(spark, sf).withColumnRenamed("id", "target"), "target").join(back, ["target", "source"], "left")
    base = mentions.base_score(F.col("n"), F.col("in_lead"), F.col("df"), total, F.lit(1.0))
    topical = F.col("p_name").contains("red") | F.col("p_type").startswith("S")
    score = build.relevance(base, F.when(k % 5 < 3, F.col("df") * 100), k % 5 == 3, F.coalesce("back", F.lit(False)), topical)
    return joined.select("source", "target", score.alias("score"))


# themes


_THEMES = {"one": "1", "three": "3", "five": "5"}
_THEME_SQL = M + ", tree AS (SELECT p_partkey AS node, p_partkey // 4 AS parent FROM part WHERE p_partkey > 0), ch AS (SELECT p_partkey AS k, p_partkey AS a FROM part UNION SELECT node, parent FROM tree UNION SELECT t.node, u.parent FROM tree t JOIN tree u ON t.parent = u.node), th(theme, p) AS (VALUES " + ", ".join(f"('{t}', '{p}')" for t, p in _THEMES.items()) + "), s AS (SELECT DISTINCT k, theme, 1 AS x FROM ch JOIN th ON contains('' || a, p) WHERE a != 0 UNION ALL SELECT p_partkey, theme, 2 FROM part JOIN th ON contains('' || p_partkey, p) OR contains(p_brand, p) UNION ALL SELECT DISTINCT substr(source, 2)::BIGINT % 2000, (['one', 'three'])[1 + substr(target, 2)::BIGINT % 2], 2 FROM m WHERE (in_lead OR n >= 2) AND substr(target, 2)::BIGINT < 40 AND substr(source, 2)::BIGINT % 2000 IN (SELECT p_partkey FROM part)), sums AS (SELECT k AS id, theme, sum(x)::BIGINT AS score FROM s GROUP BY 1, 2)"


@query(f"WITH {_THEME_SQL} SELECT * FROM sums")
def theme_scores(spark, sf):
    p = table(spark, sf, "part")
    text = lambda c: F.col(c).cast("string")
    items = p.select(F.col("p_partkey").alias("id"), F.array(text("p_partkey")).alias("categories"), F.array("p_brand").alias("texts"))
    chain = graph.ancestors(part_tree(spark, sf), 2).select(text("node").alias("node"), text("ancestor").alias("ancestor"))
    anchors = p.filter("p_partkey < 40").select(pid(F.col("p_partkey")).alias("target"), F.when(F.col("p_partkey") % 2 == 0, "one").otherwise("three").alias("theme"))
    m = base_mentions(spark, sf).withColumn("source", F.col("source").substr(2, 20).cast("long") % 2000).groupBy("source", "target", "n", "in_lead").count()
    return build.theme_scores(items, chain, anchors, m, _THEMES, "0")


# nodes and edges of the graph


_NODES = f"{D}, nodes AS (SELECT 'P' || p_partkey AS id, p_name AS t, CASE p_partkey % 3 WHEN 0 THEN 'theory' ELSE 'entity' END AS k, lower(p_type) AS ty, p_brand AS th, nullif(CASE WHEN p_size % 2 = 0 THEN '' ELSE '19' || (10 + p_size) END, '') AS d, CASE WHEN p_size % 3 > 0 AND p_size % 4 > 0 THEN p_size / 2.0 || '|' || p_partkey / 4.0 END AS c, coalesce(df, 0) AS n, (coalesce(df, 0) > 30)::INT AS g FROM part LEFT JOIN d ON target = 'P' || p_partkey WHERE p_partkey % 5 < 4)"


def node_rows(spark, sf):
    k, s = F.col("p_partkey"), F.col("p_size")
    df = mentions.document_frequency(base_mentions(spark, sf)).withColumnRenamed("target", "id")
    p = part_ids(spark, sf).filter(k % 5 < 4).join(df, "id", "left").withColumn("n_theories", F.coalesce("df", F.lit(0)))
    place = F.when(s % 3 > 0, F.array(s / 2.0, F.when(s % 4 > 0, k / 4.0)))
    lat, lon = build.coordinates(place)
    items = p.select("id", F.col("p_name").alias("title"), F.when(k % 3 == 0, "theory").otherwise("entity").alias("kind"), F.lower("p_type").alias("type"), F.array("p_brand").alias("themes"), F.array().cast("array<string>").alias("regions"), F.when(s % 2 == 0, "").otherwise(F.concat(F.lit("19"), (10 + s).cast("string"))).alias("date"), lat.alias("lat"), lon.alias("lon"), F.lit("").alias("description"), "n_theories", (F.col("n_theories") > 30).alias("generic"))
    return build.graph_nodes(items)


@query(f"WITH {_NODES} SELECT id, t, k, ty, th, d, split_part(c, '|', 1)::DOUBLE AS lat, split_part(c, '|', 2)::DOUBLE AS lon, n, g FROM nodes")
def graph_nodes(spark, sf):
    return node_rows(spark, sf).select("id", "t", "k", "ty", F.array_join("th", ",").alias("th"), "d", F.get("c", F.lit(0)).alias("lat"), F.get("c", F.lit(1)).alias("lon"), "n", "g")


_EDGES = f"{_NODES}, cc AS (SELECT 'C' || c_custkey AS id FROM customer WHERE c_custkey % 4 > 0), ed AS (SELECT source AS s, target AS t, (n * 0.5)::DOUBLE AS w, in_lead::INT AS lead, (n >= 2)::INT AS core, CASE WHEN n >= 3 THEN 'sub' END AS role FROM m WHERE source IN (FROM cc) AND target IN (SELECT id FROM nodes))"


def edge_rows(spark, sf):
    m = base_mentions(spark, sf).select("source", "target", (F.col("n") * 0.5).alias("weight"), "in_lead", F.when(F.col("n") >= 2, "core").otherwise("extended").alias("tier"), F.when(F.col("n") >= 3, "sub").otherwise("").alias("role"))
    ends = node_rows(spark, sf).select("id").union(table(spark, sf, "customer").filter("c_custkey % 4 > 0").select(F.concat(F.lit("C"), F.col("c_custkey").cast("string"))))
    return build.graph_edges(m, ends)


@query(f"WITH {_EDGES} SELECT * FROM ed")
def graph_edges(spark, sf):
    return edge_rows(spark, sf)


@query(f"WITH {_EDGES} SELECT (SELECT count(*) FROM nodes) AS n_nodes, (SELECT count(*) FROM ed) AS n_edges, (SELECT count(*) FROM nodes WHERE c IS NOT NULL) AS n_placed, (SELECT sum(w) FROM ed) AS weight, 'a,b' AS themes")
def graph_document(spark, sf):
    clusters = spark.createDataFrame([(0, "x")], "id int, top string")
    parts = exports.graph_document(node_rows(spark, sf), edge_rows(spark, sf), ["a", "b"], clusters)
    read = parts.select(F.from_json("document", "nodes array<struct<id string, c array<double>>>, edges array<array<string>>, themes array<string>").alias("d"))
    placed = F.size(F.filter("d.nodes", lambda n: n["c"].isNotNull()))
    weight = F.aggregate(F.col("d.edges"), F.lit(0.0), lambda acc, e: acc + F.get(e, F.lit(2)).cast("double"))
    total = lambda c: F.sum(c.cast("long"))
    return read.agg(total(F.size("d.nodes")).alias("n_nodes"), total(F.size("d.edges")).alias("n_edges"), total(placed).alias("n_placed"), F.sum(weight).alias("weight"), F.max(F.array_join("d.themes", ",")).alias("themes"))


@query(f"WITH {M} SELECT source, target, coalesce(core, 1) = 1 AS is_core, NULL::VARCHAR AS role FROM (SELECT source, target, CASE WHEN n % 3 > 0 THEN (n >= 2)::INT END AS core FROM m)")
def evolved_mentions(spark, sf):
    m = base_mentions(spark, sf).withColumn("core", F.when(F.col("n") % 3 > 0, (F.col("n") >= 2).cast("int")))
    return build.evolved(m, {"core": "int", "role": "string"}).select("source", "target", build.is_core(F.col("core")).alias("is_core"), "role")


@query("SELECT doc_id AS id, (doc_id IN (SELECT doc_id FROM labels WHERE quality = 1))::INT AS se, (lang = 'fr' AND text != '')::INT AS sl FROM documents")
def language_flags(spark, sf):
    d = table(spark, sf, "documents").withColumnRenamed("doc_id", "id")
    english = table(spark, sf, "labels").filter("quality = 1").select(F.col("doc_id").alias("id"))
    local = d.filter("lang = 'fr'").filter(rules.blank_to_null(F.col("text")).isNotNull()).select("id")
    return build.with_flags(d.select("id", F.lit(1).alias("se"), F.lit(7).alias("sl")), {"se": english, "sl": local}).select("id", "se", "sl")


@query("SELECT doc_id AS id, CASE WHEN doc_id % 3 = 0 THEN 'i' || doc_id ELSE 'l' || doc_id END AS title FROM documents WHERE doc_id % 3 = 0 OR doc_id % 2 = 0")
def local_titles(spark, sf):
    d, k = table(spark, sf, "documents"), F.col("doc_id")
    items = d.select(k.alias("id"), F.when(k % 3 == 0, F.concat(F.lit("i"), k.cast("string"))).otherwise("").alias("title"))
    return build.local_titles(d.select(k.alias("id")), items, d.filter(k % 2 == 0).select(k.alias("id"), F.concat(F.lit("l"), k.cast("string")).alias("title")))


@query("SELECT page_id, CASE WHEN page_id % 3 < 2 AND page_id % 4 > 0 THEN m || ' · ' || u WHEN page_id % 3 < 2 THEN m WHEN page_id % 4 > 0 THEN u ELSE 'A map' END AS description FROM (SELECT page_id, CASE page_id % 3 WHEN 0 THEN 'Confirmed' ELSE 'Disputed' END AS m, 'page ' || page_id AS u FROM pages)")
def status_descriptions(spark, sf):
    k = F.col("page_id")
    status, text = F.when(k % 3 == 0, "confirmed").when(k % 3 == 1, "disputed"), F.when(k % 4 > 0, F.concat(F.lit(" page  "), k.cast("string"))).otherwise("")
    return table(spark, sf, "pages").select("page_id", build.described(status, text, {"confirmed": "Confirmed", "disputed": "Disputed"}, "A map").alias("description"))


@query(f"WITH {E}, {_POINTS}, dg AS (SELECT node, count(*) AS degree FROM (SELECT a AS node FROM e UNION ALL SELECT b FROM e) GROUP BY 1), n AS (SELECT id, 'v' || id AS title, cluster, coalesce(degree, 0) AS degree, [(['x', 'y', 'z'])[1 + id % 3], 'w' || id % 2] AS themes, row_number() OVER (PARTITION BY cluster ORDER BY coalesce(degree, 0) DESC, id) AS rn, count(*) OVER (PARTITION BY cluster) AS size FROM pts LEFT JOIN dg ON node = 'P' || id), tc AS (SELECT cluster, theme, row_number() OVER (PARTITION BY cluster ORDER BY count(*) DESC, theme) AS r FROM (SELECT cluster, unnest(themes) AS theme FROM n) GROUP BY 1, 2) SELECT cluster, any_value(size) AS n, any_value(id) FILTER (rn = 1) AS top, string_agg(title, ',' ORDER BY rn) FILTER (rn <= 10) AS listed, (SELECT string_agg(theme, ',' ORDER BY r) FROM tc WHERE r <= 2 AND tc.cluster = n.cluster) AS themes FROM n WHERE size >= 5 GROUP BY cluster")
def cluster_tops(spark, sf):
    points = positions(spark, sf).withColumn("node", pid(F.col("id"))).join(graph.degrees(all_edges(spark, sf)), "node", "left")
    theme = F.element_at(F.array(F.lit("x"), F.lit("y"), F.lit("z")), (1 + F.col("id") % 3).cast("int"))
    nodes = points.select("id", F.concat(F.lit("v"), F.col("id").cast("string")).alias("title"), "cluster", F.coalesce("degree", F.lit(0)).alias("degree"), F.array(theme, F.concat(F.lit("w"), (F.col("id") % 2).cast("string"))).alias("themes"))
    out = build.cluster_tops(nodes)
    return out.select("cluster", "n", "top", F.array_join("listed", ",").alias("listed"), F.array_join("themes", ",").alias("themes"))


@query(f"WITH {_POINTS}, r AS (SELECT id, row_number() OVER (ORDER BY id) - 1 AS k FROM pts WHERE id % 3 = 0) SELECT id, round(1200 * cos(k * 2.399963), 5) AS x, round(1200 * sin(k * 2.399963), 5) AS y FROM r")
def orphan_ring(spark, sf):
    points = positions(spark, sf)
    placed = layout.place(points.select("id", F.lit(4).alias("n")), points.filter("id % 3 > 0").select("id", "x", "y"), ["id"])
    return placed.filter("id % 3 = 0").select("id", F.round("x", 5).alias("x"), F.round("y", 5).alias("y"))


@query(f"WITH {_POINTS} SELECT id, floor(x * 1000 + 0.5) / 10 AS x FROM (SELECT id, x / 10 * 10 AS x FROM pts)")
def rounded_positions(spark, sf):
    return positions(spark, sf).select("id", layout.rounded(F.col("x") * 100).alias("x"))


@query(f"WITH {D} SELECT target, df FROM d ORDER BY df DESC, target LIMIT 25")
def global_top(spark, sf):
    return mentions.document_frequency(base_mentions(spark, sf)).orderBy(F.desc("df"), "target").limit(25)


@query("SELECT event_id, CASE WHEN k % 3 > 0 THEN k / 2.0 END AS lat, CASE WHEN k % 3 > 0 THEN k / 4.0 END AS lon FROM (SELECT event_id, json_extract_string(props, '$.k')::INT AS k FROM events)")
def claim_places(spark, sf):
    k = F.get_json_object("props", "$.k").cast("int")
    snak = lambda value: F.concat(F.lit('{"mainsnak":{"datavalue":{"value":'), value, F.lit("}}}"))
    pair = F.concat(F.lit('{"latitude":'), (k / 2.0).cast("string"), F.lit(',"longitude":'), (k / 4.0).cast("string"), F.lit("}"))
    claims = F.concat(F.lit('{"claims":{"P625":['), snak(F.lit('{"latitude":1}')), F.when(k % 3 > 0, F.concat(F.lit(","), snak(pair))).otherwise(""), F.lit("]}}"))
    return table(spark, sf, "events").select("event_id", T.claim_place(claims, "P625").alias("p")).select("event_id", "p.lat", "p.lon")


# reviews


@query("WITH i AS (SELECT doc_id AS id, CASE WHEN doc_id % 2 = 0 THEN 'theory' ELSE 'related' END AS role, CASE WHEN doc_id % 3 = 0 THEN '1900' ELSE '' END AS date, CASE WHEN doc_id % 5 = 0 THEN 'debunked' END AS status FROM documents), t AS (SELECT id, 'date' AS task FROM i WHERE date = '' UNION ALL SELECT id, 'status' FROM i WHERE status IS NULL UNION ALL SELECT id, 'roles' FROM i WHERE role = 'theory') SELECT id, task FROM t WHERE NOT (id IN (SELECT doc_id FROM labels) AND task != 'status')")
def review_todo(spark, sf):
    d, k = table(spark, sf, "documents"), F.col("doc_id")
    items = d.select(k.alias("id"), F.when(k % 2 == 0, "theory").otherwise("related").alias("role"), F.when(k % 3 == 0, "1900").otherwise("").alias("date"), F.when(k % 5 == 0, "debunked").alias("status"))
    done = table(spark, sf, "labels").select(k.alias("id"), F.explode(F.array(F.lit("date"), F.lit("roles"))).alias("task")).distinct()
    return build.todo(items, done)


@query("SELECT doc_id AS id, source AS title FROM documents WHERE lang = 'en' AND doc_id NOT IN (SELECT doc_id FROM labels)")
def untranslated(spark, sf):
    d = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.col("source").alias("title"), F.when(F.col("lang") == "en", "theory").otherwise("related").alias("role"))
    return build.untranslated(d, table(spark, sf, "labels").select(F.col("doc_id").alias("id")).distinct())


# the leaderboard service


_SERVICE = E + """, lv AS (SELECT unnest([1, 2, 3]) AS lvl, unnest(['P2', 'P7', 'P3']) AS start, unnest([2, 2, 4]) AS dist, unnest([4, 3, 5]) AS budget),
sub AS (SELECT o_orderkey AS id, o_orderkey % 19 > 0 AS allowed, o_orderkey % 23 > 0 AS ok, CASE WHEN o_orderkey % 17 = 0 THEN '' ELSE 'n' || o_custkey % 40 END AS nick, CASE WHEN o_orderkey % 29 = 0 THEN 100 WHEN o_orderkey % 31 = 0 THEN 9 ELSE 1 + o_orderkey % 3 END AS lvl, CASE WHEN o_orderkey % 37 = 0 THEN ['P2'] WHEN o_orderkey % 11 = 0 THEN ['P2', 'P2', 'P1'] WHEN o_orderkey % 7 = 0 THEN ['P2', 'C' || o_custkey, 'P7', 'C5', 'P9', 'P1'] ELSE [(['P2', 'P7', 'P3'])[1 + o_orderkey % 3], 'C' || o_custkey, CASE WHEN o_orderkey % 13 = 0 THEN 'P5' ELSE 'P1' END] END AS path, o_orderkey % 120 AS hints FROM orders),
st AS (SELECT id, unnest(range(1, len(path))) AS i, path FROM sub), prs AS (SELECT id, i, path[i] AS x, path[i + 1] AS y FROM st), still AS (SELECT id, min(i) AS i FROM prs WHERE x = y GROUP BY 1), broken AS (SELECT id, min(i) AS i FROM prs WHERE NOT EXISTS (SELECT 1 FROM e WHERE a = least(x, y) AND b = greatest(x, y)) GROUP BY 1),
jd AS (SELECT sub.id, ok, lvl, nick, CASE WHEN NOT allowed THEN 'too_many' WHEN NOT ok THEN 'bad_json' WHEN nick = '' THEN 'no_nick' WHEN lvl > 99 THEN 'bad_level' WHEN len(path) < 2 THEN 'bad_path' WHEN start IS NULL THEN 'no_level' WHEN path[1] != start THEN 'wrong_start' WHEN path[-1] != 'P1' THEN 'not_finished' WHEN len(path) - 1 > budget THEN 'over_budget' WHEN still.i IS NOT NULL THEN 'repeat' WHEN broken.i IS NOT NULL THEN 'no_such_link' END AS error, still.i AS si, broken.i AS bi, len(path) - 1 AS moves, dist, least(hints, 99) AS hints FROM sub LEFT JOIN lv USING (lvl) LEFT JOIN still ON still.id = sub.id LEFT JOIN broken ON broken.id = sub.id),
judged AS (SELECT id, ok, lvl, nick, error, CASE error WHEN 'repeat' THEN si WHEN 'no_such_link' THEN bi END AS step, CASE WHEN error IS NULL THEN greatest(100, 1000 - 120 * (moves - dist) - 100 * hints) END AS score FROM jd)"""


def submissions(spark, sf):
    """Bodies as they are sent, with what the rate limiter said of them."""
    k, c = F.col("o_orderkey"), F.col("o_custkey").cast("string")
    hub = F.concat(F.lit("C"), c)
    start = F.element_at(F.array(F.lit("P2"), F.lit("P7"), F.lit("P3")), (1 + k % 3).cast("int"))
    path = (
        F.when(k % 37 == 0, F.array(F.lit("P2"))).when(k % 11 == 0, F.array(F.lit("P2"), F.lit("P2"), F.lit("P1")))
        .when(k % 7 == 0, F.array(F.lit("P2"), hub, F.lit("P7"), F.lit("C5"), F.lit("P9"), F.lit("P1"))).otherwise(F.array(start, hub, F.when(k % 13 == 0, "P5").otherwise("P1")))
    )
    lvl = F.when(k % 29 == 0, 100).when(k % 31 == 0, 9).otherwise(1 + k % 3)
    body = F.to_json(F.struct(lvl.alias("lvl"), F.when(k % 17 == 0, " <>").otherwise(F.concat(F.lit("n"), (F.col("o_custkey") % 40).cast("string"))).alias("nick"), path.alias("path"), (k % 120).alias("hints"), F.lit("x").alias("secs")))
    return table(spark, sf, "orders").select(k.alias("id"), F.when(k % 23 == 0, "{no").otherwise(body).alias("body"), (k % 19 > 0).alias("allowed"))


def judged_runs(spark, sf):
    sent = submissions(spark, sf)
    levels = spark.createDataFrame([(1, "P2", 2, 4), (2, "P7", 2, 3), (3, "P3", 4, 5)], "lvl int, start string, dist int, budget int")
    return service.validated(service.parsed(sent).join(sent.select("id", "allowed"), "id"), levels, all_edges(spark, sf), "P1")


@query(f"WITH {_SERVICE} SELECT id, CASE WHEN ok THEN lvl END AS lvl, error, step, score FROM judged")
def run_validation(spark, sf):
    return judged_runs(spark, sf).select("id", "lvl", "error", "step", "score")


@query(f"WITH {_SERVICE}, b AS (SELECT lvl, nick, max(score) AS best FROM judged WHERE error IS NULL GROUP BY 1, 2), r AS (SELECT *, rank() OVER (PARTITION BY lvl ORDER BY best DESC) AS rank FROM b) SELECT id, lvl, nick, score, best, rank FROM judged JOIN r USING (lvl, nick) WHERE error IS NULL")
def board_feed(spark, sf):
    return service.ranked(judged_runs(spark, sf))


_RUNS_SQL = "runs AS (SELECT o_orderkey AS id, substr(o_orderpriority, 1, 1)::INT AS lvl, 'C' || o_custkey AS nick, o_orderkey % 9 + 3 AS moves, o_orderkey % 301 AS secs, greatest(100, 1000 - 120 * (o_orderkey % 9) - 100 * (o_orderkey % 4)) AS score FROM orders)"


@query(f"WITH {_RUNS_SQL} SELECT nick, sum(score)::BIGINT AS total, count(*) AS levels FROM (SELECT nick, lvl, max(score) AS score FROM runs GROUP BY 1, 2) GROUP BY 1 ORDER BY total DESC, levels DESC, nick LIMIT 50")
def board_top(spark, sf):
    return service.top(runs(spark, sf), None, 1000)


@query(f"WITH {_RUNS_SQL} SELECT lvl, nick, max(score) AS score, min(moves) AS moves, min(secs) AS secs FROM runs WHERE lvl = 2 GROUP BY 1, 2 ORDER BY score DESC, moves, secs, nick LIMIT 20")
def board_top_level(spark, sf):
    return service.top(runs(spark, sf), 2)


@query(f"WITH {E} SELECT 3 AS levels, (SELECT count(*) FROM e) AS edges, (SELECT count(*) FROM orders) AS runs, (SELECT count(*) FROM e) > 0 AS ok")
def service_health(spark, sf):
    levels = spark.createDataFrame([(1,), (2,), (3,)], "lvl int")
    return service.health(levels, all_edges(spark, sf), table(spark, sf, "orders"))


@query(f"WITH RECURSIVE {_BFS} SELECT dist, count(*) AS nodes, min(node) AS first FROM dist GROUP BY 1")
def reach_map(spark, sf):
    return graph.distances(all_edges(spark, sf), "P1").groupBy("dist").agg(F.count("*").alias("nodes"), F.min("node").alias("first"))




# second passes over what is there


@query(f"WITH {M}, {_RESOLVED}, w AS (SELECT target FROM m GROUP BY 1 HAVING count(*) >= 25), j AS (SELECT 'H' || substr(source, 2)::BIGINT // 2 AS source, id AS target, n, in_lead FROM m JOIN res ON title = 'T' || substr(target, 2) WHERE m.target IN (FROM w)), k AS (SELECT source, target, sum(n)::BIGINT AS n, bool_or(in_lead) AS in_lead FROM j WHERE target IS NOT NULL GROUP BY 1, 2) SELECT * FROM k WHERE target IN (SELECT target FROM k GROUP BY 1 HAVING count(*) >= 25)")
def support_twice(spark, sf):
    m = base_mentions(spark, sf).select(F.col("source").alias("hub"), F.concat(F.lit("T"), F.col("target").substr(2, 20)).alias("title"), "n", "in_lead")
    hub_ids = m.select("hub").distinct().withColumn("id", F.concat(F.lit("H"), F.floor(F.col("hub").substr(2, 20).cast("long") / 2).cast("string")))
    return build.supported(m, resolved_ids(spark, sf), hub_ids, 25)


@query("SELECT p_partkey, CASE WHEN p_type = 'PROMO' THEN 'class' WHEN regexp_matches(p_name, 'red|blue') THEN 'title' WHEN p_size >= 40 THEN 'languages' END AS why, 1 + p_size % 4 AS confidence FROM part")
def keep_and_reject(spark, sf):
    found = [(F.col("p_type") == "PROMO", "class"), (F.col("p_name").rlike("red|blue"), "title"), (F.col("p_size") >= 40, "languages")]
    yes, no = build.kept_and_rejected(table(spark, sf, "part"), found)
    languages = F.slice(F.array(F.lit("en"), F.lit("fr"), F.lit("lt"), F.lit("en")), F.lit(1), F.col("p_size") % 4)
    return yes.select("p_partkey", "why", build.expansion_confidence(languages).alias("confidence")).union(no.select("p_partkey", F.lit(None), build.expansion_confidence(languages)))


@query("SELECT p_partkey FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 45)")
def pending_items(spark, sf):
    return build.pending(table(spark, sf, "part").select("p_partkey"), table(spark, sf, "lineitem").filter("l_quantity > 45").select(F.col("l_partkey").alias("p_partkey")), "p_partkey")


@query("SELECT DISTINCT o_custkey AS a, o_orderkey % 50 AS b FROM orders")
def insert_or_ignore(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("a"), (F.col("o_orderkey") % 50).alias("b"), "o_orderkey")
    return build.insert_or_ignore(o.filter("o_orderkey % 2 = 0").select("a", "b").distinct(), o.select("a", "b"), ["a", "b"])


@query("SELECT event_id, CASE WHEN event_id % 3 > 0 THEN 'e' || event_id END AS label_en, CASE WHEN event_id % 2 = 0 THEN 'l' || event_id END AS label_lt, CASE WHEN event_id % 5 = 0 THEN 'T ' || event_type END AS enwiki, (event_id % 3 > 0)::INT + (event_id % 2 = 0)::INT AS n_labels FROM events")
def entity_records(spark, sf):
    k = F.col("event_id")
    value = lambda name, c: F.concat(F.lit(f'"{name}":{{"value":"'), c, F.lit('"}'))
    labels = F.concat_ws(",", F.when(k % 3 > 0, value("en", F.concat(F.lit("e"), k.cast("string")))), F.when(k % 2 == 0, value("lt", F.concat(F.lit("l"), k.cast("string")))))
    links = F.when(k % 5 == 0, F.concat(F.lit('"enwiki":{"title":"T '), "event_type", F.lit('"}'))).otherwise("")
    body = F.concat(F.lit('{"labels":{'), labels, F.lit('},"sitelinks":{'), links, F.lit("}}"))
    return build.entity_records(table(spark, sf, "events").select("event_id", body.alias("body")), "body", ["en", "lt"], ["enwiki"])


@query("SELECT doc_id, substr(array_to_string(string_split(replace(text, chr(10), ' '), '. ')[1:2], '. '), 1, 300) AS summary FROM documents")
def review_cases(spark, sf):
    return table(spark, sf, "documents").select("doc_id", build.review_case(F.col("text")).alias("summary"))


@query("SELECT lang, count(*) AS n, sum(length(text))::BIGINT AS chars FROM documents WHERE text != '' GROUP BY 1")
def summary_map(spark, sf):
    maps = build.summary_map(table(spark, sf, "documents").select("lang", F.col("doc_id").alias("id"), F.col("text").alias("summary")))
    chars = F.aggregate(F.map_values("summaries"), F.lit(0).cast("long"), lambda acc, x: acc + F.length(x))
    return maps.groupBy("lang").agg(F.sum(F.size("summaries").cast("long")).alias("n"), F.sum(chars).alias("chars"))


@query("SELECT DISTINCT unnest(regexp_extract_all(html, '<a href=\"/([^\"]+)\"', 1)) AS title FROM pages")
def list_page_links(spark, sf):
    return table(spark, sf, "pages").select(F.explode(F.regexp_extract_all("html", F.lit('<a href="/([^"]+)"'), 1)).alias("title")).distinct()


@query("SELECT DISTINCT k FROM (SELECT l_partkey AS k FROM lineitem UNION ALL SELECT l_suppkey FROM lineitem)")
def required_keys(spark, sf):
    lines = table(spark, sf, "lineitem")
    return lines.select(F.col("l_partkey").alias("k")).union(lines.select("l_suppkey")).distinct()


_WEIGHTS = M + ", hub AS (SELECT DISTINCT source AS id FROM m WHERE substr(source, 2)::BIGINT % 3 > 0), mm AS (SELECT * FROM m UNION ALL SELECT source, 'C' || (substr(target, 2)::BIGINT % 90), n, in_lead FROM m WHERE n > 1), own AS (SELECT source, target, sum(n)::BIGINT AS n FROM mm WHERE source IN (FROM hub) GROUP BY 1, 2), sh AS (SELECT * FROM own WHERE target NOT IN (FROM hub) AND target NOT LIKE '%3'), k AS (SELECT target, count(*) AS k FROM sh GROUP BY 1 HAVING count(*) BETWEEN 2 AND 60), pr AS (SELECT x.source AS a, y.source AS b, ln(1 + 60.0 / k) * sqrt(x.n * y.n) AS w FROM sh x JOIN sh y ON x.target = y.target AND x.source < y.source JOIN k ON k.target = x.target UNION ALL SELECT least(source, target), greatest(source, target), 3.0 * n FROM own WHERE target IN (FROM hub) AND source != target), pw AS (SELECT a, b, round(sum(w), 5) AS weight FROM pr GROUP BY 1, 2)"


def weighted_pairs(spark, sf):
    """Hubs and their pairs, by numbers: twice a document's, and twice an entity's and one."""
    m = settle(hub_mentions(spark, sf).select((F.col("source") * 2).alias("source"), (F.col("target") * 2 + 1).alias("target"), "n"))
    hubs = m.select(F.col("source").alias("id")).distinct().filter(F.shiftright("id", 1) % 3 > 0)
    more = m.filter("n > 1").select("source", (F.shiftright("target", 1) % 90 * 2).alias("target"), "n")
    every = m.union(more).groupBy("source", "target").agg(F.sum("n").alias("n"))
    # names that end in 3
    generic = every.select(F.col("target").alias("id")).distinct().filter(F.shiftright("id", 1) % 10 == 3)
    return hubs, graph.pair_weights(every, hubs, generic)


def hub_id(c):
    return F.concat(F.lit("C"), F.shiftright(c, 1).cast("string"))


@query(f"WITH {_WEIGHTS} SELECT * FROM pw")
def pair_weights(spark, sf):
    pairs = weighted_pairs(spark, sf)[1]
    return pairs.select(F.least(hub_id("a"), hub_id("b")).alias("a"), F.greatest(hub_id("a"), hub_id("b")).alias("b"), F.round("weight", 5).alias("weight"))


@query(f"WITH {_WEIGHTS} SELECT id FROM hub WHERE id NOT IN (SELECT a FROM pw WHERE weight > 60 UNION SELECT b FROM pw WHERE weight > 60)")
def isolates(spark, sf):
    hubs, pairs = weighted_pairs(spark, sf)
    return graph.isolates(hubs, pairs.filter(F.round("weight", 5) > 60)).select(hub_id("id").alias("id"))


@query(f"WITH {E}, deg AS (SELECT node, count(*) AS k FROM (SELECT a AS node FROM e UNION ALL SELECT b FROM e) GROUP BY 1), ok AS (SELECT node FROM deg WHERE (k >= 2 OR node = 'P1') AND node NOT IN (SELECT 'P' || p_partkey FROM part WHERE p_type = 'PROMO' OR p_size > 45)) SELECT a, b FROM e WHERE a IN (FROM ok) AND b IN (FROM ok)")
def game_graph_plain(spark, sf):
    generic = part_ids(spark, sf).filter("p_type = 'PROMO' or p_size > 45").select(F.col("id").alias("node"))
    return graph.game_graph(all_edges(spark, sf), "P1", generic)


@query(f"WITH {D} SELECT source, target, p_type = 'PROMO' OR df > 0.05 * total AS generic FROM m JOIN d USING (target) JOIN part ON target = 'P' || p_partkey CROSS JOIN t")
def generic_targets(spark, sf):
    m = base_mentions(spark, sf).join(part_ids(spark, sf).select(F.col("id").alias("target"), "p_type"), "target")
    return mentions.weighted(m, 0.05, F.col("p_type") == "PROMO").select("source", "target", "generic")


_TWO = "par AS (SELECT p_partkey AS node, p_partkey // 3 AS parent FROM part WHERE p_partkey > 2 UNION SELECT p_partkey, p_partkey // 5 FROM part WHERE p_partkey % 4 = 1 AND p_partkey > 4)"


@query(f"WITH RECURSIVE {_TWO}, up AS (SELECT DISTINCT p_partkey AS node, p_partkey AS ancestor, 0 AS dist FROM part WHERE p_partkey IN (SELECT node FROM par) UNION SELECT up.node, par.parent, dist + 1 FROM up JOIN par ON par.node = up.ancestor WHERE dist < 7) SELECT node, ancestor, min(dist) AS dist FROM up GROUP BY 1, 2")
def class_tree(spark, sf):
    k, p = F.col("p_partkey"), table(spark, sf, "part")
    parent = p.filter(k > 2).select(k.alias("node"), F.floor(k / 3).alias("parent")).union(p.filter((k % 4 == 1) & (k > 4)).select(k, F.floor(k / 5))).distinct()
    return graph.ancestors(parent, 7)


_ROOTS = "st AS (SELECT p_partkey // 4 AS parent, p_partkey AS child FROM part WHERE p_partkey > 0), a1 AS (SELECT child AS node FROM st WHERE parent = 2), a2 AS (SELECT child AS node FROM st WHERE parent IN (FROM a1)), one AS (SELECT 2 AS node, 0 AS depth UNION ALL SELECT node, 1 FROM a1 UNION ALL SELECT node, 2 FROM a2), b1 AS (SELECT child AS node FROM st WHERE parent = 0 AND child NOT IN (SELECT node FROM one) AND child != 0), b2 AS (SELECT child AS node FROM st WHERE parent IN (FROM b1) AND child NOT IN (SELECT node FROM one))"


@query(f"WITH {_ROOTS} SELECT node, 2 AS root, depth FROM one UNION ALL SELECT 0, 0, 0 UNION ALL SELECT node, 0, 1 FROM b1 UNION ALL SELECT node, 0, 2 FROM b2")
def crawl_roots(spark, sf):
    k = F.col("p_partkey")
    edges = table(spark, sf, "part").filter(k > 0).select(F.floor(k / 4).alias("parent"), k.alias("child"))
    return graph.crawl_roots(edges, [(2, 2), (0, 2)], edges.select(F.col("child").alias("node")).limit(0)).select("node", "root", "depth")


@query()
def crawl_many_roots(spark, sf):
    k, p = F.col("p_partkey"), table(spark, sf, "part")
    edges = p.filter(k > 0).select(F.floor(k / 4).alias("parent"), k.alias("child")).union(p.filter(k % 3 == 1).select(F.floor(k / 7), k))
    return graph.crawl_roots(edges, [(root, root % 4) for root in range(1000, 0, -1)], p.filter(F.col("p_name").contains("red")).select(k.alias("node")))


@query("SELECT n_name AS name, c_custkey AS page FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_name = 'NATION_7'")
def first_language_with_members(spark, sf):
    c = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return graph.first_with_members(["none", "NATION_99", "NATION_7", "NATION_3"], c.select(F.col("n_name").alias("name"), F.col("c_custkey").alias("page")))


@query("SELECT '' || page_id || '.html' AS path, '<!doctype html><html><head><meta charset=\"utf-8\"><title>' || replace(replace(replace(replace(replace(url, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), chr(39), '&#x27;') || '</title><meta name=\"description\" content=\"a &amp; b\"><link rel=\"canonical\" href=\"https://e.org/' || page_id || '.html\"></head></html>' AS html FROM pages")
def share_pages(spark, sf):
    nodes = table(spark, sf, "pages").select(F.col("page_id").cast("string").alias("slug"), F.col("url").alias("title"), F.lit("a & b").alias("description"))
    return exports.pages(nodes, "https://e.org")
