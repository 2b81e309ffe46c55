"""Registered queries, each next to the SQL that states the same result."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillgraph.functions import text as T
from quillgraph.operators import board, exports, graph, layout, mentions, reach, rules
from quillgraph.operators.rounds import settle
from quillgraph.sources.tables import Settings, raw_mentions, table
from quillgraph.streaming import limits

#: What the queries are told; their SQL states the same numbers.
#: As the environment says, by names such as QUILLGRAPH_ITERATIONS.
SETTINGS = Settings.read({k.removeprefix("QUILLGRAPH_"): v for k, v in os.environ.items() if k.startswith("QUILLGRAPH_")})
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


RAW = "raw AS (SELECT 'C' || o_custkey AS source, 'P' || l_partkey AS target, l_linenumber = 1 AS in_lead, l_returnflag AS kind, l_quantity FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"
M = RAW + ", m AS (SELECT source, target, count(*) AS n, bool_or(in_lead) AS in_lead FROM raw GROUP BY 1, 2)"
D = M + ", d AS (SELECT target, count(*) AS df FROM m GROUP BY 1), t AS (SELECT count(DISTINCT source) AS total FROM m)"
E = RAW + ", e AS (SELECT DISTINCT least(source, target) AS a, greatest(source, target) AS b FROM raw)"
#: Weight of an entity type, and the default.
PRIORS, PRIOR = {"ECONOMY": 0.8, "STANDARD": 1.0, "PROMO": 1.2, "MEDIUM": 0.9}, 0.7
SCORED = D + (
    ", rev AS (SELECT DISTINCT target AS s, source AS t FROM raw WHERE kind = 'R'), s AS (SELECT source, target, n, in_lead, "
    + "sqrt(least(n, 5)) * CASE WHEN in_lead THEN 2.0 ELSE 1.0 END * ln((total + 1) / (df + 1)::DOUBLE) * CASE split_part(p_type, ' ', 1) "
    + " ".join(f"WHEN '{k}' THEN {v}" for k, v in PRIORS.items())
    + f" ELSE {PRIOR} END::DOUBLE AS base, greatest(0.4, least(1.8, ln(20000.0) / ln(20 + df))) AS spec, CASE WHEN rev.s IS NOT NULL THEN 1.5 ELSE 1.0 END AS mutual "
    + "FROM m JOIN d USING (target) JOIN part ON target = 'P' || p_partkey CROSS JOIN t LEFT JOIN rev ON rev.s = target AND rev.t = source)"
)


def base_mentions(spark: SparkSession, sf: str) -> DataFrame:
    return mentions.aggregate(raw_mentions(spark, sf))


def scored(spark: SparkSession, sf: str) -> DataFrame:
    # read three times
    m, raw = graph.settle(base_mentions(spark, sf)), raw_mentions(spark, sf)
    total = m.agg(F.count_distinct("source")).scalar()
    kind = F.split_part(F.col("p_type"), F.lit(" "), F.lit(1))
    prior = F.coalesce(F.create_map(*[F.lit(x) for kv in PRIORS.items() for x in kv])[kind], F.lit(PRIOR))
    parts = table(spark, sf, "part").select(F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("target"), prior.alias("prior"))
    back = raw.filter("kind = 'R'").select(F.col("target"), F.col("source"), F.lit(1.5).alias("mutual")).distinct()
    joined = m.join(mentions.document_frequency(m), "target").join(parts, "target").join(back, ["target", "source"], "left")
    base = mentions.base_score(F.col("n"), F.col("in_lead"), F.col("df"), total, F.col("prior"))
    return joined.select("source", "target", "n", "in_lead", base.alias("base"), mentions.specificity(F.col("df")).alias("spec"), F.coalesce("mutual", F.lit(1.0)).alias("mutual"))


def all_edges(spark: SparkSession, sf: str) -> DataFrame:
    return graph.canonical_edges(raw_mentions(spark, sf))


@query(f"WITH {M} SELECT * FROM m")
def mention_agg(spark, sf):
    return base_mentions(spark, sf)


@query(f"WITH {D} SELECT source, target, n, in_lead, df, round(sqrt(least(n, 5)) * CASE WHEN in_lead THEN 2.0 ELSE 1.0 END * (ln((total + 1) / (df + 1)::DOUBLE) + 0.1), 3) AS weight, df > 0.025 * total AS generic FROM m JOIN d USING (target) CROSS JOIN t")
def mention_weight(spark, sf):
    return mentions.weighted(base_mentions(spark, sf), 0.025).select("source", "target", "n", "in_lead", "df", "weight", "generic")


@query(f"WITH {D} SELECT m.* FROM m JOIN d USING (target) WHERE df >= 30")
def min_support(spark, sf):
    return mentions.min_support(base_mentions(spark, sf), 30).select("source", "target", "n", "in_lead")


@query(f"WITH {SCORED}, r AS (SELECT source, target, round(base * spec * mutual, 3) AS score FROM s), k AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY score DESC, target) - 1 AS rank FROM r) SELECT *, CASE WHEN rank < 20 AND score >= 1.0 THEN 'core' ELSE 'extended' END AS tier FROM k")
def mention_rank_tier(spark, sf):
    s = scored(spark, sf).select("source", "target", F.round(F.col("base") * F.col("spec") * F.col("mutual"), 3).alias("score"))
    return mentions.ranked(s, SETTINGS.core).withColumn("rank", F.col("rank").cast("long"))


@query(f"WITH {SCORED}, k AS (SELECT source, target, CASE WHEN in_lead THEN 'L' ELSE '' END || n AS code, row_number() OVER (PARTITION BY source ORDER BY round(base, 6) DESC, target) AS rn FROM s) SELECT * FROM k WHERE rn <= 40")
def top_candidates(spark, sf):
    s = scored(spark, sf).withColumn("base", F.round("base", 6))
    return mentions.top(s, SETTINGS.candidates, "base").select("source", "target", mentions.mention_code(F.col("in_lead"), F.col("n")).alias("code"), F.col("rn").cast("long").alias("rn"))


@query("WITH u AS (SELECT n_name AS title, 'category' AS source FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_acctbal < 0 UNION SELECT n_name, 'wikidata' FROM supplier JOIN nation ON s_nationkey = n_nationkey UNION SELECT n_name, 'list_page' FROM nation WHERE n_regionkey < 3 UNION SELECT n_name, 'manual' FROM nation WHERE n_nationkey = 7), g AS (SELECT title, list_sort(list(source)) AS l FROM u GROUP BY 1) SELECT title, array_to_string(l, ',') AS sources, 2 * list_contains(l, 'category')::INT + 2 * list_contains(l, 'wikidata')::INT + list_contains(l, 'list_page')::INT + 5 * list_contains(l, 'manual')::INT AS confidence FROM g")
def candidate_union(spark, sf):
    nation = table(spark, sf, "nation").withColumnRenamed("n_name", "title")
    parts = {
        "category": table(spark, sf, "customer").filter("c_acctbal < 0").join(nation, F.col("c_nationkey") == F.col("n_nationkey")),
        "wikidata": table(spark, sf, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey")),
        "list_page": nation.filter("n_regionkey < 3"),
        "manual": nation.filter("n_nationkey = 7"),
    }
    return rules.union_with_sources(parts).withColumn("sources", F.concat_ws(",", "sources"))


@query(f"WITH {D} SELECT p_partkey, CASE WHEN p_type LIKE 'PROMO%' THEN 'class' WHEN regexp_matches(lower(p_name), 'green|blue') THEN 'title' WHEN df >= 35 THEN 'support' WHEN p_size >= 40 THEN 'languages' END AS why FROM part LEFT JOIN d ON target = 'P' || p_partkey")
def keep_cascade(spark, sf):
    df = mentions.document_frequency(base_mentions(spark, sf))
    parts = table(spark, sf, "part").withColumn("target", F.concat(F.lit("P"), F.col("p_partkey").cast("string"))).join(df, "target", "left")
    why = rules.cascade([(F.col("p_type").startswith("PROMO"), "class"), (F.lower("p_name").rlike("green|blue"), "title"), (F.col("df") >= 35, "support"), (F.col("p_size") >= 40, "languages")])
    return parts.select("p_partkey", why.alias("why"))


@query(f"""WITH {D}, x AS (SELECT p_partkey, p_size, coalesce(df, 0) AS score, p_partkey % 11 = 0 AS manual, p_name LIKE '%list%' AS listlike, CASE p_partkey % 4 WHEN 0 THEN 'person' WHEN 1 THEN 'theory' WHEN 2 THEN 'theory?' ELSE 'concept' END AS kind, p_size % 2 = 0 AS clean FROM part LEFT JOIN d ON target = 'P' || p_partkey)
SELECT p_partkey, CASE WHEN p_partkey % 97 = 0 THEN 'related' WHEN manual THEN 'theory' WHEN listlike THEN 'dropped' WHEN kind = 'person' AND (score - 30 >= 2 OR (clean AND score - 30 >= 1)) THEN 'related' WHEN kind = 'person' THEN 'dropped' WHEN kind = 'theory' THEN 'theory' WHEN kind = 'theory?' AND (clean OR score - 30 >= 1) THEN 'theory' WHEN p_size % 5 >= 3 AND kind IN ('concept', 'theory?') THEN 'theory' WHEN score - 30 >= 2 OR (clean AND score - 30 >= 1) THEN 'related' ELSE 'dropped' END AS role FROM x""")
def role_cascade(spark, sf):
    df = mentions.document_frequency(base_mentions(spark, sf))
    p = table(spark, sf, "part").withColumn("target", F.concat(F.lit("P"), F.col("p_partkey").cast("string"))).join(df, "target", "left")
    key = F.col("p_partkey")
    kind = F.element_at(F.array(*map(F.lit, ("person", "theory", "theory?", "concept"))), (key % 4 + 1).cast("int"))
    score = F.coalesce("df", F.lit(0)) - 30
    return p.select("p_partkey", rules.role(F.when(key % 97 == 0, "related"), key % 11 == 0, F.col("p_name").contains("list"), kind, score, F.col("p_size") % 2 == 0, F.col("p_size") % 5).alias("role"))


@query("SELECT min(doc_id) AS doc_id, md5(text) AS digest FROM documents GROUP BY md5(text)")
def dedupe_first_wins(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", F.md5(F.col("text").cast("binary")).alias("digest"))
    return rules.first_wins(d, "digest", ["doc_id"])


@query("SELECT o_custkey, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey, arg_max(o_orderpriority, (o_orderdate, o_orderkey)) AS o_orderpriority FROM orders GROUP BY 1")
def last_wins_merge(spark, sf):
    o = table(spark, sf, "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_orderpriority")
    return rules.last_wins(o, "o_custkey", ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@query("SELECT c_custkey, coalesce(r_name, n_name, 'C' || c_custkey) AS resolved FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey AND n_nationkey % 3 > 0 LEFT JOIN region ON n_regionkey = r_regionkey AND r_regionkey % 2 = 0")
def alias_resolve(spark, sf):
    c, n, r = (table(spark, sf, t) for t in ("customer", "nation", "region"))
    joined = c.join(n.filter("n_nationkey % 3 > 0"), F.col("c_nationkey") == F.col("n_nationkey"), "left").join(r.filter("r_regionkey % 2 = 0"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
    return joined.select("c_custkey", F.coalesce("r_name", "n_name", F.concat(F.lit("C"), F.col("c_custkey").cast("string"))).alias("resolved"))


#: Theme rules of the synthetic corpus.
THEMES = {"law": "licen[sc]e|copyright", "number": "[0-9]{3}", "the": "\\bthe\\b", "marks": "[#$%&]{3}", "shout": "[A-Z]{5}"}
_TAGGED = "heads AS (SELECT doc_id, text, array_to_string(string_split(regexp_replace(text, '([.!?])[ \\t\\n\\r]', '\\1' || chr(1), 'g'), chr(1))[1:2], ' ') AS head FROM documents), tagged AS (" + " UNION ALL ".join(f"SELECT doc_id, '{k}' AS theme, 2 * regexp_matches(text, '{v}')::INT + regexp_matches(head, '{v}')::INT AS score FROM heads" for k, v in THEMES.items()) + ")"


def tagged(spark, sf):
    d = table(spark, sf, "documents").withColumn("head", T.first_sentences(F.col("text")))
    one = lambda k, v: F.struct(F.lit(k).alias("theme"), (2 * F.col("text").rlike(v).cast("int") + F.col("head").rlike(v).cast("int")).alias("score"))
    return d.select("doc_id", F.explode(F.array(*[one(k, v) for k, v in THEMES.items()])).alias("t")).select("doc_id", "t.theme", "t.score")


@query(f"WITH {_TAGGED} SELECT * FROM tagged WHERE score > 0")
def theme_tags(spark, sf):
    return tagged(spark, sf).filter("score > 0")


@query(f"WITH {_TAGGED}, r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, theme) AS rn FROM tagged WHERE score > 0) SELECT doc_id, string_agg(theme, ',' ORDER BY rn) AS themes FROM r WHERE rn <= 3 GROUP BY 1")
def theme_top3(spark, sf):
    best = F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), "theme"))), 1, 3)
    return tagged(spark, sf).filter("score > 0").groupBy("doc_id").agg(F.array_join(F.transform(best, lambda x: x["theme"]), ",").alias("themes"))


@query("SELECT doc_id, array_to_string(string_split(regexp_replace(text, '([.!?])[ \\t\\n\\r]', '\\1' || chr(1), 'g'), chr(1))[1:2], ' ') AS head FROM documents")
def first_sentences(spark, sf):
    return table(spark, sf, "documents").select("doc_id", T.first_sentences(F.col("text")).alias("head"))


@query("""WITH f AS (SELECT doc_id, trim(regexp_replace(text, '[ \\t\\n\\r]+', ' ', 'g')) AS flat FROM documents), c AS (SELECT doc_id, flat, flat[1:190] AS cut, 190 - instr(reverse(flat[1:190]), ' ') AS space FROM f)
SELECT doc_id, CASE WHEN length(flat) <= 190 THEN flat ELSE regexp_replace(CASE WHEN instr(cut, ' ') > 0 AND space > 114 THEN cut[1:space] ELSE cut END, '[ .,;:]+$', '') || '…' END AS short FROM c""")
def snippet(spark, sf):
    return table(spark, sf, "documents").select("doc_id", T.snippet(F.col("text")).alias("short"))


@query("""WITH s AS (SELECT doc_id, regexp_replace(regexp_replace(lower(strip_accents(text)), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') AS b FROM documents), t AS (SELECT doc_id, regexp_replace(b[1:60], '^-+|-+$', '', 'g') AS b FROM s)
SELECT doc_id, CASE WHEN b = '' THEN '' || doc_id ELSE b || '-' || doc_id END AS slug FROM t""")
def slug(spark, sf):
    return table(spark, sf, "documents").select("doc_id", T.slug(F.col("text"), F.col("doc_id").cast("string")).alias("slug"))


@query("SELECT page_id, replace(replace(replace(replace(replace(html, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&#x27;') AS escaped FROM pages")
def html_escape(spark, sf):
    return table(spark, sf, "pages").select("page_id", T.html_escape(F.col("html")).alias("escaped"))


@query("SELECT doc_id, substr(CASE WHEN length(flat) - length(replace(flat, '. ', '')) >= 4 THEN array_to_string(string_split(flat, '. ')[1:2], '. ') ELSE flat END, 1, 260) AS intro FROM (SELECT doc_id, replace(text, chr(10), ' ') AS flat FROM documents)")
def intro_cut(spark, sf):
    return table(spark, sf, "documents").select("doc_id", T.intro(F.col("text"), 260).alias("intro"))


@query("SELECT page_id, substr(trim(regexp_replace(html, '[\\x00-\\x1f<>]', '', 'g')), 1, 40) AS clean FROM pages")
def sanitize(spark, sf):
    return table(spark, sf, "pages").select("page_id", T.sanitize(F.col("html"), 40).alias("clean"))


@query("SELECT doc_id, array_to_string(list_distinct_ordered[1:7], ',') AS years FROM (SELECT doc_id, list_filter(l, lambda x, i: list_position(l, x) = i) AS list_distinct_ordered FROM (SELECT doc_id, regexp_extract_all(text, '\\b(1[0-9]{3}|20[0-9]{2})\\b', 1) AS l FROM documents))")
def year_list(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.concat_ws(",", T.years(F.col("text"))).alias("years"))


@query()
def year_contexts(spark, sf):
    return table(spark, sf, "documents").filter(F.col("text").rlike("[12][0-9]{3}")).select("doc_id", F.posexplode(T.year_contexts("text")).alias("pos", "context"))


@query("SELECT page_id, url_decode(replace(string_split(url, '/')[-1], '_', ' ')) AS title FROM pages")
def url_title(spark, sf):
    return table(spark, sf, "pages").select("page_id", T.url_title(F.concat(F.lit("/wiki/"), F.substring_index("url", "/", -1))).alias("title"))


_LINKS = "links AS (SELECT page_id, unnest(regexp_extract_all(html, '<a href=\"/([^\"]+)\"', 1)) AS target FROM pages), navs AS (SELECT page_id, unnest(regexp_extract_all(regexp_extract(html, '<nav>(.*)</nav>', 1), '<a href=\"/([^\"]+)\"', 1)) AS target FROM pages)"


@query(f"WITH {_LINKS} SELECT page_id, target, count(*) AS n, (page_id, target) IN (SELECT (page_id, target) FROM navs) AS in_lead FROM links GROUP BY 1, 2")
def page_links(spark, sf):
    anchors = lambda c: F.regexp_extract_all(c, F.lit('<a href="/([^"]+)"'), 1)
    lead = anchors(F.regexp_extract("html", "<nav>(.*)</nav>", 1))
    one = table(spark, sf, "pages").select("page_id", lead.alias("lead"), F.explode(anchors(F.col("html"))).alias("target"))
    return mentions.aggregate(one.select(F.col("page_id").alias("source"), "target", F.array_contains("lead", F.col("target")).alias("in_lead"))).withColumnRenamed("source", "page_id")


@query("SELECT p_partkey, regexp_extract(p_type, '^(\\w+)', 1) AS region, CASE WHEN regexp_matches(p_name, '(?i)\\b(green|lime)\\b') THEN 'theory' WHEN contains(lower(p_type), 'brass') THEN 'work' WHEN contains(lower(p_type), 'steel') THEN 'place' ELSE 'other' END AS kind FROM part")
def classify_keywords(spark, sf):
    kind = rules.cascade([(F.col("p_name").rlike(r"(?i)\b(green|lime)\b"), "theory"), (F.contains(F.lower("p_type"), F.lit("brass")), "work"), (F.contains(F.lower("p_type"), F.lit("steel")), "place")], "other")
    return table(spark, sf, "part").select("p_partkey", F.regexp_extract("p_type", r"^(\w+)", 1).alias("region"), kind.alias("kind"))


def part_tree(spark, sf):
    k = F.col("p_partkey")
    return table(spark, sf, "part").select(k.alias("node"), F.when(k > 0, F.floor(k / 4)).alias("parent"))


_TREE = "tree AS (SELECT p_partkey AS node, CASE WHEN p_partkey > 0 THEN p_partkey // 4 END AS parent FROM part)"


@query(f"WITH {_TREE} SELECT node, node AS ancestor, 0 AS dist FROM tree UNION ALL SELECT a.node, a.parent, 1 FROM tree a WHERE a.parent IS NOT NULL UNION ALL SELECT a.node, b.parent, 2 FROM tree a JOIN tree b ON a.parent = b.node WHERE b.parent IS NOT NULL")
def ancestor_chain(spark, sf):
    return graph.ancestors(part_tree(spark, sf), 2)


@query(f"WITH RECURSIVE {_TREE}, up AS (SELECT node, parent AS ancestor FROM tree WHERE parent IS NOT NULL UNION SELECT up.node, t.parent FROM up JOIN tree t ON t.node = up.ancestor WHERE t.parent IS NOT NULL) SELECT * FROM up")
def class_closure(spark, sf):
    return reach.closure(part_tree(spark, sf))


_PARENTS = "parents AS (SELECT p_partkey AS node, p_partkey // 4 AS parent FROM part WHERE p_partkey > 0 UNION SELECT p_partkey, p_partkey // 7 FROM part WHERE p_partkey % 3 = 1 UNION SELECT 0, 5)"


def part_parents(spark, sf):
    """Two parents for a third of the parts, and a circle at the top."""
    k, p = F.col("p_partkey"), table(spark, sf, "part")
    two = p.filter(k > 0).select(k.alias("node"), F.floor(k / 4).alias("parent")).union(p.filter(k % 3 == 1).select(k, F.floor(k / 7)))
    return two.union(spark.createDataFrame([(0, 5)], "node long, parent long"))


@query(f"WITH RECURSIVE {_PARENTS}, up AS (SELECT node, parent AS ancestor FROM parents UNION SELECT up.node, p.parent FROM up JOIN parents p ON p.node = up.ancestor) SELECT * FROM up")
def class_reach(spark, sf):
    index = reach.reach_index(part_parents(spark, sf))
    return reach.above(index, index.labels)


@query(f"WITH RECURSIVE {_PARENTS}, below AS (SELECT DISTINCT p_size::BIGINT AS root, p_size::BIGINT AS node FROM part WHERE p_size IN (SELECT node FROM parents) UNION SELECT root, p.node FROM below b JOIN parents p ON p.parent = b.node) SELECT * FROM below")
def classes_below(spark, sf):
    return reach.below(reach.reach_index(part_parents(spark, sf)), table(spark, sf, "part").select(F.col("p_size").cast("long").alias("root")).distinct())


@query(f"WITH RECURSIVE {_PARENTS}, up AS (SELECT node, parent AS ancestor FROM parents UNION SELECT up.node, p.parent FROM up JOIN parents p ON p.node = up.ancestor) SELECT l_partkey AS node, p_size::BIGINT AS ancestor, l_partkey = p_size OR EXISTS (FROM up WHERE node = l_partkey AND ancestor = p_size) AS reached FROM (SELECT DISTINCT l_partkey, p_size FROM lineitem JOIN part ON p_partkey = l_suppkey) WHERE l_partkey IN (SELECT node FROM parents)")
def mention_reaches(spark, sf):
    parents = part_parents(spark, sf)
    m = table(spark, sf, "lineitem").join(table(spark, sf, "part"), F.col("p_partkey") == F.col("l_suppkey")).select(F.col("l_partkey").alias("node"), F.col("p_size").cast("long").alias("ancestor")).distinct()
    return reach.reaches(reach.reach_index(parents), m.join(parents.select("node").distinct(), "node", "left_semi"))


@query(f"WITH RECURSIVE {_TREE}, roots AS (SELECT * FROM (VALUES (1, 'person', 0), (2, 'work', 1), (5, 'place', 2), (9, 'event', 3)) AS r(root, kind, priority)), up AS (SELECT node, node AS spot, 0 AS dist FROM tree UNION SELECT up.node, t.parent, dist + 1 FROM up JOIN tree t ON t.node = up.spot WHERE t.parent IS NOT NULL AND dist < 6 AND up.spot NOT IN (SELECT root FROM roots)) SELECT node, arg_min(kind, (dist, priority)) AS kind, min(dist) AS dist FROM up JOIN roots ON spot = root GROUP BY 1")
def nearest_root(spark, sf):
    roots = spark.createDataFrame([(1, "person", 0), (2, "work", 1), (5, "place", 2), (9, "event", 3)], "root long, kind string, priority int")
    return graph.nearest_root(part_tree(spark, sf), roots)


@query(f"WITH {E} SELECT * FROM e")
def canonical_edges(spark, sf):
    return all_edges(spark, sf)


@query(f"WITH {E} SELECT node, count(*) AS degree FROM (SELECT a AS node FROM e UNION ALL SELECT b FROM e) GROUP BY 1")
def degree(spark, sf):
    return graph.degrees(all_edges(spark, sf))


_GAME = E + ", deg AS (SELECT node, count(*) AS k FROM (SELECT a AS node FROM e UNION ALL SELECT b FROM e) GROUP BY 1), ok AS (SELECT node FROM deg WHERE k >= 10 OR node = 'P1')"


@query(f"WITH {_GAME} SELECT a, b FROM e WHERE a IN (FROM ok) AND b IN (FROM ok)")
def game_graph(spark, sf):
    return graph.game_graph(all_edges(spark, sf), "P1", least=10)


_BFS = E + ", n AS (SELECT a AS x, b AS y FROM e UNION ALL SELECT b, a FROM e), bfs AS (SELECT 'P1' AS node, 0 AS dist UNION SELECT y, dist + 1 FROM bfs JOIN n ON x = node WHERE dist < 12), dist AS (SELECT node, min(dist) AS dist FROM bfs GROUP BY 1)"


@query(f"WITH RECURSIVE {_BFS} SELECT * FROM dist")
def bfs_distance(spark, sf):
    return graph.distances(all_edges(spark, sf), "P1")


@query(f"WITH RECURSIVE {_BFS} SELECT dist, count(*) AS nodes FROM dist GROUP BY 1")
def reach_histogram(spark, sf):
    return graph.reach(graph.distances(all_edges(spark, sf), "P1"))


_WANTED = [(i + 1, f"P{p}", s, e) for i, (p, s, e) in enumerate([(2, 3, None), (7, 2, 2), (11, 3, None), (19, 2, 9), (23, 3, None), (31, 2, None), (47, 3, None), (59, 2, None), (83, 1, None), (999_999_999, 1, 3)])]
_LEVELS = "w(lvl, start, slack, expected) AS (VALUES " + ", ".join(f"({a}, '{b}', {c}, {d or 'NULL'}::INT)" for a, b, c, d in _WANTED) + ")"


@query(f"WITH RECURSIVE {_BFS}, {_LEVELS} SELECT lvl, start, dist, dist + slack AS budget, CASE WHEN dist IS NULL THEN 'unreachable' WHEN dist != expected THEN 'unexpected distance' END AS error FROM w LEFT JOIN dist ON node = start")
def levels(spark, sf):
    return graph.levels(graph.distances(all_edges(spark, sf), "P1"), spark.createDataFrame(_WANTED, "lvl int, start string, slack int, expected int"))


_PAIRS = RAW + ", g AS (SELECT source, target, count(*) AS n FROM raw GROUP BY 1, 2), k AS (SELECT target, count(*) AS k FROM g GROUP BY 1 HAVING count(*) BETWEEN 2 AND 60), p AS (SELECT x.source AS a, y.source AS b, round(sum(ln(1 + 60.0 / k) * sqrt(x.n * y.n)), 6) AS weight FROM g x JOIN g y ON x.target = y.target AND x.source < y.source JOIN k ON k.target = x.target GROUP BY 1, 2)"
_TOP = _PAIRS + ", bb AS (SELECT a, b, weight, a AS me, b AS it FROM p UNION ALL SELECT a, b, weight, b, a FROM p), top AS (SELECT DISTINCT a, b, weight FROM (SELECT *, row_number() OVER (PARTITION BY me ORDER BY weight DESC, it) AS r FROM bb) WHERE r <= 8)"


def hub_mentions(spark, sf):
    """Mentions by the hubs' and entities' numbers."""
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("source"))
    lines = table(spark, sf, "lineitem").select("l_orderkey", F.col("l_partkey").alias("target"))
    return lines.join(orders, "l_orderkey").groupBy("source", "target").agg(F.count("*").alias("n"))


def hub_name(c):
    return F.concat(F.lit("C"), F.col(c).cast("string"))


def named_pairs(pairs):
    """pairs (a, b, weight) of hubs' numbers under their names, a < b."""
    return pairs.select(F.least(hub_name("a"), hub_name("b")).alias("a"), F.greatest(hub_name("a"), hub_name("b")).alias("b"), "weight")


def strongest_pairs(spark, sf):
    return named_pairs(graph.strongest_co_mentions(hub_mentions(spark, sf), SETTINGS.most_hubs, SETTINGS.neighbours, tie=hub_name("b")))


@query(f"WITH {_PAIRS} SELECT * FROM p")
def co_mention_pairs(spark, sf):
    return named_pairs(graph.co_mentions(hub_mentions(spark, sf), SETTINGS.most_hubs).withColumn("weight", F.round("weight", 6)))


@query(f"WITH {_TOP} SELECT * FROM top")
def topk_neighbours(spark, sf):
    return strongest_pairs(spark, sf)


@query(f"WITH {_TOP} SELECT a, b, round(weight / avg(weight) OVER (), 6) AS weight FROM top")
def pair_weight_norm(spark, sf):
    # read twice
    return graph.normalized(settle(strongest_pairs(spark, sf))).withColumn("weight", F.round("weight", 6))


_PATHS = E + ", paths AS (SELECT o_orderkey AS id, ['C' || o_custkey, 'P' || (o_orderkey % 50 + 1), 'C' || (o_custkey % 40 + 1)] AS path FROM orders), st AS (SELECT id, i - 1 AS step, path[i] AS x, path[i + 1] AS y FROM paths, (VALUES (1), (2)) v(i))"


@query(f"WITH {_PATHS}, bad AS (SELECT id, min(step) AS bad_step FROM st WHERE NOT EXISTS (SELECT 1 FROM e WHERE a = least(x, y) AND b = greatest(x, y)) GROUP BY 1) SELECT id, bad_step FROM paths LEFT JOIN bad USING (id)")
def path_validate(spark, sf):
    path = F.array(F.concat(F.lit("C"), F.col("o_custkey").cast("string")), F.concat(F.lit("P"), (F.col("o_orderkey") % 50 + 1).cast("string")), F.concat(F.lit("C"), (F.col("o_custkey") % 40 + 1).cast("string")))
    return graph.check_paths(table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), path.alias("path")), all_edges(spark, sf))


_RUNS = "runs AS (SELECT o_orderkey AS id, substr(o_orderpriority, 1, 1)::INT AS lvl, 'C' || o_custkey AS nick, o_orderkey % 9 + 3 AS moves, o_orderkey % 4 AS hints, o_orderkey % 301 AS secs, greatest(100, 1000 - 120 * (o_orderkey % 9) - 100 * (o_orderkey % 4)) AS score FROM orders)"


def runs(spark, sf):
    k = F.col("o_orderkey")
    o = table(spark, sf, "orders").select(k.alias("id"), F.substring("o_orderpriority", 1, 1).cast("int").alias("lvl"), F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("nick"), (k % 9 + 3).alias("moves"), (k % 4).alias("hints"), (k % 301).alias("secs"))
    return o.withColumn("score", board.points(F.col("moves"), F.lit(3), F.col("hints")))


@query(f"WITH {_RUNS} SELECT lvl, nick, max(score) AS score, min(moves) AS moves, min(secs) AS secs FROM runs GROUP BY 1, 2")
def board_level(spark, sf):
    return board.level_board(runs(spark, sf))


@query(f"WITH {_RUNS} SELECT nick, sum(score)::BIGINT AS total, count(*) AS levels FROM (SELECT nick, lvl, max(score) AS score FROM runs GROUP BY 1, 2) GROUP BY 1")
def board_total(spark, sf):
    return board.total_board(runs(spark, sf))


@query(f"WITH {_RUNS} SELECT lvl, nick, score, rank() OVER (PARTITION BY lvl ORDER BY score DESC) AS place FROM (SELECT lvl, nick, max(score) AS score FROM runs GROUP BY 1, 2)")
def board_rank(spark, sf):
    return board.placement(runs(spark, sf)).withColumn("place", F.col("place").cast("long"))


@query(f"WITH {_RUNS} SELECT * EXCLUDE rn FROM (SELECT *, row_number() OVER (PARTITION BY lvl, nick ORDER BY score DESC, moves, secs, id) AS rn FROM runs) WHERE rn = 1")
def best_run(spark, sf):
    return board.best_runs(runs(spark, sf))


_REVIEW = M + ", items AS (SELECT 'C' || c_custkey AS id, CASE WHEN c_custkey % 3 = 0 THEN 'theory' ELSE 'related' END AS role, CASE WHEN c_custkey % 7 = 0 THEN 'confirmed' END AS status, c_custkey % 10 = 0 AS manual FROM customer UNION ALL SELECT 'P' || p_partkey, CASE WHEN p_partkey % 5 = 0 THEN 'theory' ELSE 'related' END, NULL, false FROM part), rv AS (SELECT 'C' || c_custkey AS id, CASE WHEN c_custkey % 4 = 0 THEN 'not_theory' ELSE 'disputed' END AS status FROM customer WHERE c_custkey % 2 = 0), ro AS (SELECT source, target, 'sub' AS code FROM m WHERE n >= 2), i2 AS (SELECT id, CASE WHEN rv.status = 'not_theory' AND role = 'theory' THEN 'related' ELSE role END AS role, CASE WHEN rv.status != 'not_theory' AND NOT manual THEN rv.status ELSE items.status END AS status, manual FROM items LEFT JOIN rv USING (id))"


def reviewed_tables(spark, sf):
    m, k, p = base_mentions(spark, sf), F.col("c_custkey"), F.col("p_partkey")
    c = table(spark, sf, "customer").select(k, F.concat(F.lit("C"), k.cast("string")).alias("id"))
    items = c.select("id", F.when(k % 3 == 0, "theory").otherwise("related").alias("role"), F.when(k % 7 == 0, "confirmed").alias("status"), (k % 10 == 0).alias("manual"))
    items = items.union(table(spark, sf, "part").select(F.concat(F.lit("P"), p.cast("string")), F.when(p % 5 == 0, "theory").otherwise("related"), F.lit(None).cast("string"), F.lit(False)))
    reviews = c.filter(k % 2 == 0).select("id", F.when(k % 4 == 0, "not_theory").otherwise("disputed").alias("status"))
    return rules.merge_reviews(m.withColumn("code", F.lit(None)), items, reviews, m.filter("n >= 2").select("source", "target", F.lit("sub").alias("code")))


@query(f"""WITH {_REVIEW}, c AS (SELECT m.source, m.target, ro.code, rv.id IS NOT NULL AS seen FROM m LEFT JOIN ro ON ro.source = m.source AND ro.target = m.target LEFT JOIN rv ON rv.id = m.source), anchored AS (SELECT DISTINCT target FROM c WHERE seen AND code IS NOT NULL)
SELECT source, target, CASE WHEN seen THEN code END AS code, CASE WHEN (seen AND code IS NOT NULL) OR (NOT seen AND (target IN (FROM anchored) OR target IN (SELECT id FROM i2 WHERE role = 'theory'))) THEN 'core' ELSE 'extended' END AS tier FROM c""")
def review_merge(spark, sf):
    return reviewed_tables(spark, sf)[0]


@query(f"WITH {_REVIEW} SELECT * FROM i2")
def review_items(spark, sf):
    return reviewed_tables(spark, sf)[1]


_CHECKED = M + ", known AS (SELECT 'C' || c_custkey AS id FROM customer WHERE c_custkey % 2 = 0), rv AS (SELECT 'C' || c_custkey AS id, CASE c_custkey % 7 WHEN 0 THEN 'odd' WHEN 1 THEN NULL ELSE 'debunked' END AS status FROM customer WHERE c_custkey % 4 < 3), ro AS (SELECT source, target, CASE WHEN n % 2 = 0 THEN 'sub' WHEN n % 3 = 0 THEN 'xyz' ELSE 'acc' END AS code, n FROM m WHERE n >= 2)"


@query(f"WITH {_CHECKED} SELECT 'unknown theory' AS rule, id FROM rv WHERE id NOT IN (FROM known) UNION ALL SELECT 'status', id FROM rv WHERE coalesce(status, 'odd') = 'odd' UNION ALL SELECT 'not a candidate', source FROM ro WHERE target LIKE '%7' UNION ALL SELECT 'code', source FROM ro WHERE code = 'xyz' UNION ALL SELECT 'missing', id FROM known WHERE id NOT IN (SELECT id FROM rv)")
def role_violations(spark, sf):
    m, k = base_mentions(spark, sf).filter("n >= 2"), F.col("c_custkey")
    c = table(spark, sf, "customer").select(k, F.concat(F.lit("C"), k.cast("string")).alias("id"))
    reviews = c.filter(k % 4 < 3).select("id", F.when(k % 7 == 0, "odd").when(k % 7 != 1, "debunked").alias("status"))
    roles = m.select("source", "target", F.when(F.col("n") % 2 == 0, "sub").when(F.col("n") % 3 == 0, "xyz").otherwise("acc").alias("code"))
    return rules.role_violations(reviews, roles, c.filter(k % 2 == 0).select("id"), m.filter("target not like '%7'").select("source", "target"))


@query("SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) // 20 + 1 AS batch FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def todo_batches(spark, sf):
    todo = table(spark, sf, "documents").select("doc_id").join(table(spark, sf, "labels"), "doc_id", "left_anti")
    return rules.in_batches(todo, ["doc_id"], 20)


@query("SELECT doc_id, CASE WHEN doc_id % 3 > 0 AND doc_id % 5 > 0 AND doc_id % 7 > 0 THEN '' || (1900 + doc_id % 5) WHEN doc_id % 3 = 0 THEN '1800' END AS d, CASE WHEN doc_id % 3 > 0 AND doc_id % 5 > 0 AND doc_id % 7 > 0 THEN 'year' END AS dp FROM documents")
def date_merge(spark, sf):
    k = F.col("doc_id")
    nodes = table(spark, sf, "documents").select(k.alias("id"), F.when(k % 3 == 0, "1800").alias("d"))
    dates = table(spark, sf, "documents").select(k.alias("id"), F.when(k % 5 > 0, 1900 + k % 5).otherwise(0).alias("y"), F.when(k % 7 > 0, "year").otherwise("none").alias("p"))
    return rules.merge_dates(nodes, dates).select(F.col("id").alias("doc_id"), "d", "dp")


_POINTS = "pts AS (SELECT vec_id AS id, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y, label AS cluster FROM embeddings)"


def positions(spark, sf):
    at = lambda i: F.get("embedding", F.lit(i)).cast("double")
    return table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), at(0).alias("x"), at(1).alias("y"), F.col("label").alias("cluster"))


@query(f"WITH {_POINTS}, l AS (SELECT id % 40 AS id, x, y, 1 + id % 3 AS w, cluster FROM pts), v AS (SELECT id, cluster, sum(w) AS w FROM l GROUP BY 1, 2), b AS (SELECT id, arg_max(cluster, (w, -cluster)) AS cluster FROM v GROUP BY 1) SELECT id, round(sum(x * w) / sum(w), 6) AS x, round(sum(y * w) / sum(w), 6) AS y, any_value(b.cluster) AS cluster FROM l JOIN b USING (id) GROUP BY 1")
def weighted_centroid(spark, sf):
    links = positions(spark, sf).select((F.col("id") % 40).alias("id"), "x", "y", (1 + F.col("id") % 3).alias("w"), "cluster")
    return layout.weighted_centroids(links).withColumns({"x": F.round("x", 6), "y": F.round("y", 6)})


@query(f"WITH {_POINTS}, s AS (SELECT cluster, count(*) AS n, round(avg(x), 6) AS x, round(avg(y), 6) AS y FROM pts GROUP BY 1 HAVING count(*) >= 5) SELECT *, row_number() OVER (ORDER BY n DESC, cluster) - 1 AS number FROM s")
def cluster_summary(spark, sf):
    return layout.cluster_summary(positions(spark, sf)).withColumns({"x": F.round("x", 6), "y": F.round("y", 6), "number": F.col("number").cast("long")})


@query(f"WITH {_POINTS}, g AS (SELECT *, avg(x) OVER () AS mx, avg(y) OVER () AS my, avg(x) OVER (PARTITION BY cluster) AS cx, avg(y) OVER (PARTITION BY cluster) AS cy FROM pts) SELECT round(sqrt(sum((x - cx) ** 2 + (y - cy) ** 2) / sum((x - mx) ** 2 + (y - my) ** 2)), 6) AS separation FROM g")
def separation(spark, sf):
    return layout.separation(positions(spark, sf)).withColumn("separation", F.round("separation", 6))


@query(f"WITH {_POINTS}, r AS (SELECT sqrt(x * x + y * y) AS d, row_number() OVER (ORDER BY sqrt(x * x + y * y)) - 1 AS rn, count(*) OVER () AS n FROM pts) SELECT round(d, 6) AS quantile FROM r WHERE rn = floor(0.98 * n)")
def q98_radius(spark, sf):
    far = positions(spark, sf).select(F.sqrt(F.col("x") * F.col("x") + F.col("y") * F.col("y")).alias("d"))
    return layout.nearest_rank(far, "d", 0.98).select(F.round("quantile", 6).alias("quantile"))


@query("""WITH RECURSIVE o AS (SELECT user_id, event_id, epoch_ms(ts) AS ms, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events),
w AS (SELECT user_id, event_id, rn, ms AS opened, 1 AS n FROM o WHERE rn = 1 UNION ALL SELECT o.user_id, o.event_id, o.rn, CASE WHEN o.ms - w.opened > 86400000 THEN o.ms ELSE w.opened END, CASE WHEN o.ms - w.opened > 86400000 THEN 1 ELSE w.n + 1 END FROM w JOIN o ON o.user_id = w.user_id AND o.rn = w.rn + 1)
SELECT user_id, event_id, n <= 3 AS allowed FROM w""")
def rate_limit(spark, sf):
    events = table(spark, sf, "events").select("user_id", "event_id", F.unix_millis(F.col("ts").cast("timestamp")).alias("ms"))
    return limits.limit_batch(events, 86_400_000, 3)


@query(f"WITH RECURSIVE {_BFS}, {_LEVELS}, l AS (SELECT lvl, dist, dist + slack AS budget FROM w JOIN dist ON node = start WHERE dist = coalesce(expected, dist)), g AS (SELECT unnest(['en', 'lt']) AS lang) SELECT lang, lvl, unnest([NULL] || range(dist, budget + 1))::INT AS moves FROM g CROSS JOIN l UNION ALL SELECT lang, NULL, NULL FROM g")
def game_pages(spark, sf):
    return exports.level_pages(levels(spark, sf).filter("error is null"), ["en", "lt"])


@query(f"WITH {E} SELECT count(*) AS edges, count(DISTINCT a) > 0 AS ready FROM e")
def health(spark, sf):
    return all_edges(spark, sf).agg(F.count("*").alias("edges"), (F.count_distinct("a") > 0).alias("ready"))


@query("SELECT lang, source, count(*) AS n, count(DISTINCT md5(text)) AS distinct_texts, round(avg(CASE WHEN n_chars > 1000 THEN 1.0 ELSE 0.0 END), 6) AS long_share FROM documents GROUP BY 1, 2")
def histograms(spark, sf):
    d = table(spark, sf, "documents")
    return d.groupBy("lang", "source").agg(F.count("*").alias("n"), F.count_distinct(F.md5(F.col("text").cast("binary"))).alias("distinct_texts"), F.round(F.avg(F.when(F.col("n_chars") > 1000, 1.0).otherwise(0.0)), 6).alias("long_share"))


@query()
def communities(spark, sf):
    return graph.communities(settle(strongest_pairs(spark, sf)))


@query()
def force_layout(spark, sf):
    skeleton = settle(strongest_pairs(spark, sf))
    pairs = layout.within_clusters(graph.normalized(skeleton), graph.communities(skeleton), SETTINGS.inside, SETTINGS.between)
    return layout.force_layout(pairs, SETTINGS.iterations, seed=SETTINGS.seed)


_Q = "chr(39)"


@query(f"""WITH RECURSIVE {_BFS}, {_LEVELS}, r AS (SELECT 'edges' AS kind, 'edges(a,b)' AS head, '(' || {_Q} || a || {_Q} || ',' || {_Q} || b || {_Q} || ')' AS tup, row_number() OVER (ORDER BY a, b) AS rn FROM e
UNION ALL SELECT 'levels', 'levels(lvl,start,dist,budget)', '(' || lvl || ',' || {_Q} || start || {_Q} || ',' || dist || ',' || (dist + slack) || ')', row_number() OVER (ORDER BY lvl) FROM w JOIN dist ON node = start WHERE dist = coalesce(expected, dist))
SELECT kind, (rn - 1) // 500 + 1 AS batch, 'INSERT OR IGNORE INTO ' || any_value(head) || ' VALUES ' || string_agg(tup, ',' ORDER BY rn) || ';' AS sql FROM r GROUP BY 1, 2""")
def seed_script(spark, sf):
    return exports.seed_statements(all_edges(spark, sf), levels(spark, sf).filter("error is null"))


_CATEGORIES = "steps AS (SELECT p_partkey // 4 AS parent, p_partkey AS child FROM part WHERE p_partkey > 0 UNION SELECT p_partkey // 7, p_partkey FROM part WHERE p_partkey % 3 = 1), marks AS (SELECT p_partkey AS node FROM part WHERE p_name LIKE '%red%'), l0 AS (SELECT 0 AS node, 0 AS depth, NULL::BIGINT AS parent, false AS noise, '000000000000' AS path)" + "".join(
    f", l{d} AS (SELECT child AS node, {d} AS depth, arg_min(parent, path || '/' || lpad('' || child, 12, '0')) AS parent, child IN (FROM marks) AS noise, min(path || '/' || lpad('' || child, 12, '0')) AS path FROM (SELECT s.parent, child, path FROM steps s JOIN l{d - 1} p ON p.node = s.parent AND NOT noise WHERE s.parent != child) WHERE child NOT IN ({' UNION ALL '.join(f'SELECT node FROM l{i}' for i in range(d))}) GROUP BY child)" for d in range(1, 5)
) + ", crawled AS (" + " UNION ALL ".join(f"SELECT * FROM l{d}" for d in range(5)) + ")"


def crawled(spark, sf):
    k, p = F.col("p_partkey"), table(spark, sf, "part")
    edges = p.filter(k > 0).select(F.floor(k / 4).alias("parent"), k.alias("child")).union(p.filter(k % 3 == 1).select(F.floor(k / 7), k))
    return graph.crawl(edges, [0], p.filter(F.col("p_name").contains("red")).select(k.alias("node")))


@query(f"WITH {_CATEGORIES} SELECT node, depth, parent, noise FROM crawled")
def category_crawl(spark, sf):
    return crawled(spark, sf).select("node", "depth", "parent", "noise")


@query(f"WITH {_CATEGORIES}, members AS (SELECT DISTINCT l_orderkey AS page, l_partkey AS node FROM lineitem) SELECT page, array_to_string(list_sort(list(node)), ',') AS categories FROM members JOIN crawled USING (node) WHERE depth < 4 AND NOT noise GROUP BY 1")
def category_pages(spark, sf):
    members = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("page"), F.col("l_partkey").alias("node"))
    return graph.crawled_pages(crawled(spark, sf), members).withColumn("categories", F.array_join(F.col("categories").cast("array<string>"), ","))


@query("""WITH d AS (SELECT doc_id, lang, source FROM documents WHERE lang IS NOT NULL AND source IS NOT NULL)
SELECT doc_id, 'Lang ' || lang AS target, 2 AS n, true AS in_lead FROM d UNION ALL SELECT doc_id, 'Source ' || source || ' é', 1, false FROM d""")
def wikitext_links(spark, sf):
    d = table(spark, sf, "documents").filter("lang is not null and source is not null")
    markup = F.concat(F.lit("A [[lang_"), "lang", F.lit("#x|y]] {{t [[Z]] {{u}} }}<ref>[[Q]]</ref><!-- [[R]] --> [[File:p]] [[open\n== H ==\n[[ source_"), "source", F.lit(" é ]] [[Lang "), "lang", F.lit("]] {{box}}\n== See also ==\n[[S]]"))
    return mentions.parse_links(d.withColumn("markup", markup), "doc_id", "markup").withColumnRenamed("source", "doc_id")


@query("WITH c AS (SELECT doc_id, text[1:900] AS cut, length(text) AS n, text FROM documents), p AS (SELECT *, length(cut) - length(string_split(cut, '. ')[-1]) AS stop FROM c) SELECT doc_id, CASE WHEN n <= 900 THEN text WHEN stop > 0 THEN cut[1:stop - 2] || '.' ELSE cut END AS summary FROM p")
def cut_summary(spark, sf):
    return table(spark, sf, "documents").select("doc_id", T.cut_sentence(F.col("text")).alias("summary"))


@query("SELECT p_partkey FROM part WHERE contains(lower(p_name), 'red')")
def accent_search(spark, sf):
    return table(spark, sf, "part").filter(T.search(F.col("p_name"), "RÉD")).select("p_partkey")


_NAMES = "n AS (SELECT c_custkey, unnest(['hoaxes in ' || n_name, 'Hoaxes in the ' || lower(c_mktsegment) || ' war', 'denialism in popular ' || n_name, 'films in ' || n_name, 'Propaganda in ' || c_mktsegment || ' ']) AS name FROM customer JOIN nation ON c_nationkey = n_nationkey)"


@query(f"WITH {_NAMES}, x AS (SELECT DISTINCT c_custkey, regexp_extract(name, '(?i)^(?:hoaxes|propaganda|denialism) in (.+)$', 1) AS r FROM n) SELECT c_custkey, string_agg(trim(r), '|' ORDER BY trim(r)) AS regions FROM x WHERE r != '' AND NOT starts_with(lower(r), 'popular') AND NOT contains(lower(r), ' war') GROUP BY 1")
def region_names(spark, sf):
    c = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    names = F.array(F.concat(F.lit("hoaxes in "), "n_name"), F.concat(F.lit("Hoaxes in the "), F.lower("c_mktsegment"), F.lit(" war")), F.concat(F.lit("denialism in popular "), "n_name"), F.concat(F.lit("films in "), "n_name"), F.concat(F.lit("Propaganda in "), "c_mktsegment", F.lit(" ")))
    return c.select("c_custkey", F.array_join(T.regions(names, ["hoaxes", "propaganda", "denialism"], ["popular"], [" war"]), "|").alias("regions"))


@query(f"WITH {D}, items AS (SELECT 'P' || p_partkey AS id, CASE p_partkey % 3 WHEN 0 THEN 'theory' ELSE 'dropped' END AS role FROM part WHERE p_size < 20) SELECT id, role AS kind FROM items WHERE role != 'dropped' UNION ALL SELECT target, coalesce(nullif(CASE WHEN p_size % 2 = 0 THEN '' ELSE lower(p_type) END, ''), 'concept') FROM d JOIN part ON target = 'P' || p_partkey WHERE target NOT IN (SELECT id FROM items) AND (df >= 30 OR p_partkey % 10 = 0)")
def node_emission(spark, sf):
    p = table(spark, sf, "part").withColumn("id", F.concat(F.lit("P"), F.col("p_partkey").cast("string")))
    items = p.filter("p_size < 20").select("id", F.when(F.col("p_partkey") % 3 == 0, "theory").otherwise("dropped").alias("role"))
    df = mentions.document_frequency(base_mentions(spark, sf)).withColumnsRenamed({"target": "id", "df": "n"})
    entities = df.join(p, "id").select("id", F.when(F.col("p_size") % 2 == 0, "").otherwise(F.lower("p_type")).alias("kind"), "n")
    return rules.emitted(items, entities, p.filter("p_partkey % 10 = 0").select("id"), 30)


@query("WITH o AS (SELECT l_orderkey, l_partkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) AS pos FROM lineitem) SELECT l_orderkey, string_agg(coalesce(CASE WHEN l_partkey % 3 > 0 THEN p_name END, '' || l_partkey), '|' ORDER BY pos) AS labels FROM o LEFT JOIN part ON l_partkey = p_partkey GROUP BY 1")
def label_arrays(spark, sf):
    pairs = F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey")))
    orders = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.transform(pairs, lambda x: x["l_partkey"]).alias("ids"))
    labels = table(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.when(F.col("p_partkey") % 3 > 0, F.col("p_name")).otherwise("").alias("label"))
    return rules.with_labels(orders, "l_orderkey", "ids", labels).withColumn("labels", F.array_join("labels", "|"))


@query("SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN p_name WHEN 1 THEN p_name ELSE upper(p_brand[1]) || p_brand[2:] || ' · ' || p_name END AS title FROM part")
def bilingual_title(spark, sf):
    k = F.col("p_partkey") % 3
    local = F.when(k == 0, "").when(k == 1, F.upper("p_name")).otherwise(F.concat(F.lit(" "), F.lower(F.substring("p_brand", 1, 1)), F.col("p_brand").substr(F.lit(2), F.lit(99))))
    return table(spark, sf, "part").select("p_partkey", T.bilingual(local, F.col("p_name")).alias("title"))


@query("SELECT '' || p_partkey AS id, CASE WHEN row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) > 1 THEN '' || p_partkey ELSE replace(p_name, ' ', '-') END AS slug FROM part")
def slug_collisions(spark, sf):
    p = table(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("id"), "p_partkey", F.replace("p_name", F.lit(" "), F.lit("-")).alias("slug"))
    return rules.unique_slugs(p, "p_partkey").drop("p_partkey")


@query("SELECT user_id, arg_max('v' || event_id, event_id) AS value FROM events WHERE event_type != 'error' AND user_id % 5 > 0 GROUP BY 1")
def override_map(spark, sf):
    e = table(spark, sf, "events").groupBy("user_id", "event_type").agg(F.max("event_id").alias("event_id"))
    key = F.when(F.col("event_type") == "error", F.concat(F.lit("_"), F.col("user_id").cast("string"))).otherwise(F.col("user_id").cast("string"))
    value = F.when(F.col("user_id") % 5 == 0, "").otherwise(F.concat(F.lit("v"), F.col("event_id").cast("string")))
    found = rules.overrides(e.select(F.create_map(key, value).alias("m"), "event_id"), "m").withColumn("n", F.substring("value", 2, 20).cast("long"))
    return rules.last_wins(found, "key", ["n"]).select(F.col("key").cast("long").alias("user_id"), "value")


@query("""SELECT 'no title' AS rule, doc_id AS id FROM documents WHERE doc_id % 4 = 1 OR doc_id % 6 = 0 UNION ALL SELECT 'no summary', doc_id FROM documents WHERE NOT (doc_id % 4 = 1 OR doc_id % 6 = 0) AND length(text) = 0 AND doc_id % 2 > 0
UNION ALL SELECT 'too long', doc_id FROM documents WHERE NOT (doc_id % 4 = 1 OR doc_id % 6 = 0) AND length(text) > 700 UNION ALL SELECT 'unknown id', -1 - doc_id FROM documents WHERE doc_id % 50 = 0""")
def translation_check(spark, sf):
    d, k = table(spark, sf, "documents"), F.col("doc_id")
    done = d.filter(k % 4 != 1).select(k.alias("id"), F.when(k % 6 == 0, "").otherwise("t").alias("t"), F.col("text").alias("s")).union(d.filter(k % 50 == 0).select(-1 - k, F.lit("t"), F.lit("s")))
    return rules.translation_violations(d.select(k.alias("id"), (k % 2 == 0).alias("local")), done)


@query("SELECT CASE WHEN doc_id % 4 = 1 THEN 'not reviewed' ELSE 'empty' END AS rule, doc_id AS id FROM documents WHERE doc_id % 4 = 1 OR (doc_id % 6 = 0 AND doc_id % 5 > 0) UNION ALL SELECT 'unknown id', -1 - doc_id FROM documents WHERE doc_id % 50 = 0")
def entity_translation_check(spark, sf):
    d, k = table(spark, sf, "documents"), F.col("doc_id")
    done = d.filter(k % 4 != 1).select(k.alias("id"), F.when(k % 6 == 0, "").otherwise("t").alias("t"), (k % 5 == 0).cast("int").alias("keep")).union(d.filter(k % 50 == 0).select(-1 - k, F.lit("t"), F.lit(0)))
    return rules.entity_translation_violations(d.select(k.alias("id")), done)


@query("SELECT doc_id AS id, CASE WHEN doc_id % 3 = 0 THEN 't' || doc_id ELSE 'l' END AS lt, CASE WHEN doc_id % 5 = 0 THEN 'own' WHEN doc_id % 3 = 0 THEN text ELSE '' END AS summary, (doc_id % 3 = 0 AND doc_id % 5 > 0 AND text != '')::INT AS ltm FROM documents")
def translation_merge(spark, sf):
    d, k = table(spark, sf, "documents"), F.col("doc_id")
    nodes = d.select(k.alias("id"), F.lit("l").alias("lt"), F.when(k % 5 == 0, "own").otherwise("").alias("summary"))
    out = rules.translate(nodes, d.filter(k % 3 == 0).select(k.alias("id"), F.concat(F.lit("t"), k.cast("string")).alias("t"), F.col("text").alias("s")))
    return out.withColumn("ltm", F.coalesce("ltm", F.lit(0)))


@query("SELECT n_name AS name, string_agg(DISTINCT c_mktsegment, ',' ORDER BY c_mktsegment) AS languages, true AS matched FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_nationkey % 4 > 0 GROUP BY 1 UNION ALL SELECT '' || c_nationkey, string_agg(DISTINCT c_mktsegment || ':' || c_name, ',' ORDER BY c_mktsegment || ':' || c_name), false FROM customer WHERE c_nationkey % 4 = 0 GROUP BY 1")
def foreign_titles(spark, sf):
    pages = table(spark, sf, "customer").select(F.col("c_nationkey").alias("id"), F.col("c_mktsegment").alias("lang"), F.col("c_name").alias("title"))
    yes, no = rules.split_matches(pages, table(spark, sf, "nation").filter("n_nationkey % 4 > 0").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name")))
    titles = F.array_join(F.array_sort(F.transform("titles", lambda x: F.concat(x["lang"], F.lit(":"), x["title"]))), ",")
    return yes.select("name", F.array_join("languages", ",").alias("languages"), F.lit(True).alias("matched")).union(no.select(F.col("id").cast("string"), titles, F.lit(False)))


@query("SELECT event_id, CASE WHEN event_id % 3 = 0 THEN '' ELSE 'Q' || json_extract_string(props, '$.k') END AS ids, CASE WHEN event_id % 2 = 0 THEN strftime(ts, '%Y-%m-%d') END AS day FROM events")
def entity_claims(spark, sf):
    e, k = table(spark, sf, "events"), F.get_json_object("props", "$.k")
    snak = lambda value: F.concat(F.lit('{"mainsnak":{"datavalue":{"value":'), value, F.lit("}}}"))
    ids = F.when(F.col("event_id") % 3 == 0, '{"mainsnak":{}}').otherwise(F.concat(snak(F.lit('"text"')), F.lit(","), snak(F.concat(F.lit('{"id":"Q'), k, F.lit('"}')))))
    time = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit(',"P580":['), snak(F.concat(F.lit('{"time":"+'), F.date_format("ts", "yyyy-MM-dd"), F.lit('T00:00:00Z"}'))), F.lit("]"))).otherwise("")
    claims = F.concat(F.lit('{"claims":{"P31":['), ids, F.lit("]"), time, F.lit("}}"))
    return e.select("event_id", F.array_join(T.claim_ids(claims, "P31"), ",").alias("ids"), T.claim_date(claims, "P585", "P580").alias("day"))


@query("SELECT page_id, greatest(0, least(99, coalesce(try_cast(regexp_extract(url, '([0-9]{1,9})[^0-9]*$', 1) AS INT), 0))) AS hints FROM pages")
def bounded_fields(spark, sf):
    return table(spark, sf, "pages").select("page_id", board.bounded_int(F.regexp_extract("url", r"([0-9]{1,9})[^0-9]*$", 1), 0, 99).alias("hints"))


@query("SELECT doc_id, text FROM documents WHERE text IS NOT NULL AND text != '' AND doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)")
def summary_export(spark, sf):
    good = table(spark, sf, "labels").filter("quality = 1").select("doc_id")
    return table(spark, sf, "documents").filter(rules.blank_to_null(F.col("text")).isNotNull()).join(good, "doc_id", "left_semi").select("doc_id", "text")


from quillgraph.plans import build_queries, index_queries  # noqa: E402, F401  add their queries
