"""Registered queries over the indexes: substring search and ranks kept by micro-batches, each next to its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillgraph.operators import substrings
from quillgraph.operators.rounds import new_folder, settle
from quillgraph.plans.registry import _RUNS, query, runs
from quillgraph.sources.tables import table
from quillgraph.streaming.ranks import RankIndex


@query("""WITH words AS (SELECT DISTINCT unnest(regexp_extract_all(text, '[^\\x20\\x09-\\x0D.,]{4,}')) AS needle FROM benchmark)
SELECT needle, count(*) AS n_docs, min(doc_id) AS first_doc FROM words JOIN documents ON contains(strip_accents(lower(text)), strip_accents(lower(needle))) GROUP BY 1""")
def substring_search(spark, sf):
    """Every word of four letters and more of the benchmark, looked up in all documents."""
    words = table(spark, sf, "benchmark").select(F.explode(F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D.,]{4,})"))).alias("needle")).distinct()
    postings, texts = substrings.index(table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text"))
    found = substrings.search(postings, texts, words.select(F.col("needle").alias("key"), "needle"))
    return found.groupBy(F.col("key").alias("needle")).agg(F.count("*").alias("n_docs"), F.min("id").alias("first_doc"))


@query(f"WITH {_RUNS}, best AS (SELECT lvl, nick, max(score) AS score FROM runs GROUP BY 1, 2) SELECT lvl, nick, score, rank() OVER (PARTITION BY lvl ORDER BY score DESC) AS rank FROM best")
def incremental_ranks(spark, sf):
    """Ranks after all runs, which come in batches, one for each year of the orders."""
    year = table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.year("o_orderdate").alias("year"))
    dated = settle(runs(spark, sf).join(year, "id"))
    index = RankIndex(spark, new_folder(spark), "id long, lvl int, nick string, score long, moves long, secs long", compact=4)
    years = [r.year for r in dated.select("year").distinct().orderBy("year").collect()]
    for n, y in enumerate(years):
        index.apply(dated.filter(F.col("year").eqNullSafe(F.lit(y))), n)
    return index.board(len(years))
