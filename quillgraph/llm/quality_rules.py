"""Quality rules whose cutoffs are risk-controlled on labelled holdouts.

Only DataFrame functions are used, and every feature is computed inside its own row: no shuffle of text or words.

Each rule rejects a document whose feature exceeds a cutoff. In each stratum (the `lang` column) the cutoffs of a rule
are tried from lax to strict on the labelled good documents. A cutoff passes if the exact (Clopper-Pearson) upper bound
of its false-rejection rate is at most ALPHA / number of rules, at confidence 1 - DELTA / (strata * rules): Bonferroni
over strata and rules, and fixed-sequence testing over the cutoffs of one rule (testing stops at the first that fails).
With probability 1 - DELTA, no stratum then loses more than ALPHA of its good documents to all rules together. A rule
without a passing cutoff rejects nothing, and so does a stratum with too few labels.

Defined cases: a null or blank text has no words and fails the base rule; a null stratum is a stratum of its own; label
rows with a null or unmatched doc_id, or a null label, are ignored; a document labelled twice counts with each label
row; repeated documents are judged alike; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillgraph.llm.common import materialize

ALPHA, DELTA = 0.05, 0.05
#: Rule: expression over the features, cutoffs from lax to strict.
RULES = {
    "symbols": ("100.0 * n_symbols / greatest(word_chars, 1)", [60.0, 40.0, 30.0, 25.0, 20.0, 15.0, 10.0, 7.0, 5.0, 3.0]),
    "dup_lines": ("100.0 * n_dup_lines / greatest(n_lines, 1)", [90.0, 80.0, 70.0, 60.0, 50.0, 40.0, 30.0, 20.0]),
    "repeats": ("100.0 * n_repeat_words / greatest(n_words, 1)", [45.0, 40.0, 35.0, 30.0, 25.0, 20.0, 15.0, 10.0]),
    "capitals": ("100.0 * n_capitals / greatest(word_chars, 1)", [90.0, 75.0, 60.0, 50.0, 40.0, 30.0, 20.0]),
}
_SPACE = " \t\n\x0b\x0c\r"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _dropped(text: Column, chars: str) -> Column:
    """How many characters of text are among chars."""
    return (F.char_length(text) - F.char_length(F.translate(text, chars, ""))).cast("long")


def features(docs: DataFrame, keep: list[str]) -> DataFrame:
    """keep, and n_words, word_chars, n_symbols, n_capitals, n_lines, n_dup_lines, n_repeat_words (all long)."""
    text = F.coalesce("text", F.lit(""))
    base = docs.select(*keep, text.alias("_t"))
    has_word = lambda line: F.length(F.translate(line, _SPACE, "")) > 0
    split = base.select(
        *keep,
        _dropped(F.col("_t"), "#*$%&|<>").alias("n_symbols"),
        _dropped(F.col("_t"), _UPPER).alias("n_capitals"),
        F.char_length(F.translate("_t", _SPACE, "")).cast("long").alias("word_chars"),
        F.filter(F.split("_t", "\n"), has_word).alias("_lines"),
        F.filter(F.split("_t", "[\\x20\\x09-\\x0D]+"), lambda w: w != "").alias("_w"),
    )
    counted = split.select(
        *keep, "n_symbols", "n_capitals", "word_chars",
        F.size("_w").cast("long").alias("n_words"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.transform("_w", lambda w: F.xxhash64(w)).alias("_h"),
    )
    windows = F.when(
        F.col("n_words") >= 3,
        F.array_sort(F.transform(F.slice("_h", F.lit(1), F.size("_h") - 2), lambda h, i: F.struct(F.xxhash64(h, F.get("_h", i + 1), F.get("_h", i + 2)).alias("h"), i.alias("i")))),
    )
    ordered = counted.withColumn("_s", windows).drop("_h")
    twice = F.filter("_s", lambda x, j: (F.get("_s", j + 1)["h"] == x["h"]) | (F.when(j > 0, F.get("_s", F.greatest(j - 1, F.lit(0)))["h"]) == x["h"]))
    covered = F.size(F.array_distinct(F.flatten(F.transform(twice, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))))
    return ordered.withColumn("n_repeat_words", F.coalesce(F.when(F.col("_s").isNotNull(), covered), F.lit(0)).cast("long")).drop("_s")


def base_failed() -> Column:
    """Fewer than 50 words, or over half of them in repeated three-word windows."""
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def binomial_cdf(k: Column, n: Column, p: float) -> Column:
    """P(at most k of n) with success rate p, summed from k downwards in logarithms' scale: exact to rounding.

    The k + 1 terms are accumulated as a running log-sum-exp, so large n neither underflow nor overflow.
    """
    import math

    odds = math.log(p) - math.log1p(-p)
    first = F.struct((n * F.lit(math.log1p(-p))).alias("term"), (n * F.lit(math.log1p(-p))).alias("total"))

    def step(acc: Column, i: Column) -> Column:
        term = acc["term"] + F.log((n - i + 1) / i) + F.lit(odds)
        high = F.greatest(acc["total"], term)
        return F.struct(term.alias("term"), (high + F.log(F.exp(acc["total"] - high) + F.exp(term - high))).alias("total"))

    upto = F.when(k >= 1, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<long>"))
    return F.exp(F.aggregate(upto, first, step, lambda acc: acc["total"]))


def select_cutoffs(labelled: DataFrame, stratum: str, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """(stratum, rule, cutoff): the strictest cutoff that passes; no row where none does.

    labelled: the stratum and the features of labelled good documents. Its rows are reduced to one count for each
    stratum, rule and cutoff by a partial aggregation before anything is shuffled.
    """
    grid = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(i).alias("step"), F.lit(c).alias("cutoff"), (F.expr(e) > c).alias("rejected")) for r, (e, cuts) in RULES.items() for i, c in enumerate(cuts)])
    counts = labelled.filter(~base_failed()).select(F.col(stratum).alias("stratum"), F.explode(grid).alias("g")).groupBy("stratum", "g.rule", "g.step", "g.cutoff").agg(F.count("*").alias("n"), F.sum(F.col("g.rejected").cast("long")).alias("k"))
    strata = counts.agg(F.count_distinct(F.coalesce("stratum", F.lit("\x00")))).scalar()
    risk = alpha / len(RULES)
    # a count beyond n * risk never passes, so its tail isn't summed
    passed = F.when(F.col("k") > F.col("n") * risk, False).otherwise(binomial_cdf(F.least("k", F.ceil(F.col("n") * risk)), F.col("n"), risk) <= F.lit(delta / len(RULES)) / strata)
    order = Window.partitionBy("stratum", "rule").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    return counts.withColumn("passed", passed).withColumn("all", F.min("passed").over(order)).filter("all").groupBy("stratum", "rule").agg(F.min("cutoff").alias("cutoff"))


def apply_rules(docs: DataFrame, labels: DataFrame, stratum: str = "lang", alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """doc_id, the stratum, the features, base_failed, failed_rules (array) and kept, a row for each row of docs."""
    table = materialize(features(docs, ["doc_id", stratum]), "features")
    good = labels.filter("quality = 1").select("doc_id")
    cutoffs = select_cutoffs(table.join(good, "doc_id"), stratum, alpha, delta)
    # at most one row for each stratum
    chosen = cutoffs.groupBy("stratum").agg(*[F.max(F.when(F.col("rule") == r, F.col("cutoff"))).alias(f"_{r}") for r in RULES])
    joined = table.join(chosen, table[stratum].eqNullSafe(chosen["stratum"]), "left").drop("stratum")
    failed = F.array_compact(F.array(*[F.when(F.expr(e) > F.col(f"_{r}"), F.lit(r)) for r, (e, _) in RULES.items()]))
    judged = joined.withColumns({"base_failed": base_failed(), "failed_rules": failed}).drop(*[f"_{r}" for r in RULES])
    return judged.withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))
