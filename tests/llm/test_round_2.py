"""Awkward rows, sizes and sources of the training-data operators, each against a plain version."""

import math
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from test_advice_r01 import components_of, held_by, shingle_set
from test_operators import AWKWARD, BASE, SCHEMA, expected_tokens

import corpus_pipeline
from quillgraph.llm import bloom, common, packing, quality_classifier, quality_rules, suffix_dedup, url_filter
from quillgraph.llm.registry import BYTE_BPE, SQL


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(AWKWARD, SCHEMA).repartition(3)


def test_rules_and_urls_of_any_length(spark):
    long = "example.org/" + "a" * 2500
    rules = spark.createDataFrame([(long, "block"), ("org/", "allow"), ("example.org/b", "block"), ("example.org/b", "allow")], "key string, verdict string")
    urls = [f"http://{long}bc", f"http://x.{long}", "http://example.org/" + "a" * 2499, "http://example.org/bx", "http://y.example.org/b" + "z" * 100_000]
    pages = spark.createDataFrame([(i, u, "u", "r", 1) for i, u in enumerate([*urls, urls[0]])], "page_id long, url string, _url string, rule_ string, block int")
    got = url_filter.filter_urls(pages, rules, rules.limit(0))
    assert got.columns == ["page_id", "url", "_url", "rule_", "block", "host", "path", "rule", "verdict"]
    rows = {r.page_id: (r.rule, r.verdict, r._url, r.rule_, r.block) for r in got.collect()}
    want = [(long, "block"), (long, "block"), ("org/", "allow"), ("example.org/b", "block"), ("example.org/b", "block"), (long, "block")]
    assert rows == {i: (*w, "u", "r", 1) for i, w in enumerate(want)}


def test_bloom_filter_has_no_false_negatives(spark):
    keys = spark.range(5000).select(keys_of("id"))
    n = bloom.size_for(5000)
    filled = bloom.build(keys, n)
    rows = spark.range(20_000).select("id", keys_of("id"), keys_of("id").alias("block"))
    admitted, others = (bloom.asked(rows, filled, n, admitted=flag) for flag in (True, False))
    found = {r.id for r in admitted.collect()}
    assert set(range(5000)) <= found and len(found) < 5300 and {r.id for r in others.collect()} == set(range(20_000)) - found
    assert admitted.columns == rows.columns


def keys_of(c):
    from pyspark.sql import functions as F

    return F.concat(F.lit("k"), F.col(c).cast("string")).alias("key")


def test_rows_without_doc_id_are_told_apart(spark):
    common_part = " ".join(f"shared{i}" for i in range(20))
    texts = [(None, common_part + f" only {i} " * 12) for i in range(40)] + [(5, common_part), (9, common_part + " tail")]
    table = spark.createDataFrame(texts, "doc_id long, text string")
    for hot in (20_000, 1):
        rows = sorted((r.doc_id is None, r.n_bytes, r.n_removed, r.n_spans) for r in suffix_dedup.report(table, hot).collect())
        n = len(common_part)
        assert rows[0] == (False, n, 0, 0) and rows[1] == (False, n + 5, n, 1)
        # they lose what 5 and 9 have, a space more than 5 alone, and nothing for one another
        assert all(r[2] == n + 1 for r in rows[2:]) and len(rows) == 42


def test_many_small_sources_keep_their_proportions(spark):
    ids = expected_tokens()
    rng = np.random.default_rng(3)
    rows = [(i, " ".join(rng.choice(["tree", "stone", "river", "light"], 60)), None if i % 1500 == 0 else f"s{i % 1500}", "x", 1) for i in range(6000)]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string, chunk string, position int").repartition(8)
    pieces = packing.pack(table, BYTE_BPE, with_ids=True).collect()
    by_doc = defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
    for i in range(0, 6000, 371):
        assert b"".join(bytes(p.ids) for p in sorted(by_doc[i], key=lambda p: p.start)) == ids(rows[i][1]).tobytes()
    total = sum(p.length for p in pieces)
    ends = Counter()
    for p in pieces:
        ends[p.sequence_id] += p.length
    assert [n for s, n in sorted(ends.items()) if n != 1024] == [1 << b for b in reversed(range(10)) if total % 1024 >> b & 1]
    # each source has four documents, dealt over the whole: a quarter of all sequences holds about a quarter of each
    last, first = max(ends), Counter()
    for p in pieces:
        if p.sequence_id < last // 2:
            first[rows[p.doc_id][2]] += p.length
    shares = np.array([first[s] for s in {r[2] for r in rows}]) / (total / 1500)
    assert 0.42 < shares.mean() < 0.58 and (shares > 0.1).mean() > 0.9


def test_a_source_of_a_few_tokens(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP", 4096)
    ids = expected_tokens()
    for n in (0, 1, 4):
        rows = [(i, "some words of the large source " * 6, "large") for i in range(900)] + [(1000 + i, "a b", f"tiny{i}") for i in range(n)]
        pieces = packing.pack(spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5), BYTE_BPE, with_ids=True).collect()
        own = defaultdict(list)
        for p in pieces:
            own[p.doc_id].append(p)
        assert all(b"".join(bytes(p.ids) for p in sorted(own[i], key=lambda p: p.start)) == ids(t).tobytes() for i, t, _ in rows[::89] + rows[900:])
        filled = defaultdict(list)
        for p in pieces:
            filled[p.sequence_id].append((p.offset, p.length))
        total = sum(p.length for p in pieces)
        assert all(at == end for w in filled.values() for at, end in zip([a for a, _ in sorted(w)], np.cumsum([0, *(k for _, k in sorted(w))])[:-1], strict=True))
        assert sorted(sum(k for _, k in w) for w in filled.values() if sum(k for _, k in w) < 1024) == [1 << b for b in range(10) if total % 1024 >> b & 1]


def test_sources_of_one_row_each(spark, docs):
    from pyspark.sql import functions as F

    own = docs.withColumn("source", F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("n")), F.md5(F.coalesce("text", F.lit(""))), F.col("n_chars").cast("string")))
    rows = packing.pack(own, BYTE_BPE).collect()
    ids = expected_tokens()
    assert sum(r.length for r in rows) == sum(len(ids(a[1])) for a in AWKWARD)


def test_training_texts_are_bounded_before_they_leave(spark, monkeypatch):
    monkeypatch.setattr(quality_classifier, "TRAIN_BYTES", 3000)
    seen = []
    monkeypatch.setattr(quality_classifier, "fit", lambda texts, labels: seen.append((texts, labels)) or quality_classifier.Model(constant=0.5))
    rows = [(i, "word " * (100 if i else 50_000)) for i in range(12)] + [(3, "again"), (3, "again"), (None, "x")]
    labels = [(i, i % 2) for i in range(12)] + [(3, 0), (None, 1), (77, 1), (4, None)]
    table, lab = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int")
    from pyspark.sql import functions as F

    quality_classifier.train(table, lab, F.lit(True))
    texts, ys = seen[0]
    # the long text never fits; of the repeated doc_id the smallest text is learnt, once with each label
    once = [t for n, t in enumerate(texts) if t not in ("again",) or n == texts.index("again")]
    assert sum(map(len, once)) <= 3000 and len(texts) == len(ys) >= 6 and texts.count("again") in (0, 2) and all(len(t) <= 500 for t in texts)


def test_classifier_on_clashing_columns_and_repeated_rows(spark):
    table = spark.createDataFrame([(1, "a b", 0.1, 7, "o"), (1, "a b", 0.1, 7, "o"), (None, None, 0.2, 8, "p")], "doc_id long, text string, score double, predicted int, y string")
    out = quality_classifier.classify(table, quality_classifier.Model(constant=0.75))
    assert out.columns == ["doc_id", "text", "y", "score", "predicted"] and [(r.score, r.predicted) for r in out.collect()] == [(0.75, 1)] * 3
    flags = table.select(quality_classifier.held_out().alias("h")).collect()
    assert [r.h for r in flags] == [zlib.crc32(b"1") % 3 == 1] * 2 + [False]


def cutoffs_by_definition(rows, alpha, delta):
    """rows of (stratum, features dict) of good documents -> {(stratum, rule): cutoff}."""
    strata, out = {s for s, _ in rows}, {}
    risk, confidence = alpha / len(quality_rules.RULES), delta / len(quality_rules.RULES) / max(1, len(strata))
    for s in strata:
        own = [f for t, f in rows if t == s]
        for rule, (_, cuts) in quality_rules.RULES.items():
            for cutoff in cuts:
                k, n = sum(f[rule] > cutoff for f in own), len(own)
                ways = lambda i, n=n: math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1)
                if sum(math.exp(ways(i) + i * math.log(risk) + (n - i) * math.log1p(-risk)) for i in range(k + 1)) > confidence:
                    break
                out[s, rule] = cutoff
    return out


def test_cutoffs_and_kept(spark):
    rng = np.random.default_rng(9)
    rows = []
    for i in range(2600):
        words = [f"{rng.choice(['tree', 'Stone', 'RIVER', 'light'])}{rng.integers(400)}" for _ in range(70)]
        for _ in range(rng.integers(0, 5) if i % 50 else 60):
            words[rng.integers(70)] += "###" if i % 3 else "$"
        rows.append((i, " ".join(words) + "\nsame line\nsame line" * int(rng.integers(0, 2)), [None, "en", "fr"][0 if i % 40 == 0 else 1 + (i % 7 == 0)], "e", "e"))
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, kept string, rule string")
    labels = [(i, int(i % 9 > 0)) for i in range(2600)] + [(3, 1), (None, 1), (4, None)]
    got = quality_rules.apply_rules(table, spark.createDataFrame(labels, "doc_id long, quality int"), alpha=0.2).collect()
    known = {}
    for i, text, lang, *_ in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", text)
        n = Counter(zip(w, w[1:], w[2:], strict=False))
        repeats = len({j for a in range(len(w) - 2) if n[tuple(w[a : a + 3])] > 1 for j in (a, a + 1, a + 2)})
        lines = [x for x in text.split("\n") if x.strip()]
        chars = sum(map(len, w))
        symbols = sum(c in "#*$%&|<>" for c in text)
        values = {"symbols": 100 * symbols / chars, "dup_lines": 100 * (len(lines) - len(set(lines))) / len(lines), "repeats": 100 * repeats / len(w), "capitals": 100 * sum(c.isascii() and c.isupper() for c in text) / chars}
        known[i] = (lang, symbols, len(w) < 50 or 100 * repeats > 50 * len(w), values)
    good = [(known[i][0], known[i][3]) for i, q in labels if q == 1 and i is not None and not known[i][2]]
    cutoffs = cutoffs_by_definition(good, 0.2, quality_rules.DELTA)
    assert len(cutoffs) > 5
    for r in got:
        lang, symbols, failed, values = known[r.doc_id]
        assert (r.n_symbols, r.base_failed) == (symbols, failed)
        assert set(r.failed_rules) == {rule for rule, v in values.items() if v > cutoffs.get((lang, rule), math.inf)}
        assert r.kept == (not failed and not r.failed_rules)
    assert 0 < sum(not r.kept for r in got) < len(got)


@pytest.mark.parametrize("name", sorted(SQL))
def test_queries_match_their_sql(spark, name):
    from quillgraph.llm.registry import QUERIES

    sf, con = "/root/testdata/sf0.001", duckdb.connect()
    for t in ("documents", "pages", "labels", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    df, cursor = QUERIES[name](spark, sf), con.execute(SQL[name])
    names = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(names)
    assert sorted(repr([r[c] for c in names]) for r in df.collect()) == sorted(repr(list(r)) for r in cursor.fetchall())


def test_pipeline_stages_on_awkward_rows(spark, tmp_path):
    """Each stage but the last against a plain version, on null, empty, repeated and clashing rows and on none."""
    sf = str(tmp_path)
    item = " ".join(f"bench{i * i % 541}" for i in range(40))
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    spark.createDataFrame([(4, 1, 0), (None, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    near = BASE.split() * 4
    rows = [*AWKWARD, (60, " ".join(near), "en", "a", 1, "x"), (61, " ".join([*near[:-1], "end."]), "en", "a", 1, "x"), (62, "before " + item + " after", "en", "a", 1, "x")]
    schema = SCHEMA.replace("n_tokens string", "_own string")
    docs = spark.createDataFrame(rows, schema).repartition(3)
    stages = dict(corpus_pipeline.STAGES)
    none = docs.limit(0)
    for name, stage in list(stages.items())[:-1]:
        assert stage(spark, none, sf).count() == 0, name
        assert stage(spark, docs, sf).dtypes == docs.dtypes, name
    assert stages["packing"](spark, none, sf).count() == 0
    # one training label only: the share of label 1
    assert stages["quality classifier"](spark, docs, sf).count() == len(rows)

    kept = sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in stages["SimHash near-dedup"](spark, docs, sf).collect())
    words = [((a[1] or "").translate({i: i + 32 for i in range(65, 91)})).split() for a in rows]
    sets = [shingle_set(" ".join(w)) if w else None for w in words]
    alike = lambda i, j: (rows[i][1] or "") == (rows[j][1] or "") or sets[i] and sets[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])
    group = components_of(len(rows), alike)
    first = {}
    for i, a in enumerate(rows):
        key = (a[0] is None, a[0] or 0)
        if group[i] not in first or key < first[group[i]][0]:
            first[group[i]] = (key, a[1] or "")
    assert [k[:2] for k in kept] == sorted(k for k, _ in first.values())

    clean = Counter((r.doc_id, r.text) for r in stages["benchmark decontamination"](spark, docs, sf).collect())
    assert clean == Counter((a[0], a[1]) for a in rows if not held_by(item, a[1]))
    cut = {(r.doc_id, r.text) for r in stages["suffix-array dedup"](spark, docs, sf).collect()}
    assert (4, BASE) in cut and (5, "") in cut and (None, "") in cut and (0, None) in cut


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    monkeypatch.setattr(spark.sparkContext, "master", "spark://somewhere:7077")
    if spark.conf.get("spark.checkpoint.dir", None) is None:
        with pytest.raises(RuntimeError):
            common.shared_dir(spark)
