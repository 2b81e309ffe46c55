"""The trie, the forest and the vector codes, each against a brute-force version, on awkward rows too."""

import hashlib
import math
import os
import re
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from test_operators import AWKWARD, BASE, SCHEMA

from quillgraph.llm import common, lsh_forest, prefix_trie, simhash, token_counts, vector_codes
from quillgraph.llm.registry import QUERIES, SQL, WORD_BPE

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", ["op11_prefix_trie", "op13_vector_codes"])
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("conversations", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = QUERIES[name](spark, SF)
    want = con.execute(SQL[name])
    at = [d[0] for d in want.description]
    assert sorted(df.columns) == sorted(at)
    assert sorted(map(repr, (tuple(r[c] for c in at) for r in df.collect()))) == sorted(map(repr, want.fetchall()))


def trie_by_definition(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    paths = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        paths[c] = (*own.get(c - int(math.fmod(c, 5)), [])[:h], *ts[h:])
    members = defaultdict(list)
    for c, p in paths.items():
        for d in range(len(p) + 1):
            members[p[:d]].append(c)
    children = defaultdict(int)
    leaves, saved = defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node in members:
        own_saved = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in children
            saved[node[:d]] += own_saved
    ends = {n: hashlib.sha256(",".join(map(str, sorted(c for c in m if paths[c] == n))).encode()).hexdigest() for n, m in members.items()}
    return sorted((min(m), len(n), min(members[n[:-1]]) if n else -(1 << 62), len(m), children.get(n, 0), leaves[n], saved[n], ends[n]) for n, m in members.items())


def test_trie(spark, monkeypatch):
    rng = np.random.default_rng(3)
    say = lambda k: ["Hi", "", None, "hellö", "Hi there"][k % 5]
    rows = [(int(c), None if rng.random() < 0.1 else int(rng.integers(0, 6)), ["user", None, "assistant"][int(rng.integers(0, 3))], say(int(rng.integers(0, 9)))) for c in rng.integers(-12, 60, 500)]
    rows += rows[:40] + [(None, 1, "user", "nobody")]
    # long conversations that share all of their path, and one that leaves it on the way
    rows += [(c, t, "user", f"turn {t}" if (c, t) != (102, 70) else "another way") for c in (100, 101, 102) for t in range(120)]
    rows += [(200 + c, 0, "user", "first") for c in range(50)]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, n string, s0 int")
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    for parts in (1, 6):
        if parts == 6:  # few turns to a slice, few ids to a string, heavy keys answered by broadcast
            monkeypatch.setattr(prefix_trie, "SLICE", 7)
            monkeypatch.setattr(prefix_trie, "IDS", 3)
            monkeypatch.setattr(common, "LEAST_HEAVY", 5)
            monkeypatch.setattr(common, "HEAVY_KEYS", 1 << 40)
        got = prefix_trie.report(frame.repartition(parts)).select(columns).collect()
        assert sorted((r[0], r[1], -(1 << 62) if r[2] is None else r[2], *r[3:]) for r in got) == trie_by_definition(rows)
    assert prefix_trie.report(frame.limit(0)).count() == 0
    assert [tuple(r) for r in prefix_trie.report(frame.limit(0).union(spark.createDataFrame([(7, None, None, None, None, None)], frame.schema))).select(columns[:-1]).collect()][0][:2] == (7, 0)


def sets_by_definition(rows):
    out = []
    for text in rows:
        words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
        out.append(frozenset(zip(words, words[1:], strict=False)) if len(words) > 1 else frozenset(map(tuple, [words] if words else [])))
    return out


def components_by_definition(rows):
    sets = sets_by_definition([t for _, t in rows])
    label = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and 100 * both >= 80 * (len(a) + len(sets[j]) - both) and label[i] != label[j]:
                label = [label[j] if x == label[i] else x for x in label]
    least = defaultdict(lambda: None)
    for x, (d, _) in zip(label, rows, strict=True):
        if d is not None:
            least[x] = d if least[x] is None else min(least[x], d)
    return [(d, len(s), least[x] if s else d) for (d, _), s, x in zip(rows, sets, label, strict=True)]


def drifting(n, words, every):
    """Texts that each differ from the last in some words, so that far ones have little in common."""
    out, text = [], [f"w{i}" for i in range(words)]
    for i in range(n):
        out.append(" ".join(text))
        text[(i * every) % words] = f"n{i}"
    return out


@pytest.mark.parametrize("small", [False, True])
def test_forest(spark, monkeypatch, small):
    if small:
        for module, name, value in ((lsh_forest, "REGION", 2), (lsh_forest, "PORTION", 20), (simhash, "GROUP_PORTION", 12), (simhash, "DIRECT", 6)):
            monkeypatch.setattr(module, name, value)
    texts = [(a[0], a[1]) for a in AWKWARD]
    texts += [(1000 + i, t) for i, t in enumerate(drifting(60, 60, 7))]
    texts += [(2000 + i, BASE + f" number {i}") for i in range(50)] + [(3000 + i, "UPPER lower Case" if i % 2 else "upper LOWER case") for i in range(30)]
    # 8 of 10 shingles in common is a link, 7 of 9 is none
    texts += [(4000, "a b c d e f g h i j"), (4001, "a b c d e f g h i x"), (4002, "p q r s t u v w x"), (4003, "p q r s t u v w y z")]
    frame = spark.createDataFrame([(d, t, "x", d) for d, t in texts], "doc_id long, text string, digest string, label long").repartition(5)
    got = lsh_forest.report(frame)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    rows = got.collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2] is None, r[2] or 0)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in rows), key=key) == sorted(components_by_definition(texts), key=key)
    assert all(r.kept == (r.doc_id is not None and r.doc_id == r.component_id) for r in rows)
    assert lsh_forest.report(spark.createDataFrame([], SCHEMA)).count() == 0
    assert lsh_forest.report(frame.filter("text is null or trim(text) = ''")).filter("not kept or n_shingles > 0").count() == 0


def test_exact_links_of_large_groups():
    rng = np.random.default_rng(8)
    sets, base = [], rng.integers(0, 1 << 63, 400, dtype=np.uint64)
    for _ in range(300):
        base = base.copy()
        places = rng.integers(0, len(base), rng.integers(5, 60))
        base[places] = rng.integers(0, 1 << 63, len(places), dtype=np.uint64)
        sets.append(np.unique(base))
    a, b = simhash.exact_links(sets, 0.8)
    found, want = np.arange(len(sets)), np.arange(len(sets))
    for x, y in zip(a, b, strict=True):
        found[found == found[x]] = found[y]
    for i in range(len(sets)):
        for j in range(i):
            both = len(np.intersect1d(sets[i], sets[j]))
            if 10 * both >= 8 * (len(sets[i]) + len(sets[j]) - both):
                want[want == want[i]] = want[j]
    same = lambda x: x[:, None] == x[None]
    assert (same(found) == same(want)).all() and 3 < len(set(want.tolist())) < 300


def codes_by_definition(vectors, parts, entries, rounds, scale):
    rows = [(i, [min(max(math.floor(x * scale), -(1 << 62)), 1 << 62) for x in v], lab) for i, v, lab in vectors if v and all(x is not None and math.isfinite(x) for x in v)]
    lengths = defaultdict(int)
    for _, v, _ in rows:
        lengths[len(v)] += len(v) % parts == 0
    n = max(lengths, key=lambda k: (lengths[k], k))
    rows = sorted((r for r in rows if len(r[1]) == n), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    w = n // parts
    cut = [[v[p * w : (p + 1) * w] for p in range(parts)] for _, v, _ in rows]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]
    distance = lambda x, y: sum((a - b) ** 2 for a, b in zip(x, y, strict=True))
    for r in range(rounds + 1):
        codes = [[min(range(len(books[p])), key=lambda e: (distance(c[p], books[p][e]), e)) for p in range(parts)] for c in cut]
        if r < rounds:
            books = [[[sum(xs) // len(xs) for xs in zip(*own, strict=True)] if (own := [c[p] for c, k in zip(cut, codes, strict=True) if k[p] == e]) else old for e, old in enumerate(books[p])] for p in range(parts)]
    errors = [sum(distance(c[p], books[p][k[p]]) for p in range(parts)) for c, k in zip(cut, codes, strict=True)]
    total = defaultdict(int)
    for (_, _, lab), e in zip(rows, errors, strict=True):
        total[lab] += e
    held = lambda x: x if x < 1 << 63 else None
    every = [held(e) for e in errors]
    sums = {lab: sum(e for e, (_, _, own) in zip(every, rows, strict=True) if own == lab and e is not None) for lab in total}
    text = ",".join(str(x) for p in books for e in p for x in e)
    return sorted(map(repr, ((r[0], "".join(f"{x:02x}" for x in k), e, sums[r[2]], hashlib.sha256(text.encode()).hexdigest()) for r, k, e in zip(rows, codes, every, strict=True))))


def test_vector_codes(spark):
    rng = np.random.default_rng(5)
    vectors = [(int(i), [float(x) for x in rng.integers(-6, 6, 16) / 8], int(rng.integers(0, 3)) if i % 4 else None) for i in rng.permutation(120)]
    vectors += vectors[:20] + [(i, vectors[0][1], 1) for i in range(200, 260)]
    vectors += [(300, None, 1), (301, [], 1), (302, [0.5] * 15 + [None], 1), (303, [float("nan")] * 16, 1), (304, [float("inf")] * 16, 2), (305, [1.0] * 8, 1), (306, [1.0] * 17, 1), (None, [0.25] * 16, None), (None, [0.25] * 16, 7)]
    schema = "vec_id long, embedding array<double>, label int, codes string, v int"
    frame = lambda rows: spark.createDataFrame([(*r, "x", 1) for r in rows], schema)
    got = lambda rows: sorted(repr((r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256)) for r in vector_codes.report(frame(rows).repartition(3)).collect())
    want = lambda rows: codes_by_definition(rows, 8, 16, 6, 4096)
    assert got(vectors) == want(vectors)
    few = vectors[:5]
    assert got(few) == want(few)
    wide = [(i, [float(x) for x in rng.normal(size=16) * 10.0 ** rng.integers(0, 6)], 1) for i in range(60)]
    assert got(wide) == want(wide)
    huge = [(i, [1e300 * (-1) ** i] + [0.5 * i] * 15, 1) for i in range(20)]
    assert [r.split(", ")[:2] for r in got(huge)] == [r.split(", ")[:2] for r in want(huge)]
    assert vector_codes.report(frame([])).count() == 0 == vector_codes.report(frame(vectors[180:].copy()[:0] + [(1, None, 1)])).count()
    packed = vector_codes.compress(frame(vectors))
    assert all(abs(x - y) <= 0.9 for r in vector_codes.decode(packed.rows, packed.codebooks).join(frame(vectors[:100]).select("vec_id", "embedding").distinct(), "vec_id").collect() for x, y in zip(r.decoded, r.embedding, strict=True))


def test_bounds_prune_and_hold():
    rng = np.random.default_rng(6)
    x = (rng.normal(size=(4000, 8)) * 300 + rng.integers(0, 12, (4000, 1)) * 900).astype(np.int64)
    entries = x[:16].copy()
    code, upper, lower = np.zeros(len(x), np.int64), np.full(len(x), np.inf, np.float32), np.zeros((len(x), 16), np.float32)
    taken = []
    for _ in range(6):
        taken.append(vector_codes.nearest(x, entries, code, upper, lower))
        exact = ((x[:, None] - entries[None]) ** 2).sum(-1)
        assert (code == exact.argmin(axis=1)).all()
        assert (upper.astype(float) ** 2 >= exact[np.arange(len(x)), code]).all() and (lower.astype(float) ** 2 <= exact).all()
        after = np.array([x[code == e].sum(axis=0) // max(1, (code == e).sum()) if (code == e).any() else entries[e] for e in range(16)])
        shift = np.array(vector_codes.moved([entries.tolist()], [after.tolist()])[0])
        upper[:], lower[:], entries = vector_codes.above(upper + shift[code]), vector_codes.below(lower - shift), after
    assert taken[0] < 16 * len(x) and taken[-1] < 0.3 * 16 * len(x)


def test_prefix_tables_end_with_the_count_of_the_raw_text(spark):
    from tokenizers import Tokenizer

    t, own, rng = Tokenizer.from_file(WORD_BPE), token_counts.PrefixCounter(WORD_BPE), np.random.default_rng(9)
    parts = ["a", "Don't", " ", "<|ENDOFTEXT|>", "<|endoftext|>", "<|EndOf", "<|endof", "text|>", "TEXT|>", "<|startoftext|>", "<|", "|>", "é", "E\u0301", "İ", "1234", "\n", "\t", "日本", "'LL", "\u0301"]
    texts = ["<|ENDOFTEXT|>", "x<|ENDOFTEXT|><|endoftext|>y", *("".join(rng.choice(parts, rng.integers(0, 10))) for _ in range(3000))]
    want = [len(t.encode(x, add_special_tokens=False).ids) for x in texts]
    assert [int(own.table(x)[-1]) for x in texts] == want
    frame = spark.createDataFrame([(i, x) for i, x in enumerate(texts[:60])], "doc_id long, text string")
    assert all(r.prefix_tokens[-1] == r.n_tokens == want[r.doc_id] for r in token_counts.count_tokens(frame, WORD_BPE, 3, store=True).collect())
