"""Each training-data operator against a brute-force version and on awkward rows."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer

from quillgraph.llm import class_lm, components, decontaminate, packing, quality_classifier, quality_rules, simhash, suffix_dedup, token_counts, token_files, token_ids, url_filter
from quillgraph.llm.registry import BYTE_BPE, LISTED_URLS, URL_RULES, WORD_BPE
from quillgraph.llm.token_ids import ByteBpe

LONG = " ".join(f"w{i * i % 977}x" for i in range(30_000))
BASE = "The quick brown fox jumps over the lazy dog while seven wizards quietly brew potions near the old stone bridge every single night."
TEXTS = [None, "", "   ", "a", BASE, BASE, BASE + " And then some more words follow here.", "Ünïcödé straße 日本語 it's 1999!", "<|endoftext|> and <|startoftext|>", "x" * 5000, "\n\n".join(["same line here"] * 30), LONG, LONG[:90_000] + " tail", "Wow   double\tspace \n end "]
AWKWARD = [(i, t, "en" if i % 2 else None, "hot" if i % 3 else None, len(t or ""), "extra") for i, t in enumerate(TEXTS)] + [(4, BASE, "en", "hot", len(BASE), "again"), (None, BASE, "en", "hot", 1, "x"), (None, "no id", None, None, 5, None)]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_tokens string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(AWKWARD, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def expected_tokens():
    t = Tokenizer.from_file(BYTE_BPE)
    return lambda text: np.array([*t.encode(text or "", add_special_tokens=False).ids, 0], "<u4")


def test_url_filter(spark):
    urls = [None, "", "no scheme", "HTTP://WWW.Example.NET/en/1?x", "http://a.b.net", "http://net/", "http://evilnet/x", "https://q.example.com/de/x#y", "http://x.org/fr/", "http://spam-farm.example.org/a", "http://x.org:80/fr/", "a://b://c.net/"]
    pages = spark.createDataFrame([(i, u, "r", 1) for i, u in enumerate([*urls, urls[3]])], "page_id long, url string, rule string, path int")
    rules, listed = (spark.createDataFrame(x, "key string, verdict string") for x in (URL_RULES, [(u, "block") for u in LISTED_URLS]))

    def brute(u):
        m = re.search("://([^/?#]*)([^?#]*)", u or "")
        h, p = (m[1].lower(), m[2]) if m else ("", "")
        fits = lambda k: (h == k[: k.index("/")] or h.endswith("." + k[: k.index("/")])) and p.startswith(k[k.index("/") :])
        best = max((r for r in URL_RULES if fits(r[0])), key=lambda r: len(r[0]), default=(None, None))
        return h, p, best[0], best[1] or ("block" if any(map(fits, LISTED_URLS)) else "allow")

    for salted in (False, True):
        if salted:
            url_filter.BROADCAST_ROWS = 0
        got = url_filter.filter_urls(pages, rules, listed)
        assert got.count() == 13
        for r in got.collect():
            assert (r.host, r.path, r.rule, r.verdict) == brute(r.url)
    url_filter.BROADCAST_ROWS = 200_000
    assert {r.verdict for r in url_filter.filter_urls(pages, rules.limit(0), listed.limit(0)).collect()} == {"allow"}
    assert url_filter.filter_urls(pages.limit(0), rules, listed).count() == 0


def test_token_counts(spark, docs, none):
    t = Tokenizer.from_file(WORD_BPE)
    rows = token_counts.count_tokens(docs, WORD_BPE, 20).collect()
    assert len(rows) == len(AWKWARD)
    text_of = defaultdict(set)
    for a in AWKWARD:
        text_of[a[0]].add(a[1] or "")
    for r in rows:
        assert (r.n_bytes, r.n_tokens) in {(len(x.encode()), len(t.encode(x, add_special_tokens=False).ids)) for x in text_of[r.doc_id]}
        assert r.over_limit == (r.n_tokens > 20)
    counter = token_counts.PrefixCounter(WORD_BPE)
    rng = np.random.default_rng(4)
    parts = ["a", "don't", "I'll", " ", "  ", "\n", "\t", "\x85", "日本語", "é", "e\u0301", "1234", "!?", "<|endoftext|>", "<|endof", "text|>", "<|startoftext|>", "x" * 40, "'s", "'re", "ﬁ", "\u200b", "🙂", "İ", "ß", "ΑΣ", "...", "--", "'", "''", "\u0301", "´"]
    mixed = ["".join(rng.choice(parts, rng.integers(0, 9))) for _ in range(400)]
    for x, own in zip(mixed, counter.steps(mixed), strict=True):
        assert own[-1] == len(t.encode(x, add_special_tokens=False).ids)
    for x in [*TEXTS[:9], TEXTS[-1], "they're I'd we'll don't", *mixed]:
        n = counter.normalize((x or "")[:200])
        table = counter.table((x or "")[:200])
        assert [len(t.encode(n[:i], add_special_tokens=False).ids) for i in range(len(n) + 1)] == table.tolist()
        cut = token_counts.longest_prefix(table, 3)
        assert token_counts.tokens_at(table, cut) <= 3
    stored = token_counts.count_tokens(docs.filter("doc_id = 4"), WORD_BPE, 20, store=True).first()
    assert stored.prefix_tokens[-1] == stored.n_tokens
    words = token_counts.count_tokens(docs.filter("doc_id = 4"), WORD_BPE, 10).first()
    assert words.over_limit and len(t.encode(" ".join(BASE.split()[: words.n_within]), add_special_tokens=False).ids) <= 10 < len(t.encode(" ".join(BASE.split()[: words.n_within + 1]), add_special_tokens=False).ids)
    import time

    began = time.time()
    assert len(counter.table("<|endoftext|>" + "ab1 " * 10 + "y" * 20_000)) == 20_054 and time.time() - began < 5
    assert token_counts.count_tokens(none, WORD_BPE, 20).count() == 0


@pytest.mark.parametrize("hot", [20_000, 1])
def test_suffix_dedup(docs, none, hot, monkeypatch):
    if hot == 1:
        monkeypatch.setattr(suffix_dedup, "SCAN", 4000)
        monkeypatch.setattr(suffix_dedup, "PORTION", 3000)
        monkeypatch.setattr(suffix_dedup, "COMPARED", 500)
        monkeypatch.setattr(suffix_dedup, "PLACES", 7)
    seen, want = {}, {}
    big = suffix_dedup.NO_ID
    rows = sorted({(a[0] if a[0] is not None else big, a[1] or "") for a in AWKWARD})
    for did, text in rows:
        x = text.encode()
        for i in range(len(x) - 49):
            seen.setdefault(x[i : i + 50], did)
    for did, text in rows:
        x, gone = text.encode(), np.zeros(len(text.encode()), bool)
        for i in range(len(x) - 49):
            if seen[x[i : i + 50]] < did:
                gone[i : i + 50] = True
        kept = bytes(np.frombuffer(x, np.uint8)[~gone])
        want[did, len(x), int(gone.sum()), int((np.diff(gone.astype(int), prepend=0) == 1).sum()), hashlib.sha256(kept).hexdigest()] = text
    got = [(r.doc_id if r.doc_id is not None else big, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.report(docs, hot).collect()]
    assert len(got) == len(AWKWARD) and set(got) == set(want)
    assert suffix_dedup.report(none).count() == 0
    cleaned = suffix_dedup.remove_repeats(docs, hot)
    assert cleaned.columns == docs.columns and cleaned.count() == len(AWKWARD)


def scores_by_definition(rows, core, classes):
    """The class model's score of each row, from its docstring."""
    cut = lambda x: [b"", *re.findall(rb"[^\x20\x09-\x0D]+", (x or "").encode().lower()), b""]
    held = lambda d: d is not None and zlib.crc32(str(d).encode()) % 7 == 2
    train = [cut(a[1]) for a in rows if not held(a[0])]
    c = Counter(w for t in train for w in t[1:])
    repeated = sorted((w for w in c if w and c[w] > 1), key=lambda w: (-c[w], w))
    names = [b"", *repeated[:core]]
    pairs = np.zeros((len(names), len(names)), np.int64)
    for t in train:
        for a, b in zip(t, t[1:], strict=False):
            if a in names and b in names:
                pairs[names.index(a), names.index(b)] += 1
    of = dict(zip(names, class_lm.exchange(pairs, classes).tolist(), strict=True))
    table = np.ones((classes, classes))
    for i, a in enumerate(names):
        for j, b in enumerate(names):
            table[of[a], of[b]] += pairs[i, j]
    gain = np.log(table) - np.log(table.sum(axis=1))[:, None] - np.log(table.sum(axis=0))[None, :]
    usual = Counter(k for w, k in of.items() if w)
    usual = min(usual, key=lambda k: (-usual[k], k)) if usual else 1
    for w in repeated[core:]:
        total, some = np.zeros(classes), False
        for t in train:
            for i, x in enumerate(t):
                if x == w:
                    if t[i - 1] in names:
                        total, some = total + gain[of[t[i - 1]]], True
                    if t[i + 1] in names:
                        total, some = total + gain[:, of[t[i + 1]]], True
        of[w] = 1 + int(np.argmax(total[1:])) if some else usual
    class_of = lambda w: of.get(w, classes)
    size, steps, n = Counter(), Counter(), sum(c.values())
    for w, k in c.items():
        size[class_of(w)] += k
    for t in train:
        steps.update((class_of(a), class_of(b)) for a, b in zip(t, t[1:], strict=False))
    after = Counter()
    for (a, _), k in steps.items():
        after[a] += k
    rare = sum(1 for w in c if class_of(w) == classes)

    def log_p(a, b):
        j, k = class_of(a), class_of(b)
        move = (steps[j, k] + class_lm.SMOOTH * (size[k] + 1) / (n + classes + 1)) / (after[j] + class_lm.SMOOTH)
        return math.log10(move) + (math.log10(c[b] / size[k]) if k < classes else math.log10((1 if c[b] else rare) / (size[k] + rare)))

    return [sum(log_p(a, b) for a, b in zip(t, t[1:], strict=False)) for t in (cut(a[1]) for a in rows)]


@pytest.mark.parametrize("cached", [0, 40, 100_000])
def test_class_lm(docs, none, cached, monkeypatch):
    monkeypatch.setattr(class_lm, "BATCH_ROWS", 3)
    rows = class_lm.score(docs, cached=cached, core=20, classes=6).collect()
    assert len(rows) == len(AWKWARD)
    cut = lambda x: [*re.findall(rb"[^\x20\x09-\x0D]+", (x or "").encode().lower()), b""]
    held = lambda d: d is not None and zlib.crc32(str(d).encode()) % 7 == 2
    c = Counter(w for a in AWKWARD if not held(a[0]) for w in cut(a[1]))
    n, v = sum(c.values()), len(c)
    scores = scores_by_definition(AWKWARD, 20, 6)
    want = {(a[0], held(a[0]), len(cut(a[1])), sum(c[w] > 0 for w in cut(a[1])), n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in cut(a[1])), 3), round(s, 3)) for a, s in zip(AWKWARD, scores, strict=True)}
    assert {(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 3), round(r.score, 3)) for r in rows} == want
    assert all(r.perplexity == pytest.approx(10 ** (-r.score / r.n_tokens)) for r in rows)
    assert class_lm.score(none).count() == 0


def test_class_lm_without_training_rows(spark):
    from pyspark.sql import functions as F

    rows = class_lm.score(spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string"), F.lit(True)).collect()
    assert {(r.n_tokens, r.n_known, r.train_tokens) for r in rows} == {(3, 0, 0), (1, 0, 0)} and all(r.score < 0 for r in rows)


def test_exchange_reaches_an_optimum():
    rng = np.random.default_rng(1)
    words = [0] + [w for _ in range(3000) for w in (1 + rng.integers(0, 8), 9 + rng.integers(0, 8), 17 + rng.integers(0, 4))]
    pairs = np.zeros((21, 21), np.int64)
    np.add.at(pairs, (words[:-1], words[1:]), 1)

    def likelihood(of):
        table = np.zeros((4, 4))
        np.add.at(table, (of[:, None].repeat(21, 1), of[None, :].repeat(21, 0)), pairs)
        f = lambda x: float((x * np.log(np.maximum(x, 1))).sum())
        return f(table) - f(table.sum(0)) - f(table.sum(1))

    of = class_lm.exchange(pairs, 4)
    best = likelihood(of)
    assert of[0] == 0 and best > likelihood(np.where(np.arange(21) == 0, 0, 1 + (np.arange(21) - 1) % 3))
    for w in range(1, 21):
        for k in range(1, 4):
            moved = of.copy()
            moved[w] = k
            assert likelihood(moved) <= best + 1e-6


def test_quality_rules(spark, docs, none):
    labels = spark.createDataFrame([(4, 1), (5, 0), (None, 1), (99, 1), (6, None)], "doc_id long, quality int")
    rows = quality_rules.apply_rules(docs, labels).collect()
    assert len(rows) == len(AWKWARD)
    by_id = defaultdict(set)
    for a in AWKWARD:
        x = a[1] or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", x)
        n = Counter(zip(w, w[1:], w[2:], strict=False))
        covered = {j for i in range(len(w) - 2) if n[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
        lines = [y for y in x.split("\n") if y.strip(" \t\n\x0b\x0c\r")]
        by_id[a[0]].add((len(w), sum(map(len, w)), len(lines) - len(set(lines)), len(covered)))
    for r in rows:
        assert (r.n_words, r.word_chars, r.n_dup_lines, r.n_repeat_words) in by_id[r.doc_id]
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) and not (r.base_failed and r.kept)
    assert quality_rules.apply_rules(none, labels).count() == 0 and quality_rules.apply_rules(docs, labels.limit(0)).filter("not base_failed and not kept").count() == 0
    from pyspark.sql import functions as F

    for k, n, p in ((0, 700, 0.0125), (3, 900, 0.0125), (40, 5000, 0.0125)):
        exact = sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
        got = spark.createDataFrame([(k, n)], "k long, n long").select(quality_rules.binomial_cdf(F.col("k"), F.col("n"), p)).first()[0]
        assert abs(got - exact) < 1e-9


def test_simhash(docs, none):
    def fp(text):
        w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
        h = [xxhash.xxh64_intdigest(b" ".join(w[i : i + 3]), 42) for i in range(max(1, len(w) - 2))] if w else []
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    rows = simhash.simhash_components(docs).collect()
    assert len(rows) == len(AWKWARD)
    fps = {fp(a[1]) for a in AWKWARD}
    group = {f: f for f in fps}
    for _ in fps:
        for a in fps:
            for b in fps:
                if (a ^ b).bit_count() <= 3:
                    group[a] = group[b] = min(group[a], group[b])
    least = {g: min(a[0] for a in AWKWARD if a[0] is not None and group[fp(a[1])] == g) if any(a[0] is not None and group[fp(a[1])] == g for a in AWKWARD) else None for g in set(group.values())}
    want = sorted((a[0] is None, a[0] or 0, f"{fp(a[1]):016x}", least[group[fp(a[1])]]) for a in AWKWARD if True)
    assert sorted(map(repr, want)) == sorted(repr((r.doc_id is None, r.doc_id or 0, r.fingerprint, r.component_id)) for r in rows)
    assert simhash.simhash_components(none).count() == 0


@pytest.mark.parametrize("bucket", [4096, 4])
def test_links_are_complete(spark, bucket):
    simhash.BUCKET = bucket
    rng = np.random.default_rng(3)
    centre = rng.integers(0, 1 << 62, 6)
    near = {int(c) ^ sum(1 << int(b) for b in rng.choice(62, 2, replace=False)) for c in centre for _ in range(12)} | set(map(int, centre))
    fps = np.array(sorted(near), np.uint64)
    nodes = {r.node: r.component for r in components.connected_components(simhash.links(spark.createDataFrame([(int(f),) for f in fps], "fp long"))).collect()}
    for i, a in enumerate(fps):
        for b in fps[i + 1 :]:
            if int(a ^ b).bit_count() <= 3:
                assert nodes[int(a)] == nodes[int(b)]
    simhash.BUCKET = 4096


def test_near_duplicates(spark, docs, none):
    words = [f"t{i * 7919 % 1000}" for i in range(300)]
    texts = {1: words, 2: [*words[:100], "new", *words[101:]], 3: words[::-1], 4: words, 5: words[:40], 6: [*words[:250], *[f"z{i}" for i in range(50)]]}
    table = spark.createDataFrame([(i, " ".join(w)) for i, w in texts.items()], "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in simhash.near_duplicates(table).collect()}
    assert (got[1], got[2], got[4]) == (1, 1, 1) and got[3] == 3 and got[5] == 5
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns and kept.filter(f"text = '{BASE}'").count() == 1
    assert simhash.keep_one(none).count() == 0


def drifting(n, seed, size=160, step=4):
    """Word lists in a few chains, each a small edit of one before it, so that groups reach far beyond their first member."""
    rng = np.random.default_rng(seed)
    lists = [[f"{c}w{i}" for i in range(size)] for c in range(3)]
    while len(lists) < n:
        own = list(lists[rng.integers(max(0, len(lists) - 40), len(lists))])
        for _ in range(step if rng.random() < 0.7 else 1):
            own[rng.integers(size)] = f"n{rng.integers(1 << 30)}"
        lists.append(own)
    return [" ".join(w) for w in lists]


def least_reachable(n, pairs):
    label = list(range(n))
    moved = True
    while moved:
        moved = False
        for a, b in pairs:
            low = min(label[a], label[b])
            moved |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return label


@pytest.mark.parametrize("size", [160, 20])
def test_band_links_are_complete(size):
    hashes = [simhash.shingle_hashes(t, 5) for t in drifting(400, 5, size, 4 if size > 100 else 1)]
    fps, bits = np.array([simhash.fingerprint(h) for h in hashes], np.uint64), np.array([simhash.sketch(h)[1] for h in hashes])
    every = [(i, j) for i in range(400) for j in range(i) if int(fps[i] ^ fps[j]).bit_count() <= simhash.LOOSE_RADIUS and simhash.similar(bits[i : i + 1], bits[j : j + 1], 0.8)[0]]
    found = list(zip(*(x.tolist() for x in simhash.band_links(fps, bits, 0.8)), strict=True))
    assert set(found) <= set(every) | {(j, i) for i, j in every} and len(found) < 400
    assert least_reachable(400, found) == least_reachable(400, every)


def test_large_bands_are_whole(spark, monkeypatch):
    texts = drifting(300, 9)
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    whole = sorted(map(tuple, simhash.near_duplicates(table).collect()))
    for rows in (simhash.BROADCAST_ROWS, 0):
        monkeypatch.setattr(simhash, "PORTION", 7)
        monkeypatch.setattr(simhash, "BROADCAST_ROWS", rows)
        assert sorted(map(tuple, simhash.near_duplicates(table).collect())) == whole
    sets = [set(zip(*(t.split()[i:] for i in range(5)), strict=False)) for t in texts]
    group = dict(whole)
    # the error of sketches aside, similar texts share a group
    assert all(group[i] == group[j] for i in range(300) for j in range(i) if len(sets[i] & sets[j]) >= 0.85 * len(sets[i] | sets[j]))


def test_quality_classifier(spark, docs, none):
    rng = np.random.default_rng(5)
    good = lambda: " ".join(rng.choice(["river", "stone", "walks", "under", "light", "moves"], 60))
    bad = lambda: " ".join(w + "%%%" for w in rng.choice(["river", "stone", "buy", "cheap"], 60))
    texts = [good() if i % 2 else bad() for i in range(300)]
    model = quality_classifier.fit(texts[:200], [i % 2 for i in range(200)])
    assert np.mean((model.scores(texts[200:]) >= 0.5) == np.array([i % 2 == 1 for i in range(200, 300)])) > 0.95
    rows = quality_classifier.classify(docs, model).collect()
    assert len(rows) == len(AWKWARD) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    labels = spark.createDataFrame([], "doc_id long, quality int")
    constant = quality_classifier.train(docs, labels, ~quality_classifier.held_out())
    assert {r.score for r in quality_classifier.classify(docs, constant).collect()} == {0.5} and quality_classifier.classify(none, model).count() == 0


def test_token_ids_equal_the_library(monkeypatch):
    ids, bpe = expected_tokens(), ByteBpe(BYTE_BPE)
    rng = np.random.default_rng(3)
    parts = ["a", "don't", "I'll", " ", "  ", "\n", "\n\n", "\t", "\r", "\x01", "\x1c", "\x85", "\xa0", "\u3000", "日本語", "é", "e\u0301", "1234", "!?", ".", ",", "..", "3.14", "<|endoftext|>", "x" * 100, "'s", "Foo.", "\u200b", "🙂", "\x0b", "٣"]
    mixed = ["".join(rng.choice(parts, rng.integers(0, 14))) for _ in range(4000)]
    for cache in (None, 50):
        monkeypatch.setattr(token_ids, "CACHE_PIECES", cache or token_ids.CACHE_PIECES)
        for batch in (TEXTS, *(mixed[i : i + 100] for i in range(0, 4000, 100))):
            for x, own in zip(batch, bpe.ids(batch), strict=True):
                assert np.frombuffer(own, "<u2").tolist() == ids(x)[:-1].tolist()


def test_token_files(spark, docs, none, monkeypatch):
    monkeypatch.setattr(token_files, "FILE_TOKENS", 3000)
    ids = expected_tokens()
    files = token_files.write_files(docs, BYTE_BPE)
    rows = sorted(token_files.read_files(files).collect(), key=lambda r: r.start)
    order = sorted(AWKWARD, key=lambda a: (a[0] is not None, a[0] or 0, a[1] is not None, a[1] or ""))
    at = 0
    for r, a in zip(rows, order, strict=True):
        own = ids(a[1])
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32, bytes(r.ids)) == (a[0], at, len(own), zlib.crc32(own.tobytes()), own.tobytes())
        at += len(own)
    payload = bytearray(files.first().payload)
    payload[-5000] ^= 1
    with pytest.raises(ValueError):
        list(token_files.unpack_file(bytes(payload)))
    data = np.random.default_rng(2).integers(0, 300, 700_000).astype(np.uint16) ** 2
    coder = token_files.Coder(token_files.quantize(np.bincount(data, minlength=1 << 16)))
    words, marks, states = coder.encode(data)
    step = token_files.CHECKPOINT * token_files.LANES
    assert (coder.decode_segment(len(data), 1, words, marks[1], states[1]) == data[step : 2 * step]).all()
    assert token_files.read_files(token_files.write_files(none, BYTE_BPE)).count() == 0


def test_packing(spark, docs, none):
    ids = expected_tokens()
    rows = packing.pack(docs, BYTE_BPE, with_ids=True).collect()
    assert sum(r.length for r in rows) == sum(len(ids(a[1])) for a in AWKWARD)
    by_sequence, by_doc = defaultdict(list), defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append(r)
        by_doc[r.doc_id].append(r)
        assert r.ids_crc32 == zlib.crc32(r.ids) and 4 * r.length == len(r.ids)
    for own in by_sequence.values():
        ends = np.cumsum([0, *[r.length for r in sorted(own, key=lambda r: r.offset)]])
        assert [r.offset for r in sorted(own, key=lambda r: r.offset)] == ends[:-1].tolist()
        assert ends[-1] == 1024 or ends[-1] < 1024 and not ends[-1] & (ends[-1] - 1)
    for i in (7, 11, 12):
        assert b"".join(bytes(r.ids) for r in sorted(by_doc[i], key=lambda r: r.start)) == ids(TEXTS[i]).tobytes()
    assert packing.pack(none, BYTE_BPE).count() == 0


def test_packing_plan_is_whole():
    plan = packing.Plan([3_000_000, 700_001, 1500, 900])
    ends = [0, 0, 0, 0]
    for g in range(-(-plan.total // packing.GROUP)):
        bounds, offsets = plan.group(g)
        assert bounds[0].tolist() == ends and (np.diff(bounds, axis=0) >= 0).all()
        assert np.diff(bounds, axis=0).sum(axis=1).tolist() == plan.sizes(g) and (offsets[:, 0] == 0).all()
        share = np.diff(bounds, axis=0)[:1000, 1] / 1024 if len(bounds) > 1000 else np.array([0.0])
        assert np.ptp(share) <= 3 / 1024
        ends = bounds[-1].tolist()
    assert ends == plan.totals


def test_decontaminate(spark, docs, none):
    items = spark.createDataFrame([(1, BASE), (2, "tiny"), (3, None), (4, " ".join(f"bench{i * i % 541}" for i in range(90)))], "item_id long, text string")
    rows = decontaminate.leaks(docs, items).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in rows) == [(False, 4), (False, 4), (False, 5), (False, 6), (True, 0)] and {tuple(r.item_ids) for r in rows} == {(1,)}
    edited = BASE.upper().replace("QUICK", "quik").replace("WIZARDS", "wizzards").replace(" ", "\n")
    part = " ".join(f"bench{i * i % 541}" for i in range(20, 60))
    extra = spark.createDataFrame([(1, LONG + edited + LONG), (2, "some " + part + " end"), (3, BASE[:60] + LONG)], "doc_id long, text string")
    assert {r.doc_id: r.item_ids for r in decontaminate.leaks(extra, items).collect()} == {1: [1], 2: [4]}
    clean = decontaminate.remove_contaminated(docs, items)
    assert clean.columns == docs.columns and clean.count() == len(AWKWARD) - 5
    assert decontaminate.leaks(none, items).count() == 0 and decontaminate.leaks(docs, items.limit(0)).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 130)] + [(7, 7), (5, 4)]
    got = {r.node: r.component for r in components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 1 for i in range(1, 41)} | {i: 100 for i in range(100, 130)}
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_pipeline(spark):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    start = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, sf)
        assert after.dtypes == start.dtypes, name
        docs = after.cache()
        assert 0 < docs.count() <= start.count()
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    ids = expected_tokens()
    assert pieces.groupBy().sum("length").first()[0] == sum(len(ids(r.text)) for r in docs.collect())
