"""What the review of round 1 found to be missing from the training-data operators."""

import numpy as np

from quillgraph.llm import decontaminate, simhash


def shingle_set(text, size=5):
    words = text.split()
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))}


def components_of(n, linked):
    group = list(range(n))
    for i in range(n):
        for j in range(i):
            if group[i] != group[j] and linked(i, j):
                old, new = max(group[i], group[j]), min(group[i], group[j])
                group = [new if g == old else g for g in group]
    return group


def below_and_above(n, seed, edits=(1, 12)):
    """Texts around a few common ones, each with a few words replaced: pairs of them are on both sides of 0.8."""
    rng = np.random.default_rng(seed)
    bases = [[f"b{b}w{i}" for i in range(300)] for b in range(n // 20)]
    texts = []
    for k in range(n):
        own = list(bases[k % len(bases)])
        for _ in range(rng.integers(*edits)):
            own[rng.integers(300)] = f"n{rng.integers(1 << 30)}"
        texts.append(" ".join(own))
    return texts


def test_near_duplicates_are_exact(spark, monkeypatch):
    texts = below_and_above(80, 4, (3, 9))
    sets = [shingle_set(t) for t in texts]
    expected = components_of(len(texts), lambda i, j: len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]))
    assert 4 < len(set(expected)) < 80
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert [c for _, c in sorted(map(tuple, simhash.near_duplicates(table).collect()))] == expected
    assert simhash.keep_one(table).count() == len(set(expected))
    monkeypatch.setattr(simhash, "GROUP_PORTION", 7)
    for rows in (simhash.BROADCAST_ROWS, 0):
        monkeypatch.setattr(simhash, "BROADCAST_ROWS", rows)
        assert [c for _, c in sorted(map(tuple, simhash.near_duplicates(table).collect()))] == expected


def test_exact_links_of_a_large_group():
    texts = below_and_above(240, 8)
    hashes = [np.unique(simhash.shingle_hashes(t, 5)) for t in texts]
    sets = [set(h.tolist()) for h in hashes]
    linked = lambda i, j: len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])
    a, b = simhash.exact_links(hashes, 0.8)
    assert all(map(linked, a.tolist(), b.tolist()))
    found = {frozenset(p) for p in zip(a.tolist(), b.tolist(), strict=True)}
    assert components_of(240, lambda i, j: frozenset((i, j)) in found) == components_of(240, linked)


def test_leaks_are_of_the_text_that_holds_them():
    rng = np.random.default_rng(2)
    word = lambda n: "".join(chr(97 + c) for c in rng.integers(0, 26, n))
    # an item of 190 bytes makes the bands 20 wide
    items = [(0, word(190)), *((i, word(24 + i)) for i in range(1, 50))]
    texts, expected = [], []
    for i, item in items:
        for text in (item + " " + word(90), word(61 + i) + " " + item, item[: len(item) * 19 // 20] + " " + word(33)):
            texts += [word(70 + i), text]
            expected += [set(), {i}]
    assert [set(f) for f in decontaminate.Patterns(items).search(texts)] == expected


def test_excerpts_of_a_pattern_are_found():
    rng = np.random.default_rng(6)
    word = lambda n: "".join(chr(97 + c) for c in rng.integers(0, 26, n))
    items = [(1, word(129)), (2, word(190)), (3, word(400))]
    patterns = decontaminate.Patterns(items)
    for i, item in items:
        excerpts = [f"{word(50)} {item[s : s + 128]} {word(50)}" for s in range(len(item) - 127)]
        assert patterns.search(excerpts) and all(set(f) == {i} for f in patterns.search(excerpts))
    assert not any(patterns.search([word(300) for _ in range(50)]))


def part_edits(unit, text):
    """Least edits between unit and any part of text."""
    row = np.zeros(len(text) + 1, int)
    data = np.frombuffer(text, np.uint8)
    for i, c in enumerate(unit, 1):
        best = np.minimum(row[:-1] + (data != c), row[1:] + 1)
        row = np.minimum.accumulate(np.concatenate([[i], best]) - np.arange(len(text) + 1)) + np.arange(len(text) + 1)
    return int(row.min())


def held_by(item, text):
    """Whether some unit of the item lies in the text within its edits."""
    x, y = decontaminate.normalized(item), decontaminate.normalized(text)
    m = min(len(x), decontaminate.UNIT)
    budget = min(int(m * decontaminate.RATE), (m - decontaminate.Q) // decontaminate.Q)
    return bool(y) and any(part_edits(x[s : s + m], y) <= budget for s in range(len(x) - m + 1))


def mutated(rng, text, edits):
    own = list(text)
    for _ in range(edits):
        at, kind = rng.integers(len(own)), rng.integers(3)
        if kind == 0:
            own[at] = chr(97 + rng.integers(26))
        elif kind == 1:
            own.insert(at, chr(97 + rng.integers(26)))
        else:
            own.pop(at)
    return "".join(own)


def test_leaks_are_those_of_an_edit_distance():
    rng = np.random.default_rng(12)
    word = lambda n: " ".join("".join(chr(97 + c) for c in rng.integers(0, 8, rng.integers(2, 7))) for _ in range(n))
    items = [(i, word(n)) for i, n in enumerate((6, 8, 12, 20, 25, 27, 30, 40))] + [(90, "ab " * 60), (91, "the " * 9)]
    texts, sure = [None, "", "ab", "ab " * 900, "the the the", "the " * 40], 0
    for i, item in items[:8] * 3:
        for edits in (0, 3, 7, 11, 13, 16):
            n = min(len(item), 128)
            start = int(rng.integers(0, len(item) - n + 1))
            texts.append(f"{word(int(rng.integers(0, 9)))} {mutated(rng, item[start : start + n], edits)} {word(int(rng.integers(0, 9)))}")
    patterns = decontaminate.Patterns(items)
    for text, found in zip(texts, patterns.search(texts), strict=True):
        want = {i for i, item in items if held_by(item, text)}
        assert set(found) == want, text
        sure += len(want)
    assert 60 < sure < 150
    assert [bool(f) for f in patterns.search(texts, all_items=False)] == [bool(f) for f in patterns.search(texts)]


def test_short_items_are_found_as_words():
    patterns = decontaminate.Patterns([(1, "Red fox"), (2, "ox"), (3, " "), (4, None)])
    assert [set(f) for f in patterns.search(["a red\nFOX ran", "the ox", "box", "red foxes", "red fox. ox"])] == [{1}, {2}, set(), set(), {2}]


def test_repeated_periods_stay_bounded(monkeypatch):
    import tracemalloc

    text, item = "ab" * 100_000, "ab" * 90
    patterns = decontaminate.Patterns([(1, item), (2, "xyz " * 400_000)])
    assert len(patterns.text) < 10
    monkeypatch.setattr(decontaminate, "SLICE", 300_000)
    tracemalloc.start()
    assert [set(f) for f in patterns.search([text, "xyz " * 50_000, "clean words"])] == [{1}, {2}, set()]
    assert tracemalloc.get_traced_memory()[1] < 150_000_000
    tracemalloc.stop()


def test_a_leak_is_one_row_whatever_its_blocks(spark, monkeypatch):
    rng = np.random.default_rng(1)
    word = lambda n: "".join(chr(97 + c) for c in rng.integers(0, 26, n))
    items = [(i, word(200)) for i in range(8)]
    docs = [(1, " ".join(x for _, x in items)), (1, " ".join(x for _, x in items)), (2, items[3][1]), (None, items[0][1]), (4, word(300))]
    table, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    whole = sorted(map(repr, decontaminate.leaks(table, bench).collect()))
    assert len(whole) == 4
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 400)
    assert sorted(map(repr, decontaminate.leaks(table, bench).collect())) == whole
    assert decontaminate.remove_contaminated(table, bench).count() == 1
