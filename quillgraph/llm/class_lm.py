"""Language-model scoring with Brown classes: exchange clustering, class transitions, word emissions.

Tokens are words (A-Z in lower case) and one end for each text. All counts are exact and cover all training rows. Every
word that training has twice or more has a class. The CORE most frequent ones are clustered by exchange (each word in
turn moves to the class that makes the class-bigram likelihood of the training text largest, until none moves); every
other, however many there are, makes one such exchange, by the core's classes to its left and right. Words seen once stand for
those never seen and share the class `rare`; `end` is a class of its own. A token's probability is that of its class
after the class before it, times that of the word in its class:

    P(k | j) = (n(j, k) + SMOOTH * P(k)) / (n(j) + SMOOTH),  P(k) = (N(k) + 1) / (N + number of classes)
    P(w | k) = c(w) / N(k);  in `rare` (Witten-Bell): 1 / (N(rare) + V(rare)), or V(rare) / (N(rare) + V(rare)) for a
    word never seen, as one more type

Neighbours are summed in the scan of the texts and meet by word in a shuffle, so what is gathered grows with the corpus.
The CACHED most frequent words are sent to the executors with class and count; other words get theirs by a join, which
returns them to their texts. A text is then one byte a token, its classes, from which transitions are counted and scores
summed. CACHED only decides where a word is looked up, never what is found.

Defined cases: a null or empty text has one token, its end; without training rows every class probability is uniform
and N and V are 0; rows of null doc_id are not held out; repeated rows count and are scored each; words and texts may
be of any length; of words of equal count, the smaller in bytes is the more frequent; extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillgraph.llm.common import drop_path, materialize

CORE, CLASSES, SMOOTH, SWEEPS = 1500, 48, 5.0, 12
#: Words whose class and count every executor holds.
CACHED = 200_000
#: Distinct words, and neighbours, that a counting task holds before it hands them on.
HELD_WORDS, HELD_CODES = 300_000, 4_000_000
#: Class of a token that is looked up by a join.
OPEN = 255
#: Texts that a task cuts into words at once.
BATCH_ROWS = 300
END = b""


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2, F.lit(False))


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(0, batch.num_rows, BATCH_ROWS):
            yield batch.slice(i, BATCH_ROWS)


def words(text: str | None) -> list[bytes]:
    return text.encode().lower().split() if text else []


def count_words(train: DataFrame) -> DataFrame:
    """(word binary, c) of all training tokens; the end is the empty word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], ["word", "c"])

        for batch in _parts(batches):
            for text in batch.column("text").to_pylist():
                held.update(words(text))
                if len(held) > HELD_WORDS:
                    yield out()
                    held.clear()
            held[END] += batch.num_rows
        if held:
            yield out()

    return train.mapInArrow(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def frequent(counts: DataFrame, n: int) -> DataFrame:
    """The n most frequent words that were seen twice or more, in order."""
    real = counts.filter((F.length("word") > 0) & (F.col("c") > 1))
    # a histogram of counts first, so that only rows of the last one needed are sorted beyond n
    least, seen = 2, 0
    for r in real.groupBy("c").agg(F.count("*").alias("n")).orderBy(F.desc("c")).limit(n).collect():
        least, seen = r["c"], seen + r["n"]
        if seen >= n:
            break
    return real.filter(F.col("c") >= least).orderBy(F.desc("c"), "word").limit(n)


def _ids(texts: list[str | None], number: dict[bytes, int]) -> np.ndarray:
    """Numbers of all tokens of the texts, each text begun (not counted) and ended by the end's number 0; -1 if unknown."""
    tokens = [END]
    for t in texts:
        tokens += words(t)
        tokens.append(END)
    get = number.get
    return np.array([get(w, -1) for w in tokens], np.int32)


def core_pairs(train: DataFrame, core: list[bytes]) -> np.ndarray:
    """Counts of neighbouring core words, core x core."""
    number, n = {w: i for i, w in enumerate(core)}, len(core)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, held, size = np.zeros(n * n, np.int64), [], 0
        for batch in _parts(batches):
            ids = _ids(batch.column("text").to_pylist(), number)
            both = (ids[:-1] >= 0) & (ids[1:] >= 0)
            held.append(ids[:-1][both] * n + ids[1:][both])
            size += len(held[-1])
            if size > HELD_CODES:
                total += np.bincount(np.concatenate(held), minlength=n * n)
                held, size = [], 0
        if held:
            total += np.bincount(np.concatenate(held), minlength=n * n)
        pair = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(pair), pa.array(total[pair])], ["pair", "n"])

    summed = train.mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(n * n, np.int64)
    out[summed.column("pair").to_numpy()] = summed.column("n").to_numpy()
    return out.reshape(n, n)


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def exchange(pairs: np.ndarray, classes: int, sweeps: int = SWEEPS) -> np.ndarray:
    """Class of each core word. Word 0, the end, has class 0 to itself; the others begin dealt by frequency.

    A move of a word changes one row and one column of the class-bigram counts for its old class and for each possible
    new one; the word goes where sum n log n over class pairs less those over single classes gains most.
    """
    n = len(pairs)
    of = np.where(np.arange(n) == 0, 0, 1 + (np.arange(n) - 1) % max(1, classes - 1))
    left_of, own = pairs.T.astype(float), np.diag(pairs).astype(float)
    right_of = pairs.astype(float)
    table = np.zeros((classes, classes))
    np.add.at(table, (of[:, None].repeat(n, 1), of[None, :].repeat(n, 0)), pairs)
    for _ in range(sweeps):
        moved = 0
        for w in range(1, n):
            a = of[w]
            before = np.bincount(of, left_of[w], classes)
            after = np.bincount(of, right_of[w], classes)
            before[a] -= own[w]
            after[a] -= own[w]
            # without w
            table[a, :] -= after
            table[:, a] -= before
            table[a, a] -= own[w]
            rows, columns = table.sum(axis=1), table.sum(axis=0)
            cross = table + 0.0
            gain = (_xlogx(cross + after[None, :]) - _xlogx(cross)).sum(axis=1) + (_xlogx(cross + before[:, None]) - _xlogx(cross)).sum(axis=0)
            d = np.arange(classes)
            corner = table[d, d]
            gain += _xlogx(corner + after + before + own[w]) - _xlogx(corner + after) - _xlogx(corner + before) + _xlogx(corner)
            more_right, more_left = after.sum() + own[w], before.sum() + own[w]
            gain -= _xlogx(rows + more_right) - _xlogx(rows) + _xlogx(columns + more_left) - _xlogx(columns)
            gain[0] = -np.inf
            b = int(np.argmax(gain))
            if gain[b] <= gain[a] + 1e-9:
                b = a
            table[b, :] += after
            table[:, b] += before
            table[b, b] += own[w]
            moved += b != a
            of[w] = b
        if not moved:
            break
    return of


def exchanged(train: DataFrame, core: list[bytes], of_core: np.ndarray, pairs: np.ndarray, classes: int) -> DataFrame:
    """(word binary, k): the class that one exchange gives to each word outside the core that has a core neighbour.

    A task hands on a row for each word, with its neighbours' classes, left ones and right ones, and how often each was
    there; the rows meet by word.
    """
    number, n_core, wide = {w: i for i, w in enumerate(core)}, len(of_core), 2 * classes
    table = np.ones((classes, classes))
    np.add.at(table, (of_core[:, None].repeat(n_core, 1), of_core[None, :].repeat(n_core, 0)), pairs)
    gain = np.log(table) - np.log(table.sum(axis=1))[:, None] - np.log(table.sum(axis=0))[None, :]
    weight = np.concatenate([gain, gain.T])
    weight[:, 0] = -1e12

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, int] = {}
        codes, uses, size = [], [], 0

        def fold() -> None:
            nonlocal codes, uses, size
            every, n = np.concatenate(codes), np.concatenate(uses)
            order = np.argsort(every, kind="stable")
            first = np.flatnonzero(np.concatenate([[True], every[order][1:] != every[order][:-1]]))
            codes, uses = [every[order][first]], [np.add.reduceat(n[order], first)]
            size = len(first)

        def out() -> pa.RecordBatch:
            fold()
            word, at = np.divmod(codes[0], wide)
            first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            names, ends = list(held), np.append(first[1:], len(word))
            offsets = pa.array(np.append(first, len(word)), pa.int32())
            columns = [pa.array([names[w] for w in word[first].tolist()], pa.binary()), pa.ListArray.from_arrays(offsets, pa.array(at, pa.int32())), pa.ListArray.from_arrays(offsets, pa.array(uses[0], pa.int64()))]
            held.clear()
            codes.clear()
            uses.clear()
            return pa.RecordBatch.from_arrays(columns, ["word", "at", "n"]) if len(ends) else None

        for batch in _parts(batches):
            tokens = [END]
            for t in batch.column("text").to_pylist():
                tokens += words(t)
                tokens.append(END)
            ids = np.array([number.get(w, -1) for w in tokens], np.int32)
            place = np.flatnonzero(ids < 0)
            own = np.array([held.setdefault(tokens[p], len(held)) for p in place.tolist()], np.int64) * wide
            left, right = ids[place - 1], ids[(place + 1) % len(ids)]
            new = np.concatenate([own[left >= 0] + of_core[left[left >= 0]], own[right >= 0] + classes + of_core[right[right >= 0]]])
            codes.append(new)
            uses.append(np.ones(len(new), np.int64))
            size += len(new)
            if size > HELD_CODES:
                fold()
            if (len(held) > HELD_WORDS or size > HELD_CODES // 2) and size:
                yield out()
                size = 0
        if size:
            yield out()

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total = None, np.zeros(wide)
        for batch in batches:
            names = batch.column("word").to_pylist()
            at, n = batch.column("at"), batch.column("n")
            lengths = np.diff(at.offsets.to_numpy())
            new = np.array([a != b for a, b in zip(names, [now, *names[:-1]], strict=True)])
            group = np.cumsum(new)
            # group 0 goes on from the batch before
            uses = np.zeros((int(group[-1]) + 1 if len(group) else 1, wide))
            uses[0] = total
            np.add.at(uses, (np.repeat(group, lengths), at.flatten().to_numpy()), n.flatten().to_numpy())
            done = [*([now] if now is not None else []), *(w for w, fresh in zip(names, new.tolist(), strict=True) if fresh)]
            rows = uses if now is not None else uses[1:]
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(done[:-1], pa.binary()), pa.array(np.argmax(rows[:-1] @ weight, axis=1), pa.int32())], ["word", "k"])
                now, total = done[-1], rows[-1]
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now], pa.binary()), pa.array([int(np.argmax(total @ weight))], pa.int32())], ["word", "k"])

    met = train.mapInArrow(count, "word binary, at array<int>, n array<long>").repartition("word").sortWithinPartitions("word")
    return met.mapInArrow(choose, "word binary, k int")


def transitions(train: DataFrame, k: int) -> np.ndarray:
    """Counts of neighbouring classes, k x k, of texts as their classes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(k * k, np.int64)
        for batch in _parts(batches):
            own = _flat(batch.column("classes"))
            total += np.bincount(own[:-1] * k + own[1:], minlength=k * k)
        pair = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(pair), pa.array(total[pair])], ["pair", "n"])

    out = np.zeros(k * k, np.int64)
    for r in train.select("classes").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).collect():
        out[r["pair"]] = r["n"]
    return out.reshape(k, k)


def _flat(classes: pa.Array) -> np.ndarray:
    """The classes of all texts, each text after an end: the first begins with one more, the others follow one."""
    return np.frombuffer(b"".join([b"\0", *classes.to_pylist()]), np.uint8).astype(np.int64)


def score(docs: DataFrame, is_held_out: Column | None = None, cached: int = CACHED, core: int = CORE, classes: int = CLASSES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score and perplexity of each row of docs."""
    if classes > OPEN - 1:
        raise ValueError("a class is a byte")
    marked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", (held_out() if is_held_out is None else is_held_out).alias("held_out"))
    train = marked.filter(~F.col("held_out")).select("text")
    counts = materialize(count_words(train), "word-counts")
    n_all, n_distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    ends = counts.filter(F.length("word") == 0).agg(F.coalesce(F.sum("c"), F.lit(0))).first()[0]
    first = [(bytes(r["word"]), r["c"]) for r in frequent(counts, core).collect()]
    names = [END, *(w for w, _ in first)]
    pairs = core_pairs(train, names)
    of_core = exchange(pairs, classes)
    # for words without a core neighbour the class that most core words have
    usual = int(np.bincount(of_core[1:], minlength=2)[1:].argmax()) + 1 if len(names) > 1 else min(1, classes - 1)
    chosen = exchanged(train, names, of_core, pairs, classes)
    joined = counts.filter(F.length("word") > 0).join(chosen, "word", "left")
    lexicon = materialize(joined.select("word", "c", F.when(F.col("c") > 1, F.coalesce("k", F.lit(usual))).otherwise(classes).alias("k")), "lexicon")
    in_core = set(names)
    known = {END: (0, ends)} | {w: (int(k), c) for (w, c), k in zip(first, of_core[1:], strict=True)}
    known |= {w: (r["k"], r["c"]) for r in frequent(lexicon, cached).collect() if (w := bytes(r["word"])) not in in_core}
    size = np.zeros(classes + 1)
    for r in lexicon.groupBy("k").agg(F.sum("c").alias("c")).collect():
        size[r["k"]] = r["c"]
    # the core's words are in the lexicon with a class of their neighbours; theirs is of the exchange
    core_rows = lexicon.join(F.broadcast(docs.sparkSession.createDataFrame([(bytearray(w),) for w, _ in first], "word binary")), "word")
    for r in core_rows.groupBy("k").agg(F.sum("c").alias("c")).collect():
        size[r["k"]] -= r["c"]
    np.add.at(size, of_core, [ends, *(c for _, c in first)])
    v_rare = int(size[classes])
    share = (size + 1) / (n_all + classes + 1)
    all_log, rare_log = float(np.log10(n_all + n_distinct + 1)), -float(np.log10(max(size[classes] + v_rare, 1)))
    new_log = rare_log + float(np.log10(max(v_rare, 1)))
    log_size = np.log10(np.maximum(size, 1))
    number = {w: i for i, w in enumerate(known)}
    of = np.array([k for k, _ in known.values()] + [OPEN], np.int64)
    c = np.array([n for _, n in known.values()], np.float64)
    emission = np.append(np.log10(np.maximum(c, 1)) - log_size[of[:-1]], 0.0)
    base_log, seen = np.append(np.log10(c + 1), 0.0), np.append(c > 0, False)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        for batch in _parts(batches):
            tokens = [words(t) for t in batch.column("text").to_pylist()]
            ids = np.array([number.get(w, -1) for own in tokens for w in (*own, END)], np.int32)
            lengths = np.array([len(own) + 1 for own in tokens])
            begin = np.cumsum(lengths) - lengths
            sums = [np.add.reduceat(x, begin) if len(begin) else x[:0] for x in (emission[ids], base_log[ids], seen[ids].astype(np.int64))]
            raw, ends = of[ids].astype(np.uint8).tobytes(), np.cumsum(lengths).tolist()
            rare = [[w for w in own if w not in number] for own in tokens]
            columns = [pa.array(row + np.arange(len(tokens))), batch.column("doc_id"), batch.column("held_out"), pa.array(lengths, pa.int64()), *(pa.array(x, t) for x, t in zip(sums, (pa.float64(), pa.float64(), pa.int64()), strict=True))]
            columns += [pa.array([raw[z - n : z] for z, n in zip(ends, lengths.tolist(), strict=True)], pa.binary()), pa.array(rare, pa.list_(pa.binary()))]
            row += len(tokens)
            yield pa.RecordBatch.from_arrays(columns, ["row", "doc_id", "held_out", "n_tokens", "emission", "base", "known", "classes", "rare"])

    scanned = materialize(marked.mapInArrow(scan, "row long, doc_id long, held_out boolean, n_tokens long, emission double, base double, known long, classes binary, rare array<binary>"), "scanned")
    looked_up = scanned.select("row", F.posexplode("rare").alias("at", "word")).join(lexicon, "word")
    found = looked_up.groupBy("row").agg(F.collect_list(F.struct("at", "k", "c")).alias("found"))
    columns = ["doc_id", "held_out", "n_tokens", "known", "base", "emission", "classes"]

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches):
            own = dict(zip(columns, (batch.column(c).to_pylist() for c in columns), strict=True))
            for i, list_ in enumerate(batch.column("found")):
                whole = np.frombuffer(own["classes"][i], np.uint8)
                open_ = np.flatnonzero(whole == OPEN)
                if not len(open_):
                    continue
                k = np.full(len(open_), classes)
                value = np.full(len(open_), new_log)
                if list_.is_valid:
                    at, k_, n = (list_.values.field(f).to_numpy() for f in ("at", "k", "c"))
                    k[at] = k_
                    value[at] = np.where(k_ < classes, np.log10(n) - log_size[k_], rare_log)
                    own["known"][i] += len(at)
                    own["base"][i] += float(np.log10(n + 1.0).sum())
                whole = whole.copy()
                whole[open_] = k
                own["classes"][i] = whole.tobytes()
                own["emission"][i] += float(value.sum())
            yield pa.RecordBatch.from_arrays([pa.array(own[c], batch.schema.field(c).type) for c in columns], columns)

    joined = scanned.drop("rare").join(found, "row", "left").select(*columns, "found")
    filled = materialize(joined.mapInArrow(fill, "doc_id long, held_out boolean, n_tokens long, known long, base double, emission double, classes binary"), "classes")
    for used in (counts, lexicon, scanned):
        drop_path(used)
    k = classes + 1
    table = transitions(filled.filter(~F.col("held_out")), k)
    step = np.log10((table + SMOOTH * share[None, :]) / (table.sum(axis=1)[:, None] + SMOOTH)).ravel()

    def sum_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches):
            own, lengths = _flat(batch.column("classes")), batch.column("n_tokens").to_numpy()
            total = np.add.reduceat(step[own[:-1] * k + own[1:]], np.cumsum(lengths) - lengths) if len(lengths) else np.zeros(0)
            value = total + batch.column("emission").to_numpy()
            names = ["doc_id", "held_out", "n_tokens", "n_known"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "held_out", "n_tokens", "known")), pa.array(np.full(len(lengths), n_all), pa.int64()), pa.array(batch.column("base").to_numpy() - lengths * all_log), pa.array(value), pa.array(10 ** (-value / lengths))], [*names, "train_tokens", "base_score", "score", "perplexity"])

    return filled.mapInArrow(sum_up, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, perplexity double")
