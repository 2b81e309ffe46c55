"""Exact token counts at every prefix of a text, by prefix dynamic programming over a word-level BPE.

A BPE encoding is the one sequence of tokens in which no merge across a boundary would have come before the merges
that hide it. So the last token of each prefix can be found from the last tokens of shorter prefixes: the one token
that ends there and whose left neighbour, the last token of what remains, is compatible with it. That gives the count
of tokens at every prefix of a word in one pass, and words share the work for common prefixes. A text's table is its
pieces' tables one after the other; a lookup in it answers how many tokens a prefix has, or how long the longest
prefix within a budget is, without encoding again.

The tokenizer lowers case, drops white space and ends words with a suffix; prefixes are counted in code points of the
normalized text (`normalize`). Every count is the programme's own: the library only normalizes a piece and cuts it into
words. The query keeps a text's counts at the end of each of its pieces, and reads its total, whether that is over the
limit, and how many pieces are within it, from there.

Defined cases: a null or empty text has no tokens and an empty table; a special token's string inside a text is that
one token, as the library has it, its beginnings are ordinary text; very long texts and words without spaces take linear
time; rows with null ids, repeated rows and extra columns pass through, except that columns of the result's names are
replaced.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Pieces in each of a worker's two generations, prefixes in its memo, and the longest word whose prefixes are kept.
CACHE_PIECES, MEMO_PREFIXES, MEMO_LENGTH = 500_000, 600_000, 24
BATCH_ROWS = 500

#: Words of the tokenizer's pattern that are only made by their third character.
CONTRACTIONS = ("'re", "'ve", "'ll")
_plain = re.compile(r"([A-Za-z]+)([.,]?)\Z")


class PrefixCounter:
    def __init__(self, path: str):
        import json

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        self.end = model["end_of_word_suffix"]
        self.vocab: dict[str, int] = model["vocab"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        #: (left id, right id) -> rank, and token id -> (rank, left id, right id) of the merge that makes it
        self.rank: dict[tuple[int, int], int] = {}
        self.made: dict[int, tuple[int, int, int]] = {}
        for r, (a, b) in enumerate(merges):
            pair = self.vocab[a], self.vocab[b]
            self.rank.setdefault(pair, r)
            self.made.setdefault(self.vocab[a + b], (r, *pair))
        self.longest = max(len(t) for t in self.vocab)
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")")
        self.young: dict[str, int] = {}
        self.old: dict[str, int] = {}
        self.fits: dict[tuple[int, int], bool] = {}
        self.memo: dict[str, tuple[int, int]] = {}

    def _edge(self, token: int, side: int) -> list[tuple[int, float]]:
        """The tokens that stood at one edge of `token` while it was built, each with the rank of the merge that hid it."""
        out, hidden = [], float("inf")
        while True:
            out.append((token, hidden))
            if token not in self.made:
                return out
            hidden, token = self.made[token][0], self.made[token][side]

    def compatible(self, left: int, right: int) -> bool:
        """Whether `left` and `right` stay apart: no merge of their edges comes before both edges are hidden.

        At equal rank the leftmost merge is first, so a merge across the boundary loses to the one inside `left` and
        wins over the one inside `right`.
        """
        known = self.fits.get((left, right))
        if known is None:
            rights = self._edge(right, 1)
            known = not any((r := self.rank.get((a, b))) is not None and r < hid_a and r <= hid_b for a, hid_a in self._edge(left, 2) for b, hid_b in rights)
            if len(self.fits) > 2_000_000:
                self.fits.clear()
            self.fits[left, right] = known
        return known

    def _states(self, w: str) -> tuple[list[int], list[int]]:
        """For w's prefixes of 0, 1, .. len(w) symbols that no word ends with: the last token, and how many there are."""
        keep, vocab, longest, memo, fits = len(w) <= MEMO_LENGTH, self.vocab, self.longest, self.memo, self.fits
        last, inner = [-1], [0]
        for i in range(1, len(w) + 1):
            if keep and (known := memo.get(w[:i])):
                last.append(known[0])
                inner.append(known[1])
                continue
            for j in range(max(0, i - longest), i):
                token = vocab.get(w[j:i])
                if token is not None and (j == 0 or (fits[x] if (x := (last[j], token)) in fits else self.compatible(*x))):
                    last.append(token)
                    inner.append(inner[j] + 1)
                    break
            else:
                raise KeyError(w)
            if keep:
                memo[w[:i]] = last[i], inner[i]
        return last, inner

    def _ended(self, w: str, i: int, last: list[int], inner: list[int]) -> int:
        """Token count of w's first i symbols, ended as a word."""
        for j in range(max(0, i - self.longest), i):
            token = self.vocab.get(w[j:i] + self.end)
            if token is not None and (j == 0 or self.compatible(last[j], token)):
                return inner[j] + 1
        raise KeyError(w)

    def word(self, w: str, all_prefixes: bool) -> list[int]:
        """Token counts of w's prefixes of 1, 2, .. len(w) symbols, each ended as a word; else of the whole w only."""
        last, inner = self._states(w[:-1] if not all_prefixes else w)
        return [self._ended(w, i, last, inner) for i in (range(1, len(w) + 1) if all_prefixes else [len(w)])]

    def _words(self, text: str) -> list[tuple[str, tuple[int, int]]]:
        return self.tokenizer.pre_tokenizer.pre_tokenize_str(text)

    def _ordinary(self, text: str) -> list[int]:
        """Counts at the code points 1, 2, .. of a normalized piece without a special token's string."""
        out, total, at = [0] * len(text), 0, 0
        for mapped, (start, end) in self._words(text):
            out[at:start] = [total] * (start - at)
            word = text[start:end]
            by_symbol = self.word(mapped, True)
            counts = [by_symbol[k - 1] for k in np.cumsum([len(c.encode()) for c in word]).tolist()]
            if word in CONTRACTIONS:
                counts[1] = 2  # a contraction's second letter isn't part of it until the third is there
            out[start:end] = [total + c for c in counts]
            total, at = total + counts[-1], end
        out[at:] = [total] * (len(text) - at)
        return out

    def _table(self, piece: str, special: tuple[tuple[int, int], ...]) -> list[int]:
        """Counts at the code points 1, 2, .. of the normalized piece, which has special tokens at these places."""
        out, total, at = [], 0, 0
        for start, end in [*special, (len(piece), len(piece))]:
            before = piece[at:start]
            counts = self._ordinary(before)
            out += [total + c for c in counts]
            if start < end:
                # until it is whole, a special token's string goes on from the text before it
                inside = self._ordinary(before + piece[start : end - 1])[len(before) :]
                out += [total + c for c in inside]
                total += (counts[-1] if counts else 0) + 1
                out.append(total)
            at = end
        return out

    def _total(self, piece: str) -> int:
        """Tokens of a piece."""
        m = _plain.match(piece)
        if m:
            return self.word(m[1].lower(), False)[0] + bool(m[2])
        if "<" not in piece or not self.special.search(piece):
            return sum(self.word(w, False)[0] for w, _ in self._words(self.normalize(piece)))
        parts = self.special.split(piece)
        return len(parts) // 2 + sum(map(self._total, filter(None, parts[::2])))

    def _learn(self, pieces: list[str]) -> list[int]:
        if len(self.memo) > MEMO_PREFIXES:
            self.memo.clear()
        return list(map(self._total, pieces))

    def steps(self, texts: list[str | None]) -> list[np.ndarray]:
        """For each text the token counts of its first 0, 1, .. pieces; a piece ends at a space or line feed."""
        if len(self.young) > CACHE_PIECES:
            self.old, self.young = self.young, {}
        cut = [t.replace("\n", " ").split(" ") if t else [] for t in texts]
        missing = {p for own in cut for p in own}.difference(self.young)
        self.young.update((p, self.old[p]) for p in missing.intersection(self.old))
        new = sorted(missing.difference(self.old))
        self.young.update(zip(new, self._learn(new), strict=True))
        get = self.young.__getitem__
        return [np.cumsum([0, *map(get, own)]) for own in cut]

    def normalize(self, text: str | None) -> str:
        return self.tokenizer.normalizer.normalize_str(text or "")

    def table(self, text: str | None) -> np.ndarray:
        """Token counts of the prefixes of 0, 1, .. code points of the text as the library reads it: special tokens are found in
        the raw text, and what lies between them is normalized."""
        parts = self.special.split(text or "")
        parts[::2] = map(self.normalize, parts[::2])
        ends = np.cumsum([len(p) for p in parts]).tolist()
        found, whole, steps, at, k = list(zip(ends[::2], ends[1::2], strict=False)), "".join(parts), [np.zeros(1, "i4")], 0, 0
        own: dict[tuple, np.ndarray] = {}
        for m in re.finditer("[^ ]+", whole):
            first = k
            while k < len(found) and found[k][0] < m.end():
                k += 1
            key = m[0], tuple((s - m.start(), e - m.start()) for s, e in found[first:k])
            if key not in own:
                own[key] = np.diff(self._table(*key), prepend=0)
            steps += [np.zeros(m.start() - at, "i4"), own[key]]
            at = m.end()
        steps.append(np.zeros(len(whole) - at, "i4"))
        return np.concatenate(steps).cumsum()


def tokens_at(table: np.ndarray, prefix: int) -> int:
    """How many tokens the prefix of so many code points has."""
    return int(table[min(prefix, len(table) - 1)])


def longest_prefix(table: np.ndarray, budget: int) -> int:
    """Steps (code points, or pieces) of the longest prefix that has at most `budget` tokens."""
    return int(np.searchsorted(table, budget, "right")) - 1


_loaded: dict[str, PrefixCounter] = {}


def counter(path: str) -> PrefixCounter:
    if path not in _loaded:
        _loaded[path] = PrefixCounter(path)
    return _loaded[path]


def count_tokens(docs: DataFrame, path: str, limit: int, store: bool = False, text: str = "text") -> DataFrame:
    """docs with n_bytes, n_tokens, over_limit and n_within (pieces of the longest prefix of at most `limit` tokens), and
    with `store` prefix_tokens: the count at every prefix, an array."""
    names = ["n_bytes", "n_tokens", "over_limit", "n_within", *["prefix_tokens"] * store]
    kept = [c for c in docs.columns if c not in names and c != text]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name in kept)
    schema += ", n_bytes long, n_tokens long, over_limit boolean, n_within long" + ", prefix_tokens array<int>" * store

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path)
        for whole in batches:
            for i in range(0, whole.num_rows, BATCH_ROWS):
                batch = whole.slice(i, BATCH_ROWS)
                texts = batch.column(text).to_pylist()
                steps = count.steps(texts)
                within = [longest_prefix(s, limit) for s in steps]
                columns = [batch.column(c) for c in kept] + [pa.array([len((t or "").encode()) for t in texts], pa.int64()), pa.array([int(s[-1]) for s in steps], pa.int64())]
                columns += [pa.array([n < len(s) - 1 for n, s in zip(within, steps, strict=True)], pa.bool_()), pa.array(within, pa.int64())]
                if store:
                    columns.append(pa.array([count.table(t) for t in texts], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, [*kept, *names])

    return docs.select(*kept, text).mapInArrow(run, schema.removeprefix(", "))
