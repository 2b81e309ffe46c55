"""Exact token ids of whole texts, as the tokenizers library gives them.

The library encodes each distinct piece of the texts once; a text's ids are those of its pieces, one after the other.
A text is cut only where, whatever is around, one pre-token of the byte-level pattern ends and another begins: before a
single space or line feed between two characters that aren't white space, and before a full stop or comma that follows a
Latin letter or a digit. A text that can't be cut so, or that holds the string of an added token, goes to the library
whole.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Pieces that a worker keeps during a task, the longest of them, and pieces encoded in one call.
CACHE_PIECES, KEPT_LENGTH, CALL_PIECES = 500_000, 64, 500
#: Begins a piece that no space precedes. A key is a piece without its leading space, or with MARK in front if it has
#: none; a piece that begins with a line feed is its own key.
MARK = "\x01"


class ByteBpe:
    """ids(texts): for each text its token ids as little-endian uint16 bytes."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        if self.tokenizer.get_vocab_size(with_added_tokens=True) > 1 << 16:
            raise ValueError("ids need more than 16 bits")
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        #: Bytes of each id: a character of the byte-level alphabet is a byte.
        self.bytes_of = np.zeros(1 << 16, np.int64)
        for token, i in self.tokenizer.get_vocab(with_added_tokens=False).items():
            self.bytes_of[i] = len(token)
        self.known: dict[str, bytes] = {}
        self.long: list[str] = []

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u2").tobytes()

    def _encode(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces that may stand one after the other. Their tokens are told apart by their lengths."""
        out = []
        for i in range(0, len(pieces), CALL_PIECES):
            own = pieces[i : i + CALL_PIECES]
            raw = self._whole("".join(own))
            at = np.cumsum(self.bytes_of[np.frombuffer(raw, "<u2")])
            ends = np.cumsum([len(p.encode()) for p in own])
            cuts = np.searchsorted(at, ends)
            if len(at) and (at[np.minimum(cuts, len(at) - 1)] == ends).all() and cuts[-1] == len(at) - 1:
                cuts = (2 * cuts + 2).tolist()
                out += [raw[a:z] for a, z in zip([0, *cuts[:-1]], cuts, strict=True)]
            else:
                out += map(self._whole, own)
        return out

    def _learn(self, keys: list[str]) -> None:
        """Add the ids of new keys; those at whose edges a text must not be cut stay unknown."""
        plain, lines, rest = [], [], []
        for k in keys:
            (rest if k[:1] == MARK else lines if k[:1] == "\n" else plain).append(k)
        plain = [k for k, own in zip(plain, map(str.strip, plain), strict=True) if own is k and k]
        lines, rest = ([k for k in some if (own := k[1:]) and own.strip() is own] for some in (lines, rest))
        if len(self.known) > CACHE_PIECES:
            self.known.clear()
        self.known.update(zip(plain, self._encode([" " + k for k in plain]), strict=True))
        self.known.update(zip(lines, self._encode(lines), strict=True))
        self.known.update((k, self._whole(k[1:])) for k in rest)
        self.long = [k for k in (*plain, *lines, *rest) if len(k) > KEPT_LENGTH]

    def forget(self) -> None:
        """Drop the pieces, at the end of a task: a worker that goes on has other uses for the memory."""
        self.known = {}

    def _cut(self, texts: list[str]) -> list[bytes | None]:
        """Ids of texts without MARK and added tokens; None for those that can't be cut."""
        marked = pa.array([MARK + t for t in texts], pa.large_string())
        for c in (".", ","):
            marked = pc.replace_substring(marked, c, f" {MARK}{c}")
        cut = pc.split_pattern(pc.replace_substring(marked, "\n", " \n"), " ")
        ends = cut.offsets.to_numpy()
        coded = cut.values.slice(ends[0], ends[-1] - ends[0]).dictionary_encode()
        ends = ends - ends[0]
        code, keys = coded.indices.to_numpy(), coded.dictionary.to_pylist()
        found = list(map(self.known.get, keys))
        new = [i for i, own in enumerate(found) if own is None]
        self._learn([keys[i] for i in new])
        unknown = np.zeros(len(keys), bool)
        for i in new:
            found[i] = own = self.known.get(keys[i])
            unknown[i] = own is None
        # a marked stop must follow a Latin letter or a digit
        stop = pc.starts_with(coded.dictionary, MARK).to_numpy(zero_copy_only=False)
        last = pc.utf8_slice_codeunits(coded.dictionary, -1)
        letter = pc.and_(pc.utf8_is_alnum(last), pc.less(last, pa.scalar("\u0250", pa.large_string()))).to_numpy(zero_copy_only=False)
        bad = unknown[code]
        bad[1:] |= stop[code[1:]] & ~letter[code[:-1]]
        first = ends[:-1]
        bad[first] = unknown[code[first]]
        wrong = np.add.reduceat(bad.astype(np.int64), first) > 0
        ids = pa.array(found, pa.large_binary()).take(coded.indices)
        at, raw = np.frombuffer(ids.buffers()[1], np.int64)[: len(code) + 1][ends].tolist(), memoryview(ids.buffers()[2] or b"")
        return [None if w else bytes(raw[a:z]) for w, a, z in zip(wrong.tolist(), at, at[1:], strict=False)]

    def ids(self, texts: list[str | None]) -> list[bytes]:
        out: list[bytes] = [b""] * len(texts)
        simple = [i for i, t in enumerate(texts) if t and MARK not in t and not any(a in t for a in self.added)]
        found = dict(zip(simple, self._cut([texts[i] for i in simple]), strict=True)) if simple else {}
        for i, t in enumerate(texts):
            if t:
                # other white space than single spaces and line feeds, rows of stops, or an added token
                out[i] = self._whole(t) if (own := found.get(i)) is None else own
        for k in self.long:
            self.known.pop(k, None)
        self.long = []
        return out


_loaded: dict[str, ByteBpe] = {}


def byte_bpe(path: str) -> ByteBpe:
    """One for each Python worker."""
    if path not in _loaded:
        _loaded[path] = ByteBpe(path)
    return _loaded[path]
