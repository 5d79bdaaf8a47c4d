"""Exact tokenisation of Arrow text columns with the public tokenizer files.

A text is cut before every run of ASCII white space that follows a character which is not white space. No pre-tokenisation
pattern of the supported vocabularies matches across such a cut, no normaliser composes across it, and special strings
hold no white space; so each piece between cuts (a *unit*) has the same ids alone as in its text. Units repeat a lot, so
a worker keeps the ids of those it has met, and a batch costs one library call for its new units only.
"""

from __future__ import annotations

import base64
import json
import os
import re

import numpy as np
import pyarrow as pa

from waymark.llm.arrowtext import IS_SPACE, LOWER, distinct_spans, flat, ragged

#: Units kept by a worker; past it those met least often go, which changes no result.
KEPT_UNITS = 500_000
KEPT_IDS = 8_000_000
#: New units that are encoded at a time: the arrays of their merges are as large as the list is long.
LEARNT = 20_000
#: Text of which both byte-level libraries are known to see the same letters, numbers and white space.
LATIN = re.compile("[\x00-\x7f\u00c0-\u024f]*")


LETTER = np.zeros(256, bool)
LETTER[[*range(65, 91), *range(97, 123)]] = True


def cuts(data: np.ndarray, offsets: np.ndarray, marks: bool = False) -> np.ndarray:
    """Positions at which units start: document starts and the provably stable cuts.

    marks: also cut between an ASCII letter and a full stop or comma, where a word vocabulary's letter runs end.
    """
    n = len(data)
    if not n:
        return np.empty(0, np.int64)
    here = IS_SPACE[data]
    stable = here.copy()
    stable[0] = False
    stable[1:] &= ~here[:-1] & ~((data[:-1] >= 0x1C) & (data[:-1] <= 0x1F))
    at = np.flatnonzero(stable)
    last, second = data[at - 1], data[np.maximum(at - 2, 0)]
    # The bytes before may end a Unicode space: U+0085, U+00A0, U+1680, U+2000-200A, 2028, 2029, 202F, 205F, 3000.
    wide = ((second == 0xC2) & ((last == 0x85) | (last == 0xA0))) | (((second >= 0x80) & (second <= 0x81) | (second == 0x9A)) & (last >= 0x80))
    first = np.zeros(n, bool)
    first[at[~wide]] = True
    if marks:
        stop = np.flatnonzero((data[1:] == 0x2E) | (data[1:] == 0x2C))
        first[stop[LETTER[data[stop]]] + 1] = True
    first[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
    return np.flatnonzero(first)


def byte_letters() -> dict[int, str]:
    """The characters that stand for bytes in byte-level vocabularies (a published format, fixed)."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class Merges:
    """Byte-pair merging of many words at once, for word vocabularies whose last symbol carries an end mark.

    Takes units of ASCII without apostrophes and of the letters U+00C0-U+00FF: for them the normaliser only lowers case
    and every word is a run of letters, a digit or a run of other signs. Each round merges the pair of least rank of
    every word wherever it stands, which is the library's order, since a merged symbol's pairs have higher ranks.
    """

    NONE = np.int32(1 << 30)
    BITS = 19

    def __init__(self, vocab: dict[str, int], merges: list, end: str):
        letters = byte_letters()
        self.inner = np.array([vocab.get(letters[b], -1) for b in range(256)], np.int64)
        self.last = np.array([vocab.get(letters[b] + end, -1) for b in range(256)], np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        key = np.array([vocab[a] << 16 | vocab[b] for a, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int32)
        self.keys = np.full(1 << self.BITS, -1, np.int64)
        self.rank, self.made = np.full(1 << self.BITS, self.NONE), np.zeros(1 << self.BITS, np.int32)
        left, at = np.arange(len(key)), self.place(key)
        while len(left):
            free = self.keys[at] < 0
            at_free, who = np.unique(at[free], return_index=True)
            chosen = np.flatnonzero(free)[who]
            self.keys[at_free], self.rank[at_free], self.made[at_free] = key[left[chosen]], left[chosen], made[left[chosen]]
            stay = np.ones(len(left), bool)
            stay[chosen] = False
            left, at = left[stay], (at[stay] + 1) & ((1 << self.BITS) - 1)
        table = np.zeros(256, np.uint8)  # 0: not taken, 1: white space, 2: letter, 3: digit, 4: other
        table[33:127] = 4
        table[48:58] = 3
        table[[*range(65, 91), *range(97, 123)]] = 2
        table[IS_SPACE] = 1
        table[ord("'")] = 0
        self.kind = table

    def place(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.BITS)).astype(np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and result of each pair; NONE if it is no merge."""
        key = left << 16 | right
        at = self.place(key)
        found = self.keys[at]
        rank, made = np.where(found == key, self.rank[at], self.NONE), self.made[at]
        again = np.flatnonzero((found != key) & (found >= 0))
        while len(again):
            at[again] = (at[again] + 1) & ((1 << self.BITS) - 1)
            found = self.keys[at[again]]
            hit = again[found == key[again]]
            rank[hit], made[hit] = self.rank[at[hit]], self.made[at[hit]]
            again = again[(found != key[again]) & (found >= 0)]
        return rank, made

    def lowered(self, data: np.ndarray) -> np.ndarray:
        """ASCII letters in lower case, where neither a combining mark nor a special string can be concerned."""
        if not len(data) or np.any((data[:-1] == 0x3C) & (data[1:] == 0x7C)):
            return data
        after = np.append(data[1:], np.uint8(0))
        return np.where((after < 0x80) | (after == 0xC3), LOWER[data], data)

    def simple(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which units can be taken, and the kind of each byte."""
        kind = self.kind[data]
        lead = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0xBF) & (data[1:] != 0x97) & (data[1:] != 0xB7))
        kind[lead] = kind[lead + 1] = 2
        return np.minimum.reduceat(kind, bounds[:-1]) > 0, kind

    def encode(self, data: np.ndarray, bounds: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sizes, ids and character offsets of the units between bounds."""
        unit = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        char = np.cumsum((data & 0xC0) != 0x80) - 1
        char -= char[bounds[:-1]][unit]
        low = np.where((data >= 65) & (data <= 90), data + 32, data)
        upper = np.flatnonzero((data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[:-1] == 0xC3)) + 1
        low[upper] += 0x20
        keep = np.flatnonzero(kind > 1)
        low, kind, unit, char = low[keep], kind[keep], unit[keep], char[keep]
        n = len(keep)
        if not n:
            return np.zeros(len(bounds) - 1, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
        start = np.ones(n, bool)
        start[1:] = (np.diff(keep) > 1) | (kind[1:] != kind[:-1]) | (kind[1:] == 3) | (unit[1:] != unit[:-1])
        final = np.append(start[1:], True)
        symbol = np.where(final, self.last[low], self.inner[low])
        word = np.cumsum(start) - 1
        out = np.empty(n, np.int64)
        where = np.arange(n)
        alive = np.ones(n, bool)
        out[:] = symbol
        rank, made = self.ranks(symbol[:-1], symbol[1:])
        rank = np.append(np.where(final[:-1], self.NONE, rank), self.NONE)
        made = np.append(made, 0)
        while len(word):
            head = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            least = np.minimum.reduceat(rank, head)
            size = np.diff(np.append(head, len(word)))
            go = np.repeat(least < self.NONE, size)
            if not go.all():
                out[where] = symbol
                symbol, rank, made, word, where = symbol[go], rank[go], made[go], word[go], where[go]
                least, size = least[least < self.NONE], size[least < self.NONE]
                if not len(word):
                    break
            hit = rank == np.repeat(least, size)
            near = np.flatnonzero(hit[1:] & hit[:-1]) + 1
            if len(near):  # a a a: the pairs share a symbol; every other one of a run counts
                spots = np.flatnonzero(hit)
                run = np.cumsum(np.append(True, np.diff(spots) > 1)) - 1
                first = np.flatnonzero(np.append(True, np.diff(run) > 0))
                hit[spots[(np.arange(len(spots)) - first[run]) % 2 == 1]] = False
            spots = np.flatnonzero(hit)
            symbol[spots] = made[spots]
            stay = np.ones(len(word), bool)
            stay[spots + 1] = False
            alive[where[spots + 1]] = False
            new = (np.cumsum(stay) - 1)[spots]
            symbol, rank, made, word, where = symbol[stay], rank[stay], made[stay], word[stay], where[stay]
            touched = np.zeros(len(word), bool)
            touched[new] = touched[np.maximum(new - 1, 0)] = True
            redo = np.flatnonzero(touched)
            ahead = redo + 1 < len(word)
            fresh, result = self.ranks(symbol[redo], symbol[np.minimum(redo + 1, len(word) - 1)])
            inside = ahead & (word[redo] == word[np.minimum(redo + 1, len(word) - 1)])
            rank[redo], made[redo] = np.where(inside, fresh, self.NONE), result
        return np.bincount(unit[alive], minlength=len(bounds) - 1), out[alive], char[alive]


class Encoder:
    """ids of whole texts as tokenizers' encode(text, add_special_tokens=False) gives them.

    path: a tokenizers file. ranks: a tiktoken file of the same byte-level vocabulary and pattern its split pattern; if
    given, units of plain Latin text without special strings go through that faster library, all others through tokenizers.
    """

    def __init__(self, path: str, ranks: str = "", pattern: str = ""):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.fast = None
        if ranks:
            import tiktoken

            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(ranks, "rb"))}
            self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})
            self.token_bytes = np.zeros(max(table.values()) + 1, np.int64)
            for token, rank in table.items():
                self.token_bytes[rank] = len(token)
        model = json.loads(self.tokenizer.to_str())
        self.merges = None
        if model["normalizer"] and model["model"].get("end_of_word_suffix"):
            self.merges = Merges(model["model"]["vocab"], model["model"]["merges"], model["model"]["end_of_word_suffix"])
        self.clear()

    def clear(self) -> None:
        self.slots: dict[bytes, int] = {}
        self.first, self.size, self.hits = (np.zeros(1 << 16, np.int64) for _ in range(3))
        self.ids, self.at, self.used = np.zeros(1 << 18, np.int32), np.zeros(1 << 18, np.int32), 0

    def keep_frequent(self) -> None:
        """Keep the units met most often, at most half the table, and count the others anew."""
        n = len(self.slots)
        hits = self.hits[:n]
        least = max(2, int(np.partition(hits, n // 2)[n // 2]) + 1)
        names = [(u, s) for u, s in self.slots.items() if hits[s] >= least]
        old = np.fromiter((s for _, s in names), np.int64, len(names))
        first, size, hits, ids, at = self.first[old], self.size[old], hits[old] // 2, self.ids, self.at
        take = ragged(first, size)
        self.clear()
        self.slots = {u: i for i, (u, _) in enumerate(names)}
        self.room(len(names), len(take))
        self.first[: len(old)], self.size[: len(old)], self.hits[: len(old)] = np.cumsum(size) - size, size, hits
        self.ids[: len(take)], self.at[: len(take)], self.used = ids[take], at[take], len(take)

    def room(self, units: int, ids: int) -> None:
        while len(self.first) < units:
            self.first, self.size, self.hits = (np.concatenate([x, np.zeros_like(x)]) for x in (self.first, self.size, self.hits))
        while len(self.ids) < ids:
            self.ids, self.at = np.concatenate([self.ids, self.ids]), np.concatenate([self.at, self.at])

    def _fast(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sizes, ids and byte offsets of units that start with white space: one call, cut at the units' byte lengths."""
        ids = self.fast.encode_to_numpy(b"".join(units).decode("utf-8")).astype(np.int64)
        start = np.cumsum(self.token_bytes[ids]) - self.token_bytes[ids]
        lead = np.append(0, np.cumsum(np.fromiter(map(len, units), np.int64, len(units))))
        of = np.searchsorted(lead, start, side="right") - 1
        return np.bincount(of, minlength=len(units)), ids, start - lead[of]

    def _single(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        got = self.tokenizer.encode_batch(texts, add_special_tokens=False)
        size = np.fromiter(map(len, got), np.int64, len(got))
        ids = np.fromiter((i for e in got for i in e.ids), np.int64, int(size.sum()))
        start = np.fromiter((min(a, len(t)) for e, t in zip(got, texts) for a, _ in e.offsets), np.int64, len(ids))
        return size, ids, start

    def learn(self, units: list[bytes]) -> None:
        """Encode new units and add them to the table, with the character at which each token starts."""
        if self.merges is not None:
            data = np.frombuffer(b"".join(units), np.uint8)
            bounds = np.append(0, np.cumsum(np.fromiter(map(len, units), np.int64, len(units))))
            quick, kind = self.merges.simple(data, bounds)
            bar = np.flatnonzero((data[:-1] == 0x3C) & (data[1:] == 0x7C))
            quick[np.searchsorted(bounds, bar, side="right") - 1] = False
            where = np.flatnonzero(quick)
            size = np.diff(bounds)[where]
            take = ragged(bounds[where], size)
            self.add([units[i] for i in where], *self.merges.encode(data[take], np.append(0, np.cumsum(size)), kind[take]))
            units = [units[i] for i in np.flatnonzero(~quick)]
        texts = [u.decode("utf-8") for u in units]
        if self.fast is not None:
            quick = [IS_SPACE[u[0]] and LATIN.fullmatch(t) is not None and "<|" not in t for u, t in zip(units, texts)]
            if mine := [u for u, q in zip(units, quick) if q]:
                self.add(mine, *self._fast(mine))
            units, texts = [u for u, q in zip(units, quick) if not q], [t for t, q in zip(texts, quick) if not q]
        if units:
            self.add(units, *self._single(texts))

    def add(self, units: list[bytes], size: np.ndarray, ids: np.ndarray, start: np.ndarray) -> None:
        old, new = len(self.slots), len(self.slots) + len(units)
        self.room(new, self.used + len(ids))
        self.first[old:new], self.size[old:new], self.hits[old:new] = self.used + np.cumsum(size) - size, size, 0
        self.ids[self.used : self.used + len(ids)], self.at[self.used : self.used + len(ids)] = ids, start
        self.used += len(ids)
        self.slots.update(zip(units, range(old, new)))

    def units(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts of the batch's units (with the end of the data) and their slots in the table."""
        if self.merges is not None:
            data = self.merges.lowered(data)
        starts = cuts(data, offsets, self.merges is not None)
        bounds = np.append(starts, len(data))
        if not len(starts):
            return bounds, np.empty(0, np.int64)
        index, forms = distinct_spans(data, bounds)
        if self.slots and (len(self.slots) + len(forms) > KEPT_UNITS or self.used > KEPT_IDS):
            self.keep_frequent()
        met = self.slots.get
        of = np.array([met(u, -1) for u in forms], np.int64)
        if len(new := np.flatnonzero(of < 0)):
            units = [forms[i] for i in new]
            for at in range(0, len(units), LEARNT):
                self.learn(units[at : at + LEARNT])
            of[new] = [self.slots[u] for u in units]
        self.hits[of] += np.bincount(index, minlength=len(forms))
        return bounds, of[index]

    def counts(self, texts: pa.Array) -> np.ndarray:
        """Number of tokens of each text."""
        data, offsets = flat(texts)
        bounds, slots = self.units(data, offsets)
        total = np.append(0, np.cumsum(self.size[slots]))
        return np.diff(total[np.searchsorted(bounds[:-1], offsets)])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of all texts and their n + 1 offsets."""
        data, offsets = flat(texts)
        bounds, slots = self.units(data, offsets)
        lengths = self.size[slots]
        ids = self.ids[ragged(self.first[slots], lengths)]
        total = np.append(0, np.cumsum(lengths))
        return ids, total[np.searchsorted(bounds[:-1], offsets)]

    def spans(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """ids of one text, the character at which each token starts, and the characters at which units start."""
        raw = text.encode("utf-8")
        data, offsets = np.frombuffer(raw, np.uint8), np.array([0, len(raw)])
        bounds, slots = self.units(data, offsets)
        lead = np.append(0, np.cumsum((data & 0xC0) != 0x80))
        chars = lead[bounds[:-1]]
        lengths = self.size[slots]
        take = ragged(self.first[slots], lengths)
        return self.ids[take], self.at[take] + np.repeat(chars, lengths), chars


_KEPT: dict[tuple[str, str], Encoder] = {}


def encoder(path: str, ranks: str = "", pattern: str = "") -> Encoder:
    """The worker's encoder of a vocabulary file."""
    if (path, ranks) not in _KEPT:
        _KEPT[path, ranks] = Encoder(path, ranks, pattern)
    return _KEPT[path, ranks]
