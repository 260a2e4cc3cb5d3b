"""Cutting text where a public tokenizer always cuts too, to encode each distinct unit once.

Both tokenizers used here split text by a pattern of letters, digits, other signs and
white space before any merge. The cuts below are a subset of theirs: before a lone space
or around a lone line feed, and between a letter and an ASCII sign other than the
apostrophe, which may begin a contraction. Texts that hold rare white space or the string
of a special token are not cut at all.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable
from itertools import chain

import numpy as np

from certrisk.llm.common import same_bytes, text_hashes

OTHER, LETTER, SIGN, SPACE, FEED, WHITE = range(6)
ENCODE_ROWS = 5_000
#: Units that a byte-level tokenizer takes as one word.
_WORD = re.compile(" ?[A-Za-z]+")
_CLASS = np.full(256, OTHER, np.uint8)
_CLASS[[*range(65, 91), *range(97, 123)]] = LETTER
_CLASS[[*range(33, 39), *range(40, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = SIGN
_CLASS[32], _CLASS[10] = SPACE, FEED
_CLASS[[9, 11, 12, 13]] = WHITE


def _uncut(data: np.ndarray, starts: np.ndarray, special: bytes) -> np.ndarray:
    """Rows with white space outside ASCII or with the string of a special token."""
    a, b = data[:-1], data[1:]
    odd = ((a == 0xC2) & ((b == 0xA0) | (b == 0x85)) | (a == 0xE1) & (b == 0x9A)
           | (a == 0xE2) & ((b == 0x80) | (b == 0x81)) | (a == 0xE3) & (b == 0x80)
           | (a == special[0]) & (b == special[1]))
    rows = np.zeros(len(starts) - 1, bool)
    rows[np.searchsorted(starts, np.flatnonzero(odd), "right") - 1] = True
    return rows


def cut(data: np.ndarray, starts: np.ndarray, special: bytes = b"<|") -> tuple[np.ndarray, np.ndarray]:
    """Where units start, and the row of each unit. Units cover every byte of every row."""
    n = len(data)
    cuts = np.zeros(n + 1, bool)
    if n > 1:
        kind = _CLASS[data]
        # Letters of the Latin-1 block take two bytes, the first of which is C3.
        pair = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7))
        kind[pair] = LETTER
        kind[pair + 1] = LETTER
        left, right = kind[:-1], kind[1:]
        cuts[1:n] = (left == LETTER) & (right == SIGN) | (left == SIGN) & (right == LETTER)
        solid = kind < SPACE
        between = solid[:-2] & solid[2:] & (kind[1:-1] >= SPACE)
        # Neighbours are of the same row; else cuts would depend on the rows nearby.
        inner = starts[(starts > 0) & (starts < n)]
        between[inner[inner < n - 1] - 1] = False
        between[inner[inner > 1] - 2] = False
        lone = np.flatnonzero(between) + 1
        cuts[lone[kind[lone] == SPACE]] = True
        feed = lone[kind[lone] == FEED]
        cuts[feed] = True
        cuts[feed + 1] = True
        rows = _uncut(data, starts, special)
        if rows.any():
            cuts[:n] &= ~np.repeat(rows, np.diff(starts))
    cuts[starts[:-1]] = True
    cuts[n] = False
    at = np.flatnonzero(cuts)
    return at, np.searchsorted(starts, at, "right") - 1


class _Known:
    """Units in order of their hashes: their bytes, their ids, and whether they were met again."""

    def __init__(self):
        self.keys = np.zeros(0, np.uint64)
        self.at = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.uint32)
        self.ids_at = np.zeros(0, np.int64)
        self.n_ids = np.zeros(0, np.uint32)
        self.again = np.zeros(0, bool)
        self.raw = np.zeros(0, np.uint8)
        self.ids = np.zeros(0, np.uint32)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of each key, and whether it is there."""
        place = np.minimum(np.searchsorted(self.keys, keys), max(0, len(self.keys) - 1))
        return place, self.keys[place] == keys if len(self.keys) else np.zeros(len(keys), bool)

    def with_more(self, other: _Known, kept: np.ndarray | None = None) -> _Known:
        """Both together; of these units, only the ``kept``."""
        out = _Known()
        kept = np.ones(len(self.keys), bool) if kept is None else kept
        order = np.argsort(np.concatenate([self.keys[kept], other.keys]), kind="stable")
        parts = ((self, kept), (other, slice(None)))
        out.keys = np.concatenate([t.keys[m] for t, m in parts])[order]
        out.again = np.concatenate([t.again[m] for t, m in parts])[order]
        for flat, at, size in (("raw", "at", "size"), ("ids", "ids_at", "n_ids")):
            sizes = [getattr(t, size)[m] for t, m in parts]
            setattr(out, flat, np.concatenate([gathered(getattr(t, flat), getattr(t, at)[m], n) for (t, m), n in zip(parts, sizes)]))
            both = np.concatenate(sizes)
            setattr(out, size, both[order])
            setattr(out, at, (np.cumsum(both, dtype=np.int64) - both)[order])
        return out


def gathered(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The runs of ``flat`` one after another."""
    sizes = sizes.astype(np.int64)
    before = np.cumsum(sizes) - sizes
    return flat[np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))]


class UnitTable:
    """Ids of the units seen so far, found by hash and compared by bytes; bounded.

    New units go to a small table first, which is added to the large one when it has a sixteenth of its size; a full table forgets
    the units that it met once.
    """

    def __init__(
        self, encode: Callable[[list[str]], list[list[int]]], word: Callable[[str], list[int]] | None = None,
        most: int = 400_000, recent: int = 8_000,
    ):
        self.encode, self.word, self.most, self.few = encode, word, most, recent
        self.known, self.recent = _Known(), _Known()

    def _ids(self, raw: bytes, at: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the units at these places, one after another, and their numbers."""
        units = [raw[a:b].decode("utf-8", "replace") for a, b in zip(at.tolist(), ends.tolist())]
        found: list[list[int]] = [[]] * len(units)
        rest = list(range(len(units)))
        if self.word is not None:
            rest = []
            for k, u in enumerate(units):
                if _WORD.fullmatch(u):
                    found[k] = self.word(u)
                else:
                    rest.append(k)
        for k in range(0, len(rest), ENCODE_ROWS):  # a tokenizer's results are large objects
            for place, ids in zip(rest[k:k + ENCODE_ROWS], self.encode([units[i] for i in rest[k:k + ENCODE_ROWS]])):
                found[place] = ids
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.uint32, int(sizes.sum())), sizes

    def _add(self, keys: np.ndarray, data: np.ndarray, at: np.ndarray, ends: np.ndarray) -> None:
        """Encode units and keep them; ``keys`` ascend."""
        new = _Known()
        new.keys, new.at, new.size, new.again = keys, at, (ends - at).astype(np.uint32), np.zeros(len(keys), bool)
        new.raw = data
        new.ids, sizes = self._ids(data.tobytes(), at, ends)
        new.ids_at, new.n_ids = np.cumsum(sizes) - sizes, sizes.astype(np.uint32)
        self.recent = self.recent.with_more(new)
        if len(self.recent.keys) > max(self.few, len(self.known.keys) // 16):
            if len(self.known.keys) + len(self.recent.keys) > self.most:
                kept = self.known.again
                self.known.again = np.zeros(len(kept), bool)
                self.known = self.known.with_more(self.recent, kept if 2 * kept.sum() < self.most else np.zeros(len(kept), bool))
            else:
                self.known = self.known.with_more(self.recent)
            self.recent = _Known()

    def encode_rows(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows together, and where those of each row start."""
        at, row = cut(data, starts)
        ends = np.append(at[1:], len(data))
        hashes = text_hashes(data, at, ends)
        distinct, first, back = np.unique(hashes, return_index=True, return_inverse=True)
        sizes = ends - at
        alike = sizes == sizes[first][back]
        alike &= same_bytes(data, at, data, at[first][back], np.where(alike, sizes, 0))
        ids, ids_at, n_ids = [], np.zeros(len(distinct), np.int64), np.zeros(len(distinct), np.int64)
        total, open_ = 0, np.ones(len(distinct), bool)
        for table in (self.known, self.recent):
            place, there = table.find(distinct)
            there &= open_
            k, p = np.flatnonzero(there), place[there]
            right = table.size[p] == sizes[first[k]]
            right &= same_bytes(table.raw, table.at[p], data, at[first[k]], np.where(right, table.size[p], 0).astype(np.int64))
            alike &= ~np.isin(back, k[~right]) if not right.all() else True
            table.again[p] = True
            n_ids[k] = table.n_ids[p]
            found = gathered(table.ids, table.ids_at[p], table.n_ids[p])
            ids_at[k] = total + np.cumsum(n_ids[k]) - n_ids[k]
            ids.append(found)
            total += len(found)
            open_[k] = False
        new = np.flatnonzero(open_)
        if len(new):
            own = at[first[new]], ends[first[new]]
            self._add(distinct[new], data, *own)
            place, there = self.recent.find(distinct[new])
            table = self.recent
            if not there.all():  # just moved to the large table
                table = self.known
                place, _ = table.find(distinct[new])
            n_ids[new] = table.n_ids[place]
            ids_at[new] = total + np.cumsum(n_ids[new]) - n_ids[new]
            ids.append(gathered(table.ids, table.ids_at[place], table.n_ids[place]))
            total += len(ids[-1])
        n, places = n_ids[back], ids_at[back]
        if not alike.all():  # two units share a hash: these are encoded where they stand
            odd = np.flatnonzero(~alike)
            found, sizes = self._ids(data.tobytes(), at[odd], ends[odd])
            n[odd], places[odd] = sizes, total + np.cumsum(sizes) - sizes
            ids.append(found)
        per_row = np.bincount(row, n, len(starts) - 1).astype(np.int64)
        return gathered(np.concatenate(ids), places, n), np.concatenate([[0], np.cumsum(per_row)])


_tokenizers: dict[str, object] = {}
_tables: dict[str, UnitTable] = {}


def _tokenizer(path: str):
    if path not in _tokenizers:
        # Tasks run side by side already; threads of its own would each keep memory.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        _tokenizers[path] = tokenizer
    return _tokenizers[path]


def encoder(path: str) -> Callable[[list[str]], list[list[int]]]:
    """Texts to ids by a tokenizer file, kept by the Python worker for its next tasks."""
    tokenizer = _tokenizer(path)
    return lambda texts: [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


def word_encoder(path: str) -> Callable[[str], list[int]] | None:
    """Ids of a word of ASCII letters, maybe behind a space, by the tokenizer's merges alone; None where the file
    does more to a text than to split it in the byte-level way."""
    with open(path, encoding="utf-8") as file:
        steps = json.load(file)
    split = steps.get("pre_tokenizer") or {}
    if (steps.get("normalizer") is not None or split.get("type") != "ByteLevel" or split.get("add_prefix_space")
            or not split.get("use_regex", True) or steps["model"]["type"] != "BPE"):
        return None
    pieces = _tokenizer(path).model.tokenize
    return lambda word: [t.id for t in pieces(word.replace(" ", "\u0120"))]  # the byte-level form of a space


def tokenizer_table(path: str) -> UnitTable:
    if path not in _tables:
        _tables[path] = UnitTable(encoder(path), word_encoder(path))
    return _tables[path]
