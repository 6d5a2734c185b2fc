"""Token ids of whole texts for a word-level BPE file, with the merges done for many words at once.

The ids are those that the ``tokenizers`` library gives for the file with add_special_tokens=False.
Texts repeat their words, so each task cuts its texts into units, hashes them, and finds the ids of
new units only.  A unit is a run of letters, a digit, or a run of other signs, between white space;
the merges of all new units run side by side in numpy: in each step every unit merges its leftmost
pair of lowest rank.  Units with anything but ASCII and Latin-1 letters, with an apostrophe
(contractions), ``<`` (special tokens) or control characters are stretches between white space
that go to the library itself.

Fits files whose normaliser is NFC, white space to a blank, lower case, whose split is letters,
single digits and other signs, and whose words end in ``</w>``.  Any other file is refused.
"""

from __future__ import annotations

import json

import numpy as np
from tokenizers import Tokenizer

from .words import _FACTOR, _RNG, mixed

_UNIT = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
NEVER = np.int64(2**62)
MOST_KNOWN = 1_500_000  # units kept between texts; beyond, the memory of a task starts anew

SPACE, LETTER, DIGIT, SIGN, ODD = range(5)
_CLASS = np.full(256, ODD, np.uint8)
_CLASS[[9, 10, 11, 12, 13, 32]] = SPACE
_CLASS[33:127] = SIGN
_CLASS[48:58] = DIGIT
_CLASS[65:91] = _CLASS[97:123] = LETTER
_CLASS[[ord("'"), ord("<")]] = ODD
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _byte_letters() -> list[str]:
    """The sign that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class WordBpe:
    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            said = json.load(f)
        model = said["model"]
        first = said["pre_tokenizer"]["pretokenizers"][0]
        kinds = [n["type"] for n in said["normalizer"]["normalizers"]]
        if kinds != ["NFC", "Replace", "Lowercase"] or first["pattern"] != {"Regex": SPLIT} or model["end_of_word_suffix"] != "</w>":
            raise ValueError(f"{path}: not a word-level BPE file of the kind read here")
        ids = model["vocab"]
        self.size = np.int64(max(ids.values()) + 1)
        signs = _byte_letters()
        self.inner = np.array([ids[s] for s in signs], np.int64)
        self.last = np.array([ids[s + "</w>"] for s in signs], np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        keys = np.array([ids[a] * int(self.size) + ids[b] for a, b in pairs], np.int64)
        made = np.array([ids[a + b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int64), made[order]
        self.forget()

    def forget(self) -> None:
        self.known = np.zeros(0, np.uint64)
        self.at = np.zeros(0, np.int64)
        self.length = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint16)

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each pair, NEVER where it doesn't merge, and what it makes."""
        key = left * self.size + right
        i = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = self.keys[i] == key
        return np.where(hit, self.ranks[i], NEVER), self.made[i]

    def merged(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids one after the other, how many for each unit) of units in lower-case bytes."""
        units = len(starts)
        place = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        whole = data[np.repeat(starts, lengths) + place]
        symbols = self.inner[whole]
        ends = np.cumsum(lengths) - 1
        symbols[ends] = self.last[whole[ends]]
        owner = np.repeat(np.arange(units), lengths)
        done_ids, done_owner = [], []
        rank = np.full(len(symbols), NEVER)  # of the pair that starts here
        made = np.zeros(len(symbols), np.int64)
        if len(symbols) > 1:
            rank[:-1], made[:-1] = self._pairs(symbols[:-1], symbols[1:])
            rank[:-1][owner[:-1] != owner[1:]] = NEVER
        while len(symbols):
            opens = np.flatnonzero(np.diff(owner, prepend=-1))
            counts = np.diff(opens, append=len(owner))
            least = np.minimum.reduceat(rank, opens)
            busy = np.repeat(least < NEVER, counts)
            done_ids.append(symbols[~busy])
            done_owner.append(owner[~busy])
            if not busy.any():
                break
            lowest = np.repeat(least, counts)[busy]
            symbols, owner, rank, made = symbols[busy], owner[busy], rank[busy], made[busy]
            hits = np.flatnonzero(rank == lowest)
            hits = hits[np.diff(owner[hits], prepend=-1) != 0]  # the leftmost of each unit
            symbols[hits] = made[hits]
            keep = np.ones(len(symbols), bool)
            keep[hits + 1] = False
            place = np.cumsum(keep) - 1
            symbols, owner, rank, made = symbols[keep], owner[keep], rank[keep], made[keep]
            for at in (place[hits], place[hits[place[hits] > 0]] - 1):
                at = at[at >= 0]
                inside = at[at + 1 < len(symbols)]
                r, m = self._pairs(symbols[inside], symbols[inside + 1])
                r[owner[inside] != owner[inside + 1]] = NEVER
                rank[at] = NEVER
                rank[inside], made[inside] = r, m
        ids, owner = np.concatenate(done_ids), np.concatenate(done_owner)
        order = np.argsort(owner, kind="stable")
        return ids[order].astype(np.uint16), np.bincount(owner, minlength=units)

    def _learn(self, new: np.ndarray, data: np.ndarray, lower: np.ndarray, starts, lengths, odd) -> None:
        plain = np.flatnonzero(~odd)
        ids, counts = self.merged(lower, starts[plain], lengths[plain])
        raw = [data[s:s + n].tobytes().decode("utf-8", "replace") for s, n in zip(starts[odd], lengths[odd])]
        said = [e.ids for e in self.library.encode_batch(raw, add_special_tokens=False)] if raw else []
        length = np.zeros(len(new), np.int64)
        length[plain] = counts
        length[odd] = [len(s) for s in said]
        at = np.zeros(len(new), np.int64)
        at[plain] = len(self.ids) + np.cumsum(counts) - counts
        more = np.array([i for s in said for i in s], np.uint16)
        at[odd] = len(self.ids) + len(ids) + np.cumsum(length[odd]) - length[odd]
        self.ids = np.concatenate([self.ids, ids, more])
        place = np.searchsorted(self.known, new)
        self.known = np.insert(self.known, place, new)
        self.at = np.insert(self.at, place, at)
        self.length = np.insert(self.length, place, length)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids one after the other, ids before each document and at the end) of documents that lie
        in ``data`` one after the other."""
        docs = len(offsets) - 1
        if not len(data):
            return np.zeros(0, np.uint16), np.zeros(docs + 1, np.int64)
        first = offsets[:-1][offsets[:-1] < len(data)]
        kind = _CLASS[data]
        lower = _LOWER[data]
        # Latin-1 letters are 0xC3 and a second byte; 0x97 and 0xB7 there are signs.
        two = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] < 0xC0) & (data[1:] != 0x97) & (data[1:] != 0xB7))
        kind[two] = kind[two + 1] = LETTER
        upper = two[data[two + 1] < 0x9F] + 1
        lower[upper] += 32
        inside = kind != SPACE
        opens = inside.copy()
        opens[1:] &= ~inside[:-1]
        opens[first] = inside[first]
        at = np.flatnonzero(inside)
        if not len(at):
            return np.zeros(0, np.uint16), np.zeros(docs + 1, np.int64)
        kind, opens = kind[at], opens[at]
        stretch = np.flatnonzero(opens)
        wide = np.diff(stretch, append=len(at))
        odd = np.repeat(np.maximum.reduceat(kind, stretch) == ODD, wide)
        begins = opens | (~odd & (kind == DIGIT))
        begins[1:] |= ~odd[1:] & (kind[1:] != kind[:-1])
        units = np.flatnonzero(begins)
        lengths = np.diff(units, append=len(at))
        starts = at[units]
        odd = odd[units]
        # Equal bytes are one unit; a stretch for the library is told apart and hashed as it is.
        said = np.where(np.repeat(odd, lengths), data[at], lower[at])
        powers = np.cumprod(np.full(int(lengths.max()), _FACTOR))
        place = np.arange(len(at)) - np.repeat(units, lengths)
        hashes = mixed(np.add.reduceat(_UNIT[said] * powers[place], units) + odd.astype(np.uint64))
        own, sample, which = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.known) > MOST_KNOWN:
            self.forget()
        i = np.minimum(np.searchsorted(self.known, own), max(0, len(self.known) - 1))
        new = np.flatnonzero(self.known[i] != own) if len(self.known) else np.arange(len(own))
        if len(new):
            s = sample[new]
            self._learn(own[new], data, lower, starts[s], lengths[s], odd[s])
            i = np.searchsorted(self.known, own)
        at_id, count = self.at[i][which], self.length[i][which]
        ends = np.cumsum(count)
        ids = self.ids[np.repeat(at_id - ends + count, count) + np.arange(int(ends[-1]))]
        before = np.concatenate([[0], ends])
        return ids, before[np.searchsorted(starts, offsets)]
