"""SentencePiece segmentations sampled without replacement: Gumbel top-k by A* over the lattice.

A text's lattice has an edge for every vocabulary piece at every place.  A piece weighs
-(log(2 + its rank)) * SHARPNESS, a Zipf law over the file's own order of pieces, and a path's
probability is the product of its edges', normalised over all paths (backward log sums).

The k samples of a text are the k paths with the largest Gumbel-perturbed log probabilities.  They
are found best first, without making other paths: the search holds disjoint sets of paths, each with
the maximum of its Gumbels as its exact priority.  A set is "agree with this path up to a piece, and
differ there".  Taking the largest set draws its best path from the edge probabilities; what is left
of it falls into such sets along the new path, whose maxima are Gumbels of the sets' probabilities,
cut off at the maximum of the set they came from.  So samples are distinct, come in falling order of
their perturbed scores, and the largest priority left after the last one is the threshold kappa of
the inclusion score log P(included) = log(1 - exp(-exp(log p - kappa))).

No piece crosses a break before a blank or beside a sign outside the vocabulary, so a lattice is a
chain of units, and equal units share one; a worker keeps the lattices of the units it has met, up to
KEPT nodes of them and then those met most often, from batch to batch.  Lattices, log sums, samples and priorities of all texts of a
batch are computed side by side in numpy.  All random numbers are hashes of (seed,
row key, sample, place): a row's samples do not depend on its neighbours, its partition or a retry.

Encoding loses nothing: blanks become the piece sign, signs outside the vocabulary (and a literal
piece sign) become byte pieces, and ``decode`` gives the exact text.

Defined cases: null and empty texts have one segmentation, of no piece, with log probability 0; a
text with fewer than k segmentations gives them all, and log_inclusion 0 where none is left out.
Rows with equal key and text get equal samples, each.  Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import table
from .words import _FACTOR, mixed

MODEL = "piece_bpe_32k.model"
SAMPLES = 3
SHARPNESS = 1.0
SEED = 20240501
BLANK = 0x2581
STRANGE = 0x110000  # stands for a literal piece sign
CHUNK = 1 << 18  # characters whose lattices are made at once; a longer text is a chunk of its own
KEPT = 1 << 21  # nodes of lattices that are kept for the next chunk
BLOCK = 64  # pieces of each path whose sets are looked at together; twice as many each time
REACH = 38.0  # a Gumbel of a 53-bit uniform is less than log(2^53), 36.8, above its location
_INVERSE = np.uint64(pow(int(_FACTOR), -1, 2**64))

_OPEN: dict = {}


def model_path(name: str = MODEL) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Pieces:
    """The vocabulary: piece ids and weights by hash, per length in characters."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        said = [model.id_to_piece(i) for i in range(size)]
        self.bytes = np.zeros(256, np.int64)
        parts: list[bytes] = [b""] * size
        by_length: dict[int, list[tuple[np.ndarray, int]]] = {}
        plain = 0
        self.weight = np.full(size, -np.inf)
        for i, piece in enumerate(said):
            if model.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
                parts[i] = bytes([int(piece[3:5], 16)])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                if "▁" in piece.lstrip("▁"):
                    raise ValueError(f"{path}: piece {piece!r} goes on after a blank")
                codes = np.array([ord(c) for c in piece], np.uint64)
                by_length.setdefault(len(codes), []).append((codes, i))
                parts[i] = piece.replace("▁", " ").encode()
                rank = -model.get_score(i)
                self.weight[i] = -SHARPNESS * np.log(2 + (rank if rank < 1e8 else size))
                plain += 1
        self.byte_weight = -SHARPNESS * float(np.log(2 + size))
        self.known = np.zeros(0x110001, bool)
        for codes, _ in by_length.get(1, []):
            self.known[int(codes[0])] = True
        if any(not self.known[c.astype(np.int64)].all() for rows in by_length.values() for c, _ in rows):
            raise ValueError(f"{path}: a piece has a sign that is no piece itself")
        self.table = {}
        for length, rows in by_length.items():
            codes = np.array([c for c, _ in rows])
            powers = np.cumprod(np.full(length, _FACTOR))
            hashes = (mixed(codes) * powers).sum(axis=1)
            order = np.argsort(hashes)
            # Most substrings are no piece, and no piece begins with most of them: a byte per hash
            # prefix tells so with one look (1: may be a piece, 2: a piece may go on).
            maybe = np.zeros(1 << 18, np.uint8)
            maybe[_slot(hashes)] = 1
            # Hashes with one prefix lie together: the first of them, and how many they are at most.
            where = np.zeros(1 << 18, np.int32)
            where[_slot(hashes[order[::-1]])] = np.arange(len(order))[::-1]
            most = int(np.bincount(_slot(hashes)).max())
            self.table[length] = hashes[order], np.array([i for _, i in rows])[order], maybe, where, most
        for length in range(1, max(self.table, default=0)):
            if length not in self.table:
                self.table[length] = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(1 << 18, np.uint8), None, 0
            longer = [c[:length] for n, rows in by_length.items() if n > length for c, _ in rows]
            powers = np.cumprod(np.full(length, _FACTOR))
            self.table[length][2][_slot((mixed(np.array(longer)) * powers).sum(axis=1))] |= 2
        self.kept = _Lattices(self)
        self.parts = pa.array(parts, pa.large_binary())

    def decoded(self, ids: np.ndarray) -> bytes:
        return self.decoded_all([ids])[0]

    def decoded_all(self, rows: list[np.ndarray]) -> list[bytes]:
        """The text of each row of ids, without the blank in front."""
        if not sum(map(len, rows)):
            return [b""] * len(rows)
        _, offsets, data = self.parts.take(pa.array(np.concatenate(rows))).buffers()
        cuts = np.cumsum([0, *map(len, rows)])
        ends = np.frombuffer(offsets, np.int64)[cuts].tolist()
        data = memoryview(data)
        return [data[a + 1:b].tobytes() if b > a else b"" for a, b in zip(ends, ends[1:])]


def _slot(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(46)).astype(np.int64)


def pieces_of(path: str) -> Pieces:
    if path not in _OPEN:
        _OPEN[path] = Pieces(path)
    return _OPEN[path]


class _Grown:
    """An array that grows at its end; what ``all`` gave before stays as it was."""

    def __init__(self, kind: type):
        self.room, self.n = np.empty(1 << 21, kind), 0  # memory that is not written to is not taken

    def add(self, values: np.ndarray) -> None:
        stop = self.n + len(values)
        if stop > len(self.room):
            room = np.empty(max(stop, 2 * len(self.room)), self.room.dtype)
            room[:self.n] = self.all()
            self.room = room
        self.room[self.n:stop] = values
        self.n = stop

    def all(self) -> np.ndarray:
        return self.room[:self.n]


def ranges(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """first[i], first[i] + 1, ... of each of the ranges, one after the other."""
    return np.repeat(first - (np.cumsum(size) - size), size) + np.arange(size.sum())


class _Lattices:
    """Lattices of units, found again by the hash of their characters."""

    # first edge of each node (and their number), first node of each unit, and of each edge its
    # characters, piece, log probability (0 if its node has no other) and running sum.
    KINDS = {"first": np.int64, "node0": np.int64, "width": np.int16, "ids": np.int32, "logp": np.float64, "upto": np.float64}
    EDGES = ("width", "ids", "logp", "upto")

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self.hashes, self.numbers = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.used = np.zeros(0, np.int32)  # chunks that held a unit, in the order of the hashes
        self.grown = {c: _Grown(kind) for c, kind in self.KINDS.items()}
        self.grown["first"].add(np.zeros(1, np.int64))

    def cut(self, most: int) -> _Lattices:
        """The lattices of the units met most often, with ``most`` nodes at most."""
        old = {c: grown.all() for c, grown in self.grown.items()}
        nodes = np.diff(old["node0"], append=len(old["first"]) - 1)[self.numbers]
        order = np.argsort(-self.used, kind="stable")
        kept = np.sort(order[np.cumsum(nodes[order]) <= most])
        out, number, nodes = _Lattices(self.pieces), self.numbers[kept], nodes[kept]
        node0 = old["node0"][number]
        low, high = old["first"][node0], old["first"][node0 + nodes]
        edges, own = ranges(low, high - low), ranges(node0, nodes)
        out.hashes, out.numbers, out.used = self.hashes[kept], np.arange(len(kept)), self.used[kept] // 2
        moved = np.cumsum(nodes) - nodes
        out.grown["node0"].add(moved)
        out.grown["first"].add(np.cumsum(np.diff(old["first"])[own]))
        for c in self.EDGES:
            out.grown[c].add(old[c][edges])
        return out

    def numbers_of(self, hashes: np.ndarray, codes: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Number of each of some different units, after lattices of the new ones are made."""
        at = np.searchsorted(self.hashes, hashes)
        new = np.ones(len(hashes), bool)
        inside = at < len(self.hashes)
        new[inside] = self.hashes[at[inside]] != hashes[inside]
        if new.any():
            count = self.grown["node0"].n
            self._made(codes, starts[new], lengths[new])
            self.hashes = np.insert(self.hashes, at[new], hashes[new])
            self.numbers = np.insert(self.numbers, at[new], np.arange(count, self.grown["node0"].n))
            self.used = np.insert(self.used, at[new], 0)
            at = np.searchsorted(self.hashes, hashes)
        self.used[at] += 1
        return self.numbers[at]

    def _made(self, codes: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> None:
        made = _Lattice(self.pieces, codes, starts, lengths)
        nodes, edges = self.grown["first"].n - 1, self.grown["ids"].n
        self.grown["first"].add(made.first[1:] + edges)
        self.grown["node0"].add(made.node0 + nodes)
        for c in self.EDGES:
            self.grown[c].add(getattr(made, c))


class _Chunk:
    """Lattices of some texts: ``codes`` are their characters, with a blank in front of each."""

    def __init__(self, pieces: Pieces, codes: np.ndarray, starts: np.ndarray):
        n = len(codes)
        blank, strange = codes == BLANK, ~pieces.known[codes]
        opens = blank.copy()
        opens[1:] &= ~blank[:-1]
        opens |= strange
        opens[1:] |= strange[:-1]
        opens[starts] = True
        self.opens = np.append(opens, True)
        self.unit = np.flatnonzero(opens)  # place of each unit
        self.length = np.diff(self.unit, append=n)
        powers = np.cumprod(np.full(max(int(self.length.max()), 1), _FACTOR))
        place = np.arange(n) - np.repeat(self.unit, self.length)
        hashes = mixed(np.add.reduceat(mixed(codes.astype(np.uint64)) * powers[place], self.unit))
        hashes, sample, which = np.unique(hashes, return_index=True, return_inverse=True)
        if pieces.kept.grown["first"].n > KEPT:
            pieces.kept = pieces.kept.cut(KEPT // 2)
        number = pieces.kept.numbers_of(hashes, codes, self.unit[sample], self.length[sample])
        for c, grown in pieces.kept.grown.items():
            setattr(self, c, grown.all())
        self.base = self.node0[number[which]]  # first node of each unit's lattice
        self.end = self.base + self.length

    def choice(self, edge: int) -> np.ndarray:
        """The edges of the node that this one leaves."""
        after = int(np.searchsorted(self.first, edge, side="right"))
        return np.arange(self.first[after - 1], self.first[after])

    def draw(self, path: np.ndarray, place: np.ndarray, node: np.ndarray, end: np.ndarray, seeds: np.ndarray) -> None:
        """Fills ``path`` (edge by place of its first character) from the given places to the ends
        of their units, with edges drawn by probability."""
        while len(place):
            u = _uniform(seeds, place)
            edge = self.first[node]
            more = np.flatnonzero(u > self.upto[edge])
            while len(more):
                edge[more] += 1
                more = more[u[more] > self.upto[edge[more]]]
            path[place] = edge
            step = self.width[edge]
            node = node + step
            on = np.flatnonzero(node < end)
            place, node, end, seeds = place[on] + step[on], node[on], end[on], seeds[on]


class _Lattice:
    """The units at some places.  Nodes lie between characters; the edges of a node lie together,
    nodes in order."""

    def __init__(self, p: Pieces, codes: np.ndarray, starts: np.ndarray, lengths: np.ndarray):
        self.node0 = np.cumsum(lengths + 1) - lengths - 1
        nodes = int((lengths + 1).sum())
        place = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        codes = codes[np.repeat(starts, lengths) + place]
        source = np.repeat(self.node0, lengths) + place
        left = np.repeat(lengths, lengths) - place  # characters from here to the unit's end
        powers = np.cumprod(np.full(len(codes) + 1, _FACTOR)) * _INVERSE
        back = np.cumprod(np.full(len(codes) + 1, _INVERSE)) * _FACTOR * _FACTOR
        sums = np.concatenate([[np.uint64(0)], np.cumsum(mixed(codes.astype(np.uint64)) * powers[:-1])])
        found = []
        at = np.arange(len(codes))  # where a piece of this length may begin
        for length, (known, piece, maybe, where, most) in sorted(p.table.items()):
            h = (sums[at + length] - sums[at]) * back[at]
            slot = _slot(h)
            said = maybe[slot]
            some = np.flatnonzero(said & 1)
            if len(some):
                own, h, i = source[at[some]], h[some], where[slot[some]]
                for _ in range(most - 1):
                    i += (known[i] < h) & (i < len(known) - 1)
                hit = known[i] == h
                found.append((own[hit], length, piece[i[hit]]))
            at = at[said >= 2]
            at = at[left[at] > length]
        strange = np.flatnonzero(~p.known[codes])
        found = [*found[::-1], (source[strange], 1, -1 - codes[strange])]
        # Edges of a node side by side, the longest piece first: the lists are in that order.
        degree = np.zeros(nodes, np.int64)
        for own, _, _ in found:
            degree[own] += 1
        self.first = np.concatenate([[0], np.cumsum(degree)])
        free = self.first[:-1].copy()
        self.ids, self.width = np.empty(self.first[-1], np.int32), np.empty(self.first[-1], np.int16)
        for own, length, ids in found:
            slot = free[own]
            free[own] += 1
            self.ids[slot], self.width[slot] = ids, length
        src = np.repeat(np.arange(nodes), degree)
        dst = src + self.width
        weight = p.weight[np.maximum(self.ids, 0)]
        signs = np.flatnonzero(self.ids < 0)
        weight[signs] = _sizes(self.ids[signs]) * p.byte_weight
        # Log sums to the end, for all nodes at one distance from their end at once.
        total = np.zeros(nodes)
        first, last = self.first[source], self.first[source + 1]
        by = np.argsort(left.astype(np.uint16) if left.max() < 2**16 else left, kind="stable")
        cuts = np.searchsorted(left[by], np.arange(1, int(left.max()) + 2))
        for t in range(len(cuts) - 1):
            own = by[cuts[t]:cuts[t + 1]]
            if not len(own):
                continue
            count = last[own] - first[own]
            ends = np.cumsum(count)
            e = np.repeat(first[own] - ends + count, count) + np.arange(int(ends[-1]))
            value = weight[e] + total[dst[e]]
            cut = ends - count
            most = np.maximum.reduceat(value, cut)
            total[source[own]] = most + np.log(np.add.reduceat(np.exp(value - np.repeat(most, count)), cut))
        self.logp = np.minimum(weight + total[dst] - total[src], 0.0)
        # Running sums within each node, edge by edge, so that no other text's lattice rounds them.
        self.upto = np.exp(self.logp)
        at, last = self.first[:-1], self.first[1:] - 1
        at, last = at[last >= at], last[last >= at]
        ends = last
        while len(at):
            on = at < last
            at, last = at[on], last[on]
            self.upto[at + 1] += self.upto[at]
            at = at + 1
        self.upto[ends] = 2.0  # the last edge takes the rest


def _sizes(ids: np.ndarray) -> np.ndarray:
    """Ids that each of them becomes: the bytes of a sign without a piece, else one."""
    size = np.ones(len(ids), np.int64)
    signs = np.flatnonzero(ids < 0)
    code = -1 - ids[signs]
    code[code == STRANGE] = BLANK
    size[signs] += (code > 0x7F).astype(np.int64) + (code > 0x7FF) + (code > 0xFFFF)
    return size


def _uniform(seeds: np.ndarray, place: np.ndarray) -> np.ndarray:
    """In (0, 1), by hash."""
    bits = mixed(seeds + place.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))
    return ((bits >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def _cut_gumbel(location: np.ndarray, most: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Gumbels of the locations, given that none exceeds ``most``."""
    with np.errstate(over="ignore"):
        return np.where(location == -np.inf, -np.inf, location - np.log(np.exp(location - most) - np.log(u)))


class _Family:
    """The sets along one path that can be among the ``need`` best: places and priorities by text.

    A set's Gumbel with the uniform u is at most its log probability less log(1 - u), and that is less
    than REACH above it.  The log probability falls along the path, so with its value before a block of
    pieces, sets of the block that cannot reach the best ones so far are left out by u alone, and all
    that follow where no u would do."""

    def __init__(self, chunk, starts, ends, seeds, path, texts, branch, taken, perturbed, need):
        docs = len(starts)
        at = np.flatnonzero(path >= 0)
        edge = path[at]
        lp = chunk.logp[edge]
        first = np.searchsorted(at, starts[texts])
        size = np.searchsorted(at, ends[texts]) - first
        self.path, self.branch, self.taken, self.at = path, branch, taken, at
        self.logp = np.zeros(docs)
        self.logp[texts] = np.add.reduceat(lp, first)
        # At a branch, edges taken before are left out as well: the log of what they leave.
        again, left = np.zeros(docs, bool), np.zeros(docs)
        for t, gone in taken.items():
            rest = 1 - np.exp(chunk.logp[[*gone, path[branch[t]]]]).sum()
            again[t] = True
            left[t] = -np.inf if len(gone) + 1 >= len(chunk.choice(gone[0])) or rest <= 0 else np.log(rest)
        found, rows, low, width = [], np.arange(len(texts)), 0, BLOCK
        best, total = np.full((len(texts), need), -np.inf), np.zeros(len(texts))
        while len(rows):
            width = min(width, int(size[rows].max()) - low)
            whose, step = texts[rows], np.arange(low, low + width)
            spot = np.minimum(first[rows][:, None] + step, len(at) - 1)
            place = at[spot]
            u = _uniform(seeds[whose][:, None], place)
            # Sets lie from the branch on, where another edge leaves the same node.
            with np.errstate(over="ignore"):
                near = 1 - u <= 1.0001 * np.exp(total[rows] - best[rows, 0])[:, None]
            r, c = np.nonzero(near & (step < size[rows][:, None]) & (place >= branch[whose][:, None]))
            live = lp[spot[r, c]] < 0
            r, c = r[live], c[live]
            # Sums within each text alone, so that no neighbour rounds them.
            sums = np.cumsum(np.concatenate([total[rows][:, None], lp[spot]], axis=1), axis=1)
            i, whose, before = spot[r, c], whose[r], sums[r, c]
            with np.errstate(divide="ignore"):
                location = before + np.log1p(-np.minimum(np.exp(lp[i]), 1.0))
            turned = np.flatnonzero(again[whose] & (at[i] == branch[whose]))
            location[turned] = before[turned] + left[whose[turned]]
            priority = _cut_gumbel(location, perturbed[whose], u[r, c])
            found.append((whose, i, priority))
            tops = np.full(u.shape, -np.inf)
            tops[r, c] = priority
            best[rows] = np.sort(np.concatenate([best[rows], tops], axis=1), axis=1)[:, -need:]
            total[rows] = sums[:, -1]
            low, width = low + width, 2 * width
            rows = rows[(size[rows] > low) & (total[rows] + REACH >= best[rows, 0])]
        whose, i, priority = (np.concatenate(c) for c in zip(*found))
        order = np.lexsort((i, -priority, whose))
        order = order[priority[order] > -np.inf]
        self.index, self.priority, whose = i[order], priority[order], whose[order]
        self.next, self.stop = np.searchsorted(whose, np.arange(docs)), np.searchsorted(whose, np.arange(1, docs + 1))

    def best(self) -> np.ndarray:
        """Priority of the best set for each text of the chunk."""
        top = np.full(len(self.next), -np.inf)
        some = self.next < self.stop
        top[some] = self.priority[self.next[some]]
        return top

    def take(self, text: int) -> int:
        """Place of the text's best set, which is no longer one."""
        self.next[text] += 1
        return int(self.at[self.index[self.next[text] - 1]])


def sampled(pieces: Pieces, codes: np.ndarray, starts: np.ndarray, seeds: np.ndarray, k: int):
    """(edges' chunk, samples): each sample is (texts, path, logp, perturbed, kappa) where ``path``
    holds an edge at the place of each piece's first character, and -1 elsewhere.

    ``starts`` are the places of the texts, none of which is empty; ``seeds`` one number for each."""
    chunk = _Chunk(pieces, codes, starts)
    docs, n = len(starts), len(codes)
    ends = np.append(starts[1:], n)

    def stream(number: int) -> np.ndarray:
        """A seed for each place of draws of this number: of the text, less where it lies."""
        base = mixed(seeds + np.uint64(number * 0x9E3779B97F4A7C15 % 2**64))
        return base - starts.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03)

    def finish(path: np.ndarray, texts: np.ndarray, after: np.ndarray, number: int) -> None:
        """Draws what follows place ``after`` (a piece's end) in each of the texts."""
        own = stream(number)
        first_unit = np.searchsorted(chunk.unit, after, side="left")
        last_unit = np.searchsorted(chunk.unit, ends[texts], side="left")
        count = last_unit - first_unit
        total = np.cumsum(count)
        units = np.repeat(first_unit - total + count, count) + np.arange(int(total[-1]) if len(total) else 0)
        whose = np.repeat(texts, count)
        # The rest of the unit that holds ``after``.
        unit = first_unit - 1
        part = (after < ends[texts]) & (unit >= 0) & ~chunk.opens[after]
        unit = unit[part]
        inside = chunk.base[unit] + after[part] - chunk.unit[unit]
        chunk.draw(
            path, np.concatenate([chunk.unit[units], after[part]]), np.concatenate([chunk.base[units], inside]),
            np.concatenate([chunk.end[units], chunk.end[unit]]), np.concatenate([own[whose], own[texts[part]]]),
        )

    path = np.full(n, -1, np.int64)
    texts = np.arange(docs)
    finish(path, texts, starts, 1)
    u = _uniform(stream(2), starts)
    perturbed = -np.log(-np.log(u))
    families = [_Family(chunk, starts, ends, stream(3), path, texts, starts.copy(), {}, perturbed, k)]
    out = [[texts, path, families[0].logp, perturbed.copy()]]
    for s in range(1, k + 1):
        tops = np.array([f.best() for f in families])
        which = tops.argmax(axis=0)
        best = tops[which, np.arange(docs)]
        texts = np.flatnonzero(best > -np.inf)
        kappa = best
        if s == k or not len(texts):
            break
        path = np.full(n, -1, np.int64)
        branch, taken, after = starts.copy(), {}, np.zeros(len(texts), np.int64)
        own = _uniform(stream(10 * s), starts)
        for i, t in enumerate(texts.tolist()):
            f = families[which[t]]
            place = f.take(t)
            gone = [*(f.taken.get(t, []) if place == f.branch[t] else []), int(f.path[place])]
            choice = chunk.choice(f.path[place])
            for edge in gone:
                choice = choice[choice != edge]
            share = np.exp(chunk.logp[choice] - chunk.logp[choice].max())
            edge = choice[min(int(np.searchsorted(np.cumsum(share), own[t] * share.sum())), len(choice) - 1)]
            path[starts[t]:place] = f.path[starts[t]:place]
            path[place] = edge
            branch[t], taken[t] = place, gone
            after[i] = place + int(chunk.width[edge])
        finish(path, texts, after, 10 * s + 1)
        perturbed = np.where(best > -np.inf, best, 0.0)
        families.append(_Family(chunk, starts, ends, stream(10 * s + 2), path, texts, branch, taken, perturbed, k))
        out.append([texts, path, families[-1].logp, best.copy()])
    return chunk, out, kappa


def _log_inclusion(logp: np.ndarray, kappa: np.ndarray) -> np.ndarray:
    x = logp - kappa
    with np.errstate(over="ignore", divide="ignore", under="ignore"):
        return np.where(x < -30, x, np.log(-np.expm1(-np.exp(np.minimum(x, 700)))))


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array([len(t) + 1 for t in texts])
    starts = np.cumsum(sizes) - sizes
    codes = np.frombuffer((" " + " ".join(texts)).encode("utf-32-le"), np.uint32).astype(np.int64)
    codes = np.where(codes == BLANK, STRANGE, np.where(codes == 32, BLANK, codes))
    return codes, starts


def _byte_ids(pieces: Pieces, chunk: _Chunk, edges: np.ndarray) -> np.ndarray:
    """Ids of the edges' pieces, with byte pieces where a sign has no piece."""
    ids = chunk.ids[edges]
    signs = np.flatnonzero(ids < 0)
    if not len(signs):
        return ids.astype("<u2")
    size = _sizes(ids)
    out = np.repeat(ids, size)
    at, code, size = (np.cumsum(size) - size)[signs], -1 - ids[signs], size[signs]
    code[code == STRANGE] = BLANK
    for n, lead in ((1, 0), (2, 0xC0), (3, 0xE0), (4, 0xF0)):  # bytes of UTF-8
        own = size == n
        for j in range(n):
            data = code[own] >> 6 * (n - 1 - j)
            out[at[own] + j] = pieces.bytes[(data & 0x3F) | 0x80 if j else data | lead]
    return out.astype("<u2")


_SAMPLES = "doc_id long, sample int, ids binary, n_pieces long, log_prob double, perturbed double, log_inclusion double"


def _sampler(path: str, k: int, seed: int, decoded: bool = False):
    def rows_of(texts: list[str], keys: np.ndarray, pieces: Pieces):
        """(row, sample, ids, pieces, log_prob, perturbed, log_inclusion) of a chunk's texts."""
        full = [i for i, t in enumerate(texts) if t]
        for i in range(len(texts)):
            if not texts[i]:
                yield i, 1, b"", 0, 0.0, float(-np.log(-np.log(_uniform(keys[i:i + 1], np.zeros(1))))[0]), 0.0
        if not full:
            return
        codes, starts = _codes([texts[i] for i in full])
        chunk, samples, kappa = sampled(pieces, codes, starts, keys[full], k)
        for s, (own, path_, logp, perturbed) in enumerate(samples):
            inclusion = _log_inclusion(logp, kappa)
            at = np.flatnonzero(path_ >= 0)
            edges = path_[at]
            ids = _byte_ids(pieces, chunk, edges)
            low, high = np.searchsorted(at, starts[own]), np.searchsorted(at, np.append(starts[1:], len(codes))[own])
            if len(ids) > len(edges):
                ends = np.concatenate([[0], np.cumsum(_sizes(chunk.ids[edges]))])
                low, high = ends[low], ends[high]
            for t, a, b in zip(own.tolist(), low.tolist(), high.tolist()):
                yield full[t], s + 1, ids[a:b].tobytes(), b - a, float(logp[t]), float(perturbed[t]), float(inclusion[t])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_of(path)
        for batch in (b.slice(i, 128) for b in batches for i in range(0, len(b), 128)):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            keys = mixed(batch.column("key").to_numpy().view(np.uint64) + np.uint64(seed))
            row = 0
            while row < len(texts):
                stop, size = row, 0
                while stop < len(texts) and (stop == row or size + len(texts[stop]) <= CHUNK):
                    size += len(texts[stop]) + 1
                    stop += 1
                found = list(zip(*rows_of(texts[row:stop], keys[row:stop], pieces)))
                ids = batch.column("doc_id").slice(row, stop - row).take(pa.array(found[0]))
                kinds = (pa.int32(), pa.binary(), pa.int64(), pa.float64(), pa.float64(), pa.float64())
                columns = [ids, *(pa.array(c, kind) for c, kind in zip(found[1:], kinds))]
                names = ["doc_id", "sample", "ids", "n_pieces", "log_prob", "perturbed", "log_inclusion"]
                if decoded:
                    said = pieces.decoded_all([np.frombuffer(x, "<u2") for x in found[2]])
                    columns.append(pa.array([x.decode() for x in said], pa.string()))
                    names.append("text")
                yield pa.RecordBatch.from_arrays(columns, names=names)
                row = stop

    return run


def sample_segmentations(
    docs: DataFrame, k: int = SAMPLES, seed: int = SEED, path: str | None = None, decoded: bool = False
) -> DataFrame:
    """doc_id, sample (from 1, by falling perturbed score), ids (unsigned 16-bit, little-endian),
    n_pieces, log_prob, perturbed and log_inclusion of at most k segmentations of each row.  With
    ``decoded`` the text that the ids stand for follows, made in the same pass."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text",
        F.xxhash64(F.col("doc_id").cast("long"), F.lit("row")).alias("key"),
    )
    schema = _SAMPLES + (", text string" if decoded else "")
    return rows.mapInArrow(_sampler(path or model_path(), k, seed, decoded), schema)


def decode(encoded: DataFrame, path: str | None = None, ids: str = "ids", out: str = "text") -> DataFrame:
    """``encoded`` with the text that its column of ids stands for (null for null ids)."""
    path = path or model_path()

    @F.pandas_udf("string")
    def text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        pieces = pieces_of(path)
        for column in batches:
            yield pd.Series([None if x is None else pieces.decoded(np.frombuffer(x, "<u2")).decode() for x in column], dtype=object)

    return encoded.withColumn(out, text(F.col(ids)))


def op5_piece_samples(spark, sf_dir: str) -> DataFrame:
    # Decoded in the pass that samples: a second pass would need as many Python workers again.
    found = sample_segmentations(table(spark, sf_dir, "documents"), decoded=True)
    return found.select(
        "doc_id", "sample", "n_pieces", F.crc32("ids").alias("ids_crc32"), F.crc32(F.col("text").cast("binary")).alias("text_crc32"),
        "log_prob", "perturbed", "log_inclusion",
    )
