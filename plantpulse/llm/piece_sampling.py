"""Distinct sampled segmentations of texts into SentencePiece pieces, and their decoding.

The lattice of a text has an edge for each piece of the vocabulary that matches at a position. A piece
weighs 1 / (rank + 1), as the vocabulary holds ranks and no probabilities; a character without any piece is
an edge of its bytes. Summing weights backwards gives each node's share, and so the probability of each
edge where a path reaches its start: the lattice becomes a tree of choices.

Gumbel top-k: give every path its log-probability plus its own Gumbel noise; the k highest are k samples
without replacement. A search finds them without listing paths: a subtree's highest noisy value is known
before it is opened (a Gumbel around the log of its mass, below the value of the part it was cut
from). The best waiting subtree is opened next: one path is drawn through it, which has just that value, and
what branches off at each step is a smaller subtree whose value is drawn below it. The value of the best subtree left
over after k paths is the threshold: a path's inclusion score is the chance to lie above it.

No piece goes across the front of a word's blank, so the lattice falls into words, and each word's nodes
are made once per worker for many documents. Paths of all documents of a batch are drawn as arrays. Noise
comes from a hash of seed, row key and place alone: the same row always gives the same samples.

Cases: a NULL or empty text has one segmentation, without pieces; a text with fewer segmentations than
asked for gives those it has, with certainty; repeated rows give repeated results; a NULL key
counts as zero; the blank mark of the vocabulary in a text is a blank. Texts are read whole.
"""

from __future__ import annotations

import heapq
import math
import re
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantpulse.llm.common import kept

BLANK = "▁"
_WORD = re.compile(" *[^ \n]+| +|\n")
#: Most edges that a Python worker keeps; bounds its memory only.
EDGES = 4_000_000
#: Characters of text whose paths are drawn at a time.
AT_ONCE = 300_000
#: Characters of new words whose lattices are made at a time; what that needs besides the edges kept is in proportion.
_NEW = 40_000

_STEP = np.uint64(0x9E3779B97F4A7C15)
_ALL = 0xFFFFFFFFFFFFFFFF
_SPREAD = np.uint64(0xD6E8FEB86659FD93)
_PRIME = np.uint64(1_000_003)
#: Numbers drawn ahead for each row.
_POOL = 512
#: Steps of a path whose branches are looked at together.
_BLOCK = 256
_GRAIN = float(1 << 28)
#: Edges after the likeliest that a walk looks at one by one.
_NEAR = 3
#: No Gumbel noise is above this: -log(-log(u)) for the largest u.
_HIGHEST = 20.2


def _times(factor: int, number: int) -> np.uint64:
    return np.uint64(factor * number & 0xFFFFFFFFFFFFFFFF)


def _mix(x: np.ndarray) -> np.ndarray:
    """Hash of an array of 64-bit numbers (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _uniform(x: np.ndarray) -> np.ndarray:
    """Numbers strictly between 0 and 1 from hashes.

    They have 29 bits and shares are rounded to 28, so both stay exact when a node's number is added, and a
    row's samples don't depend on what else its worker has seen.
    """
    return ((x >> np.uint64(36)).astype(np.float64) + 0.5) / _GRAIN


class Vocabulary:
    """Pieces with ranks, for look-ups of many substrings at once by their hashes."""

    def __init__(self, model: bytes):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        size = sp.get_piece_size()
        self.pieces = [sp.id_to_piece(i) for i in range(size)]
        self.byte = np.zeros(256, dtype=np.int64)
        self.is_byte = np.zeros(size, dtype=bool)
        self.longest = 1
        worst = -np.log(size + 1.0)
        rows: list[tuple] = []
        for i, piece in enumerate(self.pieces):
            if sp.is_byte(i):
                self.byte[int(piece[3:5], 16)], self.is_byte[i] = i, True
                continue
            if sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                continue
            if BLANK in piece.lstrip(BLANK) or (len(piece) > 1 and "\n" in piece):
                raise ValueError("pieces that go across words are not supported")
            rows.append((piece, i, max(worst, -np.log(1.0 - min(sp.get_score(i), 0.0)))))
            self.longest = max(self.longest, len(piece))
        self.worst = worst
        rows = [(h, i, w) for h, (_, i, w) in zip(self._hashes([p for p, _, _ in rows]).tolist(), rows)]
        rows.sort()
        self.hashes = np.array([h for h, _, _ in rows], dtype=np.uint64)
        self.ids = np.array([i for _, i, _ in rows], dtype=np.int32)
        self.weights = np.array([w for _, _, w in rows])
        # Most substrings are no pieces and begin none; a look into this table, by the first bits of their hashes,
        # tells most of them: 1 for pieces, 2 for beginnings of longer ones.
        self.filter = np.zeros(1 << 20, dtype=np.uint8)
        self.filter[(self.hashes >> np.uint64(44)).astype(np.int64)] = 1
        named = [self.pieces[i] for i in self.ids]
        starts = self._hashes(list({p[:k] for p in named for k in range(1, len(p))}))
        self.filter[(starts >> np.uint64(44)).astype(np.int64)] |= 2
        # What each piece reads as, in bytes, one after another.
        reads = [p.replace(BLANK, " ").encode() for p in self.pieces]
        for b, i in enumerate(self.byte.tolist()):
            reads[i] = bytes([b])
        self._length = np.array([len(r) for r in reads])
        self._start = np.cumsum(self._length) - self._length
        self._bytes = np.frombuffer(b"".join(reads), dtype=np.uint8)

    @staticmethod
    def _hashes(pieces: list[str]) -> np.ndarray:
        found = []
        for piece in pieces:
            h = 0
            for c in piece:
                h = (h * int(_PRIME) + ord(c) + 1) & _ALL
            found.append(h)
        return _mix(np.array(found, dtype=np.uint64))

    def look_up(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which of the hashes are of pieces, the rows of these, and which may begin longer pieces."""
        hashes = _mix(hashes)
        told = self.filter[(hashes >> np.uint64(44)).view(np.int64)]
        maybe = np.flatnonzero(told & 1)
        hashes = hashes[maybe]
        row = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        hit = self.hashes[row] == hashes
        return maybe[hit], row[hit], told > 1

    def decode(self, ids: np.ndarray) -> str:
        """The text of a sequence of pieces, without the blank that encoding puts in front."""
        length = self._length[ids]
        ends = np.cumsum(length)
        if not len(ends):
            return ""
        places = np.repeat(self._start[ids] - ends + length, length) + np.arange(ends[-1])
        text = self._bytes[places].tobytes().decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


def normalised(text: str) -> str:
    """What decoding gives back: the blank mark reads as a blank."""
    return text.replace(BLANK, " ") if BLANK in text else text


class Lattices:
    """The nodes and edges of the words met so far.

    Edges of a node are neighbours, the likeliest first. Of each edge: ``reach``, the node's number plus the
    summed shares up to it; ``logs``, the log of its share; its ``target`` node, -1 at the end; its ``piece``.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self._capacity = 0
        self.clear()

    def clear(self) -> None:
        """Forget all words. The arrays stay, as new ones would lie beside them in the worker's memory."""
        self.root: dict[str, int] = {}
        self.nodes = self.edges = 0
        if self._capacity == EDGES:
            return
        n = self._capacity = EDGES
        self.reach, self.logs = np.empty(n), np.empty(n)
        self.target, self.piece = np.empty(n, dtype=np.int32), np.empty(n, dtype=np.int32)
        self.first = np.zeros(n + 1, dtype=np.int32)

    def add(self, words: list[str]) -> None:
        """Make the lattices of words that are not there yet."""
        at = 0
        while at < len(words):
            stop, size = at + 1, len(words[at])
            while stop < len(words) and size + len(words[stop]) <= _NEW:
                size += len(words[stop])
                stop += 1
            self._add(words[at:stop])
            at = stop

    def _add(self, words: list[str]) -> None:
        v = self.vocabulary
        points = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
        points[points == ord(" ")] = ord(BLANK)
        count = len(points)
        length = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        begin = np.cumsum(length) - length
        end = np.repeat(begin + length, length)
        # Edges: every piece that matches from a position on, by its length.
        place, hashes = np.arange(count), np.zeros(count, dtype=np.uint64)
        edges = []
        for k in range(1, v.longest + 1):
            if k > 1:
                inside = place + k <= end[place]
                place, hashes = place[inside], hashes[inside]
            if not len(place):
                break
            hashes = hashes * _PRIME + points[place + (k - 1)] + np.uint64(1)
            hit, row, longer = v.look_up(hashes)
            edges.append((place[hit], np.full(len(hit), k), v.ids[row], v.weights[row]))
            if k == 1 and len(hit) < count:
                # A character without a piece: its one byte, or minus its code point for several bytes.
                bare = np.ones(count, dtype=bool)
                bare[hit] = False
                bare = np.flatnonzero(bare)
                code = points[bare].astype(np.int64)
                size = 1 + (code > 0x7F) + (code > 0x7FF) + (code > 0xFFFF)
                piece = np.where(code < 128, v.byte[np.minimum(code, 127)], -code).astype(np.int32)
                edges.append((bare, np.ones(len(bare), dtype=np.int64), piece, v.worst * size))
            place, hashes = place[longer], hashes[longer]
        # Edges of a node side by side, the shorter ones first: each goes to its node's next free place.
        per_node = np.zeros(count, dtype=np.int64)
        for at, *_ in edges:
            per_node[at] += 1
        heads = np.cumsum(per_node) - per_node
        free = heads.copy()
        step, piece = np.empty(int(per_node.sum()), dtype=np.int64), np.empty(int(per_node.sum()), dtype=np.int32)
        weight = np.empty(len(step))
        for at, steps, pieces, weights in edges:
            to = free[at]
            step[to], piece[to], weight[to] = steps, pieces, weights
            free[at] += 1
        source = np.repeat(np.arange(count), per_node)
        goal = source + step
        last = goal == end[source]
        # From the ends of the words backwards: all positions with as many characters left at once.
        left = end - np.arange(count)
        longest = int(length.max())
        by_left = np.argsort(left.astype(np.int16) if longest < 1 << 15 else left, kind="stable")
        many = per_node[by_left]
        new = np.cumsum(many) - many
        order = np.arange(len(step)) + np.repeat(heads[by_left] - new, many)
        levels = np.concatenate([[0], np.cumsum(np.bincount(left, minlength=longest + 1))[1:]])
        mass = np.zeros(count)
        ordered, onwards, ends = weight[order], np.minimum(goal[order], count - 1), last[order]
        for i, j in zip(levels[:-1].tolist(), levels[1:].tolist()):
            if i == j:
                continue
            a, b = int(new[i]), int(new[j - 1] + many[j - 1])
            onward = ordered[a:b] + np.where(ends[a:b], 0.0, mass[onwards[a:b]])
            starts = new[i:j] - a
            top = np.maximum.reduceat(onward, starts)
            spread = np.exp(onward - np.repeat(top, many[i:j]))
            mass[by_left[i:j]] = top + np.log(np.add.reduceat(spread, starts))
        share = np.exp(weight + np.where(last, 0.0, mass[np.minimum(goal, count - 1)]) - np.repeat(mass, per_node))
        # The likeliest edge of a node comes first, where a walk looks first.
        best = np.flatnonzero(share == np.repeat(np.maximum.reduceat(share, heads), per_node))
        best = best[np.flatnonzero(np.diff(source[best], prepend=-1))]
        moved = np.flatnonzero(best != heads)
        here, there = heads[moved], best[moved]
        for x in (goal, piece, share, last):
            x[here], x[there] = x[there], x[here]
        reach = share.copy()
        more, rank = heads[per_node > 1], 1
        many = per_node[per_node > 1]
        while len(more):
            reach[more + rank] += reach[more + rank - 1]
            rank += 1
            more, many = more[many > rank], many[many > rank]
        reach[heads + per_node - 1] = 1.0
        a, b, base = self.edges, self.edges + len(share), self.nodes
        if b > self._capacity or base + count >= len(self.first):
            grown = max(2 * self._capacity, b, base + count + 1)
            for name in ("reach", "logs", "target", "piece"):
                setattr(self, name, np.resize(getattr(self, name), grown))
            self.first, self._capacity = np.resize(self.first, grown + 1), grown
        self.reach[a:b] = base + source + np.minimum(np.rint(reach * _GRAIN) / _GRAIN, 1.0)
        self.logs[a:b] = np.log(np.minimum(share, 1.0))
        self.target[a:b] = np.where(last, -1, base + goal)
        self.piece[a:b] = piece
        self.first[base + 1 : base + 1 + count] = a + np.cumsum(per_node)
        self.root.update(zip(words, (base + begin).tolist()))
        self.nodes, self.edges = base + count, b

    def roots(self, texts: list[list[str]]) -> list[np.ndarray]:
        """First nodes of the words of each text."""
        every = list(chain.from_iterable(texts))
        found = np.fromiter(map(self.root.get, every, repeat(-1)), dtype=np.int64, count=len(every))
        new = np.flatnonzero(found < 0)
        if len(new):
            if self.edges > EDGES - 400_000:
                self.clear()
                new = np.arange(len(every))
            self.add(list(dict.fromkeys(map(every.__getitem__, new.tolist()))))
            found[new] = np.fromiter(map(self.root.__getitem__, map(every.__getitem__, new.tolist())), dtype=np.int64, count=len(new))
        ends = np.cumsum([len(words) for words in texts])
        return np.split(found, ends[:-1])

    def walk(self, state: np.ndarray, noise: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Draw a path from each node on. Edges in order, and where each node's edges end."""
        reach = self.reach[: self.edges]
        active, here = np.arange(len(state)), state
        steps, length = [], np.zeros(len(state), dtype=np.int64)
        while len(active):
            noise = noise + _STEP
            point = here + _uniform((noise ^ (noise >> np.uint64(32))) * _SPREAD)
            edge = self.first[here].astype(np.int64)
            other = np.flatnonzero(point >= reach[edge])
            # The next edges of the node lie beside the first one; what is not among them is searched for.
            for _ in range(_NEAR):
                if not len(other):
                    break
                edge[other] += 1
                other = other[point[other] >= reach[edge[other]]]
            if len(other):
                edge[other] = np.searchsorted(reach, point[other], side="right")
            steps.append((active, edge))
            length[active] += 1
            here = self.target[edge].astype(np.int64)
            on = here >= 0
            active, here, noise = active[on], here[on], noise[on]
        ends = np.cumsum(length)
        begin = ends - length
        out = np.empty(int(ends[-1]) if len(ends) else 0, dtype=np.int64)
        for t, (which, edge) in enumerate(steps):
            out[begin[which] + t] = edge
        return out, ends

    def walk_on(self, node: int, seed: int) -> list[int]:
        """Draw the edges from one node to the end of its word; none from the end (-1)."""
        out, seed = [], int(_mix(np.array([seed & _ALL], dtype=np.uint64))[0])
        while node >= 0:
            seed = seed + int(_STEP) & _ALL
            point = node + (((seed ^ seed >> 32) * int(_SPREAD) & _ALL) >> 36) / _GRAIN + 0.5 / _GRAIN
            edge = int(self.first[node])
            while point >= self.reach[edge]:
                edge += 1
            out.append(edge)
            node = int(self.target[edge])
        return out


class Path:
    """A drawn path: its edges, where the edges of each word end, and its noisy value."""

    def __init__(self, edges: np.ndarray, ends: np.ndarray, value: float):
        self.edges, self.ends, self.value = edges, ends, value
        self.log_prob = 0.0


class Sampler:
    """Draws segmentations of texts under one vocabulary."""

    def __init__(self, model: bytes, samples: int, seed: int):
        self.vocabulary = Vocabulary(model)
        self.lattices = Lattices(self.vocabulary)
        self._samples, self._seed = samples, seed

    def __call__(self, keys: list[int], texts: list[str]) -> Iterator[tuple[int, int, np.ndarray, float, float, float]]:
        """Row, rank, pieces, log-probability, noisy value, log of the inclusion score."""
        at = 0
        while at < len(texts):
            stop, size = at + 1, len(texts[at])
            while stop < len(texts) and size + len(texts[stop]) <= AT_ONCE:
                size += len(texts[stop])
                stop += 1
            yield from self._batch(at, keys[at:stop], texts[at:stop])
            at = stop

    def _batch(self, row: int, keys: list[int], texts: list[str]) -> Iterator:
        words = [_WORD.findall(" " + normalised(t)) if t else [] for t in texts]
        roots = self.lattices.roots(words)
        key = np.array([k & 0xFFFFFFFFFFFFFFFF for k in keys], dtype=np.uint64)
        own = _mix(_mix(key + _times(int(_STEP), self._seed)))
        count = np.array([len(r) for r in roots])
        number = np.concatenate([np.arange(c) for c in count]).astype(np.uint64) if count.sum() else np.empty(0, np.uint64)
        state = np.concatenate(roots) if roots else np.empty(0, np.int64)
        base = np.repeat(own, count) + number * np.uint64(0xD1B54A32D192ED03)
        drawn = []
        for s in range(self._samples):
            drawn.append(self.lattices.walk(state, _mix(base + _times(0x8CB92BA72F3D8DD7, s + 1))))
        pool = _mix(own ^ np.uint64(0x5851F42D4C957F2D))
        pool = np.concatenate([pool[:, None], _uniform(_mix(pool[:, None] + np.arange(_POOL, dtype=np.uint64) * _STEP)).view(np.uint64)], axis=1)
        last = np.cumsum(count)
        for d in range(len(texts)):
            a, b = int(last[d] - count[d]), int(last[d])
            plain = []
            for edges, ends in drawn:
                start = int(ends[a - 1]) if a else 0
                plain.append((edges[start : int(ends[b - 1]) if b else 0], ends[a:b] - start))
            rank = 0
            for path, score in self._search(plain, own[d : d + 1], pool[d]):
                rank += 1
                yield row + d, rank, self._pieces(path.edges), path.log_prob, path.value, score

    def _pieces(self, edges: np.ndarray) -> np.ndarray:
        ids = self.lattices.piece[edges]
        if not (ids < 0).any():
            return ids
        byte = self.vocabulary.byte
        parts = [[i] if i >= 0 else byte[list(chr(-i).encode())].tolist() for i in ids.tolist()]
        return np.array([i for p in parts for i in p], dtype=np.int32)

    def _search(self, plain: list[tuple[np.ndarray, np.ndarray]], own: np.ndarray, pool: np.ndarray) -> list[tuple[Path, float]]:
        lat, k = self.lattices, self._samples
        stream = 0
        ready = pool[1:].view(np.float64)

        def noise(n: int) -> np.ndarray:
            """The next numbers of this row."""
            nonlocal stream
            stream += n
            if stream <= _POOL:
                return ready[stream - n : stream]
            return _uniform(_mix(pool[:1] + np.arange(stream - n, stream, dtype=np.uint64) * _STEP))

        found: list[Path] = []
        waiting: list[tuple[float, int, Path, int, tuple[int, ...], float]] = []

        def branch(path: Path, start: int) -> None:
            """Put what branches off a path, from a step on, among the waiting subtrees."""
            logs = lat.logs[path.edges]
            path.log_prob = float(logs.sum())
            before = float(logs[:start].sum())
            best: list[tuple[float, int]] = []
            for a in range(start, len(logs), _BLOCK):
                # Later branches have less mass than ``before``, and the noise has a highest value.
                if len(best) > k and before + _HIGHEST < best[-1][0]:
                    break
                own = logs[a : a + _BLOCK]
                run = np.cumsum(own)
                with np.errstate(divide="ignore"):
                    mass = before + run - own + np.log(-np.expm1(own))
                bound = best[-1][0] - _HIGHEST if len(best) > k else -np.inf
                steps = np.flatnonzero(mass > bound)
                if len(steps):
                    value = values(mass[steps], path.value)
                    pick = np.argpartition(-value, k)[: k + 1] if len(value) > k + 1 else range(len(value))
                    best += [(float(value[i]), a + int(steps[i])) for i in pick]
                    best.sort(reverse=True)
                    del best[k + 1 :]
                before += float(run[-1])
            for value, step in best:
                push(value, path, step, (int(path.edges[step]),), float(logs[:step].sum()))

        def values(mass: np.ndarray, below: float) -> np.ndarray:
            """Highest noisy values of subtrees of these log masses, given that they are below one."""
            return mass - np.log(np.exp(np.minimum(mass - below, 600.0)) - np.log(noise(len(mass))))

        def push(value: float, *subtree) -> None:
            serial[0] += 1
            heapq.heappush(waiting, (-value, serial[0], *subtree))

        serial = [0]
        top = -np.log(-np.log(noise(1)[0]))
        first = Path(plain[0][0], plain[0][1], float(top))
        found.append(first)
        branch(first, 0)
        while waiting and len(found) < k:
            value, _, parent, step, taken, before = heapq.heappop(waiting)
            node = int(self._node_of(parent.edges[step : step + 1])[0])
            options = [e for e in range(lat.first[node], lat.first[node + 1]) if e not in taken]
            share = [math.exp(lat.logs[e]) for e in options]
            point, pick, left = float(noise(1)[0]) * sum(share), options[-1], sum(share[:-1])
            for e, own_share in zip(options, share):
                if point < own_share:
                    pick, left = e, sum(x for o, x in zip(options, share) if o != e)
                    break
                point -= own_share
            if len(options) > 1 and left > 0.0:
                mass = before + math.log(left)
                again = mass - math.log(math.exp(min(mass + value, 600.0)) - math.log(noise(1)[0]))
                push(again, parent, step, (*taken, pick), before)
            # The rest of the word from there, then the words of a draw of its own.
            word = int(np.searchsorted(parent.ends, step, side="right"))
            edges, ends = plain[len(found)]
            inside = lat.walk_on(int(lat.target[pick]), int(own[0]) + 0x2545F4914F6CDD1D * len(found))
            after = edges[int(ends[word]) :]
            path = Path(
                np.concatenate([parent.edges[:step], np.array([pick, *inside]), after]),
                np.concatenate([parent.ends[:word], [step + 1 + len(inside)], ends[word + 1 :] - ends[word] + step + 1 + len(inside)]),
                -value)
            found.append(path)
            branch(path, step + 1)
        limit = -waiting[0][0] if waiting else -np.inf
        out = []
        for p in found:
            odds = p.log_prob - limit
            # log(1 - exp(-exp(odds))), which is odds itself where that is small.
            out.append((p, odds if odds < -30 else float(np.log(-np.expm1(-np.exp(min(odds, 30.0)))))))
        return out

    def _node_of(self, edges: np.ndarray) -> np.ndarray:
        """The node that an edge leaves: its reach lies in (node, node + 1]."""
        return np.ceil(self.lattices.reach[edges]).astype(np.int64) - 1


_COLUMNS = "sample int, pieces array<int>, log_prob double, noisy_value double, log_inclusion double, round_trip boolean"


def segmentations(docs: DataFrame, model: str, samples: int = 2, seed: int = 5, key: str = "doc_id") -> DataFrame:
    """Up to ``samples`` distinct segmentations of each row's ``text``, most noisy value first.

    ``model`` is the path of a SentencePiece model; the driver reads it and sends its bytes (a vocabulary has a
    fixed size). Columns: the key, ``sample`` from 1, ``pieces``, ``log_prob`` of the segmentation, ``noisy_value``,
    ``log_inclusion`` and whether decoding gives the text again.
    """
    with open(model, "rb") as file:
        sent = docs.sparkSession.sparkContext.broadcast(file.read())

    def drawn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = ("pieces", hash(sent.value), samples, seed)
        sampler = kept(name, lambda: Sampler(sent.value, samples, seed))
        for batch in batches:
            ids = batch.column(0)
            for at in range(0, batch.num_rows, 500):
                keys = [k or 0 for k in ids.slice(at, 500).to_pylist()]
                texts = [normalised(t or "") for t in batch.column(1).slice(at, 500).to_pylist()]
                rows = list(sampler(keys, texts))
                offsets = np.concatenate([[0], np.cumsum([len(r[2]) for r in rows])])
                flat = np.concatenate([r[2] for r in rows]) if rows else np.empty(0, np.int32)
                same = [sampler.vocabulary.decode(r[2]) == texts[r[0]] for r in rows]
                yield pa.RecordBatch.from_arrays([
                    ids.take(pa.array([at + r[0] for r in rows])),
                    pa.array([r[1] for r in rows], pa.int32()),
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int32())),
                    *[pa.array([r[i] for r in rows], pa.float64()) for i in (3, 4, 5)],
                    pa.array(same, pa.bool_()),
                ], names=[key, "sample", "pieces", "log_prob", "noisy_value", "log_inclusion", "round_trip"])

    return docs.select(F.col(key).cast("long"), "text").mapInArrow(drawn, f"{key} long, {_COLUMNS}")


def decoded(encoded: DataFrame, model: str, pieces: str = "pieces", alias: str = "text") -> DataFrame:
    """``encoded`` with the text of each sequence of pieces."""
    with open(model, "rb") as file:
        sent = encoded.sparkSession.sparkContext.broadcast(file.read())

    @F.pandas_udf("string")
    def text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        vocabulary = Vocabulary(sent.value)
        for batch in batches:
            yield pd.Series([None if p is None else vocabulary.decode(np.asarray(p, dtype=np.int64)) for p in batch], dtype="object")

    return encoded.withColumn(alias, text(pieces))
