"""Sampled segmentations without replacement: Gumbel top-k by A* over the lattice of a text.

The lattice of a text is that of its words in a row (no piece reaches over the start of a
word). Forward sums give every node the probability of each piece that ends there, so a path
can be drawn exactly, and so can the mass of any set of paths that share their first decisions.
The search holds such sets with a perturbed value each, the maximum of their paths' values:
a Gumbel variable at the set's mass, truncated at the value of the set it came from. The best
set is opened, its best path is drawn and given out, and the rest of the set falls into the
sets that leave that path at one of its decisions. Paths come out in the order of their
perturbed values, each once.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_batches, pick, position
from .tokens import _WORDS, SPACE, UNKNOWN_PENALTY, normalised, vocabulary

#: Scores are multiplied by this; scores of the model are ranks, so it is small.
SMOOTHING = 0.0005
#: Segmentations of a text.
SAMPLES = 2
#: Distinct words whose lattices a task keeps.
KEPT_WORDS = 200_000
#: Decisions looked at one by one, and the log mass (relative) from which later ones stay together.
NEAR, FAR_MASS = 512, 40.0


class Trie:
    """Beginnings of pieces as states; finds the pieces at all places of a text at once, a character a step.

    Steps (state and character) stand in an open hash table of which a tenth or less is used.
    """

    def __init__(self, names: list[str]):
        step: dict[tuple[int, int], int] = {}
        ends = []
        for name in names:
            state = 0
            for c in name:
                state = step.setdefault((state, ord(c)), len(step) + 1)
            ends.append(state)
        self.piece = np.full(len(step) + 1, -1, dtype=np.int32)
        self.piece[ends] = np.arange(len(names), dtype=np.int32)
        self.first = np.zeros(0x110000, dtype=np.int32)
        for (state, c), to in step.items():
            if not state:
                self.first[c] = to
        bits = (10 * len(step)).bit_length()
        self.shift, self.last = np.uint64(64 - bits), (1 << bits) - 1
        self.held, self.to = np.full(1 << bits, -1, dtype=np.int64), np.zeros(1 << bits, dtype=np.int32)
        keys = np.array([state << 21 | c for state, c in step], dtype=np.int64)
        to = np.fromiter(step.values(), dtype=np.int32, count=len(step))
        slot = self._slot(keys)
        while len(keys):
            # Of those that want one free place, one gets it; the others go on to the next.
            free = np.flatnonzero(self.held[slot] < 0)
            _, one = np.unique(slot[free], return_index=True)
            got = free[one]
            self.held[slot[got]], self.to[slot[got]] = keys[got], to[got]
            left = np.ones(len(keys), dtype=bool)
            left[got] = False
            keys, to, slot = keys[left], to[left], slot[left] + 1 & self.last

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self.shift).view(np.int64)

    def _next(self, state: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """The states after a character, 0 for none."""
        keys = state.astype(np.int64) << 21 | codes
        slot = self._slot(keys)
        held = self.held[slot]
        out = np.where(held == keys, self.to[slot], 0)
        on = np.flatnonzero((held != keys) & (held >= 0))
        while len(on):
            slot[on] = slot[on] + 1 & self.last
            held = self.held[slot[on]]
            hit = held == keys[on]
            out[on[hit]] = self.to[slot[on[hit]]]
            on = on[~hit & (held >= 0)]
        return out

    def find(self, codes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """(where they start, piece) of the pieces of 1, 2, 3 ... characters in a text, by their places."""
        state, found = self.first[codes], []
        at = np.flatnonzero(state)
        state = state[at]
        while len(at):
            piece = self.piece[state]
            whole = piece >= 0
            found.append((at[whole], piece[whole]))
            if at[-1] + len(found) == len(codes):
                at, state = at[:-1], state[:-1]
            state = self._next(state, codes[at + len(found)])
            on = state > 0
            at, state = at[on], state[on]
        return found


class Codec:
    """Piece tables of a sentencepiece model, with its bytes for characters without a piece."""

    def __init__(self, path: str):
        pieces = vocabulary(path)
        names = list(pieces)
        self.ids = np.array([pieces[p][0] for p in names], dtype=np.int32)
        self.scores = np.array([pieces[p][1] for p in names])
        self.trie = Trie(names)
        self.known = np.zeros(0x110000, dtype=bool)
        self.known[[ord(p) for p in names if len(p) == 1]] = True
        self.unknown = float(self.scores.min()) - UNKNOWN_PENALTY
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        # Bytes of ASCII are characters by themselves.
        self.text_of = np.array([model.id_to_piece(i).replace(SPACE, " ") for i in range(model.get_piece_size())], dtype=object)
        self.is_high, self.high_bytes = np.zeros(len(self.text_of), dtype=bool), {}
        for b, i in enumerate(self.byte_ids):
            if b < 0x80:
                self.text_of[i] = chr(b)
            else:
                self.is_high[i], self.high_bytes[i] = True, bytes([b])

    def decode(self, ids: list[int] | np.ndarray) -> str:
        """The text of ids: marks are spaces, byte pieces bytes, and the space before the text goes."""
        ids = np.asarray(ids, dtype=np.int64)
        names, high = self.text_of[ids].tolist(), self.high_bytes
        if self.is_high[ids].any():
            text = b"".join([high.get(i) or name.encode() for i, name in zip(ids.tolist(), names, strict=True)]).decode("utf-8", "replace")
        else:
            text = "".join(names)
        return text[1:] if text.startswith(" ") else text


@lru_cache(maxsize=1)
def codec_of(path: str) -> Codec:
    """The codec of a model, made once in a worker."""
    return Codec(path)


class _Numbers(dict):
    """Numbers of words; a new word gets the next one."""

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        return number


class Lattice:
    """Nodes and pieces of distinct words, as they come: node ``base[w] + p`` is position p of word w.

    Pieces are sorted by the node they end at: ``start`` position, ``piece`` (a row of the
    codec's tables, -1 - c for character c without one), conditional log probability, and
    cumulative probability within the node (``key``), for drawing.
    """

    def __init__(self, codec: Codec, smoothing: float):
        self.codec, self.smoothing, self.number = codec, smoothing, _Numbers()
        self.room: dict[str, np.ndarray] = {}
        self.length = self.base = self.first = self.many = np.zeros(0, dtype=np.int64)
        self.start = self.piece = np.zeros(0, dtype=np.int32)
        self.log_p = self.key = np.zeros(0)

    def _append(self, name: str, values: np.ndarray) -> None:
        """More rows for one of the tables, whose room doubles when it is full."""
        held, size = getattr(self, name), len(getattr(self, name)) + len(values)
        if name not in self.room or len(self.room[name]) < size:
            self.room[name] = np.empty(max(2 * len(held), size), dtype=held.dtype)
            self.room[name][: len(held)] = held
        self.room[name][len(held) : size] = values
        setattr(self, name, self.room[name][:size])

    def words_of(self, text: str) -> np.ndarray:
        """Numbers of the words of a text; new words get the next ones, ``extend`` adds their nodes."""
        words = _WORDS.findall(normalised(text))
        return np.fromiter(map(self.number.__getitem__, words), dtype=np.int64, count=len(words))

    def extend(self) -> None:
        """Nodes and pieces of the words that have none yet."""
        codec, smoothing = self.codec, self.smoothing
        words = list(islice(self.number, len(self.length), None))
        if not words:
            return
        node, arc = len(self.first), len(self.start)
        lengths = np.array([len(w) for w in words], dtype=np.int64)
        base = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]])
        line = "\x00".join(words) + "\x00"  # word w starts at base[w], position p ends at base[w] + p
        codes = np.frombuffer(line.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        found = codec.trie.find(codes)
        odd = np.flatnonzero(~codec.known[codes])
        odd = np.setdiff1d(odd, base + lengths, assume_unique=True)  # without the ends of words
        if len(odd):
            one, piece = found[0] if found else (np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int32))
            found[:1] = [(np.concatenate([one, odd]), np.concatenate([piece, -1 - codes[odd].astype(np.int32)]))]
        # By end, longer pieces first.
        ends = np.concatenate([start + size for size, (start, _) in reversed([*enumerate(found, 1)])])
        start, piece = (np.concatenate([x[i] for x in reversed(found)]) for i in (0, 1))
        order = np.argsort(ends, kind="stable")
        ends, start, piece = ends[order], start[order], piece[order]
        weight = np.where(piece < 0, codec.unknown, codec.scores[np.maximum(piece, 0)]) * smoothing
        word = np.repeat(np.arange(len(words)), lengths + 1)[start]
        size = len(line)
        total = np.full(size, -np.inf)
        total[base] = 0.0
        # Forward sums, one position of all words at a time.
        position = ends - base[word]
        by_position = np.argsort(position.astype(np.uint16) if position.max() < 1 << 16 else position, kind="stable")
        cuts = np.flatnonzero(np.diff(position[by_position])) + 1
        for arcs in np.split(by_position, cuts):
            value = total[start[arcs]] + weight[arcs]
            first = np.flatnonzero(np.append(True, np.diff(ends[arcs]) != 0))
            top = np.maximum.reduceat(value, first)
            count = np.diff(np.append(first, len(arcs)))
            total[ends[arcs[first]]] = top + np.log(np.add.reduceat(np.exp(value - np.repeat(top, count)), first))
        log_p = total[start] + weight - total[ends]
        # Cumulative probabilities within a node.
        first = np.flatnonzero(np.append(True, np.diff(ends) != 0))
        count = np.diff(np.append(first, len(ends)))
        log_p[first[count == 1]] = 0.0
        p = np.exp(log_p)
        cumulative = np.cumsum(p)
        within = cumulative - np.repeat(cumulative[first] - p[first], count)
        share = np.minimum(within / np.repeat(within[first + count - 1], count), 1.0)
        share[first + count - 1] = 1.0
        first_of, many_of = np.zeros(size, dtype=np.int64), np.zeros(size, dtype=np.int64)
        first_of[ends[first]], many_of[ends[first]] = arc + first, count
        added = {"length": lengths, "base": node + base, "first": first_of, "many": many_of,
                 "start": start - base[word], "piece": piece, "log_p": log_p, "key": share}
        for name, values in added.items():
            self._append(name, values)


def uniform(key: np.ndarray, a: np.ndarray, b: np.ndarray, c: int) -> np.ndarray:
    """Numbers in (0, 1) that depend on the key and three counters only (a mixed counter)."""
    with np.errstate(over="ignore"):
        x = key + np.uint64(0xA0761D6478BD642F) + a.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + b.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03) + np.uint64(c) * np.uint64(0x8CB92BA72F3D8DD7)
        x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return ((x >> np.uint64(12)).astype(np.float64) + 0.5) * 2.0**-52


class _Path:
    """One drawn path of a document: pieces in the order of decisions (words left to right, each from its end)."""

    __slots__ = ("arcs", "counts", "offsets", "value", "log_p", "fixed", "without")

    def __init__(self, arcs, counts, value, fixed, without):
        self.arcs, self.counts, self.value, self.fixed, self.without = arcs, counts, value, fixed, without
        self.offsets = np.concatenate([[0], np.cumsum(counts)])


class Sampler:
    """``samples`` distinct segmentations of each text of a batch, with scores."""

    def __init__(self, path: str, samples: int = SAMPLES, smoothing: float = SMOOTHING, seed: int = 42):
        self.codec, self.samples, self.smoothing, self.seed = codec_of(path), samples, smoothing, seed
        self.lattice = Lattice(self.codec, smoothing)

    def _draw(self, lattice: Lattice, word: np.ndarray, key: np.ndarray, local: np.ndarray, position: np.ndarray, step: np.ndarray, draw: int) -> tuple[np.ndarray, np.ndarray]:
        """(pieces, how many) drawn backwards from ``position`` of each occurrence, in decision order."""
        todo = np.flatnonzero(position > 0)
        at, count = position.copy(), np.zeros(len(word), dtype=np.int64)
        rounds = []
        while len(todo):
            node = lattice.base[word[todo]] + at[todo]
            u = uniform(key[todo], local[todo], step[todo] + count[todo], draw)
            arc = lattice.first[node]
            # The pieces of a node are few: step on while the cumulative probability is too low.
            on = np.flatnonzero(lattice.key[arc] < u)
            while len(on):
                arc[on] += 1
                on = on[lattice.key[arc[on]] < u[on]]
            rounds.append((todo, arc))
            count[todo] += 1
            at[todo] = lattice.start[arc]
            todo = todo[at[todo] > 0]
        offset = np.concatenate([[0], np.cumsum(count)])
        out = np.zeros(offset[-1], dtype=np.int64)
        for k, (who, arc) in enumerate(rounds):
            out[offset[who] + k] = arc
        return out, count

    def _sets(self, lattice: Lattice, paths: list[_Path], words: list[np.ndarray], keys: list[np.uint64], draw: int) -> list[list[tuple]]:
        """For each path the best sets that the rest of its set falls into, (value, decision, excluded pieces)."""
        if not paths:
            return []
        log_p = np.split(lattice.log_p[np.concatenate([p.arcs for p in paths])], np.cumsum([len(p.arcs) for p in paths])[:-1])
        taken, before, late = [], [], []
        for path, own in zip(paths, log_p, strict=True):
            path.log_p, at = float(own.sum()), path.fixed
            # Sets that leave the path late have hardly any mass; they stay together until they matter.
            sums = np.zeros(min(at + NEAR, len(own)) + 1)
            np.cumsum(own[: len(sums) - 1], out=sums[1:])
            far = at
            if at < len(own):
                far = min(int(np.searchsorted(-sums[at:], FAR_MASS - sums[at], side="left")) + at, len(sums) - 1)
            late.append(far < len(own))
            taken += [own[at:far], np.array([own[far:].sum()] if late[-1] else [])]
            before.append(sums[at : far + late[-1]])
        mass = self._left(np.concatenate(taken)) + np.concatenate(before)
        sizes = np.array([len(x) for x in before], dtype=np.int64)
        ends = np.cumsum(sizes)
        fixed = np.array([p.fixed for p in paths], dtype=np.int64)
        counter = np.arange(len(mass)) + np.repeat(fixed - ends + sizes, sizes)
        counter[ends[late] - 1] = 1 << 43
        lost = {}
        for i, path in enumerate(paths):
            if path.without and path.fixed < len(path.arcs):
                # The first free decision has lost more pieces than the one taken.
                lost[i] = (*path.without, int(path.arcs[path.fixed]))
                node = self._node(lattice, path, words[i], path.fixed)
                left = [k for k in range(lattice.first[node], lattice.first[node] + lattice.many[node]) if k not in lost[i]]
                mass[ends[i] - sizes[i]] = before[i][0] + (np.logaddexp.reduce(lattice.log_p[left]) if left else -np.inf)
        values = self._truncated(mass, np.repeat([p.value for p in paths], sizes), np.repeat(np.array(keys, dtype=np.uint64), sizes), counter, draw)
        found = []
        for i, (path, end) in enumerate(zip(paths, ends, strict=True)):
            value, at = values[end - sizes[i] : end], path.fixed
            n = len(value) - late[i]
            best = np.argpartition(-value[:n], self.samples)[: self.samples + 1] if n > self.samples + 1 else np.arange(n)
            sets = [(float(value[k]), at + k, lost[i] if k == 0 and i in lost else (int(path.arcs[at + k]),)) for k in best.tolist() if value[k] > -np.inf]
            if late[i] and value[n] > -np.inf:
                sets.append((float(value[n]), at + n, None))
            found.append(sets)
        return found

    @staticmethod
    def _left(log_p: np.ndarray) -> np.ndarray:
        """Log probability of not taking a decision."""
        with np.errstate(divide="ignore"):
            return np.log(-np.expm1(np.minimum(log_p, 0.0)))

    @staticmethod
    def _truncated(mass: np.ndarray, limit: np.ndarray, key: np.ndarray, counter: np.ndarray, draw: int) -> np.ndarray:
        """Gumbel values at the masses, truncated at the limits."""
        u = uniform(key, counter, np.full(len(mass), 1 << 40), draw)
        value = -np.logaddexp(-limit, -(mass - np.log(-np.log(u))))
        value[np.isneginf(mass)] = -np.inf
        return value

    def _split(self, lattice: Lattice, path: _Path, value: float, far: int, key: np.uint64, draw: int) -> list[tuple]:
        """The single sets of those kept together: one has their value, the others less."""
        log_p = lattice.log_p[path.arcs[far:]]
        mass = np.concatenate([[0.0], np.cumsum(log_p)[:-1]]) + self._left(log_p)
        n = len(mass)
        gumbel = mass - np.log(-np.log(uniform(np.full(n, key), np.arange(far, far + n), np.full(n, 1 << 44), draw)))
        first = int(gumbel.argmax())
        with np.errstate(divide="ignore", over="ignore"):
            # Given the maximum, the other values are truncated at it.
            shift = np.exp(-value) - np.exp(-gumbel[first]) + np.exp(-gumbel)
            values = -np.log(np.maximum(shift, np.exp(-value)))
        values[np.isneginf(mass)] = -np.inf
        values[first] = value
        best = np.argsort(-values, kind="stable")[: self.samples + 1]
        return [(float(values[i]), far + int(i), (int(path.arcs[far + i]),)) for i in best if values[i] > -np.inf]

    @staticmethod
    def _node(lattice: Lattice, path: _Path, word: np.ndarray, decision: int) -> int:
        """The node at which a decision is taken."""
        o = int(np.searchsorted(path.offsets, decision, side="right")) - 1
        position = lattice.length[word[o]] if decision == path.offsets[o] else lattice.start[path.arcs[decision - 1]]
        return int(lattice.base[word[o]] + position)

    def __call__(self, keys: list[int], texts: list[str]) -> list[list[dict]]:
        """For each text its segmentations: ids, log_prob, perturbed value, inclusion probability."""
        if len(self.lattice.number) > KEPT_WORDS:
            self.lattice = Lattice(self.codec, self.smoothing)
        lattice = self.lattice
        words = [lattice.words_of(t) for t in texts]
        lattice.extend()
        key = (np.array([k & 0xFFFFFFFFFFFFFFFF for k in keys], dtype=np.uint64) ^ np.uint64(self.seed)) * np.uint64(0xFF51AFD7ED558CCD)
        n = len(texts)
        sizes = np.array([len(w) for w in words], dtype=np.int64)
        flat = np.concatenate(words) if n else np.zeros(0, dtype=np.int64)
        local = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        arcs, counts = self._draw(lattice, flat, np.repeat(key, sizes), local, lattice.length[flat], np.zeros(len(flat), dtype=np.int64), 0)
        ends, word_ends = np.cumsum(counts), np.cumsum(sizes)
        root = -np.log(-np.log(uniform(key, np.zeros(n), np.full(n, 1 << 41), 0)))
        paths: list[list[_Path]] = []
        queues: list[list[tuple]] = []
        for d in range(n):
            a, b = (word_ends[d] - sizes[d], word_ends[d])
            lo, hi = (ends[a - 1] if a else 0), (ends[b - 1] if b else 0)
            path = _Path(arcs[lo:hi], counts[a:b], float(root[d]), 0, ())
            paths.append([path])
        for sets in self._sets(lattice, [p[0] for p in paths], words, list(key), 0):
            queues.append([(*s, 0) for s in sets])
        for draw in range(1, self.samples):
            # The best set of every document: what is free after its decision is drawn for all at once.
            jobs = []
            for d in range(n):
                if not queues[d]:
                    continue
                while True:
                    best = max(range(len(queues[d])), key=lambda i: queues[d][i][0])
                    value, decision, excluded, parent = queues[d].pop(best)
                    path = paths[d][parent]
                    if excluded is not None:
                        break
                    queues[d] += [(*s, parent) for s in self._split(lattice, path, value, decision, key[d], draw)]
                o = int(np.searchsorted(path.offsets, decision, side="right")) - 1
                node = self._node(lattice, path, words[d], decision)
                left = np.array([i for i in range(lattice.first[node], lattice.first[node] + lattice.many[node]) if i not in excluded])
                p = np.cumsum(np.exp(lattice.log_p[left] - lattice.log_p[left].max()))
                u = uniform(key[d : d + 1], np.array([decision]), np.array([1 << 42]), draw)[0]
                jobs.append((d, path, value, decision, excluded, o, int(left[min(len(left) - 1, int(np.searchsorted(p, u * p[-1])))])))
            if not jobs:
                break
            word = np.concatenate([words[d][o:] for d, _, _, _, _, o, _ in jobs])
            free = np.array([sizes[d] - o for d, _, _, _, _, o, _ in jobs])
            head = np.cumsum(free) - free
            index = np.concatenate([np.arange(o, sizes[d]) for d, _, _, _, _, o, _ in jobs])
            position, step = lattice.length[word].copy(), np.zeros(len(word), dtype=np.int64)
            position[head] = lattice.start[[j[6] for j in jobs]]
            step[head] = [j[3] - j[1].offsets[j[5]] + 1 for j in jobs]
            arcs, counts = self._draw(lattice, word, np.repeat(key[[j[0] for j in jobs]], free), index, position, step, draw)
            ends = np.cumsum(counts)
            for (d, parent, value, decision, excluded, o, arc), a, size in zip(jobs, head, free, strict=True):
                lo, hi = (ends[a - 1] if a else 0), ends[a + size - 1]
                taken = decision - parent.offsets[o] + 1
                path = _Path(np.concatenate([parent.arcs[:decision], [arc], arcs[lo:hi]]), np.concatenate([parent.counts[:o], [counts[a] + taken], counts[a + 1 : a + size]]), value, decision, excluded)
                paths[d].append(path)
            drawn = [j[0] for j in jobs]
            for d, sets in zip(drawn, self._sets(lattice, [paths[d][-1] for d in drawn], [words[d] for d in drawn], [key[d] for d in drawn], draw), strict=True):
                queues[d] += [(*s, len(paths[d]) - 1) for s in sets]
        pieces = iter(self._pieces(lattice, [p for found in paths for p in found]))
        return [[self._row(p, next(pieces), queue) for p in found] for found, queue in zip(paths, queues, strict=True)]

    @staticmethod
    def _pieces(lattice: Lattice, paths: list[_Path]) -> list[np.ndarray]:
        """The pieces of each path from left to right."""
        if not paths:
            return []
        # Decisions run from the end of each word: reading order turns every word around.
        counts = np.concatenate([p.counts for p in paths])
        ends = np.cumsum(counts)
        arcs = np.concatenate([p.arcs for p in paths])
        last = np.repeat(2 * ends - 1 - counts, counts)
        return np.split(lattice.piece[arcs[last - np.arange(len(arcs))]], np.cumsum([len(p.arcs) for p in paths])[:-1])

    def _row(self, path: _Path, piece: np.ndarray, queue: list[tuple]) -> dict:
        odd = np.flatnonzero(piece < 0)
        ids = self.codec.ids[np.maximum(piece, 0)]
        if len(odd):
            out, at = [], 0
            for i in odd.tolist():
                out += [ids[at:i], np.array([self.codec.byte_ids[b] for b in chr(-1 - int(piece[i])).encode("utf-8", "surrogatepass")], dtype=np.int32)]
                at = i + 1
            ids = np.concatenate([*out, ids[at:]])
        limit = max((s[0] for s in queue), default=-np.inf)
        return {"ids": ids, "log_prob": path.log_p, "perturbed": path.value, "inclusion": float(-np.expm1(-np.exp(min(path.log_p - limit, 700.0)))) if limit > -np.inf else 1.0}


def sample_segmentations(docs: DataFrame, model: str, samples: int = SAMPLES, smoothing: float = SMOOTHING, seed: int = 42, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Up to ``samples`` distinct segmentations of every whole text, one row each.

    Columns: doc_id, sample (from 1, by falling perturbed value), ids, n_pieces, log_prob (of the
    segmentation among all of the text), perturbed, inclusion (probability that a draw above the
    first value left out holds it), round_trip (the ids decode to the text). The draw depends on
    the id, the text's words and ``seed`` only, so repeated rows get equal rows. NULL and empty texts have
    one segmentation, without pieces; a NULL id draws as 0; extra columns are ignored; an empty
    table gives no rows.
    """
    source = pick(docs, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("long"), F.col("text").cast("string"))

    def start():
        sampler = Sampler(model, samples, smoothing, seed)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            keys, texts = batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()]
            rows = [(k, i + 1, s, t) for k, t, found in zip(keys, texts, sampler([k or 0 for k in keys], texts), strict=True) for i, s in enumerate(found)]
            decode = sampler.codec.decode
            offsets = np.concatenate([[0], np.cumsum([len(s["ids"]) for _, _, s, _ in rows])]).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([s["ids"] for _, _, s, _ in rows]).astype(np.int32)))
            return pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int32()), ids, pa.array(np.diff(offsets)),
                 *(pa.array([r[2][c] for r in rows], pa.float64()) for c in ("log_prob", "perturbed", "inclusion")),
                 pa.array([decode(s["ids"]) == t for _, _, s, t in rows])],
                names=["doc_id", "sample", "ids", "n_pieces", "log_prob", "perturbed", "inclusion", "round_trip"])

        return step

    return map_batches(source, start, "doc_id long, sample int, ids array<int>, n_pieces int, log_prob double, perturbed double, inclusion double, round_trip boolean", rows=400)


def decode_ids(rows: DataFrame, model: str, ids_col: str = "ids") -> DataFrame:
    """``rows`` with the column ``decoded``: the text of the ids, NULL for NULL.

    A column of that name (in any case) is replaced; other columns stay, repeated rows come back as
    often, an empty table stays empty.
    """
    at = position(rows.columns, ids_col)
    rest = [i for i, n in enumerate(rows.columns) if n.lower() != "decoded"]
    fields = T.StructType([*[rows.schema.fields[i] for i in rest], T.StructField("decoded", T.StringType())])

    def start():
        codec = codec_of(model)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = [None if ids is None else codec.decode(ids) for ids in batch.column(at).to_pylist()]
            return pa.RecordBatch.from_arrays([*[batch.column(i) for i in rest], pa.array(texts, pa.string())], names=fields.names)

        return step

    return map_batches(rows, start, fields)
