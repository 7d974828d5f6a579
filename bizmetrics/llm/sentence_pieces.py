"""SentencePiece sampling without replacement, and decoding.

A text's lattice has an edge for every piece that matches at a place; a segmentation is a path, with a probability in proportion to
the product of its pieces' weights. ``sample`` returns, per text, the k segmentations with the largest Gumbel-perturbed log probabilities: k different ones,
drawn without replacement. They come out of a best-first search over subtrees of paths that begin alike:

* The perturbed maximum of all paths is a Gumbel variable, and the path that has it is an ordinary sample, drawn edge by edge.
* Along a path, what branches off at each edge is a subtree whose mass is known from the lattice's backward sums. Its perturbed maximum is a Gumbel
  variable at its log mass, truncated at that of the path. These subtrees are the frontier.
* The frontier's largest is taken next: an edge that was not taken there is drawn, the path is sampled on to the end, and leaves subtrees of its own.

The (k + 1)-th value is the threshold; a path's inclusion score is the probability that its own value exceeds it, in logarithms since those of long texts underflow.
All random numbers are hashes of the row's key, the sample and the place, so results do not depend on batches, partitions or attempts.

Paths cross no border between segments (runs of letters or of other characters, each with the spaces before it), which the model's pieces do not
either; that is checked when the model is loaded. So a task builds the lattice of a segment once and keeps it for later texts, up to a bound, and all segments of a slice advance together.
BPE models have ranks, not probabilities: the weight of rank r is (r + 1) ** -``POWER``. Characters without a piece are bytes.

Edge cases: null and empty texts have one segmentation, without pieces; a text with fewer than k segmentations returns them all, with score 0 (certain); rows with
the same key and text return the same samples; a null key is a key of its own; U+2581 decodes as a space; columns besides key and text are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bizmetrics.llm.common import give_back, mix64, ship_package, slices, utf8
from bizmetrics.llm.token_blocks import _ranges

SAMPLES = 2
POWER = 0.5
BEYOND = 45.0
SPACE = "▁"
SLICE_BYTES = 700_000
KEPT_CHARACTERS = 300_000  # of different segments; what a task keeps of lattices grows to some 30 MB, until its end
#: Runs of letters or of other characters, with the spaces before them.
SEGMENT = re.compile(f"{SPACE}*(?:[^\\W\\d_¹²³¼½¾]+|(?:[^\\w{SPACE}]|[\\d_¹²³¼½¾])+|$)")
_LOADED: dict[tuple[str, float], Model] = {}


def around(first: np.ndarray, edge: int) -> tuple[int, int]:
    """The edges of an edge's node."""
    node = int(np.searchsorted(first, edge, side="right")) - 1
    return int(first[node]), int(first[node + 1])


class Model:
    """The pieces of a model as a trie in a hash table, their weights, and their bytes."""

    def __init__(self, path: str, power: float = POWER) -> None:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        count = sp.get_piece_size()
        self.lattice: Lattice | None = None
        self.byte_ids = np.full(256, -1, np.int64)
        pieces: dict[str, int] = {}
        self.texts: list[bytes] = []
        for i in range(count):
            piece = sp.id_to_piece(i)
            self.texts.append(b"")
            if sp.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                self.texts[i] = bytes([int(piece[3:5], 16)])
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                pieces[piece] = i
                self.texts[i] = piece.replace(SPACE, " ").encode()
        if (self.byte_ids < 0).any():
            raise ValueError("the model has no bytes to fall back on")
        if crossing := [p for p in pieces if len(SEGMENT.findall(p.rstrip(SPACE))) > 2 or (p.strip(SPACE) and p.endswith(SPACE))]:
            raise ValueError(f"pieces cross segments: {crossing[:5]}")
        probe = "a  b ﬁ Ａé "
        if sp.encode(probe) and sp.decode(sp.encode(probe)) != probe:
            raise ValueError("the model changes texts before it cuts them, which is not supported")
        scores = np.array([sp.get_score(i) for i in range(count)])
        ranked = scores[list(pieces.values())]
        # Scores of a unigram model are log probabilities; those of a BPE model count merges down from 0.
        logs = np.array([-power * np.log1p(-s) for s in scores]) if len(ranked) and ranked.min() < -1000 else scores * power
        self.byte_weight = float(logs[list(pieces.values())].min())
        # Trie: (state, character) -> state.
        steps: dict[tuple[int, int], int] = {}
        final: list[int] = [-1]
        for piece, i in pieces.items():
            state = 0
            for c in map(ord, piece):
                if (state, c) not in steps:
                    steps[state, c] = len(final)
                    final.append(-1)
                state = steps[state, c]
            final[state] = i
        self.final, self.final_weight = np.array(final), logs
        self.size = 1 << max(4, int(np.ceil(np.log2(4 * len(steps) + 1))))
        self.table_key, self.table_to = np.full(self.size, -1, np.int64), np.zeros(self.size, np.int64)
        for (state, c), to in steps.items():
            key = state << 21 | c
            slot = int(self._slots(np.array([key]))[0])
            while self.table_key[slot] >= 0:
                slot = (slot + 1) % self.size
            self.table_key[slot], self.table_to[slot] = key, to
        lengths = np.fromiter(map(len, self.texts), np.int64, count)
        self.byte_count, self.byte_start = lengths, np.cumsum(lengths) - lengths
        self.bytes = np.frombuffer(b"".join(self.texts), np.uint8)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return (mix64(keys.astype(np.uint64)) & np.uint64(self.size - 1)).astype(np.int64)

    def step(self, states: np.ndarray, characters: np.ndarray) -> np.ndarray:
        """The next states; -1 where the trie has none."""
        keys = states << 21 | characters
        slots = self._slots(keys)
        held = self.table_key[slots]
        out = np.where(held == keys, self.table_to[slots], -1)
        open_ = np.flatnonzero((held != keys) & (held >= 0))
        while len(open_):
            slots[open_] = (slots[open_] + 1) % self.size
            held = self.table_key[slots[open_]]
            found = held == keys[open_]
            out[open_[found]] = self.table_to[slots[open_[found]]]
            open_ = open_[~found & (held >= 0)]
        return out

    def lattice_of(self, words: Iterable[str]) -> Lattice:
        """A lattice that has these segments: the one at hand, or a new one when that is full. Neither changes what a segment's own lattice is."""
        new = [word for word in words if self.lattice is None or word not in self.lattice.numbers]
        if self.lattice is None or self.lattice.characters and self.lattice.characters + sum(map(len, new)) > KEPT_CHARACTERS:
            self.lattice = Lattice(self)
            new = list(words)
        self.lattice.add(new)
        return self.lattice

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of ids, and how many each has; a text's first space is the model's own."""
        sizes = self.byte_count[ids]
        return self.bytes[_ranges(self.byte_start[ids], sizes)], sizes


def load(path: str, power: float = POWER) -> Model:
    """The model, kept by the worker."""
    if (path, power) not in _LOADED:
        _LOADED[path, power] = Model(path, power)
    return _LOADED[path, power]


def segments(text: str | None) -> list[str]:
    """The text as the model sees it, in segments."""
    if not text:
        return []
    found = SEGMENT.findall(SPACE + text.replace(" ", SPACE))
    return found if found[-1] else found[:-1]  # at the end the pattern also matches nothing


class Growing:
    """An array that is added to at its end."""

    def __init__(self, kind) -> None:
        self.held, self.size = np.empty(1 << 16, kind), 0

    def extend(self, values: np.ndarray) -> None:
        if self.size + len(values) > len(self.held):
            larger = np.empty(max(2 * len(self.held), self.size + len(values)), self.held.dtype)
            larger[: self.size] = self.held[: self.size]
            self.held = larger
        self.held[self.size : self.size + len(values)] = values
        self.size += len(values)

    @property
    def array(self) -> np.ndarray:
        return self.held[: self.size]


class Lattice:
    """The lattices of the segments seen so far, laid one after another: a node per character, edges by node, the longest piece first."""

    PARTS = {
        "begins": np.int64, "ends": np.int64, "first": np.int64, "chance": np.float64, "total": np.float64,
        "length": np.int8, "id_count": np.int8, "id_start": np.int32, "ids": np.int32, "only": np.bool_,
    }

    def __init__(self, model: Model) -> None:
        self.model = model
        self.numbers: dict[str, int] = {}
        self.parts = {name: Growing(kind) for name, kind in self.PARTS.items()}
        self.parts["first"].extend(np.zeros(1, np.int64))
        self.parts["ids"].extend(np.arange(len(model.final_weight)))

    def __getattr__(self, name: str) -> np.ndarray:
        if name in Lattice.PARTS:
            return self.parts[name].array
        raise AttributeError(name)

    @property
    def characters(self) -> int:
        return self.parts["first"].size - 1

    def add(self, words: Sequence[str]) -> None:
        """Lay the lattices of new segments behind those that are there."""
        model = self.model
        self.numbers.update(zip(words, range(len(self.numbers), len(self.numbers) + len(words)), strict=True))
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(lengths)
        characters = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        nodes = len(characters)
        left = np.repeat(ends, lengths) - np.arange(nodes)
        # Pieces that match, by length: all nodes walk down the trie together.
        found: list[tuple[np.ndarray, np.ndarray]] = []
        at, states, size = np.arange(nodes), np.zeros(nodes, np.int64), 0
        while len(at):
            states = model.step(states, characters[at + size])
            size += 1
            on = states >= 0
            at, states = at[on], states[on]
            last = model.final[states]
            done = last >= 0
            found.append((at[done], last[done]))
            inside = left[at] > size
            at, states = at[inside], states[inside]
        # Characters without a piece have an edge of bytes.
        lost = np.ones(nodes, bool)
        if found:
            lost[found[0][0]] = False
        lost = np.flatnonzero(lost)
        raw = [chr(c).encode("utf-8", "surrogatepass") for c in characters[lost]]
        byte_counts = np.fromiter(map(len, raw), np.int64, len(raw))
        degree = np.zeros(nodes, np.int64)
        for own, _ in found:
            degree[own] += 1
        degree[lost] += 1
        first = np.concatenate([[0], np.cumsum(degree)])
        edges = int(first[-1])
        length, id_count = np.ones(edges, np.int64), np.ones(edges, np.int64)
        weight, id_start = np.empty(edges), np.empty(edges, np.int64)
        free = first[:-1].copy()
        for size, (own, piece) in reversed(list(enumerate(found, 1))):
            place = free[own]
            length[place], weight[place], id_start[place] = size, model.final_weight[piece], piece
            free[own] += 1
        place = free[lost]
        weight[place], id_count[place] = model.byte_weight * byte_counts, byte_counts
        id_start[place] = self.parts["ids"].size + np.cumsum(byte_counts) - byte_counts
        # Backward sums: the log mass of all paths from a node to its segment's end, nearest the end first.
        mass, chance = np.zeros(nodes), np.empty(edges)
        by_left = np.argsort(left.astype(np.int16 if nodes and left.max() < 1 << 15 else np.int64), kind="stable")
        cuts = np.searchsorted(left[by_left], np.arange(1, int(left.max()) + 2)) if nodes else []
        for begin, stop in zip(cuts, cuts[1:], strict=False):
            own = by_left[begin:stop]
            many = degree[own]
            which, starts = _ranges(first[own], many), np.cumsum(many) - many
            source = np.repeat(own, many)
            to = source + length[which]
            value = weight[which] + np.where(length[which] < left[source], mass[np.minimum(to, nodes - 1)], 0.0)
            top = np.maximum.reduceat(value, starts) if len(own) else value
            shares = np.exp(value - np.repeat(top, many))
            total = np.add.reduceat(shares, starts) if len(own) else shares
            mass[own] = top + np.log(total)
            chance[which] = shares / np.repeat(total, many)
        # Cumulative chances of a node's edges; the last is beyond every random number.
        total = chance.copy()
        more, rank = np.flatnonzero(degree > 1), 1
        while len(more):
            own = first[more] + rank
            total[own] += total[own - 1]
            rank += 1
            more = more[degree[more] > rank]
        total[first[1:] - 1] = np.inf
        made = {
            "begins": ends - lengths + self.characters,
            "ends": ends + self.characters,
            "first": first[1:] + self.parts["chance"].size,
            "chance": chance,
            "total": total,
            "length": length,
            "id_count": id_count,
            "id_start": id_start,
            "ids": model.byte_ids[np.frombuffer(b"".join(raw), np.uint8)],
            "only": np.repeat(degree == 1, degree),
        }
        for name, values in made.items():
            self.parts[name].extend(values)

    def log_others(self, edges: np.ndarray) -> np.ndarray:
        """The log mass of the other edges of each edge's node."""
        own = self.chance[edges]
        rest = 1.0 - own
        rest[self.only[edges]] = 0.0
        for i in np.flatnonzero((own > 1 - 1e-6) & ~self.only[edges]).tolist():  # the difference has lost its digits there
            begin, stop = around(self.first, int(edges[i]))
            rest[i] = sum(float(self.chance[e]) for e in range(begin, stop) if e != edges[i])
        with np.errstate(divide="ignore"):
            return np.log(rest)

    def draw(self, nodes: np.ndarray, chances: np.ndarray) -> np.ndarray:
        """An edge of each node."""
        edges = self.first[nodes]
        more = np.flatnonzero(chances >= self.total[edges])
        while len(more):
            edges[more] += 1
            more = more[chances[more] >= self.total[edges[more]]]
        return edges

    def paths(self, begins: np.ndarray, ends: np.ndarray, seeds: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sampled paths from nodes to segments' ends: their edges one after another, and how many each has. ``order`` only helps the memory."""
        at, end, seed, who = begins[order], ends[order], seeds[order], order
        counts = np.zeros(len(begins), np.int64)
        taken = []
        going = np.flatnonzero(at < end)
        at, end, seed, who = at[going], end[going], seed[going], who[going]
        step = 0
        while len(at):
            edges = self.draw(at, uniform(seed, step))
            taken.append((who, edges))
            counts[who] += 1
            at = at + self.length[edges]
            on = at < end
            at, end, seed, who = at[on], end[on], seed[on], who[on]
            step += 1
        out = np.empty(int(counts.sum()), np.int64)
        starts = np.cumsum(counts) - counts
        for step, (own, edges) in enumerate(taken):
            out[starts[own] + step] = edges
        return out, counts


def uniform(seeds: np.ndarray, step: int | np.ndarray) -> np.ndarray:
    """A number in (0, 1) for each seed."""
    bits = mix64(seeds + (np.asarray(step).astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
    return ((bits >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def truncated(log_mass: np.ndarray, chances: np.ndarray, top: np.ndarray) -> np.ndarray:
    """Gumbel variables at these log masses, given that they do not exceed ``top``."""
    return -np.logaddexp(-top, np.log(-np.log(chances)) - log_mass)


class Paths:
    """A path in each of some texts, and the frontier it leaves."""

    def __init__(self, texts: np.ndarray, edges: np.ndarray, counts: np.ndarray, value: np.ndarray, lattice: Lattice) -> None:
        self.texts, self.edges, self.value = texts, edges, value
        self.ends = np.cumsum(counts)
        self.begins = self.ends - counts
        log = np.log(lattice.chance[edges])
        running = np.cumsum(log)
        base = np.concatenate([[0.0], running])[self.begins]
        self.before = running - log - np.repeat(base, counts)
        self.log_prob = np.concatenate([[0.0], running])[self.ends] - base
        self.frontier = np.full(len(edges), -np.inf)

    def leave(self, lattice: Lattice, seeds: np.ndarray, since: np.ndarray | None = None) -> None:
        """Perturbed maxima of the subtrees that branch off, from edge ``since`` of each text on.

        Far down a long text all subtrees together are lighter than a random number can resolve. They are only looked at if nothing
        before them has a value that they could not exceed but with a probability under e ** -``BEYOND``.
        """
        counts = self.ends - self.begins
        place = np.arange(len(self.edges)) - np.repeat(self.begins, counts)
        ahead = np.ones(len(self.edges), bool) if since is None else place >= np.repeat(since, counts)
        near = self.before > -2 * BEYOND
        self._perturb(lattice, seeds, place, counts, np.flatnonzero(ahead & near))
        tops = np.array([self.best(i)[0] for i in range(len(counts))])
        low = np.repeat(tops < -BEYOND, counts)
        self._perturb(lattice, seeds, place, counts, np.flatnonzero(ahead & ~near & low))

    def _perturb(self, lattice: Lattice, seeds: np.ndarray, place: np.ndarray, counts: np.ndarray, own: np.ndarray) -> None:
        mass = self.before[own] + lattice.log_others(self.edges[own])
        own, mass = own[mass > -np.inf], mass[mass > -np.inf]
        text = np.searchsorted(self.ends, own, side="right")
        self.frontier[own] = truncated(mass, uniform(seeds[text], place[own]), self.value[text])

    def best(self, i: int) -> tuple[float, int]:
        """The frontier's largest value for the i-th of these texts, and its place in the path."""
        own = self.frontier[self.begins[i] : self.ends[i]]
        if not len(own):
            return -np.inf, -1
        at = int(own.argmax())
        return float(own[at]), at


def _seeds(keys: Sequence[str | None], salt: int) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(b"\0null" if k is None else k.encode(), seed=salt) for k in keys), np.uint64, len(keys))


class Sampler:
    """The samples of some texts, searched together."""

    def __init__(self, model: Model, keys: Sequence[str | None], texts: Sequence[str | None], k: int, salt: int = 0) -> None:
        self.model, self.k = model, k
        self.word, self.n_words = self._words(texts)
        self.word_ends = np.cumsum(self.n_words)
        self.order = np.argsort(self.word, kind="stable")
        seeds = _seeds(keys, salt)
        self.path_seed = [mix64(seeds + np.uint64(4 * s + 1)) for s in range(k)]
        self.rest_seed = [mix64(seeds + np.uint64(4 * s + 2)) for s in range(k)]
        self.draw_seed = [mix64(seeds + np.uint64(4 * s + 3)) for s in range(k)]
        with np.errstate(over="ignore"):
            self.found = self._search(seeds)

    def _words(self, texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The texts' segments by number, and how many each has."""
        words = list(map(segments, texts))
        flat = list(chain.from_iterable(words))
        self.lattice = self.model.lattice_of(dict.fromkeys(flat))
        return np.fromiter(map(self.lattice.numbers.__getitem__, flat), np.int64, len(flat)), np.fromiter(map(len, words), np.int64, len(words))

    def _fresh(self, sample: int, texts: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Number, seed and text of the segments from each text's ``first`` on."""
        many = self.n_words[texts] - first
        which = _ranges(self.word_ends[texts] - many, many)
        own = np.repeat(np.arange(len(texts)), many)
        place = which - (self.word_ends - self.n_words)[texts][own]
        seeds = mix64(self.path_seed[sample][texts][own] + place.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))
        return which, seeds, own

    def _search(self, seeds: np.ndarray) -> list[Paths]:
        lattice, every = self.lattice, np.arange(len(self.n_words))
        _, seed, own = self._fresh(0, every, np.zeros(len(every), np.int64))
        edges, counts = lattice.paths(lattice.begins[self.word], lattice.ends[self.word], seed, self.order)
        value = -np.log(-np.log(uniform(seeds, 0)))
        per_text = np.bincount(own, counts, len(every)).astype(np.int64)
        paths = [Paths(every, edges, per_text, value, lattice)]
        paths[0].leave(lattice, self.rest_seed[0])
        # Per text: which path's frontier is best; edges of a frontier place that are taken already.
        heads = [[(*paths[0].best(i), 0)] for i in range(len(every))]
        where = [np.arange(len(every))]
        taken: dict[tuple[int, int, int], list[int]] = {}
        for s in range(1, self.k):
            rows, parents, places, values, edge, prefix = [], [], [], [], [], []
            for i in range(len(every)):
                top, at, parent = max(heads[i])
                if top == -np.inf:
                    continue
                j = int(where[parent][i])
                path = paths[parent]
                e = int(path.edges[path.begins[j] + at])
                gone = taken.setdefault((i, parent, at), [e])
                new = self._other(i, s, gone)
                taken[i, s, at] = [*gone, new]
                path.frontier[path.begins[j] + at] = -np.inf
                heads[i][parent] = (*path.best(j), parent)
                rows.append(i)
                parents.append(parent)
                places.append(at)
                values.append(top)
                edge.append(new)
                prefix.append(path.edges[path.begins[j] : path.begins[j] + at])
            paths.append(self._branch(s, np.array(rows, np.int64), prefix, np.array(edge, np.int64), np.array(values)))
            where.append(np.full(len(every), -1))
            where[s][rows] = np.arange(len(rows))
            at = np.array(places, np.int64)
            paths[s].leave(lattice, self.rest_seed[s][rows], at + 1)
            for j, i in enumerate(rows):
                self._leave_rest(paths[s], j, int(at[j]), taken[i, s, int(at[j])], self.draw_seed[s][i])
                for p in range(len(heads[i]), s):  # paths this text does not have
                    heads[i].append((-np.inf, -1, p))
                heads[i].append((*paths[s].best(j), s))
        self.threshold = np.array([max(h)[0] for h in heads]) if heads else np.empty(0)
        return paths

    def _other(self, i: int, sample: int, gone: list[int]) -> int:
        """An edge of the same node that is not in ``gone``."""
        first, last = around(self.lattice.first, gone[0])
        left = [e for e in range(first, last) if e not in gone]
        chances = np.cumsum(self.lattice.chance[left])
        u = float(uniform(self.draw_seed[sample][i : i + 1], 0)[0])
        return left[min(int(np.searchsorted(chances, u * chances[-1], side="right")), len(left) - 1)]

    def _leave_rest(self, path: Paths, j: int, at: int, gone: list[int], seed: np.uint64) -> None:
        """What is still left where the path branched off."""
        first, last = around(self.lattice.first, gone[0])
        mass = sum(float(self.lattice.chance[e]) for e in range(first, last) if e not in gone)
        if mass > 0:
            place = path.begins[j] + at
            log_mass = np.array([path.before[place] + np.log(mass)])
            path.frontier[place] = truncated(log_mass, uniform(np.array([seed]), 1), path.value[j : j + 1])[0]

    def _branch(self, sample: int, rows: np.ndarray, prefix: list[np.ndarray], edge: np.ndarray, values: np.ndarray) -> Paths:
        """Paths that begin as ``prefix`` and ``edge`` say and are sampled from there."""
        lattice = self.lattice
        ahead = np.fromiter(map(len, prefix), np.int64, len(prefix))
        reached = np.fromiter((int(lattice.length[p].sum()) for p in prefix), np.int64, len(prefix)) + lattice.length[edge]
        # The segment in which the branch ends, and the place there.
        sizes = (lattice.ends - lattice.begins)[self.word]
        run = np.concatenate([[0], np.cumsum(sizes)])
        base = run[(self.word_ends - self.n_words)[rows]]
        segment = np.searchsorted(run, base + reached, side="left") - 1  # the branch ends in it, or at its end
        inside = base + reached - run[segment]
        first = segment - (self.word_ends - self.n_words)[rows]
        which, seed, own = self._fresh(sample, rows, first + 1)
        number = np.full(len(self.word), -1)
        number[which] = len(rows) + np.arange(len(which))
        order = number[self.order]
        order = np.concatenate([np.arange(len(rows)), order[order >= 0]])
        part = lattice.begins[self.word[segment]] + inside
        part_seed = mix64(self.path_seed[sample][rows] + first.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))
        # The rest of the branch's own segment, then the following ones.
        edges, counts = lattice.paths(
            np.concatenate([part, lattice.begins[self.word[which]]]), np.concatenate([lattice.ends[self.word[segment]], lattice.ends[self.word[which]]]), np.concatenate([part_seed, seed]), order
        )
        starts = np.cumsum(counts) - counts
        part_count, rest_count = counts[: len(rows)], np.bincount(own, counts[len(rows) :], len(rows)).astype(np.int64)
        rest_start = np.cumsum(rest_count) - rest_count + int(part_count.sum())
        pieces = np.concatenate([*prefix, edge, edges]) if len(rows) else np.empty(0, np.int64)
        known, chosen = int(ahead.sum()), len(edge)
        begins = np.stack([np.cumsum(ahead) - ahead, known + np.arange(chosen), known + chosen + starts[: len(rows)], known + chosen + rest_start], axis=1)
        lengths = np.stack([ahead, np.ones(chosen, np.int64), part_count, rest_count], axis=1)
        return Paths(rows, pieces[_ranges(begins.ravel(), lengths.ravel())], lengths.sum(axis=1), values, lattice)

    def ids(self, sample: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of a sample's paths, one after another, and how many each has."""
        path, lattice = self.found[sample], self.lattice
        many = lattice.id_count[path.edges]
        out = lattice.ids[_ranges(lattice.id_start[path.edges], many)]
        run = np.concatenate([[0], np.cumsum(many)])
        return out, run[path.ends] - run[path.begins]


def log_inclusion(log_prob: np.ndarray, threshold: np.ndarray) -> np.ndarray:
    """log(1 - exp(-exp(log_prob - threshold))), also where that is too small for a number."""
    x = log_prob - threshold
    with np.errstate(over="ignore", divide="ignore"):
        return np.where(x < -30, x, np.log(-np.expm1(-np.exp(np.minimum(x, 700.0)))))


SCHEMA = "sample int, n_tokens long, log_prob double, perturbed double, log_inclusion double, ids_crc32 long, round_trip boolean"


def sample(texts: DataFrame, model: str, k: int = SAMPLES, salt: int = 0, power: float = POWER, id_column: str = "doc_id", text_column: str = "text", ids: bool = True) -> DataFrame:
    """Up to k rows per text: its id, the sample's number, ``ids`` if wanted, log probability, perturbed value, log inclusion score, and a checksum.

    ``round_trip`` says whether the ids decode to the text.
    """
    ship_package(texts.sparkSession)
    kind = texts.schema[id_column].dataType.simpleString()
    given = texts.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{id_column}`").cast("string").alias("key"), F.col(f"`{text_column}`").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = load(model, power)
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                own = part.column("text").to_pylist()
                sampler = Sampler(pieces, part.column("key").to_pylist(), own, k, salt)
                for s, path in enumerate(sampler.found):
                    flat, counts = sampler.ids(s)
                    data, sizes = pieces.decode(flat)
                    cuts = np.concatenate([[0], np.cumsum(counts)])
                    run_bytes = np.concatenate([[0], np.cumsum(sizes)])[cuts]
                    raw, whole = flat.astype("<u4").tobytes(), data.tobytes()
                    crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
                    same = [whole[a + 1 : b] == utf8(own[t].replace(SPACE, " ") if own[t] else "") for t, a, b in zip(path.texts.tolist(), run_bytes[:-1].tolist(), run_bytes[1:].tolist(), strict=True)]
                    score = log_inclusion(path.log_prob, sampler.threshold[path.texts])
                    columns = [
                        part.column("id").take(pa.array(path.texts)),
                        pa.array(np.full(len(path.texts), s), pa.int32()),
                        pa.array(counts, pa.int64()),
                        pa.array(path.log_prob),
                        pa.array(path.value),
                        pa.array(score),
                        pa.array(crc, pa.int64()),
                        pa.array(same, pa.bool_()),
                    ]
                    names = ["id", "sample", "n_tokens", "log_prob", "perturbed", "log_inclusion", "ids_crc32", "round_trip"]
                    if ids:
                        columns.append(pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(flat, pa.int32())))
                        names.append("ids")
                    yield pa.RecordBatch.from_arrays(columns, names=names)
        pieces.lattice = None  # the worker may go on to other work
        give_back()

    schema = f"id {kind}, {SCHEMA}" + ", ids array<int>" * ids
    return given.mapInArrow(run, schema).withColumnRenamed("id", id_column)


def decode(rows: DataFrame, model: str, ids_column: str = "ids") -> DataFrame:
    """``rows`` with ``text`` in place of the ids; a null or empty list is an empty text."""
    ship_package(rows.sparkSession)

    @F.pandas_udf("string")
    def text_of(lists):
        pieces = load(model)
        texts = []
        for own in lists:
            data, _ = pieces.decode(np.asarray(own if own is not None else [], np.int64))
            texts.append(data.tobytes()[1:].decode("utf-8", "replace"))
        return lists.__class__(texts)

    return rows.withColumn("text", text_of(F.col(f"`{ids_column}`").cast("array<int>"))).drop(ids_column)


def document_samples(documents: DataFrame) -> DataFrame:
    """Of every document, ``SAMPLES`` different segmentations with their scores."""
    import public_tokenizers

    found = sample(documents, public_tokenizers.path("piece_bpe_32k.model"), ids=False)
    return found.select("doc_id", "sample", "n_tokens", "ids_crc32", *(F.round(c, 6).alias(c) for c in ("log_prob", "perturbed", "log_inclusion")), "round_trip")
