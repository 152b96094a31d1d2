"""Language-model scores of whole documents by a gated recurrent network.

Word counts cover all training documents. The words whose counts every task knows are the
network's vocabulary, split into classes of about equal shares of the tokens, and each class
into halves, those into halves again, down to single words: the probability of a word is that
of its class given the state (softmax), times that of each half it lies in given the state and
the part that is halved. So a token takes one term for each class and one for each halving,
and not one for each word of its class. Words beyond them form one more class, within which
a word has its smoothed relative frequency. The network is fitted with truncated
backpropagation in one pass over all training documents: they are dealt to rounds, in each
round every task goes through its own, and the tasks' weights are averaged after it. Scoring carries the state from window
to window, so a document's likelihood is complete however long it is.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowtide.llm.common import stored, text_parts
from rowtide.llm.langid import fold

KNOWN_WORDS = 1 << 18  # whose counts every task holds; rarer ones are joined
HEAD_WORDS = KNOWN_WORDS  # in the network's vocabulary
CLASSES = 40  # equal shares that classes of those words are near to, see `Vocabulary`
UNITS = 16
WINDOW = 64  # steps of one truncated backpropagation
SCORE_WINDOW = 128  # steps whose probabilities are worked out together; no bearing on results
LANES = 512  # documents scored side by side
CACHED_STEPS = 4  # steps worked on at once where they need not be one by one; no bearing on results
CACHED_ROWS = 512  # rows whose probabilities of all classes are held at once; no bearing on results
# Documents fitted on side by side: as many as leave TRAIN_STEPS windows to a block of
# documents, within these bounds.
TRAIN_LANES, TRAIN_STEPS = (32, 320), 64
TRAIN_BLOCK = 5 << 18  # tokens a task holds to fit on
RATE = 0.01
WORD_RATE = 0.2  # of the weights that belong to one word or halving
AVERAGE_BLOCK = 1 << 14  # weights averaged in one row
ROUNDS = 2  # each training document belongs to one
# Parts that the documents of a round are fitted in: one for so many tokens, these at least.
PART_TOKENS, LEAST_PARTS = 1 << 23, 8
TEXT_BLOCK = 1 << 24  # bytes of text worked on at a time


def tokens(data: bytes | None) -> list[bytes]:
    """Words of a text: A-Z in lower case, parted by ASCII white space."""
    return data.lower().split() if data else []


def words_of(texts: list[bytes | None]) -> tuple[pa.Array, np.ndarray]:
    """The words (see `tokens`) of all texts in one array, and how many each text has."""
    parts = [list(text_parts(text or b"")) for text in texts]
    whole = pa.array([x for some in parts for x in some], pa.binary()).view(pa.string())
    split = pc.ascii_split_whitespace(pc.ascii_lower(whole))
    words = split.values
    real = pc.binary_length(words).to_numpy() > 0  # nothing stands before leading and after trailing space
    upto = np.append(0, np.cumsum(real))[split.offsets.to_numpy()]
    ends = upto[np.cumsum([0, *map(len, parts)])]
    return words.filter(pa.array(real)).view(pa.binary()), np.diff(ends)


def blocks_of(texts: Iterator[bytes | None]) -> Iterator[list[bytes | None]]:
    """Texts of together TEXT_BLOCK bytes, or one longer text."""
    held, size = [], 0
    for text in texts:
        if held and size + len(text or b"") > TEXT_BLOCK:
            yield held
            held, size = [], 0
        held.append(text)
        size += len(text or b"")
    if held:
        yield held


@dataclass
class Vocabulary:
    """Words by falling count. `end_rank` is the end token's place among them.

    A class holds a power of two of neighbouring words: as many as have at most 1.5 times an
    equal share of the tokens, one at least. A class of 2^d words is halved d times, whatever the
    word, so the halving k of class c is between rows c + 2^k and c + 2^(k+1) of the words' weights,
    where c is its first word (whose own row is not used).
    """

    words: list[bytes | None]  # None is the end token
    counts: np.ndarray
    total: int  # training tokens, ends included
    distinct: int
    head: int = field(init=False)
    bounds: np.ndarray = field(init=False)  # first word of each class, and the head's size

    def __post_init__(self):
        self.head = min(HEAD_WORDS, len(self.words))
        upto = np.append(0, np.cumsum(self.counts[: self.head] + 1))
        share, bounds = 1.5 * float(upto[-1]) / CLASSES, [0]
        while bounds[-1] < self.head:
            at, size = bounds[-1], 1
            while at + 2 * size <= self.head and upto[at + 2 * size] - upto[at] <= share:
                size *= 2
            bounds.append(at + size)
        self.bounds = np.array(bounds)
        self.class_of = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        self.rank = {w: i for i, w in enumerate(self.words) if w is not None}
        self.end_rank = self.words.index(None)
        rest = self.total - int(self.counts[: self.head].sum())
        self.rest_size = rest + max(self.distinct - self.head, 0) + 1

    @property
    def classes(self) -> int:
        return len(self.bounds)  # the last is the class of all other words

    def ranks(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.rank.get, words, repeat(-1)), np.int64, len(words))

    @cached_property
    def _lookup(self) -> pa.Array:
        return pa.array([w or b"" for w in self.words], pa.binary())  # no word is empty

    def coded(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, pa.Array]:
        """Ranks (-1 if not known) of all words of the texts, where each text ends, and the words."""
        words, counts = words_of(texts)
        ranks = pc.index_in(words, value_set=self._lookup).fill_null(-1).to_numpy().astype(np.int64)
        return ranks, np.cumsum(counts), words

    def ids(self, ranks: np.ndarray) -> np.ndarray:
        """Network input and target numbers: the rank, or `head` for any other word."""
        return np.where((ranks >= 0) & (ranks < self.head), ranks, self.head)


SHAPES = ("embed", "w", "u", "b", "wc", "bc", "wo", "bo")
BY_WORD = ("embed", "wo", "bo")  # a row for each word


class Network:
    """The weights, forward and backward. Gates are in the order update, reset, candidate."""

    def __init__(self, vocabulary: Vocabulary, units: int = UNITS, kind=np.float64, flat: np.ndarray | None = None):
        v, n, c = vocabulary.head, units, vocabulary.classes
        self.bounds, self.class_of, self.head, self.units = vocabulary.bounds, vocabulary.class_of, v, n
        sizes = np.diff(self.bounds)
        # How often the class of each word is halved, and its first word; the class of all others is not.
        self.halved = np.append(np.repeat(np.log2(sizes).astype(np.int32), sizes), np.int32(0))
        self.first = np.append(np.repeat(self.bounds[:-1], sizes), v).astype(np.int32)
        # Words' places where those halved most often come first.
        self.place = np.empty(v + 1, np.int64)
        self.place[np.argsort(-self.halved, kind="stable")] = np.arange(v + 1)
        # Embedded are words, any other word, begin of a text.
        shapes = ((v + 2, n), (n, 3 * n), (n, 3 * n), (3 * n,), (n, c), (c,), (v, n), (v,))
        if flat is not None:
            ends = np.cumsum([0, *map(np.prod, shapes)])
            self.p = {k: flat[ends[i] : ends[i + 1]].reshape(shapes[i]) for i, k in enumerate(SHAPES)}
            self.cast(kind)
            return
        draw = np.random.default_rng(5)
        scale = {"embed": 0.1, "w": n**-0.5, "u": n**-0.5, "wc": 0.1}
        self.p = {}
        for k, shape in zip(SHAPES, shapes):
            self.p[k] = np.zeros(shape, np.float32)
            if k in scale:
                draw.standard_normal(out=self.p[k], dtype=np.float32)
                self.p[k] *= np.float32(scale[k])
        # An unfitted network starts near word frequencies.
        counts = vocabulary.counts[:v] + 1.0
        mass = np.append(np.add.reduceat(counts, self.bounds[:-1]), vocabulary.rest_size)
        self.p["bc"], self.p["bo"] = np.log(mass / mass.sum()), self._odds(counts)
        self.cast(kind)

    def _odds(self, counts: np.ndarray) -> np.ndarray:
        """Log-odds of the later half against the earlier at each halving, by counts alone."""
        upto, own = np.append(0.0, np.cumsum(counts)), np.arange(len(counts)) - self.first[:-1]
        depth = np.floor(np.log2(np.maximum(own, 1))).astype(np.int64)
        size = 1 << np.maximum(self.halved[:-1] - depth, 1)
        begin = self.first[:-1] + (own - (1 << depth)) * size
        begin = np.where(own > 0, begin, 0)
        size = np.where(own > 0, size, 0)
        early, late = (upto[begin + (i + 1) * size // 2] - upto[begin + i * size // 2] for i in (0, 1))
        return np.where(own > 0, np.log(np.where(own > 0, late, 1.0) / np.where(own > 0, early, 1.0)), 0.0)

    def cast(self, kind) -> Network:
        self.p = {k: np.ascontiguousarray(x, kind) for k, x in self.p.items()}
        return self

    @property
    def begin(self) -> int:
        return self.head + 1

    def flat(self) -> np.ndarray:
        return np.concatenate([self.p[k].ravel() for k in SHAPES])

    def load(self, flat: np.ndarray) -> Network:
        at = 0
        for k in SHAPES:
            size = self.p[k].size
            self.p[k] = flat[at : at + size].reshape(self.p[k].shape).astype(self.p[k].dtype)
            at += size
        return self

    def states(self, inputs: np.ndarray, fresh: np.ndarray, h: np.ndarray, keep: list | None = None) -> np.ndarray:
        """States after each of the (time, lane) inputs; lanes start anew where `fresh`.

        Within, lanes come last, so that the gates are whole rows. `keep` takes, by time, unit
        and lane: the states before, the gates, and the candidate's share of the state before.
        """
        n, kind = self.units, h.dtype
        # With the first two gates' signs turned, a gate is 1 / (1 + e^x).
        sign = np.repeat(np.array([-1, 1], kind), [2 * n, n])
        u, w, b = (np.ascontiguousarray((self.p[k] * sign).T) for k in ("u", "w", "b"))
        times, width = inputs.shape
        out = np.empty((times, n, width), kind)
        kept, mine = keep is not None, np.empty((3 * n, width), kind)
        if kept:
            before, inner = np.empty_like(out), np.empty((times, 3 * n, width), kind)
            every = np.empty_like(inner)
            keep += [before, every, inner[:, 2 * n :]]
        h = np.ascontiguousarray(h.T)
        anew = fresh.any(axis=1).tolist()
        for at in range(0, times, CACHED_STEPS):
            some = slice(at, at + CACHED_STEPS)
            embedded = self.p["embed"].take(inputs[some], 0).transpose(0, 2, 1)
            gates = np.matmul(w, embedded, out=every[some] if kept else None)
            gates += b[:, None]
            for t, g in enumerate(gates, at):
                if anew[t]:
                    h = h * ~fresh[t]
                if kept:
                    before[t], mine = h, inner[t]
                np.matmul(u, h, out=mine)
                zr, c = g[: 2 * n], g[2 * n :]
                zr += mine[: 2 * n]
                np.exp(zr, out=zr)
                zr += 1
                np.reciprocal(zr, out=zr)
                c += zr[n:] * mine[2 * n :]
                np.tanh(c, out=c)
                h = h - c
                h *= zr[:n]
                h += c
                out[t] = h
        return np.ascontiguousarray(out.transpose(0, 2, 1))

    def log_likelihood(self, states: np.ndarray, targets: np.ndarray, grads: dict | None = None, move=None):
        """Natural log-probability of each target given its state (rows); for targets
        outside the head, that of their class. With `grads`, the gradient by state too.

        Rows are sorted by how often their word's class is halved, most often first, and by
        word: those with a k-th halving come first, and those that share one are neighbours.
        Classes are taken in blocks that stay in the processor's cache. With `move`, the gradients
        of the words' weights go there at once, as (name, rows, gradient).
        """
        p, outside = self.p, len(self.bounds) - 1
        targets = np.minimum(targets, self.head)
        order = np.sort((self.place.take(targets) << 32) | np.arange(len(targets))) & 0xFFFFFFFF
        states, targets = states.take(order, 0), targets.take(order)
        kind = np.append(self.class_of, outside).take(targets)
        found = np.empty(len(targets))
        by = None if grads is None else np.empty_like(states)
        for at in range(0, len(targets), CACHED_ROWS):
            some, rows = slice(at, at + CACHED_ROWS), np.arange(min(CACHED_ROWS, len(targets) - at))
            odds = p["wc"].T @ states[some].T
            odds += p["bc"][:, None]
            odds -= odds.max(axis=0)
            picked = odds[kind[some], rows]
            np.exp(odds, out=odds)
            total = odds.sum(axis=0)
            found[some] = picked - np.log(total)
            if grads is not None:
                odds *= -1 / total
                odds[kind[some], rows] += 1
                grads["wc"] += (odds @ states[some]).T
                grads["bc"] += odds.sum(axis=1)
                by[some] = odds.T @ p["wc"].T
        first, halvings = self.first.take(targets), self.halved.take(targets)
        own = (targets - first).astype(np.int32)
        # 1 / probability of the halves taken so far: at most e^36 for each of 18 or fewer.
        inverse = np.ones(int(np.count_nonzero(halvings)))
        reach = np.arange(int(halvings[0]) if len(halvings) else 0)
        for depth, count in enumerate(np.searchsorted(-halvings, -reach).tolist()):
            left, mine = halvings[:count] - depth, states[:count]
            part = own[:count] >> (left - 1)
            nodes = first[:count] + (1 << depth) + (part >> 1)
            toward = (2 * (part & 1) - 1).astype(states.dtype)
            weights = p["wo"].take(nodes, 0)
            against = np.einsum("ij,ij->i", weights, mine)
            against += p["bo"].take(nodes)
            against *= -toward
            np.minimum(against, 36, out=against)
            np.exp(against, out=against)
            whole = against + 1
            inverse[:count] *= whole
            if grads is not None:
                g = against
                g /= whole
                g *= toward
                weights *= g[:, None]
                by[:count] += weights
                starts = np.flatnonzero(np.append(True, nodes[1:] != nodes[:-1]))
                rows = nodes.take(starts)
                for name, x in (("wo", run_sums(g[:, None] * mine, starts)), ("bo", np.add.reduceat(g, starts))):
                    if move is None:
                        grads[name][rows] = x
                    else:
                        move(name, rows, x)
        found[: len(inverse)] -= np.log(inverse)
        out = np.empty_like(found)
        out[order] = found
        if grads is None:
            return out, None
        by_state = np.empty_like(by)
        by_state[order] = by
        return out, by_state

    def gradient(self, inputs, targets, fresh, live, h, move=None):
        """Log-likelihood of a window, its gradient by all weights, and the last state.

        The gradient ends at the window's first step; `live` marks the real targets. With `move`,
        gradients of weights that belong to words go there and are not returned.
        """
        n, p, keep = self.units, self.p, []
        grads = {k: np.zeros(x.shape, x.dtype) for k, x in p.items() if move is None or k not in BY_WORD}
        states = self.states(inputs, fresh, h, keep)
        at = np.flatnonzero(live.ravel())
        whole = len(at) == inputs.size
        flat, wanted = states.reshape(-1, n), targets.ravel()
        ll, by = self.log_likelihood(flat if whole else flat.take(at, 0), wanted if whole else wanted.take(at), grads, move)
        if whole:
            by_state = by
        else:
            by_state = np.zeros((inputs.size, n), h.dtype)
            by_state[at] = by
        by_state = np.ascontiguousarray(by_state.reshape(states.shape).transpose(0, 2, 1))
        before, gates, inner = keep
        later = np.zeros(by_state.shape[1:], h.dtype)
        anew = fresh.any(axis=1).tolist()
        by_embedded = np.empty((*inputs.shape, n), h.dtype)
        grads["w"], grads["u"], grads["b"] = (np.zeros_like(p[k]) for k in ("w", "u", "b"))
        for at in reversed(range(0, len(inputs), CACHED_STEPS)):
            some = slice(at, at + CACHED_STEPS)
            z, r, c = (gates[some, i * n : (i + 1) * n] for i in range(3))
            # What the gradient by a state is multiplied with to give that by each gate's input.
            by_c = 1 - c * c
            by_c *= 1 - z
            by_z = (before[some] - c) * z
            by_z *= 1 - z
            by_r = inner[some] * r
            by_r *= 1 - r
            by_r *= by_c
            by_in = np.empty((len(z), 3 * n, inputs.shape[1]), h.dtype)
            by_inner = np.empty_like(by_in)
            for t in range(len(z) - 1, -1, -1):
                d, mine = by_state[at + t], by_inner[t]
                d += later
                np.multiply(d, by_z[t], out=mine[:n])
                np.multiply(d, by_r[t], out=mine[n : 2 * n])
                dc = np.multiply(d, by_c[t], out=by_in[t, 2 * n :])
                np.multiply(dc, r[t], out=mine[2 * n :])
                later = p["u"] @ mine
                d *= z[t]
                later += d
                if anew[at + t]:
                    later *= ~fresh[at + t]
            by_in[:, : 2 * n] = by_inner[:, : 2 * n]
            grads["u"] += np.matmul(before[some], by_inner.transpose(0, 2, 1)).sum(axis=0)
            flat_in = np.ascontiguousarray(by_in.transpose(0, 2, 1)).reshape(-1, 3 * n)
            grads["b"] += flat_in.sum(axis=0)
            grads["w"] += p["embed"].take(inputs[some].ravel(), 0).T @ flat_in
            np.matmul(flat_in, p["w"].T, out=by_embedded[some].reshape(-1, n))
        ids = inputs.ravel()
        packed = np.sort((ids << 32) | np.arange(len(ids)))
        order, ids = packed & 0xFFFFFFFF, packed >> 32
        starts = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))
        words = ids.take(starts)
        by_input = run_sums(by_embedded.reshape(-1, n).take(order, 0), starts)
        if move is None:
            grads["embed"][words] = by_input
        else:
            move("embed", words, by_input)
        return float(ll.sum()), grads, states[-1]


SHORT_RUN = 4  # rows; longer runs are summed one by one


def run_sums(rows: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of runs of rows, each from a place in `starts` to the next.

    The same as add.reduceat, which takes far longer where most runs have a row or two.
    """
    sizes = np.diff(starts, append=len(rows))
    out = rows.take(starts, 0)
    more, done = np.flatnonzero((sizes > 1) & (sizes <= SHORT_RUN)), 1
    while len(more):
        sums = out.take(more, 0)
        sums += rows.take(starts.take(more) + done, 0)
        out[more] = sums
        done += 1
        more = more[sizes[more] > done]
    if len(more := np.flatnonzero(sizes > SHORT_RUN)):
        ends = np.stack([starts[more], starts[more] + sizes[more]], axis=1).ravel()
        out[more] = np.add.reduceat(rows, ends[:-1] if ends[-1] == len(rows) else ends, axis=0)[::2]
    return out


def lanes(lengths: np.ndarray, count: int, begun: int = 0) -> list[list[int]]:
    """Documents dealt to lanes, longest first, each to the lane with the least so far.

    Before that, each of the first `begun` documents opens a lane of its own.
    """
    import heapq

    size = max(1, min(count, len(lengths)))
    out = [[i] if i < begun else [] for i in range(max(size, begun))]
    heap = [(int(lengths[i]) if i < begun else 0, i) for i in range(len(out))]
    heapq.heapify(heap)
    for doc in (begun + np.argsort(-lengths[begun:], kind="stable")).tolist():
        size, lane = heapq.heappop(heap)
        out[lane].append(doc)
        heapq.heappush(heap, (size + int(lengths[doc]), lane))
    return out


def windows(ids: list[np.ndarray], begin: int, count: int, size: int, begun: list[int] | None = None, left: list | None = None):
    """Window by window: the lanes still running, and matrices of time by those lanes.

    The matrices are inputs, targets, fresh (a document begins), live (not past a lane's
    end) and the document each target belongs to. The first documents go on after the inputs
    `begun`, in the first lanes. With `left`, the windows end when fewer than half of the lanes
    are running, and what is left goes there as (document, words done, lane).
    """
    begun = begun or []
    lengths = np.array([len(x) for x in ids], np.int64)
    dealt = lanes(lengths, count, len(begun))
    docs = np.array([d for lane in dealt for d in lane], np.int64)
    targets = np.concatenate([ids[d] for d in docs.tolist()]).astype(np.int32, copy=False)
    owners = np.repeat(docs.astype(np.int32), lengths[docs])
    # Each word's input is the word before it, or the begin of a text.
    opens = np.append(True, owners[1:] != owners[:-1])
    inputs = np.where(opens, begin, np.append(begin, targets[:-1])).astype(np.int32)
    sizes = np.array([lengths[lane].sum() for lane in dealt])
    first = np.cumsum(sizes) - sizes
    opens[first[: len(begun)]] = False
    inputs[first[: len(begun)]] = begun
    for at in range(0, int(sizes.max()), size):
        running = np.flatnonzero(sizes > at)
        if left is not None and 2 * len(running) < len(dealt):
            for lane in running.tolist():
                ends = np.cumsum(lengths[dealt[lane]])
                starts = ends - lengths[dealt[lane]]
                left += [(d, max(at - int(a), 0), lane) for d, a, b in zip(dealt[lane], starts, ends) if b > at]
            return
        steps = np.arange(at, min(at + size, int(sizes.max())))[:, None]
        live = steps < sizes[running]
        place = np.minimum(first[running] + steps, len(targets) - 1)
        now = [x.take(place).astype(np.int64) for x in (inputs, targets, owners)]
        fresh = opens.take(place)
        if not live.all():
            fresh &= live
            now = [np.where(live, x, dead) for x, dead in zip(now, (begin, 0, -1))]
        yield running, now[0], now[1], fresh, live, now[2]


class Fitting:
    """Truncated backpropagation over a task's documents, block by block.

    Adam for the weights all words share. A word's own weights move only in windows that
    concern the word or its class, by Adagrad on summed gradients, with one rate for a row.
    """

    def __init__(self, network: Network):
        self.net, self.step, self.seen = network, 0, 0
        self.held: list[tuple] = []  # documents not yet done: words, and the last word and state of those begun
        self.first = {k: np.zeros_like(x) for k, x in network.p.items() if k not in BY_WORD}
        self.second = {k: np.ones(len(x), x.dtype) if k in BY_WORD else np.zeros_like(x) for k, x in network.p.items()}

    def move(self, name: str, rows, g: np.ndarray) -> None:
        second = self.second[name].take(rows)
        second += g * g if g.ndim == 1 else np.einsum("ij,ij->i", g, g) / g.shape[1]
        self.second[name][rows] = second
        rate = WORD_RATE / np.sqrt(second)
        g *= rate if g.ndim == 1 else rate[:, None]
        g += self.net.p[name].take(rows, 0)
        self.net.p[name][rows] = g

    def block(self, ids: list[np.ndarray], more: bool = False) -> None:
        """If `more` blocks follow, documents that few others run beside go on with the next."""
        held = sorted(self.held, key=lambda x: x[1] is None) + [(x, None, None) for x in ids if len(x)]
        if not held:
            return
        ids, begun = [x for x, _, _ in held], [(last, h) for _, last, h in held if last is not None]
        net, count = self.net, int(np.clip(sum(map(len, ids)) // (WINDOW * TRAIN_STEPS), *TRAIN_LANES))
        h = np.zeros((max(count, len(begun)), net.units), net.p["b"].dtype)
        for lane, (_, state) in enumerate(begun):
            h[lane] = state
        left = [] if more else None
        for running, inputs, targets, fresh, live, _ in windows(ids, net.begin, count, WINDOW, [x for x, _ in begun], left):
            _, grads, h[running] = net.gradient(inputs, targets, fresh, live, h[running], self.move)
            size = int(live.sum())
            self.seen += size
            self.step += 1
            rate = RATE / (1 - 0.9**self.step)
            for k in self.first:
                g = grads[k]
                g /= size
                first, second = self.first[k], self.second[k]
                first += 0.1 * (g - first)
                second += 0.001 * (g * g - second)
                net.p[k] += rate * first / (np.sqrt(second / (1 - 0.999**self.step)) + 1e-8)
        self.held = [
            (ids[doc][done:], int(ids[doc][done - 1]), h[lane].copy()) if done else (ids[doc], *held[doc][1:])
            for doc, done, lane in left or ()
        ]


def fit_part(network: Network, ids: list[np.ndarray]) -> tuple[Network, int]:
    """One pass over documents held at once, and the tokens seen."""
    fitting = Fitting(network)
    fitting.block(ids)
    return network, fitting.seen


def score_ids(network: Network | None, ids: list[np.ndarray], h: np.ndarray | None = None) -> tuple:
    """Natural log-likelihood of each document (0 without a network), and the lanes' last states.

    With `h` given, the one document goes on from that state, and ids[0][0] is its last input.
    """
    out = np.zeros(len(ids))
    if network is None:
        return out, h
    go_on = h is not None
    if go_on:
        first, ids = int(ids[0][0]), [ids[0][1:]]
    if not any(len(x) for x in ids):
        return out, h
    h = np.zeros((LANES, network.units), np.float32) if h is None else h
    for running, inputs, targets, fresh, live, owner in windows(ids, network.begin, LANES, SCORE_WINDOW):
        if go_on:
            inputs[0, 0], fresh[0, 0], go_on = first, False, False
        states = network.states(inputs, fresh, h[running])
        h[running] = states[-1]
        at = np.flatnonzero(live.ravel())
        ll, _ = network.log_likelihood(states.reshape(-1, network.units)[at], targets.ravel()[at])
        out += np.bincount(owner.ravel()[at], ll, minlength=len(ids))
    return out, h


class Scorer:
    """Sums that need no join: base and network scores of the words every task knows.

    Without a network, its log-likelihoods are 0.
    """

    def __init__(self, vocabulary: Vocabulary, network: Network | None):
        self.v, self.net = vocabulary, network and network.cast(np.float32)
        self.log_count = np.log10(vocabulary.counts + 1.0)

    def _sums(self, ranks: np.ndarray) -> np.ndarray:
        """Sum of log10(count + 1) over known words, over those outside the head; how many
        words are known, and how many lie outside the head or are not known."""
        known = ranks[ranks >= 0]
        logs, outside = self.log_count[known], known >= self.v.head
        seen = np.count_nonzero(self.v.counts[known])  # an end token never trained on counts for nothing
        return np.array([logs.sum(), logs[outside].sum(), seen, outside.sum() + len(ranks) - len(known)])

    def long(self, data: bytes) -> tuple:
        """One text, part by part; the state is carried on."""
        n, sums, rare, total, h, last = 1, np.zeros(4), [], 0.0, None, None
        for part in text_parts(data):
            words = tokens(part)
            if not words:
                continue
            ranks = self.v.ranks(words)
            n += len(words)
            sums += self._sums(ranks)
            rare += [words[i] for i in np.flatnonzero(ranks < 0).tolist()]
            ids = self.v.ids(ranks)
            ll, h = score_ids(self.net, [ids if last is None else np.append(last, ids)], h)
            total, last = total + ll[0], ids[-1]
        end = np.array([self.v.ids(np.array([self.v.end_rank]))[0]])
        ll, _ = score_ids(self.net, [end if last is None else np.append(last, end)], h)
        return n, *(sums + self._sums(np.array([self.v.end_rank]))), rare, total + ll[0]

    def block(self, texts: list[bytes | None]) -> list[tuple]:
        """(tokens, the four sums, rare words, log-likelihood) of each text."""
        found, ids = [], []
        flat, ends, words = self.v.coded(texts)
        for own in np.split(flat, ends[:-1]):
            ranks = np.append(own, self.v.end_rank)
            ids.append(self.v.ids(ranks))
            found.append([len(ranks), *self._sums(ranks), []])
        at = np.flatnonzero(flat < 0)
        for doc, word in zip(np.searchsorted(ends, at, side="right").tolist(), words.take(pa.array(at)).to_pylist()):
            found[doc][-1].append(word)
        ll, _ = score_ids(self.net, ids)
        return [(*f, x) for f, x in zip(found, ll.tolist())]

    def batch(self, texts: list[bytes | None]) -> Iterator[tuple]:
        held, size = [], 0
        for text in texts:
            if text is not None and len(text) > TEXT_BLOCK:
                if held:
                    yield from self.block(held)
                held, size = [], 0
                yield self.long(text)
                continue
            held.append(text)
            size += len(text or b"")
            if size > TEXT_BLOCK:
                yield from self.block(held)
                held, size = [], 0
        if held:
            yield from self.block(held)


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words with their counts, block by block of texts; null stands for the end token."""
    for held in blocks_of(text for batch in batches for text in batch.column(0).to_pylist()):
        words, counts = words_of(held)
        counted = words.value_counts()
        yield pa.RecordBatch.from_arrays(
            [
                pa.concat_arrays([counted.field("values"), pa.nulls(1, pa.binary())]),
                pa.concat_arrays([counted.field("counts"), pa.array([len(counts)], pa.int64())]),
            ],
            names=["word", "n"],
        )


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, n) over all rows of the single column of texts in UTF-8."""
    return texts.mapInArrow(_count_batches, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def vocabulary(counts: DataFrame) -> Vocabulary:
    """The totals, and the most frequent words: all above a count that at most KNOWN_WORDS reach."""
    # 256 steps for each doubling: counts up to some hundreds are told apart one by one.
    step = F.floor(F.log2("n") * 256)
    bins = counts.groupBy(step.alias("step")).agg(F.sum("n").alias("n"), F.count("*").alias("words")).collect()
    total, distinct = sum(r["n"] for r in bins), sum(r["words"] for r in bins)
    known, least = 0, 0
    for r in sorted(bins, key=lambda r: -r["step"]):
        known += r["words"]
        if known > KNOWN_WORDS:
            least = r["step"] + 1
            break
    rows = [(None if r["word"] is None else bytes(r["word"]), r["n"]) for r in counts.where(step >= least).collect()]
    if all(w is not None for w, _ in rows):
        end = counts.where("word IS NULL").first()
        rows.append((None, end["n"] if end else 0))
    rows.sort(key=lambda r: (-r[1], r[0] or b""))
    words, n = zip(*rows)
    return Vocabulary(list(words), np.array(n, np.int64), total, distinct)


def train(docs: DataFrame, vocabulary: Vocabulary, rounds: int = ROUNDS) -> Network:
    """The network fitted on all of `docs` (columns id and text), part by part and averaged.

    Every document belongs to one round, and there to one part by a hash of its id, in order of
    ids; the number of parts follows from the number of tokens. So the network depends on
    the documents alone, not on the cluster. A part is one task, which holds a block of its
    documents at a time, as word numbers; a lost executor costs the parts it worked on.
    The network's `seen` is the number of tokens fitted on.
    """
    spark = docs.sparkSession
    network = Network(vocabulary, kind=np.float32)
    seen = 0
    shared = spark.sparkContext.broadcast(vocabulary)
    drawn = F.pmod(F.xxhash64(F.col("id").cast("string"), F.lit("lm")), F.lit(rounds))
    parts = max(LEAST_PARTS, -(-vocabulary.total // (rounds * PART_TOKENS)))

    def mean(group: pa.Table) -> pa.Table:
        group = group.sort_by("part")
        seen = np.array(group["seen"].to_pylist(), np.float64)
        x = sum(np.frombuffer(b, np.float16) * (n / seen.sum()) for b, n in zip(group["x"].to_pylist(), seen))
        return pa.table(
            {
                "i": pa.array([group["i"][0].as_py()], pa.int32()),
                "x": pa.array([x.astype(np.float32).tobytes()], pa.binary()),
                "seen": pa.array([int(seen.sum())], pa.int64()),
                "part": pa.array([None], pa.int32()),
            }
        )

    for number in range(rounds):
        start = spark.sparkContext.broadcast(network.flat())

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            v, ids, size = shared.value, [], 0
            fitting = Fitting(Network(v, kind=np.float32, flat=start.value.copy()))
            end = v.ids(np.array([v.end_rank])).astype(np.int32)
            for texts in blocks_of(text for batch in batches for text in batch.column("text").to_pylist()):
                ranks, ends, _ = v.coded(texts)
                for own in np.split(v.ids(ranks).astype(np.int32), ends[:-1]):
                    ids.append(np.append(own, end))
                    size += len(ids[-1])
                    if size > TRAIN_BLOCK:
                        fitting.block(ids, more=True)
                        ids, size = [], 0
            fitting.block(ids)
            if fitting.seen:
                # Only steps leave, which need fewer digits than weights.
                flat = (fitting.net.flat() - start.value).astype(np.float16)
                for i, at in enumerate(range(0, len(flat), AVERAGE_BLOCK)):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([i], pa.int32()),
                            pa.array([flat[at : at + AVERAGE_BLOCK].tobytes()], pa.binary()),
                            pa.array([fitting.seen], pa.int64()),
                            pa.array([TaskContext.get().partitionId()], pa.int32()),
                        ],
                        names=["i", "x", "seen", "part"],
                    )

        own = docs.where(drawn == number).select("id", "text")
        # One set of weights leaves each part, also where Spark deals to more partitions.
        dealt = own.repartition(parts, F.xxhash64(F.col("id").cast("string"))).sortWithinPartitions("id", "text").coalesce(parts)
        kinds = "i int, x binary, seen long, part int"
        # As many bytes as the network has, whatever the corpus.
        rows = dealt.mapInArrow(run, kinds).groupBy("i").applyInArrow(mean, kinds).collect()
        start.unpersist()
        if rows:
            rows.sort(key=lambda r: r["i"])
            steps = np.frombuffer(b"".join(r["x"] for r in rows), np.float32)
            network = Network(vocabulary, kind=np.float32, flat=network.flat() + steps)
            seen += rows[0]["seen"]
    network.seen = seen
    return network


_SUMS = "n long, logs double, rest double, known double, outside double, rare map<binary, bigint>, ll double"


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 7, held: int = 2) -> DataFrame:
    """One row per document: id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Rows whose id has crc32 remainder `held` of `folds` are not learnt from. A null text
    counts as empty and has the end token only. Repeated rows count as often as they
    occur. base_score is the smoothed word-frequency log10 probability, score the network's.
    """
    return _scores(docs, id_col, text_col, folds, held, with_network=True)


def base_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 7, held: int = 2) -> DataFrame:
    """The columns of `score` but the last: no network is fitted."""
    return _scores(docs, id_col, text_col, folds, held, with_network=False).drop("score")


def _scores(docs: DataFrame, id_col: str, text_col: str, folds: int, held: int, with_network: bool) -> DataFrame:
    spark = docs.sparkSession
    rows = docs.select(
        F.col(id_col).alias("id"),
        (fold(F.col(id_col), folds) == held).alias("held_out"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"),
    )
    learnt = rows.where(~F.col("held_out"))
    counts = stored(word_counts(learnt.select("text")))
    known = vocabulary(counts)
    fitted = train(learnt.select("id", "text"), known).flat() if with_network else None
    shared = spark.sparkContext.broadcast((known, fitted))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, flat = shared.value
        scorer = Scorer(v, None if flat is None else Network(v, kind=np.float32, flat=flat))
        for batch in batches:
            columns = list(zip(*scorer.batch(batch.column(2).to_pylist()))) or [[]] * 7
            sums = [pa.array([float(x) for x in c], pa.float64()) for c in columns[1:5]]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(columns[0], pa.int64()),
                    *sums,
                    pa.array([list(Counter(x).items()) for x in columns[5]], pa.map_(pa.binary(), pa.int64())),
                    pa.array(columns[6], pa.float64()),
                ],
                names=["id", "held_out", "n", "logs", "rest", "known", "outside", "rare", "ll"],
            )

    kinds = f"id {docs.schema[id_col].dataType.simpleString()}, held_out boolean, {_SUMS}"
    scored = stored(rows.mapInArrow(run, kinds).withColumn("row", F.monotonically_increasing_id()))
    # Words beyond the known ones: each document's are joined with the counts.
    words = scored.select("row", F.explode("rare").alias("word", "times"))
    joined = words.join(counts, "word").groupBy("row").agg(
        F.sum("times").alias("times"), F.sum(F.col("times") * F.log10(F.col("n") + 1.0)).alias("more")
    )
    more = F.coalesce("more", F.lit(0.0))
    base = F.col("logs") + more - F.col("n") * F.lit(float(np.log10(known.total + known.distinct + 1)))
    others_share = F.col("outside") * F.lit(float(np.log10(known.rest_size)))
    own = F.col("ll") / F.lit(float(np.log(10))) + F.col("rest") + more - others_share
    return (
        scored.join(joined, "row", "left")
        .select(
            F.col("id").alias(id_col),
            "held_out",
            F.col("n").alias("n_tokens"),
            (F.col("known").cast("long") + F.coalesce("times", F.lit(0))).alias("n_known"),
            F.lit(known.total).cast("long").alias("train_tokens"),
            base.alias("base_score"),
            own.alias("score"),
        )
    )
