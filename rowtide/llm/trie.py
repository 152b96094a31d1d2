"""A byte trie in two arrays, and a per-task memory of words already worked out."""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Iterable
from itertools import islice

import numpy as np

ROOT = 0
# Places looked at together when a node's children are laid out.
WINDOW = 1 << 11


class DoubleArray:
    """Children of node n under byte c sit at base[n] + c, if check[] there names n.

    value[n] is the number of the key that ends in n, or -1.
    """

    def __init__(self, keys: Iterable[tuple[bytes, int]]):
        children: list[dict[int, int]] = [{}]
        ends = {}
        for key, number in keys:
            node = 0
            for c in key:
                step = children[node].get(c)
                if step is None:
                    step = children[node][c] = len(children)
                    children.append({})
                node = step
            ends[node] = number
        size = 2 * len(children) + 4 * WINDOW
        used = np.zeros(size, bool)
        base, check, value = (np.full(size, x, np.int32) for x in (0, -1, -1))
        used[ROOT] = True
        place, free, tight, queue = {0: ROOT}, 1, 1, deque([0])
        while queue:
            node = queue.popleft()
            at = place.pop(node)
            value[at] = ends.get(node, -1)
            kids = sorted(children[node].items())
            if not kids:
                continue
            while used[free]:
                free += 1
            if len(kids) == 1 and free >= kids[0][0]:
                start = free - kids[0][0]
            else:  # the first place where all children fit, at or after the last one found
                start = tight
                while not (fit := self._fits(used, start, kids)).any():
                    start += WINDOW
                    if start + 2 * WINDOW > len(used):
                        used, base, check, value = (
                            np.concatenate([x, np.full(len(x), fill, x.dtype)])
                            for x, fill in ((used, 0), (base, 0), (check, -1), (value, -1))
                        )
                start = tight = start + int(np.argmax(fit))
            base[at] = start
            for c, kid in kids:
                used[start + c] = True
                check[start + c] = at
                place[kid] = start + c
                queue.append(kid)
        end = int(np.flatnonzero(used)[-1]) + 257
        self.base, self.check, self.value = base[:end].copy(), check[:end].copy(), value[:end].copy()

    @staticmethod
    def _fits(used: np.ndarray, start: int, kids: list[tuple[int, int]]) -> np.ndarray:
        fit = np.ones(WINDOW, bool)
        for c, _ in kids:
            fit &= ~used[start + c : start + c + WINDOW]
        return fit

    def step(self, nodes: np.ndarray, byte: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The child of each node, and whether there is one."""
        to = self.base[nodes] + byte
        return to, self.check[to] == nodes


class Remembered:
    """Numbers words in order of appearance and works each out once.

    `work` takes the new words of a batch. Beyond `limit` words the memory starts anew, so
    it is bounded however many different words a task meets.
    """

    def __init__(self, work: Callable[[list[bytes]], None], clear: Callable[[], None], limit: int = 1 << 20):
        self.work, self.clear, self.limit = work, clear, limit
        self.numbers: dict[bytes, int] = {}

    def lookup(self, words: list[bytes]) -> np.ndarray:
        numbers = self.numbers
        if len(numbers) > self.limit:
            numbers.clear()
            self.clear()
        before = len(numbers)
        for w in words:
            if w not in numbers:
                numbers[w] = len(numbers)
        if len(numbers) > before:
            self.work(list(islice(numbers, before, None)))  # dicts keep the order of insertion
        return np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))


def by_length(words: list[bytes]) -> Iterable[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Words of similar length as (their indices, a padded byte matrix, their lengths)."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    width = 4
    low = 0
    while low < (lengths.max() if len(words) else 0):
        pick = np.flatnonzero((lengths > low) & (lengths <= width))
        if len(pick):
            flat = np.frombuffer(b"".join(words[i].ljust(width, b"\0") for i in pick.tolist()), np.uint8)
            yield pick, flat.reshape(-1, width), lengths[pick]
        low, width = width, width + max(2, width // 2)


def gather(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The pieces values[start : start + length], one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return values[np.arange(total) + np.repeat(starts - (ends - lengths), lengths)]
