"""Word-piece counts by one linear pass: a vocabulary trie with failure links.

Greedy longest-match cuts a word into the longest vocabulary entry, then the longest of the
rest, and so on. Where the trie has no way on, the node's failure link leads to the node of
what is left after the pieces already certain are taken off; how many those are is stored
with the link. Counting therefore adds stored numbers and never builds a piece.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from rowtide.llm.common import text_parts
from rowtide.llm.trie import ROOT, DoubleArray, Remembered, by_length

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Words above this length are followed byte by byte in constant memory.
LONG_WORD = 256


class Matcher:
    """The automaton of a vocabulary of byte strings that holds all 256 single bytes.

    A word is matched with a space in front: entries with that space begin words, entries
    without go on in them.
    """

    def __init__(self, entries: list[bytes]):
        if len({e for e in entries if len(e) == 1}) < 256:
            raise ValueError("the vocabulary lacks single bytes")
        self.trie = DoubleArray((e, i) for i, e in enumerate(dict.fromkeys(e for e in entries if e)))
        base, check, value = self.trie.base, self.trie.check, self.trie.value
        self.fail, self.pops = np.zeros(len(base), np.int32), np.zeros(len(base), np.int32)
        children: dict[int, list[int]] = {}
        for at, parent in enumerate(check.tolist()):
            if parent >= 0:
                children.setdefault(parent, []).append(at)
        queue = list(children.get(ROOT, []))
        for at in queue:  # breadth first: parents are done before their children
            queue += children.get(at, [])
            if value[at] >= 0:
                self.fail[at], self.pops[at] = ROOT, 1
                continue
            parent = int(check[at])
            byte = at - int(base[parent])
            node, popped = int(self.fail[parent]), int(self.pops[parent])
            while check[to := base[node] + byte] != node:
                popped += int(self.pops[node])
                node = int(self.fail[node])
            self.fail[at], self.pops[at] = to, popped

    def count_one(self, word: bytes) -> int:
        base, check, fail, pops = self.trie.base, self.trie.check, self.fail, self.pops
        node, total = ROOT, 0
        for c in word:
            while check[to := base[node] + c] != node:
                total += int(pops[node])
                node = fail[node]
            node = to
        while node != ROOT:
            total += int(pops[node])
            node = fail[node]
        return total

    def count(self, words: list[bytes]) -> np.ndarray:
        """Pieces of each word; words of similar length advance side by side."""
        out = np.zeros(len(words), np.int64)
        short = np.array([i for i, w in enumerate(words) if len(w) <= LONG_WORD], np.int64)
        for pick, text, lengths in by_length([words[i] for i in short.tolist()]):
            nodes, total = np.full(len(pick), ROOT, np.int32), np.zeros(len(pick), np.int64)
            for i in range(text.shape[1]):
                open_ = np.flatnonzero(lengths > i)
                while len(open_):
                    to, found = self.trie.step(nodes[open_], text[open_, i])
                    nodes[open_[found]] = to[found]
                    open_ = open_[~found]
                    total[open_] += self.pops[nodes[open_]]
                    nodes[open_] = self.fail[nodes[open_]]
            while (left := np.flatnonzero(nodes != ROOT)).size:
                total[left] += self.pops[nodes[left]]
                nodes[left] = self.fail[nodes[left]]
            out[short[pick]] = total
        for i, w in enumerate(words):
            if len(w) > LONG_WORD:
                out[i] = self.count_one(w)
        return out


class Counter:
    """Counts texts and remembers the words of its task."""

    def __init__(self, matcher: Matcher):
        self.matcher = matcher
        self.known = Remembered(self._learn, self._clear)
        self._clear()

    def _clear(self) -> None:
        self.counts = np.zeros(0, np.int64)

    def _learn(self, words: list[bytes]) -> None:
        self.counts = np.concatenate([self.counts, self.matcher.count([b" " + w for w in words])])

    def count(self, text: bytes | None) -> tuple[int, int]:
        words = total = 0
        for part in text_parts(text or b""):
            own = part.split()  # bytes split at ASCII white space only
            numbers = self.known.lookup(own)  # may add to the counts or start them anew
            words, total = words + len(own), total + int(self.counts[numbers].sum())
        return words, total


@lru_cache(maxsize=2)
def _matcher(path: str) -> Matcher:
    with open(path, "rb") as lines:
        return Matcher([base64.b64decode(line.split()[0]) for line in lines if line.strip()])


def count_column(spark: SparkSession, text: Column, path: str = VOCABULARY) -> Column:
    """struct<words: bigint, tokens: bigint> of a text; words are runs without ASCII white
    space. Null and blank texts have none of either. The vocabulary is read on the driver
    and sent to the tasks once (it has a fixed size)."""
    shared = spark.sparkContext.broadcast(_matcher(path))

    @F.arrow_udf("struct<words: bigint, tokens: bigint>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        counter = Counter(shared.value)
        for batch in batches:
            counts = count_batch(counter, batch.to_pylist())
            yield pa.StructArray.from_arrays(
                [pa.array(counts[:, 0]), pa.array(counts[:, 1])], names=["words", "tokens"]
            )

    return run(text.cast("binary"))


# Bytes of text whose words are looked up at a time.
TEXT_BLOCK = 1 << 21


def count_batch(counter: Counter, texts: list[bytes | None]) -> np.ndarray:
    """Words and tokens of each text; short texts are looked up together."""
    out = np.zeros((len(texts), 2), np.int64)
    held: list[bytes] = []
    rows, sizes, size = [], [], 0

    def settle() -> None:
        nonlocal held, rows, sizes, size
        if rows:
            numbers = counter.known.lookup(held)  # may add to the counts or start them anew
            counts = counter.counts[numbers]
            ends = np.concatenate([[0], np.cumsum(counts)])
            last = np.cumsum(sizes)
            out[rows, 0] = sizes
            out[rows, 1] = ends[last] - ends[last - np.array(sizes)]
        held, rows, sizes, size = [], [], [], 0

    for i, text in enumerate(texts):
        if text is not None and len(text) > TEXT_BLOCK:
            out[i] = counter.count(text)
            continue
        words = text.split() if text else []
        held += words
        rows.append(i)
        sizes.append(len(words))
        size += len(text or b"")
        if size > TEXT_BLOCK:
            settle()
    settle()
    return out
