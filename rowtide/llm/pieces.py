"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie of pieces.

A text gets a space in front; each space is the whitespace marker. No piece has a marker
after another character, so the best path over a text is the best paths over its chunks (a
run of spaces and what follows), and each different chunk is worked out once per task, all
new chunks of a batch side by side. A character no piece covers costs ten points more than
the worst piece and becomes its UTF-8 bytes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from rowtide.llm.common import text_parts
from rowtide.llm.trie import ROOT, DoubleArray, Remembered, by_length, gather

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARKER = "▁".encode()
# Longer chunks are worked out one by one, in memory of 16 bytes for each of theirs.
LONG_CHUNK = 256
# Chunks worked out side by side.
TOGETHER = 1 << 15
# Chunks a task remembers before it starts anew.
CHUNKS_KEPT = 1 << 17
UNKNOWN_PENALTY = 10.0


class Pieces:
    """The vocabulary in the form the tasks need; about a megabyte."""

    def __init__(self, path: str = MODEL):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.scores = np.array([model.get_score(i) for i in range(size)], np.float64)
        self.byte_ids = np.full(256, -1, np.int32)
        self.surface: list[bytes] = []
        plain = []
        for i in range(size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[3:-1], 16)
                self.byte_ids[value] = i
                self.surface.append(bytes([value]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.surface.append(b"")
            else:
                text = piece.encode().replace(MARKER, b" ")
                self.surface.append(text)
                plain.append((text, i))
        if (self.byte_ids < 0).any():
            raise ValueError("the vocabulary lacks byte pieces")
        if any(b" " in text.lstrip(b" ") for text, _ in plain):
            raise ValueError("a piece has a marker after another character")
        self.trie = DoubleArray(plain)
        self.unknown = min(self.scores[i] for _, i in plain) - UNKNOWN_PENALTY
        # Characters that stand in no piece with others cut a chunk as well; line ends do here.
        self.line_ends_alone = not any(b"\n" in text and text != b"\n" for text, _ in plain)

    @property
    def chunk(self) -> re.Pattern:
        return re.compile(rb"\n| +[^ \n]*|[^ \n]+" if self.line_ends_alone else rb" +[^ ]*")

    def path(self, chunk: bytes) -> list[int]:
        """The best path over one chunk, position by position."""
        n = len(chunk)
        best, back, piece = np.full(n + 1, -np.inf), np.zeros(n + 1, np.int32), np.full(n + 1, -1, np.int32)
        best[0] = 0.0
        base, check, value = self.trie.base, self.trie.check, self.trie.value
        for i in range(n):
            if best[i] == -np.inf:
                continue
            node, whole = ROOT, i + _width(chunk[i])
            for j in range(i, n):
                to = base[node] + chunk[j]
                if check[to] != node:
                    break
                node = to
                if (v := value[node]) >= 0 and (score := best[i] + self.scores[v]) > best[j + 1]:
                    best[j + 1], back[j + 1], piece[j + 1] = score, i, v
            if not self._has(chunk[i:whole]) and (score := best[i] + self.unknown) > best[whole]:
                best[whole], back[whole], piece[whole] = score, i, -1
        out, j = [], n
        while j:
            i = int(back[j])
            out.append([int(piece[j])] if piece[j] >= 0 else self.byte_ids[list(chunk[i:j])].tolist())
            j = i
        return [x for part in reversed(out) for x in part]

    def _has(self, key: bytes) -> bool:
        node = ROOT
        for c in key:
            to = self.trie.base[node] + c
            if self.trie.check[to] != node:
                return False
            node = to
        return bool(self.trie.value[node] >= 0)

    def paths(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All best paths: piece ids one after the other, and the number of each chunk's."""
        counts = np.zeros(len(chunks), np.int64)
        parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        short = [i for i, c in enumerate(chunks) if len(c) <= LONG_CHUNK]
        for begin in range(0, len(short), TOGETHER):
            some = np.array(short[begin : begin + TOGETHER])
            for pick, matrix, lengths in by_length([chunks[i] for i in some.tolist()]):
                ids, of = self._together(matrix, lengths)
                counts[some[pick]] = np.bincount(of, minlength=len(pick))
                parts.append((some[pick][of], ids, np.arange(len(ids))))
        for i, c in enumerate(chunks):
            if len(c) > LONG_CHUNK:
                ids = np.array(self.path(c), np.int32)
                counts[i] = len(ids)
                parts.append((np.full(len(ids), i), ids, np.arange(len(ids))))
        if not parts:
            return np.zeros(0, np.int32), counts
        of = np.concatenate([p[0] for p in parts])
        ids = np.concatenate([p[1] for p in parts])
        return ids[np.argsort(of, kind="stable")], counts

    def _together(self, text: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best paths over the rows of a byte matrix, all rows one position at a time."""
        rows, width = text.shape
        best = np.full((rows, width + 1), -np.inf)
        back = np.zeros((rows, width + 1), np.int16)
        piece = np.full((rows, width + 1), -1, np.int32)
        best[:, 0] = 0.0
        for i in range(width):
            active = np.flatnonzero((lengths > i) & (best[:, i] > -np.inf))
            if not len(active):
                continue
            wide = _WIDTH[text[active, i]]
            alone = np.zeros(len(active), bool)
            inside, nodes = np.arange(len(active)), np.full(len(active), ROOT)
            for j in range(i, width):
                going = lengths[active[inside]] > j
                inside, nodes = inside[going], nodes[going]
                to, found = self.trie.step(nodes, text[active[inside], j])
                inside, nodes = inside[found], to[found]
                if not len(inside):
                    break
                value = self.trie.value[nodes]
                ends = value >= 0
                at, v = inside[ends], value[ends]
                alone[at[wide[at] == j + 1 - i]] = True
                _improve(best, back, piece, active[at], i, j + 1, best[active[at], i] + self.scores[v], v)
            rest = np.flatnonzero(~alone)
            for w in range(1, 5):
                at = active[rest[wide[rest] == w]]
                at = at[lengths[at] >= i + w]
                if len(at):
                    _improve(best, back, piece, at, i, i + w, best[at, i] + self.unknown, -1)
        at, of = lengths.copy(), np.arange(rows)
        found_of, found_from, found_id, found_to = [], [], [], []
        while len(of):
            start = back[of, at].astype(np.int64)
            found_of.append(of)
            found_from.append(start)
            found_to.append(at)
            found_id.append(piece[of, at])
            going = start > 0
            of, at = of[going], start[going]
        of, start, end, ids = map(np.concatenate, (found_of, found_from, found_to, found_id))
        order = np.lexsort((start, of))
        of, start, end, ids = of[order], start[order], end[order], ids[order]
        size = np.where(ids >= 0, 1, end - start)
        if (size > 1).any() or (ids < 0).any():
            step = gather(np.arange(width + 1), start, size)
            spread = np.repeat(np.arange(len(of)), size)
            spelled = self.byte_ids[text[of[spread], np.minimum(step, width - 1)]]
            ids, of = np.where(ids[spread] >= 0, ids[spread], spelled), of[spread]
        return ids.astype(np.int32), of


def _improve(best, back, piece, rows, start, end, score, value) -> None:
    better = score > best[rows, end]
    rows = rows[better]
    best[rows, end] = score[better]
    back[rows, end] = start
    piece[rows, end] = value[better] if isinstance(value, np.ndarray) else value


def _width(lead: int) -> int:
    return 1 if lead < 0xC0 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4


_WIDTH = np.array([_width(b) for b in range(256)])


class Encoder:
    """Encodes batches of texts and remembers the chunks of its task."""

    def __init__(self, pieces: Pieces):
        self.pieces, self.pattern = pieces, pieces.chunk
        self.known = Remembered(self._learn, self._clear, CHUNKS_KEPT)
        self._clear()

    def _clear(self) -> None:
        self.ids, self.starts, self.counts = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _learn(self, chunks: list[bytes]) -> None:
        ids, counts = self.pieces.paths(chunks)
        starts = len(self.ids) + np.cumsum(counts) - counts
        self.ids = np.concatenate([self.ids, ids])
        self.starts, self.counts = np.concatenate([self.starts, starts]), np.concatenate([self.counts, counts])

    def encode(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and the number of each text's."""
        marked = [b" " + t.replace(MARKER, b" ") if t else b"" for t in texts]
        if all(len(m) <= TEXT_BLOCK for m in marked):
            return self._encode(marked)
        parts = [[self._encode([p])[0] for p in _cuts(m)] for m in marked]
        counts = [sum(map(len, own)) for own in parts]
        return np.concatenate([ids for own in parts for ids in own]), np.array(counts, np.int64)

    def _encode(self, marked: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        chunks, per_text = [], np.zeros(len(marked), np.int64)
        for n, text in enumerate(marked):
            own = self.pattern.findall(text)
            per_text[n] = len(own)
            chunks += own
        numbers = self.known.lookup(chunks)
        lengths = self.counts[numbers]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        last = np.cumsum(per_text)
        return gather(self.ids, self.starts[numbers], lengths), ends[last] - ends[last - per_text]


# Bytes of text worked on at a time, whatever the size of an Arrow batch.
TEXT_BLOCK = 1 << 20


def _cuts(marked: bytes) -> Iterator[bytes]:
    """A long text in parts that end where a chunk does: before a space that follows none."""
    held = b""
    for part in text_parts(marked, TEXT_BLOCK, b" "):
        if held and not held.endswith(b" "):
            yield held
            held = b""
        held += part
    yield held


def _blocks(column: pa.Array) -> Iterator[list[bytes | None]]:
    held, size = [], 0
    for value in column:
        value = value.as_py()
        held.append(value)
        size += len(value or b"")
        if size > TEXT_BLOCK:
            yield held
            held, size = [], 0
    if held:
        yield held


@lru_cache(maxsize=2)
def _vocabulary(path: str) -> Pieces:
    return Pieces(path)


def _lists(texts: list[bytes | None], ids: np.ndarray, counts: np.ndarray) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    missing = pa.array([t is None for t in texts])
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(ids), mask=missing)


class Decoder:
    """Piece ids to text: byte pieces joined to characters, markers to spaces, and the space
    put in front by encoding taken away."""

    def __init__(self, surface: list[bytes]):
        self.flat = np.frombuffer(b"".join(surface), np.uint8)
        self.sizes = np.array([len(s) for s in surface], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def data(self, ids: np.ndarray) -> bytes:
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.sizes)):
            raise ValueError("a piece id outside the vocabulary")
        return gather(self.flat, self.starts[ids], self.sizes[ids]).tobytes().removeprefix(b" ")


def encode_column(spark: SparkSession, text: Column, path: str = MODEL) -> Column:
    """struct<pieces: array<int>, round_trip: boolean> of a text.

    round_trip tells whether the pieces decode to the very text (one with U+2581, which
    reads as a space, does not). Null gives null pieces and no round trip, an empty text no
    pieces. The vocabulary is read on the driver and sent to the tasks once (it has a fixed
    size). Results leave in small batches, so a task's memory does not grow with its texts.
    """
    shared = spark.sparkContext.broadcast(_vocabulary(path))

    @F.arrow_udf("struct<pieces: array<int>, round_trip: boolean>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder, decoder = Encoder(shared.value), Decoder(shared.value.surface)
        for batch in batches:
            for texts in _blocks(batch):
                ids, counts = encoder.encode(texts)
                ends = np.cumsum(counts)
                same = [
                    None if t is None else decoder.data(ids[e - n : e]) == t for t, e, n in zip(texts, ends, counts)
                ]
                columns = [_lists(texts, ids, counts), pa.array(same, pa.bool_())]
                yield pa.StructArray.from_arrays(columns, names=["pieces", "round_trip"])

    return run(text.cast("binary"))


def decode_column(spark: SparkSession, ids: Column, path: str = MODEL) -> Column:
    """The text of piece ids. Null gives null; bytes that form no UTF-8 become U+FFFD; ids
    outside the vocabulary fail."""
    shared = spark.sparkContext.broadcast(_vocabulary(path).surface)

    @F.arrow_udf("string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        decoder = Decoder(shared.value)
        for batch in batches:
            rows = (r.values.to_numpy(zero_copy_only=False) if r.is_valid else None for r in batch)
            yield pa.array([None if r is None else decoder.data(r).decode("utf-8", "replace") for r in rows], pa.string())

    return run(ids)
