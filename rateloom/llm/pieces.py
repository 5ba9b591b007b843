"""SentencePiece segmentations drawn from a piece lattice, and their decoding.

A text is cut before every run of spaces, where no piece reaches over; such a unit is a path through the lattice of
vocabulary pieces, and a segmentation is drawn with odds in proportion to the product of its pieces' weights: sums of weights over all paths to each position are
filtered forward, then pieces are drawn backward from the unit's end. The random numbers come from the row's key, the
unit's number and the position, so a rerun, another batch or another executor draws the same. Characters without a path
become byte pieces, as SentencePiece has them; decoding the ids gives back the exact text.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rateloom.llm.shared import held, lists, map_batches, mix64

SCHEMA = "doc_id long, n_pieces long, ids_crc32 long, lossless boolean, ids array<int>"
#: Units up to so many characters are filtered many at once; longer ones alone, in stretches, with their sums carried along.
UNIT_CHARS = 32
STRETCH = 65_536
#: A piece's weight falls with its place in the vocabulary: 1 / (place + FLAT) ** sharpness. A piece for a bare byte weighs least.
FLAT, BYTE_WEIGHT = 10.0, 1e-8
#: Factor for every character, so that sums over paths of a unit filtered with others stay within a double's range.
PER_CHAR = 1e3
#: Units, and edges of their lattices (9 bytes each), that a worker remembers before it starts afresh. Long units are not
#: remembered.
REMEMBERED, REMEMBERED_EDGES = 150_000, 4_000_000
LEARNED_AT_ONCE = 5_000
#: Characters that are worked on at once; what is learned from them comes on top of what is remembered.
CHARS_AT_ONCE = 500_000


class _Grown:
    """An array that grows at its end."""

    def __init__(self, kind):
        self.room, self.n = np.empty(1 << 16, kind), 0

    def extend(self, values: np.ndarray) -> None:
        if self.n + len(values) > len(self.room):
            room = np.empty(max(len(self.room) * 3 // 2, self.n + len(values)), self.room.dtype)
            room[:self.n] = self.room[:self.n]
            self.room = room
        self.room[self.n:self.n + len(values)] = values
        self.n += len(values)

    @property
    def all(self) -> np.ndarray:
        return self.room[:self.n]


class PieceLattice:
    """Lattices of distinct units, and draws from them for many places at once.

    ``model_file``: a SentencePiece model with byte fallback whose normaliser leaves texts as they are.
    """

    def __init__(self, model_file: str, sharpness: float = 1.0):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.size = model.get_piece_size()
        self.bytes: list[bytes] = []
        pieces: dict[str, tuple[int, float]] = {}
        self.byte_id = np.zeros(256, np.int64)
        ordinary = [i for i in range(self.size) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        place = {i: k for k, i in enumerate(sorted(ordinary, key=lambda i: (-model.get_score(i), i)))}
        for i in range(self.size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_id[int(piece[3:-1], 16)] = i
                self.bytes.append(bytes([int(piece[3:-1], 16)]))
            else:
                text = piece.replace("▁", " ")
                self.bytes.append(text.encode() if i in place else b"")
                if i in place:
                    pieces[text] = (i, (1.0 / (place[i] + FLAT)) ** sharpness * PER_CHAR ** len(text))
        # prefixes of pieces as numbered states; a step is found by its state and character
        states = {"": 0}
        for text in sorted(pieces, key=len):
            for n in range(1, len(text) + 1):
                states.setdefault(text[:n], len(states))
        steps = sorted((states[t[:-1]] << 21 | ord(t[-1]), s) for t, s in states.items() if t)
        self.steps = np.array([*(k for k, _ in steps), 1 << 62], np.int64)
        self.next = np.array([*(s for _, s in steps), 0], np.int64)
        self.ends = np.full(len(states), -1, np.int64)
        self.weights = np.zeros(len(states))
        for text, (i, weight) in pieces.items():
            self.ends[states[text]], self.weights[states[text]] = i, weight
        self.longest = max(map(len, pieces), default=1)
        self.spaces_begin = not any(re.search("[^ ] ", text) for text in pieces)
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.first_node, self.length = _Grown(np.int64), _Grown(np.int64)  # of each known unit
        self.first_edge = _Grown(np.int64)  # of each node: the first of the pieces that end there
        self.share, self.back, self.piece = _Grown(np.float32), _Grown(np.int8), _Grown(np.int32)  # of each edge

    def _edges(self, chars: np.ndarray, left: np.ndarray) -> Iterator[tuple[np.ndarray, int, np.ndarray, np.ndarray]]:
        """Starts, length, ids and weights of the pieces that stand in the units, by length."""
        at, state = np.arange(len(chars)), np.zeros(len(chars), np.int64)
        for n in range(1, self.longest + 1):
            fits = np.flatnonzero(left[at] >= n)
            at, state = at[fits], state[fits]
            if not len(at):
                break
            key = state << 21 | chars[at + (n - 1)]
            k = np.searchsorted(self.steps, key)
            there = np.flatnonzero(self.steps[k] == key)
            if n == 1:
                alone = np.ones(len(chars), bool)
                alone[at[there][self.ends[self.next[k[there]]] >= 0]] = False
                bare = np.flatnonzero(alone)
                yield bare, 1, self.size + chars[bare], np.full(len(bare), BYTE_WEIGHT * PER_CHAR)
            at, state = at[there], self.next[k[there]]
            whole = np.flatnonzero(self.ends[state] >= 0)
            yield at[whole], n, self.ends[state[whole]], self.weights[state[whole]]

    def _learn(self, units: list[str]) -> None:
        """Filter forward: for every position the sum over paths to it, and each last piece's share in that sum."""
        chars = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        length = np.array([len(u) for u in units], np.int64)
        first = np.cumsum(length) - length
        number = np.repeat(np.arange(len(units)), length)
        inside = np.arange(len(chars)) - first[number]
        nodes, roots = len(chars) + len(units), first + np.arange(len(units))  # a unit has a node more than characters
        weight, piece = np.zeros((nodes, self.longest)), np.zeros((nodes, self.longest), np.int32)
        for start, n, what, how in self._edges(chars, length[number] - inside):
            to = start + number[start] + n
            weight[to, self.longest - n], piece[to, self.longest - n] = how, what  # longest first
        sums = np.zeros(nodes)
        sums[roots] = 1.0
        for depth in range(1, int(length.max()) + 1):
            to = roots[length >= depth] + depth
            total = np.zeros(len(to))
            for n in range(1, min(depth, self.longest) + 1):
                total += sums[to - n] * weight[to, self.longest - n]
            sums[to] = total
        end, column = np.nonzero(weight)
        back = self.longest - column
        running = np.cumsum(sums[end - back] * weight[end, column] / sums[end])
        per_node = np.bincount(end, minlength=nodes)
        first_edge = np.cumsum(per_node) - per_node
        cum = running - np.append(0.0, running)[first_edge[end]]
        cum[(first_edge + per_node - 1)[per_node > 0]] = 2.0
        self.first_node.extend(self.first_edge.n + roots)
        self.length.extend(length)
        self.first_edge.extend(self.share.n + first_edge)
        self.share.extend(cum)
        self.back.extend(back)
        self.piece.extend(piece[end, column])

    def _learn_long(self, unit: str) -> None:
        """The same for one unit of any length: sums are carried from stretch to stretch, and scaled where they grow or shrink."""
        codes = np.frombuffer(unit.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        self.first_node.extend(np.array([self.first_edge.n], np.int64))
        self.length.extend(np.array([len(codes)], np.int64))
        self.first_edge.extend(np.array([self.share.n], np.int64))  # of the node before the first character
        sums = [1.0]  # of the nodes from `base` on
        base = 0
        for a in range(0, len(codes), STRETCH):
            first = max(0, a - self.longest)
            chars = codes[first:a + STRETCH]
            found = [(start + n + first, np.full(len(start), n), what, how) for start, n, what, how in self._edges(chars, len(chars) - np.arange(len(chars)))]
            end, back, piece, value = (np.concatenate(c) for c in zip(*found, strict=True))
            order = np.lexsort((-back, end))  # longest first
            order = order[end[order] > a]
            end, back, piece, value = end[order], back[order], piece[order], value[order]
            sums, base = sums[first - base:], first
            per_node = np.bincount(end - a - 1, minlength=first + len(chars) - a)
            share, backs, values, k = [], back.tolist(), value.tolist(), 0
            for n_edges in per_node.tolist():
                running, node = [], len(sums)
                total = 0.0
                for e in range(k, k + n_edges):
                    total += sums[node - backs[e]] * values[e]
                    running.append(total)
                k += n_edges
                share += [r / total for r in running[:-1]]
                share.append(2.0)
                sums.append(total)
                if not 1e-60 < total < 1e60:
                    sums[-self.longest:] = [x / total for x in sums[-self.longest:]]
            self.first_edge.extend(self.share.n + np.cumsum(per_node) - per_node)
            self.share.extend(np.array(share))
            self.back.extend(back)
            self.piece.extend(piece)

    def units(self, text: str) -> list[str]:
        text = " " + text
        if not self.spaces_begin:
            return [text]
        return re.findall(" +[^ ]*", text) if "  " in text else [" " + w for w in text.split(" ")[1:]]

    def draw(self, texts: list[str], seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and the number of ids of each text. An empty text has no pieces."""
        if len(self.known) > REMEMBERED or self.share.n > REMEMBERED_EDGES:
            self.forget()
        known, index, counts = self.known, [], np.zeros(len(texts), np.int64)
        before, columns = len(known), (self.first_node, self.length, self.first_edge, self.share, self.back, self.piece)
        long: list[str] = []
        for k, text in enumerate(texts):
            if text:
                units = self.units(text)
                counts[k] = len(units)
                index += [known.setdefault(u, len(known)) for u in units]
        if len(known) > before:
            new = list(islice(known, before, None))
            order = sorted(range(len(new)), key=lambda k: len(new[k]) > UNIT_CHARS)  # long ones last
            numbers = np.arange(len(known))
            numbers[before + np.array(order)] = np.arange(before, len(known))
            new = [new[k] for k in order]
            known.update(zip(new, range(before, len(known)), strict=True))
            index = numbers[index]
            short = sum(len(u) <= UNIT_CHARS for u in new)
            for k in range(0, short, LEARNED_AT_ONCE):
                self._learn(new[k:min(short, k + LEARNED_AT_ONCE)])
            long, remembered = new[short:], [c.n for c in columns]
            for u in long:
                self._learn_long(u)
        unit = np.array(index, np.int64)
        if not len(unit):
            return np.zeros(0, np.int32), counts
        first_edge, share, back, piece = self.first_edge.all, self.share.all, self.back.all, self.piece.all
        at = self.length.all[unit]
        start = self.first_node.all[unit]
        ordinal = np.arange(len(unit)) - np.repeat(np.cumsum(counts) - counts, counts)
        own = mix64(np.repeat(seeds, counts) + ordinal.astype(np.uint64))
        going = np.arange(len(unit))
        drawn: list[tuple[np.ndarray, np.ndarray]] = []
        n_pieces = np.zeros(len(unit), np.int64)
        while len(going):
            random = (own >> np.uint64(12)).astype(np.float64) / float(1 << 52)
            k = first_edge[start + at]
            behind = np.flatnonzero(random >= share[k])
            while len(behind):
                k[behind] += 1
                behind = behind[random[behind] >= share[k[behind]]]
            drawn.append((going, piece[k]))
            n_pieces[going] += 1
            at = at - back[k]
            more = np.flatnonzero(at)
            going, at, start = going[more], at[more], start[more]
            own = mix64(own[more])
        if long:  # they were learned last
            for u in long:
                del known[u]
            for column, n in zip(columns, remembered, strict=True):
                column.n = n
        ends = np.cumsum(n_pieces)
        out = np.empty(int(ends[-1]), np.int64)
        for step, (who, what) in enumerate(drawn):  # drawn from the end
            out[ends[who] - 1 - step] = what
        of_text = np.add.reduceat(np.append(n_pieces, 0), np.minimum(np.cumsum(counts) - counts, len(unit))) * (counts > 0)
        if (bare := np.flatnonzero(out >= self.size)).size:
            raw = [chr(c - self.size).encode() for c in out[bare].tolist()]
            times = np.ones(len(out), np.int64)
            times[bare] = [len(r) for r in raw]
            spread = np.repeat(out, times)
            places = np.repeat((np.cumsum(times) - times)[bare], times[bare])
            places += np.concatenate([np.arange(len(r)) for r in raw])
            spread[places] = self.byte_id[np.frombuffer(b"".join(raw), np.uint8)]
            owner = np.repeat(np.arange(len(texts)), of_text)
            out, of_text = spread, np.bincount(np.repeat(owner, times), minlength=len(texts))
        return out.astype(np.int32), of_text

    def decode(self, ids: list[int]) -> bytes:
        """The text's UTF-8 bytes: pieces joined, without the space that stands before every text."""
        return b"".join(map(self.bytes.__getitem__, ids))[1:]


def lattice(model_file: str, sharpness: float) -> PieceLattice:
    """One lattice for a worker's life."""
    return held("pieces", (model_file, sharpness), lambda: PieceLattice(model_file, sharpness))


def row_seeds(keys: list[int | None], seed: int) -> np.ndarray:
    numbers = np.array([0x5EED if k is None else k & 0xFFFFFFFFFFFFFFFF for k in keys], np.uint64)
    return mix64(numbers ^ mix64(np.array([seed], np.uint64)))


def sample_pieces(df: DataFrame, model_file: str, sharpness: float = 1.0, seed: int = 7, id_column: str = "doc_id",
                  text_column: str = "text") -> DataFrame:
    """Per row, over the whole text: doc_id, n_pieces, ids_crc32, lossless, ids.

    Missing and empty texts have no pieces. Rows with equal key and text have equal ids; a missing key is a key of its own.
    ``lossless`` says that the decoded ids are the text; ``ids_crc32`` is over the ids as little-endian unsigned 32 bits.
    """

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = lattice(model_file, sharpness)
        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()]
            first = 0
            while first < len(texts):
                last, chars = first, 0
                while last < len(texts) and (last == first or chars + len(texts[last]) <= CHARS_AT_ONCE):
                    chars += len(texts[last])
                    last += 1
                part = texts[first:last]
                ids, counts = own.draw(part, row_seeds(keys[first:last], seed))
                ends = np.cumsum(counts)
                crcs, same = [], []
                for text, a, b in zip(part, ends - counts, ends, strict=True):
                    crcs.append(zlib.crc32(ids[a:b].astype("<u4").tobytes()))
                    same.append(own.decode(ids[a:b].tolist()) == text.encode())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[first:last], pa.int64()), pa.array(counts, pa.int64()), pa.array(crcs, pa.int64()),
                     pa.array(same), lists(ids, counts, pa.int32())],
                    names=["doc_id", "n_pieces", "ids_crc32", "lossless", "ids"])
                first = last

    rows = df.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return map_batches(rows, sample, SCHEMA)


def decode_pieces(df: DataFrame, model_file: str, id_column: str = "doc_id", ids_column: str = "ids") -> DataFrame:
    """doc_id, text: the texts that the ids stand for. Missing ids are an empty text."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = lattice(model_file, 1.0)
        for batch in batches:
            texts = [own.decode(ids or []).decode() for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    rows = df.select(F.col(id_column).cast("long").alias("doc_id"), F.col(ids_column).cast("array<int>").alias("ids"))
    return map_batches(rows, decode, "doc_id long, text string")
