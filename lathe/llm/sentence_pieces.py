"""SentencePiece encoding by forward-filtering backward-sampling, and lossless
decoding.

The lattice of a text has a node per character border and an edge per piece.
Forward filtering adds up, for every border, the weights of all segmentations
that end there; backward sampling then draws pieces from the end of the text,
each with its exact posterior probability. The draw at a border depends only
on the row key and the border's position, so a row's segmentation is the same
in every run, batch and layout.

No piece of the vocabulary continues past a space mark that follows other
characters (checked when a model is loaded), so the lattice falls apart into
space-led units; forward tables of units are kept per worker and the draws of
all units of a batch run side by side in numpy.

Weights: a unigram model's scores are log probabilities and used as they are.
A BPE model's scores are minus the merge ranks; a piece of rank r then weighs
1 / (r + 2) (Zipf's law). ``theta`` raises weights to a power: larger values
favour the best segmentation.

Encoding follows the model file: the dummy prefix, spaces as marks, no other
normalization, bytes for characters without a piece. A literal space mark in
the text is written as bytes, so decoding gives back every text exactly.

Defined results: a null text counts as empty; an empty text has no ids;
a null key draws like the key "null"; rows with the same key and text get the
same ids; an empty table gives an empty result; other columns are ignored.
Very long texts are one row of one batch; a unit of any length is walked with
rescaled sums, so weights do not underflow.
"""

from __future__ import annotations

import math
import re
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lathe.llm.common import table, text_or_empty
from lathe.llm.registry import register

MARK = "▁"
THETA = 1.0
LEAST = 1e-80  # smallest weight of a piece, so that sums over one piece's reach stay above 0
SEED = 11
EDGES = 2_000_000  # edges of forward tables kept per worker; then they start anew (most units are rare)
CHARS = 1_000_000  # characters of texts encoded side by side

_UNIT = re.compile("▁*[^▁\n]+|▁+|\n")
_LIT = "\x00"
_U = np.uint64
_MODELS: dict = {}


_P = _U(0x9E3779B97F4A7C15)
SHORT = 40  # units up to this length are tabled side by side
TABLED_AT_ONCE = 100_000  # characters of such units


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(_U) + _U(1)


def _prefix_hashes(rows: np.ndarray) -> np.ndarray:
    """Polynomial hash of each row of character codes."""
    h = np.zeros(len(rows), _U)
    with np.errstate(over="ignore"):
        for k in range(rows.shape[1]):
            h = h * _P + rows[:, k]
    return h


class Pieces:
    """Vocabulary of a model file."""

    def __init__(self, model: bytes, theta: float = THETA):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.byte, self.piece, self.bytes_of = {}, {}, []
        skip = lambda i: sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)
        scores = [sp.get_score(i) for i in range(sp.get_piece_size())]
        ranked = all(s == int(s) for s in scores) and min(scores) < -100
        for i, score in enumerate(scores):
            text = sp.id_to_piece(i)
            if sp.is_byte(i):
                b = int(text[3:5], 16)
                self.byte[b] = i
                self.bytes_of.append(bytes([b]))
            else:
                self.bytes_of.append(b"" if skip(i) else text.replace(MARK, " ").encode())
                if not skip(i):
                    self.piece[text] = (i, max(LEAST, math.exp(theta * (-math.log(2 - score) if ranked else score))))
        if len(self.byte) != 256:
            raise ValueError("the model has no byte fallback: decoding would lose characters")
        if any(MARK in p.lstrip(MARK) or "\n" in p or "\x00" in p for p in self.piece):
            raise ValueError("a piece crosses a space: units are not independent")
        self.longest = max(map(len, self.piece))
        self.by_prefix = []  # of each length: sorted hashes of the pieces' beginnings, ids (-1: no piece itself) and weights
        for n in range(1, self.longest + 1):
            own = list({t[:n] for t in self.piece if len(t) >= n})
            h = _prefix_hashes(_codes("".join(own)).reshape(-1, n))
            order = np.argsort(h)
            if len(np.unique(h)) != len(h):
                raise ValueError("two beginnings of pieces share a hash")
            got = [self.piece.get(own[k], (-1, 0.0)) for k in order]
            self.by_prefix.append((h[order], np.array([g[0] for g in got], np.int32),
                                   np.array([g[1] for g in got], np.float64)))
        self.fallback = max(LEAST, math.exp(-theta * math.log(len(scores))))


class Lattices:
    """Forward tables of units. Node ``base + e`` is border ``e`` of a unit; its
    edges stand one after the other from ``first`` on, by cumulative
    probability, so a draw walks the few edges of its own border."""

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self.clear()

    def clear(self):
        self.index: dict[str, int] = {}
        self.base, self.size = array("q"), array("q")
        self.first, self.chance = array("i"), array("d")
        self.start, self.id = array("i"), array("i")
        self.nodes, self.fallbacks = 0, []

    def add(self, unit: str) -> int:
        p, n = self.pieces, len(unit)
        if unit == _LIT * 2:  # a literal mark: one edge of bytes over both borders
            return self._single(unit, MARK.encode())
        get, longest = p.piece.get, p.longest
        alpha = [1.0]
        self.first.append(len(self.id))
        for e in range(1, n + 1):
            found = []
            for s in range(max(0, e - longest), e):
                hit = get(unit[s:e])
                if hit:
                    found.append((s, hit[0], alpha[s] * hit[1]))
            if not found or found[-1][0] != e - 1:  # the character itself has no piece
                raw = unit[e - 1].encode()
                if len(raw) == 1:
                    found.append((e - 1, p.byte[raw[0]], alpha[e - 1] * p.fallback))
                else:
                    self.fallbacks.append([p.byte[b] for b in raw])
                    found.append((e - 1, -len(self.fallbacks), alpha[e - 1] * max(LEAST, p.fallback ** len(raw))))
            total = sum(w for _, _, w in found)
            alpha.append(total)
            if total < 1e-200:  # only ratios inside the reach of a piece matter
                for k in range(max(0, e - longest), e + 1):
                    alpha[k] *= 1e200
            run = 0.0
            self.first.append(len(self.id))
            for s, i, w in found:
                run += w / total
                self.chance.append(run)
                self.start.append(s)
                self.id.append(i)
            self.chance[-1] = 1.0
        return self._close(unit, n)

    def add_all(self, units: list[str]) -> None:
        """Table many units, the short ones side by side."""
        short, n = [], 0
        for u in units:
            if len(u) > SHORT or u[0] == _LIT:
                self.add(u)
                continue
            short.append(u)
            n += len(u)
            if n >= TABLED_AT_ONCE:
                self._add_short(short)
                short, n = [], 0
        if short:
            self._add_short(short)

    def _edges(self, code: np.ndarray, room: np.ndarray) -> tuple[np.ndarray, ...]:
        """Place, length, id and weight of every piece in the codes; a place is
        followed as long as some piece begins with its characters."""
        p = self.pieces
        at, h, single = np.arange(len(code)), np.zeros(len(code), _U), np.zeros(len(code), bool)
        found = []
        for k, (hashes, piece, w) in enumerate(p.by_prefix):
            here = room[at] > k
            at, h = at[here], h[here]
            if not len(at):
                break
            with np.errstate(over="ignore"):
                h = h * _P + code[at + k]
            hit = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
            here = hashes[hit] == h
            at, h, hit = at[here], h[here], hit[here]
            is_piece = piece[hit] >= 0
            own = hit[is_piece]
            found.append((at[is_piece], np.full(len(own), k + 1), piece[own], w[own]))
            if k == 0:
                single[at[is_piece]] = True
        for i in np.flatnonzero(~single):  # characters without a piece
            raw = chr(int(code[i]) - 1).encode()
            key = p.byte[raw[0]]
            if len(raw) > 1:
                self.fallbacks.append([p.byte[b] for b in raw])
                key = -len(self.fallbacks)
            found.append(([i], [1], [key], [max(LEAST, p.fallback ** len(raw))]))
        return tuple(np.concatenate([f[j] for f in found]) for j in range(4))

    def _add_short(self, short: list[str]) -> None:
        code = _codes("".join(short))
        size = np.array([len(u) for u in short], np.int64)
        at = np.cumsum(size) - size
        room = np.repeat(at + size, size) - np.arange(len(code))  # characters from here to the unit's end
        place, length, ids, weight = self._edges(code, room)
        node = np.cumsum(size + 1) - (size + 1)  # border 0 of each unit
        unit = np.repeat(np.arange(len(short)), size)[place]
        start = place - at[unit]
        end = start + length
        to = node[unit] + end
        order = np.argsort(to * (self.pieces.longest + 1) + length)  # edges of a border together, shortest first
        start, end, to, ids, weight = start[order], end[order], to[order], ids[order], weight[order]
        source = to - end + start
        new = np.append(True, to[1:] != to[:-1])
        alpha = np.zeros(int((size + 1).sum()))
        alpha[node] = 1.0
        part = np.empty(len(to))
        by_end = np.argsort(end.astype(np.int16), kind="stable")
        cut = np.searchsorted(end[by_end], np.arange(1, int(size.max()) + 2))
        for a, b in zip(cut[:-1], cut[1:], strict=True):  # borders 1, 2, ... of all units
            own = by_end[a:b]
            part[own] = alpha[source[own]] * weight[own]
            begins = np.flatnonzero(new[own])
            alpha[to[own[begins]]] = np.add.reduceat(part[own], begins)
        turn = np.arange(len(to)) - np.flatnonzero(new)[np.cumsum(new) - 1]  # place among the border's edges
        for k in range(1, int(turn.max()) + 1):
            own = np.flatnonzero(turn == k)
            part[own] += part[own - 1]
        part /= alpha[to]
        part[np.append(new[1:], True)] = 1.0
        many = np.bincount(to, minlength=len(alpha))
        self.first.frombytes((len(self.id) + np.cumsum(many) - many).astype(np.int32).tobytes())
        self.chance.frombytes(part.tobytes())
        self.start.frombytes(start.astype(np.int32).tobytes())
        self.id.frombytes(ids.astype(np.int32).tobytes())
        first = len(self.base)
        self.base.frombytes((self.nodes + node).tobytes())
        self.size.frombytes(size.tobytes())
        self.nodes += len(alpha)
        self.index.update(zip(short, range(first, first + len(short))))

    def _single(self, unit: str, raw: bytes) -> int:
        self.fallbacks.append([self.pieces.byte[b] for b in raw])
        self.first.append(len(self.id))
        for _ in unit:
            self.first.append(len(self.id))
            self.chance.append(1.0)
            self.start.append(0)
            self.id.append(-len(self.fallbacks))
        return self._close(unit, len(unit))

    def _close(self, unit: str, n: int) -> int:
        self.base.append(self.nodes)
        self.size.append(n)
        self.nodes += n + 1
        self.index[unit] = len(self.base) - 1
        return len(self.base) - 1


def _mix(x: np.ndarray) -> np.ndarray:
    """Mixed in place."""
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def key_seeds(keys: list) -> np.ndarray:
    import xxhash

    return np.array([xxhash.xxh64_intdigest("null" if k is None else str(k), SEED) for k in keys], _U)


def units_of(text: str) -> list[str]:
    """Units of a text. A literal mark becomes a pair of zero characters, a
    unit of its own, and so does a zero character."""
    if not text:
        return []
    if MARK not in text and _LIT not in text:
        return _UNIT.findall(MARK + text.replace(" ", MARK))
    out = [MARK] if text[0] in (MARK, _LIT) else []
    for k, part in enumerate(re.split("(▁|\x00)", text)):
        if part in (MARK, _LIT):
            out.append(_LIT * 2 if part == MARK else _LIT)
        elif part:
            out += _UNIT.findall((MARK if k == 0 else "") + part.replace(" ", MARK))
    return out


def encode(texts: list[str], seeds: np.ndarray, lattices: Lattices) -> tuple[np.ndarray, np.ndarray]:
    """Flat ids and the number of ids of each text."""
    if len(lattices.id) > EDGES:
        lattices.clear()
    index = lattices.index
    split = [units_of(t) for t in texts]
    lattices.add_all([u for u in set(chain.from_iterable(split)) if u not in index])
    per_text = np.array([len(u) for u in split], np.int64)
    unit = np.fromiter(map(index.__getitem__, chain.from_iterable(split)), np.int64, int(per_text.sum()))
    base, size = np.frombuffer(lattices.base, np.int64), np.frombuffer(lattices.size, np.int64)
    first, chance, start, ids = (np.frombuffer(x, t) for x, t in (
        (lattices.first, np.int32), (lattices.chance, np.float64), (lattices.start, np.int32), (lattices.id, np.int32)))
    if not len(unit):
        return np.zeros(0, np.int64), per_text * 0
    row = np.repeat(np.arange(len(texts)), per_text)
    ends = np.cumsum(size[unit])
    offset = ends - size[unit]  # position of a unit in its text
    offset -= np.repeat(offset[np.minimum(np.cumsum(per_text) - per_text, len(offset) - 1)], per_text)
    live, border, steps = np.arange(len(unit)), size[unit].copy(), []
    node0, seed = base[unit], seeds[row] + offset.astype(_U) * _P
    n_ids = np.zeros(len(unit), np.int64)
    while len(live):
        x = _mix(seed[live] + border.astype(_U) * _P)
        draw = (x >> _U(40)) / 2.0**24
        edge = first[node0[live] + border]
        more = np.flatnonzero(chance[edge] <= draw)
        while len(more):
            edge[more] += 1
            more = more[chance[edge[more]] <= draw[more]]
        steps.append((live, ids[edge]))
        n_ids[live] += 1
        border = start[edge]
        go = border > 0
        live, border = live[go], border[go]
    last = np.cumsum(n_ids)
    flat = np.empty(int(last[-1]), np.int64)
    for k, (who, what) in enumerate(steps):  # drawn from the end of each unit
        flat[last[who] - 1 - k] = what
    n_row = np.bincount(row, weights=n_ids, minlength=len(texts)).astype(np.int64)
    return _with_bytes(flat, n_row, lattices) if (flat < 0).any() else (flat, n_row)


def _with_bytes(flat: np.ndarray, n_row: np.ndarray, lattices: Lattices) -> tuple[np.ndarray, np.ndarray]:
    """Characters without a piece (negative ids) replaced by their bytes."""
    where = np.flatnonzero(flat < 0)
    runs = [lattices.fallbacks[-v - 1] for v in flat[where]]
    wide = np.ones(len(flat), np.int64)
    wide[where] = [len(r) for r in runs]
    end = np.cumsum(wide)
    out = np.repeat(flat, wide)
    for w, r in zip(where, runs, strict=True):
        out[end[w] - len(r):end[w]] = r
    row = np.repeat(np.arange(len(n_row)), n_row)
    return out, np.bincount(row, weights=wide, minlength=len(n_row)).astype(np.int64)


def decode(ids, pieces: Pieces) -> str:
    return b"".join(map(pieces.bytes_of.__getitem__, ids)).decode()[1:]


def _loaded(model: bytes, theta: float) -> Lattices:
    key = (hash(model), theta)
    if key not in _MODELS:
        _MODELS[key] = Lattices(Pieces(model, theta))
    return _MODELS[key]


def _slices(texts: pa.Array) -> Iterator[slice]:
    at = n = 0
    for i, chars in enumerate(pc.utf8_length(texts).to_pylist()):
        n += chars
        if n >= CHARS:
            yield slice(at, i + 1)
            at, n = i + 1, 0
    if at < len(texts):
        yield slice(at, len(texts))


def encode_rows(df: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text",
                theta: float = THETA) -> DataFrame:
    """``id, n_chars, n_tokens, ids, lossless``; ``lossless`` tells that the ids
    decode to the row's text. The model file is broadcast (one vocabulary)."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    kind = df.schema[id_col].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattices = _loaded(shared.value, theta)
        for batch in batches:
            for part in _slices(batch.column(1)):
                own, texts = (batch.column(i).slice(part.start, part.stop - part.start) for i in (0, 1))
                some = texts.to_pylist()  # a slice at a time: decoded text is larger than the batch
                flat, n = encode(some, key_seeds(own.to_pylist()), lattices)
                ends = np.concatenate([[0], np.cumsum(n)])
                listed = flat.tolist()
                back = [decode(listed[a:b], lattices.pieces) == t for a, b, t in zip(ends[:-1], ends[1:], some, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [own, pa.array([len(t) for t in some], pa.int64()), pa.array(n, pa.int64()),
                     pa.ListArray.from_arrays(ends.astype(np.int32), pa.array(flat.astype(np.int32))),
                     pa.array(back, pa.bool_())], names=["_id", "n_chars", "n_tokens", "ids", "lossless"])

    out = df.select(F.col(id_col).alias("_id"), text_or_empty(text_col).alias("_text")).mapInArrow(
        run, f"_id {kind.simpleString()}, n_chars long, n_tokens long, ids array<int>, lossless boolean")
    return out.withColumnRenamed("_id", id_col)


def decode_rows(df: DataFrame, model: bytes, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``id, text`` from ids (null ids: empty text)."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    kind = df.schema[id_col].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _loaded(shared.value, THETA).pieces
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([decode(i or [], pieces) for i in batch.column(1).to_pylist()], pa.string())],
                names=["_id", "text"])

    out = df.select(F.col(id_col).alias("_id"), F.col(ids_col).alias("_ids")).mapInArrow(
        run, f"_id {kind.simpleString()}, text string")
    return out.withColumnRenamed("_id", id_col)


def production_model() -> bytes:
    import public_tokenizers

    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
        return f.read()


@register("op2_sentence_pieces")
def op2_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_rows(table(spark, sf_dir, "documents"), production_model())
