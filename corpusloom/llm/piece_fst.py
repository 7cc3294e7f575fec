"""Operator 10. SentencePiece encoding and decoding as a weighted finite-state transducer.

Compiled once per worker from a SentencePiece model file: the normaliser as the file states it (a marker before the text or none, every space becomes a marker) and
the pieces, as a deterministic automaton over bytes whose final states output a piece; byte fallback adds one costly arc per byte.
A piece of rank r costs ln(r + 2.7) plus a constant, as under Zipf's law (the file's scores are ranks); fallback bytes cost far more.
Encoding composes the automaton with each different chunk of a batch (a run of markers and what follows; no piece crosses chunks) at all
positions at once, which gives the lattice's arcs, and relaxes them by end position: the shortest path in the tropical semiring. Among
equal costs the lower piece id wins. Decoding writes the pieces' bytes and turns markers back. Markers are a byte that UTF-8
never has, so a literal marker character of a text goes through byte fallback and every text comes back exactly.

Defined results: null and empty texts have no pieces and decode to the empty string; an empty table gives no rows; equal rows have
equal results; extra columns are ignored or carried as they are; any characters and lengths are taken whole.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructType

from .common import distinct_spans, pieces, span_hashes, utf8

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK, GAP = 0xFF, 0xFE
FALLBACK = 60.0
#: Chunks below which paths are followed one by one, and arcs taken from arrays at a time then.
FEW, SLICE = 32, 1 << 18


def fields(message: bytes):
    """(number, value) of a serialised message's fields: integers, or bytes."""
    at = 0

    def number() -> int:
        nonlocal at
        out = shift = 0
        while True:
            b = message[at]
            at, out, shift = at + 1, out | (b & 127) << shift, shift + 7
            if b < 128:
                return out

    while at < len(message):
        key = number()
        if key & 7 == 0:
            yield key >> 3, number()
        else:
            size = {1: 8, 5: 4}.get(key & 7) or number()
            yield key >> 3, message[at : at + size]
            at += size


def normaliser(model: bytes) -> bool:
    """Whether the model's normaliser puts a marker before each text. Its other rules must be those composed here: spaces become markers, nothing else changes."""
    spec = {2: b"", 3: 1, 4: 1, 5: 1} | dict(fields(dict(fields(model)).get(3, b"")))  # charsmap, dummy prefix, removal of extra white space, escaping
    if spec[2] or spec[4] or not spec[5]:
        raise ValueError("the model's normaliser changes characters or removes white space")
    return bool(spec[3])


class Transducer:
    """States are numbered prefixes of pieces; 0 is the start. arcs: a hash table from state * 256 + byte to the next state."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        sp = SentencePieceProcessor(model_file=path)
        self.prefix = normaliser(sp.serialized_model_proto())
        text, cost, self.byte_id = {}, {}, np.zeros(256, np.int64)
        rank = [-sp.get_score(i) for i in range(len(sp))]
        norm = np.log(sum(1 / (max(r, 0) + 2.7) for r in rank))
        self.bytes = [b""] * len(sp)
        for i in range(len(sp)):
            if sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                continue
            if sp.is_byte(i):
                b = int(sp.id_to_piece(i)[3:5], 16)
                self.byte_id[b], self.bytes[i] = i, bytes([b])
                continue
            self.bytes[i] = sp.id_to_piece(i).encode().replace("▁".encode(), bytes([MARK]))
            text[self.bytes[i]], cost[i] = i, float(np.log(max(rank[i], 0) + 2.7) + norm)
        if any(a != MARK and b == MARK for t in text for a, b in zip(t, t[1:])):
            raise ValueError("a piece crosses the start of a chunk")
        self.longest = max(map(len, text))
        state, arcs, final = {b"": 0}, {}, [-1]
        for t, i in text.items():
            for k in range(1, len(t) + 1):
                if t[:k] not in state:
                    state[t[:k]] = len(state)
                    arcs[state[t[: k - 1]] * 256 + t[k - 1]] = state[t[:k]]
                    final.append(-1)
            final[state[t]] = i
        self.final = np.array(final)
        self.cost = np.array([cost.get(i, FALLBACK) for i in range(len(sp))])
        self.size = np.array([len(b) for b in self.bytes])
        self.flat = np.frombuffer(b"".join(self.bytes), np.uint8)
        self.at = np.cumsum(self.size) - self.size
        self.shift = np.uint64(64 - 20)
        self.keys, self.next, self.probes = np.full((1 << 20) + 64, -1), np.zeros((1 << 20) + 64, np.int64), 1
        for key, to in arcs.items():
            k = int(self.slot(np.array([key]))[0])
            n = 1
            while self.keys[k] >= 0:
                k, n = k + 1, n + 1
            self.keys[k], self.next[k], self.probes = key, to, max(self.probes, n)

    def slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def step(self, state: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """Next states, -1 where there is no arc."""
        key = state * 256 + byte
        slot = self.slot(key)
        seen = self.keys[slot]
        out = np.where(seen == key, self.next[slot], -1)
        left = np.flatnonzero((seen != key) & (seen >= 0))
        for _ in range(self.probes - 1):
            if not len(left):
                break
            slot[left] += 1
            seen = self.keys[slot[left]]
            hit = seen == key[left]
            out[left[hit]] = self.next[slot[left[hit]]]
            left = left[~hit & (seen >= 0)]
        return out

    def paths(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Shortest paths through the chunks data[start:end]: all piece ids, and per chunk the index of its first, end last."""
        n, size = len(starts), ends - starts
        base = np.cumsum(size + 1) - size - 1  # a gap after each chunk; node base + k is before byte k
        rel = np.arange(int((size + 1).sum())) - np.repeat(base, size + 1)
        flat = data[np.minimum(np.repeat(starts, size + 1) + rel, len(data) - 1)]
        flat[base + size] = GAP
        begin, end, piece = [], [], []
        live = np.flatnonzero(flat != GAP)
        state, alone = np.zeros(len(live), np.int64), np.ones(len(flat), bool)
        for k in range(self.longest):
            state = self.step(state, flat[live + k])
            ok = state >= 0
            live, state = live[ok], state[ok]
            done = self.final[state] >= 0
            begin.append(live[done])
            end.append(live[done] + k + 1)
            piece.append(self.final[state[done]])
            if k == 0:
                alone[live[done]] = False
            if not len(live):
                break
        spare = np.flatnonzero(alone & (flat != GAP))
        begin.append(spare)
        end.append(spare + 1)
        piece.append(self.byte_id[flat[spare]])
        begin, end, piece = map(np.concatenate, (begin, end, piece))
        order = np.lexsort((piece, end, rel[end]))
        begin, end, piece = begin[order], end[order], piece[order]
        cuts = np.searchsorted(rel[end], np.arange(int(size.max(initial=0)) + 2))
        best, into = np.full(len(flat), np.inf), np.zeros(len(flat), np.int64)
        best[base] = 0.0
        weight = self.cost[piece]
        few = int(np.sort(size)[-FEW]) + 1 if n >= FEW else 1  # from this end position on fewer than FEW chunks are left
        for a, b in zip(cuts[1:few], cuts[2 : few + 1]):
            if a == b:
                continue
            e, c = end[a:b], best[begin[a:b]] + weight[a:b]
            group = np.flatnonzero(np.diff(e, prepend=-1))
            least = np.minimum.reduceat(c, group)
            won = np.flatnonzero(c == np.repeat(least, np.diff(np.append(group, len(e)))))[::-1]
            into[e[won]] = a + won  # the first of equals is written last
            best[e[group]] = least
        if few < len(cuts):  # an arc at a time, as there is nothing to do at once
            costs = best.tolist()
            for a in range(int(cuts[few]), len(end), SLICE):
                part = slice(a, a + SLICE)
                for i, (x, y, w) in enumerate(zip(begin[part].tolist(), end[part].tolist(), weight[part].tolist()), a):
                    c = costs[x] + w
                    if c < costs[y]:
                        costs[y] = c
                        into[y] = i
        chunk, at, ids, owner = np.arange(n), base + size, [], []
        while len(chunk) >= FEW:
            on = at > base[chunk]
            chunk, at = chunk[on], at[on]
            arc = into[at]
            ids.append(piece[arc])
            owner.append(chunk)
            at = begin[arc]
        for c, k in zip(chunk.tolist(), at.tolist()):
            arcs, first = [], int(base[c])
            while k > first:
                arcs.append(into[k])
                k = begin[arcs[-1]]
            ids.append(piece[np.array(arcs[::-1], np.int64)])
            owner.append(np.full(len(arcs), c))
        ids, owner = np.concatenate(ids[::-1]), np.concatenate(owner[::-1])
        order = np.argsort(owner, kind="stable")
        return ids[order], np.searchsorted(owner[order], np.arange(n + 1))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All piece ids of the texts in order, and per text the index of its first, end last."""
        data, offsets = utf8(texts)
        size = np.diff(offsets)
        marked = np.flatnonzero(size)
        data = np.where(data == 0x20, MARK, data).astype(np.uint8)
        if self.prefix:
            data = np.insert(data, offsets[marked], MARK)
        if not len(data):
            return np.zeros(0, np.int64), np.zeros(len(size) + 1, np.int64)
        first = np.concatenate(([0], np.cumsum(size + (size > 0) * self.prefix)))
        mark = data == MARK
        new = mark.copy()
        new[1:] &= ~mark[:-1]
        new[first[:-1][size > 0]] = True
        starts = np.flatnonzero(new)
        ends = np.append(starts[1:], len(data))
        one, which = distinct_spans(data, starts, ends, span_hashes(data, starts, ends))
        ids, at = self.paths(data, starts[one], ends[one])
        n = np.diff(at)[which]
        total = np.concatenate(([0], np.cumsum(n)))
        flat = ids[np.repeat(at[which] - total[:-1], n) + np.arange(total[-1])]
        return flat, total[np.searchsorted(starts, first)]

    def decode(self, ids: np.ndarray, first: np.ndarray) -> list[bytes]:
        n = self.size[ids]
        total = np.concatenate(([0], np.cumsum(n)))
        data = self.flat[np.repeat(self.at[ids] - total[:-1], n) + np.arange(total[-1])]
        data = np.where(data == MARK, 0x20, data).astype(np.uint8).tobytes()
        cuts = total[first]
        return [data[a + self.prefix : b] if b > a else b"" for a, b in zip(cuts.tolist(), cuts[1:].tolist())]


@lru_cache(maxsize=2)
def transducer(path: str) -> Transducer:
    return Transducer(path)


def _plain(whole: pa.RecordBatch, at: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(whole.columns, names=["text" if i == at else f"c{i}" for i in range(whole.num_columns)])


def encode(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """The columns of docs and `pieces`, array<int>, of each text; a column of that name is replaced."""
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c != "pieces"])
    names = docs.columns
    at = names.index("text")

    def run(batches):
        t = transducer(model)
        for whole in batches:
            for b in pieces(_plain(whole, at)):
                ids, first = t.encode(b.column("text"))
                yield pa.RecordBatch.from_arrays([*b.columns, pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(ids, pa.int32()))], names=[*names, "pieces"])

    return docs.mapInArrow(run, StructType([*docs.schema.fields]).add("pieces", ArrayType(IntegerType())))


def decode(encoded: DataFrame, model: str = MODEL) -> DataFrame:
    """The columns of encoded with `text` restored from `pieces`."""
    names = [c for c in encoded.columns if c != "text"]
    at = names.index("pieces")

    def run(batches):
        t = transducer(model)
        for b in batches:
            lists = b.column(at).cast(pa.list_(pa.int64())).fill_null([])
            first = np.concatenate(([0], np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)))).astype(np.int64)
            texts = t.decode(lists.flatten().to_numpy(zero_copy_only=False), first)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([x.decode() for x in texts], pa.string())], names=[*names, "text"])

    kept = encoded.select(*names)
    return kept.mapInArrow(run, StructType([*kept.schema.fields]).add("text", "string"))


def piece_report(docs: DataFrame, model: str = MODEL, with_pieces: bool = False) -> DataFrame:
    """Per document: doc_id, n_pieces, n_fallback, pieces_sha256 (ids as little-endian int32), round_trip; with_pieces: also the ids."""

    def run(batches):
        t = transducer(model)
        fallback = np.zeros(len(t.size), np.int64)
        fallback[t.byte_id] = 1
        for whole in batches:
            for b in pieces(whole):
                ids, first = t.encode(b.column("text"))
                back = t.decode(ids, first)
                data, offsets = utf8(b.column("text"))
                data, cuts, raw, at = data.tobytes(), offsets.tolist(), ids.astype("<i4").tobytes(), first.tolist()
                same = [back[i] == data[cuts[i] : cuts[i + 1]] for i in range(b.num_rows)]
                sums = np.concatenate(([0], np.cumsum(fallback[ids])))[first]
                columns = [b.column("doc_id"), pa.array(np.diff(first)), pa.array(np.diff(sums)), pa.array([hashlib.sha256(raw[4 * x : 4 * y]).hexdigest() for x, y in zip(at, at[1:])]), pa.array(same)]
                names = ["doc_id", "n_pieces", "n_fallback", "pieces_sha256", "round_trip"]
                if with_pieces:
                    columns.append(pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(ids, pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, names=[*names, "pieces"][: len(columns)])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.select('doc_id').dtypes[0][1]}, n_pieces long, n_fallback long, pieces_sha256 string, round_trip boolean" + ", pieces array<int>" * with_pieces)
