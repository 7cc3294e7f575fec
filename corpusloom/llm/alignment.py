"""Operator 12. Alignment of the tokens that two tokenizers cut a text into.

Both encodings of a text cover the same bytes, so their tokens' end offsets are two increasing lists. Intervals are halved at a
common end: bisecting the first list for the middle of the interval gives a candidate, bisecting the second list tells whether the
candidate is an end there too, and candidates further out on both sides follow in widening steps where it isn't; both halves are searched again, and an
interval without a common end inside is a group. All intervals of a slice of texts are worked on at once, one level of the recursion a round.

The last tokens of a group end together: they are its link. Links are counted over the whole corpus by pair of ids. A document's sums
over its links look the counts up in two ways that together take every link once: pairs with at least one in LINK_SHARE of all links are at
most LINK_SHARE pairs and are broadcast; the others are joined by shuffle.

Tokenizer A is a byte-level BPE read from its JSON file (the file's merges must be its ranks), B a SentencePiece model. A gets a
space before the text, as B puts one there itself.

Defined results: null and empty texts, and texts that either tokenizer doesn't give back byte for byte (a literal U+2581), have no
tokens and counts of 0; an empty table gives no rows; equal rows have equal results, and each counts in the corpus; special tokens' strings are
ordinary text; extra columns are ignored; texts are taken whole.
"""

from __future__ import annotations

import hashlib
import json
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut_lineage, pieces, utf8

BYTE_BPE = "/opt/tokenizers/byte_bpe_50k.json"
PIECES = "/opt/tokenizers/piece_bpe_32k.model"
#: Fixed value: the split pattern of byte-level BPE, in possessive form.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"
LINK_SHARE = 1 << 20
#: Bytes of text a slice holds, unless one text alone has more.
SLICE = 1 << 20


class Tokens:
    """The bytes of each id of a tokenizer, and its encoder of batches to flat ids with the index of each text's first, end last."""

    def __init__(self, entries: list[bytes], encode):
        self.size = np.array([len(e) for e in entries], np.int64)
        self.flat = np.frombuffer(b"".join(entries), np.uint8)
        self.at = np.cumsum(self.size) - self.size
        self._encode = encode

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        lists = self._encode(texts)
        first = np.concatenate(([0], np.cumsum([len(x) for x in lists], dtype=np.int64)))
        return (np.concatenate(lists).astype(np.int64) if first[-1] else np.zeros(0, np.int64)), first

    def bytes_of(self, ids: np.ndarray) -> np.ndarray:
        size = self.size[ids]
        total = np.cumsum(size)
        return self.flat[np.repeat(self.at[ids] - total + size, size) + np.arange(total[-1] if len(total) else 0)]


@lru_cache(maxsize=2)
def byte_level(path: str) -> Tokens:
    """Tokenizer A from its JSON file. Byte-level entries write each byte as a character: printable ones as themselves, the others from U+0100 on."""
    import tiktoken

    with open(path, encoding="utf-8") as f:
        model = json.load(f)
    special, model = {t["content"] for t in model["added_tokens"]}, model["model"]
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    byte = {chr(b): b for b in plain} | {chr(0x100 + k): b for k, b in enumerate(other)}
    ranks = {bytes(byte[c] for c in entry): i for entry, i in model["vocab"].items() if entry not in special}
    merged = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
    if [model["vocab"][m] for m in merged] != list(range(256, 256 + len(merged))):
        raise ValueError("the merges of the file aren't in the order of their ids")
    encoder = tiktoken.Encoding(path, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    entries = [b""] * (max(model["vocab"].values()) + 1)
    for entry, i in ranks.items():
        entries[i] = entry
    return Tokens(entries, lambda texts: [encoder.encode_to_numpy(" " + t, disallowed_special=()) for t in texts])


@lru_cache(maxsize=2)
def sentence_pieces(path: str) -> Tokens:
    """Tokenizer B from its model file; a byte piece is its byte, U+2581 in a piece a space."""
    from sentencepiece import SentencePieceProcessor

    sp = SentencePieceProcessor(model_file=path)
    entries = [bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode() for i in range(len(sp))]
    return Tokens(entries, lambda texts: [np.array(x, np.int64) for x in sp.encode(texts, num_threads=1)])


def spread(starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers start ... start + size - 1 of every range, and the range each belongs to."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    return np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes - starts, sizes), owner


def cuts(end_a: np.ndarray, end_b: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Groups of tokens: the index after the last token of each group, in A and in B.

    a, b: bounds of the texts' tokens; each pair of ranges covers the same bytes. One round halves every open interval.
    """
    out_a, out_b = [], []
    a0, a1, b0, b1 = a[:-1], a[1:], b[:-1], b[1:]
    while len(a0):
        single = (a1 - a0 < 2) | (b1 - b0 < 2)
        out_a.append(a1[single])
        out_b.append(b1[single])
        a0, a1, b0, b1 = (x[~single] for x in (a0, a1, b0, b1))
        start = np.where(a0 > 0, end_a[a0 - 1], 0)
        middle = (start + end_a[a1 - 1]) // 2
        near = np.clip(np.searchsorted(end_a, middle), a0, a1 - 2)
        cut_a, cut_b = np.full(len(a0), -1), np.zeros(len(a0), np.int64)
        open_, reach, wider = np.arange(len(a0)), 0, 1
        while len(open_):  # candidates at distances reach ... reach + wider - 1 from the middle
            lo, hi, mid = a0[open_], a1[open_] - 2, near[open_]
            left = np.maximum(lo, mid - reach - wider + 1)
            right = np.maximum(mid + reach, mid + 1)
            n_left, n_right = np.maximum(mid - reach - left + 1, 0), np.maximum(np.minimum(hi, mid + reach + wider - 1) - right + 1, 0)
            at, owner = spread(np.concatenate((left, right)), np.concatenate((n_left, n_right)))
            owner %= max(len(open_), 1)
            where = np.searchsorted(end_b, end_a[at])
            hit = end_b[np.minimum(where, len(end_b) - 1)] == end_a[at]
            at, where, owner = at[hit], where[hit], owner[hit]
            best = np.lexsort((at, np.abs(end_a[at] - middle[open_[owner]]), owner))
            best = best[np.flatnonzero(np.diff(owner[best], prepend=-1))]
            found = open_[owner[best]]
            cut_a[found], cut_b[found] = at[best], where[best]
            reach, wider = reach + wider, wider * 2
            open_ = open_[(cut_a[open_] < 0) & ((near[open_] - reach >= a0[open_]) | (near[open_] + reach <= a1[open_] - 2))]
        whole = cut_a < 0
        out_a.append(a1[whole])
        out_b.append(b1[whole])
        a0, a1, b0, b1, ca, cb = (x[~whole] for x in (a0, a1, b0, b1, cut_a + 1, cut_b + 1))
        a0, a1, b0, b1 = np.concatenate((a0, ca)), np.concatenate((ca, a1)), np.concatenate((b0, cb)), np.concatenate((cb, b1))
    out_a, out_b = np.concatenate(out_a or [a0]), np.concatenate(out_b or [b0])
    order = np.argsort(out_a, kind="stable")
    return out_a[order], out_b[order]


def token_names(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Decimal ids followed by each separator."""
    return tuple(np.array([f"{i}{mark}" for i in range(n)], object) for mark in ",|;")


class Aligner:
    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = byte_level(path_a), sentence_pieces(path_b)
        self.comma, self.bar, self.semicolon = token_names(max(len(self.a.size), len(self.b.size)))

    def align(self, texts: pa.Array):
        """Per text: counts of A, B, groups; group texts; and the links, by text and pair of ids, with their number."""
        data, offsets = utf8(texts)
        rows = np.flatnonzero(np.diff(offsets))
        given = texts.take(pa.array(rows)).to_pylist()
        (ids_a, first_a), (ids_b, first_b) = self.a.encode(given), self.b.encode(given)
        want = np.insert(data, offsets[rows], 0x20)
        bounds = np.concatenate(([0], np.cumsum(np.diff(offsets)[rows] + 1)))
        same = self._gives_back(self.a, ids_a, first_a, want, bounds) & self._gives_back(self.b, ids_b, first_b, want, bounds)
        ids_a, first_a = self._keep(ids_a, first_a, same)
        ids_b, first_b = self._keep(ids_b, first_b, same)
        rows = rows[same]
        last_a, last_b = cuts(np.cumsum(self.a.size[ids_a]), np.cumsum(self.b.size[ids_b]), first_a, first_b)
        first = np.searchsorted(last_a, first_a, "right")  # groups before each text
        n = len(offsets) - 1
        counts = np.zeros((3, n), np.int64)
        counts[:, rows] = np.diff(first_a), np.diff(first_b), np.diff(first)
        owner = np.repeat(rows, np.diff(first))
        pair = ids_a[last_a - 1] * len(self.b.size) + ids_b[last_b - 1]
        order = np.lexsort((pair, owner))
        owner, pair = owner[order], pair[order]
        new = np.flatnonzero((np.diff(owner, prepend=-1) != 0) | (np.diff(pair, prepend=-1) != 0))
        times = np.diff(np.append(new, len(pair)))
        links = np.searchsorted(owner[new], np.arange(n + 1)), pair[new] // len(self.b.size), pair[new] % len(self.b.size), times
        return counts, self._texts(n, rows, ids_a, ids_b, last_a, last_b, first_a, first_b), links

    @staticmethod
    def _gives_back(tokens: Tokens, ids: np.ndarray, first: np.ndarray, want: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Which texts' tokens join to the wanted bytes; bounds: where each wanted text begins, end last."""
        got, total = tokens.bytes_of(ids), np.concatenate(([0], np.cumsum(tokens.size[ids])))
        start, size = total[first[:-1]], np.diff(total[first])
        same = size == np.diff(bounds)
        at, owner = spread(np.zeros(len(size), np.int64), np.where(same, size, 0))
        same[owner[got[start[owner] + at] != want[bounds[owner] + at]]] = False
        return same

    @staticmethod
    def _keep(ids: np.ndarray, first: np.ndarray, same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        size = np.diff(first)
        return ids[np.repeat(same, size)], np.concatenate(([0], np.cumsum(size[same])))

    def _texts(self, n, rows, ids_a, ids_b, last_a, last_b, first_a, first_b) -> list[str]:
        """The groups of each text as a1,a2|b1;a3|b2."""
        size_a, size_b = np.diff(last_a, prepend=0), np.diff(last_b, prepend=0)
        at_a = np.arange(len(ids_a)) + np.repeat(last_b - size_b, size_a)
        at_b = np.arange(len(ids_b)) + np.repeat(last_a, size_b)
        parts = np.empty(len(ids_a) + len(ids_b), object)
        parts[at_a], parts[at_b] = self.comma[ids_a], self.comma[ids_b]
        parts[at_a[last_a - 1]], parts[at_b[last_b - 1]] = self.bar[ids_a[last_a - 1]], self.semicolon[ids_b[last_b - 1]]
        out, first = [""] * n, (first_a + first_b).tolist()
        for k, row in enumerate(rows.tolist()):
            out[row] = "".join(parts[first[k] : first[k + 1]].tolist())[:-1]
        return out


@lru_cache(maxsize=2)
def aligner(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


def align(docs: DataFrame, vocabulary: str = BYTE_BPE, model: str = PIECES, with_groups: bool = False) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, groups_sha256 and links, array<struct<a, b, times>> of its different linked pairs of ids; with_groups: also the groups."""

    def run(batches):
        work = aligner(vocabulary, model)
        for whole in batches:
            for batch in pieces(whole, most=SLICE):
                counts, groups, (first, a, b, times) = work.align(batch.column("text"))
                links = pa.StructArray.from_arrays([pa.array(x, pa.int32()) for x in (a, b, times)], names=["a", "b", "times"])
                columns = [batch.column("doc_id"), *map(pa.array, counts), pa.array([hashlib.sha256(g.encode()).hexdigest() if g else "" for g in groups]), pa.ListArray.from_arrays(pa.array(first, pa.int32()), links)]
                names = ["doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "links"]
                if with_groups:
                    columns, names = [*columns, pa.array(groups)], [*names, "groups"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    docs = docs.select("doc_id", "text")
    schema = f"doc_id {docs.dtypes[0][1]}, n_a long, n_b long, n_groups long, groups_sha256 string, links array<struct<a:int,b:int,times:int>>" + ", groups string" * with_groups
    return docs.mapInArrow(run, schema)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """Per linked pair of ids over the corpus: a, b, n, and best, whether no pair with the same b has more."""
    pairs = aligned.select(F.explode("links").alias("x")).groupBy("x.a", "x.b").agg(F.sum("x.times").alias("n"))
    return pairs.withColumn("best", F.col("n") == F.max("n").over(Window.partitionBy("b")))


def alignment_report(docs: DataFrame, vocabulary: str = BYTE_BPE, model: str = PIECES, share: int = LINK_SHARE) -> DataFrame:
    """Per document the columns of align without the links themselves, n_links, and over its links n_best and count_sum."""
    aligned = cut_lineage(align(docs, vocabulary, model).withColumn("row", F.monotonically_increasing_id()))
    pairs = cut_lineage(pair_counts(aligned))
    total = pairs.agg(F.sum("n")).first()[0] or 0
    links = aligned.select("row", F.explode("links").alias("x")).select("row", "x.*")
    common, rare = F.broadcast(pairs.where(F.col("n") * share >= total)), pairs.where(F.col("n") * share < total)
    sums = [F.sum(F.col("times") * F.col("best").cast("long")).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum")]
    looked_up = links.join(common, ["a", "b"]).groupBy("row").agg(*sums)
    joined = links.join(common, ["a", "b"], "left_anti").join(rare, ["a", "b"]).groupBy("row").agg(*sums)
    found = looked_up.union(joined).groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    n_links = F.aggregate("links", F.lit(0).cast("long"), lambda s, x: s + x["times"]).alias("n_links")
    rows = aligned.select("row", "doc_id", "n_a", "n_b", "n_groups", n_links, "groups_sha256")
    return rows.join(found, "row", "left").select("doc_id", "n_a", "n_b", "n_groups", "n_links", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_best", "count_sum")], "groups_sha256")
