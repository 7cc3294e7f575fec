"""Operator 9. Suffix-array dedup: removes every byte that a repeated string of `length` bytes covers.

Bucket-pointer refinement. Each byte position starts in the bucket of its first byte; buckets of 2, 4, ... 64 bytes come from refining a
position's bucket by the bucket of the position half as far on, with the buckets of each round reused in the next. Identifiers are 64-bit
fingerprints, so tasks agree on them without sorting all suffixes in one place. The bucket of a 200-byte string is refined from those at
offsets 0, 64, 128 and 136.

Only some suffixes travel. Every string of 200 bytes has a minimiser, the least 64-byte bucket in it; equal strings share it. Consecutive
starts with one minimiser, at one place, form a run, the first kind of cell. A cell has a core, the bytes that all its strings share, and a
content, all its bytes. Cells of equal content are repeated from end to end. A cell that has no equal is lone; if others share its core, one cell of each
content in the core's bucket is split into cells of 16 starts, aligned at the minimiser, those into cells of 4, and those into
single starts, which are again grouped by core and content. So few rows travel where long stretches agree. What is repeated is
what was looked at and isn't lone; the last pass needs only the lone contents of each text.

Which cells to look at is handed to the tasks as bitmaps of 2 ** `bits` bits (16 MB at the default), whatever the corpus; a false
positive only adds rows to an exact count. The contents of each round are written to the shared folder.

Defined results: null and empty texts and those shorter than `length` lose nothing; equal texts of `length` bytes or more lose
everything, repeated rows included; a null doc_id is kept; an empty table gives no rows; extra columns are ignored. Different
strings count as equal if two 64-bit fingerprints agree, that of their core and that of all their bytes; for two strings of one core that has probability 2 ** -64.

Departure from a suffix array proper: buckets carry fingerprints as identifiers instead of ranks from one sort of all suffixes. A row for each byte, 16 bytes or
more, would be shuffled in every round, at least 16 times the input a round; see the README.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import _BYTE, mix, pieces, shared_dir, utf8

LENGTH, GRAM, BITS = 200, 64, 27
_ODD = mix(np.arange(1, 17, dtype=np.uint64)) | np.uint64(1)


def buckets(data: np.ndarray) -> np.ndarray:
    """The bucket of the GRAM bytes from each position that has as many after it."""
    b, k, i = _BYTE[data], 1, 0
    while k < GRAM:
        b = b[:-k] * _ODD[i] + b[k:]
        k, i = 2 * k, i + 1
    return mix(b)


def sliding_min(a: np.ndarray, width: int) -> np.ndarray:
    k = 1
    while 2 * k <= width:
        a = np.minimum(a[:-k], a[k:])
        k *= 2
    return np.minimum(a[: len(a) - (width - k)], a[width - k :])


class Cells:
    """Cells of a batch of texts, at first its runs: text number, first and last start, place of the minimiser, core and content."""

    def __init__(self, texts: pa.Array):
        self.data, self.offsets = utf8(texts)
        size = np.diff(self.offsets)
        none = np.zeros(0, np.int64)
        self.text, self.first, self.last, self.place, self.core, self.content = none, none, none, none, none.view(np.uint64), none.view(np.uint64)
        if not (size >= LENGTH).any():
            return
        self.b = buckets(self.data)
        m = sliding_min(self.b, LENGTH - GRAM + 1)
        edge = np.zeros(len(m) + 1, np.int8)
        long = np.flatnonzero(size >= LENGTH)
        edge[self.offsets[long]] += 1
        edge[self.offsets[long] + size[long] - LENGTH + 1] -= 1
        inside = np.cumsum(edge[:-1], dtype=np.int8) > 0
        same = inside[1:] & inside[:-1] & (m[1:] == m[:-1]) & (self.b[: len(m) - 1] != m[:-1])  # past its minimiser a start meets another one
        self.first = np.flatnonzero(inside & ~np.append(False, same))
        self.last = np.flatnonzero(inside & ~np.append(same, False))
        self.core, self.text = m[self.first], np.searchsorted(self.offsets, self.first, "right") - 1

    def select(self, on: np.ndarray) -> None:
        for k in ("text", "first", "last", "place", "core", "content"):
            if len(getattr(self, k)):
                setattr(self, k, getattr(self, k)[on])

    def locate(self) -> None:
        """The place of each run's minimiser, and its content."""
        self.place = self.last.copy()
        left = np.flatnonzero(self.b[self.place] != self.core) if len(self.place) else np.zeros(0, np.int64)
        while len(left):
            self.place[left] += 1
            left = left[self.b[self.place[left]] != self.core[left]]
        self.content = self.whole(self.first, self.last - self.first + LENGTH)

    def whole(self, start: np.ndarray, total: np.ndarray) -> np.ndarray:
        """Buckets of total bytes from each start, refined GRAM bytes at a time."""
        out = mix(total.astype(np.uint64))
        live, k = np.arange(len(total)), 0
        while len(live):
            out[live] = mix(out[live] * _ODD[7] + self.b[start[live] + np.minimum(k * GRAM, total[live] - GRAM)])
            k += 1
            live = live[k * GRAM < total[live]]
        return out

    def split(self, size: int) -> None:
        """Cells of so many starts, aligned at the minimiser."""
        low, high = (self.place - self.last) // size, (self.place - self.first) // size
        n = high - low + 1
        j = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        place, first, last = (np.repeat(x, n) for x in (self.place, self.first, self.last))
        self.text, self.place = np.repeat(self.text, n), place
        end = place - size * j
        self.first, self.last = np.maximum(first, end - size + 1), np.minimum(last, end)
        self.core = self.whole(end, np.full(len(end), LENGTH - size + 1))
        self.content = self.whole(self.first, self.last - self.first + LENGTH)


def bitmap(rows: DataFrame, value, bits: int = BITS) -> np.ndarray:
    """Bytes of a bitmap in which the low bits of each value are set; its size is fixed."""
    place = value.bitwiseAND(F.lit((1 << bits) - 1))
    made = rows.select((place + 1).alias("p")).groupBy(F.bitmap_bucket_number("p").alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("m")).toArrow()
    out = np.zeros((1 << bits) // 8 if bits > 15 else 4096, np.uint8)
    for k, m in zip(made.column("k").to_pylist(), made.column("m").to_pylist()):
        out[(k - 1) * 4096 : k * 4096] = np.frombuffer(m, np.uint8)
    return out


def is_set(bitmap_: np.ndarray, value: np.ndarray, bits: int = BITS) -> np.ndarray:
    place = (value & np.uint64((1 << bits) - 1)).astype(np.int64)
    return (bitmap_[place >> 3] >> (place & 7).astype(np.uint8)) & 1 > 0


def signed(a: np.ndarray) -> pa.Array:
    return pa.array(a.view(np.int64))


SIZES = (16, 4, 1)


def looked_at(cells: Cells, key: np.ndarray, marks: list[np.ndarray], found=None) -> None:
    """Bring cells to the round after the given bitmaps: runs of a shared minimiser, then split what each further bitmap marks.

    found(round, cells) is called with the cells of every round before they are split.
    """
    cells.select(is_set(marks[0], cells.core))
    cells.locate()
    for k, mark in enumerate(marks[1:]):
        if found:
            found(k, cells)
        cells.select(is_set(mark, cells.content ^ key[cells.text]))
        cells.split(SIZES[k])
    if found:
        found(len(marks) - 1, cells)


def lone_cells(docs: DataFrame) -> tuple[DataFrame, list]:
    """(key, round, content) of the cells without an equal, key being the hash of a text; and the broadcast bitmaps of the rounds."""
    spark = docs.sparkSession
    sc, folder = spark.sparkContext, f"{shared_dir(spark)}/strings-{uuid.uuid4().hex}"
    texts = docs.where(F.octet_length("text") >= LENGTH).select(F.xxhash64("text").alias("key"), "text")

    def count(batches):
        for whole in batches:
            for b in pieces(whole):
                g, n = np.unique(Cells(b.column("text")).core, return_counts=True)
                yield pa.RecordBatch.from_arrays([signed(g), pa.array(n)], names=["g", "n"])

    twice = texts.select("text").mapInArrow(count, "g long, n long").groupBy("g").agg(F.sum("n").alias("n")).where("n > 1")
    marks, lone = [sc.broadcast(bitmap(twice, F.col("g")))], None
    for k in range(len(SIZES) + 1):
        given = list(marks)

        def contents(batches, given=given):
            for whole in batches:
                for b in pieces(whole):
                    cells = Cells(b.column("text"))
                    looked_at(cells, b.column("key").to_numpy().view(np.uint64), [m.value for m in given])
                    yield pa.RecordBatch.from_arrays([signed(cells.core), signed(cells.content), b.column("key").take(pa.array(cells.text))], names=["core", "content", "key"])

        kinds = texts.mapInArrow(contents, "core long, content long, key long").groupBy("core", "content").agg(F.count("*").alias("n"), F.min("key").alias("key"))
        kinds.select("core", "content", "key", (F.col("n") == 1).alias("lone")).write.parquet(f"{folder}/{k}")
        kinds = spark.read.parquet(f"{folder}/{k}")
        alone = kinds.where("lone").select("key", F.lit(k).alias("round"), "content")
        lone = alone if lone is None else lone.union(alone)
        if k < len(SIZES):
            mixed = kinds.groupBy("core").agg(F.count("*").alias("kinds"), F.bool_or("lone").alias("lone")).where("kinds > 1 and lone").select("core")
            marks.append(sc.broadcast(bitmap(kinds.join(mixed, "core", "left_semi"), F.col("content").bitwiseXOR(F.col("key")))))
    return lone, marks


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and kept (the remaining bytes; cuts may fall inside a character) of every document."""
    lone, marks = lone_cells(docs)
    lists = lone.groupBy(F.col("key").alias("lone_key")).agg(*[F.collect_list(F.when(F.col("round") == k, F.col("content"))).alias(f"lone{k}") for k in range(len(SIZES) + 1)])
    keyed = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("key"))
    joined = keyed.join(lists.hint("merge"), F.col("key") == F.col("lone_key"), "left").drop("lone_key")

    def cut(batches):
        for whole in batches:
            for b in pieces(whole):
                cells = Cells(b.column("text"))
                edge = np.zeros(len(cells.data) + 1, np.int64)

                def repeated(k, c, edge=edge, b=b):
                    lists = b.column(f"lone{k}")
                    owner = np.repeat(np.arange(b.num_rows), lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
                    tie = lambda text, content: content ^ mix(text.astype(np.uint64))
                    on = ~np.isin(tie(c.text, c.content), tie(owner, lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)))
                    np.add.at(edge, c.first[on], 1)
                    np.add.at(edge, c.last[on] + LENGTH, -1)
                    c.select(~on)

                looked_at(cells, b.column("key").to_numpy().view(np.uint64), [m.value for m in marks], repeated)
                off = np.cumsum(edge[:-1]) > 0
                begins = off.copy()
                begins[1:] &= ~off[:-1]
                first = cells.offsets[:-1][cells.offsets[:-1] < len(off)]
                begins[first] = off[first]
                gone, runs = (np.concatenate(([0], np.cumsum(x)))[cells.offsets] for x in (off, begins))
                kept, at = cells.data[~off].tobytes(), (cells.offsets - gone).tolist()
                text = [kept[x:y] for x, y in zip(at, at[1:])]
                sha = [hashlib.sha256(x).hexdigest() for x in text]
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), *[pa.array(np.diff(x).astype(np.int64)) for x in (cells.offsets, gone, runs)], pa.array(sha, pa.string()), pa.array(text, pa.binary())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    kind = docs.select("doc_id").dtypes[0][1]
    return joined.mapInArrow(cut, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
