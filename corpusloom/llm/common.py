"""What several operators share: session helpers, Column helpers, and vectorised word hashing for Arrow batches."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the word contracts: space and the ASCII controls tab to carriage return.
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The shared folder that the session names in spark.checkpoint.dir; where none is set, a temporary one in local mode (tests), else an error."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = sc.getConf().get("spark.checkpoint.dir")
        if not folder and not sc.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="corpusloom-"))
    return sc.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """df as a table written in the shared folder: what follows starts from its files, whichever executors are lost."""
    path = f"{shared_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def let(value: Column, body) -> Column:
    """Evaluate value once and use it many times in body, also inside lambdas."""
    return F.transform(F.array(value), body)[0]


def fresh(columns: list[str], name: str) -> str:
    """A column name that no column has."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def words_of(text: Column) -> Column:
    """White-space separated words of a text; null gives no words."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def digest(*cols: Column) -> Column:
    """A 128-bit key of a row's values as text, nulls told apart from empty strings; equal rows get equal keys."""
    parts = [F.coalesce(F.concat(F.lit("+"), c.cast("string")), F.lit("-")) for c in cols]
    return F.unhex(F.md5(F.concat_ws("\x1f", *parts)))


def remainder(doc_id: Column, n: int) -> Column:
    """crc32 of the id's text, modulo n; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def sample_labels(labels: DataFrame, label: str, limit: int) -> DataFrame:
    """At most limit labelled ids in the order of a hash, each id once (largest label); safe to broadcast."""
    one = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    return one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)


# -- Arrow batches as bytes -------------------------------------------------------------------------------------

_rng = np.random.default_rng(20240611)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FOLDED = _BYTE.copy()
_FOLDED[65:91] = _BYTE[97:123]
_ODD = np.uint64(0x9E3779B97F4A7C15)
_SPACES = np.zeros(256, bool)
_SPACES[[9, 10, 11, 12, 13, 32]] = True
def mix(h: np.ndarray) -> np.ndarray:
    """A finaliser that spreads every input bit over all output bits."""
    h = h.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def utf8(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts and the offset of each text, with the end last; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    if not len(offsets):
        offsets = np.zeros(1, np.int64)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(batch: pa.RecordBatch, column: str = "text", most: int = 1 << 21, rows: int = 1 << 20):
    """The batch in slices of at most so many bytes of text (or of one row) and so many rows, so that arrays over bytes stay small."""
    lengths = pa.compute.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
    block = np.cumsum(lengths, dtype=np.int64) // most
    new = (np.diff(block) > 0) | (np.arange(1, len(lengths)) % rows == 0) if len(lengths) else np.zeros(0, bool)
    cuts = [0, *(np.flatnonzero(new) + 1).tolist(), len(lengths)]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def word_spans(data: np.ndarray, offsets: np.ndarray, between: np.ndarray = _SPACES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words (words never cross texts), and per text the index of its first word, end last. between: which bytes part words."""
    return runs(~between[data], offsets)


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of marked bytes (runs never cross texts), and per text the index of its first run, end last."""
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    first = offsets[:-1][offsets[:-1] < len(inside)]
    starts[first] = inside[first]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    last = offsets[1:][offsets[1:] > 0] - 1
    ends[last] = inside[last]
    starts = np.flatnonzero(starts)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, offsets)


_PLACE = mix(np.arange(1, 4097, dtype=np.uint64))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: bool = False) -> np.ndarray:
    """A 64-bit hash of each byte span; fold: A-Z count as a-z. Spans are in order and don't overlap.

    Every (byte, position) is mixed before the sum, so no regular pattern of bytes cancels out.
    """
    if not len(starts):
        return np.zeros(0, np.uint64)
    size = ends - starts
    at = np.cumsum(size) - size
    pos = np.arange(int(size.sum())) - np.repeat(at, size)
    terms = (_FOLDED if fold else _BYTE)[data[np.repeat(starts, size) + pos]] + _PLACE[pos & 4095]
    if len(_PLACE) < size.max():
        terms += (pos >> 12).astype(np.uint64) * _ODD
    terms = mix(terms)
    return mix(np.add.reduceat(terms, at) + size.astype(np.uint64))


def distinct_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans that differ from all before them, and for each span its place among these. Equal hashes only propose: the bytes decide."""
    _, one, which = np.unique(hashes, return_index=True, return_inverse=True)
    size = ends - starts
    odd = size != size[one[which]]
    n = np.where(odd, 0, size)
    pos = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    unlike = data[np.repeat(starts, n) + pos] != data[np.repeat(starts[one[which]], n) + pos]
    odd[np.repeat(np.arange(len(n)), n)[unlike]] = True
    if odd.any():  # spans that only share a hash are told apart by their bytes
        seen: dict[bytes, int] = {}
        for i in np.flatnonzero(odd).tolist():
            k = seen.setdefault(data[starts[i] : ends[i]].tobytes(), len(one))
            if k == len(one):
                one = np.append(one, i)
            which[i] = k
    return one, which


def hashed_words(texts: pa.Array, fold: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word, and per text the index of its first word, end last."""
    data, offsets = utf8(texts)
    starts, ends, first = word_spans(data, offsets)
    return span_hashes(data, starts, ends, fold), first
