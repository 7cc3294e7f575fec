"""Operator 8. Near-duplicates by DartMinHash signatures, banding, exact verification and connected components.

A text is the weighted set of its five-word shingles (A-Z lower-cased; a text of fewer words is one shingle), weights are
counts, and similarity is the weighted Jaccard. Each unit of weight is a region at which a Poisson process throws darts,
determined by hashes: a dart has a rank, a coordinate and an id, and the earliest dart of each coordinate is the signature. Darts are
generated in order of rank up to a limit of about (ln T + 3) / total weight, so a text costs about T ln T darts whatever
its length; a text with an empty coordinate is thrown again with the limit doubled. Two texts agree in a coordinate with
probability equal to their similarity.

Bands of coordinates are hashed; texts that share a band are compared exactly. In bands of up to `small` different texts all pairs are
compared. In larger ones each text is compared with the band's hub. Where that leaves a band in more than one component, its texts meet once
more by their rarest shingles (prefix filter: two texts at the threshold share one of them, so early that what follows can hold their overlap), and all that
meet and are not connected yet are compared, first with a few hubs, then all with all. A pair at 0.8 meets in some band with probability 0.99995, and is then compared or
connected through others. Equal texts share one key and are never paired.

Defined results: null counts as the empty text; texts without words are near only to equal texts; the class id is the smallest
doc_id of the class (null if all are null); repeated rows share a class; an empty table gives no rows; extra columns are ignored,
and kept by keep_one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, digest, fresh, hashed_words, mix, pieces

SHINGLE, THRESHOLD = 5, 0.8
T, BANDS, ROWS = 128, 25, 5
SMALL, SALTS, FEW, CELLS = 8, 256, 8, 1 << 16
_PLACES = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def shingles(texts: pa.Array, width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles in order, and per text the index of its first, end last."""
    words, first = hashed_words(texts, fold=True)
    n = np.diff(first)
    count = np.where(n >= width, n - width + 1, np.minimum(n, 1))
    out = np.concatenate(([0], np.cumsum(count)))
    at = np.repeat(first[:-1] - out[:-1], count) + np.arange(out[-1])
    h = np.zeros(len(at), np.uint64)
    padded = np.concatenate((words, np.zeros(width, np.uint64)))
    end = np.repeat(first[1:], count)
    for k in range(width):
        h += np.where(at + k < end, padded[at + k], np.uint64(0)) * _PLACES[k % 5] * np.uint64(2 * (k // 5) + 1)
    return mix(h), out


def signatures(doc: np.ndarray, element: np.ndarray, weight: np.ndarray, n_docs: int, t: int = T) -> np.ndarray:
    """DartMinHash: per document (numbered from 0) the dart id of each of t coordinates (t a power of two); 0 where a document has no weight.

    doc, element and weight are aligned; weights are positive reals and an element occurs once in a document.
    """
    cells = np.ceil(weight).astype(np.int64)
    cell = np.arange(int(cells.sum())) - np.repeat(np.cumsum(cells) - cells, cells)
    seed = mix(mix(np.repeat(element, cells)) + cell.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    room = np.minimum(np.repeat(weight, cells) - cell, 1.0)  # how much of the unit cell the element fills
    owner = np.repeat(doc, cells)
    total = np.bincount(doc, weight, n_docs)
    limit = (np.log(t) + 3) / np.maximum(total, 1e-300)
    sig, todo = np.zeros(n_docs * t, np.uint64), total > 0
    while todo.any():
        best = np.full(n_docs * t, np.inf)
        live = np.flatnonzero(todo[owner])
        s, o, r, w = seed[live], owner[live], np.zeros(len(live)), room[live]
        most, j, thrown = limit[o], 0, []
        while len(s):
            j += 1
            u = mix(s + np.uint64(j * 0xD1B54A32D192ED03 % 2**64))
            r = r - np.log1p(-((u >> np.uint64(11)) * 2.0**-53)) / t
            ok = r < most
            s, o, r, w, most, u = s[ok], o[ok], r[ok], w[ok], most[ok], u[ok]
            inside = (mix(u ^ np.uint64(0x5851F42D4C957F2D)) >> np.uint64(11)) * 2.0**-53 < w if (w < 1).any() else slice(None)
            key = o[inside] * t + (u[inside] & np.uint64(t - 1)).astype(np.int64)
            np.minimum.at(best, key, r[inside])
            thrown.append((key, r[inside], u[inside]))
        key, rank, u = (np.concatenate([x[i] for x in thrown]) for i in range(3))
        won = rank == best[key]
        sig[key[won]] = u[won]
        todo &= np.isinf(best.reshape(n_docs, t)).any(axis=1)
        limit = limit * 2
    return sig.reshape(n_docs, t)


def weighted(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, element and count of the distinct shingles."""
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    order = np.lexsort((hashes, doc))
    d, h = doc[order], hashes[order]
    new = np.ones(len(d), bool)
    new[1:] = (d[1:] != d[:-1]) | (h[1:] != h[:-1])
    at = np.flatnonzero(new)
    return d[at], h[at], np.diff(np.append(at, len(d))).astype(float)


def _bands(batches):
    for whole in batches:
        for b in pieces(whole, most=1 << 20, rows=512):  # a text costs about T ln T darts, however short it is
            doc, element, weight = weighted(*shingles(b.column("text")))
            sig = signatures(doc, element, weight, b.num_rows)
            full = np.flatnonzero(np.bincount(doc, minlength=b.num_rows))
            sig = sig[full]
            bands = [mix(np.add.reduce(sig[:, k * ROWS : (k + 1) * ROWS] * _PLACES[None, :ROWS], axis=1) + np.uint64(k)) for k in range(BANDS)]
            keys = b.column("key").take(pa.array(np.tile(full, BANDS)))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(bands).view(np.int64)), keys], names=["band", "key"])


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Weighted Jaccard of two lists of shingle hashes."""
    (ha, na), (hb, nb) = np.unique(a, return_counts=True), np.unique(b, return_counts=True)
    _, i, j = np.intersect1d(ha, hb, assume_unique=True, return_indices=True)
    both = int(np.minimum(na[i], nb[j]).sum())
    return both / max(1, len(a) + len(b) - both)


def _verified(threshold: float):
    def run(batches):
        for whole in batches:
            for b in pieces(whole, "ta", 1 << 20):
                (ha, fa), (hb, fb) = shingles(b.column("ta")), shingles(b.column("tb"))
                ok = [similarity(ha[fa[i] : fa[i + 1]], hb[fb[i] : fb[i + 1]]) >= threshold for i in range(b.num_rows)]
                yield b.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return run


def components(links: DataFrame) -> DataFrame:
    """(key, component): the least key that links (a, b) connect each key to. Rounds of minimum and pointer jumping, each written as tables."""
    both = cut_lineage(links.select("a", "b").union(links.select("b", "a")))
    now = cut_lineage(both.groupBy(F.col("a").alias("key")).agg(F.least(F.min("b"), F.col("a")).alias("component")).select("key", "component"))
    while True:
        near = both.join(now.select(F.col("key").alias("b"), F.col("component").alias("c")), "b").groupBy(F.col("a").alias("key")).agg(F.min("c").alias("c"))
        low = cut_lineage(now.join(near, "key").select("key", F.col("component").alias("was"), F.least("component", "c").alias("component")))
        if low.where("was <> component").isEmpty():  # all neighbours agree
            return now
        jump = low.select(F.col("key").alias("component"), F.col("component").alias("further"))
        now = cut_lineage(low.join(jump, "component").select("key", F.least("component", "further").alias("component")))


def keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", text.alias("text"), digest(text).alias("key"))


def texts_of(need: DataFrame, docs: DataFrame, one: DataFrame) -> DataFrame:
    """(key, text) of the keys in need, one copy of each."""
    need = need.join(one, "key").select(F.col("key").alias("need"), F.col("one").alias("need_id"))
    return keyed(docs).join(need, (F.col("key") == F.col("need")) & F.col("doc_id").eqNullSafe(F.col("need_id"))).groupBy("key").agg(F.first("text").alias("text"))


def verify(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """Those (a, b) whose texts are similar enough."""
    salted = pairs.select("a", "b", F.pmod(F.xxhash64("b"), F.lit(SALTS)).alias("salt"))  # a hub's many partners are dealt over as many tasks
    hubs = salted.select("a", "salt").distinct().join(texts.select(F.col("key").alias("a"), F.col("text").alias("ta")), "a")
    joined = salted.join(texts.select(F.col("key").alias("b"), F.col("text").alias("tb")), "b").join(hubs, ["a", "salt"])
    return joined.select("a", "b", "ta", "tb").mapInArrow(_verified(threshold), "a binary, b binary")


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Document and hash of each shingle with its number among the equal ones of its text: the multiset as a set."""
    doc, element, weight = weighted(*shingles(texts))
    n = weight.astype(np.int64)
    nth = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    return np.repeat(doc, n), mix(np.repeat(element, n) + nth.astype(np.uint64) * _PLACES[0])


def rare_tokens(texts: DataFrame, threshold: float) -> DataFrame:
    """(token, key, size, pos): the first tokens of each text, rarest first, so many that two texts at the threshold share one; pos: how many come before.

    The order is that of the counts of CELLS cells of token hashes, then of the hash: one order for all texts, so nothing is lost where tokens share a cell.
    """

    def count(batches):
        total = np.zeros(CELLS, np.int64)
        for whole in batches:
            for b in pieces(whole):
                total += np.bincount((tokens(b.column("text"))[1] % np.uint64(CELLS)).astype(np.int64), minlength=CELLS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["cell", "n"])

    got = texts.select("text").mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(CELLS, np.int64)
    counts[got.column("cell").to_numpy()] = got.column("n").to_numpy()
    given = texts.sparkSession.sparkContext.broadcast(counts)

    def run(batches):
        for whole in batches:
            for b in pieces(whole, most=1 << 20):
                doc, token = tokens(b.column("text"))
                order = np.lexsort((token, given.value[(token % np.uint64(CELLS)).astype(np.int64)], doc))
                doc, token = doc[order], token[order]
                size = np.bincount(doc, minlength=b.num_rows)
                most = size - np.ceil(threshold * size - 1e-9).astype(np.int64) + 1
                pos = np.arange(len(doc)) - (np.cumsum(size) - size)[doc]
                first = pos < most[doc]
                yield pa.RecordBatch.from_arrays([pa.array(token[first].view(np.int64)), b.column("key").take(pa.array(doc[first])), pa.array(size[doc[first]]), pa.array(pos[first])], names=["token", "key", "size", "pos"])

    return texts.select("key", "text").mapInArrow(run, "token long, key binary, size long, pos long")


def split_groups(rows: DataFrame, found: DataFrame, group: str) -> DataFrame:
    """The rows (group, key, ...) of groups that are in more than one component, with each key's component."""
    now = cut_lineage(rows.join(found, "key", "left").withColumn("component", F.coalesce("component", "key")))
    split = now.groupBy(group).agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select(group)
    return cut_lineage(now.join(cut_lineage(split), group))


def all_links(links: DataFrame, found: DataFrame, many: DataFrame, done: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """Components after every two texts of a band in many (band, key, n) have been compared, or been found connected; done: pairs compared before.

    Texts of bands that are not in one component meet where they share a rare token. The first round compares few hubs of a token with all its texts that
    are in other components: the text that shares bands with most others, and about FEW drawn ones. The second compares all that are still in different ones.
    """
    loose = cut_lineage(split_groups(many, found, "band").groupBy("key").agg(F.sum("n").alias("reach")))
    if loose.isEmpty():
        return found
    rows = cut_lineage(rare_tokens(texts.join(loose.select("key"), "key"), threshold))
    groups = rows.join(loose, "key").groupBy("token").agg(F.count("*").alias("m"), F.max_by("key", F.struct("reach", "key")).alias("top"), F.bit_xor(F.xxhash64("key")).alias("texts"), F.min("pos").alias("low")).where("m > 1")
    # tokens of just the same texts, as those of a passage are, say the same; the first of them comes first in every text
    groups = cut_lineage(groups.groupBy("m", "top", "texts").agg(F.min_by("token", "low").alias("token")).drop("texts"))
    rows = rows.join(groups, "token").select("token", "key", "size", "pos", "m", (F.col("key") == F.col("top")).alias("top"), (F.pmod(F.xxhash64("key"), F.lit(1 << 30)) / (1 << 30)).alias("u"))
    some = F.col("top") | (F.col("u") * F.col("m") < FEW)
    for chosen in (some, F.lit(True)):
        rows = split_groups(rows, found, "token")
        if rows.isEmpty():
            break
        hub = cut_lineage(rows.where(chosen).select("token", F.col("key").alias("hub"), F.col("size").alias("hub_size"), F.col("pos").alias("hub_pos"), F.col("component").alias("hub_component")))
        # Where two texts first share a token, what they have left from there on must hold their overlap; all that comes before is unshared.
        overlap = F.ceil(threshold / (1 + threshold) * (F.col("size") + F.col("hub_size")) - 1e-6)
        fits = (F.col("size") - F.col("pos") >= overlap) & (F.col("hub_size") - F.col("hub_pos") >= overlap)
        once = (~some if chosen is some else F.lit(False)) | (F.col("key") < F.col("hub"))  # two that are both chosen meet once
        pairs = rows.join(hub, "token").where((F.col("component") != F.col("hub_component")) & once & fits).select(F.least("key", "hub").alias("a"), F.greatest("key", "hub").alias("b")).distinct()
        pairs = cut_lineage(pairs.join(done, ["a", "b"], "left_anti"))
        done, rows = done.union(pairs), rows.drop("component")
        new = cut_lineage(verify(pairs, texts, threshold))
        if not new.isEmpty():
            links = links.union(new)
            found = components(links)
    return found


def near_components(docs: DataFrame, threshold: float = THRESHOLD, small: int = SMALL) -> tuple[DataFrame, DataFrame]:
    """(key, component) of the texts that have links, and (doc_id, key) of every document."""
    ids = cut_lineage(keyed(docs).select("doc_id", "key"))
    bands = cut_lineage(keyed(docs).select("key", "text").mapInArrow(_bands, "band long, key binary").distinct())
    met = cut_lineage(bands.groupBy("band").agg(F.count("*").alias("n"), F.min("key").alias("hub")).where("n > 1"))  # a table of its own, so that a hot band can be split in the join
    met = cut_lineage(bands.join(met, "band"))
    one = ids.groupBy("key").agg(F.min("doc_id").alias("one"))
    texts = cut_lineage(texts_of(met.select("key").distinct(), docs, one))  # only these can have links; every comparison reads this table
    few = met.where((F.col("n") > 2) & (F.col("n") <= small)).select("band", "key")
    every = few.select("band", F.col("key").alias("a")).join(few.select("band", F.col("key").alias("b")), "band").where("a < b").select("a", "b")
    pairs = cut_lineage(met.where("key <> hub").select(F.col("hub").alias("a"), F.col("key").alias("b")).union(every).distinct())
    links = cut_lineage(verify(pairs, texts, threshold))
    return all_links(links, components(links), met.where(F.col("n") > small).select("band", "key", "n"), pairs, texts, threshold), ids


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per document: doc_id, class_id (least doc_id of its class), class_size (rows in it)."""
    found, ids = near_components(docs, threshold)
    sizes = cut_lineage(ids.groupBy("key").agg(F.min("doc_id").alias("low"), F.count("*").alias("n")).join(found, "key", "left").select("key", "low", "n", F.coalesce("component", "key").alias("component")))
    classes = cut_lineage(sizes.groupBy("component").agg(F.min("low").alias("class_id"), F.sum("n").alias("class_size")))
    by_key = cut_lineage(sizes.join(classes, "component").select("key", "class_id", "class_size"))
    return ids.join(by_key, "key").select("doc_id", "class_id", "class_size")


def keep_one(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows and columns of docs, one document of each class: the one of least doc_id among the texts of the class."""
    found, ids = near_components(docs, threshold)
    one = ids.groupBy("key").agg(F.min("doc_id").alias("one"))
    classes = one.join(found, "key", "left").select("key", "one", F.coalesce("component", "key").alias("component"))
    key, kept_key, kept_id = (fresh(docs.columns, x) for x in ("key_", "kept_key_", "kept_id_"))
    kept = classes.groupBy("component").agg(F.min(F.struct(F.col("one").isNull(), "one", "key")).alias("kept")).select(F.col("kept.key").alias(kept_key), F.col("kept.one").alias(kept_id))
    rows = docs.withColumn(key, digest(F.coalesce(F.col("text"), F.lit("")))).join(cut_lineage(kept), (F.col(key) == F.col(kept_key)) & F.col("doc_id").eqNullSafe(F.col(kept_id)))
    return rows.dropDuplicates([key, "doc_id"]).select(*[F.col(f"`{c}`") for c in docs.columns])
