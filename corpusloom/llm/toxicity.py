"""Operator 6. Toxicity: noisy-channel deobfuscation, then a classifier over the restored text.

Channel. A token that looks disguised (digits or signs among letters, letters three times or more in a row, letters spaced
out one by one) becomes a lattice of characters: a sign between spaced letters is dropped or a word boundary (the reading as one word is kept beside that), each sign may stand for itself or for the letters it imitates, a run of a letter for
one or two of it, a star for any letter. Viterbi finds the path of highest probability under a character trigram model, which is
counted over the training documents. Other tokens have one path and stay as they are.

Score. A lexicon holds words and five-byte word beginnings that occur in at least `least` toxic training documents, far more often than
in the others (as many as there are in those documents; no entry is left out). A logistic regression on a few sums over a text's lexicon hits gives the score. Lexicon and regression are fitted on at
most `limit` labelled documents, in the order of a hash of the id; when a training document is scored for the
fit, its own counts are taken out of the lexicon.

Defined results: null and empty texts have no hits and get the score of that, as any text without hits; without labels of both
kinds every score is 0; labels with null ids or labels are ignored, the largest label of a repeated id wins; repeated rows have
equal scores; a null doc_id counts as the empty text in the fold rule; an empty table gives no rows; extra columns are ignored, and kept by drop_toxic.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import groupby, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, fresh, mix, pieces, remainder, runs, sample_labels, span_hashes, utf8, word_spans

LIMIT, LEAST = 40_000, 3
ODDS = 2.0
CUT = 0.7
#: Fixed value: signs and the letters they imitate.
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e"}
LETTERS = "abcdefghijklmnopqrstuvwxyz"
SWAP, SHRINK, ANY, PART, FLUSH = -1.0, -0.5, -3.5, -1.0, 1024

SIGNS, HARD, LAST, SINGLE, GAPS = b"0123456789@$!|+(*", b"0123456789@$|(", b"0123456789@$", b"@$", b" ._-"

_PARTS = np.ones(256, bool)
_PARTS[48:58] = _PARTS[65:91] = _PARTS[97:123] = _PARTS[128:] = False
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True


def _table(*signs: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[np.frombuffer(b"".join(signs), np.uint8)] = True
    return out


_SIGN, _HARD, _LAST, _GAP = _table(SIGNS), _table(HARD), _table(LAST), _table(GAPS)
_ALNUM = _LETTER | _table(b"0123456789")
_ONE = _ALNUM | _table(SINGLE)

# classes of the character model: 0 word boundary, 1-26 letters, 27 any other character
_CLASS = np.full(256, 27, np.int64)
_CLASS[[9, 10, 11, 12, 13, 32]] = 0
_CLASS[65:91] = _CLASS[97:123] = np.arange(1, 27)


def trigram_counts(texts: pa.Array) -> np.ndarray:
    """Counts of class trigrams; texts start and end with two boundaries, runs of boundaries count as one."""
    data, offsets = utf8(texts)
    c = np.insert(_CLASS[data], np.repeat(offsets, 2), 0)
    return np.bincount((c[:-2] * 28 + c[1:-1]) * 28 + c[2:], minlength=28**3)


def log_probabilities(counts: np.ndarray) -> np.ndarray:
    """log p(c | a, b), smoothed by the bigram p(c | b), that by the unigram."""
    n3 = counts.reshape(28, 28, 28).astype(float)
    n2 = n3.sum(axis=0)
    p1 = (n2.sum(axis=0) + 1) / (n2.sum() + 28)
    p2 = (n2 + 20 * p1) / (n2.sum(axis=1, keepdims=True) + 20)
    return np.log((n3 + 20 * p2[None]) / (n3.sum(axis=2, keepdims=True) + 20))


def is_spaced(token: str) -> bool:
    return len(token) > 2 and len(token) % 2 == 1 and all(c in " ._-" for c in token[1::2])


#: The options of every kind of slot met so far, as (string, log channel weight); a slot's number is its place here.
OPTIONS: list[list[tuple[str, float]]] = []


@lru_cache(maxsize=None)
def slot(c: str, run: bool = False) -> int:
    """Number of the slot of a character, or of a run of a letter; the empty character is a sign between spaced letters."""
    if not c:
        options = [("", 0.0), (" ", PART)]
    elif run:
        options = [(c, SHRINK), (c * 2, 2 * SHRINK)]
    else:
        options = [(x, ANY) for x in LETTERS] + [("*", 0.0)] if c == "*" else [(c, 0.0)] + [(x, SWAP) for x in LEET.get(c, "")]
    OPTIONS.append(options)
    return len(OPTIONS) - 1


def slots(token: str, parts: bool = False):
    """Numbers of a token's slots; a slot is one character of the token, or a run of one. parts: spaced letters may be several words."""
    if is_spaced(token):
        token = token[::2]
        if parts:
            for i, c in enumerate(token.lower()):
                if i:
                    yield slot("")
                yield slot(c)
            return
    token = token.lower()
    for c, same in groupby(token):
        n = sum(1 for _ in same)
        if n >= 3 and c in LETTERS:
            yield slot(c, True)
        else:
            yield from repeat(slot(c), n)


def lattice(token: str, parts: bool = False) -> list[list[tuple[str, float]]]:
    return [OPTIONS[k] for k in slots(token, parts)]


def code(c: str) -> int:
    return ord(c) - 96 if c in LETTERS else 0 if c == " " else 27


class Channel:
    """Viterbi steps under a character model, each worked out once.

    A matrix holds the scores of all states that paths are in (rows and columns are the last two classes), less its maximum and rounded to nine decimals; equal
    matrices have one number. A step's result depends on that number and the slot alone, so it is looked up where it was met before: long runs of signs soon come
    back to matrices they have had. What is remembered is cleared when it holds more than MOST cells or steps.
    """

    MOST = 1 << 19

    def __init__(self, logp: np.ndarray):
        self.logp = np.ascontiguousarray(logp, float)
        self.clear()

    def clear(self) -> None:
        self.matrices, self.numbers, self.next, self.before, self.cells, self.singles = [], {}, {}, {}, 0, {}

    def number(self, matrix: tuple) -> int:
        rows, columns, values = matrix
        key = rows, columns, values.tobytes()
        if key not in self.numbers:
            self.numbers[key] = len(self.matrices)
            self.matrices.append(matrix)
            self.cells += values.size
        return self.numbers[key]

    def dense(self, i: int) -> np.ndarray:
        rows, columns, values = self.matrices[i]
        out = np.full((28, 28), -np.inf)
        out[np.ix_(rows, columns)] = values
        return out

    def step(self, i: int, k: int) -> int:
        logp = self.logp
        rows, columns, values = self.matrices[i]
        single = [(code(string), weight) for string, weight in OPTIONS[k] if len(string) == 1]
        if single:
            codes, weights = zip(*single)
            at = rows, columns, k
            if at not in self.singles:
                self.singles[at] = logp[np.ix_(rows, columns, codes)] + np.array(weights)
            out = (values[:, :, None] + self.singles[at]).max(axis=0)
            if len(single) == len(OPTIONS[k]):
                return self.number((columns, codes, np.round(out - out.max(), 9) + 0.0))
        whole, m = np.full((28, 28), -np.inf), self.dense(i)
        if single:
            whole[np.ix_(columns, codes)] = out
        for string, weight in OPTIONS[k]:
            if not string:
                whole = np.maximum(whole, m + weight)
            elif len(string) == 2:
                c = code(string[0])
                whole[c, c] = max(whole[c, c], (m + logp[:, :, c] + logp[None, :, c, c]).max() + weight)
        on = whole > -np.inf
        rows, columns = np.flatnonzero(on.any(axis=1)), np.flatnonzero(on.any(axis=0))
        return self.number((tuple(rows.tolist()), tuple(columns.tolist()), np.round(whole[np.ix_(rows, columns)] - whole.max(), 9) + 0.0))

    def run(self, start: tuple, ks: list[int]) -> list[int]:
        """Numbers of the matrices before the first slot and after each."""
        if max(self.cells, len(self.next), len(self.before)) > self.MOST:
            self.clear()
        i = self.number(start)
        out = [i]
        for k in ks:
            j = self.next.get((i, k))
            if j is None:
                j = self.next[i, k] = self.step(i, k)
            out.append(j)
            i = j
        return out

    def back(self, i: int, k: int, x: int, y: int) -> tuple[int, int, str]:
        """The best state before a slot that led to the classes x, y, and the slot's string; the first of equals."""
        (rows, columns, values), logp, best, found = self.matrices[i], self.logp, -np.inf, None
        for string, weight in OPTIONS[k]:
            if not string:
                score, state = (values[rows.index(x), columns.index(y)] + weight if x in rows and y in columns else -np.inf), (x, y)
            elif code(string[-1]) != y or (len(string) == 2 and x != y):
                continue
            elif len(string) == 1:
                if x not in columns:
                    continue
                scores = [v + logp[a, x, y] for a, v in zip(rows, values[:, columns.index(x)])]
                score = max(scores)
                score, state = score + weight, (rows[scores.index(score)], x)
            else:
                scores = self.dense(i) + logp[:, :, y] + logp[None, :, y, y]
                a, b = divmod(int(scores.argmax()), 28)
                score, state = scores[a, b] + weight, (a, b)
            if score > best:
                best, found = score, (*state, string)
        return found


def decode(token: str, logp: np.ndarray | Channel, parts: bool = False) -> str:
    """The most probable reading of a disguised token: Viterbi over its lattice.

    Matrices are kept for FLUSH slots at a time; those of earlier blocks are worked out again from the block's first one on the way back, so a long token takes little memory.
    """
    channel = logp if isinstance(logp, Channel) else Channel(logp)
    ks = list(slots(token, parts))
    matrix, starts, path = ((0,), (0,), np.zeros((1, 1))), [], []
    for at in range(0, max(len(ks), 1), FLUSH):
        starts.append(matrix)
        path = channel.run(matrix, ks[at : at + FLUSH])
        matrix = channel.matrices[path[-1]]
    x, y = divmod(int((channel.dense(path[-1]) + channel.logp[:, :, 0]).argmax()), 28)
    out = []
    for block in reversed(range(len(starts))):
        part = ks[block * FLUSH : (block + 1) * FLUSH]
        if block < len(starts) - 1:
            path = channel.run(starts[block], part)
        for i, k in zip(reversed(path[:-1]), reversed(part)):
            key = i, k, x, y
            if key not in channel.before:
                channel.before[key] = channel.back(*key)
            x, y, string = channel.before[key]
            out.append(string)
    return "".join(reversed(out))


def spaced(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of three or more single characters with one gap (space, dot, line or hyphen) between each two, that no letter or digit touches."""
    n = len(data)
    one = _ONE[data]
    link = np.zeros(n, bool)
    link[: n - 2] = one[:-2] & _GAP[data[1:-1]] & one[2:]
    last = offsets[1:][offsets[1:] > 0]  # no link leaves a text
    for k in (1, 2):
        link[last[last >= k] - k] = False
    p = np.flatnonzero(link)
    before, after = np.append(False, _ALNUM[data[:-1]]), np.append(_ALNUM[data[1:]], False)
    before[offsets[:-1][offsets[:-1] < n]] = False
    after[last - 1] = False
    on = p >= 2
    goes_on = np.zeros(len(p), bool)
    goes_on[on] = link[p[on] - 2]
    first = p[~goes_on]
    ends = p + 2
    end = ends[~link[ends]]  # chains of different parity never meet, so both lists are in the same order
    first = first + 2 * before[first]
    end = end - 2 * after[end]
    ok = end - first >= 4
    return first[ok], end[ok] + 1


def disguised(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the places that look disguised, in order and without overlaps; a few passes over the bytes, whatever they are.

    A place is a chain of spaced letters, or a run of letters and signs with a sign between letters, signs before the first letter, two letters or more and then
    signs at its end, or one letter three times in a row.
    """
    none = np.zeros(0, np.int64)
    if len(data) < 2:
        return none, none
    letter, sign, hard = _LETTER[data], _SIGN[data], _HARD[data]
    euro = np.flatnonzero((data[:-2] == 0xE2) & (data[1:-1] == 0x82) & (data[2:] == 0xAC)) if len(data) > 2 else none
    for k in range(3):
        sign[euro + k] = hard[euro + k] = True
    starts, ends, _ = runs(letter | sign, offsets)
    odd = np.zeros(len(starts), bool)
    run_of = lambda at: np.searchsorted(starts, at, "right") - 1
    at = np.flatnonzero(sign)
    if len(at):
        r, before = run_of(at), np.concatenate(([0], np.cumsum(letter)))
        odd[r[(before[at] > before[starts[r]]) & (before[ends[r]] > before[at])]] = True  # a sign between letters
        own = np.unique(r)
        soft = np.append(np.flatnonzero(~hard), len(data))
        head = soft[np.searchsorted(soft, starts[own])]  # the first place from the start that isn't a hard sign
        ok = (head > starts[own]) & (head < ends[own])
        odd[own[ok & letter[np.minimum(head, len(data) - 1)]]] = True
        firm = np.append(-1, np.flatnonzero(~_LAST[data]))
        tail = firm[np.searchsorted(firm, ends[own]) - 1]  # the last place of the run that isn't a closing sign
        ok = (tail > starts[own]) & (tail < ends[own] - 1)
        odd[own[ok & letter[tail] & letter[tail - 1]]] = True
    three = np.flatnonzero(letter[:-2] & (data[:-2] == data[1:-1]) & (data[:-2] == data[2:]))
    r = run_of(three)
    odd[r[three + 2 < ends[r]]] = True
    a, b = spaced(data, offsets)
    a, b = np.concatenate((a, starts[odd])), np.concatenate((b, ends[odd]))
    order = np.lexsort((-b, a))
    a, b = a[order], b[order]
    reach = np.maximum.accumulate(np.append(0, b[:-1])) if len(b) else none
    a = np.maximum(a, reach)  # what a chain has taken is not read again
    return a[b > a], b[b > a]


def restorer(logp: np.ndarray):
    """A function from texts to texts in which disguised places are restored; null becomes the empty text."""
    channel = Channel(logp)

    def read(token: bytes) -> bytes:
        """As one word; spaced letters also as several, where that is more probable."""
        token = token.decode()
        one = decode(token, channel)
        more = decode(token, channel, True) if is_spaced(token) else one
        return (one if more == one else f"{one} {more}").encode()

    remembered = lru_cache(maxsize=50_000)(read)

    def restore(texts: pa.Array) -> pa.Array:
        data, offsets = utf8(texts)
        starts, ends = disguised(data, offsets)
        whole, parts, at, grown = data.tobytes(), [], 0, np.zeros(len(data) + 1 if len(starts) else 0, np.int64)
        for x, y in zip(starts.tolist(), ends.tolist()):
            new = (remembered if y - x <= 64 else read)(whole[x:y])
            parts += (whole[at:x], new)
            grown[y] += len(new) - (y - x)
            at = y
        parts.append(whole[at:])
        if len(starts):
            offsets = offsets + np.cumsum(grown)[offsets]
        return pa.Array.from_buffers(pa.large_string(), len(offsets) - 1, [None, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(b"".join(parts))])

    return restore


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Document, feature hash and count of the distinct words and word beginnings; and the number of words of each text."""
    data, offsets = utf8(texts)
    starts, ends, first = word_spans(data, offsets, _PARTS)
    doc = np.repeat(np.arange(len(texts)), np.diff(first))
    words = span_hashes(data, starts, ends, fold=True)
    long = np.flatnonzero(ends - starts > 5)
    heads = mix(span_hashes(data, starts[long], starts[long] + 5, fold=True) ^ np.uint64(0xABCD))
    docs, h = np.concatenate((doc, doc[long])), np.concatenate((words, heads))
    order = np.lexsort((h, docs))
    docs, h = docs[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (docs[1:] != docs[:-1]) | (h[1:] != h[:-1])
    at = np.flatnonzero(new)
    return docs[at], h[at], np.diff(np.append(at, len(h))), np.diff(first)


class Model:
    """Character model, lexicon (sorted hashes with their counts of toxic and other documents) and regression weights."""

    def __init__(self, logp, hashes, toxic, other, n_toxic, n_other):
        self.logp, self.hashes, self.toxic, self.other, self.n = logp, hashes, toxic, other, (n_toxic, n_other)
        self.beta, self.mean, self.scale = None, None, None

    def odds(self, toxic, other, n_toxic, n_other):
        return np.log((toxic + 0.1) / (n_toxic + 1)) - np.log((other + 0.1) / (n_other + 1))

    def sums(self, texts: pa.Array, labels: np.ndarray | None = None) -> np.ndarray:
        """Five sums over the lexicon hits of each text; labels: take each text's own counts out."""
        n = len(texts)
        doc, h, count, words = features(texts)
        out = np.zeros((n, 5))
        if not len(self.hashes):
            return out
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        hit = self.hashes[at] == h
        doc, at, count = doc[hit], at[hit], count[hit]
        own = np.zeros(len(doc)) if labels is None else labels[doc].astype(float)
        taken = 0.0 if labels is None else 1.0
        w = self.odds(self.toxic[at] - own, self.other[at] - (taken - own), self.n[0] - own, self.n[1] - (taken - own))
        w = np.where(w > ODDS, w, 0.0)
        np.maximum.at(out[:, 0], doc, w)
        out[:, 1] = np.log1p(np.bincount(doc, w, n))
        out[:, 2] = np.log1p(np.bincount(doc, w * count, n))
        out[:, 3] = np.bincount(doc, (w > 0) * count, n) / np.maximum(words, 1) * 10
        out[:, 4] = np.log1p(np.bincount(doc, w > 0, n))
        return out

    def fit(self, x: np.ndarray, y: np.ndarray, steps: int = 60, ridge: float = 1e-2) -> None:
        """Newton steps of a logistic regression on standardised sums."""
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-9
        z = np.c_[(x - self.mean) / self.scale, np.ones(len(x))]
        beta = np.zeros(z.shape[1])
        for _ in range(steps):
            p = 1 / (1 + np.exp(-np.clip(z @ beta, -30, 30)))
            grad = z.T @ (p - y) + ridge * len(y) * 0.01 * beta
            hess = (z * (p * (1 - p))[:, None]).T @ z + (ridge * len(y) * 0.01 + 1e-6) * np.eye(len(beta))
            step = np.linalg.solve(hess, grad)
            beta -= step
            if np.abs(step).max() < 1e-8:
                break
        self.beta = beta

    def scores(self, texts: pa.Array) -> np.ndarray:
        if self.beta is None:
            return np.zeros(len(texts))
        z = np.c_[(self.sums(texts) - self.mean) / self.scale, np.ones(len(texts))]
        return 1 / (1 + np.exp(-np.clip(z @ self.beta, -30, 30)))


def character_model(docs: DataFrame) -> np.ndarray:
    """Trigram log probabilities, counted over all documents outside the held-out fold; the table has 28 ** 3 cells whatever the input."""

    def run(batches):
        total = np.zeros(28**3, np.int64)
        for whole in batches:
            for b in pieces(whole):
                total += trigram_counts(b.column("text"))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["cell", "n"])

    counts = docs.where(remainder(F.col("doc_id"), 3) != 1).select("text").mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    full = np.zeros(28**3)
    full[counts["cell"].to_numpy(np.int64)] = counts["n"].to_numpy(float)
    return log_probabilities(full)


def train(docs: DataFrame, labels: DataFrame, limit: int = LIMIT, least: int = LEAST) -> Model:
    logp = character_model(docs)
    chosen = sample_labels(labels.where(remainder(F.col("doc_id"), 3) != 1), "toxic", limit)
    marked = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", F.col("label").cast("int").alias("label"))

    def run(batches):
        restore = restorer(logp)
        for whole in batches:
            for b in pieces(whole):
                yield pa.RecordBatch.from_arrays([restore(b.column("text")).cast(pa.string()), b.column("label")], names=["text", "label"])

    marked = cut_lineage(marked.mapInArrow(run, "text string, label int"))
    n = {r["label"]: r["count"] for r in marked.groupBy("label").count().collect()}

    def count(batches):
        for whole in batches:
            for b in pieces(whole):
                doc, h, _, _ = features(b.column("text"))
                y = b.column("label").to_numpy()[doc]
                got = pd.DataFrame({"h": h.view(np.int64), "toxic": y, "other": 1 - y}).groupby("h", sort=False).sum().reset_index()
                yield pa.RecordBatch.from_pandas(got.astype("int64"), preserve_index=False)

    words = marked.mapInArrow(count, "h long, toxic long, other long").groupBy("h").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
    odds = F.log((F.col("toxic") + 0.1) / (n.get(1, 0) + 1)) - F.log((F.col("other") + 0.1) / (n.get(0, 0) + 1))
    lexicon = words.where(F.col("toxic") >= least).withColumn("odds", odds).where(F.col("odds") > ODDS).toPandas()
    hashes = lexicon["h"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(hashes)
    model = Model(logp, hashes[order], lexicon["toxic"].to_numpy(float)[order], lexicon["other"].to_numpy(float)[order], n.get(1, 0), n.get(0, 0))
    if not (n.get(0) and n.get(1)):
        return model

    def sums(batches):
        for whole in batches:
            for b in pieces(whole):
                y = b.column("label").to_numpy()
                yield pa.RecordBatch.from_pandas(pd.DataFrame(model.sums(b.column("text"), y), columns=list("abcde")).assign(y=y.astype(float)), preserve_index=False)

    fit = marked.mapInArrow(sums, "a double, b double, c double, d double, e double, y double").toPandas().sort_values(list("abcdey"))
    model.fit(fit[list("abcde")].to_numpy(), fit["y"].to_numpy())
    return model


def with_scores(docs: DataFrame, model: Model, name: str) -> DataFrame:
    """The columns of docs and the score, under the given name."""
    columns = docs.columns
    at = columns.index("text")

    def run(batches):
        restore = restorer(model.logp)
        for whole in batches:
            for b in pieces(pa.RecordBatch.from_arrays(whole.columns, names=["text" if i == at else f"c{i}" for i in range(whole.num_columns)]), most=1 << 20):
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(model.scores(restore(b.column("text"))))], names=[*columns, name])

    from pyspark.sql.types import DoubleType, StructType

    return docs.mapInArrow(run, StructType([*docs.schema.fields]).add(name, DoubleType()))


def toxicity(docs: DataFrame, labels: DataFrame, limit: int = LIMIT) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    model = train(docs, labels, limit)
    held = (remainder(F.col("doc_id"), 3) == 1).alias("held_out")
    return with_scores(docs.select("doc_id", "text"), model, "score").select("doc_id", held, "score", (F.col("score") >= CUT).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, limit: int = LIMIT) -> DataFrame:
    """The rows and columns of docs whose score is under the cut."""
    score = fresh(docs.columns, "score")
    return with_scores(docs, train(docs, labels, limit), score).where(F.col(score) < CUT).select(*[F.col(f"`{c}`") for c in docs.columns])
