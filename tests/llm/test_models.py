import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from corpusloom.llm import attention_lm, near_dedup, piece_fst, quality_classifier, substring_dedup, toxicity

from . import cases

SPACE = re.compile(r"[\x20\x09-\x0D]+")


def low(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def accuracy(rows, labels, held):
    got = [(labels[r.doc_id], r.predicted) for r in rows if r.doc_id in labels and r.held_out == held]
    return sum(a == b for a, b in got) / len(got)


def test_quality_classifier(spark):
    docs, table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    labels = dict(table.select("doc_id", "quality").collect())
    rows = quality_classifier.quality_scores(docs, table).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert accuracy(rows, labels, True) > 0.9
    edge = quality_classifier.quality_scores(cases.docs(spark), table).collect()
    assert len(edge) == len(cases.ROWS) and len({r.score for r in edge if r.doc_id == 5}) == 1
    assert {r.score for r in quality_classifier.quality_scores(cases.docs(spark), table.limit(0)).collect()} == {0.0}
    assert quality_classifier.quality_scores(docs.limit(0), table).count() == 0


def test_toxicity(spark):
    docs, table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    labels = dict(table.select("doc_id", "toxic").collect())
    rows = toxicity.toxicity(docs, table).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert accuracy(rows, labels, True) > 0.9
    clean, bad = "plain words that nobody minds at all today", "you 1d10t what a l0ser and m o r o n truly stupiiiid"
    more = spark.createDataFrame([(9001, clean), (9002, bad), (None, None)], "doc_id long, text string")
    got = {r.doc_id: r.score for r in toxicity.toxicity(docs.select("doc_id", "text").union(more), table).collect()}
    assert got[9002] > 0.7 > got[9001]
    kept = toxicity.drop_toxic(cases.docs(spark), table)
    assert kept.columns == cases.docs(spark).columns and kept.count() == len(cases.ROWS)
    assert {r.score for r in toxicity.toxicity(cases.docs(spark), table.limit(0)).collect()} == {0.0}
    assert toxicity.toxicity(docs.limit(0), table).count() == 0


def test_spaced_words_beside_others(spark):
    docs, table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = toxicity.train(docs, table)
    whole = toxicity.restorer(model.logp)
    restore = lambda text: whole(pa.array([text]))[0].as_py()
    assert "moron" in restore("you are a m o r o n").split() and {"stupid", "idiot"} <= set(restore("s t u p i d i d i o t").split())
    assert "loser" in restore("so l o s e r").split() and "pathetic" in restore("so p a t h e t i c").split()  # the reading as one word stays
    texts = pa.array(["you are a m o r o n", "s t u p i d i d i o t", "you are a fine one"])
    hits = model.sums(whole(texts))[:, 0]
    assert hits[0] > 0 and hits[1] > 0 and hits[2] == 0


def test_viterbi_over_word_boundaries():
    rng = np.random.default_rng(1)
    logp = np.log(rng.dirichlet(np.ones(28), (28, 28)))
    code = lambda c: 0 if c == " " else ord(c) - 96 if c in toxicity.LETTERS else 27
    for token in ("a b c", "m o r o n", "l-0-l"):
        paths = [(0.0, "")]
        for slot in toxicity.lattice(token, True):
            paths = [(s + w, t + x) for s, t in paths for x, w in slot]
        totals = []
        for s, t in paths:
            a = b = 0
            for k in [*map(code, t), 0]:
                s += logp[a, b, k]
                a, b = b, k
            totals.append((s, t))
        assert toxicity.decode(token, logp, True) == max(totals)[1]


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(0)
    logp = np.log(rng.dirichlet(np.ones(28), (28, 28)))
    code = lambda c: ord(c) - 96 if c in toxicity.LETTERS else 27

    def best(token):
        paths = [(0.0, "")]
        for slot in toxicity.lattice(token):
            paths = [(s + w, t + x) for s, t in paths for x, w in slot]

        def total(s, t):
            a = b = 0
            for k in [*map(code, t), 0]:
                s += logp[a, b, k]
                a, b = b, k
            return s

        return max((total(s, t), t) for s, t in paths)[1]

    for token in ("1d10t", "a b c", "xooo1", "$t00", "l-0-l", "z9"):
        assert toxicity.decode(token, logp) == best(token)


def test_lm_scores(spark, sf):
    for docs in (cases.docs(spark), cases.sample(spark, sf)):
        texts = [(r.doc_id, r.text) for r in docs.collect()]
        tokens = [[w for w in SPACE.split(low(t)) if w] + [None] for _, t in texts]
        held = [zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2 for i, _ in texts]
        c = Counter(w for t, h in zip(tokens, held) if not h for w in t)
        n, v = sum(c.values()), len(c)
        want = sorted((i or -1, h, len(t), sum(c[w] > 0 for w in t), n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in t), 6)) for (i, _), t, h in zip(texts, tokens, held))
        for frequent in (1 << 21, 50):
            rows = attention_lm.lm_scores(docs, frequent=frequent, epochs=1).collect()
            assert sorted((r.doc_id or -1, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in rows) == want
            assert all(r.score < 0 for r in rows)
    assert attention_lm.lm_scores(docs.limit(0)).count() == 0


def test_lm_score_does_not_depend_on_what_is_broadcast(spark, sf):
    """Rare words get their exact share by the join: nearly all words, some or none of them broadcast."""
    docs = cases.sample(spark, sf)
    got = [{r.doc_id: (r.score, r.n_known) for r in attention_lm.lm_scores(docs, frequent=f, epochs=1).collect()} for f in (1 << 21, 50, 1)]
    for other in got[1:]:
        assert all(abs(got[0][i][0] - other[i][0]) <= 1e-6 * abs(got[0][i][0]) and got[0][i][1] == other[i][1] for i in got[0])
    no_share = [{r.doc_id: r.score for r in attention_lm.lm_scores(docs, frequent=f, epochs=1, share=0).collect()} for f in (1 << 21, 50)]
    assert all(abs(no_share[0][i] - no_share[1][i]) <= 1e-6 * abs(no_share[0][i]) for i in no_share[0])


def test_lm_score_does_not_depend_on_which_pairs_are_broadcast(spark, sf):
    """Pairs of ids that aren't broadcast get their exact counts by the join: all pairs broadcast, some or none, with all words, some or none."""
    for docs, share in ((cases.sample(spark, sf), attention_lm.MIX), (cases.docs(spark), attention_lm.MIX), (cases.docs(spark), 0)):
        runs = [attention_lm.lm_scores(docs, frequent=f, epochs=1, share=share, pairs=p).collect() for f, p in ((1 << 21, 1 << 21), (1 << 21, 500), (50, 50), (1, 0))]
        whole, *others = (sorted((r.doc_id or -1, r.n_tokens, r.n_known, r.base_score, r.score) for r in rows) for rows in runs)
        for rows in others:
            assert [r[:3] for r in rows] == [r[:3] for r in whole]
            assert all(abs(a - b) <= 1e-6 * abs(a) for x, y in zip(whole, rows) for a, b in zip(x[3:], y[3:]))


def test_lm_pairs_not_held_are_in_the_rest(spark, sf):
    """Held pairs and the others are together all pairs of the training documents; what follows an id is counted over all of them."""
    lm = attention_lm
    docs = cases.sample(spark, sf)
    counts = lm.word_counts(docs)
    whole = lm.trained(docs, counts, epochs=0)
    want = dict(zip(whole.cells.tolist(), whole.counts.tolist()))
    for pairs in (500, 0):
        model, rest = lm.trained_in_parts(docs, counts, pairs=pairs, epochs=0)
        held, rest = dict(zip(model.cells.tolist(), model.counts.tolist())), {r.cell: r.n for r in rest.collect()}
        assert rest and not held.keys() & rest.keys() and {**held, **rest} == want
        assert model.owners.tolist() == whole.owners.tolist() and model.totals.tolist() == whole.totals.tolist()


def test_lm_score_of_a_long_word(spark):
    """A word costs what its ids cost, however improbable it is; 40 and 43 are held out."""
    docs = spark.createDataFrame([(i, "the quick brown fox") for i in range(20)] + [(40, "q" * 20_000), (43, "q" * 40_000)], "doc_id long, text string")
    for frequent, pairs in ((1 << 21, 1 << 21), (1 << 21, 0), (1, 0)):
        got = {r.doc_id: r.score for r in attention_lm.lm_scores(docs, frequent=frequent, epochs=0, pairs=pairs).collect()}
        assert got[43] < 1.9 * got[40] < -1000


def test_lm_scores_do_not_depend_on_partitions(spark, sf):
    docs = cases.sample(spark, sf)
    got = [{r.doc_id: r.score for r in attention_lm.lm_scores(docs.repartition(k), epochs=2).collect()} for k in (1, 7)]
    assert all(abs(got[0][i] - got[1][i]) <= 1e-6 * abs(got[0][i]) for i in got[0])


def test_lm_score_is_the_plain_product(spark, sf):
    """The score of some texts from the definition: word share, class by one window at a time, share inside the class by counted pairs."""
    lm = attention_lm
    docs = cases.sample(spark, sf)
    rows = {r.doc_id: r.score for r in lm.lm_scores(docs, epochs=2).collect()}
    model = lm.trained(docs, lm.word_counts(docs), epochs=2)
    encode = lm.encoder(lm.VOCABULARY).encode_ordinary
    texts = {r.doc_id: [w for w in SPACE.split(low(r.text)) if w] for r in docs.collect()}
    train = [t for i, t in texts.items() if zlib.crc32(str(i).encode()) % 7 != 2]
    c = Counter(w for t in train for w in [*t, None])
    ids_of = lambda words: [e for w in words for e in [encode(" " + w)]] + [[lm.END]]
    pairs, inside = Counter(), Counter()
    for t in train:
        flat = [i for e in ids_of(t) for i in e]
        for a, b in zip([lm.IDS, *flat], flat):
            pairs[a, b] += 1
            inside[a, model.layout.kind[b]] += 1
    for i in sorted(texts)[:12]:
        total, seen = 0.0, []
        for word, ids in zip([*texts[i], None], ids_of(texts[i])):
            p = 1.0
            for k in ids:
                code = 0
                for x in ([lm.IDS] * lm.WINDOW + seen)[-lm.WINDOW :]:
                    code = code * (lm.CLASSES + 1) + (lm.PAD if x == lm.IDS else model.layout.kind[x])
                before = seen[-1] if seen else lm.IDS
                logp = lm.forward(model.values, np.array([code]))[0][0]
                p *= math.exp(logp[model.layout.kind[k]]) * (pairs[before, k] + lm.PULL * model.layout.share[k]) / (inside[before, model.layout.kind[k]] + lm.PULL)
                seen.append(k)
            total += math.log10(lm.MIX * c[word] / sum(c.values()) + (1 - lm.MIX) * p)
        assert abs(total - rows[i]) < 1e-3 * max(1, abs(total))


def test_lm_probabilities_sum_to_one():
    lm = attention_lm
    rng = np.random.default_rng(2)
    ids = rng.integers(0, 400, 3000)
    layout = lm.Layout(np.bincount(ids, minlength=lm.IDS).astype(float), lm.space_first(lm.VOCABULARY))
    cell, n = np.unique(np.append(lm.IDS, ids[:-1]) * lm.IDS + ids, return_counts=True)
    model = lm.Model(lm.start_values(), layout, cell, n.astype(float))
    total = 0.0
    for k in range(0, lm.IDS, 10000):  # every id as the next one after two fixed ids
        tail = np.arange(k, min(k + 10000, lm.IDS))
        flat, first = np.stack((np.full(len(tail), 5), np.full(len(tail), 9), tail), 1).ravel(), np.arange(len(tail) + 1) * 3
        total += np.exp(model.log_probabilities(flat, first)[2::3]).sum()
    assert abs(total - 1) < 1e-3


def test_lm_is_near_the_word_base(spark):
    """On words that the training documents hold the model is as good as the counts; unseen words cost what their letters cost, not one count."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [r for r in attention_lm.lm_scores(docs).collect() if r.held_out]
    n, base, score = (sum(r[k] for r in rows) for k in ("n_tokens", "base_score", "score"))
    assert score / n > -4.7 and score / n > base / n - 0.6
    known = [r for r in rows if r.n_known == r.n_tokens]
    assert known and sum(r.score for r in known) > 1.01 * sum(r.base_score for r in known)


def test_attention_gradients():
    rng = np.random.default_rng(0)
    codes = rng.integers(0, attention_lm.WINDOWS, 40)
    codes[0] = attention_lm.WINDOWS - 1  # the beginning of a text
    counts = rng.integers(0, 5, (40, attention_lm.CLASSES)).astype(float)
    p = attention_lm.start_values()
    g, _ = attention_lm.gradients(p, codes, counts)
    for name in p:
        for at in np.argsort(-np.abs(g[name]).ravel())[:4]:
            where = np.unravel_index(at, p[name].shape)
            loss = []
            for step in (1e-5, -1e-5):
                q = {k: v.copy() for k, v in p.items()}
                q[name][where] += step
                loss.append(attention_lm.gradients(q, codes, counts)[1])
            assert abs((loss[0] - loss[1]) / 2e-5 - g[name][where]) < 1e-6


def jaccard(a, b):
    wa, wb = SPACE.split(low(a).strip()), SPACE.split(low(b).strip())
    f = lambda w: Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4)))
    x, y = f(wa), f(wb)
    return sum((x & y).values()) / sum((x | y).values())


def brute_classes(texts):
    """Class of each row: links between different texts at 0.8, equal texts together."""
    kinds = sorted({t or "" for _, t in texts})
    parent = {t: t for t in kinds}

    def root(t):
        while parent[t] != t:
            t = parent[t]
        return t

    real = [t for t in kinds if SPACE.sub("", t)]
    for i, a in enumerate(real):
        for b in real[:i]:
            if 0.7 < (len(a) + 1) / (len(b) + 1) < 1.4 and jaccard(a, b) >= 0.8:
                parent[root(a)] = root(b)
    groups = {}
    for i, t in texts:
        groups.setdefault(root(t or ""), []).append(i)
    return sorted((i or -1, min(g for g in groups[root(t or "")] if g is not None) if any(g is not None for g in groups[root(t or "")]) else -1, len(groups[root(t or "")])) for i, t in texts)


def test_near_duplicates(spark, sf):
    base = [f"w{i * 7 % 311}" for i in range(400)]
    near = [(100 + k, " ".join(base[: k * 20] + ["edit", str(k)] + base[k * 20 + 1 :])) for k in range(15)]
    group = spark.createDataFrame([*near, (200, "Short Text"), (201, "short text"), (202, "short texts")], "doc_id long, text string")
    for docs in (cases.docs(spark), group, cases.sample(spark, sf)):
        rows = near_dedup.near_duplicates(docs).collect()
        assert sorted((r.doc_id or -1, -1 if r.class_id is None else r.class_id, r.class_size) for r in rows) == brute_classes([(r.doc_id, r.text) for r in docs.collect()])
        kept = near_dedup.keep_one(docs)
        assert kept.columns == docs.columns
        assert sorted(-1 if r.doc_id is None else r.doc_id for r in kept.collect()) == sorted({-1 if r.class_id is None else r.class_id for r in rows})
    assert near_dedup.near_duplicates(docs.limit(0)).count() == 0


def test_star_of_copies_that_are_not_near_to_each_other(spark):
    rng = np.random.default_rng(8)
    base = [f"w{i}" for i in range(400)]
    texts = [(0, " ".join(base))]
    for k in range(1, 301):
        words = list(base)
        for at in rng.choice(80, 7, replace=False) * 5 + 2:
            words[at] = f"edit{k}x{at}"
        texts.append((k, " ".join(words)))
    assert jaccard(texts[0][1], texts[1][1]) > 0.8
    assert sum(jaccard(texts[i][1], texts[i + 1][1]) < 0.8 for i in range(1, 300)) > 290
    rows = near_dedup.near_duplicates(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    assert {(r.class_id, r.class_size) for r in rows} == {(0, 301)}


def test_rare_tokens_meet(spark):
    texts = [(k.to_bytes(2, "big"), " ".join(f"w{(i * i + (k if i % 9 < k % 4 else 0)) % 97}" for i in range(30 + k % 5))) for k in range(60)]
    rows = near_dedup.rare_tokens(spark.createDataFrame(texts, "key binary, text string"), 0.8).collect()
    own = {}
    for r in rows:
        own.setdefault(bytes(r.key), set()).add(r.token)
    near = [(a, b) for i, (a, x) in enumerate(texts) for b, y in texts[:i] if jaccard(x, y) >= 0.8]
    assert near and all(own[a] & own[b] for a, b in near)
    at = {(bytes(r.key), r.token): (r.size, r.pos) for r in rows}
    for a, b in near:  # at the first shared token what is left holds the overlap
        first = min(own[a] & own[b], key=lambda t: at[a, t][1])
        (x, i), (y, j) = at[a, first], at[b, first]
        assert min(x - i, y - j) >= 0.8 / 1.8 * (x + y) - 1e-6


def boilerplate(edits):
    """250 pairs; all texts share most of their words, so that strangers are at about 0.77, and a pair differs in `edits` words."""
    rng = np.random.default_rng(edits)
    base, rows = [f"common{i}" for i in range(300)], []
    for k in range(250):
        words = list(base)
        for at in rng.choice(55, 4, replace=False) * 5 + 2:
            words[at] = f"own{k}x{at}"
        other = list(words)
        for at in rng.choice(59, edits, replace=False) * 5:
            other[at] = f"edit{k}x{at}"
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(other))]
    return rows


def test_all_links_in_shared_boilerplate(spark):
    for edits in (5, 4):
        rows = boilerplate(edits)
        assert jaccard(rows[0][1], rows[1][1]) >= 0.8 and jaccard(rows[0][1], rows[2][1]) < 0.8
        got = {r.doc_id: r.class_id for r in near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
        assert sum(got[2 * k] == got[2 * k + 1] for k in range(250)) == 250


def test_dart_signatures_estimate_weighted_jaccard():
    rng = np.random.default_rng(4)
    h = np.arange(1, 301, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    errors = []
    for _ in range(30):
        a, b = rng.uniform(0.2, 3, 300), rng.uniform(0.2, 3, 300)
        b[: rng.integers(0, 300)] = 1
        b = np.where(rng.random(300) < 0.5, a, b)
        s = near_dedup.signatures(np.repeat([0, 1], 300), np.tile(h, 2), np.concatenate((a, b)), 2)
        errors.append((s[0] == s[1]).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum())
    assert abs(np.mean(errors)) < 0.03 and np.std(errors) < 0.08


def test_substring_dedup(spark, sf):
    line = "the same hundred and thirty bytes of boilerplate go around again and again, however often the page is read by anyone at all. "
    own = spark.createDataFrame([(1, "a" * 500), (2, line * 5), (3, "head " + line * 2 + "tail"), (4, "x" * 199), (5, "é" * 150 + line), (6, "é" * 150 + line + "!"), (7, "y" * 200), (7, "y" * 200), (8, None)], "doc_id long, text string")
    for docs in (cases.docs(spark), own, cases.sample(spark, sf)):
        texts = [(r.doc_id, (r.text or "").encode()) for r in docs.collect()]
        n = Counter(t[s : s + 200] for _, t in texts for s in range(len(t) - 199))
        want = []
        for i, t in texts:
            off = np.zeros(len(t) + 1, bool)
            for s in range(len(t) - 199):
                if n[t[s : s + 200]] > 1:
                    off[s : s + 200] = True
            kept = bytes(b for b, o in zip(t, off) if not o)
            want.append((i or -1, len(t), int(off.sum()), int((off[:-1] & ~np.append(False, off[:-2])).sum()) if len(t) else 0, hashlib.sha256(kept).hexdigest()))
        got = substring_dedup.remove_repeats(docs).collect()
        assert sorted((r.doc_id or -1, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == sorted(want)
        assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in got)
    assert substring_dedup.remove_repeats(docs.limit(0)).count() == 0


def shortest(t, text):
    data = (" " + text).encode().replace(b" ", bytes([piece_fst.MARK])) if text else b""
    known = {x: i for i, x in enumerate(t.bytes) if x and t.cost[i] < piece_fst.FALLBACK}
    best = [(0.0, [])]
    for j in range(1, len(data) + 1):
        ways = [(best[j - k][0] + t.cost[known[data[j - k : j]]], known[data[j - k : j]], j - k) for k in range(1, min(j, t.longest) + 1) if data[j - k : j] in known and best[j - k]]
        if data[j - 1 : j] not in known:
            ways.append((best[j - 1][0] + piece_fst.FALLBACK, int(t.byte_id[data[j - 1]]), j - 1))
        cost, piece, at = min(ways)
        best.append((cost, best[at][1] + [piece]))
    return best[-1][1]


def test_pieces(spark, sf):
    t = piece_fst.transducer(piece_fst.MODEL)
    texts = ["", "a", " ", "  two  spaces ", "Ünï cödé ▁ text 😀 emoji\r\n\x0b", "▁▁", "\n\n", "x" * 50, "1234 http://a.b/c?d=e", "日本語 mixed text"]
    ids, first = t.encode(pa.array(texts))
    assert [ids[a:b].tolist() for a, b in zip(first, first[1:])] == [shortest(t, x) for x in texts]
    for docs in (cases.docs(spark), cases.sample(spark, sf)):
        rows = piece_fst.piece_report(docs, with_pieces=True).collect()
        assert len(rows) == docs.count() and all(r.round_trip and r.n_pieces == len(r.pieces) for r in rows)
        back = piece_fst.decode(piece_fst.encode(docs))
        assert sorted((r.doc_id or -1, r.text) for r in back.collect()) == sorted((r.doc_id or -1, r.text or "") for r in docs.collect())
    assert piece_fst.piece_report(docs.limit(0)).count() == 0


def test_normaliser_of_the_model():
    import pytest

    assert piece_fst.transducer(piece_fst.MODEL).prefix is True
    spec = lambda *rules: bytes([3 << 3 | 2, 2 * len(rules)]) + bytes(x for k, v in rules for x in (k << 3, v))
    assert piece_fst.normaliser(spec((3, 0), (4, 0))) is False and piece_fst.normaliser(spec((4, 0))) is True
    for bad in (spec((4, 1)), spec((4, 0), (5, 0))):
        with pytest.raises(ValueError):
            piece_fst.normaliser(bad)


def test_words_that_look_alike_encode_apart():
    from .test_hard_texts import thue_morse

    t = piece_fst.transducer(piece_fst.MODEL)
    texts = [thue_morse(2048), thue_morse(2048, True), thue_morse(1024) + " x", thue_morse(1024, True) + " x"]
    ids, first = t.encode(pa.array(texts))
    assert [x.decode() for x in t.decode(ids, first)] == texts


def test_pipeline_stages_against_brute_force(spark, sf):
    import corpus_pipeline

    from .test_native import base_spans, brute_contamination

    docs, labels = cases.sample(spark, sf), spark.read.parquet(f"{sf}/labels.parquet")
    stages = dict(corpus_pipeline.STAGES)
    step = lambda name, df: spark.createDataFrame(stages[name](spark, df, sf).collect(), df.schema)
    clean = step("toxicity", docs)
    bad = {r.doc_id for r in toxicity.toxicity(docs, labels).collect() if r.score >= 0.7}
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in docs.collect()} - bad
    one = step("near_dedup", clean)
    assert sorted(r.doc_id for r in one.collect()) == sorted({c for _, c, _ in brute_classes([(r.doc_id, r.text) for r in clean.collect()])})
    free = step("decontamination", one)
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    hit = {w[0] for w in brute_contamination([(r.doc_id, r.text) for r in one.collect()], items) if w[-1]}
    assert {r.doc_id for r in free.collect()} == {r.doc_id for r in one.collect()} - hit
    redacted = {r.doc_id: r for r in step("secrets", free).collect()}
    for r in free.collect():
        now = redacted[r.doc_id]
        assert now.n_chars == len(now.text) and not base_spans(now.text)
        assert base_spans(r.text) or "[secret]" in now.text or now.text == r.text
    t = piece_fst.transducer(piece_fst.MODEL)
    rows = stages["sentencepiece"](spark, spark.createDataFrame(list(redacted.values()), docs.schema), sf).collect()
    assert len(rows) == len(redacted) and all(r.round_trip for r in rows)
    for r in sorted(rows, key=lambda r: len(redacted[r.doc_id].text))[:40]:  # ways of equal cost may differ by rounding
        best = shortest(t, redacted[r.doc_id].text)
        assert abs(t.cost[list(r.pieces)].sum() - t.cost[best].sum()) < 1e-6 * (1 + len(best))


def test_pipeline_takes_any_rows(spark, sf, tmp_path):
    """Nulls, empty and very long texts, repeated rows and clashing columns through all stages."""
    import corpus_pipeline

    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{sf}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    cases.docs(spark).withColumn("n_chars", F.length("text").cast("long")).write.parquet(f"{tmp_path}/documents.parquet")
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in rows} >= {1, 6, 7, 8} and all(r.round_trip for r in rows)
    assert len(rows) == len({r.doc_id for r in rows})


def test_pipeline(spark, sf):
    import corpus_pipeline

    docs = cases.sample(spark, sf)
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sf)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == docs.columns, name
            assert stage(spark, docs.limit(0), sf).count() == 0
            rows = out.collect()
            assert 0.5 * docs.count() <= len(rows) <= docs.count()
            docs = spark.createDataFrame(rows, docs.schema)
    assert out.count() == docs.count() == corpus_pipeline.run(spark, sf).count()
