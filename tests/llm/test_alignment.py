import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from corpusloom.llm import alignment

from . import cases

HARD = [None, "", " ", "▁ x", "a" * 3000, "<s> <|endoftext|> </s>", "😀" * 500, "\x00\x01 \n\n\t", "  double  ", "日本語テキスト" * 50, "é́", "same same", "same same", "퟿"]


def tokens_of(path_a, path_b):
    """Encoders to (id, bytes), A by the library that its file is made for."""
    import sentencepiece
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(path_a), sentencepiece.SentencePieceProcessor(model_file=path_b)
    a.encode_special_tokens = True
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    byte = {chr(x): x for x in plain} | {chr(256 + k): x for k, x in enumerate(x for x in range(256) if x not in plain)}
    return (
        lambda s: [(i, bytes(byte[c] for c in a.id_to_token(i))) for i in a.encode(" " + s, add_special_tokens=False).ids],
        lambda s: [(i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()) for i in b.encode(s)],
    )


def ends(tokens):
    out, at = [], 0
    for _, x in tokens:
        at += len(x)
        out.append(at)
    return out


def brute(texts):
    """One merge of the two lists of ends per text, and a counter over all links."""
    encode_a, encode_b = tokens_of(alignment.BYTE_BPE, alignment.PIECES)
    docs, total = [], Counter()
    for text in texts:
        a, b = (encode_a(text), encode_b(text)) if text else ([], [])
        if {b"".join(x for _, x in t) for t in (a, b)} != {(" " + (text or "")).encode()}:
            a, b = [], []
        end_a, end_b, groups, links, i, j = ends(a), ends(b), [], [], 0, 0
        for end in sorted(set(end_a) & set(end_b)):
            ii, jj = end_a.index(end, i) + 1, end_b.index(end, j) + 1
            groups.append(",".join(str(x) for x, _ in a[i:ii]) + "|" + ",".join(str(x) for x, _ in b[j:jj]))
            links.append((a[ii - 1][0], b[jj - 1][0]))
            i, j = ii, jj
        docs.append((len(a), len(b), groups, links))
        total.update(links)
    best = Counter()
    for (_, b), n in total.items():
        best[b] = max(best[b], n)
    return [(na, nb, len(g), len(k), sum(total[x] == best[x[1]] for x in k), sum(total[x] for x in k), hashlib.sha256(";".join(g).encode()).hexdigest() if g else "") for na, nb, g, k in docs]


@pytest.mark.parametrize("share", [alignment.LINK_SHARE, 500, 0])  # all pairs looked up, some, none
def test_alignment_equals_a_merge(spark, sf, share):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").union(spark.createDataFrame([(10_000 + i, x) for i, x in enumerate(HARD)], "doc_id long, text string"))
    rows = docs.collect()
    want = sorted((r.doc_id, *x) for r, x in zip(rows, brute([r.text for r in rows])))
    assert sorted(map(tuple, alignment.alignment_report(docs, share=share).collect())) == want


def test_rows_of_any_kind(spark):
    got = alignment.alignment_report(cases.docs(spark)).collect()
    assert len(got) == len(cases.ROWS) and len({r[1:] for r in got if r.doc_id == 5}) == 1
    assert {(r.n_a, r.groups_sha256) for r in got if r.doc_id in (2, 3, 8)} == {(0, "")}  # null, empty, a literal marker
    assert alignment.alignment_report(cases.docs(spark).limit(0)).count() == 0
    text = alignment.align(cases.docs(spark).where("doc_id = 1"), with_groups=True).first()
    assert text.groups_sha256 == hashlib.sha256(text.groups.encode()).hexdigest() and text.groups.count(";") == text.n_groups - 1


def test_cuts_of_random_lists():
    """The halving finds every common end, whatever their density and the texts' lengths."""
    rnd = random.Random(3)
    for density in (0.02, 0.5, 0.98):
        texts = [([*sorted(rnd.sample(range(1, n), int(n * density))), n], [*sorted(rnd.sample(range(1, n), int(n * rnd.random()))), n]) for n in (rnd.randrange(1, 400) for _ in range(60))]
        base = np.concatenate(([0], np.cumsum([a[-1] for a, _ in texts])))
        lists = [np.concatenate([np.array(t[k]) + base[i] for i, t in enumerate(texts)]) for k in (0, 1)]
        bounds = [np.concatenate(([0], np.cumsum([len(t[k]) for t in texts]))) for k in (0, 1)]
        got_a, got_b = alignment.cuts(*lists, *bounds)
        common = np.intersect1d(*lists)
        assert (lists[0][got_a - 1] == common).all() and (lists[1][got_b - 1] == common).all()
    empty = np.zeros(0, np.int64)
    assert len(alignment.cuts(empty, empty, np.array([0]), np.array([0]))[0]) == 0


def test_long_words():
    """A million characters in one word: no common end for long, or one at every character."""
    work = alignment.aligner(alignment.BYTE_BPE, alignment.PIECES)
    for text in ("ab" * 500_000, "é" * 500_000, "a1" * 500_000):
        (na, nb, groups), _, links = work.align(pa.array([text]))
        assert 0 < groups[0] <= min(na[0], nb[0]) and links[3].sum() == groups[0]
