import hashlib
import random
import zlib

import pytest

from corpusloom.llm.merkle import manifest, proven

from . import cases

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return digest(*["-" if row[c] is None else f"{len(str(row[c]).encode())}:{row[c]}" for c in ("doc_id", "source", "lang", "n_chars", "text")])


def levels_over(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([digest(*levels[-1][i : i + 8]) for i in range(0, len(levels[-1]), 8)])
    return levels


def path(levels, i):
    out = []
    for nodes in levels[:-1]:
        start = i // 8 * 8
        out.append((nodes[start:i], nodes[i + 1 : start + 8]))
        i //= 8
    return out


def brute(rows):
    """The whole manifest in lists: all levels of all trees kept."""
    out, langs = [], sorted({r["lang"] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    ordered = {x: sorted(((r, leaf(r)) for r in rows if r["lang"] == x), key=lambda y: (y[0]["doc_id"] is not None, y[0]["doc_id"] or 0, y[1])) for x in langs}
    trees = {x: levels_over([h for _, h in ordered[x]]) for x in langs}
    top = levels_over([trees[x][-1][0] for x in langs])
    for k, x in enumerate(langs):
        for i, (row, h) in enumerate(ordered[x]):
            proof, text = path(trees[x], i) + path(top, k), row["text"]
            if zlib.crc32(b"" if row["doc_id"] is None else str(row["doc_id"]).encode()) % 3 == 0 and text is not None:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            folded = leaf({**row, "text": text})
            for left, right in proof:
                folded = digest(*left, folded, *right)
            out.append((row["doc_id"], h, trees[x][-1][0], top[-1][0], digest(*[s for a, b in proof for s in a + b]), folded, folded == top[-1][0]))
    return sorted(out, key=str)


def got(df):
    return sorted(map(tuple, manifest(df).collect()), key=str)


# one leaf, one run, two stored levels of one tree, three trees of unlike depths, more trees than a run holds, no rows
@pytest.mark.parametrize("n, langs", [(0, [None]), (1, [None]), (9, ["a", "b"]), (4200, ["a"]), (1500, ["a", "a", "a", None, ""]), (200, [f"l{i}" for i in range(90)])])
def test_manifest_equals_all_levels_kept(spark, n, langs):
    rnd = random.Random(n)
    rows = [(rnd.randrange(n) if rnd.random() > 0.05 else None, rnd.choice(["Ab", None, "", "xÉy", "QQ"]), rnd.choice(langs), rnd.choice([None, "s"]), rnd.choice([None, 3])) for _ in range(n)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(df) == brute([dict(zip(df.columns, r)) for r in rows])


def test_manifest_of_documents_and_hard_rows(spark, sf):
    df = spark.read.parquet(f"{sf}/documents.parquet")
    rows = got(df)
    assert rows == brute([r.asDict() for r in df.collect()]) and {r[-1] for r in rows} == {True, False}
    hard = cases.docs(spark).selectExpr("*", "cast(length(text) as long) AS n_chars", "'x' AS tree", "0 AS idx", "'y' AS h", "1 AS id", "2 AS path")
    assert got(hard) == brute([r.asDict() for r in hard.collect()])


def test_proofs_of_a_table_with_other_fields(spark):
    """The operator takes any fields, key and order; an unchanged row folds to the root, and only that."""
    from pyspark.sql import functions as F

    from corpusloom.llm.merkle import fold

    df = spark.range(700).selectExpr("id AS k", "id % 3 AS part", "concat('v', id) AS v")
    rows = proven(df, {"v": F.when(F.col("k") == 5, F.lit("other")).otherwise(F.col("v"))}, ("k", "v"), "part", "k").withColumn("ok", fold(F.col("path"), F.col("seen")) == F.col("root")).collect()
    assert len(rows) == 700 and [r.k for r in rows if not r.ok] == [5]
