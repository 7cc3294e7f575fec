import difflib
import itertools

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import rules as R
from corpusloom.functions import text as T
from corpusloom.operators import dedup, diff, expect, record_checks, reconcile, records, rollup, similar, templates
from corpusloom.plans import incremental
from corpusloom.plans.queries import saved

RULES = R.KeyRules({"term1": 1, "term2": 2, "term3": 3}, {"term 1": 1, "term 2": 2, "term 3": 3}, "lesson", {1: 24, 2: 14, 3: 24}, {i: [2 * i - 1, 2 * i] for i in range(1, 7)})


def one(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


@pytest.mark.parametrize("path,group,keys", [("Lesson 5/slides.pptx", None, [5]), ("Lesson_12/file.pdf", None, [12]), ("lesson-3/doc.docx", None, [3]), ("Lessons 3-5/file.pptx", None, [3, 4, 5]), ("Week 3/slides.pptx", None, [5, 6]), ("random_file.pptx", None, []), ("term2/Lesson 15/file.pptx", 2, []), ("a\\Term1\\x", 1, []), ("x/term 3 stuff/Lesson 5-6", 3, [5])])
def test_keys(spark, path, group, keys):
    df = one(spark, [(path,)], "p string").withColumn("g", R.group_of(F.col("p"), RULES))
    r = df.select("g", R.keys_of(F.col("p"), F.col("g"), RULES).alias("k")).first()
    assert (r.g, r.k) == (group, keys)


def test_text_functions(spark):
    df = one(spark, [("A  b\t C ", "Lesson 5 (1)_Plan.PPTX", "See https://youtu.be/ab-1. and https://x.org/a,")], "a string, n string, u string")
    r = df.select(T.norm(F.col("a")).alias("norm"), T.name_form(F.col("n")).alias("form"), T.urls(F.col("u")).alias("u"), T.slug(F.lit("A b--C!")).alias("slug"), T.capped(F.lit("abcdef"), 3).alias("cap"), T.punctuated(F.lit("x ")).alias("p"), T.host(F.lit("https://U@Ex.org:80/x")).alias("h"), T.tagged(F.lit("The NPCs and sound tool"), {"npcs": "NPCs", "npc": "NPCs", "sound tool": "Sound"}).alias("t")).first()
    assert (r.norm, r.form, r.u, r.slug, r.cap, r.p, r.h, r.t) == ("a b c", "lesson 5 plan", ["https://youtu.be/ab-1", "https://x.org/a"], "a-b-c", "abc...", "x.", "ex.org", ["NPCs", "Sound"])
    ratio = lambda a, b: df.select(T.edit_ratio(F.lit(a), F.lit(b))).first()[0]
    assert ratio("same", "same") == 1 and ratio("", "x") == 0 and ratio("teachers slides", "teacher slides") >= 0.85 and ratio("alpha", "omega") < 0.5


def lev(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_fuzzy_names(spark):
    names = ["teachers slides", "teacher slides", "teacher slide", "lesson plan", "lesson plans", "lessn plan", "rubric", "rubrics", "x", "xy", "a b c d e f g h", "a b c d e f g i", "b b c d e f g i", "zz b c d e f g i"]
    forms = one(spark, [(n, i) for i, n in enumerate(names)], "form string, ord int")
    for t in (0.7, 0.85):
        want = {tuple(sorted(p)) for p in itertools.combinations(names, 2) if 1 - lev(*p) / max(map(len, p)) >= t}
        edges = dedup.similar_forms(forms, t)
        assert {(r.a, r.b) for r in edges.collect()} == want
        reps, dups = [], {}
        for n in names:
            near = [m for m in reps if tuple(sorted((m, n))) in want]
            if near:
                dups[n] = near[0]
            else:
                reps.append(n)
        got = dedup.greedy_representatives(forms, edges, saved(spark)).collect()
        assert {r.form: r.similar_to for r in got if r.is_dup} == dups


def test_duplicates(spark):
    df = one(spark, [(1, "a", "m1"), (2, "a", "m2"), (3, "b", "m1"), (4, "c", ""), (5, "d", "")], "id int, name string, md5 string")
    assert [(r.id, r.duplicate_of) for r in dedup.exact_names(df).collect()] == [(2, 1)]
    assert [(r.id, r.duplicate_of) for r in dedup.same_content(df).collect()] == [(3, 1)]
    assert df.select(dedup.unsuppressed(F.array(*map(F.lit, ["Big game", "game", "Other"])))).first()[0] == ["Big game", "Other"]
    assert {tuple(r) for r in dedup.first_wins(df, ["name"], ["id"]).collect()} == {(1, "a", "m1"), (3, "b", "m1"), (4, "c", ""), (5, "d", "")}


def test_diffs(spark):
    s = "id string, md5 string, name string, modified_time string, term int"
    prev = one(spark, [("1", "a", "x", "t", 1), ("2", "b", "y", "t", 1), ("3", "c", "z", "t", 2), ("4", "d", "w", "t", 2), ("5", "", "v", "t", 3)], s)
    cur = one(spark, [("1", "a2", "x", "t", 1), ("2", "b", "y2", "t2", 1), ("3", "c", "z2", "t", 2), ("5", "e", "v", "t", 3), ("6", "f", "u", "t", 4)], s)
    got = {r.id: r.change_type for r in diff.snapshot_diff(cur, prev, "id", "md5", "name", "modified_time").collect()}
    assert got == {"1": "MODIFIED", "2": "METADATA_CHANGED", "3": "RENAMED", "4": "DELETED", "5": "UNCHANGED", "6": "NEW"}
    build = lambda df: df.groupBy("term").agg(F.count("*").alias("n"), F.max("md5").alias("m"))
    assert {tuple(r) for r in incremental.rebuild(cur, prev, build(prev), build, "term").collect()} == {(1, 2, "b"), (2, 1, "c"), (3, 1, ""), (4, 1, "f")}


def test_reconcile(spark):
    s = "atom_id string, atom_type string, content string, term int, lesson int, ord long"
    text = "one two three four five six seven eight"
    src = one(spark, [("s1", "text", "Hello  World here", 1, 1, 1), ("s2", "text", text, 1, 2, 2), ("s3", "text", "not to be found anywhere at all", 1, 1, 3), ("s4", "text", "ab", 1, 1, 4), ("s5", "link", "HTTP://www.x.org/a/", 1, 1, 5), ("s6", "text", "a much longer text that holds a tiny needle in it", 2, 1, 6)], s)
    out = one(spark, [("t1", "text", "hello world here", 2, 1, 1), ("t2", "text", "hello world here", 1, 1, 2), ("t3", "text", f"zero {text} nine", 1, 9, 3), ("t4", "link", "https://x.org/a", 1, 1, 4), ("t5", "text", "tiny needle", 1, 1, 5)], s)
    got = {r.atom_id: (r["class"], r.tier, r.target_id, r.confidence) for r in reconcile.reconcile(src, out).collect()}
    assert got == {"s1": ("matched", "exact", "t2", 1.0), "s2": ("matched", "contains", "t3", 0.9), "s3": ("unmatched", None, None, None), "s4": ("trivial", None, None, None), "s5": ("matched", "url_loose", "t4", 0.95), "s6": ("matched", "contains", "t5", 0.85)}
    assert reconcile.coverage(reconcile.reconcile(src, out)).first().coverage == 4 / 5
    stages = [("a", one(spark, [("x",), ("y",)], "k string")), ("b", one(spark, [("x",)], "k string"))]
    assert {tuple(r) for r in reconcile.attribute_loss(one(spark, [("x",), ("y",), ("z",)], "k string"), stages, "k", "a").collect()} == {("x", "b", "output"), ("y", "a", "b"), ("z", None, "a")}


def test_containment_join_is_lossless(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(60)
    hay = docs.select(F.col("doc_id").alias("hay_id"), T.norm(F.col("text")).alias("norm")).cache()
    needles = hay.select((F.col("hay_id") * 10).alias("needle_id"), F.substring("norm", 7, 60).alias("norm")).union(hay.select(F.col("hay_id") * 10 + 1, F.substring("norm", 20, 9))).cache()
    want = {(n.needle_id, h.hay_id) for n in needles.collect() for h in hay.collect() if n.norm and n.norm in h.norm}
    assert {(r.needle_id, r.hay_id) for r in reconcile.contained(needles, hay).collect()} == want


def test_needles_in_one_pass(spark):
    """10^5 short needles by one automaton, and by several, against a plain search of the words around each place."""
    import random

    from corpusloom.operators.needles import occurrences

    rnd = random.Random(2)
    needles = sorted({"".join(rnd.choice("abcdefghij é") for _ in range(rnd.randrange(1, 12))) for _ in range(160_000)})
    assert len(needles) >= 100_000
    texts = ["".join(rnd.choice("abcdefghij é") for _ in range(n)) for n in (0, 1, 30, 30, 400)] + [None, "ab" * 5000]
    held = set(needles)
    want = {(i, t[a : a + n]) for i, t in enumerate(texts) if t for n in range(1, 12) for a in range(len(t) - n + 1) if t[a : a + n] in held}
    hay, words = spark.createDataFrame(list(enumerate(texts)), "hay_id int, hay string"), spark.createDataFrame([(n,) for n in needles + needles[:5] + [""]], "needle string")
    for chars in (1 << 22, 200_000):
        got = [tuple(r) for r in occurrences(hay, words, chars).collect()]
        assert len(got) == len(want) and set(got) == want
    assert occurrences(hay, words.limit(0)).count() == 0 and occurrences(hay.limit(0), words).count() == 0


def plain_tier(atom, targets):
    """First tier of one atom against all targets, in loops: the order of tiers and targets as documented."""
    norm = lambda x: " ".join(x.lower().split())
    n, kind, term, lesson = norm(atom["content"]), atom["atom_type"], atom["term"], atom["lesson"]
    first = lambda ok: next((t["atom_id"] for t in targets if ok(t)), None)
    near = lambda t: norm(t["content"]) and (n in norm(t["content"]) or norm(t["content"]) in n)
    if hit := first(lambda t: norm(t["content"]) == n and (t["term"], t["lesson"]) == (term, lesson)) or first(lambda t: norm(t["content"]) == n):
        return "exact", hit, 1.0
    kinds = [kind, "text_block"] if kind == "speaker_note" else [kind]
    alike = [t for k in kinds for t in targets if t["atom_type"] == k]
    if len(n) >= (5 if kind == "table" else 10):
        for same, score in ((True, 0.9), (False, 0.85)):
            if hit := next((t["atom_id"] for t in alike if near(t) and (not same or t["term"] == term)), None):
                return "contains", hit, score
    if kind in ("text_block", "speaker_note", "table") and len(n) >= 15:
        scored = [(difflib.SequenceMatcher(None, n[:200], norm(t["content"])[:200]).ratio(), -i, t["atom_id"]) for i, t in enumerate(alike) if t["term"] == term]
        if scored and max(scored)[0] >= 0.8:
            return "fuzzy", max(scored)[2], max(scored)[0]
    if kind in ("link", "video_url"):
        bare = n.rstrip("/")
        if hit := first(lambda t: t["atom_type"] == "text_block" and bare in norm(t["content"])):
            return "url_in_text", hit, 0.8
    if kind in ("text_block", "speaker_note") and len(n) >= 15:
        for k in ("text_block", "speaker_note"):
            if hit := first(lambda t: t["atom_type"] == k and t["term"] == term and near(t)):  # noqa: B023
                return "cross_source", hit, 0.85
    return None


def test_reconcile_equals_loops(spark):
    """All text tiers with the fuzzy one: null terms, notes against text blocks, links of both kinds inside texts."""
    import random

    rnd = random.Random(8)
    base = [" ".join(rnd.choice("alpha beta gamma delta level game design build test player score".split()) for _ in range(rnd.randrange(3, 14))) for _ in range(40)]

    def changed(x):
        cut = rnd.randrange(4)
        return [x, x[3:-2], x.replace("a", "e", 2), x + " and some more"][cut]

    term = lambda: rnd.choice([None, 1, 2])
    target = [{"atom_id": f"t{i:03}", "atom_type": rnd.choice(["text_block", "speaker_note", "table"]), "content": b, "term": term(), "lesson": rnd.choice([None, 1]), "ord": i} for i, b in enumerate(base)]
    target += [{"atom_id": f"t9{i}", "atom_type": "text_block", "content": f"Look at https://x.org/{i} for more", "term": 1, "lesson": 1, "ord": 900 + i} for i in range(3)]
    source = [{"atom_id": f"s{i:03}", "atom_type": rnd.choice(["text_block", "speaker_note", "table"]), "content": changed(rnd.choice(base)), "term": term(), "lesson": rnd.choice([None, 1]), "ord": i} for i in range(120)]
    source += [{"atom_id": f"s9{i}", "atom_type": ["link", "video_url"][i % 2], "content": f"https://x.org/{i}/", "term": None, "lesson": None, "ord": 900 + i} for i in range(4)]
    schema = "atom_id string, atom_type string, content string, term int, lesson int, ord long"
    rows = lambda x: spark.createDataFrame([tuple(r.values()) for r in x], schema)
    got = {r.atom_id: (r.tier, r.target_id, r.confidence) if r.tier else None for r in reconcile.reconcile(rows(source), rows(target), fuzzy=similar.match_fuzzy).collect()}
    assert got == {s["atom_id"]: plain_tier(s, target) for s in source}
    assert {"exact", "contains", "fuzzy", "url_in_text"} <= {x[0] for x in got.values() if x}


def test_fuzzy_join(spark):
    base = ["the students build a small game with triggers", "write a short report about the level design", "completely different words in this sentence"]
    src = one(spark, [(f"s{i}", "text", 1, i, t.replace("small", "smal").replace("short", "shrt")) for i, t in enumerate(base[:2])] + [("s9", "text", 1, 9, "nothing like it")], "atom_id string, atom_type string, term int, ord int, norm string")
    out = one(spark, [(f"t{i}", "text", 1, i, t) for i, t in enumerate(base)], "atom_id string, atom_type string, term int, ord int, norm string")
    got = {r.atom_id: (r.target_id, r.confidence) for r in similar.match_fuzzy(src, out).collect()}
    assert got == {f"s{i}": (f"t{i}", difflib.SequenceMatcher(None, src.collect()[i].norm, base[i]).ratio()) for i in range(2)}


def test_fuzzy_docs_equal_brute_force(spark, sf):
    """q_fuzzy_docs against difflib over all pairs of a language."""
    import __spark_entry__

    d = spark.read.parquet(f"{sf}/documents.parquet").where("text is not null").select("doc_id", "lang", F.substring(T.norm(F.col("text")), 1, 200).alias("n")).collect()
    lab = {r.doc_id for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    want = {}
    for a in d:
        if a.doc_id in lab and len(a.n) >= 5:
            scored = [(difflib.SequenceMatcher(None, a.n, b.n).ratio(), -b.doc_id) for b in d if b.doc_id not in lab and b.lang == a.lang and len(b.n) >= 5 and difflib.SequenceMatcher(None, a.n, b.n).quick_ratio() >= 0.8]
            if scored and max(scored)[0] >= 0.8:
                want[a.doc_id] = (-max(scored)[1], round(max(scored)[0], 12))
    got = {r.atom_id: (r.target_id, round(r.confidence, 12)) for r in __spark_entry__.queries()["q_fuzzy_docs"](spark, sf).collect()}
    assert got == want and got


def test_records(spark):
    md = "# Slide 1\nLesson 4\nMake a game\nWhat makes a game fun to play?\n---\nNotes: say hello\nand more\n## Slide 2\nSuccess criteria\nI can make a level\nI can test it\n| a | b |\n|---|---|\n| 1 | 2 |\nplain"
    docs = one(spark, [(1, md)], "doc_id int, text string")
    s = records.slides(docs).cache()
    assert [(r.slide, r.notes) for r in s.orderBy("slide").collect()] == [(1, "say hello\nand more"), (2, "")]
    assert records.first_title(s).first().title == "Make a game" and records.questions(s).first().question == "What makes a game fun to play?"
    assert [r.line for r in records.latched(s, "(?i)success criteria").orderBy("line_no").limit(2).collect()] == ["I can make a level", "I can test it"]
    t = records.tables(docs).first()
    assert (t.headers, t.rows) == (["a", "b"], [["1", "2"]])
    c = one(spark, [(1, "Aim: learn to\nbuild things\n\nother\nGoal - win\n# end")], "doc_id int, text string")
    assert {(r.prefix, r.value) for r in records.continued(c, ["aim", "goal"]).collect()} == {("aim", "learn to build things"), ("goal", "win")}
    h = rollup.heading_sections(one(spark, [(1, 1, "intro"), (1, 2, "## A"), (1, 3, "x"), (1, 4, "## A"), (1, 5, "y")], "d int, n int, line string"), "d", "n", "line", r"^##\s*")
    assert {(r.heading, r.body) for r in h.collect()} == {("_preamble", "intro"), ("A", "y")}
    r = one(spark, [(1, "T", ["a", " "], "https://youtu.be/x https://e.org/a https://e.org/a/b")], "k int, title string, topics array<string>, text string")
    assert {(x.location, x.content) for x in records.atoms(r, "k", ["title", "topics"]).collect()} == {("title", "T"), ("topics:1", "a")}
    assert tuple(r.select(records.videos(F.col("text")), records.resources(F.col("text"))).first()) == (["https://youtu.be/x"], ["https://e.org/a", "https://e.org/a/b"])


def test_record_checks(spark):
    good = (1, 1, "Games", ["a"], ["make a good game"], ["NPCs"], ["kw"], ["signal"], "x" * 60 + ".", [("v", "https://youtu.be/a")], ["doc https://e.org/a"], [("p",)], "G7-G8", "1", "2024-01-01T00:00:00")
    bad = (1, 30, "Slide 3", ["a", "a"], ["short"], ["Nope"], ["k"], [" "], "tiny", [("v", "https://odd.example/a b")], ["https://odd.example/a b"], [("",), ("",)], "x", "", "soon")
    null = (1, 2, *[None] * 13)
    run = lambda *rows: {r.check_id: r.passed for r in record_checks.check_records(one(spark, list(rows), record_checks.RECORD), ["NPCs"], 24, ["youtu.be"], {"videos": 0.6}).collect()}
    assert all(run(good).values())
    failed = {k for k, v in run(bad).items() if not v}
    assert {"S005", "S008", "S012", "S013", "S014", "C001", "C002", "C003", "C004", "C006", "C007", "C013", "I003", "I006", "I007"} <= failed
    assert {"S002", "S015", "UC_videos"} <= {k for k, v in run(null).items() if not v}
    recs = one(spark, [good, good], record_checks.RECORD)
    assert not {r.check_id: r.passed for r in record_checks.check_records(recs, ["NPCs"], 24, []).collect()}["I005"]
    assert record_checks.missing_lessons(recs, one(spark, [(1, 3)], "term int, lessons int")).count() == 2
    looked = record_checks.lookups(recs.limit(1), one(spark, [("u1", 1, 1, None), ("u2", 1, 9, None), ("u3", None, None, "GAMES")], "id string, term int, lesson int, value string"))
    assert {r.id: r.passed for r in looked.collect()} == {"u1": True, "u2": False, "u3": True}


def test_rollups(spark):
    votes = one(spark, [("i", "path", 1.0, 1.0, 5), ("i", "kw", 0.7, 0.5, 6), ("j", "a", 0.5, 1.0, 1), ("j", "b", 0.5, 1.0, 2)], "item string, signal string, weight double, confidence double, candidate int")
    got = {r["item"]: (r.winners, r.status) for r in rollup.weighted_vote(votes, {"path": 1.5}).collect()}
    assert got == {"i": ([5], "medium"), "j": ([1, 2], "low")}
    n = one(spark, [(i, 10) for i in range(9)] + [(9, 100)], "k int, n int")
    assert [r.k for r in rollup.outliers(n, "n").where("outlier").collect()] == [9] and not any(r.outlier for r in rollup.outliers(n.limit(5), "n").collect())
    v = one(spark, [("r", 1, "f", "yes"), ("r", 2, "f", "no"), ("r", 3, "f", "no"), ("r", 1, "g", "a"), ("r", 2, "g", "b")], "record string, attempt int, field string, verdict string")
    assert {(r.field, r.verdict, r.unanimous) for r in rollup.consensus(v).collect()} == {("f", "no", False), ("g", "a", False)}
    m = rollup.merged_annotations(one(spark, [("k", ["a"], "x")], "k string, tags array<string>, description string"), one(spark, [("k", ["b"], "longer"), ("l", ["c"], "y")], "k string, tags array<string>, description string"), "k")
    assert {(r.k, tuple(r.tags), r.description, r.confidence) for r in m.collect()} == {("k", ("a", "b"), "longer", "high"), ("l", ("c",), "y", "single")}
    checks = expect.expect(n, [expect.Rule("A", "ERROR", F.col("n") > 50, "few"), expect.Rule("B", "WARNING", F.col("n") > 50, "some", 4, 0.2)])
    assert expect.verdict(checks).first().verdict == "FAIL" and expect.verdict(checks.where("check_id = 'B'")).first().verdict == "PASS"


def test_fuzzy_sides_take_every_labelled_document(spark):
    from difflib import SequenceMatcher

    from corpusloom.plans.corpus_queries import fuzzy_sides

    text = "a text about the green hills and the rivers between them"
    rows = [(1, text, "en"), (2, text, "en"), (3, text, "en"), (4, text + " x", "en"), (5, text, "de"), (6, "other words altogether, so no match", "en"), (7, text[:-3], "en"), (8, "aaaa" * 50, "en"), (9, "aaaa" * 50, "en"), (10, text + " x", "en")]
    labelled = [2, 3, 4, 6, 7, 8, 5]
    want = []
    for i, x, lang in rows:
        best = [(-SequenceMatcher(None, x, y).ratio(), j) for j, y, other in rows if j not in labelled and other == lang]
        if i in labelled and best and -min(best)[0] >= 0.8:
            want.append((i, min(best)[1], "fuzzy", round(-min(best)[0], 9)))
    d = spark.createDataFrame(rows, "doc_id long, norm string, term string").selectExpr("doc_id", "'text' AS atom_type", "term", "norm")
    got = fuzzy_sides(d, spark.createDataFrame([(i,) for i in [*labelled, 2]], "doc_id long"))
    assert sorted((r.atom_id, r.target_id, r.tier, round(r.confidence, 9)) for r in got.collect()) == want and len(want) >= 4


def test_group_checks_read_the_records_once_a_grain(spark, sf):
    """Titles and words are grains of their own; everything else comes from one written summary."""
    from corpusloom.plans.check_queries import q_group_checks

    plan = q_group_checks(spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("html#") and sum("Relation" in line and "html" in line for line in plan.splitlines()) == 2


def test_group_checks_equal_single_ones(spark):
    from corpusloom.operators import checks

    df = one(spark, [(1, 1, "a", "x"), (1, 1, "b", "x"), (1, 3, "c", ""), (2, 1, "d", "y"), (2, 2, "e", "z"), (3, 5, "f", None)], "g int, n int, title string, meta string")
    table = checks.summary(df, "g", "n", ("meta",), {"seen": F.col("title") > "b"})
    c = checks.GroupChecks(table, "g", "n", one(spark, [(1, 3), (2, 1), (4, 0)], "g int, size int"), "size")
    got = lambda x: tuple(x.first()[k] for k in ("failures", "total", "passed"))
    assert got(c.counts("X001")) == (1, 3, False) and got(c.declared()) == (2, 4, False) and got(c.counts("E005", only=F.col("g") == 1)) == (0, 1, True)
    assert got(c.contiguous()) == (1, 3, False) == got(checks.contiguous(df, "g", "n"))
    assert got(c.in_position()) == (2, 6, False) == got(checks.in_position(df, "g", "n"))  # the second row of 1, and 5
    assert got(c.constant(("meta",))) == (1, 3, False) == got(checks.constant_in_group(df, "g", ["meta"]))
    assert got(c.present(one(spark, [(1, 3), (1, 1), (9, 9)], "g int, n int"), "X002", mark="seen")) == (2, 3, False)
    assert got(c.rows("seen", "UN03", "INFO", "m")) == (4, 6, False)


def test_vote_of_signals(spark):
    """Nulls, ties, authoritative boost and bonus, inventory order, volumes."""
    from corpusloom.operators import votes

    v = votes.Voting([1, 2, 3, 4], {"path": 1.0, "parent": 1.0, "metadata": 0.95, "tags": 0.8, "content": 0.7, "volume": 0.5}, {1: [1, 2], 2: [3, 4]}, ["All of it"], [("a_film", [4])], {1: ["red apple"], 2: ["blue"]}, {"img": (1, 2)})
    rows = [("a", "x/all-of_it", None, None, None, None, None, ""), ("b", "Weeks 1-2 / lesson 3", None, [2], 0.5, None, None, "img"), ("c", "lesson 03", "week 2", None, None, None, None, "img"), ("d", "a film", None, None, None, ["Apple"], "BLUE", None), ("e", None, None, None, None, None, None, None), ("f", "inv/q", "week_2", [], None, [], "red apple blue", "img"), ("g", "lesson 9", "week 1 2", None, None, None, None, None)]
    items = spark.createDataFrame(rows, "item string, path string, batch string, known array<int>, known_confidence double, tags array<string>, text string, kind string")
    inventory = spark.createDataFrame([(1, "INV", "no - range"), (2, "inv/", "Lessons 1-2"), (3, "inv/q", "4")], "ord int, path string, keys string")
    out = votes.consensus(votes.signals(items, v, inventory), v).cache()
    got = {r.item: ([s.signal for s in r.signals], r.winners, r.confidence, r.status) for r in out.collect()}
    assert got["a"] == (["path"], [1, 2, 3, 4], 100.0, "HIGH_CONFIDENCE") and got["e"] == ([], [], 0.0, "UNMAPPED")
    assert got["b"] == (["path", "volume"], [2], 100.0, "HIGH_CONFIDENCE") and got["c"] == (["path"], [3], 100.0, "HIGH_CONFIDENCE")
    assert got["d"] == (["parent", "tags", "content"], [4], round(1.5 / (1.5 + 0.8 / 3 + 0.7 / 4) * 110, 1), "MEDIUM_CONFIDENCE")  # the tag is inside a key word: 1 of 3
    assert got["f"][0] == ["path", "metadata", "content"] and got["f"][1] == [3, 4] and got["g"] == (["path"], [1, 2, 3, 4], 100.0, "HIGH_CONFIDENCE")
    assert tuple(votes.mapping_summary(out).first()) == (7, 6, 1, 4, 1, 1) and votes.key_index(out).count() == 4 + 1 + 1 + 1 + 2 + 4
    label = lambda text, title: spark.range(1).select(votes.best_label(F.lit(text), F.lit(title), {"A": ["x", "y"], "B": ["z"]}, {"C": ["w"]})).first()[0]
    assert [label("z x", ""), label("z x", "Z"), label("w", "w"), label("", ""), label(None, None)] == ["A", "B", "C", "", ""]


def test_similar_forms_of_any_length(spark):
    """Against all pairs: short and long forms, edits at the ends, other alphabets."""
    import random

    from corpusloom.operators.dedup import similar_forms

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    rnd = random.Random(6)
    base = ["".join(rnd.choice("abcdefgh é日") for _ in range(n)) for n in (1, 2, 3, 6, 7, 12, 20, 21, 60, 200)]

    def changed(x):
        x = list(x)
        for _ in range(rnd.randrange(1, max(2, len(x) // 5))):
            i = rnd.randrange(len(x) + 1)
            x[i : i + rnd.randrange(2)] = rnd.choice([[], ["z"], ["a"]])
        return "".join(x)

    forms = sorted({f for x in base for f in (x, changed(x), changed(x), x + "q", x[1:]) if f})
    for least in (0.8, 0.9):
        want = {(a, b) for i, a in enumerate(forms) for b in forms[i + 1 :] if 1 - distance(a, b) / max(len(a), len(b)) >= least - 1e-12}
        got = {(min(r.a, r.b), max(r.a, r.b)) for r in similar_forms(spark.createDataFrame([(f,) for f in [*forms, forms[0], "", None]], "form string"), least).collect()}
        assert got == want and want


def test_assembled_records(spark):
    """Priority, limits, merging, equal values, nulls and blanks; a record is built again only where its sources changed."""
    from corpusloom.operators.assembly import Field, assemble
    from corpusloom.plans import incremental

    plan = [Field("title", (("b", "name"), ("a", "name"))), Field("tags", (("a", "tags"), ("b", "tags")), "list", 2), Field("all", (("b", "tags"), ("a", "tags")), "list", 3, merge=True), Field("n", (("a", "tags"), ("b", "tags")), "count")]
    a = spark.createDataFrame([(1, 2, "late", ["x", "y"]), (1, 1, "early", [" y ", None, ""]), (2, 1, None, None)], "key int, ord int, name string, tags array<string>")
    b = spark.createDataFrame([(1, 1, " ", ["y", "q"]), (2, 5, "two", ["r"] * 50), (None, 1, "none", None)], "key int, ord int, name string, tags array<string>")
    keys = spark.createDataFrame([(1,), (2,), (3,), (1,)], "key int")
    got = {r.key: tuple(r)[1:] for r in assemble(keys, {"a": a, "b": b}, plan).collect()}
    assert got == {1: ("early", ["y", "x"], ["y", "q", "x"], 3), 2: ("two", ["r"], ["r"], 1), 3: (None, [], [], 0)}
    assert assemble(keys.limit(0), {"a": a.limit(0), "b": b}, plan).count() == 0
    rows = lambda *x: spark.createDataFrame([(i, g, str(v), "n", "t", v) for i, g, v in x], "id int, grp int, md5 string, name string, modified_time string, v int")
    old, new = rows((1, 1, 10), (2, 1, 11), (3, 2, 20)), rows((1, 1, 10), (2, 1, 12), (3, 2, 20))
    build = lambda df: assemble(df.select("grp"), {"s": df.withColumn("ord", F.col("id"))}, [Field("values", (("s", "v"),), "list", 5)], "grp")
    built = build(old).withColumn("values", F.when(F.col("grp") == 2, F.array(F.lit("kept"))).otherwise(F.col("values")))
    assert {(r.grp, tuple(r["values"])) for r in incremental.rebuild(new, old, built, build, "grp").collect()} == {(1, ("10", "12")), (2, ("kept",))}



def test_template_records(spark):
    plan = templates.Plan(
        kinds=(("deck", "folio"), ("rubric|assessment.*guide", "product")), components={"folio": (25, "Folio"), "product": (50, "Rubric")}, skip="exemplar",
        terms=(("term 1|term1", "1"), ("term 2", "2")), lessons=((1, 3),), purpose="{label} template for all",
    )
    files = spark.createDataFrame(
        [(1, "My Rubric.v2.docx", "Term 1/x", "http://a"), (2, "Deck", "term 2", ""), (3, "exemplar rubric", "x", None), (4, "notes", "x", None), (5, "rubric", None, None), (6, None, "a/assessment b guide", None)],
        "file int, name string, path string, link string",
    )
    table = "|" + "x" * 18 + " Basic | short basic |  ||"
    bullets = ["  - able to build a thing", "* you must hand it in\r", "•• short", "- you should design it", "-- the evidence is due"]
    long = "y" * 600
    parts = spark.createDataFrame(
        [
            (1, 1, 0, "- the last skill of all"), (1, 0, 1, "\n".join([table, *bullets, "# " + "h" * 60, "p" * 39, "  " + long, "z" * 50])), (1, 0, 0, "- the first skill of all\n- the first skill of all"),
            (2, 0, 0, "\n".join(f"- skill number {i:02d}" for i in range(30))), (2, 1, 0, "\n".join(f"- must do number {i:02d}" for i in range(8)) + "\n| " + "b" * 20 + " advanced |"), (4, 0, 0, "- no kind, no skill"), (5, 0, 0, None), (None, 0, 0, "- skill of nobody"),
        ],
        "file int, source int, ord int, text string",
    )
    got = {r.file: r for r in templates.template_records(files.withColumn("component", F.lit("x")), parts.withColumn("field", F.lit("y")), plan).collect()}
    assert sorted(got) == [1, 2, 5, 6]
    r = got[1]
    assert (r.id, r.template_name, r.programme_component, r.weighting_percent, r.term, r.link) == ("my-rubric-v2", "My Rubric.v2", "product", 50, 1, "http://a")
    assert r.purpose == long[:500] and r.linked_lessons == ["Lesson 1", "Lesson 2", "Lesson 3"]
    assert r.core_skills == ["the first skill of all", "the first skill of all", "able to build a thing", "you should design it", "the last skill of all"]
    assert r.criteria == ["x" * 18 + " Basic", "you must hand it in", "the evidence is due"]
    r = got[2]
    assert r.core_skills == [f"skill number {i:02d}" for i in range(10)] and r.criteria == [*[f"must do number {i:02d}" for i in range(8)], "b" * 20 + " advanced"]
    assert (r.purpose, r.link, r.linked_lessons, r.term) == ("Folio template for all", "term 2", [], 2)
    assert (got[5].purpose, got[5].core_skills, got[5].criteria, got[5].link) == ("Rubric template for all", [], [], "")
    assert got[6].template_name == "" and got[6].id == ""
    assert templates.template_records(files.limit(0), parts, plan).count() == 0 and templates.template_records(files, parts.limit(0), plan).count() == 4


def test_votes_work_out_a_text_once(spark, sf):
    """The plan of the vote names the lower-cased text and the tags' split once, and moves no text to join the small tables."""
    from corpusloom.plans.vote_queries import voted

    plan = voted(spark, sf).select("item", "winners")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("lower(text#") == plan.count("split(coalesce(text#") == 1
    below = plan[plan.index("Join") :]
    assert "lower(text#" in below and "text#" not in plan[: plan.index("Join")]


def test_best_targets_equal_difflib(spark, sf):
    """Blocks of texts against difflib over all pairs, ties too; nearly all pairs are ruled out before they are scored."""
    import random

    from corpusloom.operators import block_match

    rnd = random.Random(5)
    parts = ["er", "tion", "the ", "a ", "in", "of ", "ñ", "ing ", "re", "and ", "x", "q", "é ", "zz", "w", "k "]
    changed = lambda t, p: "".join(rnd.choice(["", c + "z", "q"]) if rnd.random() < p else c for c in t)[:200]
    base = ["".join(rnd.choices(parts, k=140))[: rnd.choice([5, 60, 140, 199, 200, 200, 200])] for _ in range(50)] + ["ab" * 100, "q" * 200]
    t = sorted({x for b in base for x in (b, changed(b, 0.08), b[50:] + b[:50]) if len(x) >= 5})
    s = sorted({x for x in (changed(rnd.choice(base), p) for p in (0, 0.05, 0.1, 0.2) for _ in range(15)) if len(x) >= 5})
    for least in (0.8, 0.4):
        ratios = [[difflib.SequenceMatcher(None, a, b).ratio() for b in t] for a in s]
        want = [(i, j, v) for i, row in enumerate(ratios) for j, v in enumerate(row) if v == max(row) >= least]
        assert sorted(block_match.best_targets(s, t, least)) == want and len(want) > 20
    d = [r[0] for r in spark.read.parquet(f"{sf}/documents.parquet").where("lang = 'en' and text is not null").select(T.norm_start(F.col("text"), 200)).distinct().collect()]
    assert len(block_match.may_match(d[::2], d[1::2], 0.8)[0]) < 0.1 * (len(d) / 2) ** 2


def test_fuzzy_join_in_blocks(spark, sf, monkeypatch):
    """Many small blocks find what one finds, and the beginning's normal form is that of the whole text."""
    d = spark.read.parquet(f"{sf}/documents.parquet").select(F.col("doc_id").alias("atom_id"), F.col("doc_id").alias("ord"), F.lit("text").alias("atom_type"), F.col("lang").alias("term"), T.norm_start(F.col("text"), 200).alias("norm"))
    find = lambda: sorted(map(tuple, similar.match_fuzzy(d.where("atom_id % 2 = 0"), d.where("atom_id % 2 = 1")).collect()))
    whole = find()
    monkeypatch.setattr(similar, "S_BLOCK", 7)
    monkeypatch.setattr(similar, "T_BLOCK", 11)
    monkeypatch.setattr(similar, "UNITS", 9)
    assert find() == whole and whole
    odd = one(spark, [(x,) for x in (" \t a  B" * 300, "x" * 199 + "Σ" + "́" * 900 + "a", "İ" * 150, "a " * 100 + " " * 2000 + "b", "", None, "Σ")], "t string")
    assert all(r.a == r.b for r in odd.select(T.norm_start(F.col("t"), 200).alias("a"), F.substring(T.norm(F.col("t")), 1, 200).alias("b")).collect())


def test_word_hashes_do_not_depend_on_what_stands_around(spark):
    """Equal words in a row have one hash wherever they stand, others differ; null, empty and odd blanks."""
    import random

    import pyarrow as pa

    from corpusloom.operators import needles

    rnd = random.Random(1)
    texts = [None, "", "", " ", "a"] + [" ".join(rnd.choices(["a", "bb", "ñé", "c", "dd", ""], k=rnd.randrange(15))) for _ in range(300)] + ["", ""]
    for rows in (pa.array(texts, pa.string()), pa.array(texts, pa.string()).slice(3, 200)):
        gram, row, first = needles.word_grams(rows, 4)
        split = [[w for w in (t or "").split(" ") if w] for t in rows.to_pylist()]
        assert [len(x) for x in split] == (first[1:] - first[:-1]).tolist() and row.tolist() == [i for i, x in enumerate(split) for _ in x]
        words, seen = [w for x in split for w in x], {}
        for k, g in enumerate(gram.tolist()):
            seen.setdefault(tuple(words[k : k + 4]), set()).add(g)
        assert all(len(x) == 1 for x in seen.values()) and len(set.union(*seen.values())) == len(seen)


def test_contained_in_slices_with_a_crowded_bitmap(spark, monkeypatch):
    """Needles are found in one pass that only sends on what hits the bitmap, also where nearly every bit of it is set, and in texts of several slices."""
    import random

    from corpusloom.operators import needles as N

    rnd = random.Random(2)
    hay = [(i, " ".join(rnd.choices(["ab", "c", "def", "gh", "ñi"], k=rnd.randrange(60)))) for i in range(120)]
    cut = lambda t: t[(a := rnd.randrange(len(t) + 1)) : a + rnd.randrange(60)]
    some = [(i, cut(rnd.choice(hay)[1]) or "zz") for i in range(150)]
    want = {(i, j) for i, n in some for j, t in hay if n in t}
    frames = spark.createDataFrame(some, "needle_id long, norm string"), spark.createDataFrame(hay, "hay_id long, norm string")
    got = lambda: {(r.needle_id, r.hay_id) for r in reconcile.contained(*frames).collect()}
    assert got() == want and sum(len(n.split()) >= 6 for _, n in some) > 40
    hits = lambda: N.anchor_hits(frames[1].withColumnRenamed("norm", "hay"), spark.createDataFrame([(5,)], "anchor long"), 4)
    assert hits().count() == 0
    for name, value in (("SLICE", 300), ("BITS", 64), ("PART", 16)):
        monkeypatch.setattr(N, name, value)
    assert got() == want and hits().count() > 20


def test_no_text_is_copied_for_its_grams(spark):
    """holding searches numbers, not texts: a line of 60,000 words takes as long as its words, not their square."""
    import time

    long = " ".join(f"w{i}" for i in range(60_000))
    s = spark.createDataFrame([("w10 w11 w12 w13 w14 w15 w16",)], "s_norm string")
    t = spark.createDataFrame([(long,), ("w1 w2",)], "t_norm string")
    began = time.time()
    assert [r.t_norm for r in reconcile.holding(s, t).collect()] == [long] and time.time() - began < 100
