import json
import zipfile

from corpusloom.sources import api, files, office, pages, sinks

REL = '<?xml version="1.0"?><Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">{}</Relationships>'


def deck(path, slides):
    """A small deck: slides are (texts, notes, links, images)."""
    with zipfile.ZipFile(path, "w") as z:
        for i, (texts, notes, links, images) in enumerate(slides, 1):
            runs = "".join(f"<a:p><a:r><a:t>{t}</a:t></a:r></a:p>" for t in texts)
            used = "".join(f'<a:hlinkClick r:id="l{k}"/>' for k in range(len(links))) + "".join(f'<a:blip r:embed="i{k}"/>' for k in range(len(images)))
            z.writestr(f"ppt/slides/slide{i}.xml", f'<?xml version="1.0" encoding="UTF-8"?><p:sld xmlns:p="p" xmlns:a="a" xmlns:r="r"><p:sp>{runs}{used}</p:sp></p:sld>')
            rels = "".join(f'<Relationship Id="l{k}" Target="{u}"/>' for k, u in enumerate(links)) + "".join(f'<Relationship Id="i{k}" Target="../media/{m}"/>' for k, m in enumerate(images)) + '<Relationship Id="x9" Target="../media/unused.png"/>'
            if notes:
                rels += f'<Relationship Id="n1" Target="../notesSlides/notesSlide{i}.xml"/>'
                z.writestr(f"ppt/notesSlides/notesSlide{i}.xml", f'<p:notes xmlns:p="p" xmlns:a="a"><a:t>{notes}</a:t></p:notes>')
            z.writestr(f"ppt/slides/_rels/slide{i}.xml.rels", REL.format(rels))
        for m in sorted({m for s in slides for m in s[3]} | {"unused.png"}):
            z.writestr(f"ppt/media/{m}", b"png")


def test_decks(spark, tmp_path):
    deck(tmp_path / "a.pptx", [(["Title", "Body &amp; more"], "say this", ["https://a.example/x", "slide2.xml"], ["one.png"]), (["Second"], "", [], ["one.png", "two.png"])])
    (tmp_path / "b.pptx").write_bytes(b"not a zip")
    with zipfile.ZipFile(tmp_path / "d.pptx", "w") as z:
        z.writestr("ppt/presentation.xml", "<p/>")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "e.pptx").write_bytes(b"")
    parts = office.unzip(spark, str(tmp_path), "*.pptx").cache()
    assert [(r.slide, r.texts) for r in office.deck_slides(parts).orderBy("slide").collect()] == [(1, ["Title", "Body & more"]), (2, ["Second"])]
    assert [(r.slide, r.notes) for r in office.deck_notes(parts).collect()] == [(1, "say this")]
    assert [(r.slide, r.url) for r in office.deck_links(parts).collect()] == [(1, "https://a.example/x")]
    assert {(r.image, tuple(r.slides)) for r in office.deck_images(parts).collect()} == {("one.png", (1, 2)), ("two.png", (2,)), ("unused.png", ())}
    assert {tuple(r.slides) for r in office.deck_images(parts, require_use=False).where("image = 'unused.png'").collect()} == {(1, 2)}
    assert {r.path[-6:]: r.status for r in office.integrity(parts).collect()} == {"a.pptx": "valid", "b.pptx": "corrupt", "d.pptx": "empty", "e.pptx": "empty"}
    assert {tuple(r) for r in office.integrity_totals(office.integrity(parts)).collect()} == {("valid", 1), ("corrupt", 1), ("empty", 2)}
    small = spark.read.format("office_parts").option("path", f"file://{tmp_path}").option("glob", "*.pptx").option("splitBytes", 1).load()
    assert small.rdd.getNumPartitions() == 4 and small.drop("path").exceptAll(parts.drop("path")).isEmpty() and small.count() == parts.count()
    assert office.unzip(spark, str(tmp_path), "*.none").count() == 0


def test_documents_and_sheets(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.docx", "w") as z:
        z.writestr("word/document.xml", '<w:document xmlns:w="w"><w:p><w:pPr><w:pStyle w:val="Heading1"/></w:pPr><w:r><w:t>Head</w:t></w:r></w:p><w:p><w:r><w:t>Some </w:t></w:r><w:r><w:t xml:space="preserve">text &lt;1&gt;</w:t></w:r></w:p><w:p></w:p></w:document>')
        z.writestr("word/_rels/document.xml.rels", REL.format('<Relationship Id="r1" Target="https://b.example"/><Relationship Id="r2" Target="styles.xml"/><Relationship Id="r3" Target="mailto:a@b.c"/>'))
    with zipfile.ZipFile(tmp_path / "a.xlsx", "w") as z:
        z.writestr("xl/sharedStrings.xml", "<sst><si><t>Name</t></si><si><r><t>Two </t></r><r><t>runs</t></r></si></sst>")
        z.writestr("xl/worksheets/sheet1.xml", '<sheetData><row r="1"><c r="A1" t="s"><v>0</v></c><c r="B1"><v>7</v></c></row><row r="2"><c r="A2"/></row><row r="3"><c r="A3" t="s"><v>1</v></c></row></sheetData>')
    docs = office.unzip(spark, str(tmp_path), "*.docx")
    assert [(r.style, r.text) for r in office.doc_paragraphs(docs).orderBy("pos").collect()] == [("Heading1", "Head"), (None, "Some text <1>")]
    assert sorted(r.url for r in office.doc_links(docs).collect()) == ["https://b.example", "mailto:a@b.c"]
    assert [(r.row_no, r.cells) for r in office.sheet_rows(office.unzip(spark, str(tmp_path), "*.xlsx")).orderBy("row_no").collect()] == [(0, ["Name", "7"]), (2, ["Two runs"])]
    assert office.text_of(office.doc_paragraphs(docs), "path", ["pos"], "text").first().text == "Head\nSome text <1>"


def test_files(spark, tmp_path):
    (tmp_path / "in/sub").mkdir(parents=True)
    (tmp_path / "in/sub/a.md").write_text("## Slide 1\nx\n## Slide 2\n")
    (tmp_path / "in/~$a.md").write_text("temp")
    (tmp_path / "in/b.csv").write_text('name,note\n"x, y","say ""hi"""\n')
    rows = {r.name: r for r in files.scan_files(spark, str(tmp_path / "in")).collect()}
    assert set(rows) == {"a.md", "b.csv"} and rows["a.md"].folder == "sub" and rows["b.csv"].folder == "" and rows["a.md"].size == 24
    assert [r.name for r in files.with_extension(files.scan_files(spark, str(tmp_path / "in")), ".md").collect()] == ["a.md"]
    doc = files.read_text_docs(spark, str(tmp_path / "in/sub")).first()
    assert (doc.char_count, doc.slide_count) == (24, 2)
    assert tuple(files.read_csv(spark, str(tmp_path / "in/b.csv"), "name string, note string").first()) == ("x, y", 'say "hi"')
    (tmp_path / "j").mkdir()
    (tmp_path / "j/a.json").write_text(json.dumps({"file": "a", "images": [{"path": "p", "n": 1}, {"path": "q", "n": 2}], "links": []}, indent=1))
    (tmp_path / "j/b.json").write_text("{broken")
    j = files.read_json(spark, str(tmp_path / "j"), "file string, images array<struct<path:string,n:int>>, links array<struct<url:string>>").cache()
    assert j.where("__corrupt is not null").count() == 1
    assert [tuple(r) for r in files.exploded(j, "images", "file").collect()] == [("a", "p", 1), ("a", "q", 2)] and files.exploded(j, "links", "file").count() == 0
    both = files.union_formats(spark.createDataFrame([("u", "f", "new")], "url string, file string, text string"), spark.createDataFrame([("u", "f", 3), ("v", "f", 4)], "url string, file string, page int"), ["url", "file"])
    assert {(r.url, r.text, r.page) for r in both.collect()} == {("u", "new", None), ("v", None, 4)}
    assert files.read_or_empty(spark, str(tmp_path / "none"), "a int").count() == 0
    (tmp_path / "bad.txt").write_bytes(b"\xef\xbb\xbfab\x00")
    assert tuple(files.invalid_texts(spark, str(tmp_path / "bad.txt")).drop("path").first()) == (True, True, True, False)


def test_api_json(spark):
    run = lambda t, u=None: {"textRun": {"content": t, "style": {"link": {"url": u}} if u else None}}
    cell = lambda *r: {"text": {"textElements": list(r)}}
    d = {"presentationId": "p", "title": "t", "slides": [{"objectId": "s1", "pageElements": [{"shape": {"text": {"textElements": [run("Hello "), run("there", "https://x.example")]}}}, {"table": {"tableRows": [{"tableCells": [cell(run("H1")), cell(run("H2"))]}, {"tableCells": [cell(run("a")), cell(run("b", "https://y.example"))]}]}}, {"video": {"url": "v", "source": "YOUTUBE", "id": "k"}}, {"image": {"contentUrl": "img"}}]}]}
    decks = spark.read.schema(api.DECK).json(spark.sparkContext.parallelize([json.dumps(d)]))
    assert [(r.slide, r.text) for r in api.deck_texts(decks).collect()] == [(1, "Hello there")]
    assert sorted(r.url for r in api.deck_links(decks).collect()) == ["https://x.example", "https://y.example"]
    assert [(r.url, r.video_id) for r in api.deck_videos(decks).collect()] == [("v", "k")]
    assert [(r.headers, r.rows) for r in api.deck_tables(decks).collect()] == [(["H1", "H2"], [["a", "b"]])]
    assert api.deck_image_urls(decks).first().url == "img"
    doc = {"documentId": "d", "title": "t", "body": {"content": [{"paragraph": {"paragraphStyle": {"namedStyleType": "HEADING_1"}, "elements": [{"textRun": {"content": "Head\n"}}]}}, {"paragraph": {"elements": [{"textRun": {"content": "See it", "textStyle": {"link": {"url": "https://z.example"}}}}]}}, {}]}}
    docs = spark.read.schema(api.DOC).json(spark.sparkContext.parallelize([json.dumps(doc)]))
    assert [(r.style, r.text) for r in api.doc_blocks(docs).orderBy("pos").collect()] == [("HEADING_1", "Head"), (None, "See it")]
    assert [r.url for r in api.doc_links(docs).collect()] == ["https://z.example"]


def test_pages(spark):
    html = '<html lang="EN"><head><title> A </title><script>var a="<a href=\\"no\\">";</script></head><body><h2>Top &amp; more</h2><p>One <b>two</b></p><p></p><!-- <a href="no2"> --><a class="x" href="/y">y</a></body></html>'
    p = spark.createDataFrame([(1, "u", html), (2, "v", None)], "page_id long, url string, html string")
    r = pages.parse_pages(p).orderBy("page_id").first()
    assert (r.lang, r.title, [tuple(h) for h in r.headings], r.paragraphs) == ("en", "A", [(2, "Top & more")], ["One two", ""])
    assert [(x.page_id, x.pos, x.url) for x in pages.page_links(p).collect()] == [(1, 0, "/y")]
    assert [tuple(x) for x in pages.page_paragraphs(p).collect()] == [(1, "p:1", "One two")]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", ["x", "y"], "long text"), (2, "b", [], "t")], "term int, name string, tags array<string>, note string")
    sinks.write_by_key(df, "term", str(tmp_path / "j"), str(tmp_path / "all"))
    assert spark.read.json(str(tmp_path / "j")).count() == 2 and (tmp_path / "j/term=1").exists() and spark.read.json(str(tmp_path / "all")).count() == 2
    for ts in ("2024-01-01", "2024-01-02"):
        sinks.append_run(df, str(tmp_path / "log"), ts)
    assert {str(r.run_ts)[:10] for r in sinks.latest_run(spark, str(tmp_path / "log")).collect()} == {"2024-01-02"}
    for s, d in (("a", df), ("b", df), ("a", df.limit(1))):
        sinks.write_snapshot(d, str(tmp_path / "snap"), s)
    sinks.write_snapshot(df, str(tmp_path / "snap"), "c", dry_run=True)
    assert {r.snapshot_id: r["count"] for r in spark.read.parquet(str(tmp_path / "snap")).groupBy("snapshot_id").count().collect()} == {"a": 1, "b": 2}
    up = sinks.upsert(df, spark.createDataFrame([(2, "new")], "term int, name string"), ["term"])
    assert {r.term: r.name for r in up.collect()} == {1: "a", 2: "new"}
    sinks.export_csv(df, str(tmp_path / "csv"), "tags", {"note": 4})
    assert {(r.tags, r.note) for r in spark.read.option("header", True).csv(str(tmp_path / "csv")).collect()} <= {("x|y", "long"), ("", "t"), (None, "t")}
    ok, bad = (spark.createDataFrame([(v,)], "verdict string") for v in ("PASS", "FAIL"))
    assert not sinks.archive_if_passed(df, bad, str(tmp_path / "arc"), "1") and sinks.archive_if_passed(df, ok, str(tmp_path / "arc"), "1")


def test_sheet_cells_by_reference(spark):
    xml = '<row r="1"><c r="A1"><f/><v>1</v></c><c r="C1"><v>2</v></c><c r="D1"/></row><row r="3"><c r="AB3" t="inlineStr"><is><t>a &amp; b</t></is></c></row>'
    parts = spark.createDataFrame([("f", "xl/worksheets/sheet1.xml", xml, None)], "path string, entry string, xml string, error string")
    got = {r.row_no: r.cells for r in office.sheet_rows(parts).collect()}
    assert got == {0: ["1", "", "2", ""], 2: [""] * 27 + ["a & b"]}


def test_tables_and_paragraphs_of_decks_and_documents(spark):
    deck = "<p><a:p><a:r><a:t>One </a:t></a:r><a:r><a:t>line</a:t></a:r></a:p><a:tbl><a:tr h='1'><a:tc><a:p><a:t>H</a:t></a:p></a:tc><a:tc><a:t>I</a:t></a:tc></a:tr><a:tr><a:tc><a:t>1</a:t></a:tc><a:tc><a:t>2</a:t></a:tc></a:tr></a:tbl></p>"
    doc = "<w:tbl><w:tr><w:tc><w:p><w:t>A</w:t></w:p></w:tc></w:tr><w:tr><w:tc><w:t xml:space='preserve'>b &lt; c</w:t></w:tc></w:tr></w:tbl>"
    parts = spark.createDataFrame([("f", "ppt/slides/slide2.xml", deck, None), ("g", "word/document.xml", doc, None)], "path string, entry string, xml string, error string")
    assert office.deck_slides(parts).first().texts[0] == "One line"
    r = office.deck_tables(parts).first()
    assert (r.slide, r.headers, r.rows) == (2, ["H", "I"], [["1", "2"]])
    r = office.doc_tables(parts).first()
    assert (r.headers, r.rows) == (["A"], [["b < c"]])


def test_maps_annotations_and_keyed_readers(spark, tmp_path):
    from pyspark.sql import functions as F

    (tmp_path / "t.json").write_text(json.dumps({"a.mp4": {"text": "hi", "n": 1}, "b.mp4": {"text": "yo", "n": 2}, "c.mp4": None}))
    assert {tuple(r) for r in files.read_map(spark, str(tmp_path / "t.json"), "text:string,n:int").collect()} == {("a.mp4", "hi", 1), ("b.mp4", "yo", 2)}
    (tmp_path / "a").mkdir()
    (tmp_path / "a/x.json").write_text(json.dumps({"batches": [{"batch": "lesson_7", "results": [{"source": "s", "tag": "t"}]}, {"batch": "misc", "results": [{"source": "Lesson 3", "tag": "u"}, {"source": "none", "tag": "v"}]}]}))
    number = lambda c: F.nullif(F.regexp_extract(F.lower(c), r"lesson[_ ](\d+)", 1), F.lit("")).cast("int")
    got = files.read_annotations(spark, str(tmp_path / "a"), "source:string,tag:string", number("batch"), number("source"))
    assert {(r.tag, r.key) for r in got.collect()} == {("t", 7), ("u", 3), ("v", None)}
    (tmp_path / "p.csv").write_text('id,payload\n1,"{""lesson_id"": 12, ""x"": 1}"\n2,"{""lesson_id"": 13,\n""lesson_id"": 12"\n')
    assert {r.lesson_id for r in files.ids_in_csv(spark, str(tmp_path / "p.csv"), "id int, payload string", "payload", "lesson_id").collect()} == {12, 13}
    spark.createDataFrame([(1, 2, "a"), (1, 3, "b"), (2, 2, "c")], "term int, lesson int, v string").write.partitionBy("term").parquet(str(tmp_path / "k"))
    assert [r.v for r in files.read_keyed(spark, str(tmp_path / "k"), "lesson int, v string, term int", term=1, lesson=3).collect()] == ["b"]
    assert files.read_keyed(spark, str(tmp_path / "gone"), "term int", term=1).count() == 0
    (tmp_path / "Lesson 4.mp4").write_text("x" * 10)
    media = files.media_files(files.scan_files(spark, str(tmp_path), "*.mp4"), number("name"), ".mp4")
    assert [(r.size, r.key) for r in media.collect()] == [(10, 4)]


def test_api_notes_and_tables(spark):
    text = lambda *t: {"text": {"textElements": [{"textRun": {"content": x}} for x in t]}}
    d = {"presentationId": "p", "slides": [{"slideProperties": {"notesPage": {"pageElements": [{"shape": text("Say ", "hello\n")}, {}]}}}, {}]}
    decks = spark.read.schema(api.DECK).json(spark.sparkContext.parallelize([json.dumps(d)]))
    assert [tuple(r) for r in api.deck_notes(decks).collect()] == [("p", 1, "Say hello")]
    cell = lambda t: {"content": [{"paragraph": {"elements": [{"textRun": {"content": t + "\n"}}]}}]}
    doc = {"documentId": "d", "body": {"content": [{"table": {"tableRows": [{"tableCells": [cell("H"), cell("I")]}, {"tableCells": [cell("1"), cell("2")]}]}}]}}
    docs = spark.read.schema(api.DOC).json(spark.sparkContext.parallelize([json.dumps(doc)]))
    assert [(r.headers, r.rows) for r in api.doc_tables(docs).collect()] == [(["H", "I"], [["1", "2"]])]
