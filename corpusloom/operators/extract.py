"""Fields from text by line rules: activities, topics, artifacts, signals, objectives, sections, alignments, skills; and lookups that tie records to their sources.

Texts are rows (key, part, body[, notes]); lines are exploded once and every rule is a filter, a window inside one key, or one aggregate. Word lists and patterns are parameters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def part_lines(parts: DataFrame, text: str, key: str = "doc_id", part: str = "slide") -> DataFrame:
    """key, part, line_no, line (trimmed) of every line."""
    return parts.select(key, part, F.posexplode(F.split(text, "\n")).alias("line_no", "line")).withColumn("line", F.trim("line"))


def activities(parts: DataFrame, trigger: str, skip: str, noted: str, key: str = "doc_id", least: int = 25, least_note: int = 40) -> DataFrame:
    """key, priority, slide, line_no, line: lines of parts whose body matches trigger (0), then lines of notes that match `noted` (1); in this order."""
    body = part_lines(parts.where(F.lower("body").rlike(trigger)), "body", key).where((F.length("line") > least) & ~F.lower("line").rlike(skip)).withColumn("priority", F.lit(0))
    notes = part_lines(parts.where(F.lower("notes").rlike(noted)), "notes", key).where((F.length("line") > least_note) & F.lower("line").rlike(noted)).withColumn("priority", F.lit(1))
    return body.unionByName(notes).select(key, "priority", "slide", "line_no", "line")


def topic_lines(parts: DataFrame, skip: str, words: DataFrame | None = None, after: int = 0, key: str = "doc_id") -> DataFrame:
    """key, topic: lines that look like headings (2 to 8 words, 8 to 70 characters, an initial capital, no closing mark, no colon), each once; and words
    (key_word, small by its nature) that occur in the text and in none of its topics, in title case."""
    rows = part_lines(parts.where(F.col("slide") > after), "body", key)
    n = F.size(F.split("line", " +"))
    shape = F.length("line").between(8, 70) & n.between(2, 8) & F.col("line").rlike(r"^\p{Lu}") & ~F.col("line").rlike(r"[.,?]$") & ~F.contains("line", F.lit(":")) & ~F.lower("line").rlike(skip)
    topics = rows.where(shape).select(key, F.col("line").alias("topic")).distinct()
    if words is None:
        return topics
    listed = topics.groupBy(key).agg(F.lower(F.array_join(F.collect_list("topic"), "\n")).alias("have"))
    text = parts.groupBy(key).agg(F.lower(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("slide", "body"))), lambda x: x["body"]), " ")).alias("all_text")).join(listed, key, "left")
    given = words.agg(F.array_sort(F.collect_set("key_word")).alias("given")).select("given").scalar()
    extra = text.withColumn("given", given).select(key, F.explode(F.filter("given", lambda w: F.contains("all_text", F.lower(w)) & ~F.contains(F.coalesce("have", F.lit("")), F.lower(w)))).alias("w"))
    return topics.union(extra.select(key, F.initcap("w")))


def artifacts(text: Column, titled: str, bare: str, prefix: str) -> Column:
    """Titles after a mark (group 1 of titled) under one prefix, then whole matches of bare that none of them holds; compared without case, first ones win."""
    named = F.transform(F.regexp_extract_all(text, F.lit(titled), F.lit(1)), lambda x: F.concat(F.lit(prefix), F.trim(x)))
    found = F.concat(named, F.transform(F.regexp_extract_all(text, F.lit(bare), F.lit(0)), lambda x: F.trim(x)))
    zero = F.array().cast("array<string>")
    return F.aggregate(found, zero, lambda acc, x: F.when((x == "") | F.exists(acc, lambda y: F.contains(F.lower(y), F.lower(x))), acc).otherwise(F.concat(acc, F.array(x))))


def signals(text: Column, levels: list[str], codes: str, statement: str) -> Column:
    """`level: rest` for every level, codes, then lines that are statements; each once, in this order."""
    tiers = [F.transform(F.regexp_extract_all(text, F.lit(rf"(?i){level}\s*[:–\-]\s*([^\n]+)"), F.lit(1)), lambda m, level=level: F.concat(F.lit(f"{level}: "), F.trim(m))) for level in levels]
    quiz = F.transform(F.regexp_extract_all(text, F.lit(codes), F.lit(0)), lambda x: F.trim(x))
    said = F.filter(F.transform(F.split(text, "\n"), lambda x: F.trim(x)), lambda x: F.lower(x).rlike(statement))
    return F.filter(F.array_distinct(F.concat(*tiers, quiz, said)), lambda x: x != "")


def objectives(parts: DataFrame, heading: str, noise: str, key: str = "doc_id") -> DataFrame:
    """key, side, objectives: around the first line of a part that matches heading, the lines after it or, where more lines count there, those before it; title lines join the line that follows.

    A line counts from 10 characters on, unless it matches noise; a title has less than 60, an initial capital and no full stop.
    """
    rows = part_lines(parts, "body", key)
    w = Window.partitionBy(key, "slide").orderBy("line_no")
    whole = Window.partitionBy(key, "slide")
    at = F.min(F.when(F.lower("line").rlike(heading), F.col("line_no"))).over(whole)
    rows = rows.withColumn("at", at).where("at is not null and line_no <> at").withColumn("line", F.regexp_replace("line", r"^[\d.)\-•*]+ *", ""))
    rows = rows.where((F.length("line") >= 10) & ~F.lower("line").rlike(noise)).withColumn("side", F.when(F.col("line_no") > F.col("at"), "after").otherwise("before"))
    title = (F.length("line") < 60) & F.col("line").rlike(r"^\p{Lu}") & ~F.endswith("line", F.lit(".")) & (F.col("side") == "after")
    marked = rows.withColumn("title", title).withColumn("held", F.coalesce(F.lag("title").over(w) & (F.lag("side").over(w) == "after"), F.lit(False)))
    joined = F.when(F.col("held") & ~F.col("title"), F.concat(F.lag("line").over(w), F.lit(": "), "line")).otherwise(F.col("line"))
    follows = F.lead(~F.col("title")).over(w) & (F.lead("side").over(w) == "after")
    marked = marked.withColumns({"text": joined, "used": F.col("title") & F.coalesce(follows, F.lit(False))}).where("not used")
    sides = marked.groupBy(key, "slide").agg(*[F.array_sort(F.collect_list(F.when(F.col("side") == s, F.struct("line_no", "text")))).alias(s) for s in ("after", "before")])
    more = F.size("after") >= F.size("before")
    chosen = F.when(more, F.col("after")).otherwise(F.col("before"))
    return sides.select(key, "slide", F.when(more, "after").otherwise("before").alias("side"), F.transform(chosen, lambda x: x["text"]).alias("objectives")).where("size(objectives) > 0")


def section_fields(sections: DataFrame, rules: dict[str, str], key: str = "doc_id") -> DataFrame:
    """key, field, value: the bodies of sections whose heading matches a field's pattern, joined in heading order; headings that no rule takes are field `remaining`."""
    h = F.lower("heading")
    hits = F.array_compact(F.array(*[F.when(h.rlike(p), F.lit(f)) for f, p in rules.items()]))
    field = F.when((F.col("heading") == "_preamble") | (F.size(hits) == 0), F.array(F.lit("remaining"))).otherwise(hits)
    rows = sections.where(F.trim("body") != "").select(key, F.explode(field).alias("field"), "heading", "body")
    return rows.groupBy(key, "field").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("heading", "body"))), lambda x: x["body"]), " ").alias("value"))


def label_values(text: Column, labels: dict[str, str]) -> list[Column]:
    """Columns of what stands after each label, up to the end of the line; null where it isn't."""
    return [F.nullif(F.trim(F.regexp_extract(text, rf"{label}:\s*([^\n]+)", 1)), F.lit("")).alias(name) for name, label in labels.items()]


def alignments(text: Column, prefixes: list[str]) -> Column:
    """Array of (framework, text): every line from the first framework name in it on, each once."""
    hit = "(" + "|".join(prefixes) + ")"
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(hit))
    return F.array_distinct(F.transform(lines, lambda x: F.struct(F.regexp_extract(x, hit, 1).alias("framework"), F.trim(F.regexp_extract(x, rf"({'|'.join(prefixes)}).*", 0)).alias("text"))))


def purpose(text: Column, most: int = 500) -> Column:
    """The first line of 40 characters or more that is neither a heading nor a table row; empty if there is none."""
    lines = F.filter(F.transform(F.split(text, "\n"), lambda x: F.trim(x)), lambda x: (F.length(x) >= 40) & ~x.rlike(r"^[|#]"))
    return F.substring(F.coalesce(F.try_element_at(lines, F.lit(1)), F.lit("")), 1, most)


def skills_and_criteria(text: Column, skill: str, criterion: str, most: int = 10) -> list[Column]:
    """Bullet items of ten characters or more that match skill, and of the others those that match criterion; at most `most` each, as the records show them."""
    items = F.filter(F.transform(F.filter(F.split(text, "\n"), lambda x: x.rlike(r"^ *[-•*]")), lambda x: F.trim(F.regexp_replace(x, r"^ *[-•*]+", ""))), lambda x: F.length(x) >= 10)
    is_skill = lambda x: F.lower(x).rlike(skill)
    return [F.slice(F.filter(items, is_skill), 1, most).alias("skills"), F.slice(F.filter(items, lambda x: ~is_skill(x) & F.lower(x).rlike(criterion)), 1, most).alias("criteria")]


def flattened_text(blocks: Column) -> Column:
    """One text of an array of (kind, text, rows): paragraphs as they are, rows with their cells between bars, line by line."""
    return F.array_join(F.flatten(F.transform(blocks, lambda b: F.when(b["kind"] == "table", F.transform(b["rows"], lambda r: F.array_join(r, " | "))).otherwise(F.array(b["text"])))), "\n")


def contained_key(items: DataFrame, manifest: DataFrame, path: str = "path") -> DataFrame:
    """KEY10, JN19: item and the first manifest row (stem, ord; small by its nature, in blocks beyond that) whose stem the item's path holds."""
    from .reconcile import contained

    hay = items.select(F.col("item").alias("hay_id"), F.lower(path).alias("norm"))
    pairs = contained(manifest.select(F.struct("ord", "stem").alias("needle_id"), F.lower("stem").alias("norm")), hay)
    return pairs.groupBy(F.col("hay_id").alias("item")).agg(F.min("needle_id").alias("x")).select("item", F.col("x.stem").alias("stem"))


def key_of_range(keys: DataFrame, key: str, weeks: dict[int, list[int]]) -> DataFrame:
    """KEY11: the week of each key, by the exploded week map."""
    rows = [(w, k) for w, ks in weeks.items() for k in ks]
    table = keys.sparkSession.createDataFrame(rows, f"week int, {key} int")
    return keys.join(table, key, "left")


def batch_keys(batches: DataFrame, pattern: str, fixed: dict[str, list[int]]) -> DataFrame:
    """KEY12: (batch, key): the number in a batch's name, or the keys of a named batch; each once."""
    own = F.nullif(F.regexp_extract("batch", pattern, 1), F.lit("")).cast("int")
    named = F.create_map(*[x for k, v in fixed.items() for x in (F.lit(k), F.array(*map(F.lit, v)))]) if fixed else F.lit(None)
    keys = F.coalesce(F.try_element_at(named, F.col("batch")) if fixed else F.lit(None).cast("array<int>"), F.when(own.isNotNull(), F.array(own)), F.array().cast("array<int>"))
    return batches.select("batch", F.explode(keys).alias("key")).distinct()


def texts_per_key(items: DataFrame, keys: DataFrame, key: str = "key") -> DataFrame:
    """KEY12b: items (item, text) embedded in every key that a map (item, key) gives them, in item order."""
    return items.join(keys, "item").groupBy(key).agg(F.array_sort(F.collect_list(F.struct("item", "text"))).alias("items"))


def repair_shift(df: DataFrame, a: str, b: str, looks: str) -> DataFrame:
    """KEY16: a value of b that looks like one of a moves to a where a is empty."""
    empty = F.coalesce(F.trim(a), F.lit("")) == ""
    moves = empty & F.coalesce(F.col(b).rlike(looks), F.lit(False))
    return df.withColumns({a: F.when(moves, F.col(b)).otherwise(F.col(a)), b: F.when(moves, F.lit("")).otherwise(F.col(b))})


def squeezed(name: Column) -> Column:
    return F.regexp_replace(F.lower(name), "[ _-]", "")


def prefix_match(names: DataFrame, files: DataFrame, n: int = 20) -> DataFrame:
    """JN20: name and the first file whose squeezed stem begins, in n characters, inside the squeezed name, or the other way round."""
    from .reconcile import contained

    a, b = names.select("name", squeezed(F.col("name")).alias("s")), files.select("ord", "file", squeezed(F.regexp_replace("file", r"\.\w+$", "")).alias("s"))
    cut = F.substring("s", 1, n)
    one = contained(a.select(F.struct("name").alias("needle_id"), cut.alias("norm")), b.select(F.struct("ord", "file").alias("hay_id"), F.col("s").alias("norm"))).select(F.col("needle_id.name").alias("name"), F.col("hay_id").alias("x"))
    two = contained(b.select(F.struct("ord", "file").alias("needle_id"), cut.alias("norm")), a.select(F.struct("name").alias("hay_id"), F.col("s").alias("norm"))).select(F.col("hay_id.name").alias("name"), F.col("needle_id").alias("x"))
    return one.union(two).groupBy("name").agg(F.min("x").alias("x")).select("name", F.col("x.file").alias("file"))


def by_either_id(wanted: DataFrame, rows: DataFrame, first: str, second: str) -> DataFrame:
    """JN21: wanted ids with the first row (ord) that has the id in either column."""
    ids = rows.select("ord", F.explode(F.array_distinct(F.array(first, second))).alias("id")).where("id is not null").groupBy("id").agg(F.min("ord").alias("ord"))
    return wanted.join(ids, "id", "left").select("id", "ord")


def filled_in(base: DataFrame, native: DataFrame, keys: list[str], order: str) -> DataFrame:
    """JN23: the base rows, and of native the first row of each key that base lacks."""
    from .dedup import first_wins

    return base.unionByName(first_wins(native.join(base.select(*keys).distinct(), keys, "left_anti"), keys, [order]))


def strings_of(docs: DataFrame, json: str, key: str) -> DataFrame:
    """JN15: the distinct strings of a JSON column's top level, numbers and nested values as their text; invalid JSON has none."""
    kv = F.from_json(json, "map<string,string>")
    return docs.select(key, F.explode(F.map_values(kv)).alias("value")).where(F.trim("value") != "").distinct()


def compiled_batches(results: DataFrame, batches: DataFrame) -> tuple[DataFrame, DataFrame]:
    """WN15, WN15b: results (batch, source, value) gathered by source in batch order, and the ledger of batches: completed or pending, with their results."""
    by_source = results.groupBy("source").agg(F.transform(F.array_sort(F.collect_list(F.struct("batch", "value"))), lambda x: x["value"]).alias("values"))
    done = results.groupBy("batch").agg(F.count("*").alias("n"))
    ledger = batches.join(done, "batch", "left").select("batch", F.when(F.col("n").isNull(), "pending").otherwise("completed").alias("status"), F.coalesce("n", F.lit(0)).alias("results"))
    return by_source, ledger


def united_links(*sources: DataFrame) -> DataFrame:
    """SET1, SET2: all link rows with the columns of any source, every url once over all sources: the first by source number and order."""
    from .dedup import first_wins

    out = None
    for i, s in enumerate(sources):
        one = s.withColumn("source_no", F.lit(i))
        out = one if out is None else out.unionByName(one, allowMissingColumns=True)
    return first_wins(out, ["url"], ["source_no", "ord"])


def merged_resources(first: Column, second: Column) -> Column:
    """SET6: both lists in order without items that an item before them holds."""
    from .dedup import unsuppressed

    none = F.array().cast("array<string>")
    return unsuppressed(F.concat(F.coalesce(first, none), F.coalesce(second, none)))


def evidence(groups: DataFrame, texts: DataFrame, keys: list[str], most: int) -> DataFrame:
    """FN41: for each key the ordered texts as one, cut after `most` characters (as the pack shows it), and how many there are.

    Each text takes a character at least, with the line end after it, so the first most + 1 of a key are enough, and of these the ones that begin within the cut:
    only they are gathered. Ranks are cut in every task before rows travel.
    """
    from pyspark.sql.window import Window

    from .rollup import top_n

    n = texts.groupBy(*keys).agg(F.count("*").alias("n"))
    cut = top_n(texts.select(*keys, "ord", F.substring("text", 1, most).alias("text"), F.length("text").alias("size")), keys, [F.col("ord"), F.col("text")], most + 1)
    before = F.sum(F.coalesce("size", F.lit(0)) + 1).over(Window.partitionBy(*keys).orderBy("rank").rowsBetween(Window.unboundedPreceding, -1))
    shown = cut.withColumn("before", F.coalesce(before, F.lit(0))).where(F.col("before") < most)
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "text"))), lambda x: x["text"]), "\n")
    packs = shown.groupBy(*keys).agg(F.substring(joined, 1, most).alias("evidence"))
    wanted = groups.select(*keys).distinct()
    return wanted.join(n, keys, "left").join(packs, keys, "left").select(*keys, F.coalesce("n", F.lit(0)).cast("int").alias("n"), F.coalesce("evidence", F.lit("")).alias("evidence"))


def field(df: DataFrame, path: str) -> Column:
    """FN42: a column by its dotted path; null where the schema lacks it."""
    from pyspark.sql.types import StructType

    kind = df.schema
    for name in path.split("."):
        if not isinstance(kind, StructType) or name not in kind.names:
            return F.lit(None).cast("string")
        kind = kind[name].dataType
    return F.col(".".join(f"`{p}`" for p in path.split(".")))


def explained(checks: DataFrame) -> DataFrame:
    """FN47: a sentence for each check row."""
    share = F.when(F.col("total") > 0, F.round(100 * F.col("failures") / F.col("total"), 1)).otherwise(0.0)
    text = F.when(F.col("passed"), F.format_string("%s passed on %d rows", "check_id", "total")).otherwise(F.format_string("%s failed on %d of %d rows", "check_id", "failures", "total"))
    return checks.select("check_id", "passed", share.alias("percent"), text.alias("text"))
