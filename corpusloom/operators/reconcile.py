"""Reconciling source atoms with output atoms: a cascade of joins, each on what the last one left over, and attribution of losses.

Atoms are rows (atom_id, atom_type, content, term, lesson, ord). Every tier returns (atom_id, target_id, tier, confidence).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import fingerprint, is_label, norm
from ..session import checkpointed
from .checks import row
from .needles import anchor_hits, anchored, occurrences


def prepared(atoms: DataFrame) -> DataFrame:
    return atoms.withColumns({"norm": norm(F.col("content")), "print": fingerprint(F.col("content"))})


def _best(pairs: DataFrame, tier: str, confidence) -> DataFrame:
    """One target for each atom: same key first, then the atom's own type, then the target's order. A minimum, so hot atoms are reduced before the shuffle."""
    best = pairs.groupBy("atom_id").agg(F.min(F.struct((~F.col("same_key")).alias("other"), "alien", "t_ord", "target_id")).alias("x"))
    return best.select("atom_id", F.col("x.target_id").alias("target_id"), F.lit(tier).alias("tier"), confidence(~F.col("x.other")).alias("confidence"))


def _sides(source: DataFrame, target: DataFrame):
    s = source.select("atom_id", F.col("atom_type").alias("s_type"), F.col("norm").alias("s_norm"), F.col("print").alias("s_print"), F.col("term").alias("s_term"), F.col("lesson").alias("s_lesson"))
    t = target.select(F.col("atom_id").alias("target_id"), F.col("atom_type").alias("t_type"), F.col("norm").alias("t_norm"), F.col("print").alias("t_print"), F.col("term").alias("t_term"), F.col("lesson").alias("t_lesson"), F.col("ord").alias("t_ord"))
    return s, t


def match_exact(source: DataFrame, target: DataFrame) -> DataFrame:
    """Equal fingerprints, whatever the types; a target of the same term and lesson is preferred, then the first. Both sides are
    reduced to one target per (print, term, lesson) before the join, so copies don't multiply."""
    s, t = _sides(source, target)
    by_key = t.groupBy("t_print", "t_term", "t_lesson").agg(F.min(F.struct("t_ord", "target_id")).alias("x"))
    by_all = t.groupBy("t_print").agg(F.min(F.struct("t_ord", "target_id")).alias("y"))
    near = F.col("s_print") == F.col("t_print")
    same = s.join(by_key, near & F.col("s_term").eqNullSafe(F.col("t_term")) & F.col("s_lesson").eqNullSafe(F.col("t_lesson"))).select("atom_id", "x")
    found = s.join(by_all, near).select("atom_id", "y").join(same, "atom_id", "left")
    return found.select("atom_id", F.coalesce("x.target_id", "y.target_id").alias("target_id"), F.lit("exact").alias("tier"), F.lit(1.0).alias("confidence"))


def contained(needles: DataFrame, haystacks: DataFrame, anchor_words: int = 4) -> DataFrame:
    """(needle_id, hay_id) where the needle's normalised words occur in the haystack's text, as a string.

    A needle of at least anchor_words + 2 words meets haystacks on the hash of its inner words (whole words inside the needle are whole
    words of any text that contains it), the one of least hash, and found pairs are verified on the strings. Only hashes of a haystack that
    fall on a bit of the anchors' bitmap travel, however many anchors there are. Shorter needles, which any text may hold inside a word,
    are searched by an automaton in one pass of the texts.
    """
    n = needles.select("needle_id", F.col("norm").alias("needle")).where(F.length("needle") > 0)
    h = haystacks.select("hay_id", F.col("norm").alias("hay"))
    of = checkpointed(anchored(n, anchor_words))
    long, short = of.where("anchor is not null").select("needle_id", "anchor"), of.where("anchor is null").select("needle_id", F.col("short").alias("needle"))
    hits = occurrences(h, short).join(short, "needle").select("needle_id", "hay_id")
    if long.isEmpty():
        return hits.distinct()
    met = anchor_hits(h, long, anchor_words).join(long, "anchor").select("needle_id", "hay_id")
    found = met.join(n, "needle_id").join(h, "hay_id").where(F.contains("hay", F.col("needle"))).select("needle_id", "hay_id")
    return found.union(hits).distinct()


def holding(s: DataFrame, t: DataFrame, both_ways: bool = True) -> DataFrame:
    """(s_norm, t_norm), each once, where the target's norm holds the source's; both_ways: or the source's the target's. Copies of a norm are searched once, under numbers, so that no text is copied for each of its grams."""
    numbered = lambda df, name: checkpointed(df.select(F.col(name).alias("norm")).distinct().withColumn("id", F.monotonically_increasing_id()))
    one, two = numbered(s, "s_norm"), numbered(t, "t_norm")
    sides = lambda a, b: contained(a.select(F.col("id").alias("needle_id"), "norm"), b.select(F.col("id").alias("hay_id"), "norm"))
    out = sides(one, two).select(F.col("needle_id").alias("s_id"), F.col("hay_id").alias("t_id"))
    if both_ways:
        out = out.union(sides(two, one).select(F.col("hay_id").alias("s_id"), F.col("needle_id").alias("t_id"))).distinct()
    named = lambda df, side: df.select(F.col("id").alias(f"{side}_id"), F.col("norm").alias(f"{side}_norm"))
    return out.join(named(one, "s"), "s_id").join(named(two, "t"), "t_id").select("s_norm", "t_norm")


def _held_targets(s: DataFrame, t: DataFrame, both_ways: bool = True) -> DataFrame:
    """(s_norm, t_type, t_term) with the first target of that type and term whose norm holds the source's (or the other way): targets are reduced before they meet atoms."""
    first = F.min(F.struct("t_ord", "target_id")).alias("x")
    met = holding(s, t, both_ways).join(t.groupBy("t_norm", "t_type", "t_term").agg(first), "t_norm")
    return met.groupBy("s_norm", "t_type", "t_term").agg(F.min("x").alias("x")).select("s_norm", "t_type", "t_term", "x.t_ord", "x.target_id")


def same_kind(s_type: str = "s_type", t_type: str = "t_type"):
    """Types that are compared: equal ones, and notes also with text blocks."""
    return (F.col(s_type) == F.col(t_type)) | ((F.col(s_type) == "speaker_note") & (F.col(t_type) == "text_block"))


def match_contains(source: DataFrame, target: DataFrame, least: int = 0) -> DataFrame:
    """One norm inside the other, of one type (notes also against text blocks): same term first (0.9; no term equals no term), any term next (0.85).

    Sources have ten characters or more, tables five; least: shortest target that counts.
    """
    s, t = _sides(source, target)
    s = s.where(F.length("s_norm") >= F.when(F.col("s_type") == "table", 5).otherwise(10))
    t = t.where(F.length("t_norm") >= max(1, least))
    pairs = s.join(_held_targets(s, t), "s_norm").where(same_kind())
    pairs = pairs.withColumns({"same_key": F.col("s_term").eqNullSafe(F.col("t_term")), "alien": F.col("s_type") != F.col("t_type")})
    return _best(pairs, "contains", lambda same: F.when(same, 0.9).otherwise(0.85))


def match_cross_source(source: DataFrame, target: DataFrame, least: int = 15) -> DataFrame:
    """Texts and notes of 15 characters or more against all texts and notes of the same term, texts first, one norm inside the other."""
    text = ("text_block", "speaker_note")
    s, t = _sides(source.where(F.col("atom_type").isin(*text)), target.where(F.col("atom_type").isin(*text)))
    s = s.where(F.length("s_norm") >= least)
    pairs = s.join(_held_targets(s, t.where("length(t_norm) > 0")), "s_norm").where(F.col("s_term").eqNullSafe(F.col("t_term")))
    return _best(pairs.withColumns({"same_key": F.lit(True), "alien": F.col("t_type") != "text_block"}), "cross_source", lambda same: F.lit(0.85))


def match_table_cell(source: DataFrame, target: DataFrame, least: int = 10) -> DataFrame:
    """Table cells of ten characters or more inside the whole text of a table of the same term."""
    s, t = _sides(source.where("atom_type = 'table'"), target.where("atom_type = 'table'"))
    s = s.where(F.length("s_norm") >= least)
    pairs = s.join(_held_targets(s, t, False), "s_norm").where(F.col("s_term").eqNullSafe(F.col("t_term")))
    return _best(pairs.withColumns({"same_key": F.lit(True), "alien": F.lit(False)}), "table_cell", lambda same: F.lit(0.85))


def url_key(url, scheme: bool = True):
    u = F.regexp_replace(F.lower(F.trim(url)), "/+$", "")
    return u if scheme else F.regexp_replace(u, "^[a-z]+://(www\\.)?", "")


def match_url(source: DataFrame, target: DataFrame) -> DataFrame:
    """Links equal but for case and closing slash, then but for the scheme."""
    out = None
    for tier, scheme, confidence in (("url", True, 1.0), ("url_loose", False, 0.95)):
        s = source.select("atom_id", url_key(F.col("content"), scheme).alias("u"))
        t = target.select(F.col("atom_id").alias("target_id"), url_key(F.col("content"), scheme).alias("u"), F.col("ord").alias("t_ord")).groupBy("u").agg(F.min(F.struct("t_ord", "target_id")).alias("x"))
        hit = (s if out is None else s.join(out, "atom_id", "left_anti")).join(t, "u").select("atom_id", F.col("x.target_id").alias("target_id"), F.lit(tier).alias("tier"), F.lit(confidence).alias("confidence"))
        out = hit if out is None else out.unionByName(hit)
    return out


def match_url_in_text(source: DataFrame, target: DataFrame) -> DataFrame:
    """Links and video links that occur inside a text block; the first one that holds them."""
    links = source.where(F.col("atom_type").isin("link", "video_url")).select("atom_id", url_key(F.col("content")).alias("url"))
    t = target.where("atom_type = 'text_block'").groupBy("norm").agg(F.min(F.struct(F.col("ord").alias("t_ord"), F.col("atom_id").alias("target_id"))).alias("x"))
    hits = contained(links.select(F.col("url").alias("needle_id"), F.col("url").alias("norm")).distinct(), t.select(F.col("x").alias("hay_id"), "norm"))
    first = hits.groupBy(F.col("needle_id").alias("url")).agg(F.min("hay_id").alias("x"))
    return links.join(first, "url").select("atom_id", F.col("x.target_id").alias("target_id"), F.lit("url_in_text").alias("tier"), F.lit(0.8).alias("confidence"))


def _at(slides: str):
    return F.array_join(F.array_sort(slides), ",")


def match_image(source: DataFrame, target: DataFrame, exact: float = 1.0, near: float = 0.85) -> DataFrame:
    """Images with columns stem, slides, term, lesson: equal stem and slides, else the same key and a slide in common."""
    told = lambda df: df.where((F.col("stem") != "") & (F.size("slides") > 0))
    same = told(source).select("atom_id", "stem", _at("slides").alias("at")).join(told(target).select(F.col("atom_id").alias("target_id"), "stem", _at("slides").alias("at")), ["stem", "at"]).groupBy("atom_id").agg(F.min("target_id").alias("target_id"))
    same = same.select("atom_id", "target_id", F.lit("image").alias("tier"), F.lit(exact).alias("confidence"))
    rest = source.join(same, "atom_id", "left_anti").select("atom_id", "term", "lesson", F.explode(F.array_distinct("slides")).alias("slide"))
    held = target.select(F.col("atom_id").alias("target_id"), "term", "lesson", F.explode("slides").alias("slide")).groupBy("term", "lesson", "slide").agg(F.min("target_id").alias("target_id"))
    lap = rest.join(held, ["term", "lesson", "slide"]).groupBy("atom_id").agg(F.min("target_id").alias("target_id"))
    return same.unionByName(lap.select("atom_id", "target_id", F.lit("image_slides").alias("tier"), F.lit(near).alias("confidence")))


def match_image_ref(source: DataFrame, target: DataFrame) -> DataFrame:
    """Image references: equal urls (case and outer blanks aside), then as images with confidence 0.95 and 0.85."""
    url = F.lower(F.trim("content"))
    t = target.where(url != "").groupBy(url.alias("u")).agg(F.min("atom_id").alias("target_id"))
    same = source.select("atom_id", url.alias("u")).join(t, "u").select("atom_id", "target_id", F.lit("image_url").alias("tier"), F.lit(1.0).alias("confidence"))
    return same.unionByName(match_image(source.join(same, "atom_id", "left_anti"), target, 0.95))


def reconcile(source: DataFrame, target: DataFrame, least: int = 0, labels: tuple[list[str], str] = ([], "a^"), fuzzy=None) -> DataFrame:
    """Every source atom with its class: trivial, structural (labels: words and a pattern, see is_label), matched (tier, target, confidence) or unmatched.

    Tiers, each on what the last left over: exact, contains, fuzzy (a function of both sides, if given), url, url in text, image references (atoms with stem and
    slides), cross-source, table cells, images. A tier whose types one side lacks is left out. The lineage is cut between tiers.
    """
    s, t = checkpointed(prepared(source)), checkpointed(prepared(target))
    trivial = F.length("norm") < 5
    structural = ((F.col("atom_type") == "text_block") & is_label(F.col("content"), *labels)) | ((F.col("atom_type") == "image") & F.contains(F.coalesce("location", F.lit("")), F.lit("unknown_slide")) if "location" in s.columns else F.lit(False))
    left, found = s.where(~trivial & ~structural), None
    of = lambda df, *kinds: df.where(F.col("atom_type").isin(*kinds))
    kinds, held = ({r[0] for r in df.select("atom_type").distinct().collect()} for df in (left, t))  # types of atoms are few by nature
    links, texts = {"link", "video_url"}, {"text_block", "speaker_note"}
    tiers = [match_exact, lambda a, b: match_contains(a, b, least)]
    if fuzzy:
        tiers.append(lambda a, b: fuzzy(of(a, "text_block", "speaker_note", "table").where(F.length("norm") >= 15), b))
    if kinds & links and held & links:
        tiers.append(lambda a, b: match_url(of(a, *links), of(b, *links)))
    if kinds & links and "text_block" in held:
        tiers.append(match_url_in_text)
    placed = {"stem", "slides"} <= {*s.columns} & {*t.columns}
    if placed and "image_ref" in kinds & held:
        tiers.append(lambda a, b: match_image_ref(of(a, "image_ref"), of(b, "image_ref")))
    if kinds & texts and held & texts:
        tiers.append(match_cross_source)
    if "table" in kinds & held:
        tiers.append(match_table_cell)
    if placed and "image" in kinds & held:
        tiers.append(lambda a, b: match_image(of(a, "image"), of(b, "image")))
    for tier in tiers:
        hit = checkpointed(tier(left, t).select("atom_id", "target_id", "tier", F.col("confidence").cast("double").alias("confidence")))
        found = hit if found is None else found.unionByName(hit)
        left = left.join(hit, "atom_id", "left_anti")
    out = s.join(found, "atom_id", "left")
    kind = F.when(trivial, "trivial").when(structural, "structural").when(F.col("tier").isNotNull(), "matched").otherwise("unmatched")
    return out.select("atom_id", "atom_type", "term", "lesson", kind.alias("class"), "tier", "target_id", "confidence")


def reconcile_checks(results: DataFrame, losses: DataFrame, truncated: DataFrame, target: DataFrame, new_files: DataFrame, stale_files: DataFrame) -> DataFrame:
    """V001 to V009 as check rows of layer 5: coverage of keyed atoms, links and notes, early losses of text, truncated fields, unmatched atoms without key,
    unconsumed sections, unclassified and stale files. results: with source_file; losses: atom_type, lost_at (a stage number); target: location."""
    keyed = F.col("term").isNotNull() & F.col("lesson").isNotNull()
    m, u, x = (F.col("class") == c for c in ("matched", "unmatched", "structural"))
    link, note = F.col("atom_type").isin("link", "video_url"), F.col("atom_type") == "speaker_note"
    n = {"k_bad": keyed & u, "k_all": keyed & (m | u | x), "l_bad": link & u, "l_all": link & (m | u), "n_bad": note & u, "n_all": note & (m | u)}
    sums = results.agg(*[F.count_if(c).alias(k) for k, c in n.items()], F.count_distinct(F.when(u & ~keyed, F.coalesce("source_file", F.lit("")))).alias("files"))
    of = lambda bad, total: sums.select(F.col(bad).alias("failures"), F.col(total).alias("total"))
    none = lambda df: df.agg(F.count("*").alias("failures"), F.count("*").alias("total"))
    early = losses.agg(F.count_if((F.col("atom_type") == "text_block") & F.col("lost_at").isin(1, 2)).alias("failures"), F.count("*").alias("total"))
    sections = target.agg(F.count_if(F.startswith(F.coalesce("location", F.lit("")), F.lit("remaining_content"))).alias("failures"), F.count("*").alias("total"))
    # coverage of nothing is 1 for keyed atoms and 0 for links and notes
    zero = lambda bad, total: sums.select(F.when(F.col(total) == 0, 1).otherwise(F.col(bad)).alias("failures"), F.greatest(F.col(total), F.lit(1)).alias("total"))
    parts = [
        row(of("k_bad", "k_all"), "V001", "ERROR", "keyed atoms are covered", 5, 0.05),
        row(zero("l_bad", "l_all"), "V002", "ERROR", "links are covered", 5, 0.1),
        row(early, "V003", "WARNING", "no text is lost early", 5),
        row(none(truncated), "V004", "WARNING", "no field is truncated", 5),
        row(sums.select(F.col("files").alias("failures"), F.col("files").alias("total")), "V005", "WARNING", "unmatched atoms have keys", 5),
        row(zero("n_bad", "n_all"), "V006", "INFO", "notes are covered", 5, 0.2),
        row(sections, "V007", "WARNING", "all sections are consumed", 5),
        row(none(new_files), "V008", "WARNING", "all files are classified", 5),
        row(none(stale_files), "V009", "WARNING", "no entry is stale", 5),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out


def coverage(results: DataFrame, *by: str) -> DataFrame:
    """(matched + structural) / (all - trivial) by any columns; 1 where nothing counts."""
    n = F.count_if(F.col("class") != "trivial")
    m = F.count_if(F.col("class").isin("matched", "structural"))
    return results.groupBy(*by).agg(F.count("*").alias("atoms"), m.alias("matched"), n.alias("counted")).withColumn("coverage", F.when(F.col("counted") == 0, 1.0).otherwise(F.col("matched") / F.col("counted")))


def attribute_loss(lost: DataFrame, stages: list[tuple[str, DataFrame]], key: str, default: str) -> DataFrame:
    """For each lost key the stage after the last one that still holds it: last_seen (null: none) and lost_at."""
    seen = lost.select(key).distinct()
    for i, (_, held) in enumerate(stages):
        seen = seen.join(held.select(key).distinct().withColumn(f"__s{i}", F.lit(i)), key, "left")
    names = F.array(*[F.lit(n) for n, _ in stages], F.lit("output"))
    last = F.greatest(*[F.col(f"__s{i}") for i in range(len(stages))], F.lit(None).cast("int"))
    return seen.select(key, F.when(last.isNotNull(), F.element_at(names, last + 1)).alias("last_seen"), F.when(last.isNull(), F.lit(default)).otherwise(F.element_at(names, F.coalesce(last, F.lit(0)) + 2)).alias("lost_at"))


def ordinal_zip(left: DataFrame, right: DataFrame, key: str, order: str, value: str) -> DataFrame:
    """The i-th row of left with the i-th of right, per key; the shorter side gives nulls."""
    from .dedup import numbered

    a = numbered(left, [key], [order], "i").select(key, "i", F.col(value).alias("a"))
    b = numbered(right, [key], [order], "i").select(key, "i", F.col(value).alias("b"))
    return a.join(b, [key, "i"], "full_outer")
