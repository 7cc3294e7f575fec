"""Records of template files: kind by name and path, then purpose, skills and criteria from the lines of their contents."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rules import classify, first_match
from ..functions.text import slug
from .rollup import top_n

# Words that mark a bullet as a skill or as a criterion, and words of levels that mark a table's cell as a criterion.
SKILLS = ("skill", "able to", "demonstrate", "create", "design", "develop", "build", "communicate", "collaborate", "iterate")
CRITERIA = ("criteria", "must", "should", "evidence", "grade", "mark", "score", "level", "band", "rubric", "submit")
LEVELS = ("basic", "intermediate", "advanced", "emerging", "proficient")


@dataclass(frozen=True)
class Plan:
    """kinds: (pattern, component) in priority; skip: a pattern that vetoes. components: component -> (weight, label). terms: (words split by |, term); lessons: term -> how many."""

    kinds: tuple[tuple[str, str], ...]
    components: dict[str, tuple[int, str]]
    skip: str | None = None
    terms: tuple[tuple[str, str], ...] = ()
    lessons: tuple[tuple[int, int], ...] = ()
    purpose: str = "{label} template"
    skills: tuple[str, ...] = SKILLS
    criteria: tuple[str, ...] = CRITERIA
    levels: tuple[str, ...] = LEVELS
    most: int = 10


def _bare(text: Column) -> Column:
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def _has(text: Column, words: tuple[str, ...]) -> Column:
    return F.lower(text).rlike("|".join(map(re.escape, words)))


def found(parts: DataFrame, plan: Plan) -> DataFrame:
    """(file, field, at, value) of (file, source, ord, text): the first line of 40 characters that is neither heading nor table row, the skills, and the criteria from bullets and cells.

    Of a part at most `most` values of a field are handed on, so what leaves a task doesn't grow with the texts.
    """
    lines = F.transform(F.split(F.coalesce("text", F.lit("")), "\n"), lambda line, i: F.struct(i.alias("line"), F.lit(0).alias("cell"), _bare(line).alias("value")))
    plain = F.filter(lines, lambda x: ~x["value"].rlike(r"^[|#]") & (F.length(x["value"]) >= 40))
    first = F.transform(F.slice(plain, 1, 1), lambda x: F.struct(x["line"], x["cell"], F.substring(x["value"], 1, 500).alias("value")))
    bullets = F.transform(F.filter(lines, lambda x: x["value"].rlike("^[-•*]")), lambda x: F.struct(x["line"], x["cell"], _bare(F.regexp_replace(x["value"], "^[-•*]+", "")).alias("value")))
    bullets = F.filter(bullets, lambda x: F.length(x["value"]) >= 10)
    rows = F.filter(lines, lambda x: x["value"].startswith("|"))
    cells = F.flatten(F.transform(rows, lambda x: F.transform(F.split(F.regexp_replace(x["value"], r"^\|+|\|+$", ""), r"\|"), lambda c, i: F.struct(x["line"], i.alias("cell"), _bare(c).alias("value")))))
    skills = F.filter(bullets, lambda x: _has(x["value"], plan.skills))
    marks = F.filter(bullets, lambda x: ~_has(x["value"], plan.skills) & _has(x["value"], plan.criteria))
    levels = F.filter(cells, lambda x: (F.length(x["value"]) > 20) & _has(x["value"], plan.levels))
    each = {"purpose": first, "core_skills": F.slice(skills, 1, plan.most), "criteria": F.slice(F.array_sort(F.concat(marks, levels)), 1, plan.most)}
    fields = F.array(*[F.struct(F.lit(name).alias("field"), values.alias("found")) for name, values in each.items()])
    one = parts.select("file", "source", "ord", F.explode(fields).alias("x")).select("file", "source", "ord", "x.field", F.explode("x.found").alias("v"))
    return one.select("file", "field", F.struct("source", "ord", "v.line", "v.cell").alias("at"), "v.value")


def template_records(files: DataFrame, parts: DataFrame, plan: Plan) -> DataFrame:
    """A record for each file that a kind names, of files (file, name, path, link) and their contents (file, source, ord, text), read in the order of source and ord.

    Columns file, id, template_name, programme_component, purpose, weighting_percent, linked_lessons, core_skills, criteria, term, link. A file without contents has the
    kind's own purpose and no skills; null names and paths count as empty; without a link the path stands in; files of no kind have no record; equal lines all count.
    """
    name, path = F.coalesce("name", F.lit("")), F.coalesce("path", F.lit(""))
    chosen = files.select("file", name.alias("name"), path.alias("path"), "link").withColumn("component", classify(F.concat_ws(" ", "name", "path"), plan.skip, list(plan.kinds))).where("component IS NOT NULL")
    values = found(parts.join(chosen.select("file"), "file", "left_semi"), plan)
    few = top_n(values, ["file", "field"], [F.col("at")], plan.most)
    listed = lambda field: F.transform(F.array_sort(F.collect_list(F.when(F.col("field") == field, F.struct("rank", "value")))), lambda x: x["value"]).alias(field)
    got = few.groupBy("file").agg(*[listed(f) for f in ("purpose", "core_skills", "criteria")])
    stem = F.regexp_replace("name", r"^(.+)\.[^.]*$", "$1")
    term = first_match(F.col("path"), list(plan.terms)).cast("int") if plan.terms else F.lit(None).cast("int")
    label, weight, lessons, none = F.lit(None).cast("string"), F.lit(None).cast("int"), F.lit(0), F.array().cast("array<string>")
    for component, (w, text) in plan.components.items():
        label, weight = F.when(F.col("component") == component, text).otherwise(label), F.when(F.col("component") == component, w).otherwise(weight)
    for t, n in plan.lessons:
        lessons = F.when(F.col("term") == t, n).otherwise(lessons)
    before, after = plan.purpose.split("{label}")
    out = chosen.join(got, "file", "left").withColumn("term", term).withColumn("lessons", lessons)
    return out.select(
        "file", slug(stem).alias("id"), stem.alias("template_name"), F.col("component").alias("programme_component"),
        F.coalesce(F.get("purpose", F.lit(0)), F.concat(F.lit(before), label, F.lit(after))).alias("purpose"), weight.alias("weighting_percent"),
        F.when(F.col("lessons") > 0, F.transform(F.sequence(F.lit(1), F.greatest("lessons", F.lit(1))), lambda i: F.concat(F.lit("Lesson "), i.cast("string")))).otherwise(none).alias("linked_lessons"),
        F.coalesce("core_skills", none).alias("core_skills"), F.coalesce("criteria", none).alias("criteria"), "term", F.coalesce(F.nullif("link", F.lit("")), F.col("path")).alias("link"),
    )
