"""Rule tables: ordered keyword rules, key extraction from paths, change categories. Rules are parameters, not code."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


#: How paths write one key, a range of keys, and a week; {} is the key word.
ONE_KEY, KEY_RANGE, WEEK = r"{}[_\s\-]*(\d{{1,2}})", r"{}s?\s*(\d{{1,2}})\s*[-–]\s*(\d{{1,2}})", r"week[_\s\-]*(\d)"


@dataclass(frozen=True)
class KeyRules:
    """How a path names its group and its sub-keys: group folders and words, the sub-key word, most sub-keys of a group, and the week map."""

    folders: dict[str, int]
    words: dict[str, int]
    key_word: str
    most: dict[int, int]
    weeks: dict[int, list[int]]
    default_most: int = 24


def first_match(text: Column, rules: list[tuple[str, str]], default: str | None = None) -> Column:
    """The value of the first rule whose words occur in the lower-cased text; rules are (words split by |, value)."""
    t, out = F.lower(text), F.lit(default)
    for words, value in reversed(rules):
        hit = F.lit(False)
        for w in words.split("|"):
            hit = hit | F.contains(t, F.lit(w))
        out = F.when(hit, F.lit(value)).otherwise(out)
    return out


def classify(text: Column, skip: str | None, rules: list[tuple[str, str]]) -> Column:
    """A veto pattern, then the first pattern that matches; null if none does."""
    t, out = F.lower(text), F.lit(None).cast("string")
    for pattern, value in reversed(rules):
        out = F.when(t.rlike(pattern), F.lit(value)).otherwise(out)
    return F.when(t.rlike(skip), F.lit(None).cast("string")).otherwise(out) if skip else out


def group_of(path: Column, rules: KeyRules) -> Column:
    """The group of a path: a folder at its start or inside it, then words anywhere; null if none."""
    p = F.replace(F.lower(path), F.lit("\\"), F.lit("/"))
    out = F.lit(None).cast("int")
    for word, g in reversed(rules.words.items()):
        out = F.when(F.contains(p, F.lit(word)), F.lit(g)).otherwise(out)
    for folder, g in reversed(rules.folders.items()):
        out = F.when(p.startswith(f"{folder}/") | F.contains(p, F.lit(f"/{folder}/")), F.lit(g)).otherwise(out)
    return out


def keys_of(path: Column, group: Column, rules: KeyRules) -> Column:
    """Sub-keys of a path as an array: one number, else a range, else a week's keys, else none. Numbers out of range fall through."""
    p = F.lower(path)
    most = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in rules.most.items() for x in kv]), group), F.lit(rules.default_most))
    number = lambda pattern, i: F.nullif(F.regexp_extract(p, pattern, i), F.lit("")).cast("int")
    one, span = number(ONE_KEY.format(rules.key_word), 1), KEY_RANGE.format(rules.key_word)
    low, high, week = number(span, 1), number(span, 2), number(WEEK, 1)
    inside = lambda x: x.between(1, most)
    weeks = F.create_map(*[x for k, v in rules.weeks.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    none = F.array().cast("array<int>")
    span_keys = F.when(inside(low) & inside(high) & (low <= high), F.sequence(low, F.greatest(low, high)))
    return F.coalesce(F.when(inside(one), F.array(one)), span_keys, F.element_at(weeks, week), none)


def collapse_wide(keys: Column, most: int = 3) -> Column:
    """Many keys or none count as the single null key."""
    return F.when(F.size(keys).between(1, most), keys).otherwise(F.array(F.lit(None).cast("int")))


def change_category(change: Column, name: Column, native: Column, extensions: dict[str, str]) -> Column:
    """Category of a change: deletions, native documents, then by extension; metadata-only changes need no work."""
    ext = F.lower(F.regexp_extract(name, r"\.(\w+)$", 1))
    by_ext = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in extensions.items() for x in kv]), ext), F.lit("other"))
    return F.when(change == "UNCHANGED", "none").when(change == "DELETED", "deleted").when(change.isin("RENAMED", "METADATA_CHANGED"), "metadata").when(native, "native").otherwise(by_ext)
