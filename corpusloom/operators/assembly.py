"""Records assembled from a declared plan of fields: which sources a field takes its values from, in which order, and how many."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .rollup import top_n


@dataclass(frozen=True)
class Field:
    """sources: (source, expression) in priority. kind: one (the first value), list (the first `most` different values), count (of different values).
    merge: values of all sources, one after the other; else those of the first source that has any."""

    name: str
    sources: tuple[tuple[str, str], ...]
    kind: str = "one"
    most: int = 1
    merge: bool = False


def values(sources: dict[str, DataFrame], fields: list[Field], key: str) -> DataFrame:
    """(key, field, source, ord, value): every filled value of every field, from one pass of each source. Expressions give a text or an array of texts; sources have key and ord."""
    out = None
    for name, df in sources.items():
        asked = [(f.name, place, expression) for f in fields for place, (source, expression) in enumerate(f.sources) if source == name]
        if not asked:
            continue
        listed = lambda e: F.coalesce(F.expr(e), F.array().cast("array<string>")) if df.select(F.expr(e)).dtypes[0][1].startswith("array") else F.array(F.expr(e).cast("string"))  # noqa: E731, B023
        each = F.array(*[F.struct(F.lit(f).alias("field"), F.lit(p).alias("source"), listed(e).alias("found")) for f, p, e in asked])
        rows = df.select(key, "ord", F.explode(each).alias("x")).select(key, "ord", "x.field", "x.source", F.posexplode("x.found").alias("place", "value"))
        rows = rows.select(key, "field", "source", F.struct("ord", "place").alias("ord"), F.trim("value").alias("value")).where("value <> ''")
        out = rows if out is None else out.unionByName(rows)
    return out


def assemble(keys: DataFrame, sources: dict[str, DataFrame], fields: list[Field], key: str = "key") -> DataFrame:
    """A record for each key: a text, an array of texts or a number for each field; null, an empty array or 0 where no source has a value.

    One plan whatever the number of fields and sources: all values in one long table, equal values of a field reduced to their first place, ranks cut in every task before
    rows travel, so that of a key only what the record shows is gathered. ord must be of one type in all sources.
    """
    different = values(sources, fields, key).groupBy(key, "field", "value").agg(F.min(F.struct("source", "ord")).alias("at"))
    counts = different.groupBy(key).agg(*[F.count_if((F.col("field") == f.name)).alias(f.name) for f in fields if f.kind == "count"]) if any(f.kind == "count" for f in fields) else None
    shown = [f for f in fields if f.kind != "count"]
    limit: Column = F.coalesce(*[F.when(F.col("field") == f.name, 1 if f.kind == "one" else f.most) for f in shown])
    most = max([1, *[f.most for f in shown]])
    ranked = top_n(different.where(F.col("field").isin(*[f.name for f in shown])), [key, "field"], [F.col("at"), F.col("value")], most).where(F.col("rank") <= limit)

    def column(f: Field) -> Column:
        got = F.array_sort(F.collect_list(F.when(F.col("field") == f.name, F.struct("rank", "at.source", "value"))))
        if not f.merge:
            got = F.filter(got, lambda x: x["source"] == got[0]["source"])
        texts = F.transform(got, lambda x: x["value"])
        return (F.get(texts, F.lit(0)) if f.kind == "one" else texts).alias(f.name)

    records = ranked.groupBy(key).agg(*map(column, shown))
    out = keys.select(key).distinct().join(records, key, "left")
    if counts is not None:
        out = out.join(counts, key, "left")
    empty = {"list": lambda n: F.coalesce(n, F.array().cast("array<string>")), "count": lambda n: F.coalesce(n, F.lit(0)), "one": lambda n: F.col(n)}
    return out.select(key, *[empty[f.kind](f.name).alias(f.name) for f in fields])
