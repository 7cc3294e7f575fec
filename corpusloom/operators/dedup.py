"""Duplicates of names and contents, with the order of the input where that decides."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import edit_ratio, name_form
from ..session import checkpointed


def first_wins(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key in order. A minimum with partial aggregation, so a hot key doesn't meet in one task unreduced."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    best = df.groupBy(*keys).agg(F.min(F.struct(*order, *rest)).alias("__row"))
    return best.select(*[F.col(c) if c in keys else F.col(f"__row.{c}").alias(c) for c in df.columns])


def later_copies(df: DataFrame, key: str, id_col: str, kind: str) -> DataFrame:
    """Rows after the first of each non-empty key: type, id, and the id of the first."""
    told = df.where(F.nullif(F.col(key), F.lit("")).isNotNull())
    first = told.groupBy(key).agg(F.min(id_col).alias("duplicate_of"), F.count("*").alias("n")).where("n > 1").drop("n")
    return told.join(first, key).where(F.col(id_col) != F.col("duplicate_of")).select(F.lit(kind).alias("type"), id_col, "duplicate_of")


def exact_names(df: DataFrame, name: str = "name", id_col: str = "id") -> DataFrame:
    return later_copies(df, name, id_col, "exact_name")


def same_content(df: DataFrame, md5: str = "md5", name: str = "name", id_col: str = "id") -> DataFrame:
    """Equal content under names that aren't exact copies themselves."""
    return later_copies(df.join(exact_names(df, name, id_col).select(id_col), id_col, "left_anti"), md5, id_col, "md5_content")


def similar_forms(forms: DataFrame, ratio: float, form: str = "form") -> DataFrame:
    """Pairs (a, b), a < b, of different forms with an edit ratio of at least ratio.

    k edits, the most that the ratio leaves the longer form of m characters, change at most k of its numbered characters ((character, 1), (character, 2) ...), so two such
    forms share m - k of them. In the order of their rarity, rarest first, one of the first k + 1 of the one is then among the first k + 1 of the other, k taken from each form's own
    length: forms meet on those, so a form of n characters makes about (1 - ratio) * n rows. Lengths, places and the whole overlap rule out most pairs before the distance is computed.
    """
    from .similar import in_order_of_rarity

    f = forms.select(F.col(form).alias("text")).where(F.length("text") > 0).distinct().withColumn("id", F.monotonically_increasing_id())
    f = in_order_of_rarity(checkpointed(f)).select("id", "text", F.length("text").alias("n"), "order")
    edits = lambda n: F.floor((1 - ratio) * n + 1e-9).cast("int")
    spots = f.select("id", "n", F.posexplode(F.slice("order", 1, edits(F.col("n")) + 1)).alias("at", "token"))
    side = lambda p: spots.select("token", *[F.col(c).alias(f"{p}_{c}") for c in ("id", "n", "at")])
    longest = F.greatest("x_n", "y_n")
    shared = longest - edits(longest)
    met = side("x").join(side("y"), "token").where((F.col("x_id") < F.col("y_id")) & (F.least("x_n", "y_n") >= shared) & (F.least(F.col("x_n") - F.col("x_at"), F.col("y_n") - F.col("y_at")) + F.least("x_at", "y_at") >= shared))
    pairs = met.select("x_id", "y_id").distinct()
    of = lambda p: f.select(*[F.col(c).alias(f"{p}_{c}") for c in ("id", "text", "n", "order")])
    both = pairs.join(of("x"), "x_id").join(of("y"), "y_id").where(F.size(F.array_intersect("x_order", "y_order")) >= shared)
    near = both.select(F.least("x_text", "y_text").alias("a"), F.greatest("x_text", "y_text").alias("b"))
    return near.select("a", "b", edit_ratio(F.col("a"), F.col("b")).alias("ratio")).where(F.col("ratio") >= ratio)


def greedy_representatives(forms: DataFrame, edges: DataFrame, save) -> DataFrame:
    """Of forms (form, ord) and edges (a, b): form, is_dup and, for a dup, the earliest representative near it.

    The lexicographically first maximal independent set, in rounds: a form is a dup once an earlier neighbour is a representative, and a
    representative once all earlier neighbours are dups. save(df) cuts the lineage after each round.
    """
    both = edges.select("a", "b").union(edges.select("b", "a"))
    f = forms.select("form", "ord")
    earlier = both.join(f.select(F.col("form").alias("a"), F.col("ord").alias("oa")), "a").join(f.select(F.col("form").alias("b"), F.col("ord").alias("ob")), "b").where("ob < oa").select(F.col("a").alias("form"), F.col("b").alias("before"), "ob")
    earlier = save(earlier)
    state = save(f.withColumn("is_dup", F.lit(None).cast("boolean")))
    while True:
        near = earlier.join(state.select(F.col("form").alias("before"), F.col("is_dup").alias("was")), "before").groupBy("form").agg(F.bool_or(~F.col("was")).alias("any_rep"), F.every(F.coalesce("was", F.lit(False))).alias("all_dup"))
        new = F.when(F.col("is_dup").isNotNull(), F.col("is_dup")).when(F.coalesce("any_rep", F.lit(False)), True).when(F.coalesce("all_dup", F.lit(True)), False)
        state = save(state.join(near, "form", "left").select("form", "ord", new.alias("is_dup")))
        if state.where("is_dup is null").isEmpty():
            break
    reps = state.where(~F.col("is_dup")).select(F.col("form").alias("before"))
    first = earlier.join(reps, "before").groupBy("form").agg(F.min(F.struct("ob", "before")).alias("x")).select("form", F.col("x.before").alias("similar_to"))
    return state.join(first, "form", "left").select("form", "is_dup", F.when(F.col("is_dup"), F.col("similar_to")).alias("similar_to"))


def fuzzy_names(df: DataFrame, ratio: float, save, name: str = "name", order: str = "ord") -> DataFrame:
    """Greedy fuzzy duplicates of file names: forms in order of first appearance, exact names counted once."""
    forms = df.select(name_form(F.col(name)).alias("form"), order).groupBy("form").agg(F.min(order).alias("ord"))
    return greedy_representatives(forms, similar_forms(forms, ratio), save)


def unsuppressed(items: Column) -> Column:
    """Items of an array, lower-cased for the test, that aren't contained in an item kept before."""
    zero = F.array().cast("array<string>")
    keep = lambda acc, x: F.when(F.exists(acc, lambda y: F.contains(F.lower(y), F.lower(x))), acc).otherwise(F.concat(acc, F.array(x)))
    return F.aggregate(items, zero, keep)


def prefix_key(text: Column, n: int = 40) -> Column:
    return F.regexp_replace(F.lower(F.substring(text, 1, n)), "[^a-z0-9]", "")


def over_assigned(df: DataFrame, keys: str, path: str, most: int = 2, allowed: str = "a^") -> DataFrame:
    return df.where((F.size(keys) > most) & ~F.lower(F.col(path)).rlike(allowed))


def numbered(df: DataFrame, by: list[str], order: list[str], name: str = "n") -> DataFrame:
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
