"""The fuzzy join: best match by Ratcliff-Obershelp ratio on the first characters, block against block of texts, among pairs that bounds that lose nothing leave."""

from __future__ import annotations

import difflib

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from ..session import checkpointed
from .block_match import best_targets

#: Different texts of a block of sources and of targets, and tasks that the pairs of blocks are dealt over at most.
S_BLOCK, T_BLOCK, UNITS = 2048, 4096, 4000


@F.pandas_udf(DoubleType())
def ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """difflib's ratio, with its rule on popular characters; a is the first sequence."""
    return pd.Series([difflib.SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b)])


def numbered_characters(texts: DataFrame) -> DataFrame:
    """texts (id, text) with codes of two sets: the characters numbered among their equals ((character, 1), (character, 2) ...), and neighbouring characters in the same way."""

    def numbered(items: list[int]) -> list[int]:
        seen: dict[int, int] = {}
        return [(x << 20) + seen.setdefault(x, 0) for x in items if seen.update({x: seen.get(x, -1) + 1}) is None]

    def run(batches):
        for batch in batches:
            chars = [[ord(c) for c in t] for t in batch.column(1).to_pylist()]
            both = [pa.array([numbered(x) for x in side], pa.list_(pa.int64())) for side in (chars, [[(a << 21) + b for a, b in zip(x, x[1:])] for x in chars])]
            yield pa.RecordBatch.from_arrays([batch.column(0), *both], names=["id", "characters", "neighbours"])

    return texts.select("id", "text").mapInArrow(run, "id long, characters array<long>, neighbours array<long>")


def in_order_of_rarity(texts: DataFrame) -> DataFrame:
    """texts (id, text and more, from a written table) with the ranks of their numbered characters, the rarest over all texts first (order), and the codes of their numbered neighbours."""
    sets = checkpointed(numbered_characters(texts))
    each = sets.select("id", F.explode("characters").alias("code"))
    # different numbered characters: an alphabet times the longest run of one, whatever the number of texts
    ranks = each.groupBy("code").agg(F.count("*").alias("texts")).select("code", F.row_number().over(Window.orderBy("texts", "code")).alias("rank"))
    order = each.join(ranks, "code").groupBy("id").agg(F.array_sort(F.collect_list("rank")).alias("order"))
    return checkpointed(texts.join(order, "id").join(sets.select("id", "neighbours"), "id"))


def fuzzy_best(source: DataFrame, target: DataFrame, least: float, cut: int) -> DataFrame:
    """(s, t, kind, term, ratio): for each different text of the source, by kind of target and term, its greatest ratio of at least `least` in each block of targets, with all targets that reach it.

    Every text of a kind and term meets every other there, in blocks of bounded size that are dealt over all tasks; the blocks rule out nearly all pairs by counts (see block_match).
    """
    keys, sides = ["kind", "term", "s_block", "t_block"], {}
    for df, side, size in ((source, "s", S_BLOCK), (target, "t", T_BLOCK)):
        kinds = F.when(F.col("atom_type") == "speaker_note", F.array(F.lit("speaker_note"), F.lit("text_block"))).otherwise(F.array("atom_type")) if side == "s" else F.array("atom_type")
        one = df.select(F.substring("norm", 1, cut).alias("text"), F.explode(kinds).alias("kind"), term_key().alias("term")).where(F.length("text") >= 5).distinct()
        one = checkpointed(one)
        sides[side] = one, one.groupBy("kind", "term").agg(F.ceil(F.count("*") / size).cast("int").alias(f"{side}_blocks"))
    blocks = checkpointed(sides["s"][1].join(sides["t"][1], ["kind", "term"]))
    units = blocks.agg(F.sum(F.col("s_blocks").cast("long") * F.col("t_blocks"))).first()[0] or 1
    parts, mine = min(units, UNITS), lambda side: F.pmod(F.xxhash64("text"), F.col(f"{side}_blocks")).cast("int").alias(f"{side}_block")
    every = lambda side: F.explode(F.sequence(F.lit(0), F.col(f"{side}_blocks") - 1)).alias(f"{side}_block")
    s = sides["s"][0].join(blocks, ["kind", "term"]).select("text", "kind", "term", mine("s"), every("t")).repartition(parts, *keys)
    t = sides["t"][0].join(blocks, ["kind", "term"]).select("text", "kind", "term", mine("t"), every("s")).repartition(parts, *keys)

    def run(key: tuple, one: pa.Table, two: pa.Table) -> pa.Table:
        a, b = one.column("text").to_pylist(), two.column("text").to_pylist()
        found = best_targets(a, b, least)
        names = [key[0].as_py(), key[1].as_py()]
        return pa.table({"s": pa.array([a[i] for i, _, _ in found], pa.string()), "t": pa.array([b[j] for _, j, _ in found], pa.string()), "kind": pa.array([names[0]] * len(found), pa.string()), "term": pa.array([names[1]] * len(found), pa.string()), "ratio": pa.array([r for _, _, r in found], pa.float64())})

    return s.groupBy(*keys).cogroup(t.groupBy(*keys)).applyInArrow(run, "s string, t string, kind string, term string, ratio double")


def term_key() -> Column:
    """A term as text, so that none equals none."""
    return F.coalesce(F.concat(F.lit("+"), F.col("term").cast("string")), F.lit(""))


def match_fuzzy(source: DataFrame, target: DataFrame, least: float = 0.8, cut: int = 200) -> DataFrame:
    """Of atoms with norm, atom_type, term: per atom the target of the same term (none equals none) and type, for notes also text blocks, with the greatest ratio of at least
    `least`; of equals one of the atom's own type, then the first.

    Texts shorter than 5 characters don't take part. Equal texts are scored once; what their atoms get is the first target of each.
    """
    scored = fuzzy_best(source, target, least, cut)
    term = term_key().alias("term")
    t = target.select(F.col("atom_type").alias("kind"), term, F.substring("norm", 1, cut).alias("t"), F.struct("ord", "atom_id").alias("x")).groupBy("kind", "term", "t").agg(F.min("x").alias("x"))
    best = scored.join(t, ["kind", "term", "t"]).groupBy("kind", "term", "s").agg(F.min(F.struct((-F.col("ratio")).alias("r"), "x")).alias("y"))
    s = source.select("atom_id", F.col("atom_type").alias("s_kind"), term, F.substring("norm", 1, cut).alias("s"))
    found = s.join(best, ["term", "s"]).where((F.col("kind") == F.col("s_kind")) | (F.col("s_kind") == "speaker_note") & (F.col("kind") == "text_block"))
    least_of = found.groupBy("atom_id").agg(F.min(F.struct("y.r", F.col("kind") != F.col("s_kind"), F.col("y.x").alias("x"))).alias("z"))
    return least_of.select("atom_id", F.col("z.x.atom_id").alias("target_id"), F.lit("fuzzy").alias("tier"), (-F.col("z.r")).alias("confidence"))
