"""Keys of items by a weighted vote of six signals, and labels of texts by a score table. Each signal is an expression of the item's own row; two of them join a small table first."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import let
from ..session import checkpointed
from .reconcile import contained

SIGNAL = "struct<signal:string,weight:decimal(6,3),confidence:decimal(9,6),keys:array<int>>"
#: The factor of authoritative signals, the confidence from which it applies, and the bonus of an item that has one.
BOOST, SURE, BONUS = "1.5", "0.9", "1.1"


@dataclass(frozen=True)
class Voting:
    """What the signals compare with: all keys, weights, keys of weeks, names of resources for every key, parents in order, key words, expected volumes, and inventory rows (ord, path, keys as text)."""

    keys: list[int]
    weights: dict[str, float]
    weeks: dict[int, list[int]] = field(default_factory=dict)
    every: list[str] = field(default_factory=list)
    parents: list[tuple[str, list[int]]] = field(default_factory=list)
    words: dict[int, list[str]] = field(default_factory=dict)
    volumes: dict[str, tuple[int, int]] = field(default_factory=dict)
    usual: tuple[int, int] = (5, 50)

    def signal(self, name: str, found: Column) -> Column:
        """found: a struct of confidence and keys, or null."""
        whole = lambda s: F.struct(F.lit(name).alias("signal"), F.lit(str(self.weights[name])).cast("decimal(6,3)").alias("weight"), s["confidence"].cast("decimal(9,6)").alias("confidence"), s["keys"].alias("keys")).cast(SIGNAL)
        return let(found, whole)

    def path(self, path: Column, batch: Column, known: Column, known_confidence: Column) -> Column:
        """The first of: a resource of all keys, a range of weeks, the keys that the item came with, a numbered lesson, a week."""
        text = F.lower(F.trim(F.concat_ws(" ", F.coalesce(path, F.lit("")), F.coalesce(batch, F.lit("")))))
        plain = F.translate(text, "_-", "  ")
        number = lambda pattern, i=1: F.nullif(F.regexp_extract(text, pattern, i), F.lit("")).cast("int")
        week_of = F.create_map(*[x for w, k in self.weeks.items() for x in (F.lit(w), F.array(*map(F.lit, k)))]) if self.weeks else F.expr("cast(map() as map<int,array<int>>)")
        a, b = number(r"weeks?[_\s\-]*(\d)[_\s\-]*(\d)"), number(r"weeks?[_\s\-]*(\d)[_\s\-]*(\d)", 2)
        span = F.array_sort(F.array_distinct(F.flatten(F.filter(F.transform(F.when(a <= b, F.sequence(a, b)).otherwise(F.array().cast("array<int>")), lambda w: F.try_element_at(week_of, w)), lambda x: x.isNotNull()))))
        lesson, week = number(r"lesson[_\s\-]*(\d{1,2})"), F.try_element_at(week_of, number(r"week[_\s\-]*(\d)(?![_\s\-]*\d)"))
        hit = lambda keys, confidence: F.struct(F.lit(confidence).cast("double").alias("confidence"), keys.alias("keys"))
        everywhere = F.exists(F.array(*map(F.lit, map(str.lower, self.every))), lambda r: F.contains(plain, r)) if self.every else F.lit(False)
        return (
            F.when(everywhere, hit(F.array(*map(F.lit, self.keys)), 0.95)).when(F.size(span) > 0, hit(span, 0.9)).when(F.size(known) > 0, F.struct(known_confidence.cast("double").alias("confidence"), known.alias("keys")))
            .when(lesson.isin(self.keys), hit(F.array(lesson), 1.0)).when(F.size(week) > 0, hit(week, 0.9))
        )

    def parent(self, path: Column, batch: Column) -> Column:
        """The keys of the first parent whose name, also with spaces for underscores, is in the path, or in the batch where there is no path."""
        where, out = F.coalesce(F.nullif(path, F.lit("")), batch, F.lit("")), F.lit(None).cast("struct<confidence:double,keys:array<int>>")
        for name, keys in reversed(self.parents):
            out = F.when(F.contains(where, F.lit(name)) | F.contains(where, F.lit(name.replace("_", " "))), F.struct(F.lit(1.0).alias("confidence"), F.array(*map(F.lit, keys)).alias("keys"))).otherwise(out)
        return out

    def _best(self, scores: Column, full: float) -> Column:
        """Of (key, score) the keys of the greatest score above 0, and the score as a share of full."""
        keys = lambda each, top: F.transform(F.filter(each, lambda x: x["score"] == top), lambda x: x["key"])
        of = lambda each, top: F.when(top > 0, F.struct(F.least(top / full, F.lit(1.0)).alias("confidence"), keys(each, top).alias("keys")))
        return let(scores, lambda each: let(F.array_max(F.transform(each, lambda x: x["score"])), lambda top: of(each, top)))

    def _words(self) -> Column:
        return F.array(*[F.struct(F.lit(k).alias("key"), F.array(*[F.lit(w.lower()) for w in ws]).alias("words")) for k, ws in self.words.items()])

    def overlap(self, tags: Column) -> Column:
        """Tags against key words: 1 if one holds the other, a half if a word of the key word is in the tag."""
        plain = F.transform(F.coalesce(tags, F.array().cast("array<string>")), lambda t: F.translate(F.lower(t), "-_", "  "))
        one = lambda t, w: F.when(F.contains(w, t) | F.contains(t, w), 1.0).when(F.exists(F.split(w, r"\s+"), lambda x: F.contains(t, x)), 0.5).otherwise(0.0)
        total = lambda ts, ws: F.aggregate(ts, F.lit(0.0), lambda s, t: s + F.aggregate(ws, F.lit(0.0), lambda r, w: r + one(t, w)))
        return self._best(let(plain, lambda ts: F.transform(self._words(), lambda k: F.struct(k["key"].alias("key"), total(ts, k["words"]).alias("score")))), 3) if self.words else F.lit(None)

    def content(self, text: Column) -> Column:
        """How many key words of each key the text holds."""
        score = lambda low, k: F.size(F.filter(k["words"], lambda w: F.contains(low, w))).cast("double")
        return self._best(let(F.lower(text), lambda low: F.transform(self._words(), lambda k: F.struct(k["key"].alias("key"), score(low, k).alias("score")))), 4) if self.words else F.lit(None)

    def volume(self, kind: Column, known: Column, count: Column) -> Column:
        """Whether the number of items of the kind that came with the item's first key is in the expected range."""
        low, high = ([F.when(kind == k, v[i]) for k, v in self.volumes.items()] for i in (0, 1))
        low, high = F.coalesce(*low, F.lit(self.usual[0])), F.coalesce(*high, F.lit(self.usual[1]))
        confidence = F.when(count.between(low, high), 0.8).when(count > 0, 0.5).otherwise(0.3)
        return F.when((F.size(known) > 0) & (kind != ""), F.struct(confidence.alias("confidence"), known.alias("keys")))


def inventory_keys(inventory: DataFrame, keys: list[int]) -> DataFrame:
    """(ord, path, confidence, keys) of inventory rows whose text names keys: all, a range, or one number; a text with a dash but no range names none."""
    low, high = (F.nullif(F.regexp_extract("keys", r"(\d+)\s*-\s*(\d+)", i), F.lit("")).cast("int") for i in (1, 2))
    one, dash = F.nullif(F.regexp_extract("keys", r"(\d+)", 1), F.lit("")).cast("int"), F.contains("keys", F.lit("-"))
    found = F.when(F.contains("keys", F.lit("All")), F.array(*map(F.lit, keys))).when(dash & (low <= high), F.sequence(low, high)).when(~dash & one.isNotNull(), F.array(one))
    return inventory.select("ord", "path", F.when(F.contains("keys", F.lit("All")), 0.85).otherwise(0.95).alias("confidence"), found.alias("found")).where("found is not null").withColumnRenamed("found", "keys")


def signals(items: DataFrame, voting: Voting, inventory: DataFrame) -> DataFrame:
    """items (item, path, batch, known array<int>, known_confidence, tags, text, kind) with the array `signals`, one entry for each signal that says something."""
    inv = inventory_keys(inventory, voting.keys).where("path <> ''")
    listed = contained(inv.select(F.struct("ord", "confidence", "keys").alias("needle_id"), F.lower("path").alias("norm")), items.select(F.col("path").alias("hay_id"), F.lower("path").alias("norm")).where("path <> ''").distinct())
    # both tables are written, so that Spark knows when they are small and leaves the items where they are; what texts and tags say is worked out before the joins
    listed = checkpointed(listed.groupBy(F.col("hay_id").alias("path")).agg(F.min("needle_id").alias("listed")))
    of = checkpointed(items.select("kind", F.explode("known").alias("key")).groupBy("kind", "key").agg(F.count("*").alias("volume")))
    c = F.col
    own = {
        "path": voting.path(c("path"), c("batch"), c("known"), c("known_confidence")),
        "parent": voting.parent(c("path"), c("batch")),
        "tags": voting.overlap(c("tags")),
        "content": voting.content(c("text")),
    }
    rows = items.withColumns({f"__{name}": voting.signal(name, s) for name, s in own.items()} | {"key": F.get("known", F.lit(0))})
    rows = rows.join(listed, "path", "left").join(of, ["kind", "key"], "left").drop("key")
    joined = {
        "metadata": F.when(c("listed").isNotNull(), F.struct(c("listed.confidence").alias("confidence"), c("listed.keys").alias("keys"))),
        "volume": voting.volume(c("kind"), c("known"), F.coalesce("volume", F.lit(0))),
    }
    order = ("path", "parent", "metadata", "tags", "content", "volume")
    every = F.array(*[voting.signal(name, joined[name]) if name in joined else c(f"__{name}") for name in order])
    return rows.withColumn("signals", F.filter(every, lambda s: (F.size(s["keys"]) > 0) & (s["confidence"] > 0))).drop("listed", "volume", *[f"__{name}" for name in own])


def consensus(rows: DataFrame, voting: Voting, authoritative: tuple[str, ...] = ("path", "parent")) -> DataFrame:
    """rows with winners (all keys of the greatest vote, ascending), confidence in percent, status and the votes of all keys. Votes are decimals, so ties are ties."""
    sure = lambda s: s["signal"].isin(*authoritative) & (s["confidence"] >= F.lit(SURE).cast("decimal(3,1)"))
    dec = lambda x, t="decimal(20,9)": x.cast(t)
    weight = lambda s: dec(s["weight"] * s["confidence"] * F.when(sure(s), F.lit(BOOST).cast("decimal(3,1)")).otherwise(F.lit("1.0").cast("decimal(3,1)")))
    add = lambda some: F.aggregate(some, F.lit("0").cast("decimal(20,9)"), lambda t, s: dec(t + weight(s)))
    each = lambda some: F.transform(F.array(*map(F.lit, sorted(voting.keys))), lambda k: F.struct(k.alias("key"), add(F.filter(some, lambda s: F.array_contains(s["keys"], k))).alias("vote")))
    rows = rows.withColumns({"votes": F.filter(let(F.col("signals"), each), lambda v: v["vote"] > 0), "total": add(F.col("signals"))})
    best = F.array_max(F.transform("votes", lambda v: v["vote"]))
    share = F.col("best").cast("double") / F.col("total").cast("double") * 100 * F.when(F.exists("signals", sure), float(BONUS)).otherwise(1.0)
    rows = rows.withColumn("best", best).withColumn("winners", F.transform(let(F.col("best"), lambda top: F.filter("votes", lambda v: v["vote"] == top)), lambda v: v["key"])).withColumn("share", F.when(F.size("votes") > 0, F.least(share, F.lit(100.0))).otherwise(0.0))
    status = F.when(F.size("votes") == 0, "UNMAPPED").when(F.col("share") >= 90, "HIGH_CONFIDENCE").when(F.col("share") >= 70, "MEDIUM_CONFIDENCE").when(F.col("share") >= 50, "LOW_CONFIDENCE").otherwise("UNCERTAIN")
    return rows.withColumns({"confidence": F.round("share", 1), "status": status}).drop("share", "best", "total")


def mapping_summary(mapped: DataFrame) -> DataFrame:
    """One row: items, mapped and unmapped (no vote or an uncertain one), and each band of the mapped."""
    n = lambda s: F.count_if(F.col("status") == s)
    high, medium, low = n("HIGH_CONFIDENCE"), n("MEDIUM_CONFIDENCE"), n("LOW_CONFIDENCE")
    return mapped.agg(F.count("*").alias("items"), (high + medium + low).alias("mapped"), (F.count("*") - high - medium - low).alias("unmapped"), high.alias("high"), medium.alias("medium"), low.alias("low"))


def key_index(mapped: DataFrame) -> DataFrame:
    """The by-key index as rows (key, item), to be written by key; a list per key would hold any share of all items."""
    return mapped.select(F.explode_outer("winners").alias("key"), "item").where("key is not null")  # explode would push a copy of the whole vote below as its filter


def best_label(text: Column, title: Column, labels: dict[str, list[str]], fallback: dict[str, list[str]] | None = None, bonus: int = 2) -> Column:
    """The label with the most phrases in the text, each phrase in the title counting bonus more; of equals the first. Only where none scores, the fallback labels by the text alone; else empty."""

    def top(table: dict[str, list[str]], extra: int) -> Column:
        low, head = F.lower(F.coalesce(text, F.lit(""))), F.lower(F.coalesce(title, F.lit("")))
        rows = F.array(*[F.struct(F.lit(-i).alias("place"), F.lit(name).alias("label"), F.array(*map(F.lit, phrases)).alias("phrases")) for i, (name, phrases) in enumerate(table.items())])
        score = lambda r: F.size(F.filter(r["phrases"], lambda p: F.contains(low, p))) + extra * F.size(F.filter(r["phrases"], lambda p: F.contains(head, p)))
        best = F.array_max(F.transform(rows, lambda r: F.struct(score(r).alias("score"), r["place"].alias("place"), r["label"].alias("label"))))
        return F.when(best["score"] > 0, best["label"])

    found = [top(labels, bonus)] + ([top(fallback, 0)] if fallback else [])
    return F.coalesce(*found, F.lit(""))
