"""Operator 3. Secret scans with multipart credential linking.

Strong spans are found by three patterns (assign, access, hex). Weak candidates of three roles, an identifier (user names and
short access keys), a secret (short assigned values and long mixed-character tokens) and an endpoint (URLs, host:port), count
only if a part of another role lies in the same scope: less than `scope` code points between their starts. The link is an
interval join: parts become rows keyed by document and cell (start div scope), each candidate looks at its own cell and the two
beside it, and a cell holds at most scope / 4 parts, so no group grows with the data. Only DataFrame functions.

Positions come from splitting the text at the pattern: the pieces and matches alternate, and running lengths give starts. Folds run in
blocks of `BLOCK` matches, so time grows with the number of matches and not with its square; no pattern backtracks over a whole text.

Defined results: a null text is empty; a text without secrets has zero counts, the digest of the empty string and no spans;
rows with equal doc_id and text have equal results, one row each, and a null doc_id is kept; an empty table gives no rows; spans
may touch or overlap across kinds, equal (start, kind) can't repeat; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, digest, let

SCOPE, BLOCK = 256, 256
SPAN = "struct<start:int,rank:int,end:int,kind:string>"
#: kind, pattern, role, strong; the order of the strong kinds is that of the contract.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
WEAK = {
    "user": (r"""(?i:\b(?:user|username|login|account|client_id|access_key))["']?\x20*[:=]\x20*["']?[A-Za-z0-9@_.-]{3,}""", "identifier"),
    "short": (r"""(?i:\b(?:pass|pwd|pw|key|auth|bearer|password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{4,11}(?![A-Za-z0-9+/_.=-])""", "secret"),
    "mixed": (r"[A-Za-z0-9+/_=-]{20,}", "secret"),
    "endpoint": (r"(?:(?:https?|ftp|ssh|jdbc:[a-z]{2,12}|mongodb|redis|amqp|s3)://[A-Za-z0-9@:%._/-]{4,}|(?<![A-Za-z0-9.-])[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++:[0-9]{2,5}\b)", "endpoint"),  # possessive: neither backtracks nor recurses
}
#: What a match must hold besides.
HOLDS = {"mixed": ("[0-9]", "[A-Z]", "[a-z]")}
ROLE = {"assign": "secret", "access": "identifier", "hex": "secret"}
ORDER = {k: i for i, k in enumerate(("assign", "access", "hex", *WEAK))}


def in_blocks(items: Column, size: int = BLOCK) -> Column:
    """The array in slices of at most so many items, so that a fold may append inside a slice without copying all that came before."""
    return let(items, lambda x: F.transform(F.filter(F.sequence(F.lit(0), F.size(x), F.lit(size)), lambda i: i < F.size(x)), lambda i: F.slice(x, i + 1, F.lit(size))))


def found(text: Column, pattern: str, kind: str, least: int = 0, group: int = 0) -> Column:
    """Spans (start, rank, end, kind) of the leftmost non-overlapping matches; least: characters that the group must have."""
    pieces = F.split(text, pattern, -1)
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    none = F.array().cast(f"array<{SPAN}>")

    def holds(x: Column) -> Column:
        out = F.length(x["group"]) >= least
        for part in HOLDS.get(kind, ()):
            out = out & x["match"].rlike(part)
        return out

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + F.length(x["piece"])
        end = begin + F.length(x["match"])
        one = F.array(F.struct(begin.alias("start"), F.lit(ORDER[kind]).alias("rank"), end.alias("end"), F.lit(kind).alias("kind")))
        return F.struct(end.alias("at"), F.when(holds(x), F.concat(acc["out"], one)).otherwise(acc["out"]).alias("out"))

    def block(acc: Column, xs: Column) -> Column:
        inner = F.aggregate(xs, F.struct(acc["at"].alias("at"), none.alias("out")), step)
        return let(inner, lambda i: F.struct(i["at"].alias("at"), F.concat(acc["out"], F.array(i["out"])).alias("out")))

    # pieces has one element more than matches; its partner is null and ends the fold
    zipped = F.arrays_zip(pieces.alias("piece"), matches.alias("match"))
    if group:
        groups = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
        zipped = F.zip_with(zipped, groups, lambda p, g: F.struct(p["piece"].alias("piece"), p["match"].alias("match"), g.alias("group")))
    else:
        zipped = F.transform(zipped, lambda p: F.struct(p["piece"].alias("piece"), p["match"].alias("match"), p["match"].alias("group")))
    zipped = F.filter(zipped, lambda x: x["match"].isNotNull())
    spans = F.aggregate(in_blocks(zipped), F.struct(F.lit(0).alias("at"), F.array().cast(f"array<array<{SPAN}>>").alias("out")), block, lambda acc: F.flatten(acc["out"]))
    return F.when(text.rlike(pattern), spans).otherwise(none)


def listed(spans: Column) -> Column:
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def linked(rows: DataFrame, scope: int = SCOPE) -> DataFrame:
    """Weak spans of each key that a part of another role is near to. rows: row_key, strong and weak spans.

    A weak span that overlaps a strong one says nothing new and is left out.
    """
    roles = F.create_map(*[F.lit(x) for k, r in ({k: v[1] for k, v in WEAK.items()} | ROLE).items() for x in (k, r)])
    some = rows.where((F.size("weak") > 0) & (F.size("weak") + F.size("strong") > 1)).dropDuplicates(["row_key"])
    each = cut_lineage(some.select("row_key", F.explode(F.concat("strong", "weak")).alias("s")))  # a table of its own, read four times
    cell = lambda at: F.floor(at / scope)
    cells = F.explode(F.sequence(cell(F.col("s.start")), cell(F.col("s.end") - 1))).alias("cell")
    weak, strong = each.where(F.col("s.kind").isin(*WEAK)), each.where(~F.col("s.kind").isin(*WEAK))
    covering = strong.select(F.col("row_key").alias("by"), F.col("s").alias("o"), cells).withColumnRenamed("cell", "by_cell")
    covered = weak.select("row_key", "s", cells).join(covering, (F.col("row_key") == F.col("by")) & (F.col("cell") == F.col("by_cell")) & (F.col("s.start") < F.col("o.end")) & (F.col("o.start") < F.col("s.end")), "left_semi")
    free = weak.join(covered.select("row_key", "s").distinct(), ["row_key", "s"], "left_anti")
    parts = cut_lineage(strong.union(free).withColumns({"role": F.element_at(roles, F.col("s.kind")), "cell": cell(F.col("s.start"))}))
    seeking = parts.where(F.col("s.kind").isin(*WEAK)).select("row_key", "s", "role", F.explode(F.array(F.col("cell") - 1, F.col("cell"), F.col("cell") + 1)).alias("cell"))
    near = parts.select(F.col("row_key").alias("near_key"), F.col("s.start").alias("near_start"), F.col("role").alias("near_role"), F.col("cell").alias("near_cell"))
    meets = (F.col("row_key") == F.col("near_key")) & (F.col("cell") == F.col("near_cell")) & (F.col("role") != F.col("near_role")) & (F.abs(F.col("near_start") - F.col("s.start")) < scope)
    return seeking.join(near, meets, "left_semi").groupBy("row_key").agg(F.collect_set("s").alias("linked"))


def span_rows(docs: DataFrame, *carried) -> DataFrame:
    """The carried columns, row_key, and the strong and weak spans of each row."""
    strong = F.concat(found(F.col("t"), ASSIGN, "assign", 12, 1), found(F.col("t"), ACCESS, "access"), found(F.col("t"), HEX, "hex"))
    weak = F.concat(*[found(F.col("t"), p, k) for k, (p, _) in WEAK.items()])
    rows = docs.select(*carried, F.coalesce(F.col("text"), F.lit("")).alias("t"), digest(F.col("doc_id"), F.col("text")).alias("row_key"))
    return rows.select(*rows.columns[:-2], "row_key", strong.alias("strong"), weak.alias("weak"))


def with_linked(rows: DataFrame, found_in: DataFrame, scope: int) -> DataFrame:
    return rows.join(linked(found_in, scope), "row_key", "left").withColumn("linked", F.coalesce("linked", F.array().cast(f"array<{SPAN}>")))


def secret_report(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """Per row: doc_id, counts and digest of the base spans, all spans, and the number of linked ones."""
    rows = cut_lineage(span_rows(docs, F.col("doc_id")))  # few and short columns; texts stay behind
    n = lambda kind: F.size(F.filter("strong", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return with_linked(rows, rows, scope).select("doc_id", n("assign"), n("access"), n("hex"), F.sha2(listed(F.col("strong")), 256).alias("base_sha256"), listed(F.concat("strong", "linked")).alias("spans"), F.size("linked").cast("long").alias("n_linked"))


def redacted(text: Column, spans: Column, mark: str = "[secret]") -> Column:
    """The text with each run of overlapping or touching spans replaced by mark. rest: what follows code point `at`, so that no step looks at the whole text again."""

    def step(rest: Column, base: Column):
        def run(acc: Column, s: Column) -> Column:
            done = F.greatest(acc["at"], F.lit(0))
            add = F.when(s["start"] > acc["at"], F.array(F.substring(rest, done - base + 1, s["start"] - done), F.lit(mark))).otherwise(F.array().cast("array<string>"))
            return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.concat(acc["out"], add).alias("out"))

        return run

    def block(acc: Column, xs: Column) -> Column:
        base = F.greatest(acc["at"], F.lit(0))
        inner = F.aggregate(xs, F.struct(acc["at"].alias("at"), F.array().cast("array<string>").alias("out")), step(acc["rest"], base))
        return let(inner, lambda i: F.struct(i["at"].alias("at"), F.substring(acc["rest"], i["at"] - base + 1, F.length(acc["rest"])).alias("rest"), F.concat(acc["out"], F.array(F.array_join(i["out"], ""))).alias("out")))

    start = F.struct(F.lit(-1).alias("at"), text.alias("rest"), F.array().cast("array<string>").alias("out"))
    cut = F.aggregate(in_blocks(F.array_sort(spans)), start, block, lambda acc: F.concat(F.array_join(acc["out"], ""), acc["rest"]))
    return F.when(F.size(spans) == 0, text).otherwise(cut)


def redact_secrets(docs: DataFrame, scope: int = SCOPE, mark: str = "[secret]") -> DataFrame:
    """The rows and columns of docs with the secrets in text replaced by mark; a null text stays null."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    found_in = span_rows(docs)
    out = with_linked(span_rows(docs, row), found_in, scope)
    return out.select(*[redacted(F.col("row.text"), F.concat("strong", "linked"), mark).alias("text") if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns])
