"""The incremental build: what changed decides which groups are built again; a group's old rows are replaced, the others stay."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.diff import snapshot_diff


def stale_groups(current: DataFrame, previous: DataFrame, group: str, key: str = "id", content: str = "md5", name: str = "name", modified: str = "modified_time") -> DataFrame:
    """Groups with any change, in the current snapshot or, for deleted rows, in the previous one."""
    changed = snapshot_diff(current, previous, key, content, name, modified).where("change_type <> 'UNCHANGED'").select(key)
    both = current.select(key, group).union(previous.select(key, group))
    return both.join(changed, key, "left_semi").select(group).distinct()


def rebuild(current: DataFrame, previous: DataFrame, built: DataFrame, build: Callable[[DataFrame], DataFrame], group: str, **columns: str) -> DataFrame:
    """The built table with stale groups built anew from the current rows."""
    stale = stale_groups(current, previous, group, **columns)
    return built.join(stale, group, "left_anti").unionByName(build(current.join(stale, group, "left_semi")), allowMissingColumns=True)


def run_summary(parts: dict[str, DataFrame]) -> DataFrame:
    """One row for each part of a run: its name and its single-row summary as JSON."""
    rows = [df.select(F.lit(k).alias("part"), F.to_json(F.struct(*df.columns)).alias("summary")) for k, df in parts.items()]
    out = rows[0]
    for r in rows[1:]:
        out = out.union(r)
    return out
