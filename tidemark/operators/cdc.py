"""Change data capture: latest rows, change logs, history, merges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.timeutil import lsn_value

Order = list[Column | str]


def _desc(order: Order) -> list[Column]:
    """Largest first, nulls before all: a change without a time wins."""
    return [(F.col(c) if isinstance(c, str) else c).desc_nulls_first() for c in order]


def latest_by_key(df: DataFrame, keys: list[str], order: Order, deleted: str | None = "_deleted", strict: bool = False) -> DataFrame:
    """The latest row of each key; a deleted latest row takes its key away.

    strict also drops rows whose flag is null. order must be total for a unique result.
    """
    ranked = df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*_desc(order)))).filter("_rn = 1").drop("_rn")
    if deleted is None:
        return ranked
    return ranked.filter(~F.col(deleted)) if strict else ranked.filter(~F.coalesce(F.col(deleted), F.lit(False)))


def latest_by_key_agg(df: DataFrame, keys: list[str], order: list[str], deleted: str | None = "_deleted") -> DataFrame:
    """latest_by_key by aggregation: partial maxima before the shuffle and no sort of a key's rows, so a key with very many changes stays cheap."""
    by = F.struct(*(x for c in order for x in (F.col(c).isNull(), F.col(c))))
    rest = [c for c in df.columns if c not in keys]
    latest = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), by).alias("_row")).select(*keys, "_row.*").select(*df.columns)
    return latest if deleted is None else latest.filter(~F.coalesce(F.col(deleted), F.lit(False)))


def apply_changelog(df: DataFrame, keys: list[str], op: str = "_cdc_operation", ts: str = "_cdc_timestamp", lsn: str = "_cdc_lsn", lexical: bool = False) -> DataFrame:
    """Current rows of an op-coded log, by time and log position; keys whose last operation is `d` are gone."""
    position = F.col(lsn) if lexical else lsn_value(lsn)
    return latest_by_key(df, keys, [F.col(ts), position], None).filter(F.col(op) != "d")


def scd2(df: DataFrame, keys: list[str], order: str, tracked: list[str], tiebreak: Order = ()) -> DataFrame:
    """History: one row for each stretch in which the tracked columns stay the same, with valid_from, valid_to (null while current), is_current."""
    w = Window.partitionBy(*keys).orderBy(order, *tiebreak)
    state = F.to_json(F.struct(*tracked), {"ignoreNullFields": "false"})
    marked = df.withColumn("_state", state).withColumn("_before", F.lag("_state").over(w))
    changed = marked.filter(F.col("_before").isNull() | (F.col("_before") != F.col("_state")))
    until = F.lead(order).over(w)
    out = changed.withColumn("valid_from", F.col(order)).withColumn("valid_to", until)
    return out.withColumn("is_current", F.col("valid_to").isNull()).drop("_state", "_before")


def deduplicate(df: DataFrame, keys: list[str], order: Order) -> DataFrame:
    """One row for each key, the first in the given total order (dropDuplicates would take any)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def merge_changes(snapshot: DataFrame, changes: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """A snapshot that keeps deleted rows as tombstones, and a batch of changes, to the next snapshot: an older row that comes late changes nothing."""
    return latest_by_key_agg(snapshot.unionByName(changes), keys, order, None)


def live(snapshot: DataFrame, deleted: str = "_deleted") -> DataFrame:
    return snapshot.filter(~F.coalesce(F.col(deleted), F.lit(False)))


def latest_run(history: DataFrame, keys: list[str], ts: str, since: Column, catalog: DataFrame, ties: list[str] = ()) -> DataFrame:
    """The last run since a moment of each object of the kinds that the catalog lists (by the columns it has); runs of one time by `ties`."""
    recent = history.filter(F.col(ts) >= since).join(catalog.distinct(), catalog.columns, "left_semi")
    return latest_by_key(recent, keys, [ts, *ties], None)
