"""References to records that do not exist, at the moment the reference arrived.

Both sides are turned into signed changes per key: a record that appears is +1 on
the existence count and one that is deleted -1, a reference +1 on the reference
count and one that is taken back -1. A reference is an orphan where, in the order
of the changes, its key has positive references and no existence. Keys are cut by
period, with opening balances per key and period computed from pre-aggregated
sums, so a key that holds a third of all rows is spread over as many tasks as it
has periods.

The counts are also kept as a table, one row a key, to which each batch of changes
is added (`count_changes`, `add_counts`); the report of present orphans is a filter
on it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

_EXIST, _REF = 0, 1


def orphan_references(references: DataFrame, records: DataFrame, bucket: str = "day") -> DataFrame:
    """references (tab, row_key, key, at), records (key, added_at, deleted_at)
    -> (tab, row_key, period, reason) of each reference whose key has no living
    record at its time.

    A record lives from added_at to just before deleted_at, for ever if that is
    null, never if added_at is null; deleted before it was added, it never lived.
    reason: missing if the key has no record at all, late if one is added after
    the reference, else deleted. References with null key or time are no
    references. Repeated records count once each, repeated references each get a
    row. Empty tables are fine on either side.
    """
    r = references.where("key is not null and at is not null").select("key", F.col("at").alias("at"), "tab", F.col("row_key").cast("long").alias("row_key"))
    e = records.where("key is not null and added_at is not null").withColumn("one", F.when(F.col("deleted_at") <= F.col("added_at"), 0).otherwise(1))
    delta = lambda at, sign, n: F.struct(F.col(at).alias("at"), (F.col("one") * sign).cast("long").alias("delta"), F.lit(n).cast("long").alias("n"))
    zero, plus = F.lit(0).cast("long").alias("refs"), F.lit(1).cast("long").alias("refs")
    changes = e.select("key", F.explode(F.array(delta("added_at", 1, 1), delta("deleted_at", -1, 0))).alias("x"))
    changes = changes.select("key", "x.at", "x.delta", "x.n").where("at is not null")
    part = lambda c: F.date_trunc(bucket, c)

    # One row per key and period: net change, and whether references fall in it.
    net = changes.groupBy("key", part(F.col("at")).alias("part")).agg(
        F.sum("delta").alias("net"), F.max(F.when(F.col("n") > 0, F.col("at"))).alias("last_added"), F.sum("n").alias("n")
    )
    asked = r.select("key", part(F.col("at")).alias("part")).distinct()
    by_key = Window.partitionBy("key")
    opening = (
        net.withColumn("asked", F.lit(0))
        .unionByName(asked.select("key", "part", F.lit(0).cast("long").alias("net"), F.lit(None).cast("timestamp").alias("last_added"), F.lit(0).cast("long").alias("n"), F.lit(1).alias("asked")))
        .groupBy("key", "part").agg(F.sum("net").alias("net"), F.max("last_added").alias("last_added"), F.sum("n").alias("n"), F.max("asked").alias("asked"))
        .withColumns(
            {
                "opening": F.coalesce(F.sum("net").over(by_key.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
                "n_records": F.sum("n").over(by_key),
                "key_last_added": F.max("last_added").over(by_key),
            }
        )
        .where("asked = 1")
    )
    none_s, none_l, none_t = F.lit(None).cast("string"), F.lit(None).cast("long"), F.lit(None).cast("timestamp")
    lines = (
        opening.select("key", "part", F.col("part").alias("at"), F.lit(-1).alias("what"), F.col("opening").alias("delta"), zero, none_s.alias("tab"), none_l.alias("row_key"), "n_records", F.col("key_last_added").alias("last_added"))
        .unionByName(changes.select("key", part(F.col("at")).alias("part"), "at", F.lit(_EXIST).alias("what"), "delta", zero, none_s.alias("tab"), none_l.alias("row_key"), none_l.alias("n_records"), none_t.alias("last_added")))
        .unionByName(r.select("key", part(F.col("at")).alias("part"), "at", F.lit(_REF).alias("what"), F.lit(0).cast("long").alias("delta"), plus, "tab", "row_key", none_l.alias("n_records"), none_t.alias("last_added")))
    )
    w = Window.partitionBy("key", "part").orderBy("at", "what").rowsBetween(Window.unboundedPreceding, 0)
    state = lines.withColumns(
        {"living": F.sum("delta").over(w), "references": F.sum("refs").over(w), "known": F.max("n_records").over(w), "latest": F.max("last_added").over(w)}
    ).where((F.col("what") == _REF) & (F.col("references") > 0) & (F.col("living") <= 0))
    return state.select("tab", "row_key", F.date_format("at", "yyyy-MM").alias("period"), reason(F.col("known"), F.col("latest"), F.col("at")).alias("reason"))


def reason(n_records: Column, last_added: Column, at: Column) -> Column:
    return F.when(F.coalesce(n_records, F.lit(0)) == 0, "missing").when(last_added > at, "late").otherwise("deleted")


def orphan_report(orphans: DataFrame) -> DataFrame:
    """Orphans per table, period and reason."""
    return orphans.groupBy("tab", "period", "reason").agg(F.count("*").alias("n_orphans"))


COUNTS = "tab string, key string, references long, existing long"


def count_changes(references: DataFrame, records: DataFrame, as_of: Column | None = None) -> DataFrame:
    """references (tab, key, at), records (key, added_at, deleted_at), both with an
    optional column sign -> COUNTS: net counts of a batch of changes, by table and key
    for references, with null table for existence.

    sign is -1 where a row is taken back, +1 by default. With as_of only changes up to
    then count. Records that never lived, null keys and null times change nothing.
    Hot keys shrink before the shuffle.
    """
    sign = lambda df: F.col("sign").cast("long") if "sign" in df.columns else F.lit(1).cast("long")
    by_then = (lambda c: c <= as_of) if as_of is not None else (lambda c: F.lit(True))
    lived = records.where("key is not null and added_at is not null and (deleted_at is null or deleted_at > added_at)")
    net = F.when(by_then(F.col("added_at")), 1).otherwise(0) - F.when(F.col("deleted_at").isNotNull() & by_then(F.col("deleted_at")), 1).otherwise(0)
    existing = lived.select(F.lit(None).cast("string").alias("tab"), "key", F.lit(0).cast("long").alias("references"), (net * sign(records)).cast("long").alias("existing"))
    used = references.where(F.col("key").isNotNull() & F.col("at").isNotNull() & by_then(F.col("at"))).select("tab", "key", sign(references).alias("references"), F.lit(0).cast("long").alias("existing"))
    return add_counts(used, existing)


def add_counts(incoming: DataFrame, counts: DataFrame) -> DataFrame:
    """Two tables of COUNTS as one; keys whose counts are all 0 again are left out.
    What a stream merges its batches by."""
    return incoming.unionByName(counts).groupBy("tab", "key").agg(F.sum("references").alias("references"), F.sum("existing").alias("existing")).where("references <> 0 or existing <> 0")


def orphans_of(counts: DataFrame) -> DataFrame:
    """COUNTS -> (tab, key, n_references): keys with positive references and no existence."""
    existing = counts.where("tab is null and existing > 0").select("key")
    return counts.where("tab is not null and references > 0").join(existing, "key", "left_anti").select("tab", "key", F.col("references").alias("n_references"))


def current_orphans(references: DataFrame, records: DataFrame, as_of: Column | None = None) -> DataFrame:
    """(tab, key, n_references): keys with references and no living record at as_of
    (by default after all changes)."""
    return orphans_of(count_changes(references, records, as_of))
