"""Mixed timestamp notations to UTC instants.

Every value is expanded in the JVM to the array of its valid interpretations:
both orders of day and month where the notation leaves that open, and both
instants of a local time that a zone has twice. A Viterbi pass over each
source's record order then chooses one per record, penalising a change of
notation and a step back in time. What the conventions settle (month first with
slashes, day first with dots, the earlier of two instants) enters as a prior
that outweighs any path, so records follow it wherever it applies.

A record with one interpretation cuts the chain: the best path on either side
does not depend on the other. The chains are therefore solved in blocks of
record numbers, in parallel also within one source. Runs of open records that
touch the edge of a block are solved afterwards from one min-plus matrix per
block, which gives the same path as one pass over the whole source.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.runtime import materialise

SWITCH_COST = 1.0
BACKWARD_COST = 1.0
#: More than all penalties a record can save: two transitions of two penalties.
LATER_INSTANT_COST = 16.0
OTHER_ORDER_COST = 64.0
BLOCK_ROWS = 65_536
#: Blocks that a source's records without a place in its order are spread over.
UNORDERED_BLOCKS = 64

# Zone abbreviations in minutes from UTC.
ABBREVIATIONS = {
    "Z": 0, "UTC": 0, "GMT": 0, "UT": 0, "WET": 0, "WEST": 60, "BST": 60, "IST": 60,
    "CET": 60, "CEST": 120, "MEZ": 60, "MESZ": 120, "EET": 120, "EEST": 180, "MSK": 180,
    "AST": -240, "ADT": -180, "EST": -300, "EDT": -240, "CST": -360, "CDT": -300,
    "MST": -420, "MDT": -360, "PST": -480, "PDT": -420, "AKST": -540, "AKDT": -480, "HST": -600,
    "NST": -210, "NDT": -150, "JST": 540,
}
# The months' English abbreviations.
MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]

_TIME = r"(\d{1,2}):(\d{2})(?::(\d{2})(?:[.,]\d+)?)?"
_AMPM = r"(?:\s*([AaPp])\.?[Mm]\.?(?![A-Za-z]))?"
_ZONE = r"(?:\s*([Zz]|[A-Z]{2,5}|[+-]\d{2}(?::?\d{2})?))?(?:\s*\[?([A-Za-z]+(?:/[A-Za-z0-9_+-]+)+)\]?)?"
_AT = rf"(?:,?[Tt\s]\s*{_TIME}{_AMPM}{_ZONE})?"
#: Notation, pattern, and the order in which its groups give y, mo, d, h, mi, s, am/pm, offset, zone.
NOTATIONS = [
    ("iso", rf"^(\d{{4}})([-/.])(\d{{1,2}})\2(\d{{1,2}}){_AT}$", (1, 3, 4, 5, 6, 7, 8, 9, 10)),
    ("epoch_s", r"^(\d{10})$", (1,)),
    ("epoch_ms", r"^(\d{13})$", (1,)),
    ("epoch_us", r"^(\d{16})$", (1,)),
    ("epoch_ns", r"^(\d{19})$", (1,)),
    ("year", r"^(\d{4})$", (1,)),
    ("month", r"^(\d{4})[-/](\d{2})$", (1, 2)),
    ("named", rf"^(?:[A-Za-z]{{3,9}},?\s+)?(\d{{1,2}})[-\s]([A-Za-z]{{3,9}})\.?[-\s](\d{{4}}){_AT}$", (3, 2, 1, 4, 5, 6, 7, 8, 9)),
    ("week", r"^(\d{4})-?W(\d{2})(?:-?(\d))?$", (1, 2, 3)),
    ("compact", rf"^(\d{{4}})(\d{{2}})(\d{{2}})(?:T?(\d{{2}})(\d{{2}})(\d{{2}})?(?:[.,]\d+)?{_ZONE})?$", (1, 2, 3, 4, 5, 6, 0, 7, 8)),
    ("slash", rf"^(\d{{1,2}})/(\d{{1,2}})/(\d{{4}}){_AT}$", (3, 1, 2, 4, 5, 6, 7, 8, 9)),
    ("english", rf"^(?:[A-Za-z]{{3,9}},?\s+)?([A-Za-z]{{3,9}})\.?\s+(\d{{1,2}}),?\s+(\d{{4}}){_AT}$", (3, 1, 2, 4, 5, 6, 7, 8, 9)),
    ("dot", rf"^(\d{{1,2}})\.(\d{{1,2}})\.(\d{{4}}){_AT}$", (3, 2, 1, 4, 5, 6, 7, 8, 9)),
    ("english_month", r"^([A-Za-z]{3,9})\.?,?\s+(\d{4})$", (2, 1)),
]
_CODE = {name: i for i, (name, _, _) in enumerate(NOTATIONS)}
CANONICAL = r"^\d{4}-\d{2}-\d{2}T(?:[01]\d|2[0-3]):\d{2}:\d{2}Z$"
CANDIDATES = T.ArrayType(
    T.StructType([T.StructField("fmt", T.IntegerType()), T.StructField("utc_s", T.LongType()), T.StructField("cost", T.DoubleType())])
)


def _java_zones(spark: SparkSession) -> list[str]:
    ids = spark.sparkContext._jvm.java.time.ZoneId.getAvailableZoneIds()
    return sorted(z for z in ids if "/" in z and not z.startswith("SystemV/"))


def _days(y: Column, mo: Column, d: Column) -> Column:
    """Days since 1970 of a date, null where the calendar has no such date."""
    leap = ((y % 4 == 0) & (y % 100 != 0)) | (y % 400 == 0)
    last = F.when(mo == 2, F.when(leap, 29).otherwise(28)).when(mo.isin(4, 6, 9, 11), 30).otherwise(31)
    ok = y.between(1, 9999) & mo.between(1, 12) & d.between(1, last)
    return F.when(ok, F.unix_date(F.make_date(F.when(ok, y).otherwise(2000), F.when(ok, mo).otherwise(1), F.when(ok, d).otherwise(1))))


def with_interpretations(df: DataFrame, value: str, out: str = "cands", conventions: bool = True) -> DataFrame:
    """Adds the array of valid interpretations of a column: structs of notation
    code, epoch second in UTC and prior cost, 0 without conventions; empty where the value names no
    point or period in time. Null, blank and wordy values give an empty array."""
    spark = df.sparkSession
    zones = _java_zones(spark)
    s = F.regexp_replace(F.regexp_replace(F.col(value), r"(?U)^[\s\p{C}]+|[\s\p{C}]+$", ""), r"[\x{A0}\x{2007}\x{202F}]", " ")
    hit = None
    for name, pattern, groups in NOTATIONS:
        to = str(_CODE[name]) + "|" + "|".join(f"${g}" if g else "" for g in (*groups, *[0] * (9 - len(groups))))
        test = F.col("_s").rlike(pattern)
        got = F.regexp_replace("_s", pattern, to)
        hit = F.when(test, got) if hit is None else hit.when(test, got)
    keep = df.columns
    d = df.withColumn("_s", s).withColumn("_p", F.split(hit, r"\|"))
    part = lambda i: F.nullif(F.try_element_at("_p", F.lit(i + 1)), F.lit(""))
    d = d.withColumns(
        {
            "_k": part(0).cast("int"),
            "_y": F.coalesce(part(1), F.lit("0")).cast("decimal(20,0)"),
            "_mt": F.lower(part(2)),
            "_d": F.coalesce(part(3).cast("int"), F.lit(1)),
            "_h": F.coalesce(part(4).cast("int"), F.lit(0)),
            "_mi": F.coalesce(part(5).cast("int"), F.lit(0)),
            "_sec": F.coalesce(part(6).cast("int"), F.lit(0)),
            "_ap": F.lower(part(7)),
            "_off": part(8),
            "_zone": part(9),
        }
    )
    month = F.expr(
        "case when _mt is null then 1 when _mt rlike '^[0-9]+$' then cast(_mt as int) else "
        + "nullif(array_position(array(" + ",".join(f"'{m}'" for m in MONTHS) + "), substr(_mt,1,3)), 0) end"
    ).cast("int")
    is_epoch = F.col("_k").isin(*[_CODE[k] for k in ("epoch_s", "epoch_ms", "epoch_us", "epoch_ns")])
    names = "january|february|march|april|may|june|july|august|september|october|november|december|sept"
    word_ok = F.col("_mt").isNull() | F.col("_mt").rlike(rf"^(\d+|[a-z]{{3}}|{names})$")
    d = d.withColumns({"_mo": F.when(word_ok, month), "_yi": F.when(~is_epoch, F.col("_y").cast("int"))})
    hour = (
        F.when(F.col("_ap").isNull(), F.col("_h"))
        .when(F.col("_h").between(1, 12), F.col("_h") % 12 + F.when(F.col("_ap") == "p", 12).otherwise(0))
        .otherwise(99)
    )
    d = d.withColumn("_h", hour)
    clock_ok = (F.col("_mi") < 60) & (F.col("_sec") < 60) & ((F.col("_h") < 24) | ((F.col("_h") == 24) & (F.col("_mi") == 0) & (F.col("_sec") == 0)))
    clock = F.col("_h") * 3600 + F.col("_mi") * 60 + F.col("_sec")
    monday1 = F.date_trunc("week", F.make_date(F.when(F.col("_yi").between(1, 9999), F.col("_yi")).otherwise(2000), F.lit(1), F.lit(4))).cast("date")
    week_day = F.date_add(monday1, (F.col("_mo") - 1) * 7 + F.col("_d") - 1)
    week = F.when(
        F.col("_yi").between(1, 9999) & F.col("_mo").between(1, 53) & F.col("_d").between(1, 7) & (F.extract(F.lit("YEAROFWEEK"), week_day) == F.col("_yi")),
        F.unix_date(week_day),
    )
    day_a = F.when(F.col("_k") == _CODE["week"], week).when(~is_epoch, _days(F.col("_yi"), F.col("_mo"), F.col("_d")))
    open_order = F.col("_k").isin(_CODE["slash"], _CODE["dot"])
    day_b = F.when(open_order & (F.col("_d") != F.col("_mo")), _days(F.col("_yi"), F.col("_d"), F.col("_mo")))
    off_min = F.when(
        F.col("_off").rlike(r"^[+-]"),
        F.expr("(cast(substr(_off,2,2) as int) * 60 + coalesce(try_cast(nullif(substr(replace(_off,':',''),4,2),'') as int),0)) * if(_off like '-%', -1, 1)"),
    )
    abbr = F.create_map(*[F.lit(x) for k, v in ABBREVIATIONS.items() for x in (k, v)])
    fixed = F.when(F.col("_off").isNull(), F.when(F.col("_zone").isNull(), 0)).when(
        off_min.isNotNull(), F.when(F.abs(off_min) <= 14 * 60, off_min).otherwise(0)
    ).otherwise(F.try_element_at(abbr, F.upper("_off")))
    epoch = (
        F.when(F.col("_k") == _CODE["epoch_s"], F.col("_y"))
        .when(F.col("_k") == _CODE["epoch_ms"], F.floor(F.col("_y") / 1000))
        .when(F.col("_k") == _CODE["epoch_us"], F.floor(F.col("_y") / 1_000_000))
        .when(F.col("_k") == _CODE["epoch_ns"], F.floor(F.col("_y") / 1_000_000_000))
        .cast("long")
    )
    d = d.withColumns({"_fixed": fixed, "_good": F.col("_zone").isin(zones)}).withColumns(
        {f"_l{x}": F.when(clock_ok, day.cast("long") * 86400 + clock) for x, day in (("a", day_a), ("b", day_b))}
    )

    def instants(x: str) -> dict[str, Column]:
        local = F.col(f"_l{x}")
        safe = F.timestamp_seconds(F.coalesce(local, F.lit(0)))
        zone = F.when(F.col("_good"), F.col("_zone")).otherwise("UTC")
        first = F.unix_seconds(F.to_utc_timestamp(safe, zone))
        by_zone = F.col("_zone").isNotNull() & F.col("_off").isNull()
        return {
            f"_{x}1": F.when(by_zone, F.when(F.col("_good"), F.when(local.isNotNull(), first))).otherwise(local - F.col("_fixed") * 60),
            f"_{x}z": F.when(by_zone & F.col("_good") & local.isNotNull(), zone),
        }

    def later(x: str) -> Column:
        """The second instant of a local time that occurs twice."""
        one, zone, local = F.col(f"_{x}1"), F.col(f"_{x}z"), F.col(f"_l{x}")
        back = lambda gap: F.unix_seconds(F.from_utc_timestamp(F.timestamp_seconds(one + gap), zone)) == local
        return F.when(zone.isNotNull(), F.when(back(3600), one + 3600).when(back(1800), one + 1800))

    d = d.withColumns(instants("a") | instants("b"))
    other = F.lit(len(NOTATIONS)) + F.col("_k")
    cand = lambda code, utc, cost: F.struct(code.cast("int").alias("fmt"), utc.cast("long").alias("utc_s"), F.lit(float(cost) if conventions else 0.0).alias("cost"))
    plain = F.array(cand(F.col("_k"), F.coalesce(epoch, F.col("_a1")), 0))
    full = F.array(
        cand(F.col("_k"), F.col("_a1"), 0),
        cand(F.col("_k"), later("a"), LATER_INSTANT_COST),
        cand(other, F.col("_b1"), OTHER_ORDER_COST),
        cand(other, later("b"), OTHER_ORDER_COST + LATER_INSTANT_COST),
    )
    every = F.when(open_order | F.col("_zone").isNotNull(), full).otherwise(plain)
    in_range = lambda c: c["utc_s"].between(-62135596800, 253402300799)
    return d.withColumn(out, F.when(F.col("_k").isNotNull(), F.filter(every, in_range)).otherwise(F.array().cast(CANDIDATES))).select(*keep, out)


def conforming(fmt: Column) -> Column:
    """Whether an interpretation follows the conventions on the order of day and month."""
    return fmt < len(NOTATIONS)


class Chain:
    """Candidates of consecutive records: flat arrays and offsets."""

    def __init__(self, fmt: np.ndarray, utc: np.ndarray, cost: np.ndarray, off: np.ndarray):
        self.fmt, self.utc, self.cost, self.off = fmt, utc, cost, off

    def at(self, i: int) -> slice:
        return slice(self.off[i], self.off[i + 1])

    def step(self, i: int, j: int) -> np.ndarray:
        """Penalties from each candidate of record i to each of record j."""
        a, b = self.at(i), self.at(j)
        return SWITCH_COST * (self.fmt[a][:, None] != self.fmt[b][None, :]) + BACKWARD_COST * (self.utc[b][None, :] < self.utc[a][:, None])

    def matrix(self, i: int, j: int) -> np.ndarray:
        """Least cost between each candidate of record i and each of j, both included."""
        m = np.full((self.off[i + 1] - self.off[i],) * 2, np.inf)
        np.fill_diagonal(m, self.cost[self.at(i)])
        for k in range(i, j):
            m = (m[:, :, None] + self.step(k, k + 1)[None, :, :]).min(axis=1) + self.cost[self.at(k + 1)][None, :]
        return m

    def best(self, i: int, j: int, first: int | None = None, last: int | None = None) -> list[int]:
        """Candidate of each record from i to j on the cheapest path, its ends fixed if given."""
        here = self.cost[self.at(i)].copy()
        if first is not None:
            here[np.arange(len(here)) != first] = np.inf
        back = []
        for k in range(i, j):
            via = here[:, None] + self.step(k, k + 1)
            back.append(via.argmin(axis=0))
            here = via.min(axis=0) + self.cost[self.at(k + 1)]
        path = [int(here.argmin()) if last is None else last]
        for b in reversed(back):
            path.append(int(b[path[-1]]))
        return path[::-1]


def _chain(col: pa.ChunkedArray | pa.Array) -> Chain:
    arr = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.chunk(0)
    off = arr.offsets.to_numpy()
    flat = arr.values
    f = [flat.field(i).to_numpy(zero_copy_only=False) for i in range(3)]
    return Chain(f[0], f[1], f[2], off)


_BLOCK_OUT = T.StructType(
    [
        T.StructField("kind", T.IntegerType()),  # 0 decided, 1 open at an edge, 2 summary
        T.StructField("g", T.LongType()),
        T.StructField("block", T.LongType()),
        T.StructField("ord", T.LongType()),
        T.StructField("tab", T.StringType()),
        T.StructField("row_key", T.LongType()),
        T.StructField("emit", T.BooleanType()),
        T.StructField("fmt", T.IntegerType()),
        T.StructField("utc_s", T.LongType()),
        T.StructField("cands", CANDIDATES),
        T.StructField("m", T.ArrayType(T.DoubleType())),
        T.StructField("ends", CANDIDATES),
        T.StructField("n_first", T.IntegerType()),
    ]
)
_BLOCK_ARROW = pa.schema(
    [
        ("kind", pa.int32()), ("g", pa.int64()), ("block", pa.int64()), ("ord", pa.int64()), ("tab", pa.string()), ("row_key", pa.int64()), ("emit", pa.bool_()),
        ("fmt", pa.int32()), ("utc_s", pa.int64()), ("cands", c := pa.list_(pa.struct([("fmt", pa.int32()), ("utc_s", pa.int64()), ("cost", pa.float64())]))),
        ("m", pa.list_(pa.float64())), ("ends", c), ("n_first", pa.int32()),
    ]
)


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Whole groups of input sorted by keys, one table after another."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        ks = [b.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(b.num_rows, bool)
        for k in ks:
            change[1:] |= k[1:] != k[:-1]
        if held and any(held[-1].column(k)[-1].as_py() != b.column(k)[0].as_py() for k in keys):
            yield pa.Table.from_batches(held)
            held = []
        cuts = [0, *np.flatnonzero(change).tolist(), b.num_rows]
        for x, y in zip(cuts, cuts[1:]):
            if x and held:
                yield pa.Table.from_batches(held)
                held = []
            held.append(b.slice(x, y - x))
    if held:
        yield pa.Table.from_batches(held)


def _cand_list(chain: Chain, rows: list[int]) -> list[list[dict]]:
    return [[{"fmt": int(chain.fmt[c]), "utc_s": int(chain.utc[c]), "cost": float(chain.cost[c])} for c in range(chain.off[r], chain.off[r + 1])] for r in rows]


def _solve_block(t: pa.Table) -> Iterator[pa.RecordBatch]:
    t = t.filter(pc.greater(pc.list_value_length(t["cands"]), 0)).combine_chunks()
    n = t.num_rows
    if not n:
        return
    chain = _chain(t["cands"])
    sizes = np.diff(chain.off)
    choice = np.zeros(n, np.int64)
    anchors = np.flatnonzero(sizes == 1)
    lo, hi = (int(anchors[0]), int(anchors[-1])) if len(anchors) else (n, -1)
    if len(anchors):
        gaps = np.flatnonzero(np.diff(anchors) > 1)
        for a, b in zip(anchors[gaps].tolist(), anchors[gaps + 1].tolist()):
            choice[a : b + 1] = chain.best(a, b)
    decided = np.arange(n)
    pending: list[int] = []
    if lo > 0 or hi < n - 1:
        pending = [*range(0, lo + 1), *range(hi, n)] if len(anchors) else list(range(n))
        pending = sorted(set(pending))
        decided = np.arange(lo + (lo > 0), hi + (hi == n - 1)) if len(anchors) else decided[:0]
        decided = decided[~np.isin(decided, pending)] if len(anchors) else decided
    emit = t["emit"].to_numpy()
    decided = decided[emit[decided]]
    at = chain.off[:-1][decided] + choice[decided]
    g, block = t["g"][0].as_py(), t["block"][0].as_py()

    def batch(kind: int, k: int, **cols: object) -> pa.RecordBatch:
        full = {"kind": np.full(k, kind, np.int32), "g": np.full(k, g), "block": np.full(k, block)} | cols
        return pa.RecordBatch.from_arrays([pa.array(full[f.name], f.type) if f.name in full else pa.nulls(k, f.type) for f in _BLOCK_ARROW], schema=_BLOCK_ARROW)

    def take(rows: np.ndarray | list[int]) -> dict[str, object]:
        s = t.take(pa.array(rows, pa.int64()))
        return {c: s[c].combine_chunks() if s[c].num_chunks != 1 else s[c].chunk(0) for c in ("tab", "row_key", "emit")}

    if len(decided):
        yield batch(0, len(decided), **take(decided), fmt=chain.fmt[at], utc_s=chain.utc[at])
    if pending:
        yield batch(1, len(pending), **take(pending), ord=pending, cands=_cand_list(chain, pending))
    if len(anchors):
        m = chain.matrix(0, lo)[:, :1] + chain.matrix(hi, n - 1)[:1, :]
    else:
        m = chain.matrix(0, n - 1)
    ends = _cand_list(chain, [0, n - 1])
    yield batch(2, 1, emit=[bool(pending)], m=[m.ravel().tolist()], ends=[ends[0] + ends[1]], n_first=[len(ends[0])])


def _solve_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for t in _groups(batches, ["g", "block"]):
        yield from _solve_block(t)


def _join_blocks(t: pa.Table) -> pa.Table:
    """Chosen first and last candidate of each block of one source that has open records."""
    rows = sorted(t.to_pylist(), key=lambda r: r["block"])
    here, back, before = None, [], None
    for r in rows:
        k = r["n_first"]
        first, last = r["ends"][:k], r["ends"][k:]
        m = np.array(r["m"]).reshape(k, len(last))
        if here is None:
            enter, via = np.zeros(k), np.zeros(k, int)
        else:
            step = np.array([[SWITCH_COST * (a["fmt"] != b["fmt"]) + BACKWARD_COST * (b["utc_s"] < a["utc_s"]) for b in first] for a in before])
            total = here[:, None] + step
            enter, via = total.min(axis=0), total.argmin(axis=0)
        through = enter[:, None] + m
        back.append((via, through.argmin(axis=0)))
        here, before = through.min(axis=0), last
    out = []
    last = int(here.argmin()) if here is not None else 0
    for r, (via, through) in zip(reversed(rows), reversed(back)):
        first = int(through[last])
        if r["emit"]:
            out.append({"g": r["g"], "block": r["block"], "c_first": first, "c_last": last})
        last = int(via[first])
    return pa.Table.from_pylist(out, schema=pa.schema([("g", pa.int64()), ("block", pa.int64()), ("c_first", pa.int32()), ("c_last", pa.int32())]))


_DONE = "tab string, row_key long, fmt int, utc_s long"
_DONE_ARROW = pa.schema([("tab", pa.string()), ("row_key", pa.int64()), ("fmt", pa.int32()), ("utc_s", pa.int64())])


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for t in _groups(batches, ["g", "block"]):
        t = t.combine_chunks()
        chain, ords, emit = _chain(t["cands"]), t["ord"].to_numpy(), t["emit"].to_numpy()
        n, choice = t.num_rows, np.zeros(t.num_rows, np.int64)
        first, last = t["c_first"][0].as_py(), t["c_last"][0].as_py()
        single = np.flatnonzero(np.diff(chain.off) == 1)
        if not len(single):
            choice[:] = chain.best(0, n - 1, first, last)
        else:
            a, b = int(single[0]), int(single[-1])
            choice[: a + 1] = chain.best(0, a, first, None)
            choice[b:] = chain.best(b, n - 1, None, last)
        keep = np.flatnonzero(emit)
        at = chain.off[:-1][keep] + choice[keep]
        s = t.take(pa.array(keep))
        yield from pa.Table.from_arrays([s["tab"], s["row_key"], pa.array(chain.fmt[at], pa.int32()), pa.array(chain.utc[at], pa.int64())], schema=_DONE_ARROW).to_batches()
        del ords


def choose_interpretations(df: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(tab, row_key, src, seq, emit, cands) -> (tab, row_key, fmt, utc_s).

    One row for each input row with emit true and at least one candidate. src is
    the source whose record order counts, seq the order. Null src is a source of
    its own; rows without seq form UNORDERED_BLOCKS blocks ahead of the others, by
    hash of row_key; equal seq are
    ordered by row_key. Repeated rows each get a row. An empty table gives an
    empty result.
    """
    # Records without candidates are left out behind the exchange: a filter here
    # would be pushed down and repeat the whole parsing expression.
    rows = df.select(
        F.xxhash64("tab", F.coalesce("src", F.lit("\0"))).alias("g"),
        F.coalesce(F.floor(F.col("seq") / block_rows), -1 - F.pmod(F.xxhash64("row_key"), F.lit(UNORDERED_BLOCKS))).cast("long").alias("block"),
        F.col("seq").cast("long").alias("seq"), F.col("tab").cast("string").alias("tab"), F.col("row_key").cast("long").alias("row_key"), "emit", "cands",
    )
    solved = rows.repartition("g", "block").sortWithinPartitions("g", "block", "seq", "row_key").drop("seq").mapInArrow(_solve_blocks, _BLOCK_OUT)
    solved = materialise(solved, "timestamp-blocks")
    done = solved.where("kind = 0").select("tab", "row_key", "fmt", "utc_s")
    # One row for each block of a source; its records stay where they are.
    ends = (
        solved.where("kind = 2").select("g", "block", "emit", "m", "ends", "n_first")
        .groupBy("g").applyInArrow(_join_blocks, "g long, block long, c_first int, c_last int")
    )
    edge = solved.where("kind = 1").select("g", "block", "ord", "tab", "row_key", "emit", "cands").join(ends, ["g", "block"])
    rest = edge.repartition("g", "block").sortWithinPartitions("g", "block", "ord").mapInArrow(_finish, _DONE)
    return done.unionByName(rest)


def normalise_timestamps(df: DataFrame, value: str = "value", emit: Column | None = None, block_rows: int = BLOCK_ROWS, conventions: bool = True) -> DataFrame:
    """(tab, row_key, src, seq, value) -> (tab, row_key, utc): the instant each
    value names as yyyy-MM-ddTHH:mm:ssZ, fractions cut off.

    Values that name none, or only against the conventions, have no row; nor have
    rows for which emit is false, which count as context all the same. Null and
    empty values and long texts name none, blanks around a value don't count; other
    columns are ignored.

    Without conventions only the path decides: the order of day and month and which
    of two instants are chosen by the records around.
    """
    wanted = F.lit(True) if emit is None else F.coalesce(emit, F.lit(False))
    d = df.select("tab", "row_key", "src", "seq", F.col(value).alias("value"), wanted.alias("emit"))
    chosen = choose_interpretations(with_interpretations(d, "value", conventions=conventions), block_rows)
    utc = F.date_format(F.timestamp_seconds("utc_s"), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return (chosen.where(conforming(F.col("fmt"))) if conventions else chosen).select("tab", "row_key", utc.alias("utc"))
