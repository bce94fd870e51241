"""Deeply nested records to flat child tables, by list offsets.

A nested column is never walked row by row: the offsets of each Arrow list give
the parent of every element, the keys are carried to the children by one take,
and the positions are the element numbers less the parent's offset. Raw JSON
lines of changing shape are parsed in the JVM, as variants, and brought to the
same type there.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHILD_ROWS = "key long, child string, creator_pos int, item_pos int, name string, name_type string, value string"
_CHILD_ARROW = pa.schema(
    [("key", pa.int64()), ("child", pa.string()), ("creator_pos", pa.int32()), ("item_pos", pa.int32()), ("name", pa.string()), ("name_type", pa.string()), ("value", pa.string())]
)
_CREATORS_SQL = "array<struct<name_type:string,name:string,identifiers:array<string>,affiliations:array<string>>>"
CREATORS = pa.list_(
    pa.struct([("name_type", pa.string()), ("name", pa.string()), ("identifiers", pa.list_(pa.string())), ("affiliations", pa.list_(pa.string()))])
)


def parents(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Of each element that a list array holds: its list's index, its position
    there, and the elements themselves. Null lists hold none."""
    off = lists.offsets.to_numpy().astype(np.int64)
    length = np.diff(off)
    if lists.null_count:
        length = np.where(lists.is_valid().to_numpy(zero_copy_only=False), length, 0)
    parent = np.repeat(np.arange(len(lists)), length)
    start = np.cumsum(length) - length
    pos = np.arange(len(parent)) - np.repeat(start, length)
    return parent, pos, lists.values.take(pa.array(np.repeat(off[:-1], length) + pos))


def creator_rows(keys: pa.Array, creators: pa.ListArray) -> Iterator[pa.RecordBatch]:
    """Creators, identifiers and affiliations of a batch of records, with the
    record's key, the creator's position and the item's; null elements are left
    out but keep their position."""
    rec, pos, people = parents(creators)
    there = np.flatnonzero(people.is_valid().to_numpy(zero_copy_only=False))

    def rows(child: str, key: pa.Array, creator_pos: np.ndarray, item_pos: np.ndarray, name: pa.Array | None, kind: pa.Array | None, value: pa.Array | None) -> pa.RecordBatch:
        n = len(creator_pos)
        none = pa.nulls(n, pa.string())
        cols = [key, pa.array([child], pa.string()).take(pa.array(np.zeros(n, np.int64))), pa.array(creator_pos, pa.int32()), pa.array(item_pos, pa.int32()), name, kind, value]
        return pa.RecordBatch.from_arrays([none if c is None else c for c in cols], schema=_CHILD_ARROW)

    here = pa.array(there)
    people, rec, pos = people.take(here), rec[there], pos[there]
    record_keys = keys.take(pa.array(rec))
    yield rows("creator", record_keys, pos, np.full(len(pos), -1), people.field("name"), people.field("name_type"), None)
    for child, field in (("identifier", "identifiers"), ("affiliation", "affiliations")):
        who, item, values = parents(people.field(field))
        keep = np.flatnonzero(values.is_valid().to_numpy(zero_copy_only=False))
        who, item = who[keep], item[keep]
        yield rows(child, record_keys.take(pa.array(who)), pos[who], item, None, None, values.take(pa.array(keep)))


def flatten_creators(df: DataFrame, key: str = "seq", creators: str = "creators") -> DataFrame:
    """Child tables of a creators column, as one table with a child column.

    Null and empty lists at any level give no rows, null elements no row but keep
    their place, '' is a row; repeated records give repeated rows; a null key is
    carried along. Other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield from creator_rows(b.column(0).cast(pa.int64()), b.column(1).cast(CREATORS))

    part = lambda c: F.when(c.isNotNull(), F.struct(*[c[f].alias(f) for f in ("name_type", "name", "identifiers", "affiliations")]))
    return df.select(F.col(key).alias("key"), F.transform(creators, part).alias("creators")).mapInArrow(run, CHILD_ROWS)


def _many(x: object) -> list | None:
    return x if isinstance(x, list) or x is None else [x]


def _valid(s: str) -> str:
    """s with lone surrogates, which JSON can escape but no text can hold, replaced."""
    return s if s.isascii() else s.encode("utf-8", "replace").decode()


def _text(x: object, *fields: str) -> str | None:
    """A scalar as text; of an object the first of the fields it has, else all its texts."""
    if isinstance(x, dict):
        got = [x[f] for f in fields if isinstance(x.get(f), str)]
        return _valid(got[0] if got else ", ".join(v for v in x.values() if isinstance(v, str)))
    if x is None:
        return None
    return _valid(x) if isinstance(x, str) else json.dumps(x)


def _person_name(x: object) -> str | None:
    if isinstance(x, dict) and not isinstance(x.get("name"), str):
        return _valid(", ".join(v for v in (x.get("family"), x.get("given")) if isinstance(v, str)))
    return _text(x, "name")


def canonical_creators(record: object) -> list | None:
    """The creators of one parsed JSON record in the shape of CREATORS."""
    creators = _many(record.get("creators")) if isinstance(record, dict) else None
    if creators is None:
        return None
    out = []
    for c in creators:
        if c is None:
            out.append(None)
            continue
        c = c if isinstance(c, dict) else {"name": c}
        kind = c.get("name_type", c.get("nameType"))
        lists = {}
        for field, inner in (("identifiers", ("value", "identifier")), ("affiliations", ("name",))):
            items = _many(c.get(field))
            lists[field] = None if items is None else [_text(i, *inner) for i in items]
        out.append({"name_type": _text(kind), "name": _person_name(c.get("name"))} | lists)
    return out


def _not_json(_: str) -> None:
    raise ValueError("not in JSON")


def _object(x: Column) -> Column:
    """A variant's fields, null if it is no object."""
    return F.try_variant_get(x, "$", "map<string,variant>")


def _list(x: Column) -> Column:
    """A variant's elements; a single value is a list of one, null none."""
    return F.when(x.isNotNull() & ~F.is_variant_null(x), F.coalesce(F.try_variant_get(x, "$", "array<variant>"), F.array(x)))


def _is_text(x: Column) -> Column:
    return F.schema_of_variant(x) == "STRING"


def _said(x: Column, *fields: str) -> Column:
    """As _text, over variants."""
    o = _object(x)
    first = F.coalesce(*[F.when(_is_text(o[f]), F.try_variant_get(o[f], "$", "string")) for f in fields], F.lit(None).cast("string")) if fields else F.lit(None).cast("string")
    texts = F.transform(F.filter(F.map_values(o), _is_text), lambda v: F.try_variant_get(v, "$", "string"))
    return F.when(x.isNotNull() & ~F.is_variant_null(x), F.when(o.isNotNull(), F.coalesce(first, F.array_join(texts, ", "))).otherwise(F.try_variant_get(x, "$", "string")))


def json_object(line: Column) -> Column:
    """The one JSON object that a line holds, as a variant; null for anything else,
    and for objects with a repeated field or nested too deeply for the parser."""
    # In brackets, so that whatever follows the object makes the line a broken one.
    only = F.try_variant_get(F.try_parse_json(F.concat(F.lit("["), line, F.lit("]"))), "$", "array<variant>")
    return F.when((F.size(only) == 1) & _object(only[0]).isNotNull(), only[0])


def variant_creators(record: Column) -> Column:
    """The creators of a record, whatever their spelling, in the shape of CREATORS."""

    def one(c: Column) -> Column:
        o = _object(c)
        field = lambda *names: F.when(o.isNotNull(), F.coalesce(*[o[n] for n in names]))
        name = F.when(o.isNotNull(), o["name"]).otherwise(c)
        parts = _object(name)
        by_parts = F.concat_ws(", ", *[F.when(_is_text(parts[n]), F.try_variant_get(parts[n], "$", "string")) for n in ("family", "given")])
        said = F.when(parts.isNotNull() & ~F.coalesce(_is_text(parts["name"]), F.lit(False)), by_parts).otherwise(_said(name, "name"))
        items = lambda n, *inner: F.transform(_list(field(n)), lambda x: _said(x, *inner)).alias(n)
        whole = F.struct(_said(field("name_type", "nameType")).alias("name_type"), said.alias("name"), items("identifiers", "value", "identifier"), items("affiliations", "name"))
        return F.when(~F.is_variant_null(c), whole)

    return F.transform(_list(_object(record)["creators"]), one)


def flatten_json_lines(df: DataFrame, key: str = "seq", line: str = "line", canonical: Callable[[object], list | None] | None = None) -> DataFrame:
    """As flatten_creators, from one JSON object per line.

    Null, empty and broken lines, and lines that hold no object, give nothing. A
    single value in place of a list counts as a list of one; names and items may
    be texts or objects. A field given twice counts as given last.

    Lines are parsed in the JVM as variants and brought to one type there. What
    its parser refuses, broken lines and objects with a repeated field, is parsed
    once more here. With canonical, a function from a parsed record to its
    creators, every line is parsed here.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = b.column(0).cast(pa.int64())
            yield from creator_rows(keys, b.column(1).cast(CREATORS))
            rest = pa.array(np.flatnonzero(b.column(2).is_valid().to_numpy(zero_copy_only=False)))
            found = []
            for s in b.column(2).take(rest).to_pylist():
                try:
                    found.append((canonical or canonical_creators)(json.loads(s, parse_constant=_not_json)) if s else None)
                except (ValueError, RecursionError):
                    found.append(None)
            if found:
                yield from creator_rows(keys.take(rest), pa.array(found, CREATORS))

    if canonical:
        parsed = df.select(F.col(key).alias("key"), F.lit(None).cast(_CREATORS_SQL).alias("creators"), F.col(line).alias("rest"))
    else:
        # Carried as one column, so that each line is parsed once.
        parsed = df.select(F.col(key).alias("key"), F.col(line).alias("rest"), json_object(F.col(line)).alias("v"))
        parsed = parsed.select("key", variant_creators(F.col("v")).alias("creators"), F.when(F.col("v").isNull(), F.col("rest")).alias("rest"))
    return parsed.mapInArrow(run, CHILD_ROWS)
