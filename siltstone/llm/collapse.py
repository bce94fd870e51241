"""Records that differ only in formatting, collapsed.

Columns are dictionary-encoded: of each Arrow batch every distinct value is
canonicalised once and given a 128-bit integer identifier made from its
canonical form, so equal values get equal identifiers on every executor without
a shared dictionary to join. A record becomes the tuple of its (field,
identifier) pairs sorted by field, which is what is grouped; strings are never
shuffled. Groups are found by partial aggregation and joined back, so that a
group with a third of all rows is never gathered in one task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.runtime import materialise

Canonical = Callable[[pa.Array], pa.Array]


def letters_and_digits(values: pa.Array) -> pa.Array:
    """Letters and digits only, without case."""
    return pc.replace_substring_regex(pc.utf8_lower(values), r"[^\p{L}\p{N}]", "")


def link_letters_and_digits(values: pa.Array) -> pa.Array:
    """As letters_and_digits, the &-parts behind the first ? in sorted order."""
    out = letters_and_digits(values)
    several = np.flatnonzero(pc.match_substring_regex(values, r"\?[^&]*&").to_numpy(zero_copy_only=False))
    if not len(several):
        return out
    heads, parts, sizes = [], [], []
    for v in values.take(pa.array(several)).to_pylist():
        head, _, query = v.partition("?")
        heads.append(head)
        found = query.split("&")
        parts += found
        sizes.append(len(found))
    heads, parts = (letters_and_digits(pa.array(x, pa.string())).to_pylist() for x in (heads, parts))
    sorted_links, at = [], 0
    for h, n in zip(heads, sizes):
        sorted_links.append(h + "".join(sorted(parts[at : at + n])))
        at += n
    mask = np.zeros(len(values), bool)
    mask[several] = True
    return pc.replace_with_mask(out, pa.array(mask), pa.array(sorted_links, out.type))


def _ids(values: pa.Array, canonical: Canonical) -> tuple[np.ndarray, np.ndarray]:
    """Identifier of each value as 16 bytes, and whether it has one."""
    coded = values.dictionary_encode()
    forms = canonical(coded.dictionary.cast(pa.string())).to_pylist()
    known = np.array([bool(f) for f in forms] + [False])
    ids = np.frombuffer(b"".join(xxhash.xxh3_128_digest(f or "") for f in forms) + bytes(16), "V16")
    at = pc.fill_null(coded.indices, len(forms)).to_numpy(zero_copy_only=False)
    return ids[at], known[at]


def encode_records(df: DataFrame, key: str, fields: dict[str, Canonical]) -> DataFrame:
    """(key, hi, lo): each record's tuple of field identifiers, folded into 128 bits.

    Records with a field that is null or has nothing left in its canonical form
    are left out.
    """
    names = sorted(fields)
    canon = [fields[n] for n in names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols = [_ids(b.column(i + 1), c) for i, c in enumerate(canon)]
            there = np.logical_and.reduce([ok for _, ok in cols])
            tuples = np.stack([ids.view(np.uint8).reshape(-1, 16) for ids, _ in cols], axis=1)[there]
            raw, width = tuples.tobytes(), 16 * len(cols)
            folded = b"".join(xxhash.xxh3_128_digest(raw[i : i + width]) for i in range(0, len(raw), width))
            two = np.frombuffer(folded, "<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([b.column(0).filter(pa.array(there)).cast(pa.int64()), pa.array(two[:, 0]), pa.array(two[:, 1])], names=["key", "hi", "lo"])

    return df.select(key, *names).mapInArrow(run, "key long, hi long, lo long")


def _groups(encoded: DataFrame) -> DataFrame:
    return encoded.groupBy("hi", "lo").agg(F.min("key").alias("first"), F.count("*").alias("copies"))


def collapse(df: DataFrame, key: str, fields: dict[str, Canonical]) -> DataFrame:
    """(first, copies): one row for each distinct record, by its smallest key.

    Records without one of the fields are not counted; repeated keys count as
    copies; an empty table gives an empty result.
    """
    return _groups(encode_records(df, key, fields)).select("first", "copies")


def copies(df: DataFrame, key: str, fields: dict[str, Canonical]) -> DataFrame:
    """(first, copy): each record behind the first of its group, with the group's smallest key."""
    # 24 bytes a record, written once: both sides read them, the strings are read once.
    encoded = materialise(encode_records(df, key, fields), "record-tuples")
    several = _groups(encoded).where("copies > 1").select("hi", "lo", "first")
    return encoded.join(several, ["hi", "lo"]).where("key > first").select("first", F.col("key").alias("copy"))
