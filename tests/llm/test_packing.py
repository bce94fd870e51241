import os

import pytest

from siltstone.llm.packing import TOKENIZER, pack, token_counter, token_sizes


def check(rows, sizes, capacity):
    """Every piece once, none overlapping, nothing over capacity, only large items split."""
    held = {}
    for r in rows:
        held.setdefault(r.container, []).append((r.position, r.size))
    for pieces in held.values():
        at = 0
        for pos, size in sorted(pieces):
            assert pos == at
            at += size
        assert at <= capacity
    got = {}
    for r in rows:
        got.setdefault(r.key, []).append((r.piece, r.size))
    want = {k: n for k, n in sizes if n and n > 0}
    assert {k: sum(s for _, s in v) for k, v in got.items()} == want
    for k, v in got.items():
        assert sorted(p for p, _ in v) == list(range(-(-want[k] // capacity)))
    return len(held)


def test_pack(spark):
    sizes = [(i, (i * 7919) % 90 + 1) for i in range(3000)] + [(5000, 1000), (5001, 100), (5002, 0), (5003, None), (5004, -3)]
    df = spark.createDataFrame([(k, n, "x") for k, n in sizes], "key long, n long, container string").repartition(6)
    n = check(pack(df, capacity=100, open_containers=256).collect(), sizes, 100)
    room = []
    for s in sorted((min(100, n - p * 100) for _, n in sizes if n and n > 0 for p in range(-(-n // 100))), reverse=True):
        fit = next((i for i, r in enumerate(room) if r >= s), None)
        if fit is None:
            room.append(100 - s)
        else:
            room[fit] -= s
    assert n <= len(room) * 1.03
    assert check(pack(df, capacity=100, open_containers=8).collect(), sizes, 100) <= len(room) * 1.1


def test_edges(spark):
    df = spark.createDataFrame([(1, 100), (1, 100), (None, 5)], "key long, n long")
    got = pack(df, capacity=100).collect()
    assert len(got) == 3 and len({r.container for r in got}) == 3
    assert pack(df.limit(0), capacity=100).count() == 0


@pytest.mark.skipif(not os.path.exists(TOKENIZER), reason="no vocabulary")
def test_tokens(spark):
    texts = [(1, "Hello world"), (2, None), (3, ""), (4, "<|endoftext|>"), (5, "ab " * 30_000)]
    got = {r.key: r.n for r in token_sizes(spark.createDataFrame([(*t, 1) for t in texts], "doc_id long, text string, n int"), "doc_id", "text").collect()}
    assert set(got) == {1, 4, 5} and got[1] == 2 and got[4] > 1 and got[5] == token_counter(TOKENIZER)(texts[4][1])
