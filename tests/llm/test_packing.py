"""The bit packing by itself: exact round trips and random access."""

import numpy as np
import pytest
from folioframe.llm import tokenbin
from folioframe.llm.components import components
from hypothesis import given, settings
from hypothesis import strategies as st


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 32), st.integers(0, 700), st.integers(0, 2**32 - 1), st.data())
def test_round_trip(bits, n, seed, data):
    ids = np.random.default_rng(seed).integers(0, 2**bits, n, dtype=np.uint64).astype(np.uint32)
    packed = tokenbin.pack(ids, bits)
    assert len(packed) == 8 * -(-n * bits // 64)
    assert (tokenbin.unpack(packed, bits, 0, n) == ids).all()
    a = data.draw(st.integers(0, n))
    b = data.draw(st.integers(a, n))
    assert (tokenbin.unpack(packed, bits, a, b) == ids[a:b]).all()


def test_shards_check_themselves():
    raw = tokenbin._shard(3, 1, 10, [5, 6], [np.array([1, 2, 0], "<u4").tobytes(), np.array([0], "<u4").tobytes()], 16) + b"\n"
    shard = tokenbin.Shard(raw)
    assert (shard.partition, shard.number, shard.before, shard.n_ids) == (3, 1, 10, 4)
    assert shard.document(0).tolist() == [1, 2, 0] and shard.document(1).tolist() == [0]
    with pytest.raises(ValueError):
        tokenbin.Shard(raw[:-9])
    with pytest.raises(ValueError):
        tokenbin.Shard(b"x" * 60)


def test_components_of_paths_and_stars(spark):
    import random

    r = random.Random(4)
    names = list(range(1000))
    r.shuffle(names)
    edges = list(zip(names[:400], names[1:401], strict=False)) + [(names[500], x) for x in names[501:700]] + [(3, 3), (names[800], names[801]), (names[801], names[800])]
    up = {x: x for e in edges for x in e}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    got = {x["node"]: x["component"] for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: root(x) for x in got} and len(got) >= 601
