"""Ranges of ids against plain sets; intervals merged and met without expanding them."""

import random

import pytest
from conftest import in_order
from pyspark.sql import functions as F

from seqloom.operators import ranges as rg
from seqloom.operators import positions as at


def merged(spans):
    out = []
    for low, high in sorted(spans):
        if out and low <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(out[-1][1], high))
        else:
            out.append((low, high))
    return out


@pytest.mark.parametrize("seed", range(4))
def test_intervals_and_members_equal_sets(spark, monkeypatch, seed):
    monkeypatch.setattr(rg, "BUCKET_INTERVALS", [1, 2, 3, 64][seed])
    monkeypatch.setattr(rg, "MOST_SENT", [0, 1 << 16][seed % 2])
    rng = random.Random(seed)
    wide = [0, 30, 3, 10**9][seed]
    spans = [(a, a + rng.randrange(0, 4)) for a in (rng.randrange(3000) for _ in range(300))]
    spans += [(a, a + wide) for a in (rng.randrange(3000) for _ in range(2))]
    asked = spark.createDataFrame(spans, "low LONG, high LONG")
    assert sorted(tuple(r) for r in rg.disjoint(asked).collect()) == merged(spans)
    numbers = [rng.randrange(-5, 4000) for _ in range(2000)] + [10**9 + 5, None]
    records = spark.createDataFrame([(i, n) for i, n in enumerate(numbers)], "_pos LONG, n LONG")
    got = rg.in_intervals(records, F.col("n"), rg.disjoint(asked))
    want = [i for i, n in enumerate(numbers) if n is not None and any(a <= n <= b for a, b in merged(spans))]
    assert sorted(r["_pos"] for r in got.collect()) == want


def test_range_members_of_listed_texts(spark):
    asked = spark.createDataFrame([("GSM5:GSM7,GSM9",), ("GSM6",), ("GSM100:GSM2000000000",), ("GSM8:GSM3",), ("SRR1",), ("",), (None,)], "ids STRING")
    ids = ["GSM4", "GSM5", "GSM7", "GSM8", "GSM9", "GSM99", "GSM100", "GSM1999999999", "GSM2000000001", "SRR1", "GSM", "GSM6x", None]
    records = spark.createDataFrame([(i, v) for i, v in enumerate(ids)], "_pos LONG, v STRING")
    found = rg.range_members(records, "v", asked, "ids")
    assert in_order(at.compact(found)) == ["GSM5", "GSM7", "GSM9", "GSM100", "GSM1999999999"]
    assert in_order(at.reverse(found))[0] == "GSM1999999999"  # gaps are noted
    nothing = spark.createDataFrame([], "ids STRING")
    assert rg.range_members(records, "v", nothing, "ids").collect() == []
