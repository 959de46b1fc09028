"""Packing over batches of rows, with groups dealt to one or several ranges."""

import random

import pytest

from quillmill.operators import ordering, packing


def plain(rows, block, size):
    """(part, group, block number, ids) by the definition."""
    out = []
    for part in {r[0] for r in rows}:
        own = sorted(r[1:] for r in rows if r[0] == part)
        for g in range(0, len(own), size):
            flat = [t for _, ids in own[g : g + size] for t in ids or []]
            out += [(part, g // size, b, flat[b * block : (b + 1) * block]) for b in range(len(flat) // block)]
    return sorted(out)


@pytest.mark.parametrize("ranges", [1 << 15, 3, 1])
@pytest.mark.parametrize("by", [[], ["part"]])
def test_packing_equals_the_definition(spark, monkeypatch, ranges, by):
    monkeypatch.setattr(ordering, "MAX_RANGES", ranges)
    rng = random.Random(ranges)
    rows = [("a" if not by or i % 3 else f"p{i % 2}", 7 * i, [rng.randint(0, 99) for _ in range(rng.choice([0, 0, 1, 3, 40]))]) for i in range(157)]
    rows += [(rows[0][0], 5000, None)]
    df = spark.createDataFrame(rows, "part string, k long, input_ids array<int>").repartition(5)
    got = packing.pack_batches(df, 8, ["k"], 10, by, ["input_ids"])
    names = [*by, "group_id", "block_id", "input_ids", "labels"]
    assert got.columns == names
    expected = plain(rows, 8, 10)
    assert sorted((r["part"] if by else "a", r.group_id, r.block_id, r.input_ids) for r in got.collect()) == expected


def test_packing_of_no_rows(spark):
    empty = spark.createDataFrame([], "k long, part string, input_ids array<int>")
    assert packing.pack_batches(empty, 8, ["k"], 10, [], ["input_ids"]).collect() == []
    assert packing.pack_batches(empty, 8, ["k"], 10, ["part"], ["input_ids"]).collect() == []
