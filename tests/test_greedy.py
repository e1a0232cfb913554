"""Greedy batches over a whole order against the plain loop."""

import random

import pytest

from voxframe.operators.greedy import batch_numbers_over_order, greedy_batches


def plain(rows, budget):
    out, batch, held, longest = [], -1, 0, ()
    for lengths in rows:
        wider = tuple(max(a, b) for a, b in zip(longest, lengths)) if held else lengths
        if held and (held + 1) * sum(wider) <= budget:
            held, longest = held + 1, wider
        else:
            batch, held, longest = batch + 1, 1, lengths
        out.append(batch)
    return out


@pytest.mark.parametrize("block,budget,most", [(1, 30, 9), (7, 60, 9), (16, 500, 4), (64, 40, 200), (1000, 90, 12)])
def test_equals_the_loop_on_any_blocks(spark, block, budget, most):
    draw = random.Random(block)
    rows = [(draw.randint(0, most), draw.choice([0, 1, most])) for _ in range(257)]
    frame = spark.createDataFrame([(i, *r, "x") for i, r in enumerate(rows)], "at long, a int, b long, batch_name string").repartition(5)
    found = batch_numbers_over_order(frame, "at", ["a", "b"], budget, block).orderBy("at").collect()
    assert [r["batch"] for r in found] == plain(rows, budget)


def test_rows_sizes_and_empty_tables(spark):
    frame = spark.createDataFrame([(0, "a", 5), (1, "b", 50), (2, "c", None), (3, "d", 5), (4, "e", 5)], "at long, id string, n int")
    found = {r["batch"]: (r["n"], r["padded_size"], [x["id"] for x in r["rows"]]) for r in greedy_batches(frame, "at", "id", ["n"], 12, 2).collect()}
    assert found == {0: (1, 5, ["a"]), 1: (1, 50, ["b"]), 2: (2, 10, ["c", "d"]), 3: (1, 5, ["e"])}
    assert greedy_batches(frame.limit(0), "at", "id", ["n"], 12).collect() == []
