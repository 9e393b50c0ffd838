from __future__ import annotations

import random

import llm_data as data
import pytest

from membertide.llm.common import Scratch
from membertide.llm.components import components


def check(spark, links):
    frame = spark.createDataFrame(links, "a bigint, b bigint")
    found = {r.node: r.root for r in components(frame, Scratch(spark)).collect()}
    nodes = sorted({n for a, b in links for n in (a, b) if a != b})
    at = {n: i for i, n in enumerate(nodes)}
    roots = data.union_find(len(nodes), [(at[a], at[b]) for a, b in links if a != b])
    smallest = {}
    for n in nodes:
        smallest.setdefault(roots[at[n]], n)
    assert found == {n: smallest[roots[at[n]]] for n in nodes}


@pytest.mark.parametrize("shape", ["chain", "shuffled chain", "star", "random", "none"])
def test_components(spark, shape):
    rng = random.Random(2)
    numbers = list(range(-60, 60))
    if shape != "chain":
        rng.shuffle(numbers)
    links = {
        "star": [(numbers[0], n) for n in numbers] + [(5, 5), (5, 5)],
        "random": [(rng.choice(numbers), rng.choice(numbers)) for _ in range(70)],
        "none": [],
    }.get(shape, list(zip(numbers, numbers[1:])))
    check(spark, links)
