"""Rounds of components."""

import os

from fieldweave.llm import graph


def test_a_star_goes_in_one_round(spark):
    """Stars and cliques, as groups of copies give them, shrank by half in a round only."""
    rounds = lambda: len([n for n in os.listdir(f"{folder}/fieldweave") if n.startswith("graph-heads-")]) if os.path.isdir(f"{folder}/fieldweave") else 0
    folder = spark.conf.get("spark.checkpoint.dir")
    links = [(0, i) for i in range(1, 500)] + [(1000 + i, 1000 + j) for i in range(30) for j in range(i)]
    before = rounds()
    found = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert len(found) == 530 and len(set(found.values())) == 2 and found[0] == found[499] != found[1000] == found[1029]
    assert rounds() - before == 1
