import random

from quarry.llm.graph import connected_components


def smallest_reachable(edges):
    label = {v: v for e in edges if None not in e and e[0] != e[1] for v in e}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            if a in label and b in label and a != b and label[a] != label[b]:
                label[a] = label[b] = min(label[a], label[b])
                changed = True
    return label


def check(spark, edges):
    df = spark.createDataFrame(edges, "a long, b long")
    rows = connected_components(df).collect()
    assert len(rows) == len({r.id for r in rows})
    assert {r.id: r.label for r in rows} == smallest_reachable(edges)


def test_chain_star_loops_nulls_and_repeats(spark):
    chain = [(i, i + 1) for i in range(1, 12)]
    star = [(100, i) for i in range(50, 60)]
    check(spark, chain + star + [(7, 7), (None, 3), (200, None), (51, 100), (2, 1)])


def test_no_edges(spark):
    check(spark, [])


def test_random_graph(spark):
    rng = random.Random(7)
    check(spark, [(rng.randrange(300), rng.randrange(300)) for _ in range(180)])
