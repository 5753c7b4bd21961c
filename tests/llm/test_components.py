"""Connected components against merging sets one link at a time."""

import random

from gristmill.llm import components


def merged(links):
    of = {}
    for a, b in links:
        if a != b:
            group = of.get(a, {a}) | of.get(b, {b})
            of.update(dict.fromkeys(group, group))
    return {(i, min(group)) for i, group in of.items()}


def links(rng):
    pairs = [(i, i + 1) for i in range(100)] + [(1000 + i, 2000) for i in range(50)]
    clique = rng.sample(range(3000, 4000), 25)
    pairs += [(a, b) for a in clique for b in clique] + [(5000 + 7 * i % 60, 5000 + 7 * (i + 1) % 60) for i in range(60)]
    pairs += [(rng.randrange(6000, 6400), rng.randrange(6000, 6400)) for _ in range(200)] + [(7, 7), (8000, 8000)]
    rng.shuffle(pairs)
    return [(b, a) if rng.random() < 0.5 else (a, b) for a, b in pairs]


def test_components_and_links_read_again(spark, monkeypatch):
    pairs, kept, seen = links(random.Random(3)), components.stored, []

    def stored(df, name):
        out = kept(df, name)
        if name == "links":
            seen.append(out.count())
        return out

    monkeypatch.setattr(components, "stored", stored)
    got = components.connected_components(spark.createDataFrame(pairs, "a long, b long"))
    assert {tuple(r) for r in got.collect()} == merged(pairs)
    assert len(seen) < 8  # a chain of a hundred ids takes no round per link
    assert len(seen) > 1 and sum(seen[1:]) < seen[0]  # later rounds read fewer links, not all again


def test_no_links(spark):
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
