"""What the driver holds of plans: each star step shuffles once, and the rank map's plan has one version."""

import random

import pytest
from tessera.llm import bpe, components, mapped, shared


def _roots(links):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in root}


def _links():
    draw = random.Random(5)
    path, star = [(k, k + 1) for k in range(40)], [(1000, 1001 + k) for k in range(60)]
    return path + star + [(draw.randrange(2000, 2100), draw.randrange(2000, 2100)) for _ in range(80)] + [(3000, 3000)]


def test_no_step_of_components_repeats_its_shuffles(spark, monkeypatch):
    seen, write = [], shared._written

    def spied(df, path):
        seen.append(str(df._jdf.queryExecution().executedPlan()).count("Exchange hashpartitioning"))
        return write(df, path)

    monkeypatch.setattr(shared, "_written", spied)
    links = _links()
    got = components.components(spark.createDataFrame(links, "x long, y long"), "x", "y").collect()
    assert {r.node: r.root for r in got} == _roots([x for x in links if x[0] != x[1]]) and len(got) == len({r.node for r in got})
    assert len(seen) > 3 and max(seen) <= 3


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_the_rank_map_is_planned_once(spark, documents, monkeypatch, adaptive):
    seen, build = [], mapped.build

    def spied(df, *args, **how):
        seen.append(spark.conf.get("spark.sql.adaptive.enabled"))
        return build(df, *args, **how)

    monkeypatch.setattr(mapped, "build", spied)
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        ranks = {bytes([k]): k for k in range(256)} | {b"ab": 256, b"abc": 257}
        found = bpe.dictionary(documents([(1, "abc ab"), (2, None)]), ranks, "[a-z]+| ")
        assert seen == ["false"] and spark.conf.get("spark.sql.adaptive.enabled") == adaptive
        assert found.sizes.sum() == 3
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
