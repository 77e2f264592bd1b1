from collections import defaultdict

from pyspark.sql import functions as F
from llm_world import documents, messy_rows, prose

from martkeep.llm import mixing


def brute_targets(sizes):
    """Water filling by rounds: share out, stop the full, share out the excess."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, left, open_ = dict.fromkeys(names, 0.0), float(sum(sizes.values())), set(names)
    while left > 1e-9 and open_:
        total, rest = sum(weight[s] for s in open_), 0.0
        for s in list(open_):
            target[s] += left * weight[s] / total
            if target[s] >= 3 * sizes[s]:
                rest += target[s] - 3 * sizes[s]
                target[s] = 3.0 * sizes[s]
                open_.discard(s)
        left = rest
    return target


def check(spark, rows):
    df = documents(spark, rows)
    got = mixing.mix_sources(df)
    out = got.collect()
    assert len(out) == len(rows)
    sizes, taken, largest = defaultdict(int), defaultdict(int), defaultdict(int)
    units = mixing.mix_units(mixing.sized_documents(df)).collect()
    for u in units:
        sizes[u["source"]] += u["size"] * u["n"]
        taken[u["source"]] += u["copies"] * u["size"] * u["n"]
        largest[u["source"]] = max(largest[u["source"]], u["size"] * u["n"])
        assert 0 <= u["copies"] <= 3
    want = brute_targets(sizes)
    for u in units:
        assert abs(u["target"] - want[u["source"]]) < 1e-6 * max(1, want[u["source"]])
    for s in sizes:
        assert abs(taken[s] - want[s]) <= largest[s] + 1e-6, s
    assert sum(r["taken"] for r in out) == sum(taken.values())
    again = mixing.mix_sources(df.repartition(7)).collect()
    assert sorted(map(tuple, again), key=repr) == sorted(map(tuple, out), key=repr)


def test_messy_rows(spark):
    check(spark, messy_rows())


def test_sources_that_fill_up_and_many_levels(spark, monkeypatch):
    import random

    monkeypatch.setattr(mixing, "CHUNK", 4)
    rnd = random.Random(2)
    rows = [(i, prose(rnd, rnd.randrange(1, 60)), "en", f"s{0 if i % 3 else i % 10}", 1) for i in range(400)] + [(1000, "few words", "en", "a", 1)]
    check(spark, rows)


def test_everything_is_left_to_chance_fairly(spark):
    rows = [(i, "w " * 10, "en", "a" if i < 500 else "b", 1) for i in range(1000)]
    counts = mixing.mix_sources(documents(spark, rows)).groupBy("target").agg(F.count("*"), F.sum("taken"), F.min("copies"), F.max("copies")).collect()
    for target, n, taken, low, high in counts:
        assert n == 500 and abs(taken - target) <= 10 and high - low == 1


def test_empty_and_wordless(spark):
    assert mixing.mix_sources(documents(spark, [])).count() == 0
    assert [tuple(r) for r in mixing.mix_sources(documents(spark, [(1, None, "en", None, 0)])).select("doc_id", "taken", "target").collect()] == [(1, 0, 0.0)]


def test_no_python_in_the_plan(spark):
    plan = mixing.mix_sources(documents(spark, clashing=False))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
