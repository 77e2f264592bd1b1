import random
from collections import defaultdict

import numpy as np
import pytest
from llm_world import brute_groups, documents, messy_rows, prose

from martkeep.llm import jaccard
from martkeep.llm.common import staged
from martkeep.llm.components import connected_components


def grouped(df, width, percent):
    rows = jaccard.jaccard_groups(df, width, percent).collect()
    nodes = defaultdict(set)
    for row in rows:
        if row["node"] is not None:
            nodes[row["node"]].add(row["component_id"])
    # Components of different texts under one doc_id have nodes of their own.
    assert all(len(ids) == 1 for ids in nodes.values())
    return sorted([tuple(row)[:3] for row in rows], key=repr)


@pytest.mark.parametrize(("width", "percent"), [(4, 85), (5, 80), (1, 50)])
def test_groups_are_those_of_all_pairs(spark, width, percent):
    rows = messy_rows()
    assert grouped(documents(spark), width, percent) == brute_groups([r[:2] for r in rows], width, percent)


@pytest.mark.parametrize(("broadcast", "rounds"), [(0, 0), (1000, 1), (1000, 2)])
def test_common_passages_and_a_large_family(spark, monkeypatch, broadcast, rounds):
    monkeypatch.setattr(jaccard, "BROADCAST_SETS", broadcast)
    monkeypatch.setattr(jaccard, "PIVOTS", rounds)
    monkeypatch.setattr(jaccard, "RUN", 20)
    monkeypatch.setattr(jaccard, "HEAVY_LEAST", 8)
    monkeypatch.setattr(jaccard, "BLOCK_DOCS", 7)
    monkeypatch.setattr(jaccard, "CHUNK", 16)
    rnd = random.Random(5)
    passage, base = prose(rnd, 60, 5000), prose(rnd, 80, 5000).split()
    rows = [(i, f"{prose(rnd, 40, 5000)} {passage}") for i in range(40)]
    for i in range(40, 110):
        copy = list(base)
        for _ in range(rnd.randrange(5)):
            copy[rnd.randrange(len(copy))] = f"edit{rnd.randrange(50)}"
        rows.append((i, " ".join(copy)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert grouped(df, 4, 85) == brute_groups(rows, 4, 85)


def test_chains_of_links_are_followed(spark):
    """Neighbours link, sets further apart do not: no pivot ties such a family at once."""
    rnd = random.Random(9)
    words = [f"c{i}" for i in range(400)]
    rows = [(i, " ".join(words[2 * i : 2 * i + 100])) for i in range(120)] + [(200 + i, prose(rnd, 50, 3000)) for i in range(30)]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = brute_groups(rows, 4, 85)
    assert grouped(df, 4, 85) == want and len({component for _, _, component in want}) == 31


def _family(n, rnd):
    base, out = prose(rnd, 150, 50_000).split(), []
    for i in range(n):
        copy = list(base)
        for _ in range(rnd.randrange(2)):
            copy[rnd.randrange(len(copy))] = f"edit{i}x{rnd.randrange(9)}"
        out.append((i, " ".join([*copy, f"end{i}"])))
    return out


def test_the_work_grows_with_the_sets_of_a_family(spark, monkeypatch):
    made = {}

    def counting(df, purpose):
        out = staged(df, purpose)
        if purpose in ("jaccard-links", "jaccard-pairs", "jaccard-families-placed"):
            made[purpose] = made.get(purpose, 0) + out.count()
        return out

    monkeypatch.setattr(jaccard, "staged", counting)
    rows = []
    for n in (300, 600, 1200):
        made.clear()
        df = spark.createDataFrame(_family(n, random.Random(n)), "doc_id long, text string").repartition(4)
        assert {row[2] for row in grouped(df, 4, 85)} == {0}
        rows.append(sum(made.values()))
    assert rows[1] < 2.6 * rows[0] and rows[2] < 2.6 * rows[1], rows


def test_sketches_tell_long_sets_apart_and_keep_linked_ones():
    import pyarrow as pa

    rnd = np.random.default_rng(2)

    def pairs(sets, percent):
        rows = [(1, 0, 0, 0, i, len(g), jaccard.sketch(g)) for i, g in enumerate(sets)]
        names = ["cluster", "i", "j", "side", "sid", "n", "sketch"]
        batch = pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows])
        found = [b.to_pylist() for b in jaccard._possible(percent)(iter([batch]))]
        return {(r["a"], r["b"]) for some in found for r in some}

    for size in (40, 150, 1000, 2000, 20_000, 300_000):
        unrelated = [np.unique(rnd.integers(0, 1 << 63, size).astype(np.uint64) << np.uint64(1)) for _ in range(6)]
        assert not pairs(unrelated, 80), size
        for percent in (80, 85):
            base = unrelated[0]
            more = int(len(base) * (100 - percent) / percent)  # a set and one that holds it, just linked
            longer = np.unique(np.concatenate([base, rnd.integers(0, 1 << 63, more).astype(np.uint64)]))
            both = len(np.intersect1d(base, longer))
            assert 100 * both >= percent * len(longer) and pairs([base, longer, unrelated[1]], percent) == {(1, 0)}


def test_signatures_of_the_same_sets_become_one_group(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(jaccard, "RUN", 5)
    rnd = random.Random(3)
    members = {sig: sorted(rnd.sample(range(40), rnd.choice((1, 1, 2, 3, 9, 30)))) for sig in range(60)}
    members |= {100: [1, 2, 3], 101: [1, 2, 3], 102: [4, 4, 4]}
    rows = [(sig, sid) for sig in sorted(members) for sid in members[sig] for _ in range(rnd.choice((1, 1, 2)))]
    for step in (1, 3, 7, 1000):
        batches = [pa.RecordBatch.from_pydict({"sig": [r[0] for r in rows[i : i + step]], "sid": [r[1] for r in rows[i : i + step]]}) for i in range(0, len(rows), step)]
        groups = defaultdict(set)
        for batch in jaccard._runs(iter(batches)):
            for sig, sid in zip(*(c.to_pylist() for c in batch.columns)):
                groups[sig].add(sid)
        want = {frozenset(sids) for sids in members.values() if len(set(sids)) > 1}
        assert {frozenset(sids) for sids in groups.values()} == want
        assert len(groups) == len({frozenset(s) for s in members.values() if 1 < len(set(s)) <= 5}) + sum(len(set(s)) > 5 for s in members.values())


def test_empty_table(spark):
    assert grouped(documents(spark, []), 4, 85) == []


def test_linked_sets_share_a_signature():
    rnd = np.random.default_rng(1)
    heavy = np.sort(rnd.integers(0, 1 << 63, 200).astype(np.uint64))
    for percent in (60, 85):
        for size in (1, 2, 3, 7, 8, 15, 16, 60, 127, 128, 300):
            for _ in range(60):
                common = rnd.integers(0, 1 << 63, size).astype(np.uint64)
                if rnd.random() < 0.5:
                    common[: size * 9 // 10] = heavy[: min(200, size * 9 // 10)][: len(common[: size * 9 // 10])] if size * 9 // 10 <= 200 else common[: size * 9 // 10]
                more = int(size * (100 - percent) / percent)
                spare = rnd.integers(0, 1 << 63, more).astype(np.uint64)
                cut = int(rnd.integers(0, more + 1))
                a = np.unique(np.concatenate([common, spare[:cut]]))
                b = np.unique(np.concatenate([common, spare[cut:]]))
                both = len(np.intersect1d(a, b))
                if 100 * both >= percent * (len(a) + len(b) - both):
                    assert len(np.intersect1d(jaccard.signatures(a, heavy, percent), jaccard.signatures(b, heavy, percent)))


def test_linked_sets_share_as_many_signatures_of_a_kind_as_said():
    rnd = np.random.default_rng(4)
    heavy = np.sort(rnd.integers(0, 1 << 63, 300).astype(np.uint64))
    tried = 0
    for percent in (50, 80, 85):
        for size in (1, 2, 5, 7, 8, 31, 60, 100, 127, 128, 250, 255, 300, 520):
            for _ in range(60):
                common = rnd.integers(0, 1 << 63, size).astype(np.uint64)
                often = min(300, int(size * rnd.choice([0, 0, 0.5, 0.9, 1])))
                common[:often] = rnd.permutation(heavy)[:often]
                spare = rnd.integers(0, 1 << 63, int(size * (100 - percent) / percent)).astype(np.uint64)
                cut = int(rnd.integers(0, len(spare) + 1))
                a, b = (np.unique(np.concatenate([common, more])) for more in (spare[:cut], spare[cut:]))
                both = len(np.intersect1d(a, b))
                if 100 * both >= percent * (len(a) + len(b) - both):
                    one, two = ({kind: (least, found) for kind, least, found in jaccard.kinds(g, heavy, percent)} for g in (a, b))
                    assert all(least >= 1 for least, _ in (*one.values(), *two.values()))
                    shared = {k: len(np.intersect1d(one[k][1], two[k][1])) - max(one[k][0], two[k][0]) for k in one.keys() & two.keys()}
                    assert max(shared.values()) >= 0, (percent, size, shared)
                    tried += 1
    assert tried > 2000


def _compared(spark, monkeypatch, rows):
    """Groups of ``rows``, and how many rows the pairs of blocks of the signatures left over take."""
    made = []

    def counting(df, purpose):
        out = staged(df, purpose)
        if purpose == "jaccard-clusters-placed":
            made.append(out.selectExpr("sum(size(others))").first()[0] or 0)
        return out

    monkeypatch.setattr(jaccard, "staged", counting)
    monkeypatch.setattr(jaccard, "BLOCK_DOCS", 8)
    got = grouped(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), 5, 80)
    return got, sum(made)


def test_passages_that_chain_unlike_texts_do_not_bring_them_together(spark, monkeypatch):
    """Each text shares a line with some others, so all hang together, and none is like another."""
    n, rnd = 400, random.Random(4)
    lines = [" ".join(f"l{i}w{k}" for k in range(8)) for i in range(n // 2)]
    rows = [(i, " ".join([prose(rnd, 60, 50_000), *rnd.sample(lines, 2), prose(rnd, 60, 50_000)])) for i in range(n)]
    rows.append((n, rows[7][1] + " more"))
    got, placed = _compared(spark, monkeypatch, rows)
    assert got == brute_groups(rows, 5, 80) and sum(i != component for i, _, component in got) == 1
    assert placed <= n, placed


def test_likeness_that_goes_from_text_to_text_is_compared_by_signature(spark, monkeypatch):
    """Neighbours share much and do not link; compared in blocks, all with all, the rows grow with the square."""
    work = []
    for n in (60, 240):
        words = [f"c{i}" for i in range(8 * n + 200)]
        rows = [(i, " ".join(words[8 * i : 8 * i + 60])) for i in range(n)] + [(n, " ".join([*words[:60], "more"]))]
        got, placed = _compared(spark, monkeypatch, rows)
        assert got == brute_groups(rows, 5, 80) and sum(i != component for i, _, component in got) == 1
        work.append(placed)
    assert work[0] and work[1] < 5.2 * work[0], work


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 2000 + i) for i in range(50)] + [(5, 5), (None, 3), (7, None)] + [(3000, 3001)] * 4
    got = dict(map(tuple, connected_components(spark.createDataFrame(edges, "a long, b long").repartition(6)).collect()))
    assert got == {**{i: 0 for i in range(201)}, **{2000 + i: 1000 for i in range(50)}, 1000: 1000, 3000: 3000, 3001: 3000}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_edges_that_are_contracted_were_written_down(spark, monkeypatch):
    """Contracting edges is a Python step: it must not share its tasks with another."""
    plans = []

    def contracting(edges, purpose="components"):
        plans.append(edges._jdf.queryExecution().optimizedPlan().toString())
        return connected_components(edges, purpose)

    monkeypatch.setattr(jaccard, "connected_components", contracting)
    monkeypatch.setattr(jaccard, "PIVOTS", 0)
    rnd = random.Random(3)
    base = prose(rnd, 80, 3000)
    rows = [(i, f"{base} {prose(rnd, 3, 3000)}") for i in range(12)] + [(20 + i, prose(rnd, 40, 3000)) for i in range(8)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert grouped(df, 4, 85) == brute_groups(rows, 4, 85)
    assert len(plans) > 2 and not any("MapInArrow" in plan for plan in plans)
