import hashlib
import math

import pytest
from llm_world import documents, messy_rows

from martkeep.llm import fingerprint


@pytest.mark.parametrize("per_bucket", [3, 2000])
def test_edits_of_every_row(spark, per_bucket):
    rows = messy_rows()
    got = fingerprint.fingerprint_edits(documents(spark), per_bucket=per_bucket).collect()
    line = sorted(((r[0], r[1] or "") for r in rows), key=lambda r: (r[0] is None, -(r[0] or 0), r[1].encode()))
    want = []
    for (i, text), (_, after) in zip(line, line[1:] + line[:1]):
        n = len(text)
        want.append((i, n, hashlib.sha256((text[: n - n // 3] + after[: n // 3]).encode()).hexdigest()))
    assert sorted((tuple(r)[:3] for r in got), key=repr) == sorted(want, key=repr)
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)


def test_equal_texts_and_the_band(spark):
    rows = messy_rows()
    texts = [r[1] for r in rows]
    marks = {}
    for text, mark, other in fingerprint.fingerprint(documents(spark), out="fingerprint").select("text", "fingerprint", "score").collect():
        assert marks.setdefault(text, mark) == mark and other == "clash"
    assert marks[None] == marks[""] == "0"
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    common = fingerprint.common_terms(df, 1.0)
    words = [set((t or "").encode().lower().split()) for t in texts]
    frequent = {w for s in words for w in s if sum(w in o for o in words) > math.exp(-1.0) * len(texts)}
    read = fingerprint.TermReader()
    assert set(common.tolist()) == {int(read(w.decode())[0]) for w in frequent}


def test_likeness_tells_edits_from_others():
    import random

    from llm_world import prose

    rnd = random.Random(4)
    make = fingerprint.Fingerprinter(common=read_nothing())
    near, far = [], []
    for _ in range(60):
        a, b = prose(rnd, 400, 20_000), prose(rnd, 400, 20_000)
        edited = a[: len(a) - len(a) // 3] + b[: len(a) // 3]
        near.append(fingerprint.likeness(make(a), make(edited)))
        far.append(fingerprint.likeness(make(a), make(b)))
        assert fingerprint.likeness(make(a), make(a)) == 1.0
    assert min(near) > max(far) and sum(near) / 60 > 0.25


def read_nothing():
    import numpy as np

    return np.empty(0, np.uint64)


def test_small_tables(spark):
    assert fingerprint.fingerprint_edits(documents(spark, [])).count() == 0
    row = fingerprint.fingerprint_edits(documents(spark, [(1, "abcdef", "en", "a", 6)])).collect()[0]
    assert row["edited_sha256"] == hashlib.sha256(b"abcdab").hexdigest() and row["near_next"] == 1.0


@pytest.mark.parametrize("edits", [0, 4])
def test_a_family_of_a_third_keeps_its_terms(spark, edits):
    import random

    from llm_world import prose

    rnd = random.Random(5)
    bases = [prose(rnd, 150, 4000).split() for _ in range(2)]
    rows = []
    for i in range(300):
        words = list(bases[i % 3]) if i % 3 < 2 else prose(rnd, 150, 4000).split()
        for _ in range(edits if i % 3 < 2 else 0):
            words[rnd.randrange(150)] = f"edit{rnd.randrange(10**6)}"
        rows.append((i, " ".join(words), "en", "a", 1))
    marks = [r["fingerprint"] for r in fingerprint.fingerprint(documents(spark, rows)).orderBy("doc_id").select("fingerprint").collect()]
    assert "0" not in marks
    within = [fingerprint.likeness(marks[i], marks[i + 3]) for i in range(0, 290, 3)]
    across = [fingerprint.likeness(marks[i], marks[i + 1]) for i in range(0, 290, 3)]
    assert sum(within) / len(within) > 0.6 and max(across) < 0.3 and min(within) > max(across)


def test_few_rows_are_told_apart(spark):
    rows = [(i, f"some words of their own a{i} b{i} c{i} d{i} e{i}", "en", "a", 1) for i in range(5)] + [(9, "", "en", "a", 0)]
    marks = {r["doc_id"]: r["fingerprint"] for r in fingerprint.fingerprint(documents(spark, rows)).select("doc_id", "fingerprint").collect()}
    assert len(set(marks.values())) == 6 and marks[9] == "0"


def test_texts_of_common_terms_alone():
    common = fingerprint.TermReader()(" ".join(f"c{i}" for i in range(40)))
    make = fingerprint.Fingerprinter(common, common.astype("int64"))
    assert make("c1 c2 c3") != "0" != make("c4 c5") != make("c1 c2 c3") and make(" ") == "0"
