import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest
from llm_world import documents, messy_rows
from pyspark.sql import functions as F

from martkeep.llm import brown


def tokens(text):
    return [*(text or "").encode("utf-8").lower().split(), "end"]


def held_out(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


@pytest.mark.parametrize("listed", [10, 1 << 18])
def test_counts_and_base_scores_are_exact(spark, listed):
    df, rows = documents(spark), messy_rows()
    train = [r[1] for r in rows if not held_out(r[0])]
    model = brown.train_brown(spark.createDataFrame([(t,) for t in train], "text string").repartition(3), listed, clustered=20, classes=4, rounds=2)
    count = Counter(t for text in train for t in tokens(text))
    total, words = sum(count.values()), len(count)
    assert (model.train_tokens, model.vocabulary) == (total, words)
    got = brown.score_texts(df.select("doc_id", "text", "score", "kept"), model).collect()
    want = Counter()
    for i, text, *_ in rows:
        w = tokens(text)
        base = sum(math.log10((count[t] + 1) / (total + words + 1)) for t in w)
        want[i, len(w), sum(count[t] > 0 for t in w), round(base, 4)] += 1
    assert Counter((r["doc_id"], r["n_tokens"], r["n_known"], round(r["base_score"], 4)) for r in got) == want
    assert all(math.isfinite(r["score"]) and r["score"] < 0 and r["kept"] == "clash" for r in got)


def test_probabilities_sum_to_one(spark):
    texts = [(r[1],) for r in messy_rows()]
    model = brown.train_brown(spark.createDataFrame(texts, "text string"), clustered=30, classes=5, rounds=2)
    assert np.allclose((10**model.transition).sum(axis=1), 1, atol=1e-3)
    classes = len(model.transition) - brown.SHAPES
    sums = np.bincount(model.classes, weights=10**model.emission, minlength=len(model.transition))
    for c in range(classes):
        assert sums[c] == pytest.approx(1, abs=1e-9) or sums[c] == 0
    for s in range(brown.END):
        if model.shape_tokens[s] > 0:  # the rest is for unknown words
            assert sums[classes + s] + model.discount * model.shape_words[s] / model.shape_tokens[s] == pytest.approx(1, abs=1e-6)


def test_exchange_finds_the_classes_and_beats_words(spark):
    rnd = random.Random(3)
    nouns, verbs = [f"n{i}" for i in range(40)], [f"v{i}" for i in range(40)]

    def text():
        return " ".join(x for _ in range(20) for x in (rnd.choice(nouns), rnd.choice(verbs)))

    train = spark.createDataFrame([(text(),) for _ in range(300)], "text string")
    model = brown.train_brown(train, clustered=80, classes=2, rounds=6)
    reader = brown.TokenReader()
    of = dict(zip(model.codes.tolist(), model.classes.tolist()))
    kinds = [{of[int(reader(w)[0])] for w in words} for words in (nouns, verbs)]
    assert len(kinds[0]) == len(kinds[1]) == 1 and kinds[0] != kinds[1]
    new = spark.createDataFrame([(i, text()) for i in range(50)], "doc_id long, text string")
    rows = brown.score_texts(new, model).collect()
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows) * 0.9


def test_nothing_to_learn_from_and_nothing_to_score(spark):
    empty = spark.createDataFrame([], "text string")
    model = brown.train_brown(empty)
    rows = brown.score_texts(documents(spark).select("doc_id", "text"), model).collect()
    assert len(rows) == len(messy_rows()) and all(math.isfinite(r["score"]) and r["n_known"] == r["train_tokens"] == 0 for r in rows)
    assert brown.score_texts(documents(spark, []).select("doc_id", "text"), model).count() == 0


def test_frequent_words_beyond_the_seeds_get_classes_too(spark):
    rnd = random.Random(8)
    kinds = [[f"n{i}" for i in range(150)], [f"verb{i}," for i in range(150)]]

    def text():
        return " ".join(kind[int(rnd.random() ** 1.5 * 150)] for _ in range(20) for kind in kinds)

    train = spark.createDataFrame([(text(),) for _ in range(400)], "text string").repartition(3)
    model = brown.train_brown(train, clustered=40, classes=2, rounds=6, classed_least=5)
    read, of = brown.TokenReader(), dict(zip(model.codes.tolist(), model.classes.tolist()))
    found = [[of[int(read(w)[0])] for w in kind if int(read(w)[0]) in of] for kind in kinds]
    learned = [[c for c in some if c < 2] for some in found]
    assert all(len(some) > 140 and len(set(some)) == 1 for some in learned) and learned[0][0] != learned[1][0]
    classed = model.classes < 2
    assert model.counts[classed].sum() > 0.94 * model.train_tokens
    assert np.allclose((10**model.transition).sum(axis=1), 1, atol=1e-3)


def test_share_of_tokens_in_learned_classes(spark):
    texts = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text")
    model = brown.train_brown(texts, rounds=2)
    share = model.counts[model.classes < brown.CLASSES].sum() / model.train_tokens
    seeds = brown.train_brown(texts, rounds=2, classed_least=1 << 40)
    assert share > 0.6 > seeds.counts[seeds.classes < brown.CLASSES].sum() / seeds.train_tokens


def test_classes_are_chosen_by_the_likelihood_of_all_pairs():
    """The gain of each class, against the likelihood counted anew with the word in it."""
    rnd = np.random.default_rng(3)
    n, size = 4, 4 + brown.SHAPES
    for _ in range(20):
        rest, now = rnd.integers(1, 50, (size, size)).astype(float), n + rnd.integers(0, 5)
        left, right = rnd.integers(0, 30, size), rnd.integers(0, 30, size)
        left[now] = right[now] = 0  # no neighbour of the word's own shape, so that counts are plain

        def with_word(c):
            m = rest.copy()
            m[c] += right
            m[:, c] += left
            return m

        values = [brown.likelihood(with_word(b)) for b in range(n)]
        assert brown.best_classes(left[None], right[None], np.array([now]), with_word(now), n)[0] == int(np.argmax(values))


@pytest.mark.parametrize("known", [3, 400_000])
def test_tasks_that_forget_words_count_the_same(spark, monkeypatch, known):
    monkeypatch.setattr(brown, "KNOWN_WORDS", known)
    texts = [r[1] for r in messy_rows()]
    want = Counter(t for text in texts for t in tokens(text))
    rows = brown.count_words(spark.createDataFrame([(t,) for t in texts], "text string").repartition(2)).collect()
    assert sorted(r["n"] for r in rows) == sorted(want.values())


def test_texts_are_read_once(spark):
    read = spark.sparkContext.accumulator(0)

    def text(i):
        read.add(1)
        return f"a{i % 7} b{i % 3} c{i % 7}. d e"

    texts = spark.range(0, 200, 1, 2).select(F.udf(text, "string")("id").alias("text"))
    model = brown.train_brown(texts, clustered=5, classes=2, rounds=1, classed_least=2)
    assert model.train_tokens == 1200 and read.value == 200


@pytest.mark.parametrize("piece", [1, 7, 1 << 14])
def test_numbered_texts_hold_every_token(spark, monkeypatch, piece):
    monkeypatch.setattr(brown, "PIECE", piece)
    long = " ".join(f"w{i % 70_000}" for i in range(70_500))  # more words than two bytes can number
    texts = ["a b a", None, "", "B a", "c" * 40, long, "a"]
    rows = brown.numbered_texts(spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1)).select(*brown.PACKED).toArrow()
    got = [codes[numbers] for batch in rows.to_batches() for codes, numbers in brown._pieces(batch)]
    reader = brown.TokenReader()
    assert np.array_equal(np.concatenate(got), np.concatenate([reader(t) for t in texts]))
    assert all(piece[-1] == brown.END for piece in got)


def test_numbered_texts_come_in_small_row_groups(spark):
    rnd = random.Random(5)
    texts = [" ".join(f"w{rnd.randrange(20_000)}" for _ in range(2000)) for _ in range(300)]
    numbered = brown.numbered_texts(spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1))
    groups = []
    for path in numbered.inputFiles():
        data = pq.ParquetFile(path.removeprefix("file://")).metadata
        groups += [data.row_group(i).total_byte_size for i in range(data.num_row_groups)]
    assert sum(groups) > 3 << 20 and max(groups) < 2 << 20
