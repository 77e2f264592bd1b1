import random

import pytest
from pyspark.sql import functions as F
from llm_world import documents, messy_rows, prose

from martkeep.llm import toxicity
from martkeep.llm.common import fold
from martkeep.llm.queries import QUERIES

LABEL = "doc_id long, toxic int, quality int"


def lexicon():
    return toxicity.Lexicon({"idiot": 5.0, "vequ*": 4.0})


@pytest.mark.parametrize(
    ("text", "patterns"),
    [
        ("an idiot", ["plain"]),
        ("You are an IDIOT!", ["targeted"]),
        ("you walk far away from any such idiot", ["plain"]),
        ("not an idiot", ["negated"]),
        ("never said. an idiot", ["plain"]),
        ("she said that they are an idiot", ["reported"]),
        ("she said so; idiot, vequment idiots", ["plain", "plain"]),
        ("i will kill you", ["threat"]),
        ("i will kill", []),
        ("you i kill", ["threat"]),
        ("you did not kill", ["covered_threat"]),
        ("vequ", []),
        (None, []),
        ("", []),
        (" ... ", []),
    ],
)
def test_patterns_of_clauses(text, patterns):
    assert [p for p, _ in toxicity.matches(text, lexicon())] == patterns


def corpus(n=400):
    """Every fifth text is toxic: a word of a family, or a plain insult; another word is only ever near."""
    rnd = random.Random(6)
    docs, labels = [], []
    for i in range(n):
        text = prose(rnd, 40, 3000).split()
        toxic = int(i % 5 == 0)
        for _ in range(2 * toxic):
            text.insert(rnd.randrange(40), rnd.choice(["grublat", "grubnik,", "Grubsel", "oaf."]))
        docs.append((i, " ".join(text), "en", "a", 1))
        labels.append((i, toxic, 1))
    return docs, labels


def test_held_out_texts_are_told_apart(spark):
    docs, labels = corpus()
    df, labelled = documents(spark, docs), spark.createDataFrame(labels, LABEL)
    model = toxicity.train_toxicity(df, labelled.where(fold("doc_id", 5) != 0))
    assert "oaf" in model[0] and any(t.startswith("grub") and t.endswith("*") for t in model[0])
    assert not [t for t in model[0] if t.startswith("w")]
    got = toxicity.score_toxicity(df, model).join(labelled, "doc_id").where(fold("doc_id", 5) == 0).collect()
    assert len(got) > 50 and all(r["predicted"] == r["toxic"] for r in got)


def test_labels_ids_and_sources_are_no_inputs(spark):
    docs, labels = corpus()
    model = toxicity.train_toxicity(documents(spark, docs), spark.createDataFrame(labels, LABEL))
    text = docs[0][1]
    rows = [(1, text, "en", "a", 1), (None, text, None, None, None), (2, text, "fr", "z", 9)]
    assert len({r["score"] for r in toxicity.score_toxicity(documents(spark, rows), model).collect()}) == 1


def test_messy_rows_and_nothing_to_learn(spark):
    none = spark.createDataFrame([], LABEL)
    model = toxicity.train_toxicity(documents(spark), none)
    got = toxicity.score_toxicity(documents(spark), model).collect()
    assert len(got) == len(messy_rows()) and all(0 <= r["score"] < 0.5 and r["predicted"] == 0 for r in got)
    odd = spark.createDataFrame([(1, None, 1), (None, 1, 1), (2, 1, 1), (2, 0, 1), (2, 1, 1), (999, 1, 1)], LABEL)
    toxicity.train_toxicity(documents(spark), odd)
    assert toxicity.score_toxicity(documents(spark, []), model).count() == 0


def test_query_on_held_out_rows(spark):
    """Labels also call some texts toxic that hold no prose (one word over and over, symbols): those cannot be told by words."""
    from martkeep.llm import quality

    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic")
    prose_like = quality.judge_quality(spark.read.parquet(f"{folder}/documents.parquet")).select("doc_id", "kept")
    got = QUERIES["op10_toxicity"](spark, folder).where("held_out").join(labels, "doc_id").join(prose_like, "doc_id").persist()
    hit = {(r["toxic"], r["predicted"], r["kept"]): r["count"] for r in got.groupBy("toxic", "predicted", "kept").count().collect()}

    def n(toxic, predicted, *kept):
        return sum(hit.get((toxic, predicted, k), 0) for k in kept or (True, False))

    assert n(0, 1) <= 0.002 * n(0, 0)
    assert n(1, 0, True) <= 0.05 * n(1, 1, True) and n(1, 0) <= 0.1 * n(1, 1)
    assert got.where(F.col("score").isNull()).count() == 0


@pytest.mark.parametrize(
    ("text", "patterns"),
    [
        ("we will kill you", ["threat"]),
        ("they kill you and him", ["threat"]),
        ("i am killing you", ["threat"]),
        ("je tue ces gens, toi", ["threat"]),
        ("ich bringe dich um!", ["threat"]),
        ("ich bringe dich um die ecke", []),
        ("mato a ellos", ["threat"]),
        ("kill time. you", []),
        ("kill some more of the time you have", []),
        ("kill not you", ["covered_threat"]),
        ("kill the idiot, you", ["plain", "threat"]),
        ("never kill you", ["covered_threat"]),
        ("kill", []),
        ("ich töte dich nicht", ["covered_threat"]),
        ("dich töte ich nicht", ["covered_threat"]),
        ("ich töte dich. nicht", ["threat"]),
        ("ich töte dich heute ganz und gar nicht", ["threat"]),
        ("i will kill you, he said", ["covered_threat"]),
        ("i will kill you idiot", ["threat", "targeted"]),
        ("i kill you and i kill him", ["threat", "threat"]),
        ("i kill you. you kill me", ["threat", "threat"]),
    ],
)
def test_threats_before_their_target_and_inflected(text, patterns):
    assert [p for p, _ in toxicity.matches(text, lexicon())] == patterns


@pytest.mark.parametrize(
    ("text", "patterns"),
    [
        ("he quoted: you idiot", ["reported"]),
        ("she said: i will kill you. you idiot", ["covered_threat", "targeted"]),
        ("listen: you idiot", ["targeted"]),
    ],
)
def test_reported_speech_goes_on_after_a_colon(text, patterns):
    assert [p for p, _ in toxicity.matches(text, lexicon())] == patterns


def test_threats_are_learned_from_what_is_aimed(spark):
    """A word that is common, and toxic only beside a target, threatens there and nowhere else."""
    rnd = random.Random(12)
    docs, labels = [], []
    for i in range(1200):
        toxic = int(i % 6 == 0)
        text = prose(rnd, 40, 3000) + ". "
        if toxic:
            text += rnd.choice(["soon we frobble you", "i frobbled him today", "they will be frobbling them"]) if i % 12 else "a blorkhead, " + prose(rnd, 3, 3000)
        else:
            text += rnd.choice(["people frobble wood", "wood frobbled early", "you like wood", "the frobbling of wood", "we never frobble you", "soon we like you", "i like him today", "they will be liking them"])
        docs.append((i, text, "en", "a", 1))
        labels.append((i, toxic, 1))
    df, labelled = documents(spark, docs), spark.createDataFrame(labels, LABEL)
    model = toxicity.train_toxicity(df, labelled.where(fold("doc_id", 5) != 0))
    assert any(t.startswith("frob") for t in model[2]) and not any(t.startswith("frob") for t in model[0])
    got = toxicity.score_toxicity(df, model).join(labelled, "doc_id").where(fold("doc_id", 5) == 0).collect()
    hit = {(bool(r["toxic"]), bool(r["predicted"])): 0 for r in got}
    for r in got:
        hit[bool(r["toxic"]), bool(r["predicted"])] += 1
    assert hit.get((False, True), 0) <= 0.05 * hit[False, False] and hit.get((True, False), 0) <= 0.1 * hit[True, True], hit


def test_insults_that_clean_texts_negate_or_quote_are_learned(spark):
    rnd = random.Random(9)
    docs, labels = [], []
    for i in range(600):
        text = prose(rnd, 40, 3000)
        toxic = int(i % 5 == 0)
        if toxic:
            text += ". a blorkhead, " + prose(rnd, 3, 3000)
        elif i % 5 < 3:
            text += rnd.choice([". not a blorkhead", ". nobody quoted a blorkhead", ". she said blorkhead again"])
        elif i % 60 == 4:
            text += ". a blorkhead"
        docs.append((i, text, "en", "a", 1))
        labels.append((i, toxic, 1))
    df, labelled = documents(spark, docs), spark.createDataFrame(labels, LABEL)
    model = toxicity.train_toxicity(df, labelled.where(fold("doc_id", 5) != 0))
    assert any(t.startswith("blor") for t in model[0]) and not [t for t in model[0] if t.startswith("w")]
    got = toxicity.score_toxicity(df, model).join(labelled, "doc_id").where(fold("doc_id", 5) == 0).collect()
    plain = [r for r in got if r["toxic"]]
    covered = [r for r in got if not r["toxic"] and r["doc_id"] % 5 < 3]
    assert all(r["predicted"] for r in plain) and not any(r["predicted"] for r in covered) and len(covered) > 20


def test_families_that_owe_their_evidence_to_one_word_are_dropped():
    toxic = {"loser": 40, "lose*": 42, "idiot": 30, "idio*": 31, "grub*": 30, "grubnik": 8, "grubsel": 7}
    clean = {"lose*": 6, "grub*": 4}
    odds = dict.fromkeys(toxic, 5.0)
    assert toxicity.loose_families(odds, toxic, clean, 300, 2500, 5.0) == {"lose*"}


def test_terms_under_negation_or_report_are_not_open():
    found = toxicity.open_terms("not one two three four. she said five six; seven you eight", toxicity.Lexicon({}))
    assert found & set("one two three four five six seven eight".split()) == {"four", "seven", "eight"}
