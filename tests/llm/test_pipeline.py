import ast
from collections import Counter
from pathlib import Path

import corpus_pipeline
import public_tokenizers
from tokenizers import Tokenizer
from llm_world import brute_groups

from martkeep.llm import mixing, quality, toxicity
from martkeep.llm.common import staged

FOLDER = "/root/testdata/sf0.001"
ROOT = Path(corpus_pipeline.__file__).parent


def test_every_stage_against_brute_force(spark):
    start = docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = staged(stage(spark, docs, FOLDER), "pipeline-test")
        rows[name] = docs.collect()
        assert name == "bpe" or docs.columns == list(corpus_pipeline.DOCUMENTS)
    ids = {name: [r["doc_id"] for r in got] for name, got in rows.items()}
    judged = quality.judge_quality(start).collect()
    assert sorted(ids["quality_rules"]) == sorted(r["doc_id"] for r in judged if r["kept"])
    clean = spark.createDataFrame(rows["quality_rules"], start.schema)
    model = toxicity.train_toxicity(clean, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    lexicon = toxicity.Lexicon(model[0], threats=model[2])
    hit = {r["doc_id"] for r in rows["quality_rules"] if toxicity.matches(r["text"], lexicon)}
    assert set(ids["quality_rules"]) - hit <= set(ids["toxicity"])
    groups = brute_groups([(r["doc_id"], r["text"]) for r in rows["toxicity"]], 5, 80)
    assert sorted(ids["near_duplicates"]) == sorted(i for i, _, component in groups if i == component)
    mixed = mixing.mix_sources(spark.createDataFrame(rows["near_duplicates"], start.schema)).collect()
    assert Counter(ids["mixing"]) == Counter({r["doc_id"]: r["copies"] for r in mixed if r["copies"]})
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = {r["doc_id"]: r["text"] for r in rows["mixing"]}
    assert Counter(ids["bpe"]) == Counter(ids["mixing"])
    assert all(r["n_tokens"] == len(library.encode(texts[r["doc_id"]], add_special_tokens=False).ids) for r in rows["bpe"])


def test_messy_rows_pass_all_stages(spark):
    from llm_world import documents

    docs = documents(spark, clashing=False)
    for _, stage in corpus_pipeline.STAGES:
        docs = staged(stage(spark, docs, FOLDER), "pipeline-test")
    assert docs.count() > 0
    docs = documents(spark, [], clashing=False)
    for _, stage in corpus_pipeline.STAGES:
        docs = staged(stage(spark, docs, FOLDER), "pipeline-test")
    assert docs.count() == 0


def test_a_document_of_each_group_stays(spark):
    a, b, c = (" ".join(f"{k}{i}" for i in range(60)) for k in "abc")
    rows = [(1, a), (1, b), (7, b), (1, b + " more"), (2, c), (2, c), (3, c), (4, ""), (4, ""), (5, None), (None, a), (None, a), (6, "two words")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.near_duplicate_stage(spark, docs, FOLDER).collect()
    left = Counter((r["doc_id"], r["text"]) for r in got)
    assert left.pop((1, b), 0) + left.pop((1, b + " more"), 0) == 1
    assert left == Counter({(1, a): 1, (2, c): 1, (4, ""): 2, (5, None): 1, (None, a): 2, (6, "two words"): 1})


def test_nothing_else_imports_the_subpackage():
    for path in (ROOT / "martkeep").rglob("*.py"):
        if "llm" not in path.parts:
            for node in ast.walk(ast.parse(path.read_text())):
                if isinstance(node, ast.Import | ast.ImportFrom):
                    assert "llm" not in ast.dump(node), path


def python_steps(df):
    """How many Python steps a frame adds to what was last written down."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return sum(plan.count(name) for name in ("ArrowEvalPython", "MapInArrow", "BatchEvalPython"))


def test_encoding_has_one_python_step_at_a_time(spark):
    docs = spark.createDataFrame([(1, "the cat", "en", "s", 7), (2, None, "en", "s", 0)], "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.encoding_stage(spark, docs, FOLDER)
    assert python_steps(got) == 1
    assert sorted((r["doc_id"], r["n_tokens"], len(r["ids"])) for r in got.collect()) == [(1, 2, 8), (2, 0, 0)]


def test_quality_rules_count_once_in_a_task(spark):
    docs = spark.createDataFrame([(1, "w " * 60, "en", "s", 7), (2, None, "en", "s", 0)], "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.quality_stage(spark, docs, FOLDER)
    assert python_steps(got) == 1
    assert got.count() == 0


def test_units_of_the_mix_are_sent_or_shuffled_to_the_same_end(spark, monkeypatch):
    rows = [(i % 150, f"a{i} " * (i % 9), "en", "s" if i % 3 else None, 1) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {}
    for most in (corpus_pipeline.BROADCAST_UNITS, 0):
        monkeypatch.setattr(corpus_pipeline, "BROADCAST_UNITS", most)
        mixed = corpus_pipeline.mixing_stage(spark, docs, FOLDER)
        assert ("strategy=broadcast" in mixed._jdf.queryExecution().optimizedPlan().toString()) == (most > 0)
        got[most] = Counter(map(tuple, mixed.collect()))
    assert len(got) == 2 and len({frozenset(g.items()) for g in got.values()}) == 1


def test_stages_bound_the_rows_that_a_task_reads(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES:
        for key in (keys := corpus_pipeline.BATCH | corpus_pipeline.READ):
            spark.conf.unset(key)
        stage(spark, docs, FOLDER)
        assert {key: spark.conf.get(key) for key in keys} == keys, name
