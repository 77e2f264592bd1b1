import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer
from llm_world import documents, messy_rows

from martkeep.llm import bpe
from martkeep.llm.queries import QUERIES, word_tokenizer

ODD = [
    "<|endoftext|>a<|startoftext|> B", "<|endoftext|", "x<|ENDOFTEXT|>", "ΑΣ ΣΑΣ", "İstanbul", "it's we'LL 'S don't've", "a\x1cb \x1d c", "ab" * 3000,
    "é́ é", "ǅ ß ẞ ﬁ ½ ² Ⅷ", "", "   ", "日本語テキスト 12345 ١٢٣", "👩‍👩‍👧 ok", "!" * 400,
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def test_ids_and_text_are_those_of_the_library(library):
    rnd = random.Random(1)
    texts = ODD + ["".join(rnd.choice("aAbB'srtdm lΣé1 .,<|>\n\t\x1f́ñǅ") for _ in range(80)) for _ in range(500)]
    ours = bpe.WordBpe(word_tokenizer())
    for text, packed, want in zip(texts, ours.encode_batch(texts), library.encode_batch(texts, add_special_tokens=False)):
        assert np.frombuffer(packed, "<u4").tolist() == want.ids, text
        assert ours.decode(packed) == library.decode(want.ids, skip_special_tokens=False), text


def test_long_words_merge_alike():
    ours = bpe.WordBpe(word_tokenizer())
    for word in ("ab" * 300, "straßenbahn" * 30, "the" * 200):
        letters = ours.pieces(word)[0]
        assert ours.exact_long(ours.symbols(letters + bpe.END)) == [ours.ids[s] for s in ours.merge(ours.symbols(letters + bpe.END))]


def test_matrix_merges_are_those_of_one_word(library):
    ours, rnd = bpe.WordBpe(word_tokenizer()), random.Random(4)
    letters = [ours.letters[b] for b in range(256)]
    texts = ["".join(rnd.choice(letters[97:123] if rnd.random() < 0.8 else letters) for _ in range(rnd.randrange(1, 260))) for _ in range(300)]
    texts += ["".join(rnd.choice("theandingers") for _ in range(rnd.randrange(1, 14))) for _ in range(2000)]
    ended = np.array([rnd.random() < 0.5 for _ in texts])
    for text, end, got in zip(texts, ended, ours.merge_all(texts, ended)):
        want = [ours.ids[s] for s in ours.merge(ours.symbols(text + (bpe.END if end else "")))]
        assert got.tolist() == want, text


def test_longest_tokens_from_the_left():
    ours, words = bpe.WordBpe(word_tokenizer()), ["thering", "x", "qzqzq", "\u0120", "international"]
    ids, owner, wrong = ours.greedy(words)
    for k, word in enumerate(words):
        mine, at = [ours.names[i].replace(bpe.END, bpe.MARK) for i in ids[owner == k]], 0
        for token in mine:
            rest = (word + bpe.MARK)[at:]
            assert token == max((rest[:n] for n in range(1, len(rest) + 1) if rest[:n].replace(bpe.MARK, bpe.END) in ours.ids), key=len)
            at += len(token)
        assert wrong[k] == (at != len(word) + 1)


def test_columns(spark, library):
    df = bpe.decode(bpe.encode(documents(spark), word_tokenizer()), word_tokenizer())
    rows = df.select("doc_id", "text", "ids", "decoded", "score").collect()
    assert len(rows) == len(messy_rows())
    for row in rows:
        want = library.encode(row["text"] or "", add_special_tokens=False).ids
        assert np.frombuffer(row["ids"], "<u4").tolist() == want
        assert row["decoded"] == library.decode(want, skip_special_tokens=False) and row["score"] == "clash"
    assert bpe.encode(documents(spark, []), word_tokenizer()).count() == 0


def test_query(spark, library):
    folder = "/root/testdata/sf0.001"
    texts = dict(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect())
    for doc_id, n, ids, decoded in QUERIES["op1_bpe"](spark, folder).collect():
        want = library.encode(texts[doc_id] or "", add_special_tokens=False).ids
        text = library.decode(want, skip_special_tokens=False)
        assert (n, ids, decoded) == (len(want), hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())


def test_a_worker_keeps_what_the_step_at_hand_uses():
    from martkeep.llm.common import kept_in_worker, release

    made = []
    for key in (("test", "a"), ("test", "b")):
        kept_in_worker(key, lambda key=key: made.append(key))
    release(("test", "a"))
    for key in (("test", "a"), ("test", "b")):
        kept_in_worker(key, lambda key=key: made.append(key))
    release()
    assert made == [("test", "a"), ("test", "b"), ("test", "b")]
