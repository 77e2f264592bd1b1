import hashlib
from collections import Counter, defaultdict

import pytest
import sentencepiece
from llm_world import documents, messy_rows
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from martkeep.llm import alignment
from martkeep.llm.bpe import byte_letters
from martkeep.llm.queries import QUERIES, vocabulary

A, B = vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")
ODD = [
    "a b", "<|endoftext|> x </s><s> <unk>", "", " ", "  a  b ", "▁x", "日本語 ñ é", "\n\n\ta\n", " x" * 50, "x" * 3000, "\x00a", "ﬁ ½ Ⅷ é", None, "é",
    "I'll don't WE'RE", "a\x1cb c d", "👩‍👩‍👧 ok", "12345 678", " 　 x", "<0x0A>", "\r\n x\r\n",
]


@pytest.fixture(scope="module")
def brute():
    """(ids of A, of B, groups) of a text by the two libraries and a walk over the bytes; None without tokens."""
    library = Tokenizer.from_file(A)
    library.encode_special_tokens = True
    pieces = sentencepiece.SentencePieceProcessor(model_file=B)
    back = {letter: byte for byte, letter in byte_letters().items()}

    def bytes_b(i):
        name = pieces.id_to_piece(i)
        return bytes([int(name[3:5], 16)]) if pieces.is_byte(i) else name.replace("▁", " ").encode()

    def align(text):
        if not text:
            return None
        a, b = library.encode(" " + text, add_special_tokens=False).ids, pieces.encode(text)
        by_a, by_b = [bytes(back[c] for c in library.id_to_token(i)) for i in a], [bytes_b(i) for i in b]
        if not b"".join(by_a) == b"".join(by_b) == (" " + text).encode():
            return None
        ends_a, ends_b, at = {}, {}, 0
        for k, t in enumerate(by_a):
            at += len(t)
            ends_a[at] = k
        at = 0
        for k, t in enumerate(by_b):
            at += len(t)
            ends_b[at] = k
        groups, i, j = [], 0, 0
        for end in sorted(ends_a.keys() & ends_b.keys()):
            groups.append((a[i : ends_a[end] + 1], b[j : ends_b[end] + 1]))
            i, j = ends_a[end] + 1, ends_b[end] + 1
        return a, b, groups

    return align


def spelled(groups):
    return ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)


def corpus(brute, texts):
    """Expected (n_a, n_b, n_groups, n_links, n_best, count_sum, hash) per text."""
    found = [brute(t) for t in texts]
    links = [[(a[-1], b[-1]) for a, b in f[2]] if f else [] for f in found]
    counts = Counter(pair for some in links for pair in some)
    highest = defaultdict(int)
    for (_, b), n in counts.items():
        highest[b] = max(highest[b], n)
    return [
        (len(f[0]), len(f[1]), len(f[2]), len(some), sum(counts[p] == highest[p[1]] for p in some), sum(counts[p] for p in some), hashlib.sha256(spelled(f[2]).encode()).hexdigest())
        if f else (0, 0, 0, 0, 0, 0, "")
        for f, some in zip(found, links)
    ]


def test_texts(brute, monkeypatch):
    monkeypatch.setattr(alignment, "KNOWN_WINDOWS", 40)  # forget often
    monkeypatch.setattr(alignment, "CHUNK_BYTES", 300)
    texts = ODD + [row[1] for row in messy_rows()]
    aligner = alignment.Aligner(A, B)
    for text, got in zip(texts, aligner.align(texts)):
        want = brute(text)
        assert (got is None) == (want is None), text
        if got:
            assert (got[0], got[1], got[2].decode()) == (len(want[0]), len(want[1]), spelled(want[2])), text
            assert len(got[3]) == 4 * len(want[2])


def test_every_pair_that_ends_alike_has_a_number():
    pairs = alignment.endings([b"a", b" a", b"ba", b"c"], [b"a", b"ba", b"cba", b"a"])
    assert [(p >> 32, p & 0xFFFFFFFF) for p in pairs.tolist()] == [(0, 0), (0, 1), (0, 2), (0, 3), (1, 0), (1, 3), (2, 0), (2, 1), (2, 2), (2, 3)]


def test_ids_of_every_letter_are_the_librarys():
    library = Tokenizer.from_file(A)
    texts = [f"a{chr(c)}1 {chr(c)}b{chr(c)}{chr(c)} " for c in range(1, 0x30000, 7) if not 0xD800 <= c < 0xE000]
    ours = alignment.ByteTokens(A).encode(texts)
    wrong = [t for t, ids in zip(texts, ours) if ids.tolist() != library.encode(" " + t, add_special_tokens=False).ids]
    assert not wrong


def test_corpus(spark, brute):
    rows = messy_rows() + [(300 + i, t, None, None, None) for i, t in enumerate(ODD)]
    out = alignment.align_corpus(documents(spark, rows), A, B)
    assert "text" not in out.columns and {"score", "ids"} <= set(out.columns)
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    got = sorted([(r["doc_id"], *[r[n] for n in names]) for r in out.collect()], key=repr)
    assert got == sorted([(row[0], *want) for row, want in zip(rows, corpus(brute, [r[1] for r in rows]))], key=repr)


def test_groups_as_text(spark, brute):
    rows = [(i, t, "en", "a", 1) for i, t in enumerate(ODD)]
    out = alignment.align(documents(spark, rows, clashing=False).withColumn("pair", F.lit("clash")), A, B, groups=True)
    for row in out.collect():
        want = brute(ODD[row["doc_id"]])
        assert row["groups"] == (spelled(want[2]) if want else "")


def test_empty_and_tokenless(spark):
    assert alignment.align_corpus(documents(spark, []), A, B).count() == 0
    (row,) = alignment.align_corpus(documents(spark, [(None, None, None, None, None)]), A, B).collect()
    assert (row["doc_id"], row["n_a"], row["n_best"], row["count_sum"], row["groups_sha256"]) == (None, 0, 0, 0, "")


def test_query(spark, brute):
    folder = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    out = QUERIES["op12_alignment"](spark, folder)
    assert out.columns == names and [t for _, t in out.dtypes] == ["bigint"] * 7 + ["string"]
    assert sorted(map(tuple, out.collect())) == sorted((r["doc_id"], *want) for r, want in zip(rows, corpus(brute, [r["text"] for r in rows])))
