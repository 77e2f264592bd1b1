"""Cross-tokenizer alignment: groups of tokens of two tokenizers that cover the same bytes.

A text is tokenised whole by both. Where both have a token end and both next tokens begin
with a space there is an anchor; anchors cut a text into windows, mostly words. What the
tokens of a window do is worked out once per pair of id tuples and remembered.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martkeep.llm.bpe import byte_letters
from martkeep.llm.common import ODD, hold, kept_in_worker, mix, release, staged

SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
KNOWN_WINDOWS = 150_000  # a worker remembers up to twice as many
CHUNK_BYTES = 1 << 20  # text that is aligned at once
BETWEEN = b"\xff\xff\xff\xff"  # in a window's key; no token id


class ByteTokens:
    """A byte-level BPE vocabulary in its JSON file: ids of a text after a space, and their bytes."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        back = {letter: byte for byte, letter in byte_letters().items()}
        added = {t["id"]: t["content"].encode() for t in spec["added_tokens"]}
        #: Whether tokens always spell the text: bytes that no normaliser has touched.
        self.lossless = not spec.get("normalizer")
        vocab = {i: bytes(map(back.__getitem__, name)) for name, i in spec["model"]["vocab"].items() if i not in added}
        tokens = vocab | added
        self.bytes = [tokens.get(i, b"") for i in range(max(tokens) + 1)]
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        ids = spec["model"]["vocab"]
        made = [ids["".join(m)] for m in merges]
        if made == sorted(made) and len(vocab) == 256 + len(made):  # ids stand for ranks
            import tiktoken

            plain = tiktoken.Encoding("byte-bpe", pat_str=SPLIT, mergeable_ranks={b: i for i, b in vocab.items()}, special_tokens={})
            self._ids = lambda texts: [plain.encode_to_numpy(t, disallowed_special=()).astype("<i4") for t in texts]
        else:
            from tokenizers import Tokenizer

            library = Tokenizer.from_file(path)
            library.no_truncation()
            library.no_padding()
            library.encode_special_tokens = True
            self._ids = lambda texts: [np.array(library.encode(t, add_special_tokens=False).ids, "<i4") for t in texts]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return self._ids([" " + t for t in texts])


class PieceTokens:
    """A sentence-piece vocabulary in its model file; it puts a space before the text itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.bytes = [
            bytes([int(name[3:5], 16)]) if self.model.is_byte(i) else name.replace("▁", " ").encode() for i, name in enumerate(names)
        ]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(ids, "<i4") for ids in self.model.encode(texts, num_threads=1)]


def endings(a: list[bytes], b: list[bytes]) -> np.ndarray:
    """All id pairs (a << 32 | b) that can end at one byte, sorted: one's bytes end the other's.

    This depends on the vocabularies alone and is at most the sum of their tokens' lengths,
    twice where bytes are named twice; it bounds every table of pairs, whatever the corpus.
    """

    def by_bytes(tokens: list[bytes]) -> dict[bytes, list[int]]:
        at: dict[bytes, list[int]] = {}
        for i, token in enumerate(tokens):
            at.setdefault(token, []).append(i)
        return at

    of_a, of_b, pairs = by_bytes(a), by_bytes(b), set()
    for i, token in enumerate(a):
        for cut in range(len(token)):
            pairs.update(i << 32 | j for j in of_b.get(token[cut:], ()))
    for j, token in enumerate(b):
        for cut in range(len(token)):
            pairs.update(i << 32 | j for i in of_a.get(token[cut:], ()))
    return np.array(sorted(pairs), np.int64)


def starts_with_space(tokens: list[bytes]) -> np.ndarray:
    return np.array([t[:1] == b" " for t in tokens])


def written(tokens: int, ends: str) -> np.ndarray:
    """Each id as text with ``ends`` behind it."""
    return np.array([f"{i}{ends}".encode() for i in range(tokens)], object)


def shared(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the ends that both have; both rise and have the same last one."""
    at_a, at_b = (np.zeros(int(ends_a[-1]) + 1, bool) for _ in range(2))
    at_a[ends_a] = at_b[ends_b] = True
    return np.flatnonzero(at_b[ends_a]), np.flatnonzero(at_a[ends_b])


class Aligner:
    """Aligns texts; remembers windows. Pairs are numbered by their place in :func:`endings`."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = ByteTokens(path_a), PieceTokens(path_b)
        self.size_a, self.size_b = (np.array([len(t) for t in side.bytes], np.int64) for side in (self.a, self.b))
        self.spaced_a, self.spaced_b = starts_with_space(self.a.bytes), starts_with_space(self.b.bytes)
        self.pairs = endings(self.a.bytes, self.b.bytes)
        self.text_a, self.text_b = ([written(len(side.bytes), e) for e in (",", end)] for side, end in ((self.a, "|"), (self.b, ";")))
        # Key of ids -> groups as text, each with ";" behind it, packed pair numbers, and
        # whether the tokens of both sides spell the same bytes.
        self.windows: dict[bytes, tuple[bytes, bytes, bool]] = {}
        self.older: dict[bytes, tuple[bytes, bytes, bool]] = {}

    def learn(self, keys: list[bytes]) -> None:
        """Align these windows, all at once, and remember them."""
        ids = np.frombuffer(b"".join([key + BETWEEN for key in keys]), "<i4")
        (marks,) = np.nonzero(ids < 0)  # after the A ids and after the B ids of each window
        side = np.repeat(np.arange(len(marks)) % 2, np.diff(marks, prepend=-1))
        a, b = (ids[(side == k) & (ids >= 0)].astype(np.int64) for k in (0, 1))
        stop_a, stop_b = (np.cumsum(np.diff(marks, prepend=-1)[k::2] - 1) for k in (0, 1))
        last_a, last_b = shared(np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b]))
        numbers = np.searchsorted(self.pairs, a[last_a] << 32 | b[last_b]).astype("<i4").tobytes()
        # The text: A ids of a group, then its B ids; a group's last id is followed by | or ;
        ends_a, ends_b = np.zeros(len(a), bool), np.zeros(len(b), bool)
        ends_a[last_a] = ends_b[last_b] = True
        group_a, group_b = np.cumsum(ends_a) - ends_a, np.cumsum(ends_b) - ends_b
        words = np.empty(len(a) + len(b), object)
        words[np.arange(len(a)) + np.append(0, last_b + 1)[group_a]] = np.where(ends_a, self.text_a[1][a], self.text_a[0][a])
        words[np.arange(len(b)) + (last_a + 1)[group_b]] = np.where(ends_b, self.text_b[1][b], self.text_b[0][b])
        words = words.tolist()
        groups = (4 * np.searchsorted(last_a, stop_a)).tolist()
        stops = (stop_a + stop_b).tolist()
        spelled_a, spelled_b = (
            b"".join(map(tokens.__getitem__, x.tolist())) for tokens, x in ((self.a.bytes, a), (self.b.bytes, b))
        )
        at = np.cumsum(self.size_a[a])[stop_a - 1].tolist()
        whole = spelled_a == spelled_b
        for key, i, j, m, n, p, q in zip(keys, [0, *stops], stops, [0, *groups], groups, [0, *at], at):
            self.windows[key] = b"".join(words[i:j]), numbers[m:n], whole or spelled_a[p:q] == spelled_b[p:q]

    def look_up(self, keys: list[bytes]) -> list[tuple[bytes, bytes, bool]]:
        """What is known of windows, each key once."""
        if len(self.windows) > KNOWN_WINDOWS:
            self.older, self.windows = self.windows, {}
        known, older = self.windows, self.older
        found = list(map(known.get, keys))
        unknown = [i for i, window in enumerate(found) if window is None]
        if unknown:
            new = set()
            for key in {keys[i] for i in unknown}:
                if key in older:
                    known[key] = older[key]
                else:
                    new.add(key)
            if new:
                self.learn(list(new))
            for i in unknown:
                found[i] = known[keys[i]]
        return found

    def anchors(self, a: np.ndarray, b: np.ndarray, stop_a: np.ndarray, stop_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places after the tokens at which windows end, in the ids of several texts on end.

        Candidates are the tokens before a space-marked one, and the last of each text
        (before ``stop_a``, ``stop_b``); those whose ends both tokenizers share are anchors.
        """
        ends_a, ends_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        before_a, before_b = np.append(self.spaced_a[a[1:]], True), np.append(self.spaced_b[b[1:]], True)
        before_a[stop_a - 1] = before_b[stop_b - 1] = True
        before_a, before_b = np.flatnonzero(before_a), np.flatnonzero(before_b)
        at_a, at_b = shared(ends_a[before_a], ends_b[before_b])
        return before_a[at_a] + 1, before_b[at_b] + 1

    def align(self, texts: list[str | None]) -> list[tuple[int, int, bytes, bytes] | None]:
        """(tokens of A, of B, groups as text, packed pair numbers) per text; None if it has no tokens."""
        out: list = [None] * len(texts)
        batch, size = [], 0
        for i, text in enumerate(texts):
            if text:
                batch.append(i)
                size += len(text)
            if batch and (size >= CHUNK_BYTES or i == len(texts) - 1):
                for k, result in zip(batch, self._align_some([texts[k] for k in batch])):
                    out[k] = result
                batch, size = [], 0
        return out

    def _align_some(self, texts: list[str]) -> list[tuple[int, int, bytes, bytes] | None]:
        """As :meth:`align`. Both sides' tokens must be as long as the text, and alike in every window."""
        out: list = [None] * len(texts)
        ids = list(zip(self.a.encode(texts), self.b.encode(texts)))
        fine = []
        for k, (a, b) in enumerate(ids):
            size = len(texts[k].encode()) + 1
            if size == self.size_a[a].sum() == self.size_b[b].sum():
                if self.a.lossless or b"".join(map(self.a.bytes.__getitem__, a.tolist())) == b" " + texts[k].encode():
                    fine.append(k)
        if not fine:
            return out
        a, b = (np.concatenate([ids[k][side] for k in fine]) for side in (0, 1))
        stop_a, stop_b = (np.cumsum([len(ids[k][side]) for k in fine]) for side in (0, 1))
        cut_a, cut_b = self.anchors(a, b, stop_a, stop_b)
        first, which = self.distinct(a, b, cut_a, cut_b)
        raw_a, raw_b = a.tobytes(), b.tobytes()
        bounds = [(4 * x).tolist() for cut in (cut_a, cut_b) for x in (np.append(0, cut[:-1])[first], cut[first])]
        windows = self.look_up([raw_a[i:j] + BETWEEN + raw_b[m:n] for i, j, m, n in zip(*bounds)])
        groups, links = (np.empty(len(windows), object) for _ in range(2))
        groups[:], links[:] = [w[0] for w in windows], [w[1] for w in windows]
        alike = np.array([w[2] for w in windows])[which]
        groups, links = groups[which].tolist(), links[which].tolist()
        of_text = np.searchsorted(cut_a, stop_a, side="right").tolist()
        for k, start, stop in zip(fine, [0, *of_text], of_text):
            if alike[start:stop].all():
                text = b"".join(groups[start:stop])[:-1]
                out[k] = (len(ids[k][0]), len(ids[k][1]), text, b"".join(links[start:stop]))
        return out

    def distinct(self, a: np.ndarray, b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places of windows that hold all different ones, which of these each window is).

        Windows are told apart by two 64-bit hashes of their ids; if those of one text
        disagree, each window counts as its own.
        """
        hashes = []
        for seed in (ODD, mix(np.array([ODD]))[0]):
            total = np.zeros(len(cut_a), np.uint64)
            for ids, cut in ((a, cut_a), (b, cut_b)):
                start = np.append(0, cut[:-1])
                place = np.arange(len(ids), dtype=np.uint64) - np.repeat(start, cut - start).astype(np.uint64)
                mixed = mix(mix(ids.astype(np.uint64) + seed) + place * ODD)
                total = mix(total * ODD + np.add.reduceat(mixed, start) + (cut - start).astype(np.uint64))
            hashes.append(total)
        _, first, which = np.unique(hashes[0], return_index=True, return_inverse=True)
        if (hashes[1][first][which] != hashes[1]).any():
            return np.arange(len(cut_a)), np.arange(len(cut_a))
        return first, which


ALIGNED = "n_a long, n_b long, n_groups long, groups_sha256 string, pair binary, times binary"


def align(docs: DataFrame, path_a: str, path_b: str, text: str = "text", groups: bool = False) -> DataFrame:
    """``docs`` without the text, with n_a, n_b, n_groups, groups_sha256, pair, times.

    ``path_a`` is the JSON file of a byte-level BPE, ``path_b`` a sentence-piece model; both
    are read on the executors. Groups are written `a1,a2|b1;a3|b2,b3` in order and hashed;
    with ``groups`` their text is returned too, as column groups. As no token is empty, each
    group is one link: that of the A and the B token that end it. pair and times hold the
    distinct links as packed little-endian 32-bit numbers, of :func:`endings` and how often.

    Null and empty texts, and those whose tokens do not spell a space and the text (say,
    because the model normalises), have no tokens: zeros, '' for the hash, empty links.
    Special tokens written in a text are text. Repeated rows are aligned alike. Columns of
    the names returned are replaced, others pass through. An empty table gives none.
    """
    names = ["n_a", "n_b", "n_groups", "groups_sha256", "pair", "times", *(["groups"] if groups else [])]
    kept = [c for c in docs.columns if c not in (*names, text)]
    source = docs.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text}`").cast("string").alias("aligned_text"))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema[:-1]] + [ALIGNED] + ["groups string"] * groups)
    kinds = [pa.int64()] * 3 + [pa.string(), pa.binary(), pa.binary()] + [pa.string()] * groups
    key = (Aligner.__qualname__, path_a, path_b)

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = kept_in_worker(key, lambda: Aligner(path_a, path_b))
        hold()
        for batch in batches:
            rows = []
            for found in aligner.align(batch.column(len(kept)).to_pylist()):
                n_a, n_b, text_of_groups, links = found or (0, 0, b"", b"")
                pair, times = np.unique(np.frombuffer(links, "<i4"), return_counts=True)
                digest = hashlib.sha256(text_of_groups).hexdigest() if found else ""
                row = (n_a, n_b, len(links) // 4, digest, pair.tobytes(), times.astype("<i4").tobytes())
                rows.append(row + ((text_of_groups.decode(),) if groups else ()))
            columns = [pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)] if rows else [pa.array([], kind) for kind in kinds]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], *columns], [*kept, *names])
        release(key)

    return source.mapInArrow(aligned, schema)


def count_links(aligned: DataFrame, most: int) -> np.ndarray:
    """How often each pair is linked in the whole of ``aligned``, by pair number.

    Tasks add up in an array of ``most`` numbers, the number of possible pairs, and hand on
    what is not 0; the sums, no more than ``most``, come to the driver.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(most, np.int64)
        for batch in batches:
            pair, times = (np.frombuffer(b"".join(c.drop_null().to_pylist()), "<i4") for c in batch.columns)
            total += np.bincount(pair, weights=times, minlength=most).astype(np.int64)
        (some,) = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], ["number", "links"])
        release()

    few = aligned.coalesce(4 * aligned.sparkSession.sparkContext.defaultParallelism)
    sums = few.select("pair", "times").mapInArrow(counted, "number int, links long").groupBy("number").agg(F.sum("links").alias("links"))
    table = staged(sums, "alignment-counts").toArrow()
    out = np.zeros(most, np.int64)
    out[table["number"].to_numpy()] = table["links"].to_numpy()
    return out


def best_of(counts: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """Whether each pair's count is the highest of its B id."""
    b = pairs & 0xFFFFFFFF
    highest = np.zeros(int(b.max()) + 1 if len(b) else 0, np.int64)
    np.maximum.at(highest, b, counts)
    return counts == highest[b]


def weigh_links(aligned: DataFrame, counts: np.ndarray, best: np.ndarray) -> DataFrame:
    """``aligned`` with n_links, n_best and count_sum instead of pair and times.

    ``counts`` and ``best`` have an entry per possible pair, so their size is bounded by the
    vocabularies; they are broadcast.
    """
    sent = aligned.sparkSession.sparkContext.broadcast((counts, best))
    kept = [c for c in aligned.columns if c not in ("pair", "times", "n_links", "n_best", "count_sum")]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in aligned.select(*[F.col(f"`{c}`") for c in kept]).schema])

    def weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, best = sent.value
        for batch in batches:
            out = np.zeros((3, batch.num_rows), np.int64)
            packed = zip(*(batch.column(len(kept) + k).to_pylist() for k in (0, 1)))
            for i, (pair, times) in enumerate(packed):
                pair, times = np.frombuffer(pair, "<i4"), np.frombuffer(times, "<i4").astype(np.int64)
                out[:, i] = times.sum(), times[best[pair]].sum(), (times * counts[pair]).sum()
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], *map(pa.array, out)], [*kept, "n_links", "n_best", "count_sum"])

    rows = aligned.select(*[F.col(f"`{c}`") for c in kept], "pair", "times")
    return rows.mapInArrow(weighed, f"{schema}, n_links long, n_best long, count_sum long")


def align_corpus(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """:func:`align` with n_links, n_best and count_sum over the whole of ``docs``, instead of the links.

    A link's count is how many links of the corpus hold its id pair; n_best counts links
    whose count is the highest of their B id, ties included; count_sum adds counts up.
    """
    aligned = staged(align(docs, path_a, path_b), "alignment-links")
    pairs = endings(ByteTokens(path_a).bytes, PieceTokens(path_b).bytes)
    counts = count_links(aligned, len(pairs))
    return weigh_links(aligned, counts, best_of(counts, pairs))
