"""BPE by speculation and verification: greedy tokens, checked pairs, exact merges for the rest.

A sequence of tokens is what merging gives if every two neighbours are what merging their
joined text gives. So words are cut greedily into the longest tokens, by one search over all
new words, all pairs of neighbours are looked up at once, and only words with a wrong pair
are merged by rank, as rows of a matrix.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martkeep.llm.common import hold, kept_in_worker, release

#: White space as the tokenizer's patterns see it; str.split() also splits at \x1c-\x1f.
SPACE = "\t\n\x0b\x0c\r \x85\xa0  -     　"
PATTERN = rf"'s|'t|'re|'ve|'m|'ll|'d|[\p{{L}}]+|[\p{{N}}]|[^{SPACE}\p{{L}}\p{{N}}]+"
END = "</w>"
MARK = "\ue000"  # stands for END, as one letter that no text has in byte letters
KNOWN_WORDS, KNOWN_PAIRS = 60_000, 100_000  # a worker remembers up to twice as many
NO_RANK = np.int32(2**31 - 1)
WIDTHS = (4, 8, 12, 16, 24, 32, 64, 200)  # words are merged beside others of about their length


def byte_letters() -> dict[int, str]:
    """Byte -> the printable character that stands for it in a byte-level vocabulary."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return {b: chr(b) if b in printable else chr(next(spare)) for b in range(256)}


def _names(ids: dict[str, int]) -> list[str]:
    names = [""] * (max(ids.values()) + 1)
    for name, i in ids.items():
        names[i] = name
    return names


def token_names(path: str) -> list[str]:
    """The text of each token id: all that decoding needs."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    return _names(spec["model"]["vocab"] | {t["content"]: t["id"] for t in spec["added_tokens"]})


class WordBpe:
    """A byte-level vocabulary with word ends, as its JSON file describes it."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.ids: dict[str, int] = model["vocab"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.ranks = {pair: rank for rank, pair in enumerate(merges)}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names = _names(self.ids | self.special)
        # Longest tokens from the left: an automaton over all tokens, word ends as one letter.
        self.finder = ahocorasick.Automaton()
        marked = {name.replace(END, MARK): i for name, i in self.ids.items() if name not in self.special}
        for name, i in marked.items():
            self.finder.add_word(name, i)
        self.finder.make_automaton()
        self.length = np.zeros(len(self.names), np.int64)
        self.length[list(marked.values())] = [len(name) for name in marked]
        # The same merges as arrays: codes of pairs of ids, their ranks, and what each rank makes.
        pairs = [(self.ids[a], self.ids[b]) for a, b in merges]
        codes = np.array([a << 32 | b for a, b in pairs], np.int64)
        order = np.argsort(codes, kind="stable")
        self.codes, self.rank_of = codes[order], order.astype(np.int32)
        self.made = np.array([self.ids[a + b] for a, b in merges], np.int64)
        self.letter_ids = np.full((2, 512), -1, np.int64)
        for letter in byte_letters().values():
            for k, end in enumerate(("", END)):
                self.letter_ids[k, ord(letter)] = self.ids.get(letter + end, -1)
        self.letters = byte_letters()
        self.split = regex.compile(PATTERN)
        self.spaces = regex.compile(f"[{SPACE}]+")
        self.at_special = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None
        # What is known of words and pairs; the older halves still serve, then are dropped.
        self.words: dict[str, bytes] = {}
        self.older_words: dict[str, bytes] = {}
        self.pair_ok: dict[int, bool] = {}
        self.older_pairs: dict[int, bool] = {}

    # -- exact merging -----------------------------------------------------------------

    def merge(self, symbols: list[str]) -> list[str]:
        """Merge the pair of lowest rank, leftmost first, until none is left."""
        rank, none = self.ranks.get, 1 << 60
        ranked = [rank(pair, none) for pair in zip(symbols, symbols[1:])]
        while ranked:
            best = min(ranked)
            if best == none:
                break
            i = ranked.index(best)
            symbols[i : i + 2] = [symbols[i] + symbols[i + 1]]
            del ranked[i]
            if i:
                ranked[i - 1] = rank((symbols[i - 1], symbols[i]), none)
            if i < len(ranked):
                ranked[i] = rank((symbols[i], symbols[i + 1]), none)
        return symbols

    def symbols(self, text: str) -> list[str]:
        """Single letters of a stretch of vocabulary text; a word end stays with its letter."""
        if text.endswith(END):
            body = text[: -len(END)]
            return [*body[:-1], body[-1:] + END]
        return list(text)

    def ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs of ids; none where either is missing (-1) or they do not merge."""
        code = left << 32 | right
        at = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        return np.where((self.codes[at] == code) & (left >= 0) & (right >= 0), self.rank_of[at], NO_RANK)

    def merge_all(self, texts: list[str], ended: np.ndarray) -> list[np.ndarray]:
        """Ids of stretches of byte letters by exact merging; ``ended``: a word ends there."""
        out: list = [None] * len(texts)
        sizes = np.array([len(t) for t in texts], np.int64)
        for low, high in zip((0, *WIDTHS), WIDTHS):
            rows = np.flatnonzero((sizes > low) & (sizes <= high))
            if len(rows):
                self._merge_rows([texts[i] for i in rows.tolist()], sizes[rows], ended[rows], rows, high, out)
        for i in np.flatnonzero(sizes > WIDTHS[-1]).tolist():
            symbols = self.exact_long(self.symbols(texts[i] + END * bool(ended[i])))
            out[i] = np.array(symbols, np.int64)
        return out

    def _merge_rows(self, texts: list[str], sizes: np.ndarray, ended: np.ndarray, rows: np.ndarray, width: int, out: list) -> None:
        """Merge a matrix of ids, a text each row: in each step every row merges its lowest pair, the leftmost first."""
        points = np.frombuffer("".join([t.ljust(width, "\0") for t in texts]).encode("utf-32-le"), "<u4").reshape(-1, width)
        column = np.arange(width)
        ids = np.where(column < sizes[:, None], self.letter_ids[0][points], -1)
        at_end = np.flatnonzero(ended)
        ids[at_end, sizes[at_end] - 1] = self.letter_ids[1][points[at_end, sizes[at_end] - 1]]
        ranks = self.ranks_of(ids[:, :-1], ids[:, 1:])
        while len(rows):
            best = ranks.argmin(axis=1)
            rank = ranks[np.arange(len(rows)), best]
            done = rank == NO_RANK
            for i, found in zip(rows[done].tolist(), ids[done]):
                out[i] = found[found >= 0]
            go = ~done
            rows, ids, ranks, best, rank = rows[go], ids[go], ranks[go], best[go][:, None], rank[go]
            each = np.arange(len(rows))
            np.put_along_axis(ids, best, self.made[rank][:, None], axis=1)
            ids[:, :-1] = np.where(column[:-1] > best, ids[:, 1:], ids[:, :-1])
            ids[:, -1] = -1
            ranks[:, :-1] = np.where(column[:-2] >= best, ranks[:, 1:], ranks[:, :-1])
            ranks[:, -1] = NO_RANK
            best = best[:, 0]
            left = np.flatnonzero(best > 0)
            ranks[left, best[left] - 1] = self.ranks_of(ids[left, best[left] - 1], ids[left, best[left]])
            right = each[best < width - 1]
            ranks[right, best[right]] = self.ranks_of(ids[right, best[right]], ids[right, best[right] + 1])

    def exact_long(self, symbols: list[str]) -> list[int]:
        """The same merges by a heap over linked neighbours, for very long words."""
        from heapq import heapify, heappop, heappush

        after = [*range(1, len(symbols)), -1]
        before = [*range(-1, len(symbols) - 1)]
        heap = [(r, i, a, b) for i, (a, b) in enumerate(zip(symbols, symbols[1:])) if (r := self.ranks.get((a, b))) is not None]
        heapify(heap)
        alive = [True] * len(symbols)
        while heap:
            _, i, a, b = heappop(heap)
            j = after[i]
            if not alive[i] or j < 0 or symbols[i] != a or symbols[j] != b:
                continue
            symbols[i], alive[j], after[i] = a + b, False, after[j]
            if after[i] >= 0:
                before[after[i]] = i
            for left, right in ((before[i], i), (i, after[i])):
                if left >= 0 and right >= 0 and (r := self.ranks.get((symbols[left], symbols[right]))) is not None:
                    heappush(heap, (r, left, symbols[left], symbols[right]))
        return [self.ids[s] for s, ok in zip(symbols, alive) if ok and s in self.ids]

    # -- speculation and verification --------------------------------------------------

    def greedy(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Longest tokens from the left of all words: (ids, word of each, words that tokens do not cover)."""
        found = list(self.finder.iter_long("".join([word + MARK for word in words])))
        stops, ids = (np.fromiter((f[k] for f in found), np.int64, len(found)) for k in (0, 1))
        sizes = np.array([len(word) + 1 for word in words], np.int64)
        owner = np.searchsorted(np.cumsum(sizes) - 1, stops)
        covered = np.bincount(owner, weights=self.length[ids], minlength=len(words))
        return ids, owner, covered != sizes

    def compatible(self, pairs: np.ndarray) -> np.ndarray:
        """Whether merging each pair's joined text gives the pair; id << 32 | next id.

        The low half of a lone token is all ones: merging must give back the token itself.
        """
        if len(self.pair_ok) > KNOWN_PAIRS:
            self.older_pairs, self.pair_ok = self.pair_ok, {}
        known, older = self.pair_ok, self.older_pairs
        distinct, at = np.unique(pairs, return_inverse=True)
        verdicts = list(map(known.get, distinct.tolist()))
        unknown = [k for k, ok in enumerate(verdicts) if ok is None]
        texts, ended, asked = [], [], []
        for k in unknown:
            pair = int(distinct[k])
            if (ok := older.get(pair)) is not None:
                known[pair] = verdicts[k] = ok
                continue
            a, b = pair >> 32, pair & 0xFFFFFFFF
            text = self.names[a] if b == 0xFFFFFFFF else self.names[a] + self.names[b]
            ended.append(text.endswith(END))
            texts.append(text.removesuffix(END))
            asked.append(k)
        for k, ids in zip(asked, self.merge_all(texts, np.array(ended, bool))):
            pair = int(distinct[k])
            want = [pair >> 32] if pair & 0xFFFFFFFF == 0xFFFFFFFF else [pair >> 32, pair & 0xFFFFFFFF]
            known[pair] = verdicts[k] = ids.tolist() == want
        return np.array(verdicts, bool)[at]

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Packed token ids of distinct words in byte letters."""
        if not words:
            return []
        ids, owner, wrong = self.greedy(words)
        joined = owner[1:] == owner[:-1]
        sizes = np.bincount(owner, minlength=len(words))
        single = (sizes == 1)[owner]
        pairs = np.concatenate([(ids[:-1] << 32 | ids[1:])[joined], ids[single] << 32 | 0xFFFFFFFF])
        of = np.concatenate([owner[1:][joined], owner[single]])
        wrong[of[~self.compatible(pairs)]] = True
        packed, stops = ids.astype("<u4").tobytes(), (4 * np.cumsum(sizes)).tolist()
        out = [packed[i:j] for i, j in zip([0, *stops], stops)]
        failed = np.flatnonzero(wrong).tolist()
        merged = self.merge_all([words[k] for k in failed], np.ones(len(failed), bool))
        for k, found in zip(failed, merged):
            out[k] = found.astype("<u4").tobytes()
        return out

    # -- texts -------------------------------------------------------------------------

    def pieces(self, chunk: str) -> list[str]:
        """What the splitting pattern finds in text without white space, in byte letters."""
        if chunk.isascii() and chunk.isprintable():  # such letters stand for themselves
            return [chunk] if chunk.isalpha() else self.split.findall(chunk)
        letters = self.letters
        return ["".join(map(letters.__getitem__, m.encode())) for m in self.split.findall(chunk)]

    def learn(self, chunks: set[str]) -> None:
        """Put the packed ids of these stretches without white space among the known ones."""
        if len(self.words) > KNOWN_WORDS:
            self.older_words, self.words = self.words, {}
        words, older, new = self.words, self.older_words, []
        for chunk in chunks:
            if chunk not in words:
                if (ids := older.get(chunk)) is not None:
                    words[chunk] = ids
                else:
                    new.append(chunk)
        split = [self.pieces(c) for c in new]
        distinct = list({w for ws in split for w in ws})
        ids = dict(zip(distinct, self.encode_words(distinct)))
        for chunk, ws in zip(new, split):
            words[chunk] = ids[ws[0]] if len(ws) == 1 else b"".join([ids[w] for w in ws])

    def normal(self, text: str) -> str:
        """NFC, then each character in lower case by itself (no final sigma)."""
        text = unicodedata.normalize("NFC", text) if not text.isascii() else text
        return text.replace("Σ", "σ").lower()

    def chunks(self, text: str) -> list[str]:
        text = self.normal(text)
        if text.isascii() and not any(c in text for c in "\x1c\x1d\x1e\x1f"):
            return text.split()
        return [c for c in self.spaces.split(text) if c]

    def parts(self, text: str) -> Iterator[list[str] | int]:
        """Stretches of ordinary text as chunks, and the ids of special tokens between them."""
        at = 0
        if self.at_special and "<|" in text:
            for m in self.at_special.finditer(text):
                yield self.chunks(text[at : m.start()])
                yield self.special[m.group()]
                at = m.end()
        yield self.chunks(text[at:])

    def encode_batch(self, texts: list[str | None]) -> list[bytes]:
        """Packed little-endian unsigned 32-bit ids of each whole text; nothing for none."""
        out = []
        for start in range(0, len(texts), 256):
            split = [list(self.parts(t)) if t else [] for t in texts[start : start + 256]]
            self.learn({c for parts in split for p in parts if not isinstance(p, int) for c in p})
            known = self.words
            out += [
                b"".join(
                    np.array([p], "<u4").tobytes() if isinstance(p, int) else b"".join(map(known.__getitem__, p))
                    for p in parts
                )
                for parts in split
            ]
        return out

    def decode(self, packed: bytes | None) -> str | None:
        return spell(packed, self.names)


def spell(packed: bytes | None, names: list[str]) -> str | None:
    """The tokens' text with a blank between them: the file names no decoder."""
    if packed is None:
        return None
    return " ".join(map(names.__getitem__, np.frombuffer(packed, "<u4").tolist()))


def _kept(path: str) -> tuple[tuple[str, str], tuple[str, str]]:
    """What encoding and decoding keep in a worker; the same one may serve both in turn."""
    return (WordBpe.__qualname__, path), (token_names.__name__, path)


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with column ``ids``: packed little-endian unsigned 32-bit token ids.

    The whole of each text is encoded as the tokenizer in the file ``path`` does without
    adding special tokens; special tokens written in a text are found. ``path`` is read on
    the executors. Null and empty texts have no tokens (empty ids). Repeated rows are
    encoded alike; an empty table gives none. A column named like ``ids`` is replaced.
    """

    @F.arrow_udf(T.BinaryType())
    def pack(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        hold()
        bpe = kept_in_worker(_kept(path)[0], lambda: WordBpe(path))
        for texts in batches:
            yield pa.array(bpe.encode_batch(texts.to_pylist()), pa.binary())
        bpe.older_words, bpe.older_pairs = {}, {}
        release(*_kept(path))

    return docs.withColumn(ids, pack(F.col(text).cast("string")))


def decode(docs: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``docs`` with column ``text``: what the packed ids stand for, special tokens included.

    NULL ids decode to NULL, empty ids to an empty text. A column named like ``text`` is
    replaced.
    """

    @F.arrow_udf(T.StringType())
    def unpack(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        hold()
        names = kept_in_worker(_kept(path)[1], lambda: token_names(path))
        for packed in batches:
            yield pa.array([spell(p, names) for p in packed.to_pylist()], pa.string())
        release(*_kept(path))

    return docs.withColumn(text, unpack(F.col(ids)))


def n_tokens(ids: str = "ids"):
    """How many tokens packed ids hold."""
    return F.floor(F.octet_length(ids) / 4).cast("long")
