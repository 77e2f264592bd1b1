"""Brown class-based n-grams: exchange clustering, class transitions and word emissions."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martkeep.llm.common import SMALL_GROUPS, Hasher, hold, release, signed, staged

SHAPES = 16
END = SHAPES - 1  # the code of the end of a text: no word's last four bits are all ones alone
LISTED = 1 << 18  # the most frequent words, sent to the tasks with their counts (some MB)
CLUSTERED = 2048  # of these, the words that exchange moves until nothing gains
CLASSED_LEAST = 8  # all other listed words of at least this count get the class that gains most
CLASSES = 64
KNOWN_WORDS = 400_000  # different words that a task holds at once
PIECE = 8192  # tokens a row of numbered texts
PACKED = ("codes", "numbers", "counts")
PRIOR = 5.0  # pseudo-counts of a class's successors, drawn by their overall shares


class Coder(Hasher):
    """60-bit hashes of words; the last four bits say what a word looks like."""

    @staticmethod
    def code(word: bytes) -> int:
        punctuated = word[-1:] in (b".", b",", b";", b":", b"!", b"?")
        shape = 8 * punctuated + 4 * (not word.isascii()) + min(2, len(word) // 5)
        if not word.strip(b"#*$%&|<>.,;:!?-_0123456789"):
            shape = 3  # no letter in it
        return xxhash.xxh64_intdigest(word) >> 4 << 4 | shape


class TokenReader:
    """The codes of a whole text's words (A-Z lower-cased) and of its end."""

    def __init__(self):
        self.code = Coder()

    def __call__(self, text: str | None) -> np.ndarray:
        words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
        return np.append(self.code(words), np.uint64(END))


class WordIndex(dict):
    """Word -> number, given in the order of first sight; ``new`` holds words not yet looked at."""

    def __init__(self):
        super().__init__()
        self.new: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self) + 1  # 0 is the end of a text
        self.new.append(word)
        return number


class BatchReader:
    """Texts as numbers of words, all texts of a batch on end, each with a 0 behind it.

    ``codes`` has the code of each number; ``look`` computes, from codes, arrays of what is
    known of words (see :meth:`known`), once for each word.
    """

    def __init__(self, look: Callable[[np.ndarray], tuple[np.ndarray, ...]] = lambda codes: ()):
        self.look, self.code = look, Coder.code
        self.reset()

    def reset(self) -> None:
        self.index, self.codes = WordIndex(), np.array([END], np.uint64)
        self.known = self.look(self.codes)

    def full(self) -> bool:
        return len(self.index) > KNOWN_WORDS

    def __call__(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(numbers, where each text's begin)."""
        split = [text.encode("utf-8", "surrogatepass").lower().split() if text else [] for text in texts]
        sizes = np.array([len(words) for words in split], np.int64)
        numbers = np.fromiter(map(self.index.__getitem__, chain.from_iterable(split)), np.int64, int(sizes.sum()))
        if self.index.new:
            codes = np.array([self.code(word) for word in self.index.new], np.uint64)
            self.codes = np.concatenate([self.codes, codes])
            self.known = tuple(np.concatenate(pair) for pair in zip(self.known, self.look(codes)))
            self.index.new.clear()
        stops = np.cumsum(sizes)
        return np.insert(numbers, stops, 0), stops - sizes + np.arange(len(sizes))


def _before(values: np.ndarray, end: int) -> np.ndarray:
    """What stands before each token: an end before the first of a text."""
    return np.concatenate([[end], values[:-1]])


def _number_texts(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole texts on end, as many as have some :data:`PIECE` tokens a row (see :func:`numbered_texts`)."""
    hold()
    read = BatchReader()
    for batch in rows:
        if read.full():
            read.reset()
        numbers, starts = read(batch.column(0).to_pylist())
        if not len(starts):
            continue
        cuts = starts[np.flatnonzero(np.diff(starts // PIECE, prepend=-1))].tolist()
        pieces = []
        for i, j in zip(cuts, [*cuts[1:], len(numbers)]):
            some, local, n = np.unique(numbers[i:j], return_inverse=True, return_counts=True)
            local = local.astype("<u2" if len(some) <= 1 << 16 else "<u4")
            pieces.append((read.codes[some].astype("<u8").tobytes(), n.astype("<u4").tobytes(), local.tobytes()))
        yield pa.RecordBatch.from_arrays([pa.array(column, pa.binary()) for column in zip(*pieces)], ["codes", "counts", "numbers"])
    del read
    release()


def numbered_texts(texts: DataFrame) -> DataFrame:
    """All ``texts`` read once: rows (codes, counts, numbers) of packed whole numbers, written down.

    A row holds some :data:`PIECE` tokens of whole texts, more only if one text has more:
    ``codes`` of its different words, the end first, ``counts`` of each, and of every token its
    place in ``codes``, in two bytes if that is enough. A text ends with a 0. All further passes
    start from these, so no word is cut out of a text, hashed or looked up twice.
    """
    numbered = texts.select(F.col("text").cast("string").alias("text")).mapInArrow(_number_texts, "codes binary, counts binary, numbers binary")
    return staged(numbered, "brown-numbers", SMALL_GROUPS)


def _codes(packed: pa.Scalar) -> np.ndarray:
    return np.frombuffer(packed.as_buffer(), "<u8")


def _pieces(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(codes, numbers) of each row of a batch of (codes, numbers, counts)."""
    for codes, numbers, counts in zip(*batch.columns):
        numbers, tokens = numbers.as_buffer(), int(np.frombuffer(counts.as_buffer(), "<u4").sum(dtype=np.int64))
        yield _codes(codes), np.frombuffer(numbers, "<u2" if numbers.size == 2 * tokens else "<u4")


def _count_words(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's counts of words, in parts if there are very many."""
    codes, counts, waiting, held = np.empty(0, np.uint64), np.empty(0, np.int64), [], 0

    def merge() -> None:
        nonlocal codes, counts, waiting, held
        codes, at = np.unique(np.concatenate([codes, *[c for c, _ in waiting]]), return_inverse=True)
        counts = np.bincount(at, weights=np.concatenate([counts, *[n for _, n in waiting]]), minlength=len(codes)).astype(np.int64)
        waiting, held = [], 0

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(signed(codes)), pa.array(counts)], ["code", "n"])

    for batch in rows:
        for packed, n in zip(*batch.columns):
            waiting.append((_codes(packed), np.frombuffer(n.as_buffer(), "<u4")))
            held += len(waiting[-1][0])
        if held > KNOWN_WORDS:
            merge()
        if len(codes) > KNOWN_WORDS:  # counts are summed anyway, so a task may send parts
            yield out()
            codes, counts = codes[:0], counts[:0]
    merge()
    yield out()
    del codes, counts
    release()


def count_words(texts: DataFrame) -> DataFrame:
    """(code, n) of every token, ends included."""
    return _counted(numbered_texts(texts))


def _counted(numbered: DataFrame) -> DataFrame:
    counted = numbered.select("codes", "counts").mapInArrow(_count_words, "code long, n long")
    return counted.groupBy("code").agg(F.sum("n").alias("n"))


def _count_pairs(look: Callable[[np.ndarray], np.ndarray], size: int):
    """A task's counts of neighbours, as ``first * size + second`` of what ``look`` makes of codes."""
    end = int(look(np.array([END], np.uint64))[0])

    def count(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, waiting, held = np.zeros(size * size, np.int64), [], 0

        def add() -> None:
            nonlocal waiting, held
            total[:] += np.bincount(np.concatenate([np.empty(0, np.int64), *waiting]), minlength=size * size)
            waiting, held = [], 0

        for batch in rows:
            for codes, numbers in _pieces(batch):
                ids = look(codes)[numbers]
                waiting.append(_before(ids, end) * size + ids)
                held += len(ids)
                if held > 1_000_000:
                    add()
        add()
        (some,) = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["pair", "n"])
        del total
        release()

    return count


def listed_words(counts: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Codes and counts of all words with a count from some number on, at most ``most`` of them.

    The number is found from a histogram of logarithms, whose size does not grow.
    """
    step = F.floor(F.log2("n") * 64).cast("int")
    histogram = counts.groupBy(step.alias("step")).agg(F.count("*").alias("words"), F.min("n").alias("least")).orderBy(F.desc("step")).collect()
    total, least = 0, 1 << 62
    for row in histogram:
        total += row["words"]
        if total > most:
            break
        least = row["least"]
    rows = counts.where(F.col("n") >= least).toArrow()
    codes = rows.column("code").to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(codes)
    return codes[order], rows.column("n").to_numpy().astype(np.int64)[order], least


# -- classes ---------------------------------------------------------------------------------


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-12))


def exchange(classes: np.ndarray, left: np.ndarray, right: np.ndarray, own: np.ndarray, n: int) -> np.ndarray:
    """Each word, the most frequent first, to the class where the likelihood gains most.

    left and right: counts of a word's predecessors and successors by class; own: of itself
    after itself. Classes from ``n`` on are fixed and not chosen. Counts of words between
    moves are those of the round's start.
    """
    classes = classes.copy()
    size = left.shape[1]
    between = np.zeros((size, size))
    np.add.at(between, classes, right)
    words = np.flatnonzero(classes < n)
    for w in words[np.argsort(-right[words].sum(axis=1), kind="stable")]:
        a, r, l, s = classes[w], right[w].astype(float), left[w].astype(float), float(own[w])
        r[a] -= s
        l[a] -= s
        m = between
        m[a, :] -= r
        m[:, a] -= l
        m[a, a] -= s
        np.maximum(m, 0, out=m)
        rows, columns = m.sum(axis=1), m.sum(axis=0)
        gain = (_xlogx(m[:n] + r) - _xlogx(m[:n])).sum(axis=1) + (_xlogx(m[:, :n] + l[:, None]) - _xlogx(m[:, :n])).sum(axis=0)
        d = np.arange(n)
        corner = m[d, d]
        gain += _xlogx(corner + r[:n] + l[:n] + s) + _xlogx(corner) - _xlogx(corner + r[:n]) - _xlogx(corner + l[:n])
        gain -= _xlogx(rows[:n] + r.sum() + s) - _xlogx(rows[:n]) + _xlogx(columns[:n] + l.sum() + s) - _xlogx(columns[:n])
        b = int(np.argmax(gain))
        m[b, :] += r
        m[:, b] += l
        m[b, b] += s
        classes[w] = b
    return classes


def likelihood(between: np.ndarray) -> float:
    return float(_xlogx(between).sum() - _xlogx(between.sum(axis=1)).sum() - _xlogx(between.sum(axis=0)).sum())


def _vectors(classes: np.ndarray, size: int):
    """Of rows (word, other, n, side) sorted by word: a word's counts by class of the other."""

    def gather(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for batch in rows:
            word, other, n, side = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            for w in np.unique(word):
                at = word == w
                v = found.setdefault(int(w), np.zeros(2 * size + 1, np.int64))
                np.add.at(v, side[at] * size + classes[other[at]], n[at])
                v[-1] += n[at][(other[at] == w) & (side[at] == 1)].sum()
        words = list(found)
        yield pa.RecordBatch.from_arrays(
            [pa.array(words, pa.int64()), pa.array([found[w] for w in words], pa.list_(pa.int64()))], ["word", "v"]
        )

    return gather


@dataclass
class BrownModel:
    """A fitted model: word classes, transitions, and what a word's count says of it."""

    codes: np.ndarray  # listed words, sorted
    counts: np.ndarray
    classes: np.ndarray  # of the listed words
    emission: np.ndarray  # log10 P(word | class) of the listed words
    transition: np.ndarray  # log10 P(class | class before)
    shape_tokens: np.ndarray  # tokens of words outside the clusters, by shape
    shape_words: np.ndarray  # different ones
    discount: float
    least: int  # words of at least this count are listed
    train_tokens: int
    vocabulary: int
    word_counts: DataFrame  # (code, n) of all words


def cluster(numbered: DataFrame, symbols: np.ndarray, classes: int, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Classes of the sorted ``symbols`` by rounds of exchange, and the counts between classes.

    Symbols beyond these are one class per shape, the end one more. The counts of pairs of
    neighbours form a table of at most (len(symbols) + SHAPES)^2 rows; every round reads it
    and yields one vector of counts by class per symbol.
    """
    n, size = len(symbols), classes + SHAPES
    total = n + SHAPES

    counted = numbered.select(*PACKED).mapInArrow(_count_pairs(lambda codes: symbol_ids(codes, symbols), total), "pair long, n long")
    table = counted.groupBy("pair").agg(F.sum("n").alias("n"))
    one, two = F.floor(F.col("pair") / total).cast("long"), F.col("pair") % total
    sides = F.explode(F.array(
        F.struct(one.alias("word"), two.alias("other"), "n", F.lit(1).cast("long").alias("side")),
        F.struct(two.alias("word"), one.alias("other"), "n", F.lit(0).cast("long").alias("side")),
    ))
    rows = staged(table.select(sides.alias("x")).select("x.*").repartition("word").sortWithinPartitions("word"), "brown-pairs")
    of = np.concatenate([np.arange(n) % classes, classes + np.arange(SHAPES)])
    best, best_between, best_value = of, np.zeros((size, size)), -np.inf
    for step in range(rounds + 1):
        left, right, own = np.zeros((total, size)), np.zeros((total, size)), np.zeros(total)
        for row in rows.mapInArrow(_vectors(of, size), "word long, v array<long>").groupBy("word").agg(F.collect_list("v").alias("v")).collect():
            v = np.sum(row["v"], axis=0)
            left[row["word"]], right[row["word"]], own[row["word"]] = v[:size], v[size:-1], v[-1]
        between = np.zeros((size, size))
        np.add.at(between, of, right)
        if (value := likelihood(between)) > best_value:
            best, best_between, best_value = of, between, value
        if step < rounds and n:
            of = exchange(of, left, right, own, classes)
    return best[:n], best_between


def symbol_ids(codes: np.ndarray, symbols: np.ndarray) -> np.ndarray:
    """Places of codes among sorted symbols; beyond them, len(symbols) + shape."""
    shape = (codes & np.uint64(SHAPES - 1)).astype(np.int64) + len(symbols)
    if not len(symbols):
        return shape
    at = np.minimum(np.searchsorted(symbols, codes), len(symbols) - 1)
    return np.where(symbols[at] == codes, at, shape)


# -- classes of all other words ------------------------------------------------------------------


def _count_neighbours(words: np.ndarray, look: Callable[[np.ndarray], np.ndarray], size: int):
    """A task's counts (word, slot, n) of the classes before (slot) and after (size + slot) each of ``words``."""
    end = int(look(np.array([END], np.uint64))[0])

    def both(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(words, codes), len(words) - 1)
        return np.where(words[at] == codes, at, -1), look(codes)

    def count(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, held = [], 0
        keys, counts = np.empty(0, np.int64), np.empty(0, np.int64)

        def merge() -> None:
            nonlocal keys, counts, waiting, held
            fresh, many = np.unique(np.concatenate([np.empty(0, np.int64), *waiting]), return_counts=True)
            every, at = np.unique(np.concatenate([keys, fresh]), return_inverse=True)
            counts = np.bincount(at, weights=np.concatenate([counts, many]), minlength=len(every)).astype(np.int64)
            keys, waiting, held = every, [], 0

        def out() -> pa.RecordBatch:
            word, slot = np.divmod(keys, 2 * size)
            return pa.RecordBatch.from_arrays([pa.array(word), pa.array(slot.astype(np.int32)), pa.array(counts)], ["word", "slot", "n"])

        for batch in rows:
            for codes, numbers in _pieces(batch):
                word, of = (known[numbers] for known in both(codes))
                at = np.flatnonzero(word >= 0)
                mine = word[at] * 2 * size
                waiting += [mine + _before(of, end)[at], mine + size + of[at + 1]]  # an end stands behind every word
                held += 2 * len(at)
                if held > 2_000_000:
                    merge()
            if len(keys) > 4_000_000:  # counts are summed anyway, so a task may send parts
                yield out()
                keys, counts = keys[:0], counts[:0]
        merge()
        yield out()
        del keys, counts
        release()

    return count


def best_classes(left: np.ndarray, right: np.ndarray, now: np.ndarray, between: np.ndarray, n: int) -> np.ndarray:
    """For each word, by its counts of classes before and after it, the class that gains most likelihood.

    ``now`` is the class, none of the first ``n``, by which the word is counted in
    ``between``; the gain is that of moving it from there, all other words staying.
    """
    m, rows, columns = between, between.sum(axis=1)[:n], between.sum(axis=0)[:n]
    corner = m[np.arange(n), np.arange(n)]
    out = np.empty(len(left), np.int64)
    for start in range(0, len(left), 256):
        l, r = (x[start : start + 256].astype(float) for x in (left, right))
        of = now[start : start + 256]
        each = np.arange(len(of))
        # What follows each class and what precedes it, without the word where it is now.
        down, across = (np.repeat(x[None], len(of), axis=0) for x in (m[:n], m[:, :n].T))
        down[each, :, of] -= l[:, :n]
        across[each, :, of] -= r[:, :n]
        gain = (_xlogx(down + r[:, None]) - _xlogx(down)).sum(axis=2) + (_xlogx(across + l[:, None]) - _xlogx(across)).sum(axis=2)
        gain += _xlogx(corner + r[:, :n] + l[:, :n]) + _xlogx(corner) - _xlogx(corner + r[:, :n]) - _xlogx(corner + l[:, :n])
        gain -= _xlogx(rows + r.sum(axis=1)[:, None]) - _xlogx(rows) + _xlogx(columns + l.sum(axis=1)[:, None]) - _xlogx(columns)
        out[start : start + 256] = gain.argmax(axis=1)
    return out


def _assign(now: np.ndarray, between: np.ndarray, n: int):
    """(word, class) of rows (word, slot, n) sorted by word."""
    size = len(between)

    def assign(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.empty(0, np.int64)] * 3
        for batch in chain(rows, [None]):
            if batch is not None:
                held = [np.concatenate([old, c.to_numpy(zero_copy_only=False).astype(np.int64)]) for old, c in zip(held, batch.columns)]
            word, slot, counts = held
            if not len(word):
                continue
            # The last word may go on in the next batch.
            done = len(word) if batch is None else int(np.searchsorted(word, word[-1]))
            words, at = np.unique(word[:done], return_inverse=True)
            if len(words):
                vectors = np.zeros((len(words), 2 * size), np.int64)
                np.add.at(vectors, (at, slot[:done]), counts[:done])
                found = best_classes(vectors[:, :size], vectors[:, size:], now[words], between, n)
                yield pa.RecordBatch.from_arrays([pa.array(words), pa.array(found)], ["word", "class"])
            held = [x[done:] for x in held]
        release()

    return assign


def classify(numbered: DataFrame, words: np.ndarray, look: Callable[[np.ndarray], np.ndarray], between: np.ndarray, n: int) -> np.ndarray:
    """Classes of the sorted ``words``, from the classes of their neighbours in all texts.

    Neighbours are counted in tasks and by a shuffle, at most 2 x classes rows a word; classes
    are chosen in tasks. Words and classes, at most :data:`LISTED`, come to the driver.
    """
    counted = numbered.select(*PACKED).mapInArrow(_count_neighbours(words, look, len(between)), "word long, slot int, n long")
    sums = staged(counted.groupBy("word", "slot").agg(F.sum("n").alias("n")), "brown-neighbours")
    chosen = sums.repartition("word").sortWithinPartitions("word").mapInArrow(_assign(look(words), between, n), "word long, class long").toArrow()
    out = np.zeros(len(words), np.int64)
    out[chosen["word"].to_numpy()] = chosen["class"].to_numpy()
    return out


def train_brown(
    texts: DataFrame, listed: int = LISTED, clustered: int = CLUSTERED, classes: int = CLASSES, rounds: int = 8, classed_least: int = CLASSED_LEAST
) -> BrownModel:
    """A class bigram model of all ``texts`` (column text), whole.

    The ``clustered`` most frequent words are the seeds that exchange deals into classes. All
    other listed words that occur ``classed_least`` times then get the class that gains most
    likelihood, by the classes of their neighbours, in tasks. Transitions are counted anew
    with all of these classes. Only words that are rarer, whose neighbours say little, have
    a class by what they look like.

    Counts of words and of neighbours cover every text and stay tables; what comes to the
    driver is bounded by ``listed``, ``clustered`` and ``classes``. The texts are read once, and written as
    numbers of words for the four passes that follow.
    """
    numbered = numbered_texts(texts)
    counts = staged(_counted(numbered), "brown-words")
    codes, n, least = listed_words(counts, listed)
    of_word = codes != np.uint64(END)
    order = np.argsort(-n[of_word], kind="stable")[:clustered]
    symbols = np.sort(codes[of_word][order])
    of_symbol, between = cluster(numbered, symbols, classes, rounds)
    ids = symbol_ids(codes, symbols)

    def class_of(words: np.ndarray, of: np.ndarray) -> Callable[[np.ndarray], np.ndarray]:
        return lambda found: np.append(of, classes + np.arange(SHAPES))[symbol_ids(found, words)]

    of_listed = class_of(symbols, of_symbol)(codes)
    more = (ids >= len(symbols)) & of_word & (n >= classed_least)
    if more.any() and len(symbols):
        of_listed[more] = classify(numbered, codes[more], class_of(symbols, of_symbol), between, classes)
        learned = of_listed < classes
        size = classes + SHAPES
        pairs = numbered.select(*PACKED).mapInArrow(_count_pairs(class_of(codes[learned], of_listed[learned]), size), "pair long, n long")
        between = np.zeros(size * size)
        for row in pairs.groupBy("pair").agg(F.sum("n").alias("n")).collect():
            between[row["pair"]] = row["n"]
        between = between.reshape(size, size)
        symbols = codes[learned]
    outside = counts
    shape = F.col("code").bitwiseAND(SHAPES - 1)
    tokens, words, once, twice = np.zeros(SHAPES), np.zeros(SHAPES), 0, 0
    for row in outside.groupBy(shape.cast("int").alias("shape")).agg(
        F.sum("n").alias("n"), F.count("*").alias("words"), F.count_if(F.col("n") == 1).alias("once"), F.count_if(F.col("n") == 2).alias("twice")
    ).collect():
        tokens[row["shape"]], words[row["shape"]] = row["n"], row["words"]
        once, twice = once + row["once"], twice + row["twice"]
    train, vocabulary = int(tokens.sum()), int(words.sum())
    where = np.searchsorted(codes, symbols)
    symbol_shape = (symbols & np.uint64(SHAPES - 1)).astype(int)
    np.subtract.at(tokens, symbol_shape, n[where])
    np.subtract.at(words, symbol_shape, 1)
    discount = once / (once + 2 * twice) if once and twice else 0.5
    class_tokens = np.bincount(of_listed, weights=n, minlength=classes + SHAPES)
    log = np.log10
    with np.errstate(divide="ignore", invalid="ignore"):
        emission = np.where(
            of_listed < classes,
            log(n) - log(np.maximum(class_tokens[of_listed], 1)),
            log(np.maximum(n - discount, 1e-9)) - log(np.maximum(np.append(np.zeros(classes), tokens)[of_listed], 1)),
        )
    emission[~of_word] = 0.0  # the end is alone in its class
    share = (between.sum(axis=0) + 1e-3) / (between.sum() + 1e-3 * len(between))
    transition = log((between + PRIOR * share) / (between.sum(axis=1, keepdims=True) + PRIOR))
    return BrownModel(codes, n, of_listed, emission, transition, tokens, words, discount, least, train, vocabulary, counts)


# -- scores ------------------------------------------------------------------------------------


def score_texts(docs: DataFrame, model: BrownModel) -> DataFrame:
    """Per row of ``docs`` (doc_id, text, further columns): n_tokens, n_known, train_tokens,
    base_score and score, log10 probabilities of the whole text and its end.

    base_score is the add-one unigram model. score sums the transition between the classes
    of neighbours and the emission of each word by its class. Words without a learned class
    are emitted by their shape's class with discounted counts; what the discount frees is
    the probability of the shape's unknown words. Counts of listed words travel with the
    task; all other words of a text are joined with the table of counts, exactly.

    Null and empty texts have one token, the end. Repeated rows are all returned, scored
    alike. With nothing to learn from, counts are 0 and scores finite. An empty table gives
    none. Of the columns of ``docs`` those named like an output are replaced.
    """
    m = model
    floor = m.train_tokens + m.vocabulary + 1
    base = np.log10((m.counts + 1) / floor)
    classes = len(m.transition) - SHAPES
    listed_codes, listed_classes, transition, emission = m.codes, m.classes, m.transition, m.emission

    def look(codes: np.ndarray) -> tuple[np.ndarray, ...]:
        """Whether words are listed, their class, and what each adds to the two scores."""
        ids = symbol_ids(codes, listed_codes)
        n = len(listed_codes)
        known, at = ids < n, np.minimum(ids, max(n - 1, 0))
        if not n:
            return known, classes + ids, np.zeros(len(codes)), np.zeros(len(codes))
        return known, np.where(known, listed_classes[at], classes + ids - n), np.where(known, base[at], 0.0), np.where(known, emission[at], 0.0)

    def read_texts(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold()
        read = BatchReader(look)
        for batch in rows:
            if read.full():
                read.reset()
            numbers, starts = read(batch.column(1).to_pylist())
            sizes = np.diff(np.append(starts, len(numbers)))
            known, of, of_base, of_emission = (x[numbers] for x in read.known)
            path = transition[_before(of, classes + END), of]
            rare = np.flatnonzero(~known)
            text, code = np.repeat(np.arange(len(sizes)), sizes)[rare], read.codes[numbers[rare]]
            order = np.lexsort((code, text))
            text, code = text[order], code[order]
            first = np.flatnonzero(np.concatenate([[True], (text[1:] != text[:-1]) | (code[1:] != code[:-1])])) if len(text) else np.empty(0, np.int64)
            many = np.diff(np.append(first, len(text)))
            ends = np.searchsorted(text[first], np.arange(len(sizes) + 1)).astype(np.int32)

            def total(values: np.ndarray) -> np.ndarray:
                return np.add.reduceat(values, starts) if len(starts) else values

            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(sizes), pa.array(total(known.astype(np.int64))), pa.array(total(of_base)),
                    pa.array(total(path + of_emission)), pa.ListArray.from_arrays(pa.array(ends), pa.array(signed(code[first]))),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(many)),
                ],
                ["row", "n_tokens", "n_known", "base_score", "score", "codes", "many"],
            )
        del read
        release()

    outputs = ["n_tokens", "n_known", "train_tokens", "base_score", "score"]
    keep = [c for c in docs.columns if c != "text" and c not in outputs]
    # Rows are numbered so that the parts of a text find back; the numbers are written down.
    numbered = docs.select(*[F.col(f"`{c}`") for c in keep], F.col("text").cast("string").alias("text")).withColumn(
        "row", F.struct(F.monotonically_increasing_id().alias("id"), *[F.col(f"`{c}`") for c in keep])
    )
    row_type = numbered.schema["row"].dataType.simpleString()
    read = staged(
        numbered.select("row", "text").mapInArrow(
            read_texts,
            f"row {row_type}, n_tokens long, n_known long, base_score double, score double, codes array<long>, many array<long>",
        ),
        "brown-texts",
    )
    rest = read.select(F.col("row.id").alias("id"), F.explode(F.arrays_zip("codes", "many")).alias("x")).select("id", "x.codes", "x.many")
    few = m.word_counts.where(F.col("n") < m.least)
    met = rest.join(few, F.col("codes") == F.col("code"), "left")
    shape = F.col("codes").bitwiseAND(SHAPES - 1).cast("int")
    tokens = F.element_at(F.array(*[F.lit(float(max(t, 1))) for t in m.shape_tokens]), shape + 1)
    unknown = F.element_at(F.array(*[F.lit(float(max(m.discount * w, 1e-3))) for w in m.shape_words]), shape + 1)
    mass = F.when(F.col("n").isNull(), unknown).otherwise(F.col("n") - m.discount)
    sums = met.groupBy("id").agg(
        F.sum(F.when(F.col("n").isNotNull(), F.col("many")).otherwise(0)).alias("more_known"),
        F.sum(F.col("many") * F.log10((F.coalesce("n", F.lit(0)) + 1) / F.lit(float(floor)))).alias("more_base"),
        F.sum(F.col("many") * F.log10(mass / tokens)).alias("more_score"),
    )
    plain = read.select("row.*", "n_tokens", "n_known", "base_score", "score")
    joined = plain.withColumnRenamed("id", "row_id").join(sums, F.col("row_id") == F.col("id"), "left")

    def plus(name: str, more: str):
        return (F.col(name) + F.coalesce(more, F.lit(0))).alias(name)

    return joined.select(
        *[F.col(f"`{c}`") for c in keep], "n_tokens", plus("n_known", "more_known"),
        F.lit(m.train_tokens).cast("long").alias("train_tokens"), plus("base_score", "more_base"), plus("score", "more_score"),
    )
