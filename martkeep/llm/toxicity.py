"""Toxicity by a weighted finite-state grammar over clauses.

Words pass a lexicon transducer that turns them into marks (insult, threat, target,
negation, reported speech, clause end), and the marks pass a pattern transducer that emits
one pattern per insult or threat with what governs it in its clause. Insults, words that
threaten when they are aimed at someone, and the weight of each pattern, are learned from
labelled texts; the closed classes (targets, negations, words of report) are given.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martkeep.llm.common import release, staged

INSULT, THREAT, TARGET, NEGATION, REPORTED, END, GAP, SPLIT, PARTICLE = range(9)

#: Closed word classes of the grammar in the four languages of the corpus.
def _forms(stems: str, endings: str) -> list[str]:
    return [stem + ending.strip("-") for stem in stems.split() for ending in endings.split()]


#: Where learning starts; words that labelled texts show to threaten are added.
THREATS = [
    *_forms("kill destroy burn", "- s ed ing"), *"hurt hurts hurting burnt".split(),
    *_forms("tu", "er e es ons ez ent ai as a é ée és ées ant erai eras era erons erez eront erais erait"),
    *_forms("détrui", "re s t sons sez sent sant te ts tes rai ras ra rons rez ront rais rait"),
    *_forms("töt", "en e est et ete eten end"), *"getötet umbringen umzubringen umgebracht umbringe umbringst umbringt".split(),
    *_forms("mat", "ar o as a amos an é aste ó aron ando ado aré arás ará aremos arán aría"),
    *_forms("destru", "ir yo yes ye imos yen í iste yó yeron yendo ido iré irás irá iremos irán iría"),
]
#: Forms of the German verb whose particle, at the end of the clause, makes it a threat.
SPLITS, PARTICLES = "bringe bring bringst bringt bringen brachte brachtest brachten".split(), ("um",)
TARGETS = (
    "you your he she they him her them his tu vous il elle ils elles toi lui du ihr er sie "
    "dich euch tú usted ustedes él ella ellos te"
).split()
NEGATIONS = "not no never nobody isn't don't ne pas jamais nicht kein keine nie nunca jamás".split()
REPORTS = (
    "said says wrote claimed quoted called dit écrit appelle sagte schrieb nannte dijo escribió llamó"
).split()
EDGES = "'\"()[]{}<>|.,;:!?-_*#$%&«»“”„’¿¡"
CLAUSE_ENDS = (".", "!", "?", ";", ":")

#: Patterns the grammar emits and the weight of each before anything is learned.
PATTERNS = {"plain": 1.0, "targeted": 1.2, "negated": 0.6, "reported": 0.6, "threat": 1.0, "covered_threat": 0.3}
START, AIMED, DENIED, QUOTED, THREATENED, SWORN = range(6)
#: (state, mark) -> (next state, patterns emitted); a mark without an arc leaves the state.
ARCS: dict[tuple[int, int], tuple[int, tuple[str, ...]]] = {
    **{(s, END): (START, ()) for s in (START, AIMED, DENIED, QUOTED, THREATENED)},
    **{(s, REPORTED): (QUOTED, ()) for s in (START, AIMED, DENIED)},
    (START, TARGET): (AIMED, ()),
    (START, NEGATION): (DENIED, ()),
    (AIMED, NEGATION): (DENIED, ()),
    (AIMED, GAP): (START, ()),
    (DENIED, GAP): (START, ()),
    (START, INSULT): (START, ("plain",)),
    (AIMED, INSULT): (AIMED, ("targeted",)),
    (DENIED, INSULT): (DENIED, ("negated",)),
    (QUOTED, INSULT): (QUOTED, ("reported",)),
    (DENIED, THREAT): (DENIED, ("covered_threat",)),
    (QUOTED, THREAT): (QUOTED, ("covered_threat",)),
    (START, THREAT): (THREATENED, ()),  # open until its target follows
    (THREATENED, NEGATION): (DENIED, ("covered_threat",)),
    (THREATENED, REPORTED): (QUOTED, ("covered_threat",)),
    (THREATENED, INSULT): (THREATENED, ("plain",)),
    (THREATENED, GAP): (START, ()),
    # With its target a threat is made, unless what follows takes it back.
    (AIMED, THREAT): (SWORN, ()),
    (THREATENED, TARGET): (SWORN, ()),
    (SWORN, NEGATION): (DENIED, ("covered_threat",)),
    (SWORN, REPORTED): (QUOTED, ("covered_threat",)),
    (SWORN, THREAT): (SWORN, ("threat",)),
    (SWORN, INSULT): (AIMED, ("threat", "targeted")),
    (SWORN, END): (START, ("threat",)),
    (SWORN, GAP): (START, ("threat",)),
}
REACH = 3  # unmarked words over which a target or a negation still holds
STEMS = range(4, 8)  # code points of a word's beginning that may stand for its family


def core(token: str) -> str:
    """A lower-cased token without the punctuation around it."""
    return token.strip(EDGES)


def terms(text: str) -> set[str]:
    """The words of a text and their beginnings, the latter marked by a final asterisk."""
    return families(set(text.lower().split()))


def families(tokens: set[str]) -> set[str]:
    """The words of tokens and their beginnings; see :func:`terms`."""
    found = set()
    for word in set(map(core, tokens)):
        if word:
            found.add(word)
            found.update(f"{word[:k]}*" for k in STEMS if len(word) > k)
    return found


class Lexicon(dict):
    """Token -> (mark, weight, ends clause) or None; worked out once per token, kept bounded."""

    def __init__(self, insults: dict[str, float], keep: int = 100_000, threats: dict[str, float] | None = None):
        super().__init__()
        self.learned = {**{t: (THREAT, w) for t, w in (threats or {}).items()}, **{t: (INSULT, w) for t, w in insults.items()}}
        self.keep = keep
        self.stems = sorted({len(t) - 1 for t in self.learned if t.endswith("*")}, reverse=True)
        self.marks = {
            **dict.fromkeys(TARGETS, TARGET),
            **dict.fromkeys(THREATS, THREAT),
            **dict.fromkeys(NEGATIONS, NEGATION),
            **dict.fromkeys(REPORTS, REPORTED),
            **dict.fromkeys(SPLITS, SPLIT),
            **dict.fromkeys(PARTICLES, PARTICLE),
        }

    def __missing__(self, token: str):
        word = core(token)
        known = self.learned.get(word)
        for k in self.stems if known is None else ():
            if len(word) > k and (known := self.learned.get(f"{word[:k]}*")) is not None:
                break
        ends = token.endswith(CLAUSE_ENDS)
        given = self.marks.get(word)
        if known is None or (known[0] == THREAT and given is not None):
            known = given, 1.0  # a closed class is not learned anew
        entry = (*known, ends) if known[0] is not None or ends else None
        self[token] = entry
        return entry

    def trim(self) -> None:
        if len(self) > self.keep:
            self.clear()


def states(tokens: list[str], found: list) -> Iterator[tuple[int, int, list[tuple[str, float]]]]:
    """Place, state, and patterns with their word's weight, of every marked token in one pass of the grammar.

    A clause goes on after a colon in reported speech. The text's end ends its last clause.
    """
    state, last, split, sworn = START, -1, False, 1.0

    def step(mark: int, weight: float = 1.0) -> list[tuple[str, float]]:
        nonlocal state
        state, patterns = ARCS.get((state, mark), (state, ()))
        return [(p, sworn if p.endswith("threat") else weight) for p in patterns]

    for at, entry in enumerate(found):
        if entry is None:
            continue
        mark, weight, ends = entry
        if mark == SPLIT:
            split, mark = True, None
        elif mark == PARTICLE:
            closing = at + 1 == len(found) or tokens[at][-1] in EDGES
            split, mark = split and not closing, THREAT if split and closing else None
        if mark is not None:
            if at - last > REACH and (patterns := step(GAP)):
                yield last, state, patterns
            # A threat that is open already is made before its successor's weight counts.
            patterns, sworn = (step(mark, weight), weight) if mark == THREAT and state == SWORN else (None, weight if mark == THREAT else sworn)
            last = at
            patterns = step(mark, weight) if patterns is None else patterns
            yield at, state, patterns
        if ends and not (state == QUOTED and tokens[at].endswith(":")):
            split = False
            patterns = step(END)
            yield at, state, patterns
    if state == SWORN:
        yield last, START, step(END)


def matches(text: str | None, lexicon: Lexicon) -> list[tuple[str, float]]:
    """The patterns that the grammar finds in a whole text, with the weight of their word."""
    if not text:
        return []
    tokens = text.lower().split()
    found = list(map(lexicon.__getitem__, tokens))
    marks = {e[0] for e in set(found) if e is not None}
    if not marks & {INSULT, THREAT} and not marks >= {SPLIT, PARTICLE}:
        return []
    return [pattern for *_, patterns in states(tokens, found) for pattern in patterns]


def features(text: str | None, lexicon: Lexicon) -> list[float]:
    """Summed word weights by pattern, each sum damped by a logarithm."""
    sums = Counter()
    for pattern, weight in matches(text, lexicon):
        sums[pattern] += weight
    return [float(np.log1p(sums[p])) for p in PATTERNS]


def open_terms(text: str, lexicon: Lexicon) -> set[str]:
    """The :func:`terms` of a text that stand where an insult would be plain or targeted."""
    tokens = text.lower().split()
    found = list(map(lexicon.__getitem__, tokens))
    out: set[str] = set()
    begin, state, last = 0, START, -1

    def pass_to(end: int) -> None:
        # a negation holds over REACH words, reported speech to the end of its clause
        if state not in (DENIED, QUOTED):
            out.update(tokens[begin:end])
        elif state == DENIED:
            out.update(tokens[max(begin, last + 1 + REACH) : end])

    for at, now, _ in states(tokens, found):
        if now == START and found[at][2]:  # the token that ends a clause is still in it
            pass_to(at + 1)
            begin, state, last = at + 1, START, at
        else:
            pass_to(at)
            begin, state, last = at, now, at
    pass_to(len(tokens))
    return families(out)


def aimed_terms(text: str, lexicon: Lexicon) -> set[str]:
    """The :func:`terms` of a text that stand within :data:`REACH` words of a target in its clause, not denied or reported."""
    tokens = text.lower().split()
    found = list(map(lexicon.__getitem__, tokens))
    out: set[str] = set()
    begin, covered, targets = 0, False, []
    for at, entry in enumerate([*found, (None, 1.0, True)]):
        if entry is None:
            continue
        mark, _, ends = entry
        covered |= mark in (NEGATION, REPORTED)
        if mark == TARGET:
            targets.append(at)
        if ends:
            stop = min(at + 1, len(tokens))
            for k in () if covered else targets:
                out.update(tokens[max(begin, k - REACH) : k], tokens[k + 1 : min(stop, k + 1 + REACH)])
            begin, covered, targets = stop, False, []
    return families({t for t in out if lexicon[t] is None or lexicon[t][0] is None})


def _count_terms(only: set[str] | None):
    lexicon = Lexicon({})

    def count(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every, plain = Counter(), Counter()
        for batch in rows:
            lexicon.trim()
            for text in batch.column(0).to_pylist():
                found, free = terms(text or ""), open_terms(text or "", lexicon)
                every.update(found if only is None else found & only)
                plain.update(free if only is None else free & only)
        names = list(every)
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array([every[t] for t in names], pa.int64()), pa.array([plain[t] for t in names], pa.int64())],
            ["term", "n", "free"],
        )
        del every, plain, names
        release()

    return count


def _term_counts(rows: DataFrame, only: set[str] | None) -> DataFrame:
    """Per term: texts that hold it (n), and that do where an insult is plain or targeted (free)."""
    counted = rows.select("text").mapInArrow(_count_terms(only), "term string, n long, free long")
    return counted.groupBy("term").agg(F.sum("n").alias("n"), F.sum("free").alias("free"))


def explaining(lists: list[np.ndarray], n: int, damp: float = 0.7, least: float = 2.0) -> list[int]:
    """Which of ``n`` terms explain the toxic texts, whose terms are ``lists``.

    The term with the most evidence is taken, its texts count less for the next, until no
    term has the evidence of ``least`` texts: words that only happen to stand beside
    insults lose their evidence to these.
    """
    holders: list[list[int]] = [[] for _ in range(n)]
    for d, terms_ in enumerate(lists):
        for t in terms_:
            holders[t].append(d)
    evidence = np.array([len(h) for h in holders], float)
    weight, taken = np.ones(len(lists)), []
    while n and evidence[t := int(np.argmax(evidence))] >= least:
        taken.append(t)
        for d in holders[t]:
            evidence[lists[d]] -= (1 - damp) * weight[d]
            weight[d] *= damp
        evidence[t] = -1e18
    return taken


def log_odds(hits: int, misses: int, n_toxic: int, n_clean: int) -> tuple[float, float]:
    """Logarithm of how much likelier toxic texts hold a term than clean ones, and its standard error."""
    odds = np.log((hits + 0.5) / (n_toxic + 1)) - np.log((misses + 0.5) / (n_clean + 1))
    return float(odds), float(np.sqrt(1 / (hits + 0.5) + 1 / (misses + 0.5)))


def loose_families(odds: dict[str, float], toxic: dict[str, int], clean: dict[str, int], n_toxic: int, n_clean: int, ratio: float) -> set[str]:
    """Families that owe their evidence to one word, while their other words are in clean texts as well.

    ``toxic`` and ``clean`` count the texts of each term. A family stays if half of its toxic
    texts, or what is left without its most frequent word, speak for it.
    """
    chief: dict[str, str] = {}
    for word in odds:
        if not word.endswith("*"):
            for k in STEMS:
                family = f"{word[:k]}*"
                if family in odds and toxic[word] > toxic.get(chief.get(family, ""), 0):
                    chief[family] = word
    found = set()
    for family, word in chief.items():
        hits, misses = toxic[family] - toxic[word], clean.get(family, 0) - clean.get(word, 0)
        if 2 * toxic[word] > toxic[family] and misses > 0 and log_odds(max(hits, 0), misses, n_toxic, n_clean)[0] < np.log(ratio):
            found.add(family)
    return found


def learn_threats(labelled: DataFrame, insults: dict[str, float], share: float = 0.002, ratio: float = 8.0, errors: float = 2.5) -> dict[str, float]:
    """Words that threaten when aimed at someone, with their log-odds.

    Looked for in the toxic texts that no insult or known threat explains. A term must stand
    beside a target, in ``share`` of all toxic texts at least, and so be likelier by ``ratio`` in
    these than in clean texts, with ``errors`` standard errors to spare. The terms that explain
    the texts stay (see :func:`explaining`). What comes to the driver is bounded as for insults.
    """
    known = Lexicon(insults)

    def aimed(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            known.trim()
            out = [
                (int(label), sorted(aimed_terms(text, known)))
                for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                if not label or not matches(text, known)
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[0] for o in out], pa.int32()), pa.array([o[1] for o in out], pa.list_(pa.string()))], ["toxic", "terms"]
            )
        release()

    n = {row["toxic"]: row["n"] for row in labelled.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n_toxic, n_clean = n.get(1, 0), n.get(0, 0)
    if not n_toxic or not n_clean:
        return {}
    found = staged(labelled.select("text", "toxic").mapInArrow(aimed, "toxic int, terms array<string>"), "toxicity-aimed")
    open_toxic = found.where("toxic = 1").count()
    enough = max(4, int(share * n_toxic))
    counts = found.select("toxic", F.explode("terms").alias("term")).groupBy("term").agg(
        F.count_if(F.col("toxic") == 1).alias("hits"), F.count_if(F.col("toxic") == 0).alias("misses")
    )
    odds = {}
    for row in counts.where(F.col("hits") >= enough).orderBy("term").collect():
        value, error = log_odds(row["hits"], row["misses"], open_toxic, n_clean)
        if value - errors * error >= np.log(ratio):
            odds[row["term"]] = value
    place = {term: i for i, term in enumerate(odds)}
    names = list(odds)
    lists = found.where("toxic = 1").select(F.filter("terms", lambda t: t.isin(names)).alias("terms")).where(F.size("terms") > 0)
    rows = [np.array(sorted(place[t] for t in r["terms"]), int) for r in lists.collect()] if names else []
    return {names[t]: odds[names[t]] for t in explaining(rows, len(names), least=float(enough))}


def learn_insults(labelled: DataFrame, share: float = 0.004, ratio: float = 5.0, errors: float = 2.0) -> dict[str, float]:
    """Insulting words and word families with their log-odds.

    A term must stand in ``share`` of the toxic texts, so there are at most terms-per-text /
    share of them, and in so many that chance would hardly put any term of the sample in
    toxic texts alone. It must be likelier in toxic than in clean texts by ``ratio``, with
    ``errors`` standard errors to spare. For that, uses count, in texts of both kinds, where an
    insult would be plain or targeted: clean texts may negate or quote insults. Of these terms,
    those stay that explain toxic texts (see :func:`explaining`), but for
    :func:`loose_families`.
    """
    n = {row["toxic"]: row["n"] for row in labelled.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n_toxic, n_clean = n.get(1, 0), n.get(0, 0)
    if not n_toxic or not n_clean:
        return {}
    counts = staged(_term_counts(labelled.where("toxic = 1"), None), "toxicity-terms")
    by_chance = (np.log(max(counts.count(), 2)) + 3) / -np.log(n_toxic / (n_toxic + n_clean))
    enough = max(3, int(share * n_toxic), int(np.ceil(by_chance)))
    toxic = {row["term"]: row["free"] for row in counts.where(F.col("n") >= enough).collect()}
    if not toxic:
        return {}
    clean = {row["term"]: row["free"] for row in _term_counts(labelled.where("toxic = 0"), set(toxic)).collect()}
    odds = {}
    for term, hits in sorted(toxic.items()):
        value, error = log_odds(hits, clean.get(term, 0), n_toxic, n_clean)
        if value - errors * error >= np.log(ratio):
            odds[term] = value
    for family in loose_families(odds, toxic, clean, n_toxic, n_clean, ratio):
        del odds[family]
    place = {term: i for i, term in enumerate(odds)}

    def lists(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            found = [sorted(place[t] for t in terms(text) if t in place) for text in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.int32()))], ["terms"])
        release()

    rows = labelled.where("toxic = 1").select("text").mapInArrow(lists, "terms array<int>").collect()
    names = list(odds)
    return {names[t]: odds[names[t]] for t in explaining([np.array(r["terms"], int) for r in rows], len(names))}


def fit_patterns(x: np.ndarray, y: np.ndarray, pull: float = 1.0, rounds: int = 50) -> np.ndarray:
    """Logistic weights (bias last) drawn towards :data:`PATTERNS` where labels say little."""
    prior = np.array([*PATTERNS.values(), -4.0])
    strength = np.full(len(prior), pull)
    strength[-1] = 0.01
    x1, w = np.hstack([x, np.ones((len(x), 1))]), prior.copy()
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x1 @ w, -30, 30)))
        gradient = x1.T @ (p - y) + strength * (w - prior)
        step = np.linalg.solve((x1 * (p * (1 - p))[:, None]).T @ x1 + np.diag(strength), gradient)
        w = w - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    w[:-1] = np.maximum(w[:-1], 0.05)
    return w


def train_toxicity(docs: DataFrame, labels: DataFrame, fit_rows: int = 50_000):
    """(insults, pattern weights, threats) from at most ``fit_rows`` labelled texts.

    The rows are those of the lowest hashes of doc_id, so the choice does not depend on the
    order or the partitions. Being bounded, their ids go to the texts by broadcast; only the
    candidate terms and pattern sums of these rows come to the driver. Rows whose label is NULL or
    that lack a text count for nothing; of several labels for a document the highest holds.
    """
    chosen = (
        labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL")
        .groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows)
    )
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    labelled = texts.where("text IS NOT NULL").join(F.broadcast(chosen), "doc_id")
    labelled = staged(labelled, "toxicity-labelled")
    insults = learn_insults(labelled)
    threats = learn_threats(labelled, insults)
    lexicon = Lexicon(insults, threats=threats)

    def sums(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            lexicon.trim()
            table = Counter(
                (*features(text, lexicon), label)
                for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            )
            yield pa.RecordBatch.from_arrays(
                [pa.array([list(k) for k in table], pa.list_(pa.float64())), pa.array(list(table.values()), pa.int64())],
                ["x", "n"],
            )

    rows = labelled.select("text", "toxic").mapInArrow(sums, "x array<double>, n long").collect()
    if not rows or not (insults or threats):
        return insults, np.array([*PATTERNS.values(), -4.0]), threats
    table = np.repeat(np.array([r["x"] for r in rows]), [r["n"] for r in rows], axis=0)
    return insults, fit_patterns(table[:, :-1], table[:, -1]), threats


SCORE_TYPE = T.StructType([T.StructField("score", T.DoubleType()), T.StructField("patterns", T.ArrayType(T.StringType()))])


def score_toxicity(docs: DataFrame, model) -> DataFrame:
    """``docs`` with score (0 to 1), the patterns found, and predicted (1 if score >= 0.5).

    Only the text is looked at, the whole of it. Null and empty texts get the score of a
    text without a match. Equal texts get equal scores; repeated rows are all returned;
    an empty table gives none. Columns named like an output are replaced, others pass.
    """
    insults, weights, threats = model
    lexicon = Lexicon(insults, threats=threats)
    names = list(PATTERNS)

    @F.arrow_udf(SCORE_TYPE)
    def score(texts: pa.Array) -> pa.Array:
        lexicon.trim()
        scores, found = [], []
        for text in texts.to_pylist():
            sums = Counter()
            for pattern, weight in (got := matches(text, lexicon)):
                sums[pattern] += weight
            x = sum(w * np.log1p(sums[p]) for w, p in zip(weights, names) if sums[p]) + weights[-1]
            scores.append(float(1 / (1 + np.exp(-x))))
            found.append(sorted({p for p, _ in got}))
        return pa.StructArray.from_arrays([pa.array(scores, pa.float64()), pa.array(found, pa.list_(pa.string()))], ["score", "patterns"])

    outputs = ("score", "patterns", "predicted")
    docs = docs.drop(*outputs, "toxicity_found")
    at = F.col("toxicity_found")
    return docs.withColumn("toxicity_found", score(F.col("text").cast("string"))).select(
        *[F.col(f"`{name}`") for name in docs.columns],
        at["score"].alias("score"),
        at["patterns"].alias("patterns"),
        (at["score"] >= 0.5).cast("int").alias("predicted"),
    )
