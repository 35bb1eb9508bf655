"""Toxicity by a weighted finite-state pattern grammar over clauses."""

from __future__ import annotations

import math
import re
from functools import lru_cache

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, rename_clashes

# Closed word classes of the grammar in English, German, French and Spanish (insults are learned).
THREATS = ("kill", "hurt", "destroy", "murder", "beat", "töten", "umbringen", "verletzen", "tuer", "frapper", "détruire",
           "matar", "golpear", "destruir")
TARGETS = ("you", "your", "yours", "yourself", "u", "ur", "he", "she", "they", "du", "dich", "dein", "deine", "ihr", "tu",
           "toi", "vous", "ton", "votre", "usted", "tú", "ustedes")
NEGATIONS = ("not", "no", "never", "isn't", "aren't", "don't", "nicht", "kein", "keine", "nie", "pas", "jamais", "nunca", "jamás")
REPORTED = ("said", "says", "called", "quoted", "wrote", "allegedly", "reported", "sagte", "nannte", "schrieb", "dit", "appelé",
            "écrit", "dijo", "llamó", "escribió")

# Most labelled documents that fit the lexicon and the weights (a hash-ordered sample beyond it).
FIT_ROWS = 20_000
# Words after a negation that it reaches, and words between a target and what aims at it, at most.
NEGATION_REACH = 3
TARGET_REACH = 8

_CLAUSE_END = re.compile(r"[.!?;:\n]")
_WORD = re.compile(r"\w+(?:'\w+)?")
# A matched clause: insult or threat, aimed or not, negated or not, reported or not.
PATTERNS = [(k, t, n, r) for k in "IT" for t in (0, 1) for n in (0, 1) for r in (0, 1)]
_AT = {p: i for i, p in enumerate(PATTERNS)}


class Transducer:
    """A deterministic weighted transducer: ``(state, symbol) -> (state, symbol, weight)``; missing arcs copy the symbol and
    weigh nothing.  Weights add up along a path."""

    def __init__(self, start, arcs: dict):
        self.start, self.arcs = start, {k: arc if len(arc) == 3 else (*arc, 0.0) for k, arc in arcs.items()}

    def weighted_step(self, state, symbol):
        return self.arcs.get((state, symbol), (state, symbol, 0.0))

    def step(self, state, symbol):
        return self.weighted_step(state, symbol)[:2]


class Composed(Transducer):
    """The second transducer reads what the first writes; arcs of the product are made when first met, at most one for each
    state and known symbol."""

    def __init__(self, first: Transducer, second: Transducer):
        super().__init__((first.start, second.start), {})
        self.first, self.second = first, second

    def weighted_step(self, state, symbol):
        arc = self.arcs.get((state, symbol))
        if arc is None:
            a, middle, x = self.first.weighted_step(state[0], symbol)
            b, out, y = self.second.weighted_step(state[1], middle)
            arc = self.arcs[state, symbol] = ((a, b), out, x + y)
        return arc


def insult(words: tuple[tuple[str, float], ...]) -> Transducer:
    """Reads a learned insult as I, with its weight."""
    return Transducer(0, {(0, w): (0, "I", x) for w, x in words})


def threat() -> Transducer:
    """Reads a form of a threatening verb as T."""
    return Transducer(0, {(0, w): (0, "T", 1.0) for w in threat_forms()})


def threat_forms() -> tuple[str, ...]:
    """The listed verbs, English ones also with their regular endings."""
    english = THREATS[:THREATS.index("töten")]
    return THREATS + tuple(w + end for w in english for end in ("s", "ed", "ing"))


def negation(reach: int = NEGATION_REACH) -> Transducer:
    """After N, the insult or threat within ``reach`` words is marked negated."""
    arcs = {}
    for left in range(reach + 1):
        arcs[left, "N"] = (reach, "o")
        for s in ("o", "Y", "R"):
            arcs[left, s] = (max(0, left - 1), s)
        for s in "IT":
            arcs[left, s] = (max(0, left - 1), (s, 0, int(left > 0), 0))
    return Transducer(0, arcs)


def reported() -> Transducer:
    """After R, everything to the end of the clause is reported speech."""
    arcs = {(0, "R"): (1, "o"), (1, "R"): (1, "o")}
    for s in "IT":
        for n in (0, 1):
            arcs[1, (s, 0, n, 0)] = (1, (s, 0, n, 1))
    return Transducer(0, arcs)


def target(reach: int = TARGET_REACH) -> Transducer:
    """A target aims the matches within ``reach`` symbols after it.  A second walk, from the clause's end, does the same for
    targets after a match."""
    arcs = {}
    for left in range(reach + 1):
        arcs[left, "Y"] = (reach, "Y")
        arcs[left, "o"] = (max(0, left - 1), "o")
        for s in "IT":
            for t in (0, 1):
                for n in (0, 1):
                    for r in (0, 1):
                        arcs[left, (s, t, n, r)] = (max(0, left - 1), (s, int(t or left > 0), n, r))
    return Transducer(0, arcs)


@lru_cache(maxsize=4)
def grammar(insults: tuple[tuple[str, float], ...] = ()) -> tuple[Transducer, Transducer]:
    """The five transducers composed, for the walk through a clause, and the one for the walk back."""
    machine = insult(insults)
    for following in (threat(), negation(), reported(), target()):
        machine = Composed(machine, following)
    return machine, target()


def clause_paths(symbols: list, insults: tuple[tuple[str, float], ...] = ()) -> list[tuple[tuple, float]]:
    """``(pattern, weight)`` of the matches that the composed grammar finds in a clause, in order.  Symbols are words of the
    lexicon, class marks, and ``o`` for any other word."""
    machine, back = grammar(insults)
    line, state = [], machine.start
    for s in symbols:
        state, out, x = machine.weighted_step(state, s)
        line.append((out, x))
    found, state = [], back.start
    for out, x in reversed(line):
        state, out = back.step(state, out)
        if isinstance(out, tuple):
            found.append((out, x))
    return found[::-1]


def clause_matches(symbols: list) -> list[tuple]:
    """The patterns alone."""
    return [pattern for pattern, _ in clause_paths(symbols)]


@lru_cache(maxsize=4)
def _lexicon(insults: tuple[tuple[str, float], ...]):
    """The symbol of every known word, and a finder of those that can match."""
    symbols = {w: w for w in threat_forms()}
    symbols |= {w: "Y" for w in TARGETS} | {w: "N" for w in NEGATIONS} | {w: "R" for w in REPORTED}
    symbols |= {w: w for w, _ in insults}
    finder = ahocorasick.Automaton()
    for w, s in symbols.items():
        if s == w:
            finder.add_word(w, w)
    finder.make_automaton()
    return symbols, finder


def features(text: str | None, insults: tuple[tuple[str, float], ...]) -> np.ndarray:
    """Weight of the matched clauses by pattern (log scale), over the whole text, in time linear in its length.

    Aho-Corasick finds insults and threats as whole words; the clause around each is read by the composed grammar; a
    match weighs what its path does.
    """
    known, finder = _lexicon(insults)
    low, total = (text or "").lower(), np.zeros(len(PATTERNS))
    done = 0
    for end, word in finder.iter(low):
        at = end - len(word) + 1
        if at < done or (at and (low[at - 1].isalnum() or low[at - 1] == "_")) or (end + 1 < len(low) and (low[end + 1].isalnum() or low[end + 1] == "_")):
            continue
        head = max(low.rfind(mark, done, at) + 1 for mark in ".!?;:\n")
        tail = m.start() if (m := _CLAUSE_END.search(low, end + 1)) else len(low)
        symbols = [known.get(t, "o") for t in _WORD.findall(low, max(head, done), tail)]
        done = tail
        for pattern, x in clause_paths(symbols, insults):
            total[_AT[pattern]] += x
    return np.log1p(total)


def learn_insults(train: DataFrame, min_docs: int = 4, margin: float = 8.0) -> tuple[tuple[str, float], ...]:
    """Words that mark label 1, with weights from 0 to 1 (capped log odds), from ``train(text, label)``.

    Spark counts, per word, the texts of either label that hold it; a word counts as an insult if its likelihood ratio
    beats what the best of as many words would reach by chance, by ``margin``; nothing else bounds their number.  Equal
    texts count once.
    """
    texts = train.groupBy(F.xxhash64("text").alias("h"), "label").agg(F.first("text").alias("text"))
    base = {r["label"]: r["n"] for r in texts.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    n1, n0 = base.get(1, 0), base.get(0, 0)
    if not n1 or not n0:
        return ()
    words = texts.select("label", F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"(?U)\w+"), F.lit(0)))).alias("w"))
    counts = words.groupBy("w").agg(F.sum("label").alias("t"), F.count(F.lit(1)).alias("n"))
    vocabulary = counts.count()
    t, n = F.col("t").cast("double"), F.col("n").cast("double")
    p, c = n1 / (n1 + n0), F.col("n").cast("double") - F.col("t")
    plogp = lambda a, b: F.when(a > 0, a * F.log(a / b)).otherwise(0.0)
    ratio = 2 * (plogp(t, n * p) + plogp(c, n * (1 - p)))
    odds = F.log((t + 0.5) / (n1 + 1.0)) - F.log((c + 0.5) / (n0 + 1.0))
    kept = counts.where((t >= min_docs) & (odds > 2.0) & (ratio > 2 * math.log(max(2, vocabulary)) + margin))
    best = kept.select("w", F.least(F.lit(1.0), odds / 5).alias("x"))
    return tuple(sorted((r["w"], round(r["x"], 6)) for r in best.collect()))


def fit_weights(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 50) -> np.ndarray:
    """Ridge logistic weights by Newton's method; the last is the bias, which is not shrunk."""
    a = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(a.shape[1])
    shrink = np.r_[np.full(x.shape[1], ridge), 1e-6]
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        g = a.T @ (p - y) + shrink * w
        h = (a * (p * (1 - p))[:, None]).T @ a + np.diag(shrink)
        d = np.linalg.solve(h, g)
        w -= d
        if np.abs(d).max() < 1e-8:
            break
    return w


class ToxicityModel:
    """Lexicon and pattern weights; :meth:`score` gives 0 to 1."""

    def __init__(self, insults: tuple[tuple[str, float], ...], weights: np.ndarray):
        self.insults, self.weights = insults, [float(w) for w in weights]

    def score(self, text: str | None) -> float:
        z = float(features(text, self.insults) @ np.array(self.weights[:-1])) + self.weights[-1]
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))

    def column(self, text: F.Column) -> F.Column:
        model = self

        @F.pandas_udf("double")
        def score(texts: pd.Series) -> pd.Series:
            return pd.Series([model.score(t) for t in texts], dtype="float64")

        return score(text)


def held_out(key: F.Column) -> F.Column:
    """True for the fifth of the ids that is never learned from."""
    return F.coalesce(F.crc32(key.cast("string")) % 5 == 0, F.lit(False))


def fit_toxicity(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
                 fit_rows: int = FIT_ROWS) -> ToxicityModel:
    """Fits lexicon and weights on labelled documents that are not held out.

    At most about ``fit_rows`` of them (all if fewer; else those with the smallest hash of the id), whole texts.  Only
    the pattern weights of these rows - 16 numbers a row - reach the driver.  Rows with a null id, text or label teach
    nothing; an id with several labels has the more frequent one (label 1 if equal).  With no label of either kind, every text gets the share of label 1.
    """
    names = labels.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{label}`").cast("int").alias("label"))
    names = names.where("doc_id is not null and label is not null").where(~held_out(F.col("doc_id")))
    names = names.groupBy("doc_id").agg((F.avg("label") >= 0.5).cast("int").alias("label"))
    n = names.count()
    if n > fit_rows:
        names = names.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(1_000_000 * fit_rows / n))
    base = rename_clashes(docs, [key, text]).toDF("doc_id", "text").where("text is not null")
    train = cut_lineage(base.join(F.broadcast(names) if min(n, fit_rows * 2) * 24 <= 8 << 20 else names, "doc_id").select("text", "label"))
    insults = learn_insults(train)

    @F.pandas_udf("array<double>")
    def patterns(texts: pd.Series) -> pd.Series:
        return pd.Series([features(t, insults).tolist() for t in texts])

    rows = train.select(patterns("text").alias("x"), "label").groupBy("x", "label").count().collect()
    if not rows:
        return ToxicityModel((), np.zeros(len(PATTERNS) + 1))
    x = np.repeat(np.array([r["x"] for r in rows]), [r["count"] for r in rows], axis=0)
    y = np.repeat(np.array([r["label"] for r in rows], float), [r["count"] for r in rows])
    weights = fit_weights(x, y)
    weights[:-1] = np.maximum(weights[:-1], 0.0)  # a matched clause never makes a text look cleaner
    return ToxicityModel(insults, weights)


def score_toxicity(docs: DataFrame, model: ToxicityModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every document; nothing but id and whole text is read.

    Null and empty texts match no clause and get the base score; repeated rows come back as often; an empty table gives
    no row.
    """
    base = rename_clashes(docs, [key, text]).toDF("doc_id", "text")
    scored = base.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), model.column(F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def drop_toxic(docs: DataFrame, model: ToxicityModel, text: str = "text") -> DataFrame:
    """``docs`` without the documents whose score is 0.5 or more; nothing is shuffled or joined."""
    return docs.where(model.column(F.col(f"`{text}`")) < 0.5)
