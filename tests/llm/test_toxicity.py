import random

import numpy as np
from pyspark.sql import functions as F

import llm_data
from rareclass.llm import toxicity as T

INSULTS = (("moron", 1.0), ("scum", 0.8))


def pattern(text):
    x = T.features(text, INSULTS)
    return {T.PATTERNS[i]: round(float(np.expm1(v)), 3) for i, v in enumerate(x) if v}


def test_grammar_reads_clauses():
    assert pattern("the moron left.") == {("I", 0, 0, 0): 1.0}
    assert pattern("You moron.") == {("I", 1, 0, 0): 1.0}
    assert pattern("moron, you are") == {("I", 1, 0, 0): 1.0}  # a target after the match
    assert pattern("not a moron") == {("I", 0, 1, 0): 1.0}
    assert pattern("not one of all those people is scum") == {("I", 0, 0, 0): 0.8}  # out of the negation's reach
    assert pattern("it said moron") == {("I", 0, 0, 1): 1.0}
    assert pattern("it said so. moron!") == {("I", 0, 0, 0): 1.0}  # reported speech ends with the clause
    assert pattern("I will kill you") == {("T", 1, 0, 0): 1.0}
    assert pattern("oxymoron moronic scums") == {}  # whole words only
    assert pattern("Moron moron; scum") == {("I", 0, 0, 0): 2.8}
    assert pattern("") == {} and pattern(None) == {}


def test_composition_equals_one_after_the_other():
    rng = random.Random(1)
    for _ in range(300):
        symbols = [rng.choice("oNRYIT") for _ in range(rng.randint(0, 9))]
        stages = [T.negation(), T.reported(), T.target()]
        line = symbols
        for machine in stages:
            state, out = machine.start, []
            for s in line:
                state, o = machine.step(state, s)
                out.append(o)
            line = out
        want = [x for x in line if isinstance(x, tuple)]
        if "Y" in symbols:
            want = [(k, 1, n, r) for k, _, n, r in want]
        assert T.clause_matches(symbols) == want


def paths_by_hand(tokens, insults):
    """The patterns and weights of a clause, read off its words without any machine."""
    out, kinds = [], []
    for t in tokens:
        kinds.append("I" if t in insults else "T" if t in T.threat_forms() else "Y" if t in T.TARGETS else "N" if t in T.NEGATIONS
                     else "R" if t in T.REPORTED else "o")
    for i, k in enumerate(kinds):
        if k in "IT":
            aimed = "Y" in kinds[max(0, i - T.TARGET_REACH):i + T.TARGET_REACH + 1]
            out.append(((k, int(aimed), int("N" in kinds[max(0, i - T.NEGATION_REACH):i]), int("R" in kinds[:i])), insults.get(tokens[i], 1.0)))
    return out


def test_paths_against_plain_reading():
    rng = random.Random(2)
    words = ["moron", "scum", "kill", "murdering", "you", "never", "said", "tree", "house"]
    known = T._lexicon(INSULTS)[0]
    for _ in range(500):
        tokens = [rng.choice(words + ["and"] * 12) for _ in range(rng.randint(0, 30))]
        assert T.clause_paths([known.get(t, "o") for t in tokens], INSULTS) == paths_by_hand(tokens, dict(INSULTS))


def test_every_transducer_has_an_effect():
    assert pattern("he will be killing you") == {("T", 1, 0, 0): 1.0} and pattern("kill time") == {("T", 0, 0, 0): 1.0}
    far = "you " + "walk " * T.TARGET_REACH + "past a moron"
    assert pattern(far) == {("I", 0, 0, 0): 1.0} and pattern("you " + "walk " * (T.TARGET_REACH - 1) + "moron") == {("I", 1, 0, 0): 1.0}
    assert pattern("a moron " + "walks " * T.TARGET_REACH + "past you") == {("I", 0, 0, 0): 1.0}


def test_long_texts_take_linear_time():
    text = "a moron walks by, " * 200_000  # one clause
    assert pattern(text) == {("I", 0, 0, 0): 200_000.0}
    assert pattern("word " * 400_000 + "moron. " * 100_000) == {("I", 0, 0, 0): 100_000.0}


def test_conflicting_labels(spark):
    docs, labels = labelled(spark)
    known = labels.where("toxic is not null")
    model = T.fit_toxicity(docs, labels)
    # every label three times, and once the other way round
    mixed = known.union(known).union(known).union(known.selectExpr("doc_id", "1 - toxic"))
    again = T.fit_toxicity(docs, mixed)
    assert again.insults == model.insults and again.weights == model.weights


def labelled(spark, n=600):
    rng = random.Random(3)
    rows, labels = [], []
    for i in range(n):
        bad = rng.random() < 0.2
        words = llm_data.words(rng, rng.randint(20, 60)).split()
        if bad:
            for _ in range(rng.randint(1, 3)):
                words.insert(rng.randrange(len(words)), rng.choice(["moron", "idiot", "scum"]))
        rows.append((i, " ".join(words)))
        labels.append((i, None if i % 50 == 49 else int(bad)))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_held_out_accuracy(spark):
    docs, labels = labelled(spark)
    model = T.fit_toxicity(docs, labels)
    assert {w for w, _ in model.insults} == {"moron", "idiot", "scum"}
    got = T.score_toxicity(docs, model).join(labels, "doc_id").where("held_out and toxic is not null")
    assert got.count() > 60 and got.where("predicted <> toxic").count() == 0
    assert got.where("score < 0 or score > 1").count() == 0


def test_held_out_labels_teach_nothing(spark):
    docs, labels = labelled(spark)
    turned = labels.withColumn("toxic", F.when(T.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = T.fit_toxicity(docs, labels), T.fit_toxicity(docs, turned)
    assert a.insults == b.insults and a.weights == b.weights


def test_awkward_tables(spark):
    docs, labels = labelled(spark)
    model = T.fit_toxicity(docs, labels)
    out = T.score_toxicity(llm_data.docs(spark), model)
    assert out.count() == len(llm_data.rows()) and out.where("score is null or predicted is null or held_out is null").count() == 0
    kept = T.drop_toxic(llm_data.docs(spark), model)
    assert kept.count() == len(llm_data.rows()) and kept.columns == llm_data.docs(spark).columns
    assert T.score_toxicity(llm_data.empty(spark), model).count() == 0
    blank = T.fit_toxicity(llm_data.empty(spark), labels.limit(0))
    assert T.score_toxicity(docs, blank).where("score <> 0.5").count() == 0
