import numpy as np
from pyspark.sql import functions as F

from binscope.llm import toxicity as X
from binscope.llm.text import crc_bucket

from .cases import awkward, awkward_rows, empty


def test_scopes_of_a_clause():
    g = X.Grammar(["idiot*", "scum"], [])
    label = lambda t: g.paths(t)
    assert label("You are an idiot.") == [("insult", True, False, False)]
    assert label("not an idiot") == [("insult", False, True, False)]
    assert label("not at all one of those idiots") == [("insult", False, False, False)]
    assert label("he said: idiotic scum") == [("insult", True, False, True)] * 2
    assert label("You there. Idiot!") == [("insult", False, False, False)]
    assert label("“scum” and more") == [("insult", False, False, True)]
    assert label("I will kill you") == [("threat", True, False, False)]
    assert label("scummy") == [] and label("") == []


def test_composition_gives_the_paths_of_the_cascade():
    """All paths, by trying every arc of one transducer after the other."""
    def every(t, symbols):
        paths = [(s, ()) for s in t.start]
        for x in symbols:
            paths = [(q, (*out, y)) for s, out in paths for a, steps in t.arcs[s].items() if a == x for y, q in steps]
        return [out for s, out in paths if s in t.final]

    r = np.random.default_rng(3)
    symbols = [*X.WORDS, *X.MATCHES]
    for _ in range(2000):
        clause = [symbols[i] for i in r.integers(0, len(symbols), r.integers(0, 12))]
        for quoted in (False, True):
            outs = [tuple(clause)]
            for t in (X.negation_scope(), X.report_scope(quoted), X.target_scope()):
                outs = [z for y in outs for z in every(t, y)]
            assert X.SCOPES[quoted].paths(clause) == [[y for y in out if isinstance(y, tuple)] for out in outs]
            assert len(outs) == 1
            # and by the definition of the scopes
            want = []
            for k, x in enumerate(clause):
                if isinstance(x, tuple):
                    want.append((x, "target" in clause, "negation" in clause[max(0, k - X.SCOPE):k], quoted or "speech" in clause[:k]))
            assert X.SCOPES[quoted].paths(clause)[0] == want


def test_unseen_attacks_and_threats_take_the_weights_of_insults():
    n = len(X.LABELS)
    weights, seen = np.arange(2.0 * n), np.zeros(n)
    plain, attack = X._PLACE["insult", False, False, False], X._PLACE["insult", True, False, False]
    threat = X._PLACE["threat", True, False, False]
    seen[plain] = X.LEAST_SEEN
    X.borrow(weights, seen)
    assert weights[threat] == weights[attack] == plain and weights[n + threat] == weights[n + attack] == n + plain
    assert weights[X._PLACE["threat", True, True, False]] == X._PLACE["threat", True, True, False]
    seen[attack], weights[attack] = X.LEAST_SEEN, -5
    X.borrow(weights, seen)
    assert weights[threat] == -5


def test_threats_count_only_with_a_target(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    grammar = X.fit_toxicity(docs, spark.read.parquet("/root/testdata/sf0.1/labels.parquet"))
    plain = grammar.score("")[0]
    for text in ("I will kill you.", "We will murder them all.", "They are killing him!"):
        assert grammar.score(text)[0] >= 0.5, text
    for text in ("We will shoot the film.", "The battery was killed by frost.", "I will not kill you."):
        assert grammar.score(text)[0] < 0.5, text
    assert grammar.score("We will shoot the film.")[0] == plain


def test_entries_are_learned_and_cover_every_toxic_text():
    r = np.random.default_rng(1)
    words = ["".join(r.choice(list("abcdefgh"), 5)) for _ in range(200)]
    texts, toxic = [], []
    for i in range(400):
        t = r.choice(words, 30).tolist()
        if i % 4 == 0:
            t[3] = ["zork", "qwuxly" + words[i % 50]][i // 4 % 2]
        texts.append(" ".join(t))
        toxic.append(i % 4 == 0)
    entries = X.learn_entries(texts, np.array(toxic), X.STRONG, 1)
    assert {e.rstrip("*")[:4] for e in entries} == {"zork", "qwux"}


def test_accuracy_on_labels_it_has_not_seen(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    grammar = X.fit_toxicity(docs, labels.filter(crc_bucket(5) != 0))
    rows = X.score_toxicity(docs.join(labels.filter(crc_bucket(5) == 0), "doc_id"), grammar, keep=["toxic"]).collect()
    hit = [(r["toxic"], r["_toxicity"]["score"] >= 0.5) for r in rows]
    assert sum(a == 1 and b for a, b in hit) / sum(a == 1 for a, _ in hit) > 0.8
    assert sum(a == 0 and not b for a, b in hit) / sum(a == 0 for a, _ in hit) > 0.985


def test_awkward_rows_and_empty_tables(spark):
    labels = spark.createDataFrame([(3, 1), (4, 0), (None, 1), (99, None)], "doc_id long, toxic int")
    for grammar in (X.fit_toxicity(awkward(spark), labels), X.fit_toxicity(empty(spark), labels.limit(0)), X.Grammar(["idiot*"], [])):
        got = X.score_toxicity(awkward(spark), grammar)
        assert got.columns == [*awkward(spark).columns, "_toxicity"]
        rows = got.collect()
        assert len(rows) == len(awkward_rows()) and all(0 <= r["_toxicity"]["score"] <= 1 for r in rows)
        assert len({r["_toxicity"]["score"] for r in rows if not (r["text"] or "").strip()}) == 1
    assert X.score_toxicity(empty(spark), X.Grammar([], [])).count() == 0
    assert X.score_toxicity(awkward(spark), X.Grammar([], [])).filter(F.col("_toxicity.score") != 0).count() == 0
