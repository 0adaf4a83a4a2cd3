"""Toxicity (operator 5): a weighted finite-state grammar over clauses.

A lexical transducer maps a clause's words to symbols: sets of insult, hint and threat
entries, targets (second and third persons), negations and speech verbs. It is composed
with three scope transducers, tables of states and arcs: a negation holds for the next ``SCOPE``
words, a speech verb or a quotation mark makes what follows in the clause reported, and a target
anywhere in the clause makes an attack of its entries (the transducer guesses at the
clause's start whether one will come; a path that guessed wrong is not accepted, so each clause has
exactly one path). The path gives each matched entry a label (kind, attack, negated, reported).
A last automaton counts each label's matches in the text: the arc of the n-th one weighs what its
presence (n = 1) and the growth of log(1 + n) weigh. Words without a match weigh nothing, nor do threats without a target.

The grammar's function words are fixed below. Insults are learned from a bounded
labelled sample (``SAMPLE_PER_CLASS`` rows of each class): word stems and whole
words that are ``STRONG`` times as frequent in toxic texts as in others, chosen
greedily until every toxic text has ``COVER`` of them; and hints, ``WEAK`` times as
frequent, which tell by their number in a text. Label weights are a logistic
regression on the same sample, moved to the class shares of all labelled rows. An insult or threat label
found in fewer than ``LEAST_SEEN`` sample texts takes the weights of the nearest learned label of insults
with the same negation and report. Insults without a target do count: the labels mark them.

Defined results: null and empty texts have no clauses and get the score of a
text without a match; without labels of both classes every score is 0; repeated
rows are scored each.
"""

from __future__ import annotations

import heapq
import re
from collections import Counter
from collections.abc import Hashable, Iterable, Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from binscope.llm.quality import _sample
from binscope.llm.text import text_column

SAMPLE_PER_CLASS = 2000
SCOPE = 3
COVER = 4
STRONG = 20
WEAK = 4
STEMS = range(4, 9)
#: Sample texts with a label, below which its weights are borrowed.
LEAST_SEEN = 8
#: Least number, and least share, of toxic sample texts that an entry adds something to.
LEAST_GAIN = (8, 0.01)

# Function words of the grammar, in English, German, French and Spanish.
TARGETS = "you your yours yourself he she him her they them their du dich dir dein deine ihr euch er sie ihn tu te toi ton ta vous votre il elle ils lui leur tú ti tu usted ustedes él ella ellos su".split()
NEGATIONS = "not no never none nor neither without cannot nicht kein keine nie niemals ohne ne pas jamais aucun sans nunca jamás ni sin ningún".split()
SPEECH = "said says say told tells called calls wrote quoted claimed reported sagte sagt nannte schrieb dit disait appelle écrit dijo dice llamó escribió".split()
THREATS = "kill* destroy hurt murder* attack beat shoot töten umbringen schlagen zerstören tuer détruire frapper matar destruir golpear".split()
QUOTES = '"“”„«»'

_TOKEN = re.compile(rf"[^\W\d_]+|[.!?;\n]|[{QUOTES}]")
_WORD = re.compile(r"[^\W\d_]+")
KINDS = ("insult", "hint", "threat")
LABELS = [(kind, attack, negated, reported) for kind in KINDS for attack in (False, True)
          for negated in (False, True) for reported in (False, True)]
_PLACE = {label: i for i, label in enumerate(LABELS)}


@dataclass
class Transducer:
    """Start states; for each state and input symbol the arcs (output symbol, next state); final states."""

    start: list
    arcs: dict[Hashable, dict[Hashable, list[tuple[Hashable, Hashable]]]]
    final: set

    def paths(self, symbols: Iterable[Hashable]) -> list[list]:
        """The entry symbols (tuples) that each accepting path gives out."""
        live: list[tuple] = [(s, None) for s in self.start]
        for x in symbols:
            live = [(t, (out, y) if isinstance(y, tuple) else out) for s, out in live for y, t in self.arcs[s].get(x, ())]
        found = []
        for s, out in live:
            if s in self.final:
                path = []
                while out:
                    out, y = out
                    path.append(y)
                found.append(path[::-1])
        return found


def compose(a: Transducer, b: Transducer) -> Transducer:
    """What ``b`` makes of the output of ``a``; only states that can be reached."""
    start = [(p, q) for p in a.start for q in b.start]
    arcs: dict = {}
    todo = list(start)
    while todo:
        s = todo.pop()
        if s not in arcs:
            arcs[s] = {x: [(z, (p, q)) for y, p in steps for z, q in b.arcs[s[1]].get(y, ())] for x, steps in a.arcs[s[0]].items()}
            todo += [t for steps in arcs[s].values() for _, t in steps]
    return Transducer(start, arcs, {s for s in arcs if s[0] in a.final and s[1] in b.final})


#: Symbols of the lexical transducer: function words by their scope, and entries by the tuple of their kinds.
WORDS = ("other", "target", "negation", "speech")
MATCHES = [k for n in (1, 2, 3) for k in combinations(KINDS, n)]


def negation_scope() -> Transducer:
    """A state for each number of words, itself included, that the last negation still reaches from here."""
    arcs: dict = {}
    for n in range(SCOPE + 2):
        m = max(0, n - 1)
        arcs[n] = {x: [(x, SCOPE + 1 if x == "negation" else m)] for x in WORDS} | {k: [((k, m > 0), m)] for k in MATCHES}
    return Transducer([0], arcs, set(arcs))


def report_scope(quoted: bool) -> Transducer:
    """Whether a speech verb or quotation mark was there; a clause inside a quotation starts so."""
    arcs = {told: {x: [(x, told or x == "speech")] for x in WORDS} | {(k, neg): [((k, neg, told), told)] for k in MATCHES for neg in (False, True)}
            for told in (False, True)}
    return Transducer([quoted], arcs, set(arcs))


def target_scope() -> Transducer:
    """Guesses ``none`` or ``later``; the first dies with a target, the second must come to ``seen``."""
    after = {"none": {}, "later": {"target": "seen"}, "seen": {"target": "seen"}}
    arcs: dict = {}
    for s, on_target in after.items():
        arcs[s] = {x: [(x, s)] for x in WORDS if x != "target"} | {x: [(x, t)] for x, t in on_target.items()}
        arcs[s] |= {(k, neg, told): [((k, s != "none", neg, told), s)] for k in MATCHES for neg in (False, True) for told in (False, True)}
    return Transducer(["none", "later"], arcs, {"none", "seen"})


#: The composed scopes of clauses that begin outside and inside of a quotation.
SCOPES = [compose(compose(negation_scope(), report_scope(quoted)), target_scope()) for quoted in (False, True)]


class Entries:
    """Words, and stems, which end in ``*``."""

    def __init__(self, entries: list[str]) -> None:
        self.whole = {e for e in entries if e[-1] != "*"}
        self.stems = {e[:-1] for e in entries if e[-1] == "*"}
        self.lengths = sorted({len(s) for s in self.stems})

    def __contains__(self, word: str) -> bool:
        return word in self.whole or any(word[:n] in self.stems for n in self.lengths)


@dataclass
class Grammar:
    """Learned entries and the weight of every path label."""

    insults: list[str]
    hints: list[str]
    weights: np.ndarray | None = None  # for each label: of its presence, then of its log count
    bias: float = 0.0

    def __post_init__(self) -> None:
        self.lexicon = {"insult": Entries(self.insults), "hint": Entries(self.hints), "threat": Entries(THREATS)}
        #: A text without any of these has no match; this is cheaper than reading its words.
        needles = sorted({x for e in self.lexicon.values() for x in e.stems | e.whole}, key=len)
        self.needles = [x for i, x in enumerate(needles) if not any(y in x for y in needles[:i])]
        self.scopes = {w: "target" for w in TARGETS} | {w: "negation" for w in NEGATIONS} | {w: "speech" for w in [*SPEECH, *QUOTES]}

    def symbol(self, word: str) -> str | tuple[str, ...]:
        """The lexical transducer: one state, an arc for every word."""
        return self.scopes.get(word) or tuple(k for k, entries in self.lexicon.items() if word in entries) or "other"

    def clause(self, words: list[str], quoted: bool) -> list[tuple[str, bool, bool, bool]]:
        """The one accepting path of a clause: a label for each matched entry."""
        symbols = [self.symbol(w) for w in words]
        if not any(isinstance(x, tuple) for x in symbols):
            return []
        (path,) = SCOPES[quoted].paths(symbols)
        return [(kind, attack, negated, told) for kinds, attack, negated, told in path for kind in kinds]

    def paths(self, text: str) -> list[tuple[str, bool, bool, bool]]:
        """Path labels of all matched clauses of a text."""
        low = text.lower()
        if not any(x in low for x in self.needles):
            return []
        out, words, quoted = [], [], False
        for token in [*_TOKEN.findall(low), "\n"]:
            if token in ".!?;\n":
                out += self.clause(words, quoted)
                quoted = quoted ^ (sum(w in QUOTES for w in words) % 2 == 1)
                words = []
            else:
                words.append(token)
        return out

    def features(self, paths: list[tuple[str, bool, bool, bool]]) -> np.ndarray:
        n = np.zeros(len(LABELS))
        for p in paths:
            n[_PLACE[p]] += p[0] != "threat" or p[1]
        return np.concatenate(((n > 0).astype(float), np.log1p(n)))

    def score(self, text: str) -> tuple[float, int]:
        """Probability that the text is toxic, and its matched entries."""
        if self.weights is None:
            return 0.0, 0
        paths = self.paths(text)
        z = self.bias + (float(self.features(paths) @ self.weights) if paths else 0.0)
        return float(1 / (1 + np.exp(-np.clip(z, -500, 500)))), len(paths)


def learn_entries(texts: list[str], toxic: np.ndarray, ratio: float, cover_all: int) -> list[str]:
    """Words and stems that are ``ratio`` times as frequent in toxic texts, chosen by how many texts
    they add to the cover, until all toxic texts have ``cover_all`` or nothing adds enough."""
    clean: Counter = Counter()
    where: dict[str, list[int]] = {}
    for i, t in enumerate(texts):
        found = set(_WORD.findall(t.lower()))
        own = {w for w in found if len(w) > 2} | {w[:n] + "*" for w in found for n in STEMS if len(w) >= n}
        if toxic[i]:
            for x in own:
                where.setdefault(x, []).append(i)
        else:
            clean.update(own)
    n_toxic = int(toxic.sum())
    odds = max(1, n_toxic) / max(1, len(texts) - n_toxic)
    least = max(LEAST_GAIN[0], LEAST_GAIN[1] * n_toxic)
    left = {e: np.array(at) for e, at in where.items() if len(at) >= least and clean[e] * odds * ratio <= len(at)}
    cover = np.zeros(len(texts), dtype=int)
    chosen: list[str] = []
    entries: list[str] = []
    # a gain only goes down: only that of the entry that may be the best is worked out again
    agenda = [(-float(len(at)), -len(e), e) for e, at in left.items()]
    heapq.heapify(agenda)
    while agenda:
        bound, size, best = heapq.heappop(agenda)
        stem = best.rstrip("*")
        if any(stem.startswith(c) or c.startswith(stem) for c in chosen):
            continue
        gain = float((cover[left[best]] < cover_all).sum()) - ratio * clean[best] * odds
        if gain < least:
            continue
        if agenda and -gain > agenda[0][0]:
            heapq.heappush(agenda, (-gain, size, best))
            continue
        chosen.append(stem)
        entries.append(best)
        cover[left[best]] += 1
    return entries


def _weights(x: np.ndarray, y: np.ndarray, ridge: float = 1e-5) -> tuple[np.ndarray, float]:
    """Logistic regression by Newton steps; both classes weigh the same."""
    a = np.hstack((x, np.ones((len(x), 1))))
    weight = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))
    w = np.zeros(a.shape[1])
    penalty = ridge * np.eye(a.shape[1])
    penalty[-1, -1] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        g = a.T @ ((p - y) * weight) + penalty @ w
        k = weight * np.maximum(p * (1 - p), 1e-6)
        step = np.linalg.solve(a.T @ (a * k[:, None]) + penalty, g)
        w -= step * min(1.0, 3.0 / max(1e-9, float(np.abs(step).max())))
        if np.abs(step).max() < 1e-6:
            break
    return w[:-1], float(w[-1])


def borrow(weights: np.ndarray, seen: np.ndarray) -> None:
    """Weights of attacks, and of threats, that were found in too few sample texts: those of attacks by
    insults with the same negation and report, else of insults without a target. Changed in place."""
    for kind in ("insult", "threat"):
        for negated in (False, True):
            for told in (False, True):
                own = _PLACE[kind, True, negated, told]
                known = [i for i in (_PLACE["insult", True, negated, told], _PLACE["insult", False, negated, told]) if seen[i] >= LEAST_SEEN]
                if seen[own] < LEAST_SEEN and known:
                    for part in (0, len(LABELS)):
                        weights[part + own] = weights[part + known[0]]


def fit_toxicity(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> Grammar:
    """Grammar learned from rows of ``labels`` (doc_id, toxic) with texts in ``docs``."""
    rows = _sample(docs, labels, "toxic", per_class)
    y = np.array([r[0] for r in rows], dtype=int)
    if not (y == 1).any() or not (y == 0).any():
        return Grammar([], [])
    texts = [r[1] for r in rows]
    grammar = Grammar(learn_entries(texts, y == 1, STRONG, COVER), learn_entries(texts, y == 1, WEAK, 1))
    x = np.array([grammar.features(grammar.paths(t)) for t in texts])
    grammar.weights, grammar.bias = _weights(x, y)
    borrow(grammar.weights, (x[:, :len(LABELS)] > 0).sum(axis=0))
    n = {r[0]: r[1] for r in labels.filter(F.col("toxic").isin(0, 1)).groupBy(F.col("toxic").cast("int")).count().collect()}
    grammar.bias += float(np.log(max(1, n.get(1, 0)) / max(1, n.get(0, 0))))
    return grammar


def score_toxicity(docs: DataFrame, grammar: Grammar, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` of ``docs`` and struct ``_toxicity``: ``score`` and ``n_matches`` (matched entries)."""
    kept = docs.columns if keep is None else keep
    own = ["__toxicity_score", "__toxicity_n"]
    shown = docs.select(*[F.col(f"`{c}`") for c in kept], F.lit(None).cast("double").alias(own[0]), F.lit(None).cast("long").alias(own[1])).schema
    sent = docs.sparkSession.sparkContext.broadcast(grammar)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = sent.value
        for batch in batches:
            cols = {f.name: batch.column(i) for i, f in enumerate(batch.schema)}
            found = [g.score(t.as_py()) for t in text_column(cols[text])]
            cols[own[0]] = pa.array([s for s, _ in found], type=pa.float64())
            cols[own[1]] = pa.array([n for _, n in found], type=pa.int64())
            yield pa.RecordBatch.from_arrays([cols[k] for k in shown.names], names=shown.names)

    out = docs.mapInArrow(run, shown)
    return out.select(*[F.col(f"`{c}`") for c in kept], F.struct(F.col(own[0]).alias("score"), F.col(own[1]).alias("n_matches")).alias("_toxicity"))
