import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from binscope.llm import lm as L
from binscope.llm.text import crc_bucket

from .cases import awkward, awkward_rows, by_row, empty

END = "\0end"


def tokens(t):
    return [*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or "")), END]


def held(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2


def check_base(got, rows):
    count = Counter(w for i, t in rows if not held(i) for w in tokens(t))
    n, v = sum(count.values()), len(count)
    want = []
    for i, t in rows:
        w = tokens(t)
        want.append((i, held(i), len(w), sum(count[x] > 0 for x in w), n, sum(math.log10((count[x] + 1) / (n + v + 1)) for x in w)))
    want, seen = by_row(want), by_row(tuple(r[k] for k in ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score")) for r in got)
    assert [x[:5] for x in seen] == [x[:5] for x in want]
    assert all(a[5] == pytest.approx(b[5]) for a, b in zip(seen, want))
    return count, n, v


@pytest.mark.parametrize("values", [[], [0], [0, 0, 5, 5, 9, 10 ** 9], list(range(1000)), sorted(np.random.default_rng(1).integers(0, 7000, 3000).tolist())])
def test_elias_fano_round_trip(values):
    code = L.EliasFano(np.array(values, dtype=np.int64))
    assert code[np.arange(len(values))].tolist() == values


def test_codes_round_counts_down():
    n = np.unique(np.concatenate((np.arange(1, 3000), 2 ** np.arange(12, 33))))
    value = L.VALUES[L.quantise(n)]
    assert (np.diff(L.VALUES) > 0).all() and (value <= n).all() and (n < value * 2 ** (1 / 8) + 1).all()
    assert (value[n <= L.EXACT] == n[n <= L.EXACT]).all()


def grams(seed=4):
    r = np.random.default_rng(seed)
    text = (r.integers(0, 12, 4000) % r.integers(1, 13, 4000)).tolist()
    return [{k: c for k, c in Counter(zip(*[text[i:] for i in range(order)])).items() if c > 2} for order in (2, 3)]


@pytest.mark.parametrize("mapped", [False, True])
def test_trie_finds_exactly_the_kept_ngrams(mapped):
    two, three = grams()
    for kept in (two, three, {}, dict([max(three.items())])):
        order = len(next(iter(kept), (0, 0)))
        by = sorted(kept, key=lambda k: (k[-2], k[0], k[-1]))
        column = lambda at: np.array([k[at] for k in by], dtype=np.int64)
        trie = L.Trie(column(-2), column(0) if order == 3 else None, column(-1), np.array([kept[k] for k in by], dtype=np.int64))
        trie = trie.mapped() if mapped else trie
        ask = [x.ravel() for x in np.meshgrid(*[np.arange(14)] * order)]
        got = trie.codes(ask[-2], ask[0] if order == 3 else None, ask[-1])
        want = [int(L.quantise(np.array([kept.get(k, 0)]))[0]) for k in zip(*[x.tolist() for x in ask])]
        assert got.tolist() == want


def test_base_scores_match_brute_force_and_the_model_is_better(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    monkeypatch.setattr(L, "BLOCK_BYTES", 200_000)
    got = L.score_texts(docs, crc_bucket(7) == 2).collect()
    check_base(got, [(r[0], r[1]) for r in docs.collect()])
    unseen = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in unseen) > sum(r["base_score"] for r in unseen) * 0.95
    assert all(r["score"] < 0 for r in got)


def test_awkward_rows_and_empty_tables(spark):
    docs = awkward(spark)
    got = L.score_texts(docs, crc_bucket(7) == 2).collect()
    check_base(got, awkward_rows())
    assert L.score_texts(empty(spark), crc_bucket(7) == 2).count() == 0
    none = L.score_texts(docs, F.lit(True)).collect()
    assert all(r["train_tokens"] == 0 and r["n_known"] == 0 and r["base_score"] == 0 and r["score"] == 0 for r in none)


def brute_scores(rows):
    """Scores by definition: all n-grams of all words that are there twice, by their codes."""
    train = [tokens(t) for i, t in rows if not held(i)]
    code = lambda n: int(L.VALUES[L.quantise(np.array([n]))][0])
    count = [Counter(tuple(w[i:i + k]) for w in train for i in range(len(w) - k + 1)) for k in (1, 2, 3)]
    total = sum(count[0].values()) + len(count[0]) + 1
    d, under, seen = [0, 0, 0], [None, {}, {}], [None, Counter(), Counter()]
    for k in (1, 2):
        once, twice = (sum(c == x for c in count[k].values()) for x in (1, 2))
        d[k] = once / (once + 2 * twice) if once else 0.5
        for g, c in count[k].items():
            seen[k][g[:-1]] += c
            one, all_n = under[k].get(g[:-1], (0, 0))
            under[k][g[:-1]] = (one + 1, all_n + code(c)) if c >= 2 else (one, all_n)

    def p(g):
        k = len(g) - 1
        if not k:
            return (count[0][g] + 1) / total
        n, h = count[k][g], max(seen[k][g[:-1]], 1)
        kept, kept_n = under[k].get(g[:-1], (0, 0))
        return (code(n) - d[k] if n >= 2 else 0) / h + max(1 - (kept_n - d[k] * kept) / h, 1e-9) * p(g[1:])

    return [(i, held(i), sum(math.log10(p(tuple(w[max(0, j - 2):j + 1]))) for j in range(len(w)))) for i, w in ((i, tokens(t)) for i, t in rows)]


@pytest.mark.parametrize("split", [1 << 20, 40])
def test_scores_match_brute_force_for_all_words(spark, monkeypatch, split):
    """Also words below 1 in 10,000, and words whose bigrams are in several shards."""
    r = np.random.default_rng(5)
    rare = [f"r{i}" for i in range(9000)]
    rows = []
    for i in range(400):
        w = [str(x) for x in r.zipf(1.5, 60) % 500]
        at = int(r.integers(0, 4000))
        pair = [x for k in range(10) for x in ("of", "the", str(k * 7 + i % 90))]  # a hot pair with many successors
        rows.append((i, " ".join([*w, *rare[at:at + 20], *w[:5], *pair])))
    monkeypatch.setattr(L, "BLOCK_BYTES", 20_000)
    monkeypatch.setattr(L, "SPLIT", split)
    got = L.score_texts(spark.createDataFrame(rows, "doc_id long, text string"), crc_bucket(7) == 2).collect()
    for a, b in zip(by_row(tuple(r[k] for k in ("doc_id", "held_out", "score")) for r in got), by_row(brute_scores(rows))):
        assert a[:2] == b[:2] and a[2] == pytest.approx(b[2], rel=1e-9)


def test_packed_arrays_come_back():
    r = np.random.default_rng(2)
    for arrays in ([np.zeros(0, np.int64)], [np.array([0, 255, 256, 1 << 40]), np.zeros(3, np.int64), np.arange(300), r.integers(0, 200, 50).astype(np.uint8)],
                   [np.array([1 << 63, (1 << 64) - 5], dtype=np.uint64), np.array([7])]):
        back = L._unpack(L._pack(*arrays), len(arrays))
        assert [x.view(a.dtype if a.itemsize == 8 else np.int64).tolist() for x, a in zip(back, arrays)] == [a.tolist() for a in arrays]


@pytest.mark.parametrize("top", [50, 1 << 62])
def test_ranks_with_and_without_room_for_places(top):
    key = np.random.default_rng(3).integers(0, top, 500)
    for k in (key, key[:0], np.repeat(key, 3)):
        want, place = np.unique(k, return_inverse=True)
        got = L._ranks(k, top)
        assert got[0].tolist() == want.tolist() and got[1].tolist() == place.tolist()


@pytest.mark.parametrize("n", [1, 7, 64, 5000])
def test_spans_and_single_places_agree(n):
    values = np.sort(np.random.default_rng(n).integers(0, 90 * n, n))
    code = L.EliasFano(values)
    for lo, hi in ((0, n), (0, 0), (n // 3, n // 2 + 1), (n - 1, n)):
        assert code.span(lo, hi).tolist() == values[lo:hi].tolist()
    far = np.array([n - 1, 0, n // 2])
    assert code[far].tolist() == values[far].tolist()


def long_ranges():
    """Trigrams and bigrams of few words with thousands of successors and predecessors each."""
    r = np.random.default_rng(6)
    key = np.unique(r.integers(0, 4 * 3000 * 3000, 40_000))
    b, a, w = key // (3000 * 3000), key // 3000 % 3000, key % 3000
    two = np.unique(b * 3000 + w)
    return (two // 3000, None, two % 3000), (b, a, w)


def test_trie_finds_few_ngrams_in_long_ranges():
    for b, a, w in long_ranges():
        trie = L.Trie(b, a, w, np.arange(len(b)) % 9 + 2).mapped()
        for at in (np.arange(0, len(b), 997), np.array([len(b) - 1, 3]), np.zeros(0, np.int64)):
            got = trie.codes(b[at], None if a is None else a[at], w[at])
            assert got.tolist() == L.quantise(at % 9 + 2).tolist()
            assert not trie.codes(b[at] + 4, None if a is None else a[at], w[at]).any()
            assert not trie.codes(b[at], None if a is None else a[at], w[at] + 3000).any()


def test_lookups_of_sorted_ngrams_read_few_numbers_each(monkeypatch):
    """A binary search for each n-gram reads as many numbers as its range has binary digits."""
    read = []
    one, span = L.EliasFano.__getitem__, getattr(L.EliasFano, "span", None)
    monkeypatch.setattr(L.EliasFano, "__getitem__", lambda self, i: read.append(len(i)) or one(self, i))
    if span:
        monkeypatch.setattr(L.EliasFano, "span", lambda self, lo, hi: read.append(hi - lo) or span(self, lo, hi))
    for b, a, w in long_ranges():
        trie = L.Trie(b, a, w, np.full(len(b), 2))
        del read[:]
        assert (trie.codes(b, a, w) == 2).all()
        assert sum(read) < 10 * len(b)
