import hashlib
import random
import zlib

import numpy as np
import pytest

from binscope.llm import periodic as P
from binscope.llm.queries import op12_periodic_runs

from .cases import awkward, awkward_rows, by_row, empty


def brute_runs(words: list) -> list[tuple[int, int, int]]:
    """All stretches by definition, the least period of each."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(12, 2 * q):
                found.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted((a, m, q) for (a, m), q in found.items())


def brute_row(doc_id, text) -> tuple:
    words = [w for w in __import__("re").findall("[^\x20\x09-\x0D]+", text or "")]
    n, h = len(words), zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    drop = {i for a, m, q in runs for i in range(a + q, a + m)}
    kept = " ".join(w for i, w in enumerate(words) if i not in drop)
    top = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    listed = "".join(f"{a},{m},{q}\n" for a, m, q in runs)
    return (doc_id, len(runs), *(top or (None,) * 3), top and 1000 * top[1] // top[2],
            hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def caught(texts: list[list[int]]) -> list[list[tuple[int, int, int]]]:
    offsets = np.cumsum([0, *map(len, texts)])
    found = P.Catchers(np.array([w for t in texts for w in t], dtype=np.int64), offsets).advance()
    return [found.get(i, []) for i in range(len(texts))]


@pytest.mark.parametrize("letters", [1, 2, 3, 8])
def test_catchers_equal_brute_force_on_random_words(letters):
    r = random.Random(letters)
    texts = [[r.randrange(letters) for _ in range(r.choice([0, 1, 11, 12, 13, 30, 100, 217]))] for _ in range(120)]
    assert caught(texts) == [brute_runs(t) for t in texts]


def test_catchers_equal_brute_force_on_planted_periods():
    r = random.Random(5)
    texts = []
    for period in [*range(1, 40), 63, 64, 65, 127, 128, 129]:
        for extra in (0, 1, period // 2, period):
            root = [r.randrange(4) for _ in range(period)]
            n = max(12, 2 * period) + extra - r.choice([0, 0, 1])
            head = [r.randrange(50) for _ in range(r.randrange(30))]
            texts.append(head + [root[i % period] for i in range(n)] + [r.randrange(50) for _ in range(r.randrange(30))])
    a, b = [0], [0, 1]
    while len(b) < 600:  # a word with runs of many periods
        a, b = b, b + a
    texts += [b, b + b[:100] + b, [0, 1] * 200 + [0, 0] * 150]
    assert caught(texts) == [brute_runs(t) for t in texts]


def test_long_texts_advance_in_steps(monkeypatch):
    monkeypatch.setattr(P, "STEP", 37)
    r = random.Random(9)
    texts = [[r.randrange(2) for _ in range(150)], [3] * 20, [i % 21 for i in range(200)]]
    assert caught(texts) == [brute_runs(t) for t in texts]


def test_a_million_equal_words_are_one_run():
    assert caught([[7] * 300_000]) == [[(0, 300_000, 1)]]


def test_awkward_rows(spark, tmp_path):
    rows = [r for r in awkward_rows() if r[0] != 8]
    docs = awkward(spark).filter("doc_id is null or doc_id <> 8")
    path = str(tmp_path / "documents.parquet")
    docs.write.parquet(path)
    assert by_row(op12_periodic_runs(spark, str(tmp_path)).collect()) == by_row([brute_row(*r) for r in rows])
    assert P.find_runs(docs).columns == [*docs.columns, "_periodic"]
    assert P.find_runs(empty(spark)).count() == 0
    long = P.find_runs(awkward(spark).filter("doc_id = 8"), keep=["doc_id"]).select("_periodic.*").first()
    text = dict(awkward_rows())[8]
    assert (long["runs"] == []) == (long["collapsed"] == " ".join(text.split()))
