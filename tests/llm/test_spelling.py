import random
import re
import zlib
from collections import Counter

import pytest

from binscope.llm import spelling as S
from binscope.llm.queries import op11_spelling_variants

from .cases import awkward, awkward_rows, by_row, empty


def one_edit(a: str, b: str) -> bool:
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) < len(b):
        a, b = b, a
    return any(a[:i] + a[i + 1:] == b for i in range(len(a)))


def brute_groups(words: dict[str, int]) -> list[tuple]:
    near = {w: [v for v in words if abs(len(v) - len(w)) < 2 and one_edit(w, v)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        if best is not None and words[best] >= 5 * n:
            form[w] = best
    out = []
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, len(near[w]), words.get(form.get(w))))
    return out


def brute_words(rows) -> dict[str, int]:
    found = Counter()
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 6 and n >= 5}


def dictionary(seed: int, letters: str, size: int, longest: int) -> dict[str, int]:
    r = random.Random(seed)
    words: dict[str, int] = {}
    while len(words) < size:
        if words and r.random() < 0.5:
            w = r.choice(list(words))
            i, c = r.randrange(len(w) + 1), r.choice(letters)
            w = r.choice([w[:i] + c + w[i:], w[:i] + w[i + 1:], w[:i] + c + w[i + 1:]])
        else:
            w = "".join(r.choice(letters) for _ in range(r.randint(1, longest)))
        if w:
            words[w] = r.choice([5, 6, 25, 26, 130, 700])
    return words


@pytest.mark.parametrize("letters, size, longest", [("ab", 150, 9), ("abcé", 250, 12), ("abcdefghijkl", 250, 20), ("aé", 120, 130)])
def test_groups_equal_brute_force(spark, letters, size, longest):
    words = dictionary(size + longest, letters, size, longest)
    got = S.group_variants(spark.createDataFrame(list(words.items()), "word string, n long"))
    assert by_row(got.collect()) == by_row(brute_groups(words))


def test_very_long_words(spark):
    r = random.Random(2)
    base = "".join(r.choice("abcde") for _ in range(4000))
    words = {base: 700, base[:100] + base[101:]: 5, base[:3990] + "z" + base[3991:]: 30, "a" * 5000: 8, "a" * 4999: 40, "b" + "a" * 4999: 7,
             base[::-1]: 9, base[:2000] + "q" + base[2000:]: 6}
    got = S.group_variants(spark.createDataFrame(list(words.items()), "word string, n long"))
    assert by_row(got.collect()) == by_row(brute_groups(words))


def test_every_pair_comes_up_once(spark):
    words = dictionary(77, "ab", 120, 9)
    pairs = S.near_words(spark.createDataFrame(list(words.items()), "word string, n long"))
    rows = [(a.word, a.near) for a in pairs.collect()]
    assert len(rows) == len(set(rows)) and all((b, a) in set(rows) for a, b in rows)


def test_counts_and_small_tasks(spark, monkeypatch):
    monkeypatch.setattr(S, "FLUSH", 3)
    text = "Zürich zürich ÀÉÎÕÜß Kitchen kitchens, kitchen42kitchen_kitchen\tKITCHEN x" * 40
    rows = [(i, text) for i in range(30)] + [(None, text), (3, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.word: r.n for r in S.count_words(docs, change=S.drop_one).collect()}
    assert got == brute_words(rows)


def test_awkward_rows(spark, tmp_path):
    vocabulary = dictionary(4, "abcdeß", 60, 9)
    extra = [(100 + i, " ".join(w.title() if i % 2 else w for w in vocabulary)) for i in range(8)]
    docs = awkward(spark).select("doc_id", "text", "n_words").union(spark.createDataFrame([(*e, 1) for e in extra], "doc_id long, text string, n_words int"))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    words = brute_words([*awkward_rows(), *extra])
    assert words
    assert by_row(op11_spelling_variants(spark, str(tmp_path)).collect()) == by_row(brute_groups(words))
    assert S.spelling_variants(empty(spark)).count() == 0
