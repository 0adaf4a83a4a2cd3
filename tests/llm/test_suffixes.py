import hashlib
import random

import numpy as np

from binscope.llm import suffixes as S

from .cases import awkward, awkward_rows, by_row, empty


def brute(rows):
    texts = [(t or "").encode() for _, t in rows]
    count: dict[bytes, int] = {}
    for t in texts:
        for s in range(len(t) - 199):
            count[t[s:s + 200]] = count.get(t[s:s + 200], 0) + 1
    out = []
    for (d, _), t in zip(rows, texts):
        gone = [False] * len(t)
        for s in range(len(t) - 199):
            if count[t[s:s + 200]] > 1:
                gone[s:s + 200] = [True] * 200
        spans = sum(g and not p for g, p in zip(gone, [False, *gone]))
        out.append((d, len(t), sum(gone), spans, hashlib.sha256(bytes(b for b, g in zip(t, gone) if not g)).hexdigest()))
    return by_row(out)


def result(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return by_row(S.remove_repeats(docs).drop("kept").collect())


def rows_with_repeats(seed):
    r = random.Random(seed)

    def noise(n):
        return "".join(r.choice("abcdefgh é") for _ in range(n))
    shared = [noise(n) for n in (190, 199, 200, 201, 260, 700)]
    rows = []
    for i in range(60):
        rows.append((i, "".join(r.choice([noise(r.randint(0, 150)), r.choice(shared), r.choice(shared)[r.randint(0, 60):]]) for _ in range(r.randint(1, 6)))))
    rows += [(70, "ab" * 300), (71, "ba" * 150 + noise(50)), (72, "\0" * 450), (73, "\0" * 199), (74, noise(100) + "\0" * 230)]
    return rows


def test_multikey_sort_orders_rows_and_prefixes():
    r = np.random.default_rng(5)
    rows = r.integers(0, 2, (300, 21)).astype(np.uint8)
    rows[50:80] = rows[50]
    order, common = S.multikey_sort(rows)
    ordered = [bytes(rows[i]) for i in order]
    assert ordered == sorted(ordered)
    for k in range(1, 300):
        n = next((j for j in range(21) if ordered[k][j] != ordered[k - 1][j]), 21)
        assert common[k] == n


def test_anchor_of_a_string_is_its_own():
    r = np.random.default_rng(5)
    body = r.integers(97, 100, 900).astype(np.uint8)
    text = np.concatenate((body, r.integers(97, 100, 50).astype(np.uint8), body))
    start, anchor, _ = S.anchors(text, np.array([0, len(text)]))
    assert (start == np.arange(len(text) - 199)).all()
    inside = 900 - 199
    assert (anchor[:inside] - start[:inside] == anchor[950:950 + inside] - start[950:950 + inside]).all()
    assert ((anchor >= start) & (anchor + S.GRAM <= start + S.LENGTH)).all()


def test_matches_brute_force(spark):
    rows = rows_with_repeats(1)
    assert result(spark, rows) == brute(rows)


def test_many_buckets_and_hot_keys_change_nothing(spark, monkeypatch):
    rows = rows_with_repeats(2)
    want = brute(rows)
    monkeypatch.setattr(S, "BUCKET_RECORDS", 20)
    assert result(spark, rows) == want
    monkeypatch.setattr(S, "HOT", 3)
    assert result(spark, rows) == want


def test_awkward_rows_and_empty_tables(spark):
    got = S.remove_repeats(awkward(spark))
    assert by_row(got.drop("kept").collect()) == brute(awkward_rows())
    for r in got.collect():
        assert r["kept"] is None or hashlib.sha256(r["kept"]).hexdigest() == r["kept_sha256"]
    assert S.remove_repeats(empty(spark)).count() == 0
