import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa

from binscope.llm import neardup as N
from binscope.llm.text import slices

from .cases import awkward, awkward_rows, by_row, empty


def words_of(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))


def shingle_set(t):
    w = words_of(t)
    n = min(5, len(w))
    return {tuple(w[k:k + n]) for k in range(len(w) - n + 1)} if w else set()


def brute(rows):
    """Class id of every row by comparing all pairs."""
    sets = [shingle_set(t) for _, t in rows]
    comp = list(range(len(rows)))

    def root(i):
        while comp[i] != i:
            i = comp[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and both >= 0.8 * (len(sets[i]) + len(sets[j]) - both):
                comp[root(i)] = root(j)
    ids = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            ids[root(i)] = min(d, ids.get(root(i), d))
    return by_row((d, d if not sets[i] else ids.get(root(i))) for i, (d, _) in enumerate(rows))


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


def classes(spark, rows):
    return by_row(N.near_duplicate_classes(frame(spark, rows)).select("doc_id", "class_id").collect())


def test_signatures_estimate_probability_jaccard():
    r = np.random.default_rng(1)
    keys = r.integers(1, 1 << 60, 400).astype(np.uint64)
    x, y = r.integers(0, 6, 400).astype(float), r.integers(0, 6, 400).astype(float)
    y[:250] = x[:250]
    hit = []
    for registers in (4096,):
        both = []
        for w in (x, y):
            own = np.flatnonzero(w)
            both.append(N.probminhash(np.zeros(len(own)), keys[own], w[own], 1, registers)[0])
        hit.append((both[0] == both[1]).mean())
    exact = 0.0
    for i in np.flatnonzero((x > 0) & (y > 0)):
        exact += 1 / np.maximum(x / x[i], y / y[i]).sum()
    assert abs(hit[0] - exact) < 0.03
    # early termination changes nothing: rows in one call are as alone
    own = np.flatnonzero(x)
    two = N.probminhash(np.repeat([0, 1], len(own)), np.tile(keys[own], 2), np.tile(x[own], 2), 2)
    assert (two[0] == two[1]).all() and (two[0] != 0).all()


def test_shingles_match_brute_force():
    rows = awkward_rows()
    for _, _, buf, offs in slices(pa.array([t for _, t in rows])):
        _, _, (row, _), count = N.shingles(buf, offs)
        n = Counter(row.tolist())
        assert [n[i] for i in range(len(rows))] == [len(shingle_set(t)) for _, t in rows]
        total = [max(0, len(words_of(t)) - 4) or min(1, len(words_of(t))) for _, t in rows]
        assert [int(count[row == i].sum()) for i in range(len(rows))] == total


def test_classes_match_brute_force_on_chains_and_groups(spark):
    r = random.Random(3)
    rows, k = [], 0
    for group in range(6):
        text = [f"w{group}_{r.randint(0, 400)}" for _ in range(80)]
        for _ in range(14):  # a chain: each near the one before, the ends far apart
            text = list(text)
            text[r.randrange(80)] = f"c{r.randint(0, 9999)}"
            rows.append((k * 7 % 1009, " ".join(text)))
            k += 1
    base = [f"h{r.randint(0, 900)}" for _ in range(120)]
    for _ in range(40):  # a group around a text, whose members may be far from each other
        text = list(base)
        for _ in range(r.randint(0, 4)):
            text[r.randrange(120)] = f"x{r.randint(0, 9999)}"
        rows.append((k * 7 % 1009, " ".join(text)))
        k += 1
    rows += [(k * 7 % 1009 + i, " ".join(f"u{r.randint(0, 9999)}" for _ in range(50))) for i in range(20)]
    assert classes(spark, rows) == brute(rows)


def test_a_pair_is_a_candidate_once_however_many_shingles_it_shares(spark):
    r = random.Random(8)
    base = [f"w{k}" for k in range(300)]
    texts = []
    for i in range(40):
        own = list(base)
        for k in r.sample(range(300), r.choice((2, 6, 9, 12))):
            own[k] = f"x{i}x{k}"
        texts.append(" ".join(own[:r.choice((240, 300))]))
    sets = [shingle_set(t) for t in texts]
    nodes = [bytes([i]) for i in range(len(texts))]
    table = spark.createDataFrame(list(zip(nodes, texts)), "node binary, text string")
    open_ = N._open(N._rare_buckets(table), spark.createDataFrame([], "node binary, comp binary"))
    rows = [(bytes(p.a), bytes(p.b)) for p in N._candidates(open_, open_).collect()]
    linked = {(nodes[i], nodes[j]) for j in range(len(nodes)) for i in range(j)
              if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])}
    assert len(linked) > 50
    assert linked <= set(rows)
    # both ends are leaders here, so each pair comes from either side
    assert len(rows) <= 2.2 * len(set(rows))


def test_a_bucket_is_compared_until_nothing_is_open(spark, monkeypatch):
    """All rows in common buckets: only leaders in turn can find the links."""
    r = random.Random(9)
    rows = []
    for group in range(5):
        base = [f"g{group}_{i}" for i in range(60)]
        for _ in range(5):
            text = list(base)
            text[r.randrange(60)] = f"x{r.randint(0, 9999)}"
            rows.append((len(rows), " ".join(text)))
    real = N._sign

    def everywhere(batches):
        for b in real(batches):
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([[1, 2]] * b.num_rows, type=pa.list_(pa.int64()))], names=b.schema.names)
    monkeypatch.setattr(N, "_sign", everywhere)
    assert classes(spark, rows) == brute(rows)


def test_repeated_passages_do_not_hide_links(spark):
    """A text and the same with a passage repeated many times: sets 0.8 alike, weighted shingles 0.45."""
    rows = []
    for k in range(80):
        text = [f"p{k}_{i}" for i in range(104)]
        advert = [f"a{k}_{i}" for i in range(20)] * 50
        rows += [(2 * k, " ".join(text)), (2 * k + 1, " ".join(text + advert))]
    got = classes(spark, rows)
    assert got == brute(rows) and len({c for _, c in got}) == 80


def test_awkward_rows_and_empty_tables(spark):
    rows = awkward_rows()
    got = N.near_duplicate_classes(awkward(spark)).select("doc_id", "class_id")
    assert by_row(got.collect()) == brute(rows)
    kept = N.drop_near_duplicates(awkward(spark))
    assert kept.columns == awkward(spark).columns
    want = [r for r in rows if not words_of(r[1])] + [(3, "a"), (4, "x y z")] + [r for r in rows if r[0] in (5, 8, 9, 10, 11, 13, 14)] + [r for r in rows if r[0] is None and r[1]]
    assert by_row(kept.select("doc_id", "text").collect()) == by_row(want)
    assert N.near_duplicate_classes(empty(spark)).count() == 0
    assert N.drop_near_duplicates(empty(spark)).count() == 0


def test_pairs_are_compared_in_parts(monkeypatch):
    """The sets of a batch's texts are not all held at once, and parts give the same links."""
    import tracemalloc
    r = random.Random(4)
    texts = [" ".join(r.choices("abcdefghij", k=1500)) for _ in range(1500)]
    other = [t if k % 3 else t[::-1] for k, t in enumerate(texts)]
    ids = [k.to_bytes(4, "big") for k in range(len(texts))]
    batch = pa.RecordBatch.from_pydict({"a": pa.array(ids, pa.binary()), "b": pa.array(ids, pa.binary()), "text_a": texts, "text_b": other})
    tracemalloc.start()
    parts = list(N._similarity(iter([batch, batch.slice(0, 0)])))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    whole = [k for k in range(len(texts)) if k % 3]
    assert sorted(int.from_bytes(x, "big") for b in parts for x in b.column(0).to_pylist()) == whole
    assert most < 25e6
    monkeypatch.setattr(N, "_PAIR_BYTES", 1)
    assert sum(b.num_rows for b in N._similarity(iter([batch.slice(0, 30)]))) == 20
