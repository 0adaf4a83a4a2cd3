import random
import re

import numpy as np
import pyarrow as pa

from binscope.llm import decontaminate as D

from .cases import awkward, awkward_rows, by_row, empty


def words_of(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))


def brute(text, items, window=10):
    """(n_words, hit word places, ids of items with an occurring window)."""
    w, hit, found = words_of(text), set(), set()
    for i, t in items:
        x = words_of(t)
        n = min(window, len(x))
        for k in range(len(x) - n + 1) if x else ():
            for p in range(len(w) - n + 1):
                if w[p:p + n] == x[k:k + n]:
                    hit |= set(range(p, p + n))
                    if i is not None:
                        found.add(str(i))
    return len(w), hit, sorted(found)


def test_suffix_array_is_sorted():
    r = np.random.default_rng(3)
    tokens = np.append(r.integers(0, 4, 400), 0)
    starts = np.flatnonzero(tokens)

    def suffix(p):
        end = p + int(np.argmax(tokens[p:] == 0))
        return tuple(tokens[p:end])
    order = D.suffix_array(tokens, starts, 400)
    assert [suffix(p) for p in order] == sorted(suffix(p) for p in starts)


def check(spark, docs, rows, items, **more):
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = D.find_contamination(docs, bench, keep=["doc_id"], **more).collect()
    seen = by_row((r[0], r[1]["n_words"], sum(s["end"] - s["start"] for s in r[1]["spans"]), tuple(r[1]["items"])) for r in got)
    want = []
    for i, t in rows:
        n, hit, found = brute(t, items)
        want.append((i, n, len(hit), tuple(found)))
    assert seen == by_row(want)
    return got


def test_windows_match_brute_force_in_one_and_many_blocks(spark):
    r = random.Random(5)
    vocabulary = ["ab", "cd", "ef", "gh", "é"]
    rows = [(i, " ".join(r.choice(vocabulary) for _ in range(r.randint(0, 60)))) for i in range(40)]
    items = [(i, " ".join(rows[i][1].upper().split()[3:3 + n])) for i, n in enumerate([1, 3, 9, 10, 11, 30, 5, 7])]
    items += [(1, items[1][1]), (None, rows[20][1][:25]), (99, None), (98, " . "), (97, "ab cd " * 12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    check(spark, docs, rows, items)
    check(spark, docs, rows, items, block_bytes=40)


def test_longest_match_goes_beyond_the_window(spark):
    text = " ".join(f"w{k}" for k in range(40))
    docs = spark.createDataFrame([(1, "some words before " + text)], "doc_id long, text string")
    got = check(spark, docs, [(1, "some words before " + text)], [(7, "zzz " + text)])
    assert got[0]["_leak"]["longest"].asDict() == {"item_id": "7", "item_word": 1, "doc_word": 3, "n_words": 40}


def test_repeated_items_are_sent_once(spark, monkeypatch):
    sent = []
    build = D.TestSuffixes.__init__
    monkeypatch.setattr(D.TestSuffixes, "__init__", lambda self, rows, window: sent.append(len(rows)) or build(self, rows, window))
    rows = [(1, "a b c d e"), (2, "c d")]
    items = [(5, "c d")] * 400 + [(None, None)] * 400 + [(6, "")] * 400 + [(7, "d e")]
    got = check(spark, spark.createDataFrame(rows, "doc_id long, text string"), rows, items, block_bytes=100)
    assert sum(sent) == 2 and [r[1]["longest"]["item_id"] for r in sorted(got)] == ["5", "5"]


def test_awkward_rows_and_empty_tables(spark):
    rows = awkward_rows()
    items = [(1, rows[5][1][100:400]), (2, "a"), (3, None)]
    check(spark, awkward(spark).select("doc_id", "text"), rows, items)
    check(spark, awkward(spark).select("doc_id", "text"), rows, [(1, None)])
    bench = spark.createDataFrame(items, "item_id long, text string")
    kept = D.decontaminate(awkward(spark), bench)
    assert kept.columns == awkward(spark).columns
    assert by_row(kept.select("doc_id", "text").collect()) == by_row(x for x in rows if not brute(x[1], items)[1])
    assert D.decontaminate(empty(spark), bench).count() == 0
    assert D.decontaminate(awkward(spark), bench.limit(0)).count() == len(rows)


def test_shards_give_the_same_and_bound_the_memory(monkeypatch):
    """A batch may be many MB, beside an executor's heap; only a shard of it is searched at once."""
    import tracemalloc
    r = random.Random(8)
    vocabulary = [f"w{k}" for k in range(300)]
    texts = [" ".join(r.choices(vocabulary, k=500)) for _ in range(4000)] + [None, ""]
    items = [(str(k), " ".join(texts[97 * k].split()[k:k + 12])) for k in range(40)] + [("all", " ".join(vocabulary))]
    column = pa.array(texts)
    assert column.nbytes > 7_000_000
    test = D.TestSuffixes(items, 10)
    tracemalloc.start()
    got = D._batch(column, test)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 40e6
    assert [len(x) for x in got] == [len(texts)] * 4 and sum(map(bool, got[2])) >= 40
    assert got == D._shard(column, test)
    some = column.slice(0, 200)
    monkeypatch.setattr(D, "SHARD_BYTES", 3000)
    small = D.TestSuffixes(items[:3], 10)
    assert small.shard_bytes < 4000
    assert D._batch(some, small) == D._shard(some, small)
    assert D._batch(column.slice(0, 0), small) == [[], [], [], []]
