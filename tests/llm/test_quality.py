import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from binscope.llm import quality as Q

from .cases import awkward, awkward_rows, by_row, empty

SMALL = "/root/testdata/sf0.01"


def base(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
    grams = {}
    for k in range(len(w) - 2):
        grams.setdefault(tuple(w[k:k + 3]), []).append(k)
    repeated = {p for at in grams.values() if len(at) > 1 for k in at for p in (k, k + 1, k + 2)}
    seen, dup = set(), 0
    for line in (t or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    failed = len(w) < 50 or 100 * len(repeated) > 50 * len(w)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), dup, len(repeated), failed


def values(df):
    return by_row((r[0], *[r[1][k] for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")]) for r in df.collect())


def test_base_rules_match_brute_force(spark):
    rows = awkward_rows()
    got = Q.score_quality(awkward(spark), None, keep=["doc_id"])
    assert values(got) == by_row((i, *base(t)) for i, t in rows)
    whole = Q.score_quality(awkward(spark), None)
    assert whole.columns == [*awkward(spark).columns, "_quality"]
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert values(Q.score_quality(docs, None, keep=["doc_id"])) == by_row((r[0], *base(r[1])) for r in docs.select("doc_id", "text").collect())


def test_trigrams_are_of_characters():
    texts = ["añb日本😀", "", "ab", "añb", "日本😀日本😀"]
    for lo, hi, buf, offs in Q.slices(pa.array(texts)):
        _, _, h, upto = Q.words(buf, offs, Q.NONSPACE, lower=False)
        feature, bounds = Q._grams(buf, offs, h, upto)[0]
        assert (lo, hi) == (0, 5) and np.diff(bounds).tolist() == [max(0, len(t) - 2) for t in texts]
        grams = [t[k:k + 3] for t in texts for k in range(len(t) - 2)]
        assert len(set(zip(grams, feature.tolist()))) == len(set(grams)) == len(set(feature.tolist()))


def test_probabilities_match_brute_force(spark):
    r = np.random.default_rng(4)
    size = 3 << Q.BITS
    model = Q.QualityModel(r.normal(size=size), 0.3, 0.7, -0.2)

    def brute(text):
        margin = 0.0
        for _, _, buf, offs in Q.slices(pa.array([text or ""])):
            _, _, h, upto = Q.words(buf, offs, Q.NONSPACE, lower=False)
            for feature, _ in Q._grams(buf, offs, h, upto):
                margin += sum(model.weights[f] for f in feature.tolist()) / max(1, len(feature))
        return 1 / (1 + np.exp(-(0.7 * (margin + 0.3) - 0.2)))

    got = Q.score_quality(awkward(spark), model, keep=["doc_id", "text"]).collect()
    for row in got:
        p, q = brute(row["text"]), row["_quality"]
        assert abs(p - q["p_good"]) < 1e-9 and q["kept"] == (not q["base_failed"] and p >= Q.KEEP_FROM)


def test_classifier_is_right_on_rows_it_has_not_seen(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    model = Q.fit_quality(docs, labels.filter(fold != 0), per_class=400)
    rows = Q.score_quality(docs.join(labels.filter(fold == 0), "doc_id"), model, keep=["doc_id", "quality"]).collect()
    judged = [r for r in rows if not r["_quality"]["base_failed"]]  # the base rules decide on the others
    right = [r["_quality"]["kept"] == (r["quality"] == 1) for r in judged]
    assert len(judged) > 500 and sum(right) / len(right) > 0.99
    # calibrated: the mean probability is near the share of good rows
    assert abs(sum(r["_quality"]["p_good"] for r in judged) / len(judged) - sum(r["quality"] for r in judged) / len(judged)) < 0.05
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 4 == 0 for r in rows)


def test_labels_that_give_no_model(spark):
    labels = spark.createDataFrame([(3, 1, None), (None, 0, 1), (99, None, None)], "doc_id long, quality int, toxic int")
    assert Q.fit_quality(awkward(spark), labels) is None
    assert Q.fit_quality(empty(spark), labels.limit(0)) is None
    assert Q.score_quality(empty(spark), None).count() == 0
    kept = Q.score_quality(awkward(spark), None, keep=["doc_id"]).collect()
    assert all(r[1]["kept"] == (not r[1]["base_failed"]) for r in kept)


def test_temporaries_stay_small_and_freed_memory_is_given_back(monkeypatch):
    """Workers are reused beside an executor's heap: a batch of some MB needs no hundreds of MB, and a task leaves none."""
    import tracemalloc

    from binscope.llm import neardup as N
    from binscope.llm import text as T
    texts = [" ".join(f"w{i * j % 977}x" for j in range(400)) for i in range(1500)]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text": texts})
    assert batch.nbytes > 3_000_000
    own = [f"__quality_{c}" for c in Q.STATISTICS]
    model = Q.QualityModel(np.zeros(3 << Q.BITS), 0.0, 1.0, 0.0)
    given = []
    monkeypatch.setattr(T, "give_back", lambda: given.append(True))
    for run in (Q._scan(model, ["doc_id", *own], "text", own), N._sign):
        tracemalloc.start()
        rows = sum(b.num_rows for b in T.giving_back(run)(iter([batch])))
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert rows == len(texts) and most < 30e6
    assert len(given) == 2


def test_memory_can_be_given_back():
    from binscope.llm import text as T
    T.give_back()
    assert [b.num_rows for b in T.giving_back(lambda b: b)(iter([pa.RecordBatch.from_pydict({"a": [1, 2]})]))] == [2]
