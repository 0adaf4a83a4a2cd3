import hashlib
import random

import pyarrow as pa
import pytest

from binscope.llm import pieces as P
from binscope.llm.queries import tokenizer_path

from .cases import awkward, awkward_rows, by_row, empty

PATH = tokenizer_path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def vocabulary():
    return P.Vocabulary(PATH)


def test_agenda_equals_the_library_on_random_texts(vocabulary):
    r = random.Random(11)
    letters = "  \n\tabcdefghijk tionthe ▁.,%$#éü中文字😀\x00\r<s>0x41</unk>ＡḀ"
    for _ in range(3000):
        s = "".join(r.choice(letters) for _ in range(r.randint(0, 40)))
        ids = vocabulary.encode(s)
        assert ids == vocabulary.library.encode(s), repr(s)
        assert vocabulary.decode(ids) == vocabulary.library.decode(ids), repr(s)


def test_cutting_changes_nothing(vocabulary):
    for s in ("the quick  brown\n\nfox", "naïve▁▁x", "   ", "a\nb"):
        whole = P.BLANK + s.replace(" ", P.BLANK)
        assert vocabulary.merge(whole) == vocabulary.encode(s)


def test_cache_overflow_keeps_results(vocabulary, monkeypatch):
    texts = [t or "" for _, t in awkward_rows()]
    full: list[list] = [[], [], []]
    P._encode(vocabulary, texts, full)
    monkeypatch.setattr(P, "CACHE_CHUNKS", 3)
    for _ in range(2):
        few: list[list] = [[], [], []]
        for t in texts:
            P._encode(vocabulary, [t], few)
        assert few == full


def test_awkward_rows(spark, vocabulary):
    sp = vocabulary.library
    want = []
    for i, t in awkward_rows():
        ids = sp.encode(t or "")
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(sp.decode(ids).encode()).hexdigest()))
    got = P.encode_documents(awkward(spark), PATH, keep=["doc_id"]).select("doc_id", "_pieces.*")
    assert by_row(got.collect()) == by_row(want)
    assert P.encode_documents(awkward(spark), PATH).columns == [*awkward(spark).columns, "_pieces"]
    assert P.encode_documents(empty(spark), PATH).count() == 0
    lists = {r["doc_id"]: r["token_ids"] for r in P.encode_ids(awkward(spark).filter("doc_id in (4, 10)"), PATH).collect()}
    assert lists == {i: sp.encode(t) for i, t in awkward_rows() if i in (4, 10)}


def test_short_and_long_texts_merge_alike(vocabulary, monkeypatch):
    """The list of scores and the heap give the same ids, and short texts never go to the heap."""
    v = vocabulary
    r = random.Random(4)
    texts = ["", "a", "aaaaaaa", "▁▁▁▁▁", "\x00\x01", "zażółć", "日本語日本語", "éé"]
    texts += ["".join(r.choices("▁abcdeilnorstßéж日,.1\n", k=r.randint(1, P.SHORT))) for _ in range(3000)]
    with monkeypatch.context() as m:
        m.setattr(P, "SHORT", -1)
        by_heap = [v.merge(t) for t in texts]
    monkeypatch.setattr(P.heapq, "heapify", lambda x: 1 / 0)
    assert [v.merge(t) for t in texts] == by_heap


def test_a_worker_keeps_the_caches_until_a_task_of_another_operator():
    from binscope.llm import text as T
    P._VOCABULARY.clear()
    batch = pa.RecordBatch.from_pydict({"doc_id": [1], "text": ["some text"]})
    run = P._scan(PATH, "text", ["doc_id", "n", "ids", "plain"], ["n", "ids", "plain"])
    for _ in range(2):
        list(T.giving_back(run, keeps="pieces")(iter([batch])))
        assert len(P._VOCABULARY[PATH].chunk_ids) == 2
    list(T.giving_back(lambda b: b)(iter([batch])))
    assert not P._VOCABULARY and not T.cache_of("pieces")


def test_scans_are_sent_without_the_drivers_caches():
    """A worker empties its own caches, not a copy that came with the task."""
    from pyspark.cloudpickle import dumps

    from binscope.llm import text as T
    P.vocabulary(PATH)
    assert len(dumps(T.giving_back(P._scan("x", "text", ["a"], ["a"]), keeps="pieces"))) < 50_000
