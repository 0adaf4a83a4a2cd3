import random

import pytest

from binscope.llm import token_counts as T
from binscope.llm.queries import op13_token_counts, tokenizer_path

from .cases import awkward, awkward_rows, by_row, empty

PATH = tokenizer_path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(PATH)


def count(library, text) -> int:
    return len(library.encode(text or "", add_special_tokens=False))


def texts(seed: int) -> list[str]:
    r = random.Random(seed)
    parts = ["don't", "we'll", "'s", "''", "x1y2", "naïve", "é", "́", "ſ", "İ", "日本語", "。", "😀", "<|endoftext|>", "<|startoftext|>", "<|end",
             "...", "--", "=≠", " ", "  ", "\n", "\t", " ", " ", "1234", "ﬁ", "각", "ᄀ", "ᅡ", "A", "the", "quick"]
    prose = ["".join(r.choice(parts) + r.choice(["", " ", " "]) for _ in range(r.randint(50, 900))) for _ in range(60)]
    return [*prose, "a" * 3000, "ab" * 2000 + " " + "c" * 1000, "日本語" * 900, "'" * 700 + "s" * 900, "́" * 900, "1" * 2500,
            "<|endoftext|>" * 200, " " * 3000, "x " * 1500, ("word " * 30 + "z" * 500) * 6]


def test_spliced_counts_equal_the_library(spark, library):
    rows = [(i, t) for i, t in enumerate(texts(3))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = sorted((i, len(t.encode()), count(library, t)) for i, t in rows)
    for chunk, overlap in ((200, 32), (64, 20), (1000, 100)):
        got = T.count_tokens(docs, PATH, keep=["doc_id"], chunk=chunk, overlap=overlap).select("doc_id", "_tokens.n_bytes", "_tokens.n_tokens")
        assert sorted(map(tuple, got.collect())) == want, (chunk, overlap)


def test_every_mark_is_a_border_of_the_whole_text(library):
    e = T.encoder(PATH)
    for text in texts(4):
        whole = library.encode(text, add_special_tokens=False)
        starts, ends = [a for a, _ in whole.offsets], [b for _, b in whole.offsets]
        for border in range(100, len(text) - 100, 173):
            for lo, hi in ((0, min(len(text), border + 100)), (border - 100, len(text))):
                own = T.marks(e, text[lo:hi], border - lo, 60)
                for m in own:
                    x = m["place"] + lo
                    n = sum(s < x for s in starts)
                    assert max(ends[:n], default=0) <= x, (text, border, m)
                    right = count(library, text[lo:]) - (m["n"] if lo else 0)
                    assert (m["n"] == n) if lo == 0 else (right == len(starts) - n), (text, border, m)


def test_counts_without_memory_and_other_vocabularies(library, monkeypatch):
    monkeypatch.setattr(T, "MEMO", 5)
    e = T.Encoder(PATH)
    for _ in range(2):
        assert [e.count([t])[0] for t in texts(8)] == [count(library, t) for t in texts(8)]
    assert len(e.known) <= 5
    with pytest.raises(ValueError):
        T.Encoder(tokenizer_path("byte_bpe_50k.json"))


def test_a_text_without_stable_places_is_widened_to_one_chunk(spark, library, monkeypatch):
    used = []
    cut = T._cut
    monkeypatch.setattr(T, "_cut", lambda chunk, overlap: used.append((chunk, overlap)) or cut(chunk, overlap))
    text = "é" * 5000
    docs = spark.createDataFrame([(1, text), (2, "ok then " * 600)], "doc_id long, text string")
    got = {r[0]: r[1] for r in T.count_tokens(docs, PATH, keep=["doc_id"], chunk=300, overlap=16).select("doc_id", "_tokens.n_tokens").collect()}
    assert got == {1: count(library, text), 2: count(library, "ok then " * 600)}
    assert used == [(300, 16), (1200, 64), (4800, 256), (19200, 1024)]


def test_awkward_rows(spark, library, tmp_path):
    awkward(spark).write.parquet(str(tmp_path / "documents.parquet"))
    want = [(i, len((t or "").encode()), n := count(library, t), n > 2048) for i, t in awkward_rows()]
    assert by_row(op13_token_counts(spark, str(tmp_path)).collect()) == by_row(want)
    assert T.count_tokens(awkward(spark), PATH, chunk=50, overlap=10).columns == [*awkward(spark).columns, "_tokens"]
    assert T.count_tokens(empty(spark), PATH).count() == 0


def test_whole_table_equals_the_library(spark, library, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet").select("doc_id", "text").collect()
    want = [(d, len((t or "").encode()), n := count(library, t), n > 2048) for d, t in docs]
    assert by_row(op13_token_counts(spark, small_dir).collect()) == by_row(want)
