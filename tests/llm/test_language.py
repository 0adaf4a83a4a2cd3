import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from binscope.llm import language as G
from binscope.llm.text import crc_bucket

from .cases import awkward, awkward_rows, empty


def test_grams_are_four_characters_of_one_text():
    numbers = G.numbering(np.array([ord(c) for c in "abcdx"]))
    show = {0: "\0", G._BLANK: " ", G._OTHER: "?"} | {G._OTHER + 1 + i: c for i, c in enumerate("abcdx")}
    keys, upto, letters = G.grams(["Ab", "", "c  d!", "\n\n", "\0x"], numbers)
    assert upto.tolist() == [0, 2, 2, 6, 7, 9]
    assert letters.tolist() == [True, False, True, False, True]
    text = ["".join(show[int(k) >> 16 * j & 0xFFFF] for j in (3, 2, 1, 0)) for k in keys]
    assert text == ["\0\0\0a", "\0\0ab", "\0\0\0c", "\0\0c ", "\0c d", "c d ", "\0\0\0 ", "\0\0\0 ", "\0\0 x"]


def test_letters_beyond_16_bits_are_letters_of_their_own(spark):
    high = "".join(chr(0x20000 + i) for i in range(40))
    numbers = G.numbering(np.array([ord("a"), 0x10041, 0x20000]))
    one = lambda t: int(G.grams([t], numbers)[0][-1]) & 0xFFFF
    assert len({one("a"), one("A\U00010041"), one("\U00020000"), one("z"), one(" ")}) == 5
    assert one("z") == one("\U0002A000") == G._OTHER and len(G.grams(["\U00020000\U00030000"], numbers)[0]) == 2
    rows = [(i, ("".join(chr(97 + (i * j) % 13) for j in range(1, 40)), "aa") if i % 2 else (high[i % 20:] + high[:i % 20], "bb")) for i in range(80)]
    docs = spark.createDataFrame([(i, t, lang) for i, (t, lang) in rows], "doc_id long, text string, lang string")
    got = G.predict_language(docs, G.fit_languages(docs)).collect()
    assert all(r["_language"]["lang_pred"] == r["lang"] for r in got)


def brute_entropy(learn, languages, text):
    """Cross-entropy per character by definition, in plain dictionaries."""
    def clean(t):
        return re.sub(" +", " ", "".join(c if c.isalpha() else " " for c in t.replace("\0", " ").lower()))
    out = []
    alphabet = {c for t, _ in learn for c in clean(t)}
    for lang in languages:
        count = [Counter() for _ in range(5)]
        for t, own in learn:
            padded = "\0\0\0" + clean(t)
            if own == lang:
                count[4].update(padded[i:i + 4] for i in range(len(padded) - 3))
        for k in (3, 2, 1):
            count[k].update(g[1:] for g in count[k + 1])
        d, total, types = [0] * 5, Counter(), Counter()
        for k in range(1, 5):
            n1, n2 = (sum(c == x for c in count[k].values()) for x in (1, 2))
            d[k] = min(max(n1 / (n1 + 2 * n2) if n1 + n2 else 0.5, 0.05), 0.95)
            for g, c in count[k].items():
                total[k, g[:-1]] += c
                types[k, g[:-1]] += 1

        def p(k, g):
            if not k:
                return 1 / (len(alphabet) + 1)
            n, h = total[k, g[:-1]], max(total[k, g[:-1]], 1)
            return max(count[k][g] - d[k], 0) / h + (d[k] * types[k, g[:-1]] / h if n else 1) * p(k - 1, g[1:])

        padded = "\0\0\0" + clean(text)
        out.append(-sum(math.log(p(4, padded[i:i + 4])) for i in range(len(padded) - 3)) / (len(padded) - 3))
    return out


def test_entropies_match_brute_force():
    r = np.random.default_rng(3)
    words = lambda letters: " ".join("".join(r.choice(list(letters), r.integers(1, 6))) for _ in range(12))
    learn = [(words("abcde\U00020000"), "aa") for _ in range(15)] + [(words("cdefgh é"), "bb") for _ in range(15)]
    letters = sorted({ord(c) for t, _ in learn for c in t.lower() if c.isalpha()})
    rows = []
    for i, lang in enumerate(("aa", "bb")):
        key, n = np.unique(G.grams([t for t, own in learn if own == lang], G.numbering(np.array(letters)))[0], return_counts=True)
        rows += [(k, i, c) for k, c in zip(key, n)]
    model = G.CharacterModels(["aa", "bb"], np.array(letters)).fit(*(np.array(x) for x in zip(*rows)))
    texts = [words("abcdefgh") for _ in range(20)] + ["a", "Abba! cde", "\U00020000\U00020000 a"]
    got, _ = model.entropies(texts)
    for t, h in zip(texts, got):
        assert h.tolist() == pytest.approx(brute_entropy(learn, ["aa", "bb"], t), rel=1e-4), t


def test_every_context_is_a_distribution():
    texts = {"aa": ["abab cabab", "ba"], "bb": ["xyx xyzx"]}
    numbers = G.numbering(np.array([ord(c) for c in "abcxyz"]))
    rows = []
    for i, (_, own) in enumerate(texts.items()):
        key, n = np.unique(G.grams(own, numbers)[0], return_counts=True)
        rows += [(k, i, c) for k, c in zip(key, n)]
    model = G.CharacterModels(list(texts)).fit(*(np.array(x) for x in zip(*rows)))
    letters = np.unique(np.array([r[0] for r in rows]) & np.uint64(0xFFFF))
    for context in {int(r[0]) >> 16 for r in rows} | {int(numbers[ord('x')]) << 32 | int(numbers[ord('y')]) << 16 | int(numbers[ord('z')])}:
        keys = np.array([context << 16 | int(c) for c in letters], dtype=np.uint64)
        p = np.exp(model.lookup(G.ORDER, keys).astype(float)).sum(axis=0)
        # the floor has one place more, for characters that were never seen
        assert (p <= 1 + 1e-5).all() and (p > 0.7).all()


def test_accuracy_on_texts_it_has_not_seen(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text", "lang")
    model = G.fit_languages(docs.filter(crc_bucket(3) != 1), per_language=200)
    assert model.languages == ["de", "en", "es", "fr"]
    got = G.predict_language(docs.filter(crc_bucket(3) == 1), model, keep=["doc_id", "lang"]).collect()
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1 for r in got)
    assert sum(r["lang"] == r["_language"]["lang_pred"] for r in got) / len(got) > 0.99
    assert all(0 <= r["_language"]["score"] <= 1 for r in got)
    assert sum(r["_language"]["rejected"] for r in got) / len(got) < 0.03


def test_awkward_rows_and_empty_tables(spark):
    docs = awkward(spark)
    rows = awkward_rows()
    model = G.fit_languages(docs)
    got = G.predict_language(docs, model).collect()
    assert len(got) == len(rows)
    for r in got:
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["_language"]["lang_pred"] == "en") == letters
        assert letters or (r["_language"]["lang_pred"] == "und" and r["_language"]["score"] == 0)
    nothing = G.fit_languages(empty(spark))
    assert {r["_language"]["lang_pred"] for r in G.predict_language(docs, nothing).collect()} == {"und"}
    assert G.predict_language(empty(spark), model).count() == 0
