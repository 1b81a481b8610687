import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from quartzflow.llm import leakage


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=25), min_size=1, max_size=6), st.lists(st.sampled_from("abcd"), min_size=3, max_size=3))
def test_index_finds_all_places(docs, phrase):
    ix = leakage.FMIndex(docs, sample=3)
    sym = np.array([[ix.vocabulary.get(w, 0) for w in phrase]], np.int64)
    which, lo, hi = ix.search(sym)
    got = set()
    for a, b in zip(lo, hi):
        for at in ix.locate(np.arange(a, b)):
            d = int(np.searchsorted(ix.starts, at, side="right") - 1)
            got.add((d, int(at - ix.starts[d])))
    want = {(d, k) for d, w in enumerate(docs) for k in range(len(w) - 2) if w[k : k + 3] == phrase}
    assert got == want


def test_suffix_order():
    rng = random.Random(1)
    for n in (1, 2, 50, 400):
        x = np.array([rng.randint(0, 2) for _ in range(n)])
        assert leakage.suffix_order(x).tolist() == sorted(range(n), key=lambda k: x[k:].tolist())


def test_words():
    assert leakage.words_of("Straße ＡＢＣ ﬁn_x1, É é—2½") == ["strasse", "abc", "fin", "x1", "é", "é", "21", "2"]
    for t in ["plain ASCII text, 12", "Straße ＡＢＣ ﬁn é é x", "각 한글", "a b \u1100\u1161\u11a8\u0f71\u0f72 c \u0f71\u0f72\u0f71 d"]:
        w, p = leakage.words_of(t), leakage.word_places(t)
        assert len(w) == len(p) and all(leakage.words_of(t[a:b])[0].startswith(x[:1]) for x, (a, b) in zip(w, p))


def test_against_brute_force(spark):
    rng = random.Random(7)
    vocab = [f"w{k}" for k in range(30)]
    items = [(k, " ".join(rng.choice(vocab) for _ in range(rng.randint(5, 40)))) for k in range(25)] + [(98, None), (99, ""), (0, items_text := "a b c d e f g h i j k")]
    docs = []
    for k in range(200):
        w = [rng.choice(vocab) for _ in range(rng.randint(0, 60))]
        if k % 3 == 0:
            s = (items[rng.randint(0, 24)][1]).split()
            a = rng.randint(0, len(s) - 1)
            w[5:5] = s[a : a + rng.randint(8, 14)]
        docs.append((k, rng.choice([" ", ", ", "\n> "]).join(w).upper() if k % 2 else " ".join(w)))
    docs += [(500, None), (501, ""), (502, "..."), (503, items_text.upper()), (503, items_text), (504, "word " * 200_000)]
    d = spark.createDataFrame(docs, "doc_id bigint, text string").selectExpr("doc_id", "text", "1 as doc", "2 as item", "3 as word_from").repartition(3)
    i = spark.createDataFrame(items, "item_id bigint, text string")
    got = leakage.leaked_spans(d, "doc_id", "text", i, "item_id", "text", shard_words=900)
    pairs = {(r["doc"], r["item"]) for r in got.collect()}
    grams = {}
    for k, t in items:
        w = leakage.words_of(t or "")
        for j in range(len(w) - 9):
            grams.setdefault(tuple(w[j : j + 10]), set()).add(k)
    want = set()
    for k, t in docs:
        w = leakage.words_of(t or "")
        for j in range(len(w) - 9):
            want |= {(k, o) for o in grams.get(tuple(w[j : j + 10]), ())}
    assert pairs == want and len(want) > 10
    text = dict(docs)
    for r in got.filter("doc < 500").collect():
        assert leakage.words_of(text[r["doc"]])[r["word_from"] : r["word_to"]] == leakage.words_of(text[r["doc"]][r["char_from"] : r["char_to"]])


def test_empty_tables_and_blocks(spark, monkeypatch):
    d = spark.createDataFrame([(1, "a b c d e f g h i j")], "doc_id bigint, text string")
    i = spark.createDataFrame([(k, "A, b c d e f g h i j") for k in range(5)], "item_id bigint, text string")
    assert leakage.leaked_spans(d.limit(0), "doc_id", "text", i, "item_id", "text").count() == 0
    assert leakage.leaked_spans(d, "doc_id", "text", i.limit(0), "item_id", "text").count() == 0
    monkeypatch.setattr(leakage, "ITEM_BYTES", 40)
    assert leakage.leaked_spans(d, "doc_id", "text", i, "item_id", "text").count() == 5
