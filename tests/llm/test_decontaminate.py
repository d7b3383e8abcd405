"""Short items, ids of any type, periodic texts and reordered passages."""

import random
import time

import pytest

from corpusflow.llm import decontaminate


def _words(rng, n):
    return ["".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(n)]


@pytest.mark.parametrize("rows", [3, 40])
def test_short_items_against_plain_search(spark, rows):
    rng = random.Random(rows)
    docs = [(i, " ".join(rng.choice("abcde") for _ in range(rng.randint(0, 8)))) for i in range(rows)]
    items = [(f"i{k}", " ".join(rng.choice("abcde") for _ in range(1 + k % 4))) for k in range(12)] + [("none", ""), ("null", None)]
    found = decontaminate.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id string, text string"), least_words=1)
    assert dict(found.dtypes)["item_id"] == "string"
    want = {(i, k) for i, d in docs for k, t in items if t and f" {t} " in f" {d} "}
    assert {(r.doc_id, r.item_id) for r in found.collect()} == want


def test_short_items_drop_no_document(spark):
    docs = spark.createDataFrame([(1, "a clean text of some words"), (2, "what is the capital of france"), (3, None)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "clean"), (2, "What is the capital of France?"), (3, None)], "item_id int, text string")
    assert sorted(r.doc_id for r in decontaminate.drop_leaks(docs, bench).collect()) == [1, 3]
    assert {(r.doc_id, r.item_id) for r in decontaminate.leaks(docs, bench, least_words=1).collect()} == {(1, 1), (2, 2)}


@pytest.mark.parametrize("doc, item", [
    ("a " * 20000, "a " * 500),
    (("a " * 399 + "b ") * 50, "a " * 500),
    ("a b c " * 6667, "a b c " * 167),
    ("a " * 300 + "x " + "b a " * 9800, "a b " * 250),
])
def test_periodic_texts_take_under_a_second(doc, item):
    block = decontaminate.Block([(1, item)], 5)
    start = time.monotonic()
    found = list(block.leaks(doc, 0.5))
    assert time.monotonic() - start < 1
    assert found


def test_reordered_sentences_are_found(spark):
    """Each item's sentences, of 3 to 14 words, shuffled inside a document. What is missed has a fifth of its words
    in sentences of under five words."""
    rng = random.Random(4)
    items, docs, excused = [], [], set()
    for k in range(200):
        sentences = [_words(rng, rng.randint(3, 14)) for _ in range(6)]
        items.append((k, ". ".join(" ".join(s) for s in sentences)))
        if sum(len(s) for s in sentences if len(s) < 5) > 0.2 * sum(map(len, sentences)):
            excused.add(k)
        rng.shuffle(sentences)
        docs.append((k, " ".join(_words(rng, 30)) + ". " + ". ".join(" ".join(s) for s in sentences)))
    docs += [(1000 + k, " ".join(_words(rng, 80))) for k in range(100)]
    found = {(r.doc_id, r.item_id) for r in decontaminate.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert found <= {(k, k) for k in range(200)}
    assert {k for k in range(200) if (k, k) not in found} <= excused
    assert len(found) >= 0.85 * 200
