"""Ranked search against scoring every document."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from riskloom.llm import lexical
from riskloom.llm.licences import words

DOCS = "doc_id long, text string"
ITEMS = "item_id long, text string"


def terms(text):
    low = (text or "").translate(str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)}))
    return re.findall("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def brute(docs, items, k):
    bags = [(i, terms(t)) for i, t in docs]
    bags = [(i, len(w), Counter(w)) for i, w in bags if w]
    n_docs, total = len(bags), sum(n for _, n, _ in bags)
    df = Counter(t for _, _, c in bags for t in c)
    out = []
    for item, text in set(items):
        scores = []
        for i, n, c in bags:
            m = 75 + (25 * n * n_docs) // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    * ((1000000000 * c[t]) // (1000 * c[t] + 12 * m)) for t in terms(text) if c[t])
            if s > 0:
                scores.append((-s, i is None, i or 0, i))
        out += [(item, r + 1, i, -s) for r, (s, _, _, i) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=str)


def found(spark, docs, items, k=20, parts=3, **more):
    d = spark.createDataFrame(docs, DOCS).withColumn("score", F.lit(1)).withColumn("n", F.lit(2)).repartition(parts)
    q = spark.createDataFrame(items, ITEMS).withColumn("rank", F.lit(3)).withColumn("doc_id", F.lit(4))
    return sorted((tuple(r) for r in lexical.search(d, q, k, **more).select("item_id", "rank", "doc_id", "score").collect()),
                  key=str)


def corpus(n, seed):
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("abcdefg") for _ in range(rng.randint(1, 4))) for _ in range(600)]
    weights = [1 / (1 + i) for i in range(len(vocab))]
    docs = [(i, " ".join(rng.choices(vocab, weights, k=int(rng.expovariate(1 / 40)) + 1))) for i in range(n)]
    items = [(i, " ".join(rng.choices(vocab, weights, k=12))) for i in range(7)]
    return docs, items + [(50, docs[3][1]), (51, "Zz äÖ zz " + vocab[5].upper())]


@pytest.mark.parametrize("room", [1, 8])
def test_search_against_all_scores(spark, room):
    docs, items = corpus(500, 5)
    assert found(spark, docs, items, room=room) == brute(docs, items, 20)


def test_search_of_odd_rows(spark):
    docs, items = corpus(60, 6)
    docs += [(1, None), (2, ""), (3, ".,;"), (None, "abc abc é"), (7, docs[7][1]), (7, docs[7][1]), (None, docs[7][1]),
             (900, "abc " * 300_000), (901, "ÉTÉ abc")] + [(1000 + i, "same words abc") for i in range(40)]
    items += [items[0], (0, "another text abc"), (None, "abc same"), (60, None), (61, ""), (62, "unknownword"), (63, "ABC é")]
    assert found(spark, docs, items) == brute(docs, items, 20)
    assert found(spark, docs, [], 5) == [] == found(spark, [], items, 5)
    assert found(spark, docs[:4], items, 5) == brute(docs[:4], items, 5)


def test_search_in_batches(spark, monkeypatch):
    docs, items = corpus(80, 7)
    monkeypatch.setattr(lexical, "TERMS", 20)
    monkeypatch.setattr(lexical, "SLICE", 50)
    assert found(spark, docs, items, 4) == brute(docs, items, 4)


def test_bounds_and_their_use():
    """No score exceeds its bound, and rescoring stops early."""
    docs, items = corpus(800, 8)
    bags = [Counter(words(t)) for _, t in docs]
    ns = [sum(c.values()) for c in bags]
    df = {t: n for t, n in Counter(t for c in bags for t in c).items()}
    batch = lexical.Batch([Counter(words(t)) for _, t in items], df, len(bags), sum(ns))
    bound = batch.bounds(ns, [lexical.sketch(c) for c in bags])
    skipped = 0
    for i in range(len(items)):
        scores = [batch.score(c, n, i) for c, n in zip(bags, ns)]
        assert all(b >= s for b, s in zip(bound[:, i], scores))
        skipped += sum(bound[:, i] < sorted(scores)[-20])
    assert skipped > 0.5 * len(items) * len(bags)
    assert max(lexical.sketch(Counter({b"x": 70000}))) == 255
