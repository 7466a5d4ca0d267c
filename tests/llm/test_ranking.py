"""Ranked search against a brute-force version."""

import collections
import math
import random
import re
import string

import numpy as np
import pytest

from pagemill.llm import ranking
from pagemill.llm.ranking import rank_documents

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def ranked_by_hand(documents, items, k=10):
    docs = [(d, collections.Counter(TERM.findall((t or "").translate(LOWER)))) for d, t in documents]
    lengths = [sum(c.values()) for _, c in docs]
    n, total = sum(x > 0 for x in lengths), sum(lengths)
    df = collections.Counter(t for _, c in docs for t in c)
    answer = []
    for item, text in sorted(set(items), key=str):
        terms = TERM.findall((text or "").translate(LOWER))
        scores = []
        for (doc, held), length in zip(docs, lengths, strict=True):
            m = 25 + 75 * length * n // max(total, 1)
            score = 0
            for term in terms:
                if tf := held[term]:
                    score += math.floor(1000 * math.log((2 * n + 2) / (2 * df[term] + 1))) * (
                        10**9 * tf // (1000 * tf + 8 * m)
                    )
            if score:
                scores.append((-score, doc is not None, doc or 0, doc))
        scores.sort()
        answer += [(item, rank, s[3], -s[0]) for rank, s in enumerate(scores[:k], 1)]
    return sorted(answer, key=str)


def collected(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


def nasty(seed=2):
    rng = random.Random(seed)
    words = ["Alpha", "beta", "GAMMA", "Ünï", "ünï", "中文", "x1", "0", "É", "delta"] + [f"w{n}" for n in range(60)]
    text = lambda n: "".join(rng.choice(words) + rng.choice([" ", "\n", "-", "!?", "_", "\x7f"]) for _ in range(n))
    documents = [(n, text(rng.choice([0, 1, 5, 30]))) for n in range(300)]
    documents += [(1000 + n, "beta beta gamma") for n in range(40)]
    documents += [(None, "alpha beta"), (None, "alpha beta"), (7, None), (8, ""), (9, " !? "), (2000, text(30_000))]
    documents += [documents[3], (3, "another text w1 w2 w3")]
    items = [(n, text(rng.randint(0, 12))) for n in range(30)]
    items += [items[4], (5, "same id other text beta"), (None, "alpha beta gamma"), (50, None), (51, ""), (52, "Nowhere")]
    return documents, [*items, (53, "beta " * 5000 + text(3000))]


@pytest.mark.parametrize("small", [False, True])
def test_ranking_equals_brute_force(spark, monkeypatch, small):
    if small:
        for name, size in {"BLOCK_TERMS": 640, "ITEM_TILE": 8, "VOCABULARY_TILE": 16, "ROW_TILE": 32}.items():
            monkeypatch.setattr(ranking, name, size)
    documents, items = nasty()
    left = spark.createDataFrame([(*r, 1, "x") for r in documents], "doc_id bigint, text string, n int, terms string")
    right = spark.createDataFrame([(*r, 1, 2) for r in items], "item_id bigint, text string, item int, doc_id int")
    found = rank_documents(left.repartition(3), right)
    assert collected(found) == ranked_by_hand(documents, items)


def test_empty_tables_and_a_cut_of_one(spark):
    documents, items = nasty()
    left = spark.createDataFrame(documents, "doc_id bigint, text string")
    right = spark.createDataFrame(items[:3], "item_id bigint, text string")
    assert collected(rank_documents(left.limit(0), right)) == []
    assert collected(rank_documents(left, right.limit(0))) == []
    assert collected(rank_documents(left, right, k=1)) == ranked_by_hand(documents, items[:3], k=1)


def test_vocabulary_tiles_keep_partial_sums_exact():
    rng = np.random.default_rng(4)
    terms = np.sort(rng.integers(0, 500, 4000))
    items = rng.integers(0, 20, 4000)
    pairs = np.unique(terms * 20 + items)
    terms, items = pairs // 20, pairs % 20
    weights = rng.integers(1, 2 * 10**9, len(terms))
    weights[::97] = 10**11
    seen = 0
    for begin, end in ranking._vocabulary_tiles(terms, items, weights, 20):
        assert begin == seen and end > begin
        inside = (terms >= begin) & (terms < end)
        sums = np.bincount(items[inside], weights[inside].astype(float) * ranking.MOST_IMPACT, 20)
        assert end == begin + 1 or sums.max() < ranking.EXACT
        seen = end
    assert seen == terms[-1] + 1


def test_heavy_terms_are_summed_as_whole_numbers(spark):
    documents = [(1, "rare common"), (2, "common common other"), (3, "other")]
    items = [(1, "rare " * 400_000 + "common " * 3)]
    df = spark.createDataFrame(documents, "doc_id bigint, text string")
    assert collected(rank_documents(df, spark.createDataFrame(items, "item_id bigint, text string"))) == ranked_by_hand(documents, items)
