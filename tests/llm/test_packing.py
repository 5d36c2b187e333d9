"""Neighbours of a seed against BM25 written out."""

import math
from collections import Counter

import numpy as np
import pytest

from frostline.llm import packing
from frostline.llm.packing import B, K1, Index, pack


def plain_scores(docs, seed):
    """BM25 of every document for all terms of the seed that several documents have."""
    counts, mean = [Counter(d.tolist()) for d in docs], np.mean([len(d) for d in docs])
    out = []
    for d, c in zip(docs, counts):
        score = 0.0
        for term in set(seed.tolist()):
            n = sum(term in x for x in counts)
            if n > 1 and c[term]:
                rarity = math.log(1 + (len(docs) - n + 0.5) / (n + 0.5))
                score += rarity * c[term] * (K1 + 1) / (c[term] + K1 * (1 - B + B * len(d) / mean))
        out.append(score)
    return out


@pytest.fixture(scope="module")
def docs():
    rng = np.random.default_rng(5)
    return [np.minimum(rng.zipf(1.3, rng.integers(1, 120)), 3000).astype("<u2") for _ in range(300)]


def test_all_terms_of_a_seed_count(docs):
    index = Index(docs)
    for seed in docs[:40]:
        plain = plain_scores(docs, seed)
        assert index.scores(seed) == pytest.approx(plain, rel=1e-9, abs=1e-12)


def test_neighbours_come_best_first(docs, monkeypatch):
    monkeypatch.setattr(packing, "RANKED", 7)  # several turns
    index, unused = Index(docs), np.arange(len(docs)) % 3 > 0
    for seed in docs[:40]:
        score = index.scores(seed)
        there = [d for d in range(len(docs)) if unused[d] and score[d] > 0]
        assert list(index.neighbours(seed, unused)) == sorted(there, key=lambda d: (-score[d], d))


def test_rare_terms_dont_hide_the_others():
    """Sixty terms of two documents, and ten of four: the latter's documents are neighbours too, before one without any."""
    rare, shared, end = np.arange(100, 160), np.arange(200, 210), [2]
    docs = [np.concatenate(x).astype("<u2") for x in ([rare, shared, end], [rare, end], [[300], end], *([shared, [i], end] for i in (301, 302, 303)))]
    docs += [np.array([400 + i, 2], "<u2") for i in range(40)]
    found = list(Index(docs).neighbours(docs[0], np.arange(len(docs)) > 0))
    assert found[:4] == [1, 3, 4, 5]
    assert [d for d, _, _ in next(pack(docs, 168))] == [0, 1, 3, 4, 5]
