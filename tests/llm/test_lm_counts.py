"""The model holds every n-gram of its text: scores against a dictionary model."""

import math
import random
from collections import Counter, defaultdict

from lodestone.llm import lm_trie


def brute(train, texts):
    counts = [Counter() for _ in range(3)]
    for t in train:
        w = [*t.split(), "</s>"]
        for i in range(len(w)):
            counts[0][w[i],] += 1
            counts[1][w[i - 1] if i else "</s>", w[i]] += 1
            if i:
                counts[2][w[i - 2] if i > 1 else "</s>", w[i - 1], w[i]] += 1
    used = defaultdict(float)
    for k in (1, 2):
        for g, c in counts[k].items():
            used[g[:-1]] += (c - lm_trie.DISCOUNT) / counts[k - 1][g[:-1]]
    total = sum(counts[0].values())
    out = []
    for t in texts:
        w, score = [*t.split(), "</s>"], 0.0
        for i in range(len(w)):
            p = (counts[0][w[i],] + 1) / (total + len(counts[0]) + 1)
            grams = [(w[i - 1] if i else "</s>", w[i])] + ([(w[i - 2] if i > 1 else "</s>", w[i - 1], w[i])] if i else [])
            for k, g in enumerate(grams, 1):
                if g[:-1] in used:
                    c = counts[k][g]
                    p = (1 - used[g[:-1]]) * p + ((c - lm_trie.DISCOUNT) / counts[k - 1][g[:-1]] if c else 0)
            score += math.log10(p)
        out.append(score)
    return out


def test_ngrams_seen_once_count(spark):
    r = random.Random(3)
    texts = [" ".join(f"w{int(r.paretovariate(0.7)) % 60}" for _ in range(r.randrange(1, 40))) for _ in range(80)]
    frame = lambda x: spark.createDataFrame(list(enumerate(x)), "doc_id long, text string")
    got = {x["doc_id"]: x for x in lm_trie.score(frame(texts), lm_trie.train(frame(texts[:50]))).collect()}
    for d, want in enumerate(brute(texts[:50], texts)):
        assert abs(got[d]["score"] - want) < 1e-3 * got[d]["n_tokens"]
    pruned = lm_trie.score(frame(texts), lm_trie.train(frame(texts[:50]), least=2)).collect()
    assert any(abs(x["score"] - got[x["doc_id"]]["score"]) > 0.1 for x in pruned)
