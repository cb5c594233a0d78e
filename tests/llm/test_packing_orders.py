"""Packing: statistics of all documents, and neighbours that stand far apart in the input."""

import random
from collections import Counter, defaultdict

import numpy as np

from lodestone.llm import packing

WORDS = ["".join(random.Random(i).choices("abcdefghijklmnopqrstuvwxyz", k=7)) for i in range(3000)]


def some(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def test_statistics_cover_all_documents(spark):
    rng = random.Random(3)
    texts = [some(rng, rng.randrange(1, 60)) for _ in range(150)] + [None, "", "a a a"]
    stored = packing.encoded(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(7), "byte_bpe_50k.tiktoken")
    idf, mean = packing.corpus_weights(stored)
    ids = [[*packing.encoder("byte_bpe_50k.tiktoken")(t or ""), packing.END] for t in texts]
    df = Counter(x for i in ids for x in set(i))
    assert abs(mean - sum(map(len, ids)) / len(ids)) < 1e-9
    for token in range(len(idf)):
        n = df.get(token, 0)
        want = max(0.0, np.log((len(texts) - n + 0.5) / (n + 0.5))) if n > 1 else 0.0
        assert abs(idf[token] - want) < 1e-9


def test_weighted_minima_follow_common_weight():
    rng = np.random.default_rng(1)
    idf = np.where(rng.random(500) < 0.1, 0.0, rng.random(500) * 6)
    ranks = packing.hash_orders(idf, 3000)
    a, b = np.arange(0, 300), np.arange(100, 400)
    share = idf[100:300].sum() / idf[:400].sum()
    assert abs((ranks[:, a].max(axis=1) == ranks[:, b].max(axis=1)).mean() - share) < 0.04
    assert not ranks[:, idf == 0].any()


def test_copies_meet_wherever_they_stand(spark):
    rng = random.Random(5)
    texts = [some(rng, 40) for _ in range(600)]
    pairs = [(i, 599 - i) for i in range(0, 200, 10)]
    for a, b in pairs:
        texts[b] = texts[a]
    got = defaultdict(set)
    for r in packing.pack(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5, "doc_id"), shard_docs=64).collect():
        got[r["doc_id"]].add(r["sequence_id"])
    assert set(got) == set(range(600))
    assert sum(bool(got[a] & got[b]) for a, b in pairs) >= len(pairs) - 3  # but where a shard or partition ends between them


def test_a_seed_takes_its_best_unused_neighbours():
    rng = random.Random(9)
    texts = [np.array([rng.randrange(40) for _ in range(rng.randrange(1, 30))]) for _ in range(80)]
    at = np.concatenate(([0], np.cumsum([len(x) for x in texts])))
    index = packing.Bm25(np.concatenate(texts), at, np.linspace(0, 3, 40), 12.0)
    sets = [Counter(x.tolist()) for x in texts]

    def plain(seed, doc):
        total = 0.0
        for t in sets[seed]:
            n, w = sets[doc][t], np.linspace(0, 3, 40)[t]
            total += w * n * 2.2 / (n + 1.2 * (0.25 + 0.75 * len(texts[doc]) / 12.0)) if n else 0.0
        return total

    for seed in range(0, 80, 7):
        assert np.allclose(np.delete(index.scores(seed), seed), [plain(seed, d) for d in range(80) if d != seed])
    rows = list(packing.fill(np.diff(at), index, 64))
    first = [r for r in rows if r[3] == 0]
    want = sorted((d for d in range(1, 80)), key=lambda d: (-plain(0, d), d))
    assert [r[0] for r in first][1:] == want[: len(first) - 1]


def test_lists_lose_used_documents(monkeypatch):
    """Seeds read lists without the documents that are used up, and find the same neighbours as in whole lists."""
    rng = random.Random(11)
    texts = [np.array([rng.randrange(60) for _ in range(rng.randrange(1, 50))]) for _ in range(200)]
    at = np.concatenate(([0], np.cumsum([len(x) for x in texts])))
    make = lambda: packing.Bm25(np.concatenate(texts), at, np.linspace(0, 3, 60), 25.0)
    whole, read, scores = make(), [], packing.Bm25.scores
    monkeypatch.setattr(packing.Bm25, "scores", lambda self, seed: read.append(len(self.doc)) or scores(whole, seed))
    want = list(packing.fill(np.diff(at), make(), 64))
    monkeypatch.setattr(packing.Bm25, "scores", scores)
    assert list(packing.fill(np.diff(at), make(), 64)) == want
    assert read == sorted(read, reverse=True) and read[-1] < read[0] / 2
    some = np.arange(200) % 3 == 0
    assert (whole.among(some).scores(0)[some] == whole.scores(0)[some]).all() and not whole.among(some).scores(0)[~some].any()


def test_stored_ids_are_those_of_tokenizers(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = [None, "", " ", "a <|endoftext|> b", "<|endoftext|><|endoftext|>", "<|endoftext", "äöü ß 漢字 \U0001f600‍", "a\x00b\r\n\n  c", "tha " * 3000, "'s're 12³"]
    rows = packing.encoded(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3), "byte_bpe_50k.tiktoken").where("row is not null").collect()
    assert len({r["row"] for r in rows}) == len(texts)
    for r in rows:
        assert np.frombuffer(r["ids"], "<u2").tolist() == [*plain.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids, packing.END]
