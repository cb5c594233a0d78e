import numpy as np
import pyarrow as pa

from lodestone.llm import lm_trie


def test_select_in_word():
    rng = np.random.default_rng(3)
    for w in [1, 1 << 63, (1 << 64) - 1, *(int(x) for x in rng.integers(1, 1 << 63, 200, dtype=np.uint64))]:
        ones = [i for i in range(64) if w >> i & 1]
        assert lm_trie.select_in_word(np.full(len(ones), w, np.uint64), np.arange(len(ones))).tolist() == ones


def test_level_searches_each_key_once_and_in_order(tmp_path, monkeypatch):
    """Whatever the order and the repeats of a batch's keys, a shard is asked for each once, in order."""
    rng = np.random.default_rng(4)
    keys, shards = np.unique(rng.integers(0, 1 << 40, 5000, dtype=np.uint64)), []
    for i, part in enumerate(np.array_split(keys, 3)):
        arrays, info = lm_trie.pack_sequence(part, "key")
        lm_trie.write_shard(f"file:{tmp_path}/{i}", arrays, {"key": info})
        shards.append({"uri": f"file:{tmp_path}/{i}", "first": int(part[0]), "n": len(part), "mass": len(part)})
    level, asked, find = lm_trie.Level({"shards": shards}), [], lm_trie.Sequence.find
    monkeypatch.setattr(lm_trie.Sequence, "find", lambda self, x: asked.append(x) or find(self, x))
    batch = rng.choice(np.concatenate([keys, rng.integers(0, 1 << 41, 3000, dtype=np.uint64), keys[:1] - np.uint64(1)]), 20000)
    place = {int(k): i for i, k in enumerate(keys)}
    assert level.find(batch).tolist() == [place.get(int(x), -1) for x in batch]
    assert all((x[1:] > x[:-1]).all() for x in asked)
    assert level.find(keys[:0]).tolist() == []


def test_distinct_keys_of_any_size():
    rng = np.random.default_rng(5)
    near = (rng.integers(0, 40, 5000, dtype=np.uint64) << np.uint64(57)) + rng.integers(0, 9, 5000, dtype=np.uint64)  # these differ in bits that the first sort drops
    for keys in (near, rng.integers(0, 50, 3000, dtype=np.uint64), near[:1], near[:0], rng.integers(0, 1 << 64, 4000, dtype=np.uint64)):
        some, place = lm_trie.distinct(keys)
        assert keys[some].tolist() == sorted(set(keys.tolist())) and (keys[some][place] == keys).all()


def test_batches_share_their_searches(spark, monkeypatch):
    """N-grams that occur in many batches of a task are searched once."""
    texts = ["a b c a b d", "b c a", None, "", "d d d d e"]
    model = lm_trie.train(spark.createDataFrame(list(enumerate(texts[:4])), "doc_id long, text string"))
    asked, find = [], lm_trie.Sequence.find
    monkeypatch.setattr(lm_trie.Sequence, "find", lambda self, x: asked.extend((id(self), y) for y in x.tolist()) or find(self, x))
    run = lm_trie._scored(model["uri"], model["tokens"], model["words"])
    batches = [pa.RecordBatch.from_arrays([pa.array([i]), pa.array([t], pa.string())], ["doc_id", "text"]) for i, t in enumerate(texts * 20)]
    got = [r for b in run(iter(batches)) for r in b.to_pylist()]
    assert [r["doc_id"] for r in got] == list(range(100)) and asked and len(asked) == len(set(asked))
    for r in got:
        assert (r["n_tokens"], r["score"]) == (got[r["doc_id"] % 5]["n_tokens"], got[r["doc_id"] % 5]["score"])
