"""Lexical retrieval packing: documents share training sequences with their BM25 neighbours.

Texts are encoded once, into a table of the shared folder; BM25's terms are the tokens. Document frequencies and the mean
length are counted over all documents: a number for each token of the vocabulary, however many documents there are.
Documents are then ordered by minima of hashes that weigh each token by its inverse document frequency, so that those
with many rare tokens in common, and all copies, come next to each other wherever they stood in the input. Runs of that
order are the index's shards, each with an inverted index of its own: a seed document fetches its nearest unused
neighbours from its shard, which fill the seed's window, the last of them cut to what is left. A shard's sequences are
full but for its last one. The order is total and is taken from the written table, so a repeated task packs as before.
"""

from __future__ import annotations

import copy
import json
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm.common import mix64, small_batches, table, written

WINDOW = 2048
SHARD_DOCS = 1024
SHARD_TOKENS = 1 << 21
ORDERS = 4
K1, B = 1.2, 0.75
END = 1
STORED = "row long, doc_id long, ids binary, counts binary"
OUT = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


@lru_cache(maxsize=2)
def vocabulary(ranks_file: str, whole_file: str = "byte_bpe_50k.json") -> tuple[Callable[[str], np.ndarray], np.dtype, int]:
    """The ids that tokenizers gives with whole_file and without adding special tokens, their type and their number.

    The ranks file holds the same vocabulary, and tiktoken gives the same ids several times faster. It knows nothing of
    the rules of the tokens that whole_file adds to it, so texts that hold one of their strings go to tokenizers. It is told
    of them only as it hands out arrays by a call that looks for some.
    """
    import base64

    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    with open(public_tokenizers.path(ranks_file), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    with open(public_tokenizers.path(whole_file)) as f:
        extra = json.load(f)["added_tokens"]
    added = [x["content"] for x in extra]
    size = 1 + max(END, *ranks.values(), *(x["id"] for x in extra))
    whole = Tokenizer.from_file(public_tokenizers.path(whole_file))
    fast = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={x["content"]: x["id"] for x in extra})

    def encode(text: str) -> np.ndarray:
        if not added:
            return np.array(fast.encode_ordinary(text), dtype=np.uint32)
        if any(x in text for x in added):
            return np.array(whole.encode(text, add_special_tokens=False).ids, dtype=np.uint32)
        return fast.encode_to_numpy(text, disallowed_special=())

    return encode, np.dtype("<u2" if size <= 1 << 16 else "<u4"), size


def encoder(ranks_file: str) -> Callable[[str], list[int]]:
    encode = vocabulary(ranks_file)[0]
    return lambda text: encode(text).tolist()


def idf_of(n: int, df: np.ndarray) -> np.ndarray:
    return np.log((n - df + 0.5) / (df + 0.5))


class Bm25:
    """An inverted index of a shard; terms whose inverse document frequency isn't positive weigh nothing and are left out.

    idf (by term) and mean are those of all documents; without them the shard's own are taken.
    """

    def __init__(self, terms: np.ndarray, bounds: np.ndarray, idf: np.ndarray | None = None, mean: float | None = None):
        n = len(bounds) - 1
        self.n = n
        length = np.diff(bounds)
        order = np.argsort(terms, kind="stable")  # a term's documents stay in order
        t, d = terms[order], np.repeat(np.arange(n, dtype=np.int32), length)[order]
        new = np.ones(len(t), bool)
        new[1:] = (t[1:] != t[:-1]) | (d[1:] != d[:-1])
        first = np.flatnonzero(new)
        tf = np.diff(np.append(first, len(t)))
        t, d = t[first], d[first]
        head = np.ones(len(t), bool)
        head[1:] = t[1:] != t[:-1]
        at = np.flatnonzero(head)
        df = np.diff(np.append(at, len(t)))
        weight = idf_of(n, df) if idf is None else idf[t[at]]
        mean = max(1.0, length.mean() if n else 1.0) if mean is None else mean
        term = np.cumsum(head) - 1
        use = (weight[term] > 0) & (df[term] > 1) if len(term) else np.zeros(0, bool)
        d, tf, term = d[use], tf[use], term[use]
        self.doc = d
        self.weight = weight[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length[d] / mean))
        kept, self.term = np.unique(term, return_inverse=True)
        self.start = np.searchsorted(self.term, np.arange(len(kept) + 1))
        by_doc = np.argsort(d, kind="stable")
        self.terms_of = self.term[by_doc]
        self.doc_at = np.searchsorted(d[by_doc], np.arange(n + 1))

    def among(self, open_: np.ndarray) -> Bm25:
        """The index with open documents only in its lists; their scores for any seed stay the same."""
        out, use = copy.copy(self), open_[self.doc]
        out.doc, out.weight = self.doc[use], self.weight[use]
        out.start = np.concatenate(([0], np.cumsum(use)))[self.start]
        return out

    def scores(self, seed: int) -> np.ndarray:
        """Of every document for all of the seed's terms."""
        q = self.terms_of[self.doc_at[seed] : self.doc_at[seed + 1]]
        lo, n = self.start[q], self.start[q + 1] - self.start[q]
        if not n.sum():
            return np.zeros(self.n)
        at = np.repeat(lo - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
        return np.bincount(self.doc[at], weights=self.weight[at], minlength=self.n)


def fill(sizes: np.ndarray, index: Bm25, window: int = WINDOW) -> Iterator[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of each piece of a shard; every token lies in exactly one."""
    n = len(sizes)
    done = np.zeros(n, dtype=np.int64)
    open_ = np.ones(n, bool)
    listed = n
    sequence = 0
    for seed in range(n):
        if not open_[seed]:
            continue
        while sizes[seed] - done[seed] >= window:
            yield seed, int(done[seed]), window, sequence, 0
            done[seed] += window
            sequence += 1
        open_[seed] = False
        used = int(sizes[seed] - done[seed])
        if not used:
            continue
        yield seed, int(done[seed]), used, sequence, 0
        rest = np.flatnonzero(open_)
        if len(rest):
            if len(rest) < 0.8 * listed:  # lists are read by every seed to come
                index, listed = index.among(open_), len(rest)
            near = rest[np.argsort(-index.scores(seed)[rest], kind="stable")]
            for doc in near:
                size = int(min(sizes[doc] - done[doc], window - used))
                yield int(doc), int(done[doc]), size, sequence, used
                done[doc] += size
                used += size
                open_[doc] = done[doc] < sizes[doc]
                if used == window:
                    break
        sequence += 1


def encoded(docs: DataFrame, ranks_file: str) -> DataFrame:
    """Write each row's ids, closing token included, as 16 or 32 bits by the vocabulary's size; row numbers the rows.

    Each task adds a row of its own: in counts the number of its documents and of their tokens, then how many of its
    documents hold each token.
    """
    small_batches(docs.sparkSession)
    names = [x.split()[0] for x in STORED.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, kind, size = vocabulary(ranks_file)
        row, tokens = TaskContext.get().partitionId() << 40, 0
        first, df, last, end = row, np.zeros(size, dtype=np.int64), np.zeros(size, dtype=np.int32), np.array([END], dtype=np.uint32)
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            ids = [encode(t or "") for t in batch.column(1).to_pylist()]
            at = np.concatenate(([0], np.cumsum([len(x) + 1 for x in ids])))
            flat = np.concatenate([part for x in ids for part in (x, end)])
            if at[-1] * kind.itemsize >= 1 << 31:
                raise ValueError("the ids of a batch exceed 2 GB")
            places, every = flat.astype(np.intp), np.arange(at[-1], dtype=np.int32)
            for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):  # of a document's equal tokens that counts which is written last
                x, i = places[a:b], every[a:b]
                last[x] = i
                df[x[last[x] == i]] += 1
            tokens += len(flat)
            stored = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer((at * kind.itemsize).astype(np.int32)), pa.py_buffer(flat.astype(kind))])
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(row, row + n)), batch.column(0), stored, pa.nulls(n, pa.binary())], names)
            row += n
        if row > first:
            yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.array([np.concatenate(([row - first, tokens], df)).tobytes()], pa.binary())], names)

    return written(docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text").mapInArrow(run, STORED), "packing-ids")


def corpus_weights(stored: DataFrame) -> tuple[np.ndarray, float]:
    """Each token's inverse document frequency in all documents (0 where it can't tell them apart), and the mean length."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for x in batch.column(0).to_pylist():
                v = np.frombuffer(x, dtype=np.int64)
                total = v if total is None else total + v
        if total is not None:
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at]), pa.array(np.full(len(at), len(total)))], ["at", "n", "size"])

    rows = stored.where("counts is not null").select("counts").mapInArrow(add, "at long, n long, size long").groupBy("at").agg(F.sum("n").alias("n"), F.max("size").alias("size")).collect()
    total = np.zeros(max((r["size"] for r in rows), default=2), dtype=np.int64)
    for r in rows:
        total[r["at"]] = r["n"]
    n, tokens, df = int(total[0]), int(total[1]), total[2:]
    return np.where(df > 1, np.maximum(idf_of(n, df), 0), 0), max(1.0, tokens / max(1, n))


def hash_orders(idf: np.ndarray, orders: int = ORDERS) -> np.ndarray:
    """Ranks of the tokens in random orders where those of high weight tend to come first; 0 for tokens without weight.

    The chance that two sets have the same highest rank is the share of their common weight.
    """
    out = np.zeros((orders, len(idf)), dtype=np.int32)
    use = np.flatnonzero(idf > 0)
    for i in range(orders):
        u = (mix64(use.astype(np.uint64) + np.uint64((i + 1) << 32)) >> np.uint64(11)).astype(np.float64) + 0.5
        out[i, use[np.argsort(np.log(u / (1 << 53)) / idf[use], kind="stable")]] = np.arange(1, len(use) + 1)
    return out


def pack(docs: DataFrame, window: int = WINDOW, shard_docs: int = SHARD_DOCS, shard_tokens: int = SHARD_TOKENS, ranks_file: str = "byte_bpe_50k.tiktoken") -> DataFrame:
    """A row per piece of docs (doc_id, text, ...), in OUT's columns.

    Null and empty texts have one id, the end. Rows with null or equal doc_ids are packed each by itself. An empty table
    gives no rows. Other columns are ignored. A document longer than a shard makes one alone.
    """
    stored = encoded(docs, ranks_file)
    idf, mean = corpus_weights(stored)
    ranks = hash_orders(idf)
    kind = np.dtype("<u2") if len(idf) <= 1 << 16 else np.dtype("<u4")
    keys = [f"k{i}" for i in range(len(ranks))]
    names = [x.split()[0] for x in OUT.split(", ")]

    def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        _, bounds, data = column.buffers()
        at = np.frombuffer(bounds, dtype=np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
        return np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]].view(kind), (at - at[0]) // kind.itemsize

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                ids, at = flat(batch.column(2))
                yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(np.maximum.reduceat(r[ids], at[:-1])) for r in ranks)], ["row", "doc_id", "ids", *keys])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = TaskContext.get().partitionId(), 0

        def shard(docs: list, ids: list[np.ndarray]) -> pa.RecordBatch:
            nonlocal made
            sizes = np.array([len(x) for x in ids], dtype=np.int64)
            index = Bm25(np.concatenate(ids), np.concatenate(([0], np.cumsum(sizes))), idf, mean)
            rows = list(fill(sizes, index, window))
            out = [(docs[d], a, n, zlib.crc32(ids[d][a : a + n].astype("<u4").tobytes()), int(sizes[d]), (part << 32) + made + s, o) for d, a, n, s, o in rows]
            made += 1 + max((r[3] for r in rows), default=-1)
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names)

        held, ids, tokens = [], [], 0
        for batch in batches:
            for doc, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                x = np.frombuffer(x, dtype=kind)
                if held and (len(held) >= shard_docs or tokens + len(x) > shard_tokens):
                    yield shard(held, ids)
                    held, ids, tokens = [], [], 0
                held.append(doc)
                ids.append(x)
                tokens += len(x)
        if held:
            yield shard(held, ids)

    found = stored.where("row is not null").select("row", "doc_id", "ids").mapInArrow(key, ", ".join(["row long, doc_id long, ids binary", *(f"{k} int" for k in keys)]))
    return found.repartitionByRange(*keys, "row").sortWithinPartitions(*keys, "row").select("doc_id", "ids").mapInArrow(run, OUT)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


QUERIES = {"op10_packing": op10_packing}
ORACLE: dict[str, str] = {}
