"""SentencePiece encoding and decoding over a relational lattice.

A text is escaped as the library does it (a leading and every space as U+2581) and falls into words that no piece spans.
Distinct words explode into their substrings of bounded length, an equi-join to the piece table (a vocabulary file, some
tens of thousands of rows) leaves the lattice's edges, and edges grouped by word are folded with a higher-order
aggregate. For unigram models the fold is Viterbi's. The given model is BPE, whose ids no sum of scores yields: there the
fold merges the adjacent pair of the best score, leftmost of ties, until no edge spans two neighbours. A word's cuts are
the bits of one number and an edge is one number, so a step of the fold is a few integer operations an edge.

Words go by 64-bit hashes. Their ids go into shard files in the shared folder, mapped by the tasks that write texts' ids.
Characters outside of the vocabulary become byte pieces.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm.common import hash_spans, let, open_in, ragged, scratch, small_batches, store_map, store_put, table, text_bytes, tidy, trimmed_heap, wide_batches

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
SHARD_CHARS = 4 << 20
LEAST_SHARDS = 16
#: Words whose hashes a task remembers, so as to hand each on once; 8 bytes each.
SEEN = 4_000_000
#: Groups that the grouping of edges holds in memory before it sorts; about 600 bytes each.
GROUPS = "spark.sql.objectHashAggregate.sortBased.fallbackThreshold"
HELD_GROUPS = 1 << 18


@lru_cache(maxsize=2)
def processor(model: str):
    import public_tokenizers
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(model))


def ordinary(model: str) -> list[tuple[str, int, float]]:
    """(piece, id, score) of a model's ordinary pieces; spaces are spaces."""
    sp = processor(model)
    return [(sp.id_to_piece(i).replace(SPACE, " "), i, float(sp.get_score(i))) for i in range(sp.vocab_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]


def piece_table(spark: SparkSession, model: str = MODEL) -> tuple[DataFrame, int]:
    """(piece, id, score, code) of a model's ordinary pieces, and the longest one's length. code: see coded_edges; equal scores share a place."""
    rows = ordinary(model)
    place = {score: i for i, score in enumerate(sorted({x[2] for x in rows}, reverse=True))}
    return spark.createDataFrame([(p, i, x, place[x] << 28 | i << 12) for p, i, x in rows], "piece string, id int, score double, code long"), max(len(p) for p, _, _ in rows)


@lru_cache(maxsize=2)
def letter_ids(model: str) -> np.ndarray:
    """The id of each code point's piece, -1 without one."""
    out = np.full(0x110000, -1, np.int32)
    for p, i, _ in ordinary(model):
        if len(p) == 1:
            out[ord(p)] = i
    return out


def lattice(words: DataFrame, pieces: DataFrame, longest: int) -> DataFrame:
    """words (shard, word) with their edges: structs of start, end, id and score; id is null where a character has no piece."""
    starts = words.select("shard", "word", F.explode(F.sequence(F.lit(0), F.length("word") - 1)).alias("s"))
    subs = starts.select("shard", "word", "s", F.explode(F.sequence(F.lit(1), F.least(F.lit(longest), F.length("word") - F.col("s")))).alias("n"))
    subs = subs.withColumn("piece", F.substring(F.col("word"), F.col("s") + 1, F.col("n")))
    met = subs.join(F.broadcast(pieces), "piece", "left").filter(F.col("id").isNotNull() | (F.col("n") == 1))
    return met.groupBy("shard", "word").agg(F.collect_list(F.struct(F.col("s"), (F.col("s") + F.col("n")).alias("e"), "id", "score")).alias("edges"))


def coded_edges(words: DataFrame, pieces: DataFrame, longest: int) -> DataFrame:
    """words (shard, h, word) with the edges over two characters and more; those of over LONG_WORD characters get none.

    An edge is a bigint: the piece's place by falling score, its id (16 bits), start and end (6 bits each); sorted, the
    one to merge first comes first. Every word has the edge -1, too. A start's substrings are as long as the longest
    piece with the same two first characters.
    """
    many = F.broadcast(pieces.filter(F.length("piece") > 1))
    reach = many.groupBy(F.substring("piece", 1, 2).alias("two")).agg(F.max(F.length("piece")).alias("most"))
    m = F.length("word")
    starts = words.select("shard", "h", "word", m.alias("m"), F.explode(F.sequence(F.lit(0), F.when(m <= LONG_WORD, F.greatest(m - 2, F.lit(0))).otherwise(0))).alias("s"))
    starts = starts.withColumn("two", F.substring(F.col("word"), F.col("s") + 1, F.lit(2))).join(F.broadcast(reach), "two", "left").filter((F.col("s") == 0) | F.col("most").isNotNull())
    most = F.when(F.col("m") <= LONG_WORD, F.greatest(F.least(F.least("most", F.lit(longest)), F.col("m") - F.col("s")), F.lit(1))).otherwise(1)
    subs = starts.select("*", F.explode(F.sequence(F.when(F.col("s") == 0, 1).otherwise(2), F.coalesce(most, F.lit(1)))).alias("n"))
    subs = subs.select("shard", "h", "word", "s", "n", F.substring(F.col("word"), F.col("s") + 1, F.col("n")).alias("piece"))
    met = subs.join(many.select("piece", "code"), "piece", "left").filter(F.col("code").isNotNull() | (F.col("n") == 1))
    edge = F.when(F.col("code").isNull(), F.lit(-1).cast("long")).otherwise(F.expr("code | shiftleft(cast(s as bigint), 6) | (s + n)"))
    return met.groupBy("shard", "h", "word").agg(F.array_sort(F.collect_list(edge)).alias("edges"))


def merged_cuts(edges: Column, n: Column) -> Column:
    """Byte-pair encoding as a fold: a bit for each cut that is left when the best edge over two neighbours is merged, again and again.

    edges: structs of ends (the bits at an edge's ends) and inner (those between), best first. An edge spans two
    neighbours if both ends and just one inner bit are cuts. The number is negative (its bits flipped) once none does.
    """
    one = F.lit(1).cast("long")
    whole = F.call_function("shiftleft", one, n + 1) - 1

    def step(cuts: Column, _: Column) -> Column:
        fits = lambda x: (cuts.bitwiseAND(x["ends"]) == x["ends"]) & (F.bit_count(cuts.bitwiseAND(x["inner"])) == 1)
        best = F.aggregate(edges, F.lit(0).cast("long"), lambda a, x: F.when(a != 0, a).when(fits(x), x["inner"]).otherwise(a))
        return F.when(cuts < 0, cuts).otherwise(let(best, lambda b: F.when(b == 0, F.bitwise_not(cuts)).otherwise(cuts.bitwiseAND(F.bitwise_not(b)))))

    return let(F.aggregate(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), whole, step), lambda c: F.when(c < 0, F.bitwise_not(c)).otherwise(c))


def merged_pieces(words: DataFrame, pieces: DataFrame, longest: int) -> DataFrame:
    """(shard, h, word, cuts, chosen) of words (shard, h, word): the cuts' bits, and start << 16 | id of the pieces of two characters and more; no cuts for words of over LONG_WORD characters."""
    got = coded_edges(words, pieces, longest)
    bit = lambda x: F.call_function("shiftleft", F.lit(1).cast("long"), x.cast("int"))
    s, e = lambda x: F.shiftright(x, 6).bitwiseAND(F.lit(63)), lambda x: x.bitwiseAND(F.lit(63))
    as_bits = lambda x: F.struct((bit(s(x)) + bit(e(x))).alias("ends"), (bit(e(x)) - bit(s(x) + 1)).alias("inner"), F.shiftleft(s(x), 16).bitwiseOR(F.shiftright(x, 12).bitwiseAND(F.lit(65535))).alias("at"))
    n = F.length("word")

    def body(edges: Column) -> Column:
        def of(cuts: Column) -> Column:
            left = F.filter(edges, lambda x: (cuts.bitwiseAND(x["ends"]) == x["ends"]) & (cuts.bitwiseAND(x["inner"]) == 0))
            return F.struct(cuts.alias("cuts"), F.transform(left, lambda x: x["at"]).alias("chosen"))

        return let(merged_cuts(edges, n), of)

    many = F.transform(F.filter("edges", lambda x: x >= 0), as_bits)
    return got.select("shard", "h", "word", F.when(n <= LONG_WORD, let(many, body)).alias("x")).select("shard", "h", "word", "x.cuts", "x.chosen")


def viterbi_cuts(edges: Column, n: Column, unknown: float = -100.0) -> Column:
    """The cuts of the path of the largest sum of scores; of equal ones, that whose last piece is longest."""
    start = F.array(F.struct(F.lit(0.0).alias("v"), F.array(F.lit(0)).alias("cuts")))

    def step(best: Column, end: Column) -> Column:
        into = F.filter(edges, lambda x: x["e"] == end)
        ways = F.transform(into, lambda x: F.struct((F.get(best, x["s"])["v"] + F.coalesce(x["score"], F.lit(unknown))).alias("v"), (-x["s"]).alias("l"), F.concat(F.get(best, x["s"])["cuts"], F.array(end)).alias("cuts")))
        return F.concat(best, F.array(F.transform(F.array(F.array_max(ways)), lambda w: F.struct(w["v"].alias("v"), w["cuts"].alias("cuts")))[0]))

    return F.element_at(F.aggregate(F.sequence(F.lit(1), n), start, step), -1)["cuts"]


def word_pieces(words: DataFrame, pieces: DataFrame, longest: int) -> DataFrame:
    """(shard, word, cuts, ids) of words (shard, word) under a unigram model: ids of the pieces between the cuts, null for a character without one."""
    got = lattice(words, pieces, longest).withColumn("cuts", viterbi_cuts(F.col("edges"), F.length("word")))
    # edges as a map from start and end, so that a path's ids are looked up in one pass
    chosen = F.filter("edges", lambda x: (F.array_position("cuts", x["s"]) > 0) & (F.get("cuts", F.array_position("cuts", x["s"]).cast("int")) == x["e"]))
    ids = F.transform(F.array_sort(F.transform(chosen, lambda x: F.struct(x["s"].alias("s"), x["id"].alias("id")))), lambda x: x["id"])
    return got.select("shard", "word", "cuts", ids.alias("ids"))


#: The fold keeps a word's cuts in one number, and takes time with the square of its length: longer words than this (no natural ones) are merged by a heap.
LONG_WORD = 60


def heap_ids(word: str, pieces: dict[str, tuple[int, float]]) -> list[tuple[int | None, str]]:
    """(id, piece) as the fold gives them, in n log n: the best-scored pair of neighbours merges first, leftmost of ties; no id for a character without a piece."""
    n = len(word)
    after, before, end = [*range(1, n + 1)], [*range(-1, n - 1)], [*range(1, n + 1)]
    alive, heap = [True] * n, []

    def offer(i: int) -> None:
        j = after[i]
        if j < n and (got := pieces.get(word[i : end[j]])):
            heapq.heappush(heap, (-got[1], i, j, end[j]))

    for i in range(n):
        offer(i)
    while heap:
        _, i, j, e = heapq.heappop(heap)
        if not (alive[i] and j < n and alive[j] and after[i] == j and end[j] == e):
            continue
        alive[j], end[i], after[i] = False, e, after[j]
        if after[i] < n:
            before[after[i]] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    out, i = [], 0
    while i < n:
        got = pieces.get(word[i : end[i]])
        out.append((got[0] if got else None, word[i : end[i]]))
        i = end[i]
    return out


def units(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, bounds of words in them, bounds of texts among words): words tile their text, escaped with a space for U+2581.

    A word is spaces with what follows them up to the next space or control character, or one control character.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if pc.any(pc.match_substring(texts, SPACE)).as_py():
        texts = pc.replace_substring(texts, SPACE, " ")
    raw, at = text_bytes(texts)
    full = np.diff(at) > 0
    raw = np.insert(raw, at[:-1][full], 32)
    at = at + np.concatenate(([0], np.cumsum(full)))
    if not len(raw):
        return raw, np.zeros(1, np.int64), np.zeros(len(at), np.int64)
    control, space = raw < 32, raw == 32
    start = control.copy()
    start[1:] |= control[:-1] | space[1:] & ~space[:-1]
    start[at[:-1][full]] = True
    starts = np.flatnonzero(start)
    return raw, np.append(starts, len(raw)), np.searchsorted(starts, at)


def _shard(h: np.ndarray, shards: int) -> np.ndarray:
    return ((h >> np.uint64(33)) % np.uint64(shards)).astype(np.int32)


def word_ids(words: list[str], cuts: np.ndarray, chosen: pa.ListArray, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all words one after the other, how many each word has) from merged_pieces' columns."""
    points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    sizes = np.array([len(w) for w in words], np.int64)
    begin = np.cumsum(sizes) - sizes
    place = np.arange(len(points)) - np.repeat(begin, sizes)
    ids = letters[points]
    many = chosen.flatten().to_numpy(zero_copy_only=False)
    owner = np.repeat(begin, np.diff(chosen.offsets.to_numpy()))
    cut = (np.repeat(cuts, sizes) >> place & 1).astype(bool)
    ids[owner + (many >> 16)] = many & 65535
    count = cut.astype(np.int64)
    unknown = np.flatnonzero(cut & (ids < 0))
    for i in unknown:
        count[i] = len(chr(points[i]).encode())
    out = np.repeat(np.where(cut, ids, 0), count)
    first = np.cumsum(count) - count
    for i in unknown:  # byte pieces
        out[first[i] : first[i] + count[i]] = [3 + x for x in chr(points[i]).encode()]
    return out.astype("<u2"), np.add.reduceat(count, begin) if len(begin) else count


def dictionary(docs: DataFrame, text: str = "text", model: str = MODEL) -> str:
    """Encode the distinct words of docs into shard files; the name of a file that lists them. A task hands each word on once."""
    spark = docs.sparkSession
    small_batches(spark)
    chars = docs.agg(F.sum(F.length(text))).first()[0] or 0
    shards = max(LEAST_SHARDS, -(-chars // SHARD_CHARS))
    pieces, longest = piece_table(spark, model)
    folder = scratch(spark, "pieces")

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(0, np.uint64)
        for batch in batches:
            raw, bounds, _ = units(batch.column(0))
            h = hash_spans(raw, bounds[:-1], bounds[1:])
            first = np.flatnonzero(~pd.Series(h).duplicated().to_numpy())
            at = np.searchsorted(seen, h[first])
            fresh = first if not len(seen) else first[seen[np.minimum(at, len(seen) - 1)] != h[first]]
            if not len(fresh):
                continue
            seen = np.sort(np.concatenate((seen if len(seen) < SEEN else seen[:0], h[fresh])))
            strings = pa.Array.from_buffers(pa.large_string(), len(bounds) - 1, [None, pa.py_buffer(bounds.astype(np.int64).tobytes()), pa.py_buffer(raw.tobytes())]).take(pa.array(fresh)).cast(pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(_shard(h[fresh], shards)), pa.array(h[fresh].view(np.int64)), strings], ["shard", "h", "word"])
        trimmed_heap()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, names = letter_ids(model), None
        by: dict[int, tuple[list, list, list]] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            shard, h, words = batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64), batch.column(2).to_pylist()
            long = batch.column(3).is_null().to_numpy(zero_copy_only=False)
            ids, sizes = word_ids([w for w, x in zip(words, long, strict=True) if not x], batch.column(3).drop_null().to_numpy(), batch.column(4).filter(pa.array(~long)), letters)
            if long.any():
                names = names or {p: (i, x) for p, i, x in ordinary(model)}
                rows = [[y for i, c in heap_ids(w, names) for y in ([i] if i is not None else [3 + x for x in c.encode()])] for w, x in zip(words, long, strict=True) if x]
                ids, sizes = np.concatenate([ids, *(np.array(r, "<u2") for r in rows)]), np.concatenate([sizes, [len(r) for r in rows]])
                order = np.concatenate((np.flatnonzero(~long), np.flatnonzero(long)))
                shard, h = shard[order], h[order]
            begin = np.cumsum(sizes) - sizes
            for s in np.unique(shard):
                sel = np.flatnonzero(shard == s)
                for part, x in zip(by.setdefault(int(s), ([], [], [])), (h[sel], sizes[sel], ids[ragged(begin[sel], sizes[sel])]), strict=True):
                    part.append(x)
        lines = []
        for s, parts in by.items():
            h, sizes, ids = (np.concatenate(x) for x in parts)
            order = np.argsort(h)
            ids = ids[ragged((np.cumsum(sizes) - sizes)[order], sizes[order])]
            uri = f"{folder}/{s}-{np.random.default_rng().integers(1 << 62):x}"
            store_put(uri, h[order].astype("<u8").tobytes() + np.concatenate(([0], np.cumsum(sizes[order]))).astype("<u8").tobytes() + ids.tobytes())
            lines.append((s, uri, len(h)))
        trimmed_heap()
        yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in lines], k) for i, k in enumerate((pa.int32(), pa.string(), pa.int64()))], ["shard", "uri", "n"])

    # the words are keys, so their grouping hashes and needs no sort
    words = docs.select(text).mapInArrow(distinct, "shard int, h long, word string").repartition(shards, "shard").distinct()
    coded = merged_pieces(words, pieces, longest).mapInArrow(write, "shard int, uri string, n long")
    before = spark.conf.get(GROUPS, None)
    spark.conf.set(GROUPS, str(HELD_GROUPS))
    try:
        with tidy(spark), wide_batches(spark, 8192):
            files = [r.asDict() for r in coded.collect()]
    finally:
        spark.conf.unset(GROUPS) if before is None else spark.conf.set(GROUPS, before)
    store_put(f"{folder}/files.json", json.dumps({"shards": shards, "files": files}).encode())
    return f"{folder}/files.json"


class _Words:
    def __init__(self, uri: str):
        with open_in(uri) as f:
            found = json.loads(f.read())
        self.shards, self.by = found["shards"], {}
        for f in found["files"]:
            raw, n = store_map(f["uri"]), f["n"]
            self.by.setdefault(f["shard"], []).append((raw[: 8 * n].view("<u8"), raw[8 * n : 16 * n + 8].view("<u8"), raw[16 * n + 8 :].view("<u2")))

    def ids(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words one after the other, how many each word has)."""
        back, u = pd.factorize(h)
        shard = _shard(u, self.shards)
        start, size, flat, held = np.zeros(len(u), np.int64), np.full(len(u), -1, np.int64), [], 0
        order = np.argsort(shard, kind="stable")
        for some in np.split(order, np.flatnonzero(np.diff(shard[order])) + 1) if len(u) else []:
            for keys, bounds, ids in self.by.get(int(shard[some[0]]), []):
                at = np.minimum(np.searchsorted(keys, u[some]), len(keys) - 1)
                there = keys[at] == u[some]
                sel, at = some[there], at[there]
                lo = bounds[at].astype(np.int64)
                size[sel] = bounds[at + 1].astype(np.int64) - lo
                start[sel] = held + np.cumsum(size[sel]) - size[sel]
                flat.append(ids[ragged(lo, size[sel])])
                held += len(flat[-1])
        if (size < 0).any():
            raise KeyError("a word isn't in the dictionary")
        return np.concatenate(flat)[ragged(start[back], size[back])] if flat else np.zeros(0, "<u2"), size[back]


_OPEN: dict[str, _Words] = {}


def encode(docs: DataFrame, key: str = "doc_id", text: str = "text", model: str = MODEL) -> DataFrame:
    """(key, ids) of each row: the ids that the library gives. Null and empty texts have none; repeated rows stay; other columns are ignored."""
    uri = dictionary(docs, text, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if uri not in _OPEN:
            _OPEN.clear()
            _OPEN[uri] = _Words(uri)
        for batch in batches:
            raw, bounds, at = units(batch.column(1))
            flat, sizes = _OPEN[uri].ids(hash_spans(raw, bounds[:-1], bounds[1:]))
            ends = np.concatenate(([0], np.cumsum(sizes)))[at].astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.astype(np.int32)))], [key, "ids"])
        trimmed_heap()

    return docs.select(key, text).mapInArrow(run, f"{key} {docs.schema[key].dataType.simpleString()}, ids array<int>")


@lru_cache(maxsize=2)
def piece_bytes(model: str) -> tuple[np.ndarray, np.ndarray]:
    """All pieces' bytes one after the other, and where each starts; control pieces have none."""
    sp = processor(model)
    names = [bytes([i - 3]) if sp.is_byte(i) else b"" if sp.is_control(i) or sp.is_unknown(i) else sp.id_to_piece(i).replace(SPACE, " ").encode() for i in range(sp.vocab_size())]
    return np.frombuffer(b"".join(names), np.uint8), np.concatenate(([0], np.cumsum([len(x) for x in names])))


def decoded(lists: pa.ListArray, model: str) -> list[bytes]:
    """The bytes of each list of ids, without the leading space."""
    names, at = piece_bytes(model)
    ids = lists.flatten().to_numpy(zero_copy_only=False)
    sizes = at[ids + 1] - at[ids]
    raw = names[ragged(at[ids], sizes)].tobytes()
    ends = np.concatenate(([0], np.cumsum(sizes)))
    count = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
    cut = ends[np.concatenate(([0], np.cumsum(count)))].tolist()
    out = [raw[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)]
    return [x[1:] if x.startswith(b" ") else x for x in out]


def decode(coded: DataFrame, key: str = "doc_id", model: str = MODEL) -> DataFrame:
    """(key, text) of rows (key, ids); bytes that aren't UTF-8 become replacement characters, null ids null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            texts = [x.decode("utf-8", "replace") for x in decoded(lists, model)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string(), mask=lists.is_null().to_numpy(zero_copy_only=False))], [key, "text"])

    return coded.select(key, "ids").mapInArrow(run, f"{key} {coded.schema[key].dataType.simpleString()}, text string")


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids, and what decoding them gives, as digests."""
    coded = encode(table(spark, sf_dir, "documents").select("doc_id", "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            ids, at = lists.flatten().to_numpy(zero_copy_only=False).astype("<u4"), np.concatenate(([0], np.cumsum(pc.list_value_length(lists).to_numpy()))).tolist()
            crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(at[:-1], at[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(at), pa.int64()), pa.array(crc, pa.int64()), pa.array([hashlib.sha256(x).hexdigest() for x in decoded(lists, MODEL)], pa.string())], ["doc_id", "n_tokens", "ids_crc32", "decoded_sha256"])

    return coded.mapInArrow(run, "doc_id long, n_tokens long, ids_crc32 long, decoded_sha256 string")


QUERIES = {"op4_sentencepiece": op4_sentencepiece}
ORACLE: dict[str, str] = {}
