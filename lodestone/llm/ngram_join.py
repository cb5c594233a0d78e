"""N-gram Jaccard join: documents whose 5-word shingle sets have a similarity of 0.8 or more, exactly, and their classes.

Size-aware heavy-light join. For similarity t a set of n shingles shares at least ceil(t n) with any partner, so of two
partners' first n - ceil(t n) + L shingles, under one order of all shingles, the L smallest common ones agree. Small sets
enumerate the L-subsets of that prefix (L = 2) and meet where they share one; large sets (and the small ones near the
boundary) put the prefix for L = 1 into inverted lists, which are scanned. The boundary is the size that costs least.
Shingles are ordered by a count sketch of fixed size, frequent ones last, which keeps the lists short.

Equal sets count as one node. The rows (key, node) are range-partitioned and sorted, so a key of any weight may span
partitions; scanning a run of equal keys is streaming. In a list, a pivot stands for its members: links to it join most
of a large class, and then only pairs of members from different classes are left. The join on lists lets those go whose
sizes and parities by cell rule a link out (may_link); longer parities rule out most others, and what is left is verified.
"""

from __future__ import annotations

import hashlib
import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm.common import dropped, hash_words, mix64, small_batches, table, trimmed_heap, wide_batches, written
from lodestone.llm.components import components

SHINGLE = 5
PERCENT = 80
SUBSET = 2
SKETCH = 1 << 20
#: Cells of the shortest signature; a power of two.
LEAST_CELLS = 256
#: Nodes up to which their names are broadcast to fetch documents; 8 bytes each.
BROADCAST_NODES = 500_000
#: Rounds in which lists link their members to a pivot, before the pairs of different classes are enumerated.
PIVOT_ROUNDS = 2
#: Rows of one key that a task holds at most before they leave in pieces.
RUN_ROWS = 65536


def shingle_sets(texts: pa.Array, k: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; with fewer words than k, the whole sequence as one; none without words."""
    h, at = hash_words(texts)
    out = []
    rolled = np.zeros(max(0, len(h) - k + 1), np.uint64)
    for i in range(k):
        rolled = rolled * np.uint64(0x9E3779B97F4A7C15) + h[i : len(h) - k + 1 + i] if len(rolled) else rolled
    rolled = mix64(rolled)
    for a, b in zip(at[:-1], at[1:], strict=True):
        if b - a >= k:
            out.append(np.unique(rolled[a : b - k + 1]))
        elif b > a:
            whole = hashlib.blake2b(h[a:b].tobytes(), digest_size=8).digest()
            out.append(np.frombuffer(whole, np.uint64))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def node_of(s: np.ndarray) -> int:
    """A 63-bit name of a set."""
    return int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little") >> 1


def prefix_length(n: int, shared: int, percent: int = PERCENT) -> int:
    """How many of its smallest shingles a set of n must show so that partners agree in `shared` of them."""
    return min(n, n - -(-percent * n // 100) + shared)


def signature(s: np.ndarray) -> np.ndarray:
    """Parities of how many of a set's shingles fall into each of m cells, packed into bytes: m is the power of two from the set's size on.

    Two sets' parities differ in at least one shingle of either set each, so the differing cells bound what sets share.
    A signature takes 1 to 2 bits a shingle. Folding its halves onto each other gives the signature of half as many cells.
    """
    m = max(LEAST_CELLS, 1 << max(0, len(s) - 1).bit_length())
    odd = np.bincount((s >> np.uint64(20)).astype(np.int64) & (m - 1), minlength=m) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little")


def folded(sig: np.ndarray, size: int) -> np.ndarray:
    """A signature of `size` bytes from a longer one."""
    while len(sig) > size:
        sig = sig[: len(sig) // 2] ^ sig[len(sig) // 2 :]
    return sig


def may_link(percent: int = PERCENT) -> Column:
    """Whether sizes na, nb and folded signatures a0-a3, b0-b3 allow a link; no link is lost.

    Sets that link differ in at most (100 - percent) / (100 + percent) of their added sizes.
    """
    apart = sum((F.bit_count(F.col(f"a{i}").bitwiseXOR(F.col(f"b{i}"))) for i in range(LEAST_CELLS // 64)), F.lit(0))
    near = (100 + percent) * apart <= (100 - percent) * (F.col("na") + F.col("nb"))
    sized = (100 * F.col("na") >= percent * F.col("nb")) & (100 * F.col("nb") >= percent * F.col("na"))
    return sized & near


def linked(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both) and both > 0


def sketch(docs: DataFrame) -> tuple[np.ndarray, dict[int, int], float]:
    """A count sketch of shingles (documents by cell, heavy cells only), the histogram of set sizes, and the heavy cells' mean weight.

    At most SKETCH cells and a row per set size (rounded above 256) reach the driver, whatever the number of documents.
    The sketch only orders shingles; the join is exact under any order.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, sizes = np.zeros(SKETCH, np.int64), {}
        for batch in batches:
            for s in shingle_sets(batch.column(0)):
                np.add.at(cells, (s % np.uint64(SKETCH)).astype(np.int64), 1)
                n = len(s) if len(s) <= 256 else 1 << int(len(s)).bit_length()
                sizes[n] = sizes.get(n, 0) + 1
        heavy = np.flatnonzero(cells >= 8 + 3 * cells.mean())
        yield pa.RecordBatch.from_arrays(
            [pa.array([0] * len(heavy) + [1] * len(sizes), pa.int32()), pa.array([*heavy.tolist(), *sizes], pa.int64()), pa.array([*cells[heavy].tolist(), *sizes.values()], pa.int64())], ["what", "k", "n"]
        )

    found = docs.select("text").mapInArrow(run, "what int, k long, n long").groupBy("what", "k").agg(F.sum("n").alias("n")).collect()
    cells = np.zeros(SKETCH, np.int64)
    for r in found:
        if r["what"] == 0:
            cells[r["k"]] = r["n"]
    sizes = {r["k"]: r["n"] for r in found if r["what"] == 1}
    total = sum(k * n for k, n in sizes.items()) or 1
    return cells, sizes, float((cells.astype(float) ** 2).sum()) / total


def boundary(sizes: dict[int, int], heavy: float, percent: int = PERCENT) -> int:
    """The largest size whose sets enumerate subsets, by cost: rows of subsets against rows of lists and what scanning them meets."""
    enum = {n: c * math.comb(prefix_length(n, SUBSET, percent), SUBSET) for n, c in sizes.items() if n}
    scan = {n: c * prefix_length(n, 1, percent) * (2 + math.log1p(heavy)) for n, c in sizes.items() if n}
    cost = lambda b: sum(v for n, v in enum.items() if n <= b) + sum(v for n, v in scan.items() if 100 * n > percent * b)
    return min([0, *(n for n in sizes if 4 <= n <= 256)], key=lambda b: (cost(b), b))


def keys_of(s: np.ndarray, order: np.ndarray, bound: int, percent: int = PERCENT) -> np.ndarray:
    """The join keys of a set: hashed subsets if it's small, its prefix in the inverted lists if it's large or a large set's partner can be."""
    n = len(s)
    weight = order[(s % np.uint64(SKETCH)).astype(np.int64)]
    p = prefix_length(n, SUBSET if n <= bound else 1, percent)
    first = s[np.lexsort((s, weight))[:p]] if n else s
    out = []
    if n and n <= bound and p >= SUBSET:
        i, j = np.triu_indices(p, 1)
        out.append(mix64(first[i] * np.uint64(3) + mix64(first[j] + np.uint64(1))))
    if n and 100 * n > percent * bound:
        out.append(mix64(first[: prefix_length(n, 1, percent)] + np.uint64(2)))
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def _signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)


def text_hash() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit("")))


def keyed(docs: DataFrame, cells: np.ndarray, bound: int, percent: int = PERCENT) -> DataFrame:
    """(doc_id, t, n, node, sig, keys) of each row; t is a hash of the text."""
    order = docs.sparkSession.sparkContext.broadcast(cells.astype(np.int32))  # SKETCH cells: 4 MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = shingle_sets(batch.column(1))
            keys = [_signed(keys_of(s, order.value, bound, percent)) for s in sets]
            bounds = np.concatenate(([0], np.cumsum([len(k) for k in keys]))).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.concatenate(keys) if keys else np.zeros(0, np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array([len(s) for s in sets], pa.int64()), pa.array([node_of(s) for s in sets], pa.int64()), pa.array([signature(s).tobytes() for s in sets], pa.binary()), lists], ["doc_id", "t", "n", "node", "sig", "keys"])
        trimmed_heap()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", text_hash().alias("t")).mapInArrow(run, "doc_id long, t long, n long, node long, sig binary, keys array<long>")


def _runs(batches: Iterator[pa.RecordBatch], most: int = RUN_ROWS) -> Iterator[pa.RecordBatch]:
    """Of sorted (key, node) rows, those of keys with two nodes or more; lists of the same members come once.

    A complete run is named by a sum over its members, so that equal lists coincide. The runs at a partition's ends may
    go on elsewhere, and keep their key; so do all pieces of a run of over `most` rows.
    """
    held_k, held_n, raw = np.zeros(0, np.int64), np.zeros(0, np.int64), True  # raw: the open run leaves under its key

    def batch_of(k: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(k), pa.array(n)], ["list", "node"])

    def distinct(k: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        new = np.ones(len(k), bool)
        new[1:] = (k[1:] != k[:-1]) | (n[1:] != n[:-1])
        return k[new], n[new]

    for batch in batches:
        k = np.concatenate((held_k, batch.column(0).to_numpy(zero_copy_only=False)))
        n = np.concatenate((held_n, batch.column(1).to_numpy(zero_copy_only=False)))
        k, n = distinct(k, n)
        if not len(k):
            continue
        heads = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1])))
        last = heads[-1]
        if raw and last > 0:  # the partition's first run, or the rest of one that left in pieces
            yield batch_of(k[: heads[1]], n[: heads[1]])
            k, n, last, raw = k[heads[1] :], n[heads[1] :], last - heads[1], False
            heads = heads[1:] - heads[1]
        if raw or last == 0 and len(k) > most:  # one long run: it leaves in pieces under its key
            yield batch_of(k[:-1], n[:-1])
            held_k, held_n, raw = k[-1:], n[-1:], True
            continue
        size = np.diff(np.append(heads[:-1], last))
        name = np.add.reduceat(mix64(n[:last].view(np.uint64)), heads[:-1]) if last else np.zeros(0, np.uint64)
        many = np.repeat(size >= 2, size)
        if many.any():
            yield batch_of(np.repeat(_signed(mix64(name)), size)[many], n[:last][many])
        held_k, held_n = k[last:], n[last:]
    if len(held_k):
        yield batch_of(held_k, held_n)


def runs_of(rows: DataFrame, parts: int) -> DataFrame:
    """(list, node): each node once in each list; a few lists have one node only."""
    pairs = rows.select(F.explode("keys").alias("key"), "node")
    return pairs.repartitionByRange(parts, "key", "node").sortWithinPartitions("key", "node").mapInArrow(_runs, "list long, node long").distinct()


def shared_lists(found: DataFrame) -> DataFrame:
    """Those of lists with two nodes or more."""
    full = found.groupBy("list").agg(F.count("*").alias("c")).filter("c > 1").select("list")
    return found.join(full, "list")


def node_sets(docs: DataFrame, rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """(node, set) of the nodes in pairs, from the text of one document each."""
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    some = rows.select("node", F.coalesce("doc_id", F.lit(-(2**63))).alias("d")).join(nodes, "node").groupBy("node").agg(F.min("d").alias("d")).select("d").distinct()
    some = written(some, "fetched")
    if some.count() <= BROADCAST_NODES:
        some = F.broadcast(some)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = shingle_sets(batch.column(0))
            yield pa.RecordBatch.from_arrays([pa.array([node_of(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())], ["node", "set"])
        trimmed_heap()

    picked = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("d"), "text").join(some, "d", "left_semi").select("text")
    return picked.mapInArrow(run, "node long, set binary").groupBy("node").agg(F.first("set").alias("set"))


def items(column: pa.Array, kind: str) -> list[np.ndarray]:
    """A binary column's values as arrays over its own bytes, without a copy."""
    _, bounds, data = column.buffers()
    at = np.frombuffer(bounds, np.int32)[column.offset : column.offset + len(column) + 1].tolist() if len(column) else []
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return [raw[a:b].view(kind) for a, b in zip(at[:-1], at[1:], strict=True)]


def folded_bits(signed: DataFrame) -> DataFrame:
    """(node, n, bits0, ...) of (node, n, sig): signatures folded to LEAST_CELLS, as bigints."""
    words = [f"bits{i}" for i in range(LEAST_CELLS // 64)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                bits = np.stack([folded(s, LEAST_CELLS // 8) for s in items(batch.column(2), "u1")]).view(np.int64)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *[pa.array(np.ascontiguousarray(bits[:, i])) for i in range(len(words))]], ["node", "n", *words])

    return signed.select("node", "n", "sig").mapInArrow(run, "node long, n long, " + ", ".join(f"{w} long" for w in words))


def possible(pairs: DataFrame, signed: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Those of pairs (a, b) whose sizes and signatures allow a link; no link is lost."""
    side = lambda k, x: signed.select(F.col("node").alias(k), F.col("n").alias(f"n{k}"), F.col("sig").alias(x))
    near = pairs.join(side("a", "x"), "a").join(side("b", "y"), "b").filter(f"100 * na >= {percent} * nb and 100 * nb >= {percent} * na").select("a", "b", "na", "nb", "x", "y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = batch.column(2).to_numpy(zero_copy_only=False) + batch.column(3).to_numpy(zero_copy_only=False)
            apart = []
            for x, y in zip(items(batch.column(4), "u1"), items(batch.column(5), "u1"), strict=True):
                size = min(len(x), len(y))
                apart.append(int(np.bitwise_count(folded(x, size) ^ folded(y, size)).sum(dtype=np.int64)))
            m = pa.array((100 + percent) * np.array(apart, np.int64) <= (100 - percent) * both)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(m), batch.column(1).filter(m)], ["a", "b"])

    return near.mapInArrow(run, "a long, b long")


def verified(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Those of pairs (a, b) that link, by their whole sets."""
    both = pairs.join(sets.select(F.col("node").alias("a"), F.col("set").alias("x")), "a").join(sets.select(F.col("node").alias("b"), F.col("set").alias("y")), "b").select("a", "b", "x", "y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = pa.array([linked(x, y, percent) for x, y in zip(items(batch.column(2), "<u8"), items(batch.column(3), "<u8"), strict=True)], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(m), batch.column(1).filter(m)], ["a", "b"])
        trimmed_heap()

    return both.mapInArrow(run, "a long, b long")


def labelled(docs: DataFrame, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """Written rows (doc_id, t, n, node, sig), one for each of docs, and (node, root): nodes that links join have one root. Nodes without links may be absent."""
    spark = docs.sparkSession
    small_batches(spark)
    cells, sizes, heavy = sketch(docs)
    wide = written(keyed(docs, cells, boundary(sizes, heavy, percent), percent), "keys")
    keys = wide.agg(F.sum(F.size("keys"))).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), keys // 4_000_000)
    with wide_batches(spark):
        found = written(runs_of(wide.filter("n > 0"), parts), "lists")
    rows = written(wide.drop("keys"), "rows")
    dropped(wide)
    lists = written(shared_lists(found), "members")
    dropped(found)
    nodes = written(lists.select("node").distinct(), "nodes")
    signed = written(rows.select("node", "n", "sig").join(nodes, "node").dropDuplicates(["node"]), "signatures")
    labels = nodes.select("node", F.col("node").alias("root"))
    links = tried = None
    for turn in range(PIVOT_ROUNDS + 1):
        named = lists.join(labels, "node")
        if turn < PIVOT_ROUNDS:
            pivot = lists.groupBy("list").agg(F.min_by("node", F.xxhash64("node", F.lit(turn))).alias("pivot"))
            pairs = named.join(pivot, "list").join(labels.select(F.col("node").alias("pivot"), F.col("root").alias("other")), "pivot").filter("root <> other").select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b"))
        else:
            # lists whose members are all in one class have nothing left
            open_ = named.groupBy("list").agg(F.min("root").alias("x"), F.max("root").alias("y")).filter("x <> y").select("list")
            left = named.join(open_, "list")
            left = left.join(folded_bits(signed), "node")
            side = lambda k, r: left.select("list", F.col("node").alias(k), F.col("root").alias(r), F.col("n").alias(f"n{k}"), *[F.col(f"bits{i}").alias(f"{k}{i}") for i in range(LEAST_CELLS // 64)])
            pairs = side("a", "r").join(side("b", "q"), "list").filter("a < b and r <> q").filter(may_link(percent)).select("a", "b")
        pairs = pairs.distinct()
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = written(possible(pairs, signed, percent), "pairs")
        if not pairs.isEmpty():
            new = written(verified(pairs, node_sets(docs, rows, pairs), percent), "links")
            tried = pairs if tried is None else tried.union(pairs)
            if new.isEmpty():
                continue
            links = new if links is None else links.union(new)
            old, labels = labels, written(nodes.join(components(links), "node", "left").select("node", F.coalesce("root", "node").alias("root")), "labels")
            dropped(old)
    dropped(lists, signed)
    return rows, labels


def classes(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """docs (doc_id, text, ...) as (doc_id, n_shingles, component_id): a row for each row of docs.

    component_id is the smallest doc_id that links reach, its own included. Null or empty text: no shingles, its own
    doc_id. A null doc_id takes part; its class is named by the smallest other id, or null. Repeated rows and equal ids
    give a row each. Other columns are ignored. An empty table gives no rows. Ids that are no whole numbers raise.
    """
    rows, labels = labelled(docs, percent)
    least = rows.filter("n > 0").groupBy("node").agg(F.min("doc_id").alias("least"))
    named = least.join(labels, "node", "left").select("node", F.coalesce("root", "node").alias("root"), "least")
    final = named.join(named.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("node", "component_id")
    out = rows.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("node")).alias("node")).join(final, "node", "left")
    return out.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes(table(spark, sf_dir, "documents").select("doc_id", "text"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each class one row stays, that with the smallest doc_id; of rows with one id, that with the smallest hash of its text.

    Null ids come last, so such a row stays only where its class has no other. Of rows with equal id and text one stays.
    Rows without words all stay. Columns of any name are kept as they are; an empty table stays empty.
    """
    rows, labels = labelled(docs.select("doc_id", "text"))
    full = rows.filter("n > 0").join(labels, "node", "left").select(F.coalesce("root", "node").alias("root"), "doc_id", "t")
    first = full.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "t")).alias("x"))
    keep = written(first.select(F.col("x.doc_id").alias("d"), F.col("x.t").alias("t")).unionByName(rows.filter("n = 0").select(F.col("doc_id").alias("d"), "t")).distinct(), "kept")
    keys = [f"{name}_{uuid.uuid4().hex}" for name in ("d", "t")]  # no column of docs bears them
    same = F.col(keys[0]).eqNullSafe(keep["d"]) & (F.col(keys[1]) == keep["t"])
    left = docs.withColumns({keys[0]: F.col("doc_id").cast("long"), keys[1]: text_hash()}).join(keep, same, "left_semi")
    repeated = rows.filter("n > 0").groupBy("doc_id", "t").count().filter("count > 1").select(F.col("doc_id").alias("d"), "t").join(keep.withColumnsRenamed({"d": "kd", "t": "kt"}), F.col("d").eqNullSafe(F.col("kd")) & (F.col("t") == F.col("kt")), "left_semi")
    if not repeated.isEmpty():  # else each kept pair of id and text has one row, and nothing needs a shuffle
        words = F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
        left = left.filter(words).dropDuplicates(keys).unionByName(left.filter(~words))
    return left.select(docs.columns)


_SETS = r"""
t AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' ')) END)) AS g FROM t)"""
ORACLE_SQL = f"""
WITH RECURSIVE {_SETS},
u AS (SELECT g, min(doc_id) AS d, len(g) AS n FROM s WHERE len(g) > 0 GROUP BY g),
x AS (SELECT d, n, unnest(g) AS x FROM u),
p AS (SELECT a.d AS a, b.d AS b FROM x a JOIN x b ON a.x = b.x AND a.d < b.d AND 100 * a.n >= 80 * b.n AND 100 * b.n >= 80 * a.n
 GROUP BY a.d, b.d, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
e AS (SELECT a, b FROM p UNION ALL SELECT b, a FROM p UNION ALL SELECT d, d FROM u),
r AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
c AS (SELECT a AS d, min(b) AS c FROM r GROUP BY a)
SELECT s.doc_id, len(s.g) AS n_shingles, CASE WHEN len(s.g) = 0 THEN s.doc_id ELSE c.c END AS component_id FROM s LEFT JOIN u ON s.g = u.g LEFT JOIN c ON u.d = c.d"""

QUERIES = {"op7_ngram_join": op7_ngram_join}
ORACLE = {"op7_ngram_join": ORACLE_SQL}
