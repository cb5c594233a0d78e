"""Language-model scoring by an Elias-Fano n-gram trie in memory-mapped levels.

Level 1 holds the sorted 64-bit hashes of all training words as an Elias-Fano sequence; a word's id is its rank. A node
of level k is (parent, label): parent is the rank of the first k - 1 words on level k - 1, label the rank of the last
k - 1 words *among the successors of their own context*. Labels are thus small, and parent * M + label grows along the
level, so one Elias-Fano sequence holds it; a second, monotone one holds where each parent's successors start. Finding an
n-gram is a successor search in that sequence. With every node go its quantised discounted probability, and with every
parent its quantised back-off weight.

The model is a set of shard files in the shared folder, cut from the sorted level at equal shares of the text, so that a
word with a third of all successors spans shards. Tasks map the files; no model goes through the driver, which keeps a
line per shard. Smoothing is interpolated absolute discounting down to add-one word probabilities; every n-gram of the
text is stored.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm.common import hash_words, merge_counts, mix64, open_in, scratch, small_batches, store_map, store_put, table, tidy, trimmed_heap

ORDER = 3
DISCOUNT = 0.75
#: n-grams of two or more words seen less often are pruned; 1: none.
LEAST_COUNT = 1
#: Steps of a quantised log10: 1 / QUANT.
QUANT = 4096
#: Characters of training text a shard.
SHARD_CHARS = 16 << 20
LEAST_SHARDS = 16
END = int(mix64(np.array([0x5E4D], np.uint64))[0])
BUFFER = 3_000_000
#: Bytes of texts whose n-grams are searched together.
POOL = 8 << 20

U = np.uint64


#: The place of the r-th one of a byte at [r << 8 | byte]; 10 to the power of each quantised logarithm.
_SELECT = np.array([([i for i in range(8) if b >> i & 1] + [0] * 8)[r] for r in range(8) for b in range(256)], np.int64)
_POWER = 10 ** (-np.arange(1 << 16) / QUANT)
_EACH, _TOP = U(0x0101010101010101), U(0x8080808080808080)


def select_in_word(w: np.ndarray, r: np.ndarray) -> np.ndarray:
    """The place of the r-th one (from 0) of each word: running sums of the bytes' ones tell its byte, a table its place there."""
    r = r.astype(U)
    x = w - (w >> U(1) & U(0x5555555555555555))
    x = (x & U(0x3333333333333333)) + (x >> U(2) & U(0x3333333333333333))
    x = (x + (x >> U(4)) & U(0x0F0F0F0F0F0F0F0F)) * _EACH
    at = np.bitwise_count((r * _EACH | _TOP) - x & _TOP).astype(U) << U(3)
    r = r - ((x << U(8)) >> at & U(255))
    return at.astype(np.int64) + _SELECT[(w >> at & U(255) | (r & U(7)) << U(8)).astype(np.int64)]


def pack_sequence(values: np.ndarray, name: str) -> tuple[dict[str, np.ndarray], dict]:
    """A monotone uint64 sequence as high bits in unary with rank directories, and packed low bits."""
    n = len(values)
    base = int(values[0]) if n else 0
    v = values - U(base)
    top = int(v[-1]) if n else 0
    low = max(0, (top // max(n, 1)).bit_length() - 1)
    high = (v >> U(low)).astype(np.int64)
    ones = high + np.arange(n)
    words = (int(high[-1]) + n) // 64 + 2 if n else 1
    bits = np.zeros(words * 64, np.uint8)
    bits[ones] = 1
    h = np.packbits(bits, bitorder="little").view(U)
    before = np.concatenate(([0], np.cumsum(np.bitwise_count(h).astype(np.int64))[:-1]))
    packed = np.zeros(n * low // 64 + 2, U)
    if low and n:
        bit = np.arange(n, dtype=np.int64) * low
        w, o = bit >> 6, (bit & 63).astype(U)
        part = v & U((1 << low) - 1)
        first = np.flatnonzero(np.concatenate(([True], w[1:] != w[:-1])))
        packed[w[first]] |= np.add.reduceat(part << o, first)
        packed[w[first] + 1] |= np.bitwise_or.reduceat((part >> U(1)) >> (U(63) - o), first)
    return {f"{name}_h": h, f"{name}_one": before.astype(np.uint32), f"{name}_zero": (64 * np.arange(words) - before).astype(np.uint32), f"{name}_low": packed}, {"n": n, "low": low, "base": base}


class Sequence:
    """Access and search in a packed sequence, many queries at once."""

    def __init__(self, arrays: dict[str, np.ndarray], name: str, info: dict):
        self.h, self.one, self.zero, self.packed = (arrays[f"{name}_{x}"] for x in ("h", "one", "zero", "low"))
        self.n, self.low, self.base = info["n"], info["low"], info["base"]
        self.most: int | None = None

    def low_bits(self, i: np.ndarray) -> np.ndarray:
        if not self.low:
            return np.zeros(len(i), U)
        bit = i * self.low
        w, o = bit >> 6, (bit & 63).astype(U)
        return (self.packed[w] >> o | (self.packed[w + 1] << U(1)) << (U(63) - o)) & U((1 << self.low) - 1)

    def access(self, i: np.ndarray) -> np.ndarray:
        w = np.searchsorted(self.one, i.astype(np.uint32), side="right") - 1
        at = w * 64 + select_in_word(self.h[w], i - self.one[w].astype(np.int64))
        return (at - i).astype(U) << U(self.low) | self.low_bits(i) if self.low else (at - i).astype(U)

    def value(self, i: np.ndarray) -> np.ndarray:
        return self.access(i) + U(self.base)

    def _zero(self, k: np.ndarray) -> np.ndarray:
        w = np.searchsorted(self.zero, k.astype(np.uint32), side="right") - 1
        return w * 64 + select_in_word(~self.h[w], k - self.zero[w].astype(np.int64))

    def _clear(self, bit: np.ndarray) -> np.ndarray:
        """The first clear bit from each place on."""
        w = bit >> 6
        free = ~self.h[w] >> (bit & 63).astype(U) << (bit & 63).astype(U)
        full = np.flatnonzero(free == 0)
        while len(full):
            w[full] += 1
            free[full] = ~self.h[w[full]]
            full = full[free[full] == 0]
        return (w << 6) + np.bitwise_count((free & -free) - U(1)).astype(np.int64)

    def find(self, x: np.ndarray) -> np.ndarray:
        """The place of each of some ascending values in a sequence of distinct ones, -1 where absent: a search among those with the same high bits."""
        out = np.full(len(x), -1, np.int64)
        if not self.n:
            return out
        if self.most is None:
            self.most = int(self.value(np.array([self.n - 1]))[0])
        a, b = int(np.searchsorted(x, U(self.base))), int(np.searchsorted(x, U(self.most), side="right"))
        if a >= b:
            return out
        y = x[a:b] - U(self.base)
        high = (y >> U(self.low)).view(np.int64)
        bit = self._zero(np.maximum(high - 1, 0)) + 1
        bit[: np.searchsorted(high, 1)] = 0
        lo, hi = bit - high, self._clear(bit) - high
        open_ = np.flatnonzero(lo < hi)
        at, lo, hi, want = open_ + a, lo[open_], hi[open_], (y & U((1 << self.low) - 1))[open_]
        while len(at):
            mid = (lo + hi) >> 1
            found = self.low_bits(mid)
            hit = found == want
            out[at[hit]] = mid[hit]
            less = found < want
            lo, hi = np.where(less, mid + 1, lo), np.where(less, hi, mid)
            open_ = np.flatnonzero((lo < hi) & ~hit)
            at, lo, hi, want = at[open_], lo[open_], hi[open_], want[open_]
        return out


def write_shard(uri: str, arrays: dict[str, np.ndarray], info: dict) -> None:
    at, places, blobs = 0, {}, []
    for k, a in arrays.items():
        b = np.ascontiguousarray(a).tobytes()
        places[k] = (a.dtype.str, at, len(a))
        b += bytes(-len(b) % 8)
        blobs.append(b)
        at += len(b)
    head = json.dumps({"arrays": places, "info": info}).encode()
    head += b" " * (-len(head) % 8)
    store_put(uri, len(head).to_bytes(8, "little") + head + b"".join(blobs))


class Shard:
    def __init__(self, uri: str):
        raw = np.asarray(store_map(uri))  # a plain array: slices of a memmap cost as much as small searches
        n = int.from_bytes(raw[:8].tobytes(), "little")
        head = json.loads(raw[8 : 8 + n].tobytes())
        self.info = head["info"]
        self.a = {k: raw[8 + n + at : 8 + n + at + size * np.dtype(kind).itemsize].view(kind) for k, (kind, at, size) in head["arrays"].items()}
        self.keys = Sequence(self.a, "key", self.info["key"])
        self.starts = Sequence(self.a, "ptr", self.info["ptr"]) if "ptr" in self.info else None
        self.cum = Sequence(self.a, "cum", self.info["cum"]) if "cum" in self.info else None


class Level:
    """A level's shards in order; ids are places in the whole level."""

    def __init__(self, meta: dict):
        self.meta, self.shards = meta, [Shard(s["uri"]) for s in meta["shards"]]
        self.first = np.array([s["first"] for s in meta["shards"]], U)
        self.begin = np.array([0, *np.cumsum([s["n"] for s in meta["shards"]])], np.int64)
        self.mass = np.array([0, *np.cumsum([s["mass"] for s in meta["shards"]])], np.int64)
        self.size, self.total = int(self.begin[-1]), int(self.mass[-1])
        self.lent = (np.array([p for p, _ in meta.get("lent", [])], np.int64), np.array([x for _, x in meta.get("lent", [])], float))

    def _each(self, where: np.ndarray) -> Iterator[tuple[int, np.ndarray | slice]]:
        if not len(where):
            return
        order = None if (where[1:] >= where[:-1]).all() else np.argsort(where.astype(np.int16 if len(self.shards) < 1 << 15 else np.int32), kind="stable")
        ranked = where if order is None else where[order]
        cuts = np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1], [True])))
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            yield int(ranked[a]), slice(a, b) if order is None else order[a:b]

    def search(self, u: np.ndarray) -> np.ndarray:
        """The node of each of some ascending distinct keys, -1 where absent: searches next to one another read the same memory."""
        got = np.full(len(u), -1, np.int64)
        for s, sel in self._each(np.searchsorted(self.first, u, side="right") - 1):
            if s >= 0:
                at = self.shards[s].keys.find(u[sel])
                got[sel] = np.where(at >= 0, at + self.begin[s], -1)
        return got

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The node of each key, -1 where absent. Each distinct key is searched once."""
        some, place = distinct(keys)
        return self.search(keys[some])[place]

    def gather(self, name: str, ids: np.ndarray) -> np.ndarray:
        """An array's values at ids."""
        out = np.zeros(len(ids), np.int64)
        for s, sel in self._each(np.searchsorted(self.begin, ids, side="right") - 1):
            out[sel] = self.shards[s].a[name][ids[sel] - self.begin[s]]
        return out

    def masses(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(training tokens of all nodes before each, each one's own): from the running sums, an Elias-Fano sequence a shard."""
        before, own = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64)
        for s, sel in self._each(np.searchsorted(self.begin, ids, side="right") - 1):
            at = ids[sel] - self.begin[s]
            lo = self.shards[s].cum.value(at).astype(np.int64)
            before[sel] = lo + self.mass[s]
            own[sel] = self.shards[s].cum.value(at + 1).astype(np.int64) - lo
        return before, own

    def count(self, ids: np.ndarray) -> np.ndarray:
        return self.masses(ids)[1]

    def start(self, parents: np.ndarray) -> np.ndarray:
        """Where each parent's successors start."""
        m = U(self.meta["m"])
        out = np.zeros(len(parents), np.int64)
        for s, sel in self._each(np.searchsorted(self.first, parents.astype(U) * m, side="right") - 1):
            if s < 0:
                continue
            info, shard = self.shards[s].info, self.shards[s]
            p = parents[sel]
            inside = (p >= info["p0"]) & (p <= info["p1"])
            got = np.full(len(p), self.begin[s + 1], np.int64)
            if inside.any():
                got[inside] = shard.starts.value(p[inside] - info["p0"]).astype(np.int64) + self.begin[s]
            out[sel] = got
        return out

    def left(self, parents: np.ndarray) -> np.ndarray:
        """Back-off weights; 1 for parents without successors."""
        out = np.ones(len(parents))
        first = np.array([s.info["p0"] for s in self.shards], np.int64)
        for s, sel in self._each(np.searchsorted(first, parents, side="right") - 1):
            if s < 0:
                continue
            info, p = self.shards[s].info, parents[sel]
            inside = p <= info["p1"]
            got = np.ones(len(p))
            got[inside] = _POWER[self.shards[s].a["left"][p[inside] - info["p0"]]]
            out[sel] = got
        if len(self.lent[0]):
            i = np.minimum(np.searchsorted(self.lent[0], parents), len(self.lent[0]) - 1)
            out = np.where(self.lent[0][i] == parents, self.lent[1][i], out)
        return out


_OPEN: dict[str, list[Level]] = {}


def opened(uri: str) -> list[Level]:
    """The levels that a description in the shared folder names; a worker maps each model once."""
    if uri not in _OPEN:
        _OPEN.clear()
        with open_in(uri) as f:
            _OPEN[uri] = [Level(m) for m in json.loads(f.read())]
    return _OPEN[uri]


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each distinct key, by size, occurs, and each key's place among them.

    Keys are sorted with their places in one number. Where both don't fit, keys lose low bits at first, and a second sort
    mends what little is out of order.
    """
    n = len(keys)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int32)
    least, bits = keys.min(), U((n - 1).bit_length())
    drop = U(max(0, int(keys.max() - least).bit_length() + int(bits) - 64))
    both = (keys - least) >> drop << bits | np.arange(n, dtype=U)
    both.sort()
    order = (both & (U(1) << bits) - U(1)).view(np.int64)
    ranked = keys[order] if drop else both >> bits
    if drop and (ranked[1:] < ranked[:-1]).any():
        again = np.argsort(ranked, kind="stable")
        order, ranked = order[again], ranked[again]
    new = np.ones(n, bool)
    np.not_equal(ranked[1:], ranked[:-1], out=new[1:])
    place = np.empty(n, np.int32)
    place[order] = np.cumsum(new, dtype=np.int32) - 1
    return order[new], place


def of_nodes(nodes: np.ndarray, value, absent: float = 0) -> np.ndarray:
    """value of the nodes, absent for -1."""
    sel = np.flatnonzero(nodes >= 0)
    got = value(nodes[sel])
    out = np.full(len(nodes), absent, got.dtype)
    out[sel] = got
    return out


class Grams:
    """The n-grams of each order that end at each token of some texts; whatever is asked of a level is asked once of each distinct one, in order.

    nodes[k] holds the nodes of distinct n-grams of k + 1 words and a last -1; place[k] tells which of them ends at a
    token, -1 where none can. bounds are the texts' among tokens.
    """

    def __init__(self, levels: list[Level], texts: pa.Array, orders: int):
        self.levels = levels
        h, at = hash_words(texts)
        docs = len(at) - 1
        self.bounds = at + np.arange(docs + 1)
        tokens = np.full(len(h) + docs, U(END))
        word = np.ones(len(tokens), bool)
        word[self.bounds[1:] - 1] = False
        tokens[word] = h
        some, place = distinct(tokens)
        self.place, self.nodes = [place], [np.append(levels[0].search(tokens[some]), -1)]
        self.parents = np.zeros(0, np.int64)
        for k in range(1, orders):
            sel, parent, label, rank = self.keys(k)
            some, found = distinct(rank)
            self.parents = parent[some]
            self.nodes.append(np.append(levels[k].search(key_of(levels, self.parents, label[some])), -1))
            place = np.full(len(tokens), -1, np.int32)
            place[sel] = found
            self.place.append(place)

    def labels(self, k: int) -> np.ndarray:
        """The rank of each node of level k, the last that was searched, among its context's successors."""
        nodes = self.nodes[k]
        if not k:
            return nodes
        heads = heads_of(self.parents)
        start = np.repeat(self.levels[k].start(self.parents[heads]), np.diff(np.append(heads, len(self.parents))))
        return np.append(nodes[:-1] - start, -1)

    def before(self, k: int) -> np.ndarray:
        """Which n-gram of k + 1 words ends before each token. The word before a text is an end, as before the first text that at the end of the last."""
        out = np.roll(self.place[k], 1)
        if k:
            out[self.bounds[:-1]] = -1
        return out

    def keys(self, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Tokens that end an n-gram of k + 1 words which level k could hold, its parents and labels, and numbers of the same order as the keys', but smaller."""
        nodes, before, here = self.nodes[k - 1], self.before(k - 1), self.place[k - 1]
        known = nodes >= 0
        sel = np.flatnonzero(known[before] & known[here])
        if len(sel) < len(here):
            before, here = before[sel], here[sel]
        label = self.labels(k - 1)[here]
        return sel, nodes[before], label, key_of(self.levels, before, label)


def key_of(levels: list[Level], parent: np.ndarray, label: np.ndarray) -> np.ndarray:
    return parent.astype(U) * U(levels[0].size) + label.astype(U)


def pooled(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[pa.RecordBatch]:
    """Batches put together to POOL bytes of their texts: a search of many keys at once costs less for each."""
    held, size = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += batch.column(column).nbytes
        if size >= POOL:
            yield pa.concat_batches(held)
            held, size = [], 0
    if held:
        yield pa.concat_batches(held)


def packed(x: np.ndarray) -> bytes:
    """Byte planes of an array, compressed: small numbers take few bytes."""
    planes = np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T)
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpacked(data: bytes, n: int, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(pa.decompress(data, decompressed_size=n * size, codec="zstd"), np.uint8).reshape(size, n)
    return np.ascontiguousarray(planes.T).view(kind).reshape(n)


def heads_of(x: np.ndarray) -> np.ndarray:
    """Where a sorted array's runs of equal values start."""
    return np.flatnonzero(np.concatenate(([True], x[1:] != x[:-1]))) if len(x) else np.zeros(0, np.int64)


def _counted(uri: str | None, k: int, shards: int):
    """Counts n-grams of k + 1 words by task: a row per shard with the sorted keys' gaps and counts, packed."""

    def batch_of(x: np.ndarray, c: np.ndarray, levels: list[Level], m: int) -> Iterator[pa.RecordBatch]:
        if not len(x):
            return
        if k == 0:
            share = (x >> U(32)).astype(float) / 2.0**32
        else:
            up = levels[k - 1]
            p = (x // U(m)).astype(np.int64)
            heads = heads_of(p)
            size = np.diff(np.append(heads, len(p)))
            before, own = up.masses(p[heads])
            share = (np.repeat(before, size) + np.repeat(own, size) * ((x % U(m)).astype(float) / m)) / max(1, up.total)
        s = np.minimum((share * shards).astype(np.int32), shards - 1)
        cuts = heads_of(s)
        for a, b in zip(cuts, np.append(cuts[1:], len(s)), strict=True):
            keys = packed(np.diff(x[a:b], prepend=U(0)))
            yield pa.RecordBatch.from_arrays([pa.array(s[a : a + 1]), pa.array([int(b - a)], pa.int64()), pa.array([keys], pa.binary()), pa.array([packed(c[a:b].astype(np.uint32))], pa.binary())], ["shard", "n", "keys", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels = opened(uri) if uri else []
        m = levels[0].size if k else 0
        raw, held, done = [], 0, (np.zeros(0, U), np.zeros(0, np.int64))

        def summed() -> tuple[np.ndarray, np.ndarray]:
            x = np.sort(np.concatenate(raw)) if raw else np.zeros(0, U)
            heads = heads_of(x)
            x, c = x[heads], np.diff(np.append(heads, len(x)))
            return merge_counts([done[0], x], [done[1], c]) if len(done[0]) else (x, c)

        for batch in pooled(batches, 0):
            if k == 0:
                h, at = hash_words(batch.column(0))
                raw += [h, np.full(len(at) - 1, END, U)]
            else:
                _, parent, label, _ = Grams(levels, batch.column(0), k).keys(k)
                raw.append(key_of(levels, parent, label))
            held += len(raw[-1]) + (len(raw[-2]) if k == 0 else 0)
            if held > BUFFER:
                done, raw, held = summed(), [], 0
                if len(done[0]) > BUFFER // 2:
                    yield from batch_of(*done, levels, m)
                    done = (np.zeros(0, U), np.zeros(0, np.int64))
        yield from batch_of(*summed(), levels, m)
        trimmed_heap()

    return run


def _built(uri: str | None, k: int, folder: str, least: int, last: bool):
    """Writes a level's shards, the few that hash to one task; a line of figures for each."""

    def finish(shard: int, keys: list[np.ndarray], counts: list[np.ndarray]) -> dict | None:
        x, c = merge_counts(keys, counts)
        if k and least > 1:
            keep = c >= least
            x, c = x[keep], c[keep]
        if not len(x):
            return None
        arrays, key = pack_sequence(x, "key")
        info = {"key": key}
        if not last:  # no level's probabilities are shares of the last one's counts
            sums, info["cum"] = pack_sequence(np.concatenate(([0], np.cumsum(c))).astype(U), "cum")
            arrays |= sums
        line = {"shard": shard, "n": len(x), "mass": int(c.sum()), "first": int(x[0])}
        if k:
            levels = opened(uri)
            m = levels[0].size
            p = (x // U(m)).astype(np.int64)
            p0, p1 = int(p[0]), int(p[-1])
            heads = heads_of(p)
            u, size = p[heads], np.diff(np.append(heads, len(p)))
            a = (c - DISCOUNT) / np.repeat(levels[k - 1].count(u), size)
            arrays["prob"] = np.minimum(65535, np.round(-np.log10(a) * QUANT)).astype(np.uint16)
            used = np.zeros(p1 - p0 + 1)
            used[u - p0] = np.add.reduceat(a, heads)
            arrays["left"] = np.minimum(65535, np.round(-np.log10(np.maximum(1e-9, 1 - used)) * QUANT)).astype(np.uint16)
            ptr, about = pack_sequence(np.searchsorted(p, np.arange(p0, p1 + 2)).astype(U), "ptr")
            arrays |= ptr
            info |= {"ptr": about, "p0": p0, "p1": p1}
            line |= {"p0": p0, "p1": p1, "used0": float(used[0]), "used1": float(used[-1])}
        line["uri"] = f"{folder}/level{k + 1}-{shard}-{np.random.default_rng().integers(1 << 62):x}"
        write_shard(line["uri"], arrays, info)
        return line

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[list, list]] = {}
        for batch in batches:
            for s, n, x, c in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                keys, counts = held.setdefault(s, ([], []))
                keys.append(np.cumsum(unpacked(x, n, U), dtype=U))
                counts.append(unpacked(c, n, np.uint32))
        lines = []
        for shard in sorted(held):
            keys, counts = held.pop(shard)
            if line := finish(shard, keys, [c.astype(np.int64) for c in counts]):
                lines.append(json.dumps(line))
        trimmed_heap()
        yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], ["line"])

    return run


def train(docs: DataFrame, order: int = ORDER, least: int = LEAST_COUNT) -> dict:
    """A model of docs (text, ...): a description whose size is a line per shard, the levels being files in the shared folder.

    The levels are described in a file beside them, so that tasks carry its name only. Null texts are empty and count an end. An empty table makes a model without words. Each level is one counting pass,
    one shuffle of counts that tasks have summed, and one task per shard that writes its file. least: see LEAST_COUNT.
    """
    spark = docs.sparkSession
    small_batches(spark)
    texts = docs.select("text")
    chars = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    shards = max(LEAST_SHARDS, -(-chars // SHARD_CHARS))
    folder = scratch(spark, "trie")
    levels: list[dict] = []
    uri = None
    for k in range(order):
        if k and not levels[k - 1]["shards"]:
            break
        rows = texts.mapInArrow(_counted(uri, k, shards), "shard int, n long, keys binary, counts binary").repartition(shards, "shard")
        with tidy(spark):
            lines = sorted((json.loads(r["line"]) for r in rows.mapInArrow(_built(uri, k, folder, least, k == order - 1), "line string").collect()), key=lambda x: x["shard"])
        meta = {"shards": lines, "m": sum(s["n"] for s in (levels[0]["shards"] if k else lines))}
        if k:
            if sum(s["n"] for s in lines) and sum(s["n"] for s in levels[k - 1]["shards"]) * meta["m"] >= 1 << 63:
                raise ValueError("parents times labels of a level exceed 63 bits")
            mass: dict[int, list[float]] = {}
            for s in lines:
                mass.setdefault(s["p0"], []).append(s["used0"])
                if s["p1"] != s["p0"]:
                    mass.setdefault(s["p1"], []).append(s["used1"])
            meta["lent"] = sorted((p, max(1e-9, 1 - sum(x))) for p, x in mass.items() if len(x) > 1)
        levels.append(meta)
        uri = f"{folder}/levels-{k + 1}.json"
        store_put(uri, json.dumps(levels).encode())
    return {"uri": uri, "tokens": sum(s["mass"] for s in levels[0]["shards"]), "words": sum(s["n"] for s in levels[0]["shards"])}


SCORES = "doc_id long, n_tokens long, n_known long, base_score double, score double"


def _scored(uri: str, total: int, words: int):
    """Scores texts (doc_id, text) by the model at uri of total tokens, words of them distinct."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels = opened(uri)
        for batch in pooled(batches, 1):
            grams = Grams(levels, batch.column(1), len(levels))
            nodes, place = grams.nodes[0], grams.place[0]
            p = (of_nodes(nodes, levels[0].count) + 1) / (total + words + 1)
            known, base, p = (nodes >= 0)[place], np.log10(p)[place], p[place]
            for k in range(1, len(levels)):
                if levels[k].size:
                    p *= of_nodes(grams.nodes[k - 1], levels[k].left, 1)[grams.before(k - 1)]
                    p += of_nodes(grams.nodes[k], lambda x, k=k: _POWER[levels[k].gather("prob", x)])[grams.place[k]]
            sums = lambda x: np.add.reduceat(x, grams.bounds[:-1])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.diff(grams.bounds)), pa.array(sums(known.astype(np.int64))), pa.array(sums(base)), pa.array(sums(np.log10(p)))], [x.split()[0] for x in SCORES.split(", ")]
            )

    return run


def score(docs: DataFrame, model: dict) -> DataFrame:
    """SCORES for each row of docs (doc_id, text, ...): null text is empty and has one token, its end."""
    small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_scored(model["uri"], model["tokens"], model["words"]), SCORES)


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learns from all documents but a seventh, scores all. A null doc_id is learnt from."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held = lambda: F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2, F.lit(False))
    model = train(docs.filter(~held()))
    return score(docs, model).select("doc_id", held().alias("held_out"), "n_tokens", "n_known", F.lit(model["tokens"]).cast("long").alias("train_tokens"), "base_score", "score")


QUERIES = {"op3_lm_scoring": op3_lm_scoring}
ORACLE: dict[str, str] = {}
