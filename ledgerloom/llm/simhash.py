"""Operator 3: SimHash near-dedup by a binary trie self-join.

Distinct fingerprints meet in tries (:mod:`trie`): pairs of nodes are traversed
together, differing bits add up, and a pair is pruned whenever the Hamming budget
is exceeded. Within a task only a spanning forest of the links found is kept,
never all pairs of a group, and node pairs whose fingerprints are already
connected are not traversed again.

:func:`simhash_components` links 64-bit fingerprints. :func:`drop_near_duplicates`
finds the pairs of texts whose sets of word shingles are similar: candidates come
from tries over several bands of a longer SimHash, and an exact check decides.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import repeat
from math import acos, ceil, comb, log, pi, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_128_digest, xxh64_intdigest

from .common import fresh, lean_checkpoint, prepare, row_key, texts
from .components import connected_components
from .trie import MOST, Keys, same_run, spanning_links, trie_join, trie_links

SEED = 42


# --- fingerprints -----------------------------------------------------------


def shingle_hashes(text: bytes | None, n: int) -> np.ndarray:
    """XXH64 (seed 42) of each n-word shingle, repeats included; fewer words: the whole sequence; none: empty."""
    w = (text or b"").lower().split()
    if not w:
        return np.empty(0, np.uint64)
    joined = b" ".join(w)
    ends = np.cumsum([len(x) + 1 for x in w])
    n = min(n, len(w))
    stops = (ends[n - 1 :] - 1).tolist()
    starts = [0, *ends[: len(w) - n].tolist()]
    view = memoryview(joined)
    return np.fromiter(map(xxh64_intdigest, [view[a:b] for a, b in zip(starts, stops, strict=True)], repeat(SEED)), np.uint64, len(stops))


def set_bits(words: np.ndarray) -> np.ndarray:
    """For rows of 64-bit words, whether each bit is set in over half of the rows (uint8 0 or 1, from the lowest bit)."""
    raw = np.ascontiguousarray(words).view(np.uint8).reshape(len(words), -1)
    total = np.zeros(raw.shape[1] * 8, np.int64)
    for at in range(0, len(raw), 255):
        total += np.add.reduce(np.unpackbits(raw[at : at + 255], axis=1, bitorder="little"), axis=0, dtype=np.uint8)
    return (total * 2 > len(words)).astype(np.uint8)


def fingerprint(hashes: np.ndarray) -> int:
    """64-bit SimHash as a signed integer: a bit is 1 if set in over half the hashes; none: 0."""
    return int(np.packbits(set_bits(hashes), bitorder="little").view(np.int64)[0]) if len(hashes) else 0


def fingerprint_links(fps: DataFrame, col: str = "fp", bits: int = 64, budget: int = 3, most: int | None = None) -> DataFrame:
    """Spanning links (u, v) between distinct fingerprints at most ``budget`` bits apart; most: keys of a group in one task."""

    def unpack(batch: pa.RecordBatch) -> dict:
        fp = batch.column(0).to_numpy(zero_copy_only=False)
        return {"node": fp, "keys": fp.view(np.uint64).reshape(-1, 1)}

    def work(shape: Keys, x: dict, nodes, depth: int) -> Iterator[pa.RecordBatch]:
        i, j = spanning_links(x["key"], nodes, depth, shape.bits, (shape.budget,))
        if len(i):
            yield pa.RecordBatch.from_arrays([pa.array(x["node"][i]), pa.array(x["node"][j])], names=["u", "v"])

    nodes = fps.select(F.col(col).alias("fp"))
    return trie_join(nodes, Keys(bits, budget), unpack, work, "u long, v long", {"node": "i8"}, nodes.count(), most=most)


def simhash(df: DataFrame, words: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and fp (64-bit SimHash as a long) of every row."""
    prepare(df.sparkSession)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            fps = [fingerprint(shingle_hashes(t, words)) for t in texts(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(fps, pa.int64())], names=["doc_id", "fp"])

    return df.select(df[id_col].cast("long"), df[text_col]).mapInArrow(run, "doc_id long, fp long")


def simhash_components(df: DataFrame, words: int = 3, budget: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fp, fingerprint (16 hex digits), component_id for every row.

    component_id is the least doc_id reachable over links of at most ``budget``
    differing bits, the row itself included (null only where a component has
    no id). Texts without words, null ones too, have fingerprint zero and are
    linked like any other. Repeated rows stay, empty tables give no rows,
    other columns are ignored.
    """
    docs = lean_checkpoint(simhash(df, words, id_col, text_col))
    least = lean_checkpoint(docs.groupBy("fp").agg(F.min("doc_id").alias("low")))
    roots = connected_components(fingerprint_links(least, "fp", 64, budget)).withColumnRenamed("node", "fp")
    rooted = least.join(roots, "fp", "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    low = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    ids = rooted.join(low, "root").select("fp", "component_id")
    # a fingerprint that a third of the rows share only makes many narrow rows, which AQE splits
    return docs.join(ids, "fp").select("doc_id", "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


# --- near-duplicates by several bands and an exact check ----------------------

BUDGET = 2
LEAST_BITS, CROWDED_BITS = 24, 15
COMPARED = 256  # keys that a key meets by chance in a band, about, at most
MISSED, CROWDED_MISSED = 0.001, 1e-5  # share of pairs at the least similarity that no band finds; fewer where bands are short
FIRST_BANDS = 8  # that the first search uses, which need not find all
CHECK_BITS, SIGMAS = 64, 4  # deviations from the mean that a pair at the least similarity may have in other bits
FEW = 200_000  # rows of some 100 bytes that may be broadcast
MANY, WIDE_WORDS, WIDE_SIGMAS = 4, 64, 3.3  # candidates of a text in a task from which on it is looked at by so many 64-bit words



@dataclass(frozen=True)
class Plan:
    """How near-duplicates at a similarity are searched among n texts.

    Sets of a Jaccard similarity s meet at an angle of acos(2s / (1 + s)) if they
    are equally large; each SimHash bit differs with that angle over pi. Keys have
    so many bits that chance meets stay bounded, and there are so many bands
    that a pair at the least similarity is missed with a probability of ``missed``.
    """

    n: int
    similarity: float = 0.8
    least_bits: int = LEAST_BITS
    missed: float = MISSED

    @property
    def odds(self) -> float:
        return acos(2 * self.similarity / (1 + self.similarity)) / pi

    @property
    def bits(self) -> int:
        b = self.least_bits
        while self.n * sum(comb(b, k) for k in range(BUDGET + 1)) / 2**b > COMPARED:
            b += 1
        return b

    @property
    def found(self) -> float:
        """The probability that a band finds a pair at the least similarity."""
        p, b = self.odds, self.bits
        return sum(comb(b, k) * p**k * (1 - p) ** (b - k) for k in range(BUDGET + 1))

    @property
    def bands(self) -> int:
        return ceil(log(self.missed) / log(1 - self.found))

    @property
    def words(self) -> int:
        """64-bit words of a sketch."""
        return -(-self.bands * self.bits // 64)

    def most_apart(self, bits: int, sigmas: float = SIGMAS) -> int:
        """Bits of so many that a pair at the least similarity may differ in."""
        return ceil(bits * self.odds + sigmas * sqrt(bits * self.odds * (1 - self.odds)))


def shingle_set(text: bytes | None, n: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the n-word shingles (A-Z lower-cased; fewer words: the whole sequence), from the words' hashes."""
    w = (text or b"").lower().split()
    if not w:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxh64_intdigest, w, repeat(SEED)), np.uint64, len(w))
    n = min(n, len(w))
    total = np.full(len(w) - n + 1, n, np.uint64)
    for k in range(n):
        total = (total ^ h[k : len(w) - n + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
        total ^= total >> np.uint64(29)
    total = total * np.uint64(0xBF58476D1CE4E5B9)
    return np.unique(total ^ (total >> np.uint64(32)))


@lru_cache(8)
def _turns(words: int) -> np.ndarray:
    return np.random.default_rng(SEED).integers(1, 1 << 63, words, dtype=np.uint64) | np.uint64(1)


def sketch(hashes: np.ndarray, words: int) -> np.ndarray:
    """A SimHash of 64 * words bits (uint8 0 or 1) of a set of hashes, each hash expanded to as many random bits; none: zeros."""
    if not len(hashes):
        return np.zeros(64 * words, np.uint8)
    x = hashes[:, None] * _turns(words)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    return set_bits(x)


def resemblance(a: bytes, b: bytes, words: int) -> float:
    """Jaccard similarity of the sets of word shingles."""
    x, y = shingle_set(a, words), shingle_set(b, words)
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both / max(1, len(x) + len(y) - both) if len(x) or len(y) else 1.0


def _band_keys(words: np.ndarray, plan: Plan, bands: range) -> np.ndarray:
    """The keys (rows by bands) of sketches given as 64-bit words."""
    weights = np.uint64(1) << np.arange(plan.bits - 1, -1, -1, dtype=np.uint64)
    flat = np.unpackbits(np.ascontiguousarray(words).view(np.uint8), axis=1, bitorder="little")[:, bands.start * plan.bits : bands.stop * plan.bits]
    return (flat.reshape(len(words), len(bands), plan.bits) * weights).sum(axis=2, dtype=np.uint64)


def _unpacker(plan: Plan, bands: range):
    """unpack(batch) of rows (node, bits and, if there are, root and crowded): keys and check words by band; a band's check word takes the bits after its own."""

    def unpack(batch: pa.RecordBatch) -> dict:
        words = np.ascontiguousarray(batch.column("bits").flatten().to_numpy().reshape(batch.num_rows, -1)).view(np.uint64)
        flat = np.unpackbits(words.view(np.uint8), axis=1, bitorder="little")
        size, twice = flat.shape[1], np.concatenate([flat, flat], axis=1)
        checks = [np.packbits(twice[:, at : at + CHECK_BITS], axis=1).view(np.uint64)[:, 0] for at in (((b + 1) * plan.bits) % size for b in bands)]
        out = {"node": batch.column("node").to_numpy(), "keys": _band_keys(words, plan, bands), "check": np.stack(checks, axis=1)}
        if "root" in batch.schema.names:
            out["root"] = batch.column("root").to_numpy()
        if "crowded" in batch.schema.names:
            out["crowded"] = batch.column("crowded").to_numpy(zero_copy_only=False)
        return out

    return unpack


def close_links(nodes: DataFrame, plan: Plan, most: int | None = None) -> DataFrame:
    """Distinct links (u, v) that look close, from (node, bits): of each trie a minimum spanning forest by the check words' distance.

    They only serve to connect most of what belongs together, so only links at
    most as far apart as a pair at the least similarity is on average are taken.
    """
    apart = plan.most_apart(CHECK_BITS, 0)

    def work(shape: Keys, x: dict, nodes, depth: int) -> Iterator[pa.RecordBatch]:
        def near(i, j):
            d = np.bitwise_count(x["check"][i] ^ x["check"][j])
            return d, d <= apart

        i, j = spanning_links(x["key"], nodes, depth, shape.bits, (0, shape.budget), near)
        if len(i):
            yield pa.RecordBatch.from_arrays([pa.array(x["node"][i]), pa.array(x["node"][j])], names=["u", "v"])

    bands = range(min(FIRST_BANDS, plan.bands))
    found = trie_join(nodes, Keys(plan.bits, BUDGET, len(bands)), _unpacker(plan, bands), work, "u long, v long", {"check": "u8", "node": "i8"}, plan.n, complete=False, most=most)
    return found.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()


def crossing_links(nodes: DataFrame, plan: Plan, bands: range, large_roots: list[int], most: int | None = None) -> DataFrame:
    """Candidate pairs (u, v) of nodes with different roots, from (node, bits, root, crowded), and (u, u) for nodes found to be crowded.

    Node pairs within one root are not traversed. A node is crowded if it has
    over MANY candidates in a task, as in a large family of texts whose similarity
    is just too small; pairs of two crowded nodes are left to :func:`crowded_links`,
    all others of these bands are listed here.
    """
    apart = plan.most_apart(CHECK_BITS)

    def work(shape: Keys, x: dict, nodes, depth: int) -> Iterator[pa.RecordBatch]:
        root, check, node, known = x["root"], x["check"], x["node"], x["crowded"]
        seen, held = np.zeros(len(root), np.int64), []
        few = lambda i, j: ~((known[i] | (seen[i] > MANY)) & (known[j] | (seen[j] > MANY)))
        for i, j in trie_links(x["key"], nodes, depth, shape.bits, shape.budget, same_run(root)):
            hit = (root[i] != root[j]) & (np.bitwise_count(check[i] ^ check[j]) <= apart)
            i, j = i[hit], j[hit]
            seen += np.bincount(np.concatenate([i, j]), minlength=len(seen))
            left = few(i, j)
            held.append((i[left], j[left]))
        i, j = (np.concatenate([np.empty(0, np.int64), *x]) for x in (zip(*held, strict=True) if held else ((), ())))
        left, crowded = few(i, j), np.flatnonzero((seen > MANY) & ~known)
        u, v = node[np.concatenate([i[left], crowded])], node[np.concatenate([j[left], crowded])]
        if len(u):
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(u, v)), pa.array(np.maximum(u, v))], names=["u", "v"])

    columns = {"root": "i8", "check": "u8", "node": "i8", "crowded": "?"}
    found = trie_join(nodes, Keys(plan.bits, BUDGET, len(bands)), _unpacker(plan, bands), work, "u long, v long", columns, plan.n, large_roots, most=most)
    return lean_checkpoint(found.distinct())


def crowded_links(nodes: DataFrame, plan: Plan, large_roots: list[int], most: int | None = None) -> DataFrame:
    """All candidate pairs (u, v) of crowded nodes with different roots, once each, from (node, root, bits of WIDE_WORDS words).

    The whole sketch travels with every key, so pairs that are not close enough
    are never listed; a pair is listed by the first trie that holds it.
    """
    apart, kind = plan.most_apart(64 * WIDE_WORDS, WIDE_SIGMAS), f"V{8 * WIDE_WORDS}"
    narrow = _unpacker(plan, range(plan.bands))

    def unpack(batch: pa.RecordBatch) -> dict:
        return narrow(batch) | {"wide": np.ascontiguousarray(batch.column("bits").flatten().to_numpy()).view(kind)}

    def work(shape: Keys, x: dict, nodes, depth: int) -> Iterator[pa.RecordBatch]:
        root, check, node, slot = x["root"], x["check"], x["node"], x["slot"]
        wide = x["wide"].view(np.uint64).reshape(-1, WIDE_WORDS)
        for i, j in trie_links(x["key"], nodes, depth, shape.bits, shape.budget, same_run(root)):
            hit = (root[i] != root[j]) & (np.bitwise_count(check[i] ^ check[j]) <= plan.most_apart(CHECK_BITS))
            i, j = i[hit], j[hit]
            for at in range(0, len(i), 1 << 14):
                a, b = i[at : at + (1 << 14)], j[at : at + (1 << 14)]
                near = np.bitwise_count(wide[a] ^ wide[b]).sum(axis=1, dtype=np.int64) <= apart
                a, b = a[near], b[near]
                if len(a):
                    first = shape.first_slot(_band_keys(wide[a], plan, range(plan.bands)), _band_keys(wide[b], plan, range(plan.bands))) == slot[a]
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(node[a], node[b])[first]), pa.array(np.maximum(node[a], node[b])[first])], names=["u", "v"])

    columns = {"root": "i8", "check": "u8", "node": "i8", "slot": "i4", "wide": kind}
    return trie_join(nodes, Keys(plan.bits, BUDGET, plan.bands), unpack, work, "u long, v long", columns, nodes.count(), large_roots, most=most)


def _bodies_of(some: DataFrame, nodes: DataFrame, bodies: DataFrame, out: str, of) -> DataFrame:
    """node and of(shingle set) (array<long>, named out) for the nodes of ``some``, each read once from its own row's text.

    Up to FEW nodes are broadcast, so that texts are not moved for them; more
    meet the texts by a shuffled join.
    """
    words, name = of
    wanted = lean_checkpoint(some.select("node").distinct().join(nodes.select("node", "_key"), "node"))
    if wanted.count() <= FEW:
        wanted = F.broadcast(wanted)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            got = [name(shingle_set(t, words)) for t in texts(batch.column(1))]
            flat = np.concatenate([np.empty(0, np.int64), *got])
            lists = pa.LargeListArray.from_arrays(pa.array(np.cumsum([0, *map(len, got)]), pa.int64()), pa.array(flat)).cast(pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=["node", out])

    read = bodies.join(wanted, "_key").dropDuplicates(["node"]).select("node", "_text")
    return lean_checkpoint(read.mapInArrow(run, f"node long, {out} array<long>"))


def _verified(pairs: DataFrame, nodes: DataFrame, bodies: DataFrame, plan: Plan, words: int, sure: DataFrame | None = None) -> DataFrame:
    """The pairs (u, v) whose shingle sets are similar enough: first by all bits of their sketches, which the pairs ``sure`` need not, then exactly."""

    def ends(some: DataFrame, of: DataFrame, column: str) -> DataFrame:
        for end in ("u", "v"):
            some = some.join(of.select(F.col("node").alias(end), F.col(column).alias(f"_{end}")), end)
        return some

    differing = F.aggregate(F.zip_with("_u", "_v", lambda a, b: F.bit_count(a.bitwiseXOR(b))), F.lit(0), lambda s, x: s + x)
    close = ends(pairs, nodes, "bits").filter(differing <= plan.most_apart(64 * plan.words)).select("u", "v")
    close = lean_checkpoint(close if sure is None else close.unionByName(sure))
    sets = _bodies_of(close.select(F.explode(F.array("u", "v")).alias("node")), nodes, bodies, "shingles", (words, lambda s: s.view(np.int64)))
    met = ends(close, sets, "shingles").withColumn("_both", F.size(F.array_intersect("_u", "_v")))
    return met.filter(F.col("_both") / (F.size("_u") + F.size("_v") - F.col("_both")) >= plan.similarity).select("u", "v")


def drop_near_duplicates(df: DataFrame, words: int = 5, similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text", most: int | None = None) -> DataFrame:
    """One row of each group of near-duplicates, with df's own columns.

    Rows are linked when their sets of ``words``-word shingles (A-Z lower-cased,
    fewer words: the whole sequence) have a Jaccard similarity of at least
    ``similarity``; groups are the connected components. Rows with equal sets are
    one node from the start. A first search connects most of what belongs
    together; a second one finds every candidate between the groups that the
    verified links of the first make, and all of them are checked exactly; texts
    with many candidates are compared by longer sketches before. A pair
    at the least similarity is a candidate with a probability of 0.999, closer
    ones more surely.

    The row with the least id stays (nulls last; then the least digest of its
    text, then of its other columns; of rows equal in all columns any one). Null
    texts count as empty, and empty texts form a group. Empty tables stay empty.
    most: keys of a group in one task, for tests.
    """
    spark = df.sparkSession
    prepare(spark)
    plan = Plan(df.count(), similarity)
    body = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    others = [F.col(f"`{c}`") for c in df.columns if c not in (id_col, text_col)]
    rest = F.md5(F.to_json(F.struct(*others), {"ignoreNullFields": "false"})) if others else F.lit("")
    rows = df.select(F.col(f"`{id_col}`").alias("_id"), rest.alias("_rest"), F.md5(body).alias("_digest"), body.alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t, words) for t in texts(batch.column(3))]
            names = pa.array([xxh3_128_digest(s.tobytes()) for s in sets], pa.binary())
            bits = np.concatenate([np.empty(0, np.int64), *[np.packbits(sketch(s, plan.words), bitorder="little").view(np.int64) for s in sets]])
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1, dtype=np.int32) * plan.words), pa.array(bits))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], names, lists], names=["_id", "_rest", "_digest", "_set", "bits"])

    kind = df.schema[id_col].dataType.simpleString()
    read = rows.mapInArrow(run, f"_id {kind}, _rest string, _digest string, _set binary, bits array<long>")
    best = F.min(F.struct(F.col("_id").isNull(), F.col("_id"), F.col("_digest"), F.col("_rest"))).alias("best")
    nodes = read.groupBy("_set").agg(best, F.first("bits").alias("bits"))
    # numbers are stored with the nodes; they only name them
    key_of = lambda r: row_key(r["_id"], r["_digest"], r["_rest"])
    nodes = lean_checkpoint(nodes.select(F.monotonically_increasing_id().alias("node"), "best", key_of(F.col("best")).alias("_key"), "bits"))
    bodies = rows.select(row_key(F.col("_id"), F.col("_digest"), F.col("_rest")).alias("_key"), "_text")

    first = connected_components(_verified(lean_checkpoint(close_links(nodes.select("node", "bits"), plan, most)), nodes, bodies, plan, words))
    grouped = lean_checkpoint(nodes.select("node", "bits").join(first, "node", "left").select("node", "bits", F.coalesce("root", "node").alias("root")))

    # roots that may fill a task on their own: few, as each holds so many nodes
    large = first.groupBy("root").count().filter(F.col("count") > (most or MOST // 64) // 8).select("root").collect()
    large = [r["root"] for r in large]
    # nodes that the first bands find crowded are known in the others
    start = min(FIRST_BANDS, plan.bands)
    crossing = crossing_links(grouped.withColumn("crowded", F.lit(False)), plan, range(start), large, most)
    crowded = crossing.filter("u = v").select(F.col("u").alias("node"))
    if start < plan.bands:
        marked = grouped.join(crowded.withColumn("crowded", F.lit(True)), "node", "left").withColumn("crowded", F.coalesce("crowded", F.lit(False)))
        crossing = crossing.unionByName(crossing_links(marked, plan, range(start, plan.bands), large, most)).distinct()
        crowded = crossing.filter("u = v").select(F.col("u").alias("node"))
    crowded = lean_checkpoint(crowded)
    wide = _bodies_of(crowded, nodes, bodies, "bits", (words, lambda s: np.packbits(sketch(s, WIDE_WORDS), bitorder="little").view(np.int64)))
    among = crowded_links(grouped.select("node", "root").join(wide, "node"), Plan(crowded.count(), similarity, CROWDED_BITS, CROWDED_MISSED), large, most)
    # what the tries listed of pairs of two crowded nodes, crowded_links lists too
    others = crossing.filter("u < v")
    for end in ("u", "v"):
        others = others.join(crowded.select(F.col("node").alias(end), F.lit(1).alias(f"_{end}")), end, "left")
    others = others.filter("_u is null or _v is null").select("u", "v")
    second = _verified(lean_checkpoint(others), nodes, bodies, plan, words, among)
    roots = connected_components(first.select(F.col("node").alias("u"), F.col("root").alias("v")).unionByName(second))

    rooted = nodes.select("node", "best").join(roots, "node", "left").select("best", F.coalesce("root", "node").alias("root"))
    winners = rooted.groupBy("root").agg(F.min("best").alias("b")).select(key_of(F.col("b")).alias("_key"))
    key = fresh(df, "row_digest")
    marked = df.withColumn(key, row_key(F.col(f"`{id_col}`"), F.md5(body), rest))
    return marked.join(winners, marked[key] == winners["_key"], "left_semi").dropDuplicates([key]).drop(key)
