"""N-gram Jaccard self-join by MinHash banding, with exact verification.

Equal texts form one node. Each node has the set of its word 5-grams and a MinHash signature cut
into bands; nodes that share a band's hash meet, and a pair is a link when the Jaccard similarity of
the full sets reaches the threshold. Buckets with the same members count once. A large bucket is cut
into blocks by a hash of the node, and a unit of work is a pair of blocks, so that no task gets an
unbounded group. Units return, per node, its number of links and one edge to its local group: rows
grow with the nodes, not with the pairs.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_schema, join_one, map_rows, quoted, ship, stored

WORDS, THRESHOLD = 5, 0.8
UNIT_BLOCK = 256


def choose_banding(threshold: float, recall: float, hashes: int = 96) -> tuple[int, int]:
    """Bands and rows a band: the most rows, and so the fewest needless meetings, with which a pair at the
    threshold meets with probability ``recall`` in at most so many hashes; one row a band if none will do."""
    ways = [(math.ceil(math.log(1 - recall) / math.log1p(-(threshold**rows))), rows) for rows in range(1, hashes + 1)]
    return max((w for w in ways if w[0] * w[1] <= hashes), key=lambda w: w[1], default=ways[0])


def node_of(text: Column) -> Column:
    """128 bits of SHA-256 of the text; null is the empty text."""
    return F.substring(F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256)), 1, 16)


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct n-grams of lower-cased words between ASCII white space.

    A text of fewer words has one n-gram, of all its words; one without words has none.
    """
    found = (text or "").lower().encode().split()
    if not found:
        return np.zeros(0, np.uint64)
    if len(found) < words:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(found))], np.uint64)
    h = np.array([xxhash.xxh3_64_intdigest(w) for w in found], np.uint64)
    n = len(h) - words + 1
    s = h[:n].copy()
    for j in range(1, words):
        s ^= s >> np.uint64(29)
        s *= np.uint64(0x9E3779B97F4A7C15)
        s += h[j : n + j]
    s ^= s >> np.uint64(32)
    s *= np.uint64(0xD6E8FEB86659FD93)
    s ^= s >> np.uint64(29)
    return np.unique(s)


class Signer:
    """MinHash signatures as one 64-bit hash a band."""

    def __init__(self, bands: int, rows: int, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.bands, self.rows = bands, rows
        self.a = rng.integers(0, 1 << 63, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.b = rng.integers(0, 1 << 63, bands * rows, dtype=np.uint64)

    def __call__(self, grams: np.ndarray) -> list[int]:
        if not len(grams):
            return []
        least = np.full(len(self.a), ~np.uint64(0))
        for i in range(0, len(grams), 2048):
            np.minimum(least, (grams[i : i + 2048, None] * self.a + self.b).min(0), out=least)
        raw = least.tobytes()
        step = 8 * self.rows
        return [xxhash.xxh3_64_intdigest(raw[i * step : (i + 1) * step], seed=i) - (1 << 63) for i in range(self.bands)]


def linked(sets: list[np.ndarray], first: np.ndarray, second: np.ndarray, earlier: list[frozenset], threshold: tuple[int, int]) -> tuple[np.ndarray, list[int]]:
    """Links between members of a unit: the number of each member's, and each one's local root.

    A pair is looked at when one is in the ``first`` block and the other in the ``second``, they don't
    share a bucket that comes earlier, and their sizes allow the similarity ``threshold`` (a fraction).
    """
    up, down = threshold
    m = len(sets)
    size = np.array([len(s) for s in sets], np.int64)
    count, root = np.zeros(m, np.int64), list(range(m))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    def link(i: int, j: int) -> None:
        count[i] += 1
        count[j] += 1
        a, b = find(i), find(j)
        root[max(a, b)] = min(a, b)

    if m <= 8:
        for i in range(m):
            for j in range(i + 1, m):
                if (first[i] and second[j] or first[j] and second[i]) and min(size[i], size[j]) * down >= up * max(size[i], size[j]) and not earlier[i] & earlier[j]:
                    both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                    if both * down >= up * (size[i] + size[j] - both):
                        link(i, j)
        return count, [find(i) for i in range(m)]
    _, code = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.concatenate([[0], np.cumsum(size)[:-1]])
    buckets = {b: k for k, b in enumerate(sorted(set().union(*earlier)))}
    inside = np.zeros((m, len(buckets)), np.int32)
    for i, e in enumerate(earlier):
        inside[i, [buckets[b] for b in e]] = 1
    mark = np.zeros(int(code.max()) + 1, np.int32)
    for i in range(m):
        able = (first[i] & second | second[i] & first) & (np.arange(m) > i)
        able &= np.minimum(size, size[i]) * down >= up * np.maximum(size, size[i])
        if len(buckets) and able.any():
            able &= (inside @ inside[i]) == 0
        if not able.any():
            continue
        own = code[starts[i] : starts[i] + size[i]]
        mark[own] = 1
        both = np.add.reduceat(mark[code], starts)
        mark[own] = 0
        for j in np.flatnonzero(able & (both * down >= up * (size + size[i] - both))):
            link(i, int(j))
    return count, [find(i) for i in range(m)]


def signatures(docs: DataFrame, bands: int, rows: int, words: int, id_column: str, text_column: str) -> DataFrame:
    """A stored row per document: ``doc_id, node, bands``."""

    def make():
        sign = Signer(bands, rows)
        last: dict[bytes, list[int]] = {}

        def work(columns):
            out = []
            for node, text in zip(columns[1], columns[2], strict=True):
                if node not in last:
                    if len(last) > 4096:
                        last.clear()
                    last[node] = sign(shingles(text, words))
                out.append(last[node])
            return {"doc_id": columns[0], "node": columns[1], "bands": out}

        return work

    text = F.col(text_column)
    return stored(map_rows(docs.select(F.col(id_column).cast("long"), node_of(text), text), make, "doc_id long, node binary, bands array<long>"), "signatures")


def verified(docs: DataFrame, nodes: DataFrame, words: int, threshold: tuple[int, int], text_column: str) -> DataFrame:
    """A stored row per node and unit with links: ``node, links, root``. ``nodes`` has ``node, bands``."""
    spark = docs.sparkSession
    ship(spark)
    entries = nodes.select("node", F.explode("bands").alias("bucket"))
    mix = [F.bit_xor(F.xxhash64("node")), F.bit_xor(F.xxhash64("node", F.lit(1)))]
    shared = entries.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), mix[0].alias("x"), mix[1].alias("y")).where("n > 1")
    kept = shared.groupBy("n", "x", "y").agg(F.min("bucket").alias("bucket")).select("bucket", "n")
    member = stored(entries.join(kept, "bucket"), "buckets")
    own = member.groupBy("node").agg(F.collect_list(F.struct("bucket", "n")).alias("buckets"))  # at most a bucket a band
    texts = docs.select(node_of(F.col(text_column)).alias("node"), F.coalesce(F.col(text_column), F.lit("")).alias("text")).groupBy("node").agg(F.first("text").alias("text"))

    def make():
        return lambda c: {"node": c[0], "grams": [shingles(t, words).tobytes() for t in c[2]], "buckets": c[1]}

    sets = map_rows(own.join(texts, "node").select("node", "buckets", "text"), make, "node binary, grams binary, buckets array<struct<bucket:long,n:long>>")
    cut = F.ceil(F.col("b.n") / UNIT_BLOCK).cast("int")
    units = sets.select("node", "grams", F.array_sort(F.col("buckets.bucket")).alias("all"), F.explode("buckets").alias("b"))
    units = units.select("node", "grams", "all", F.col("b.bucket").alias("bucket"), F.pmod(F.xxhash64("node"), cut).cast("int").alias("block"), F.explode(F.sequence(F.lit(0), cut - 1)).alias("other"))
    units = units.select("bucket", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "node", "grams", "all")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = units.repartition(parts, "bucket", "i", "j").sortWithinPartitions("bucket", "i", "j", "node")
    schema = "node binary, links long, root binary"
    arrow = arrow_schema(schema)

    def run(batches):
        unit, members = None, []

        def done():
            bucket, i, j = unit
            nodes_ = [n for n, _, _, _ in members]
            block = np.array([b for _, b, _, _ in members])
            earlier = [frozenset(x for x in a if x < bucket) for _, _, _, a in members]
            count, root = linked([g for _, _, g, _ in members], block == i, block == j, earlier, threshold)
            hit = np.flatnonzero(count)
            if len(hit):
                return pa.RecordBatch.from_pydict({"node": [nodes_[k] for k in hit], "links": count[hit], "root": [nodes_[root[k]] for k in hit]}, schema=arrow)
            return None

        for batch in batches:
            bucket, i, j, block, node, grams, all_ = (batch.column(k) for k in range(7))
            for r in range(batch.num_rows):
                key = (bucket[r].as_py(), i[r].as_py(), j[r].as_py())
                if key != unit:
                    if len(members) > 1 and (out := done()) is not None:
                        yield out
                    unit, members = key, []
                members.append((node[r].as_py(), block[r].as_py(), np.frombuffer(grams[r].as_py(), np.uint64), all_[r].as_py()))
        if len(members) > 1 and (out := done()) is not None:
            yield out

    return stored(dealt.mapInArrow(run, schema), "links")


def components(edges: DataFrame) -> DataFrame:
    """``node, label``: the least node of each one's connected component, for nodes with an edge.

    Each round contracts the graph: a node takes the name of the first of itself and its neighbours,
    and edges join names, until none is left. The order is that of the nodes in one round, which ends
    stars and cliques at once, and a new random one in the next, which leaves at most about three
    quarters of the names at any shape; so the rounds grow with the logarithm of a component's nodes.
    The last name in an order is never taken, so every round has fewer. Each round is stored. Edges of
    hubs, as the first node of a large class is one, are renamed by broadcast and don't meet in one task.
    """

    def simple(a: Column, b: Column) -> list[Column]:
        return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]

    def renamed(rows: DataFrame, step: DataFrame, least: int, end: str, name: str) -> DataFrame:
        names = step.select(F.col("node").alias(end), F.col("name").alias(name), "edges")
        hubs, others = names.where(F.col("edges") >= least).drop("edges"), names.where(F.col("edges") < least).drop("edges")
        return rows.join(F.broadcast(hubs), end).unionByName(rows.join(others, end))

    parts = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    left = stored(edges.where("node <> root").select(*simple(F.col("node"), F.col("root"))).distinct(), "edges")
    steps: list[DataFrame] = []
    while not left.isEmpty():
        turn = len(steps)
        near = left.select(F.col("a").alias("node"), F.col("b").alias("to")).union(left.select("b", "a"))
        place = (lambda c, turn=turn: F.struct(F.xxhash64(c, F.lit(turn)).alias("h"), F.col(c).alias("name"))) if turn % 2 else (lambda c: F.struct(F.col(c).alias("name")))
        first = near.groupBy("node").agg(F.min(place("to")).alias("first"), F.count(F.lit(1)).alias("edges"))
        step = stored(first.select("node", F.least("first", place("node"))["name"].alias("name"), "edges"), "names")
        least = max(left.count() // (4 * parts), 2)  # hubs have more edges: at most eight a task
        named = renamed(renamed(left, step, least, "a", "c"), step, least, "b", "d")
        step = step.drop("edges")
        left = stored(named.where("c <> d").select(*simple(F.col("c"), F.col("d"))).distinct(), "edges")
        steps.append(step)
    if not steps:
        return left.select(F.col("a").alias("node"), F.col("b").alias("label"))
    names = steps.pop()
    while steps:  # from the last round to the first: a name without edges is its component's last
        names = stored(steps.pop().withColumnRenamed("name", "own").join(names.withColumnRenamed("node", "own"), "own", "left").select("node", F.coalesce("name", "own").alias("name")), "names")
    return names.join(names.groupBy("name").agg(F.min("node").alias("label")), "name").select("node", "label")


def near_duplicates(
    docs: DataFrame, threshold: tuple[int, int] = (4, 5), recall: float = 0.99999, words: int = WORDS, id_column: str = "doc_id", text_column: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """Two tables: members (``doc_id, node``: a row per document) and nodes (``node, class_id,
    n_links, n_copies, keeper``: a row per distinct text).

    A link joins two different texts whose sets of lower-cased word n-grams have a Jaccard similarity
    of at least ``threshold`` (a fraction). A class is a connected component over links and equal
    texts; ``class_id`` is its least identifier (null where all are null) and ``keeper`` marks one node of it.
    ``n_links`` counts the linked texts, ``n_copies`` the rows of this text. Null and empty texts are one
    text; texts without words have no links. Repeated rows count as copies. An empty table gives empty tables.
    """
    bands, rows = choose_banding(threshold[0] / threshold[1], recall)
    signed = signatures(docs, bands, rows, words, id_column, text_column)
    nodes = stored(signed.groupBy("node").agg(F.first("bands").alias("bands"), F.min("doc_id").alias("least_id"), F.count(F.lit(1)).alias("n_copies")), "nodes")
    links = verified(docs, nodes, words, threshold, text_column)
    label = components(links)
    counted = links.groupBy("node").agg(F.sum("links").alias("n_links"))
    known = nodes.drop("bands").join(counted, "node", "left").join(label, "node", "left")
    known = stored(known.select("node", "least_id", "n_copies", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("label", "node").alias("label")), "known")
    first = F.struct(F.col("least_id").isNull(), "least_id", "node")
    best = known.groupBy("label").agg(F.min("least_id").alias("class_id"), F.min_by("node", first).alias("best"))
    result = known.join(best, "label").select("node", "class_id", "n_links", "n_copies", (F.col("node") == F.col("best")).alias("keeper"))
    return signed.select("doc_id", "node"), result


def join_documents(docs: DataFrame) -> DataFrame:
    members, nodes = near_duplicates(docs)
    return join_one(members, nodes, "node", "hot-nodes").select("doc_id", "class_id", "n_links", "n_copies")


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each class: of its kept text, the row with the least identifier.

    Null and empty texts are one class, of which one row stays. Of rows equal in identifier and text any
    one stays; null identifiers come last. All columns pass through, whatever their names; an empty table stays empty.
    """
    _, nodes = near_duplicates(docs)
    row = F.struct(*quoted(docs.columns))
    held = docs.select(node_of(F.col("text")).alias("node"), F.struct(F.col("doc_id").isNull(), F.col("doc_id")).alias("order"), row.alias("row"))
    single = held.groupBy("node").agg(F.min_by("row", "order").alias("row"))  # copies meet as partial results
    return single.join(nodes.where("keeper").select("node"), "node", "left_semi").select("row.*")
