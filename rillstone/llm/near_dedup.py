"""MinHash near-duplicates with an LSH forest.

A document's set is that of its distinct 5-word shingles, as 64-bit hashes.
Documents of equal sets are one node. Of each node, PERMUTATIONS minima are
taken; each order writes some of them one after another and sorts all nodes by
that. Nodes that agree on a long prefix stand together; those that agree on
MIN_DEPTH minima make a run. A node's candidates are the next nodes of its
run, of another component. How deep the agreement of neighbours goes adapts
to the region: where many nodes agree, neighbours agree on more.

A few orders, of which only adjacent nodes are compared, come first. They join
most of what belongs together, so in the TREES orders that follow, the bulk of
a large group is one component and gives no candidates any more. Candidates
are confirmed on full sets, first the best one of each component, then, with
the components that this made, the best of each of those, and at last all that
are left between different components. So a group of copies costs about as
many comparisons as it has members.

A run that goes on beyond the neighbours looked at, and has several
components, is open. Open runs with a component in common make a region,
which is finished exactly: its nodes are dealt to tiles, by size; a tile
compares the signatures of all its nodes of different components, and of those
that may be alike the full sets. There is no cap on a region's size; the work
of this last step grows with its square, its rows don't.

Orders are made by range partitioning, so a run of a third of all nodes is cut
into many partitions; rows at the cuts are compared once more, and the parts
of a cut run are put together by its prefix.

Null or empty texts, and those without words, have empty sets and are linked
with nothing. Repeated rows are linked. Rows with a null doc_id can't be named:
they are linked with nothing, have no component and are kept. If rows of one
doc_id have different texts, all get the id's component, and the text with the
smallest key of its set stands for the id. doc_id must be an integer; other
types raise. Extra columns are ignored by :func:`near_duplicates` and kept by
:func:`keep`.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import BROADCAST_ROWS, arrow_rows, materialize, release, restrict, scratch
from .components import components, union_find

SHINGLE = 5
#: Linked from this percentage of the union on.
PERCENT = 75
PERMUTATIONS = 128
#: Orders, minima that neighbours must agree on, minima that an order sorts by, and neighbours that are looked at.
#: With these, a pair at 0.75 is in no common run once in 190,000 times; all pairs of a run are looked at, or it is open.
TREES, MIN_DEPTH, MAX_DEPTH, WIDTH = 32, 4, 12, 3
#: Orders that come first, of which adjacent nodes are looked at.
FIRST_TREES = 4
#: Rounds in which each component's best candidate is confirmed, before all others are.
BEST_ROUNDS = 3
#: Signatures of a link agree on so many minima at least: a pair at 0.75 has fewer once in a hundred million times.
LEAST_EQUAL = 68
#: Bytes of a text that are split into words at once.
BLOCK = 1 << 22
#: A row with a signature counts as so many rows of numbers, where files are counted.
WIDE = 8
#: Nodes and shingles of one side of a tile, about so many at most; shingles of a tile that are compared at once.
TILE_NODES, TILE_SHINGLES, TILE_COLUMNS = 2048, 2_000_000, 2048
#: Sizes of sets are put into bands by powers of this, a bit more than 100 / PERCENT: links lie within a band or between two adjacent ones.
BAND = 1.34
#: Rows of a partition of the orders, at least and at most about so many.
ROWS_PER_PARTITION, MOST_PER_PARTITION = 20_000, 1_000_000

_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_rng = np.random.default_rng(20240101)
_MULTIPLIERS = _rng.integers(1, 1 << 63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_COEFFICIENTS = [np.uint64(int(x) * 2 + 1) for x in _rng.integers(1, 1 << 62, SHINGLE)]


def word_hashes(data: bytes) -> np.ndarray:
    """64-bit hashes of the words of a text, A-Z in lower case."""
    parts, at, data = [], 0, data.lower()
    while at < len(data):
        end = at + BLOCK
        if end < len(data):
            space = _SPACE.search(data, end)
            end = space.start() if space else len(data)
        words = data[at:end].split()
        parts.append(np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words)))
        at = end
    return np.concatenate(parts) if parts else np.empty(0, np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(29))


def shingles(text: bytes) -> np.ndarray:
    """The sorted distinct hashes of a document's shingles."""
    words = word_hashes(text)
    if not len(words):
        return words
    if len(words) < SHINGLE:
        whole = xxhash.xxh64_intdigest(words.tobytes(), seed=len(words))
        return np.array([whole], np.uint64)
    n = len(words) - SHINGLE + 1
    total = np.zeros(n, np.uint64)
    for k, c in enumerate(_COEFFICIENTS):
        total += words[k : k + n] * c
    return np.unique(_mix(total))


def signature(hashes: np.ndarray) -> np.ndarray:
    """16 bits of each permutation's minimum."""
    least = np.full(PERMUTATIONS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), 1024):
        np.minimum(least, (_MULTIPLIERS[:, None] * hashes[None, at : at + 1024]).min(axis=1), out=least)
    return (_mix(least) >> np.uint64(40)).astype(">u2")


def _texts(batch: pa.RecordBatch) -> Iterator[bytes]:
    for x in batch.column("text").cast(pa.large_binary()):
        yield x.as_py() or b""


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, keys, signs = [], [], []
        for text in _texts(batch):
            found = shingles(text)
            sizes.append(len(found))
            keys.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest() if len(found) else None)
            signs.append(signature(found).tobytes() if len(found) else None)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(signs, pa.binary())], ["doc_id", "n_shingles", "set_key", "signature"])


def _binary(rows: np.ndarray) -> pa.Array:
    """Rows of a matrix as binary values."""
    rows = np.ascontiguousarray(rows)
    width = rows.shape[1] * rows.itemsize
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(rows.tobytes())])


ORDER_ROWS = "tree int, key binary, doc_id long, n long, component long"


def _orders(turn: int, trees: int):
    """A function that gives each node's key in each tree; every turn has orders of its own."""
    rng = np.random.default_rng(1000 + turn)
    take = []
    for _ in range(-(-trees * MIN_DEPTH // PERMUTATIONS)):
        take += list(rng.permutation(PERMUTATIONS))
    firsts = np.array(take[: trees * MIN_DEPTH]).reshape(trees, MIN_DEPTH)
    places = np.array([[*f, *[p for p in rng.permutation(PERMUTATIONS) if p not in f][: MAX_DEPTH - MIN_DEPTH]] for f in firsts])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            signs = _matrix(batch.column("signature"), PERMUTATIONS)
            keys = signs[:, places].reshape(n * trees, MAX_DEPTH)
            own = [pa.array(np.repeat(_longs(batch.column(c)), trees)) for c in ("doc_id", "n_shingles", "component")]
            yield pa.RecordBatch.from_arrays([pa.array(np.tile(np.arange(trees, dtype=np.int32), n)), _binary(keys), *own], ["tree", "key", "doc_id", "n", "component"])

    return run


def _longs(column) -> np.ndarray:
    return np.asarray(column.to_numpy(zero_copy_only=False), np.int64)


def _matrix(column, width: int) -> np.ndarray:
    """Binary values of one length as rows of a matrix."""
    return np.frombuffer(b"".join(x.as_py() for x in column), ">u2").reshape(len(column), width)


#: What a partition of an order gives: PAIR candidates; OUTER rows, for pairs across cuts; EDGEs between components of an open run; and of
#: runs that may be cut, a PART for each component (n counts the part's nodes, once).
PAIR, OUTER, EDGE, PART = range(4)
NEAR = pa.schema([("what", pa.int32()), ("a", pa.int64()), ("b", pa.int64()), ("depth", pa.int32()), ("ca", pa.int64()), ("cb", pa.int64()), ("n", pa.int64()), ("tree", pa.int32()), ("key", pa.binary()), ("part", pa.int32())])
NEAR_ROWS = "what int, a long, b long, depth int, ca long, cb long, n long, tree int, key binary, part int"


def _near(what: int, size: int, **columns) -> pa.RecordBatch:
    columns["what"] = np.full(size, what, np.int32)
    return pa.RecordBatch.from_arrays([(x if isinstance(x, pa.Array) else pa.array(x, f.type)) if (x := columns.get(f.name)) is not None else pa.nulls(size, f.type) for f in NEAR], schema=NEAR)


def _pairs(rows: list[np.ndarray], width: int, part: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
    """Candidates among sorted rows; with part, only those of different partitions."""
    tree, key, ids, n, component = rows
    for step in range(1, width + 1):
        if len(ids) <= step:
            break
        good = (tree[step:] == tree[:-step]) & (key[step:, :MIN_DEPTH] == key[:-step, :MIN_DEPTH]).all(axis=1) & (component[step:] != component[:-step])
        small, large = np.minimum(n[step:], n[:-step]), np.maximum(n[step:], n[:-step])
        good &= 100 * small >= PERCENT * large
        if part is not None:
            good &= part[step:] != part[:-step]
        x = np.flatnonzero(good)
        y = x + step
        depth = np.cumprod(key[x] == key[y], axis=1, dtype=np.int32).sum(axis=1, dtype=np.int32)
        x, y = np.where(ids[x] < ids[y], x, y), np.where(ids[x] < ids[y], y, x)
        if len(x):
            yield _near(PAIR, len(x), a=ids[x], b=ids[y], depth=depth, ca=component[x], cb=component[y])


def _read(batches: Iterator[pa.RecordBatch]) -> tuple[list[np.ndarray], pa.Table] | None:
    table = [b for b in batches if b.num_rows]
    if not table:
        return None
    table = pa.Table.from_batches(table)
    return [table.column("tree").to_numpy(), _matrix(table.column("key"), MAX_DEPTH), *(table.column(c).to_numpy() for c in ("doc_id", "n", "component"))], table


def _neighbours(width: int, closing: bool):
    """A function that looks at one partition of the orders: its candidates and outer rows, and with closing the components of open runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if (found := _read(batches)) is None:
            return
        rows, _ = found
        tree, key, ids, n, component = rows
        m = len(ids)
        yield from _pairs(rows, width)
        part = TaskContext.get().partitionId()
        outer = np.arange(m) if m <= 2 * width else np.r_[0:width, m - width : m]
        yield _near(OUTER, len(outer), a=ids[outer], ca=component[outer], n=n[outer], tree=tree[outer], key=_binary(key[outer]), part=np.full(len(outer), part, np.int32))
        if not closing:
            return
        new = np.r_[True, (tree[1:] != tree[:-1]) | (key[1:, :MIN_DEPTH] != key[:-1, :MIN_DEPTH]).any(axis=1)]
        first, run_of = np.flatnonzero(new), np.cumsum(new) - 1
        sizes = np.diff(np.r_[first, m])
        least, most = np.minimum.reduceat(component, first), np.maximum.reduceat(component, first)
        cut = np.zeros(len(first), bool)
        cut[[0, -1]] = True
        inside = ((sizes > width + 1) & (least != most) & ~cut)[run_of] & (component != least[run_of])
        edges = np.unique(np.stack([least[run_of][inside], component[inside]], axis=1), axis=0)
        if len(edges):
            yield _near(EDGE, len(edges), a=edges[:, 0], b=edges[:, 1])
        for r in np.flatnonzero(cut):
            own = np.unique(component[first[r] : first[r] + sizes[r]])
            k = len(own)
            yield _near(PART, k, a=own, n=np.r_[sizes[r], np.zeros(k - 1, np.int64)], tree=np.full(k, tree[first[r]], np.int32), key=pa.array([key[first[r], :MIN_DEPTH].tobytes()] * k, pa.binary()))

    return run


def _across(width: int):
    """A function that gives the candidates among the outer rows of all partitions, in order, that stand in different ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if (found := _read(batches)) is not None:
            yield from _pairs(found[0], width, found[1].column("part").to_numpy())

    return run


def with_component(df: DataFrame, key: str, labels: DataFrame | None, name: str = "component") -> DataFrame:
    """df with the component of the node in key, which is itself where no link is known. labels are broadcast up to a checked number."""
    if labels is None:
        return df.withColumn(name, F.col(key))
    own = labels.select(F.col("node").alias(key), F.col("component").alias("__component"))
    own = F.broadcast(own) if labels.limit(BROADCAST_ROWS // 2 + 1).count() <= BROADCAST_ROWS // 2 else own
    return df.join(own, key, "left").withColumn(name, F.coalesce("__component", key)).drop("__component")


def candidates(nodes: DataFrame, labels: DataFrame | None, turn: int, trees: int, width: int, closing: bool) -> tuple[DataFrame, DataFrame | None]:
    """Candidate pairs a, b with ca, cb (their components), votes (orders in which they are near) and depth; and with closing, edges (a, b) between components of open runs. Materialized.

    nodes has doc_id, n_shingles and signature.
    """
    spark = nodes.sparkSession
    n = nodes.count() * trees
    arrow_rows(spark, 2000)
    parts = max(1, n // MOST_PER_PARTITION, min(int(spark.conf.get("spark.sql.shuffle.partitions")), n // ROWS_PER_PARTITION))
    named = with_component(nodes.select("doc_id", "n_shingles", "signature"), "doc_id", labels)
    rows = named.mapInArrow(_orders(turn, trees), ORDER_ROWS)
    by = ("tree", "key", "doc_id")
    near = materialize(rows.repartitionByRange(parts, *by).sortWithinPartitions(*by).mapInArrow(_neighbours(width, closing), NEAR_ROWS), "near", n)
    cut = near.where(F.col("what") == OUTER).select("tree", "key", F.col("a").alias("doc_id"), "n", F.col("ca").alias("component"), "part")
    across = cut.repartition(1).sortWithinPartitions(*by).mapInArrow(_across(width), NEAR_ROWS)  # six rows of each partition at most
    pairs = near.where(F.col("what") == PAIR).unionByName(across)
    votes = pairs.groupBy("a", "b").agg(F.min("ca").alias("ca"), F.min("cb").alias("cb"), F.count("*").alias("votes"), F.max("depth").alias("depth"))
    seen = near.count()
    votes = materialize(votes, "candidates", seen)
    edges = None
    if closing:
        part = near.where(F.col("what") == PART).select("tree", "key", F.col("a").alias("component"), "n")
        runs = part.groupBy("tree", "key").agg(F.sum("n").alias("n"), F.min("component").alias("least"), F.max("component").alias("most")).where((F.col("n") > width + 1) & (F.col("least") != F.col("most")))
        more = part.join(runs.select("tree", "key", F.col("least").alias("a")), ["tree", "key"]).where("component <> a").select("a", F.col("component").alias("b"))
        edges = near.where(F.col("what") == EDGE).select("a", "b").unionByName(more).distinct()
        edges = materialize(edges, "open-runs", seen)
    release(near)
    return votes, edges


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [shingles(t).view(np.int64) for t in _texts(batch)]
        offsets = np.cumsum([0, *map(len, found)]).astype(np.int32)
        values = pa.array(np.concatenate(found) if found else np.empty(0, np.int64))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.ListArray.from_arrays(pa.array(offsets), values)], ["doc_id", "hashes"])


class FullSets:
    """doc_id and hashes of documents that were asked for so far; each is made once."""

    def __init__(self, docs: DataFrame):
        self.docs, self.parts = docs, []

    def of(self, ids: DataFrame) -> DataFrame:
        """The sets made so far, among them those of ids, which are materialized and distinct."""
        wanted = ids
        for part in self.parts:
            wanted = wanted.join(part.select("doc_id"), "doc_id", "left_anti")
        wanted = materialize(wanted, "wanted-sets", ids.count()) if self.parts else ids
        if wanted.limit(1).count():
            arrow_rows(self.docs.sparkSession)
            rows = restrict(self.docs.select("doc_id", "text"), wanted, "doc_id", True).mapInArrow(_sets, "doc_id long, hashes array<long>")
            self.parts.append(materialize(rows, "sets"))
        if self.parts and wanted is not ids:
            release(wanted)
        out = self.parts[0]
        for part in self.parts[1:]:
            out = out.unionByName(part)
        return out

    def release(self) -> None:
        release(*self.parts)
        self.parts = []


def confirm(pairs: DataFrame, sets: FullSets, n: int) -> DataFrame:
    """The pairs, n at most, with linked: whether their full sets are alike enough. Materialized.

    A node is in 2 * WIDTH * TREES pairs at most, so no key is hot.
    """
    ids = materialize(pairs.select(F.col("a").alias("doc_id")).unionByName(pairs.select(F.col("b").alias("doc_id"))).distinct(), "pair-ids", 2 * n)
    all_sets = restrict(sets.of(ids), ids, "doc_id", True)
    a, b = (all_sets.select(F.col("doc_id").alias(x), F.col("hashes").alias(f"h{x}")) for x in "ab")
    both = pairs.join(a, "a").join(b, "b").withColumn("__shared", F.size(F.array_intersect("ha", "hb")).cast("long"))
    union = F.size("ha") + F.size("hb") - F.col("__shared")
    out = materialize(both.select(*pairs.columns, (100 * F.col("__shared") >= PERCENT * union).alias("linked")), "confirmed", n)
    release(ids)
    return out


def _joined(labels: DataFrame | None, links: DataFrame, n: int) -> DataFrame:
    """The labels after further links (a, b) between components."""
    found = components(links)
    if labels is None:
        return found
    more = found.select(F.col("node").alias("component"), F.col("component").alias("__to"))
    old = labels.join(more, "component", "left").select("node", F.coalesce("__to", "component").alias("component"))
    fresh = more.join(labels.select(F.col("node").alias("component")), "component", "left_anti").select(F.col("component").alias("node"), F.col("__to").alias("component"))
    out = materialize(old.unionByName(fresh), "labels", n)
    release(labels, found)
    return out


def _plausible(pairs: DataFrame, nodes: DataFrame, n: int) -> DataFrame:
    """The pairs, n at most, whose signatures agree as those of a link do. Materialized."""
    a, b = (nodes.select(F.col("doc_id").alias(x), F.col("signature").alias(f"s{x}")) for x in "ab")
    arrow_rows(nodes.sparkSession, 2000)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, y = (_matrix(batch.column(c), PERMUTATIONS) for c in ("sa", "sb"))
                alike = (x == y).sum(axis=1) >= LEAST_EQUAL
                yield batch.filter(pa.array(alike)).drop_columns(["sa", "sb"])

    both = pairs.join(a, "a").join(b, "b").select(*pairs.columns, "sa", "sb")
    return materialize(both.mapInArrow(run, pairs.schema), "plausible", n)


def contract(pairs: DataFrame, labels: DataFrame | None, sets: FullSets, nodes: DataFrame) -> DataFrame | None:
    """The labels after all links among the candidate pairs that join components.

    In each of BEST_ROUNDS rounds, the best pair of each component is
    confirmed, and what it joins needs no other pair; the last round confirms
    all that are left between different components.
    """
    n, at = pairs.count(), nodes.count()
    rest = _plausible(pairs, nodes, n)
    rounds = BEST_ROUNDS
    while n := rest.count():
        todo, rounds = rest, rounds - 1
        if rounds >= 0:
            ends = rest.select(F.col("ca").alias("component"), *rest.columns).unionByName(rest.select(F.col("cb").alias("component"), *rest.columns))
            best = ends.groupBy("component").agg(F.max(F.struct("votes", "depth", "a", "b", "ca", "cb")).alias("x"))
            todo = materialize(best.select("x.*").select(*rest.columns).distinct(), "best", n)
            if 2 * todo.count() >= n:  # most are someone's best
                release(todo)
                todo, rounds = rest, -1
        confirmed = confirm(todo, sets, n)
        links = materialize(confirmed.where("linked").select(F.least("ca", "cb").alias("a"), F.greatest("ca", "cb").alias("b")).distinct(), "new-links", n)
        if links.limit(1).count():
            labels = _joined(labels, links, 2 * at)
        else:
            rounds = min(rounds, 0)
        if todo is rest:
            release(links, confirmed)
            break
        left = rest.join(confirmed.select("a", "b"), ["a", "b"], "left_anti")
        left = with_component(with_component(left.drop("ca", "cb"), "a", labels, "ca"), "b", labels, "cb").where("ca <> cb")
        left = materialize(left.select(*rest.columns), "rest", n)
        release(rest, links, confirmed, todo)
        rest = left
    release(rest)
    return labels


def _tile(rows: pa.Table) -> pa.Table:
    """Links (a, b) between components, as few as join what is alike in a tile; every pair of the two sides, or of the only one, is compared."""
    rows = rows.combine_chunks()
    ids, side = (rows.column(c).to_numpy() for c in ("component", "side"))
    lists = rows.column("hashes").combine_chunks()
    sizes = lists.value_lengths().to_numpy().astype(np.int64)
    _, columns, counts = np.unique(lists.flatten().to_numpy(), return_inverse=True, return_counts=True)
    at = np.repeat(np.arange(len(ids)), sizes)
    several = counts > 1  # what one node alone has is shared with none
    inside = several[columns]
    at, columns = at[inside], (np.cumsum(several) - 1)[columns[inside]]
    order = np.argsort(columns, kind="stable")
    at, columns = at[order], columns[order]
    left = np.flatnonzero(side == 0)
    right = np.flatnonzero(side == 1)
    right = right if len(right) else left
    shared = np.zeros((len(left), len(right)), np.float32)
    for first in range(0, int(several.sum()), TILE_COLUMNS):
        low, high = np.searchsorted(columns, (first, first + TILE_COLUMNS))
        has = np.zeros((len(ids), TILE_COLUMNS), np.float32)
        has[at[low:high], columns[low:high] - first] = 1
        shared += has[left] @ has[right].T
    shared = shared.astype(np.int64)
    alike = (100 + PERCENT) * shared >= PERCENT * (sizes[left][:, None] + sizes[right][None, :])
    x, y = np.nonzero(alike & (ids[left][:, None] != ids[right][None, :]))
    a, b = ids[left][x], ids[right][y]
    pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0)
    found = list(union_find(iter([pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])])))
    if not found:
        return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
    joined = pa.Table.from_batches(found)
    to, node = joined.column("component").to_numpy(), joined.column("node").to_numpy()
    return pa.table({"a": to[to != node], "b": node[to != node]})


def _alike_signatures(rows: pa.Table) -> pa.Table:
    """The nodes (doc_id) of a tile whose signatures agree, as those of a link do, with one of another component on the other side."""
    rows = rows.combine_chunks()
    ids, side, component = (rows.column(c).to_numpy() for c in ("doc_id", "side", "component"))
    signs = _matrix(rows.column("signature"), PERMUTATIONS)
    left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    right = right if len(right) else left
    hit = np.zeros(len(ids), bool)
    for x in np.array_split(left, max(1, len(left) // 256)):
        equal = np.zeros((len(x), len(right)), np.uint8)
        for p in range(PERMUTATIONS):
            equal += signs[x, p][:, None] == signs[right, p][None, :]
        alike = (equal >= LEAST_EQUAL) & (component[x][:, None] != component[right][None, :])
        hit[x] |= alike.any(axis=1)
        hit[right] |= alike.any(axis=0)
    return pa.table({"doc_id": ids[hit]})


def _placed(members: DataFrame, n: int) -> DataFrame:
    """tile, side, component and doc_id: each pair of members of a region whose sizes allow a link meets in a tile. Materialized.

    members are n rows of node, region, component and n. A component that
    fills tiles of its own isn't compared with itself.
    """
    members = members.withColumn("band", F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(BAND))).cast("int"))
    large = members.groupBy("region", "component").count().where(F.col("count") >= TILE_NODES).select("region", "component", F.lit(True).alias("large"))
    members = members.join(large, ["region", "component"], "left").withColumn("large", F.coalesce("large", F.lit(False)))
    members = members.withColumn("of", F.when(F.col("large"), F.col("component")).otherwise(F.lit(0).cast("long")))
    members = materialize(members.select("node", "region", "component", "n", "band", "large", "of"), "members", n)
    cell = ["region", "large", "of", "band"]
    cells = members.groupBy(*cell).agg(F.ceil(F.greatest(F.count("*") / TILE_NODES, F.sum("n") / TILE_SHINGLES)).cast("long").alias("blocks"))
    cells = materialize(cells, "cells", n)
    blocks = cells.select(*cell, F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"))
    own = F.struct("large", "of", "block")
    x = blocks.select("region", F.col("band").alias("xb"), own.alias("x"), F.explode(F.array(F.col("band"), F.col("band") + 1)).alias("yb"))
    y = blocks.select("region", F.col("band").alias("yb"), own.alias("y"))
    both = x.join(y, ["region", "yb"]).where(((F.col("xb") < F.col("yb")) | (F.col("x") <= F.col("y"))) & ~(F.col("x.large") & F.col("y.large") & (F.col("x.of") == F.col("y.of"))))
    name = F.concat_ws(":", *(c.cast("string") for c in map(F.col, ("region", "xb", "x.large", "x.of", "x.block", "yb", "y.large", "y.of", "y.block"))))
    same = (F.col("xb") == F.col("yb")) & (F.col("x") == F.col("y"))
    sides = F.array(F.struct(F.col("xb").alias("band"), F.col("x").alias("own"), F.lit(0).alias("side")), F.struct(F.col("yb").alias("band"), F.col("y").alias("own"), F.lit(1).alias("side")))
    tiles = both.select("region", name.alias("tile"), F.explode(F.when(same, F.slice(sides, 1, 1)).otherwise(sides)).alias("s")).select("region", "tile", "s.band", "s.own.*", "s.side")
    placed = members.join(cells, cell).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    placed = materialize(placed.join(tiles, [*cell, "block"]).select("tile", "side", "component", F.col("node").alias("doc_id")), "placed")
    release(members, cells)
    return placed


def finish(nodes: DataFrame, labels: DataFrame | None, edges: DataFrame, sets: FullSets) -> DataFrame | None:
    """The labels after all links within open regions, found by comparing all nodes there whose sizes allow a link. edges join components of open runs."""
    n, at = edges.count(), nodes.count()
    if not n:
        return labels
    now = with_component(with_component(edges.select(F.col("a").alias("x"), F.col("b").alias("y")), "x", labels, "a"), "y", labels, "b").where("a <> b")
    now = materialize(now.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "open-edges", n)
    if not now.limit(1).count():
        release(now)
        return labels
    found = components(now)
    regions = found.select(F.col("node").alias("component"), F.col("component").alias("region"))
    members = with_component(nodes.select(F.col("doc_id").alias("node"), F.col("n_shingles").alias("n")), "node", labels)
    regions = F.broadcast(regions) if found.limit(BROADCAST_ROWS // 2 + 1).count() <= BROADCAST_ROWS // 2 else regions
    members = materialize(members.join(regions, "component"), "open-nodes", at)
    placed = _placed(members, at)
    rows = placed.join(nodes.select("doc_id", "signature"), "doc_id").select("tile", "side", "component", "doc_id", "signature")
    alike = materialize(rows.groupBy("tile").applyInArrow(_alike_signatures, "doc_id long").distinct(), "alike", at)
    release(placed)
    if alike.limit(1).count():
        fewer = materialize(members.join(alike.withColumnRenamed("doc_id", "node"), "node", "left_semi"), "alike-nodes", at)
        placed = _placed(fewer, at)
        rows = placed.join(sets.of(alike), "doc_id").select("tile", "side", "component", "hashes")
        links = materialize(rows.groupBy("tile").applyInArrow(_tile, "a long, b long").distinct(), "exact-links", at)
        if links.limit(1).count():
            labels = _joined(labels, links, 2 * at)
        release(fewer, placed, links)
    release(now, found, members, alike)
    return labels


def link(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """node and component of the nodes that have a link. docs has the texts, nodes one row of each set."""
    sets = FullSets(docs)
    pairs, _ = candidates(nodes, None, 1, FIRST_TREES, 1, False)
    labels = contract(pairs, None, sets, nodes)
    release(pairs)
    pairs, edges = candidates(nodes, labels, 0, TREES, WIDTH, True)
    labels = contract(pairs, labels, sets, nodes)
    release(pairs)
    labels = finish(nodes, labels, edges, sets)
    release(edges)
    sets.release()
    return docs.sparkSession.createDataFrame([], "node long, component long") if labels is None else labels


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of each document."""
    spark = docs.sparkSession
    if not isinstance(docs.schema["doc_id"].dataType, T.IntegralType):
        raise TypeError(f"doc_id must be an integer, not {docs.schema['doc_id'].dataType.simpleString()}")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    arrow_rows(spark)
    signed = signatures = materialize(docs.mapInArrow(_sign, "doc_id long, n_shingles long, set_key binary, signature binary"), "signatures")
    n = signed.count()
    mixed = signed.where("doc_id is not null").groupBy("doc_id").agg(F.min("set_key").alias("least"), F.max("set_key").alias("most"), F.count_if(F.col("set_key").isNull()).alias("empty"))
    mixed = mixed.where("least <> most or (least is not null and empty > 0)").select("doc_id", "least")
    mixed = materialize(mixed, "ids-of-several-texts", n)
    if mixed.limit(1).count():
        both = signed.join(mixed, "doc_id", "left")
        own = F.col("least").isNull() | F.col("set_key").eqNullSafe(F.col("least"))
        signed = both.select("doc_id", "n_shingles", F.coalesce("least", "set_key").alias("set_key"), F.when(own, F.col("signature")).alias("signature"))
    named = signed.where("set_key is not null and doc_id is not null")
    several = named.where("signature is not null").groupBy("set_key").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    several = materialize(several, "equal-sets", n)
    ids = signed.select("doc_id", "n_shingles", "set_key")
    # the side of the equal sets has each key once; what a third of all documents share is split by adaptive execution
    firsts = materialize(ids.join(several, "set_key", "left").select("doc_id", "n_shingles", "set_key", F.when(F.col("doc_id").isNotNull(), F.coalesce("first", "doc_id")).alias("first")), "firsts", n)
    others = materialize(firsts.where("first <> doc_id").select("doc_id").distinct(), "others", n)
    nodes = restrict(named.where("signature is not null").select("doc_id", "n_shingles", "signature"), others, "doc_id", False)
    nodes = materialize(nodes.dropDuplicates(["doc_id"]), "nodes", WIDE * n)
    release(signatures, several, others, mixed)
    labels = link(docs, nodes)
    release(nodes)
    out = with_component(firsts.where("doc_id is not null"), "first", labels, "component_id").select("doc_id", "n_shingles", "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept"))
    nameless = firsts.where("doc_id is null").select("doc_id", "n_shingles", F.col("first").alias("component_id"), F.lit(True).alias("kept"))
    return out.unionByName(nameless)


def keep(docs: DataFrame) -> DataFrame:
    """The documents, with all their columns, that near_duplicates() keeps: one of each component, and one of rows that repeat a doc_id; all without one."""
    with scratch() as stays:
        found = near_duplicates(docs).where("doc_id is not null")
        found = materialize(found.groupBy("doc_id").agg(F.count("*").alias("n"), F.max("kept").alias("kept")).where("not kept or n > 1"), "dropped-or-repeated")
        n = found.count()
        out = stays(materialize(found.where("not kept").select("doc_id"), "dropped", n))
        repeated = stays(materialize(found.where("kept").select("doc_id"), "repeated", n))
    left = restrict(docs, out, "doc_id", False)
    if not repeated.limit(1).count():
        return left
    return restrict(left, repeated, "doc_id", False).unionByName(restrict(left, repeated, "doc_id", True).dropDuplicates(["doc_id"]))
