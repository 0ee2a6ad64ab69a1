"""Benchmark decontamination by Wu-Manber multi-pattern search.

A pattern is a window of 13 words of a benchmark item, written with single
spaces around and between its words, so that a byte match is a match of whole
words. A text is normalised the same way and searched once for all patterns.
A block shift table tells how far the search may jump, the hash of a
pattern's last block selects the patterns that may end here, and a direct
comparison confirms each occurrence.

A benchmark that fits one block, the usual case, is searched for in one pass
without a shuffle. A larger one is cut into blocks, and each is one pass over
the documents, which keeps nothing but the places of hits, by the text's hash;
the driver and a worker hold one block at a time, however many there are.

Nulls and texts without a word have no words, no hits, and aren't
contaminated. Items without a word have no window. Items with a null id count
as one item, which the digest of ids doesn't name. Rows are judged one by
one, so repeated rows get equal results. Extra columns of the documents are
ignored by :func:`contamination` and kept by :func:`clean`.
"""

from __future__ import annotations

import hashlib
import uuid
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, arrow_rows, materialize, null_text, release

#: Words of a window.
WINDOW = 13
#: Contaminated from this share of hit words on: one in so many.
SHARE = 20
#: Bytes of benchmark text that one pass over the documents searches for; further text takes further passes. It is what is broadcast at once, and
#: a worker's table takes about 50 times as much.
PASS_BYTES = 8_000_000
#: Bytes of a block of the shift table; shorter patterns use their length.
BLOCK = 8
#: Patterns are searched for in groups of like length, so a short one doesn't shorten the jumps of the others.
GROUP_LENGTHS = (0, 4, 8, 16, 32, 48)

#: A-Z become a-z; other ASCII characters but digits and a-z become spaces; all bytes of other characters stay.
FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def normalise(data: bytes) -> bytes:
    """The words of a text with one space before, between and after them; empty without words."""
    text = b" " + data.translate(FOLD) + b" "
    while b"  " in text:
        text = text.replace(b"  ", b" ")
    return b"" if text == b" " else text


def windows(text: bytes, size: int = WINDOW) -> set[bytes]:
    """The windows of a normalised text; one for a text of fewer words."""
    words = text.split()
    if not words:
        return set()
    return {b" " + b" ".join(words[i : i + size]) + b" " for i in range(max(1, len(words) - size + 1))}


class WuManber:
    """Patterns of one group: their shift table and the buckets of those that end in a block."""

    def __init__(self, patterns: Iterable[bytes]):
        patterns = sorted(patterns)
        self.least = m = min(map(len, patterns))
        self.block = b = min(BLOCK, m)
        self.jump = m - b + 1
        self.shift: dict[bytes, int] = {}
        self.buckets: dict[bytes, list[bytes]] = {}
        for p in patterns:
            head = p[:m]
            for i in range(b, m + 1):
                key, far = head[i - b : i], m - i
                if self.shift.get(key, self.jump) > far:
                    self.shift[key] = far
            self.buckets.setdefault(head[m - b : m], []).append(p)

    def search(self, text: bytes) -> Iterator[tuple[int, bytes]]:
        """Each start at which a pattern occurs, and the pattern."""
        shift, jump, b, m, end = self.shift, self.jump, self.block, self.least, len(text)
        at = m
        while at <= end:
            key = text[at - b : at]
            step = shift.get(key, jump)
            if step:
                at += step
                continue
            start = at - m
            for p in self.buckets.get(key, ()):
                if text.startswith(p, start):
                    yield start, p
            at += 1


class Patterns:
    """All windows of a block of items, and the items that each belongs to."""

    def __init__(self, items: Iterable[tuple[str | None, str]], size: int = WINDOW):
        self.items: dict[bytes, list[str | None]] = {}
        for item, text in items:
            for w in windows(normalise((text or "").encode()), size):
                self.items.setdefault(w, []).append(item)
        groups: dict[int, list[bytes]] = {}
        for p in self.items:
            groups.setdefault(bisect_right(GROUP_LENGTHS, len(p)), []).append(p)
        self.groups = [WuManber(g) for _, g in sorted(groups.items())]

    def hits(self, text: bytes) -> tuple[list[tuple[int, int]], set[str | None]]:
        """Merged byte ranges that windows cover, and the items whose windows occur."""
        found, items = [], set()
        for group in self.groups:
            for start, p in group.search(text):
                found.append((start, start + len(p)))
                items.update(self.items[p])
        return merge(found), items


def merge(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Ranges that overlap, or share the space between two words, become one."""
    out: list[list[int]] = []
    for start, end in sorted(spans):
        if out and start < out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [(a, b) for a, b in out]


def _judge(text: bytes, spans: list[tuple[int, int]], items: set[str | None]) -> tuple[int, int, int, str, bool]:
    n_words = max(0, text.count(b" ") - 1)
    n_hit = sum(text.count(b" ", a, b) - 1 for a, b in spans)
    digest = hashlib.sha256(",".join(sorted(i for i in items if i is not None)).encode()).hexdigest()
    return n_words, n_hit, len(items), digest, n_hit > 0 and SHARE * n_hit >= n_words


def _item_blocks(benchmark: DataFrame, limit: int) -> Iterator[list[tuple[str | None, str]]]:
    """The benchmark in blocks of about limit bytes; the driver holds one at a time."""
    block, held = [], 0
    rows = benchmark.select(F.col("item_id").cast("string"), "text").where("text is not null").sort("item_id", "text")
    for item, text in rows.toLocalIterator():
        block.append((item, text))
        held += len(text.encode())
        if held >= limit:
            yield block
            block, held = [], 0
    if block:
        yield block


RESULT = "n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"
_FIELDS = [("n_words", pa.int64()), ("n_hit", pa.int64()), ("n_items", pa.int64()), ("items_sha256", pa.string()), ("contaminated", pa.bool_())]


def _texts(column: pa.Array) -> Iterator[bytes]:
    for x in column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()):
        yield normalise(x.as_py() or b"")


#: The tables of the block that this worker searched for last: the block's name and the window, and the tables.
_ready: list[tuple[tuple[str, int], Patterns]] = []


def _patterns(shared, token: str, window: int, built=None) -> Patterns:
    """The tables of a broadcast block, built once by each worker process; token names the block."""
    if not _ready or _ready[0][0] != (token, window):
        _ready[:] = [((token, window), Patterns(shared.value, window))]
        if built is not None:
            built.add(1)
    return _ready[0][1]


def _field(f) -> str:
    return f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}"


def _with_hits(docs: DataFrame, hits, keep_clean: bool) -> DataFrame:
    """docs with the columns of RESULT, or, with keep_clean, those that aren't contaminated; hits makes a function from a batch to text, spans and items of each row."""
    results = [] if keep_clean else [n for n, _ in _FIELDS]
    own = [f for f in docs.schema if f.name not in results and f.name != "__hits"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = hits()
        for batch in batches:
            rows = [_judge(t, s, i) for t, (s, i) in found(batch)]
            out = pa.RecordBatch.from_arrays([batch.column(f.name) for f in own], [f.name for f in own])
            if keep_clean:
                yield out.filter(pa.array([not r[4] for r in rows], pa.bool_()))
            else:
                yield pa.RecordBatch.from_arrays([*out.columns, *(pa.array([r[k] for r in rows], kind) for k, (_, kind) in enumerate(_FIELDS))], [*out.schema.names, *results])

    return docs.drop(*results).mapInArrow(run, ", ".join([*map(_field, own), *([] if keep_clean else [RESULT])]))


HIT_ROWS = "starts array<int>, ends array<int>, items array<string>"


def _blockwise(docs: DataFrame, first: list, rest: Iterator[list], window: int, built) -> DataFrame:
    """docs with __hits: by the hash of the text, the starts, ends and items of the hits of all blocks; null for most texts."""
    spark, text_hash = docs.sparkSession, F.sha2(null_text(F.col("text")), 256)
    passes = []
    kinds = [pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.string())]
    for block in chain([first], rest):
        shared, token = spark.sparkContext.broadcast(block), uuid.uuid4().hex

        def search(batches: Iterator[pa.RecordBatch], shared=shared, token=token) -> Iterator[pa.RecordBatch]:
            patterns = _patterns(shared, token, window, built)
            for batch in batches:
                rows = []
                for x in batch.column("text").cast(pa.large_binary()):
                    raw = x.as_py() or b""
                    spans, items = patterns.hits(normalise(raw))
                    if spans:
                        rows.append((hashlib.sha256(raw).hexdigest().encode(), [a for a, _ in spans], [b for _, b in spans], list(items)))
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], ["blob", "starts", "ends", "items"])

        hits = docs.select("text").mapInArrow(search, f"blob binary, {HIT_ROWS}").dropDuplicates(["blob"])
        passes.append(materialize(hits, "block-hits"))
        shared.destroy()
    found = passes[0]
    for part in passes[1:]:
        found = found.unionByName(part)
    n = found.count()
    every = found.groupBy(F.col("blob").cast("string").alias("__blob")).agg(F.struct(*(F.flatten(F.collect_list(c)).alias(c) for c in ("starts", "ends", "items"))).alias("__hits"))
    every = materialize(every, "hits", n)
    release(*passes)
    small = n <= BROADCAST_ROWS // 20
    return docs.withColumn("__blob", text_hash).join(F.broadcast(every) if small else every, "__blob", "left").drop("__blob")


def judge(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, pass_bytes: int = PASS_BYTES, keep_clean: bool = False, built=None) -> DataFrame:
    """docs with the columns of RESULT; with keep_clean only the rows that aren't contaminated, without those columns. built, an accumulator, counts the tables that workers build."""
    spark = docs.sparkSession
    arrow_rows(spark)
    blocks = _item_blocks(benchmark, pass_bytes)
    first, second = next(blocks, []), next(blocks, None)
    if second is None:
        shared, token = spark.sparkContext.broadcast(first), uuid.uuid4().hex

        def hits():
            patterns = _patterns(shared, token, window, built)
            return lambda batch: ((t, patterns.hits(t)) for t in _texts(batch.column("text")))

        return _with_hits(docs, hits, keep_clean)

    def known():
        def of(batch):
            for text, x in zip(_texts(batch.column("text")), batch.column("__hits").to_pylist(), strict=True):
                yield text, (merge(zip(x["starts"], x["ends"], strict=True)), set(x["items"])) if x else ([], set())

        return of

    return _with_hits(_blockwise(docs.drop("__hits", "__blob"), first, chain([second], blocks), window, built), known, keep_clean)


def contamination(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """doc_id and the columns of RESULT, a row per document."""
    return judge(docs.select("doc_id", "text"), benchmark, **options).drop("text")


def clean(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents, with all their columns, that aren't contaminated."""
    return judge(docs, benchmark, keep_clean=True, **options)
