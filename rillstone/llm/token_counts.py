"""Token counts of byte-level BPE by heap-and-linked-list merging.

A text is split by the pattern of the vocabulary; each piece starts as a
linked list of its bytes. A heap holds the ranks of adjacent pairs; the lowest
is popped, merged, and the pairs with its two neighbours are pushed, until no
pair has a rank. The piece counts as its bytes less its merges; no identifier
is made. Pieces that return are looked up.

Null and empty texts have no bytes and no tokens. A special token's string in
a text is one token, as by the library's default. Repeated rows get equal
counts; extra columns are ignored.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame

from .common import arrow_rows

#: Tokens beyond which a document is over the limit.
LIMIT = 1024
#: The piece pattern of the byte-level vocabularies (a fixed value).
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Pieces remembered by a worker; then it starts anew.
REMEMBERED = 200_000
#: Longer pieces aren't remembered.
LONG_PIECE = 64
#: Pieces of a text are listed at once up to so many characters, beyond that one by one.
LONG_TEXT = 1_000_000


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary file: printable Latin-1 bytes stand for themselves, the others follow from U+0100 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def read_vocabulary(path: str) -> tuple[dict[tuple[int, int], tuple[int, int]], dict[int, int], list[str]]:
    """Merges as (left, right) -> (rank, joined), the symbol of each byte, and the special strings.

    Symbols are numbered here, in the order in which they first occur; they
    aren't the vocabulary's identifiers.
    """
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    letters = byte_letters()
    symbols: dict[str, int] = {}
    number = lambda s: symbols.setdefault(s, len(symbols))
    single = {b: number(c) for c, b in letters.items()}
    merges = {}
    for rank, pair in enumerate(spec["model"]["merges"]):
        left, right = pair.split(" ") if isinstance(pair, str) else pair
        merges[number(left), number(right)] = (rank, number(left + right))
    return merges, single, [t["content"] for t in spec.get("added_tokens", ()) if t["content"]]


class Counter(dict):
    """Counts the tokens of texts; as a dict it holds the counts of pieces seen."""

    def __init__(self, path: str):
        super().__init__()
        self.merges, self.single, special = read_vocabulary(path)
        self.pattern = regex.compile(PIECES)
        self.special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None

    def __missing__(self, piece: str) -> int:
        n = self.piece(piece.encode("utf-8", "surrogatepass"))
        if len(piece) <= LONG_PIECE:
            if len(self) >= REMEMBERED:
                self.clear()
            self[piece] = n
        return n

    def piece(self, data: bytes) -> int:
        """Bytes of a piece less its merges."""
        n = len(data)
        if n < 2:
            return n
        single, merges = self.single, self.merges
        symbol = [single[b] for b in data]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []
        for i in range(n - 1):
            found = merges.get((symbol[i], symbol[i + 1]))
            if found:
                heap.append((found[0], i, found[1]))
        heapq.heapify(heap)
        left = n
        while heap:
            _, i, joined = heapq.heappop(heap)
            j = after[i] if symbol[i] >= 0 else n
            found = merges.get((symbol[i], symbol[j])) if j < n else None
            if not found or found[1] != joined:
                continue  # one of the two symbols was merged meanwhile
            symbol[i], symbol[j] = joined, -1
            k = after[i] = after[j]
            left -= 1
            if k < n:
                before[k] = i
                if right := merges.get((joined, symbol[k])):
                    heapq.heappush(heap, (right[0], i, right[1]))
            h = before[i]
            if h >= 0 and (ahead := merges.get((symbol[h], joined))):
                heapq.heappush(heap, (ahead[0], h, ahead[1]))
        return left

    def plain(self, text: str) -> int:
        if len(text) <= LONG_TEXT:
            return sum(map(self.__getitem__, self.pattern.findall(text)))
        return sum(self[m.group()] for m in self.pattern.finditer(text))

    def count(self, text: str) -> int:
        """Tokens of a whole text."""
        if not self.special or not self.special.search(text):
            return self.plain(text)
        n = at = 0
        for m in self.special.finditer(text):
            n += self.plain(text[at : m.start()]) + 1
            at = m.end()
        return n + self.plain(text[at:])


_counters: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    """The counter of a vocabulary, one for a worker process."""
    if path not in _counters:
        _counters[path] = Counter(path)
    return _counters[path]


def token_counts(docs: DataFrame, vocabulary: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (n_tokens > limit) of each document.

    vocabulary is a file that the driver can read; Spark hands it to the executors.
    """
    spark = docs.sparkSession
    arrow_rows(spark)
    spark.sparkContext.addFile(vocabulary)
    name = vocabulary.rsplit("/", 1)[-1]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = counter(SparkFiles.get(name))
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            counts = [tokens.count(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(t.encode("utf-8", "surrogatepass")) for t in texts], pa.int64()), pa.array(counts, pa.int64()), pa.array([n > limit for n in counts], pa.bool_())],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(count, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")
