"""Near duplicates by SimHash and a byte-position inverted index with count filtering.

Two 64-bit fingerprints that differ in at most 4 bits differ in at most 4 of their
8 bytes, so at least 4 bytes are equal at their positions: the guaranteed minimum.
The index has postings for 20 triples of positions, chosen so that any 4 positions
contain one of them; every pair with 4 shared bytes therefore meets in a posting
list. For each pair met, the shared bytes are tallied, pairs below the minimum go,
and the rest are verified bit by bit. Equal fingerprints are one entry, and a list
gives at most one edge less than it has entries, so nothing grows with the square
of a group of copies.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyroll.llm.common import free_name, row_keyed, staged
from tallyroll.llm.graph import components

BYTES = 8
MAX_BITS = 4
MIN_SHARED = BYTES - MAX_BITS
#: Words of a shingle and seed of its hash.
WORDS, SEED = 4, 42
#: Entries of a posting list that one task compares; longer lists take the way of ``_dense_links``.
LIST_LIMIT = 16_384
_BLOCK = 65_536


def position_triples() -> list[tuple[int, int, int]]:
    """20 triples of the 8 positions such that any 4 positions contain one.

    Positions form three classes. A triple is taken inside a class, or with two
    positions of a class and one of the next.
    """
    kind = [i % 3 for i in range(BYTES)]
    out = []
    for t in combinations(range(BYTES), 3):
        n = [sum(kind[i] == c for i in t) for c in range(3)]
        if 3 in n or any(n[c] == 2 and n[(c + 1) % 3] == 1 for c in range(3)):
            out.append(t)
    return out


def fingerprint(text: str | None) -> int:
    """Unsigned 64-bit SimHash of a whole text; zero without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(size + 1) - 1
    starts = ends - size
    span = min(WORDS, len(words)) - 1
    starts, ends = starts[: len(words) - span].tolist(), ends[span:].tolist()
    digest = xxhash.xxh64_intdigest
    total = np.zeros(64, np.int64)
    for at in range(0, len(starts), _BLOCK):
        spans = zip(starts[at : at + _BLOCK], ends[at : at + _BLOCK], strict=True)
        h = np.array([digest(joined[a:b], SEED) for a, b in spans], dtype="<u8")
        bits = np.unpackbits(h.view(np.uint8), bitorder="little").reshape(-1, 64)
        for row in range(0, len(bits), 255):  # sums of 255 bits fit a byte
            total += np.add.reduce(bits[row : row + 255], axis=0, dtype=np.uint8)
    return int(np.packbits(total * 2 > len(starts), bitorder="little").view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        fp = np.array([fingerprint(x.as_py()) for x in b.column("text")], np.uint64).view(np.int64)
        rest = [b.column(i) for i, f in enumerate(b.schema) if f.name != "text"]
        names = [f.name for f in b.schema if f.name != "text"]
        yield pa.RecordBatch.from_arrays([*rest, pa.array(fp)], [*names, "fp"])


def fingerprints(docs: DataFrame, *keys: str) -> DataFrame:
    """The columns ``keys`` and ``fp`` (the fingerprint's 64 bits as a signed long) of each row of ``docs``."""
    rows = docs.select(*keys, F.col("text").cast("string").alias("text"))
    kept = rows.drop("text").schema
    return rows.mapInArrow(_fingerprints, kept.add("fp", "long", False))


def _postings(fps: DataFrame) -> DataFrame:
    """A row ``key, fp`` for each triple of positions; the key holds the triple's number and its bytes."""

    def byte(i: int):
        return F.shiftrightunsigned("fp", 8 * i).bitwiseAND(F.lit(255))

    keys = [
        F.lit(n << 24) + byte(i) * 65_536 + byte(j) * 256 + byte(k) for n, (i, j, k) in enumerate(position_triples())
    ]
    return fps.select("fp", F.explode(F.array(*keys)).alias("key")).select("key", "fp")


def _linked(x: np.ndarray, y: np.ndarray, most: int) -> np.ndarray:
    """Which pairs share the minimum of bytes and differ in at most ``most`` bits."""
    differ = x ^ y
    ok = (differ.view(np.uint8).reshape(-1, BYTES) == 0).sum(axis=1) >= BYTES - most
    ok[ok] = np.bitwise_count(differ[ok]) <= most
    return ok


def _forest(fps: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a spanning forest of the links among ``fps``, each entry compared with those not reached yet."""
    left, us, vs = fps, [], []
    while len(left) > 1:
        front, left = [left[0]], left[1:]
        while front and len(left):
            u = front.pop()
            ok = _linked(np.full(len(left), u), left, most)
            if ok.any():
                new = left[ok]
                us.append(np.full(len(new), u))
                vs.append(new)
                front.extend(new)
                left = left[~ok]
    none = np.empty(0, np.uint64)
    return (np.concatenate(us), np.concatenate(vs)) if us else (none, none)


def _link_lists(limit: int, most: int):
    """Maps rows sorted by key to edges ``u, v``; entries of lists over ``limit`` come back with ``v`` null."""

    def pairs_of(keys: np.ndarray, fps: np.ndarray) -> tuple[list, list]:
        us, vs = [], []
        cut = np.flatnonzero(np.diff(keys)) + 1
        starts = np.concatenate([[0], cut]).astype(np.int64)
        size = np.diff(np.concatenate([starts, [len(keys)]]))
        two = starts[size == 2]
        if len(two):
            ok = _linked(fps[two], fps[two + 1], most)
            us.append(fps[two][ok])
            vs.append(fps[two + 1][ok])
        for s, n in zip(starts[size > 2].tolist(), size[size > 2].tolist(), strict=True):
            u, v = _forest(fps[s : s + n], most)
            us.append(u)
            vs.append(v)
        return us, vs

    def batch(us: list, vs: list, dense: list) -> pa.RecordBatch:
        none = [np.empty(0, np.uint64)]
        u, v, d = (np.concatenate(x or none).view(np.int64) for x in (us, vs, dense))
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([u, d])), pa.concat_arrays([pa.array(v), pa.nulls(len(d), pa.int64())])], ["u", "v"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, fps = np.empty(0, np.int64), np.empty(0, np.uint64)
        dense_key = None
        for b in batches:
            if not b.num_rows:
                continue
            keys = np.concatenate([keys, b.column("key").to_numpy()])
            fps = np.concatenate([fps, b.column("fp").to_numpy().view(np.uint64)])
            last = int(np.searchsorted(keys, keys[-1]))  # the last list may go on in the next batch
            us, vs, dense = [], [], []
            head = 0
            if dense_key is not None:
                head = int(np.searchsorted(keys, dense_key, "right"))
                dense.append(fps[:head])
                if head < len(keys):
                    dense_key = None
            if last > head:
                us, vs = pairs_of(keys[head:last], fps[head:last])
            tail = max(head, last)
            if len(keys) - tail > limit:
                dense_key = int(keys[-1])
                dense.append(fps[tail:])
                tail = len(keys)
            keys, fps = keys[tail:], fps[tail:]
            yield batch(us, vs, dense)
        if len(keys):
            yield batch(*pairs_of(keys, fps), [])

    return run


def _neighbours(most: int):
    """Maps ``u`` to every value within half of ``most`` bits of it."""
    masks = [0]
    for n in range(1, most // 2 + 1):
        masks += [sum(1 << i for i in c) for c in combinations(range(64), n)]
    around = np.array(masks, np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = b.column("u").to_numpy().view(np.uint64)
            for at in range(0, len(fps), 256):
                part = fps[at : at + 256]
                z = (part[:, None] ^ around[None, :]).ravel().view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(z), pa.array(np.repeat(part, len(around)).view(np.int64))], ["z", "u"])

    return run


def _dense_links(dense: DataFrame, most: int) -> DataFrame:
    """Edges among entries of long lists, in proportion to their number.

    Two fingerprints differ in at most 4 bits exactly if some value lies within 2
    bits of both. Each entry is joined to the least entry around each such value.
    """
    around = dense.mapInArrow(_neighbours(most), "z long, u long")
    least = around.groupBy("z").agg(F.min("u").alias("v"), F.max("u").alias("most")).where("v <> most").drop("most")
    return around.join(least, "z").where("u <> v").select("u", "v").distinct()


def links(fps: DataFrame, most: int = MAX_BITS, limit: int = LIST_LIMIT) -> DataFrame:
    """Edges ``u, v`` that connect all fingerprints (distinct ``fp``) linked at ``most`` bits or fewer."""
    if not 0 < most <= MAX_BITS or most % 2:
        raise ValueError("most must be 2 or 4")
    found = staged(
        _postings(fps).repartition("key").sortWithinPartitions("key", "fp").mapInArrow(_link_lists(limit, most), "u long, v long"),
        "links",
    )
    edges = found.where("v is not null")
    dense = found.where("v is null").select("u").distinct()
    return edges if dense.isEmpty() else edges.unionByName(_dense_links(dense, most))


def grouped(marked: DataFrame, most: int = MAX_BITS, limit: int = LIST_LIMIT) -> DataFrame:
    """``fp, root`` of every distinct ``fp`` of ``marked``; root is the same for all of a component."""
    fps = marked.select("fp").distinct()
    star = components(links(fps, most, limit))
    return fps.join(star.withColumnRenamed("node", "fp"), "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, most: int = MAX_BITS, limit: int = LIST_LIMIT) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every row of ``docs`` (``doc_id``, ``text``).

    Null and empty texts have no words: fingerprint zero, linked like any other.
    Repeated rows and equal texts share a fingerprint and stay one row each. A null
    doc_id keeps its row and never names a component unless all ids in it are null.
    Other columns are ignored; an empty table gives no rows.
    """
    marked = staged(fingerprints(docs, "doc_id"), "fingerprints")
    roots = staged(grouped(marked, most, limit), "roots")
    least = marked.groupBy("fp").agg(F.min("doc_id").alias("least"))
    per_root = roots.join(least, "fp")
    ids = per_root.groupBy("root").agg(F.min("least").alias("component_id"))
    named = per_root.join(ids, "root").select("fp", "component_id")
    return marked.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def deduplicated(docs: DataFrame, most: int = MAX_BITS, limit: int = LIST_LIMIT) -> DataFrame:
    """The rows of ``docs`` of which each group of near duplicates keeps one: that of the smallest doc_id.

    Columns are those of ``docs``. Of rows with the same smallest doc_id the first by
    file and place stays; null ids come last. Rows of a join must be staged first.
    """
    no = free_name(docs, "row_no")
    numbered = row_keyed(docs, no)
    ids = numbered.select(F.col(no).alias("row_no"), "doc_id", "text")
    marked = staged(fingerprints(ids, "row_no", "doc_id"), "fingerprints")
    roots = grouped(marked, most, limit)
    first = marked.groupBy("fp").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "row_no")).alias("first")
    )
    kept = roots.join(first, "fp").groupBy("root").agg(F.min("first").alias("first")).select(F.col("first.row_no").alias(no))
    # The list of rows grows with the documents, so it is never broadcast.
    return numbered.join(staged(kept, "kept").hint("merge"), no, "left_semi").select(*docs.columns)
