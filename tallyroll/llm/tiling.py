"""Benchmark decontamination by greedy string tiling.

Words of documents and benchmark items are compared in lower case, without punctuation.
Runs of SEED words that a document shares with an item are found by one join on their
hashes. For each pair of a document and an item whose shared runs could cover enough of
the item, the longest common run is marked, then the longest among the words not marked
yet, and so on (running Karp-Rabin), until no run of SEED words is left. A document is
contaminated by an item of which the marked runs, in whatever order, cover COVERAGE.
"""

from __future__ import annotations

import heapq
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyroll.llm.common import free_name, row_keyed, staged

SEED, COVERAGE = 5, 0.5
#: Bits of the filter of seeds that every task gets: half a megabyte, however large the benchmark.
FILTER_BITS = 1 << 22
#: Letters of scripts that put no spaces between words (Thai, Lao, Burmese, Khmer, Japanese, Chinese). Each is a word.
_UNSPACED = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
_WORD = re.compile(rf"[^\W{_UNSPACED}]+|(?=\w)[{_UNSPACED}]")
_BASE = np.uint64(0x9E3779B97F4A7C15)
#: Words whose hashes a task remembers, and characters of text that it works on at once.
_KNOWN, _BLOCK = 500_000, 1 << 22


def words(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


class _Hashes(dict):
    def __missing__(self, word: str) -> int:
        if len(self) >= _KNOWN:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


def _windows(codes: np.ndarray, width: int) -> np.ndarray:
    """Karp-Rabin hash of each window of ``width`` word hashes."""
    n = len(codes) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    h = np.full(n, width, np.uint64)
    for i in range(width):
        h = h * _BASE + codes[i : i + n]
    return h ^ (h >> np.uint64(29))


def _filter_places(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (h >> np.uint64(42)).astype(np.int64), (h & np.uint64(FILTER_BITS - 1)).astype(np.int64)


def _items(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes()
        for b in batches:
            out = []
            for no, item_id, text in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                w = words(text)
                width = min(least, len(w))
                h = _windows(np.array([hashes[x] for x in w], np.uint64), width) if w else np.empty(0, np.uint64)
                out.append({"item_no": no, "item_id": item_id, "words": w, "width": width, "seeds": h.view(np.int64).tolist()})
            yield pa.RecordBatch.from_pylist(out, _ITEMS)

    return run


_ITEMS = pa.schema(
    {"item_no": pa.int64(), "item_id": pa.int64(), "words": pa.list_(pa.string()), "width": pa.int32(), "seeds": pa.list_(pa.int64())}
)
_HITS = pa.schema(
    {
        "row_no": pa.string(),
        "doc_id": pa.int64(),
        "seeds": pa.list_(pa.int64()),
        "spans": pa.list_(pa.struct({"at": pa.int32(), "words": pa.list_(pa.string())})),
    }
)


def _hits(widths: list[int], sent):
    """Maps whole documents to the runs of words that may be in an item; documents without any give no row."""

    def block(rows: list[tuple]) -> list[dict]:
        first, second = (np.unpackbits(x).astype(bool) for x in sent.value)
        texts = [words(t) for _, _, t in rows]
        size = np.array([len(t) for t in texts])
        ends = np.cumsum(size)
        owner = np.repeat(np.arange(len(texts)), size)
        codes = np.fromiter((hashes[w] for t in texts for w in t), np.uint64, int(ends[-1]))
        found: dict[int, list] = defaultdict(list)
        for width in widths:
            h = _windows(codes, width)
            if not len(h):
                continue
            a, b = _filter_places(h)
            hit = np.flatnonzero(first[a] & second[b])
            hit = hit[owner[hit] == owner[hit + width - 1]]
            for i, d, value in zip(hit.tolist(), owner[hit].tolist(), h[hit].view(np.int64).tolist(), strict=True):
                found[d].append((i, width, value))
        out = []
        for d, hits in found.items():
            start = int(ends[d] - size[d])
            spans: list[list[int]] = []
            for i, width, _ in sorted(hits):
                if spans and i - start <= spans[-1][1]:
                    spans[-1][1] = max(spans[-1][1], i - start + width)
                else:
                    spans.append([i - start, i - start + width])
            out.append(
                {
                    "row_no": rows[d][0],
                    "doc_id": rows[d][1],
                    "seeds": list({v for _, _, v in hits}),
                    "spans": [{"at": a, "words": texts[d][a:b]} for a, b in spans],
                }
            )
        return out

    hashes = _Hashes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            now, size = [], 0
            for row in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), (x.as_py() for x in b.column(2)), strict=True):
                now.append(row)
                size += len(row[2] or "")
                if size >= _BLOCK:
                    yield pa.RecordBatch.from_pylist(block(now), _HITS)
                    now, size = [], 0
            if now:
                yield pa.RecordBatch.from_pylist(block(now), _HITS)

    return run


def greedy_tiles(text: list, pattern: list, least: int) -> list[tuple[int, int, int]]:
    """Tiles ``(text position, pattern position, length)``: longest common runs first, none overlapping.

    Each word belongs to one tile at most. Of runs of one length the first in the text
    wins, then the first in the pattern. Runs shorter than ``least`` are no tiles.

    Runs are searched for by a length that halves. Those found wait in a heap, the longest
    on top; what longer tiles leave of a run goes back by its new length, so that the next tile is
    the longest run left at all.
    """
    free_t, free_p = [True] * len(text), [True] * len(pattern)
    codes: dict = {}
    t = [codes.setdefault(w, len(codes) + 1) for w in text]
    p = [codes.setdefault(w, len(codes) + 1) for w in pattern]
    out = []
    size = max(min(len(t), len(p)), least)
    while True:
        waiting = [(-n, i, j) for n, i, j in _common_runs(t, p, free_t, free_p, size)]
        heapq.heapify(waiting)
        while waiting:
            minus, i, j = heapq.heappop(waiting)
            rest = list(_free_parts(free_t, free_p, i, j, -minus, size))
            if rest == [(-minus, i, j)]:
                free_t[i : i - minus] = free_p[j : j - minus] = [False] * -minus
                out.append((i, j, -minus))
                continue
            for n, k, m in rest:
                heapq.heappush(waiting, (-n, k, m))
        if size <= least:
            return sorted(out)
        size = max(size // 2, least)


def _free_parts(free_t: list[bool], free_p: list[bool], i: int, j: int, n: int, size: int) -> Iterator[tuple[int, int, int]]:
    """Parts of ``size`` words or more of a run that no tile holds yet."""
    start = 0
    for k in range(n + 1):
        if k == n or not (free_t[i + k] and free_p[j + k]):
            if k - start >= size:
                yield k - start, i + start, j + start
            start = k + 1


def _common_runs(t: list[int], p: list[int], free_t: list[bool], free_p: list[bool], size: int) -> list[tuple[int, int, int]]:
    """Runs of ``size`` free words or more that can't be made longer."""
    at = defaultdict(list)
    for h, j in _rolling(p, free_p, size):
        at[h].append(j)
    out = []
    for h, i in _rolling(t, free_t, size):
        for j in at.get(h, ()):
            if i and j and t[i - 1] == p[j - 1] and free_t[i - 1] and free_p[j - 1]:
                continue  # part of a run that starts further left
            n = 0
            while i + n < len(t) and j + n < len(p) and t[i + n] == p[j + n] and free_t[i + n] and free_p[j + n]:
                n += 1
            if n >= size:
                out.append((n, i, j))
    return out


def _rolling(codes: list[int], free: list[bool], size: int) -> Iterator[tuple[int, int]]:
    """Hash and start of each window of ``size`` free words, each hash made from the one before."""
    base, mod = 1_000_003, (1 << 61) - 1
    top = pow(base, size - 1, mod)
    h = run = 0
    for i, c in enumerate(codes):
        if not free[i]:
            h = run = 0
            continue
        if run == size:
            h = (h - codes[i - size] * top) % mod
            run -= 1
        h = (h * base + c) % mod
        run += 1
        if run == size:
            yield h, i - size + 1


def _tiled(coverage: float):
    schema = pa.schema(
        {
            "row_no": pa.string(),
            "doc_id": pa.int64(),
            "item_id": pa.int64(),
            "n_words": pa.int32(),
            "covered": pa.int32(),
            "tiles": pa.list_(pa.struct({"doc_word": pa.int32(), "item_word": pa.int32(), "length": pa.int32()})),
        }
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for r in b.to_pylist():
                flat, places = [], []
                for s in r["spans"]:
                    flat += [*s["words"], None]  # no item has None: runs end with their span
                    places += range(s["at"], s["at"] + len(s["words"]) + 1)
                tiles = greedy_tiles(flat, r["words"], r["width"])
                covered = sum(n for _, _, n in tiles)
                if covered >= coverage * len(r["words"]):
                    out.append(
                        {k: r[k] for k in ("row_no", "doc_id", "item_id")}
                        | {"n_words": len(r["words"]), "covered": covered}
                        | {"tiles": [{"doc_word": places[i], "item_word": j, "length": n} for i, j, n in tiles]}
                    )
            yield pa.RecordBatch.from_pylist(out, schema)

    return run


_TILED = "row_no string, doc_id long, item_id long, n_words int, covered int, tiles array<struct<doc_word:int,item_word:int,length:int>>"


def contaminated_rows(numbered: DataFrame, benchmark: DataFrame, least: int = SEED, coverage: float = COVERAGE) -> DataFrame:
    """Like ``contaminated``, for rows ``row_no, doc_id, text``; ``row_no`` (a string) comes back too."""
    spark = numbered.sparkSession
    items = staged(
        benchmark.select(
            F.monotonically_increasing_id().alias("item_no"), F.col("item_id").cast("long"), F.col("text").cast("string")
        ).mapInArrow(_items(least), "item_no long, item_id long, words array<string>, width int, seeds array<long>"),
        "items",
    )
    seeds = items.select("item_no", "width", F.size("words").alias("n_words"), F.posexplode("seeds").alias("pos", "seed"))
    # At most FILTER_BITS places for each half of the filter, whatever the benchmark's size.
    halves = [F.shiftrightunsigned("seed", 42), F.col("seed").bitwiseAND(F.lit(FILTER_BITS - 1))]
    packed = []
    for half in halves:
        places = np.zeros(FILTER_BITS, bool)
        places[seeds.select(half.alias("place")).distinct().toPandas()["place"].to_numpy(np.int64)] = True
        packed.append(np.packbits(places))
    widths = sorted(r[0] for r in items.where("width > 0").select("width").distinct().collect())
    docs = numbered.select("row_no", F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    hits = staged(
        docs.mapInArrow(
            _hits(widths, spark.sparkContext.broadcast(packed)),
            "row_no string, doc_id long, seeds array<long>, spans array<struct<at:int,words:array<string>>>",
        ),
        "hits",
    )
    shared = hits.select("row_no", F.explode("seeds").alias("seed")).join(seeds, "seed")
    pairs = (
        shared.groupBy("row_no", "item_no", "n_words", "width")
        .agg(F.collect_set("pos").alias("pos"))
        .withColumn(
            "reach",
            F.size(F.array_distinct(F.flatten(F.transform("pos", lambda p: F.sequence(p, p + F.col("width") - 1))))),
        )
        .where(F.col("reach") >= coverage * F.col("n_words"))
        .select("row_no", "item_no")
    )
    both = pairs.join(hits.select("row_no", "doc_id", "spans"), "row_no").join(items.select("item_no", "item_id", "words", "width"), "item_no")
    return both.drop("item_no").mapInArrow(_tiled(coverage), _TILED)


def contaminated(docs: DataFrame, benchmark: DataFrame, least: int = SEED, coverage: float = COVERAGE) -> DataFrame:
    """``doc_id, item_id, n_words, covered, coverage, tiles`` of each document (``doc_id``, ``text``) and item that it holds.

    ``benchmark`` has ``item_id`` and ``text``. An item of fewer than ``least`` words is
    held only as a whole, in one run; one without words never. Null texts are empty. Null
    ids come back null; repeated rows and items give a row each. Other columns are
    ignored. An empty table on either side gives no rows.
    """
    rows = docs.select(F.monotonically_increasing_id().cast("string").alias("row_no"), "doc_id", "text")
    found = contaminated_rows(rows, benchmark, least, coverage)
    return found.select("doc_id", "item_id", "n_words", "covered", (F.col("covered") / F.col("n_words")).alias("coverage"), "tiles")


def decontaminated(docs: DataFrame, benchmark: DataFrame, least: int = SEED, coverage: float = COVERAGE) -> DataFrame:
    """The rows of ``docs`` that hold no item, with the columns of ``docs``.

    Rows of a join must be staged first.
    """
    no = free_name(docs, "row_no")
    numbered = row_keyed(docs, no)
    found = contaminated_rows(numbered.select(F.col(no).alias("row_no"), "doc_id", "text"), benchmark, least, coverage)
    gone = staged(found.select(F.col("row_no").alias(no)).distinct(), "contaminated")
    return numbered.join(gone, no, "left_anti").select(*docs.columns)
