"""Collocations: phrases of two to four words that occur together more often than their parts.

Texts are read twice. Each shard counts its sequences of words, sorted, into weighted acyclic
automata (``llm/automata.py``); an automaton holds the sequences of one length whose prefix
lies in one range of hashes. The automata of a range are united, weights summed, and what
stays below the least count is cut. The first reading counts words and pairs; the second only counts
longer sequences whose pairs may all be frequent, which a bit filter of fixed size tells: it lets
every frequent pair through, so nothing is lost. The parts of a phrase are looked up by composing an
automaton of the parts wanted with the counts of their range.

A sequence starts with its language. The sequences of a prefix lie in half of the ring of hashes, dealt by
their last word, so that a frequent prefix is shared by half of the tasks.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyroll.llm import automata
from tallyroll.llm.common import staged

LONGEST, LEAST, TOP = 4, 30, 2000
#: A phrase gives way to a longer one that holds it if it occurs so many times of a hundred inside of it.
INSIDE = 80
SCALE = 2_000_000
NO_LANG = "und"
#: Words of a shard; bytes of texts that are split at once.
SHARD_WORDS, SPLIT_BYTES = 1_500_000, 2_000_000
#: Sequences that are held apart before they are united.
UNION_ROWS = 500_000
#: Bits of the filter of frequent pairs, whatever the number of pairs.
FILTER_BITS = 1 << 26
#: Parts of a language that are ranked apart first.
RANK_PARTS = 16

_END = b"\xff"  # no byte of a text in UTF-8
_SEPARATORS = b".,;:!?\x0a\x0b\x0c\x0d"
_TABLE = bytes(_END[0] if c in _SEPARATORS else c for c in range(256))
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_COUNTS = "range int, ord int, data binary"

Batches = Iterator[pa.RecordBatch]


def words_of(blob: bytes) -> list[bytes]:
    """The words of a text in order, with an end mark between the pieces that no phrase crosses."""
    return blob.lower().translate(_TABLE).replace(_END, b" " + _END + b" ").split()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _A
    return x ^ (x >> np.uint64(29))


def _hashes(words: list[bytes]) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(w) for w in words], np.uint64)


def _prefix_hash(hashes: np.ndarray, columns: list[np.ndarray]) -> np.ndarray:
    found = hashes[columns[0]]
    for column in columns[1:]:
        found = _mixed(found * _B + hashes[column])
    return found


def ranges_of(hashes: np.ndarray, rows: np.ndarray, ranges: int) -> np.ndarray:
    """The range of each row of labels: that of its prefix, moved by up to half of the ring for the last word."""
    columns = list(rows.T)
    place = _mixed(_prefix_hash(hashes, columns[:-1] or columns))
    if len(columns) > 1:
        place = place + (_mixed(hashes[columns[-1]]) >> np.uint64(1))
    return (((place >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)).astype(np.int64)


def _probes(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of the filter that stand for each hash."""
    other = _mixed(hashes * _B)
    return hashes % np.uint64(bits), other % np.uint64(bits)


class _Shard:
    """Words of one stretch of rows, as numbers by language."""

    def __init__(self) -> None:
        self.known: defaultdict[bytes, int] = defaultdict()
        self.known.default_factory = self.known.__len__
        self.ids: defaultdict[bytes, list[np.ndarray]] = defaultdict(list)
        self.size = 0

    def add(self, lang: bytes, texts: list[bytes]) -> None:
        found = [*words_of(_END.join(texts)), _END]
        self.ids[lang].append(np.fromiter(map(self.known.__getitem__, found), np.int32, len(found)))
        self.size += len(found)

    def labelled(self) -> tuple[list[bytes], int, list[tuple[int, np.ndarray]]]:
        """All words, sorted; the label of the end mark; the labels of each language in the order of the languages."""
        for lang in self.ids:
            self.known[lang]
        self.known[_END]
        words = list(self.known)
        order = sorted(range(len(words)), key=words.__getitem__)
        label = np.empty(len(words), np.int64)
        label[order] = np.arange(len(words))
        langs = sorted(self.ids)
        return [words[i] for i in order], int(label[self.known[_END]]), [
            (int(label[self.known[x]]), label[np.concatenate(self.ids[x])]) for x in langs
        ]


def _with_lang(lang: int, rows: np.ndarray) -> np.ndarray:
    return np.column_stack((np.full(len(rows), lang, np.int32), rows.astype(np.int32)))


def _short(lang: int, ids: np.ndarray, end: int, size: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Number of words, words, and pairs of one language, each with counts."""
    inside = ids != end
    yield 0, np.array([[lang]], np.int32), np.array([inside.sum()], np.int64)
    counts = np.bincount(ids[inside], minlength=1)
    found = np.flatnonzero(counts)
    yield 1, _with_lang(lang, found[:, None]), counts[found]
    pairs, counts = np.unique((ids[:-1] * size + ids[1:])[inside[:-1] & inside[1:]], return_counts=True)
    yield 2, _with_lang(lang, np.column_stack((pairs // size, pairs % size))), counts


def _long(
    lang: int, ids: np.ndarray, end: int, size: int, hashes: np.ndarray, kept: np.ndarray
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Sequences of three and more words whose pairs all pass the filter, with counts."""
    inside = ids != end
    at = np.flatnonzero(inside[:-1] & inside[1:])
    full = _prefix_hash(hashes, [np.full(len(at), lang), ids[at], ids[at + 1]])
    ok = np.ones(len(at), bool)
    for bit in _probes(full, len(kept) * 64):
        ok &= (kept[bit >> np.uint64(6)] >> (bit & np.uint64(63))) & np.uint64(1) == 1
    run = np.zeros(len(ids), bool)
    run[at[ok]] = True
    pairs, at = run, np.flatnonzero(run)
    key = ids[at] * size + ids[at + 1] if len(at) else at
    for order in range(3, LONGEST + 1):
        # A sequence goes on where the pair at its end does; what it holds is named by the rank of its prefix.
        rank = np.unique(key, return_inverse=True)[1]
        on = at + order - 2
        go = (on < len(pairs)) & pairs[np.minimum(on, len(pairs) - 1)]
        at = at[go]
        key = rank[go] * size + ids[at + order - 1]
        _, first, counts = np.unique(key, return_index=True, return_counts=True)
        rows = np.column_stack([ids[at[first] + j] for j in range(order)]) if len(first) else np.empty((0, order), np.int64)
        yield order, _with_lang(lang, rows), counts


def _counted(batches: Batches, ranges: int, kept=None) -> Iterator[pa.RecordBatch]:
    """Maps ``lang, text`` to automata of counts for each range and length."""

    def out(shard: _Shard) -> Iterator[pa.RecordBatch]:
        words, end, langs = shard.labelled()
        shard.known.clear()
        shard.ids.clear()
        hashes = _hashes(words)
        by_order = defaultdict(list)
        for lang, ids in langs:
            found = _short(lang, ids, end, len(words)) if kept is None else _long(lang, ids, end, len(words), hashes, kept.value)
            for order, rows, counts in found:
                by_order[order].append((rows, counts))
        del langs
        for order in list(by_order):
            rows, counts = (np.concatenate(x) for x in zip(*by_order.pop(order), strict=True))
            dealt = ranges_of(hashes, rows, ranges)
            sort = np.argsort(dealt, kind="stable")
            present, starts = np.unique(dealt[sort], return_index=True)
            data = [
                automata.to_bytes(automata.built(words, rows[x], counts[x])) for x in np.split(sort, starts[1:]) if len(x)
            ]
            yield _rows(present, order, data)

    shard = _Shard()
    for b in batches:
        waiting: defaultdict[bytes, list[bytes]] = defaultdict(list)
        sizes: defaultdict[bytes, int] = defaultdict(int)
        for lang, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
            waiting[lang].append(text.as_py())
            sizes[lang] += len(waiting[lang][-1])
            if sizes[lang] >= SPLIT_BYTES:
                shard.add(lang, waiting.pop(lang))
                sizes[lang] = 0
        for lang, texts in waiting.items():
            shard.add(lang, texts)
        if shard.size >= SHARD_WORDS:
            yield from out(shard)
            shard = _Shard()
    if shard.size:
        yield from out(shard)


def _rows(ranges: np.ndarray, order: int, data: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(ranges, pa.int32()), pa.array(np.full(len(data), order), pa.int32()), pa.array(data, pa.binary())],
        ["range", "ord", "data"],
    )


def _united(batches: Batches, least: int) -> Iterator[pa.RecordBatch]:
    """Unites the automata of a range and length, which come one after the other, and cuts what is below ``least``."""
    now, held, size, base = None, [], 0, 0

    def done() -> Iterator[pa.RecordBatch]:
        x = automata.union(held)
        x = automata.pruned(x, least) if now[1] else x
        if len(x.weights):
            yield _rows(np.array(now[:1]), now[1], [automata.to_bytes(x)])

    for b in batches:
        for place, order, data in zip(*(b.column(i) for i in range(3)), strict=True):
            key = (place.as_py(), order.as_py())
            if key != now:
                if now:
                    yield from done()
                now, held, size, base = key, [], 0, 0
            held.append(automata.from_bytes(data.as_py()))
            size += len(held[-1].weights)
            if size > max(UNION_ROWS, 2 * base):
                held = [automata.union(held)]
                size = base = len(held[0].weights)
    if now:
        yield from done()


def _counts(texts: DataFrame, ranges: int, least: int, kept=None) -> DataFrame:
    """Automata of the counts of each range: of up to two words, or of more with a filter of pairs."""
    shards = texts.mapInArrow(partial(_counted, ranges=ranges, kept=kept), _COUNTS)
    dealt = shards.repartitionById(ranges, F.col("range")).sortWithinPartitions("range", "ord")
    return dealt.mapInArrow(partial(_united, least=least), _COUNTS)


def _bits(batches: Batches, bits: int) -> Iterator[pa.RecordBatch]:
    """The slots of the filter that the pairs of these automata set."""
    slots = np.zeros(bits // 64, np.uint64)
    for b in batches:
        for data in b.column("data"):
            x = automata.from_bytes(data.as_py())
            for bit in _probes(_prefix_hash(_hashes(x.words), list(automata.paths(x).T)), bits):
                np.bitwise_or.at(slots, (bit >> np.uint64(6)).astype(np.int64), np.uint64(1) << (bit & np.uint64(63)))
    used = np.flatnonzero(slots)
    for i in range(0, len(used), 10_000):
        part = used[i : i + 10_000]
        yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(slots[part].view(np.int64))], ["slot", "mask"])


def pair_filter(counts: DataFrame, bits: int):
    """A broadcast filter of the frequent pairs, of a size that the data do not change."""
    set_ = counts.where("ord = 2").mapInArrow(partial(_bits, bits=bits), "slot long, mask long")
    found = set_.groupBy("slot").agg(F.bit_or("mask").alias("mask")).toArrow()
    slots = np.zeros(bits // 64, np.uint64)
    slots[found.column("slot").to_numpy()] = found.column("mask").to_numpy().view(np.uint64)
    return counts.sparkSession.sparkContext.broadcast(slots)


def _texts(words: list[bytes], rows: np.ndarray) -> list[bytes]:
    return [b" ".join([words[i] for i in row]) for row in rows.tolist()]


def _listed(batches: Batches) -> Iterator[pa.RecordBatch]:
    """The sequences of automata as rows ``ord, lang, phrase, a``."""
    for b in batches:
        for order, data in zip(b.column("ord"), b.column("data"), strict=True):
            x = automata.from_bytes(data.as_py())
            rows = automata.paths(x)
            for i in range(0, len(rows), 10_000):
                part = rows[i : i + 10_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(part), order.as_py()), pa.int32()), pa.array([x.words[j] for j in part[:, 0]], pa.binary()),
                     pa.array(_texts(x.words, part[:, 1:]), pa.binary()), pa.array(x.weights[i : i + 10_000])],
                    ["ord", "lang", "phrase", "a"],
                )


def _wanted(batches: Batches, ranges: int) -> Iterator[pa.RecordBatch]:
    """Automata of the parts that these rows ``lang, phrase`` ask for, by range and length."""
    for b in batches:
        by_order = defaultdict(list)
        for lang, phrase in zip(b.column("lang"), b.column("phrase"), strict=True):
            row = (lang.as_py(), *phrase.as_py().split(b" "))
            by_order[len(row) - 1].append(row)
        for order, rows in by_order.items():
            words = sorted({w for row in rows for w in row})
            at = {w: i for i, w in enumerate(words)}
            labels = np.array([[at[w] for w in row] for row in rows], np.int64)
            dealt = ranges_of(_hashes(words), labels, ranges)
            for place in np.unique(dealt).tolist():
                part = labels[dealt == place]
                x = automata.summed(words, part, np.ones(len(part), np.int64))
                yield _rows(np.array([place]), order, [automata.to_bytes(x)])


def _looked_up(batches: Batches) -> Iterator[pa.RecordBatch]:
    """Composes the wanted parts of a range and length with the counts that come before them."""
    now, counts = None, None
    for b in batches:
        for place, order, asks, data in zip(*(b.column(c) for c in ("range", "ord", "asks", "data")), strict=True):
            x, key = automata.from_bytes(data.as_py()), (place.as_py(), order.as_py())
            if not asks.as_py():
                now, counts = key, x
            elif now == key:
                rows, weights = automata.composed(x, counts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x.words[i] for i in rows[:, 0]], pa.binary()), pa.array(_texts(x.words, rows[:, 1:]), pa.binary()),
                     pa.array(weights)],
                    ["lang", "part", "f"],
                )


def _part_counts(parts: DataFrame, counts: DataFrame, ranges: int) -> DataFrame:
    """``lang, part, f``: how often each distinct part of ``parts`` occurs."""
    asked = parts.select(F.col("lang").cast("binary").alias("lang"), F.col("part").cast("binary").alias("phrase"))
    asked = asked.mapInArrow(partial(_wanted, ranges=ranges), _COUNTS).withColumn("asks", F.lit(True))
    both = counts.withColumn("asks", F.lit(False)).unionByName(asked)
    dealt = both.repartitionById(ranges, F.col("range")).sortWithinPartitions("range", "ord", "asks")
    found = dealt.mapInArrow(_looked_up, "lang binary, part binary, f long")
    return found.select(F.col("lang").cast("string").alias("lang"), F.col("part").cast("string").alias("part"), "f")


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, filter_bits: int = FILTER_BITS) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of the first ``top`` phrases of each language of ``docs`` (``lang``, ``text``).

    Texts are lower-cased (A-Z), split into pieces at punctuation and line ends and those into words at
    spaces and tabs. A phrase has 2 to 4 words of a piece and occurs ``a >= least`` times; cut into
    two parts that occur l and r times it scores floor(2000000 a / (l + r)), and the cut with
    the least score counts, then the shorter first part. A phrase that lies inside a longer one which
    occurs at least 0.8 a times is dropped. n is the number of all words. Ties in rank go to the
    larger a, then the phrase by bytes. Null texts are empty, a null lang is ``und``; repeated rows
    count again; other columns are ignored; no rows give no rows.
    """
    spark = docs.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    lang = F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANG))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    texts = docs.select(lang.cast("binary").alias("lang"), text.cast("binary").alias("text"))
    short = staged(_counts(texts, ranges, least), "counts")
    kept = pair_filter(short, filter_bits)
    long = staged(_counts(texts, ranges, least, kept), "counts")
    counts = short.unionByName(long)

    listed = counts.where("ord = 0 or ord > 1").mapInArrow(_listed, "ord int, lang binary, phrase binary, a long")
    listed = listed.withColumns({"lang": F.col("lang").cast("string"), "phrase": F.col("phrase").cast("string")})
    phrases = staged(listed, "phrases")
    sizes = phrases.where("ord = 0").select("lang", F.col("a").alias("n"))
    phrases = phrases.where("ord > 1")

    words = F.split("phrase", " ")
    run = lambda w, start, n: F.array_join(F.slice(w, start, n), " ")
    inner = F.when(F.col("ord") == 3, F.array(*(run(words, i, 2) for i in (1, 2)))).otherwise(
        F.array(*(run(words, i, n) for n in (2, 3) for i in range(1, LONGEST - n + 2)))
    )
    held = phrases.where("ord > 2").select("lang", F.explode(inner).alias("phrase"), F.col("a").alias("longer"))
    held = held.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    wide = lambda name: F.col(name).cast("decimal(20,0)")
    dropped = F.coalesce(wide("longer") * 100 >= wide("a") * INSIDE, F.lit(False))
    stays = staged(phrases.join(held, ["lang", "phrase"], "left").where(~dropped).drop("longer"), "stays")

    cuts = F.filter(
        F.array(*(F.when(F.col("ord") > k, F.struct(F.lit(k).alias("k"), run(words, 1, k).alias("first"), run(words, k + 1, LONGEST).alias("rest"))) for k in range(1, LONGEST))),
        lambda x: x.isNotNull(),
    )
    sides = stays.select("lang", "phrase", "a", F.inline(cuts)).select(
        "lang", "phrase", "a", "k", F.inline(F.array(*(F.struct(F.lit(c == "first").alias("left"), F.col(c).alias("part")) for c in ("first", "rest"))))
    )
    sides = staged(sides, "sides")
    found = _part_counts(sides.select("lang", "part").distinct(), counts, ranges)
    found = staged(found.groupBy("lang", "part").agg(F.max("f").alias("f")), "parts")
    of_side = lambda left: F.max(F.when(F.col("left") == left, F.col("f")))
    cut = sides.join(found, ["lang", "part"]).groupBy("lang", "phrase", "a", "k").agg(of_side(True).alias("l"), of_side(False).alias("r"))
    scored = cut.withColumn("score", F.call_function("div", wide("a") * SCALE, wide("l") + wide("r")).cast("long"))
    best = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    best = staged(best.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score"), "scored")

    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS))
    first = best.withColumn("place", F.row_number().over(Window.partitionBy("lang", part).orderBy(*order))).where(F.col("place") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return ranked.join(sizes, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
