"""Near duplicates by similarity: documents whose five-word shingles have a Jaccard index of 0.8 or more.

The fingerprint has 128 positions, each the least of all shingles in an order of its own, so that two
texts of index J share a position with a chance of J. The index has postings for 32 groups of 4
positions; a pair of index 0.8 meets in none of them with a chance of 5e-8. The groups that op6 finds by
SimHash are lists of the index as well. Pairs met are verified by the exact index of their shingles, as
fingerprints also link what is less similar. Equal sets of shingles are one entry.

A list first compares each entry with its least and greatest one. Where its entries are still apart, they are
told by what differs from the least one: of those that lists have compared with the same least one, ``_forest``
finds links that join all which links join, from those differences, and only such links are made. So a group of
copies gives rows in proportion to it. Differences of one least entry are dealt by their volume: each part is one
task's, first alone, then with each other part if entries of several roots are left.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from tallyroll.llm import simhash
from tallyroll.llm.common import free_name, row_keyed, staged
from tallyroll.llm.graph import components

#: Words of a shingle and seed of its hash; least similarity of a link.
WORDS, SEED, LEAST = 5, 42, 0.8
#: Positions of a fingerprint and positions of a group.
POSITIONS, GROUP = 128, 4
#: Shingles of the differences that are one part.
PART = 1 << 20
_CHUNK = 2048
_RANDOM = np.random.default_rng(SEED)
_FLIPS = _RANDOM.integers(0, 1 << 64, (POSITIONS, 1), np.uint64)
_FACTORS = _RANDOM.integers(0, 1 << 64, (POSITIONS, 1), np.uint64) | np.uint64(1)


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of the five-word shingles of a whole text; a shorter text is one shingle."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(size + 1) - 1
    starts = ends - size
    span = min(WORDS, len(words)) - 1
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[: len(words) - span].tolist(), ends[span:].tolist(), strict=True)
    return np.unique(np.array([digest(joined[a:b], SEED) for a, b in spans], np.uint64))


def signature(found: np.ndarray) -> list[int]:
    """The keys of the postings of a fingerprint."""
    least = np.full(POSITIONS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(found), _CHUNK):
        np.minimum(least, ((found[at : at + _CHUNK] ^ _FLIPS) * _FACTORS).min(axis=1), out=least)
    return [xxhash.xxh64_intdigest(r.tobytes(), i) for i, r in enumerate(least.reshape(-1, GROUP))]


def _signed(values: list[int]) -> pa.Array:
    return pa.array(np.array(values, np.uint64).view(np.int64))


def _marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        sids, fps, sizes, keys = [], [], [], []
        for x in b.column("text"):
            found = shingles(text := x.as_py())
            fps.append(simhash.fingerprint(text))
            sids.append(xxhash.xxh64_intdigest(found.tobytes(), SEED))
            sizes.append(len(found))
            keys += signature(found)
        offsets = np.arange(len(sids) + 1, dtype=np.int32) * (POSITIONS // GROUP)
        yield pa.RecordBatch.from_arrays(
            [b.column("row_no"), b.column("doc_id"), _signed(sids), _signed(fps), pa.array(sizes, pa.int64()),
             pa.ListArray.from_arrays(pa.array(offsets), _signed(keys))],
            ["row_no", "doc_id", "sid", "fp", "size", "keys"],
        )


def _postings(one: DataFrame) -> DataFrame:
    """``sid, key`` of the groups of positions. An entry of one shingle is similar to no other."""
    return one.where("size > 1").select("sid", F.explode("keys").alias("key"))


def _group_postings(marked: DataFrame) -> DataFrame:
    """``sid, key`` of op6's groups: entries whose SimHashes are linked share a key. Texts of one entry may differ in theirs, which count repeats."""
    told = marked.where("size > 1").select("sid", "fp").distinct()
    key = F.xxhash64(F.lit("simhash"), "root").alias("key")
    return told.join(staged(simhash.grouped(marked), "groups").hint("merge"), "fp").select("sid", key).distinct()


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for at in range(b.num_rows):
            found = pa.array(shingles(b.column("text")[at].as_py()).view(np.int64))
            yield pa.RecordBatch.from_arrays([b.column("sid").slice(at, 1), pa.array([found], pa.list_(pa.int64()))], ["sid", "set"])


def _forest(sids: np.ndarray, sizes: np.ndarray, roots: np.ndarray, diffs: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links that join all entries whose sets are similar enough, one for each two roots that become one.

    ``diffs`` say in which shingles each set, of ``sizes``, differs from one that all are compared with. The
    difference of two sets is that of their diffs, so shingles that most of the diffs have are taken into the
    set they are compared with, which leaves each entry the edits of its own. Two sets are similar enough if the
    excess of both, nine times a diff less the size, adds up to eighteen times the shared diff or less. So one
    without excess is linked to that of the least. All other links share a shingle among the rarest of both diffs.
    """
    lengths = np.fromiter(map(len, diffs), np.int64, len(diffs))
    found, ids, times = np.unique(np.concatenate(diffs), return_inverse=True, return_counts=True)
    usual = np.flatnonzero(2 * times > len(diffs))
    rank = np.empty(len(found), np.int64)
    times[usual] = len(diffs) - times[usual]
    rank[np.argsort(times, kind="stable")] = np.arange(len(found))
    own = [np.setxor1d(rank[x], rank[usual], assume_unique=True) for x in np.split(ids, np.cumsum(lengths)[:-1])]
    excess = 9 * np.fromiter(map(len, own), np.int64, len(own)) - sizes
    # Least excess first; an entry is compared with those before it.
    order = np.argsort(excess, kind="stable")
    sids, excess, own = sids[order], excess[order], [own[i] for i in order]
    size = np.fromiter(map(len, own), np.int64, len(own))
    root = np.unique(roots[order], return_inverse=True)[1]
    links = []

    def link(i: int, j: int) -> None:
        if root[i] != root[j]:
            links.append((min(sids[i], sids[j]), max(sids[i], sids[j])))
            root[root == root[i]] = root[j]

    for i in np.flatnonzero(excess[1:] + excess[0] <= 0) + 1:
        link(i, 0)

    def firsts(i: int, least: int) -> np.ndarray:
        """The rarest shingles of an entry: a shared diff with one of at least that excess has one of them."""
        shared = max(1, -(-(excess[i] + least) // 18))
        return own[i][: max(0, size[i] - shared + 1)]

    listed = [firsts(i, excess[i]) for i in range(len(own))]
    counts = np.fromiter(map(len, listed), np.int64, len(listed))
    tokens, entries = np.concatenate(listed), np.repeat(np.arange(len(own)), counts)
    after = np.repeat(size, counts) - np.concatenate([np.arange(n) for n in counts])  # shingles from here to the end
    by = np.argsort(tokens, kind="stable")
    entries, after = entries[by], after[by]
    begin = np.searchsorted(tokens[by], np.arange(len(found) + 1))
    seen = np.zeros(len(found), bool)
    for i in range(1, len(own)):
        wanted = firsts(i, excess[0])
        spans = [(begin[t], begin[t + 1], size[i] - at) for at, t in enumerate(wanted.tolist()) if begin[t] < begin[t + 1]]
        if not spans or (root == root[0]).all():
            continue
        others = np.concatenate([entries[a:b] for a, b, _ in spans])
        left = np.minimum(np.concatenate([after[a:b] for a, b, _ in spans]), np.repeat([n for _, _, n in spans], [b - a for a, b, _ in spans]))
        others = np.unique(others[(others < i) & (root[others] != root[i]) & (18 * left >= excess[others] + excess[i])])
        seen[own[i]] = True
        for j in others:
            if root[j] != root[i] and 18 * np.count_nonzero(seen[own[j]]) >= excess[i] + excess[j]:
                link(i, j)
        seen[own[i]] = False
    return links


def _joined(rows: pa.Table) -> pa.Table:
    """``_forest`` of the entries of a part."""
    sids, sizes, roots = (rows.column(c).to_numpy() for c in ("sid", "size", "root"))
    links = np.array(_forest(sids, sizes, roots, [x.values.to_numpy() for x in rows.column("diff")]), np.int64).reshape(-1, 2)
    return pa.table({"u": links[:, 0], "v": links[:, 1]})


def _links(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs ``u, v`` whose sets are similar enough. Sets may be long, so rows are compared one by one and in no batch."""
    both = pairs.join(sets.toDF("v", "y").hint("merge"), "v").join(sets.toDF("u", "x").hint("merge"), "u")
    counted = both.select("u", "v", F.size(F.array_intersect("x", "y")).alias("shared"), (F.size("x") + F.size("y")).alias("all"))
    return counted.where(F.col("shared") / (F.col("all") - F.col("shared")) >= LEAST).select("u", "v")


def _apart(lists: DataFrame, one: DataFrame, edges: DataFrame) -> DataFrame:
    """The lists with entries of several roots by the links so far, with the root of every entry."""
    roots = components(edges).toDF("sid", "root")
    entries = one.select("sid").join(roots.hint("merge"), "sid", "left").withColumn("root", F.coalesce("root", "sid"))
    rooted = staged(lists.join(staged(entries, "roots").hint("merge"), "sid"), "rooted")
    apart = rooted.groupBy("key").agg(F.min("root").alias("a"), F.max("root").alias("b")).where("a < b").select("key")
    return staged(rooted.join(apart.hint("merge"), "key"), "apart")


def _differences(lists: DataFrame, sets: DataFrame) -> DataFrame:
    """For the entries of lists of one ``low``, their shingles that it lacks and those that they lack; by ``key``, the low one."""
    both = lists.select("low", "sid").distinct().join(sets.toDF("sid", "x").hint("merge"), "sid").join(sets.toDF("low", "y").hint("merge"), "low")
    diff = F.concat(F.array_except("x", "y"), F.array_except("y", "x"))
    told = staged(both.select(F.col("low").alias("key"), "sid", F.size("x").cast("long").alias("size"), diff.alias("diff")), "differences")
    parts = told.groupBy("key").agg(F.ceil(F.sum(F.size("diff") + 1) / PART).alias("parts"))
    return told.join(parts.hint("merge"), "key").withColumn("part", F.pmod(F.xxhash64("sid"), "parts"))


def _joins(parts: DataFrame) -> DataFrame:
    """The links ``u, v`` that join the similar entries of each part."""
    return parts.select("key", "part", "sid", "size", "root", "diff").groupBy("key", "part").applyInArrow(_joined, "u long, v long").distinct()


def deduplicated(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` of which each group linked by similarity keeps one: that of the smallest doc_id.

    Columns are those of ``docs``. Of rows with the same smallest doc_id the first by
    file and place stays; null ids come last. Null and empty texts are alike. Rows of a
    join must be staged first.
    """
    no = free_name(docs, "row_no")
    numbered = row_keyed(docs, no)
    texts = numbered.select(F.col(no).alias("row_no"), "doc_id", F.col("text").cast("string").alias("text"))
    kind = texts.drop("text").schema.add("sid", "long").add("fp", "long").add("size", "long").add("keys", ArrayType(LongType()))
    marked = staged(texts.mapInArrow(_marks, kind), "marks")
    firsts = F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "row_no")).alias("first")
    one = staged(marked.groupBy("sid").agg(firsts, *(F.first(c).alias(c) for c in ("size", "keys"))), "entries")

    postings = staged(_postings(one).unionByName(_group_postings(marked)), "postings")
    ends = postings.groupBy("key").agg(F.min("sid").alias("low"), F.max("sid").alias("high"), F.count("*").alias("n")).where("n > 1")
    met = staged(postings.join(ends.hint("merge"), "key"), "met")
    wanted = one.join(met.select("sid").distinct().hint("merge"), "sid").select("first.row_no", "sid")
    sets = staged(
        texts.select("row_no", "text").join(wanted.hint("merge"), "row_no").select("sid", "text").mapInArrow(_sets, "sid long, set array<long>"), "sets"
    )
    # The least and greatest entries of all lists; a list of three has no other pairs.
    pairs = met.select("sid", F.explode(F.array("low", "high")).alias("end")).where("sid <> end")
    pairs = staged(pairs.select(F.least("sid", "end").alias("u"), F.greatest("sid", "end").alias("v")).distinct(), "pairs")
    edges = staged(_links(pairs, sets), "links")
    lists = _apart(met.where("n > 3").select("key", "low", "sid"), one, edges)

    # What is still apart: the parts of all entries told by one low one, then each two of its parts.
    sets = staged(sets.join(lists.select("sid").distinct().hint("merge"), "sid", "left_semi"), "sets")
    told = staged(_differences(lists, sets).join(lists.select("sid", "root").distinct().hint("merge"), "sid"), "told")
    edges = staged(edges.unionByName(_links(staged(_joins(told), "more"), sets)), "links")
    split = _apart(told.where("parts > 1").drop("root"), one, edges)
    other = F.explode(F.expr("filter(sequence(0, parts - 1), x -> x <> part)")).alias("other")
    split = split.select("*", other).withColumn("part", F.struct(F.least("part", "other"), F.greatest("part", "other")))
    star = components(edges.unionByName(_links(staged(_joins(split), "more"), sets))).toDF("sid", "root")

    grouped = one.select("sid", "first").join(star.hint("merge"), "sid", "left").groupBy(F.coalesce("root", "sid").alias("root"))
    kept = grouped.agg(F.min("first").alias("first")).select(F.col("first.row_no").alias(no))
    # The list of rows grows with the documents, so it is never broadcast.
    return numbered.join(staged(kept, "kept").hint("merge"), no, "left_semi").select(*docs.columns)
