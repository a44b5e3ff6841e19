"""Exact top-k search by inner product in three phases with a uniform threshold.

The components of the vectors are split into LISTS slices. A slice gives each query a list
of partial scores, and a score is the sum of its partial scores. Partial scores are taken
above the lowest of their list, so none is negative.

1. In each block of candidates a list names its largest entries. The k-th best score of
   all that were named bounds the k-th best score of the query from below.
2. That bound divided by the number of lists is a safe cutoff: a candidate below it in
   every list can't reach the bound. It goes to all blocks, and each list names all entries
   at or above it.
3. The scores of what was named are worked out exactly where the vectors are; those that
   reach the bound, the k best of each block, are ranked.

A block of queries and a block of candidates, each packed into one row, are a group of their own, and
partial scores are made of a part of both at a time. Scores are integers below 2**53, which double
precision holds exactly, single precision where they are small. Vectors with components too large for
that go another way: their scores are made of Python integers and ranked with the others.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyroll.llm.common import staged

LISTS = 2
#: Queries and candidates whose scores are made at a time.
QUERY_ROWS, CANDIDATE_ROWS = 512, 4096
#: Components of a block at most, on average, and the pairs of blocks that share the work of tables with few blocks.
BLOCK, PAIRS = 1 << 22, 64
#: Inner products up to this size are exact in double precision.
_EXACT = 2**53
#: Components below it fit in a long when they are scaled.
_FITS = float(2**53)


def scaled(embeddings: DataFrame) -> DataFrame:
    """``no, vec_id, v, x, most``: floor(256 x) of each component x; rows that are null or hold null or non-finite components go.

    ``most`` is the largest magnitude in ``v``. Where it would not fit in a long, it and ``v`` are null and ``x`` has the components.
    """
    rows = embeddings.select(
        F.monotonically_increasing_id().alias("no"),
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("embedding").cast("array<double>").alias("x"),
    )
    fits = F.forall("x", lambda c: F.abs(c) < _FITS)
    v = F.transform("x", lambda c: F.when(F.abs(c) < _FITS, F.floor(c * 256).cast("long")))
    made = rows.where(_valid("x")).select("no", "vec_id", F.when(fits, v).alias("v"), F.when(~fits, F.col("x")).alias("x"))
    zero = F.lit(0).cast("long")
    most = F.greatest(F.coalesce(F.array_max("v"), zero), -F.coalesce(F.array_min("v"), zero))
    return made.withColumn("most", F.when(F.col("v").isNotNull(), most))


def _valid(name: str) -> F.Column:
    finite = F.forall(name, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False)))
    return F.col(name).isNotNull() & F.coalesce(finite, F.lit(False))


def _every(count: int) -> F.Column:
    return F.explode(F.sequence(F.lit(0), F.lit(count - 1)).cast("array<long>"))


def _number(count: int) -> F.Column:
    """The block of a row, of about equal numbers of rows, by a hash of its number."""
    return F.pmod(F.xxhash64("no"), F.lit(count))


def _matrix(v: pa.ListArray, dims: int) -> np.ndarray:
    """A row for each list of ``v``, filled up with zeros."""
    out = np.zeros((len(v), dims))
    sizes = pc.list_value_length(v).to_numpy(zero_copy_only=False).astype(np.int64)
    out[np.arange(dims) < sizes[:, None]] = v.flatten().to_numpy(zero_copy_only=False)
    return out


def _slices(dims: int, lists: int) -> list[slice]:
    cut = np.linspace(0, dims, lists + 1).astype(int)
    return [slice(a, b) for a, b in zip(cut[:-1], cut[1:], strict=True)]


def _packed(dims: int, more: list[str]):
    """A block as one row, in the order of ties: its number, ``no``, ``vec_id``, the components ``v`` in integers as short as they can be, and ``more``."""

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        none = rows["vec_id"].is_null().to_numpy()
        rows = rows.take(pa.array(np.lexsort((rows["no"].to_numpy(), pc.fill_null(rows["vec_id"], 0).to_numpy(), none))))
        v = _matrix(rows["v"].combine_chunks(), dims)
        most = np.abs(v).max()
        kind = next(x for x in (np.int16, np.int32, np.int64) if most <= np.iinfo(x).max)
        longs = {c: pa.array([pc.list_flatten(rows[c]) if c == "lows" else rows[c].combine_chunks()], pa.list_(pa.int64())) for c in ["no", "vec_id", *more]}
        return pa.table({rows.column_names[0]: rows.column(0)[:1], "v": pa.array([v.astype(kind).tobytes()], pa.binary()), **longs})

    return run


def _blocks(rows: DataFrame, number: str, count: int, dims: int, more: list[str]) -> DataFrame:
    kind = "".join(f", {c} array<long>" for c in ["no", "vec_id", *more])
    dealt = rows.select(_number(count).alias(number), "no", "vec_id", "v", *more)
    return dealt.groupBy(number).applyInArrow(_packed(dims, more), f"{number} long, v binary{kind}")


def _paired(q_side: DataFrame, c_side: DataFrame, count: int, run, kind: str) -> DataFrame:
    """``run`` over the rows of each pair of blocks, ``asking`` those of queries; a pair is one group, so that a task holds one at a time."""
    both = q_side.withColumn("asking", F.lit(True)).unionByName(c_side.withColumn("asking", F.lit(False)), allowMissingColumns=True)
    # By both numbers and as many partitions as pairs, as the work of a pair is far more than its bytes tell.
    return both.repartition(min(count, 10_000), "q", "c").groupBy("q", "c").applyInArrow(run, kind)


class _Side:
    """A block as it was packed."""

    def __init__(self, rows: pa.Table, asking: bool, dims: int):
        row = rows.filter(pc.equal(rows["asking"], asking))
        self.rows = row.num_rows
        if self.rows:
            self.no, self.vec_id = row["no"][0].values.to_numpy(), row["vec_id"][0].values
            v = row["v"][0].as_buffer()
            self.v = np.frombuffer(v, f"i{v.size // (len(self.no) * dims)}").reshape(-1, dims)
            self.bound, self.lows = (row[c][0].values if c in row.column_names else None for c in ("bound", "lows"))

    def longest(self) -> float:
        return math.sqrt(np.square(self.v, dtype=float).sum(axis=1).max())


def _tiles(q: _Side, c: _Side, dims: int, lists: int):
    """For some queries at a time their slice, the kind of the scores, and for some candidates at a time: the first one, the partial scores, whole ones and places of the queries themselves."""
    # Sums of products stay below that of the lengths, which is then small enough for single precision and its differences.
    kind = np.float32 if q.longest() * c.longest() * lists < 2**23 else np.float64
    qm, cm, parts = q.v.astype(kind), c.v.astype(kind), _slices(dims, lists)
    own = np.full(len(q.no), -1)
    _, at, to = np.intersect1d(q.no, c.no, assume_unique=True, return_indices=True)
    own[at] = to

    def scored(some: slice):
        for first in range(0, len(c.no), CANDIDATE_ROWS):
            among = cm[first : first + CANDIDATE_ROWS]
            partial = [qm[some, part] @ among[:, part].T for part in parts]
            here = np.flatnonzero((own[some] >= first) & (own[some] < first + len(among)))
            yield first, partial, sum(partial[1:], partial[0].copy()), (here, own[some][here] - first)

    for start in range(0, len(q.no), QUERY_ROWS):
        some = slice(start, min(start + QUERY_ROWS, len(q.no)))
        yield some, kind, scored(some)


class _Best:
    """The ``k`` best entries of each row so far; of equal scores the first. A score below ``need`` of its row is not among them."""

    def __init__(self, need: np.ndarray, k: int):
        self.need, self.k = need, k
        self.at, self.to, self.score = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)

    def add(self, at: np.ndarray, to: np.ndarray, score: np.ndarray) -> None:
        """Entries behind all that were given before."""
        if len(at):
            at, to, score = np.concatenate([self.at, at]), np.concatenate([self.to, to]), np.concatenate([self.score, score])
            order = np.lexsort((to, -score, at))
            at, to, score = at[order], to[order], score[order]
            place = np.arange(len(at)) - np.searchsorted(at, at)
            self.at, self.to, self.score = (x[place < self.k] for x in (at, to, score))
            last = place == self.k - 1
            self.need[at[last]] = np.maximum(self.need[at[last]], score[last] + 1)


def _largest(dims: int, lists: int, k: int):
    """Phase 1: for each query of a pair of blocks the lists' lowest partial scores, and the ``k`` best scores of what the lists name."""

    def run(rows: pa.Table) -> pa.Table:
        q, c = _Side(rows, True, dims), _Side(rows, False, dims)
        out = [_NAMED.empty_table()]
        for some, kind, tiles in _tiles(q, c, dims, lists) if q.rows and c.rows else ():
            n = some.stop - some.start
            lows, floors = np.full((lists, n), np.inf), np.full((lists, n), -np.inf, kind)
            best = _Best(np.full(n, -np.inf, kind), k)
            for first, partial, score, own in tiles:
                named = np.zeros(score.shape, bool)
                for i, x in enumerate(partial):
                    np.minimum(lows[i], x.min(axis=1), out=lows[i])
                    x[own] = -np.inf
                    over = x > floors[i][:, None]
                    # A list that would name many names its largest ones, and from then on what is larger.
                    if x.shape[1] > k and np.count_nonzero(over) > 4 * k * n:
                        least = np.partition(x, -k, axis=1)[:, -k]
                        np.maximum(floors[i], least, out=floors[i])
                        over &= x >= least[:, None]
                    named |= over
                named &= score >= best.need[:, None]
                at, to = np.nonzero(named)
                best.add(at, to + first, score[at, to].astype(float))
            ends = np.searchsorted(best.at, np.arange(n + 1)).astype(np.int32)
            least = pa.ListArray.from_arrays(np.arange(n + 1, dtype=np.int32) * lists, lows.T.astype(np.int64).ravel())
            out.append(pa.table([q.no[some], least, pa.ListArray.from_arrays(ends, best.score.astype(np.int64))], schema=_NAMED))
        return pa.concat_tables(out)

    return run


def _reaching(dims: int, lists: int, k: int):
    """Phases 2 and 3 for a pair of blocks: what a list names at or above the cutoff, with its exact score, and of these each query's ``k`` best."""

    def run(rows: pa.Table) -> pa.Table:
        q, c = _Side(rows, True, dims), _Side(rows, False, dims)
        out = [_REACHED.empty_table()]
        for some, kind, tiles in _tiles(q, c, dims, lists) if q.rows and c.rows else ():
            bound = q.bound.to_numpy()[some].astype(float)
            lows = q.lows.to_numpy().reshape(-1, lists)[some].astype(float)
            cutoff = bound - lows.sum(axis=1)  # of all lists together
            best = _Best(bound.astype(kind), k)
            for first, partial, score, own in tiles:
                score[own] = -np.inf
                at, to = np.nonzero(score >= best.need[:, None])
                named = np.zeros(len(at), bool)
                for i, x in enumerate(partial):
                    named |= (x[at, to] - lows[at, i]) * lists >= cutoff[at]
                at, to = at[named], to[named]
                best.add(at, to + first, score[at, to].astype(float))
            at, to = pa.array(best.at + some.start), pa.array(best.to)
            found = [pa.array(q.no).take(at), q.vec_id.take(at), pa.array(c.no).take(to), c.vec_id.take(to), best.score.astype(np.int64)]
            out.append(pa.table(found, schema=_REACHED))
        return pa.concat_tables(out)

    return run


_NAMED = pa.schema({"query": pa.int64(), "lows": pa.list_(pa.int64()), "best": pa.list_(pa.int64())})
_REACHED = pa.schema({"query": pa.int64(), "query_id": pa.int64(), "candidate": pa.int64(), "vec_id": pa.int64(), "score": pa.int64()})


def _integers(rows: dict[str, list], dims: int) -> np.ndarray:
    """Scaled vectors of Python integers, filled up with zeros."""
    out = np.zeros((len(rows["no"]), dims), object)
    for i, (v, x) in enumerate(zip(rows["v"], rows["x"], strict=True)):
        whole = v if v is not None else [int(c) * 256 if abs(c) >= _FITS else math.floor(c * 256) for c in x]
        out[i, : len(whole)] = whole
    return out


def _key(score: int) -> str:
    """Text in the order of scores: plain for a long, by length and digits beyond it."""
    if -(2**63) <= score < 2**63:
        return "1"
    digits = f"{len(str(abs(score))):04d}{abs(score)}"
    return f"2{digits}" if score > 0 else "0" + digits.translate(str.maketrans("0123456789", "9876543210"))


def _by_integers(dims: int, k: int):
    """Each query's ``k`` best of a pair of blocks, by exact integers of any size."""

    def run(rows: pa.Table) -> pa.Table:
        q, c = rows.filter(rows["asking"]), rows.filter(pc.invert(rows["asking"]))
        if not (q.num_rows and c.num_rows):
            return _RANKED.empty_table()
        q, c = q.to_pydict(), c.to_pydict()
        cm, c_no, c_id = _integers(c, dims), c["no"], c["vec_id"]
        out = []
        for no, vec_id, v in zip(q["no"], q["vec_id"], _integers(q, dims), strict=True):
            scores = cm @ v
            others = [n for n in range(len(c_no)) if c_no[n] != no]
            best = heapq.nsmallest(k, others, key=lambda n: (-scores[n], c_id[n] is None, c_id[n] or 0, c_no[n]))
            for n in best:
                near = max(-(2**63), min(scores[n], 2**63 - 1))
                out.append((no, vec_id, c_no[n], c_id[n], near, _key(scores[n])))
        return pa.Table.from_pylist([dict(zip(_RANKED.names, r, strict=True)) for r in out], _RANKED)

    return run


_RANKED = pa.schema(
    {"query": pa.int64(), "query_id": pa.int64(), "candidate": pa.int64(), "vec_id": pa.int64(), "score": pa.int64(), "beyond": pa.string()}
)


def top_k(embeddings: DataFrame, is_query, k: int = 5, lists: int = LISTS) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` best other rows of each row for which ``is_query`` (a column of ``vec_id``).

    Ties go to the smaller vec_id (null last), then to the earlier row. With fewer rows all
    are returned. Repeated rows are rows: a copy of the query is a candidate. Shorter
    vectors count as filled up with zeros. Vectors so large that a score may pass 2**53 are ranked
    by exact integers; a score that passes a long is given as the nearest long. Other columns are
    ignored; an empty table gives no rows.
    """
    rows = staged(scaled(embeddings), "vectors")
    total, longest, asked = rows.agg(
        F.count("*"), F.max(F.size(F.coalesce(F.col("v").cast("array<double>"), "x"))), F.count(F.when(is_query, 1))
    ).first()
    dims = max(longest or 0, lists)
    # Two vectors below this bound have partial and whole scores below 2**53.
    small = F.coalesce(F.col("most") <= math.isqrt(_EXACT // (4 * dims) - 1), F.lit(False))
    large = rows.where(~small).count()
    ordinary = rows.where(small)
    reached = _by_threshold(ordinary, ordinary.where(is_query), total - large, asked, dims, lists, k).withColumn("beyond", F.lit("1"))
    if large:
        kind = "query long, query_id long, candidate long, vec_id long, score long, beyond string"
        queries, larger = rows.where(is_query), rows.where(~small)
        for asking, among, count in ((queries.where(~small), rows, total), (queries.where(small), larger, large)):
            q_blocks, c_blocks = max(-(-(min(asked, large) if among is rows else asked) // QUERY_ROWS), 1), max(-(-count // CANDIDATE_ROWS), 1)
            q_side = asking.select("*", _number(q_blocks).alias("q"), _every(c_blocks).alias("c")).drop("most")
            c_side = among.select("*", _number(c_blocks).alias("c"), _every(q_blocks).alias("q")).drop("most")
            reached = reached.unionByName(_paired(q_side, c_side, q_blocks * c_blocks, _by_integers(dims, k), kind))
    best = Window.partitionBy("query").orderBy(F.desc("score"), F.desc("beyond"), F.col("vec_id").asc_nulls_last(), "candidate")
    return reached.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _counts(total: int, asked: int, dims: int, k: int) -> tuple[int, int]:
    """Blocks of queries and of candidates: a block of one side goes along with each block of the other, so few are best where the work is shared well."""
    q_blocks = max(-(-asked * max(dims, k) // BLOCK), 1)
    return q_blocks, max(-(-total * dims // BLOCK), min(-(-total // CANDIDATE_ROWS), -(-PAIRS // q_blocks)), 1)


def _by_threshold(rows: DataFrame, queries: DataFrame, total: int, asked: int, dims: int, lists: int, k: int) -> DataFrame:
    """The three phases: for each query rows of which the ``k`` best are its best."""
    q_blocks, c_blocks = _counts(total, asked, dims, k)
    c_side = staged(_blocks(rows, "c", c_blocks, dims, []), "candidates").withColumn("q", _every(q_blocks))

    def pairs(q_rows: DataFrame, more: list[str], run, kind: str) -> DataFrame:
        q_side = _blocks(q_rows, "q", q_blocks, dims, more).withColumn("c", _every(c_blocks))
        return _paired(q_side, c_side, q_blocks * c_blocks, run, kind)

    sent = staged(pairs(queries, [], _largest(dims, lists, k), "query long, lows array<long>, best array<long>"), "lists")
    lows = sent.groupBy("query").agg(F.array(*(F.min(F.col("lows")[i]) for i in range(lists))).alias("lows"))
    order = Window.partitionBy("query").orderBy(F.desc("score"))
    ranked = sent.select("query", F.explode("best").alias("score")).withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)
    bounds = ranked.where(F.col("place") == k).select("query", F.col("score").alias("bound"))
    least = F.aggregate("lows", F.lit(0).cast("long"), lambda s, x: s + x)
    cutoffs = staged(
        lows.join(bounds, "query", "left").select(F.col("query").alias("no"), "lows", F.coalesce("bound", least).alias("bound")), "cutoffs"
    )
    return pairs(
        queries.join(cutoffs, "no"), ["bound", "lows"], _reaching(dims, lists, k), "query long, query_id long, candidate long, vec_id long, score long"
    )
