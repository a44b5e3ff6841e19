"""Mixing of overlapping sources to target weights by a min-cost flow.

Documents are summed by membership pattern, the set of sources they belong to. The flow sends
the tokens of patterns to the quotas of their sources; the second and third copy of a token cost
more than the first, so that repeats are spread before any pattern is taken a third time. Then
each pattern takes whole copies of its documents, and one more of those that come first in a seeded order.

Only patterns reach the driver, a row each; their number is checked against :data:`MAX_PATTERNS` before.
"""

from __future__ import annotations

from collections import defaultdict, deque
from collections.abc import Callable, Mapping, Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyroll.llm.common import staged

#: Copies of a document at most, and cost of each copy beyond the one before: convex, so early copies come first.
COPIES = 3
COSTS = (0, 1, 2)
SEED = "mix"
#: Membership patterns that the driver takes; more raise. They follow the sources that users name, not the documents.
MAX_PATTERNS = 1 << 20
#: Parts of the seeded order; only the one in which a pattern's share ends is put in order.
PARTS = 4096

Source = str | None
Pattern = tuple[Source, ...]


def in_order(sources) -> list[Source]:
    """Sources by code point, null last."""
    return sorted(sources, key=lambda s: (s is None, s or ""))


def cyclic_weights(sources: Sequence[Source]) -> dict[Source, int]:
    """Weights 1, 2, 3, 1, ... in the order of the sources."""
    return {s: i % 3 + 1 for i, s in enumerate(in_order(sources))}


def targets(sizes: Mapping[Source, int], weights: Mapping[Source, int], total: int, copies: int = COPIES) -> dict[Source, Fraction]:
    """Shares of ``total`` by weight, none above ``copies`` times its source's size; what is cut off is shared anew by weight."""
    found: dict[Source, Fraction] = {}
    rest, weight = total, sum(weights[s] for s in sizes)
    # Sources reach their bound in the order of size by weight.
    for s in sorted(sizes, key=lambda s: (Fraction(sizes[s], weights[s]), s is None, s or "")):
        if copies * sizes[s] * weight >= weights[s] * rest:
            break
        found[s] = Fraction(copies * sizes[s])
        rest, weight = rest - copies * sizes[s], weight - weights[s]
    return found | {s: Fraction(weights[s] * rest, weight) for s in sizes if s not in found}


class _Network:
    """A flow network; arcs lie in pairs with their reverse."""

    def __init__(self, nodes: int) -> None:
        self.out: list[list[int]] = [[] for _ in range(nodes)]
        self.to: list[int] = []
        self.room: list[int] = []
        self.cost: list[int] = []

    def arc(self, a: int, b: int, room: int, cost: int = 0) -> int:
        for x, y, r, c in ((a, b, room, cost), (b, a, 0, -cost)):
            self.out[x].append(len(self.to))
            self.to.append(y)
            self.room.append(r)
            self.cost.append(c)
        return len(self.to) - 2

    def _distances(self, start: int) -> list[int | None]:
        far: list[int | None] = [None] * len(self.out)
        far[start], queue, waits = 0, deque([start]), {start}
        while queue:
            a = queue.popleft()
            waits.discard(a)
            for e in self.out[a]:
                b = self.to[e]
                if self.room[e] and (far[b] is None or far[a] + self.cost[e] < far[b]):
                    far[b] = far[a] + self.cost[e]
                    if b not in waits:
                        waits.add(b)
                        queue.append(b)
        return far

    def _path(self, start: int, end: int, far: list, tried: list[int], on: list[bool]) -> list[int]:
        """Arcs of a cheapest path with room; ``tried`` counts the arcs of each node that lead nowhere."""
        path, a = [], start
        on[start] = True
        while a != end:
            while tried[a] < len(self.out[a]):
                e = self.out[a][tried[a]]
                b = self.to[e]
                if self.room[e] and not on[b] and far[b] is not None and far[b] == far[a] + self.cost[e]:
                    break
                tried[a] += 1
            else:
                if not path:
                    return []
                on[a] = False
                a = self.to[path.pop() ^ 1]
                tried[a] += 1
                continue
            path.append(e)
            a = b
            on[a] = True
        return path

    def run(self, start: int, end: int) -> None:
        """The largest flow of the least cost: cheapest paths first, all of one length before the next."""
        while (far := self._distances(start))[end] is not None:
            tried = [0] * len(self.out)
            while path := self._path(start, end, far, tried, [False] * len(self.out)):
                room = min(self.room[e] for e in path)
                for e in path:
                    self.room[e] -= room
                    self.room[e ^ 1] += room


def _components(patterns) -> list[list[Pattern]]:
    """Patterns that share sources, directly or through others."""
    of: dict[Source, Source] = {}

    def root(s: Source) -> Source:
        while of.setdefault(s, s) != s:
            of[s] = of[of[s]]
            s = of[s]
        return s

    for p in patterns:
        for s in p[1:]:
            of[root(s)] = root(p[0])
    groups = defaultdict(list)
    for p in patterns:
        groups[root(p[0])].append(p)
    return list(groups.values())


def flow(tokens: Mapping[Pattern, int], quotas: Mapping[Source, int], costs: Sequence[int] = COSTS) -> dict[Pattern, dict[Source, int]]:
    """Tokens that each pattern gives to each of its sources: as many as quotas and copies allow, at the least cost.

    Patterns without common sources are routed apart, so a table whose documents have one
    source each costs a step for each source.
    """
    routed: dict[Pattern, dict[Source, int]] = {}
    for group in _components(sorted((p for p in tokens if p), key=lambda p: [(s is None, s or "") for s in p])):
        if len(group) == 1 and len(group[0]) == 1:
            (p,) = group
            routed[p] = {p[0]: min(quotas[p[0]], len(costs) * tokens[p])}
            continue
        sources = in_order({s for p in group for s in p})
        net = _Network(2 + len(group) + len(sources))
        at = {s: 2 + len(group) + i for i, s in enumerate(sources)}
        arcs = {}
        for i, p in enumerate(group):
            for cost in costs:
                net.arc(0, 2 + i, tokens[p], cost)
            arcs[p] = {s: net.arc(2 + i, at[s], len(costs) * tokens[p]) for s in p}
        for s in sources:
            net.arc(at[s], 1, quotas[s])
        net.run(0, 1)
        routed |= {p: {s: net.room[e ^ 1] for s, e in own.items()} for p, own in arcs.items()}
    return routed


def word_count(text: Column) -> Column:
    """Words of a text: runs of anything but white space. Null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def seeded_place(key: Column, seed: str = SEED) -> Column:
    """The place of a row in the seeded order, from 0 to 2**52."""
    named = F.concat(F.lit(f"{seed}/"), F.coalesce(key.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(named), 1, 13), 16, 10).cast("long")


def mixed(
    docs: DataFrame,
    members: Column,
    weights: Callable[[Sequence[Source]], Mapping[Source, int]] = cyclic_weights,
    total: int | None = None,
    seed: str = SEED,
) -> tuple[DataFrame, dict[Source, dict]]:
    """``doc_id, size, sources, taken`` of every row of ``docs`` (``doc_id``, ``text``), and the size, target and filled tokens of each source.

    ``members`` is an array with the sources of a row. A document counts in the size of each of
    its sources, but what is taken of it fills one quota. ``total`` tokens are shared by weight; without it, all there are.
    ``taken`` is a whole number of copies, at most three. Rows without sources are not taken. Null and
    empty texts have no words; null ids and sources are values like others; repeated rows count
    again; other columns are ignored; no rows give no rows. Reruns agree.
    """
    spark = docs.sparkSession
    sized = docs.select(
        "doc_id", word_count(F.col("text").cast("string")).alias("size"),
        F.array_sort(F.array_distinct(F.coalesce(members, F.array().cast("array<string>")))).alias("sources"),
        seeded_place(F.col("doc_id"), seed).alias("place"),
    )
    sized = staged(sized.withColumn("pattern", F.to_json("sources")), "sized")

    parts = sized.groupBy("pattern", F.shiftright("place", 40).alias("part")).agg(F.first("sources").alias("sources"), F.sum("size").alias("size"))
    parts = staged(parts, "parts")
    patterns = parts.groupBy("pattern").agg(F.first("sources").alias("sources"), F.sum("size").alias("size"))
    found = patterns.limit(MAX_PATTERNS + 1).collect()
    if len(found) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} membership patterns")
    tokens = {tuple(in_order(r.sources)): r.size for r in found}
    names = {tuple(in_order(r.sources)): r.pattern for r in found}
    sizes: dict[Source, int] = defaultdict(int)
    for p, size in tokens.items():
        for s in p:
            sizes[s] += size
    aim = targets(sizes, weights(list(sizes)), sum(tokens[p] for p in tokens if p) if total is None else total) if sizes else {}
    routed = flow(tokens, {s: int(t + Fraction(1, 2)) for s, t in aim.items()})
    filled: dict[Source, int] = defaultdict(int)
    shares = []
    for p, own in routed.items():
        for s, n in own.items():
            filled[s] += n
        copies, rest = divmod(sum(own.values()), tokens[p]) if tokens[p] else (0, 0)
        shares.append((names[p], copies, rest))
    report = {s: {"size": sizes[s], "target": float(aim[s]), "filled": filled[s]} for s in in_order(sizes)}

    plan = spark.createDataFrame(shares, "pattern string, copies long, rest long")
    before = Window.partitionBy("pattern").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ends = parts.withColumn("start", F.coalesce(F.sum("size").over(before), F.lit(0))).join(plan, "pattern")
    ends = ends.where("start < rest and rest < start + size or start + size = rest and size > 0 and rest > 0")
    ends = ends.select("pattern", "copies", "part", (F.col("rest") - F.col("start")).alias("left")).collect()
    cut = {r.pattern: (r.part, r.left) for r in ends}
    # Parts before the cut are taken once more, those behind it not.
    full = spark.createDataFrame([(name, copies, *cut.get(name, (-1, 0))) for name, copies, _ in shares], "pattern string, copies long, cut long, left long")
    dealt = sized.join(full, "pattern", "left").withColumn("part", F.shiftright("place", 40))
    inside = Window.partitionBy("pattern").orderBy("place", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    at_cut = dealt.where("part = cut").withColumn("before", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    at_cut = at_cut.withColumn("more", (2 * F.col("before") + F.col("size") <= 2 * F.col("left")).cast("long")).drop("before")
    others = dealt.where("cut is null or part <> cut").withColumn("more", F.coalesce((F.col("part") < F.col("cut")).cast("long"), F.lit(0)))
    taken = (F.col("size") * (F.coalesce("copies", F.lit(0)) + F.col("more"))).cast("long")
    return others.unionByName(at_cut).select("doc_id", "size", "sources", taken.alias("taken")), report


def mixed_by_source(docs: DataFrame) -> DataFrame:
    """``doc_id, size, source_size, target, taken``: :func:`mixed` of rows with one source each, in column ``source``."""
    rows, report = mixed(docs, F.array(F.col("source").cast("string")))
    known = docs.sparkSession.createDataFrame(
        [(s, r["size"], r["target"]) for s, r in report.items()], "source string, source_size long, target double"
    )
    named = rows.withColumn("source", F.col("sources")[0])
    return named.join(known, F.col("sources")[0].eqNullSafe(known["source"])).select("doc_id", "size", "source_size", "target", "taken")
