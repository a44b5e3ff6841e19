"""Near duplicates by five-word similarity, as in the pipeline's stage."""

import random
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from tallyroll.llm import near, simhash

SF = "/root/testdata/sf0.01"


def plain_kept(rows):
    """Ids kept by comparing every pair that shares a shingle."""
    sets = []
    for _, text in rows:
        w = (text or "").encode("utf-8", "surrogatepass").lower().split()
        n = min(5, len(w))
        sets.append(frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if w else frozenset())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    by, first = defaultdict(list), {}
    for i, s in enumerate(sets):
        if (j := first.setdefault(s, i)) != i:
            root[find(i)] = find(j)
            continue
        shared = Counter()
        for x in s:
            shared.update(by[x])
            by[x].append(i)
        for j, n in shared.items():
            if n / (len(s) + len(sets[j]) - n) >= 0.8:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), d), d)
    return sorted(least.values())


def test_stage_keeps_one_of_each_similar_group(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    got = corpus_pipeline.dedup_stage(spark, docs, SF)
    assert got.columns == docs.columns
    assert sorted(r.doc_id for r in got.collect()) == plain_kept(rows)


@pytest.mark.parametrize("edits", [2, 5])
def test_edited_copies_go(spark, edits, tmp_path):
    """Copies that differ in some words, chains of them and texts that share less."""
    rng = random.Random(edits)
    words = [f"w{i}" for i in range(3000)]
    base = rng.choices(words, k=200)
    texts = [" ".join(base)]
    for i in range(60):
        copy = list(texts[-1].split() if i % 3 == 0 else base)
        for at in rng.sample(range(200), edits + i % 4):
            copy[at] = rng.choice(words)
        texts.append(" ".join(copy))
    texts += [" ".join(base[:120] + rng.choices(words, k=80)) for _ in range(20)] + ["", "a b", "A  b", " "]
    rows = [(i, t) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    want = plain_kept(rows)
    assert sorted(r.doc_id for r in near.deduplicated(docs).collect()) == want
    assert near.deduplicated(docs.where("false")).count() == 0


def test_pairs_of_a_group_follow_its_size(spark, monkeypatch, tmp_path):
    """One group of copies, each with two words of its own: an index of about 0.8, on both sides of the bound."""
    rng, made = random.Random(9), []
    real = near._links
    monkeypatch.setattr(near, "_links", lambda pairs, sets: made.append(pairs.count()) or real(pairs, sets))
    words = [f"w{i}" for i in range(3000)]
    base, rows = rng.choices(words, k=200), []
    for i in range(240):
        copy = list(base)
        for at in rng.sample(range(200), 2):
            copy[at] = rng.choice(words)
        rows.append((i, " ".join(copy)))
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "d"))
    got = near.deduplicated(spark.read.parquet(str(tmp_path / "d")))
    assert sorted(r.doc_id for r in got.collect()) == plain_kept(rows)
    # All pairs would be 28,680.
    assert len(made) == 3 and sum(made) <= 40 * len(rows)


def edited(rng, base, words, edits):
    copy = list(base)
    for at in rng.sample(range(len(base)), edits):
        copy[at] = rng.choice(words)
    return " ".join(copy)


def test_pairs_grow_with_a_group_whose_copies_are_mostly_apart(spark, monkeypatch, tmp_path):
    """Copies with three words of their own have an index of about 0.75; some pairs still reach 0.8."""
    rng, words, real, per_row = random.Random(3), [f"w{i}" for i in range(3000)], near._links, []
    for size in (200, 800):
        base, made = rng.choices(words, k=200), []
        rows = [(i, edited(rng, base, words, 3)) for i in range(size)]
        spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / str(size)))
        monkeypatch.setattr(near, "_links", lambda pairs, sets, made=made: made.append(pairs.count()) or real(pairs, sets))
        got = near.deduplicated(spark.read.parquet(str(tmp_path / str(size))))
        assert sorted(r.doc_id for r in got.collect()) == plain_kept(rows)
        per_row.append(sum(made) / size)
    # All pairs are 99 and 399 a row.
    assert max(per_row) <= 30 and per_row[1] <= 2 * per_row[0]


def test_parts_of_a_group_meet_each_other(spark, monkeypatch, tmp_path):
    """Differences in many parts: the links between two parts are found as well."""
    rng, words = random.Random(4), [f"w{i}" for i in range(3000)]
    base = rng.choices(words, k=120)
    rows = [(i, edited(rng, base, words, 1 + i % 5)) for i in range(150)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "d"))
    made, real = [], near._joins
    monkeypatch.setattr(near, "PART", 1500)
    monkeypatch.setattr(near, "_joins", lambda parts: made.append(parts.select("key", "part").distinct().count()) or real(parts))
    got = near.deduplicated(spark.read.parquet(str(tmp_path / "d")))
    assert sorted(r.doc_id for r in got.collect()) == plain_kept(rows)
    assert len(made) == 2 and made[1] > 1


@pytest.mark.parametrize("seed", range(20))
def test_forest_joins_what_all_pairs_join(seed):
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 1 << 62, 60)
    sets = []
    for _ in range(120):
        keep = base[rng.random(60) > rng.uniform(0, 0.2)]
        sets.append(np.union1d(keep, rng.integers(0, 40, rng.integers(0, 8))))
    sets = [x for x in {x.tobytes(): x for x in sets}.values() if len(x)]
    n, pivot = len(sets), sets[0]
    roots = np.arange(n)
    roots[n // 2 : n // 2 + 3] = n // 2  # linked before
    diffs = [np.setxor1d(x, pivot) for x in sets]
    links = near._forest(np.arange(n), np.array([len(x) for x in sets]), roots, diffs)

    def similar(i, j):
        shared = len(np.intersect1d(sets[i], sets[j]))
        return shared / (len(sets[i]) + len(sets[j]) - shared) >= 0.8

    def joined(pairs):
        root = roots.copy()
        for i, j in pairs:
            root[root == root[i]] = root[j]
        return {frozenset(np.flatnonzero(root == r)) for r in root}

    every = [(i, j) for i in range(n) for j in range(i) if similar(i, j)]
    assert all(similar(i, j) for i, j in links)
    assert joined(links) == joined(every)
    assert len(links) == len(set(roots)) - len(joined(every))


def test_stage_runs_op6_over_all_documents(spark, monkeypatch, tmp_path):
    """What op6 groups is compared, even where the positions bring nothing together."""
    rng, words, seen = random.Random(5), [f"w{i}" for i in range(3000)], []
    bases = [rng.choices(words, k=400) for _ in range(20)]
    texts = [" ".join(b) for b in bases] + [" ".join([*b, "x"]) for b in bases[:8]] + [" ".join([*bases[0], "x", "y"]), "", None, "a b"]
    rows = list(enumerate(texts))
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    real = simhash.grouped
    monkeypatch.setattr(simhash, "grouped", lambda marked: seen.append({r.fp for r in marked.select("fp").collect()}) or real(marked))
    monkeypatch.setattr(near, "_postings", lambda one: one.where("false").selectExpr("sid", "0L as key"))
    got = corpus_pipeline.dedup_stage(spark, docs, str(tmp_path))
    prints = [simhash.fingerprint(t) for t in texts]
    assert seen == [{int(np.uint64(p).view(np.int64)) for p in prints}]
    # Copies that op6 links go, and no others.
    linked = sum((prints[i] ^ prints[i + 20]).bit_count() <= simhash.MAX_BITS for i in range(8))
    assert linked >= 5
    kept = {r.doc_id for r in got.collect()}
    assert kept >= {*range(20)} and {20 + i for i in range(8) if (prints[i] ^ prints[i + 20]).bit_count() <= simhash.MAX_BITS}.isdisjoint(kept)


def test_groups_of_op6_are_lists(spark):
    rows = [(1, 0, 9), (2, 0b1111, 9), (3, 0b1111_1111, 9), (4, -1, 9), (5, 0, 1), (1, 1 << 62 | 0xABCDEF << 20, 9)]
    found = defaultdict(set)
    for r in near._group_postings(spark.createDataFrame(rows, "sid long, fp long, size long")).collect():
        found[r.key].add(r.sid)
    assert sorted(map(sorted, found.values())) == [[1], [1, 2, 3], [4]]
