"""Collocations, mixing and alignment against plain versions, and their edge cases."""

import hashlib
import random
import re
from collections import Counter, defaultdict
from fractions import Fraction
from itertools import product

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyroll.llm import alignment, automata, mixing, phrases
from tallyroll.llm.queries import BYTE_LEVEL, QUERIES, VOCABULARY

SF = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows):
    """Documents with columns whose names the operators use inside."""
    made = spark.createDataFrame([(i, t, lang, s, 0) for i, t, lang, s in rows], DOCS)
    return made.select("*", *(F.lit("x").alias(c) for c in ("words", "size", "part", "pattern", "range", "ord", "block", "rank", "a")))


# Automata


def random_rows(rng, width, words):
    rows = rng.integers(0, len(words), (int(rng.integers(1, 60)), width))
    return rows, rng.integers(1, 9, len(rows))


def as_counts(words, rows, weights):
    found = Counter()
    for row, n in zip(rows.tolist(), weights.tolist(), strict=True):
        found[tuple(words[i] for i in row)] += n
    return found


def test_automata_equal_plain_counters():
    rng = np.random.default_rng(11)
    read = lambda x: as_counts(x.words, automata.paths(x), x.weights)
    for _ in range(200):
        width = int(rng.integers(1, 6))
        words = sorted({bytes(rng.integers(97, 100, int(rng.integers(1, 4))).astype(np.uint8)) for _ in range(8)})
        (a, wa), (b, wb) = random_rows(rng, width, words), random_rows(rng, width, words)
        x, y = automata.summed(words, a, wa), automata.summed(words, b, wb)
        assert read(x) == as_counts(words, a, wa)
        assert list(read(x)) == sorted(read(x))
        assert read(automata.from_bytes(automata.to_bytes(x))) == read(x)
        both = automata.union([x, y, x])
        want = Counter()
        for part in (x, y, x):
            want.update(read(part))
        assert read(both) == want
        rows, weights = automata.composed(y, both)
        assert as_counts(y.words, rows, weights) == {k: want[k] for k in read(y)}
        assert read(automata.pruned(both, 5)) == {k: n for k, n in want.items() if n >= 5}


def test_automata_share_prefixes_and_suffixes():
    words = [b"a", b"b", b"c", b"x", b"y"]
    rows = np.array([(i, j, k) for i in range(3) for j in (3, 4) for k in (3, 4)])
    x = automata.built(words, rows, np.arange(len(rows)))
    assert [len(labels) for labels in x.labels] == [3, 2, 2]
    assert x.weights.tolist() == list(range(12))


# 11


def plain_collocations(rows, least, top):
    sizes, counts = Counter(), defaultdict(Counter)
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lowered):
            words = re.findall("[^\x20\x09]+", piece)
            sizes[lang] += len(words)
            for n in range(1, 5):
                counts[lang].update(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
    out = []
    for lang, f in counts.items():
        candidates = [p for p in f if len(p) > 1 and f[p] >= least]
        inside = Counter()
        for p in candidates:
            for n in range(2, len(p)):
                for i in range(len(p) - n + 1):
                    inside[p[i : i + n]] = max(inside[p[i : i + n]], f[p])
        scored = []
        for p in candidates:
            if 100 * inside[p] < 80 * f[p] or not inside[p]:
                score, k = min((2_000_000 * f[p] // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-score, -f[p], " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, sizes[lang], -score))
    return sorted(out)


@pytest.mark.parametrize("bits", [64, 1 << 20])
def test_collocations_equal_a_plain_version(spark, bits):
    """Also with a filter so small that it lets everything through."""
    rng = random.Random(5)
    words = ["Alpha", "beta", "GAMMA", "delta", "é", "日本", "x\x1cy", "und"]
    texts = [
        "".join(rng.choice(words) + rng.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\n", "\r\n", " ! "]) for _ in range(rng.randint(0, 60)))
        for _ in range(120)
    ]
    rows = [(t, rng.choice(["en", "fr", None, "und", "alpha"])) for t in texts] + [(None, "en"), ("", None), ("solo", "only")]
    docs = documents(spark, [(i % 7, t, lang, "s") for i, (t, lang) in enumerate(rows * 2)])
    got = phrases.collocations(docs, least=4, top=50, filter_bits=bits)
    assert sorted(map(tuple, got.collect())) == plain_collocations(rows * 2, 4, 50)


def test_collocations_of_shards_smaller_than_a_text(spark, monkeypatch):
    text = "one two three four. " * 40 + "one two"
    docs = documents(spark, [(i, text, "en", "s") for i in range(3)])
    want = plain_collocations([(text, "en")] * 3, 30, 2000)
    assert sorted(map(tuple, phrases.collocations(docs).collect())) == want
    assert phrases.collocations(docs.limit(0)).collect() == []


def test_collocation_shards_and_unions_do_not_change_counts(monkeypatch):
    rng = random.Random(2)
    texts = [" ".join(rng.choices("a b c d e".split(), k=rng.randint(0, 30))).encode() for _ in range(50)]
    table = pa.table({"lang": pa.array([b"en", b"fr"] * 25, pa.binary()), "text": pa.array(texts, pa.binary())})

    def counted():
        shards = pa.Table.from_batches(phrases._counted(iter(table.to_batches(max_chunksize=7)), 5))
        ordered = shards.sort_by([("range", "ascending"), ("ord", "ascending")])
        found = Counter()
        for b in phrases._united(iter(ordered.to_batches(max_chunksize=3)), 3):
            for data in b.column("data"):
                x = automata.from_bytes(data.as_py())
                found.update(as_counts(x.words, automata.paths(x), x.weights))
        return found

    whole = counted()
    monkeypatch.setattr(phrases, "SHARD_WORDS", 20)
    monkeypatch.setattr(phrases, "SPLIT_BYTES", 40)
    assert counted() == whole and whole[(b"en",)] + whole[(b"fr",)] == sum(len(t.split()) for t in texts)


# 12


def test_targets_stop_at_three_times_the_size():
    rng = random.Random(1)
    for _ in range(300):
        sizes = {f"s{i}": rng.choice([0, 1, 3, 50, 1000]) for i in range(rng.randint(1, 8))}
        weights = mixing.cyclic_weights(list(sizes))
        total = sum(sizes.values())
        got = mixing.targets(sizes, weights, total)
        # The rule step by step: share, cut, share what was cut off.
        want, rest, open_ = {}, Fraction(total), set(sizes)
        while open_:
            weight = sum(weights[s] for s in open_)
            over = {s for s in open_ if rest * weights[s] / weight > 3 * sizes[s]}
            if not over:
                want |= {s: rest * weights[s] / weight for s in open_}
                break
            want |= {s: Fraction(3 * sizes[s]) for s in over}
            rest -= sum(want[s] for s in over)
            open_ -= over
        assert got == want and sum(got.values()) == total


def test_flow_is_the_cheapest_of_all():
    """Against every way to route small whole numbers."""
    rng = random.Random(4)
    for _ in range(60):
        patterns = {("a",): rng.randint(0, 2), ("a", "b"): rng.randint(0, 2), ("b", None): rng.randint(0, 2)}
        quotas = {s: rng.randint(0, 4) for s in ("a", "b", None)}
        arcs = [(p, s) for p in patterns for s in p]

        def value(amounts, patterns=patterns, quotas=quotas, arcs=arcs):
            by_pattern, by_source = Counter(), Counter()
            for (p, s), n in zip(arcs, amounts, strict=True):
                by_pattern[p] += n
                by_source[s] += n
            if any(n > 3 * patterns[p] for p, n in by_pattern.items()) or any(n > quotas[s] for s, n in by_source.items()):
                return None
            cost = sum(sum(max(0, min(n - c * patterns[p], patterns[p])) * c for c in range(3)) for p, n in by_pattern.items())
            return -sum(amounts), cost

        best = min(v for v in map(value, product(range(5), repeat=len(arcs))) if v)
        routed = mixing.flow(patterns, quotas)
        assert value([routed[p][s] for p, s in arcs]) == best


def test_mixing_of_overlapping_sources(spark):
    rng = random.Random(7)
    kinds = [["a"], ["a", "b"], ["b", "c"], [None], ["c", None], []]
    rows = [(i % 900, " ".join(["w"] * rng.randint(0, 40)), rng.choice(kinds)) for i in range(2000)] + [(None, None, ["a"]), (5, "", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, tags array<string>").withColumn("size", F.lit("x"))
    runs = [mixing.mixed(docs, F.col("tags")) for _ in range(2)]
    first, again = (sorted(map(str, rows.collect())) for rows, _ in runs)
    assert first == again and len(first) == len(rows)
    report = runs[0][1]
    assert list(report) == ["a", "b", "c", None]
    assert sum(r["filled"] for r in report.values()) == pytest.approx(sum(len((t or "").split()) for _, t, k in rows if k), abs=4)
    for r in report.values():
        assert r["filled"] == pytest.approx(r["target"], abs=1)
    for r in runs[0][0].collect():
        assert r.taken % max(r.size, 1) == 0 and r.taken <= 3 * r.size and (r.sources or r.taken == 0)
    taken = sum(r.taken for r in runs[0][0].collect())
    assert abs(taken - sum(r["filled"] for r in report.values())) <= 20 * len(kinds)


def test_mixing_of_odd_rows(spark):
    rows = [(1, None, "en", "a"), (1, "", "en", "a"), (2, "x y", "en", None), (2, "x y", "en", None), (None, "z " * 50, "en", "b")]
    got = mixing.mixed_by_source(documents(spark, rows)).collect()
    assert sorted((r.doc_id or 0, r.size, r.source_size, r.taken % max(r.size, 1)) for r in got) == [
        (0, 50, 50, 0), (1, 0, 0, 0), (1, 0, 0, 0), (2, 2, 4, 0), (2, 2, 4, 0),
    ]
    assert {r.target for r in got if r.size == 2} == {12.0}
    assert mixing.mixed_by_source(documents(spark, rows).limit(0)).collect() == []


def test_mixing_stays_near_its_targets(spark):
    got = QUERIES["op12_mixing"](spark, SF)
    by_source = got.groupBy("target", "source_size").agg(F.sum("taken").alias("taken"), F.max("size").alias("longest")).collect()
    assert len(by_source) == 20
    for r in by_source:
        assert abs(r.taken - r.target) <= r.longest / 2 + 1


# 13


def plain_alignment(pair, text):
    """Tokens, groups and links of a whole text, without its words."""
    if not text:
        return None
    full = f" {text}".encode()
    a, b = pair.a.encode(f" {text}", add_special_tokens=False).ids, pair.b.encode(text)
    if b"".join(pair.bytes_a[i] for i in a) != full or b"".join(pair.bytes_b[i] for i in b) != full:
        return None
    ends_a, ends_b = (np.cumsum([len(x[i]) for i in ids]).tolist() for ids, x in ((a, pair.bytes_a), (b, pair.bytes_b)))
    links, i, j = [], 0, 0
    while i < len(a) and j < len(b):
        links.append((a[i], b[j]))
        x, y = ends_a[i], ends_b[j]
        i, j = i + (x <= y), j + (y <= x)
    at_a, at_b = ({e: k + 1 for k, e in enumerate(x)} for x in (ends_a, ends_b))
    groups, p, q = [], 0, 0
    for e in sorted(at_a.keys() & at_b.keys()):
        groups.append(f"{','.join(map(str, a[p : at_a[e]]))}|{','.join(map(str, b[q : at_b[e]]))}")
        p, q = at_a[e], at_b[e]
    return len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()


def plain_rows(texts):
    pair = alignment.load(BYTE_LEVEL, VOCABULARY)
    found = [(i, plain_alignment(pair, t)) for i, t in texts]
    counts, top = Counter(), Counter()
    for _, x in found:
        counts.update(set(x[3]) if x else ())
    for (a, _), n in counts.items():
        top[a] = max(top[a], n)
    return Counter(
        (i, 0, 0, 0, 0, 0, 0, "") if x is None
        else (i, *x[:3], len(x[3]), sum(counts[p] == top[p[0]] for p in x[3]), sum(counts[p] for p in x[3]), x[4])
        for i, x in found
    )


def test_alignment_query(spark):
    texts = duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet'").fetchall()
    assert Counter(map(tuple, QUERIES["op13_alignment"](spark, SF).collect())) == plain_rows(texts)


def test_alignment_of_odd_texts(spark, monkeypatch):
    rng = random.Random(3)
    parts = list("abe ThE..,,  \n\t\r \xa0　é日本🎉ＡＢ▁0123's<>|/\"-_\x00\x1c\x85") + ["<|endoftext|>", "</s>", "the ", "  ", "<0x41>", "'re "]
    texts = ["".join(rng.choices(parts, k=rng.randint(1, 25))) for _ in range(600)]
    texts += [t.replace("▁", "") for t in texts] + [None, "", " ", "  ", "a ", " a", "a  ", "▁", "é", "ab" * 3000]
    rows = [(i % 500, t) for i, t in enumerate(texts)] + [(None, "a b"), (3, "a b"), (3, "a b")]
    docs = documents(spark, [(i, t, "en", "s") for i, t in rows])
    got = alignment.token_alignment(docs, BYTE_LEVEL, VOCABULARY)
    assert Counter(map(tuple, got.collect())) == plain_rows(rows)
    assert alignment.token_alignment(docs.limit(0), BYTE_LEVEL, VOCABULARY).collect() == []


def test_alignment_blocks_and_lexicon_do_not_change_rows(monkeypatch):
    pair = alignment.load(BYTE_LEVEL, VOCABULARY)
    texts = [t for (t,) in duckdb.sql(f"select text from '{SF}/documents.parquet' limit 60").fetchall()]
    lexicon = alignment._Lexicon(pair)
    halves = [alignment._block("b", list(range(30)), texts[i : i + 30], lexicon) for i in (0, 30)]
    whole = alignment._block("b", list(range(60)), texts, alignment._Lexicon(pair))
    shas = lambda b: pa.ipc.open_stream(b.column("data")[0].as_buffer()).read_next_batch().column("shas")[0].as_py()
    assert shas(halves[0]) + shas(halves[1]) == shas(whole)
    held = Counter()
    for b in halves:
        held.update(dict(zip(b.column("pairs")[0].as_py(), b.column("docs")[0].as_py(), strict=True)))
    assert held == dict(zip(whole.column("pairs")[0].as_py(), whole.column("docs")[0].as_py(), strict=True))
