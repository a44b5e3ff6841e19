"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns."""

import hashlib
import importlib.util
import math
import os
import random
import subprocess
import sys
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from tallyroll.llm import chat, graph, html_text, pieces, quality, shards, simhash, tiling, topk, urls, warc
from tallyroll.llm.common import row_keyed
from tallyroll.llm.queries import RULES, VOCABULARY

LONG = "lorem ipsum dolor sit amet consectetur " * 6000 + "x" * 50_000
TEXTS = [(1, "a b c d e"), (1, "a b c d e"), (2, None), (3, ""), (None, "a b c d e"), (None, None), (4, LONG), (5, " \t\n"), (6, "é▁ 🙂\x00")]
KIND = "doc_id long, text string, fp string, row_no int, score string, ids string, key string"


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("edges") / "docs")
    spark.createDataFrame([(d, t, "x", 9, "y", "z", "k") for d, t in TEXTS], KIND).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("doc_id = 99")


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.load_vocabulary(VOCABULARY, "rank")


def as_counts(rows):
    return Counter(map(str, rows))


def test_tokens(docs, none, vocabulary):
    rows = pieces.tokenized(docs, vocabulary, "doc_id").collect()
    assert len(rows) == len(TEXTS) and all(r.round_trip for r in rows)
    assert Counter(r.doc_id for r in rows) == Counter(d for d, _ in TEXTS)
    assert all((r.n_tokens == 0) == (r.doc_id in (2, 3) or r.n_tokens == 0) for r in rows)
    assert pieces.tokenized(none, vocabulary, "doc_id").count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=5))
def test_any_text_is_written_and_read_back(texts):
    tokenizer = test_any_text_is_written_and_read_back.__dict__.setdefault(
        "tokenizer", pieces.Tokenizer(pieces.load_vocabulary(VOCABULARY, "rank"))
    )
    ids, at = tokenizer.encode_all(texts)
    for t, a, b in zip(texts, at, at[1:], strict=False):
        assert tokenizer.decode(ids[a:b].tolist()) == t.replace("▁", " ")
        if t:
            whole = (pieces.MARK + t.replace(" ", pieces.MARK)).encode()
            total = lambda x: sum(tokenizer.scores[i] for i in x if i not in tokenizer.byte_ids)
            assert total(ids[a:b].tolist()) == pytest.approx(total(tokenizer.best_path(whole)), abs=1e-6)


def test_trie_and_pieces_across_markers():
    entries = {b"a": 1, b"ab": 2, b"abc": 3, b"\xc3\xa9": 4, b"b": 5}
    t = pieces.Trie.build(entries)

    def find(word):
        node = 0
        for b in word:
            to = t.base[node] + b
            if t.check[to] != node:
                return -1
            node = to
        return t.piece[node]

    assert {w: find(w) for w in entries} == entries and find(b"ac") == find(b"\xc3") == -1


def test_chat_parts(spark):
    kind = f"conv_id long, turn long, role string, parts {chat.PARTS}, segment string"
    part = lambda **x: {k: x.get(k) for k in ("kind", "text", "ref", "width", "height", "seconds", "pages")}
    mixed = [
        part(kind="text", text="see <|end|> \\ "), part(kind="image", ref="a.png", width=28, height=15), None,
        part(kind="audio", ref="b.wav", seconds=2.01), part(kind="document", ref="c.pdf", pages=3), part(kind="film", ref="d"),
        part(kind="text", text="[INST]"),
    ]
    rows = [(1, 0, "assistant", mixed, "q"), (1, None, None, None, "q"), (None, 0, "user", [], "q"), (1, 0, "<|part|>\n", [part(kind="text")], "q")]
    out = chat.formatted(spark.createDataFrame(rows, kind))
    got = {(r.conv_id, r.turn, r.segment): r for r in out.collect()}
    assert len(got) == 4
    r = next(r for r in got.values() if r.attachments)
    assert [(a.number, a.kind, a.ref, a.tokens) for a in r.attachments] == [
        (1, "image", "a.png", 4), (2, "audio", "b.wav", 51), (3, "document", "c.pdf", 1200), (4, "other", "d", 0)
    ]
    assert r.attachment_tokens == 1255
    assert r.segment.count("<|end|>") == 1 and r.segment.index("<|image:1|>") < r.segment.index("<|document:3|>")
    assert "".join(chat.unescape(r.segment[s.start : s.start + s.length]) for s in r.loss) == "see <|end|> \\ [INST]"
    assert {chat.parse(s)[0] for _, _, s in got} == {"assistant", "", "user", "<|part|>\n"}
    back = {r.conv_id: r for r in chat.read_back(out).collect()}
    assert back[1].n_turns == 3 and back[None].n_turns == 1
    assert back[None].loss_sha256 == hashlib.sha256(b"").hexdigest()
    assert chat.read_back(chat.formatted(spark.createDataFrame([], kind))).count() == 0


def test_no_control_string_is_formed_where_parts_meet(spark):
    kind = f"conv_id long, turn long, role string, parts {chat.PARTS}"
    empty = (None, None, None, None, None)
    cuts = [("</", "s>"), ("[IN", "ST]"), ("<", "|end|>"), ("<<SY", "", "S>>", " a \\"), ("\\", "<", "|x"), ("</s", ">")]
    rows = [(n, 0, "assistant", [("text", t, *empty) for t in cut]) for n, cut in enumerate(cuts)]
    rows.append((99, 0, "assistant", [("text", "<", *empty), ("image", None, "r", 14, 14, None, None), ("text", "|end|>", *empty)]))
    out = chat.formatted(spark.createDataFrame(rows, kind)).collect()
    for r in out:
        content = r.segment.split(chat.PART, 1)[1].removesuffix(chat.END)
        assert [m[0] for m in chat._control.finditer(content)] == (["<|"] if r.conv_id == 99 else [])
        text = "".join(cuts[r.conv_id]) if r.conv_id < 99 else "<|end|>"
        assert "".join(chat.unescape(r.segment[s.start : s.start + s.length]) for s in r.loss) == text


@given(st.text(alphabet="<|>/s[INST]\\ a\n"))
def test_escaping_is_reversible_and_hides_controls(text):
    assert chat.unescape(chat.escape(text)) == text
    assert not chat._control.search(chat.escape(text))


def test_urls(spark):
    rows = [(1, None), (2, ""), (3, "no scheme"), (4, "http://"), (4, "http://"), (5, "x://A.ORG?q://b/"), (6, "http://É.org/en"),
            (7, "http://org/"), (8, "http://aorg/"), (9, "http://www.example.org/en/12#x"), (10, "http://a\nb.com/de/\n?"), (None, LONG)]
    pages = spark.createDataFrame([(i, u, "h", "r") for i, u in rows], "page_id long, url string, host string, rule string")
    model = urls.fit(spark.createDataFrame(urls.LABELLED, "url string, label int"))
    out = urls.judged(pages, RULES, model).collect()
    got = {r.page_id: (r.host, r.path, r.rule) for r in out}
    assert len(out) == len(rows)
    assert got[1] == got[2] == got[3] == got[4] == got[None] == ("", "", None)
    assert got[5] == ("a.org", "", None) and got[6] == ("É.org", "/en", "org/") and got[7] == ("org", "/", "org/")
    assert got[8] == ("aorg", "/", None) and got[9][2] == "example.org/en/1" and got[10] == ("a\nb.com", "/de/\n", "com/de/")
    assert urls.judged(pages.where("page_id = 99"), RULES, model).count() == 0
    assert urls.fit(spark.createDataFrame([], "url string, label int")).blocked(["a"], ["/"])[0] < 0.5


def test_quality(spark, docs, none):
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (3, None), (4, 7)], "doc_id long, quality int")
    model = quality.fit(docs, labels)
    rows = quality.classified(docs, model, "doc_id").collect()
    assert len(rows) == len(TEXTS) and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (2, 3)}) == 1
    assert quality.good(docs, labels.where("false")).count() == len(TEXTS)
    assert quality.good(none, labels).columns == docs.columns and quality.good(none, labels).count() == 0
    same = [quality.scores([t.encode()], model)[0] for t in ("a" * 700, "b")]
    assert quality.scores([b"a" * 700, b"b"], model).tolist() == pytest.approx(same)


def test_html():
    page = (
        "<html><head><title>T</title><style>p{}</style></head><body><div class='cookie-notice'>We use <b>cookies</b></div>"
        "<header>Site</header><div id=menu><div>in</div><a href=x>Home</a></div><main><h1>Head &amp; line</h1>"
        "<p>First <b>para\n</b>graph&nbsp;one.<p class=notice>Old<p>Second<script>if(a<b)'</p>'</script> part.</p>"
        "<aside>Also read <p>this</p></aside><p>Third &lt;end&gt;.</p><section class='comments'><p>Nice!</p></section></main>"
        "<form><input value='x'>Name</form><footer>&copy; all</footer></body></html><p"
    )
    assert html_text.main_text(page) == "Head & line First para graph one. Second part. Third <end>."
    plain = "<div><a href=1>Home</a> <a href=2>News</a></div>" + "<p>" + "word " * 60 + "</p><p>Short.</p>" + "<div><a href=3>Imprint of the site</a></div>"
    assert html_text.main_text(plain).startswith("word word") and "Short." in html_text.main_text(plain)
    for empty in (None, "", "<", "<p>", "<!-- never closed", "<script>x", "&", "<a b='"):
        assert html_text.main_text(empty) in ("", "&", "<")


def test_scripts_bring_no_markup_back():
    page = (
        "<article><p>A first paragraph of some length here.</p><script>if(i<n){/* don't */}</script>"
        "<p>It's a paragraph</p><style>a<b{content:'\"'}</style><p>and one more.</p></article>"
    )
    assert html_text.main_text(page) == "A first paragraph of some length here. It's a paragraph and one more."


def test_html_rows(spark, none):
    kind = "page_id long, url string, html string, text string"
    pages = spark.createDataFrame([(1, None, None, "t"), (None, "u", f"<p>{LONG}", "t"), (1, None, None, "t")], kind)
    got = html_text.extracted(pages).collect()
    assert Counter(r.n_chars for r in got) == Counter([0, 0, len(" ".join(LONG.split()))])
    assert html_text.extracted(pages.where("false")).count() == 0


def test_simhash_rows(docs, none):
    rows = simhash.near_duplicates(docs).collect()
    assert len(rows) == len(TEXTS)
    empty = [r for r in rows if r.fingerprint == "0" * 16]
    assert len(empty) == 4 and {r.component_id for r in empty} == {2}
    assert simhash.near_duplicates(none).count() == 0
    kept = simhash.deduplicated(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({r.component_id for r in rows})
    assert simhash.deduplicated(none).count() == 0


def test_components(spark):
    chain = [(i, i + 1) for i in range(60)] + [(100, 100), (200, 201), (200, 201), (None, 3)]
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(chain, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(61)} | {200: 200, 201: 200}
    assert graph.components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_shards(spark, docs, none):
    out = shards.sharded(docs, [1.0, 2.0, 0.0, 1.0])
    rows = out.collect()
    assert len(rows) == len(TEXTS) and {r.shard for r in rows} <= {0, 1, 3}
    for s in {r.shard for r in rows}:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))
    assert {(r.size, r.text_crc32) for r in rows if r.doc_id in (2, 3)} == {(16, 0)}
    assert shards.sharded(none, [1.0]).count() == 0
    keys = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    moved = shards.sharded(keys, [1.0, 3.0, 4.0], 2.0).groupBy("shard").count().collect()
    for r, share in zip(sorted(moved), (1 / 8, 3 / 8, 1 / 2), strict=True):
        assert r["count"] / 20_000 == pytest.approx(share, abs=0.015)
    grown = shards.sharded(keys, [1.0, 3.0, 4.0], 2.0).where("shard <> grown_shard")
    assert {r.grown_shard for r in grown.collect()} == {3} and grown.count() / 20_000 == pytest.approx(0.2, abs=0.015)
    for bad in ([], [0.0], [-1.0, 2.0]):
        with pytest.raises(ValueError):
            shards.sharded(docs, bad)


def test_tiling_rows(spark, docs, none):
    bench = spark.createDataFrame(
        [(7, "A, b. C d; e"), (7, "a b"), (8, None), (None, "lorem ipsum dolor sit amet consectetur"), (9, "")], "item_id long, text string"
    )
    got = Counter((r.doc_id, r.item_id, r.covered) for r in tiling.contaminated(docs, bench).collect())
    want = Counter({(4, None, 6): 1})
    for d in (1, 1, None):
        want.update([(d, 7, 5), (d, 7, 2)])
    assert got == want
    clean = tiling.decontaminated(docs, bench)
    assert clean.columns == docs.columns and sorted(str(r.doc_id) for r in clean.collect()) == ["2", "3", "5", "6", "None"]
    assert tiling.contaminated(none, bench).count() == tiling.contaminated(docs, bench.where("false")).count() == 0


def test_reordered_passages_are_found(spark):
    words = [f"w{i}" for i in range(40)]
    parts = [words[i : i + 10] for i in (20, 0, 30, 10)]
    text = " noise ".join(" ".join(p).upper() for p in parts)
    docs = spark.createDataFrame([(1, text), (2, " ".join(words[:15]))], "doc_id long, text string")
    bench = spark.createDataFrame([(5, " ".join(words))], "item_id long, text string")
    (row,) = tiling.contaminated(docs, bench).collect()
    assert (row.doc_id, row.covered, row.coverage) == (1, 40, 1.0)
    assert sorted(t.item_word for t in row.tiles) == [0, 10, 20, 30]


def test_top_k(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.5]), (1, [1.0, 0.5]), (1, [1.0, 0.5]), (2, None), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [None, 1.0]),
            (6, [-1.0]), (None, [1.0, 0.5]), (50, [0.001, -0.001]), (50, []), (7, [2.0, 2.0])]
    table = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<float>, rank int, score int")
    got = [tuple(r) for r in topk.top_k(table, F.col("vec_id") % 50 == 0, 3).orderBy("query_id", "rank").collect()]
    assert got[:3] == [(0, 1, 7, 512 * 384), (0, 2, 1, 256 * 256 + 128 * 128), (0, 3, 1, 256 * 256 + 128 * 128)]
    assert len(got) == 9
    few = [tuple(r) for r in topk.top_k(table.where("vec_id in (0, 6)"), F.col("vec_id") == 0, 5).collect()]
    assert few == [(0, 1, 6, -256 * 256)]
    assert topk.top_k(table.where("vec_id = 0"), F.col("vec_id") == 0).count() == 0
    assert topk.top_k(table.where("false"), F.col("vec_id") == 0).count() == 0


def test_top_k_of_large_components_is_exact(spark):
    draw = random.Random(3)
    rows = [(i, [draw.randint(-9, 9) / 4 for _ in range(3)]) for i in range(30)]
    rows += [(30, [1e30, -1e30, 0.3]), (31, [1e30, 1e30, 0.3]), (32, [-1e200, 1.5]), (33, [2.0**46, 0.0, -0.7]), (34, [2.0**46, 2.0**-9])]
    rows += [(40, [1e30, 1e30, 0.3]), (50, [1e308]), (60, [2.0**27, 0.1]), (70, [])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    whole = {i: [math.floor(Fraction(x) * 256) for x in v] for i, v in rows}
    want = []
    for q in (i for i in whole if i % 10 == 0):
        scores = sorted((-sum(a * b for a, b in zip(whole[q], whole[c], strict=False)), c) for c in whole if c != q)
        want += [(q, rank, c, max(-(2**63), min(-s, 2**63 - 1))) for rank, (s, c) in enumerate(scores[:6], 1)]
    got = [tuple(r) for r in topk.top_k(table, F.col("vec_id") % 10 == 0, 6).orderBy("query_id", "rank").collect()]
    assert got == want


def test_top_k_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk, "QUERY_ROWS", 3)
    monkeypatch.setattr(topk, "CANDIDATE_ROWS", 7)
    draw = random.Random(5)
    rows = [(i, [draw.randint(-2, 2) / 4 for _ in range(6)]) for i in range(60)]
    rows += [(100 + i, [0.5] * 6) for i in range(20)] + [(200, [-40.0] * 6)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3, "vec_id")
    whole = {i: [math.floor(256 * x) for x in v] for i, v in rows}
    want = []
    for q in (i for i in whole if i % 10 == 0):
        scores = sorted((-sum(a * b for a, b in zip(whole[q], whole[c], strict=True)), c) for c in whole if c != q)
        want += [(q, rank, c, -s) for rank, (s, c) in enumerate(scores[:5], 1)]
    got = [tuple(r) for r in topk.top_k(table, F.col("vec_id") % 10 == 0).orderBy("query_id", "rank").collect()]
    assert got == sorted(want)


def bytes_sent(df):
    """Bytes that the exchanges of a query wrote when its rows were collected."""
    plans, total = [df._jdf.queryExecution().executedPlan()], 0
    while plans:
        node = plans.pop()
        name = node.nodeName()
        if "AdaptiveSparkPlan" in name:
            plans.append(node.executedPlan())
        elif "QueryStage" in name:
            plans.append(node.plan())
        elif "ReusedExchange" not in name:
            total += node.metrics().apply("dataSize").value() if name.startswith("Exchange") else 0
            plans += [node.children().apply(i) for i in range(node.children().size())]
    return total


@pytest.mark.parametrize("block, times", [(None, 8), (4096, 40)])
def test_top_k_sends_vectors_a_few_times_however_many_ask(spark, monkeypatch, tmp_path, block, times):
    """Every vector asks; the blocks are few, or with a small bound many on both sides."""
    if block:
        monkeypatch.setattr(topk, "BLOCK", block)
    n, dims = 4000, 16
    whole = np.random.default_rng(8).integers(-200, 200, (n, dims))
    whole[::7] = whole[0]  # ties, more than are asked for
    rows = [(i, v) for i, v in enumerate((whole / 256).tolist())]
    spark.createDataFrame(rows, "vec_id long, embedding array<double>").write.parquet(str(tmp_path / "v"))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as tables of any size beyond a broadcast are joined
    try:
        top = topk.top_k(spark.read.parquet(str(tmp_path / "v")), F.lit(True))
        got = sorted(tuple(r) for r in top.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    score = whole @ whole.T
    want = []
    for q in range(n):
        order = np.lexsort((np.arange(n), -score[q]))
        want += [(q, rank, c, score[q, c]) for rank, c in enumerate(order[order != q][:5].tolist(), 1)]
    assert got == want
    assert 0 < bytes_sent(top) < times * whole.nbytes


@pytest.mark.parametrize("least, types", [(0, {"response": 5, "revisit": 3}), (1, {"response": 6, "revisit": 2})])
def test_warc(spark, tmp_path, least, types):
    trap = "\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n"
    rows = [(3, "http://a/", "same é"), (1, "http://b/\r\nWARC-Type: x", "same é"), (1, None, "same é"), (4, "u", None), (5, "u", ""),
            (6, "u", trap), (None, "u", "none"), (7, "u", LONG)]
    kind = "page_id long, url string, html string, digest string, no int"
    spark.createDataFrame([(*r, "x", 1) for r in rows], kind).write.parquet(str(tmp_path / "pages"))
    pages = spark.read.parquet(str(tmp_path / "pages"))
    warc.write_pages(pages, str(tmp_path / "warc"), least)
    nested = warc.captures(warc.read_records(spark, str(tmp_path / "warc"))).collect()
    assert len(nested) == len(rows) and all(len(r.requests) == len(r.metadata) == 1 for r in nested)
    payloads = Counter(bytes(r.main.payload) for r in nested if r.main.type == "response")
    assert set(payloads) == {(h or "").encode() for _, _, h in rows}
    assert all(r.main.payload_digest in (None, r.main.header_digest) for r in nested)
    got = warc.page_captures(spark, str(tmp_path / "warc")).collect()
    assert Counter(r.record_type for r in got) == types
    assert all(r.refers_to == 1 for r in got if r.record_type == "revisit" and r.payload_bytes)
    assert Counter(r.payload_bytes for r in got) == Counter(len((h or "").encode()) for _, _, h in rows)
    assert warc.round_trip(pages.where("page_id = 99")).count() == 0


def test_records_without_a_response_are_kept(spark):
    names = warc._NAMES
    rows = [dict.fromkeys(names) | {"type": "request", "record_id": "<r>", "concurrent_to": "<gone>"},
            dict.fromkeys(names) | {"type": "metadata", "record_id": "<m>", "concurrent_to": "<gone>"}]
    (row,) = warc.captures(spark.createDataFrame([tuple(r[n] for n in names) for r in rows], warc._RECORDS)).collect()
    assert row.main is None and len(row.requests) == len(row.metadata) == 1


def test_stages_on_edges(spark, docs, none, tmp_path):
    spark.createDataFrame([(1, 1)], "doc_id long, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, "q r s t u v")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    full = docs.select("*", F.lit("en").alias("lang"), F.lit("s").alias("source"))
    for table, n in ((full, len(TEXTS)), (full.where("false"), 0)):
        table.write.mode("overwrite").parquet(str(tmp_path / "in"))
        read = spark.read.parquet(str(tmp_path / "in"))
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, read, str(tmp_path))
            assert out.columns == read.columns and out.count() <= n
        assert corpus_pipeline.STAGES[-1][1](spark, read, str(tmp_path)).count() == n


def test_the_rest_imports_without_these_operators(tmp_path):
    repo = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    for name in ("__spark_entry__.py", "checks", "tallyroll"):
        if os.path.isdir(f"{repo}/{name}"):
            os.makedirs(tmp_path / name)
            for sub in os.listdir(f"{repo}/{name}"):
                if sub not in ("llm", "__pycache__"):
                    os.symlink(f"{repo}/{name}/{sub}", tmp_path / name / sub)
        else:
            (tmp_path / name).write_text(open(f"{repo}/{name}").read())
    code = "import __spark_entry__ as e; assert 'payslips' in e.queries() and not [q for q in e.queries() if q.startswith('op')]"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={**os.environ, "PYTHONPATH": str(tmp_path)})
    assert importlib.util.find_spec("corpus_pipeline")


def test_row_keys_do_not_follow_the_splits_of_a_scan(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.range(0, 4000, numPartitions=3).select("id", F.sha2(F.col("id").cast("string"), 256).alias("h")).write.option("parquet.block.size", 4096).parquet(path)

    def keys(split: str) -> dict:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        rows = row_keyed(spark.read.parquet(path), "key")
        assert rows.rdd.getNumPartitions() > (3 if split == "8k" else 0)
        return {r["id"]: r["key"] for r in rows.collect()}

    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        small, large = keys("8k"), keys("128m")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert small == large and len(set(small.values())) == 4000


def test_rows_that_lie_in_no_file_get_keys_too(spark):
    rows = row_keyed(spark.range(5).toDF("_metadata"), "key").collect()
    assert sorted(r["_metadata"] for r in rows) == list(range(5)) and len({r["key"] for r in rows}) == 5
