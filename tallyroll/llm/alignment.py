"""Alignment of two tokenizers by the spans that their libraries give.

Character offsets of the byte-level tokenizer and spans of the sentencepiece proto are coarse
cuts of the bytes of a text. Where a cut falls inside a character of several bytes, or a token is a
fallback byte, the decoded bytes of the tokens refine it. Cuts of both tokenizers split the text
into stretches; the two tokens over a stretch are linked, and a cut of both ends a group.

Neither tokenizer has tokens that reach over a space behind a character that is not white space, so a text is cut there
into words first, and each distinct word is aligned once for a block of documents. A block is stored as one
row. The counts of id pairs are bounded by the vocabularies, not by the documents; they are broadcast if they are few
and reach the blocks by a join if not.
"""

from __future__ import annotations

import gc
import hashlib
import os
import re
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache, partial
from itertools import chain, islice
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyroll.llm.automata import gathered
from tallyroll.llm.common import staged

#: Words and documents of a block, and distinct words that a worker keeps from block to block.
BLOCK_WORDS, BLOCK_DOCS, KEPT_WORDS = 500_000, 10_000, 700_000
#: Words that are encoded at once.
BATCH = 2_048
#: Id pairs that are broadcast, of 24 bytes each. With more the counts of each block come by a join.
PAIR_LIMIT = 2_000_000
_CUT = re.compile("(?<=[^\\s▁]) (?=.)", re.DOTALL)
#: White space before a space; without any, all spaces are cuts.
_ODD = re.compile("[\\s▁] |^ ")
_CLOSED = re.compile("[^\\s▁]\\Z")
_BYTE = re.compile("<0x([0-9A-F]{2})>")

Batches = Iterator[pa.RecordBatch]


class Pair(NamedTuple):
    """Two tokenizers and the bytes of their tokens."""

    a: object
    b: object
    bytes_a: list[bytes]
    bytes_b: list[bytes]
    sizes_a: np.ndarray
    sizes_b: np.ndarray


def byte_alphabet() -> dict[str, int]:
    """The characters by which byte-level vocabularies write bytes: printable ones stand for themselves, the others follow 255 in order."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    odd = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(odd)}


@lru_cache(maxsize=2)
def load(path_a: str, path_b: str) -> Pair:
    """The byte-level tokenizer of one file and the sentencepiece model of another, loaded once by each worker."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(path_a)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=path_b)
    alphabet = byte_alphabet()
    bytes_a = [b""] * a.get_vocab_size()
    for token, i in a.get_vocab().items():
        bytes_a[i] = bytes(alphabet[c] for c in token) if all(c in alphabet for c in token) else token.encode()
    pieces = [b.id_to_piece(i) for i in range(b.get_piece_size())]
    bytes_b = [bytes([int(m[1], 16)]) if (m := _BYTE.fullmatch(p)) and b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
    sizes = (np.fromiter(map(len, x), np.int64, len(x)) for x in (bytes_a, bytes_b))
    return Pair(a, b, bytes_a, bytes_b, *sizes)


def words_of(text: str) -> list[str]:
    """The words of a text. A space stands before each, also the first, and both tokenizers cut before it."""
    return _CUT.split(text) if text[-1] == " " or _ODD.search(text) else text.split(" ")


class Spans(NamedTuple):
    """Tokens of many words, one after the other: ids, ends in bytes of all words, and how many each word has."""

    ids: np.ndarray
    ends: np.ndarray
    counts: np.ndarray


def _refined(ids: np.ndarray, coarse: np.ndarray, sure: np.ndarray, sizes_of: np.ndarray, words: np.ndarray) -> tuple[Spans, np.ndarray]:
    """Tokens with their ends, and which words have tokens that do not add up to them.

    The ``coarse`` ends that are ``sure`` stand. Between them the sizes of the decoded tokens are added up
    from the last sure one.
    """
    sizes, at = sizes_of[ids], np.arange(len(ids))
    total = np.cumsum(sizes)
    last = np.maximum.accumulate(np.where(sure, at, -1))
    off = np.where(last >= 0, (coarse - total)[last], 0)
    ends = total + off
    stops = np.cumsum(words)
    owner = np.minimum(np.searchsorted(stops, ends), max(len(words) - 1, 0))
    counts = np.bincount(owner, minlength=len(words))
    bad = np.bincount(owner, sizes, len(words)).astype(np.int64) != words
    # The first token of a sure span must fit behind the last one.
    wrong = np.diff(ends, prepend=0) != sizes
    bad[owner[wrong]] = True
    return Spans(ids, ends, counts), bad


def _of_a(pair: Pair, words: list[bytes], sizes: np.ndarray) -> tuple[Spans, np.ndarray]:
    """Tokens of words that follow one another as one text."""
    found = pair.a.encode(b"".join(words).decode(), add_special_tokens=False)
    n = len(found)
    ids = np.array(found.ids, np.int64)
    spans = np.fromiter(chain.from_iterable(found.offsets), np.int64, 2 * n).reshape(-1, 2)
    # Offsets count characters: the bytes before a character come from the lead bytes of the text.
    text = np.frombuffer(b"".join(words), np.uint8)
    place = np.append(np.flatnonzero((text & 0xC0) != 0x80), len(text))
    # A token whose last character the next one shares ends inside of it.
    shared = np.zeros(n, bool)
    shared[:-1] = spans[1:, 0] < spans[:-1, 1]
    return _refined(ids, place[spans[:, 1]], ~shared, pair.sizes_a, sizes)


def _of_b(pair: Pair, words: list[bytes], sizes: np.ndarray) -> tuple[Spans, np.ndarray]:
    # The model adds the space that the first word starts with.
    found = pair.b.encode(b"".join(words)[1:].decode(), return_type="proto").pieces
    n = len(found)
    ids = np.fromiter((p.id for p in found), np.int64, n)
    ends = np.fromiter((p.end for p in found), np.int64, n)
    # A span starts where the last one ends; an empty one is the added space alone or a fallback byte inside of a character.
    return _refined(ids, ends + 1, ends > np.concatenate(([0], ends[:-1])) if n else ends > 0, pair.sizes_b, sizes)


class Aligned(NamedTuple):
    """What is known of many words: numbers for each, the texts of their groups, and their links."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    bad: np.ndarray
    groups: list[str]
    n_links: np.ndarray
    links: np.ndarray


def aligned(pair: Pair, words: list[str]) -> Aligned:
    """Aligns words, each with a space before it. A link is ``a << 32 | b``.

    They are encoded as one text. A word at whose end white space could join that of the next one is
    encoded alone, and so is each word of a text that does not add up.
    """
    encoded = [b" " + w.encode() for w in words]
    closed = np.fromiter((_CLOSED.search(w) is not None for w in words), bool, len(words))
    parts = [(np.flatnonzero(closed), _aligned(pair, [encoded[i] for i in np.flatnonzero(closed).tolist()]))] if closed.any() else []
    alone = np.flatnonzero(~closed).tolist()
    if parts and parts[0][1].bad.any():
        alone, parts = list(range(len(words))), []
    parts += [(np.array([i]), _aligned(pair, [encoded[i]])) for i in alone]
    order = np.argsort(np.concatenate([at for at, _ in parts]))
    every = _joined([x for _, x in parts])
    starts = np.cumsum(every.n_links) - every.n_links
    return Aligned(
        *(x[order] for x in (every.n_a, every.n_b, every.n_groups, every.bad)), [every.groups[i] for i in order.tolist()],
        every.n_links[order], every.links[gathered(starts[order], every.n_links[order])],
    )


def _joined(parts: list[Aligned]) -> Aligned:
    columns = zip(*parts, strict=True)
    return Aligned(*(np.concatenate(x) if isinstance(x[0], np.ndarray) else list(chain(*x)) for x in columns))


def _aligned(pair: Pair, words: list[bytes]) -> Aligned:
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    a, bad_a = _of_a(pair, words, sizes)
    b, bad_b = _of_b(pair, words, sizes)
    bad, n = bad_a | bad_b, len(words)
    text = b"".join(words)
    for spans, tokens in ((a, pair.bytes_a), (b, pair.bytes_b)):
        bad |= b"".join(map(tokens.__getitem__, spans.ids.tolist())) != text
    if bad.any():
        none = np.zeros(n, np.int64)
        return Aligned(none, none, none, np.ones(n, bool), [""] * n, none, none[:0])
    cuts = _distinct(np.concatenate((a.ends, b.ends)))
    over_a, over_b = np.searchsorted(a.ends, cuts), np.searchsorted(b.ends, cuts)
    stops = np.cumsum(sizes)
    common = np.intersect1d(a.ends, b.ends, assume_unique=True)
    return Aligned(
        a.counts, b.counts, np.bincount(np.searchsorted(stops, common), minlength=n), bad, _group_texts(a, b, common, n),
        np.bincount(np.searchsorted(stops, cuts), minlength=n), (a.ids[over_a] << 32) | b.ids[over_b],
    )


@lru_cache(maxsize=1)
def _names(top: int) -> list[str]:
    """Ids as text before each of ``,``, ``|``, ``;`` and the end of a word."""
    return [f"{i}{mark}" for mark in (",", "|", ";", "") for i in range(top)]


def _group_texts(a: Spans, b: Spans, common: np.ndarray, n: int) -> list[str]:
    """The groups of each word as ``a1,a2|b1;a3|b2``."""
    top = 1 << 17
    kinds, places = [], []
    for side, x in enumerate((a, b)):
        group = np.searchsorted(common, x.ends)
        last = common[group] == x.ends
        kind = np.where(last, 1 + side, 0)
        if side:
            kind[np.cumsum(x.counts)[x.counts > 0] - 1] = 3
        kinds.append(x.ids + kind * top)
        places.append(2 * group + side)
    order = np.argsort(np.concatenate(places), kind="stable")
    texts = list(map(_names(top).__getitem__, np.concatenate(kinds)[order].tolist()))
    ends = np.cumsum(a.counts + b.counts).tolist()
    return ["".join(texts[i:j]) for i, j in zip([0, *ends], ends, strict=False)]


def _distinct(values: np.ndarray) -> np.ndarray:
    values.sort()
    return values[np.diff(values, prepend=-1) != 0]


class _Lexicon:
    """Words aligned so far, by number."""

    def __init__(self, pair: Pair) -> None:
        self.pair, self.numbers, self.parts, self.done = pair, defaultdict(), [], 0
        self.numbers.default_factory = self.numbers.__len__

    def known(self) -> Aligned:
        new = list(islice(self.numbers, self.done, None))
        self.parts += [aligned(self.pair, new[i : i + BATCH]) for i in range(0, len(new), BATCH)]
        self.done = len(self.numbers)
        self.parts = [_joined(self.parts)]
        return self.parts[0]


#: The lexicon of this worker, by the files of its tokenizers. It only saves work.
_kept: dict[tuple[str, str], _Lexicon] = {}


def _lexicon(path_a: str, path_b: str) -> _Lexicon:
    found = _kept.get((path_a, path_b))
    if found is None or len(found.numbers) > KEPT_WORDS:
        _kept.clear()
        found = _kept[path_a, path_b] = _Lexicon(load(path_a, path_b))
    return found


_BLOCK = "block string, pairs array<long>, docs array<long>, data binary"


_PARTS = ["doc_ids", "shas", "numbers", "word_ends", "words", "link_ends", "links"]


def _block(name: str, ids: list[int | None], texts: list[str | None], lexicon: _Lexicon) -> pa.RecordBatch:
    """One row for a block of documents: their numbers, words and groups; the links of each word; and the distinct pairs with the documents that hold them."""
    per_doc = [words_of(t) if t else [] for t in texts]
    sizes = np.fromiter(map(len, per_doc), np.int64, len(per_doc))
    words = np.fromiter(map(lexicon.numbers.__getitem__, chain.from_iterable(per_doc)), np.int64, int(sizes.sum()))
    del per_doc
    used, words = np.unique(words, return_inverse=True)
    if len(used):
        x = lexicon.known()
    else:
        x = Aligned(*(np.empty(0, np.int64),) * 3, np.empty(0, bool), [], *(np.empty(0, np.int64),) * 2)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    # A document of which one word does not add up has no tokens.
    bad = np.bincount(owner, x.bad[used][words], len(sizes)) > 0
    keep = ~bad[owner]
    words, owner, sizes = words[keep], owner[keep], np.where(bad, 0, sizes)
    numbers = [np.bincount(owner, n[used][words], len(sizes)).astype(np.int64) for n in (x.n_a, x.n_b, x.n_groups, x.n_links)]
    ends = np.cumsum(sizes)
    groups = [x.groups[i] for i in used.tolist()]
    shas = [
        hashlib.sha256(";".join(map(groups.__getitem__, words[i:j].tolist())).encode()).hexdigest() if j > i else ""
        for i, j in zip((ends - sizes).tolist(), ends.tolist(), strict=True)
    ]
    starts = np.cumsum(x.n_links) - x.n_links
    counts = x.n_links[used]
    pairs, links = np.unique(x.links[gathered(starts[used], counts)], return_inverse=True)
    link_ends = np.cumsum(counts)
    # Distinct words of each document, then their distinct pairs.
    own = _distinct(owner * max(len(used), 1) + words)
    held, word = np.divmod(own, max(len(used), 1))
    spread = np.repeat(held, counts[word]) * max(len(pairs), 1) + links[gathered((link_ends - counts)[word], counts[word])]
    docs = np.bincount(_distinct(spread) % max(len(pairs), 1), minlength=len(pairs)).astype(np.int64)
    kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32())
    columns = (ids, shas, np.concatenate(numbers), ends, words, link_ends, links)
    data = pa.RecordBatch.from_arrays([pa.array([c], pa.list_(k)) for c, k in zip(columns, kinds, strict=True)], _PARTS)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, data.schema, options=pa.ipc.IpcWriteOptions(compression="lz4")) as writer:
        writer.write_batch(data)
    return pa.RecordBatch.from_arrays(
        [pa.array([name]), pa.array([pairs], pa.list_(pa.int64())), pa.array([docs], pa.list_(pa.int64())), pa.array([sink.getvalue().to_pybytes()])],
        ["block", "pairs", "docs", "data"],
    )


def _blocks(batches: Batches, path_a: str, path_b: str) -> Iterator[pa.RecordBatch]:
    """Maps ``doc_id, text`` to blocks, named by the task's partition and their place in it."""
    from pyspark import TaskContext

    task, made = TaskContext.get().partitionId(), 0
    gc.disable()  # nothing here makes cycles, and the search for them takes time
    ids, texts, size = [], [], 0
    for b in batches:
        for i, t in zip(b.column("doc_id"), b.column("text"), strict=True):
            ids.append(i.as_py())
            texts.append(t.as_py())
            size += (texts[-1] or "").count(" ") + 1
            if size >= BLOCK_WORDS or len(ids) >= BLOCK_DOCS:
                yield _block(f"{task}/{made}", ids, texts, _lexicon(path_a, path_b))
                ids, texts, size, made = [], [], 0, made + 1
    if ids:
        yield _block(f"{task}/{made}", ids, texts, _lexicon(path_a, path_b))
    gc.enable()


def _numbered(batches: Batches, table=None) -> Iterator[pa.RecordBatch]:
    """Maps blocks to a row for each document. The counts of pairs come from a broadcast table, sorted, or else with each block."""
    _kept.clear()
    for b in batches:
        for row in range(b.num_rows):
            parts = pa.ipc.open_stream(b.column("data")[row].as_buffer()).read_next_batch()
            of = lambda c, parts=parts: parts.column(c)[0].values
            n, pairs = len(of("doc_ids")), b.column("pairs")[row].values.to_numpy()
            ends, link_ends = of("word_ends").to_numpy(), of("link_ends").to_numpy()
            words, links = of("words").to_numpy(), of("links").to_numpy()
            count, best = np.zeros(len(pairs), np.int64), np.zeros(len(pairs), np.int64)
            if table is not None:
                at = np.searchsorted(table.value[0], pairs)
                count, best = table.value[1][at], table.value[2][at]
            elif (found := b.column("found")[row].values) is not None and len(found):
                at = found.field("at").to_numpy()
                count[at], best[at] = found.field("n").to_numpy(), found.field("best").to_numpy()
            word = np.repeat(np.arange(len(link_ends)), np.diff(link_ends, prepend=0))
            doc = np.repeat(np.arange(n), np.diff(ends, prepend=0))
            sums = []
            for x in (best, count):
                of_word = np.zeros(len(link_ends), np.int64)
                np.add.at(of_word, word, x[links])
                of_doc = np.zeros(n, np.int64)
                np.add.at(of_doc, doc, of_word[words])
                sums.append(of_doc)
            numbers = of("numbers").to_numpy().reshape(4, n)
            yield pa.RecordBatch.from_arrays(
                [of("doc_ids"), *map(pa.array, numbers), *map(pa.array, sums), of("shas")],
                ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"],
            )


def token_alignment(docs: DataFrame, path_a: str, path_b: str, pair_limit: int = PAIR_LIMIT) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of every row of ``docs`` (``doc_id``, ``text``).

    Both tokenizers encode a space and the text. Bytes where a token of each ends cut the tokens into
    groups; tokens that share bytes are linked. The count of an id pair is the number of rows
    that hold it linked. ``n_best`` are links whose count is the highest of their first id, and ``count_sum`` sums the
    counts of all links. Null and empty texts, and those that the tokens of either do not spell, have
    zeros and ''. Repeated rows count again; a null id is kept; other columns are ignored; no rows give no rows.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    blocks = staged(texts.mapInArrow(partial(_blocks, path_a=path_a, path_b=path_b), _BLOCK), "blocks")
    held = blocks.select("block", F.posexplode(F.arrays_zip("pairs", "docs")).alias("at", "x"))
    held = held.select("block", "at", F.col("x.pairs").alias("pair"), F.col("x.docs").alias("docs"))
    counts = staged(held.groupBy("pair").agg(F.sum("docs").alias("n")), "counts").withColumn("a", F.shiftright("pair", 32))
    highest = counts.groupBy("a").agg(F.max("n").alias("top"))
    counts = counts.join(highest, "a").select("pair", "n", (F.col("n") == F.col("top")).cast("long").alias("best"))
    counts = staged(counts, "best")
    out = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    blocks = blocks.drop("docs")
    if counts.count() <= pair_limit:
        known = counts.toArrow().sort_by("pair")
        table = docs.sparkSession.sparkContext.broadcast([known.column(c).to_numpy() for c in ("pair", "n", "best")])
        return blocks.mapInArrow(partial(_numbered, table=table), out)
    found = held.select("block", "at", "pair").join(counts, "pair").groupBy("block").agg(F.collect_list(F.struct("at", "n", "best")).alias("found"))
    return blocks.join(found, "block", "left").mapInArrow(_numbered, out)
