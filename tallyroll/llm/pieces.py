"""SentencePiece encoding and decoding: Unigram Viterbi over a double-array trie.

The text's spaces become the marker U+2581 and one marker is put in front. Of all ways
to write the result as pieces, the one with the largest sum of log scores is taken. A
character that no piece starts with costs ten less than the lowest score and is written
as the pieces of its UTF-8 bytes, so every text can be written and read back.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MARK = "▁"
UNKNOWN_PENALTY = 10.0
#: Bytes of a chunk up to which many chunks are worked on at once, and cells of such a block.
_SHORT, _CELLS = 64, 1 << 16
#: Chunks and ids that a worker remembers before it starts anew.
_KNOWN, _KNOWN_IDS = 600_000, 6_000_000


@dataclass
class Vocabulary:
    """Pieces by id with their scores; ``bytes_`` has the id of each byte (-1: none)."""

    pieces: list[str]
    scores: np.ndarray
    usable: np.ndarray
    bytes_: np.ndarray
    unknown: int


def load_vocabulary(path: str, scores: str = "log") -> Vocabulary:
    """The pieces of a SentencePiece model file; the file is read on the driver.

    ``scores``: ``log`` if the file has log scores; ``rank`` if it has the negative ranks
    of merges, which become log scores by Zipf's law: the piece of rank r is as likely as
    1 / (r + 1) of the first.
    """
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    n = sp.get_piece_size()
    pieces = [sp.id_to_piece(i) for i in range(n)]
    value = np.array([sp.get_score(i) for i in range(n)], np.float64)
    if scores == "rank":
        value = -np.log1p(-np.minimum(value, 0))
    elif scores != "log":
        raise ValueError("scores must be log or rank")
    usable = np.array([not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) or sp.is_byte(i)) for i in range(n)])
    byte_ids = np.full(256, -1, np.int32)
    for i in range(n):
        if sp.is_byte(i):
            byte_ids[int(pieces[i][1:-1], 16)] = i
    return Vocabulary(pieces, value, usable, byte_ids, sp.unk_id())


@dataclass
class Trie:
    """Double array over UTF-8 bytes: the child of node n by byte b is base[n] + b if check there is n."""

    base: np.ndarray
    check: np.ndarray
    piece: np.ndarray  # id of the piece that ends at a node, else -1

    @classmethod
    def build(cls, entries: dict[bytes, int]) -> Trie:
        keys = sorted(k for k in entries if k)
        base, check, piece = [0] * 1024, [-1] * 1024, [-1] * 1024
        check[0] = 0
        free, wide = 257, 257  # where to look for one slot, and for several
        todo = [(0, 0, len(keys), 0)]  # node, range of keys below it, bytes read
        while todo:
            node, lo, hi, depth = todo.pop()
            if len(keys[lo]) == depth:
                piece[node] = entries[keys[lo]]
                lo += 1
            if lo == hi:
                continue
            heads, at = [], lo
            while at < hi:
                b, start = keys[at][depth], at
                while at < hi and keys[at][depth] == b:
                    at += 1
                heads.append((b, start, at))
            while free < len(check) and check[free] >= 0:
                free += 1
            start, tries = max((free if len(heads) == 1 else wide) - heads[0][0], 1), 0
            while True:
                if start + 256 >= len(check):
                    more = len(check)
                    base += [0] * more
                    check += [-1] * more
                    piece += [-1] * more
                if all(check[start + b] < 0 for b, _, _ in heads):
                    break
                start += 1
                tries += 1
            if tries > 16:
                wide = start + heads[0][0]
            base[node] = start
            for b, x, y in heads:
                check[start + b] = node
                todo.append((start + b, x, y, depth + 1))
        return cls(np.array(base, np.int32), np.array(check, np.int32), np.array(piece, np.int32))


class Tokenizer:
    """Encodes and decodes; holds no more than a fixed number of chunks seen before."""

    def __init__(self, vocabulary: Vocabulary):
        v = vocabulary
        self.byte_ids, self.unknown = v.bytes_, v.unknown
        usable = [(i, p) for i, p in enumerate(v.pieces) if v.usable[i] and p]
        self.trie = Trie.build({p.encode("utf-8"): i for i, p in reversed(usable)})
        self.scores = v.scores
        self.unk_score = float(min((v.scores[i] for i, _ in usable), default=0.0)) - UNKNOWN_PENALTY
        self.longest = max((len(p.encode("utf-8")) for _, p in usable), default=1)
        self.lists = [x.tolist() for x in (self.trie.base, self.trie.check, self.trie.piece)]
        self.surface = [p.encode("utf-8") for p in v.pieces]
        for b, i in enumerate(v.bytes_.tolist()):
            if i >= 0:
                self.surface[i] = bytes([b])
        for i in np.flatnonzero(~v.usable & ~np.isin(np.arange(len(v.pieces)), v.bytes_)):
            self.surface[i] = b""
        self.surface[v.unknown] = " ⁇ ".encode()
        # A text is cut where no piece reaches across: before a marker after another
        # character, and around a line end that is in no piece.
        if any(a != MARK and b == MARK for _, p in usable for a, b in zip(p, p[1:], strict=False)):
            self.cut = re.compile(r".+", re.S)
        elif any("\n" in p for _, p in usable):
            self.cut = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
        else:
            self.cut = re.compile(f"{MARK}+[^{MARK}\n]*|[^{MARK}\n]+|\n")
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.starts, self.sizes, self.ids = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int32)

    def best_path(self, data: bytes) -> list[int]:
        """Ids of the best way to write ``data``, one node after another."""
        base, check, piece = self.lists
        n = len(data)
        score = [float("-inf")] * (n + 1)
        back: list[tuple[int, int]] = [(0, -1)] * (n + 1)
        score[0] = 0.0
        for s in range(n):
            here = score[s]
            if here == float("-inf"):
                continue
            e = min(s + _char_size(data[s]), n)
            if here + self.unk_score > score[e]:
                score[e], back[e] = here + self.unk_score, (s, -1)
            node = 0
            for e in range(s, n):
                to = base[node] + data[e]
                if check[to] != node or to == 0:
                    break
                node = to
                i = piece[node]
                if i >= 0 and here + self.scores[i] > score[e + 1]:
                    score[e + 1], back[e + 1] = here + self.scores[i], (s, i)
        out: list[int] = []
        e = n
        while e > 0:
            s, i = back[e]
            out.extend([i] if i >= 0 else self._unknown(data[s:e])[::-1])
            e = s
        return out[::-1]

    def _unknown(self, char: bytes) -> list[int]:
        ids = self.byte_ids[list(char)].tolist()
        return ids if min(ids) >= 0 else [self.unknown]

    def best_paths(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``best_path`` of each of many short chunks, all of them a step at a time.

        Gives all ids, one chunk after another, the number of each chunk's ids, and the
        places of the chunks with unknown characters, which get no ids here.
        """
        t = self.trie
        n = len(chunks)
        size = np.fromiter(map(len, chunks), np.int64, n)
        width = int(size.max())
        # 255 is no byte of UTF-8, so no path goes on beyond a chunk's end.
        padded = b"".join([c.ljust(width, b"\xff") for c in chunks])
        text = np.ascontiguousarray(np.frombuffer(padded, np.uint8).reshape(n, width).T)
        score = np.full((width + 1, n), -np.inf)
        score[0] = 0
        origin = np.zeros((width + 1, n), np.int16)
        made = np.full((width + 1, n), -1, np.int32)
        for s in range(width):
            rows = np.flatnonzero(score[s] > -np.inf)
            rows = rows[size[rows] > s]
            if not len(rows):
                continue
            here = score[s, rows]
            after = np.minimum(s + _CHAR_SIZES[text[s, rows]], size[rows])
            better = here + self.unk_score > score[after, rows]
            score[after[better], rows[better]] = here[better] + self.unk_score
            origin[after[better], rows[better]] = s
            made[after[better], rows[better]] = -1
            node = np.zeros(len(rows), np.int32)
            for e in range(s, min(width, s + self.longest)):
                to = t.base[node] + text[e, rows]
                ok = t.check[to] == node
                if not ok.all():
                    rows, node, here = rows[ok], to[ok], here[ok]
                    if not len(rows):
                        break
                else:
                    node = to
                ids = t.piece[node]
                value = np.where(ids >= 0, here + self.scores[ids], -np.inf)
                better = value > score[e + 1, rows]
                chosen = rows[better]
                score[e + 1, chosen] = value[better]
                origin[e + 1, chosen] = s
                made[e + 1, chosen] = ids[better]
        every, e, steps = np.arange(n), size.copy(), []
        while (on := e > 0).any():
            steps.append(np.where(on, made[e, every], -2))
            e = np.where(on, origin[e, every], 0)
        path = np.array(steps[::-1]).T
        unknown = (path == -1).any(axis=1)
        path[unknown] = -2
        return path[path >= 0], (path >= 0).sum(axis=1), np.flatnonzero(unknown)

    def _learn(self, chunks: set[str]) -> None:
        names = list(chunks)
        coded = [c.encode("utf-8", "surrogatepass") for c in names]
        size = np.fromiter(map(len, coded), np.int64, len(coded))
        order = np.argsort(size, kind="stable")
        sizes, ids, held = [self.sizes], [self.ids], len(self.sizes)
        at = 0
        alone = order[size[order] > _SHORT].tolist()
        short = order[: len(order) - len(alone)]
        while at < len(short):
            end = at + max(_CELLS // int(size[short[at]] + 1), 1)
            some = short[at:end].tolist()
            flat, counts, unknown = self.best_paths([coded[i] for i in some])
            self.known.update(zip([names[i] for i in some], range(held, held + len(some)), strict=True))
            held += len(some)
            sizes.append(counts)
            ids.append(flat)
            alone += [some[i] for i in unknown.tolist()]
            at = end
        for i in alone:
            path = self.best_path(coded[i])
            self.known[names[i]] = held
            held += 1
            sizes.append(np.array([len(path)]))
            ids.append(np.array(path, np.int32))
        self.sizes, self.ids = np.concatenate(sizes), np.concatenate(ids)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)])[:-1]

    def encode_all(self, texts: list[str], block: int = 1 << 21) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after another, and where each text's ids start (and the last end)."""
        parts, counts = [], []
        at = 0
        while at < len(texts):
            size, end = 0, at
            while end < len(texts) and (size < block or end == at):
                size += len(texts[end])
                end += 1
            cut = [self.cut.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts[at:end]]
            flat = [c for x in cut for c in x]
            if len(self.known) > _KNOWN or len(self.ids) > _KNOWN_IDS:
                self._forget()
            if new := set(flat).difference(self.known):
                self._learn(new)
            if flat:
                which = np.fromiter(map(self.known.__getitem__, flat), np.int64, len(flat))
                n = self.sizes[which]
                before = np.concatenate([[0], np.cumsum(n)])
                parts.append(self.ids[np.repeat(self.starts[which] - before[:-1], n) + np.arange(before[-1])])
                ends = before[np.cumsum([len(x) for x in cut])]
            else:
                ends = np.zeros(len(cut), np.int64)
            counts.append(np.diff(np.concatenate([[0], ends])))
            at = end
        none = [np.empty(0, np.int32)]
        return np.concatenate(parts or none), np.concatenate([[0], np.cumsum(np.concatenate(counts or none))]).astype(np.int64)

    def encode(self, text: str) -> list[int]:
        return self.encode_all([text])[0].tolist()

    def decode(self, ids: list[int]) -> str:
        """The text: bytes are put together, markers become spaces, and the one in front goes.

        Bytes that are no UTF-8 become U+FFFD; control pieces give nothing.
        """
        text = b"".join(map(self.surface.__getitem__, ids)).decode("utf-8", "replace").replace(MARK, " ")
        return text.removeprefix(" ")


def _char_size(lead: int) -> int:
    return 1 if lead < 0xC0 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4


_CHAR_SIZES = np.array([_char_size(b) for b in range(256)])


def tokenized(docs: DataFrame, vocabulary: Vocabulary, *keys: str) -> DataFrame:
    """The columns ``keys``, ``ids`` (array of int), ``n_tokens``, ``n_bytes`` and ``round_trip`` of each row.

    ``n_bytes`` counts the ids of single bytes. ``round_trip`` is true if decoding gives
    the text again, U+2581 read as a space, which the marker can't be told from. Null and
    empty texts have no ids. Repeated rows stay; an empty table gives no rows.
    """
    # The vocabulary is a file of fixed size, whatever the data.
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = Tokenizer(sent.value)
        is_byte = np.zeros(len(sent.value.pieces), bool)
        is_byte[sent.value.bytes_[sent.value.bytes_ >= 0]] = True
        for b in batches:
            where = b.schema.get_field_index("_text")
            rest = [(b.column(i), f.name) for i, f in enumerate(b.schema) if i != where]
            texts = [x.as_py() or "" for x in b.column(where)]
            ids, at = tokenizer.encode_all(texts)
            single = np.concatenate([[0], np.cumsum(is_byte[ids])])
            same = [
                tokenizer.decode(ids[x:y].tolist()) == t.replace(MARK, " ")
                for t, x, y in zip(texts, at[:-1].tolist(), at[1:].tolist(), strict=True)
            ]
            counts = np.diff(at).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    *(c for c, _ in rest),
                    pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids)),
                    pa.array(counts),
                    pa.array((single[at[1:]] - single[at[:-1]]).astype(np.int32)),
                    pa.array(same, pa.bool_()),
                ],
                [*(n for _, n in rest), "ids", "n_tokens", "n_bytes", "round_trip"],
            )

    rows = docs.select(*keys, F.col("text").cast("string").alias("_text"))
    schema = rows.drop("_text").schema.add("ids", T.ArrayType(T.IntegerType())).add("n_tokens", "integer").add("n_bytes", "integer")
    return rows.mapInArrow(run, schema.add("round_trip", "boolean"))
