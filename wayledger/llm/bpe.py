"""Byte-level BPE of whole texts in numpy.

Method: the distinct pieces of a batch are laid into padded matrices by length; in each round
every row merges its leftmost pair of least rank, ranks are looked up in a hash table of all
merges, and rows that have no pair left are taken out. Pieces seen before come from a dictionary
of bounded size.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

DEFAULT_DIR = "/opt/tokenizers"
# Fixed value: the piece pattern of byte-level vocabularies.
PIECES = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_NONE = np.int32(2**31 - 1)
_WIDTHS = (4, 8, 12, 16, 24, 32, 48, 64, 96, 128, 256, 512)
_CHUNK = 100_000


@dataclass(frozen=True)
class Vocabulary:
    """Ids of single bytes, and all merges by rank as (left, right, merged) ids."""

    of_byte: np.ndarray
    merges: np.ndarray

    @staticmethod
    def load(folder: str = DEFAULT_DIR, name: str = "byte_bpe_50k") -> Vocabulary:
        """Read ``name``.json; its tokens write each byte as a printable character."""
        with open(f"{folder}/{name}.json", encoding="utf-8") as f:
            model = json.load(f)["model"]
        ids, pairs = model["vocab"], [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        shown = {b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b}
        hidden = [b for b in range(256) if b not in shown]
        char = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
        return Vocabulary(np.array([ids[char[b]] for b in range(256)], np.int32), np.array([(ids[a], ids[b], ids[a + b]) for a, b in pairs], np.int32))


class PairTable:
    """Hash table from a pair of ids to its rank, open addressing, looked up by whole arrays."""

    def __init__(self, merges: np.ndarray):
        self.bits = max(10, int(np.ceil(np.log2(max(1, len(merges)) * 4))))
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.rank = np.full(1 << self.bits, _NONE, np.int32)
        self.merged = merges[:, 2].astype(np.int32)
        key = self._key(merges[:, 0], merges[:, 1])
        todo, slot = np.arange(len(key)), self._slot(key)
        while len(todo):
            free = self.keys[slot] < 0
            self.keys[slot[free]] = key[todo[free]]  # of several for one slot the last stays
            put = self.keys[slot] == key[todo]
            self.rank[slot[put]] = todo[put]
            todo, slot = todo[~put], (slot[~put] + 1) & ((1 << self.bits) - 1)

    @staticmethod
    def _key(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return (left.astype(np.int64) << 32) | right.astype(np.int64)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, ``_NONE`` where it is no merge or one side is padding (< 0)."""
        shape = left.shape
        left, right = left.ravel(), right.ravel()
        out = np.full(len(left), _NONE, np.int32)
        todo = np.flatnonzero((left >= 0) & (right >= 0))
        key = self._key(left[todo], right[todo])
        slot = self._slot(key)
        while len(todo):
            got = self.keys[slot]
            hit = got == key
            out[todo[hit]] = self.rank[slot[hit]]
            more = ~hit & (got >= 0)
            todo, key, slot = todo[more], key[more], (slot[more] + 1) & ((1 << self.bits) - 1)
        return out.reshape(shape)


def _merge_matrix(ids: np.ndarray, table: PairTable) -> tuple[np.ndarray, np.ndarray]:
    """Merge all rows of a padded matrix to the end; gives the matrix and the rows' lengths."""
    n, width = ids.shape
    ids = ids.copy()
    out = np.full((n, width), -1, np.int32)
    size = np.zeros(n, np.int64)
    row = np.arange(n)
    rank = table.ranks(ids[:, :-1], ids[:, 1:])
    while len(row):
        at = rank.argmin(1) if rank.shape[1] else np.zeros(len(row), np.int64)
        best = rank[np.arange(len(row)), at] if rank.shape[1] else np.full(len(row), _NONE)
        done = best == _NONE
        if done.any():
            out[row[done], : ids.shape[1]] = ids[done]
            size[row[done]] = (ids[done] >= 0).sum(1)
            live = ~done
            row, ids, rank, at, best = row[live], ids[live], rank[live], at[live], best[live]
            if not len(row):
                break
        r = np.arange(len(row))
        ids[r, at] = table.merged[best]
        # close the gap right of the merged token
        col = np.arange(ids.shape[1] - 1)
        ids = np.take_along_axis(ids, col + (col > at[:, None]), 1)
        col = np.arange(rank.shape[1] - 1)
        rank = np.take_along_axis(rank, col + (col >= at[:, None]), 1) if len(col) else rank[:, :0]
        if rank.shape[1]:
            left = at > 0
            rank[r[left], at[left] - 1] = table.ranks(ids[r[left], at[left] - 1], ids[r[left], at[left]])
            right = at < rank.shape[1]
            rank[r[right], at[right]] = table.ranks(ids[r[right], at[right]], ids[r[right], at[right] + 1])
    return out, size


def _merge_long(ids: np.ndarray, table: PairTable) -> np.ndarray:
    """The same for one very long piece, by a linked list and a queue of (rank, position)."""
    n = len(ids)
    tok, nxt, prv = ids.tolist(), list(range(1, n + 1)), list(range(-1, n - 1))
    rank = table.ranks(ids[:-1], ids[1:])
    queue = [(int(rank[i]), i, tok[i], tok[i + 1]) for i in np.flatnonzero(rank != _NONE)]
    heapq.heapify(queue)

    def push(i: int) -> None:
        j = nxt[i]
        if i >= 0 and j < n:
            k = int(table.ranks(np.array([tok[i]]), np.array([tok[j]]))[0])
            if k != _NONE:
                heapq.heappush(queue, (k, i, tok[i], tok[j]))

    while queue:
        k, i, a, b = heapq.heappop(queue)
        j = nxt[i]
        if tok[i] != a or j >= n or tok[j] != b:
            continue
        tok[i], tok[j] = int(table.merged[k]), -1
        nxt[i] = nxt[j]
        if nxt[j] < n:
            prv[nxt[j]] = i
        if prv[i] >= 0:
            push(prv[i])
        push(i)
    return np.array([t for t in tok if t >= 0], np.int32)


class Encoder:
    """Encodes texts; keeps the ids of up to ``keep`` distinct pieces."""

    def __init__(self, vocabulary: Vocabulary, keep: int = 300_000):
        import regex

        self.v, self.table, self.keep = vocabulary, PairTable(vocabulary.merges), keep
        self.pieces = regex.compile(PIECES)
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.flat = np.zeros(1 << 16, np.int32)
        self.used = 0
        self.offset: list[np.ndarray] = []
        self.length: list[np.ndarray] = []
        self.off = self.len = np.zeros(0, np.int64)

    def _store(self, words: list[str], ids: np.ndarray, lengths: np.ndarray) -> None:
        """``ids`` are those of all words, one after the other."""
        need = self.used + len(ids)
        if need > len(self.flat):
            self.flat = np.concatenate([self.flat[: self.used], np.zeros(max(need, 2 * len(self.flat)) - self.used, np.int32)])
        self.flat[self.used : need] = ids
        starts = self.used + np.cumsum(lengths) - lengths
        base = len(self.known)
        self.known.update(zip(words, range(base, base + len(words)), strict=True))
        self.off, self.len = np.concatenate([self.off, starts]), np.concatenate([self.len, lengths])
        self.used = need

    def learn(self, words: list[str]) -> None:
        """Encode pieces not yet known."""
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        size = np.array([len(r) for r in raw])
        edges = np.searchsorted(_WIDTHS, size)
        for k in np.unique(edges):
            pick = np.flatnonzero(edges == k)
            if k == len(_WIDTHS):
                for i in pick:
                    got = _merge_long(self.v.of_byte[np.frombuffer(raw[i], np.uint8)], self.table)
                    self._store([words[i]], got, np.array([len(got)]))
                continue
            width = _WIDTHS[k]
            for part in np.array_split(pick, -(-len(pick) * width // 4_000_000) or 1):
                joined = np.frombuffer(b"".join(raw[i] for i in part), np.uint8)
                there = np.arange(width) < size[part][:, None]
                ids = np.full(there.shape, -1, np.int32)
                ids[there] = self.v.of_byte[joined]
                out, n = _merge_matrix(ids, self.table)
                self._store([words[i] for i in part], out[np.arange(width) < n[:, None]], n)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and how many each text has."""
        out, counts = [], np.zeros(len(texts), np.int64)
        pieces: list[str] = []
        marks: list[tuple[int, int]] = []

        def flush() -> None:
            ids, n = self._ids(pieces)
            out.append(ids)
            upto = np.concatenate([[0], np.cumsum(n)])
            at = 0
            for i, k in marks:
                counts[i] += upto[at + k] - upto[at]
                at += k
            pieces.clear()
            marks.clear()

        for i, text in enumerate(texts):
            if len(text) < 1_000_000:
                got = self.pieces.findall(text)
                pieces += got
                marks.append((i, len(got)))
                if len(pieces) >= _CHUNK:
                    flush()
            else:
                found = (m.group() for m in self.pieces.finditer(text))
                while got := list(islice(found, _CHUNK)):
                    pieces += got
                    marks.append((i, len(got)))
                    flush()
        flush()
        return np.concatenate(out) if out else np.zeros(0, np.int32), counts

    def _ids(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if len(self.known) > self.keep:
            self._forget()
        new = [p for p in dict.fromkeys(pieces) if p not in self.known]
        if new:
            self.learn(new)
        at = np.fromiter(map(self.known.__getitem__, pieces), np.int64, len(pieces))
        n = self.len[at]
        total = int(n.sum())
        start = np.repeat(self.off[at] - (np.cumsum(n) - n), n)
        return self.flat[start + np.arange(total)], n


def _encode_batches(vocabulary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = None
        for b in batches:
            enc = enc or Encoder(vocabulary.value)
            step = 512
            for lo in range(0, b.num_rows, step):
                s = b.slice(lo, step)
                ids, n = enc.encode([t or "" for t in s.column(1).to_pylist()])
                offsets = pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32())
                yield pa.RecordBatch.from_arrays([s.column(0), pa.ListArray.from_arrays(offsets, pa.array(ids))], names=["doc_id", "ids"])

    return run


def encode_documents(documents: DataFrame, folder: str = DEFAULT_DIR, name: str = "byte_bpe_50k") -> DataFrame:
    """(doc_id, ids) of every document, without special tokens; their names are plain text.

    Null and empty texts give an empty list. Every row gives a row, repeated ones too. The
    vocabulary (a few MB, whatever the corpus) is read on the driver and broadcast. Extra columns
    are ignored.
    """
    vocabulary = documents.sparkSession.sparkContext.broadcast(Vocabulary.load(folder, name))
    return documents.select("doc_id", "text").mapInArrow(_encode_batches(vocabulary), "doc_id long, ids array<int>")
