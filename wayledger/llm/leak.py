"""Held-out evaluation passages printed on corpus pages.

Method: the evaluation items are an inverted index with BM25 impacts in blocks; every passage of
every page is a query against it, answered by block-max WAND with all items above a threshold. A
retrieved item is verified on the page: its words must be printed in order, as an unbroken
stretch of at least ``min_words`` words, read column by column.

Terms are neighbouring word pairs and pairs with one word between, so that a misread word or a
spurious space leaves enough of a passage to be found, while the words of a language alone, or
the same words in another order, don't add up to a score.

What retrieval can't lose: the threshold of an item is a share of the least score that any
``min_words`` consecutive words of it have, so neither its length nor how many other items hold
the same words raises it. Long items are indexed in overlapping pieces, identical texts once, and
document frequencies are those of all items whatever block they are searched in.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from bisect import bisect_left
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayledger.session import materialize


@dataclass(frozen=True)
class LeakRules:
    """What counts as leaked, and how candidates are found.

    ``share``: a piece of an item is retrieved by a passage that scores more than this share of
    the least score of ``min_words`` consecutive words of the piece. A passage has ``passage``
    words, and one starts every ``stride`` words.

    ``max_insert`` is the longest advert, in words, that may stand inside a stretch. There may be
    any number of them, with at least two words of the stretch at its ends and ``between`` words
    between two adverts.

    Items are indexed in pieces of ``piece`` words that overlap by ``overlap``, and are searched
    in blocks of about ``max_words_per_index`` words.
    """

    min_words: int = 12
    share: float = 1 / 6
    passage: int = 96
    stride: int = 48
    max_insert: int = 60
    between: int = 4
    piece: int = 96
    overlap: int = 24
    max_words_per_index: int = 2_000_000
    block: int = 16


# Code points of scripts written without blanks: their words are single characters.
_UNSPACED = ((0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3040, 0x30FF), (0x31F0, 0x31FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x323AF))
# Letters that are themselves: ideographs and syllables without accents or case.
_PLAIN = ((0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xAC00, 0xD7A3), (0x20000, 0x323AF))
_SAME = {"ß": "s", "æ": "a", "œ": "o", "ø": "o", "ł": "l", "đ": "d", "ı": "i", "ς": "σ"}
_SEVERAL = 1


def _bare(ch: str) -> str:
    """The letters and digits of a character, lower-case and without accents."""
    flat = unicodedata.normalize("NFKD", ch.lower())
    return "".join(_SAME.get(x, x) for x in flat if x.isalnum() or unicodedata.category(x) == "Mc")


def _letters() -> np.ndarray:
    """Code point to code point: lower-case base letters of any script, digits, newline, ``-`` for
    hyphens, 0 for marks, 1 for what is several letters, else blank."""
    table = np.full(0x110000, 32, np.uint32)
    for lo, hi in _PLAIN:
        table[lo : hi + 1] = np.arange(lo, hi + 1)
    for c in range(0x20000):
        if table[c] != 32:
            continue
        ch = chr(c)
        kind = unicodedata.category(ch)
        if ch in "-=¬\u00ad‐‑":
            table[c] = 45
        elif ch == "\n":
            table[c] = 10
        elif kind == "Mn":
            table[c] = 0
        elif ch.isalnum() or kind == "Mc":
            bare = _bare(ch)
            table[c] = ord(bare) if len(bare) == 1 else _SEVERAL if bare else 32
    return table


_TABLE: np.ndarray | None = None
_SINGLE: np.ndarray | None = None
_BROKEN = re.compile(r"- *\n *")


def plain(text: str) -> str:
    """Letters and digits, blanks, newlines and hyphens; accents and case are gone.

    Characters of scripts without blanks stand apart, each a word of its own.
    """
    global _TABLE, _SINGLE
    if _TABLE is None:
        _TABLE = _letters()
        _SINGLE = np.zeros(0x110000, bool)
        for lo, hi in _UNSPACED:
            _SINGLE[lo : hi + 1] = True
    if text.isascii():
        out = _TABLE[np.frombuffer(text.encode("ascii"), np.uint8)].astype(np.uint8)
        return out[out > 0].tobytes().decode("ascii")
    out = _TABLE[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    if (out == _SEVERAL).any():
        text = "".join(_bare(c) if _TABLE[ord(c)] == _SEVERAL else c for c in text)
        out = _TABLE[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    out = out[out > 0]
    at = np.flatnonzero(_SINGLE[out])
    if len(at):
        out = np.insert(out, np.concatenate([at, at + 1]), 32)
    return out.tobytes().decode("utf-32-le")


def words_of(lines: Sequence[str]) -> list[str]:
    """Words of plain lines in reading order, words broken at a line end joined again."""
    s = _BROKEN.sub("", "\n".join(lines))
    return s.replace("-", " ").split()


def reading_order(doc: np.ndarray, x0: np.ndarray, y0: np.ndarray, x1: np.ndarray) -> np.ndarray:
    """Order of lines: by page, column and height.

    A column starts where the left edges of a page's lines leave a gap of 3 % of its width.
    """
    if not len(doc):
        return np.zeros(0, np.int64)
    by_x = np.lexsort((x0, doc))
    d, x = doc[by_x], x0[by_x]
    starts = np.flatnonzero(np.append(True, d[1:] != d[:-1]))
    width = np.maximum.reduceat(x1[by_x], starts) - x[starts]
    gap = np.repeat(np.maximum(12, 0.03 * width), np.diff(np.append(starts, len(d))))
    fresh = np.append(True, (d[1:] != d[:-1]) | (x[1:] - x[:-1] > gap[1:]))
    column = np.empty(len(d), np.int64)
    column[by_x] = np.cumsum(fresh)
    return np.lexsort((np.arange(len(doc)), y0, column, doc))


def _word_key(w: str) -> int:
    """A stable 64-bit key of a word, never 0."""
    return xxhash.xxh3_64_intdigest(w) or 1


def _pair_keys(h: np.ndarray, gap: int) -> np.ndarray:
    """Keys of the terms that start at each word: the pairs of words ``gap`` apart."""
    a, b = h[:-gap], h[gap:]
    return a * np.uint64(0x9E3779B97F4A7C15) + ((b << np.uint64(31)) | (b >> np.uint64(33))) * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(gap)


GAPS = (1, 2)


def pieces(n: int, rules: LeakRules) -> list[tuple[int, int]]:
    """Where the pieces of a text of n words start and end; none if it is too short to be found."""
    if n < rules.min_words:
        return []
    step = rules.piece - rules.overlap
    return [(lo, min(n, lo + rules.piece)) for lo in range(0, max(1, n - rules.overlap), step)]


def piece_terms(words: Sequence[str], rules: LeakRules) -> list[np.ndarray]:
    """The distinct term keys of each piece of a text."""
    h = np.fromiter((_word_key(w) for w in words), np.uint64, len(words))
    return [np.unique(np.concatenate([_pair_keys(h[lo:hi], g) for g in GAPS])) for lo, hi in pieces(len(words), rules)]


@dataclass(frozen=True)
class TermStatistics:
    """Of all items: the number of pieces, their mean length, and in how many each term stands."""

    pieces: int
    mean_words: float
    keys: np.ndarray
    count: np.ndarray


class ItemIndex:
    """BM25 inverted index of item pieces, impacts in blocks of postings with their maxima.

    Impacts are in units of the piece's own threshold, so that 1 is the bound of every piece.
    ``texts`` are (id, words); ``stats`` those of all items, by default of these.
    """

    def __init__(self, texts: Sequence[tuple[int, Sequence[str]]], rules: LeakRules, stats: TermStatistics | None = None, k1: float = 1.2, b: float = 0.75):
        self.block = rules.block
        self.words: list[Sequence[str]] = []
        self.ids: list[int] = []
        self.key_of: dict[str, int] = {}
        spans, keys, owner, place = [], [], [], []
        for i, words in texts:
            for w in words:
                if w not in self.key_of:
                    self.key_of[w] = _word_key(w)
            h = np.fromiter((self.key_of[w] for w in words), np.uint64, len(words))
            for lo, hi in pieces(len(words), rules):
                n = len(self.ids)
                self.ids.append(i)
                self.words.append(words[lo:hi])
                spans.append(h[lo:hi])
                for g in GAPS:
                    k = _pair_keys(h[lo:hi], g)
                    keys.append(k)
                    owner.append(np.full(len(k), n))
                    place.append(np.arange(len(k)) * len(GAPS) + (g - 1))
        none = np.zeros(0, np.int64)
        key = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
        who, at = (np.concatenate(x) if x else none for x in (owner, place))
        order = np.lexsort((at, who, key))
        key, who, self.at = key[order], who[order], at[order]
        fresh = np.ones(len(key), bool)
        fresh[1:] = (key[1:] != key[:-1]) | (who[1:] != who[:-1])
        post = np.flatnonzero(fresh)  # one posting per term and piece
        self.at_from = np.append(post, len(key))
        self.post_piece, post_key = who[post], key[post]
        first = np.flatnonzero(np.append(True, post_key[1:] != post_key[:-1])) if len(post) else none
        self.keys, self.post_from = post_key[first], np.append(first, len(post))
        total, mean = (stats.pieces, stats.mean_words) if stats else (len(self.ids), sum(map(len, self.words)) / max(1, len(self.ids)))
        held = stats.count[np.searchsorted(stats.keys, self.keys)] if stats else np.diff(self.post_from)
        idf = np.repeat(np.log(1 + (total - held + 0.5) / (held + 0.5)), np.diff(self.post_from))
        tf = np.diff(self.at_from)
        size = np.array([len(w) for w in self.words] or [0])
        impact = idf * tf * (k1 + 1) / (tf + k1 * (1 - b + b * size[self.post_piece] / max(1e-9, mean)))
        # least score of min_words consecutive words of each piece, each term counted once
        least = np.empty(len(self.ids))
        by_place = np.empty(len(key))
        by_place[order] = np.repeat(impact, tf)
        lo = 0
        for n, h in enumerate(spans):
            score = np.zeros(len(h) - rules.min_words + 1)
            for g in GAPS:
                k = _pair_keys(h, g)
                before = _previous(k)
                view = lambda x, g=g: np.lib.stride_tricks.sliding_window_view(x, rules.min_words - g)
                start = np.arange(len(score))[:, None]
                score += np.where(view(before) < start, view(by_place[lo : lo + len(k)]), 0.0).sum(1)
                lo += len(k)
            least[n] = score.min()
        self.impact = impact / (rules.share * least[self.post_piece]) if len(impact) else impact
        self._entries: dict[int, tuple] = {}

    def entry(self, t: int) -> tuple:
        """A term's pieces, impacts, places, and its blocks' last pieces and maxima."""
        e = self._entries.get(t)
        if e is None:
            if len(self._entries) > 100_000:
                self._entries.clear()
            a, b = int(self.post_from[t]), int(self.post_from[t + 1])
            docs, impact = self.post_piece[a:b].tolist(), self.impact[a:b].tolist()
            last = [docs[min(i + self.block, len(docs)) - 1] for i in range(0, len(docs), self.block)]
            best = [max(impact[i : i + self.block]) for i in range(0, len(docs), self.block)]
            e = self._entries[t] = (docs, impact, a, last, best, max(best))
        return e

    def places(self, t: int, n: int) -> list[tuple[int, int]]:
        """(word, gap) of each occurrence of term t in piece n."""
        docs, _, a, *_ = self.entry(t)
        k = bisect_left(docs, n)
        if k == len(docs) or docs[k] != n:
            return []
        return [(int(x) // len(GAPS), int(x) % len(GAPS) + 1) for x in self.at[self.at_from[a + k] : self.at_from[a + k + 1]]]

    def bounded(self, term: np.ndarray, slices: list[tuple[int, int]]) -> list[bool]:
        """For each slice of the terms, whether in some block of four pieces they could pass 1 together.

        The sum of all impacts in a block is no less than the score of any of its pieces. Terms with
        many postings are left to the search itself, which skips.
        """
        size = self.post_from[term + 1] - self.post_from[term]
        ends = np.append(0, np.cumsum(size))
        if ends[-1] > 20_000:
            return [True] * len(slices)
        flat = np.arange(ends[-1]) + np.repeat(self.post_from[term] - ends[:-1], size)
        block, impact = self.post_piece[flat] // 4, self.impact[flat]
        return [b > a and bool(np.bincount(block[ends[a] : ends[b]], impact[ends[a] : ends[b]]).max() > 1.0 - 1e-9) for a, b in slices]

    def hits(self, words: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """(word, term) of the page's terms that the index has, in reading order."""
        h = np.fromiter(map(self.key_of.get, words, repeat(0)), np.uint64, len(words))
        at, term = [], []
        for g in GAPS:
            j = np.flatnonzero((h[:-g] > 0) & (h[g:] > 0))
            k = _pair_keys(h, g)[j]
            t = np.searchsorted(self.keys, k)
            ok = t < len(self.keys)
            ok[ok] = self.keys[t[ok]] == k[ok]
            at.append(j[ok])
            term.append(t[ok])
        at, term = np.concatenate(at), np.concatenate(term)
        order = np.argsort(at, kind="stable")
        return at[order], term[order]


def _previous(k: np.ndarray) -> np.ndarray:
    """Where the same value stood last, -1 for nowhere."""
    order = np.argsort(k, kind="stable")
    out = np.full(len(k), -1)
    same = k[order[1:]] == k[order[:-1]]
    out[order[1:][same]] = order[:-1][same]
    return out


def wand(hits: list[tuple], threshold: float, block: int) -> list[int]:
    """All items that score above the threshold for the terms of one passage.

    ``hits`` are the index entries of the passage's distinct terms. Document at a time with a
    pivot: lists are kept by their current item; items before the pivot can't reach the threshold
    by the lists' maxima, and blocks that can't by the blocks' maxima are skipped whole.
    """
    lists = [[h[0][0], 0, h] for h in hits]
    lists.sort(key=lambda x: x[0])
    found = []
    while lists:
        bound, pivot = 0.0, -1
        for k, x in enumerate(lists):
            bound += x[2][5]
            if bound > threshold:
                pivot = k
                break
        if pivot < 0:
            return found
        item = lists[pivot][0]
        while pivot + 1 < len(lists) and lists[pivot + 1][0] == item:
            pivot += 1
        # block bound of the lists up to the pivot
        bound, jump = 0.0, sys.maxsize
        for x in lists[: pivot + 1]:
            docs, _, _, last, best, _ = x[2]
            k = x[1] // block
            while k < len(last) and last[k] < item:
                k += 1
            if k < len(last):
                bound += best[k]
                jump = min(jump, last[k] + 1)
        if pivot + 1 < len(lists):
            jump = min(jump, lists[pivot + 1][0])
        if bound <= threshold:
            goal = max(item + 1, jump) if jump != sys.maxsize else item + 1
        elif lists[0][0] == item:
            score = 0.0
            for x in lists[: pivot + 1]:
                score += x[2][1][x[1]]
            if score > threshold:
                found.append(item)
            goal = item + 1
        else:
            goal = item
        for x in lists[: pivot + 1]:
            docs, at = x[2][0], x[1]
            while at < len(docs) and docs[at] < goal:
                at += 1
            x[1] = at
            x[0] = docs[at] if at < len(docs) else sys.maxsize
        lists = [x for x in lists if x[0] != sys.maxsize]
        lists.sort(key=lambda x: x[0])
    return found


def edit_distance(a: str, b: str, most: int) -> int:
    """Levenshtein distance, or ``most + 1`` as soon as it must be larger."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    x, y = set(a), set(b)  # a letter that the other lacks takes an edit
    if len(x - y) > most or len(y - x) > most:
        return most + 1
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        prev, row[0] = row[0], i
        low = i
        for j, y in enumerate(b, 1):
            cur = min(row[j] + 1, row[j - 1] + 1, prev + (x != y))
            prev, row[j] = row[j], cur
            low = min(low, cur)
        if low > most:
            return most + 1
    return row[-1]


def alike(a: str, b: str) -> bool:
    """One misread in short words, up to a third of the letters in longer ones."""
    if a == b:
        return True
    most = max(1, max(len(a), len(b)) // 3)
    if len(a) < 3 or len(b) < 3:
        return len(a) == len(b) and edit_distance(a, b, 1) <= 1 and len(a) > 1
    return edit_distance(a, b, most) <= most


def _extend(item: Sequence[str], page: Sequence[str]) -> int:
    """How many leading words of ``item`` are printed at the start of ``page``, misread or not.

    A word of the item may be split in two on the page, two may run together, and one may be
    illegible if the next two are read.
    """
    i = j = 0
    good = 0
    while i < len(item) and j < len(page):
        if alike(item[i], page[j]):
            i, j = i + 1, j + 1
        elif j + 1 < len(page) and alike(item[i], page[j] + page[j + 1]):
            i, j = i + 1, j + 2
        elif i + 1 < len(item) and alike(item[i] + item[i + 1], page[j]):
            i, j = i + 2, j + 1
        elif i + 2 < len(item) and j + 2 < len(page) and alike(item[i + 1], page[j + 1]) and alike(item[i + 2], page[j + 2]):
            i, j = i + 3, j + 3
        else:
            break
        good = i
    return good


def _unlike(a: Sequence[str], b: Sequence[str]) -> tuple[str, str]:
    """The letters of two word sequences without the words that are the same at either end."""
    lo, m = 0, min(len(a), len(b))
    while lo < m and a[lo] == b[lo]:
        lo += 1
    hi = 0
    while hi < m - lo and a[len(a) - 1 - hi] == b[len(b) - 1 - hi]:
        hi += 1
    return "".join(a[lo : len(a) - hi]), "".join(b[lo : len(b) - hi])


def longest_stretch(item: Sequence[str], page: Sequence[str], points: list[tuple[int, int]], rules: LeakRules) -> int:
    """The most consecutive words of the item that are printed in order on the page, or the first
    number found that is at least ``rules.min_words``.

    ``points`` are (item word, page word) pairs read alike. They are chained so that both move on
    together; up to ``min_words`` words between chained points may differ in 45 % of their letters
    (30 % beyond four words), and by three words more or less. The
    page may be ahead by an advert where the item goes on with the very next words. Both ends
    are extended over misread words.

    A chain is in state 0 before its first advert, then in the state of its words since the last
    advert, up to ``rules.between``: from there on another advert may follow.
    """
    points = sorted(set(points))
    n, full, enough = len(points), rules.between, rules.min_words
    best = [[1] * n, *([0] * n for _ in range(full))]
    back = [[None] * n for _ in range(full + 1)]

    def reach(s: int, q: int, length: int, via: tuple[int, int]) -> None:
        if length > best[s][q]:
            best[s][q], back[s][q] = length, via

    for q in range(n):
        iq, jq = points[q]
        for p in range(q - 1, -1, -1):
            ip, jp = points[p]
            di, dj = iq - ip, jq - jp
            if di > enough + 1:
                break
            if di < 1 or dj < 1:
                continue
            if abs(dj - di) <= 3:
                gains = [(s, 0 if s == 0 else min(full, s + di)) for s in range(full + 1) if best[s][p]]
                gains = [(s, to) for s, to in gains if best[s][p] + di > best[to][q]]
                if not gains:
                    continue
                if di > 1 or dj > 1:
                    a, b = _unlike(item[ip + 1 : iq], page[jp + 1 : jq])
                    most = max(2, int((0.45 if di <= 5 else 0.3) * max(len(a), len(b))))
                    if edit_distance(a, b, most) > most:
                        continue
                for s, to in gains:
                    reach(to, q, best[s][p] + di, (s, p))
            elif di <= 2 and dj <= rules.max_insert:
                if best[0][p] >= 2:
                    reach(1, q, best[0][p] + di, (0, p))
                if best[full][p]:
                    reach(1, q, best[full][p] + di, (full, p))
        if best[0][q] >= enough:
            return best[0][q]
    top, after_of, before_of = 0, {}, {}
    for length, s, q in sorted(((best[s][q], s, q) for s in range(full + 1) for q in range(n) if best[s][q]), reverse=True):
        first = (s, q)
        while back[first[0]][first[1]] is not None:
            first = back[first[0]][first[1]]
        p = first[1]
        (i0, j0), (i1, j1) = points[p], points[q]
        if q not in after_of:
            after_of[q] = _extend(item[i1 + 1 :], page[j1 + 1 : j1 + 1 + 2 * len(item)])
        if s == 1 and not after_of[q]:
            continue
        if p not in before_of:
            before_of[p] = _extend([w[::-1] for w in item[:i0][::-1]], [w[::-1] for w in page[max(0, j0 - 2 * len(item)) : j0][::-1]])
        top = max(top, length + after_of[q] + before_of[p])
        if top >= enough:
            break
    return top


def page_items(words: list[str], index: ItemIndex, rules: LeakRules) -> list[int]:
    """The ids of the items of which enough is printed on a page, in order."""
    if len(words) < 2 or not len(index.keys):
        return []
    at, term = index.hits(words)
    if not len(at):
        return []
    wanted: dict[int, list[int]] = {}
    starts = range(0, max(1, len(words) - rules.passage + rules.stride), rules.stride)
    from_, to = np.searchsorted(at, starts), np.searchsorted(at, [lo + rules.passage for lo in starts])
    slices = list(zip(from_.tolist(), to.tolist(), strict=True))
    for lo, (a, b), may in zip(starts, slices, index.bounded(term, slices), strict=True):
        if not may:
            continue
        entries = [index.entry(t) for t in set(term[a:b].tolist())]
        if sum(e[5] for e in entries) > 1.0:
            for n in wand(entries, 1.0, index.block):
                wanted.setdefault(n, []).append(lo)
    out: set[int] = set()
    for n, lows in wanted.items():
        if index.ids[n] in out:
            continue
        # verify around the passages that were retrieved; those that overlap are read as one
        reach = rules.max_insert + len(index.words[n])
        spans: list[list[int]] = []
        for lo in lows:
            if spans and lo - reach <= spans[-1][1]:
                spans[-1][1] = lo + rules.passage + reach
            else:
                spans.append([lo - reach, lo + rules.passage + reach])
        for lo, hi in spans:
            a, b = np.searchsorted(at, (lo, hi))
            points = []
            for j, t in zip(at[a:b].tolist(), term[a:b].tolist(), strict=True):
                for i, gap in index.places(t, n):
                    points += [(i, j), (i + gap, j + gap)]
            if longest_stretch(index.words[n], words, points, rules) >= rules.min_words:
                out.add(index.ids[n])
                break
    return sorted(out)


def _pages(b: pa.RecordBatch) -> Iterator[tuple[int, list[str]]]:
    """Each page's words, read column by column where the boxes fit its lines, else as scanned."""
    ids, texts, boxes = b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)
    lines = [plain(t or "").split("\n") for t in texts]
    count = np.array([len(x) for x in lines])
    offset = boxes.offsets.to_numpy()
    sizes = np.diff(offset)
    valid = np.ones(len(sizes), bool) if boxes.null_count == 0 else np.asarray(boxes.is_valid())
    flat = boxes.values
    fits = valid & (sizes == count)
    if fits.any():
        page = np.repeat(np.arange(len(sizes)), sizes)
        edges = [flat.field(k).slice(offset[0], offset[-1] - offset[0]) for k in ("x0", "y0", "x1")]
        for c in (flat.slice(offset[0], offset[-1] - offset[0]), *edges):
            if c.null_count:
                fits[page[np.asarray(c.is_null())]] = False
        x0, y0, x1 = (c.fill_null(0).to_numpy(zero_copy_only=False) for c in edges)
        order = reading_order(page, x0, y0, x1) - np.repeat(offset[:-1] - offset[0], sizes)
    for i, doc in enumerate(ids):
        if fits[i]:
            own = order[offset[i] - offset[0] : offset[i + 1] - offset[0]]
            yield doc, words_of([lines[i][k] for k in own])
        else:
            yield doc, words_of(lines[i])


_INDEX: tuple[int, ItemIndex] | None = None


def _search(block, rules: LeakRules):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        global _INDEX
        for big in batches:
            if _INDEX is None or _INDEX[0] != block._jid:  # one index per worker, however many tasks it runs
                texts, stats = block.value
                _INDEX = (block._jid, ItemIndex([(i, w.split(" ")) for i, w in texts], rules, stats))
            for lo in range(0, big.num_rows, 500):
                docs, found = [], []
                for doc, words in _pages(pa.RecordBatch.from_arrays([pa.concat_arrays([c]) for c in big.slice(lo, 500).columns], names=big.schema.names)):
                    for i in page_items(words, _INDEX[1], rules):
                        docs.append(doc)
                        found.append(i)
                yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(found, pa.int64())], names=["doc_id", "text_id"])

    return run


def _normal(rules: LeakRules):
    """Items as normalised words, with the number and length of their pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words = [words_of(plain(t).split("\n")) for t in b.column(1).to_pylist()]
            cut = [pieces(len(w), rules) for w in words]
            cols = [b.column(0), pa.array([" ".join(w) for w in words]), pa.array([len(c) for c in cut], pa.int64()), pa.array([sum(hi - lo for lo, hi in c) for c in cut], pa.int64())]
            yield pa.RecordBatch.from_arrays(cols, names=["item_id", "words", "n_pieces", "n_words"])

    return run


def _terms(rules: LeakRules):
    """The terms of every piece, each once per piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = [k for w in b.column(0).to_pylist() for k in piece_terms(w.split(" "), rules)]
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64))], names=["key"])

    return run


def leaked_items(documents: DataFrame, items: DataFrame, rules: LeakRules | None = None) -> DataFrame:
    """(doc_id, item_id): every page on which ``min_words`` consecutive words of an item stand.

    The items are a stated set of queries: their distinct texts are indexed in blocks of about
    ``max_words_per_index`` words, each block broadcast and held against all pages in one pass
    without a shuffle; items with the same words share one entry and get its pages by a join.
    Blocks don't change the result: document frequencies are counted over all items.

    Null, empty and too short texts and items give nothing; pages without fitting ``line_boxes``
    are read as scanned; repeated pages each get their rows, repeated rows of an item one (of
    several texts under one id the least counts). A character of a script without blanks is a
    word. Extra columns are ignored.
    """
    rules = rules or LeakRules()
    spark = documents.sparkSession
    if "line_boxes" in documents.columns:
        pages = documents.select("doc_id", "text", F.transform("line_boxes", lambda x: F.struct(x["x0"].alias("x0"), x["y0"].alias("y0"), x["x1"].alias("x1"))).alias("line_boxes"))
    else:
        pages = documents.select("doc_id", "text", F.expr("cast(array() as array<struct<x0: int, y0: int, x1: int>>)").alias("line_boxes"))
    wanted = items.where("item_id is not null and item_text is not null").groupBy("item_id").agg(F.min("item_text").alias("item_text"))
    wanted = wanted.select(F.col("item_id").cast("long").alias("item_id"), "item_text")
    normal = wanted.mapInArrow(_normal(rules), "item_id long, words string, n_pieces long, n_words long").where("n_pieces > 0")
    normal = materialize(normal, "items")
    texts = normal.groupBy("words").agg(F.min("item_id").alias("text_id"), F.min("n_pieces").alias("n_pieces"), F.min("n_words").alias("n_words"))
    n_texts, n_pieces, n_words = texts.agg(F.count(F.lit(1)), F.coalesce(F.sum("n_pieces"), F.lit(0)), F.coalesce(F.sum("n_words"), F.lit(0))).first()
    blocks = max(1, -(-n_words // rules.max_words_per_index))
    if blocks > 1:
        texts = materialize(texts, "texts")
    number = F.pmod(F.xxhash64("text_id"), F.lit(blocks))
    counts = materialize(texts.select("words").mapInArrow(_terms(rules), "key long").groupBy("key").count(), "terms") if blocks > 1 else None
    out = None
    for k in range(blocks):
        part = texts.where(number == k).select("text_id", "words")
        stats = _statistics(part, counts, rules, n_pieces, n_words) if blocks > 1 else None
        block = spark.sparkContext.broadcast(([tuple(r) for r in part.orderBy("text_id").collect()], stats))
        block._jid = block._jbroadcast.id()
        hit = pages.mapInArrow(_search(_Shared(block), rules), "doc_id long, text_id long")
        out = hit if out is None else out.unionByName(hit)
    if n_texts == normal.count():
        return out.withColumnRenamed("text_id", "item_id")
    members = normal.join(texts, "words").select("text_id", "item_id")
    return out.join(members, "text_id").select("doc_id", "item_id")


class _Shared:
    """A broadcast value and its number, which names the index that a worker keeps."""

    def __init__(self, block):
        self._block, self._jid = block, block._jid

    @property
    def value(self):
        return self._block.value


def _statistics(part: DataFrame, counts: DataFrame, rules: LeakRules, n_pieces: int, n_words: int) -> TermStatistics:
    """Statistics of all items for the terms of one block."""
    own = part.select("words").mapInArrow(_terms(rules), "key long").distinct()
    got = counts.join(own, "key", "left_semi").toArrow()
    key, n = got.column("key").to_numpy().view(np.uint64), got.column("count").to_numpy()
    order = np.argsort(key)
    return TermStatistics(n_pieces, n_words / max(1, n_pieces), key[order], n[order])
