"""Leaked items: retrieval against brute force, printed passages, and what is no case."""

from __future__ import annotations

import difflib
import random
import re
import unicodedata

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from wayledger.llm import leak

WORDS = "harbor captain lamp coffee market winter bridge doctor village letter music trade river school window garden silver mountain paper bread evening summer north cotton railway bishop".split()
MANY = [f"{a}{b}" for a in WORDS for b in ("", "en", "ia", "os", "ul", "er")]
PAGE = "line_boxes array<struct<x0: int, y0: int, x1: int, y1: int, conf: float>>"


def text(seed, n):
    rnd = random.Random(seed)
    return [rnd.choice(WORDS) for _ in range(n)]


ITEM = text(1, 40)


def found(spark, lines, item=None, boxes=None):
    docs = spark.createDataFrame([(7, "\n".join(lines) if lines is not None else None, boxes, "x")], f"doc_id long, text string, {PAGE}, item_id string")
    items = spark.createDataFrame([(i, " ".join(text(100 + i, 40))) for i in range(60)] + [(999, " ".join(item or ITEM))], "item_id long, item_text string")
    return [tuple(r) for r in leak.leaked_items(docs, items).collect()]


def lines_of(words, per=5):
    return [" ".join(words[i : i + per]) for i in range(0, len(words), per)]


def test_plain_broken_and_misread(spark):
    filler = text(50, 60)
    assert found(spark, lines_of(filler + ITEM[5:20] + filler)) == [(7, 999)]
    assert found(spark, lines_of(filler + ITEM[5:14] + filler)) == []
    shuffled = ITEM[:]
    random.Random(2).shuffle(shuffled)
    assert found(spark, lines_of(filler + shuffled)) == []
    misread = [w.replace("a", "á") if i % 3 else w.upper() for i, w in enumerate(ITEM[5:20])]
    misread[4] = misread[4][:-1] + "?"
    broken = ["... " + " ".join(misread[:7]) + " " + misread[7][:3] + "-", misread[7][3:] + ", " + " ".join(misread[8:])]
    assert found(spark, lines_of(filler) + broken) == [(7, 999)]
    advert = ["Buy SOAP today", "Telephone 12", "best in town"]
    assert found(spark, [" ".join(ITEM[3:11]), *advert, " ".join(ITEM[11:19])]) == [(7, 999)]


def test_columns(spark):
    left, right = lines_of(text(60, 10) + ITEM[:10]), lines_of(ITEM[10:20] + text(61, 10))
    mixed, boxes = [], []
    for k, (a, b) in enumerate(zip(left, right, strict=True)):
        mixed += [a, b]
        boxes += [(50 + k % 3, 100 + 40 * k, 400, 130 + 40 * k, None), (500 - k % 3, 101 + 40 * k, 900, 130 + 40 * k, 0.5)]
    assert found(spark, mixed, boxes=boxes) == [(7, 999)]
    assert found(spark, mixed, boxes=boxes[:-1]) == [] and found(spark, mixed) == []


def test_a_box_without_place_spoils_only_its_page(spark):
    left, right = lines_of(text(60, 10) + ITEM[:10]), lines_of(ITEM[10:20] + text(61, 10))
    mixed = [x for pair in zip(left, right, strict=True) for x in pair]
    box = [(50 + 450 * (k % 2), 100 + 40 * (k // 2), 400 + 450 * (k % 2), 0, None) for k in range(len(mixed))]
    broken = [(None, *box[0][1:]), *box[1:]]
    rows_in = [(1, "\n".join(mixed), box), (2, "\n".join(mixed), broken), (3, "\n".join(mixed), None), (4, "\n".join(mixed), [None, *box[1:]]), (5, "\n".join(mixed), box)]
    docs = spark.createDataFrame(rows_in, f"doc_id long, text string, {PAGE}").coalesce(1)
    items = spark.createDataFrame([(999, " ".join(ITEM))], "item_id long, item_text string")
    assert sorted(r.doc_id for r in leak.leaked_items(docs, items).collect()) == [1, 5]


def test_empty_cases(spark):
    assert found(spark, None) == [] and found(spark, [""]) == []
    docs = spark.createDataFrame([(1, " ".join(ITEM))], "doc_id long, text string")
    items = spark.createDataFrame([(5, " ".join(ITEM)), (5, " ".join(ITEM)), (6, None), (None, "x"), (8, "")], "item_id long, item_text string")
    assert [tuple(r) for r in leak.leaked_items(docs, items).collect()] == [(1, 5)]
    assert leak.leaked_items(docs, items.where("false")).count() == 0
    assert leak.leaked_items(docs.where("false"), items).count() == 0
    blocks = leak.LeakRules(max_words_per_index=10)
    assert [tuple(r) for r in leak.leaked_items(docs.unionByName(docs), items, blocks).collect()] == [(1, 5), (1, 5)]
    long = spark.createDataFrame([(1, " ".join(text(9, 60_000) + ITEM + text(10, 60_000)))], "doc_id long, text string")
    assert [tuple(r) for r in leak.leaked_items(long, items).collect()] == [(1, 5)]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.dictionaries(st.integers(0, 30), st.floats(0.1, 3), min_size=1), max_size=8), st.floats(0.5, 6), st.integers(1, 4))
def test_wand_equals_scoring_everything(lists, threshold, block):
    hits, total = [], {}
    for d in lists:
        docs = sorted(d)
        impact = [d[k] for k in docs]
        last = [docs[min(i + block, len(docs)) - 1] for i in range(0, len(docs), block)]
        best = [max(impact[i : i + block]) for i in range(0, len(docs), block)]
        hits.append((docs, impact, None, last, best, max(best)))
        for k, v in d.items():
            total[k] = total.get(k, 0.0) + v
    got = leak.wand(hits, threshold, block)
    near = {k for k, v in total.items() if abs(v - threshold) < 1e-9}
    assert set(got) - near == {k for k, v in total.items() if v > threshold} - near


@given(st.text(alphabet="abc", max_size=8), st.text(alphabet="abc", max_size=8))
def test_edit_distance(a, b):
    d = np.zeros((len(a) + 1, len(b) + 1), int)
    d[:, 0], d[0] = range(len(a) + 1), range(len(b) + 1)
    for i in range(len(a)):
        for j in range(len(b)):
            d[i + 1, j + 1] = min(d[i, j + 1] + 1, d[i + 1, j] + 1, d[i, j] + (a[i] != b[j]))
    assert leak.edit_distance(a, b, 3) == min(4, d[-1, -1]) or d[-1, -1] > 3 < leak.edit_distance(a, b, 3)


def flat(text):
    """Words without accents and case; shares nothing with the operator."""
    low = "".join(c for c in unicodedata.normalize("NFKD", re.sub(r"-\s*\n\s*", "", text).lower()) if not unicodedata.combining(c))
    return re.findall(r"[^\W_]+", low)


def columns(page_text, boxes):
    """Lines column by column: left edges that lie within 4 % of the page's width are one column."""
    lines = page_text.split("\n")
    if not boxes or len(boxes) != len(lines) or any(b is None or b.x0 is None for b in boxes):
        return page_text
    width = max(b.x1 for b in boxes) - min(b.x0 for b in boxes)
    lefts, col = sorted({b.x0 for b in boxes}), {}
    for k, x in enumerate(lefts):
        col[x] = col[lefts[k - 1]] + (x - lefts[k - 1] > 0.04 * width) if k else 0
    return "\n".join(lines[k] for k in sorted(range(len(lines)), key=lambda k: (col[boxes[k].x0], boxes[k].y0)))


def printed_pairs(docs, items):
    """Pairs where twelve words of an item and a stretch of the page have nearly the same letters.

    Plain comparison of letters by the standard library: no index, no score, no chains.
    """
    by_pair, words = {}, {}
    for r in items:
        words[r.item_id] = w = flat(r.item_text)
        for k in range(len(w) - 1):
            by_pair.setdefault((w[k], w[k + 1]), []).append((r.item_id, k))
    want = set()
    for d in docs:
        page = flat(columns(d.text or "", d.line_boxes))
        seeds = {}
        for j in range(len(page) - 1):
            for i, k in by_pair.get((page[j], page[j + 1]), ()):
                seeds.setdefault(i, []).append((k, j))
        for i, at in seeds.items():
            for k, j in at:
                if (d.doc_id, i) in want or sum(abs((a - k) - (b - j)) < 4 and abs(a - k) < 12 for a, b in at) < 3:
                    continue
                for s in range(max(0, k - 10), min(k, len(words[i]) - 12) + 1):
                    a, b = "".join(words[i][s : s + 12]), "".join(page[max(0, j - k + s) : j - k + s + 12])
                    if difflib.SequenceMatcher(None, a, b, False).ratio() >= 0.85:
                        want.add((d.doc_id, i))
                        break
    return want


def test_recall_against_plain_comparison(spark, data):
    """Every pair, misread ones too, that a matcher without the operator's code finds."""
    docs = spark.read.parquet(f"{data}/documents.parquet")
    items = spark.read.parquet(f"{data}/eval_items.parquet")
    got = {tuple(r) for r in leak.leaked_items(docs, items).collect()}
    want = printed_pairs(docs.select("doc_id", "text", "line_boxes").collect(), items.collect())
    assert want and want <= got


def misread(words, rnd, share):
    """One letter in some of the words replaced, some words split or run together."""
    out = []
    for w in words:
        if rnd.random() < share and len(w) > 3:
            k = rnd.randrange(len(w))
            w = w[:k] + rnd.choice("cexzq") + w[k + 1 :]
        if rnd.random() < share / 8 and len(w) > 4:
            out += [w[:2], w[2:]]
        elif out and rnd.random() < share / 8:
            out[-1] += w
        else:
            out.append(w)
    return out


def pages_and_items(spark, pages, items):
    docs = spark.createDataFrame(list(enumerate(pages)), "doc_id long, text string")
    return docs, spark.createDataFrame(items, "item_id long, item_text string")


def test_no_planted_stretch_is_lost(spark):
    """Long, repeated and nearly equal items, many scripts, misread, with one and more adverts."""
    rnd = random.Random(11)
    draw = lambda n: [rnd.choice(MANY) for _ in range(n)]
    items = {i: draw(30) for i in range(120)}
    items[500] = draw(1000)
    for i in range(600, 800):
        items[i] = items[600] if i > 600 else draw(40)  # one text under 200 ids
    base = draw(40)
    for i in range(900, 960):
        items[i] = base[:39] + [f"last{i}"]  # held by most, but for a word
    greek = lambda lo, n: ["".join(chr(lo + rnd.randrange(20)) for _ in range(rnd.randrange(3, 9))) for _ in range(n)]
    items[1000], items[1001], items[1002] = greek(0x430, 30), greek(0x3B1, 30), greek(0x5D0, 30)
    items[1003] = ["".join(chr(0x4E00 + rnd.randrange(3000)) for _ in range(40))]
    items[1004] = ["".join(chr(0xAC00 + rnd.randrange(3000)) for _ in range(3)) for _ in range(30)]
    rows_in = [(i, " ".join(w)) for i, w in items.items()]
    pages, truth = [], set()

    def plant(ids, words):
        at = rnd.randrange(150)
        page = draw(150)
        pages.append("\n".join(lines_of(page[:at] + words + page[at:], 7)))
        truth.update((len(pages) - 1, i) for i in ids)

    for _ in range(40):
        i = rnd.randrange(120)
        s = rnd.randrange(19)
        plant([i], items[i][s : s + 12])
        plant([i], misread(items[i][:24], rnd, 0.3))
        s = rnd.randrange(980)
        plant([500], items[500][s : s + 12])
        plant([500], misread(items[500][s : s + 20], rnd, 0.25))
    for s in (0, 13, 28):
        plant(range(600, 800), items[600][s : s + 12])
        plant(range(900, 960), base[min(s, 26) : min(s, 26) + 12])
    for i in (1000, 1001, 1002, 1004):
        plant([i], items[i][3:15])
        plant([i], [w.upper() for w in items[i][10:22]])
    plant([1003], [items[1003][0][5:17]])
    plant([1003], [items[1003][0][8:14] + "\n" + items[1003][0][14:20]])
    for i in range(20):
        w = items[i]
        plant([i], w[3:9] + draw(55) + w[9:15])
        plant([i], w[:5] + draw(20) + w[5:10] + draw(30) + w[10:15])
    docs, table = pages_and_items(spark, pages, rows_in)
    got = {tuple(r) for r in leak.leaked_items(docs, table).collect()}
    missed = truth - got
    assert len(missed) <= 0.01 * len(truth), missed
    assert not {(d, i) for d, i in missed if i >= 500}
    assert not {(d, i) for d, i in got - truth if i >= 1000 or i < 500}
    small = leak.LeakRules(max_words_per_index=3000)
    assert {tuple(r) for r in leak.leaked_items(docs, table, small).collect()} == got


def test_shared_words_or_another_order_are_no_case(spark):
    rnd = random.Random(5)
    draw = lambda n: [rnd.choice(MANY) for _ in range(n)]
    pages, items = [], [(i, " ".join(draw(50))) for i in range(40)]
    for _, t in items:
        w = t.split()
        pages.append(" ".join(draw(80) + w[20:27] + draw(80)))
        rnd.shuffle(w)
        pages.append(" ".join(w))
    docs, table = pages_and_items(spark, pages, items)
    assert leak.leaked_items(docs, table).count() == 0


def test_statistics_of_blocks_are_those_of_all():
    texts = [(i, text(i, 30)) for i in range(60)]
    r = leak.LeakRules()
    whole = leak.ItemIndex(texts, r)
    stats = leak.TermStatistics(60, 30.0, whole.keys, np.diff(whole.post_from))
    part = leak.ItemIndex(texts[:20], r, stats)
    for t, key in enumerate(part.keys):
        docs, impact, *_ = part.entry(t)
        all_docs, all_impact, *_ = whole.entry(int(np.searchsorted(whole.keys, key)))
        known = dict(zip(all_docs, all_impact, strict=True))
        assert np.allclose(impact, [known[d] for d in docs])


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.integers(12, 400))
def test_any_exact_stretch_passes_the_threshold(seed, n):
    rnd = random.Random(seed)
    rules = leak.LeakRules()
    items = [(i, [rnd.choice(WORDS[: rnd.choice([3, 8, 26])]) for _ in range(n if i == 0 else 30)]) for i in range(20)]
    index = leak.ItemIndex(items, rules)
    s = rnd.randrange(n - 11)
    assert 0 in leak.page_items(items[0][1][s : s + 12], index, rules)


def test_block_size_is_no_matter():
    items = [(i, text(i, 30)) for i in range(80)]
    page = text(3, 200) + text(5, 25)
    results = [leak.page_items(page, leak.ItemIndex(items, r), r) for r in (leak.LeakRules(block=b) for b in (1, 4, 64))]
    assert results[0] == results[1] == results[2] and 5 in results[0]
