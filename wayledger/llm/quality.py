"""Per-document text quality: statistics, and the share of prose, list, table and junk lines.

Method: a hidden Markov model over line statistics. Each non-blank line is described by a few
binned features (words, figures, symbols, known words, markers, wide gaps, width, repeated
letters); the states are prose, list, table and junk, and neighbouring lines tend to be of one
kind. The best state sequence of each document (Viterbi) labels its lines, and the shares of the
labels describe the document.

Emissions and transitions are fitted here on a bounded sample of documents (``sample_docs`` of at
most ``sample_chars`` characters, parameters; those with the least hashes of id and text): lines that plain rules can place are the labelled seed, and
documents whose seed lines agree are examples with all their lines, and a few rounds of
labelling the sample and counting again (Viterbi training) settle the rest. Which
words are known is counted over the whole corpus: those in at least ``common_share`` of its
documents.
"""

from __future__ import annotations

import math
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

STATES = ("prose", "list", "table", "junk")
#: The model tells marked lists from plain ones and symbol junk from letter junk.
PROSE, MARKED, PLAIN, TABLE, NOISE, SOUP = range(6)
LABEL_OF = np.array([0, 1, 1, 2, 3, 3])
#: Number of bins of each feature of a line.
BINS = {"words": 7, "figures": 4, "symbols": 4, "known": 5, "marker": 3, "gaps": 3, "width": 3, "repeats": 3, "end": 3, "form": 5, "leaders": 2, "capital": 2}


@dataclass(frozen=True)
class QualityRules:
    """Sample and rounds of the fit, and what makes a word common.

    A line of ``full_width`` characters is a full one, so that a run-on line doesn't make all
    others of its document look short.
    """

    sample_docs: int = 3000
    sample_chars: int = 20_000
    full_width: int = 200
    rounds: int = 3
    common_share: float = 0.004
    stay: float = 0.95
    pure: float = 0.7


_KIND: np.ndarray | None = None
_BLANK, _NL, _LETTER, _DIGIT, _POINT, _DASH, _BAR, _SYMBOL = range(8)


def _kinds() -> np.ndarray:
    """Kind of every code point."""
    global _KIND
    if _KIND is None:
        t = np.full(0x110000, _SYMBOL, np.uint8)
        for c in (*range(0x32400), *range(0xE0000, 0xE0200)):  # beyond them there are no letters or marks
            k = unicodedata.category(chr(c))
            if k[0] == "L" or k[0] == "M":
                t[c] = _LETTER
            elif k == "Nd":
                t[c] = _DIGIT
            elif chr(c).isspace():
                t[c] = _BLANK
        for ch in ".,;:!?'\"()“”«»’‘":
            t[ord(ch)] = _POINT
        for ch in "-–—=¬½":
            t[ord(ch)] = _DASH
        t[ord('|')] = _BAR
        t[10] = _NL
        _KIND = t
    return _KIND


@dataclass
class Lines:
    """Statistics of the non-blank lines of a batch of documents."""

    doc: np.ndarray  # document of each line
    cols: dict[str, np.ndarray]

    def __len__(self) -> int:
        return len(self.doc)


def line_statistics(texts: list[str], common: set[str]) -> Lines:
    """One row per non-blank line, documents and lines in order."""
    low = [t.lower() for t in texts]
    joined = "\n".join(low) + "\n"
    code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    # the same text in its own case, where lower-casing kept every length
    original = "\n".join(texts) + "\n"
    raw = np.frombuffer(original.encode("utf-32-le", "surrogatepass"), np.uint32) if len(original) == len(joined) else code
    kind = _kinds()[code]
    ends = np.flatnonzero(kind == _NL)
    starts = np.append(0, ends[:-1] + 1)
    n = len(starts)
    doc_end = np.cumsum([len(t) + 1 for t in low])
    doc = np.searchsorted(doc_end, starts, "right")

    def total(mask: np.ndarray) -> np.ndarray:
        c = np.zeros(len(mask) + 1, np.int64)
        np.cumsum(mask, out=c[1:])
        return c[ends] - c[starts]

    letter = kind == _LETTER
    solid = kind > _NL
    before = np.append(_NL, kind[:-1])
    letters, digits, symbols, dashes = total(letter), total(kind == _DIGIT), total(kind == _SYMBOL), total(kind == _DASH)
    chars = total(solid)
    # words: runs of letters
    ws = np.flatnonzero(letter & (before != _LETTER))
    after = np.append(kind[1:], _NL)
    we = np.flatnonzero(letter & (after != _LETTER)) + 1
    wline = np.searchsorted(ends, ws)
    known = np.fromiter((joined[a:b] in common for a, b in zip(ws.tolist(), we.tolist(), strict=True)), bool, len(ws))
    long = (we - ws) > 1
    count = lambda line, m=None: np.bincount(line if m is None else line[m], minlength=n)
    words = count(wline)
    # tokens between blanks; those with a digit, dash or lone point are figures
    solid_start = np.flatnonzero(solid & (before <= _NL))
    solid_end = np.flatnonzero(solid & (after <= _NL)) + 1
    tline = np.searchsorted(ends, solid_start)
    lc = np.append(0, np.cumsum(letter))
    dc = np.append(0, np.cumsum(kind == _DIGIT))
    t_letters, t_digits = lc[solid_end] - lc[solid_start], dc[solid_end] - dc[solid_start]
    yc = np.append(0, np.cumsum(kind == _SYMBOL))
    figure = (t_letters <= t_digits) & (yc[solid_end] == yc[solid_start])
    tokens, figures = count(tline), count(tline, figure)
    # wide gaps inside a line
    blank = kind == _BLANK
    gap_start = np.flatnonzero(blank & (before > _NL))
    gap_end = solid_start[np.searchsorted(solid_start, gap_start)] if len(solid_start) and len(gap_start) else np.zeros(0, np.int64)
    ok = np.searchsorted(solid_start, gap_start) < len(solid_start) if len(gap_start) else np.zeros(0, bool)
    gap_start, gap_end = gap_start[ok] if len(gap_start) else gap_start, gap_end[: len(gap_start)][ok] if len(gap_start) else gap_end
    gline = np.searchsorted(ends, gap_start)
    wide = (gap_end - gap_start >= 2) & (gline == np.searchsorted(ends, gap_end))
    gaps = count(gline, wide)
    bars = total((kind == _BAR) | (code == 9))
    # letters that come again at once or in twos (lIlIlI)
    repeats = np.maximum(total(np.append(False, code[1:] == code[:-1]) & solid), total(np.concatenate([[False, False], code[2:] == code[:-2]])[: len(code)] & solid))
    # first and last solid character of each line
    first_tok = np.searchsorted(solid_start, starts)
    first = np.full(n, -1)
    has = tokens > 0
    first[has] = solid_start[first_tok[has]]
    last = np.full(n, -1)
    last[has] = solid_end[np.searchsorted(solid_start, ends[has]) - 1] - 1
    first_kind, last_kind = np.full(n, _BLANK), np.full(n, _BLANK)
    first_kind[has], last_kind[has] = kind[first[has]], kind[last[has]]
    # form: ends in a figure, ends in an initial, a bracket near the start, a colon near the start
    last_tok = np.searchsorted(solid_start, ends) - 1
    tail = np.where(has, last_tok, 0)
    form = np.zeros(n, np.int64)
    if len(solid_start):
        form[has & (t_digits[tail] > 0) & (t_letters[tail] == 0)] = 1
        form[has & (t_digits[tail] == 0) & (t_letters[tail] == 1) & (tokens > 1)] = 2
        head = np.where(has, first_tok, 0)
        head = np.minimum(head, len(solid_start) - 1)
        for k in range(3):
            tok = np.minimum(head + k, len(solid_start) - 1)
            within = has & (k < tokens)
            form[within & (code[solid_start[tok]] == 40)] = 3
            form[within & (code[solid_end[tok] - 1] == 58) & (k < tokens - 1)] = 4
    dot = (code == 46) | (code == 0xB7)
    leaders = total(dot & np.append(False, dot[:-1])) >= 2
    capital = np.zeros(n, bool)
    capital[has] = raw[first[has]] != code[first[has]]
    end_mark = np.zeros(n, np.int64)
    end_mark[has & np.isin(last_kind, [_POINT])] = 1
    end_mark[has & (last_kind == _DASH)] = 2
    width = ends - starts
    keep = has
    cols = {
        "letters": letters, "digits": digits, "symbols": symbols, "dashes": dashes, "chars": chars, "words": words, "long_words": count(wline, long), "known": count(wline, known & long), "known_all": count(wline, known),
        "tokens": tokens, "figures": figures, "gaps": gaps + bars, "repeats": repeats, "first_kind": first_kind, "end_mark": end_mark, "width": width, "form": form, "leaders": leaders.astype(np.int64), "capital": capital.astype(np.int64),
    }
    return Lines(doc[keep], {k: v[keep] for k, v in cols.items()})


def _bin(x: np.ndarray, *edges: float) -> np.ndarray:
    return np.searchsorted(np.array(edges), x, "right")


def line_features(s: Lines, n_docs: int, rules: QualityRules) -> np.ndarray:
    """Bins of each line's features, columns as in ``BINS``."""
    c = s.cols
    tokens, chars = np.maximum(1, c["tokens"]), np.maximum(1, c["chars"])
    widest = np.zeros(n_docs, np.int64)
    np.maximum.at(widest, s.doc, np.minimum(c["width"], rules.full_width))
    known = np.where(c["long_words"] == 0, 0, 1 + _bin(c["known"] / np.maximum(1, c["long_words"]), 0.15, 0.4, 0.7))
    marker = np.where(c["first_kind"] == _DIGIT, 1, np.where(np.isin(c["first_kind"], [_DASH, _SYMBOL]), 2, 0))
    return np.stack(
        [
            np.minimum(c["words"], 6),
            _bin(c["figures"] / tokens, 0.01, 0.3, 0.6),
            _bin(c["symbols"] / chars, 0.001, 0.06, 0.25),
            known,
            marker,
            np.minimum(c["gaps"], 2),
            _bin(c["width"] / np.maximum(1, widest[s.doc]), 0.5, 0.75),
            _bin(c["repeats"] / chars, 0.15, 0.35),
            c["end_mark"],
            c["form"],
            c["leaders"],
            c["capital"],
        ],
        axis=1,
    ).astype(np.int64)


def seed_labels(f: np.ndarray, s: Lines) -> np.ndarray:
    """Labels of the lines that plain rules can place, -1 for the others."""
    words, figures, symbols, known, marker, gaps, _, repeats, _, form, leaders, _ = f.T
    c = s.cols
    out = np.full(len(f), -1)
    out[(words >= 4) & (known >= 3) & (marker == 0) & (figures <= 1) & (gaps <= 1) & (form == 0)] = PROSE
    short = (words <= 5) & (figures <= 2) & (gaps <= 1) & (c["digits"] < c["letters"])
    out[(words <= 2) & (known >= 2) & (marker == 0) & (figures == 0) & (c["end_mark"] == 0)] = PLAIN
    out[short & (form > 0) & (marker == 0)] = PLAIN
    out[short & (marker > 0) & ((known >= 2) | (form > 0))] = MARKED
    out[(figures >= 2) & (c["tokens"] >= 3) & ((gaps >= 2) | (leaders > 0))] = TABLE
    out[(symbols == 3) | (repeats == 2) & (c["chars"] >= 8)] = NOISE
    out[(c["long_words"] >= 3) & (known <= 1) & (figures <= 1) & (form == 0)] = SOUP
    return out


@dataclass(frozen=True)
class LineModel:
    """Log probabilities: start and moves between states, and bins of each feature by state."""

    start: np.ndarray
    move: np.ndarray
    emit: tuple[np.ndarray, ...]

    def scores(self, f: np.ndarray) -> np.ndarray:
        return sum(e[:, f[:, k]].T for k, e in enumerate(self.emit))

    def label(self, f: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """Best state of every line, by Viterbi over documents of like length side by side."""
        out = np.zeros(len(f), np.int64)
        if not len(f):
            return out
        score = self.scores(f)
        starts = np.flatnonzero(np.append(True, doc[1:] != doc[:-1]))
        size = np.diff(np.append(starts, len(doc)))
        order = np.argsort(size, kind="stable")
        at = 0
        while at < len(order):
            most = int(min(size[order[at]] * 1.5 + 8, 1 << 60))
            upto = at + np.searchsorted(size[order[at:]], most, "right")
            upto = min(upto, at + max(1, 2_000_000 // most))
            part = order[at:upto]
            at = upto
            length = size[part]
            T = int(length.max())
            best = self.start + score[starts[part]]
            back = np.zeros((T, len(part), len(self.start)), np.int8)
            live = np.arange(len(part))
            for t in range(1, T):
                live = live[length[live] > t]
                step = best[live][:, :, None] + self.move
                back[t, live] = step.argmax(1)
                best[live] = step.max(1) + score[starts[part[live]] + t]
            state = best.argmax(1)
            rows = np.arange(len(part))
            for t in range(T - 1, -1, -1):
                on = length > t
                out[starts[part[on]] + t] = state[on]
                if t:
                    state = np.where(on, back[t, rows, state], state)
        return out


def fit_model(texts: list[str], common: set[str], rules: QualityRules) -> LineModel:
    """Fit on the sample: seed lines make whole documents examples, then documents are relabelled.

    A document most of whose seed lines (``rules.pure``) agree is an example of that kind with all
    its lines, headings and short lines included; in others only the seed lines count. After
    each round the model's own labels of the documents take the place of the seed's.
    """
    s = line_statistics(texts, common)
    f = line_features(s, len(texts), rules)
    k, n = len(LABEL_OF), len(texts)
    label = seed = seed_labels(f, s)
    lines = np.bincount(s.doc, minlength=n)
    start = np.full(k, 1 / k)
    inside = np.append(False, s.doc[1:] == s.doc[:-1]) if len(s) else np.zeros(0, bool)
    model = None
    for _ in range(rules.rounds):
        votes = np.stack([np.bincount(s.doc, label == q, minlength=n) for q in range(k)], 1)
        told = votes.sum(1)
        pure = (votes.max(1) >= rules.pure * np.maximum(1, told)) & (told >= 0.3 * lines) & (told > 0)
        kind = np.where(pure, votes.argmax(1), -1)
        example = np.where(kind[s.doc] >= 0, kind[s.doc], seed)
        emit = []
        for j, bins in enumerate(BINS.values()):
            counts = np.full((k, bins), 0.5)
            for q in range(k):
                counts[q] += np.bincount(f[example == q, j], minlength=bins)
            # every kind of line may show any bin: a floor keeps one odd feature from deciding
            emit.append(np.log(0.98 * counts / counts.sum(1, keepdims=True) + 0.02 / bins))
        moves = np.full((k, k), (1 - rules.stay) / (k - 1))
        np.fill_diagonal(moves, rules.stay)
        if model is not None:
            seen = np.full((k, k), 1.0)
            np.add.at(seen, (label[:-1][inside[1:]], label[1:][inside[1:]]), 1)
            moves = 0.5 * moves + 0.5 * seen / seen.sum(1, keepdims=True)
        model = LineModel(np.log(start), np.log(moves), tuple(emit))
        label = model.label(f, s.doc)
    return model


def common_words(documents: DataFrame, share: float, n: int) -> DataFrame:
    """(word): those in at least ``share`` of the n documents with text, counted over all of them.

    Distinct words of a document are counted once, pre-aggregated before the shuffle. There are
    at most (mean distinct words of a document) / share of them.
    """
    texts = documents.where(F.trim("text") != "").select(F.lower("text").alias("t"))
    words = texts.select(F.explode(F.array_distinct(F.split("t", r"[^\p{L}\p{M}]+"))).alias("word")).where(F.length("word") > 1)
    return words.groupBy("word").count().where(F.col("count") >= max(2, math.ceil(share * n))).select("word")


def sample_texts(documents: DataFrame, rules: QualityRules) -> tuple[list[str], int]:
    """The sample and the number of documents with text.

    The sample is the ``sample_docs`` distinct documents of least hash among those of at most
    ``sample_chars`` characters: the same whatever the partitions. Only documents whose hash is below
    a bound leave their task, about half as many again as are wanted, so that what travels doesn't
    grow with the corpus; where many are blank or long the bound is raised.
    """
    bits = 1 << 30
    share = min(1.0, 1.5 * rules.sample_docs / max(1, documents.count()))
    while True:
        seen = Observation()
        texts = documents.where(F.trim("text") != "").observe(seen, F.count(F.lit(1)).alias("n"))
        near = texts.select(F.pmod(F.xxhash64("doc_id", "text"), F.lit(bits)).alias("h"), "text").where((F.col("h") < math.ceil(share * bits)) & (F.length("text") <= rules.sample_chars))
        chosen = near.distinct().orderBy("h", "text").limit(rules.sample_docs).collect()
        if len(chosen) == rules.sample_docs or share == 1.0:
            return sorted(r.text for r in chosen), _observed(seen, texts)
        share = min(1.0, 4 * share)


def _observed(seen: Observation, texts: DataFrame) -> int:
    """The number seen; where the plan was known to be empty before it ran, nothing was observed."""
    try:
        return seen.get["n"]
    except Py4JJavaError:
        return texts.count()


_OUT = "doc_id long, n_lines long, n_words long, mean_word_length double, symbol_ratio double, end_punctuation_share double, common_word_share double, prose_share double, list_share double, table_share double, junk_share double"


def _document_rows(ids: list, texts: list[str], model: LineModel, common: set[str], rules: QualityRules) -> pa.RecordBatch:
    s = line_statistics(texts, common)
    n = len(texts)
    label = LABEL_OF[model.label(line_features(s, n, rules), s.doc)]
    per = lambda x: np.bincount(s.doc, x, minlength=n)
    c = s.cols
    lines, words, letters, chars = np.bincount(s.doc, minlength=n), per(c["words"]), per(c["letters"]), per(c["chars"])
    with np.errstate(invalid="ignore", divide="ignore"):
        cols = [lines, words.astype(np.int64), letters / words, per(c["symbols"] + c["dashes"]) / chars, per(c["end_mark"] == 1) / lines, per(c["known_all"]) / words, *(per(label == q) / lines for q in range(4))]
    arrays = [pa.array(ids, pa.int64()), *(pa.array(x, pa.int64()) for x in cols[:2]), *(pa.array(x, pa.float64(), from_pandas=True) for x in cols[2:])]
    names = [w.strip().split(" ")[0] for w in _OUT.split(",")]
    return pa.RecordBatch.from_arrays(arrays, names=names)


def _measure(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, common, rules = shared.value
        for b in batches:
            lo = 0
            texts = [t or "" for t in b.column(1).to_pylist()]
            ids = b.column(0).to_pylist()
            while lo < len(texts):
                hi, size = lo, 0
                while hi < len(texts) and (hi == lo or size + len(texts[hi]) < 1_000_000):
                    size += len(texts[hi])
                    hi += 1
                yield _document_rows(ids[lo:hi], texts[lo:hi], model, common, rules)
                lo = hi

    return run


def document_quality(documents: DataFrame, rules: QualityRules | None = None) -> DataFrame:
    """One row per document: statistics and the shares of its lines by label.

    Columns: doc_id, n_lines (non-blank), n_words (runs of letters), mean_word_length,
    symbol_ratio (of non-blank characters), end_punctuation_share (of lines), common_word_share,
    prose_, list_, table_ and junk_share. Null, empty and blank texts have zero lines and words
    and null ratios. Repeated rows each get a row; extra columns are ignored.
    """
    rules = rules or QualityRules()
    spark = documents.sparkSession
    sample, n = sample_texts(documents, rules)
    common = {r.word for r in common_words(documents, rules.common_share, n).toLocalIterator()}
    model = fit_model(sample, common, rules)
    shared = spark.sparkContext.broadcast((model, common, rules))
    return documents.select("doc_id", "text").mapInArrow(_measure(shared), _OUT)


def not_prose(quality: DataFrame) -> DataFrame:
    """(doc_id, doc_class): documents most of whose lines aren't prose, by their commonest label."""
    c = {s: F.col(f"{s}_share") for s in STATES[1:]}
    top = F.greatest(*c.values())
    kind = F.when(c["table"] == top, "table").when(c["list"] == top, "list").otherwise("junk")
    return quality.where((F.col("n_lines") > 0) & (F.col("prose_share") < 0.5)).select("doc_id", kind.alias("doc_class"))


