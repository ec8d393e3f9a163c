"""Text quality statistics and the prose classifier (problem 9).

Method: gradient-boosted trees over document statistics. They are fitted on a
bounded sample (``TRAIN_DOCS`` documents chosen by a hash of their id, texts of
up to ``TRAIN_CHARS`` characters) with weak labels: prose by its share of common
words, structural junk by the lack of them; shuffled prose and a
fragment said over and over are junk too, and documents put together from both teach the share at which prose ends.
Probabilities are calibrated on the hand-checked texts of ``holdout``. Where a table
is so small that its sample lacks prose or junk, those texts join the sample, so
there is no table that the trees do not judge.

Beside the plain statistics there are those of word order: how often neighbouring
words stand next to each other in weakly labelled prose rather than in junk
(log odds in a table of at most ``VOCABULARY`` squared entries), once for frequent
words of the sample and once for the common words alone. The second holds for
texts on other subjects, too; to teach that, a part of the examples is shown with
most other words forgotten.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from annoweave.llm.boosting import Averaged
from annoweave.llm.holdout import CALIBRATION
from annoweave.llm.portions import portions, sampled
from annoweave.llm.winnowing import CHARS, words

TRAIN_DOCS, TRAIN_CHARS, VOCABULARY, LEAST_DF = 4000, 20_000, 1500, 6
#: Models and boosted trees of each; the share of the examples that they see again with words forgotten,
#: and the shares of the words, common ones apart, that are.
BAGS, TREES, AGAIN, FORGOTTEN = 3, 80, 0.3, (1.0,)
#: Most rows of the table of common words; a larger one is refused, never cut.
MOST_WORDS = 1_000_000
#: Words to either side that decide whether a word stands in prose, and the
#: levels of mean log odds (in sixteenths) from which they do.
REACH, LEVELS = 6, (4, 10, 16)
STATS = [
    "word_count",
    "mean_word_length",
    "symbol_ratio",
    "digit_ratio",
    "upper_ratio",
    "space_ratio",
    "line_count",
    "words_per_line",
    "punctuated_lines",
    "bulleted_lines",
    "common_share",
    "number_share",
    "mixed_share",
    "distinct_share",
    "other_letters",
    "bracket_ratio",
    "word_variety",
]
_ENDS = tuple(".!?…。\"'”»")
_BULLET = re.compile(r"\s*(?:[-*•·+>|#]|\(?\d{1,3}[.)]\s|\(?[a-z][.)]\s|\[\d)")
#: Byte classes: 0 letter, 1 upper, 2 digit, 3 space, 4 symbol, 5 part of a non-ASCII character, 6 bracket or equals sign.
def _byte_class(i: int) -> int:
    c = chr(i)
    if c in "()[]{}=":
        return 6
    if c.isspace():
        return 3
    if c.isdigit():
        return 2
    return 1 if 65 <= i <= 90 else 0 if 97 <= i <= 122 else 5 if i > 127 else 4


_CLASS = np.array([_byte_class(i) for i in range(256)], dtype=np.uint8)


class Common:
    """Function words of each language, accents removed."""

    def __init__(self, rows: list[tuple[str, str]]):
        langs = sorted({lang for lang, _ in rows if lang})
        self.mask: dict[str, int] = {}
        for lang, word in rows:
            if lang and word:
                for w in words(word):
                    self.mask[w] = self.mask.get(w, 0) | 1 << langs.index(lang)
        self.langs = max(1, len(langs))


def _per_text(values: np.ndarray, starts: np.ndarray, count: np.ndarray) -> np.ndarray:
    total = np.append(0, np.cumsum(values, dtype=np.float64))
    return total[starts + count] - total[starts]


def _window_mean(values: np.ndarray, starts: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Mean over REACH words to either side, within the text."""
    own = np.repeat(np.arange(len(count)), count)
    at = np.arange(len(values))
    lo, hi = np.maximum(at - REACH, starts[own]), np.minimum(at + REACH + 1, (starts + count)[own])
    total = np.append(0, np.cumsum(values, dtype=np.float64))
    return (total[hi] - total[lo]) / (hi - lo)


class Words:
    """The words of many texts in one row, with what is known of each."""

    def __init__(self, texts: list[str], common: Common):
        split = [words(t) for t in texts]
        self.count = np.array([len(w) for w in split], dtype=np.int64)
        self.starts = np.cumsum(self.count) - self.count
        self.flat = [w for ws in split for w in ws]
        n = len(self.flat)
        self.length = np.fromiter(map(len, self.flat), np.int32, n)
        self.number = np.fromiter((w.isdigit() for w in self.flat), bool, n)
        self.alpha = np.fromiter((w.isalpha() for w in self.flat), bool, n)
        get = common.mask.get
        masks = np.fromiter((get(w, 0) for w in self.flat), np.int64, n)
        per = np.stack([_per_text(masks >> i & 1, self.starts, self.count) for i in range(common.langs)], 1)
        language = per.argmax(1) if len(per) else np.empty(0, np.int64)
        self.common = (masks >> np.repeat(language, self.count) & 1).astype(bool)

    def ids(self, vocabulary: dict[str, int]) -> np.ndarray:
        """Vocabulary number; 0 unknown, 1 number, 2 letters with digits."""
        get = vocabulary.get
        known = np.fromiter((get(w, 0) for w in self.flat), np.int32, len(self.flat))
        return np.where(known > 0, known, np.where(self.number, 1, np.where(self.alpha, 0, 2)))


def statistics(texts: list[str], w: Words) -> np.ndarray:
    """The STATS of every text. A text without words or characters has zeros for shares."""
    raw = [t.encode("utf-8", "replace") for t in texts]
    size = np.array([len(r) for r in raw], dtype=np.int64)
    kind = _CLASS[np.frombuffer(b"".join(raw), dtype=np.uint8)]
    start = np.cumsum(size) - size
    chars = np.maximum(size, 1)
    share = [_per_text(kind == k, start, size) / chars for k in range(7)]
    lines = [[x for x in t.splitlines() if x.strip()] for t in texts]
    many = np.array([len(x) for x in lines])
    ends = np.array([sum(x.rstrip().endswith(_ENDS) for x in ls) for ls in lines]) / np.maximum(many, 1)
    bullets = np.array([sum(_BULLET.match(x) is not None for x in ls) for ls in lines]) / np.maximum(many, 1)
    n = np.maximum(w.count, 1)
    alpha = np.maximum(_per_text(w.alpha, w.starts, w.count), 1)
    distinct = np.array([len(set(w.flat[s : s + c])) for s, c in zip(w.starts, w.count)])
    return np.stack(
        [
            w.count,
            _per_text(w.length, w.starts, w.count) / n,
            share[4] + share[6],
            share[2],
            share[1],
            share[3],
            many,
            w.count / np.maximum(many, 1),
            ends,
            bullets,
            _per_text(w.common, w.starts, w.count) / alpha,
            _per_text(w.number, w.starts, w.count) / n,
            _per_text(~w.number & ~w.alpha, w.starts, w.count) / n,
            distinct / n,
            share[5],
            share[6],
            np.where(w.count > 1, np.log(np.maximum(distinct, 1)) / np.log(np.maximum(w.count, 2)), 1.0),
        ],
        1,
    ).astype(np.float64)


class OrderTable:
    """Log odds, in sixteenths, of neighbouring words in ``good`` rather than ``bad`` texts."""

    def __init__(self, vocabulary: list[str], good: list[list[str]], bad: list[list[str]]):
        self.number = {x: i + 3 for i, x in enumerate(vocabulary)}
        v, odds = len(vocabulary) + 3, []
        for side in (good, bad):
            counts = np.full(v * v, 0.5)
            for ws in side:
                i = np.array([self.number.get(x, 1 if x.isdigit() else 0 if x.isalpha() else 2) for x in ws], dtype=np.int64)
                np.add.at(counts, i[:-1] * v + i[1:], 1)
            odds.append(np.log(counts / counts.sum()))
        self.odds = np.clip(np.round((odds[0] - odds[1]).reshape(v, v) * 16), -64, 64).astype(np.int8)

    def features(self, w: Words, forgotten: np.ndarray | None = None) -> list[np.ndarray]:
        """Share of unknown words, mean of the odds, share of words with clear odds, and shares of words in surroundings of each level."""
        ids = w.ids(self.number)
        if forgotten is not None:
            ids = np.where(forgotten & (ids > 2), 0, ids)
        order = np.zeros(len(ids))
        if len(ids) > 1:
            pair = self.odds[ids[:-1], ids[1:]].astype(float)
            own = np.repeat(np.arange(len(w.count)), w.count)
            pair[own[1:] != own[:-1]] = 0
            order[1:] += pair / 2
            order[:-1] += pair / 2
        near = _window_mean(order, w.starts, w.count)
        mean = lambda v: _per_text(v, w.starts, w.count) / np.maximum(w.count, 1)
        return [mean(ids == 0), mean(order), mean(order > 8), *[mean(near >= level) for level in LEVELS]]


class Prose:
    """The fitted model: vocabulary, word-order table and trees."""

    def __init__(self, common: Common, texts: list[str], seed: int = 11):
        self.common = common
        rng = np.random.default_rng(seed)
        w, n, prose, junk = self._weak(texts)
        if min(len(prose), len(junk)) < 5:
            own = len(texts)
            texts = [*texts, *(t for t, _ in CALIBRATION)]
            w, n, prose, junk = self._weak(texts)
            known = np.array([p for _, p in CALIBRATION])
            prose = np.append(prose[prose < own], own + np.flatnonzero(known))
            junk = np.append(junk[junk < own], own + np.flatnonzero(~known))
        split = lambda rows: [w.flat[w.starts[i] : w.starts[i] + w.count[i]] for i in rows]
        good, bad = split(prose), split(junk)
        # the half that teaches word order does not teach the trees
        half_g, half_b = len(good) // 2, len(bad) // 2
        self._learn_order(good[:half_g], bad[:half_b], rng)
        # what the common words call prose but is in no order (shuffled text) leaves the prose; then once more
        order = self.features([texts[i] for i in prose])[:, len(STATS) + 1]
        kept = np.flatnonzero((order >= 0.5 * np.median(order)) | (n[prose] < 20))
        half_g = int((kept < half_g).sum())
        prose, good = prose[kept], [good[i] for i in kept]
        self._learn_order(good[:half_g], bad[:half_b], rng)
        # several models on examples of their own, whose margins are averaged, err less than one
        self.trees = Averaged(BAGS, TREES)
        for model in self.trees.models:
            made, label = self._examples([texts[i] for i in prose[half_g:]], [texts[i] for i in junk[half_b:]], good[half_g:], rng)
            x, y = [self.features(made)], [label]
            for share in FORGOTTEN:
                some = np.flatnonzero(rng.random(len(made)) < AGAIN)
                x.append(self.features([made[i] for i in some], forget=share, rng=rng))
                y.append(label[some])
            model.fit(np.concatenate(x), np.concatenate(y))
        self.trees.calibrate(self.features([t for t, _ in CALIBRATION]), np.array([p for _, p in CALIBRATION], dtype=float))

    def _weak(self, texts: list[str]) -> tuple[Words, np.ndarray, np.ndarray, np.ndarray]:
        """The words of texts, their number, and which texts are labelled prose and junk."""
        w = Words(texts, self.common)
        stats = statistics(texts, w) if texts else np.zeros((0, len(STATS)))
        names = ("common_share", "punctuated_lines", "number_share", "bracket_ratio", "word_count", "word_variety")
        share, ends, number, bracket, n, variety = (stats[:, STATS.index(c)] for c in names)
        code = (bracket > 0.02) & (ends < 0.05)
        repeated = (n >= 30) & (variety < 0.8)
        prose = np.flatnonzero((share >= 0.24) & (n >= 8) & (number < 0.3) & ~code & ~repeated)
        return w, n, prose, np.flatnonzero((n > 0) & ((share < 0.07) | (number > 0.6) | code | repeated))

    def _learn_order(self, good: list[list[str]], bad: list[list[str]], rng: np.random.Generator) -> None:
        df = Counter(x for ws in (*good, *bad) for x in set(ws) if x.isalpha())
        least = min(LEAST_DF, max(2, len(good) // 20))
        kept = [x for x, c in sorted(df.items(), key=lambda p: (-p[1], p[0])) if c >= least][: VOCABULARY - 3]
        listed = sorted(self.common.mask, key=lambda x: (-df[x], x))[: VOCABULARY - 3]
        shuffled = [list(rng.permutation(np.array(ws, dtype=object))) for ws in good]
        self.tables = [OrderTable(words_, good, [*bad, *shuffled]) for words_ in (kept, listed)]

    def _examples(self, good: list[str], bad: list[str], good_words: list[list[str]], rng: np.random.Generator) -> tuple[list[str], np.ndarray]:
        made, label = [*good, *bad], [1.0] * len(good) + [0.0] * len(bad)
        for ws in good_words[: 2 * len(good_words) // 5]:
            made.append(" ".join(rng.permutation(np.array(ws, dtype=object))))
            label.append(0.0)
        for ws in good_words[: len(good_words) // 8]:
            at, n = int(rng.integers(len(ws))), int(rng.integers(2, 7))
            made.append(str(rng.choice(["  ", "\n", " "])).join([" ".join(ws[at : at + n])] * int(rng.integers(15, 70))))
            label.append(0.0)
        size = lambda t: max(1, len(words(t)))
        for _ in range(min(1500, 2 * len(good))):
            a, b = good[rng.integers(len(good))], bad[rng.integers(len(bad))]
            # cut either part to a random share of itself, at line or word ends
            a, b = (" ".join(re.split(r"( )", t)[: 1 + 2 * int(rng.integers(1, 1 + t.count(" ") + 1))]) if rng.random() < 0.7 else t for t in (a, b))
            na, nb = size(a), size(b)
            share = na / (na + nb)
            if abs(share - 0.5) < 0.06:
                continue
            made.append("\n\n".join((a, b) if rng.random() < 0.7 else (b, a)))
            label.append(float(share >= 0.5))
        return made, np.array(label)

    def features(self, texts: list[str], w: Words | None = None, stats: np.ndarray | None = None, forget: float = 0.0, rng: np.random.Generator | None = None) -> np.ndarray:
        """STATS, order of frequent and of common words, and the share of words among common ones.

        ``forget`` is the share of the words, common ones apart, that are taken as unknown.
        """
        w = w or Words(texts, self.common)
        stats = statistics(texts, w) if stats is None else stats
        forgotten = None
        if forget and rng is not None:
            lost = {x for x in self.tables[0].number if x not in self.common.mask and rng.random() < forget}
            forgotten = np.fromiter((x in lost for x in w.flat), bool, len(w.flat))
        alpha = _window_mean(w.alpha, w.starts, w.count)
        common = _window_mean(w.common, w.starts, w.count) / np.maximum(alpha, 1e-9)
        zone = _per_text((common >= 0.2) & (alpha >= 0.4), w.starts, w.count) / np.maximum(w.count, 1)
        return np.column_stack([stats, *self.tables[0].features(w, forgotten), *self.tables[1].features(w), zone])

    def probability(self, x: np.ndarray) -> np.ndarray:
        """Probability that half of the words or more stand in prose; 0 without words."""
        return np.where(x[:, 0] > 0, self.trees.probability(x), 0.0)


def fit(docs: DataFrame, doc_id: str, text: str, common_words: DataFrame) -> Prose:
    """The model of a table; at most about TRAIN_DOCS documents reach the driver."""
    listed = common_words.select("lang", "word").distinct().limit(MOST_WORDS + 1).collect()
    if len(listed) > MOST_WORDS:
        raise ValueError(f"more than {MOST_WORDS} common words: they must fit the driver and every task")
    common = Common(sorted(((r["lang"], r["word"]) for r in listed), key=lambda x: (x[0] or "", x[1] or "")))
    share = min(1.0, TRAIN_DOCS / max(docs.count(), 1))
    chosen = docs.where(sampled(F.lit(share), 3, doc_id) & F.col(text).isNotNull() & (F.length(text) <= TRAIN_CHARS))
    sample = chosen.select(F.col(doc_id).alias("d"), F.col(text).alias("t")).limit(2 * TRAIN_DOCS).toPandas().sort_values("d")
    return Prose(common, sample["t"].tolist())


def quality(docs: DataFrame, doc_id: str, text: str, common_words: DataFrame) -> DataFrame:
    """One row per document: its STATS, ``prose_probability`` and ``is_prose``.

    A null text has null statistics and a null verdict; a text without any word
    is no prose. Whole texts are read whatever their length, in one pass beside
    the one that draws the sample. Languages without a listed common word are
    judged by word order and layout alone. Other columns are not carried.
    """
    model = fit(docs, doc_id, text, common_words)
    names = [*STATS, "prose_probability"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for lo, hi in portions(pdf["t"].str.len().fillna(0).astype(int), CHARS):
                part = pdf.iloc[lo:hi]
                null = part["t"].isna().to_numpy()
                texts = part["t"].fillna("").tolist()
                w = Words(texts, model.common)
                stats = statistics(texts, w)
                found = np.column_stack([stats, model.probability(model.features(texts, w, stats))])
                found[null] = np.nan
                yield pd.DataFrame(found, columns=names).assign(d=part["d"].to_numpy())[["d", *names]]

    ids = docs.select(F.col(doc_id).cast("long").alias("d"), F.col(text).alias("t"))
    scored = ids.mapInPandas(run, "d long, " + ", ".join(f"{c} double" for c in names))
    value = lambda c: F.when(~F.isnan(c), F.col(c))
    whole = ("word_count", "line_count")
    return scored.select(
        F.col("d").alias(doc_id),
        *[value(c).cast("long").alias(c) for c in whole],
        *[value(c).alias(c) for c in names if c not in whole],
        (value("prose_probability") >= 0.5).alias("is_prose"),
    )
