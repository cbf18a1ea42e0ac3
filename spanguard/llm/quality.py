"""Document quality by co-training of two classifiers.

One view has the words of the text, the other the page's metadata: source, language, length and
layout (lines, share of capitals, digits, symbols and white space, repeated words). Both begin
with the labelled rows; over rounds each labels the unlabelled documents of which it is most
confident for the other. Their log-odds are then calibrated and combined on labelled rows that
neither was fitted to, and every document is scored over its whole text.

Two such pairs are fitted: for quality, and among documents of quality 1 for not being toxic.
A document's score is the product of both probabilities.

The texts are read once, into a table of features. The fit begins with at most ``LABELLED`` labelled
rows, of least id hash. In each round both views score every document of the corpus; all texts
of which a view is sure are candidates, and of these the ``PER_ROUND`` texts of least hash, a hash
of each round's own, are labelled for the other view. So what is fitted to stays bounded, and what it
is drawn from is the whole corpus at every size. Rows whose text is one of the first rows' are never
candidates; equal texts are one.

Defined results: null or blank texts score 0 and aren't kept; null labels and labels of no
document are left out, of several labels of an id the worst counts; with labels of one kind
only, or none, that kind's share is the score; equal rows get equal scores; other columns are
ignored.
"""

from __future__ import annotations

import re
from copy import copy

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import Scratch, map_batches

LABELLED, HELD_OUT = 16_000, 5
ROUNDS, PER_ROUND, CONFIDENT = 3, 400, 0.97
LEAST_DOCS, BUCKETS, MEMO = 5, 64, 500_000
#: Standard errors by which a word's log-odds must differ from none.
SURE = 3.3
_WORD = re.compile(r"[^\W\d_]+")


class _Hashes(dict):
    def __missing__(self, word: str) -> int:
        if len(self) >= MEMO:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word) >> 33
        return h


def text_words(text: str) -> set[str]:
    return set(_WORD.findall(text.lower()))


def figures(text: str) -> list[float]:
    """Layout figures of a text."""
    raw = np.frombuffer(text.encode(), np.uint8)
    c = np.bincount(raw, minlength=256)
    n = max(1, len(raw))
    lines = int(c[10]) + 1
    words = text.split()
    return [
        np.log1p(len(text)), np.log1p(lines), np.log1p(n / lines), c[65:91].sum() / n, c[48:58].sum() / n, (c[33:48].sum() + c[58:65].sum() + c[91:97].sum() + c[123:127].sum()) / n,
        (c[32] + c[9]) / n, c[10] / n, c[128:].sum() / n, c[33] / n, c[124] / n, len(set(words)) / max(1, len(words)), np.log1p(n / max(1, len(words))),
    ]


FIGURES = len(figures(""))


def metadata(figs: np.ndarray, source: np.ndarray, lang: np.ndarray) -> np.ndarray:
    """The second view: layout figures, each cut into steps too (what is good is often a middle range), and one-hot buckets of source and language."""
    n = len(figs)
    steps = np.minimum(7, (figs * np.where(figs <= 1, 8, 1)).astype(int))
    out = np.zeros((n, FIGURES * 9 + 2 * BUCKETS), np.float32)
    row, at = np.arange(n), np.arange(FIGURES) * 9
    out[:, at] = figs
    out[row[:, None], at + 1 + steps] = 1
    out[row, FIGURES * 9 + source] = 1
    out[row, FIGURES * 9 + BUCKETS + lang] = 1
    return out


class Words:
    """The distinct words of documents, one behind the other."""

    def __init__(self, flat: np.ndarray, begin: np.ndarray):
        self.flat, self.begin = flat, begin

    @staticmethod
    def of(column) -> "Words":
        """From an Arrow list column."""
        return Words(column.flatten().to_numpy(zero_copy_only=False), np.append(0, np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False))).astype(np.int64))

    def take(self, rows: np.ndarray) -> "Words":
        parts = [self.flat[self.begin[i] : self.begin[i + 1]] for i in rows]
        return Words(np.concatenate([*parts, self.flat[:0]]), np.append(0, np.cumsum([len(p) for p in parts])).astype(np.int64))

    def __add__(self, other: "Words") -> "Words":
        return Words(np.concatenate([self.flat, other.flat]), np.append(self.begin, other.begin[1:] + self.begin[-1]))


class Sparse:
    """Logistic regression on binary words, with the words of at least LEAST_DOCS documents."""

    def fit(self, docs: "Words", y: np.ndarray, steps: int = 150, decay: float = 1e-4) -> "Sparse":
        words, back, df = np.unique(docs.flat, return_inverse=True, return_counts=True)
        good = np.bincount(back, np.repeat(y, np.diff(docs.begin)), len(words))
        n, k = len(y), y.sum()
        # words whose share of good documents differs from the rest's by more than chance
        odds = np.log((good + 0.5) * (n - k + 1) / ((df - good + 0.5) * (k + 1)))
        self.words = words[(df >= LEAST_DOCS) & (np.abs(odds) >= SURE * np.sqrt(1 / (good + 0.5) + 1 / (df - good + 0.5)))]
        at, begin = self._columns(docs)
        w, b, m, s = np.zeros(len(self.words)), 0.0, np.zeros(len(self.words) + 1), np.zeros(len(self.words) + 1)
        for t in range(1, steps + 1):
            p = 1 / (1 + np.exp(-(self._sums(w, at, begin) + b)))
            d = (p - y) / len(y)
            g = np.append(np.bincount(at, np.repeat(d, np.diff(begin)), len(w)) + decay * w, d.sum())
            m, s = 0.9 * m + 0.1 * g, 0.99 * s + 0.01 * g * g
            step = 0.15 * (m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.99**t)) + 1e-6)
            w, b = w - step[:-1], b - step[-1]
        self.w, self.b = w, b
        return self

    def _columns(self, docs: "Words"):
        if not len(self.words):
            return np.zeros(0, np.int64), np.zeros_like(docs.begin)
        at = np.minimum(np.searchsorted(self.words, docs.flat), len(self.words) - 1)
        known = self.words[at] == docs.flat
        return at[known], np.append(0, np.cumsum(known))[docs.begin]

    @staticmethod
    def _sums(w, at, begin):
        total = np.append(0.0, np.cumsum(w[at]))
        return total[begin[1:]] - total[begin[:-1]]

    def odds(self, docs: "Words") -> np.ndarray:
        return self._sums(self.w, *self._columns(docs)) + self.b


class Dense:
    """Logistic regression on standardized figures."""

    def fit(self, x: np.ndarray, y: np.ndarray, steps: int = 300, decay: float = 1e-4) -> "Dense":
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-3
        z = np.column_stack([(x - self.mean) / self.scale, np.ones(len(x))])
        w, m, s = np.zeros(z.shape[1]), np.zeros(z.shape[1]), np.zeros(z.shape[1])
        for t in range(1, steps + 1):
            g = z.T @ (1 / (1 + np.exp(-np.clip(z @ w, -30, 30))) - y) / len(y) + decay * w
            m, s = 0.9 * m + 0.1 * g, 0.99 * s + 0.01 * g * g
            w = w - 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.99**t)) + 1e-6)
        self.w = w
        return self

    def odds(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale) @ self.w[:-1] + self.w[-1]


def _one(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class CoModel:
    """Two views, the pseudo-labels that they gave each other, and a calibrated combination of their log-odds."""

    def __init__(self, words: Words, meta: np.ndarray, y: np.ndarray, seed: int = 3):
        self.share, self.both = float(y.mean()) if len(y) else 0.0, None
        if len(np.unique(y)) < 2:
            return
        fold = np.random.default_rng(seed).permutation(len(y)) % HELD_OUT == 0
        if len(np.unique(y[fold])) < 2 or len(np.unique(y[~fold])) < 2:
            fold = np.zeros(len(y), bool)
        base, held = np.flatnonzero(~fold), np.flatnonzero(fold if fold.any() else ~fold)
        self.held = words.take(held), meta[held], y[held]
        self.rows = {"text": (words.take(base), y[base]), "meta": (meta[base], y[base])}
        self._fit("text", "meta")

    def _fit(self, *views: str) -> None:
        """Fit the views anew, and what they and both together say on the held-out rows."""
        if "text" in views:
            self.text = Sparse().fit(*self.rows["text"])
        if "meta" in views:
            self.meta = Dense().fit(*self.rows["meta"])
        words, meta, y = self.held
        t, m = self.text.odds(words), self.meta.odds(meta)
        self.sure = {"text": Dense().fit(t[:, None], y), "meta": Dense().fit(m[:, None], y)}
        self.both = Dense().fit(np.clip(np.column_stack([t, m]), -12, 12), y, decay=1e-3)

    def learn(self, words: dict[str, tuple[Words, np.ndarray, np.ndarray]]) -> None:
        """Add rows (words, metadata, labels) that a view has labelled to those of the other."""
        for by, (more, meta, y) in words.items():
            to = "meta" if by == "text" else "text"
            x, old = self.rows[to]
            self.rows[to] = (x + more if to == "text" else np.vstack([x, meta])), np.append(old, y)
        self._fit(*("meta" if by == "text" else "text" for by in words))

    def views(self, words: Words, meta: np.ndarray) -> dict[str, np.ndarray]:
        """Calibrated probabilities of each view."""
        odds = {"text": self.text.odds(words), "meta": self.meta.odds(meta)}
        return {v: _one(self.sure[v].odds(z[:, None])) for v, z in odds.items()}

    def scores(self, words: Words, meta: np.ndarray):
        """Probabilities by the text, by the metadata and by both."""
        if self.both is None:
            return (np.full(len(meta), self.share),) * 3
        t, m = self.text.odds(words), self.meta.odds(meta)
        return _one(t), _one(m), _one(self.both.odds(np.clip(np.column_stack([t, m]), -12, 12)))

    def bare(self) -> "CoModel":
        """What scores need: without the rows that it was fitted to, and only with words that move a score."""
        out = copy(self)
        if self.both is not None:
            out.rows = out.held = None
            out.text = copy(self.text)
            moving = np.abs(self.text.w) > 1e-4
            out.text.words, out.text.w = self.text.words[moving], self.text.w[moving]
        return out


COLUMNS = "id long, th long, blank boolean, words array<int>, figures array<float>, source int, lang int"


def features(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """What both views need of each row: the text's hash, its distinct words' hashes, its layout, buckets of source and language."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64("text").alias("th"), "text", "source", "lang")

    def make():
        hashes = _Hashes()

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = batch.column("text").to_pylist()
            words = [np.sort(np.fromiter({hashes[w] for w in text_words(t)}, np.int32)) if t else np.zeros(0, np.int32) for t in texts]
            words = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum([len(w) for w in words])), pa.int32()), pa.array(np.concatenate(words)))
            layout = pa.array([figures(t or "") for t in texts], pa.list_(pa.float32()))
            buckets = [pa.array([xxhash.xxh3_64_intdigest(x or "") % BUCKETS for x in batch.column(c).to_pylist()], pa.int32()) for c in ("source", "lang")]
            return pa.RecordBatch.from_arrays([batch.column("id"), batch.column("th"), pa.array([not t or t.isspace() for t in texts]), words, layout, *buckets], names=[c.split()[0] for c in COLUMNS.split(", ")])

        return step

    return map_batches(rows, make, COLUMNS)


def _arrays(batch) -> tuple[Words, np.ndarray]:
    """Both views of the rows of a batch or of a table without chunks."""
    figs = batch.column("figures").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, FIGURES)
    return Words.of(batch.column("words")), metadata(figs, *(batch.column(c).to_numpy(zero_copy_only=False) for c in ("source", "lang")))


def _gathered(rows: DataFrame, *order: str) -> pa.RecordBatch:
    """A bounded table on the driver, in an order of its own, so that a fit is the same each time."""
    found = rows.toArrow().combine_chunks()
    found = found.take(pa.array(np.lexsort([found[c].to_numpy() for c in reversed(order)])))
    return pa.RecordBatch.from_arrays([c.combine_chunks() for c in found.columns], names=found.column_names)


def _drawn(df: DataFrame, wanted: int, rows: int) -> DataFrame:
    """``wanted`` rows of least id hash; a threshold leaves about twice as many to sort."""
    u = F.shiftrightunsigned(F.xxhash64("id", F.lit(23)), 11) / F.lit(float(2**53))
    return df.where(u < 2 * wanted / max(rows, 1)).orderBy(u, "id").limit(wanted)


def _candidates(feats: DataFrame, models: list[CoModel], known: np.ndarray) -> DataFrame:
    """Rows g, th of each text that a view of a model is sure of: g tells model, view and label; texts in ``known`` (sorted) are left out."""
    models = [m.bare() for m in models]

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            words, meta = _arrays(batch)
            th, g = batch.column("th").to_numpy(), []
            open_ = ~np.isin(th, known) & ~batch.column("blank").to_numpy(zero_copy_only=False)
            for k, model in enumerate(models):
                if model.both is not None:
                    for v, p in enumerate(model.views(words, meta).values()):
                        g += [(4 * k + 2 * v + label, np.unique(th[open_ & (sure >= CONFIDENT)])) for label, sure in enumerate((1 - p, p))]
            return pa.RecordBatch.from_arrays([pa.array(np.repeat([c for c, _ in g], [len(x) for _, x in g]).astype(np.int32)), pa.array(np.concatenate([np.zeros(0, np.int64), *(x for _, x in g)]))], names=["g", "th"])

        return step

    return map_batches(feats.select("th", "blank", "words", "figures", "source", "lang"), make, "g int, th long")


def fit(feats: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> tuple[CoModel, CoModel]:
    """Models of quality and of not being toxic, from ``features`` of all documents (a saved table) and ``labels`` (id, quality, toxic)."""
    kind = F.when(F.min("quality") < 1, 0).when(F.max("toxic") < 1, 2).otherwise(1)
    known = labels.where("quality is not null and toxic is not null").groupBy(F.col(id_col).cast("long").alias("id")).agg(kind.alias("y")).where("id is not null")
    picked = _drawn(known, LABELLED, known.count())
    train = _gathered(feats.join(F.broadcast(picked), "id").where("not blank"), "id", "th")
    words, meta = _arrays(train)
    y = train.column("y").to_numpy()
    fine = np.flatnonzero(y > 0)
    models = [CoModel(words, meta, (y > 0).astype(float)), CoModel(words.take(fine), meta[fine], (y[fine] > 1).astype(float))]
    fitted = np.unique(train.column("th").to_numpy())
    for r in range(ROUNDS if any(m.both is not None for m in models) else 0):
        # equal texts count once; the limit of a group is taken in each task before the rows move
        each = _candidates(feats, models, fitted).distinct()
        rank = F.row_number().over(Window.partitionBy("g").orderBy(F.xxhash64("th", F.lit(r)), "th"))
        chosen = [(x.g, x.th) for x in each.withColumn("rank", rank).where(F.col("rank") <= PER_ROUND).select("g", "th").collect()]
        if not chosen:
            break
        texts = feats.sparkSession.createDataFrame([(t,) for t in sorted({t for _, t in chosen})], "th long")
        one = feats.join(F.broadcast(texts), "th").groupBy("th").agg(F.min(F.struct("source", "lang", "words", "figures")).alias("x"))
        found = _gathered(one.select("th", "x.*"), "th")
        words, meta = _arrays(found)
        at = {t: i for i, t in enumerate(found.column("th").to_pylist())}
        for k, model in enumerate(models):
            said = {}
            for v, view in enumerate(("text", "meta")):
                rows = sorted((t, g % 2) for g, t in chosen if g // 2 == 2 * k + v)
                if rows:
                    i = np.array([at[t] for t, _ in rows])
                    said[view] = words.take(i), meta[i], np.array([float(label) for _, label in rows])
            if said:
                model.learn(said)
        fitted = np.union1d(fitted, [t for _, t in chosen])
    return models[0].bare(), models[1].bare()


def score(feats: DataFrame, models: tuple[CoModel, CoModel], least: float = 0.5) -> DataFrame:
    """Rows doc_id, p_text, p_meta, p_toxic, score, kept of each row of ``features``."""
    first, second = models

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            words, meta = _arrays(batch)
            by_text, by_meta, good = first.scores(words, meta)
            clean = second.scores(words, meta)[2]
            total = np.where(batch.column("blank").to_numpy(zero_copy_only=False), 0.0, good * clean)
            return pa.RecordBatch.from_arrays([batch.column("id"), *(pa.array(x, pa.float64()) for x in (by_text, by_meta, 1 - clean, total)), pa.array(total >= least)], names=["doc_id", "p_text", "p_meta", "p_toxic", "score", "kept"])

        return step

    return map_batches(feats, make, "doc_id long, p_text double, p_meta double, p_toxic double, score double, kept boolean")


def quality(docs: DataFrame, labels: DataFrame, least: float = 0.5, id_col: str = "doc_id") -> DataFrame:
    """Fit on the labelled documents and score all."""
    feats = Scratch(docs.sparkSession, "quality").save(features(docs, id_col), "features")
    return score(feats, fit(feats, labels, id_col), least)
