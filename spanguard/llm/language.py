"""Language identification by a small byte convolutional network, trained in numpy.

Text is lower-cased, taken as UTF-8 and cut into fixed-length windows that cover all of it. A
window goes through convolutions of several widths over byte embeddings, max pooling over its
positions, and softmax. The document's score is the softmax of the windows' mean logits.

The filters of widths 2, 3 and 4 are sums of one embedding row for each position, so after
training they are tabulated by pairs of bytes: a position then costs few table reads.

Training takes a bounded sample: ``TRAIN_DOCS`` documents of each language, those of least id
hash, out of the documents whose crc32(id) mod 5 isn't 0 and whose language isn't null.

Defined results: ``und`` with score 0.0 if the text is null or has no letter; equal texts get
equal results; without training documents every text is ``und``; other columns are ignored.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_batches

WINDOW, FILTERS, WIDTHS, EMBED = 256, 8, (2, 3, 4), 8
#: Bounds of training: documents of each language, languages, windows of one document.
TRAIN_DOCS, MAX_LANGUAGES, TRAIN_WINDOWS = 600, 200, 6
EPOCHS, RATE, SEED = 12, 0.01, 7


def has_letter(text: str) -> bool:
    """Whether any character is a letter; numerals of any kind (a half, a superscript, a Roman numeral) aren't."""
    return any(map(str.isalpha, text))


def windows_of(raw: bytes) -> np.ndarray:
    """Windows of a text, 2-D; the last one is filled with byte 0."""
    n = max(1, -(-len(raw) // WINDOW))
    out = np.zeros(n * WINDOW, np.uint8)
    out[: len(raw)] = np.frombuffer(raw, np.uint8)
    return out.reshape(n, WINDOW)


class ByteNet:
    """Weights: embedding (256, E), one (width * E, F) matrix and bias for each width, and the output layer."""

    def __init__(self, languages: list[str], seed: int = SEED):
        r = np.random.default_rng(seed)
        self.languages = languages
        self.w = {"emb": r.normal(0, 0.5, (256, EMBED)), "out": r.normal(0, 0.3, (FILTERS * len(WIDTHS), len(languages))), "out_b": np.zeros(len(languages))}
        for k in WIDTHS:
            self.w[f"c{k}"] = r.normal(0, (2 / (k * EMBED)) ** 0.5, (k * EMBED, FILTERS))
            self.w[f"b{k}"] = np.zeros(FILTERS)
        self.w = {k: v.astype(np.float32) for k, v in self.w.items()}

    def step(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict]:
        """Loss and gradients for windows x and language numbers y."""
        w, n = self.w, len(x)
        e = w["emb"][x]
        kept, pooled = [], []
        for k in WIDTHS:
            m = x.shape[1] - k + 1
            cols = np.concatenate([e[:, j : j + m] for j in range(k)], 2)
            a = cols @ w[f"c{k}"] + w[f"b{k}"]
            at = a.argmax(1)
            best = np.take_along_axis(a, at[:, None], 1)[:, 0]
            kept.append((cols, at, best > 0))
            pooled.append(np.maximum(best, 0))
        h = np.concatenate(pooled, 1)
        z = h @ w["out"] + w["out_b"]
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        loss = -np.log(p[np.arange(n), y] + 1e-9).mean()
        p[np.arange(n), y] -= 1
        p /= n
        g = {"out": h.T @ p, "out_b": p.sum(0), "emb": np.zeros_like(w["emb"])}
        dh = p @ w["out"].T
        for i, k in enumerate(WIDTHS):
            cols, at, on = kept[i]
            d = dh[:, i * FILTERS : (i + 1) * FILTERS] * on
            picked = np.take_along_axis(cols, at[:, :, None], 1)  # (n, F, k * E)
            g[f"c{k}"] = np.einsum("nfe,nf->ef", picked, d)
            g[f"b{k}"] = d.sum(0)
            back = d[:, :, None] * w[f"c{k}"].T[None]  # (n, F, k * E)
            for j in range(k):
                at_byte = np.take_along_axis(x, at + j, 1)
                np.add.at(g["emb"], at_byte.ravel(), back[:, :, j * EMBED : (j + 1) * EMBED].reshape(-1, EMBED))
        return float(loss), g

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = EPOCHS, seed: int = SEED) -> None:
        """Adam over shuffled batches."""
        r, t = np.random.default_rng(seed), 0
        m = {k: np.zeros_like(v) for k, v in self.w.items()}
        s = {k: np.zeros_like(v) for k, v in self.w.items()}
        for epoch in range(epochs):
            order, rate = r.permutation(len(x)), RATE * (1 - epoch / epochs)
            for at in range(0, len(x), 64):
                rows, t = order[at : at + 64], t + 1
                _, g = self.step(x[rows], y[rows])
                for k, d in g.items():
                    m[k] = 0.9 * m[k] + 0.1 * d
                    s[k] = 0.999 * s[k] + 0.001 * d * d
                    self.w[k] -= (rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(s[k] / (1 - 0.999**t)) + 1e-8)).astype(np.float32)

    def tables(self) -> dict:
        """Filter responses by byte and by pair of bytes."""
        w = self.w
        part = {(k, j): w["emb"] @ w[f"c{k}"][j * EMBED : (j + 1) * EMBED] for k in WIDTHS for j in range(k)}
        pair = lambda k, j: (part[k, j][:, None] + part[k, j + 1][None]).reshape(65536, FILTERS)
        return {"2": pair(2, 0), "3a": pair(3, 0), "3b": part[3, 2], "4a": pair(4, 0), "4b": pair(4, 2)} | {k: w[k] for k in ("b2", "b3", "b4", "out", "out_b")}


def window_logits(t: dict, x: np.ndarray) -> np.ndarray:
    """The network's logits for windows x, from its tables."""
    out = np.empty((len(x), len(t["out_b"])), np.float32)
    for at in range(0, len(x), 64):
        b = x[at : at + 64]
        n, pairs = len(b), (b[:, :-1].astype(np.int32) << 8) | b[:, 1:]
        two = np.take(t["2"], pairs, 0).max(1)
        a3 = np.take(t["3a"], pairs[:, :-1], 0)
        a3 += np.take(t["3b"], b[:, 2:], 0)
        a4 = np.take(t["4a"], pairs[:, :-2], 0)
        a4 += np.take(t["4b"], pairs[:, 2:], 0)
        h = np.concatenate([two + t["b2"], a3.max(1) + t["b3"], a4.max(1) + t["b4"]], 1)
        out[at : at + n] = np.maximum(h, 0) @ t["out"] + t["out_b"]
    return out


def training_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The bounded sample: text and lang, the same for the same table."""
    crc = F.crc32(F.col(id_col).cast("string").cast("binary"))
    usable = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & (F.coalesce(crc, F.lit(0)) % 5 != 0)).select(F.col(id_col).alias("i"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    u = F.shiftrightunsigned(F.xxhash64("i", F.lit(SEED)), 11) / F.lit(float(2**53))
    usable = usable.withColumn("u", u)
    counts = usable.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MAX_LANGUAGES).collect()
    if not counts:
        return usable.select("lang", "text").limit(0)
    # twice as many as wanted pass a threshold, whatever the table's size, and few are left to sort
    below = F.lit(None).cast("boolean")
    for r in counts:
        below = F.when(F.col("lang") == r.lang, F.col("u") < 2 * TRAIN_DOCS / r["count"]).otherwise(below)
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("u", "i", "text"))
    return usable.where(below).withColumn("nth", nth).where(F.col("nth") <= TRAIN_DOCS).orderBy("lang", "nth").select("lang", "text")


def train(rows: list[tuple[str, str]]) -> ByteNet | None:
    """A network for (language, text) rows; None if there are none."""
    languages = sorted({g for g, _ in rows})
    if not languages:
        return None
    r, xs, ys = np.random.default_rng(SEED), [], []
    for g, text in rows:
        if not has_letter(text):
            continue
        x = windows_of(text.lower().encode())
        if len(x) > TRAIN_WINDOWS:
            x = x[r.choice(len(x), TRAIN_WINDOWS, replace=False)]
        xs.append(x)
        ys += [languages.index(g)] * len(x)
    net = ByteNet(languages)
    if len(languages) > 1 and xs:
        net.fit(np.concatenate(xs), np.array(ys))
    return net


#: Windows that go through the network together, whichever texts they are of.
POOL = 1024


def _sums(tables: dict, texts: list[bytes]):
    """Sum of the logits and number of the windows of each text; no more than POOL windows are held."""
    total, count = [], []
    pool, owner = [], []

    def run():
        z = window_logits(tables, np.concatenate(pool)).astype(np.float64)
        of = np.concatenate(owner)
        first = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
        for i, s in zip(of[first].tolist(), np.add.reduceat(z, first)):
            total[i] = total[i] + s

    held = 0
    for i, raw in enumerate(texts):
        x = windows_of(raw)
        total.append(0.0)
        count.append(len(x))
        for at in range(0, len(x), POOL):
            part = x[at : at + POOL]
            if held + len(part) > POOL:
                run()
                pool, owner, held = [], [], 0
            pool.append(part)
            owner.append(np.full(len(part), i))
            held += len(part)
    if pool:
        run()
    return total, count


def predict_all(tables: dict | None, net: ByteNet | None, texts: list[str | None]) -> list[tuple[str, float]]:
    """Language and score of each text, by batches of windows; a window's logits don't depend on its batch."""
    out = [("und", 0.0)] * len(texts)
    known = [i for i, t in enumerate(texts) if t and has_letter(t)] if net else []
    for i, total, n in zip(known, *_sums(tables, [texts[i].lower().encode() for i in known])):
        z = total / n
        p = np.exp(z - z.max())
        p /= p.sum()
        k = int(p.argmax())
        out[i] = (net.languages[k], float(p[k]))
    return out


def predict(tables: dict | None, net: ByteNet | None, text: str | None) -> tuple[str, float]:
    """Language and score of one text."""
    return predict_all(tables, net, [text])[0]


def identify(docs: DataFrame, net: ByteNet | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows doc_id, held_out, lang_pred, score."""
    crc = F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(0))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), (crc % 5 == 0).alias("held_out"), F.col(text_col).alias("text"))
    tables = net.tables() if net else None

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = predict_all(tables, net, batch.column("text").to_pylist())
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array([a for a, _ in found], pa.string()), pa.array([b for _, b in found], pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

        return step

    return map_batches(rows, make, "doc_id long, held_out boolean, lang_pred string, score double")


def keep_identified(docs: DataFrame, net: ByteNet | None, least: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose language is found with a score of ``least`` or more."""
    tables = net.tables() if net else None

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            return batch.filter(pa.array([s >= least for _, s in predict_all(tables, net, batch.column(text_col).to_pylist())], pa.bool_()))

        return step

    return map_batches(docs, make, docs.schema)


def language_id(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Train on the table's own labelled rows and predict every row."""
    sample = [(r.lang, r.text) for r in training_rows(docs, id_col, text_col, lang_col).collect()]
    return identify(docs, train(sample), id_col, text_col)
