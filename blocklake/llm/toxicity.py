"""Toxicity: a convolutional text classifier on hashed word embeddings, trained here in numpy.

A word's vector is the sum of embeddings of its hash and of hashes of its first letters (so that inflected words share
what they know), filters of several widths run over the words of the whole text, and each filter's greatest values at
different n-grams are pooled. A logistic layer on them and the text's length gives the score.

Fitting needs a sample of labelled rows of bounded size (``max_rows``, ``max_bytes``); one task gets it and returns the model,
so the driver never holds a text. The model has a fixed size and is broadcast; scoring is one scan of all texts with no
shuffle. Language decides nothing but the threshold of the verdict; it is no input of the score.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blocklake.llm.common import slices, table, text_buffers
from blocklake.llm.tokens import ALNUM, LOWER, prefix_sums, span_hash, words

#: Lengths in bytes of the first letters that are hashed besides the whole word (0).
PREFIXES = (0, 4, 5, 6, 7)
BUCKETS, DIM, WIDTHS, FILTERS, TOP = 1 << 14, 16, (1, 2, 3), 12, 3
PAD = max(WIDTHS) - 1
THRESHOLD = 0.7
#: Words of a training batch, about; a longer text is a batch by itself.
BATCH_WORDS = 10_000
NEVER = np.float32(-1e9)
#: How counts become the first number of an embedding, and about how many steps few rows are trained for.
SURE, LEAST, SCALE, FEW, STEPS = 1.645, 1.5, 0.45, 500, 300
#: Passes over the rows without a lower loss on those kept out, after which training ends.
PATIENCE = 6
OFFSETS = [(w, o) for w in WIDTHS for o in range(w)]


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``ids, bounds``: hash buckets of all words of several texts (words x features), and where each text's words start."""
    data = LOWER[data]
    starts, ends, bounds = words(data, offsets, ALNUM)
    sums = prefix_sums(data)
    ids = np.empty((len(starts), len(PREFIXES)), np.int32)
    for k, n in enumerate(PREFIXES):
        h = span_hash(sums, starts, np.minimum(ends, starts + n) if n else ends)
        ids[:, k] = (h >> np.uint64(20)) % np.uint64(BUCKETS) + np.uint64(k * BUCKETS)
    return ids, bounds


def _padded(ids: np.ndarray, bounds: np.ndarray, embeddings: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word vectors with PAD zero rows after each text, where each text starts there, and the place of each word."""
    counts = np.diff(bounds)
    at = np.r_[0, np.cumsum(counts + PAD)]
    place = np.arange(len(ids)) + np.repeat(np.arange(len(counts)) * PAD, counts)
    x = np.zeros((at[-1] + PAD, DIM), np.float32)
    v = embeddings[ids[:, 0]]
    for k in range(1, ids.shape[1]):
        v += embeddings[ids[:, k]]
    x[place] = v
    return x, at, place


@dataclass
class Model:
    embeddings: np.ndarray
    filters: np.ndarray  # DIM x (offsets x FILTERS)
    bias: np.ndarray  # widths x FILTERS
    top: np.ndarray  # pooled features and log length
    shift: float
    scale: tuple[float, float] = (1.0, 0.0)  # calibration of the logit
    thresholds: dict[str, float] = field(default_factory=dict)

    def maps(self, x: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
        """For each width, every filter's value at every place of padded vectors.

        Products are summed in double precision and then rounded, so that equal n-grams have equal values wherever they stand.
        """
        y, n = (x.astype(np.float64) @ self.filters.astype(np.float64)).astype(np.float32), len(x) - PAD
        out, k = [], 0
        for w in WIDTHS:
            m = y[:n, k * FILTERS : (k + 1) * FILTERS].copy()
            for o in range(1, w):
                m += y[o : n + o, (k + o) * FILTERS : (k + o + 1) * FILTERS]
            for o in range(1, w):
                m[at[1:] - o] = NEVER  # would reach into the next text
            out.append(m)
            k += w
        return out

    def pooled(self, ids: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Texts x (widths x TOP x FILTERS + 1): greatest different values of each filter, and the log of the length."""
        x, at, _ = _padded(ids, bounds, self.embeddings)
        counts = np.diff(at)
        out = []
        for w, m in enumerate(self.maps(x, at)):
            for k in range(TOP):
                best = np.maximum.reduceat(m, at[:-1], axis=0)
                out.append(np.maximum(best + self.bias[w], 0))
                if k + 1 < TOP:
                    m[m == np.repeat(best, counts, axis=0)] = NEVER
        return np.hstack([*out, np.log1p(np.diff(bounds))[:, None].astype(np.float32) / 8])

    def logits(self, ids: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        return self.pooled(ids, bounds) @ self.top + self.shift

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        out = np.empty(len(offsets) - 1)
        for a, b in slices(offsets, 1 << 19):
            part = data[offsets[a] : offsets[b]]
            out[a:b] = self.logits(*features(part, offsets[a : b + 1] - offsets[a]))
        return 1 / (1 + np.exp(-np.clip(self.scale[0] * out + self.scale[1], -30, 30)))


def _sample_features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features of the whole sample, a quarter of a megabyte at a time."""
    parts = [features(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]) for a, b in slices(offsets, 1 << 18)]
    counts = [np.diff(b) for _, b in parts]
    ids = np.concatenate([i for i, _ in parts]) if parts else np.zeros((0, len(PREFIXES)), np.int32)
    return ids, np.r_[0, np.cumsum(np.concatenate(counts))] if counts else np.zeros(1, np.int64)


def _telling(ids: np.ndarray, bounds: np.ndarray, rows: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """For each hash bucket how surely it tells toxic rows from others: the log odds ratio less SURE deviations, where that is over LEAST."""
    counts = np.diff(bounds)
    doc = np.repeat(np.arange(len(counts)), counts)
    used = np.zeros(len(counts), bool)
    used[rows] = True
    n = np.zeros((2, len(PREFIXES) * BUCKETS))
    for k in range(ids.shape[1]):
        pairs = np.unique(doc[used[doc]] * (len(PREFIXES) * BUCKETS) + ids[used[doc], k])
        where = pairs // (len(PREFIXES) * BUCKETS)
        np.add.at(n, (labels[where].astype(int), pairs % (len(PREFIXES) * BUCKETS)), 1)
    total = np.array([(labels[rows] == c).sum() for c in (0, 1)])
    odds = np.log((n[1] + 0.5) / (total[1] + 1)) - np.log((n[0] + 0.5) / (total[0] + 1))
    return SCALE * np.maximum(odds - SURE * np.sqrt(1 / (n[0] + 0.5) + 1 / (n[1] + 0.5)) - LEAST, 0)


def fit(texts: pa.Array, labels: np.ndarray, weights: np.ndarray, langs: list[str | None], epochs: int = 12, batch: int = 32, seed: int = 8) -> Model:
    """Adagrad on the weighted log loss; a fifth of the rows is kept out to calibrate scores and thresholds.

    With few rows (in the order of ``FEW``) the first number of each embedding starts as what counts tell of its bucket, and the first
    filter of width one reads it, so that some hundred rows suffice to know the words that toxic rows share; all of it is trained
    on. Few rows are gone through more often, for about ``STEPS`` steps. The best model so far is kept, and training ends once
    ``PATIENCE`` passes have brought no better one.
    """
    rng = np.random.default_rng(seed)
    model = Model(rng.normal(0, 0.1, (len(PREFIXES) * BUCKETS, DIM)).astype(np.float32), rng.normal(0, 0.25, (DIM, len(OFFSETS) * FILTERS)).astype(np.float32), np.zeros((len(WIDTHS), FILTERS), np.float32), rng.normal(0, 0.1, len(WIDTHS) * TOP * FILTERS + 1).astype(np.float32), 0.0)
    ids, bounds = _sample_features(*text_buffers(texts))
    n = len(texts)
    if n == 0 or labels.min() == labels.max():  # nothing to tell apart
        model.top[:] = 0
        model.shift = 0.0 if n == 0 else float(np.where(labels[0], 4.0, -4.0))
        return model
    prior = float(np.average(labels, weights=weights))
    model.shift = float(np.log(prior / (1 - prior)))
    kept = rng.permutation(n)
    kept = kept[np.argsort(labels[kept], kind="stable")]  # a fifth of each class is kept out
    held, train = kept[::5], np.delete(kept, np.s_[::5])
    part = np.float32(np.exp(-len(train) / FEW))  # the more rows there are to train on, the less counts say
    model.embeddings[:, 0] += part * (_telling(ids, bounds, train, labels) - model.embeddings[:, 0])
    model.filters[:, 0] += part * (np.eye(DIM, dtype=np.float32)[0] - model.filters[:, 0])
    model.top[: TOP * FILTERS : FILTERS] += part * (1 - model.top[: TOP * FILTERS : FILTERS])
    epochs = max(epochs, min(8 * epochs, STEPS * batch // max(1, len(train))))
    sq = {"e": np.full(len(model.embeddings), 1e-6, np.float32), "f": np.full_like(model.filters, 1e-6), "b": np.full_like(model.bias, 1e-6), "t": np.full_like(model.top, 1e-6), "s": 1e-6}
    best, best_loss, since = None, np.inf, 0
    copy = lambda: (model.embeddings.copy(), model.filters.copy(), model.bias.copy(), model.top.copy(), model.shift)

    def portions(rows: np.ndarray) -> list[np.ndarray]:
        """Rows in order, at most ``batch`` of them and about BATCH_WORDS words at a time, so that scratch arrays stay small."""
        counts, cuts, words_, n_ = bounds[rows + 1] - bounds[rows], [0], 0, 0
        for i, c in enumerate(counts):
            if n_ and (n_ == batch or words_ + c > BATCH_WORDS):
                cuts.append(i)
                words_ = n_ = 0
            words_, n_ = words_ + c, n_ + 1
        return [rows[a:b] for a, b in zip(cuts, [*cuts[1:], len(rows)], strict=True) if b > a]

    def logits(rows: np.ndarray) -> np.ndarray:
        return np.concatenate([model.logits(*take(part)) for part in portions(rows)])

    def take(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        counts = bounds[rows + 1] - bounds[rows]
        b = np.r_[0, np.cumsum(counts)]
        pick = np.arange(b[-1]) - np.repeat(b[:-1], counts) + np.repeat(bounds[rows], counts)
        return ids[pick], b

    def loss(rows: np.ndarray) -> float:
        z = logits(rows)
        return float(np.average(np.logaddexp(0, np.where(labels[rows] > 0, -z, z)), weights=weights[rows]))

    if len(held):  # what counts tell by themselves may be the best there is
        best, best_loss = copy(), loss(held)
    for epoch in range(epochs):
        rate = 0.1 / (1 + epoch / 4)
        for rows in portions(rng.permutation(train)):
            got, b = take(rows)
            drop = rng.random(len(got)) < 0.3  # a word is at times known by its first letters only
            used = got.copy()
            used[drop, 0] = got[drop, 1]
            x, at, place = _padded(used, b, model.embeddings)
            counts = np.diff(at)
            doc = np.repeat(np.arange(len(rows)), counts)
            pooled, where = [], []
            for w, m in enumerate(model.maps(x, at)):
                for k in range(TOP):
                    top = np.maximum.reduceat(m, at[:-1], axis=0)
                    r, c = np.nonzero(m == top[doc])
                    arg = np.zeros(top.shape, np.int64)
                    arg[doc[r[::-1]], c[::-1]] = r[::-1]  # the first of equal places stays
                    pooled.append(np.maximum(top + model.bias[w], 0))
                    where.append(arg)
                    m[r, c] = NEVER
            p = np.hstack([*pooled, np.log1p(np.diff(b))[:, None].astype(np.float32) / 8])
            z = p @ model.top + model.shift
            g = (weights[rows] * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[rows]) / len(rows)).astype(np.float32)
            gt = p.T @ g + 1e-4 * model.top
            dp = g[:, None] * model.top[None, :-1]
            gf, gb = 1e-5 * model.filters, np.zeros_like(model.bias)
            gx = np.zeros_like(x)
            for w, width in enumerate(WIDTHS):
                base = sum(WIDTHS[:w])
                for k in range(TOP):
                    j = w * TOP + k
                    d = dp[:, j * FILTERS : (j + 1) * FILTERS] * (pooled[j] > 0)
                    gb[w] += d.sum(0)
                    r, c = np.nonzero(d)
                    for o in range(width):
                        col = (base + o) * FILTERS + c
                        spot = where[j][r, c] + o
                        np.add.at(gx, spot, d[r, c][:, None] * model.filters[:, col].T)
                        np.add.at(gf.T, col, d[r, c][:, None] * x[spot])
            gw = gx[place]
            moved = np.flatnonzero(np.abs(gw).sum(1))
            if len(moved):
                flat, index = np.unique(used[moved].ravel(), return_inverse=True)
                ge = np.zeros((len(flat), DIM), np.float32)
                np.add.at(ge, index, np.repeat(gw[moved], used.shape[1], axis=0))
                sq["e"][flat] += (ge**2).mean(1)
                model.embeddings[flat] -= rate * ge / np.sqrt(sq["e"][flat])[:, None]
            for k, g_, a in (("f", gf, model.filters), ("b", gb, model.bias), ("t", gt, model.top)):
                sq[k] += g_**2
                a -= rate * g_ / np.sqrt(sq[k])
            gs = float(g.sum())
            sq["s"] += gs * gs
            model.shift -= rate * gs / np.sqrt(sq["s"])
        now = loss(held) if len(held) else 0.0
        since += 1
        if now < best_loss:
            best_loss, best, since = now, copy(), 0
        elif since == PATIENCE:
            break
    if best:
        model.embeddings, model.filters, model.bias, model.top, model.shift = best
    rows = held if len(held) >= 20 else kept
    _calibrate(model, logits(rows), rows, labels, weights, langs)
    return model


def _calibrate(model: Model, z: np.ndarray, rows: np.ndarray, labels: np.ndarray, weights: np.ndarray, langs: list[str | None]) -> None:
    """Scale and shift of the logit by weighted log loss, and for each language the threshold of the best F1 near THRESHOLD."""
    y, w = labels[rows], weights[rows]
    # few rows of a class say little: targets keep away from 0 and 1 accordingly
    n1, n0 = (y == 1).sum(), (y == 0).sum()
    t = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, b = 1.0, 0.0
    for _ in range(60):  # Newton steps on two numbers, held near the start
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30)))
        g = np.array([np.average((p - t) * z, weights=w) + 0.02 * (a - 1), np.average(p - t, weights=w) + 0.01 * b])
        q = w * p * (1 - p) / w.sum()
        hessian = np.array([[(q * z * z).sum() + 0.02, (q * z).sum()], [(q * z).sum(), q.sum() + 0.01]])
        step = np.clip(np.linalg.solve(hessian, g), -0.5, 0.5)
        a, b = float(np.clip(a - step[0], 0.3, 3)), float(np.clip(b - step[1], -3, 3))
    model.scale = (a, b)
    p = 1 / (1 + np.exp(-np.clip(model.scale[0] * z + model.scale[1], -30, 30)))
    names = np.array([x or "" for x in (langs[i] for i in rows)])
    for lang in np.unique(names):
        mine = names == lang
        if (y[mine] * 1).sum() < 20:
            continue
        grid = np.linspace(0.5, 0.9, 9)
        f1 = [2 * (w * y * (p >= t))[mine].sum() / max(1e-9, ((w * y)[mine].sum() + (w * (p >= t))[mine].sum())) for t in grid]
        good = np.flatnonzero(np.array(f1) >= max(f1) - 1e-9)
        model.thresholds[str(lang)] = float(grid[good[np.argmin(np.abs(grid[good] - THRESHOLD))]])


def held_out(doc_id: Column) -> Column:
    """Rows kept from all fitting: those whose crc32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def _fit(shares: dict[int, int]):
    """The model, pickled, from all rows ``lang, text, label`` of one partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(list(batches), pa.schema([("lang", pa.string()), ("text", pa.string()), ("label", pa.int32())]))
        y = rows["label"].to_numpy().astype(np.float64)
        total = max(1, sum(shares.values()))
        weights = np.array([shares.get(int(c), 1) / total / max(1e-9, (y == c).mean()) for c in y])
        model = fit(rows["text"].combine_chunks(), y, weights, rows["lang"].to_pylist())
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(vars(model))], pa.binary())], ["model"])

    return run


def train(docs: DataFrame, labels: DataFrame, max_rows: int = 2000, max_bytes: int = 16 << 20) -> Model:
    """A model fitted on at most ``max_rows`` toxic and as many other labelled rows, chosen by a hash, none held out.

    Of each class also at most ``max_bytes`` of texts: in order of the hash, rows are learned from as long as their bytes and
    those before fit. Rows are weighted so that both classes have their share of all labelled rows. Null labels are no labels;
    an id that repeats is one row, with its least text; no labelled row gives a model that says 0.5 of everything.
    """
    own = docs.select(F.col("doc_id").alias("id"), F.col("lang").cast("string").alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).select(F.col("doc_id").alias("id"), (F.col("toxic") > 0).cast("int").alias("label"))
    shares = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}  # two rows
    order = F.xxhash64("id", F.lit(3))
    chosen = [known.where(F.col("label") == c).orderBy(order, "id").limit(max_rows) for c in (0, 1)]
    picked = F.broadcast(chosen[0].unionByName(chosen[1]).dropDuplicates(["id"]))  # 2 * max_rows rows at most
    found = own.join(picked, "id").groupBy("id", "label").agg(F.min(F.struct("text", "lang")).alias("d"))
    so_far = F.sum(F.octet_length("d.text")).over(Window.partitionBy("label").orderBy(order, "id"))
    sample = found.withColumn("bytes", so_far).where(F.col("bytes") <= max_bytes).repartition(1).sortWithinPartitions("id")
    made = sample.select("d.lang", "d.text", "label").mapInArrow(_fit(shares), "model binary").first()  # of fixed size
    return Model(**pickle.loads(made["model"])) if made else fit(pa.array([], pa.string()), np.zeros(0), np.zeros(0), [])


def score(docs: DataFrame, model: Model, text: str = "text", names: tuple[str, str] = ("score", "toxic")) -> DataFrame:
    """``docs`` with ``score`` (0 to 1, higher: more likely toxic) and ``toxic``, the verdict by the language's threshold.

    Whole texts are scored, null ones as empty. The two columns are called ``names``; columns of these names that ``docs`` has are
    replaced. Repeated rows are scored each; an empty table gives an empty one. A language without a threshold of its own has 0.7.
    """
    sent = docs.sparkSession.sparkContext.broadcast(vars(model))  # arrays of fixed size
    rest = docs.drop(*names)
    schema = T.StructType([*rest.schema.fields, T.StructField(names[0], T.DoubleType())])
    columns = rest.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(**sent.value)
        for batch in batches:
            column = batch.column(columns.index(text)).fill_null("")
            got = own.scores(*text_buffers(column))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(got, pa.float64())], [*columns, names[0]])

    scored = rest.mapInArrow(run, schema)
    line = F.lit(THRESHOLD)
    if "lang" in columns:
        for lang, t in sorted(model.thresholds.items()):
            line = F.when(F.coalesce("lang", F.lit("")) == lang, F.lit(t)).otherwise(line)
    return scored.withColumn(names[1], F.col(names[0]) >= line)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents by a model that never saw the held-out rows."""
    docs = table(spark, sf_dir, "documents")
    model = train(docs, table(spark, sf_dir, "labels"))
    scored = score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


QUERIES = {"op10_toxicity": query}
SQL: dict[str, str] = {}
