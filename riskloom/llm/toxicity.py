"""Toxicity by averaged subword embeddings and a linear softmax (operator 9).

A word (a run without white space, lower-cased, outer punctuation cut) is a
bag of the character 3- to 5-grams of ``<word>`` and the word itself, hashed
to ``BUCKETS`` vectors.  A word is the mean of its bag, a window of ``WINDOW``
words the mean of its words, and a linear softmax over that mean gives the
window's class.  Vectors and softmax are trained together (numpy, Adagrad).
Misspelt and unseen words share most of their grams, and so their vectors,
with known ones.

A few toxic words in a long text would vanish in one mean, so a document
scores as its highest window; training takes the highest window of each
document in the round (all of a document's windows in the first).  At the end
the softmax is calibrated on documents by Platt's method, half way from the sample's
shares of the classes to those among all labels.

A window's logit is a mean of one number a word, so scoring keeps that number
for words it has seen and needs no vectors for them.

The fit uses a bounded sample: at most ``PER_CLASS`` labelled rows a class,
chosen by a hash of the document number, of at most ``FIT_CHARS`` characters.
Scoring reads whole texts.

Defined results: null and empty texts score as a text without words (the
calibrated score of logit ``EMPTY``); with no label of one class every score
is 0; repeated rows score alike; null labels take no part; of several labels
for one document the highest counts; further columns are ignored
(``filter_toxic`` passes them through).
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import remainder, trim_memory, worker_cache

BUCKETS, DIM, WINDOW = 1 << 16, 8, 12
PER_CLASS, FIT_CHARS, ROUNDS, SEED = 1500, 20_000, 6, 11
MEMO, EMPTY = 400_000, -8.0
EDGE = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~«»“”„…"


def split(text: str) -> list[str]:
    return text.lower().split()


def grams(words: list[str], buckets: int = BUCKETS):
    """Bucket of each gram and the place of its word in ``words``."""
    import numpy as np
    marked = ["<" + (w.strip(EDGE) or w) + ">" for w in words]
    c = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint32)
    size = np.array([len(w) for w in marked])
    word = np.repeat(np.arange(len(words)), size)
    end = np.repeat(np.cumsum(size), size)
    h = np.zeros(len(c), np.uint32)
    shift = np.uint32(32 - (buckets - 1).bit_length())
    out, at = [], []
    mix = lambda x: ((x ^ (x >> np.uint32(15))) * np.uint32(2246822519)) >> shift
    for n in range(1, 6):
        m = len(c) - n + 1
        if m <= 0:
            break
        h = h[:m] * np.uint32(16777619) + c[n - 1:] * np.uint32(2654435761) + np.uint32(n)
        if n >= 3:
            on = np.arange(m) + n <= end[:m]
            out.append(mix(h[on])), at.append(word[:m][on])
    # the word itself: a sum over its characters by place
    start = np.cumsum(size) - size
    power = (np.arange(len(c)) - np.repeat(start, size)).astype(np.uint32) * np.uint32(40503) + np.uint32(1)
    whole = np.add.reduceat(c * np.uint32(2654435761) * (power | np.uint32(1)), start).astype(np.uint32)
    out.append(mix(whole)), at.append(np.arange(len(words)))
    return np.concatenate(out).astype(np.int64), np.concatenate(at)


def word_values(words: list[str], vectors, direction):
    """Mean over each word's grams of vector times direction."""
    import numpy as np
    value = vectors @ direction
    out = np.zeros(len(words))
    for a in range(0, len(words), 20_000):
        some = words[a:a + 20_000]
        g, at = grams(some, len(value))
        out[a:a + len(some)] = np.bincount(at, value[g], len(some)) / np.bincount(at, minlength=len(some))
    return out


def window_means(values, window: int = WINDOW):
    """Means of each run of ``window`` numbers (one mean if there are fewer).

    A number that occurs among the ``window`` - 1 before it adds nothing: a
    word that a text repeats over and over counts once.
    """
    import numpy as np
    n = len(values)
    again = np.zeros(n, bool)
    for k in range(1, min(window, n)):
        again[k:] |= values[k:] == values[:-k]
    values = np.where(again, 0.0, values)
    if n <= window:
        return np.array([values.sum() / max(n, window // 2)])
    total = np.concatenate([[0.0], np.cumsum(values)])
    return (total[window:] - total[:-window]) / window


def fit(texts: list[str], labels: list[int], odds: float = 1.0) -> dict | None:
    """Vectors, softmax and calibration from bounded lists.

    Half the log of ``odds`` is added to the calibrated margins; ``train``
    chooses it so that half the log odds of all its labels count, however
    many of each class were drawn.
    """
    import numpy as np
    y = np.array(labels, float)
    if not len(y) or y.min() == y.max():
        return None
    rng = np.random.default_rng(SEED)
    vocab: dict[str, int] = {}
    ids = [np.array([vocab.setdefault(w, len(vocab)) for w in split(t)], np.int32) for t in texts]
    words = list(vocab)
    del vocab
    if not words:
        return None
    parts, counts = [], []  # each word's grams, side by side
    for a in range(0, len(words), 20_000):
        some = words[a:a + 20_000]
        g, at = grams(some)
        parts.append(g[np.argsort(at, kind="stable")].astype(np.int32))
        counts.append(np.bincount(at, minlength=len(some)))
    gram, count = np.concatenate(parts), np.concatenate(counts)
    del words, parts, counts
    first = np.concatenate([[0], np.cumsum(count)])
    vectors = rng.uniform(-1, 1, (BUCKETS, DIM)) / DIM
    softmax = np.zeros((DIM, 2))
    bias = np.zeros(2)
    sum_v, sum_s, sum_b = np.full((BUCKETS, DIM), 1e-6), np.full((DIM, 2), 1e-6), np.full(2, 1e-6)
    softmax[0, 1], softmax[0, 0] = 0.1, -0.1

    def values():
        v = vectors @ (softmax[:, 1] - softmax[:, 0])
        return np.add.reduceat(v[gram], first[:-1]) / count

    def step(windows: list, target, rate: float) -> None:
        # the grams of a batch of windows, each weighed by its share of the window's mean
        size = np.array([len(w) for w in windows])
        flat = np.concatenate(windows)
        row = np.repeat(np.arange(len(windows)), size)
        n = count[flat]
        start = np.repeat(first[flat] - (np.cumsum(n) - n), n)
        g = gram[start + np.arange(int(n.sum()))]
        r = np.repeat(row, n)
        w = np.repeat(1.0 / (n * np.maximum(size, WINDOW // 2)[row]), n)
        mean = np.stack([np.bincount(r, w * vectors[g, k], len(windows)) for k in range(DIM)], 1)
        z = mean @ softmax + bias
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        e = p.copy()
        e[np.arange(len(windows)), target] -= 1
        weight = np.where(target == 1, 0.5 / max(1, (target == 1).sum()), 0.5 / max(1, (target == 0).sum()))
        e *= (weight * len(windows))[:, None]
        back = e @ softmax.T
        used, place = np.unique(g, return_inverse=True)
        grad = np.stack([np.bincount(place, w * back[r, k], len(used)) for k in range(DIM)], 1)
        for x, d, acc in ((softmax, mean.T @ e / len(windows), sum_s), (bias, e.mean(0), sum_b)):
            acc += d * d
            x -= rate * d / np.sqrt(acc)
        sum_v[used] += grad * grad
        vectors[used] -= rate * grad / np.sqrt(sum_v[used])

    for k in range(ROUNDS):
        value = values()
        chosen, target = [], []
        for d, label in zip(ids, y.astype(int)):
            if not len(d):
                continue
            mean = window_means(value[d])
            if k == 0:  # some of its windows, spread over the text
                at = rng.choice(len(mean), min(4, len(mean)), replace=False)
            else:
                best = int(np.argmax(mean))
                at = [best] if label else [best, int(rng.integers(len(mean)))]
            for i in at:
                chosen.append(np.unique(d[i:i + WINDOW])), target.append(label)
        target = np.array(target)
        for _ in range(3 if k else 6):
            for part in np.array_split(rng.permutation(len(chosen)), max(1, len(chosen) // 512)):
                step([chosen[i] for i in part], target[part], 0.3)
    value = values()
    top = np.array([window_means(value[d]).max() if len(d) else EMPTY for d in ids]) + bias[1] - bias[0]
    # Platt's method, with his targets; documents weigh as drawn
    pos = y.sum()
    t = np.where(y == 1, (pos + 1) / (pos + 2), 1 / (len(y) - pos + 2))
    mu, sd = top.mean(), top.std() + 1e-9
    u, a, b = (top - mu) / sd, 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * u + b, -30, 30)))
        s = np.maximum(p * (1 - p), 1e-6)
        g = np.array([((p - t) * u).sum() + 1e-3 * a, (p - t).sum()])
        h = np.array([[(s * u * u).sum() + 1e-3, (s * u).sum()], [(s * u).sum(), s.sum()]])
        move = np.linalg.solve(h, g)
        a, b = a - np.clip(move[0], -2, 2), b - np.clip(move[1], -2, 2)
    a = max(a, 1e-3)
    return {"value": (vectors @ (softmax[:, 1] - softmax[:, 0])).astype(np.float32),
            "bias": float(bias[1] - bias[0]), "a": float(a / sd),
            "b": float(b - a * mu / sd + 0.5 * np.log(max(odds, 1e-6)))}


def train(docs: DataFrame, labels: DataFrame, target: str = "toxic") -> dict | None:
    """Fit on a bounded sample of the documents that have a label."""
    marks = (labels.filter(F.col(target).isNotNull() & F.col("doc_id").isNotNull())
             .groupBy(F.col("doc_id").alias("l_id")).agg((F.max(target) > 0).cast("int").alias("l_y")))
    sizes = {r.l_y: r["count"] for r in marks.groupBy("l_y").count().collect()}
    scale = 1 << 30
    share = [int(min(1.0, PER_CLASS / max(1, sizes.get(k, 0))) * scale) for k in (0, 1)]
    drawn = F.pmod(F.xxhash64("l_id", F.lit("toxic")), F.lit(scale))
    few = marks.filter(drawn < F.when(F.col("l_y") == 1, share[1]).otherwise(share[0]))
    rows = (docs.filter(F.col("text").isNotNull() & (F.length("text") <= FIT_CHARS)).select("doc_id", "text")
            .join(few, F.col("doc_id") == F.col("l_id"), "inner").select("doc_id", "text", "l_y")
            .groupBy("doc_id", "l_y").agg(F.min("text").alias("text")))
    got = sorted((r.doc_id, r.l_y, r.text) for r in rows.toLocalIterator())
    y = [y for _, y, _ in got]
    few1, few0 = sum(y), len(y) - sum(y)
    # half the log odds of all labels count, in place of the sample's own, whatever the table's size
    odds = sizes.get(1, 0) / max(1, sizes.get(0, 0)) * (few0 / max(1, few1)) ** 2
    model = fit([t for *_, t in got], y, odds)
    del got
    trim_memory()
    return model


def _scorer(model: dict | None):
    """A function from texts to scores."""
    import numpy as np
    if model is None:
        return lambda texts: [0.0] * len(texts)
    value, one, kept = model["value"].astype(np.float64), np.ones(1), {}

    def score(texts: list) -> list[float]:
        out = []
        for a in range(0, len(texts), 64):
            cut = [split(t or "") for t in texts[a:a + 64]]
            new = [x for x in set().union(*cut) if x not in kept]
            if len(kept) + len(new) > MEMO:
                kept.clear()
                new = list(set().union(*cut))
            if new:
                kept.update(zip(new, word_values(new, value[:, None], one).tolist()))
            for w in cut:
                z = EMPTY
                if w:
                    z = window_means(np.fromiter(map(kept.__getitem__, w), float, len(w))).max()
                z = model["a"] * (z + model["bias"]) + model["b"]
                out.append(float(1 / (1 + np.exp(-np.clip(z, -40, 40)))))
        return out

    return score


def predict(docs: DataFrame, model: dict | None) -> DataFrame:
    """doc_id, score, predicted of every document."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_cache().clear()  # what a worker keeps for other operators
        f = None
        for b in batches:
            f = f or _scorer(model)
            s = f(b.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(s, pa.float64()), pa.array([int(x >= 0.5) for x in s], pa.int32())],
                names=["doc_id", "score", "predicted"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double, predicted int")


def filter_toxic(docs: DataFrame, model: dict | None) -> DataFrame:
    """The rows of ``docs``, all columns, that are not predicted toxic."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_cache().clear()  # what a worker keeps for other operators
        f = None
        for b in batches:
            f = f or _scorer(model)
            yield b.filter(pa.array([x < 0.5 for x in f(b.column(at).to_pylist())], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(remainder(doc_id, 5) == 0, F.lit(False))


__all__ = ["filter_toxic", "fit", "held_out", "predict", "train"]
