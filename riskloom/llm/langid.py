"""Language identification by nearest centroid (operator 1).

A text becomes counts of its character 1-, 2- and 3-grams (lower-cased
letters; everything else is a word boundary), hashed to ``BUCKETS`` with a
sign, so that collisions cancel out and texts without common grams have a
cosine near 0.  Counts are weighed, square root times inverse document
frequency, and normalised.
Each language has ``CLUSTERS`` centroids, found by spherical k-means; a text
gets the language of the centroid with the largest cosine.  It is rejected if
that cosine is below the limit for texts of its length.  Limits lie between
the cosines of known and of unknown texts of that length, three quarters of
the way up: the least that all but one in ``TAIL`` of the training texts reach
with centroids of the other half of them, and the most that unknown texts do (training texts without the
centroids of their language, all but one in ``FOREIGN``, and noise of their
letters, all but one in 100).  Where these overlap, the limit is that of the
known texts.  Besides whole texts, beginnings of them of all shorter lengths
take part; a length class with few examples uses the classes around it, and a
small table all it has; without any text to compare (no language has rows in
both halves) no limit is set.

Document frequencies cover all training rows (labelled and not held out).
The clustering and the limits are fitted on a bounded sample of them: at most
``PER_LANGUAGE`` rows a language and about ``ALL_ROWS`` rows in all, but
``LEAST_ROWS`` rows of every language (one at least has a letter, if any
has), chosen by a hash of the document number, counts of grams only (sparse),
on the driver.  Every language is learned; the sample grows with their number.

Defined results: a null text and one without a letter is ``und`` with score 0
and rejected; without any training row every text is ``und``; repeated rows
and ties are predicted alike (ties: first language by code point); further
columns are ignored (``filter_language`` passes them through).
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import remainder, trim_memory, worker_cache

BUCKETS, CLUSTERS = 8192, 4
PER_LANGUAGE, ALL_ROWS, LEAST_ROWS = 1000, 8000, 16
TAIL, FOREIGN, EXAMPLES, PIECES = 200, 20, 30, 2000
UNKNOWN = "und"


def _letters():
    """One bit for each code point: whether it is a letter."""
    import numpy as np
    return np.packbits(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))


class Grams:
    """Hashed gram counts of a text."""

    def __init__(self, packed, buckets: int = BUCKETS):
        import numpy as np
        self.letter = np.unpackbits(packed).astype(bool)
        self.buckets = buckets
        self.shift = np.uint32(32 - (buckets - 1).bit_length())

    def count(self, text: str):
        """Signed counts by bucket and number of letters; None without a letter."""
        import numpy as np
        c = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
        on = self.letter[c]
        n = int(on.sum())
        if not n:
            return None, 0
        keep = on.copy()
        keep[1:] |= on[:-1]  # one boundary after each word
        c = np.concatenate([[np.uint32(0)], np.where(on, c, np.uint32(0))[keep], [np.uint32(0)]]).astype(np.uint32)
        a = c * np.uint32(2654435761)
        b = a[:-1] * np.uint32(31) + a[1:] + np.uint32(977)
        t = b[:-1] * np.uint32(40503) + a[2:] + np.uint32(7919)
        got = np.zeros(self.buckets, np.int64)
        for h in (a[c > 0], b, t):
            h = (h ^ (h >> np.uint32(15))) * np.uint32(2246822519)
            at, sign = h >> self.shift, (h ^ (h >> np.uint32(13))) * np.uint32(3266489917) >> np.uint32(31)
            got += np.bincount(at, 1.0 - 2.0 * sign, self.buckets).astype(np.int64)
        return got, n


def _weigh(counts, idf):
    import numpy as np
    v = (np.sign(counts) * np.sqrt(np.abs(counts))).astype(np.float32) * idf
    return v / np.maximum(np.sqrt((v * v).sum(-1, keepdims=True)), 1e-9)


def _kmeans(x, k: int, rounds: int = 12):
    """Centroids of unit rows; starts far apart, in a fixed way."""
    import numpy as np
    first = x.mean(0)
    centre = [x[int(np.argmax(x @ first))]]
    while len(centre) < min(k, len(x)):
        centre.append(x[int(np.argmin(np.max(x @ np.array(centre).T, axis=1)))])
    centre = np.array(centre)
    for _ in range(rounds):
        near = np.argmax(x @ centre.T, axis=1)
        new = np.array([x[near == j].sum(0) if (near == j).any() else centre[j] for j in range(len(centre))])
        centre = new / np.maximum(np.sqrt((new * new).sum(1, keepdims=True)), 1e-9)
    return centre


def _size(letters):
    """Length class of a text: doublings of its letters."""
    import numpy as np
    return np.log2(np.maximum(letters, 1)).astype(int)


def _piece_and_noise(text: str, letter):
    """The beginning of a text, of a length class by its hash, and as many random ones of its letters."""
    import zlib
    import numpy as np
    seed = zlib.crc32(text.encode("utf-8", "surrogatepass"))
    c = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    place = np.flatnonzero(letter[c])
    cut = int(1.5 * 2 ** (seed % (int(np.log2(len(place))) + 1)))
    piece = c[:place[cut - 1] + 1] if cut < len(place) else c
    known = np.unique(c[place])
    noise = None
    if len(known) >= 10:  # fewer letters make words of the language
        noise, on = piece.copy(), letter[piece]
        noise[on] = np.random.default_rng(seed).choice(known, int(on.sum()))
    return [None if x is None else x.tobytes().decode("utf-32-le", "surrogatepass") for x in (piece, noise)]


def _limits(by: dict[str, list], noise: list, idf, buckets: int, clusters: int):
    """Limit of each length class, from halves of the sample and from noise."""
    import numpy as np

    def cosines(some: list, centres):
        out = [np.zeros((0, len(centres)), np.float32)]
        for a in range(0, len(some), 128):
            out.append(_weigh(_dense(some[a:a + 128], buckets), idf) @ centres.T)
        return np.concatenate(out)

    known, foreign = [], []  # cosine and length class
    random = [np.zeros((0, 2))]
    for half in (0, 1):
        names, centres = [], []
        for lang, rows in by.items():
            some = [r for r in rows if r[3] == half and not r[4]]
            if some:
                c = _kmeans(_weigh(_dense(some, buckets), idf), clusters)
                names += [lang] * len(c)
                centres.append(c)
        if not names:
            continue
        centres, names = np.concatenate(centres), np.array(names)
        for lang, rows in by.items():
            some = [r for r in rows if r[3] != half]
            cos, size = cosines(some, centres), _size(np.array([r[0] for r in some], int))
            own = names == lang
            if own.any():
                known += zip(cos.max(1).tolist(), size.tolist())
            if not own.all():
                foreign += zip(cos[:, ~own].max(1).tolist(), size.tolist())
        if noise:
            random.append(np.column_stack([cosines(noise, centres).max(1), _size(np.array([r[0] for r in noise]))]))
    known, foreign, random = np.array(known).reshape(-1, 2), np.array(foreign).reshape(-1, 2), np.concatenate(random)
    limit = np.zeros(64)
    if not len(known):
        return limit

    def near(x, k: int):
        width = next((w for w in range(64) if (np.abs(x[:, 1] - k) <= w).sum() >= EXAMPLES), 64)
        return np.sort(x[np.abs(x[:, 1] - k) <= width, 0])

    for k in range(64):
        at = near(known, k)
        least, most = at[len(at) // TAIL], 0.0
        for x, one_in in ((foreign, FOREIGN), (random, 100)):
            if len(x):
                at = near(x, k)
                most = max(most, at[-1 - len(at) // one_in])
        limit[k] = least - max(0.0, least - most) / 4
    return limit


def _half(idx) -> int:
    import zlib
    return zlib.crc32(idx.tobytes()) & 1


def _dense(some: list, buckets: int):
    import numpy as np
    x = np.zeros((len(some), buckets), np.float32)
    for i, r in enumerate(some):
        x[i, r[1]] = r[2]
    return x


def train(rows: DataFrame, buckets: int = BUCKETS, clusters: int = CLUSTERS) -> dict | None:
    """Fit on rows with text and lang (doc_id orders the sample)."""
    import numpy as np
    rows = rows.filter("lang is not null and text is not null").select("doc_id", "text", "lang")
    scale = 1 << 30
    draw = F.pmod(F.xxhash64("doc_id", F.lit("langid")), F.lit(scale))
    sizes = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("count"), F.min(
        F.when(F.col("text").rlike(r"\p{L}"), draw)).alias("first")).collect()  # a row a language
    if not sizes:
        return None
    each = max(LEAST_ROWS, min(PER_LANGUAGE, ALL_ROWS // len(sizes)))
    share = rows.sparkSession.createDataFrame(
        [(r["lang"], max(int(min(1.0, each / r["count"]) * scale), (r["first"] or 0) + 1)) for r in sizes],
        "lang string, share long")
    packed = _letters()
    kind = "idx array<int>, cnt array<int>, lang string, letters long, part string, df binary"
    pieces = max(1, -(-sum(min(each, r["count"]) for r in sizes) // PIECES))  # one in so many sampled rows gives them

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, df = Grams(packed, buckets), np.zeros(buckets, np.int64)
        table = lambda x: pa.RecordBatch.from_pylist(x, schema=pa.schema(
            [("idx", pa.list_(pa.int32())), ("cnt", pa.list_(pa.int32())), ("lang", pa.string()),
             ("letters", pa.int64()), ("part", pa.string()), ("df", pa.binary())]))
        for b in batches:
            out = []
            for text, lang, drawn, cut in zip(*(c.to_pylist() for c in b.columns)):
                got, n = grams.count(text)
                if got is None:
                    continue
                df += got != 0
                parts = [("whole", got, n)] if drawn else []
                if drawn and cut:
                    made = zip(("piece", "noise"), _piece_and_noise(text, grams.letter))
                    parts += [(p, *grams.count(t)) for p, t in made if t is not None]
                for part, got, n in parts:
                    if got is not None:
                        i = np.flatnonzero(got)
                        out.append({"idx": i.tolist(), "cnt": got[i].tolist(), "lang": lang, "letters": n,
                                    "part": part, "df": None})
            if out:
                yield table(out)
        yield table([{"idx": None, "cnt": None, "lang": None, "letters": None, "part": None, "df": df.tobytes()}])

    from .common import save
    got = save(rows.join(share, "lang")  # a local table of a row a language
               .select("text", "lang", (draw < F.col("share")).alias("drawn"),
                       (F.pmod(F.xxhash64("doc_id", F.lit("piece")), F.lit(pieces)) == 0).alias("cut"))
               .mapInArrow(run, kind), "langid-sample")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for b in batches:
            for x in b.column(0).to_pylist():
                total += np.frombuffer(x, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["df"])

    # one row of sums for each of at most 32 tasks reaches the driver
    sums = got.filter("df is not null").select("df").coalesce(32).mapInArrow(add, "df binary").collect()
    df = sum((np.frombuffer(r.df, np.int64) for r in sums), np.zeros(buckets, np.int64))
    documents = sum(r["count"] for r in sizes)
    idf = np.log((1 + documents) / (1 + df)).astype(np.float32) + np.float32(1e-3)
    centres, names, noise = [], [], []
    by: dict[str, list] = {r["lang"]: [] for r in sorted(sizes, key=lambda r: r["lang"])}
    for r in got.filter("lang is not null").select("idx", "cnt", "lang", "letters", "part").toLocalIterator():
        x = (r.letters, np.array(r.idx, np.int32), np.array(r.cnt, np.int32))
        if r.part == "noise":
            noise.append(x)
        else:
            by[r.lang].append((*x, r.part == "piece"))
    for lang, some in by.items():  # letters, buckets, counts, half, whether a piece
        some = sorted(some, key=lambda t: (t[3], t[0], t[1].tobytes(), t[2].tobytes()))
        by[lang] = [(*t[:3], _half(t[1]), t[3]) for t in some]
        whole = [t for t in by[lang] if not t[4]]
        if whole:
            c = _kmeans(_weigh(_dense(whole, buckets), idf), clusters)
            centres.append(c)
            names += [lang] * len(c)
    if not names:
        return None
    limit = _limits(by, noise, idf, buckets, clusters)
    del by, noise
    trim_memory()
    return {"idf": idf, "centres": np.concatenate(centres).astype(np.float32), "names": names,
            "limit": limit, "packed": packed, "buckets": buckets}


def _predictor(model: dict | None):
    """A function from texts to (language, score, rejected) lists."""
    import numpy as np
    if model is None:
        return lambda texts: ([UNKNOWN] * len(texts), [0.0] * len(texts), [True] * len(texts))
    grams = Grams(model["packed"], model["buckets"])

    def predict(texts: list):
        lang, score, out = [UNKNOWN] * len(texts), [0.0] * len(texts), [True] * len(texts)
        for a in range(0, len(texts), 256):
            at, rows, letters = [], [], []
            for i in range(a, min(a + 256, len(texts))):
                got, n = grams.count(texts[i]) if texts[i] else (None, 0)
                if got is not None:
                    at.append(i), rows.append(got), letters.append(n)
            if not at:
                continue
            cos = _weigh(np.array(rows), model["idf"]) @ model["centres"].T
            best = cos.argmax(1)
            top = cos[np.arange(len(at)), best]
            low = top < model["limit"][_size(np.array(letters))]
            for i, j, c, r in zip(at, best.tolist(), top.tolist(), low.tolist()):
                lang[i], score[i], out[i] = model["names"][j], min(1.0, max(0.0, c)), r
        return lang, score, out

    return predict


def predict(docs: DataFrame, model: dict | None) -> DataFrame:
    """doc_id, lang_pred, score, rejected of every document."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_cache().clear()  # what a worker keeps for other operators
        f = None
        for b in batches:
            f = f or _predictor(model)
            lang, score, out = f(b.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(out, pa.bool_())],
                names=["doc_id", "lang_pred", "score", "rejected"])

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, lang_pred string, score double, rejected boolean")


def filter_language(docs: DataFrame, model: dict | None) -> DataFrame:
    """The rows of ``docs``, all columns, whose language is not rejected."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_cache().clear()  # what a worker keeps for other operators
        f = None
        for b in batches:
            f = f or _predictor(model)
            out = f(b.column(at).to_pylist())[2]
            yield b.filter(pa.array([not x for x in out], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(remainder(doc_id, 4) == 2, F.lit(False))


__all__ = ["filter_language", "held_out", "predict", "train"]
