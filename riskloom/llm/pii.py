"""Personal data by bootstrapped contextual extraction (operator 11).

Base patterns find e-mail addresses, IP addresses, payment cards and phone
numbers.  They are the seeds.  Looser forms (an address with "(at)", an IPv6 or
defanged address, digits without a plus or a valid check digit) are candidates.

A pattern is a kind and the words before it: the last word and the white space
or marks (``: = # " ' >``) between it and the identifier, in lower case.  An
instance is the normalised identifier.  Patterns and instances are the two sides
of a graph, whose edges count how often an instance follows a pattern.  Spark
scores both sides in turns:

* the confidence of a pattern is the sum of the scores of what it extracts over
  all occurrences of its words in the corpus, and 0 unless ``SUPPORT`` known
  instances follow it;
* the score of an instance is 1 for a seed, else 1 minus the product of
  (1 - confidence) of the patterns of at least ``ACCEPT`` that it follows, and
  ``PRIOR`` as long as there is none, as it has at least the kind's form.

After ``ROUNDS`` every candidate whose instance reaches ``ACCEPT`` is a span: an
identifier that a trusted pattern introduces, or another form of a known one.

Words are counted exactly, over all texts, for patterns only: a bitmap of fixed
size tells tasks which words may matter, a join drops those that do not.

Defined results: a null text is empty; repeated rows have equal results; an
empty table gives no rows; candidates that overlap a base span are dropped, of
overlapping accepted ones that of the higher score stays (then the earlier kind,
then the earlier one); further columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import save

KINDS = ("email", "ip", "card", "phone")
SUPPORT, ACCEPT, PRIOR, ROUNDS = 3, 0.5, 0.5, 4
BITS = 22  # log2 of the bitmap's size: half a megabyte

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_HOST = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")  # a run of digits fails from all its places or none
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_AT = re.compile(r"(?: ?[(\[{]at[)\]}] ?| at )(?=[A-Za-z0-9-])", re.I)
_LOOSE_HOST = re.compile(r"[A-Za-z0-9-]+(?:(?:\.| ?[(\[{]dot[)\]}] ?| dot )[A-Za-z0-9-]+)+", re.I)
_DOT = re.compile(r" ?[(\[{]?dot[)\]}]? ?", re.I)
_V6 = re.compile(r"(?<![\w:.])[0-9A-Fa-f:]{4,39}(?![\w:])")
_DEFANGED = re.compile(r"(?<![\w.])[0-9]{1,3}(?:(?:\[\.\]|\(\.\)| ?[(\[]dot[)\]] ?)[0-9]{1,3}){3}(?!\w)", re.I)
_DIGITS = re.compile(r"(?<![\w+.-])[0-9](?:[ .-]?[0-9]){11,18}(?!\w)")
_CALL = re.compile(r"(?<![\w+.])(?:\([0-9]{1,5}\)[ -]?)?[0-9](?:[ ()./-]{0,2}[0-9]){6,14}(?!\w)")
_PAIR = re.compile(r"(?<![^\W\d_])([^\W\d_]++)([\s:=#\"'>]{1,6})")
_BEFORE = re.compile(r"(?<![^\W\d_])([^\W\d_]{1,40}+)([\s:=#\"'>]{1,6})\Z")
_SPACE = re.compile(r"\s+")


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    """Whether the check digit is right."""
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _before_at(text: str, at: int, low: int) -> int:
    """Where the run of local characters that ends at ``at`` starts, not before ``low``."""
    part = text[max(low, text.rfind("@", low, at) + 1):at]
    return at - (len(part) - len(part.rstrip(_LOCAL)))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the contract's four patterns, by kind and start."""
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        host = _HOST.match(text, at + 1)
        start = _before_at(text, at, end) if host else at
        if start < at:
            out.append((0, start, host.end()))
            end = host.end()
        at = text.find("@", max(at + 1, end))
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            out.append((1, *m.span()))
    for m in _CARD.finditer(text):
        d = _digits(m.group())
        if 16 <= len(d) <= 19 and luhn(d):
            out.append((2, *m.span()))
    for m in _PHONE.finditer(text):
        if 8 <= len(_digits(m.group())) <= 15:
            out.append((3, *m.span()))
    return out


def _address(s: str) -> str | None:
    from ipaddress import ip_address
    try:
        return ip_address(s).compressed
    except ValueError:
        return None


def candidates(text: str) -> list[tuple[int, int, int, str]]:
    """(kind, start, end, normalised) of the looser forms."""
    out, end = [], 0
    for m in _AT.finditer(text):
        host = _LOOSE_HOST.match(text, m.end())
        start = _before_at(text, m.start(), end) if host else m.start()
        if start < m.start():
            end = host.end()
            out.append((0, start, end, f"{text[start:m.start()]}@{_DOT.sub('.', host.group())}".lower()))
    for m in _V6.finditer(text):
        if m.group().count(":") > 1 and (a := _address(m.group())):
            out.append((1, *m.span(), a))
    for m in _DEFANGED.finditer(text):
        if a := _address(".".join(str(int(p)) for p in re.findall("[0-9]+", m.group()))):
            out.append((1, *m.span(), a))
    out += [(2, *m.span(), _digits(m.group())) for m in _DIGITS.finditer(text)]
    for m in _CALL.finditer(text):
        if 7 <= len(d := _digits(m.group())) <= 15:
            out.append((3, *m.span(), d))
    return out


def _normal(kind: int, s: str) -> str:
    if kind == 0:
        return s.lower()
    if kind == 1:
        return ".".join(p.lstrip("0") or "0" for p in s.split("."))
    return _digits(s)


def _words_before(text: str, start: int) -> str | None:
    m = _BEFORE.search(text[max(0, start - 48):start])
    return _key(*m.groups()) if m else None


def _key(word: str, gap: str) -> str:
    return word.lower() + _SPACE.sub(" ", gap)


def mentions(text: str | None) -> list[tuple]:
    """(kind, start, end, base, words before, normalised) of base spans and candidates."""
    if not text:
        return []
    base = base_spans(text)
    out = [(k, a, z, True, _words_before(text, a), _normal(k, text[a:z])) for k, a, z in base]
    taken = sorted((a, z) for _, a, z in base)
    loose = sorted(candidates(text), key=lambda x: x[1])
    high, at = 0, 0
    for k, a, z, name in loose:
        while at < len(taken) and taken[at][0] < z:
            high = max(high, taken[at][1])
            at += 1
        # spans that start before the end of a candidate; any of them that ends after its start overlaps
        if high <= a or not any(x < z and y > a for x, y in taken[:at]):
            out.append((k, a, z, False, _words_before(text, a), name))
    return out


MENTION = "struct<kind: int, start: long, stop: long, base: boolean, words: string, name: string>"


def scan(docs: DataFrame) -> DataFrame:
    """row (unique), doc_id and the mentions of every document."""
    kind = docs.schema["doc_id"].dataType
    item = pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("stop", pa.int64()), ("base", pa.bool_()),
                      ("words", pa.string()), ("name", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        row = TaskContext.get().partitionId() << 40
        for b in batches:
            found = [[dict(zip(("kind", "start", "stop", "base", "words", "name"), m)) for m in mentions(t.as_py())]
                     for t in b.column(1)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(row, row + b.num_rows), pa.int64()), b.column(0).cast(to_arrow_type(kind)),
                 pa.array(found, pa.list_(item))], names=["row", "doc_id", "mentions"])
            row += b.num_rows

    return docs.select("doc_id", "text").mapInArrow(
        run, f"row long, doc_id {kind.simpleString()}, mentions array<{MENTION}>")


def occurrences(docs: DataFrame, patterns: DataFrame) -> DataFrame:
    """words, occ: how often the words of patterns occur in all texts."""
    wanted = patterns.select("words").distinct()
    bit = F.crc32(F.col("words").cast("binary")) % (1 << BITS)
    cells = (wanted.select(bit.alias("bit")).groupBy((F.col("bit") / 32).cast("int").alias("cell"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit % 32 as int))")).alias("on")).collect())  # at most 2**17 rows
    bitmap = bytearray(1 << (BITS - 3))
    for r in cells:
        bitmap[4 * r.cell:4 * r.cell + 4] = r.on.to_bytes(4, "little")
    bitmap = bytes(bitmap)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count: Counter = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(count), pa.string()), pa.array(list(count.values()), pa.int64())],
                                             names=["words", "occ"])
            count.clear()
            return out

        for b in batches:
            for t in b.column(0):
                for (word, gap), n in Counter(_PAIR.findall(t.as_py() or "")).items():
                    if len(word) <= 40:
                        key = _key(word, gap)
                        at = crc32(key.encode("utf-8", "surrogatepass")) & ((1 << BITS) - 1)
                        if bitmap[at >> 3] >> (at & 7) & 1:
                            count[key] += n
            if len(count) > 100_000:
                yield flush()
        yield flush()

    got = docs.select("text").mapInArrow(run, "words string, occ long").groupBy("words").agg(F.sum("occ").alias("occ"))
    return got.join(wanted, "words", "left_semi")


def bootstrap(docs: DataFrame, found: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame]:
    """Scored instances (kind, name, score) and patterns (kind, words, confidence, known, occ)."""
    each = found.select("row", F.explode("mentions").alias("m")).select("row", "m.*")
    seen = each.groupBy("kind", "name").agg(F.max("base").alias("seed"))
    edges = (each.filter("words is not null").groupBy("kind", "words", "name").agg(F.count("*").alias("n"))
             .join(seen, ["kind", "name"]))
    edges = save(edges, "pii-edges")
    several = edges.groupBy("kind", "words").agg(F.count("*").alias("names"), F.sum("n").alias("hits")).filter(
        F.col("names") >= SUPPORT)
    several = save(several, "pii-several")
    # what a pattern extracts bounds its confidence: words that mostly precede something else go
    patterns = (several.join(occurrences(docs, several), "words").filter(F.col("hits") >= ACCEPT * (F.col("occ") + 1))
                .select("kind", "words", "occ"))
    graph = save(edges.join(patterns, ["kind", "words"]), "pii-graph")
    scores = graph.select("kind", "name", "seed").distinct().withColumn(
        "score", F.when(F.col("seed"), F.lit(1.0)).otherwise(F.lit(PRIOR))).withColumn("known", F.col("seed"))
    confidence = None
    for _ in range(rounds):
        confidence = save(graph.select("kind", "words", "name", "n", "occ").join(scores, ["kind", "name"])
                          .groupBy("kind", "words", "occ").agg(F.sum(F.col("n") * F.col("score")).alias("s"),
                                                               F.count_if("known").alias("known"))
                          .select("kind", "words", "occ", "known",
                                  F.when(F.col("known") >= SUPPORT, F.col("s") / (F.col("occ") + 1)).otherwise(0.0)
                                  .alias("confidence")), "pii-patterns")
        trusted = confidence.filter(F.col("confidence") >= ACCEPT).select("kind", "words", "confidence")
        doubt = F.sum(F.when(F.col("confidence").isNotNull(), F.log1p(-F.col("confidence"))))  # confidence < 1
        scores = save(graph.join(trusted, ["kind", "words"], "left").groupBy("kind", "name", "seed").agg(doubt.alias("d"))
                      .select("kind", "name", "seed", F.when(F.col("seed"), F.lit(1.0)).when(F.col("d").isNull(), F.lit(PRIOR))
                              .otherwise(1 - F.exp("d")).alias("score"), (F.col("seed") | F.col("d").isNotNull()).alias("known")),
                      "pii-scores")
    named = seen.filter("seed").select("kind", "name", F.lit(1.0).alias("score"))
    more = scores.filter(~F.col("seed") & F.col("known") & (F.col("score") >= ACCEPT)).select("kind", "name", "score")
    return named.unionByName(more), confidence


def find(docs: DataFrame) -> DataFrame:
    """doc_id, base and found (arrays of kind, start, stop; found with its score) of every document."""
    found = save(scan(docs), "pii-mentions")
    accepted, _ = bootstrap(docs, found)
    loose = (found.select("row", F.explode(F.filter("mentions", lambda m: ~m["base"])).alias("m")).select("row", "m.*")
             .join(accepted, ["kind", "name"]).groupBy("row")
             .agg(F.collect_list(F.struct("score", "kind", "start", "stop")).alias("extra")))  # one document's
    base = F.transform(F.filter("mentions", lambda m: m["base"]),
                       lambda m: F.struct(m["kind"].alias("kind"), m["start"].alias("start"), m["stop"].alias("stop")))
    return (found.select("row", "doc_id", base.alias("base")).join(loose, "row", "left_outer")
            .select("doc_id", "base", F.coalesce("extra", F.array().cast("array<struct<score:double,kind:int,start:long,stop:long>>"))
                    .alias("extra")))


def _apart(extra: list[dict]) -> list[tuple[int, int, int]]:
    """Accepted candidates without overlaps: the best score first, then the earlier kind and place."""
    from bisect import bisect
    kept: list[tuple[int, int, int]] = []  # start, stop, kind; sorted, apart
    for x in sorted(extra, key=lambda x: (-x["score"], x["kind"], x["start"])):
        at = bisect(kept, (x["start"],))
        if (at == len(kept) or kept[at][0] >= x["stop"]) and (at == 0 or kept[at - 1][1] <= x["start"]):
            kept.insert(at, (x["start"], x["stop"], x["kind"]))
    return [(k, a, z) for a, z, k in kept]


def digests(spans: DataFrame) -> DataFrame:
    """The counts, digest and list of spans of every document, from ``find``."""
    kind = spans.schema["doc_id"].dataType

    def said(rows: list[tuple[int, int, int]]) -> str:
        return ",".join(f"{KINDS[k]}:{a}:{z}" for k, a, z in rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from hashlib import sha256
        for b in batches:
            rows = []
            for base, extra in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                base = [(x["kind"], x["start"], x["stop"]) for x in base]
                count = Counter(k for k, _, _ in base)
                rows.append((*[count[k] for k in range(4)], sha256(said(base).encode()).hexdigest(),
                             said(sorted([*base, *_apart(extra)]))))
            cols = list(zip(*rows)) or [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [b.column(0).cast(to_arrow_type(kind)), *[pa.array(c, pa.int64()) for c in cols[:4]],
                 *[pa.array(c, pa.string()) for c in cols[4:]]],
                names=["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans"])

    return spans.mapInArrow(run, f"doc_id {kind.simpleString()}, " + ", ".join(f"n_{k} long" for k in KINDS)
                            + ", base_sha256 string, spans string")


__all__ = ["KINDS", "base_spans", "bootstrap", "candidates", "digests", "find", "luhn", "mentions", "occurrences", "scan"]
