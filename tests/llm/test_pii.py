"""Personal data: base patterns against the contract's expressions, bootstrapping on planted patterns."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from riskloom.llm import pii

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string"
PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
            "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+",
            "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def passes(kind, s):
    d = re.sub("[^0-9]", "", s)
    if kind == "ip":
        return all(int(p) <= 255 for p in s.split("."))
    if kind == "card":
        twice = [int(c) * (1 + k % 2) for k, c in enumerate(d[::-1])]
        return 16 <= len(d) <= 19 and sum(x // 10 + x % 10 for x in twice) % 10 == 0
    return kind == "email" or 8 <= len(d) <= 15


def brute_base(text):
    return [(k, m.start(), m.end()) for k, p in PATTERNS.items() for m in re.finditer(p, text or "") if passes(k, m.group())]


def test_base_spans_against_the_expressions():
    rng = random.Random(2)
    parts = ["a", "b@", "@", ".", "..", "1", "25", "255", "256", "0300", "+", "+1", "(", ")", "-", " ", "4111111111111111", "é",
             "x.y", "@c.de", "12.3.4.5", "\U0001f600", "_", "%", "４", "4000 0000 0000 0002", "555-1234"]
    for _ in range(4000):
        t = "".join(rng.choices(parts, k=rng.randint(0, 25)))
        assert [(pii.KINDS[k], a, z) for k, a, z in pii.base_spans(t)] == brute_base(t), t


@pytest.mark.parametrize("piece", ["a", "1", "1.", "a@", "@b.c", "1 ", "+1", "a at b", "(1)", ":", "tel: ", "é", "1-", "a.b@c.d "])
def test_long_texts_take_linear_time(piece):
    pii.mentions(piece * (200_000 // len(piece)))
    pii._PAIR.findall(piece * (200_000 // len(piece)))


def test_query_base_columns(spark):
    got = E.queries()["op11_bootstrapped_pii"](spark, SF).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert len(got) == len(docs) > 0
    for r in got:
        base = brute_base(docs[r.doc_id])
        n = Counter(k for k, _, _ in base)
        said = [f"{k}:{a}:{z}" for k, a, z in base]
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(n[k] for k in pii.KINDS)
        assert r.base_sha256 == hashlib.sha256(",".join(said).encode()).hexdigest()
        assert set(said) <= set(filter(None, r.spans.split(",")))


def brute_scores(texts, rounds=pii.ROUNDS):
    """Accepted names by plain dictionaries over all mentions and all pairs of words and gap."""
    edges, seeds, seen = Counter(), set(), set()
    for t in texts:
        for k, _, _, base, before, name in pii.mentions(t):
            seen.add((k, name))
            if base:
                seeds.add((k, name))
            if before:
                edges[k, before, name] += 1
    occ = Counter()
    for t in texts:
        for m in re.finditer(r"(?<![^\W\d_])([^\W\d_]+)([\s:=#\"'>]{1,6})", t or ""):
            occ[m[1].lower() + re.sub(r"\s+", " ", m[2])] += 1
    score = {e: 1.0 if e in seeds else pii.PRIOR for e in seen}
    known = set(seeds)
    trusted = {}
    for _ in range(rounds):
        total, support = defaultdict(float), Counter()
        for (k, w, name), n in edges.items():
            total[k, w] += n * score[k, name]
            support[k, w] += (k, name) in known
        trusted = {p: s / (occ[p[1]] + 1) for p, s in total.items()
                   if support[p] >= pii.SUPPORT and s / (occ[p[1]] + 1) >= pii.ACCEPT}
        doubt = defaultdict(lambda: 1.0)
        for (k, w, name) in edges:
            if (k, w) in trusted:
                doubt[k, name] *= 1 - trusted[k, w]
        score = {e: 1.0 if e in seeds else 1 - doubt[e] if e in doubt else pii.PRIOR for e in seen}
        known = seeds | set(doubt)
    return {e: s for e, s in score.items() if e in known and s >= pii.ACCEPT}, trusted


@pytest.fixture(scope="module")
def planted():
    rng = random.Random(9)
    number = lambda n: "".join(rng.choice("123456789") for _ in range(n))
    plain = ["the", "order", "of", "weiß", "and", "total", "version"]
    words = lambda n: " ".join(rng.choice(plain) for _ in range(n))
    docs = []
    for i in range(120):
        kind = i % 6
        if kind == 0:
            docs.append(f"{words(9)} Tel: +49 {number(9)}, {words(4)}")
        elif kind == 1:
            docs.append(f"{words(5)} tel: 0{number(3)} {number(6)} {words(4)}")
        elif kind == 2:
            docs.append(f"{words(3)} mail: u{i}@h.example.org {words(2)} call 0{number(8)} {words(3)}")
        elif kind == 3:
            docs.append(f"{words(3)} mail: u{i} (at) h{i % 4}.example (dot) org; {words(3)}")
        elif kind == 4:
            docs.append(f"{words(4)} the +49 {number(9)} {words(6)} order {number(9)} {words(2)}")
        else:
            docs.append(words(40))
    docs.append("call 0123456789 then again call 0123456789 and tel: 0123456789")
    docs.append("u2 at h.example.org is the same address")
    return docs


def test_bootstrap_finds_unseen_forms(spark, planted):
    df = spark.createDataFrame(list(enumerate(planted)), DOCS).withColumn("score", F.lit(1)).withColumn("row", F.lit(1)).repartition(5)
    accepted, patterns = pii.bootstrap(df, pii.scan(df))
    want, trusted = brute_scores(planted)
    got = {(r.kind, r["name"]): r.score for r in accepted.collect()}
    assert got.keys() == want.keys() and all(math.isclose(got[e], want[e]) for e in want)
    found = {(r.kind, r.words): r.confidence for r in patterns.collect() if r.confidence >= pii.ACCEPT}
    assert found.keys() == trusted.keys() and all(math.isclose(found[p], trusted[p]) for p in found)
    assert {(0, "mail: "), (3, "tel: ")} <= found.keys()
    assert not {w for _, w in found} & {"order ", "the ", "of ", "version "}
    spans = {r.doc_id: r.spans for r in pii.digests(pii.find(df)).collect()}
    for i, t in enumerate(planted):
        for m in re.finditer(r"tel: (0\d{3} \d{6})|mail: (u\d+ \(at\) \S+ \(dot\) org)", t):
            k = 1 if m[1] else 2
            assert f"{'phone' if m[1] else 'email'}:{m.start(k)}:{m.end(k)}" in spans[i].split(","), t
        if i % 6 == 5 and i < 120:
            assert spans[i] == ""
    assert spans[120].split(",")[0] == "phone:5:15" and spans[121] == "email:0:19"


def test_odd_texts(spark):
    rows = [(1, None), (1, None), (None, "a@b.c"), (2, ""), (3, "x " * 200_000 + "call +49 123 456 78"), (4, "a@b.c a@b.c"), (4, "a@b.c a@b.c")]
    df = spark.createDataFrame(rows, DOCS).withColumn("kind", F.lit("x")).withColumn("mentions", F.lit(0))
    got = pii.digests(pii.find(df)).collect()
    assert len(got) == 7
    assert sorted(r.spans for r in got) == ["", "", "", "email:0:5", "email:0:5,email:6:11", "email:0:5,email:6:11", "phone:400005:400019"]
    assert pii.digests(pii.find(df.limit(0))).count() == 0


def test_candidates():
    found = lambda t: [(pii.KINDS[k], t[a:z], name) for k, a, z, name in pii.candidates(t)]
    assert found("x 2001:db8::1, 10[.]0[.]0[.]1") == [("ip", "2001:db8::1", "2001:db8::1"), ("ip", "10[.]0[.]0[.]1", "10.0.0.1")]
    assert ("card", "4111.1111.1111.1112", "4111111111111112") in found("no 4111.1111.1111.1112!")
    assert found("at 12:30 or 1:2") == [] and found("a.b [at] c [dot] d.e") == [("email", "a.b [at] c [dot] d.e", "a.b@c.d.e")]
    overlap = pii.mentions("tel: +49 (30) 123 456 78")
    assert [m[3] for m in overlap] == [True] and overlap[0][4] == "tel: "
