"""Training-data operators against brute force, and their defined results for odd rows."""

import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from riskloom.llm import (fixity, html_text, langid, licences, mixing, packing, piecewise, simhash, topk, toxicity)

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "lorem ipsum dolor sit amet " * 20_000


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and very long texts, ties, repeated rows and extra columns."""
    rows = [(1, "the cat sat on the mat", "en", "a", 1), (1, "the cat sat on the mat", "en", "a", 1),
            (2, None, None, None, None), (None, "the cat sat on the mat", "en", "b", 1), (3, "", "de", "b", 0),
            (4, LONG, "la", "b", 0), (5, "12 34 !! \t\n", "en", None, 9), (6, "der Hund \U0001f600 über", "de", "c", 3)]
    return (spark.createDataFrame(rows, DOCS).withColumn("score", F.lit(1)).withColumn("fp", F.lit(2))
            .withColumn("rank", F.lit(3)).withColumn("size", F.lit(4)).withColumn("bin", F.lit(5)))


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def none(spark, df):
    return spark.createDataFrame([], df.schema)


@pytest.mark.parametrize("key", ["op5_exact_top_k", "op7_merkle_fixity", "op8_mix_sources", "op12_max_sketch_search"])
def test_query_matches_sql(spark, key):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = E.queries()[key](spark, SF)
    want = con.execute(E.oracle_sql()[key])
    cols = [c[0] for c in want.description]
    assert sorted(got.columns) == sorted(cols)
    assert sorted(map(str, (tuple(r) for r in got.select(*cols).collect()))) == sorted(map(str, want.fetchall()))


def test_language(spark, odd, docs):
    model = langid.train(docs.filter(~langid.held_out(F.col("doc_id"))))
    got = (langid.predict(docs, model).join(docs.select("doc_id", "lang"), "doc_id")
           .filter(langid.held_out(F.col("doc_id")) & F.col("lang").isNotNull()))
    r = got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")).alias("a"),
                F.avg(F.col("rejected").cast("int")).alias("r")).first()
    assert r.a > 0.9 and r.r < 0.05
    rows = langid.predict(odd, model).collect()
    assert len(rows) == 8 and all(0 <= x.score <= 1 for x in rows)
    assert {x.doc_id: x.lang_pred for x in rows}[2] == "und" == {x.doc_id: x.lang_pred for x in rows}[5]
    assert langid.filter_language(odd, model).columns == odd.columns
    assert langid.train(none(spark, odd)) is None
    assert {x.lang_pred for x in langid.predict(odd, None).collect()} == {"und"}


def test_every_language_is_learned(spark, monkeypatch):
    # a draw of one row a language, in expectation, would leave about a third of them without any
    monkeypatch.setattr(langid, "ALL_ROWS", 40)
    monkeypatch.setattr(langid, "LEAST_ROWS", 1)
    r = random.Random(5)
    letters = [chr(0x4E00 + k) for k in range(1200)]
    words = [["".join(r.choice(letters[30 * k:30 * k + 30]) for _ in range(6)) for _ in range(12)] for k in range(40)]
    rows = [(100 * k + j, " ".join(r.choice(words[k]) for _ in range(60)), f"l{k:02}") for k in range(40)
            for j in range(1 if k == 7 else 4)] + [
        (9000 + j, " ".join(words[0]), "l00") for j in range(80)]
    known = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(known)
    assert set(model["names"]) == {f"l{k:02}" for k in range(40)}
    got = langid.predict(known, model).join(known, "doc_id")
    assert got.filter("lang <> lang_pred").count() == 0
    foreign = spark.createDataFrame([(1, "zyxw vuts rqpo " * 60, None)], "doc_id long, text string, lang string")
    assert langid.predict(foreign, model).first().rejected


def test_toxicity(spark, odd, docs):
    rng = random.Random(5)
    plain = ["".join(rng.choice("aeioubdfgklmnprst") for _ in range(rng.randint(3, 7))) for _ in range(400)]
    texts, labels = [], []
    for k in range(400):
        w = rng.choices(plain, k=60)
        if k % 2:
            for _ in range(3):
                w[rng.randrange(60)] = rng.choice(["zorkface", "grumwit", "vexhole"])
        texts.append(" ".join(w)), labels.append(k % 2)
    model = toxicity.fit(texts, labels)
    unseen = " ".join(rng.choices(plain, k=50) + ["zorkfase", "gruumwit", "vexholes"])
    score = toxicity._scorer(model)([texts[1], texts[2], unseen, "", None])
    assert score[0] > 0.5 > score[1] and score[2] > 0.5 and score[3] == score[4] < 0.5
    assert toxicity.fit(["a"], [1]) is None and toxicity.fit([], []) is None
    got = toxicity.predict(odd, model).collect()
    assert len(got) == 8 and all(0 <= r.score <= 1 for r in got)
    assert toxicity.filter_toxic(odd, model).columns == odd.columns
    assert {r.score for r in toxicity.predict(odd, None).collect()} == {0.0}
    labels = spark.createDataFrame([(1, None), (None, 1), (2, 0)], "doc_id long, toxic int")
    assert toxicity.train(odd, labels) is None


def brute_fingerprint(text):
    """Word by word and bit by bit, as the contract says."""
    import xxhash
    low = (text or "").translate(str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)}))
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    runs = [" ".join(w[i:i + 4]) for i in range(max(1, len(w) - 3))] if w else []
    h = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps, distance):
    left, out = set(fps), {}
    while left:
        todo = [left.pop()]
        group = set(todo)
        while todo:
            x = todo.pop()
            near = {y for y in left if (x ^ y).bit_count() <= distance}
            left -= near
            group |= near
            todo += near
        for x in group:
            out[x] = group
    return out


def test_simhash(spark, odd, docs):
    rows = simhash.near_duplicates(docs.unionByName(odd.select(*docs.columns))).collect()
    texts = [(r.doc_id, r.text) for r in docs.unionByName(odd.select(*docs.columns)).collect()]
    ids = {}
    for i, t in texts:
        ids.setdefault(brute_fingerprint(t), []).append(i)
    group = brute_components(ids, 4)
    want = sorted((i, f, min((x for g in group[f] for x in ids[g] if x is not None), default=None))
                  for f, all_ in ids.items() for i in all_ if i is not None)
    got = sorted((r.doc_id, r.fp % (1 << 64), r.component_id) for r in rows if r.doc_id is not None)
    assert got == want and len(rows) == len(texts)
    assert simhash.near_duplicates(none(spark, odd)).count() == 0


def _plans(monkeypatch, module):
    """Spark's plan of every table that ``module`` writes, by name."""
    got = {}

    def noted(df, name, real=module.save):
        got[name] = df._jdf.queryExecution().executedPlan().toString()
        return real(df, name)

    monkeypatch.setattr(module, "save", noted)
    return got


def test_simhash_index_is_not_broadcast(spark, docs, monkeypatch):
    """Spark sizes the index, dozens of rows a fingerprint, as a table of a row each."""
    plans = _plans(monkeypatch, simhash)
    edges = []

    def noted(df, name, real=simhash.components):
        edges.append(df._jdf.queryExecution().executedPlan().toString())
        return real(df, name)

    monkeypatch.setattr(simhash, "components", noted)
    assert simhash.near_duplicates(docs).count() == docs.count()
    for plan in (*edges, plans["simhash-mixed"]):
        assert "SortMergeJoin [key" in plan and "Broadcast" not in plan


def test_mix_does_not_broadcast_documents(spark, docs, monkeypatch):
    many = docs.crossJoin(spark.range(20)).withColumn("doc_id", F.col("doc_id") * 20 + F.col("id")).drop("id")
    plans = _plans(monkeypatch, mixing)
    got = mixing.mix_copies(many)
    for name in ("mix-bins", "mix"):  # the small table of sources is
        assert "BroadcastHashJoin" in plans[name] and "BuildLeft" not in plans[name]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and plan.count("BroadcastHashJoin") == 1  # the few groups that the sample splits


def test_simhash_links_only_clusters_and_chains(spark):
    rng = random.Random(8)
    fps = [0]
    for _ in range(60):  # chains and dense clusters, with flips in every segment
        x = rng.getrandbits(64)
        for _ in range(rng.choice([1, 3, 12])):
            fps.append(x)
            y = x
            for b in rng.sample(range(64), rng.randint(1, 6)):
                y ^= 1 << b
            x = rng.choice([x, y])
            fps.append(y)
    fps = sorted(set(fps))
    signed = [(x - (1 << 64) if x >> 63 else x, -1) for x in fps]
    for distance, segments in ((4, 3), (3, 4), (5, 2)):
        want = brute_components(fps, distance)
        got = {r.fp % (1 << 64): r.root for r in simhash.link(
            spark.createDataFrame(signed, "fp long, few long"), distance, segments).collect()}
        parts = {}
        for f, root in got.items():
            parts.setdefault(root, set()).add(f)
        assert len(got) == len(fps) and all(want[f] == parts[root] for f, root in got.items())


def test_keep_one(spark, odd):
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 4, 5, 6]  # 2 and 3 are both empty


def test_mix(spark, odd, docs):
    got = mixing.mix_sources(odd)
    rows = got.collect()
    assert len(rows) == 8 and all(r.taken <= 2 * r["size"] for r in rows)
    assert mixing.mix_sources(none(spark, odd)).count() == 0
    copies = mixing.mix_copies(docs)
    sums = {r.doc_id: r.n for r in copies.groupBy("doc_id").agg(
        F.sum(mixing.word_count(F.col("text"))).alias("n")).collect()}
    want = {r.doc_id: r.taken for r in mixing.mix_sources(docs).collect() if r.taken}
    assert {k: v for k, v in sums.items() if v} == want
    odd_copies = mixing.mix_copies(odd)
    assert odd_copies.columns == odd.columns
    assert odd_copies.count() == got.agg(F.sum("copies")).first()[0]


def test_mix_draws_with_unequal_probabilities(spark):
    # one source with half its words to draw: pairs of a short and a long document
    rows = [(i, "w " * (1 if i % 2 else 31), "a") for i in range(8000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix_sources(docs, weights=(1,), share=(1, 2)).collect()
    long_, short = (sum(r.copies for r in got if r["size"] == k) / 4000 for k in (31, 1))
    total = sum(r["size"] for r in got)
    assert abs(sum(r.taken for r in got) - total / 2) <= 31
    # weights 5 and 1, the binary digits of 31 and 1: p = total / 2 * weight / (4000 * (5 * 31 + 1))
    p = total / 2 / (4000 * 156)
    assert abs(long_ - 5 * p) < 0.03 and abs(short - p) < 0.03
    # a weight of the caller's; probabilities of 1 and more are certain copies
    sure = mixing.mix_sources(docs, weights=(1,), share=(1, 2),
                              weight=F.when(F.col("doc_id") < 2000, 1_000_000).otherwise(1)).collect()
    assert all(r.copies == 1 for r in sure if r.doc_id < 2000) and {r.copies for r in sure} == {0, 1}


def test_packing(spark, odd, docs):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(packing.tokenizer_path())
    tok.encode_special_tokens = True
    all_ = docs.unionByName(odd.select(*docs.columns).filter("doc_id is not null").withColumn(
        "doc_id", F.col("doc_id") + 1_000_000).dropDuplicates(["doc_id"]))
    ids = {r.doc_id: np.array(tok.encode(r.text or "", add_special_tokens=False).ids + [0], "<u4")
           for r in all_.collect()}
    at, sequences = dict.fromkeys(ids, 0), {}
    for r in packing.pack_documents(all_).orderBy("doc_id", "start").collect():
        x = ids[r.doc_id]
        assert r.start == at[r.doc_id] and r.length > 0 and r.doc_tokens == len(x)
        assert r.ids_crc32 == zlib.crc32(x[r.start:r.start + r.length].tobytes())
        at[r.doc_id] += r.length
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert at == {k: len(x) for k, x in ids.items()}
    for pieces in sequences.values():
        end = 0
        for offset, n in sorted(pieces):
            assert offset == end
            end += n
        assert end == 1024 or end & (end - 1) == 0
    assert packing.pack_documents(odd).agg(F.sum("length")).first()[0] > 0
    assert packing.pack_documents(none(spark, odd)).count() == 0


def test_small_memo_gives_the_same_ids():
    texts = [" ".join(f"word{i * j % 97}x{j}," for j in range(50)) for i in range(300)]
    few, many = packing.Encoder(packing.tokenizer_path(), 400), packing.Encoder(packing.tokenizer_path())
    assert list(few.encode(texts)) == list(many.encode(texts))
    assert few.memo == 400 and len(few.old) and many.memo == packing.MEMO and not many.old
    few.forget()
    assert len(few.kept) == 2 and not few.old and list(few.encode(texts)) == list(many.encode(texts))


def test_encoder_and_curve():
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(packing.tokenizer_path())
    enc, r = packing.Encoder(packing.tokenizer_path()), random.Random(1)
    bits = [" ", "  ", "\n", "\t", "\r", "\x1c", "\xa0", "'s", "a", "Word", "été", ".", ",", "!!", "9", "漢", "\U0001f642"]
    texts = ["".join(r.choice(bits) for _ in range(r.randint(0, 12))) for _ in range(3000)]
    for t, got in zip(texts, enc.encode(texts)):
        assert np.frombuffer(got, "<u2").tolist() == tok.encode(t, add_special_tokens=False).ids, repr(t)
    cells = np.array([(a, b, c) for a in range(8) for b in range(8) for c in range(8)])
    order = cells[np.argsort(packing.hilbert(cells, 3))]
    assert sorted(packing.hilbert(cells, 3)) == list(range(512))
    assert (np.abs(np.diff(order, axis=0)).sum(1) == 1).all()  # each step goes to a neighbouring cell


def test_piecewise(spark, odd, docs):
    rows = {r.doc_id: r for r in piecewise.fingerprints_with_next(docs, partitions=7).collect()}
    texts = sorted(((r.doc_id, r.text or "") for r in docs.collect()), reverse=True)
    for k, (i, t) in enumerate(texts):
        after, n, r = texts[(k + 1) % len(texts)][1], len(t), rows[i]
        edited = t[:n - n // 2] + after[:n // 2]
        f, e = piecewise.fingerprint(t), piecewise.fingerprint(edited)
        assert (r.n_chars, r.edited_sha256) == (n, hashlib.sha256(edited.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (f, e)
        assert r.near_edited == piecewise.likeness(f, e)
        assert r.near_next == piecewise.likeness(f, piecewise.fingerprint(after))
    for n in (1, 3, 50):
        assert piecewise.fingerprints_with_next(odd, partitions=n).count() == 8
    one = piecewise.fingerprints_with_next(odd.filter("doc_id = 6"), partitions=3).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
    assert piecewise.fingerprints_with_next(none(spark, odd)).count() == 0


def test_piecewise_spans_the_whole_text():
    r = random.Random(3)
    prose = "".join(r.choice("abcdefghij  klmnop\n") for _ in range(300_000))
    for text in (LONG, prose, LONG[:200_000] + prose, prose + LONG[:200_000], "a" * 100_000, "ab", "x"):
        size, one, two = piecewise.fingerprint(text).split(":")
        assert 1 <= len(one) <= 2 * piecewise.CHARS + 1 and 1 <= len(two) <= 2 * piecewise.CHARS + 1
        changed = text[:-1] + "#"  # the last character counts, however many boundaries come before it
        assert piecewise.fingerprint(text + "# one more passage at the end of it" * 40) != ":".join((size, one, two))
        assert piecewise.likeness(piecewise.fingerprint(text), piecewise.fingerprint(changed)) <= 1
    half = len(LONG) // 2
    assert piecewise.likeness(piecewise.fingerprint(LONG), piecewise.fingerprint(LONG[:half] + prose[:half])) < 1
    edited = prose[:200_000] + "".join(r.choice("qrstuvw xyz") for _ in range(100_000))
    assert 0.4 < piecewise.likeness(piecewise.fingerprint(prose), piecewise.fingerprint(edited)) < 0.9


def test_bit_parallel_lcs():
    r = random.Random(2)
    for _ in range(200):
        a = [r.randint(0, 4) for _ in range(r.randint(0, 12))]
        b = [r.randint(0, 4) for _ in range(r.randint(0, 12))]
        d = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(len(a)):
            for j in range(len(b)):
                d[i + 1][j + 1] = d[i][j] + 1 if a[i] == b[j] else max(d[i][j + 1], d[i + 1][j])
        assert piecewise._common("".join(map(str, a)), "".join(map(str, b))) == d[-1][-1]
        at = html_text.common_places(a, b)
        assert len(at) == d[-1][-1] and at == sorted(set(at))
        rest = iter(b)
        assert all(any(x == a[i] for x in rest) for i in at)


PAGE = ("<html><head><title>T</title><style>p{}</style><script>var x='<p>no</p>';</script></head><body>{top}"
        "<nav><ul><li><a>Menu</a></ul></nav>{body}<aside>side</aside><form><p>mail</form><div class='cookie-notice'>ok</div>"
        "<section id=comments><p>first!</section><footer>&copy; us</footer>")


def test_html(spark):
    page = lambda top, body: PAGE.replace("{top}", top).replace("{body}", body)
    rows = [(1, "http://h/a/1", page("<p>Our  site</p>", "<div><h1>One</h1><p>a &amp; b<br>c<p>same words</div>")),
            (2, "http://h/a/2", page("<p>Our site</p>", "<div><h1>Two</h1><p>x &lt; y</div>")),
            (3, "http://g/a/3", page("", "<article><h1>Only</h1><p>text<div class=ad>buy</div><p>more</article>")
             .replace("</nav>", "")),
            (4, None, None), (5, "http://f/", "plain <b>words"), (5, "http://f/", "plain <b>words"), (None, "http://f/x", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit(1))
    for n in (1, 4, 40):
        got = {(r.page_id, r.url): (r.text, r.n_chars) for r in html_text.extract(df, partitions=n).collect()}
        assert got[1, "http://h/a/1"][0] == "One\n\na & b c\n\nsame words"
        assert got[2, "http://h/a/2"][0] == "Two\n\nx < y"
        assert got[3, "http://g/a/3"][0] == "Only\n\ntext\n\nmore"
        assert got[4, None] == ("", 0) == got[None, "http://f/x"] and got[5, "http://f/"] == ("plain words", 11)
        assert html_text.extract(df, partitions=n).count() == 7
    assert html_text.extract(none(spark, df)).count() == 0


def test_top_k(spark):
    rng = np.random.default_rng(4)
    v = rng.normal(size=(700, 16)) * rng.choice([0.1, 1, 3], (700, 1))
    v[100:160] = v[100]  # ties
    v[300] = 0
    rows = [(i, [float(x) for x in v[i]]) for i in range(700)]
    rows += [(9000, None), (9050, [1.0, None]), (9100, [float("nan")] * 16), (None, [1.0] * 16), rows[0], (9150, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit(1))
    w = topk.whole_vectors(df)
    got = {}
    for r in topk.top_k(w, w.filter("vec_id % 50 = 0")).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.score, r.vec_id)
    whole = np.floor(256 * v).astype(np.int64)
    for q in range(0, 700, 50):
        s = whole @ whole[q]
        want = sorted(((-s[i], i) for i in range(700) if i != q))[:5]
        assert got[q] == {k + 1: (-a, i) for k, (a, i) in enumerate(want)}
    assert len(got) == 14
    assert topk.top_k(w.limit(0), w.limit(0)).count() == 0


def check_top_k(spark, v, bucket=topk.BUCKET, group=topk.GROUP):
    """Every query's rows against all products, for whole vectors."""
    rows = [(i, [float(x) / 256 for x in v[i]]) for i in range(len(v))]
    w = topk.whole_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5))
    got = {}
    for r in topk.top_k(w, w.filter("vec_id % 50 = 0"), bucket=bucket, group=group).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    for q in range(0, len(v), 50):
        s = [sum(int(a) * int(b) for a, b in zip(v[i], v[q])) for i in range(len(v))]
        want = sorted((-s[i], i) for i in range(len(v)) if i != q)[:5]
        assert sorted(got.get(q, [])) == [(k + 1, i, -a) for k, (a, i) in enumerate(want)], q


@pytest.mark.parametrize("n", [0, 3, 6, 51])
def test_top_k_of_few_vectors(spark, n):
    rng = np.random.default_rng(n)
    check_top_k(spark, rng.integers(-300, 300, (n, 3)))


@pytest.mark.parametrize("dim, bucket, group", [(2, 512, 16), (3, 4, 2), (4, 3, 1)])
def test_top_k_where_pruning_leaves_few(spark, dim, bucket, group):
    rng = np.random.default_rng(dim)
    v = rng.normal(size=(1500, dim))
    v *= (rng.choice([1, 2, 4, 8], len(v)) / np.linalg.norm(v, axis=1))[:, None]
    check_top_k(spark, np.floor(256 * v).astype(np.int64), bucket, group)


def test_top_k_of_long_vectors(spark):
    rng = np.random.default_rng(3)
    check_top_k(spark, rng.integers(-(1 << 29), 1 << 29, (120, 4)))
    far = spark.createDataFrame([(0, [1e300]), (1, [1.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="too long"):
        topk.whole_vectors(far).collect()


def test_fixity(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    records = fixity.page_archives(pages, 20)
    a, b = fixity.leaves(fixity.as_records(records)), fixity.leaves(fixity.as_records(fixity.damaged(records, 7)))
    x = {(r.archive, r.offset): r.digest for r in a.collect()}
    y = {(r.archive, r.offset): r.digest for r in b.collect()}
    want = {k for k in x.keys() | y.keys() if x.get(k) != y.get(k)}
    got = fixity.audit(a, b).collect()
    assert {(r.archive, r.offset) for r in got} == want and len(got) == len(want)
    assert fixity.audit(a, a).count() == 0 and fixity.audit(a.limit(0), a.limit(0)).count() == 0
    assert {r.status for r in fixity.audit(b, a).collect()} <= {"corrupt", "extra"}
    null = spark.createDataFrame([(1, 0, "r", None), (None, 0, "r", b"x"), (1, None, "r", b"x")],
                                 "archive long, offset long, record_id string, record binary")
    assert [r.length for r in fixity.leaves(null).collect()] == [0]


def test_packing_leaves_nothing_in_workers(spark):
    import pyarrow as pa
    from riskloom.llm import common
    assert packing.pack_documents(spark.read.parquet(f"{SF}/documents.parquet")).count() > 0

    def kept(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([len(common.worker_cache())], pa.int64())], names=["id"])

    assert {r.id for r in spark.range(0, 64, 1, 16).mapInArrow(kept, "id long").collect()} == {0}


def test_fixity_shuffles_texts_once(spark):
    rows = [(i % 40 if i % 9 else None, f"http://a/{i % 40}", f"<p>{i % 40}</p>" * 9) for i in range(60)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for tables that are too large
    try:
        records = fixity.page_archives(pages, 20)
        assert len(records.collect()) == 60
        plan = records._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert "SortMergeJoin" in plan and "ReusedExchange" in plan


def test_fixity_of_repeated_pages_and_clashing_offsets(spark):
    rows = [(7, "u", "<p>same</p>")] * 9000 + [(8, "u", "<p>other</p>"), (7, "u", "<p>changed</p>"), (None, None, None),
                                              (None, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = fixity.page_archives(pages, 100_000).collect()
    assert len(got) == len(rows)
    at = 0
    for r in sorted(got, key=lambda r: r.offset):  # gapless: every row has its place
        assert (r.archive, r.offset) == (0, at)
        at += len(r.text)
    leaf = lambda *x: spark.createDataFrame(
        [(0, o, i, d.encode()) for o, i, d in x], "archive long, offset long, record_id string, record binary")
    a = fixity.leaves(leaf((0, "a", "A"), (0, "b", "B"), (9, "c", "C")))
    b = fixity.leaves(leaf((0, "a", "A"), (0, "b", "B"), (9, "c", "D")))
    bad = fixity.audit(a, b).collect()
    assert [(r.offset, r.status, r.record_id) for r in bad] == [(9, "corrupt", "c")]
    more = fixity.leaves(leaf((0, "a", "A"), (9, "c", "C")))
    assert [(r.offset, r.status, r.record_id) for r in fixity.audit(a, more).collect()] == [(0, "missing", "b")]


def test_read_warc(spark, tmp_path):
    body = [b"hello", b"", b"WARC/1.1 inside\r\n\r\nbody"]
    raw = b"".join(b"WARC/1.1\r\nWARC-Record-ID: <%d>\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (i, len(x), x)
                   for i, x in enumerate(body))
    (tmp_path / "a.warc").write_bytes(raw)
    got = sorted(fixity.read_warc(spark, str(tmp_path / "*.warc")).collect(), key=lambda r: r.offset)
    assert [r.record_id for r in got] == ["<0>", "<1>", "<2>"]
    assert b"".join(bytes(r.record) for r in got) == raw


def test_licences(spark, odd, docs):
    passage = licences.PASSAGES[1][2]
    extra = spark.createDataFrame(
        [(-1, "MIT License mit license! cc by-nc", None, None, 0),
         (-2, "x " + passage.replace("source", "sauce") + " y", None, None, 0)], DOCS)
    all_ = docs.unionByName(extra).unionByName(odd.select(*docs.columns).filter("doc_id > 1").withColumn(
        "doc_id", F.col("doc_id") + 1_000_000))
    index = licences.Index(*licences.frequencies(all_, licences.vocabulary()))
    got = {r.doc_id: r for r in licences.scan(all_, index).collect()}
    word = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    low = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    for r in all_.collect():
        w = word.findall((r.text or "").translate(low))
        hits = [(s, label) for p, label in licences.PHRASES.items() for s in range(len(w))
                if w[s:s + len(p.split())] == p.split()]
        g = got[r.doc_id]
        assert (g.n_words, g.n_base) == (len(w), len(hits))
        assert g.first_word == min((s for s, _ in hits), default=None)
        assert g.last_word == max((s for s, _ in hits), default=None)
        assert g.base_labels == ",".join(sorted({x for _, x in hits}))
    assert got[-1].base_labels == "cc-by,mit" and got[-2].labels == "bsd-text" and 0.8 <= got[-2].score < 1
    assert licences.scan(none(spark, odd), index).count() == 0


def test_pipeline_stages_keep_columns(spark, docs):
    import corpus_pipeline as P
    names = [n for n, _ in P.STAGES]
    assert names == ["language", "toxicity", "near_copies", "mix", "pack"]
    rows = docs
    for name, stage in P.STAGES[:-1]:
        new = stage(spark, rows, SF)
        assert new.columns == docs.columns
        before = {r.doc_id for r in rows.select("doc_id").collect()}
        rows = spark.createDataFrame(new.collect(), docs.schema)
        after = {r.doc_id for r in rows.select("doc_id").collect()}
        assert after <= before
        if name in ("language", "toxicity"):
            assert len(after) > 0.8 * len(before)
        if name == "near_copies":
            group = {f: min(i for i, g in members) for members in brute_groups(before, docs) for _, f in members}
            assert after == set(group.values())
    total = P.STAGES[-1][1](spark, rows, SF).agg(F.sum("length")).first()[0]
    assert total == packing.tokenized(rows, packing.tokenizer_path()).agg(
        F.sum(F.octet_length("ids")) / 2).first()[0]


def brute_groups(ids, docs):
    """Components of the documents ``ids`` as lists of (doc_id, fingerprint)."""
    fps = {}
    for r in docs.collect():
        if r.doc_id in ids:
            fps.setdefault(brute_fingerprint(r.text), []).append(r.doc_id)
    seen, out = set(), []
    for f, group in brute_components(fps, 4).items():
        if f not in seen:
            seen |= group
            out.append([(i, g) for g in group for i in fps[g]])
    return out


def test_licence_phrases_stand_in_full():
    """Expected places written out by hand, without the operator's own phrase table."""
    index = licences.Index(10, {})
    got = index.scan("The GNU General Public License, a general public license; Apache License. CC-BY and cc by, MIT license")
    assert (got["n_words"], got["n_base"], got["first_word"], got["last_word"]) == (18, 5, 1, 16)
    assert got["base"] == {"gpl", "apache", "cc-by", "mit"}
    got = index.scan("a general public license and an apache licence")
    assert (got["n_base"], got["first_word"], got["last_word"], got["labels"]) == (0, None, None, set())


def test_html_names_do_not_hide_articles():
    text = lambda html: html_text.main_text(html_text.lines(html), None)
    body = "<article><header class='entry-header'><h1>Title</h1></header><p>Words</article>"
    for around in ("<div class='no-sidebar'>{}</div>", "<div id='content-with-comments'>{}</div>",
                   "<div class='sidebar-right'><p class=ad>buy</p>{}</div>", "<form><div class=sidebar>{}</div></form>",
                   "<nav><ul><li>Menu{}", "<div class=share>tell</div>{}<div class='related-posts'><article>Other</article></div>"):
        assert text(around.format(body)) == "Title\n\nWords", around
    assert text("<div class='page header'><h1>Title</h1><p>Words</div><div class=header>Site</div>") == "Title\n\nWords"
    assert text("<form id=f><h1>Title</h1><p>Words</form>") == "Title\n\nWords"
    kept = "<article><h1>T</h1><p class='market-share'>a</p><p class='legal-notice'>b</p><p class=notice>c</p>{}</article>"
    assert text(kept.format("<div class='ad-slot'>buy</div><div class='share-buttons'>tell</div>")) == "T\n\na\n\nb\n\nc"
    for tag in ("svg", "math"):
        assert text(f"<article><p>a<{tag} width='1'/>b<p>c<{tag}/><p>d<{tag}><text>no</text></{tag}></article>") == "ab\n\nc\n\nd"
        assert text(f"<article><p>a<{tag}><p>b</article>") == "a\n\nb"


def test_html_shared_lines_go_inside_articles():
    cut = lambda *body: html_text.lines(f"<article><h1>Weekly</h1>{''.join(f'<p>{x}' for x in body)}</article>")
    own = [f"{w} words that only one page has, and so many that no other text comes near their length at all" for w in "abcdefgh"]
    passage = [f"{w} passage that both of the pages quote in full, with so many words that it is no line of the site" for w in "xyz"]
    bar, more = "Tell your friends", "Read more of this series"
    one, two = cut(bar, *own[:4], more), cut(bar, *own[4:], more)
    assert html_text.main_text(one, two).split("\n\n") == ["Weekly", *own[:4]]
    one, two = cut(*own[:4], *passage, own[4], more), cut(own[5], *passage, *own[6:], more)
    assert html_text.main_text(one, two).split("\n\n") == ["Weekly", *own[:4], *passage, own[4]]
    copy, edited = cut(bar, *own, more), cut(bar, *own[:6], "x", own[7], more)
    assert html_text.main_text(copy, copy).split("\n\n") == ["Weekly", bar, *own, more]
    assert html_text.main_text(edited, copy).split("\n\n") == ["Weekly", bar, *own[:6], "x", own[7], more]


def test_licence_passages_against_brute_force():
    """Altered passages, cut ones, and texts where the altered words occur elsewhere; every alignment tried."""
    rng, index = random.Random(3), licences.Index(10, {})
    holds = lambda w, key: any(w[i:i + len(key)] == key for i in range(len(w)))
    found = 0
    for k in range(600):
        label, key, passage = licences.PASSAGES[k % len(licences.PASSAGES)]
        w = passage.split()
        n = len(w)
        at = rng.sample(range(n), rng.randint(0, n // 4)) if k % 3 else sorted(
            range(n), key=lambda j: (index.rank[w[j].encode()], j))[:rng.randint(0, n // 4)]
        lost = [w[j] for j in at]
        for j in at:
            w[j] = "zz"
        w = w[rng.choice([0, 0, 2]):]
        text = ["yy"] * rng.choice([0, 3]) + w + ["yy"] + (lost if k % 2 else []) + ["yy", *key.split()]
        spans, score = set(), 0.0
        for name, phrase, whole in licences.PASSAGES:
            t = whole.split()
            for s in range(-len(t), len(text)) if holds(text, phrase.split()) else ():
                share = sum(0 <= s + j < len(text) and text[s + j] == x for j, x in enumerate(t)) / len(t)
                if share >= licences.MATCH:
                    spans.add((name, max(s, 0), s + len(t)))
                    score = max(score, share)
        got = index.scan(" ".join(text))
        assert {s for s in got["spans"] if s[0] in got["labels"]} == spans
        assert got["labels"] == {s[0] for s in spans} and (got["n_base"] or got["score"] == score)
        found += bool(spans)
    assert 200 < found < 600


def test_licence_altered_words_are_not_looked_up_first():
    index = licences.Index(10, {})
    for label, key, passage in licences.PASSAGES[:4]:
        w = passage.split()
        once = [j for j, x in enumerate(w) if w.count(x) == 1 and x not in key.split()]
        for j in once[:len(w) // 5]:
            w[j] = "zz"
        assert index.scan(" ".join([*w, *key.split()]))["labels"] == {label}, label


def test_language_rejects_noise_and_foreign_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").filter(F.length("text") >= 40)
    r, rows = random.Random(4), []
    letters = {"latin": "abcdefghijklmnopqrstuvwxyz", "cyrillic": "абвгдежзийклмнопрстуфхцчшщъыьэюя",
               "han": [chr(0x4E00 + i) for i in range(3000)]}
    for kind, some in letters.items():
        for n in (60, 250, 1500, 6000):
            for _ in range(20):
                words = ("".join(r.choice(some) for _ in range(r.randint(2, 9))) for _ in range(n))
                rows.append((len(rows), " ".join(words)[:n], f"{kind} {n}"))
    noise = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(docs.filter(~langid.held_out(F.col("doc_id"))))
    part = lambda df, m: {x.lang: x.r for x in langid.predict(df, m).join(df.select("doc_id", "lang"), "doc_id")
                          .groupBy("lang").agg(F.avg(F.col("rejected").cast("int")).alias("r")).collect()}
    got = part(noise, model)
    assert all(v >= 0.9 for k, v in got.items() if k != "latin 60"), got
    long = docs.filter((F.length("text") > 500) & F.col("lang").isNotNull())
    rest = langid.train(docs.filter((F.col("lang") != "es") & ~langid.held_out(F.col("doc_id"))))
    got = part(long, rest)
    assert got.pop("es") > 0.9 and all(v < 0.05 for v in got.values()), got
    assert all(v < 0.05 for v in part(docs.filter("lang is not null"), model).values())
