"""Each operator against brute force, the library it must agree with, or a round trip, on small tables
with nulls, empty and long texts, ties, repeated rows, empty tables and clashing extra columns."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

P = pytest.importorskip("public_tokenizers")

LONG = "word " * 30_000
TEXTS = [None, "", "   ", "a b c", "Under the MIT License, friends.", "Under the MIT License, friends.", "Été à la plage — ÇA VA? <|endoftext|> x", LONG, "mail me at a.b@c.example.com or +1 (269) 555-3296, 10.0.0.1", "日本語 😀 text"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "x", 7, "clash") for i, t in enumerate(TEXTS)] + [(4, TEXTS[4], "x", 7, "clash"), (None, "no id here", None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, n_words string, n_tokens int, score string")


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where("false")


def test_token_counts(docs, empty):
    from tokenizers import Tokenizer

    from sedge.llm.token_counts import count_tokens

    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    got = {r.doc_id: r for r in count_tokens(docs, P.path("byte_bpe_50k.json")).collect()}
    for i, text in enumerate(TEXTS):
        n = len(t.encode(text or "", add_special_tokens=False).ids)
        assert (got[i].n_bytes, got[i].n_tokens, got[i].over_limit) == (len((text or "").encode()), n, n > 512)
    assert count_tokens(empty, P.path("byte_bpe_50k.json")).count() == 0


def _ids(text, end):
    from tokenizers import Tokenizer

    return np.array(Tokenizer.from_file(P.path("word_bpe_49k.json")).encode(text or "", add_special_tokens=False).ids + [end], "<u4")


def test_packing(docs, empty):
    from sedge.llm.packing import pack

    rows = docs.where("doc_id is not null").dropDuplicates(["doc_id"])
    got = pack(rows, P.path("word_bpe_49k.json")).toPandas()
    for i, text in enumerate(TEXTS):
        ids, at = _ids(text, 2), 0
        for r in got[got.doc_id == i].sort_values("start").itertuples():
            assert r.start == at and r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    for _, g in got.groupby("sequence_id"):
        g = g.sort_values("offset")
        assert list(g.offset) == [0, *np.cumsum(g.length)[:-1]] and g.length.sum() <= 4096
    assert pack(empty, P.path("word_bpe_49k.json")).count() == 0


def test_token_archive(spark, docs, empty):
    from sedge.llm.storage import new_folder
    from sedge.llm.token_archive import lookup, read_token_archive, token_digests, write_token_archive

    folder = new_folder(spark, "t")
    manifest = write_token_archive(docs, folder, P.path("word_bpe_49k.json"), shard_bytes=150)
    assert manifest.count() > 3
    got = token_digests(spark, folder).orderBy("start").collect()
    assert len(got) == docs.count() and got[0].doc_id is None
    at = 0
    for r in got:
        ids = _ids("no id here" if r.doc_id is None else TEXTS[r.doc_id], 1)
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    files = [f"{folder}/{r.file}" for r in manifest.collect()]
    found = [x for f in files if (x := lookup(f, 6)) is not None]
    assert len(found) == 1 and found[0].tolist() == _ids(TEXTS[6], 1).tolist()
    assert read_token_archive(spark, folder).where("doc_id = 3").first().ids == _ids("a b c", 1).tobytes()
    folder = new_folder(spark, "t")
    write_token_archive(empty, folder, P.path("word_bpe_49k.json"))
    assert token_digests(spark, folder).count() == 0


def test_warc(spark):
    from sedge.llm.storage import new_folder
    from sedge.llm.warc import read_warc, write_warc

    big = "<p>é</p>" * 50
    rows = [(5, "http://a", big), (2, None, big), (9, "http://b\nx", big), (7, "u", "tiny"), (8, "u", "tiny"), (1, "u", None), (2, None, big), (None, "u", big), (3, "u", "x" * 300_000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    folders = [new_folder(spark, "w"), new_folder(spark, "w")]
    manifests = [write_warc(d, f, shard_bytes=2000, max_file_bytes=200).orderBy("file").collect() for d, f in zip((df, df.repartition(5)), folders, strict=True)]
    assert [(r.file, r.sha256) for r in manifests[0]] == [(r.file, r.sha256) for r in manifests[1]] and len(manifests[0]) > 3
    got = read_warc(spark, folders[0]).collect()
    assert len(got) == len(rows)
    for r in got:
        text = next(h or "" for p, _, h in rows if p == r.page_id).encode()
        assert (r.payload_bytes, r.payload_digest) == (len(text), hashlib.sha256(text).hexdigest())
    kinds = sorted((str(r.page_id), r.record_type, r.refers_to) for r in got)
    assert kinds == sorted([("1", "response", None), ("2", "response", None), ("2", "revisit", 2), ("3", "response", None), ("5", "revisit", 2), ("7", "response", None), ("8", "response", None), ("9", "revisit", 2), ("None", "revisit", 2)])
    folder = new_folder(spark, "w")
    write_warc(df.where("false"), folder)
    assert read_warc(spark, folder).count() == 0


def test_shards_weigh_about_the_target_whatever_the_keys(spark):
    """Dense and scattered keys, a key and nulls with a third of all rows each, and 5,000 shards."""
    from sedge.llm.storage import Shards

    sub = F.pmod(F.xxhash64("n"), F.lit(1 << 31)).cast("int")
    base = spark.range(60_000).select(F.col("id").alias("n"))
    keys = {"dense": F.col("n"), "scattered": F.xxhash64("n"), "hot": F.when(F.col("n") % 3 == 0, 7).when(F.col("n") % 3 == 1, F.lit(None)).otherwise(F.col("n")).cast("long")}
    for name, key in keys.items():
        rows = base.select("n", key.alias("k"), F.lit(10).alias("w"))
        shards = Shards(rows, "k", "w", 6000)
        placed = rows.select("k", shards.of(F.col("k"), sub).alias("shard"))
        sizes = [r["count"] for r in placed.groupBy("shard").count().collect()]
        assert 90 <= len(shards) <= 220 and max(sizes) <= 1300 and len(sizes) <= len(shards), name
        by_key = placed.groupBy("shard").agg(F.min("k").alias("lo"), F.max("k").alias("hi")).where("lo is not null").orderBy("shard").collect()
        assert all(a.hi <= b.lo for a, b in zip(by_key, by_key[1:], strict=False))
    rows = spark.range(1_000_000).select(F.col("id").alias("k"), F.lit(1).alias("w"))
    shards = Shards(rows, "k", "w", 200)
    assert 4000 <= len(shards) <= 8000
    dealt = shards.dealt(rows.select("k", shards.of(F.col("k"), F.lit(0)).alias("shard")))
    assert dealt.groupBy(F.spark_partition_id()).agg(F.count_distinct("shard").alias("n"), F.count("*").alias("rows")).where("n > 1 or rows > 400").count() == 0
    assert len(Shards(rows.where("false"), "k", "w", 200)) == 1


def test_decontamination(spark, docs, empty):
    from sedge.llm.decontamination import WINDOW, contamination, decontaminate, windows_of, words_of

    random.seed(2)
    vocabulary = [f"w{i}" for i in range(30)]
    items = [(i, " ".join(random.choices(vocabulary, k=random.choice([3, 9, 10, 14])))) for i in range(12)] + [(50, None), (51, "--"), (None, "w1 w2")]
    texts = []
    for i in range(60):
        t = random.choices(vocabulary + ["zz"], k=40)
        if i % 2:
            t[5:5] = random.choice(items[:12])[1].upper().split()
        texts.append((i, " ".join(t)))
    df = spark.createDataFrame([*texts, (60, None), (61, "")], "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: r for r in contamination(df, bench, most_symbols=200).collect()}
    windows = {i: set(windows_of(words_of(t), WINDOW)) for i, t in items if i is not None}
    for doc, text in [*texts, (60, None)]:
        words, hit, names = words_of(text), set(), set()
        for i, of in windows.items():
            for w in of:
                for k in range(len(words) - len(w) + 1):
                    if tuple(words[k : k + len(w)]) == w:
                        hit |= set(range(k, k + len(w)))
                        names.add(str(i))
        digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        assert (got[doc].n_words, got[doc].n_hit, got[doc].n_items, got[doc].items_sha256) == (len(words), len(hit), len(names), digest)
    clean = decontaminate(df, bench)
    assert clean.count() == 62 and contamination(clean, bench).where("contaminated").count() == 0
    assert contamination(empty, bench).count() == 0 and contamination(docs, bench.where("false")).where("contaminated").count() == 0


def test_license_scan(docs, empty):
    from sedge.llm.license_scan import scan

    got = {r.doc_id: r for r in scan(docs).collect()}
    assert scan(docs).count() == docs.count() and scan(empty).count() == 0
    assert (got[4].n_words, got[4].n_base, got[4].first_word, got[4].last_word, got[4].base_labels, got[4].labels) == (5, 1, 0, 0, "mit", "mit")
    assert (got[0].n_words, got[0].n_base, got[0].first_word, got[0].labels, got[0].score) == (0, 0, None, "", 0.0)
    spark = docs.sparkSession
    near = spark.createDataFrame([(1, "this is licensed under the new gnu general public license version 3 ok"), (2, "cc-by-nc and CC by NC"), (3, "general public")], "doc_id long, text string")
    got = {r.doc_id: r for r in scan(near).collect()}
    assert got[1].labels == "gpl-3" and got[1].n_base == 0 and got[2].n_base == 2 and got[2].last_word == 4 and got[3].labels == ""


def test_license_scan_of_whole_licenses(spark):
    """Whole texts with words changed, put in and left out; a part alone is not enough."""
    from sedge.llm.license_scan import TEXTS, scan

    rng, rows, want = random.Random(1), [], {}
    for k, (label, text) in enumerate(TEXTS.items()):
        words = text.split(" ")
        for at in sorted(rng.sample(range(len(words)), len(words) // 25), reverse=True):
            words[at : at + 1] = rng.choice([[], ["other"], [words[at], "indeed"]])
        rows.append((k, "Before it. " + ", ".join(words).upper() + " After it."))
        want[k] = label
        rows.append((100 + k, " ".join(text.split(" ")[: len(text.split(" ")) // 3])))
    got = {r.doc_id: r for r in scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for k, label in want.items():
        assert label in got[k].labels.split(",") and got[k].score >= 0.8, label
    assert max(len(t.split(" ")) for t in TEXTS.values()) > 62
    assert got[101].n_base == 0 and got[102].labels == "" and got[104].labels == ""


PII = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def _luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _base(text):
    kinds, found = list(PII), []
    for k, kind in enumerate(kinds):
        for m in re.finditer(PII[kind], text or ""):
            d = re.sub("[^0-9]", "", m.group())
            good = {"email": True, "ip": kind != "ip" or all(int(x) <= 255 for x in m.group().split(".")), "card": 14 <= len(d) <= 19 and _luhn(d), "phone": 10 <= len(d) <= 15}[kind]
            if good:
                found.append((m.start(), k, m.end()))
    return [f"{kinds[k]}:{a}:{b}" for a, k, b in sorted(found)]


def test_pii(spark, docs, empty):
    from sedge.llm.pii import digest_columns, find, fit_pii, redact

    random.seed(4)
    parts = ["é ", "a@b.co", "%d@e.f.g", "4532015112830366", "4532 0151 1283 0366", "4 5 3 2 0 1 5 1 1 2 8 3 0 3 6 6", "+1 (269) 555-3296", "+1(2(3(4(5(6(7(8(9(0", "1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1", "000255.1.1.1", " ", "\n", "-", "@", "7" * 40, "+", "x"]
    rows = [(i, "".join(random.choices(parts, k=random.randrange(12)))) for i in range(400)] + [(900, None), (901, "1" * 50_000), (902, "a." * 20_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    model = fit_pii(df)
    got = {r.doc_id: r for r in digest_columns(find(df, model)).collect()}
    for i, text in rows:
        want = _base(text)
        assert got[i].base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest(), text
        assert [got[i][f"n_{k}"] for k in PII] == [sum(w.startswith(k + ":") for w in want) for k in PII]
        assert set(want) <= set(got[i].spans.split(",")) | {""}
    assert find(empty, model).count() == 0 and fit_pii(empty).trees == []
    clean = {r.doc_id: r.text for r in redact(docs, model).collect()}
    assert clean[8] == "mail me at [EMAIL] or [PHONE], [IP]" and clean[0] is None and clean[3] == "a b c"


def test_pii_adds_spans_that_the_base_patterns_miss(spark):
    from sedge.llm.pii import find, fit_pii, redact

    r = random.Random(7)

    def card():
        d = str(r.randrange(4 * 10**14, 5 * 10**14))
        d += next(c for c in "0123456789" if _luhn(d + c))
        return d[:4], d[4:8], d[8:12], d[12:]

    phone = lambda: f"({r.randrange(200, 999)}) 555-{r.randrange(1000, 9999)}"
    shapes = [lambda: f"tel. {phone()} x", lambda: "paid by " + ".".join(card()) + " x", lambda: " ".join(["".join(card())] * 2), lambda: f"part {phone()} x", lambda: f"sums {r.randrange(10**15)} x", lambda: f"see {r.randrange(10**6)}.{r.randrange(10**6)} x", lambda: f"mail jane{r.randrange(99)} (at) mail{r.randrange(9)} (dot) org x", lambda: f"m{r.randrange(99)} (at) noon (dot) x", lambda: f"b{r.randrange(99)}@c.example.com x", lambda: f"+1 {phone()} x"]
    df = spark.createDataFrame([(i, shapes[i % len(shapes)]()) for i in range(1800)], "doc_id long, text string")
    model = fit_pii(df)
    told = ["tel. (269) 555-3296 now", "paid by 4532.0151.1283.0366 now", "part (269) 555-3296 now", "paid by 4532.0151.1283.0367 now", "mail joe (at) mail7 (dot) org now", "4532015112830366 4532015112830366", "tel. +1 (269) 555-3296 now"]
    docs = spark.createDataFrame(list(enumerate(told)), "doc_id long, text string")
    got = [x.text for x in redact(docs, model).orderBy("doc_id").collect()]
    assert got == ["tel. [PHONE] now", "paid by [CARD] now", told[2], told[3], "mail [EMAIL] now", "[CARD] [CARD]", "tel. [PHONE] now"]
    assert [[s.base for s in x.spans] for x in find(docs, model).orderBy("doc_id").collect()] == [[False], [False], [], [], [False], [False, False], [True]]


def test_pii_very_many_matches_and_clashing_columns(spark):
    import time

    from sedge.llm.pii import KINDS, Models, digest_columns, find, fit_pii, redact

    many = [" ".join(f"a{i}@b{i % 9}.com" for i in range(20_000)), " ".join(f"+1 (2{i % 90:02d}) 555-{i % 10_000:04d}," for i in range(20_000))]
    df = spark.createDataFrame([(i, t, 5, "x", None) for i, t in enumerate(many)], "doc_id long, text string, __spans int, __text string, `a.b` string").repartition(2)
    model = Models([])
    digest_columns(find(df, model)).collect()  # compiles
    began = time.time()
    found = {r.doc_id: (r.n_email, r.n_phone, r.base_sha256) for r in digest_columns(find(df, model)).collect()}
    assert time.time() - began < 15
    assert found == {i: (20_000 * (i == 0), 20_000 * (i == 1), hashlib.sha256(",".join(_base(t)).encode()).hexdigest()) for i, t in enumerate(many)}
    clean = redact(df, model)
    assert clean.schema == df.schema
    rows = {r.doc_id: r for r in clean.collect()}
    assert rows[0].text == " ".join(["[EMAIL]"] * 20_000) and rows[1].text == " ".join(["[PHONE],"] * 20_000) and rows[0]["__spans"] == 5 and rows[0]["__text"] == "x"
    # overlapping spans of two kinds are replaced together
    both = spark.createDataFrame([(1, "x 1.2.3.4532015112830366 y +1.2.3.4567890 z")], "doc_id long, text string")
    assert KINDS[3] in {KINDS[s.kind] for s in find(both, model).first().spans} and redact(both, model).first().text.startswith("x ")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    learnt = fit_pii(docs)
    assert learnt.trees and find(docs, learnt).select(F.explode("spans").alias("s")).where("not s.base").count() > 0


def _components(rows):
    sets = {}
    for d, t in rows:
        w = (t or "").lower().split()
        sets[d] = frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()
    up = {d: d for d in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = list(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            k = len(sets[a] & sets[b])
            if k and 100 * k >= 75 * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), root(d)) for d in ids}


@pytest.mark.parametrize("limits", [{}, {"most_docs": 7}])
def test_jaccard_join(spark, limits):
    from sedge.llm.jaccard_join import jaccard_components

    random.seed(3)
    base = [[f"w{random.randint(0, 3000)}" for _ in range(random.randint(10, 60))] for _ in range(15)]
    rows = []
    for i in range(120):
        b = list(random.choice(base))
        for _ in range(random.randint(0, 3)):
            b[random.randrange(len(b))] = f"x{random.randint(0, 9999)}"
        b = b[: random.randint(2, len(b))] if random.random() < 0.5 else b
        rows.append((i * 3, " ".join(b + [f"c{k}" for k in range(20)] * (random.random() < 0.4))))
    rows += [(9000, None), (9001, ""), (9002, "a b"), (9003, "A  b")]
    df = spark.createDataFrame([*rows, (None, rows[0][1])], "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_components(df, **limits).collect()}
    assert got.pop(None)[1] == _components(rows)[0][1] and got == _components(rows)
    assert not limits or jaccard_components(df.where("false")).count() == 0


@pytest.mark.parametrize(("num", "den"), [(75, 100), (50, 100), (68, 100), (9, 10), (1, 1)])
def test_jaccard_keys(num, den):
    """Linked sets share a key, whichever elements of their union one of them lacks."""
    from sedge.llm.jaccard_join import Bounds

    rng, bounds = np.random.default_rng(1), Bounds(num, den)
    for trial in range(800):
        union = np.unique(rng.integers(0, 1 << 63, int(rng.integers(1, 60 if trial % 2 else 400))).astype(np.uint64))
        lacking = len(union) - -(-len(union) * num // den)
        at = np.unique(np.linspace(0, len(union) - 1, lacking).astype(int)) if trial % 3 else rng.permutation(len(union))[:lacking]
        side = rng.random(len(at)) < rng.choice([0, 0.2, 0.5, 1])
        a, b = np.delete(union, at[side]), np.delete(union, at[~side])
        if len(a) and len(b):
            assert np.intersect1d(bounds.keys(a), bounds.keys(b)).size


def test_keep_one(spark):
    """Null ids, ids with two texts, repeated rows, texts without words, clashing columns, an empty table."""
    from sedge.llm.jaccard_join import keep_one

    words = [f"w{i}" for i in range(40)]
    near = " ".join([*words[:-1], "other"])
    a, b, c = " ".join(words), " ".join(f"v{i}" for i in range(9)), "one two"
    rows = [(5, a), (3, near), (3, b), (None, a), (9, b), (None, c), (None, c), (7, c), (8, "solo text here"), (8, "solo text here"), (1, None), (1, None), (2, " "), (None, "no id at all"), (None, "no id at all")]
    df = spark.createDataFrame([(i, t, k, "x") for k, (i, t) in enumerate(rows)], "doc_id long, text string, node int, `row` string")
    got = keep_one(df)
    assert got.schema == df.schema
    found = sorted(((r.doc_id, r.text) for r in got.collect()), key=str)
    assert found == sorted([(3, near), (3, b), (7, c), (8, "solo text here"), (1, None), (1, None), (2, " "), (None, "no id at all")], key=str)
    assert keep_one(df.where("false")).count() == 0


def test_exact_top_k(spark):
    from sedge.llm.exact_top_k import top_k

    rng = np.random.default_rng(1)
    v = rng.normal(size=(300, 8)).round(1)
    v[50:60] = v[49]  # ties
    rows = [(i, [float(x) for x in r], 1) for i, r in enumerate(v)] + [(400, None, 1), (500, [float("nan")] * 8, 1), (600, [None] * 8, 1), (None, [1.0] * 8, 1), (700, [0.0] * 8, 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank int")
    got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in top_k(df, F.col("vec_id") % 50 == 0, k=5, unit=64).collect()}
    good = {i: np.floor(1024 * np.array(r)).astype(int) for i, r, _ in rows if i is not None and r and None not in r and np.isfinite(r).all()}
    want = {}
    for q in (i for i in good if i % 50 == 0):
        best = sorted(((-int(good[q] @ x), i) for i, x in good.items() if i != q))[:5]
        want |= {(q, k + 1): (i, -s) for k, (s, i) in enumerate(best)}
    assert got == want and top_k(df.where("false"), F.lit(True)).count() == 0


def test_quality_held_out_accuracy(spark, docs, empty):
    from sedge.llm.quality import Model, fit_quality, keep_quality, score_quality

    sf = "/root/testdata/sf0.01"
    real, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    model = fit_quality(real, labels)
    r = score_quality(real, model).join(labels, "doc_id").where("held_out").agg(F.avg((F.col("predicted") == F.col("quality")).cast("int")), F.count("*")).first()
    assert r[0] >= 0.95 and r[1] > 50
    assert score_quality(docs, model).count() == docs.count() and score_quality(docs, model).where("score < 0 or score > 1 or score is null").count() == 0
    assert fit_quality(docs, labels.where("false")) .scores(np.zeros((1, 16))).tolist() == [0.5] and isinstance(fit_quality(empty, labels), Model)
    assert keep_quality(real, model).columns == real.columns


def test_pipeline(spark):
    import corpus_pipeline

    from sedge.llm.decontamination import contamination
    from sedge.llm.quality import fit_quality, score_quality

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept, tables = docs, {}
    for name, stage in corpus_pipeline.STAGES:
        kept = tables[name] = stage(spark, kept, sf)
        assert name == "packing" or kept.columns == docs.columns
    good = score_quality(docs, fit_quality(docs, spark.read.parquet(f"{sf}/labels.parquet"))).where("predicted = 1").select("doc_id")
    rows = [tuple(r) for r in docs.join(good, "doc_id").select("doc_id", "text").collect()]
    want = {d for d, (_, c) in _components(rows).items() if c == d}
    assert {r.doc_id for r in tables["near_duplicates"].collect()} == want
    assert contamination(tables["decontamination"], spark.read.parquet(f"{sf}/benchmark.parquet")).where("contaminated").count() == 0
    assert all(not _base(r.text) for r in tables["personal_data"].collect())
    assert {r.doc_id for r in tables["packing"].select("doc_id").distinct().collect()} == want
