"""Plain restatements of the learnt model and of packing's classes; hot keys; stages on odd tables."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

P = pytest.importorskip("public_tokenizers")

SF = "/root/testdata/sf0.001"


def test_quality_against_loops(spark):
    """Scores entry by entry, and each boosting step against a search of all trees."""
    import math

    from sedge.llm.quality import _square, _tree, features, fit, fit_quality, score_quality

    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    model = fit_quality(docs, labels)
    texts = {r.doc_id: r.text for r in docs.collect()}

    def bin_of(cuts, v):
        return sum(c <= v for c in cuts)

    for r in score_quality(docs, model).collect():
        x, z = features(texts[r.doc_id] or ""), model.intercept
        for j, table in enumerate(model.tables):
            z += table[bin_of(model.cuts[j], x[j])]
        for (i, j), table in zip(model.pairs, model.pair_tables, strict=True):
            z += table[bin_of(model.coarse[i], x[i])][bin_of(model.coarse[j], x[j])]
        want = 1 / (1 + math.exp(-z))
        assert abs(r.score - want) < 1e-12 and r.predicted == int(want >= 0.3)

    rng = np.random.default_rng(2)

    def gain(g, h):
        return g.sum() ** 2 / (h.sum() + 1.0)

    for _ in range(30):
        n = int(rng.integers(2, 9))
        g, h = rng.normal(size=n), rng.uniform(0.1, 1, n)
        best = max(range(1, n), key=lambda c: gain(g[:c], h[:c]) + gain(g[c:], h[c:]))
        step = _tree(g, h, 2, 0.0, 1.0)
        want = np.concatenate([np.full(best, -g[:best].sum() / (h[:best].sum() + 1)), np.full(n - best, -g[best:].sum() / (h[best:].sum() + 1))])
        if gain(g[:best], h[:best]) + gain(g[best:], h[best:]) <= gain(g, h):  # no cut is better than none
            want = np.full(n, -g.sum() / (h.sum() + 1))
        assert np.allclose(step, want)
        m = int(rng.integers(2, 7))
        g2, h2 = rng.normal(size=(n, m)), rng.uniform(0.1, 1, (n, m))
        cells = lambda a, b: [(slice(0, a), slice(0, b)), (slice(0, a), slice(b, None)), (slice(a, None), slice(0, b)), (slice(a, None), slice(b, None))]  # noqa: B023, E731
        top = max(sum(gain(g2[c], h2[c]) for c in cells(a, b)) for a in range(1, n + 1) for b in range(1, m + 1))
        assert abs(_square(g2, h2, 1.0)[0] - top) < 1e-9

    # cyclic boosting lowers the loss, and pairs find what no single feature shows
    x = rng.uniform(size=(800, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    assert ((fit(x, y).scores(x) > 0.5) == y).mean() > 0.95 and ((fit(x, y, n_pairs=0).scores(x) > 0.5) == y).mean() < 0.8


def test_packing_classes(spark):
    """Sequences of class k hold exactly k pieces; fewer than k of each class are left for best fit."""
    from sedge.llm.packing import pack, pieces_of

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    docs = docs.unionByName(docs.limit(3)).unionByName(docs.limit(2).withColumn("doc_id", F.lit(None).cast("long")))
    got = pack(docs.withColumn("length", F.lit("clash")).withColumn("k", F.lit(1)), P.path("word_bpe_49k.json")).collect()
    of = {n: dict(zip(np.cumsum([0] + [a for a, _ in pieces_of(n, 4096)])[:-1].tolist(), [k for _, k in pieces_of(n, 4096)], strict=True)) for n in {r.doc_tokens for r in got}}
    classes, sequences = Counter(), {}
    for r in got:
        k = of[r.doc_tokens][r.start]
        classes[k] += 1
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length, k))
    assert sorted(sequences) == list(range(len(sequences)))
    first_rest = sum(n // k for k, n in classes.items())
    for s, pieces in sequences.items():
        at = 0
        for offset, length, _ in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 4096
        if s < first_rest:
            assert len({k for _, _, k in pieces}) == 1 and len(pieces) == pieces[0][2]
    left = Counter(k for s, pieces in sequences.items() if s >= first_rest for _, _, k in pieces)
    assert left == Counter({k: n % k for k, n in classes.items() if n % k})
    assert Counter(r.doc_id for r in got if r.start == 0)[None] == 2


def test_warc_hot_ids(spark):
    """A third of all pages without an id and a third with one id are many shards; columns may clash."""
    from sedge.llm.storage import new_folder
    from sedge.llm.warc import read_warc, write_warc

    rows = [(None if k % 3 == 0 else 7 if k % 3 == 1 else 1000 + k, f"http://h/{k}", "<p>x</p>" * 20 + str(k % 40), "a", 1, "b") for k in range(600)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, digest string, shard int, payload string")
    folder = new_folder(spark, "w")
    files = write_warc(df, folder, shard_bytes=20_000).collect()
    assert len(files) > 15 and max(r.n_records for r in files) < 120
    got = read_warc(spark, folder).collect()
    assert Counter(r.page_id for r in got) == Counter(r[0] for r in rows)
    first = {}
    for page, _, html, *_ in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        first.setdefault(html, page)
    by_digest = {}
    for r in got:
        by_digest.setdefault(r.payload_digest, []).append(r)
    assert len(by_digest) == 40
    for same in by_digest.values():
        responses = [r for r in same if r.record_type == "response"]
        assert len(responses) == 1 and responses[0].page_id == 7 and all(r.refers_to == 7 for r in same if r.record_type == "revisit")


def test_decontaminate_seams(spark):
    """What a removal joins is removed too; other columns and rows stay, in whatever number."""
    from sedge.llm.decontamination import contamination, decontaminate

    item = [f"q{i}" for i in range(10)]
    other = [f"z{i}" for i in range(10)]
    split = [*item[:5], *other, *item[5:]]
    long = ["w"] * 200_000
    texts = ["a " + " ".join(split) + " b", "keep, THIS.", None, "", " ".join([*long[:100_000], *item, *long]), "c " + " ".join([*item[:5], *item[:5], *other, *item[5:], *item[5:]]) + " d"]
    rows = [(k, t, "x", 5) for k, t in enumerate(texts)] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, spans string, item_id int")
    bench = spark.createDataFrame([(1, " ".join(item)), (2, " ".join(other))], "item_id long, text string")
    clean = decontaminate(df, bench)
    assert clean.schema == df.schema and clean.count() == 12
    got = {r.doc_id: r.text for r in clean.collect()}
    assert got[0].split() == ["a", "b"] and got[1] == "keep, THIS." and got[2] is None and got[3] == "" and len(got[4].split()) == 300_000 and got[5].split() == ["c", "d"]
    assert contamination(clean, bench).where("contaminated").count() == 0
    assert decontaminate(df, bench.where("false")).where("text is null").count() == 2


def test_jaccard_long_texts_and_clashes(spark):
    from sedge.llm.jaccard_join import jaccard_components

    r = random.Random(5)
    long = [f"w{r.randrange(10**6)}" for _ in range(60_000)]
    near = [*long[:20_000], *["other"] * 100, *long[20_100:]]
    rows = [(5, " ".join(long)), (3, " ".join(near)), (8, " ".join(long[:30_000])), (1, "short text of few words here")]
    df = spark.createDataFrame([(i, t, 1, 2, "n", "b") for i, t in rows], "doc_id long, text string, n int, rep int, carried string, block string")
    assert {r.doc_id: r.component_id for r in jaccard_components(df).collect()} == {5: 3, 3: 3, 8: 8, 1: 1}


def test_contamination_and_warc_with_clashing_columns(spark):
    from sedge.llm.decontamination import contamination

    bench = spark.createDataFrame([(1, "one two three", "x")], "item_id long, text string, doc_id string")
    df = spark.createDataFrame([(1, "ONE, two. three", 9, "s"), (None, "one two", 9, "s")], "doc_id long, text string, n_words int, spans string")
    assert {(r.doc_id, r.n_hit) for r in contamination(df, bench).collect()} == {(1, 3), (None, 0)}


def test_stages_on_odd_tables(spark, tmp_path):
    """Nulls, empty texts, repeated rows, clashing columns and an empty table through every stage."""
    import corpus_pipeline
    from sedge.llm.storage import new_folder, written

    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    real = spark.read.parquet(f"{SF}/documents.parquet")
    odd = real.limit(1).select(F.explode(F.array(F.lit(None).cast("string"), F.lit(""), F.lit(" "), F.lit("mail me at a.b@c.example.com now"))).alias("text"), *[c for c in real.columns if c != "text"])
    extra = [("row", "1"), ("node", "2"), ("__spans", "x"), ("length", "0"), ("hash", "h"), ("k", "7")]
    docs = real.unionByName(odd.select(real.columns).withColumn("doc_id", F.lit(None).cast("long"))).unionByName(real.limit(5))
    for name, value in extra:
        docs = docs.withColumn(name, F.lit(value))
    docs = docs.select("doc_id", "text", *[c for c in docs.columns if c not in ("doc_id", "text")])
    kept, empty = docs, docs.where("false")
    # fitting needs rows with labels, so the empty table goes through the stages one by one
    for name, stage in corpus_pipeline.STAGES:
        out = written(stage(spark, kept, str(tmp_path)), f"{new_folder(spark, 'odd')}/{name}")
        none = stage(spark, empty, str(tmp_path))
        assert none.count() == 0
        if name != "packing":
            assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in docs.schema] and [f.name for f in none.schema] == docs.columns
        if name == "near_duplicates":
            ids = [r.doc_id for r in out.select("doc_id").where("doc_id is not null").collect()]
            assert len(ids) == len(set(ids))
        kept = out
    assert kept.count() > 0


def test_folders_are_released(spark):
    from pyarrow import fs

    from sedge.llm.storage import filesystem, new_folder, release, written

    folder = new_folder(spark, "released")
    written(spark.range(3), folder)
    store, path = filesystem(folder)
    assert store.get_file_info(path).type == fs.FileType.Directory
    release()
    assert store.get_file_info(path).type == fs.FileType.NotFound
