"""Jobs, property filters and mirrored paths: against plain loops."""

import random

from pyspark.sql import functions as F

from sedge.operators import elements, graph, index, jobs, pages


def test_served_like_a_loop(spark):
    rng = random.Random(5)
    rows = [(q, k, rng.randrange(40_000), rng.choice([0, 1, 30, 900])) for k, q in enumerate(rng.choices("abc", [6, 2, 1], k=400))]
    rows += [("d", 1000 + k, 7, 5) for k in range(6)]  # arrivals that tie go by id
    rows += [("e", 2000, -5000, 20_000), ("e", 2001, 14_000, 1)]  # a long job that later blocks wait for
    want = {}
    for q in "abcde":
        free = -(10**9)
        for _, k, at, lasts in sorted((r for r in rows if r[0] == q), key=lambda r: (r[2], r[1])):
            free = max(free, at) + lasts
            want[k] = (free - lasts, free)
    df = spark.createDataFrame(rows, "queue string, job_id long, at long, lasts long")
    for block in (100, 5000, 10**9):
        assert {r.job_id: (r.begins, r.ends) for r in jobs.served(df, block=block).collect()} == want
    assert jobs.served(df.limit(0)).count() == 0


def test_failures_pages_and_progress(spark):
    df = spark.createDataFrame([("ValueError", "no page"), ("KeyError", None)], "k string, m string")
    assert [r[0] for r in df.select(jobs.failure(F.col("k"), F.col("m"))).collect()] == ["ValueError: no page", "KeyError: "]
    expected = spark.createDataFrame([(1, p) for p in (1, 2, 2, 10, 3)] + [(2, 1)], "doc_id long, page_no int")
    found = spark.createDataFrame([(1, 1), (2, 1)], "doc_id long, page_no int")
    assert [tuple(r) for r in jobs.left_out(expected, found).collect()] == [(1, 3, "2, 3, 10")]
    assert sorted(map(tuple, jobs.progress(expected, found.where("doc_id = 2")).collect())) == [(1, 5, 10, 0), (2, 1, 1, 1)]


def test_matching_and_nodes(spark):
    df = spark.createDataFrame([("a", "en", 1), ("b", None, 2), (None, None, 3)], "collection string, lang string, n int")
    assert [r.n for r in graph.matching(df, lang=None, collection="b").collect()] == [2]
    assert graph.matching(df).count() == 3 and graph.matching(df, collection="c").count() == 0
    chunks = spark.createDataFrame([("x", "x"), ("y#1", "y"), ("z", "gone")], "chunk_id string, graph_node_id string")
    vertices = spark.createDataFrame([("x", "Paragraph", 1), ("y", "Picture", 4)], "vid string, tag string, page_no int")
    assert sorted(map(tuple, index.nodes_of(chunks, vertices).collect())) == [("x", "x", "Paragraph", 1), ("y#1", "y", "Picture", 4)]


def test_mirror_keeps_identity(spark, tmp_path):
    df = spark.createDataFrame([("docs/shore/tide.html", "<p>a</p>"), ("\\docs\\shore\\reef.htm", "<p>b</p>")], "partition_key string, html string")
    for _ in range(2):
        pages.write_mirror(df, str(tmp_path / "mirror"))
    got = {r.path: r.html for r in spark.read.parquet(str(tmp_path / "mirror")).collect()}
    assert got == {".cleaned/docs/shore/tide.html": "<p>a</p>", ".cleaned/docs/shore/reef.htm": "<p>b</p>"}
    keys = df.select(elements.identity(F.col("partition_key"))["key"].alias("a"), elements.identity(pages.mirrored(F.col("partition_key")))["key"].alias("b"))
    assert all(r.a == r.b for r in keys.collect())
