import random

import pytest
from pyspark.sql import functions as F

from sedge.functions import text as T
from sedge.operators import chunks, elements, matter


def rows(df, *columns):
    return [tuple(r[c] for c in columns) for r in df.collect()]


@pytest.mark.parametrize(
    "path, key, filename, collection",
    [
        ("library/Harbour Tides/2. Slack water.html", "library/Harbour Tides/2. Slack water", "2. Slack water", "Harbour Tides"),
        (".cleaned/library/Harbour Tides/Foreword.html", "library/Harbour Tides/Foreword", "Foreword", "Harbour Tides"),
        ("library\\Sel et vent\\Marées.html", "library/Sel et vent/Marées", "Marées", "Sel et vent"),
        ("jottings/moon", "jottings/moon", "moon", ""),
    ],
)
def test_identity(spark, path, key, filename, collection):
    r = spark.createDataFrame([(path,)], "p string").select(elements.identity(F.col("p")).alias("i")).first().i
    assert (r.key, r.filename, r.collection) == (key, filename, collection)


def test_document_vid_fits_and_differs(spark):
    keys = ["tides", "é" * 400, "a" * 300 + "x", "a" * 300 + "y"]
    got = [r[0] for r in spark.createDataFrame([(k,) for k in keys], "k string").select(elements.document_vid(F.col("k"))).collect()]
    assert got[0] == "doc_tides" and len(set(got)) == 4 and all(len(v.encode()) <= 256 for v in got)


@pytest.mark.parametrize(("ranks", "most"), [(7, 7), (13, 13), (None, 40)])
def test_heading_tree_is_the_stack(spark, ranks, most):
    random.seed(5)
    data, want = [], {}
    for doc in range(20):
        stack = []
        for k in range(30 if doc else 700):
            rank = random.randrange(most)
            data.append((doc, "k", k, 1, f"t{k}", "heading", rank))
            while stack and stack[-1][1] >= rank:
                stack.pop()
            depth = min(stack[-1][2] + 1, 3) if stack else 0
            want[doc, k] = (stack[-1][0] if stack else None, depth)
            stack.append((k, rank, depth))
    df = spark.createDataFrame(data, "doc_id long, key string, pos int, page_no int, text string, label string, heading_rank int")
    df = elements.with_positions(df).withColumn("id", F.col("pos").cast("string"))
    got = {(r.doc_id, r.pos): (None if r.reference_id == "DOC" else int(r.reference_id), r.depth) for r in elements.with_headings(df, ranks).collect()}
    assert got == want
    if ranks:
        with pytest.raises(Exception, match="not below the given bound"):
            elements.with_headings(df, ranks - 1).collect()


def test_walk_goes_all_the_way_up(spark):
    from sedge.operators import graph

    chain = [(1, f"n{k}" if k else "doc_x", f"n{k + 1}", "PARENT_OF") for k in range(12)]
    df = spark.createDataFrame([*chain, (2, "doc_y", "n1", "PARENT_OF")], "doc_id long, src string, dst string, edge_type string")
    walks = graph.ancestors(df)
    assert walks.where("doc_id = 1").agg(F.max("hops")).first()[0] == 12 and walks.where("doc_id = 1").count() == 78
    assert {(r.doc_id, r.node) for r in graph.document_of(walks).collect()} == {(1, f"n{k}") for k in range(1, 13)} | {(2, "n1")}


def test_window_edges():
    assert chunks.window_spans("", 100, 20) == [] and chunks.window_spans("  a ", 100, 20) == ["a"]
    parts = chunks.window_spans("x" * 1000, 100, 20)
    assert all(0 < len(p) <= 100 for p in parts)
    words = " ".join(f"mot{i}" for i in range(500))
    assert all(len(p) <= 200 for p in chunks.window_spans(words, 200, 50))
    with pytest.raises(ValueError):
        chunks.chunk_windows(None, 100, 100)


def test_blocks_fuse_within_section_and_target(spark):
    data = [(1, k, str(k), "text", t, s) for k, (t, s) in enumerate([("Premiere phrase.", "a"), ("|---|", "a"), ("Seconde phrase.", "a"), ("b" * 30, "b"), ("c" * 890, "b")])]
    df = spark.createDataFrame(data, "doc_id long, order int, id string, label string, text string, reference_id string")
    got = sorted(rows(chunks.build_blocks(df, target=900, least=10), "block", "anchor", "text"))
    assert [(b, a) for b, a, _ in got] == [(0, "0"), (1, "3"), (2, "4")] and got[0][2] == "Premiere phrase.\nSeconde phrase."


def test_language(spark):
    en = "the cat is in the house and it was happy that you have more of the fish which they would be with this " * 2
    fr = "les chats sont dans une maison avec des amis et nous avons pour vous tout cette nuit mais pas plus sur leur lit " * 2
    it = "gli amici sono una bella compagnia per tutti perche questo mare non ha molto vento quando ogni barca parte dopo il sole e anche la luna che sempre torna senza fretta verso il porto " * 2
    nl = "het schip is niet van de haven maar een boot die met ons naar zee vaart en ook door de storm zoals het altijd was zonder angst voor het water " * 2
    pt = "os barcos são uma forma de viver para quem não tem pressa e também gosta muito do mar quando todos voltam depois pelo vento até ao porto com seus filhos " * 2
    got = [r[0] for r in spark.createDataFrame([(x,) for x in (en, fr, it, nl, pt, "short", "", None)], "t string").select(T.detect_language(F.col("t"))).collect()]
    assert got == ["en", "fr", "it", "nl", "pt", "", "", ""]
    folded = spark.createDataFrame([("ÀẾÑ ｆｕｌｌ ⓐ e\u0301",)], "t string").select(T.folded(F.col("t"))).first()[0]
    assert folded == "aen full a e"


def test_no_word_belongs_to_two_languages():
    words = [w for w, _ in T.exclusive_words()]
    assert len(words) == len(set(words))


def test_skipped_and_kept_pages(spark):
    toc = [("a", 1, 1, "Front Cover", 1), ("a", 2, 1, "Credits", 2), ("a", 3, 1, "TOC", 6), ("a", 4, 1, "Of tides", 9), ("a", 5, 1, "Slack water", 31), ("a", 6, 2, "Neap", 37), ("a", 7, 1, "Indexes", 191), ("b", 1, 1, "Moorings", 18), ("b", 2, 2, "Index", 33), ("c", 1, 1, "Sommaire", 1), ("d", 1, 1, "Colophon", 640)]
    toc = spark.createDataFrame(toc, "doc string, pos int, level int, title string, page int")
    totals = spark.createDataFrame([("a", 200), ("b", 40), ("c", 250), ("d", 90)], "doc string, pages int")
    skipped = matter.skipped_pages(matter.toc_spans(toc, totals))
    got = sorted(rows(matter.kept_ranges(totals, skipped), "doc", "first", "last"))
    assert got == [("a", 9, 190), ("b", 1, 32), ("c", 1, 250), ("d", 1, 90)]
    sampled = matter.sampled_pages(matter.kept_ranges(totals, skipped)).where("doc = 'b'")
    assert sorted(x for (x,) in rows(sampled, "page")) == sorted({int(i * 32 / 20) + 1 for i in range(20)})


@pytest.mark.parametrize(("title", "normal", "skipped"), [("4. Moorings", "moorings", False), ("7) Credits", "credits", True), ("B. Buoys and bells", "buoys and bells", False), ("Dédicace", "dedicace", True), ("88", "88", False), ("  Back   — Cover?  ", "back cover", True)])
def test_titles(spark, title, normal, skipped):
    r = spark.createDataFrame([(title,)], "t string").select(T.normal_title(F.col("t")), T.is_matter(F.col("t"))).first()
    assert tuple(r) == (normal, skipped)


def test_outside_figures(spark):
    schema = "doc int, page int, order int, l double, b double, r double, t double"
    figures = spark.createDataFrame([(1, 1, 0, 100.0, 100.0, 400.0, 300.0)], schema)
    heads = spark.createDataFrame([(1, 1, 1, 150.0, 150.0, 300.0, 200.0), (1, 1, 2, 99.0, 99.0, 401.0, 301.0), (1, 1, 3, 150.0, 400.0, 300.0, 450.0), (1, 1, 4, 50.0, 150.0, 300.0, 200.0)], schema)
    assert sorted(x for (x,) in rows(matter.outside_figures(heads, figures), "order")) == [3, 4]


def test_stream_ingest_is_incremental(spark, tmp_path):
    from sedge.streaming.ingest import ingest

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    docs.where("doc_id < 20").write.parquet(str(tmp_path / "in"))
    ingest(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "check"))
    docs.where("doc_id between 20 and 29").write.mode("append").parquet(str(tmp_path / "in"))
    ingest(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "check"))
    assert spark.read.parquet(str(tmp_path / "out/elements")).select("doc_id").distinct().count() == 30


def test_language_sample_goes_on_to_20000_characters(spark, tmp_path):
    from sedge.plans import catalogue

    lines = ["a" * 1000] * 25
    spark.createDataFrame([(1, "x", "\n".join(lines))], "doc_id long, source string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert [r["sample"] for r in catalogue.queries()["language_sample"](spark, str(tmp_path)).collect()] == [" ".join(lines[:20])]


def test_chunk_records_move_documents_once(spark, tmp_path):
    from sedge.plans import catalogue

    lines = "\n".join(f"Line {k} of a log about tides." for k in range(25))
    table = [(1, lines, "en", "x"), (2, "short", None, None), (3, None, "fr", "y"), (4, lines, "en", "x")]
    spark.createDataFrame(table, "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    keep = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = catalogue.queries()["chunk_records"](spark, str(tmp_path))
        plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", keep)
    assert plan.count("Exchange hashpartitioning") == 2  # the texts, and what is joined to them
    got = sorted((r for r in found.collect() if r.filename == "1"), key=lambda r: int(r.document.split()[1]))
    assert [r.document for r in got] == ["\n".join(lines.split("\n")[k : k + 3]) for k in range(0, 25, 3)]
    assert [(r.chunk_index, r.chunk_count, r.block_size) for r in got] == [(0, 2, 3), (1, 2, 3), (0, 2, 2), (1, 2, 3), (0, 1, 2), (0, 2, 3), (1, 2, 2), (0, 2, 3), (1, 2, 1)]


def test_anchors_of_two_tables(spark):
    known = spark.createDataFrame([(1, "a", 0, "i0"), (1, "a", 1, "i1"), (1, "b", 2, "i2"), (2, None, 0, "j0")], "doc_id long, self_ref string, order int, id string")
    refs = spark.createDataFrame([(1, 0, 0, "?", "x"), (1, 0, 1, "b", "y"), (1, 0, 2, "a", None), (1, 1, 0, "b", "z"), (1, 2, 0, "?", "w"), (2, 0, 0, None, "v"), (2, 1, 0, "a", "u")], "doc_id long, chunk int, at int, ref string, text string")
    got = chunks.anchored(known.unionByName(refs, allowMissingColumns=True), ("order",), texts=True)
    assert sorted(rows(got, "doc_id", "chunk", "id", "order", "block_size", "chunk_index", "chunk_count", "text")) == [(1, 0, "i2", 2, 2, 0, 2, "x\ny"), (1, 1, "i2", 2, 1, 1, 2, "z")]
