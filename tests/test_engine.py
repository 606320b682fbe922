"""Markdown, statements, index, sources, sinks: literals and random texts against plain loops."""

import random
import re

import pytest
from pyspark.sql import functions as F

from sedge.operators import index, markdown, matter, statements
from sedge.sources import config


def one(spark, column, *values):
    return [r[0] for r in spark.createDataFrame([(v,) for v in values], "t string").select(column(F.col("t"))).collect()]


def test_paragraphs(spark):
    cases = {
        "a\nb\n\nc  \nd\\\ne\n": "a b\n\nc  \nd\\\ne\n",
        "one\n  two  \nthree": "one two\nthree",
        "# h\nx\ny\n- i\nz": "# h\nx y\n- i\nz",
        "a\nTitle\n---\nb\nc": "a\nTitle\n---\nb c",
        "```\na\nb\n~~~\n```\nc\nd": "```\na\nb\n~~~\n```\nc d",
        "~~~\na\nb": "~~~\na\nb",
        "> q\nr\n| t |\n<div>\n    code\n1. n\n***\nx": "> q\nr\n| t |\n<div>\n    code\n1. n\n***\nx",
        "a\r\nb": "a b",
        "": "",
        "x\n": "x\n",
    }
    assert one(spark, markdown.paragraphs, *cases) == list(cases.values())


def test_paragraphs_are_the_fold(spark):
    r = random.Random(6)
    parts = ["word", "two words", "", "  ", "# h", "- i", "> q", "```", "~~~", "===", "---", "end  ", "end\\", "    code", "| t", "<b>", "1. n", "⟦IMG:0001⟧ x", " lead"]
    texts = ["\n".join(r.choices(parts, k=r.randrange(1, 40))) + "\n" * r.randrange(2) for _ in range(300)]

    def fold(text):
        lines, out, open_, mark = text.split("\n"), [], False, ""
        lines = lines[:-1] if lines[-1] == "" else lines
        for i, x in enumerate(lines):
            fence = re.match(markdown.FENCE, x)
            if fence or mark:
                mark = mark if not fence else fence[1][0] if not mark else "" if fence[1][0] == mark else mark
                out.append(x)
                open_ = False
                continue
            after = lines[i + 1] if i + 1 < len(lines) else ""
            if not x.strip() or re.match(markdown.STARTERS, x) or re.match(markdown.UNDERLINE, after):
                out.append(x)
                open_ = False
                continue
            if open_:
                out[-1] = out[-1].rstrip() + " " + x.strip()
            else:
                out.append(x)
            open_ = not re.search(markdown.HARD_BREAK, x)
        done = "\n".join(out)
        return done + "\n" if text.endswith("\n") and not done.endswith("\n") else done

    assert one(spark, markdown.paragraphs, *texts) == [fold(t) for t in texts]


def test_images(spark):
    text = 'see ![[a%20b.png|300]] and ![the cap](x/c+d.jpg "t") end\n```\n![no](n.png)\n```\n![](y/e.f.svg)![[z]]\n'
    got = one(spark, markdown.images, text, "plain\n", "")
    assert got[0].text == "see  and  end\n⟦IMG:0000⟧ a b\n⟦IMG:0001⟧ the cap\n```\n![no](n.png)\n```\n⟦IMG:0002⟧ z\n⟦IMG:0003⟧ e.f\n"
    assert [(i["index"], i.target, i.caption) for i in got[0].images] == [(0, "a b.png", ""), (1, "x/c+d.jpg", "the cap"), (2, "z", ""), (3, "y/e.f.svg", "")]
    assert got[1].text == "plain\n" and got[1].images == [] and got[2].text == ""


def test_statement_literals(spark):
    texts = ['a"b', "c\\frac", "l'eau", "x\ny\r\tz"]
    assert one(spark, statements.quoted, *texts) == ['"a\\"b"', '"c\\\\frac"', '"l\'eau"', '"x\\ny\\r\\tz"']
    df = spark.createDataFrame([("v", "T", "x", 3, None, True, 1.5)], "vid string, tag string, label string, page_no int, text string, flag boolean, size double")
    assert statements.vertex_values(df, properties=("label", "page_no", "text", "flag", "size")).first().value == '"v":("x", 3, "", true, 1.5)'


def test_statement_batches(spark):
    r = random.Random(3)
    values = [f"{k:05d}" + "x" * r.randrange(60) for k in range(900)]
    df = spark.createDataFrame([(1, "K", v[:5], v) for v in values], "doc_id int, kind string, key string, value string")
    want, held, weight = [], [], 0
    for v in values:
        if held and (len(held) >= 7 or weight + len(v) + 2 > 200):
            want.append(held)
            held, weight = [], 0
        held.append(v)
        weight += len(v) + 2
    want.append(held)
    got = statements.batched(df, ["doc_id"], 7, 200).orderBy("batch").collect()
    assert [x["values"] for x in got] == [", ".join(w) for w in want] and [x.n for x in got] == [len(w) for w in want]
    alone = spark.createDataFrame([(1, "K", "a", "y" * 500), (1, "K", "b", "z")], df.schema)
    assert [x.n for x in statements.batched(alone, ["doc_id"], 7, 200).orderBy("batch").collect()] == [1, 1]
    assert all(s.endswith(";") for s in statements.schema_statements(["Table", "Code"]))


def test_index(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2)], "chunk_id string, n int")
    new = spark.createDataFrame([("b", 5), ("b", 4), ("c", 6)], "chunk_id string, n int")
    assert sorted(map(tuple, index.upserted(old, new).collect())) == [("a", 1), ("b", 5), ("c", 6)]
    assert index.missing_keys(old) == list(index.METADATA) and len(index.METADATA) == 17
    df = spark.createDataFrame([(1, "", "text", 0, 0, 0), (1, "k", None, None, -1, None), (2, "k2", "text", 1, 0, 0)], "doc_id long, id string, label string, page_no int, order int, depth int")
    assert sorted((r.id, r.reason) for r in index.violations(df).collect()) == [("", "id is missing"), ("", "page is below 1"), ("k", "label is missing"), ("k", "order is missing or negative")]
    shares = spark.createDataFrame([("low tide", "Tide, low TIDE", "high")], "q string, a string, b string").select(index.lexical(F.col("q"), F.col("a")), index.lexical(F.col("q"), F.col("b"))).first()
    assert tuple(shares) == (1.0, 0.0)


def test_sources(spark):
    spec = '{"sources": [{"name": "shore", "glob": "x/**", "type": "html", "extra_skip_titles": ["Errata"], "cleaning": {"profiles": [{"name": "p", "detect": ".d", "content": ".c", "strip": [".s"]}]}}, {"name": "notes", "glob": "n/**", "type": "md", "skip_front_back_matter": false}]}'
    shore, notes = config.sources(spec)
    assert shore.needs_cleaning and not notes.needs_cleaning and shore.cleaning.profiles[0].strip == (".s",)
    files = spark.createDataFrame([("x/Index.html", 1), ("x/2. ERRATA.html", 1), ("x/Tides.html", 7)], "path string, modified long")
    assert [(r.path, r.run_key) for r in config.partitions(files, shore).collect()] == [("x/Tides.html", "shore_x/Tides.html_7")]
    assert config.ignored(files, shore).count() == 2 and config.partitions(files, notes).count() == 3
    for bad in ('{"sources": [{"name": "A", "glob": "x", "type": "md"}]}', '{"sources": [{"name": "a", "glob": "x", "type": "doc"}]}', '{"sources": [{"name": "a", "glob": "x", "type": "md"}, {"name": "a", "glob": "y", "type": "md"}]}'):
        with pytest.raises(ValueError):
            config.sources(bad)
    assert config.cursor('{"a": 1}') == {"a": 1.0} and config.cursor("{") == {} and config.cursor(None) == {}


def test_files_on_disk(spark, tmp_path):
    from sedge.sources import files

    (tmp_path / "Datas" / "b").mkdir(parents=True)
    (tmp_path / "Datas" / "b" / "x.MD").write_text("# x")
    found = files.discover(spark, str(tmp_path)).select(files.source_path(F.col("path")).alias("p"), files.kind_of(F.col("path")).alias("k")).collect()
    assert [(r.p, r.k) for r in found] == [("b/x.MD", "md")]
    assert one(spark, files.source_path, "/q/only.html", "/a/Datas/b/Datas/c.md") == ["only.html", "b/Datas/c.md"]
    with pytest.raises(Exception, match="unsupported format"):
        one(spark, files.kind_of, "a.docx")


def test_ingest_rejects_and_reports(spark, tmp_path):
    from sedge.streaming import ingest

    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(k, "Slack water lasts a short while here.\nThen it turns and runs again.", "en", "s", 60) for k in range(6)]
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "in"))
    spark.createDataFrame([(2, "A later, larger text of the same id.", "en", "t", 30)], schema).write.mode("append").parquet(str(tmp_path / "in"))
    ingest.ingest(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "check"))
    told = ingest.status(spark, str(tmp_path / "out")).collect()
    assert sum(r.documents for r in told) == 6 and all(r.rejects == 0 for r in told) and all(r.chunks > 0 for r in told)
    vectors = spark.read.parquet(str(tmp_path / "out" / "chunks"))
    assert vectors.where("size(embedding) <> 64").count() == 0 and {r.tag for r in spark.read.parquet(str(tmp_path / "out" / "vertices")).select("tag").distinct().collect()}
    assert ingest.without(spark, str(tmp_path / "out"), "chunks", vectors.where("doc_id = 1")).where("doc_id = 1").count() == 0


def test_paged_ranks_of_headings(spark):
    h = spark.createDataFrame([(1, k, s) for k, s in enumerate([20.0, 14.0, 9.0, 20.0])] + [(2, 0, 9.0)], "doc int, order int, size double")
    ranks = spark.createDataFrame([(1, 20.0, 0), (1, 14.0, 1)], "doc int, size double, rank int")
    free = h.where("not (doc = 1 and `order` = 3)").select("doc", "order")
    got = {(r.doc, r.order): r["rank"] for r in matter.paged_ranks(h, ranks, free).collect()}
    assert got == {(1, 0): 0, (1, 1): 1, (1, 2): 2, (1, 3): 2, (2, 0): None}
