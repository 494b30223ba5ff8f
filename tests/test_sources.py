import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from lectern.sources import halves, readers, writers


def test_jsonl_types_and_blank_lines(spark, tmp_path):
    node = {"id": "a", "citation": "c", "text": "x", "segments": [], "citations_out": [], "type": "verse"}
    other = {"id": "b", "citation": "d", "text": "y", "segments": [{"role": "r", "text": "y"}], "citations_out": []}
    (tmp_path / "n.jsonl").write_text(json.dumps(node) + "\n\n" + json.dumps(other) + "\n")
    df = readers.scan_jsonl(spark, str(tmp_path / "*.jsonl"))
    assert dict(df.dtypes)["segments"].startswith("array<struct<role:string,n:int")
    assert sorted(r.id for r in df.collect()) == ["a", "b"]
    assert [r.id for r in readers.scan_jsonl_filtered(spark, str(tmp_path / "*.jsonl")).collect()] == ["b"]


def test_adjacency_round_trip_and_missing(spark, tmp_path):
    edges = spark.createDataFrame([("john/1", "b", "B"), ("john/1", "a", "A"), ("mark/2", "c", None)], "key string, id string, citation string")
    writers.sink_adjacency(edges, str(tmp_path / "adj"), "key", ["id", "citation"], 10)
    back = readers.scan_adjacency(spark, str(tmp_path / "adj"), "struct<id:string,citation:string>").collect()
    assert sorted((r.key, r.pos, r.id) for r in back) == [("john/1", 0, "a"), ("john/1", 1, "b"), ("mark/2", 0, "c")]
    many = spark.createDataFrame([("k", f"{i:03d}") for i in range(57)] + [("l", "x")], "key string, id string").repartition(5)
    writers.sink_adjacency(many, str(tmp_path / "many"), "key", ["id"], 10)
    back = readers.scan_adjacency(spark, str(tmp_path / "many"), "struct<id:string>").where("key = 'k'").collect()
    assert sorted((r.pos, r.id) for r in back) == [(i, f"{i:03d}") for i in range(57)]
    assert readers.scan_adjacency(spark, str(tmp_path / "nothing")).count() == 0
    (tmp_path / "one.json").write_text(json.dumps({"k": [{"id": "z"}], "l": []}, indent=0))
    assert [r.id for r in readers.scan_adjacency(spark, str(tmp_path / "one.json"), whole=True).collect()] == ["z"]


def test_cp1252(spark, tmp_path):
    (tmp_path / "x.lat").write_bytes("1:1 cœlum “q”, \"b\"\r\n1:2 Noë\n".encode("cp1252"))
    assert sorted(r.value for r in readers.scan_cp1252(spark, str(tmp_path)).collect()) == ['1:1 cœlum “q”, "b"', "1:2 Noë"]
    assert readers.scan_cp1252_files(spark, str(tmp_path)).first().text.startswith("1:1 cœlum “q”")


def test_whole_and_separated_text(spark, tmp_path):
    (tmp_path / "t.txt").write_text("a\nb\n##\nc\n##\n")
    assert [r.text for r in readers.scan_wholetext(spark, str(tmp_path / "t.txt")).collect()] == ["a\nb\n##\nc\n##\n"]
    assert sorted(r.text for r in readers.scan_wholetext(spark, str(tmp_path / "t.txt"), "\n##\n").collect()) == ["a\nb", "c"]


def test_half_precision_file(spark, tmp_path):
    """A file and a list of ids as another program writes them, in splits of every size."""
    v = np.random.default_rng(1).normal(size=(50, 8)).astype("<f2")
    (tmp_path / "v.bin").write_bytes(v.tobytes())
    (tmp_path / "v.json").write_text(json.dumps({"dims": 8, "count": 50, "ids": [f"n{i}" for i in range(50)]}))
    for split in (1000, 7):
        held = halves.scan_file(spark, str(tmp_path / "v.bin"), str(tmp_path / "v.json"), split)
        assert held.rdd.getNumPartitions() == -(-50 // split) and held.dtypes == [("id", "string"), ("vector", "array<float>")]
        rows = held.collect()
        assert len(rows) == 50 and all(np.array_equal(np.float32(v[int(r.id[1:])]), np.float32(r.vector)) for r in rows)
    (tmp_path / "v.bin").write_bytes(v.tobytes()[:-1])
    with pytest.raises(Exception, match="bytes where"):
        halves.scan_file(spark, str(tmp_path / "v.bin"), str(tmp_path / "v.json")).count()


def test_half_precision_round_trip(spark, tmp_path):
    x = np.random.default_rng(2).normal(size=(300, 5))
    x[7] = 0
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "id long, vector array<float>").repartition(4)
    path = str(tmp_path / "t")
    halves.sink(df.where("id < 200"), path, split=16)
    halves.sink(df.where("id >= 200"), path, split=16)
    meta = json.loads((tmp_path / "t" / "meta.json").read_text())
    assert meta["count"] == 300 and meta["dims"] == 5 and sum(p["rows"] for p in meta["parts"]) == 300
    got = {r.id: r.vector for r in halves.scan(spark, path).collect()}
    want = x.astype(np.float32).astype(float) / np.maximum(np.linalg.norm(x.astype(np.float32).astype(float), axis=1, keepdims=True), 1e-30)
    assert len(got) == 300 and all(np.array_equal(np.float32(want[i].astype("<f2")), np.float32(got[i])) for i in range(300))
    halves.sink(df.where("id = 3"), path, overwrite=True)
    assert [r.id for r in halves.scan(spark, path).collect()] == [3] and len(list((tmp_path / "t").glob("*.f16.bin"))) == 1


def test_broken_write_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    halves.sink(spark.createDataFrame([(1, [1.0, 0.0])], "id long, vector array<float>"), path)
    for bad in ([(2, [1.0, 0.0]), (3, None)], [(2, [1.0, 0.0, 0.0])], [(2, [1.0, 0.0]), (3, [1.0])]):
        with pytest.raises(Exception):
            halves.sink(spark.createDataFrame(bad, "id long, vector array<float>"), path)
        assert [(r.id, r.vector) for r in halves.scan(spark, path).collect()] == [(1, [1.0, 0.0])]


def test_lectionary_whole_file(spark, tmp_path):
    (tmp_path / "g.json").write_text(json.dumps({"2026-07-10": {"gospel": "Matthew 10:16-23", "day": "Friday"}}, indent=0))
    row = readers.scan_lectionary(spark, str(tmp_path / "g.json"), whole=True).first()
    assert (str(row.date), row.gospel, row.day) == ("2026-07-10", "Matthew 10:16-23", "Friday")


def test_partitioned_nodes_and_stats(spark, tmp_path):
    nodes = spark.createDataFrame([("i", f"q{i:03d}", "x") for i in range(20)] + [("iii", "q1", "y")], "part string, id string, text string")
    writers.sink_jsonl_partitioned(nodes, str(tmp_path / "n"), "part", ["id"])
    assert sorted(p.name for p in (tmp_path / "n").iterdir() if p.is_dir()) == ["part=i", "part=iii"]
    writers.sink_stats(nodes.agg(F.count("*").alias("n"), F.max(F.lit(None).cast("int")).alias("none")), str(tmp_path / "s"))
    assert readers.read_json_object(spark, str(tmp_path / "s")) == {"n": 21, "none": None}


def test_html_pages(spark, tmp_path):
    (tmp_path / "p.htm").write_text("<p>é</p>", encoding="utf-8")
    (tmp_path / "q.html").write_bytes(b"<p>a\xffb\xc3</p>")
    rows = sorted((r.url.rsplit("/", 1)[1], r.html) for r in readers.scan_html_pages(spark, str(tmp_path)).collect())
    assert rows == [("p.htm", "<p>é</p>"), ("q.html", "<p>a\ufffdb\ufffd</p>")]


def test_last_verse_wins(spark, tmp_path):
    line = lambda i, t: json.dumps({"id": i, "verse_key": "john/1/1", "text": t, "citation": "c", "book": "John", "chapter": 1, "verse": 1})
    (tmp_path / "a.jsonl").write_text(line("z", "first") + "\n" + line("y", "second") + "\n")
    (tmp_path / "b.jsonl").write_text(line("b", "third") + "\n" + line("a", "last") + "\n")
    rows = readers.scan_verse_map(spark, str(tmp_path)).collect()
    assert [(r.verse_key, r.id, r.text) for r in rows] == [("john/1/1", "a", "last")]


def test_vectors_of_one_length(spark):
    from lectern.functions.vectors import dot_with, pack_f16, unpack_f16

    df = spark.createDataFrame([(1, [3.0, 4.0]), (2, None), (3, [0.0, 0.0])], "id int, v array<float>").coalesce(1)
    back = {r.id: r.w for r in df.select("id", unpack_f16(pack_f16("v")).alias("w")).collect()}
    assert back[2] is None and back[3] == [0.0, 0.0] and np.allclose(back[1], [0.6, 0.8], atol=1e-3)
    assert [r.s for r in df.select(dot_with(F.col("v"), [1.0, 2.0]).alias("s")).collect()] == [11.0, None, 0.0]
    odd = spark.createDataFrame([(1, [1.0, 0.0, 0.0]), (2, [1.0])], "id int, v array<float>").coalesce(1)
    with pytest.raises(Exception, match="components"):
        odd.select(dot_with(F.col("v"), [1.0, 0.0]).alias("s")).collect()


def test_pages_as_files_of_their_own(spark, tmp_path):
    """Many pages cost no folder each; rows of one page share its file, a null is an empty line."""
    pages = [(i, f"<p>{i}</p>".encode()) for i in range(2500)] + [(7, b"again\xff"), (9000, None)]
    df = spark.createDataFrame(pages, "page_id long, value binary").repartition(2, "page_id")
    writers.sink_pages(df, str(tmp_path / "w"))
    held = {p.name: p.read_bytes() for p in (tmp_path / "w").rglob("*.txt")}
    assert len(held) == 2501 and len([p for p in (tmp_path / "w").iterdir() if p.is_dir()]) <= 4
    assert held["page_id=12.txt"] == b"<p>12</p>\n" and held["page_id=9000.txt"] == b"\n"
    assert sorted(held["page_id=7.txt"].split(b"\n")) == [b"", b"<p>7</p>", b"again\xff"]
    read = readers.scan_html_pages(spark, str(tmp_path / "w"), "*.txt")
    assert read.columns == ["url", "html"] and read.count() == 2501
    writers.sink_pages(df.limit(0), str(tmp_path / "none"))
    assert readers.scan_html_pages(spark, str(tmp_path / "none"), "*.txt").count() == 0


def test_bundle_stores_only_what_it_writes(spark, monkeypatch):
    from lectern.plans import corpus, q_sources

    stored = {}
    settle = q_sources.settle
    monkeypatch.setattr(q_sources, "settle", lambda df, label: stored.setdefault(label, settle(df, label)))
    out = {r.subset: r.rows for r in q_sources.export_bundle(corpus.Tables(spark, "/root/testdata/sf0.001")).collect()}
    assert out["articles"] == out["teaching"] == spark.read.parquet("/root/testdata/sf0.001/documents.parquet").count()
    assert stored["articles"].columns == ["id", "citation", "title", "text", "noted_text", "citations_out"]
