"""Objects cut at every place against a JSON parser."""

import json
import random
import time

import pyarrow as pa
import pytest

from lectern.sources import bigjson, readers, writers


def flat(obj):
    out = []
    for k, v in obj.items():
        out += [(k, i, e) for i, e in enumerate(v)] if isinstance(v, list) else [(k, None, v)]
    return sorted(out, key=str)


def told(df):
    return sorted(((r.key, r.pos, json.loads(r.value)) for r in df.collect()), key=str)


def odd(rng):
    text = lambda: "".join(rng.choices(['"', "\\", "{", "}", "[", "]", ",", ":", " ", "\n", "é", "\U0001f600", "a", "b"], k=rng.randrange(0, 9)))
    value = lambda d: rng.choice([text(), 1.5, None, True]) if d > 2 or rng.random() < 0.4 else (
        {text(): value(d + 1) for _ in range(rng.randrange(3))} if rng.random() < 0.5 else [value(d + 1) for _ in range(rng.randrange(4))])
    return {text() + str(i): value(0) for i in range(rng.randrange(1, 14))}


@pytest.mark.parametrize("split", [1, 7, 64])
def test_cut_anywhere(spark, tmp_path, split, monkeypatch):
    monkeypatch.setattr(bigjson, "TAIL", 8)
    rng = random.Random(split)
    whole = {}
    for n in range(4):
        obj = {f"{n}/{k}": v for k, v in odd(rng).items()}
        whole |= obj
        (tmp_path / f"{n}.json").write_text(json.dumps(obj, ensure_ascii=n % 2 == 0, indent=[None, 2][n // 2]))
    (tmp_path / "_skipped").write_text("{")
    (tmp_path / "empty.json").write_text("{}")
    spans = sum(p.stat().st_size for p in tmp_path.glob("*.json"))
    if split == 1 and spans > 900:
        split = 3
    assert told(bigjson.scan_object(spark, str(tmp_path), split)) == flat(whole)


def test_long_list_and_missing_files(spark, tmp_path):
    obj = {"a": [], "hot": [{"id": f'x"{i}', "n": [i]} for i in range(5000)], "z": [{"id": "last", "n": []}]}
    (tmp_path / "o.json").write_text(json.dumps(obj))
    found = bigjson.scan_object(spark, str(tmp_path / "o.json"), 10_000)
    assert found.rdd.getNumPartitions() > 5 and told(found) == flat(obj)
    assert bigjson.scan_object(spark, str(tmp_path / "none.json")).count() == 0
    (tmp_path / "cut.json").write_text(json.dumps(obj)[:-5])
    with pytest.raises(ValueError, match="no whole JSON"):
        bigjson.scan_object(spark, str(tmp_path / "cut.json"), 10_000)


def test_adjacency_as_one_object_a_file(spark, tmp_path):
    rows = [(f"k{i % 7}", f"id{i:03d}", f"c {i}") for i in range(60)]
    edges = spark.createDataFrame(rows, "key string, id string, citation string")
    writers.sink_adjacency(edges, str(tmp_path / "w"), "key", ["id", "citation"], 5, whole=True)
    files = [p for p in (tmp_path / "w").glob("part-*") if p.stat().st_size]
    assert all(isinstance(json.loads(p.read_text()), dict) for p in files)
    got = readers.scan_adjacency(spark, str(tmp_path / "w"), "struct<id:string,citation:string>", whole=True).collect()
    want = [(k, i, r[1], r[2]) for k in {r[0] for r in rows} for i, r in enumerate(sorted(r for r in rows if r[0] == k))]
    assert sorted(map(tuple, got)) == sorted(want)


def test_many_keys_in_one_split(tmp_path):
    """The time goes with the bytes of a split, not with its bytes times its keys."""
    obj = {f"book/{i}": [{"id": str(i), "ref": "x" * 40}] for i in range(60_000)}
    path = tmp_path / "o.json"
    path.write_text(json.dumps(obj))
    size, begun = path.stat().st_size, time.monotonic()
    span = {"file": str(path), "number": 0, "begin": 0, "end": size, "size": size, "inside": 0, "depth": 0, "kind": 0, "key": None, "pos": 0}
    rows = pa.Table.from_batches(list(bigjson._rows([pa.RecordBatch.from_pylist([span])]))).to_pylist()
    assert [(r["key"], r["pos"], json.loads(r["value"])) for r in rows] == [(k, 0, v[0]) for k, v in obj.items()]
    assert time.monotonic() - begun < 15
