import hashlib

from pyspark.sql import functions as F

from terrafold.sources import footer, manifest, textual


def test_geojson_sequence(spark, tmp_path):
    (tmp_path / "a.geojsonseq").write_text(
        '\x1e{"type":"Feature","properties":{"name":"区","admin_level":"7"},'
        '"geometry":{"type":"Polygon","coordinates":[[[0,0],[1,0],[1,1],[0,0]]]}}\n'
        '\n{"type":"Feature","properties":{},"geometry":{"type":"Point","coordinates":[1.5,2]}}\n', "utf-8")
    rows = textual.read_geojson_lines(spark, str(tmp_path)).collect()
    assert sorted(r["geometry_type"] for r in rows) == ["Point", "Polygon"]
    poly = next(r for r in rows if r["geometry_type"] == "Polygon")
    assert poly["properties"] == {"name": "区", "admin_level": "7"}
    df = spark.createDataFrame([(poly["coordinates"],)], "c string")
    assert [tuple(p) for p in df.select(textual.polygon_rings(F.col("c"))).first()[0][0]] == [
        (0, 0), (1, 0), (1, 1), (0, 0)]


def test_element_text(spark, tmp_path):
    (tmp_path / "x.opl").write_text(
        "n5 v1 x1 y2\nw7 v1 Nn1,n2\nr9 v1 Tname=M Mw12@outer,n3@,w-4@inner,r8@sub\nr10 v1 M\nr11 v1\n# note\n")
    rows = {(r["kind"], r["id"]): r["members"] for r in textual.read_opl(spark, str(tmp_path)).collect()}
    assert sorted(rows) == [("n", 5), ("r", 9), ("r", 10), ("r", 11), ("w", 7)]
    assert [tuple(m) for m in rows[("r", 9)]] == [
        ("w", 12, "outer"), ("n", 3, ""), ("w", -4, "inner"), ("r", 8, "sub")]
    assert rows[("r", 10)] == [] and rows[("r", 11)] is None
    members = textual.opl_members(textual.read_opl(spark, str(tmp_path))).collect()
    assert sorted((m["rel_id"], m["pos"], m["ref"]) for m in members) == [(9, 0, 12), (9, 2, -4)]


def test_manifest_and_drift(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    files = {"a.bin": b"x" * 10_000_000, "sub/b.bin": b"", "sub/c.bin": b"c"}
    for name, data in files.items():
        (tmp_path / name).write_bytes(data)
    got = manifest.manifest(spark, str(tmp_path))
    assert {r["name"]: (r["size"], r["digest"]) for r in got.collect()} == {
        n: (len(d), hashlib.md5(d).hexdigest()) for n, d in files.items()}
    assert [r["name"] for r in manifest.numbered(got).collect()] == sorted(files)
    record = spark.createDataFrame([("a.bin", "old"), ("sub/b.bin", hashlib.md5(b"").hexdigest()),
                                    ("gone", "x")], "name string, digest string")
    assert {r["name"]: r["status"] for r in manifest.drift(record, got).collect()} == {
        "a.bin": "changed", "sub/c.bin": "unrecorded", "gone": "missing"}


def test_footer_of_several_files(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100, numPartitions=4).withColumn("s", F.lit("v")).write.parquet(path)
    chunks = footer.chunks(spark, path)
    assert chunks.count() == 8
    assert footer.files(chunks).agg(F.sum("num_rows")).first()[0] == 100
    ids = chunks.where("column = 'id'").agg(F.min("min_int"), F.max("max_int")).first()
    assert tuple(ids) == (0, 99)
    kv = footer.key_values(spark, path)
    assert kv.where("key LIKE 'org.apache.spark%'").count() > 0
