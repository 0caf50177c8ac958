"""Sources, sinks, joins and preparation on small tables."""

import pytest
from pyspark.sql import functions as F

from vanewright.operators import joins
from vanewright.plans import prep
from vanewright.schemas import FEATURES, fleet_schema
from vanewright.sources import packets, scans, sinks


def test_fleet_schema_has_43_columns():
    names = fleet_schema().names
    assert len(names) == 43 and names[:3] == ["timestamp_ms", "unit", "cycle"] and names[-1] == "Wf_z"
    assert len(FEATURES) == 18


def test_decode_defaults_and_rejects(spark):
    messages = [("1", '{"unit": 1.0, "cycle": "2", "a": 3, "rul": 7, "timestamp_ms": 5}'),
                ("1", '{"unit": 1, "cycle": 2.9, "RUL": 8}'), ("1", "{oops"), ("2", '{"cycle": 1}'), ("3", None)]
    df = spark.createDataFrame(messages, "key string, value string")
    good = packets.decode_packets(df, ["a", "b"])
    assert [tuple(r) for r in good.collect()] == [(1, 2, 5, 7.0, 3.0, 0.0)]  # one without a stamp is no packet
    assert good.count() + packets.dead_letters(df, ["a", "b"]).count() == len(messages)


def test_upsert_prefers_new_on_equal_order(spark):
    old = spark.createDataFrame([(1, 1, 5, "old"), (1, 2, 9, "old")], "unit int, cycle int, ts int, v string")
    new = spark.createDataFrame([(1, 1, 5, "new"), (1, 2, 8, "new"), (2, 1, 1, "new")], old.schema)
    got = {(r["unit"], r["cycle"]): r["v"] for r in sinks.upsert_latest(old, new, ["unit", "cycle"], ["ts"]).collect()}
    assert got == {(1, 1): "new", (1, 2): "old", (2, 1): "new"}
    once = sinks.upsert_latest(old, new, ["unit", "cycle"], ["ts"])
    assert sinks.upsert_latest(once, new, ["unit", "cycle"], ["ts"]).count() == once.count()


def test_materialize_reuses_and_rewrites(spark, tmp_path):
    path = str(tmp_path / "stage")
    assert sinks.materialize(spark.range(5), path).count() == 5
    assert sinks.materialize(spark.range(9), path).count() == 5
    assert sinks.materialize(spark.range(9), path, reuse=False).count() == 9


def test_corrupt_files_are_set_aside(spark, tmp_path):
    (tmp_path / "a.h5").write_bytes(b"\x89HDF\r\n\x1a\nrest")
    (tmp_path / "b.h5").write_bytes(b"html")
    ok, bad = scans.split_valid_files(scans.file_heads(spark, str(tmp_path)), b"\x89HDF\r\n\x1a\n")
    assert ok.first()["path"].endswith("a.h5") and bad.first()["path"].endswith("b.h5")
    listed = scans.scan_files(spark, str(tmp_path), "*.h5")
    assert listed.count() == 2 and len(listed.first()["sha256"]) == 64


def test_files_are_read_by_ranges(spark, tmp_path, monkeypatch):
    """Digests by chunks far smaller than a file, heads without the rest, many files in several tasks."""
    import hashlib
    from vanewright.sources import file_ranges
    (tmp_path / "deep").mkdir()
    bodies = {f"deep/f{i}.bin": bytes([i]) * (i * 1000) for i in range(9)} | {"big.bin": b"xyz" * 100_000, "empty.bin": b"", "_SUCCESS": b""}
    for name, body in bodies.items():
        (tmp_path / name).write_bytes(body)
    rows = scans.scan_files(spark, str(tmp_path), "*.bin", chunk_bytes=64).collect()
    want = {n.split("/")[-1]: (len(b), hashlib.sha256(b).hexdigest()) for n, b in bodies.items() if n.endswith(".bin")}
    assert {r["file_name"]: (r["length"], r["sha256"]) for r in rows} == want and all(r["path"].startswith("file:/") for r in rows)
    heads = {r["path"].split("/")[-1]: bytes(r["head"]) for r in scans.file_heads(spark, f"file://{tmp_path}", "*.bin", 5).collect()}
    assert heads == {n.split("/")[-1]: b[:5] for n, b in bodies.items() if n.endswith(".bin")}
    reads = []
    plain = file_ranges._opened

    class Counted:
        def __init__(self, system): self.system = system  # noqa: E704
        def get_file_info(self, x): return self.system.get_file_info(x)  # noqa: E704
        def open_input_stream(self, name):
            stream = self.system.open_input_stream(name)
            class Stream:
                def __enter__(self): return self  # noqa: E704
                def __exit__(self, *_): stream.close()  # noqa: E704
                def read(self, n): reads.append(n); return stream.read(n)  # noqa: E702,E704
            return Stream()
    monkeypatch.setattr(file_ranges, "_opened", lambda p: (lambda a, b, c: (Counted(a), b, c))(*plain(p)))
    reader = file_ranges._Reader({"path": str(tmp_path), "glob": "big.bin", "head_bytes": "8", "digest": "false"})
    parts = reader.partitions()
    assert sum(b.num_rows for p in parts for b in reader.read(p)) == 1 and reads == [8]
    reader = file_ranges._Reader({"path": str(tmp_path), "glob": "*.bin", "task_bytes": str(3 * file_ranges.OPEN_BYTES)})
    assert len(reader.partitions()) >= 4
    assert scans.scan_files(spark, str(tmp_path), "*.none").count() == 0
    assert not file_ranges.opens("viewfs://nowhere/x") and not file_ranges.opens(f"{tmp_path}/absent")


def test_alignment_guard(spark):
    a = spark.createDataFrame([(1, 2.0)], "x int, y double")
    with pytest.raises(ValueError):
        joins.assert_aligned([a, a.select("y", "x")])
    with pytest.raises(ValueError):
        scans.zip_row_aligned({"a": a, "b": a}, "x")
    joins.assert_aligned([a, a])


def test_dropped_and_valid_make_requested(spark):
    req = spark.createDataFrame([(i,) for i in range(20)], "f int")
    valid = req.where("f % 3 = 0")
    dropped = joins.dropped_inputs(req, valid, "f")
    assert sorted(r[0] for r in dropped.union(valid).collect()) == list(range(20))


def test_reconcile_reports_what_totals_hide(spark):
    want = spark.createDataFrame([("a",), ("b",)], "k string")
    have = spark.createDataFrame([("a",), ("c",), ("c",)], "k string")
    row = joins.reconcile(want, have, "k").first()
    assert row["passes"] and not row["complete"] and (row["missing"], row["extra"]) == (1, 1)


def test_catalog_of_absent_table(spark):
    assert scans.catalog_report(spark, "no_such_table").first()["exists"] is False
    spark.range(1).createOrReplaceTempView("one_row")
    assert scans.catalog_report(spark, "one_row").first()["column_name"] == "id"


def test_validation_units(spark):
    df = spark.range(1000).select((F.col("id") % 50).alias("unit"))
    got = prep.choose_validation_units(df, 0.1, None)
    assert sorted(r["unit"] for r in got.collect()) == [45, 46, 47, 48, 49]
    assert prep.choose_validation_units(df, 0.0001, 3).count() == 1
    hashed = prep.choose_validation_units(df, 0.2, 3)
    assert {tuple(r) for r in hashed.collect()} == {tuple(r) for r in prep.choose_validation_units(df, 0.2, 3).collect()}
    assert hashed.count() == 10


def test_splits_are_disjoint(spark):
    df = spark.range(600).select((F.col("id") % 30).alias("unit"),
                                 F.when(F.col("id") % 30 < 5, "test").otherwise("dev").alias("split"))
    val = prep.choose_validation_units(df.where("split = 'dev'"), 0.2)
    parts = prep.extract_splits(df, val)
    assert parts.groupBy("unit").agg(F.countDistinct("part").alias("n")).where("n > 1").count() == 0
    assert parts.count() == 600
    rest, held = joins.split_by_units(df, val)
    assert rest.count() + held.count() == 600


def test_registry_lookup_ignores_case(spark):
    reg = spark.createDataFrame([("GDPR", 1)], "slug string, entry int")
    got = scans.lookup_registry(spark.createDataFrame([("gdpr",), ("none",)], "slug string"), reg)
    assert {r["slug"]: r["entry"] for r in got.collect()} == {"gdpr": 1, "none": None}


def test_null_keys_match_each_other(spark):
    src = spark.createDataFrame([(None, 1), ("a", 2), ("b", 3)], "path string, size int")
    assert [r["path"] for r in sinks.new_files_only(src, src.where("size < 3"), ["path"]).collect()] == ["b"]
    assert joins.missing_keys(src, src.where("path is null"), "path").count() == 2
    rest, held = joins.split_by_units(src, src.where("path is null").select("path"), "path")
    assert (rest.count(), [r["size"] for r in held.collect()]) == (2, [1])
    pairs = joins.pair_by_row(src, src, "path", ["size"])
    assert pairs.count() == 3
    life = spark.createDataFrame([(None, 10)], "unit int, total_cycles int")
    now = spark.createDataFrame([(None, 4), (1, 2)], "unit int, cycle int")
    assert [(r["unit"], r["progress"]) for r in joins.mission_progress(now, life).collect()] == [(None, 0.4)]


def test_a_null_validation_unit_leaks_into_no_scaler(spark):
    rng = __import__("random").Random(1)
    rows = [("d", "dev", u, i, rng.gauss(100.0 if u is None else 0.0, 1.0)) for u in (None, 1, 2, 3, 4) for i in range(200)]
    df = spark.createDataFrame(rows, "dataset string, split string, unit int, step int, a double")
    cfg = prep.PrepConfig(features=["a"], order=["step"], val_fraction=0.2, seed=None)
    for seed in range(40):
        cfg = prep.PrepConfig(features=["a"], order=["step"], val_fraction=0.2, seed=seed)
        out = prep.prepare(df, cfg)
        if out.where("split = 'val' and unit is null").count():
            break
    else:
        raise AssertionError("no seed chooses the null unit")
    got = out.where("split = 'train'").agg(F.avg("a").alias("m"), F.stddev_pop("a").alias("s")).first()
    assert abs(got["m"]) < 1e-9 and abs(got["s"] - 1) < 0.02
    assert out.where("split = 'val'").agg(F.avg("a")).first()[0] > 50
