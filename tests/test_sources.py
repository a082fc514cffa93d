"""JSON lines, stores, folders, registries, timing and streams on small inputs."""

import datetime
import io
import json
import tarfile
import zipfile

import pytest
from pyspark.sql import functions as F

from recordmill.operators import gates, registry, timing
from recordmill.sources import jsonl, trees
from recordmill.streaming import status

LINES = ['{"id": 1, "name": "a", "tags": ["x"], "more": 1}', "", "not json", '{"id": 2}', '{"id": 3, "name": "c"']
SCHEMA = "id long, name string, tags array<string>"


def test_three_policies(spark, tmp_path):
    path = str(tmp_path / "r.jsonl")
    (tmp_path / "r.jsonl").write_text("\n".join(LINES))
    kept = jsonl.with_defaults(jsonl.read(spark, path, SCHEMA, "drop"))
    assert [tuple(r)[:3] for r in kept.orderBy("pos").collect()] == [(1, "a", ["x"]), (2, "", [])]
    counted = jsonl.read(spark, path, SCHEMA, "count")
    assert counted.where(f"{jsonl.CORRUPT} IS NOT NULL").count() == 2 and counted.count() == 4
    with pytest.raises(Exception, match="(?i)malformed"):
        jsonl.read(spark, path, SCHEMA, "fail").collect()
    with pytest.raises(ValueError):
        jsonl.read(spark, path, SCHEMA, "other")
    assert tuple(jsonl.integrity(spark, path).first()) == (4, 2, False)


def test_stores(spark, tmp_path):
    (tmp_path / "c.txt").write_text("a\n\n b \na\n")
    assert {r.key for r in jsonl.checkpoint_keys(spark, str(tmp_path / "c.txt")).collect()} == {"a", "b"}
    (tmp_path / "m.json").write_text(json.dumps({"wrappers": [{"wrapper_path": "x"}, {"wrapper_path": ""}, {"other": 1}]}))
    assert [r.wrapper_path for r in jsonl.manifest_paths(spark, str(tmp_path / "m.json")).collect()] == ["x"]
    (tmp_path / "s.json").write_text(json.dumps({"entries": {"k": {"n": 1}}}))
    assert [(r.key, r.value.n) for r in jsonl.keyed_store(spark, str(tmp_path / "s.json"), "struct<n:int>").collect()] == [("k", 1)]
    df = spark.createDataFrame([("k", 1, "é"), ("k", 2, "b")], "key string, pos int, v string")
    assert [r.v for r in jsonl.last_of_key(df, "key").collect()] == ["b"]
    jsonl.write(df, str(tmp_path / "out"))
    assert "é" in "".join(p.read_text() for p in (tmp_path / "out").glob("*.json"))


def test_folders(spark, tmp_path):
    a = tmp_path / "a"
    a.mkdir()
    (a / ".shed.yml").write_text("x: 1")
    (a / "t.xml").write_text("<tool id='t'/>")
    (a / "macros.xml").write_text("<macros/>")
    (a / "bad.xml").write_text("<tool")
    (a / "other.xml").write_text("<data/>")
    (a / "cli.py").write_text("import argparse\nargv\n")
    (a / "x.bin").write_bytes(b"\x00\x01")
    (a / "tests").mkdir()
    (a / "tests" / "t.py").write_text("x")
    assert [r.package_dir.rsplit("/", 1)[-1] for r in trees.packages(spark, str(tmp_path)).collect()] == ["a"]
    assert [r.name for r in trees.wrappers(spark, str(tmp_path)).collect()] == ["t.xml"]
    found = {r.relpath: r.score for r in trees.sources(spark, str(tmp_path), ["cli"]).collect()}
    assert found["a/cli.py"] == 60 + 50 + 35 + 20 and "a/x.bin" not in found and not any("tests" in p for p in found)
    with zipfile.ZipFile(a / "z.zip", "w") as z:
        z.writestr("one.txt", "12")
    with tarfile.open(a / "z.tar.gz", "w:gz") as t:
        info = tarfile.TarInfo("two.txt")
        info.size = 3
        t.addfile(info, io.BytesIO(b"abc"))
    (a / "broken.zip").write_bytes(b"no")
    assert {(r.member, r.size) for r in trees.archive_members(spark, str(tmp_path)).collect()} == {("one.txt", 2), ("two.txt", 3), (None, None)}


def test_registry(spark):
    runs = spark.createDataFrame([("r1", "running", {"a": "1", "b": "2"}, 1)], "run string, status string, info map<string,string>, at int")
    updates = spark.createDataFrame([("r1", None, {"b": "3"}, 5), ("r2", "new", None, 2)], "run string, status string, info map<string,string>, at int")
    got = {r.run: (r.status, r["info"], r["at"]) for r in registry.upserted(runs, updates, "run", ["status"], ["info"], "at").collect()}
    assert got == {"r1": ("running", {"a": "1", "b": "3"}, 5), "r2": ("new", {}, 2)}
    jobs = spark.createDataFrame([("j", ["t2", "t1", "gone"], ["p", "q"]), ("k", [], [])], "job_id string, task_ids array<string>, artifacts array<string>")
    tasks = spark.createDataFrame([("t1", "completed"), ("t2", "pending")], "task_id string, status string")
    assert [(r.task_id, r.place) for r in registry.tasks_of(jobs, tasks).orderBy("place").collect()] == [("t2", 0), ("t1", 1)]
    assert {tuple(r) for r in registry.jobs_state(jobs, tasks).collect()} == {("j", "running", 1, 2, 0.5), ("k", "pending", 0, 0, 0.0)}
    files = spark.createDataFrame([("q",)], "path string")
    assert [tuple(r) for r in registry.artifacts(jobs, files).collect()] == [("j", "a1", "q")]
    listed = registry.newest(spark.createDataFrame([("a", "x", "s1", 1), ("b", "y", "s1", 2), ("c", "x", "s2", 3)], "run string, kind string, status string, at int"), "at", "run", limit=2)
    assert {(r.status, r.kind, r.n) for r in registry.listing_counts(listed).collect()} == {("s1", None, 1), ("s2", None, 1), (None, "x", 1), (None, "y", 1)}


def test_progress(spark):
    t = lambda m: datetime.datetime(2024, 1, 1, 0, m)
    rows = [(t(0), t(1), 30, 60), (t(0), t(1), 30, None), (t(0), t(0), 0, 60), (t(0), t(1), 60, 60)]
    df = spark.createDataFrame(rows, "s timestamp_ntz, n timestamp_ntz, d long, t long")
    got = [(r.elapsed, r.speed, r.remaining) for r in timing.progress(df, "s", "n", "d", "t").collect()]
    assert got == [(60.0, 0.5, 60.0), (60.0, 0.5, None), (0.0, 0.0, None), (60.0, 1.0, None)]


def test_gates(spark):
    df = spark.createDataFrame([("a", 0.9, 0.1, 0.8, 0.1), ("b", 0.5, 0.4, 0.9, 0.1), ("c", None, 0.1, 0.9, 0.1)], "k string, ok double, bad double, base_ok double, base_bad double")
    rules = [gates.Gate("ok", least=0.6, tolerance=0.05), gates.Gate("bad", most=0.3, tolerance=0.1)]
    got = {r.k: (r.passed, r.reasons) for r in gates.decided(df, rules).collect()}
    assert got["a"] == (True, []) and got["c"] == (False, ["ok is under its limit"])
    assert got["b"] == (False, ["ok is under its limit", "ok fell behind the baseline", "bad is over its limit", "bad fell behind the baseline"])


def test_lease_stream(spark, tmp_path):
    t = lambda s: datetime.datetime(2024, 1, 1, 0, 0, s)
    rows = [("k", "w1", "claim", t(0)), ("k", "w2", "claim", t(5)), ("k", "w1", "heartbeat", t(8)), ("k", "w2", "heartbeat", t(9)), ("k", "w2", "claim", t(30)), ("k", "w1", "complete", t(31)), ("k", "w2", "complete", t(32)), ("k", "w3", "claim", t(59))]
    spark.createDataFrame(rows, "task string, worker string, action string, at timestamp").coalesce(1).write.parquet(str(tmp_path / "in"))
    out = status.run_to_end(status.leases(status.read_files(spark, str(tmp_path / "in")), 10), "append", "leases")
    assert [r.outcome for r in out.orderBy("at").collect()] == ["claimed", "held", "prolonged", "worker_mismatch", "claimed", "worker_mismatch", "completed", "task_done"]


def test_latest_is_the_same_for_streams_and_tables(spark, tmp_path):
    rows = [(k % 3, k, f"s{k}") for k in range(20)]
    df = spark.createDataFrame(rows, "key int, at int, state string")
    df.repartition(4).write.parquet(str(tmp_path / "in"))
    batch = status.latest(df, "key", "at", "at", ["state"])
    stream = status.latest_by_stream(spark, str(tmp_path / "in"), "key", "at", "at", ["state"])
    assert {(r.key, r.state) for r in batch.collect()} == {(r.key, r.state) for r in stream.collect()} == {(0, "s18"), (1, "s19"), (2, "s17")}


def test_first_of_key_stream(spark, tmp_path):
    rows = [(1, datetime.datetime(2024, 1, 1)), (1, datetime.datetime(2024, 1, 1, 0, 1)), (2, datetime.datetime(2024, 1, 1))]
    spark.createDataFrame(rows, "k int, at timestamp").coalesce(1).write.parquet(str(tmp_path / "in"))
    out = status.run_to_end(status.first_of_key(status.read_files(spark, str(tmp_path / "in")), "k", "at", "1 hour"), "append", "first")
    assert sorted(r.k for r in out.collect()) == [1, 2]


def test_append_stream(spark, tmp_path):
    spark.createDataFrame([("a", 1), ("a", 1), ("b", 2)], "key string, n int").coalesce(1).write.parquet(str(tmp_path / "in"))
    for _ in range(2):  # again: the checkpoint knows what was written
        jsonl.append_stream(status.read_files(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "cp"), "key").awaitTermination()
    assert sorted(r.key for r in spark.read.json(str(tmp_path / "out")).select(F.col("key")).collect()) == ["a", "b"]


def test_documents_and_logs(spark, tmp_path):
    (tmp_path / "d.json").write_text('{\n "a": 1\n}')
    (tmp_path / "broken.json").write_text("{")
    assert [jsonl.document(spark, str(tmp_path / n), "a int").first()["a"] for n in ("d.json", "broken.json", "none.json")] == [1, None, None]
    (tmp_path / "list.json").write_text('[{"a": 1}, {"a": 2}]')
    (tmp_path / "held.json").write_text('{"records": [{"a": 3}]}')
    assert [[r.a for r in jsonl.records_of(spark, str(tmp_path / n), "a int").orderBy("place").collect()] for n in ("list.json", "held.json")] == [[1, 2], [3]]
    (tmp_path / "log").write_text('{"a": 1}\n{"a": 2}\nno\n')
    assert jsonl.last_valid(spark, str(tmp_path / "log"), "a int").first()["a"] == 2
    assert [r.value for r in jsonl.last_lines(spark, str(tmp_path / "log"), 2).collect()] == ['{"a": 2}', "no"]
    (tmp_path / "empty").write_text("x\n")
    assert jsonl.last_valid(spark, str(tmp_path / "empty"), "a int").count() == 0


def test_sinks(spark, tmp_path):
    from recordmill.sources import sinks

    df = spark.createDataFrame([("a", 1, "x|y"), ("b", 2, None)], "key string, at int, note string")
    assert sinks.markdown(df, "Report").splitlines()[4] == "| a | 1 | x\\|y |"
    base = str(tmp_path / "s")
    sinks.snapshot(df, base, "r1")
    sinks.snapshot(df.where("at = 2"), base, "r2")
    assert sinks.current(spark, base).count() == 1 and spark.read.parquet(f"{base}/runs/r1").count() == 2
    sinks.upsert(df, str(tmp_path / "k"), "key", "at", 0)
    sinks.upsert(spark.createDataFrame([("a", 5, "new")], df.schema), str(tmp_path / "k"), "key", "at", 1)
    assert {(r.key, r["at"]) for r in spark.read.parquet(str(tmp_path / "k" / "version=1")).collect()} == {("a", 5), ("b", 2)}
    sinks.document(df, str(tmp_path / "doc"))
    assert spark.read.json(str(tmp_path / "doc")).count() == 2
    assert [r.key for r in sinks.feedback(df, ["note"]).collect()] == ["a"]
    blocks = spark.createDataFrame([(1, "<r>\n a</r>"), (2, "<r> a</r>"), (3, "b"), (4, None)], "id int, b string")
    assert [(r.times, r.first) for r in sinks.repeated_blocks(blocks, "id", "b").collect()] == [(2, 1)]


def test_yaml_and_terms(spark, tmp_path):
    from recordmill.functions import markup

    df = spark.createDataFrame([("name: é\ntags: [a, b]",), ("- a",), ("x: [",), (None,)], "t string")
    got = [r.j for r in df.select(markup.yaml_json("t").alias("j")).collect()]
    assert [json.loads(g) for g in got] == [{"name": "é", "tags": ["a", "b"]}, {}, {}, {}]
    assert spark.range(1).select(markup.to_yaml(F.lit('{"a": [1]}')).alias("y")).first().y == "a:\n- 1\n"
    (tmp_path / "terms").write_text("bam # alignments\n\n# none\nbed\n")
    assert {r.term for r in trees.known_terms(spark, ["bam", "vcf"], str(tmp_path / "terms")).collect()} == {"bam", "bed", "vcf"}
    (tmp_path / "u.yml").write_text("class: UserTool\nid: a")
    (tmp_path / "v.yaml").write_text("class: Other")
    assert [r.path.rsplit("/", 1)[-1] for r in trees.user_tools(spark, str(tmp_path)).collect()] == ["u.yml"]


def test_record_timeouts(spark, tmp_path):
    t = lambda s: datetime.datetime(2024, 1, 1, 0, 0, s)
    schema = "record string, status string, at timestamp"
    batches = [[("a", "started", t(0)), ("b", "started", t(1))], [("a", "done", t(5)), ("c", "started", t(6))], [("d", "started", t(59))], [("d", "done", t(59))]]
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / f"in/{k}"))
    files = sorted((tmp_path / "in").glob("*/*.parquet"), key=lambda p: p.parent.name)
    for k, p in enumerate(files):
        p.rename(tmp_path / "in" / f"{k}.parquet")
        import os

        os.utime(tmp_path / "in" / f"{k}.parquet", (1_700_000_000 + k, 1_700_000_000 + k))
    out = status.run_to_end(status.record_timeouts(status.read_files(spark, str(tmp_path / "in"), 1), 10), "append", "timeouts")
    assert {(r.record, r.outcome) for r in out.collect()} == {("a", "done"), ("b", "timeout"), ("c", "timeout"), ("d", "done")}
