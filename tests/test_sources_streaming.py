import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from rivulet.session import fresh_path, shared_folder
from rivulet.sources import readers, sinks
from rivulet.streaming import posts as stream
from tests.conftest import as_set


def test_a_cluster_needs_a_folder_that_all_can_reach(monkeypatch):
    from rivulet import session

    class Hadoop:
        def __init__(self, default):
            self.get = {"fs.defaultFS": default}.get

    for folder, default, good in [("hdfs://n/x", "file:///", True), ("file:///shared", "file:///", True), ("/x", "hdfs://n", True), ("/x", "file:///", False), (None, "hdfs://n", False)]:
        for master, local in (("local-cluster[2,1,1024]", False), ("spark://h:1", False), ("local[4]", True), ("local", True)):
            if local or good:
                session.check_folder(folder, master, Hadoop(default))
            else:
                with pytest.raises(RuntimeError):
                    session.check_folder(folder, master, Hadoop(default))


def test_a_plain_path_that_executors_reach_is_shared(spark, tmp_path, monkeypatch):
    from rivulet import session

    get = type(spark.conf).get
    plain = str(tmp_path / "mount")
    monkeypatch.setattr(type(spark.conf), "get", lambda conf, key, *rest: plain if key == "spark.checkpoint.dir" else get(conf, key, *rest))
    monkeypatch.setattr(spark.sparkContext, "master", "spark://h:1")
    assert shared_folder(spark) == plain
    d = session.materialize(spark.range(5))
    assert d.count() == 5 and all(plain in f for f in d.inputFiles())

    monkeypatch.setattr(session, "reached_by_all", lambda *of: False)
    with pytest.raises(RuntimeError, match="not all executors"):
        shared_folder(spark)


def test_released_tables_are_gone(spark):
    from rivulet.session import materialize, release

    d = materialize(spark.range(5))
    assert d.count() == 5
    release(d)
    with pytest.raises(Exception):
        spark.read.parquet(d.inputFiles()[0]).count()


def test_the_shared_folder_is_kept(spark):
    assert shared_folder(spark) == shared_folder(spark)
    assert fresh_path(spark, "a") != fresh_path(spark, "a")


def test_marked_lines_skip_notices_and_leading_markers(spark, tmp_path):
    lines = [
        '{"created_at": "t1", "text": "a"}', '{"delete": {"id": 3}}', 'created_at {"text": "b"}', "",
        '{"text": "c", "created_at": "t2"}',
    ]
    (tmp_path / "dump").write_text("\n".join(lines))
    got = readers.marked_lines(spark, str(tmp_path / "dump"), "created_at", "created_at string, text string")
    assert as_set(got, "created_at", "text") == {("t1", "a"), ("t2", "c")}


def test_broken_lines_are_rejects_and_no_rows(spark, tmp_path):
    lines = [
        '{"created_at": "t1", "n": 1}', '{"created_at": "t2", "n": ', '{"created_at": "t3", "n": "x"}', '[{"created_at": "t4"}]',
        '"created_at"', 'see created_at', "", "   ", '{"created_at": null}', '  {"created_at": "t5", "n": 2, "more": [1]}', '{"delete": 1',
    ]
    (tmp_path / "dump").write_text("\n".join(lines))
    found = readers.checked_records(spark, str(tmp_path), "created_at string, n long", "created_at")
    assert as_set(found.records, "created_at", "n") == {("t1", 1), (None, None), ("t5", 2)}
    assert found.records.count() == 3
    want = {(lines[1], "not JSON"), (lines[2], "a field does not fit its type"), (lines[3], "not an object"), (lines[4], "not an object"), (lines[5], "not JSON")}
    assert as_set(found.rejects, "text", "reason") == want
    assert all(r["file"].endswith("/dump") and r["split"] == 0 for r in found.rejects.collect())
    assert tuple(found.counts().first()) == (3, 5)
    every = readers.checked_records(spark, str(tmp_path), "created_at string, n long")
    assert tuple(every.counts().first()) == (3, 6)
    assert readers.json_records(spark, str(tmp_path), "created_at string, n long").count() == 3


def test_large_csv_files_are_split(spark, tmp_path):
    (tmp_path / "big.csv").write_text("a,b\n" + "".join(f"{i},text {i}\n" for i in range(60_000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
    try:
        whole = readers.csv_table(spark, str(tmp_path), "a long, b string")
        assert whole.rdd.getNumPartitions() > 4
        assert whole.agg(F.count("a"), F.countDistinct("a")).first()[:] == (60_000, 60_000)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_json_document(spark, tmp_path):
    (tmp_path / "d.json").write_text(json.dumps([{"id": 1, "user": {"name": "a"}}, {"id": 2}], indent=1))
    got = readers.json_document(spark, str(tmp_path), "id long, user struct<name: string>")
    assert as_set(got.select("id", "user.name"), "id", "name") == {(1, "a"), (2, None)}


def test_json_document_round_trip(spark):
    d = spark.createDataFrame([(i, None if i == 3 else f'"{i}"') for i in range(50)], "id long, t string").repartition(3)
    d = d.unionByName(d.where("id < 0"))  # with empty partitions
    path = sinks.write_json_document(d, fresh_path(spark, "doc"))
    assert as_set(readers.json_document(spark, path, "id long, t string"), "id", "t") == as_set(d, "id", "t")
    for (text,) in spark.read.text(path, wholetext=True).collect():
        assert isinstance(json.loads(text), list)


def test_rowset_finds_cells_by_header(spark):
    def payload(headers, *rows):
        return json.dumps({"resultSets": [{"name": "x", "headers": headers, "rowSet": list(rows)}]})

    d = spark.createDataFrame(
        [(1, payload(["A", "B"], [1, "x"], [2, None])), (2, payload(["B", "A"], ["y", 3])), (3, payload(["A"], [4])), (4, "{}")],
        "id long, payload string",
    )
    got = readers.rowset_table(d, {"A": "double", "B": "string"}, keep=["id"])
    assert as_set(got, "id", "A", "B") == {(1, 1.0, "x"), (1, 2.0, None), (2, 3.0, "y"), (3, 4.0, None)}


def test_bad_cells_and_payloads_are_rejects(spark):
    def payload(headers, *rows):
        return json.dumps({"resultSets": [{"headers": headers, "rowSet": list(rows)}]})

    d = spark.createDataFrame(
        [(1, payload(["A", "B"], ["1", "x"], ["one", None], [None, "y"])), (2, "{cut"), (3, "{}"), (4, None), (5, payload(["B"], ["z"]))], "id long, payload string"
    )
    fields = {"A": "long", "B": "string"}
    assert as_set(readers.rowset_table(d, fields, keep=["id"]), "id", "A", "B") == {(1, 1, "x"), (1, None, None), (1, None, "y"), (5, None, "z")}
    assert as_set(readers.rowset_rejects(d, fields, keep=["id"]), "id", "field", "text", "reason") == {
        (1, "A", "one", "a field does not fit its type"), (2, None, "{cut", "not JSON"), (3, None, "{}", "no such result set")
    }


def test_matrix_and_sweep_csv(spark, tmp_path):
    (tmp_path / "m.csv").write_text(",u1,u2\nb1, 0.1 ,4\nb2,x,\n")
    got = {r.row_id: r.vector for r in readers.matrix_csv(spark, str(tmp_path / "m.csv"), ["id", "u1", "u2"]).collect()}
    assert got == {"b1": [0.1, 4.0], "b2": [None, None]}
    (tmp_path / "s.csv").write_text("K,RMSE,MAE\n5,0.5,0.25\n,,")
    rows = readers.csv_table(spark, str(tmp_path / "s.csv"), "K int, RMSE double, MAE double").collect()
    assert [tuple(r) for r in rows] == [(5, 0.5, 0.25), (None, None, None)]


def test_round_trips_with_awkward_text(spark):
    rows = [(1, 'say "hi", you', 1.5), (2, "tab\there", None), (3, None, -0.25), (4, "two\nlines, \"quoted\"\n", 2.0)]
    d = spark.createDataFrame(rows, "id long, t string, v double")
    schema = "id long, t string, v double"
    backs = [
        readers.csv_table(spark, sinks.write_csv(d, fresh_path(spark, "c")), schema, multi_line=True),
        readers.tsv_table(spark, sinks.write_tsv(d, fresh_path(spark, "t")), schema, multi_line=True),
        readers.json_records(spark, sinks.write_json(d, fresh_path(spark, "j")), schema),
    ]
    for back in backs:
        assert as_set(back, "id", "t", "v") == set(rows)


def test_view_and_spread(spark):
    d = spark.range(100).coalesce(1)
    assert readers.register(d, "some_numbers").count() == 100
    wide = readers.spread(d)
    assert wide.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism and wide.count() == 100
    assert readers.spread(wide) is wide


@pytest.fixture(scope="module")
def feed(spark):
    start = dt.datetime(2024, 1, 2, 9, 35)
    texts = ["good day", "BAD luck", "The end", "fine good", "bad bad", "none"]
    rows = [(start + dt.timedelta(minutes=4 * i), texts[i % 6], float(i)) for i in range(400)]
    path = fresh_path(spark, "feed")
    batch = spark.createDataFrame(rows, "ts timestamp, text string, v double")
    batch.repartition(3).write.parquet(path)
    return path, batch


def live(spark, feed):
    return spark.readStream.schema(feed[1].schema).parquet(feed[0])


def test_track(spark, feed):
    got = stream.run_available(stream.track_filter(live(spark, feed), ["Bad", "FINE"]))
    want = feed[1].where(F.lower("text").rlike("bad|fine")).select("text")
    assert sorted(r.text for r in got.collect()) == sorted(r.text for r in want.collect())


def test_buckets_are_complete(spark, feed):
    got = as_set(stream.run_available(stream.time_buckets(live(spark, feed), "ts"), "b", ["bucket"]), "bucket", "n")
    every = feed[1].groupBy(F.window("ts", "10 minutes")).count()
    assert got == {(r.window.start, r["count"]) for r in every.collect()}


def test_a_second_run_goes_on_with_late_files(spark, feed):
    source, folder = fresh_path(spark, "late"), fresh_path(spark, "late-out")
    rows = feed[1].orderBy("ts").collect()
    run = lambda: stream.run_available(
        stream.time_buckets(spark.readStream.schema(feed[1].schema).parquet(source), "ts"), "late", ["bucket"], folder
    )
    parts = [rows[200:], rows[:100], rows[100:200]]  # the newest first
    for n, part in enumerate(parts, 1):
        spark.createDataFrame(part, feed[1].schema).write.mode("append").parquet(source)
        done = [r for p in parts[:n] for r in p]
        want = spark.createDataFrame(done, feed[1].schema).groupBy(F.window("ts", "10 minutes")).count()
        assert as_set(run(), "bucket", "n") == {(r.window.start, r["count"]) for r in want.collect()}
    assert run().count() == want.count()  # nothing new


def size_of(spark, folder):
    """Rows in all files of keyed results, and the number of their folders."""
    versions = stream.KeyedResults(spark, folder, None, [])
    names = [(kind, n) for kind, label in (("rows", "run"), ("whole", "upto")) for n in versions._finished(kind)]
    paths = [f"{folder}/{kind}/{'run' if kind == 'rows' else 'upto'}={n}" for kind, n in names]
    return sum(spark.read.parquet(p).count() for p in paths), len(paths)


def test_many_runs_leave_a_folder_in_proportion_to_the_groups(spark):
    source, folder, start = fresh_path(spark, "many"), fresh_path(spark, "many-out"), dt.datetime(2024, 1, 2)
    schema, rows = "ts timestamp, text string", []
    for n in range(50):
        # old buckets again and again, late ones, rows that repeat, and now and then nothing at all
        new = [(start + dt.timedelta(minutes=10 * (k % 12 if n % 3 else k + n % 5)), "x") for k in range(0 if n % 7 == 6 else 20)]
        rows += new
        spark.createDataFrame(new, schema).coalesce(1).write.mode("append").parquet(source)
        found = stream.run_available(stream.time_buckets(spark.readStream.schema(schema).parquet(source), "ts"), "many", ["bucket"], folder)
        if n % 10 == 9:
            want = spark.createDataFrame(rows, schema).groupBy(F.window("ts", "10 minutes")).count().collect()
            assert as_set(found, "bucket", "n") == {(r.window.start, r["count"]) for r in want}
    held, folders = size_of(spark, folder)
    assert held <= 6 * len(want) and folders <= 2 * stream.KeyedResults.MOST_RUNS + 4


def test_results_survive_a_stop_while_clearing(spark):
    folder, schema = fresh_path(spark, "stop"), spark.createDataFrame([], "k long, v long").schema
    results = stream.KeyedResults(spark, folder, schema, ["k"])
    assert results.newest().count() == 0
    for n, pairs in enumerate([[(1, 1), (None, 1)], [(1, 2), (2, 1)], [(2, 2)]]):
        results.store(spark.createDataFrame(pairs, schema), n)
    want = {(1, 2), (None, 1), (2, 2)}
    assert as_set(results.newest(), "k", "v") == want
    # a table that was not finished, and then a run that is repeated
    spark.createDataFrame([(9, 9)], schema).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{folder}/whole/upto=2")
    assert as_set(results.newest(), "k", "v") == want
    results.clear()
    assert as_set(results.newest(), "k", "v") == want
    results.store(spark.createDataFrame([(1, 5)], schema), 3)
    results.store(spark.createDataFrame([(1, 5)], schema), 3)
    before = results.newest()
    results.store(spark.createDataFrame([(1, 6), (2, 6), (3, 6), (None, 6)], schema), 4)
    results.clear()
    assert as_set(results.newest(), "k", "v") == {(1, 6), (2, 6), (3, 6), (None, 6)}
    assert as_set(before, "k", "v") == {(1, 5), (None, 1), (2, 2)}  # still there


def test_stream_and_batch_sentiment_agree(spark, feed):
    from rivulet.plans.text import clean_words
    from rivulet.plans.timeseries import ratio_and_diff

    good = spark.createDataFrame([("good", 2.0), ("fine", 1.0), ("fine", 0.5)], "word string, value double")
    bad = spark.createDataFrame([("bad", -1.0)], "word string, value double")
    columns = ("bucket", "positive", "negative", "ratio", "diff")
    found = stream.bucket_sentiment(live(spark, feed), "ts", good, bad, ["The"])
    got = as_set(stream.run_available(found, "s", ["bucket"]), *columns)
    words = clean_words(feed[1], ["The"], keep=["ts"]).withColumn("bucket", F.window("ts", "10 minutes")["start"])
    assert got == as_set(ratio_and_diff(words, good, bad, ["bucket"]), *columns)


def test_last_quotes_of_a_stream_equal_the_batch(spark, feed):
    from rivulet.operators.ordered import slot_last_quote

    found = stream.last_quotes(live(spark, feed), "ts", ["v"])
    got = as_set(stream.run_available(found, "q", ["day", "slot"]), "day", "slot", "v")
    batch = feed[1].withColumn("day", F.to_date("ts"))
    assert got == as_set(slot_last_quote(batch, "ts", ["v"], ["day"]), "day", "slot", "v")


def test_a_delay_bounds_what_still_counts(spark, feed):
    got = stream.run_available(stream.time_buckets(live(spark, feed), "ts", "10 minutes"))
    every = feed[1].groupBy(F.window("ts", "10 minutes")).count().count()
    assert 0 < got.count() < every  # append mode: only buckets that are over
