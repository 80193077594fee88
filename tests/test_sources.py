"""The tile data source and sink, commits by run, and readers of written runs."""

import json

import pytest
from pyspark.sql import functions as F

from tilewright import run_queries
from tilewright.operators import outcome
from tilewright.sources import tables, tile_format, transport

FOLDER = "/root/testdata/sf0.001"


class Refused(Exception):
    def __init__(self, code):
        super().__init__(f"refused with S3CR3T and {code}")
        self.code = code


def test_failures_that_may_pass_are_tried_again():
    calls, waits, now = [], [], [0.0]

    def fetch(url, headers, timeout):
        calls.append(url)
        if "404" in url:
            raise Refused(404)
        if "down" in url or len(calls) < 3:
            raise Refused(503) if len(calls) % 2 else OSError("S3CR3T lost")
        return b"x", None, 200

    pace = tile_format.Pace(0, sleep=waits.append)
    assert tile_format.read_tile(fetch, "u/1", {"Key": "S3CR3T"}, 5, 3, 0.5, pace) == (b"x", "", 200, None, 3)
    assert waits == [0.5, 1.0]
    calls.clear()
    assert tile_format.read_tile(fetch, "u/404", {}, 5, 3, 0.5, pace)[2:] == (404, "Refused: refused with S3CR3T and 404", 1)
    body, kind, status, error, attempts = tile_format.read_tile(fetch, "u/down", {"Key": "S3CR3T"}, 5, 2, 0.5, pace)
    assert (body, kind, attempts) == (None, None, 3) and "S3CR3T" not in error
    calls.clear()
    assert tile_format.read_tile(lambda *a: (b"", "", 503), "u", {}, 5, 1, 0, pace) == (b"", "", 503, None, 2)

    def sleep(seconds):
        now[0] += seconds

    paced = tile_format.Pace(4, clock=lambda: now[0], sleep=sleep)
    for url in ("http://a/1", "http://a/2", "http://b/1", "http://a/3"):
        paced.wait(url)
    assert now[0] == pytest.approx(0.5)  # three requests to one host are two gaps; another host waits for nothing


def reader(**options):
    return tile_format.TileReader({"template": "t/{z}/{x}/{y}", "zoom": "3", "x_min": "2", "x_max": "11", "y_min": "0", "y_max": "1", "partitions": "4", **options}, lambda url, headers, timeout: (url.encode(), "x/y", 200))


def test_partitions_cover_the_range_once_and_filters_narrow_it():
    own = reader()
    ranges = [(p.first, p.last) for p in own.partitions()]
    assert ranges[0][0] == 2 and ranges[-1][1] == 11 and all(a[1] + 1 == b[0] for a, b in zip(ranges, ranges[1:])) and len(ranges) == 4
    assert [(r[2], r[3], r[7]) for r in own.read(own.partitions()[0])] == [(x, y, f"t/3/{x}/{y}".encode()) for x in (2, 3) for y in (0, 1)]
    kept = list(own.pushFilters([tile_format.GreaterThan(("x",), 4), tile_format.LessThanOrEqual(("x",), 6), tile_format.EqualTo(("y",), 1), tile_format.EqualTo(("http_status",), 200)]))
    assert len(kept) == 1 and own.ends == {"x": [5, 6], "y": [1, 1]} and [(p.first, p.last) for p in own.partitions()] == [(5, 5), (6, 6)]
    list(own.pushFilters([tile_format.LessThan(("x",), 5)]))
    assert [list(own.read(p)) for p in own.partitions()] == [[]]
    with pytest.raises(RuntimeError):
        list(tile_format.TileReader({"template": "t", "zoom": "0", "x_min": "0", "x_max": "0", "y_min": "0", "y_max": "0"}, None).read(tile_format.XRange(0, 0)))


def test_the_format_reads_ranges(spark, tmp_path):
    seen = tmp_path / "seen"
    seen.mkdir()

    def fetch(url, headers, timeout):
        name = seen / url.replace("/", "_")
        with open(name, "a") as f:  # how often each tile was asked for
            f.write("x")
        if url.endswith("/2") and name.stat().st_size < 2:
            raise OSError("once")
        return url.encode(), headers["K"], 200

    tile_format.register(spark, fetch, "tiles_of_test")
    given = dict(template="h/{z}/{x}/{y}", zoom=5, x_min=0, x_max=9, y_min=0, y_max=3, headers='{"K": "v"}', backoff=0, partitions=3)
    df = spark.read.format("tiles_of_test").options(**given).load()
    assert df.rdd.getNumPartitions() == 3
    rows = df.where("x >= 8").collect()
    assert len(rows) == 8 and {f.name.split("_")[2] for f in seen.iterdir()} == {"8", "9"}  # nothing else was asked for
    assert {(r["x"], r["y"]): (bytes(r["content"]), r["content_type"], r["attempts"]) for r in rows} == {(x, y): (f"h/5/{x}/{y}".encode(), "v", 1 + (y == 2)) for x in (8, 9) for y in range(4)}


def test_tiles_are_fetched_once_where_they_are_kept(spark, tmp_path):
    seen = tmp_path / "seen"
    seen.mkdir()

    def fetch(url, headers, timeout):
        with open(seen / url, "a") as f:
            f.write("x")
        return b"b", "", 200

    wanted = transport.raw_range(spark, "s", "{z}-{x}-{y}", 3, (0, 5), (0, 0))
    kept = transport.read_by(wanted, fetch, partitions=2, retries=1, per_second=1000, path=f"{tmp_path}/kept")
    assert [kept.count(), kept.where("http_status = 200").count(), kept.select("attempts").distinct().count()] == [6, 6, 1]
    assert {f.read_text() for f in seen.iterdir()} == {"x"} and len(list(seen.iterdir())) == 6
    with pytest.raises(ValueError):
        transport.read_by(wanted, fetch, per_second=3)


def test_files_of_a_sink_are_whole_and_repeatable(spark, tmp_path):
    writer, root = tile_format.TileFileWriter(f"file://{tmp_path}/root"), tmp_path / "root"
    rows = [{"output_path": f"a/3/1/{i}.png", "content": b"p%d" % i, "metadata_path": f"a/3/1/{i}.png.metadata.json", "metadata": "{}"} for i in range(3)] + [{"output_path": None, "content": None, "metadata_path": "a/3/1/9.png.metadata.json", "metadata": "{}"}]
    first = writer.write(iter(rows))
    again = writer.write(iter(rows))  # a task that is run again
    assert first == again == tile_format.Written(7, 6 + 8)
    assert sorted(f.name for f in (root / "a/3/1").iterdir()) == sorted([f"{i}.png" for i in range(3)] + [f"{i}.png.metadata.json" for i in (0, 1, 2, 9)])
    with pytest.raises(Exception):
        tile_format.read_files(spark, str(root))  # no marker yet
    writer.commit([again, None])
    assert json.loads((root / "committed.json").read_text()) == {"byte_length": 14, "file_count": 7}
    with pytest.raises(ValueError):
        writer.write(iter([{"output_path": "../x", "content": b"", "metadata_path": None, "metadata": None}]))

    def broken():
        yield rows[0]
        raise OSError("lost")

    with pytest.raises(OSError):
        tile_format.TileFileWriter(str(tmp_path / "torn")).write(broken())
    assert sorted(f.name for f in (tmp_path / "torn").rglob("*") if f.is_file()) == ["0.png", "0.png.metadata.json"]


def run(spark, **changed):
    done = run_queries._processed(spark, FOLDER)
    jobs = done.select("request_id", "job_index", "provider", "run_label").distinct()
    return jobs, done.withColumns({k: v for k, v in changed.items()})


def test_one_failing_run_leaves_the_others_readable(spark, tmp_path):
    jobs, done = run(spark)
    labelled = done.withColumn("run_label", F.concat(F.lit("r"), (F.col("x") % 3).cast("string"))).withColumn("request_id", F.col("x") % 3)
    labelled = labelled.withColumn("stop_on_error", F.col("run_label") == "r1").cache()
    jobs = labelled.select("request_id", "job_index", "provider", "run_label").distinct()
    path = f"{tmp_path}/run"
    with pytest.raises(RuntimeError, match="^r1: https://h/"):
        tables.write_run(jobs, labelled, path)
    assert {r["run_label"] for r in spark.read.parquet(f"{path}/committed").collect()} == {"r0", "r2"}
    good = labelled.where("run_label <> 'r1'")
    for name in tables.RECORDS:
        assert tables.read_run(spark, path, name).count() == getattr(outcome, name)(good).count() > 0
    assert spark.read.parquet(f"{path}/manifests").count() == 2 and spark.read.parquet(f"{path}/failed_runs").count() == 1
    assert spark.read.parquet(f"{path}/tiles_raw").count() == labelled.where("stored_content IS NOT NULL AND outcome = 'fetched'").count()


def test_what_is_not_committed_is_not_shown_and_folders_are_pruned(spark, tmp_path):
    jobs, done = run(spark, stop_on_error=F.lit(False))
    path = f"{tmp_path}/run"
    tables.write_run(jobs, done, path)
    some = tables.read_run(spark, path, "tile_summary", F.col("run_label") == "run_F")
    assert some.count() == outcome.tile_summary(done).where("run_label = 'run_F'").count() > 0
    assert "dynamicpruning" in some._jdf.queryExecution().toString().lower()
    left = spark.read.parquet(f"{path}/committed").where("run_label <> 'run_O'").collect()
    spark.createDataFrame(left).write.mode("overwrite").parquet(f"{path}/committed")
    assert tables.read_run(spark, path, "tile_summary").where("run_label = 'run_O'").count() == 0
    assert tables.read_run(spark, path, "manifests").where("run_label = 'run_O'").count() == 0


def test_a_written_table_is_not_opened(spark, tmp_path):
    """Whether a table has files is seen from their list: one job, which writes it. Without rows it is one file without rows."""
    sc = spark.sparkContext
    rows = spark.range(0, 6, 1, 2).select("id", F.expr("nullif(id % 3, 2)").alias("n"), F.lit("p").alias("provider"))
    try:
        sc.setJobGroup("one_table", "one_table")
        tables.write_table(rows, f"{tmp_path}/t", "provider", "n")
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert len(sc.statusTracker().getJobIdsForGroup("one_table")) == 1
    assert sorted(map(str, spark.read.parquet(f"{tmp_path}/t").select("id", "provider", "n").collect())) == sorted(map(str, rows.select("id", "provider", "n").collect()))
    tables.write_table(rows.where("id < 0"), f"{tmp_path}/t", "provider", "n")
    assert spark.read.parquet(f"{tmp_path}/t").count() == 0 and set(spark.read.parquet(f"{tmp_path}/t").columns) == set(rows.columns)


@pytest.mark.parametrize("stops", [False, True])
def test_runs_are_joined_to_failed_ones_if_there_are_any(spark, tmp_path, monkeypatch, stops):
    """Rows without a run's number stay, those that come twice count twice, whether a run failed or not."""
    done = run_queries._processed(spark, FOLDER)
    done = done.union(done.where("x % 7 = 0")).withColumns({"request_id": F.expr("nullif(x % 3, 2)"), "stop_on_error": F.lit(stops) & (F.col("x") % 3 > 0)}).withColumn("run_label", F.lit("r")).cache()
    jobs = done.select("request_id", "job_index", "provider", "run_label").distinct()
    seen, summary = [], outcome.tile_summary
    monkeypatch.setattr(outcome, "tile_summary", lambda df: [seen.append(df), summary(df)][1])
    tables.write_run(jobs, done, f"{tmp_path}/run", raise_failed=False)
    assert ("Join" in seen[0]._jdf.queryExecution().optimizedPlan().toString()) == stops
    left = done.where("NOT coalesce(request_id = 1, false)") if stops else done
    monkeypatch.undo()
    for name in tables.RECORDS:
        assert spark.read.parquet(f"{tmp_path}/run/{name}").count() == getattr(outcome, name)(left).count() > 0
    rows = lambda df: sorted(repr(r.asDict()) for r in df.select(sorted(df.columns)).collect())
    kept = jobs.where("NOT coalesce(request_id = 1, false)") if stops else jobs
    assert rows(spark.read.parquet(f"{tmp_path}/run/manifests")) == rows(tables.metrics.manifests(kept, left))
    assert spark.read.parquet(f"{tmp_path}/run/failed_runs").count() == 2 * stops  # the one without a number is listed, too


def test_records_meet_their_manifests_by_path(spark, tmp_path):
    for label, n in (("a", 2), ("b", 1)):
        (tmp_path / label).mkdir()
        (tmp_path / label / "tile_summary.csv").write_text("provider,x\n" + "".join(f"p,{i}\n" for i in range(n)))
        (tmp_path / label / "manifest.json").write_text(json.dumps({"provider": "p", "job_index": n}))
    results = tables.load_results(tables.read_manifests(spark, f"{tmp_path}/*/manifest.json"))
    rows = tables.load_records(results, "tile_summary_path", ["provider", "x"], f"{tmp_path}/*/tile_summary.csv").collect()
    assert sorted((r["result_run_label"], r["result_job_index"], r["x"]) for r in rows) == [("a", 2, "0"), ("a", 2, "1"), ("b", 1, "0")]


def test_files_equal_stored_tiles(spark, tmp_path):
    _, done = run(spark)
    tile_format.write_files(done, f"{tmp_path}/files", partitions=3)
    files = {r["output_path"]: bytes(r["content"]) for r in tile_format.read_files(spark, f"{tmp_path}/files").collect()}
    rows = outcome.fetched(done).select("run_label", "output_path", "stored_content", "source_kind", "metadata_path").collect()
    assert len(files) == len(rows)
    for r in rows:
        found = files[next(k for k in files if k.endswith(f"{r['run_label']}/{r['output_path']}"))]
        assert json.loads(found) == json.loads(r["stored_content"]) and found.startswith(b"{\n  ") if r["source_kind"] == "coverage_json" else found == bytes(r["stored_content"])
    beside = json.loads(next((tmp_path / "files").glob(f"*/{rows[0]['run_label']}/{rows[0]['metadata_path']}")).read_text())
    assert list(beside) == sorted(outcome.TILE_SUMMARY)


def test_packed_files_are_the_same_files(spark, tmp_path):
    """Rows of a few containers instead of two files and a folder a tile; unpacked, they are the tree that is written singly."""
    _, done = run(spark)
    tile_format.write_files(done, f"{tmp_path}/single", partitions=3)
    tile_format.write_files(done, f"{tmp_path}/packed", partitions=3, packed=True)
    assert len(list((tmp_path / "packed").rglob("*.parquet"))) <= 3
    tile_format.unpack_files(spark, f"{tmp_path}/packed", f"{tmp_path}/unpacked")
    tree = lambda name: {str(f.relative_to(tmp_path / name)): f.read_bytes() for f in (tmp_path / name).rglob("*") if f.is_file()}
    single, unpacked = tree("single"), tree("unpacked")
    times = [t.pop(k) for t in (single, unpacked) for k in [k for k in t if k.endswith(".metadata.json")]]
    assert {**single, "committed.json": b""} == {**unpacked, "committed.json": b""} and len(times) == 2 * outcome.fetched(done).count()
    read = {r["output_path"]: bytes(r["content"]) for r in tile_format.read_files(spark, f"{tmp_path}/packed", packed=True).collect()}
    assert read == {k: v for k, v in single.items() if k != "committed.json"}
    assert tables.read_images(spark, f"{tmp_path}/packed", packed=True).count() == len(single) - 1
    tile_format.unpack_files(spark, f"{tmp_path}/packed", f"{tmp_path}/some", F.endswith("output_path", F.lit(".mvt")))
    assert {k.split(".", 1)[1] for k in tree("some")} == {"mvt", "mvt.metadata.json", "json"}


def test_packed_manifests_read_as_those_of_files(spark, tmp_path):
    rows = spark.range(40).select(F.concat(F.lit("l"), "id").alias("run_label"), F.lit("ns").alias("namespace"), F.lit("s3cret").alias("access_token"))
    tables.pack_manifests(rows.coalesce(2), f"{tmp_path}/packed")
    assert len(list((tmp_path / "packed").rglob("*.parquet"))) == 2  # not a folder each
    read = {r["manifest_path"]: json.loads(r["document"]) for r in tables.packed_manifests(spark, f"{tmp_path}/packed").collect()}
    assert read == {f"ns/l{i}/manifest.json": {"namespace": "ns", "run_label": f"l{i}"} for i in range(40)}
