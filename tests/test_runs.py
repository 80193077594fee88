"""From requests over stored tiles to tables, manifests, summaries, exports, streams and the command line."""

import gzip
import hashlib
import json

import pytest
from pyspark.sql import functions as F
from test_decode import RGBA, png, tile

from tilewright import api, cli
from tilewright.operators import compare, decode, metrics, outcome
from tilewright.plans.planner import AreaRequest, build_jobs, job_tiles, to_frame
from tilewright.sources import catalog, tables, transport
from tilewright.streaming import tiles as streaming

BOX = (4.728, 52.278, 5.079, 52.431)
PANOS = json.dumps({"lastModified": "m", "panos": [{"panoid": "p", "lat": 1.0, "lon": 2.0}]}).encode()
CLEAR = png(1, 1, 8, 4, [b"\0\0\0"])


@pytest.fixture(scope="module")
def stored(spark):
    raster = lambda i, content, status=200, kind="image/png", error=None: ("kartaview_sequence_tiles", 10, 525 + i % 2, 336 + i // 2, status, kind, content, error)
    rows = [raster(0, RGBA), raster(1, b"broken")]
    rows += [("apple_lookaround_cached_bluelines", 11, x, y, 200, "", gzip.compress(tile()), None) for x in range(1050, 1053) for y in range(672, 674)]
    rows += [("yandex_stv_tiles_png", 10, 618, 321, 204, "", None, None), ("yandex_stv_tiles_png", 10, 618, 320, 200, "image/png", CLEAR, None), ("panoramax_xyz_mvt", 10, 525, 336, None, None, None, "timeout")]
    return spark.createDataFrame(rows, transport.STORED)


@pytest.fixture(scope="module")
def run(spark, stored):
    given = dict(bbox=BOX, display_zoom=10, stop_on_error=False)
    requests = [AreaRequest("kartaview", **given), AreaRequest("apple_lookaround", BOX, display_zoom=11, stop_on_error=False), AreaRequest("panoramax", **given), AreaRequest("svmap_google", **given), AreaRequest("kartaview", dry_run=True, **given)]
    jobs = api.plan(spark, requests).cache()
    return jobs, api.process(jobs, stored).cache()


def test_outcomes(run):
    _, done = run
    got = {(r["provider"], r["x"], r["y"]): (r["outcome"], r["is_empty"], r["reason"]) for r in done.where("request_id IN (0, 2)").collect()}
    assert got["kartaview", 525, 336] == ("fetched", False, None)
    assert got["kartaview", 526, 336][0] == "error" and got["panoramax", 525, 336] == ("error", None, "timeout")
    assert got["panoramax", 526, 336] == ("skipped", None, "http_404")
    assert done.where("request_id = 4").count() == 0  # a dry run reads nothing


def test_record_tables(run):
    _, done = run
    summary = outcome.tile_summary(done)
    assert summary.columns == [*outcome.RUN, *outcome.TILE_SUMMARY]
    row = summary.where("provider = 'kartaview'").first()
    assert (row["coverage_pixel_count"], row["total_pixel_count"], row["coverage_ratio"], row["output_path"]) == (2, 4, 0.5, "tiles/10/525/336.png")
    vector = summary.where("provider = 'apple_lookaround'")
    assert vector.count() == 6 and vector.first()["was_gzip_compressed"] and json.loads(vector.first()["layer_counts_json"]) == {"a": 1, "b": 2}
    assert outcome.feature_records(done).columns == [*outcome.RUN, *outcome.FEATURE_RECORDS]
    assert outcome.feature_records(done).count() == 0  # that decoder keeps only configured layers
    assert {r["reason"] for r in outcome.skipped_tiles(done).collect()} == {"http_404"} and outcome.error_tiles(done).count() == 2


def test_special_and_json_sources(spark):
    columns = "request_id long, job_index int, run_label string, provider string, source_id string, source_kind string, display_zoom int, source_zoom int, x long, y long, tile_url string, http_status int, content_type string, content binary, transport_error string, fetched_at string, options map<string,string>, content_type_prefix string, skip_404 boolean, stop_on_error boolean, storage_subdir string, decoder string, layer_names array<string>"
    special = {"config_kind": "yandex_stv_renderer"}
    row = lambda x, kind, status, ctype, content, options=special: (1, 0, "r", "p", "s", kind, 1, 1, x, 0, "u", status, ctype, content, None, "t", options, "image/", True, True, None, None, [])
    rows = [row(0, "raster", 204, "", None), row(1, "raster", 200, "image/png", CLEAR), row(2, "raster", 200, "image/png", RGBA), row(3, "raster", 200, "text/html", b"x", {}), row(4, "coverage_json", 200, "text/html", gzip.compress(PANOS)), row(5, "coverage_json", 200, "", b"{"), row(6, "other", 200, "image/x", b"x"), row(7, "raster", 404, "", None), row(8, "vector_mvt", 200, "", b"\x1f\x8bno")]
    done = outcome.process_tiles(spark.createDataFrame(rows, columns)).cache()
    got = {r["x"]: (r["outcome"], r["is_empty"], r["stored_byte_length"] > 0) for r in done.collect()}
    assert [got[i][:2] for i in range(9)] == [("fetched", True), ("fetched", True), ("fetched", False), ("skipped", None), ("fetched", None), ("error", None), ("error", None), ("skipped", None), ("error", None)]
    assert got[1][2] and not got[0][2]
    panos = outcome.pano_records(done).collect()
    assert [(r["panoid"], r["lat"], r["lastModified"]) for r in panos] == [("p", 1.0, "m")]
    assert outcome.first_errors(done).first()["error"]["x"] == 5
    with pytest.raises(RuntimeError):
        outcome.raise_on_errors(done)


AS_READ = "request_id long, job_index int, run_label string, provider string, source_id string, source_kind string, display_zoom int, source_zoom int, x long, y long, tile_url string, http_status int, content_type string, content binary, transport_error string, fetched_at string, options map<string,string>, content_type_prefix string, skip_404 boolean, stop_on_error boolean, storage_subdir string, decoder string, layer_names array<string>"


def as_read(spark, given):
    """Tiles as read, with x from 0: kind, status and content of each."""
    rows = [(x % 7, 0, "r", "p", "s", kind, 1, 1, x, 0, "https://h/t", status, "image/png", content, None, "2026-01-01T00:00:00+00:00", {}, "image/", True, True, None, None, []) for x, (kind, status, content) in enumerate(given)]
    return spark.createDataFrame(rows, AS_READ)


def inflated(data):
    try:
        return gzip.decompress(data) if data and data[:2] == b"\x1f\x8b" else data
    except (OSError, EOFError):
        return None


@pytest.mark.parametrize("one_pass", [False, True])
def test_bytes_of_odd_tiles(spark, one_pass):
    """Inflated bytes, hashes and errors of tiles that are null, empty, short, zipped, zipped nothing, zipped twice or broken; some come twice."""
    bodies = [None, b"", b"\x1f", b"\x1f\x8b", b"\x1f\x8bno", tile(), gzip.compress(tile()), gzip.compress(b""), gzip.compress(gzip.compress(tile())), gzip.compress(tile())[:-3], gzip.compress(tile()) * 2, RGBA, gzip.compress(PANOS), PANOS]
    texts = [b for b in bodies if (inflated(b) or b"").isascii()]  # what Spark's decode takes
    given = [(kind, status, body) for kind in ("vector_mvt", "coverage_json", "raster", "other", None) for status in (200, 404, 500) for body in (texts if kind == "coverage_json" else bodies)] * 2
    rows = outcome.process_tiles(as_read(spark, given), one_pass).select("x", "outcome", "reason", "wire_sha256", "stored_sha256", "stored_byte_length", "was_gzip_compressed", "plain", "mvt", "png").collect()
    assert len(rows) == len(given)
    for r in rows:
        kind, status, body = given[r["x"]]
        ok = status == 200 and kind != "other"
        plain = None if not ok or kind is None else body if kind == "raster" else inflated(body)
        assert (r["plain"], r["stored_byte_length"]) == (plain, len(plain or b""))
        assert (r["wire_sha256"], r["stored_sha256"]) == tuple(hashlib.sha256(b or b"").hexdigest() for b in (body, plain))
        read = decode.decode_rows([plain])[0] if kind == "vector_mvt" and body and plain is not None else {"layers": None, "error": None}
        assert (r["mvt"]["layers"] and [x["name"] for x in r["mvt"]["layers"]], r["mvt"]["error"]) == (read["layers"] and [x["name"] for x in read["layers"]], read["error"])
        if ok and kind == "vector_mvt":
            zipped_but_broken = bool(body) and body[:2] == b"\x1f\x8b" and plain is None
            assert (r["outcome"], r["reason"]) == (("error", "broken gzip") if zipped_but_broken else ("error", read["error"]) if read["error"] else ("fetched", None))


def test_tiles_go_to_python_once(spark):
    plan = outcome.process_tiles(as_read(spark, [("raster", 200, RGBA)]), one_pass=True).select("outcome", "wire_sha256", "stored_sha256", "record_count")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and plan.count("sha2(") == 2 and "THEN wire_sha256#" in plan


def test_sums_of_a_batch_are_few_files(spark, tmp_path):
    """Sums of a batch are planned by their size, however many tasks the stream has; null ids and jobs without tiles are kept."""
    tiles = as_read(spark, [("raster", 200, RGBA), ("vector_mvt", 200, tile()), ("raster", 404, None)] * 20)
    tiles = tiles.withColumn("request_id", F.expr("nullif(request_id, 3)"))
    tiles.write.parquet(f"{tmp_path}/in")
    stream = streaming.arriving_tiles(spark, f"{tmp_path}/in", tiles.schema)
    streaming.keep_manifests(stream, f"{tmp_path}/out", f"{tmp_path}/checkpoint").awaitTermination(120)
    assert [len(list(p.glob("*.parquet"))) for p in (tmp_path / "out" / "partials").iterdir()] in ([1], [1, 1])  # the last batch may be empty
    jobs = tiles.select("request_id", "job_index").distinct().union(spark.sql("SELECT 99L, 0"))
    kept = streaming.kept_manifests(spark, jobs, f"{tmp_path}/out")
    rows = lambda df: sorted(repr(r.asDict()) for r in df.collect())
    assert rows(kept) == rows(metrics.manifests(jobs, outcome.process_tiles(tiles)))
    assert kept.where("request_id = 99").first()["tile_count"] == 0 and kept.count() == 8


def test_manifests_and_summaries(spark, run):
    jobs, done = run
    rows = {r["request_id"]: r for r in metrics.manifests(jobs, done).collect()}
    k = rows[0]
    assert (k["tile_count"], k["error_count"], k["total_coverage_pixels"], k["total_pixels"], k["aggregate_coverage_ratio"], k["nonempty_tile_count"]) == (1, 1, 2, 4, 0.5, 1)
    assert rows[1]["vector_feature_record_count"] == 18 and rows[1]["aggregate_coverage_ratio"] is None
    assert rows[3]["tile_count"] == 0 and rows[3]["skipped_404_count"] == 2 and rows[4]["skipped_404_count"] == 0
    files = tables.manifest_json(metrics.manifests(jobs, done)).collect()
    document = json.loads(files[0]["document"])
    assert files[0]["document"].startswith('{\n  "') and list(document) == sorted(document) and "aggregate_coverage_ratio" in document
    summary = compare.summarize(metrics.manifests(jobs, done))
    assert summary.columns == compare.SUMMARY and summary.count() == 5
    panels = {r["source_id"]: (r["panel_row"], r["panel_column"]) for r in compare.panels(summary.where("run_label NOT LIKE 'none'"), 2).dropDuplicates(["source_id"]).collect()}
    assert panels["apple_lookaround_cached_bluelines"] == (0, 0)
    assert metrics.rollup(metrics.manifests(jobs, done)).where("provider IS NULL").first()["coverage_ratio"] == 0.5


def test_manifest_files(spark, tmp_path):
    folder = tmp_path / "ns" / "label_7"
    folder.mkdir(parents=True)
    (folder / "m.json").write_text(json.dumps({"provider": "p", "source_id": "s", "display_zoom": 3, "source_zoom": 3, "tile_count": None, "fetched_tile_count": 9, "skipped_tile_count": 2, "pano_records_path": "x"}))
    files = tables.read_manifests(spark, [str(folder / "m.json")])
    row = compare.summarize_documents(files).first()
    assert (row["run_label"], row["source_kind"], row["job_index"], row["tile_count"], row["skipped_404_count"], row["error_count"]) == ("label_7", "coverage_json", -1, None, 2, 0)
    assert compare.summarize_results(files).first()["job_index"] == 0
    loaded = tables.load_results(files).first()
    assert loaded["run_label"] == "label_7" and loaded["tile_summary_path"].endswith("/label_7/tile_summary.csv") and loaded["pano_records_path"] == "x"


def test_csv(spark, tmp_path):
    df = spark.createDataFrame([(1, True, None, 'a "b", c'), (2, None, 0.5, "")], "x int, flag boolean, ratio double, text string").coalesce(1)
    tables.write_csv(df, f"{tmp_path}/t", ["x", "flag", "none", "ratio", "text"])
    lines = next((tmp_path / "t").glob("*.csv")).read_text().splitlines()
    assert lines[0] == "x,flag,none,ratio,text" and lines[1].startswith("1,True,,,")
    back = tables.read_csv(spark, f"{tmp_path}/t", ["x", "flag", "none", "ratio", "text"]).orderBy("x").collect()
    assert back[0]["text"] == 'a "b", c' and back[0]["flag"] == "True"
    assert tables.read_csv(spark, f"{tmp_path}/absent", ["x"]).count() == 0


def test_layers_for_drawing(spark):
    df = spark.createDataFrame([("raster", "o", 4207, 2692, 13, "web_mercator"), ("raster", "", 1, 1, 3, "baidu")], "source_kind string, output_path string, x long, y long, source_zoom int, scheme string")
    a, b = compare.tile_frames(df).collect()
    assert a["overlay"] and a["centre"]["lon"] == pytest.approx(4.89990234375) and not b["overlay"] and b["bounds"] is None
    features = spark.createDataFrame([("MULTILINESTRING ((0 0, 1 1), (2 2, 3 3))",)], "geometry_wkt string")
    assert [r["part_index"] for r in compare.segments(features).collect()] == [0, 1]
    assert compare.points(spark.createDataFrame([(1.0, None), (1.0, 2.0)], "lon double, lat double")).count() == 1
    box = spark.range(1).select(compare.viewport(F.struct(F.lit(0.0).alias("min_lon"), F.lit(2.0).alias("min_lat"), F.lit(10.0).alias("max_lon"), F.lit(1.0).alias("max_lat")), 0.1)).first()[0]
    assert tuple(box) == (-1.0, 2.0, 11.0, 1.0)
    assert {r["label"]: r["colour"] for r in compare.with_labels(spark.createDataFrame([("baidu_mapsv_raster",), ("x",)], "provider string")).collect()} == {"baidu": "#b15928", "x": catalog.OTHER_COLOUR}


def test_injected_fetch_and_tokens(spark):
    def fetch(url, headers, timeout):
        if url.endswith("336"):
            return b"", "", 204
        raise TimeoutError(f"{timeout} {'token' in url}")

    jobs = build_jobs(to_frame(spark, [AreaRequest("mapillary", BOX, display_zoom=10, access_token="token", stop_on_error=False)]))
    rows = api.process(jobs, fetch=fetch).select("outcome", "reason").collect()
    assert {tuple(r) for r in rows} == {("error", "TimeoutError: 60 True")}
    hidden = transport.tile_requests(api.planner.job_tiles(jobs)).first()["tile_url"]
    assert hidden.endswith("?access_token=REDACTED")
    raw = transport.read_by(transport.raw_range(spark, "s", "u/{z}/{x}/{y}", 3, (1, 2), (336, 336)), fetch)
    found = transport.raw_manifest(raw).first()
    assert (found["tile_count"], found["x_min"], found["x_max"], found["y_max"]) == (2, 1, 2, 336)
    assert {(r["stored_file"], r["byte_length"]) for r in transport.raw_files(raw).collect()} == {("3/1/336.bin", 0), ("3/2/336.bin", 0)}


def test_no_secret_is_written(spark, tmp_path):
    """Fetched runs: neither the token nor a header's value is in any file or message."""
    secret, header, body = "S3CR*T~value", "h3ader-value", tile()

    def fetch(url, headers, timeout):
        if "336" in url:
            assert "S3CR%2AT~value" in url and headers["X-Key"] == header
            return body, "application/x-protobuf", 200
        raise OSError(f"no route to {url} with {secret} and {headers}")

    given = dict(bbox=BOX, display_zoom=9, access_token=secret, extra_headers={"X-Key": header})
    jobs = build_jobs(to_frame(spark, [AreaRequest("mapillary", stop_on_error=False, **given)]))
    done = api.process(jobs, fetch=fetch)
    assert not {"access_token", "headers", "extra_headers", "fetch_url"} & set(done.columns)
    done.write.parquet(f"{tmp_path}/processed")
    tables.write_run(jobs, spark.read.parquet(f"{tmp_path}/processed"), f"{tmp_path}/run")
    tables.export_files(spark, f"{tmp_path}/run", f"{tmp_path}/files")
    for path in (f"{tmp_path}/processed", *(f"{tmp_path}/run/{n}" for n in ("tile_summary", "pano_records", "feature_records", "error_tiles", "skipped_tiles", "tiles_raw", "manifests"))):
        text = "\n".join(spark.read.parquet(path).drop("content", "plain", "stored_content").toJSON().collect())
        assert not any(x in text for x in (secret, "S3CR", header))
    for path in tmp_path.rglob("files/**/*"):
        assert path.is_dir() or not any(x in path.read_bytes() for x in (b"S3CR", header.encode()))
    stopping = api.process(build_jobs(to_frame(spark, [AreaRequest("mapillary", **given)])), fetch=lambda *a: (_ for _ in ()).throw(OSError(a[0])))
    with pytest.raises(RuntimeError) as e:
        outcome.raise_on_errors(stopping)
    assert "REDACTED" in str(e.value) and "S3CR" not in str(e.value)


def test_runs_are_read_back(spark, run, tmp_path):
    jobs, done = run
    tables.write_run(jobs, done.where("source_kind = 'raster' AND outcome = 'fetched'"), f"{tmp_path}/run")
    counts = {n: spark.read.parquet(f"{tmp_path}/run/{n}").count() for n in ("tile_summary", "pano_records", "feature_records", "error_tiles", "skipped_tiles", "manifests")}
    assert counts == {"tile_summary": 1, "pano_records": 0, "feature_records": 0, "error_tiles": 0, "skipped_tiles": 0, "manifests": 5}
    tables.export_files(spark, f"{tmp_path}/run", f"{tmp_path}/files")
    loaded = tables.load_results(tables.read_manifests(spark, f"{tmp_path}/files/manifests/*/*/*")).where("provider = 'kartaview'").first()
    back = tables.read_csv(spark, loaded["tile_summary_path"], outcome.TILE_SUMMARY)
    assert [(r["provider"], r["x"], r["coverage_pixel_count"], r["is_empty"]) for r in back.collect()] == [("kartaview", "525", "2", "False")]
    assert tables.read_csv(spark, loaded["pano_records_path"], outcome.PANO_RECORDS).count() == 0
    assert compare.summarize_documents(tables.read_manifests(spark, f"{tmp_path}/files/manifests/*/*/*")).where("tile_count > 0").count() == 1


PAGE = b'<html><script type="application/json" class="state-view">{"config": {"hosts": {"stvTiles": "https://0%d.core-stv-renderer.maps.yandex.net/2.x/tiles?l=stv\\u0026%c\\u0026v=%v\\u0026%l"}, "layers": {"stv": {"version": "9.8"}}}, "query": {"l": "sat"}}</script></html>'


def test_live_pages_give_version_and_template(spark):
    found = transport.discover(spark, lambda url, headers, timeout: (PAGE, "text/html", 200), "yandex")
    row = found.first()
    assert (row["config_source"], row["version"], row["query_layers"], row["config_error"]) == ("live_page", "9.8", "sat", None)
    jobs = build_jobs(to_frame(spark, [AreaRequest("yandex", BOX, display_zoom=8)]))
    wanted = transport.tile_requests(api.planner.job_tiles(jobs), discovered=found).first()
    assert wanted["tile_url"].startswith("https://core-stv-renderer.maps.yandex.net/2.x/tiles?l=stv&x=131&y=") and "&v=9.8&lang=en_US&scale=1" in wanted["tile_url"]
    for fetch in (lambda *a: (b"<html/>", "", 200), lambda *a: (_ for _ in ()).throw(TimeoutError("slow"))):
        row = transport.discover(spark, fetch, "yandex").first()
        assert row["config_source"] == "fallback" and row["version"] and row["config_error"] and row["template"] is None
    assert transport.discover(spark, None, "kartaview").first()["config_source"] == "catalog"
    style = transport.discover_style(spark, lambda *a: (b'cb({"version": "7", "tiles": ["t"]});', "", 200)).first()
    assert style["version"] == "7" and "/7/{z}" in style["overlay"]
    script = b'ROADVIEW:function(t,n,a){return"//h/sd/"+a+"/"+n+"/"+t+".png"},ROADVIEW_HD:function(t,n,a){return"//h/hd/"+a+"/"+n+"/"+t+".png"}'
    assert transport.discover_roadview(spark, lambda *a: (script, "", 200), "u").first()["standard"] == "https://h/sd/{level}/{tile_y}/{tile_x}.png"


def test_figures_and_job_indexes(spark):
    rows = [(r, j, f"p{i}", "s") for r in (1, 2) for j in (0, 1) for i in range(3)]
    df = spark.createDataFrame(rows, "request_id int, job_index int, provider string, source_id string")
    found = compare.panels(df, 2, figure=("request_id", "job_index")).collect()
    assert {(r["n_panels"], r["n_rows"]) for r in found} == {(3, 2)}
    assert [r["job_index"] for r in metrics.job_indexes(df).collect()] == [0, 1]
    with pytest.raises(ValueError):
        compare.panels(df, jobs=[7])


def test_downloads_carry_notes(spark, tmp_path):
    got = transport.download("panoramax", str(tmp_path), spark, lambda url, headers, timeout: (b"abc", "x/y", 200))
    assert (got["byte_length"], got["content_type"]) == (3, "x/y") and got["notes"] and (tmp_path / "panoramax.parquet").read_bytes() == b"abc"


def test_stream_equals_batch(spark, stored, run, tmp_path):
    jobs, done = run
    read = transport.read_stored(transport.tile_requests(api.planner.job_tiles(jobs.where("NOT dry_run"))), stored)
    for i in (1, 2):  # every tile arrives twice
        read.write.parquet(f"{tmp_path}/in/part={i}")
    stream = streaming.arriving_tiles(spark, f"{tmp_path}/in", read.schema)
    streaming.append_summaries(stream, f"{tmp_path}/out", f"{tmp_path}/checkpoint").awaitTermination(120)
    counts = lambda df: sorted((r["request_id"], r["tile_count"], r["error_count"]) for r in df.collect())
    assert counts(streaming.current_manifests(spark, jobs, f"{tmp_path}/out/*")) == counts(metrics.manifests(jobs, done))


def planner_tiles(jobs):
    return job_tiles(jobs.where("NOT dry_run"))


@pytest.mark.parametrize("compact_every", [2, 3, 16])
def test_kept_manifests_are_those_of_the_whole_table(spark, run, stored, tmp_path, compact_every):
    jobs, done = run
    read = transport.read_stored(transport.tile_requests(planner_tiles(jobs)), stored).withColumn("fetched_at", F.lit("2026-01-01T00:00:00+00:00"))
    read.repartition(5).write.parquet(f"{tmp_path}/in")
    read.limit(3).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")  # some arrive again
    stream = streaming.arriving_tiles(spark, f"{tmp_path}/in", read.schema, files_per_batch=1)
    out = f"{tmp_path}/out"
    streaming.keep_manifests(stream, out, f"{tmp_path}/checkpoint", compact_every).awaitTermination(120)
    rows = lambda: sorted(repr(r.asDict()) for r in streaming.kept_manifests(spark, jobs, out, compact_every).collect())
    expected = sorted(repr(r.asDict()) for r in metrics.manifests(jobs, done).collect())
    assert rows() == expected
    last = spark.read.parquet(f"{out}/partials").agg(F.max("batch")).first()[0]
    assert last >= 4
    names = [c for c in read.columns if c in spark.read.parquet(f"{tmp_path}/in").columns]
    seen = spark.read.parquet(f"{out}/summaries").where(F.col("batch") == last).select("request_id", "job_index", "x", "y")
    again = read.select(*names).join(seen, ["request_id", "job_index", "x", "y"], "left_semi")
    streaming.merge_batch(again, last, out, compact_every)  # the last batch is replayed
    assert rows() == expected
    if compact_every == 2:
        assert len(list((tmp_path / "out" / "bases").iterdir())) >= (last + 1) // 2
        tiles = spark.read.schema(read.schema).parquet(f"{tmp_path}/in").where("false")
        streaming.merge_batch(tiles, 0, f"{tmp_path}/none", compact_every)
        assert streaming.kept_manifests(spark, jobs, f"{tmp_path}/none", compact_every).agg(F.sum("tile_count")).first()[0] == 0


def test_command_line(spark, stored, tmp_path, capsys):
    stored.write.parquet(f"{tmp_path}/stored")
    box = [str(v) for v in BOX]
    common = ["--bbox", *box, "--display-zoom", "10", "--output-root", f"{tmp_path}/out"]
    assert cli.main(["list-providers"], spark) == 0 and cli.main(["provider-notes", "mapillary"], spark) == 0
    assert cli.main(["fetch-provider", "--provider", "kartaview", "--dry-run", *common], spark) == 0
    assert '"tile_count":2' in capsys.readouterr().out
    assert cli.main(["fetch-multi", "--provider", "kartaview", "--provider", "svmap_google", "--continue-on-error", "--stored-tiles", f"{tmp_path}/stored", *common], spark) == 0
    assert '"provider":"svmap_google"' in capsys.readouterr().out
    assert spark.read.parquet(f"{tmp_path}/out/tile_summary").count() == 1 and spark.read.parquet(f"{tmp_path}/out/tiles_raw").count() == 1
    with pytest.raises(RuntimeError):
        cli.main(["fetch-provider", "--provider", "kartaview", "--stored-tiles", f"{tmp_path}/stored", *common], spark)
    with pytest.raises(SystemExit):
        cli.main(["fetch-provider", "--provider", "kartaview", *common], spark)
    with pytest.raises(ValueError):
        cli.key_values(["x"])
