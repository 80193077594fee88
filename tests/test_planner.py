import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tilewright.plans.planner import AreaRequest, build_jobs, job_tiles, multi_source, to_frame
from tilewright.sources import catalog

AMSTERDAM = (4.728, 52.278, 5.079, 52.431)


def jobs(spark, *requests):
    return build_jobs(to_frame(spark, list(requests))).orderBy("request_id", "job_index").collect()


def test_auto_zoom_takes_the_largest_zoom_within_the_budget(spark):
    fits, none = jobs(spark, *[AreaRequest("apple_lookaround", AMSTERDAM, auto_zoom=True, max_source_tile_count=n) for n in (16, 0)])
    counts = {c["zoom"]: c["tile_count"] for c in fits["zoom_candidates"]}
    assert counts == {**{z: 1 for z in range(3, 9)}, 9: 2, 10: 2, 11: 6, 12: 20, 13: 63, 14: 221, 15: 792, **{z: 11997 for z in range(16, 21)}}
    assert (fits["display_zoom"], fits["tile_count"], fits["source_kind"]) == (11, 6, "vector_mvt")
    assert fits["run_label"] == "apple_lookaround_layered_subbox_00"
    assert (none["display_zoom"], none["tile_count"]) == (3, 1)


def test_grid_and_selection(spark):
    got = jobs(spark, AreaRequest("kartaview", (0, 0, 2, 4), grid_rows=2, grid_cols=2), AreaRequest("kartaview", {"min_lon": 0, "min_lat": 0, "max_lon": 2, "max_lat": 4}, grid_rows=2, grid_cols=2, target_subboxes=[3, 0, 9, 0]))
    boxes = [tuple(r["bbox"]) for r in got if r["request_id"] == 0]
    assert boxes == [(0, 0, 1, 2), (1, 0, 2, 2), (0, 2, 1, 4), (1, 2, 2, 4)]
    assert [r["job_index"] for r in got if r["request_id"] == 1] == [0, 3]


def test_zooms_presets_and_labels(spark):
    got = jobs(spark, AreaRequest("apple_lookaround", preset="amsterdam_city_bbox_approx", display_zoom=0), AreaRequest("baidu", preset="hong_kong_urban_bbox_approx", run_label="mine"), AreaRequest("yandex", (37.53, 55.73, 37.60, 55.76)))
    assert [(r["display_zoom"], r["source_zoom"], r["tile_count"]) for r in got] == [(18, 17, 11997), (13, 13, 35), (13, 13, 6)]
    assert got[1]["run_label"] == "mine_subbox_00"


@pytest.mark.parametrize("bad", [AreaRequest("nobody", AMSTERDAM), AreaRequest("kartaview"), AreaRequest("kartaview", preset="nowhere"), AreaRequest("apple_lookaround", AMSTERDAM, display_zoom=2), AreaRequest("apple_lookaround", AMSTERDAM, auto_zoom=True, min_display_zoom=9, max_display_zoom=5)])
def test_errors(spark, bad):
    with pytest.raises(PySparkException):
        jobs(spark, bad)


def test_bad_boxes_and_grids(spark):
    with pytest.raises(ValueError):
        to_frame(spark, [AreaRequest("kartaview", (1, 2, 3))])
    with pytest.raises(ValueError):
        to_frame(spark, [AreaRequest("kartaview", AMSTERDAM, grid_rows=0)])


def test_multi_source_and_tiles(spark):
    df = build_jobs(multi_source(spark, AreaRequest("", AMSTERDAM, auto_zoom=True), zooms={"kartaview": 10}, tokens={"mapillary": "t"}))
    rows = {r["provider"]: r for r in df.collect()}
    assert list(rows) and set(rows) == set(catalog.MULTI_SOURCE)
    assert rows["kartaview"]["display_zoom"] == 10 and rows["apple_lookaround"]["display_zoom"] == 11 and rows["panoramax"]["display_zoom"] == 13
    tiles = job_tiles(df.where("provider = 'kartaview'"))
    assert tiles.count() == rows["kartaview"]["tile_count"]
    assert job_tiles(df.where("provider = 'kartaview'"), (525, 525)).select(F.max("x")).first()[0] == 525


def test_catalog(spark):
    assert catalog.providers(spark).count() == 7 and catalog.sources(spark).count() == 9 and catalog.presets(spark).count() == 4 and catalog.downloads(spark).count() == 3
    bounds = {r["provider"]: (r["zoom_min"], r["zoom_max"]) for r in catalog.zoom_bounds(spark).collect()}
    assert bounds["apple_lookaround"] == (3, 20)
    assert [r["note"] == "-" for r in catalog.notes(spark, "-").collect()].count(False) == 2
