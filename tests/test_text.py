import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tilewright.functions import text

L = F.lit


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def test_suffixes(spark):
    urls = ["https://h/a/b.png?x=1", "/a/.png", "/a.tar.gz", "/t/1/2/", "https://h", "https://h/a.", "https://h.com/{z}|x.mvt#f.g"]
    assert one(spark, *[text.url_suffix(L(u)) for u in urls]) == (".png", ".bin", ".gz", ".bin", ".bin", ".bin", ".mvt")
    kinds = ["image/jpeg; q=1", "application/octet-stream", "", "application/x-protobuf"]
    assert one(spark, *[text.content_suffix(L(k), L("/a.pbf")) for k in kinds]) == (".jpg", ".pbf", ".pbf", ".mvt")


def test_urls(spark):
    assert one(spark, text.with_token(L("u?a=1"), L("t"), L("x y")), text.with_token(L("u"), L(""), L(None)), text.redact_token(L("u?t=abc&b=1"), L("t"))) == ("u?a=1&t=x+y", "u", "u?t=REDACTED&b=1")
    with pytest.raises(PySparkException):
        one(spark, text.with_token(L("u"), L("t"), L(None).cast("string")))
    assert one(spark, *[text.with_scheme(L(u)) for u in ("//h/x", "h/x", "http://h")]) == ("https://h/x", "https://h/x", "http://h")
    assert one(spark, text.normalise_tile_template(L("https://0%d.core-stv-renderer.maps.yandex.net/2.x/tiles?l=stv&%c\\u0026v=%v&%l"), L("sta")))[0] == "https://core-stv-renderer.maps.yandex.net/2.x/tiles?l=sta&x={x}&y={y}&z={z}&v={version}&lang=en_US&scale=1"
    assert one(spark, text.roadview_url(L("{level}/{tile_y}/{tile_x}/{z}"), L(3), L(4), L(5))) == ("3/5/4/3",)
    assert one(spark, text.picker_url(L("v"), L(1), L(2), L(3)))[0].startswith("https://map.pstatic.net/nrb/picker/basic/v/1/2/3.json")


def test_entries(spark):
    assert one(spark, text.parse_entries(F.array(L("A=1"), L("B = x=y"), L("A=2")))) == ({"A": "2", "B": "x=y"},)
    with pytest.raises(PySparkException):
        one(spark, text.parse_entries(F.array(L("nothing"))))
    a, b = F.create_map(L("x"), L("1"), L("y"), L("2")), F.create_map(L("y"), L("3"))
    assert one(spark, text.merge_headers(a, b), text.merge_headers(a, L(None).cast("map<string,string>"))) == ({"x": "1", "y": "3"}, {"x": "1", "y": "2"})


def test_frontends(spark):
    style = one(spark, text.style_config(L('cb({"version": "7", "tiles": ["t0", "t1"]});')))[0]
    assert style["version"] == "7" and style["base_style"] == "t0" and "/basic/7/{z}/{x}/{y}.png" in style["overlay"]
    html = 'x<script type="application/json" class="state-view">{"config":{"hosts":{"stvTiles":"T"},"layers":{"stv":{"version":"V"}}},"query":{"l":"stv"}}</script>'
    assert tuple(one(spark, text.page_state(L(html)))[0]) == ("T", "V", "stv")
    layer = lambda n: n + ':function(t,n,a){return"//h/' + n + '/"+a+"/"+n+"/"+t+".png"}'
    script = f'{layer("ROADVIEW")},{layer("ROADVIEW_HD")};e.RESOURCE_PATH={{A:"//r/a",B:"r/b"}};var c=e.onloadcallbacks,o=["v3"],m={{v3:r+"/mapjsapi/4.4.19/v3.js"}},l=1'
    config = one(spark, text.roadview_config(L(script)))[0]
    assert config["standard"] == "https://h/ROADVIEW/{level}/{tile_y}/{tile_x}.png" and config["resources"] == {"A": "https://r/a", "B": "https://r/b"} and config["versions"] == {"v3": "4.4.19"}
    assert one(spark, text.resource_paths(L("")), text.bundle_versions(L(""))) == ({}, {})
    for broken in (text.style_config(L("x")), text.page_state(L("x")), text.uri_templates(L("x")), text.roadview_config(L(layer("ROADVIEW")))):
        with pytest.raises(PySparkException):
            one(spark, broken)


def test_small_ones(spark):
    assert one(spark, text.wkt_type(L("Curve (1)")), text.wkt_type(L(None).cast("string")), text.run_label(L("p"), L(3)), text.tile_path(L(1), L(2), L(3))) == ("Curve", "Unknown", "p_subbox_03", "1/2/3.bin")
    assert one(spark, text.iso_utc(F.timestamp_seconds(L(1.9)))) == ("1970-01-01T00:00:01+00:00",)
    assert tuple(one(spark, text.hex_to_rgba(L("#1f78b4")))[0]) == (31, 120, 180, 190)
    assert one(spark, text.sorted_json(F.create_map(L("b"), L(1), L("a"), L(2)))) == ('{"a":2,"b":1}',)


def test_tokens_of_odd_parameters_are_replaced(spark):
    """The parameter is written form-encoded, and is no pattern."""
    url = F.lit("https://h/x?a=1")
    for parameter in ("access token", "a.b", "t[]", "k$", "(x"):
        full = text.with_token(url, F.lit(parameter), F.lit("s3cret&more"))
        row = spark.range(1).select(full.alias("full"), text.redact_token(full, F.lit(parameter)).alias("kept"), text.redact_token(F.lit("https://h/x?aXb=1"), F.lit(parameter)).alias("other")).first()
        assert "s3cret" in row["full"] and "s3cret" not in row["kept"] and row["kept"].endswith("=REDACTED") and row["other"].endswith("aXb=1")
