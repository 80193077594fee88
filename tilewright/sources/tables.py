"""Record tables, manifests and exports."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tilewright.operators import metrics, outcome


def read_csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """All columns as text; a path that isn't there is an empty table."""
    schema = ", ".join(f"`{c}` string" for c in columns)
    try:
        return spark.read.schema(schema).csv(path, header=True, multiLine=True, escape='"')
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            return spark.createDataFrame([], schema)
        raise


def write_csv(df: DataFrame, path: str, columns: list[str], folders: tuple[str, ...] = ()) -> None:
    """Columns in order, header always, nulls empty, booleans as True and False; with ``folders``, a folder for each of their values."""
    kinds = dict(df.dtypes)
    shown = [F.initcap(F.col(c).cast("string")).alias(c) if kinds.get(c) == "boolean" else F.col(c) if c in kinds else F.lit("").alias(c) for c in columns]
    rows = df.select(*shown, *[F.col(c).alias(f"in_{c}") for c in folders])
    writer = rows.write.mode("overwrite").options(header=True, nullValue="", emptyValue="", escape='"')
    (writer.partitionBy(*[f"in_{c}" for c in folders]) if folders else writer).csv(path)


def read_manifests(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``document, manifest_path``: whole JSON files, kept as text because which keys are there matters."""
    paths = [paths] if isinstance(paths, str) else paths
    return spark.read.text(paths, wholetext=True).select(F.col("value").alias("document"), F.col("_metadata.file_path").alias("manifest_path"))


def load_results(manifests: DataFrame) -> DataFrame:
    """Manifests with paths of their tables (beside the file, if they name none), job 0 and the folder's name as defaults."""
    j, folder = F.col("document"), F.regexp_replace("manifest_path", "/[^/]*$", "")
    path = lambda key, name: F.coalesce(F.get_json_object(j, f"$.{key}"), F.concat(folder, F.lit(f"/{name}"))).alias(key)
    return manifests.select(
        "*",
        F.get_json_object(j, "$.provider").alias("provider"),
        F.coalesce(F.get_json_object(j, "$.job_index").cast("int"), F.lit(0)).alias("job_index"),
        F.coalesce(F.get_json_object(j, "$.run_label"), F.regexp_extract(folder, "[^/]+$", 0)).alias("run_label"),
        path("tile_summary_path", "tile_summary.csv"),
        path("pano_records_path", "pano_records.csv"),
        path("vector_feature_records_path", "vector_feature_records.csv"),
    )


def write_table(df: DataFrame, path: str, *folders: str) -> None:
    """Parquet by folders. A table without rows is one file without rows, so that it can be read."""
    df.write.mode("overwrite").partitionBy(*folders).parquet(path)
    if not df.sparkSession.read.schema(df.schema).parquet(path).rdd.getNumPartitions():  # files are listed, none is opened
        df.limit(0).write.mode("overwrite").parquet(path)


def _written(df: DataFrame, path: str) -> DataFrame:
    """Rows written as Parquet, to be read from there; the schema is known, no file is opened for it."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


RECORDS = ("tile_summary", "pano_records", "feature_records", "error_tiles", "skipped_tiles")


def write_run(jobs: DataFrame, processed: DataFrame, path: str, with_tiles: bool = True, written: bool = False, raise_failed: bool = True) -> None:
    """All tables of a run, as Parquet by provider and label, committed run by run.

    Outcomes are written first (``outcomes``; not again if ``processed`` is ``written``), so that no tile is read or decoded twice. Runs that are to stop
    on errors and have one are found by one aggregate (``failed_runs``, with the first error of each); the tables have the rows of all other runs,
    and ``committed``, the list of these runs, is written last: :func:`read_run` shows no other. Tiles that were read stay in ``tiles_raw``, whatever became of their run.
    At the end the first failed run raises, unless ``raise_failed`` is False. Access tokens of jobs are not written.
    """
    spark, jobs = processed.sparkSession, jobs.drop("access_token", "extra_headers")
    if not written:
        kept = [c for c in processed.columns if c not in ("content", "plain", "png")]
        processed = _written(processed.select(*kept), f"{path}/outcomes")
    failed = _written(outcome.first_errors(processed), f"{path}/failed_runs")
    good = processed if failed.isEmpty() else processed.join(failed.select(*outcome.RUN), outcome.RUN, "left_anti")
    for name in RECORDS:
        write_table(getattr(outcome, name)(good), f"{path}/{name}", "provider", "run_label")
    if with_tiles:
        tiles = outcome.fetched(processed).where(F.col("stored_content").isNotNull())
        write_table(tiles.select("source_id", "source_zoom", "x", "y", F.col("stored_content").alias("content"), "content_type", "output_path"), f"{path}/tiles_raw", "source_id", "source_zoom")
    kept_jobs = jobs.join(failed.select(*outcome.RUN), outcome.RUN, "left_anti")
    runs = _written(metrics.manifests(kept_jobs, good), f"{path}/manifests").select(*outcome.RUN, "provider", "tile_count", "error_count")
    runs.write.mode("overwrite").parquet(f"{path}/committed")
    if raise_failed:
        outcome.raise_first(failed)


def read_run(spark: SparkSession, path: str, table: str, which: Column | None = None) -> DataFrame:
    """A record table of a written run: the rows of committed jobs, or of those among them whose manifest matches ``which``.

    Tables are laid out by provider and label, so only the folders of matching manifests are read (dynamic partition pruning).
    """
    keys = [*outcome.RUN, "provider"]
    jobs = spark.read.parquet(f"{path}/committed").select(*keys)
    if which is not None:
        jobs = spark.read.parquet(f"{path}/manifests").where(which).select(*keys).join(jobs, keys, "left_semi")
    jobs = jobs.distinct().withColumnsRenamed({k: f"_{k}" for k in keys})
    rows = spark.read.parquet(f"{path}/{table}")
    same = [rows[k] == jobs[f"_{k}"] for k in keys]
    return rows.join(jobs, same, "left_semi")


def load_records(results: DataFrame, key: str, columns: list[str], files: str) -> DataFrame:
    """Rows of the CSV tables that results name in ``key`` (:func:`load_results`), with the results' provider, job and label beside them.

    ``files`` is a pattern of paths that holds them all; a table is a file or a folder of part files. Results and tables meet by path, so any number of manifests is one scan.
    """
    spark = results.sparkSession
    rows = spark.read.schema(", ".join(f"`{c}` string" for c in columns)).csv(files, header=True, multiLine=True, escape='"')
    plain = lambda c: F.regexp_replace(c, "^file:/*", "/")
    place = F.regexp_replace(F.url_decode(plain(F.col("_metadata.file_path"))), "/part-[^/]*$", "")
    rows = rows.select("*", place.alias("_place"))
    own = results.select(plain(F.col(key)).alias("_place"), F.col("provider").alias("result_provider"), F.col("job_index").alias("result_job_index"), F.col("run_label").alias("result_run_label"))
    return rows.join(own, "_place").drop("_place")


def _pretty(rows: pd.Series) -> pd.Series:
    return rows.map(lambda r: None if r is None else json.dumps(json.loads(r), indent=2, sort_keys=True))


def pretty_text(document: Column) -> Column:
    """JSON texts with sorted keys and an indent of two."""
    return F.pandas_udf(_pretty, "string")(document)


def pretty_json(row: Column) -> Column:
    """A struct as such a text, nulls included."""
    return pretty_text(F.to_json(row, {"ignoreNullFields": "false"}))


def manifest_json(manifests: DataFrame) -> DataFrame:
    """``manifest_path, document``: each manifest row as JSON with sorted keys and an indent of two."""
    path = F.concat_ws("/", "namespace", "run_label", F.lit("manifest.json"))
    kept = F.struct(*[c for c in manifests.columns if c not in ("access_token", "extra_headers")])
    return manifests.select(path.alias("manifest_path"), pretty_json(kept).alias("document"))


def export_files(spark: SparkSession, run: str, path: str) -> None:
    """A written run as files for other tools: CSV tables, and a JSON manifest for each job that names them, by namespace and label.

    :func:`load_results` over :func:`read_manifests` of ``manifests/*/*/*`` finds the tables; skipped and failed tiles are JSON lines, where there are any.
    """
    manifests, folders = spark.read.parquet(f"{run}/manifests"), ("provider", "run_label")
    names = {"tile_summary": ("tile_summary_path", outcome.TILE_SUMMARY), "pano_records": ("pano_records_path", outcome.PANO_RECORDS), "feature_records": ("vector_feature_records_path", outcome.FEATURE_RECORDS)}
    place = F.concat(F.lit("/in_provider="), F.col("provider"), F.lit("/in_run_label="), F.col("run_label"))
    for name, (key, columns) in names.items():
        write_csv(spark.read.parquet(f"{run}/{name}"), f"{path}/{name}.csv", columns, folders)
        manifests = manifests.withColumn(key, F.concat(F.lit(f"{path}/{name}.csv"), place))
    for name in ("skipped_tiles", "error_tiles"):
        spark.read.parquet(f"{run}/{name}").write.mode("overwrite").json(f"{path}/{name}")
    documents = manifest_json(manifests).select(F.split_part("manifest_path", F.lit("/"), F.lit(1)).alias("namespace"), F.split_part("manifest_path", F.lit("/"), F.lit(2)).alias("run_label"), "document")
    documents.write.mode("overwrite").partitionBy("namespace", "run_label").text(f"{path}/manifests")


def pack_manifests(manifests: DataFrame, path: str) -> None:
    """The files of :func:`manifest_json` as rows of Parquet containers: for more manifests than a disk should have folders."""
    manifest_json(manifests).write.mode("append").parquet(path)


def packed_manifests(spark: SparkSession, path: str) -> DataFrame:
    """Packed manifests as :func:`read_manifests` gives them."""
    return spark.read.parquet(path).select("document", "manifest_path")


def read_images(spark: SparkSession, path: str, packed: bool = False) -> DataFrame:
    """Files as a table with ``path`` and ``content``; of ``packed`` ones (:func:`tilewright.sources.tile_format.write_files`) with their places."""
    if packed:
        return spark.read.parquet(path).where("output_path IS NOT NULL AND content IS NOT NULL").select(F.col("output_path").alias("path"), "content")
    return spark.read.format("binaryFile").load(path)
