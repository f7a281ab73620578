"""What the driver keeps of the files of many scans."""

import json

from acopio.operators.discovery import manifest_from_paths
from acopio.sources import listing
from acopio.sources.readers import read_files

OPTIONS = {"csv": {"header": "true"}, "json": {}}


def _manifest(spark, folder):
    paths = []
    for i in range(7):
        (folder / f"v{i}.csv").write_text(f"a b;(c),path\n{i},p{i}\n")
        (folder / f"j{i}.json").write_text(json.dumps({"n": i if i % 2 else i + 0.5}))
        (folder / f"bad{i}.json").write_text("{[ not such a file")
        paths += [(str(folder / name),) for name in (f"v{i}.csv", f"j{i}.json", f"bad{i}.json", f"gone{i}.csv")]
    return manifest_from_paths(spark.createDataFrame(paths, "path string"))


def _plain(df):
    return sorted(str(sorted(r.asDict().items(), key=str)) for r in df.drop("ingestion_ts", "fecha_ingesta").collect())


def test_scans_beyond_what_is_held_are_written_one_by_one(spark, tmp_path):
    """The rows of many scans come from the shared folder: no plan holds the files they were read from."""
    manifest = _manifest(spark, tmp_path)
    read = lambda **more: read_files(manifest, OPTIONS, run_id="r", unzip_to="", **more)
    held, bounded = read(), read(files_per_scan=2, files_held=3)
    of_source = lambda df: [f for f in df.inputFiles() if f.endswith((".csv", ".json"))]
    assert len(of_source(held.rows)) == 14 and not of_source(bounded.rows) and not of_source(bounded.output())
    assert held.rows.columns == bounded.rows.columns and "a b;(c)" in bounded.rows.columns
    assert _plain(held.rows) == _plain(bounded.rows) and held.rows.count() == 14
    assert _plain(held.errors) == _plain(bounded.errors) and held.errors.count() == 14
    assert _plain(held.files) == _plain(bounded.files)
    assert spark.conf.get(listing._OPEN_COST, None) is None


def test_a_smaller_opening_cost_stays(spark):
    spark.conf.set(listing._OPEN_COST, "10")
    try:
        with listing.small_files_together(spark):
            assert spark.conf.get(listing._OPEN_COST) == "10"
        assert spark.conf.get(listing._OPEN_COST) == "10"
    finally:
        spark.conf.unset(listing._OPEN_COST)
