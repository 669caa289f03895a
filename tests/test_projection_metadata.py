"""Projections from grid-mapping attributes, and pruning of hourly files by their paths."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from chronogrid.config import ChunkPlan, GridSpec
from chronogrid.functions import projection as pj
from chronogrid.functions import timeaxis as ta
from chronogrid.session import scratch_path
from chronogrid.sources import hourly_files, manifest
from chronogrid.sources.gridstore import catalog_frame

LCC = {"grid_mapping_name": "lambert_conformal_conic", "standard_parallel": "30.0, 60.0", "latitude_of_projection_origin": "40",
       "longitude_of_central_meridian": "-97", "earth_radius": "6370000"}


def test_known_mappings():
    assert pj.from_attributes(LCC) == pj.GRID_LCC
    assert pj.from_attributes(LCC | {"standard_parallel": "[30. 60.]"}) == pj.GRID_LCC
    albers = {"grid_mapping_name": "albers_conical_equal_area", "standard_parallel": "29.5 45.5", "latitude_of_projection_origin": "23.0",
              "longitude_of_central_meridian": "-96", "semi_major_axis": "6378137", "inverse_flattening": "298.257222101"}
    assert pj.from_attributes(albers) == pj.POLY_ALBERS
    polar = {"grid_mapping_name": "lambert_azimuthal_equal_area", "latitude_of_projection_origin": "90", "longitude_of_projection_origin": "0"}
    assert pj.from_attributes(polar) == pj.AREA_LAEA
    axes = dict(LCC, semi_major_axis="6378137", semi_minor_axis="6356752.314140356")
    del axes["earth_radius"]
    assert math.isclose(pj.from_attributes(axes).ellipsoid.inv_f, pj.GRS80.inv_f, rel_tol=1e-9)


@pytest.mark.parametrize("change", [{"grid_mapping_name": "mercator"}, {"standard_parallel": ""}, {"standard_parallel": "1, 2, 3"},
                                    {"latitude_of_projection_origin": None}, {"longitude_of_central_meridian": "west"}])
def test_what_cannot_be_read_is_an_error(change):
    with pytest.raises(ValueError):
        pj.from_attributes(LCC | change)


def test_catalog_row(spark):
    assert pj.of_catalog(catalog_frame(spark, [("crs", [], LCC, {})])) == pj.GRID_LCC
    with pytest.raises(ValueError, match="no crs row"):
        pj.of_catalog(catalog_frame(spark, [("T2D", ["time"], {}, {})]))


def test_round_trips(spark):
    planes = [pj.from_attributes(LCC | {"standard_parallel": "33", "false_easting": "5e5", "false_northing": "-100"}),
              pj.LambertConformal(pj.WGS84, 33.0, 45.0, 39.0, -96.0, 100.0, 200.0), pj.LambertConformal(pj.GRS80, -30.0, -50.0, -40.0, 10.0),
              pj.AlbersEqualArea(pj.GRS80, 29.5, 45.5, 23.0, -96.0, 1000.0, -500.0)]
    for plane in planes:
        lon0, lat0 = plane.lon0, plane.lat1
        df = spark.createDataFrame([(lon0 + a, lat0 + b) for a in (-20.0, -1.0, 0.0, 15.0) for b in (-9.0, 0.0, 8.0)], "lon double, lat double")
        x, y = plane.forward("lon", "lat")
        f = df.select("lon", "lat", x.alias("x"), y.alias("y"))
        lon, lat = plane.inverse("x", "y")
        for r in f.select("lon", "lat", lon.alias("lon2"), lat.alias("lat2")).collect():
            assert r.lon2 == pytest.approx(r.lon, abs=1e-8) and r.lat2 == pytest.approx(r.lat, abs=1e-7)


def test_conformal_on_a_near_sphere_is_the_sphere(spark):
    near, sphere = pj.LambertConformal(pj.Ellipsoid(6370000.0, 1e12), 30.0, 60.0, 40.0, -97.0), pj.GRID_LCC
    df = spark.createDataFrame([(-110.0, 35.0), (-80.0, 50.0)], "lon double, lat double")
    for r in df.select(*near.forward("lon", "lat"), *sphere.forward("lon", "lat")).toDF("a", "b", "c", "d").collect():
        assert (r.a, r.b) == pytest.approx((r.c, r.d), abs=1e-2)


# --- file pruning ---------------------------------------------------------------
TEMPLATE = "{wrf_dir}/wy_dir={wy_dir}/fname={fdate:%Y%m%d%H%M}.LDASIN_DOMAIN1"
SPEC = GridSpec("2023-09-30 00:00:00", "hour", ChunkPlan(24, 2, 2))


def files_read(df):
    """Files that the plan's scan opened."""
    plan = df._jdf.queryExecution().executedPlan()
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    leaves, out = plan.collectLeaves(), []
    for k in range(leaves.size()):
        m = leaves.apply(k).metrics().get("numFiles")
        if m.isDefined():
            out.append(m.get().value())
    return out


def test_one_chunk_opens_its_files(spark):
    root = scratch_path(spark, "hourly-files")
    times = (spark.range(24 * 20).select((F.lit("2023-09-25").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.col("id").cast("int"))).alias("time"),
                                         F.lit(0).alias("y"), F.lit(0).alias("x"), F.col("id").cast("double").alias("T2D")))
    hourly_files.write_hourly_files(times.withColumns({"wy_dir": ta.water_year_dir("time"), "fname": F.date_format("time", "yyyyMMddHHmm'.LDASIN_DOMAIN1'")}), root)
    listing = hourly_files.list_files(spark, root)
    for first, last in ((3, 3), (0, 2)):        # the second spans the change of water years
        chunks = spark.range(first, last + 1).select(F.col("id").cast("int").alias("chunk"))
        m = manifest.verified_manifest(manifest.hourly_manifest(chunks, SPEC, root, TEMPLATE), listing, root, TEMPLATE)
        grid, _ = hourly_files.scan_manifest(spark, m, SPEC, first, last, root, TEMPLATE, ["T2D"])
        start = dt.datetime(2023, 9, 30) + dt.timedelta(days=first)
        hours = 24 * (last - first + 1)
        assert sorted(r.time for r in grid.collect()) == [start + dt.timedelta(hours=h) for h in range(hours)]
        inside = hourly_files.path_range(TEMPLATE, root, start, start + dt.timedelta(hours=hours - 1))
        scan = (spark.read.schema(hourly_files.hourly_schema(["T2D"])).option("recursiveFileLookup", "true")
                .parquet(hourly_files.year_folders(TEMPLATE, root, start, start + dt.timedelta(hours=hours))).where(inside).select("time", "T2D"))
        assert files_read(scan) == [hours]
        assert "file_path" in grid._jdf.queryExecution().optimizedPlan().toString()


def test_other_templates_are_not_pruned():
    times = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    assert hourly_files.path_range("{wrf_dir}/{wy_dir}/{fdate:%d%m%Y}.nc", "/x", *times) is None
    assert hourly_files.path_range("{wrf_dir}/{wy_dir}/{fdate:%Y%j}.nc", "/x", *times) is None
    assert hourly_files.path_range("{wrf_dir}/{wy_dir}/data.nc", "/x", *times) is None
