"""Registered queries: manifests, file scans, metadata and the variable catalog."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import ChunkPlan, GridSpec
from ..functions import timeaxis as ta
from ..functions import values as fv
from ..operators import catalog as cat
from ..session import scratch_path
from ..sources import fixtures as fx
from ..sources import hourly_files, manifest, metadata
from .registry import F1_SQL, f1, register

WRF = "/data/wrf"
SPEC = GridSpec("1979-10-01 00:00:00", "hour", ChunkPlan(144, 175, 175))
BASE79 = "TIMESTAMP '1979-10-01 00:00:00'"


def _wy(t: str) -> str:
    return f"'WY' || CAST(year({t}) + CASE WHEN month({t}) >= 10 THEN 1 ELSE 0 END AS VARCHAR)"


def _path(wy: str, t: str) -> str:
    return f"'{WRF}/' || {wy} || '/' || strftime({t}, '%Y%m%d%H%M') || '.LDASIN_DOMAIN1'"


MANIFEST_SQL = f"""c AS (SELECT DISTINCT CAST(floor(date_diff('second', {BASE79}, l_shipdate) / 518400) AS INTEGER) AS chunk FROM lineitem),
m AS (SELECT chunk, {BASE79} + to_days(CAST(chunk * 6 + k // 24 AS INTEGER)) AS cdate, CAST(k % 24 AS INTEGER) AS hour,
             {BASE79} + to_hours(CAST(chunk * 144 + k AS BIGINT)) AS fdate FROM c, range(144) r(k)),
mp AS (SELECT *, {_path(_wy('cdate'), 'fdate')} AS path, {_path("'WY' || CAST(year(cdate) AS VARCHAR)", 'fdate')} AS alt_path,
              {_path(_wy('cdate'), 'cdate')} AS day00_path, month(cdate) = 10 AND day(cdate) = 1 AS oct1 FROM m),
ls AS (SELECT DISTINCT {_path(f"CASE WHEN l_returnflag = 'A' THEN 'WY' || CAST(year(l_shipdate) AS VARCHAR) ELSE {_wy('l_shipdate')} END", 'l_shipdate + to_hours(CAST(l_suppkey % 24 AS BIGINT))')} AS path FROM lineitem)"""


def _chunks(spark, sf_dir):
    li = fx.table(spark, sf_dir, "lineitem")
    return li.select(ta.chunk_index("l_shipdate", SPEC).alias("chunk")).distinct()


def _manifest(spark, sf_dir):
    return manifest.hourly_manifest(_chunks(spark, sf_dir), SPEC, WRF)


def _listing(spark, sf_dir):
    return fx.file_listing(spark, sf_dir, WRF, manifest.DEFAULT_TEMPLATE)


@register("SR01_file_manifest", f"WITH {MANIFEST_SQL} SELECT chunk, fdate, path FROM mp")
def q_sr01(spark, sf_dir):
    return _manifest(spark, sf_dir).select("chunk", "fdate", "path")


@register("SC12_path_format", f"WITH {MANIFEST_SQL} SELECT fdate, path, {_path(_wy('fdate'), 'fdate')} AS path_by_hour FROM mp")
def q_sc12(spark, sf_dir):
    m = _manifest(spark, sf_dir)
    return m.select("fdate", "path",
                    manifest.manifest_path(manifest.DEFAULT_TEMPLATE, WRF, ta.water_year_dir("fdate"), "fdate")
                    .alias("path_by_hour"))


@register("SR02_file_manifest_verified", f"""WITH {MANIFEST_SQL},
j AS (SELECT mp.*, p.path IS NOT NULL AS ex, a.path IS NOT NULL AS alt_ex, d.path IS NOT NULL AS d00_ex
      FROM mp LEFT JOIN ls p ON p.path = mp.path LEFT JOIN ls a ON a.path = mp.alt_path LEFT JOIN ls d ON d.path = mp.day00_path),
k AS (SELECT chunk, fdate, CASE WHEN NOT (oct1 AND NOT d00_ex) AND ex THEN path
                               WHEN (oct1 AND NOT d00_ex) AND hour = 0 AND alt_ex THEN alt_path END AS path FROM j)
SELECT * FROM k WHERE path IS NOT NULL""")
def q_sr02(spark, sf_dir):
    return manifest.verified_manifest(_manifest(spark, sf_dir), _listing(spark, sf_dir), WRF)


@register("SR02_manifest_report", f"""WITH {MANIFEST_SQL},
j AS (SELECT mp.*, p.path IS NOT NULL AS ex, a.path IS NOT NULL AS alt_ex, d.path IS NOT NULL AS d00_ex
      FROM mp LEFT JOIN ls p ON p.path = mp.path LEFT JOIN ls a ON a.path = mp.alt_path LEFT JOIN ls d ON d.path = mp.day00_path),
k AS (SELECT chunk, CASE WHEN NOT (oct1 AND NOT d00_ex) AND ex THEN path
                         WHEN (oct1 AND NOT d00_ex) AND hour = 0 AND alt_ex THEN alt_path END AS path FROM j),
e AS (SELECT chunk, count(*) AS expected FROM mp GROUP BY chunk),
f AS (SELECT chunk, count(*) AS found FROM k WHERE path IS NOT NULL GROUP BY chunk)
SELECT e.chunk, expected, coalesce(found, 0) AS found, expected - coalesce(found, 0) AS missing
FROM e LEFT JOIN f USING (chunk)""")
def q_sr02_report(spark, sf_dir):
    """Q19: files expected, kept and missing per chunk (the reference skips
    missing files silently)."""
    m = _manifest(spark, sf_dir)
    return manifest.manifest_report(m, manifest.verified_manifest(m, _listing(spark, sf_dir), WRF))


@register("JN04_manifest_existence", f"WITH {MANIFEST_SQL} SELECT chunk, fdate, path FROM mp WHERE path IN (SELECT path FROM ls)")
def q_jn04(spark, sf_dir):
    return manifest.existing_files(_manifest(spark, sf_dir), _listing(spark, sf_dir)).select("chunk", "fdate", "path")


@register("SR03_hourly_scan", f"SELECT time, y, x, T2D, RAINRATE FROM ({F1_SQL})")
def q_sr03(spark, sf_dir):
    """Write F1 as one dataset per hour, list the expected files of its chunks,
    keep those that exist and read them as one grid (constants from the first file)."""
    from .q_store import HOURLY_TEMPLATE, chunks_of, hourly_files_of_f1
    root = hourly_files_of_f1(spark, sf_dir)
    spec = fx.F1_SPEC
    lo, hi = chunks_of(f1(spark, sf_dir))
    chunks = spark.range(lo, hi + 1).select(F.col("id").cast("int").alias("chunk"))
    m = manifest.existing_files(manifest.hourly_manifest(chunks, spec, root, HOURLY_TEMPLATE), hourly_files.list_files(spark, root))
    grid, cells = hourly_files.scan_manifest(spark, m, spec, lo, hi, root, HOURLY_TEMPLATE, ["T2D", "RAINRATE"], ["lat", "lon"])
    assert cells.count() == 4
    return grid


@register("SR06_mask_and_scale", """SELECT event_id,
  CASE WHEN event_type = 'error' THEN -32768 ELSE CAST(round(value * 100) AS INTEGER) END AS packed,
  CASE WHEN event_type = 'error' THEN NULL ELSE CAST(round(value * 100) AS INTEGER) * CAST(0.01 AS DOUBLE) + CAST(250.0 AS DOUBLE) END AS value
FROM events""")
def q_sr06(spark, sf_dir):
    ev = fx.table(spark, sf_dir, "events")
    packed = F.when(F.col("event_type") == "error", F.lit(-32768)).otherwise(F.round(F.col("value") * 100).cast("int"))
    p = ev.select("event_id", packed.alias("packed"))
    return p.withColumn("value", fv.mask_and_scale("packed", -32768, 0.01, 250.0))


@register("SC21_is_missing", """SELECT time, y, x, T2D IS NULL AS t2d_missing, RAINRATE IS NULL AS rain_missing, T2D, RAINRATE FROM (
  SELECT date_trunc('hour', ts) AS time, CAST(floor((user_id % 4) / 2) AS INTEGER) AS y, CAST(user_id % 2 AS INTEGER) AS x,
         CASE WHEN isnan(max(v)) THEN NULL ELSE max(v) END AS T2D, CASE WHEN isnan(min(v)) THEN NULL ELSE min(v) END AS RAINRATE
  FROM (SELECT *, CASE WHEN event_id % 97 = 0 THEN 'NaN'::DOUBLE ELSE value END AS v FROM events) GROUP BY 1, 2, 3)""")
def q_sc21(spark, sf_dir):
    g = fx.hourly_grid(spark, sf_dir, plant_nan=True, mask=False)      # NaN still present
    return g.select("time", "y", "x", fv.is_missing("T2D").alias("t2d_missing"),
                    fv.is_missing("RAINRATE").alias("rain_missing"),
                    fv.mask_nan("T2D").alias("T2D"), fv.mask_nan("RAINRATE").alias("RAINRATE"))


@register("SR11_variable_list_scan", "SELECT DISTINCT upper(event_type) AS variable FROM events")
def q_sr11(spark, sf_dir):
    path = scratch_path(spark, "var-list")
    (fx.table(spark, sf_dir, "events").select(F.upper("event_type").alias("variable")).distinct()
     .write.option("header", True).csv(path))
    return metadata.read_variable_list(spark, path)


U_SQL = """u AS (SELECT user_id,
    sum(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END) AS n_signup, sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS n_purchase,
    sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS n_error, sum(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) AS n_view,
    sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS n_click, max(event_type) AS max_type FROM events GROUP BY user_id),
c AS (SELECT CASE user_id WHEN 0 THEN 'I_ACLWDNB' WHEN 1 THEN 'I_ACLWUPB' WHEN 2 THEN 'I_ACSWDNB' WHEN 3 THEN 'I_ACSWDNT'
               WHEN 4 THEN 'I_ACSWUPB' ELSE 'V' || CAST(user_id AS VARCHAR) END AS varname, n_signup > n_error AS has_time, * FROM u),
a AS (SELECT varname, 'long_name' AS key, 'user ' || CAST(user_id AS VARCHAR) AS value FROM c
  UNION ALL SELECT varname, 'units', max_type FROM c
  UNION ALL SELECT varname, 'integration_length', CASE WHEN n_purchase >= n_click + 3 THEN '60-minute accumulation' ELSE '15-minute accumulation' END FROM c WHERE n_purchase > n_click
  UNION ALL SELECT varname, 'esri_pe_string', 'PROJCS' FROM c WHERE n_error > n_view
  UNION ALL SELECT varname, 'proj4', '+proj=lcc' FROM c WHERE n_view > n_click
  UNION ALL SELECT varname, 'resolution', '4000' FROM c WHERE n_click > n_signup),
md AS (SELECT varname, 'meta ' || CAST(user_id AS VARCHAR) AS long_name,
         CASE WHEN n_view > n_click THEN 'std_' || CAST(user_id AS VARCHAR) END AS standard_name,
         CASE WHEN n_click > n_signup THEN 'm' END AS units, CASE WHEN n_signup > n_purchase THEN 'x y' END AS coordinates FROM c WHERE n_error >= n_view
       UNION ALL SELECT 'time', 'time', 'time', 'hours', NULL)"""

DROPPED = "('esri_pe_string', 'proj4', '_CoordinateAxisType', 'resolution')"
CLASS_SQL = f"""cl AS (SELECT c.varname, CASE
    WHEN il.value IS NOT NULL AND c.varname IN ('I_ACLWDNB', 'I_ACLWUPB', 'I_ACSWDNB', 'I_ACSWDNT', 'I_ACSWUPB') THEN 'accumulated since 1979-10-01 00:00:00 bucket'
    WHEN il.value IS NOT NULL THEN il.value WHEN has_time THEN 'instantaneous' ELSE 'constant' END AS class
  FROM c LEFT JOIN (SELECT * FROM a WHERE key = 'integration_length') il USING (varname))"""


@register("PF08_drop_attrs", f"WITH {U_SQL} SELECT varname, key, value FROM a WHERE key NOT IN {DROPPED}")
def q_pf08(spark, sf_dir):
    return cat.attrs_long(cat.drop_attrs(fx.var_catalog(spark, sf_dir)))


NEW_ATTRS = {"I_ACLWDNB": {"units": "W m-2", "grid_mapping": "crs"}, "V10": {"long_name": "ten", "axis": "T"}}


@register("PF09_set_attrs", f"""WITH {U_SQL},
n AS (SELECT * FROM (VALUES ('I_ACLWDNB', 'units', 'W m-2'), ('I_ACLWDNB', 'grid_mapping', 'crs'), ('V10', 'long_name', 'ten'), ('V10', 'axis', 'T')) t(varname, key, value)
      WHERE varname IN (SELECT varname FROM c))
SELECT varname, key, value FROM a WHERE (varname, key) NOT IN (SELECT (varname, key) FROM n) UNION ALL SELECT * FROM n""")
def q_pf09(spark, sf_dir):
    return cat.attrs_long(cat.set_attrs(fx.var_catalog(spark, sf_dir), NEW_ATTRS))


@register("PF10_overlay_metadata", f"""WITH {U_SQL},
ml AS (SELECT varname, 'long_name' AS key, long_name AS value FROM md UNION ALL SELECT varname, 'standard_name', standard_name FROM md
       UNION ALL SELECT varname, 'units', units FROM md UNION ALL SELECT varname, 'coordinates', coordinates FROM md),
mv AS (SELECT * FROM ml WHERE value IS NOT NULL AND varname IN (SELECT varname FROM c))
SELECT varname, 'attrs' AS part, key, value FROM a WHERE (varname, key) NOT IN (SELECT (varname, key) FROM mv WHERE key <> 'coordinates')
UNION ALL SELECT varname, 'attrs', key, value FROM mv WHERE key <> 'coordinates'
UNION ALL SELECT varname, 'encoding', 'dtype', 'float64' FROM c
UNION ALL SELECT varname, 'encoding', key, value FROM mv WHERE key = 'coordinates'""")
def q_pf10(spark, sf_dir):
    c = cat.overlay_metadata(fx.var_catalog(spark, sf_dir), fx.var_metadata(spark, sf_dir))
    a = cat.attrs_long(c, "attrs").withColumn("part", F.lit("attrs"))
    e = cat.attrs_long(c, "encoding").withColumn("part", F.lit("encoding"))
    return a.unionByName(e).select("varname", "part", "key", "value")


@register("JN03_metadata_join", f"""WITH {U_SQL}
SELECT c.varname, md.long_name, md.standard_name, md.units, md.coordinates FROM c LEFT JOIN md USING (varname)""")
def q_jn03(spark, sf_dir):
    j = cat.join_metadata(fx.var_catalog(spark, sf_dir), fx.var_metadata(spark, sf_dir))
    return j.select("varname", *[F.col("meta")[k].alias(k) for k in ("long_name", "standard_name", "units", "coordinates")])


@register("PF11_classify_vars", f"WITH {U_SQL}, {CLASS_SQL} SELECT varname, class FROM cl")
def q_pf11(spark, sf_dir):
    return cat.classify(fx.var_catalog(spark, sf_dir)).select("varname", "class")


@register("PF12_split_constants", f"WITH {U_SQL}, {CLASS_SQL} SELECT varname FROM cl WHERE class = 'constant'")
def q_pf12(spark, sf_dir):
    return cat.constants(fx.var_catalog(spark, sf_dir)).select("varname")


@register("AG12_group_vars", f"""WITH {U_SQL}, {CLASS_SQL},
g AS (SELECT class, string_agg(varname, ',' ORDER BY varname) AS variables, count(*) AS n FROM cl GROUP BY class),
imp AS (SELECT DISTINCT value AS class FROM a WHERE key = 'integration_length'
        AND varname IN ('I_ACLWDNB', 'I_ACLWUPB', 'I_ACSWDNB', 'I_ACSWDNT', 'I_ACSWUPB'))
SELECT * FROM g UNION ALL SELECT class, '' AS variables, 0 AS n FROM imp WHERE class NOT IN (SELECT class FROM g)""")
def q_ag12(spark, sf_dir):
    g = cat.group_by_class(fx.var_catalog(spark, sf_dir))
    return g.select("class", F.array_join("variables", ",").alias("variables"), F.size("variables").cast("long").alias("n"))


@register("SL01_sort_vars", f"WITH {U_SQL}, {CLASS_SQL} SELECT varname FROM cl WHERE class = 'instantaneous'")
def q_sl01(spark, sf_dir):
    return cat.sorted_names(fx.var_catalog(spark, sf_dir))


@register("SR12_metadata_scan", f"WITH {U_SQL} SELECT varname, long_name, standard_name, CASE WHEN varname = 'time' THEN NULL ELSE units END AS units, coordinates FROM md")
def q_sr12(spark, sf_dir):
    path = scratch_path(spark, "metadata")
    md = fx.var_metadata(spark, sf_dir).withColumn("extra", F.lit("ignored"))
    md.write.option("header", True).option("sep", "\t").csv(path)
    return metadata.read_metadata(spark, path)


@register("PF05_rename", f"SELECT time, y, x, T2D AS T2, RAINRATE FROM ({F1_SQL})")
def q_pf05(spark, sf_dir):
    src = f1(spark, sf_dir).withColumnsRenamed({"y": "south_north", "x": "west_east"})
    out = cat.rename(src, {"south_north": "y", "west_east": "x", "bottom_top": "z"}, {"T2D": "T2"})
    return out.select("time", "y", "x", "T2", "RAINRATE")


@register("SR10_array_metadata_scan", """SELECT DISTINCT upper(event_type) AS varname,
  CAST(CASE event_type WHEN 'error' THEN 1 ELSE 0 END AS INTEGER) AS time_pos FROM events WHERE event_type <> 'signup'
  UNION ALL SELECT 'time', 0""")
def q_sr10(spark, sf_dir):
    """Build a consolidated metadata document for one variable per event type
    (signup: no time dimension; error: time second), write it, read it back."""
    from ..sources.arraystore import consolidated_metadata
    ev = fx.table(spark, sf_dir, "events")
    t = ev.groupBy(F.upper("event_type").alias("varname"), "event_type").agg(F.count("*").alias("n"))
    dims = (F.when(F.col("event_type") == "signup", F.array(F.lit("y"), F.lit("x")))
            .when(F.col("event_type") == "error", F.array(F.lit("y"), F.lit("time"), F.lit("x")))
            .otherwise(F.array(F.lit("time"), F.lit("y"), F.lit("x"))))
    shape = F.transform(dims, lambda d: F.when(d == "time", F.col("n")).otherwise(F.lit(2)).cast("long"))
    vars_ = t.select("varname", dims.alias("dims"), shape.alias("shape"))
    coord = spark.createDataFrame([("time", ["time"], [720])], "varname string, dims array<string>, shape array<bigint>")
    path = scratch_path(spark, "zmeta")
    consolidated_metadata(vars_.unionByName(coord)).write.text(path)
    return metadata.read_time_positions(spark, path)
