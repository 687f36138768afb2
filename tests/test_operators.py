"""Hand-worked cases for the traps that pandas-shaped data sets for SQL."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from platelake.functions import naming, scalars
from platelake.operators import cells, induction, normalize, qc, selection, similarity, wells
from platelake.operators.profiles import Profiles


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_column_rules(spark):
    df = spark.createDataFrame([(1, 1, 2, 3, 4.0, "u", 1.0)], ["ImageNumber", "Metadata_Well", "Metadata_Plate", "X_Metadata_y", "Area", "URL_a", "ExecutionTime_1"])
    assert naming.features_without(df) == ["ImageNumber", "Area", "URL_a", "ExecutionTime_1"]
    assert "X_Metadata_y" in naming.features_not_starting(df)
    assert naming.drop_bookkeeping(df).columns == ["Metadata_Well", "X_Metadata_y", "Area"]
    assert naming.drop_text_features(df).columns == [c for c in df.columns if c != "URL_a"]
    assert naming.prefixed(df.select("Metadata_Well", "Area"), "DNA_").columns == ["Metadata_Well", "DNA_Area"]
    stale = spark.createDataFrame([(1, 2, 3)], ["FileName_A", "ImageQuality_x", "QC_Error_A"])
    assert naming.drop_stale_qc(stale).columns == ["FileName_A"]


def test_missing_values(spark):
    df = spark.createDataFrame([("NA", 1.0), ("nan", float("nan")), ("NAN", None), ("x", 2.0)], "t string, v double")
    assert rows(naming.nulls_for_nan(naming.nulls_for_tokens(df))) == sorted([(None, 1.0), (None, None), ("NAN", None), ("x", 2.0)], key=str)


def test_integers_with_blanks_are_not_integers(spark):
    df = spark.createDataFrame([(1, None, 5, 1.5), (2, 3, 6, 2.5)], "a int, b int, Metadata_Site int, c double")
    assert naming.whole_integers(df) == ["a"]


def test_quality_predicates_are_not_opposites(spark):
    df = spark.createDataFrame([(1, 0.5, None), (2, -1.0, None), (3, 0.0, 0.0), (4, 1.0, 0.0), (5, None, None)], "ImageNumber int, ImageQC_a double, ImageQC_b double")
    assert [r[0] for r in df.filter(qc.any_flag(df)).orderBy("ImageNumber").collect()] == [1, 2, 4]
    assert [r[0] for r in df.filter(qc.sum_below_one(df)).orderBy("ImageNumber").collect()] == [1, 2, 3, 5]
    objects = spark.createDataFrame([(1, "a"), (3, "b"), (3, "c"), (None, "d")], "ImageNumber int, o string")
    assert [r[1] for r in rows(qc.without_failing(objects, df))] == ["b", "c", "d"]


def test_metadata_join_only_when_missing(spark):
    images = spark.createDataFrame([(1, "A01", 2)], "ImageNumber int, Metadata_Well string, Metadata_Site int")
    objects = spark.createDataFrame([(1, 9), (7, 8)], "ImageNumber int, x int")
    assert rows(qc.with_image_metadata(objects, images)) == [(1, 9, "A01", 2), (7, 8, None, None)]
    assert qc.with_image_metadata(images, images) is images


def test_mask_needs_a_record_for_every_row(spark):
    quality = spark.createDataFrame([(1, 0.0), (2, 1.0)], "k int, ImageQC_a double")
    good = spark.createDataFrame([(1,), (2,)], "k int")
    assert rows(qc.mask_rows(good, quality, "k", qc.sum_below_one(quality))) == [(1,)]
    with pytest.raises(Exception, match="no quality record"):
        qc.mask_rows(spark.createDataFrame([(3,)], "k int"), quality, "k", qc.sum_below_one(quality)).collect()


def test_aggregate_drops_null_keys_and_text(spark):
    df = spark.createDataFrame([("A", 1.0, "x"), ("A", None, "y"), (None, 5.0, "z"), ("B", 2.0, "w")], "Metadata_Well string, v double, t string")
    assert rows(wells.aggregate_by(df, ["Metadata_Well"])) == [("A", 1.0), ("B", 2.0)]
    ordered = spark.createDataFrame([("A", 2, None), ("A", 3, 7.0), ("A", 4, 8.0)], "w string, o int, v double")
    assert rows(wells.aggregate_by(ordered, ["w"], "first", "o")) == [("A", 7.0)]
    with pytest.raises(ValueError):
        wells.aggregate_by(df, ["Metadata_Well"], "first")


def test_site_scaling(spark):
    df = spark.createDataFrame([("A", 1, 10, 1.0), ("A", 2, 20, 1.0), ("B", 1, 30, 1.0), (None, 1, 1, 1.0)], "Metadata_Well string, Metadata_Site int, n int, x double")
    assert rows(wells.site_scaling(df, [])) == [("A", 2, 1.0), ("B", 1, 2.0)]
    assert rows(wells.scale_counts(df, []).select("Metadata_Well", "n", "x")) == [("A", 10.0, 1.0), ("A", 20.0, 1.0), ("B", 60.0, 1.0)]


def test_outer_merge_and_annotation(spark):
    a = spark.createDataFrame([("A", 1), ("B", 2)], "Metadata_Well string, x int")
    b = spark.createDataFrame([("B", 3), ("C", 4)], "Metadata_Well string, x int")
    merged = wells.outer_merge([a, b], ["Metadata_Well"])
    assert merged.columns == ["Metadata_Well", "x", "x_1"] and rows(merged) == [("A", 1, None), ("B", 2, 3), ("C", None, 4)]
    plate = spark.createDataFrame([("dmso", 0, "A", "P"), (None, 1, "Z", "P")], "Metadata_Compound string, Metadata_ConcLevel int, Metadata_Well string, Metadata_Plate string")
    made = wells.annotate(merged, wells.platemap_of(plate), ["Metadata_Well"])
    assert rows(made) == [("DMSO", 0, "A", "P", 1, None)]
    assert rows(wells.platemap_of(plate).select("Metadata_Compound")) == [("DMSO",), ("NAN",)]


def test_mad_robustize(spark):
    data = [("c", "p", 1.0, 5.0), ("c", "p", 2.0, 5.0), ("c", "p", 9.0, 5.0), ("t", "p", 4.0, 6.0), ("t", "p", None, 5.0), ("t", "q", 1.0, 1.0)]
    p = Profiles.of(spark.createDataFrame(data, "kind string, plate string, a double, b double"), ["a", "b"])
    got = normalize.mad_robustize(p, ["plate"], F.col("kind") == "c").wide()
    s = 1.4826
    want = [("c", "p", -1 / s, 0.0), ("c", "p", 0.0, 0.0), ("c", "p", 7 / s, 0.0), ("t", "p", 2 / s, 1e18), ("t", "p", None, 0.0), ("t", "q", None, None)]
    for a, b in zip(rows(got), sorted(want, key=str)):
        assert a[:2] == b[:2] and all((x is None) == (y is None) and (x is None or math.isclose(x, y, rel_tol=1e-9)) for x, y in zip(a[2:], b[2:]))
    with pytest.raises(Exception, match="no control rows"):
        normalize.mad_robustize(p, ["plate"], F.col("kind") == "C", require=True).wide().collect()


def test_feature_selection(spark):
    rng = np.random.default_rng(0)
    n = 80
    x = rng.normal(size=n)
    cols = {"good": x, "twin": x * 2 + 1, "mirror": -x, "constant": np.ones(n), "rare": np.r_[1.0, np.zeros(n - 1)], "gaps": np.where(np.arange(n) % 5 < 3, np.nan, rng.normal(size=n)), "wild": np.r_[rng.normal(size=n - 1), 900.0], "other": rng.normal(size=n)}
    df = spark.createDataFrame([tuple(float(v[i]) for v in cols.values()) for i in range(n)], list(cols))
    p = Profiles.of(df, list(cols))
    assert set(cols) - set(selection.variance_threshold(p)) == {"constant", "rare"}
    assert set(cols) - set(selection.drop_na_columns(p, 0.5)) == {"gaps"}
    assert set(cols) - set(selection.drop_outliers(p)) == {"wild"}
    r = selection.correlation_matrix(p)
    assert math.isclose(r[0, 1], 1, abs_tol=1e-9) and math.isclose(r[0, 2], -1, abs_tol=1e-9) and np.isnan(r[3, 0])
    ok = ~np.isnan(cols["gaps"])
    assert math.isclose(r[5, 7], np.corrcoef(cols["gaps"][ok], cols["other"][ok])[0, 1], abs_tol=1e-9)
    gone = set(cols) - set(selection.correlation_threshold(p))
    assert len(gone) == 1 and gone <= {"good", "twin"}
    kept = selection.feature_select(p, ["variance_threshold", "drop_na_columns", "correlation_threshold", "drop_outliers"], {"drop_na_columns": {"cutoff": 0.5}})
    assert len(kept.names) == 3 and {"mirror", "other"} <= set(kept.names) and kept.wide().count() == n


def test_selection_per_time_fills_zero(spark):
    df = spark.createDataFrame([("6h", float(i), 1.0) for i in range(9)] + [("12h", float(i), float(-i)) for i in range(9)], "Metadata_Timepoint string, a double, b double")
    got = selection.select_per(Profiles.of(df, ["a", "b"]), "Metadata_Timepoint", ["variance_threshold"])
    assert got.columns == ["Metadata_Timepoint", "a", "b"]
    assert {r["b"] for r in got.filter("Metadata_Timepoint = '6h'").collect()} == {0.0}


def test_sigmoid(spark):
    df = spark.createDataFrame([(0.0,), (2.3538,), (-2.3538,), (1e18,), (1e60,), (None,)], "x double")
    got = [r[0] for r in df.select(scalars.double_sigmoid(F.col("x"))).collect()]
    assert got[0] == 0 and math.isclose(got[1], 2**-0.5) and math.isclose(got[2], -(2**-0.5)) and got[3] == 1.0 and got[4] == 0.0 and got[5] is None


def test_average_cosine_equals_pairs(spark):
    rng = np.random.default_rng(2)
    data = [("g", k, rng.normal(size=4).tolist()) for k in range(6)] + [("g", 6, [0.0] * 4), ("one", 0, [1.0, 0.0]), ("same", 0, [1.0, 2.0]), ("same", 1, [2.0, 4.0]), ("opposite", 0, [1.0, 0.0]), ("opposite", 1, [-3.0, 0.0]), (None, 0, [1.0] * 4), ("holes", 0, [None, 1.0, 0.0]), ("holes", 1, [0.0, 1.0, None])]
    df = spark.createDataFrame(data, "k string, row_idx int, features array<double>")
    mean = {r["k"]: r["average_cosine_similarity"] for r in similarity.average_cosine(df, ["k"]).collect()}
    pairs = {r["k"]: r for r in similarity.replicate_cosines(df, ["k"]).collect()}
    assert set(mean) == set(pairs) == {"g", "one", "same", "opposite", "holes"}
    assert mean["one"] is None and pairs["one"]["cosine_similarities"] == []
    assert math.isclose(mean["same"], 1) and math.isclose(mean["opposite"], -1) and math.isclose(mean["holes"], 1)
    assert math.isclose(mean["g"], np.mean(pairs["g"]["cosine_similarities"]), abs_tol=1e-12) and len(pairs["g"]["cosine_similarities"]) == 21
    with pytest.raises(Exception, match="too many replicates"):
        similarity.replicate_cosines(df, ["k"], most=3).collect()


def test_induction_and_hits(spark):
    df = spark.createDataFrame([("p", "6h", "DMSO", 0, 0.95, 0.99), ("p", "6h", "DMSO", 0, None, 0.1), ("p", "6h", "x", 1, 0.96, 0.97), ("p", "6h", "y", 1, 0.1, 0.2), ("p", "12h", "x", 1, 1.0, 1.0), (None, "6h", "x", 1, 1.0, 1.0)], "Metadata_Plate string, Metadata_Timepoint string, Metadata_Compound string, Metadata_ConcLevel int, a double, b double")
    scored = df.withColumn("induction", induction.induction(["a", "b"], 0.95))
    assert [r[0] for r in scored.select("induction").collect()] == [0.5, 0.0, 1.0, 0.0, 1.0, 1.0]
    same = df.withColumn("f", F.array("a", "b")).select(induction.induction(F.col("f"), 0.95, array=True))
    assert [r[0] for r in same.collect()] == [0.5, 0.0, 1.0, 0.0, 1.0, 1.0]
    control = F.col("Metadata_Compound") == "DMSO"
    threshold = induction.control_threshold(scored, control)
    assert rows(threshold) == [("p", "6h", 0.475)]
    flags = induction.flag_hits(induction.mean_induction(scored, control), threshold)
    assert rows(flags.select("Metadata_Timepoint", "Metadata_Compound", "Bioactive")) == [("12h", "x", 0), ("6h", "x", 1), ("6h", "y", 0)]
    assert rows(induction.venn(flags)) == [(1, 0, 1)]
    assert rows(induction.venn_per_time(flags)) == [("6h", 0, 0, 1, 100)]
    pivot = induction.hit_pivot(flags, ["6h", "12h", "24h"])
    assert rows(pivot.select("Metadata_Compound", "6h", "12h", "24h", "any_active")) == [("x", 1, 0, 0, 1), ("y", 0, 0, 0, 0)]


def test_natural_order(spark):
    df = spark.createDataFrame([("24h_2",), ("6h",), ("ctrl",), ("12h",), (None,)], "Metadata_Timepoint string")
    assert induction.ordered_times(df) == ["6h", "12h", "24h_2", "ctrl"]


def test_histogram_counts_everything(spark):
    df = spark.createDataFrame([("p", v / 10) for v in range(11)] + [("p", None)], "k string, induction double")
    got = induction.histogram(df, ["k"], bins=5).collect()
    assert sum(r["n"] for r in got) == 11 and max(r["bin"] for r in got) == 4
    flat = spark.createDataFrame([("p", 1.0)] * 3, "k string, induction double")
    assert [r["n"] for r in induction.histogram(flat, ["k"]).collect()] == [3]
    area = induction.density(df, ["k"], cut=3.0).orderBy("x").collect()
    x, y = np.array([r["x"] for r in area]), np.array([r["density"] for r in area])
    assert math.isclose(float(((y[1:] + y[:-1]) / 2 * np.diff(x)).sum()), 1, abs_tol=0.02)


def test_histogram_and_density_keep_to_a_group(spark):
    """Worked out by hand: one group from 0 to 1 and one from 10 to 30 have bins of their own; a group of one value has bins around it."""
    data = [("a", 0.0), ("a", 0.26), ("a", 0.5), ("a", 1.0), ("b", 10.0), ("b", 14.9), ("b", 15.0), ("b", 30.0), ("c", 7.0), ("c", 7.0), (None, 2.0), (None, 4.0)]
    df = spark.createDataFrame(data, "k string, induction double")
    got = {(r["k"], r["bin"]): (r["low"], r["high"], r["n"]) for r in induction.histogram(df, ["k"], bins=4).collect()}
    assert got == {
        ("a", 0): (0.0, 0.25, 1), ("a", 1): (0.25, 0.5, 1), ("a", 2): (0.5, 0.75, 1), ("a", 3): (0.75, 1.0, 1),
        ("b", 0): (10.0, 15.0, 2), ("b", 1): (15.0, 20.0, 1), ("b", 3): (25.0, 30.0, 1),
        ("c", 2): (7.0, 7.25, 2), (None, 0): (2.0, 2.5, 1), (None, 3): (3.5, 4.0, 1),
    }
    grid = induction.density(df, ["k"]).groupBy("k").agg(F.min("x").alias("lo"), F.max("x").alias("hi"), F.count("*").alias("n")).orderBy("k").collect()
    assert [tuple(r) for r in grid] == [("a", 0.0, 1.0, 200), ("b", 10.0, 30.0, 200)]


def test_value_frequencies_of_ties(spark):
    df = spark.createDataFrame([(1.0, 5.0), (1.0, 5.0), (2.0, 5.0), (2.0, None), (3.0, None)], "a double, b double")
    got = {r["pos"]: tuple(r)[1:] for r in selection.value_frequencies(Profiles.of(df, ["a", "b"])).collect()}
    assert got == {0: (3, 2, 2), 1: (1, 3, None)}


def test_jobs(spark):
    from platelake.operators import jobs

    plates, times = spark.createDataFrame([("P1",), ("P2",), ("P3",)], "plate string"), spark.createDataFrame([("12",), ("6",), ("24",), ("48",)], "time string")
    got = {(r["plate"], r["time"]): (r["batch"], r["instance"]) for r in jobs.job_batches(plates, times).collect()}
    assert len(got) == 12 and [k for k, v in got.items() if v == (1, "small")] and sum(v == (0, "large") for v in got.values()) == 10
    assert {k for k, v in got.items() if v[0] == 1} == {("P3", "48"), ("P3", "6")}
    folders = spark.createDataFrame([("s3/b_6h_P1/x",), ("s3/a_6h_P1/x",), ("s3/12h_P2/y",)], "folder string")
    assert sorted(map(tuple, jobs.first_folders(spark.createDataFrame([("P1", "6"), ("P2", "12"), ("P3", "6")], "plate string, time string"), folders).collect())) == [("P1", "6", "s3/a_6h_P1/x"), ("P2", "12", "s3/12h_P2/y")]


def test_text_functions(spark):
    df = spark.createDataFrame([("a/Images/b.tif",), ("a/Image/Image_1.tif",), ("binned/P01",), ("dmso_1",), ("binned/inner1",)], "p string")
    p = F.col("p")
    got = df.select(scalars.stacked_path(p), scalars.binned_key(p), scalars.strip_leading(p, "binned/"), scalars.strip_prefix(p, "binned/"), scalars.last_segment(p), scalars.file_label(p)).collect()
    assert tuple(got[0])[:2] == ("a/ImagesStacked/b.tif", "a/Image_binneds/b.tif") and got[0][4] == "b.tif"
    assert got[1][0] == "a/Image/Image_1.tif" and got[1][1] == "a/Image_binned/Image_binned_1.tif"
    assert [r[2] for r in got[2:]] == ["P01", "mso_1", "r1"] and [r[3] for r in got[2:]] == ["P01", "dmso_1", "inner1"]
    one = spark.range(1).select(scalars.path_join(F.lit("a/"), F.lit("b")), scalars.path_join(F.lit("a"), F.lit("/b")), scalars.path_join(F.lit("a"), F.lit("b")), scalars.well_of_position(F.lit(25)), scalars.well_of(F.lit(16), F.lit(24)), scalars.percent(F.lit(2), F.lit(3)), scalars.percent(F.lit(0), F.lit(0))).first()
    assert tuple(one) == ("a/b", "/b", "a/b", "B01", "P24", 66, 0)


def test_pixel_functions(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0],), ([5.0, 5.0],), ([],)], "v array<double>")
    assert [r[0] for r in df.select(scalars.scale_8bit(F.col("v"))).collect()] == [[0, 127, 255], [0, 0], []]
    light = F.array(F.lit(2.0), F.lit(4.0), F.lit(6.0))
    assert [r[0] for r in df.select(scalars.divide_illumination(F.col("v"), light)).collect()] == [[0.5, 0.5, 0.5], [5.0, 5.0], []]
    assert [r[0] for r in df.select(scalars.cosine(F.col("v"), F.transform("v", lambda x: x * 0))).collect()] == [0.0, 0.0, 0.0]


def test_cells_to_wells(spark):
    data = [("A", 1, 0, False, [1.0, 2.0]), ("A", 1, 1, True, [9.0, 9.0]), ("A", 2, 0, False, [3.0, 4.0]), ("B", 1, 0, True, [1.0, 1.0]), ("C", 1, None, None, None)]
    df = spark.createDataFrame(data, "Metadata_Well string, site int, cell_index int, is_dead boolean, embedding array<float>")
    sites = cells.site_sums(df, ["Metadata_Well", "site"])
    assert rows(sites.select("Metadata_Well", "site", "Cell_Count", "Dead_Cells", "n_alive", "total")) == [("A", 1, 2, 1, 1, [1.0, 2.0]), ("A", 2, 1, 0, 1, [3.0, 4.0]), ("B", 1, 1, 1, 0, None), ("C", 1, 0, 0, 0, None)]
    timed = sites.withColumn("Metadata_Timepoint", F.when(F.col("site") == 2, "6h")).withColumn("Metadata_Plate", F.lit("p"))
    got = cells.well_means(timed, ["Metadata_Well"], "site")
    assert rows(got) == [("A", 2, "6h", "p", [2.0, 3.0]), ("B", 0, None, "p", None), ("C", 0, None, "p", None)]


def test_box_edges(spark):
    df = spark.createDataFrame([(y,) for y in (99, 100, 400, 401)], "y int")
    ok = df.filter(cells.inside(F.col("y"), F.lit(200), F.lit(500), F.lit(500))).collect()
    assert [r[0] for r in ok] == [100, 400]
    assert spark.range(1).select(cells.dead(F.lit(0.5)), cells.dead(F.lit(0.51)), cells.cell_id(F.lit("A01"), F.lit(3), F.lit(0))).first()[:] == (False, True, "A01_3_cell0")


def test_cosine_summary_has_no_limit_on_a_group(spark, tmp_path):
    from platelake.plans.catalog import QUERIES

    rng = np.random.default_rng(7)
    data = [(k, 1 if k < 2100 else 2 if k < 2103 else 3, rng.normal(size=4).tolist()) for k in range(2104)]
    df = spark.createDataFrame(data, "vec_id long, label int, embedding array<double>")
    df.write.parquet(f"{tmp_path}/embeddings.parquet")
    got = {r["label"]: r for r in QUERIES["cosine_pairs"](spark, str(tmp_path)).collect()}
    assert set(got) == {1, 2}
    for label, r in got.items():
        x = np.array([v for _, k, v in data if k == label])
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        c = (x @ x.T)[np.triu_indices(len(x), 1)]
        assert r["n_pairs"] == len(c) and math.isclose(r["low"], c.min(), abs_tol=2e-6) and math.isclose(r["high"], c.max(), abs_tol=2e-6) and math.isclose(r["total"], c.sum(), abs_tol=2e-4)
    few = similarity.replicate_cosine_summary(df.filter("label = 2"), ["label"], "embedding", "vec_id", lane=1).first()
    assert few["n_pairs"] == 3


def test_well_profiles_of_all_plates_and_times(spark):
    """Every plate and time with a passing image has its profiles, and those of one are what the chain on its tables alone gives."""
    from platelake.operators import wells
    from platelake.plans.adapters import images, measurements
    from platelake.plans.catalog import QUERIES, rounded

    sf = "/root/testdata/sf0.001"
    keys = ["Metadata_Plate", "Metadata_Timepoint"]
    made = QUERIES["well_profiles"](spark, sf)
    got = made.collect()
    image = images(spark, sf).filter("ImageQC_flag = 0").join(measurements(spark, sf), "ImageNumber", "left_semi")
    assert {(r[keys[0]], r[keys[1]], r["Metadata_Well"]) for r in got} == {(str(p), t, w) for p, t, w in image.select(*keys, "Metadata_Well").collect()}
    assert len({(r[keys[0]], r[keys[1]]) for r in got}) > 1
    of_one = images(spark, sf).filter("Metadata_Timepoint = '1995' AND Metadata_Plate = 1")
    nuclei = measurements(spark, sf).select("ImageNumber", "line", "quantity").join(of_one.select("ImageNumber"), "ImageNumber", "left_semi")
    layout = spark.range(96).select(F.concat(F.lit("c"), F.col("id") % 5).alias("Metadata_Compound"), (F.col("id") % 3).alias("Metadata_ConcLevel"), F.col("id").alias("Metadata_Well"), F.lit("1").alias("Metadata_Plate"))
    one = wells.well_profiles({"Image": of_one.select("ImageNumber", "Metadata_Well", "Metadata_Site", "ImageQC_flag"), "Nuclei": nuclei}, layout, "1995").filter("DNA_line IS NOT NULL")
    one = rounded(one.drop("Image_ImageQC_flag"), "DNA_line", "DNA_quantity")
    assert rows(made.filter("Metadata_Plate = '1' AND Metadata_Timepoint = '1995'").select(*sorted(made.columns))) == rows(one.select(*sorted(one.columns)))


def test_selection_within_groups_is_selection_of_each_part(spark):
    """All rules at once over groups against each rule on each part, with features that only some groups drop."""
    rng = np.random.default_rng(5)
    rows, names = [], [f"f{k}" for k in range(9)]
    for g in ("a", "b", "c"):
        x = rng.normal(size=(60, 9))
        x[:, 1] = x[:, 0] + 0.01 * x[:, 1] if g != "b" else x[:, 1]
        x[:, 2] = x[:, 0] + 0.3 * x[:, 2] if g == "c" else x[:, 2]
        x[:, 3] = 1.0 if g == "a" else x[:, 3]
        x[::2, 4] = np.nan if g == "b" else x[::2, 4]
        x[0, 5] = 900 if g == "c" else x[0, 5]
        x[3, 6] = np.nan
        x[:, 8] = 1.0
        rows += [(g, k, *map(float, r)) for k, r in enumerate(x)]
    rows.append((None, 0, *[1.0] * 9))
    wide = spark.createDataFrame(rows, "Metadata_g string, Metadata_k int, " + ", ".join(f"{n} double" for n in names)).repartition(5)
    rules = ["variance_threshold", "drop_na_columns", "correlation_threshold", "drop_outliers"]
    p = Profiles.of(wide, names)
    got = selection.select_per(p, "Metadata_g", rules)
    parts = {g: selection.feature_select(Profiles.of(wide.filter(F.col("Metadata_g") == g), names), rules).names for g in "abc"}
    assert len({tuple(v) for v in parts.values()}) == 3
    assert got.columns == ["Metadata_g", "Metadata_k", *(n for n in names if any(n in v for v in parts.values()))]
    want = {(r[0], r[1]): dict(zip(names, r[2:])) for r in rows if r[0]}
    found = got.collect()
    assert len(found) == 180
    for r in found:
        for n in got.columns[2:]:
            x = want[r["Metadata_g"], r["Metadata_k"]][n]
            assert r[n] == (x if n in parts[r["Metadata_g"]] and x == x else 0.0)
