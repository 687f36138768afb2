"""Image kernels, codecs, files and the stream."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from platelake.operators import cells, images
from platelake.sources import images as codec
from platelake.sources import tables
from platelake.streaming.folders import follow_csv


def test_folded_rings_are_literal():
    assert (images.ring_numbers(8, 1)[:, 0] - 1).tolist() == [0, 1, 2, 3, 3, 2, 1, 0]


def test_slope_by_size():
    rng = np.random.default_rng(0)
    assert images.power_slope(rng.random((8, 8))) is None
    assert images.power_slope(rng.random((32, 32))) == 0.0
    assert images.power_slope(np.ones((64, 64))) == 0.0
    x = rng.random((64, 80))
    slope = images.power_slope(x)
    rings, _, power = images.radial_power(x)
    assert rings.tolist() == list(range(2, 8)) and math.isclose(slope, np.polyfit(np.log(rings), np.log(power), 1)[0], rel_tol=1e-9)
    with pytest.raises(ValueError):
        images.power_slope(np.ones((2, 2, 2)))


def test_percent_maximal():
    x = np.array([[1, 2], [2, 2]])
    assert images.percent_maximal(x) == 75.0 and images.percent_maximal(x, np.zeros((2, 2), bool)) == 0.0


def test_resize_keeps_constants_and_type():
    x = np.full((30, 20), 7, np.uint16)
    assert (images.resize(x, 11) == 7).all() and images.resize(x, 11).shape == (11, 11) and images.resize(x, 11).dtype == np.uint16
    same = np.arange(36.0).reshape(6, 6)
    assert np.allclose(images.resize(same, 6), same)


def test_tiff_round_trip():
    rng = np.random.default_rng(1)
    for x in (rng.integers(0, 255, (5, 7)).astype(np.uint8), rng.integers(0, 65535, (4, 3)).astype(np.uint16), rng.random((3, 3)).astype(np.float32)):
        assert (codec.decode(codec.encode_tiff(x)) == x).all() and codec.decode(codec.encode_tiff(x)).dtype == x.dtype


def test_tiff_of_signed_and_colour_pixels():
    rng = np.random.default_rng(2)
    for x in (np.array([[-5, 3], [7, -32768]], np.int16), np.array([[-1, 2, 3]], np.int8), rng.integers(0, 255, (5, 7, 3)).astype(np.uint8), rng.integers(0, 60000, (3, 4, 4)).astype(np.uint16), np.array([[-70000]], np.int32)):
        back = codec.decode(codec.encode_tiff(x))
        assert back.dtype == x.dtype and back.shape == x.shape and (back == x).all()
    small = images.resize(np.dstack([np.full((9, 8), v, np.uint8) for v in (1, 2, 3)]), 4)
    assert small.shape == (4, 4, 3) and small[0, 0].tolist() == [1, 2, 3]
    with pytest.raises(ValueError):
        codec.encode_tiff(np.zeros((2, 2), np.float64))


def test_image_qc_from_files(spark, tmp_path):
    """Files of one name in two folders are told apart; columns of an earlier run go; a file that is not there is reported."""
    from platelake.plans import pipelines

    rng = np.random.default_rng(5)
    a, b, c = (rng.integers(1, 200, (64, 64)).astype(np.uint8) for _ in range(3))
    for name, x in (("P1/x.tif", a), ("P2/x.tif", b), ("x.tif", c)):
        (tmp_path / "in" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "in" / name).write_bytes(codec.encode_tiff(x))
    np.save(tmp_path / "DNA_illum.npy", np.full((64, 64), 2.0))
    sites = spark.createDataFrame([(1, "P1/x.tif", "x.tif", 9.0), (2, "./P2/x.tif", "gone.tif", 9.0)], "site_id int, FileName_DNA string, FileName_ER string, ImageQuality_PercentMaximal_DNA double")
    for small in (64 << 20, 0):
        got = {r["site_id"]: r for r in pipelines.image_qc(spark, sites, str(tmp_path / "in"), str(tmp_path), small=small).collect()}
        assert math.isclose(got[1]["ImageQuality_PowerLogLogSlope_DNA"], images.power_slope(a / 2.0)) and math.isclose(got[2]["ImageQuality_PowerLogLogSlope_DNA"], images.power_slope(b / 2.0))
        assert math.isclose(got[1]["ImageQuality_PercentMaximal_ER"], images.percent_maximal(c)) and got[2]["QC_Error_ER"] == "File Not Found" and got[1]["QC_Error_ER"] is None
    again = pipelines.image_qc(spark, pipelines.image_qc(spark, sites, str(tmp_path / "in")), str(tmp_path / "in"))
    assert len(set(again.columns)) == len(again.columns) == 3 + 6
    with pytest.raises(Exception, match="two images"):
        pipelines.image_qc(spark, sites.withColumn("site_id", F.lit(1)), str(tmp_path / "in")).collect()


def test_projection_from_files_to_files(spark, tmp_path):
    from platelake.plans import pipelines

    rng = np.random.default_rng(6)
    rows, held = [], {}
    for k in range(13):
        x = rng.integers(0, 255, (6, 5) if k != 7 else (5, 6)).astype(np.uint8)
        (tmp_path / "in/a/Images").mkdir(parents=True, exist_ok=True)
        (tmp_path / f"in/a/Images/{k}.tif").write_bytes(codec.encode_tiff(x))
        held[k] = x
        rows.append(("P", "a/Images", f"{k}.tif", k))
    planes = spark.createDataFrame(rows, "PlateID string, Image_PathName string, Image_FileName string, row_idx int")
    got = {(r["chunk"], r["channel"]): r for r in pipelines.project_files(spark, planes, str(tmp_path / "in"), 2, 3).collect()}
    assert set(got) == {(0, 0), (0, 1), (1, 0), (1, 1)} and got[0, 1]["path"] == "a/ImagesStacked/1.tif"
    assert (codec.decode(bytes(got[0, 0]["content"])) == np.maximum.reduce([held[0], held[2], held[4]])).all()
    assert got[1, 1]["content"] is None and "different shape" in got[1, 1]["error"]
    done = pipelines.project_files(spark, planes, str(tmp_path / "in"), 2, 3, str(tmp_path / "out")).collect()
    assert len(done) == 3 and (codec.decode((tmp_path / "out/a/ImagesStacked/0.tif").read_bytes()) == np.maximum.reduce([held[0], held[2], held[4]])).all()


def test_plane_groups_and_projection(spark):
    planes = spark.createDataFrame([("P", k, [float(k), 10.0 - k]) for k in range(14)], "PlateID string, row_idx int, pixels array<double>")
    got = images.plane_groups(planes, 2, 3, ["row_idx"])
    assert got.count() == 12 and [tuple(r) for r in got.orderBy("row_idx").select("chunk", "channel", "plane").collect()][:7] == [(0, 0, 0), (0, 1, 0), (0, 0, 1), (0, 1, 1), (0, 0, 2), (0, 1, 2), (1, 0, 0)]
    top = images.max_projection(got, ["PlateID", "chunk", "channel"]).orderBy("chunk", "channel").collect()
    assert top[0]["pixels"] == [4.0, 10.0] and len(top) == 4
    again = images.max_projection(spark.createDataFrame(top), ["PlateID", "chunk", "channel"]).orderBy("chunk", "channel").collect()
    assert again == top
    odd = spark.createDataFrame([("a", [1.0]), ("a", [1.0, 2.0])], "k string, pixels array<double>")
    with pytest.raises(Exception, match="different size"):
        images.max_projection(odd, ["k"]).collect()


def test_image_files(spark, tmp_path):
    rng = np.random.default_rng(3)
    x = rng.integers(1, 200, (48, 48)).astype(np.uint8)
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.TIF").write_bytes(codec.encode_tiff(x))
    (tmp_path / "in/b.tif").write_bytes(b"broken")
    (tmp_path / "in/c.txt").write_bytes(b"no image")
    np.save(tmp_path / "IllumDNA.npy", np.full((48, 48), 2.0))
    files = tables.images_below(spark, str(tmp_path / "in"))
    assert files.count() == 2
    made = {r["path"].rsplit("/")[-1]: r for r in codec.map_images(files, lambda a: images.resize(a, 24), lambda p: p.replace("in/", "out/")).collect()}
    assert codec.decode(bytes(made["a.TIF"]["content"])).shape == (24, 24) and made["a.TIF"]["error"] is None
    assert made["b.tif"]["content"] is None and made["b.tif"]["error"]
    kept = spark.createDataFrame([("x/a.tif", made["a.TIF"]["content"]), ("x/none.tif", None)], "path string, content binary")
    assert [tuple(r) for r in codec.write_files(kept, str(tmp_path / "w")).collect()] == [("x/a.tif", len(made["a.TIF"]["content"]), None)]
    assert (tmp_path / "w/x/a.tif").read_bytes() == bytes(made["a.TIF"]["content"]) and len(list((tmp_path / "w/x").iterdir())) == 1
    light = codec.load_arrays(spark.read.format("binaryFile").load(str(tmp_path / "*.npy")))
    assert codec.illumination_of(light, "DNA").shape == (48, 48) and codec.illumination_of(light, "ER") is None
    sites = spark.createDataFrame([(0, "a.TIF", "b.tif")], "site int, FileName_DNA string, FileName_ER string")
    joined = images.unpivot_channels(sites, "site").join(files.select(F.element_at(F.split("path", "/"), -1).alias("file"), "content"), "file")
    wide = images.quality_columns(sites, images.image_quality(joined, "site", light), "site", ["DNA", "ER"]).first()
    assert math.isclose(wide["ImageQuality_PowerLogLogSlope_DNA"], images.power_slope(x / 2.0)) and wide["QC_Error_DNA"] is None
    assert wide["ImageQuality_PercentMaximal_ER"] is None and wide["QC_Error_ER"]


def test_model_interface(spark):
    def stack(site):
        return np.dstack([np.arange(500.0 * 500).reshape(500, 500)] * (3 if site["site"] == 2 else 2))

    def models():
        def segment(s):
            mask = np.zeros((500, 500), int)
            mask[200:240, 200:240], mask[0:20, 0:20] = 1, 2
            return mask

        return segment, lambda batch: batch.reshape(len(batch), -1, 2).max(1), lambda flat: np.full(len(flat), 0.6)

    def broken(site):
        raise OSError("gone")

    sites = spark.createDataFrame([(1,), (2,)], "site int")
    got = {r["site"]: r for r in cells.process_sites(sites, "site", stack, models, 2).collect()}
    assert (got[1]["cell_index"], got[1]["y"], got[1]["x"], got[1]["is_dead"], got[1]["embedding"]) == (0, 219, 219, True, [255.0, 255.0])
    assert got[2]["cell_index"] is None and got[2]["error"] is None
    assert cells.process_sites(sites, "site", stack, models, 2, drop_dead=True).filter("cell_index IS NOT NULL").count() == 0
    assert {r["error"] for r in cells.process_sites(sites, "site", broken, models, 2).collect()} == {"OSError: gone"}


def test_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Metadata_Well;n;x;t\nA01;1;1.5;NA\nB02;;nan;NAN\n")
    df = tables.read_csv(spark, str(tmp_path / "a.csv"))
    assert dict(df.dtypes) == {"Metadata_Well": "string", "n": "bigint", "x": "double", "t": "string"}
    assert sorted(map(tuple, df.collect())) == [("A01", 1, 1.5, None), ("B02", None, None, "NAN")]
    tables.write_csv(df.withColumn("l", F.array(F.lit(1), F.lit(2))), str(tmp_path / "out"), single=True)
    again = tables.read_csv(spark, str(tmp_path / "out/*.csv"), ",")
    assert again.columns == [*df.columns, "l"] and {r["l"] for r in again.collect()} == {"[1,2]"}


def test_matching_and_union(spark, tmp_path):
    for plate, text in (("p1", "a,b\n1,2\n"), ("p2", "b,c\n3,4\n")):
        (tmp_path / plate).mkdir()
        (tmp_path / plate / "Normalized_features_6h.csv").write_text(text)
        (tmp_path / plate / "other.csv").write_text("z\n1\n")
    found = tables.read_matching(spark, str(tmp_path))
    assert sorted(map(tuple, tables.append(found).select("a", "b", "c").collect()), key=str) == [(1, 2, None), (None, 3, 4)]
    moved = tables.append([found[0], found[1]], strict_position=True)
    assert sorted(map(tuple, moved.collect())) == [(1, 2), (3, 4)] and moved.columns == ["a", "b"]


def test_concat_timepoints(spark, tmp_path):
    for time in ("6h", "12h", "24h"):
        (tmp_path / time).mkdir()
        (tmp_path / time / "Nuclei.csv").write_text("ImageNumber,Area\n1,5\n2,6\n")
        if time != "24h":
            (tmp_path / time / "Image.csv").write_text("ImageNumber,Metadata_Plate,Metadata_Site,Metadata_Well\n1,P,3,A01\n")
    made, skipped = tables.concat_timepoints(spark, {t: str(tmp_path / t) for t in ("6h", "12h", "24h")}, ("Nuclei", "Image"))
    assert [s.split(":")[0] for s in skipped] == ["24h/Image"]
    assert sorted((r["Metadata_Timepoint"], r["ImageNumber"], r["Metadata_Well"]) for r in made["Nuclei"].collect()) == [("12h", 1, "A01"), ("12h", 2, None), ("6h", 1, "A01"), ("6h", 2, None)] or made["Nuclei"].count() == 4


def test_folders_and_row_index(spark, tmp_path):
    paths = spark.createDataFrame([("a/b/dmso_1/c.tif",), ("a/b/dmso_1/d.tif",), ("x/y.tif",), ("q/6h_P/z/6h_P/w.tif",)], "path string")
    assert [r[0] for r in tables.main_folders(paths, ["dmso", "6h_"]).collect()] == ["a/b/dmso_1", "q/6h_P"]
    tables.write_parquet(spark.range(0, 25, 1, 3), str(tmp_path / "t"), rows=4)
    got = tables.with_row_index(spark.read.parquet(str(tmp_path / "t"))).collect()
    assert sorted(r["row_idx"] for r in got) == list(range(25)) and all(r["row_idx"] == r["id"] for r in got)
    assert tables.output_name("s3/x.parquet", "_coords.parquet") == "s3/x_coords.parquet"


def test_stream_of_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/1.csv").write_text("ImageNumber,v\n1,2.0\n")
    go = lambda: follow_csv(spark, str(tmp_path / "in"), "ImageNumber int, v double", lambda d: d.withColumn("w", F.col("v") * 2), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination(60)
    go()
    (tmp_path / "in/2.csv").write_text("ImageNumber,v\n2,3.0\n")
    go()
    got = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted((r["ImageNumber"], r["w"]) for r in got) == [(1, 4.0), (2, 6.0)]


def test_every_vector_is_in_a_picture(spark, tmp_path):
    from platelake.operators.images import percent_maximal, power_slope
    from platelake.plans.catalog import QUERIES

    rng = np.random.default_rng(3)
    data = [(k * 3 + 1, 0 if k % 6 else 1, rng.normal(size=64).tolist()) for k in range(130)]
    spark.createDataFrame(data, "vec_id long, label int, embedding array<double>").repartition(3).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = {(r["label"], r["picture"]): (r["slope"], r["percent"]) for r in QUERIES["radial_power_slope"](spark, str(tmp_path)).collect()}
    want = {}
    for label in (0, 1):
        x = np.concatenate([v for _, k, v in data if k == label])
        for p in range(-(-len(x) // 1600)):
            one = np.zeros(1600)
            one[: len(x[p * 1600 : (p + 1) * 1600])] = x[p * 1600 : (p + 1) * 1600]
            want[label, p] = power_slope(one.reshape(40, 40)), percent_maximal(one.reshape(40, 40))
    assert set(got) == set(want) and len(want) == 6
    assert all(np.allclose(got[k], want[k], atol=2e-6) for k in want)


def test_parquet_row_groups(spark, tmp_path):
    import pyarrow.parquet as pq

    tables.write_parquet(spark.range(250).coalesce(1), str(tmp_path / "t"), rows=100)
    (file,) = (tmp_path / "t").glob("*.parquet")
    groups = pq.ParquetFile(file).metadata
    assert [groups.row_group(k).num_rows for k in range(groups.num_row_groups)] == [100, 100, 50]
