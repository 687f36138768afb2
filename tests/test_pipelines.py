"""Whole runs over files made here."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from platelake.plans import pipelines
from platelake.sources.images import encode_tiff


@pytest.fixture(scope="module")
def experiment(tmp_path_factory):
    """A plate at two times: four wells of two sites with three objects each; image 8 fails."""
    base = tmp_path_factory.mktemp("experiment")
    rng = np.random.default_rng(0)
    wells = ["A01", "A02", "B01", "B02"]
    maps = {}
    for plate in ("P1",):
        (base / f"{plate}.csv").write_text("Metadata_Compound;Metadata_ConcLevel;Metadata_Well;Metadata_Plate\n" + "".join(f"{c};{k};{w};{plate}\n" for c, k, w in (("dmso", 0, "A01"), ("DMSO", 0, "A02"), ("drug", 1, "B01"), ("drug", 1, "B02"))))
        maps[f"binned/{plate}"] = str(base / f"{plate}.csv")
        for time in ("6h", "12h"):
            folder = base / "binned" / plate / time
            folder.mkdir(parents=True)
            image = [(n + 1, w, s, int(n == 7), 10.0 + n) for n, (w, s) in enumerate(itertools.product(wells, (1, 2)))]
            (folder / "Image.csv").write_text("ImageNumber,Metadata_Well,Metadata_Site,ImageQC_blur,Count_x,URL_a\n" + "".join(f"{n},{w},{s},{q},{c},u\n" for n, w, s, q, c in image))
            for t in ("Nuclei", "Cells", "Cytoplasm"):
                rows = [(n, k, 3 + k, rng.normal() + 4 * (w[0] == "B")) for n, w, *_ in image for k in range(3)]
                (folder / f"{t}.csv").write_text("ImageNumber,ObjectNumber,Children,Area\n" + "".join(f"{n},{k},{c},{a}\n" for n, k, c, a in rows))
    return str(base), maps


def test_profiling_chain(spark, experiment, tmp_path):
    base, maps = experiment
    done = pipelines.normalize_plates(spark, base, maps, ["6h", "12h"], str(tmp_path / "normalized"))
    assert done.count() == 8
    back = spark.read.parquet(str(tmp_path / "normalized"))
    assert back.count() == 8 and {r[0] for r in back.select("Metadata_Timepoint").distinct().collect()} == {"6h", "12h"}
    control = done.filter("Metadata_Compound = 'DMSO'").groupBy("Metadata_Plate", "Metadata_Timepoint").agg(F.median("DNA_Area").alias("m"))
    assert all(abs(r["m"]) < 1e-9 for r in control.collect())
    selected, cosines = pipelines.select_features(back.select(*done.columns), operations=("drop_na_columns",))
    assert cosines.count() == 4 and all(-1 <= r["average_cosine_similarity"] <= 1 for r in cosines.collect())
    selected.write.parquet(str(tmp_path / "selected"))
    hits = pipelines.call_hits(spark.read.parquet(str(tmp_path / "selected")), threshold=0.5)
    assert hits["flags"].count() == 2 and hits["induction"].count() == 8
    pivot = hits["pivot"].collect()
    assert len(pivot) == 1 and hits["pivot"].columns == ["Metadata_Plate", "Metadata_Compound", "6h", "12h", "any_active"]
    for name, df in hits.items():
        df.collect()
    with pytest.raises(Exception, match="no control rows"):
        pipelines.normalize_plates(spark, base, maps, ["6h"], control="dmso").collect()


def test_flat_plates_and_columns_that_differ(spark, tmp_path):
    """Plates without a folder a time stand for each time; a count is scaled where it has no blank, whatever other files hold."""
    maps = {}
    for plate, blank, extra in (("P 1", "4", ""), ("P2", "", ",More"), ("P3", "", "")):
        (tmp_path / plate).mkdir()
        (tmp_path / f"{plate}.csv").write_text("Metadata_Compound,Metadata_ConcLevel,Metadata_Well,Metadata_Plate\n" + f"dmso,0,A,{plate}\ndmso,0,B,{plate}\n")
        (tmp_path / plate / "Image.csv").write_text("ImageNumber,Metadata_Well,Metadata_Site,ImageQC_x,Metadata_Plate\n1,A,1,0,9\n2,A,2,0,9\n3,B,1,0,9\n4,B,2,1,9\n")
        for t in ("Nuclei", "Cells", "Cytoplasm"):
            own = f",{7}" if extra else ""
            (tmp_path / plate / f"{t}.csv").write_text(f"ImageNumber,Count{extra}\n1,2{own}\n2,{blank}{own}\n3,3{own}\n4,50{own}\n")
        maps[plate] = str(tmp_path / f"{plate}.csv")
    from platelake.operators import wells
    from platelake.sources import tables

    label = {"Metadata_Plate": F.element_at(F.split("_file", "/"), -2), "Metadata_Timepoint": F.lit("6h")}
    read = {t: tables.read_csvs(spark, [f"{tmp_path}/{p}/{t}.csv" for p in maps], label) for t in ("Image", "Nuclei", "Cells", "Cytoplasm")}
    assert len(read["Image"]) == 1 and len(read["Cells"]) == 2
    layout = spark.createDataFrame([("dmso", 0, w, p) for p in maps for w in "AB"], "Metadata_Compound string, Metadata_ConcLevel int, Metadata_Well string, Metadata_Plate string")
    got = {(r["Metadata_Plate"], r["Metadata_Well"]): r for r in wells.plate_profiles(read, layout).collect()}
    assert {k: r["DNA_Count"] for k, r in got.items()} == {("P 1", "A"): 3.0, ("P 1", "B"): 6.0, ("P2", "A"): 2.0, ("P2", "B"): 3.0, ("P3", "A"): 2.0, ("P3", "B"): 3.0}
    assert got["P 1", "A"]["Cell_More"] is None and got["P2", "B"]["Cell_More"] == 14.0 and got["P2", "A"]["Metadata_Compound"] == "DMSO"
    both = pipelines.normalize_plates(spark, str(tmp_path), maps, ["6h", "12h"], time_folders=False)
    rows = both.select("Metadata_Plate", "Metadata_Well", "Metadata_Timepoint").collect()
    assert len(rows) == len(set(rows)) == 12 and {r["Metadata_Timepoint"] for r in rows} == {"6h", "12h"}


def test_older_run_whole(spark, tmp_path):
    """Two times of a plate: metadata come from the images, means by well, selection a time, and similarities by hand."""
    rng = np.random.default_rng(3)
    folder, wells = tmp_path / "Plate_7", [("A", "DMSO", 0), ("B", "DMSO", 0), ("C", "DMSO", 0), ("D", "x", 1), ("E", "x", 1), ("F", "x", 1)]
    for time in ("6h", "12h"):
        (folder / time).mkdir(parents=True)
        (folder / time / "Image.csv").write_text("ImageNumber,Metadata_Plate,Metadata_Site,Metadata_Well,Metadata_Timepoint,Metadata_Compound,Metadata_ConcLevel,File\n" + "".join(f"{n},old,1,{w},?,{c},{k},f\n" for n, (w, c, k) in enumerate(wells)))
        for t in ("Nuclei", "Cells", "Cytoplasm"):
            (folder / time / f"{t}.csv").write_text("ImageNumber,Area,Round\n" + "".join(f"{n},{rng.normal() + n},{rng.normal()}\n" for n in range(6) for _ in range(2)))
    out = pipelines.profile_times(spark, str(folder), ["6h", "12h"], str(tmp_path / "out"), operations=("drop_na_columns",))
    assert list(out) == ["6h", "12h"]
    for made in out.values():
        rows = made["selected"].collect()
        names = [c for c in made["selected"].columns if "Metadata" not in c]
        assert len(rows) == 6 and len(names) == 6 and {r["Metadata_Plate"] for r in rows} == {"Plate_7"}
        x = np.array([[r[c] for c in names] for r in sorted((r for r in rows if r["Metadata_Compound"] == "x"), key=lambda r: r["Metadata_Well"])])
        assert (x >= 0).all() and (x <= 1).all()
        u = x / np.linalg.norm(x, axis=1, keepdims=True)
        want = [u[i] @ u[j] for i in range(3) for j in range(i + 1, 3)]
        cosines = {r["Metadata_Compound"]: r for r in made["cosines"].collect()}
        assert np.allclose(cosines["x"]["cosine_similarities"], want) and len(cosines) == 2
        means = {r["Metadata_Compound"]: r["average_cosine_similarity"] for r in made["averages"].collect()}
        assert math.isclose(means["x"], np.mean(want), rel_tol=1e-9)
    assert (tmp_path / "out/12h/cosines").exists()


def test_sites_scale_counts_after_qc(spark, experiment):
    base, maps = experiment
    from platelake.operators.wells import well_profiles
    from platelake.sources.tables import read_csv

    loaded = {t: read_csv(spark, f"{base}/binned/P1/6h/{t}.csv") for t in ("Image", "Nuclei")}
    got = {r["Metadata_Well"]: r for r in well_profiles(loaded, read_csv(spark, maps["binned/P1"]), "6h").collect()}
    assert got["A01"]["DNA_Children"] == 4.0 and got["B02"]["DNA_Children"] == 8.0  # one of two sites is left
    loose = {r["Metadata_Well"]: r for r in well_profiles(loaded, read_csv(spark, maps["binned/P1"]), "6h", qc_drop=False).collect()}
    assert loose["B02"]["DNA_Children"] == 4.0


def test_older_form(spark):
    rows = [("p", w, "6h", c, v) for w, c, v in (("A", "DMSO", 1.0), ("A", "DMSO", 3.0), ("B", "DMSO", 5.0), ("C", "x", 9.0))]
    t = spark.createDataFrame(rows, "Metadata_Plate string, Metadata_Well string, Metadata_Timepoint string, Metadata_Compound string, Area double")
    got = pipelines.profile_objects({"Cells": t, "Nuclei": t}).collect()
    assert len(got) == 3 and all(0 <= r["Cell_Area"] <= 1 for r in got)
    mad = 1.5 * 1.4826
    x = (9 - 3.5) / mad / 2.3538
    assert math.isclose(next(r for r in got if r["Metadata_Well"] == "C")["DNA_Area"], x**3 / math.sqrt(1 + x**6), rel_tol=1e-9)


def test_image_runs(spark, tmp_path):
    rng = np.random.default_rng(1)
    (tmp_path / "Image").mkdir()
    for n in ("a", "b"):
        (tmp_path / f"Image/{n}.tif").write_bytes(encode_tiff(rng.integers(0, 99, (48, 48)).astype(np.uint8)))
    sites = spark.createDataFrame([(0, "a.tif", "b.tif"), (1, "b.tif", "gone.tif")], "site_id int, FileName_DNA string, FileName_ER string")
    got = {r["site_id"]: r for r in pipelines.image_qc(spark, sites, str(tmp_path / "Image")).collect()}
    assert got[0]["ImageQuality_PowerLogLogSlope_ER"] == got[1]["ImageQuality_PowerLogLogSlope_DNA"] and got[1]["QC_Error_ER"]
    made = pipelines.rebin_images(spark, str(tmp_path / "Image"), 16).collect()
    assert len(made) == 2 and all("Image_binned" in r["path"] and r["content"] for r in made)


def test_projection_run(spark):
    planes = spark.createDataFrame([("P", "x/Images", f"{k}.tif", k) for k in range(7)], "PlateID string, Image_PathName string, Image_FileName string, row_idx int")
    pixels = spark.createDataFrame([(f"x/Images/{k}.tif", [float(k), 9.0 - k]) for k in range(7)], "path string, pixels array<double>")
    got = sorted(pipelines.project_planes(planes, pixels, 2, 3).collect(), key=lambda r: r["channel"])
    assert [(r["path"], r["pixels"]) for r in got] == [("x/ImagesStacked/0.tif", [4.0, 9.0]), ("x/ImagesStacked/1.tif", [5.0, 8.0])]


def test_embedding_run(spark):
    def models():
        def segment(s):
            mask = np.zeros(s.shape[:2], int)
            mask[140:160, 140:160], mask[180:200, 180:200] = 1, 2
            return mask

        return segment, lambda x: np.stack([np.full((2, 3), k + 1.0) for k in range(len(x))]), lambda flat: np.array([0.9] + [0.1] * (len(flat) - 1))

    sites = spark.createDataFrame([(1, "A01", 1, "p"), (2, "A01", 2, "p"), (3, "B01", 1, "p")], "site_id int, Metadata_Well string, Metadata_Site int, Metadata_Plate string")
    size = lambda site: np.zeros((90 if site["site_id"] == 3 else 340, 340, 2))
    out = pipelines.embed_sites(sites, "site_id", size, models, 2)
    assert sorted((r["site_id"], r["Cell_Count"], r["Dead_Cells"]) for r in out["sites"].collect()) == [(1, 2, 1), (2, 2, 1), (3, 0, 0)]
    assert {r["Cell_ID"] for r in out["coordinates"].collect()} == {f"A01_{s}_cell{k}" for s in (1, 2) for k in (0, 1)}
    wells = {r["Metadata_Well"]: r for r in out["wells"].collect()}
    assert wells["A01"]["Cell_Count"] == 2 and wells["A01"]["mean_features"] == [2.0] * 6 and wells["B01"]["Cell_Count"] == 0
    assert out["single_cells"].count() == 4 and out["errors"].count() == 0 or out["errors"].first()["site_id"] == 3
