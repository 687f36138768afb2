"""The query catalogue over the driver tables, each query with its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from platelake.functions import scalars
from platelake.functions.naming import drop_bookkeeping, drop_stale_qc, drop_text_features, features_not_starting, features_without, nulls_for_tokens, prefixed
from platelake.operators import cells as C
from platelake.operators import images as I
from platelake.operators import induction as H
from platelake.operators import jobs, qc, selection, similarity, wells
from platelake.operators.normalize import mad_robustize
from platelake.operators.profiles import Profiles
from platelake.plans.adapters import CONTROL, FEATURES, META, SQL_CELLS, SQL_EVENTS, SQL_IMAGES, SQL_OBJECTS, TIMES, cells, events, images, load, measurements, objects
from platelake.session import scratch
from platelake.sources.images import decode, map_images
from platelake.sources.tables import append, main_folders, read_csvs, write_csv, write_parquet

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
GROUP = ["Metadata_Plate", "Metadata_Timepoint"]


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its name, with its SQL."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Floating results to a comparable number of digits, without a negative zero."""
    return df.withColumns({c: F.round(F.col(c), digits) + F.lit(0.0) for c in columns})


def control() -> F.Column:
    return F.col("Metadata_Compound") == CONTROL


# --- Induction and hits -------------------------------------------------------------------------------------------------

#: Thresholds that give both outcomes on the driver tables.
INDUCED, QUANTILE = 0.5, 0.95

_MAD = f"""med AS (SELECT Metadata_Plate, Metadata_Timepoint, {", ".join(f"median({f}) AS m_{f}" for f in FEATURES)}
        FROM obj WHERE Metadata_Compound = '{CONTROL}' GROUP BY ALL),
    mad AS (SELECT o.Metadata_Plate, o.Metadata_Timepoint, {", ".join(f"median(abs({f} - m_{f})) * 1.4826 AS s_{f}" for f in FEATURES)}
        FROM obj o JOIN med USING (Metadata_Plate, Metadata_Timepoint) WHERE Metadata_Compound = '{CONTROL}' GROUP BY ALL),
    scaled AS (SELECT o.* EXCLUDE ({", ".join(FEATURES)}), {", ".join(f"({f} - m_{f}) / (s_{f} + 1e-18) AS {f}" for f in FEATURES)}
        FROM obj o LEFT JOIN med USING (Metadata_Plate, Metadata_Timepoint) LEFT JOIN mad USING (Metadata_Plate, Metadata_Timepoint))"""
_SIG = "abs(pow({0} / 2.3538, 3) / sqrt(1 + pow({0} / 2.3538, 6)))"
_IND = f"""ind AS (SELECT *, ({" + ".join(f"CASE WHEN {_SIG.format(f)} > {INDUCED} THEN 1 ELSE 0 END" for f in FEATURES)}) / 4.0::DOUBLE AS induction FROM scaled)"""
_FLAGS = f"""thr AS (SELECT Metadata_Plate, Metadata_Timepoint, quantile_cont(induction, {QUANTILE}) AS threshold FROM ind WHERE Metadata_Compound = '{CONTROL}' GROUP BY ALL),
    mean AS (SELECT Metadata_Plate, Metadata_Timepoint, Metadata_Compound, Metadata_ConcLevel, avg(induction) AS induction_mean
        FROM ind WHERE Metadata_Compound <> '{CONTROL}' GROUP BY ALL),
    flags AS (SELECT mean.*, threshold, CASE WHEN induction_mean >= threshold THEN 1 ELSE 0 END AS Bioactive FROM mean LEFT JOIN thr USING (Metadata_Plate, Metadata_Timepoint))"""
_HITS = f"WITH {SQL_OBJECTS}, {_MAD}, {_IND}, {_FLAGS}"


def normalised(spark: SparkSession, sf_dir: str) -> Profiles:
    obj = objects(spark, sf_dir).select("ImageNumber", "line", *META, *FEATURES)
    return mad_robustize(Profiles.of(obj, FEATURES), GROUP, control())


def induced(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = normalised(spark, sf_dir).mapped(lambda x: F.abs(scalars.double_sigmoid(x)))
    return p.df.withColumn("induction", H.induction(F.col("features"), INDUCED, array=True))


def flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = induced(spark, sf_dir)
    return H.flag_hits(H.mean_induction(rows, control()), H.control_threshold(rows, control(), QUANTILE))


@query(f"""WITH {SQL_OBJECTS} SELECT ImageNumber, line,
    round(({" + ".join(f"CASE WHEN {f} > 0.05 THEN 1 ELSE 0 END" for f in FEATURES)}) / 4.0::DOUBLE, 6) AS induction FROM obj""")
def induction_score(spark, sf_dir):
    obj = objects(spark, sf_dir).select("ImageNumber", "line", H.induction(FEATURES, 0.05).alias("induction"))
    return rounded(obj, "induction")


@query(f"WITH {SQL_EVENTS} SELECT Metadata_Plate, round(quantile_cont(value, 0.95), 6) AS threshold FROM ev WHERE Metadata_Compound = 'view' GROUP BY ALL")
def control_quantile_threshold(spark, sf_dir):
    return rounded(H.control_threshold(events(spark, sf_dir), F.col("Metadata_Compound") == "view", 0.95, "value", ("Metadata_Plate",)), "threshold")


@query(f"""{_HITS} SELECT Metadata_Plate, Metadata_Timepoint, Metadata_Compound, Metadata_ConcLevel, round(induction_mean, 6) AS induction_mean,
    round(threshold, 6) AS threshold, Bioactive FROM flags""")
def bioactivity_hits(spark, sf_dir):
    return rounded(flags(spark, sf_dir), "induction_mean", "threshold").select(*GROUP, "Metadata_Compound", "Metadata_ConcLevel", "induction_mean", "threshold", "Bioactive")


@query(f"{_HITS} SELECT Metadata_Timepoint, Metadata_Compound, max(Bioactive) AS Bioactive FROM flags GROUP BY ALL")
def bioactivity_summary(spark, sf_dir):
    return H.hits_by(flags(spark, sf_dir), "Metadata_Timepoint", "Metadata_Compound")


@query(f"{_HITS} SELECT Metadata_Plate, upper(Metadata_Compound) AS Metadata_Compound, Metadata_Timepoint, max(Bioactive) AS Bioactive FROM flags GROUP BY ALL")
def bioactivity_by_plate(spark, sf_dir):
    return H.hits_by(flags(spark, sf_dir).withColumn("Metadata_Compound", F.upper("Metadata_Compound")), "Metadata_Plate", "Metadata_Compound", "Metadata_Timepoint")


@query(f"""{_HITS} SELECT Metadata_Plate, Metadata_Compound, {", ".join(f"coalesce(max(CASE WHEN Metadata_Timepoint = '{t}' THEN Bioactive END), 0) AS t{t}" for t in TIMES)},
    coalesce(max(Bioactive), 0) AS any_active FROM flags GROUP BY ALL""")
def bioactivity_pivot(spark, sf_dir):
    return H.hit_pivot(flags(spark, sf_dir), TIMES).withColumnsRenamed({t: f"t{t}" for t in TIMES})


@query(f"""{_HITS}, of AS (SELECT Metadata_Compound, max(Bioactive) AS a FROM flags GROUP BY ALL)
    SELECT count(*) FILTER (WHERE a = 0) AS only_all, CAST(0 AS BIGINT) AS only_active, count(*) FILTER (WHERE a = 1) AS both FROM of""")
def venn_overall(spark, sf_dir):
    return H.venn(flags(spark, sf_dir))


@query(f"""{_HITS}, ever AS (SELECT count(DISTINCT Metadata_Compound) AS n FROM flags WHERE Bioactive = 1),
    cur AS (SELECT Metadata_Timepoint, count(DISTINCT Metadata_Compound) AS b FROM flags WHERE Bioactive = 1 GROUP BY ALL)
    SELECT Metadata_Timepoint, n - b AS only_all, CAST(0 AS BIGINT) AS only_time, b AS both, CAST(floor(b * 100 / n) AS INTEGER) AS percent FROM cur, ever""")
def venn_per_timepoint(spark, sf_dir):
    return H.venn_per_time(flags(spark, sf_dir))


# Controls of each plate and time are binned over their own range, as a histogram of that group alone is.
@query(f"""{_HITS}, c AS (SELECT Metadata_Plate, Metadata_Timepoint, induction AS v FROM ind WHERE Metadata_Compound = '{CONTROL}'),
    r AS (SELECT Metadata_Plate, Metadata_Timepoint, min(v) AS lo, max(v) AS hi FROM c GROUP BY ALL),
    e AS (SELECT Metadata_Plate, Metadata_Timepoint, CASE WHEN hi = lo THEN lo - 0.5 ELSE lo END AS lo, CASE WHEN hi = lo THEN 1.0 ELSE hi - lo END / 100 AS w FROM r)
    SELECT Metadata_Plate, Metadata_Timepoint, CAST(least(99, floor((v - lo) / w)) AS BIGINT) AS bin, round(any_value(lo), 6) AS start, count(*) AS n
    FROM c JOIN e USING (Metadata_Plate, Metadata_Timepoint) GROUP BY Metadata_Plate, Metadata_Timepoint, bin""")
def induction_histogram(spark, sf_dir):
    made = H.histogram(induced(spark, sf_dir).filter(control()), GROUP)
    return rounded(made.select(*GROUP, "bin", (F.col("low") - F.col("bin") * (F.col("high") - F.col("low"))).alias("start"), "n"), "start")


@query(f"""WITH {SQL_EVENTS}, c AS (SELECT * FROM ev WHERE value IS NOT NULL), r AS (SELECT Metadata_Plate, Metadata_Compound, min(value) AS lo, (max(value) - min(value)) / 100 AS w FROM c GROUP BY ALL)
    SELECT Metadata_Plate, Metadata_Compound, CAST(least(99, floor((value - lo) / w)) AS BIGINT) AS bin, count(*) AS n FROM c JOIN r USING (Metadata_Plate, Metadata_Compound) GROUP BY ALL""")
def event_histogram(spark, sf_dir):
    return H.histogram(events(spark, sf_dir), ["Metadata_Plate", "Metadata_Compound"], "value").select("Metadata_Plate", "Metadata_Compound", "bin", "n")


@query(f"""{_HITS}, c AS (SELECT Metadata_Plate, Metadata_Timepoint, induction AS v FROM ind WHERE Metadata_Compound = '{CONTROL}'),
    st AS (SELECT Metadata_Plate, Metadata_Timepoint, count(*) AS n, stddev_samp(v) * pow(count(*), -0.2) AS h, min(v) AS lo, max(v) AS hi FROM c GROUP BY ALL),
    grid AS (SELECT Metadata_Plate, Metadata_Timepoint, n, h, k, lo + k * (hi - lo) / 199 AS x FROM st, range(0, 200) AS r(k) WHERE h > 0),
    vals AS (SELECT Metadata_Plate, Metadata_Timepoint, v, count(*) AS cnt FROM c GROUP BY ALL)
    SELECT Metadata_Plate, Metadata_Timepoint, round(x, 6) AS x, round(sum(cnt * exp(-0.5 * pow((x - v) / h, 2)) / (n * h * sqrt(2 * pi()))), 6) AS density
    FROM grid JOIN vals USING (Metadata_Plate, Metadata_Timepoint) GROUP BY Metadata_Plate, Metadata_Timepoint, x""")
def induction_density(spark, sf_dir):
    return rounded(H.density(induced(spark, sf_dir).filter(control()), GROUP), "x", "density")


# --- Wells --------------------------------------------------------------------------------------------------------------


@query(f"WITH {SQL_IMAGES} SELECT l_orderkey AS ImageNumber, l_linenumber AS line, Metadata_Well, Metadata_Site FROM lineitem LEFT JOIN images ON l_orderkey = ImageNumber")
def image_metadata_left_join(spark, sf_dir):
    return qc.with_image_metadata(measurements(spark, sf_dir), images(spark, sf_dir)).select("ImageNumber", "line", "Metadata_Well", "Metadata_Site")


@query("SELECT l_orderkey AS ImageNumber, l_linenumber AS line, l_quantity AS quantity FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P')")
def qc_any_antijoin(spark, sf_dir):
    flagged = load(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("ImageNumber"), (F.col("o_orderstatus") == "P").cast("int").alias("ImageQC_flag"))
    return qc.without_failing(measurements(spark, sf_dir), flagged).select("ImageNumber", "line", "quantity")


@query("""SELECT o_orderkey AS ImageNumber, o_totalprice FROM orders
    WHERE coalesce(CAST(o_orderstatus = 'P' AS DOUBLE), 0) + coalesce(CASE WHEN o_totalprice > 200000 THEN 0.5 ELSE 0 END, 0) < 1""")
def qc_sum_filter(spark, sf_dir):
    orders = load(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("ImageNumber"), "o_totalprice", (F.col("o_orderstatus") == "P").cast("int").alias("ImageQC_a"), F.when(F.col("o_totalprice") > 200000, 0.5).otherwise(0.0).alias("ImageQC_b"))
    return orders.filter(qc.sum_below_one(orders)).select("ImageNumber", "o_totalprice")


@query("SELECT o_orderkey AS ImageNumber, o_totalprice FROM orders WHERE o_orderstatus <> 'P'")
def qc_keyed_mask(spark, sf_dir):
    orders = load(spark, sf_dir, "orders")
    rows = orders.select(F.col("o_orderkey").alias("ImageNumber"), "o_totalprice")
    quality = orders.select(F.col("o_orderkey").alias("ImageNumber"), (F.col("o_orderstatus") == "P").cast("int").alias("ImageQC_flag"))
    return qc.mask_rows(rows, quality, "ImageNumber", qc.sum_below_one(quality))


def _well(how: str) -> str:
    return f"WITH {SQL_OBJECTS} SELECT Metadata_Well, {', '.join(f'round({how}({f}), 6) AS {f}' for f in FEATURES)} FROM obj GROUP BY ALL"


@query(_well("avg"))
def well_mean(spark, sf_dir):
    return rounded(wells.aggregate_by(objects(spark, sf_dir).select("Metadata_Well", *FEATURES), ["Metadata_Well"]), *FEATURES)


@query(_well("median"))
def well_median(spark, sf_dir):
    return rounded(wells.aggregate_by(objects(spark, sf_dir).select("Metadata_Well", *FEATURES), ["Metadata_Well"], "median"), *FEATURES)


_FOUR = ["Metadata_Plate", "Metadata_Well", "Metadata_Timepoint", "Metadata_Compound"]


@query(f"WITH {SQL_OBJECTS} SELECT {', '.join(_FOUR)}, {', '.join(f'round(avg({f}), 8) AS {f}' for f in FEATURES)} FROM obj GROUP BY ALL")
def profile_mean_4key(spark, sf_dir):
    return rounded(wells.aggregate_by(objects(spark, sf_dir).select(*_FOUR, *FEATURES), _FOUR), *FEATURES, digits=8)


_SCALE = f"""WITH {SQL_OBJECTS}, s AS (SELECT {', '.join(GROUP)}, Metadata_Well, count(DISTINCT Metadata_Site) AS n_sites FROM obj GROUP BY ALL),
    f AS (SELECT *, max(n_sites) OVER (PARTITION BY {', '.join(GROUP)}) / n_sites::DOUBLE AS scaling_factor FROM s)"""


@query(f"{_SCALE} SELECT {', '.join(GROUP)}, Metadata_Well, n_sites, round(scaling_factor, 6) AS scaling_factor FROM f")
def site_scaling(spark, sf_dir):
    return rounded(wells.site_scaling(objects(spark, sf_dir), GROUP), "scaling_factor")


@query(f"{_SCALE} SELECT ImageNumber, round(line * scaling_factor, 6) AS line FROM obj JOIN f USING ({', '.join(GROUP)}, Metadata_Well)")
def scaled_counts(spark, sf_dir):
    return rounded(wells.scale_counts(objects(spark, sf_dir), GROUP, ["line"]).select("ImageNumber", "line"), "line")


_KINDS = {"A": "DNA_", "N": "Cell_", "R": "Cyto_"}


@query(f"""WITH {SQL_OBJECTS}, {", ".join(f"k{k} AS (SELECT Metadata_Well, avg(quantity) AS {p}quantity, avg(tax) AS {p}tax FROM obj WHERE kind = '{k}' GROUP BY ALL)" for k, p in _KINDS.items())}
    SELECT Metadata_Well, {", ".join(f"round({p}{f}, 6) AS {p}{f}" for p in _KINDS.values() for f in ("quantity", "tax"))}
    FROM kA FULL JOIN kN USING (Metadata_Well) FULL JOIN kR USING (Metadata_Well)""")
def well_outer_merge(spark, sf_dir):
    obj = objects(spark, sf_dir).select("kind", "Metadata_Well", "quantity", "tax")
    parts = [wells.aggregate_by(prefixed(obj.filter(F.col("kind") == k).drop("kind"), p), ["Metadata_Well"]) for k, p in _KINDS.items()]
    return rounded(wells.outer_merge(parts, ["Metadata_Well"]), *(p + f for p in _KINDS.values() for f in ("quantity", "tax")))


@query("""SELECT upper(n_name) AS Metadata_Compound, n_regionkey AS Metadata_ConcLevel, n_nationkey AS Metadata_Well, CAST('P1' AS VARCHAR) AS Metadata_Plate, round(b, 4) AS balance
    FROM nation JOIN (SELECT c_nationkey, avg(c_acctbal) AS b FROM customer GROUP BY ALL) ON n_nationkey = c_nationkey""")
def annotate_platemap(spark, sf_dir):
    profiles = load(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("Metadata_Well")).agg(F.avg("c_acctbal").alias("balance"))
    plate = load(spark, sf_dir, "nation").select(F.col("n_name").alias("Metadata_Compound"), F.col("n_regionkey").alias("Metadata_ConcLevel"), F.col("n_nationkey").alias("Metadata_Well"), F.lit("P1").alias("Metadata_Plate"))
    return rounded(wells.annotate(profiles, wells.platemap_of(plate), ["Metadata_Well"]), "balance", digits=4)


@query(f"""WITH {SQL_OBJECTS}, ok AS (SELECT * FROM obj WHERE ImageQC_flag = 0),
    s AS (SELECT Metadata_Plate, Metadata_Timepoint, Metadata_Well, count(DISTINCT Metadata_Site) AS n FROM ok GROUP BY ALL),
    f AS (SELECT *, max(n) OVER (PARTITION BY Metadata_Plate, Metadata_Timepoint) / n::DOUBLE AS f FROM s),
    w AS (SELECT Metadata_Plate, Metadata_Timepoint, Metadata_Well, avg(line * f) AS l, avg(quantity) AS q FROM ok JOIN f USING (Metadata_Plate, Metadata_Timepoint, Metadata_Well) GROUP BY ALL)
    SELECT 'C' || (Metadata_Well % 5) AS Metadata_Compound, Metadata_Well % 3 AS Metadata_ConcLevel, Metadata_Well, CAST(Metadata_Plate AS VARCHAR) AS Metadata_Plate,
    round(l, 6) AS DNA_line, round(q, 6) AS DNA_quantity, Metadata_Timepoint FROM w""")
def well_profiles(spark, sf_dir):
    """The chain from objects to annotated wells on all plates and times, which are group keys."""
    keys = [*GROUP, "Metadata_Well"]
    image = images(spark, sf_dir).select("ImageNumber", *keys, "Metadata_Site", "ImageQC_flag")
    nuclei = qc.without_failing(measurements(spark, sf_dir).select("ImageNumber", "line", "quantity").join(image.drop("ImageQC_flag"), "ImageNumber"), image)
    scaled = wells.scale_counts(prefixed(drop_bookkeeping(nuclei, (*keys, "Metadata_Site")), "DNA_"), GROUP).drop("Metadata_Site")
    made = wells.aggregate_by(scaled, keys).withColumn("Metadata_Plate", F.col("Metadata_Plate").cast("string"))
    plates = made.select("Metadata_Plate").distinct()
    layout = spark.range(96).select(F.concat(F.lit("c"), F.col("id") % 5).alias("Metadata_Compound"), (F.col("id") % 3).alias("Metadata_ConcLevel"), F.col("id").alias("Metadata_Well")).crossJoin(plates)
    return rounded(wells.annotate(made, wells.platemap_of(layout), ["Metadata_Plate", "Metadata_Well"]), "DNA_line", "DNA_quantity")


@query(f"WITH {SQL_OBJECTS} SELECT ImageNumber, Metadata_Well, quantity, tax FROM obj")
def drop_rules(spark, sf_dir):
    obj = objects(spark, sf_dir).withColumns({"URL_x": F.lit("u"), "ExecutionTime_x": F.lit(1.0)}).withColumn("Image", F.col("ImageNumber"))
    kept = drop_bookkeeping(obj).select("Image", "Metadata_Well", "quantity", "tax")
    return kept.withColumnRenamed("Image", "ImageNumber")


# --- Normalisation and features -----------------------------------------------------------------------------------------


@query(f"WITH {SQL_OBJECTS}, {_MAD} SELECT ImageNumber, line, {', '.join(f'round({f}, 6) + 0.0 AS {f}' for f in FEATURES)} FROM scaled")
def mad_robustize_objects(spark, sf_dir):
    return rounded(normalised(spark, sf_dir).wide().select("ImageNumber", "line", *FEATURES), *FEATURES)


@query(f"""WITH {SQL_EVENTS}, m AS (SELECT Metadata_Plate, median(value) AS m FROM ev WHERE Metadata_Compound = 'view' GROUP BY ALL),
    s AS (SELECT Metadata_Plate, median(abs(value - m)) * 1.4826 AS s FROM ev JOIN m USING (Metadata_Plate) WHERE Metadata_Compound = 'view' GROUP BY ALL)
    SELECT event_id, round((value - m) / (s + 1e-18), 6) + 0.0 AS value FROM ev JOIN m USING (Metadata_Plate) JOIN s USING (Metadata_Plate)""")
def mad_robustize_events(spark, sf_dir):
    p = Profiles.of(events(spark, sf_dir), ["value"])
    return rounded(mad_robustize(p, ["Metadata_Plate"], F.col("Metadata_Compound") == "view").wide().select("event_id", "value"), "value")


@query(f"SELECT event_id, round(pow(value / 2.3538, 3) / sqrt(1 + pow(value / 2.3538, 6)), 6) + 0.0 AS sigmoid, round({_SIG.format('value')}, 6) AS magnitude FROM events")
def double_sigmoid(spark, sf_dir):
    s = scalars.double_sigmoid(F.col("value"))
    return rounded(load(spark, sf_dir, "events").select("event_id", s.alias("sigmoid"), F.abs(s).alias("magnitude")), "sigmoid", "magnitude")


_LONG = f"long AS ({' UNION ALL '.join(f'SELECT {k} AS pos, {f} AS x FROM obj' for k, f in enumerate(FEATURES))})"


def _profiles(spark, sf_dir) -> Profiles:
    return Profiles.of(objects(spark, sf_dir).select("ImageNumber", *FEATURES), FEATURES)


@query(f"""WITH {SQL_OBJECTS}, {_LONG}, c AS (SELECT pos, x, count(*) AS n FROM long GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY pos ORDER BY n DESC, x) AS p FROM c)
    SELECT pos, count(*) AS n_values, max(CASE WHEN p = 1 THEN n END) AS "first", max(CASE WHEN p = 2 THEN n END) AS "second" FROM r GROUP BY pos""")
def fs_variance(spark, sf_dir):
    return selection.value_frequencies(_profiles(spark, sf_dir))


@query(f"WITH {SQL_OBJECTS}, {_LONG} SELECT pos, round(avg(CASE WHEN x IS NULL THEN 1.0 ELSE 0.0 END), 6) AS share FROM (SELECT pos, nullif(x, 0.05) AS x FROM long) GROUP BY pos")
def fs_na(spark, sf_dir):
    p = _profiles(spark, sf_dir).mapped(lambda x: F.nullif(x, F.lit(0.05)))
    return rounded(selection.missing_share(p), "share")


@query(f"WITH {SQL_OBJECTS} SELECT * FROM ({' UNION ALL '.join(f'SELECT {i} AS i, {j} AS j, round(corr({a}, {b}), 6) + 0.0 AS r FROM obj' for i, a in enumerate(FEATURES) for j, b in enumerate(FEATURES) if i < j)})")
def fs_correlation(spark, sf_dir):
    r = selection.correlation_rows(_profiles(spark, sf_dir)).select("i", F.posexplode("r").alias("j", "r")).filter("i < j")
    return rounded(r, "r")


@query(f"WITH {SQL_OBJECTS}, {_LONG} SELECT pos, min(x) AS low, max(x) AS high FROM long GROUP BY pos")
def fs_outlier(spark, sf_dir):
    return selection.extremes(_profiles(spark, sf_dir))


@query(f"""WITH {SQL_OBJECTS}, {_LONG}, c AS (SELECT pos, x, count(*) AS n FROM long WHERE x IS NOT NULL GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY pos ORDER BY n DESC, x) AS p FROM c),
    varied AS (SELECT pos FROM r GROUP BY pos HAVING count(*) > 1 AND max(CASE WHEN p = 2 THEN n END) / max(CASE WHEN p = 1 THEN n END)::DOUBLE >= 0.05),
    known AS (SELECT pos FROM long GROUP BY pos HAVING avg(CASE WHEN x IS NULL THEN 1.0 ELSE 0.0 END) <= 0.05),
    k AS (SELECT * FROM ({' UNION ALL '.join(f'SELECT {i} AS i, {j} AS j, corr({a}, {b}) AS r FROM obj' for i, a in enumerate(FEATURES) for j, b in enumerate(FEATURES) if i != j)})
        WHERE i IN (FROM varied) AND i IN (FROM known) AND j IN (FROM varied) AND j IN (FROM known)),
    load AS (SELECT i, sum(abs(r)) AS s FROM k GROUP BY i),
    twins AS (SELECT CASE WHEN a.s >= b.s THEN k.i ELSE k.j END AS pos FROM k JOIN load a ON a.i = k.i JOIN load b ON b.i = k.j WHERE k.r > 0.9 AND k.i > k.j),
    calm AS (SELECT pos FROM long GROUP BY pos HAVING max(abs(x)) <= 500)
    SELECT [{', '.join(f"'{f}'" for f in FEATURES)}][pos + 1] AS feature FROM varied
    WHERE pos IN (FROM known) AND pos IN (FROM calm) AND pos NOT IN (FROM twins)""")
def fs_all(spark, sf_dir):
    """Names that survive all rules: prices exceed the outlier cutoff."""
    options = {"variance_threshold": {"unique_cut": 0.0}, "drop_outliers": {"cutoff": 500.0}}
    kept = selection.feature_select(_profiles(spark, sf_dir), ["variance_threshold", "drop_na_columns", "correlation_threshold", "drop_outliers"], options)
    return spark.createDataFrame([(n,) for n in kept.names], "feature string")


@query("""SELECT o_orderkey AS id, o_totalprice, NULL::DOUBLE AS c_acctbal, 0.0 AS filled FROM orders
    UNION ALL SELECT c_custkey, NULL, c_acctbal, c_acctbal FROM customer""")
def union_by_name_fill(spark, sf_dir):
    a = load(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), "o_totalprice")
    b = load(spark, sf_dir, "customer").select("c_acctbal", F.col("c_custkey").alias("id"))
    return selection.unite([a, b]).withColumn("filled", F.coalesce("c_acctbal", F.lit(0.0)))


@query("SELECT r_regionkey AS k, r_name AS name FROM region UNION ALL SELECT n_nationkey, n_name FROM nation")
def append_positional(spark, sf_dir):
    a = load(spark, sf_dir, "region").select(F.col("r_regionkey").alias("k"), F.col("r_name").alias("name"))
    return append([a, load(spark, sf_dir, "nation").select("n_nationkey", "n_name")], strict_position=True)


@query("SELECT event_id, CASE WHEN event_type IN ('view', 'click') THEN NULL ELSE event_type END AS event_type FROM events")
def null_tokens(spark, sf_dir):
    df = load(spark, sf_dir, "events").select("event_id", "event_type")
    return nulls_for_tokens(df, ["view", "click"])


# --- Similarity ---------------------------------------------------------------------------------------------------------

_PAIRS = """e AS (SELECT label, vec_id, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS i, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
    p AS (SELECT a.label, a.i, b.i AS j, list_cosine_similarity(a.v, b.v) AS c FROM e a JOIN e b ON a.label = b.label AND a.i < b.i)"""


@query(f"WITH {_PAIRS} SELECT label, round(avg(c), 6) AS average_cosine_similarity FROM p GROUP BY label")
def cosine_avg(spark, sf_dir):
    df = similarity.average_cosine(load(spark, sf_dir, "embeddings"), ["label"], "embedding")
    return rounded(df, "average_cosine_similarity").drop("n")


@query(f"WITH {_PAIRS} SELECT label, count(*) AS n_pairs, round(min(c), 6) AS low, round(max(c), 6) AS high, round(sum(c), 4) AS total FROM p GROUP BY label")
def cosine_pairs(spark, sf_dir):
    made = similarity.replicate_cosine_summary(load(spark, sf_dir, "embeddings"), ["label"], "embedding", "vec_id")
    return rounded(rounded(made, "low", "high"), "total", digits=4)


# --- Cells --------------------------------------------------------------------------------------------------------------

_SITE = f"""WITH {SQL_CELLS}, el AS (SELECT site, Metadata_Well, is_dead, unnest(embedding) AS v, unnest(range(len(embedding))) AS pos FROM cells)"""


@query(f"{_SITE} SELECT site, pos, round(sum(v::DOUBLE), 5) + 0.0 AS total FROM el WHERE NOT is_dead GROUP BY ALL")
def site_sum(spark, sf_dir):
    made = C.site_sums(cells(spark, sf_dir), ["site"]).select("site", F.posexplode("total").alias("pos", "total"))
    return rounded(made.withColumn("pos", F.col("pos").cast("long")), "total", digits=5)


@query(f"WITH {SQL_CELLS} SELECT site, count(*) AS Cell_Count, count(*) FILTER (WHERE is_dead) AS Dead_Cells FROM cells GROUP BY ALL")
def dead_counts(spark, sf_dir):
    return C.site_sums(cells(spark, sf_dir), ["site"]).select("site", "Cell_Count", "Dead_Cells")


@query(f"""{_SITE}, n AS (SELECT Metadata_Well, count(*) AS n FROM cells WHERE NOT is_dead GROUP BY ALL)
    SELECT Metadata_Well, any_value(n) AS Cell_Count, pos, round(sum(v::DOUBLE) / any_value(n), 6) + 0.0 AS mean FROM el JOIN n USING (Metadata_Well) WHERE NOT is_dead GROUP BY Metadata_Well, pos""")
def well_embedding_mean(spark, sf_dir):
    sites = C.site_sums(cells(spark, sf_dir), ["Metadata_Well", "site"]).withColumn("Metadata_Timepoint", F.lit("6h"))
    made = C.well_means(sites, ["Metadata_Well"], "site", ("Metadata_Timepoint",))
    made = made.select("Metadata_Well", "Cell_Count", F.posexplode("mean_features").alias("pos", "mean"))
    return rounded(made.withColumn("pos", F.col("pos").cast("long")), "mean")


_CELL = f"""WITH {SQL_CELLS}, c AS (SELECT Metadata_Well, site, vec_id, embedding, row_number() OVER (PARTITION BY Metadata_Well, site ORDER BY vec_id) - 1 AS i FROM cells)"""


def _site_cells(spark, sf_dir) -> DataFrame:
    rows = cells(spark, sf_dir).groupBy("Metadata_Well", "site").agg(F.sort_array(F.collect_list(F.struct("vec_id", "embedding"))).alias("cells"))
    return C.single_cells(rows).select("Metadata_Well", "site", F.col("Cell_Index").cast("long").alias("Cell_Index"), "single_cell_features.vec_id", "single_cell_features.embedding")


@query(f"""{_CELL} SELECT Metadata_Well || '_' || site || '_cell' || i AS Cell_ID, CAST(vec_id * 37 % 1080 AS INTEGER) AS Y_Center, CAST(vec_id * 91 % 1080 AS INTEGER) AS X_Center
    FROM c WHERE vec_id * 37 % 1080 BETWEEN 100 AND 980 AND vec_id * 91 % 1080 BETWEEN 100 AND 980""")
def cell_coords(spark, sf_dir):
    made = _site_cells(spark, sf_dir).select(C.cell_id(F.col("Metadata_Well"), F.col("site"), F.col("Cell_Index")).alias("Cell_ID"), (F.col("vec_id") * 37 % 1080).cast("int").alias("Y_Center"), (F.col("vec_id") * 91 % 1080).cast("int").alias("X_Center"))
    return made.filter(C.inside(F.col("Y_Center"), F.col("X_Center"), F.lit(1080), F.lit(1080)))


@query(f"{_CELL} SELECT Metadata_Well, site, i AS Cell_Index, vec_id, round(list_sum(CAST(embedding AS DOUBLE[])), 4) + 0.0 AS total FROM c")
def single_cell_explode(spark, sf_dir):
    made = _site_cells(spark, sf_dir)
    total = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double"))
    return rounded(made.select("Metadata_Well", "site", "Cell_Index", "vec_id", total.alias("total")), "total", digits=4)


@query("""WITH m AS (SELECT l_suppkey % 50 AS image, l_partkey % 7 AS label, l_linenumber AS y, CAST(l_quantity AS INTEGER) AS x FROM lineitem)
    SELECT image, label, CAST(floor(avg(y)) AS INTEGER) AS Y_Center, CAST(floor(avg(x)) AS INTEGER) AS X_Center FROM m WHERE label <> 0 GROUP BY ALL""")
def mask_centroids(spark, sf_dir):
    m = load(spark, sf_dir, "lineitem").select((F.col("l_suppkey") % 50).alias("image"), (F.col("l_partkey") % 7).alias("label"), F.col("l_linenumber").alias("y"), F.col("l_quantity").cast("int").alias("x"))
    return C.mask_centroids(m, ["image"])


@query()
def cell_model_interface(spark, sf_dir):
    """Sites through stand-in models: quadrants of a synthetic stack as cells, channel means as embedding."""
    sites = load(spark, sf_dir, "embeddings").select("vec_id", "embedding")

    def stack(site: dict) -> np.ndarray:
        side = np.resize(np.asarray(site["embedding"], float), (16, 16))
        return np.stack([np.kron(side, np.ones((32, 32)))] * 2, axis=-1)

    def models():
        def segment(s: np.ndarray) -> np.ndarray:
            mask = np.zeros(s.shape[:2], int)
            mask[120:240, 120:240], mask[280:400, 280:400] = 1, 2
            return mask

        return segment, lambda batch: batch.reshape(len(batch), -1, 2).mean(1)[..., None], lambda flat: flat[:, 0] / 255.0

    return C.process_sites(sites, "vec_id", stack, models, channels=2).drop("error")


# --- Images -------------------------------------------------------------------------------------------------------------

_PLANES = """r AS (SELECT event_id, value, user_id % 4 AS PlateID, row_number() OVER (PARTITION BY user_id % 4 ORDER BY event_id) - 1 AS r FROM events),
    g AS (SELECT *, r // 6 AS chunk, r % 6 % 2 AS channel, r % 6 // 2 AS plane, count(*) OVER (PARTITION BY PlateID, r // 6) AS n FROM r)"""


def _planes(spark, sf_dir) -> DataFrame:
    e = load(spark, sf_dir, "events").select("event_id", "value", (F.col("user_id") % 4).alias("PlateID"))
    return I.plane_groups(e, 2, 3, ["event_id"])


@query(f"WITH {_PLANES} SELECT event_id, value, PlateID, chunk, channel, plane FROM g WHERE n = 6")
def max_projection_groups(spark, sf_dir):
    return _planes(spark, sf_dir)


@query("SELECT label, pos, max(v) AS value FROM (SELECT label, unnest(embedding) AS v, unnest(range(len(embedding))) AS pos FROM embeddings) GROUP BY ALL")
def max_projection(spark, sf_dir):
    e = load(spark, sf_dir, "embeddings").select("label", F.col("embedding").alias("pixels"))
    return I.max_projection(e, ["label"]).select("label", F.posexplode("pixels").alias("pos", "value")).withColumn("pos", F.col("pos").cast("long"))


@query("SELECT vec_id, round(100.0 * len(list_filter(embedding, lambda x: x = list_max(embedding))) / len(embedding), 6) AS percent FROM embeddings")
def percent_maximal(spark, sf_dir):
    e = load(spark, sf_dir, "embeddings")
    return rounded(e.select("vec_id", I.percent_maximal_column(F.col("embedding")).alias("percent")), "percent")


@query("""WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings), m AS (SELECT vec_id, v, list_min(v) AS lo, list_max(v) AS hi FROM e)
    SELECT vec_id, CAST(list_sum(list_transform(v, lambda x: CAST(floor(255 * (x - lo) / (hi - lo)) AS BIGINT))) AS BIGINT) AS total FROM m""")
def scale_8bit(spark, sf_dir):
    e = load(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    return e.select("vec_id", F.aggregate(scalars.scale_8bit(F.col("v")), F.lit(0).cast("long"), lambda a, x: a + x).alias("total"))


@query("""WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)
    SELECT vec_id, round(list_sum(list_transform(range(1, len(v) + 1), lambda i: v[i] / (1.0 + i))), 5) + 0.0 AS total FROM e""")
def illumination_divide(spark, sf_dir):
    v = F.col("embedding").cast("array<double>")
    light = F.transform(F.sequence(F.lit(1), F.size(v)), lambda i: 1.0 + i)
    made = load(spark, sf_dir, "embeddings").select("vec_id", F.aggregate(scalars.divide_illumination(v, light), F.lit(0.0), lambda a, x: a + x).alias("total"))
    return rounded(made, "total", digits=5)


@query("""WITH l AS (SELECT vec_id, unnest(CAST(embedding AS DOUBLE[])) AS x FROM embeddings), m AS (SELECT vec_id, x, avg(x) OVER (PARTITION BY vec_id) AS m FROM l)
    SELECT vec_id, round(avg(x), 6) + 0.0 AS mean, round(median(abs(x - m)), 6) AS spread, round(max(x) - min(x), 6) AS extent FROM m GROUP BY vec_id""")
def pixel_statistics(spark, sf_dir):
    e = load(spark, sf_dir, "embeddings").select("vec_id", I.pixel_statistics(F.col("embedding").cast("array<double>")).alias("s"))
    return rounded(e.select("vec_id", "s.mean", "s.spread", "s.extent"), "mean", "spread", "extent")


def _numbered_vectors(e: DataFrame) -> DataFrame:
    """e with r, the number of a vector in its label from 0 by vec_id. Ranges of identifiers are numbered apart, so a label needs no one task."""
    cuts = e.stat.approxQuantile("vec_id", [k / 64 for k in range(1, 64)], 0.002)
    rows = e.filter("label IS NOT NULL").withColumn("part", F.size(F.filter(F.array(*map(F.lit, cuts)).cast("array<double>"), lambda c: c < F.col("vec_id"))))
    counts = rows.groupBy("label", "part").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(H.Window.partitionBy("label").orderBy("part").rowsBetween(H.Window.unboundedPreceding, -1)), F.lit(0))
    counts = counts.select("label", "part", before.alias("before"))  # at most 64 rows a label
    return H.numbered_rows(rows, ["label", "part"], ["vec_id"]).join(counts, ["label", "part"]).withColumn("r", F.col("r") + F.col("before")).drop("part", "before")


@query()
def radial_power_slope(spark, sf_dir):
    """Slope and saturation of 40 x 40 pictures, each of 25 consecutive vectors of one label; the last one of a label ends in zeros."""
    import io

    import pandas as pd

    def picture(key, pdf):
        x = np.concatenate([np.asarray(v, float) for v in pdf.sort_values("r")["embedding"]])
        whole = np.zeros(1600)
        whole[: len(x)] = x  # longer ones are an error
        buffer = io.BytesIO()
        np.save(buffer, whole.reshape(40, 40))
        return pd.DataFrame({"name": [f"{key[0]}/{key[1]}"], "channel": ["DNA"], "content": [buffer.getvalue()]})

    ranked = _numbered_vectors(load(spark, sf_dir, "embeddings")).withColumn("picture", F.floor(F.col("r") / 25))
    pictures = ranked.groupBy("label", "picture").applyInPandas(picture, "name string, channel string, content binary")
    name = F.split("name", "/")
    made = I.image_quality(pictures, "name").select(name[0].cast("int").alias("label"), name[1].cast("long").alias("picture"), "channel", "slope", "percent")
    return rounded(made, "slope", "percent")


# The sum of a resampled picture is linear in its pixels: each counts by the weights of its row and of its column, summed over the new ones.
@query("""WITH t AS (SELECT o, p, (p + 0.5 - (o + 0.5) * 1.6::DOUBLE) / 1.6::DOUBLE AS t FROM range(5) a(o), range(8) b(p)),
    w AS (SELECT o, p, CASE WHEN abs(t) >= 3 THEN 0 WHEN abs(t) < 1e-12 THEN 1 ELSE sin(pi() * t) / (pi() * t) * sin(pi() * t / 3) / (pi() * t / 3) END AS w FROM t),
    c AS (SELECT p, sum(w / s) AS c FROM (SELECT *, sum(w) OVER (PARTITION BY o) AS s FROM w) GROUP BY p),
    e AS (SELECT vec_id, unnest(CAST(embedding AS DOUBLE[])) AS x, unnest(range(len(embedding))) AS pos FROM embeddings)
    SELECT vec_id, round(sum(x * a.c * b.c), 4) + 0.0 AS total FROM e JOIN c a ON a.p = pos // 8 JOIN c b ON b.p = pos % 8 GROUP BY vec_id""")
def resized_images(spark, sf_dir):
    """Vectors as 8 x 8 pictures, resampled to 5 x 5."""
    from collections.abc import Iterator

    import pandas as pd

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            small = [I.resize(np.asarray(v, np.float64).reshape(8, 8), 5) for v in pdf["embedding"]]
            yield pd.DataFrame({"vec_id": pdf["vec_id"], "total": [float(x.sum()) for x in small]})

    return rounded(load(spark, sf_dir, "embeddings").select("vec_id", "embedding").mapInPandas(run, "vec_id long, total double"), "total", digits=4)


# --- Names, paths and jobs ----------------------------------------------------------------------------------------------


@query("""SELECT page_id, list_aggregate(list_transform(string_split('a/Images/' || url, '/'), lambda p, i: CASE WHEN i = list_position(string_split('a/Images/' || url, '/'), 'Images') THEN 'ImagesStacked' ELSE p END), 'string_agg', '/') AS stacked,
    replace('Image/' || url || '/Image_1', 'Image', 'Image_binned') AS binned, ltrim('binned/' || page_id, 'binned/') AS stripped,
    split_part(rtrim(url, '/'), '/', -1) AS last_part, translate(url, ' /', '__') AS label FROM pages""")
def path_rewrites(spark, sf_dir):
    url = F.col("url")
    return load(spark, sf_dir, "pages").select(
        "page_id",
        scalars.stacked_path(F.concat(F.lit("a/Images/"), url)).alias("stacked"),
        scalars.binned_key(F.concat(F.lit("Image/"), url, F.lit("/Image_1"))).alias("binned"),
        scalars.strip_leading(F.concat(F.lit("binned/"), F.col("page_id")), "binned/").alias("stripped"),
        scalars.last_segment(url).alias("last_part"),
        scalars.file_label(url).alias("label"),
    )


@query("""SELECT p_partkey, chr(CAST(65 + (p_partkey % 384) // 24 AS INTEGER)) || lpad(CAST((p_partkey % 384) % 24 + 1 AS VARCHAR), 2, '0') AS by_position,
    chr(CAST(65 + p_size % 16 AS INTEGER)) || lpad(CAST(p_partkey % 24 + 1 AS VARCHAR), 2, '0') AS by_row FROM part""")
def well_names(spark, sf_dir):
    key = F.col("p_partkey")
    return load(spark, sf_dir, "part").select("p_partkey", scalars.well_of_position(key % 384 + 1).alias("by_position"), scalars.well_of(F.col("p_size") % 16 + 1, key % 24 + 1).alias("by_row"))


@query("SELECT c_custkey, c_name, TRY_CAST(nullif(regexp_extract(c_name || c_mktsegment, '([0-9]+)', 1), '') AS BIGINT) AS key FROM customer")
def natural_sort_key(spark, sf_dir):
    return load(spark, sf_dir, "customer").select("c_custkey", "c_name", scalars.natural_key(F.concat("c_name", "c_mktsegment")).alias("key"))


@query("""WITH j AS (SELECT n_name AS plate, r_name AS time, row_number() OVER (ORDER BY n_name, r_name) - 1 AS r FROM nation, region)
    SELECT plate, time, r // 10 AS batch, CASE WHEN count(*) OVER (PARTITION BY r // 10) < 5 THEN 'small' ELSE 'large' END AS instance FROM j""")
def job_grid_batches(spark, sf_dir):
    plates, times = load(spark, sf_dir, "nation").select(F.col("n_name").alias("plate")), load(spark, sf_dir, "region").select(F.col("r_name").alias("time"))
    return jobs.job_batches(plates.select("plate"), times.select("time"))


@query("""WITH f AS (SELECT DISTINCT 's3/' || c_nationkey || 'h_' || r_regionkey || '/' || c_mktsegment AS folder FROM customer, region)
    SELECT CAST(r_regionkey AS VARCHAR) AS plate, CAST(n_nationkey AS VARCHAR) AS time, min(folder) AS folder
    FROM region, nation JOIN f ON contains(folder, n_nationkey || 'h_' || r_regionkey) GROUP BY ALL""")
def job_first_folder(spark, sf_dir):
    """The first folder, by name, that holds time, "h_" and plate, for jobs that have one."""
    nation, region = load(spark, sf_dir, "nation"), load(spark, sf_dir, "region")
    made = load(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select("n_nationkey", "c_mktsegment").distinct()
    made = made.join(region.select("r_regionkey"), how="cross").select(F.concat(F.lit("s3/"), F.col("n_nationkey").cast("string"), F.lit("h_"), F.col("r_regionkey").cast("string"), F.lit("/"), F.col("c_mktsegment")).alias("folder"))
    grid = region.select(F.col("r_regionkey").cast("string").alias("plate")).join(nation.select(F.col("n_nationkey").cast("string").alias("time")), how="cross")
    return jobs.first_folders(grid, made)


@query("""WITH p AS (SELECT string_split(url, '/') AS s FROM pages), a AS (SELECT s, list_position(list_transform(s, lambda x: contains(x, 'example')), true) AS k FROM p)
    SELECT DISTINCT array_to_string(s[1:k], '/') AS url FROM a WHERE k > 0""")
def main_folder_list(spark, sf_dir):
    return main_folders(load(spark, sf_dir, "pages").select("url"), ["example"], "url")


# --- Columns by name, files and back ------------------------------------------------------------------------------------


@query("SELECT c_custkey, c_acctbal, c_mktsegment AS Metadata_Compound FROM customer")
def text_features_dropped(spark, sf_dir):
    return drop_text_features(load(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal", F.col("c_mktsegment").alias("Metadata_Compound")))


@query("SELECT event_id, value FROM events")
def stale_qc_dropped(spark, sf_dir):
    return drop_stale_qc(load(spark, sf_dir, "events").select("event_id", "value", F.col("value").alias("ImageQuality_Slope_DNA"), F.col("event_type").alias("QC_Error_DNA")))


@query("SELECT o_orderkey AS Image_key, o_totalprice AS Image_total, CAST(year(o_orderdate) AS VARCHAR) AS Metadata_Timepoint FROM orders")
def image_prefix(spark, sf_dir):
    return prefixed(load(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("key"), F.col("o_totalprice").alias("total"), F.year("o_orderdate").cast("string").alias("Metadata_Timepoint")), "Image_")


@query("SELECT p_partkey, p_retailprice AS holding, p_retailprice + p_size AS starting FROM part")
def feature_columns(spark, sf_dir):
    """Sums over the features by either rule: a name that holds Metadata further on is a feature to one of them only."""
    part = load(spark, sf_dir, "part").select(F.col("p_partkey").alias("Metadata_key"), F.col("p_retailprice").alias("price"), F.col("p_size").alias("Own_Metadata_size"))
    total = lambda names: sum((F.col(c) for c in names), F.lit(0.0))
    return part.select(F.col("Metadata_key").alias("p_partkey"), total(features_without(part)).alias("holding"), total(features_not_starting(part)).alias("starting"))


@query(f"WITH {SQL_IMAGES} SELECT DISTINCT Metadata_Plate, Metadata_Timepoint, Metadata_Compound FROM images")
def distinct_groups(spark, sf_dir):
    return images(spark, sf_dir).select(*GROUP, "Metadata_Compound").distinct()


@query("""SELECT page_id, 'base/' || url AS below, url AS alone, '/abs' AS absolute, 'slash/' || url AS slash FROM pages""")
def path_joined(spark, sf_dir):
    url = F.col("url")
    return load(spark, sf_dir, "pages").select(
        "page_id",
        scalars.path_join(F.lit("base"), url).alias("below"),
        scalars.path_join(F.lit(""), url).alias("alone"),
        scalars.path_join(url, F.lit("/abs")).alias("absolute"),
        scalars.path_join(F.lit("slash/"), url).alias("slash"),
    )


@query("SELECT n_nationkey, upper(n_name[1]) || lower(n_name[2:]) AS name FROM nation")
def capitalised_names(spark, sf_dir):
    return load(spark, sf_dir, "nation").select("n_nationkey", scalars.capitalised(F.col("n_name")).alias("name"))


@query("SELECT event_id, value FROM events WHERE NOT (value > 0.5)")
def living_cells(spark, sf_dir):
    return load(spark, sf_dir, "events").filter(~C.dead(F.col("value"))).select("event_id", "value")


@query(f"WITH {SQL_OBJECTS} SELECT kind, Metadata_Well, Metadata_Site, count(*) AS n FROM obj GROUP BY ALL")
def metadata_by_nuclei(spark, sf_dir):
    """Three object tables, of which the nuclei lack the site, so that all three get their image's metadata."""
    objects_ = measurements(spark, sf_dir).select("ImageNumber", "kind")
    tables = {"Image": images(spark, sf_dir)} | {n: objects_.filter(F.col("kind") == k) for n, k in (("Nuclei", "A"), ("Cells", "N"), ("Cytoplasm", "R"))}
    met = qc.tables_with_metadata(tables, ("Metadata_Well", "Metadata_Site"))
    return selection.unite([met[n] for n in ("Nuclei", "Cells", "Cytoplasm")]).groupBy("kind", "Metadata_Well", "Metadata_Site").agg(F.count("*").alias("n"))


@query("SELECT s_suppkey, s_name, round(s_acctbal, 2) AS s_acctbal, CAST('csv' AS VARCHAR) AS folder FROM supplier")
def csv_round_trip(spark, sf_dir):
    """Suppliers written as CSV and read again, types inferred, with a column made of the file's path."""
    path = scratch(spark, "csv_round_trip/csv")
    write_csv(load(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_acctbal"), path)
    parts = [t for t, _ in read_csvs(spark, [path], {"folder": F.element_at(F.split("_file", "/"), -2)})]
    return rounded(selection.unite(parts), "s_acctbal", digits=2)


@query("SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders")
def parquet_round_trip(spark, sf_dir):
    """Orders written as Parquet in a folder for each status, in row groups of 5,000, and read again."""
    path = scratch(spark, "parquet_round_trip")
    write_parquet(load(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus"), path, rows=5000, by=("o_orderstatus",))
    return spark.read.parquet(path)


@query("SELECT vec_id, round(list_sum(list_transform(embedding, lambda x: x::DOUBLE)), 4) + 0.0 AS total, 8 AS height, CAST(len(embedding) / 8 AS INTEGER) AS width FROM embeddings")
def image_round_trip(spark, sf_dir):
    """Vectors as pictures of eight rows, from .npy files to TIFF, and read again."""
    import io

    import pandas as pd

    def packed(parts):
        for pdf in parts:
            out = []
            for v in pdf["embedding"]:
                f = io.BytesIO()
                np.save(f, np.asarray(v, np.float32).reshape(8, -1))
                out.append(f.getvalue())
            yield pd.DataFrame({"path": pdf["vec_id"].astype(str), "content": out})

    def opened(parts):
        for pdf in parts:
            pictures = [decode(bytes(x)) for x in pdf["content"]]
            yield pd.DataFrame({"vec_id": pdf["path"].astype("int64"), "total": [float(p.sum(dtype=float)) for p in pictures], "height": [p.shape[0] for p in pictures], "width": [p.shape[1] for p in pictures]})

    files = load(spark, sf_dir, "embeddings").select("vec_id", "embedding").mapInPandas(packed, "path string, content binary")
    return rounded(map_images(files, lambda x: x).mapInPandas(opened, "vec_id long, total double, height int, width int"), "total", digits=4)
