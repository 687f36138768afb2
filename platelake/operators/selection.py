"""Feature selection: each rule reads one small table of statistics and returns the names that survive it."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from platelake.operators.profiles import Profiles


#: A group of rows, by the values of its keys, and positions of features.
Chosen = dict[tuple, set[int]]


def _by_group(rows: DataFrame, by: tuple[str, ...]) -> Chosen:
    """The positions (pos) in rows of each group. A row a group and feature reaches the driver."""
    found: Chosen = {}
    for r in rows.select(*by, "pos").collect():
        found.setdefault(tuple(r[:-1]), set()).add(r["pos"])
    return found


def _names_without(profiles: Profiles, gone: Chosen) -> list[str]:
    return [n for k, n in enumerate(profiles.names) if k not in gone.get((), set())]


def value_frequencies(profiles: Profiles, by: tuple[str, ...] = ()) -> DataFrame:
    """by, pos, n_values, first and second: how often the two commonest values occur. Values are counted and compared by partial aggregates."""
    at = [*by, "pos"]
    counts = profiles.long(*by).filter("x IS NOT NULL").groupBy(*at, "x").agg(F.count("*").alias("n"))
    top = counts.groupBy(*at).agg(F.count("*").alias("n_values"), F.max(F.struct("n", "x")).alias("top"))
    rest = counts.join(top.select(*at, "top"), at).filter(F.col("x") != F.col("top.x")).groupBy(*at).agg(F.max("n").alias("second"))
    return top.join(rest, at, "left").select(*at, "n_values", F.col("top.n").alias("first"), "second")


def _invariant(profiles: Profiles, by: tuple[str, ...], alive: Chosen, freq_cut: float = 0.05, unique_cut: float = 0.01) -> Chosen:
    rows = profiles.df.groupBy(*by).agg(F.count("*").alias("rows"))
    found = value_frequencies(profiles, by)
    met = found.join(rows, list(by)) if by else found.crossJoin(rows)  # one row
    kept = _by_group(met.filter((F.col("n_values") > 1) & (F.col("second") / F.col("first") >= freq_cut) & (F.col("n_values") / F.col("rows") >= unique_cut)), by)
    return {g: known - kept.get(g, set()) for g, known in alive.items()}


def variance_threshold(profiles: Profiles, freq_cut: float = 0.05, unique_cut: float = 0.01) -> list[str]:
    """Without features of one value, of a second value rarer than freq_cut of the first, or of too few values for the rows."""
    return _names_without(profiles, _invariant(profiles, (), _all(profiles), freq_cut, unique_cut))


def missing_share(profiles: Profiles, by: tuple[str, ...] = ()) -> DataFrame:
    """by, pos and share of missing values."""
    return profiles.long(*by).groupBy(*by, "pos").agg(F.avg(F.col("x").isNull().cast("double")).alias("share"))


def _sparse(profiles: Profiles, by: tuple[str, ...], alive: Chosen, cutoff: float = 0.05) -> Chosen:
    return _by_group(missing_share(profiles, by).filter(F.col("share") > cutoff), by)


def drop_na_columns(profiles: Profiles, cutoff: float = 0.05) -> list[str]:
    """Features whose share of missing values is at most cutoff."""
    return _names_without(profiles, _sparse(profiles, (), {}, cutoff))


def extremes(profiles: Profiles, by: tuple[str, ...] = ()) -> DataFrame:
    """by, pos, low, high."""
    return profiles.long(*by).groupBy(*by, "pos").agg(F.min("x").alias("low"), F.max("x").alias("high"))


def _outlying(profiles: Profiles, by: tuple[str, ...], alive: Chosen, cutoff: float = 500.0) -> Chosen:
    return _by_group(extremes(profiles, by).filter((F.abs("high") > cutoff) | (F.abs("low") > cutoff)), by)


def drop_outliers(profiles: Profiles, cutoff: float = 500.0) -> list[str]:
    """Features all of whose values lie within cutoff of zero."""
    return _names_without(profiles, _outlying(profiles, (), {}, cutoff))


def correlation_rows(profiles: Profiles, lanes: int = 32, by: tuple[str, ...] = ()) -> DataFrame:
    """by, i and r: for each feature the Pearson correlations with all features, over a group's rows that hold both; NaN where one is constant.

    Partitions send their sums of products, a packed row for each feature, one group after another; these are added in lanes and then
    by feature. Neither products nor correlations become rows or reach the driver."""
    n, keys = len(profiles.names), list(by)
    center = {}  # a number a group and feature
    for r in profiles.long(*by).groupBy(*by, "pos").agg(F.avg("x").alias("m")).collect():
        center.setdefault(tuple(r[:-2]), np.zeros(n))[r["pos"]] = r["m"] or 0.0

    def packed(group: tuple, total: np.ndarray) -> Iterator[pd.DataFrame]:
        for a in range(0, n, 64):
            rows = range(a, min(n, a + 64))
            yield pd.DataFrame({**{k: [g] * len(rows) for k, g in zip(keys, group)}, "i": rows, "sums": [total[:, i].tobytes() for i in rows]})

    def sums(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, total = None, np.zeros((6, n, n))
        for pdf in parts:
            for group, some in pdf.groupby(keys, sort=False) if keys else [((), pdf)]:
                if now is not None and group != now:  # rows come sorted by group
                    yield from packed(now, total)
                    total[:] = 0
                now = group
                x = np.array([np.asarray(row, float) for row in some["features"]]).reshape(-1, n) - center[group]  # a null is NaN here
                ok = ~np.isnan(x)
                z, m = np.where(ok, x, 0), ok.astype(float)
                for k, (a, b) in enumerate(((m, m), (z, m), (m, z), (z * z, m), (m, z * z), (z, z))):
                    total[k] += a.T @ b
        if now is not None:
            yield from packed(now, total)

    def added(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(6 * n)
        for x in pdf["sums"]:
            total += np.frombuffer(x)
        return pd.DataFrame({**{k: [g] for k, g in zip([*keys, "i"], key)}, "sums": [total.tobytes()]})

    def correlated(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            rows = []
            for x in pdf["sums"]:
                c, sx, sy, sxx, syy, sxy = np.frombuffer(x).reshape(6, n)
                with np.errstate(all="ignore"):
                    cov, vx, vy = sxy - sx * sy / c, sxx - sx * sx / c, syy - sy * sy / c
                    rows.append(np.where((vx > 1e-12 * np.maximum(sxx, 1e-300)) & (vy > 1e-12 * np.maximum(syy, 1e-300)), cov / np.sqrt(vx * vy), np.nan))
            yield pd.DataFrame({**{k: pdf[k] for k in keys}, "i": pdf["i"], "r": rows})

    kinds = dict(profiles.df.dtypes)
    head = "".join(f"`{k}` {kinds[k]}, " for k in keys)
    held = profiles.df.select(*by, "features").dropna(subset=keys).sortWithinPartitions(*by) if by else profiles.df.select("features")
    partial = held.mapInPandas(sums, head + "i int, sums binary").withColumn("lane", F.pmod(F.spark_partition_id(), F.lit(lanes)))
    once = partial.groupBy(*by, "i", "lane").applyInPandas(lambda key, pdf: added(key[:-1], pdf), head + "i int, sums binary")
    return once.groupBy(*by, "i").applyInPandas(added, head + "i int, sums binary").mapInPandas(correlated, head + "i int, r array<double>")


def correlation_matrix(profiles: Profiles) -> np.ndarray:
    """The correlations of all pairs of features as one matrix, for a caller who wants it whole."""
    r = np.full((len(profiles.names),) * 2, np.nan)
    for row in correlation_rows(profiles).toLocalIterator():
        r[row["i"]] = [np.nan if x is None else x for x in row["r"]]
    return r


def _all(profiles: Profiles) -> Chosen:
    return {(): set(range(len(profiles.names)))}


def _correlated(profiles: Profiles, by: tuple[str, ...], alive: Chosen, threshold: float = 0.9) -> Chosen:
    """Positions that go by correlation_threshold in each group, among those alive there.

    Rows of correlations are judged where they are; a number a group and feature reaches the driver twice, its load and whether it goes."""
    n, keys = len(profiles.names), list(by)
    head = "".join(f"`{k}` {dict(profiles.df.dtypes)[k]}, " for k in keys)
    masks = {g: np.isin(np.arange(n), list(known)) for g, known in alive.items()}
    rows = correlation_rows(profiles, by=by).persist()

    def each(pdf: pd.DataFrame) -> Iterator[tuple[tuple, int, np.ndarray]]:
        for *group, i, r in pdf[[*keys, "i", "r"]].itertuples(index=False, name=None):
            if masks[tuple(group)][i]:
                yield tuple(group), i, np.where(masks[tuple(group)], np.asarray(r, float), np.nan)

    def loads(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            yield pd.DataFrame([(*g, i, float(np.nansum(np.abs(r)))) for g, i, r in each(pdf)], columns=[*keys, "i", "load"])

    try:
        load = {g: np.zeros(n) for g in alive}
        for *group, i, x in rows.mapInPandas(loads, head + "i int, load double").collect():
            load[tuple(group)][i] = x

        def judged(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in parts:
                gone: set[tuple] = set()
                for g, i, r in each(pdf):
                    j = np.flatnonzero(r[:i] > threshold)
                    heavier = load[g][i] >= load[g][j]
                    gone |= {(*g, int(k)) for k in j[~heavier]} | ({(*g, int(i))} if heavier.any() else set())
                yield pd.DataFrame(sorted(gone), columns=[*keys, "pos"])

        return _by_group(rows.mapInPandas(judged, head + "pos int").distinct(), by)
    finally:
        rows.unpersist()


def correlation_threshold(profiles: Profiles, threshold: float = 0.9) -> list[str]:
    """Of each pair that correlates above threshold (signed), the feature that correlates more with all others goes; ties go by order."""
    return _names_without(profiles, _correlated(profiles, (), _all(profiles), threshold))


OPERATIONS = {"variance_threshold": variance_threshold, "drop_na_columns": drop_na_columns, "correlation_threshold": correlation_threshold, "drop_outliers": drop_outliers}
_GROUPED = {"variance_threshold": _invariant, "drop_na_columns": _sparse, "correlation_threshold": _correlated, "drop_outliers": _outlying}


def feature_select(profiles: Profiles, operations: list[str], options: dict[str, dict] | None = None) -> Profiles:
    """Operations in order, each on the features that the ones before it left. The table is cached between them."""
    profiles.df.persist()
    try:
        now = profiles
        for name in operations:
            if now.names:
                now = profiles.keeping(OPERATIONS[name](now, **(options or {}).get(name, {})))
    finally:
        profiles.df.unpersist()
    return now


def select_per(profiles: Profiles, key: str, operations: list[str], options: dict[str, dict] | None = None) -> DataFrame:
    """Selection within each value of key, all values at once; features that are dropped at one value and kept at another are 0 there,
    and so is what is missing. Rows whose key is null are left out."""
    df = profiles.df.filter(F.col(key).isNotNull())
    now = Profiles(df.persist(), profiles.names, profiles.meta)
    try:
        alive: Chosen = {(r[0],): set(range(len(now.names))) for r in df.select(key).distinct().collect()}
        for name in operations:
            gone = _GROUPED[name](now, (key,), alive, **(options or {}).get(name, {}))
            alive = {g: known - gone.get(g, set()) for g, known in alive.items()}
    finally:
        df.unpersist()
    at = sorted(set().union(*alive.values()))
    kept = df.sparkSession.createDataFrame([(g[0], [k in known for k in at]) for g, known in alive.items()], f"`{key}` {dict(df.dtypes)[key]}, _kept array<boolean>")
    few = Profiles(df, profiles.names, profiles.meta).keeping([profiles.names[k] for k in at])
    filled = F.zip_with("features", "_kept", lambda x, ok: F.when(ok, F.coalesce(x, F.lit(0.0))).otherwise(0.0))
    return Profiles(few.df.join(kept, key).withColumn("features", filled), few.names, few.meta).wide()


def unite(tables: list[DataFrame]) -> DataFrame:
    """Union by name, missing columns null."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out
