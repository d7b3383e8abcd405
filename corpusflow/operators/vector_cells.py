"""Exact nearest neighbours of a large query table by cells and rings.

Unit vectors are dealt to the nearest of a bounded sample of pivots (cells);
a cell is cut into rings by distance from its pivot and rings that are still
too large into slices. A query first visits the slices it lies in, which
bounds the distance of its k-th neighbour; after that it visits only those
slices that the triangle inequality (ring bounds and the plane between two
pivots) can't rule out. Equal vectors are compared once on both sides.

Slices are compared in bins, so that a query travels once a bin and not once
a slice. Vectors without such structure (independent random ones of many
dimensions) rule nothing out: every query then visits every slice.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusflow.session import ensure_checkpoint_dir

MAX_PIVOTS = 1024     # vectors sampled to the driver, whatever the input's size
MAX_SLICES = 65_536   # slices grow with the input beyond it, so that their list stays bounded
RINGS = 64
BIN_ROWS = 32_768     # documents of neighbouring slices that one task compares
BLOCK_NUMBERS = 1_000_000  # numbers of a block of query vectors, and of a block of cosines
DIGITS = 6
SLACK = 1e-6          # distances are compared with room for rounding


def unit_rows(arrs) -> np.ndarray:
    """Rows scaled to length one; zero vectors stay zero."""
    m = np.vstack([np.asarray(a, dtype=np.float64) for a in arrs])
    n = np.linalg.norm(m, axis=1, keepdims=True)
    n[n == 0] = 1.0
    return m / n


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    sq = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2.0 * (a @ b.T)
    return np.sqrt(np.maximum(sq, 0.0))


def _group(vec: str, others: list[str]) -> Column:
    return F.sha2(F.to_json(F.struct(vec, *others)), 256)


def _representatives(d: DataFrame, meta: list[str], n: int) -> DataFrame:
    """One row per different vector (with the same ``meta``): ``g``, the vector
    and its ``n`` smallest ids. More can't be among the n nearest, as ties go
    by id. Copies meet map-side and carry no vectors through the shuffle."""
    d = d.withColumn("g", _group("embedding", meta))
    by_id = Window.partitionBy("g").orderBy("doc_id")
    ids = d.select("g", "doc_id").distinct().withColumn("__r", F.row_number().over(by_id)).where(F.col("__r") <= n) \
           .groupBy("g").agg(F.collect_list("doc_id").alias("ids"))
    return d.select("g", "embedding", *meta).dropDuplicates(["g"]).join(ids, "g")


class Cells:
    """Pivots, cells and slices over the representatives ``reps``."""

    def __init__(self, reps: DataFrame, slice_rows: int):
        ensure_checkpoint_dir(reps.sparkSession)
        reps = reps.checkpoint()
        n = reps.count()
        self.slice_rows = max(slice_rows, -(-n // MAX_SLICES))
        m = min(MAX_PIVOTS, -(-n // max(1, slice_rows // 8)))
        # the smallest hashes are a sample without order by content
        self.pivots = unit_rows([r[0] for r in reps.orderBy("g").limit(m).select("embedding").collect()]) if n else None
        self.rows = self._slices(reps) if n else None
        self.units = None
        if n:
            u = self.rows.groupBy("unit").agg(F.first("cell").alias("cell"), F.count(F.lit(1)).alias("n"), F.min("r").alias("lo"),
                                              F.max("r").alias("hi")).orderBy("cell", "lo", "unit").toPandas()
            u["bin"] = (u["n"].cumsum() - u["n"]) // max(self.slice_rows, BIN_ROWS)
            self.units = u
            number = spark_rows(reps.sparkSession, u)
            self.rows = self.rows.join(F.broadcast(number), "unit").select(*[c for c in self.rows.columns if c != "unit"], "unit_no", "bin")

    def _slices(self, reps: DataFrame) -> DataFrame:
        pivots = self.pivots

        @F.pandas_udf("cell int, r double")
        def nearest(vecs: pd.Series) -> pd.DataFrame:
            if not len(vecs):
                return pd.DataFrame({"cell": np.zeros(0, np.int32), "r": np.zeros(0)})
            dist = _distances(unit_rows(vecs), pivots)
            cell = dist.argmin(1)
            return pd.DataFrame({"cell": cell.astype(np.int32), "r": dist[np.arange(len(cell)), cell]})

        rows = reps.withColumn("__a", nearest("embedding")).select(*reps.columns, "__a.cell", "__a.r").checkpoint()
        shares = [i / RINGS for i in range(1, RINGS)]
        # at most MAX_PIVOTS rows, then at most RINGS for each of them
        cuts = rows.groupBy("cell").agg(F.when(F.count(F.lit(1)) > self.slice_rows,
                                               F.percentile_approx("r", shares)).alias("cuts"))
        rows = rows.join(F.broadcast(cuts), "cell").withColumn(
            "ring", F.coalesce(F.size(F.filter("cuts", lambda c: c < F.col("r"))), F.lit(0))).drop("cuts")
        parts = rows.groupBy("cell", "ring").agg(
            F.ceil(F.count(F.lit(1)) / F.lit(float(self.slice_rows))).cast("long").alias("parts"))
        rows = rows.join(F.broadcast(parts), ["cell", "ring"])
        part = F.pmod(F.xxhash64("g"), F.col("parts"))
        unit = F.concat_ws("-", "cell", "ring", part.cast("string"))
        return rows.withColumn("unit", unit).drop("ring", "parts").checkpoint()

    def visits(self, queries: DataFrame, k: int, blocks: int, second: bool) -> DataFrame:
        """``queries`` once for each ``bin`` to visit, with the ``units`` to
        compare there (null: all) and a ``block``. First the nearest slices
        that hold k vectors; in the second pass all others that may hold one at
        least as near as the cosine ``least``, a null one ruling nothing out."""
        pivots, u = self.pivots, self.units
        cell, n, lo, hi = (u[c].to_numpy() for c in ("cell", "n", "lo", "hi"))
        bins, starts, sizes = np.unique(u["bin"].to_numpy(), return_index=True, return_counts=True)

        def dealt(units: np.ndarray) -> list:
            parts = np.split(units, np.searchsorted(units, starts[1:]))
            return [{"bin": int(b), "units": None if len(p) == m else p.tolist()} for b, m, p in zip(bins, sizes, parts) if len(p)]

        @F.pandas_udf("array<struct<bin:int,units:array<int>>>")
        def choose(vecs: pd.Series, least: pd.Series) -> pd.Series:
            between = _distances(pivots, pivots)
            out, size = [], max(1, BLOCK_NUMBERS // len(cell))
            for i in range(0, len(vecs), size):
                dist = _distances(unit_rows(vecs.iloc[i:i + size]), pivots)
                near = dist.argmin(1)
                own = dist[np.arange(len(near)), near]
                gap = between[near]
                plane = np.where(gap > 0, (dist ** 2 - own[:, None] ** 2) / (2 * np.where(gap > 0, gap, 1.0)), 0.0)
                low = np.maximum(np.maximum(dist[:, cell] - hi, lo - dist[:, cell]), np.maximum(plane[:, cell], 0.0))
                for row, far, t in zip(low, dist[:, cell], least.iloc[i:i + size]):
                    rank, first, held = np.where(row > SLACK, 4.0 + row, far), [], 0
                    while held < k and len(first) < len(cell):
                        j = int(rank.argmin())
                        first.append(j)
                        held += n[j]
                        rank[j] = np.inf
                    if second:
                        reach = np.inf if pd.isna(t) else np.sqrt(max(0.0, 2.0 - 2.0 * (t - 2 * 10.0 ** -DIGITS)))
                        ok = row <= reach + SLACK
                        ok[first] = False
                        first = np.flatnonzero(ok)
                    out.append(dealt(np.sort(np.asarray(first, dtype=np.int64))))
            return pd.Series(out)

        queries = queries if second else queries.withColumn("least", F.lit(None).cast("double"))
        chosen = queries.withColumn("__v", choose("qvec", "least")).checkpoint()  # chosen once, one row a query
        return chosen.select(*queries.columns, F.inline("__v")) \
                     .withColumn("block", F.pmod(F.xxhash64("gq"), F.lit(blocks)))

    def made(self, visits: DataFrame) -> DataFrame:
        """``unit_no, queries, documents``: what the visits compare."""
        spark = visits.sparkSession
        u = self.units.reset_index().rename(columns={"index": "unit_no"})
        per_bin = spark.createDataFrame([(int(b), g["unit_no"].tolist()) for b, g in u.groupby("bin")], "bin int, all_units array<int>")
        sizes = spark.createDataFrame([(int(i), int(n)) for i, n in zip(u["unit_no"], u["n"])], "unit_no int, documents long")
        return visits.join(F.broadcast(per_bin), "bin").select(F.explode(F.coalesce("units", "all_units")).alias("unit_no")) \
                     .groupBy("unit_no").agg(F.count(F.lit(1)).alias("queries")).join(sizes, "unit_no")


def spark_rows(spark, units: pd.DataFrame) -> DataFrame:
    """The numbers and bins of the slices as a (bounded) table."""
    return spark.createDataFrame([(name, i, int(b)) for i, (name, b) in enumerate(zip(units["unit"], units["bin"]))],
                                 "unit string, unit_no int, bin int")


def _best(sims: np.ndarray, k: int, floor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of each row's k greatest entries and what ties with them after
    rounding, none below the row's ``floor``, which rises to its k-th entry."""
    if sims.shape[1] >= k:
        np.maximum(floor, np.partition(sims, sims.shape[1] - k, axis=1)[:, sims.shape[1] - k], out=floor)
    return np.nonzero(np.isfinite(sims) & (sims >= floor[:, None] - 2 * 10.0 ** -DIGITS))


def _compare(visits: DataFrame, rows: DataFrame, k: int, fields: list, mask: Callable) -> DataFrame:
    """``gq, g, cosine``: the k best (and what ties with them after rounding)
    of each query in each bin it visits, a block of queries at a time."""
    qcols, dcols = [f[0] for f in fields], sorted({f[1] for f in fields})
    pairs = visits.select(F.col("bin").alias("bin"), F.col("block").alias("block")).distinct()
    d = rows.select("bin", "unit_no", "g", "embedding", *dcols).join(pairs, "bin")

    def run(qs: pd.DataFrame, ds: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({"gq": [], "g": [], "cosine": []})
        if not len(qs) or not len(ds):
            return none
        q, asked = unit_rows(qs["qvec"]), qs[qcols].to_dict("records") if qcols else None
        everywhere = qs["units"].isna().to_numpy()
        chosen = [(i, j) for i, units in enumerate(qs["units"]) if not everywhere[i] for j in units]
        who, where = np.array(chosen, dtype=np.int64).reshape(-1, 2).T
        found = []
        # cosines that each query's k-th best can't be below, as far as known
        floor = qs["least"].to_numpy(dtype=np.float64, na_value=-np.inf)
        for unit, part in ds.groupby("unit_no"):
            ask = np.union1d(np.flatnonzero(everywhere), who[where == unit])
            docs, size = unit_rows(part["embedding"]), max(1, BLOCK_NUMBERS // len(part))
            at = part.index.to_numpy()
            for i in range(0, len(ask), size):
                block = ask[i:i + size]
                sims = q[block] @ docs.T
                for row, j in enumerate(block if fields else ()):
                    sims[row, ~mask(asked[j], part, fields)] = -np.inf
                low = floor[block]
                a, b = _best(sims, k, low)
                floor[block] = low
                found.append((block[a], at[b], sims[a, b]))
        if not found:
            return none
        a, b, s = (np.concatenate(c) for c in zip(*found))
        order = np.lexsort((-s, a))
        a, b, s = a[order], b[order], s[order]
        # the k-th best of each query, or its last
        starts, counts = np.unique(a, return_index=True, return_counts=True)[1:]
        kth = s[starts + np.minimum(counts, k) - 1]
        keep = s >= np.repeat(np.where(counts < k, -np.inf, kth), counts) - 2 * 10.0 ** -DIGITS
        return pd.DataFrame({"gq": qs["gq"].to_numpy()[a[keep]], "g": ds["g"].to_numpy()[b[keep]], "cosine": s[keep]})

    return visits.select("bin", "block", "gq", "qvec", "least", "units", *qcols).groupBy("bin", "block") \
                 .cogroup(d.groupBy("bin", "block")).applyInPandas(run, "gq string, g string, cosine double")


def cell_candidates(q: DataFrame, d: DataFrame, k: int, fields: list, mask: Callable, exclude_self: bool = False,
                    slice_rows: int = 4096) -> tuple[DataFrame, DataFrame]:
    """Candidates ``(query_id, doc_id, cosine)`` that hold every query's exact
    top k (by cosine to six digits, then id), and the visits made, one row per
    slice: ``unit_no, queries, documents`` (their products are the pairs compared).

    ``q`` is ``(query_id, qvec, <filter columns>)``, ``d`` is ``(doc_id,
    embedding, <meta columns>)``. Rows without a vector are left out; a
    repeated (doc_id, vector) row counts once; empty tables give no rows. Zero
    vectors have cosine zero with everything."""
    spark, want = d.sparkSession, k + 1 if exclude_self else k
    meta, asked = sorted({f[1] for f in fields}), [f[0] for f in fields]
    types = dict(d.dtypes)
    cells = Cells(_representatives(d.where(F.col("embedding").isNotNull()).select("doc_id", "embedding", *meta), meta, want),
                  slice_rows)
    if cells.units is None:
        return (spark.createDataFrame([], f"query_id {dict(q.dtypes)['query_id']}, doc_id {types['doc_id']}, cosine double"),
                spark.createDataFrame([], "unit_no int, queries long, documents long"))
    q = q.where(F.col("qvec").isNotNull()).withColumn("gq", _group("qvec", asked))
    groups = q.select("gq", "qvec", *asked).dropDuplicates(["gq"]).checkpoint()
    numbers = groups.agg(F.sum(F.size("qvec").cast("long"))).first()[0] or 0
    block = max(1, -(-numbers // BLOCK_NUMBERS))

    visits1 = cells.visits(groups, want, block, second=False)
    found1 = _compare(visits1, cells.rows, want, fields, mask).checkpoint()
    least = found1.groupBy("gq").agg(F.get(F.sort_array(F.collect_list("cosine"), asc=False), F.lit(want - 1)).alias("least"))
    found, visits = found1, visits1
    if len(cells.units) > 1:  # a single slice has been visited by all
        visits2 = cells.visits(groups.join(least, "gq", "left"), want, block, second=True)
        found = found1.unionByName(_compare(visits2, cells.rows, want, fields, mask))
        visits = visits1.select("bin", "units").unionByName(visits2.select("bin", "units"))

    near = F.round("cosine", DIGITS).desc()
    kept = found.withColumn("__r", F.rank().over(Window.partitionBy("gq").orderBy(near))).where(F.col("__r") <= want)
    ids = kept.join(cells.rows.select("g", "ids"), "g").select("gq", F.explode("ids").alias("doc_id"), "cosine")
    top = ids.withColumn("__r", F.row_number().over(Window.partitionBy("gq").orderBy(near, "doc_id"))) \
             .where(F.col("__r") <= want).groupBy("gq").agg(F.collect_list(F.struct("doc_id", "cosine")).alias("__top"))
    out = q.select("query_id", "gq").join(top, "gq").select("query_id", F.inline("__top"))
    if exclude_self:
        out = out.where(F.col("query_id") != F.col("doc_id"))
    return out, cells.made(visits)
