"""Embedding near-duplicates: int8 tile products with rigorous bounds, doubles for what may pass.

Only vectors of one label (and length) meet. Identical vectors are collapsed first. A bounded sample
of vectors (MAX_PIVOTS) serves as pivots; every vector lives in the cell of its nearest pivot of its
label and also visits each lower-numbered cell whose pivot is at most 2 * theta (theta = arccos of the
threshold) farther away: by the triangle inequality no linked pair is missed, whatever the pivots.
Cells are cut into tiles of about TILE rows, and each pair of tiles is one group.

In a group each unit vector x is s * q + e with q int8, s a scale and |e| its measured residual norm.
The product of two vectors differs from s s' (q . q') by at most |x^| |e'| + |x'^| |e| + |e| |e'|
(Cauchy-Schwarz, x^ = s q); only pairs whose product plus this bound reaches the threshold are
recomputed in double precision. A group returns, for each vector, its number of links and one edge
of a spanning forest, never the pairs.

Null label; null, zero or empty vectors, and null or non-finite components: linked with nothing, kept.
Repeated rows are vectors of their own (linked by cosine 1); clashing extra columns are not read.
A cosine of exactly the threshold links. Vectors may be of any length; one is held whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise
from .components import components

MAX_PIVOTS = 2048
PER_PIVOT = 1024
TILE = 1024


def _unit(rows: list) -> np.ndarray:
    x = np.array(rows, np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 vectors, scales, norms of what they stand for, norms of the residuals (rounded up)."""
    scale = np.abs(x).max(axis=1) / 127
    q = np.rint(x / scale[:, None]).astype(np.int8)
    stands = q * scale[:, None]
    slack = 1 + 1e-12
    return q, scale, np.linalg.norm(stands, axis=1) * slack, np.linalg.norm(x - stands, axis=1) * slack + 1e-15


def _exact_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products of int8 rows; sums over 1024 dimensions are exact in float32."""
    out = np.zeros((len(a), len(b)))
    for k in range(0, a.shape[1], 1024):
        out += a[:, k : k + 1024].astype(np.float32) @ b[:, k : k + 1024].astype(np.float32).T
    return out


def linked_pairs(a: np.ndarray, b: np.ndarray, threshold: float, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of unit vectors with a cosine of at least the threshold (i < j if both sides are the same)."""
    qa, sa, na, ea = quantise(a)
    qb, sb, nb, eb = quantise(b)
    for at in range(0, len(a), 512):
        part = slice(at, at + 512)
        upper = _exact_products(qa[part], qb) * sa[part, None] * sb + na[part, None] * eb + ea[part, None] * (nb + eb) + 1e-12
        i, j = np.nonzero(upper >= threshold)
        i += at
        if same:
            i, j = i[i < j], j[i < j]
        for k in range(0, len(i), 1 << 16):
            x, y = i[k : k + (1 << 16)], j[k : k + (1 << 16)]
            passed = np.einsum("ij,ij->i", a[x], b[y]) >= threshold
            yield x[passed], y[passed]


def _group_links(pdf: pd.DataFrame, threshold: float) -> pd.DataFrame:
    x = _unit(pdf["embedding"].tolist())
    side = pdf["side"].to_numpy()
    a = np.flatnonzero(side == 0)
    alone = pdf["alone"].iloc[0]
    b = a if alone else np.flatnonzero(side == 1)
    weight, links, parent = pdf["weight"].to_numpy(), np.zeros(len(pdf), np.int64), np.arange(len(pdf))
    if len(a) and len(b):
        for i, j in linked_pairs(x[a], x[b], threshold, alone):
            i, j = a[i], b[j]
            np.add.at(links, i, weight[j])
            np.add.at(links, j, weight[i])
            while len(i):  # hook the higher root to the lower one, then halve the paths, until both ends agree
                p, q = parent[i], parent[j]
                np.minimum.at(parent, np.maximum(p, q), np.minimum(p, q))
                while (parent[parent] != parent).any():
                    parent = parent[parent]
                apart = parent[i] != parent[j]
                i, j = i[apart], j[apart]
    ids = pdf["rep"].to_numpy()
    some = np.flatnonzero(links > 0)
    return pd.DataFrame({"rep": ids[some], "links": links[some], "root": ids[parent[some]]})


def near_duplicates(vectors: DataFrame, threshold: float = 0.98, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """(key, n_links, component_id, kept) for each row of vectors(key, vector, label)."""
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("embedding"), F.col(label).alias("label"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    sound = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & finite & F.exists("embedding", lambda x: x != 0))
    reps = materialise(sound.groupBy("label", "embedding").agg(F.min("id").alias("rep"), F.count("*").alias("weight")))
    n = reps.count()
    wanted = min(MAX_PIVOTS, n // PER_PIVOT)
    drawn = reps.where(F.pmod(F.xxhash64("rep", F.lit(7)), F.lit(1_000_000)) < F.lit(1_000_000 * 2 * wanted // max(n, 1) + 1)).orderBy(F.xxhash64("rep", F.lit(7)), "rep").limit(wanted) if wanted else reps.limit(0)
    pivots: dict = {}
    for r in drawn.collect():
        pivots.setdefault((r["label"], len(r["embedding"])), []).append(r["embedding"])
    pivots = {k: _unit(v) for k, v in pivots.items()}
    theta = float(np.arccos(threshold))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            pdf["dim"] = pdf["embedding"].map(len)
            for (name, dim), part in pdf.groupby(["label", "dim"]):
                own = pivots.get((name, dim))
                if own is None:
                    yield part.assign(cell=0, side=0)
                    continue
                for at in range(0, len(part), 4096):
                    piece = part.iloc[at : at + 4096]
                    angle = np.arccos(np.clip(_unit(piece["embedding"].tolist()) @ own.T, -1, 1))
                    home = angle.argmin(axis=1)
                    yield piece.assign(cell=home, side=0)
                    i, cell = np.nonzero((angle <= angle[np.arange(len(piece)), home][:, None] + 2 * theta + 1e-7) & (np.arange(len(own)) < home[:, None]))
                    yield piece.iloc[i].assign(cell=cell, side=1)

    kinds = dict(reps.dtypes)
    placed = materialise(reps.mapInPandas(place, f"label {kinds['label']}, embedding {kinds['embedding']}, rep long, weight long, dim int, cell int, side int"))
    cells = placed.groupBy("label", "dim", "cell").agg(F.ceil(F.count_if(F.col("side") == 0) / TILE).alias("t0"), F.ceil(F.count_if(F.col("side") == 1) / TILE).alias("t1"))
    name = lambda kind, i, j, side: F.struct(F.lit(kind).alias("kind"), i.cast("long").alias("i"), j.cast("long").alias("j"), side.cast("int").alias("at"))
    tile = F.pmod(F.xxhash64("rep", F.lit(11)), F.when(F.col("side") == 1, F.col("t1")).otherwise(F.col("t0")))
    upto = lambda count: F.filter(F.sequence(F.lit(0).cast("long"), count), lambda k: k < count)
    own = F.transform(upto(F.col("t0")), lambda j: name("own", F.least("tile", j), F.greatest("tile", j), F.col("tile") > j))
    hosts = F.transform(upto(F.col("t1")), lambda j: name("visit", F.col("tile"), j, F.lit(0)))
    guests = F.transform(upto(F.col("t0")), lambda i: name("visit", i, F.col("tile"), F.lit(1)))
    units = placed.join(cells, ["label", "dim", "cell"]).withColumn("tile", tile).withColumn("unit", F.explode(F.when(F.col("side") == 1, guests).otherwise(F.concat(own, hosts))))
    units = units.select(
        "label", "dim", "cell", F.col("unit.kind").alias("kind"), F.col("unit.i").alias("i"), F.col("unit.j").alias("j"), F.col("unit.at").alias("side"),
        ((F.col("unit.kind") == "own") & (F.col("unit.i") == F.col("unit.j"))).alias("alone"), "rep", "weight", "embedding",
    )
    found = materialise(units.groupBy("label", "dim", "cell", "kind", "i", "j").applyInPandas(lambda pdf: _group_links(pdf, threshold), "rep long, links long, root long"))
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    joined = components(found.select(F.col("rep").alias("u"), F.col("root").alias("v")))
    by_rep = reps.join(links, "rep", "left").join(joined.withColumnRenamed("id", "rep"), "rep", "left")
    by_rep = by_rep.select("label", "embedding", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component"))
    result = rows.join(by_rep, ["label", "embedding"], "left")
    component = F.coalesce("component", "id")
    return result.select(F.col("id").alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"))
