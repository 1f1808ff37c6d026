"""Embedding near-duplicates: spherical k-means cells and blocked cosine products."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rapport.llm.common import components
from rapport.operators.joins import split_join
from rapport.sources.sinks import stored

# Centroids are fitted to this many vectors at most, drawn by hash; all vectors are compared.
SAMPLE = 20_000
MAX_CELLS = 4096
ROUNDS = 8
# Allowance for rounding where a vector is tested for being near a border.
ROUNDING = 1e-7
# Rows of a cell compared at a time.
BLOCK = 1024
# Cells of more than one block that are broadcast at most.
MAX_SENT_CELLS = 50_000


def fit(vectors: np.ndarray, cells: int, seed: int = 9) -> np.ndarray:
    """Spherical k-means: unit centroids of unit vectors."""
    rng = np.random.default_rng(seed)
    cells = max(1, min(cells, len(vectors)))
    centroids = vectors[np.sort(rng.choice(len(vectors), cells, replace=False))]
    for _ in range(ROUNDS):
        nearest = np.argmax(vectors @ centroids.T, axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, vectors)
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centroids = np.where(norms > 0, sums / np.where(norms > 0, norms, 1), centroids)
    return centroids


def exact_margin(least: float) -> float:
    """Distance from a border within which one of any two linked vectors lies.

    Unit vectors x and y at a cosine of ``least`` or more are at most sqrt(2 - 2 least) apart.
    With c and d the centroids of their homes, gap x + gap y = (c - d)(x - y) is at most that
    times the distance of c and d, so one of the two gaps is at most half of it: that vector
    visits the other's home.
    """
    return max((1 - least) / 2, 0.0) ** 0.5


def visits(unit: np.ndarray, centroids: np.ndarray, margin: float) -> tuple[np.ndarray, np.ndarray]:
    """Home cell of every vector, and a table of the cells it visits, home included.

    A vector visits cell c if it lies within ``margin`` of the plane midway between c's
    centroid and that of its home, a cosine difference over the distance of the centroids.
    """
    cosines = unit @ centroids.T
    home = np.argmax(cosines, axis=1)
    gap = cosines[np.arange(len(unit)), home][:, None] - cosines
    apart = np.sqrt(np.maximum(2 - 2 * centroids @ centroids.T, 0))[home]
    near = gap <= margin * apart + ROUNDING
    near[np.arange(len(unit)), home] = True
    return home, near


def compare(left: pd.DataFrame, right: pd.DataFrame, same: bool, least: float):
    """Links between two blocks of one cell: per row its links to count here, and a spanning star.

    A pair is counted in one cell only: the home of both, else the lower of the two homes in
    which the pair meets. Stars hold the smallest ``rep`` that a row reaches inside the blocks.
    """

    def parts(block):
        return units(block.embedding.to_list()), *(block[c].to_numpy() for c in ("home", "cls", "rep", "n"))

    (a, home_a, cls_a, rep_a, n_a), (b, home_b, cls_b, rep_b, n_b) = parts(left), parts(right)
    cell = int(left.cell.iloc[0])
    near = a @ b.T >= least
    if same:
        np.fill_diagonal(near, False)
    i, j = np.nonzero(near)
    if not len(i):
        return None
    # Two homes: the pair also meets in the other one if the vector at home here visits it.
    ha, hb = home_a[i], home_b[j]
    visit_a = [frozenset(v) for v in left.visit]
    visit_b = visit_a if same else [frozenset(v) for v in right.visit]
    other = np.where(ha == cell, hb, ha)
    here = (ha == cell) | (hb == cell)
    counted = here & ((ha == hb) | (other > cell))
    unsure = np.flatnonzero(here & (ha != hb) & (other < cell))
    for k in unsure.tolist():
        at_home = visit_a[i[k]] if ha[k] == cell else visit_b[j[k]]
        counted[k] = int(other[k]) not in at_home
    links_a = np.bincount(i[counted], n_b[j[counted]], len(a)).astype(np.int64)
    links_b = np.bincount(j[counted], n_a[i[counted]], len(b)).astype(np.int64)
    low_a, low_b = rep_a.copy(), rep_b.copy()
    while True:
        new_a, new_b = low_a.copy(), low_b.copy()
        np.minimum.at(new_a, i, low_b[j])
        np.minimum.at(new_b, j, new_a[i])
        if same:
            new_a = new_b = np.minimum(new_a, new_b)
        if (new_a == low_a).all() and (new_b == low_b).all():
            break
        low_a, low_b = new_a, new_b
    if same:
        return cls_a, rep_a, links_a, low_a
    return tuple(map(np.concatenate, ((cls_a, cls_b), (rep_a, rep_b), (links_a, links_b), (low_a, low_b))))


def units(vectors: list[np.ndarray]) -> np.ndarray:
    """Vectors in double precision, divided by their length."""
    out = np.stack(vectors).astype(np.float64)
    out /= np.abs(out).max(axis=1, keepdims=True)
    return out / np.linalg.norm(out, axis=1, keepdims=True)


def classes_of(vectors: DataFrame) -> DataFrame:
    """Classes of equal vectors that can link: (cls, rep, n, label, embedding).

    ``rep`` is the smallest id, ``cls`` tells classes of the same ``rep`` apart, ``n`` is the
    number of rows. Left out are null ids and labels, and vectors that are null, empty or
    zero or hold a null, infinite or undefined component.
    """
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists("embedding", lambda x: x != 0)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", "embedding")
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & fine & some)
    classes = rows.groupBy("label", "embedding").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("n"))
    return classes.select(F.xxhash64("label", "embedding").alias("cls"), "rep", "n", "label", "embedding")


def cell_links(classes: DataFrame, least: float, margin: float, cells: int | None) -> DataFrame:
    """Rows (cls, rep, links, low) from every pair of blocks; a class has a row for each it links in.

``classes`` is that of ``classes_of``; it is read several times.
    """
    spark = classes.sparkSession
    width = F.size("embedding")
    total = classes.count()
    cells = cells or int(min(MAX_CELLS, max(1, total**0.5 / 2)))
    drawn = classes.orderBy("cls", "rep").limit(SAMPLE).select("embedding").collect()
    by_width: dict[int, list] = {}
    for row in drawn:
        by_width.setdefault(len(row.embedding), []).append(row.embedding)
    centroids = {w: fit(units(v), cells) for w, v in by_width.items()}
    sent = spark.sparkContext.broadcast(centroids)
    kinds = dict(classes.dtypes)
    rows = classes.select("cls", "rep", "n", "label", "embedding", width.cast("int").alias("width"))

    def assign(batches):
        for pdf in batches:
            for w, part in pdf.groupby("width"):
                # A width outside the sample is one cell.
                unit = units(part.embedding.to_list())
                places = sent.value.get(w, np.eye(1, w))
                for at in range(0, len(part), 4096):
                    home, near = visits(unit[at : at + 4096], places, margin)
                    row, cell = np.nonzero(near)
                    out = part.iloc[at + row].copy()
                    lists = [np.flatnonzero(x).tolist() for x in near]
                    out["home"], out["cell"], out["visit"] = home[row], cell, [lists[k] for k in row]
                    yield out[["cls", "rep", "n", "label", "width", "embedding", "home", "cell", "visit"]]

    schema = (
        f"cls long, rep long, n long, label {kinds['label']}, width int, embedding {kinds['embedding']}, "
        "home int, cell int, visit array<int>"
    )
    placed = stored(rows.mapInPandas(assign, schema), "cells")
    at = ["label", "width", "cell"]
    # Cells of several blocks are few, and so sent to all tasks if they are; else joined by shuffle.
    full = placed.groupBy(*at).agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    full = stored(full.where("blocks > 1"), "large-cells")
    few = full.count() <= MAX_SENT_CELLS
    placed = placed.join(F.broadcast(full), at, "left") if few else split_join(placed, full, at, "left")
    placed = placed.withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    placed = placed.withColumn("block", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
    # Each block meets each of its cell, itself included, once: as (lower, higher).
    placed = placed.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    pairs = placed.select("*", F.least("block", "with").alias("lo"), F.greatest("block", "with").alias("hi"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        lo, hi = int(pdf.lo.iloc[0]), int(pdf.hi.iloc[0])
        pdf = pdf.sort_values(["rep", "cls"], kind="stable")
        left, right = pdf[pdf.block == lo], pdf[pdf.block == hi]
        out = compare(left, right, lo == hi, least) if len(left) and len(right) else None
        found = pd.DataFrame(dict(zip(("cls", "rep", "links", "low"), out or ([], [], [], []))), dtype="int64")
        return found[(found.links > 0) | (found.low != found.rep)]

    return pairs.groupBy(*at, "lo", "hi").applyInPandas(run, "cls long, rep long, links long, low long")


def near_duplicates(
    vectors: DataFrame, least: float = 0.98, margin: float | None = None, cells: int | None = None
) -> DataFrame:
    """Links and group of every vector: (vec_id, n_links, component_id, kept).

    Vectors with equal non-null labels link at a cosine of ``least`` or more, in double
    precision. Equal vectors are folded first. Centroids are fitted to a bounded sample;
    every vector is assigned to its nearest one and visits the cells whose border is near,
    and in each cell blocks of vectors are multiplied, so no pairs are sent and a cell of any
    size is cut into bounded tasks. ``margin`` follows from ``least`` (``exact_margin``), so
    no link is missed; a smaller one given here can miss links across borders.

    ``n_links`` counts the other vectors, equal ones included, ``component_id`` is the
    smallest id reachable, ``kept`` marks it. Vectors of different length, and those
    ``classes_of`` leaves out, link with nothing: 0, their own id, kept. A null id has
    a null component and is not kept. Rows that repeat an id are vectors of their own.
    """
    found = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", "embedding")
    margin = exact_margin(least) if margin is None else margin
    classes = stored(classes_of(vectors), "vectors")
    links = stored(cell_links(classes, least, margin, cells), "cell-links")
    groups = components(links.select(F.col("rep").alias("a"), F.col("low").alias("b")), "vector-links")
    counts = links.groupBy("rep", "cls").agg(F.sum("links").alias("links"))
    classes = classes.join(counts, ["rep", "cls"], "left")
    classes = classes.join(groups, classes.rep == groups.node, "left")
    classes = classes.select(
        "label",
        "embedding",
        (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
        F.coalesce("component", "rep").alias("component_id"),
    )
    rows = split_join(found, classes, ["label", "embedding"], "left")
    component = F.when(F.col("vec_id").isNotNull(), F.coalesce("component_id", "vec_id"))
    rows = rows.select("vec_id", F.when(F.col("vec_id").isNotNull(), F.coalesce("n_links", F.lit(0))).otherwise(0).alias("n_links"), component.alias("component_id"))
    return rows.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
