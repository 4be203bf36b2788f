"""Size-constrained clustering of a spot's cells by deterministic annealing.

Every spot has its own small problem: as many clusters as it has types, with the
types' shares as capacities. Spots of ordinary size are solved inside tasks. A
spot with more cells than ``max_rows`` is solved by the same steps, but each step
is a Spark aggregation over its cells, so no task holds the spot.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, spread_by
from .merge import NOT_DECONVOLVED

# Starting temperatures, cooling factor, steps per temperature.
TEMPERATURES = [1.0, 1e-1, 1e-2, 1e-3, 1e-4, 1e-5, 1e-6, 1e-7, 1e-8]
COOLING = 0.999
MAX_STEPS = 1000
MAX_ROWS = 20_000


def _responsibilities(x: np.ndarray, centres: np.ndarray, eta: np.ndarray, beta: float):
    gap = np.sqrt(((x[:, None, :] - centres[None, :, :]) ** 2).sum(axis=2))
    # Shifting each row's exponent leaves both normalised quantities unchanged.
    weight = np.exp(-beta * (gap - gap.min(axis=1, keepdims=True)))
    return gap, weight


def _partial(x, centres, eta, beta):
    """Sums a block of cells contributes to the next sizes (eta)."""
    _, weight = _responsibilities(x, centres, eta, beta)
    return (weight / (weight @ eta)[:, None]).sum(axis=0)


def _partial_centres(x, centres, eta, beta):
    """Sums a block contributes to the next centres, and its hard label counts."""
    _, weight = _responsibilities(x, centres, eta, beta)
    share = weight * eta
    share /= share.sum(axis=1, keepdims=True)
    counts = np.bincount(share.argmax(axis=1), minlength=len(eta))
    return share.T @ x, share.sum(axis=0), counts


def _fits(counts: np.ndarray, capacity: np.ndarray) -> bool:
    return bool((counts > 0).all() and (counts <= capacity + 1e-9).all())


class _Schedule:
    """Temperatures, sizes and centres of one spot; fed with sums over its cells."""

    def __init__(self, n: int, share: np.ndarray, first: np.ndarray):
        self.n, self.share, self.first = n, share, first
        self.capacity = n * share
        self.level, self.best = -1, None
        self.done = False
        self._next_level()

    def _next_level(self) -> None:
        self.level += 1
        if self.level == len(TEMPERATURES):
            self.done = True
            return
        self.t, self.step = TEMPERATURES[self.level], 0
        self.centres, self.eta = self.first.copy(), self.share.copy()

    @property
    def beta(self) -> float:
        return 1.0 / self.t

    def take_sizes(self, sums: np.ndarray) -> None:
        self.eta = self.share / np.maximum(sums / self.n, 1e-300)

    def take_centres(self, total: np.ndarray, mass: np.ndarray, counts: np.ndarray) -> None:
        state = (self.centres, self.eta, self.beta)
        self.centres = total / np.maximum(mass, 1e-300)[:, None]
        self.t *= COOLING
        self.step += 1
        if not (_fits(counts, self.capacity) or self.step >= MAX_STEPS):
            return
        found = int((counts > 0).sum())
        off = abs(found - len(self.share))
        if self.best is None or off < self.best[0]:
            self.best = (off, *state, self.centres)
        if off == 0:
            self.done = True
        else:
            self._next_level()


def anneal(x: np.ndarray, share: np.ndarray) -> np.ndarray:
    """Labels of one spot's cells; the first cells in order start the centres."""
    k = len(share)
    if k == 1:
        return np.zeros(len(x), dtype=int)
    run = _Schedule(len(x), share, x[:k].copy())
    while not run.done:
        run.take_sizes(_partial(x, run.centres, run.eta, run.beta))
        run.take_centres(*_partial_centres(x, run.centres, run.eta, run.beta))
    _, centres, eta, beta, last = run.best
    _, weight = _responsibilities(x, centres, eta, beta)
    labels = (weight * eta).argmax(axis=1)
    return enforce_sizes(x, labels, last, target_sizes(share, len(x)))


def target_sizes(share: np.ndarray, n: int) -> np.ndarray:
    """Integer cluster sizes; rounding errors are settled on the largest remainders."""
    exact = share * n
    sizes = np.floor(exact).astype(int)
    rest = np.argsort(-(exact - sizes), kind="stable")[: n - sizes.sum()]
    sizes[rest] += 1
    return sizes


def enforce_sizes(x, labels, centres, sizes) -> np.ndarray:
    """Move the farthest cell of an oversized cluster to the nearest undersized one."""
    labels = labels.copy()
    counts = np.bincount(labels, minlength=len(sizes))
    for big in range(len(sizes)):
        if counts[big] <= sizes[big]:
            continue
        members = np.flatnonzero(labels == big)
        far = np.linalg.norm(x[members] - centres[big], axis=1)
        for cell in members[np.argsort(-far, kind="stable")][: counts[big] - sizes[big]]:
            small = np.flatnonzero(counts < sizes)
            nearest = small[np.linalg.norm(x[cell] - centres[small], axis=1).argmin()]
            labels[cell] = nearest
            counts[big] -= 1
            counts[nearest] += 1
    return labels


def _usable_share(counts: list[float], n: int) -> np.ndarray:
    """Shares of the spot's types; with fewer cells than types the largest stay."""
    share = np.asarray(counts, dtype=float)
    if len(share) > n:
        keep = np.sort(np.argsort(-share, kind="stable")[:n])
        share = share[keep]
    return share / share.sum()


def _match_types(sizes: np.ndarray, types: list[str], counts: list[int]) -> dict[int, str]:
    """Give clusters the type with exactly their size; each type is used once."""
    free = list(zip(types, counts))
    found: dict[int, str] = {}
    for cluster, size in enumerate(sizes):
        for i, (name, count) in enumerate(free):
            if count == size and size > 0:
                found[cluster] = name
                del free[i]
                break
    return found


def local_assignment(
    cells: DataFrame, counts: DataFrame, max_rows: int = MAX_ROWS, seed: int = 0
) -> DataFrame:
    """(cell_ids, barcode, spot_clusters, cell_type) by annealing within each spot.

    ``cells`` has (cell_ids, barcode, features), ``counts`` (barcode, cell_type, n).
    """
    types = counts.filter("n > 0").groupBy("barcode").agg(
        F.sort_array(F.collect_list(F.struct("cell_type", "n"))).alias("_t")
    )
    sizes = cells.groupBy("barcode").agg(F.count("*").alias("_size"))
    work = (
        cells.filter(F.col("barcode").isNotNull())
        .join(sizes, "barcode")
        .join(types, "barcode", "left")
        .select(
            "cell_ids",
            "barcode",
            "features",
            "_size",
            F.transform("_t", lambda t: t["cell_type"]).alias("types"),
            F.transform("_t", lambda t: t["n"].cast("long")).alias("counts"),
            F.xxhash64("cell_ids", F.lit(seed)).alias("_h"),
        )
    )

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["_h", "cell_ids"], kind="stable")
        names = pdf["types"].iloc[0]
        if names is None:
            labels, lookup = np.zeros(len(pdf), dtype=int), {0: NOT_DECONVOLVED}
        else:
            x = np.stack(pdf["features"].to_numpy()).astype(float)
            n_types = list(pdf["counts"].iloc[0])
            labels = anneal(x, _usable_share(n_types, len(x)))
            lookup = _match_types(np.bincount(labels), list(names), n_types)
        return pd.DataFrame(
            {
                "cell_ids": pdf["cell_ids"].to_numpy(),
                "barcode": pdf["barcode"].to_numpy(),
                "spot_clusters": labels.astype(np.int32),
                "cell_type": [lookup.get(int(v)) for v in labels],
            }
        )

    kinds = dict(cells.dtypes)
    schema = (
        f"cell_ids {kinds['cell_ids']}, barcode {kinds['barcode']}, "
        "spot_clusters int, cell_type string"
    )
    small = work.filter(F.col("_size") <= max_rows)
    solved = spread_by(small, "barcode").groupBy("barcode").applyInPandas(solve, schema)
    crowded = sizes.filter((F.col("_size") > max_rows) & F.col("barcode").isNotNull())
    # At most (all cells / max_rows) spots are crowded; only their keys come back.
    for row in crowded.collect():
        spot = work.filter(F.col("barcode") == F.lit(row["barcode"]))
        solved = solved.unionByName(_crowded_spot(spot, row["barcode"], row["_size"], schema))
    return solved


def _crowded_spot(spot: DataFrame, barcode, n: int, schema: str) -> DataFrame:
    """One very large spot: every annealing step is an aggregation over its cells."""
    spot = cut_lineage(spot)
    head = spot.orderBy("_h", "cell_ids").select("types", "counts").first()
    if head["types"] is None:
        return spot.select(
            "cell_ids", "barcode", F.lit(0).alias("spot_clusters"),
            F.lit(NOT_DECONVOLVED).alias("cell_type"),
        )
    share = _usable_share(list(head["counts"]), n)
    k = len(share)
    first = spot.orderBy("_h", "cell_ids").select("features").limit(k).collect()
    run = _Schedule(n, share, np.stack([np.asarray(r["features"], dtype=float) for r in first]))
    features = spot.select("features")

    def fold(step, width: int) -> np.ndarray:
        def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total = np.zeros(width)
            for batch in batches:
                if len(batch):
                    total += step(np.stack(batch["features"].to_numpy()).astype(float))
            yield pd.DataFrame({"i": np.arange(width), "v": total})

        rows = features.mapInPandas(sums, "i int, v double").groupBy("i").agg(F.sum("v").alias("v"))
        out = np.zeros(width)
        for r in rows.collect():
            out[r["i"]] = r["v"]
        return out

    while k > 1 and not run.done:
        centres, eta, beta = run.centres, run.eta, run.beta
        run.take_sizes(fold(lambda x: _partial(x, centres, eta, beta), k))
        eta, dims = run.eta, centres.shape[1]

        def centre_step(x):
            total, mass, counts = _partial_centres(x, centres, eta, beta)
            return np.concatenate([total.ravel(), mass, counts])

        flat = fold(centre_step, k * dims + 2 * k)
        run.take_centres(
            flat[: k * dims].reshape(k, dims), flat[k * dims : k * dims + k], flat[-k:]
        )
    if k == 1:
        sizes, labelled = np.array([n]), spot.withColumn("spot_clusters", F.lit(0))
    else:
        _, centres, eta, beta, last = run.best

        def label(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                x = np.stack(batch["features"].to_numpy()).astype(float)
                gap, weight = _responsibilities(x, centres, eta, beta)
                own = (weight * eta).argmax(axis=1)
                away = np.sqrt(((x[:, None, :] - last[None, :, :]) ** 2).sum(axis=2))
                yield batch[["cell_ids", "barcode", "_h"]].assign(
                    spot_clusters=own.astype(np.int32), away=list(away)
                )

        key = schema.split(",")[0] + "," + schema.split(",")[1]
        tagged = cut_lineage(
            spot.select("cell_ids", "barcode", "_h", "features").mapInPandas(
                label, key + ", _h long, spot_clusters int, away array<double>"
            )
        )
        sizes = target_sizes(share, n)
        labelled = _enforce_sizes_at_scale(tagged, sizes)
    lookup = _match_types(sizes, list(head["types"]), list(head["counts"]))
    name = F.lit(None).cast("string")
    for cluster, cell_type in lookup.items():
        name = F.when(F.col("spot_clusters") == cluster, cell_type).otherwise(name)
    return labelled.select(
        "cell_ids", "barcode", F.col("spot_clusters").cast("int").alias("spot_clusters"),
        name.alias("cell_type"),
    )


def _enforce_sizes_at_scale(tagged: DataFrame, sizes: np.ndarray) -> DataFrame:
    """The moves of ``enforce_sizes`` in rounds.

    In a round the farthest surplus cells of one oversized cluster, in order, all
    prefer their nearest undersized cluster. The moves before the first cluster
    fills up are the same as one by one; then the next round starts. A round fills
    one cluster, so there are at most clusters^2 rounds.
    """
    k = len(sizes)
    while True:
        counts = np.zeros(k, dtype=int)
        for r in tagged.groupBy("spot_clusters").count().collect():
            counts[r["spot_clusters"]] = r["count"]
        surplus = counts - sizes
        if (surplus <= 0).all():
            return tagged
        big = int(np.flatnonzero(surplus > 0)[0])
        small = [int(i) for i in np.flatnonzero(surplus < 0)]
        wish = F.array_min(F.array(*[F.struct(F.get("away", F.lit(i)), F.lit(i)) for i in small]))
        rank = F.struct(-F.get("away", F.lit(big)), F.col("_h"), F.col("cell_ids"))
        members = tagged.filter(F.col("spot_clusters") == big).select(
            "cell_ids", "away", "_h", rank.alias("_rank"), wish["col2"].alias("_to")
        )
        movers = cut_lineage(members.orderBy("_rank").limit(int(surplus[big])))
        # The first wish that overflows its cluster ends the round.
        room = {i: int(-surplus[i]) for i in small}
        stop = None
        for i in small:
            over = movers.filter(F.col("_to") == i).orderBy("_rank").limit(room[i] + 1)
            last = over.agg(F.count("*").alias("c"), F.max("_rank").alias("r")).first()
            if last["c"] > room[i] and (stop is None or tuple(last["r"]) < tuple(stop)):
                stop = last["r"]
        if stop is not None:
            edge = F.struct(*[F.lit(v) for v in stop])
            movers = movers.filter(F.col("_rank") < edge)
        moved = movers.select("cell_ids", "_to")
        tagged = cut_lineage(
            tagged.join(moved, "cell_ids", "left")
            .withColumn("spot_clusters", F.coalesce("_to", "spot_clusters"))
            .drop("_to")
        )
