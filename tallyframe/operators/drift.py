"""Distribution drift between profiles: shared bins, PMFs and distances.

The reference recipe: take the shared range of two summaries, cut it into
integer bins (``range(int(lo), int(hi), int((hi - lo) / n_bins))``), read
each side's PMF at ``edges[:-1]`` and compare the two PMFs.  Here the
range comes from one min/max aggregate per side (two small rows), the
edges are a short driver-side list (about ``n_bins`` numbers), and the
PMF cells of every side come from ONE grouped aggregate over the data
(``groupBy(side, cell)``), so the data is scanned once whatever the
number of sides.  Cells are laid on a dense grid (``spark.range``) and
joined to the counts, so empty cells take part in the metrics.

Cells: m points give m+1 cells; cell i holds points[i-1] <= x < points[i]
(cell 0 is below the first point).  The reference does not say whether a
cell is closed on the left or right; this is our choice.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyframe.operators.profile import numeric_view, quote
from tallyframe.operators.ranks import finite_ends, quantile_grid

# Own choice: floor for zero shares inside the logarithms of KL and PSI.
EPSILON = 1e-9


@dataclass(frozen=True)
class Bins:
    lo: float
    hi: float
    step: float
    edges: tuple[float, ...]      # bins of the reference recipe
    integer: bool                 # False when the floored step was 0

    @property
    def points(self) -> tuple[float, ...]:
        return self.edges[:-1]

    @property
    def cells(self) -> int:
        return len(self.points) + 1


def shared_bins(lo: float, hi: float, n_bins: int) -> Bins:
    """Integer edges over [lo, hi] as the reference builds them.

    ``int()`` truncates toward zero (also for negative minima).  The
    floored step can make more than ``n_bins`` cells; a zero step (range
    narrower than ``n_bins``) makes the reference raise, we fall back to
    ``n_bins`` float cells.
    """
    if lo is None or hi is None:     # no values on any side
        lo = hi = 0.0
    width = hi / n_bins - lo / n_bins if math.isinf(hi - lo) else (hi - lo) / n_bins
    step = int(width)
    if step > 0:
        edges = tuple(float(e) for e in range(int(lo), int(hi), step))
        if len(edges) >= 2:
            return Bins(lo, hi, float(step), edges, True)
    width = width if hi > lo else 1.0
    edges = tuple(lo + j * width for j in range(n_bins + 1))
    return Bins(lo, hi, width, edges, False)


def linspace_bins(lo: float, hi: float, n_bins: int) -> Bins:
    """Overlay edges: linspace(int(lo), int(hi), int((hi - lo) / n_bins)) points.

    Here ``n_bins`` acts as a bin width, as in the reference's overlay.
    """
    a, b = int(lo), int(hi)
    num = int((hi - lo) / n_bins)
    if num < 2:
        num = 2
    step = (b - a) / (num - 1)
    edges = tuple(a + j * step for j in range(num))
    return Bins(lo, hi, step, edges, False)


def cell_of(x: Column, bins: Bins) -> Column:
    """Number of points <= x, by arithmetic on the equal step (stays in codegen)."""
    m = len(bins.points)
    p0 = bins.points[0]
    steps = (x - F.lit(p0)) / F.lit(bins.step) if math.isfinite(bins.hi - bins.lo) else x / F.lit(bins.step) - F.lit(p0 / bins.step)
    k = F.least(F.floor(steps), F.lit(m - 1)) + 1
    return F.when(x < F.lit(p0), F.lit(0)).otherwise(k).cast("int")


def side_ranges(df: DataFrame, column: str, side: Column) -> DataFrame:
    """Range of each side's finite values; infinite ones fall into the end cells."""
    x = numeric_view(F.col(quote(column)))
    finite = F.when(F.abs(x) < float("inf"), x)
    return df.groupBy(side.alias("side")).agg(F.min(finite).alias("lo"), F.max(finite).alias("hi"))


def range_of(df: DataFrame, column: str, side: Column) -> tuple[float, float]:
    """Shared range of all sides: least of the minima, greatest of the maxima."""
    r = side_ranges(df, column, side).agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).first()
    return r["lo"], r["hi"]


def cell_table(df: DataFrame, column: str, side: Column, bins: Bins, sides=None) -> DataFrame:
    """Dense long table (side, cell, count, pmf) for the given side labels.

    One grouped aggregate over the data; the grid of sides x cells is
    generated from the (short) side list and the cell count, not joined.
    Without a list the sides are all labels of the data, which stay on the executors
    (a label without values has count 0 and no shares).
    """
    x = numeric_view(F.col(quote(column)))
    counts = (df.filter(x.isNotNull())
              .groupBy(side.alias("side"), cell_of(x, bins).alias("cell"))
              .agg(F.count(F.lit(1)).alias("n")))
    if sides is None:
        every = F.sequence(F.lit(0), F.lit(bins.cells - 1))
        grid = df.select(side.alias("side")).filter(F.col("side").isNotNull()).distinct().select("side", F.explode(every).alias("cell"))
    else:
        grid = df.sparkSession.range(0, bins.cells).select(
            F.explode(F.array(*[F.lit(str(s)) for s in sides])).alias("side"),
            F.col("id").cast("int").alias("cell"))
    dense = grid.join(counts, ["side", "cell"], "left").select(
        "side", "cell", F.coalesce("n", F.lit(0)).cast("bigint").alias("count"))
    # Each side has ``cells`` rows (about n_bins): bounded windows.
    total = F.sum("count").over(Window.partitionBy("side"))
    return dense.select("side", "cell", "count", F.try_divide("count", total).alias("pmf"))


def pair(cells_long: DataFrame, a: str, b: str) -> DataFrame:
    """(cell, na, nb, p, q): reference side ``a`` and target side ``b`` side by side."""
    g = cells_long.groupBy("cell").agg(
        F.sum(F.when(F.col("side") == a, F.col("count"))).alias("na"),
        F.sum(F.when(F.col("side") == b, F.col("count"))).alias("nb"),
        F.sum(F.when(F.col("side") == a, F.col("pmf"))).alias("p"),
        F.sum(F.when(F.col("side") == b, F.col("pmf"))).alias("q"))
    return g


def metrics(cells: DataFrame, n_bins: int) -> DataFrame:
    """All distances of side ``b`` from reference side ``a`` in one row.

    * ``intersection``: sum of min(p, q) over all cells; ``intersection_ref``
      over the first ``n_bins`` cells only (the reference loop's range).
    * ``kl``: sum over p > 0 of p ln(p / max(q, eps)).
    * ``psi``: sum of (p - q) ln(max(p, eps) / max(q, eps)).
    * ``ks``: max |P(x) - Q(x)| of the cumulative shares.
    * ``mutual_info``: the reference's "K-L" call: mutual information of the
      two PMF vectors taken as label sequences (cells are the samples).
    """
    eps = F.lit(EPSILON)
    both = F.col("p").isNotNull() & F.col("q").isNotNull()   # a side without values has no shares
    # ``cells`` has one row per cell (about n_bins): a bounded running window.
    w = Window.partitionBy(F.lit(0)).orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)
    c = cells.select("cell", "na", "nb", "p", "q",
                     F.sum("p").over(w).alias("cp"), F.sum("q").over(w).alias("cq"),
                     _mi_term().alias("mi_term"))
    base = c.agg(
        F.sum(F.when(both, F.least("p", "q"))).alias("intersection"),
        F.sum(F.when(both & (F.col("cell") < n_bins), F.least("p", "q"))).alias("intersection_ref"),
        F.sum(F.when(both & (F.col("p") > 0), F.col("p") * F.ln(F.col("p") / F.greatest("q", eps))))
        .alias("kl"),
        F.sum((F.col("p") - F.col("q")) * F.ln(F.greatest("p", eps) / F.greatest("q", eps)))
        .alias("psi"),
        F.max(F.abs(F.col("cp") - F.col("cq"))).alias("ks"),
        F.sum("mi_term").alias("mutual_info"),
        F.count(F.lit(1)).alias("cells"))
    return base.select("cells", "intersection", "intersection_ref", "kl", "psi", "ks",
                       "mutual_info")


def _mi_term() -> Column:
    """Each cell's share of the mutual information of the label sequences.

    A pair of labels (na, nb) shared by n_ij cells contributes
    n_ij/N ln(N n_ij / (a_i b_j)); spread over its cells that is
    1/N ln(N n_ij / (a_i b_j)) per cell, with the counts taken by windows
    over the (bounded) cell table, so no join is needed.
    """
    one = F.lit(1)
    n_all = F.count(one).over(Window.partitionBy(F.lit(0)))
    nij = F.count(one).over(Window.partitionBy("na", "nb"))
    ai = F.count(one).over(Window.partitionBy("na"))
    bj = F.count(one).over(Window.partitionBy("nb"))
    return F.ln(n_all * nij / (ai * bj)) / n_all


def two_sided(df: DataFrame, column: str, side: Column, n_bins: int,
              sides=("reference", "target")):
    """Bins and the dense (cell, na, nb, p, q) table of a two-sided split."""
    lo, hi = range_of(df, column, side)
    bins = shared_bins(lo, hi, n_bins)
    cells = pair(cell_table(df, column, side, bins, sides), *sides)
    return bins, cells


def binned_scatter(df: DataFrame, x: str, y: str, bins: int = 20) -> DataFrame:
    """2-D equal-width binned counts of (x, y): the data behind a scatter plot."""
    from tallyframe.operators.stats import equal_width_bin, min_max
    xlo, xhi = min_max(df, x)
    ylo, yhi = min_max(df, y)
    xc, yc = numeric_view(F.col(quote(x))), numeric_view(F.col(quote(y)))
    if None in (xlo, xhi, ylo, yhi):
        xlo = xhi = ylo = yhi = 0.0
    return (df.filter(xc.isNotNull() & yc.isNotNull())
            .groupBy(equal_width_bin(xc, xlo, xhi, bins).alias("bin_x"),
                     equal_width_bin(yc, ylo, yhi, bins).alias("bin_y"))
            .agg(F.count(F.lit(1)).alias("count")))


def compare(profiles_a: DataFrame, profiles_b: DataFrame, column: str, n_bins: int = 20):
    """Drift of profile ``b`` from profile ``a``, from their stored rows alone.

    The shared range comes from the two summaries, the PMFs from the two KLL
    sketches at the shared points; returns (bins, one row of ``metrics``).
    Each side must be one profile of the column (merge grouped profiles
    first).  An infinite end is replaced by the sketch's nearest finite quantile.  A side without values has null PMFs and so null metrics.
    """
    rows_a, rows_b = (p.filter(F.col("column") == column) for p in (profiles_a, profiles_b))
    lo, hi = finite_ends(quantile_grid(F.col("kll")), F.col("min"), F.col("max"))
    ends = [rows.filter(F.col("n") > 0).select(lo.alias("lo"), hi.alias("hi")) for rows in (rows_a, rows_b)]
    r = ends[0].unionByName(ends[1]).agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).first()
    bins = shared_bins(r["lo"], r["hi"], n_bins)
    # sketch ranks count x <= p: points just below the edges give the cells p_i <= x < p_i+1
    points = [math.nextafter(p, -math.inf) for p in bins.points]
    grid = profiles_a.sparkSession.range(0, bins.cells).select(F.col("id").cast("int").alias("cell"))

    def side(rows, share, count):
        n = rows.agg(F.sum("n").alias("n")).select(F.coalesce("n", F.lit(0)).alias("n")).first()["n"]
        pmf = sketch_pmf(rows, points).select("cell", F.col("pmf").alias(share))
        return pmf.withColumn(count, F.round(F.col(share) * F.lit(n)).cast("bigint"))

    cells = (grid.join(side(rows_a, "p", "na"), "cell", "left").join(side(rows_b, "q", "nb"), "cell", "left")
             .select("cell", "na", "nb", "p", "q"))
    return bins, metrics(cells, n_bins)


def sketch_pmf(profile_rows: DataFrame, points) -> DataFrame:
    """PMF from each profile's KLL sketch at the given points (rank differences).

    KLL ranks count x <= p, so sketch cells are (p_i-1, p_i]; on discrete
    data pass points just below the integer edges for the exact twin's cells.
    """
    pts = F.array(*[F.lit(float(p)) for p in points])
    ranks = F.call_function("kll_sketch_get_rank_double", F.col("kll"), pts)
    cum = F.concat(F.array(F.lit(0.0)), ranks, F.array(F.lit(1.0)))
    cells = F.transform(F.sequence(F.lit(1), F.lit(len(points) + 1)),
                        lambda j: F.element_at(cum, j + 1) - F.element_at(cum, j))
    keys = [k for k in ("name", "dataset_timestamp", "tags") if k in profile_rows.columns]
    return (profile_rows.filter(F.col("kll").isNotNull() & (F.col("n") > 0))
            .select(*keys, "column", F.posexplode(cells).alias("cell", "pmf")))
