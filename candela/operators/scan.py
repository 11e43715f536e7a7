"""First-order linear recurrences over ordered series, without Python.

Computes ``y_t = c_t * y_(t-1) + u_t`` (``y`` before the first row is 0) per
series, given the running log-decay ``L_t = sum(ln c_k, k <= t)`` and ``u_t``.

Unrolled, ``y_t = sum_i u_i * exp(L_t - L_i)``.  The naive closed form
``exp(L_t) * sum(u_i exp(-L_i))`` overflows after a few thousand rows, so the
series is cut into *decay blocks*: block ``b`` holds the rows with
``-L_t`` in ``[b*T, (b+1)*T)``.

* Inside a block the exponent relative to the block floor stays in
  ``(-T, 0]``, so ``local_t = exp(e_t) * sum(u_i exp(-e_i))`` is a plain
  running window sum over ``(series, block)``.
* Across blocks: a row of block ``b`` needs the value at the end of the
  previous non-empty block, which itself needs the end of the one before.
  Anything three or more blocks back is damped by more than ``exp(-2T)``
  (below 1e-55 for T = 64), far under double precision, so two look-backs
  (``last(.., ignorenulls)`` over the preceding rows) complete the recurrence.

Every step is a window over the series' own partition: no arrays, no
collection of a series into one value, no Python.  The number of blocks grows
with the total decay, not with the row count per se.

Two entry points:

* ``ewm_adjust_false``: exponential means with missing values kept in place
  (the gap-aware recurrence, through ``decayed_scan``), one span at a time;
* ``ewm_complete``: series without interior gaps, several spans sharing one
  fixed-size block layout (``block_rows`` / ``add_blocks``) and one sort.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK_DECAY = 64.0


def decayed_scan(df: DataFrame, keys: list[str], order: str, series: dict[str, tuple[str, str]],
                 block_decay: float = BLOCK_DECAY) -> DataFrame:
    """Add one column per entry of ``series`` (``out -> (log_decay, term)``):
    the recurrence defined by the running log-decay column (non-increasing
    per series) and the input column.  Each output has its own decay blocks
    (one sort each for the in-block sums); the block ends, look-backs and
    carries of all outputs share three window passes."""
    T = float(block_decay)
    w = Window.partitionBy(*keys).orderBy(order)
    before = w.rowsBetween(Window.unboundedPreceding, -1)

    def n(out: str, part: str) -> str:
        return f"_{out}_{part}"

    cols = {}
    for out, (log_decay, _term) in series.items():
        L = F.col(log_decay)
        floor_blk = F.floor(-L / F.lit(T))
        cols[n(out, "blk")] = floor_blk
        cols[n(out, "e")] = L + floor_blk * F.lit(T)
    df = df.withColumns(cols)
    locs = {}
    for out, (_log_decay, term) in series.items():
        e = F.col(n(out, "e"))
        wb = (Window.partitionBy(*keys, n(out, "blk")).orderBy(order)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
        locs[n(out, "loc")] = F.exp(e) * F.sum(F.col(term) * F.exp(-e)).over(wb)
    df = df.withColumns(locs)
    df = df.withColumns({n(out, "end"): F.coalesce(F.lead(F.col(n(out, "blk"))).over(w) != F.col(n(out, "blk")),
                                                   F.lit(True)) for out in series})
    prev = {}
    for out, (log_decay, _term) in series.items():
        end = F.col(n(out, "end"))
        prev[n(out, "prev_loc")] = F.last(F.when(end, F.col(n(out, "loc"))), ignorenulls=True).over(before)
        prev[n(out, "prev_decay")] = F.last(F.when(end, F.col(log_decay)), ignorenulls=True).over(before)
    df = df.withColumns(prev)
    df = df.withColumns({
        n(out, "yend"): F.col(n(out, "loc")) + F.coalesce(
            F.exp(F.col(log_decay) - F.col(n(out, "prev_decay"))) * F.col(n(out, "prev_loc")), F.lit(0.0))
        for out, (log_decay, _term) in series.items()})
    df = df.withColumns({n(out, "carry"): F.last(F.when(F.col(n(out, "end")), F.col(n(out, "yend"))),
                                                 ignorenulls=True).over(before) for out in series})
    df = df.withColumns({
        out: F.col(n(out, "loc")) + F.coalesce(
            F.exp(F.col(log_decay) - F.col(n(out, "prev_decay"))) * F.col(n(out, "carry")), F.lit(0.0))
        for out, (log_decay, _term) in series.items()})
    return df.drop(*[n(out, part) for out in series
                     for part in ("blk", "e", "loc", "end", "prev_loc", "prev_decay", "yend", "carry")])


def decay_terms(df: DataFrame, keys: list[str], order: str, value: str, prefix: str,
                numbered: Column | None = None) -> DataFrame:
    """Per-row observation bookkeeping shared by all spans on one column:
    row number (``numbered``, where rows count otherwise), row number of the
    first and of the previous observation, and whether any observation has been
    seen."""
    w = Window.partitionBy(*keys).orderBy(order)
    rn, obs_rn = f"{prefix}_rn", f"{prefix}_obs_rn"
    df = df.withColumn(rn, numbered if numbered is not None else F.row_number().over(w))
    df = df.withColumn(obs_rn, F.when(F.col(value).isNotNull(), F.col(rn)))
    return (
        df.withColumn(f"{prefix}_first", F.min(obs_rn).over(w.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn(f"{prefix}_last", F.last(obs_rn, ignorenulls=True).over(
            w.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn(f"{prefix}_prev", F.last(obs_rn, ignorenulls=True).over(
            w.rowsBetween(Window.unboundedPreceding, -1)))
    )


def ewm_adjust_false(df: DataFrame, keys: list[str], order: str, value: str, span: float,
                     out: str, prefix: str | None = None) -> DataFrame:
    """Exponentially weighted mean with ``alpha = 2 / (span + 1)``, no
    bias adjustment, missing values kept in place (the weight of the previous
    mean keeps decaying across a gap and is renormalised at the next
    observation), null before the first observation.

    ``y_0 = x_0``;  after ``g`` missing rows ``y = (d^(g+1) y' + a x) / (d^(g+1) + a)``
    with ``d = 1 - a``, which is ``d y' + a x`` when there is no gap."""
    return ewm_gap_aware(df, keys, order, value, {out: span}, prefix)


def ewm_gap_aware(df: DataFrame, keys: list[str], order: str, value: str, spans: dict[str, float],
                  prefix: str | None = None, values: dict[str, str] | None = None) -> DataFrame:
    """``ewm_adjust_false`` for several spans of one column at once: the
    observation bookkeeping, the renormalisation sums and the cross-block
    passes are shared.

    ``values`` names a column of its own for some outputs, present in the very
    rows where ``value`` is (a series that begins with a carried-forward mean
    has a different first value for every span).  The bookkeeping columns of
    ``decay_terms`` may be given under ``prefix``."""
    p = prefix or f"_{value}"
    values = values or {}
    have_terms = f"{p}_rn" in df.columns
    if not have_terms:
        df = decay_terms(df, keys, order, value, p)
    rn, first, last, prev = (F.col(f"{p}_{s}") for s in ("rn", "first", "last", "prev"))
    x = F.col(value)
    gap = rn - prev - F.lit(1)
    has_gap = x.isNotNull() & prev.isNotNull() & (gap > F.lit(0))
    w = Window.partitionBy(*keys).orderBy(order)
    norms = {}
    for out, span in spans.items():
        a = 2.0 / (span + 1.0)
        norms[f"_{out}_norm"] = F.pow(F.lit(1.0 - a), (gap + F.lit(1)).cast("double")) + F.lit(a)
    df = df.withColumns(norms)
    df = df.withColumns({f"_{out}_lnn": F.sum(F.when(has_gap, F.log(F.col(f"_{out}_norm"))).otherwise(F.lit(0.0)))
                         .over(w.rowsBetween(Window.unboundedPreceding, 0)) for out in spans})
    terms = {}
    for out, span in spans.items():
        a = 2.0 / (span + 1.0)
        v = F.col(values.get(out, value))
        ln_d = math.log(1.0 - a)
        terms[f"_{out}_L"] = F.coalesce((last - first).cast("double") * F.lit(ln_d) - F.col(f"_{out}_lnn"),
                                        F.lit(0.0))
        terms[f"_{out}_u"] = (F.when(x.isNull(), F.lit(0.0))
                              .when(prev.isNull(), v)
                              .when(has_gap, F.lit(a) * v / F.col(f"_{out}_norm"))
                              .otherwise(F.lit(a) * v))
    df = df.withColumns(terms)
    df = decayed_scan(df, keys, order, {out: (f"_{out}_L", f"_{out}_u") for out in spans})
    df = df.withColumns({out: F.when(last.isNotNull(), F.col(out)) for out in spans})
    df = df.drop(*[f"_{out}_{t}" for out in spans for t in ("norm", "lnn", "L", "u")])
    if not have_terms and prefix is None:
        df = drop_terms(df, p)
    return df


def drop_terms(df: DataFrame, prefix: str) -> DataFrame:
    return df.drop(*(f"{prefix}_{s}" for s in ("rn", "obs_rn", "first", "last", "prev")))



# ---------------------------------------------------------------------------
# Fast path: series without interior gaps.
# ---------------------------------------------------------------------------

def block_rows(spans: list[float], block_decay: float = 64.0, max_exponent: float = 600.0) -> int:
    """Rows per block shared by all ``spans``: every block damps the slowest
    average by at least ``exp(-block_decay)``, and the fastest one's in-block
    rescaling stays below ``exp(max_exponent)``."""
    lns = [abs(math.log(1.0 - 2.0 / (s + 1.0))) for s in spans]
    b = int(math.ceil(block_decay / min(lns)))
    if b * max(lns) > max_exponent:
        raise ValueError(f"spans {spans} too far apart to share blocks; scan them separately")
    return b


def first_present(value: str, order: str, keys: list[str]) -> Column:
    """``order`` of the first row with a present ``value``, per series."""
    return F.min(F.when(F.col(value).isNotNull(), F.col(order))).over(Window.partitionBy(*keys))


def add_blocks(df: DataFrame, keys: list[str], order: str, value: str, b: int, prefix: str,
               rn: str | None = None, first: str | None = None) -> DataFrame:
    """Per series: row number, date of the first present ``value``, block id
    and in-block position (blocks of ``b`` rows).  Existing row-number /
    first-date columns can be passed in (``rn``, ``first``) to save their
    window passes."""
    w = Window.partitionBy(*keys).orderBy(order)
    df = df.withColumns({
        f"{prefix}_rn": F.col(rn) if rn else F.row_number().over(w),
        f"{prefix}_first": F.col(first) if first else first_present(value, order, keys),
    })
    rn0 = F.col(f"{prefix}_rn") - F.lit(1)
    return df.withColumns({f"{prefix}_blk": F.floor(rn0 / F.lit(b)), f"{prefix}_j": rn0 % F.lit(b)})


def drop_blocks(df: DataFrame, prefix: str) -> DataFrame:
    return df.drop(*(f"{prefix}_{s}" for s in ("rn", "first", "blk", "j")))


def ewm_complete(df: DataFrame, keys: list[str], order: str, value: str, spans: dict[str, float],
                 prefix: str, b: int, values: dict[str, str] | None = None) -> DataFrame:
    """Exponential means (``adjust=False``) of ``value`` for several spans at
    once, for series whose values are all present from their first
    observation on (leading missing rows are allowed and give null).

    Needs the columns of ``add_blocks(.., prefix)`` with ``b`` from
    ``block_rows``.  Inside a block ``local_t = d^j * sum(u_i d^-j_i)``; the
    carry into a block is the previous block's last ``local``, damped by
    ``d^(j+1)``.  What that drops, the carry into the previous block, is
    damped by at least ``d^b <= exp(-block_decay)`` (1e-28), far below double
    precision.  So each span costs two window functions over one sort on
    (series, block, order).  A missing value after the first observation
    raises an error instead of silently taking this path.  ``values`` names a
    column of its own for some outputs, as in ``ewm_gap_aware``."""
    values = values or {}
    j, f, x, o = (F.col(f"{prefix}_j"), F.col(f"{prefix}_first"), F.col(value), F.col(order))
    started = f.isNotNull() & (o >= f)
    checked = F.when(x.isNull() & started & (o > f),
                     F.raise_error(F.lit(f"missing {value} inside a series: use the gap-aware average"))
                     ).otherwise(x)
    wo = (Window.partitionBy(*keys).orderBy(f"{prefix}_blk", order)
          .rowsBetween(Window.unboundedPreceding, -1))
    end = j == F.lit(b - 1)
    df = df.withColumn(f"{prefix}_u", checked)
    # The in-block sums as SQL text: one parsed expression per span instead of
    # a few dozen Python-built column nodes (the same arithmetic).
    q = lambda c: f"`{c}`"
    part = ", ".join(q(k) for k in [*keys, f"{prefix}_blk"])
    jj, ff, oo = q(f"{prefix}_j"), q(f"{prefix}_first"), q(order)
    locs = {}
    for out, span in spans.items():
        a = 2.0 / (span + 1.0)
        d = 1.0 - a
        uu = q(values[out]) if out in values else q(f"{prefix}_u")
        u = (f"CASE WHEN NOT ({ff} IS NOT NULL AND {oo} >= {ff}) THEN CAST(0 AS DOUBLE) "
             f"WHEN {oo} = {ff} THEN {uu} ELSE CAST({a!r} AS DOUBLE) * {uu} END")
        locs[f"_{out}_loc"] = F.expr(
            f"power(CAST({d!r} AS DOUBLE), {jj}) * sum(({u}) * power(CAST({d!r} AS DOUBLE), -{jj})) "
            f"OVER (PARTITION BY {part} ORDER BY {oo} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)")
    df = df.withColumns(locs).drop(f"{prefix}_u")
    df = df.withColumns({f"_{out}_p1": F.last(F.when(end, F.col(f"_{out}_loc")), ignorenulls=True).over(wo)
                         for out in spans})
    outs = {}
    for out, span in spans.items():
        d = 1.0 - 2.0 / (span + 1.0)
        carry = F.coalesce(F.col(f"_{out}_p1"), F.lit(0.0))
        outs[out] = F.when(started, F.col(f"_{out}_loc") + F.pow(F.lit(d), j + F.lit(1)) * carry)
    temps = [f"_{o_}_{t}" for o_ in spans for t in ("loc", "p1")]
    return df.withColumns(outs).drop(*temps)
