"""Career relations over the appearance fact table.

Input: a DataFrame with the ``schemas.APPEARANCES`` columns (extra columns are
ignored).  ``A`` below is the appearances with ``tookPart = True``; a *span* is
the first and last active year of one driver at one constructor.

Scale notes
-----------
* Raw appearances only ever meet a ``groupBy`` (partial aggregation runs
  before the shuffle, so a driver with a third of all rows is combined
  map-side) or an equi-join on ``(driverId, year)``; AQE splits a hot key of
  the big side of such a join.
* Every pair relation is built from spans, which are unique per
  ``(driverId, constructorId)``.  Transfers use an equi-join on
  ``(driverId, year)`` instead of ``driverId`` plus an OR residual, and gap
  pairs evaluate their range condition on distinct years only, so the work
  is proportional to the output, not to spans² of a driver.
* ``breaks`` never materialises the break/return pairs: the nearest earlier
  span end is a running max over the distinct (driverId, year) rows (an as-of
  lookup whose window is bounded by the period domain), then joined on
  ``(driverId, year)``.
* Global maxima are scalar subqueries (one row, computed once).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stintwise.functions.columns import is_active
from stintwise.schemas import TRANSFER_COLUMNS
from stintwise.session import materialize

D, C, Y = "driverId", "constructorId", "year"
N = "_n"            # how many equal appearances a row of ``yearly_entries`` stands for
_BLOCK = 4096


def active(a: DataFrame) -> DataFrame:
    """FLT-1: appearances that took part."""
    return a.filter(is_active())


def with_names(relation: Callable[..., DataFrame], rows: DataFrame, *args, entity: str = D, group: str = C,
               period: str = Y, active: str = "tookPart", **options) -> DataFrame:
    """A relation of this module over a table with column names of its own.

    ``with_names(breaks, staff, entity="person", group="team", period="season", active="played", midseason=True)``:
    the four columns are renamed on the way in, entity and group are renamed back in the
    result; further columns of ``rows`` are not read.
    """
    a = rows.select(F.col(entity).alias(D), F.col(group).alias(C), F.col(period).alias(Y),
                    F.col(active).alias("tookPart"))
    return relation(a, *args, **options).withColumnsRenamed({D: entity, C: group})


def latest_year(a: DataFrame) -> Column:
    """AG-4: ``(SELECT MAX(year) FROM a)`` over *all* appearances."""
    return a.select(F.max(Y)).scalar()


def spans(a: DataFrame) -> DataFrame:
    """AG-3: first and last active year per (driver, constructor)."""
    return (active(a).groupBy(D, C)
            .agg(F.min(Y).alias("first_year"), F.max(Y).alias("last_year")))


def shared_spans(a: DataFrame) -> DataFrame:
    """Spans written once (parquet, shared checkpoint folder) for relations reading them 2-5 times.

    Column pruning gives each consumer a different plan, so Spark cannot
    reuse the span shuffle; without this, every consumer re-runs the scan and
    joins behind ``a``.  Spans have at most one row per (driver, constructor)
    and four narrow columns, and a table on shared storage survives lost
    executors.
    """
    return materialize(spans(a), "spans")


def debut_years(a: DataFrame) -> DataFrame:
    """Q-1: per driver, the first active year."""
    return active(a).groupBy(D).agg(F.min(Y).alias("debut_year")).select("debut_year", D)


def debuts(a: DataFrame, s: DataFrame | None = None) -> DataFrame:
    """Q-2: debut year joined back to *all* appearances of that driver and year.

    Duplicated entries stay duplicated and test entries of the debut year are
    kept, as in the reference.  With materialised spans ``s`` the debut year is
    the smallest span start; without them ``a`` is read once, by ``yearly_entries``,
    which ``a`` may be itself.
    """
    if s is None and N not in a.columns:
        a = yearly_entries(a)
    if s is None:
        first = active(a).groupBy(D).agg(F.min(Y).alias(Y))
    else:
        first = s.groupBy(D).agg(F.min("first_year").alias(Y))
    if N in a.columns:
        return _each(a.select(D, C, Y, N).join(first, [D, Y], "inner"), D, C, Y).select(
            D, C, F.col(Y).alias("debut_year"))
    return (a.select(D, C, Y).join(first, [D, Y], "inner")
            .select(D, C, F.col(Y).alias("debut_year")))


def yearly_entries(a: DataFrame) -> DataFrame:
    """One pass over the fact table: counted (driver, constructor, year, tookPart), written once.

    Equal appearances are combined map-side.  The retirement relations (Q-3..Q-5) read
    maxima, lists and rows from this table instead of scanning ``a`` again for each of
    them; spans and debuts may read it too.
    """
    return materialize(count_entries(a), "yearly-entries")


def count_entries(a: DataFrame) -> DataFrame:
    """Appearances as counted (driver, constructor, year, tookPart); counts of parts of a table add up."""
    return a.groupBy(D, C, Y, "tookPart").agg(F.count(F.lit(1)).alias(N))


def _each(rows: DataFrame, *cols: str) -> DataFrame:
    """``cols`` of every row as often as its count says.

    Counts above ``_BLOCK`` are cut into blocks that are dealt out anew, so the copies of
    one frequent appearance do not come from one task; all others are repeated where
    they lie.  The filter on the count reaches the scan of the counted table.
    """
    def repeated(part: DataFrame, times: Column) -> DataFrame:
        return part.select(*cols, F.explode(F.array_repeat(F.lit(0), times.cast("int"))).alias("_copy")).drop("_copy")

    blocks = (rows.where(F.col(N) > _BLOCK)
              .select(*cols, N, F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"({N} - 1) div {_BLOCK}")))
                      .alias("_block"))
              .repartition(*cols, "_block"))
    few = rows.where(F.col(N) <= _BLOCK)
    return repeated(few, F.col(N)).unionByName(
        repeated(blocks, F.least(F.lit(_BLOCK), F.col(N) - F.col("_block") * _BLOCK)))


def last_seen_before_max(a: DataFrame, e: DataFrame | None = None) -> DataFrame:
    """Q-3: per driver the last active year, kept when below the latest year."""
    e = yearly_entries(a) if e is None else e
    return (active(e).groupBy(D).agg(F.max(Y).alias("retirement_year"))
            .filter(F.col("retirement_year") < latest_year(e))
            .select("retirement_year", D))


def retirements(a: DataFrame, e: DataFrame | None = None) -> DataFrame:
    """Q-4: Q-3 joined back to all appearances of that driver and year."""
    e = yearly_entries(a) if e is None else e
    last = last_seen_before_max(a, e).withColumnRenamed("retirement_year", Y)
    return _each(e.select(D, C, Y, N).join(last, [D, Y], "inner"), D, C, Y).select(
        D, C, F.col(Y).alias("retirement_year"))


def announced_only(a: DataFrame) -> DataFrame:
    """Drivers listed in the latest season without taking part (``tookPart = False``)."""
    return a.filter((F.col(Y) == latest_year(a)) & (F.col("tookPart") == F.lit(False))).select(D)


def filter_not_in(df: DataFrame, key: str, values: DataFrame, value_col: str) -> DataFrame:
    """FLT-4: rows of ``df`` whose ``key`` is NOT IN ``values.value_col`` (null-aware).

    The distinct list is written once, so the join and the two guards (empty
    list, null in list) read it instead of recomputing ``values`` three times.
    """
    listed = materialize(values.select(F.col(value_col).alias(value_col)).distinct(), "not-in")
    return (flag_listed(df, key, listed, value_col)
            .filter(not_in(key, listed, value_col)).drop("_listed"))


def not_in(key: str, values: DataFrame, value_col: str) -> Column:
    """FLT-4 / JN-7 helper: a Column equal to SQL ``key NOT IN (SELECT value_col FROM values)``.

    Three-valued: true when the list is empty; unknown (false in a filter) when
    ``key`` is null, or when it is absent but the list holds a null.  The
    filtered DataFrame must already carry ``_listed`` from ``flag_listed``.
    """
    n_all = values.select(F.count(F.lit(1))).scalar()
    n_null = values.select(F.count(F.lit(1)) - F.count(value_col)).scalar()
    return ((n_all == 0)
            | (F.col(key).isNotNull() & F.col("_listed").isNull() & (n_null == 0)))


def flag_listed(df: DataFrame, key: str, values: DataFrame, value_col: str) -> DataFrame:
    """Left-join a distinct key list so ``_listed`` is true for members, null otherwise."""
    keys = (values.filter(F.col(value_col).isNotNull()).select(F.col(value_col).alias(key))
            .distinct().withColumn("_listed", F.lit(True)))
    return df.join(keys, key, "left")


def year_summary(e: DataFrame) -> DataFrame:
    """One row per year with the announced-only counts of ``yearly_entries``, written once (tiny: years).

    The latest and second-latest year and the NOT IN guards all read this.
    """
    announced = F.col("tookPart") == F.lit(False)
    return materialize(
        e.groupBy(Y).agg(F.count_if(announced).alias("n_announced"),
                         F.count_if(announced & F.col(D).isNull()).alias("n_announced_null")),
        "year-summary")


def second_latest_year(ys: DataFrame) -> DataFrame:
    """FLT-3: the largest year below the latest one (null if there is none), from one row per year."""
    return ys.filter(F.col(Y) < latest_year(ys)).agg(F.max(Y).alias("second_latest_year"))


def retirements_announced(a: DataFrame, e: DataFrame | None = None) -> DataFrame:
    """Q-5: retirements where the latest season may be announced only.

    ``ry`` is the last active year below the latest year; the row is kept when
    ``ry`` is below the second-latest year, or the driver is NOT IN the
    announced-only list of the latest season.  The NOT IN under OR becomes a
    left join to the distinct list plus a null-aware flag, not a nested loop.
    The fact table is read once, by ``yearly_entries``.
    """
    e = yearly_entries(a) if e is None else e
    ys = year_summary(e)
    mx = latest_year(ys)
    second = second_latest_year(ys).scalar()
    latest = ys.filter(F.col(Y) == mx)
    n_all = latest.select(F.coalesce(F.sum("n_announced"), F.lit(0))).scalar()
    n_null = latest.select(F.coalesce(F.sum("n_announced_null"), F.lit(0))).scalar()
    act = active(e.filter(F.col(Y) < mx))
    last = act.groupBy(D).agg(F.max(Y).alias(Y))
    rows = act.select(D, C, Y, N).join(last, [D, Y], "inner")
    announced = e.filter((F.col(Y) == mx) & (F.col("tookPart") == F.lit(False))).select(D)
    flagged = flag_listed(rows, D, announced, D)
    listed_out = F.col(D).isNotNull() & F.col("_listed").isNull() & (n_null == 0)
    keep = (F.col(Y) < second) | (n_all == 0) | listed_out
    return _each(flagged.filter(keep), D, C, Y).select(D, C, F.col(Y).alias("retirement_year"))


def retirements_top(a: DataFrame, n: int = 1500) -> DataFrame:
    """LIM-1: the first ``n`` rows of Q-5 in a defined order (the reference's show(1500))."""
    return (retirements_announced(a)
            .orderBy("retirement_year", D, C).limit(n))


def _out_side(s: DataFrame) -> DataFrame:
    return s.select(D, F.col(C).alias("const_out"), F.col("last_year").alias("transfer_out"))


def _in_side(s: DataFrame) -> DataFrame:
    return s.select(D, F.col(C).alias("const_in"), F.col("first_year").alias("transfer_in"))


def transfers_consecutive(a: DataFrame, s: DataFrame | None = None) -> DataFrame:
    """Q-6: span pairs of one driver with ``out.last = in.first - 1``.

    Equi-join on (driverId, year); different constructors follow because a
    span cannot end the year before it starts.
    """
    s = spans(a) if s is None else s
    out = _out_side(s).withColumn("_k", F.col("transfer_out"))
    inn = _in_side(s).withColumn("_k", F.col("transfer_in") - 1)
    return out.join(inn, [D, "_k"], "inner").select(*TRANSFER_COLUMNS)


def transfers_with_midseason(a: DataFrame, s: DataFrame | None = None) -> DataFrame:
    """Q-7: Q-6 plus same-year moves ``out.last = in.first`` to another constructor.

    JN-3's OR residual is rewritten exactly: each in-span offers the two years
    it can be reached from (first-1, first), so the join is a pure equi-join on
    (driverId, year) with the ``const_out != const_in`` residual.
    """
    s = spans(a) if s is None else s
    out = _out_side(s).withColumn("_k", F.col("transfer_out"))
    inn = _in_side(s).withColumn(
        "_k", F.explode(F.array(F.col("transfer_in") - 1, F.col("transfer_in"))))
    return (out.join(inn, [D, "_k"], "inner")
            .filter(F.col("const_out") != F.col("const_in"))
            .select(*TRANSFER_COLUMNS))


def transfer_ends(s: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The out-spans and in-spans that take part in a Q-7 transfer, without forming the pairs.

    A span is kept if it has at least one partner, so the work follows the spans
    and not the pairs of a (driver, year).
    """
    out, inn = _out_side(s), _in_side(s)
    reach = out.withColumn("_k", F.explode(F.array(F.col("transfer_out"), F.col("transfer_out") + 1))).alias("o")
    starts = inn.withColumn("_k", F.col("transfer_in")).alias("i")
    from_ends = inn.withColumn("_k", F.explode(F.array(F.col("transfer_in") - 1, F.col("transfer_in")))).alias("i")
    ends = out.withColumn("_k", F.col("transfer_out")).alias("o")
    partner = ((F.col("o.driverId") == F.col("i.driverId")) & (F.col("o._k") == F.col("i._k"))
               & (F.col("o.const_out") != F.col("i.const_in")))
    return (reach.join(starts, partner, "left_semi").drop("_k"),
            from_ends.join(ends, partner, "left_semi").drop("_k"))


def transfers_of_driver(a: DataFrame, driver_id: str) -> DataFrame:
    """Q-12 / FLT-6: Q-7 for one driver.

    The filter is applied before the spans, so on a stored fact table it is a
    pushed parquet filter and only that driver's rows are aggregated, once.
    """
    a = a.filter(F.col(D) == F.lit(driver_id))
    return transfers_with_midseason(a, shared_spans(a))


def gap_pairs(a: DataFrame, s: DataFrame | None = None) -> DataFrame:
    """Q-8: span pairs of one driver with ``out.last < in.first - 1``.

    The range condition runs on distinct years only (see ``_gap_join``).  The
    reference's GROUP BY is a no-op here (spans are unique per constructor,
    so a pair is unique per (driver, const_out, const_in)) and is not planned.
    """
    s = spans(a) if s is None else s
    return _gap_join(_break_side(s), _return_side(s))


def _break_side(s: DataFrame) -> DataFrame:
    return s.filter(F.col(D).isNotNull()).select(
        D, F.col(C).alias("const_out"), F.col("last_year").alias("break_year"))


def _return_side(s: DataFrame) -> DataFrame:
    return s.filter(F.col(D).isNotNull()).select(
        D, F.col(C).alias("const_in"), F.col("first_year").alias("return_year"))


def _gap_join(out: DataFrame, inn: DataFrame) -> DataFrame:
    """Pairs (out-span, in-span) of one driver with ``break_year < return_year - 1``.

    The range condition is evaluated on the distinct (driver, year) values of
    each side only - at most (periods)^2 per driver, whatever the number of
    groups a driver had - and the spans are attached by equi-joins on
    (driverId, year), so work beyond that follows the output.
    """
    end_years = out.select(D, "break_year").distinct()
    start_years = inn.select(D, "return_year").distinct()
    e, r = end_years.alias("e"), start_years.alias("r")
    cond = (F.col("e.driverId") == F.col("r.driverId")) & (
        F.col("e.break_year") < F.col("r.return_year") - 1)
    year_pairs = e.join(r, cond, "inner").select(F.col("e.driverId").alias(D), "break_year",
                                                 "return_year")
    return (year_pairs.join(out, [D, "break_year"], "inner")
            .join(inn, [D, "return_year"], "inner")
            .select(D, "const_out", "break_year", "const_in", "return_year",
                    (F.col("return_year") - F.col("break_year")).alias("gap")))


def unexplained_returns(s: DataFrame, midseason: bool) -> DataFrame:
    """In-spans that are not the arrival of a transfer (JN-5 at span level).

    The reference anti-joins on (driver, const_in, return_year) against the
    transfer relation; the transfer arrivals are exactly the in-spans with a
    matching out-span, so two anti-joins on (driverId, year) give the same
    set.  A null constructor never equals a transfer key, so it always stays.
    """
    inn = _return_side(s)
    ends = s.filter(F.col(D).isNotNull()).select(
        D, F.col(C).alias("_c_out"), F.col("last_year").alias("_end"))
    e = ends.alias("e")

    def drop_arrivals(kept: DataFrame, lag: int) -> DataFrame:
        k = kept.alias("k")
        cond = ((F.col("k.driverId") == F.col("e.driverId"))
                & (F.col("e._end") == F.col("k.return_year") - lag))
        if midseason:
            # Q-7 rows need const_out != const_in (so both non-null).
            cond = cond & (F.col("e._c_out") != F.col("k.const_in"))
        else:
            # Q-6 rows match the anti-join only through a non-null const_in.
            cond = cond & F.col("k.const_in").isNotNull()
        return k.join(e, cond, "left_anti").select(D, "const_in", "return_year")

    kept = drop_arrivals(inn, 1)
    if midseason:
        kept = drop_arrivals(kept, 0)
    return kept


def gaps_unexplained(a: DataFrame, midseason: bool = False,
                     s: DataFrame | None = None) -> DataFrame:
    """Q-9: gap pairs whose return is not the arrival of a transfer.

    ``midseason`` picks the explaining relation: Q-6 (script) or Q-7 (notebook).
    The anti-join runs on spans before the range join, so fewer pairs form.
    """
    s = spans(a) if s is None else s
    return _gap_join(_break_side(s), unexplained_returns(s, midseason))


def _nearest_ends(s: DataFrame, midseason: bool) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Returns, span ends, and per (driver, return year) the latest end >= 2 years earlier.

    The as-of lookup runs over *distinct* (driver, year) rows only, so a
    window partition holds at most two rows per period of one driver - its
    size is bounded by the period domain, not by rows or by the driver's
    number of groups.  Null keys drop out as in the reference's equality
    self-joins.
    """
    returns = (unexplained_returns(s, midseason)
               .filter(F.col("const_in").isNotNull() & F.col("return_year").isNotNull()))
    ends = _break_side(s).filter(F.col("break_year").isNotNull())
    end_years = ends.select(D, F.col("break_year").alias("_y")).distinct() \
        .withColumn("_end", F.col("_y"))
    return_years = returns.select(D, F.col("return_year").alias("_y")).distinct() \
        .withColumn("_end", F.lit(None).cast("int"))
    w = Window.partitionBy(D).orderBy("_y").rangeBetween(Window.unboundedPreceding, -2)
    nearest = (end_years.unionByName(return_years)
               .withColumn("break_year", F.max("_end").over(w))
               .filter(F.col("_end").isNull() & F.col("break_year").isNotNull())
               .select(D, F.col("_y").alias("return_year"), "break_year"))
    return returns, ends, nearest


def _with_gap(df: DataFrame) -> DataFrame:
    return df.select(D, "const_out", "break_year", "const_in", "return_year",
                     (F.col("return_year") - F.col("break_year")).alias("gap"))


def breaks_nearest_return(a: DataFrame, midseason: bool = False,
                          s: DataFrame | None = None) -> DataFrame:
    """Q-10: of Q-9, per (driver, const_in, return_year) the pairs with minimal gap.

    The minimal gap of a return is the one to the latest span end at least two
    years earlier (an as-of lookup, no pair set); joins on (driverId, year)
    then attach the return's constructors and every span ending that year
    (ties kept).
    """
    s = spans(a) if s is None else s
    returns, ends, nearest = _nearest_ends(s, midseason)
    return _with_gap(returns.join(nearest, [D, "return_year"], "inner")
                     .join(ends, [D, "break_year"], "inner"))


def breaks(a: DataFrame, midseason: bool = False, s: DataFrame | None = None) -> DataFrame:
    """Q-11: of Q-10, per (driver, const_out, break_year) the pairs with minimal gap.

    Every return whose nearest end is year ``y`` pairs with every span ending
    in ``y``, so the minimal gap of an out-span is reached by the earliest
    return year mapped to ``y`` - a partial aggregate per (driver, year)
    instead of a window over pairs.
    """
    s = spans(a) if s is None else s
    returns, ends, nearest = _nearest_ends(s, midseason)
    first = _first_returns(nearest)
    return _with_gap(returns.join(first, [D, "return_year"], "inner")
                     .join(ends.filter(F.col("const_out").isNotNull()), [D, "break_year"], "inner"))


def _first_returns(nearest: DataFrame) -> DataFrame:
    return nearest.groupBy(D, "break_year").agg(F.min("return_year").alias("return_year"))


def break_ends(s: DataFrame, midseason: bool = False) -> tuple[DataFrame, DataFrame]:
    """The out-spans and returns that take part in a Q-11 break, without forming the pairs."""
    returns, ends, nearest = _nearest_ends(s, midseason)
    ends = ends.filter(F.col("const_out").isNotNull())
    first = _first_returns(nearest).join(ends, [D, "break_year"], "left_semi")
    return (ends.join(first, [D, "break_year"], "left_semi"),
            returns.join(first, [D, "return_year"], "left_semi"))
