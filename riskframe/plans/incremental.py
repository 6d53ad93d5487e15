"""High-water marks and the incremental loads built on them.

Watermarks are read as uncorrelated scalar subqueries (with the default folded
inside, so the date filter is pushed to the Parquet scan at run time) and
advanced with the same upsert as every other table.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import date_lit
from ..operators import advanced as adv
from ..operators import metrics as met
from ..operators import positions as pos
from ..operators import prices as prc
from ..functions.windows import ordered, running
from ..schemas import as_double
from ..sources.files import folder_names
from . import changes
from .store import Store

EPOCH = "0001-01-01"
ADVANCED = "portfolio_advanced:"   # and the benchmark: source of the advanced metrics' watermark


def _partitioning(table: str) -> tuple:
    from ..schemas import TABLES
    return TABLES[table].partition_by


def watermark(meta: DataFrame, source: str) -> DataFrame:
    """One-row frame [last_loaded_date]; null when the source has none."""
    return meta.filter(F.col("source") == source).agg(F.max("last_loaded_date").alias("last_loaded_date"))


def watermark_value(meta: DataFrame, source: str, default=EPOCH) -> Column:
    """I1 as a scalar subquery with the default inside it."""
    return meta.filter(F.col("source") == source).select(
        F.coalesce(F.max("last_loaded_date"), date_lit(default))).scalar()


def new_rows(df: DataFrame, meta: DataFrame, source: str, date_col: str = "date") -> DataFrame:
    """C4: rows strictly after the source's watermark (all rows when it has none)."""
    return df.filter(F.col(date_col) > watermark_value(meta, source))


def batch_max(df: DataFrame, date_col: str = "date") -> DataFrame:
    """The batch's max date, the next watermark."""
    return df.agg(F.max(date_col).alias("last_loaded_date"))


def watermark_updates(source: str, last_date) -> DataFrame:
    """Rows for I2: from a one-row frame (e.g. ``batch_max``; a null max -> no row) or a value."""
    if isinstance(last_date, DataFrame):
        d = last_date.select(F.col(last_date.columns[0]).alias("last_loaded_date"))
    else:
        from pyspark.sql import SparkSession
        d = SparkSession.active().range(1).select(date_lit(last_date).alias("last_loaded_date"))
    return d.filter(F.col("last_loaded_date").isNotNull()).select(
        F.lit(source).alias("source"), "last_loaded_date", F.current_timestamp().alias("_updated_at"))


def set_watermark(store: Store, source: str, last_date) -> DataFrame:
    """Upsert (source, last_loaded_date) and refresh _updated_at."""
    return store.upsert("load_metadata", watermark_updates(source, last_date))


def advance_watermark(store: Store, source: str, table: str, date_col: str = "date") -> DataFrame:
    """Watermark := max(date) stored in ``table`` when that is newer (lazy: no
    value passes through the driver; an unchanged max writes nothing new)."""
    meta = store.read("load_metadata")
    current = watermark_value(meta, source)
    # only partitions at or after the current watermark's month can hold a newer max
    recent = F.col("month") >= store.month_of(current) if "month" in _partitioning(table) else None
    top = store.read(table, where=recent).agg(F.max(date_col).alias("d"))
    newer = top.filter(F.col("d") > current)
    return set_watermark(store, source, newer)


def load_feed(store: Store, feed: DataFrame, table: str, source: str, clean=None, date_col: str = "date",
              advance: bool = True, late: bool = False) -> DataFrame:
    """Rows newer than the watermark -> clean -> upsert into ``table`` ->
    watermark = the max date loaded. An empty batch changes nothing. Without
    ``advance`` the watermark stays, so that a later run reads the same dates again.
    With ``late`` rows of any date are merged where their key is not stored yet (stored
    rows stay), for feeds whose entities do not arrive in one order of dates."""
    batch = feed if late else new_rows(feed, store.read("load_metadata"), source, date_col)
    if clean is not None:
        batch = clean(batch)
    out = store.upsert(table, batch, update_cols=[] if late else None, insert_defaults={"_ingested_at": F.current_timestamp()})
    if advance:
        advance_watermark(store, source, table, date_col)
    return out


def _next_day(store: Store, source: str, default=EPOCH) -> Column:
    """The day after a source's watermark, as a scalar."""
    return F.date_add(watermark_value(store.read("load_metadata"), source, default), 1)


def build_prices(store: Store, default_start: str = "2025-01-01", pair: str = "USDGBP",
                 history: str = "window", lookback_days: int = 120) -> DataFrame:
    """FACT_PRICES, merged on (symbol, date): the days after the
    'fact_prices' watermark of every symbol, and those from the first changed
    day on (equities, FX rate, names) of a symbol that changed earlier. The
    watermark becomes the max date written (not today).

    The equity scan is bounded: month partitions of the last ``lookback_days``
    before the first day to compute, plus the older rows of symbols with too
    little recent history for their windows (with no such symbol no older
    month is read). The table equals the full-history recompute
    whatever order the rows came in. ``history='increment'`` computes the
    windows over the rows to compute alone.
    """
    new = changes.pending(store, "fact_prices")
    fx = as_double(store.read("fx_daily"))
    first_ever = F.date_add(date_lit(default_start), 1)
    rate_since = new.since("fx_daily").filter(F.col("pair") == pair).agg(F.min("since")).scalar()
    start = F.greatest(first_ever, F.least(_next_day(store, "fact_prices", default_start), rate_since))
    since = (new.since("equity_daily").unionByName(new.since("dim_symbol")).groupBy("symbol")
             .agg(F.greatest(F.min("since"), first_ever).alias("since")))
    late, first = changes.earlier(store, since, start)
    back = 0 if history == "increment" else lookback_days
    since_day = F.date_sub(first, back)
    recent = changes.from_first(as_double(store.read("equity_daily", where=(F.col("month") >= store.month_of(since_day))
                                                     & (F.col("date") >= since_day))), late, start)
    base = recent.filter(F.col("date") >= F.date_sub("_from", back))
    if history == "window":
        # windows count rows that have a rate: symbols with too few of them before their first day
        old, to_do = F.col("date") < F.col("_from"), F.col("date") >= F.col("_from")
        short = (prc.join_fx(base, fx, pair).groupBy("symbol", "_from").agg(F.count_if(old).alias("n"), F.bool_or(to_do).alias("to_do"))
                 .filter(F.col("to_do") & (F.col("n") < prc.LONGEST_FRAME)).select("symbol", "_from"))
        need = changes.kept(store, short)
        upto = F.date_sub(need.agg(F.max("_from")).scalar(), back)      # null without such symbols: no month is read
        older = as_double(store.read("equity_daily", where=(F.col("month") <= store.month_of(upto)) & (F.col("date") < upto)))
        base = base.unionByName(older.join(need, "symbol").filter(F.col("date") < F.date_sub("_from", back)))
    elif history != "increment":
        raise ValueError("history must be 'window' or 'increment'")
    rows = prc.with_window_stats(prc.project(prc.join_dim(prc.join_fx(base, fx, pair), store.read("dim_symbol"))))
    rows = changes.from_first(rows, late, start).filter(F.col("date") >= F.col("_from"))
    out = store.upsert("fact_prices", rows.select(*prc.PRICE_COLUMNS), unique=True, mostly_new=True)
    advance_watermark(store, "fact_prices", "fact_prices")
    new.done()
    return out


def first_stored_day(store: Store, table: str, date_col: str = "date") -> Column:
    """The earliest day of a month-partitioned table (its first month is read), as a scalar."""
    months = [n.partition("=")[2] for n in folder_names(store.spark, store.path(table)) if n.startswith("month=")]
    return store.read(table, where=F.col("month") == (min(months) if months else "")).agg(F.min(date_col)).scalar()


def build_positions(store: Store, as_of) -> DataFrame:
    """Positions up to ``as_of``; matched rows keep _created_at and the
    watermark becomes ``as_of``.

    The first run computes all of them. Afterwards a pair without a changed
    transaction carries its stored quantity on from the watermark, and a pair
    with one (or one whose day has come) is computed again from its first changed day (a new pair: from
    the first day of the table), so that late or corrected transactions give the
    table of a single run. A pair whose transactions have all moved to other pairs
    keeps rows with quantity 0.
    """
    new = changes.pending(store, "portfolio_positions_daily")
    txns = as_double(store.read("portfolio_transactions"))
    cut = watermark(store.read("load_metadata"), "positions_daily").first()[0]     # one row
    if cut is None:
        rows = pos.positions_daily(txns, last_date=pos.start_date(txns), as_of=as_of)
    else:
        rows = _position_suffixes(store, txns, new.since("portfolio_transactions"), cut, as_of)
    out = store.upsert("portfolio_positions_daily", rows, update_cols=["quantity"],
                       insert_defaults={"_created_at": F.current_timestamp()}, unique=True, mostly_new=True)
    set_watermark(store, "positions_daily", as_of if not isinstance(as_of, _dt.date) else as_of.isoformat())
    new.done()
    return out


def _position_suffixes(store: Store, txns: DataFrame, since: DataFrame, cut: _dt.date, as_of) -> DataFrame:
    """The rows of ``build_positions`` after its first run, up to the later of ``as_of`` and ``cut``."""
    next_day = F.date_add(date_lit(cut), 1)
    until = F.greatest(date_lit(as_of), date_lit(cut))
    # trades that lay ahead of the last run count as changed when their day comes
    due = txns.filter((F.col("transaction_date") >= next_day) & (F.col("transaction_date") <= until))
    since = changes.kept(store, since.unionByName(due.select(*pos.PAIR, F.col("transaction_date").alias("since")))
                         .groupBy(*pos.PAIR).agg(F.min("since").alias("since")))
    # one day of the positions table: prune to its month partition
    held = as_double(store.read("portfolio_positions_daily", where=(F.col("month") == store.month_of(cut))
                                & (F.col("date") == date_lit(cut)))).select(*pos.PAIR, "quantity")
    first_stored = first_stored_day(store, "portfolio_positions_daily")
    first = F.coalesce(F.least(first_stored, since.agg(F.min("since")).scalar()), next_day)
    same = pos.spread(held.join(since, pos.PAIR, "left_anti"))
    carried = same.select(*pos.PAIR, F.explode(pos.days_between(next_day, until)).alias("date"), "quantity")
    # the table now begins earlier: every pair does
    before = same.select(*pos.PAIR, F.explode(pos.days_between(first, F.date_sub(first_stored, 1))).alias("date"),
                         F.lit(0.0).alias("quantity"))
    known = held.select(*pos.PAIR, F.lit(True).alias("known"))
    pairs = since.join(known, pos.PAIR, "left").select(
        *pos.PAIR, F.when(F.col("known").isNull() | (first < first_stored), first)
        .otherwise(F.least("since", next_day)).alias("_from"))
    moves = (txns.join(since, pos.PAIR, "left_semi").filter(F.col("transaction_date") <= until)
             .select(*pos.PAIR, F.col("transaction_date").alias("date"), F.col("quantity_delta").alias("q")))
    anchors = pairs.select(*pos.PAIR, first.alias("date"), F.lit(0.0).alias("q"))
    points = pos.spread(moves.unionByName(anchors).groupBy(*pos.PAIR, "date").agg(F.sum("q").alias("q")))
    spans = points.select(*pos.PAIR, "date", F.sum("q").over(running(pos.PAIR)).alias("quantity"),
                          F.lead("date").over(ordered(pos.PAIR)).alias("next_date")).join(pairs, pos.PAIR)
    last = F.coalesce(F.date_sub("next_date", 1), until)
    changed = spans.select(*pos.PAIR, F.explode(pos.days_between(F.greatest("date", "_from"), last)).alias("date"), "quantity")
    return carried.unionByName(before).unionByName(changed)


def build_daily(store: Store) -> DataFrame:
    """The holdings join aggregated to (portfolio, day): the days after the
    last stored one, and those from the first changed position or price on
    of the portfolios that have such a change. Prices and positions are read from
    the first of these months on only."""
    new = changes.pending(store, "portfolio_daily")
    start = _next_day(store, "portfolio_daily")
    symbols, first_price = changes.earlier(store, new.since("fact_prices"), start)
    owners = store.read("portfolio_positions_daily", where=(F.col("month") >= store.month_of(first_price))
                        & (F.col("date") >= first_price) & (F.col("date") < start))
    by_price = owners.join(symbols, "symbol").filter(F.col("date") >= F.col("since"))
    since = (new.since("portfolio_positions_daily").select("portfolio_id", "since")
             .unionByName(by_price.select("portfolio_id", F.col("date").alias("since")))
             .groupBy("portfolio_id").agg(F.min("since").alias("since")))
    late, first = changes.earlier(store, since, start)
    recent = (F.col("month") >= store.month_of(first)) & (F.col("date") >= first)
    held = changes.from_first(as_double(store.read("portfolio_positions_daily", where=recent)), late, start)
    rows = met.daily(met.holdings(as_double(store.read("fact_prices", where=recent)),
                                  held.filter(F.col("date") >= F.col("_from"))))
    out = store.upsert("portfolio_daily", rows, unique=True)
    advance_watermark(store, "portfolio_daily", "portfolio_daily")
    new.done()
    return out


def build_metrics(store: Store) -> DataFrame:
    """M3 stored: new and changed days are aggregated once, the windows run over the
    small daily table, and the days from the first new or changed one of a portfolio on are merged."""
    daily = build_daily(store)
    new = changes.pending(store, "fact_portfolio_metrics")
    start = _next_day(store, "portfolio_metrics")
    late, _ = changes.earlier(store, new.since("portfolio_daily"), start)
    rows = changes.from_first(met.over_days(daily), late, start).filter(F.col("date") >= F.col("_from"))
    out = store.upsert("fact_portfolio_metrics", rows.select(*met.METRIC_COLUMNS), unique=True)
    advance_watermark(store, "portfolio_metrics", "fact_portfolio_metrics")
    new.done()
    return out


def build_advanced(store: Store, benchmark: str = "SPY", lookback_days: int = 60) -> DataFrame:
    """I8: the advanced metrics, merged on (date, portfolio_id). Builds the metrics first.

    Computed are the days after the watermark and, of a portfolio whose metrics
    changed earlier, those from the first changed day on (of every portfolio,
    if the benchmark changed). Their windows go on from ``portfolio_adv_state``,
    which carries the peak and row numbers of each stored day: read are the
    months of the last ``lookback_days`` before the first day to compute, and
    older ones only when some portfolio has rows there that its frames still
    need. The table equals the full recompute whatever order the rows came in.
    Another benchmark than last time computes all days.
    """
    build_metrics(store)
    new = changes.pending(store, "fact_portfolio_adv_metrics")
    source = f"{ADVANCED}{benchmark}"
    bench_since = new.since("fact_benchmark").filter(F.col("symbol") == benchmark).agg(F.min("since")).scalar()
    start = F.least(_next_day(store, source), bench_since)
    late, first = changes.earlier(store, new.since("fact_portfolio_metrics"), start)
    rows = store.read("fact_portfolio_metrics", where=(F.col("month") >= store.month_of(first)) & (F.col("date") >= first))
    rows = changes.from_first(rows, late, start).filter(F.col("date") >= F.col("_from"))
    history = _window_history(store, rows.select(adv.PID, "_from").distinct(), first, lookback_days)
    todo = adv.with_benchmark(rows, _benchmark_rows(store, benchmark, first, lookback_days), benchmark)
    found = changes.kept(store, adv.go_on(history, todo))
    store.upsert("portfolio_adv_state", found.select(*adv.STATE_COLUMNS), unique=True)
    out = store.upsert("fact_portfolio_adv_metrics", found.select(*adv.ADV_COLUMNS), unique=True)
    others = store.read("load_metadata").filter(F.col("source").startswith(ADVANCED) & (F.col("source") != source)
                                                & F.col("last_loaded_date").isNotNull())
    if not others.isEmpty():     # the stored rows are no longer those of another benchmark
        store.upsert("load_metadata", others.select("source", F.lit(None).cast("date").alias("last_loaded_date"),
                                                    F.current_timestamp().alias("_updated_at")))
    advance_watermark(store, source, "fact_portfolio_adv_metrics")
    new.done()
    return out


def _window_history(store: Store, todo: DataFrame, first: Column, lookback_days: int) -> DataFrame:
    """Stored state rows before the first day to compute (``_from``) of each portfolio in ``todo``: those of the
    last ``lookback_days``, and all older ones of a portfolio whose frames reach further back."""
    todo = changes.kept(store, todo)
    since = F.date_sub(first, lookback_days)
    recent = (store.read("portfolio_adv_state", where=(F.col("month") >= store.month_of(since)) & (F.col("date") >= since))
              .join(todo, adv.PID).filter((F.col("date") < F.col("_from")) & (F.col("date") >= F.date_sub("_from", lookback_days))))
    seen = recent.groupBy(adv.PID).agg(F.count(F.lit(1)).alias("n"), F.count_if("has_bench").alias("n_bench"),
                                       F.max("row_no").alias("of"), F.max("bench_no").alias("of_bench"))
    frame = F.lit(adv.FRAME - 1)
    enough = (F.col("n") >= F.least("of", frame)) & (F.col("n_bench") >= F.least("of_bench", frame))
    need = changes.kept(store, todo.join(seen, adv.PID, "left").filter(~F.coalesce(enough, F.lit(False))).select(adv.PID, "_from"))
    upto = F.date_sub(need.agg(F.max("_from")).scalar(), lookback_days)     # null without such portfolios: no month is read
    older = (store.read("portfolio_adv_state", where=(F.col("month") <= store.month_of(upto)) & (F.col("date") < upto))
             .join(need, adv.PID).filter(F.col("date") < F.date_sub("_from", lookback_days)))
    return recent.unionByName(older)


def _benchmark_rows(store: Store, benchmark: str, first: Column, lookback_days: int) -> DataFrame:
    """The benchmark from ``first`` on and the row before it (some older rows come along)."""
    since = F.date_sub(first, lookback_days)
    recent = store.read("fact_benchmark", where=(F.col("month") >= store.month_of(since)) & (F.col("date") >= since)
                        & (F.col("symbol") == benchmark))
    last = recent.filter(F.col("date") < first).agg(F.max("date")).scalar()
    upto = F.when(last.isNull(), since)
    older = store.read("fact_benchmark", where=(F.col("month") <= store.month_of(upto)) & (F.col("date") < upto)
                       & (F.col("symbol") == benchmark))
    return as_double(recent.unionByName(older))


def load_transactions(store: Store, staged: DataFrame) -> DataFrame:
    """I9 + K8: the staged CSV frame merged by transaction_id (the stage is
    the DataFrame itself; duplicate ids in one file fail the merge)."""
    return store.upsert("portfolio_transactions", staged, insert_defaults={"_ingested_at": F.current_timestamp()})
