"""From landed listing pages to the current listings table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listingflow.operators.parse import OUTCOME, project_items, stop_at_fatal
from listingflow.operators.positions import _renamed, _same
from listingflow.operators.rules import LISTING_WALK_EMPTIES, truncate_after_empty, walk_stops
from listingflow.operators.upsert import upsert_latest, write_order
from listingflow.session import cut_lineage
from listingflow.sources.payloads import read_pages
from listingflow.sources.tables import conform_listings, stamp

# One walk: the pages of one neighbourhood and listing type in one run.
WALK = ["run", "uf", "city", "neighbourhood", "listing_type"]
WRITE_COLUMNS = [*WALK, "city_idx", "neighbourhood_pos", "page", "pos"]

# Outcomes of pages without items: `page:` and the reason, or this for an empty one.
PAGE_EMPTY = "page:empty"


def _marks(pages: DataFrame) -> DataFrame:
    """What the stop rule looks at: a page without items is empty, an error ends its walk."""
    return pages.withColumns({"_empty": F.col("state") != "items", "_error": F.col("state") == "error"})


def walked_pages(payloads: DataFrame) -> DataFrame:
    """The pages whose listings count: those before the stop of their walk.

    A page with an error status or an unreadable payload stops its walk at once.
    """
    kept = truncate_after_empty(
        _marks(read_pages(payloads)), WALK, LISTING_WALK_EMPTIES, empty="_empty", error="_error"
    )
    return kept.select(*payloads.columns)


def page_outcomes(payloads: DataFrame, base_url: str) -> DataFrame:
    """All that the pages hold, from one parse: nothing of the input is left out.

    A row per listing item, and one per page without items (`pos` is NULL). `outcome`
    is NULL for a good item, `reject:` or `fatal:` and the field for a refused one,
    and for a page `page:` and why it has no items (see `read_pages`). `raw_json` has
    the item's text, or that of a page that cannot be read. `state` is the page's.
    """
    others = [name for name in payloads.columns if name != "payload"]
    pages = read_pages(payloads)
    reason = F.when(F.col("state") != "items", F.concat(F.lit("page:"), F.coalesce("reason", F.lit("empty"))))
    lost = F.when(F.col("state") == "error", F.col("payload"))
    items = F.when(F.col("state") == "items", F.col("items"))
    opened = pages.select(
        *others, "state", reason.alias("_page"), lost.alias("_lost"), F.posexplode_outer(items).alias("pos", "item")
    )
    rows = project_items(opened, base_url).withColumns(
        {OUTCOME: F.coalesce("_page", OUTCOME), "raw_json": F.coalesce("raw_json", "_lost")}
    )
    return rows.drop("_page", "_lost")


def counted(rows: DataFrame, pages: DataFrame | None = None, on_fatal: str = "quarantine") -> DataFrame:
    """The rows of `page_outcomes` that count: a walk ends where its stop rule says.

    `pages` gives the walk, page and state of all pages, more than once is no harm; by
    default they are taken from the rows. The page that stops a walk still comes out
    with its outcome, those behind it do not. `on_fatal="truncate"` also ends a walk at
    its first fatal item, which comes out too.
    """
    if pages is None:
        # The first item stands for its page.
        pages = rows.where(F.coalesce("pos", F.lit(0)) == 0)
    stops = walk_stops(
        _marks(pages.select(*WALK, "page", "state")), WALK, LISTING_WALK_EMPTIES, empty="_empty", error="_error"
    )
    stops = stops.select(*_renamed(WALK, "_w"), F.col("stop").alias("_stop"))
    at_stop = (F.col("page") == F.col("_stop")) & F.col("pos").isNull()
    kept = (
        rows.join(stops, _same(WALK, "_w"), "left")
        .where(F.col("_stop").isNull() | (F.col("page") < F.col("_stop")) | at_stop)
        .select(*rows.columns)
    )
    return _until_fatal(kept, on_fatal)


def _until_fatal(rows: DataFrame, on_fatal: str) -> DataFrame:
    if on_fatal not in ("quarantine", "truncate"):
        raise ValueError(f"unknown on_fatal: {on_fatal}")
    if on_fatal == "truncate":
        return stop_at_fatal(rows, WALK, ["page", "pos"], keep_fatal=True)
    return rows


def split_outcomes(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, rejected) rows; an empty page is neither."""
    good = rows.where(F.col(OUTCOME).isNull()).drop(OUTCOME, "state")
    refused = F.col(OUTCOME).isNotNull() & (F.col(OUTCOME) != PAGE_EMPTY)
    return good, rows.where(refused).select(*WRITE_COLUMNS, "url", "raw_json", OUTCOME)


def parse_pages(
    payloads: DataFrame,
    base_url: str,
    portal: str,
    now: str,
    on_fatal: str = "quarantine",
    stop_rule: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """(good, rejected) items of landed pages, with the columns that order writes.

    With `stop_rule`, pages beyond the stop of their walk do not count; leave it
    out where the fetcher has stopped by itself and only good pages have landed.
    A page that cannot be read is a rejected row of its own, without `pos`, with the
    outcome `page:` and the reason; it ends its walk.

    `on_fatal="quarantine"` sets aside just the broken item; `"truncate"` also
    ends its walk there: later items are neither good nor rejected.
    """
    rows = page_outcomes(payloads, base_url)
    if stop_rule:
        # Taken from the payloads, so that no item is parsed for it.
        rows = counted(rows, read_pages(payloads), on_fatal)
    else:
        rows = _until_fatal(rows, on_fatal)
    good, rejected = split_outcomes(rows)
    return stamp(good, portal, now), rejected


def current_listings(existing: DataFrame | None, good: DataFrame) -> DataFrame:
    """The listings table after the good rows of a run are written to it.

    The upsert looks at the new rows twice, so they are stored once in between
    and not parsed again.
    """
    if existing is not None:
        good = cut_lineage(good)
    return conform_listings(upsert_latest(existing, good, write_order()))
