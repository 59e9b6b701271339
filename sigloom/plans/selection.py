"""Item selection: viewed items that still need signals, with title, aspects and description."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from sigloom.functions import fixed_values as fv
from sigloom.operators import filters as flt
from sigloom.operators import items as it
from sigloom.operators.ordering import stored, top_by_rank
from sigloom.sources.tables import Tables
from sigloom.sources.writers import append_ledger, require_empty, write_items


@dataclass(frozen=True)
class SelectionRequest:
    start: str
    end: str
    limit: int = fv.DEFAULT_ITEM_LIMIT
    overfetch: int = fv.OVERFETCH_FACTOR
    verticals: list[str] | None = None
    site_ids: list[int] | None = None
    excluded_level3: list[int] | None = None
    use_ledger: bool = False
    denied_names: list[str] | None = None  # None: the default lists; an empty list denies nothing
    denied_values: list[str] | None = None
    denied_sources: list[int] | None = None
    aspect_types: list[str] | None = None
    marketplace: str | None = None  # its own product-id aspect is denied too
    scratch: str | None = None  # a shared folder for narrow intermediate tables; without it they are computed where used

    def valid(self) -> dict:
        """Arguments of ``valid_aspects``."""
        return {"denied_names": self.denied_names, "denied_values": self.denied_values, "denied_sources": self.denied_sources,
                "types": self.aspect_types, "marketplace": self.marketplace}


def candidates(tables: Tables, req: SelectionRequest) -> DataFrame:
    """Viewed items with their rank, over-fetched.  A vacant slot comes first, then the view count."""
    ranked = it.with_rank(it.views_per_item(it.relevant_views(tables["views"], req.start, req.end)))
    narrow = stored(ranked.select("item_id", "site_id", "leaf_categ_id", "rank"), req.scratch, "ranked")
    return top_by_rank(narrow, "rank", "item_id", req.limit * req.overfetch)


def new_candidates(tables: Tables, req: SelectionRequest, viewed: DataFrame) -> DataFrame:
    """Candidates in wanted categories and not in the ledger.  Ids are unique already: one row per item."""
    categories = flt.pick_categories(tables["categories"], site_ids=req.site_ids, excluded_level3=req.excluded_level3,
                                     verticals=req.verticals)
    wanted = it.in_categories(viewed, categories).select("item_id", "rank")
    if req.use_ledger:
        wanted = it.without_ids(wanted, it.recent_ledger(tables["ledger"], req.start))
    return wanted


def recent_aspects(tables: Tables, req: SelectionRequest) -> DataFrame:
    return tables["aspects"].filter(F.col("auct_end_dt") >= F.lit(req.start).cast("date"))


def item_data(tables: Tables, req: SelectionRequest, ids: DataFrame) -> DataFrame:
    """Live listings ⟕ aspects ⟕ description for the given ids, rows without any content dropped."""
    listings = flt.live_only(tables["listings"]).select("item_id", F.col("auct_titl").alias("title"))
    items = listings.join(ids, "item_id")  # brings the rank along, so no second join is needed
    maps = it.latest_aspects(it.with_ids(recent_aspects(tables, req), ids), **req.valid())
    descriptions = it.with_ids(tables["descriptions"], ids).select("item_id", F.col("item_desc").alias("desc"))
    return flt.has_content(it.assemble(items, maps, descriptions))


def final_ids(tables: Tables, req: SelectionRequest, ids: DataFrame) -> DataFrame:
    """The best ids among those with a live listing and any content, decided on narrow rows only."""
    live = flt.live_only(tables["listings"]).select("item_id").join(ids, "item_id")
    content = (flt.valid_aspects(recent_aspects(tables, req), **req.valid()).select("item_id")
                  .unionByName(tables["descriptions"].filter(F.col("item_desc").isNotNull()).select("item_id")))
    eligible = stored(it.with_ids(live, content), req.scratch, "eligible")
    return stored(top_by_rank(eligible, "rank", "item_id", req.limit), req.scratch, "final")


def select_items(tables: Tables, req: SelectionRequest) -> DataFrame:
    """item_id, title, aspects, desc and rank of the selected items."""
    return item_data(tables, req, final_ids(tables, req, new_candidates(tables, req, candidates(tables, req))))


def slot_counts() -> list[Column]:
    vacant = F.count_if(F.col("rank") == fv.VACANT_RANK)
    return [F.count("*").alias("total"), vacant.alias("vacant"), (F.count("*") - vacant).alias("non_vacant")]


def slot_report(selected: DataFrame) -> DataFrame:
    """Total, vacant and non-vacant in one pass."""
    return selected.agg(*slot_counts())


def run(tables: Tables, req: SelectionRequest, output: str | None, ledger_path: str | None = None,
        ledger_scope: str = "candidates", slots: Observation | None = None) -> DataFrame:
    """Guard, select, write, then append the ledger.  The written table is read back for the ledger and report.

    ``slots`` takes the counts of ``slot_report`` while the items are written, so the report costs no job of its own.
    """
    if ledger_scope not in ("candidates", "selected"):
        raise ValueError("ledger_scope is 'candidates' or 'selected'")
    if slots is not None and not output:
        raise ValueError("slots are counted while the items are written: name an output")
    if output:
        require_empty(tables.spark, output)
    new = stored(new_candidates(tables, req, candidates(tables, req)), req.scratch, "new")
    selected = item_data(tables, req, final_ids(tables, req, new))
    if slots is not None:
        selected = selected.observe(slots, *slot_counts())
    write_items(selected.drop("rank"), output)
    written = tables.spark.read.parquet(output) if output else selected.drop("rank")
    if ledger_path:
        append_ledger(new if ledger_scope == "candidates" else written, ledger_path, req.start, req.use_ledger)
    return written
