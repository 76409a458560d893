"""Repeated margins by geometry: blocks of text that stand at the same place on many pages of a document are running heads and feet, unless they are protected.

A block's signature is its text's form and the cell of a grid in which its centre lies. A centre near a cell's border also counts for the neighbour, so that small shifts
between pages don't part what belongs together. Signatures are counted by distinct pages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def signatures(x: Column, y: Column, cell: float, slack: float) -> Column:
    """Cells of a centre: its own, and neighbours whose border is nearer than `slack` (a share of the cell)."""
    def along(v: Column) -> Column:
        own, part = F.floor(v / cell), v / cell - F.floor(v / cell)
        return F.array_compact(F.array(own, F.when(part < slack, own - 1), F.when(part >= 1 - slack, own + 1)))

    return F.flatten(F.transform(along(x), lambda a: F.transform(along(y), lambda b: F.struct(a.alias("cx"), b.alias("cy")))))


def split_margins(
    blocks: DataFrame, document: str, page: str, text: str, box: tuple[str, str, str, str], page_height: Column, *, band: float = 0.15, cell: float = 0.05, slack: float = 0.2, least_pages: int = 3, least_share: float = 0.5,
    protected: Column | None = None,
) -> DataFrame:
    """blocks with n_pages (distinct pages of its most frequent signature) and margin: true for what lies wholly in the upper or lower `band` of its page, is not
    protected, and whose signature is on least_pages or more and on least_share or more of the document's pages.

    Kept and excluded blocks are the rows with margin false and true: together they are all rows. box: left, top, right, bottom in the unit of page_height; a block
    without a box, a page height or a text is no margin. Texts are compared with digits as one sign, case and blanks aside. Repeated blocks of a page count once.
    """
    left, top, right, bottom = (F.col(c).cast("double") / page_height for c in box)
    inside = F.coalesce((bottom <= band) | (top >= 1 - band), F.lit(False))
    form = F.trim(F.regexp_replace(F.regexp_replace(F.lower(text), r"\p{N}+", "#"), r"[\s\p{Z}]+", " "))
    usable = inside & F.coalesce(form != "", F.lit(False)) & F.coalesce((left + right).isNotNull(), F.lit(False))
    if protected is not None:
        usable = usable & ~F.coalesce(protected, F.lit(False))
    rows = blocks.withColumn("__form", F.when(usable, F.sha2(form, 256))).withColumn("__cells", F.when(usable, signatures((left + right) / 2, (top + bottom) / 2, cell, slack)))
    pages = blocks.groupBy(F.col(document).alias("__d")).agg(F.count_distinct(page).alias("__pages"))
    each = rows.where("__form IS NOT NULL").select(F.col(document).alias("__d"), F.col(page).alias("__p"), "__form", F.explode("__cells").alias("__c")).distinct()
    often = each.groupBy("__d", "__form", "__c").agg(F.count(F.lit(1)).alias("__n"))
    # a block takes the best of its cells: one row for each form and set of cells of a document, joined by them
    kinds = rows.where("__form IS NOT NULL").select(F.col(document).alias("__d"), "__form", "__cells").distinct()
    kinds = kinds.withColumn("__c", F.explode("__cells")).join(often, ["__d", "__form", "__c"]).groupBy("__d", "__form", "__cells").agg(F.max("__n").alias("n_pages"))
    kinds = kinds.join(pages, "__d").select(F.col("__d").alias("__d2"), F.col("__form").alias("__f2"), F.col("__cells").alias("__c2"), "n_pages", "__pages")
    found = rows.join(kinds, (F.col(document) == F.col("__d2")) & (F.col("__form") == F.col("__f2")) & (F.col("__cells") == F.col("__c2")), "left")
    margin = F.coalesce((F.col("n_pages") >= least_pages) & (F.col("n_pages") >= least_share * F.col("__pages")), F.lit(False))
    return found.select(*[F.col(c) for c in blocks.columns], "n_pages", margin.alias("margin"))
