"""Printed pages put together from placed characters.

A page reader gives one row a character: ``document``, ``page``, ``text``, its box ``x0 x1 top
bottom`` in points from the page's upper left corner, ``size``, ``font``, ``upright``, and the page's
``width`` and ``height``. Everything here is relational: characters are dealt by page once, and
clustered by windows over the page's characters; what lines say is put together in arrays of a line's
length. ``answer_files``, ``weekly_files``, ``report_files`` and ``text_lines`` give what the parsers
of ``sources.printed`` and ``sources.elections`` take.

Null texts and characters without a place are left out; blank characters count as blanks;
characters printed over each other (the same text at the same place) count once.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from tessera.operators.aggregates import most_common
from tessera.operators.sequence import chained
from tessera.sources.printed import _runs_on_each_page

PAGE = ("document", "page")

#: Shares of a type size (fixed values): characters of a line have baselines this close, sizes this close in points; a
#: gap this wide is a blank; type below SMALL of the page's is a mark that joins a line within REACH of its size.
BASELINE, SIZES, BLANK, SMALL, REACH = 0.2, 1.5, 0.25, 0.8, 0.5
#: Running heads end and notes begin here, page one's title block ends above TITLE, the askers' column ends at SPLIT (points; fixed values).
HEAD, FOOT, TITLE, SPLIT, NOTES = 80.0, 770.0, 450.0, 236.0, 9.0
#: Of stenographic reports: where the running head ends, the gap of a blank, the body's and the smallest size (points; fixed values).
REPORT_HEAD, REPORT_BLANK, REPORT_SIZE, REPORT_LEAST = 58.0, 1.5, 10.0, 9.0
#: Of tables without rules (fixed values): cells are this share of the type apart, a row has so many numbers, a table so many rows,
#: and at most so many lines of labels; rows further apart than so many sizes are two tables; labels are shorter than LABEL.
CELL, NUMBERS, ROWS, LABELS, APART, LABEL = 0.9, 3, 3, 4, 2.5, 40

_MARK = "\x01"  # a blank that is not printed


def modal(values: Column) -> Column:
    """The most frequent element of an array, of equals the one that comes first."""
    each = F.transform(
        F.array_distinct(values),
        lambda v: F.struct(F.size(F.filter(values, lambda x: x.eqNullSafe(v))).alias("n"), (-F.array_position(values, v)).alias("first"), v.alias("v")),
    )
    return F.array_max(each)["v"]


def _blank(text: Column) -> Column:
    return F.trim(F.translate(text, "\xa0\t", "  ")) == ""


def _set_text(glyphs: Column, gap: Column | None) -> Column:
    """The characters of a line, marks where a gap stands for a blank."""

    def piece(c: Column, k: Column) -> Column:
        before = F.get(glyphs, k - 1)
        wide = c["x0"] - before["x1"] > (F.lit(BLANK) * c["size"] if gap is None else gap)
        return F.when((k > 0) & wide & ~_blank(before["text"]) & (c["text"] != " "), F.concat(F.lit(_MARK), c["text"])).otherwise(c["text"])

    return F.array_join(F.transform(glyphs, piece), "")


def _plain(text: Column) -> Column:
    return F.translate(text, _MARK, " ")


def strips(glyphs: DataFrame, keys: Sequence[str] = PAGE) -> DataFrame:
    """Characters of about one size and baseline, left to right: a row each, with ``glyphs`` as an array."""
    placed = glyphs.where(F.col("text").isNotNull() & F.col("x0").isNotNull() & F.col("bottom").isNotNull() & F.col("size").isNotNull())
    once = placed.groupBy(*keys, "text", "x0", "bottom").agg(*(F.min(c).alias(c) for c in ("x1", "top", "size", "font", "width", "height")))
    body = F.mode("size", True).over(Window.partitionBy(*keys))
    sized = chained(once.withColumn("_body", body), keys, "size", F.lit(SIZES), "_class")
    lined = chained(sized, [*keys, "_class"], "bottom", F.col("size") * BASELINE, "_strip")
    glyph = F.struct(F.col("x0"), F.col("x1"), F.col("text"), F.col("top"), F.col("bottom"), F.col("size"), F.coalesce("font", F.lit("")).alias("font"))
    return lined.groupBy(*keys, "_class", "_strip").agg(
        F.sort_array(F.collect_list(glyph)).alias("glyphs"),  # as many as a line has
        F.min("bottom").alias("bottom"),
        F.max("size").alias("size"),
        F.first("_body").alias("_body"),
        F.min("top").alias("top"),
        F.first("width").alias("width"),
        F.first("height").alias("height"),
    )


def _joined_to(df: DataFrame, keys: Sequence[str], small: Column, large: Column, to: str) -> DataFrame:
    """``to`` of small strips becomes that of the nearest large one above or below, if it is within reach."""
    w = Window.partitionBy(*keys).orderBy("bottom", F.desc("size"), "_class", "_strip")
    mine = F.when(large, F.struct("bottom", "size", F.col(to).alias("to")))
    above = F.last(mine, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    below = F.first(mine, ignorenulls=True).over(w.rowsBetween(1, Window.unboundedFollowing))
    near = lambda c, rank: F.when(
        F.abs(F.col("bottom") - c["bottom"]) <= REACH * c["size"],
        F.struct(F.abs(F.col("bottom") - c["bottom"]).alias("distance"), F.lit(rank).alias("rank"), c["to"].alias("to")),
    )
    best = F.least(near(F.col("_above"), 0), near(F.col("_below"), 1))["to"]
    marked = df.withColumns({"_above": above, "_below": below})
    return marked.withColumn(to, F.when(small, F.coalesce(best, F.col(to))).otherwise(F.col(to))).drop("_above", "_below")


def lines(glyphs: DataFrame, keys: Sequence[str] = PAGE, gap: Column | None = None) -> DataFrame:
    """The lines of each page (or of each column, if ``keys`` has one): sub- and superscripts with the line they belong to.

    Gives the keys, line (from 1, downwards), top, bottom, x and x1 (of what is printed), size and
    font (the most frequent), bold (more than half of the line), all_bold, bold_start, italic, serif
    and sans of the most frequent font, numbered (opens with a number in a hanging indent), text, first_size,
    glyphs, width and height. ``gap`` is the least gap that is a blank; without it a quarter of the size.
    """
    s = strips(glyphs, keys).withColumn("_own", F.struct("bottom", "_class", "_strip"))
    level = F.when(F.col("size") >= SMALL * F.col("_body"), 0).when(F.col("size") >= SMALL * SMALL * F.col("_body"), 1).otherwise(2)
    s = s.withColumn("_level", level).withColumn("_line", F.col("_own"))
    s = _joined_to(s, keys, F.col("_level") == 1, F.col("_level") == 0, "_line")
    s = _joined_to(s, keys, F.col("_level") == 2, F.col("_level") < 2, "_line")
    base = F.col("_line").eqNullSafe(F.col("_own"))
    whole = s.groupBy(*keys, "_line").agg(
        F.sort_array(F.flatten(F.collect_list("glyphs"))).alias("glyphs"),
        F.min(F.when(base, F.col("top"))).alias("top"),
        F.max(F.when(base, F.col("bottom"))).alias("bottom"),
        F.first("width").alias("width"),
        F.first("height").alias("height"),
    )
    return described(whole, gap).where("size IS NOT NULL").withColumn(
        "line", F.row_number().over(Window.partitionBy(*keys).orderBy("bottom", "x", "_line")).cast("long")
    ).drop("_line")


def described(df: DataFrame, gap: Column | None = None) -> DataFrame:
    """What ``lines`` says of the array ``glyphs``; size is null where nothing is printed."""
    printed = F.filter("glyphs", lambda c: ~_blank(c["text"]))
    fonts, is_bold = F.transform("_printed", lambda c: c["font"]), lambda c: c["font"].contains("Bold")
    return (
        df.withColumns({"_printed": printed, "_set": _set_text(F.col("glyphs"), gap)})
        .withColumn("font", modal(fonts))
        .withColumns(
            {
                "x": F.get("_printed", F.lit(0))["x0"],
                "x1": F.array_max(F.transform("_printed", lambda c: c["x1"])),
                "size": modal(F.transform("_printed", lambda c: F.round(c["size"], 1))),
                "first_size": F.round(F.get("_printed", F.lit(0))["size"], 1),
                "bold": 2 * F.size(F.filter("_printed", is_bold)) > F.size("_printed"),
                "all_bold": F.forall("_printed", is_bold),
                "bold_start": is_bold(F.get("_printed", F.lit(0))),
                "italic": F.col("font").contains("Ital"),
                "serif": F.col("font").contains("Times"),
                "sans": F.forall("_printed", lambda c: c["font"].contains("Arial")),
                "numbered": F.col("_set").rlike(r"^\s*\d{1,3}\.\x01"),
                "text": _plain(F.col("_set")),
            }
        )
        .drop("_printed", "_set")
    )


# ---------------------------------------------------------------- tables


def _cells(glyphs: Column) -> Column:
    """The texts between gaps of CELL sizes."""
    printed = F.filter(glyphs, lambda c: ~_blank(c["text"]))
    far = lambda c, k: (k > 0) & (c["x0"] - F.get(printed, k - 1)["x1"] >= CELL * c["size"])
    return F.split(F.array_join(F.transform(printed, lambda c, k: F.when(far(c, k), F.concat(F.lit(_MARK), c["text"])).otherwise(c["text"])), ""), _MARK)


def is_number(cell: Column) -> Column:
    """Digits with the marks of numbers around and between them, or one of the marks that stand for no number."""
    digits = F.translate(cell, "()%+-–., ", "")
    return (digits.rlike(r"^\d+$") & cell.rlike(r"^\(?[-+–]?\d")) | cell.isin("*", "x", "×", "–", "—", "-")


def with_tables(found: DataFrame, keys: Sequence[str] = PAGE) -> DataFrame:
    """``lines`` with table: the number, on its page, of the table without rules that a line is part of.

    A table is at least ROWS lines of NUMBERS numbers or more, with short lines between them, and up to
    LABELS short lines above. A line that is neither, or a gap, ends it.
    """
    w = Window.partitionBy(*keys).orderBy("line")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    df = found.withColumn("_cells", _cells(F.col("glyphs")))
    df = df.withColumns({
        "_row": F.size(F.filter("_cells", is_number)) >= NUMBERS,
        "_short": F.forall("_cells", lambda c: F.length(c) < LABEL),
    })
    apart = F.col("top") - F.lag("bottom").over(w) > APART * F.col("size")
    df = df.withColumn("_run", F.count_if(F.coalesce(apart, F.lit(False)) | ~(F.col("_row") | F.col("_short"))).over(upto))
    run = Window.partitionBy(*keys, "_run")
    df = df.withColumns({
        "_rows": F.count_if("_row").over(run),
        "_from": F.min(F.when(F.col("_row"), F.col("line"))).over(run),
        "_to": F.max(F.when(F.col("_row"), F.col("line"))).over(run),
    })
    core = (F.col("_rows") >= ROWS) & F.col("line").between(F.col("_from"), F.col("_to"))
    df = df.withColumns({"_core": core, "_streak": F.col("line") - F.coalesce(F.max(F.when(~F.col("_short"), F.col("line"))).over(upto), F.lit(0))})
    starts = F.col("_core") & (F.col("line") == F.col("_from"))
    # Of the nearest table that begins within LABELS lines: where, and how many short lines are right above it.
    df = df.withColumn("_above", F.lag("_streak", 1, 0).over(w))
    df = df.withColumn("_next", F.min(F.when(starts, F.struct("line", "_above"))).over(w.rowsBetween(1, LABELS)))
    label = ~F.col("_core") & (F.col("_next.line") - F.col("line") <= F.col("_next._above"))
    begins = F.when(F.col("_core"), F.col("_from")).when(label, F.col("_next.line"))
    df = df.withColumn("_begins", begins)
    rank = F.dense_rank().over(Window.partitionBy(*keys).orderBy(F.col("_begins").asc_nulls_last()))
    return df.withColumn("table", F.when(F.col("_begins").isNotNull(), rank)).drop(*(c for c in df.columns if c.startswith("_")))


def outside(glyphs: DataFrame, tables: DataFrame) -> DataFrame:
    """The characters that are in none of the reader's ruled ``tables`` (document, page, x0, top, x1, bottom, rows); a point of leeway."""
    boxes = tables.groupBy(*PAGE).agg(F.collect_list(F.struct("x0", "top", "x1", "bottom")).alias("_boxes"))  # those of a page
    inside = F.exists(
        "_boxes",
        lambda b: (F.col("x0") >= b["x0"] - 1) & (F.col("x1") <= b["x1"] + 1) & (F.col("top") >= b["top"] - 1) & (F.col("top") <= b["bottom"] + 1),
    )
    return glyphs.join(boxes, list(PAGE), "left").where(F.col("_boxes").isNull() | ~inside).drop("_boxes")


# ---------------------------------------------------------------- what the parsers take


@F.pandas_udf(BooleanType())
def _running(text: pd.Series) -> pd.Series:
    return text.map(_runs_on_each_page)


def _items(marked: DataFrame, tables: DataFrame | None, line: Column, keep: Column) -> DataFrame:
    """(document, page, top, rank, item): lines as JSON, each table once, at its top."""
    table_item = lambda item: [*PAGE, "top", F.lit(1).alias("rank"), F.to_json(F.struct(item)).alias("item")]
    found = marked.where(keep & F.col("table").isNull()).select(*PAGE, "top", F.lit(2).alias("rank"), F.to_json(line).alias("item"))
    unread = marked.where(F.col("table").isNotNull()).groupBy(*PAGE, "table").agg(F.min("top").alias("top"))
    found = found.unionByName(unread.select(*table_item(F.col("page").alias("unread"))))
    return found.unionByName(tables.select(*table_item(F.col("rows")))) if tables is not None else found


def _pages(marked: DataFrame, *more: Column) -> DataFrame:
    """An item where each page begins."""
    pages = marked.groupBy(*PAGE).agg(F.first(F.col("width") > F.col("height")).alias("landscape"), *more)
    item = F.to_json(F.struct("page", "landscape", *(c for c in pages.columns if c not in (*PAGE, "landscape")))).alias("item")
    return pages.select(*PAGE, F.lit(float("-inf")).alias("top"), F.lit(0).alias("rank"), item)


def _files(items: DataFrame, fields: DataFrame | None = None) -> DataFrame:
    """One JSON object a document, (path, content): its items in the order of pages, tops and ranks, and other ``fields`` by document."""
    rows = items.groupBy("document").agg(F.sort_array(F.collect_list(F.struct("page", "top", "rank", "item"))).alias("rows"))
    listed = F.concat(F.lit('"items":['), F.array_join(F.transform("rows", lambda r: r["item"]), ","), F.lit("]"))
    whole = F.concat(F.lit("{"), listed, F.lit("}"))
    if fields is not None:
        rows = rows.join(fields.select("document", F.to_json(F.struct(*(c for c in fields.columns if c != "document"))).alias("more")), "document", "left")
        whole = F.when(F.length("more") > 2, F.concat(F.lit("{"), listed, F.lit(","), F.expr("substring(more, 2)"))).otherwise(whole)
    return rows.select(F.col("document").cast("string").alias("path"), whole.cast("binary").alias("content"))


def answer_files(glyphs: DataFrame, tables: DataFrame | None = None) -> DataFrame:
    """Answers to inquiries (S19) as ``printed.answers`` reads them: running heads and notes taken off, the title block
    and the note of page one as the head, tables without rules marked as unread, ruled ones from the reader."""
    found = with_tables(lines(outside(glyphs, tables) if tables is not None else glyphs))
    landscape, one = F.col("width") > F.col("height"), F.col("page") == 1
    bold = F.exists("glyphs", lambda c: c["font"].contains("Bold"))
    title = F.max(F.when((F.col("top") < TITLE) & bold, F.col("top"))).over(Window.partitionBy(*PAGE))
    heading = one & ((F.col("top") <= F.coalesce(title, F.lit(HEAD))) | (F.col("top") > FOOT))
    inside = ~heading & (landscape | F.col("top").between(HEAD, FOOT))
    marked = found.withColumn("heading", heading).withColumn("inside", inside)
    body = _items(marked, tables, F.struct("page", "top", "x", "size", "text", "bold", "bold_start", "serif", "numbered"), F.col("inside"))
    opens = F.when(F.col("inside") & F.col("table").isNull() & ~_running(F.trim("text")), F.struct("top", "line", F.trim("text").alias("text"), "serif"))
    first = F.min(opens)
    pages = _pages(marked, F.coalesce(first["text"], F.lit("")).alias("first"), F.coalesce(first["serif"], F.lit(False)).alias("serif"))
    heads = marked.where("heading").groupBy("document").agg(F.sort_array(F.collect_list(F.struct("top", "line", F.trim("text").alias("text")))).alias("h"))
    return _files(body.unionByName(pages), heads.select("document", F.array_join(F.transform("h", lambda r: r["text"]), " ").alias("head")))


def _bold_runs(glyphs: Column) -> Column:
    """(text, bold) of the stretches of one weight; blanks go with what is before them."""
    nothing = F.array().cast("array<struct<text:string,bold:boolean>>")

    def step(runs: Column, c: Column) -> Column:
        last = F.try_element_at(runs, F.lit(-1))
        goes_on = F.coalesce(_blank(c["text"]) | (last["bold"] == c["bold"]), F.lit(False)) & (F.size(runs) > 0)
        longer = F.struct(F.concat(last["text"], c["text"]).alias("text"), last["bold"].alias("bold"))
        return F.when(goes_on, F.concat(F.slice(runs, 1, F.greatest(F.size(runs) - 1, F.lit(0))), F.array(longer))).otherwise(F.concat(runs, F.array(c)))

    def piece(c: Column, k: Column) -> Column:
        before = F.get(glyphs, k - 1)
        gap = (k > 0) & (c["x0"] - before["x1"] > BLANK * c["size"]) & ~_blank(before["text"]) & (c["text"] != " ")
        return F.struct(F.when(gap, F.concat(F.lit(" "), c["text"])).otherwise(c["text"]).alias("text"), c["font"].contains("Bold").alias("bold"))

    return F.aggregate(F.transform(glyphs, piece), nothing, step)


def weekly_files(glyphs: DataFrame, tables: DataFrame | None = None) -> DataFrame:
    """Weekly lists of written questions (S20) as ``printed.weekly_questions`` reads them: a line has its bold and plain
    runs left of SPLIT and its text from there on; small type and what stands upright in the margin are left out."""
    upright = glyphs.where(F.coalesce("upright", F.lit(True)))
    found = with_tables(lines(outside(upright, tables) if tables is not None else upright))
    left, right = F.filter("glyphs", lambda c: c["x0"] < SPLIT), F.filter("glyphs", lambda c: c["x0"] >= SPLIT)
    marked = found.withColumns({"left": _bold_runs(left), "right": _plain(_set_text(right, None)), "bold": F.col("all_bold"), "serif": ~F.col("sans")})
    line = F.struct("page", "top", "x", "size", "text", "bold", "serif", "left", "right")
    return _files(_items(marked, tables, line, (F.col("top") >= HEAD) & (F.col("size") >= NOTES)).unionByName(_pages(marked)))


def _printed_number(head: Column) -> Column:
    """The page's own number in a running head: first on left pages, last on right ones, where its digits may be spaced."""
    left = F.regexp_extract(head, r"^(\d{1,5})\b.*?Deutscher Bundestag", 1)
    after = F.regexp_extract(head, r"^Deutscher Bundestag.*\d{4}([\d ]*?) *(?:[-–][\d ]*)?$", 1)
    return F.coalesce(F.nullif(left, F.lit("")), F.nullif(F.replace(after, F.lit(" "), F.lit("")), F.lit(""))).try_cast("int")


def report_lines(glyphs: DataFrame) -> DataFrame:
    """Lines of stenographic reports (S18) column by column: document, page (as printed), col, line, top, x, size, indent, bold, bold_start, text.

    Pages without a running head of the report (title, contents) are passed over. The indent is
    measured from where most body lines of that column begin, on all left or all right pages of the document (A22).
    """
    gap = F.lit(REPORT_BLANK)
    at_top = F.col("top") < REPORT_HEAD
    heads = lines(glyphs.where(at_top), PAGE, gap).where("line = 1").select(*PAGE, F.trim("text").alias("head"))
    heads = heads.where(F.col("head").contains("Wahlperiode")).withColumns({"number": _printed_number(F.col("head")), "is_left": F.col("head").rlike(r"^\d")})
    middle = (F.col("x0") + F.col("x1")) / 2
    sided = glyphs.where(~at_top).withColumn("col", (middle >= F.col("width") / 2).cast("int"))
    found = lines(sided, [*PAGE, "col"], gap).join(heads.where("number IS NOT NULL"), list(PAGE))
    # Margin letters (fixed values) go; a line is measured from what comes after them.
    margin = F.trim("text").rlike(r"^\([A-D]\)")
    printed = F.filter("glyphs", lambda c: ~_blank(c["text"]))
    kept = F.when(margin, F.slice(printed, 4, F.greatest(F.size(printed) - 3, F.lit(0)))).otherwise(printed)
    bold = lambda c: c["font"].contains("Bold")
    start = F.get("_kept", F.lit(0))
    found = found.withColumn("_kept", kept).where(F.size("_kept") > 0).withColumns({
        "x": start["x0"],
        "size": F.round(start["size"], 1),
        "bold": 2 * F.size(F.filter("_kept", bold)) > F.size("_kept"),
        "bold_start": bold(start),
        "text": F.trim(F.regexp_replace(F.trim("text"), r"^\([A-D]\)\s*|\s*\([A-D]\)$", "")),
    })
    sides = ["document", "is_left", "col"]
    body = found.where((F.abs(F.col("size") - REPORT_SIZE) < 0.3) & ~margin).withColumn("_x", F.round("x"))
    edges = most_common(body, sides, "_x", [F.col("page"), F.col("line")], "_edge")
    said = found.where((F.col("size") >= REPORT_LEAST) & (F.col("text") != "")).join(edges, sides)
    return said.select(
        "document", F.col("number").alias("page"), "col", "line", "top", "x", "size", (F.col("x") - F.col("_edge")).alias("indent"), "bold", "bold_start", "text"
    )


def report_files(glyphs: DataFrame, tails: DataFrame | None = None) -> DataFrame:
    """Reports as ``printed.report_tail`` reads them; ``tails`` (document, tail) has the last paragraphs of each one's XML."""
    line = F.to_json(F.struct("page", "top", "x", "size", "text", "indent", "bold", "bold_start"))
    # Columns of a page follow each other: their order takes the place of the top.
    items = report_lines(glyphs).select("document", "page", (F.col("col") * 1e6 + F.col("top")).alias("top"), F.col("line").alias("rank"), line.alias("item"))
    return _files(items, tails)


def text_lines(glyphs: DataFrame) -> DataFrame:
    """(path, page, line, text): plain lines, as ``elections.successors`` (S11) takes them."""
    found = lines(glyphs, PAGE, F.lit(3.0))
    return found.select(F.col("document").alias("path"), "page", "line", F.trim(F.regexp_replace("text", r"\s+", " ")).alias("text"))
