"""Page-level extraction: method choice, tables, column gutters, layout elements."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from leafmill.functions.text import blank, lines, strip

# Layout patterns.
HEADING = r"^(?:[0-9]+\.?\p{IsWhite_Space}+)?[A-Z][A-Za-z:–—\-\p{IsWhite_Space}]{3,80}$"
LIST_ITEM = r"^\p{IsWhite_Space}*(?:[-•●▪◦▸►]|[0-9]+[.)]\p{IsWhite_Space}|[a-z][.)]\p{IsWhite_Space})"
PAGE_NUMBER = r"(?i)^(?:\p{IsWhite_Space}*[-–—]?\p{IsWhite_Space}*[0-9]{1,4}\p{IsWhite_Space}*[-–—]?\p{IsWhite_Space}*|Page\p{IsWhite_Space}+[0-9]+.*)$"
FIGURE = r"(?i)(?:Figure|Fig\.?|Exhibit|Chart|Graph|Diagram)\p{IsWhite_Space}+[0-9]+"
BINS, LOW_SHARE, MIN_GUTTER = 100, 0.1, 3
MIN_OFFSETS, MIN_GAP = 20, 50


def page_method(text: Column, ocr_text: Column) -> Column:
    """struct(method, text): the text layer if it has any, else what was read by OCR, else 'empty'."""
    has = lambda c: F.coalesce(~blank(c), F.lit(False))
    return F.when(has(text), F.struct(F.lit("pdfplumber").alias("method"), text.alias("text"))).when(has(ocr_text), F.struct(F.lit("ocr").alias("method"), ocr_text.alias("text"))).otherwise(F.struct(F.lit("empty").alias("method"), F.lit("").alias("text")))


def format_table(table: Column, page: Column, index: Column) -> Column:
    """A table's rows as ' | '-joined lines under a title; a rule of 40 dashes follows the first."""
    cell = lambda c: strip(F.replace(F.coalesce(c, F.lit("")), F.lit("\n"), F.lit(" ")))
    rows = F.transform(table, lambda r: F.array_join(F.transform(r, cell), " | "))
    body = F.concat(F.slice(rows, 1, 1), F.array(F.lit("-" * 40)), F.slice(rows, 2, F.greatest(F.size(rows) - 1, F.lit(0))))
    title = F.format_string("[Table %d — Page %d]", index, page)
    return F.array_join(F.concat(F.array(title), body), "\n")


def page_tables(page_input: DataFrame) -> DataFrame:
    """(doc_path, page_number, table_no, n_rows, text) of each non-empty table of PAGE_INPUT rows, formatted; table_no counts from 1 on each page."""
    t = page_input.select("doc_path", "page_number", F.posexplode(F.filter("tables", lambda x: F.size(x) > 0)).alias("pos", "t"))
    no = (F.col("pos") + 1).alias("table_no")
    return t.select("doc_path", "page_number", no, F.size("t").alias("n_rows"), format_table(F.col("t"), F.col("page_number"), F.col("pos") + 1).alias("text"))


def page_results(page_input: DataFrame) -> DataFrame:
    """(doc_path, page_number, method, text, has_text) of PAGE_INPUT rows: the chosen text; below a text layer, after a blank line, the page's tables. Rows of files that could not be read have no page and give none."""
    pages = page_input.where("page_number IS NOT NULL").withColumn("m", page_method(F.col("text"), F.col("ocr_text")))
    tables = F.transform(F.filter(F.coalesce("tables", F.array()), lambda x: F.size(x) > 0), lambda x, i: format_table(x, F.col("page_number"), i + 1))
    below = F.when((F.col("m.method") == "pdfplumber") & (F.size(tables) > 0), F.concat(F.lit("\n\n"), F.array_join(tables, "\n\n"))).otherwise("")
    return pages.select("doc_path", "page_number", F.col("m.method").alias("method"), F.concat("m.text", below).alias("text"), (F.col("m.method") != "empty").alias("has_text"))


def format_tables(tables: Column) -> Column:
    """Tables by themselves: cells joined by ' | ', after the first row a rule as long as it but of 40 dashes at least; tables are parted by blank lines."""
    cell = lambda c: strip(F.replace(F.coalesce(c, F.lit("")), F.lit("\n"), F.lit(" ")))
    one = lambda rows: F.array_join(F.concat(F.slice(rows, 1, 1), F.array(F.repeat(F.lit("-"), F.greatest(F.lit(40), F.length(rows[0])))), F.slice(rows, 2, F.greatest(F.size(rows) - 1, F.lit(0)))), "\n")
    joined = F.transform(F.filter(tables, lambda t: F.size(t) > 0), lambda t: F.transform(t, lambda r: F.array_join(F.transform(r, cell), " | ")))
    return F.array_join(F.transform(joined, one), "\n\n")


def drawn_elements(page_input: DataFrame) -> DataFrame:
    """(doc_path, page_number, element_type, confidence, preview): one row a table of a page, and one for a page with images."""
    tables = page_tables(page_input).select("doc_path", "page_number", F.lit("table").alias("element_type"), F.lit(0.9).alias("confidence"), F.format_string("Table with %d rows", "n_rows").alias("preview"))
    figures = page_input.where("n_images > 0").select("doc_path", "page_number", F.lit("figure").alias("element_type"), F.lit(0.9).alias("confidence"), F.format_string("%d images", "n_images").alias("preview"))
    return tables.unionByName(figures)


def median_size(chars: DataFrame, page: str = "page", size: str = "size") -> DataFrame:
    """(page, median_size): the upper median of the sizes of a page's characters; null sizes don't count, a page without any has no row."""
    c = chars.where(F.col(size).isNotNull())
    by_value = c.groupBy(page, F.col(size).alias("_s")).agg(F.count("*").alias("n"))  # sizes are few: what is sorted is small
    before = F.sum("n").over(W.partitionBy(page).orderBy("_s")) - F.col("n")
    whole = F.sum("n").over(W.partitionBy(page))
    return by_value.withColumns({"lo": before, "all": whole}).where("lo <= all DIV 2 AND all DIV 2 < lo + n").select(page, F.col("_s").alias("median_size"))


def multi_column(chars: DataFrame, page: str = "page", x0: str = "x0") -> DataFrame:
    """(page, multi_column): whether a page's characters begin at over 20 different whole offsets with a gap of over 50 between two of them."""
    xs = chars.where(F.col(x0).isNotNull()).select(page, F.col(x0).cast("int").alias("x")).distinct()
    gap = F.col("x") - F.lag("x").over(W.partitionBy(page).orderBy("x"))
    return xs.withColumn("gap", gap).groupBy(page).agg(((F.count("*") > MIN_OFFSETS) & (F.coalesce(F.max("gap"), F.lit(0)) > MIN_GAP)).alias("multi_column"))


def method_counts(pages: DataFrame) -> DataFrame:
    """Pages by method a document, repeated rows once."""
    p = pages.select("doc_id", "page_number", "method").distinct()
    return p.groupBy("doc_id").agg(F.count("*").alias("pages"), *(F.count_if(F.col("method") == m).alias(m) for m in ("pdfplumber", "ocr", "empty")))


def full_text(pages: DataFrame) -> DataFrame:
    """(doc_id, text): non-blank pages joined by blank lines in page order."""
    p = pages.where(F.col("text").isNotNull() & ~blank(F.col("text"))).groupBy("doc_id", "page_number").agg(F.max("text").alias("text"))
    return p.groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page_number", "text"))), lambda s: s["text"]), "\n\n").alias("text"))


def layout_elements(pages: DataFrame) -> DataFrame:
    """(doc_id, page_number, line_no, element_type, confidence, preview): one element a non-blank line, another for a figure reference in it."""
    p = pages.where("text IS NOT NULL").groupBy("doc_id", "page_number").agg(F.max("text").alias("text"))
    x = p.select("doc_id", "page_number", F.posexplode(lines(F.col("text"))).alias("line_no", "raw"))
    x = x.withColumn("line", strip(F.col("raw"))).where("line <> ''")
    kind = F.when(F.col("line").rlike(HEADING), F.struct(F.lit("heading").alias("t"), F.lit(0.7).alias("c"))).when(F.col("line").rlike(LIST_ITEM), F.struct(F.lit("list_item").alias("t"), F.lit(1.0).alias("c"))).when(F.col("line").rlike(PAGE_NUMBER), F.struct(F.lit("page_number").alias("t"), F.lit(1.0).alias("c"))).otherwise(F.struct(F.lit("paragraph").alias("t"), F.lit(0.6).alias("c")))
    figure = F.when(F.col("line").rlike(FIGURE), F.array(F.struct(F.lit("figure_reference").alias("t"), F.lit(0.8).alias("c")))).otherwise(F.array().cast("array<struct<t:string,c:double>>"))
    e = x.select("doc_id", "page_number", "line_no", F.explode(F.concat(F.array(kind), figure)).alias("k"), F.substring("line", 1, 80).alias("preview"))
    return e.select("doc_id", "page_number", "line_no", F.col("k.t").alias("element_type"), F.col("k.c").alias("confidence"), "preview")


def page_flags(pages: DataFrame) -> DataFrame:
    """(doc_id, page_number, has_header, has_footer): a first line under 80 characters; a last line that is a page number or under 30. A page without text has both."""
    p = pages.groupBy("doc_id", "page_number").agg(F.max("text").alias("text"))
    x = p.withColumn("l", F.filter(F.transform(lines(F.coalesce("text", F.lit(""))), strip), lambda s: s != ""))
    first, last = F.coalesce(F.try_element_at("l", F.lit(1)), F.lit("")), F.coalesce(F.try_element_at("l", F.lit(-1)), F.lit(""))
    return x.select("doc_id", "page_number", (F.length(first) < 80).alias("has_header"), (last.rlike(PAGE_NUMBER) | (F.length(last) < 30)).alias("has_footer"))


def layout_summary(elements: DataFrame) -> DataFrame:
    return elements.groupBy("doc_id").agg(F.concat(F.lit("Detected elements: "), F.coalesce(F.nullif(F.array_join(F.array_sort(F.collect_set("element_type")), ", "), F.lit("")), F.lit("none"))).alias("summary"))


def gutters(chars: DataFrame, page: str = "page", x0: str = "x0", width: str = "width") -> DataFrame:
    """(page, start_bin, end_bin, split): the widest run of thin bins in a page's middle half, the first one on a tie; no row for a page without one of MIN_GUTTER bins."""
    binned = chars.where(F.col(x0).isNotNull() & (F.col(width) > 0)).select(page, width, F.least(F.floor(F.col(x0) / (F.col(width) / BINS)), F.lit(BINS - 1)).cast("int").alias("b"))
    counts = binned.groupBy(page, "b").agg(F.count("*").alias("n"))
    total = binned.groupBy(page).agg((F.count("*") / BINS).alias("mean"), F.max(width).alias("w"))
    grid = total.select(page, "mean", "w", F.explode(F.sequence(F.lit(BINS // 4), F.lit(BINS * 3 // 4 - 1))).alias("b"))
    low = grid.join(counts, [page, "b"], "left").where(F.coalesce("n", F.lit(0)) <= F.col("mean") * LOW_SHARE)
    runs = low.withColumn("g", F.col("b") - F.row_number().over(W.partitionBy(page).orderBy("b"))).groupBy(page, "g").agg(F.min("b").alias("start_bin"), F.max("b").alias("end_bin"), F.max("w").alias("w"))
    best = runs.where(F.col("end_bin") - F.col("start_bin") + 1 >= MIN_GUTTER).groupBy(page).agg(F.max(F.struct((F.col("end_bin") - F.col("start_bin")).alias("len"), (-F.col("start_bin")).alias("first"), "start_bin", "end_bin", "w")).alias("s"))
    return best.select(page, "s.start_bin", "s.end_bin", ((F.col("s.start_bin") + F.col("s.end_bin") + 1) / 2 * F.col("s.w") / BINS).alias("split"))
