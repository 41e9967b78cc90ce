"""Text to sections: line types, then gaps and islands as window functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from leafmill.functions.text import lines, strip
from leafmill.operators.hierarchy import hierarchy
from leafmill.session import materialise

# Line patterns.
HEADING_1 = r"^(?:[IVX]+|[0-9]+)\.\p{IsWhite_Space}+[A-Z][A-Za-z0-9:–—\-\p{IsWhite_Space}]{3,100}$"
HEADING_2 = r"^[0-9]+\.[0-9]+\p{IsWhite_Space}+[A-Z][A-Za-z0-9:–—\-\p{IsWhite_Space}]{3,100}$"
HEADING_3 = r"^[0-9]+\.[0-9]+\.[0-9]+\p{IsWhite_Space}+[A-Z][A-Za-z0-9:–—\-\p{IsWhite_Space}]{3,100}$"
CAPITALS = r"^[A-Z0-9:–—\-\p{IsWhite_Space}]{5,80}$"
LIST_ITEM = r"^(?:[-•●▪◦▸►]|[0-9]+[.)]\p{IsWhite_Space}|[a-z][.)]\p{IsWhite_Space})"
CAPTION = r"(?i)^(?:Figure|Fig\.?|Table|Exhibit)\p{IsWhite_Space}+[0-9]+.*"
ROOT_TITLE = "Document Root"


def line_type(c: Column) -> Column:
    return (
        F.when(c.rlike(HEADING_1), "h1").when(c.rlike(HEADING_2), "h2").when(c.rlike(HEADING_3), "h3")
        .when(c.rlike(CAPITALS) & ~c.rlike(CAPTION), "h1").when(c.rlike(LIST_ITEM), "list_item").when(c.rlike(CAPTION), "caption").otherwise("paragraph")
    )


def parse_sections(docs: DataFrame, doc: str = "id", content: str = "content") -> DataFrame:
    """(doc_id, order_index, section_type, title, content, level) of every document.

    A document starts with an empty root section; each heading is a section; between headings, each run of lines of one type is one. The first line after
    a heading opens a paragraph whatever its type. Null and blank texts have the root only; repeated rows count once (the greatest text of an id).
    """
    d = docs.where(F.col(doc).isNotNull()).groupBy(F.col(doc).alias("doc_id")).agg(F.max(content).alias("_t"))
    typed = d.select("doc_id", F.posexplode(lines(F.col("_t"))).alias("pos", "raw")).select("doc_id", "pos", strip(F.col("raw")).alias("line")).where("line <> ''").withColumn("t", line_type(F.col("line")))
    by = W.partitionBy("doc_id").orderBy("pos")
    head = F.col("t").isin("h1", "h2", "h3")
    x = typed.withColumn("seg", F.sum(head.cast("int")).over(by))
    in_seg = W.partitionBy("doc_id", "seg").orderBy("pos")
    x = x.withColumn("nth", F.sum((~head).cast("int")).over(in_seg))
    kind = F.when(F.col("nth") == 1, "paragraph").otherwise(F.col("t"))
    x = x.withColumn("ct", F.when(~head, kind))
    x = x.withColumn("brk", (F.col("nth") > 1) & (F.col("t") != F.lag("ct").over(in_seg)))
    x = x.withColumn("block", F.when(head, -1).otherwise(F.sum(F.col("brk").cast("int")).over(in_seg)))
    g = x.groupBy("doc_id", "seg", "block").agg(F.min("pos").alias("pos"), F.min_by("t", "pos").alias("t0"), F.min_by("ct", "pos").alias("ct"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "line"))), lambda s: s["line"]), "\n").alias("content"))
    g = g.withColumn("heading", F.first(F.when(F.col("block") == -1, F.struct(F.substring("content", 1, 255).alias("title"), F.substring("t0", 2, 1).cast("int").alias("level"))), ignorenulls=True).over(W.partitionBy("doc_id", "seg")))
    is_head = F.col("block") == -1
    body = g.select(
        "doc_id", "pos", F.when(is_head, "heading").otherwise(F.col("ct")).alias("section_type"), F.coalesce("heading.title", F.lit(ROOT_TITLE)).alias("title"), "content",
        F.when(is_head, F.col("heading.level")).otherwise(F.coalesce("heading.level", F.lit(0)) + 1).alias("level"),
    )
    root = d.select("doc_id", F.lit(-1).alias("pos"), F.lit("paragraph").alias("section_type"), F.lit(ROOT_TITLE).alias("title"), F.lit("").alias("content"), F.lit(0).alias("level"))
    every = root.unionByName(body)
    return every.select("doc_id", (F.row_number().over(by) - 1).alias("order_index"), "section_type", "title", "content", "level")


def document_tree(sections: DataFrame) -> DataFrame:
    """(doc_id, tree): one JSON document per doc_id, its sections in order; built from flat sections, whose depth is one."""
    s = F.struct("order_index", "section_type", "title", "level", "content")
    return sections.groupBy("doc_id").agg(F.to_json(F.struct(F.array_sort(F.collect_list(s)).alias("sections"))).alias("tree"))


def section_tree(sections: DataFrame) -> DataFrame:
    """(doc_id, tree): one JSON array a document, its sections nested below their parents by `children`, in order.

    A parent that is null, no section's id, or of another document leaves a section at the top, as does a chain of parents that ends in a circle. A document with
    a section without id is a flat list. Repeated rows count once, the greatest of an id. Sections are sorted as a walk through their tree meets them, so that
    each one's text only needs the depth of the next to close the right brackets: no step is repeated by level.
    """
    cols = ["order_index", "section_type", "title", "level", "content"]
    rows = sections.where("doc_id IS NOT NULL").select("doc_id", "id", "parent_section_id", *cols).distinct()
    flat = rows.groupBy("doc_id").agg(F.max(F.col("id").isNull()).alias("flat")).where("flat").select("doc_id", F.lit(True).alias("flat"))
    plain = rows.join(flat, "doc_id", "left")
    one = plain.where("flat IS NULL").groupBy("id").agg(F.max(F.struct("doc_id", "parent_section_id", *cols)).alias("s")).select("id", "s.*")
    up = one.select(F.col("id").alias("parent_section_id"), F.col("doc_id").alias("up_doc"))
    one = one.join(up, "parent_section_id", "left").withColumn("parent_section_id", F.when(F.col("up_doc") == F.col("doc_id"), F.col("parent_section_id")))
    one = materialise(one.drop("up_doc"))
    placed = materialise(hierarchy(one.select("id", "doc_id", "parent_section_id")))
    order = one.select("id", F.coalesce("order_index", F.lit(-1)).alias("o"))
    # the way down to a section, as the places of those on it among their siblings
    way = placed.select("id", F.posexplode(F.coalesce("path", F.array("id"))).alias("pos", "up")).join(order.withColumnRenamed("id", "up"), "up")
    way = way.groupBy("id").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "o", "up"))), lambda s: F.struct(s["o"], s["up"])).alias("way"))
    as_json = F.to_json(F.struct("id", *cols), {"ignoreNullFields": "false"})
    nodes = one.join(way, "id").select("doc_id", "way", (F.size("way") - 1).alias("depth"), F.regexp_replace(as_json, r"\}$", ',"children":[').alias("json"))
    rows_flat = plain.where("flat").select("doc_id", F.array(F.struct(F.coalesce("order_index", F.lit(-1)).alias("o"), F.coalesce("id", F.lit(-1)).alias("up"))).alias("way"), F.lit(0).alias("depth"), F.regexp_replace(as_json, r"\}$", ',"children":[').alias("json"))
    # a document's tree is one row, so that its sections meet in one task is in the result's nature
    after = F.lead("depth").over(W.partitionBy("doc_id").orderBy("way", "json"))
    closed = nodes.unionByName(rows_flat).withColumn("after", after)
    text = F.concat("json", F.repeat(F.lit("]}"), F.col("depth") - F.coalesce("after", F.lit(0)) + 1), F.when(F.col("after") <= F.col("depth"), ",").otherwise(""))
    listed = F.array_sort(F.collect_list(F.struct("way", text.alias("text"))))
    return closed.groupBy("doc_id").agg(F.concat(F.lit("["), F.array_join(F.transform(listed, lambda s: s["text"]), ""), F.lit("]")).alias("tree"))


def represented(documents: DataFrame, trees: DataFrame) -> DataFrame:
    """Documents whose metadata_json is replaced by {"unified_representation": {"document": ..., "sections": [...]}}; what the column held stays in document.metadata. Documents without sections have an empty list."""
    kept = F.coalesce(F.to_json(F.try_parse_json("metadata_json")), F.lit("null"))
    doc = F.to_json(F.struct("id", "filename", "title", "doc_type"), {"ignoreNullFields": "false"})
    doc = F.concat(F.regexp_replace(doc, r"\}$", ""), F.lit(',"metadata":'), kept, F.lit("}"))
    j = documents.join(trees.withColumnRenamed("doc_id", "id"), "id", "left")
    whole = F.concat(F.lit('{"unified_representation":{"document":'), doc, F.lit(',"sections":'), F.coalesce("tree", F.lit("[]")), F.lit("}}"))
    return j.withColumn("metadata_json", whole).select(*documents.columns)
