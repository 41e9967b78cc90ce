"""Entities and co-occurrence edges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.functions.text import strip, title_case

# Labels that are no entities.
DROPPED_LABELS = ("CARDINAL", "ORDINAL", "QUANTITY", "PERCENT")
CONFIDENCE = 0.5
# What a company's name may end in, titles of people, months, currencies, words of places and of facilities.
COMPANY = "Inc|Corp|Corporation|Company|Co|Ltd|Limited|LLC|LLP|PLC|GmbH|AG|KG|SE|SA|SARL|SpA|BV|NV|AB|Oy|Group|Holdings|Holding|Systems|Energy|Foods|Works|Paper|Marine|Retail|Logistics|Cement|Chemicals|Textiles|Utilities|Bank|Partners|Industries|Technologies|University|Institute|Ministry|Agency|Commission|Committee|Association|Foundation"
TITLE = "Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Sir|Señor|Señora|Madame|Monsieur"
MONTH = "January|February|March|April|May|June|July|August|September|October|November|December|Januar|Februar|März|Mai|Juni|Juli|Oktober|Dezember"
CURRENCY = "USD|EUR|GBP|CHF|JPY|dollars|euros|pounds"
PLACE = "River|Lake|Mount|City|County|Province|Island|Bay|Valley|Street|Avenue|Road"
_NAME = r"[A-ZÄÖÜÉ][A-Za-zÄÖÜäöüßéèêáóñç&'-]+"
# The rules in order of precedence; each is tried where the ones before find nothing, from left to right.
RULES = {
    "PERCENT": r"\b[0-9]+(?:[.,][0-9]+)? ?(?:%|percent|Prozent)",
    "MONEY": rf"(?:[$€£] ?[0-9][0-9.,]*(?: (?:million|billion))?|\b[0-9][0-9.,]* (?:{CURRENCY})\b)",
    "DATE": rf"(?:\b[0-9]{{1,2}}\.? (?:{MONTH}) [0-9]{{4}}\b|\b(?:{MONTH}) [0-9]{{1,2}}, [0-9]{{4}}\b|\b(?:{MONTH}) [0-9]{{4}}\b|\b[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}\b|\b(?:19|20)[0-9][0-9]\b)",
    "ORG": rf"(?:{_NAME} ){{1,5}}(?:{COMPANY})\b",
    "PERSON": rf"\b(?:{TITLE})\.? {_NAME}(?: {_NAME})?",
    "LOC": rf"(?:{_NAME} ){{1,3}}(?:{PLACE})\b",
    "ORDINAL": r"\b[0-9]+(?:st|nd|rd|th)\b",
    "CARDINAL": r"\b[0-9]+(?:[.,][0-9]+)*\b",
}
SENTENCE_END = r"(?<=[.!?])\s+"


def label_of(name: Column) -> Column:
    """The first rule that a found name fits as a whole."""
    out = F.lit(None).cast("string")
    for label, rule in reversed(RULES.items()):
        out = F.when(name.rlike(f"^(?:{rule})$"), label).otherwise(out)
    return out


def rule_entities(chunks: DataFrame, id_col: str = "id", doc_col: str = "doc_id", text_col: str = "content") -> DataFrame:
    """(doc_id, chunk_id, sentence_no, pos, name, label) by rules, in the order of their places: numbers, dates, amounts, and capitalised names with a telling word.

    Stands in for a trained recogniser, which isn't reproduced; any frame of this shape can take its place. Expressions only: whole texts are read, and none leaves the JVM. Null texts have none.
    """
    s = chunks.where(F.col(text_col).isNotNull()).select(F.col(doc_col).cast("long").alias("doc_id"), F.col(id_col).cast("long").alias("chunk_id"), F.posexplode(F.split(text_col, SENTENCE_END)).alias("sentence_no", "sentence"))
    every = "|".join(RULES.values())
    found = s.select("doc_id", "chunk_id", "sentence_no", F.posexplode(F.regexp_extract_all("sentence", F.lit(f"({every})"), F.lit(1))).alias("pos", "name"))
    return found.withColumn("label", label_of(F.col("name")))


def usable_entities(mentions: DataFrame) -> DataFrame:
    m = mentions.where(~F.col("label").isin(*DROPPED_LABELS)).withColumn("name", title_case(strip(F.col("name"))))
    return m.where(F.length("name") >= 2)


def entity_counts(mentions: DataFrame, previous: DataFrame | None = None) -> DataFrame:
    """(doc_id, name, entity_type, count): additive upsert as an aggregate; `previous` counts are added in."""
    m = mentions.select("doc_id", "name", F.col("label").alias("entity_type"), F.lit(1).cast("long").alias("count"))
    if previous is not None:
        m = m.unionByName(previous.select("doc_id", "name", "entity_type", "count"))
    return m.groupBy("doc_id", "name", "entity_type").agg(F.sum("count").alias("count"))


def cooccurrences(mentions: DataFrame, sentence: list[str]) -> DataFrame:
    """Every ordered pair of different names in a sentence, earlier first, repeated as often as it occurs; an equi-join on the sentence."""
    a = mentions.select(*sentence, F.col("pos").alias("p1"), F.col("name").alias("source_entity"))
    b = mentions.select(*sentence, F.col("pos").alias("p2"), F.col("name").alias("target_entity"))
    j = a.join(b, sentence).where("p1 < p2 AND source_entity <> target_entity")
    return j.select(*sentence, "source_entity", "target_entity", F.lit("co_occurs").alias("relation_type"), F.lit(CONFIDENCE).alias("confidence"))


def with_ids(edges: DataFrame, entities: DataFrame) -> DataFrame:
    """Edges with source_id and target_id: the id of the entity of that name in their document, of several types the greatest id; null where there is none."""
    ids = entities.groupBy("doc_id", "name").agg(F.max("id").alias("id"))
    out = edges
    for side in ("source", "target"):
        out = out.join(ids.select("doc_id", F.col("name").alias(f"{side}_entity"), F.col("id").alias(f"{side}_id")), ["doc_id", f"{side}_entity"], "left")
    return out


def edges_in(edges: DataFrame, doc_id: int) -> DataFrame:
    """A document's relationships, most confident first."""
    return edges.where(F.col("doc_id") == doc_id).orderBy(F.desc("confidence"), "source_entity", "target_entity")


def edges_of(edges: DataFrame, name: str) -> DataFrame:
    return edges.where((F.col("source_entity") == name) | (F.col("target_entity") == name)).orderBy(F.desc("confidence"), "source_entity", "target_entity")


def search_names(entities: DataFrame, q: str, limit: int = 50) -> DataFrame:
    return entities.where(F.col("name").ilike(f"%{q}%")).orderBy(F.desc("count"), "name").limit(limit)
