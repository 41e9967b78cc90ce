"""One form for texts that a reader cannot tell apart."""

from __future__ import annotations

import functools
import hashlib
import re
import sys
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.session import materialise

#: Copies of one text are spread over so many keys.
SALTS = 8
# Letters of other alphabets whose printed shape is a Latin letter's.
SAME_SHAPE = (
    ("АВЕЅІЈКМНОРСТУХҮԌԚԜӀ", "ABESIJKMHOPCTYXYGQWI"),  # Cyrillic capitals
    ("асеоруѕіјхһԁԛԝѵ", "aceopysijxhdqwv"),  # Cyrillic small letters
    ("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧ", "ABEZHIKMNOPTYX"),  # Greek capitals
    ("οϲϳ", "ocj"),  # Greek small letters
)
# Hyphens of one printed length; longer dashes and the minus sign stay.
HYPHENS = "\u2010\u2011\ufe63\uff0d"
# What joins letters or pictures visibly where it stands between them.
JOINERS = "\u200c\u200d"

_PICTURE = regex.compile(r"\p{Extended_Pictographic}")
_JOINING = regex.compile(r"[\p{Arabic}\p{Syriac}\p{Devanagari}\p{Bengali}\p{Malayalam}\p{Sinhala}\p{Mongolian}]")
_KEEP_KINDS = {"<wide>", "<narrow>", "<noBreak>", "<initial>", "<medial>", "<final>", "<isolated>"}
_ASTRAL = re.compile("[\U00010000-\U0010ffff]")
_GAP = re.compile(r"[ \t]+")
_EDGE = re.compile(r"^ | $", re.M)


def _compatible(ch: str) -> str | None:
    """What `ch` looks exactly like by its compatibility decomposition; None where the decomposition changes its looks."""
    kind, _, codes = unicodedata.decomposition(ch).partition(" ")
    if not kind.startswith("<"):
        return None
    said, name = "".join(chr(int(c, 16)) for c in codes.split()), unicodedata.name(ch, "")
    if kind in _KEEP_KINDS:
        return said if len(said) <= 3 else None  # a whole phrase drawn as one sign has a shape of its own
    if kind == "<compat>":
        if "LIGATURE" in name or "ROMAN NUMERAL" in name or name.startswith(("LATIN CAPITAL LETTER DZ", "LATIN SMALL LETTER DZ", "LATIN CAPITAL LETTER LJ", "LATIN SMALL LETTER LJ", "LATIN CAPITAL LETTER NJ", "LATIN SMALL LETTER NJ")):
            return said
        if ch in "µ…‥ĿŀŉΫ℃℉" or unicodedata.category(ch) == "Zs" or 0x2F00 <= ord(ch) < 0x2FE0:
            return said
    return None


@functools.cache
def _tables(fold_looks: bool) -> tuple[dict[str, str], re.Pattern, re.Pattern]:
    """Every character that changes, with its form, by rule over all code points; and the patterns that find them, in the first plane (one table lookup a character) and beyond."""
    shape = {a: b for olds, news in SAME_SHAPE for a, b in zip(olds, news, strict=True)} if fold_looks else {}
    ignorable = regex.compile(r"[\p{Default_Ignorable_Code_Point}--\u115f\u1160\u3164\uffa0]|[\u0000-\u0008\u000e-\u001f\u007f-\u0084\u0086-\u009f\ufff9-\ufffb]", regex.V1)
    to: dict[str, str] = {}
    for code in range(sys.maxunicode + 1):
        if 0xD800 <= code < 0xE000 or 0x3400 <= code < 0xA000 or 0xAC00 <= code < 0xD7A4 or 0x20000 <= code < 0xE0000:
            continue
        ch = chr(code)
        if ch in JOINERS:
            continue
        if ignorable.match(ch):
            to[ch] = ""
        elif ch in HYPHENS:
            to[ch] = "-"
        elif unicodedata.category(ch) == "Zs":
            to[ch] = " "
        else:
            said = unicodedata.normalize("NFD", _compatible(ch) or ch)
            new = unicodedata.normalize("NFC", "".join(shape.get(x, x) for x in said))
            if new != ch:
                to[ch] = new
    to |= {c: "\n" for c in "\x0b\x0c\x85\u2028\u2029"}
    del to[" "]
    return to, _class([c for c in to if c <= "\uffff"]), _class([c for c in to if c > "\uffff"])


def _class(chars: list[str]) -> re.Pattern:
    spans: list[list[int]] = []
    for c in sorted(map(ord, chars)):
        if spans and spans[-1][1] == c - 1:
            spans[-1][1] = c
        else:
            spans.append([c, c])
    return re.compile("[" + "".join(f"{re.escape(chr(x))}-{re.escape(chr(y))}" for x, y in spans) + "]")


def look_form(text: str | None, fold_case: bool = False, fold_looks: bool = True) -> str | None:
    """The form shared by all texts that look like `text`; null stays null.

    Canonical composition; the width of letters, digits and spaces, ligatures and letters of equal shape folded (`fold_looks`
    off keeps alphabets apart); every gap of blanks one space, blanks at line ends and around the text gone; what shows nothing removed.
    Joiners stay where they change the picture: between two pictographs, or two letters of a joining script. Superscripts,
    fractions, circled signs, accents, dashes of another length and case stay; `fold_case` adds full case folding.
    """
    if text is None:
        return None
    if "\r" in text:
        text = text.replace("\r\n", "\n").replace("\r", "\n")
    if not text.isascii():
        to, special, beyond = _tables(fold_looks)
        text = special.sub(lambda m: to[m[0]], unicodedata.normalize("NFC", text))
        if _ASTRAL.search(text):
            text = beyond.sub(lambda m: to[m[0]], text)
        for j in JOINERS:
            if j in text:
                text = _joiners(text, j)
        text = unicodedata.normalize("NFC", text)
    elif not text.isprintable():
        to, special, _ = _tables(fold_looks)
        text = special.sub(lambda m: to[m[0]], text)
    text = _EDGE.sub("", _GAP.sub(" ", text)).strip()
    return unicodedata.normalize("NFC", text.casefold()) if fold_case else text


def _joiners(text: str, j: str) -> str:
    out, parts = [], text.split(j)
    for a, b in zip(parts, parts[1:], strict=False):
        out.append(a)
        before = a[-1:]
        both = before and b and ((_PICTURE.match(before) and _PICTURE.match(b[0])) or (_JOINING.match(before) and _JOINING.match(b[0])))
        if both:
            out.append(j)
    return "".join([*out, parts[-1]])


MEMO = 200_000


class _Known(dict):
    """Forms, or their digests, by the digest of a text: each distinct text met in a task is worked out once; starts anew when full."""

    def __missing__(self, key: bytes) -> None:
        if len(self) > MEMO:
            self.clear()
        return None


def _digest(s: str) -> bytes:
    return hashlib.md5(s.encode("utf-8", "surrogatepass")).digest()


def normalise_looks(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", fold_case: bool = False, fold_looks: bool = True) -> DataFrame:
    """(id, form) of every row, repeated rows included once for each; each distinct text of a batch is worked out once, where it lies: nothing is shuffled.

    Null text: null form. Blank text: empty form. Other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            values = b.column(1).dictionary_encode()
            forms = pa.array([look_form(t, fold_case, fold_looks) for t in values.dictionary.to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([b.column(0), forms.take(values.indices)], [id_col, "form"])

    return df.select(F.col(id_col), F.col(text_col)).mapInArrow(run, f"`{id_col}` {dict(df.dtypes)[id_col]}, form string")


def look_classes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", fold_case: bool = False) -> DataFrame:
    """(id, class_id, text_id, n_texts): for every row with something visible, the smallest id of its looks' class, the smallest id with the very same text, and how many different texts the class has.

    One row an id, whatever the number of copies: the whole result for classes of boilerplate, where pairs would be quadratic. Only digests are shuffled; copies are folded before texts meet.
    """
    rows = df.where(F.col(text_col).isNotNull() & F.col(id_col).isNotNull()).select(F.col(id_col).alias("th"), F.col(text_col).alias("text"))
    forms = _with_digest(rows, fold_case)
    texts = forms.groupBy("form", "th").agg(F.min("id").alias("text_id"))
    classes = texts.groupBy("form").agg(F.min("text_id").alias("class_id"), F.count("*").alias("n_texts"))
    named = texts.join(classes, "form").select("th", "text_id", "class_id", "n_texts")
    salt = F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int")  # a text may have a third of all rows as its copies
    spread = named.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return forms.select("id", "th").distinct().withColumn("salt", salt).join(spread, ["th", "salt"]).select(F.col("id").alias(id_col), "class_id", "text_id", "n_texts")


def same_looks(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", fold_case: bool = False) -> DataFrame:
    """Pairs (<id>_a, <id>_b), smaller id first, of rows whose texts differ but share one form.

    Only digests are shuffled, and only forms with two or more different texts go on, so copies of one text, however
    many, meet nobody. Texts with nothing visible, nulls among them, pair with none. Repeated rows count once. The result is as long as there are such
    pairs; `look_classes` has the same in one row an id.
    """
    a, b = f"{id_col}_a", f"{id_col}_b"
    classes = materialise(look_classes(df, id_col, text_col, fold_case).where("n_texts > 1").select(F.col(id_col).alias("id"), "class_id", "text_id"))
    x, y = classes.select(F.col("id").alias("i1"), "class_id", F.col("text_id").alias("t1")), classes.select(F.col("id").alias("i2"), "class_id", F.col("text_id").alias("t2"))
    return x.join(y, "class_id").where("i1 < i2 AND t1 <> t2").select(F.col("i1").alias(a), F.col("i2").alias(b)).distinct()


def _with_digest(rows: DataFrame, fold_case: bool) -> DataFrame:
    """(id, th, form): digests of the text and of its form, each 16 bytes, written once and read by every later step."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Known()
        for b in batches:
            th, fm = [], []
            for text in b.column(1).to_pylist():
                t = _digest(text)
                found = known[t]
                if found is None:
                    form = look_form(text, fold_case)
                    found = known[t] = _digest(form) if form else b""
                th.append(t)
                fm.append(found or None)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(th, pa.binary()), pa.array(fm, pa.binary())], ["id", "th", "form"])

    kind = dict(rows.dtypes)["th"]
    return materialise(rows.mapInArrow(run, f"id {kind}, th binary, form binary").where("form IS NOT NULL"))
