"""Noise in text from scanned pages: running headers, page labels, words broken at line ends, misread characters.

Headers are edge lines that recur on pages of their document, compared by a skeleton in which often confused letters are alike and, for the
rest, by edit distance to a recurring line. Page labels are edge lines whose values follow the pages' numbers. What a line's last word
continues as, and whether a rare word is a frequent one misread, is looked up in the corpus' own vocabulary by joins;
nothing that grows with the corpus is broadcast: a bounded list of the most frequent words only saves looking those up.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.session import materialise, shuffle_partitions

#: What scanners take for what (read, printed).
CONFUSIONS = (
    ("c", "e"), ("e", "c"), ("0", "o"), ("o", "0"), ("1", "l"), ("l", "1"), ("1", "i"), ("!", "i"), ("!", "l"), ("|", "l"), ("|", "i"), ("5", "s"), ("s", "5"), ("9", "g"), ("g", "9"),
    ("8", "b"), ("6", "é"), ("e", "é"), ("c", "é"), ("é", "e"), ("b", "h"), ("h", "b"), ("f", "t"), ("t", "f"), ("2", "z"), ("l", "i"), ("i", "l"), ("j", "i"), ("q", "g"), ("n", "u"), ("u", "n"), ("v", "y"), ("4", "a"), ("3", "e"), ("ö", "o"), ("o", "ö"),
    ("rn", "m"), ("m", "rn"), ("m", "in"), ("in", "m"), ("ni", "m"), ("m", "ni"), ("ii", "u"), ("u", "ii"), ("cl", "d"), ("d", "cl"), ("vv", "w"), ("w", "vv"), ("ri", "n"), ("n", "ri"), ("li", "h"), ("h", "li"), ("hn", "lin"), ("ti", "h"), ("fi", "h"), ("tl", "d"), ("iii", "m"), ("nn", "m"), ("rr", "n"),
)
END_MARKS = "-­¬‐‑"
EDGE = ".,;:!?…()[]{}\"'“”‘’«»„–—*•▪"
UNREADABLE = "�"
#: Share of an edge line's letters that may differ from a recurring line's.
HEADER_DIFFERENCE = 0.2
#: How many of the most frequent words each task holds; all others are looked up by a join, so this saves look-ups and decides nothing.
FREQUENT_WORDS = 50_000
#: A word that confusions explain is another one misread if that one is at least so many times as frequent: for words met up to FEW times, and for others.
FEW = 3
TIMES_AS_FREQUENT = (6, 25)

_STRAY = re.compile(r"[`|¦^~°•¬¨´_=\\<>#@¤§{}*+]{1,3}")
_INSIDE = re.compile(r"(?<=[^\W\d_])[`^¦|~°¨´_\\](?=[^\W\d_])")
_INSIDE_KEY = re.compile(r"(?<=[^\W\d_])[`^¦~°¨´\\](?=[^\W\d_])")  # | may be a letter's stroke
_NUMBERISH = re.compile(r"(?=.*\d)(?=.*[OolISB])[\dOolISB][\dOolISB.,]*%?")
_STROKES = str.maketrans({"m": "iii", "n": "ii", "u": "ii", "h": "ii", "b": "ii", "8": "ii", "6": "c", "é": "c", "w": "vv", "d": "ci", "r": "i", "l": "i", "1": "i", "!": "i", "|": "i", "j": "i", "t": "i", "f": "i", "e": "c", "3": "c", "0": "o", "ö": "o", "5": "s", "9": "g", "q": "g", "2": "z", "y": "v", "4": "a"})
_BY_READ: dict[str, list[str]] = defaultdict(list)
for _read, _printed in CONFUSIONS:
    _BY_READ[_read].append(_printed)
_LONGEST = max(map(len, _BY_READ))

_DIGIT = {"O": "0", "o": "0", "Q": "0", "D": "0", "l": "1", "I": "1", "i": "1", "|": "1", "!": "1", "Z": "2", "z": "2", "S": "5", "s": "5", "B": "8", "b": "8", "g": "9", "q": "9", "G": "6"}
# Words before a page number, and between it and the number of pages.
LABEL_WORDS = ("page", "pages", "pag", "pg", "pp", "p", "seite", "s", "página", "pagina", "pág", "folio", "стр", "страница", "с")
LABEL_OF = ("of", "von", "de", "sur", "из", "/")
_LABEL_WORD = r"(?P<word>[^\W\d_][^\s\d.]*?)(?:\s*[.:]\s*|\s+|(?=\d))"
_LABEL_NUMBER = r"(?P<n>[0-9OoQDlIi|!ZzSsBbgqG�]{1,5}|[ivxlcIVXLC1!|]{1,7})(?:\s*(?P<of>[^\W\d_]\S{0,3}|/)\s*(?P<m>[0-9OoQDlIi|!ZzSsBbgqG�]{1,5}))?\W*"
_LABELS = (re.compile(rf"\W*{_LABEL_WORD}{_LABEL_NUMBER}"), re.compile(rf"\W*(?P<word>){_LABEL_NUMBER}"))


@lru_cache(100_000)
def strokes(word: str) -> str:
    """A word's skeleton: letters that are confused with each other are written as the same strokes."""
    return word.lower().translate(_STROKES)


def misreading(read: str, printed: str) -> list[int] | None:
    """Offsets in `read` at which it differs from `printed`, if the confusions explain all of it; else None. Both in small letters."""
    best: dict[tuple[int, int], list[int] | None] = {}

    def go(i: int, j: int) -> list[int] | None:
        key = (i, j)
        if key in best:
            return best[key]
        found = None
        if i == len(read) and j == len(printed):
            found = []
        else:
            options = []
            if i < len(read) and j < len(printed) and read[i] == printed[j] and (rest := go(i + 1, j + 1)) is not None:
                options.append(rest)
            for k in range(1, _LONGEST + 1):
                for p in _BY_READ.get(read[i : i + k], ()) if i + k <= len(read) else ():
                    if printed.startswith(p, j) and (rest := go(i + k, j + len(p))) is not None:
                        options.append([i, *rest])
            if options:
                found = min(options, key=len)
        best[key] = found
        return found

    return go(0, 0)


def _distance(a: str, b: str, most: int) -> int:
    """Edit distance, or most + 1 where it is larger; an unreadable character equals any."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        prev, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (x != y and UNREADABLE not in (x, y)))
        if min(row) > most:
            return most + 1
    return row[-1]


def _roman(s: str) -> int:
    value = {"i": 1, "v": 5, "x": 10, "l": 50, "c": 100}
    total = last = 0
    for ch in reversed(s):
        v = value[ch]
        total, last = (total - v, last) if v < last else (total + v, v)
    return total


def page_label(line: str) -> tuple[str, int | None] | None:
    """(format, value) if a line holds nothing but what may be a page's printed label, misread characters allowed; value None where unreadable."""
    s = line.strip()
    if len(s) > 40:
        return None
    return next((got for m in map(lambda p: p.fullmatch(s), _LABELS) if m and (got := _label(s, m))), None)


def _label(s: str, m: re.Match) -> tuple[str, int | None] | None:
    word, n, of = (m["word"] or "").lower(), m["n"], (m["of"] or "").lower()
    if word and not any(_distance(strokes(word), strokes(w), (len(w) > 2) + 0) <= (len(w) > 3) for w in LABEL_WORDS):
        return None
    if of and not any(strokes(of) == strokes(o) or _distance(of, o, 1) <= (len(o) > 2) for o in LABEL_OF):
        return None
    digits = "".join(_DIGIT.get(c, c) for c in n)
    if any(c.isdigit() for c in n) or word or (of and m["m"]) or (s != n and set(n) <= set("lI|!")):
        value = int(digits) if digits.isdigit() else None
        form = "n"
    elif re.fullmatch(r"(?=.)c{0,3}(xc|xl|l?x{0,3})(ix|iv|v?i{0,3})", n.lower()):
        value, form = _roman(n.lower()), "r"
    elif UNREADABLE in n:
        value, form = None, "n"
    elif digits.isdigit() and len(n) <= 3 and s != n:
        value, form = int(digits), "n"
    else:
        return None
    around = re.sub(r"[\w�!|]+", "", re.sub(r"\s+", "", s))
    return ("w" if word else "d" if around or of else "b") + form, value


def _edge_lines(text: str) -> list[tuple[int, str]]:
    shown = [(i, s) for i, s in enumerate(text.split("\n"), 1) if s.strip()]
    return shown if len(shown) <= 4 else [*shown[:2], *shown[-2:]]


def _header_key(line: str) -> str:
    """An edge line without digits, blanks, stray marks, and letters' differences by misreading; what can't be read stays."""
    line = _INSIDE_KEY.sub("", " ".join(t for t in line.split() if not _STRAY.fullmatch(t) or t in "|=+<>#&@§*_•"))
    letters = re.sub(r"(?<![^\W\d_])\d+(?![^\W\d_])|\s+", "", re.sub(r"(?<!\w)[OlISBZ|!\d]+(?!\w)", "", line))
    letters = re.sub(r"(?<=\W)[ivxlcIVXLC]{1,6}$", "", letters)
    return strokes(letters)


def scanned_pages(pages: DataFrame) -> DataFrame:
    """The pages read by OCR that have text, repeated rows once, laid out by document and page and written once: (doc_id, page_number, text, part)."""
    ocr = pages.where("method = 'ocr' AND text IS NOT NULL AND doc_id IS NOT NULL AND page_number IS NOT NULL").select("doc_id", "page_number", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last = TaskContext.get().partitionId(), None
        for b in batches:
            keep = []
            for i, key in enumerate(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)):
                if key != last:
                    keep.append(i)
                last = key
            b = b.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([part] * b.num_rows, pa.int32())], ["doc_id", "page_number", "text", "part"])

    laid = ocr.repartitionByRange(shuffle_partitions(pages.sparkSession), "doc_id", "page_number").sortWithinPartitions("doc_id", "page_number", "text")
    return materialise(laid.mapInArrow(run, "doc_id long, page_number int, text string, part int"))


def furniture(pages: DataFrame) -> DataFrame:
    """(doc_id, page_number, line_no, kind) of headers and page labels, from a `scanned_pages` result."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple] = []
            for doc, page, text in zip(*(b.column(c).to_pylist() for c in ("doc_id", "page_number", "text")), strict=True):
                for no, s in _edge_lines(text):
                    label = page_label(s)
                    out.append((doc, page, no, _header_key(s), *(label or (None, None))))
            kinds = (pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.string(), pa.int64())
            cols = zip(*out, strict=True) if out else [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(cols, kinds, strict=True)], ["doc_id", "page_number", "line_no", "key", "form", "value"])

    edges = materialise(pages.mapInArrow(run, "doc_id long, page_number int, line_no int, key string, form string, value long"))
    # labels: values that follow the page numbers, on two pages or more, vouch for their offset, and for their form of label
    labels = edges.where("form IS NOT NULL").withColumn("off", F.col("value") - F.col("page_number"))
    offsets = labels.where("value IS NOT NULL").groupBy("doc_id", "off").agg(F.count_distinct("page_number").alias("n_off"))
    best = offsets.groupBy("doc_id").agg(F.max(F.struct("n_off", "off")).alias("best"))
    good_form = labels.join(offsets.where("n_off > 1"), ["doc_id", "off"]).groupBy("doc_id", "form").agg(F.lit(True).alias("vouched"))
    size = pages.groupBy("doc_id").agg(F.count("*").alias("n_pages"))
    j = labels.join(offsets, ["doc_id", "off"], "left").join(best, "doc_id", "left").join(good_form, ["doc_id", "form"], "left").join(size, "doc_id")
    worded, bare = F.col("form").startswith("w"), F.col("form").startswith("b")
    near = F.col("value").isNull() | (F.abs(F.col("off") - F.col("best.off")) <= 5)
    alone = (F.col("n_pages") < 3) & (~bare | ((F.col("value") < 400) & (F.abs("off") < 400)))
    is_label = worded | (F.col("n_off") > 1) | (F.col("vouched") & near) | alone
    page_no = j.where(is_label).select("doc_id", "page_number", "line_no", F.lit("page_no").alias("kind"))
    # headers: recurring keys, and lines close to one that recurs
    rest = edges.where("length(key) > 3").join(page_no.select("doc_id", "page_number", "line_no"), ["doc_id", "page_number", "line_no"], "left_anti").select("doc_id", "page_number", "line_no", "key")
    rest = materialise(rest)
    keys = rest.groupBy("doc_id", "key").agg(F.count_distinct("page_number").alias("n"))
    base = keys.where("n > 1").select("doc_id", F.col("key").alias("base"))

    def of_like_length(bases: DataFrame) -> DataFrame:
        """Keys with the bases of their document that are about as long; they meet by length, so a long document is spread over many join keys."""
        most = F.floor(2 + F.length("base") / 8).cast("int")
        spread = bases.withColumn("len", F.explode(F.sequence(F.greatest(F.lit(0), F.length("base") - most), F.length("base") + most)))
        return keys.select("doc_id", "key", F.length("key").alias("len")).join(spread, ["doc_id", "len"]).select("doc_id", "key", "base")

    pair = of_like_length(base)

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for i, (x, y) in enumerate(zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True)):
                if x == y or _distance(x, y, (most := int(HEADER_DIFFERENCE * len(y)))) <= most:
                    keep.append(i)
            yield b.take(pa.array(keep, pa.int64()))

    like = materialise(pair.mapInArrow(close, "doc_id long, key string, base string"))
    # each copy of a header may hold another unreadable character: such a key seen once is a base if it is near no other
    lone = keys.where((F.col("n") == 1) & F.col("key").contains(UNREADABLE)).join(like, ["doc_id", "key"], "left_anti").select("doc_id", F.col("key").alias("base"))
    like = like.unionByName(of_like_length(lone).mapInArrow(close, "doc_id long, key string, base string"))
    member = rest.join(like, ["doc_id", "key"])
    enough = member.groupBy("doc_id", "base").agg(F.count_distinct("page_number").alias("n")).where("n > 2").select("doc_id", "base")
    header = member.join(enough, ["doc_id", "base"], "left_semi").select("doc_id", "page_number", "line_no", F.lit("header").alias("kind")).distinct()
    return materialise(page_no.unionByName(header))


def _bare(token: str) -> str:
    """A token without punctuation around it, in small letters; a mark that starts a word in place of a letter stays."""
    t = token.strip(EDGE)
    if len(token) > 2 and token[0] in "!|" and token[1:2].isalpha():
        t = token[0] + t
    return t.lower()


def vocabulary(pages: DataFrame) -> DataFrame:
    """(word, n): how often each word occurs on all pages, whatever their method, repeated rows once; parts of words broken at line ends are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw: Counter = Counter()
            for text in b.column(0).to_pylist():
                broken = False
                for line in text.split("\n"):
                    tokens = line.split()
                    if not tokens:
                        continue
                    ends = tokens[-1][-1] in END_MARKS and len(tokens[-1]) > 1
                    raw.update(tokens[broken : len(tokens) - ends])
                    broken = ends
            counts: Counter = Counter()
            for token, n in raw.items():  # each token once a batch
                counts[_bare(token)] += n
            counts.pop("", None)
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])

    texts = pages.where("text IS NOT NULL").groupBy("doc_id", "page_number").agg(F.max("text").alias("text")).select("text")
    return materialise(texts.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")))


_EVENT = "doc_id long, page_number int, line_no int, what string, a string, page2 int, line2 int, b string"


class _Kinds(dict):
    """What a token is apart from its place: 0 fine, 1 marked, 2 a stray mark if it doesn't begin the line; else the rare word it holds, after a # where it looks like a number with letters in it."""

    def __init__(self, known: set[str]) -> None:
        super().__init__()
        self.known = known

    def __missing__(self, t: str) -> int | str:
        w = _bare(t)
        if UNREADABLE in t or _INSIDE.search(t):
            kind: int | str = 1
        elif _STRAY.fullmatch(t) and t not in "|=+<>#&@§*_•":
            kind = 2
        elif _NUMBERISH.fullmatch(t.strip(EDGE)) and w not in self.known:
            kind = "#" + w
        else:
            kind = w if len(w) > 2 and w not in self.known and any(map(str.isalpha, w)) else 0
        if len(self) > 500_000:
            self.clear()
        self[t] = kind
        return kind


def _events(frequent):
    """Per page: marks ('mark'), numbers with letters in them ('number'), rare words ('word', or 'word0' where the page begins with it), words broken at line ends with what follows ('pair'), or with what follows on another page ('last'), and how the page begins ('first')."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds_of = _Kinds(frequent.value)
        for batch in batches:
            out: list[tuple] = []
            for doc, page, text, gone in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "page_number", "text", "gone")), strict=True):
                skip = set(gone or ())
                lines = [(i, s.split()) for i, s in enumerate(text.split("\n"), 1) if i not in skip and s.strip()]
                carried = False
                for k, (no, tokens) in enumerate(lines):
                    if k == 0:
                        out.append((doc, page, no, "first", None, page, no, tokens[0]))
                    last = tokens[-1]
                    ends = last[-1] in END_MARKS and len(last) > 1 and last[-2].isalnum() or (len(last) > 1 and last[-1] in END_MARKS and last[-2] in UNREADABLE)
                    if ends:
                        if k + 1 < len(lines):
                            out.append((doc, page, no, "pair", last[:-1], page, lines[k + 1][0], lines[k + 1][1][0]))
                        else:
                            out.append((doc, page, no, "last", last[:-1], None, None, None))
                    marked = False
                    for at, w in enumerate(map(kinds_of.__getitem__, tokens)):
                        if not w:
                            continue
                        if w == 2:
                            marked |= at > 0
                        elif w == 1:
                            marked = True
                        elif (carried and at == 0) or (ends and at == len(tokens) - 1):
                            continue
                        elif w[0] == "#":
                            out.append((doc, page, no, "number", w[1:], None, None, None))
                        else:
                            out.append((doc, page, no, "word" if k or at else "word0", w, None, None, None))
                            if tokens[at].endswith("!"):  # the last letter, perhaps
                                out.append((doc, page, no, "word" if k or at else "word0", w + "!", None, None, None))
                    if marked:
                        out.append((doc, page, no, "mark", None, None, None, None))
                    carried = ends
            kinds = (pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.string(), pa.int32(), pa.int32(), pa.string())
            cols = list(zip(*out, strict=True)) if out else [()] * 8
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(cols, kinds, strict=True)], ["doc_id", "page_number", "line_no", "what", "a", "page2", "line2", "b"])

    return run


def _across_pages(events: DataFrame) -> DataFrame:
    """'last' events completed by how the document's next page with running text begins.

    Both lie sorted by document and page in range partitions; each partition's first row is handed to the one before, so a long document is no one task's.
    """
    spark = events.sparkSession
    few = events.where("what IN ('first', 'last')")

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([part] * b.num_rows, pa.int32())], [*b.schema.names, "part"])

    ranged = few.repartitionByRange(shuffle_partitions(spark), "doc_id", "page_number").sortWithinPartitions("doc_id", "page_number", "what")
    laid = materialise(ranged.mapInArrow(number, f"{_EVENT}, part int"))
    heads = laid.where("what = 'first'").groupBy("part").agg(F.min_by(F.struct("doc_id", "page_number", "line_no", "b"), F.struct("doc_id", "page_number")).alias("h")).collect()
    after = {r["part"]: (r["h"]["doc_id"], r["h"]["page_number"], r["h"]["line_no"], r["h"]["b"]) for r in heads}  # one row a partition
    shared = spark.sparkContext.broadcast(after)

    def lead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        after, out = shared.value, []
        waiting = None  # the last line of a page that ends in a broken word
        part = -1
        names = [f.split()[0] for f in _EVENT.split(", ")]
        for b in batches:
            for r in b.to_pylist():
                part = r["part"]
                if r["what"] == "last":
                    waiting = r
                elif waiting:
                    if r["doc_id"] == waiting["doc_id"] and r["page_number"] > waiting["page_number"]:
                        out.append(waiting | {"what": "pair", "page2": r["page_number"], "line2": r["line_no"], "b": r["b"]})
                        waiting = None
                    elif r["doc_id"] != waiting["doc_id"]:
                        waiting = None
        if waiting:
            for p in sorted(p for p in after if p > part)[:1]:
                doc, page, line, b = after[p]
                if doc == waiting["doc_id"]:
                    out.append(waiting | {"what": "pair", "page2": page, "line2": line, "b": b})
        schema = pa.schema([("doc_id", pa.int64()), ("page_number", pa.int32()), ("line_no", pa.int32()), ("what", pa.string()), ("a", pa.string()), ("page2", pa.int32()), ("line2", pa.int32()), ("b", pa.string())])
        yield pa.RecordBatch.from_pylist([{k: r[k] for k in names} for r in out], schema)

    n = shuffle_partitions(spark)
    back = laid.repartition(n, "part").sortWithinPartitions("part", "doc_id", "page_number", "what")
    return back.groupBy("part").applyInArrow(lambda t: pa.Table.from_batches(list(lead(iter(t.sort_by([("doc_id", "ascending"), ("page_number", "ascending"), ("what", "ascending")]).to_batches())))), _EVENT)


def _corrections(words: DataFrame, vocab: DataFrame) -> DataFrame:
    """(word, printed, at): words that are misread more frequent ones, the likeliest printed word, and where they differ."""
    rare = words.distinct().join(vocab, "word", "left").select("word", F.coalesce("n", F.lit(0)).alias("n"))
    rare, known = _with_strokes(rare), _with_strokes(vocab.where("n > 2"))
    met = rare.join(known.withColumnsRenamed({"word": "printed", "n": "m"}), "strokes").where(f"printed <> word AND m >= n * IF(n <= {FEW}, {TIMES_AS_FREQUENT[0]}, {TIMES_AS_FREQUENT[1]})").select("word", "printed", "m")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [misreading(w, p) for w, p in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)]
            keep = [i for i, g in enumerate(got) if g]
            yield pa.RecordBatch.from_arrays([*b.take(pa.array(keep, pa.int64())).columns, pa.array([got[i] for i in keep], pa.list_(pa.int32()))], ["word", "printed", "m", "at"])

    met = met.mapInArrow(run, "word string, printed string, m long, at array<int>")
    return met.groupBy("word").agg(F.max_by(F.struct("printed", "at"), F.struct("m", "printed")).alias("s")).select("word", "s.printed", "s.at")


def _with_strokes(df: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([strokes(w) for w in b.column(0).to_pylist()], pa.string())], ["word", "n", "strokes"])

    return df.select("word", "n").mapInArrow(run, "word string, n long, strokes string")


def _hyphens(pairs: DataFrame, vocab: DataFrame) -> DataFrame:
    """Adds `solid` to pairs (a, b) with the bare word they make: whether it is written in one. True if the vocabulary has it so more often than with a hyphen, or has neither and the rest begins small."""
    left, right = F.ltrim(F.lower("a"), F.lit(EDGE)), F.rtrim(F.lower("b"), F.lit(EDGE + "-"))
    p = pairs.withColumns({"solid_word": F.concat(left, right), "hyphened": F.concat(left, F.lit("-"), right), "rest": right})
    keys = p.select(F.explode(F.array("solid_word", "hyphened")).alias("word")).distinct().join(vocab, "word")
    keys = materialise(keys)
    p = p.join(keys.select(F.col("word").alias("solid_word"), F.col("n").alias("n1")), "solid_word", "left").join(keys.select(F.col("word").alias("hyphened"), F.col("n").alias("n2")), "hyphened", "left")
    n1, n2 = F.coalesce("n1", F.lit(0)), F.coalesce("n2", F.lit(0))
    begins_small = F.col("b").rlike(r"^[\p{Ll}!1|0589\x{fffd}]")
    return p.withColumn("solid", F.when((n1 > 0) | (n2 > 0), n1 > n2).otherwise(begins_small)).withColumn("seen", n1 > 0)


def read_noise(page_results: DataFrame) -> dict[str, DataFrame]:
    """All that is found on pages read by OCR: `pages`, `furniture`, `hyphens` (with the joined word), `words` (with what was printed), `fixed` (those and broken words), `marks`.

    Null pages, numbers and texts are no lines; blank pages have none. Repeated rows count once. Other columns are ignored. Empty tables give empty results.
    """
    spark = page_results.sparkSession
    pages = scanned_pages(page_results)
    gone = furniture(pages)
    vocab = vocabulary(page_results)
    misread = materialise(_corrections(vocab.select("word"), vocab))
    common = materialise(vocab.where("n > 20").join(misread, "word", "left_anti"))
    frequent = spark.sparkContext.broadcast({r["word"] for r in common.orderBy(F.desc("n"), "word").limit(FREQUENT_WORDS).select("word").collect()})
    by_page = gone.groupBy("doc_id", "page_number").agg(F.collect_set("line_no").alias("gone"))  # at most four lines a page
    events = materialise(pages.join(by_page, ["doc_id", "page_number"], "left").select("doc_id", "page_number", "text", "gone").mapInArrow(_events(frequent), _EVENT))
    pairs = events.where("what = 'pair'").unionByName(_across_pages(events))
    hyphens = materialise(_hyphens(pairs, vocab))
    inner = events.where("what = 'word'").select("doc_id", "page_number", "line_no", F.col("a").alias("word"))
    begun = hyphens.where("page2 > page_number").select("doc_id", F.col("page2").alias("page_number"), F.col("line2").alias("line_no"))
    head = events.where("what = 'word0'").select("doc_id", "page_number", "line_no", F.col("a").alias("word")).join(begun, ["doc_id", "page_number", "line_no"], "left_anti")
    words = materialise(inner.unionByName(head))
    joined = hyphens.where("solid AND NOT seen").select(F.col("solid_word").alias("word"))
    unseen = words.select("word").unionByName(joined).distinct().join(vocab, "word", "left_anti")
    fixes = materialise(misread.unionByName(_corrections(unseen, vocab)))
    words = words.join(fixes, "word")
    broken = hyphens.where("solid AND NOT seen").join(fixes, F.col("solid_word") == fixes["word"])
    cut = F.length(F.ltrim(F.lower("a"), F.lit(EDGE)))
    first = broken.where(F.exists("at", lambda x: x < cut)).select("doc_id", "page_number", "line_no")
    second = broken.where(F.exists("at", lambda x: x >= cut)).select("doc_id", F.col("page2").alias("page_number"), F.col("line2").alias("line_no"))
    fixed = words.unionByName(broken.select("doc_id", "page_number", "line_no", fixes["word"], "printed", "at"))
    odd = events.where("what = 'number'").select("doc_id", "page_number", "line_no", F.col("a").alias("word")).join(common, "word", "left_anti").drop("word")
    return {"pages": pages, "furniture": gone, "hyphens": hyphens.where("solid"), "words": words, "fixed": fixed, "marks": events.where("what = 'mark'").select("doc_id", "page_number", "line_no").unionByName(odd).unionByName(first).unionByName(second)}


def noisy_lines(page_results: DataFrame) -> DataFrame:
    """(doc_id, page_number, line_no, kind) with kinds header, page_no, hyphen and ocr, each line and kind once."""
    got = read_noise(page_results)
    hyphen = got["hyphens"].select("doc_id", "page_number", "line_no", F.lit("hyphen").alias("kind"))
    ocr = got["marks"].unionByName(got["words"].select("doc_id", "page_number", "line_no")).distinct().withColumn("kind", F.lit("ocr"))
    return got["furniture"].unionByName(hyphen).unionByName(ocr).distinct()


_ITEM = re.compile(r"\s*(?:[-–•▪*]|\(?\d{1,3}[.)]|\(?[a-z][.)]|\d+(?:\.\d+)+)\s")


def _mended(token: str, fixes: dict[str, str]) -> str:
    """A token with the printed word in place of the read one; punctuation around it and a large first letter stay."""
    w = _bare(token)
    shown = fixes.get(w + "!") if token.endswith("!") else None
    w, shown = (w + "!", shown) if shown else (w, fixes.get(w))
    at = token.lower().find(w) if shown else -1
    if at < 0:
        return token
    old = token[at : at + len(w)]
    new = shown.upper() if old.isupper() and len(old) > 1 else shown[:1].upper() + shown[1:] if old[:1].isupper() else shown
    return token[:at] + new + token[at + len(w) :]


#: A page's last line of at least this share of its longest line is no heading: without an end of sentence it goes on overleaf, whatever the next letter.
FULL_LINE = 0.7


class Paragraphs:
    """Paragraphs put together from the lines of one page after another."""

    def __init__(self) -> None:
        self.out: list[str] = []
        self.full = self.closed = False

    def add_page(self, text: str, gone: set[int], hyphens: dict[int, str], headless: set[int], fixes: dict[str, str]) -> None:
        out, lines = self.out, text.split("\n")
        width = max((len(s.strip()) for i, s in enumerate(lines, 1) if i not in gone), default=0)
        fresh, skip_first, overleaf, moved = True, False, bool(out), False
        for no, line in enumerate(lines, 1):
            if no in gone:
                continue
            tokens = line.split()
            if not tokens:
                fresh = True
                continue
            item = bool(_ITEM.match(line))
            tokens = tokens[1:] if skip_first or no in headless else tokens
            moved |= overleaf and no in headless
            skip_first = no in hyphens
            if skip_first and tokens:
                tokens[-1] = hyphens[no]
            tokens = [t for k, t in enumerate(tokens) if not (k and _STRAY.fullmatch(t) and t not in "|=+<>#&@§*_•")]
            said = " ".join(_mended(_INSIDE.sub("", t), fixes) for t in tokens)
            if not said:
                continue
            unended = out and out[-1][-1] not in ".!?:"
            goes_on = out and not self.closed and (moved or not item and (not fresh or (unended and (said[0].islower() or (overleaf and self.full)))))
            if goes_on:
                out[-1] += " " + said
            else:
                out.append(("" if fresh or not out else "\n") + said)
            fresh = overleaf = moved = self.closed = False
            self.full = len(line.strip()) >= FULL_LINE * width

    def keep(self, raw: str) -> None:
        """Text that is no scanned page's stays as it is; no paragraph runs into it or out of it."""
        self.out.append(raw.strip("\n"))
        self.closed = True

    def text(self) -> str:
        return "".join(p if p.startswith("\n") or not k else "\n\n" + p for k, p in enumerate(self.out))


def repair_text(text: str, gone: set[int], hyphens: dict[int, str], headless: set[int], fixes: dict[str, str]) -> str:
    """A page's text in paragraphs: lines in `gone` left out, `hyphens` (line -> the word that its end and the next line make) put together, the first
    word of the lines in `headless` dropped as it has moved up, misread words of `fixes` and stray marks mended. A blank line ends a paragraph unless the next begins
    small and the last hasn't ended its sentence; list items and headings keep lines of their own."""
    got = Paragraphs()
    got.add_page(text, gone, hyphens, headless, fixes)
    return got.text()


def _place(content: str, text: str, at: int) -> tuple[int, int] | None:
    """Where a page's text stands in its document's content from `at` on, between empty lines; else on lines of its own with white space changed."""
    i = content.find(text, at)
    while i >= 0:
        j = i + len(text)
        if (not content[at:i].strip() or content[:i].endswith("\n\n")) and (j == len(content) or content.startswith("\n\n", j)):
            return i, j
        i = content.find(text, i + 1)
    m = re.compile(r"^[^\S\n]*" + r"\s+".join(map(re.escape, text.split())) + r"[^\S\n]*$", re.M).search(content, at)
    return m.span() if m else None


def repair_document(content: str, pages: list[tuple[str, set[int], dict[int, str], set[int], dict[str, str]]]) -> str:
    """A document's content with its scanned pages, in order and each given as `repair_text` takes it, in paragraphs that run over the ends of pages."""
    got, at = Paragraphs(), 0
    for page in pages:
        if page[0].strip() and (place := _place(content, page[0], at)):
            if content[at : place[0]].strip():
                got.keep(content[at : place[0]])
            got.add_page(*page)
            at = place[1]
    if content[at:].strip():
        got.keep(content[at:])
    return got.text()


_REPAIR = ("text", "gone", "ends", "heads", "fixed")


def _to_repair(got: dict[str, DataFrame]) -> DataFrame:
    """Each scanned page of a `read_noise` result with all that its repair needs."""
    page = ["doc_id", "page_number"]
    gone = got["furniture"].groupBy(*page).agg(F.collect_set("line_no").alias("gone"))
    ends = got["hyphens"].groupBy(*page).agg(F.collect_list(F.struct("line_no", F.concat("a", "b").alias("word"))).alias("ends"))
    heads = got["hyphens"].where("page2 <> page_number").select("doc_id", F.col("page2").alias("page_number"), "line2").groupBy(*page).agg(F.collect_set("line2").alias("heads"))
    fixed = got["fixed"].groupBy(*page).agg(F.collect_set(F.struct("word", "printed")).alias("fixed"))
    j = got["pages"].select(*page, "text")
    for side in (gone, ends, heads, fixed):  # each has at most a few rows a line of a page
        j = j.join(side, page, "left")
    return j


def _repair_of(text: str, gone: list | None, ends: list | None, heads: list | None, fixed: list | None) -> tuple[str, set[int], dict[int, str], set[int], dict[str, str]]:
    return text, set(gone or ()), {e["line_no"]: e["word"] for e in ends or ()}, set(heads or ()), {f["word"]: f["printed"] for f in fixed or ()}


def _paged(to_repair: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [repair_text(*_repair_of(*r)) for r in zip(*(b.column(c).to_pylist() for c in _REPAIR), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("page_number"), pa.array(texts, pa.string())], ["doc_id", "page_number", "text"])

    return to_repair.mapInArrow(run, "doc_id long, page_number int, text string").where("text <> ''")


def _whole(to_repair: DataFrame, documents: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = zip(b.column("content").to_pylist(), b.column("pages").to_pylist(), strict=True)
            texts = [repair_document(c, [_repair_of(*(p[k] for k in _REPAIR)) for p in pages]) for c, pages in rows]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    # a document's pages together are no longer than its content, which is one row already
    pages = to_repair.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("page_number", *_REPAIR))).alias("pages"))
    docs = documents.where("id IS NOT NULL AND content IS NOT NULL").groupBy(F.col("id").alias("doc_id")).agg(F.max("content").alias("content"))
    return docs.join(pages, "doc_id").mapInArrow(run, "doc_id long, text string").where("text <> ''")


def repaired_pages(page_results: DataFrame) -> DataFrame:
    """(doc_id, page_number, text): the text of each page read by OCR as continuous paragraphs.

    A word that goes on over the page's end stands whole on the page where it begins. Characters that can't be read at all stay marked as such. Pages without text give no row.
    """
    return _paged(_to_repair(read_noise(page_results)))


def repaired_documents(page_results: DataFrame, documents: DataFrame) -> DataFrame:
    """(doc_id, text): the content of each of `documents` (id, content) that has pages read by OCR, as continuous paragraphs that run over the ends of pages.

    What in a content is no scanned page's text (a metadata header, pages with a text layer) stays as it is, apart from empty lines around it.
    Null contents and documents without scanned pages give no row; repeated rows count once.
    """
    return _whole(_to_repair(read_noise(page_results)), documents)


def repaired(page_results: DataFrame, documents: DataFrame) -> DataFrame:
    """(source_table, doc_id, page_number, text): `repaired_pages` as page_results and, without a page number, `repaired_documents` as pdf_documents; the noise is looked for once."""
    to_repair = materialise(_to_repair(read_noise(page_results)))
    pages = _paged(to_repair).select(F.lit("page_results").alias("source_table"), "doc_id", "page_number", "text")
    return pages.unionByName(_whole(to_repair, documents).select(F.lit("pdf_documents").alias("source_table"), "doc_id", F.lit(None).cast("int").alias("page_number"), "text"))
