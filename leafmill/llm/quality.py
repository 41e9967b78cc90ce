"""Per-text quality statistics, their exact ranks by language, outlier scores, and what a text is: prose, list, table or junk."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.session import materialise, shuffle_partitions

#: The statistics, with the tail in which a text is less like prose: +1 the upper, -1 the lower.
STATS = {
    "word_count": -1, "mean_word_length": 1, "symbol_ratio": 1, "digit_ratio": 1, "punctuated_lines": -1,
    "common_words": -1, "list_share": 1, "table_share": 1, "junk_share": 1,
}
#: The group that every text belongs to besides its language's; texts of no known language are ranked in it.
ALL = "*"
MIN_LANGUAGE_SHARE = 0.1
#: A value that more than one in so many texts has is joined by broadcast, so that no task has all texts with it; there are at most so many such values of a statistic in all texts, and in the languages together.
FREQUENT = 1000
#: A score above what ranks without order give (the mean of -ln of even shares is 1), and the share of signs and digits, from which a text whose lines look like none of the kinds is junk all the same.
OUTLIER, MOSTLY_SIGNS = 1.0, 0.7

_WORD = re.compile(r"[^\W\d_]+")
_MARK = re.compile(r"(?:[-–—*•▪◦‣●■□○·>+»]|\(?(?:\d{1,3}|[A-Za-z]|[ivxIVX]{1,5})[.)]|\d{1,2}(?:\.\d{1,3}){1,5}\.?)\s+(?=\S)")
_CELLS = re.compile(r"\s*[|;\t]\s*|\s{2,}")
_SPLIT = re.compile(r"[\s|;\t/]+")
_NUMBER = re.compile(r"[(\[]?[-+−–±~<>]?\s?[€$£]?\d[\d.,'’  ]*(?:[eE]\d+)?\s?[%‰]?[)\]]?|[-–—.]|n/?a|k\.A\.|NaN", re.I)
_VOWEL = re.compile(r"[aeiouyàáâãäåæèéêëìíîïòóôõöøùúûüýÿœаеёиоуыэюяіїєαεηιουωάέήίόύώ]", re.I)
_LATIN_OR_CYRILLIC = re.compile(r"[A-Za-zÀ-ɏЀ-ӿ]")
_REPEAT = re.compile(r"(.)\1{3}")
_EDGE = "()[]{}<>\"'“”‘’«»„.,;:!?…*/-–—"


def _wordlike(token: str) -> bool:
    """Whether a token could be a word of some language: letters, inner hyphens or apostrophes, one sort of case, a vowel where the script has them."""
    t = token.strip(_EDGE)
    if not t or len(t) > 40:
        return False
    for part in re.split(r"[-‐‑'’/·­]", t):
        if not part:
            continue
        if not part.isalpha() or not (part.islower() or part.isupper() or part.istitle() or part[1:].islower() or not part.lower() != part.upper()):
            return False
        if len(part) > 2 and (_REPEAT.search(part) or (not part.isupper() or len(part) > 5) and _LATIN_OR_CYRILLIC.search(part) and not _VOWEL.search(part)):
            return False
    return True


def _stops(s: str) -> bool:
    return s.rstrip("\"'”’»)]")[-1:] in (".", "!", "?", "…")


def _leads_to_page(s: str) -> bool:
    """A line of a contents list: words, a leader of dots or the like, a page number."""
    if s[-1] not in "0123456789ivxlc":
        return False
    t = s.rstrip("0123456789ivxlc").rstrip()
    tail = t[-8:].replace(" ", "")
    return len(tail) > 2 and (tail[-3:] in ("...", "···", "___") or tail[-1] == "…") and any(map(str.isalpha, t[:40]))


@lru_cache(200_000)
def _readable_length(token: str) -> int:
    return len(token) if _wordlike(token) or (len(token) < 20 and _NUMBER.fullmatch(token)) else 0


def _readable(tokens: list[str]) -> float:
    """Share of characters in tokens that are words or numbers."""
    total = sum(map(len, tokens))
    return sum(map(_readable_length, tokens)) / total if total else 0.0


def _line_kind(s: str, low: list[str], n_common: int) -> str:
    """Of one non-blank line by itself: prose, list, table, junk, cell (one number), or short (it depends on its neighbours)."""
    n = len(low)
    flowing = n > 4 and n_common * 6 >= n
    if "|" in s or "\t" in s or "  " in s or not flowing:
        if _leads_to_page(s):
            return "list"
        if _NUMBER.fullmatch(s):
            return "cell"
        cells = [c for c in _CELLS.split(s) if c]
        if len(cells) > 2 and sum(bool(_NUMBER.fullmatch(c)) for c in cells) * 2 >= len(cells) - 1:
            return "table"
        if any(map(s.__contains__, "0123456789")):
            parts = [c for c in _SPLIT.split(s) if c]
            numbers = sum(bool(_NUMBER.fullmatch(c)) for c in parts)
            if numbers > 1 and numbers * 2 >= len(parts):
                return "table"
            if s.count(",") > 1 and sum(bool(_NUMBER.fullmatch(c.strip())) for c in s.split(",")) * 2 > s.count(","):
                return "table"
        if not flowing and (_readable(_SPLIT.split(s)) < 0.5 or (n > 5 and len(set(low)) * 5 <= n)):
            return "junk"
        if len(cells) > 2 and ("|" in s or "\t" in s) and max(len(c.split()) for c in cells) < 6:
            return "table"
    if _MARK.match(s):
        return "prose" if n >= 10 and n_common * 5 >= n and _stops(s) else "list"
    return "short" if len(s) <= 90 and not _stops(s) else "prose"


def measure(text: str, common: dict[str, str]) -> tuple[str, dict[str, float]]:
    """(language, statistics) of a text; `common` names the languages of each common word. A blank text has no language and all statistics 0."""
    stats = dict.fromkeys(STATS, 0.0)
    lines = [s for s in (raw.strip() for raw in text.split("\n")) if s]
    if not lines:
        return "", stats
    has = common.__contains__
    lows = [s.lower().split() for s in lines]
    words = _WORD.findall(text.lower())
    hits = Counter(map(common.get, words))
    hits.pop(None, None)
    votes: Counter = Counter()
    for langs, n in hits.items():
        for lang in langs.split():
            votes[lang] += n
    lang, best = max(votes.items(), key=lambda x: (x[1], x[0]), default=("", 0))
    commons = [sum(map(has, low)) for low in lows]
    kinds = [_line_kind(s, low, n) for s, low, n in zip(lines, lows, commons, strict=True)]
    _settle(lines, kinds, lows, commons)
    chars = Counter()
    for s, k in zip(lines, kinds, strict=True):
        chars[k] += len(s)
    total = sum(chars.values())
    if len(words) >= 40 and len(set(words)) * 20 < len(words) and chars["prose"]:
        chars["junk"] += chars.pop("prose")  # the same few words over and over
    visible = len("".join(text.split()))
    letters = sum(map(len, words))
    digits = sum(map(text.count, "0123456789"))
    stats |= {
        "word_count": float(len(words)),
        "mean_word_length": letters / len(words) if words else 0.0,
        "symbol_ratio": max(0, visible - letters - digits) / visible,
        "digit_ratio": digits / visible,
        "punctuated_lines": sum(s[-1] in ".!?:;,…" for s in lines) / len(lines),
        "common_words": sum(hits.values()) / len(words) if words else 0.0,
        "list_share": chars["list"] / total,
        "table_share": chars["table"] / total,
        "junk_share": chars["junk"] / total,
    }
    return lang if words and best / len(words) >= MIN_LANGUAGE_SHARE else "", stats


def _settle(lines: list[str], kinds: list[str], lows: list[list[str]], commons: list[int]) -> None:
    """Cells and their labels make a table. A run of short lines is a list if hardly a line begins small and few words are common ones;
    else it is wrapped prose. One or two short lines beside a list go with it, as its title."""
    n = len(kinds)
    for i, k in enumerate(kinds):
        if k == "short" and len(lows[i]) <= 4 and ("cell" in kinds[max(0, i - 1) : i] or "cell" in kinds[i + 1 : i + 2]):
            kinds[i] = "label"
    i = 0
    while i < n:
        if kinds[i] == "short":
            j = i
            while j < n and kinds[j] == "short":
                j += 1
            words = sum(len(lows[x]) for x in range(i, j))
            few = sum(commons[i:j]) * 4 < words
            terse = words <= 8 * (j - i) and sum(lines[x][0].islower() for x in range(i, j)) * 8 <= j - i
            beside = [kinds[x] for x in (i - 1, j) if 0 <= x < n]
            kinds[i:j] = [("list" if few and terse and (j - i >= 3 or "list" in beside) else "prose")] * (j - i)
            i = j
        else:
            i += 1
    kinds[:] = ["table" if k in ("cell", "label") else k for k in kinds]


def kind_of(list_share: float, table_share: float, junk_share: float) -> str:
    """The exact check: what holds most of the characters that are no prose, if those are the most of all."""
    rest = 1 - list_share - table_share - junk_share
    if list_share + table_share + junk_share <= rest + 1e-9:  # halves are no more than half, however they are summed up
        return "prose"
    return max((("list", list_share), ("table", table_share), ("junk", junk_share)), key=lambda x: x[1])[0]


def _common_of(words: DataFrame) -> dict[str, str]:
    """Word -> its languages, in one string; the table is a fixed word list and its size is checked."""
    rows = words.where("word IS NOT NULL AND lang IS NOT NULL").groupBy("word").agg(F.array_join(F.sort_array(F.collect_set("lang")), " ").alias("langs")).limit(100_001).collect()
    if len(rows) > 100_000:
        raise ValueError("the list of common words has over 100,000 words")
    return {r["word"]: r["langs"] for r in rows}


def text_statistics(df: DataFrame, common_words: DataFrame, key_cols: tuple[str, ...] = ("id",), text_col: str = "content") -> DataFrame:
    """(keys, lang, statistics) of every non-null text; null texts give no row, blank ones all zeros. Repeated rows stay repeated; other columns are ignored."""
    shared = df.sparkSession.sparkContext.broadcast(_common_of(common_words))
    keys = list(key_cols)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common = shared.value
        for b in batches:
            got = [measure(t, common) for t in b.column(len(keys)).to_pylist()]
            cols = [pa.array([g[0] for g in got], pa.string()), *(pa.array([g[1][s] for g in got], pa.float64()) for s in STATS)]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(len(keys))), *cols], [*keys, "lang", *STATS])

    kinds = dict(df.dtypes)
    schema = ", ".join([*(f"`{k}` {kinds[k]}" for k in keys), "lang string", *(f"{s} double" for s in STATS)])
    return df.where(F.col(text_col).isNotNull()).select(*keys, text_col).mapInArrow(run, schema)


def empirical_ranks(stats: DataFrame) -> DataFrame:
    """(grp, stat, value, n, at_most, total): of each value of each statistic in each group, how many rows have it, how many have at most it, and how many there are; exact over all rows and values.

    Rows are counted by value before anything is sorted; the counts are range-partitioned by group, statistic and value and summed up
    within each partition, and each partition's sums are moved up by those of the partitions before it. What comes to the driver is a row for each partition and statistic of a group that it has.
    """
    spark = stats.sparkSession
    groups = F.explode(F.array_distinct(F.array(F.lit(ALL), _group()))).alias("grp")
    counted = stats.select("lang", _pairs()).groupBy("lang", "p.stat", "p.value").count().select(groups, "stat", "value", "count")
    counted = counted.groupBy("grp", "stat", "value").agg(F.sum("count").alias("n"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, so_far = TaskContext.get().partitionId(), None, 0
        for b in batches:
            cum = []
            for g, s, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(3).to_pylist(), strict=True):
                so_far = so_far + n if (g, s) == last else n
                last = (g, s)
                cum.append(so_far)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cum, pa.int64()), pa.array([part] * len(cum), pa.int32())], ["grp", "stat", "value", "n", "cum", "part"])

    ranged = counted.repartitionByRange(shuffle_partitions(spark), "grp", "stat", "value").sortWithinPartitions("grp", "stat", "value")
    ranged = materialise(ranged.mapInArrow(run, "grp string, stat int, value double, n long, cum long, part int"))
    sums = ranged.groupBy("grp", "stat", "part").agg(F.max("cum").alias("cum")).toPandas().sort_values(["grp", "stat", "part"])
    by = sums.groupby(["grp", "stat"])["cum"]
    sums["before"], sums["total"] = by.cumsum() - sums["cum"], by.transform("sum")
    offsets = spark.createDataFrame(pa.Table.from_pandas(sums[["grp", "stat", "part", "before", "total"]], preserve_index=False), "grp string, stat int, part int, before long, total long")
    return ranged.join(F.broadcast(offsets), ["grp", "stat", "part"]).select("grp", "stat", "value", "n", (F.col("cum") + F.col("before")).alias("at_most"), "total")


def _group() -> Column:
    return F.when(F.col("lang") == "", ALL).otherwise(F.col("lang"))


def _pairs() -> Column:
    """A row a statistic: p.stat, its number in STATS, and p.value."""
    return F.explode(F.array(*(F.struct(F.lit(i).alias("stat"), F.col(s).alias("value")) for i, s in enumerate(STATS)))).alias("p")


def tail_shares(stats: DataFrame, row: str) -> DataFrame:
    """(row, t0, t1, ...): of each statistic the share of the texts of the row's group that are at least as little like prose; `row` numbers the rows of `stats`, which is read several times."""
    ranks = materialise(empirical_ranks(stats))
    upper = F.col("stat").isin([i for i, tail in enumerate(STATS.values()) if tail > 0])
    share = F.when(upper, F.col("total") - F.col("at_most") + F.col("n")).otherwise(F.col("at_most")) / F.col("total")
    shares = ranks.select("grp", "stat", "value", "n", share.alias("share"))
    rare = shares.where(F.col("n") * FREQUENT <= (n_texts := stats.count())).drop("n")
    frequent = F.broadcast(shares.where(F.col("n") * FREQUENT > n_texts).drop("n"))
    own, on = stats.select(row, _group().alias("grp"), _pairs()).select(row, "grp", "p.stat", "p.value"), ["grp", "stat", "value"]
    got = own.join(frequent, on).unionByName(own.join(frequent, on, "left_anti").join(rare, on))
    return got.groupBy(row).agg(*(F.max(F.when(F.col("stat") == i, F.col("share"))).alias(f"t{i}") for i in range(len(STATS))))


def outlier_scores(stats: DataFrame) -> DataFrame:
    """Adds `score`, the mean over the statistics of -ln P(a text of the group is at least as little like prose), and `kind`. The rows of `stats` are read several times.

    The group is the text's language, or all texts where it has none. Ties count as at least as extreme. A text whose lines say list, table or junk is that whatever its
    score, so that how common lists are in a language decides nothing. Of the others the score decides: an outlier of OUTLIER or more that is hardly letters is junk.
    """
    names = stats.columns
    stats = materialise(stats.withColumn("_row", F.monotonically_increasing_id()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            score = np.zeros(b.num_rows)
            for i in range(len(STATS)):
                score -= np.log(b.column(f"t{i}").to_numpy(zero_copy_only=False)) / len(STATS)
            shares = (b.column(c).to_pylist() for c in ("list_share", "table_share", "junk_share"))
            kind = [kind_of(*x) for x in zip(*shares, strict=True)]
            signs = b.column("symbol_ratio").to_numpy(zero_copy_only=False) + b.column("digit_ratio").to_numpy(zero_copy_only=False)
            kind = ["junk" if k == "prose" and out else k for k, out in zip(kind, (score >= OUTLIER) & (signs >= MOSTLY_SIGNS), strict=True)]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), pa.array(score.round(6)), pa.array(kind, pa.string())], [*names, "score", "kind"])

    schema = ", ".join([*(f"`{c}` {t}" for c, t in stats.dtypes if c != "_row"), "score double", "kind string"])
    return stats.join(tail_shares(stats, "_row"), "_row").drop("_row").mapInArrow(run, schema)


def classify(df: DataFrame, common_words: DataFrame, key_cols: tuple[str, ...] = ("id",), text_col: str = "content") -> DataFrame:
    """(keys, lang, statistics, score, kind) of every non-null text, repeated rows once. Texts are read once and never shuffled."""
    stats = text_statistics(df, common_words, key_cols, text_col)
    stats = stats.groupBy(*key_cols).agg(F.max("lang").alias("lang"), *(F.max(s).alias(s) for s in STATS))
    return outlier_scores(stats)
