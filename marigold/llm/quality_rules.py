"""Quality rules that clean lines first and judge the document by what is left.

Every line is judged by itself (sentence marks, navigation, boilerplate, shouting). Failing lines go, and a
document that loses too much of its text goes as a whole, as does one that fails the base counts. All of it is
one projection over the scan, no shuffle and no Python, but for texts of millions of characters: their words become rows,
and windows that occur twice are found by grouping.

Defined cases: a null text has no words and fails as too short; an empty text likewise; lines without a word
are neither judged nor counted, and are kept; rows are judged one by one, so repeated rows get equal results;
an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from marigold.llm.text import SPACE, column, fresh, has_word, let, words
from marigold.staging import stage

SYMBOLS = r"[#*$%&|<>]"
SEPARATORS = "[|>»•·]"
# Fixed phrases of page furniture and licence notes.
BOILERPLATE = (
    r"(?i)\b(licen[sc]ed under|all rights reserved|copyright \(?c\)?|cookie policy|privacy policy|"
    r"terms of (use|service)|powered by|click here|read more|sign (in|up)|log in|subscribe|"
    r"share (this|on)|enable javascript|lorem ipsum)\b"
)
SENTENCE_MARK = r"[.!?…。！？]"
MIN_WORDS = 50
MAX_REPEAT_PCT = 50
MAX_SYMBOL_SHARE = 0.04
MIN_SEPARATORS = 3
MAX_LOST = 0.5
# Above so many characters, a text's words are rows and not an array.
LONG_CHARS = 2_000_000


def line_fails(line: Column) -> Column:
    """True where a line is navigation, symbols, shouting, boilerplate, or has no sentence mark at all.

    Each counting test stands behind a search that fails at once in ordinary prose.
    """
    size = F.length(line)
    return (
        ~line.rlike(SENTENCE_MARK)
        | (~line.rlike(r"\p{Ll}") & line.rlike(r"\p{Lu}.*\p{Lu}.*\p{Lu}"))
        | (line.rlike(SYMBOLS) & (F.regexp_count(line, F.lit(SYMBOLS)) > MAX_SYMBOL_SHARE * size))
        | (line.rlike(SEPARATORS) & (F.regexp_count(line, F.lit(SEPARATORS)) >= F.greatest(F.lit(MIN_SEPARATORS), size / 40)))
        | line.rlike(BOILERPLATE)
    )


def repeated_words(tokens: Column) -> Column:
    """How many words lie in a window of three words that the text has twice or more.

    Each window becomes a struct: two hashes of 64 bits, and its place. Sorting these brings equal windows together,
    however many there are.
    """

    def at(w: Column, i: Column) -> Column:
        return F.get(w, i.cast("int"))

    def same(a: Column, b: Column) -> Column:
        return (a["h"] == b["h"]) & (a["g"] == b["g"])

    def window(w: Column, i: Column) -> Column:
        x, y, z = at(w, i), at(w, i + 1), at(w, i + 2)
        return F.struct(F.xxhash64(x, y, z).alias("h"), F.xxhash64(F.lit(1), x, y, z).alias("g"), i.alias("i"))

    def keyed(w: Column) -> Column:
        return F.sort_array(F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: window(w, i)))

    def covered(keys: Column) -> Column:
        twins = F.filter(keys, lambda k, i: same(k, F.get(keys, i + 1)) | same(k, F.get(keys, i - 1)))
        places = F.transform(twins, lambda k: k["i"])
        return F.size(F.array_distinct(F.flatten(F.transform(places, lambda p: F.array(p, p + 1, p + 2)))))

    return F.when(F.size(tokens) < 4, F.lit(0)).otherwise(let(keyed(tokens), covered)).cast("long")


def _facts(body: Column, lines: Column, n_words: Column, word_chars: Column, n_repeat_words: Column) -> Column:
    spoken = F.filter(lines, has_word)
    return F.struct(
        n_words.cast("long").alias("n_words"),
        word_chars.cast("long").alias("word_chars"),
        F.regexp_count(body, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size(spoken) - F.size(F.array_distinct(spoken))).cast("long").alias("n_dup_lines"),
        n_repeat_words.alias("n_repeat_words"),
        F.concat_ws("\n", F.filter(lines, lambda line: ~has_word(line) | ~line_fails(line))).alias("clean_text"),
    )


def _verdict(fact: Column) -> Column:
    left = F.length(F.regexp_replace(fact["clean_text"], SPACE, "")).cast("long")
    failed = (fact["n_words"] < MIN_WORDS) | (100 * fact["n_repeat_words"] > MAX_REPEAT_PCT * fact["n_words"])
    base = [fact[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    kept = ~failed & (left >= (1 - MAX_LOST) * fact["word_chars"])
    return F.struct(*base, failed.alias("base_failed"), kept.alias("kept"), left.alias("clean_chars"), fact["clean_text"].alias("clean_text"))


def _word_counts(texts: DataFrame) -> DataFrame:
    """``t1, t2, n_words, n_repeat_words`` of very long texts: each word a row, so that no task holds a text's windows at once."""
    of_text = ["t1", "t2"]
    lines = texts.groupBy(*of_text).agg(F.first("body").alias("body")).select(*of_text, F.posexplode(F.split("body", "\n", -1)).alias("line", "own"))
    spoken = lines.select(*of_text, "line", F.posexplode(words(F.col("own"))).alias("place", "word"))
    spoken = spoken.select(*of_text, "line", "place", F.xxhash64("word").alias("a"), F.xxhash64(F.lit(1), "word").alias("b"))
    order = Window.partitionBy(*of_text).orderBy("line", "place")
    run = [F.lead(c, i).over(order).alias(f"{c}{i}") for c in "ab" for i in (1, 2)]
    placed = spoken.select(*of_text, F.row_number().over(order).alias("i"), "a", "b", *run)
    windows = placed.filter("a2 is not null").select(*of_text, "i", F.xxhash64("a", "a1", "a2").alias("h"), F.xxhash64("b", "b1", "b2").alias("g"))
    twice = windows.groupBy(*of_text, "h", "g").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    places = windows.join(twice, [*of_text, "h", "g"], "left_semi").select(*of_text, F.explode(F.array("i", F.col("i") + 1, F.col("i") + 2)).alias("i"))
    covered = places.distinct().groupBy(*of_text).agg(F.count(F.lit(1)).alias("n_repeat_words"))
    counts = placed.groupBy(*of_text).agg(F.count(F.lit(1)).alias("n_words"))
    return counts.join(covered, of_text, "left").select(*of_text, "n_words", F.coalesce("n_repeat_words", F.lit(0)).cast("long").alias("n_repeat_words"))


def measure(df: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), long_chars: int = LONG_CHARS) -> DataFrame:
    """The base counts, the verdict and the cleaned text of each row, after the columns named in ``keep``.

    Texts of more than ``long_chars`` characters have their words counted row by row; the results are the same.
    """
    body = F.coalesce(column(df, text), F.lit(""))
    is_long = F.length(body) > long_chars

    def in_place(b: Column) -> Column:
        def facts(lines: Column, tokens: Column) -> Column:
            return let(_facts(b, lines, F.size(tokens), F.length(F.array_join(tokens, "")), repeated_words(tokens)), _verdict)

        return let(F.split(b, "\n", -1), lambda lines: let(words(b), lambda tokens: facts(lines, tokens)))

    # A generator is evaluated once a row; a plain struct would be once for each field taken from it.
    kept = [column(df, c) for c in keep]
    short = df.filter(~is_long).select(*kept, F.inline(F.array(let(body, in_place))))

    rows = F.struct(*[c.alias(f"k{i}") for i, c in enumerate(kept)]).alias("row")
    long = stage(df.filter(is_long).select(rows, body.alias("body"), F.xxhash64(body).alias("t1"), F.xxhash64(F.lit(1), body).alias("t2")), "long-texts")
    counted = long.join(_word_counts(long.select("t1", "t2", "body")), ["t1", "t2"], "left")
    none = F.lit(0).cast("long")
    facts = let(
        F.split("body", "\n", -1),
        lambda lines: _facts(
            F.col("body"), lines, F.coalesce("n_words", none), F.length(F.regexp_replace("body", SPACE, "")), F.coalesce("n_repeat_words", none)
        ),
    )
    judged = counted.select("row", F.inline(F.array(let(facts, _verdict))))
    return short.union(judged.select("row.*", *judged.columns[1:]))


def clean(df: DataFrame, text: str = "text") -> DataFrame:
    """The documents that pass, with their text cleaned line by line; all columns as they were."""
    (key,) = fresh(df, "verdict")
    packed = df.select(F.struct(*[column(df, c) for c in df.columns]).alias(key), column(df, text).alias("__body"))
    judged = measure(packed, "__body", (key,)).filter("kept")
    return judged.select(*[(F.col("clean_text") if c == text else F.col(key).getField(c)).alias(c) for c in df.columns])
