"""Line-first cleaning: rules per line, then a verdict on what is left (DataFrame functions only).

Every non-blank line of a text is judged on its own:

* punctuation: it holds no sentence end (``.``, ``!``, ``?`` or an ellipsis, closing
  quotes allowed, before white space or the line's end; or a stop of another script
  anywhere), nor a long run of a script that has no stops (Thai, Lao);
* navigation: at least ``MIN_SEPARATORS`` menu separators, one for every
  ``WORDS_PER_SEPARATOR`` words or more;
* symbols: more than one of ``#*$%&|<>`` for every ``WORDS_PER_SYMBOL`` words;
* boilerplate: the sentences with a stock phrase of sites (cookies, rights, licences,
  sign-up) hold at least ``MAX_STOCK`` of the line. Prose that mentions one stays.

Failing lines are removed. A document is kept if it passes the base rules (20
words or more, at most 30 % of the words in repeated 8-word windows) and the
removed lines held no more than ``MAX_LOST`` of its word characters.

Null text counts as empty: no words, so it fails. Lines that differ only by white
space are different lines. Repeated rows each get their own (equal) result.
Arrays are handled within the row, so a text must fit in a task, as it does
already in the scan; nothing is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from hourcast.llm.common import let, pick

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8
MIN_SEPARATORS = 3
WORDS_PER_SEPARATOR = 4
WORDS_PER_SYMBOL = 2
MAX_STOCK = 0.5
MAX_LOST = 0.5

#: Patterns are kept to what Java and RE2 read alike, so that the SQL oracle can share them.
SPLIT = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]"
SENTENCE_END = "[.!?…][\"'»”’)\\]]*([\\x20\\x09-\\x0D]|\\z)|[。！？｡।॥؟۔։።፧။།។]|[ก-๛ກ-ໟ]{20}"
STOPS = "[.!?…。！？｡।॥؟۔։።፧။།។]"
SEPARATORS = "|»›·•>"
SYMBOLS = "#*$%&|<>"
BOILERPLATE = (
    r"(?i)(all rights reserved|licensed under|released under the|terms of (use|service)|privacy policy"
    r"|cookie (policy|settings|consent)|we use cookies|accept (all )?cookies|enable javascript"
    r"|sign up for our|subscribe to our|follow us on|share (this|on) (page|facebook|twitter)|skip to content"
    r"|tous droits r.serv.s|politique de confidentialit.|alle rechte vorbehalten"
    r"|datenschutzerkl.rung|todos los derechos reservados|pol.tica de privacidad)"
)


def _count(text: Column, chars: str) -> Column:
    """Characters of ``text`` that are in ``chars``."""
    return (F.length(text) - F.length(F.regexp_replace(text, f"[{chars}]", ""))).cast("long")


def _words(text: Column) -> Column:
    return F.array_remove(F.split(text, SPLIT), "")


def _covered(hashes: Column) -> Column:
    """Words covered by windows whose hash occurs twice or more (sorted neighbours are compared)."""
    ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def repeated(s: Column) -> Column:
        same = lambda j, k: F.get(s, j)["h"].eqNullSafe(F.get(s, k)["h"])
        at = F.transform(F.sequence(F.lit(0), F.size(s) - 1),
                         lambda k: F.when(same(k, k - 1) | same(k, k + 1), F.get(s, k)["i"]))
        return F.sort_array(F.filter(at, lambda p: p.isNotNull()))

    start = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
    step = lambda acc, p: F.struct(
        (p + WINDOW).alias("end"), (acc["n"] + p + WINDOW - F.greatest(p, acc["end"])).alias("n"))
    return F.aggregate(let(ordered, repeated), start, step, lambda acc: acc["n"])


def _doubled(hashes: Column, step: int) -> Column:
    """Hashes of 2 * ``step`` words from those of ``step`` words."""
    return let(hashes, lambda h: F.transform(
        F.slice(h, 1, F.size(h) - step), lambda x, i: F.xxhash64(x, F.get(h, i + step))))


def _repeat_words(words: Column) -> Column:
    """Words in 8-word windows found twice or more; 64-bit hashes stand for the windows."""
    def count(w: Column) -> Column:
        hashes = _doubled(_doubled(_doubled(F.transform(w, lambda x: F.xxhash64(x)), 1), 2), 4)  # WINDOW words
        return F.when(F.size(w) < WINDOW, F.lit(0).cast("long")).otherwise(
            let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long"))
                .otherwise(_covered(h))))
    return let(words, count)


def _is_stock(line: Column) -> Column:
    """Whether sentences with a stock phrase hold the given share of the line; most lines have none."""
    def share(pieces: Column) -> Column:
        size = lambda xs: F.aggregate(xs, F.lit(0), lambda n, x: n + F.length(x))
        return size(F.filter(pieces, lambda x: x.rlike(BOILERPLATE))) >= MAX_STOCK * size(pieces)
    return F.when(line.rlike(BOILERPLATE), let(F.split(line, STOPS), share)).otherwise(False)


def _line_fails(line: Column) -> Column:
    n = F.size(_words(line))
    separators, symbols = _count(line, SEPARATORS), _count(line, SYMBOLS)
    return (~line.rlike(SENTENCE_END)
            | ((separators >= MIN_SEPARATORS) & (separators * WORDS_PER_SEPARATOR >= n))
            | ((symbols > 0) & (symbols * WORDS_PER_SYMBOL > n))
            | _is_stock(line))


def cleaned(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of ``df``: the base counts, the cleaned text and the verdict.

    Columns: ``id``, those of ``carry``, ``n_words``, ``word_chars``, ``n_symbols``,
    ``n_dup_lines``, ``n_repeat_words``, ``n_lines``, ``n_removed`` (lines),
    ``lost_chars`` (word characters of removed lines), ``clean_text`` (the lines
    left, blank ones included), ``base_failed``, ``kept``.
    """
    d = pick(df, id=id_col, text=text_col, **{f"c_{c}": c for c in carry})
    d = d.withColumn("t", F.coalesce("text", F.lit("")))
    d = d.withColumns({
        "word_list": _words(F.col("t")),
        "lines": F.split("t", "\n"),
    }).withColumns({
        "n_words": F.size("word_list").cast("long"),
        "word_chars": F.length(F.array_join("word_list", "")).cast("long"),
        "n_symbols": _count(F.col("t"), SYMBOLS),
        "n_repeat_words": _repeat_words(F.col("word_list")),
        "full": F.filter("lines", lambda x: x.rlike(WORD)),
        "judged": F.transform("lines", lambda x: F.struct(
            x.alias("line"), x.rlike(WORD).alias("full"), (x.rlike(WORD) & _line_fails(x)).alias("fails"))),
    }).withColumns({
        "n_dup_lines": (F.size("full") - F.size(F.array_distinct("full"))).cast("long"),
        "n_lines": F.size("full").cast("long"),
        "bad": F.filter("judged", lambda x: x["fails"]),
        "left": F.filter("judged", lambda x: ~x["fails"]),
    }).withColumns({
        "n_removed": F.size("bad").cast("long"),
        "lost_chars": F.length(F.regexp_replace(F.concat_ws("", F.transform("bad", lambda x: x["line"])), SPLIT, "")).cast("long"),
        "clean_text": F.concat_ws("\n", F.transform("left", lambda x: x["line"])),
        "base_failed": (F.col("n_words") < MIN_WORDS)
        | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")),
    })
    kept = ~F.col("base_failed") & (F.col("lost_chars") <= MAX_LOST * F.col("word_chars"))
    return d.withColumn("kept", kept).select(
        "id", *[f"c_{c}" for c in carry], "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "n_lines", "n_removed", "lost_chars", "clean_text", "base_failed", "kept")
