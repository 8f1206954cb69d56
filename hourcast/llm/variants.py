"""Spelling variants: words at most one edit apart, found with a bit-sliced position index.

Words are runs of letters, lower-cased, with at least ``MIN_LETTERS`` letters and
``MIN_USES`` uses. Two words are near if one inserted, deleted or replaced letter turns
one into the other. A word's form is its near word with most uses (ties: the
smallest), if that has ``RATIO`` times the word's uses; the root is the end of the
chain of forms.

The index of a block of words holds, for every (position, letter), the set of the words
with this letter there, as the bits of an integer. A word is looked up letter by
letter in all words of the block at once: the set that matches without error and the three sets with
one error so far (replaced; the word has a letter more, compared one position back; a
letter less, one position on) are carried on by a few bitwise operations a letter.

Blocks come from cells, so that not every word meets every other. Two near words whose
shorter one has m letters agree on the first or on the last half (less the letter in
error) of them; a cell holds the words with such a part in common. A cell of more
than ``CELL`` words is dealt out again in the same way by the halves of what lies between
the parts agreed on, until at most one letter is left between, where the words of a cell can differ in
nothing else. So cells stay bounded whatever prefix or ending is common, and no near pair is lost. A
pair that meets in the left and the right half counts on the left: on the right,
words that also agree on the left are taken off, by the set without error at that position.

Null texts have no words; a null id is written as nothing. Repeated rows are documents
of their own. An empty table gives no row. Further columns of the input are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from hourcast.llm.common import batches_by, pick, prepare
from hourcast.sinks.util import materialize

MIN_LETTERS = 7
MIN_USES = 2
RATIO = 10
#: Of the runs, those whose checksum this divides lose a letter.
DAMAGE = 31
#: Words of a cell above which it is dealt out again.
CELL = 1024
#: Tasks over which the words of such a cell are spread meanwhile.
SALTS = 64
#: Words that a task counts before it hands them on.
HELD = 400_000
RUN = re.compile("[A-Za-zÀ-ÿ]+")


# ---- words ------------------------------------------------------------------------

def as_written(word: str, checksum: int, damage: int = DAMAGE) -> str:
    """``word``, or ``word`` without the letter at ``checksum`` % length if ``damage`` divides the checksum."""
    if checksum % damage:
        return word
    at = checksum % len(word)
    return word[:at] + word[at + 1:]


def word_counts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", damage: int = DAMAGE,
                min_letters: int = MIN_LETTERS, min_uses: int = MIN_USES) -> DataFrame:
    """(word, n) of the words of whole texts; counted in the tasks before they are shuffled."""
    prepare(df.sparkSession)
    d = pick(df, id=id_col, text=text_col).where("text is not null")
    d = d.select(F.coalesce(F.col("id").cast("string"), F.lit("")).alias("id"), "text")

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def hand_on() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])
            held.clear()
            return out

        for batch in it:
            texts = pc.ascii_lower(batch.column("text"))  # only A-Z
            for i, text in zip(batch.column("id").to_pylist(), texts.to_pylist(), strict=True):
                start = zlib.crc32(f"{i}:".encode())
                for word, n in Counter(RUN.findall(text)).items():
                    h = zlib.crc32(word.encode(), start)
                    if not h % damage:
                        word = as_written(word, h, damage)
                    if len(word) >= min_letters:
                        held[word] += n
                if len(held) > HELD:
                    yield hand_on()
        if held:
            yield hand_on()

    counts = d.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.where(F.col("n") >= min_uses)


# ---- cells ------------------------------------------------------------------------

def _split(cells: DataFrame) -> DataFrame:
    """Every word of a cell goes to its left and its right half.

    A cell: ``m`` letters of the shorter word of a pair, the first ``a`` and the last
    ``b`` letters agree (``part``); pairs that agree on the first ``skip`` letters
    belong elsewhere. ``path`` tells cells apart that come from different halves.
    """
    h = F.floor((F.col("m") - F.col("a") - F.col("b")) / 2).cast("int")
    left = F.struct(F.lit("l").alias("s"), (F.col("a") + h).alias("a"), F.col("b"), F.col("skip"))
    right = F.struct(F.lit("r").alias("s"), F.col("a"), (F.col("b") + h).alias("b"),
                     F.least("skip", F.col("a") + h).alias("skip"))
    out = cells.withColumn("to", F.explode(F.array(left, right)))
    out = out.select("word", "n", "size", "m", F.concat("path", "to.s").alias("path"), "to.a", "to.b", "to.skip")
    return out.withColumn("part", _part())


def _part() -> Column:
    return F.concat(F.substring("word", F.lit(1), F.col("a")), F.lit("-"),
                    F.when(F.col("b") > 0, F.substring("word", -F.col("b"), F.col("b"))).otherwise(""))


def _cells(words: DataFrame, limit: int) -> DataFrame:
    """(word, n, size, m, path, a, b, skip, part): words by cell, cells of more than ``limit`` words dealt out again."""
    start = words.withColumn("size", F.length("word")).withColumn("m", F.explode(F.array(F.col("size"), F.col("size") - 1)))
    never = F.lit((1 << 31) - 1)
    cells = start.select("word", "n", "size", "m", F.lit("").alias("path"), F.lit(0).alias("a"), F.lit(0).alias("b"), never.alias("skip"))
    cells, done, key = materialize(_split(cells), "cells"), None, ["m", "path", "part"]
    while True:
        size = cells.groupBy(*key).agg(F.count(F.lit(1)).alias("words"), F.max(F.col("m") - F.col("a") - F.col("b")).alias("between"))
        hot = materialize(size.where((F.col("words") > limit) & (F.col("between") > 1)).select(*key), "hot_cells")
        if hot.isEmpty():
            return cells if done is None else done.unionByName(cells)
        # a hot cell's words are spread over SALTS tasks
        salted = cells.withColumn("salt", F.pmod(F.hash("word"), F.lit(SALTS)))
        hot = hot.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).withColumn("again", F.lit(True))
        sized = materialize(salted.join(hot, [*key, "salt"], "left").drop("salt"), "sized_cells")
        kept = sized.where("again is null").drop("again")
        done = kept if done is None else done.unionByName(kept)
        cells = materialize(_split(sized.where("again")), "cells")


# ---- index ------------------------------------------------------------------------

class Index:
    """(position, letter) -> set of words, as bits of an integer; word i is bit i."""

    def __init__(self, words: list[str]) -> None:
        self.at: list[dict[str, int]] = [{} for _ in range(max(map(len, words), default=0) + 2)]
        self.of_size: dict[int, int] = {}
        for i, word in enumerate(words):
            bit = 1 << i
            self.of_size[len(word)] = self.of_size.get(len(word), 0) | bit
            for here, c in zip(self.at, word, strict=False):
                here[c] = here.get(c, 0) | bit
        self.all = (1 << len(words)) - 1

    def near(self, word: str, skip: int = 1 << 31) -> tuple[int, int, int]:
        """Words one edit from ``word``: with a letter replaced, with one less, with one more.

        Words that agree on the first ``skip`` letters are left out.
        """
        none, at = 0, self.at
        exact, replaced, less, more = self.all, none, none, none
        left_out = none
        end = len(at) - 1
        for i, c in enumerate(word):
            if i == skip:
                left_out = exact
            here = at[i].get(c, none) if i < end else none
            following = at[i + 1].get(c, none) if i < end else none
            before = at[i - 1].get(c, none) if 0 < i <= end else none
            more = (more | exact) & following
            less = less & before | exact
            replaced = replaced & here | exact & ~here
            exact &= here
            if not (replaced or less or more or exact):
                return none, none, none
        if len(word) == skip:
            left_out = exact
        size, keep = self.of_size, ~left_out
        return (replaced & size.get(len(word), none) & keep, less & size.get(len(word) - 1, none) & keep,
                (more | exact) & size.get(len(word) + 1, none) & keep)


def bits(x: int) -> Iterator[int]:
    while x:
        low = x & -x
        yield low.bit_length() - 1
        x ^= low


def cell_matches(words: list[str], uses: list[int], m: int, skip: int) -> Iterator[tuple[str, int, int, str]]:
    """(word, near words, uses and text of the best one) for the words of a cell that have near ones in it."""
    index = Index(words)
    for word in words:
        replaced, less, more = index.near(word, skip)
        found = replaced | more if len(word) == m else less
        if found:
            best = max(((uses[i], i) for i in bits(found)), key=lambda x: (x[0], _falling(words[x[1]])))
            yield word, found.bit_count(), best[0], words[best[1]]


def _falling(word: str) -> tuple[int, ...]:
    """Orders words from the last to the first in code-point order (none is the beginning of another of its size)."""
    return (*(-ord(c) for c in word), 1)


def matches(words: DataFrame, cell: int = CELL) -> DataFrame:
    """(word, n_near, best) for every word of ``words`` (word, n) that has near ones; ``best``: (n, word)."""
    cells = _cells(words, cell)
    key = F.concat_ws("|", "m", "path", "part")
    cells = cells.select(key.alias("cell"), "m", "skip", "word", "n")
    parts = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cells = cells.repartition(parts, "cell").sortWithinPartitions("cell", "word")

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in batches_by(it, "cell"):
            names, sizes, skips, texts, uses = (table.column(c).to_pylist() for c in ("cell", "m", "skip", "word", "n"))
            out, a = [], 0
            for b in range(1, len(names) + 1):
                if b == len(names) or names[b] != names[a]:
                    if b - a > 1:
                        out += cell_matches(texts[a:b], uses[a:b], sizes[a], skips[a])
                    a = b
            if out:
                word, near, n, best = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(near, pa.int64()), pa.array(n, pa.int64()), pa.array(best)],
                                                 names=["word", "near", "best_n", "best"])

    found = cells.mapInArrow(run, "word string, near long, best_n long, best string")
    # most uses first, then the smallest word: the largest n, the least word among those with it
    top = F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("word")))
    return found.groupBy("word").agg(F.sum("near").alias("n_near"), top.alias("top"))


def forms(words: DataFrame, ratio: int = RATIO, cell: int = CELL) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every row of ``words`` (word, n; each word once)."""
    words = materialize(words.select("word", "n"), "words")
    near = matches(words, cell)
    d = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.col("top.word").alias("best"), (-F.col("top.less")).alias("best_n"))
    fits = F.col("best_n") >= ratio * F.col("n")
    d = materialize(d.select("word", "n", "n_near", F.when(fits, F.col("best")).alias("form"), F.when(fits, F.col("best_n")).alias("form_n")), "forms")
    # uses grow along a chain, so it ends; each round doubles the steps taken
    steps = materialize(d.where("form is not null").select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = steps.select(F.col("word").alias("root"), F.col("root").alias("further"))
        both = steps.join(onward, "root", "left")
        steps = materialize(both.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        if steps.where("moved").isEmpty():
            break
        steps = steps.drop("moved")
    return d.join(steps.select("word", "root"), "word", "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
