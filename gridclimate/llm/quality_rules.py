"""Quality rules with a hashed n-gram log-likelihood ratio (operator 5, native).

Method: a word is reduced to its form, the last `ENDING` characters and its length, and two words in a
row to their last characters and lengths. There are only so many forms and pairs in a language, however much
text there is, so a fixed number of cells that they are hashed to holds the same kinds of
words at every size and counts only grow. Two multinomials are counted over whole tables, one over all
documents (raw) and one over the trusted ones (target). A word says
log(target / raw), raw counts scaled to the size of the target and one added to both; the occurrence
that is scored is left out of the counts, so that trusted documents have no start. The score of a document is
the mean over its words and pairs, kept in whole steps of 2^-20, so no order of rows changes a sum.
It is kept if it passes the base rules and its score is not below the `LEFT_OUT` quantile of the trusted documents
that pass them: the exact rank among scores rounded to `STEPS` steps a unit.

Words are exploded and counted in generated code; a task hands on one row a cell at most.
There is one plan at every size, and the table of cells that is broadcast has `2 * CELLS` rows.

Defined cases: a null text has no words and fails the base rules; a document
without words scores 0; without trusted documents all scores are 0 and the base rules
alone decide; words that occur once say nothing (0); rows with the same id are each judged by their own text, and repeated rows alike;
a null id is trusted by nobody; an empty table gives no rows; a long text is read whole; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridclimate.llm.common import small_side, stored
from gridclimate.llm.native import grams, let, split_words

BLANKS = r"\x20\x09-\x0D"
SYMBOLS = "[#*$%&|<>]"
#: Cells of single words, and as many of pairs.
CELLS = 1 << 16
#: Characters of a form, and lengths told apart in forms and in pairs.
ENDING, LENGTHS, PAIR_LENGTHS = 2, 6, 4
#: Share of the trusted documents below the smallest score that is kept.
LEFT_OUT = 0.02
#: Steps of a unit that sums are kept in, and that scores are ranked by.
FINE, STEPS = 1 << 20, 1000
SMALL_ROWS = 2_000_000
REPEAT = 5


def _marked(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """doc_id, text (null: empty), `t`: whether `trusted` names the id, and a key that equal rows share."""
    ids = stored(trusted.select(F.col("doc_id").alias("trusted_id")).where("trusted_id is not null").distinct(), "trusted")
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return rows.join(small_side(ids, SMALL_ROWS), F.col("doc_id") == F.col("trusted_id"), "left") \
        .select("doc_id", "text", F.col("trusted_id").isNotNull().alias("t"), F.xxhash64("doc_id", "text").alias("key"))


def _cells(marked: DataFrame, keep: list[str]) -> DataFrame:
    """One row per word and one per pair of words: the columns `keep` and `cell`."""
    def form(word: Column, characters: int, lengths: int) -> list[Column]:
        return [F.substring(word, -characters, characters), F.least(F.char_length(word), F.lit(lengths))]

    def cell(*parts: Column) -> Column:
        return F.pmod(F.xxhash64(*parts), F.lit(CELLS)).cast("int")

    words = marked.select(*keep, split_words(F.col("text"), BLANKS).alias("w")).withColumn("v", F.concat(F.array(F.lit("")), "w"))
    pairs = words.select(*keep, F.explode(F.arrays_zip("w", "v")).alias("p")).where("p.w is not null")
    w, v = F.col("p.w"), F.col("p.v")
    both = F.array(cell(*form(w, ENDING, LENGTHS)), cell(*form(v, 1, PAIR_LENGTHS), *form(w, 1, PAIR_LENGTHS)) + CELLS)
    return pairs.select(*keep, F.explode(both).alias("cell"))


def cell_counts(marked: DataFrame) -> DataFrame:
    """Counts of every cell that occurs, in all documents (raw) and in those with `t` (target): `2 * CELLS` rows at most."""
    return stored(_cells(marked, ["t"]).groupBy("cell").agg(F.count("*").alias("raw"), F.count_if("t").alias("target")), "cells")


def cell_gains(counts: DataFrame) -> DataFrame:
    """What an occurrence of a cell adds to the score, in whole steps: in a trusted document (`own`) and in another (`other`)."""
    raw, target = (x or 0 for x in counts.agg(F.sum("raw"), F.sum("target")).first())
    rest = F.log((F.col("raw") - 1) * F.lit(target / max(raw, 1)) + 1.0)
    known = (F.col("raw") > 1) & F.lit(target > 0)

    def steps(count: Column) -> Column:
        return F.when(known, F.round((F.log(count + 1.0) - rest) * FINE)).otherwise(0).cast("long")

    return counts.select("cell", steps(F.greatest(F.col("target") - 1, F.lit(0))).alias("own"), steps(F.col("target")).alias("other"))


def _repeated(hashes: Column) -> Column:
    """Words inside windows of `REPEAT` words whose hash comes twice or more, from the windows' hashes."""
    def spread(rows: Column) -> Column:
        last = F.size(rows) - 1
        twice = F.transform(rows, lambda x, i: F.when(
            ((i > 0) & (rows[F.greatest(i - 1, F.lit(0))]["h"] == x["h"])) | ((i < last) & (rows[F.least(i + 1, last)]["h"] == x["h"])), x["at"]))
        return let(F.sort_array(F.filter(twice, lambda x: x.isNotNull())), lambda at: F.aggregate(
            at, F.struct(F.lit(-1).alias("end"), F.lit(0).cast("long").alias("n")),
            lambda s, x: F.struct((x + REPEAT).alias("end"), (s["n"] + x + REPEAT - F.greatest(x, s["end"])).alias("n")), lambda s: s["n"]))

    rows = F.sort_array(F.transform(hashes, lambda x, i: F.struct(x.alias("h"), i.alias("at"))))
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(let(rows, spread))


def base_counts(docs: DataFrame) -> DataFrame:
    """Add the counts of the base rules and `base_failed` to documents (text, never null)."""
    out = docs.withColumn("words", split_words(F.col("text"), BLANKS)).withColumn("w", F.transform("words", lambda x: F.xxhash64(x)))
    out = out.withColumn("w", grams("w", REPEAT))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(f"[^{BLANKS}]"))
    out = out.select(
        "*", F.size("words").cast("long").alias("n_words"), F.char_length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.size(F.split("text", SYMBOLS)) - 1).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        _repeated(F.col("w")).alias("n_repeat_words"))
    return out.withColumn("base_failed", F.expr("n_words < 10 or 100 * n_repeat_words > 20 * n_words"))


def quality_rules(docs: DataFrame, trusted: DataFrame, left_out: float = LEFT_OUT) -> DataFrame:
    """Counts, score and verdict of every document (doc_id, text)."""
    marked = _marked(docs, trusted)
    gains = F.broadcast(cell_gains(cell_counts(marked)))
    gain = F.when(F.col("t"), F.col("own")).otherwise(F.col("other"))
    # equal rows add up to a multiple of one sum, whose mean is theirs
    scores = _cells(marked, ["key", "t"]).join(gains, "cell").groupBy("key").agg((F.sum(gain) / F.count("*") / FINE).alias("score"))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    base = base_counts(marked).select("key", "doc_id", "t", *counts)
    judged = stored(base.join(scores, "key", "left").drop("key").withColumn("score", F.coalesce("score", F.lit(0.0))), "scores")
    step = F.floor(F.col("score") * STEPS)
    ranks = judged.where("t and not base_failed").groupBy(step.alias("step")).agg(F.count("*").alias("n"))
    upto = F.sum("n").over(Window.orderBy("step"))  # a row per step of a score: no more than scores can differ
    whole = F.sum("n").over(Window.partitionBy())
    least = ranks.select("step", upto.alias("upto"), whole.alias("whole")).where(F.col("upto") > F.lit(left_out) * F.col("whole")).agg(F.min("step")).first()[0]
    # without trusted documents there is nothing to compare with
    passed = F.lit(True) if least is None else step >= least
    return judged.select("doc_id", *counts, (~F.col("base_failed") & passed).alias("kept"), "score")
