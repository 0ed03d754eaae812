"""Benchmark decontamination by winnowing (operator 2, native).

Method: of every run of W = 8 consecutive k-gram hashes (k = 6 words) the
smallest is kept as a fingerprint. A run spans W + k - 1 = 13 words and its
smallest hash depends on these words alone, so a document and an item that share
13 words share a fingerprint. Fingerprints of both sides are joined; in documents
with a joint fingerprint the hits are extended to whole windows, compared word by
word. Items of fewer than 13 words have no full run: their whole hash is the
fingerprint, looked up at every place of the documents.

The fingerprints of the benchmark are sent to all tasks only after they have been
counted; beyond `SMALL_ROWS` the join shuffles. Documents appear in shuffles as
keys, and as texts only if a fingerprint has hit.

Defined cases: a null or empty text has no words and no hits; a null or empty item
never occurs; rows with one id and different texts are judged on their own; repeated rows
get equal results; a null item id marks words but is not listed; without documents there
are no rows, without items no hits; long texts are read whole; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridclimate.llm.common import small_side, stored
from gridclimate.llm.native import grams, lower_ascii, pair_least, places, split_words

#: Everything but digits, lower-case letters and non-ASCII characters.
SEPARATORS = r"\x00-\x2F\x3A-\x60\x7B-\x7F"
WINDOW, GRAM = 13, 6
#: Rows of 8 to 200 bytes sent to every task at most.
SMALL_ROWS = 500_000


def words(text: Column) -> Column:
    return split_words(lower_ascii(text), SEPARATORS)


def _fingerprints(df: DataFrame, short: list[int]) -> DataFrame:
    """Add `prints`, the winnowed hashes of `words`, and the hashes of all runs of the given short lengths."""
    out = df.withColumn("w", F.transform("words", lambda x: F.xxhash64(x))).withColumn("g", grams("w", GRAM))
    for step in (1, 2, 4):  # minima over 2, 4 and then 8 neighbours
        out = out.withColumn("g", pair_least("g", step))
    parts = [F.array_distinct("g")]
    for n in short:
        out = out.withColumn(f"s{n}", grams("w", n))
        parts.append(F.array_distinct(f"s{n}"))
    return out.withColumn("prints", F.concat(*parts)).drop("w", "g", *[f"s{n}" for n in short])


def _windows(lengths: list[int]) -> Column:
    """Start, length and text of every window of `words` of these lengths."""
    def of_length(n: int) -> Column:
        return F.transform(places(F.size("words") - (n - 1)), lambda i: F.struct(
            i.alias("start"), F.lit(n).alias("len"), F.array_join(F.slice("words", i + 1, F.lit(n)), " ").alias("window")))

    return F.concat(*map(of_length, lengths))


def benchmark_hits(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Per row of `docs` (doc_id, text): a hash of both, n_words, hit spans and ids of the items (item_id, text) that occur in it."""
    item_words = stored(items.select("item_id", words(F.col("text")).alias("words")).where(F.size("words") > 0), "items")
    short = [r[0] for r in item_words.where(F.size("words") < WINDOW).select(F.size("words")).distinct().collect()]
    full = item_words.where(F.size("words") >= WINDOW).withColumn("own", _windows([WINDOW]))
    whole = item_words.where(F.size("words") < WINDOW).withColumn("own", F.array(F.struct(
        F.lit(0).alias("start"), F.size("words").alias("len"), F.array_join("words", " ").alias("window"))))
    windows = stored(full.unionByName(whole).select("item_id", F.explode("own").alias("x")).select("item_id", "x.window").distinct(), "windows")
    wanted = _fingerprints(item_words.where(F.size("words") >= WINDOW), [])
    for n in short:
        wanted = wanted.unionByName(_fingerprints(item_words.where(F.size("words") == n), [n]))
    wanted = stored(wanted.select(F.explode("prints").alias("print")).distinct().withColumn("found", F.lit(True)), "prints")

    # every document once with a print of its own, which keeps the row, and with its fingerprints
    keyed = docs.select("doc_id", "text", F.coalesce(F.col("doc_id").cast("long"), F.lit(-2**63)).alias("did"), F.xxhash64("doc_id", "text").alias("th"))
    printed = _fingerprints(keyed.withColumn("words", words(F.col("text"))).drop("text"), short)
    rows = printed.select("doc_id", "did", "th", F.size("words").cast("long").alias("n_words"), F.explode(F.concat(
        F.transform("prints", lambda p: F.struct(p.alias("print"), F.lit(False).alias("own"))),
        F.array(F.struct(F.col("th").alias("print"), F.lit(True).alias("own"))))).alias("x")).select("doc_id", "did", "th", "n_words", "x.print", "x.own")
    met = stored(rows.join(small_side(wanted, SMALL_ROWS), "print", "left").where("own or found").select("doc_id", "did", "th", "n_words", "own"), "met")

    # hits extended to whole windows
    hit = stored(met.where("not own").select("did", "th").distinct(), "hit")
    spans = keyed.join(small_side(hit, SMALL_ROWS), ["did", "th"], "left_semi").withColumn("words", words(F.col("text"))) \
        .select("did", "th", F.explode(_windows([WINDOW, *short])).alias("x")).select("did", "th", "x.*")
    texts = stored(windows.select("window").distinct(), "texts")
    spans = stored(spans.join(small_side(texts, SMALL_ROWS), "window", "left_semi").distinct(), "spans")
    covered = spans.groupBy("did", "th").agg(F.sort_array(F.collect_set(F.struct("start", (F.col("start") + F.col("len")).alias("end")))).alias("spans"))
    listed = spans.select("did", "th", "window").join(windows, "window").select("did", "th", F.col("item_id").cast("string").alias("item")).distinct() \
        .groupBy("did", "th").agg(F.sort_array(F.collect_list("item")).alias("items"))
    found = covered.join(listed, ["did", "th"])
    none = "cast(array() as array<{}>)"
    return met.where("own").join(found, ["did", "th"], "left").select(
        "doc_id", F.col("th").alias("row_hash"), "n_words", F.coalesce("spans", F.expr(none.format("struct<start:int,end:int>"))).alias("spans"),
        F.coalesce("items", F.expr(none.format("string"))).alias("items"))


def covered_words(spans: Column) -> Column:
    """Words in the union of spans sorted by start."""
    state = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
    return F.aggregate(spans, state, lambda s, x: F.struct(
        F.greatest(s["end"], x["end"]).alias("end"),
        (s["n"] + F.greatest(F.lit(0), x["end"] - F.greatest(s["end"], x["start"]))).alias("n")), lambda s: s["n"])


def contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Per document: words, hit words, items met and the verdict (hit words are a twentieth of all or more)."""
    return benchmark_hits(docs, items).select(
        "doc_id", "row_hash", "n_words", covered_words(F.col("spans")).alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256")) \
        .withColumn("contaminated", F.expr("n_hit > 0 and 20 * n_hit >= n_words"))
