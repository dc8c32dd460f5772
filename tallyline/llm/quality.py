"""Quality rules and a likelihood-ratio score, in native expressions throughout.

Texts are cut into letter, digit and punctuation tokens; single tokens and pairs
of neighbours are hashed into buckets. Two multinomials over the buckets are
counted, one over trusted documents and one over the whole corpus; a document's
score is the mean log ratio of the two over its n-grams. Documents below a fixed
threshold, or failing the base rules, are not kept.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import NO_ID, among, maybe_in, named, texts

# What words are, the symbols counted, and the base rules' bounds.
BLANK = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
LEAST_WORDS, MOST_REPEATED_PERCENT = 50, 50

TOKEN = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]+"
BUCKETS = 1 << 20  # what every task holds is a number of 4 bytes for each
SPLITS_EACH = 4  # of the scan, for a task that counts
SMOOTHING = 1.0
THRESHOLD = -0.3  # mean log ratio below which a document is not kept


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with `value` computed once, also inside lambdas."""
    return F.transform(F.array(value), use)[0]


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, BLANK), "")


# In a 64-bit number: the lower bits hold a window's place, the upper ones those of its hash.
PLACE = (1 << 31) - 1


def window_hashes(ws: Column) -> Column:
    """A 64-bit hash for every window of three words."""

    def windows(first: Column, second: Column, third: Column) -> Column:
        return F.transform(first, lambda w, i: F.xxhash64(w, F.get(second, i), F.get(third, i)))

    n = F.greatest(F.size(ws) - 2, F.lit(0))
    return let(
        F.slice(ws, 2, n),
        lambda second: let(F.slice(ws, 3, n), lambda third: windows(F.slice(ws, 1, n), second, third)),
    )


def repeated_words(df: DataFrame, hashes: str, *keep: str) -> DataFrame:
    """`keep` and n_repeat_words: words in windows whose hash occurs twice or more in the array.

    Where hashes are not all different, a sort of numbers made of a hash's upper bits and
    the place leaves the windows that may be repeated; the whole hashes of those few decide.

    Arrays are columns where they are sorted or made distinct: in lambdas Spark does that
    by boxed values and does not compile it.
    """

    def neighbours(xs: Column, key: Callable[[Column], Column]) -> Column:
        """Elements of a sorted array with the key of the one before or after."""
        return F.filter(
            xs, lambda x, k: (key(x) == key(F.get(xs, k + 1))) | (key(x) == key(F.get(xs, k - 1)))
        )

    def pair(packed: Column) -> Column:
        return let(
            packed.bitwiseAND(F.lit(PLACE)).cast("int"),
            lambda i: F.struct(F.get(hashes, i).alias("h"), i.alias("i")),
        )

    upper = F.lit(~PLACE)
    packed = F.transform(hashes, lambda h, i: h.bitwiseAND(upper).bitwiseOR(i.cast("long")))
    some = F.size(F.array_distinct(hashes)) < F.size(hashes)
    may = neighbours(F.col("_packed"), lambda x: x.bitwiseAND(upper))
    sure = neighbours(F.col("_pairs"), lambda x: x["h"])
    covered = F.flatten(F.transform(sure, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))
    return (
        df.select(*keep, hashes, F.when(some, F.sort_array(packed)).alias("_packed"))
        .select(*keep, F.sort_array(F.transform(may, pair)).alias("_pairs"))
        .select(
            *keep,
            F.coalesce(F.size(F.array_distinct(covered)), F.lit(0)).cast("long").alias("n_repeat_words"),
        )
    )


def base_rules(docs: DataFrame, *keep: str) -> DataFrame:
    """The counts of the base rules and whether they fail."""
    text = F.col("text")
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    measured = let(
        words(text),
        lambda ws: F.struct(
            F.size(ws).cast("long").alias("n_words"),
            F.length(F.array_join(ws, "")).cast("long").alias("word_chars"),
            window_hashes(ws).alias("_hashes"),
        ),
    )
    cut = docs.select(
        *keep,
        measured.alias("m"),
        F.regexp_count(text, F.lit(f"[{SYMBOLS}]")).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
    ).select(*keep, "m.n_words", "m.word_chars", "n_symbols", "n_dup_lines", "m._hashes")
    counted = repeated_words(cut, "_hashes", *keep, "n_words", "word_chars", "n_symbols", "n_dup_lines")
    failed = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words")
    )
    return counted.withColumn("base_failed", failed)


def bucket(buckets: int, *parts: Column) -> Column:
    """The bucket of an n-gram; for a power of two without a division."""
    h = F.xxhash64(*parts)
    if buckets & (buckets - 1):
        return F.pmod(h, F.lit(buckets)).cast("int")
    return h.bitwiseAND(F.lit(buckets - 1)).cast("int")


def ngram_buckets(text: Column, buckets: int) -> Column:
    """Buckets of all tokens and all pairs of neighbouring tokens."""

    def both(tokens: Column) -> Column:
        after = F.slice(tokens, 2, F.greatest(F.size(tokens) - 1, F.lit(0)))
        single = F.transform(tokens, lambda t: bucket(buckets, t))
        # zip_with gives the last token a null neighbour: the end of the text.
        pair = F.zip_with(tokens, after, lambda a, b: bucket(buckets, a, F.lit(" "), b))
        return F.concat(single, pair)

    return let(F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0)), both)


def ngram_rows(docs: DataFrame, buckets: int, *keep: str) -> DataFrame:
    """A row for each of ngram_buckets(text), without lambdas, which Spark does not compile."""
    tokens = F.regexp_extract_all(F.lower("text"), F.lit(TOKEN), F.lit(0))
    a, b = F.col("a"), F.get("tokens", F.col("i") + 1)
    return (
        docs.select(*keep, tokens.alias("tokens"))
        # Not posexplode: Spark would cut all texts once more to leave out those without tokens.
        .select(*keep, "tokens", F.posexplode_outer("tokens").alias("i", "a"))
        .where("a IS NOT NULL")
        .select(*keep, F.explode(F.array(bucket(buckets, a), bucket(buckets, a, F.lit(" "), b))).alias("bucket"))
    )


def log_ratios(docs: DataFrame, marks: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """One row: array `ratios` of log P(bucket | trusted) - log P(bucket | corpus).

    Both are counted whole: the corpus over every row, the target over every row
    whose document is marked as good. Only texts of which two bitmaps say nothing are shuffled.
    """
    good = (
        marks.where("quality > 0 AND doc_id IS NOT NULL")
        .select(F.col("doc_id").cast("long"))
        .distinct()
    )
    # Each text is cut once. A first bitmap tells most rows that are not trusted, a second
    # one, of the ids that the first is wrong of, most that are; the rest is joined. A semi
    # join of all rows would be moved below the bitmaps, and every text shuffled.
    rows = texts(docs)
    wrong = among(rows.select("doc_id"), good).join(good, "doc_id", "left_anti").distinct()
    told = maybe_in(maybe_in(rows, good, "good"), wrong, "open")
    sure = told.where("NOT (good AND open)").select("text", F.col("good").cast("int"))
    # A task sends a counter for nearly every bucket, however much it reads.
    parts = rows.rdd.getNumPartitions()
    sure = sure.coalesce(max(parts // SPLITS_EACH, min(parts, docs.sparkSession.sparkContext.defaultParallelism), 1))
    rest = told.where("good AND open").drop("good").join(good.withColumn("good", F.lit(1)), "doc_id", "left")
    cut = sure.unionByName(rest.select("text", F.coalesce("good", F.lit(0)).alias("good")))
    grams = ngram_rows(cut, buckets, "good")
    counts = grams.groupBy("bucket").agg(F.count("*").alias("raw"), F.sum("good").alias("good"))
    every = docs.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    counts = every.join(counts, "bucket", "left").na.fill(0)
    lists = counts.agg(
        F.sum("raw").alias("raws"),
        F.sum("good").alias("goods"),
        F.sort_array(F.collect_list(F.struct("bucket", "raw", "good"))).alias("rows"),
    )
    share = lambda n, total: F.log((n + SMOOTHING) / (total + SMOOTHING * buckets))
    return lists.select(
        F.transform(
            "rows",
            lambda r: F.when(
                F.col("goods") > 0, share(r["good"], F.col("goods")) - share(r["raw"], F.col("raws"))
            ).otherwise(F.lit(0.0)).cast("float"),
        ).alias("ratios")
    )


def judge(
    docs: DataFrame, marks: DataFrame, threshold: float = THRESHOLD, buckets: int = BUCKETS
) -> DataFrame:
    """Base counts, score and verdict for every row of `docs`.

    A null or empty text has no words, fails the base rules and has score 0, as
    has every text when no document is marked as good. A null doc_id stays null;
    repeated rows return each time; columns other than doc_id and text are not
    looked at. `marks` holds doc_id and quality (1: trusted).
    """
    # The one row of ratios is computed before the scan and read by every task. Its column
    # is used once and no other is costly, so that Spark puts it into the score: as a column
    # of the rows its 4 MB were copied for each of them.
    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"),
        "text",
        log_ratios(docs, marks, buckets).scalar().alias("_ratios"),
    )
    text = F.coalesce(F.col("text"), F.lit(""))
    score = let(
        ngram_buckets(text, buckets),
        lambda grams: F.when(
            F.size(grams) > 0,
            let(
                F.col("_ratios"),
                lambda ratios: F.aggregate(grams, F.lit(0.0), lambda total, g: total + F.get(ratios, g)),
            )
            / F.size(grams),
        ).otherwise(F.lit(0.0)),
    )
    out = base_rules(rows.select("doc_id", text.alias("text"), score.alias("score")), "doc_id", "score")
    return named(
        out.withColumn("kept", ~F.col("base_failed") & (F.col("score") >= threshold))
    )
