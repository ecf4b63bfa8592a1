"""Quality rules and a hashed n-gram likelihood ratio, in SQL functions alone.

Words and pairs of words are hashed into a fixed number of buckets. Two multinomials over the buckets are
counted: one over the documents labelled good, one over all documents. The score of a document is the mean
log-likelihood ratio of its n-grams, less what comes of how the labels are spread; documents under a threshold
that the labels set are rejected. The bucket counts are arrays of fixed length, read as a scalar subquery.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lealtia.llm.common import bound, sized, stored

BUCKETS = 1 << 16
#: Added to every bucket's count; with a learned threshold the same mass is dealt out as the raw shares are.
SMOOTHING = 1.0
#: How often the share of good documents lost counts against the share of bad ones rejected, and the steps of a threshold.
LOSS_WEIGHT = 10
STEPS = 1000
# Blanks between words, and the characters counted as symbols.
BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WORD_BREAK = r"[ \t-\r]+"
REPEAT_WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20


def word_list(text: Column) -> Column:
    """Words of a text; without blanks at its ends no piece of the split is empty."""
    bare = F.trim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, WORD_BREAK))


def with_words(df: DataFrame, text_column: str) -> DataFrame:
    hashed = df.withColumn("__q_words", word_list(F.col(text_column))).withColumn(
        "__q_hash", F.transform("__q_words", lambda w: F.xxhash64(w))
    )
    return hashed.withColumn("__q_pairs", pairs_hash(F.col("__q_hash")))


def neighbours_hash(left: Column, right: Column, apart: int) -> Column:
    """A hash of every element of ``left`` with the one ``apart`` places on in ``right``, beside each other in two lists: no
    element is looked up by its place. An element without one on the right is left out."""
    count = F.greatest(F.size(right) - apart, F.lit(0))
    return F.zip_with(F.slice(left, 1, count), F.slice(right, apart + 1, count), lambda a, b: F.xxhash64(a, b))


def pairs_hash(hashes: Column) -> Column:
    """A hash of every two neighbours."""
    return neighbours_hash(hashes, hashes, 1)


def covered_words(windows: Column, width: int) -> Column:
    """Words inside windows that occur twice or more: equal windows become neighbours by sorting."""

    def of_sorted(pairs: Column) -> Column:
        same = lambda k, other: F.coalesce(F.get(pairs, k)["h"] == F.get(pairs, other)["h"], F.lit(False))
        repeated = F.filter(F.sequence(F.lit(0), F.size(pairs) - 1), lambda k: same(k, k - 1) | same(k, k + 1))
        places = F.sort_array(F.transform(repeated, lambda k: F.get(pairs, k)["i"]))
        return F.aggregate(
            places,
            F.struct(F.lit(0).cast("long").alias("n"), F.lit(-width).cast("int").alias("last")),
            lambda acc, p: F.struct((acc["n"] + F.least(F.lit(width), p - acc["last"])).alias("n"), p.alias("last")),
        )["n"]

    pairs = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0).cast("long")).otherwise(
        bound(pairs, of_sorted)
    )


def base_rules(df: DataFrame, text_column: str = "text") -> DataFrame:
    """``df`` with word hashes and the base measures ``n_words`` ... ``base_failed``."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^ \t-\r]"))
    n = F.col("n_words")
    return (
        with_words(df, text_column)
        .withColumn("n_words", F.size("__q_words").cast("long"))
        .withColumn("word_chars", F.char_length(F.array_join("__q_words", "")).cast("long"))
        .withColumn("n_symbols", F.regexp_count(text, F.lit(f"[{SYMBOLS}]")).cast("long"))
        .withColumn("__q_lines", lines)
        .withColumn("n_dup_lines", (F.size("__q_lines") - F.size(F.array_distinct("__q_lines"))).cast("long"))
        .withColumn("__q_four", neighbours_hash(F.col("__q_pairs"), F.col("__q_pairs"), 2))
        .withColumn("__q_five", neighbours_hash(F.col("__q_four"), F.col("__q_hash"), REPEAT_WINDOW - 1))
        .withColumn("n_repeat_words", covered_words(F.col("__q_five"), REPEAT_WINDOW))
        .withColumn("base_failed", (n < MIN_WORDS) | (F.col("n_repeat_words") * 100 > n * MAX_REPEAT_PERCENT))
    )


def bucket_of(h: Column, buckets: int) -> Column:
    return F.pmod(h, F.lit(buckets)).cast("int")


def gram_hashes() -> Column:
    """The hash of every word and of every pair of neighbouring words."""
    return F.concat("__q_hash", "__q_pairs")


def label_marks(labels: DataFrame) -> DataFrame:
    """``__q_id`` and ``__q_good`` (1 or 0) of every labelled document; good if any of its labels is."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
    return known.groupBy(F.col("doc_id").alias("__q_id")).agg(F.max("quality").cast("int").alias("__q_good"))


def bucket_counts(docs: DataFrame, marks: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """One row: per bucket the n-grams of all documents (``raw``), labelled ones (``seen``) and good ones (``target``),
    each an array with its sum (``raws``, ``seens``, ``targets``)."""
    marked = docs.select("doc_id", "text").join(marks, F.col("doc_id") == F.col("__q_id"), "left")
    hashed = with_words(marked, "text").select("__q_good", F.explode(gram_hashes()).alias("hash"))
    grams = hashed.select("__q_good", bucket_of(F.col("hash"), buckets).alias("bucket"))
    names = ["raw", "seen", "target"]
    counts = grams.groupBy("bucket").agg(
        F.count("*").alias("raw"), F.count("__q_good").alias("seen"), F.coalesce(F.sum("__q_good"), F.lit(0)).alias("target")
    )
    every = docs.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    filled = every.join(F.broadcast(counts), "bucket", "left").select(
        F.struct("bucket", *[F.coalesce(n, F.lit(0)).alias(n) for n in names]).alias("c")
    )
    sums = filled.agg(
        F.sort_array(F.collect_list("c")).alias("counts"), *[F.sum(f"c.{n}").alias(f"{n}s") for n in names]
    )
    return sums.select(*[F.col(f"counts.{n}").alias(n) for n in names], *[f"{n}s" for n in names])


def plain_weights(counts: DataFrame, buckets: int, smoothing: float) -> DataFrame:
    """One array: per bucket the log of target share over raw share, both smoothed towards uniform."""
    share = lambda n, total: F.log((n + smoothing) / (total + smoothing * buckets))
    weight = lambda t, r: share(t, F.col("targets")) - share(r, F.col("raws"))
    return counts.select(F.zip_with("target", "raw", weight).alias("weights"))


def shared_weights(counts: DataFrame, buckets: int, smoothing: float) -> DataFrame:
    """``target``, ``seen`` and ``prior`` counts, the totals, and ``weights``, as one struct.

    The trusted target stands for the good part of the whole corpus: a bucket's target mass is its raw count times the
    share of its labelled n-grams that are in good documents, smoothed towards the share in all labelled ones by a
    prior dealt out as the raw corpus is. So what few labels cover is not held against a document, and a bucket without
    labels weighs nothing. The weight is the log of the bucket's share of the target mass over its share of the raw
    corpus, where the target mass as a whole is the good share of the raw one.
    """
    prior = F.transform("raw", lambda r: F.lit(smoothing * buckets) * r / F.greatest(F.col("raws"), F.lit(1)))
    good = (F.col("targets") + 1) / (F.col("seens") + 2)
    target_mass = F.zip_with("target", "prior", lambda t, p: t + good * p)
    # a bucket without n-grams is never read
    kept = F.zip_with(target_mass, F.zip_with("seen", "prior", lambda s, p: s + p), lambda t, s: F.when(s > 0, t / s))
    weights = F.transform(kept, lambda k: F.coalesce(F.log(k / good), F.lit(0.0)))
    whole = counts.withColumn("prior", prior)
    return whole.select(F.struct("target", "seen", "prior", "targets", "seens", weights.alias("weights")).alias("w"))


def held_out(w: Column, grams: Column, good: Column) -> Column:
    """Sum of the weights of a labelled document's n-grams as they are without its own label: equal buckets become
    neighbours."""
    size = F.size(grams)
    share = (w["targets"] - size * good + 1) / (w["seens"] - size + 2)

    def of(share: Column) -> Column:
        def part(bucket: Column, n: Column) -> Column:
            prior = F.get(w["prior"], bucket)
            return n * F.log((F.get(w["target"], bucket) - n * good + share * prior) / (F.get(w["seen"], bucket) - n + prior))

        def step(acc: Column, g: Column) -> Column:
            same = acc["last"] == g
            return F.struct(
                g.alias("last"),
                F.when(same, acc["n"] + 1).otherwise(F.lit(1)).alias("n"),
                F.when(same | (acc["n"] == 0), acc["sum"]).otherwise(acc["sum"] + part(acc["last"], acc["n"])).alias("sum"),
            )

        start = F.struct(F.lit(-1).alias("last"), F.lit(0).alias("n"), F.lit(0.0).alias("sum"))
        return F.aggregate(
            F.sort_array(grams),
            start,
            step,
            lambda acc: F.when(acc["n"] > 0, acc["sum"] + part(acc["last"], acc["n"]) - size * F.log(share)).otherwise(F.lit(0.0)),
        )

    return bound(share, of)


def learned_threshold(judged: DataFrame) -> DataFrame:
    """One row with the ``threshold`` that the held-out scores of the labelled documents set; null to reject none.

    The share of bad documents under it, less ``LOSS_WEIGHT`` times that of good ones (with one lost document
    more than were seen), is largest and above 0; it is midway between the steps that hold documents, and the lowest such.
    """
    steps = (
        judged.where(F.col("__q_good").isNotNull() & ~F.col("base_failed"))
        .groupBy(F.floor(F.col("score") * STEPS).alias("step"))
        .agg(F.sum("__q_good").alias("good"), F.sum(1 - F.col("__q_good")).alias("bad"))
    )
    under, whole = Window.orderBy("step").rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    lost = (F.coalesce(F.sum("good").over(under), F.lit(0)) + 1) / (F.sum("good").over(whole) + 1)
    gain = F.try_divide(F.coalesce(F.sum("bad").over(under), F.lit(0)), F.sum("bad").over(whole)) - LOSS_WEIGHT * lost
    middle = (F.lag("step").over(Window.orderBy("step")) + 1 + F.col("step")) / (2 * STEPS)
    best = steps.select(gain.alias("gain"), (-middle).alias("at")).where("gain > 0").agg(F.max(F.struct("gain", "at")).alias("best"))
    return best.select((-F.col("best.at")).alias("threshold"))


def judge_documents(
    docs: DataFrame,
    labels: DataFrame,
    threshold: float | None = None,
    buckets: int = BUCKETS,
    smoothing: float = SMOOTHING,
    columns: list[str] | None = None,
) -> DataFrame:
    """``columns`` of ``docs`` (all by default) with the base measures, ``score`` and ``kept``.

    The labels set the threshold: a labelled document is scored without its own counts, one without a label
    by all counts. Where the labels give no step that parts good from bad (ten good documents or fewer that
    pass the base rules, or no bad one), the base rules alone decide. With a given ``threshold`` the score is the plain
    ratio smoothed towards uniform, own counts included.

    A null or empty text has no words, fails the base rules and scores 0. A null id is judged like any
    other and never counts as labelled; repeated rows are judged row by row, and repeated labels count
    once. Columns of ``docs`` named like a measure are replaced. An empty table gives no rows.
    """
    measures = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "score", "kept"]
    marks = sized(label_marks(labels))
    counts = bucket_counts(docs, marks, buckets)
    weights = (plain_weights if threshold is not None else shared_weights)(counts, buckets, smoothing)
    given = [c for c in docs.columns if c not in measures]
    own = given if columns is None else [c for c in columns if c in given]
    grams = F.transform(gram_hashes(), lambda h: bucket_of(h, buckets))

    def plain(w: Column) -> Column:
        added = lambda total, h: total + F.get(w, bucket_of(h, buckets))
        return F.aggregate("__q_pairs", F.aggregate("__q_hash", F.lit(0.0), added), added)

    good = F.col("__q_good")
    length = F.size("__q_hash") + F.greatest(F.size("__q_hash") - 1, F.lit(0))
    rows = docs.select([F.col(f"`{c}`") for c in given])
    if threshold is not None:
        total = bound(F.col("__q_weights"), plain)
    else:
        rows = rows.join(marks, F.col("doc_id") == F.col("__q_id"), "left")
        total = bound(
            F.col("__q_weights"),
            lambda w: F.when(good.isNull(), bound(w["weights"], plain)).otherwise(bound(grams, lambda g: held_out(w, g, good))),
        )
    judged = (
        base_rules(rows)
        .withColumn("__q_weights", stored(weights, "gram-weights").scalar())
        .withColumn("score", F.when(length > 0, F.round(total / length, 9)).otherwise(F.lit(0.0)))
    )
    if threshold is None:  # the scores are needed twice
        judged = stored(judged.select(*[F.col(f"`{c}`") for c in own], "__q_good", *measures[:-1]), "judged")
        limit = F.coalesce(stored(learned_threshold(judged), "threshold").scalar(), F.lit(float("-inf")))
        passed = F.col("score") >= limit
        return judged.select(*[F.col(f"`{c}`") for c in own], *measures[:-1], (~F.col("base_failed") & passed).alias("kept"))
    return (
        judged.withColumn("kept", ~F.col("base_failed") & (F.col("score") >= threshold))
        # a generator, past which no filter moves: a filter on ``kept`` would work out every measure once more
        .select(*[F.col(f"`{c}`") for c in own], F.inline(F.array(F.struct(*measures))))
    )
