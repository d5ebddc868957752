"""Operator 10: quality rules by a log-likelihood ratio of hashed n-grams.

Words and word pairs are hashed into buckets; one multinomial over the buckets is counted
on trusted documents and one on the whole raw corpus. A document's score is the mean log
ratio of the two over its n-grams, and every document is judged by one threshold, which
follows from the trusted documents' own scores. Base rules on the text's form come first.
DataFrame functions only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.shared import stored

#: White space between words, and characters that count as symbols.
SPACE, SYMBOLS = " \t\n\u000b\f\r", "[#*$%&|<>]"
_SPLIT, WINDOW = "[\\x20\\x09-\\x0D]+", 5
LEAST_WORDS, MOST_REPEATED = 10, 20
BUCKETS = 1 << 14
#: Counts by which the trusted multinomial is drawn towards the raw one.
PRIOR = 4096
#: A score's error falls with the square root of the words, so the score times that root
#: is what the threshold is for: this many times its given quantile on trusted documents.
QUANTILE, MARGIN = 0.001, 2.0
#: The quantile is looked for in so many cells at a time, until so few values are left.
CELLS, FEW = 1000, 10_000
#: Bits of the map of trusted ids that is broadcast, 64 a row: a fixed size for any number of ids.
ID_BITS = 1 << 25


def with_words(docs: DataFrame) -> DataFrame:
    """``row`` (a struct of the columns of ``docs``), ``text`` (null: empty), ``words``."""
    text = F.coalesce(docs["text"], F.lit(""))
    out = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), text.alias("text"),
                      F.btrim(text, F.lit(SPACE)).alias("inner"))
    words = F.when(F.col("inner") == "", F.array().cast("array<string>")).otherwise(F.split("inner", _SPLIT))
    return out.select("row", "text", words.alias("words"))


def repeated_words() -> str:
    """SQL: of sorted ``(hash, place)`` windows ``s``, the words in those that occur twice
    or more: windows of five words from sorted places cover the gaps up to five."""
    return f"""aggregate(zip_with(places, slice(places, 2, size(places)),
        (a, b) -> least({WINDOW}, coalesce(b - a, {WINDOW}))), 0L, (x, y) -> x + y)"""


def base_counts(worded: DataFrame) -> DataFrame:
    """Adds ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed``.

    Windows are compared by a 64-bit hash of their words' hashes. Only texts with an equal pair of
    windows sort theirs; the steps are apart so that each is evaluated once."""
    n = F.size("words")
    lines = "filter(split(text, '\\n', -1), l -> btrim(l, '%s') <> '')" % SPACE.replace("\n", "\\n").replace("\t", "\\t").replace("\u000b", "\\u000b").replace("\f", "\\u000c").replace("\r", "\\r")
    hashes = F.when(n < WINDOW, F.array().cast("array<bigint>")).otherwise(F.expr(
        "transform(slice(one, 1, size(one) - %d), (h, i) -> xxhash64(h, %s))" % (
            WINDOW - 1, ", ".join(f"one[i + {k}]" for k in range(1, WINDOW)))))
    out = worded.withColumn("one", F.transform("words", lambda w: F.xxhash64(w))).select(
        *worded.columns, n.cast("long").alias("n_words"), F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.expr(lines).alias("lines"), hashes.alias("hashes"))
    out = out.withColumns({
        "n_dup_lines": F.expr("cast(size(lines) - size(array_distinct(lines)) as long)"),
        "s": F.expr("""CASE WHEN size(array_distinct(hashes)) < size(hashes)
            THEN sort_array(transform(hashes, (h, i) -> struct(h AS h, i AS i))) END""")})
    out = out.withColumn("same", F.expr("zip_with(s, slice(s, 2, size(s)), (a, b) -> coalesce(a.h = b.h, false))"))
    out = out.withColumn("places", F.expr("""array_sort(filter(zip_with(s, zip_with(same,
        concat(array(false), slice(same, 1, size(same) - 1)), (a, b) -> a or b), (x, d) -> if(d, x.i, null)), x -> x is not null))"""))
    out = out.withColumn("n_repeat_words", F.expr(f"cast(coalesce({repeated_words()}, 0) as long)"))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return out.withColumn("base_failed", failed).drop("lines", "hashes", "s", "same", "places")


def _bucket(*words: str) -> str:
    return f"cast(pmod(xxhash64({', '.join(words)}), {BUCKETS}) as int)"


def trusted_ids(labels: DataFrame) -> DataFrame:
    """The ids of all documents labelled as good and not toxic."""
    return labels.where("quality = 1 and coalesce(toxic, 0) = 0 and doc_id is not null").select("doc_id").distinct()


def of_ids(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``doc_id, text`` of the rows of ``docs`` whose id is in ``ids(doc_id)``, which are
    distinct and not null.

    Texts whose id has no bit in a map of hashed ids go before the shuffle; the rest meets
    the ids themselves, so what is left is exact."""
    bit = F.expr(f"pmod(xxhash64(cast(doc_id as string)), {ID_BITS})")
    cells = ids.select(bit.alias("bit")).groupBy(F.expr("bit div 64").alias("cell")).agg(
        F.expr("bit_or(shiftleft(1L, cast(bit % 64 as int)))").alias("bits"))
    near = docs.select("doc_id", "text", bit.alias("bit")).withColumn("cell", F.expr("bit div 64")).join(
        F.broadcast(cells), "cell").where("shiftright(bits, cast(bit % 64 as int)) & 1 = 1")
    # a semi join would be moved below the map's, in front of it
    return near.select("doc_id", "text").join(ids.hint("merge"), "doc_id").select("doc_id", "text")


def grams(docs: DataFrame) -> DataFrame:
    """``buckets``: those of a text's words in order, then those of its word pairs."""
    pairs = F.expr(f"""concat(transform(words, w -> {_bucket('w')}),
        zip_with(slice(words, 1, size(words) - 1), slice(words, 2, size(words)), (a, b) -> {_bucket('a', 'b')}))""")
    return with_words(docs.select("text")).select(
        F.when(F.size("words") > 1, pairs).otherwise(F.expr(f"transform(words, w -> {_bucket('w')})")).alias("buckets"))


def counts(grams: DataFrame) -> list[int]:
    """How often each bucket is met in ``buckets``: one row for each bucket and task meet,
    and the result has one number for each bucket."""
    out = [0] * BUCKETS
    # explode alone would be given a filter in which the buckets are made a second time
    for r in grams.select(F.explode_outer("buckets").alias("bucket")).groupBy("bucket").count().collect():
        if r["bucket"] is not None:
            out[r["bucket"]] = r["count"]
    return out


def log_ratios(raw: list[int], target: list[int]) -> list[float]:
    """The log ratio of each bucket, from its counts in all and in the trusted documents."""
    if not sum(target):
        return [0.0] * BUCKETS  # nothing is trusted: nothing tells documents apart
    all_raw, all_target = sum(raw), sum(target)
    return [math.log((t + PRIOR * r / all_raw) * all_raw / (r * (all_target + PRIOR))) if r else 0.0
            for r, t in zip(raw, target)]


def ratios(docs: DataFrame, trusted: DataFrame) -> list[float]:
    """The log ratio of each bucket; ``trusted(doc_id)`` names the trusted documents."""
    return log_ratios(counts(grams(docs)), counts(grams(of_ids(docs, trusted))))


def _table(weights: list[float]) -> Column:
    return F.split(F.lit(",".join(f"{w:.6f}" for w in weights)), ",").cast("array<double>")


def _mean(alone: Column, pairs: Column, n: Column) -> Column:
    return F.round((alone + pairs) / F.greatest(F.lit(1), 2 * n - 1), 6)


def scored(worded: DataFrame, weights: list[float]) -> DataFrame:
    """Adds ``llr``: the mean weight of a text's words and pairs; 0 without words."""
    table = _table(weights)
    weight = lambda *x: F.get(table, F.pmod(F.xxhash64(*x), F.lit(BUCKETS)).cast("int"))
    n = F.size("words")
    alone = F.aggregate("words", F.lit(0.0), lambda total, w: total + weight(w))
    pairs = F.zip_with(F.slice("words", 1, n - 1), F.slice("words", 2, n), lambda a, b: weight(a, b))
    pairs = F.when(n > 1, F.aggregate(pairs, F.lit(0.0), lambda total, w: total + w)).otherwise(0.0)
    return worded.withColumn("llr", _mean(alone, pairs, n))


#: What is compared with the threshold, of ``llr`` and the number of words.
_EVIDENCE = "llr * sqrt({})"


def nth_least(values: DataFrame, n: int) -> float:
    """The value of column ``x`` that ``n`` others stand before in ascending order.

    The cells between the least and the greatest value are counted and the one that holds it
    is cut into cells again, until few values are left in it; no task holds them all."""
    low, high, left = values.agg(F.min("x"), F.max("x"), F.count("x")).first()
    while low < high and left > FEW:
        cell = F.least(F.floor((F.col("x") - low) / (high - low) * CELLS), F.lit(CELLS - 1))
        for r in values.groupBy(cell.alias("cell")).agg(
                F.min("x").alias("low"), F.max("x").alias("high"), F.count("x").alias("rows")).orderBy("cell").collect():
            if n < r["rows"]:
                break
            n -= r["rows"]
        low, high, left = r["low"], r["high"], r["rows"]
        values = values.where(F.col("x").between(low, high))
    return low if low == high else sorted(r["x"] for r in values.collect())[n]


def least_evidence(trusted: DataFrame, weights: list[float]) -> float:
    """The least evidence that keeps a document, from the ``buckets`` of trusted ones;
    without any, all are kept. The quantile lies between the two values next to it."""
    table, n = _table(weights), F.expr("(size(buckets) + 1) div 2").cast("int")
    total = lambda part: F.aggregate(part, F.lit(0.0), lambda sum, b: sum + F.get(table, b))
    own = trusted.withColumn("n", n).where(F.col("n") >= LEAST_WORDS)
    own = own.withColumn("llr", _mean(total(F.slice("buckets", 1, F.col("n"))), total(F.slice("buckets", F.col("n") + 1, F.col("n"))), F.col("n")))
    values = stored(own.selectExpr(f"{_EVIDENCE.format('n')} AS x"), "evidence")
    count = values.count()
    if not count:
        return float("-inf")
    at = QUANTILE * (count - 1)
    below, above = nth_least(values, math.floor(at)), nth_least(values, math.ceil(at))
    return MARGIN * min(below + (above - below) * (at - math.floor(at)), 0.0)


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``row`` (a struct of the columns of ``docs``), the base columns, ``llr``, ``kept``.

    Null and empty texts have no words and fail the base rules; repeated rows are judged
    each; null labels are no trust. Only columns of ``labels`` by name are read."""
    trusted = stored(grams(of_ids(docs, trusted_ids(labels))), "trusted")
    weights = log_ratios(counts(grams(docs)), counts(trusted))
    least = least_evidence(trusted, weights)
    out = scored(base_counts(with_words(docs)), weights)
    return out.withColumn("kept", ~F.col("base_failed") & F.expr(f"{_EVIDENCE.format('size(words)')} >= {least!r}D" if math.isfinite(least) else "true"))


def quality_rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per row of ``docs``: the base columns, ``kept`` and ``llr``."""
    return judged(docs.select("doc_id", "text"), labels).select(
        F.col("row.doc_id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines",
        "n_repeat_words", "base_failed", "kept", "llr")


def good_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, all columns as they are. No shuffle of texts.

    The row number keeps the filter where it stands: moved below the columns it needs, it
    would repeat what they are made of many times over."""
    out = judged(docs, labels).withColumn("place", F.monotonically_increasing_id()).where("kept and place >= 0")
    return out.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])
