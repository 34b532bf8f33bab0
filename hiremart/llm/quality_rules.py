"""Quality rules with thresholds that follow each language and source.

Only DataFrame functions: no Python runs on the executors.

1. One map over the texts counts words, symbols, lines and five-word windows.
   Windows are compared by 64-bit hashes within their own text.  The slim counts
   are written once; texts are not read again.
2. Each ratio of a document (in thousandths) falls into a bin of a log-linear
   quantile sketch, whose bins are at most 1/32 of their value wide.  A sketch is bins with
   counts, and two are merged by adding counts: tasks pre-aggregate theirs, and the sketches
   of a language, and of all, are merged from those of its sources.
   Documents that fail the fixed base rule are left out.
3. The quartiles of a sketch give the thresholds: ``FENCE`` times the distance between them
   beyond the upper (word length: also the lower) quartile; the distance counts as
   ``LEAST_SPREAD`` at least, so that a ratio that is 0 nearly everywhere rejects no small ones.
   Groups of fewer than ``LEAST_GROUP`` documents take their language's sketch, small languages that of all.
4. The thresholds are joined to the counts by language and source, rows of a key
   dealt over parts.

Scale: no shuffle carries text; bins pre-aggregate before theirs; a window runs over the bins of one
group and ratio (about 1,200 at most), never over documents.

Defined results: a null text has no words and fails the base rule, as an empty one does; null language and
null source are groups of their own; a null doc_id, repeated rows and rows that share an id are each judged by
their text; an empty table gives no rows.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hiremart.llm.common import salted_left_join, written

WINDOW = 5
LEAST_WORDS = 10
MOST_REPEATED = 20  # per cent of the words
FENCE = 3
LEAST_GROUP = 50
FINE_BITS = 6

#: Ratio in thousandths -> numerator, denominator, least distance between the quartiles.
RATIOS = {
    "word_length": ("word_chars", "n_words", 500),
    "symbols": ("n_symbols", "n_words", 50),
    "dup_lines": ("n_dup_lines", "n_lines", 150),
    "repeats": ("n_repeat_words", "n_words", 60),
}
TWO_SIDED = ("word_length",)
LEAST_SPREAD = {k: v[2] for k, v in RATIOS.items()}

_BLANK = " \t\n\x0b\f\r"
_SYMBOLS = "#*$%&|<>"


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _covered(places: Column) -> Column:
    """Words in the windows that begin at ``places`` (ascending); overlaps count once."""
    start = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n"))
    return F.aggregate(places, start, lambda a, p: F.struct(p.alias("last"), (a["n"] + F.least(F.lit(WINDOW), p - a["last"])).alias("n")), lambda a: a["n"])


def _repeat_words(words: Column) -> Column:
    """Words inside windows of ``WINDOW`` words that the text holds twice or more."""

    def of_windows(found: Column) -> Column:
        ordered = F.sort_array(F.transform(found, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def again(s: Column) -> Column:
            same = F.filter(s, lambda x, k: F.coalesce(F.get(s, k - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(s, k + 1)["h"] == x["h"], F.lit(False)))
            return _covered(F.sort_array(F.transform(same, lambda x: x["i"])))

        # most texts repeat no window and are not sorted
        return F.when(F.size(F.array_distinct(found)) == F.size(found), F.lit(0)).otherwise(_let(ordered, again))

    def of_hashes(h: Column) -> Column:
        found = F.transform(F.sequence(F.lit(0), F.size(h) - WINDOW), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(WINDOW)]))
        return F.when(F.size(h) > WINDOW, _let(found, of_windows)).otherwise(0)

    return _let(F.transform(words, lambda w: F.xxhash64(w)), of_hashes)


def counts(text: Column) -> Column:
    """Struct of the counts of a text; words and lines are cut once."""
    whole = F.coalesce(text, F.lit(""))
    words = F.regexp_extract_all(whole, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    with_words = F.filter(F.split(whole, "\n"), lambda x: F.btrim(x, F.lit(_BLANK)) != "")

    def of(w: Column, lines: Column) -> Column:
        found = {
            "n_words": F.size(w), "word_chars": F.length(F.translate(whole, _BLANK, "")),
            "n_symbols": F.length(whole) - F.length(F.translate(whole, _SYMBOLS, "")), "n_lines": F.size(lines),
            "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)), "n_repeat_words": _repeat_words(w),
        }
        return F.struct(*[v.cast("long").alias(k) for k, v in found.items()])

    return _let(words, lambda w: _let(with_words, lambda lines: of(w, lines)))


def measured(docs: DataFrame, *, key: str = "doc_id", text: str = "text", language: str = "lang", source: str = "source") -> DataFrame:
    """Key, group, counts and base_failed of every document, written once."""

    def group(name: str) -> Column:  # null is a group of its own
        return F.coalesce(F.concat(F.lit("="), F.col(name).cast("string")), F.lit("-"))

    # inline is a generator, so the counts are computed once and not again for each column
    found = docs.select(F.col(key), group(language).alias("lk"), group(source).alias("sk"), F.inline(F.array(counts(F.col(text).cast("string")))))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return written(found.withColumn("base_failed", failed), "quality-counts")


def ratio(name: str) -> Column:
    """A ratio of the counts in whole thousandths."""
    over, under, _ = RATIOS[name]
    return F.expr(f"(1000 * {over}) div {under}")


def bin_of(value: Column) -> Column:
    """Lower edge of the sketch's bin: the leading ``FINE_BITS`` bits of a whole number."""
    shift = F.greatest(F.length(F.bin(value)) - FINE_BITS, F.lit(0))
    return _let(shift, lambda s: F.call_function("shiftleft", F.call_function("shiftright", value, s), s))


def sketches(found: DataFrame) -> DataFrame:
    """Bins with counts of every ratio: of each language and source, of each language (sk null), of all (lk, sk null)."""
    passed = found.where(~F.col("base_failed"))
    long = passed.select("lk", "sk", F.explode(F.array(*[F.struct(F.lit(k).alias("ratio"), ratio(k).alias("v")) for k in RATIOS])).alias("x"))
    own = written(long.select("lk", "sk", "x.ratio", F.col("x.v").alias("v")).groupBy("lk", "sk", "ratio", bin_of(F.col("v")).alias("bin")).agg(F.count(F.lit(1)).alias("n")), "quality-sketch")
    nobody = F.lit(None).cast("string")
    merged = own.groupBy("lk", "ratio", "bin").agg(F.sum("n").alias("n")).select("lk", nobody.alias("sk"), "ratio", "bin", "n")
    whole = own.groupBy("ratio", "bin").agg(F.sum("n").alias("n")).select(nobody.alias("lk"), nobody.alias("sk"), "ratio", "bin", "n")
    return own.unionByName(merged).unionByName(whole)


def fences(bins: DataFrame, *, fence: int = FENCE) -> DataFrame:
    """Documents behind each sketch and the limits of every ratio, a row for each (lk, sk)."""
    of = Window.partitionBy("lk", "sk", "ratio")
    upto = of.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cut = bins.withColumn("upto", F.sum("n").over(upto)).withColumn("all", F.sum("n").over(of))
    quartiles = cut.groupBy("lk", "sk", "ratio").agg(
        F.min(F.when(4 * F.col("upto") >= F.col("all"), F.col("bin"))).alias("low"),
        F.min(F.when(4 * F.col("upto") >= 3 * F.col("all"), F.col("bin"))).alias("high"), F.max("all").alias("n"),
    )
    least = F.coalesce(*[F.when(F.col("ratio") == k, F.lit(v)) for k, v in LEAST_SPREAD.items()])
    spread = fence * F.greatest(F.col("high") - F.col("low"), least)
    limits = quartiles.select("lk", "sk", "ratio", "n", (F.col("low") - spread).alias("low"), (F.col("high") + spread).alias("high"))
    return limits.groupBy("lk", "sk").agg(
        F.max("n").alias("n"),
        *[F.max(F.when(F.col("ratio") == k, F.col("high"))).alias(f"{k}_most") for k in RATIOS],
        *[F.max(F.when(F.col("ratio") == k, F.col("low"))).alias(f"{k}_least") for k in TWO_SIDED],
    )


def thresholds(found: DataFrame, *, least_group: int = LEAST_GROUP) -> DataFrame:
    """Limits for every (lk, sk): of the first large enough of its own sketch, its language's, that of all."""
    by_group = written(fences(sketches(found)), "quality-fences")
    limits = [c for c in by_group.columns if c not in ("lk", "sk", "n")]
    all_of = lambda c: F.coalesce(c, F.lit("*"))  # noqa: E731  keys begin with "=" or "-"
    offered = by_group.where((F.col("n") >= least_group) | F.col("lk").isNull()).select(all_of(F.col("lk")).alias("a"), all_of(F.col("sk")).alias("b"), *limits)
    any_key = F.lit("*")
    asked = by_group.where("sk is not null").select("lk", "sk", F.posexplode(F.array(
        F.struct(F.col("lk").alias("a"), F.col("sk").alias("b")), F.struct(F.col("lk").alias("a"), any_key.alias("b")), F.struct(any_key.alias("a"), any_key.alias("b")),
    )).alias("turn", "of"))
    met = asked.select("lk", "sk", "turn", "of.a", "of.b").join(offered, ["a", "b"])
    return met.groupBy("lk", "sk").agg(F.min_by(F.struct(*limits), "turn").alias("limits")).select("lk", "sk", "limits.*")


def judged(docs: DataFrame, *, key: str = "doc_id", text: str = "text", language: str = "lang", source: str = "source", least_group: int = LEAST_GROUP) -> DataFrame:
    """Key, counts, base_failed and kept of every document."""
    found = measured(docs, key=key, text=text, language=language, source=source)
    joined = salted_left_join(found, thresholds(found, least_group=least_group), ["lk", "sk"], F.struct(key, "n_words", "word_chars"))
    inside = [ratio(k) <= F.col(f"{k}_most") for k in RATIOS] + [ratio(k) >= F.col(f"{k}_least") for k in TWO_SIDED]
    good = inside[0]
    for x in inside[1:]:
        good = good & x
    kept = F.when(F.col("base_failed"), F.lit(False)).otherwise(F.coalesce(good, F.lit(False)))
    return joined.select(key, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"), "n_lines")


def passing(docs: DataFrame, *, key: str = "doc_id", **names) -> DataFrame:
    """The rows of ``docs``, whole, whose id has a kept row (rows that share an id go or stay by the best of them)."""
    good = judged(docs, key=key, **names).where("kept").select(key).distinct()
    return docs.join(good, key, "left_semi")
