"""Quality rules with limits that adapt to language and source, as DataFrame expressions only.

Each document gets a few measures. Per (language, source) and measure a mergeable quantile sketch counts values in
log-linear bins: values below 1024 exactly, larger ones by their ten highest bits, so a quantile is off by less than
one part in 512. Sketches merge by adding counts: groups of fewer than `least` documents take their language's, and
languages as small take the whole table's. Limits are quartiles plus or minus a multiple of their distance, never
nearer to the quartiles than a floor, and wider for short texts, whose means scatter more. Documents join their group's limits
and are kept or not.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripstrata.llm.shared import stored

#: What parts words, and the symbols counted.
SPACES = " \t\n\x0b\x0c\r"
BETWEEN_WORDS = r"[\x20\x09-\x0D]+"
A_WORD = r"[^\x20\x09-\x0D]"
SYMBOLS = "[#*$%&|<>]"
WINDOW = 5

#: Limit tables up to this many rows are broadcast (some 100 bytes each); larger ones are joined by a shuffle.
BROADCAST_ROWS = 50_000


@dataclass(frozen=True)
class Rules:
    """`reach` times the quartiles' distance, but at least the measure's floor, may lie between quartile and limit."""

    least: int = 200
    reach: float = 4.0
    steady_words: int = 200
    #: Measure: (floor of the distance, whether there is a lower limit). Measures are per mille of their base.
    floors: tuple[tuple[str, int, bool], ...] = (("word_length", 500, True), ("symbols", 100, False), ("dup_lines", 400, False), ("repeat_words", 200, False))


def measures(text: Column) -> dict[str, Column]:
    """Expressions of the counts of one text (null: no words), to be selected in two steps: see `measured`."""
    return {"words": F.array_remove(F.split(text, BETWEEN_WORDS), ""), "lines": F.filter(F.split(text, "\n"), lambda x: x.rlike(A_WORD))}


def measured(docs: DataFrame, text_col: str, keep: list[Column]) -> DataFrame:
    """`keep` and the counts n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, one row per row."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    dense = text
    for space in SPACES:
        dense = F.replace(dense, F.lit(space), F.lit(""))
    split = docs.select(
        *keep,
        *(c.alias(f"_{n}") for n, c in measures(text).items()),
        F.length(dense).cast("bigint").alias("word_chars"),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("bigint").alias("n_symbols"),
    )
    names = split.columns[: len(keep)]
    windows = F.expr(f"slice(transform(_words, (w, i) -> xxhash64(w, {', '.join(f'get(_words, i + {k})' for k in range(1, WINDOW))})), 1, greatest(size(_words) - {WINDOW - 1}, 0))")
    hashed = split.select(
        *names, "word_chars", "n_symbols",
        F.size("_words").cast("bigint").alias("n_words"),
        F.size("_lines").cast("bigint").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
        windows.alias("_windows"),
    )
    # Starts of windows that occur again: neighbours by hash, then a walk over the starts in order of place.
    placed = hashed.select("*", F.expr("CASE WHEN size(array_distinct(_windows)) < size(_windows) THEN sort_array(transform(_windows, (h, i) -> struct(h, i))) END").alias("_placed"))
    starts = placed.select("*", F.expr("sort_array(transform(filter(_placed, (p, k) -> p.h = get(_placed, k - 1).h OR p.h = get(_placed, k + 1).h), p -> p.i))").alias("_starts"))
    covered = F.expr(f"aggregate(_starts, struct(-{WINDOW} AS last, 0L AS words), (a, s) -> struct(s AS last, a.words + least({WINDOW}, s - a.last) AS words), a -> a.words)")
    return starts.select(*names, "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", F.coalesce(covered, F.lit(0)).cast("bigint").alias("n_repeat_words"))


def shares() -> dict[str, Column]:
    """The measures that have limits, as whole per mille."""
    per_mille = lambda a, b: F.expr(f"CAST(CASE WHEN {b} > 0 THEN {a} * 1000 DIV {b} ELSE 0 END AS bigint)")
    return {
        "word_length": per_mille("word_chars", "n_words"),
        "symbols": per_mille("n_symbols", "n_words"),
        "dup_lines": per_mille("n_dup_lines", "n_lines"),
        "repeat_words": per_mille("n_repeat_words", "n_words"),
    }


def sketch(counted: DataFrame) -> DataFrame:
    """(lang, source, measure, bin, n): the sketch of every group and measure; adding n merges sketches."""
    long = counted.where("n_words > 0").select("lang", "source", F.explode(F.map_from_arrays(F.array(*(F.lit(k) for k in shares())), F.array(*shares().values()))).alias("measure", "v"))
    places = "greatest(length(bin(v)) - 10, 0)"
    return long.withColumn("bin", F.expr(f"shiftleft(shiftright(v, {places}), {places})")).groupBy("lang", "source", "measure", "bin").agg(F.count("*").alias("n"))


def _quartiles(sketches: DataFrame, by: list[str]) -> DataFrame:
    """Documents and quartiles of each group: its bins, some thousands at most, in one array per group and measure."""
    merged = sketches.groupBy(*by, "measure", "bin").agg(F.sum("n").alias("n"))
    bins = merged.groupBy(*by, "measure").agg(F.sum("n").alias("docs"), F.sort_array(F.collect_list(F.struct("bin", "n"))).alias("bins"))
    at = lambda q: F.expr(f"aggregate(bins, struct(0L AS seen, CAST(NULL AS bigint) AS found), (a, b) -> struct(a.seen + b.n AS seen, CASE WHEN a.found IS NULL AND (a.seen + b.n) * 4 >= docs * {q} THEN b.bin ELSE a.found END AS found), a -> a.found)")
    return bins.select(*by, "measure", "docs", at(1).alias("low"), at(3).alias("high"))


def limits(sketches: DataFrame, rules: Rules) -> DataFrame:
    """(lang, source, and for each measure its quartiles `<measure>_low` and `<measure>_high`)."""
    own = _quartiles(sketches, ["lang", "source"])
    by_lang = _quartiles(sketches, ["lang"]).select(F.col("lang").alias("l"), F.col("measure").alias("lm"), F.struct("docs", "low", "high").alias("of_lang"))
    of_all = _quartiles(sketches, []).select(F.col("measure").alias("am"), F.struct("docs", "low", "high").alias("of_all"))
    joined = own.join(by_lang, F.col("lang").eqNullSafe(F.col("l")) & (F.col("measure") == F.col("lm"))).join(of_all, F.col("measure") == F.col("am"))
    chosen = joined.select("lang", "source", "measure", F.when(F.col("docs") >= rules.least, F.struct("docs", "low", "high")).when(F.col("of_lang.docs") >= rules.least, F.col("of_lang")).otherwise(F.col("of_all")).alias("q"))
    pick = lambda m, side: F.max(F.when(F.col("measure") == m, F.col(f"q.{side}"))).alias(f"{m}_{side}")
    return chosen.groupBy("lang", "source").agg(*(pick(m, side) for m in shares() for side in ("low", "high")))


def verdicts(counted: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """`counted` with base_failed and kept. `counted` is read twice, so it should be stored or cheap."""
    found = limits(sketch(counted), rules)
    small = stored(found)
    if small.count() <= BROADCAST_ROWS:
        small = F.broadcast(small)
    small = small.withColumnsRenamed({"lang": "_l", "source": "_s"})
    joined = counted.join(small, counted["lang"].eqNullSafe(F.col("_l")) & counted["source"].eqNullSafe(F.col("_s")), "left")
    base = (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20)
    scatter = F.sqrt(F.greatest(F.lit(1.0), rules.steady_words / F.greatest(F.col("n_words"), F.lit(1))))
    good = F.lit(True)
    value = shares()
    for name, floor, two_sided in rules.floors:
        low, high = F.col(f"{name}_low"), F.col(f"{name}_high")
        room = F.greatest(rules.reach * (high - low), F.lit(float(floor))) * scatter
        good = good & (value[name] <= high + room)
        if two_sided:
            good = good & (value[name] >= low - room)
    return joined.withColumn("base_failed", base).withColumn("kept", ~base & F.coalesce(good, F.lit(False))).select(*counted.columns, "base_failed", "kept")


def _group(name: str | None) -> Column:
    return F.col(name).cast("string") if name else F.lit(None).cast("string")


def quality(docs: DataFrame, rules: Rules = Rules(), id_col: str = "doc_id", text_col: str = "text", lang_col: str | None = "lang", source_col: str | None = "source") -> DataFrame:
    """Counts and verdict of every row: doc_id, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, base_failed, kept.

    A null text has no words and fails. Null languages or sources form groups of their own. Null or repeated ids and
    repeated rows keep their rows; every other column is left unread, whatever its name. An empty table gives none.
    Sketches are aggregated before they are shuffled, so a source with most rows costs no more than others.
    """
    keep = [F.col(id_col).cast("bigint").alias("doc_id"), _group(lang_col).alias("lang"), _group(source_col).alias("source")]
    counted = stored(measured(docs, text_col, keep))
    return verdicts(counted, rules).drop("lang", "source")


def good_documents(docs: DataFrame, rules: Rules = Rules(), text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """The rows of `docs` that the rules keep, with all of their columns.

    Rows and counts are stored together once, so that neither texts are shuffled nor counts taken twice; rows need no key.
    """
    row = F.struct(*(docs[c] for c in docs.columns)).alias("row")
    keep = [row, _group(lang_col).alias("lang"), _group(source_col).alias("source")]
    counted = stored(measured(docs, text_col, keep))
    return verdicts(counted, rules).where("kept").select("row.*")
