"""Benchmark decontamination with DataFrame functions only.

The benchmark's windows of normalised words become two things: a table of window texts, and a
bitmap of their hashes, sized by the benchmark, that travels inside the query as a constant.  A document's windows are tested
against the bitmap in place, without a shuffle; the few that pass are joined to the table by their
whole text, so a hit is always verified word by word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from weirflow.lineage import cut_lineage

WINDOW = 13
SLOTS_A_WINDOW = 32      # bits of the bitmap for each window of the benchmark: one in 250 others passes
LEAST_SLOTS, MOST_SLOTS = 1 << 17, 1 << 28  # 16 kB and 32 MB; a larger benchmark only lets more windows pass to the join
_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # words of lower-cased text stand between these


def normal_words(text: Column) -> Column:
    """Words of a text: A-Z lower-cased, cut at ASCII that is no letter or digit; null has none."""
    lower = F.translate(F.coalesce(text.cast("string"), F.lit("")), _LETTERS, _LETTERS.lower())
    return F.filter(F.split(lower, _BETWEEN), lambda w: w != "")


def _starts(words: Column, width: int) -> Column:
    """1-based starts of the windows of ``width`` words."""
    return F.when(F.size(words) >= width, F.sequence(F.lit(1), F.size(words) - (width - 1))).otherwise(
        F.array().cast("array<int>"))


def _slots(hashed: Column, slots: int) -> list[Column]:
    """Two places of the bitmap for a window's hash, counted from 0: its lower and its upper bits."""
    low = F.lit(slots - 1).cast("long")
    return [hashed.bitwiseAND(low), F.shiftrightunsigned(hashed, 32).bitwiseAND(low)]


def _may_be_in(bitmap: Column, slots: int, words: Column) -> Column:
    """Whether both places are marked; the hash is bound to a lambda's variable, so that it is taken once."""
    marked = lambda slot: F.getbit(F.get(bitmap, F.shiftright(slot, 6).cast("int")), slot.bitwiseAND(F.lit(63).cast("long")).cast("int")) == 1

    def both(hashed: Column) -> Column:
        one, two = _slots(hashed, slots)
        return marked(one) & marked(two)

    return F.exists(F.array(F.xxhash64(words)), both)


def benchmark_windows(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", width: int = WINDOW) -> DataFrame:
    """(item, width, window) for every item's windows; a shorter item is one window, none without words."""
    words = benchmark.select(F.col(id_col).cast("string").alias("item"), normal_words(F.col(text_col)).alias("words"))
    words = words.filter(F.size("words") > 0).withColumn("width", F.least(F.size("words"), F.lit(width)))
    starts = F.sequence(F.lit(1), F.size("words") - F.col("width") + 1)
    windows = F.transform(F.array("words"), lambda w: F.transform(
        starts, lambda i: F.array_join(F.slice(w, i, F.col("width")), " ")))[0]
    return words.select("item", "width", F.explode(windows).alias("window")).distinct()


def _bitmap(windows: DataFrame) -> tuple[Column, int, list[int]]:
    """The bitmap as a constant array of 64-bit words, its slots, and the window widths.

    Its size follows the benchmark, within bounds.  Only its words reach the driver, gathered by Spark.
    """
    seen = windows.agg(F.count("*").alias("n"), F.collect_set("width").alias("widths")).first()
    slots = LEAST_SLOTS
    while slots < min(MOST_SLOTS, SLOTS_A_WINDOW * seen.n):
        slots *= 2
    parts = windows.select(F.explode(F.array(*_slots(F.xxhash64(F.split("window", " ")), slots))).alias("slot"))
    marked = parts.groupBy(F.shiftright("slot", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, CAST(slot & 63 AS INT))")).alias("bits")).collect()
    held = {r.word: r.bits for r in marked}
    # the optimizer folds the split and the cast into one literal
    text = ",".join(str(held.get(k, 0)) for k in range(slots // 64))
    return F.split(F.lit(text), ",").cast("array<bigint>"), slots, sorted(seen.widths)


def _places(words: Column, width: int, bitmap: Column, slots: int) -> Column:
    """(start, width, window) of the windows that pass the bitmap."""
    held = F.filter(_starts(words, width), lambda i: _may_be_in(bitmap, slots, F.slice(words, i, width)))
    return F.transform(held, lambda i: F.struct(
        i.alias("start"), F.lit(width).alias("width"), F.array_join(F.slice(words, i, width), " ").alias("window")))


def _scanned(docs: DataFrame, windows: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, row, mark, n_words, places) of each row in one pass: places are windows that pass the bitmap.

    ``row`` tells rows with equal ids apart, ``mark`` their texts.  Written to the checkpoint folder; apart from the ids it
    holds little more than the hits.
    """
    bitmap, slots, widths = _bitmap(windows)
    none = F.array().cast("array<struct<start:int,width:int,window:string>>")
    # the words are bound to a lambda's variable, so that they are cut out once a text
    scan = F.transform(F.array(normal_words(F.col(text_col))), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"), F.concat(none, *[_places(w, n, bitmap, slots) for n in widths]).alias("places")))
    return cut_lineage(docs.select(F.col(id_col), F.monotonically_increasing_id().alias("row"), _mark(text_col).alias("mark"), F.inline(scan)))


def _mark(text_col: str) -> Column:
    return F.xxhash64(F.col(text_col).cast("string"))


def _hits(scanned: DataFrame, windows: DataFrame, id_col: str) -> DataFrame:
    places = scanned.filter(F.size("places") > 0).select(F.col(id_col), "row", F.explode("places").alias("p")).select(
        F.col(id_col), "row", "p.start", "p.width", "p.window")
    return places.join(windows, ["width", "window"]).select(F.col(id_col), "row", "item", "start", "width")


def benchmark_hits(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", width: int = WINDOW,
) -> DataFrame:
    """Every place where a benchmark window stands in a document: (id, item, start, width).

    ``start`` counts words from 1.  Cases as in ``contamination``.
    """
    windows = benchmark_windows(benchmark, item_col, item_text_col, width)
    return _hits(_scanned(docs, windows, id_col, text_col), windows, id_col).drop("row")


def contamination(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", width: int = WINDOW,
) -> DataFrame:
    """Each document's words, hit words and the items found in it.

    Returns (id, n_words, n_hit, items array<string> sorted, spans array<struct<first,last>>): word
    positions from 1, overlapping spans merged; a row for each row of ``docs``, repeated ids too.  A
    word inside any occurrence of a window is hit.  Null and empty texts have no words and no hit; an
    item without words has no window; an empty benchmark hits nothing.  Other columns of either
    table are not read.
    """
    return _measured(docs, benchmark, id_col, text_col, item_col, item_text_col, width).drop("mark")


def _measured(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", width: int = WINDOW,
) -> DataFrame:
    windows = benchmark_windows(benchmark, item_col, item_text_col, width)
    scanned = _scanned(docs, windows, id_col, text_col)
    span = F.struct(F.col("start").alias("first"), (F.col("start") + F.col("width") - 1).alias("last"))
    per_row = _hits(scanned, windows, id_col).groupBy("row").agg(
        F.array_sort(F.collect_set("item")).alias("items"), F.array_sort(F.collect_set(span)).alias("found"))
    per_row = per_row.select("row", "items", merge_spans(F.col("found")).alias("spans"))
    out = scanned.select(F.col(id_col), "row", "mark", "n_words").join(per_row, "row", "left")
    covered = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["last"] - s["first"] + 1)
    return out.select(
        F.col(id_col), "mark", "n_words", F.coalesce(covered, F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.coalesce("spans", F.array().cast("array<struct<first:int,last:int>>")).alias("spans"),
    )


def merge_spans(spans: Column) -> Column:
    """Sorted spans with those that overlap or touch put together."""
    empty = F.array().cast("array<struct<first:int,last:int>>")

    def add(acc: Column, s: Column) -> Column:
        top = F.element_at(acc, -1)
        joined = F.struct(top["first"].alias("first"), F.greatest(top["last"], s["last"]).alias("last"))
        return F.when((F.size(acc) > 0) & (s["first"] <= F.get(acc, F.size(acc) - 1)["last"] + 1),
                      F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), F.array(joined))).otherwise(
                          F.concat(acc, F.array(F.struct(s["first"].alias("first"), s["last"].alias("last")))))

    return F.aggregate(spans, empty, add)


def is_contaminated() -> Column:
    """The contract's rule on ``n_hit`` and ``n_words``: some word hit, and one in twenty or more."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def clean_documents(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not contaminated.

    A row is known by its id and text: of rows that share an id only those with a contaminated text
    go, and a row with a null id is judged like any other.
    """
    bad = _measured(docs, benchmark, id_col, text_col).filter(is_contaminated()).select(F.col(id_col).alias("_bad"), "mark").distinct()
    marked = docs.withColumn("_mark", _mark(text_col))
    return marked.join(bad, marked[id_col].eqNullSafe(bad["_bad"]) & (marked["_mark"] == bad["mark"]), "left_anti").drop("_mark")


def cut_spans(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text without the hit words): the words' own bytes go, what stands between words stays.

    Texts without a hit come back unchanged, null as null.
    """
    spans = contamination(docs, benchmark, id_col, text_col).select(F.col(id_col).alias("_id"), "spans").filter(F.size("spans") > 0)
    joined = docs.select(F.col(id_col), F.col(text_col)).join(spans, docs[id_col] == spans["_id"], "left")
    word = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    pieces = F.split(F.col(text_col), word, -1)
    own = F.regexp_extract_all(F.col(text_col), F.lit(word), F.lit(0))
    kept = F.transform(F.array(own), lambda w: F.transform(w, lambda x, i: F.when(
        F.exists("spans", lambda s: (i + 1 >= s["first"]) & (i + 1 <= s["last"])), F.lit("")).otherwise(x)))[0]
    rebuilt = F.array_join(F.flatten(F.zip_with(pieces, kept, lambda p, w: F.array(p, F.coalesce(w, F.lit(""))))), "")
    return joined.select(F.col(id_col), F.when(F.size("spans") > 0, rebuilt).otherwise(F.col(text_col)).alias(text_col))
