"""Benchmark decontamination by a prefix-filtered join, in DataFrame operations.

Texts and items are lower-cased (A-Z) and cut into words
``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``. A window is ``window`` consecutive words
of an item; an item of fewer words, but not none, is one window. A document
contains a window if the window's words stand in it one after another.

1. Tokens of the join are shingles of ``shingle`` words (of all words where a
   window has fewer). A document offers its shingle at every position; those
   that no window has end there, the others are written as spots.
2. Rarity: a shingle's count over all documents. Containment is complete, so
   of a window's shingles ordered by rarity the necessary prefix is the first,
   and a window with a shingle that no document has is dropped at once.
3. Length and position: where the rarest shingle was found, the window must
   fit into the document.
4. Candidates are verified exactly: every shingle of the window must stand at
   its place. Shingles are compared as text, so their words are, one by one;
   the documents are not read again.

Rows are told apart by a hash of the text, so equal texts are searched like
one and results go back to every copy; ids play no part in the join.

Defined cases: null and empty texts have no words; items without words are
not windows; an item with a null id marks words as hit but is not listed;
equal ids or rows among documents are judged one by one; repeated items count
once; shingles that are equally rare are ordered by their text; texts of any
length are read whole; empty tables give rows without hits, or no rows. Input
columns that clash with a made one are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardstar.session import materialize

from .common import ascii_lower, others, quoted

# Fixed value of the contract: what separates words once A-Z are a-z.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
MADE = ["n_words", "n_hit", "n_items", "items_sha256", "contaminated"]


def words(text: Column) -> Column:
    """The word list of a text; null is an empty text."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), SEPARATORS), "")


def item_windows(items: DataFrame, window: int, id_col: str, text_col: str) -> DataFrame:
    """(item_id, words): the distinct windows of each item."""
    src = items.select(F.col(quoted(id_col)).cast("string").alias("item_id"),
                       words(F.col(quoted(text_col))).alias("w")).where(F.size("w") > 0)
    first = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("w") - (window - 1)))
    return src.select("item_id", "w", F.explode(first).alias("i")) \
        .select("item_id", F.slice("w", F.col("i"), F.lit(window)).alias("words")).distinct()


def _shingle(k: int) -> Column:
    """The ``k`` words of array ``w`` from 0-based position ``p``. Words hold no
    blank, so different word lists never give one text."""
    return F.concat_ws(" ", *[F.get("w", F.col("p") + i) for i in range(k)])


def _offered(length: Column, sizes: list[int]) -> Column:
    """The shingles that start at position ``p``; null where none fits."""
    one = [F.when(F.col("p") + k <= length, _shingle(k)) for k in sizes]
    return one[0] if len(one) == 1 else F.explode(F.array(*one))


def find_windows(docs: DataFrame, windows: DataFrame, shingle: int = 3) -> DataFrame:
    """(text_key, start, length, item_id): every occurrence of a window.

    ``docs`` has text_key and text, ``windows`` the columns of
    :func:`item_windows`.
    """
    parts = materialize(windows.groupBy("words").agg(F.collect_set("item_id").alias("items"))
                        .withColumn("length", F.size("words"))
                        .withColumn("k", F.least(F.lit(shingle), F.size("words")))
                        .withColumn("window", F.array_join("words", " ")), "benchmark-windows")
    sizes = [r.k for r in parts.select("k").distinct().orderBy("k").collect()] or [shingle]  # 1 to shingle
    places = parts.select("window", "length", "k", F.col("words").alias("w"),
                          F.explode(F.sequence(F.lit(0), F.col("length") - F.col("k"))).alias("p"))
    of_window = materialize(places.select("window", "length", F.col("p").alias("o"), F.coalesce(*[
        F.when(F.col("k") == k, _shingle(k)) for k in sizes]).alias("shingle")), "benchmark-shingles")

    # where documents have a shingle of the benchmark. The outer form keeps Spark
    # from adding a filter on the word list, which would cut every text twice.
    listed = docs.select("text_key", words(F.col("text")).alias("w"))
    at = listed.select("text_key", F.size("w").alias("n_words"), "w",
                       F.posexplode_outer("w").alias("p", "_w"))
    offered = at.select("text_key", "n_words", "p", _offered(F.col("n_words"), sizes).alias("shingle")) \
        .where(F.col("shingle").isNotNull())
    known = materialize(of_window.select("shingle").distinct(), "benchmark-known")
    spots = materialize(offered.join(known, "shingle"), "benchmark-spots")

    # the prefix: of each window the rarest shingle
    counts = spots.groupBy("shingle").agg(F.count(F.lit(1)).alias("n"))
    prefix = of_window.join(counts, "shingle", "left").groupBy("window", "length").agg(
        F.min(F.struct("n", "o", "shingle")).alias("r"), F.count(F.lit(1)).alias("n_shingles")) \
        .where(F.col("r.n").isNotNull()) \
        .select("window", "length", "n_shingles", F.col("r.o").alias("o"), F.col("r.shingle").alias("shingle"))
    start = F.col("p") - F.col("o")
    candidates = spots.join(prefix, "shingle") \
        .where((start >= 0) & (start + F.col("length") <= F.col("n_words"))) \
        .select("text_key", start.alias("start"), "window", "n_shingles").distinct()

    # verification: each shingle of the candidate's window at its place
    wanted = candidates.join(of_window, "window").select(
        "text_key", "start", "window", "length", "n_shingles", (F.col("start") + F.col("o")).alias("p"), "shingle")
    there = spots.select("text_key", "p", "shingle").distinct()
    whole = wanted.join(there, ["text_key", "p", "shingle"]).groupBy("text_key", "start", "window", "length") \
        .agg((F.count(F.lit(1)) == F.max("n_shingles")).alias("whole")).where("whole")
    return whole.join(parts.select("window", "items"), "window").select(
        "text_key", "start", "length", F.explode_outer("items").alias("item_id"))


def _text_key(text: Column) -> Column:
    """128 bits of the text's SHA-256."""
    return F.substring(F.unhex(F.sha2(text.cast("binary"), 256)), 1, 16)


def contamination(docs: DataFrame, items: DataFrame, window: int = 10, shingle: int = 3,
                  text_col: str = "text", item_id_col: str = "item_id",
                  item_text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Input columns with n_words, n_hit (words inside an occurrence of a
    window), n_items, items_sha256 and contaminated."""
    text = F.coalesce(F.col(quoted(text_col)).cast("string"), F.lit(""))
    keyed = docs.select(_text_key(text).alias("text_key"), text.alias("text"))
    hits = materialize(find_windows(keyed, item_windows(items, window, item_id_col, item_text_col),
                                    shingle), "benchmark-hits")

    # words covered: occurrences in order of their start, overlaps counted once
    runs = hits.groupBy("text_key", "start").agg(
        (F.col("start") + F.max("length")).alias("end"))
    before = F.max("end").over(Window.partitionBy("text_key").orderBy("start")
                               .rowsBetween(Window.unboundedPreceding, -1))
    new = F.col("end") - F.greatest("start", F.least("end", F.coalesce(before, F.lit(0))))
    hit = runs.select("text_key", new.alias("new")).groupBy("text_key").agg(F.sum("new").alias("n_hit"))
    named = hits.groupBy("text_key").agg(F.array_sort(F.collect_set("item_id")).alias("ids"))
    by_text = hit.join(named, "text_key").select(
        "text_key", "n_hit", F.size("ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("ids", ","), 256).alias("items_sha256"))

    passed = others(docs, MADE) if keep is None else keep
    key = "__text_key"
    src = docs.select(*[F.col(quoted(c)) for c in passed], _text_key(text).alias(key),
                      F.size(words(F.col(quoted(text_col)).cast("string"))).cast("long").alias("n_words"))
    return src.join(by_text, F.col(key) == F.col("text_key"), "left").select(
        *[F.col(quoted(c)) for c in passed], "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
        F.col("n_hit").isNotNull().alias("contaminated"))


def remove_contaminated(docs: DataFrame, items: DataFrame, window: int = 10, shingle: int = 3,
                        text_col: str = "text", item_id_col: str = "item_id",
                        item_text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns as they are, without an occurrence of
    a window."""
    text = F.coalesce(F.col(quoted(text_col)).cast("string"), F.lit(""))
    keyed = docs.select(_text_key(text).alias("text_key"), text.alias("text"))
    hits = materialize(find_windows(keyed, item_windows(items, window, item_id_col, item_text_col), shingle)
                       .select(F.col("text_key").alias("__text_key")).distinct(), "benchmark-hits")
    return docs.join(hits, _text_key(text) == F.col("__text_key"), "left_anti")
