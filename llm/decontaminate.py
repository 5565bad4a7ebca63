"""Benchmark decontamination over a positional inverted index.

The index stores a posting (document, position, term) for each training word that occurs in any test item. A test phrase starts from its
rarest terms, by their counts in the index: their lists, each shifted by the term's offset in the phrase, are intersected, and the
starts that all of them give are compared with the document's words. ``near`` finds all terms of a query within a stretch of words the same way, without the order.

Only SQL functions are used. Hits are found once for each id and text (a 128-bit digest of both) and given to every row that holds them; rows that
share an id but not the text are documents of their own.

Defined cases: a null or empty text has no words and no hits; an item without words has no windows; null ids stay; equal windows of
several items count for each of them; an empty table gives no rows, an empty benchmark no hits; other columns are ignored.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from llm.common import LOWER, UPPER, small, stored

WINDOW = 13
#: Lists that are intersected before the words are compared.
RAREST = 3


def words_of(text: Column) -> Column:
    """A-Z lower-cased; stretches of digits, a-z and everything beyond ASCII."""
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")


def document_key(id_col: Column, text: Column) -> Column:
    """128 bits that tell documents apart by id and text, nulls included."""
    part = lambda c: F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("-"))
    return F.unhex(F.md5(F.concat(part(id_col), F.lit("\0"), part(text))))


def build_index(docs: DataFrame, terms: DataFrame | None, id_col: str, text_col: str) -> DataFrame:
    """Postings (key, pos, term) of the words in ``terms``, or of all words for None: such an index serves any test set. Each row also has an entry
    with its id and n_words, at position 0 or null."""
    text = F.col(text_col)
    words = docs.select(F.col(id_col).alias("id"), document_key(F.col(id_col), text).alias("key"), words_of(text).alias("words"))
    every = words.select("id", "key", F.size("words").cast("long").alias("n_words"), F.posexplode_outer("words").alias("pos", "word"))
    if terms is None:
        known = every.withColumn("term", F.when(F.col("word").isNotNull(), F.xxhash64("word")))
    else:
        known = every.join(small(terms, "octet_length(word) + 32"), "word", "left").filter("term IS NOT NULL OR coalesce(pos, 0) = 0")
    head = F.coalesce("pos", F.lit(0)) == 0
    return stored(known.select("key", "pos", "term", F.when(head, F.col("id")).alias("id"), F.when(head, F.col("n_words")).alias("n_words")), "index")


def phrase_windows(items: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """Distinct windows: win, words, items (the ids, as strings, of the items that hold it)."""
    w = F.col("words")
    start = F.sequence(F.lit(1), F.greatest(F.size(w) - size + 1, F.lit(1)))
    return (items.select(F.col(id_col).cast("string").alias("item"), words_of(F.col(text_col)).alias("words")).filter(F.size(w) > 0)
            .select("item", F.explode(F.transform(start, lambda k: F.slice(w, k, size))).alias("words"))
            .groupBy("words").agg(F.collect_set("item").alias("items")).withColumn("win", F.xxhash64("words")))


def vocabulary(windows: DataFrame) -> DataFrame:
    return windows.select(F.explode("words").alias("word")).distinct().withColumn("term", F.xxhash64("word"))


def rarest_terms(index: DataFrame, windows: DataFrame, at_most: int) -> DataFrame:
    """(win, off, term, lists): the rarest terms of each window whose terms all occur; lists: how many were taken."""
    df = index.filter("term IS NOT NULL").groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    terms = windows.select("win", F.posexplode("words").alias("off", "word")).withColumn("term", F.xxhash64("word")).join(df, "term", "left")
    by = Window.partitionBy("win")
    return (terms.withColumn("all", F.min(F.col("df").isNotNull()).over(by)).filter("all")
            .withColumn("r", F.row_number().over(by.orderBy("df", "off"))).filter(F.col("r") <= at_most)
            .withColumn("lists", F.count(F.lit(1)).over(by)).select("win", "off", "term", "lists"))


def phrase_starts(index: DataFrame, windows: DataFrame, at_most: int = RAREST) -> DataFrame:
    """(key, win, start) where the shifted lists of the rarest terms meet."""
    pivots = stored(rarest_terms(index, windows, at_most), "index-pivots")
    shifted = (index.filter("term IS NOT NULL").select("key", "pos", "term").join(small(pivots, "40"), "term")
               .select("key", "win", (F.col("pos") - F.col("off")).alias("start"), "off", "lists").filter("start >= 0"))
    # offsets of one window differ, so a bit for each counts the different lists
    met = shifted.groupBy("key", "win", "start").agg(F.bit_or(F.expr("shiftleft(1L, off % 63)")).alias("bits"), F.max("lists").alias("lists"))
    return met.filter(F.bit_count("bits") == F.col("lists")).select("key", "win", "start")


def phrase_hits(docs: DataFrame, index: DataFrame, windows: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(key, hits): each document's exact phrase matches as structs of start, end (exclusive) and items."""
    starts = phrase_starts(index, windows).join(small(windows, "16 * size(words) + 24 * size(items)"), "win")
    asked = starts.groupBy("key").agg(F.collect_list(F.struct("start", "words", "items")).alias("asked"))
    text = F.col(text_col)
    words = docs.select(document_key(F.col(id_col), text).alias("key"), F.translate(text, UPPER, LOWER).alias("low")).dropDuplicates(["key"])
    same = F.filter("asked", lambda a: F.slice(F.col("words"), a["start"] + 1, F.size(a["words"])) == a["words"])
    hits = F.transform(same, lambda a: F.struct(a["start"].alias("start"), (a["start"] + F.size(a["words"])).alias("end"), a["items"].alias("items")))
    return words.join(asked, "key").select("key", "asked", words_of(F.col("low")).alias("words")).select("key", hits.alias("hits")).filter(F.size("hits") > 0)


def covered(hits: Column) -> Column:
    """Positions inside any of the hits."""
    spans = F.array_sort(F.transform(hits, lambda h: F.struct(h["start"], h["end"])))
    zero = F.struct(F.lit(0).alias("to"), F.lit(0).cast("long").alias("n"))
    step = lambda s, h: F.struct(F.greatest(s["to"], h["end"]).alias("to"), (s["n"] + F.greatest(h["end"] - F.greatest(s["to"], h["start"]), F.lit(0))).alias("n"))
    return F.aggregate(spans, zero, step)["n"]


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
                  size: int = WINDOW, one_in: int = 20, index: DataFrame | None = None) -> DataFrame:
    """Per row: the id, n_words, n_hit, n_items, items_sha256, contaminated, hits, key. Contaminated: a hit, and ``one_in`` * n_hit >= n_words.
    ``index``: one of ``docs`` built before, with the words of this benchmark or all."""
    windows = stored(phrase_windows(benchmark, item_col, item_text, size), "index-windows")
    if index is None:
        index = build_index(docs, stored(vocabulary(windows), "index-terms"), id_col, text_col)
    hits = phrase_hits(docs, index, windows, id_col, text_col)
    heads = index.filter("n_words IS NOT NULL").select("key", "id", "n_words")  # one a row
    n_hit = F.coalesce(covered(F.col("hits")), F.lit(0)).cast("long")
    found = F.coalesce(F.array_sort(F.array_distinct(F.flatten(F.transform("hits", lambda h: h["items"])))), F.array().cast("array<string>"))
    out = heads.join(hits, "key", "left").select("key", "id", "n_words", n_hit.alias("n_hit"), found.alias("found"), "hits")
    return out.select(F.col("id").alias(id_col), "n_words", "n_hit", F.size("found").cast("long").alias("n_items"), F.sha2(F.array_join("found", ","), 256).alias("items_sha256"),
                      ((F.col("n_hit") > 0) & (F.col("n_hit") * one_in >= F.col("n_words"))).alias("contaminated"), "hits", "key")


def near(index: DataFrame, queries: DataFrame, slop: int) -> DataFrame:
    """Proximity matches. ``queries``: query, words. (key, query, pos): a position of the query's rarest term from which all its different
    words lie, in any order, in some stretch of at most size(words) + ``slop`` words that holds the position."""
    asked = queries.select("query", F.array_distinct("words").alias("words"), (F.size("words") + slop).alias("span")).filter(F.size("words") > 0).withColumn("win", F.xxhash64("query", "words"))
    pivot = rarest_terms(index, asked, 1).select("win", "term")
    postings = index.filter("term IS NOT NULL").select("key", "pos", "term")
    at = postings.join(pivot, "term").join(asked, "win").select("key", "win", "query", "words", "span", F.col("pos").alias("pivot"))
    wanted = at.select("*", F.explode(F.transform("words", lambda w: F.xxhash64(w))).alias("term"))
    met = (wanted.join(postings, ["key", "term"]).filter("abs(pos - pivot) < span")
           .groupBy("key", "query", "win", "pivot", "span", F.size("words").alias("n")).agg(F.collect_set(F.struct("pos", "term")).alias("ps")))
    fits = F.exists("ps", lambda s: (s["pos"] <= F.col("pivot")) & (F.col("pivot") < s["pos"] + F.col("span")) & (F.size(F.array_distinct(F.transform(
        F.filter("ps", lambda p: (p["pos"] >= s["pos"]) & (p["pos"] < s["pos"] + F.col("span"))), lambda p: p["term"]))) == F.col("n")))
    return met.filter(fits).select("key", "query", F.col("pivot").alias("pos"))
