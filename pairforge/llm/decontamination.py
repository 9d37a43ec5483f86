"""Benchmark decontamination with a distributed positional inverted index, in native expressions.

Test items are cut into windows of ``size`` words (an item of fewer words, but not none, is one
window).  The document frequency of every test term over all documents decides which terms of
a window are its rarest.  The index stores a posting (term, doc_id, position) for each training token
whose term is the rarest or second rarest of some window.  For a window, the list of its rarest
term and, offset-adjusted, the list of the second rarest are intersected; what is left are
places where the window may start.  Each is compared with the words of the document: an equal run is
an exact phrase match, and a place where the two rarest terms lie within ``slop`` words of their
distance in the window is a proximity match.

Words are runs of a-z, 0-9 and non-ASCII characters, A-Z lower-cased.  Null texts have none.
Defined cases: items with a null id or without words never occur; a row's postings are kept under a
hash of its id and text, so rows that share a doc_id, or whose doc_id is null, are judged each by its own
text, and repeated rows alike; items that repeat one text all count; where several places of a window
lie within the slop, all are reported.  A very long text is one row whose words are one array; its postings
are rows; an empty table of documents gives no row, one of items no hit.  Columns of the documents pass through, except for those named like a result of :func:`match`.

The index is a stage table.  Test terms and windows are broadcast only below a counted number of
rows; beyond it both sides are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairforge.llm.common import broadcast_if_small, stage

SIZE = 10
SLOP = 2
#: Most rows of a side that is broadcast: about 20 MB of terms.
BROADCAST_ROWS = 200_000


def words(text: Column) -> Column:
    lowered = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.array_remove(F.split(lowered, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")


def windows(items: DataFrame, size: int = SIZE) -> DataFrame:
    """(phrase: array of words, item_ids): the different windows of all items."""
    w = items.filter("item_id IS NOT NULL").select("item_id", words(F.col("text")).alias("ws")).filter("size(ws) > 0")
    at = w.select("item_id", "ws", F.explode(F.sequence(F.lit(1), F.greatest(F.size("ws") - size + 1, F.lit(1)))).alias("p"))
    return at.select("item_id", F.slice("ws", F.col("p"), size).alias("phrase")).groupBy("phrase").agg(F.collect_set("item_id").alias("item_ids"))


#: Working columns carry this prefix, so that they never meet a column of the documents.
_P = "_decontamination_"


def _key(docs: DataFrame) -> Column:
    """What tells texts apart in the index: a hash of the row's id and text."""
    return F.xxhash64(docs["doc_id"], F.coalesce(docs["text"], F.lit("")))


def _tokens(docs: DataFrame) -> DataFrame:
    """(key, pos, term) of every word."""
    return docs.select(_key(docs).alias("key"), F.posexplode(words(F.col("text"))).alias("pos", "term"))


def rarest_terms(phrases: DataFrame, tokens: DataFrame, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """(phrase_id, phrase, t1, o1, t2, o2): each phrase's two rarest terms by the number of tokens
    in all documents, with their offsets; t2 and o2 are null in one-word phrases.  A
    stage table."""
    terms = stage(phrases.select(F.explode("phrase").alias("term")).distinct(), "terms")
    df = tokens.select("term").join(broadcast_if_small(terms, broadcast_rows), "term").groupBy("term").agg(F.count("*").alias("df"))
    at = phrases.select("phrase_id", F.posexplode("phrase").alias("o", "term"))
    ranked = at.join(df, "term", "left").groupBy("phrase_id").agg(F.sort_array(F.collect_list(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "o", "term"))).alias("r"))
    # the second term is the rarest that differs from the first; else another place of the same
    first = F.col("r")[0]
    others = F.filter("r", lambda x: x["term"] != first["term"])
    second = F.when(F.size(others) > 0, others[0]).otherwise(F.get(F.col("r"), F.lit(1)))
    picked = ranked.filter(first["df"] > 0).select("phrase_id", first["term"].alias("t1"), first["o"].alias("o1"), second["term"].alias("t2"), second["o"].alias("o2"))
    return stage(picked.join(phrases, "phrase_id"), "picked")


def postings(tokens: DataFrame, picked: DataFrame, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """The index: (term, key, pos) for the terms that some phrase is looked up by.  Repeated rows share
    their postings."""
    wanted = stage(picked.select(F.explode(F.array("t1", "t2")).alias("term")).filter("term IS NOT NULL").distinct(), "wanted")
    return stage(tokens.join(broadcast_if_small(wanted, broadcast_rows), "term").select("term", "key", "pos"), "postings")


def candidates(index: DataFrame, picked: DataFrame, slop: int = SLOP, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """(key, phrase_id, phrase, item_ids, start, gap): places where the two rarest terms of a phrase lie as
    far from each other as in the phrase, up to ``slop`` words (``gap``)."""
    p = broadcast_if_small(picked, broadcast_rows)
    first = index.join(p, index["term"] == p["t1"]).select("key", "phrase_id", "t2", (F.col("pos") - F.col("o1")).alias("start"), (F.col("pos") - F.col("o1") + F.col("o2")).alias("due"))
    alone = first.filter("t2 IS NULL").select("key", "phrase_id", "start", F.lit(0).alias("gap"))
    # offset-adjusted intersection: the second list is met at the place where it is due, or near it
    near = first.filter("t2 IS NOT NULL").withColumn("near", F.explode(F.array(*[F.lit(g) for g in range(-slop, slop + 1)])))
    near = near.withColumn("want", F.col("due") + F.col("near"))
    second = index.select(F.col("term").alias("t"), F.col("key").alias("d"), F.col("pos").alias("q"))
    met = near.join(second, (near["t2"] == second["t"]) & (near["key"] == second["d"]) & (near["want"] == second["q"]))
    both = met.groupBy("key", "phrase_id", "start").agg(F.min(F.abs("near")).alias("gap"))
    places = both.select("key", "phrase_id", "start", "gap").union(alone)  # phrases travel by their id
    return places.join(p.select("phrase_id", "phrase", "item_ids"), "phrase_id").select("key", "phrase_id", "phrase", "item_ids", "start", "gap")


def _covered(spans: Column) -> Column:
    """How many places the spans (b, e), sorted by b, cover."""
    start = F.struct(F.lit(0).alias("n"), F.lit(-1).alias("to"))
    step = lambda acc, s: F.struct((acc["n"] + F.greatest(s["e"] - F.greatest(s["b"], acc["to"]), F.lit(0))).alias("n"), F.greatest(s["e"], acc["to"]).alias("to"))
    return F.aggregate(F.sort_array(spans), start, step)["n"]


RESULTS = ("n_words", "phrases", "near", "n_hit", "items")


def match(documents: DataFrame, items: DataFrame, size: int = SIZE, slop: int = SLOP, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Every document (all its columns) with ``n_words``, ``phrases`` (exact matches: start, length,
    item_ids), ``near`` (proximity matches that are no exact ones: start, gap, item_ids), ``n_hit`` and
    ``items``."""
    docs = documents.drop(*RESULTS)
    tokens = _tokens(docs)
    phrases = stage(windows(items, size).withColumn("phrase_id", F.xxhash64("phrase")), "phrases")
    picked = rarest_terms(phrases, tokens, broadcast_rows)
    # rows with one key have one text: their postings are the same, and one of each place is enough
    found = candidates(postings(tokens, picked, broadcast_rows), picked, slop, broadcast_rows)
    by_doc = found.groupBy("key").agg(F.collect_set(F.struct("start", "gap", "phrase", "item_ids")).alias(f"{_P}found"))
    by_doc = stage(by_doc.withColumnRenamed("key", f"{_P}key"), "found")
    at = docs.join(by_doc, _key(docs) == by_doc[f"{_P}key"], "left").drop(f"{_P}key").withColumn(f"{_P}ws", words(F.col("text")))
    every, ws = F.coalesce(f"{_P}found", F.expr("array()")), F.col(f"{_P}ws")
    same = lambda f: (f["gap"] == 0) & (f["start"] >= 0) & (F.slice(ws, F.greatest(f["start"], F.lit(0)) + 1, F.size(f["phrase"])) == f["phrase"])
    at = at.withColumns({"n_words": F.size(ws).cast("long"), f"{_P}exact": F.filter(every, same), f"{_P}near": F.filter(every, lambda f: ~same(f))})
    exact = F.col(f"{_P}exact")
    spans = F.transform(exact, lambda f: F.struct(f["start"].alias("b"), (f["start"] + F.size(f["phrase"])).alias("e")))
    out = at.withColumns(
        {
            "phrases": F.transform(exact, lambda f: F.struct(f["start"].alias("start"), F.size(f["phrase"]).alias("length"), f["item_ids"].alias("item_ids"))),
            "near": F.transform(f"{_P}near", lambda f: F.struct(f["start"].alias("start"), f["gap"].alias("gap"), f["item_ids"].alias("item_ids"))),
            "n_hit": _covered(spans).cast("long"),
            "items": F.array_distinct(F.flatten(F.transform(exact, lambda f: f["item_ids"]))),
        }
    )
    return out.drop(f"{_P}found", f"{_P}ws", f"{_P}exact", f"{_P}near")
