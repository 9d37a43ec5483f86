"""Phrase matching with stems, closed-vocabulary labels, ontology overlap, e-mail enrichment."""

from __future__ import annotations

import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pairforge import dims
from pairforge.functions.text import canonical_sector, first_email, normalize_key
from pairforge.operators import containment as C

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # the stemmer runs on workers without this package


def porter_stem(word: str) -> str:
    """The Porter stem of a lower-case word (M. F. Porter, 1980; public description)."""
    vowels = "aeiou"

    def consonant(w: str, i: int) -> bool:
        return w[i] not in vowels and not (w[i] == "y" and i > 0 and consonant(w, i - 1))

    def measure(w: str) -> int:
        kinds = [consonant(w, i) for i in range(len(w))]
        return sum(not a and b for a, b in zip(kinds, kinds[1:], strict=False))

    def has_vowel(w: str) -> bool:
        return any(not consonant(w, i) for i in range(len(w)))

    def double(w: str) -> bool:
        return len(w) > 1 and w[-1] == w[-2] and consonant(w, len(w) - 1)

    def short(w: str) -> bool:
        n = len(w)
        return n > 2 and consonant(w, n - 3) and not consonant(w, n - 2) and consonant(w, n - 1) and w[-1] not in "wxy"

    w = word
    if len(w) <= 2:
        return w
    for end, to in (("sses", "ss"), ("ies", "i"), ("ss", "ss"), ("s", "")):
        if w.endswith(end):
            w = w[: len(w) - len(end)] + to
            break
    again = False
    if w.endswith("eed"):
        if measure(w[:-3]) > 0:
            w = w[:-1]
    elif w.endswith("ed") and has_vowel(w[:-2]):
        w, again = w[:-2], True
    elif w.endswith("ing") and has_vowel(w[:-3]):
        w, again = w[:-3], True
    if again:
        if w.endswith(("at", "bl", "iz")):
            w += "e"
        elif double(w) and w[-1] not in "lsz":
            w = w[:-1]
        elif measure(w) == 1 and short(w):
            w += "e"
    if w.endswith("y") and has_vowel(w[:-1]):
        w = w[:-1] + "i"
    second = "ational>ate tional>tion enci>ence anci>ance izer>ize abli>able alli>al entli>ent eli>e ousli>ous ization>ize ation>ate ator>ate alism>al iveness>ive fulness>ful ousness>ous aliti>al iviti>ive biliti>ble"
    third = "icate>ic ative> alize>al iciti>ic ical>ic ful> ness>"
    for rules in (second, third):
        for end, to in (r.split(">") for r in rules.split(" ")):
            if w.endswith(end):
                if measure(w[: len(w) - len(end)]) > 0:
                    w = w[: len(w) - len(end)] + to
                break
    for end in "ement ance ence able ible ment ant ent ism ate iti ous ive ize ion al er ic ou".split():
        if w.endswith(end):
            stem = w[: len(w) - len(end)]
            if measure(stem) > 1 and (end != "ion" or stem[-1:] in "st"):
                w = stem
            break
    if w.endswith("e"):
        m = measure(w[:-1])
        if m > 1 or (m == 1 and not short(w[:-1])):
            w = w[:-1]
    return w[:-1] if w.endswith("ll") and measure(w) > 1 else w


def stems(words: Column) -> Column:
    """The stem of each word of an array, by a vectorised function: Spark has no stemmer."""
    @F.pandas_udf("array<string>")
    def run(column: pd.Series) -> pd.Series:
        known: dict[str, str] = {}

        def one(ws):
            return [known.get(w) or known.setdefault(w, porter_stem(w)) for w in ws] if ws is not None else None

        return column.map(one)

    return run(words)


def content_words(text: Column) -> Column:
    found = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"([a-zA-Z][a-zA-Z0-9\-]{1,})"), F.lit(1))
    return F.array_distinct(F.filter(found, lambda w: F.length(w) > 2))


def keyword_hits(pairs: DataFrame, phrases: str, corpus: str, name: str = "hits", stemmed: bool = True) -> DataFrame:
    """How many phrases stand in the corpus text, or have all their stems among its stems (without
    stemming: all their words as substrings)."""
    low = F.lower(F.coalesce(F.col(corpus), F.lit("")))
    p = pairs.withColumn("_ph", F.filter(F.transform(F.col(phrases), F.trim), lambda x: F.length(x) >= 2)).withColumn("_low", low)
    words = F.transform("_ph", content_words)
    if not stemmed:
        return p.withColumn("_w", words).withColumn(name, F.size(F.filter(F.arrays_zip("_ph", "_w"), lambda x: F.contains(F.col("_low"), F.lower(x["_ph"])) | ((F.size(x["_w"]) > 0) & F.forall(x["_w"], lambda t: F.contains(F.col("_low"), t)))))).drop("_ph", "_low", "_w")
    # the words of all phrases are stemmed as one array, in order, and looked up again by the word
    p = p.withColumn("_w", words).withColumn("_all", F.array_distinct(F.flatten("_w")))
    p = p.withColumns({"_cs": stems(content_words(F.col(corpus))), "_st": F.map_from_arrays("_all", stems(F.col("_all")))})
    whole = lambda ws: (F.size(ws) > 0) & F.forall(ws, lambda w: F.array_contains(F.col("_cs"), F.col("_st")[w]))
    hits = F.filter(F.arrays_zip("_ph", "_w"), lambda x: F.contains(F.col("_low"), F.lower(x["_ph"])) | whole(x["_w"]))
    return p.withColumn(name, F.coalesce(F.size(hits), F.lit(0))).drop("_ph", "_low", "_w", "_all", "_cs", "_st")


def adjacent_label(raw: DataFrame, allowed: DataFrame) -> DataFrame:
    """(id, raw, resolved): a phrase as a label of the closed vocabulary ``allowed`` (label): equal, equal
    but for case if unique, by alias, or a unique substring either way from six characters on.  Each different phrase is resolved once."""
    aliases = F.create_map(*[F.lit(x) for kv in dims.ADJACENT_ALIASES.items() for x in kv])
    asked = raw.select("id", "raw").distinct()
    r = asked.select("raw", F.trim("raw").alias("s")).filter("s <> ''").distinct().withColumn("low", F.lower("s")).withColumn("alias", F.try_element_at(aliases, F.col("low")))
    labels = allowed.select("label").distinct()
    # labels that differ in case only are one text with several labels
    texts = allowed.filter("label <> ''").groupBy(F.lower("label").alias("text")).agg(F.count("*").alias("n"), F.max("label").alias("top"))
    close = C.either_way(r.filter(F.length("low") >= 6), "low", texts, "text").join(texts, "text")
    close = close.groupBy("low").agg(F.sum("n").alias("_ns"), F.max("top").alias("_u"))
    found = r.join(labels.withColumn("_e", F.col("label")).withColumnRenamed("label", "s"), "s", "left").join(texts.withColumnRenamed("text", "low"), "low", "left")
    found = found.join(labels.withColumn("_a", F.col("label")).withColumnRenamed("label", "alias"), "alias", "left").join(close, "low", "left")
    named = found.select("raw", F.coalesce("_e", F.when(F.col("n") == 1, F.col("top")), "_a", F.when(F.col("_ns") == 1, F.col("_u"))).alias("resolved"))
    return asked.join(named, "raw", "left").select("id", "raw", "resolved")


def ontology_bag(sector: Column, entry: Column) -> Column:
    """Canonical forms of a sector, its canonical name, synonyms, sub-domains and neighbours; ``entry``
    is a struct of these (null: the sector alone)."""
    none = F.array().cast("array<string>")
    words = F.concat(F.array(sector, F.coalesce(entry["canonical"], sector)), F.coalesce(entry["synonyms"], none), F.coalesce(entry["sub_domains"], none), F.coalesce(entry["adjacent_domains"], none))
    return F.filter(F.array_distinct(F.transform(words, canonical_sector)), lambda x: x != "")


def ontology_overlap(left: DataFrame, right: DataFrame) -> DataFrame:
    """Pairs (cid, oid) whose bags share a term: a semi-join on exploded terms."""
    a, b = left.select("cid", F.explode("bag").alias("t")), right.select("oid", F.explode("bag").alias("t"))
    return a.join(b, "t").select("cid", "oid").distinct()


def email_from_rows(targets: DataFrame, sources: DataFrame, key: str, context: str) -> DataFrame:
    """Targets (id, name, context) with an e-mail: from their own context, else the n-th source row of
    their name for the n-th target of that name that still has none."""
    own = targets.withColumn("_own", first_email(F.col(context))).withColumn("_key", normalize_key(F.col(key)))
    empty = own.filter("_own = ''").withColumn("_n", F.row_number().over(W.partitionBy("_key").orderBy("id")))
    s = sources.withColumn("_key", normalize_key(F.col(key))).filter("email <> ''").withColumn("_n", F.row_number().over(W.partitionBy("_key").orderBy("sid"))).select("_key", "_n", F.col("email").alias("_mail"))
    filled = empty.join(s, ["_key", "_n"], "left").select("id", F.coalesce("_mail", F.lit("")).alias("email"), F.when(F.col("_mail").isNotNull(), "name").otherwise("none").alias("found"))
    return own.filter("_own <> ''").select("id", F.col("_own").alias("email"), F.lit("row").alias("found")).union(filled)
