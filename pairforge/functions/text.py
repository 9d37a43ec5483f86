"""Text functions as column expressions.  Nulls become empty strings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairforge import dims

#: What a word consists of, as opposed to spaces and punctuation (letters and numbers of any script).
NOT_WORD = r"[^\p{L}\p{N}_\s\p{Z}]"
SPACES = r"[\s\p{Z}]+"


def _empty(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def collapse(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, SPACES, " "))


def preprocess(c: Column) -> Column:
    """Lower case, punctuation to spaces, spaces collapsed."""
    return collapse(F.regexp_replace(F.lower(_empty(c)), NOT_WORD, " "))


def preprocess_g0(c: Column) -> Column:
    """As :func:`preprocess`, but punctuation is removed, which joins the parts of a word."""
    return collapse(F.regexp_replace(F.lower(_empty(c)), NOT_WORD, ""))


def safe_str(c: Column) -> Column:
    return F.trim(_empty(c))


def canonical_name(c: Column) -> Column:
    """The key of an entity name: ``&`` is ``and``, trailing legal forms are dropped."""
    suffixes = "|".join(dims.LEGAL_SUFFIXES)
    bare = preprocess(F.replace(F.lower(_empty(c)), F.lit("&"), F.lit(" and ")))
    return F.trim(F.regexp_replace(bare, rf"(^|\s)({suffixes})(\s+({suffixes}))*$", ""))


#: What stands between tokens.
_BETWEEN = r"[^\p{L}\p{N}_]+"


def static_tokens(c: Column, generic: list[str] | None = None) -> Column:
    """The different words of more than two characters that are not numbers, stop or generic words.  One
    split does what :func:`preprocess` and a split at blanks would do; words are tested once each."""
    drop = F.array(*[F.lit(w) for w in [*dims.STOPWORDS, *(generic if generic is not None else dims.GENERIC_TERMS)]])
    words = F.array_except(F.split(F.lower(_empty(c)), _BETWEEN), drop)
    return F.filter(words, lambda t: (F.length(t) > 2) & ~t.rlike(r"^\p{Nd}+$"))


def without_common(tokens: Column, common: Column) -> Column:
    """Tokens that are not common in the corpus; ``common`` is an array column (null: none)."""
    return F.array_except(tokens, F.coalesce(common, F.array().cast("array<string>")))


def focus_company(c: Column) -> Column:
    """Without phrases on founding, listing and headquarters."""
    return collapse(F.regexp_replace(_empty(c), "(?i)" + "|".join(dims.JUNK_PHRASES), " "))


def focus_opportunity(c: Column) -> Column:
    """Without prices, amounts and geography."""
    return collapse(F.regexp_replace(F.regexp_replace(_empty(c), "(?i)" + dims.PRICE_NUMBER, " "), "(?i)" + dims.GEOGRAPHY, " "))


def canonical_sector(c: Column) -> Column:
    return F.trim(F.replace(preprocess(c), F.lit(" and "), F.lit(" ")))


def quote_in_text(quote: Column, text: Column, least_words: int = 4) -> Column:
    q = preprocess(quote)
    return (F.size(F.split(q, " ")) >= least_words) & F.contains(preprocess(text), q)


def normalize_terminology(c: Column) -> Column:
    out = _empty(c)
    for pattern, name in dims.GLOSSARY:
        out = F.regexp_replace(out, pattern, name)
    return out


def normalize_localization(value: Column, decision: Column) -> Column:
    v = F.lower(F.trim(_empty(value)))
    out = None
    for item in dims.LOCALIZATION_MENU:
        low = F.lit(item.lower())
        hit = F.contains(v, low) | ((v != "") & F.contains(low, v))
        out = F.when(hit, item) if out is None else out.when(hit, item)
    positive = F.coalesce(decision, F.lit("")).isin("Excellent Match", "Strong Match", "Good Match")
    return out.when(F.contains(v, F.lit("not recommend")), "Not recommended").when(positive, "Supplier localization").otherwise("Not recommended")


def parse_fit(c: Column) -> Column:
    s = F.lower(F.trim(_empty(c)))
    return F.when(s.startswith("direct") | (s == "yes"), "Direct").when(s.startswith("partial") | s.startswith("supplier") | s.startswith("partner"), "Partial").otherwise("No")


def normalize_email(c: Column) -> Column:
    e = F.lower(F.btrim(F.trim(_empty(c)), F.lit(".,;:()[]<>\"'")))
    return F.when(e.rlike(f"^{dims.EMAIL}$"), e).otherwise("")


def first_email(c: Column) -> Column:
    return normalize_email(F.regexp_extract(_empty(c), f"({dims.EMAIL})", 1))


def normalize_key(c: Column) -> Column:
    return collapse(F.regexp_replace(F.translate(F.lower(F.trim(_empty(c))), "-_", "  "), r"[^a-z0-9\s]", " "))


def strip_html(c: Column) -> Column:
    return collapse(F.regexp_replace(_empty(c), "<[^>]+>", " "))


def snippets(html: Column, least: int = 24, most: int = 900, count: int = 5) -> Column:
    """Readable paragraphs of a page: short ones dropped, long ones cut, the first few kept."""
    found = F.transform(F.regexp_extract_all(_empty(html), F.lit(r"(?s)<p[^>]*>(.*?)</p>"), F.lit(1)), strip_html)
    return F.slice(F.transform(F.filter(found, lambda s: F.length(s) >= least), lambda s: F.substring(s, 1, most)), 1, count)


def clip_evidence(c: Column, most: int = 200) -> Column:
    s = safe_str(c)
    return F.when(F.length(s) <= most, s).otherwise(F.concat(F.substring(s, 1, most - 1), F.lit("…")))


def drop_control(c: Column) -> Column:
    """Without the control characters that a workbook can't hold."""
    return F.regexp_replace(_empty(c), r"[\x00-\x08\x0B\x0C\x0E-\x1F]", "")


def report_clean(c: Column) -> Column:
    s = F.translate(_empty(c), "—–", "--")
    return F.when(s == "nan", "").otherwise(collapse(s))


def sector_label(c: Column) -> Column:
    """A taxonomy node for a raw sector label: by synonym, else the node itself, else empty."""
    key = collapse(F.lower(F.trim(_empty(c))))
    synonyms = F.create_map(*[F.lit(x) for kv in dims.SECTOR_SYNONYMS.items() for x in kv])
    nodes = sorted({*dims.TAXONOMY, *(leaf for leaves in dims.TAXONOMY.values() for leaf in leaves)})
    return F.coalesce(F.try_element_at(synonyms, key), F.when(key.isin(nodes), key), F.lit(""))


def labelled(pairs: list[tuple[str, Column]]) -> Column:
    """``label: value`` lines of the non-empty values."""
    return F.concat_ws("\n", *[F.when(safe_str(v) != "", F.concat(F.lit(f"{k}: "), safe_str(v))) for k, v in pairs])


def row_context(df: DataFrame, preferred: list[str]) -> Column:
    """The preferred columns of a row (found whatever their case) as labelled lines; all columns where
    none of these is filled."""
    by_name = {c.strip().lower(): c for c in df.columns}
    first = labelled([(p, F.col(f"`{by_name[p.lower()]}`").cast("string")) for p in preferred if p.lower() in by_name])
    return F.when(first != "", first).otherwise(labelled([(c, F.col(f"`{c}`").cast("string")) for c in df.columns]))
