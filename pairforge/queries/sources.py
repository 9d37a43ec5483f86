"""Readers and sinks: tables are written in a foreign layout below the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairforge import dims
from pairforge.operators import feedback as B
from pairforge.operators import ranking as R
from pairforge.operators import scoring as O
from pairforge.queries.base import PAIRS_SQL, SPACES, pairs, pick, pp, sql_pick, sql_text, t
from pairforge.queries.texts import FOUNDING, PRICES, SUFFIXES
from pairforge.sources import folders, readers, stages, workbooks

S = SparkSession
#: Header spellings as they occur in workbooks: odd spaces, odd case.
COMPANY_SHEET = {"name": "Company  Name", "profile": " company  PROFILE​", "products": "Product/Services", "sector": "SECTOR "}
OPPORTUNITY_SHEET = {"name": "What is the opportunity name?", "sector": "Sector", "text": "What is the  opportunity description?", "materials": "What materials are involved or required in the project?"}


def _company_sheet(s: S, d: str) -> DataFrame:
    """Suppliers as a workbook tab: two of five share a name but for its legal form."""
    k = F.col("s_suppkey")
    return t(s, d, "supplier").select(
        F.concat(F.lit("Firm "), F.floor(k * 3 / 5).cast("string"), pick(SUFFIXES[:1] + SUFFIXES[2:4], k)).alias(COMPANY_SHEET["name"]),
        F.concat(pick(FOUNDING, k), F.lit(" "), F.repeat(F.lit("steel "), (k % 7).cast("int"))).alias(COMPANY_SHEET["profile"]),
        F.when(k % 6 != 0, F.concat(F.lit("Pumps & valves; no. "), k.cast("string"))).alias(COMPANY_SHEET["products"]),
        pick(["Mining", "MedTech", "ICT Hardware"], k).alias(COMPANY_SHEET["sector"]),
        k.alias("id"),
    )


def company_scan(s: S, d: str) -> DataFrame:
    c = readers.companies(_company_sheet(s, d))
    return c.select("company_id", "company_name", "sector", "combined", "combined_focused", "products_clean")


def merged_names(s: S, d: str) -> DataFrame:
    c = readers.identified(readers.with_headers(_company_sheet(s, d), readers.COMPANY_HEADERS), "company", "company_id")
    return readers.merged_names(c)


def _opportunity_sheet(s: S, d: str) -> DataFrame:
    k = F.col("item_id")
    return t(s, d, "benchmark").select(
        F.concat(F.lit("Plant "), k.cast("string")).alias(OPPORTUNITY_SHEET["name"]), pick(["Mining", "MedTech"], k).alias(OPPORTUNITY_SHEET["sector"]),
        F.col("text").alias(OPPORTUNITY_SHEET["text"]), F.when(k % 3 != 0, pick(PRICES, k)).alias(OPPORTUNITY_SHEET["materials"]), F.concat(F.lit(" "), k.cast("string")).alias("opportunity_id"),
    )


def opportunity_scan(s: S, d: str) -> DataFrame:
    o = readers.opportunities(_opportunity_sheet(s, d))
    return o.select("opportunity_id", "opportunity_name", "requirement", "requirement_focused")


def sheet_union(s: S, d: str) -> DataFrame:
    """Three tabs, of which one has other columns and is left out."""
    tabs = [_company_sheet(s, d).filter("id % 2 = 0"), t(s, d, "nation"), _company_sheet(s, d).filter("id % 2 = 1").drop("id")]
    wanted = ["company_name", "company_profile", "product_services", "sector"]
    return readers.union_sheets(tabs, lambda df: readers.with_headers(df, readers.COMPANY_HEADERS, wanted)).select("company_name", "sector", "id")


def first_existing(s: S, d: str) -> DataFrame:
    """The first table of a list of candidates that is there, and its rows."""
    names = ["companies", "Data/companies", "nation", "region"]
    found = readers.first_existing(s, [f"{d}/{n}.parquet" for n in names]) or ""
    return s.read.parquet(found).agg(F.count("*").alias("n")).select(F.lit(found.rpartition("/")[2]).alias("found"), "n")


def header_names(s: S, d: str) -> DataFrame:
    """Every header of the two sheets with the column that it becomes."""
    made = [("company", h, readers.COMPANY_HEADERS.get(readers.header(h), "")) for h in COMPANY_SHEET.values()]
    made += [("opportunity", h, readers.OPPORTUNITY_HEADERS.get(readers.header(h), "")) for h in OPPORTUNITY_SHEET.values()]
    return s.createDataFrame(made, "sheet string, header string, renamed string")


def structured_lists(s: S, d: str) -> DataFrame:
    """A structured sheet in which one list column is broken for some rows and the others are missing."""
    k = F.col("item_id")
    df = t(s, d, "benchmark").select(k, F.when(k % 5 == 0, F.lit("[broken")).otherwise(F.to_json(F.array(F.lit("ore"), k.cast("string")))).alias("required_inputs"))
    assert readers.is_structured(df)
    return readers.structured_lists(df).select("item_id", *[F.array_join(c, "|").alias(c) for c in readers.STRUCTURED_LISTS])


def id_discovery(s: S, d: str) -> DataFrame:
    """Ids from a column of mixed texts, and positions where there is no such column."""
    n = t(s, d, "nation")
    k = F.col("n_nationkey")
    named = readers.identified(n.select("n_name", F.when(k % 4 == 0, F.lit("x")).otherwise(F.concat(F.lit(" "), k.cast("string"))).alias("companyId")), "company", "found_id").drop("companyId")
    placed = readers.identified(n.select("n_name"), "company", "position", [F.col("n_name")])
    return named.join(placed, "n_name")


def _log_rows(s: S, d: str) -> DataFrame:
    e = t(s, d, "events")
    return e.select(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("ts"), F.concat(F.lit("c"), "user_id").alias("company"), F.col("event_type").alias("opportunity"),
        pick(["Direct", "Partial", "No"], F.col("event_id")).alias("decision"), F.lit(0.5).alias("confidence"), F.col("event_id").cast("int").alias("votes"),
    )


def verdict_log(s: S, d: str) -> DataFrame:
    """A log appended to in two runs, read back, last entry of each pair."""
    path = stages.scratch(s, "log")
    rows = _log_rows(s, d)
    stages.append_jsonl(rows.filter("votes % 2 = 1"), path)
    stages.append_jsonl(rows.filter("votes % 2 = 0"), path)
    log = readers.read_verdicts(s, path).withColumn("o", F.struct("ts", "votes"))
    return R.latest(log, ["company", "opportunity"], "o").select("company", "opportunity", "ts", "decision", "votes")


def verdict_stream(s: S, d: str) -> DataFrame:
    """The same log read as a stream, in two files, into the table of last verdicts."""
    from pairforge.streaming import verdict_log as stream

    path, out = stages.scratch(s, "stream"), stages.scratch(s, "latest")
    rows = _log_rows(s, d)
    stages.append_jsonl(rows.filter("votes % 2 = 1"), path)
    stages.append_jsonl(rows.filter("votes % 2 = 0"), path)
    stream.keep_latest(stream.read_log(s, path), out, stages.scratch(s, "progress")).awaitTermination()
    return stream.current(s, out).select("company", "opportunity", "ts", "decision", "votes")


def review_file(s: S, d: str) -> DataFrame:
    """Reviews written as CSV, with quotes and line ends in the names, and read back; a file that isn't there gives none."""
    path = stages.scratch(s, "reviews")
    c = t(s, d, "customer")
    k = F.col("c_custkey")
    company = F.concat(F.when(k % 5 == 0, 'Say "Hi",\n').otherwise("firm "), k.cast("string"))
    stages.write_csv(c.select(company.alias("company"), F.lit("deal, one").alias("opportunity"), pick(["agree", "Not a fit", "maybe", " TRUE "], k).alias("verdict")), path)
    return readers.read_reviews(s, path).unionByName(readers.read_reviews(s, path + "-none"))


def view_rescan(s: S, d: str) -> DataFrame:
    """Views written and read back: rows of each; an empty optional view isn't there, and abstentions
    without a row have one that says so."""
    path = stages.scratch(s, "views")
    p = pairs(s, d).select("cid", "oid", "decision", "verdict")
    none = p.filter("1 = 0")
    stages.write_views({"All_Pairs": p, "Company_View": p.filter("oid < 3"), "Consortium_View": none, "Abstentions": none.select("oid", F.col("decision").alias("status"))}, path)
    views = stages.read_views(s, path, ["All_Pairs", "Company_View", "Consortium_View", "Abstentions"])
    out = None
    for name, df in views.items():
        one = df.agg(F.count("*").alias("n")).select(F.lit(name).alias("view"), "n")
        out = one if out is None else out.union(one)
    return out


def csv_export(s: S, d: str) -> DataFrame:
    """Commas, quotes and line ends survive a CSV export."""
    path = stages.scratch(s, "csv")
    df = t(s, d, "benchmark").select("item_id", F.concat(F.lit('a "quoted", '), F.substring("text", 1, 60)).alias("note"))
    stages.write_csv(df, path)
    return stages.read_csv(s, path).select(F.col("item_id").cast("long").alias("item_id"), "note")


def batched_files(s: S, d: str) -> DataFrame:
    """One folder for each ten source entities."""
    path = stages.scratch(s, "batches")
    stages.write_batches(pairs(s, d).select("cid", "oid"), path, "cid")
    back = s.read.parquet(path)
    return back.groupBy(F.col("batch").cast("long").alias("batch")).agg(F.count("*").alias("n"), F.min("cid").alias("lo"), F.max("cid").alias("hi"))


def checkpoint_resume(s: S, d: str) -> DataFrame:
    """A checkpoint is read again while its inputs and parameters are the same, and made anew when rows of an input, a parameter or
    the columns have changed."""
    path = stages.scratch(s, "resume")
    n = t(s, d, "nation")
    taken: dict[str, DataFrame] = {}

    def again(name: str, source: DataFrame, made: int, rubric: str) -> None:
        df = source.select("n_nationkey", F.lit(made).alias("made"))
        taken[name] = stages.stage(stages.checkpoint(df, path, [source], {"rubric": rubric}).withColumnRenamed("made", name), name)

    some = n.filter("n_nationkey % 3 <> 0")
    again("first", some, 1, "a")
    again("kept", some, 2, "a")
    again("fresh_rows", n, 3, "a")
    again("fresh_rubric", n, 4, "b")
    out = n.select("n_nationkey")
    for df in taken.values():
        out = out.join(df, "n_nationkey", "left")
    return out


def folder_scan(s: S, d: str) -> DataFrame:
    """CSV files in nested folders, each with a header of its own, read as one table of texts."""
    path = stages.scratch(s, "folder")
    c, n, p = t(s, d, "clients"), t(s, d, "nation"), t(s, d, "vendors")
    told = F.when(F.col("client_id") % 3 == 0, F.concat(F.lit('says "hi"\n'), "name")).otherwise(F.col("name"))
    stages.write_csv(c.filter("client_id IS NOT NULL").select(F.col("client_id").alias("Key"), told.alias("Name"), F.col("email").alias("E-Mail")), f"{path}/a/b")
    stages.write_csv(n.select(F.lit("nation").alias("Kind"), F.col("n_name").alias("name"), F.col("n_nationkey").alias("Key")), f"{path}/a/n")
    stages.write_csv(p.filter("vendor_id IS NOT NULL").select(F.col("name").alias("NAME"), F.col("vendor_id").alias("key"), F.lit("v").alias("Kind")), f"{path}/c")
    rows, _ = folders.read_folder(s, path)
    return rows.select("Name", "Key", "Kind", "E-Mail")


def person_keys(s: S, d: str) -> DataFrame:
    """Rows of files with an e-mail, and the keys of their persons from name columns and from first and last names."""
    path = stages.scratch(s, "persons")
    c, p = t(s, d, "clients").filter("client_id IS NOT NULL"), t(s, d, "vendors").filter("vendor_id IS NOT NULL")
    k = F.col("client_id").cast("string")
    stages.write_csv(c.select(F.col("name").alias("First Name"), F.concat(F.lit("No-"), k).alias("last"), F.concat(F.lit("c"), k, F.lit("@Example.org")).alias("Work Email"), k.alias("mark")), f"{path}/x")
    v = F.col("vendor_id").cast("string")
    note = F.when(F.col("vendor_id") % 2 == 0, F.concat(F.lit("write to v"), v, F.lit("@example.com")))
    stages.write_csv(p.select(F.concat(F.lit("contact of "), v).alias("Contact"), F.concat(F.lit("Guest_"), v).alias("Guest"), note.alias("Remark"), F.lit("").alias("Email")), f"{path}/y")
    rows, _ = folders.read_folder(s, path)
    return folders.person_rows(rows).select("email", F.array_join("keys", "|").alias("keys"))


def document_files(s: S, d: str) -> DataFrame:
    """Text files: category by the name's prefix, length and line ends.  Files are written by the driver,
    one for each region."""
    path = stages.scratch(s, "files")
    jvm = s.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(s.sparkContext._jsc.hadoopConfiguration())
    for r in t(s, d, "region").orderBy("r_regionkey").collect():  # five rows at every scale
        name = f"{r.r_name}_{r.r_regionkey}.txt" if r.r_regionkey % 2 else f"plain{r.r_regionkey}.txt"
        out = fs.create(jvm.org.apache.hadoop.fs.Path(root, name))
        out.write(bytearray(f"Région {r.r_name}\nsecond line\n" * (r.r_regionkey + 1), "utf-8"))
        out.close()
    return readers.read_documents(s, path).select("file", "category", "n_chars", "n_lines")


def workbook_scan(s: S, d: str) -> DataFrame:
    """A workbook of two formatted sheets beside a file that is none, read back as texts."""
    path = stages.scratch(s, "books")
    n = t(s, d, "nation").orderBy("n_nationkey").select(F.col("n_name").alias("Name"), F.col("n_nationkey").alias("Key"), F.when(F.col("n_nationkey") % 2 == 0, F.lit("a <b> & \"c\"\n d")).alias("Note"), pick(["High Fit", "Low Fit"], F.col("n_nationkey")).alias("ai_decision"))
    workbooks.write_workbook({"All_Pairs": n, "Second & last": n.filter("Key < 3").select("Key", "Name")}, f"{path}/deep/down/book.xlsx", "ai_decision")
    n.coalesce(1).write.option("header", True).csv(f"{path}/deep/odd.xlsx")
    rows = workbooks.read_workbooks(s, path)
    first = workbooks.sheet_table(rows, "All_Pairs", ["Name", "Key", "Note", "ai_decision"]).withColumn("sheet", F.lit(1))
    return first.unionByName(workbooks.sheet_table(rows, "Second & last", ["Name", "Key", "Note", "ai_decision"]).withColumn("sheet", F.lit(2)))


LITERAL = [{"title": f"Plant {k}", "sector": sector, "note": "n" * k} for k, sector in enumerate(["Mining", "MedTech", "ICT Hardware", "Agri Food"])]


def literal_rows(s: S, d: str) -> DataFrame:
    return readers.literal_table(s, LITERAL, ["title", "sector", "materials", "note"])


def vector_cache(s: S, d: str) -> DataFrame:
    """Half of the texts are in the cache; the others go to a provider in batches of 96."""
    names = t(s, d, "part").select("p_partkey", F.col("p_name").alias("text"))
    texts = names.withColumn("text", F.concat("text", F.lit(" "), (F.col("p_partkey") % 300).cast("string")))
    vector = lambda m: F.array(F.length("text").cast("double"), F.lit(m))
    cache = texts.filter("p_partkey % 300 < 150").select(stages.cache_key("m1", F.col("text")).alias("key"), vector(0.0).alias("vector")).distinct()
    out, whole = stages.cached_vectors(texts, cache, lambda asked: asked.select("key", F.array(F.length("text").cast("double"), F.lit(1.0)).alias("vector")), "m1", "text")
    size = whole.agg(F.count("*").alias("cached"))
    return out.select("p_partkey", F.element_at("vector", 1).alias("first"), F.element_at("vector", 2).alias("asked")).join(F.broadcast(size))  # one row


def cache_merge(s: S, d: str) -> DataFrame:
    """Fresh entries replace older ones of their key."""
    n = t(s, d, "nation")
    old = n.select(F.col("n_name").alias("key"), F.lit("old").alias("value"))
    fresh = n.filter("n_nationkey % 3 = 0").select(F.col("n_name").alias("key"), F.lit("new").alias("value")).union(t(s, d, "region").select("r_name", F.lit("new")))
    return stages.merged_cache(old, fresh, "key")


def markdown_summary(s: S, d: str) -> DataFrame:
    rows = pairs(s, d).select("oid", "cid", "decision", F.when(F.col("oid") % 3 == 0, "Anchor candidate").otherwise("JV partner").alias("match_type"), F.col("profile").alias("final_score"), F.col("match_value").alias("confidence_score"))
    rows = rows.filter("oid < 8 AND cid < 20").join(O.opportunity_status(rows.filter("oid < 8 AND cid < 20"), "oid"), "oid")
    rows = rows.withColumns({"opportunity_name": F.concat(F.lit("Deal "), F.col("oid").cast("string")), "company_name": F.concat(F.lit("Firm "), F.col("cid").cast("string"))})
    sectors = lambda n: t(s, d, "nation").filter(F.col("n_nationkey") < n).select(F.concat(F.lit("name"), "n_nationkey").alias("name"), pick(["Mining", "MedTech", "Mining"], F.col("n_nationkey")).alias("sector"))
    return B.summary_lines(rows, sectors(20), sectors(8))


def report_sheets(s: S, d: str) -> DataFrame:
    """The plain report: matches, opportunities without one, needs and gaps; one column tells the sheet."""
    p = pairs(s, d).select("cid", "oid", "verdict", "human", "votes", F.col("profile").alias("final_score"), F.coalesce(F.col("verdict").isin("Direct", "Yes") & (F.col("oid") % 4 != 1), F.lit(False)).alias("validated_fit"))
    p = p.withColumns({"opportunity": F.concat(F.lit("deal—"), F.col("oid").cast("string")), "company": F.concat(F.lit("firm  "), F.col("cid").cast("string"))})
    p = p.withColumns({"gate_explanation": F.when(F.col("cid") % 2 == 0, F.concat(F.lit("why – "), "company"))})
    gaps = s.createDataFrame([("deal—0", "Steel", "firm 1", "near"), ("deal—0", "Glass", "", None), ("deal—2", "", "", None)], "opportunity string, need string, covered_by string, why string")
    away = p.groupBy("opportunity").agg(F.bool_or("validated_fit").alias("v"), F.max_by("company", F.struct("final_score", -F.col("cid"))).alias("best_candidate")).filter("NOT v").select("opportunity", "best_candidate", F.lit("graded No").alias("detail"))
    sheets = B.report_sheets(p, away, gaps)
    out = None
    for name, df in sheets.items():
        one = df.select(F.lit(name).alias("sheet"), F.concat_ws("|", *[F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in df.columns]).alias("row"))
        out = one if out is None else out.union(one)
    return out


QUERIES = {
    "company_scan": company_scan, "merged_names": merged_names, "opportunity_scan": opportunity_scan, "sheet_union": sheet_union, "first_existing": first_existing, "header_names": header_names,
    "structured_lists": structured_lists, "id_discovery": id_discovery, "verdict_log": verdict_log, "verdict_stream": verdict_stream, "review_file": review_file, "view_rescan": view_rescan, "csv_export": csv_export,
    "batched_files": batched_files, "checkpoint_resume": checkpoint_resume, "folder_scan": folder_scan, "person_keys": person_keys, "document_files": document_files, "workbook_scan": workbook_scan, "literal_rows": literal_rows, "vector_cache": vector_cache,
    "cache_merge": cache_merge, "markdown_summary": markdown_summary, "report_sheets": report_sheets,
}

# --- SQL -----------------------------------------------------------------------------------------


def _focus(x: str) -> str:
    junk = sql_text("(?i)" + "|".join(dims.JUNK_PHRASES))
    return f"trim(regexp_replace(regexp_replace({x}, {junk}, ' ', 'g'), '{SPACES}', ' ', 'g'))"


def _focus_deal(x: str) -> str:
    cut = f"regexp_replace(regexp_replace({x}, {sql_text('(?i)' + dims.PRICE_NUMBER)}, ' ', 'g'), {sql_text('(?i)' + dims.GEOGRAPHY)}, ' ', 'g')"
    return f"trim(regexp_replace({cut}, '{SPACES}', ' ', 'g'))"


_suffix = "|".join(dims.LEGAL_SUFFIXES)
_key = f"trim(regexp_replace({pp('replace(lower(name), ' + sql_text('&') + ', ' + sql_text(' and ') + ')')}, '(^|\\s)({_suffix})(\\s+({_suffix}))*$', ''))"
_FIRMS = f"""co AS (SELECT s_suppkey AS id, 'Firm ' || floor(s_suppkey * 3 / 5)::BIGINT || {sql_pick(SUFFIXES[:1] + SUFFIXES[2:4], 's_suppkey')} AS name,
  {sql_pick(FOUNDING, 's_suppkey')} || ' ' || repeat('steel ', (s_suppkey % 7)::INT) AS profile, CASE WHEN s_suppkey % 6 <> 0 THEN 'Pumps & valves; no. ' || s_suppkey END AS products,
  {sql_pick(['Mining', 'MedTech', 'ICT Hardware'], 's_suppkey')} AS sector FROM supplier),
ke AS (SELECT *, {_key} AS k FROM co), rn AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY length(profile) + length(coalesce(products, '')) DESC, id) AS r FROM ke)"""
_nk = lambda x: f"trim(regexp_replace(regexp_replace(translate(lower(trim({x})), '-_', '  '), '[^a-z0-9\\s]', ' ', 'g'), '{SPACES}', ' ', 'g'))"
_lit = "SELECT * FROM (VALUES " + ", ".join(f"({sql_text(r['title'])}, {sql_text(r['sector'])}, '', {sql_text(r['note'])})" for r in LITERAL) + ") v(title, sector, materials, note)"
_vet = "decision IN ('Excellent Match', 'Strong Match', 'Good Match')"
_MD = f"""pr AS (SELECT *, CASE WHEN oid % 3 = 0 THEN 'Anchor candidate' ELSE 'JV partner' END AS match_type FROM ({PAIRS_SQL}) WHERE oid < 8 AND cid < 20),
st AS (SELECT oid, CASE WHEN NOT bool_or({_vet}) THEN 'No viable target in current universe' WHEN bool_or({_vet} AND match_type = 'Anchor candidate') THEN 'Anchor candidate identified' ELSE 'No anchor in universe - JV/supplier options only' END AS status FROM pr GROUP BY oid)"""
_cl = lambda x: f"trim(regexp_replace(translate({x}, '—–', '--'), '{SPACES}', ' ', 'g'))"

SQL = {
    "company_scan": f"""WITH {_FIRMS} SELECT id AS company_id, name AS company_name, sector, concat_ws(' ', name, sector, profile, products) AS combined,
      concat_ws(' ', sector, {_focus('profile')}, {_focus("coalesce(products, '')")}) AS combined_focused, {pp('products')} AS products_clean FROM rn WHERE r = 1""",
    "merged_names": f"WITH {_FIRMS} SELECT b.name AS kept, a.name AS merged FROM rn a JOIN rn b USING (k) WHERE a.r > 1 AND b.r = 1",
    "opportunity_scan": f"""WITH o AS (SELECT item_id, concat_ws(' ', 'Plant ' || item_id, {sql_pick(['Mining', 'MedTech'], 'item_id')}, text, CASE WHEN item_id % 3 <> 0 THEN {sql_pick(PRICES, 'item_id')} END) AS x FROM benchmark)
      SELECT item_id AS opportunity_id, 'Plant ' || item_id AS opportunity_name, x AS requirement, {_focus_deal('x')} AS requirement_focused FROM o""",
    "sheet_union": f"WITH {_FIRMS} SELECT name AS company_name, sector, CASE WHEN id % 2 = 0 THEN id END AS id FROM co",
    "first_existing": "SELECT 'nation.parquet' AS found, count(*) AS n FROM nation",
    "header_names": "SELECT * FROM (VALUES " + ", ".join(
        f"('{sheet}', {sql_text(h)}, '{to}')" for sheet, h, to in [
            *(("company", h, to) for h, to in zip(COMPANY_SHEET.values(), ["company_name", "company_profile", "product_services", "sector"], strict=True)),
            *(("opportunity", h, to) for h, to in zip(OPPORTUNITY_SHEET.values(), ["opportunity_name", "sector", "description", "materials"], strict=True)),
        ]
    ) + ") v(sheet, header, renamed)",
    "structured_lists": "SELECT item_id, " + ", ".join("CASE WHEN item_id % 5 = 0 THEN '' ELSE 'ore|' || item_id END AS required_inputs" if c == "required_inputs" else f"'' AS {c}" for c in readers.STRUCTURED_LISTS) + " FROM benchmark",
    "id_discovery": "SELECT n_name, CASE WHEN n_nationkey % 4 = 0 THEN 0 ELSE n_nationkey END::BIGINT AS found_id, row_number() OVER (ORDER BY n_name) AS position FROM nation",
    "verdict_log": f"""WITH e AS (SELECT strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS ts, 'c' || user_id AS company, event_type AS opportunity, {sql_pick(['Direct', 'Partial', 'No'], 'event_id')} AS decision, event_id::INT AS votes FROM events)
      SELECT company, opportunity, ts, decision, votes FROM (SELECT *, row_number() OVER (PARTITION BY company, opportunity ORDER BY ts DESC, votes DESC) AS r FROM e) WHERE r = 1""",
    "review_file": "SELECT CASE WHEN c_custkey % 5 = 0 THEN 'Say \"Hi\",' || chr(10) ELSE 'firm ' END || c_custkey AS company, 'deal, one' AS opportunity, CASE c_custkey % 4 WHEN 1 THEN 0 ELSE 1 END::INT AS label FROM customer WHERE c_custkey % 4 <> 2",
    "view_rescan": f"SELECT 'All_Pairs' AS view, count(*) AS n FROM ({PAIRS_SQL}) UNION ALL SELECT 'Company_View', count(*) FROM ({PAIRS_SQL}) WHERE oid < 3 UNION ALL SELECT 'Abstentions', 1",
    "csv_export": "SELECT item_id, 'a \"quoted\", ' || substring(text, 1, 60) AS note FROM benchmark",
    "batched_files": f"SELECT cid // 10 AS batch, count(*) AS n, min(cid) AS lo, max(cid) AS hi FROM ({PAIRS_SQL}) GROUP BY 1",
    "checkpoint_resume": "SELECT n_nationkey, CASE WHEN n_nationkey % 3 <> 0 THEN 1 END AS first, CASE WHEN n_nationkey % 3 <> 0 THEN 1 END AS kept, 3 AS fresh_rows, 4 AS fresh_rubric FROM nation",
    "folder_scan": """SELECT nullif(CASE WHEN client_id % 3 = 0 THEN 'says "hi"' || chr(10) || name ELSE name END, '') AS "Name", client_id::VARCHAR AS "Key", NULL::VARCHAR AS "Kind", nullif(email, '') AS "E-Mail" FROM clients WHERE client_id IS NOT NULL
      UNION ALL SELECT n_name, n_nationkey::VARCHAR, 'nation', NULL FROM nation UNION ALL SELECT nullif(name, ''), vendor_id::VARCHAR, 'v', NULL FROM vendors WHERE vendor_id IS NOT NULL""",
    "person_keys": f"""WITH c AS (SELECT 'c' || client_id || '@example.org' AS email, [{_nk("coalesce(name, '')")}, {_nk("coalesce(name, '') || ' No-' || client_id")}] AS k FROM clients WHERE client_id IS NOT NULL),
      v AS (SELECT 'v' || vendor_id || '@example.com' AS email, [{_nk("'contact of ' || vendor_id")}, {_nk("'Guest_' || vendor_id")}] AS k FROM vendors WHERE vendor_id IS NOT NULL AND vendor_id % 2 = 0)
      SELECT email, array_to_string(list_filter(k, lambda x: length(x) >= 4), '|') AS keys FROM (FROM c UNION ALL FROM v)""",
    "document_files": """SELECT CASE WHEN r_regionkey % 2 = 1 THEN r_name || '_' || r_regionkey ELSE 'plain' || r_regionkey END AS file, CASE WHEN r_regionkey % 2 = 1 THEN string_split(r_name, '_')[1] ELSE 'Telecom/ICT' END AS category,
      ((length('Région ' || r_name) + 13) * (r_regionkey + 1))::INT AS n_chars, (2 * (r_regionkey + 1))::INT AS n_lines FROM region""",
    "workbook_scan": """SELECT n_name AS "Name", n_nationkey::VARCHAR AS "Key", CASE WHEN n_nationkey % 2 = 0 THEN 'a <b> & "c"' || chr(10) || ' d' ELSE '' END AS "Note", CASE WHEN n_nationkey % 2 = 0 THEN 'High Fit' ELSE 'Low Fit' END AS ai_decision, 1 AS sheet FROM nation
      UNION ALL SELECT n_name, n_nationkey::VARCHAR, '', '', 2 FROM nation WHERE n_nationkey < 3""",
    "literal_rows": f"SELECT *, (length(title) + length(sector) + length(note))::INT AS n_chars FROM ({_lit})",
    "vector_cache": """WITH x AS (SELECT p_partkey, p_name || ' ' || (p_partkey % 300)::VARCHAR AS text, p_partkey % 300 >= 150 AS fresh FROM part)
      SELECT p_partkey, length(text)::DOUBLE AS first, fresh::INT::DOUBLE AS asked, (SELECT count(DISTINCT text) FROM x) AS cached FROM x""",
    "cache_merge": "SELECT n_name AS key, CASE WHEN n_nationkey % 3 = 0 THEN 'new' ELSE 'old' END AS value FROM nation UNION ALL SELECT r_name, 'new' FROM region",
    "markdown_summary": f"""WITH {_MD}, c AS (SELECT n_nationkey AS k, CASE WHEN n_nationkey % 3 = 1 THEN 'MedTech' ELSE 'Mining' END AS sector FROM nation),
      li AS (SELECT 0 AS part, 0 AS k, '# Matching run: dataset verdict' AS line
        UNION ALL SELECT 1, 0, 'Companies: ' || (SELECT count(*) FROM c WHERE k < 20) || ' (' || (SELECT string_agg(sector || ' ' || n, ', ' ORDER BY n DESC, sector) FROM (SELECT sector, count(*) AS n FROM c WHERE k < 20 GROUP BY sector)) || ')'
        UNION ALL SELECT 2, 0, 'Opportunities: ' || (SELECT count(*) FROM c WHERE k < 8) || ' (' || (SELECT string_agg(sector || ' ' || n, ', ' ORDER BY n DESC, sector) FROM (SELECT sector, count(*) AS n FROM c WHERE k < 8 GROUP BY sector)) || ')'
        UNION ALL SELECT 3, 0, 'Anchor candidates identified: ' || count_if(status = 'Anchor candidate identified') || ' of 8 opportunities; without a viable target: ' || count_if(status = 'No viable target in current universe') FROM st
        UNION ALL SELECT 4, 0, '## Per-opportunity status'
        UNION ALL SELECT 5, row_number() OVER (ORDER BY 'Deal ' || oid) - 1, '- Deal ' || oid || ': ' || status FROM st
        UNION ALL SELECT 6, 0, '## Pursue list'
        UNION ALL SELECT 7, row_number() OVER (ORDER BY profile DESC, 'Firm ' || cid, 'Deal ' || oid) - 1, '- Firm ' || cid || ' -> Deal ' || oid || ': ' || decision || ', ' || match_type || ', score ' || profile || ', confidence ' || match_value FROM pr WHERE {_vet})
      SELECT part::INT AS part, k::INT AS k, line FROM li""",
    "report_sheets": f"""WITH p AS (SELECT *, coalesce(verdict IN ('Direct', 'Yes') AND oid % 4 <> 1, false) AS v FROM ({PAIRS_SQL})),
      m AS (SELECT 'Matches' AS sheet, {_cl("'deal—' || oid")} || '|' || {_cl("'firm  ' || cid")} || '|Can build it|' || CASE WHEN cid % 2 = 0 THEN {_cl("'why – firm  ' || cid")} ELSE '' END || '|' ||
          CASE WHEN human = 'Agree' THEN 'Confirmed by analyst' WHEN votes = '' THEN 'Medium' WHEN string_split(votes, '/')[1] = string_split(votes, '/')[2] THEN 'High (unanimous)' ELSE 'Medium (' || votes || ' votes)' END || '|' || coalesce(human, '') AS row FROM p WHERE v),
      a AS (SELECT oid, first(cid ORDER BY profile DESC, cid) AS best FROM p GROUP BY oid HAVING NOT bool_or(v))
      SELECT * FROM m UNION ALL SELECT 'No match', {_cl("'deal—' || oid")} || '|No suitable company in the current list|' || {_cl("'firm  ' || best")} || '|graded No' FROM a
      UNION ALL SELECT * FROM (VALUES ('Needs and gaps', 'deal-0|Steel|firm 1|near'), ('Needs and gaps', 'deal-0|Glass|NOBODY YET (gap)|')) g(sheet, row)""",
}
SQL["verdict_stream"] = SQL["verdict_log"]
