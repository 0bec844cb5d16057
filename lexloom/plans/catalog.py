"""The registered queries over the fixture tables, each with its SQL.

The fixture tables stand in for the dictionary tables: documents for entries (lang for part of speech, source for
lemma), lines for senses, conversations for attestations, labels for side tables, pages for dump pages.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import udfs
from ..operators import decisions, filters, joins, merge, ordering, reports
from . import align, collect

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


class Tables:
    """The tables of a folder by name, read when asked for."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(sql: str | None = None) -> Callable[[Callable[[Tables], DataFrame]], Query]:
    """Register a query under its function's name, with the SQL that gives the same rows."""

    def register(build: Callable[[Tables], DataFrame]) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(Tables(spark, sf_dir))

        QUERIES[build.__name__] = run
        if sql:
            SQL[build.__name__] = sql
        return run

    return register


def lines(t: Tables) -> DataFrame:
    """(doc_id, lang, source, n, line): the non-blank lines of documents, numbered from 0."""
    split = t.documents.select("doc_id", "lang", "source", F.posexplode(F.split("text", "\n", -1)).alias("n", "line"))
    return split.where(F.trim("line") != "")


LINES = "(SELECT doc_id, lang, source, unnest(string_split(text, chr(10))) AS line, unnest(generate_series(0, len(string_split(text, chr(10))) - 1)) AS n FROM documents)"


# Totals and filters


@query(f"SELECT lang, count(DISTINCT doc_id) AS entries, count(*) AS senses, CAST(sum(length(line)) AS BIGINT) AS characters FROM {LINES} WHERE trim(line, ' ') <> '' GROUP BY lang")
def totals(t):
    return lines(t).groupBy("lang").agg(F.count_distinct("doc_id").alias("entries"), F.count("*").alias("senses"), F.sum(F.length("line").cast("long")).alias("characters"))


@query("SELECT doc_id, source, n_chars FROM documents WHERE lang = 'en' AND source IN ('src0', 'src1', 'src2')")
def entries_language(t):
    return filters.in_language(t.documents, "en", "lang").where(F.col("source").isin("src0", "src1", "src2")).select("doc_id", "source", "n_chars")


@query("SELECT CASE WHEN event_type = 'click' THEN 'propn' ELSE event_type END AS pos, count(*) AS n FROM (SELECT CASE event_type WHEN 'view' THEN 'noun' WHEN 'purchase' THEN 'verb' ELSE event_type END AS event_type FROM events) WHERE event_type IN ('noun', 'verb', 'click') GROUP BY 1")
def pos_map(t):
    raw = F.when(F.col("event_type") == "view", "noun").when(F.col("event_type") == "purchase", "verb").when(F.col("event_type") == "click", "name").otherwise(F.col("event_type"))
    return t.events.select(filters.map_pos(raw).alias("pos")).where("pos is not null").groupBy("pos").agg(F.count("*").alias("n"))


PREFIXES = ["standard", "small plated", "promo brushed tin", "economy  anodized"]


@query("""SELECT p_partkey, p_type FROM part WHERE lower(p_type) = 'standard' OR starts_with(lower(p_type), 'standard ') OR starts_with(lower(p_type), 'small plated ')
    OR lower(p_type) IN ('small plated', 'promo brushed tin') OR starts_with(lower(p_type), 'promo brushed tin ')""")
def form_prefix_filter(t):
    return t.part.where(filters.starts_with_any(F.col("p_type"), PREFIXES)).select("p_partkey", "p_type")


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 0 THEN year(o_orderdate) END AS y FROM orders
    WHERE o_orderstatus = 'P' OR (o_orderkey % 5 <> 0 AND year(o_orderdate) BETWEEN 1994 AND 1996)""")
def year_bounds(t):
    rows = t.orders.select("o_orderkey", F.when(F.col("o_orderkey") % 5 != 0, F.year("o_orderdate").cast("long")).alias("y"), F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("reference"))
    return rows.where(filters.year_within(F.col("reference"), F.col("y"), 1994, 1996)).drop("reference")


@query(r"""SELECT p_partkey, w AS synonym FROM (SELECT p_partkey, p_name, unnest([p_name, p_brand || ';', p_type, '(' || p_brand, '[' || p_brand || ']']) AS w FROM part)
    WHERE regexp_matches(w, '[A-Za-z0-9]') AND w <> p_name AND NOT regexp_matches(w, '[:,;]$') AND length(w) - length(replace(w, '(', '')) = length(w) - length(replace(w, ')', ''))""")
def synonym_filter(t):
    words = F.array("p_name", F.concat("p_brand", F.lit(";")), F.col("p_type"), F.concat(F.lit("("), "p_brand"), F.concat(F.lit("["), "p_brand", F.lit("]")))
    return t.part.select("p_partkey", F.explode(udfs.kept_synonyms(words, "p_name")).alias("synonym"))


@query(r"SELECT conv_id, turn, regexp_replace(chr(9) || text || chr(10), '^[ \t\n]+|[ \t\n]+$', '', 'g') AS plain FROM conversations")
def unicode_trim(t):
    return t.conversations.select("conv_id", "turn", filters.unicode_trim(F.concat(F.lit("\t"), "text", F.lit("\n"))).alias("plain"))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events WHERE CAST(json_extract(props, '$.k') AS BIGINT) > 50")
def narrow_json(t):
    return t.events.select("event_id", F.from_json("props", "k bigint")["k"].alias("k")).where("k > 50")


@query("SELECT page_id, url FROM pages WHERE contains(lower(html), '<table') OR contains(lower(html), '&amp;')")
def page_prefilter(t):
    return t.pages.where(filters.page_may_hold(F.col("html"), "<table", "&amp;")).select("page_id", "url")


@query("SELECT doc_id FROM documents WHERE trim(source, ' ') <> '' AND n_chars > 0")
def headword_present(t):
    return filters.has_headword(t.documents, "source").where("n_chars > 0").select("doc_id")


@query("SELECT doc_id, quality FROM labels WHERE NOT (toxic = 1 OR quality = 0)")
def form_tag_filter(t):
    tags = F.filter(F.array(F.when(F.col("toxic") == 1, F.lit("form-of")), F.when(F.col("quality") == 0, F.lit("alt-of"))), lambda x: x.isNotNull())
    return t.labels.where(~filters.is_form(tags)).select("doc_id", "quality")


@query("""SELECT doc_id, count(*) AS kept FROM (SELECT doc_id, line, bool_or(line IS NULL) OVER (PARTITION BY doc_id) AS damaged FROM
    (SELECT doc_id, CASE WHEN contains(line, '|') THEN NULL WHEN length(line) < 20 THEN '' ELSE line END AS line FROM """ + LINES + """ WHERE trim(line, ' ') <> '')) WHERE NOT damaged AND line <> '' GROUP BY doc_id""")
def damaged_levels(t):
    clean = F.when(F.contains("line", F.lit("|")), F.lit(None)).when(F.length("line") < 20, "").otherwise(F.col("line"))
    chains = lines(t).groupBy("doc_id").agg(F.collect_list(F.struct(clean.alias("g"))).alias("levels"))
    kept = F.filter("levels", lambda x: x["g"] != "")
    return chains.where(~F.exists("levels", lambda x: x["g"].isNull())).where(F.size(kept) > 0).select("doc_id", F.size(kept).cast("long").alias("kept"))


@query("""SELECT p_partkey, string_agg(f, '|' ORDER BY f) AS forms FROM (SELECT DISTINCT p_partkey, unnest([p_name, p_type, p_brand]) AS f FROM part
    WHERE p_size > 40) GROUP BY p_partkey""")
def service_forms(t):
    entry = lambda form, *tags: F.struct(form.alias("form"), F.array(*map(F.lit, tags)).cast("array<string>").alias("tags"))
    forms = F.array(entry(F.col("p_type")), entry(F.lit("-")), entry(F.lit("  ")), entry(F.lit("row"), "table-tags"), entry(F.col("p_brand"), "plural"))
    return t.part.where("p_size > 40").select("p_partkey", F.array_join(F.array_sort(filters.service_forms(forms, F.col("p_name"))), "|").alias("forms"))


# Joins


@query("SELECT c_custkey, coalesce(n_name, 'none') AS variant FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_regionkey < 3) ON c_nationkey = n_nationkey")
def variant_lookup(t):
    known = t.nation.where("n_regionkey < 3").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("variant"))
    return joins.look_up(t.customer.select("c_custkey", "c_nationkey"), known, ["c_nationkey"], {"variant": F.lit("none")}).select("c_custkey", "variant")


@query("SELECT d.doc_id, coalesce(nullif(CASE WHEN d.doc_id % 3 = 0 THEN '' ELSE lang END, ''), CASE WHEN quality = 1 THEN 'good' WHEN quality = 0 THEN 'bad' END) AS label FROM documents d LEFT JOIN labels USING (doc_id)")
def label_fill(t):
    rows = t.documents.select("doc_id", F.when(F.col("doc_id") % 3 == 0, "").otherwise(F.col("lang")).alias("label"))
    known = t.labels.select("doc_id", F.when(F.col("quality") == 1, "good").otherwise("bad").alias("label"))
    return joins.fill_label(rows, known, "doc_id", "label")


@query("SELECT doc_id, source FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id) OR source = 'src1'")
def known_table_anti(t):
    return joins.without(t.documents, t.labels, ["doc_id"], F.col("source") == "src1").select("doc_id", "source")


@query("""SELECT DISTINCT item_id, doc_id FROM (SELECT item_id, unnest(string_split(lower(text), ' ')) AS form FROM benchmark)
    JOIN (SELECT doc_id, unnest(string_split(lower(text), ' ')) AS form FROM documents WHERE lang = 'en') USING (form) WHERE length(form) >= 12""")
def blocking_candidates(t):
    form = lambda df, key: df.select(key, F.explode(F.split(F.lower("text"), " ", -1)).alias("form")).where(F.length("form") >= 12)
    return joins.block(form(t.benchmark, "item_id"), form(t.documents.where("lang = 'en'"), "doc_id"), ["form"], "item_id", "doc_id")


@query("""SELECT s_suppkey FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    WHERE r_name NOT IN ('ASIA', 'EUROPE') AND s_suppkey NOT IN (SELECT l_suppkey FROM lineitem WHERE l_quantity = 50 AND l_discount = 0.1)""")
def staged_exclusion(t):
    found = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    rest = joins.exclude_stages(found.withColumn("sources", F.array("r_name")), "sources", ["ASIA", "EUROPE"])
    equivalent = t.lineitem.where("l_quantity = 50 and l_discount = 0.1").select(F.col("l_suppkey").alias("s_suppkey"))
    return joins.without(rest, equivalent, ["s_suppkey"]).select("s_suppkey")


@query("""WITH direct AS (SELECT c_custkey, o_orderkey FROM customer JOIN orders ON c_custkey = o_custkey WHERE o_orderstatus = 'O' AND o_totalprice > 200000),
    fallback AS (SELECT c_custkey, min(o_orderkey) AS o_orderkey FROM customer JOIN orders ON c_custkey = o_custkey WHERE o_orderstatus = 'F' AND o_totalprice > 150000 GROUP BY c_custkey HAVING count(DISTINCT o_orderkey) = 1)
    SELECT c_custkey, o_orderkey, 'direct' AS via FROM direct UNION ALL SELECT c_custkey, o_orderkey, 'fallback' FROM fallback WHERE c_custkey NOT IN (SELECT c_custkey FROM direct)""")
def unique_fallback(t):
    both = t.customer.join(t.orders, F.col("c_custkey") == F.col("o_custkey"))
    return joins.unique_fallback(both.where("o_orderstatus = 'O' and o_totalprice > 200000"), both.where("o_orderstatus = 'F' and o_totalprice > 150000"), "c_custkey", "o_orderkey")


@query("""SELECT p.doc_id AS entry_id, t.doc_id AS target_id, p.gloss FROM (SELECT doc_id, text AS gloss, lang FROM documents WHERE doc_id % 2 = 0) p
    JOIN (SELECT doc_id, lang FROM documents WHERE doc_id % 2 = 1) t ON t.doc_id = p.doc_id + 1 WHERE p.lang = t.lang""")
def pointer_resolution(t):
    pointers = t.documents.where("doc_id % 2 = 0").select(F.col("doc_id").alias("entry_id"), (F.col("doc_id") + 1).alias("target_id"), F.col("text").alias("gloss"), F.col("lang").alias("gloss_key"))
    tables = t.documents.where("doc_id % 2 = 1").select(F.col("doc_id").alias("entry_id"), F.col("lang").alias("gloss_key"))
    return joins.resolve_pointers(pointers, tables).select("entry_id", "target_id", "gloss")


@query("""WITH scored AS (SELECT c_nationkey, c_custkey, round(c_acctbal / 1000) AS score FROM customer), ranked AS (SELECT *, row_number() OVER w AS rk, lead(score) OVER w AS nxt FROM scored WINDOW w AS (PARTITION BY c_nationkey ORDER BY score DESC, c_custkey))
    SELECT c_nationkey, c_custkey, score FROM ranked WHERE rk = 1 AND score >= 5 AND (nxt IS NULL OR nxt < score)""")
def best_match_no_ties(t):
    scored = t.customer.select("c_nationkey", "c_custkey", F.round(F.col("c_acctbal") / 1000).alias("score"))
    return joins.best_without_ties(scored, "c_nationkey", "c_custkey", "score", 5.0)


@query("SELECT DISTINCT conv_id FROM conversations WHERE conv_id NOT IN (SELECT doc_id FROM labels)")
def cache_pending(t):
    return joins.pending(t.conversations.select("conv_id").distinct(), t.labels.select(F.col("doc_id").alias("conv_id")), "conv_id")


@query("""SELECT d.doc_id, coalesce(string_agg(DISTINCT l.link, '|' ORDER BY l.link), '') AS targets FROM documents d LEFT JOIN (SELECT doc_id, 'q' || quality AS link FROM labels UNION ALL SELECT doc_id, 't' || toxic FROM labels) l USING (doc_id) GROUP BY d.doc_id""")
def apply_links(t):
    link = t.labels.select("doc_id", F.explode(F.array(F.concat(F.lit("q"), "quality"), F.concat(F.lit("t"), "toxic"))).alias("link"))
    return joins.apply_links(t.documents.select("doc_id"), link, "doc_id", "link").select("doc_id", F.array_join("targets", "|").alias("targets"))


@query("""SELECT n_name, count(*) AS n FROM nation JOIN supplier ON n_nationkey = s_nationkey WHERE EXISTS (SELECT 1 FROM customer WHERE c_nationkey = n_nationkey AND c_acctbal > 9900) GROUP BY n_name""")
def ancestor_semi(t):
    rich = t.customer.where("c_acctbal > 9900").select(F.col("c_nationkey").alias("n_nationkey"))
    return t.nation.join(rich, "n_nationkey", "left_semi").join(t.supplier, F.col("n_nationkey") == F.col("s_nationkey")).groupBy("n_name").agg(F.count("*").alias("n"))


@query("""SELECT doc_id, CAST(n AS BIGINT) AS depth, CAST(row_number() OVER w AS BIGINT) AS levels, md5(line) AS level, md5(string_agg(md5(line), '>') OVER w) AS chain FROM """ + LINES + """ WINDOW w AS (PARTITION BY doc_id ORDER BY n ROWS UNBOUNDED PRECEDING)""")
def ancestor_chains(t):
    own = F.transform(F.split("text", "\n", -1), lambda g: F.md5(g))
    # A chain is told by the hashes of its levels, so that deep texts stay in proportion.
    grown = t.documents.select("doc_id", own.alias("g")).select("doc_id", "g", F.posexplode("g").alias("depth", "level"))
    chain = F.md5(F.array_join(F.slice("g", F.lit(1), F.col("depth") + 1), ">"))
    return grown.select("doc_id", F.col("depth").cast("long").alias("depth"), (F.col("depth") + 1).cast("long").alias("levels"), "level", chain.alias("chain"))


# Merging and report aggregations


@query("SELECT lang || '.' || source AS id, min(doc_id) AS first, string_agg(md5(text), '|' ORDER BY doc_id) AS texts, count(*) AS n FROM documents GROUP BY 1")
def merge_lemmas(t):
    rows = t.documents.select(F.concat("lang", F.lit("."), "source").alias("id"), "doc_id", F.md5("text").alias("text"))
    merged = rows.groupBy("id").agg(F.min("doc_id").alias("first"), merge.in_order(F.col("text"), F.col("doc_id")).alias("texts"))
    return merged.select("id", "first", F.array_join("texts", "|").alias("texts"), F.size("texts").cast("long").alias("n"))


@query("SELECT line, min(doc_id) AS doc_id FROM " + LINES + " WHERE trim(line, ' ') <> '' GROUP BY line")
def merge_senses_first_seen(t):
    return merge.first_seen(lines(t), ["line"], "doc_id").select("line", "doc_id")


@query("SELECT lang AS target, string_agg(DISTINCT source, '|' ORDER BY source) AS variants FROM documents WHERE source <> 'src0' AND n_chars > 500 GROUP BY lang")
def gather_variants(t):
    rows = t.documents.where("n_chars > 500").select(F.col("lang").alias("target"), F.when(F.col("source") == "src0", F.col("lang")).otherwise(F.col("source")).alias("variant"))
    return merge.gather_variants(rows, "target", "variant").select("target", F.array_join("variants", "|").alias("variants"))


@query("""SELECT source, lang, min(doc_id) AS first, string_agg(DISTINCT w, '|' ORDER BY w) AS words, arg_max(label, doc_id) FILTER (WHERE label <> '') AS label FROM (SELECT *, unnest(string_split(text, ' ')) AS w, CASE WHEN doc_id % 4 = 0 THEN '' ELSE 'L' || doc_id % 7 END AS label FROM documents) GROUP BY source, lang""")
def translation_tables(t):
    label = F.when(F.col("doc_id") % 4 == 0, "").otherwise(F.concat(F.lit("L"), (F.col("doc_id") % 7).cast("string")))
    rows = t.documents.select("source", "lang", F.explode(F.split("text", " ", -1)).alias("w"), label.alias("l"), "doc_id")
    return merge.merge_tables(rows, ["source", "lang"], "w", "l", "doc_id").select("source", "lang", "first", F.array_join("words", "|").alias("words"), "label")


@query("""SELECT source, string_agg(lang, '|' ORDER BY lang) AS known FROM (SELECT source, lang FROM documents LEFT JOIN labels USING (doc_id) GROUP BY source, lang HAVING max(CASE WHEN quality = 0 THEN 1 ELSE 0 END) = 0) GROUP BY source""")
def known_minus_incomplete(t):
    rows = t.documents.join(t.labels, "doc_id", "left").withColumn("complete", F.coalesce(F.col("quality") != 0, F.lit(True)))
    found = merge.known_keys(rows, "source", "lang", F.col("complete"))
    return found.where(F.size("known") > 0).select("source", F.array_join("known", "|").alias("known"))


@query("""SELECT conv_id, start, "end", string_agg(DISTINCT kind, '+' ORDER BY kind DESC) AS sources FROM (SELECT conv_id, CASE WHEN role = 'user' THEN 'lemmatizer' ELSE 'bold' END AS kind, CAST(turn // 2 AS BIGINT) AS start, CAST(turn // 2 + 1 AS BIGINT) AS "end" FROM conversations) GROUP BY ALL""")
def merge_word_offsets(t):
    start = F.floor(F.col("turn") / 2).cast("int")
    span = F.struct(start.alias("start"), (start + 1).alias("end"), F.array(F.when(F.col("role") == "user", "lemmatizer").otherwise("bold")).alias("sources"))
    merged = t.conversations.groupBy("conv_id").agg(F.collect_list(span).alias("spans")).select("conv_id", F.explode(udfs.merged_ranges("spans")["ranges"]).alias("r"))
    return merged.select("conv_id", F.col("r.start").cast("long").alias("start"), F.col("r.end").cast("long").alias("end"), F.array_join("r.sources", "+").alias("sources"))


@query("""WITH r AS (SELECT conv_id, turn, role, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS n FROM conversations), first AS (SELECT conv_id, role, min(turn) AS seen FROM r GROUP BY ALL) SELECT conv_id, string_agg(role, '>' ORDER BY seen) AS roles FROM first GROUP BY conv_id""")
def append_if_absent(t):
    rows = t.conversations.groupBy("conv_id").agg(merge.in_order(F.array("role"), F.col("turn")).alias("lists"))
    return rows.select("conv_id", F.array_join(merge.append_absent(F.col("lists")), ">").alias("roles"))


@query("SELECT lang AS pos, count(*) AS n FROM documents GROUP BY lang")
def entries_by_pos(t):
    return reports.count_by(t.documents.withColumnRenamed("lang", "pos"), "pos")


@query("SELECT n AS value, count(*) AS n FROM (SELECT doc_id, count(*) AS n FROM " + LINES + " WHERE trim(line, ' ') <> '' GROUP BY doc_id) GROUP BY 1")
def senses_per_entry(t):
    return reports.histogram(reports.count_by(lines(t), "doc_id", name="senses"), F.col("senses"))


@query("SELECT CAST(len(string_split(text, chr(10))) AS BIGINT) AS depth, count(*) AS n FROM documents GROUP BY 1")
def gloss_depths(t):
    return reports.histogram(t.documents, F.size(F.split("text", "\n", -1)).cast("long"), "depth")


@query("SELECT CASE WHEN role = 'system' THEN 'quotation' ELSE 'example' END AS kind, count(*) AS n FROM conversations GROUP BY 1")
def sentence_kinds(t):
    return reports.histogram(t.conversations, F.when(F.col("role") == "system", "quotation").otherwise("example"), "kind")


@query("SELECT source AS tag, count(*) AS n, min(doc_id) AS first FROM documents GROUP BY source ORDER BY n DESC, first LIMIT 10")
def tag_topk(t):
    counts = t.documents.groupBy(F.col("source").alias("tag")).agg(F.count("*").alias("n"), F.min("doc_id").alias("first"))
    return reports.top_k(counts, 10, "n", "first")


@query("SELECT source, count(*) AS n, round(count(*) / (SELECT count(*) FROM documents), 6) AS share FROM documents GROUP BY source")
def share_table(t):
    return reports.shares(t.documents, "source")


@query("SELECT CAST(quantile_cont(n, 0.5) AS DOUBLE) AS median FROM (SELECT doc_id, count(*) AS n FROM " + LINES + " WHERE trim(line, ' ') <> '' GROUP BY doc_id)")
def median_histogram(t):
    counts = reports.histogram(reports.count_by(lines(t), "doc_id", name="senses"), F.col("senses"))
    return reports.median_of(counts, "value", "n")


@query("SELECT lang AS code, CAST(sum(len(string_split(text, ' '))) AS BIGINT) AS words, count(DISTINCT source) AS tables FROM documents GROUP BY lang")
def translation_languages(t):
    return t.documents.groupBy(F.col("lang").alias("code")).agg(F.sum(F.size(F.split("text", " ", -1)).cast("long")).alias("words"), F.count_distinct("source").alias("tables"))


@query("SELECT lang, source, count(*) AS n, CAST(grouping(lang, source) AS INTEGER) AS level FROM documents GROUP BY CUBE (lang, source)")
def report_rollup(t):
    return reports.marginals(t.documents, "lang", "source")


@query("SELECT 'q' || quality AS task, count(*) AS evaluated, CAST(sum(toxic) AS BIGINT) AS aligned, CAST(sum(1 - toxic) AS BIGINT) AS unaligned, CAST(sum(toxic) AS BIGINT) AS associations FROM labels GROUP BY 1")
def alignment_stats(t):
    links = F.when(F.col("toxic") == 1, F.array(F.lit("t"))).otherwise(F.array().cast("array<string>"))
    return decisions.statistics(t.labels.select(F.concat(F.lit("q"), "quality").alias("task"), links.alias("links")), "task", "links")


@query("SELECT year(o_orderdate) AS y, count(*) AS quotations, count(*) FILTER (WHERE o_orderstatus = 'P') AS undated FROM orders GROUP BY 1")
def quotation_years(t):
    return t.orders.groupBy(F.year("o_orderdate").cast("long").alias("y")).agg(F.count("*").alias("quotations"), F.count_if(F.col("o_orderstatus") == "P").alias("undated"))


@query("SELECT count(DISTINCT l_partkey) AS ids, count(*) AS uses, round(avg(l_quantity), 6) AS mean_uses FROM lineitem WHERE l_returnflag = 'R'")
def wikidata_ids_per_sense(t):
    return t.lineitem.where("l_returnflag = 'R'").agg(F.count_distinct("l_partkey").alias("ids"), F.count("*").alias("uses"), F.round(F.avg("l_quantity"), 6).alias("mean_uses"))


# Order, sets and decisions


@query("SELECT conv_id, turn, last_value(CASE WHEN role = 'user' THEN turn END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS asked FROM conversations")
def role_carry_forward(t):
    return ordering.carry_forward(t.conversations.select("conv_id", "turn", "role"), F.when(F.col("role") == "user", F.col("turn")), "conv_id", "turn", "asked").drop("role")


@query("""WITH m AS (SELECT *, CASE WHEN lag(role) OVER (PARTITION BY conv_id ORDER BY turn) IS NOT DISTINCT FROM role THEN 0 ELSE 1 END AS b FROM (SELECT conv_id, turn, CASE WHEN turn % 3 = 0 THEN 'a' ELSE 'b' END AS role FROM conversations)),
    g AS (SELECT *, CAST(sum(b) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS BIGINT) AS island FROM m) SELECT conv_id, island, role, min(turn) AS first, max(turn) AS last, count(*) AS size FROM g GROUP BY conv_id, island, role""")
def role_islands(t):
    rows = t.conversations.select("conv_id", "turn", F.when(F.col("turn") % 3 == 0, "a").otherwise("b").alias("role"))
    return ordering.islands(rows, "role", "conv_id", "turn").withColumn("island", F.col("island").cast("long"))


@query("""SELECT * FROM (SELECT user_id, event_id, e - 40 + event_id % 50 AS start, e AS "end", lag(e) OVER (PARTITION BY user_id ORDER BY e - 40 + event_id % 50, e, event_id) AS previous_end FROM (SELECT user_id, event_id, event_id * 3 AS e FROM events)) WHERE start < previous_end""")
def offset_overlap_lag(t):
    rows = t.events.select("user_id", "event_id", (F.col("event_id") * 3 - 40 + F.col("event_id") % 50).alias("start"), (F.col("event_id") * 3).alias("end"))
    return ordering.overlaps(rows, ["user_id"], "start", "end")


@query("SELECT user_id, count(*) AS n, min(event_id) AS first FROM events GROUP BY user_id ORDER BY n DESC, first LIMIT 10")
def top10_ties(t):
    return reports.top_k(t.events.groupBy("user_id").agg(F.count("*").alias("n"), F.min("event_id").alias("first")), 10, "n", "first")


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS r FROM orders) WHERE r = 1")
def first_occurrence(t):
    return merge.first_seen(t.orders.withColumn("at", F.struct("o_orderdate", "o_orderkey")), ["o_custkey"], "at").select("o_orderkey", "o_custkey", "o_totalprice")


@query("SELECT source, 'd' AS side FROM documents WHERE lang = 'en' UNION ALL SELECT role, 'c' FROM conversations")
def union_all_sources(t):
    return t.documents.where("lang = 'en'").select("source", F.lit("d").alias("side")).unionByName(t.conversations.select(F.col("role").alias("source"), F.lit("c").alias("side")))


@query("SELECT lang AS word FROM documents UNION SELECT role FROM conversations")
def union_sources(t):
    return t.documents.select(F.col("lang").alias("word")).union(t.conversations.select("role")).distinct()


@query("SELECT doc_id FROM documents INTERSECT SELECT doc_id FROM labels")
def intersect_sources(t):
    return t.documents.select("doc_id").intersect(t.labels.select("doc_id"))


@query("SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels")
def except_sources(t):
    return t.documents.select("doc_id").exceptAll(t.labels.select("doc_id")).distinct()


@query("SELECT 'a' || doc_id AS alignment_id, 's' AS source_id, CASE WHEN toxic = 1 THEN 't' || quality ELSE '' END AS target_id, CASE WHEN toxic = 1 THEN 'equivalent' ELSE '' END AS relation, CASE WHEN toxic = 1 THEN 'r' ELSE '' END AS reason FROM labels")
def explode_decisions(t):
    link = F.struct(F.concat(F.lit("t"), "quality").alias("target_id"), F.lit("equivalent").alias("relation"), F.lit("r").alias("reason"))
    links = F.filter(F.array(F.when(F.col("toxic") == 1, link)), lambda x: x.isNotNull())
    return decisions.to_rows(t.labels.select(F.concat(F.lit("a"), "doc_id").alias("alignment_id"), F.lit("s").alias("source_id"), links.alias("links")))


@query("""SELECT l_suppkey % 7 AS q, l_orderkey AS id, count(DISTINCT l_partkey) AS n, 'source' AS side FROM lineitem WHERE l_quantity > 45 GROUP BY 1, 2 HAVING count(DISTINCT l_partkey) > 1
    UNION ALL SELECT l_suppkey % 7, l_partkey, count(DISTINCT l_orderkey), 'target' FROM lineitem WHERE l_quantity > 45 GROUP BY 1, 2 HAVING count(DISTINCT l_orderkey) > 1""")
def one_to_one_violations(t):
    return decisions.repeated_targets(t.lineitem.where("l_quantity > 45").withColumn("q", F.col("l_suppkey") % 7), "q", "l_orderkey", "l_partkey")


# Text


@query(r"""SELECT doc_id, trim(regexp_replace(text, '[ \t]{2,}', ' ', 'g'), chr(9) || chr(10) || ' ') AS plain FROM documents WHERE NOT regexp_matches(text, '[\[\]<>&#{}\\]|''''|[^\x00-\x7F]|\r')""")
def plain_documents(t):
    quiet = t.documents.where(~F.col("text").rlike(r"[\[\]<>&#{}\\]|''|[^\x00-\x7F]|\r"))
    return quiet.select("doc_id", udfs.plain_text("text").alias("plain"))


@query(r"""SELECT doc_id, regexp_replace(regexp_replace(text, '[ \t\n]+', ' ', 'g'), '^ | $', '', 'g') AS plain FROM documents WHERE NOT regexp_matches(text, '[\[\]<>&#{}\\]|''''|[^\x00-\x7F]|\r')""")
def plain_marked_documents(t):
    """Every word of a text as a bold link, an entity for each line's end: the scanner gives the words back."""
    quiet = t.documents.where(~F.col("text").rlike(r"[\[\]<>&#{}\\]|''|[^\x00-\x7F]|\r"))
    words = F.filter(F.split("text", "[ \t\n]+", -1), lambda w: w != "")
    marked = F.array_join(F.transform(words, lambda w: F.concat(F.lit("<b>'''[[x#y|"), w, F.lit("]]'''</b>"))), "&#32;  ")
    return quiet.select("doc_id", udfs.plain_text(marked).alias("plain"))


@query("SELECT doc_id, n, CASE WHEN NOT regexp_matches(line, '[A-Za-z0-9]') THEN '' ELSE upper(substr(line, 1, 1)) || substr(line, 2) || CASE WHEN regexp_matches(line, '[.?!]$') THEN '' ELSE '.' END END AS statement FROM " + LINES + " WHERE regexp_matches(line, '^[A-Za-z][^()]*[A-Za-z0-9.?!]$') AND NOT regexp_matches(line, '^[a-z]\\s*[=+<>\\\\]') AND NOT regexp_matches(line, '[^\\x00-\\x7F]')")
def line_statements(t):
    shape = F.col("line").rlike(r"^[A-Za-z][^()]*[A-Za-z0-9.?!]$") & ~F.col("line").rlike(r"^[a-z]\s*[=+<>\\]") & ~F.col("line").rlike(r"[^\x00-\x7F]")
    return lines(t).where(shape).select("doc_id", F.col("n").cast("long").alias("n"), udfs.as_statement("line").alias("statement"))


@query("SELECT p_partkey, p_brand || ' and ' || p_type AS plain FROM part")
def link_text(t):
    return t.part.select("p_partkey", udfs.plain_text(F.concat(F.lit("[["), "p_name", F.lit("|"), "p_brand", F.lit("]] and [["), "p_type", F.lit("]]"))).alias("plain"))


@query("SELECT p_partkey, p_name || ' ' || p_brand AS plain FROM part")
def emphasis(t):
    return t.part.select("p_partkey", udfs.plain_text(F.concat(F.lit("''"), "p_name", F.lit("'' '''"), "p_brand", F.lit("'''"))).alias("plain"))


@query("""SELECT doc_id, w AS form, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[a-z0-9_]+')) AS w FROM documents WHERE NOT regexp_matches(text, '[^\\x00-\\x7F]')) WHERE w IN ('the', 'of', 'and', 'is') GROUP BY ALL""")
def form_counts(t):
    plain = t.documents.where(~F.col("text").rlike(r"[^\x00-\x7F]"))
    found = plain.select("doc_id", F.explode(udfs.form_counts("text", F.array(*map(F.lit, ("the", "of", "and", "is"))))).alias("form", "n"))
    return found.select("doc_id", "form", F.col("n").cast("long").alias("n"))


@query("""SELECT doc_id, md5(lower(regexp_replace(CASE WHEN regexp_matches(k, '[^.]\\.$') THEN substr(k, 1, length(k) - 1) ELSE k END, ' +$', ''))) AS key FROM (SELECT doc_id, regexp_replace(regexp_replace(text, '[ \\t\\n\\r]+', ' ', 'g'), '^ | $', '', 'g') AS k FROM documents WHERE NOT regexp_matches(text, '[^\\x00-\\x7F]'))""")
def document_keys(t):
    plain = t.documents.where(~F.col("text").rlike(r"[^\x00-\x7F]"))
    return plain.select("doc_id", F.md5(udfs.heading_key("text")).alias("key"))


@query("SELECT p_partkey, lower(p_type) AS k1, lower(p_name) || '..' AS k2 FROM part")
def gloss_key(t):
    return t.part.select("p_partkey", udfs.heading_key(F.concat(F.lit("  "), F.replace("p_type", F.lit(" "), F.lit("   ")), F.lit(". "))).alias("k1"), udfs.heading_key(F.concat("p_name", F.lit(".."))).alias("k2"))


@query("SELECT p_partkey, upper(substr(p_name, 1, 1)) || substr(p_name, 2) || '.' AS s1, 'Is it?' AS s2, '' AS s3 FROM part")
def statement_case(t):
    return t.part.select("p_partkey", udfs.clean_gloss(F.concat(F.lit(" "), "p_name", F.lit(" ;"))).alias("s1"), udfs.clean_gloss(F.lit("is it?")).alias("s2"), udfs.clean_gloss(F.lit("--")).alias("s3"))


@query("SELECT CASE WHEN contains(w, ' ') THEN 'Multiword' WHEN regexp_matches(w, '[''’]') THEN 'Apostrophe' WHEN contains(w, '-') THEN 'Hyphenated' WHEN regexp_matches(w, '[^\\x00-\\x7F]') THEN 'Non-ASCII' ELSE 'Plain' END AS shape, count(*) AS n FROM (SELECT unnest(string_split(text, '.')) AS w FROM documents UNION ALL SELECT unnest(string_split(text, ' ')) FROM documents) GROUP BY 1")
def headword_shape(t):
    words = t.documents.select(F.explode(F.split("text", r"\.", -1)).alias("w")).unionByName(t.documents.select(F.explode(F.split("text", " ", -1)).alias("w")))
    return reports.histogram(words, udfs.headword_shape("w"), "shape")


@query("SELECT o_orderkey, year(o_orderdate) AS y FROM orders")
def year_extract(t):
    return t.orders.select("o_orderkey", udfs.year_of(F.concat(F.lit("no. 123456, the "), F.year("o_orderdate").cast("string"), F.lit("s, 1822"))).cast("long").alias("y"))


@query("""SELECT CASE WHEN turn % 5 = 0 THEN 'Lemmatizer only' WHEN turn % 5 = 1 THEN 'Bold only' WHEN turn % 5 = 2 THEN 'Exact agreement' WHEN turn % 5 = 3 THEN 'Overlapping proposals' ELSE 'Disagreement' END AS relation, count(*) AS n FROM conversations GROUP BY 1""")
def source_agreement(t):
    at = lambda a, b, source: F.struct(F.lit(a).alias("start"), F.lit(b).alias("end"), F.array(F.lit(source)).alias("sources"))
    k = F.col("turn") % 5
    own, bold = at(0, 4, "lemmatizer"), at(0, 4, "bold")
    spans = F.when(k == 0, F.array(own)).when(k == 1, F.array(bold)).when(k == 2, F.array(own, bold)).when(k == 3, F.array(own, at(2, 6, "bold"))).otherwise(F.array(own, at(9, 12, "bold")))
    return reports.histogram(t.conversations, udfs.merged_ranges(spans)["relation"], "relation")


@query("SELECT p_partkey FROM part WHERE p_size % 3 = 0")
def balanced_delimiters(t):
    shape = F.when(F.col("p_size") % 3 == 0, F.concat(F.lit("(["), "p_name", F.lit("])"))).when(F.col("p_size") % 3 == 1, F.concat(F.lit("(["), "p_name", F.lit(")]"))).otherwise(F.concat("p_name", F.lit("(")))
    return t.part.where(udfs.balanced(shape)).select("p_partkey")


@query("""SELECT o_orderkey, count(DISTINCT l_linenumber) = 1 AS valid FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey""")
def valid_decisions(t):
    """Each line of an order links the order's one table, so that an order with another line number breaks one-to-one."""
    link = F.struct(F.lit("t").alias("target_id"), F.lit("translation").alias("relation"), F.lit("r").alias("reason"))
    made = F.collect_list(F.struct(F.col("l_linenumber").cast("string").alias("source_id"), F.array(link).alias("links")))
    grouped = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).groupBy("o_orderkey").agg(made.alias("d"))
    return grouped.select("o_orderkey", udfs.valid_decisions(F.lit("translations"), "d", F.transform("d", lambda x: x["source_id"]), F.array(F.lit("t"))).alias("valid"))


@query("""SELECT p_partkey, round(CASE WHEN a >= 2 AND c >= 0.85 * a AND c >= 0.3 * b THEN greatest(2.0 * c / (a + b), 0.7 + 0.2 * c / b) ELSE 2.0 * c / (a + b) END, 9) AS similarity
    FROM (SELECT p_partkey, len(string_split(p_name, ' ')) AS a, len(string_split(p_name || ' ' || p_type, ' ')) AS b, len(string_split(p_name, ' ')) AS c FROM part)""")
def covered_similarity(t):
    words = F.split("p_name", " ", -1)
    return t.part.select("p_partkey", F.round(udfs.similar_words(words, F.concat(words, F.split("p_type", " ", -1))), 9).alias("similarity"))


# Without SQL: Python kernels and whole dataflows, which the tests hold against plain versions


def raw_entries(t: Tables) -> DataFrame:
    """Documents as raw entries: the first word is headword, a sense a document with its text as gloss, all lines as examples."""
    example = lambda line: F.struct(line.alias("text"), F.lit(None).cast("string").alias("ref"), F.lit("example").alias("type"), F.lit(None).cast("array<array<int>>").alias("bold_text_offsets"))
    none, words = F.array().cast("array<string>"), F.split("text", " ", 6)
    sense = F.struct(
        F.array("text").alias("glosses"), F.array("lang").alias("tags"), none.alias("topics"), none.alias("wikidata"),
        F.transform(F.split("text", "\n", -1), example).alias("examples"), F.array().cast("array<struct<word:string>>").alias("alt_of"), F.array(F.struct(F.get(words, F.lit(1)).alias("word"))).alias("synonyms"),
    )
    translation = F.struct(F.get(words, F.lit(2)).alias("word"), F.col("lang").alias("lang_code"), F.upper("lang").alias("lang"), F.get(words, F.lit(0)).alias("sense"))
    ordinal = F.struct(F.lit("").alias("file"), F.lit(0).cast("long").alias("block"), F.col("doc_id").alias("place"))
    return t.documents.select(
        ordinal.alias("ord"), F.get(words, F.lit(0)).alias("word"), F.when(F.col("doc_id") % 3 == 0, "name").otherwise("noun").alias("pos"), F.lit("en").alias("lang_code"), F.lit("1").alias("etymology_number"),
        F.array().cast("array<struct<form:string,tags:array<string>>>").alias("forms"), F.array(translation).alias("translations"), F.array(sense).alias("senses"),
    )


@query()
def sense_ids(t):
    return t.part.select("p_partkey", udfs.sense_id("p_name", F.lit("noun"), F.lit("1"), F.array("p_type", "p_brand")).alias("sense_id"))


@query()
def token_similarity(t):
    return t.part.select("p_partkey", udfs.similarity("p_name", "p_type").alias("similarity"))


@query()
def latexize(t):
    return t.part.select("p_partkey", udfs.tex(F.concat(F.lit("x \u2208 \u211d, "), "p_name")).alias("tex"))


@query()
def templates(t):
    markup = F.concat(F.lit("{{t|fr|"), "p_name", F.lit("|{{l|en|"), "p_brand", F.lit("}}}} and {{q|"), "p_type", F.lit("}}"))
    return t.part.select("p_partkey", F.array_join(udfs.template_names(markup), "|").alias("names"))


@query()
def clean_translations(t):
    found = udfs.clean_translation(F.lit("fr"), F.concat("p_name", F.lit(" m / "), "p_brand", F.lit(" f (dated)")))
    return t.part.select("p_partkey", F.array_join(found["words"], "|").alias("words"))


@query()
def clean_glosses(t):
    return lines(t).select("doc_id", "n", udfs.clean_gloss("line").alias("gloss"))


@query()
def plain_pages(t):
    return t.pages.select("page_id", udfs.plain_text("html").alias("plain"))


@query()
def collect_lemmas(t):
    found = collect.collect(raw_entries(t))
    return found.select("id", "lemma", "pos", F.size("senses").alias("n_senses"), F.size("translation_tables").alias("n_tables"), F.to_json("senses").alias("senses"))


@query()
def align_stub(t):
    lemmas = collect.collect(raw_entries(t))
    cache = t.spark.createDataFrame([], align.DECISION)
    return align.decide(align.translation_queries(lemmas), cache, "translations")
