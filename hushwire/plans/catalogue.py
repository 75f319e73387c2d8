"""All queries of the engine with the SQL that checks them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hushwire import ports, workers
from hushwire.functions import patterns as P
from hushwire.functions import text as T
from hushwire.functions.distance import distances, rate
from hushwire.operators import audio, blocks, consensus, entities, files, reports, spans, state
from hushwire.operators import words as timed
from hushwire.plans import views
from hushwire.sources import io, store
from hushwire.streaming import resume

QUERIES: dict = {}
ORACLE_SQL: dict = {}
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def query(name: str, oracle: str | None = None):
    def add(f):
        QUERIES[name] = f
        if oracle:
            ORACLE_SQL[name] = oracle
        return f

    return add


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def view(spark: SparkSession, d: str, sql: str, name: str, **fill: str) -> DataFrame:
    """A derived table: its SQL over the one table it names."""
    text = sql.format(**fill).replace("{", "{{").replace("}", "}}")
    return spark.sql(text.replace(f"FROM {name}", "FROM {t}"), t=table(spark, d, name))


#: Rows of a task of pattern work: short texts, a millisecond or two each.
PII_ROWS = 10_000


def pii(spark, d):
    # the table is one small file: its keys are spread by their number before the texts are made and searched
    keys = table(spark, d, "customer").select("c_custkey")
    keys = keys.repartition(max(8, -(-keys.count() // PII_ROWS)), "c_custkey")
    return spark.sql(views.PII_TEXT.replace("FROM customer", "FROM {t}"), t=keys)


def asr(spark, d):
    return view(spark, d, views.ASR, "conversations", g="")


def span_rows(spark, d):
    return view(spark, d, views.SPANS, "lineitem", end="end")


def calls(spark, d):
    return view(spark, d, views.CALLS, "documents")


PII, ASR, SPANS, CALLS, STATUS = (f"({x})" for x in (views.PII_TEXT, views.ASR.format(g=", 'g'"), views.SPANS.format(end="stop"), views.CALLS, views.STATUS))


#: All documents, as the pattern queries name their columns.
DOCS = "(SELECT doc_id AS id, text FROM documents)"


def sql(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# ---- patterns


def offsets_sql(pattern: str, group: int, source: str, where: str = "") -> str:
    p = sql(pattern)
    return f"""WITH a AS (SELECT id, regexp_extract_all(text, {p}, 0) AS m, regexp_extract_all(text, {p}, {group}) AS g, string_split_regex(text, {p}) AS s FROM {source} v),
    b AS (SELECT id, m, g, s, unnest(range(1, len(m) + 1)) AS i FROM a),
    c AS (SELECT id, g[i] AS text, CAST(list_sum(list_transform(s[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i], lambda x: length(x))), 0) - length(g[i]) AS INT) AS "start" FROM b)
    SELECT id, text, "start", CAST("start" + length(text) AS INT) AS "end" FROM c {where}"""


#: Patterns that both engines read: pattern, group and what a match must fulfil, by name.
ON_TEXTS: dict = {}


def _pattern_query(name: str, pattern: str, group: int) -> None:
    where = ""
    if name == "card":
        where = "WHERE length(regexp_replace(text, '[^0-9]', '', 'g')) BETWEEN 13 AND 19"
    if name == "id":
        where = "WHERE length(regexp_replace(text, '[^A-Za-z0-9]', '', 'g')) >= 4 AND regexp_matches(text, '[0-9]')"

    def run(spark, d, name=name):
        return pii(spark, d).select("id", F.inline(entities.rule_entities("text", name))).select("id", "text", "start", "end")

    QUERIES[f"rx_{name}"] = run
    if name != "phone":  # its look-behind has no form there; see rx_phone below
        ORACLE_SQL[f"rx_{name}"] = offsets_sql(pattern, group, PII, where)
        ON_TEXTS[name] = (pattern, group, where)


for _d in P.DETECTORS:
    _pattern_query(_d[0], _d[1], _d[2])


def _patterns_sql(source: str) -> str:
    return " UNION ALL ".join(f"(SELECT '{n}' AS kind, * FROM ({offsets_sql(p, g, source, where)}) o)" for n, (p, g, where) in ON_TEXTS.items())


def every_pattern(texts: DataFrame) -> DataFrame:
    """What each pattern finds in whole texts (id, text), in one pass over them."""
    found = entities.scanned(texts.select("id", F.col("text").alias("_text")), "_text", tuple(ON_TEXTS))
    return found.select(F.col("rule").alias("kind"), "id", "text", "start", "end")


@query("document_patterns", _patterns_sql(DOCS))
def document_patterns(spark, d):
    return every_pattern(table(spark, d, "documents").select(F.col("doc_id").alias("id"), "text"))


@query("page_patterns", _patterns_sql("(SELECT page_id AS id, html AS text FROM pages)"))
def page_patterns(spark, d):
    return every_pattern(table(spark, d, "pages").select(F.col("page_id").alias("id"), F.col("html").alias("text")))


ORACLE_SQL["rx_phone_texts"] = rf"""SELECT id, unnest(regexp_extract_all(text, '(?:^|\D)((?:\+?\d{{1,3}}[-.\s]?)?(?:\(?\d{{3}}\)?[-.\s]?)?\d{{3}}[-.\s]?\d{{4}})(?:\D|$)', 1)) AS text
  FROM (SELECT id, substr(text, strpos(text, ' call '), 20) AS text FROM {PII} v) w"""


@query("rx_phone_texts", ORACLE_SQL["rx_phone_texts"])
def rx_phone_texts(spark, d):
    t = pii(spark, d).select("id", F.expr("substr(text, instr(text, ' call '), 20)").alias("text"))
    return t.select("id", F.inline(entities.rule_entities("text", "phone"))).select("id", "text")


_NAMES = " UNION ALL ".join(
    f"SELECT id, unnest(regexp_extract_all(text, {sql(rf'(?i)\b{lead}\s+{P.NAME}(?:\s+(?:{stops})\b|[.,;!?]|$)')}, 1)) AS text FROM {PII} v" for lead, stops in P.NAMES
)


@query("rule_names", f"SELECT id, text FROM ({_NAMES}) n WHERE NOT list_has_any(string_split(lower(text), ' '), [{', '.join(map(sql, P.NAME_BLACKLIST))}])")
def rule_names(spark, d):
    return pii(spark, d).select("id", F.inline(entities.name_entities("text"))).select("id", "text")


@query("entity_totals")
def entity_totals(spark, d):
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("id"), "text")
    found = entities.detect(docs, "id")
    return found.groupBy("type").agg(F.count("*").alias("n"), F.count_distinct("id").alias("docs"))


@query("detect_all")
def detect_all(spark, d):
    return entities.detect(pii(spark, d), "id")


_WORDS = ", ".join(f"({sql(w)}, {sql(n)})" for w, n in P.NUMBER_WORDS.items())
_SPOKEN = rf"""WITH toks AS (SELECT id, text, i, regexp_replace(lower(m[i]), '[^a-z0-9]+', '', 'g') AS norm, list_sum(list_transform(s[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i-1], lambda x: length(x))), 0) AS a, length(m[i]) AS n
   FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM (SELECT id, text, regexp_extract_all(text, {sql(P.TOKEN)}) AS m, string_split_regex(text, {sql(P.TOKEN)}) AS s FROM {PII} v) x) y),
 w(word, digit) AS (VALUES {_WORDS}),
 f AS (SELECT t.*, w.digit IS NOT NULL OR regexp_matches(norm, '^[0-9]$') AS single, coalesce(w.digit, CASE WHEN regexp_matches(norm, '^[0-9]+$') THEN norm END) AS digits FROM toks t LEFT JOIN w ON w.word = t.norm),
 g AS (SELECT *, lag(norm) OVER o AS before, coalesce(lead(single) OVER o, false) AS next_single FROM f WINDOW o AS (PARTITION BY id ORDER BY i)),
 h AS (SELECT *, norm IN ('dash', 'hyphen', 'minus', 'space', 'spaces') OR (norm IN ('double', 'triple') AND next_single) OR digits IS NOT NULL AS ok,
   coalesce(length(digits) * CASE WHEN single AND before = 'double' THEN 2 WHEN single AND before = 'triple' THEN 3 ELSE 1 END, 0) AS k FROM g),
 r AS (SELECT *, sum(CASE WHEN ok THEN 0 ELSE 1 END) OVER (PARTITION BY id ORDER BY i) AS run FROM h),
 z AS (SELECT id, any_value(text) AS text, min(a) AS a, max(a + n) AS b, sum(k) AS k FROM r WHERE ok GROUP BY id, run HAVING sum(k) >= 7)
 SELECT id, substr(text, CAST(a + 1 AS BIGINT), CAST(b - a AS BIGINT)) AS text, CASE WHEN k >= 10 THEN 'PHONE' ELSE 'ID_NUMBER' END AS type, CAST(a AS INT) AS "start", CAST(b AS INT) AS "end" FROM z
 WHERE k >= 10 OR regexp_matches(lower(substr(text, CAST(greatest(0, a - 100) + 1 AS BIGINT), CAST(b + 100 - greatest(0, a - 100) AS BIGINT))), '{P.NUMBER_HINTS}')"""


@query("spoken_numbers", _SPOKEN)
def spoken_numbers(spark, d):
    return entities.spoken_numbers(pii(spark, d), "id", "text").select("id", "text", "type", "start", "end")


@query(
    "saved_json_entities",
    f"""SELECT id, substr(text, p, n) AS text, type, CAST(p - 1 AS INT) AS "start", CAST(p - 1 + n AS INT) AS "end" FROM (
      SELECT id, text, strpos(text, 'mail user' || id || '@') AS p, length('mail user' || id) AS n, 'PERSON_NAME' AS type FROM {PII} v UNION ALL
      SELECT id, text, strpos(text, '415-555-'), 12, 'PHONE' FROM {PII} v) u WHERE id % 7 <> 0""",
)
def saved_json_entities(spark, d):
    saved = F.expr("""CASE WHEN id % 14 = 0 THEN 'no json' WHEN id % 7 = 0 THEN '[]' ELSE '{"entities": [{"text": "  MAIL User' || id || ' ", "type": "first name", "category": "pii"}, {"text": "card", "type": "x", "category": "other"}, '
      || '{"text": " ", "category": "PII"}, {"text": "' || regexp_extract(text, '415-555-[0-9]+', 0) || '", "type": "phone-number", "category": "PHI"}]}' END""")
    found = pii(spark, d).withColumn("saved", saved).select("id", "text", F.explode(entities.saved_entities("text", "saved")).alias("e"))
    # a number may end an address's name too; the check is for the first place
    first = found.groupBy("id", "e.type").agg(F.min_by("e", "e.start").alias("e"))
    return first.select("id", "e.text", "e.type", "e.start", "e.end")


_LABELS = "SELECT p_partkey AS id, CASE p_partkey % 6 WHEN 0 THEN ' phone-number' WHEN 1 THEN 'Date of Birth' WHEN 2 THEN 'drug' WHEN 3 THEN '' WHEN 4 THEN NULL ELSE p_brand END AS label, CASE p_partkey % 3 WHEN 0 THEN 'b-city' WHEN 1 THEN 'I-SURNAME' ELSE 'O' END AS tag FROM part"


@query("type_normalize", f"SELECT id, CASE t WHEN 'PHONE_NUMBER' THEN 'PHONE' WHEN 'DATE_OF_BIRTH' THEN 'DOB' WHEN 'DRUG' THEN 'MEDICATION' ELSE t END AS type, CASE id % 3 WHEN 0 THEN 'LOCATION' WHEN 1 THEN 'PERSON_NAME' END AS tag FROM (SELECT id, translate(upper(trim(CASE WHEN coalesce(label, '') = '' THEN 'PII' ELSE label END)), ' -', '__') AS t FROM ({_LABELS}) a) b")
def type_normalize(spark, d):
    t = view(spark, d, _LABELS, "part")
    return t.select("id", T.normalize_type(F.col("label")).alias("type"), T.normalize_tag(F.col("tag")).alias("tag"))


# ---- text

_ASCII = "text NOT SIMILAR TO '.*[^\\x00-\\x7F].*'"
_LINES = "SELECT conv_id, turn, regexp_replace(text, '[^A-Za-z0-9 .,!?'']+', ' '{g}) AS text FROM conversations"
LINES = f"({_LINES.format(g=', ' + sql('g'))})"
_NORM = "trim(regexp_replace(regexp_replace(regexp_replace(lower(trim(text)), '\\s+', ' ', 'g'), '[^a-z0-9\\s'']+', ' ', 'g'), '\\s+', ' ', 'g'))"


def lines(spark, d):
    return view(spark, d, _LINES, "conversations", g="")


@query("normalize_text", f"SELECT conv_id, turn, {_NORM} AS norm, regexp_replace(text, '\\s+', ' ', 'g') AS collapsed, regexp_replace(lower(text), '[^a-z0-9]+', '', 'g') AS token, regexp_replace(text, '[^0-9]', '', 'g') AS digits FROM {LINES} t")
def normalize_text(spark, d):
    c = F.col("text")
    return lines(spark, d).select("conv_id", "turn", T.normalize_for_consensus(c).alias("norm"), T.collapse_space(c).alias("collapsed"), T.normalize_token(c).alias("token"), T.digits_only(c).alias("digits"))


@query(
    "tokenize_spans",
    f"""SELECT conv_id, turn, m[i] AS token, CAST(list_sum(list_transform(s[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i-1], lambda x: length(x))), 0) AS INT) AS "start"
    FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM (SELECT conv_id, turn, regexp_extract_all(text, {sql(P.TOKEN)}) AS m, string_split_regex(text, {sql(P.TOKEN)}) AS s FROM {LINES} t) a) b WHERE regexp_matches(lower(m[i]), '[a-z0-9]')""",
)
def tokenize_spans(spark, d):
    return lines(spark, d).select("conv_id", "turn", F.inline(T.tokens("text"))).select("conv_id", "turn", "token", "start")


_PAIRS = "SELECT a.file_id, a.engine AS e1, b.engine AS e2, {n}(a.transcript) AS x, {n}(b.transcript) AS y"


@query(
    "cer_jaccard",
    f"""WITH n AS (SELECT file_id, engine, {_NORM.replace("text", "transcript")} AS x FROM {ASR} t WHERE error IS NULL)
    SELECT a.file_id, a.engine AS e1, b.engine AS e2, round(levenshtein(a.x, b.x) / greatest(1, length(a.x)), 6) AS cer,
     round(CASE WHEN a.x = '' AND b.x = '' THEN 1.0 ELSE len(list_intersect(list_distinct(list_filter(string_split(a.x, ' '), lambda w: w <> '')), list_filter(string_split(b.x, ' '), lambda w: w <> ''))) / len(list_distinct(list_filter(string_split(a.x || ' ' || b.x, ' '), lambda w: w <> ''))) END, 6) AS jaccard
    FROM n a JOIN n b ON a.file_id = b.file_id""",
)
def cer_jaccard(spark, d):
    n, j = engine_pairs(spark, d)
    two = lambda a, b, x, y: F.struct(F.col(a).alias("e1"), F.col(b).alias("e2"), F.round(rate(F.col("d.chars"), F.length(x)), 6).alias("cer"), "jaccard")
    j = j.withColumn("jaccard", F.round(T.jaccard(F.col("x"), F.col("y")), 6))
    own = n.select("file_id", "e1", F.col("e1").alias("e2"), F.lit(0.0).alias("cer"), F.lit(1.0).alias("jaccard"))
    return j.select("file_id", F.inline(F.array(two("e1", "e2", "x", "y"), two("e2", "e1", "y", "x")))).unionByName(own)


def engine_pairs(spark, d):
    """Normalised texts by engine (file_id, e1, x), and every two engines of a file once, with their distances d."""
    n = asr(spark, d).where("error IS NULL").select("file_id", F.col("engine").alias("e1"), T.normalize_for_consensus(F.col("transcript")).alias("x"))
    j = n.join(n.select("file_id", F.col("e1").alias("e2"), F.col("x").alias("y")), "file_id").where("e1 < e2")
    return n, j.withColumn("d", distances(F.col("x"), F.col("y")))


@query("similarity_pairs")
def similarity_pairs(spark, d):
    n, j = engine_pairs(spark, d)
    two = lambda a, b, x, y: F.struct(F.col(a).alias("e1"), F.col(b).alias("e2"), F.round(rate(F.col("d.words"), F.size(T.words(F.col(x)))), 6).alias("wer"), F.round(T.similarity(x, y, F.col("d")), 6).alias("similarity"))
    own = n.select("file_id", "e1", F.col("e1").alias("e2"), F.lit(0.0).alias("wer"), F.lit(1.0).alias("similarity"))
    return j.select("file_id", F.inline(F.array(two("e1", "e2", "x", "y"), two("e2", "e1", "y", "x")))).unionByName(own)


_RATES = "SELECT p_partkey AS id, CASE p_partkey % 7 WHEN 0 THEN '64k' WHEN 1 THEN '96000' WHEN 2 THEN '24.5k' WHEN 3 THEN 'fast' WHEN 4 THEN '' WHEN 5 THEN ' 128K ' ELSE CAST(p_size AS STRING) END AS v, p_size FROM part"


@query("bitrate_choice", f"SELECT id, CAST(CASE WHEN n IS NULL THEN 64 ELSE greatest(1, CAST(round_even(CASE WHEN k THEN n WHEN n >= 1000 THEN n / 1000 ELSE n END, 0) AS INT)) END AS INT) AS kbps FROM (SELECT id, s LIKE '%k' AS k, TRY_CAST(CASE WHEN s LIKE '%k' THEN substr(s, 1, length(s) - 1) ELSE s END AS DOUBLE) AS n FROM (SELECT id, lower(trim(v)) AS s FROM ({_RATES}) a) b) c")
def bitrate_choice(spark, d):
    return view(spark, d, _RATES, "part").select("id", T.bitrate_kbps(F.col("v")).cast("int").alias("kbps"))


# ---- entities and spans

_ENT = "SELECT l_orderkey AS file_id, CAST(l_quantity AS INT) AS {s}, CAST(l_quantity AS INT) + l_linenumber - 1 AS {e}, CASE l_linenumber % 4 WHEN 0 THEN 'SSN' WHEN 1 THEN 'PHONE' WHEN 2 THEN 'ZIP' ELSE 'OTHER' END AS type, CASE WHEN l_linenumber % 2 = 0 THEN ' A ' ELSE 'a' END AS text, round(l_discount, 2) AS score, 'x' AS source, l_linenumber * 1000000 + l_partkey AS ord FROM lineitem"


@query("entity_dedupe", f"SELECT file_id, s AS \"start\", e AS \"end\", type, score FROM (SELECT *, row_number() OVER (PARTITION BY file_id, s, e, lower(trim(text)) ORDER BY CASE type WHEN 'SSN' THEN 1 WHEN 'PHONE' THEN 5 WHEN 'ZIP' THEN 23 ELSE 999 END, score DESC, ord) AS n FROM ({_ENT.format(s='s', e='e')}) t WHERE e > s) u WHERE n = 1")
def entity_dedupe(spark, d):
    return entities.dedupe(view(spark, d, _ENT, "lineitem", s="start", e="end"), ["file_id"]).select("file_id", "start", "end", "type", "score")


_PRIORITY = "CASE type WHEN 'SSN' THEN 1 WHEN 'PHONE' THEN 5 WHEN 'ZIP' THEN 23 ELSE 999 END"


@query(
    "entity_resolve",
    f"""WITH d AS (SELECT * FROM (SELECT *, {_PRIORITY} AS p, row_number() OVER (PARTITION BY file_id, s, e, lower(trim(text)) ORDER BY {_PRIORITY}, score DESC, ord) AS n FROM ({_ENT.format(s='s', e='e')}) t WHERE e > s) u WHERE n = 1),
    l AS (SELECT file_id, list([struct_pack(a := s, b := e, p := p, score := score, ord := ord, type := type, text := text, source := source)] ORDER BY s, e DESC, p, score DESC, ord) AS es FROM d GROUP BY file_id),
    f AS (SELECT file_id, unnest(list_reduce(es, lambda kept, x: CASE WHEN len(list_filter(kept, lambda k: k.a < x[1].b AND x[1].a < k.b)) = 0 THEN kept || x
      ELSE list_transform(kept, lambda k, i: CASE WHEN i = list_position(list_transform(kept, lambda q: q.a < x[1].b AND x[1].a < q.b), true)
        AND (x[1].p < k.p OR (x[1].p = k.p AND (x[1].score > k.score OR (x[1].score = k.score AND x[1].b - x[1].a > k.b - k.a)))) THEN x[1] ELSE k END) END)) AS r FROM l)
    SELECT file_id, r.text AS text, r.type AS type, r.a AS "start", r.b AS "end", r.score AS score, r.source AS source FROM f""",
)
def entity_resolve(spark, d):
    return entities.resolve(entities.dedupe(view(spark, d, _ENT, "lineitem", s="start", e="end"), ["file_id"]), ["file_id"])


def _merge_sql(both: bool) -> str:
    ch = "-1" if both else "channel"
    return f"""WITH s AS (SELECT file_id, CAST({ch} AS INT) AS channel, start, stop, duration, type, text, source, ord FROM {SPANS} t),
    a AS (SELECT *, max(stop) OVER (PARTITION BY file_id, channel ORDER BY start, stop, ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS far FROM s),
    b AS (SELECT *, sum(CASE WHEN far IS NULL OR start > far + 0.05 THEN 1 ELSE 0 END) OVER w AS island, row_number() OVER w AS pos FROM a WINDOW w AS (PARTITION BY file_id, channel ORDER BY start, stop, ord)),
    c AS (SELECT *, row_number() OVER (PARTITION BY file_id, channel, island ORDER BY pos) AS k FROM b)
    SELECT file_id, channel, min(start) AS "start", max(stop) AS "end", count(*) AS n, min_by(type, pos) AS type, string_agg(DISTINCT type, ',' ORDER BY type) AS types,
     string_agg(DISTINCT source, ',' ORDER BY source) AS sources, string_agg(text, '|' ORDER BY pos) FILTER (WHERE k = 1 OR text <> '') AS texts,
     round(CASE WHEN count(*) > 1 THEN max(stop) - min(start) ELSE min_by(duration, pos) END, 6) AS duration FROM c GROUP BY file_id, channel, island"""


def _merged(spark, d, both):
    m = spans.merge_spans(span_rows(spark, d), both=both)
    return m.select("file_id", F.col("channel").cast("int").alias("channel"), "start", "end", "n", "type", "types", "sources", "texts", F.round("duration", 6).alias("duration"))


@query("merge_spans_channel", _merge_sql(False))
def merge_spans_channel(spark, d):
    return _merged(spark, d, False)


@query("merge_spans_both", _merge_sql(True))
def merge_spans_both(spark, d):
    return _merged(spark, d, True)


_W = "SELECT o_orderkey AS file_id, o_orderkey % 7 AS k, 60.0 AS duration FROM orders"
_TIMED = "SELECT file_id, k, duration, i, i * 0.4 AS w_start, i * 0.4 + 0.3 AS w_end, i * 6 AS start_char, i * 6 + 5 AS end_char FROM ({w}) o CROSS JOIN (SELECT 0 AS i UNION ALL SELECT 1 UNION ALL SELECT 2 UNION ALL SELECT 3 UNION ALL SELECT 4 UNION ALL SELECT 5) n"
_ENTS = "SELECT file_id, k * 6 + 2 AS s, k * 6 + 2 + k AS e, 'e' || k AS text, k AS ord FROM ({w}) o"


#: Orders of a task, of six words and one entity each.
ORDER_ROWS = 100_000


def placed(spark, d):
    """Entities with the times of the words that they overlap; keys are spread by their number before words are made."""
    keys = table(spark, d, "orders").select("o_orderkey")
    tasks = max(8, -(-keys.count() // ORDER_ROWS))
    orders = {"t": keys.repartition(tasks, "o_orderkey")}
    w = spark.sql(_TIMED.format(w=_W).replace("FROM orders", "FROM {t}"), **orders).selectExpr("file_id", "CAST(duration AS DOUBLE) duration", "CAST(w_start AS DOUBLE) w_start", "CAST(w_end AS DOUBLE) w_end", "start_char", "end_char")
    e = spark.sql(_ENTS.format(w=_W).replace("FROM orders", "FROM {t}"), **orders).withColumnsRenamed({"s": "start", "e": "end"})
    return spans.entity_spans(e, w, ["file_id"], tasks=tasks)


@query(
    "entity_word_overlap",
    f"""WITH w AS ({_TIMED.format(w=_W)}), e AS ({_ENTS.format(w=_W)}), j AS (SELECT e.file_id, e.text, min(w_start) AS a, max(w_end) AS b, 60.0 AS d FROM e LEFT JOIN w ON w.file_id = e.file_id AND w.end_char > e.s AND w.start_char < e.e GROUP BY e.file_id, e.text),
    p AS (SELECT *, greatest(0, a - 0.12) AS lo, least(d, b + 0.12) AS hi FROM j), q AS (SELECT *, CASE WHEN a IS NULL THEN NULL WHEN hi - lo < 0.3 THEN greatest(0, (lo + hi) / 2 - 0.15) ELSE lo END AS st FROM p)
    SELECT file_id, text, CAST(round(st, 6) AS DOUBLE) AS start_sec, CAST(round(CASE WHEN a IS NULL THEN NULL WHEN hi - lo < 0.3 THEN least(d, st + 0.3) ELSE hi END, 6) AS DOUBLE) AS end_sec FROM q""",
)
def entity_word_overlap(spark, d):
    return placed(spark, d).select("file_id", "text", F.round("start_sec", 6).alias("start_sec"), F.round("end_sec", 6).alias("end_sec"))


@query(
    "unmapped_entities",
    f"""SELECT file_id, CAST(60.0 AS DOUBLE) AS end_sec, substr(string_agg(text, ' | ' ORDER BY ord), 1, 500) AS text FROM ({_ENTS.format(w=_W)}) e
    WHERE NOT EXISTS (SELECT 1 FROM ({_TIMED.format(w=_W)}) w WHERE w.file_id = e.file_id AND w.end_char > e.s AND w.start_char < e.e) GROUP BY file_id""",
)
def unmapped_entities(spark, d):
    return spans.unmapped_spans(placed(spark, d).where("start_sec IS NULL"), ["file_id"]).select("file_id", "end_sec", "text")


@query("failsafe_spans", f"SELECT file_id, CAST(unnest(range(0, greatest(1, least(CASE WHEN channels = 0 THEN 2 ELSE channels END, 2)))) AS INT) AS channel, CAST(greatest(0, duration) AS DOUBLE) AS end_sec FROM {CALLS} t")
def failsafe_spans(spark, d):
    return spans.failsafe_spans(calls(spark, d).withColumn("duration", F.col("duration").cast("double"))).select("file_id", "channel", "end_sec")


# ---- consensus


@query("consensus_full")
def consensus_full(spark, d):
    return consensus.consensus(asr(spark, d), "alpha", ["alpha", "beta", "gamma", "delta"])


@query(
    "consensus_majority",
    f"""WITH n AS (SELECT file_id, channel, engine, engine_ord, {_NORM.replace("text", "transcript")} AS x FROM {ASR} t WHERE error IS NULL), g AS (SELECT file_id, x, count(*) AS n, max(engine = 'alpha') AS has, min(engine_ord) AS o FROM n WHERE x <> '' GROUP BY file_id, x),
    r AS (SELECT *, row_number() OVER (PARTITION BY file_id ORDER BY n DESC, has DESC, length(x) DESC, o) AS k FROM g) SELECT file_id, n AS agreement_count FROM r WHERE k = 1 AND n >= 3""",
)
def consensus_majority(spark, d):
    return consensus_full(spark, d).where("method = 'strict_majority'").select("file_id", "agreement_count")


@query("detection_items", f"""WITH f AS (SELECT file_id, 'final_consensus' AS source, transcript AS text, 0 AS o FROM {ASR} t WHERE engine_ord = 0 UNION ALL SELECT file_id, 'engine:' || engine, transcript, engine_ord + 1 FROM {ASR} t WHERE error IS NULL)
  SELECT file_id, source, trim(text) AS text FROM f WHERE trim(text) <> ''""")
def detection_items(spark, d):
    a = asr(spark, d)
    b = a.groupBy("file_id", "channel").agg(F.max(F.when(F.col("engine_ord") == 0, F.col("transcript"))).alias("final"), F.array_sort(F.collect_list(F.struct("engine_ord", "engine", F.col("transcript").alias("text"), "error"))).alias("engines"))
    return reports.detection_items(b).select("file_id", "source", "text")


# ---- files


@query("discover_exclude", f"SELECT file_id, path FROM {CALLS} t WHERE NOT starts_with(path, '/calls/src1/') AND path NOT LIKE '%/tmp/%'")
def discover_exclude(spark, d):
    return files.exclude(calls(spark, d), ["/calls/src1"], ["*/tmp/*"], "/calls").select("file_id", "path")


@query("shard_limit", f"SELECT path FROM (SELECT path, row_number() OVER (ORDER BY path) - 1 AS i FROM {CALLS} t) u WHERE i % 3 = 1 ORDER BY path LIMIT 50")
def shard_limit(spark, d):
    return files.shard(calls(spark, d).select("path"), 3, 1, 50).select("path")


@query("micro_batches", f"SELECT path, (row_number() OVER (ORDER BY path) - 1) // 8 AS batch FROM {CALLS} t")
def micro_batches(spark, d):
    return files.micro_batches(calls(spark, d).select("path"), 8).select("path", "batch")


@query("expected_channels", f"SELECT file_id, CAST(unnest(range(0, least(2, greatest(1, channels)))) AS INT) AS channel FROM {CALLS} t")
def expected_channels(spark, d):
    return calls(spark, d).select("file_id", F.explode(files.expected_channels(F.col("channels"))).alias("channel"))


@query("format_check", f"SELECT file_id, lower(codec) = 'opus' AND rate = 48000 AND channels = 2 AS ok FROM {CALLS} t")
def format_check(spark, d):
    return calls(spark, d).select("file_id", files.required_format(F.col("codec"), F.col("rate"), F.col("channels")).alias("ok"))


@query("strategy_route", f"SELECT file_id, CASE WHEN duration > 5000 THEN 'too_long' WHEN duration > 1800 THEN 'temp_wav' ELSE 'single_decode' END AS strategy FROM {CALLS} t")
def strategy_route(spark, d):
    return calls(spark, d).select("file_id", files.strategy(F.col("duration"), 5000.0).alias("strategy"))


_OUT = "'/out/' || regexp_replace(substr(path, 8), '\\.[^./]+$', '') || '.opus'"


@query("output_paths", f"SELECT file_id, {_OUT} AS out_path, {_OUT} || '.json' AS sidecar, CASE WHEN file_id % 2 = 0 THEN '/calls/' || regexp_replace(substr(path, 8), '\\.[^./]+$', '') || '.opus' END AS beside FROM {CALLS} t")
def output_paths(spark, d):
    c = calls(spark, d).withColumn("other", F.when(F.col("file_id") % 2 == 0, F.col("path")).otherwise(F.regexp_replace("path", r"\.wav$", ".opus")))
    out = files.output_path(F.col("path"), "/calls", "/out")
    # an output below the input root is refused where it is the input
    return c.select("file_id", out.alias("out_path"), files.sidecar_path(out).alias("sidecar"), files.output_path(F.col("other"), "/calls", "/calls").alias("beside"))


@query("decoded_gb_guard", f"SELECT file_id % 50 AS grp, CASE WHEN count(*) = count(duration) THEN round(CAST(sum(duration) AS DOUBLE) * 48000 * 2 * 4 / 1073741824, 6) END AS gb FROM {CALLS} t GROUP BY 1")
def decoded_gb_guard(spark, d):
    g = files.decoded_gb(calls(spark, d).withColumn("grp", F.col("file_id") % 50), ["grp"])
    return g.select("grp", F.round(F.col("gb").cast("double"), 6).alias("gb"))


_ADAPT = "SELECT p_partkey AS id, CAST(p_size AS BIGINT) AS size, CAST(p_partkey % 16 AS DOUBLE) AS free FROM part"


@query("adaptive_sizes", f"SELECT id, CAST(CASE WHEN free < 8 AND size > 2 THEN greatest(2, size // 2) ELSE size END AS BIGINT) AS shrunk, CAST(CASE WHEN free >= 8 THEN least(32, greatest(size + 1, 2 * size)) ELSE size END AS BIGINT) AS recovered FROM ({_ADAPT}) t")
def adaptive_sizes(spark, d):
    t = view(spark, d, _ADAPT, "part")
    size, free = F.col("size"), F.col("free")
    return t.select("id", files.shrunk(size, free, 8.0, 2).cast("long").alias("shrunk"), files.recovered(size, F.lit(32), free, 8.0).cast("long").alias("recovered"))


_PROBE = """SELECT doc_id AS id, '{{"streams": [{{"codec_name": "opus", "sample_rate": "' || CASE WHEN doc_id % 5 = 0 THEN '48000.0' ELSE '48000' END || '", "channels": ' || (doc_id % 3) || ', "duration": "' || CASE WHEN doc_id % 4 = 0 THEN '0.0' ELSE CAST(n_chars AS STRING) || '.5' END || '"}}], "format": {{"duration": "7.25", "bit_rate": "64000", "format_name": "ogg"}}}}' AS j FROM documents"""


@query("probe_json_parse", f"SELECT id, CASE WHEN id % 5 <> 0 THEN 48000 END AS sample_rate, id % 3 AS channels, CASE WHEN id % 4 = 0 THEN 7.25 ELSE CAST(j ->> '$.streams[0].duration' AS DOUBLE) END AS duration, CAST(j ->> '$.format.bit_rate' AS BIGINT) AS bit_rate FROM ({_PROBE.format()}) t".replace("7.25 ELSE", "CAST(7.25 AS DOUBLE) ELSE").replace("THEN 48000 END", "THEN CAST(48000 AS BIGINT) END"))
def probe_json_parse(spark, d):
    return files.probed(view(spark, d, _PROBE, "documents"), "j").select("id", "sample_rate", "channels", "duration", "bit_rate")


@query("validate_outputs", f"SELECT file_id, file_id % 5 <> 0 AND lower(codec) = 'opus' AND rate = 48000 AND channels = 2 AND coalesce(abs((duration + (file_id % 3) * 0.15) - duration) <= 0.2, true) AS valid FROM {CALLS} t")
def validate_outputs(spark, d):
    t = calls(spark, d).withColumns(
        {"out_bytes": F.expr("CASE WHEN file_id % 5 <> 0 THEN file_id END"), "out_codec": F.col("codec"), "out_rate": F.col("rate"), "out_channels": F.col("channels"), "out_duration": F.expr("duration + (file_id % 3) * 0.15")}
    )
    return files.validated(t).select("file_id", "valid")


@query("error_rows", f"SELECT file_id, engine, '' AS transcript, CASE WHEN error IS NULL THEN 'Error' ELSE string_split(error, ':')[1] END AS error FROM {ASR} t WHERE transcript IS NULL")
def error_rows(spark, d):
    return asr(spark, d).where("transcript IS NULL").select("file_id", "engine", F.lit("").alias("transcript"), files.short_error(F.col("error")).alias("error"))


# ---- state and reports


@query("upsert_status", f"SELECT file_id, updated_at, status, valid FROM (SELECT *, row_number() OVER (PARTITION BY file_id ORDER BY updated_at % 2 DESC, updated_at DESC) AS n FROM {STATUS} t) u WHERE n = 1")
def upsert_status(spark, d):
    s = view(spark, d, views.STATUS, "orders")
    return state.upsert(s.where("updated_at % 2 = 0"), s.where("updated_at % 2 = 1"), ["file_id"], ["updated_at"])


@query("cache_complete", f"SELECT file_id FROM {ASR} t WHERE error IS NULL AND channel < 1 GROUP BY file_id HAVING count(DISTINCT engine) = 4")
def cache_complete(spark, d):
    return state.complete_files(asr(spark, d), ["alpha", "beta", "gamma", "delta"], 1, with_errors=False)


@query("missing_work", f"SELECT DISTINCT f.file_id, e.engine, 0 AS channel FROM {ASR} f CROSS JOIN (SELECT DISTINCT engine FROM {ASR} t) e WHERE NOT EXISTS (SELECT 1 FROM {ASR} r WHERE r.file_id = f.file_id AND r.engine = e.engine AND r.error IS NULL)")
def missing_work(spark, d):
    a = asr(spark, d)
    f = a.select("file_id").distinct().withColumn("channel_list", F.array(F.lit(0)))
    engines = spark.createDataFrame([("alpha",), ("beta",), ("gamma",), ("delta",)], "engine string")
    return state.missing_work(f, engines, a).select("file_id", "engine", "channel")


@query("resume_anti", f"SELECT c_custkey AS file_id FROM customer WHERE c_custkey NOT IN (SELECT file_id FROM {STATUS} t WHERE starts_with(status, 'success') AND valid)")
def resume_anti(spark, d):
    return state.pending(table(spark, d, "customer").select(F.col("c_custkey").alias("file_id")), view(spark, d, views.STATUS, "orders"))


_STATES = "SELECT o_custkey AS file_id, CASE o_orderkey % 5 WHEN 0 THEN 'failed' WHEN 1 THEN 'skipped_existing' WHEN 2 THEN 'success_unmapped_fallback' WHEN 3 THEN 'probe_failed' ELSE 'success' END AS status FROM orders"


@query("run_counters", f"SELECT file_id % 10 AS shard, count(*) AS processed, count(*) FILTER (WHERE starts_with(status, 'success') OR status = 'skipped_existing') AS success, count(*) FILTER (WHERE status = 'failed') AS failed, count(*) FILTER (WHERE status = 'skipped_existing') AS skipped, count(*) FILTER (WHERE status = 'success_unmapped_fallback') AS failsafe FROM ({_STATES}) t GROUP BY 1")
def run_counters(spark, d):
    return reports.run_counters(view(spark, d, _STATES, "orders").withColumn("shard", F.col("file_id") % 10), ["shard"])


@query("last_n_report", f"SELECT file_id, updated_at FROM {STATUS} t ORDER BY updated_at DESC LIMIT 100")
def last_n_report(spark, d):
    return reports.last_rows(view(spark, d, views.STATUS, "orders").select("file_id", "updated_at"), 100, "updated_at")


@query("union_header", "SELECT NULL AS acctbal, r_regionkey AS key, r_name AS name FROM region UNION ALL SELECT s_acctbal, s_suppkey, NULL FROM supplier")
def union_header(spark, d):
    r = table(spark, d, "region").select(F.col("r_regionkey").cast("long").alias("key"), F.col("r_name").alias("name"))
    return reports.union_all([r, table(spark, d, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_acctbal").alias("acctbal"))])


@query("bench_summary", """SELECT o_custkey % 20 AS run, count(*) FILTER (WHERE o_orderstatus <> 'F') AS success, count(*) FILTER (WHERE o_orderstatus = 'F') AS failed, round(sum(o_totalprice) / 3600, 4) AS audio_hours,
  round(CASE WHEN o_custkey % 20 = 0 THEN 0 ELSE count(*) / (o_custkey % 20) * 3600 END, 4) AS files_per_hour, min(least(o_totalprice, 500)) AS min_free, max(greatest(o_totalprice, 500)) AS max_free FROM orders GROUP BY 1, o_custkey % 20""")
def bench_summary(spark, d):
    o = table(spark, d, "orders").select(
        (F.col("o_custkey") % 20).alias("run"), F.when(F.col("o_orderstatus") == "F", "failed").otherwise("success").alias("status"), F.col("o_totalprice").alias("duration_sec"),
        (F.col("o_custkey") % 20).alias("elapsed_sec"), F.array("o_totalprice", F.lit(500.0)).alias("free"),
    )
    return reports.bench_summary(o, ["run"]).select("run", "success", "failed", F.round("audio_hours", 4).alias("audio_hours"), F.round("files_per_hour", 4).alias("files_per_hour"), "min_free", "max_free")


@query("stage_timing", "SELECT user_id, event_type AS stage, round(sum(value), 4) AS seconds FROM events GROUP BY 1, 2")
def stage_timing(spark, d):
    e = table(spark, d, "events").select("user_id", F.col("event_type").alias("stage"), F.col("value").alias("seconds"))
    return reports.stage_timing(e, ["user_id"]).select("user_id", F.explode("stages").alias("stage", "seconds")).withColumn("seconds", F.round("seconds", 4))


_SPOKEN_TEXTS = "SELECT doc_id AS file_id, CASE WHEN doc_id % 13 = 0 THEN '  ' WHEN doc_id % 26 = 1 THEN NULL ELSE text END AS text FROM documents UNION ALL SELECT doc_id, CASE WHEN doc_id % 39 = 0 THEN text ELSE '' END FROM documents"
_MAPPED = "SELECT l_orderkey AS file_id, l_linenumber % 5 <> 0 AS mapped FROM lineitem WHERE l_linenumber > 2"


@query(
    "finalize_status",
    f"""WITH s AS (SELECT c.*, lower(codec) = 'opus' AND rate = 48000 AS matches, EXISTS (SELECT 1 FROM ({_SPOKEN_TEXTS}) x WHERE x.file_id = c.file_id AND trim(x.text) <> '') AS spoken,
      (SELECT count(*) FROM ({_MAPPED}) m WHERE m.file_id = c.file_id) AS found, (SELECT count(*) FROM ({_MAPPED}) m WHERE m.file_id = c.file_id AND NOT mapped) AS lost FROM {CALLS} c)
    SELECT file_id, 'failed' AS status FROM s WHERE duration IS NULL AND (NOT spoken OR lost > 0)
    UNION ALL SELECT file_id, 'success_unmapped_fallback' FROM s WHERE duration IS NOT NULL AND (NOT spoken OR lost > 0)
    UNION ALL SELECT file_id, 'success' FROM s WHERE spoken AND lost = 0 AND found > 0
    UNION ALL SELECT file_id, CASE WHEN matches THEN 'success_no_pii_fast_copy' ELSE 'success_no_pii_transcoded' END FROM s WHERE spoken AND found = 0""",
)
def finalize_status(spark, d):
    c = calls(spark, d).withColumn("matches", (F.lower("codec") == "opus") & (F.col("rate") == 48000))
    texts = spark.sql(_SPOKEN_TEXTS.replace("FROM documents", "FROM {t}"), t=table(spark, d, "documents"))
    return reports.final_status(c, texts, view(spark, d, _MAPPED, "lineitem")).select("file_id", "status")


@query("engine_maps", f"SELECT file_id, engine, transcript FROM {ASR} t WHERE error IS NULL")
def engine_maps(spark, d):
    m = asr(spark, d).groupBy("file_id").agg(F.map_from_entries(F.collect_list(F.struct("engine", "transcript"))).alias("m"))
    return m.select("file_id", F.explode(F.map_filter("m", lambda k, v: v.isNotNull())).alias("engine", "transcript"))


@query("words_json_roundtrip", f"SELECT file_id, engine, length(transcript) AS n FROM {ASR} t WHERE error IS NULL")
def words_json_roundtrip(spark, d):
    t = asr(spark, d).where("error IS NULL").select("file_id", "engine", F.to_json(F.struct("transcript")).alias("j"))
    return t.select("file_id", "engine", F.length(F.from_json("j", "transcript string")["transcript"]).cast("long").alias("n"))


# ---- samples

_PCM = "SELECT l_orderkey AS id, l_linenumber AS k, l_quantity / 32 AS x, l_extendedprice AS secs FROM lineitem"


@query("sample_index", f"SELECT id, k, CAST(round_even(x * 16, 0) AS BIGINT) AS at, CAST(trunc(greatest(-1, least(1, x - 0.75)) * 32767) AS SMALLINT) AS pcm FROM ({_PCM}) t")
def sample_index(spark, d):
    t = view(spark, d, _PCM, "lineitem")
    return t.select("id", "k", audio.sample_index(F.col("x"), 16).alias("at"), audio.pcm16(F.col("x") - 0.75).alias("pcm"))


@query("peak_silence", f"""WITH a AS (SELECT id, list(x - 0.75 ORDER BY k, secs) AS xs FROM ({_PCM}) t GROUP BY id)
  SELECT id, CASE WHEN list_max(list_transform(xs, lambda v: abs(v))) = 0 THEN 1 ELSE list_max(list_transform(xs, lambda v: abs(v))) END AS peak, round(coalesce(list_sum(xs[1:1]), 0) + coalesce(list_sum(xs[4:]), 0), 6) AS total FROM a""")
def peak_silence(spark, d):
    t = view(spark, d, _PCM, "lineitem").groupBy("id").agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "secs", "x"))), lambda s: s["x"] - 0.75).alias("xs"))
    quiet = audio.silence(F.col("xs"), F.lit(1), F.lit(3))
    return t.select("id", audio.peak(F.col("xs")).alias("peak"), F.round(F.aggregate(quiet, F.lit(0.0), lambda a, v: a + v), 6).alias("total"))


@query("fade_envelope", """WITH a AS (SELECT p_partkey AS id, p_size AS n, greatest(1, least(4, CASE WHEN p_size // 2 < 1 THEN 1 ELSE p_size // 2 END)) AS f FROM part), b AS (SELECT *, unnest(range(0, n)) AS i FROM a)
  SELECT id, round(sum(CASE WHEN f <= 1 OR n <= 2 THEN 1 WHEN i < f THEN i / (f - 1) WHEN i >= n - f THEN (n - 1 - i) / (f - 1) ELSE 1 END), 6) AS total FROM b GROUP BY id""")
def fade_envelope(spark, d):
    t = table(spark, d, "part").select(F.col("p_partkey").alias("id"), F.col("p_size").alias("n"))
    return t.select("id", F.round(F.aggregate(audio.fade(F.col("n"), F.lit(4)), F.lit(0.0), lambda a, v: a + v), 6).alias("total"))


_NOISY = "SELECT id, k, x, secs, k % 4 - 1 AS channel FROM ({p}) q"


@query("mask_beep", f"""WITH a AS (SELECT id, list(x - 0.75 ORDER BY k, secs) AS xs FROM ({_PCM}) t GROUP BY id), b AS (SELECT *, CASE WHEN list_max(list_transform(xs, lambda v: abs(v))) = 0 THEN 1 ELSE list_max(list_transform(xs, lambda v: abs(v))) END AS p FROM a)
  SELECT id, round(xs[1] + CASE WHEN len(xs) > 2 THEN 0.35 * p * sin(pi() / 4) ELSE 0 END + coalesce(list_sum(xs[4:]), 0), 6) AS total FROM b""")
def mask_beep(spark, d):
    t = view(spark, d, _PCM, "lineitem").groupBy("id").agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "secs", "x"))), lambda s: s["x"] - 0.75).alias("xs"))
    return t.select("id", F.round(F.aggregate(audio.beep(F.col("xs"), F.lit(1), F.lit(3), 8000), F.lit(0.0), lambda a, v: a + v), 6).alias("total"))


def recordings(spark, d):
    t = view(spark, d, _PCM, "lineitem").groupBy("id").agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "secs", "x"))), lambda s: s["x"] - 0.75).alias("samples"))
    return t.withColumn("samples", F.flatten(F.array_repeat("samples", 12)))


@query("mask_noise")
def mask_noise(spark, d):
    t = recordings(spark, d).withColumn("spans", F.expr("array(named_struct('start', 0.001D, 'end', 0.003D))"))
    return audio.noise(t, 8000).select("id", F.size("samples").alias("n"), F.expr("round(aggregate(samples, 0D, (a, v) -> a + v), 4)").alias("total"))


@query("resample_pcm")
def resample_pcm(spark, d):
    return audio.resample(recordings(spark, d), 48000, 16000).select("id", F.size("samples").alias("n"), F.expr("round(aggregate(samples, 0D, (a, v) -> a + v), 3)").alias("total"))


@query("mono_mix_split", f"SELECT id, channel, round(sum(v), 6) AS total FROM (SELECT id, c.channel, CASE c.channel WHEN -1 THEN (x + k) / 2 WHEN 0 THEN x ELSE k END AS v FROM ({_PCM}) t CROSS JOIN (VALUES (-1), (0), (1)) c(channel)) u GROUP BY id, channel")
def mono_mix_split(spark, d):
    t = view(spark, d, _PCM, "lineitem").groupBy("id").agg(F.collect_list(F.array("x", F.col("k").cast("double"))).alias("f"))
    rows = t.select("id", "f", F.explode(F.array(F.lit(-1), F.lit(0), F.lit(1))).alias("channel"))
    own = F.when(F.col("channel") < 0, audio.mono_mix(F.col("f"))).otherwise(audio.one_channel(F.col("f"), F.greatest(F.lit(0), "channel")))
    return rows.select("id", "channel", F.round(F.aggregate(own, F.lit(0.0), lambda a, v: a + v), 6).alias("total"))


@query("target_channels", f"SELECT id, k, c.target FROM ({_NOISY.format(p=_PCM)}) t JOIN (VALUES (0), (1)) c(target) ON t.channel NOT IN (0, 1) OR t.channel = c.target")
def target_channels(spark, d):
    t = view(spark, d, _NOISY.format(p=_PCM), "lineitem")
    return t.select("id", "k", F.explode(audio.target_channels(F.col("channel").cast("int"), 2)).alias("target"))


_BITS = "SELECT p_partkey AS id, CASE WHEN p_partkey % 4 = 0 THEN 0 WHEN p_partkey % 4 = 1 THEN NULL ELSE p_size * 2500 END AS bits, 16 + p_partkey % 32 AS kbps FROM part"


@query("output_bitrate", f"SELECT id, CAST(greatest(24, CASE WHEN bits > 0 THEN round_even(bits / 1000, 0) ELSE kbps END) AS INT) AS kbps FROM ({_BITS}) t")
def output_bitrate(spark, d):
    t = view(spark, d, _BITS, "part")
    return t.select("id", audio.output_bitrate(F.col("bits"), F.col("kbps").cast("int"), 24).cast("int").alias("kbps"))


# ---- timed words

_SAID = f"""(SELECT conv_id * 1000 + turn AS file_id, 0 AS channel, unnest(string_split(text, ' ')) AS word, unnest(range(0, len(string_split(text, ' ')))) AS ord FROM {LINES} l)"""


def said(spark, d):
    t = lines(spark, d).select((F.col("conv_id") * 1000 + F.col("turn")).alias("file_id"), F.lit(0).alias("channel"), F.posexplode(F.split("text", " ")).alias("ord", "word"))
    return t.withColumns({"start": F.col("ord") * 0.4, "end": F.col("ord") * 0.4 + 0.3})


@query("canonical_words", f"""SELECT file_id, ord, word, CAST(coalesce(sum(length(word) + 1) OVER (PARTITION BY file_id ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS INT) AS start_char
  FROM {_SAID} w WHERE word <> ''""")
def canonical_words(spark, d):
    return timed.canonical_words(said(spark, d)).select("file_id", "ord", "word", "start_char")


@query("canonical_transcript", f"SELECT file_id, string_agg(word, ' ' ORDER BY ord) AS transcript, count(*) AS word_count FROM {_SAID} w WHERE word <> '' GROUP BY file_id")
def canonical_transcript(spark, d):
    return timed.canonical_transcript(said(spark, d)).select("file_id", "transcript", "word_count")


_LOOSE = "SELECT l_orderkey AS file_id, l_linenumber AS ord, l_quantity - 3 AS start, l_quantity - 3 + l_tax * 10 - 0.2 AS {e}, CASE WHEN l_linenumber = 5 THEN NULL ELSE 40.0 END AS duration FROM lineitem"


@query(
    "clamp_words",
    f"""SELECT file_id, ord, round(CASE WHEN duration IS NULL THEN start ELSE least(greatest(0, start), 40) END, 6) AS "start",
    round(CASE WHEN duration IS NULL THEN greatest(start, stop) ELSE least(greatest(start, stop, 0), 40) END, 6) AS "end",
    stop < start OR coalesce(start < -1 OR greatest(start, stop) > duration + 1, false) AS suspicious FROM ({_LOOSE.format(e="stop")}) t""",
)
def clamp_words(spark, d):
    t = view(spark, d, _LOOSE, "lineitem", e="end").withColumn("duration", F.col("duration").cast("double"))
    return timed.clamped(t).select("file_id", "ord", F.round("start", 6).alias("start"), F.round("end", 6).alias("end"), "suspicious")


_SEGMENTS = "SELECT conv_id * 1000 + turn AS file_id, 0 AS channel, turn AS segment_id, CAST(turn * 1.5 AS DOUBLE) AS a, CAST(turn * 1.5 + conv_id % 3 AS DOUBLE) AS b, text FROM ({t}) l"


@query(
    "interpolate_words",
    f"""WITH s AS (SELECT file_id, least(a, 6) AS a, least(greatest(least(a, 6), b), 6) AS b, list_filter(string_split(text, ' '), lambda w: w <> '') AS w FROM ({_SEGMENTS.format(t=LINES)}) q),
    i AS (SELECT *, greatest(0.01, b - a) AS n, unnest(w) AS word, unnest(range(0, len(w))) AS i FROM s)
    SELECT file_id, i, word, CAST(floor((a + n * i / len(w)) * 1000) AS BIGINT) AS start_ms, CAST(floor((a + n * (i + 1) / len(w)) * 1000) AS BIGINT) AS end_ms FROM i""",
)
def interpolate_words(spark, d):
    t = lines(spark, d).selectExpr("conv_id * 1000 + turn AS file_id", "0 AS channel", "turn AS segment_id", "turn * 1.5D AS start", "turn * 1.5D + conv_id % 3 AS end", "text", "6D AS duration")
    return timed.interpolated(t).select("file_id", "i", "word", F.floor(F.col("start") * 1000).alias("start_ms"), F.floor(F.col("end") * 1000).alias("end_ms"))


@query("align_words")
def align_words(spark, d):
    words = said(spark, d)
    spoken = words.where("ord % 7 <> 3").withColumn("word", F.expr("if(ord % 5 = 1, concat(word, 'x'), word)"))
    return timed.align(timed.canonical_transcript(spoken), words).select("file_id", "word", "start_char", "end_char", F.round("start", 6).alias("start"), "anchor_word")


@query("text_chunks")
def text_chunks(spark, d):
    return timed.text_chunks(table(spark, d, "documents"), "doc_id").select("doc_id", "start", F.length("chunk").alias("length"))


_PICK = "SELECT file_id, CASE WHEN file_id % 3 = 0 THEN 'gamma' ELSE 'delta' END AS selected_engine"
_HAS = "(engine_ord IN (1, 2) OR (engine_ord = 0 AND file_id % 2 = 0))"


def made_bundles(spark, d):
    r = asr(spark, d).withColumn("words", F.expr(f"if({_HAS}, array(engine), CAST(array() AS array<string>))"))
    chosen = r.where("engine = if(file_id % 3 = 0, 'gamma', 'delta')").select("file_id", "channel", F.col("engine").alias("selected_engine"), F.col("transcript").alias("final_transcript"))
    return timed.bundles(r.where("file_id % 5 = 0"), r, chosen, "alpha")


_BUNDLES = f"""(WITH r AS (SELECT *, {_HAS} AS has FROM {ASR} t), a AS (SELECT file_id, channel, min_by(engine, CASE WHEN engine = 'alpha' THEN -1 ELSE engine_ord END) FILTER (WHERE has) AS anchor_engine FROM r GROUP BY 1, 2),
   f AS (SELECT file_id, engine AS selected_engine, trim(coalesce(transcript, '')) AS final, has FROM r WHERE engine = CASE WHEN file_id % 3 = 0 THEN 'gamma' ELSE 'delta' END)
   SELECT a.file_id, a.channel, f.final AS final_transcript, f.selected_engine, a.anchor_engine, CASE WHEN f.has THEN 'selected' WHEN trim(r.transcript) = f.final THEN 'anchor' WHEN f.final <> '' THEN 'aligned' ELSE 'none' END AS words_from
   FROM a JOIN f USING (file_id) JOIN r ON r.file_id = a.file_id AND r.engine = a.anchor_engine)"""


@query("bundle_group", f"SELECT file_id, channel, final_transcript, selected_engine, anchor_engine, words_from, 4 AS n FROM {_BUNDLES} b")
def bundle_group(spark, d):
    return made_bundles(spark, d).select("file_id", "channel", "final_transcript", "selected_engine", "anchor_engine", "words_from", F.size("engine_results").alias("n"))


@query("transcript_rows", f"""SELECT file_id, 'consensus' AS engine, final_transcript AS transcript, len(list_filter(string_split(final_transcript, ' '), lambda w: w <> '')) AS word_count FROM {_BUNDLES} b
  UNION ALL SELECT file_id, engine, coalesce(transcript, ''), CASE WHEN {_HAS} THEN 1 ELSE 0 END FROM {ASR} t""")
def transcript_rows(spark, d):
    return reports.transcript_rows(made_bundles(spark, d)).select("file_id", "engine", "transcript", F.col("word_count").cast("long").alias("word_count"))


@query("cached_anchor_guard", f"SELECT g AS file_id FROM (SELECT file_id // 10 AS g, max(CASE WHEN engine = 'alpha' AND file_id % 7 <> 0 THEN 1 ELSE 0 END) AS ok FROM {ASR} t GROUP BY file_id // 10, file_id % 2) u GROUP BY g HAVING min(ok) = 1")
def cached_anchor_guard(spark, d):
    r = asr(spark, d).selectExpr("file_id DIV 10 AS file_id", "CAST(file_id % 2 AS int) AS channel", "engine", "error", "if(file_id % 7 <> 0, array(engine), NULL) AS words")
    return timed.anchored_files(r, "alpha")


@query("result_rows", """SELECT o_orderkey AS file_id, CAST(o_custkey AS BIGINT) AS num_words, coalesce(e, 0) AS num_entities, coalesce(s, 0) AS num_spans FROM orders
  LEFT JOIN (SELECT l_orderkey, count(*) AS e, count(*) FILTER (WHERE l_linenumber < 3) AS s FROM lineitem GROUP BY 1) l ON l_orderkey = o_orderkey""")
def result_rows(spark, d):
    orders, items = table(spark, d, "orders"), table(spark, d, "lineitem").withColumnRenamed("l_orderkey", "file_id")
    items = items.join(orders.select(F.col("o_orderkey").alias("file_id")), "file_id", "left_semi")
    return reports.result_rows(orders.selectExpr("o_orderkey AS file_id", "o_custkey AS word_count"), items, items.where("l_linenumber < 3"))


@query("perf_merge", """SELECT e.user_id, event_type AS name, round(sum(value), 4) AS sec, round(sum(value / 2), 4) AS engine_sec, any_value(samples) AS samples FROM events e
  JOIN (SELECT user_id, string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY event_id) AS samples FROM events GROUP BY 1) s ON s.user_id = e.user_id GROUP BY 1, 2""")
def perf_merge(spark, d):
    parts = table(spark, d, "events").select(
        "user_id", F.col("event_id").alias("ord"), F.create_map("event_type", "value").alias("stages"), F.create_map("event_type", F.col("value") / 2).alias("engines"), F.array("event_id").alias("samples"),
    )
    m = reports.merged_metrics(parts, ["user_id"])
    rows = m.select("user_id", "engines", F.array_join(F.col("samples").cast("array<string>"), ",").alias("samples"), F.explode("stages").alias("name", "sec"))
    return rows.select("user_id", "name", F.round("sec", 4).alias("sec"), F.round(F.col("engines")[F.col("name")], 4).alias("engine_sec"), "samples")


@query("entity_enrich", f"""SELECT id, CASE WHEN id % 2 = 0 THEN 'engine:beta' ELSE 'final_consensus' END AS transcript_source, CASE WHEN id % 2 = 0 THEN 'beta' END AS asr_engine, text, "start" FROM ({ORACLE_SQL["rx_email"]}) e""")
def entity_enrich(spark, d):
    t = pii(spark, d).select(F.col("id").alias("file_id"), F.lit(0).alias("channel"), F.expr("if(id % 2 = 0, 'engine:beta', 'final_consensus')").alias("source"), entities.rule_entities("text", "email").alias("entities"))
    # an entity has its detector in `source`; the text's source goes by its own name
    return reports.enriched(t).select(F.col("file_id").alias("id"), "transcript_source", "asr_engine", "text", "start")


@query("sidecar_json", f"SELECT file_id, path, '/out/' || file_id AS out_path, 'success' AS status, CAST(channels AS BIGINT) AS num_entities FROM {CALLS} t")
def sidecar_json(spark, d):
    c = calls(spark, d).select("file_id", "path", F.expr("'/out/' || file_id").alias("out_path"), F.lit("success").alias("status"), F.array_repeat(F.struct("codec"), F.col("channels")).alias("entities"), F.array(F.struct("rate")).alias("spans"))
    doc = F.from_json("document", "files struct<input_path:string,output_path:string>, status string, num_entities long")
    return reports.sidecar(c).select("file_id", doc.alias("j")).select("file_id", F.col("j.files.input_path").alias("path"), F.col("j.files.output_path").alias("out_path"), "j.status", "j.num_entities")


# ---- masks over several spans and channels

_FRAMES = "SELECT o_orderkey AS id, i, round(((o_orderkey * 31 + i * 7) % 64) / 64 - 0.5, 6) AS a, round(((o_orderkey * 17 + i * 11) % 32) / 32 - 0.5, 6) AS b FROM orders CROSS JOIN ({n}) n"
_STEPS = " UNION ALL ".join(f"SELECT {i} AS i" for i in range(40))
_MASKS = ((2, 9, 0), (15, 22, -1), (20, 30, 1), (34, 99, 5))


#: Recordings of a task, made of small keys: blocks of all of them are sorted by one task.
RECORDINGS = 20_000


def _samples(key: str, step: int, parts: int):
    """The frames of a channel, each _n times.  Sixty-fourths have six digits, so they are round as they are; spelt out
    one by one they are compiled code, where a function over an array runs interpreted."""
    once = F.array(*(F.expr(f"CAST((({key} + {i * step}) % {parts}) / {parts} - 0.5 AS float)") for i in range(40)))
    return F.when(F.col("_n") == 1, once).otherwise(F.flatten(F.transform(once, lambda v: F.array_repeat(v, F.col("_n")))))


def stereo(spark, d):
    """Recordings of the frames.  A frame is made of its order's key alone, so keys meet before frames are made: of a key
    that comes n times every frame comes n times."""
    keys = table(spark, d, "orders").select("o_orderkey")
    keys = keys.repartition(max(8, -(-keys.count() // RECORDINGS)), "o_orderkey").groupBy("o_orderkey").agg(F.count("*").cast("int").alias("_n"))
    spans_ = F.array(*(F.struct(F.lit(a / 8000).alias("start"), F.lit(b / 8000).alias("end"), F.lit(c).alias("channel")) for a, b, c in _MASKS))
    return keys.select(F.col("o_orderkey").alias("id"), F.array(_samples("o_orderkey * 31", 7, 64), _samples("o_orderkey * 17", 11, 32)).alias("channels"), spans_.alias("spans"))


def _covered(channel: int) -> str:
    return "(" + " OR ".join(f"(i >= {a} AND i < {b})" for a, b, c in _MASKS if c not in (0, 1) or c == channel) + ")"


@query("mask_silence", f"SELECT id, round(sum(CASE WHEN {_covered(0)} THEN 0 ELSE a * (i + 1) END), 3) AS left_sum, round(sum(CASE WHEN {_covered(1)} THEN 0 ELSE b * (i + 1) END), 3) AS right_sum FROM ({_FRAMES.format(n=_STEPS)}) f GROUP BY id")
def mask_silence(spark, d):
    m = audio.mask(stereo(spark, d), 8000, "silence")
    weighed = lambda k: F.round(F.aggregate(F.transform(F.col("channels")[k], lambda v, i: v.cast("double") * (i + 1)), F.lit(0.0), lambda a, v: a + v), 3)
    return m.select("id", weighed(0).alias("left_sum"), weighed(1).alias("right_sum"))


def _tone(channel: int, column: str) -> str:
    """A later span wins; a span ends with the recording."""
    cases = ""
    for a, b, c in reversed(_MASKS):
        if c not in (0, 1) or c == channel:
            n = min(b, 40) - a
            f = min(32, max(1, n // 2))
            cases += f" WHEN i >= {a} AND i < {b} THEN 0.35 * top * sin(2 * pi() * 1000 * (i - {a}) / 8000) * least(1, (i - {a}) / {max(1, f - 1)}, ({n} - 1 - (i - {a})) / {max(1, f - 1)})"
    return f"CASE{cases} ELSE {column} END"


@query("mask_beep_spans", f"SELECT id, CAST(floor(sum(abs({_tone(0, 'a')})) * 100 + 0.5) AS BIGINT) AS left_sum, CAST(floor(sum(abs({_tone(1, 'b')})) * 100 + 0.5) AS BIGINT) AS right_sum FROM (SELECT *, max(greatest(abs(a), abs(b))) OVER (PARTITION BY id) AS top FROM ({_FRAMES.format(n=_STEPS)}) f) g GROUP BY id")
def mask_beep_spans(spark, d):
    m = audio.mask(stereo(spark, d), 8000, "beep")
    total = lambda k: F.floor(F.aggregate(F.col("channels")[k], F.lit(0.0), lambda a, v: a + F.abs(v.cast("double"))) * 100 + 0.5)
    return m.select("id", total(0).alias("left_sum"), total(1).alias("right_sum"))


#: Samples a block: spans begin, end and go over its edges.
_BLOCK = 7


def _masked_blocks(spark, d, mode: str):
    """Samples (id, i, a, b) of the stereo recordings, masked block by block."""
    t = stereo(spark, d)
    m = blocks.mask(blocks.cut(t, _BLOCK), t.select("id", "spans"), _BLOCK, 8000, mode)
    frames = m.select("id", "block", F.posexplode(F.arrays_zip(F.col("channels")[0].alias("a"), F.col("channels")[1].alias("b"))).alias("i", "f"))
    return frames.select("id", (F.col("block") * _BLOCK + F.col("i")).alias("i"), F.col("f.a").cast("double").alias("a"), F.col("f.b").cast("double").alias("b"))


@query("mask_silence_blocks", ORACLE_SQL["mask_silence"])
def mask_silence_blocks(spark, d):
    weighed = lambda c: F.round(F.sum(F.col(c) * (F.col("i") + 1)), 3)
    return _masked_blocks(spark, d, "silence").groupBy("id").agg(weighed("a").alias("left_sum"), weighed("b").alias("right_sum"))


@query("mask_beep_blocks", ORACLE_SQL["mask_beep_spans"])
def mask_beep_blocks(spark, d):
    total = lambda c: F.floor(F.sum(F.abs(c)) * 100 + 0.5)
    return _masked_blocks(spark, d, "beep").groupBy("id").agg(total("a").alias("left_sum"), total("b").alias("right_sum"))


@query("peaks_by_blocks", f"SELECT id, count(*) AS n, max(CAST(greatest(abs(a), abs(b)) AS FLOAT)) AS peak FROM ({_FRAMES.format(n=_STEPS)}) f GROUP BY id")
def peaks_by_blocks(spark, d):
    return blocks.totals(blocks.cut(stereo(spark, d), _BLOCK)).select("id", "n", F.col("peak").cast("float").alias("peak"))


# ---- caches, taggers, tails and streams

_CACHE = "SELECT '/calls/' || (o_custkey % 500) AS input_path, CASE o_orderkey % 3 WHEN 0 THEN 'alpha' WHEN 1 THEN 'beta' ELSE 'zeta' END AS engine, CAST(o_orderkey % 2 AS INT) AS channel, o_orderpriority AS transcript, o_orderkey AS updated_at FROM orders"
_LAST = f"SELECT input_path, engine, channel, max_by(transcript, updated_at) AS transcript, max(updated_at) AS updated_at FROM ({_CACHE}) c GROUP BY 1, 2, 3"


@query("upsert_asr_cache", _LAST)
def upsert_asr_cache(spark, d):
    c = view(spark, d, _CACHE, "orders")
    half = table(spark, d, "orders").agg(F.percentile_approx("o_orderkey", 0.5)).first()[0]
    return state.upsert_asr_cache(c.where(F.col("updated_at") <= half), c.where(F.col("updated_at") > half))


@query("cached_scan", f"SELECT input_path, channel, string_agg(engine, ',' ORDER BY CASE engine WHEN 'zeta' THEN 1 WHEN 'beta' THEN 2 ELSE 3 END) AS engines FROM ({_LAST}) c WHERE input_path NOT IN ('/calls/1', '/calls/2') GROUP BY 1, 2")
def cached_scan(spark, d):
    gone = spark.createDataFrame([("/calls/1",), ("/calls/2",)], "input_path string")
    rows = state.cached_results(state.without_files(upsert_asr_cache(spark, d), gone), ["zeta", "beta"])
    placed = rows.withColumn("k", F.monotonically_increasing_id())
    return placed.groupBy("input_path", "channel").agg(F.array_join(F.array_sort(F.collect_list(F.struct("k", "engine")))["engine"], ",").alias("engines"))


_TAGS = "SELECT p_partkey AS key, CAST(p_size AS INT) AS start, CAST(p_partkey % 9 - 1 AS INT) AS a, CAST(p_partkey % 9 + p_partkey % 4 AS INT) AS b, CASE p_partkey % 5 WHEN 0 THEN 'b-city' WHEN 1 THEN 'I-SURNAME' WHEN 2 THEN 'PERSON' WHEN 3 THEN 'ORG' ELSE 'O' END AS label, p_partkey % 10 / 10 AS score FROM part"


@query(
    "tagger_filter",
    f"""WITH r AS (SELECT t.*, p_name AS whole, start + a AS f, least(start + b, length(p_name)) AS e FROM ({_TAGS}) t JOIN part ON p_partkey = key)
    SELECT key, 'token' AS source, substr(whole, f + 1, e - f) AS text, CASE label WHEN 'b-city' THEN 'LOCATION' ELSE 'PERSON_NAME' END AS type, f AS "start", e AS "end" FROM r WHERE f >= 0 AND e > f AND score >= 0.5 AND label IN ('b-city', 'I-SURNAME')
    UNION ALL SELECT key, 'ner', substr(whole, f + 1, e - f), CASE label WHEN 'ORG' THEN 'INSTITUTION_NAME' ELSE 'PERSON_NAME' END, f, e FROM r WHERE f >= 0 AND e > f AND label IN ('PERSON', 'ORG')""",
)
def tagger_filter(spark, d):
    raw = view(spark, d, _TAGS, "part").selectExpr("key", "start", "'' AS chunk", "label", "a AS `from`", "b AS `to`", "CAST(score AS DOUBLE) AS score")
    texts = table(spark, d, "part").selectExpr("p_partkey AS key", "p_name AS text")
    both = ports.kept_tags(raw, texts, "token").unionByName(ports.kept_tags(raw, texts, "ner"))
    return both.select("key", "source", "text", "type", "start", "end")


@query("report_tail", "SELECT c_custkey AS id, CAST(row_number() OVER (ORDER BY c_custkey) - 1 AS BIGINT) AS line FROM customer QUALIFY line >= 40")
def report_tail(spark, d):
    place = io.scratch(spark)
    rows = table(spark, d, "customer").select(F.col("c_custkey").alias("id"))
    rows.repartitionByRange(3, "id").sortWithinPartitions("id").write.json(place)
    return reports.report_tail(spark, place, 40, "id long").select("record.id", "line")


@query("stream_resume", "SELECT s_suppkey AS file_id, CASE WHEN s_suppkey % 3 = 0 THEN 'failed' ELSE 'success' END AS status FROM supplier")
def stream_resume(spark, d):
    place = io.scratch(spark)
    kind, rows = "file_id long", table(spark, d, "supplier").select(F.col("s_suppkey").alias("file_id"))
    rows.repartition(2, "file_id").write.json(f"{place}/in")
    done = lambda b: b.selectExpr("file_id", "if(file_id % 3 = 0, 'failed', 'success') AS status", "unix_micros(current_timestamp()) AS updated_at")
    resume.resume(spark, f"{place}/in", kind, f"{place}/state", done, 1).awaitTermination()
    return resume.current(spark, f"{place}/state").select("file_id", "status")


_ENGINES = ["alpha", "beta", "gamma", "delta"]


@query(
    "consensus_methods",
    f"""WITH n AS (SELECT file_id, channel, engine, engine_ord, trim(coalesce(transcript, '')) AS raw, {_NORM.replace("text", "transcript")} AS x FROM {ASR} t WHERE error IS NULL AND trim(coalesce(transcript, '')) <> ''),
    g AS (SELECT file_id, x, count(*) AS n, max(CASE WHEN engine = 'alpha' THEN 1 ELSE 0 END) AS has, min(engine_ord) AS o, arg_min(engine, CASE WHEN engine = 'alpha' THEN -1 ELSE engine_ord END) AS engine FROM n WHERE x <> '' GROUP BY file_id, x),
    r AS (SELECT *, row_number() OVER (PARTITION BY file_id ORDER BY n DESC, has DESC, length(x) DESC, o) AS k FROM g),
    m AS (SELECT file_id, engine, n FROM r WHERE k = 1 AND n >= 3),
    p AS (SELECT file_id, arg_min(engine, engine_ord) AS engine FROM n GROUP BY file_id),
    c AS (SELECT f.file_id, CASE WHEN m.engine IS NOT NULL THEN 'strict_majority' WHEN p.engine IS NOT NULL THEN 'fallback_priority' ELSE 'all_empty' END AS method, coalesce(m.engine, p.engine) AS selected_engine,
      CAST(coalesce(m.n, CASE WHEN p.engine IS NULL THEN 0 ELSE 1 END) AS BIGINT) AS agreement_count FROM (SELECT DISTINCT file_id FROM {ASR} t) f LEFT JOIN m USING (file_id) LEFT JOIN p USING (file_id))
    SELECT c.file_id, method, selected_engine, agreement_count, coalesce(n.raw, '') AS final_transcript FROM c LEFT JOIN n ON n.file_id = c.file_id AND n.engine = c.selected_engine""",
)
def consensus_methods(spark, d):
    """Majority, fallback and emptiness with every column; no similarity reaches 2, so none is soft."""
    return consensus.consensus(asr(spark, d), "alpha", _ENGINES, soft=2.0).select("file_id", "method", "selected_engine", "agreement_count", "final_transcript")


# ---- passes over outputs, models in workers, keyed stores and states

_OUTPUT_COLUMNS = (
    "file_id", "codec", "rate", "CASE WHEN file_id % 13 <> 0 THEN file_id % 4 + 0.25 + CASE WHEN file_id % 6 = 0 THEN 0.5 ELSE 0 END END AS duration", "CASE WHEN file_id % 5 <> 0 THEN file_id END AS out_bytes", "file_id % 3 <> 0 AS side_there",
    """CASE WHEN file_id % 7 = 0 THEN 'no json' WHEN file_id % 5 <> 0 THEN '{"streams": [{"codec_name": "' || codec || '", "sample_rate": "' || rate || '", "channels": 2, "duration": "' || (file_id % 4) || '.25"}]}' END AS out_probe""",
    "CASE file_id % 9 WHEN 0 THEN 'failed' WHEN 1 THEN 'success_no_pii_fast_copy' ELSE 'success' END AS status", "CASE WHEN file_id % 9 = 0 THEN 'no mask can be made' END AS error",
)
_OUTPUTS = f"SELECT {', '.join(_OUTPUT_COLUMNS)} FROM"


@query(
    "settled_outputs",
    f"""WITH o AS ({_OUTPUTS} {CALLS} t), p AS (SELECT *, out_bytes IS NOT NULL AS a, out_probe LIKE '{{%' AS seen FROM o),
    c AS (SELECT *, coalesce(seen AND lower(codec) = 'opus', false) AS b, coalesce(seen AND rate = 48000, false) AS r, coalesce(seen, false) AS n, NOT coalesce(seen AND duration IS NOT NULL AND file_id % 6 = 0, false) AS d FROM p),
    v AS (SELECT *, a AND b AND r AND n AND d AS ok, concat_ws(',', CASE WHEN NOT a THEN 'output_exists' END, CASE WHEN NOT b THEN 'codec_ok' END, CASE WHEN NOT r THEN 'rate_ok' END, CASE WHEN NOT n THEN 'channels_ok' END, CASE WHEN NOT d THEN 'duration_ok' END) AS broken FROM c)
    SELECT file_id, CASE WHEN ok THEN status ELSE 'failed' END AS status, CASE WHEN starts_with(status, 'success') AND NOT ok THEN 'invalid output: ' || broken ELSE error END AS error, ok AND starts_with(status, 'success') AS valid, ok AND side_there AS reused FROM v""",
)
def settled_outputs(spark, d):
    """The second pass over what was written: checks, statuses decided from both passes, and what a later run skips."""
    o = calls(spark, d).selectExpr(*_OUTPUT_COLUMNS).withColumn("duration", F.col("duration").cast("double"))
    checked = files.checked_outputs(o.select("file_id", "duration"), o.select("file_id", "out_bytes", "side_there", "out_probe"))
    reused = files.reusable(checked).withColumn("reused", F.lit(True))
    return files.settled(o.select("file_id", "status", "error"), checked).join(reused, "file_id", "left").withColumn("reused", F.coalesce("reused", F.lit(False)))


@query(
    "engine_rows",
    """SELECT conv_id * 1000 + turn AS file_id, CASE WHEN f % 7 = 0 THEN NULL WHEN f % 5 = 1 THEN 'plain ' || length(text) ELSE text END AS transcript, CASE WHEN f % 7 <> 0 AND f % 5 <> 1 THEN len(regexp_extract_all(text, '[^ ]+')) END AS num_words,
     CASE WHEN f % 7 = 0 THEN 'ValueError(''seven'')' END AS error, f % 7 <> 0 AND f % 5 = 1 AS retried FROM (SELECT *, conv_id * 1000 + turn AS f FROM conversations) t""",
)
def engine_rows(spark, d):
    """A model held in the workers: batches that fail are tried row by row, suspicious times go to the plain model."""

    def load():
        def model(rows):
            if any(r["file_id"] % 7 == 0 for r in rows):
                raise ValueError("seven")
            odd = lambda r, i: i - 1.0 if r["file_id"] % 5 == 1 else i + 0.5
            return [(r["said"], [{"word": w, "start": float(i), "end": odd(r, i)} for i, w in enumerate([w for w in r["said"].split(" ") if w] or ["-"])]) for r in rows]

        return model

    engine = workers.Engine("said", load, 8, lambda: lambda rows: [(f"plain {len(r['said'])}", None) for r in rows])
    inputs = table(spark, d, "conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("file_id"), F.lit(0).alias("channel"), F.col("text").alias("said"))
    return workers.recognised(inputs, engine).select("file_id", "transcript", F.when(F.col("words").isNotNull(), F.size("words")).cast("long").alias("num_words"), "error", "retried")


@query("tag_documents", offsets_sql("[0-9]+", 0, DOCS))
def tag_documents(spark, d):
    """A tagger on lateral chunks of whole documents; what chunks share is one entity, at its place in the text."""

    def load():
        import re

        return lambda chunks: [[{"label": "id number", "start": m.start(), "end": m.end(), "score": 0.9} for m in re.finditer("[0-9]+", c)] for c in chunks]

    docs = table(spark, d, "documents").select(F.col("doc_id").alias("id"), "text")
    return workers.tagged(docs, (workers.Tagger("digits", "zero_shot", load, 32),)).select("id", "text", "start", "end")


_KEPT = "SELECT CAST(o_custkey AS STRING) AS input_path, o_orderpriority AS engine, CAST(o_custkey % 2 AS INT) AS channel, {v} AS transcript, CAST({at} AS DOUBLE) AS updated_at FROM orders"


@query(
    "result_store",
    f"""WITH a AS (SELECT *, 0 AS g FROM ({_KEPT.format(v="'old ' || o_orderkey", at="o_orderkey")}) x UNION ALL SELECT *, 1 FROM ({_KEPT.format(v="'new ' || o_orderkey", at="-o_orderkey")} WHERE o_orderkey % 10 = 0) y),
    r AS (SELECT *, row_number() OVER (PARTITION BY input_path, engine, channel ORDER BY g DESC, updated_at DESC) AS n FROM a)
    SELECT input_path, engine, channel, transcript FROM r WHERE n = 1 AND CAST(input_path AS BIGINT) % 11 <> 0""",
)
def result_store(spark, d):
    """Two upserts and a deletion through the keyed store, each rewriting the buckets that it touches."""
    kept = store.result_store(io.scratch(spark), 16)
    kept.upsert(with_nulls(view(spark, d, _KEPT, "orders", v="'old ' || o_orderkey", at="o_orderkey")))
    kept.upsert(with_nulls(view(spark, d, f"{_KEPT} WHERE o_orderkey % 10 = 0", "orders", v="'new ' || o_orderkey", at="-o_orderkey")))
    kept.delete(table(spark, d, "orders").where("o_custkey % 11 = 0").select(F.col("o_custkey").cast("string").alias("input_path")))
    return kept.read(spark).select("input_path", "engine", "channel", "transcript")


def with_nulls(rows: DataFrame) -> DataFrame:
    """Rows of the results' schema, null where they have no such column."""
    empty = rows.sparkSession.createDataFrame([], state.RESULT_SCHEMA)
    return empty.unionByName(rows, allowMissingColumns=True)


@query(
    "stream_by_state",
    """SELECT o_custkey AS file_id, CASE WHEN o_custkey % 3 = 0 THEN 'failed' ELSE 'success' END AS status, CASE WHEN o_custkey % 3 = 0 THEN count(*) ELSE 1 END AS handled, CASE WHEN o_custkey % 3 = 0 THEN 0 ELSE count(*) - 1 END AS skipped FROM orders GROUP BY o_custkey""",
)
def stream_by_state(spark, d):
    """Calls that come again and again: failures are tried again, successes skipped, by each file's own state."""
    place = io.scratch(spark)
    table(spark, d, "orders").select(F.col("o_custkey").alias("file_id")).repartition(3).write.json(f"{place}/in")
    resume.resume_by_state(spark, f"{place}/in", "file_id long", f"{place}/state", lambda row: ("failed", False) if row["file_id"] % 3 == 0 else ("success", True), 1).awaitTermination()
    log = resume.status_log(spark, f"{place}/state").groupBy("file_id").agg(F.count_if(F.col("status") != "skipped_existing").alias("handled"), F.count_if(F.col("status") == "skipped_existing").alias("skipped"))
    return resume.current(spark, f"{place}/state").select("file_id", "status").join(log, "file_id")
