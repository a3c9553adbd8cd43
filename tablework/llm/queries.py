"""The registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablework.llm import bpe, chat, contamination, exact, jaccard, language, lines, repetition, runs, spelling, toxicity, urls, warc
from tablework.plans.registry import Tables
from tablework.session import pin, prepare, scratch

OPERATORS: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
OPERATOR_SQL: dict[str, str] = {}


def operator(sql: str | None = None):
    """Register a function of ``Tables`` under its own name."""

    def register(build: Callable[[Tables], DataFrame]):
        OPERATORS[build.__name__] = lambda spark, folder: build(Tables(prepare(spark), folder))
        if sql:
            OPERATOR_SQL[build.__name__] = sql
        return build

    return register


@operator()
def op1_language_id(t: Tables) -> DataFrame:
    """Learned from the rows that are not held out, applied to all."""
    docs = t.documents.select("doc_id", "text", "lang").withColumn("held_out", toxicity.held_out(F.col("doc_id")))
    filters = language.learn_filters(docs.filter("NOT held_out"))
    return language.identify(docs.select("doc_id", "held_out", "text"), filters).drop("text")


_WORDS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

_CONTAMINATION_SQL = f"""
WITH items AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
wins AS (
  SELECT DISTINCT item_id, list_slice(w, i::BIGINT, (i + least(len(w), 13) - 1)::BIGINT) AS win, least(len(w), 13) AS n
  FROM items, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS u(i) WHERE len(w) > 0),
docs AS (SELECT doc_id, {_WORDS} AS w FROM documents),
sizes AS (SELECT DISTINCT n FROM wins),
spans AS (
  SELECT doc_id, i, n, list_slice(w, i::BIGINT, (i + n - 1)::BIGINT) AS win
  FROM docs, sizes, unnest(range(1, len(w) - n + 2)) AS u(i)),
occ AS (SELECT doc_id, i, s.n, item_id FROM spans s JOIN wins USING (win)),
hit AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM occ, unnest(range(i, i + n)) AS u(k) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
          FROM (SELECT DISTINCT doc_id, item_id FROM occ) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""


@operator(_CONTAMINATION_SQL)
def op2_decontaminate(t: Tables) -> DataFrame:
    found = contamination.contamination(t.documents, t.benchmark)
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated"
    )


_CHAT_SQL = """
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok'),
sized AS (
  SELECT *, length(CASE role WHEN 'system' THEN 'System' WHEN 'user' THEN 'User' WHEN 'assistant' THEN 'Assistant'
           WHEN 'tool' THEN 'Tool' ELSE '=' || role END)
         + length(replace(replace(replace(text, '\\', '\\\\'), '#', '\\#'), '<', '\\<')) + 15 AS chars,
         CASE role WHEN 'system' THEN prior IS NULL WHEN 'user' THEN prior IS NULL OR prior IN ('system', 'assistant')
           WHEN 'assistant' THEN coalesce(prior IN ('user', 'tool'), FALSE)
           WHEN 'tool' THEN coalesce(prior = 'assistant', FALSE) ELSE FALSE END AS fits
  FROM (SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS prior FROM rows))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(chars)::BIGINT AS formatted_chars, bool_and(fits) AS valid
FROM sized GROUP BY conv_id
"""


@operator(_CHAT_SQL)
def op3_chat_format(t: Tables) -> DataFrame:
    """All conversations and one full of control strings: formatted, written, and read back."""
    text = "\\### Assistant: </turn> ok"
    hard = t.spark.createDataFrame([(-7, 0, "user", text), (-7, 1, "assistant", text)], "conv_id long, turn long, role string, text string")
    rows = t.conversations.select("conv_id", "turn", "role", "text").unionByName(hard)
    return chat.read_chats(pin(chat.format_chats(rows), "chats"))


@operator("""
WITH clean AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS norm FROM documents)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id IS NOT DISTINCT FROM min(doc_id) OVER same AS kept, sha256(norm) AS text_sha256
FROM clean WINDOW same AS (PARTITION BY norm)
""")
def op4_exact_dedup(t: Tables) -> DataFrame:
    return exact.exact_groups(t.documents)


@operator()
def op5_line_dedup(t: Tables) -> DataFrame:
    """Every line that isn't blank, however short."""
    return lines.line_report(t.documents, least_words=1)


@operator()
def op6_byte_bpe(t: Tables) -> DataFrame:
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return bpe.token_digests(t.documents, ranks, public_tokenizers.PATTERN)


#: score from which a text counts as toxic
TOXIC = 0.3

URL_RULES = [
    urls.Rule("block", "net", "/"), urls.Rule("allow", "example.net", "/en/"),
    urls.Rule("block", "example.com", "/de/"), urls.Rule("allow", "org", "/fr/"),
]


@operator()
def op7_url_filter(t: Tables) -> DataFrame:
    return urls.judge_urls(t.pages, URL_RULES)


@operator()
def op8_toxicity(t: Tables) -> DataFrame:
    docs = t.documents.select("doc_id", "text")
    model = toxicity.learn(docs, t.labels)
    scored = toxicity.score_texts(docs.withColumn("held_out", toxicity.held_out(F.col("doc_id"))), model).drop("text")
    return scored.withColumn("predicted", (F.col("score") >= TOXIC).cast("int"))


_JACCARD_SQL = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, i::BIGINT, (i + 4)::BIGINT), ' ') AS g
      FROM w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS u(i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (SELECT g FROM s GROUP BY g HAVING count(*) > 1),
t AS (SELECT s.* FROM s SEMI JOIN shared USING (g)),
i AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM t a JOIN t b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM i JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 75 * (x.n + y.n - i)),
ways AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
reach AS (SELECT a, b FROM ways UNION SELECT r.a, x.b FROM reach r JOIN ways x ON r.b = x.a)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(doc_id, m) AS component_id
FROM documents LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT a AS doc_id, min(b) AS m FROM reach GROUP BY a) USING (doc_id)
"""


@operator(_JACCARD_SQL)
def op9_jaccard_join(t: Tables) -> DataFrame:
    return jaccard.similar_documents(t.documents)


@operator("""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
d AS (SELECT page_id, octet_length(body)::BIGINT AS payload_bytes, sha1(body) AS payload_digest, md5(body) AS other FROM p),
g AS (SELECT *, count(*) OVER same AS n, max(page_id) OVER same AS first FROM d
      WINDOW same AS (PARTITION BY payload_digest, other, payload_bytes))
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND n > 1 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND n > 1 AND page_id <> first THEN first END AS refers_to
FROM g
""")
def op10_warc(t: Tables) -> DataFrame:
    """Pages written as archives and read back; the page that a revisit names is read from its record id."""
    path = scratch(t.spark, "archives")
    warc.write_archives(warc.page_records(t.pages), path)
    back = warc.read_archives(t.spark, path)
    return back.select(
        F.col("headers")["X-Page-Id"].cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.regexp_extract("refers_to", "^<urn:page:([0-9-]+):", 1).cast("long").alias("refers_to"),
    )


_REPETITION_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
x AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM d),
c AS (SELECT doc_id, i, length(x) AS size FROM x),
g5 AS (SELECT doc_id, i, x, x || ' ' || lead(x, 1) OVER s || ' ' || lead(x, 2) OVER s || ' ' || lead(x, 3) OVER s || ' ' || lead(x, 4) OVER s AS g
       FROM x WINDOW s AS (PARTITION BY doc_id ORDER BY i)),
g AS (""" + " UNION ALL ".join(
    f"SELECT doc_id, i, {k} AS k, g" + "".join(f" || ' ' || lead(x, {n}) OVER s" for n in range(5, k))
    + " AS g FROM g5 WINDOW s AS (PARTITION BY doc_id ORDER BY i)" for k in range(5, 11)) + """),
m AS (SELECT doc_id, k, i, count(*) OVER (PARTITION BY doc_id, k, g) AS n, row_number() OVER (PARTITION BY doc_id, k, g ORDER BY i) AS r
      FROM g WHERE g IS NOT NULL),
hit AS (SELECT doc_id, k, j, max(r) > 1 AS again FROM m, unnest(range(i, i + k)) AS u(j) WHERE n > 1 GROUP BY ALL),
s AS (SELECT hit.doc_id, """ + ", ".join(
    f"coalesce(sum(size) FILTER (k = {k} AND again), 0)::BIGINT AS dup_chars_{k}" for k in range(5, 11)) + """,
      count(*) FILTER (k = 8) AS n_repeat_words
      FROM hit JOIN c ON c.doc_id = hit.doc_id AND c.i = hit.j GROUP BY hit.doc_id),
l AS (SELECT doc_id, line, row_number() OVER (PARTITION BY doc_id, line ORDER BY i) AS r
      FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line, generate_subscripts(string_split(t, chr(10)), 1) AS i FROM d)
      WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')),
n AS (SELECT doc_id, count(*) FILTER (r > 1) AS n_dup_lines,
             coalesce(sum(length(regexp_replace(line, '[\\x20\\x09-\\x0D]+', '', 'g'))) FILTER (r > 1), 0)::BIGINT AS dup_line_chars
      FROM l GROUP BY doc_id),
a AS (SELECT d.doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
             length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
             coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
             coalesce(dup_line_chars, 0)::BIGINT AS dup_line_chars, """ + ", ".join(
    f"coalesce(dup_chars_{k}, 0)::BIGINT AS dup_chars_{k}" for k in range(5, 11)) + """
      FROM d LEFT JOIN s USING (doc_id) LEFT JOIN n USING (doc_id))
SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words)
       AND 100 * dup_line_chars <= 20 * word_chars AND """ + " AND ".join(
    f"100 * dup_chars_{k} <= {20 - k} * word_chars" for k in range(5, 11)) + """ AS kept
FROM a
"""


@operator(_REPETITION_SQL)
def op11_quality_rules(t: Tables) -> DataFrame:
    return repetition.repetition(t.documents)


def _with_periods(docs: DataFrame) -> DataFrame:
    """The documents, one in ten of them with a period from some word on, by a checksum of the id."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    picked = docs.select(
        "doc_id", "text", h.alias("h"),
        F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit("[^\\x20\\x09-\\x0D]+"), F.lit(0))).alias("w"))
    sized = picked.select("doc_id", "text", "w", F.size("w").alias("n"), F.floor(F.col("h") / 10).alias("g"))
    begun = sized.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int"))
    p = 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)).cast("int")
    begun = begun.withColumn("p", p)
    again = F.flatten(F.array_repeat(F.slice("w", F.col("a") + 1, F.col("p")), F.ceil((F.col("n") - F.col("a")) / F.col("p")).cast("int")))
    periodic = F.slice(F.concat(F.slice("w", F.lit(1), F.col("a")), again), F.lit(1), F.col("n"))
    return begun.select("doc_id", F.when(F.col("n") > 0, F.array_join(periodic, " ")).otherwise(F.col("text")).alias("text"))


def _stronger(a: Column, b: Column) -> Column:
    """Order of runs: by length / period downwards, then start and period."""
    left, right = a["length"] * b["period"], b["length"] * a["period"]
    later = F.when(a["start"] != b["start"], a["start"] > b["start"]).otherwise(a["period"] > b["period"])
    return F.when(left > right, -1).when(left < right, 1).when(later, 1).otherwise(-1)


@operator()
def op12_periodic_runs(t: Tables) -> DataFrame:
    found = runs.word_runs(_with_periods(t.documents.select("doc_id", "text")))
    best = F.get(F.array_sort("runs", _stronger), F.lit(0))
    listed = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    found = found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"),
        F.sha2(F.concat(F.array_join(listed, "\n"), F.when(F.size("runs") > 0, "\n").otherwise("")), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))
    return found.select(
        "doc_id", "n_runs", "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


# the checksum of the ids and words in SQL: one step per byte, by the usual table of 256 values
_CRC_TABLE = (
    "list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)), "
    "lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END))")
_CRC_BYTES = (
    "flatten(list_transform(string_split(doc_id::VARCHAR || ':' || run, ''), "
    "lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)::BIGINT] ELSE [195, unicode(x)::BIGINT - 64] END))")
_CRC = (
    f"xor(list_reduce(list_prepend(4294967295, {_CRC_BYTES}), "
    f"lambda c, b: xor(c >> 8, list_extract({_CRC_TABLE}, (xor(c, b) & 255) + 1))), 4294967295)")

_SPELLING_SQL = f"""
WITH RECURSIVE r AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[a-z\\x{{00C0}}-\\x{{00FF}}]+')) AS run FROM documents),
c AS (SELECT doc_id, run, count(*) AS n FROM r WHERE length(run) >= 5 GROUP BY ALL),
h AS (SELECT run, n, {_CRC} AS h FROM c),
p AS (SELECT CASE WHEN h % 97 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM h),
v AS (SELECT word, sum(n)::BIGINT AS n FROM p WHERE length(word) >= 5 GROUP BY 1 HAVING sum(n) >= 3),
d AS (SELECT word, n, i, left(word, i) || substr(word, i + 2) AS short FROM v, unnest(range(length(word))) AS u(i)),
near AS (
  SELECT DISTINCT a.word, b.word AS near, b.n FROM d a JOIN d b ON a.i = b.i AND a.short = b.short AND a.word <> b.word
  UNION SELECT d.word, v.word, v.n FROM d JOIN v ON d.short = v.word
  UNION SELECT v.word, d.word, d.n FROM d JOIN v ON d.short = v.word),
best AS (SELECT word, near, n, count(*) OVER (PARTITION BY word) AS n_near, row_number() OVER (PARTITION BY word ORDER BY n DESC, near) AS r
         FROM near),
f AS (SELECT v.word, v.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN b.n >= 2 * v.n THEN near END AS form,
             CASE WHEN b.n >= 2 * v.n THEN b.n END AS form_n FROM v LEFT JOIN best b ON b.word = v.word AND r = 1),
walk AS (SELECT word, form AS root FROM f WHERE form IS NOT NULL
         UNION ALL SELECT walk.word, f.form FROM walk JOIN f ON f.word = walk.root WHERE f.form IS NOT NULL),
ends AS (SELECT walk.word, root FROM walk JOIN f ON f.word = root WHERE f.form IS NULL)
SELECT f.word, form, coalesce(root, f.word) AS root, n, n_near, form_n FROM f LEFT JOIN ends ON ends.word = f.word
"""


def _with_slips(words: DataFrame) -> DataFrame:
    """Words of texts, one in 97 of them without one of its letters, by a checksum of the id and the word."""
    h = F.crc32(F.encode(F.concat(F.col("doc_id").cast("string"), F.lit(":"), F.col("word")), "UTF-8"))
    words = words.select("word", h.alias("h"))
    without = F.expr("concat(substring(word, 1, int(h % length(word))), substring(word, int(h % length(word)) + 2))")
    return words.select(F.when(F.col("h") % 97 == 0, without).otherwise(F.col("word")).alias("word"))


@operator(_SPELLING_SQL)
def op13_spelling_variants(t: Tables) -> DataFrame:
    return spelling.variants(spelling.vocabulary(_with_slips(spelling.text_words(t.documents))))
