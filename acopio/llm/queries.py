"""One query for each operator, over whole tables, and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from acopio.llm import chat, licenses, mixing, packing, pages, quality, search, sharding, simhash, spelling, toxicity, trie, warc
from acopio.llm.ranks import ranked
from acopio.llm.text import hash_bucket
from acopio.session import stage

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Captures made of each page: the first is a full response, later ones are responses or revisits by a hash.
VISITS = 4


def captures(crawled: DataFrame) -> DataFrame:
    """Archive records from ``pages``: each page is captured at four times, under two forms of its url."""
    visit = crawled.select("page_id", "url", F.md5("html").alias("body"), F.explode(F.sequence(F.lit(0), F.lit(VISITS - 1))).alias("v"))
    visit = visit.withColumn("h", hash_bucket(F.md5(F.concat_ws(":", F.col("page_id").cast("string"), F.col("v").cast("string"))), 1, 1))
    response = (F.col("v") == 0) | (F.col("h") < 4)
    own = F.concat(F.lit('"'), F.md5(F.concat_ws(":", "body", F.col("v").cast("string"))), F.lit('"'))
    first = F.concat(F.when(F.col("h") % 2 == 1, "W/").otherwise(""), F.lit('"'), F.md5(F.concat(F.col("body"), F.lit(":0"))), F.lit('"'))
    etag = F.when(response, own).when(F.col("h") < 10, first).when(F.col("h") == 15, F.lit('"other"'))
    modified = F.when(response, F.concat_ws("-", F.lit("m"), F.col("page_id").cast("string"), F.col("v").cast("string"))).when(
        F.col("h").between(10, 12), F.concat_ws("-", F.lit("m"), F.col("page_id").cast("string"), F.lit("0"))
    )
    seconds = F.lit(1_700_000_000) + F.col("page_id") * 60 + F.col("v") * 604_800
    return visit.select(
        (F.col("page_id") * 10 + F.col("v")).alias("record_id"),
        F.when(F.col("v") % 2 == 0, F.col("url")).otherwise(F.concat(F.regexp_replace("url", "^https?", "HTTPS"), F.lit("#v"))).alias("url"),
        F.timestamp_seconds(seconds).alias("captured_at"),
        F.when(response, "response").otherwise("revisit").alias("kind"),
        F.when(response, F.when((F.col("v") > 0) & (F.col("h") == 0), 404).otherwise(200)).otherwise(304).alias("status"),
        etag.alias("etag"),
        modified.alias("last_modified"),
        F.map_from_arrays(
            F.array(F.lit("cache-control"), F.lit("content-type"), F.lit("date")),
            F.array(F.concat(F.lit("max-age="), F.col("h").cast("string")), F.when(response, "text/html").otherwise("none"), seconds.cast("string")),
        ).alias("headers"),
    )


_CANONICAL = """
  regexp_replace(regexp_replace(lower(regexp_extract(bare, '^[^/?]*')), ':(80|443)$', ''), '^(www|m)\\.', '')
  || regexp_replace(regexp_replace(regexp_extract(bare, '^[^/?]*([^?]*)', 1), '/(index|default)\\.(html?|php|aspx?)$', '/'), '/+$', '')
  || CASE WHEN len(kept) > 0 THEN '?' || array_to_string(kept, '&') ELSE '' END"""

OP1 = f"""
WITH visit AS (
  SELECT page_id, url, md5(html) AS body, v, ('0x' || substr(md5(page_id || ':' || v), 1, 1))::BIGINT AS h
  FROM pages, range(0, {VISITS}) r(v)),
record AS (
  SELECT page_id * 10 + v AS record_id,
    CASE WHEN v % 2 = 0 THEN url ELSE regexp_replace(url, '^https?', 'HTTPS') || '#v' END AS url,
    1700000000 + page_id * 60 + v * 604800 AS ts, h, v = 0 OR h < 4 AS response, NOT (v > 0 AND h = 0) AS fine,
    CASE WHEN v = 0 OR h < 4 THEN '"' || md5(body || ':' || v) || '"' WHEN h < 10 THEN CASE WHEN h % 2 = 1 THEN 'W/' ELSE '' END || '"' || md5(body || ':0') || '"' WHEN h = 15 THEN '"other"' END AS etag,
    CASE WHEN v = 0 OR h < 4 THEN 'm-' || page_id || '-' || v WHEN h BETWEEN 10 AND 12 THEN 'm-' || page_id || '-0' END AS modified
  FROM visit),
bared AS (SELECT *, regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS bare FROM record),
params AS (SELECT *, list_sort(list_filter(string_split(regexp_extract(bare, '^[^?]*\\?(.*)$', 1), '&'),
    lambda x: x <> '' AND NOT regexp_matches(lower(x), '^({warc.TRACKING})(=|$)'))) AS kept FROM bared),
keyed AS (SELECT *, {_CANONICAL} AS url_key FROM params),
-- the latest earlier moment with a response, and the largest record of that moment
moment AS (SELECT url_key, ts, max(record_id) AS response_id FROM keyed WHERE response AND fine GROUP BY 1, 2),
matched AS (
  SELECT r.*, m.response_id, m.ts AS response_at
  FROM (SELECT * FROM keyed WHERE NOT response) r ASOF LEFT JOIN moment m ON r.url_key = m.url_key AND r.ts > m.ts),
judged AS (
  SELECT r.record_id, r.url_key, r.ts, r.response_id, r.response_at, r.h AS h, f.h AS fh,
    CASE WHEN r.response_id IS NULL THEN 'orphan'
      WHEN r.etag IS NOT NULL THEN CASE WHEN regexp_replace(r.etag, '^W/', '') = f.etag THEN 'resolved' ELSE 'changed' END
      WHEN r.modified IS NOT NULL THEN CASE WHEN r.modified = f.modified THEN 'resolved' ELSE 'changed' END
      ELSE 'unvalidated' END AS verdict
  FROM matched r LEFT JOIN keyed f ON f.record_id = r.response_id)
SELECT record_id, url_key, ts AS captured_s, verdict, response_id, response_at AS response_s,
  CASE WHEN verdict IN ('resolved', 'unvalidated') THEN 'cache-control=max-age=' || h || ';content-type=text/html;date=' || ts END AS headers
FROM judged
"""


@query(OP1)
def op1_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.resolve_revisits(captures(table(spark, sf_dir, "pages")))
    entries = F.array_sort(F.transform(F.map_entries("headers"), lambda e: F.concat_ws("=", e["key"], e["value"])))
    return found.select(
        "record_id", "url_key", F.unix_seconds("captured_at").alias("captured_s"), "verdict", "response_id",
        F.unix_seconds("response_at").alias("response_s"), F.when(F.col("headers").isNotNull(), F.array_join(entries, ";")).alias("headers"),
    )


def _op2_sql() -> str:
    known = ", ".join(f"('{s}', '{k}')" for k, own in licenses.SENTENCES.items() for s in own)
    left, steps = "'|' || array_to_string(ids, '||') || '|'", []
    for i, (_, parts) in enumerate(licenses.RULES):
        needle = "".join(f"|{p}|" for p in parts)
        steps.append(f"r{i + 1} AS (SELECT *, contains(l{i}, '{needle}') AS m{i}, replace(l{i}, '{needle}', '/') AS l{i + 1} FROM r{i})")
    names, weak = (", ".join(f"CASE WHEN m{i} THEN '{n}' END" for i, (n, p) in enumerate(licenses.RULES) if licenses.yields(p) == w) for w in (False, True))
    n = len(licenses.RULES)
    return f"""
WITH known(known, sentence_id) AS (VALUES {known}),
cut AS (SELECT doc_id, rowid_, unnest(s) AS raw, generate_subscripts(s, 1) AS pos FROM (
  SELECT doc_id, row_number() OVER () AS rowid_, regexp_split_to_array(regexp_replace(lower(coalesce(text, '')), '[^a-z0-9.!?;\\n\\x20\\x09-\\x0D]+', ' ', 'g'), '\\n|[.!?;](?:[\\x20\\x09-\\x0D]|$)') AS s FROM documents)),
hits AS (SELECT doc_id, rowid_, pos, sentence_id FROM (SELECT *, trim(regexp_replace(raw, '[^a-z0-9]+', ' ', 'g')) AS known FROM cut) JOIN known USING (known)),
r0 AS (SELECT doc_id, ids, {left} AS l0 FROM (SELECT doc_id, rowid_, list(sentence_id ORDER BY pos) AS ids FROM hits GROUP BY ALL)),
{", ".join(steps)},
told AS (SELECT *, list_filter([{names}], lambda x: x IS NOT NULL) AS strong, list_filter([{weak}], lambda x: x IS NOT NULL) AS weak FROM r{n}),
named AS (SELECT *, CASE WHEN len(strong) > 0 THEN strong ELSE weak END AS found FROM told)
SELECT doc_id, array_to_string(ids, ',') AS sentence_ids,
  array_to_string(list_filter(found, lambda x, i: list_position(found, x) = i), ',') AS licences,
  (length(regexp_replace(l{n}, '[^|]+', '', 'g')) // 2)::BIGINT AS unmatched
FROM named
"""


@query(_op2_sql())
def op2_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.licences(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.array_join("sentence_ids", ",").alias("sentence_ids"), F.array_join("licences", ",").alias("licences"), "unmatched")


@query()
def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    prints = stage(table(spark, sf_dir, "documents").select("doc_id", simhash.fingerprint(F.col("text")).alias("fp")), "prints")
    return simhash.near_duplicates(prints).select("doc_id", simhash.hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id", "component_rows")


def held_out(doc_id: str = "doc_id"):
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0


def toxicity_model(docs: DataFrame, labels: DataFrame) -> toxicity.Model:
    """Learned from the labels that are not held out only."""
    return toxicity.train(docs, labels.where(~held_out()))


@query()
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity_model(docs, table(spark, sf_dir, "labels"))
    scored = docs.select("doc_id", held_out().alias("held_out"), toxicity.toxicity(F.col("text"), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


SHARDS = 40


@query()
def op5_interleaved_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealt = sharding.shards(table(spark, sf_dir, "documents"), SHARDS)
    return dealt.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "source")


#: Results per query. A query is all terms of its document.
TOP_K = 10


@query()
def op6_bm25_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = search.search(docs, docs.where(F.col("doc_id") % 20 == 0), TOP_K)
    return found.select("query_id", "doc_id", "rank", F.round("score", 6).alias("score"))


@query()
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    votes = stage(quality.with_votes(quality.with_metrics(docs)).drop("text"), "votes")
    shown = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return quality.judged(votes, quality.learn(votes)).select("doc_id", *shown, "base_failed", "kept", F.round("quality", 6).alias("quality"))


@query()
def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.near_clusters(table(spark, sf_dir, "documents")))


@query()
def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = table(spark, sf_dir, "pages").select("page_id", "url", pages.extract(F.col("html")).alias("text"))
    return text.withColumn("n_chars", F.length("text").cast("long"))


OP10 = """
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
    md5('mix:' || coalesce(doc_id::VARCHAR, '')) AS digest FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w, 3 * source_size AS cap, sum(source_size) OVER ()::BIGINT AS whole FROM s),
f AS (SELECT *, coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS full_, sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::BIGINT AS rest FROM w),
l AS (SELECT *, (whole - full_) / rest AS level FROM f),
t AS (SELECT source, source_size, coalesce(least(cap::DOUBLE, (SELECT arg_min(level, cap / w) FROM l WHERE level * w < cap) * w), cap::DOUBLE) AS target FROM l),
r AS (SELECT d.*, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0::DOUBLE END AS rate,
    ('0x' || substr(md5('mix:start:' || coalesce(d.source, '')), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS start,
    row_number() OVER (PARTITION BY d.source ORDER BY length(size::VARCHAR), substr(size::VARCHAR, 1, 2), substr(digest, 1, 2), size, digest, doc_id) AS k
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, size * least(floor(k * rate + start) - floor((k - 1) * rate + start), 3)::BIGINT AS taken, source FROM r
"""


@query(OP10)
def op10_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    taken = mixing.copies(table(spark, sf_dir, "documents"))
    return taken.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "source")


#: Rebuilt conversations start with up to this many turns less one of another conversation, one of each hundred.
SHARED_TURNS, FAMILY = 6, 100


def rebuilt_conversations(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id) and (conv_id, depth, tokens, digest): each conversation begins as the first of its hundred does.

    Turns are ordered by turn (nulls first), then role and digest; places are counted per range of
    turns, so that a very long conversation is not sorted in one task. Rows without a conv_id
    belong to no conversation.
    """
    said = turns.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").isNotNull().cast("int").alias("known"), F.coalesce(F.floor(F.col("turn") / 256), F.lit(0)).alias("range"),
        "turn", F.coalesce("role", F.lit("")).alias("role"), trie.turn_digest(F.col("role"), F.col("text")).alias("digest"),
        F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("tokens"),
    )
    own = stage(ranked(stage(said, "said"), ["conv_id"], ["known", "range"], ["turn", "role", "digest"], "place").select("conv_id", "place", "digest", "tokens"), "own-turns")
    found = own.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % SHARED_TURNS
    first = F.col("conv_id") - F.col("conv_id") % FAMILY
    lead = found.select(F.col("conv_id").alias("first"), F.col("n").alias("first_n"))
    plan = stage(
        found.select("conv_id", h.alias("h"), first.alias("first")).join(lead, "first", "left")
        .select("conv_id", "first", "h", F.least("h", F.coalesce("first_n", F.lit(0))).alias("taken")), "rebuilding",
    )
    leads = own.where((F.col("conv_id") % FAMILY == 0) & (F.col("place") < SHARED_TURNS)).withColumnRenamed("conv_id", "first")
    begun = plan.join(leads, "first").where("place <= h").select("conv_id", F.col("place").alias("depth"), "tokens", "digest")
    rest = own.join(plan, "conv_id").where("place > h").select("conv_id", (F.col("taken") + F.col("place") - F.col("h")).alias("depth"), "tokens", "digest")
    return plan.select("conv_id"), begun.unionByName(rest)


#: crc32 of a decimal number, bit by bit.
_CRC32 = """xor(list_reduce(list_transform(string_split({0}::VARCHAR, ''), lambda c: ascii(c)::BIGINT), lambda crc, byte:
  list_reduce(range(8), lambda x, k: xor(x >> 1, 3988292384::BIGINT * (x & 1)), xor(crc, byte)), 4294967295::BIGINT), 4294967295::BIGINT)"""

OP11 = f"""
WITH said AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS place
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, conv_id - conv_id % {FAMILY} AS lead, {_CRC32.format("conv_id")} % {SHARED_TURNS} AS h FROM (SELECT DISTINCT conv_id FROM said)),
taken AS (
  SELECT c.conv_id, place AS k, 0 AS later, role, text FROM c JOIN said s ON s.conv_id = c.lead AND s.place <= c.h
  UNION ALL SELECT c.conv_id, place, 1, role, text FROM c JOIN said s ON s.conv_id = c.conv_id AND s.place > c.h),
rebuilt AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY later, k) AS depth, length(text) AS tokens,
    sha256(length(role) || ':' || role || text) AS digest FROM taken),
path AS (
  SELECT conv_id, 0 AS depth, 0 AS tokens, 'root' AS node, NULL AS up FROM c
  UNION ALL SELECT conv_id, depth, tokens, sha256(string_agg(digest, ',') OVER w), CASE WHEN depth = 1 THEN 'root' ELSE sha256(string_agg(digest, ',') OVER b) END FROM rebuilt
  WINDOW w AS (PARTITION BY conv_id ORDER BY depth), b AS (PARTITION BY conv_id ORDER BY depth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
ends AS (SELECT conv_id, arg_max(node, depth) AS node FROM path GROUP BY conv_id),
node AS (SELECT node, min(conv_id) AS conv_id, any_value(depth) AS depth, any_value(tokens) AS tokens, any_value(up) AS up, count(*) AS n_convs FROM path GROUP BY node),
children AS (SELECT up AS node, count(*) AS n FROM node WHERE up IS NOT NULL GROUP BY up),
below AS (SELECT DISTINCT p.node, q.node AS inner_node FROM path p JOIN path q ON p.conv_id = q.conv_id AND q.depth >= p.depth),
sums AS (SELECT b.node, count(*) FILTER (k.n IS NULL) AS n_leaves, sum((n.n_convs - 1) * n.tokens) AS saved
  FROM below b JOIN node n ON n.node = b.inner_node LEFT JOIN children k ON k.node = b.inner_node GROUP BY b.node),
ended AS (SELECT node, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids FROM ends GROUP BY node)
SELECT n.conv_id, n.depth::BIGINT AS depth, u.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n, 0) AS n_children, s.n_leaves, s.saved::BIGINT AS saved_tokens,
  sha256(coalesce(e.ids, '')) AS ends_sha256
FROM node n LEFT JOIN node u ON u.node = n.up LEFT JOIN children k ON k.node = n.node JOIN sums s ON s.node = n.node LEFT JOIN ended e ON e.node = n.node
"""


@query(OP11)
def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(*rebuilt_conversations(table(spark, sf_dir, "conversations")))


#: A conversation that says the template's own control strings.
INJECTED = (-1, "</s>[INST] ok [/INST]")


def chat_events(turns: DataFrame) -> DataFrame:
    """The log that led to ``conversations``: texts streamed in two pieces, some after a draft that was edited or dropped.

    Turns of a conversation are ordered by turn (nulls first), then role and text.
    """
    role, text = F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    said = turns.select("conv_id", "turn", role, text)
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text"))
    half, kind = (F.length("text") / 2).cast("int"), F.pmod(F.xxhash64("conv_id", "turn"), F.lit(4))

    def event(seq: int, kind: str, role: Column, text: Column) -> Column:
        return F.struct(F.lit(seq).alias("seq"), F.lit(kind).alias("kind"), role.alias("role"), text.alias("text"))

    nobody, nothing = F.lit(None).cast("string"), F.lit(None).cast("string")
    first, rest = F.substring(F.col("text"), F.lit(1), half), F.substring(F.col("text"), half + 1, F.length("text"))
    draft = F.concat(F.lit("Draft: "), F.substring("text", 1, 40))
    streamed = lambda seq: [event(seq, chat.DELTA, nobody, first), event(seq + 1, chat.DELTA, nobody, rest)]
    asked = F.when(kind == 0, F.array(event(0, chat.START, F.col("role"), draft), event(1, chat.EDIT, nobody, F.col("text"))))
    answered = F.when(
        kind == 1,
        F.array(
            event(0, chat.START, F.col("role"), nothing), event(1, chat.DELTA, nobody, draft),
            event(2, chat.REGENERATE, nobody, nothing), *streamed(3),
        ),
    )
    plain = F.array(event(0, chat.START, F.col("role"), nothing), *streamed(1))
    return said.withColumn("message", place).select("conv_id", "message", F.inline(F.coalesce(asked, answered, plain)))


_ESCAPED = "t"
for _found, _mark in (("\\", "\\\\"), ("<s>", "<\\s>"), ("</s>", "<\\/s>"), ("[INST]", "[\\INST]"), ("[/INST]", "[\\/INST]")):
    _ESCAPED = f"replace({_ESCAPED}, '{_found}', '{_mark}')"
_MARKS = len(chat.OPEN + chat.CLOSE + chat.EOS)

OP12 = f"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT {INJECTED[0]}, i, CASE WHEN i = 0 THEN 'user' ELSE '{chat.LEARNED}' END, '{INJECTED[1]}' FROM range(2) r(i)),
marked AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k, role = '{chat.LEARNED}' AS learned,
  length({_ESCAPED.replace("(t,", "(role,")}) + length({_ESCAPED.replace("(t,", "(text,")}) + {_MARKS} AS size FROM said)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (learned), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (learned), '')) AS loss_sha256, (sum(size) + {len(chat.BOS)})::BIGINT AS formatted_chars
FROM marked GROUP BY conv_id
"""


@query(OP12)
def op12_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text")
    speaker = F.when(F.col("id") == 0, "user").otherwise(chat.LEARNED)
    added = spark.range(2).select(F.lit(INJECTED[0]).cast("long").alias("conv_id"), F.col("id").alias("turn"), speaker.alias("role"), F.lit(INJECTED[1]).alias("text"))
    done = chat.render(chat.fold(chat_events(turns.unionByName(added))))
    said = F.array_join(F.transform(chat.turns_of(F.col("formatted")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    read = done.select(
        "conv_id", F.size(chat.turns_of(F.col("formatted"))).cast("long").alias("n_turns"), F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        chat.learned_text(F.col("formatted"), F.col("loss")).alias("learned"), F.length("formatted").cast("long").alias("formatted_chars"),
    )
    return read.select(
        "conv_id", "n_turns", "turns_sha256", F.length("learned").cast("long").alias("loss_chars"),
        F.sha2(F.col("learned").cast("binary"), 256).alias("loss_sha256"), "formatted_chars",
    )


#: One in this many words loses a letter, so that there are variants to find.
SLIP_EVERY = 199
LEAST_LETTERS, LEAST_COUNT = 6, 5


def slipped_words(docs: DataFrame) -> DataFrame:
    """(word, n): every run of letters of every text, some of them with a letter left out, counted.

    A null doc_id is read as empty text. Runs that are too short before a letter is left out
    cannot become words, so they are dropped first.
    """
    found = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(spelling.runs(F.col("text"))).alias("run"))
    found = found.where(F.length("run") >= LEAST_LETTERS)
    h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    left_out = (h % F.length("run")).cast("int")
    slipped = F.concat(F.substring(F.col("run"), F.lit(1), left_out), F.substring(F.col("run"), left_out + 2, F.length("run")))
    words = found.select(F.when(h % SLIP_EVERY == 0, slipped).otherwise(F.col("run")).alias("word")).where(F.length("word") >= LEAST_LETTERS)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= LEAST_COUNT)


@query()
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(slipped_words(table(spark, sf_dir, "documents")))
