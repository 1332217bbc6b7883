"""The operators as queries over the given tables, with SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codespan.llm import (
    chat_format,
    decontaminate,
    divergence,
    exact_dedup,
    jaccard_join,
    line_dedup,
    mixing,
    quality,
    secrets,
    span_dedup,
    token_count,
    toxicity,
    whitening,
)
from codespan.llm.store import table

VOCABULARY = "piece_bpe_32k.model"


def op1_quality_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document by its nearest labelled neighbours."""
    return quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_line_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines left in every document, and a digest of its text, after boilerplate went."""
    out = line_dedup.remove_boilerplate(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("text_sha256"))


def op3_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentences removed from every document, and its text, after repeated passages went."""
    return span_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op4_toxicity_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document by its nearest labelled examples."""
    return toxicity.score_toxicity(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    ).drop("text_key")


def op5_pfair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of every document in the mixture of sources."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mix(docs).drop("text")


def op6_winnow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages in every document."""
    return decontaminate.contaminated(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    ).drop("text_key")


def op7_merge_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exact duplicates of every document."""
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


CONTROL_TEXT = "</s>[INST] ok [/INST]"


def op8_chat_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation rendered, and what reading it back gives."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(CONTROL_TEXT).alias("text"),
    )
    shown = chat_format.format_conversations(rows.union(probe))
    turns = chat_format.read_back()
    spoken = F.array_join(
        F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    loss = chat_format.learned()
    return shown.select(
        "conv_id",
        F.size(turns).cast("long").alias("n_turns"),
        F.sha2(spoken, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document."""
    import public_tokenizers

    return token_count.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


def op10_jaccard_vertical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The component of near duplicates of every document."""
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents")).drop("text_key")


def op11_level_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How every source differs from the others of its language, and by which words."""
    return divergence.source_divergence(table(spark, sf_dir, "documents"))


def op12_rank_one_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four leading whitened coordinates of every embedding."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_entropy_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document: counts and a digest of the known forms, and all spans."""
    found = secrets.secret_spans(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id", count("assign"), count("access"), count("hex"),
        F.sha2(secrets.listed(F.col("base")), 256).alias("base_sha256"),
        secrets.listed(F.col("spans")).alias("spans"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality_knn, op2_line_spread, op3_sentence_spans, op4_toxicity_knn, op5_pfair_mix,
        op6_winnow, op7_merge_tree, op8_chat_events, op9_token_counts, op10_jaccard_vertical,
        op11_level_products, op12_rank_one_whitening, op13_entropy_secrets,
    )
}

_FOLD = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE: dict[str, str] = {}

ORACLE["op2_line_spread"] = f"""
WITH parts AS (
  SELECT doc_id, source, unnest(string_split(text, chr(10))) AS raw,
         generate_subscripts(string_split(text, chr(10)), 1) AS place FROM documents),
lines AS (SELECT *, trim(raw) AS line FROM parts),
wide AS (
  SELECT line, min((doc_id, place)) AS first FROM lines WHERE line <> ''
  GROUP BY line HAVING count(DISTINCT source) >= {line_dedup.MIN_SITES}),
marked AS (
  SELECT l.doc_id, l.raw, l.place, w.line IS NOT NULL AND (l.doc_id, l.place) <> w.first AS gone
  FROM lines l LEFT JOIN wide w ON l.line = w.line)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed,
       sha256(coalesce(string_agg(raw, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS text_sha256
FROM marked GROUP BY doc_id"""

_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ORACLE["op6_winnow"] = f"""
WITH d AS (SELECT doc_id, regexp_extract_all({_FOLD}, '{_WORDS}') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({_FOLD}, '{_WORDS}') AS w FROM benchmark),
size AS (SELECT item_id, w, least(len(w), {decontaminate.SPAN}) AS n FROM b WHERE len(w) > 0),
item AS (SELECT DISTINCT item_id, n, unnest(list_transform(range(1, len(w) - n + 2), lambda i: w[i:i + n - 1])) AS p FROM size),
sizes AS (SELECT DISTINCT n FROM item),
doc AS (SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS place,
               unnest(list_transform(range(1, len(w) - n + 2), lambda i: w[i:i + n - 1])) AS p
        FROM d, sizes WHERE len(w) >= n),
hit AS (SELECT doc_id, place, doc.n, item_id FROM doc JOIN item ON doc.p = item.p AND doc.n = item.n),
word AS (SELECT DISTINCT doc_id, unnest(range(place, place + n)) AS place FROM hit),
words AS (SELECT doc_id, count(*) AS n_hit FROM word GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)"""

ORACLE["op7_merge_tree"] = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents),
g AS (SELECT text_sha256, count(*) AS group_size, min((-n, doc_id)) AS best FROM d GROUP BY text_sha256)
SELECT doc_id, best[2] AS keep_id, group_size, doc_id = best[2] AS kept, text_sha256
FROM d JOIN g USING (text_sha256)"""

_CONTROL = chat_format.QUOTE.replace("(?=", "(")
ORACLE["op8_chat_events"] = f"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{CONTROL_TEXT}'
  UNION ALL SELECT -7, 1, 'assistant', '{CONTROL_TEXT}'),
sized AS (
  SELECT *, {len(chat_format.START) + len(chat_format.END) + 2} + length(role) + length(text)
            + len(regexp_extract_all(text, '{_CONTROL}')) AS shown FROM rows)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text)
                       FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(shown) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id"""

ORACLE["op10_jaccard_vertical"] = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all({_FOLD}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(w) - 3, 2)), lambda i: w[i:i + 4])) AS g
      FROM d WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id
         GROUP BY x.doc_id, y.doc_id),
link AS (SELECT a, b FROM common JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
         WHERE 100 * c >= 75 * (na.n + nb.n - c)),
edge AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (SELECT doc_id AS node, doc_id AS root FROM d
          UNION SELECT edge.b, reach.root FROM reach JOIN edge ON edge.a = reach.node WHERE reach.root < edge.b),
least AS (SELECT node, min(root) AS root FROM reach GROUP BY node)
SELECT doc_id, coalesce(n.n, 0) AS n_shingles, least.root AS component_id
FROM d LEFT JOIN n USING (doc_id) JOIN least ON least.node = doc_id"""


_TERMS = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
ORACLE["op11_level_products"] = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all({_FOLD}, '{_TERMS}') AS w FROM documents),
t AS (SELECT r, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS all_n FROM t GROUP BY lang, term
         HAVING count(DISTINCT r) >= {divergence.LEAST_DOCS}),
langs AS (SELECT lang, count(*) AS v, sum(all_n) AS n FROM kept GROUP BY lang),
held AS (SELECT lang, source, term, count(*) AS n FROM t JOIN kept USING (lang, term) GROUP BY lang, source, term),
size AS (SELECT lang, source, sum(n) AS n FROM held GROUP BY lang, source),
groups AS (SELECT lang, source, coalesce(size.n, 0) AS n FROM (SELECT DISTINCT lang, source FROM d)
           LEFT JOIN size USING (lang, source)),
rate AS (
  SELECT g.lang, g.source, k.term, coalesce(h.n, 0) AS c,
         1 + {divergence.UNIT} * (coalesce(h.n, 0) + 2)::HUGEINT // (g.n + 2 * l.v)::HUGEINT AS p,
         1 + {divergence.UNIT} * (k.all_n + 2)::HUGEINT // (l.n + 2 * l.v)::HUGEINT AS q
  FROM groups g JOIN langs l USING (lang) JOIN kept k USING (lang)
  LEFT JOIN held h ON h.lang = g.lang AND h.source = g.source AND h.term = k.term),
priced AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM rate a JOIN rate b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY a.lang, a.source, b.source),
pair AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN priced p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source),
term AS (SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // (p + q) AS value
         FROM rate WHERE c > 0 AND p > q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
       CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM (SELECT * FROM pair UNION ALL SELECT * FROM term)
QUALIFY part = 'pair' OR rank <= {divergence.TOP_TERMS}"""


def _secret_sql() -> str:
    quote = lambda p: p.replace("'", "''")
    kinds = [("assign", secrets.ASSIGN), ("access", secrets.ACCESS), ("hex", secrets.HEX)]
    for c in secrets.CLASSES:
        inside = "".join("\\" + x if x in "-+/_=" else x for x in c.alphabet)
        kinds.append((c.kind, f"[{inside}]{{{c.window},}}"))
    pieces = " UNION ALL ".join(
        f"SELECT r, '{kind}' AS kind, {place} AS place, unnest(regexp_extract_all(t, '{quote(p)}')) AS found, "
        f"unnest(string_split_regex(t, '{quote(p)}')) AS gap, "
        f"generate_subscripts(string_split_regex(t, '{quote(p)}'), 1) AS i FROM d"
        for place, (kind, p) in enumerate(kinds)
    )
    allowed = " OR ".join(
        [f"NOT regexp_matches(found, '{secrets.MIXED}')"] + [f"regexp_matches(found, '{p}')" for p in secrets.ALLOW])
    sizes = ", ".join(f"('{c.kind}', {c.window}, {c.bits})" for c in secrets.CLASSES)
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
piece AS ({pieces}),
placed AS (
  SELECT *, sum(coalesce(length(found), 0) + length(gap)) OVER (PARTITION BY r, kind ORDER BY i) AS until
  FROM piece),
span AS (SELECT r, kind, place, found, until - length(found) AS start, until FROM placed WHERE found IS NOT NULL),
base AS (
  SELECT r, kind, place, start, until FROM span
  WHERE place < 3 AND (kind <> 'assign' OR length(regexp_extract(found, '{quote(secrets.ASSIGN)}', 2)) >= {secrets.LEAST_ASSIGN})),
class(kind, w, bits) AS (VALUES {sizes}),
run AS (SELECT *, row_number() OVER () AS number FROM span JOIN class USING (kind) WHERE NOT ({allowed})),
win AS (SELECT *, unnest(range(0, length(found) - w + 1)) AS o FROM run),
hit AS (
  SELECT number, r, kind, place, start + o AS start, start + o + w AS until FROM win
  WHERE list_sum(list_transform(list_distinct(string_split(substring(found, CAST(o AS INTEGER) + 1, w), '')),
          lambda c: CAST(round({secrets.SCALE} * (w - length(replace(substring(found, CAST(o AS INTEGER) + 1, w), c, '')))
                     * log2(w - length(replace(substring(found, CAST(o AS INTEGER) + 1, w), c, '')))) AS BIGINT)))
        <= floor({secrets.SCALE} * w * (log2(w) - bits))),
part AS (
  SELECT *, sum(opens) OVER (PARTITION BY number ORDER BY start) AS island FROM (
    SELECT *, CASE WHEN start <= max(until) OVER (PARTITION BY number ORDER BY start
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS opens FROM hit)),
random AS (SELECT r, kind, place, min(start) AS start, max(until) AS until FROM part GROUP BY number, island, r, kind, place),
known AS (
  SELECT r, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
         count(*) FILTER (kind = 'hex') AS n_hex,
         string_agg(concat_ws(':', kind, start::BIGINT, until::BIGINT), ',' ORDER BY start, place) AS listed
  FROM base GROUP BY r),
every AS (
  SELECT r, string_agg(concat_ws(':', kind, start::BIGINT, until::BIGINT), ',' ORDER BY start, place) AS spans
  FROM (SELECT * FROM base UNION ALL SELECT * FROM random) GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(listed, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN known USING (r) LEFT JOIN every USING (r)"""


ORACLE["op13_entropy_secrets"] = _secret_sql()
