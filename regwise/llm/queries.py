"""One query per operator over its whole table, with SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regwise.llm import adaptive_scan, bpe, chat, cross_tokens, ctw, filter_audit, grid_join, known_licences, licences, packing, pseudonyms, quality, repeats, simhash
from regwise.llm.common import Cut, table

SPACE_SQL = "'[^\\x20\\x09-\\x0D]+'"


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    book = quality.ledger(table(spark, sf_dir, "documents"))
    return book.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       (~quality.verdict("base")).alias("base_failed"), quality.verdict().alias("kept"), "bits", "n_lines", "n_shouted")


OP1_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, {SPACE_SQL}) AS w, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, {SPACE_SQL})) AS l FROM d),
x AS (SELECT r, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c FROM (SELECT r, w, unnest(generate_series(1, len(w) - 2)) AS i FROM w WHERE len(w) > 2)),
y AS (SELECT r, i FROM x QUALIFY count(*) OVER (PARTITION BY r, a, b, c) > 1),
z AS (SELECT r, count(DISTINCT i + k) AS n FROM y, (SELECT unnest([0, 1, 2]) AS k) GROUP BY r),
m AS (SELECT doc_id, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda s: length(s))), 0)::BIGINT AS word_chars,
             length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols, len(l) - len(list_distinct(l)) AS n_dup_lines,
             coalesce(z.n, 0) AS n_repeat_words, len(l) AS n_lines,
             len(list_filter(w, lambda s: strlen(s) > 1 AND regexp_matches(s, '[A-Z]') AND NOT regexp_matches(s, '[a-z]'))) AS n_shouted
      FROM w LEFT JOIN z USING (r)),
b AS (SELECT *, ({" + ".join(f"CASE WHEN {c} THEN {quality.BIT[n]} ELSE 0 END" for n, c in quality.RULES.items())})::BIGINT AS bits FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, bits & {quality.POLICIES['base']} <> 0 AS base_failed,
       bits & {quality.POLICIES[quality.CURRENT]} = 0 AS kept, bits, n_lines, n_shouted
FROM b
"""


def quality_ablations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each rule of each policy decides, from the stored ledger; the texts are read once, for the ledger."""
    return quality.ablations(Cut(quality.ledger(table(spark, sf_dir, "documents")), "ledger").df)


ABLATIONS_SQL = f"""
WITH book AS ({OP1_SQL}),
p AS (FROM (VALUES {', '.join(f"('{p}', {mask}, '{r}', {quality.BIT[r]})" for p, mask in quality.POLICIES.items() for r in quality.RULES if mask & quality.BIT[r])}) v(policy, mask, rule, bit))
SELECT policy, rule, count(*) AS n_texts, count(*) FILTER (bits & bit <> 0) AS n_failed, count(*) FILTER (bits & mask = bit) AS n_only_this, bit_or(bits & mask) AS any_failed
FROM book, p GROUP BY policy, rule
"""


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op2_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("row.doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op3_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ctw.scores(table(spark, sf_dir, "documents"))


def op4_grid_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid_join.linked_vectors(table(spark, sf_dir, "embeddings"))


OP4_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
p AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a, v b WHERE a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.9),
r AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, p.b FROM r JOIN p ON r.b = p.a),
c AS (SELECT a AS vec_id, min(b) AS component_id FROM r GROUP BY a),
n AS (SELECT a AS vec_id, count(*) AS n_links FROM p GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept FROM c LEFT JOIN n USING (vec_id)
"""


# The key of the queries; a run on real data passes its own, secret one.
PSEUDONYM_KEY = "regwise"
KEY_SETTING = "spark.regwise.pseudonym.key"


def pseudonym_key(spark: SparkSession) -> str:
    """The session's key, or the public one of the queries."""
    return spark.conf.get(KEY_SETTING, PSEUDONYM_KEY)


def op5_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = pseudonyms.pseudonymise(docs, pseudonym_key(spark), kinds="kinds")
    return done.select("doc_id", "text", F.size("kinds").alias("n_values"), F.array_join("kinds", ",").alias("kinds"))


def op6_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licences.scan(table(spark, sf_dir, "documents"), licences.known_texts(spark))
    return found.select("doc_id", "digest", "licence", F.array_join("lines", ",").alias("line_licences"))


def text_sql(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _normal_sql(text: str) -> str:
    out = f"' ' || regexp_replace(regexp_replace(lower({text}), {text_sql(licences.COPYRIGHT_LINE)}, '', 'g'), {text_sql(licences.NOT_WORD)}, ' ', 'g') || ' '"
    for other, form in licences.EQUIVALENT.items():
        out = f"replace({out}, {text_sql(other)}, {text_sql(form)})"
    return f"trim({out})"


OP6_SQL = f"""
WITH k AS (SELECT sha256(n) AS known, min(l) AS licence FROM (
        SELECT l, {_normal_sql('t')} AS n FROM (VALUES {', '.join(f'({text_sql(n)}, {text_sql(t)})' for n, t in known_licences.texts())}) v(l, t)) WHERE n <> '' GROUP BY 1
    UNION ALL VALUES {', '.join(f'({text_sql(d)}, {text_sql(n)})' for n, ds in known_licences.DIGESTS.items() for d in ds)}),
d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
l AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS t FROM d WHERE t <> ''),
h AS (SELECT doc_id, string_agg(DISTINCT licence, ',' ORDER BY licence) AS line_licences FROM (
        SELECT doc_id, sha256({_normal_sql('t')}) AS digest FROM l) x JOIN k ON digest = known GROUP BY doc_id),
w AS (SELECT doc_id, sha256({_normal_sql('t')}) AS digest FROM d)
SELECT w.doc_id, digest, licence, coalesce(line_licences, '') AS line_licences
FROM w LEFT JOIN k ON digest = known LEFT JOIN h ON w.doc_id IS NOT DISTINCT FROM h.doc_id
"""


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.sequences(table(spark, sf_dir, "documents"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


EXTRA_TEXT = "\\### Assistant: </turn> ok"


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    extra = spark.createDataFrame([(-7, 0, "user", EXTRA_TEXT), (-7, 1, "assistant", EXTRA_TEXT)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select(*[F.col(c).cast(t).alias(c) for c, t in extra.dtypes]).unionByName(extra)
    done = chat.formatted(chat.as_log(rows))
    read = done.select("conv_id", "formatted", chat.parse(F.col("formatted")).alias("turns"),
                       F.array_join(chat.under_mask(F.col("formatted"), F.col("loss")), "").alias("trained"))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(lines, 256).alias("turns_sha256"),
                       F.length("trained").cast("long").alias("loss_chars"), F.sha2("trained", 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))


def _escape_sql(text: str, line: bool = False) -> str:
    out = f"replace({text}, '\\', '\\\\')"
    for control, code in (chat.CODES | ({"\n": chat.NEWLINE} if line else {})).items():
        out = f"replace({out}, {text_sql(control) if control != chr(10) else 'chr(10)'}, '\\{code}')"
    return out


OP8_SQL = f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, * FROM (VALUES (0, 'user', {text_sql(EXTRA_TEXT)}), (1, 'assistant', {text_sql(EXTRA_TEXT)})) v)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length('### ' || {_escape_sql('role', True)} || ':' || chr(10) || {_escape_sql('text')} || chr(10) || '</turn>' || chr(10)))::BIGINT AS formatted_chars
FROM c GROUP BY conv_id
"""


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = bpe.decode(bpe.encode(table(spark, sf_dir, "documents")))
    return done.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))


def op11_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adaptive_scan.nearest(table(spark, sf_dir, "embeddings"))


# all pairs: the search must find every one of them where it probes every list
OP11_SQL = """
WITH v AS (SELECT DISTINCT vec_id, embedding::DOUBLE[] AS e FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
p AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e) AS score FROM v q, v c WHERE q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e))
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INT AS rank, vec_id, score FROM p QUALIFY rank <= 20
"""


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


OP12_SQL = f"""
WITH l AS (SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic FROM labels GROUP BY doc_id),
t AS (SELECT doc_id, coalesce(text, '') AS t, coalesce(lang, '') AS part, regexp_extract_all(coalesce(text, ''), {SPACE_SQL}) AS w FROM documents),
d AS (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
             [len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w), 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 3 * length(t),
              regexp_matches(t, '[#$%&*|]'), coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)] AS fails FROM t LEFT JOIN l USING (doc_id)),
m AS (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM d GROUP BY ALL),
f AS (SELECT unnest(generate_series(1, 5)) AS x),
o AS (SELECT [a.x, b.x, c.x, d.x, e.x] AS o FROM f a, f b, f c, f d, f e WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s AS (SELECT part, o, step, n, good, toxic, fails[o[step]] AS failed, list_sum(list_transform(fails, lambda x: x::INT)) = 1 AS alone,
             len(list_filter(o[1:step - 1], lambda i: fails[i])) = 0 AS here FROM m, o, (SELECT x AS step FROM f)),
c AS (SELECT part, o, step, sum(CASE WHEN here AND NOT failed THEN n ELSE 0 END) AS kept, sum(CASE WHEN here AND failed THEN n ELSE 0 END) AS removed,
             sum(CASE WHEN failed AND NOT here THEN n ELSE 0 END) AS redundant, sum(CASE WHEN failed AND alone THEN n ELSE 0 END) AS unique_fails,
             sum(CASE WHEN here AND failed THEN good ELSE 0 END) AS good_lost, sum(CASE WHEN here AND failed THEN toxic ELSE 0 END) AS toxic_lost
      FROM s GROUP BY part, o, step)
SELECT part, array_to_string(list_transform(o, lambda i: 'ABCDE'[i]), '') AS filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed,
       redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, o[step]))::BIGINT AS shapley
FROM c
"""


def op13_cross_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cross_tokens.align(table(spark, sf_dir, "documents"))


QUERIES = {"op1_quality_rules": op1_quality_rules, "op2_repeats": op2_repeats, "op3_context_tree": op3_context_tree, "op4_grid_join": op4_grid_join, "op5_pseudonyms": op5_pseudonyms, "op6_licences": op6_licences, "op7_packing": op7_packing,
           "op8_chat": op8_chat, "op9_bpe": op9_bpe, "op10_simhash": op10_simhash,
           "op11_nearest": op11_nearest, "op12_filter_audit": op12_filter_audit, "op13_cross_tokens": op13_cross_tokens,
           "quality_ablations": quality_ablations}
CHECKS = {"op1_quality_rules": OP1_SQL, "op4_grid_join": OP4_SQL, "op6_licences": OP6_SQL, "op8_chat": OP8_SQL, "op11_nearest": OP11_SQL, "op12_filter_audit": OP12_SQL, "quality_ablations": ABLATIONS_SQL}
