"""The registered queries of this package, each over its whole table, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bytebpe, conversations, exact, interactions, jaccard, langid, lines, packing, phrases, pieces, quality, suffixes, toxicity
from .io import documents, real_id

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

#: Separators of words and the white space stripped from line keys, as a DuckDB expression.
_SPACES = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def tokenizer_path(name: str) -> str:
    """Place of an installed public tokenizer file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLE[fn.__name__] = sql
        return fn

    return register


@query()
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, base verdict and adaptive verdict of every document."""
    return quality.quality_rules(documents(spark, sf_dir))


@query(f"""
WITH docs AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
     line AS (SELECT doc_id, generate_subscripts(lines, 1) AS pos, unnest(lines) AS line FROM docs),
     keyed AS (SELECT doc_id, pos, line, {_LOWER.format(f"trim(line, {_SPACES})")} AS key FROM line),
     owner AS (SELECT key, min(doc_id) AS owner, count(DISTINCT doc_id) AS n FROM keyed WHERE length(key) >= 10 GROUP BY key),
     judged AS (SELECT k.doc_id, k.pos, k.line, coalesce(o.n >= 2 AND o.owner <> k.doc_id, false) AS dropped FROM keyed k LEFT JOIN owner o ON k.key = o.key AND length(k.key) >= 10)
SELECT doc_id, count(*)::BIGINT AS n_lines, (count(*) FILTER (dropped))::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY doc_id""")
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines kept and dropped of every document."""
    return lines.line_digests(documents(spark, sf_dir))


@query()
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from the labels outside fold 0 of 5."""
    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.fit_toxicity(docs, labels, ~langid.held_out(0, 5))
    scored = toxicity.toxicity(docs, model)
    return scored.select("doc_id", langid.held_out(0, 5).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_segments")


@query(f"""
WITH docs AS (SELECT doc_id, {_LOWER.format("coalesce(text, '')")} AS norm FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
FROM docs WINDOW w AS (PARTITION BY norm)""")
def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group of equal texts of every document."""
    return exact.exact_duplicates(documents(spark, sf_dir))


@query()
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned outside fold 2 of 4."""
    docs = documents(spark, sf_dir)
    model = langid.fit_language_model(docs, ~langid.held_out(2, 4))
    found = langid.predict_language(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), model)
    return found.select("doc_id", langid.held_out(2, 4).alias("held_out"), F.col("_lang").alias("lang_pred"), F.col("_score").alias("score"), F.col("_accepted").alias("accepted"))


@query(rf"""
WITH RECURSIVE docs AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS w FROM documents),
     starts AS (SELECT r, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM docs WHERE len(w) > 0),
     shingle AS (SELECT DISTINCT r, md5_number(array_to_string(w[i:i + 2], ' ')) AS h FROM starts),
     sizes AS (SELECT r, count(*) AS n, md5(string_agg(h::VARCHAR, ' ' ORDER BY h)) AS whole FROM shingle GROUP BY r),
     kind AS MATERIALIZED (SELECT whole, min(r) AS k, any_value(n) AS n FROM sizes GROUP BY whole),
     placed AS MATERIALIZED (SELECT k, n, h, row_number() OVER (PARTITION BY k ORDER BY many, h) AS place
       FROM kind JOIN shingle ON shingle.r = kind.k JOIN (SELECT h, count(*) AS many FROM shingle JOIN kind ON kind.k = shingle.r GROUP BY h) USING (h)),
     prefix AS (SELECT k, n, h FROM placed WHERE place <= n - (90 * n + 99) // 100 + 1),
     pair AS (SELECT DISTINCT a.k AS u, b.k AS v FROM prefix a JOIN prefix b ON a.h = b.h AND a.k < b.k AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)),
     link AS MATERIALIZED (SELECT u, v FROM pair JOIN placed a ON a.k = u JOIN placed b ON b.k = v AND b.h = a.h GROUP BY u, v, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
     ways AS MATERIALIZED (SELECT u, v FROM link UNION ALL SELECT v, u FROM link),
     reach AS (SELECT k AS x, k AS y FROM kind UNION SELECT x, v FROM reach JOIN ways ON u = y),
     least_id AS (SELECT whole, min(doc_id) AS least FROM sizes JOIN docs USING (r) GROUP BY whole),
     root AS (SELECT a.whole, min(least) AS root FROM kind a JOIN reach ON x = a.k JOIN kind b ON b.k = y JOIN least_id ON least_id.whole = b.whole GROUP BY a.whole)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(root, doc_id) AS component_id
FROM docs LEFT JOIN sizes USING (r) LEFT JOIN root USING (whole)""")
def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document under 3-word shingle similarity 0.9."""
    found = jaccard.jaccard_groups(documents(spark, sf_dir), k=3, num=90, den=100)
    return found.select(real_id(), "n_shingles", real_id("component_id"))


@query(r"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
     starts AS (SELECT r, unnest(range(1, len(w) - 33)) AS i, w FROM docs WHERE len(w) >= 35),
     windows AS MATERIALIZED (SELECT r, i, md5(array_to_string(w[i:i + 34], ' ')) AS h FROM starts),
     hit AS (SELECT r, i FROM windows WHERE h IN (SELECT h FROM windows GROUP BY h HAVING count(*) > 1)),
     gone AS (SELECT DISTINCT r, unnest(range(i, i + 35)) AS i FROM hit),
     word AS (SELECT r, generate_subscripts(w, 1) AS i, unnest(w) AS x FROM docs),
     kept AS (SELECT r, count(*) AS n, string_agg(x, ' ' ORDER BY i) AS text FROM word ANTI JOIN gone USING (r, i) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (r)""")
def op7_phrase_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words left of every document after recurring 35-word windows are removed."""
    return phrases.phrase_digests(documents(spark, sf_dir))


@query("""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
     bytes AS (SELECT r, doc_id, strlen(text) AS n, hex(encode(text)) AS x FROM docs),
     page AS (SELECT r, n, p, x[2 * p + 1:2 * p + 2798] AS x FROM (SELECT r, n, x, unnest(range(0, n, 1000)) AS p FROM bytes WHERE n >= 400)),
     starts AS (SELECT r, p, x, unnest(range(0, least(1000, n - 399 - p))) AS k FROM page),
     windows AS MATERIALIZED (SELECT r, p + k AS i, md5(x[2 * k + 1:2 * k + 800]) AS h FROM starts),
     hit AS (SELECT r, i, i > coalesce(lag(i) OVER (PARTITION BY r ORDER BY i) + 400, -1) AS opens FROM windows WHERE h IN (SELECT h FROM windows GROUP BY h HAVING count(*) > 1)),
     island AS (SELECT r, i, sum(opens::INT) OVER (PARTITION BY r ORDER BY i) AS s FROM hit),
     span AS (SELECT r, s, min(i) AS a, max(i) + 400 AS b FROM island GROUP BY r, s),
     edge AS (SELECT r, a AS upto, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS since FROM span UNION ALL SELECT r, max(n), max(b) FROM span JOIN bytes USING (r) GROUP BY r),
     left_over AS (SELECT r, string_agg(x[2 * since + 1:2 * upto], '' ORDER BY since) AS x FROM edge JOIN bytes USING (r) WHERE upto > since GROUP BY r),
     lost AS (SELECT r, sum(b - a) AS n_removed, count(*) AS n_spans FROM span GROUP BY r)
SELECT doc_id, n::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(CASE WHEN n_spans IS NULL THEN bytes.x ELSE coalesce(left_over.x, '') END)) AS kept_sha256
FROM bytes LEFT JOIN lost USING (r) LEFT JOIN left_over USING (r)""")
def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes left of every document after recurring 400-byte strings are removed."""
    return suffixes.suffix_digests(documents(spark, sf_dir))


@query()
def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of every document, the decoded text, and agreement with the sentencepiece library."""
    found = pieces.piece_tokens(documents(spark, sf_dir), tokenizer_path("piece_bpe_32k.model"), with_ids=False)
    return found.select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"), "parity")


@query()
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Power-of-two pieces of every document."""
    found = packing.packed_pieces(documents(spark, sf_dir), tokenizer_path("byte_bpe_50k.json"), with_ids=False)
    return found.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


@query(r"""
WITH named AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         coalesce(doc_id, 9223372036854775807) AS id FROM documents),
marks AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
failed AS (
  SELECT n.part, coalesce(m.good, 0) AS good, coalesce(m.toxic, 0) AS toxic,
         concat(CASE WHEN len(words) < 50 THEN 'A' ELSE '' END,
                CASE WHEN 100 * len(list_distinct(words)) < 65 * len(words) THEN 'B' ELSE '' END,
                CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text) THEN 'C' ELSE '' END,
                CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END,
                CASE WHEN id > min(id) OVER (PARTITION BY text) THEN 'E' ELSE '' END) AS fails
  FROM named n LEFT JOIN marks m ON n.doc_id = m.doc_id),
counted AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM failed GROUP BY part, fails),
letter AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM letter a, letter b, letter c, letter d, letter e
           WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
ranked AS (SELECT c.*, o.filter_order, coalesce(list_min(list_transform(string_split(nullif(c.fails, ''), ''), lambda f: instr(o.filter_order, f))), 9) AS gone FROM counted c, orders o),
steps AS (SELECT unnest([1, 2, 3, 4, 5]) AS step),
cells AS (
  SELECT r.part, r.filter_order, s.step, substr(r.filter_order, s.step, 1) AS filter,
         coalesce(sum(n) FILTER (gone > step), 0) AS kept, coalesce(sum(n) FILTER (gone = step), 0) AS removed,
         coalesce(sum(n) FILTER (gone < step AND contains(fails, substr(filter_order, step, 1))), 0) AS redundant,
         coalesce(sum(n) FILTER (fails = substr(filter_order, step, 1)), 0) AS unique_fails,
         coalesce(sum(good) FILTER (gone = step), 0) AS good_lost, coalesce(sum(toxic) FILTER (gone = step), 0) AS toxic_lost
  FROM ranked r, steps s GROUP BY r.part, r.filter_order, s.step)
SELECT part, filter_order, step::INTEGER AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails,
       good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, filter))::BIGINT AS shapley
FROM cells""")
def op11_filter_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Removals of five filters under every order, by source."""
    return interactions.filter_interactions(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


@query()
def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of every document, and the bytes they decode to."""
    found = bytebpe.encoded(documents(spark, sf_dir), tokenizer_path("byte_bpe_50k.tiktoken"), with_ids=False)
    return found.select("doc_id", "n_tokens", "n_split", "ids_sha256", "decoded_sha256")


def _repair_sql() -> str:
    """Backward recursion over the turns; v holds, for the states nothing, s, u, a, the best (cost, audit, lines) of what follows."""
    wanted, role = (3, 3, 4, 3), {3: "user", 4: "assistant"}

    def option(cost: str, edit: str, line: str | None, to: int) -> str:
        lines = f"list_prepend({line}, v[{to}].t)" if line else f"v[{to}].t"
        return f"{{'c': {cost} + v[{to}].c, 'a': '{edit}' || v[{to}].a, 't': {lines}}}"

    best = lambda *options: f"list_sort([{', '.join(options)}])[1]"
    inserted = lambda at, to: f"{{'c': 2 + {at}.c, 'a': 'I' || {at}.a, 't': list_prepend('{role[to]}:', {at}.t)}}"
    kept = {1: "CASE kind WHEN 's' THEN 2 WHEN 'u' THEN 3 END", 2: "CASE kind WHEN 'u' THEN 3 END", 3: "CASE kind WHEN 'a' THEN 4 END", 4: "CASE kind WHEN 'u' THEN 3 END"}
    base = []
    for q in (1, 2, 3, 4):
        keep = f"CASE WHEN fault < 2 AND ({kept[q]}) IS NOT NULL THEN {option('fault', 'K', 'line', 0).replace('v[0]', f'v[{kept[q]}]')} ELSE far END"
        rerole = f"CASE WHEN fault < 2 THEN {option('2 + fault', 'R', f"'{role[wanted[q - 1]]}:' || text", wanted[q - 1])} ELSE far END"
        base.append(f"{best(option('3', 'D', None, q), keep, rerole)} AS b{q}")
    space = _SPACES
    return f"""
WITH RECURSIVE
bits AS (SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS t),
hashed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda x: ascii(x)::BIGINT)),
             lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8))) % 20 AS damage
  FROM conversations, bits),
damaged AS (
  SELECT conv_id, turn, CASE WHEN damage = 4 THEN 'user' ELSE role END AS role,
         CASE damage WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM hashed, unnest(CASE WHEN damage = 3 THEN [1, 2] WHEN damage = 0 THEN []::INT[] ELSE [1] END)),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i, row_number() OVER (PARTITION BY conv_id, role, text) AS copy, trim(text, {space}) AS core FROM damaged),
judged AS (
  SELECT conv_id, turn, i, left(role, 1) AS kind, role || ':' || text AS line, text,
         left(lag(role) OVER (PARTITION BY conv_id ORDER BY i), 1) || left(role, 1) AS pair, core = '' AS is_blank,
         core <> '' AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS is_repeat, right(core, 1) NOT IN ('.', '!', '?') AS is_open FROM placed),
faulty AS (SELECT *, CASE WHEN is_blank OR is_repeat THEN 2 WHEN is_open THEN 1 ELSE 0 END::BIGINT AS fault FROM judged),
counted AS (
  SELECT c.conv_id, count(i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (is_blank) AS blank,
         count(*) FILTER (is_repeat) AS duplicate, count(*) FILTER (fault = 1) AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN faulty f ON c.conv_id IS NOT DISTINCT FROM f.conv_id GROUP BY c.conv_id),
walk AS (
  SELECT conv_id, n AS i, [{{'c': 0::BIGINT, 'a': '', 't': []::VARCHAR[]}}, {{'c': 4::BIGINT, 'a': 'II', 't': ['user:', 'assistant:']}},
                           {{'c': 2::BIGINT, 'a': 'I', 't': ['assistant:']}}, {{'c': 0::BIGINT, 'a': '', 't': []::VARCHAR[]}}] AS v FROM counted
  UNION ALL
  SELECT conv_id, i, [{best('b1', inserted('f3', 3))}, {best('b2', inserted('f3', 3))}, f3, f4] AS v
  FROM (SELECT conv_id, i, b1, b2, {best('b3', inserted('b4', 4))} AS f3, {best('b4', inserted('b3', 3))} AS f4
        FROM (SELECT w.conv_id, w.i - 1 AS i, {', '.join(base)}
              FROM (SELECT *, {{'c': 1000000000000, 'a': '', 't': []::VARCHAR[]}} AS far FROM walk) w JOIN faulty f ON w.conv_id IS NOT DISTINCT FROM f.conv_id AND w.i = f.i)))
SELECT c.conv_id, gaps::BIGINT AS gaps, blank::BIGINT AS blank, duplicate::BIGINT AS duplicate, truncated::BIGINT AS truncated, illegal::BIGINT AS illegal,
       v[1].c::BIGINT AS cost, v[1].a AS audit, sha256(array_to_string(v[1].t, chr(10))) AS repaired_sha256
FROM counted c JOIN walk w ON c.conv_id IS NOT DISTINCT FROM w.conv_id AND w.i = 0"""


@query(_repair_sql())
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cheapest structure repair of every damaged conversation."""
    return conversations.repaired_conversations(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
