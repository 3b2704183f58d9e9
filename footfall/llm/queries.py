"""The operators applied to the given tables, one query each, and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.llm.ann import nearest
from footfall.llm.bpe import encode
from footfall.llm.collocations import MAX_WORDS, MIN_COUNT, TOP, collocations
from footfall.llm.common import importable, table, text_or_empty
from footfall.llm.exact_dedup import exact_dedup
from footfall.llm.langid import held_out, predict, train
from footfall.llm.license_scan import TEMPLATES, THRESHOLD, scan_licenses
from footfall.llm.minhash import near_duplicates
from footfall.llm.mixing import BLOCK_TOKENS, mix
from footfall.llm.pii import BASE_KINDS, find_pii
from footfall.llm.secret_scan import BASE_RULES, RULES, scan_secrets
from footfall.llm.sharding import even_tree, grown, put_in_shards
from footfall.llm.token_counts import count_tokens
from footfall.llm.variants import DAMAGE, MIN_LENGTH, TIMES, group_variants
from footfall.llm.variants import MIN_COUNT as MIN_WORD_COUNT
from footfall.session import work_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

BPE_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")

# No source is passed over more than twice as often as another.
MAX_REPEATS = 2


def query(function):
    @wraps(function)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        importable(spark)
        return function(spark, sf_dir)

    QUERIES[function.__name__] = run
    return run


@query
def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", "keep_id", "group_size", "kept", F.col("text_digest").alias("text_sha256")
    )


ORACLE_SQL["op2_exact_dedup"] = r"""
WITH t AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS x
  FROM documents
)
SELECT doc_id,
       min(doc_id) OVER (PARTITION BY x) AS keep_id,
       count(*) OVER (PARTITION BY x) AS group_size,
       row_number() OVER (PARTITION BY x ORDER BY doc_id NULLS LAST) = 1 AS kept,
       sha256(x) AS text_sha256
FROM t
"""


@query
def op5_hash_tree_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = text_or_empty("text")
    rows = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit("key").alias("law"),
    )
    tree = even_tree(8)
    return put_in_shards(rows, tree, next_tree=grown(tree))


@query
def op1_temperature_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    draws = mix(table(spark, sf_dir, "documents"), max_repeats=MAX_REPEATS)
    return draws.select(
        F.col("id").alias("doc_id"), "source", "tokens", "epoch", "block", "slot", "budget"
    )


# The bisection runs over the same multiples of 2 ** -21.
ORACLE_SQL["op1_temperature_mix"] = rf"""
WITH RECURSIVE t AS (
  SELECT doc_id, source, struct_pack(name := source) AS s,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) + 1 AS tokens
  FROM documents
), totals AS (
  SELECT s, sum(tokens)::BIGINT AS total FROM t GROUP BY s
), shares AS (
  SELECT s, total, total / sum(total) OVER () AS p FROM totals
), b(low, high) AS (
  SELECT -1::BIGINT, 2097152::BIGINT
  UNION ALL
  SELECT CASE WHEN ok THEN low ELSE mid END, CASE WHEN ok THEN mid ELSE high END
  FROM (
    SELECT low, high, (low + high) // 2 AS mid,
           (SELECT max(pow(p, ((low + high) // 2) / 2097152.0::DOUBLE) / p)
                   <= {MAX_REPEATS} * min(pow(p, ((low + high) // 2) / 2097152.0::DOUBLE) / p)
            FROM shares) AS ok
    FROM b WHERE high - low > 1
  )
), e AS (
  SELECT min(high) / 2097152.0::DOUBLE AS power FROM b
), w AS (
  SELECT s, total, pow(p, power) / sum(pow(p, power)) OVER () AS weight FROM shares, e
), g AS (
  SELECT s, total, greatest(total, floor(weight * max(total / weight) OVER ())::BIGINT) AS budget
  FROM w
), n AS (
  SELECT greatest(1, ceil(sum(budget) / {BLOCK_TOKENS}.0::DOUBLE))::BIGINT AS blocks FROM g
), d AS (
  SELECT doc_id, source, t.s, tokens, total, budget, epoch,
         greatest(1, ceil(budget / blocks::DOUBLE))::BIGINT AS per_block,
         md5('0:' || epoch || ':' || coalesce(doc_id::VARCHAR, '')) AS key
  FROM t JOIN g ON t.s IS NOT DISTINCT FROM g.s, n,
       UNNEST(range(0, ((budget + total - 1) // total)::BIGINT)) AS u(epoch)
), placed AS (
  SELECT *, coalesce(sum(tokens) OVER (
    PARTITION BY s, epoch ORDER BY key, doc_id NULLS FIRST, tokens
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM d
), cut AS (
  SELECT *, (epoch * total + start) // per_block AS block
  FROM placed WHERE epoch * total + start < budget
)
SELECT doc_id, source, tokens, epoch, block,
       row_number() OVER (PARTITION BY block ORDER BY key, source, doc_id NULLS FIRST, tokens) - 1
         AS slot,
       budget
FROM cut
"""


@query
def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode(docs, BPE_RANKS, packed=True, decoded=True).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2("packed", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_pii(docs, keep_text=False)
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))

    def joined(spans):
        one = lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])
        return F.array_join(F.transform(spans, one), ",")

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    counts = [count(kind).alias(f"n_{kind}") for kind in BASE_KINDS]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


@query
def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"), words=2)
    return found.select(
        F.col("id").alias("doc_id"),
        "n_shingles",
        "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"),
    )


@query
def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    known = docs.filter(docs.doc_id.isNotNull() & ~held_out())
    found = predict(docs.select("doc_id", "text"), train(known))
    return found.select(
        "doc_id", held_out().alias("held_out"), "lang_pred", F.col("lang_score").alias("score")
    )


@query
def op7_adaptive_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@query
def op4_trie_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return count_tokens(docs, BPE_RANKS, public_tokenizers.PATTERN, keep_text=False)


@query
def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files of a tree: a folder per source, and in it one per hundred ids."""
    folder = F.expr("CAST(doc_id DIV 100 AS STRING)")
    name = F.concat(F.col("doc_id").cast("string"), F.lit(".txt"))
    files = table(spark, sf_dir, "documents").select(
        "doc_id", F.concat_ws("/", "source", folder, name).alias("path"), "text"
    )
    return scan_licenses(files)


def _license_sql() -> str:
    quote = lambda text: "'" + text.replace("'", "''") + "'"
    values = ", ".join(
        f"({i}, {quote(name)}, {quote(notice)})" for i, (name, notice) in enumerate(TEMPLATES)
    )
    words = "list_filter(string_split_regex(lower({}), '[^a-z0-9]+'), lambda x: x <> '')"
    return rf"""
WITH templates(template, license, notice) AS (VALUES {values}),
notice AS (
  SELECT template, license, UNNEST({words.format('notice')}) AS term FROM templates
), files AS (
  SELECT row_number() OVER () AS f, doc_id,
         concat_ws('/', source, (doc_id // 100)::VARCHAR, doc_id::VARCHAR || '.txt') AS path,
         coalesce(text, '') AS text
  FROM documents
), df AS (
  SELECT term, count(*) AS n
  FROM (SELECT UNNEST(list_distinct({words.format('text')})) AS term FROM files)
  WHERE term IN (SELECT term FROM notice) GROUP BY term
), total AS (
  SELECT count(*) AS total FROM files
), idf AS (
  SELECT term, ln((1 + total) / (1 + coalesce(n, 0))) + 1 AS idf
  FROM (SELECT DISTINCT term FROM notice) LEFT JOIN df USING (term), total
), vector AS (
  SELECT template, license, term, count(*) * any_value(idf) AS v
  FROM notice JOIN idf USING (term) GROUP BY template, license, term
), length AS (
  SELECT template, sqrt(sum(v * v)) AS l FROM vector GROUP BY template
), passage AS (
  SELECT f, -1 AS line, text AS passage FROM files
  UNION ALL
  SELECT f, UNNEST(range(0, len(string_split(text, chr(10)))))::INTEGER,
         UNNEST(string_split(text, chr(10)))
  FROM files
), word AS (
  SELECT f, line, term, count(*) AS n
  FROM (SELECT f, line, UNNEST({words.format('passage')}) AS term FROM passage)
  GROUP BY f, line, term
), weighted AS (
  SELECT f, line, term, n * coalesce(idf, ln(1 + total) + 1) AS w
  FROM word LEFT JOIN idf USING (term), total
), size AS (
  SELECT f, line, sqrt(sum(w * w)) AS l FROM weighted GROUP BY f, line
), score AS (
  SELECT f, line, template, any_value(license) AS license,
         round(sum(w * v) / (any_value(size.l) * any_value(length.l)), 6) AS s
  FROM weighted JOIN vector USING (term) JOIN size USING (f, line) JOIN length USING (template)
  GROUP BY f, line, template
), top AS (
  SELECT f, line, s, license FROM score WHERE s >= {THRESHOLD}
  QUALIFY row_number() OVER (PARTITION BY f, line ORDER BY s DESC, template) = 1
), best AS (
  SELECT f, line, s, license FROM top
  QUALIFY row_number() OVER (PARTITION BY f ORDER BY s DESC, line) = 1
), holder AS (
  SELECT regexp_replace(path, '/?[^/]*$', '') AS dir, license
  FROM top JOIN files USING (f) WHERE line = -1
  QUALIFY row_number() OVER (PARTITION BY dir ORDER BY s DESC, license DESC) = 1
), up AS (
  SELECT f, path, UNNEST(range(0, len(string_split(path, '/')))) AS depth
  FROM files WHERE f NOT IN (SELECT f FROM best)
), inherited AS (
  SELECT f, license
  FROM (SELECT f, depth, array_to_string(string_split(path, '/')[1:depth], '/') AS dir FROM up)
       JOIN holder USING (dir)
  QUALIFY row_number() OVER (PARTITION BY f ORDER BY depth DESC) = 1
)
SELECT doc_id, path, coalesce(b.license, i.license) AS license, b.s AS similarity,
       CASE WHEN b.line >= 0 THEN b.line END AS line,
       CASE WHEN b.line >= 0 THEN 'header' WHEN b.line < 0 THEN 'file'
            WHEN i.f IS NOT NULL THEN 'directory' END AS origin
FROM files LEFT JOIN best b USING (f) LEFT JOIN inherited i USING (f)
"""


ORACLE_SQL["op9_license_scan"] = _license_sql()


@query
def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as versions: a file per source and hundred ids, and in it the id as version."""
    path = F.concat_ws("/", "source", F.expr("CAST(doc_id DIV 100 AS STRING)"))
    versions = table(spark, sf_dir, "documents").select("doc_id", path.alias("path"), "text")
    found = scan_secrets(versions, work_dir(spark, "secret-ledger"), version_col="doc_id")
    kinds = [r.kind for r in BASE_RULES]

    def joined(spans):
        one = lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])
        return F.array_join(F.transform(spans, one), ",")

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    base = F.filter("spans", lambda s: s["kind"].isin(*kinds))
    return found.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in kinds],
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


def _secret_sql() -> str:
    def matches(i, rule):
        pattern = "'" + rule.pattern.replace("'", "''") + "'"
        found = f"regexp_extract_all(text, {pattern})"
        return f"""
  SELECT r, {i} AS rank, '{rule.kind}' AS kind, {rule.least} AS least,
         UNNEST(range(len({found}))) AS nth,
         UNNEST({found}) AS match,
         UNNEST(regexp_extract_all(text, {pattern}, {rule.group})) AS value,
         UNNEST(string_split_regex(text, {pattern})[1:len({found})]) AS piece
  FROM t WHERE regexp_matches(text, {pattern})"""

    parts = "\n  UNION ALL".join(matches(i, rule) for i, rule in enumerate(RULES))
    joined = "string_agg({}kind || ':' || start || ':' || stop, ',' ORDER BY start, rank, stop)"
    base = joined.format("") + f" FILTER (WHERE rank < {len(BASE_RULES)})"
    counts = ", ".join(
        f"count(kind) FILTER (WHERE kind = '{rule.kind}') AS n_{rule.kind}" for rule in BASE_RULES
    )
    return f"""
WITH t AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
), m AS ({parts}
), ended AS (
  SELECT *, sum(len(piece) + len(match)) OVER (PARTITION BY r, rank ORDER BY nth)::BIGINT AS stop
  FROM m
), s AS (
  SELECT r, rank, kind, stop - len(match) AS start, stop FROM ended WHERE len(value) >= least
)
SELECT doc_id, {counts}, sha256(coalesce({base}, '')) AS base_sha256,
       coalesce({joined.format("")}, '') AS spans
FROM t LEFT JOIN s USING (r) GROUP BY r, doc_id
"""


ORACLE_SQL["op13_secret_scan"] = _secret_sql()


@query
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents").select("lang", "text"))


ORACLE_SQL["op12_collocations"] = rf"""
WITH t AS (
  SELECT coalesce(lang, 'und') AS lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
           AS text
  FROM documents
), piece AS (
  SELECT lang, UNNEST(string_split_regex(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM t
), w AS (
  SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w
  FROM piece
), total AS (
  SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang
), start AS (
  SELECT lang, w, UNNEST(range(1, len(w) + 1)) AS i FROM w
), gram AS (
  SELECT lang, w[i:i + m - 1] AS words
  FROM start, UNNEST(range(1, {MAX_WORDS + 1})) AS u(m) WHERE i + m - 1 <= len(w)
), f AS (
  SELECT lang, words, count(*) AS f FROM gram GROUP BY lang, words
  HAVING count(*) >= {MIN_COUNT}
), cand AS (
  SELECT lang, words, f AS a FROM f WHERE len(words) > 1
), cut AS (
  SELECT c.lang, c.words, a, n, k, l.f AS l, r.f AS r,
         ((1000::HUGEINT * a * n) // (l.f::HUGEINT * r.f))::BIGINT AS score
  FROM (SELECT *, UNNEST(range(1, len(words))) AS k FROM cand) c
       JOIN total USING (lang)
       JOIN f l ON l.lang = c.lang AND l.words = c.words[1:k]
       JOIN f r ON r.lang = c.lang AND r.words = c.words[k + 1:]
), best AS (
  SELECT * EXCLUDE (words), array_to_string(words, ' ') AS phrase, len(words) AS size FROM cut
  QUALIFY row_number() OVER (PARTITION BY lang, words ORDER BY score, k) = 1
), kept AS (
  SELECT * FROM best b WHERE NOT EXISTS (
    FROM best x
    WHERE x.lang = b.lang AND x.size > b.size AND 100 * x.a >= 100 * b.a
          AND contains(' ' || x.phrase || ' ', ' ' || b.phrase || ' '))
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
       phrase, a, l, r, n, score
FROM kept
QUALIFY rank <= {TOP}
"""


@query
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_variants(table(spark, sf_dir, "documents").select("doc_id", "text"))


def _variant_sql() -> str:
    """CRC-32 by its table of 256 steps; near words by what is left when a letter goes."""
    steps = []
    for i in range(256):
        for _ in range(8):
            i = i >> 1 ^ (0xEDB88320 if i & 1 else 0)
        steps.append(i)
    return rf"""
WITH RECURSIVE t AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS id,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
           AS text
  FROM documents
), run AS (
  SELECT id, UNNEST(regexp_extract_all(text, '[a-z\x{{C0}}-\x{{FF}}]+')) AS run FROM t
), counted AS (
  SELECT id, run, count(*) AS n FROM run WHERE len(run) >= {MIN_LENGTH} GROUP BY id, run
), bytes AS (
  SELECT run, n, hex(encode(id || ':' || run)) AS h FROM counted
), crc AS (
  SELECT run, n, xor(list_reduce(
    list_transform(range(len(h) // 2), lambda i: ('0x' || h[2 * i + 1:2 * i + 2])::UBIGINT),
    lambda c, b: xor(c >> 8, ({steps}::UBIGINT[])[((xor(c, b) & 255) + 1)::BIGINT]),
    4294967295::UBIGINT), 4294967295::UBIGINT) AS h
  FROM bytes
), word AS (
  SELECT CASE WHEN h % {DAMAGE} = 0
              THEN run[1:(h % len(run))::BIGINT] || run[(h % len(run))::BIGINT + 2:] ELSE run
         END AS word, sum(n)::BIGINT AS n
  FROM crc GROUP BY 1 HAVING len(word) >= {MIN_LENGTH} AND sum(n) >= {MIN_WORD_COUNT}
), cut AS (
  SELECT word, n, i, word[1:i] || word[i + 2:] AS rest
  FROM (SELECT word, n, UNNEST(range(len(word))) AS i FROM word)
), near AS (
  SELECT a.word, b.word AS near, b.n AS near_n
  FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION
  SELECT a.word, b.word, b.n FROM cut a JOIN word b ON a.rest = b.word
  UNION
  SELECT b.word, a.word, a.n FROM cut a JOIN word b ON a.rest = b.word
), top AS (
  SELECT word, count(*) AS n_near, arg_min(near, (-near_n, near)) AS form, max(near_n) AS form_n
  FROM near GROUP BY word
), formed AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near,
         CASE WHEN form_n >= {TIMES} * n THEN form END AS form,
         CASE WHEN form_n >= {TIMES} * n THEN form_n END AS form_n
  FROM word LEFT JOIN top USING (word)
), path(word, root) AS (
  SELECT word, word FROM formed
  UNION ALL
  SELECT p.word, f.form FROM path p JOIN formed f ON f.word = p.root WHERE f.form IS NOT NULL
)
SELECT f.*, p.root
FROM formed f JOIN path p ON p.word = f.word JOIN formed e ON e.word = p.root WHERE e.form IS NULL
"""


ORACLE_SQL["op11_spelling_variants"] = _variant_sql()
