"""The registered queries of this package, with production parameters, and their DuckDB statements."""

from __future__ import annotations

import secrets
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import (
    bpe,
    crf,
    decontaminate,
    jaccard,
    language,
    licences,
    mixing,
    prefixes,
    pseudonyms,
    rules,
    sharding,
    toxicity,
    whitening,
)
from starloom.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op2_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: Session setting that holds the secret of the pseudonyms. Without it a new one is drawn, which nobody keeps.
PSEUDONYM_KEY = "spark.starloom.pseudonyms.key"


def op4_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = spark.conf.get(PSEUDONYM_KEY, None) or secrets.token_hex(16)
    return pseudonyms.pseudonymise(table(spark, sf_dir, "documents"), key)


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = rules.apply_rules(table(spark, sf_dir, "documents"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.detect(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crf.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents"))


#: Sources by domain; a parameter of the mixture, as are the weights.
DOMAINS = {f"src{n}": "web" if n < 10 else "books" if n < 15 else "reference" for n in range(20)}
WEIGHTS = ({"web": 50, "books": 30, "reference": 20}, {"en": 60, "de": 15, "fr": 15, "es": 10}, {})


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"), 50, 2, "mix-1", DOMAINS, WEIGHTS)
    renamed = {c: c[1:] for c in mixing.LEAF} | {"_tokens": "n_tokens", "_whole": "epochs", "_part": "part_tokens"}
    return mixed.select("doc_id", *[F.col(c).alias(name) for c, name in renamed.items()])


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixes.prefix_trie(table(spark, sf_dir, "conversations"))


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    encoded = bpe.encode(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    return bpe.decode(encoded, ranks).select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("raw", 256).alias("decoded_sha256"),
    )


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings")).withColumn(
        "deviation", F.expr("try_cast(deviation as bigint)")
    )


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_language_id,
        op2_licences,
        op3_decontamination,
        op4_pseudonyms,
        op5_quality_rules,
        op6_toxicity,
        op7_line_quality,
        op8_jaccard_join,
        op9_mixing,
        op10_sharding,
        op11_prefix_trie,
        op12_byte_bpe,
        op13_whitening,
    )
}

_WORD = r"[^\x20\x09-\x0D]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_STOP = ", ".join(f"'{w}'" for w in rules.STOP_WORDS)


def _weights(column: str, weights: dict[str, int]) -> str:
    return f"CASE {column} {' '.join(f"WHEN '{k}' THEN {v}" for k, v in weights.items())} ELSE 1 END" if weights else "1"


def _shared(name: str, depth: int) -> str:
    """Two statements: the families of a level with their budgets, then each child's share."""
    keys = ["domain", "lang", "source"][:depth]
    parent = keys[:-1]
    by = f"PARTITION BY {', '.join(parent)}" if parent else ""
    given = f"JOIN share{depth - 1} USING ({', '.join(parent)})" if parent else "CROSS JOIN share0"
    order = f"{by} ORDER BY capacity / weight, capacity, {', '.join(keys)} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    return f"""level{depth} AS (
  SELECT {', '.join(keys)}, capacity, weight, budget,
    coalesce(sum(capacity) OVER ({order}), 0) AS taken,
    sum(weight) OVER ({by}) - coalesce(sum(weight) OVER ({order}), 0) AS remaining
  FROM (SELECT {', '.join(keys)}, sum(tokens) * 2 AS capacity, {_weights(keys[-1], WEIGHTS[depth - 1])} AS weight
        FROM leaves GROUP BY {', '.join(keys)}) {given}),
full{depth} AS (SELECT *, capacity * remaining <= weight * greatest(budget - taken, 0) AS is_full FROM level{depth}),
share{depth} AS (
  SELECT {', '.join(keys)}, CAST(CASE WHEN is_full THEN capacity ELSE
    ((budget - sum(CASE WHEN is_full THEN capacity ELSE 0 END) OVER ({by})) * weight)
    // greatest(sum(CASE WHEN is_full THEN 0 ELSE weight END) OVER ({by}), 1) END AS HUGEINT) AS budget
  FROM full{depth})"""


_DOMAIN = "CASE " + " ".join(f"WHEN source = '{s}' THEN '{d}'" for s, d in DOMAINS.items()) + " ELSE 'other' END"

_TEMPLATES = ", ".join(
    f"('{name}', {k}, '{text.replace("'", "''")}')" for name, texts in licences.TEMPLATES.items() for k, text in enumerate(texts)
)

ORACLES: dict[str, str] = {
    "op2_licences": f"""
WITH split AS (
  SELECT row_number() OVER () AS r, doc_id,
    [regexp_extract_all(lower(l), '{licences.WORDS}') FOR l IN string_split(text, chr(10))] AS ls
  FROM documents WHERE text IS NOT NULL),
numbered AS (
  SELECT r, doc_id, flatten(ls) AS words,
    flatten(list_transform(ls, lambda l, n: list_transform(l, lambda w: n - 1))) AS nr
  FROM split),
templates AS (
  SELECT licence, wording, regexp_extract_all(lower(body), '{licences.WORDS}') AS own
  FROM (VALUES {_TEMPLATES}) t(licence, wording, body)),
known AS (
  SELECT licence, wording, len(own) AS k, own[i + 1] || ' ' || own[i + 2] AS gram, count(*) AS m
  FROM (SELECT *, unnest(range(len(own) - 1)) AS i FROM templates) GROUP BY ALL),
placed AS (
  SELECT r, i, words[i + 1] || ' ' || words[i + 2] AS gram
  FROM (SELECT r, words, unnest(range(len(words) - 1)) AS i FROM numbered)),
hit AS (SELECT r, i, licence, wording, k, gram, m FROM placed JOIN known USING (gram)),
shared AS (
  SELECT a.r, a.i AS start, a.licence, a.wording, a.k, b.gram, least(b.m, count(*)) AS n
  FROM hit a JOIN hit b ON b.r = a.r AND b.licence = a.licence AND b.wording = a.wording AND b.i BETWEEN a.i AND a.i + a.k - 2
  GROUP BY a.r, a.i, a.licence, a.wording, a.k, b.gram, b.m),
summed AS (SELECT r, start, licence, k, sum(n) AS common FROM shared GROUP BY r, start, licence, wording, k),
measured AS (
  SELECT doc_id, nr, licence, start, least(k, len(words) - start) AS length, CAST(common * 2 AS DOUBLE) AS twice,
    least(k, len(words) - start) - 1 + k - 1 AS sizes FROM summed JOIN numbered USING (r)),
best AS (
  SELECT *, twice / sizes AS dice FROM measured WHERE 100 * twice >= {licences.LEAST} * sizes
  QUALIFY row_number() OVER (PARTITION BY doc_id, licence ORDER BY twice / sizes DESC, start, length) = 1)
SELECT doc_id, licence, dice, CAST(nr[start + 1] AS INTEGER) AS line,
  CAST(nr[start + length] - nr[start + 1] + 1 AS INTEGER) AS lines FROM best""",
    "op5_quality_rules": f"""
WITH base AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS body,
    regexp_extract_all(coalesce(text, ''), '{_WORD}') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '{_WORD}')) AS lines
  FROM documents),
word AS (SELECT r, unnest(words) AS w, generate_subscripts(words, 1) AS i FROM base),
eight AS (
  SELECT r, i, list(w) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING) AS w8 FROM word),
starts AS (
  SELECT r, i, count(*) OVER (PARTITION BY r, array_to_string(w8, ' ')) AS n FROM eight WHERE len(w8) = 8),
flagged AS (
  SELECT word.r, max(coalesce(n > 1, false)) OVER
    (PARTITION BY word.r ORDER BY word.i ROWS BETWEEN 7 PRECEDING AND CURRENT ROW) AS repeated
  FROM word LEFT JOIN starts ON word.r = starts.r AND word.i = starts.i),
again AS (SELECT r, count(*) AS n_repeat_words FROM flagged WHERE repeated GROUP BY r),
echoes AS (
  SELECT r, count(*) AS n_echoed FROM (
    SELECT r, w = lag(w) OVER (PARTITION BY r ORDER BY i) AS echo FROM word) WHERE echo GROUP BY r),
counted AS (
  SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_echoed, 0) AS n_echoed_words,
    CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(body, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(lines) AS BIGINT) AS n_lines,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
    len(list_filter(words, lambda w: lower(w) IN ({_STOP}))) AS n_stop_words
  FROM base LEFT JOIN again USING (r) LEFT JOIN echoes USING (r)),
judged AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM counted)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND 1000 * word_chars BETWEEN 1500 * n_words AND 20000 * n_words
  AND 1000 * n_symbols <= 100 * n_words AND 1000 * n_stop_words >= 30 * n_words
  AND 1000 * n_dup_lines <= 500 * n_lines AND 1000 * n_echoed_words <= 300 * n_words AS kept
FROM judged""",
    "op9_mixing": f"""
WITH docs AS (
  SELECT doc_id, {_DOMAIN} AS domain, coalesce(lang, 'und') AS lang, coalesce(source, 'unknown') AS source,
    len(regexp_extract_all(coalesce(text, ''), '{_WORD}')) AS n_tokens
  FROM documents),
leaves AS (SELECT domain, lang, source, sum(n_tokens) AS tokens FROM docs GROUP BY ALL),
share0 AS (SELECT least(sum(tokens) * 50 // 100, sum(tokens) * 2) AS budget FROM leaves),
{_shared('domain', 1)},
{_shared('lang', 2)},
{_shared('source', 3)},
plan AS (
  SELECT domain, lang, source, budget // greatest(tokens, 1) AS epochs, budget % greatest(tokens, 1) AS rest
  FROM leaves JOIN share3 USING (domain, lang, source)),
placed AS (
  SELECT *, ('0x' || substr(md5('mix-1:' || epochs || ':' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 12))::BIGINT AS place
  FROM docs JOIN plan USING (domain, lang, source)),
summed AS (
  SELECT *, coalesce(sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY place, doc_id, n_tokens
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM placed)
SELECT doc_id, domain, lang, source, CAST(n_tokens AS BIGINT) AS n_tokens, CAST(epochs AS INTEGER) AS epochs,
  CAST(greatest(0, least(n_tokens, rest - start)) AS BIGINT) AS part_tokens
FROM summed""",
    "op8_jaccard_join": f"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '{_WORD}') AS words
  FROM documents),
sets AS (
  SELECT doc_id, list_sort(list_distinct(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
    ELSE [array_to_string(words[i:i + 4], ' ') FOR i IN range(1, len(words) - 3)] END)) AS shingles FROM docs),
classes AS (
  SELECT row_number() OVER () AS c, shingles, len(shingles) AS n, min(doc_id) AS least FROM sets WHERE len(shingles) > 0
  GROUP BY shingles),
member AS (SELECT c, n, unnest(shingles) AS shingle FROM classes),
linked AS (
  SELECT a.c AS a, b.c AS b FROM member a JOIN member b ON b.shingle = a.shingle AND a.c < b.c
  GROUP BY a.c, b.c, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
link AS (SELECT a, b FROM linked UNION ALL SELECT b, a FROM linked),
reach AS (SELECT c AS a, c AS b FROM classes UNION SELECT reach.a, link.b FROM reach JOIN link ON link.a = reach.b),
component AS (SELECT reach.a AS c, min(least) AS component_id FROM reach JOIN classes ON classes.c = reach.b GROUP BY reach.a)
SELECT doc_id, len(sets.shingles) AS n_shingles, CASE WHEN len(sets.shingles) = 0 THEN doc_id ELSE component_id END AS component_id
FROM sets LEFT JOIN classes USING (shingles) LEFT JOIN component USING (c)""",
    "op10_sharding": f"""
WITH RECURSIVE polynomial AS (
  SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)),
    lambda v, i: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)) AS steps),
summed AS (
  SELECT doc_id, coalesce(octet_length(encode(text)), 0) + {sharding.OVERHEAD} AS size,
    CASE WHEN text IS NOT NULL THEN xor(list_reduce(
      list_prepend(4294967295::BIGINT, [('0x' || h)::BIGINT FOR h IN regexp_extract_all(hex(encode(text)), '..')]),
      lambda s, b: xor(s >> 8, steps[(xor(s, b) & 255) + 1])), 4294967295) END AS text_crc32
  FROM documents, polynomial),
hop AS (
  SELECT key, shards, 0::BIGINT AS at_, 0::BIGINT AS target, ('0x' || substr(md5(key), 1, 12))::HUGEINT AS state
  FROM (SELECT DISTINCT coalesce(CAST(doc_id AS VARCHAR), '') AS key FROM documents),
    (VALUES ({sharding.SHARDS}), ({sharding.SHARDS} + 1)) s(shards)
  UNION ALL
  SELECT key, shards, target, floor((target + 1) * (2147483648.0::DOUBLE / ((drawn >> 17) + 1)::DOUBLE))::BIGINT, drawn
  FROM (SELECT *, (state * {sharding.MULTIPLIER} + {sharding.INCREMENT}) % 281474976710656 AS drawn FROM hop WHERE target < shards)),
dealt AS (
  SELECT key, any_value(at_) FILTER (WHERE shards = {sharding.SHARDS}) AS shard,
    any_value(at_) FILTER (WHERE shards > {sharding.SHARDS}) AS grown_shard FROM hop WHERE target >= shards GROUP BY key)
SELECT doc_id, CAST(size AS BIGINT) AS size, text_crc32, 'key' AS law, CAST(shard AS INTEGER) AS shard,
  row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, text_crc32 NULLS FIRST, size) - 1 AS slot,
  CAST(grown_shard AS INTEGER) AS grown_shard
FROM summed JOIN dealt ON dealt.key = coalesce(CAST(doc_id AS VARCHAR), '')""",
    "op11_prefix_trie": f"""
WITH own AS (
  SELECT conv_id, list(struct_pack(role := coalesce(role, ''), text := coalesce(text, ''))
    ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
heads AS (
  SELECT conv_id, turns, xor(list_reduce(
    list_prepend(4294967295::BIGINT, [ascii(c)::BIGINT FOR c IN string_split(conv_id::VARCHAR, '')]),
    lambda s, b: list_reduce(list_prepend(xor(s, b), range(8)),
      lambda v, i: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)), 4294967295) % {prefixes.HEADS} AS h
  FROM own),
rebuilt AS (
  SELECT o.conv_id, list_concat(coalesce(b.turns[1:o.h], []), o.turns[o.h + 1:]) AS turns
  FROM heads o LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % {prefixes.FAMILY}),
prefix AS (
  SELECT conv_id, depth, len(turns) = depth AS ends, length(turns[depth].text) AS size,
    to_json(turns[1:depth])::VARCHAR AS key, to_json(turns[1:depth - 1])::VARCHAR AS parent
  FROM (SELECT *, unnest(range(len(turns) + 1)) AS depth FROM rebuilt)),
node AS (
  SELECT key, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(parent) AS parent, any_value(size) AS size,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
  FROM prefix GROUP BY key, depth),
born AS (SELECT parent AS key, depth - 1 AS depth, count(*) AS n_children FROM node WHERE depth > 0 GROUP BY ALL),
below AS (
  SELECT p.key, p.depth, count(*) FILTER (WHERE born.key IS NULL) AS n_leaves,
    sum(CASE WHEN n.depth > 0 THEN (n.n_convs - 1) * n.size ELSE 0 END) AS saved
  FROM node n LEFT JOIN born ON born.key = n.key AND born.depth = n.depth
  JOIN prefix p ON p.conv_id = n.conv_id AND p.depth <= n.depth GROUP BY ALL)
SELECT node.conv_id, node.depth, up.conv_id AS parent_conv_id, node.n_convs, coalesce(n_children, 0) AS n_children,
  n_leaves, CAST(saved AS BIGINT) AS saved_tokens, node.ends_sha256
FROM node JOIN below USING (key, depth) LEFT JOIN born USING (key, depth)
LEFT JOIN node up ON node.depth > 0 AND up.key = node.parent AND up.depth = node.depth - 1""",
}
