"""The registered queries of this package and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlake.llm.bpe_trie import bpe_digests
from cardlake.llm.budget_mix import NULL_NAME, mix
from cardlake.llm.decontamination import leak_digests
from cardlake.llm.fill_in_middle import MARKS, PLAIN_PERCENT, SEED, SPM_PERCENT, middle_digests
from cardlake.llm.jaccard_tiles import jaccard_join
from cardlake.llm.license_scan import license_scan
from cardlake.llm.quote_threads import link_quotations
from cardlake.llm.repetition import BASE_WINDOW as MIN_GRAM
from cardlake.llm.repetition import (MAX_LINE_SHARE, MAX_NGRAM_SHARE, MAX_REPEAT_PERCENT, MAX_SYMBOLS_PER_WORD, MIN_WORDS,
                                     repetition_rules)
from cardlake.llm.secret_index import secret_scan
from cardlake.llm.spelling_variants import FORM_FACTOR, MIN_COUNT, MIN_LENGTH, NOISE_STEP, spelling_variants
from cardlake.llm.substring_dedup import substring_dedup
from cardlake.llm.tables import table
from cardlake.llm.topk_nra import top_k
from cardlake.llm.weak_labels import quality_scores

Query = Callable[[SparkSession, str], DataFrame]

TOKENIZER_FILE = "word_bpe_49k.json"
QUERY_ID_STEP = 100


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER_FILE)


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents"))


def op2_topk_nra(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return top_k(rows, rows.where(F.col("vec_id") % QUERY_ID_STEP == 0), k=10)


def op3_repetition_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition_rules(table(spark, sf_dir, "documents")).drop("dup_line_share", "dup_ngram_shares")


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents"), output="sha256")


def op5_bpe_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(table(spark, sf_dir, "documents"), tokenizer_path())


def op6_quote_threads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_quotations(table(spark, sf_dir, "conversations"))


def op7_secret_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan(table(spark, sf_dir, "documents"))


def op8_weak_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"))


#: The documents carry no domain: sources are dealt to four by the number that ends their name.
MIX_DOMAINS = 4
MIX_SHARE = 0.6
MIX_EPOCHS = 2
MIX_SEED = 42
MIX_WEIGHTS = {"d0": 3.0, "d1": 2.0, "d0/en": 2.0, "d1/de": 2.0}


def source_domain(source: str = "source") -> Column:
    number = F.regexp_extract(F.col(source), "([0-9]{1,9})$", 1)
    return F.when(number != "", F.concat(F.lit("d"), (number.cast("long") % MIX_DOMAINS).cast("string"))).otherwise("d-")


def op9_budget_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    chosen = mix(docs, source_domain(), MIX_SHARE, MIX_EPOCHS, MIX_WEIGHTS, MIX_SEED)
    return chosen.select(F.col("doc.doc_id").alias("doc_id"), "domain", "lang", "source", "n_tokens", "budget",
                         "epoch", "order_key")


def op10_jaccard_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_shingles", "component_id", "n_links", "n_copies")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return middle_digests(table(spark, sf_dir, "documents"))


def op13_leak_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leak_digests(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def queries() -> dict[str, Query]:
    found = [op1_license_scan, op2_topk_nra, op3_repetition_rules, op4_substring_dedup, op5_bpe_trie, op6_quote_threads,
             op7_secret_index, op8_weak_labels,
             op9_budget_mix, op10_jaccard_tiles, op11_spelling_variants, op12_fill_in_middle, op13_leak_index]
    return {f.__name__: f for f in found}


OP2_SQL = f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
  WHERE q.vec_id % {QUERY_ID_STEP} = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id, score
FROM s
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 10
"""


def _weights_sql(path: str) -> str:
    whens = " ".join(f"WHEN '{k}' THEN CAST({v} AS DOUBLE)" for k, v in sorted(MIX_WEIGHTS.items()))
    return f"CASE {path} {whens} ELSE CAST(1 AS DOUBLE) END"


def _share_sql(name: str, keys: list[str], parents: str | None) -> str:
    """One level of the tree: children in ascending order of capacity per weight."""
    above = ", ".join(keys[:-1])
    part = f"PARTITION BY {above}" if above else ""
    path = " || '/' || ".join(keys)
    rising = f"{part} ORDER BY capacity / weight, {', '.join(keys)}"
    given = (f"JOIN {parents} p USING ({above})" if parents else "CROSS JOIN total p")
    return f"""{name}0 AS (
  SELECT *, {_weights_sql(path)} AS weight FROM (
    SELECT {', '.join(keys)}, CAST(sum(capacity) AS BIGINT) AS capacity FROM leaves GROUP BY {', '.join(keys)})
), {name}1 AS (
  SELECT c.*, p.budget AS given FROM {name}0 c {given} WHERE weight > 0
), {name}2 AS (
  SELECT *, capacity * sum(weight) OVER ({rising} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
    <= weight * (given - coalesce(sum(capacity) OVER ({rising} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    AS is_full FROM {name}1
), {name} AS (
  SELECT {', '.join(keys)}, CASE WHEN is_full THEN capacity ELSE CAST(floor(weight
    * (given - coalesce(sum(CASE WHEN is_full THEN capacity END) OVER ({part}), 0))
    / sum(CASE WHEN NOT is_full THEN weight END) OVER ({part})) AS BIGINT) END AS budget FROM {name}2
)"""


_TREE = ["domain", "lang", "source"]
OP9_SQL = f"""
WITH docs AS (
  SELECT doc_id, CASE WHEN regexp_extract(source, '([0-9]{{1,9}})$', 1) <> ''
      THEN 'd' || CAST(CAST(regexp_extract(source, '([0-9]{{1,9}})$', 1) AS BIGINT) % {MIX_DOMAINS} AS VARCHAR)
      ELSE 'd-' END AS domain,
    coalesce(lang, '{NULL_NAME}') AS lang, coalesce(source, '{NULL_NAME}') AS source,
    CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS n_tokens,
    coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, '')) AS row_name
  FROM documents
), sized AS (SELECT * FROM docs WHERE n_tokens > 0
), leaves AS (
  SELECT domain, lang, source, CAST(sum(n_tokens) AS BIGINT) AS tokens,
         CAST(sum(n_tokens) * {MIX_EPOCHS} AS BIGINT) AS capacity
  FROM sized GROUP BY domain, lang, source
), total AS (SELECT CAST(floor(CAST(sum(tokens) AS DOUBLE) * {MIX_SHARE}) AS BIGINT) AS budget FROM leaves
), {_share_sql("lvl_a", _TREE[:1], None)}, {_share_sql("lvl_b", _TREE[:2], "lvl_a")},
{_share_sql("lvl_c", _TREE, "lvl_b")},
cut AS (
  SELECT l.*, c.budget, c.budget // l.tokens AS whole, c.budget % l.tokens AS rest
  FROM leaves l JOIN lvl_c c USING (domain, lang, source)
), keyed AS (
  SELECT s.*, c.budget, c.whole, c.rest,
         md5('{MIX_SEED}:' || CAST(c.whole AS VARCHAR) || ':' || s.row_name) AS order_key
  FROM sized s JOIN cut c USING (domain, lang, source)
), placed AS (
  SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY order_key RANGE UNBOUNDED PRECEDING) AS upto
  FROM keyed
)
SELECT doc_id, domain, lang, source, n_tokens, budget, epoch, order_key
FROM placed, unnest(range(whole + CASE WHEN upto <= rest THEN 1 ELSE 0 END)) AS e(epoch)
"""


BLANK_WORDS_SQL = "regexp_extract_all(coalesce({}, ''), '[^\\x20\\x09-\\x0D]+')"
OP3_SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS no, doc_id, coalesce(text, '') AS text, {BLANK_WORDS_SQL.format("text")} AS w FROM documents
), words AS (SELECT no, unnest(w) AS word, generate_subscripts(w, 1) AS k FROM d
), sizes AS (SELECT no, sum(length(word)) AS word_chars FROM words GROUP BY no
), windows AS (
  SELECT no, n, k, array_to_string(list_slice(w, k, k + n - 1), ' ') AS gram
  FROM d, (SELECT unnest([{MIN_GRAM}, {", ".join(map(str, MAX_NGRAM_SHARE))}]) AS n), unnest(range(1, len(w) - n + 2)) AS t(k)
), covered AS (
  SELECT DISTINCT no, n, i AS k
  FROM (SELECT *, count(*) OVER (PARTITION BY no, n, gram) AS times FROM windows), unnest(range(k, k + n)) AS t(i) WHERE times > 1
), shares AS (
  SELECT no, n, count(*) AS n_words, sum(length(word)) AS chars FROM covered JOIN words USING (no, k) GROUP BY no, n
), most AS (
  SELECT unnest([{", ".join(map(str, MAX_NGRAM_SHARE))}]) AS n, unnest([{", ".join(f"CAST({x} AS DOUBLE)" for x in MAX_NGRAM_SHARE.values())}]) AS share
), repeats AS (
  SELECT no, max(CASE WHEN n = {MIN_GRAM} THEN s.n_words END) AS n_repeat,
    bool_or(CAST(chars AS DOUBLE) / word_chars > most.share) AS too_many
  FROM shares s JOIN sizes USING (no) LEFT JOIN most USING (n) GROUP BY no
), lines AS (
  SELECT no, line, count(*) AS times FROM (SELECT no, unnest(string_split(text, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY no, line
), copies AS (
  SELECT no, sum(times - 1) AS n_dup_lines, CAST(sum((times - 1) * strlen(line)) AS DOUBLE) / sum(times * strlen(line)) AS share
  FROM lines GROUP BY no
), counted AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(word_chars, 0) AS BIGINT) AS word_chars,
    CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
    CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(n_repeat, 0) AS BIGINT) AS n_repeat_words,
    coalesce(too_many, false) AS too_many, coalesce(copies.share, 0) AS line_share
  FROM d LEFT JOIN sizes USING (no) LEFT JOIN repeats USING (no) LEFT JOIN copies USING (no)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed,
  NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words OR too_many
    OR line_share > CAST({MAX_LINE_SHARE} AS DOUBLE) OR n_symbols > CAST({MAX_SYMBOLS_PER_WORD} AS DOUBLE) * n_words) AS kept
FROM counted
"""
OP4_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS no, doc_id, {BLANK_WORDS_SQL.format("text")} AS w FROM documents
), windows AS (
  SELECT no, doc_id, k, array_to_string(list_slice(w, k, k + 12), ' ') AS words FROM d, unnest(range(1, len(w) - 11)) AS t(k)
), hits AS (
  SELECT DISTINCT no, k FROM (SELECT no, doc_id, k, min(doc_id) OVER (PARTITION BY words) AS first FROM windows) WHERE first < doc_id
), gone AS (SELECT DISTINCT no, word FROM hits, unnest(range(k, k + 13)) AS t(word)
), words AS (SELECT no, unnest(w) AS text, generate_subscripts(w, 1) AS word FROM d
), kept AS (
  SELECT no, count(*) AS n, string_agg(text, ' ' ORDER BY word) AS text FROM words ANTI JOIN gone USING (no, word) GROUP BY no
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (no)
"""
OP10_SQL = f"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS no, doc_id, {BLANK_WORDS_SQL.format(
      "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT no, array_to_string(list_slice(w, k, k + 4), ' ') AS words
  FROM d, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS t(k) WHERE len(w) > 0
), sizes AS (SELECT no, count(*) AS n, md5(string_agg(words, chr(10) ORDER BY words)) AS whole FROM shingles GROUP BY no
), copies AS (SELECT whole, count(*) AS n_copies FROM sizes JOIN d USING (no) WHERE doc_id IS NOT NULL GROUP BY whole
), shared AS (
  SELECT a.no AS a, b.no AS b, count(*) AS n FROM shingles a JOIN shingles b USING (words) WHERE a.no <> b.no GROUP BY ALL
), links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.no = a JOIN sizes y ON y.no = b JOIN d p ON p.no = a JOIN d q ON q.no = b
  WHERE 100 * shared.n >= 80 * (x.n + y.n - shared.n) AND p.doc_id IS NOT NULL AND q.doc_id IS NOT NULL
), degree AS (SELECT a AS no, count(*) AS n_links FROM links GROUP BY a
), reach AS (
  SELECT no, doc_id AS low FROM d
  UNION SELECT l.b, r.low FROM reach r JOIN links l ON l.a = r.no
)
SELECT doc_id, coalesce(sizes.n, 0) AS n_shingles, component_id, coalesce(n_links, 0) AS n_links,
  CASE WHEN doc_id IS NULL THEN 1 ELSE coalesce(n_copies, 1) END AS n_copies
FROM d JOIN (SELECT no, min(low) AS component_id FROM reach GROUP BY no) USING (no) LEFT JOIN sizes USING (no)
  LEFT JOIN copies USING (whole) LEFT JOIN degree USING (no)
"""
OP11_SQL = f"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda x: list_reduce(list_prepend(x, range(8)), lambda c, i:
    CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS steps
), runs AS (
  SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')) AS run FROM documents
), seen AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
  FROM runs GROUP BY ALL
), hashed AS (
  SELECT run, n, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS bytes FROM seen
), drawn AS (
  SELECT run, n, xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(
    range(len(bytes) // 2), lambda i: CAST('0x' || substr(bytes, CAST(2 * i + 1 AS BIGINT), 2) AS BIGINT))), lambda c, b:
    xor(c >> 8, steps[(xor(c, b) & 255) + 1]))) AS h
  FROM hashed, crc
), noisy AS (
  SELECT CASE WHEN h % {NOISE_STEP} = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END
    AS word, n FROM drawn
), v AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM noisy WHERE length(word) >= {MIN_LENGTH} GROUP BY word HAVING sum(n) >= {MIN_COUNT}
), gaps AS (
  SELECT word, n, k, substr(word, 1, k - 1) AS head, substr(word, k + 1) AS tail FROM v, unnest(range(1, length(word) + 1)) AS t(k)
), near AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM gaps a JOIN gaps b USING (k, head, tail) WHERE a.word <> b.word
  UNION SELECT g.word, v.word, v.n FROM gaps g JOIN v ON v.word = g.head || g.tail
  UNION SELECT v.word, g.word, g.n FROM gaps g JOIN v ON v.word = g.head || g.tail
), best AS (
  SELECT word, count(*) AS n_near, arg_min(other, (-other_n, other)) AS form, max(other_n) AS form_n FROM near GROUP BY word
), judged AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= {FORM_FACTOR} * v.n THEN form END AS form,
    CASE WHEN form_n >= {FORM_FACTOR} * v.n THEN form_n END AS form_n
  FROM v LEFT JOIN best USING (word)
), chains AS (
  SELECT word, word AS root, form AS next FROM judged
  UNION ALL SELECT c.word, j.word, j.form FROM chains c JOIN judged j ON j.word = c.next
)
SELECT word, form, root, n, n_near, form_n FROM judged JOIN (SELECT word, root FROM chains WHERE next IS NULL) USING (word)
"""
OP12_SQL = f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+') AS u,
    sha256('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents
), drawn AS (
  SELECT *, len(u) AS n, {", ".join(f"CAST('0x' || substr(h, {8 * i + 1}, 8) AS BIGINT) AS h{i + 1}" for i in range(4))}
  FROM d
), cut AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN text = '' OR {" OR ".join(f"contains(text, '{m}')" for m in MARKS)} OR h3 % 100 >= {PLAIN_PERCENT} THEN 'plain'
         WHEN h4 % 100 < {SPM_PERCENT} THEN 'spm' ELSE 'psm' END AS form
  FROM drawn
), parts AS (
  SELECT *, array_to_string(list_slice(u, 1, a), '') AS prefix, array_to_string(list_slice(u, a + 1, b), '') AS middle,
    array_to_string(list_slice(u, b + 1, n), '') AS suffix
  FROM cut
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
  CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle
         ELSE '<P>' || prefix || '<S>' || suffix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM parts
"""
LEAK_WORDS_SQL = """regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"""
OP13_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS no, doc_id, {LEAK_WORDS_SQL} AS w FROM documents
), i AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {LEAK_WORDS_SQL} AS w FROM benchmark
), phrases AS (
  SELECT DISTINCT item, array_to_string(list_slice(w, k, k + 9), ' ') AS phrase, least(len(w), 10) AS n
  FROM i, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS t(k) WHERE len(w) > 0
), places AS (
  SELECT no, k, n, array_to_string(list_slice(w, k, k + n - 1), ' ') AS phrase
  FROM d, (SELECT DISTINCT n FROM phrases), unnest(range(1, len(w) - n + 2)) AS t(k)
), hits AS (SELECT no, k, n, item FROM places JOIN phrases USING (phrase, n)
), covered AS (
  SELECT no, count(DISTINCT word) AS n_hit FROM (SELECT DISTINCT no, k, n FROM hits), unnest(range(k, k + n)) AS t(word)
  GROUP BY no
), named AS (SELECT no, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT no, item FROM hits) GROUP BY no)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN covered USING (no) LEFT JOIN named USING (no)
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_topk_nra": OP2_SQL, "op3_repetition_rules": OP3_SQL, "op4_substring_dedup": OP4_SQL,
            "op9_budget_mix": OP9_SQL, "op10_jaccard_tiles": OP10_SQL, "op11_spelling_variants": OP11_SQL,
            "op12_fill_in_middle": OP12_SQL, "op13_leak_index": OP13_SQL}
