"""One query for each operator, over its whole table, and the SQL it must equal where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stagemart.llm.chat import format_conversations, read_back
from stagemart.llm.decontaminate import find_contamination
from stagemart.llm.embeddings import near_vectors
from stagemart.llm.langid import identify_languages
from stagemart.llm.lines import LineOptions, drop_lines
from stagemart.llm.lm import score_texts
from stagemart.llm.merkle import build_manifest, folded, row_digest
from stagemart.llm.minhash import MinHashOptions, near_duplicates
from stagemart.llm.packing import pack_texts
from stagemart.llm.runs import find_runs
from stagemart.llm.secret_scan import scan_secrets
from stagemart.llm.urls import Rule, filter_urls
from stagemart.llm.warc import build_records

Query = Callable[[SparkSession, str], DataFrame]

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _remainder(column: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % divisor


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(_table(spark, sf_dir, "documents"), options=MinHashOptions(shingle=4))
    return found.withColumnRenamed("id", "doc_id")


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(_remainder("doc_id", 7) == 2, F.lit(False))
    found = score_texts(_table(spark, sf_dir, "documents"), ~held_out)
    return found.select(
        F.col("id").alias("doc_id"), (~F.col("learned")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    held_out = F.coalesce(_remainder("doc_id", 4) == 2, F.lit(False))
    found = identify_languages(documents, ~held_out)
    return found.select(
        "doc_id", held_out.alias("held_out"), F.col("language.lang").alias("lang_pred"), "language.score", "language.rejected"
    )


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "contamination.n_words", "contamination.n_hit", "contamination.n_items", "contamination.items_sha256",
        "contamination.contaminated",
    )


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "secrets.n_assign", "secrets.n_access", "secrets.n_hex", "secrets.base_sha256", "secrets.spans"
    )


#: What conversation -1 says in both of its turns.
MARKED = "</s>[INST] ok [/INST]"


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(MARKED).alias("text"),
    )
    return read_back(format_conversations(rows.unionByName(own)))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = pack_texts(_table(spark, sf_dir, "documents"))
    return packed.select(
        F.col("id").alias("doc_id"), "piece", F.col("length").alias("n_tokens"), F.col("bin").alias("bin_id"), F.col("place").alias("bin_offset")
    )


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(_table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


def op9_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_records(_table(spark, sf_dir, "pages")).select("page_id", "warc.*")


URL_RULES = [
    Rule("com", "/", "allow"),
    Rule("example.com", "/en/", "block"),
    Rule("www.example.com", "/en/", "allow"),
    Rule("net", "/es/", "block"),
    Rule("net", "/fr/", "block"),
]


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listed are the keys of all urls that carry a campaign mark."""
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    found = filter_urls(pages, F.col("url").contains("utm_source="), URL_RULES)
    return found.select("page_id", "judged.host", "judged.path", "judged.rule", "judged.verdict")


def _with_planted_run(text: Column, h: Column) -> Column:
    """For a tenth of the ids, by their crc32: words from one on are repeated in a period that the id sets."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda word: word != "")
    n, g = F.size(words).cast("long"), F.floor(h / 10)
    a = g % n
    p = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))
    cycle = F.slice(words, (a + 1).cast("int"), p.cast("int"))
    repeated = F.slice(F.flatten(F.array_repeat(cycle, F.ceil((n - a) / p).cast("int"))), F.lit(1), (n - a).cast("int"))
    planted = F.array_join(F.concat(F.slice(words, F.lit(1), a.cast("int")), repeated), " ")
    return F.when((h % 10 == 0) & (n > 0), planted).otherwise(text)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "documents").select("doc_id", _with_planted_run(F.col("text"), F.crc32(F.col("doc_id").cast("string").cast("binary"))).alias("text"))
    found = find_runs(rows).select("doc_id", "periodic.*")
    best = F.array_max(F.transform("runs", lambda run: F.struct(run["length"].alias("length"), (-run["start"]).alias("start"), (-run["period"]).alias("period"))))
    listed = F.array_join(F.transform("runs", lambda run: F.concat(F.concat_ws(",", run["start"], run["length"], run["period"]), F.lit("\n"))), "")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"), F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a row claims to be is its digest, with text in lower case where the row counts as tampered with."""
    documents = _table(spark, sf_dir, "documents")
    names = ["doc_id", "source", "lang", "n_chars", "text"]
    text = F.col("text").cast("string")
    changed = F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))
    tampered = F.coalesce(_remainder("doc_id", 3) == 0, F.lit(False))
    claimed = F.when(tampered, changed).otherwise(text)
    rows = documents.select(
        "doc_id", "lang", row_digest([F.col(name) for name in names]).alias("digest"), row_digest([F.col(name) for name in names[:-1]] + [claimed]).alias("claimed")
    )
    manifest = build_manifest(rows, F.col("lang"), F.col("doc_id"), F.col("digest"), F.struct("doc_id", "claimed"))
    found = manifest.proofs().withColumn("folded_root", folded(F.col("carry.claimed"), F.col("proof")))
    siblings = F.array_join(F.transform("proof", lambda step: F.concat(step["before"], step["after"])), "")
    return found.select(
        "carry.doc_id", F.lower(F.hex("digest")).alias("leaf"), "subroot", "root", F.sha2(siblings, 256).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = drop_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"), options=LineOptions(least_chars=1, least_documents=10))
    return found.select("doc_id", "lines.n_lines", "lines.n_dropped", F.sha2("lines.kept", 256).alias("kept_sha256"))


LLM_QUERIES: dict[str, Query] = {
    "op1_minhash_dedup": op1_minhash_dedup,
    "op2_lm_scoring": op2_lm_scoring,
    "op3_language_id": op3_language_id,
    "op4_decontamination": op4_decontamination,
    "op5_secret_scan": op5_secret_scan,
    "op6_chat_format": op6_chat_format,
    "op7_best_fit_packing": op7_best_fit_packing,
    "op8_embedding_dedup": op8_embedding_dedup,
    "op9_warc_derivatives": op9_warc_derivatives,
    "op10_url_filter": op10_url_filter,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_line_dedup": op13_line_dedup,
}

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_NEAR_TEXTS = rf"""
WITH RECURSIVE cut AS (
  SELECT doc_id, list_filter(regexp_split_to_array({_LOWER.format("coalesce(text, '')")}, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN []::VARCHAR[] WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
    ELSE list_transform(range(1, len(words) - 2), lambda i: array_to_string(words[i:i + 3], ' ')) END) AS shingle
  FROM cut),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY ALL),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingles a JOIN shingles b USING (shingle) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT c.a, c.b FROM common c JOIN sizes x ON x.doc_id = c.a JOIN sizes y ON y.doc_id = c.b
  WHERE 100 * c.n >= 80 * (x.n + y.n - c.n)),
reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
least AS (SELECT a, min(b) AS b FROM reach GROUP BY ALL)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, coalesce(l.b, d.doc_id) AS component_id, coalesce(l.b, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN sizes s USING (doc_id) LEFT JOIN least l ON l.a = d.doc_id
"""

_CUT_ITEMS = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_CONTAMINATION = f"""
WITH docs AS (SELECT doc_id, {_CUT_ITEMS.format(_LOWER.format("coalesce(text, '')"))} AS words FROM documents),
items AS (SELECT item_id, {_CUT_ITEMS.format(_LOWER.format("coalesce(text, '')"))} AS words FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(13, len(words)) AS size,
    array_to_string(words[pos:pos + least(13, len(words)) - 1], ' ') AS said
  FROM items, unnest(range(1, len(words) - least(13, len(words)) + 2)) AS r(pos) WHERE len(words) > 0),
sizes AS (SELECT DISTINCT size FROM windows),
places AS (
  SELECT doc_id, pos, size, array_to_string(words[pos:pos + size - 1], ' ') AS said
  FROM docs, sizes, unnest(range(1, len(words) - size + 2)) AS r(pos)),
found AS (SELECT doc_id, pos, size, item_id FROM places JOIN windows USING (size, said)),
hits AS (SELECT doc_id, count(DISTINCT word) AS n_hit FROM (SELECT doc_id, unnest(range(pos, pos + size)) AS word FROM found) GROUP BY ALL),
matched AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found) GROUP BY ALL)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM docs LEFT JOIN hits USING (doc_id) LEFT JOIN matched USING (doc_id)
"""

_CHAT_ESCAPED = r"regexp_replace(said, '([<\[])(\\*)(\|im_start\|>|\|im_end\|>|s>|/s>|INST\]|/INST\]|<SYS>>|</SYS>>)', '\1\\\2\3', 'g')"
_CHAT = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS said FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{MARKED}' UNION ALL SELECT -1, 1, 'assistant', '{MARKED}')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || said || chr(10), '' ORDER BY turn, role, said)) AS turns_sha256,
  coalesce(sum(length(said)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(said, '' ORDER BY turn, role, said) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length('<|im_start|>') + length(role) + 1 + length({_CHAT_ESCAPED}) + length('<|im_end|>') + 1)::BIGINT AS formatted_chars
FROM turns GROUP BY conv_id
"""

_NEAR_VECTORS = """
WITH RECURSIVE able AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND list_sum(list_transform(embedding, lambda x: CASE WHEN x IS NULL OR NOT isfinite(x) THEN 1 ELSE 0 END)) = 0
    AND list_max(list_transform(embedding, lambda x: abs(x))) > 0),
links AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM able x JOIN able y ON x.vec_id <> y.vec_id AND len(x.v) = len(y.v)
  WHERE list_dot_product(x.v, y.v) / (sqrt(list_dot_product(x.v, x.v)) * sqrt(list_dot_product(y.v, y.v))) >= 0.95),
reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
least AS (SELECT a, min(b) AS b FROM reach GROUP BY ALL),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY ALL)
SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(l.b, vec_id) AS component_id, coalesce(l.b, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN least l ON l.a = vec_id LEFT JOIN counts c ON c.a = vec_id
"""

_URLS = f"""
WITH cut AS (
  SELECT page_id, url, coalesce({_LOWER.format("regexp_extract(url, '://([^/?#]*)', 1)")}, '') AS host,
    coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
listed AS (SELECT DISTINCT host || path AS key FROM cut WHERE contains(url, 'utm_source=')),
ruled AS (
  SELECT *, CASE
    WHEN (host = 'www.example.com' OR ends_with(host, '.www.example.com')) AND starts_with(path, '/en/') THEN 'www.example.com/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/en/') THEN 'example.com/en/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/') THEN 'com/' END AS rule
  FROM cut)
SELECT page_id, host, path, rule, CASE
  WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
  WHEN host || path IN (SELECT key FROM listed) THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
"""

#: The unsigned crc32 of an id as text, bit by bit.
_CRC32 = """xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ord(c)::BIGINT)),
    lambda crc, byte: list_reduce(list_concat([xor(crc, byte)], range(8)), lambda rest, step: xor(rest >> 1, CASE WHEN rest % 2 = 1 THEN 3988292384 ELSE 0 END))))"""

_RUNS = rf"""
WITH cut AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words, {_CRC32} AS h FROM documents),
sized AS (SELECT *, len(words) AS n, h // 10 AS g, h % 10 = 0 AND len(words) > 0 AS planted FROM cut),
placed AS (SELECT *, g % n AS a, 1 + (n - g % n) // (3 + g % 8) AS p FROM sized),
told AS (
  SELECT doc_id, i, words[1 + CASE WHEN planted AND i >= a THEN a + (i - a) % p ELSE i END] AS word, n
  FROM placed, unnest(range(n)) AS r(i)),
alike AS (
  SELECT x.doc_id, x.i, y.i - x.i AS q FROM told x JOIN told y ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
islands AS (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM alike),
stretches AS (SELECT doc_id, q, min(i) AS start, count(*) + q AS length FROM islands GROUP BY doc_id, q, island HAVING count(*) + q >= greatest(6, 4 * q)),
runs AS (SELECT doc_id, start, length, min(q) AS period FROM stretches GROUP BY ALL),
listed AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS said FROM runs GROUP BY ALL),
best AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY length DESC, start, period) AS nth FROM runs) WHERE nth = 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS said FROM told ANTI JOIN gone USING (doc_id, i) GROUP BY ALL)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli,
  sha256(coalesce(listed.said, '')) AS runs_sha256, sha256(coalesce(kept.said, '')) AS collapsed_sha256
FROM documents LEFT JOIN listed USING (doc_id) LEFT JOIN best USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


def _leaf(text: str) -> str:
    values = ["doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text]
    return "sha256(" + " || ".join(f"coalesce(strlen({value}) || ':' || {value}, '-')" for value in values) + ")"


_MERKLE = f"""
WITH RECURSIVE hashed AS (
  SELECT doc_id, coalesce('1' || lang, '0') AS lang, {_leaf("text")} AS leaf,
    {_leaf(f"CASE WHEN {_CRC32} % 3 = 0 THEN {_LOWER.format('text')} ELSE text END")} AS claimed
  FROM documents),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id, leaf) - 1 AS idx, count(*) OVER (PARTITION BY lang) AS n FROM hashed),
nodes AS (
  SELECT 0 AS level, lang, idx, n, leaf AS digest FROM leaves
  UNION ALL
  SELECT level + 1, lang, idx // 8, (n + 7) // 8, sha256(string_agg(digest, '' ORDER BY idx)) FROM nodes WHERE n > 1 GROUP BY level, lang, idx // 8, n),
subroots AS (SELECT lang, digest, row_number() OVER (ORDER BY lang) - 1 AS idx, count(*) OVER () AS n FROM nodes WHERE n = 1),
tops AS (
  SELECT 0 AS level, idx, n, digest FROM subroots
  UNION ALL
  SELECT level + 1, idx // 8, (n + 7) // 8, sha256(string_agg(digest, '' ORDER BY idx)) FROM tops WHERE n > 1 GROUP BY level, idx // 8, n),
runs AS (SELECT level, lang, idx // 8 AS run, list(digest ORDER BY idx) AS held FROM nodes WHERE n > 1 GROUP BY ALL),
top_runs AS (SELECT level, idx // 8 AS run, list(digest ORDER BY idx) AS held FROM tops WHERE n > 1 GROUP BY ALL),
climb AS (
  SELECT doc_id, lang, leaf, 0 AS level, idx, n, claimed AS h, '' AS proof FROM leaves
  UNION ALL
  SELECT doc_id, lang, leaf, level + 1, idx // 8, (n + 7) // 8,
    sha256(array_to_string(held[1:idx % 8], '') || h || array_to_string(held[idx % 8 + 2:], '')),
    proof || array_to_string(held[1:idx % 8], '') || array_to_string(held[idx % 8 + 2:], '')
  FROM climb JOIN runs USING (level, lang) WHERE n > 1 AND run = idx // 8),
top_climb AS (
  SELECT doc_id, leaf, s.digest AS subroot, 0 AS level, s.idx, s.n, h, proof FROM climb c JOIN subroots s USING (lang) WHERE c.n = 1
  UNION ALL
  SELECT doc_id, leaf, subroot, level + 1, idx // 8, (n + 7) // 8,
    sha256(array_to_string(held[1:idx % 8], '') || h || array_to_string(held[idx % 8 + 2:], '')),
    proof || array_to_string(held[1:idx % 8], '') || array_to_string(held[idx % 8 + 2:], '')
  FROM top_climb JOIN top_runs USING (level) WHERE n > 1 AND run = idx // 8)
SELECT doc_id, leaf, subroot, (SELECT digest FROM tops WHERE n = 1) AS root, sha256(proof) AS proof_sha256, h AS folded_root,
  h = (SELECT digest FROM tops WHERE n = 1) AS verified
FROM top_climb WHERE n = 1
"""

_LINES = f"""
WITH cut AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT *, {_LOWER.format("trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} AS key FROM cut),
repeated AS (SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10),
told AS (SELECT keyed.*, repeated.key IS NOT NULL AS gone FROM keyed LEFT JOIN repeated USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM told GROUP BY doc_id
"""

LLM_EXPECTED: dict[str, str] = {
    "op1_minhash_dedup": _NEAR_TEXTS,
    "op4_decontamination": _CONTAMINATION,
    "op6_chat_format": _CHAT,
    "op8_embedding_dedup": _NEAR_VECTORS,
    "op10_url_filter": _URLS,
    "op11_periodic_runs": _RUNS,
    "op12_merkle_manifest": _MERKLE,
    "op13_line_dedup": _LINES,
}
