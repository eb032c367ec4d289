"""One registered query per operator, with its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from snapwatch.llm import chat, hard_negatives, knn, merkle, mixing, packing, passages, quality, secret_scan, simhash, toxicity, url_lists, warc
from snapwatch.llm.tables import read

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return add


def _sql_list(words) -> str:
    return ", ".join(f"'{w}'" for w in words)


# ---- 1: chat formatting ----

_OPENING = " ".join(f"WHEN '{r}' THEN {len(o) + len(c)}" for r, (o, c) in chat.MARKS.items())
_OTHER = len(chat.OTHER_OPEN) + len(chat.OTHER_TEXT) + len(chat.OTHER_CLOSE)
_ESCAPED = r"""regexp_replace({}, '([<\[])(\\*)(/?INST\]|/?s>|</?SYS>>|</?ROLE>>|<TEXT>>)', '\1\\\2\3', 'g')"""


@query(
    "op1_chat_format",
    f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
r AS (
  SELECT *, length({_ESCAPED.format("text")})
    + CASE role {_OPENING} ELSE {_OTHER} + length({_ESCAPED.format("role")}) END AS chars
  FROM t)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars, true AS round_trip
FROM r GROUP BY conv_id""",
)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation and one made of control strings, formatted; all columns are read back from the output."""
    hostile = spark.sql(
        "SELECT -7L AS conv_id, turn, role, '</s>[INST] ok [/INST]' AS text FROM VALUES (0L, 'user'), (1L, 'assistant') t(turn, role)"
    )
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(hostile)
    read_back = chat.format_chats(turns).select(
        "conv_id",
        F.length("formatted").cast("long").alias("formatted_chars"),
        "round_trip",
        chat.parse_chat(F.col("formatted")).alias("_turns"),
        F.array_join(
            F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: chat.unescape(s["text"])), ""
        ).alias("_loss"),
    )
    told = F.array_join(F.transform("_turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read_back.select(
        "conv_id",
        F.size("_turns").cast("long").alias("n_turns"),
        F.sha2(told, 256).alias("turns_sha256"),
        F.length("_loss").cast("long").alias("loss_chars"),
        F.sha2("_loss", 256).alias("loss_sha256"),
        "formatted_chars",
        "round_trip",
    )


# ---- 2: repeated passages ----


@query("op2_repeated_passages")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of 50 words and more that documents share, with their classes."""
    return passages.repeated_passages(read(spark, sf_dir, "documents"))


# ---- 3: packing ----


@query("op3_packing")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces; the checksum is taken of the ids that the operator returns."""
    return packing.pack(read(spark, sf_dir, "documents")).select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


# ---- 4: mixing ----


@query("op4_mixing")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size and words taken of every document, with its source's size and target."""
    return mixing.mix(read(spark, sf_dir, "documents"))


# ---- 5: exact top-k search ----


@query(
    "op5_top_k",
    """
WITH e AS (
  SELECT vec_id, row_number() OVER () AS n, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, q.n, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM e q JOIN e c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY n ORDER BY score DESC, vec_id) AS place FROM s)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM r WHERE place <= 20""",
)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best of all vectors for every vector whose id is divisible by 20."""
    vectors = knn.usable(read(spark, sf_dir, "embeddings"))
    return knn.top_k(vectors, vectors.where("vec_id % 20 = 0"))


# ---- 6: near duplicates by SimHash ----


@query("op6_simhash")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and group of every document."""
    groups = simhash.near_duplicate_groups(simhash.fingerprints(read(spark, sf_dir, "documents")))
    return groups.select("doc_id", simhash.hex_digits(F.col("fingerprint")).alias("fingerprint"), "component_id")


# ---- 7: URL filters ----

_HOST = r"lower(regexp_extract(url, '^[A-Za-z]+://([^/?#:@]+)', 1))"


def _captures(pages: DataFrame) -> DataFrame:
    """When a page was fetched: a day and an hour of 2024 by its id, as the table has none."""
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("page_id") * 7919 % 366).cast("int"))
    hour = F.make_dt_interval(hours=(F.col("page_id") % 24).cast("int"))
    return pages.select("page_id", "url", (day.cast("timestamp_ntz") + hour).alias("fetched_at"))


def _changes(pages: DataFrame) -> DataFrame:
    """A dated list over the hosts of the pages: hosts, their domains and paths, by digits of the host's MD5 sum."""
    hosts = pages.select(url_lists.host_of(F.col("url")).alias("host")).where("host <> ''").distinct()
    hosts = hosts.select("host", F.md5(F.col("host").cast("binary")).alias("m"))
    digit = [F.instr(F.lit("0123456789abcdef"), F.substr("m", F.lit(i), F.lit(1))) - 1 for i in range(1, 11)]
    hosts = hosts.select("host", *[d.alias(f"d{i}") for i, d in enumerate(digit, 1)])
    domain = F.substring_index("host", ".", -3)

    def change(when: str, entry: Column, verdict: str | None, days: str) -> Column:
        at = F.date_add(F.lit("2024-01-01").cast("date"), F.expr(days).cast("int")).cast("timestamp_ntz")
        made = F.struct(entry.alias("entry"), F.lit(verdict).cast("string").alias("verdict"), at.alias("at"))
        return F.when(F.expr(when), made)

    rows = F.array(
        change("d1 < 8", F.col("host"), "block", "d2 * 8"),
        change("d1 < 8 AND d3 >= 4", F.col("host"), None, "d2 * 8 + 30 + d4"),
        change("d1 < 8 AND d3 >= 4 AND d5 >= 8", F.col("host"), "block", "d2 * 8 + 90 + d6"),
        change("d1 >= 14", domain, "block", "d2 * 10"),
        change("d7 < 4", F.concat("host", F.lit("/es")), "block", "d8 * 5"),
        change("d9 < 4", F.concat("host", F.lit("/en")), "allow", "d10 * 10"),
    )
    return hosts.select(F.explode(F.array_compact(rows)).alias("c")).select("c.*")


@query(
    "op7_url_lists",
    f"""
WITH p AS (
  SELECT page_id, url, {_HOST} AS host,
    DATE '2024-01-01' + CAST(page_id * 7919 % 366 AS INTEGER) + to_hours(CAST(page_id % 24 AS INTEGER)) AS fetched_at,
    list_filter(string_split(regexp_extract(url, '^[A-Za-z]+://[^/?#]*([^?#]*)', 1), '/'), lambda s: s <> '') AS parts
  FROM pages),
m AS (SELECT DISTINCT host, md5(host) AS m FROM p),
h AS (SELECT host, {", ".join(f"instr('0123456789abcdef', substr(m, {i}, 1)) - 1 AS d{i}" for i in range(1, 11))} FROM m),
c AS (
  SELECT host AS entry, 'block' AS verdict, DATE '2024-01-01' + CAST(d2 * 8 AS INTEGER) AS since FROM h WHERE d1 < 8
  UNION ALL SELECT host, NULL, DATE '2024-01-01' + CAST(d2 * 8 + 30 + d4 AS INTEGER) FROM h WHERE d1 < 8 AND d3 >= 4
  UNION ALL SELECT host, 'block', DATE '2024-01-01' + CAST(d2 * 8 + 90 + d6 AS INTEGER) FROM h WHERE d1 < 8 AND d3 >= 4 AND d5 >= 8
  UNION ALL SELECT array_to_string(list_slice(string_split(host, '.'), -3, -1), '.'), 'block', DATE '2024-01-01' + CAST(d2 * 10 AS INTEGER) FROM h WHERE d1 >= 14
  UNION ALL SELECT host || '/es', 'block', DATE '2024-01-01' + CAST(d8 * 5 AS INTEGER) FROM h WHERE d7 < 4
  UNION ALL SELECT host || '/en', 'allow', DATE '2024-01-01' + CAST(d10 * 10 AS INTEGER) FROM h WHERE d9 < 4),
t AS (
  SELECT entry, CAST(since AS TIMESTAMP) AS since, CASE max(CASE verdict WHEN 'allow' THEN 2 WHEN 'block' THEN 1 ELSE 0 END) WHEN 2 THEN 'allow' WHEN 1 THEN 'block' END AS verdict
  FROM c GROUP BY entry, since),
v AS (SELECT *, lead(since) OVER (PARTITION BY entry ORDER BY since) AS until FROM t),
n AS (
  SELECT page_id, host, fetched_at, len(string_split(host, '.')) AS labels, parts FROM p),
k AS (
  SELECT page_id, fetched_at, labels - i AS depth, array_to_string(list_slice(string_split(host, '.'), i, labels), '.') AS entry
  FROM (SELECT *, unnest(range(1, greatest(labels, 2))) AS i FROM n)
  UNION ALL
  SELECT page_id, fetched_at, labels + i, host || '/' || array_to_string(list_slice(parts, 1, i), '/')
  FROM (SELECT *, unnest(range(1, len(parts) + 1)) AS i FROM n)),
j AS (
  SELECT page_id, k.entry, since, verdict, count(*) OVER (PARTITION BY page_id) AS n_active,
    row_number() OVER (PARTITION BY page_id ORDER BY depth DESC) AS place
  FROM k JOIN v ON k.entry = v.entry AND verdict IS NOT NULL AND fetched_at >= since AND (until IS NULL OR fetched_at < until))
SELECT p.page_id, url, CAST(fetched_at AS TIMESTAMP) AS fetched_at, host, coalesce(verdict = 'block', false) AS blocked,
  coalesce(n_active, 0) AS n_active, entry, since AS listed_at
FROM p LEFT JOIN j ON p.page_id = j.page_id AND place = 1""",
)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page judged by the list as it was when the page was fetched."""
    pages = read(spark, sf_dir, "pages")
    return url_lists.judge_captures(_captures(pages), _changes(pages))


# ---- 8: secret scans ----


@query("op8_secret_scan")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of every document, those of the fixed patterns also counted and hashed."""
    base = secret_scan.KINDS[:3]

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return secret_scan.scan_secrets(read(spark, sf_dir, "documents")).select(
        "doc_id",
        *map(count, base),
        F.sha2(secret_scan.listed(F.col("spans"), base), 256).alias("base_sha256"),
        secret_scan.listed(F.col("spans")).alias("spans"),
    )


# ---- 9: quality rules ----

_HAS_WORD = r"[^\x20\x09-\x0D]"
_LIMITS = " OR ".join(
    f"{r.metric} {sign} {limit}" for r in quality.RULES for sign, limit in (("<", r.low), (">", r.high)) if limit is not None
)


@query(
    "op9_quality_rules",
    rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '{_HAS_WORD}')) AS lines
  FROM documents),
w AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM d),
g AS (
  SELECT doc_id, i, word, lead(word, 1) OVER o AS w1, lead(word, 2) OVER o AS w2
  FROM w WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
n AS (
  SELECT doc_id, i, CASE WHEN w2 IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, word, w1, w2) > 1 THEN 1 ELSE 0 END AS again
  FROM g),
c AS (
  SELECT doc_id, greatest(again, lag(again, 1, 0) OVER o, lag(again, 2, 0) OVER o) AS covered
  FROM n WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
r AS (SELECT doc_id, CAST(sum(covered) AS BIGINT) AS n_repeat_words FROM c GROUP BY doc_id),
m AS (
  SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words,
    CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
    CAST(length(text) - length(translate(text, '{quality.SYMBOLS}', '')) AS BIGINT) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words, len(lines) AS n_lines,
    len(list_filter(words, lambda w: lower(w) IN ({_sql_list(quality.STOP_WORDS)}))) AS n_stop,
    len(list_filter(lines, lambda l: regexp_matches(l, '{quality.BULLET}'))) AS n_bullet,
    len(list_filter(lines, lambda l: regexp_matches(l, '{quality.ELLIPSIS}'))) AS n_ellipsis
  FROM d LEFT JOIN r ON d.doc_id = r.doc_id),
q AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    CASE WHEN n_words > 0 THEN word_chars / n_words ELSE 0 END AS mean_word_chars,
    CASE WHEN n_words > 0 THEN n_symbols / n_words ELSE 0 END AS symbol_ratio,
    CASE WHEN n_words > 0 THEN n_stop / n_words ELSE 0 END AS stop_word_ratio,
    CASE WHEN n_lines > 0 THEN n_dup_lines / n_lines ELSE 0 END AS dup_line_ratio,
    CASE WHEN n_lines > 0 THEN n_bullet / n_lines ELSE 0 END AS bullet_line_ratio,
    CASE WHEN n_lines > 0 THEN n_ellipsis / n_lines ELSE 0 END AS ellipsis_line_ratio,
    CASE WHEN n_words > 0 THEN n_repeat_words / n_words ELSE 0 END AS repeat_word_ratio
  FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT ({_LIMITS}) AS kept
FROM q""",
)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, ratios and verdict of every document."""
    base_failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return quality.quality_verdicts(read(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base_failed.alias("base_failed"),
        (~base_failed & F.col("kept")).alias("kept"),
    )


# ---- 10: toxicity ----


@query("op10_toxicity")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score and prediction for every document."""
    return toxicity.toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


# ---- 11: WARC ----

_BASE32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(CAST('0x' || substr(hex, {start}, 5) AS BIGINT) // {32**place} % 32 AS INTEGER) + 1, 1)"
    for start in range(1, 41, 5)
    for place in (3, 2, 1, 0)
)


@query(
    "op11_warc",
    f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
r AS (
  SELECT *, row_number() OVER o AS place, first_value(page_id) OVER o AS best
  FROM p WINDOW o AS (PARTITION BY html ORDER BY page_id DESC NULLS LAST))
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, {_BASE32} AS payload_digest,
  CASE WHEN place = 1 THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN place > 1 THEN best END AS refers_to
FROM r""",
)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to an archive and read back by the archive's index."""
    return warc.archive_pages(read(spark, sf_dir, "pages"), with_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


# ---- 12: Merkle dataset manifest ----

_CRC = """xor(4294967295, list_reduce(
  list_prepend(4294967295::BIGINT, flatten(list_transform(string_split({}, ''), lambda c: [ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
  lambda a, b: xor(xor(a, b) >> 1, 3988292384 * (xor(a, b) & 1))))"""


def _hashed(*fields: str) -> str:
    texts = [f"CAST({f} AS VARCHAR)" for f in fields]
    return "sha256(" + " || ".join(f"coalesce(strlen({t}) || ':' || {t}, '-')" for t in texts) + ")"


def _tree_sql(leaves: str, runs: str, nodes: str, depth: int) -> tuple[str, str]:
    """CTEs of the levels above ``leaves`` (tree, rank, digest, n), and a SELECT of the trees' highest nodes."""
    ctes, tops, below = [], [f"SELECT tree, digest FROM {leaves} WHERE n = 1"], leaves
    for level in range(depth):
        ctes.append(
            f"{runs}{level} AS (SELECT tree, rank // 8 AS rank, n, list(digest ORDER BY rank) AS kids"
            f" FROM {below} WHERE n > {8**level} GROUP BY tree, rank // 8, n),\n"
            f"{nodes}{level} AS (SELECT tree, rank, n, sha256(array_to_string(kids, '')) AS digest FROM {runs}{level})"
        )
        below = f"{nodes}{level}"
        tops.append(f"SELECT tree, digest FROM {below} WHERE n <= {8 ** (level + 1)}")
    return ",\n".join(ctes), " UNION ALL ".join(tops)


def _climb_sql(source: str, runs: str, depth: int, rank: str, own: str, proof: str) -> str:
    """CTEs that fold ``own`` and collect ``proof`` level by level; the last one is ``runs`` + 'end'."""
    ctes, below = [], source
    for level in range(depth):
        at = f"(CAST({rank} AS BIGINT) // {8**level}) % 8"
        others = f"list_slice(kids, 1, {at}), list_slice(kids, {at} + 2, len(kids))"
        name = f"{runs}end" if level == depth - 1 else f"{runs}step{level}"
        ctes.append(
            f"{name} AS (SELECT b.* EXCLUDE ({own}, {proof}),"
            f" CASE WHEN kids IS NULL THEN {own} ELSE sha256(array_to_string(list_concat(list_slice(kids, 1, {at}), [{own}], list_slice(kids, {at} + 2, len(kids))), '')) END AS {own},"
            f" CASE WHEN kids IS NULL THEN {proof} ELSE {proof} || array_to_string(list_concat({others}), '') END AS {proof}"
            f" FROM {below} b LEFT JOIN {runs}{level} g ON g.rank = {rank} // {8 ** (level + 1)}"
            + (" AND g.tree IS NOT DISTINCT FROM b.lang)" if runs == "run" else ")")
        )
        below = name
    return ",\n".join(ctes)


_LANG_TREE, _LANG_TOPS = _tree_sql("base", "run", "node", 9)
_CROWN_TREE, _CROWN_TOPS = _tree_sql("crown", "top", "peak", 4)


@query(
    "op12_merkle_manifest",
    f"""
WITH d AS (
  SELECT doc_id, lang, {_hashed("doc_id", "source", "lang", "n_chars", "text")} AS leaf,
    CASE WHEN {_CRC.format("CAST(doc_id AS VARCHAR)")} % 3 = 0
      THEN {_hashed("doc_id", "source", "lang", "n_chars", "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS forged
  FROM documents),
e AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank, count(*) OVER (PARTITION BY lang) AS n
  FROM d),
base AS (SELECT lang AS tree, rank, leaf AS digest, n FROM e),
{_LANG_TREE},
subs AS ({_LANG_TOPS}),
crown AS (
  SELECT 1 AS tree, tree AS lang, digest, row_number() OVER (ORDER BY tree NULLS FIRST) - 1 AS rank, count(*) OVER () AS n FROM subs),
{_CROWN_TREE},
root AS ({_CROWN_TOPS}),
told AS (
  SELECT e.doc_id, e.lang, e.leaf, e.rank AS leaf_rank, c.rank AS lang_rank, c.digest AS subroot, r.digest AS root,
    coalesce(forged, leaf) AS own, '' AS proof
  FROM e JOIN crown c ON e.lang IS NOT DISTINCT FROM c.lang CROSS JOIN root r),
{_climb_sql("told", "run", 9, "leaf_rank", "own", "proof")},
{_climb_sql("runend", "top", 4, "lang_rank", "own", "proof")}
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, own AS folded_root, own = root AS verified FROM topend""",
)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's leaf, proof and root; a third of the texts is changed after the manifest was made."""
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, merkle.row_digest(lower_text=True))
    leaves = read(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("long").alias("doc_id"), "lang", merkle.row_digest().alias("leaf"), tampered.alias("tampered")
    )
    folded = merkle.fold(F.coalesce("row.tampered", "leaf"), F.col("path"))
    return merkle.manifest(leaves, "lang", "doc_id", "leaf").select(
        "row.doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2(merkle.siblings(F.col("path")), 256).alias("proof_sha256"),
        folded.alias("folded_root"),
        (folded == F.col("root")).alias("verified"),
    )


# ---- 13: hard negatives ----


@query(
    "op13_hard_negatives",
    """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS alike, CAST(list_inner_product(a.v, c.v) AS BIGINT) AS score
  FROM e a JOIN e c ON a.vec_id % 50 = 0 AND (a.vec_id <> c.vec_id OR a.label <> c.label)),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score,
    row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS place
  FROM s WHERE alike),
n AS (
  SELECT p.anchor_id, positive_id, s.vec_id AS negative_id, positive_score, s.score AS negative_score,
    CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
  FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT alike AND 100 * s.score BETWEEN 50 * positive_score AND 95 * positive_score
  WHERE place <= 5)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3""",
)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every anchor; every seventh row has a wrong label."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = read(spark, sf_dir, "embeddings").select("vec_id", moved.alias("label"), "embedding")
    return hard_negatives.hard_negatives(rows, F.col("vec_id") % 50 == 0)


# ---- The pipeline of stages 9, 6, 8, 4 and 3 ----


@query("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)
