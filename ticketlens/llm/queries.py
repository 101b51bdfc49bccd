"""The registered queries of this folder and, where SQL can say the same, their twins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketlens.llm import chat, cube, decontam, langid, lattice, neardup, pfp, privacy, quality, sharding, turns, vafile, warc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.verdicts(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


OP9_SQL = r"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT doc_id, source, text,
    list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM d
),
win AS (
  SELECT doc_id, i, list_aggregate(words[i:i + 7], 'string_agg', chr(1)) AS win
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS i FROM w WHERE len(words) >= 8)
),
again AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS n FROM win) WHERE n > 1),
rep AS (SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM again, range(0, 8) t(k) GROUP BY doc_id),
ln AS (
  SELECT doc_id, source,
    trim(regexp_replace(regexp_replace(lower(x), '[0-9]+', '0', 'g'), '[\x20\x09-\x0D]+', ' ', 'g')) AS line,
    len(list_filter(string_split_regex(x, '[\x20\x09-\x0D]+'), lambda v: v <> '')) AS words
  FROM (SELECT doc_id, source, unnest(lines) AS x FROM w)
),
hosts AS (SELECT source, count(DISTINCT doc_id) AS n FROM d GROUP BY source),
freq AS (
  SELECT f.source, f.line, f.first_doc FROM (
    SELECT source, line, count(DISTINCT doc_id) AS docs, min(doc_id) AS first_doc FROM ln GROUP BY source, line
  ) f JOIN hosts h ON f.source IS NOT DISTINCT FROM h.source WHERE f.docs > 20 AND f.docs > 0.05 * h.n
),
gone AS (
  SELECT l.doc_id, sum(l.words) AS gone
  FROM ln l JOIN freq f ON l.source IS NOT DISTINCT FROM f.source AND l.line = f.line
  WHERE l.doc_id <> f.first_doc GROUP BY l.doc_id
),
figures AS (
  SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words, coalesce(gone, 0) AS gone
  FROM w LEFT JOIN rep ON w.doc_id = rep.doc_id LEFT JOIN gone ON w.doc_id = gone.doc_id
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND NOT (n_words - gone < n_words / 3) AS kept
FROM figures
"""

def id_remainder(modulus: int) -> Column:
    """crc32 of the id as text, modulo `modulus`; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % modulus


def op1_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


OP1_SQL = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM f
"""


def op2_bottom_k_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents")).drop("row_key", "group_id")


def op3_lattice_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = lattice.score(docs, train=id_remainder(7) != 2)
    return scored.select(
        "doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op4_label_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"), shards=16)


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    marks = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-7, 0, "user", marks), (-7, 1, "assistant", marks)], rows.schema)
    records = chat.as_records(chat.gather_turns(rows.unionByName(more)))
    turns = chat.canonical_turns(records, "record").select("conv_id", "turns")
    return chat.digests(chat.read_back(chat.format_turns(turns)))


OP5_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL
  SELECT -7, t, r, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) v(t, r)
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length('<|turn|>' || url_encode(role) || chr(10) || replace(replace(text, '<', '<;'), '[', '[;')
    || '<|end|>' || chr(10))) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id
"""


def op6_cube_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = cube.mix(table(spark, sf_dir, "documents"))
    return mixed.select(
        "doc_id", "size", "source_size", "target", (F.col("times") * F.col("size")).alias("taken"), "times"
    )


def op7_prefix_free_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pfp.remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


#: How far the terms of a proximity match may be off their places to each other.
NEAR_WORDS = 5


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), slop=NEAR_WORDS)
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated",
        F.size("near_item_ids").cast("long").alias("n_near_items"),
    )


OP8_SQL = r"""
WITH d AS (
  SELECT doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS words FROM documents
),
b AS (
  SELECT item_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS words FROM benchmark
),
iw AS (
  SELECT DISTINCT item_id, least(len(words), 10) AS n, array_to_string(words[i:i + least(len(words), 10) - 1], ' ') AS win
  FROM (SELECT item_id, words, unnest(range(1, len(words) - least(len(words), 10) + 2)) AS i FROM b WHERE len(words) > 0)
),
dw AS (
  SELECT doc_id, i, n, array_to_string(words[i:i + n - 1], ' ') AS win
  FROM (
    SELECT doc_id, words, n, unnest(range(1, len(words) - n + 2)) AS i
    FROM d, (SELECT DISTINCT n FROM iw) WHERE len(words) >= n
  )
),
m AS (SELECT doc_id, item_id, i, dw.n FROM dw JOIN iw ON dw.win = iw.win AND dw.n = iw.n),
hits AS (SELECT doc_id, count(DISTINCT i + k) AS n_hit FROM m, range(0, 10) t(k) WHERE k < n GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM m) GROUP BY doc_id
),
dt AS (SELECT doc_id, unnest(words) AS term, unnest(range(0, len(words))) AS pos FROM d),
tc AS (SELECT term, count(*) AS n FROM dt GROUP BY term),
wt AS (
  SELECT win, unnest(string_split(win, ' ')) AS term, unnest(range(0, len(string_split(win, ' ')))) AS q
  FROM (SELECT DISTINCT win FROM iw)
),
probe AS (
  SELECT win, wt.term, q, row_number() OVER (PARTITION BY win ORDER BY coalesce(tc.n, 0), q) AS rk
  FROM wt LEFT JOIN tc ON wt.term = tc.term QUALIFY rk <= 2
),
st AS (SELECT DISTINCT doc_id, win, rk, pos - q AS at FROM dt JOIN probe ON dt.term = probe.term WHERE pos >= q),
near_win AS (
  SELECT DISTINCT a.doc_id, a.win FROM st a JOIN st b ON a.doc_id = b.doc_id AND a.win = b.win AND b.rk = 2
  WHERE a.rk = 1 AND abs(a.at - b.at) <= {NEAR_WORDS}
  UNION SELECT DISTINCT doc_id, win FROM st WHERE strpos(win, ' ') = 0
),
near AS (SELECT doc_id, count(DISTINCT CAST(item_id AS VARCHAR)) AS n_near_items FROM near_win JOIN iw ON near_win.win = iw.win GROUP BY doc_id)
SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated, coalesce(n_near_items, 0) AS n_near_items
FROM d LEFT JOIN hits ON d.doc_id = hits.doc_id LEFT JOIN items ON d.doc_id = items.doc_id LEFT JOIN near ON d.doc_id = near.doc_id
""".replace("{NEAR_WORDS}", str(NEAR_WORDS))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = id_remainder(4) == 2
    model = langid.fit(docs.filter(~held_out))
    rows = docs.select("doc_id", held_out.alias("held_out"), "text")
    return langid.predict(rows, model, keep=("doc_id", "held_out"))


def op11_va_file_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vafile.cluster(table(spark, sf_dir, "embeddings"))


def _op11_sql(rounds: int = 3) -> str:
    """The rounds written out one after another."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS (
  SELECT n, vec_id, v, c, d FROM (
    SELECT *, row_number() OVER (PARTITION BY n ORDER BY d, c) AS place FROM (
      SELECT n, vec_id, k.v, c, list_sum(list_transform(range(1, 65), lambda i: (k.v[i] - m.v[i]) * (k.v[i] - m.v[i]))) AS d FROM k, m{r} m
    )
  ) WHERE place = 1
)""")
        if r < rounds:
            steps.append(f"""s{r} AS (
  SELECT c, list(CAST((s - (s % n + n) % n) // n AS BIGINT) ORDER BY i) AS v FROM (
    SELECT c, i, count(*) AS n, sum(v[i]) AS s FROM a{r}, range(1, 65) t(i) GROUP BY c, i
  ) GROUP BY c
),
m{r + 1} AS (SELECT m.c, coalesce(s.v, m.v) AS v FROM m{r} m LEFT JOIN s{r} s ON m.c = s.c)""")
    return f"""
WITH k AS (
  SELECT row_number() OVER () AS n, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
),
m0 AS (
  SELECT place - 1 AS c, v FROM (SELECT v, row_number() OVER (ORDER BY sha256('1:' || coalesce(CAST(vec_id AS VARCHAR), '')), v) AS place FROM k)
  WHERE place <= 16
),
{",".join(steps)}
SELECT vec_id, CAST(a.c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia,
  CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(m.v, ',')) AS centroid_sha256
FROM a{rounds} a JOIN m{rounds} m ON a.c = m.c
"""


def op12_skip_chain_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = privacy.find(docs, privacy.fit(docs))

    def listed(spans: str) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *[count(k) for k in privacy.KINDS], F.sha2(listed("base"), 256).alias("base_sha256"), listed("spans").alias("spans"))


def op13_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    return turns.report(turns.damaged(rows), ids=rows)


def _op13_sql() -> str:
    """Damage, faults, and the least weights as texts: nine digits of cost, then the letters."""
    def front(cost: str, letter: str, weight: str) -> str:
        return f"lpad(CAST(CAST(substr({weight}, 1, 9) AS INTEGER) + {cost} AS VARCHAR), 9, '0') || '{letter}' || substr({weight}, 10)"

    def taken(state: int, kept: str, to: int) -> str:
        return f"least({front('4', 'D', f'v{state}')}, {kept}, CASE WHEN NOT gone THEN {front('3 + more', 'R', f'v{to}')} END)"

    def keep(initial: str, to: int) -> str:
        return f"CASE WHEN NOT gone AND initial = '{initial}' THEN {front('more', 'K', f'v{to}')} END"

    return f"""
WITH RECURSIVE crc(n, k, c) AS (
  SELECT range, 0, range FROM range(256)
  UNION ALL SELECT n, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM crc WHERE k < 8
),
tab AS (SELECT list(c ORDER BY n) AS t FROM crc WHERE k = 8),
hashed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, xor(list_reduce(
    list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda x: CAST(ascii(x) AS BIGINT)),
    lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]), CAST(4294967295 AS BIGINT)), CAST(4294967295 AS BIGINT)) % 20 AS part
  FROM conversations, tab
),
hurt AS (
  SELECT conv_id, turn, CASE WHEN part = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN part = 1 THEN '' WHEN part = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM hashed, range(0, 2) t(copy) WHERE part <> 0 AND (copy = 0 OR part = 3)
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS i, left(role, 1) AS initial,
    NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank, NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') AS cut
  FROM hurt
),
judged AS (
  SELECT *, CASE WHEN blank THEN 1 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 2 WHEN cut THEN 3 ELSE 0 END AS fault,
    lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial AS pair
  FROM placed
),
counts AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 1) AS blank,
    count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM judged GROUP BY conv_id
),
dp(conv_id, i, v0, v1, v2, v3) AS (
  SELECT conv_id, n + 1, '000000000', CAST(NULL AS VARCHAR), '000000003I', '000000000' FROM counts
  UNION ALL
  SELECT conv_id, i, least(t0, {front('3', 'I', 't2')}), least(t1, {front('3', 'I', 't2')}), least(t2, {front('3', 'I', 't3')}),
    least(t3, {front('3', 'I', 't2')})
  FROM (
    SELECT conv_id, i, {taken(0, f"{keep('s', 1)}, {keep('u', 2)}", 2)} AS t0, {taken(1, keep('u', 2), 2)} AS t1,
      {taken(2, keep('a', 3), 3)} AS t2, {taken(3, keep('u', 2), 2)} AS t3
    FROM (
      SELECT dp.*EXCLUDE (i), j.i, j.initial, j.fault IN (1, 2) AS gone, CASE WHEN j.fault = 3 THEN 3 ELSE 0 END AS more
      FROM dp JOIN judged j ON dp.conv_id IS NOT DISTINCT FROM j.conv_id AND j.i = dp.i - 1
    )
  )
),
best AS (SELECT conv_id, CAST(substr(v0, 1, 9) AS BIGINT) AS cost, substr(v0, 10) AS audit FROM dp WHERE i = 1),
edits AS (
  SELECT conv_id, k, letter, sum(CASE WHEN letter <> 'I' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY k) AS i
  FROM (SELECT conv_id, k, substr(audit, CAST(k AS INTEGER), 1) AS letter FROM (SELECT conv_id, audit, unnest(range(1, length(audit) + 1)) AS k FROM best))
),
put AS (
  SELECT e.conv_id, k, letter, j.role, CASE WHEN letter = 'I' THEN '' ELSE j.text END AS text,
    row_number() OVER (PARTITION BY e.conv_id ORDER BY k) - 1 AS p, first_value(letter = 'K' AND j.initial = 's') OVER (PARTITION BY e.conv_id ORDER BY k) AS led
  FROM edits e LEFT JOIN judged j ON e.conv_id IS NOT DISTINCT FROM j.conv_id AND e.i = j.i WHERE letter <> 'D'
),
mended AS (
  SELECT conv_id, sha256(string_agg(
    CASE WHEN letter = 'K' THEN role WHEN (p - CASE WHEN led THEN 1 ELSE 0 END) % 2 = 0 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY k
  )) AS repaired_sha256 FROM put GROUP BY conv_id
)
SELECT c.conv_id, coalesce(n.gaps, 0) AS gaps, coalesce(n.blank, 0) AS blank, coalesce(n.duplicate, 0) AS duplicate, coalesce(n.truncated, 0) AS truncated,
  coalesce(n.illegal, 0) AS illegal, coalesce(b.cost, 0) AS cost, coalesce(b.audit, '') AS audit, coalesce(m.repaired_sha256, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN counts n ON c.conv_id IS NOT DISTINCT FROM n.conv_id
LEFT JOIN best b ON c.conv_id IS NOT DISTINCT FROM b.conv_id LEFT JOIN mended m ON c.conv_id IS NOT DISTINCT FROM m.conv_id
"""


QUERIES = {
    "op1_warc_index": op1_warc_index,
    "op2_bottom_k_dedup": op2_bottom_k_dedup,
    "op3_lattice_score": op3_lattice_score,
    "op4_label_sharding": op4_label_sharding,
    "op5_chat_format": op5_chat_format,
    "op6_cube_mixing": op6_cube_mixing,
    "op7_prefix_free_dedup": op7_prefix_free_dedup,
    "op8_decontamination": op8_decontamination,
    "op9_quality_rules": op9_quality_rules,
    "op10_language_id": op10_language_id,
    "op11_va_file_clusters": op11_va_file_clusters,
    "op12_skip_chain_pii": op12_skip_chain_pii,
    "op13_turn_repair": op13_turn_repair,
}
ORACLE = {
    "op1_warc_index": OP1_SQL,
    "op5_chat_format": OP5_SQL,
    "op8_decontamination": OP8_SQL,
    "op9_quality_rules": OP9_SQL,
    "op11_va_file_clusters": _op11_sql(),
    "op13_turn_repair": _op13_sql(),
}
