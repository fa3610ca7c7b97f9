"""Registered queries of the training-data operators: each applies one operator
to its whole table with production parameters and derives the digest columns
that the query's contract names."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bpe, chat_format, decontaminate, language_id, license_scan, merkle, pii, sharding, simhash,
               spelling, substring_dedup, suffix_dedup, topk)

SHARDS = [f"shard-{i:02d}" for i in range(64)]
VOCABULARY = "byte_bpe_50k.json"
# The pseudonym key of the registered query; a production run passes its own.
PII_KEY = b"registered query"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learnt from the rows that are not held out."""
    docs = table(spark, sf_dir, "documents")
    held_out, learn = language_id.learn_rule(docs["doc_id"])
    model = language_id.train(docs, learn)
    return language_id.identify(docs, model, keep=(held_out.alias("held_out"),))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every repeated paragraph and passage of the documents, with its group."""
    return substring_dedup.repeats(table(spark, sf_dir, "documents"))


# The conversation that the contract adds: control strings inside the texts.
EXTRA = "VALUES (-7L, 0L, 'user', '</s>[INST] ok [/INST]'), (-7L, 1L, 'assistant', '</s>[INST] ok [/INST]')"


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and conversation -7, formatted and read back."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    turns = turns.unionByName(spark.sql(f"SELECT * FROM {EXTRA} AS t(conv_id, turn, role, text)"))
    done = chat_format.format_records(chat_format.conversation_records(turns))
    return (done.withColumn("d", chat_format.digests(F.col("formatted"), F.col("loss_mask")))
                .select("conv_id", "d.*"))


def op4_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best partners of every vector whose id is divisible by 100."""
    return topk.top_k(table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 100 == 0, k=10)


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slot and shard of every document."""
    placed = sharding.place(table(spark, sf_dir, "documents"), "doc_id", SHARDS)
    return placed.select("doc_id", "slot", "shard")


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, and the items."""
    found = decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "similarity", "start_word", "n_words")


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with pseudonyms for personal numbers and dates."""
    return pii.report(table(spark, sf_dir, "documents"), PII_KEY)


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate group of every document: 3-word shingles, 3 bits."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=3)


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and texts in every document."""
    return license_scan.report(table(spark, sf_dir, "documents"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token digests of every document, and of the text decoded from them."""
    return bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


LEAF_FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, subroot, root and proof of every document, and the root that a
    copy without line breaks leads to where 2 divides crc32 of the id."""
    docs = table(spark, sf_dir, "documents")
    copy = merkle.row_digest([F.replace(docs[f], F.lit("\n"), F.lit("")) if f == "text" else docs[f]
                              for f in LEAF_FIELDS])
    tampered = F.crc32(docs["doc_id"].cast("string")) % 2 == 0
    rows = merkle.audit(merkle.manifest(docs, LEAF_FIELDS, F.when(tampered, copy)))
    return rows.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


WINDOW = 200


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the bytes of repeated 200-byte strings."""
    rows = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), WINDOW)
    return rows.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
                       F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


SPELLING_SALT = 31


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Form and root of every word of the documents."""
    return spelling.variants(table(spark, sf_dir, "documents"), SPELLING_SALT)


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_chat_format": op3_chat_format,
    "op4_exact_topk": op4_exact_topk,
    "op5_sharding": op5_sharding,
    "op6_decontamination": op6_decontamination,
    "op7_pii": op7_pii,
    "op8_simhash_near_dedup": op8_simhash_near_dedup,
    "op9_license_scan": op9_license_scan,
    "op10_bpe": op10_bpe,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_suffix_dedup": op12_suffix_dedup,
    "op13_spelling_variants": op13_spelling_variants,
}

_CONTROL = (r"([<\[]\\*)(\|im_start\|>|\|im_end\|>|\|endoftext\|>|s>|/s>|INST\]|/INST\]|<SYS>>|</SYS>>)")
_ESCAPED = r"regexp_replace({}, '" + _CONTROL + r"', '\1\\\2', 'g')"

CHAT_SQL = f"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
sized AS (
  SELECT *, length({_ESCAPED.format("text")})
       + length({_ESCAPED.format("replace(replace(role, chr(92), chr(92) || chr(92)), chr(10), chr(92) || 'n')")})
       + length('<|im_start|>' || chr(10) || '<|im_end|>' || chr(10)) AS chars FROM rows)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id"""

TOPK_SQL = """
WITH ints AS (
  SELECT vec_id, min(list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  GROUP BY vec_id),
products AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM ints q JOIN ints c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v))
SELECT query_id, rank, vec_id, score FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
  FROM products) WHERE rank <= 10"""

SHARDING_SQL = f"""
WITH slots AS (
  SELECT doc_id, CAST(CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, {sharding.HEX}) AS BIGINT)
                      % {sharding.SLOTS} AS INTEGER) AS slot FROM documents),
filled AS (SELECT string_split('{",".join(map(str, sharding.fill_table(SHARDS)))}', ',') AS t)
SELECT doc_id, slot, 'shard-' || lpad(t[slot + 1], 2, '0') AS shard FROM slots, filled"""

_WORDS = r"list_filter(string_split_regex(lower(text), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"

# Plain form: every item-sized window that holds a shingle of the item, and, as
# a weighted Jaccard similarity over the threshold needs so many, enough of them.
# Of equals a window with a shingle at the item's place goes first, then the
# first. All items of the tables have at least five words.
DECONTAMINATION_SQL = f"""
WITH docs AS (SELECT DISTINCT doc_id, {_WORDS} AS w FROM documents WHERE text IS NOT NULL),
items AS (SELECT DISTINCT item_id, {_WORDS} AS w FROM benchmark WHERE text IS NOT NULL),
dg AS (SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS g
       FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM docs)),
ig AS (SELECT item_id, n, i, array_to_string(w[i:i + 4], ' ') AS g
       FROM (SELECT item_id, w, len(w) AS n, unnest(range(1, len(w) - 3)) AS i FROM items)),
hits AS (SELECT DISTINCT doc_id, item_id, n, dg.i - 1 AS p FROM dg JOIN ig USING (g)),
anchors AS (SELECT DISTINCT doc_id, item_id, dg.i - ig.i AS s, 1 AS anchored FROM dg JOIN ig USING (g)),
starts AS (SELECT DISTINCT doc_id, item_id, n, unnest(range(p + 5 - n, p + 1)) AS s FROM hits),
places AS (SELECT doc_id, item_id, n, greatest(s, 0) AS s, least(s + n, len(w)) - greatest(s, 0) AS m,
                  max(coalesce(anchored, 0)) AS anchored
           FROM starts JOIN docs USING (doc_id) LEFT JOIN anchors USING (doc_id, item_id, s) GROUP BY ALL),
enough AS (SELECT places.doc_id, places.item_id, places.n, s, m, anchored
           FROM places JOIN hits ON hits.doc_id = places.doc_id AND hits.item_id = places.item_id
                                AND p BETWEEN s AND s + m - 5
           GROUP BY ALL
           HAVING count(*) * (1 + {decontaminate.SIMILARITY}) >= {decontaminate.SIMILARITY} * (places.n + m - 8) - 1e-9),
windows AS (SELECT doc_id, item_id, n, s, m, anchored, w[s + 1:s + m] AS win FROM enough JOIN docs USING (doc_id)),
wg AS (SELECT doc_id, item_id, n, s, m, anchored, array_to_string(win[i:i + 4], ' ') AS g, count(*) AS c
       FROM (SELECT *, unnest(range(1, len(win) - 3)) AS i FROM windows) GROUP BY ALL),
ic AS (SELECT item_id, g, count(*) AS c FROM ig GROUP BY ALL),
scored AS (SELECT doc_id, item_id, s, m, anchored, sum(least(wg.c, ic.c)) AS shared, any_value(n) - 4 AS a
           FROM wg JOIN ic USING (item_id, g) GROUP BY doc_id, item_id, s, m, anchored),
near AS (SELECT *, CAST(shared AS DOUBLE) / CAST(a + m - 4 - shared AS DOUBLE) AS similarity FROM scored)
SELECT doc_id, item_id, similarity, CAST(s AS BIGINT) AS start_word, CAST(m AS BIGINT) AS n_words FROM (
  SELECT *, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, anchored DESC, s, m DESC) AS r
  FROM near WHERE similarity >= {decontaminate.SIMILARITY}) WHERE r = 1"""

def _crc_table() -> list[int]:
    """The byte table of CRC-32 (reflected polynomial 0xEDB88320), by its rule."""
    out = []
    for c in range(256):
        for _ in range(8):
            c = c >> 1 ^ (0xEDB88320 if c & 1 else 0)
        out.append(c)
    return out


def _crc32_sql(text: str) -> str:
    """Unsigned crc32 of a text's UTF-8 bytes; the table is ``crc.t``."""
    bytes_ = (f"list_transform(range(0, octet_length(encode({text}))), "
              f"lambda i: CAST('0x' || substr(hex(encode({text})), 2 * i + 1, 2) AS BIGINT))")
    return (f"xor(list_reduce({bytes_}, lambda c, b: xor(crc.t[(xor(c, b) & 255) + 1], c >> 8), 4294967295), 4294967295)")


_CRC = f"crc AS (SELECT CAST({_crc_table()} AS BIGINT[]) AS t)"


def _leaf_sql(text: str) -> str:
    field = "coalesce(octet_length(encode(CAST({0} AS VARCHAR))) || ':' || CAST({0} AS VARCHAR), '-')"
    return "sha256(" + " || ".join(field.format(f) for f in ["doc_id", "source", "lang", "n_chars", text]) + ")"


def _tree_sql(name: str, leaves: str) -> str:
    """All nodes (level, g, pos, node, n: nodes of the level) above ``leaves``."""
    return f"""
{name} AS (
  SELECT 0 AS level, g, pos, node, n FROM {leaves}
  UNION ALL
  SELECT level + 1, g, pos // 3, sha256(string_agg(node, '' ORDER BY pos)), (n + 2) // 3
  FROM {name} WHERE n > 1 GROUP BY level, g, pos // 3, n)"""


def _steps_sql(tree: str, leaves: str, at: str) -> str:
    """Siblings to the left and right, by level, of every leaf (column ``at``)."""
    return f"""
  SELECT l.{at}, t.level,
         coalesce(string_agg(t.node, '' ORDER BY t.pos) FILTER (WHERE t.pos < l.pos // CAST(pow(3, t.level) AS BIGINT)), '') AS lo,
         coalesce(string_agg(t.node, '' ORDER BY t.pos) FILTER (WHERE t.pos > l.pos // CAST(pow(3, t.level) AS BIGINT)), '') AS hi
  FROM {leaves} l JOIN {tree} t
    ON t.g = l.g AND t.n > 1 AND t.pos // 3 = l.pos // CAST(pow(3, t.level + 1) AS BIGINT)
  GROUP BY l.{at}, t.level"""


MERKLE_SQL = f"""
WITH RECURSIVE {_CRC},
rows AS (
  SELECT doc_id, source, {_leaf_sql("text")} AS leaf,
         CASE WHEN {_crc32_sql("CAST(doc_id AS VARCHAR)")} % 2 = 0 THEN {_leaf_sql("replace(text, chr(10), '')")} END AS copy
  FROM documents, crc),
numbered AS (
  SELECT *, row_number() OVER (ORDER BY doc_id) AS r,
         dense_rank() OVER (ORDER BY source NULLS FIRST) AS g,
         row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
         count(*) OVER (PARTITION BY source) AS n, leaf AS node FROM rows),
{_tree_sql("tree", "numbered")},
subroots AS (
  SELECT g AS sg, 1 AS g, row_number() OVER (ORDER BY g) - 1 AS pos, count(*) OVER () AS n, node FROM tree WHERE n = 1),
{_tree_sql("upper_tree", "subroots")},
steps AS ({_steps_sql("tree", "numbered", "r")}),
upper_steps AS ({_steps_sql("upper_tree", "subroots", "sg")}),
height AS (SELECT g, max(level) AS h FROM tree GROUP BY g),
path AS (
  SELECT r, level, lo, hi FROM steps
  UNION ALL
  SELECT numbered.r, height.h + u.level, lo, hi
  FROM upper_steps u JOIN numbered ON numbered.g = u.sg JOIN height ON height.g = u.sg),
proofs AS (SELECT r, string_agg(lo || hi, '' ORDER BY level) AS proof, max(level) + 1 AS steps FROM path GROUP BY r),
folded AS (
  SELECT r, 0 AS level, coalesce(copy, leaf) AS node FROM numbered
  UNION ALL
  SELECT folded.r, folded.level + 1, sha256(lo || node || hi) FROM folded JOIN path USING (r, level)),
root AS (SELECT node FROM upper_tree WHERE n = 1)
SELECT doc_id, leaf, subroots.node AS subroot, root.node AS root, sha256(coalesce(proof, '')) AS proof_sha256,
       folded.node AS folded_root, folded.node = root.node AS verified
FROM numbered JOIN subroots ON subroots.sg = numbered.g LEFT JOIN proofs USING (r)
JOIN folded ON folded.r = numbered.r AND folded.level = coalesce(proofs.steps, 0), root"""

SUFFIX_SQL = f"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
windows AS (
  SELECT r, s, md5_number(substr(h, CAST(2 * s + 1 AS BIGINT), {2 * WINDOW})) AS w
  FROM (SELECT r, h, unnest(range(0, length(h) // 2 - {WINDOW - 1})) AS s FROM texts)),
often AS (SELECT w FROM windows GROUP BY w HAVING count(*) > 1),
marked AS (
  SELECT r, s, coalesce(s > lag(s) OVER (PARTITION BY r ORDER BY s) + {WINDOW}, true) AS fresh
  FROM windows JOIN often USING (w)),
runs AS (SELECT r, s, sum(CASE WHEN fresh THEN 1 ELSE 0 END) OVER (PARTITION BY r ORDER BY s) AS k FROM marked),
spans AS (SELECT r, k, min(s) AS s, max(s) + {WINDOW} AS e FROM runs GROUP BY r, k),
edges AS (
  SELECT r, k, s, e, coalesce(lag(e) OVER (PARTITION BY r ORDER BY k), 0) AS kept_from FROM spans),
cuts AS (
  SELECT r, count(*) AS n_spans, sum(e - s) AS n_removed, max(e) AS last_end,
         string_agg(substr(h, CAST(2 * kept_from + 1 AS BIGINT), CAST(2 * (s - kept_from) AS BIGINT)), '' ORDER BY k) AS kept
  FROM edges JOIN texts USING (r) GROUP BY r)
SELECT doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(kept, '') || substr(h, CAST(2 * coalesce(last_end, 0) + 1 AS BIGINT)))) AS kept_sha256
FROM texts LEFT JOIN cuts USING (r)"""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

SPELLING_SQL = f"""
WITH RECURSIVE {_CRC},
runs AS (
  SELECT doc_id, translate(run, '{_UPPER}', '{_LOWER}') AS run, count(*) AS c
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents)
  WHERE length(run) >= {spelling.MIN_LENGTH} GROUP BY ALL),
hashed AS (
  SELECT run, c, {_crc32_sql("coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run")} AS h FROM runs, crc),
words AS (
  SELECT CASE WHEN h % {SPELLING_SALT} = 0
              THEN substr(run, 1, CAST(h % length(run) AS BIGINT)) || substr(run, CAST(h % length(run) AS BIGINT) + 2)
              ELSE run END AS word, sum(c) AS n
  FROM hashed GROUP BY ALL),
vocab AS (SELECT word, CAST(n AS BIGINT) AS n FROM (SELECT word, sum(n) AS n FROM words GROUP BY word)
          WHERE length(word) >= {spelling.MIN_LENGTH} AND n >= {spelling.MIN_COUNT}),
gaps AS (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM vocab)),
pairs AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM gaps a JOIN gaps b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION
  SELECT g.word, v.word, v.n FROM gaps g JOIN vocab v ON g.rest = v.word
  UNION
  SELECT v.word, g.word, g.n FROM gaps g JOIN vocab v ON g.rest = v.word),
ranked AS (
  SELECT word, near, near_n, row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) AS k,
         count(*) OVER (PARTITION BY word) AS n_near FROM pairs),
forms AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near,
         CASE WHEN near_n >= {spelling.TIMES} * v.n THEN near END AS form,
         CASE WHEN near_n >= {spelling.TIMES} * v.n THEN near_n END AS form_n
  FROM vocab v LEFT JOIN ranked r ON r.word = v.word AND k = 1),
walk AS (
  SELECT word, word AS at FROM forms
  UNION ALL
  SELECT walk.word, forms.form FROM walk JOIN forms ON forms.word = walk.at WHERE forms.form IS NOT NULL),
ends AS (SELECT walk.word, walk.at AS root FROM walk JOIN forms ON forms.word = walk.at WHERE forms.form IS NULL)
SELECT forms.word, form, root, n, n_near, form_n FROM forms JOIN ends USING (word)"""

# The others have no SQL form here: a classifier, MinHash groups, keyed
# permutations, XXH64 fingerprints, diagonal votes with a coverage, and BPE.
ORACLE: dict[str, str] = {
    "op3_chat_format": CHAT_SQL,
    "op4_exact_topk": TOPK_SQL,
    "op5_sharding": SHARDING_SQL,
    "op6_decontamination": DECONTAMINATION_SQL,
    "op11_merkle_manifest": MERKLE_SQL,
    "op12_suffix_dedup": SUFFIX_SQL,
    "op13_spelling_variants": SPELLING_SQL,
}
