"""The registered queries of this subpackage, each over its whole table."""

import public_tokenizers
from pyspark.sql import functions as F

from orderloom.llm import (
    bpe,
    chat,
    decontamination,
    jaccard,
    language,
    lm,
    merkle,
    quality,
    repetition,
    sharding,
    simhash,
    vector_codes,
    warc,
)
from orderloom.llm.text import held_out, table

QUERIES = {}
ORACLES = {}


def query(build):
    QUERIES[build.__name__] = build
    return build


@query
def op1_byte_convolution(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return language.identify(docs, language.fit(docs)).select(
        "doc_id", held_out("doc_id", 5).alias("held_out"), "lang_pred", "score")


@query
def op2_dictionary_warc(spark, sf_dir):
    archives, folder = warc.archive_pages(table(spark, sf_dir, "pages"))
    return warc.read_archives(archives, folder).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLES["op2_dictionary_warc"] = f"""
WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes,
    sha1(coalesce(html, '')) AS payload_digest FROM pages),
s AS (SELECT payload_digest, max(page_id) AS stored FROM p
    WHERE payload_bytes >= {warc.REVISIT_BYTES} GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
    CASE WHEN stored <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN stored <> page_id THEN stored END AS refers_to
FROM p LEFT JOIN s USING (payload_digest)"""


@query
def op3_random_indexing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    vectors = quality.word_vectors(docs)
    net = quality.fit(docs, table(spark, sf_dir, "labels"), vectors)
    return quality.scores(docs, vectors, net).select(
        "doc_id", held_out("doc_id", 5).alias("held_out"), "score", "predicted")


@query
def op9_tool_call_links(spark, sf_dir):
    calls, results = chat.conversation_calls(table(spark, sf_dir, "conversations"))
    return chat.format_calls(calls, results, chat.TURN_TOOLS).withColumn(
        "errors", F.array_join("errors", "; "))


_CALL = "'call_' || conv_id || '_' || "
ORACLES["op9_tool_call_links"] = f"""
WITH RECURSIVE calls AS (SELECT conv_id::VARCHAR AS conversation, {_CALL} turn AS call_id, turn,
    role, text, CASE WHEN turn = 1 THEN {_CALL} 0 WHEN turn > 1 THEN {_CALL} (turn - 2) END
        AS needs FROM conversations WHERE role IN ('user', 'system')),
results AS (SELECT conv_id::VARCHAR AS conversation, {_CALL} (turn - 1) AS call_id, turn, text
    FROM conversations WHERE role = 'assistant'),
pairs AS (SELECT c.call_id AS later, c.needs AS earlier, p.call_id IS NOT NULL AS known,
    coalesce(length(c.text), 0) < coalesce(length(p.text), 0) AND known AS waits
  FROM calls c LEFT JOIN calls p ON p.call_id = c.needs WHERE c.needs IS NOT NULL),
edges AS (SELECT CASE WHEN waits THEN earlier ELSE later END AS holder,
    CASE WHEN waits THEN later ELSE earlier END AS need FROM pairs WHERE known),
behind AS (SELECT call_id AS holder, call_id AS need, 0 AS steps FROM calls
  UNION ALL SELECT b.holder, e.need, steps + 1 FROM behind b JOIN edges e ON e.holder = b.need),
due AS (SELECT holder AS call_id, max({{'place': turn, 'step': steps}}) AS due
  FROM behind JOIN calls ON call_id = need GROUP BY holder),
rows AS (SELECT coalesce(c.conversation, r.conversation) AS conversation,
    coalesce(c.call_id, r.call_id) AS call_id, coalesce(c.turn, r.turn) AS place,
    CASE WHEN c.call_id IS NULL THEN 'orphan_result' WHEN r.call_id IS NULL THEN 'unanswered'
        ELSE 'linked' END AS status,
    (r.call_id IS NOT NULL)::BIGINT AS answers,
    (SELECT count(*) FROM pairs WHERE later = c.call_id AND NOT known) AS unknown_needs,
    CASE WHEN c.call_id IS NULL THEN 'no call has this identifier'
        WHEN c.text = '' THEN CASE c.role WHEN 'system' THEN 'arguments.instruction: too short'
            ELSE 'arguments.prompt: too short' END ELSE '' END AS errors,
    CASE WHEN c.call_id IS NULL THEN json_object('id', r.call_id, 'result', r.text)
        WHEN c.role = 'system' THEN json_object('arguments', json_object(
            'instruction', c.text, 'turn', c.turn), 'id', c.call_id, 'name', 'instruct',
            'result', r.text)
        ELSE json_object('arguments', json_object('prompt', c.text, 'turn', c.turn),
            'id', c.call_id, 'name', 'ask', 'result', r.text) END::VARCHAR AS message
  FROM calls c FULL JOIN results r USING (call_id))
SELECT conversation, row_number() OVER (PARTITION BY conversation
        ORDER BY coalesce(due.place, place), coalesce(due.step, 0), place, call_id, status) - 1 AS position, call_id, status, answers,
    unknown_needs, false AS cyclic, errors = '' AS valid, errors, message
FROM rows LEFT JOIN due USING (call_id)"""


@query
def op10_virtual_slots(spark, sf_dir):
    placed = sharding.shard_documents(table(spark, sf_dir, "documents"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                         "slot", F.lit(None).cast("int").alias("grown_shard"), "virtual_slot",
                         "map_version")


@query
def op6_subword_lattice(spark, sf_dir):
    scored = lm.score(table(spark, sf_dir, "documents"), ~held_out("doc_id", 10),
                      public_tokenizers.path("piece_bpe_32k.model"))
    return scored.select("doc_id", held_out("doc_id", 10).alias("held_out"), "n_tokens",
                         "n_known", "train_tokens", "base_score", "score", "word_score")


@query
def op7_simhash_bk_trees(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op8_bpe_chunks(spark, sf_dir):
    return bpe.digests(table(spark, sf_dir, "documents"),
                       public_tokenizers.path("byte_bpe_50k.json"))


@query
def op4_suffix_repetition(spark, sf_dir):
    return repetition.repetition(table(spark, sf_dir, "documents")).drop("longest_repeat")


@query
def op5_suffix_automaton(spark, sf_dir):
    return decontamination.contamination(table(spark, sf_dir, "documents"),
                                         table(spark, sf_dir, "benchmark"))


_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def _repeated(size):
    """SQL for the starts of windows of `size` words that occur twice or more in a text."""
    return f"""SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, win) > 1 AS again
        FROM (SELECT doc_id, p, array_to_string(ws[p:p + {size - 1}], ' ') AS win
              FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - {size - 2})) AS p FROM w))"""


def _covered(size, name):
    """SQL for the number of words of a text inside such windows."""
    return f"""SELECT doc_id, count(*) FILTER (inside) AS {name} FROM (
        SELECT t.doc_id, coalesce(max(again) OVER (PARTITION BY t.doc_id ORDER BY t.p
            ROWS BETWEEN {size - 1} PRECEDING AND CURRENT ROW), false) AS inside
        FROM (SELECT doc_id, unnest(range(1, len(ws) + 1)) AS p FROM w) t
        LEFT JOIN ({_repeated(size)}) r ON r.doc_id = t.doc_id AND r.p = t.p) GROUP BY doc_id"""


# A repeat of n words or more covers what repeated windows of n words cover; one of more than n
# words exists if a window of n + 1 words is repeated.
ORACLES["op4_suffix_repetition"] = f"""
WITH w AS (SELECT doc_id, {_WORDS} AS ws,
    len(coalesce(text, '')) - len(regexp_replace(coalesce(text, ''), '[#*$%&|<>]', '', 'g'))
        AS n_symbols,
    list_filter(string_split(coalesce(text, ''), chr(10)),
        lambda s: regexp_matches(s, '[^\x20\x09-\x0D]')) AS lines FROM documents),
three AS ({_covered(3, "n_repeat_words")}),
long AS ({_covered(repetition.MIN_REPEAT_WORDS, "n_covered_words")}),
long_one AS (SELECT doc_id, bool_or(again) AS too_long FROM (
    {_repeated(repetition.MAX_REPEAT_WORDS + 1)}) GROUP BY doc_id),
base AS (SELECT doc_id, len(ws)::BIGINT AS n_words,
    coalesce(list_sum(list_transform(ws, lambda s: len(s))), 0)::BIGINT AS word_chars,
    n_symbols::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words,
    coalesce(n_covered_words, 0) AS n_covered_words, coalesce(too_long, false) AS too_long
  FROM w LEFT JOIN three USING (doc_id) LEFT JOIN long USING (doc_id)
  LEFT JOIN long_one USING (doc_id))
SELECT * EXCLUDE (too_long), n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
    AND n_covered_words <= {repetition.MAX_COVERED} * n_words
    AND NOT too_long AS kept FROM base"""

_NORMAL = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""
ORACLES["op5_suffix_automaton"] = f"""
WITH w AS (SELECT doc_id, {_NORMAL} AS ws FROM documents),
i AS (SELECT item_id, {_NORMAL} AS ws FROM benchmark),
item_windows AS (SELECT DISTINCT item_id, size, array_to_string(ws[p:p + size - 1], ' ') AS win
    FROM (SELECT item_id, ws, size, unnest(range(1, len(ws) - size + 2)) AS p FROM (
        SELECT *, least({decontamination.WINDOW}, len(ws)) AS size FROM i WHERE len(ws) > 0))),
sizes AS (SELECT DISTINCT size FROM item_windows),
doc_windows AS (SELECT doc_id, p, size, array_to_string(ws[p:p + size - 1], ' ') AS win
    FROM (SELECT doc_id, ws, size, unnest(range(1, len(ws) - size + 2)) AS p
          FROM w JOIN sizes ON len(ws) >= size)),
hits AS (SELECT doc_id, p, size, item_id FROM doc_windows JOIN item_windows USING (size, win)),
words AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM (
    SELECT doc_id, unnest(range(p, p + size)) AS place FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS name FROM hits) GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit,
    coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AND {decontamination.ONE_IN} * coalesce(n_hit, 0) >= len(ws)
        AS contaminated
FROM w LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)"""


@query
def op12_time_forward_merkle(spark, sf_dir):
    leaves = merkle.document_leaves(table(spark, sf_dir, "documents"))
    return merkle.manifest(leaves).select(
        "doc_id", "leaf", "subroot", "root", merkle.proof_digest("proof").alias("proof_sha256"),
        "folded_root", "verified")


def _field(column):
    return f"coalesce(strlen({column}::VARCHAR)::VARCHAR || ':' || {column}::VARCHAR, '-')"


def _leaf(n_chars):
    fields = ("doc_id", "source", "lang", n_chars, "text")
    return f"sha256({' || '.join(map(_field, fields))})"


def _rising(source):
    """SQL for the levels above the nodes `source` (tree, place, n, value)."""
    return f"""SELECT tree, 0 AS level, place, n, value FROM {source} UNION ALL
        SELECT tree, level + 1, place // 2, (any_value(n) + 1) // 2,
            sha256(string_agg(value, '' ORDER BY place)) FROM {{up}} WHERE n > 1
        GROUP BY tree, level, place // 2"""


# The CRC-32 of a short text, bit by bit.
_CRC = """list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, strlen(name) + 1),
    lambda i: ascii(name[i])::BIGINT)), lambda crc, byte: list_reduce(list_prepend(
        xor(crc, byte), range(8)), lambda c, k: xor(c >> 1, (c & 1) * 3988292384)))"""
ORACLES["op12_time_forward_merkle"] = f"""
WITH RECURSIVE d AS (SELECT *, xor({_CRC}, 4294967295) % 7 = 0 AS hit FROM (
    SELECT *, doc_id::VARCHAR AS name FROM documents)),
leaves AS (SELECT doc_id, lang, {_leaf("n_chars")} AS value,
    {_leaf("CASE WHEN hit THEN n_chars + 1 ELSE n_chars END")} AS claimed FROM d),
nodes AS (SELECT doc_id, value, claimed, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS place,
    count(*) OVER (PARTITION BY lang) AS n FROM leaves),
up AS ({_rising("nodes").format(up="up")}),
subroots AS (SELECT 0 AS tree, tree AS place, count(*) OVER () AS n, value FROM up WHERE n = 1),
top AS ({_rising("subroots").format(up="top")}),
path AS (SELECT doc_id, claimed AS value, tree, 0 AS stage, 0 AS level, place, n, '' AS proof
    FROM nodes UNION ALL
  SELECT * FROM (
    SELECT p.doc_id, sha256(CASE WHEN s.value IS NULL THEN p.value WHEN p.place % 2 = 0
            THEN p.value || s.value ELSE s.value || p.value END), p.tree, p.stage, p.level + 1,
        p.place // 2, (p.n + 1) // 2, p.proof || coalesce(s.value, '')
    FROM path p LEFT JOIN (SELECT 0 AS stage, * FROM up UNION ALL SELECT 1, * FROM top) s
      ON s.stage = p.stage AND s.tree = p.tree AND s.level = p.level
        AND s.place = xor(p.place, 1)
    WHERE p.n > 1 UNION ALL
    SELECT doc_id, value, 0, 1, 0, tree, (SELECT count(*) FROM subroots), proof
    FROM path WHERE n = 1 AND stage = 0)),
folded AS (SELECT doc_id, value AS folded_root, proof FROM path WHERE stage = 1 AND n = 1)
SELECT doc_id, nodes.value AS leaf, s.value AS subroot, r.value AS root,
    sha256(proof) AS proof_sha256, folded_root, folded_root = r.value AS verified
FROM nodes JOIN folded USING (doc_id) JOIN subroots s ON s.place = nodes.tree
CROSS JOIN (SELECT value FROM top WHERE n = 1) r"""


@query
def op11_gnat_codes(spark, sf_dir):
    return vector_codes.compress(table(spark, sf_dir, "embeddings"))


def _assigning(books):
    """SQL for the nearest entry and the squared distance of every part to it."""
    return f"""SELECT vec_id, part, v, a.entry, a.error FROM (
        SELECT vec_id, part, v, min(struct_pack(error := list_sum(list_transform(
            list_zip(v, b), lambda x: (x[1] - x[2]) * (x[1] - x[2]))), entry := entry)) AS a
        FROM parts JOIN {books} USING (part) GROUP BY vec_id, part, v)"""


def _refining(assigned, books):
    """SQL for the codebooks after a round."""
    return f"""SELECT part, entry, coalesce(m, b) AS b FROM {books} LEFT JOIN (
        SELECT part, entry, list(mean ORDER BY i) AS m FROM (
            SELECT part, entry, i, floor(sum(v[i])::DOUBLE / count(*))::BIGINT AS mean
            FROM {assigned}, (SELECT unnest(range(1, 5)) AS i) GROUP BY part, entry, i)
        GROUP BY part, entry) USING (part, entry)"""


ORACLES["op11_gnat_codes"] = f"""
WITH kept AS (SELECT vec_id, label, list_transform(embedding,
        lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
    WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS (SELECT vec_id, part, v[4 * part + 1:4 * part + 4] AS v
    FROM kept, (SELECT unnest(range({vector_codes.PARTS})) AS part)),
b0 AS (SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, v AS b
    FROM parts WHERE vec_id IN (SELECT vec_id FROM kept ORDER BY vec_id
        LIMIT {vector_codes.ENTRIES})),
a0 AS ({_assigning("b0")}), b1 AS ({_refining("a0", "b0")}),
a1 AS ({_assigning("b1")}), b2 AS ({_refining("a1", "b1")}),
a2 AS ({_assigning("b2")}),
coded AS (SELECT vec_id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code,
    sum(error)::BIGINT AS error FROM a2 GROUP BY vec_id),
books AS (SELECT sha256(string_agg(list_aggregate(b, 'string_agg', ','), ','
    ORDER BY part, entry)) AS codebooks_sha256 FROM b2)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error,
    codebooks_sha256
FROM coded JOIN kept USING (vec_id) CROSS JOIN books"""


@query
def op13_light_heavy_jaccard(spark, sf_dir):
    return jaccard.join(table(spark, sf_dir, "documents"))


_LOWER = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"""
ORACLES["op13_light_heavy_jaccard"] = f"""
WITH RECURSIVE w AS (SELECT doc_id, {_LOWER} AS ws FROM documents),
s AS (SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < {jaccard.SHINGLE}
        THEN [array_to_string(ws, ' ')] ELSE list_distinct(list_transform(
            range(1, len(ws) - {jaccard.SHINGLE - 2}),
            lambda p: array_to_string(ws[p:p + {jaccard.SHINGLE - 1}], ' '))) END AS shingles
    FROM w),
sizes AS (SELECT doc_id, len(shingles)::BIGINT AS n FROM s),
each AS (SELECT doc_id, n, unnest(shingles) AS shingle FROM s JOIN sizes USING (doc_id)),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, a.n AS n, b.n AS m, count(*) AS c
    FROM each a JOIN each b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
        AND 100 * a.n >= {jaccard.PERCENT} * b.n AND 100 * b.n >= {jaccard.PERCENT} * a.n
    GROUP BY ALL),
links AS (SELECT a, b FROM common WHERE 100 * c >= {jaccard.PERCENT} * (n + m - c)),
ends AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id, doc_id AS other FROM sizes UNION
    SELECT r.doc_id, e.b FROM reach r JOIN ends e ON e.a = r.other)
SELECT doc_id, n AS n_shingles, min(other) AS component_id
FROM sizes JOIN reach USING (doc_id) GROUP BY doc_id, n"""
