"""The training-data operators as queries over the given tables.

What a query writes to the shared folder stays there, as its result still reads it; within common.scratch_of_run() it can be cleaned up.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import alignment, byte_bpe, chat_format, language_id, line_dedup, media_sniff, packing, prefix_trie, quality_rules, quality_votes, simhash, token_counts, toxicity
from .common import crc_of_id, table, written


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_rules.verdicts(table(spark, sf_dir, "documents").select("doc_id", "text"))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "fail_bits")
    earlier = quality_rules.allows(quality_rules.POLICIES["v1"], F.col("ledger.fail_bits")).alias("kept_v1")
    return found.select("doc_id", *[F.col(f"ledger.{x}").alias(x) for x in names], earlier)


OP1_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
    regexp_extract_all(coalesce(text, ''), '\p{L}') AS letters
  FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS g
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 7)) AS i FROM d WHERE len(w) > 8)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM windows) WHERE n > 1),
covered AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest(generate_series(i, i + 7)) AS j FROM twice) GROUP BY doc_id),
m AS (
  SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    coalesce(covered.n, 0)::BIGINT AS n_repeat_words, len(lines)::BIGINT AS n_lines, len(letters)::BIGINT AS n_letters,
    len(list_filter(letters, lambda x: regexp_matches(x, '\p{Lu}')))::BIGINT AS n_upper,
    len(list_filter(generate_series(2, len(w)), lambda i: w[i] = w[i - 1]))::BIGINT AS n_stutters
  FROM d LEFT JOIN covered USING (doc_id)),
bits AS (
  SELECT *, ((n_words < 20)::BIGINT + (100 * n_repeat_words > 30 * n_words)::BIGINT * 2 + (100 * n_symbols > 30 * n_words)::BIGINT * 4
    + (100 * n_dup_lines > 50 * n_lines)::BIGINT * 8 + (100 * n_upper > 50 * n_letters)::BIGINT * 16 + (word_chars > 40 * n_words)::BIGINT * 32
    + (2 * n_letters < word_chars)::BIGINT * 64 + (100 * n_stutters > 40 * n_words)::BIGINT * 128)::BIGINT AS fail_bits
  FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, fail_bits & 3 <> 0 AS base_failed, fail_bits = 0 AS kept, fail_bits,
  fail_bits & 3 = 0 AS kept_v1
FROM bits
"""


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = crc_of_id() % 4 == 2
    prototypes = language_id.train(docs.where(~held_out))
    found = language_id.predict(docs.select("doc_id", "text"), prototypes)
    return found.select("doc_id", held_out.alias("held_out"), F.col("language.lang_pred").alias("lang_pred"), F.col("language.score").alias("score"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = crc_of_id() % 3 == 1
    model = toxicity.fit(toxicity.training_rows(docs.where(~held_out), table(spark, sf_dir, "labels")))
    found = toxicity.score(docs, model)
    return found.select("doc_id", held_out.alias("held_out"), F.col("toxicity.score").alias("score"), F.col("toxicity.predicted").alias("predicted"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = byte_bpe.digests(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "bpe.n_tokens", "bpe.ids_sha256", "bpe.decoded_sha256")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.pieces(table(spark, sf_dir, "documents").select("doc_id", "text")))


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    odd = "<|im_end|><|im_start|>assistant ok"
    extra = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(odd).alias("text"))
    examples = chat_format.texts(chat_format.expand(given.unionByName(extra)))
    read = examples.select(
        "conv_id", "alone", "example", F.length("text").alias("chars"),
        chat_format.unescaped(chat_format.part("text", "loss_start", "loss_end")).alias("reply"),
        "text",
    )
    last = F.max_by("text", "example").alias("text")
    replies = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("example", "reply"))), lambda x: x["reply"]), "").alias("replies")
    # grouped as its turns are, so that nothing moves again
    by_conv = read.groupBy("conv_id", "alone").agg(last, replies, F.sum("chars").cast("long").alias("formatted_chars"))
    turns = by_conv.withColumn("turns", chat_format.read_turns(F.col("text")))
    spelled = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return turns.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(spelled, 256).alias("turns_sha256"),
        F.length("replies").cast("long").alias("loss_chars"),
        F.sha2("replies", 256).alias("loss_sha256"),
        "formatted_chars",
    )


OP6_SQL = r"""
WITH c AS (
  SELECT conv_id, CASE WHEN conv_id IS NULL THEN row_number() OVER () ELSE 0 END AS alone, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 0, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
o AS (
  SELECT *, row_number() OVER w AS i, sum(12 + 11 + 1 + length(replace(replace(role, '&', '&amp;'), '<|', '&lt;|')) + length(replace(replace(text, '&', '&amp;'), '<|', '&lt;|'))) OVER w AS upto
  FROM c WINDOW w AS (PARTITION BY conv_id, alone ORDER BY turn NULLS FIRST, role, text ROWS UNBOUNDED PRECEDING)),
m AS (SELECT conv_id, alone, max(i) AS n, max(i) FILTER (role = 'assistant') AS last_reply, max(upto) AS whole FROM o GROUP BY conv_id, alone)
SELECT o.conv_id, max(n)::BIGINT AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '')) AS loss_sha256,
  (coalesce(sum(upto) FILTER (role = 'assistant'), 0) + CASE WHEN coalesce(max(last_reply), 0) < max(n) THEN max(whole) ELSE 0 END)::BIGINT AS formatted_chars
FROM o JOIN m ON o.conv_id IS NOT DISTINCT FROM m.conv_id AND o.alone = m.alone GROUP BY o.conv_id, o.alone
"""


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "line_dedup.n_lines", "line_dedup.n_dropped", F.sha2("line_dedup.kept", 256).alias("kept_sha256"))


OP7_SQL = r"""
WITH lines AS (
  SELECT doc_id, i, ls[i] AS line, translate(trim(ls[i], chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, ls, unnest(generate_series(1, len(ls))) AS i FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents))),
gone AS (SELECT key, max(doc_id) AS last_doc FROM lines WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
marked AS (SELECT doc_id, i, line, last_doc IS NOT NULL AND last_doc <> doc_id AS dropped FROM lines LEFT JOIN gone USING (key))
SELECT doc_id, count(*)::BIGINT AS n_lines, (count(*) FILTER (dropped))::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens of every document, counted in token files that are written first."""
    folder = token_counts.write_flat(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return token_counts.scan(spark, folder).select("doc_id", "n_tokens")


def op10_media_sniff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media_sniff.store_and_read(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "media.*")


def op11_quality_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = crc_of_id() % 5 == 0
    model = quality_votes.fit(quality_votes.training_rows(docs.where(~held_out), table(spark, sf_dir, "labels")), docs)
    found = quality_votes.score(docs, model)
    return found.select("doc_id", held_out.alias("held_out"), F.col("quality.score").alias("score"), F.col("quality.predicted").alias("predicted"))


#: A conversation begins with up to this many turns less one of the first conversation of its FAMILY.
BORROWED, FAMILY = 9, 5


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    turns = written(prefix_trie.ordered_turns(given), "turns")
    conversations = given.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    borrowed = F.crc32(F.col("conv_id").cast("string")) % BORROWED
    own = turns.where(F.col("pos") >= borrowed)
    # the first conversation of a family lends its first turns to each that asks for them, itself included
    asked = conversations.select((F.col("conv_id") - F.col("conv_id") % FAMILY).alias("lender"), F.col("conv_id").alias("by"), borrowed.alias("n"))
    lent = turns.where(F.col("pos") < BORROWED - 1).join(asked, F.col("conv_id") == F.col("lender")).where("pos < n")
    lent = lent.select(F.col("by").alias("conv_id"), "pos", "digest", "bytes")
    # where the lender is shorter, what follows moves up
    order = Window.partitionBy("conv_id").orderBy("pos")
    rebuilt = lent.unionByName(own).withColumn("pos", (F.row_number().over(order) - 1).cast("long"))
    return prefix_trie.trie(rebuilt, conversations)


OP12_SQL = r"""
WITH steps AS (
  SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)), lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)) AS crc),
ids AS (
  SELECT conv_id, conv_id - conv_id % 5 AS lender,
    xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
      lambda x, y: xor(x >> 8, crc[(xor(x, y) & 255) + 1])), 4294967295) % 9 AS h
  FROM (SELECT DISTINCT conv_id::BIGINT AS conv_id FROM conversations WHERE conv_id IS NOT NULL), steps),
o AS (
  SELECT conv_id::BIGINT AS conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS pos,
    coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
rebuilt AS (
  SELECT ids.conv_id, o.pos, o.role, o.text FROM ids JOIN o ON o.conv_id = ids.lender AND o.pos < ids.h
  UNION ALL SELECT ids.conv_id, o.pos, o.role, o.text FROM ids JOIN o USING (conv_id) WHERE o.pos >= ids.h),
paths AS (
  SELECT conv_id, coalesce(list({'role': role, 'text': text} ORDER BY pos) FILTER (pos IS NOT NULL), []) AS turns
  FROM ids LEFT JOIN rebuilt USING (conv_id) GROUP BY conv_id),
members AS (SELECT conv_id, len(turns) = d AS ends, d, turns[1:d] AS path FROM (SELECT conv_id, turns, unnest(range(len(turns) + 1)) AS d FROM paths)),
nodes AS (
  SELECT d, path, min(conv_id) AS conv_id, count(*)::BIGINT AS n_convs,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256,
    (count(*) - 1) * CASE WHEN d = 0 THEN 0 ELSE strlen(path[d].text) END AS saved
  FROM members GROUP BY d, path),
edges AS (SELECT p.conv_id, p.d, count(c.d)::BIGINT AS n_children FROM nodes p LEFT JOIN nodes c ON c.d = p.d + 1 AND c.path[1:p.d] = p.path GROUP BY p.conv_id, p.d),
subtree AS (
  SELECT a.conv_id, a.d, sum(b.saved)::BIGINT AS saved_tokens, count(*) FILTER (e.n_children = 0)::BIGINT AS n_leaves
  FROM (SELECT conv_id, d, saved, unnest(range(d + 1)) AS up, path FROM nodes) b JOIN nodes a ON a.d = b.up AND b.path[1:b.up] = a.path
  JOIN edges e ON e.conv_id = b.conv_id AND e.d = b.d GROUP BY a.conv_id, a.d)
SELECT n.conv_id, n.d::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs, e.n_children, s.n_leaves, s.saved_tokens, n.ends_sha256
FROM nodes n LEFT JOIN nodes p ON p.d = n.d - 1 AND n.path[1:n.d - 1] = p.path
JOIN edges e ON e.conv_id = n.conv_id AND e.d = n.d JOIN subtree s ON s.conv_id = n.conv_id AND s.d = n.d
"""


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES = {f.__name__: f for f in (op1_quality_rules, op2_language_id, op3_byte_bpe, op4_packing, op5_simhash, op6_chat_format, op7_line_dedup, op8_token_counts, op9_toxicity, op10_media_sniff, op11_quality_votes, op12_prefix_trie, op13_alignment)}
ORACLE_SQL = {"op1_quality_rules": OP1_SQL, "op6_chat_format": OP6_SQL, "op7_line_dedup": OP7_SQL, "op12_prefix_trie": OP12_SQL}
