"""The registered queries of the corpus operators: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wideskein.llm import exact_dedup, langid, mixing, near_copies, packing, prefix_trie, recompression, resampling, secrets, sharding, simhash, sketches, toxicity


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_pack_cutting_stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_read(spark, sf_dir, "documents"))


def op2_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed, _ = sharding.shard_documents(_read(spark, sf_dir, "documents"), 24)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "virtual_slot")


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.mark(_read(spark, sf_dir, "documents"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(_read(spark, sf_dir, "documents"))


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_read(spark, sf_dir, "documents"))


def op6_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recompression.kept_digests(_read(spark, sf_dir, "documents"))


def op7_bottom_k_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketches.fingerprint_edits(_read(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, _read(spark, sf_dir, "labels")))


def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_plan(_read(spark, sf_dir, "documents")).select("doc_id", "source", "size", "source_size", "target", "taken")


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(_read(spark, sf_dir, "documents")).drop("features")


def op11_target_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


#: The contract of op12: pairs of words, A-Z lowered, texts without words alone.
OP12_RULE = near_copies.Rule(width=2, percent=80, ascii_only=True, empty_linked=False)


def op12_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_copies.near_duplicates(_read(spark, sf_dir, "documents"), OP12_RULE)


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(_read(spark, sf_dir, "conversations"))


#: CRC-32 of the UTF-8 bytes of the texts ``s`` of a table ``spelled``, as a table ``crcs`` (s, crc).
SQL_CRCS = """
            steps AS (SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) r(i)),
            crcs AS (
                SELECT s, xor(list_reduce(list_prepend(4294967295, list_transform(range(octet_length(encode(s))), lambda k: CAST('0x' || substr(hex(encode(s)), 2 * k + 1, 2) AS BIGINT))),
                    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS crc
                FROM (SELECT DISTINCT s FROM spelled), (SELECT list(v ORDER BY i) AS t FROM steps)
            )"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_pack_cutting_stock, op2_virtual_slots, op3_exact_dedup, op4_language_id, op5_simhash_near_dedup, op6_recompression, op7_bottom_k_fingerprints, op8_toxicity, op9_mix_sources, op10_secret_scan, op11_target_resampling, op12_minhash_near_dedup, op13_prefix_trie)}


def oracle_sql() -> dict[str, str]:
    return {
        "op3_exact_dedup": """
            SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
                   doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
            FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
        """,
        "op6_recompression": r"""
            WITH split AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
            spots AS (SELECT doc_id, unnest(range(1, len(ws) - 11)) AS i FROM split WHERE len(ws) >= 13),
            windows AS (SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS g FROM spots JOIN split USING (doc_id)),
            firsts AS (SELECT g, min(doc_id) AS low FROM windows GROUP BY g),
            covered AS (SELECT DISTINCT doc_id, i + k AS i FROM windows JOIN firsts USING (g) CROSS JOIN range(13) AS r(k) WHERE low < doc_id),
            words AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS i FROM split),
            kept AS (
                SELECT w.doc_id, count(c.i) AS n_removed, string_agg(w.word, ' ' ORDER BY w.i) FILTER (WHERE c.i IS NULL) AS t
                FROM words w LEFT JOIN covered c ON w.doc_id = c.doc_id AND w.i = c.i GROUP BY w.doc_id
            )
            SELECT s.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
            FROM split s LEFT JOIN kept k ON s.doc_id = k.doc_id
        """,
        "op11_target_resampling": rf"""
            WITH texts AS (
                SELECT row_number() OVER () AS r, doc_id, false AS goal, text FROM documents UNION ALL SELECT NULL, NULL, true, text FROM benchmark
            ),
            split AS (
                SELECT r, doc_id, goal, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM texts
            ),
            words AS (SELECT r, goal, unnest(ws) AS s FROM split),
            spelled AS (SELECT s FROM words),
            {SQL_CRCS},
            counts AS (SELECT crc % 10000 AS bucket, count(*) FILTER (WHERE NOT goal) AS s, count(*) FILTER (WHERE goal) AS t FROM words JOIN crcs USING (s) GROUP BY 1),
            sums AS (SELECT count(*) FILTER (WHERE NOT goal) AS big_s, count(*) FILTER (WHERE goal) AS big_t FROM words),
            gains AS (
                SELECT bucket, CAST(floor(1000 * ln((CAST(t + 1 AS DOUBLE) * CAST(big_s + 10000 AS DOUBLE)) / (CAST(s + 1 AS DOUBLE) * CAST(big_t + 10000 AS DOUBLE)))) AS BIGINT) AS gain FROM counts, sums
            ),
            means AS (SELECT r, CAST(floor(sum(gain) / count(*)) AS BIGINT) AS weight FROM words JOIN crcs USING (s) JOIN gains ON crc % 10000 = bucket WHERE NOT goal GROUP BY r),
            scored AS (
                SELECT r, doc_id, CAST(len(ws) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
                    coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296.0::DOUBLE))) AS BIGINT) AS score
                FROM split LEFT JOIN means USING (r) WHERE NOT goal
            ),
            ranks AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST) AS rank, 10 * count(*) OVER () // 100 AS most FROM scored WHERE n_features >= 20)
            SELECT doc_id, n_features, weight, score, CASE WHEN rank <= most THEN rank END AS rank FROM scored LEFT JOIN ranks USING (r)
        """,
        "op12_minhash_near_dedup": r"""
            WITH RECURSIVE rows AS (
                SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents
            ),
            cut AS (SELECT r, doc_id, CASE WHEN len(ws) < 2 THEN ws ELSE list_distinct(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) END AS gs FROM rows),
            sets AS (SELECT list_sort(gs) AS gs, min(r) AS s FROM cut WHERE len(gs) > 0 GROUP BY 1),
            spread AS (SELECT s, len(gs) AS n, unnest(gs) AS g FROM sets),
            often AS (SELECT g, count(*) AS times FROM spread GROUP BY g),
            placed AS (SELECT s, n, g, row_number() OVER (PARTITION BY s ORDER BY times, g) AS nth FROM spread JOIN often USING (g)),
            firsts AS (SELECT s, n, g FROM placed WHERE nth <= n - (80 * n + 99) // 100 + 1),
            pairs AS (SELECT DISTINCT a.s AS a, b.s AS b FROM firsts a JOIN firsts b ON a.g = b.g AND a.s < b.s AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)),
            links AS (
                SELECT a, b FROM (SELECT a, b, len(list_intersect(x.gs, y.gs)) AS common, len(x.gs) + len(y.gs) AS total FROM pairs JOIN sets x ON x.s = a JOIN sets y ON y.s = b)
                WHERE 100 * common >= 80 * (total - common)
            ),
            edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
            reached AS (SELECT s AS a, s AS b FROM sets UNION SELECT reached.a, edges.b FROM reached JOIN edges ON reached.b = edges.a),
            ids AS (SELECT s, min(doc_id) AS low FROM cut JOIN sets ON list_sort(cut.gs) = sets.gs GROUP BY s),
            least_ids AS (SELECT a AS s, min(low) AS component_id FROM reached JOIN ids ON b = ids.s GROUP BY a)
            SELECT doc_id, CAST(len(c.gs) AS BIGINT) AS n_shingles, CASE WHEN len(c.gs) = 0 THEN doc_id ELSE component_id END AS component_id,
                doc_id IS NOT DISTINCT FROM CASE WHEN len(c.gs) = 0 THEN doc_id ELSE component_id END AS kept
            FROM cut c LEFT JOIN sets ON list_sort(c.gs) = sets.gs LEFT JOIN least_ids USING (s)
        """,
        "op13_prefix_trie": rf"""
            WITH turns AS (
                SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i
                FROM conversations WHERE conv_id IS NOT NULL
            ),
            own AS (SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY i) AS ts FROM turns GROUP BY 1),
            spelled AS (SELECT CAST(conv_id AS VARCHAR) AS s FROM own),
            {SQL_CRCS},
            rebuilt AS (
                SELECT o.conv_id, list_concat(coalesce(b.ts[1:crc % 4], []), o.ts[crc % 4 + 1:]) AS ts
                FROM own o JOIN crcs ON s = CAST(o.conv_id AS VARCHAR) LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 20
            ),
            paths AS (SELECT conv_id, d, ts[1:d] AS node, d = len(ts) AS whole FROM (SELECT conv_id, ts, unnest(range(len(ts) + 1)) AS d FROM rebuilt)),
            nodes AS (
                SELECT node, d, min(conv_id) AS conv_id, count(*) AS n_convs, sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE whole), '')) AS ends_sha256,
                    CASE WHEN d = 0 THEN 0 ELSE (count(*) - 1) * len(regexp_extract_all(node[d].text, '[^\x20\x09-\x0D]+')) END AS saved
                FROM paths GROUP BY node, d
            ),
            family AS (
                SELECT n.*, p.conv_id AS parent_conv_id, (SELECT count(*) FROM nodes c WHERE c.d = n.d + 1 AND c.node[1:n.d] = n.node) AS n_children
                FROM nodes n LEFT JOIN nodes p ON p.d = n.d - 1 AND p.node = n.node[1:n.d - 1]
            ),
            above AS (SELECT n_children, saved, node[1:a] AS node, a AS d FROM (SELECT *, unnest(range(d + 1)) AS a FROM family)),
            totals AS (SELECT node, d, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum(saved) AS saved_tokens FROM above GROUP BY 1, 2)
            SELECT f.conv_id, f.d AS depth, parent_conv_id, n_convs, n_children, n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, ends_sha256
            FROM family f JOIN totals t ON t.d = f.d AND t.node = f.node
        """,
    }
