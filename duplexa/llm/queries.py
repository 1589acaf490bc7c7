"""The corpus operators' registered queries, each over its whole table."""

from __future__ import annotations

from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duplexa.llm import (
    bpe_automaton,
    embedding_dedup,
    embedding_whitening,
    html_extract,
    license_scan,
    line_dedup,
    minhash_dedup,
    packing,
    quality_classifier,
    suffix_dedup,
    topk_search,
    warc,
)
from duplexa.llm.scratch import Scratch


def word_bpe() -> str:
    """The tokenizer file's content, read on the driver and sent from there."""
    return Path(public_tokenizers.path("word_bpe_49k.json")).read_text("utf-8")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_extract_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_text(_table(spark, sf_dir, "pages"))


def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(_table(spark, sf_dir, "documents"), words=3, percent=85)


def op3_dedup_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = line_dedup.dedup_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("doc_id", "n_lines", "n_removed", "n_runs", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op4_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), word_bpe(), with_ids=False).drop("ids")


def op5_quality_grades(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = quality_classifier.grade_labels(_table(spark, sf_dir, "labels"))
    model = quality_classifier.train(docs, labels, quality_classifier.LEVELS)
    scored = quality_classifier.score(docs, model, quality_classifier.LEVELS - 1)
    return scored.select("doc_id", F.round("expected_grade", 6).alias("expected_grade"), F.round("tail_probability", 6).alias("tail_probability"), "accepted")


def op6_bpe_encode_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_automaton.encode_decode(
        _table(spark, sf_dir, "documents"), word_bpe(), outputs=("n_tokens", "ids_sha256", "decoded_sha256")
    )


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(_table(spark, sf_dir, "documents"))


def op8_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op9_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup_substrings(_table(spark, sf_dir, "documents"))


def op10_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings")
    return topk_search.top_k(rows, rows.where("vec_id % 100 = 0"))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_whitening.whiten(_table(spark, sf_dir, "embeddings"))


def op12_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = Scratch(spark, "warc").root
    warc.write(_table(spark, sf_dir, "pages"), path)
    found = warc.records(warc.read(spark, path, payloads=False))
    return found.select(
        F.col("id").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast("long").alias("refers_to")
    )


QUERIES = {
    f.__name__: f
    for f in (
        op1_extract_main_text,
        op2_minhash_near_dedup,
        op3_dedup_lines,
        op4_pack_sequences,
        op5_quality_grades,
        op6_bpe_encode_decode,
        op7_license_scan,
        op8_embedding_near_dedup,
        op9_suffix_array_dedup,
        op10_exact_top_k,
        op11_embedding_whitening,
        op12_warc_round_trip,
    )
}


def _license_sql() -> str:
    """Known texts and documents made canonical by the same rules, both without the header before a licence's own lines."""
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    line = "lower(x)"
    for one, other in license_scan.SPELLINGS:
        line = f"replace({line}, {quoted(one)}, {quoted(other)})"
    line = f"trim(regexp_replace({line}, {quoted(license_scan.NOT_WORDS)}, ' ', 'g'))"
    header = quoted(rf"^((?:{license_scan.HEADER_LINES})(?:\n|$))+")

    def lines(text):
        made = f"list_transform(string_split(coalesce({text}, ''), chr(10)), lambda x: {line})"
        return f"list_filter({made}, lambda x: x <> '' AND NOT regexp_matches(x, {quoted(license_scan.OWNER_LINES)}))"

    own = f"sha256(replace(regexp_replace(array_to_string(ls, chr(10)), {header}, ''), chr(10), ' '))"
    known = ", ".join(f"({quoted(name)}, {quoted(text)})" for name, text in license_scan.texts())
    return f"""
        WITH k AS (
            SELECT {own} AS d, min(l) AS license_id FROM (SELECT l, {lines("t")} AS ls FROM (VALUES {known}) AS v(l, t)) GROUP BY 1
        ), r AS (SELECT doc_id, {lines("text")} AS ls FROM documents),
        w AS (SELECT doc_id, sha256(array_to_string(ls, ' ')) AS text_digest, {own} AS own_digest FROM r),
        n AS (
            SELECT doc_id, string_agg(DISTINCT license_id, ',' ORDER BY license_id) AS notices
            FROM (SELECT doc_id, sha256(unnest(ls)) AS d FROM r) JOIN k USING (d) GROUP BY doc_id
        )
        SELECT w.doc_id, w.text_digest, CASE WHEN own_digest <> sha256('') THEN k.license_id END AS license_id, coalesce(n.notices, '') AS notices
        FROM w LEFT JOIN k ON k.d = w.own_digest LEFT JOIN n ON n.doc_id = w.doc_id
    """


#: Smallest node reachable over the pairs (x, y) of a relation named link.
REACHED = """
    edge AS (SELECT x, y FROM link UNION SELECT y, x FROM link),
    reach AS (SELECT x AS node, y AS other FROM edge UNION SELECT r.node, e.y FROM reach r JOIN edge e ON e.x = r.other),
    least AS (SELECT node, min(other) AS low FROM reach GROUP BY node)
"""

ORACLE_SQL = {
    "op2_minhash_near_dedup": f"""
        WITH RECURSIVE w AS (
            SELECT doc_id, list_filter(regexp_split_to_array(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws
            FROM documents
        ), s AS (
            SELECT DISTINCT doc_id, array_to_string(ws[i : i + 2], ' ') AS shingle
            FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 2, 1) + 1)) AS i FROM w WHERE len(ws) > 0)
        ), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2),
        link AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 85 * (a.n + b.n - c)),
        {REACHED}
        SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, least(d.doc_id, coalesce(low, d.doc_id)) AS component_id,
            d.doc_id <= coalesce(low, d.doc_id) AS kept
        FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN least ON node = d.doc_id
    """,
    "op8_embedding_near_dedup": f"""
        WITH RECURSIVE v AS (
            SELECT vec_id, e, sqrt(list_inner_product(e, e)) AS norm FROM (
                SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings WHERE embedding IS NOT NULL
            )
        ), link AS (
            SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.vec_id < b.vec_id WHERE list_inner_product(a.e, b.e) / (a.norm * b.norm) >= 0.95
        ), {REACHED}, k AS (SELECT x, count(*) AS n FROM edge GROUP BY x)
        SELECT r.vec_id, CAST(coalesce(k.n, 0) AS BIGINT) AS n_links, least(r.vec_id, coalesce(low, r.vec_id)) AS component_id,
            r.vec_id <= coalesce(low, r.vec_id) AS kept
        FROM embeddings r LEFT JOIN k ON k.x = r.vec_id LEFT JOIN least ON node = r.vec_id
    """,
    "op9_suffix_array_dedup": """
        WITH t AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
        b AS (SELECT doc_id, h, CAST(length(h) // 2 AS BIGINT) AS n FROM t),
        g AS (SELECT doc_id, i, substr(h, CAST(2 * i + 1 AS BIGINT), 100) AS g FROM (SELECT doc_id, h, unnest(range(greatest(n - 49, 0))) AS i FROM b)),
        f AS (SELECT doc_id, i, doc_id > min(doc_id) OVER (PARTITION BY g) AS again FROM g),
        o AS (SELECT doc_id, i, max(i) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM f WHERE again),
        r AS (SELECT doc_id, i, sum(CASE WHEN before IS NULL OR i > before + 50 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM o),
        u AS (SELECT doc_id, run, min(i) AS lo, max(i) + 50 AS hi FROM r GROUP BY doc_id, run),
        k AS (
            SELECT doc_id, lo, hi, coalesce(lag(hi) OVER (PARTITION BY doc_id ORDER BY lo), 0) AS since FROM u
            UNION ALL SELECT b.doc_id, b.n, b.n, coalesce(max(u.hi), 0) FROM b LEFT JOIN u ON u.doc_id = b.doc_id GROUP BY b.doc_id, b.n
        ),
        e AS (
            SELECT b.doc_id, string_agg(substr(b.h, CAST(2 * since + 1 AS BIGINT), CAST(2 * (lo - since) AS BIGINT)), '' ORDER BY lo, hi) AS kept
            FROM k JOIN b ON b.doc_id = k.doc_id GROUP BY b.doc_id
        ),
        c AS (SELECT doc_id, sum(hi - lo) AS removed, count(*) AS spans FROM u GROUP BY doc_id)
        SELECT b.doc_id, b.n AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(spans, 0) AS BIGINT) AS n_spans,
            sha256(unhex(coalesce(kept, ''))) AS kept_sha256
        FROM b LEFT JOIN e ON e.doc_id = b.doc_id LEFT JOIN c ON c.doc_id = b.doc_id
    """,
    "op3_dedup_lines": f"""
        WITH s AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL),
        l AS (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS pos FROM s),
        b AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS k FROM l WHERE trim(line) <> ''),
        p AS (
            SELECT a.doc_id, a.pos, c.pos AS pos2, a.line AS x, c.line AS y
            FROM b a JOIN b c ON a.doc_id = c.doc_id AND c.k = a.k + 1
        ),
        g1 AS (SELECT doc_id, pos, row_number() OVER (PARTITION BY line ORDER BY doc_id, pos) AS n FROM b WHERE length(line) >= {line_dedup.MIN_CHARS}),
        g2 AS (SELECT doc_id, pos, pos2, row_number() OVER (PARTITION BY x, y ORDER BY doc_id, pos) AS n FROM p),
        gone AS (
            SELECT doc_id, pos FROM g1 WHERE n > 1 UNION SELECT doc_id, pos FROM g2 WHERE n > 1 UNION SELECT doc_id, pos2 FROM g2 WHERE n > 1
        ),
        e AS (
            SELECT l.doc_id, count(gone.pos) AS n_removed, string_agg(l.line, chr(10) ORDER BY l.pos) FILTER (gone.pos IS NULL) AS kept,
                count(*) FILTER (gone.pos IS NOT NULL AND before.pos IS NULL) AS n_runs
            FROM l LEFT JOIN gone ON gone.doc_id = l.doc_id AND gone.pos = l.pos
            LEFT JOIN gone before ON before.doc_id = l.doc_id AND before.pos = l.pos - 1 GROUP BY l.doc_id
        )
        SELECT d.doc_id, CAST(coalesce(len(string_split(d.text, chr(10))), 0) AS BIGINT) AS n_lines, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
            CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, sha256(coalesce(kept, '')) AS kept_sha256
        FROM documents d LEFT JOIN e ON e.doc_id = d.doc_id
    """,
    "op7_license_scan": _license_sql(),
    "op10_exact_top_k": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS e FROM embeddings WHERE embedding IS NOT NULL
        ), s AS (
            SELECT q.vec_id AS query_id, r.vec_id AS vec_id, CAST(list_inner_product(q.e, r.e) AS BIGINT) AS score
            FROM v q JOIN v r ON q.vec_id % 100 = 0 AND q.vec_id <> r.vec_id
        ), t AS (
            SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS "rank", vec_id, score FROM s
        )
        SELECT query_id, "rank", vec_id, score FROM t WHERE "rank" <= 10
    """,
    # A base32 letter for each five bits of the digest; x and y are the one or two hexadecimal digits that hold them.
    "op12_warc_round_trip": """
        WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
        d AS (SELECT page_id, octet_length(b) AS n, sha1(b) AS h, min(page_id) OVER (PARTITION BY b) AS first FROM p)
        SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
            array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + ((
                16 * (instr('0123456789abcdef', substr(h, CAST(1 + 5 * i // 4 AS BIGINT), 1)) - 1)
                + greatest(instr('0123456789abcdef', substr(h || '0', CAST(2 + 5 * i // 4 AS BIGINT), 1)) - 1, 0)
            ) // CAST(power(2, 3 - i % 4) AS BIGINT)) % 32 AS BIGINT), 1)), '') AS payload_digest,
            CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to
        FROM d
    """,
}
