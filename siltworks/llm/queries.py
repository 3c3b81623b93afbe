"""The operators' queries over whole tables, with production parameters, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltworks.llm.byte_bpe import digests
from siltworks.llm.common import table
from siltworks.llm.decontamination import decontaminate
from siltworks.llm.html_text import main_text
from siltworks.llm.kd_clusters import kd_clusters
from siltworks.llm.line_dedup import line_dedup
from siltworks.llm.ngram_join import jaccard_components
from siltworks.llm.packing import pack
from siltworks.llm.personal_data import find_personal_data
from siltworks.llm.quality_rules import quality_rules
from siltworks.llm.sharding import external_shuffle
from siltworks.llm.substring_dedup import substring_dedup
from siltworks.llm.url_filter import url_filter
from siltworks.llm.whitening import whiten

#: (verdict, host, path)
URL_RULES = [("block", "com", "/en/"), ("allow", "example.com", "/en/7"), ("allow", "net", "/de/"), ("block", "example.net", "/de/8"), ("block", "org", "/es/")]


#: A later copy of a single line goes from so many words on (or ten times so many code points).
LONG_LINE = 10


def vocabulary() -> tuple[str, str]:
    """Path of the rank file, and the splitting pattern."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = line_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"), min_lines=2, min_words=LONG_LINE)
    return done.select("doc_id", "n_lines", "n_removed", "n_runs", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op2_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_personal_data(table(spark, sf_dir, "documents").select("doc_id", "text"), carry=["doc_id"])
    # all kinds in their order, secrets last
    spans = F.array_join(F.transform("entities", lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    n_secret = F.size(F.filter("entities", lambda s: s["kind"] == "secret")).cast("bigint")
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", spans.alias("spans"), n_secret.alias("n_secret"), F.size("entities").cast("bigint").alias("n_found"))


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents").select("doc_id", "text"), size=5, percent=75).withColumnRenamed("key", "doc_id")


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter(table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents").select("doc_id", "text"), *vocabulary(), carry=["doc_id"])


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"), length=50, with_bytes=False).drop("text")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark").select("item_id", "text"), carry=["doc_id"])


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return external_shuffle(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", (F.octet_length(text).cast("bigint") + F.lit(1).cast("bigint")).alias("size"), F.crc32(text).alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"), carry=["page_id", "url"])


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules(table(spark, sf_dir, "documents").select("doc_id", "text"), carry=["doc_id"])
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "votes", "posterior")


def op11_kd_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kd_clusters(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), k=16, rounds=3, scale=64, dims=64, seed=1, carry=["vec_id"])


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), components=8, scale=1024, shift=100_000, carry=["vec_id"])
    # a deviation beyond 64 bits, as of hundreds of billions of rows, is null here
    return done.withColumn("deviation", F.col("deviation").try_cast("bigint"))


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    pieces = pack(table(spark, sf_dir, "documents").select("doc_id", "text"), path, public_tokenizers.PATTERN, size=1024, end=0, carry=["doc_id"])
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_personal_data": op2_personal_data,
    "op3_ngram_join": op3_ngram_join,
    "op4_url_filter": op4_url_filter,
    "op5_byte_bpe": op5_byte_bpe,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_decontamination": op7_decontamination,
    "op8_sharding": op8_sharding,
    "op9_html_text": op9_html_text,
    "op10_quality_rules": op10_quality_rules,
    "op11_kd_clusters": op11_kd_clusters,
    "op12_whitening": op12_whitening,
    "op13_packing": op13_packing,
}

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Vectors with their nearest centroids of a round, and the centroids of the round after: exact floors of means, or as before.
NEAREST = """SELECT vec_id, x, d // 16 AS distance, d % 16 AS cluster FROM (SELECT vec_id, any_value(x) AS x, min(16 * list_sum(list_transform(range(1, 65), lambda i: (x[i] - c[i]) * (x[i] - c[i])))::BIGINT + cluster) AS d
                FROM (SELECT v.*, row_number() OVER () AS row FROM v), c{} GROUP BY row, vec_id)"""
MEANS = """s{1} AS (SELECT cluster, i, sum(x[i])::HUGEINT AS s, count(*) AS n FROM a{0}, unnest(range(1, 65)) AS t(i) GROUP BY cluster, i),
        m{1} AS (SELECT cluster, list((s - (s % n + n) % n) // n ORDER BY i)::BIGINT[] AS c FROM s{1} GROUP BY cluster),
        c{1} AS (SELECT c{0}.cluster, coalesce(m{1}.c, c{0}.c) AS c FROM c{0} LEFT JOIN m{1} ON c{0}.cluster = m{1}.cluster),"""
CLUSTER_ROUNDS = " ".join(f"a{r} AS ({NEAREST.format(r)}), {MEANS.format(r, r + 1)}" for r in range(3))

ORACLE_SQL: dict[str, str] = {
    "op1_line_dedup": """
        WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents WHERE text IS NOT NULL),
        p AS (SELECT doc_id, unnest(range(len(lines))) AS pos, unnest(lines) AS line FROM l),
        w AS (SELECT doc_id, pos, line, lead(line) OVER (PARTITION BY doc_id ORDER BY pos) AS following FROM p),
        c AS (SELECT doc_id, pos, row_number() OVER (PARTITION BY line, following ORDER BY doc_id, pos) AS nth FROM w WHERE following IS NOT NULL),
        a AS (SELECT doc_id, pos, row_number() OVER (PARTITION BY line ORDER BY doc_id, pos) AS nth FROM p WHERE len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) >= 10 OR length(trim(line)) >= 100),
        gone AS (SELECT doc_id, unnest([pos, pos + 1]) AS pos FROM c WHERE nth > 1 UNION SELECT doc_id, pos FROM a WHERE nth > 1),
        m AS (SELECT p.doc_id, p.pos, p.line, g.pos IS NOT NULL AS removed, coalesce(lag(g.pos IS NOT NULL) OVER (PARTITION BY p.doc_id ORDER BY p.pos), false) AS before
              FROM p LEFT JOIN gone g ON p.doc_id = g.doc_id AND p.pos = g.pos),
        r AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (removed) AS n_removed, count(*) FILTER (removed AND NOT before) AS n_runs,
                     coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT removed), '') AS kept FROM m GROUP BY doc_id)
        SELECT d.doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_runs, 0)::BIGINT AS n_runs, sha256(coalesce(kept, '')) AS kept_sha256
        FROM documents d LEFT JOIN r ON d.doc_id = r.doc_id""",
    "op3_ngram_join": f"""
        WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
        s AS (SELECT DISTINCT doc_id, array_to_string(words[i:i + 4], ' ') AS g FROM w, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS t(i) WHERE len(words) > 0),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
        e AS (SELECT o.a, o.b FROM o JOIN n x ON x.doc_id = o.a JOIN n y ON y.doc_id = o.b WHERE 100 * shared >= 75 * (x.n + y.n - shared)),
        r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
        SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, min(r.b) AS component_id FROM documents d JOIN r ON r.a = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id GROUP BY d.doc_id, n.n""",
    "op6_substring_dedup": """
        WITH h AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
        w AS (SELECT doc_id, i, substr(x, 2 * i + 1, 100) AS s FROM h, unnest(range((length(x) // 2 - 49)::BIGINT)) AS t(i)),
        f AS (SELECT hash(s) AS s, min(doc_id) AS first FROM w GROUP BY 1),
        c AS (SELECT w.doc_id, w.i, w.i - lag(w.i) OVER (PARTITION BY w.doc_id ORDER BY w.i) AS gap FROM w JOIN f ON hash(w.s) = f.s WHERE f.first < w.doc_id),
        g AS (SELECT doc_id, i, sum(CASE WHEN gap <= 50 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM c),
        r AS (SELECT doc_id, run, min(i) AS a, max(i) + 50 AS b FROM g GROUP BY 1, 2),
        q AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before, lead(a) OVER (PARTITION BY doc_id ORDER BY a) AS after FROM r),
        k AS (SELECT q.doc_id, count(*) AS n_spans, sum(b - a) AS n_removed,
                     string_agg(substr(x, 2 * before + 1, 2 * (a - before)) || CASE WHEN after IS NULL THEN substr(x, 2 * b + 1) ELSE '' END, '' ORDER BY a) AS kept
              FROM q JOIN h ON q.doc_id = h.doc_id GROUP BY q.doc_id)
        SELECT h.doc_id, (length(x) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(kept, x))) AS kept_sha256
        FROM h LEFT JOIN k ON h.doc_id = k.doc_id""",
    "op7_decontamination": f"""
        WITH dw AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') AS ws FROM documents),
        bw AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') AS ws FROM benchmark),
        items AS (SELECT DISTINCT item_id, least(len(ws), 13) AS n, array_to_string(ws[i:i + 12], ' ') AS g FROM bw, unnest(range(1, greatest(len(ws) - 12, 1) + 1)) AS t(i) WHERE len(ws) > 0),
        lengths AS (SELECT DISTINCT n FROM items),
        dg AS (SELECT doc_id, n, i, array_to_string(ws[i:i + n - 1], ' ') AS g FROM dw, lengths, unnest(range(1, len(ws) - n + 2)) AS t(i)),
        m AS (SELECT dg.doc_id, dg.n, dg.i, items.item_id FROM dg JOIN items ON dg.n = items.n AND dg.g = items.g),
        hit AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS place FROM (SELECT DISTINCT doc_id, n, i FROM m)) GROUP BY doc_id),
        own AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM m) GROUP BY doc_id)
        SELECT dw.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
        FROM dw LEFT JOIN hit ON dw.doc_id = hit.doc_id LEFT JOIN own ON dw.doc_id = own.doc_id""",
    "op11_kd_clusters": f"""
        WITH v AS (SELECT vec_id, list_transform(embedding, lambda e: floor(64 * e::DOUBLE)::BIGINT) AS x FROM embeddings
                   WHERE len(embedding) = 64 AND list_bool_and(list_transform(embedding, lambda e: e IS NOT NULL AND isfinite(e)))),
        c0 AS (SELECT row_number() OVER (ORDER BY h, x) - 1 AS cluster, x AS c FROM (SELECT sha256('1:' || vec_id) AS h, x FROM v ORDER BY h, x LIMIT 16)),
        {CLUSTER_ROUNDS}
        a AS ({NEAREST.format(3)}),
        t AS (SELECT cluster, sum(distance)::BIGINT AS cluster_inertia FROM a GROUP BY cluster)
        SELECT a.vec_id, a.cluster::INTEGER AS cluster, a.distance, t.cluster_inertia, (SELECT sum(distance) FROM a)::BIGINT AS inertia, sha256(array_to_string(c3.c, ',')) AS centroid_sha256
        FROM a JOIN t ON a.cluster = t.cluster JOIN c3 ON a.cluster = c3.cluster""",
}
