"""The registered queries of the subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesflow.llm import (
    block_names,
    bpe,
    complement_packing,
    language,
    licenses,
    line_quality,
    main_text,
    near_duplicates,
    prefix_trie,
    sharding,
    token_matrix,
    voronoi,
    whitening,
)
from salesflow.llm.encoding import vocabulary
from salesflow.llm.sampling import fold


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files ``source/lang/doc_id``, a missing part as ``-``; licence files hand their licence down to their directory."""
    documents = _table(spark, sf_dir, "documents")
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in ("source", "lang", "doc_id")]
    return licenses.scan(documents.select("doc_id", F.concat_ws("/", *parts).alias("path"), "text"))


def op2_token_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed matrix of all documents, its rows as they would be written."""
    return token_matrix.pack_matrix(_table(spark, sf_dir, "documents"), vocabulary())


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight equal shards; law: ``key``."""
    return sharding.placements(_table(spark, sf_dir, "documents"))


def op4_voronoi_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return voronoi.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op5_complement_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return complement_packing.pack_documents(_table(spark, sf_dir, "documents"), vocabulary())


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(_table(spark, sf_dir, "documents"), vocabulary())


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    held_out = fold(F.col("doc_id"), 3) == 1
    model = language.fit(documents.where(~held_out))
    found = language.with_language(documents.select("doc_id", "text"), model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op10_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    field = line_quality.fit(documents, labels.where(fold(F.col("doc_id"), 5) != 0))
    scored = line_quality.with_quality(documents.select("doc_id", "text"), field)
    return scored.select(
        "doc_id",
        (fold(F.col("doc_id"), 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(_table(spark, sf_dir, "documents"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = block_names.exact_duplicates(_table(spark, sf_dir, "documents"))
    return result.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector counts as often as it occurs."""
    whitened = whitening.whiten(_table(spark, sf_dir, "embeddings"))
    return whitened.withColumn("deviation", F.col("deviation").cast("long"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(_table(spark, sf_dir, "conversations"))


def op13_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = main_text.with_main_text(_table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return pages.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_licenses": op1_licenses,
    "op2_token_matrix": op2_token_matrix,
    "op3_sharding": op3_sharding,
    "op4_voronoi_top_k": op4_voronoi_top_k,
    "op5_complement_packing": op5_complement_packing,
    "op6_bpe": op6_bpe,
    "op7_language": op7_language,
    "op8_near_duplicates": op8_near_duplicates,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_line_quality": op10_line_quality,
    "op11_whitening": op11_whitening,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_main_text": op13_main_text,
}

_TEMPLATE_ROWS = ", ".join(f"({i}, '{name}', '{kind}', '{text}', '{words}')" for i, (name, kind, text, words) in enumerate(licenses.TEMPLATES))
_WINDOW_ROWS = ", ".join(f"({width}, {max(width // 2, 1)}, {width // 2})" for width in licenses.WINDOWS)

#: Words of five by position, as the near-duplicate operator defines them.
_WORDS = """
          SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                            '[^\\x20\\x09-\\x0D]+') AS w
          FROM documents"""

#: The table of CRC-32 by byte value.
_CRC_TABLE = """
        steps(b, n, c) AS (
          SELECT range, 0, range::BIGINT FROM range(256)
          UNION ALL
          SELECT b, n + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END FROM steps WHERE n < 8
        ),
        crc AS (SELECT list(c ORDER BY b) AS t FROM steps WHERE n = 8)"""

ORACLES: dict[str, str] = {
    "op1_licenses": f"""
        WITH template(i, license, kind, body, words) AS (VALUES {_TEMPLATE_ROWS}),
        tt AS (
          SELECT i, t, count(*) AS n
          FROM (SELECT i, unnest(regexp_extract_all(lower(body), '[\\p{{L}}\\p{{N}}]+')) AS t FROM template) GROUP BY ALL
        ),
        need AS (SELECT DISTINCT i, unnest(string_split(words, ' ')) AS t FROM template),
        needs AS (SELECT i, count(*) AS n FROM need GROUP BY i),
        doc AS (
          SELECT row_number() OVER () AS r, doc_id,
                 concat_ws('/', coalesce(source, '-'), coalesce(lang, '-'), coalesce(doc_id::VARCHAR, '-')) AS path, coalesce(text, '') AS body
          FROM documents
        ),
        total AS (SELECT count(*) AS n FROM doc),
        idf AS (
          SELECT t, ln(any_value(total.n)::DOUBLE / count(*)) + 1 AS w
          FROM (SELECT DISTINCT r, unnest(regexp_extract_all(lower(body), '[\\p{{L}}\\p{{N}}]+')) AS t FROM doc), total
          GROUP BY t HAVING count(*) >= {licenses.RARE} * any_value(total.n)
        ),
        norm AS (
          SELECT i, sqrt(sum((n * coalesce(w, {licenses.rarest()!r})) ** 2)) AS z FROM tt LEFT JOIN idf USING (t) GROUP BY i
        ),
        wide(width, step, less) AS (VALUES {_WINDOW_ROWS}),
        line AS (SELECT r, string_split(body, chr(10)) AS lines FROM doc),
        part AS (
          SELECT r, lines, width, unnest(range(1, greatest(len(lines) - less, 1) + 1, step)) AS pos FROM line, wide
        ),
        seg AS (
          SELECT r, true AS whole, 0 AS width, 0 AS pos, body FROM doc
          UNION ALL
          SELECT r, false, width, pos, array_to_string(lines[pos:pos + width - 1], ' ') FROM part
        ),
        st AS (
          SELECT r, whole, width, pos, t, count(*) AS n
          FROM (SELECT r, whole, width, pos, unnest(regexp_extract_all(lower(body), '[\\p{{L}}\\p{{N}}]+')) AS t FROM seg) GROUP BY ALL
        ),
        met AS (
          SELECT r, whole, width, pos, need.i FROM st JOIN need USING (t) JOIN needs ON needs.i = need.i
          GROUP BY r, whole, width, pos, need.i HAVING count(*) = any_value(needs.n)
        ),
        weighed AS (
          SELECT r, whole, width, pos, t, st.n * coalesce(w, {licenses.rarest()!r}) AS v
          FROM st SEMI JOIN met USING (r, whole, width, pos) LEFT JOIN idf USING (t)
        ),
        size AS (SELECT r, whole, width, pos, sqrt(sum(v ** 2)) AS z FROM weighed GROUP BY ALL),
        cosine AS (
          SELECT m.r, m.whole, m.i, round(sum(d.v * tt.n * coalesce(idf.w, {licenses.rarest()!r})) / any_value(size.z) / any_value(norm.z), 6) AS score
          FROM met m
          JOIN weighed d ON d.r = m.r AND d.whole = m.whole AND d.width = m.width AND d.pos = m.pos
          JOIN tt ON tt.i = m.i AND tt.t = d.t LEFT JOIN idf ON idf.t = d.t JOIN norm ON norm.i = m.i
          JOIN size ON size.r = m.r AND size.whole = m.whole AND size.width = m.width AND size.pos = m.pos
          GROUP BY m.r, m.whole, m.width, m.pos, m.i
        ),
        own AS (
          SELECT r, license, score, evidence
          FROM (
            SELECT r, license, score,
                   CASE WHEN whole AND score >= {licenses.FILE} OR NOT whole AND score >= {licenses.HEADER} AND kind = 'body' THEN 'file'
                        WHEN NOT whole AND score >= {licenses.HEADER} THEN 'header' END AS evidence
            FROM cosine JOIN template USING (i)
          )
          WHERE evidence IS NOT NULL
          QUALIFY row_number() OVER (PARTITION BY r ORDER BY evidence, score DESC, license) = 1
        ),
        placed AS (
          SELECT doc.r, doc_id, path, regexp_replace(path, '/?[^/]*$', '') AS dir, license, score, evidence
          FROM doc LEFT JOIN own USING (r)
        ),
        holder AS (
          SELECT dir, license FROM placed WHERE evidence = 'file'
          QUALIFY row_number() OVER (PARTITION BY dir ORDER BY score DESC, license) = 1
        ),
        above AS (
          SELECT d.dir, holder.dir AS license_dir, holder.license AS passed
          FROM (SELECT DISTINCT dir FROM placed) d JOIN holder
            ON holder.dir = d.dir OR holder.dir = '' OR starts_with(d.dir, holder.dir || '/')
          QUALIFY row_number() OVER (PARTITION BY d.dir ORDER BY length(holder.dir) DESC) = 1
        )
        SELECT doc_id, path, license AS own_license, score AS own_score,
               coalesce(evidence, CASE WHEN passed IS NOT NULL THEN 'inherited' END) AS evidence,
               coalesce(license, passed) AS license,
               CASE WHEN evidence IS NULL THEN license_dir END AS license_dir
        FROM placed LEFT JOIN above USING (dir)""",
    "op8_near_duplicates": f"""
        WITH RECURSIVE words AS ({_WORDS}),
        sh AS (
          SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
          FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM words WHERE len(w) > 0)
        ),
        n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
        pair AS (
          SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared
          FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
        ),
        link AS (
          SELECT a, b FROM pair JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 75 * (x.n + y.n - shared)
        ),
        reach(doc_id, other) AS (
          SELECT doc_id, doc_id FROM documents
          UNION
          SELECT reach.doc_id, link.b FROM reach JOIN link ON link.a = reach.other
        ),
        low AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
        SELECT low.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, low.doc_id = component_id AS kept
        FROM low LEFT JOIN n ON n.doc_id = low.doc_id""",
    # the draws are 52-bit prefixes of MD5; with equal weights the largest draw wins
    "op3_sharding": f"""
        WITH RECURSIVE {_CRC_TABLE},
        docs AS (
          SELECT doc_id, strlen(coalesce(text, ''))::BIGINT + 1 AS size, hex(encode(coalesce(text, ''))) AS h,
                 coalesce('k' || doc_id::VARCHAR, 'missing') AS k
          FROM documents
        ),
        summed AS (
          SELECT doc_id, size, k,
            xor(list_reduce(
              [4294967295::BIGINT] || list_transform(range(1, size), lambda i: ('0x' || substr(h, (2 * i - 1)::BIGINT, 2))::BIGINT),
              lambda a, b: xor(a >> 8, t[(xor(a & 255, b)) + 1])), 4294967295::BIGINT) AS text_crc32
          FROM docs, crc
        ),
        drawn AS (
          SELECT s.doc_id, s.size, s.k, s.text_crc32, r.range::INTEGER AS i,
                 ('0x' || substr(md5(s.k || ':' || r.range), 1, 13))::BIGINT AS d
          FROM summed s, range(9) r
        ),
        won AS (
          SELECT doc_id, size, k, text_crc32,
                 arg_max(i, d * 16 - i) FILTER (i < 8) AS shard, arg_max(i, d * 16 - i) AS grown_shard
          FROM drawn GROUP BY ALL
        )
        SELECT doc_id, size, text_crc32, 'key' AS law, shard,
               row_number() OVER (PARTITION BY shard
                 ORDER BY ('0x' || substr(md5(k), 1, 13))::BIGINT, doc_id, size, text_crc32) - 1 AS slot,
               grown_shard
        FROM won""",
    "op4_voronoi_top_k": """
        WITH v AS (
          SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS q FROM embeddings
          WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ),
        s AS (
          SELECT a.vec_id AS query_id, b.vec_id, list_dot_product(a.q, b.q)::BIGINT AS score
          FROM v a JOIN v b ON a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id
        ),
        r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20""",
    "op9_exact_dedup": """
        WITH d AS (
          SELECT doc_id, length(coalesce(text, '')) AS chars,
                 regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') AS body
          FROM documents
        ),
        w AS (
          SELECT *, first_value(doc_id) OVER (PARTITION BY body ORDER BY chars DESC, doc_id) AS keep_id,
                 count(*) OVER (PARTITION BY body) AS group_size
          FROM d
        )
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256 FROM w""",
    "op12_prefix_trie": f"""
        WITH RECURSIVE {_CRC_TABLE},
        turn AS (
          SELECT conv_id, {{'r': coalesce(role, ''), 'x': coalesce(text, '')}} AS v,
                 row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place
          FROM conversations WHERE conv_id IS NOT NULL
        ),
        own AS (SELECT conv_id, list(v ORDER BY place) AS turns FROM turn GROUP BY conv_id),
        rule AS (
          SELECT conv_id, turns, conv_id - conv_id % 100 AS lender,
            xor(list_reduce(
              [4294967295::BIGINT] || list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT),
              lambda a, b: xor(a >> 8, t[(xor(a & 255, b)) + 1])), 4294967295::BIGINT) % 6 AS h
          FROM own, crc
        ),
        conv AS (
          SELECT rule.conv_id, coalesce(own.turns, [])[1:h] || rule.turns[h + 1:] AS turns FROM rule LEFT JOIN own ON own.conv_id = rule.lender
        ),
        member AS (SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS depth FROM conv),
        node AS (
          SELECT depth, turns[1:depth] AS path, min(conv_id) AS conv_id, count(*) AS n,
                 coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (len(turns) = depth), '') AS ends
          FROM member GROUP BY ALL
        ),
        kids AS (SELECT path[1:depth - 1] AS path, depth - 1 AS depth, count(*) AS n FROM node WHERE depth > 0 GROUP BY ALL),
        below AS (
          SELECT path[1:d] AS path, d AS depth, sum(leaf) AS leaves, sum(saved) AS saved
          FROM (
            SELECT node.path, unnest(range(0, node.depth + 1)) AS d, CASE WHEN kids.n IS NULL THEN 1 ELSE 0 END AS leaf,
                   CASE WHEN node.depth = 0 THEN 0 ELSE (node.n - 1) * length(node.path[node.depth].x) END AS saved
            FROM node LEFT JOIN kids ON kids.depth = node.depth AND kids.path = node.path
          )
          GROUP BY ALL
        )
        SELECT node.conv_id, node.depth, up.conv_id AS parent_conv_id, node.n AS n_convs, coalesce(kids.n, 0) AS n_children,
               below.leaves::BIGINT AS n_leaves, below.saved::BIGINT AS saved_tokens, sha256(node.ends) AS ends_sha256
        FROM node
        JOIN below ON below.depth = node.depth AND below.path = node.path
        LEFT JOIN kids ON kids.depth = node.depth AND kids.path = node.path
        LEFT JOIN node up ON up.depth = node.depth - 1 AND up.path = node.path[1:node.depth - 1]""",
}
