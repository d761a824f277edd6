"""The queries opN_<name> and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import bpe, exact_dedup, language, line_dedup, minhash, near_dedup, neighbours, packing, phrases, quality, secrets, toxicity, vector_codes


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality"))


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digests(_documents(spark, sf_dir))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    return language.identify(docs, public_tokenizers.path("piece_bpe_32k.model"))


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(_documents(spark, sf_dir))


def op5_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.duplicate_groups(_documents(spark, sf_dir))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(_documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.drop_lines(_documents(spark, sf_dir))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(spark.read.parquet(f"{sf_dir}/documents.parquet").select("text", "lang"))


def op13_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_documents(spark, sf_dir))


QUERIES = {f.__name__: f for f in (op1_quality, op2_secrets, op3_language, op4_near_dedup, op5_neighbours, op6_exact_dedup, op7_toxicity, op8_line_dedup, op9_packing, op10_bpe, op11_vector_codes, op12_collocations, op13_minhash_dedup)}

_NORM = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: Kind, pattern, group that is measured, and characters that it has at least: as the contract gives the base ones.
_SPANS = [
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", "AKIA[A-Z0-9]+", 0, 20),
    ("hex", "[0-9a-f]+", 0, 24),
    ("github", "gh[pousr]_[A-Za-z0-9]{36,}", 0, 0),
    ("pem", "-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----", 0, 0),
]


def _secret_spans_sql() -> str:
    """(doc_id, spans) in DuckDB SQL: the texts between the matches and the matches add up to the offsets."""
    each = []
    for rank, (kind, regex, group, _) in enumerate(_SPANS):
        pattern = "'" + regex.replace("'", "''") + "'"
        each.append(f"""
            SELECT k, {rank} AS rank, '{kind}' AS kind, unnest(range(1, len(m) + 1)) AS i, m, g, p
            FROM (SELECT k, regexp_extract_all(t, {pattern}, 0) AS m, regexp_extract_all(t, {pattern}, {group}) AS g, regexp_split_to_array(t, {pattern}) AS p FROM d)""")
    long = " ".join(f"WHEN {rank} THEN {least}" for rank, (*_, least) in enumerate(_SPANS))
    sums = lambda what, upto: f"coalesce(list_sum(list_transform({what}[1:{upto}], lambda x: length(x))), 0)::BIGINT"
    return f"""
        d AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS t FROM documents),
        each AS ({" UNION ALL ".join(each)}),
        span AS (SELECT k, rank, kind, {sums("p", "i")} + {sums("m", "i - 1")} AS s, {sums("p", "i")} + {sums("m", "i")} AS e FROM each WHERE length(g[i]) >= CASE rank {long} END)"""


_WRITTEN = "string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank)"


def _vector_codes_sql() -> str:
    """Four rounds spelt out; inner products are exact, for the components are integers far below 2**26."""
    far = "list_dot_product(x, x) - 2 * list_dot_product(x, e.c) + list_dot_product(e.c, e.c)"
    ctes = [
        "k AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id) AS i, vec_id, label, len(embedding) // 4 AS w, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)",
        "p AS MATERIALIZED (SELECT i, part, list_slice(v, part * w + 1, part * w + w) AS x FROM k, range(4) AS r(part))",
        "b0 AS MATERIALIZED (SELECT part, i - 1 AS entry, x AS c FROM p WHERE i <= 256)",
    ]
    for n in range(5):
        ctes.append(f"a{n} AS MATERIALIZED (SELECT i, p.part, any_value(x) AS x, min(({far})::BIGINT * 256 + entry) AS m FROM p JOIN b{n} e ON p.part = e.part GROUP BY i, p.part)")
        if n < 4:
            ctes.append(f"u{n} AS (SELECT part, m % 256 AS entry, unnest(range(1, len(x) + 1)) AS pos, unnest(x)::BIGINT AS s FROM a{n})")
            ctes.append(f"m{n} AS (SELECT part, entry, list(floor(s / n) ORDER BY pos) AS c FROM (SELECT part, entry, pos, sum(s)::DOUBLE AS s, count(*) AS n FROM u{n} GROUP BY ALL) GROUP BY ALL)")
            ctes.append(f"b{n + 1} AS MATERIALIZED (SELECT b.part, b.entry, coalesce(m{n}.c, b.c) AS c FROM b{n} b LEFT JOIN m{n} USING (part, entry))")
    return (
        f"WITH {', '.join(ctes)}, h AS (SELECT sha256(string_agg(array_to_string(list_transform(c, lambda y: y::BIGINT), ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b4),"
        " f AS (SELECT i, string_agg(printf('%02x', m % 256), '' ORDER BY part) AS code, sum(m // 256)::BIGINT AS error FROM a4 GROUP BY i)"
        " SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM k JOIN f USING (i), h"
    )


ORACLE_SQL = {
    "op11_vector_codes": _vector_codes_sql(),
    "op12_collocations": rf"""
        WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_NORM}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
        w AS (SELECT row_number() OVER () AS k, lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM p),
        t AS MATERIALIZED (SELECT k, lang, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM w),
        g AS (SELECT lang, w AS w1, lead(w, 1) OVER o AS w2, lead(w, 2) OVER o AS w3, lead(w, 3) OVER o AS w4 FROM t WINDOW o AS (PARTITION BY k ORDER BY i)),
        e AS (SELECT lang, size, CASE size WHEN 1 THEN w1 WHEN 2 THEN w1 || ' ' || w2 WHEN 3 THEN w1 || ' ' || w2 || ' ' || w3 ELSE w1 || ' ' || w2 || ' ' || w3 || ' ' || w4 END AS phrase FROM g, range(1, 5) AS s(size)),
        f AS MATERIALIZED (SELECT lang, size, phrase, count(*) AS f FROM e WHERE phrase IS NOT NULL GROUP BY ALL HAVING count(*) >= 30),
        c AS (SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE size > 1),
        cut AS (SELECT c.lang, c.phrase, a, k, l.f AS l, r.f AS r, (2000000::HUGEINT * a) // (l.f + r.f)::HUGEINT AS score FROM c JOIN range(1, 4) AS s(k) ON k < c.size
                JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(ws[1 : k], ' ') JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(ws[k + 1 : c.size], ' ')),
        best AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
        part AS (SELECT lang, array_to_string(ws[i : i + m - 1], ' ') AS phrase, max(a) AS longest FROM c, range(2, 4) AS s(m), range(1, 4) AS q(i) WHERE m < size AND i + m - 1 <= size GROUP BY ALL),
        inside AS (SELECT lang, phrase FROM c JOIN part USING (lang, phrase) WHERE 100 * longest::HUGEINT >= 80 * a::HUGEINT),
        n AS MATERIALIZED (SELECT lang, count(*) AS n FROM t GROUP BY lang),
        kept AS MATERIALIZED (SELECT b.* FROM best b LEFT JOIN inside i ON b.lang = i.lang AND b.phrase = i.phrase WHERE i.phrase IS NULL)
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score::BIGINT AS score FROM kept JOIN n USING (lang) QUALIFY rank <= 2000""",
    "op2_secrets": f"""
        WITH {_secret_spans_sql()}
        SELECT d.doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
               sha256(coalesce({_WRITTEN} FILTER (rank < 3), '')) AS base_sha256, coalesce({_WRITTEN} FILTER (rank >= 0), '') AS spans
        FROM d LEFT JOIN span USING (k) GROUP BY d.k, d.doc_id""",
    "op6_exact_dedup": f"""
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept, text_sha256
        FROM (SELECT doc_id, sha256({_NORM}) AS text_sha256 FROM documents) WINDOW g AS (PARTITION BY text_sha256)""",
    # written from the method: a token is constant at its place in a leaf where three different texts have it there
    "op8_line_dedup": r"""
        WITH d AS (SELECT row_number() OVER () AS k, doc_id, text, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
        e AS (SELECT k, coalesce(text, '') AS body, unnest(range(1, len(lines) + 1)) AS pos, lines FROM d),
        r AS (SELECT k, body, pos, list_filter(regexp_split_to_array(lines[pos], '[\x09-\x0d\x20]+'), lambda t: t <> '') AS raw FROM e),
        m AS (SELECT *, list_transform(raw, lambda t: CASE WHEN regexp_matches(t, '[0-9]') THEN '<*>' ELSE t END) AS masked FROM r WHERE len(raw) > 0),
        l AS (SELECT k, body, pos, CASE WHEN len(list_filter(masked, lambda t: t <> '<*>')) > 0 THEN masked ELSE raw END AS toks FROM m),
        t AS (SELECT *, len(toks) AS n, toks[1:2] AS lead FROM l),
        leaf AS (SELECT n, lead FROM t GROUP BY n, lead HAVING count(DISTINCT body) >= 3),
        f AS (SELECT DISTINCT n, lead, toks, body FROM t JOIN leaf USING (n, lead)),
        p AS (SELECT n, lead, toks, body, unnest(range(1, n + 1)) AS place FROM f),
        constant AS (SELECT n, lead, place, toks[place] AS token FROM p WHERE toks[place] <> '<*>' GROUP BY ALL HAVING count(DISTINCT body) >= 3),
        marked AS (SELECT DISTINCT p.n, p.lead, p.toks, p.place, c.token FROM p LEFT JOIN constant c ON p.n = c.n AND p.lead = c.lead AND p.place = c.place AND p.toks[p.place] = c.token),
        template AS (SELECT n, lead, toks, list(coalesce(token, '<*>') ORDER BY place) AS template, count(token) AS constants FROM marked GROUP BY n, lead, toks),
        named AS (SELECT n, lead, toks, CASE WHEN constants >= 0.7 * n THEN template ELSE toks END AS name FROM template),
        gone AS (SELECT n, lead, name FROM named JOIN f USING (n, lead, toks) GROUP BY n, lead, name HAVING count(DISTINCT body) >= 3),
        lost AS (SELECT k, list(pos) AS lost FROM t JOIN named USING (n, lead, toks) JOIN gone USING (n, lead, name) GROUP BY k)
        SELECT doc_id, CASE WHEN lost IS NULL THEN text ELSE array_to_string(list_transform(list_filter(range(1, len(lines) + 1), lambda i: NOT list_contains(lost, i)), lambda i: lines[i]), chr(10)) END AS text,
               len(lines) AS n_lines, coalesce(len(lost), 0) AS n_dropped
        FROM d LEFT JOIN lost USING (k)""",
}
