"""The registered corpus queries, each over its whole table, and the SQL that gives the same rows where there is one."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyledger.llm import block_naming, compression_quality, deleted_interpolation, induced_sorting, license_scan, packing, part_enum, pii, positional_index, relative_lz, secret_ownership, spelling_variants, subvector_clustering
from skyledger.llm.common import fold

TOKENIZER = "byte_bpe_50k.json"


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality_model(spark, sf_dir):
    """The classifier, fitted on labels of documents that are not held out."""
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").where(fold(F.col("doc_id")) != 0)
    return compression_quality.fit(docs, labels)


def op1_compression_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = compression_quality.scored(docs, quality_model(spark, sf_dir))
    return rows.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "score",
                       (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op2_license_scan(spark, sf_dir):
    return license_scan.report(table(spark, sf_dir, "documents"))


def op3_relative_lz(spark, sf_dir):
    rows = relative_lz.remove_repeats(table(spark, sf_dir, "documents"), length=35)
    return rows.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op4_induced_sorting(spark, sf_dir):
    return induced_sorting.remove_repeats(table(spark, sf_dir, "documents"), length=100)


def op5_pii(spark, sf_dir):
    return pii.report(table(spark, sf_dir, "documents"))


def op6_positional_index(spark, sf_dir):
    return positional_index.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_best_fit_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op8_part_enum(spark, sf_dir):
    return part_enum.join(table(spark, sf_dir, "documents"), length=5, percent=80)


def op9_exact_dedup(spark, sf_dir):
    return block_naming.exact_duplicates(table(spark, sf_dir, "documents"))


def op10_deleted_interpolation(spark, sf_dir):
    remainder = fold(F.col("doc_id"))
    training, deleted = remainder != 1, fold(F.col("doc_id"), 50) % 10 == 4
    rows = deleted_interpolation.score(table(spark, sf_dir, "documents"), training, deleted)
    return rows.select("doc_id", (~F.col("trained")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op11_subvector_clustering(spark, sf_dir):
    return subvector_clustering.cluster(table(spark, sf_dir, "embeddings"), k=16, rounds=3, seed="1", dims=64, scale=64)


def op12_spelling_variants(spark, sf_dir):
    return spelling_variants.variants(table(spark, sf_dir, "documents"), length=7, least=2, factor=10, one_in=31)


def op13_secret_ownership(spark, sf_dir):
    return secret_ownership.report(table(spark, sf_dir, "documents"))


def tokenizer_path():
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


QUERIES = {
    "op1_compression_quality": op1_compression_quality, "op2_license_scan": op2_license_scan, "op3_relative_lz": op3_relative_lz,
    "op4_induced_sorting": op4_induced_sorting,
    "op5_pii": op5_pii,
    "op6_positional_index": op6_positional_index, "op7_best_fit_packing": op7_best_fit_packing, "op8_part_enum": op8_part_enum,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_deleted_interpolation": op10_deleted_interpolation, "op11_subvector_clustering": op11_subvector_clustering,
    "op12_spelling_variants": op12_spelling_variants, "op13_secret_ownership": op13_secret_ownership,
}

def clustering_sql(k: int = 16, rounds: int = 3) -> str:
    """Rounds of clustering, unrolled."""
    text = f"""
        WITH vec AS (
            SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
        c0 AS (
            SELECT CAST(row_number() OVER (ORDER BY h, v) - 1 AS INT) AS c, v
            FROM (SELECT sha256('1:' || coalesce(vec_id::VARCHAR, '')) AS h, v FROM vec ORDER BY h, v LIMIT {k}))"""
    for n in range(rounds + 1):
        text += f""",
        a{n} AS (
            SELECT r, min_by(c, (d, c)) AS c, min(d) AS d FROM (
                SELECT r, c, CAST(list_sum(list_transform(list_zip(vec.v, c{n}.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS d
                FROM vec, c{n}) GROUP BY r)"""
        if n < rounds:
            text += f""",
        m{n} AS (
            SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY i) AS v FROM (
                SELECT c, i, CAST(sum(v[i]) AS BIGINT) AS s, count(*) AS n
                FROM vec JOIN a{n} USING (r), (SELECT unnest(range(1, 65)) AS i) GROUP BY c, i) GROUP BY c),
        c{n + 1} AS (SELECT c, coalesce(m{n}.v, c{n}.v) AS v FROM c{n} LEFT JOIN m{n} USING (c))"""
    return text + f"""
        SELECT vec_id, a{rounds}.c AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY a{rounds}.c) AS BIGINT) AS cluster_inertia,
               CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c{rounds}.v, ',')) AS centroid_sha256
        FROM vec JOIN a{rounds} USING (r) JOIN c{rounds} USING (c)
    """


def spelling_sql() -> str:
    """The checksum byte by byte from its table, deletions to find near words, and chains of forms."""
    step = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
    return f"""
        WITH RECURSIVE bits AS (
            SELECT i, i AS c, 0 AS k FROM (SELECT unnest(range(256))::BIGINT AS i)
            UNION ALL SELECT i, {step}, k + 1 FROM bits WHERE k < 8),
        tab AS (SELECT list(c ORDER BY i) AS t FROM bits WHERE k = 8),
        run AS (
            SELECT doc_id, w, count(*) AS n FROM (
                SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                         '[A-Za-z\u00C0-\u00FF]{{7,}}')) AS w FROM documents) GROUP BY ALL),
        byte AS (
            SELECT w, n, list_transform(range(1, octet_length(encode(k)) + 1), lambda i: ('0x' || substr(hex(encode(k)), 2 * i - 1, 2))::BIGINT) AS b
            FROM (SELECT *, coalesce(doc_id::VARCHAR, '') || ':' || w AS k FROM run)),
        summed AS (
            SELECT w, n, xor(list_reduce(list_concat([4294967295::BIGINT], b), lambda c, x: xor(t[(xor(c, x) & 255) + 1], c >> 8)), 4294967295) AS h
            FROM byte, tab),
        word AS (
            SELECT w, CAST(sum(n) AS BIGINT) AS n FROM (
                SELECT CASE WHEN h % 31 = 0 THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS w, n FROM summed)
            WHERE length(w) >= 7 GROUP BY w HAVING sum(n) >= 2),
        gone AS (
            SELECT w, n, i, substr(w, 1, i - 1) || substr(w, i + 1) AS d FROM (SELECT w, n, unnest(range(1, length(w) + 1)) AS i FROM word)),
        near AS (
            SELECT a.w AS w, b.w AS f, b.n AS n FROM gone a JOIN gone b ON a.d = b.d AND a.i = b.i AND a.w <> b.w
            UNION SELECT a.w, b.w, b.n FROM gone a JOIN word b ON a.d = b.w
            UNION SELECT b.w, a.w, a.n FROM gone a JOIN word b ON a.d = b.w),
        best AS (SELECT w, count(*) AS n_near, max(n) AS top, min_by(f, (-n, f)) AS f FROM near GROUP BY w),
        formed AS (
            SELECT w, word.n AS n, coalesce(n_near, 0) AS n_near, CASE WHEN top >= 10 * word.n THEN f END AS form,
                   CASE WHEN top >= 10 * word.n THEN top END AS form_n FROM word LEFT JOIN best USING (w)),
        chain AS (
            SELECT w, w AS root, 0 AS k FROM formed
            UNION ALL SELECT chain.w, formed.form, k + 1 FROM chain JOIN formed ON formed.w = chain.root WHERE formed.form IS NOT NULL)
        SELECT formed.w AS word, form, root, n, n_near, form_n
        FROM formed JOIN (SELECT w, max_by(root, k) AS root FROM chain GROUP BY w) r USING (w)
    """


def secrets_sql() -> str:
    """Matches per kind with places from the pieces between them, holders of every value, verdicts."""
    kinds = secret_ownership.KINDS
    quoted = lambda text: "'" + text.replace("'", "''") + "'"
    parts = []
    for number, kind in enumerate(kinds):
        tests = [f"length(v) BETWEEN {kind.low} AND {kind.high}"]
        tests += [f"regexp_matches(v, '[{letters}]')" for letters in ("a-z", "A-Z", "0-9")] if kind.mixed else []
        parts.append(f"""
            SELECT d, source, lang, {number} AS k, {kind.owned} AS owned, v, CAST(list_sum(list_transform(g[:i], lambda x: length(x))) + coalesce(
                       list_sum(list_transform(m[:i - 1], lambda x: length(x))), 0) AS BIGINT) AS a, length(m[i]) AS size
            FROM (SELECT *, unnest(e) AS v, unnest(range(1, len(m) + 1)) AS i FROM (
                SELECT d, source, lang, regexp_extract_all(text, {quoted(kind.pattern)}) AS m, regexp_extract_all(text, {quoted(kind.pattern)}, {kind.group}) AS e,
                       string_split_regex(text, {quoted(kind.pattern)}) AS g FROM doc)) WHERE {' AND '.join(tests)}""")
    names = "[" + ", ".join(quoted(kind.name) for kind in kinds) + "]"
    verdicts = "[" + ", ".join(quoted(name) for name in secret_ownership.SCORES) + "]"
    scores = "[" + ", ".join(f"{score}::DOUBLE" for score in secret_ownership.SCORES.values()) + "]"
    counts = ", ".join(f"count(k) FILTER (k = {n}) AS n_{kind.name}" for n, kind in enumerate(kinds) if kind.base)
    listed = f"string_agg({names}[k + 1] || ':' || a || ':' || (a + size), ',' ORDER BY a, k)"
    return f"""
        WITH doc AS (SELECT row_number() OVER () AS d, doc_id, coalesce(text, '') AS text, source, lang FROM documents),
        found AS ({' UNION ALL '.join(parts)}),
        held AS (SELECT v, count(DISTINCT coalesce(source, chr(1))) AS owners, count(DISTINCT (coalesce(source, chr(1)), coalesce(lang, chr(1)))) AS repos FROM found GROUP BY v),
        looked AS (
            SELECT *, CASE WHEN regexp_matches(v, {quoted(secret_ownership.PLACEHOLDER)}) THEN 0 WHEN length(v) >= 16
                           AND len(list_distinct(string_split(v, ''))) >= 10 AND regexp_matches(v, '[0-9]') THEN 2 ELSE 1 END AS look
            FROM found JOIN held USING (v)),
        judged AS (
            SELECT *, CASE WHEN owners >= 3 OR repos >= 6 OR look = 0 THEN 0 WHEN look = 1 THEN 1 WHEN owners = 1 THEN 3 ELSE 2 END AS verdict
            FROM looked WHERE NOT owned OR (owners = 1 AND look = 2))
        SELECT doc.doc_id AS doc_id, {counts}, sha256(coalesce({listed} FILTER (k < {len(secret_ownership.BASE)}), '')) AS base_sha256,
               coalesce({listed}, '') AS spans, coalesce(string_agg({verdicts}[verdict + 1], ',' ORDER BY a, k), '') AS verdicts,
               count(k) FILTER (verdict = 3) AS n_live, count(k) FILTER (verdict = 0) AS n_example, coalesce({scores}[max(verdict) + 1], 0::DOUBLE) AS score
        FROM doc LEFT JOIN judged USING (d) GROUP BY doc.d, doc.doc_id
    """


# Fixed value: the word pattern, in the notation of the SQL engine.
WORDS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

ORACLES = {
    "op3_relative_lz": """
        WITH doc AS (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
        win AS (
            SELECT doc_id, p, list_slice(w, p, p + 34) AS win FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS p FROM doc)),
        hit AS (SELECT doc_id, p FROM win JOIN (SELECT win FROM win GROUP BY win HAVING count(*) > 1) USING (win)),
        gone AS (
            SELECT doc_id, list(DISTINCT q) AS g FROM (SELECT doc_id, unnest(range(p, p + 35)) AS q FROM hit) GROUP BY doc_id),
        kept AS (
            SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS text
            FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM doc)
            WHERE (doc_id, p) NOT IN (SELECT (doc_id, unnest(g)) FROM gone) GROUP BY doc_id)
        SELECT doc_id, len(w) AS n_words, coalesce(len(g), 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
        FROM doc LEFT JOIN gone USING (doc_id) LEFT JOIN kept USING (doc_id)
    """,
    "op6_positional_index": f"""
        WITH item AS (SELECT item_id, {WORDS} AS w FROM benchmark),
        wins AS (
            SELECT DISTINCT item_id, list_slice(w, s, s + 9) AS win, least(len(w), 10) AS size
            FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM item WHERE len(w) > 0)),
        doc AS (SELECT doc_id, {WORDS} AS w FROM documents),
        grams AS (
            SELECT doc_id, p, list_slice(w, p, p + size - 1) AS win, size
            FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS p FROM doc, (SELECT DISTINCT size FROM wins))),
        hit AS (SELECT doc_id, item_id, p, grams.size AS size FROM grams JOIN wins USING (win)),
        word AS (SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(p, p + size)) AS q FROM hit) GROUP BY doc_id),
        items AS (
            SELECT doc_id, count(DISTINCT item_id) AS n_items,
                   string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
            FROM hit GROUP BY doc_id)
        SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM doc LEFT JOIN word USING (doc_id) LEFT JOIN items USING (doc_id)
    """,
    "op8_part_enum": """
        WITH RECURSIVE doc AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
        gram AS (
            SELECT DISTINCT doc_id, list_slice(w, p, p + 4) AS g
            FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS p FROM doc WHERE len(w) > 0)),
        size AS (SELECT doc_id, count(*) AS n FROM gram GROUP BY doc_id),
        link AS (
            SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared FROM gram x JOIN gram y USING (g) GROUP BY ALL) p
            JOIN size s ON s.doc_id = a JOIN size t ON t.doc_id = b WHERE 100 * shared >= 80 * (s.n + t.n - shared)),
        reach AS (SELECT a, b FROM link UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a)
        SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(low, doc_id) AS component_id
        FROM doc LEFT JOIN size USING (doc_id) LEFT JOIN (SELECT a, min(b) AS low FROM reach GROUP BY a) r ON r.a = doc_id
    """,
    "op9_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
    "op11_subvector_clustering": clustering_sql(),
    "op12_spelling_variants": spelling_sql(),
    "op13_secret_ownership": secrets_sql(),
}
