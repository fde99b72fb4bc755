"""DuckDB SQL for the text queries that SQL can express."""

from __future__ import annotations

_SMALL = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ITEM_WORDS = r"regexp_extract_all({0}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def _item_words(text: str) -> str:
    return _ITEM_WORDS.format(_SMALL.format(f"coalesce({text}, '')"))


def _finite(vector: str) -> str:
    return f"({vector} IS NOT NULL AND coalesce(list_bool_and(list_transform({vector}, lambda x: coalesce(isfinite(x), false))), true))"


def _whole(vector: str, scale: int) -> str:
    return f"list_transform({vector}, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT))"


def _clusters(rounds: int) -> str:
    """Three rounds of k-means, one after the other."""
    far = "list_sum(list_transform(range(1, 65), lambda i: (v.x[i] - c.x[i]) * (v.x[i] - c.x[i])))"
    steps = [f"""
        v AS (SELECT vec_id, {_whole("embedding", 64)} AS x FROM embeddings WHERE len(embedding) = 64 AND {_finite("embedding")}),
        c0 AS (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS c, x FROM v QUALIFY c < 16)"""]
    for n in range(rounds + 1):
        steps.append(f"""
        a{n} AS (
            SELECT vec_id, v.x, c.c, {far} AS d FROM v, c{n} c
            QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, c.c) = 1)""")
        if n < rounds:
            steps.append(f"""
        s{n} AS (SELECT c, i, sum(e) AS s, count(*) AS n FROM (SELECT c, unnest(x) AS e, generate_subscripts(x, 1) AS i FROM a{n}) GROUP BY c, i),
        m{n} AS (SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS x FROM s{n} GROUP BY c),
        c{n + 1} AS (SELECT c, coalesce(m.x, old.x) AS x FROM c{n} old LEFT JOIN m{n} m USING (c))""")
    return f"""
        WITH {",".join(steps)}
        SELECT vec_id, CAST(a.c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance,
            CAST(sum(d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
            sha256(array_to_string(c.x, ',')) AS centroid_sha256
        FROM a{rounds} a JOIN c{rounds} c USING (c)"""


CHECKS: dict[str, str] = {
    "op2_ngram_join": rf"""
        WITH RECURSIVE d AS (
            SELECT doc_id, regexp_extract_all({_SMALL.format("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS w FROM documents
        ), s AS (
            SELECT DISTINCT doc_id, md5(array_to_string(w[k:k + 4], ' ')) AS g
            FROM (SELECT *, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS k FROM d WHERE len(w) > 0)
        ), n AS (
            SELECT doc_id, count(*) AS n FROM s GROUP BY 1
        ), p AS (
            SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS i
            FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY 1, 2
        ), l AS (
            SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * i >= 75 * (na.n + nb.n - i)
        ), links AS (
            SELECT a, b FROM l UNION ALL SELECT b, a FROM l
        ), reach AS (
            SELECT doc_id, doc_id AS other FROM d
            UNION
            SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.other
        )
        SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(other) AS component_id
        FROM d JOIN reach USING (doc_id) LEFT JOIN n USING (doc_id) GROUP BY 1""",
    "op3_passages": r"""
        WITH d AS (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
        ), runs AS (
            SELECT doc_id, k, md5(array_to_string(w[k:k + 34], ' ')) AS run
            FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS k FROM d WHERE len(w) >= 35)
        ), again AS (
            SELECT doc_id, k FROM (SELECT *, count(*) OVER (PARTITION BY run) AS n FROM runs) WHERE n > 1
        ), gone AS (
            SELECT DISTINCT doc_id, unnest(range(k, k + 35)) AS p FROM again
        ), listed AS (
            SELECT doc_id, count(*) AS n_removed, list(p) AS ps FROM gone GROUP BY 1
        ), kept AS (
            SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS left_over
            FROM (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d) x
            WHERE NOT EXISTS (SELECT 1 FROM gone g WHERE g.doc_id = x.doc_id AND g.p = x.p) GROUP BY 1
        )
        SELECT doc_id, len(w) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(left_over, '')) AS kept_sha256
        FROM d LEFT JOIN listed USING (doc_id) LEFT JOIN kept USING (doc_id)""",
    "op5_bytespans": """
        WITH d AS (
            SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n FROM documents
        ), runs AS (
            SELECT doc_id, k, md5(substr(h, 2 * k - 1, 200)) AS run
            FROM (SELECT doc_id, h, unnest(range(1, n - 98)) AS k FROM d WHERE n >= 100)
        ), later AS (
            SELECT doc_id, k FROM (SELECT *, row_number() OVER (PARTITION BY run ORDER BY doc_id, k) AS r FROM runs) WHERE r > 1
        ), parts AS (
            SELECT doc_id, k, k - lag(k) OVER (PARTITION BY doc_id ORDER BY k) > 100 AS apart,
                lag(k) OVER (PARTITION BY doc_id ORDER BY k) IS NULL AS first FROM later
        ), spans AS (
            SELECT doc_id, s, min(k) AS a, max(k) + 99 AS b
            FROM (SELECT *, count(*) FILTER (WHERE first OR apart) OVER (PARTITION BY doc_id ORDER BY k) AS s FROM parts) GROUP BY 1, 2
        ), pieces AS (
            SELECT d.doc_id, a, b, substr(h, 2 * coalesce(lag(b) OVER w, 0) + 1, 2 * (a - 1 - coalesce(lag(b) OVER w, 0))) AS before
            FROM d JOIN spans USING (doc_id) WINDOW w AS (PARTITION BY d.doc_id ORDER BY a)
        ), cut AS (
            SELECT doc_id, count(*) AS n_spans, sum(b - a + 1)::BIGINT AS n_removed, max(b) AS last_b,
                string_agg(before, '' ORDER BY a) AS kept
            FROM pieces GROUP BY 1
        )
        SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
            sha256(unhex(coalesce(kept, '') || substr(h, 2 * coalesce(last_b, 0) + 1))) AS kept_sha256
        FROM d LEFT JOIN cut USING (doc_id)""",
    "op9_decontaminate": f"""
        WITH i AS (
            SELECT item_id, {_item_words("text")} AS w FROM benchmark
        ), windows AS (
            SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[k:k + least(len(w), 10) - 1], ' ') AS run
            FROM (SELECT *, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS k FROM i WHERE len(w) > 0)
        ), sizes AS (
            SELECT DISTINCT n FROM windows
        ), d AS (
            SELECT doc_id, {_item_words("text")} AS w FROM documents
        ), runs AS (
            SELECT doc_id, n, k, array_to_string(w[k:k + n - 1], ' ') AS run
            FROM (SELECT doc_id, n, w, unnest(range(1, len(w) - n + 2)) AS k FROM d, sizes WHERE len(w) >= n)
        ), found AS (
            SELECT doc_id, item_id, k, runs.n FROM runs JOIN windows ON runs.n = windows.n AND runs.run = windows.run
        ), words_hit AS (
            SELECT doc_id, count(DISTINCT p) AS n_hit
            FROM (SELECT doc_id, unnest(range(k, k + n)) AS p FROM (SELECT DISTINCT doc_id, k, n FROM found)) GROUP BY 1
        ), named AS (
            SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
            FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY 1
        )
        SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
            sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN words_hit USING (doc_id) LEFT JOIN named USING (doc_id)""",
    "op10_warc": """
        WITH p AS (
            SELECT page_id, coalesce(html, '') AS body, strlen(coalesce(html, '')) AS payload_bytes FROM pages
        ), f AS (
            SELECT *, min(page_id) OVER (PARTITION BY body) AS first_id FROM p
        )
        SELECT page_id, payload_bytes, sha256(body) AS payload_digest,
            CASE WHEN payload_bytes >= 100 AND first_id <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
            CASE WHEN payload_bytes >= 100 AND first_id <> page_id THEN first_id END AS refers_to
        FROM f""",
    "op12_hard_negatives": f"""
        WITH r AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, {_whole("embedding", 256)} AS x
            FROM embeddings WHERE label IS NOT NULL AND {_finite("embedding")}
        ), s AS (
            SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
                list_sum(list_transform(range(1, len(a.x) + 1), lambda i: a.x[i] * b.x[i])) AS score
            FROM r a JOIN r b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0
        ), p AS (
            SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5
        ), n AS (
            SELECT anchor_id, positive_id, other AS negative_id, positive_score, score AS negative_score,
                row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) AS rank
            FROM p JOIN s USING (anchor_id) WHERE NOT same AND 100 * score BETWEEN 50 * positive_score AND 95 * positive_score
        )
        SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, CAST(positive_score AS BIGINT) AS positive_score,
            CAST(negative_score AS BIGINT) AS negative_score
        FROM n WHERE rank <= 3""",
    "op13_centroids": _clusters(3),
}
